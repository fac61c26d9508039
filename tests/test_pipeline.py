"""Whole-run behaviour (31-33): the reference's pipeline scenarios as table tests."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from eventloom.functions.ids import event_key
from eventloom.operators.stores import DEDUP_NAMESPACE, latest_vectors, read_articles, read_vector_log
from eventloom.plans.pipeline import read_quarantine, run_pipeline
from eventloom.sources.intake import RESPONSE_SCHEMA
from eventloom.streaming.stream import stream_pipeline

RUN_TS = "2024-01-15 00:00:00"
A = {"title": "Storm hits coast", "summary": "A strong storm reached the northern coast overnight with heavy rain"}
B = {"title": "Markets rally", "summary": "Stock markets rallied after central bank comments on interest rates"}


def answers(spark, payloads, start=0):
    ts = dt.datetime(2024, 1, 15, 8)
    return spark.createDataFrame(
        [(start + i, 200, json.dumps({"events": p}), ts) for i, p in enumerate(payloads)], RESPONSE_SCHEMA)


def corpus(spark):
    return spark.createDataFrame(
        [(1, "http://a.example/1", "storm coast rain heavy"), (2, "http://b.example/2", "markets rally bank rates"),
         (3, "http://c.example/3", "unrelated words only")],
        "page_id long, url string, content string")


def run(spark, tmp, payloads, batch_id, **kw):
    res = run_pipeline(spark, answers(spark, payloads), corpus(spark), tmp + "/vec", tmp + "/art",
                       batch_id=batch_id, run_ts=RUN_TS, **kw)
    return res.stats.first().asDict()


def test_two_unique_events_are_stored(spark, tmp_dir):
    assert run(spark, tmp_dir, [[A, B]], 1) == {"total": 2, "duplicates": 0, "stored": 2, "rejected": 0}
    art = read_articles(spark, tmp_dir + "/art").collect()
    assert sorted(r.title for r in art) == ["Markets rally", "Storm hits coast"]
    storm = next(r for r in art if r.title == A["title"])
    assert storm.sources[0] == "http://a.example/1" and storm.story.startswith("storm coast")
    view = latest_vectors(read_vector_log(spark, tmp_dir + "/vec"), DEDUP_NAMESPACE).count()
    assert view == 2


def test_all_duplicates_store_nothing(spark, tmp_dir):
    run(spark, tmp_dir, [[A, B]], 1)
    before = read_articles(spark, tmp_dir + "/art").count()
    assert run(spark, tmp_dir, [[A, B]], 2) == {"total": 2, "duplicates": 2, "stored": 0, "rejected": 0}
    assert read_articles(spark, tmp_dir + "/art").count() == before


def test_first_unique_second_duplicate(spark, tmp_dir):
    run(spark, tmp_dir, [[B]], 1)
    assert run(spark, tmp_dir, [[A, B]], 2) == {"total": 2, "duplicates": 1, "stored": 1, "rejected": 0}
    titles = [r.title for r in read_articles(spark, tmp_dir + "/art").filter("batch_id = 2").collect()]
    assert titles == ["Storm hits coast"]


def test_no_events_stop(spark, tmp_dir):
    assert run(spark, tmp_dir, [[]], 1) == {"total": 0, "duplicates": 0, "stored": 0, "rejected": 0}
    assert read_articles(spark, tmp_dir + "/art").count() == 0


def test_same_event_twice_in_one_batch(spark, tmp_dir):
    # History is fixed for the batch: both copies survive (articles insert both).
    assert run(spark, tmp_dir, [[A, A]], 1) == {"total": 2, "duplicates": 0, "stored": 2, "rejected": 0}
    assert read_articles(spark, tmp_dir + "/art").count() == 2
    assert run(spark, tmp_dir + "/b", [[A, A]], 1, scope="history+batch")["stored"] == 1


def test_rejected_rows_are_counted_and_kept(spark, tmp_dir):
    ts = dt.datetime(2024, 1, 15, 8)
    rows = [(1 << 60, 200, json.dumps({"events": [A, {"title": "no summary"}]}), ts), (2, 200, "no json", ts), (-3, 503, "down", ts),
            (4, 200, r'{"events": [{"title": "\ud83d", "summary": "cut"}]}', ts)]
    df = spark.createDataFrame(rows, RESPONSE_SCHEMA)
    args = (spark, df, corpus(spark), tmp_dir + "/vec", tmp_dir + "/art")
    res = run_pipeline(*args, batch_id=1, run_ts=RUN_TS, quarantine_path=tmp_dir + "/bad")
    assert res.stats.first().asDict() == {"total": 1, "duplicates": 0, "stored": 1, "rejected": 4}
    bad = {(r.response_id, r.event_idx, r.reason) for r in read_quarantine(spark, tmp_dir + "/bad").collect()}
    assert bad == {(1 << 60, 1, "missing_summary"), (2, None, "no_json"), (-3, None, "status_503"), (4, 0, "bad_unicode")}
    with pytest.raises(Exception, match="status|undecodable|contract"):  # whichever is met first
        run_pipeline(*args, batch_id=2, run_ts=RUN_TS, mode="failfast")


def test_search_window_of_one_day(spark, tmp_dir):
    pages = corpus(spark).withColumn("ts", F.when(F.col("page_id") == 1, F.lit("2024-01-14")).otherwise(F.lit("2024-01-15")).cast("timestamp"))
    run_pipeline(spark, answers(spark, [[A, B]]), pages, tmp_dir + "/vec", tmp_dir + "/art", batch_id=1, run_ts=RUN_TS,
                 search_ts_col="ts", search_date="2024-01-15")
    art = {r.title: r.sources for r in read_articles(spark, tmp_dir + "/art").collect()}
    assert art == {A["title"]: [], B["title"]: ["http://b.example/2"]}


def test_retry_without_survivors_removes_the_first_attempt(spark, tmp_dir):
    run(spark, tmp_dir, [[A]], 1)
    assert run(spark, tmp_dir, [[]], 1)["stored"] == 0
    assert read_articles(spark, tmp_dir + "/art").count() == 0 and read_vector_log(spark, tmp_dir + "/vec").count() == 0


def test_event_keys_sort_as_their_parts(spark):
    parts = [(-(1 << 63), 0), (-5, 3), (0, 0), (0, 10), (1, 2), (1, 11), ((1 << 63) - 1, 2**31 - 1)]
    df = spark.createDataFrame(parts, "a long, b int").select("a", "b", event_key(F.col("a"), F.col("b")).alias("k"))
    assert [(r.a, r.b) for r in df.orderBy("k").collect()] == parts


def test_stream_equals_batch(spark, tmp_dir):
    inbox = tmp_dir + "/inbox"
    answers(spark, [[A]], 0).write.parquet(inbox + "/f1")
    answers(spark, [[B]], 1).write.parquet(inbox + "/f2")
    q = stream_pipeline(spark, inbox + "/*", corpus(spark), tmp_dir + "/svec", tmp_dir + "/sart",
                        tmp_dir + "/ckpt", run_ts=RUN_TS)
    q.awaitTermination()
    streamed = sorted((r.title, r.story) for r in read_articles(spark, tmp_dir + "/sart").collect())
    run(spark, tmp_dir + "/batch", [[A], [B]], 1)
    batch = sorted((r.title, r.story) for r in read_articles(spark, tmp_dir + "/batch/art").collect())
    assert streamed == batch


def test_stream_batches_see_earlier_batches_as_history(spark, tmp_dir):
    inbox = tmp_dir + "/inbox2"
    # One file per answer set, so one file per trigger is one answer set per epoch.
    answers(spark, [[A]], 0).coalesce(1).write.parquet(inbox + "/f1")
    answers(spark, [[A, B]], 1).coalesce(1).write.parquet(inbox + "/f2")
    q = stream_pipeline(spark, inbox + "/*", corpus(spark), tmp_dir + "/v2", tmp_dir + "/a2",
                        tmp_dir + "/ckpt2", run_ts=RUN_TS, files_per_trigger=1)
    q.awaitTermination()
    art = read_articles(spark, tmp_dir + "/a2").collect()
    # Epoch 1 stores A; epoch 2 finds A in the history written by epoch 1 and stores only B.
    assert sorted((r.batch_id, r.title) for r in art) == [(1, "Storm hits coast"), (2, "Markets rally")]


def test_a_stream_without_its_checkpoint_does_not_replace_batches(spark, tmp_dir):
    inbox = tmp_dir + "/inbox3"
    answers(spark, [[A]], 0).coalesce(1).write.parquet(inbox + "/f1")
    start = lambda ckpt: stream_pipeline(spark, inbox + "/*", corpus(spark), tmp_dir + "/v3", tmp_dir + "/a3", tmp_dir + ckpt, run_ts=RUN_TS)
    start("/one").awaitTermination()
    with pytest.raises(Exception, match="belongs to run"):
        start("/two").awaitTermination()
    assert [r.title for r in read_articles(spark, tmp_dir + "/a3").collect()] == [A["title"]]
