"""Chunk records, vector log + latest-wins view, compaction, articles (26-30)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators.stores import (
    append_articles,
    chunk_vectors,
    claim_batch,
    compact_vectors,
    latest_vectors,
    overview_vectors,
    read_articles,
    read_vector_log,
    upsert_vectors,
)
from eventloom.operators.vectors import embed_table


def events(spark, rows):
    df = spark.createDataFrame(
        [(eid, dt.datetime(2024, 1, 15), t, s, story, src, o) for eid, t, s, story, src, o in rows],
        "event_id string, date timestamp, title string, summary string, story string, sources array<string>, ord long")
    return embed_table(df.withColumn("_o", F.concat("title", F.lit(" "), "summary")), "ord", "_o", dim=16).drop("_o")


def records(ev):
    return overview_vectors(ev).unionByName(chunk_vectors(ev, dim=16, n=3))


def test_records_with_and_without_story(spark):
    ev = events(spark, [("e1", "T", "S", "a b c d e", ["u1", "u2"], 1), ("e2", "T2", "S2", "", [], 2)])
    rec = {(r.namespace, r.id): r for r in records(ev).collect()}
    assert set(rec) == {("deduplication", "e1"), ("deduplication", "e2"), ("research", "e1_chunk_0"),
                        ("research", "e1_chunk_1")}
    assert rec[("research", "e1_chunk_1")].text == "d e"
    assert rec[("research", "e1_chunk_0")].sources == ["u1", "u2"]
    assert rec[("deduplication", "e1")].summary == "S"


def test_latest_wins_stale_chunks_and_compaction(spark, tmp_dir):
    path = tmp_dir + "/vectors"
    long_story = events(spark, [("e1", "T", "S1", "a b c d e f g", [], 1)])
    upsert_vectors(records(long_story), path, 1)
    short_story = events(spark, [("e1", "T", "S2", "x y", [], 1), ("e1", "T", "S3", "", [], 2)])
    upsert_vectors(records(short_story), path, 2)
    log = read_vector_log(spark, path)
    view = {(r.namespace, r.id): r for r in latest_vectors(log).collect()}
    assert view[("deduplication", "e1")].summary == "S3"  # same batch: higher ord wins
    assert view[("research", "e1_chunk_0")].text == "x y" and view[("research", "e1_chunk_0")].version == 2
    assert view[("research", "e1_chunk_2")].version == 1  # stale chunk kept, as the reference does
    # The newest store of e1 (ord 2 of batch 2) has no story, so no chunk is current, seen from either namespace.
    assert {r.id for r in latest_vectors(log, prune_stale=True).collect()} == {"e1"}
    assert latest_vectors(log, "research", prune_stale=True).count() == 0
    assert {r.id for r in latest_vectors(log, "research", before_batch=2, prune_stale=True).collect()} == {"e1_chunk_0", "e1_chunk_1", "e1_chunk_2"}
    assert latest_vectors(log, "deduplication", columns=["vector"]).columns == ["namespace", "id", "vector"]
    as_of_2 = {r.id: r.summary for r in latest_vectors(log, "deduplication", before_batch=2).collect()}
    assert as_of_2 == {"e1": "S1"}
    compacted = compact_vectors(spark, path, tmp_dir + "/compact")
    cols = ["namespace", "id", "version", "summary", "text", "vector"]
    assert len(read_vector_log(spark, tmp_dir + "/compact").inputFiles()) <= len(log.inputFiles())
    assert sorted(compacted.select(*cols).collect()) == sorted(latest_vectors(log).select(*cols).collect())


def test_retried_batch_is_idempotent(spark, tmp_dir):
    path = tmp_dir + "/vectors"
    ev = events(spark, [("e1", "T", "S", "a b c d", [], 1)])
    for _ in range(2):
        upsert_vectors(records(ev), path, 5)
    assert read_vector_log(spark, path).count() == 3


def test_retry_with_less_leaves_nothing_behind(spark, tmp_dir):
    path = tmp_dir + "/vectors"
    upsert_vectors(records(events(spark, [("e1", "T", "S", "a b c d", [], 1)])), path, 5)
    upsert_vectors(records(events(spark, [("e1", "T", "S", "", [], 1)])), path, 5)
    assert [r.namespace for r in read_vector_log(spark, path).collect()] == ["deduplication"]


def test_compaction_of_many_batches_has_fewer_files(spark, tmp_dir):
    path = tmp_dir + "/vectors"
    for b in range(1, 6):
        upsert_vectors(records(events(spark, [(f"e{b}", "T", "S", "a b c d", [], 1), ("same", "T", f"S{b}", "x", [], 2)])), path, b)
    before = read_vector_log(spark, path)
    compact_vectors(spark, path, tmp_dir + "/compact")
    after = read_vector_log(spark, tmp_dir + "/compact")
    assert len(after.inputFiles()) < len(before.inputFiles())
    assert {(r.id, r.version) for r in after.collect()} == {(r.id, r.version) for r in latest_vectors(before).collect()}
    assert {r.batch_id for r in after.select("batch_id").distinct().collect()} == {5}


def test_batch_of_another_run_is_refused(spark, tmp_dir):
    claim_batch(spark, tmp_dir + "/vectors", 1, "run-a")
    claim_batch(spark, tmp_dir + "/vectors", 1, "run-a")
    claim_batch(spark, tmp_dir + "/vectors", 2, "run-b")
    with pytest.raises(ValueError, match="belongs to run"):
        claim_batch(spark, tmp_dir + "/vectors", 1, "run-b")


def test_articles_insert_not_upsert(spark, tmp_dir):
    path = tmp_dir + "/articles"
    ev = events(spark, [("e1", "Same", "S1", "", [], 1), ("e1", "Same", "S2", "", [], 2)])
    append_articles(ev, path, 1)
    append_articles(ev, path, 1)  # retry of batch 1 replaces itself
    append_articles(ev, path, 2)
    art = read_articles(spark, path)
    assert art.count() == 4
    assert art.filter("batch_id = 1").count() == 2
    assert read_articles(spark, tmp_dir + "/missing").count() == 0
