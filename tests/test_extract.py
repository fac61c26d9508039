"""Answer intake and structured extraction (operators 1, 2, 9-12)."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.extract import (
    NoJson, answer_candidates, build_events, contract_report, contract_split, decode_first, decode_paths, decode_responses, extract_events, read_by_python,
)
from eventloom.sources.intake import RESPONSE_SCHEMA, day_window, read_responses, split_by_status

TWO_EVENTS = {"events": [{"title": "Event 1", "summary": "Summary 1"}, {"title": "Event 2", "summary": "Summary 2"}]}
FENCED = "<think>\nreasoning\n</think>\n```json\n" + json.dumps(TWO_EVENTS, indent=2) + "\n```"


def answers(spark, rows):
    ts = dt.datetime(2024, 1, 15, 12)
    return spark.createDataFrame([(i, st, c, ts) for i, (st, c) in enumerate(rows)], RESPONSE_SCHEMA)


def test_decode_variants(spark):
    cases = [
        (FENCED, TWO_EVENTS),
        ("Here you go:\n```json\n{\"a\": 1}\n```\nbye", {"a": 1}),
        ("Sure! {\"a\": [1, 2]} trailing {junk", {"a": [1, 2]}),
        ("[1, 2]", [1, 2]),
        ("```JSON\n{\"x\": -Infinity}\n```", {"x": float("-inf")}),
        ("x ```json\n[1] and more ]\n``` y", [1]),  # the block does not parse: its longest prefix does
        ("There is no JSON here at all.", NoJson),
        ("{broken", NoJson),
        (None, NoJson),
    ]
    found = answer_candidates(answers(spark, [(200, c) for c, _ in cases])).orderBy("response_id").collect()
    for row, (text, want) in zip(found, cases):
        if want is NoJson:
            with pytest.raises(NoJson):
                decode_first(row.whole, row.fenced, row.tail)
        else:
            assert decode_first(row.whole, row.fenced, row.tail) == want, text


def test_cut_emoji_is_quarantined_not_fatal(spark):
    df = answers(spark, [(200, r'{"events": [{"title": "cut \ud83d", "summary": "s"}, {"title": "ok \ud83d\ude00", "summary": "s"}]}')])
    events, quarantine = extract_events(df)
    assert [r.title for r in events.collect()] == ["ok \U0001F600"]
    assert [(r.event_idx, r.reason) for r in quarantine.collect()] == [(0, "bad_unicode")]
    with pytest.raises(Exception, match="bad_unicode"):
        extract_events(df, mode="failfast")[0].collect()


def test_plain_answers_are_read_as_python_reads_them(spark):
    """Answers glued from pieces that JSON readers disagree on: the path inside the JVM and Python alone give the same rows."""
    rng = random.Random(7)
    values = ['"a"', '"\\u00e9 \\n \\"q\\""', r'"\ud83d"', r'"\ud83d\ude00"', r'"\u0000"', '"tab\t"', "1", "01", "1e999", "-0.5", "null", "true", "NaN", "[1,]", "[]", "{}", '{"x": [{"y": null}]}', '"' + "z" * 500 + '"', "9" * 1200]

    def item():
        pick = rng.sample if rng.random() < 0.9 else rng.choices  # the latter repeats keys
        keys = pick(["title", "summary", "extra"], k=rng.randint(0, 3))
        return rng.choice(values) if rng.random() < 0.04 else "{" + ", ".join(f'"{k}": {rng.choice(values[:2] if rng.random() < 0.93 else values)}' for k in keys) + "}"

    def body():
        items = "[" + ", ".join(item() for _ in range(rng.randint(0, 4))) + "]"
        return rng.choice([items, '{"events": ' + items + "}", '{"events": ' + rng.choice(values) + "}", '{"events": ' + items + ', "n": 1}', '{"other": 1}'])

    around = ["", "Here: ", "true", "null ", '"', "5 ", "- ", "[x] ", "{", "\n```json\n", "```\n", "\n```", " bye [1]", "</think>", "<think>x</think>", "}", "\u00a0", "\ufeff"]
    cases = ["", None, "nothing"] + [rng.choice(around) + rng.choice(["", *around]) + body() + rng.choice(["", *around]) for _ in range(3000)]
    cases += ["```json\n" + body() + "\n```" for _ in range(300)] + [body() for _ in range(300)] + ["[" * n + "]" * n for n in (10, 900, 1100)]
    df = answers(spark, [(200, c) for c in cases])
    want = read_by_python(answer_candidates(df), F.lit(True)).select("response_id", F.inline("entries"))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(decode_responses(df).collect(), key=key) == sorted(want.collect(), key=key)
    paths = decode_paths(df).first()
    assert paths.n_answers == len(cases) and 0 < paths.n_python < 0.8 * len(cases)


def test_only_answers_that_are_not_plain_reach_python(spark):
    plain = [FENCED, json.dumps(TWO_EVENTS), "Sure: " + json.dumps(TWO_EVENTS["events"]) + " done", '{"events": []}']
    other = ["none", '{"events": null}', '{"events": [1]}', '{"events": [{"title": NaN}]}', '{"events": [], "events": []}', "5 []", None]
    paths = decode_paths(answers(spark, [(200, c) for c in plain + other])).first()
    assert (paths.n_answers, paths.n_python) == (len(plain) + len(other), len(other))


def test_extract_two_events_in_order(spark):
    ok, _ = split_by_status(answers(spark, [(200, FENCED)]))
    events, quarantine = extract_events(ok)
    rows = events.orderBy("event_idx").collect()
    assert [(r.event_idx, r.title, r.summary) for r in rows] == [(0, "Event 1", "Summary 1"), (1, "Event 2", "Summary 2")]
    assert quarantine.count() == 0


def test_status_split_and_failfast(spark):
    df = answers(spark, [(200, FENCED), (400, "Bad request"), (None, "x")])
    ok, rejected = split_by_status(df)
    assert ok.count() == 1
    assert sorted(r.reason for r in rejected.collect()) == ["status_400", "status_null"]
    guarded, _ = split_by_status(df, mode="failfast")
    with pytest.raises(Exception, match="status"):
        guarded.collect()


def test_quarantine_reasons(spark):
    df = answers(spark, [
        (200, "No JSON at all."),
        (200, "5"),
        (200, '{"events": "none"}'),
        (200, '{"events": [1, {"title": "t"}, {"title": 2, "summary": "s"}, {"title": "ok", "summary": "s"}]}'),
        (200, '{"results": []}'),
        (200, '[{"title": "list", "summary": "top level", "extra": 1}]'),
    ])
    events, quarantine = extract_events(df)
    reasons = sorted((r.response_id, r.reason) for r in quarantine.collect())
    assert reasons == [(0, "no_json"), (1, "not_object_or_list"), (2, "events_not_array"),
                       (3, "field_not_string"), (3, "item_not_object")]
    valid, rejected = contract_split(events)
    assert sorted((r.response_id, r.title) for r in valid.collect()) == [(3, "ok"), (5, "list")]
    assert [r.reason for r in rejected.collect()] == ["missing_summary"]
    with pytest.raises(Exception, match="contract"):
        contract_split(events, mode="failfast")[0].collect()


def test_contract_report_counts_breaches(spark):
    items = [{"title": "T" * 95, "summary": "s" * 600}] + [{"title": "t", "summary": "s"}] * 6
    events, _ = extract_events(answers(spark, [(200, json.dumps({"events": items}))]))
    r = contract_report(events).first()
    assert (r.n_events, r.n_over_requested, r.n_long_titles, r.n_long_summaries) == (7, 2, 1, 1)


def test_build_events_cleans_summary_only(spark):
    payload = {"events": [{"title": "**Big** news [1]", "summary": "## Head\n- **bold** fact [1] [Reuters]"}]}
    events, _ = extract_events(answers(spark, [(200, json.dumps(payload))]))
    valid, _ = contract_split(events)
    row = build_events(valid, "2024-01-15 00:00:00").first()
    assert row.title == "**Big** news [1]"
    assert row.summary == "Head\nbold fact"
    assert row.story == "" and row.sources == []
    assert row.event_id.startswith("event_") and len(row.event_id) == 22
    assert row.date == dt.datetime(2024, 1, 15)


def test_read_responses_roundtrip_and_stream_schema(spark, tmp_dir):
    answers(spark, [(200, FENCED)]).write.parquet(tmp_dir)
    assert read_responses(spark, tmp_dir).schema == RESPONSE_SCHEMA
    assert read_responses(spark, tmp_dir, streaming=True).isStreaming


def test_day_window_half_open(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 14, 23, 59, 59)), (2, dt.datetime(2024, 1, 15)), (3, dt.datetime(2024, 1, 15, 23, 59)),
         (4, dt.datetime(2024, 1, 16))], "id int, ts timestamp_ntz")
    assert sorted(r.id for r in day_window(df, "ts", "2024-01-15").collect()) == [2, 3]
    assert sorted(r.id for r in day_window(df, "ts", "2024-01-15", days=2).collect()) == [1, 2, 3]
    plan = day_window(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts", "2024-01-15")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan._jdf.queryExecution().executedPlan().toString()
