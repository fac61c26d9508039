"""The pipeline's stages against brute force on a small table, and its place in the entry."""

import re
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
from eventloom.llm.common import prepare, table
from eventloom.llm.quality import quality_scores

from .helpers import SF, docs_df, odd_texts, rows_of
from .test_counts_mixing_packing import check_packing, water
from .test_ngram_join import brute as near_brute

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_every_stage_on_its_input(spark):
    prepare(spark)
    docs = table(spark, SF, "documents").cache()
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    kept = stages["quality"](spark, docs, SF).cache()
    scores = {r["doc_id"]: r["predicted"] for r in rows_of(quality_scores(docs, table(spark, SF, "labels")))}
    assert kept.columns == columns and {r["doc_id"] for r in kept.collect()} == {i for i, p in scores.items() if p}

    once = stages["exact_duplicates"](spark, kept, SF).cache()
    last = {}
    for r in kept.collect():
        last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", -1))
    assert once.columns == columns and sorted(r["doc_id"] for r in once.collect()) == sorted(last.values())

    apart = stages["near_duplicates"](spark, once, SF).cache()
    rows = once.collect()
    want = [i for i, _, c in near_brute([r["doc_id"] for r in rows], [r["text"] for r in rows], 5, 80) if i == c]
    assert apart.columns == columns and sorted(r["doc_id"] for r in apart.collect()) == want

    mixed = stages["mixture"](spark, apart, SF).cache()
    words, sizes, taken = {}, Counter(), Counter()
    for r in apart.collect():
        words[r["doc_id"]] = len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += words[r["doc_id"]]
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns and set(times.values()) <= {1, 2}
    for r in apart.collect():
        taken[r["source"]] += times[r["doc_id"]] * words[r["doc_id"]]
    target = water(sizes)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 0.05 * target[s] + 50

    packed = rows_of(stages["packing"](spark, mixed, SF))
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == times
    assert check_packing(packed, 4096) <= 1.02 * sum(r["length"] for r in packed) / 4096 + 1


def test_run_is_the_stages_and_is_registered(spark):
    rows = rows_of(entry.queries()["pipeline"](spark, SF))
    by = defaultdict(int)
    for r in rows:
        by[r["doc_id"]] += r["length"]
    assert rows and min(by.values()) > 1
    check_packing(rows, 4096)
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in entry.queries()) == 1


def test_odd_rows_pass_through_every_stage(spark):
    texts = odd_texts() + ["very long " * 30000]
    docs = docs_df(spark, texts, [None if i % 7 == 0 else f"s{i % 3}" for i in range(len(texts))], ids=[None if i == 5 else i % 30 for i in range(len(texts))])
    for name, apply in corpus_pipeline.STAGES:
        rows = apply(spark, docs, SF)
        empty = apply(spark, docs.limit(0), SF)
        assert empty.count() == 0
        if name != "packing":
            assert rows.columns == docs.columns and empty.columns == docs.columns
            assert 0 < rows.count() <= (2 if name == "mixture" else 1) * len(texts)


def test_any_column_names_pass_through_every_stage(spark):
    from pyspark.sql import functions as F

    names = ["times", "copy", "taken", "doc", "__row", "__word", "__hit", "__s", "__copy", "row", "id", "digest", "group", "lowest", "component"]
    docs = docs_df(spark, [t for t in odd_texts()])
    for name in names:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs = docs.withColumn("a.b", F.lit(1))
    prepare(spark)
    for name, apply in corpus_pipeline.STAGES[:-1]:
        out = apply(spark, docs, SF)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names) and r["a.b"] == 1
    assert apply(spark, docs, SF).count() > 0


def test_settings_of_the_caller_come_back(spark):
    from eventloom.session import ensure_engine_conf

    ensure_engine_conf(spark)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    prepare(spark)
    prepare(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "1024"
    ensure_engine_conf(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
