"""What finished steps leave on disk."""

import os

from pyspark.sql import functions as F

from eventloom.operators.retrieval import build_index
from eventloom.session import ensure_checkpoint_dir, ensure_engine_conf


def _left(spark, name):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(root) if f.startswith(name)}


def test_the_index_keeps_its_blocks_only(spark):
    corpus = spark.createDataFrame([(i, f"word{i % 7} more{i % 3} text") for i in range(50)], "page_id long, content string")
    before = _left(spark, "page-terms")
    index = build_index(corpus)
    assert _left(spark, "page-terms") == before
    assert index.n_pages == 50 and index.postings.count() == 150
    index.release()


def _shuffle_bytes(root):
    return sum(os.path.getsize(os.path.join(r, f)) for r, _, fs in os.walk(root) for f in fs if f.startswith("shuffle_") and f.endswith(".data"))


def test_shuffle_files_go_with_their_job(spark, tmp_path):
    ensure_engine_conf(spark)
    root = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    before = _shuffle_bytes(root)
    df = spark.range(0, 200_000, 1, 8).groupBy((F.col("id") * 7919 % 100_000).alias("k")).agg(F.sum("id").alias("s"))
    df.write.parquet(str(tmp_path / "out"))
    assert _shuffle_bytes(root) - before < 100_000  # it shuffles over a megabyte
    # A table can be read again after its files went.
    assert len(df.collect()) == len(df.collect()) == 100_000


def _records(spark, rows):
    """``(namespace, id, event_id, title, ord)`` as records of the store."""
    df = spark.createDataFrame(rows, "namespace string, id string, event_id string, title string, ord string")
    return df.select("namespace", "id", F.array(F.length("title").cast("double")).alias("vector"), "event_id", "title", F.lit(None).cast("string").alias("summary"),
                     F.lit(None).cast("int").alias("chunk_index"), F.lit(None).cast("array<string>").alias("sources"), F.lit(None).cast("string").alias("text"), "ord")


def test_vectors_of_a_batch_are_shuffled_once(spark, tmp_path, monkeypatch):
    """One exchange carries vectors; ids in several buckets, without an order or with very many rows end as before."""
    from eventloom.operators import snapshots

    plain = [("n", f"e{i % 40}", f"e{i % 40}", f"t{i}", f"{i:05d}") for i in range(200)]
    moved = plain + [("n", "e1", "elsewhere", "moved", "90000"), ("n", "e2", "elsewhere", "early", "00000")]
    unordered = plain + [("n", "x", "x", "no order", None), ("n", "e3", "e3", "no order either", None)]
    monkeypatch.setattr(snapshots, "MANY_ROWS", 30)
    hot = plain + [("n", "h", "h", f"h{i}", f"{i:05d}") for i in range(100)]
    plans = []
    write = spark.range(0).write.__class__.parquet

    def seen(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return write(self, path, *args, **kwargs)

    for case, rows in (("plain", plain), ("moved", moved), ("unordered", unordered), ("hot", hot)):
        store = snapshots.SnapshotStore(spark, str(tmp_path / case), buckets=4)
        plans.clear()
        with monkeypatch.context() as patched:
            patched.setattr(spark.range(0).write.__class__, "parquet", seen)
            store.commit(1, _records(spark, rows))
        want = {}
        for _, i, event, title, order in rows:
            if order is not None and order > want.get(i, ("",))[0]:
                want[i] = (order, event, title)
            want.setdefault(i, ("",))
        got = {r.id: (r.ord or "", *((r.event_id, r.title) if r.ord else ())) for r in store.vectors().collect()}
        assert got == want
        if case == "plain":
            assert plans[0].count("Exchange hashpartitioning") == 1


def test_a_run_leaves_no_scratch_and_caches_nothing(spark):
    """Steps of a run are written and removed; nothing persisted holds shuffle files until the end."""
    from eventloom.plans import catalog

    ensure_engine_conf(spark)
    names = ("decoded", "events", "flagged", "enriched")
    spark.catalog.clearCache()
    cached, before = [], _left(spark, names)
    keep = type(spark.range(0)).persist
    try:
        type(spark.range(0)).persist = lambda self, *a: cached.append(self) or keep(self, *a)
        assert catalog.q_run_pipeline(spark, "/root/testdata/sf0.001").count() > 0
    finally:
        type(spark.range(0)).persist = keep
    assert not cached and _left(spark, names) == before
