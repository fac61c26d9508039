"""The whole curation flow as one batch job, and its run statistics (31-32).

    responses -> status split -> decode (written) -> contract -> build -> embed (written)
      -> flag vs history fixed at batch start (written) -> survivors
      -> queries -> BM25 top-k -> enrich (written) -> vector log + articles
      -> stats

Written steps are scratch tables, removed as soon as the next one is written. What Spark
persists would keep the shuffle files that it came from until the end of the run, and lie on
disk uncompressed where memory does not hold it.

The reference deduplicates before it enriches, so enrichment (the costly
step) only runs for survivors; the plan keeps that order. History is the
latest-wins view *before* this batch, so a retried batch sees the same input.
Sinks are a ``SnapshotStore``, which commits all of them at once, or plain
folders, whose partitions a retry rewrites one after the other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.ids import event_key
from eventloom.operators.extract import build_events, contract_split, decode_responses, split_decoded
from eventloom.operators.retrieval import EXCERPT_MAX_CHARS, BM25Index, build_queries, enrich_events, retrieve_topk
from eventloom.operators.similarity import SIMILARITY_THRESHOLD, DEDUP_TOP_K, flag_duplicates
from eventloom.operators.snapshots import SnapshotStore
from eventloom.operators.stores import (
    DEDUP_NAMESPACE,
    append_articles,
    chunk_vectors,
    claim_batch,
    clear_batch,
    latest_vectors,
    overview_vectors,
    read_vector_log,
    upsert_vectors,
)
from eventloom.operators.vectors import DEFAULT_DIM, embed_table, overview_text
from eventloom.sources.intake import split_by_status, split_malformed
from eventloom.sources.tables import discard, staged


@dataclass
class PipelineRun:
    stats: DataFrame  # one row: total, duplicates, stored, rejected
    store_path: str | None
    articles_path: str | None
    batch_id: int
    quarantine_path: str | None = None
    store: SnapshotStore | None = None


def event_batch(
    responses: DataFrame, run_ts: str, dim: int = DEFAULT_DIM, embedder=None, mode: str = "quarantine"
) -> dict[str, DataFrame]:
    """Responses -> embedded events of one batch, plus every rejected row.

    ``decoded`` is written: events and quarantine both come from it, and the
    caller discards it. ``mode='failfast'`` aborts on the first bad row instead.
    """
    responses, malformed = split_malformed(responses, mode)
    ok, rejected = split_by_status(responses, mode)
    if mode == "failfast":
        rejected = rejected.withColumn("reason", F.lit(None).cast("string"))
    decoded = staged(decode_responses(ok), "decoded")
    raw, undecodable = split_decoded(decoded, mode)
    valid, broken = contract_split(raw, mode)
    if mode == "failfast":
        broken = broken.withColumn("reason", F.lit(None).cast("string"))
    built = build_events(valid, run_ts).withColumn("ord", event_key(F.col("response_id"), F.col("event_idx")))
    embedded = embed_table(
        built.withColumn("_overview", overview_text(F.col("title"), F.col("summary"))),
        "ord", "_overview", dim=dim, embedder=embedder,
    ).drop("_overview")
    quarantine = (
        rejected.unionByName(malformed).select("response_id", F.lit(None).cast("int").alias("event_idx"), "reason")
        .unionByName(undecodable)
        .unionByName(broken.select("response_id", "event_idx", "reason"))
    )
    return {"events": embedded, "quarantine": quarantine, "decoded": decoded}


def flag_batch(
    events: DataFrame,
    history: DataFrame,
    threshold: float = SIMILARITY_THRESHOLD,
    scope: str = "history",
    dim: int | None = None,
) -> DataFrame:
    """Events with ``is_duplicate``, ``best_score``, ``best_match_id``."""
    flagged = flag_duplicates(
        events, history.select(F.col("id").alias("match_id"), F.col("vector").alias("hvec")),
        threshold, DEDUP_TOP_K, probe_id="ord", hist_id="match_id", vec_col="vector", hist_vec_col="hvec", dim=dim,
    )
    if scope == "history+batch":
        batch = events.select(F.col("ord").alias("b_ord"), F.col("vector").alias("bvec"))
        within = flag_duplicates(
            events.select("ord", "vector"), batch, threshold, DEDUP_TOP_K,
            probe_id="ord", hist_id="b_ord", vec_col="vector", hist_vec_col="bvec",
            probe_ord="ord", hist_ord="b_ord", dim=dim,
        ).select("ord", F.col("is_duplicate").alias("_in_batch"))
        flagged = flagged.join(within, "ord", "left").withColumn(
            "is_duplicate", F.col("is_duplicate") | F.coalesce(F.col("_in_batch"), F.lit(False))
        ).drop("_in_batch")
    elif scope != "history":
        raise ValueError(f"unknown scope {scope!r}")
    return flagged


def pipeline_stats(flagged: DataFrame) -> DataFrame:
    """One row: total events, duplicates, stored (= total - duplicates)."""
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_duplicate")).alias("duplicates"),
        F.count_if(~F.col("is_duplicate")).alias("stored"),
    )


def run_pipeline(
    spark: SparkSession,
    responses: DataFrame,
    corpus: DataFrame,
    store_path: str | None,
    articles_path: str | None,
    batch_id: int,
    run_ts: str,
    supplied_queries: DataFrame | None = None,
    articles: DataFrame | None = None,
    dim: int = DEFAULT_DIM,
    embedder=None,
    threshold: float = SIMILARITY_THRESHOLD,
    scope: str = "history",
    index: BM25Index | None = None,
    quarantine_path: str | None = None,
    mode: str = "quarantine",
    search_ts_col: str | None = None,
    search_date=None,
    excerpt_chars: int | None = EXCERPT_MAX_CHARS,
    run_id: str | None = None,
    store: SnapshotStore | None = None,
) -> PipelineRun:
    """Run one batch end to end; returns the statistics of the run.

    With ``store`` vectors, articles and quarantine become visible together, by one
    commit at the end, and the paths are not used.

    No event is stored when none survives (the reference's early exit); what an
    earlier attempt of the batch stored is removed. Rejected rows are counted,
    and written to ``quarantine_path`` (by batch) if it is given; with
    ``mode='failfast'`` the first one aborts the run. ``search_ts_col`` and
    ``search_date`` limit the search to that day's pages; without a date that is the day
    of ``run_ts``. ``index``
    (``build_index(corpus)``) can be shared by many batches; if not given it is
    built for this batch and released at the end. With ``run_id`` the batch is
    claimed for that run, and a batch of another run is refused.
    """
    if store is not None:
        store.check_owner(batch_id, run_id)
    elif run_id is not None:
        claim_batch(spark, store_path, batch_id, run_id)
    if search_ts_col is not None and search_date is None:
        search_date = run_ts[:10]
    batch = event_batch(responses, run_ts, dim, embedder, mode)
    scratch = [batch["decoded"]]

    def written(df: DataFrame, name: str) -> DataFrame:
        scratch.append(staged(df, name))
        return scratch[-1]

    if store is not None:
        history = store.vectors(DEDUP_NAMESPACE, before_batch=batch_id, columns=["vector"])
    else:
        history = latest_vectors(read_vector_log(spark, store_path), DEDUP_NAMESPACE, before_batch=batch_id, columns=["vector"])
    try:
        events = written(batch["events"], "events")
        flagged = written(flag_batch(events, history, threshold, scope, dim=None if embedder else dim), "flagged")
        discard(events)
        counts = pipeline_stats(flagged).first().asDict()
        quarantine = batch["quarantine"].withColumn("batch_id", F.lit(batch_id).cast("long"))
        if store is not None:
            quarantine = staged(quarantine, "quarantine")  # counted and committed
        elif quarantine_path:
            clear_batch(spark, quarantine_path, batch_id)
            quarantine.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(quarantine_path)
            quarantine = read_quarantine(spark, quarantine_path).filter(F.col("batch_id") == batch_id)
        counts["rejected"] = quarantine.count()
        discard(batch["decoded"])
        stats = spark.createDataFrame([counts], "total long, duplicates long, stored long, rejected long")
        if counts["stored"]:
            survivors = flagged.filter(~F.col("is_duplicate")).drop("is_duplicate", "best_score", "best_match_id")
            queries = build_queries(survivors, supplied_queries)
            results = retrieve_topk(queries, corpus, ts_col=search_ts_col, run_date=search_date, index=index)
            enriched = written(enrich_events(survivors, results, articles, excerpt_chars), "enriched")
            discard(flagged)
            records = overview_vectors(enriched).unionByName(chunk_vectors(enriched, dim=dim, embedder=embedder))
            if store is not None:
                store.commit(batch_id, records, enriched, quarantine, run_id)
            else:
                upsert_vectors(records, store_path, batch_id)
                append_articles(enriched, articles_path, batch_id)
        elif store is not None:
            store.commit(batch_id, quarantine=quarantine, run_id=run_id)
        else:
            clear_batch(spark, store_path, batch_id)
            clear_batch(spark, articles_path, batch_id)
    finally:
        for table in scratch:
            discard(table)
    return PipelineRun(stats, store_path, articles_path, batch_id, quarantine_path, store)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``(response_id, event_idx, reason, batch_id)`` of the rows that runs rejected."""
    schema = "response_id long, event_idx int, reason string, batch_id long"
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as exc:  # noqa: BLE001 - only "path does not exist" is expected
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], schema)
