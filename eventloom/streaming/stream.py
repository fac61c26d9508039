"""The curation flow over a stream of answers (operator 33).

Each micro-batch is one pipeline run against the history as of its start.
Exactly-once comes from three things: the stream checkpoint, one commit per batch that replaces
an earlier attempt of the ``batch_id`` (or folders that are rewritten), and inputs that are a function of the epoch
(history read with ``batch_id < current``, ``run_ts`` fixed or taken from
the batch itself).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.retrieval import build_index
from eventloom.plans.pipeline import run_pipeline
from eventloom.sources.intake import read_responses


def stream_pipeline(
    spark: SparkSession,
    responses_path: str,
    corpus: DataFrame,
    store_path: str | None,
    articles_path: str | None,
    checkpoint_path: str,
    run_ts: str | None = None,
    batch_offset: int = 1,
    files_per_trigger: int | None = None,
    available_now: bool = True,
    fmt: str = "parquet",
    **pipeline_kwargs,
) -> StreamingQuery:
    """Start the stream; ``batch_id = epoch_id + batch_offset``.

    ``run_ts=None`` stamps each batch with its latest answer time, so a
    replayed epoch gets the same stamp; with ``search_ts_col`` it is also the day that
    the batch's search is limited to. ``store`` (a ``SnapshotStore``) takes the place of
    the two paths. ``fmt='json'`` reads lines, malformed ones go to quarantine. Batches belong to the stream's checkpoint:
    a stream with another checkpoint that would replace them is refused (give it a
    ``batch_offset`` beyond them). The corpus is static for the stream,
    so its BM25 index is built once and shared by every micro-batch.
    """
    index = pipeline_kwargs.pop("index", None) or build_index(corpus)
    source = read_responses(spark, responses_path, streaming=True, fmt=fmt, files_per_trigger=files_per_trigger)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        stamp = run_ts
        if stamp is None:
            latest = batch.agg(F.max("ts").cast("string").alias("t")).first()["t"]
            stamp = latest or "1970-01-01 00:00:00"
        run_pipeline(
            batch.sparkSession, batch, corpus, store_path, articles_path,
            batch_id=epoch_id + batch_offset, run_ts=stamp, index=index, run_id=checkpoint_path, **pipeline_kwargs,
        )

    writer = source.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
