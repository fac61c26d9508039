"""Chunking, vector/article sinks and the latest-wins view (operators 25-30).

The reference writes to a hosted vector index (upsert by id, last write wins)
and inserts documents into a collection. Here both are Parquet folders on
shared storage:

* ``vectors``: an append-only log partitioned by ``namespace, batch_id``.
  Each batch is written with dynamic partition overwrite, so a retried
  micro-batch replaces exactly its own partitions (idempotent). Readers use
  ``latest_vectors``: one row per ``(namespace, id)``, highest
  ``(version, ord)``, computed with ``max_by`` over the columns asked for. That
  is a partial aggregate, so a hot id never lands in one task as raw rows.
* ``articles``: insert-only, partitioned by ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.ids import chunk_id
from eventloom.functions.text import words
from eventloom.operators.vectors import DEFAULT_DIM, embed_table

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour)
# ---------------------------------------------------------------------------
CHUNK_WORDS = 300
DEDUP_NAMESPACE = "deduplication"
RESEARCH_NAMESPACE = "research"
# ---------------------------------------------------------------------------

VECTOR_COLUMNS = ["namespace", "id", "vector", "event_id", "title", "summary", "chunk_index", "sources", "text"]

VECTOR_LOG_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.DoubleType())),
        T.StructField("event_id", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("chunk_index", T.IntegerType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
        T.StructField("text", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("ord", T.StringType()),
        T.StructField("namespace", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def chunk_table(df: DataFrame, id_col: str, text_col: str, n: int = CHUNK_WORDS) -> DataFrame:
    """``(id, chunk_index, chunk)``: slices of <= n words rejoined with one space.

    Empty or blank text gives no rows. Narrow: no shuffle, any text length.
    """
    staged = df.select(F.col(id_col), words(F.col(text_col)).alias("_toks"))
    return staged.select(F.col(id_col), F.posexplode(_chunk_array(F.col("_toks"), n)).alias("chunk_index", "chunk"))


def overview_vectors(events: DataFrame, vec_col: str = "vector") -> DataFrame:
    """One ``deduplication`` record per event: id, vector, event_id, title, summary."""
    return events.select(
        F.lit(DEDUP_NAMESPACE).alias("namespace"),
        F.col("event_id").alias("id"),
        F.col(vec_col).alias("vector"),
        "event_id",
        "title",
        "summary",
        F.lit(None).cast("int").alias("chunk_index"),
        F.lit(None).cast("array<string>").alias("sources"),
        F.lit(None).cast("string").alias("text"),
        F.col("ord").cast("string").alias("ord"),
    )


def chunk_vectors(events: DataFrame, dim: int = DEFAULT_DIM, embedder=None, n: int = CHUNK_WORDS) -> DataFrame:
    """``research`` records: story chunks with their own vectors; no story, no rows."""
    with_story = events.filter(F.col("story").isNotNull() & (F.col("story") != F.lit("")))
    # One chunk row per event row: the owning row's order, then chunk order.
    keyed = with_story.select("event_id", "title", "sources", "ord", words(F.col("story")).alias("_toks")).select(
        "event_id", "title", "sources", "ord", F.posexplode(_chunk_array(F.col("_toks"), n)).alias("chunk_index", "chunk")
    )
    embedded = embed_table(keyed, "event_id", "chunk", dim=dim, embedder=embedder)
    return embedded.select(
        F.lit(RESEARCH_NAMESPACE).alias("namespace"),
        chunk_id(F.col("event_id"), F.col("chunk_index")).alias("id"),
        "vector",
        "event_id",
        "title",
        F.lit(None).cast("string").alias("summary"),
        F.col("chunk_index").cast("int").alias("chunk_index"),
        "sources",
        F.col("chunk").alias("text"),
        # Chunk ids already carry the index; equal ids only come from events
        # sharing a title, and the later event (higher ord) wins.
        F.col("ord").cast("string").alias("ord"),
    )


def _chunk_array(toks, n: int):
    """Array of <= n-word slices of a staged word array, rejoined with one space."""
    n_chunks = F.ceil(F.size(toks) / F.lit(n)).cast("int")
    return F.when(
        F.size(toks) > 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n_chunks - 1, F.lit(0))),
            lambda i: F.array_join(F.slice(toks, i * n + 1, F.lit(n)), " "),
        ),
    ).otherwise(F.array().cast("array<string>"))


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def clear_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Remove all that an earlier attempt of a batch wrote below ``path``.

    Dynamic overwrite alone replaces only the partitions that the new attempt
    writes too; one that has fewer (no story, no survivor) would leave the rest.
    """
    fs, root = _file_system(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path
    for depth in (f"batch_id={batch_id}", f"*/batch_id={batch_id}"):
        for found in fs.globStatus(pattern(root, depth)) or []:
            fs.delete(found.getPath(), True)


def claim_batch(spark: SparkSession, store_path: str, batch_id: int, run_id: str) -> None:
    """Record that ``run_id`` owns a batch; a batch of another owner is refused.

    A stream that lost its checkpoint counts its epochs from 0 again, and must
    not replace the batches of the stream that filled the store.
    """
    path = store_path.rstrip("/") + "-owners"
    fs, root = _file_system(spark, path)
    mark = spark._jvm.org.apache.hadoop.fs.Path(root, f"batch_id={batch_id}")
    if fs.exists(mark):
        owner = spark.read.schema("run_id string, batch_id long").parquet(path).filter(F.col("batch_id") == batch_id).first()
        if owner is not None and owner["run_id"] != run_id:
            raise ValueError(f"batch {batch_id} of {store_path} belongs to run {owner['run_id']!r}, not {run_id!r}")
    row = spark.createDataFrame([(run_id, batch_id)], "run_id string, batch_id long").coalesce(1)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def upsert_vectors(records: DataFrame, path: str, batch_id: int) -> None:
    """Write one batch of the vector log; a retry replaces all that the batch wrote before."""
    clear_batch(records.sparkSession, path, batch_id)
    (
        records.select(*VECTOR_COLUMNS, "ord")
        .withColumn("version", F.lit(batch_id).cast("long"))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .select(*[f.name for f in VECTOR_LOG_SCHEMA.fields])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("namespace", "batch_id")
        .parquet(path)
    )


def read_vector_log(spark: SparkSession, path: str) -> DataFrame:
    """The raw log; an absent folder reads as an empty log."""
    try:
        return spark.read.schema(VECTOR_LOG_SCHEMA).parquet(path)
    except Exception as exc:  # noqa: BLE001 - only "path does not exist" is expected
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], VECTOR_LOG_SCHEMA)


def latest_vectors(
    log: DataFrame,
    namespace: str | None = None,
    before_batch: int | None = None,
    prune_stale: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Latest-wins view: one row per ``(namespace, id)``.

    ``before_batch`` reads the log as of the start of that batch, which fixes
    the history for a whole batch (and makes a retry see the same input).
    ``prune_stale`` drops research chunks left over from an earlier, longer
    story of the same event (the reference keeps them): an event's chunks are
    those of its newest store, by version and then by order in the batch, in
    whichever namespace that is. ``columns`` are the columns of the view besides
    namespace and id; only they are read and shuffled.
    """
    if before_batch is not None:
        log = log.filter(F.col("batch_id") < before_batch)  # partition pruning
    whole = log
    if namespace is not None:
        log = log.filter(F.col("namespace") == namespace)  # partition pruning
    wanted = columns or [c for c in VECTOR_LOG_SCHEMA.fieldNames() if c not in ("namespace", "id")]
    payload = list(dict.fromkeys([*wanted, *(["event_id", "version", "ord"] if prune_stale else [])]))
    latest = (
        log.groupBy("namespace", "id")
        .agg(F.max_by(F.struct(*payload), F.struct("version", "ord")).alias("r"))
        .select("namespace", "id", "r.*")
    )
    if prune_stale:
        newest = whole.groupBy(F.col("event_id").alias("_event")).agg(F.max(F.struct("version", "ord")).alias("_newest"))
        current = F.struct("version", "ord") == F.col("_newest")
        latest = (
            latest.join(newest, F.col("event_id") == F.col("_event"))
            .filter((F.col("namespace") != RESEARCH_NAMESPACE) | current)
            .drop("_event", "_newest")
        )
    return latest.select("namespace", "id", *wanted)


def compact_vectors(spark: SparkSession, src: str, dst: str, partitions: int | None = None) -> DataFrame:
    """Rewrite the latest-wins view of ``src`` into a fresh log at ``dst`` as one base batch.

    Rows keep their version; the base batch has the highest batch id of ``src``,
    so later batches go on from it. Each namespace has at most ``partitions``
    files (hash-partitioned by id), and never more in all than ``src`` has.
    """
    log = read_vector_log(spark, src)
    base = log.agg(F.max("batch_id")).first()[0] or 0
    namespaces = max(log.select("namespace").distinct().count(), 1)
    n = max(1, min(partitions or spark.sparkContext.defaultParallelism, len(log.inputFiles()) // namespaces))
    view = latest_vectors(log)
    (
        view.withColumn("batch_id", F.lit(base).cast("long"))
        .repartition(n, "id")
        .select(*[f.name for f in VECTOR_LOG_SCHEMA.fields])
        .write.mode("overwrite")
        .partitionBy("namespace", "batch_id")
        .parquet(dst)
    )
    return latest_vectors(read_vector_log(spark, dst))


ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("title", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("story", T.StringType()),
        T.StructField("sources", T.ArrayType(T.StringType())),
        T.StructField("ord", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def append_articles(events: DataFrame, path: str, batch_id: int) -> None:
    """Insert (not upsert) each stored event as a document; a retry replaces its batch."""
    clear_batch(events.sparkSession, path, batch_id)
    (
        events.select(
            "event_id", "date", "title", "summary", "story", "sources",
            F.col("ord").cast("string").alias("ord"), F.lit(batch_id).cast("long").alias("batch_id"),
        )
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(ARTICLE_SCHEMA).parquet(path)
    except Exception as exc:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], ARTICLE_SCHEMA)
