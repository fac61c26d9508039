"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.session import ensure_engine_conf, remember_setting, scratch_path

#: Bits of the id filter; its table has at most 1/64 as many rows, whatever the input.
FILTER_BITS = 1 << 24


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators need: the engine's own, and small Arrow batches
    (the kernels work on a few MB of text at a time). The next query that needs no such batches has
    the caller's setting again."""
    ensure_engine_conf(spark)
    remember_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1024")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage is cut, and
    lost executors cost no recomputation beyond this table."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.staged_path = path
    return written


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """(__row, doc), written: every row of ``df`` as a struct, so that no column name can clash, and a
    distinct number of it that stays the same between two reads. ``doc.*`` gives the columns back."""
    return stage(df.select(F.monotonically_increasing_id().alias("__row"), F.struct("*").alias("doc")), name)


def doc_column(name: str) -> Column:
    """A column of a row that ``number_rows`` packed."""
    return F.col("doc").getField(name)


def discard(written: DataFrame) -> None:
    """Remove a table that ``stage`` wrote and that nothing reads any more."""
    jvm = written.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(written.staged_path)
    path.getFileSystem(written.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def _slot(id_col: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(bits))


def split_by_ids(df: DataFrame, id_col: str, ids: DataFrame, bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in ``ids``, rows whose id is certainly not in it).

    ``ids`` is folded into a one-hash Bloom filter of ``bits`` bits, kept as at
    most ``bits / 64`` words and broadcast, so that wide rows with no match never
    reach a shuffle. The filter has no false negatives. When it fills up, more
    rows than needed take the shuffled side and the result is the same.
    """
    slot = _slot(F.col(ids.columns[0]), bits)
    words = (
        ids.select(slot.alias("__s"))
        .select(F.shiftrightunsigned("__s", 6).alias("__word"), F.expr("shiftleft(1L, cast(__s & 63 as int))").alias("__bit"))
        .groupBy("__word")
        .agg(F.bit_or("__bit").alias("__bits"))
    )
    marked = (
        df.withColumn("__s", _slot(F.col(id_col), bits))
        .withColumn("__word", F.shiftrightunsigned("__s", 6))
        .join(F.broadcast(words), "__word", "left")
        .withColumn("__hit", F.expr("coalesce(shiftright(__bits, cast(__s & 63 as int)) & 1L, 0L) = 1L"))
        .drop("__s", "__word", "__bits")
    )
    return marked.filter("__hit").drop("__hit"), marked.filter("NOT __hit").drop("__hit")


def keep_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is in the one-column table ``ids``."""
    maybe, _ = split_by_ids(df, id_col, ids)
    ids = ids.toDF("__id")
    return maybe.join(ids, maybe[id_col] == ids["__id"], "left_semi")


def drop_ids(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is not in the one-column table ``ids``; null ids stay."""
    maybe, no = split_by_ids(df, id_col, ids)
    ids = ids.toDF("__id")
    return no.unionByName(maybe.join(ids, maybe[id_col] == ids["__id"], "left_anti"))


def spread_rank(df: DataFrame, keys: list[str], order: list[Column], bucket: Column, name: str = "rank") -> DataFrame:
    """Number the rows of each key from 1, by (bucket, order), without sorting a whole key in one task.

    ``bucket`` (a small int, at most a few thousand values) cuts every key, hot
    ones too. Rows are counted by (key, bucket) with map-side sums, the counts
    before a bucket are added up over its key's few buckets, and row_number runs
    within one (key, bucket).
    """
    cut = df.withColumn("__bucket", bucket)
    sums = cut.groupBy(*keys, "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    cond = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*keys, "__bucket"]]
    joined = cut.alias("l").join(sums.alias("r"), cond).select("l.*", "r.__before")
    within = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    return joined.withColumn(name, F.col("__before") + F.row_number().over(within)).drop("__before", "__bucket")
