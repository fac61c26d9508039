"""Table reads that keep every core busy.

A small Parquet file with one row group scans as one partition, which would
run every narrow, CPU-heavy step after it (regex cleaning, hashing, JSON
decoding) in a single task. ``read_table`` spreads such an input over the
cluster's parallelism with one round-robin repartition. A large input (many
files or row groups) already has enough splits and is left untouched, so at
scale this adds no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from eventloom.session import scratch_path


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return ensure_parallelism(df) if spread else df


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.staged_path = path
    return written


def discard(written: DataFrame) -> None:
    """Remove a table that ``staged`` wrote and that nothing reads any more."""
    spark = written.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(written.staged_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
