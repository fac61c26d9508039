"""Response intake, status split and calendar-day window (operators 1-3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("response_id", T.LongType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("content", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

OK_STATUS = 200


#: A line that is no answer, as it stands in the file; null for the others.
MALFORMED = "_malformed"


def read_responses(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Raw model answers in bulk (or as a stream) with an enforced schema.

    The schema is given, never inferred, so a stream and a batch read of the
    same folder plan identically and a malformed file cannot widen types.
    ``fmt='json'`` reads a line per answer; a line that does not parse, or holds
    a value of another type, keeps its text in the column ``_malformed``
    (``split_malformed`` tells them apart) and fails nothing.
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt != "json":
        return reader.schema(RESPONSE_SCHEMA).format(fmt).load(path)
    # Lines are parsed as a column: the JSON source reads only the columns that a plan needs, and a
    # value of a wrong type in another column would pass unseen.
    schema = T.StructType([*RESPONSE_SCHEMA.fields, T.StructField(MALFORMED, T.StringType())])
    lines = reader.format("text").load(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED})
    return lines.select(parsed.alias("r")).select("r.*")


def split_malformed(df: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(answers, malformed)``: lines that could not be read go to quarantine with reason
    ``malformed_line``, or abort the job with ``mode='failfast'``. Sources without such a
    column have no malformed rows."""
    if MALFORMED not in df.columns:
        return df, df.limit(0).withColumn("reason", F.lit(None).cast("string"))
    if mode == "failfast":
        said = F.concat(F.lit("malformed response line: "), F.substring(MALFORMED, 1, 200))
        checked = df.filter(F.when(F.col(MALFORMED).isNull(), F.lit(True)).otherwise(F.raise_error(said).cast("boolean")))
        return checked.drop(MALFORMED), df.limit(0).drop(MALFORMED).withColumn("reason", F.lit(None).cast("string"))
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    bad = df.filter(F.col(MALFORMED).isNotNull()).withColumn("reason", F.lit("malformed_line"))
    return df.filter(F.col(MALFORMED).isNull()).drop(MALFORMED), bad.drop(MALFORMED)


def split_by_status(df: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(ok, rejected)``: any status other than 200, NULL included, is rejected.

    ``mode='failfast'`` makes the first rejected row abort the job the way the
    reference raises on a bad answer; the check runs inside the executors
    (``raise_error``), so no rows are pulled to the driver.
    """
    is_ok = F.coalesce(F.col("status") == OK_STATUS, F.lit(False))
    if mode == "failfast":
        guarded = df.withColumn(
            "status",
            F.when(is_ok, F.col("status")).otherwise(
                F.raise_error(F.concat(
                    F.lit("response error status: "), F.coalesce(F.col("status").cast("string"), F.lit("null"))
                ))
            ).cast("int"),
        )
        return guarded, df.limit(0)
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    rejected = df.filter(~is_ok).withColumn(
        "reason", F.concat(F.lit("status_"), F.coalesce(F.col("status").cast("string"), F.lit("null")))
    )
    return df.filter(is_ok), rejected


def day_bounds(run_date: dt.date | str, days: int = 1) -> tuple[dt.datetime, dt.datetime]:
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    end = dt.datetime.combine(run_date, dt.time()) + dt.timedelta(days=1)
    return end - dt.timedelta(days=days), end


def day_window(df: DataFrame, ts_col: str, run_date: dt.date | str, days: int = 1) -> DataFrame:
    """Rows of the ``days`` calendar days ending with ``run_date`` (default: that day)."""
    dtype = df.schema[ts_col].dataType
    start, end = day_bounds(run_date, days)
    target = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    col = F.col(ts_col)
    # Literal strings cast in the session time zone (UTC), never Python-local time.
    lo = F.lit(start.isoformat(sep=" ")).cast(target)
    hi = F.lit(end.isoformat(sep=" ")).cast(target)
    return df.filter((col >= lo) & (col < hi))
