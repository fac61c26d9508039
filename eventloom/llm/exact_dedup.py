"""Operator 8, exact dedup by a heavy-hitter split.

A text's digest is its SHA-256. Misra-Gries summaries, one per partition and
added up, name every digest that could be held by more than 1/``counters`` of
the rows. Those candidates (at most ``counters`` rows) are counted exactly with
map-side sums, and the verified ones are broadcast with their winner, so rows
of a hot group never meet in one task. All other digests take an ordinary
shuffle: map-side partial aggregation, then an equi-join back that AQE may
split.

Null and empty texts are equal. Of equal texts the row with the largest id
stays; rows that repeat an id count as rows of their own, and then the decisions
keep each row of the winning id, while the stage keeps one. A null id is smaller
than all others. Texts are digested whole, however
long. Empty tables give empty results. Extra columns are not read; the stage keeps them,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import doc_column, drop_ids, number_rows, stage

#: Counters of a Misra-Gries summary, and the most rows that are broadcast.
COUNTERS = 1024


def misra_gries(keys: Iterator[np.ndarray], counters: int) -> dict:
    """Summary of at most ``counters`` keys: a key seen more than total / (counters + 1)
    times is in it, with a count too low by at most that much."""
    held: dict = {}
    for part in keys:
        for key, n in zip(*(x.tolist() for x in np.unique(part, return_counts=True))):
            held[key] = held.get(key, 0) + n
        if len(held) > counters:
            cut = np.partition(np.fromiter(held.values(), np.int64, len(held)), len(held) - counters - 1)[len(held) - counters - 1]
            held = {k: n - int(cut) for k, n in held.items() if n > cut}
    return held


def frequent_keys(df: DataFrame, key: str, counters: int = COUNTERS) -> DataFrame:
    """(key, low): at most ``counters`` candidates for the frequent values of a string column."""

    def summarise(batches):
        held = misra_gries((b.column(0).to_numpy(zero_copy_only=False).astype("S") for b in batches if b.num_rows), counters)
        yield pa.RecordBatch.from_arrays([pa.array([k.decode() for k in held], pa.string()), pa.array(list(held.values()), pa.int64())], [key, "low"])

    parts = df.select(key).mapInArrow(summarise, f"{key} string, low long")
    return parts.groupBy(key).agg(F.sum("low").alias("low")).orderBy(F.desc("low"), key).limit(counters)


def join_summary(rows: DataFrame, key: str, *sums: Column, counters: int = COUNTERS) -> DataFrame:
    """``rows`` with per-key aggregates beside them, hot keys split off.

    The aggregates of frequent keys (at most ``counters`` of them) are summed on
    the map side and broadcast; rows of all other keys are shuffled. ``rows`` is
    read several times, so it should be a written table; ``key`` is a string.
    """
    summary = lambda part: part.groupBy(key).agg(*sums, F.count("*").alias("__n"))
    candidates = frequent_keys(rows, key, counters).select(key)
    hot = stage(summary(rows.join(F.broadcast(candidates), key, "left_semi")).filter("__n > 1"), "hot-keys")
    direct = rows.join(F.broadcast(hot), key)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return direct.unionByName(rest.join(summary(rest), key)).drop("__n")


def dedup_decisions(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    counters: int = COUNTERS,
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    digests = stage(docs.select(F.col(id_col).alias("id"), F.sha2(text.cast("binary"), 256).alias("digest")), "dedup-digests")

    joined = join_summary(digests, "digest", F.max("id").alias("keep_id"), F.count("*").alias("group_size"), counters=counters)
    return joined.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row of ``docs`` for every text, that of the largest id; rows are told apart by number, as ids may repeat."""
    rows = number_rows(docs, "dedup-rows")
    digest = F.sha2(F.coalesce(doc_column(text_col).cast("string"), F.lit("")).cast("binary"), 256)
    digests = stage(rows.select("__row", doc_column(id_col).alias("id"), digest.alias("digest")), "dedup-digests")
    joined = join_summary(digests, "digest", F.max(F.struct("id", "__row")).alias("keep"), counters=counters)
    lost = stage(joined.filter("__row <> keep.__row").select("__row"), "dedup-lost")
    return drop_ids(rows, "__row", lost).select("doc.*")
