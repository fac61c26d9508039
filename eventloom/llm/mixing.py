"""Operator 4, mixing sources to target weights by subset-sum budget fitting.

A document's size is its number of words. Sources in code-point order (null
last) take the weights in turn and share ``share`` times all sizes. A target
stops at ``most`` times its source's size and the excess goes to the others by
weight until none is above; the fixed point of that is found in one pass over
the sources in the order in which they fill up.

A document can be taken 0 to ``most`` times, so a source with n documents of
some length has ``most * n`` copies of it. Documents are counted by exact
length, every length gets its proportional number of copies, rounded down,
greedy picks close in on the target, and bounded-knapsack dynamic programming
over the copies that are left fits the small rest exactly, or as nearly as they
can; where they cannot, a part of the proportional copies is put back and the
fit tried again. The result is a number of copies per (source, length): all its
documents share them evenly, and those that get one more come first in the
order of a seeded hash, counted by hash buckets so that no length of a hot
source is sorted in one task.

Null texts have size 0; so have texts of white space. Size-0 documents are taken
0 words. Rows that repeat an id are documents of their own. Empty tables give
empty results; extra columns are not read. Reruns give the same rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.common import spread_rank, stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 7
BUCKETS = 512
#: The dynamic programme fits a rest of up to this many words beyond the largest length.
FIT_WORDS = 1 << 14


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size) with size the number of words."""
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches):
        for batch in batches:
            n = [K.words(data, bounds).per_text for _, data, bounds in K.blocks(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64))], ["id", "source", "size"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(count, f"id {kind}, source string, size long")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target), one row per source."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))[((F.row_number().over(order) - 1) % len(weights)).cast("int")]
    weighted = by_source.withColumn("weight", turn.cast("double")).withColumn("full", F.col("source_size") * F.lit(float(most)))
    # Sources fill up in the order of full / weight. Before the k-th does, those ahead hold
    # their full amount and the level of the others is what is left by weight.
    filling = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    ahead = filling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        weighted.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("held", F.coalesce(F.sum("full").over(ahead), F.lit(0.0)))
        .withColumn("rest", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(ahead), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("held")) / F.col("rest"))
        .withColumn("open", F.col("full") / F.col("weight") > F.col("level"))
    )
    lowest = F.min(F.when(F.col("open"), F.struct(F.col("full") / F.col("weight"), F.col("level")))).over(whole).getField("level")
    return level.withColumn("common", lowest).select("source", "source_size", F.least(F.col("full"), F.coalesce(F.col("common") * F.col("weight"), F.col("full"))).alias("target"))


def fit(length: np.ndarray, copies: np.ndarray, budget: int, fit_words: int = FIT_WORDS) -> np.ndarray:
    """How many copies of each length to take, at most ``copies``, for a total close to ``budget``."""
    order = np.argsort(-length, kind="stable")
    size, have = length[order].astype(np.int64), copies[order].astype(np.int64)
    total = int((size * have).sum())
    best = np.where(size > 0, have, 0) if budget >= total else np.zeros(len(size), np.int64)
    miss = abs(budget - int((size * best).sum()))
    for quarters in (4, 3, 2, 0) if 0 < budget < total else ():
        if not miss:
            break
        take = np.array([int(n) * budget // total * quarters // 4 for n in have], np.int64)  # proportional, rounded down
        rest = budget - int((size * take).sum())
        for i in np.flatnonzero(size > 0):  # greedy, from the longest, down to a small rest
            if rest <= fit_words:
                break
            more = min(int(have[i] - take[i]), rest // int(size[i]))
            if more > 0:
                take[i] += more
                rest -= more * int(size[i])
        take += _knapsack(size, have - take, rest)
        off = abs(budget - int((size * take).sum()))
        if off < miss:
            best, miss = take, off
    out = np.empty(len(size), np.int64)
    out[order] = best
    return out


def _knapsack(size: np.ndarray, have: np.ndarray, rest: int) -> np.ndarray:
    """Counts (at most ``have``) whose total size is nearest ``rest``; the smaller of two as near."""
    take = np.zeros(len(size), np.int64)
    usable = np.flatnonzero((size > 0) & (have > 0) & (size <= 2 * rest))
    if rest <= 0 or not len(usable):
        return take
    top = 2 * rest  # a total beyond it is farther off than 0
    by = np.full(top + 1, -1, np.int32)  # the item that first reached a sum
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    items: list[tuple[int, int]] = []
    for i in usable[::-1]:  # short lengths first: they fill the sums soonest
        n, part = int(have[i]), 1
        n = min(n, top // int(size[i]))
        while n > 0 and not reached[rest]:
            part = min(part, n)
            step = part * int(size[i])
            if step <= top:
                fresh = reached[: top + 1 - step] & ~reached[step:]
                by[step:][fresh] = len(items)
                reached[step:] |= fresh
                items.append((int(i), part))
            n -= part
            part *= 2
        if reached[rest]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - rest))])
    while at:
        i, part = items[by[at]]
        take[i] += part
        at -= part * int(size[i])
    return take


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """(id, size, source, source_size, target, times, taken); taken = times * size."""
    sized = stage(sizes(docs, id_col, text_col, source_col), "mixing-sizes")
    goal = targets(sized, weights, share, most)
    # One row per distinct length of a source: at most as many as the longest text has words.
    lengths = sized.groupBy("source", "size").agg(F.count("*").alias("n")).alias("l")
    joined = lengths.join(goal.alias("g"), F.col("l.source").eqNullSafe(F.col("g.source"))).select("l.*", "source_size", "target")

    def fit_source(batch):
        import pandas as pd

        size, n = batch["size"].to_numpy(np.int64), batch["n"].to_numpy(np.int64)
        whole, target = int(batch["source_size"].iloc[0]), float(batch["target"].iloc[0])
        copies = fit(size, most * n, int(np.floor(target + 0.5)))
        base, extra = copies // n, copies % n
        return pd.DataFrame({"source": batch["source"], "size": size, "source_size": whole, "target": target, "base": base, "extra": extra})

    plan = stage(joined.groupBy("source").applyInPandas(fit_source, "source string, size long, source_size long, target double, base long, extra long"), "mixing-plan")
    shuffled: Column = F.xxhash64(F.lit(seed), F.col("id"))
    ranked = spread_rank(sized, ["source", "size"], [shuffled, F.col("id")], F.pmod(shuffled, F.lit(BUCKETS)).cast("int"))
    cond = F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.size") == F.col("p.size"))
    times = F.when(F.col("r.size") == 0, F.lit(0)).otherwise(F.col("base") + (F.col("rank") <= F.col("extra")).cast("long"))
    chosen = ranked.alias("r").join(plan.alias("p"), cond).withColumn("times", times)
    return chosen.select(F.col("r.id").alias(id_col), F.col("r.size"), F.col("r.source").alias(source_col), "source_size", "target", "times", (F.col("times") * F.col("r.size")).alias("taken"))
