"""Operator 11, hard-negative mining over Hilbert-ordered blocks with zone maps.

Components become the integers floor(scale * x); a row's score for an anchor is
their inner product. Rows are put in order by (dimension, label, place on a Hilbert
curve through the ``CURVE`` components of largest spread) and written as Parquet
blocks of at most ``BLOCK`` rows of one label, each with the least and the greatest
value of every component. For an anchor, interval arithmetic over these bounds the
score of every row of a block from both sides.

What an anchor needs is a window of scores: the highest of its own label for its
positives, the highest of the other labels between ``low`` and ``high`` percent of
each positive for its negatives. Each is read in two turns. First the most promising
block; its k-th best score is a floor. Then every other block whose interval reaches
the window above that floor (ties included). Blocks are read by the anchors that chose
them, in bundles, each with its floor, and give at most the k best of each window. So
the result is exact; what the zone maps rule out is never read.

Anchors meet zone maps in a grid of blocks of both, so no side is broadcast and no
task holds all of one.

Rows with a null id, label or vector, an empty vector or any null or non-finite
component take no part. Rows of the anchor's own id are no others of it. Vectors meet
only vectors of the same dimension. Equal scores rank by the smaller id; rows that
repeat an id count each, and each row with an anchor's id is an anchor of its own only
once per distinct (id, label, vector). Scores beyond 63 bits are held at plus or minus
2**63 - 1 and rank as such. Percentages of a positive's score are compared as integers.
Empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import stage
from eventloom.llm.integers import MOST, integers, products

SCALE = 256.0
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
BLOCK = 512
#: Components the curve goes through, and bits of each.
CURVE, CURVE_BITS = 8, 4
#: Anchors and zone maps of a cell of the grid; anchors that read a block together.
ANCHOR_CELL, ZONE_CELL, BUNDLE = 256, 1024, 256


def _matrix(raw: list[bytes], dim: int, scale: float) -> np.ndarray:
    return integers(np.frombuffer(b"".join(raw), "<f8"), scale).reshape(len(raw), dim)


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows) with ``bits`` bits a coordinate, as unsigned 64-bit."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    level = one << np.uint64(bits - 1)
    while level > one:  # undo the turns of the finer cells
        low = level - one
        for i in range(n):
            turned = (x[i] & level) != 0
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
        level >>= one
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    level = one << np.uint64(bits - 1)
    while level > one:
        flip ^= np.where((x[n - 1] & level) != 0, level - one, np.uint64(0))
        level >>= one
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | (((x[i] ^ flip) >> np.uint64(bit)) & one)
    return key


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible inner products of every anchor with points between ``low`` and ``high``,
    widened by more than the rounding of the sums."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1e-9 * (np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T) + 1
        least, most = up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack
    # Scores are held within 64 bits, and so are their bounds.
    return np.minimum(np.where(np.isnan(least), -np.inf, least), float(MOST)), np.maximum(np.where(np.isnan(most), np.inf, most), -float(MOST))


def _points(vectors: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, dim, vector) of the rows that take part, the vector as its doubles' bytes."""
    narrow = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = narrow.filter("id IS NOT NULL AND label IS NOT NULL AND size(v) > 0")

    def rows(batches):
        for batch in batches:
            column = batch.column(2)
            flat = column.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False)
            size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
            ends = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            kept = np.flatnonzero(bad[ends] == bad[ends - size])
            raw = flat.astype("<f8")
            vectors = [raw[ends[i] - size[i] : ends[i]].tobytes() for i in kept.tolist()]
            take = pa.array(kept)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(size[kept].astype(np.int32)), pa.array(vectors, pa.binary())], ["id", "label", "dim", "vector"])

    return sound.mapInArrow(rows, "id long, label long, dim int, vector binary")


def _spread(points: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By dimension: the components of largest variance, and their mean and deviation. At most one row of
    sums per task and dimension is merged, in a tree of Spark's aggregation."""

    def sums(batches):
        held: dict[int, list] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                raw = batch.column(1).filter(pa.array(dims == dim)).to_pylist()
                x = np.clip(np.frombuffer(b"".join(raw), "<f8").reshape(-1, dim), -1e150, 1e150)
                own = held.setdefault(dim, [0, np.zeros(dim), np.zeros(dim)])
                own[0] += len(x)
                own[1] += x.sum(axis=0)
                own[2] += (x * x).sum(axis=0)
        for dim, (n, s, q) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(np.arange(dim, dtype=np.int32)), pa.array([n] * dim, pa.int64()), pa.array(s), pa.array(q)], ["dim", "i", "n", "s", "q"])

    parts = points.select("dim", "vector").mapInArrow(sums, "dim int, i int, n long, s double, q double")
    totals = parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    spread = F.col("q") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)
    order = Window.partitionBy("dim").orderBy(F.desc("spread"), "i")
    top = totals.withColumn("spread", spread).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= CURVE)
    out: dict[int, list] = {}
    for r in top.select("dim", "i", (F.col("s") / F.col("n")).alias("mean"), "spread", "place").orderBy("dim", "place").toLocalIterator():  # CURVE rows a dimension
        out.setdefault(r.dim, []).append((r.i, r.mean, max(r.spread, 0.0) ** 0.5))
    return {dim: tuple(np.array(c) for c in zip(*rows)) for dim, rows in out.items()}


def _curve_keys(points: DataFrame) -> DataFrame:
    """``points`` with ``key``, the place on the curve as a signed long."""
    known = points.sparkSession.sparkContext.broadcast(_spread(points))

    def rows(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            key = np.zeros(batch.num_rows, np.uint64)
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                axis, mean, deviation = known.value[dim]
                x = np.frombuffer(b"".join(batch.column("vector").take(pa.array(mine)).to_pylist()), "<f8").reshape(-1, dim)[:, axis.astype(int)]
                # Cells of equal width within two deviations of the mean.
                cell = np.floor((np.clip((x - mean) / np.where(deviation > 0, deviation, 1), -2, 2) + 2) / 4 * (1 << CURVE_BITS))
                key[mine] = hilbert_key(np.minimum(cell, (1 << CURVE_BITS) - 1), CURVE_BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((key >> np.uint64(1)).view(np.int64))], [*batch.schema.names, "key"])

    return points.mapInArrow(rows, "id long, label long, dim int, vector binary, key long")


def zone_blocks(points: DataFrame, scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """(block, label, dim, n, ids, vectors, low, high): Hilbert-ordered blocks of rows with their zone maps, written."""
    spark = points.sparkSession
    keyed = stage(_curve_keys(points), "negatives-points")
    parts = max(1, min(keyed.count() // (4 * block) + 1, 1 << 15))
    ordered = keyed.repartitionByRange(parts, "dim", "label", "key", "id").sortWithinPartitions("dim", "label", "key", "id")

    def rows(batches):
        held = []

        def cut(some):
            table = pa.Table.from_batches(some)
            dims, labels = table.column("dim").to_numpy(), table.column("label").to_numpy()
            edge = np.flatnonzero((dims[1:] != dims[:-1]) | (labels[1:] != labels[:-1])) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(dims)]):
                for first in range(a, b, block):
                    part = table.slice(first, min(block, b - first))
                    raw = part.column("vector").to_pylist()
                    x = _matrix(raw, int(dims[a]), scale)
                    low, high = (np.array(f(x, axis=0), dtype="<f8") for f in (np.min, np.max))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(labels[a])], pa.int64()), pa.array([int(dims[a])], pa.int32()), pa.array([len(raw)], pa.int32()),
                        pa.array([part.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()), pa.array([b"".join(raw)], pa.binary()),
                        pa.array([low.tobytes()], pa.binary()), pa.array([high.tobytes()], pa.binary()),
                    ], ["label", "dim", "n", "ids", "vectors", "low", "high"])

        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 16 * block:  # whole blocks leave, the rest waits for its neighbours
                yield from cut(held)
                held, n = [], 0
        if held:
            yield from cut(held)

    cut_rows = ordered.mapInArrow(rows, "label long, dim int, n int, ids binary, vectors binary, low binary, high binary")
    return stage(cut_rows.withColumn("block", F.monotonically_increasing_id()), "negatives-blocks")


def _choose(anchors: DataFrame, zones: DataFrame, own_label: bool, first: bool) -> DataFrame:
    """(anchor, block, most): blocks whose interval reaches a window of the anchor.

    ``anchors`` holds (anchor, label, dim, vector, floors, caps), a window for each place of the two
    lists. With ``first`` only the block of the greatest bound within reach is taken, of all cells.
    """
    n_anchors, n_zones = anchors.count(), zones.count()
    across, down = -(-n_zones // ZONE_CELL) or 1, -(-n_anchors // ANCHOR_CELL) or 1
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("a", F.pmod(F.xxhash64("anchor"), F.lit(down)).cast("int")).withColumn("z", spread(across))
    right = zones.withColumn("z", F.pmod(F.xxhash64("block"), F.lit(across)).cast("int")).withColumn("a", spread(down))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"anchor": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "most": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        dim = left.column("dim")[0].as_py()
        x = _matrix(left.column("vector").to_pylist(), dim, SCALE).astype(float)
        low, high = (np.frombuffer(b"".join(right.column(c).to_pylist()), "<f8").reshape(-1, dim) for c in ("low", "high"))
        least, most = intervals(x, low, high)
        floors, caps = (np.array(left.column(c).to_pylist(), np.float64).reshape(len(x), -1) for c in ("floors", "caps"))
        fits = (left.column("label").to_numpy()[:, None] == right.column("label").to_numpy()[None, :]) == own_label
        reach = np.zeros(fits.shape, bool)
        for w in range(floors.shape[1]):
            # Doubles round to the nearest, so that a bound and a score of more than 53 bits may meet: never ruled out.
            reach |= (most >= floors[:, w : w + 1] * (1 - 1e-15 * np.sign(floors[:, w : w + 1]))) & (least <= caps[:, w : w + 1] * (1 + 1e-15 * np.sign(caps[:, w : w + 1])))
        reach &= fits
        if first:
            bound = np.where(reach, most, -np.inf)
            i = np.flatnonzero(reach.any(axis=1))
            j = bound[i].argmax(axis=1)
        else:
            i, j = np.nonzero(reach)
        return pa.table({"anchor": left.column("anchor").to_numpy()[i], "block": right.column("block").to_numpy()[j], "most": most[i, j]})

    left = left.select("a", "z", "dim", "anchor", "label", "vector", "floors", "caps")
    right = right.select("a", "z", "dim", "block", "label", "low", "high")
    cells = left.groupBy("a", "z", "dim").cogroup(right.groupBy("a", "z", "dim")).applyInArrow(meet, "anchor long, block long, most double")
    if first:
        return cells.groupBy("anchor").agg(F.max_by("block", "most").alias("block"))
    return cells.select("anchor", "block")


def _best_in_windows(score: np.ndarray, ids: np.ndarray, floors: np.ndarray, caps: np.ndarray, k: int) -> np.ndarray:
    """Places of one anchor's scores that are among the k best of any of its windows, ids in order for ties."""
    order = np.lexsort((ids, -score))
    sorted_scores = score[order]
    taken = np.zeros(len(score), bool)
    for floor, cap in zip(floors, caps):
        start = np.searchsorted(-sorted_scores, -cap, side="left") if cap < MOST else 0
        end = np.searchsorted(-sorted_scores, -floor, side="right") if floor > -MOST else len(score)
        taken[order[start : min(end, start + k)]] = True
    return np.flatnonzero(taken)


def _read(chosen: DataFrame, anchors: DataFrame, blocks: DataFrame, k: int, bundle: int = BUNDLE) -> DataFrame:
    """(anchor, id, score): of every chosen block the rows among the k best of a window of the anchor."""
    bundles = max(-(-anchors.count() // bundle), 1)
    reads = chosen.join(anchors.select("anchor", "anchor_id", "dim", "vector", "floors", "caps"), "anchor")
    reads = reads.withColumn("bundle", F.pmod(F.xxhash64("anchor"), F.lit(bundles)).cast("int"))
    bundled = chosen.select("block", F.pmod(F.xxhash64("anchor"), F.lit(bundles)).cast("int").alias("bundle")).distinct()
    content = blocks.select("block", "ids", "vectors").join(bundled, "block")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            ids = np.frombuffer(right.column("ids")[0].as_py(), "<i8")
            rows = _matrix([right.column("vectors")[0].as_py()], dim * len(ids), SCALE).reshape(len(ids), dim)
            score = products(_matrix(left.column("vector").to_pylist(), dim, SCALE), rows)
            own = left.column("anchor_id").to_numpy()
            for i, (anchor, floors, caps) in enumerate(zip(left.column("anchor").to_pylist(), left.column("floors").to_pylist(), left.column("caps").to_pylist())):
                others = np.flatnonzero(ids != own[i])
                best = others[_best_in_windows(score[i, others], ids[others], floors, caps, k)]
                found[0].append(np.full(len(best), anchor))
                found[1].append(ids[best])
                found[2].append(score[i, best])
        return pa.table({name: np.concatenate(part).astype(np.int64) if part else np.zeros(0, np.int64) for name, part in zip(("anchor", "id", "score"), found)})

    cells = reads.select("block", "bundle", "anchor", "anchor_id", "dim", "vector", "floors", "caps").groupBy("block", "bundle")
    return cells.cogroup(content.select("block", "bundle", "ids", "vectors").groupBy("block", "bundle")).applyInArrow(meet, "anchor long, id long, score long")


def _two_turns(anchors: DataFrame, blocks: DataFrame, own_label: bool, k: int, rank_windows, name: str) -> DataFrame:
    """(anchor, id, score) that hold the k best of every window; ``rank_windows`` gives (anchor, window, rank, score) of found rows."""
    zones = blocks.select("block", "label", "dim", "low", "high")
    seeds = stage(_choose(anchors, zones, own_label, first=True), f"{name}-seeds")
    first = stage(_read(seeds, anchors, blocks, k), f"{name}-first")
    kth = rank_windows(first).filter(F.col("rank") == k).groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("kth"))
    raised = F.transform("floors", lambda f, w: F.greatest(f, F.coalesce(F.try_element_at("kth", w), f)))
    raised = anchors.join(kth, "anchor", "left").withColumn("kth", F.coalesce("kth", F.create_map().cast("map<int,bigint>"))).withColumn("floors", raised).drop("kth")
    raised = stage(raised, f"{name}-anchors")
    rest = _choose(raised, zones, own_label, first=False).join(seeds, ["anchor", "block"], "left_anti")
    rest = stage(rest, f"{name}-reads")
    return stage(first.union(_read(rest, raised, blocks, k)), f"{name}-found")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, block: int = BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the column ``id``; ``label`` a column of ``vectors``.
    """
    points = stage(_points(vectors, id_col, vector_col, label), "negatives-rows")
    blocks = zone_blocks(points, SCALE, block)
    every = F.array(F.lit(-MOST)), F.array(F.lit(MOST))
    anchors = points.filter(is_anchor).distinct().select(F.col("id").alias("anchor_id"), "label", "dim", "vector", every[0].alias("floors"), every[1].alias("caps"))
    anchors = stage(anchors.withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")

    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    best = lambda found: found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
    found = _two_turns(anchors, blocks, True, positives, lambda rows: best(rows).withColumn("window", F.lit(0)), "positives")
    # Below zero no score is at least the lower and at most the higher percentage. The others have a window
    # from ceil(low * p / 100) to floor(high * p / 100), in integers.
    pairs = best(found).filter(F.col("score") >= 0).select(
        "anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.expr(f"score div 100 * {low} + (score % 100 * {low} + 99) div 100").alias("floor"),
        F.expr(f"score div 100 * {high} + score % 100 * {high} div 100").alias("cap"),
    )
    pairs = stage(pairs, "positives")
    windows = F.sort_array(F.collect_list(F.struct("window", "floor", "cap")))  # at most ``positives`` of an anchor
    windows = pairs.groupBy("anchor").agg(windows.alias("w"))
    padded = lambda c, fill: F.concat(F.col(f"w.{c}"), F.array_repeat(F.lit(fill), F.lit(positives) - F.size("w")))
    windows = windows.select("anchor", padded("floor", MOST).alias("floors"), padded("cap", -MOST).alias("caps"))  # no score is in the padding
    seekers = stage(anchors.drop("floors", "caps").join(windows, "anchor"), "negatives-seekers")

    of_window = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")

    def in_windows(rows: DataFrame) -> DataFrame:
        met = rows.join(pairs, "anchor").filter(F.col("score").between(F.col("floor"), F.col("cap")))
        return met.withColumn("rank", F.row_number().over(of_window)).filter(F.col("rank") <= negatives)

    mined = in_windows(_two_turns(seekers, blocks, False, negatives, in_windows, "negatives"))
    return mined.join(anchors.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
