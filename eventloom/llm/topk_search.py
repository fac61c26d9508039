"""Operator 3, exact top-k search by inner product with multi-resolution segment statistics.

Components become the integers floor(scale * x). A vector is cut into segments;
each has a mean and a deviation. Within a segment of m components the inner
product of two vectors is at most m * (mean * mean + deviation * deviation)
(Cauchy-Schwarz on what is left after the means), which with the norms is the
same as the lower bound on the distance. Summed over a few coarse segments this
costs a few products per pair. Candidates that cannot reach a query's k-th best
score so far are dropped, the others meet the bound of finer segments, and only
survivors get their exact score.

Queries and candidates lie in blocks by a hash of the id, and every block of
queries meets every block of candidates in one task, which returns k rows for
each query. So a task's memory is bounded, no side is broadcast, and the k best
of the few rows per query are ranked at the end.

Vectors that are null or empty or hold a null, NaN or infinite component take
no part; neither do rows with a null id. Vectors meet only vectors of the same
dimension. A query does not meet rows of its own id. Equal scores rank by the
smaller id, rows that repeat an id each count, as candidates and as queries. Scores
are exact; one beyond 63 bits is held at plus or minus 2**63 - 1 and ranks as such
(vectors of such size take exact integers of any length in place of the bounds). Empty
tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import stage
from eventloom.llm.integers import integers, products

K, SCALE = 20, 64.0
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192
#: Segments of a vector, coarse to fine.
RESOLUTIONS = (4, 16)
#: Queries and candidates whose bounds are held at a time.
QUERY_TILE, CANDIDATE_TILE = 256, 4096


def quantise(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, dim, vector) of the rows that take part, the vector as its doubles' bytes."""

    def rows(batches):
        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).astype("<f8")
            length = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            ends = np.cumsum(length)
            good = batch.column(0).is_valid().to_numpy(zero_copy_only=False) & (length > 0) & (bad[ends] == bad[ends - length])
            kept = np.flatnonzero(good)
            raw = [flat[ends[i] - length[i] : ends[i]].tobytes() for i in kept.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)).cast(pa.int64()), pa.array(length[kept].astype(np.int32)), pa.array(raw, pa.binary())], ["id", "dim", "vector"])

    narrow = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return narrow.mapInArrow(rows, "id long, dim int, vector binary")


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner product bounds the vectors' from above: weighted segment means and deviations."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    size = np.diff(edges).astype(float)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / size
    square = np.add.reduceat(x * x, edges[:-1], axis=1) / size
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean * np.sqrt(size), deviation * np.sqrt(size)], axis=1)


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of q with all rows of c."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    return (q.astype(float) @ c.astype(float).T).astype(np.int64) if most < 2**53 else q @ c.T


def _pair_scores(q: np.ndarray, c: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.empty(len(i), np.int64)
    for a in range(0, len(i), 1 << 16):
        part = slice(a, a + (1 << 16))
        out[part] = np.einsum("nd,nd->n", q[i[part]], c[j[part]])
    return out


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k, self.query = k, np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = np.full(queries, np.iinfo(np.int64).min)  # the k-th best score, once there are k

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query = query[order]
        first = np.searchsorted(query, query, side="left")
        place = np.arange(len(query)) - first
        keep = place < self.k
        self.query, self.score, self.id = query[keep], score[order][keep], ids[order][keep]
        full = place[keep] == self.k - 1
        self.least[self.query[full]] = self.score[full]


def search_block(query_ids, queries, candidate_ids, candidates, k: int, resolutions=RESOLUTIONS):
    """The k best candidates of each query within the block: (query index, score, candidate id)."""
    floats = queries.astype(float), candidates.astype(float)
    # Bounds are floating-point sums; the margin is far above their rounding.
    levels = [(segment_statistics(floats[0], s), segment_statistics(floats[1], s)) for s in resolutions]
    norm_q, norm_c = (np.sqrt((x * x).sum(axis=1)) for x in floats)
    margin = 1e-6 * (1 + norm_q * norm_c.max(initial=0))
    found = _Best(len(queries), k)
    # Long vectors can score high: they come first, so that the k-th best rises early.
    by_norm = np.argsort(-norm_c, kind="stable")
    for a in range(0, len(queries), QUERY_TILE):
        mine = np.arange(a, min(a + QUERY_TILE, len(queries)))
        for b in range(0, len(by_norm), CANDIDATE_TILE):
            theirs = by_norm[b : b + CANDIDATE_TILE]
            i = j = None
            for coarse_q, coarse_c in levels:
                if i is None:
                    bound = coarse_q[mine] @ coarse_c[theirs].T
                    if not b:  # the most promising by the first bound set the first k-th best
                        n = min(4 * k, len(theirs))
                        top = np.argpartition(-bound, n - 1, axis=1)[:, :n]
                        x, y = np.repeat(np.arange(len(mine)), n), top.ravel()
                        own = query_ids[mine[x]] == candidate_ids[theirs[y]]
                        x, y = x[~own], y[~own]
                        seeds = _Best(len(mine), k)
                        seeds.add(x, _pair_scores(queries, candidates, mine[x], theirs[y]), candidate_ids[theirs[y]])
                        found.least[mine] = np.maximum(found.least[mine], seeds.least)
                    i, j = np.nonzero(bound + margin[mine][:, None] >= found.least[mine][:, None])
                elif len(i) * 4 > len(mine) * len(theirs):
                    bound = coarse_q[mine] @ coarse_c[theirs].T
                    alive = bound[i, j] + margin[mine[i]] >= found.least[mine[i]]
                    i, j = i[alive], j[alive]
                else:
                    alive = _pair_bounds(coarse_q, coarse_c, mine[i], theirs[j]) + margin[mine[i]] >= found.least[mine[i]]
                    i, j = i[alive], j[alive]
            if len(i) * 8 > len(mine) * len(theirs):
                score = _scores(queries[mine], candidates[theirs])[i, j]
            else:
                score = _pair_scores(queries, candidates, mine[i], theirs[j])
            good = (score >= found.least[mine[i]]) & (query_ids[mine[i]] != candidate_ids[theirs[j]])
            i, j, score = i[good], j[good], score[good]
            found.add(mine[i], score, candidate_ids[theirs[j]])
    return found.query, found.score, found.id


def _pair_bounds(q, c, i, j):
    out = np.empty(len(i))
    for a in range(0, len(i), 1 << 16):
        part = slice(a, a + (1 << 16))
        out[part] = np.einsum("nd,nd->n", q[i[part]], c[j[part]])
    return out


def _open(block: pa.Table, scale: float):
    """(numbers, ids, integers, wide): floor(scale * x) of a block's vectors; a wide row's scores may not fit 62 bits
    of integer arithmetic."""
    numbers, ids = block.column("number").to_numpy(), block.column("id").to_numpy()
    flat = np.frombuffer(b"".join(block.column("vector").to_pylist()), "<f8")
    x = integers(flat, scale).reshape(len(ids), -1)
    most = np.abs(x).max(axis=1).astype(float)
    return numbers, ids, x, most * most * x.shape[1] >= 2.0**62


def _exact_best(q, q_ids, c, c_ids, k: int):
    """The k best of few rows in Python integers: (query index, score, candidate id)."""
    score = products(q, c)
    query, other = np.nonzero(q_ids[:, None] != c_ids[None, :])
    best = _Best(len(q), k)
    best.add(query, score[query, other], c_ids[other])
    return best.query, best.score, best.id


def search_rows(q_ids, q, q_wide, c_ids, c, c_wide, k: int):
    """``search_block`` for rows whose scores fit, exact integers of any size for the others."""
    parts = []
    for mine, theirs, search in ((~q_wide, ~c_wide, search_block), (~q_wide, c_wide, None), (q_wide, np.ones(len(c), bool), None)):
        mine = np.flatnonzero(mine)
        if not len(mine) or not theirs.any():
            continue
        if search:
            found = search(q_ids[mine], q[mine].astype(np.int64), c_ids[theirs], c[theirs].astype(np.int64), k)
        else:
            found = _exact_best(q[mine], q_ids[mine], c[theirs], c_ids[theirs], k)
        parts.append((mine[found[0]], found[1], found[2]))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*parts) if parts else ((), (), ()))]


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: float = SCALE, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score); ``is_query`` is a condition on the column ``id``."""
    points = stage(quantise(vectors, id_col, vector_col).withColumn("number", F.monotonically_increasing_id()), "search-vectors")
    n, n_queries = points.agg(F.count("*"), F.count_if(is_query)).first()
    across, down = max(-(-n // candidate_block), 1), max(-(-n_queries // query_block), 1)
    place = F.xxhash64("id", "number")
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = points.filter(is_query).withColumn("q", F.pmod(place, F.lit(down)).cast("int")).withColumn("c", blocks(across))
    right = points.withColumn("c", F.pmod(place, F.lit(across)).cast("int")).withColumn("q", blocks(down))

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            empty = pa.array([], pa.int64())
            return pa.table({"number": empty, "query_id": empty, "vec_id": empty, "score": empty})
        (numbers, q_ids, q, q_wide), (_, c_ids, c, c_wide) = _open(queries, scale), _open(candidates, scale)
        query, score, ids = search_rows(q_ids, q, q_wide, c_ids, c, c_wide, k)
        return pa.table({"number": numbers[query], "query_id": q_ids[query], "vec_id": ids, "score": score})

    cells = left.groupBy("q", "c", "dim").cogroup(right.groupBy("q", "c", "dim")).applyInArrow(meet, "number long, query_id long, vec_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
