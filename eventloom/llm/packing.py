"""Operator 10, best-two-fit packing of tokenised documents.

Tokenising: a text's ids are the concatenated ids of its words, as the
tokenizer drops white space and never joins what white space parts, so every
worker encodes each distinct word once. Every document ends with ``end_id``;
one longer than ``capacity`` is cut into pieces of ``capacity`` ids, of which
the last may be shorter.

Packing works on the histogram of piece lengths, at most ``capacity`` numbers,
not on pieces. A bin takes the longest piece left and then, again and again,
the longest that fits. Then its smallest piece is replaced by the two unpacked
pieces that fit the gap it leaves most tightly, if they fill more. The same
bin repeats for as long as the lengths last, so the plan has one pattern for
many bins and its size is bound by the capacity. The pieces of a length are
numbered (hot lengths are split first) and take the plan's places in turn.

Null and empty texts are one piece, the end id alone. Rows that repeat an id
are documents of their own. Empty tables give empty results; extra columns are
not read. A piece lies in one sequence, sequences have no gaps, and reruns
give the same sequences.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.common import spread_rank, stage
from eventloom.llm.wordcache import WordCache

CAPACITY = 4096
END_ID = 1
#: Cuts of a length's pieces when they are numbered.
BUCKETS = 512

_ENCODERS: dict[str, WordCache] = {}


def _encoder(path: str) -> WordCache:
    if path not in _ENCODERS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)

        def solve(data, start, end):
            raw = data.tobytes()
            got = tokenizer.encode_batch([raw[a:b].decode("utf-8", "replace") for a, b in zip(start.tolist(), end.tolist())], add_special_tokens=False)
            ids = [x.ids for x in got]
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            return length, np.fromiter((i for x in ids for i in x), np.int32, int(length.sum()))

        _ENCODERS[path] = WordCache(solve)
    return _ENCODERS[path]


def text_ids(column: pa.Array, path: str):
    """The ids (int32 array) of each text of a column, one after the other."""
    cache = _encoder(path)
    for _, data, bounds in K.blocks(column):
        w, hashes = K.word_hashes(data, bounds)
        first, length = cache.look_up(data, w, hashes)
        ids = cache.flat[K.ragged(first, length)]
        ends = np.concatenate([[0], np.cumsum(length)])[w.first]
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            yield ids[a:b]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) for every piece of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], "<u4")

    def cut(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        for batch in batches:
            rows, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, body in enumerate(text_ids(batch.column(1), tokenizer_path)):
                body = body.astype("<u4")
                for at in range(0, len(body) + 1, capacity):
                    part = body[at : at + capacity]
                    if len(part) < capacity:
                        part = np.concatenate([part, end])
                    rows.append(row)
                    piece.append(at // capacity)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.data))
                    if with_ids:
                        kept.append(part)
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            out = [ids, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                out.append(pa.array([x.astype(np.int64) for x in kept], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(cut, schema)


@dataclass
class Plan:
    """Places for pieces: those of ``length`` numbered from ``rank`` on lie ``use`` to a bin,
    in the bins from ``sequence`` on, the first of each at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    use: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.searchsorted(self.length, length, side="left")
        high = np.searchsorted(self.length, length, side="right")
        while (todo := high - low > 1).any():  # binary search among the rows of a length
            middle = (low + high) // 2
            right = todo & (self.rank[np.minimum(middle, len(self.rank) - 1)] <= rank)
            low, high = np.where(right, middle, low), np.where(todo & ~right, middle, high)
        turn = rank - self.rank[low]
        return self.sequence[low] + turn // self.use[low], self.offset[low] + turn % self.use[low] * length


def _pattern(left: np.ndarray, capacity: int) -> Counter:
    """One bin from the pieces left (``left[n]`` of length ``n``)."""
    use: Counter = Counter()
    there = np.flatnonzero(left)
    gap = capacity
    while gap > 0 and len(there):
        at = int(np.searchsorted(there, gap, side="right")) - 1
        if at < 0:
            break
        length = int(there[at])
        n = min(gap // length, int(left[length]))
        use[length] += n
        gap -= n * length
        there = there[:at]
    if gap and len(use) + max(use.values()) > 2:
        smallest = min(use)
        room = gap + smallest
        free = left.copy()
        for length, n in use.items():
            free[length] -= n
        free[smallest] += 1
        most = np.zeros(room + 1, np.int64)  # the longest free length of at most so much
        lengths = np.flatnonzero(free[: room + 1])
        most[lengths] = lengths
        most = np.maximum.accumulate(most)
        other = most[room - lengths]
        twice = (other == lengths) & (free[lengths] < 2)
        other[twice] = most[np.maximum(lengths[twice] - 1, 0)]
        sums = np.where(other > 0, lengths + other, 0)
        best = int(np.argmax(sums)) if len(sums) else -1
        if best >= 0 and sums[best] > smallest:
            use[smallest] -= 1
            use[int(lengths[best])] += 1
            use[int(other[best])] += 1
    return +use


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Best-two-fit over a histogram of lengths (each from 1 to ``capacity``)."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] += n
    taken = np.zeros(capacity + 1, np.int64)
    rows, sequences = [], 0
    while left.any():
        use = _pattern(left, capacity)
        times = min(int(left[length]) // n for length, n in use.items())
        offset = 0
        for length in sorted(use, reverse=True):
            rows.append((length, int(taken[length]), use[length], sequences, offset))
            taken[length] += times * use[length]
            left[length] -= times * use[length]
            offset += use[length] * length
        sequences += times
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with (sequence_id, offset)."""
    cut = stage(cut, "packing-pieces")
    histogram = {int(r[0]): int(r[1]) for r in cut.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = cut.sparkSession.sparkContext.broadcast(plan_packing(histogram, capacity))
    ranked = spread_rank(cut, ["length"], [F.col("id"), F.col("piece"), F.col("ids_crc32")], F.pmod(F.xxhash64("id", "piece"), F.lit(BUCKETS)).cast("int"))

    def place(batches):
        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(n)).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
            sequence, offset = plan.value.place(length, rank - 1)
            kept = [c for n, c in zip(names, batch.columns) if n != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [n for n in names if n != "rank"] + ["sequence_id", "offset"])

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row for every piece: (id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    return pack(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id, with_ids), capacity).withColumnRenamed("id", id_col)
