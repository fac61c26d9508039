"""Operator 1, suffix-array dedup: removes bytes covered by a repeated string of ``length`` bytes.

A window is a string of ``length`` bytes within one text. A byte goes if a
window that covers it also starts earlier, in a document of a smaller id or
earlier in its own. Windows are judged on the input.

1. Of equal texts only the one with the smallest id is looked at; the others go
   whole (if they hold a window).
2. Every window has an anchor, the ``ANCHOR``-byte string in it with the
   smallest hash (the leftmost of equals). Equal windows have equal anchors, so
   windows meet by anchor, and windows next to each other mostly share one: the
   text from the first to the end of the last is the anchor's context. Anchors
   are counted over all texts; contexts are made only for those that may occur
   twice (a filter of bounded size, without false negatives).
3. Contexts with the same anchor go to the same shard. A shard holds some MB of
   distinct contexts. It builds their suffix array (Larsson-Sadakane refinement:
   groups that agree on h bytes are sorted by the group that follows h bytes
   on, only where not yet single) and common prefixes (Kasai), and the runs with
   common prefixes of at least ``length`` bytes are the equal windows. Of a run,
   all but the earliest window are covered. An anchor with more contexts than a
   shard holds is cut into several shards, and their sorted windows are merged
   by binary search.
4. The covered intervals are joined back to the texts.

Equal contexts are folded to the earliest within a task, before any shuffle. An
anchor found more than ``HOT_LEAST`` times (at most ``MOST_HOT`` of them) is split
by what its windows hold around it, in steps from both ends, so that one line
in a third of all documents does not meet in one task.

Null texts count as empty. Rows that repeat an id are ordered by their text's
hash; rows equal in both are one document, each with its result. A null id comes
before all others. Empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.common import drop_ids, stage
from eventloom.llm.exact_dedup import join_summary

LENGTH = 100
ANCHOR = 32
#: Context bytes that a map task folds at a time, and that a shard's suffix array covers.
FOLD_BYTES = 16 << 20
SHARD_BYTES = 2 << 20
#: Bits of the filter on repeated anchors (16 for each, within these bounds).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: An anchor with more occurrences is split, if it is among the most frequent.
HOT_LEAST, MOST_HOT = 4096, 1 << 20
#: Texts beyond this length are read in pieces that overlap by a window.
PIECE_BYTES = 1 << 20
NULL_ID = -(1 << 63)


# Suffix arrays -----------------------------------------------------------------------------


def _words64(text: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    n = len(text)
    out = np.zeros(n, np.uint64)
    for j in range(8):
        out = out << np.uint64(8) | padded[j : j + n]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start of every suffix of ``text`` in lexicographic order (a prefix comes first)."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    first = _words64(text)
    order = np.argsort(first, kind="stable")
    new = np.ones(n, bool)
    new[1:] = first[order[1:]] != first[order[:-1]]
    # Zero bytes at the end look like the padding: such suffixes are told apart by their length.
    tail = order > n - 8
    if tail.any():
        new |= tail
        new[1:] |= tail[:-1]
        same = np.flatnonzero(tail)
        for at in same.tolist():  # at most 7 suffixes; a shorter one precedes its equals
            value, lo = first[order[at]], at
            while lo and first[order[lo - 1]] == value and order[lo - 1] < order[at]:
                lo -= 1
            if lo < at:
                order[lo : at + 1] = np.concatenate([order[at : at + 1], order[lo:at]])
                new[lo : at + 1] = True if at - lo == 1 else np.concatenate([[True, True], new[lo + 1 : at]])
    rank = np.zeros(n + 1, np.int64)  # one more than the place of the group's first; 0 beyond the end
    place = np.arange(1, n + 1)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    # Larsson-Sadakane: refine only the groups that hold more than one suffix.
    single = new.copy()
    single[:-1] &= new[1:]
    h, open_ = 8, np.flatnonzero(~single)
    while len(open_):
        starts = order[open_]
        group = rank[starts]
        key = group << 32 | rank[np.minimum(starts + h, n)]
        by = np.argsort(key, kind="stable")
        starts, key = starts[by], key[by]
        order[open_] = starts
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        # Ranks change only after all keys of this round have been read.
        rank[starts] = np.maximum.accumulate(np.where(new, open_ + 1, 0))
        single = new.copy()
        single[:-1] &= new[1:]
        open_ = open_[~single]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, lane: int = 256) -> np.ndarray:
    """Kasai: bytes that each suffix shares with the one before it in ``order``, up to ``most``.

    The text is cut into lanes of ``lane`` starts, walked side by side: from one
    start to the next a common prefix shrinks by one byte at most.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    eight = np.concatenate([_words64(text), np.zeros(most + 16, np.uint64)])
    shared = np.zeros(n, np.int64)
    at = np.arange(0, n, lane)
    h = np.zeros(len(at), np.int64)
    for _ in range(min(lane, n)):
        live = at < n
        if not live.all():
            at, h = at[live], h[live]
        h = np.maximum(h - 1, 0)
        other = before[at]
        h[other < 0] = 0
        todo = np.flatnonzero((other >= 0) & (h < most))
        while len(todo):
            x = eight[at[todo] + h[todo]] ^ eight[other[todo] + h[todo]]
            same = np.full(len(todo), 8, np.int64)
            for byte in range(8):
                same[(same == 8) & (x >> np.uint64(8 * (7 - byte)) != 0)] = byte
            h[todo] += same
            todo = todo[(same == 8) & (h[todo] < most)]
        h = np.minimum(h, n - np.maximum(at, other))  # the zeros beyond the end are no bytes
        shared[at] = np.minimum(h, most)
        at = at + 1
    return shared[order]


# Windows, anchors, contexts ------------------------------------------------------------------


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def _pieces(column: pa.Array, length: int):
    """(row numbers, place of the piece in its text, bytes, bounds): short texts whole, long ones in pieces."""
    for rows, data, bounds in K.blocks(column, K.SMALL_BLOCK):
        if len(data) <= PIECE_BYTES or rows.stop - rows.start > 1:
            n = rows.stop - rows.start
            yield np.arange(rows.start, rows.stop), np.zeros(n, np.int64), data, bounds
            continue
        for at in range(0, len(data) - length + 1, PIECE_BYTES):
            part = data[at : at + PIECE_BYTES + length - 1]
            yield np.array([rows.start]), np.array([at]), part, np.array([0, len(part)])


class _Anchors:
    """Anchors of a block: the k-byte string at ``at`` is the anchor of the windows ``low`` to ``high``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, length: int, k: int):
        self.data = data
        none = np.zeros(0, np.int64)
        self.at, self.low, self.high, self.key = none, none, none, np.zeros(0, np.uint64)
        if len(data) < length:
            return
        self.prefix = K.prefix_hash(data)
        n = len(data) - k + 1
        hashed = (self.prefix[k:] - self.prefix[:-k]) * K.inverse_powers(n)
        hashed ^= hashed >> np.uint64(32)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(29)
        low32 = np.uint64(0xFFFFFFFF)
        least = _sliding_min((hashed & ~low32) | np.arange(n, dtype=np.uint64), length - k + 1)
        valid = np.flatnonzero(np.arange(len(least)) + length <= np.repeat(bounds[1:], np.diff(bounds))[: len(least)])
        if not len(valid):
            return
        anchor = (least[valid] & low32).astype(np.int64)
        new = np.ones(len(valid), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1] + 1)
        first = np.flatnonzero(new)
        self.at, self.low = anchor[first], valid[first]
        self.high = valid[np.append(first[1:], len(valid)) - 1]
        self.key = hashed[self.at]

    def take(self, index: np.ndarray) -> None:
        self.at, self.low, self.high, self.key = self.at[index], self.low[index], self.high[index], self.key[index]

    def split(self, hot: np.ndarray, length: int, k: int) -> None:
        """Cut hot anchors' windows into ranges by place of the anchor, each keyed by the bytes that all of
        a range's windows hold. Ranges are short at both ends, where windows differ most."""
        is_hot = np.isin(self.key, hot)
        if not is_hot.any():
            return
        rest, mine = np.flatnonzero(~is_hot), np.flatnonzero(is_hot)
        span = length - k
        ends = sorted({min(2**i, span - span // 2) - 1 for i in range(span.bit_length() + 1)})
        starts = sorted({0, *(e + 1 for e in ends), *(span - e for e in ends)})
        out = [(self.at[rest], self.low[rest], self.high[rest], self.key[rest])]
        at, low, high, key = self.at[mine], self.low[mine], self.high[mine], self.key[mine]
        for i, j in zip(starts, [*starts[1:], span + 1]):  # windows that start i to j - 1 bytes before the anchor
            a, b = np.maximum(low, at - (j - 1)), np.minimum(high, at - i)
            some = a <= b
            core = K.span_hash(self.prefix, at[some] - i, at[some] - (j - 1) + length)
            out.append((at[some], a[some], b[some], K.mix(key[some] + np.uint64(i + 1)) ^ core))
        self.at, self.low, self.high, self.key = (np.concatenate(x) for x in zip(*out))


def _merge(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unite overlapping and touching intervals of each owner."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    if not len(owner):
        return owner, start, end
    big = int(end.max()) + 1
    reach = np.maximum.accumulate(end + owner * big) - owner * big  # the furthest end so far of the same owner
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return owner[first], start[first], reach[np.append(first[1:], len(owner)) - 1]


SCHEMA = "key long, context long, id long, hash long, start long, end long, bytes binary"
_NAMES = ["key", "context", "id", "hash", "start", "end", "bytes"]


def _batch(key, context, ids, hashes, start, end, data=None):
    """Rows of SCHEMA; without ``data`` they are covered intervals, with a null key."""
    n = len(start)
    if data is None:
        null = pa.nulls(n, pa.int64())
        columns = [null, null, pa.array(ids), pa.array(hashes), pa.array(start), pa.array(end), pa.nulls(n, pa.binary())]
    else:
        bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
        raw = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        columns = [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), pa.array(ids), pa.array(hashes), pa.array(start), pa.array(end), raw]
    return pa.RecordBatch.from_arrays(columns, _NAMES)


def _owners(ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers 0, 1, .. for the distinct (id, hash) in their order."""
    order = np.lexsort((hashes, ids))
    new = np.ones(len(order), bool)
    new[1:] = (ids[order[1:]] != ids[order[:-1]]) | (hashes[order[1:]] != hashes[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _covered_rows(ids, hashes, start, end):
    owner = _owners(ids, hashes)
    of, s, e = _merge(owner, start, end)
    sample = np.zeros(int(owner.max()) + 1 if len(owner) else 0, np.int64)
    sample[owner] = np.arange(len(owner))
    return _batch(None, None, ids[sample[of]], hashes[sample[of]], s, e)


class _Fold:
    """Collects contexts of a task and folds equal ones to the earliest."""

    def __init__(self):
        self.parts, self.bytes = [], 0

    def add(self, key, context, ids, hashes, start, end, data):
        self.parts.append((key, context, ids, hashes, start, end, data))
        self.bytes += len(data)

    def flush(self):
        if not self.parts:
            return
        key, context, ids, hashes, start, end, data = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.bytes = [], 0
        order = np.lexsort((start, hashes, ids, context, key))
        new = np.ones(len(order), bool)
        new[1:] = (key[order[1:]] != key[order[:-1]]) | (context[order[1:]] != context[order[:-1]])
        kept, again = order[new], order[~new]
        same = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[~new]]
        moved = (ids[again] != ids[same]) | (hashes[again] != hashes[same]) | (start[again] != start[same])
        again = again[moved]  # an equal row of the input is the same place
        if len(again):
            yield _covered_rows(ids[again], hashes[again], start[again], end[again])
        length = end - start
        first = np.cumsum(length) - length
        yield _batch(key[kept], context[kept], ids[kept], hashes[kept], start[kept], end[kept], data[K.ragged(first[kept], length[kept])])


# Shards --------------------------------------------------------------------------------------


class _Shard:
    """Distinct contexts with their windows in suffix order."""

    def __init__(self, ids, hashes, start, data, bounds, length):
        order = suffix_array(data)
        shared = common_prefixes(data, order, length)
        of = np.searchsorted(bounds, order, side="right") - 1
        window = order + length <= bounds[of + 1]
        run = np.cumsum(shared < length)[window]
        order, of = order[window], of[window]
        self.at, self.owner, self.place = order, of, start[of] + order - bounds[of]
        self.ids, self.hashes = ids[of], hashes[of]
        _, self.run = np.unique(run, return_inverse=True)
        self.data, self.length = data, length

    def earliest(self):
        """Index of the earliest window of every run."""
        order = np.lexsort((self.place, self.hashes, self.ids, self.run))
        new = np.ones(len(order), bool)
        new[1:] = self.run[order[1:]] != self.run[order[:-1]]
        return order[new]

    def strings(self, index):
        """The windows as fixed-width strings, in suffix order."""
        return np.lib.stride_tricks.sliding_window_view(self.data, self.length)[self.at[index]].copy().view(f"S{self.length}").ravel()

    def covered(self, ids, hashes, place):
        """Intervals of the windows that are not the earliest of their run, given each run's earliest."""
        later = (self.ids != ids[self.run]) | (self.hashes != hashes[self.run]) | (self.place != place[self.run])
        return self.ids[later], self.hashes[later], self.place[later], self.place[later] + self.length


def _earlier(a, b):
    """Where place a = (ids, hashes, starts) precedes place b."""
    return (a[0] < b[0]) | (a[0] == b[0]) & ((a[1] < b[1]) | (a[1] == b[1]) & (a[2] < b[2]))


def merge_shards(shards: list[_Shard]):
    """Covered intervals of several shards' windows: their sorted windows are merged by binary search."""
    firsts = [s.earliest() for s in shards]
    if len(shards) == 1:
        s, f = shards[0], firsts[0]
        return [s.covered(s.ids[f], s.hashes[f], s.place[f])]
    strings, places = None, None
    for s, f in zip(shards, firsts):
        mine, at = s.strings(f), (s.ids[f], s.hashes[f], s.place[f])
        if strings is None:
            strings, places = mine, at
            continue
        where = np.searchsorted(strings, mine)
        known = strings[np.minimum(where, len(strings) - 1)] == mine
        hit = where[known]
        sooner = _earlier(tuple(x[known] for x in at), tuple(x[hit] for x in places))
        for have, new in zip(places, at):
            have[hit[sooner]] = new[known][sooner]
        strings = np.insert(strings, where[~known], mine[~known])
        places = tuple(np.insert(have, where[~known], new[~known]) for have, new in zip(places, at))
    out = []
    for s, f in zip(shards, firsts):
        where = np.searchsorted(strings, s.strings(f))
        out.append(s.covered(*(x[where] for x in places)))
    return out


def _resolve(rows: list, length: int, shard_bytes: int):
    """Covered rows for contexts sorted by (key, context, id, hash, start), whole keys only."""
    key, context, ids, hashes, start, data, bounds = rows
    n = len(key)
    size = np.diff(bounds)
    new = np.ones(n, bool)
    new[1:] = (key[1:] != key[:-1]) | (context[1:] != context[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    again = np.flatnonzero(~new & ((ids != ids[first]) | (hashes != hashes[first]) | (start != start[first])))
    found = [(ids[again], hashes[again], start[again], start[again] + size[again])]
    kept = np.flatnonzero(new)
    of = np.cumsum(np.concatenate([[True], key[kept][1:] != key[kept][:-1]])) - 1
    # One context alone needs the shard too if a window can lie in it twice.
    several = np.bincount(of)[of] > 1
    kept, of = kept[several | (size[kept] > length)], of[several | (size[kept] > length)]

    def shard(index):
        flat = data[K.ragged(bounds[index], size[index])]
        return _Shard(ids[index], hashes[index], start[index], flat, np.concatenate([[0], np.cumsum(size[index])]), length)

    edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, np.int64)
    held: list = []
    weight = 0
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        mine = int(size[kept[a:b]].sum())
        if mine > shard_bytes:
            cuts = np.searchsorted(np.cumsum(size[kept[a:b]]), np.arange(shard_bytes, mine, shard_bytes)) + a
            found += merge_shards([shard(x) for x in np.split(kept[a:b], cuts - a) if len(x)])
            continue
        held.append(kept[a:b])
        weight += mine
        if weight >= shard_bytes:
            found += merge_shards([shard(np.concatenate(held))])
            held, weight = [], 0
    if held:
        found += merge_shards([shard(np.concatenate(held))])
    ids, hashes, start, end = (np.concatenate(x) for x in zip(*found))
    if len(ids):
        yield _covered_rows(ids, hashes, start, end)


# The job -------------------------------------------------------------------------------------


def covered_intervals(texts: DataFrame, length: int = LENGTH, k: int = ANCHOR, shard_bytes: int = SHARD_BYTES, hot_least: int = HOT_LEAST) -> DataFrame:
    """(id, hash, start, end): bytes of each text to remove, as intervals that may overlap.

    ``texts`` has (id long not null, hash long, text); distinct texts only.
    """
    spark = texts.sparkSession

    def count(batches):
        held, n = [], 0

        def report():
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], ["key", "n"])

        for batch in batches:
            for _, _, data, bounds in _pieces(batch.column(0), length):
                held.append(_Anchors(data, bounds, length, k).key)
                n += len(held[-1])
                if n >= 1 << 20:
                    yield report()
                    held, n = [], 0
        if n:
            yield report()

    counts = texts.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1")
    counts = stage(counts, "suffix-anchors")
    repeated = counts.count()
    bits = min(max(1 << max(16 * repeated - 1, 1).bit_length(), LEAST_BITS), MOST_BITS)
    slot = F.col("key").bitwiseAND(F.lit(bits - 1))
    words = counts.select(F.shiftrightunsigned(slot, 6).alias("word"), F.expr(f"shiftleft(1L, cast(key & {63} as int))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most bits / 64 rows
    filled = np.zeros(bits // 64, np.uint64)
    filled[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    hot = counts.filter(F.col("n") > hot_least).orderBy(F.desc("n"), "key").limit(MOST_HOT).select("key").toArrow()
    shared = spark.sparkContext.broadcast((filled, np.sort(hot.column("key").to_numpy().view(np.uint64))))

    def contexts(batches):
        bitmap, hot_keys = shared.value
        mask = np.uint64(len(bitmap) * 64 - 1)
        fold = _Fold()
        for batch in batches:
            ids, hashes = (batch.column(i).to_numpy() for i in (0, 1))
            for rows, base, data, bounds in _pieces(batch.column(2), length):
                a = _Anchors(data, bounds, length, k)
                place = a.key & mask
                a.take(np.flatnonzero(bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)))
                if not len(a.at):
                    continue
                a.split(hot_keys, length, k)
                end = a.high + length
                context = K.span_hash(a.prefix, a.low, end) + (a.at - a.low).astype(np.uint64)
                text = np.searchsorted(bounds, a.low, side="right") - 1
                shift = base[text] - bounds[text]
                fold.add(a.key, context, ids[rows[text]], hashes[rows[text]], a.low + shift, end + shift, data[K.ragged(a.low, end - a.low)])
                if fold.bytes >= FOLD_BYTES:
                    yield from fold.flush()
        yield from fold.flush()

    made = stage(texts.select("id", "hash", "text").mapInArrow(contexts, SCHEMA), "suffix-contexts")
    direct = made.filter("key IS NULL").select("id", "hash", "start", "end")

    def resolve(batches):
        held, weight = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            arrays = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            data, bounds = K.utf8(batch.column(6))
            held.append([*arrays, data, bounds])
            weight += len(data)
            if weight < 2 * shard_bytes:
                continue
            rows = _concatenate(held)
            key = rows[0]
            cut = int(np.searchsorted(key, key[-1], side="left"))  # the last key may go on in the next batch
            if cut:
                yield from _resolve(_slice(rows, 0, cut), length, shard_bytes)
                rows = _slice(rows, cut, len(key))
            held, weight = [rows], int(len(rows[5])) if cut else 0
        if held:
            yield from _resolve(_concatenate(held), length, shard_bytes)

    sorted_ = made.filter("key IS NOT NULL").repartition(F.col("key")).sortWithinPartitions("key", "context", "id", "hash", "start")
    found = sorted_.select(*_NAMES).mapInArrow(resolve, SCHEMA).select("id", "hash", "start", "end")
    return direct.union(found)


def _concatenate(parts: list) -> list:
    if len(parts) == 1:
        return parts[0]
    columns = [np.concatenate([p[i] for p in parts]) for i in range(6)]
    sizes = np.concatenate([np.diff(p[6]) for p in parts])
    return [*columns, np.concatenate([[0], np.cumsum(sizes)])]


def _slice(rows: list, a: int, b: int) -> list:
    bounds = rows[6]
    return [*(x[a:b] for x in rows[:5]), rows[5][bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]]


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    k: int = ANCHOR,
    shard_bytes: int = SHARD_BYTES,
    hot_least: int = HOT_LEAST,
    with_bytes: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans[, kept]), one row for every row of ``docs``.

    ``spans`` are the maximal removed runs as (start, end) in bytes; ``kept`` are the bytes that stay.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.col(id_col).alias("own_id"), text.alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("row", F.xxhash64("id", "hash"))
    digests = stage(rows.filter(F.octet_length("text") >= length).select("id", "row", F.octet_length("text").cast("long").alias("end"), "hash", F.sha2(F.col("text").cast("binary"), 256).alias("digest")), "suffix-digests")
    copies = join_summary(digests, "digest", F.min("id").alias("first")).filter("id > first")
    copies = stage(copies.select("id", "row", "hash", "end"), "suffix-copies")
    long_ = rows.filter(F.octet_length("text") >= length)
    found = covered_intervals(drop_ids(long_, "row", copies.select("row")), length, k, shard_bytes, hot_least)
    found = found.union(copies.select("id", "hash", F.lit(0).cast("long"), "end"))
    spans = found.groupBy(F.xxhash64("id", "hash").alias("row")).agg(F.collect_list(F.struct("start", "end")).alias("spans"))

    def cut(batches):
        for batch in batches:
            texts, given = batch.column(1), batch.column(2)
            n_bytes, removed, n_spans, sha, spans, kept = [], [], [], [], [], []
            flat = given.combine_chunks() if isinstance(given, pa.ChunkedArray) else given
            inner = flat.values
            starts, ends = inner.field(0).to_numpy(), inner.field(1).to_numpy()
            offsets, valid = flat.offsets.to_numpy(), flat.is_valid().to_numpy(zero_copy_only=False)
            data, bounds = K.utf8(texts)
            for i in range(batch.num_rows):
                raw = data[bounds[i] : bounds[i + 1]]
                own = slice(offsets[i], offsets[i + 1]) if valid[i] else slice(0, 0)
                _, s, e = _merge(np.zeros(own.stop - own.start, np.int64), starts[own], ends[own])
                stay = raw
                if len(s):
                    mask = np.ones(len(raw), bool)
                    for x, y in zip(s.tolist(), e.tolist()):
                        mask[x:y] = False
                    stay = raw[mask]
                n_bytes.append(len(raw))
                removed.append(len(raw) - len(stay))
                n_spans.append(len(s))
                sha.append(hashlib.sha256(stay.tobytes()).hexdigest())
                spans.append([{"start": x, "end": y} for x, y in zip(s.tolist(), e.tolist())])
                if with_bytes:
                    kept.append(stay.tobytes())
            out = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
            names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if with_bytes:
                out.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>" + ", kept binary" * with_bytes
    return rows.join(spans, "row", "left").select("own_id", "text", "spans").mapInArrow(cut, schema)
