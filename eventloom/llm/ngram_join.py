"""Operator 9, n-gram Jaccard join by grouped prefixes.

A document's set holds the 64-bit hashes of its distinct shingles of ``words``
words (A-Z lower-cased). Two documents link when their sets' Jaccard
similarity is at least ``percent`` / 100.

1. Equal sets are one class. Shingles are ordered by hash, but frequent ones
   come last. The first n - ceil(t n) + 1 shingles of a set are its prefix;
   linked sets share one. To tell frequent ones, each document's shingles are
   counted as far as its prefix may reach; then those of the final prefixes are
   counted, to tell which no other prefix holds.
2. Classes with the same prefix and size form a group. Only groups meet in the
   join: a (shingle, group) row for every prefix shingle of at least two groups.
3. Group pairs are filtered by size and by the number of prefix shingles they
   share, then expanded to members, which are verified on their whole sets.

A family of near copies shares its whole prefix, so pairing all of it would
cost the square of its size. Hence pairs are made in turns. First every group is paired
with one other, members of a group with the group's first (those left without a
link with a new first), and then every component with one other; the links found that way give classes a hub at a
known distance. Only shingles and groups whose classes still lie in different
components are joined, hub against hub. For sets, 1 - Jaccard is a
metric: members a, b of hubs h, k can link only if d(h, k) <= 1 - t + d(a, h) +
d(b, k). Pairs of hubs that this cannot rule out are expanded to those members whose
own distances do not rule them out either. No link between different components is lost.

Families that are similar, but not enough to link, share prefixes too. Every class has a
sketch, the parity of how many of its shingles fall in each of ``SKETCH`` slots. A shingle
that only one of two sets holds flips one slot, so they differ in at least as many shingles
as their sketches in slots. That bound is part of the joins' conditions.

Null and empty texts have an empty set, link with nothing and are components of
their own. A text with fewer words has its whole sequence as its one shingle.
Rows that repeat an id, or have a null id, are documents of their own; null ids
come after all others. Rows are told apart by number. Empty tables give empty
results; extra columns are not read. Shingles, sets and groups are told apart
by 64-bit hashes (sets by 128).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.common import discard, doc_column, drop_ids, keep_ids, number_rows, stage
from eventloom.llm.components import components, merged

WORDS = 5
PERCENT = 80
#: Shingles counted at a time by a task.
CHUNK = 1 << 21
#: A set's shingles are counted this many times as far as its prefix reaches.
REACH = 1.3
#: A shingle that so many documents hold is demoted, if it is among the most frequent ones.
FREQUENT = 12
#: Groups that a group is compared with in the first turn.
PARTNERS = 3
#: Times that members of a group without a link are paired with a new first, before the turns.
STARS = 2
#: Turns in which hubs meet the representatives of their shingles.
TURNS = 2
MOST_FREQUENT = 1 << 20
#: Slots of a class's sketch, 64 to a column.
SKETCH = 512
_SKETCH_COLUMNS = [f"s{i}" for i in range(SKETCH // 64)]
#: Bits of the filter on repeated shingles (16 for each, within these bounds).
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28


def _sets(column: pa.Array, words: int):
    """The sorted shingle hashes of each text."""
    for _, data, bounds in K.blocks(column, K.SMALL_BLOCK):
        text, hashes = K.shingles(data, bounds, words)
        yield from np.split(hashes, np.searchsorted(text, np.arange(1, len(bounds) - 1)))


def _prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _counted(n: int, percent: int) -> int:
    """How many of a set's shingles, by hash, are counted."""
    return min(n, int(REACH * _prefix_length(n, percent)) + 1)


def _prefix(s: np.ndarray, percent: int, often: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The prefix of a sorted set, given the frequent shingles and their counts."""
    take = _prefix_length(len(s), percent)
    if len(often):
        at = np.minimum(np.searchsorted(often, s), len(often) - 1)
        held = np.where(often[at] == s, times[at], 0)
        if held.any():
            return s[np.lexsort((s, held))[:take]]
    return s[:take]


class Frequencies:
    """What is known of shingles' document counts: the frequent ones, and which two prefixes hold.

    Every set is counted as far as its prefix reaches. Where so many of those are
    frequent that demoting them makes the prefix reach further (families of
    copies, texts made of common passages), a second pass counts the set whole.
    That makes the list of frequent ones, which fixes every prefix; a last pass
    counts the prefixes. Both tables have a bounded size. A frequent shingle that
    is not listed and a shingle that wrongly counts as repeated make the join
    slower, not different.
    """

    def __init__(self, docs: DataFrame, words: int, percent: int):
        spark = docs.sparkSession
        self.words, self.percent = words, percent
        self.often, self.times = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        counts = stage(self._count(docs, lambda s: s[: _counted(len(s), percent)]), "join-counts")
        self._list(counts)
        deep = spark.sparkContext.broadcast((self.often, self.times))

        def whole(s):
            often, _ = deep.value
            reach = s[: _counted(len(s), percent)]
            at = np.minimum(np.searchsorted(often, reach), len(often) - 1)
            return s if len(reach) - int((often[at] == reach).sum()) < _prefix_length(len(s), percent) else s[:0]

        if len(self.often):
            further = stage(self._count(docs, whole), "join-counts-deep")
            self._list(counts.union(further).groupBy("shingle").agg(F.max("n").alias("n")))
            discard(further)
        discard(counts)
        listed = spark.sparkContext.broadcast((self.often, self.times))
        counts = stage(self._count(docs, lambda s: _prefix(s, percent, *listed.value)), "join-counts-prefix")
        bits = min(max(1 << max(16 * counts.count() - 1, 1).bit_length(), LEAST_BITS), MOST_BITS)
        slot = F.col("shingle").bitwiseAND(F.lit(bits - 1))
        filled = counts.select(F.shiftrightunsigned(slot, 6).alias("word"), F.expr("shiftleft(1L, cast(shingle & 63 as int))").alias("bit"))
        filled = filled.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # at most bits / 64 rows
        self.bitmap = np.zeros(bits // 64, np.uint64)
        self.bitmap[filled.column("word").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)

    def _count(self, docs: DataFrame, part) -> DataFrame:
        """(shingle, n) of what ``part`` takes of each set, without those of one document."""
        words = self.words

        def count(batches):
            held, n = [], 0

            def report():
                values, counts = np.unique(np.concatenate(held), return_counts=True)
                return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["shingle", "n"])

            for batch in batches:
                for s in _sets(batch.column(0), words):
                    taken = part(s) if len(s) else s
                    if len(taken):
                        held.append(taken)
                        n += len(taken)
                if n >= CHUNK:
                    yield report()
                    held, n = [], 0
            if held:
                yield report()

        counted = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        return counted.filter("n > 1")

    def _list(self, counts: DataFrame) -> None:
        top = counts.filter(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "shingle").limit(MOST_FREQUENT).toArrow()
        values = top.column("shingle").to_numpy().view(np.uint64)
        order = np.argsort(values)
        self.often, self.times = values[order], top.column("n").to_numpy()[order].astype(np.int32)

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the prefix of a sorted set, places in it of shingles that may be in another prefix)."""
        prefix = _prefix(s, self.percent, self.often, self.times)
        place = prefix & np.uint64(len(self.bitmap) * 64 - 1)
        twice = self.bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1) == 1
        return prefix, np.flatnonzero(twice)


def _digest(*arrays: np.ndarray) -> tuple[int, int]:
    h = hashlib.blake2b(digest_size=16)
    for x in arrays:
        h.update(x.tobytes())
    raw = h.digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in the slots, as 64-bit words."""
    odd = (np.bincount((s >> np.uint64(13)) & np.uint64(SKETCH - 1), minlength=SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


def _may_be_within(x: str, y: str, n_x: Column, n_y: Column, distance: Column) -> Column:
    """Whether sets of these sizes and sketches can be at most so far apart. At 1 - Jaccard = d they differ in
    d * (n_x + n_y) / (2 - d) shingles."""
    apart = sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in _SKETCH_COLUMNS), F.lit(0))
    return (distance >= 1) | (apart <= distance * (n_x + n_y) / (2 - distance) + 1e-6)


def prefix_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(row, id, n, set_key, set_rest, group, prefix, places, sketch columns) for every document; keys are null for empty sets.

    ``prefix`` leaves out shingles that no other prefix holds; ``places`` are where the others stand in it.
    """
    row_kind, kind = (docs.schema[c].dataType.simpleString() for c in ("row", "id"))
    known = docs.sparkSession.sparkContext.broadcast(Frequencies(docs, words, percent))

    def rows(batches):
        frequencies = known.value
        for batch in batches:
            n, key, rest, group, prefixes, places, sketches = [], [], [], [], [], [], []
            for s in _sets(batch.column(2), words):
                n.append(len(s))
                sketches.append(_sketch(s))
                if not len(s):
                    for column in (key, rest, group):
                        column.append(None)
                    prefixes.append(s)
                    places.append(np.zeros(0, np.int64))
                    continue
                prefix, at = frequencies.prefix(s)
                a, b = _digest(s)
                key.append(a)
                rest.append(b)
                group.append(_digest(prefix, np.array([len(s)]))[0])
                prefixes.append(prefix[at])
                places.append(at)
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            at = np.concatenate(places).astype(np.int64) if places else np.zeros(0, np.int64)
            lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (flat, at)]
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(key, pa.int64()), pa.array(rest, pa.int64()), pa.array(group, pa.int64())]
            sketch = np.array(sketches, np.int64).reshape(len(n), len(_SKETCH_COLUMNS)).T
            yield pa.RecordBatch.from_arrays([*columns, *lists, *map(pa.array, sketch)], ["row", "id", "n", "set_key", "set_rest", "group", "prefix", "places", *_SKETCH_COLUMNS])

    return docs.select("row", "id", "text").mapInArrow(rows, f"row {row_kind}, id {kind}, n long, set_key long, set_rest long, group long, prefix array<long>, places array<long>, " + ", ".join(f"{c} long" for c in _SKETCH_COLUMNS))


def _ceil(numerator: Column, denominator: int) -> Column:
    return F.floor((numerator + F.lit(denominator - 1)) / F.lit(denominator))


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (a * 100 >= b * percent) & (b * 100 >= a * percent)


def _within_reach(place: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether a shingle at ``place`` of a set of size ``a`` can be the first that it shares with a
    linked set of size ``b``: what follows must hold all they need to share."""
    return place <= a - _ceil((a + b) * percent, 100 + percent)


def _enough_shared(shared: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether prefixes share enough for their sets to link: what they do not share is at most
    all that follows the prefix of one of them."""
    behind = F.greatest(_ceil(a * percent, 100), _ceil(b * percent, 100)) - 1
    return shared >= _ceil((a + b) * percent, 100 + percent) - behind


class _Verifier:
    """Exact similarity of pairs of classes, on sets read again from their documents' texts."""

    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int):
        self.docs, self.classes, self.words, self.percent = docs, classes, words, percent

    def sets(self, keys: DataFrame) -> DataFrame:
        words = self.words
        wanted = self.classes.join(keys.distinct(), "set_key", "left_semi").select("row")

        def rows(batches):
            for batch in batches:
                found = [s for s in _sets(batch.column(1), words) if len(s)]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
                flat = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
                keys = pa.array([_digest(s)[0] for s in found], pa.int64())
                yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["key", "set"])

        return stage(keep_ids(self.docs.select("row", "text"), "row", wanted).mapInArrow(rows, "key long, set array<long>"), "join-sets")

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """Distinct (a, b) pairs with (near, distance): whether they link, and 1 - similarity."""
        pairs = stage(pairs.select("a", "b").distinct(), "join-pairs")
        sets = self.sets(pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")))
        left = sets.select(F.col("key").alias("a"), F.col("set").alias("set_a"))
        right = sets.select(F.col("key").alias("b"), F.col("set").alias("set_b"))
        both = pairs.join(left, "a").join(right, "b")
        common = both.select("a", "b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("common"), (F.size("set_a") + F.size("set_b")).cast("long").alias("sizes"))
        union = F.col("sizes") - F.col("common")
        near = (F.col("common") * 100 >= union * self.percent).alias("near")
        verified = common.select("a", "b", near, (1 - F.col("common") / union).alias("distance"))
        verified = stage(verified.dropDuplicates(["a", "b"]), "join-verified")  # a key that two sets share by chance
        discard(sets)
        discard(pairs)
        return verified


def linked_classes(docs: DataFrame, prefixes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) over the set keys that have a link; ``docs`` has (row, id, text)."""
    classes = stage(prefixes.filter("n > 0").groupBy("set_key", "set_rest").agg(F.min("row").alias("row"), F.min("n").alias("n"), F.min("group").alias("group"), *(F.min(c).alias(c) for c in _SKETCH_COLUMNS)).drop("set_rest"), "join-classes")
    groups = stage(classes.groupBy("group").agg(F.min("set_key").alias("first"), F.min("n").alias("n"), F.count("*").alias("members")), "join-groups")
    verify = _Verifier(docs, classes, words, percent)
    slack = 1 - percent / 100 + 1e-9

    # (shingle, group, n, place, lowest group of that shingle) for shingles of at least two groups.
    firsts = groups.select(F.col("first").alias("set_key"), "group").join(classes.select("set_key", "row"), "set_key").select("row", "set_key")
    own = stage(prefixes.join(firsts, ["row", "set_key"], "left_semi").select("set_key", "group", "n", "prefix", "places"), "join-own")
    tokens = own.select("group", "n", F.explode(F.arrays_zip("prefix", "places")).alias("t")).select("group", "n", F.col("t.prefix").alias("shingle"), F.col("t.places").alias("place"))
    spread = tokens.groupBy("shingle").agg(F.min(F.struct("group", "n")).alias("low"), F.max("group").alias("high")).filter("low.group < high")
    # A row stays if another group of its shingle has a size that can link; in order of size that is a neighbour.
    by_size = Window.partitionBy("shingle").orderBy("n", "group")
    near_size = _sizes_fit(F.col("n"), F.lag("n").over(by_size), percent) | _sizes_fit(F.col("n"), F.lead("n").over(by_size), percent)
    rows = tokens.join(spread, "shingle").select("shingle", "group", "n", "place", F.col("low.group").alias("low"), F.col("low.n").alias("low_n"))
    shared = stage(rows.withColumn("kept", near_size).filter("kept").drop("kept"), "join-shared")

    # First turn: each group against the few others, of the lowest groups of its shingles, with which it
    # shares most; members against their group's first.
    to_low = shared.filter("group <> low").filter(_sizes_fit(F.col("n"), F.col("low_n"), percent))
    to_low = to_low.groupBy("group", "low").agg(F.count("*").alias("shared"), F.min("n").alias("n"), F.min("low_n").alias("low_n"))
    to_low = to_low.filter(_enough_shared(F.col("shared"), F.col("n"), F.col("low_n"), percent))
    most = F.slice(F.sort_array(F.collect_list(F.struct("shared", "low")), asc=False), 1, PARTNERS)
    to_low = to_low.groupBy("group").agg(most.alias("lows")).select("group", F.explode("lows.low").alias("low"))
    first_of = groups.select(F.col("group").alias("low"), F.col("first").alias("b"))
    pairs = to_low.join(classes.select("group", F.col("set_key").alias("a")), "group").join(first_of, "low").select("a", "b")
    inside = classes.join(groups.filter("members > 1").select("group", "first"), "group").filter("set_key <> first").select(F.col("set_key").alias("a"), F.col("first").alias("b"))
    star = verify(pairs.union(inside))
    # Members that have no link yet get a first of their own, some times: without that a family whose
    # first is a stranger would meet all against all.
    tried = groups.select(F.col("first").alias("set_key"))
    for _ in range(STARS):
        linked = star.filter("near")
        done = tried.union(linked.select("a")).union(linked.select("b")).distinct()
        alone = classes.join(groups.filter("members > 1").select("group"), "group").join(done, "set_key", "left_anti").select("group", "set_key")
        again = alone.join(alone.groupBy("group").agg(F.min("set_key").alias("b")), "group").select(F.col("set_key").alias("a"), "b")
        again = stage(again, "join-alone")
        if again.isEmpty():
            break
        tried = tried.union(again.select("b"))
        star = stage(star.union(verify(again.filter("a <> b"))), "join-star")
    links = star.filter("near").select("a", "b")

    # Hubs: of the classes that a class is linked to, the lowest that has no such link itself.
    linked = star.filter("near")
    roots = linked.join(linked.select(F.col("a").alias("b")).distinct(), "b", "left_anti")
    hub_of = roots.groupBy(F.col("a").alias("set_key")).agg(F.min(F.struct("b", "distance")).alias("h"))
    # All members of a group share its prefix; one row stands for it, so that members in different
    # components meet also where no other group holds any of its shingles.
    together = groups.filter("members > 1").select(F.col("group").alias("shingle"), "group", F.lit(0).cast("long").alias("place"))

    def hubs_of(found):
        """Classes with hub and component, hubs, and a row per shingle, hub where components still meet."""
        members = (
            classes.join(hub_of, "set_key", "left")
            .join(found.withColumnRenamed("node", "set_key"), "set_key", "left")
            .select("set_key", "group", "n", *_SKETCH_COLUMNS, F.coalesce("h.b", "set_key").alias("hub"), F.coalesce("h.distance", F.lit(0.0)).alias("radius"), F.coalesce("component", "set_key").alias("component"))
        )
        members = stage(members, "join-members")
        hubs = members.groupBy("hub").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max("radius").alias("radius"), F.count("*").alias("members"))
        hubs = hubs.join(classes.select(F.col("set_key").alias("hub"), F.col("n").alias("n_hub"), *_SKETCH_COLUMNS), "hub")
        rows = shared.select("shingle", "group", "place").union(together).join(members.select("group", "hub", "component"), "group")
        rows = rows.groupBy("shingle", "hub", "component").agg(F.min("place").alias("place"))
        ends = rows.groupBy("shingle").agg(F.min(F.struct("component", "hub")).alias("lo"), F.max(F.struct("component", "hub")).alias("hi")).filter("lo.component < hi.component")
        return members, hubs, stage(rows.join(ends, "shingle").drop("lo", "hi"), "join-open")

    def meets(x: str, y: str) -> Column:
        return (F.col(f"{x}n_min") * percent <= F.col(f"{y}n_max") * 100) & (F.col(f"{y}n_min") * percent <= F.col(f"{x}n_max") * 100)

    # The same again, some times, for hubs: each against the one of the hubs that stand for its shingles, another
    # one each time, with which it shares most, if their sketches allow a link. A family of classes that all link
    # meets its representative here, without a join of all with all.
    hub_of = stage(hub_of, "join-hubs")
    found = components(links)
    members, hubs, rows = hubs_of(found)
    for turn in range(TURNS):
        if rows.isEmpty():
            break
        open_rows = rows.select("shingle", "hub", "component")
        stands = open_rows.groupBy("shingle").agg(F.min(F.struct(F.xxhash64("hub", F.lit(turn)).alias("h"), "component", "hub")).alias("rep"))
        tried = open_rows.join(stands, "shingle").filter("component <> rep.component")
        tried = tried.groupBy("hub", F.col("rep.hub").alias("rep")).agg(F.count("*").alias("shared"))
        own_side, rep_side = hubs.alias("x"), hubs.alias("y")
        fits = tried.join(own_side, tried["hub"] == F.col("x.hub")).join(rep_side, tried["rep"] == F.col("y.hub"))
        fits = fits.filter(_sizes_fit(F.col("x.n_hub"), F.col("y.n_hub"), percent) & _may_be_within("x.", "y.", F.col("x.n_hub"), F.col("y.n_hub"), F.lit(slack)))
        best = fits.groupBy(tried["hub"].alias("a")).agg(F.max(F.struct(tried["shared"], tried["rep"].alias("b"))).alias("t"))
        fresh = stage(verify(best.select("a", "t.b")).filter("near").select("a", "b"), "join-links")
        if not fresh.isEmpty():
            found = merged(found, fresh)
            discard(rows)
            discard(members)
            members, hubs, rows = hubs_of(found)

    if rows.isEmpty():
        for table in (classes, groups, own, shared, members, rows):
            discard(table)
        return found

    # Second turn: hub against hub, over shingles that still join different components.
    rows_open = rows
    rows = stage(rows_open.join(hubs, "hub"), "join-open-hubs")
    x, y = rows.alias("x"), rows.alias("y")
    meet = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.hub") < F.col("y.hub")) & (F.col("x.component") != F.col("y.component"))
    meet &= meets("x.", "y.")
    meet &= _within_reach(F.col("x.place"), F.col("x.n_max"), F.col("y.n_min"), percent)
    meet &= _within_reach(F.col("y.place"), F.col("y.n_max"), F.col("x.n_min"), percent)
    meet &= _may_be_within("x.", "y.", F.col("x.n_hub"), F.col("y.n_hub"), slack + F.col("x.radius") + F.col("y.radius"))
    met = x.join(y, meet).groupBy(F.col("x.hub").alias("a"), F.col("y.hub").alias("b")).agg(*(F.min(f"{s}.{c}").alias(f"{c}_{s}") for s in "xy" for c in ("n_min", "members", "radius")))
    single = (F.col("members_x") == 1) & (F.col("members_y") == 1)
    prefix_of = lambda s: own.select(F.col("set_key").alias(s), F.col("prefix").alias(f"prefix_{s}"))
    both = met.join(prefix_of("a"), "a", "left").join(prefix_of("b"), "b", "left")
    known = F.col("prefix_a").isNotNull() & F.col("prefix_b").isNotNull()
    enough = _enough_shared(F.size(F.array_intersect("prefix_a", "prefix_b")), F.col("n_min_x"), F.col("n_min_y"), percent)
    met = stage(both.filter(~single | ~known | enough).drop("prefix_a", "prefix_b"), "join-met")
    across = verify(met)
    found = merged(found, across.filter("near").select("a", "b"))

    # Pairs of hubs too close to rule out: members against the other hub, then members that remain.
    close = met.join(across.filter("NOT near"), ["a", "b"]).filter(~single & (F.col("distance") <= slack + F.col("radius_x") + F.col("radius_y")))
    close = stage(close.select("a", "b", "distance", "radius_x", "radius_y"), "join-close")
    if not close.isEmpty():
        of = members.select("hub", F.col("set_key").alias("member"), "n", "radius", *_SKETCH_COLUMNS)
        hub = classes.select(F.col("set_key").alias("other"), F.col("n").alias("n_other"), *(F.col(c).alias(f"o_{c}") for c in _SKETCH_COLUMNS))

        def against(own: str, other: str, beyond: str) -> DataFrame:
            """(member, other) of one side's members that may link with a member of the other hub."""
            sides = close.select(F.col(own).alias("hub"), F.col(other).alias("other"), "distance", F.col(beyond).alias("reach")).join(hub, "other")
            able = (F.col("s.hub") == F.col("m.hub")) & (F.col("m.member") != F.col("m.hub"))
            able &= F.col("s.distance") <= slack + F.col("m.radius") + F.col("s.reach")
            able &= _may_be_within("m.", "s.o_", F.col("m.n"), F.col("s.n_other"), slack + F.col("s.reach"))
            return sides.alias("s").join(of.alias("m"), able).select("m.member", "s.other")

        half = against("a", "b", "radius_y").union(against("b", "a", "radius_x")).toDF("a", "b")
        halves = verify(half)
        found = merged(found, halves.filter("near").select("a", "b"))
        label = found.select(F.col("node").alias("set_key"), "component")
        tagged = of.join(label, of["member"] == label["set_key"], "left").drop("set_key").withColumn("component", F.coalesce("component", "member"))
        # Distances of members to the other hub; the hubs themselves are members too.
        far = halves.select(F.col("a").alias("member"), F.col("b").alias("other"), F.col("distance").alias("far"))
        far = far.union(close.select("a", "b", "distance")).union(close.select("b", "a", "distance"))
        tagged = tagged.join(far, "member")
        side = lambda own, other, mark: close.select("a", "b", *([f"radius_{mark}"])).join(tagged.drop("radius"), (F.col(own) == F.col("hub")) & (F.col(other) == F.col("other"))).drop("hub", "other")
        left, right = side("a", "b", "y").alias("x"), side("b", "a", "x").alias("y")
        able = (F.col("x.a") == F.col("y.a")) & (F.col("x.b") == F.col("y.b")) & (F.col("x.component") != F.col("y.component"))
        able &= _sizes_fit(F.col("x.n"), F.col("y.n"), percent) & (F.col("x.far") <= slack + F.col("x.radius_y")) & (F.col("y.far") <= slack + F.col("y.radius_x"))
        able &= _may_be_within("x.", "y.", F.col("x.n"), F.col("y.n"), F.lit(slack))
        rest = verify(left.join(right, able).select(F.col("x.member").alias("a"), F.col("y.member").alias("b")))
        found = merged(found, rest.filter("near").select("a", "b"))
    for table in (classes, groups, own, shared, members, rows_open, rows, met, close):
        discard(table)
    return found


def row_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(row, id, n, lowest) for every row of (row, id, text); ``lowest`` holds the smallest id that links
    reach and the smallest row of that id. Null ids come last."""
    prefixes = stage(prefix_rows(docs, words, percent), "join-prefixes")
    found = linked_classes(docs, prefixes, words, percent)
    own = F.struct(F.col("id").isNull().alias("missing"), "id", "row")
    classes = prefixes.filter("n > 0").groupBy("set_key", "set_rest").agg(F.min(own).alias("first"))
    labelled = classes.join(found, classes["set_key"] == found["node"], "left").select("set_key", "set_rest", "first", F.coalesce("component", "set_key").alias("component"))
    # A class without links keeps its own first id: distinct sets never share a label by chance.
    alone = found.select(F.col("node").alias("set_key"), F.lit(True).alias("in_link"))
    labelled = labelled.join(alone, "set_key", "left")
    lowest = labelled.filter("in_link").groupBy("component").agg(F.min("first").alias("lowest"))
    labelled = labelled.join(lowest, "component", "left").select("set_key", "set_rest", F.when(F.col("in_link"), F.col("lowest")).otherwise(F.col("first")).alias("lowest"))
    full = prefixes.filter("n > 0").select("row", "id", "n", "set_key", "set_rest").join(labelled, ["set_key", "set_rest"])
    empty = prefixes.filter("n = 0")
    return full.select("row", "id", "n", "lowest").union(empty.select("row", "id", "n", own.alias("lowest")))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id), one row for every row of ``docs``; component_id is the
    smallest id that links reach, null only if all of them are."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    narrow = stage(narrow.withColumn("row", F.monotonically_increasing_id()), "join-rows")
    found = row_components(narrow.select("row", "id", "text"), words, percent)
    return found.select("id", "n", "lowest.id").toDF(id_col, "n_shingles", "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, that of the smallest id; documents without words stay.
    Rows are told apart by number, as ids may repeat; all columns stay, whatever their names."""
    rows = number_rows(docs, "join-rows")
    narrow = rows.select(F.col("__row").alias("row"), doc_column(id_col).alias("id"), doc_column(text_col).cast("string").alias("text"))
    found = row_components(narrow, words, percent)
    lost = stage(found.filter("row <> lowest.row").select("row"), "join-lost")
    return drop_ids(rows, "__row", lost).select("doc.*")
