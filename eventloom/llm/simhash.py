"""Operator 13, SimHash near-dedup by pigeonhole blocks.

A text is lower-cased (A-Z) and cut into words; every shingle of ``SHINGLE``
words, repeats included, is hashed with XXH64 (seed 42). A bit of the 64-bit
fingerprint is 1 if it is set in over half of the hashes. Fingerprints with at
most ``distance`` differing bits link.

Rows with one fingerprint are one class; everything after that is on distinct
fingerprints. The 64 bits are cut into ``blocks`` blocks. Two fingerprints that
differ in at most ``distance`` bits agree on at least ``blocks - distance``
whole blocks, so each is put in one bucket for every choice of that many blocks
(6 blocks, distance 3: 20 buckets of about 32 bits), and linked ones share a
bucket. Members of a bucket are verified by Hamming distance.

A bucket may hold a large family of near copies, so it is not paired all
against all. In a few turns every member is verified against one hub of its
bucket, another hub each turn, which costs one row per member and puts families
into components. Only buckets whose members still lie in different components
are then joined, and only across components: such a link is never lost, one
inside a component changes nothing.

Null and empty texts and texts without words have fingerprint zero and link like
any other; a text with fewer words has its whole sequence as its one shingle.
Very long texts are read in pieces of some MB. Rows that repeat an id are rows
of their own; a null id comes after all others, so ``component_id`` is null only
if all ids of a component are. Empty tables give empty results; extra columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import discard, stage
from eventloom.llm.components import components, merged
from eventloom.llm.exact_dedup import COUNTERS, frequent_keys

SHINGLE, SEED = 3, 42
DISTANCE, BLOCKS = 3, 6
#: Turns in which members of a bucket are verified against one hub.
TURNS = 3
#: Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_lists(raw: bytes, piece: int) -> Iterator[list[bytes]]:
    """The words of a text, in order, some MB of text at a time."""
    at = 0
    while at < len(raw):
        end = at + piece
        if end < len(raw):
            gap = _SPACE.search(raw, end)
            end = gap.start() if gap else len(raw)
        yield raw[at:end].lower().split()
        at = end


def shingle_hashes(raw: bytes, size: int = SHINGLE, piece: int = PIECE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, in parts."""
    digest, carry, cut = xxhash.xxh64_intdigest, [], False
    for found in _word_lists(raw, piece):
        words = carry + found
        if len(words) >= size:
            ends = list(accumulate(len(w) + 1 for w in words))
            joined = b" ".join(words)
            yield np.array([digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[size - 1 :])], np.uint64)
            cut, words = True, words[len(words) - size + 1 :]
        carry = words
    if carry and not cut:
        yield np.array([digest(b" ".join(carry), SEED)], np.uint64)


def fingerprint(raw: bytes, size: int = SHINGLE, piece: int = PIECE) -> int:
    set_in, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(raw, size, piece):
        total += len(hashes)
        for a in range(0, len(hashes), 1 << 14):
            part = hashes[a : a + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
            set_in += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_in > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(id, fp) for every row, fp as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", size) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return narrow.mapInArrow(rows, f"id {kind}, fp long")


def block_masks(blocks: int, equal: int) -> list[int]:
    """For every choice of ``equal`` of ``blocks`` blocks, the mask of their bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    ones = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    return [sum(chosen) for chosen in combinations(ones, equal)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _near(a: Column, b: Column, distance: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= distance


def linked_fingerprints(classes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, turns: int = TURNS) -> DataFrame:
    """(node, component) over the distinct fingerprints ``fp`` that have a link."""
    masks = F.array(*[F.lit(_signed(m)) for m in block_masks(blocks, blocks - distance)])
    keyed = classes.select("fp", F.posexplode(masks).alias("choice", "mask"))
    keyed = keyed.select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"))
    shared = keyed.groupBy("choice", "bucket").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).filter("low < high")
    rows = stage(keyed.join(shared.select("choice", "bucket"), ["choice", "bucket"]), "simhash-buckets")

    found = None
    for turn in range(turns):
        members = rows if found is None else stage(_apart(rows, found), "simhash-apart")
        if found is not None and members.isEmpty():
            discard(members)
            discard(rows)
            return found
        own = F.col("fp") if found is None else F.col("component")
        hubs = members.groupBy("choice", "bucket").agg(F.min(F.struct(F.xxhash64("fp", F.lit(turn)), F.col("fp").alias("hub"), own.alias("of"))).alias("h"))
        star = members.join(hubs.select("choice", "bucket", "h.hub", "h.of"), ["choice", "bucket"]).filter((own != F.col("of")) & _near(F.col("fp"), F.col("hub"), distance))
        star = stage(star.select(F.col("fp").alias("a"), F.col("hub").alias("b")).distinct(), "simhash-links")
        if found is None:
            found = components(star)
        elif not star.isEmpty():
            found = merged(found, star)
        discard(star)
        if members is not rows:
            discard(members)

    members = stage(_apart(rows, found), "simhash-apart")
    x, y = members.alias("x"), members.alias("y")
    meet = (F.col("x.choice") == F.col("y.choice")) & (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") < F.col("y.component"))
    across = x.join(y, meet & _near(F.col("x.fp"), F.col("y.fp"), distance)).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    across = stage(across.distinct(), "simhash-across")
    discard(rows)
    return found if across.isEmpty() else merged(found, across)


def _apart(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows (choice, bucket, fp, component) of buckets that hold several components."""
    label = found.select(F.col("node").alias("fp"), "component")
    rows = rows.select("choice", "bucket", "fp").join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ends = rows.groupBy("choice", "bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(ends.filter("low < high").select("choice", "bucket"), ["choice", "bucket"]).select("choice", "bucket", "fp", "component")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, distance: int = DISTANCE, blocks: int = BLOCKS
) -> DataFrame:
    """(id, fingerprint, component_id, class_size), one row for every row of ``docs``."""
    rows = stage(fingerprints(docs, id_col, text_col, size).withColumn("key", F.hex("fp")), "simhash-rows")
    classes = stage(rows.groupBy("fp", "key").agg(F.min("id").alias("first"), F.count("*").alias("class_size")), "simhash-classes")
    found = linked_fingerprints(classes.select("fp"), distance, blocks)
    labelled = classes.join(found, classes["fp"] == found["node"], "left").drop("node")
    lowest = labelled.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("lowest"))
    # A class without a link is a component of its own.
    labelled = labelled.join(lowest, "component", "left").select(
        "key", "class_size", F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("lowest")).alias("component_id")
    )
    labelled = stage(labelled, "simhash-labels")
    # The most frequent fingerprints get their label by broadcast, so that no task holds all rows of one.
    hot = labelled.join(F.broadcast(frequent_keys(rows, "key", COUNTERS).select("key")), "key", "left_semi")
    direct = rows.join(F.broadcast(hot), "key")
    rest = rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(labelled, "key")
    return direct.unionByName(rest).select(
        F.col("id").alias(id_col), F.lower(F.lpad("key", 16, "0")).alias("fingerprint"), "component_id", "class_size"
    )
