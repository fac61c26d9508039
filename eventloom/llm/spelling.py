"""Operator 12, spelling variant grouping by a relational trie frontier.

Words are the maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF) of all texts,
lower-cased in A-Z only, one letter deleted where the checksum rule of ``deal``
says so, of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences.

All words make a trie, held as a table of edges (parent, label, child). A node is
a prefix; where only one word is left below a node its whole rest is one edge.
States (word, position, node, edits) are joined with the edges level by level: an
edge is taken as it is, or with the one edit. A state that ends on a word with
one edit is a pair of near words. Edges carry masks of which one, two and three
letters may follow and how long the words below are, so that most dead states are
dropped at once; masks err on the side of keeping.

A trie is wide near its root, so an early edit would branch into all of it. Hence
there are two tries, of the words and of the reversed words: an edit in the second
half of a word is found in the first, where the first half must match as it is, an
edit in the first half in the other one. A word's states start at the node of that
exact part. A node below which many words lie is salted: its edges are repeated
for every salt, its states are dealt over them.

The form of a word is its near word of largest count (ties: smallest in code-point
order) with at least twice the word's count; the root follows forms to the last
one, by pointer doubling (counts double at every step, so there are no cycles).

Null and empty texts hold no words. A null id enters the checksum as an empty
text. Rows that repeat an id count each. Texts are read in pieces, however long;
of a word beyond ``DEPTH`` letters the rest is one edge. Empty tables give empty
results; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import discard, stage

LEAST_LETTERS, LEAST_COUNT = 5, 3
MODULUS = 97
#: Letters of a word that are nodes of their own in the trie.
DEPTH = 64
#: Words below a node for each of its salts.
PER_SALT = 2048
#: Bytes of text that are cut into words at a time, and words counted before a task reports.
PIECE, MOST_COUNTED = 8 << 20, 1 << 19
#: Runs longer than this get their checksum one by one.
LONG_RUN = 64

_GAPS = "[^A-Za-z\u00C0-\u00FF]+"
_LETTER = re.compile("[A-Za-z\u00C0-\u00FF]")


def _byte_table() -> np.ndarray:
    """CRC-32 of every single byte, as a state without the inversions."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, np.uint32(0xEDB88320) ^ (value >> np.uint32(1)), value >> np.uint32(1))
    return value


_TABLE = _byte_table()


def after_zeros(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For every checksum so far (rows) and byte length (columns, rising) what to combine by exclusive or with the
    checksum of bytes of that length, to have the checksum of both; CRC-32 is linear in the bytes."""
    out = np.empty((len(crcs), len(lengths)), np.uint32)
    state, n = crcs.astype(np.uint32) ^ np.uint32(0xFFFFFFFF), 0
    for column, length in enumerate(lengths.tolist()):
        while n < length:
            state = _TABLE[state & np.uint32(0xFF)] ^ (state >> np.uint32(8))
            n += 1
        out[:, column] = state ^ np.uint32(0xFFFFFFFF) ^ np.uint32(zlib.crc32(bytes(length)))
    return out


def _prefix(doc_id) -> int:
    return zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())


def _pieces(texts: pa.Array, piece: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(rows, texts) of some MB each; one longer text is cut between runs."""
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    first, n = 0, len(texts)
    while first < n:
        last, held = first, 0
        while last < n and (held + size[last] <= piece or last == first):
            held += size[last]
            last += 1
        if held <= piece:
            yield pa.array(np.arange(first, last)), texts.slice(first, last - first)
        else:
            text, at = texts[first].as_py(), 0
            while at < len(text):
                end = min(at + piece // 4, len(text))
                while end < len(text) and _LETTER.match(text, end) and _LETTER.match(text, end - 1):
                    end += 1
                yield pa.array([first]), pa.array([text[at:end]], pa.large_string())
                at = end
        first = last


def deal_words(ids: list, texts: pa.Array, piece: int = PIECE) -> Iterator[pa.Table]:
    """(word, n) of some texts: their runs of letters, lower-cased in A-Z, one letter less where
    ``MODULUS`` divides the checksum of ``<id>:<run>``."""
    prefixes = np.array([_prefix(i) for i in ids], np.uint32)
    for rows, part in _pieces(texts, piece):
        runs = pc.split_pattern_regex(pc.ascii_lower(part.cast(pa.large_string())), _GAPS)
        doc = np.repeat(rows.to_numpy(), pc.fill_null(pc.list_value_length(runs), 0).to_numpy())
        coded = pc.dictionary_encode(runs.flatten())
        words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        raw = [w.encode() for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        crc = np.array([zlib.crc32(w) for w in raw], np.uint32)
        short = (size > 0) & (size <= LONG_RUN)
        lengths = np.unique(size[short])
        docs, doc_at = np.unique(doc, return_inverse=True)
        shifts = after_zeros(prefixes[docs], lengths)
        column = np.searchsorted(lengths, size)
        plain = short[code]
        chosen = np.zeros(len(code), bool)
        at = np.flatnonzero(plain)
        h = shifts[doc_at[at], column[code[at]]] ^ crc[code[at]]
        chosen[at[h % MODULUS == 0]] = True
        chosen |= size[code] > LONG_RUN  # these are looked at below
        count = np.bincount(code[~chosen], minlength=len(words))
        spelt: Counter = Counter()
        for i in np.flatnonzero(chosen).tolist():
            spelt[deal(ids[doc[i]], words[code[i]])] += 1
        kept = np.flatnonzero((count > 0) & (size > 0))
        yield pa.table({"word": coded.dictionary.take(pa.array(kept)), "n": pa.array(count[kept].astype(np.int64))})
        if spelt:
            yield pa.table({"word": pa.array(spelt.keys(), pa.large_string()), "n": pa.array(spelt.values(), pa.int64())})


def deal(doc_id, word: str) -> str:
    """A run as this document spells it: one letter less if ``MODULUS`` divides the checksum."""
    h = zlib.crc32(word.encode(), _prefix(doc_id))
    if h % MODULUS:
        return word
    cut = h % len(word)
    return word[:cut] + word[cut + 1 :]


def word_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(word, n) of every text; counted in the task first."""

    def count(batches):
        held: list[pa.Table] = []
        n = 0

        def merge():
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in batches:
            for part in deal_words(batch.column(0).to_pylist(), batch.column(1)):
                held.append(part)
                n += part.num_rows
            if n > 2 * MOST_COUNTED:
                merged = merge()
                held, n = [merged], merged.num_rows
                if n > MOST_COUNTED:
                    yield from merged.cast(schema).to_batches(1 << 16)
                    held, n = [], 0
        if held:
            yield from merge().cast(schema).to_batches(1 << 16)

    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _bit(c: Column) -> Column:
    """One of 64 bits for a short string."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.xxhash64(c).bitwiseAND(F.lit(63)).cast("int"))


#: How many of the next letters an edge's masks of what may follow look at, one mask each.
AHEAD = (1, 2, 3)


def trie_edges(sided: DataFrame, depth: int = DEPTH, per_salt: int = PER_SALT) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, salts, terminal) with several words below, and the edges that leave them, written.

    ``sided`` holds (wid, word, size), words after the mark of their side. An edge is (parent, salt,
    label, child, leaf, terminal, low, high, salts and a mask for each of ``AHEAD``): ``low`` and
    ``high`` are the sizes of the words below the child, ``salts`` the child's.
    """
    places = F.sequence(F.lit(1), F.least("size", F.lit(depth)))
    prefixes = sided.select("wid", "word", "size", F.explode(places).alias("i"))
    masks = [_bit(F.substring("word", F.col("i") + 2, F.lit(n))).alias(f"mask{n}") for n in AHEAD]
    prefixes = prefixes.select(F.substring("word", F.lit(1), F.col("i") + 1).alias("child"), "i", "wid", "size", *masks)
    nodes = prefixes.groupBy("child", "i").agg(
        F.count("*").alias("below"),
        F.sum("wid").alias("wid"),
        F.max(F.col("size") == F.col("i")).alias("terminal"),
        F.min("size").alias("low"),
        F.max("size").alias("high"),
        *(F.bit_or(f"mask{n}").alias(f"mask{n}") for n in AHEAD),
    )
    nodes = nodes.withColumn("salts", F.ceil(F.col("below") / F.lit(per_salt)).cast("int"))
    nodes = stage(nodes.withColumn("parent", F.substring("child", F.lit(1), F.col("i"))), "trie-nodes")
    single = F.col("below") == 1
    # An edge leaves a node with several words below; one that leads to a single word is all of its rest.
    wide = nodes.filter(~single).select(F.col("child").alias("parent"), F.col("salts").alias("spread"))
    edges = nodes.join(wide, "parent")
    sizes = ["low", "high", "salts", *(f"mask{n}" for n in AHEAD)]
    inner = edges.filter(~single).select("parent", "spread", F.substring("child", F.col("i") + 1, F.lit(1)).alias("label"), "child", F.lit(False).alias("leaf"), "terminal", *sizes)
    words = sided.select("wid", "word", F.col("size").alias("letters"))
    ends = edges.filter(single).drop("child").join(words, "wid")
    ends = ends.select("parent", "spread", F.substring("word", F.col("i") + 1, F.col("letters")).alias("label"), F.col("word").alias("child"), F.lit(True).alias("leaf"), F.lit(True).alias("terminal"), *sizes)
    none = [F.lit(0).cast("long").alias(f"mask{n}") for n in AHEAD]
    deep = sided.filter(F.col("size") > depth).select(
        F.substring("word", F.lit(1), F.lit(depth + 1)).alias("parent"), F.substring("word", F.lit(depth + 2), F.col("size")).alias("label"),
        F.col("word").alias("child"), F.lit(True).alias("leaf"), F.lit(True).alias("terminal"),
        F.col("size").alias("low"), F.col("size").alias("high"), F.lit(1).alias("salts"), *none,
    ).join(wide, "parent")
    edges = inner.unionByName(ends).unionByName(deep)
    edges = edges.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))).drop("spread")
    edges = stage(edges, "trie-edges")
    return nodes.filter(~single).select(F.col("child").alias("node"), "salts", "terminal"), edges


def _salt(salts: Column) -> Column:
    return F.pmod(F.xxhash64("word"), salts).cast("int")


def near_words(words: DataFrame, depth: int = DEPTH, per_salt: int = PER_SALT) -> DataFrame:
    """(word, near): every ordered pair of distinct ``word`` values one edit apart."""
    # Both tries are one table: a word stands behind ">", its reverse behind "<"; places count from there.
    size = F.length("word")
    forward = words.select(F.concat(F.lit(">"), "word").alias("word"), size.alias("size"), F.floor(size / 2).cast("int").alias("exact"))
    backward = words.select(F.concat(F.lit("<"), F.reverse("word")).alias("word"), size.alias("size"), (size - F.floor(size / 2)).cast("int").alias("exact"))
    sided = stage(forward.union(backward).withColumn("wid", F.monotonically_increasing_id()), "trie-words")
    nodes, edges = trie_edges(sided, depth, per_salt)

    at, size = F.col("at"), F.length("word") - 1
    begin = F.least("exact", F.lit(depth))
    states = sided.select("word", begin.cast("int").alias("at"), F.substring("word", F.lit(1), begin + 1).alias("node")).join(nodes, "node")
    shorter = (at == size - 1) & F.col("terminal")  # all but the word's last letter is a word
    states = states.select("word", "at", "node", F.lit(0).alias("edits"), _salt(F.col("salts")).alias("salt"), F.when(shorter, F.col("node")).alias("near"), F.lit(True).alias("goes_on"))
    level = stage(states, "trie-frontier")
    found = []
    while True:
        found.append(stage(level.filter("near IS NOT NULL").select("word", "near"), "trie-found"))
        frontier = level.filter("goes_on").drop("near", "goes_on")
        if frontier.isEmpty():
            break
        # A state without an edit meets all edges of its node, one with an edit that of its next letter only.
        here, label, next_letter = F.col("f.at"), F.col("e.label"), F.substring("f.word", F.col("f.at") + 2, F.lit(1))
        on = (F.col("f.node") == F.col("e.parent")) & (F.col("f.salt") == F.col("e.salt"))
        rest = F.substring("f.word", here + 2, F.length("f.word"))
        on &= (F.col("f.edits") == 0) | F.when(F.col("e.leaf"), rest == label).otherwise(next_letter == label)
        on &= (F.col("f.edits") == 1) | (F.col("e.low") <= F.length("f.word")) & (F.col("e.high") >= F.length("f.word") - 2)
        on &= (F.col("f.edits") == 1) | ~F.col("e.leaf") | (F.levenshtein(rest, label, 1) == 1)
        met = frontier.alias("f").join(edges.alias("e"), on)
        # What a state can do with an edge of one letter: take it, take it for another letter, take it without
        # using one, skip one letter before it.
        step = lambda n, edits: F.struct((F.col("at") + n).cast("int").alias("at"), F.lit(edits).alias("edits"))
        same, fresh = next_letter == label, (F.col("f.edits") == 0) & ~F.col("e.leaf")
        steps = F.array(
            F.when(F.col("e.leaf"), F.struct((F.length("f.word") - 1).cast("int").alias("at"), F.lit(1).alias("edits"))),
            F.when(~F.col("e.leaf") & same, F.struct((here + 1).cast("int").alias("at"), F.col("f.edits").alias("edits"))),
            F.when(fresh & ~same & (here + 2 <= F.length("f.word")), step(1, 1)),
            F.when(fresh, step(0, 1)),
            F.when(fresh & (F.substring("f.word", here + 3, F.lit(1)) == label) & (here + 3 <= F.length("f.word")), step(2, 1)),
        )
        met = met.select("f.word", "e.child", "e.leaf", "e.terminal", "e.low", "e.high", "e.salts", *(f"e.mask{n}" for n in AHEAD), F.explode(steps).alias("step")).filter("step IS NOT NULL")
        met = met.select("*", F.col("step.at").alias("at"), F.col("step.edits").alias("edits"))
        ends = F.col("terminal") & ((at == size) & (F.col("edits") == 1) | (at == size - 1) & (F.col("edits") == 0))
        # After its edit a state goes on only where the letters left may follow and a word below is as long.
        alive = at < size
        for n in AHEAD:
            alive &= F.col(f"mask{n}").bitwiseAND(_bit(F.substring(F.col("word"), at + 2, F.lit(n)))) != 0
        alive &= (F.length("child") - 1 + size - at).between(F.col("low"), F.col("high"))
        goes_on = ~F.col("leaf") & ((F.col("edits") == 0) | alive)
        met = met.select("word", "at", F.col("child").alias("node"), "edits", _salt(F.col("salts")).alias("salt"), F.when(ends, F.col("child")).alias("near"), goes_on.alias("goes_on"))
        nxt = stage(met.filter("near IS NOT NULL OR goes_on"), "trie-frontier")
        discard(level)
        level = nxt
    pairs = found[0]
    for part in found[1:]:
        pairs = pairs.union(part)
    upright = lambda c: F.when(F.startswith("word", F.lit("<")), F.reverse(F.substring(c, F.lit(2), F.length(c)))).otherwise(F.substring(c, F.lit(2), F.length(c)))
    near = stage(pairs.select(upright("word").alias("upright"), upright("near").alias("near")).toDF("word", "near").distinct(), "trie-near")
    for table in (*found, level, edges, sided):
        discard(table)
    return near


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form: the last one on the way of forms."""
    hops = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = hops.select(F.col("word").alias("root"), F.col("root").alias("next"))
        nxt = stage(hops.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(hops)
        if nxt.filter("moved").isEmpty():
            return nxt.select("word", "root")
        hops = stage(nxt.select("word", "root"), "spelling-roots")
        discard(nxt)


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of the vocabulary."""
    if least_letters < 2:
        raise ValueError("words need two letters at least: a shorter one has no part that stays as it is")
    counted = word_counts(docs, id_col, text_col)
    words = stage(counted.filter((F.length("word") >= least_letters) & (F.col("n") >= least_count)), "spelling-words")
    near = near_words(words.select("word")).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    joined = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.rank")).alias("near_n"))
    strong = F.col("near_n") >= 2 * F.col("n")
    joined = stage(joined.select("word", "n", "n_near", F.when(strong, F.col("near")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n")), "spelling-forms")
    root = roots(joined.filter("form IS NOT NULL"))
    return joined.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
