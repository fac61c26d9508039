"""Text -> fixed-dimension vectors for every row of a table (operators 13-14).

The reference calls a hosted embedding model once per text. The default here
is a lexical stand-in, not a semantic model: signed feature hashing of word
bigrams, L2-normalised.

Plan shape: tokenising is a native expression. Bigrams, hashes and the
scatter-add into dense vectors are one Arrow UDF over whole batches: words are
numbered, every distinct bigram of some thousand texts is hashed once, MD5 for
all of them at a time in numpy. The step is narrow: no shuffle, no exploded
rows, any document length (work linear in its words).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.text import words

DEFAULT_DIM = 256
VECTOR_TYPE = T.ArrayType(T.DoubleType())
MD5_TILE = 4096  # messages hashed at a time
BATCH_WORDS = 1 << 18  # words of texts whose bigrams are numbered together


def overview_text(title: Column, summary: Column) -> Column:
    """``title + ' ' + summary``; ``concat`` keeps NULL semantics (not ``concat_ws``)."""
    return F.concat(title, F.lit(" "), summary)


def _md5_constants() -> tuple[np.ndarray, np.ndarray]:
    shifts = np.repeat([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], 4, axis=0).reshape(-1)
    return np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32), shifts.astype(np.uint32)


_SINES, _SHIFTS = _md5_constants()
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)


def md5_heads(blocks: np.ndarray) -> np.ndarray:
    """First four bytes of the MD5 digests of padded one-block messages, as big-endian integers.

    ``blocks`` holds a message per row, as 16 words (uint32, little-endian).
    """
    out = np.empty(len(blocks), np.uint32)
    for at in range(0, len(blocks), MD5_TILE):
        m = np.ascontiguousarray(blocks[at : at + MD5_TILE].T)
        filled = m.any(axis=1)
        a, b, c, d = (np.full(m.shape[1], x, np.uint32) for x in _START)
        f, t = np.empty_like(a), np.empty_like(a)
        for i in range(61):  # what the 61st step makes is the first word of the digest
            if i < 16:
                np.bitwise_xor(c, d, out=f), np.bitwise_and(f, b, out=f), np.bitwise_xor(f, d, out=f)
                g = i
            elif i < 32:
                np.bitwise_xor(b, c, out=f), np.bitwise_and(f, d, out=f), np.bitwise_xor(f, c, out=f)
                g = (5 * i + 1) % 16
            elif i < 48:
                np.bitwise_xor(b, c, out=f), np.bitwise_xor(f, d, out=f)
                g = (3 * i + 5) % 16
            else:
                np.bitwise_not(d, out=f), np.bitwise_or(f, b, out=f), np.bitwise_xor(f, c, out=f)
                g = 7 * i % 16
            a += f
            a += _SINES[i]
            if filled[g]:
                a += m[g]
            np.right_shift(a, np.uint32(32) - _SHIFTS[i], out=t)
            np.left_shift(a, _SHIFTS[i], out=a)
            a |= t
            a += b
            a, b, c, d = d, a, b, c
        b += _START[0]
        out[at : at + MD5_TILE] = b.byteswap()
    return out


def term_codes(names: pa.StringArray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """First 8 hex digits of the md5 of ``first second`` (words by number; the first alone where the second is -1).

    ``code >> 4`` (first 7 hex digits) picks the bucket; the parity of the 8th
    digit (``code & 1``) picks the sign.
    """
    raw, starts = _bytes_of(names)
    size = np.diff(starts)
    alone = second < 0
    before, after = size[first], np.where(alone, 0, size[second])
    total = before + after + ~alone
    short = total <= 55  # others take more than one block
    out = np.empty(len(first), np.int64)
    blocks = np.zeros((int(short.sum()), 64), np.uint8)
    flat, row = blocks.reshape(-1), np.arange(len(blocks)) * 64
    a, b = before[short], after[short]
    for word, n, place in ((first[short], a, row), (second[short], b, row + a + 1)):
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        flat[np.repeat(place, n) + inside] = raw[np.repeat(starts[word], n) + inside]
    flat[(row + a)[~alone[short]]] = 32
    flat[row + total[short]] = 128
    packed = blocks.view("<u4")
    packed[:, 14] = total[short] * 8
    out[short] = md5_heads(packed)
    for i in np.flatnonzero(~short):
        text = b" ".join(raw[starts[w] : starts[w + 1]].tobytes() for w in (first[i], second[i])[: 1 if alone[i] else 2])
        out[i] = int.from_bytes(hashlib.md5(text).digest()[:4])
    return out


def _bytes_of(names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, where each string starts, and the last ends)."""
    wide = names.cast(pa.large_binary())
    _, starts, raw = wide.buffers()
    starts = np.frombuffer(starts, np.int64, len(wide) + 1, wide.offset * 8)
    return np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), starts


def _dense(toks: pa.Array, dim: int) -> np.ndarray:
    """Vectors of rows of words: adjacent word pairs joined by one space, a lone word stands alone."""
    n = toks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = toks.flatten()
    if not len(flat):
        return np.zeros((len(n), dim))
    coded = pc.dictionary_encode(flat)
    code, row = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(n)), n)
    last = np.zeros(len(code), bool)
    last[np.cumsum(n)[n > 0] - 1] = True
    lone = last & (n[row] == 1)
    follows = np.where(lone, -1, np.append(code[1:], -1))
    kept = ~last | lone
    step = len(coded.dictionary) + 1
    which, pairs = pd.factorize((code * step + follows + 1)[kept])
    codes = term_codes(coded.dictionary, pairs // step, pairs % step - 1)
    cells, signs = (codes >> 4) % dim, 1.0 - 2.0 * (codes & 1)
    out = np.bincount(row[kept] * dim + cells[which], weights=signs[which], minlength=len(n) * dim).reshape(len(n), dim)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    np.divide(out, norms, out=out, where=norms > 0)
    return out


def _densify(dim: int) -> Callable[[pa.Array], pa.Array]:
    def densify(toks: pa.Array) -> pa.Array:
        ends = np.cumsum(toks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        out = np.zeros((len(toks), dim))
        first = 0
        while first < len(toks):  # a row is never cut
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + BATCH_WORDS, side="right")))
            out[first:last] = _dense(toks.slice(first, last - first), dim)
            first = last
        return pa.ListArray.from_arrays(pa.array(np.arange(len(toks) + 1, dtype=np.int32) * dim), pa.array(out.reshape(-1)))

    return densify


def _python_step(udf):
    """Keep a vector UDF where it is planned.

    The function is deterministic, but Catalyst would otherwise copy it into
    predicates inferred on its output (``size(vector) > 0`` from an explode,
    ``vector IS NOT NULL`` before a join) and push those below shuffles, so
    it would run twice, once before the repartition that spreads the work.
    Declaring it non-deterministic pins it to one evaluation per row.
    """
    return udf.asNondeterministic()


def embed_table(
    df: DataFrame,
    id_col: str,
    text_col: str,
    dim: int = DEFAULT_DIM,
    embedder: Callable[[pd.Series], pd.Series] | None = None,
    out_col: str = "vector",
) -> DataFrame:
    """Append ``out_col`` (array<double>) for every row.

    ``embedder`` is the model hook: a function ``pd.Series[str] -> pd.Series
    [list[float]]`` run as an Arrow-batched pandas UDF (batching amortises
    model calls the way the reference's one-call-per-text could not).
    Blank text gives the all-zero vector, which never matches anything.
    """
    if embedder is not None:
        return df.withColumn(out_col, _python_step(F.pandas_udf(embedder, VECTOR_TYPE))(F.col(text_col)))
    densify = _python_step(F.arrow_udf(_densify(dim), VECTOR_TYPE))
    staged = df.withColumn("_toks", F.coalesce(words(F.lower(F.col(text_col))), F.array().cast("array<string>")))
    return staged.withColumn(out_col, densify(F.col("_toks"))).drop("_toks")


def join_embeddings(df: DataFrame, vectors: DataFrame, id_col: str, vec_col: str, out_col: str = "vector") -> DataFrame:
    """Attach precomputed vectors (cast to double) by id; rows without one get NULL."""
    v = vectors.select(F.col(id_col), F.col(vec_col).cast(VECTOR_TYPE).alias(out_col))
    return df.join(v, id_col, "left")


def sparse_entries(df: DataFrame, id_col: str, vec_col: str = "vector") -> DataFrame:
    """``(id, dim_index, value)`` for the non-zero entries of each vector."""
    return (
        df.select(F.col(id_col), F.posexplode(vec_col).alias("dim_index", "value"))
        .filter(F.col("value") != 0)
    )
