import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm.suffix_dedup import common_prefixes, remove_repeats, suffix_array

from .helpers import docs_df, odd_texts, real_docs, rows_of


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=120), st.lists(st.sampled_from([b"a", b"ab", b"\0", b"aab" * 9]), max_size=30).map(b"".join)))
def test_suffix_array_and_common_prefixes(raw):
    text = np.frombuffer(raw, np.uint8)
    order = suffix_array(text)
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    assert order.tolist() == want
    shared = [0]
    for a, b in zip(want, want[1:]):
        n = 0
        while n < 20 and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        shared.append(n)
    assert common_prefixes(text, order, 20, lane=7).tolist() == shared[: len(raw)]


def brute(ids, texts, length):
    seen, out = set(), {}
    for i in sorted(range(len(ids)), key=lambda i: ids[i]):
        raw = (texts[i] or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - length + 1):
            window = raw[at : at + length]
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        spans = sum(1 for j in range(len(raw)) if gone[j] and (j == 0 or not gone[j - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[ids[i]] = (ids[i], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(out.values())


def got(df):
    return sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows_of(df))


def passages(seed, n, words=40):
    rng = random.Random(seed)
    vocab = [f"wörd{i}" for i in range(words)]
    make = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    shared = [make(rng.randint(10, 70)) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [make(rng.randint(0, 30)) if rng.random() < 0.6 else rng.choice(shared)[rng.randint(0, 40) :] for _ in range(rng.randint(0, 5))]
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("length,k", [(100, 32), (24, 8)])
def test_matches_brute_force(spark, length, k):
    texts = passages(3, 120) + odd_texts() + ["ab" * 300, "ab" * 150, "q" * 99, "q" * 100, "q" * 101]
    ids = random.Random(6).sample(range(10000), len(texts))
    df = docs_df(spark, texts, ids=ids, extra=True)
    want = brute(ids, texts, length)
    assert got(remove_repeats(df, length=length, k=k)) == want
    # Small shards make keys span several of them; a low limit makes every repeated anchor hot.
    assert got(remove_repeats(df, length=length, k=k, shard_bytes=600, hot_least=1)) == want


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr("eventloom.llm.suffix_dedup.PIECE_BYTES", 500)
    monkeypatch.setattr("eventloom.llm.kernel.SMALL_BLOCK", 400)
    texts = [" ".join(passages(s, 30)) for s in (1, 2, 1)] + passages(4, 20)
    assert got(remove_repeats(docs_df(spark, texts))) == brute(range(len(texts)), texts, 100)


def test_given_table(spark):
    df = real_docs(spark)
    data = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert got(remove_repeats(df)) == brute([d[0] for d in data], [d[1] for d in data], 100)


def test_repeated_rows_kept_bytes_and_empty_table(spark):
    line = "the same long line of text, over and over, " * 4
    df = docs_df(spark, [line, line, line + "x", None], ids=[2, 2, 1, 1])
    rows = sorted(rows_of(remove_repeats(df, with_bytes=True)), key=lambda r: (r["doc_id"], r["n_bytes"]))
    assert [(r["doc_id"], r["n_bytes"]) for r in rows] == [(1, 0), (1, len(line) + 1), (2, len(line)), (2, len(line))]
    assert rows[2] == rows[3] and rows[2]["kept"] == b"" and rows[2]["n_spans"] == 1
    assert rows[1]["n_removed"] > 0 and len(rows[1]["kept"]) == rows[1]["n_bytes"] - rows[1]["n_removed"]
    assert rows_of(remove_repeats(df.limit(0))) == []
