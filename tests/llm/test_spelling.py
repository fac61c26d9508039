import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from eventloom.llm.spelling import PIECE, after_zeros, deal, deal_words, near_words, spelling_forms
from tests.llm.helpers import docs_df, odd_texts, real_docs, rows_of


def brute_words(ids, texts):
    counts = Counter()
    for doc_id, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_near(words):
    """Pairs one edit apart, candidates by equal strings with one place left out."""
    by = defaultdict(set)
    for w in words:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in by.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def expected(ids, texts):
    n = brute_words(ids, texts)
    near = brute_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def result(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in rows_of(df))


def misspelt(seed, n=400):
    rng = random.Random(seed)
    letters = "abcdeéßÿ"
    vocab = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(30)] + ["aaaaa", "aaaaaa", "Aaaaaaa", "ÀÉaaa", "Àéaaa"]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 30)):
            w = rng.choice(vocab)
            for _ in range(rng.choice((0, 0, 0, 1, 2))):
                i = rng.randrange(len(w) + 1)
                w = rng.choice((w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]))
            words.append(w)
        texts.append(rng.choice((" ", ", ", "1", "\n")).join(words))
    return texts


def test_misspelt_words_equal_brute_force(spark):
    texts = misspelt(1) + odd_texts()
    ids = list(range(len(texts)))
    ids[3], ids[4] = None, 2
    assert result(spelling_forms(docs_df(spark, texts, ids=ids, extra=True))) == expected(ids, texts)


def test_given_documents_equal_brute_force(spark):
    docs = real_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    assert result(spelling_forms(docs)) == expected([r.doc_id for r in rows], [r.text for r in rows])


def test_long_words_salts_and_depth(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("ab") for _ in range(150))
    words = {base, base[:-1], base + "c", base[:70] + "x" + base[71:], base[:3] + base[4:], "q" + base, base[1:], "aaaaa", "aaaab", "baaaa"}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(2, 9))) for _ in range(300)}
    want = {(a, b) for a, near in brute_near(words).items() for b in near if a != b}
    for depth, per_salt in ((64, 2048), (8, 16)):
        got = near_words(spark.createDataFrame([(w,) for w in sorted(words)], "word string"), depth, per_salt)
        assert {(r.word, r.near) for r in got.collect()} == want


def test_texts_in_pieces_and_long_runs():
    texts = [*odd_texts(), "z" * 300 + " y" * 50, "é" * 200, "ab" * 40 + " c" * 9, None]
    ids = [*range(len(texts) - 1), None]
    want = Counter()
    for doc_id, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            want[deal(doc_id, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run))] += 1
    for piece in (PIECE, 40):
        got = Counter()
        for part in deal_words(ids, pa.array(texts, pa.string()), piece):
            for word, n in zip(*part.to_pydict().values()):
                got[word] += n
        assert got == want


def test_checksum_of_both_parts():
    prefixes, words = [b"12:", b":", b"-7:"], [b"a", "é".encode(), b"abcdefgh" * 7]
    lengths = np.array(sorted({len(w) for w in words}))
    got = after_zeros(np.array([zlib.crc32(p) for p in prefixes], np.uint32), lengths)
    for i, p in enumerate(prefixes):
        for w in words:
            assert int(got[i, lengths.tolist().index(len(w))]) ^ zlib.crc32(w) == zlib.crc32(p + w)


@pytest.mark.parametrize("texts", [[], [None, "", "12 34", "one two"]])
def test_no_words(spark, texts):
    got = spelling_forms(docs_df(spark, texts))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and got.count() == 0
