import random

import numpy as np
import pytest
import xxhash

from eventloom.llm.simhash import block_masks, fingerprint, linked_fingerprints, simhash_components
from tests.llm.helpers import docs_df, odd_texts, real_docs, rows_of


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Smallest reachable index of every fingerprint."""
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(prints))]


def expected(ids, texts):
    prints = [brute_fingerprint(t) for t in texts]
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, i))
    got = brute_components([prints[i] for i in order])
    return sorted(((ids[i], f"{prints[i]:016x}", ids[order[got[k]]]) for k, i in enumerate(order)), key=repr)


def result(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows_of(df)), key=repr)


def family(seed, n):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    texts = [" ".join(base)]
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice((1, 1, 2, 4))):
            words[rng.randrange(len(words))] = f"v{rng.randrange(400)}"
        texts.append(" ".join(words))
    return texts


def test_fingerprint_of_odd_texts_and_in_pieces():
    for text in odd_texts():
        raw = (text or "").encode()
        assert fingerprint(raw) == brute_fingerprint(text)
        assert fingerprint(raw, piece=7) == brute_fingerprint(text)


def test_masks_leave_a_common_block_for_three_changes():
    masks = block_masks(6, 3)
    assert len(masks) == 20
    rng = np.random.default_rng(1)
    for _ in range(500):
        change = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(change & m == 0 for m in masks)


def test_odd_rows_equal_brute_force(spark):
    texts = odd_texts() + family(1, 60) + family(2, 20) * 2
    ids = list(range(len(texts)))
    ids[5], ids[6], ids[40] = None, None, 39
    assert result(simhash_components(docs_df(spark, texts, ids=ids, extra=True))) == expected(ids, texts)


def test_given_documents_equal_brute_force(spark):
    docs = real_docs(spark)
    rows = docs.select("doc_id", "text").collect()
    assert result(simhash_components(docs)) == expected([r.doc_id for r in rows], [r.text for r in rows])


def test_empty_table(spark):
    got = simhash_components(docs_df(spark, []))
    assert got.columns[:3] == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


@pytest.mark.parametrize("bits", [10, 14])
def test_dense_family_of_fingerprints(spark, bits):
    """Thousands of fingerprints within a few bits of each other, and chains of links between families."""
    rng = random.Random(bits)
    places = rng.sample(range(64), bits)
    prints = {sum(1 << p for p in places if rng.random() < 0.3) for _ in range(600)}
    prints |= {rng.getrandbits(64) for _ in range(300)}
    chain = rng.getrandbits(64)
    for _ in range(12):
        prints.add(chain)
        chain ^= sum(1 << b for b in rng.sample(range(64), 3))
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    got = {r.node: r.component for r in linked_fingerprints(spark.createDataFrame([(p,) for p in prints], "fp long").repartition(4)).collect()}
    want = brute_components([p % (1 << 64) for p in prints])
    groups = {}
    for p, w in zip(prints, want):
        groups.setdefault(w, set()).add(p)
    have = {}
    for p in prints:
        have.setdefault(got.get(p, p), set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, have.values()))
