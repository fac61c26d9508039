import random
import re
from collections import defaultdict

import numpy as np
import pytest

from eventloom.llm import kernel as K
from eventloom.llm.ngram_join import join_components, near_dedup

from .helpers import docs_df, odd_texts, real_docs, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < k else [tuple(w[i : i + k]) for i in range(len(w) - k + 1)])


def brute(ids, texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in index[x] if j > i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(j)] = find(i)
    low = defaultdict(list)
    for i in range(len(ids)):
        low[find(i)].append(ids[i])
    return sorted((ids[i], len(sets[i]), min(low[find(i)])) for i in range(len(ids)))


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows_of(df))


def families(seed, n_families, copies, length, edits, vocab=60):
    """Families of drifting near copies: each copy edits an earlier one, so families are not cliques."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocab)]
    texts = []
    for _ in range(n_families):
        family = [[rng.choice(words) for _ in range(rng.randint(length // 2, length))]]
        for _ in range(copies):
            t = list(rng.choice(family))
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(t))
                t[at : at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
            family.append(t)
        texts += [" ".join(t) for t in family]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("seed", [1, 2])
def test_drifting_families(spark, k, percent, seed):
    texts = families(seed, 12, 14, 60, 3) + families(seed + 9, 3, 30, 200, 6) + odd_texts(seed)
    assert got(join_components(docs_df(spark, texts, extra=True), words=k, percent=percent)) == brute(range(len(texts)), texts, k, percent)


def test_common_passages_and_short_texts(spark, monkeypatch):
    monkeypatch.setattr("eventloom.llm.ngram_join.FREQUENT", 4)
    rng = random.Random(8)
    line = " ".join(f"c{i}" for i in range(12))
    texts = [line + " " + " ".join(rng.choice("abcdefgh") + str(rng.randint(0, 3)) for _ in range(rng.randint(0, 14))) for _ in range(150)]
    texts += ["a b", "A B", "a  b ", "a", "a", "b a", "", None, "\t"]
    assert got(join_components(docs_df(spark, texts), words=3, percent=90)) == brute(range(len(texts)), texts, 3, 90)


def test_given_table_and_stage(spark):
    df = real_docs(spark)
    data = [(r["doc_id"], r["text"]) for r in df.collect()]
    want = brute([d[0] for d in data], [d[1] for d in data], 3, 90)
    assert got(join_components(df, words=3, percent=90)) == want
    want = brute([d[0] for d in data], [d[1] for d in data], 5, 80)
    kept = near_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in rows_of(kept)) == [i for i, _, c in want if i == c]


def test_empty_and_repeated_ids(spark):
    df = docs_df(spark, ["a b c d", "a b c d", "x y z", None], ids=[4, 4, 4, 4])
    assert got(join_components(df, words=3, percent=90)) == [(4, 0, 4), (4, 1, 4), (4, 2, 4), (4, 2, 4)]
    assert got(join_components(df.limit(0))) == []


def by_hash(words):
    """Words in the order of their one-word shingles."""
    def key(w):
        raw = np.frombuffer(w.encode(), np.uint8)
        return int(K.shingles(raw, np.array([0, len(raw)]), 1)[1][0])

    return sorted(words, key=key)


def test_links_inside_an_isolated_group(spark):
    # Equal size and equal prefix (the 9 lowest hashes of 40), and no other group holds any of it.
    texts, rng = [], random.Random(4)
    for t in range(24):
        pool = by_hash(f"t{t}w{i}" for i in range(80))
        prefix, rest = pool[:9], pool[9:]
        rng.shuffle(rest)
        a = rest[:31]
        if t % 2:  # a stranger and two that link: 40 / 42 words in common
            family = [rest[31:62], a, [*a[1:], rest[62]]]
        else:  # a chain: the ends have 32 words in common, neighbours 36
            family = [a, [*a[4:], *rest[31:35]], [*a[8:], *rest[31:39]]]
        texts += [" ".join(prefix + f) for f in family]
    assert got(join_components(docs_df(spark, texts), words=1, percent=80)) == brute(range(len(texts)), texts, 1, 80)


def test_family_whose_group_starts_with_strangers(spark):
    pool = by_hash(f"s{i}" for i in range(900))
    prefix, rest = pool[:9], pool[9:]
    texts = [" ".join(prefix + rest[31 * i : 31 * i + 31]) for i in range(12)]
    texts += [" ".join(prefix + rest[372:402] + [rest[410 + i]]) for i in range(12)]
    assert got(join_components(docs_df(spark, texts), words=1, percent=80)) == brute(range(len(texts)), texts, 1, 80)


def test_shingle_within_reach_of_one_prefix_only(spark):
    # a has the frequent f first, then x; b has two more in front, so only the demotion of f brings
    # x into b's prefix. 10 of 12 words are common, and of the prefixes only the first x.
    pool = by_hash(f"v{i}" for i in range(120))
    d, f, x, rest = pool[:2], pool[2:4], pool[4:12], pool[12:]
    texts = [" ".join(f + x), " ".join(d + f + x)] + [" ".join(f + rest[8 * i : 8 * i + 8]) for i in range(13)]
    want = brute(range(len(texts)), texts, 1, 80)
    assert want[:2] == [(0, 10, 0), (1, 12, 0)]
    assert got(join_components(docs_df(spark, texts), words=1, percent=80)) == want


def test_stage_decides_repeated_ids_row_by_row(spark):
    rows = [(4, "x y z w"), (4, "a b c d"), (3, "x y z w"), (4, "p q"), (4, "p q"), (4, None), (None, "a b c d"), (None, "r s")]
    df = docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    kept = [(r["doc_id"], r["text"]) for r in rows_of(near_dedup(df, words=3, percent=90))]
    assert len(kept) == 5 and set(kept) == {(3, "x y z w"), (4, "a b c d"), (4, "p q"), (4, None), (None, "r s")}


def test_null_ids_link_like_others(spark):
    rng, rows, want = random.Random(6), [], []
    for t in range(16):  # chains of one group, as above, and of different groups, with null ids in each place
        pool = by_hash(f"n{t}w{i}" for i in range(80))
        prefix, rest = (pool[:9], pool[9:]) if t % 2 else ([], pool)
        rng.shuffle(rest)
        a = rest[: 40 - len(prefix)]
        family = [a, [*a[4:], *rest[40:44]], [*a[8:], *rest[40:48]]]
        ids = [None if t // 2 & 1 << i else 10 * t + i for i in range(3)]
        low = min((i for i in ids if i is not None), default=None)
        rows += [(i, " ".join(prefix + f)) for i, f in zip(ids, family)]
        want += [(i, 40, low) for i in ids]
    rows.append((None, None))
    want.append((None, 0, None))
    order = lambda r: [(x is None, x or 0) for x in r]
    found = rows_of(join_components(docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows]), words=1, percent=80))
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=order) == sorted(want, key=order)


def test_texts_that_a_polynomial_hash_confuses(spark):
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    a, b = ("".join(w[x] for x in bits) for w in ("ab", "ba"))
    rows = rows_of(join_components(docs_df(spark, [a, b, a + " x", b]), words=3, percent=90))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == [(0, 1, 0), (1, 1, 1), (2, 1, 2), (3, 1, 1)]
