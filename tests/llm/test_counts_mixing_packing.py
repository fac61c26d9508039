import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventloom.llm import kernel as K
from eventloom.llm.mixing import fit, mix
from eventloom.llm.packing import pack_documents, plan_packing
from eventloom.llm.queries import PIECE_VOCABULARY, WORD_BPE, tokenizer_file
from eventloom.llm.token_counts import LongestMatch, read_vocabulary, token_counts

from .helpers import docs_df, odd_texts, real_docs, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def greedy(word, starts, rests):
    n, at, pieces = 0, 0, starts
    longest = max(map(len, starts | rests), default=0)
    while at < len(word):
        for end in range(min(len(word), at + longest), at, -1):
            if word[at:end] in pieces:
                break
        else:
            return 0
        n, at, pieces = n + 1, end, rests
    return n


def test_automaton_equals_greedy_on_random_vocabularies():
    rng = random.Random(1)
    make = lambda n: "".join(rng.choice("abc") for _ in range(n)).encode()
    for _ in range(60):
        starts, rests = ({make(rng.randint(1, 6)) for _ in range(rng.randint(0, 12))} for _ in range(2))
        words = [make(rng.randint(1, 14)) for _ in range(80)]
        data = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum([len(w) for w in words])
        got = LongestMatch(starts, rests).count(data, end - [len(w) for w in words], end)
        assert got.tolist() == [greedy(w, starts, rests) for w in words]


def counts_brute(texts):
    starts, rests = map(set, read_vocabulary(tokenizer_file(PIECE_VOCABULARY)))
    memo = {}
    for i, t in enumerate(texts):
        words = WORD.findall(t or "")
        for w in set(words) - memo.keys():
            memo[w] = greedy(w.encode(), starts, rests)
        n = [memo[w] for w in words]
        yield i, len(words), sum(max(x, 1) for x in n), n.count(0)


def test_token_counts_match_greedy(spark):
    texts = odd_texts() + [r["text"] for r in real_docs(spark).limit(40).collect()]
    texts += ["long " * 40000 + "w" * 7000, "\n".join(t or "" for t in texts) * 20]  # very long ones, whole
    got = token_counts(docs_df(spark, texts, extra=True), tokenizer_file(PIECE_VOCABULARY))
    assert sorted(tuple(r.values()) for r in rows_of(got)) == list(counts_brute(texts))
    assert rows_of(token_counts(docs_df(spark, texts).limit(0), tokenizer_file(PIECE_VOCABULARY))) == []


def thue_morse(n):
    """Two words of n bytes that collide under every polynomial modulo 2**64 of an odd base."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_a_polynomial_hash_confuses(spark, n):
    a, b = thue_morse(n)
    data = np.frombuffer((a + b).encode(), np.uint8)
    plain = K.span_hash(K.prefix_hash(data), np.array([0, n]), np.array([n, 2 * n]))
    assert plain[0] == plain[1]
    _, h = K.word_hashes(np.frombuffer(f"{a} {b} {a}".encode(), np.uint8), np.array([0, 3 * n + 2]))
    assert h[0] == h[2] != h[1]
    texts = [a, b, f"{a} x", f"x {b} y {a}"]
    assert sorted(tuple(r.values()) for r in rows_of(token_counts(docs_df(spark, texts), tokenizer_file(PIECE_VOCABULARY)))) == list(counts_brute(texts))
    tokenizer = Tokenizer.from_file(tokenizer_file(WORD_BPE))
    crc = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in rows_of(pack_documents(docs_df(spark, texts), tokenizer_file(WORD_BPE))) if r["piece"] == 0}
    for i, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1][:4096]
        assert crc[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def water(sizes, share=1.5, most=2):
    """Shares by weight, capped and reshared until none is above."""
    sources = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    budget, target, open_ = share * sum(sizes.values()), {}, list(sources)
    while open_:
        level = budget / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= most * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            budget -= target[s]
        open_ = [s for s in open_ if s not in over]
    return target


@pytest.mark.parametrize("sources", [["a"], ["a", "b"], ["b", "a", None, "é", "c", "zz", ""]])
def test_mix(spark, sources):
    rng = random.Random(5)
    texts = [t for t in odd_texts() if len(t or "") < 20000] + ["w " * rng.randint(0, 60) for _ in range(200)]
    from_ = [rng.choice(sources) for _ in texts]
    df = docs_df(spark, texts, from_, extra=True)
    rows = rows_of(mix(df))
    assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
    size = {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}
    by = Counter()
    for i, s in enumerate(from_):
        by[s] += size[i]
    target = water({s: by[s] for s in set(from_)})
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    for s, t in target.items():
        assert abs(taken[s] - t) <= 1, (s, taken[s], t)
    key = lambda x: sorted((r["doc_id"], r["taken"]) for r in x)
    assert key(rows) == key(rows_of(mix(df.repartition(7))))
    assert rows_of(mix(df.limit(0))) == []


def test_fit_reaches_nearly_every_reachable_budget():
    rng, exact, n = random.Random(2), 0, 300
    for _ in range(n):
        lengths = sorted(rng.sample(range(0, 40), rng.randint(1, 6)))
        counts = [rng.randint(1, 6) for _ in lengths]
        sums = {0}
        for length, most in zip(lengths, counts):
            sums = {s + k * length for s in sums for k in range(most + 1)}
        budget = rng.choice(sorted(sums))
        take = fit(np.array(lengths), np.array(counts), budget)
        assert ((0 <= take) & (take <= counts)).all()
        off = abs(int((take * lengths).sum()) - budget)
        assert off <= 40
        exact += off == 0
    assert exact >= 0.95 * n


def check_packing(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_ids_and_places(spark):
    tokenizer = Tokenizer.from_file(tokenizer_file(WORD_BPE))
    texts = odd_texts() + ["<|endoftext|> mid<|startoftext|>dle 's 're é ́x ΑΣ Σ", "İstanbul ﬁ ½ x\u0085y​z"]
    rows = rows_of(pack_documents(docs_df(spark, texts, extra=True), tokenizer_file(WORD_BPE), with_ids=True))
    by_doc = defaultdict(list)
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"])
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["ids"]))
    for i, t in enumerate(texts):
        want = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        parts = sorted(by_doc[i])
        assert [p[:2] for p in parts] == [(k, 4096 * k) for k in range(len(parts))]
        assert all(len(p[2]) == 4096 for p in parts[:-1])
        assert sum((p[2] for p in parts), []) == want
    n = check_packing(rows, 4096)
    assert n <= -(-sum(r["length"] for r in rows) // 4096) + 1
    assert rows_of(pack_documents(docs_df(spark, texts).limit(0), tokenizer_file(WORD_BPE))) == []


def test_packing_given_table_is_tight_and_repeatable(spark):
    df = real_docs(spark)
    runs = [rows_of(pack_documents(x, tokenizer_file(WORD_BPE))) for x in (df, df.repartition(5))]
    assert check_packing(runs[0], 4096) <= 1.01 * sum(r["length"] for r in runs[0]) / 4096 + 1
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["sequence_id"], r["offset"]) for r in rows)
    assert key(runs[0]) == key(runs[1])


def test_plan_uses_every_piece_once():
    rng = random.Random(4)
    for _ in range(40):
        capacity = rng.randint(3, 60)
        histogram = Counter(rng.randint(1, capacity) for _ in range(rng.randint(1, 300)))
        plan = plan_packing(histogram, capacity)
        bins = defaultdict(list)
        for length, n in histogram.items():
            rank = np.arange(n)
            for s, o in zip(*plan.place(np.full(n, length), rank)):
                bins[int(s)].append((int(o), length))
        assert len(bins) == plan.sequences
        for parts in bins.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity


def test_kernel_words_and_hashes():
    import pyarrow as pa

    texts = odd_texts()
    whole = {}
    for rows, data, bounds in K.blocks(pa.array(texts), 300):
        w, h = K.word_hashes(data, bounds)
        for i, t in enumerate(texts[rows]):
            span = slice(w.first[i], w.first[i + 1])
            words = [data[a:b].tobytes().decode() for a, b in zip(w.start[span], w.end[span])]
            assert words == WORD.findall(t or "")
            for word, value in zip(words, h[span].tolist()):
                assert whole.setdefault(word, value) == value
    assert len(set(whole.values())) == len(whole)
