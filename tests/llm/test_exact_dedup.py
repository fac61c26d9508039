import hashlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from eventloom.llm.exact_dedup import dedup_decisions, exact_dedup, misra_gries

from .helpers import docs_df, odd_texts, real_docs, rows_of


def brute(ids, texts):
    groups = defaultdict(list)
    for i, t in zip(ids, texts):
        groups[t or ""].append(i)
    return sorted((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in zip(ids, texts))


def got(df):
    return sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows_of(df))


def test_matches_brute_force_with_hot_group_and_few_counters(spark):
    texts = odd_texts() + ["hot"] * 150
    df = docs_df(spark, texts, extra=True)
    for counters in (1, 4, 1024):
        assert got(dedup_decisions(df, counters=counters)) == brute(range(len(texts)), texts)


def test_given_table(spark):
    df = real_docs(spark)
    data = df.select("doc_id", "text").collect()
    assert got(dedup_decisions(df)) == brute([r[0] for r in data], [r[1] for r in data])


def test_repeated_ids_and_empty_table(spark):
    df = docs_df(spark, ["a", "a", "b", None], ids=[5, 5, 1, 2])
    assert got(dedup_decisions(df)) == brute([5, 5, 1, 2], ["a", "a", "b", None])
    assert got(dedup_decisions(df.limit(0))) == []


def test_stage_keeps_columns_and_winners(spark):
    texts = odd_texts()
    df = docs_df(spark, texts)
    kept = exact_dedup(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in rows_of(kept)) == [i for i, _, _, keep, _ in brute(range(len(texts)), texts) if keep]


def test_stage_decides_repeated_ids_row_by_row(spark):
    rows = [(5, "a"), (5, "b"), (6, "a"), (7, "c"), (7, "c"), (None, "a"), (None, "d"), (8, None), (5, "")]
    df = docs_df(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    kept = {(r["doc_id"], r["text"]) for r in rows_of(exact_dedup(df))}
    assert exact_dedup(df).count() == 5 and kept == {(5, "b"), (6, "a"), (7, "c"), (None, "d"), (8, None)}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=200), st.integers(1, 5))
def test_misra_gries_bound(keys, counters):
    parts = [np.array(keys[i : i + 17]) for i in range(0, len(keys), 17)]
    held = misra_gries(iter(parts), counters)
    assert len(held) <= counters
    for key, n in Counter(keys).items():
        assert n - len(keys) / (counters + 1) <= held.get(key, 0) <= n
