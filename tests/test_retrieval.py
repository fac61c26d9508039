"""Queries, BM25 top-k, sources, excerpts and enrichment (20-24)."""

import math

from pyspark.sql import functions as F

from eventloom.operators.retrieval import (
    aggregate_results,
    build_queries,
    enrich_events,
    retrieve_topk,
)


def events(spark, rows):
    return spark.createDataFrame(
        [(eid, t, "", []) for eid, t in rows], "event_id string, title string, story string, sources array<string>"
    )


def test_query_fallback_and_newlines(spark):
    ev = events(spark, [("e1", "Title one"), ("e2", "Title two")])
    supplied = spark.createDataFrame([("e1", "  line one\nline two  ")], "event_id string, query string")
    got = {r.event_id: r.query for r in build_queries(ev, supplied).collect()}
    assert got == {"e1": "line one line two", "e2": "Title two"}


def test_bm25_matches_formula(spark):
    corpus = spark.createDataFrame(
        [(1, "u1", "apple banana apple"), (2, "u2", "banana cherry"), (3, "u3", "durian"), (4, "u4", "")],
        "page_id long, url string, content string")
    queries = spark.createDataFrame([("q", "Apple banana APPLE")], "event_id string, query string")
    got = {r.page_id: (r.rank, r.score) for r in retrieve_topk(queries, corpus, k=15).collect()}
    n, avgdl = 4, 6 / 4

    def idf(df):
        return math.log(1 + (n - df + 0.5) / (df + 0.5))

    def part(tf, dl, df):
        return idf(df) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))

    assert set(got) == {1, 2}
    assert math.isclose(got[1][1], part(2, 3, 1) + part(1, 3, 2))
    assert math.isclose(got[2][1], part(1, 2, 2))
    assert got[1][0] == 1 and got[2][0] == 2


def test_both_strategies_agree_and_leave_nothing_cached(spark):
    corpus = spark.createDataFrame([(i, f"u{i}", " ".join(["common"] * (i % 4) + [f"w{i % 7}", "x"])) for i in range(60)],
                                   "page_id long, url string, content string")
    queries = spark.createDataFrame([(f"q{i}", f"w{i} common") for i in range(9)], "event_id string, query string")
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    rows = [sorted((r.event_id, r.rank, r.page_id, round(r.score, 9)) for r in retrieve_topk(queries, corpus, strategy=s).collect())
            for s in ("blocks", "shuffle", None)]
    assert rows[0] == rows[1] == rows[2] and rows[0]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_sources_first_seen_and_excerpts(spark):
    results = spark.createDataFrame(
        [("e", 1, "a", "x"), ("e", 2, "b", ""), ("e", 3, "a", "y"), ("e", 4, None, "z"), ("e", 5, "", None)],
        "event_id string, rank int, url string, content string")
    r = aggregate_results(results).first()
    assert r.sources == ["a", "b"]
    assert r.excerpts == "x\n\ny\n\nz"
    assert r.n_results == 5


def test_excerpt_cap(spark):
    results = spark.createDataFrame([("e", i, f"u{i}", "é" * 3000) for i in range(1, 5)],
                                    "event_id string, rank int, url string, content string")
    assert len(aggregate_results(results).first().excerpts) == 8000
    assert len(aggregate_results(results, max_chars=None).first().excerpts) == 4 * 3000 + 3 * 2


def test_enrich_no_results_unchanged_and_article_branch(spark):
    ev = events(spark, [("e1", "T1"), ("e2", "T2"), ("e3", "T3")])
    results = spark.createDataFrame(
        [("e1", 1, "u1", "  snippet one  "), ("e1", 2, "u2", "two"), ("e3", 1, "u3", "three")],
        "event_id string, rank int, url string, content string")
    articles = spark.createDataFrame([("e3", "# Head [1]\n**Body** [Reuters]"), ("e1", None)],
                                     "event_id string, article string")
    out = {r.event_id: r for r in enrich_events(ev, results, articles).collect()}
    assert out["e1"].story == "snippet one  \n\ntwo" and out["e1"].sources == ["u1", "u2"]
    assert out["e2"].story == "" and out["e2"].sources == []
    assert out["e3"].story == "# Head \n**Body**" and out["e3"].sources == ["u3"]
    plain = {r.event_id: r.story for r in enrich_events(ev, results).collect()}
    assert plain["e3"] == "three"


def test_block_search_completes_few_scores_and_loses_none(spark):
    """Random pages and queries over many small blocks: the same rows as the join, a fraction of its pairs."""
    import random

    from eventloom.operators import retrieval

    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    pages = [(i, f"u{i}", " ".join(rng.choices(vocab, weights, k=rng.randint(0, 120)))) for i in range(1500)] + [(9000, "n", None), (9001, "e", "")]
    corpus = spark.createDataFrame(pages, "page_id long, url string, content string").repartition(5)
    queries = spark.createDataFrame(
        [(f"q{i}", " ".join(rng.choices(vocab, weights, k=rng.randint(1, 25)))) for i in range(120)] + [("none", "unknown"), ("blank", " "), ("null", None)],
        "event_id string, query string")
    index = retrieval.build_index(corpus, block_pages=64)
    assert index.n_blocks > 15 and index.n_pages == 1502
    found = retrieval.search_pages(queries, index, 15)
    scored = found.agg(F.sum("scored")).first()[0]
    pairs = retrieval._scores_by_join(queries, index).count()
    print("completed scores:", scored, "of", pairs)
    assert scored * 5 < pairs
    rows = [sorted((r.event_id, r.rank, r.page_id, round(r.score, 6)) for r in retrieve_topk(queries, corpus, index=index, strategy=s).collect()) for s in ("blocks", "shuffle")]
    assert rows[0] == rows[1] and len(rows[0]) > 1000
    index.release()


def test_many_chunks_meet_many_groups_without_a_grid(spark, monkeypatch):
    """Neither events nor blocks are dealt to grid cells; ties and null texts as in the join."""
    import random

    from eventloom.operators import blockmax

    monkeypatch.setattr(blockmax, "CHUNK_EVENTS", 16)
    monkeypatch.setattr(blockmax, "GROUP_BLOCKS", 2)
    monkeypatch.setattr(blockmax, "DENSE_PAGES", 3)
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(60)]
    pages = [(i, f"u{i % 50}", " ".join(rng.choices(vocab[: 1 + i % 60], k=i % 23))) for i in range(400)] + [(500, "n", None)]
    corpus = spark.createDataFrame(pages, "page_id long, url string, content string")
    queries = spark.createDataFrame([(f"q{i}", " ".join(rng.choices(vocab, k=1 + i % 9))) for i in range(70)], "event_id string, query string")
    from eventloom.operators import retrieval

    index = retrieval.build_index(corpus, block_pages=16)
    rows = [sorted((r.event_id, r.rank, r.page_id, round(r.score, 6)) for r in retrieve_topk(queries, corpus, k=7, index=index, strategy=s).collect()) for s in ("blocks", "shuffle")]
    assert rows[0] == rows[1] and len(rows[0]) > 300
    assert retrieval.search_pages(queries, index, 7).count() < 70 * 7 * 5  # not k for every event and group
    index.release()


def test_grouped_contents_end_at_the_cut(spark):
    """Contents beyond the cut are not grouped, and the excerpts are the same."""
    texts = ["a" * 30, "", None, "b" * 9, "c" * 59, "d", "e" * 400, "f" * 50]
    corpus = spark.createDataFrame([(i, f"u{i}", f"w{i} " + t if t else t) for i, t in enumerate(texts)] + [(3, "u3b", "w3 short")],
                                   "page_id long, url string, content string")
    queries = spark.createDataFrame([("q", " ".join(f"w{i}" for i in range(8))), ("p", "w3 w6")], "event_id string, query string")
    found = retrieve_topk(queries, corpus)
    assert "chars_before" in found.columns
    plain = found.drop("chars_before")
    for cut in (1, 33, 34, 35, 36, 48, 100, 200, 1000):
        got, want = (sorted((r.event_id, r.sources, r.excerpts, r.n_results) for r in aggregate_results(f, cut).collect()) for f in (found, plain))
        assert got == want


def test_few_of_the_scores_by_join_leave_a_task(spark):
    """Every pair is scored where parts meet; with k what is written grows with events, not with pairs."""
    from eventloom.operators import retrieval

    n_events, n_pages = 600, 1200
    corpus = spark.createDataFrame([(i, f"u{i}", f"the of w{i % 50} " + "x " * (i % 9)) for i in range(n_pages)], "page_id long, url string, content string")
    queries = spark.createDataFrame([(f"q{i}", f"the of w{i % 50}") for i in range(n_events)], "event_id string, query string")
    index = retrieval.build_index(corpus, block_pages=64)
    assert retrieval._scores_by_join(queries, index).count() == n_events * n_pages
    rows = [sorted((r.event_id, r.rank, r.page_id, round(r.score, 6)) for r in retrieve_topk(queries, corpus, index=index, strategy=s).collect()) for s in ("blocks", "shuffle")]
    assert rows[0] == rows[1] and len(rows[0]) == n_events * 15
    assert retrieval._scores_by_join(queries, index, 15).count() < n_events * n_pages // 10
    index.release()


def test_rows_of_one_page_id_are_one_page_for_the_join(spark):
    """Null and repeated page ids, repeated events: sums as the join of postings and words gives them."""
    from collections import defaultdict

    from eventloom.operators import retrieval

    pages = [(1, "a", "red red blue"), (1, "b", "red"), (None, "n", "blue"), (None, "m", "blue green"), (2, "c", "green"), (3, "d", None), (4, "e", "")]
    pages += [(100 + i, f"u{i}", f"red w{i}") for i in range(30)]
    corpus = spark.createDataFrame(pages, "page_id long, url string, content string")
    asked = [("p", "red blue"), ("p", "red"), (None, "green"), ("none", "zzz"), ("null", None)]
    index = retrieval.build_index(corpus, block_pages=2)
    df, total = defaultdict(int), defaultdict(float)
    texts = [(i, (t or "").split()) for i, _, t in pages]
    avgdl = sum(len(t) for _, t in texts) / len(texts)
    for _, t in texts:
        for w in set(t):
            df[w] += 1
    for event, query in asked:
        for w in set((query or "").split()):
            for page, t in texts:
                if w in t:
                    idf = math.log(1 + (len(texts) - df[w] + 0.5) / (df[w] + 0.5))
                    total[event, page] += idf * t.count(w) * 2.2 / (t.count(w) + 1.2 * (0.25 + 0.75 * len(t) / avgdl))
    queries = spark.createDataFrame(asked, "event_id string, query string")
    got = {(r.event_id, r.page_id): r.score for r in retrieval._scores_by_join(queries, index).collect()}
    assert set(got) == set(total) and all(math.isclose(got[x], total[x]) for x in total)
    few = retrieval._scores_by_join(queries, index, 3).collect()
    for event in ("p", None):
        best = sorted((x for x in total if x[0] == event), key=lambda x: (-round(total[x], 6), x[1] is not None, x[1] or 0))[:3]
        assert set(best) <= {(r.event_id, r.page_id) for r in few}
    index.release()


def test_totals_in_single_precision_leave_few_pages_to_score(spark):
    """Long queries over pages of one language, which bounds of words cannot tell apart: the rows of the join, near ties among them."""
    import random

    from eventloom.operators import retrieval

    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 3) for i in range(300)]
    pages = [(i, f"u{i}", " ".join(rng.choices(vocab, weights, k=rng.randint(40, 200)))) for i in range(1200)]
    pages += [(5000 + i, "t", "w1 w2 w3 w250") for i in range(40)]
    corpus = spark.createDataFrame(pages, "page_id long, url string, content string").repartition(4)
    queries = spark.createDataFrame([(f"q{i}", " ".join(rng.choices(vocab, weights, k=rng.randint(30, 60)))) for i in range(60)] + [("tied", "w250 w2")], "event_id string, query string")
    index = retrieval.build_index(corpus, block_pages=256)
    scored = retrieval.search_pages(queries, index, 15).agg(F.sum("scored")).first()[0]
    pairs = retrieval._scores_by_join(queries, index).count()
    assert 61 * 15 <= scored and scored * 20 < pairs
    rows = [sorted((r.event_id, r.rank, r.page_id, round(r.score, 6)) for r in retrieve_topk(queries, corpus, index=index, strategy=s).collect()) for s in ("blocks", "shuffle")]
    assert rows[0] == rows[1] and len(rows[0]) == 61 * 15
    index.release()


def test_a_word_in_few_or_many_pages_counts_alike(monkeypatch):
    """Scores of a group do not depend on which words have a row of weights, and a null page id counts as in the ranking."""
    import pyarrow as pa

    from eventloom.operators import blockmax

    blocks = pa.table({"page_ids": [[3, None, 1], [2]], "dl": [[2, 1, 2], [1]], "terms": [["a", "b"], ["b"]], "starts": [[0, 3, 5], [0, 1]], "pages": [[0, 1, 2, 0, 2], [0]], "tf": [[1, 1, 1, 1, 1], [1]]})
    chunk = pa.table({"event_id": ["x", "y", "z"], "terms": [["b", "a"], ["zzz"], ["a"]], "idf": [[2.0, 1.0], [1.0], [1.0]], "floor": [0.0, 0.0, 0.0]})
    found = []
    for dense in (1, 2, 99):
        monkeypatch.setattr(blockmax, "DENSE_PAGES", dense)
        table = blockmax.search_cell(blockmax._Events(chunk, 2), blockmax._Group(blocks, lambda t, row: blockmax._weights(t, row, 1.5)))
        found.append(sorted((e, p is None, p or 0, round(s, 9)) for e, p, s in zip(*(table.column(c).to_pylist() for c in ("event_id", "page_id", "score")))))
    assert found[0] == found[1] == found[2]
    assert [x[:3] for x in found[0]] == [("x", False, 1), ("x", False, 3), ("z", False, 1), ("z", True, 0)]
