"""Embedding (13-14) and chunking (25)."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from eventloom.operators.stores import chunk_table
from eventloom.operators.vectors import embed_table, overview_text


def python_vector(text: str, dim: int = 256) -> np.ndarray:
    toks = text.lower().split()
    terms = [f"{a} {b}" for a, b in zip(toks, toks[1:])] if len(toks) >= 2 else toks
    v = np.zeros(dim)
    for t in terms:
        h = hashlib.md5(t.encode()).hexdigest()
        v[int(h[:7], 16) % dim] += -1.0 if int(h[7], 16) % 2 else 1.0
    n = np.linalg.norm(v)
    return v / n if n else v


def test_embedding_matches_python(spark):
    texts = ["", "   ", "one", "Alpha beta GAMMA beta", "the the the the", "Été très\tchaud\naujourd'hui"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    rows = embed_table(df, "id", "t", dim=64).orderBy("id").collect()
    for r in rows:
        assert len(r.vector) == 64
        np.testing.assert_allclose(np.array(r.vector), python_vector(texts[r.id], 64), atol=1e-12)
    assert not any(rows[0].vector) and not any(rows[1].vector)


def test_custom_embedder_hook(spark):
    import pandas as pd

    def lengths(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [float(len(t)), 1.0])

    df = spark.createDataFrame([(1, "abc")], "id int, t string")
    assert embed_table(df, "id", "t", embedder=lengths).first().vector == [3.0, 1.0]


def test_overview_text_keeps_null(spark):
    df = spark.createDataFrame([("T", "S"), ("T", None)], "title string, summary string")
    assert [r.o for r in df.select(overview_text(F.col("title"), F.col("summary")).alias("o")).collect()] == ["T S", None]


def test_chunks_match_reference_intent(spark):
    text500 = " ".join(f"w{i}" for i in range(500))
    cases = [(0, ""), (1, "   "), (2, "one two three four five"), (3, text500), (4, " a\n b\tc ")]
    df = spark.createDataFrame(cases, "id int, t string")
    for n in (10, 100, 300):
        got = {}
        for r in chunk_table(df, "id", "t", n=n).collect():
            got.setdefault(r.id, []).append((r.chunk_index, r.chunk))
        for i, text in cases:
            found = [c for _, c in sorted(got.get(i, []))]
            sizes = [len(c.split(" ")) for c in found]
            assert " ".join(found).split(" ") == (text.split() or [""]), (i, n)  # every word once, in order
            assert all(size == n for size in sizes[:-1]) and all(0 < size <= n for size in sizes), (i, n)
            assert [i for i, _ in sorted(got.get(i, []))] == list(range(len(found)))
    assert chunk_table(df.filter("id = 3"), "id", "t", n=100).count() == 5


def test_texts_go_to_python_in_small_batches_and_the_setting_comes_back(spark):
    from eventloom.plans import catalog
    from eventloom.session import ensure_engine_conf

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    ensure_engine_conf(spark)
    before = spark.conf.get(key)
    catalog.built_events(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(key)) <= 1024
    ensure_engine_conf(spark)
    assert spark.conf.get(key) == before


def test_every_distinct_bigram_is_hashed_once(monkeypatch):
    """Vectors as with hashlib, words of any length and bytes; texts that repeat cost one hash a bigram."""
    import random

    import pyarrow as pa

    from eventloom.operators import vectors

    rng = random.Random(5)
    vocab = ["é" * rng.randint(1, 30) + "x" * rng.randint(0, 4) for _ in range(40)] + ["a", "b", "w" * 53, "w" * 54, "w" * 55, "w" * 56, "w" * 300, "日本"]
    texts = [[rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 90]))] for _ in range(60)]
    hashed, plain = [], vectors.term_codes
    monkeypatch.setattr(vectors, "term_codes", lambda names, first, second: hashed.append(len(first)) or plain(names, first, second))
    for words_at_a_time in (1, 500, vectors.BATCH_WORDS):
        monkeypatch.setattr(vectors, "BATCH_WORDS", words_at_a_time)
        hashed.clear()
        got = vectors._densify(32)(pa.array(texts * 5, pa.list_(pa.string())).slice(3)).to_pylist()
        for vector, toks in zip(got, (texts * 5)[3:], strict=True):
            np.testing.assert_allclose(vector, python_vector(" ".join(toks), 32), atol=1e-12)
    terms = {p for t in texts for p in ([tuple(t)] if len(t) == 1 else zip(t, t[1:]))}
    assert sum(hashed) == len(terms)
