import random

from eventloom.llm.common import prepare, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, texts, sources=None, ids=None, extra=False, parts=3):
    """A documents table from texts; ``extra`` adds columns whose names clash with internal ones."""
    prepare(spark)
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    if extra:
        from pyspark.sql import functions as F

        for name in ("id", "size", "digest", "rank", "count", "token", "n", "label", "start", "__word"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def real_docs(spark):
    prepare(spark)
    return table(spark, SF, "documents")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def odd_texts(seed=3):
    rng = random.Random(seed)
    vocab = ["the", "of", "and", "thing", "ünïcode", "naïve", "x", "[[", "東京", "don't", "12,5", "A" * 40]
    texts = [None, "", " ", "\t\n", "one", "one", "one two", " lead and trail ", "a b c", "\x00 nul", "😀 emoji 😀"]
    for _ in range(25):
        texts.append(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 80))))
    texts += [texts[-1], texts[-1], " ".join(rng.choice(vocab) for _ in range(9000)), "z" * 5000]
    return texts
