"""A training corpus from ``documents``: quality filter, exact and near dedup, mixing, packing.

Every stage takes what its predecessor kept. All but the last return the columns
of documents; the last returns the packed pieces. Stages are written to the
shared scratch folder as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import doc_column, number_rows, prepare, stage, table
from eventloom.llm.exact_dedup import exact_dedup
from eventloom.llm.mixing import mix
from eventloom.llm.ngram_join import near_dedup
from eventloom.llm.packing import pack_documents
from eventloom.llm.quality import keep_quality
from eventloom.llm.queries import WORD_BPE, tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``labels``, scores at least 0.5."""
    prepare(spark)
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    prepare(spark)
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of those linked by a Jaccard similarity of at least 0.8 of five-word shingles."""
    prepare(spark)
    return near_dedup(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0, 1 or 2 times."""
    prepare(spark)
    rows = number_rows(docs, "mixture-rows")  # numbered and packed, so that any column names pass
    narrow = rows.select("__row", doc_column("text").alias("text"), doc_column("source").alias("source"))
    times = mix(narrow, id_col="__row").select(F.col("__row").alias("taken"), F.col("times").cast("int").alias("times")).filter("times > 0")
    copies = rows.join(times, rows["__row"] == times["taken"]).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return copies.select("doc.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    prepare(spark)
    return pack_documents(docs, tokenizer_file(WORD_BPE))


STAGES = [
    ("quality", quality),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

#: Trees, lasso fits and knapsacks are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
