"""Registered queries: one Spark job per operator over the given tables.

Each entry is ``(spark, sf_dir) -> DataFrame``. Output conventions, shared
with the SQL oracles in ``eventloom.plans.oracle``: arrays are rendered as
text (``array_join``), timestamps as ``yyyy-MM-dd HH:mm:ss`` text, scores
rounded to 6 decimals, integers as bigint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.ids import event_key
from eventloom.functions.text import clean_text, strip_citations, strip_markdown, strip_reasoning
from eventloom.operators import extract, retrieval, similarity, stores, vectors
from eventloom.operators.snapshots import SnapshotStore
from eventloom.plans import pipeline
from eventloom.session import remember_setting, scratch_path
from eventloom.sources import fixtures
from eventloom.sources.intake import day_window, read_responses, split_by_status
from eventloom.sources.tables import discard, read_table, staged

SPREAD_TABLES = {"documents", "pages", "conversations"}
RUN_TS = "2024-01-15 00:00:00"
RUN_DATE = "2024-01-15"
DIM = vectors.DEFAULT_DIM
BATCH_ROWS = "512"  # of whole answers or texts in an Arrow batch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Small tables (labels, the day-window scan) need no spreading.
    return read_table(spark, sf_dir, name, spread=name in SPREAD_TABLES)


def _ts_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _r6(c):
    return F.round(c, 6)


def _text_list(c):
    return F.array_join(c, " ")


# --------------------------------------------------------------------------- fixtures

def responses_df(spark, sf_dir, faults: bool = True) -> DataFrame:
    return fixtures.responses(_table(spark, sf_dir, "documents"), faults)


def decoded_events(spark, sf_dir, faults: bool = True) -> DataFrame:
    ok, _ = split_by_status(responses_df(spark, sf_dir, faults))
    events, _ = extract.extract_events(ok)
    return events


def small_batches(spark) -> None:
    """Whole answers and texts go to Python: batches of so few rows bound a worker's memory (the caller's setting comes back)."""
    remember_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def built_events(spark, sf_dir) -> DataFrame:
    """Every document as an event: answers without faults."""
    small_batches(spark)
    valid, _ = extract.contract_split(decoded_events(spark, sf_dir, faults=False))
    return extract.build_events(valid, RUN_TS).withColumn("ord", event_key(F.col("response_id"), F.col("event_idx")))


def seed_events(spark, sf_dir) -> DataFrame:
    """Stored history: labelled documents as events (same title/summary rule)."""
    history, _ = fixtures.labelled_split(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    raw = history.select(
        "doc_id",
        fixtures.title_of(F.col("text")).alias("title"),
        fixtures.raw_summary(F.col("doc_id"), F.col("text")).alias("summary"),
    )
    return extract.build_events(raw.withColumn("response_id", F.col("doc_id")).withColumn(
        "event_idx", F.lit(0)), RUN_TS).withColumn("ord", event_key(F.col("response_id"), F.lit(0)))


def with_overview_vector(events: DataFrame) -> DataFrame:
    return vectors.embed_table(events.withColumn("_o", vectors.overview_text(F.col("title"), F.col("summary"))),
                               "ord", "_o", DIM)


def embedded_docs(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """``(history, probes)`` documents with vectors: labelled vs unlabelled.

    Split first, then embed each side once and write it: several jobs read it.
    """
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    history, probes = fixtures.labelled_split(docs, _table(spark, sf_dir, "labels"))
    return (staged(vectors.embed_table(history, "doc_id", "text", DIM).drop("text"), "history-vectors"),
            staged(vectors.embed_table(probes, "doc_id", "text", DIM).drop("text"), "probe-vectors"))


def corpus_df(spark, sf_dir) -> DataFrame:
    return fixtures.corpus(_table(spark, sf_dir, "pages"))


def search_results(spark, sf_dir, events: DataFrame | None = None, **options) -> DataFrame:
    queries = retrieval.build_queries(built_events(spark, sf_dir) if events is None else events)
    return retrieval.retrieve_topk(queries, corpus_df(spark, sf_dir), **options)


def written_events(spark, sf_dir) -> DataFrame:
    """``built_events``, written: answers are decoded and cleaned once, however many steps read them."""
    return staged(built_events(spark, sf_dir), "built-events")


def enriched_events(spark, sf_dir) -> DataFrame:
    events = written_events(spark, sf_dir)
    return retrieval.enrich_events(events, search_results(spark, sf_dir, events))


def supplied_queries(events: DataFrame) -> DataFrame:
    """Queries that a caller supplies: for events of an even index, the title's words upside down in two lines."""
    ev = events.filter(F.col("event_idx") % 2 == 0).groupBy("event_id").agg(F.min("title").alias("title"))
    return ev.select("event_id", F.concat(F.lit("  news on\n"), F.col("title"), F.lit(" ")).alias("query"))


def supplied_articles(events: DataFrame) -> DataFrame:
    """Articles that a caller supplies for events of an odd index: their summary with a citation."""
    ev = events.filter(F.col("event_idx") % 2 == 1).groupBy("event_id").agg(F.min("summary").alias("summary"))
    return ev.select("event_id", F.concat(F.col("summary"), F.lit(" [3] [Reuters]")).alias("article"))


# --------------------------------------------------------------------------- 2.1 sources

def q_read_responses(spark, sf_dir):
    path = scratch_path(spark, "responses")
    responses_df(spark, sf_dir).write.parquet(path)
    df = read_responses(spark, path)
    return df.select("response_id", F.col("status").cast("long").alias("status"), _ts_text(F.col("ts")).alias("ts"),
                     "content")


def q_split_by_status(spark, sf_dir):
    ok, rejected = split_by_status(responses_df(spark, sf_dir))
    return ok.select("response_id", F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("response_id", F.lit(False).alias("accepted"), "reason")
    )


def q_day_window(spark, sf_dir):
    ev = day_window(_table(spark, sf_dir, "events"), "ts", RUN_DATE)
    return ev.select("event_id", _ts_text(F.col("ts")).alias("ts"), "user_id", "event_type", "value")


# --------------------------------------------------------------------------- 2.2 cleaning

def _decorated_docs(spark, sf_dir):
    return fixtures.decorated_text(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), "doc_id", "text")


def q_strip_reasoning(spark, sf_dir):
    return _decorated_docs(spark, sf_dir).select("doc_id", strip_reasoning(F.col("text")).alias("text"))


def q_strip_citations(spark, sf_dir):
    return _decorated_docs(spark, sf_dir).select("doc_id", strip_citations(F.col("text")).alias("text"))


def q_strip_markdown(spark, sf_dir):
    return _decorated_docs(spark, sf_dir).select("doc_id", strip_markdown(F.col("text")).alias("text"))


def q_clean_table(spark, sf_dir):
    conv = _table(spark, sf_dir, "conversations")
    ids = conv.withColumn("_k", F.col("conv_id") * 1000 + F.col("turn"))
    dec = fixtures.decorated_text(ids, "_k", "text")
    return dec.select("conv_id", "turn", "role", clean_text(F.col("text"), citations=True, markdown=True).alias("text"))


def q_cleaning_report(spark, sf_dir):
    dec = _decorated_docs(spark, sf_dir)
    cleaned = clean_text(F.col("text"), citations=True, markdown=True)
    return (
        dec.select("source", F.col("text").alias("raw"), cleaned.alias("clean"))
        .groupBy("source")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("raw") != F.col("clean")).alias("n_changed"),
            F.sum(F.length("raw") - F.length("clean")).alias("chars_removed"),
        )
    )


# --------------------------------------------------------------------------- 2.3 extraction

def q_extract_events(spark, sf_dir):
    return decoded_events(spark, sf_dir).select("response_id", F.col("event_idx").cast("long").alias("event_idx"),
                                                "title", "summary")


def q_extract_quarantine(spark, sf_dir):
    ok, _ = split_by_status(responses_df(spark, sf_dir))
    _, quarantine = extract.extract_events(ok)
    return quarantine.select("response_id", "reason")


def q_contract_split(spark, sf_dir):
    valid, rejected = extract.contract_split(decoded_events(spark, sf_dir))
    return valid.select("response_id", F.col("event_idx").cast("long").alias("event_idx"), F.lit(True).alias("accepted"),
                        F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select("response_id", F.col("event_idx").cast("long").alias("event_idx"), F.lit(False).alias("accepted"),
                        "reason"))


def q_contract_report(spark, sf_dir):
    return extract.contract_report(decoded_events(spark, sf_dir))


def q_build_events(spark, sf_dir):
    b = built_events(spark, sf_dir)
    return b.select("event_id", _ts_text(F.col("date")).alias("date"), "title", "summary", "story",
                    F.size("sources").cast("long").alias("n_sources"), "response_id",
                    F.col("event_idx").cast("long").alias("event_idx"))


# --------------------------------------------------------------------------- 2.4 vectors

def q_overview_text(spark, sf_dir):
    b = built_events(spark, sf_dir)
    return b.select("response_id", F.col("event_idx").cast("long").alias("event_idx"),
                    vectors.overview_text(F.col("title"), F.col("summary")).alias("overview"))


def q_embed_table(spark, sf_dir):
    docs = vectors.embed_table(_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", DIM)
    return vectors.sparse_entries(docs, "doc_id").select(
        "doc_id", F.col("dim_index").cast("long").alias("dim_index"), _r6(F.col("value")).alias("value"))


def q_similarity_topk(spark, sf_dir):
    history, probes = embedded_docs(spark, sf_dir)
    h = history.select(F.col("doc_id").alias("match_id"), F.col("vector").alias("hvec"))
    top = similarity.similarity_topk(probes, h, k=similarity.DEDUP_TOP_K, probe_id="doc_id", hist_id="match_id",
                                     hist_vec_col="hvec", dim=DIM)
    return top.select(F.col("doc_id").alias("probe_id"), "match_id", _r6(F.col("score")).alias("score"),
                      F.col("rank").cast("long").alias("rank"))


def q_similarity_topk_grid(spark, sf_dir):
    """The same search through a grid of many small blocks."""
    history, probes = embedded_docs(spark, sf_dir)
    h = history.select(F.col("doc_id").alias("match_id"), F.col("vector").alias("hvec"))
    top = similarity.similarity_topk(probes, h, k=similarity.DEDUP_TOP_K, probe_id="doc_id", hist_id="match_id",
                                     hist_vec_col="hvec", dim=DIM, block_rows=max(64, history.count() // 6))
    return top.select(F.col("doc_id").alias("probe_id"), "match_id", _r6(F.col("score")).alias("score"),
                      F.col("rank").cast("long").alias("rank"))


def q_join_embeddings(spark, sf_dir):
    """Given vectors attached to documents by id."""
    given = _table(spark, sf_dir, "embeddings")
    docs = _table(spark, sf_dir, "documents").select("doc_id")
    joined = vectors.join_embeddings(docs, given.withColumnRenamed("vec_id", "doc_id"), "doc_id", "embedding")
    return joined.select("doc_id", F.size("vector").cast("long").alias("n"),
                         _weight(F.transform("vector", lambda x: x.cast("double"))).alias("weight"))


def q_flag_duplicates(spark, sf_dir):
    history, probes = embedded_docs(spark, sf_dir)
    h = history.select(F.col("doc_id").alias("match_id"), F.col("vector").alias("hvec"))
    flagged = similarity.flag_duplicates(probes, h, probe_id="doc_id", hist_id="match_id", hist_vec_col="hvec",
                                           dim=DIM)
    return flagged.select(F.col("doc_id").alias("probe_id"), "is_duplicate", _r6(F.col("best_score")).alias("best_score"),
                          "best_match_id")


def q_semantic_anti_join(spark, sf_dir):
    history, probes = embedded_docs(spark, sf_dir)
    h = history.select(F.col("doc_id").alias("match_id"), F.col("vector").alias("hvec"))
    survivors, _ = similarity.semantic_anti_join(probes, h, probe_id="doc_id", hist_id="match_id", hist_vec_col="hvec",
                                                 dim=DIM)
    return survivors.select("doc_id")


def q_semantic_anti_join_batch(spark, sf_dir):
    history, probes = embedded_docs(spark, sf_dir)
    h = history.select(F.col("doc_id").alias("match_id"), F.col("vector").alias("hvec"))
    survivors, _ = similarity.semantic_anti_join(
        probes.withColumn("ord", F.col("doc_id")), h, probe_id="doc_id", hist_id="match_id", hist_vec_col="hvec",
        scope="history+batch", order_col="ord", dim=DIM)
    return survivors.select("doc_id")


def q_similarity_join_lsh(spark, sf_dir):
    history, probes = embedded_docs(spark, sf_dir)
    h = history.select(F.col("doc_id").alias("match_id"), F.col("vector").alias("hvec"))
    pairs = similarity.similarity_join_lsh(probes, h, probe_id="doc_id", hist_id="match_id", hist_vec_col="hvec",
                                           dim=DIM)
    return pairs.select(F.col("doc_id").alias("probe_id"), "match_id", _r6(F.col("score")).alias("score"))


# --------------------------------------------------------------------------- 2.5 retrieval

def q_build_queries(spark, sf_dir):
    return retrieval.build_queries(built_events(spark, sf_dir))


def q_build_queries_supplied(spark, sf_dir):
    events = built_events(spark, sf_dir)
    return retrieval.build_queries(events, supplied_queries(events))


def _results_out(r: DataFrame) -> DataFrame:
    return r.select("event_id", F.col("rank").cast("long").alias("rank"), "page_id", _r6(F.col("score")).alias("score"))


def q_retrieve_topk(spark, sf_dir):
    return _results_out(search_results(spark, sf_dir))


def q_retrieve_topk_shuffle(spark, sf_dir):
    return _results_out(search_results(spark, sf_dir, strategy="shuffle"))


def q_retrieve_topk_day(spark, sf_dir):
    return _results_out(search_results(spark, sf_dir, ts_col="ts", run_date=RUN_DATE))


def q_collect_sources(spark, sf_dir):
    s = retrieval.collect_sources(search_results(spark, sf_dir))
    return s.select("event_id", _text_list(F.col("sources")).alias("sources"),
                    F.size("sources").cast("long").alias("n_sources"))


def q_collect_excerpts(spark, sf_dir):
    return retrieval.collect_excerpts(search_results(spark, sf_dir))


def q_collect_excerpts_full(spark, sf_dir):
    return retrieval.collect_excerpts(search_results(spark, sf_dir), max_chars=None)


def q_enrich_events_articles(spark, sf_dir):
    events = written_events(spark, sf_dir)
    e = retrieval.enrich_events(events, search_results(spark, sf_dir, events), supplied_articles(events))
    return e.select("event_id", "response_id", F.col("event_idx").cast("long").alias("event_idx"), "story",
                    _text_list(F.col("sources")).alias("sources"))


def q_enrich_events(spark, sf_dir):
    e = enriched_events(spark, sf_dir)
    return e.select("event_id", "response_id", F.col("event_idx").cast("long").alias("event_idx"), "story",
                    _text_list(F.col("sources")).alias("sources"))


# --------------------------------------------------------------------------- 2.6 stores

def q_chunk_table(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return stores.chunk_table(docs, "doc_id", "text").select(
        "doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "chunk")


def _nnz(c):
    return F.size(F.filter(c, lambda x: x != 0)).cast("long")


def _weight(c):
    """Sum of the entries by place, so that an entry that is wrong or in a wrong place shows."""
    return _r6(F.aggregate(F.transform(c, lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x))


def q_overview_vectors(spark, sf_dir):
    rec = stores.overview_vectors(with_overview_vector(built_events(spark, sf_dir)))
    return rec.select("namespace", "id", "event_id", "title", "summary", _nnz(F.col("vector")).alias("nnz"),
                      _weight(F.col("vector")).alias("weight"), "ord")


def q_chunk_vectors(spark, sf_dir):
    rec = stores.chunk_vectors(enriched_events(spark, sf_dir), dim=DIM)
    return rec.select("namespace", "id", "event_id", "title", F.col("chunk_index").cast("long").alias("chunk_index"), "text",
                      _text_list(F.col("sources")).alias("sources"), _nnz(F.col("vector")).alias("nnz"),
                      _weight(F.col("vector")).alias("weight"), "ord")


def _seed_and_batch_store(spark, sf_dir) -> SnapshotStore:
    """A store with batch 0 = labelled documents, batch 1 = this run's events."""
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.commit(0, stores.overview_vectors(with_overview_vector(seed_events(spark, sf_dir))))
    store.commit(1, stores.overview_vectors(with_overview_vector(built_events(spark, sf_dir))))
    return store


def _view_out(view: DataFrame) -> DataFrame:
    return view.select("namespace", "id", "version", "title", "summary", _nnz(F.col("vector")).alias("nnz"),
                       _weight(F.col("vector")).alias("weight"), "ord")


def q_upsert_vectors(spark, sf_dir):
    return _view_out(_seed_and_batch_store(spark, sf_dir).vectors())


def q_compact_vectors(spark, sf_dir):
    """The view after the store's attempts were merged into one."""
    store = _seed_and_batch_store(spark, sf_dir)
    store.compact(small_bytes=1 << 62, fan_in=2)
    return _view_out(store.vectors())


def _chunk_log(spark, sf_dir) -> str:
    """Chunks of every document's text in batch 1; in batch 2 documents of an odd id again, without a story."""
    small_batches(spark)
    path = scratch_path(spark, "vectors")
    docs = _table(spark, sf_dir, "documents").select(
        F.concat(F.lit("event_"), F.col("doc_id").cast("string")).alias("event_id"), fixtures.title_of(F.col("text")).alias("title"),
        F.col("text").alias("story"), F.lit("").alias("summary"), F.array().cast("array<string>").alias("sources"),
        event_key(F.col("doc_id"), F.lit(0)).alias("ord"), "doc_id")
    embedded = vectors.embed_table(docs, "ord", "title", DIM)
    stores.upsert_vectors(stores.overview_vectors(embedded).unionByName(stores.chunk_vectors(docs, dim=DIM)), path, 1)
    stores.upsert_vectors(stores.overview_vectors(embedded.filter(F.col("doc_id") % 2 == 1)), path, 2)
    return path


def q_prune_stale(spark, sf_dir):
    log = stores.read_vector_log(spark, _chunk_log(spark, sf_dir))
    view = stores.latest_vectors(log, stores.RESEARCH_NAMESPACE, prune_stale=True, columns=["event_id", "chunk_index", "text", "version"])
    return view.select("id", "event_id", F.col("chunk_index").cast("long").alias("chunk_index"), "text", "version")


def q_research_search(spark, sf_dir):
    """Nearest stored chunks of the research namespace for every overview of an unlabelled document's title."""
    log = stores.read_vector_log(spark, _chunk_log(spark, sf_dir))
    chunks = stores.latest_vectors(log, stores.RESEARCH_NAMESPACE, before_batch=2, columns=["vector"])
    _, probes = fixtures.labelled_split(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))
    probes = staged(vectors.embed_table(probes, "doc_id", "text", DIM).drop("text"), "probe-vectors")
    top = similarity.similarity_topk(probes, chunks.select(F.col("id").alias("chunk"), F.col("vector").alias("hvec")), k=3,
                                     probe_id="doc_id", hist_id="chunk", hist_vec_col="hvec", dim=DIM)
    return top.select("doc_id", "chunk", _r6(F.col("score")).alias("score"), F.col("rank").cast("long").alias("rank"))


def q_append_articles(spark, sf_dir):
    path = scratch_path(spark, "articles")
    stores.append_articles(enriched_events(spark, sf_dir), path, 1)
    art = stores.read_articles(spark, path)
    return art.select("event_id", "batch_id", "title", "story", _text_list(F.col("sources")).alias("sources"), "ord")


def _seeded_store(spark, sf_dir) -> SnapshotStore:
    store = SnapshotStore(spark, scratch_path(spark, "store"))
    store.commit(0, stores.overview_vectors(with_overview_vector(seed_events(spark, sf_dir))))
    return store


def _pipeline_run(spark, sf_dir, faults: bool = False, **options):
    return pipeline.run_pipeline(spark, responses_df(spark, sf_dir, faults), corpus_df(spark, sf_dir), None, None,
                                 batch_id=1, run_ts=RUN_TS, store=_seeded_store(spark, sf_dir), **options)


def _articles_out(art: DataFrame):
    return art.select("event_id", "title", "summary", "story", _text_list(F.col("sources")).alias("sources"), "ord")


def q_run_pipeline(spark, sf_dir):
    return _articles_out(_pipeline_run(spark, sf_dir).store.articles())


def q_run_pipeline_supplied(spark, sf_dir):
    """The whole flow with queries and articles that a caller supplies."""
    events = written_events(spark, sf_dir)
    run = _pipeline_run(spark, sf_dir, supplied_queries=supplied_queries(events), articles=supplied_articles(events))
    discard(events)
    return _articles_out(run.store.articles())


def q_run_pipeline_day(spark, sf_dir):
    """The whole flow with the search limited to the day of the run's stamp."""
    return _articles_out(_pipeline_run(spark, sf_dir, search_ts_col="ts").store.articles())


def q_run_quarantine(spark, sf_dir):
    """Rows that a run over answers with faults rejects."""
    bad = _pipeline_run(spark, sf_dir, faults=True).store.quarantine()
    return bad.select("response_id", F.col("event_idx").cast("long").alias("event_idx"), "reason")


def q_run_quarantine_lines(spark, sf_dir):
    """Rows that a run over answers in JSON lines rejects, some lines cut in the middle."""
    path = scratch_path(spark, "answer-lines")
    line = F.to_json(F.struct("response_id", "status", "content", "ts"))
    cut = F.when(F.col("response_id") % fixtures.CUT_EVERY == fixtures.CUT_AT, F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    responses_df(spark, sf_dir).select(cut.alias("value")).write.text(path)
    run = pipeline.run_pipeline(spark, read_responses(spark, path, fmt="json"), corpus_df(spark, sf_dir), None, None,
                                batch_id=1, run_ts=RUN_TS, store=_seeded_store(spark, sf_dir))
    return run.store.quarantine().select("response_id", F.col("event_idx").cast("long").alias("event_idx"), "reason")


def q_pipeline_stats(spark, sf_dir):
    return _pipeline_run(spark, sf_dir).stats


STREAM_PARTS = 3


def _streamed(spark, sf_dir, parts: int) -> DataFrame:
    """Articles of a stream whose input arrives in ``parts`` ranges of answer ids, a micro-batch each."""
    from eventloom.streaming.stream import stream_pipeline

    store, inbox, checkpoint = _seeded_store(spark, sf_dir), scratch_path(spark, "inbox"), scratch_path(spark, "stream-ckpt")
    answers = responses_df(spark, sf_dir, faults=False)
    first, last = answers.agg(F.min("response_id"), F.max("response_id")).first()
    part = F.expr(f"(response_id - {first or 0}) * {parts} div {(last or 0) - (first or 0) + 1}")
    corpus = corpus_df(spark, sf_dir)
    index = retrieval.build_index(corpus)
    try:
        for i in range(parts):
            answers.filter(part == i).write.parquet(f"{inbox}/part={i}")
            stream_pipeline(spark, f"{inbox}/*", corpus, None, None, checkpoint, run_ts=RUN_TS, batch_offset=1, index=index, store=store).awaitTermination()
    finally:
        index.release()
    return store.articles()


def q_stream_pipeline(spark, sf_dir):
    return _articles_out(_streamed(spark, sf_dir, 1))


def q_stream_micro_batches(spark, sf_dir):
    """What each of several micro-batches stores; each sees those before it as history."""
    art = _streamed(spark, sf_dir, STREAM_PARTS)
    return _articles_out(art).join(art.select("ord", "batch_id"), "ord")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "read_responses": q_read_responses,
    "split_by_status": q_split_by_status,
    "day_window": q_day_window,
    "strip_reasoning": q_strip_reasoning,
    "strip_citations": q_strip_citations,
    "strip_markdown": q_strip_markdown,
    "clean_table": q_clean_table,
    "cleaning_report": q_cleaning_report,
    "extract_events": q_extract_events,
    "extract_quarantine": q_extract_quarantine,
    "contract_split": q_contract_split,
    "contract_report": q_contract_report,
    "build_events": q_build_events,
    "overview_text": q_overview_text,
    "embed_table": q_embed_table,
    "similarity_topk": q_similarity_topk,
    "similarity_topk_grid": q_similarity_topk_grid,
    "join_embeddings": q_join_embeddings,
    "flag_duplicates": q_flag_duplicates,
    "semantic_anti_join": q_semantic_anti_join,
    "semantic_anti_join_batch": q_semantic_anti_join_batch,
    "similarity_join_lsh": q_similarity_join_lsh,
    "build_queries": q_build_queries,
    "build_queries_supplied": q_build_queries_supplied,
    "retrieve_topk": q_retrieve_topk,
    "retrieve_topk_shuffle": q_retrieve_topk_shuffle,
    "retrieve_topk_day": q_retrieve_topk_day,
    "collect_sources": q_collect_sources,
    "collect_excerpts": q_collect_excerpts,
    "collect_excerpts_full": q_collect_excerpts_full,
    "enrich_events": q_enrich_events,
    "enrich_events_articles": q_enrich_events_articles,
    "chunk_table": q_chunk_table,
    "overview_vectors": q_overview_vectors,
    "chunk_vectors": q_chunk_vectors,
    "upsert_vectors": q_upsert_vectors,
    "compact_vectors": q_compact_vectors,
    "prune_stale": q_prune_stale,
    "research_search": q_research_search,
    "append_articles": q_append_articles,
    "run_pipeline": q_run_pipeline,
    "run_pipeline_supplied": q_run_pipeline_supplied,
    "run_pipeline_day": q_run_pipeline_day,
    "run_quarantine": q_run_quarantine,
    "run_quarantine_lines": q_run_quarantine_lines,
    "pipeline_stats": q_pipeline_stats,
    "stream_pipeline": q_stream_pipeline,
    "stream_micro_batches": q_stream_micro_batches,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers -> events -> vectors -> flags vs the stored collection -> survivors.

    The stored collection is the labelled documents' events, held as the
    latest-wins view (one vector per event id) the vector log would give.
    """
    events = with_overview_vector(built_events(spark, sf_dir)).drop("_o")
    seed = stores.overview_vectors(with_overview_vector(seed_events(spark, sf_dir)))
    history = stores.latest_vectors(seed.withColumn("version", F.lit(0).cast("long")), columns=["vector"])
    flagged = pipeline.flag_batch(events, history, dim=DIM)
    return flagged.filter(~F.col("is_duplicate")).select(
        "event_id", "title", _r6(F.col("best_score")).alias("best_score"), "best_match_id", "ord")
