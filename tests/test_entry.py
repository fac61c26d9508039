"""Driver contract: entry, queries and oracles line up."""

import __spark_entry__ as entry

SURVEY_KEYS = {
    "read_responses", "split_by_status", "day_window", "strip_reasoning", "strip_citations", "strip_markdown",
    "clean_table", "cleaning_report", "extract_events", "contract_split", "contract_report", "build_events",
    "overview_text", "embed_table", "similarity_topk", "flag_duplicates", "semantic_anti_join",
    "semantic_anti_join_batch", "similarity_join_lsh", "build_queries", "retrieve_topk", "collect_sources",
    "collect_excerpts", "enrich_events", "chunk_table", "overview_vectors", "chunk_vectors", "upsert_vectors",
    "compact_vectors", "append_articles", "run_pipeline", "pipeline_stats", "stream_pipeline",
}


def test_every_survey_operator_is_registered_with_an_oracle():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert SURVEY_KEYS <= set(queries)
    assert set(oracles) <= set(queries)
    assert SURVEY_KEYS - set(oracles) == set()


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["event_id", "title", "best_score", "best_match_id", "ord"]
    assert df.count() > 0


def test_shared_folder_with_a_scheme_leaves_no_local_file(spark, tmp_path, monkeypatch):
    from eventloom import session

    monkeypatch.chdir(tmp_path)
    monkeypatch.setattr(spark.sparkContext, "_eventloom_shipped", False, raising=False)
    session.ship_package(spark)
    assert list(tmp_path.iterdir()) == []


def test_answers_are_decoded_once_for_all_steps_that_read_events(spark, monkeypatch):
    """Queries, articles and enrichment read one written table of events."""
    from eventloom.plans import catalog

    decoded, plain = [], catalog.decoded_events
    monkeypatch.setattr(catalog, "decoded_events", lambda *a, **k: decoded.append(1) or plain(*a, **k))
    for query in (catalog.q_enrich_events, catalog.q_enrich_events_articles):
        decoded.clear()
        df = query(spark, "/root/testdata/sf0.001")
        assert len(decoded) == 1
        assert "VariantGet" not in df._jdf.queryExecution().optimizedPlan().toString()  # no answer is decoded again
