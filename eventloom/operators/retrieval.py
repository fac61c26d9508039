"""Retrieval and enrichment (operators 20-24).

The reference asks a hosted web search for up to 15 results per event. Here
the search is BM25 over a corpus *table*, computed set-at-a-time for all
queries at once. The corpus is indexed once as a table of page blocks
(``eventloom.operators.blockmax``); a batch's query words get their weights by
one join, and chunks of events meet groups of page blocks, pruned by the
largest weight of each word in each block. ``strategy='shuffle'`` is the plain
form: postings are shuffled by page and query words by event, parts of both meet, are
joined on the word and summed by (event, page) there, so that no pair is written, and the
k best of each part are ranked by a window. ``build_index`` can be made once and reused by
many query batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.text import clean_text, trim_ws, words
from eventloom.operators.blockmax import BLOCK_PAGES, BM25_B, BM25_K1, SCORE_DECIMALS, page_blocks, posting_blocks, score_blocks, search_blocks, term_statistics
from eventloom.sources.intake import day_window
from eventloom.sources.tables import discard, staged

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour)
# ---------------------------------------------------------------------------
MAX_RESULTS = 15
SEARCH_DAYS = 1
EXCERPT_SEPARATOR = "\n\n"
EXCERPT_MAX_CHARS = 8000
QUERY_MAX_CHARS = 250
# ---------------------------------------------------------------------------

def build_queries(events: DataFrame, supplied: DataFrame | None = None) -> DataFrame:
    """``(event_id, query, query_too_long)``: one search string per event id.

    A supplied query (``event_id, query``) is trimmed and its newlines become
    spaces; a missing one falls back to the title. Events sharing an id
    (same title) share one query.
    """
    base = events.select("event_id", "title")
    if supplied is not None:
        q = supplied.select("event_id", F.replace(trim_ws(F.col("query")), F.lit("\n"), F.lit(" ")).alias("q"))
        base = base.join(q, "event_id", "left")
        query = F.coalesce(F.col("q"), F.col("title"))
    else:
        query = F.col("title")
    out = base.groupBy("event_id").agg(F.min(query).alias("query"))
    return out.withColumn("query_too_long", F.length("query") > QUERY_MAX_CHARS)


@dataclass
class BM25Index:
    """Page blocks with their postings (written), and corpus statistics."""

    blocks: DataFrame
    n_blocks: int
    n_pages: int
    avgdl: float

    @property
    def postings(self) -> DataFrame:
        """``(page_id, term, tf, dl)``, a row for every word of a page."""
        term = F.explode(F.sequence(F.lit(0), F.size("terms") - 1)).alias("i")
        runs = self.blocks.filter(F.size("terms") > 0).select("page_ids", "dl", "starts", "pages", "tf", "terms", term)
        one = F.struct(F.get("pages", F.col("j")).alias("page"), F.get("tf", F.col("j")).cast("long").alias("tf"))
        rows = runs.withColumn("j", F.explode(F.sequence(F.get("starts", F.col("i")), F.get("starts", F.col("i") + 1) - 1)))
        rows = rows.select("page_ids", "dl", F.get("terms", F.col("i")).alias("term"), one.alias("p"))
        return rows.select(F.get("page_ids", F.col("p.page")).alias("page_id"), "term", F.col("p.tf").alias("tf"), F.get("dl", F.col("p.page")).alias("dl"))

    def release(self) -> None:
        discard(self.blocks)


def build_index(corpus: DataFrame, id_col: str = "page_id", text_col: str = "content", block_pages: int = BLOCK_PAGES) -> BM25Index:
    """Tokenise the corpus once into page blocks, written to the shared scratch folder.

    Words are counted within the page's own row, so page texts are never
    shuffled. Build the index once per corpus and pass it to every batch;
    ``release()`` removes it.
    """
    blocks = page_blocks(corpus, id_col, text_col, block_pages)
    lengths = F.aggregate("dl", F.lit(0).cast("long"), lambda a, x: a + x)
    n_blocks, n_pages, total = blocks.agg(F.count(F.lit(1)), F.sum(F.size("page_ids")), F.sum(lengths)).first()  # pages without words count too
    return BM25Index(blocks, n_blocks, n_pages or 0, float(total or 0) / n_pages if n_pages else 0.0)


def retrieve_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = MAX_RESULTS,
    ts_col: str | None = None,
    run_date=None,
    days: int = SEARCH_DAYS,
    index: BM25Index | None = None,
    strategy: str | None = None,
) -> DataFrame:
    """``(event_id, rank, page_id, url, content, score, chars_before)``: best <= k pages per query.

    ``chars_before`` is how many characters of the event's excerpts lie before the page's at least;
    ``aggregate_results`` need not carry contents beyond its cut.

    Tokens are lower-cased whitespace words; a query's distinct words are
    scored. Ranked by ``round(score, 6) DESC, page_id ASC``. With ``ts_col``
    and ``run_date`` only pages of that day window are searched.

    ``index`` (from ``build_index``) lets many batches share one tokenised
    corpus; without it one is built here and released before returning.

    Plan: ``strategy='blocks'``, the default, searches the page blocks with
    block-max pruning; neither events nor blocks are copied to the cells of a grid.
    ``strategy='shuffle'`` deals postings by page, joins them to query words on the word
    where parts meet, and scores every (event, page) with a common word; of these only
    each part's k best leave a task. Both give the same rows. The winners (<= k per event) are written, and the corpus is
    joined to them without a forced broadcast.
    """
    if strategy not in (None, "blocks", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if ts_col is not None and run_date is not None:
        corpus = day_window(corpus, ts_col, run_date, days)
        index = None  # an index of the whole corpus does not apply to one day
    own_index = index is None
    index = build_index(corpus) if own_index else index
    try:
        if not index.n_pages:
            return _empty_results(queries, corpus)
        page_kind = corpus.schema["page_id"].dataType.simpleString()
        scores = _scores_by_join(queries, index, k) if strategy == "shuffle" else search_pages(queries, index, k, page_kind)
        w = Window.partitionBy("event_id").orderBy(F.round("score", SCORE_DECIMALS).desc(), F.col("page_id").asc())
        ranked = scores.select("event_id", "page_id", "score").withColumn("rank", F.row_number().over(w))
        top = staged(ranked.filter(F.col("rank") <= k), "search-winners")
    finally:
        if own_index:
            index.release()
    return _with_pages(top, corpus)


def _with_pages(top: DataFrame, corpus: DataFrame) -> DataFrame:
    """The winners with their pages. Lengths are joined and added up first, on narrow rows, contents come last."""
    step = F.when(_present(F.col("content")), F.length("content") + len(EXCERPT_SEPARATOR)).otherwise(0).cast("long")
    # Of pages with one id the shortest counts: a lower bound.
    lengths = corpus.groupBy("page_id").agg(F.min(step).alias("_step"))
    earlier = Window.partitionBy("event_id").orderBy("rank").rangeBetween(Window.unboundedPreceding, -1)
    placed = top.join(lengths, "page_id").withColumn("chars_before", F.coalesce(F.sum("_step").over(earlier), F.lit(0)))
    return placed.join(corpus.select("page_id", "url", "content"), "page_id").select(
        "event_id", F.col("rank").cast("int").alias("rank"), "page_id", "url", "content", "score", "chars_before"
    )


def _idf(index: BM25Index):
    return F.log(F.lit(1.0) + (F.lit(index.n_pages) - F.col("df") + 0.5) / (F.col("df") + 0.5))


def _query_terms(queries: DataFrame) -> DataFrame:
    return queries.select("event_id", F.explode(F.array_distinct(words(F.lower(F.col("query"))))).alias("term"))


def search_pages(queries: DataFrame, index: BM25Index, k: int, page_kind: str = "bigint") -> DataFrame:
    """``(event_id, page_id, score, scored)``, written: every event's k best pages, and some that were the best before.

    ``scored`` adds up to the pages whose score was completed.
    """
    statistics = term_statistics(index.blocks, index.avgdl or 1.0, k)
    weighted = _query_terms(queries).join(statistics, "term").select("event_id", F.struct("term", _idf(index).alias("idf")).alias("t"), (_idf(index) * F.col("kth")).alias("floor"))
    events = weighted.groupBy("event_id").agg(F.collect_list("t").alias("t"), F.max("floor").alias("floor"))  # the words of one query
    events = staged(events.select("event_id", F.col("t.term").alias("terms"), F.col("t.idf").alias("idf"), "floor"), "query-terms")
    found = search_blocks(events, index.blocks, k, index.avgdl or 1.0, events.count(), index.n_blocks, page_kind)
    discard(events)
    return found


def _scores_by_join(queries: DataFrame, index: BM25Index, k: int | None = None) -> DataFrame:
    """``(event_id, page_id, score)``, written, of every event and page with a common word; with ``k`` only
    what may be among an event's k best."""
    postings = index.postings
    df_t = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weighted = _query_terms(queries).join(df_t, "term").groupBy("event_id", "term").agg(F.sum(_idf(index)).alias("idf"))
    events = weighted.groupBy("event_id").agg(F.collect_list(F.struct("term", "idf")).alias("t"))  # the words of one query
    events = staged(events.select("event_id", F.col("t.term").alias("terms"), F.col("t.idf").alias("idf")), "query-terms")
    norm = F.lit(BM25_K1) * (F.lit(1 - BM25_B) + F.lit(BM25_B) * F.col("dl") / F.lit(index.avgdl or 1.0))
    weights = postings.select("page_id", "term", (F.col("tf") * F.lit(BM25_K1 + 1) / (F.col("tf") + norm)).alias("weight"))
    page_kind = postings.schema["page_id"].dataType.simpleString()
    found = score_blocks(events, posting_blocks(weights, index.n_pages), k, events.count(), page_kind)
    discard(events)
    return found


def _empty_results(queries: DataFrame, corpus: DataFrame) -> DataFrame:
    return queries.select(
        "event_id",
        F.lit(None).cast("int").alias("rank"),
        F.lit(None).cast(corpus.schema["page_id"].dataType).alias("page_id"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("string").alias("content"),
        F.lit(None).cast("double").alias("score"),
        F.lit(None).cast("long").alias("chars_before"),
    ).limit(0)


def _present(c):
    return c.isNotNull() & (c != F.lit(""))


def aggregate_results(results: DataFrame, max_chars: int | None = EXCERPT_MAX_CHARS) -> DataFrame:
    """Per event: ``sources`` (distinct URLs, first-seen order), ``excerpts``
    (non-empty snippets in rank order, not deduplicated, blank-line joined, first
    ``max_chars`` characters, ``None`` for all) and ``n_results``. One bounded
    group per event (<= k rows). Where the results say how many characters lie
    before a page's, only what the cut leaves of its content is grouped.
    """
    if max_chars is not None and "chars_before" in results.columns:
        # At least one character: the separator before it may be inside the cut.
        room = F.greatest(F.lit(max_chars) - F.col("chars_before"), F.lit(1)).cast("int")
        results = results.withColumn("content", F.substr("content", F.lit(1), room))
    joined = F.array_join(
        F.transform(F.filter("r", lambda x: _present(x["content"])), lambda x: x["content"]), EXCERPT_SEPARATOR
    )
    excerpts = joined if max_chars is None else F.substring(joined, 1, max_chars)
    ordered = F.sort_array(F.collect_list(F.struct("rank", "url", "content")))
    return (
        results.groupBy("event_id")
        .agg(ordered.alias("r"), F.count(F.lit(1)).alias("n_results"))
        .select(
            "event_id",
            "n_results",
            F.array_distinct(
                F.transform(F.filter("r", lambda x: _present(x["url"])), lambda x: x["url"])
            ).alias("sources"),
            excerpts.alias("excerpts"),
        )
    )


def collect_sources(results: DataFrame) -> DataFrame:
    no_content = results.withColumn("content", F.lit(None).cast("string"))  # among one rank the order is by URL, then by content
    return aggregate_results(no_content, None).select("event_id", "sources")


def collect_excerpts(results: DataFrame, max_chars: int | None = EXCERPT_MAX_CHARS) -> DataFrame:
    return aggregate_results(results, max_chars).select("event_id", "excerpts")


def enrich_events(
    events: DataFrame, results: DataFrame, articles: DataFrame | None = None, max_chars: int | None = EXCERPT_MAX_CHARS
) -> DataFrame:
    """Attach sources and a story.

    No result rows: the event is unchanged (empty story, no sources) and is
    still stored. Otherwise ``sources`` are the ordered distinct URLs and
    ``story`` is the supplied article (``event_id, article``) cleaned with
    markdown kept; a missing article falls back to the raw excerpts. Trimmed.
    """
    agg = aggregate_results(results, max_chars).select(
        "event_id", F.col("n_results").alias("_n"), F.col("sources").alias("_src"), F.col("excerpts").alias("_exc")
    )
    joined = events.join(agg, "event_id", "left")
    fresh = F.col("_exc")
    if articles is not None:
        art = articles.select("event_id", clean_text(F.col("article"), citations=True, markdown=False).alias("_art"))
        joined = joined.join(art, "event_id", "left")
        fresh = F.coalesce(F.col("_art"), fresh)
    found = F.coalesce(F.col("_n"), F.lit(0)) > 0
    replaced = {
        "story": F.when(found, trim_ws(fresh)).otherwise(F.col("story")),
        "sources": F.when(found, F.col("_src")).otherwise(F.col("sources")),
    }
    return joined.select(*[replaced.get(c, F.col(c)).alias(c) for c in events.columns])
