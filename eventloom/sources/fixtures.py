"""Inputs of the reference's shapes, derived deterministically from the given tables.

The reference consumes model answers, search results and stored history from
hosted services. Here they are Spark projections of the test tables, so every
job's work grows with the tables. Nothing is sampled or capped. Every page is one
corpus row. Without faults every document becomes one event; with faults (the
input of the status, extraction and contract jobs, whose feature they are) the
answers of some ids are refused, have no JSON or lack a field.

* ``responses``: documents grouped five to an answer (the reference asks for
  five events per answer). An event's title is the document's first line and
  its summary the whole rest of the text. Answers are wrapped in the styles
  real answers arrive in, chosen by ``response_id % 10``; status is 500 for
  ``response_id % 11 = 0``. ``faults=False`` uses only the whole styles, in turn,
  and status 200.
* ``corpus``: pages with content = text of ``<p>...</p>`` elements, tags
  blanked to a space, joined by a space.
* ``decorated_text``: documents / conversation turns with markdown, citations,
  reasoning blocks and fences added by id, for the cleaning jobs.
* ``history`` / ``probes``: labelled documents are the stored collection,
  unlabelled ones the incoming batch (a split on data, not on ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENTS_PER_RESPONSE = 5
N_STYLES = 10
ERROR_EVERY = 11
CUT_EVERY, CUT_AT = 13, 4  # answers whose line is cut, where answers are JSON lines
BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
SECONDS_PER_RESPONSE = 997
SECONDS_PER_PAGE = 600
PAGE_OFFSET = 13 * 86400  # the first pages are two days older than the run's day
WHOLE_STYLES = (0, 1, 2, 3, 4, 7)  # styles whose answers hold all their events

# Fixed wrapper texts for the answer styles.
THINK_TEXT = "<think>\nThe user wants the five most significant events. I will answer in JSON.\n</think>\n"
PROSE_BEFORE = "Here are the most significant events of the day:\n"
PROSE_AFTER = "\nEach item was checked against two sources."
NO_JSON_TEXT = "No significant events could be confirmed for this date."
FENCE_LEAD = "Sure. The requested data follows.\n```JSON\n"
FENCE_TAIL = "\n```\nLet me know if you need more."


def title_of(text: Column) -> Column:
    """First line of the text (whole text when there is no newline)."""
    return F.substring_index(text, "\n", 1)


def body_of(text: Column) -> Column:
    """Everything after the first newline ('' when there is none)."""
    return F.substr(text, F.length(title_of(text)) + F.lit(2))


def raw_summary(doc_id: Column, text: Column) -> Column:
    """Summary as the model would send it: body with a citation / heading by id."""
    body = body_of(text)
    cited = (
        F.when(doc_id % 3 == 1, F.concat(body, F.lit(" ["), (doc_id % 9 + 1).cast("string"), F.lit("]")))
        .when(doc_id % 3 == 2, F.concat(body, F.lit(" [Reuters]")))
        .otherwise(body)
    )
    return F.when(doc_id % 4 == 3, F.concat(F.lit("## "), cited)).otherwise(cited)


def responses(documents: DataFrame, faults: bool = True) -> DataFrame:
    """``(response_id, status, content, ts)`` answers built from ``documents``."""
    docs = documents.select(
        "doc_id",
        (F.col("doc_id") / EVENTS_PER_RESPONSE).cast("long").alias("response_id"),
        title_of(F.col("text")).alias("title"),
        raw_summary(F.col("doc_id"), F.col("text")).alias("summary"),
    )
    style = F.col("response_id") % N_STYLES
    if not faults:
        style = F.array(*map(F.lit, WHOLE_STYLES))[(F.col("response_id") % len(WHOLE_STYLES)).cast("int")]
    first_in_response = F.col("doc_id") % EVENTS_PER_RESPONSE == 0
    item = F.when(
        (style == 5) & first_in_response, F.to_json(F.struct("title"))
    ).otherwise(F.to_json(F.struct("title", "summary")))
    # At most five documents per answer: a bounded group, never a hot key.
    grouped = (
        docs.select("response_id", "doc_id", item.alias("item"))
        .groupBy("response_id")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "item"))).alias("items"))
        .select("response_id", F.array_join(F.transform("items", lambda x: x["item"]), ",").alias("items"))
    )
    obj = F.concat(F.lit('{"events":['), F.col("items"), F.lit("]}"))
    content = (
        F.when(style == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
        .when(style == 2, F.concat(F.lit(THINK_TEXT + "```json\n"), obj, F.lit("\n```")))
        .when(style == 3, F.concat(F.lit(PROSE_BEFORE), obj, F.lit(PROSE_AFTER)))
        .when(style == 4, F.concat(F.lit("["), F.col("items"), F.lit("]")))
        .when(style == 6, F.lit(NO_JSON_TEXT))
        .when(style == 7, F.concat(F.lit(FENCE_LEAD), obj, F.lit(FENCE_TAIL)))
        .when(style == 8, F.lit('{"events":"none"}'))
        .when(style == 9, F.concat(F.lit('{"results":['), F.col("items"), F.lit("]}")))
        .otherwise(obj)
    )
    return grouped.select(
        "response_id",
        F.when(F.lit(faults) & (F.col("response_id") % ERROR_EVERY == 0), F.lit(500)).otherwise(F.lit(200)).alias("status"),
        content.alias("content"),
        F.timestamp_seconds(F.col("response_id") * SECONDS_PER_RESPONSE + BASE_EPOCH).alias("ts"),
    )


def corpus(pages: DataFrame) -> DataFrame:
    """``(page_id, url, content, ts)``: paragraph text of each page, a page every ten minutes."""
    paragraphs = F.regexp_extract_all(F.col("html"), F.lit(r"(?s)<p>(.*?)</p>"), 1)
    content = F.array_join(F.transform(paragraphs, lambda p: F.regexp_replace(p, r"<[^>]*>", " ")), " ")
    ts = F.timestamp_seconds(F.col("page_id") * SECONDS_PER_PAGE + BASE_EPOCH + PAGE_OFFSET)
    return pages.select("page_id", "url", content.alias("content"), ts.alias("ts"))


def decorated_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add markdown, citations, reasoning blocks and fences by id (LF only)."""
    i = F.col(id_col)
    t = F.col(text_col)
    md = i % 7
    marked = (
        F.when(md == 0, F.concat(F.lit("# "), F.replace(t, F.lit("\n"), F.lit("\n## "))))
        .when(md == 1, F.concat(F.lit("- "), F.replace(t, F.lit("\n"), F.lit("\n* "))))
        .when(md == 2, F.concat(F.lit("1. "), F.replace(t, F.lit("\n"), F.lit("\n2. "))))
        .when(md == 3, F.concat(F.lit("**"), t, F.lit("**\n---")))
        .when(md == 4, F.replace(t, F.lit(". "), F.lit(" [1]. ")))
        .when(md == 5, F.concat(t, F.lit(" [Reuters]")))
        .otherwise(F.concat(t, F.lit("\n***\n_end_")))
    )
    th = i % 3
    wrapped = (
        F.when(th == 1, F.concat(F.lit("<think>plan the answer</think>\n"), marked))
        .when(th == 2, F.concat(F.lit("```json\n"), marked, F.lit("\n```")))
        .otherwise(marked)
    )
    return df.withColumn(text_col, wrapped)


def labelled_split(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(history, probes)``: documents with a label row / without one."""
    # Semi/anti joins never duplicate a document, so labels need no distinct.
    keys = labels.select("doc_id")
    return documents.join(keys, "doc_id", "left_semi"), documents.join(keys, "doc_id", "left_anti")
