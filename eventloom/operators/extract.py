"""Structured extraction: answers -> one row per event (operators 9-12).

Columns find the texts in which an answer's JSON may lie: the unwrapped answer,
its fenced block, what follows its first bracket. Answers whose JSON is proven
plain are read as VARIANT inside the JVM. Spark's JSON differs from the rules
needed (NaN/Infinity, duplicate keys, lone surrogates), so all others, among them
every faulty one, are read by an Arrow-batched pandas UDF, which gets NULL for the
plain ones. Both are narrow: no shuffle, linear in the answer's length. Contract, report and building events are
native Column work too.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.ids import event_id
from eventloom.functions.text import clean_text, strip_reasoning, to_java

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour)
# ---------------------------------------------------------------------------
FENCED_BLOCK = r"```(?:json)?\s*([\[{].*?[\]}])\s*```"  # DOTALL | IGNORECASE
EVENTS_KEY = "events"
REQUESTED_EVENTS = 5
TITLE_MAX_CHARS = 90
SUMMARY_TARGET_CHARS = 500
QUERY_MAX_CHARS = 250
# ---------------------------------------------------------------------------

#: A whole answer that starts so may be JSON by itself, though no object or list.
_SCALAR = r'\A[ \t\n\r]*(?:["0-9-]|(?:true|false|null|NaN|Infinity)[ \t\n\r]*\z)'
_BRACKET = r"\A[ \t\n\r]*[\[{]"
#: An escaped surrogate, of which the JVM keeps no lone half.
_SURROGATE = r"\\u[dD][89a-fA-F]"

_DECODER = json.JSONDecoder()


class NoJson(ValueError):
    pass


def answer_candidates(responses: DataFrame) -> DataFrame:
    """``(response_id, whole, fenced, tail)``: the texts in which an answer's JSON is looked for.

    ``whole`` is the answer unwrapped twice, ``fenced`` its first fenced block (NULL
    without one), ``tail`` what follows the first bracket of either. Each step is
    a projection of its own, as it refers to the last one several times.
    """
    once = responses.select("response_id", strip_reasoning(F.col("content")).alias("once"))
    twice = once.select("response_id", strip_reasoning(F.col("once")).alias("whole"))
    block = twice.select("response_id", "whole", F.regexp_extract("whole", to_java(FENCED_BLOCK, flags="si"), 1).alias("block"))
    text = block.select("response_id", "whole", F.when(F.col("block") != "", F.col("block")).alias("fenced"))
    at = text.withColumn("text", F.coalesce("fenced", "whole")).withColumn("at", F.regexp_instr("text", F.lit(r"[\[{]")))
    return at.select("response_id", "whole", "fenced", F.when(F.col("at") > 0, F.substr("text", F.col("at"))).alias("tail"))


def decode_first(whole: str | None, fenced: str | None, tail: str | None):
    """The value of the first candidate that is JSON; of the tail, its longest prefix that is."""
    for read, text in ((json.loads, whole), (json.loads, fenced), (lambda t: _DECODER.raw_decode(t)[0], tail)):
        if text is not None:
            try:
                return read(text)
            except (ValueError, RecursionError):
                continue
    raise NoJson("no candidate holds JSON")


def _storable(value: str | None) -> bool:
    """Whether a string has an encoding; a lone surrogate (a cut emoji) has none."""
    try:
        return value is None or value.encode() is not None
    except UnicodeEncodeError:
        return False


def _event_entries(candidates: Sequence[str | None]) -> list[tuple]:
    try:
        payload = decode_first(*candidates)
    except NoJson:
        return [(None, None, None, "no_json")]
    if not isinstance(payload, (list, dict)):
        return [(None, None, None, "not_object_or_list")]
    items = payload if isinstance(payload, list) else payload.get(EVENTS_KEY, [])
    if items in ("", {}):
        return []  # an empty string or object holds no events
    if not isinstance(items, list):
        return [(None, None, None, "events_not_array")]
    rows = []
    for idx, item in enumerate(items):
        error, fields = None, (None, None)
        if not isinstance(item, dict):
            error = "item_not_object"
        else:
            fields = (item.get("title"), item.get("summary"))
            if not all(isinstance(f, (str, type(None))) for f in fields):
                error = "field_not_string"
            elif not all(map(_storable, fields)):
                error = "bad_unicode"
        rows.append((idx, *(fields if error is None else (None, None)), error))
    return rows


#: What one answer holds: its events, or one entry for its error.
_ENTRIES = "array<struct<event_idx: int, title: string, summary: string, error: string>>"


def _decode_texts(wanted: pd.Series, whole: pd.Series, fenced: pd.Series, tail: pd.Series) -> pd.Series:
    texts = (column.astype(object).where(column.notna(), None) for column in (whole, fenced, tail))
    return pd.Series([_event_entries(candidates) if asked else None for asked, *candidates in zip(wanted, *texts)], dtype=object)


def plain_entries(candidates: DataFrame) -> DataFrame:
    """Candidates with ``plain``: the events of an answer that is proven plain, else NULL.

    Where the whole answer is not JSON by itself, or is what ``tail`` holds, the value
    sought is the longest prefix of ``tail`` that is JSON, which is what
    ``try_parse_json`` reads. It gives NULL on all that it reads otherwise than
    the JSON rules needed (NaN, duplicate keys); escaped surrogates are kept from it.
    Plain are lists of objects whose title and summary are strings, null or missing.
    """
    only_tail = ~F.col("whole").rlike(_SCALAR) & ~(F.col("whole").rlike(_BRACKET) & F.col("fenced").isNotNull())
    text = F.when(only_tail & ~F.col("tail").rlike(_SURROGATE), F.col("tail"))
    parsed = candidates.withColumn("value", F.try_parse_json(text))
    events = F.when(F.col("tail").startswith("["), F.col("value")).otherwise(F.try_variant_get("value", f"$.{EVENTS_KEY}", "variant"))
    listed = parsed.withColumn("listed", F.try_variant_get(events, "$", "array<variant>"))

    def is_text(item: Column, key: str) -> Column:
        return F.coalesce(F.schema_of_variant(F.try_variant_get(item, f"$.{key}", "variant")), F.lit("VOID")).isin("STRING", "VOID")

    def entry(item: Column, idx: Column) -> Column:
        fields = (F.try_variant_get(item, f"$.{key}", "string").alias(key) for key in ("title", "summary"))
        return F.struct(idx.alias("event_idx"), *fields, F.lit(None).cast("string").alias("error"))

    fits = F.forall("listed", lambda x: F.schema_of_variant(x).startswith("OBJECT") & is_text(x, "title") & is_text(x, "summary"))
    return listed.select("response_id", "whole", "fenced", "tail", F.when(fits, F.transform("listed", entry)).alias("plain"))


def decode_paths(responses: DataFrame) -> DataFrame:
    """``(n_answers, n_python)``: how many answers there are, and how many of them Python reads."""
    return plain_entries(answer_candidates(responses)).agg(F.count(F.lit(1)).alias("n_answers"), F.count_if(F.col("plain").isNull()).alias("n_python"))


def read_by_python(found: DataFrame, wanted: Column) -> DataFrame:
    """Candidates with ``entries``: what Python reads of the answers that are ``wanted``, else NULL.

    Declared non-deterministic, as filters inferred from an explode would repeat it.
    """
    decode = F.pandas_udf(_decode_texts, _ENTRIES).asNondeterministic()
    return found.withColumn("entries", decode(wanted, *(F.when(wanted, F.col(c)) for c in ("whole", "fenced", "tail"))))


def decode_responses(responses: DataFrame) -> DataFrame:
    """One row per event item, or one error row per undecodable answer."""
    read = read_by_python(plain_entries(answer_candidates(responses)), F.col("plain").isNull())
    return read.select("response_id", F.explode(F.coalesce("plain", "entries")).alias("entry")).select("response_id", "entry.*")


def split_decoded(decoded: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(events, quarantine)`` of decoded rows; ``failfast`` aborts on the first bad one."""
    if mode == "failfast":
        title = F.when(F.col("error").isNull(), F.col("title")).otherwise(
            F.raise_error(F.concat(F.lit("undecodable answer: "), F.col("error"))).cast("string"))
        return decoded.withColumn("title", title).drop("error"), _quarantine(decoded.limit(0))
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    return decoded.filter(F.col("error").isNull()).drop("error"), _quarantine(decoded.filter(F.col("error").isNotNull()))


def _quarantine(decoded: DataFrame) -> DataFrame:
    return decoded.select("response_id", "event_idx", F.col("error").alias("reason"))


def extract_events(responses: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(events, quarantine)`` from answers already split by status.

    ``events``: response_id, event_idx, title, summary (NULL when the key is
    missing). ``quarantine``: response_id, event_idx (NULL for a whole
    answer), reason; a title or summary that cannot be stored as UTF-8 is
    ``bad_unicode``. ``failfast`` aborts on the first such row instead.
    """
    return split_decoded(decode_responses(responses), mode)


def contract_reason() -> Column:
    return (
        F.when(F.col("summary").isNull(), F.lit("missing_summary"))
        .when(F.col("title").isNull(), F.lit("missing_title"))
    )


def contract_split(events: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: title and summary are required; extra fields are gone.

    ``failfast`` aborts the job on the first bad item (the reference's
    behaviour), checked inside the executors.
    """
    reason = contract_reason()
    if mode == "failfast":
        checked = events.withColumn(
            "summary",
            F.when(reason.isNull(), F.col("summary")).otherwise(
                F.raise_error(F.concat(F.lit("contract violation: "), reason))
            ).cast("string"),
        )
        return checked, events.limit(0)
    if mode != "quarantine":
        raise ValueError(f"unknown mode {mode!r}")
    tagged = events.withColumn("reason", reason)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())


def contract_report(events: DataFrame) -> DataFrame:
    """Breaches of the requested-but-unenforced limits, per answer."""
    return events.groupBy("response_id").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.greatest(F.count(F.lit(1)) - REQUESTED_EVENTS, F.lit(0)).alias("n_over_requested"),
        F.count_if(F.length("title") > TITLE_MAX_CHARS).alias("n_long_titles"),
        F.count_if(F.length("summary") > SUMMARY_TARGET_CHARS).alias("n_long_summaries"),
        F.count_if(F.col("summary").isNull() | F.col("title").isNull()).alias("n_incomplete"),
    )


def build_events(valid: DataFrame, run_ts: str) -> DataFrame:
    """Stamp date, clean the summary (citations and markdown), keep the title raw.

    ``run_ts`` (UTC, ISO text) replaces the reference's wall clock, so a rerun
    gives the same rows. ``ord`` is the event's place in the batch.
    """
    return valid.select(
        event_id(F.col("title")).alias("event_id"),
        F.lit(run_ts).cast("timestamp").alias("date"),
        "title",
        clean_text(F.col("summary"), citations=True, markdown=True).alias("summary"),
        F.lit("").alias("story"),
        F.array().cast("array<string>").alias("sources"),
        "response_id",
        "event_idx",
    )
