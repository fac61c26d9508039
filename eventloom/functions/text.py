"""Text-cleaning rules as native Column expressions (no Python in the hot path).

Every function maps a string Column to a string Column, so a whole cleaning
recipe collapses into one projection inside whole-stage codegen.

Regex dialect notes (Java regex is Spark's engine):
* Python's ``str.strip()`` / ``\\s`` know more whitespace than Java's ``\\s``;
  ``WS`` below is the Python set written for Java.
* Python's ``\\d`` is any Unicode decimal digit: Java ``\\p{Nd}``.
* Python's MULTILINE ``^``/``$`` only break at ``\\n``: Java needs ``(?md)``
  (``d`` = UNIX_LINES) or it also breaks at ``\\r``, U+0085, U+2028, U+2029.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference behaviour)
# ---------------------------------------------------------------------------
THINK_CLOSE = "</think>"
FENCE_JSON = "```json"
FENCE = "```"
NUMERIC_CITATION = r"\[\d+\]"
TEXT_CITATION = r"\[[A-Za-z][^\]]+\]"
HEADING = r"^#{1,6}\s*"
BULLET = r"^\s*[-*+]\s+"
NUMBERED = r"^\s*\d+\.\s+"
RULE = r"^(?:-{3,}|\*{3,})$"
EMPHASIS_CHARS = "*_"
# ---------------------------------------------------------------------------

# Python's whitespace set (str.isspace) as a Java character class.
WS = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# The same set, written so that a character which is none is ruled out by few tests.
SPLIT_WS = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"


def to_java(pattern: str, multiline: bool = False, flags: str = "") -> str:
    """Rewrite a Python-flavoured pattern so Java matches what Python matches."""
    out = pattern.replace(r"\s", WS).replace(r"\d", r"\p{Nd}")
    flags += "md" * multiline
    return f"(?{flags}){out}" if flags else out


# Python's whitespace, by its own rule (str.isspace; nothing above U+3000 is space).
WS_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def trim_ws(c: Column) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace.

    ``btrim`` with a character set touches only the ends, not the whole text.
    """
    return F.btrim(c, F.lit(WS_CHARS))


def _drop_prefix(c: Column, prefix: str) -> Column:
    return F.when(c.startswith(prefix), F.substr(c, F.lit(len(prefix) + 1))).otherwise(c)


def _drop_suffix(c: Column, suffix: str) -> Column:
    return F.when(c.endswith(suffix), F.substr(c, F.lit(1), F.length(c) - len(suffix))).otherwise(c)


def strip_reasoning(c: Column) -> Column:
    """Keep the text after the last ``</think>``; unwrap one JSON code fence.

    No marker keeps the whole text. After each step the text is trimmed.
    """
    after = F.substring_index(c, THINK_CLOSE, -1)
    out = trim_ws(after)
    out = trim_ws(_drop_prefix(out, FENCE_JSON))
    out = trim_ws(_drop_prefix(out, FENCE))
    out = trim_ws(_drop_suffix(out, FENCE))
    return out


def strip_citations(c: Column) -> Column:
    """Drop ``[12]`` style then ``[Reuters]`` style citations (no space collapse)."""
    out = F.regexp_replace(c, to_java(NUMERIC_CITATION), "")
    return F.regexp_replace(out, to_java(TEXT_CITATION), "")


def strip_markdown(c: Column) -> Column:
    """Drop headings, bullets, numbered markers, rules, then every ``*``/``_``."""
    out = c
    for rule in (HEADING, BULLET, NUMBERED, RULE):
        out = F.regexp_replace(out, to_java(rule, multiline=True), "")
    # Removing "**", "__", "*", "_" in any order removes every such character.
    return F.translate(out, EMPHASIS_CHARS, "")


def clean_text(c: Column, citations: bool = True, markdown: bool = False) -> Column:
    """The full recipe: reasoning/fence strip, citations, markdown, final trim."""
    out = strip_reasoning(c)
    if citations:
        out = strip_citations(out)
    if markdown:
        out = strip_markdown(out)
    return trim_ws(out)


def words(c: Column) -> Column:
    """Python ``str.split()``: whitespace-separated, no empty pieces."""
    return F.filter(F.split(c, SPLIT_WS + "+"), lambda w: w != F.lit(""))
