"""Cleaning rules (operators 4-8): literal inputs with the outcome worked out by hand, and properties."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.functions.text import clean_text, strip_citations, strip_markdown, strip_reasoning, trim_ws

REASONING = [
    ("", ""),
    ("   ", ""),
    ("plain text", "plain text"),
    ("  padded\n", "padded"),
    ("<think>plan</think>answer", "answer"),
    ("<think>a</think> one </think> two ", "two"),  # the last marker counts
    ("no opening</think>rest", "rest"),
    ("<think>never closed", "<think>never closed"),
    ("text </think>", ""),
    ('<think>x</think>\n```json\n{"a": 1}\n```', '{"a": 1}'),
    ("```\nfenced\n```", "fenced"),
    ("```json x", "x"),
    ("```json```json x", "json x"),  # one json fence, then one bare fence
    ("``````", ""),
    ("only end```", "only end"),
    ("```JSON\nx\n```", "JSON\nx"),  # the label is lower case only
    ("a ``` b", "a ``` b"),  # fences inside stay
    ("\u3000wide\u00a0", "wide"),
    ("\x1c\x1dseparators\x1f", "separators"),
]

CITATIONS = [
    ("a [1] b", "a  b"),
    ("a [12][3] b", "a  b"),
    ("says [Reuters] so", "says  so"),
    ("one letter [A] stays", "one letter [A] stays"),
    ("a list [12, 13] stays", "a list [12, 13] stays"),
    ("[link](http://x.y)", "(http://x.y)"),
    ("[ Reuters] stays", "[ Reuters] stays"),
    ("[] stays", "[] stays"),
    ("arabic [\u0663\u0664] digits", "arabic  digits"),
    ("[Ab\nc] over lines", " over lines"),
    ("[[1]]", "[]"),
]

MARKDOWN = [
    ("# Title", "Title"),
    ("###### six", "six"),
    ("####### seven", "# seven"),
    ("a # b", "a # b"),
    ("#none", "none"),
    ("- item\n* star\n+ plus", "item\nstar\nplus"),
    ("  - indented", "indented"),
    ("-tight", "-tight"),
    ("1. one\n  22. two", "one\ntwo"),
    ("1.5 stays", "1.5 stays"),
    ("\u0661. arabic item", "arabic item"),
    ("a\n---\nb", "a\n\nb"),
    ("a\n***\nb", "a\n\nb"),
    ("--", "--"),
    ("**bold** __u__ *i* _j_", "bold u i j"),
    ("snake_case", "snakecase"),
    ("line\r# not a line start", "line\r# not a line start"),
    ("line\r\n# heading", "line\r\nheading"),
    ("x\u0085- no line start", "x\u0085- no line start"),
    ("#\n\nafter", "after"),  # the heading's space takes the line breaks
]

CLEAN = [
    ("<think>t</think>\n# Head [1]\n**Body** [Reuters].", True, True, "Head \nBody ."),
    ("<think>t</think>\n# Head [1]\n**Body** [Reuters].", True, False, "# Head \n**Body** ."),
    ("<think>t</think>\n# Head [1]\n**Body** [Reuters].", False, False, "# Head [1]\n**Body** [Reuters]."),
    ("```json\n[2] tail [7]\n```", True, True, "tail"),
    ("_", True, True, ""),
]

PIECES = list("ab #*-_+.[]12\n\r\t") + [" ", "\u3000", "\u0663", "\u00a0", "\x85", "\u2028", "</think>", "```", "```json", "[1]", "[Ab]"]
texts = st.lists(st.sampled_from(PIECES), max_size=25).map("".join)
PROPERTY = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def run_all(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    out = df.select("i", fn(F.col("t")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


@pytest.mark.parametrize("cases,rule", [(REASONING, strip_reasoning), (CITATIONS, strip_citations), (MARKDOWN, strip_markdown)])
def test_rules_on_literal_cases(spark, cases, rule):
    got = run_all(spark, [c[0] for c in cases], rule)
    assert list(zip([c[0] for c in cases], got)) == cases


def test_recipes_on_literal_cases(spark):
    for text, citations, markdown, want in CLEAN:
        assert run_all(spark, [text], lambda c: clean_text(c, citations, markdown)) == [want], text


@PROPERTY
@given(st.lists(texts, min_size=1, max_size=40))
def test_properties_of_the_full_recipe(spark, values):
    for text, out in zip(values, run_all(spark, values, lambda c: clean_text(c, citations=True, markdown=True))):
        assert out == out.strip()
        assert not set(out) & set("*_") and "</think>" not in out
        # What is left is what was there: nothing is added or moved.
        rest = iter(text)
        assert all(ch in rest for ch in out), text


@PROPERTY
@given(st.lists(texts, min_size=1, max_size=40))
def test_properties_of_single_rules(spark, values):
    for text, out in zip(values, run_all(spark, values, strip_citations)):
        assert "[1]" not in out or "[[1]]" in text or "[" in text.replace("[1]", "")
        assert out == text or re.search(r"\[", text)
    for text, out in zip(values, run_all(spark, values, strip_reasoning)):
        assert out == out.strip() and out in text


def test_trim_matches_python_strip(spark):
    values = [" \t x \n", "\u00a0y\u3000", "\x1cz\x1f", "", "none"]
    assert run_all(spark, values, trim_ws) == [v.strip() for v in values]


def test_null_stays_null(spark):
    assert run_all(spark, [None], lambda c: clean_text(c, True, True)) == [None]


def test_words_split_at_every_python_space_and_nowhere_else(spark):
    from eventloom.functions.text import words

    codes = [c for c in range(0x3100) if c] + [0xFEFF, 0xFFFD, 0x1F600]
    rows = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "c int, t string").select("c", words(F.col("t")).alias("w")).collect()
    assert {r.c for r in rows if len(r.w) == 2} == {c for c in codes if chr(c).isspace()}
