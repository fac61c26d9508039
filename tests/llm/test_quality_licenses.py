import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventloom.llm import kernel as K
from eventloom.llm.common import prepare, table
from eventloom.llm.licenses import RULES, SENTENCES, apply_rules, build_tables, license_scan
from eventloom.llm.quality import STATISTICS, fit_rules, keep_quality, quality_scores, statistics

from .helpers import SF, docs_df, odd_texts, rows_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    raw = (text or "").encode()
    w = WORD.findall(raw)
    share = lambda a, b: a / b if b else 0.0
    count = lambda chars: sum(raw.count(bytes([c])) for c in chars.encode())
    upper, lower = count("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), count("abcdefghijklmnopqrstuvwxyz")
    lines = raw.split(b"\n")
    lines = lines[:-1] if lines[-1] == b"" else lines
    triples = list(zip(w, w[1:], w[2:]))
    values = {
        "bytes": len(raw), "words": len(w), "word_bytes": share(sum(map(len, w)), len(w)), "longest_word": max(map(len, w), default=0),
        "upper": share(upper, upper + lower), "digits": share(count("0123456789"), len(raw)), "symbols": share(count("#$%&*@^~<>{}[]\\=+_`/"), len(raw)),
        "marks": share(count(".,;:?'\"()-"), len(raw)), "exclamations": share(count("!"), len(raw)), "pipes": share(count("|"), len(raw)),
        "other_bytes": share(sum(b >= 128 for b in raw), len(raw)), "spaces": share(count(" \t\n\v\f\r"), len(raw)), "lines": len(lines),
        "line_words": share(len(w), len(lines)), "distinct_words": share(len(set(w)), len(w)), "twin_words": share(sum(a == b for a, b in zip(w, w[1:])), len(w)),
        "top_word": share(max(Counter(w).values(), default=0), len(w)), "distinct_triples": share(len(set(triples)), len(triples)),
        "repeated_lines": share(len(lines) - len(set(lines)), len(lines)), "byte_entropy": -sum(c / len(raw) * math.log2(c / len(raw)) for c in Counter(raw).values()) if raw else 0.0,
    }
    return [values[n] for n in STATISTICS]


def test_statistics_match_plain_python():
    texts = odd_texts() + ["a\nb\na\n", "\n\n", "x x x y", "UP low!! 3|4\n$%"]
    got = np.concatenate([statistics(d, b) for _, d, b in K.blocks(pa.array(texts), 500)])
    want = np.array([plain_statistics(t) for t in texts])
    for i, t in enumerate(texts):
        assert np.allclose(got[i], want[i]), (t, dict(zip(STATISTICS, zip(got[i], want[i]))))


def test_rules_learn_a_conjunction():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 6))
    y = ((x[:, 1] > 0.6) & (x[:, 4] <= 0.5)).astype(int)
    model = fit_rules(x[:2000], y[:2000])
    assert ((model.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    assert 0 < len(model.rules) < 150


def test_scores_on_given_table(spark):
    prepare(spark)
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    rows = {r["doc_id"]: r for r in rows_of(quality_scores(docs, labels))}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(rows[r["doc_id"]]["predicted"], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) > 0.95


def test_no_labels_and_odd_rows(spark):
    texts = odd_texts()
    df = docs_df(spark, texts, extra=True).withColumn("__stat0", F.lit(1))
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in rows_of(quality_scores(df, none))} == {0.5}
    odd = spark.createDataFrame([(None, 1), (3, None), (10**9, 0), (4, 1), (4, 1)], "doc_id long, quality int")
    rows = rows_of(quality_scores(df, odd))
    assert len(rows) == len(texts) and len({r["score"] for r in rows}) == 1
    assert keep_quality(df, none).columns == df.columns
    assert keep_quality(df, none).count() == len(texts)
    assert rows_of(quality_scores(df.limit(0), none)) == []


KNOWN = {}


def brute_scan(text):
    """Sentences by comparing every run of words between breaks."""
    if not KNOWN:
        for name, texts in build_tables()[0].items():
            for t in texts:
                KNOWN[" ".join(words(t))] = name
    known = KNOWN
    low = (text or "").lower()
    parts = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[a-z0-9]+(?:\.[a-z0-9]+)*", low, re.A)]
    parts = [(re.sub("^licence", "license", w), a, b) for w, a, b in parts]
    begins = [i == 0 or re.search(r"[\n.;:!?]", low[parts[i - 1][2] : parts[i][1]]) is not None for i in range(len(parts))] + [True]
    out, i = [], 0
    while i < len(parts):
        hit = 0
        if begins[i]:
            for j in range(len(parts), i, -1):
                name = known.get(" ".join(p[0] for p in parts[i:j])) if begins[j] and j - i < 120 else None
                if name:
                    out.append(name)
                    hit = j - i
                    break
        i += hit or 1
    return out


def words(text):
    return [re.sub("^licence", "license", w) for w in re.findall(r"[a-z0-9]+(?:\.[a-z0-9]+)*", text.lower(), re.A)]


def test_license_scan(spark):
    mit = "\n".join(s[0] + "." for n, s in SENTENCES.items() if n.startswith("MIT"))
    wrapped = "\n".join(re.findall(r".{1,60}(?:\s|$)", mit))
    texts = [None, "", "no notice", "Released under the MIT License.", "x Released under the MIT License.", "a.\nLICENSED under the Apache Licence, Version 2.0", mit, wrapped, "All rights reserved. MIT License", *(s[0] for s in SENTENCES.values())]
    texts += [t for t in odd_texts() if len(t or "") < 2000] + ["y " * 50000 + ".\nLicensed under CC BY-NC 4.0."]
    rows = {r["doc_id"]: r for r in rows_of(license_scan(docs_df(spark, texts, extra=True)))}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        want = brute_scan(t)
        assert rows[i]["sentence_ids"] == want, t
        found, unmatched = apply_rules(want, build_tables()[1])
        assert rows[i]["licenses"] == list(dict.fromkeys(f[0] for f in found)) and rows[i]["unmatched"] == unmatched
        for s in rows[i]["spans"]:
            assert (t or "").encode()[s["start"] : s["end"]].strip() != b""
    assert rows[3]["licenses"] == ["MIT"] and rows[4]["licenses"] == [] and rows[5]["licenses"] == ["Apache-2.0"]
    assert rows[6]["licenses"] == rows[7]["licenses"] == ["MIT"] and len(rows[6]["spans"]) == 1
    assert rows[8]["licenses"] == ["MIT"] and rows[8]["unmatched"] == ["Reserved"]
    assert rows_of(license_scan(docs_df(spark, texts).limit(0))) == []


def test_given_table_and_rule_order(spark):
    prepare(spark)
    docs = table(spark, SF, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows_of(license_scan(docs)):
        assert r["sentence_ids"] == (brute_scan(texts[r["doc_id"]]) if re.search("(?i)icen|eserved|gpl|mpl|eupl|universal|warranty", texts[r["doc_id"]] or "") else [])
    for i, (_, wanted) in enumerate(RULES):  # an earlier rule never hides a longer later one
        assert all(wanted[: len(w)] != w or len(w) > len(wanted) for _, w in RULES[:i])


SAMPLES = [
    ("                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n", ["Apache-2.0"]),
    ("GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n", ["GPL-3.0-only"]),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3\n", ["GPL-3.0-only"]),
    ("Mozilla Public License Version 2.0\n", ["MPL-2.0"]),
    ("// SPDX-License-Identifier: Apache-2.0 OR MIT\n", ["Apache-2.0 OR MIT"]),
    ("SPDX-License-Identifier: (MIT AND BSD-3-Clause)\n", ["MIT AND BSD-3-Clause"]),
    ("GPL-2.0-or-later", ["GPL-2.0-or-later"]),
    ("Boost Software License - Version 1.0 - August 17th, 2003\n", ["BSL-1.0"]),
    ("Eclipse Public License - v 2.0\n", ["EPL-2.0"]),
    ("Licensed under the MIT license (the License)", ["MIT"]),
    ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", ["Apache-2.0"]),
    ("We met under the MIT License plate", []),
]


def test_names_heads_tags_and_optional_sentences(spark):
    rows = {r["doc_id"]: r for r in rows_of(license_scan(docs_df(spark, [t for t, _ in SAMPLES])))}
    for i, (text, want) in enumerate(SAMPLES):
        assert rows[i]["licenses"] == want, text
        assert rows[i]["sentence_ids"] == brute_scan(text)
    assert len(rows[10]["spans"]) == 1 and rows[10]["unmatched"] == []
    sentences, rules = build_tables()
    assert len({licence for licence, _ in rules if " " not in licence}) >= 30 and sum(map(len, sentences.values())) > 1500
