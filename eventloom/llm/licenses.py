"""Operator 7, licence scans by sentence rules.

Texts are normalised: A-Z lower-cased, everything but letters a-z, digits and
dots between them is a gap, "licence" is "license". A sentence of the table is
recognised where its words follow each other, across line breaks too, and where
it begins and ends at the text's ends, at a line break or at one of . ; : ! ?
A text so becomes a sequence of sentence identifiers (of sentences that overlap, the
one that begins first, then the longest). Rules, tried in order at each place of
the sequence, turn runs of identifiers into licences; an identifier of a rule that is
marked ``?`` may be missing. An identifier that begins no rule is left unmatched and
reported. The tables are the written ones and what ``build_tables`` makes by rule.

Null and empty texts have no sentences. Each row is scanned whole and on its
own, so repeated rows give equal results. Empty tables give empty results;
extra columns are not read.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, normalised by ``normalise`` before use.
SENTENCES = {
    "MIT-name": ["Released under the MIT License", "Licensed under the MIT License", "The MIT License", "MIT License", "This project is licensed under the MIT License", "SPDX-License-Identifier: MIT"],
    "MIT-grant": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"],
    "MIT-condition": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"],
    "MIT-warranty": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"],
    "MIT-liability": ["IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE"],
    "ISC-grant": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "ISC-name": ["Licensed under the ISC License", "ISC License", "SPDX-License-Identifier: ISC"],
    "Apache-2-name": ["Licensed under the Apache License, Version 2.0", "Licensed under the Apache License, Version 2.0 (the \"License\")", "Apache License, Version 2.0", "Apache License 2.0", "SPDX-License-Identifier: Apache-2.0"],
    "Apache-2-use": ["you may not use this file except in compliance with the License", "Licensed under the Apache License, Version 2.0 (the \"License\"), you may not use this file except in compliance with the License"],
    "Apache-2-copy": ["You may obtain a copy of the License at"],
    "Apache-2-warranty": ["Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"],
    "BSD-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BSD-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"],
    "BSD-binary": ["Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"],
    "BSD-endorse": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "BSD-2-name": ["SPDX-License-Identifier: BSD-2-Clause", "Licensed under the BSD 2-Clause License"],
    "BSD-3-name": ["SPDX-License-Identifier: BSD-3-Clause", "Licensed under the BSD 3-Clause License"],
    "GPL-3-name": ["This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3", "GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0"],
    "GPL-2-name": ["This work is licensed under the GNU General Public License, version 2", "Licensed under the GNU General Public License, version 2", "GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0"],
    "GPL-free": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"],
    "GPL-2-free": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"],
    "GPL-hope": ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"],
    "GPL-details": ["See the GNU General Public License for more details"],
    "LGPL-3-name": ["Licensed under the GNU Lesser General Public License, version 3", "GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-only"],
    "AGPL-3-name": ["Licensed under the GNU Affero General Public License, version 3", "GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-only"],
    "MPL-2-name": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License, Version 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-name": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-name": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-name": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-ND-name": ["Licensed under CC BY-ND 4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"],
    "CC-BY-NC-SA-name": ["Licensed under CC BY-NC-SA 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"],
    "CC0-name": ["Licensed under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "Unlicense-grant": ["This is free and unencumbered software released into the public domain"],
    "Reserved": ["All rights reserved"],
}

# The rules, in the order in which they are tried.
RULES = [
    ("MIT", ["MIT-name", "MIT-grant", "MIT-condition", "MIT-warranty", "MIT-liability"]),
    ("MIT", ["MIT-grant", "MIT-condition", "MIT-warranty", "MIT-liability"]),
    ("MIT", ["MIT-grant", "MIT-condition"]),
    ("MIT", ["MIT-name"]),
    ("ISC", ["ISC-name", "ISC-grant"]),
    ("ISC", ["ISC-grant"]),
    ("ISC", ["ISC-name"]),
    ("Apache-2.0", ["Apache-2-name?", "Apache-2-use", "Apache-2-copy?", "Apache-2-warranty?"]),
    ("Apache-2.0", ["Apache-2-name"]),
    ("BSD-3-Clause", ["BSD-grant", "BSD-source", "BSD-binary", "BSD-endorse"]),
    ("BSD-2-Clause", ["BSD-grant", "BSD-source", "BSD-binary"]),
    ("BSD-3-Clause", ["BSD-3-name"]),
    ("BSD-2-Clause", ["BSD-2-name"]),
    ("GPL-3.0-or-later", ["GPL-free", "GPL-hope", "GPL-details"]),
    ("GPL-3.0-or-later", ["GPL-free"]),
    ("GPL-2.0-or-later", ["GPL-2-free", "GPL-hope", "GPL-details"]),
    ("GPL-2.0-or-later", ["GPL-2-free"]),
    ("GPL-3.0-only", ["GPL-3-name"]),
    ("GPL-2.0-only", ["GPL-2-name"]),
    ("LGPL-3.0-only", ["LGPL-3-name"]),
    ("AGPL-3.0-only", ["AGPL-3-name"]),
    ("MPL-2.0", ["MPL-2-name"]),
    ("CC-BY-NC-SA-4.0", ["CC-BY-NC-SA-name"]),
    ("CC-BY-NC-4.0", ["CC-BY-NC-name"]),
    ("CC-BY-SA-4.0", ["CC-BY-SA-name"]),
    ("CC-BY-ND-4.0", ["CC-BY-ND-name"]),
    ("CC-BY-4.0", ["CC-BY-name"]),
    ("CC0-1.0", ["CC0-name"]),
    ("Unlicense", ["Unlicense-grant"]),
]

# SPDX identifiers and the names of their licences.
NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3"],
    "GPL-2.0-or-later": ["GNU General Public License, version 2 or later", "GNU General Public License v2.0 or later", "GPLv2+", "GPL-2.0-or-later"],
    "GPL-3.0-or-later": ["GNU General Public License, version 3 or later", "GNU General Public License v3.0 or later", "GPLv3+", "GPL-3.0-or-later"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3"],
    "LGPL-2.1-or-later": ["GNU Lesser General Public License, version 2.1 or later", "LGPL-2.1-or-later"],
    "LGPL-3.0-or-later": ["GNU Lesser General Public License, version 3 or later", "LGPL-3.0-or-later"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3"],
    "AGPL-3.0-or-later": ["GNU Affero General Public License, version 3 or later", "AGPL-3.0-or-later"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"],
    "EPL-1.0": ["Eclipse Public License, Version 1.0", "Eclipse Public License - v 1.0", "Eclipse Public License 1.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License - v 2.0", "Eclipse Public License 2.0"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License", "BSD 2-Clause \"Simplified\" License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "Modified BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "Unlicense": ["The Unlicense"],
    "CC0-1.0": ["CC0 1.0 Universal"],
    "CDDL-1.0": ["Common Development and Distribution License, Version 1.0", "Common Development and Distribution License 1.0"],
    "EUPL-1.2": ["European Union Public Licence v. 1.2", "European Union Public License 1.2", "EUPL v1.2"],
    "Artistic-2.0": ["Artistic License 2.0"],
    "OFL-1.1": ["SIL Open Font License, Version 1.1", "SIL Open Font License 1.1"],
    "PSF-2.0": ["Python Software Foundation License Version 2", "PSF License Agreement"],
    "WTFPL": ["Do What The F*ck You Want To Public License, Version 2"],
    "MS-PL": ["Microsoft Public License"],
    "PostgreSQL": ["PostgreSQL License"],
}

# The lines that licence texts begin with.
HEADS = {
    "Apache-2.0": ["Apache License Version 2.0, January 2004", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"],
    "GPL-2.0-only": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0-only": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.1-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "AGPL-3.0-only": ["GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "OFL-1.1": ["SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"],
    "Zlib": ["This software is provided 'as-is', without any express or implied warranty"],
    "Unlicense": ["This is free and unencumbered software released into the public domain"],
}

LEADS = ["", "The", "under the", "Licensed under", "Licensed under the", "Released under the", "Distributed under the", "Available under the",
         "This project is licensed under the", "This software is licensed under the", "This work is licensed under the", "This file is licensed under the",
         "Licensed under the terms of the", "Released under the terms of the", "Distributed under the terms of the"]


def _known_as(sentences: dict[str, list[str]], rules: list[tuple[str, list[str]]]) -> dict[str, str]:
    """The identifier of the sentences that alone name a licence, by licence."""
    return {licence: wanted[0] for licence, wanted in rules if len(wanted) == 1 and wanted[0].endswith("-name") and wanted[0] in sentences}


def build_tables(sentences: dict[str, list[str]] = SENTENCES, rules: list[tuple[str, list[str]]] = RULES) -> tuple[dict[str, list[str]], list[tuple[str, list[str]]]]:
    """The sentence and rule tables: those above, every name behind every lead, with and without
    ``(the "License")``, the heads, and SPDX tags of one licence and of two joined by OR or AND."""
    named = _known_as(sentences, rules)
    all_sentences = {name: list(texts) for name, texts in sentences.items()}
    taken = {tuple(w for w, _, _ in normalise(t.encode())) for texts in sentences.values() for t in texts}
    all_rules = list(rules)

    def add(identifier: str, licence: str, texts: list[str]) -> None:
        fresh = []
        for text in texts:
            words = tuple(w for w, _, _ in normalise(text.encode()))
            if words not in taken:
                taken.add(words)
                fresh.append(text)
        if fresh:
            all_sentences.setdefault(identifier, []).extend(fresh)
            if (licence, [identifier]) not in all_rules:
                all_rules.append((licence, [identifier]))

    for licence, names in NAMES.items():
        identifier = named.get(licence, f"{licence}-name")
        leads = [f"{lead} {name}" for lead in LEADS for name in names if lead or len(normalise(name.encode())) > 1 or name[-1:].isdigit()]
        add(identifier, licence, [*HEADS.get(licence, []), f"SPDX-License-Identifier: {licence}", *leads, *(f'{x} (the "License")' for x in leads)])
    for a in NAMES:
        for b in NAMES:
            if a != b:
                for word in ("OR", "AND"):
                    add(f"{a}-{word}-{b}", f"{a} {word} {b}", [f"SPDX-License-Identifier: {a} {word} {b}", f"SPDX-License-Identifier: ({a} {word} {b})"])
    return all_sentences, all_rules


_TOKEN = re.compile(rb"[a-z0-9]+(?:\.[a-z0-9]+)*")
_BREAK = re.compile(rb"[\n.;:!?]")


def normalise(text: bytes) -> list[tuple[bytes, int, int]]:
    """(word, start, end) for every word."""
    out = []
    for m in _TOKEN.finditer(text.lower()):
        word = m.group()
        out.append((b"license" + word[7:] if word.startswith(b"licence") else word, m.start(), m.end()))
    return out


class SentenceTable:
    """Sentences by their words, found through a word that is rare elsewhere."""

    def __init__(self, sentences: dict[str, list[str]]):
        self.by_words: dict[tuple[bytes, ...], str] = {}
        for name, texts in sentences.items():
            for text in texts:
                self.by_words[tuple(w for w, _, _ in normalise(text.encode()))] = name
        self.lengths: dict[bytes, list[int]] = {}
        for words in self.by_words:
            self.lengths.setdefault(words[0], []).append(len(words))
        for at in self.lengths:
            self.lengths[at] = sorted(set(self.lengths[at]), reverse=True)
        # Each sentence holds one of these strings, so a text without any of them is done.
        self.signs = self._signs([b" ".join(w) for w in self.by_words])

    @staticmethod
    def _signs(sentences: list[bytes]) -> list[bytes]:
        """A few words so that every sentence holds one: greedily, the longest of the most widely held."""
        left, signs = set(sentences), []
        while left:
            held: dict[bytes, int] = {}
            for s in left:
                for word in set(s.split()):
                    held[word] = held.get(word, 0) + 1
            word = max(held, key=lambda w: (held[w] * len(w), w))
            signs.append(word)
            left = {s for s in left if word not in s.split()}
        return signs

    def find(self, text: bytes) -> list[tuple[str, int, int]]:
        """(identifier, start, end) of the sentences in a text, in order, without overlaps."""
        low = text.lower().replace(b"licence", b"license")
        if not any(sign in low for sign in self.signs):
            return []
        words = normalise(text)
        n = len(words)
        # gap[i]: whether a sentence may begin at word i (and end before it)
        gap = [True, *(_BREAK.search(text, words[i - 1][2], words[i][1]) is not None for i in range(1, n)), True]
        out, at = [], 0
        while at < n:
            step = 1
            if gap[at]:
                for length in self.lengths.get(words[at][0], ()):
                    if at + length <= n and gap[at + length]:
                        name = self.by_words.get(tuple(w for w, _, _ in words[at : at + length]))
                        if name is not None:
                            out.append((name, words[at][1], words[at + length - 1][2]))
                            step = length
                            break
            at += step
        return out


def _taken(names: list[str], at: int, wanted: list[str]) -> int:
    """How many identifiers from ``at`` on the rule takes; 0 if it does not fit. One marked ``?`` may be missing."""
    here = at
    for name in wanted:
        if here < len(names) and names[here] == name.removesuffix("?"):
            here += 1
        elif not name.endswith("?"):
            return 0
    return here - at


def apply_rules(names: list[str], rules: list[tuple[str, list[str]]] = RULES) -> tuple[list[tuple[str, int, int]], list[str]]:
    """((licence, first, last + 1) over the sequence, identifiers that no rule took)."""
    by_first: dict[str, list[tuple[str, list[str]]]] = {}
    for rule in rules:
        for i, name in enumerate(rule[1]):
            by_first.setdefault(name.removesuffix("?"), []).append(rule)
            if not name.endswith("?"):
                break
    found, unmatched, at = [], [], 0
    while at < len(names):
        for licence, wanted in by_first.get(names[at], ()):
            n = _taken(names, at, wanted)
            if n:
                found.append((licence, at, at + n))
                at += n
                break
        else:
            unmatched.append(names[at])
            at += 1
    return found, unmatched


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sentences: dict[str, list[str]] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """(id, licenses, sentence_ids, unmatched, spans), one row for every row of ``docs``.

    ``licenses`` are distinct, in order of appearance; ``spans`` are the byte ranges of each match.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    if sentences is None and rules is None:
        sentences, rules = build_tables()
    sentences, rules = sentences or SENTENCES, rules or RULES
    span = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches):
        table = SentenceTable(sentences)
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for text in batch.column(1).cast(pa.binary()):
                found = table.find(text.as_py() or b"")
                matches, unmatched = apply_rules([f[0] for f in found], rules)
                columns[0].append(list(dict.fromkeys(m[0] for m in matches)))
                columns[1].append([f[0] for f in found])
                columns[2].append(unmatched)
                columns[3].append([{"license": m, "start": found[a][1], "end": found[b - 1][2]} for m, a, b in matches])
            kinds = [pa.list_(pa.string())] * 3 + [pa.list_(span)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], [id_col, "licenses", "sentence_ids", "unmatched", "spans"])

    schema = f"`{id_col}` {kind}, licenses array<string>, sentence_ids array<string>, unmatched array<string>, spans array<struct<license: string, start: long, end: long>>"
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(scan, schema)
