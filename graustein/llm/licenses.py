"""Licence scans by sentence rules.

Texts are cut into sentences twice, once with line ends as sentence ends (notices on lines of
their own) and once with only blank lines as such (wrapped paragraphs). Normalised sentences
are looked up among the known licence sentences, which gives a sequence of sentence identifiers per
text; unknown sentences have no place in it. A rule is an ordered list of identifiers: its steps are
joined with the sequence, and hits whose place less their step is the same lie on one alignment of the
rule. A rule matches where at least ``SHARE`` of its steps lie on one alignment, in full where all do.

Only texts with one of a few words are cut at all; they are chosen from the known sentences so that
each has at least one of them.

Defined cases: null text counts as empty; a null id stays null; rows that agree in id and
text count once; texts without a known sentence give no row; no rows give no rows. Only the
id and the text are read; texts are processed whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


SHARE = 0.6

# Sentences of public licences and notices, by identifier.
SENTENCES = {
    "mit.ref": "Released under the MIT License.",
    "mit.ref2": "Licensed under the MIT License.",
    "mit.ref3": "This project is licensed under the MIT License.",
    "mit.title": "The MIT License (MIT)",
    "mit.grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit.notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit.warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit.liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache.ref": "Licensed under the Apache License, Version 2.0.",
    "apache.ref2": "Released under the Apache License, Version 2.0.",
    "apache.notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache.notice2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache.copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache.asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache.see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3.ref": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3.ref2": "Licensed under the GNU General Public License, version 3.",
    "gpl2.ref": "Licensed under the GNU General Public License, version 2.",
    "gpl.free3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl.free2": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl.warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl.see": "See the GNU General Public License for more details.",
    "gpl.copy": "You should have received a copy of the GNU General Public License along with this program.",
    "ccby.ref": "Licensed under CC BY 4.0.",
    "ccby.ref2": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "ccbysa.ref": "Licensed under CC BY-SA 4.0.",
    "ccbysa.ref2": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "ccbync.ref": "Licensed under CC BY-NC 4.0.",
    "ccbync.ref2": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "bsd.redist": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd.binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd.name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "mpl.notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc.grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "unlicense.free": "This is free and unencumbered software released into the public domain.",
    "rights.all": "All rights reserved; no licence is granted.",
    "rights.reserved": "All rights reserved.",
    "lgpl.free21": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl.free3": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "lgpl.warranty": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "lgpl.see": "See the GNU Lesser General Public License for more details.",
    "lgpl.copy": "You should have received a copy of the GNU Lesser General Public License along with this library.",
    "agpl.free3": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl.see": "See the GNU Affero General Public License for more details.",
    "agpl.copy": "You should have received a copy of the GNU Affero General Public License along with this program.",
    "bsd.style": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "cc0.waiver": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "cc0.waiver2": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}

# Ordered rules, (licence, sentence identifiers). Numbers of list items ("1.") are
# sentences of their own and aren't counted.
RULES = [
    ("MIT", ["mit.ref"]), ("MIT", ["mit.ref2"]), ("MIT", ["mit.ref3"]), ("MIT", ["mit.title", "mit.grant", "mit.notice", "mit.warranty", "mit.liability"]),
    ("MIT", ["mit.grant", "mit.notice", "mit.warranty", "mit.liability"]),
    ("Apache-2.0", ["apache.ref"]), ("Apache-2.0", ["apache.ref2"]), ("Apache-2.0", ["apache.notice2", "apache.copy", "apache.asis", "apache.see"]), ("Apache-2.0", ["apache.notice"]),
    ("GPL-3.0", ["gpl3.ref"]), ("GPL-3.0", ["gpl3.ref2"]), ("GPL-2.0", ["gpl2.ref"]),
    ("GPL-3.0-or-later", ["gpl.free3", "gpl.warranty", "gpl.see", "gpl.copy"]), ("GPL-2.0-or-later", ["gpl.free2", "gpl.warranty", "gpl.see", "gpl.copy"]),
    ("CC-BY-4.0", ["ccby.ref"]), ("CC-BY-4.0", ["ccby.ref2"]), ("CC-BY-SA-4.0", ["ccbysa.ref"]), ("CC-BY-SA-4.0", ["ccbysa.ref2"]),
    ("CC-BY-NC-4.0", ["ccbync.ref"]), ("CC-BY-NC-4.0", ["ccbync.ref2"]),
    ("BSD-2-Clause", ["bsd.redist", "bsd.source", "bsd.binary"]), ("BSD-3-Clause", ["bsd.redist", "bsd.source", "bsd.binary", "bsd.name"]),
    ("MPL-2.0", ["mpl.notice"]), ("ISC", ["isc.grant"]), ("Unlicense", ["unlicense.free"]), ("Proprietary", ["rights.all"]),
    ("Proprietary", ["rights.reserved"]), ("BSD", ["bsd.style"]), ("CC0-1.0", ["cc0.waiver"]), ("CC0-1.0", ["cc0.waiver2"]),
    ("LGPL-2.1-or-later", ["lgpl.free21", "lgpl.warranty", "lgpl.see", "lgpl.copy"]), ("LGPL-3.0-or-later", ["lgpl.free3", "lgpl.warranty", "lgpl.see", "lgpl.copy"]),
    ("AGPL-3.0-or-later", ["agpl.free3", "gpl.warranty", "agpl.see", "agpl.copy"]),
]

# How a line names a licence; every lead goes with every name.
LEADS = ("Licensed under", "Released under", "Distributed under", "This work is licensed under", "This project is licensed under", "This software is licensed under")
REFERENCES = [
    ("MIT", "the MIT License"), ("Apache-2.0", "the Apache License, Version 2.0"), ("GPL-2.0", "the GNU General Public License, version 2"),
    ("GPL-3.0", "the GNU General Public License, version 3"), ("LGPL-2.1", "the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "the GNU Lesser General Public License, version 3"), ("AGPL-3.0", "the GNU Affero General Public License, version 3"),
    ("BSD", "the BSD License"), ("BSD", "a BSD-style license"), ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"),
    ("ISC", "the ISC License"), ("MPL-2.0", "the Mozilla Public License, version 2.0"), ("Unlicense", "the Unlicense"),
    ("CC0-1.0", "CC0 1.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-4.0", "a Creative Commons Attribution 4.0 International License"), ("CC-BY-SA-4.0", "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("CC-BY-NC-4.0", "a Creative Commons Attribution-NonCommercial 4.0 International License"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(sentence: str) -> str:
    """The normal form of a known sentence: ASCII letters in lower case, digits, single spaces."""
    return re.sub("[^a-z0-9]+", " ", "".join(c.lower() if c in UPPER else c for c in sentence)).strip(" ")


def _references() -> None:
    """Sentences and one-step rules of the references, besides those listed above."""
    taken = {normal(s) for s in SENTENCES.values()}
    for name, (license_, named) in enumerate(REFERENCES):
        for lead, words in enumerate(LEADS):
            sentence = f"{words} {named}."
            if normal(sentence) not in taken:
                SENTENCES[f"ref.{name}.{lead}"] = sentence
                RULES.append((license_, [f"ref.{name}.{lead}"]))


_references()


def sentences(text: Column, wrapped: bool) -> Column:
    """The normalised sentences of a text, in order; those without a letter are left out."""
    if wrapped:
        text = F.translate(F.regexp_replace(text, "\\n[ \\t\\r]*\\n", "\x01"), "\n", " ")
        parts = F.split(F.regexp_replace(text, "([.!?;:])[ \\t]+", "$1\x01"), "\x01", -1)
    else:
        parts = F.split(F.regexp_replace(text, "([.!?;:])[ \\t]+", "$1\n"), "\n", -1)
    clean = F.transform(parts, lambda p: F.trim(F.regexp_replace(F.translate(p, UPPER, LOWER), "[^a-z0-9]+", " ")))
    return F.filter(clean, lambda p: p.rlike("[a-z]"))


def gate(parts: Iterable[str]) -> str:
    """A pattern that every text with one of the normalised sentences matches: words, at least one of
    each sentence, few in number."""
    left = [set(p.split(" ")) for p in dict.fromkeys(parts)]
    words = []
    while left:
        count = Counter(w for p in left for w in p)
        words.append(max(count, key=lambda w: (count[w] * (len(w) > 3), len(w), w)))
        left = [p for p in left if words[-1] not in p]
    return "|".join(words)


GATE = gate(p for s in SENTENCES.values() for p in map(normal, re.split(r"(?<=[.!?;:])[ \t]+", s)) if re.search("[a-z]", p))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: dict[str, str] = SENTENCES,
         rules: list[tuple[str, list[str]]] = RULES, share: float = SHARE) -> DataFrame:
    """(id, license, score, n_full): for every document and licence, the largest share of a rule's
    steps on one alignment, and how many alignments of its rules are complete. Alignments are of the
    sequence of known sentences: what stands between them doesn't count."""
    spark = docs.sparkSession
    # sentences may hold ends in their middle ("v. 2.0"): each part is a step of its own
    steps, names = [], {}
    for rule, (license_, ids) in enumerate(rules):
        parts = [p for i in ids for p in map(normal, re.split(r"(?<=[.!?;:])[ \t]+", known[i])) if re.search("[a-z]", p)]
        for step, part in enumerate(parts):
            steps.append((names.setdefault(part, len(names)), rule, license_, step, len(parts)))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    texts = texts.filter(F.col("text").rlike(f"(?i){gate(names)}") if names else F.lit(False))
    known_rows = F.broadcast(spark.createDataFrame([(s, i) for s, i in names.items()], "sentence string, sid int"))
    rule_rows = F.broadcast(spark.createDataFrame(steps, "sid int, rule int, license string, step int, size int"))
    sequence = lambda wrapped: F.filter(sentences(F.col("text"), wrapped), lambda p: p.isin(*names))
    cut = [texts.select("id", "th", F.lit(k).alias("form"), F.posexplode(sequence(bool(k))).alias("place", "sentence")) for k in (0, 1)]
    hits = cut[0].unionByName(cut[1]).join(known_rows, "sentence").select("id", "th", "form", "place", "sid")
    aligned = hits.join(rule_rows, "sid").withColumn("start", F.col("place") - F.col("step"))
    runs = aligned.groupBy("id", "th", "form", "rule", "license", "size", "start").agg((F.count_distinct("step") / F.col("size")).alias("score"))
    per_form = runs.filter(F.col("score") >= share).groupBy("id", "th", "form", "license").agg(
        F.max("score").alias("score"), F.sum((F.col("score") == 1).cast("long")).alias("n_full"))
    return per_form.groupBy("id", "th", "license").agg(F.max("score").alias("score"), F.max("n_full").alias("n_full")).drop("th")
