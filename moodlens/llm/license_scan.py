"""Licence scan: Dice coefficient over word bigrams; DataFrame functions only.

Units are the lines of a text and, where it has several, the whole text.  With a and b distinct bigrams and s
shared ones the coefficient is 2 s / (a + b).  It can reach t only if a and b differ by at most the factor
(2 - t) / t, so a unit meets just the templates of about its size, and most lines meet none.  Templates are a
fixed list in the plan: the scan is narrow, with no join and no shuffle.  Texts and lines without any of a few
words that a match must hold are passed over.

A notice can also be a part of a line or run over several lines of a longer text.  So runs of words are units
too: over the words of the whole text, those that begin and end with a bigram of a template and have at most
(2 - t) / t times its bigrams.  A run needs t b / (2 - t) shared bigrams, so only places with that many of them
close together are looked at.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .exact_dedup import lower_ascii

#: Public licence texts and common notices.
TEMPLATES: list[tuple[str, str]] = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("isc", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
    ('bsd-2-clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ('bsd-3-clause', 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ('zlib', "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ('bsl-1.0', 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ('lgpl-3.0', 'This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.'),
    ('lgpl-2.1', 'This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.'),
    ('agpl-3.0', 'This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.'),
    ('epl-2.0', 'This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/'),
    ('unlicense', 'Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.'),
]
THRESHOLD = 0.8


def _bigrams(text: str) -> list[str]:
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def needed_words(grams: list[str], threshold: float) -> set[str]:
    """Words of which a unit must hold one to reach the threshold.  With b bigrams in the template that takes
    ``threshold * b / (2 - threshold)`` shared ones; words are taken, longest first, until fewer bigrams are
    left without any of them."""
    least = threshold * len(grams) / (2 - threshold)
    out: set[str] = set()
    for word in sorted({w for g in grams for w in g.split()}, key=lambda w: (len(w), w), reverse=True):
        if sum(out.isdisjoint(g.split()) for g in grams) < least - 1e-9:
            break
        out.add(word)
    return out


def license_scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Units of a document that are like a licence template.

    Input: ``doc_id``, ``text`` (others are ignored, whatever their names).  One row per unit and template with
    a coefficient of at least ``threshold``: doc_id, unit (0: the whole text; else the line from 1), template
    (its place in the list), license, shared, dice.  Text is compared without case (A-Z) and punctuation.
    Null and empty texts and units of fewer than two words match nothing; repeated rows match each; all
    templates that reach the threshold are returned, ties too.  An empty table gives an empty table.

    Runs of words that reach it have as unit minus the place of their first word in the text (from 1).  Of the
    runs of a template that overlap, the one with the highest coefficient counts (then the first, the shortest).
    A run inside a line, or in a text, that itself matches a template of the same licence is not given again.
    """
    factor = (2 - threshold) / threshold
    known = [(i, name, b, len(b)) for i, (name, text) in enumerate(templates) for b in [_bigrams(text)]]
    longest = max(n for *_, n in known) * factor
    literal = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.array(*map(F.lit, b)).alias("grams"), F.lit(n).alias("n")) for i, name, b, n in known])

    def close(c):
        """Candidates by size."""
        return F.filter("templates", lambda t: (t["n"] <= c * factor + 1e-9) & (c <= t["n"] * factor + 1e-9))

    # Cleaned once per text; generators keep what follows from being computed anew for every reference
    # (the outer ones, for which no filter is inferred that would compute their input twice).
    clean = F.regexp_replace(lower_ascii(F.col("text").cast("string")), "[^a-z0-9\n]+", " ")
    words = "|".join(sorted(set().union(*(needed_words(b, threshold) for _, _, b, _ in known))))
    likely = F.rlike("text", F.lit(f"(?:^|[ \n])(?:{words})(?:[ \n]|$)"))
    # The same test on the text as it is, so that only texts that pass are cleaned.
    raw = F.rlike(F.col("text").cast("string"), F.lit(f"(?i)(?<![a-z0-9])(?:{words})(?![a-z0-9])"))
    texts = docs.where(raw).select(F.col("doc_id").cast("long").alias("doc_id"), F.explode_outer(F.array(clean)).alias("text"))
    whole = F.when(F.instr("text", "\n") > 0, F.regexp_replace("text", "[ \n]+", " ")).otherwise("")
    units = texts.select("doc_id", F.posexplode_outer(F.concat(F.array(whole), F.split("text", "\n"))).alias("unit", "text")).where(likely)
    units = units.select("doc_id", "unit", F.trim("text").alias("part"))
    words = F.split("part", " ")
    both = F.arrays_zip(F.slice(words, 1, F.size(words) - 1).alias("x"), F.slice(words, 2, F.size(words) - 1).alias("y"))
    pairs = F.array_distinct(F.transform(both, lambda z: F.concat(z["x"], F.lit(" "), z["y"])))
    grams = units.where(F.instr("part", " ") > 0).select("doc_id", "unit", F.explode(F.array(pairs)).alias("grams"))
    near = grams.where(F.size("grams") <= longest).select("doc_id", "unit", "grams", F.size("grams").alias("n"), literal.alias("templates"))
    hits = F.transform(
        close(F.col("n")),
        lambda t: F.struct(t["template"].alias("template"), t["license"].alias("license"), F.size(F.array_intersect("grams", t["grams"])).alias("shared"), (F.col("n") + t["n"]).alias("both")),
    )
    hits = near.select("doc_id", "unit", F.explode(hits).alias("t")).where(F.expr(f"2.0D * t.shared / t.both >= {threshold}D"))
    hits = hits.select("doc_id", "unit", "t.template", "t.license", "t.shared", F.expr("2.0D * t.shared / t.both").alias("dice"))
    return hits.unionByName(_runs(texts, templates, threshold))


def _pairs(words):
    """All bigrams of an array of words, in order."""
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.transform(F.arrays_zip(F.slice(words, 1, rest).alias("x"), F.slice(words, 2, rest).alias("y")), lambda z: F.concat(z["x"], F.lit(" "), z["y"]))


def _previous(grams):
    """For each bigram the place where it stood before (-1: nowhere), by one sort of the text's bigrams."""
    ordered = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    return ordered, lambda o: F.transform(
        F.array_sort(F.transform(o, lambda x, k: F.struct(x["i"].alias("i"), F.when((k > 0) & (F.get(o, k - 1)["g"] == x["g"]), F.get(o, k - 1)["i"]).otherwise(F.lit(-1)).alias("before")))),
        lambda x: x["before"],
    )


def _best_end(start, before, hits, most, n):
    """Of the runs from a place that end with a bigram of the template within ``most`` places, the most alike: running
    counts of new bigrams and of new ones of the template, without a copy of the run."""

    def step(acc, i):
        new, hit = F.get(before, i) < start, F.get(hits, i)
        a = acc["a"] + new.cast("int")
        shared = acc["s"] + (new & hit).cast("int")
        dice = F.lit(2.0) * shared / (a + n)
        better = hit & (dice > acc["dice"])
        return F.struct(
            a.alias("a"), shared.alias("s"), F.when(better, dice).otherwise(acc["dice"]).alias("dice"),
            F.when(better, i).otherwise(acc["last"]).alias("last"), F.when(better, shared).otherwise(acc["shared"]).alias("shared"),
        )

    zero = F.struct(F.lit(0).alias("a"), F.lit(0).alias("s"), F.lit(0.0).alias("dice"), start.alias("last"), F.lit(0).alias("shared"))
    places = F.sequence(start, F.least(start + most, F.size(hits)) - 1)
    return F.aggregate(places, zero, step, lambda acc: F.struct((-acc["dice"]).alias("order"), start.alias("start"), acc["last"].alias("last"), acc["shared"].alias("shared"), acc["dice"].alias("dice")))


def _runs(texts: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """Runs of words of cleaned texts that are like a template, without those in a unit of the same licence."""
    factor = (2 - threshold) / threshold
    known = []
    for i, (name, text) in enumerate(templates):
        grams, words = _bigrams(text), len(re.sub("[^a-z0-9]+", " ", text.lower()).split())
        if grams:
            known.append((i, name, grams, max(1, math.ceil(len(grams) / factor - 1e-9)), math.floor((words - 1) * factor + 1e-9)))
    if not known:
        return texts.where(F.lit(False)).select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (("unit", "int"), ("template", "int"), ("license", "string"), ("shared", "int"), ("dice", "double"))])
    literal = F.array(*[F.struct(F.lit(i).alias("template"), F.lit(name).alias("license"), F.array(*map(F.lit, b)).alias("grams"), F.lit(len(b)).alias("n"), F.lit(least).alias("least"), F.lit(most).alias("most")) for i, name, b, least, most in known])
    every = F.array(*map(F.lit, sorted({g for _, _, b, *_ in known for g in b})))

    def like(words, license):
        """Whether a unit matches a template of the licence."""
        found = F.transform(F.array(F.array_distinct(_pairs(words))), lambda own: F.exists("templates", lambda t: (t["license"] == license) & (F.lit(2.0) * F.size(F.array_intersect(own, t["grams"])) / (F.size(own) + t["n"]) >= threshold)))
        return found[0]

    words = texts.select("doc_id", "text", F.explode(F.array(F.filter(F.split("text", "[ \n]+"), lambda w: w != ""))).alias("words"))
    grams = words.select("doc_id", "text", "words", F.explode(F.array(_pairs(F.col("words")))).alias("grams"))
    common = grams.select("*", F.explode(F.array(F.array_intersect("grams", every))).alias("common")).where(F.size("common") >= min(least for *_, least, _ in known))
    possible = F.filter("templates", lambda t: F.size(F.array_intersect("common", t["grams"])) >= t["least"])
    rows = common.withColumn("templates", literal).withColumn("possible", F.explode(F.array(possible))).where(F.size("possible") > 0)
    ordered, places_of = _previous(F.col("grams"))
    rows = rows.withColumn("ordered", F.explode(F.array(ordered))).withColumn("before", F.explode(F.array(places_of(F.col("ordered"))))).drop("ordered")
    rows = rows.withColumn("t", F.explode("possible")).drop("possible")
    # Places of the template's bigrams; a run begins at one that has enough others after it.
    rows = rows.withColumn("hits", F.explode(F.array(F.transform("grams", lambda g: F.array_contains(F.col("t.grams"), g)))))
    places = F.filter(F.transform("hits", lambda h, i: F.when(h, i)), lambda i: i.isNotNull())
    rows = rows.withColumn("places", F.explode(F.array(places)))
    starts = F.filter("places", lambda p, k: F.get("places", k + F.col("t.least") - 1) - p < F.col("t.most"))
    runs = F.transform(starts, lambda p: _best_end(p, F.col("before"), F.col("hits"), F.col("t.most"), F.col("t.n")))
    rows = rows.withColumn("runs", F.explode(F.array(F.array_sort(F.filter(runs, lambda x: x["dice"] >= threshold))))).where(F.size("runs") > 0)
    apart = F.aggregate("runs", F.slice("runs", 1, 0), lambda acc, x: F.when(F.exists(acc, lambda y: (y["start"] <= x["last"] + 1) & (x["start"] <= y["last"] + 1)), acc).otherwise(F.concat(acc, F.array(x))))
    lines = F.transform(F.split("text", "\n"), lambda line: F.filter(F.split(line, " +"), lambda w: w != ""))
    rows = rows.where(~like(F.col("words"), F.col("t.license"))).withColumn("lines", F.explode(F.array(lines)))
    rows = rows.withColumn("line_of", F.explode(F.array(F.flatten(F.transform("lines", lambda w, i: F.array_repeat(i, F.size(w)))))))
    rows = rows.withColumn("run", F.explode(apart)).withColumns({"begin": F.get("line_of", F.col("run.start")), "end": F.get("line_of", F.col("run.last") + 1)})
    rows = rows.where((F.col("begin") != F.col("end")) | ~like(F.get("lines", F.col("begin")), F.col("t.license")))
    return rows.select("doc_id", (-F.col("run.start") - 1).cast("int").alias("unit"), "t.template", "t.license", "run.shared", "run.dice")


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    rows = ", ".join(f"({i}, '{name}', '{text.replace(chr(39), chr(39) * 2)}')" for i, (name, text) in enumerate(templates))
    norm = "string_split(trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ')"
    return f"""
WITH u0 AS (SELECT doc_id, 0 AS unit, text AS part FROM documents WHERE contains(text, chr(10))
  UNION ALL SELECT doc_id, CAST(unnest(range(1, 1 + len(string_split(text, chr(10))))) AS INTEGER), unnest(string_split(text, chr(10))) FROM documents),
u AS (SELECT doc_id, unit, {norm.format("part")} AS w FROM u0),
g AS (SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS grams FROM u WHERE len(w) > 1),
t AS (SELECT template, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS tg
      FROM (SELECT template, license, {norm.format("body")} AS w FROM (VALUES {rows}) v(template, license, body))),
m AS (SELECT doc_id, unit, template, license, len(list_intersect(grams, tg)) AS shared, len(grams) + len(tg) AS n FROM g JOIN t ON list_has_any(grams, tg))
SELECT doc_id, unit, template, license, CAST(shared AS INTEGER) AS shared, CAST(2 AS DOUBLE) * shared / n AS dice FROM m WHERE CAST(2 AS DOUBLE) * shared / n >= {threshold}
"""
