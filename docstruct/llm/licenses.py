"""Licence scans: Dice coefficient over word bigrams against licence templates. DataFrame functions only.

Looked at are a text's lines, its paragraphs (between blank lines) and the text as a whole, and for licences that none of
these names also all runs of consecutive lines, so wordings that span several lines or paragraphs of a longer text. Of each the words are taken in
lower case without signs, and its word bigrams, repeats counted, are held against the templates'. Dice can't reach the
threshold unless the two sizes are within a factor of (2 - threshold) / threshold of each other: all other templates are
pruned, and segments too short or too long for any template go before their bigrams are made. Nor can it unless a share of
threshold / (2 - threshold) of the segment's bigrams stand in some template, which drops nearly all the rest. Runs are made
only of texts that hold the same share of a template's bigrams.
"""

from __future__ import annotations

from collections import Counter
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8

#: Wordings of public licences and of the notices that refer to them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]


_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_TWO = next(t for n, t in TEMPLATES if n == "BSD-2-Clause")
#: Whole bodies with their disclaimers.
BODIES = [
    ("BSD-2-Clause", f"{_TWO} {_DISCLAIMER}"),
    ("BSD-3-Clause", f"{_TWO} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_DISCLAIMER}"),
]


def _bigrams(text: str) -> Counter:
    """Bigrams of a template, whose words are ASCII."""
    words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


def _once(value: Column) -> Column:
    """value, made in a step of its own: filters on it aren't moved before it, which would make it again."""
    return F.explode(F.array(value))


def _segments() -> Column:
    """Lines, paragraphs if there are several, and the whole text if it has several lines, of a normalised text _norm."""
    none = F.array().cast("array<string>")
    lines = F.split("_norm", "\n", -1)
    parts = F.split("_norm", r"\n *\n[ \n]*", -1)
    return F.concat(lines, F.when(F.size(parts) > 1, parts).otherwise(none), F.when(F.size(lines) > 1, F.array("_norm")).otherwise(none))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, licence, similarity, segments): licences that a whole text names or holds, best likeness and number of segments.

    A segment counts for the likeliest template (ties: the first by name) if their Dice coefficient is at least threshold.
    So does a run of lines, unless it meets one of another licence that has more of its bigrams in common; runs count as one segment together, and only
    where no segment names the licence.
    Null and empty texts and segments of fewer than two words name none. Rows that repeat an id count together. Documents
    without a licence have no row.
    """
    sets = [(name, _bigrams(t)) for name, t in (TEMPLATES + BODIES if templates is None else templates)]
    sets = sorted((x for x in sets if x[1]), key=lambda x: (x[0], sorted(x[1].items())))
    bound = (2 - threshold) / threshold
    least, most = min((b.total() for _, b in sets), default=1) / bound, max((b.total() for _, b in sets), default=0) * bound
    every = sorted({x for _, b in sets for x in b}) or [""]

    norm = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}\n]+", " ")
    rows = docs.select(F.col(doc_id).alias("_id"), _once(norm).alias("_norm")).select("_id", F.explode(_segments()).alias("_segment"))
    rows = rows.select("_id", _once(F.split(F.trim(F.translate("_segment", "\n", " ")), " +")).alias("_words"))
    size = F.size("_words") - 1
    rows = rows.where(size.between(max(1, least), most))
    pairs = F.zip_with(F.slice("_words", 1, size), F.slice("_words", 2, size), lambda a, b: F.concat_ws(" ", a, b))
    rows = rows.select("_id", _once(pairs).alias("_pairs"))
    size = F.size("_pairs")
    rows = rows.select("_id", "_pairs", _once(F.size(F.filter("_pairs", lambda x: x.isin(every)))).alias("_known")).where(F.col("_known") >= size / bound - 1e-9)

    def dice(own: Counter) -> Column:
        known = F.split(F.lit("|".join(f"{b}={n}" for b, n in sorted(own.items()))), r"\|")

        def least_of(done: Column, each: Column) -> Column:
            return done + F.least(F.split_part(each, F.lit("="), F.lit(2)).cast("int"), F.size(F.filter("_pairs", lambda x: x == F.split_part(each, F.lit("="), F.lit(1)))))

        shared = F.aggregate(known, F.lit(0), least_of)
        return F.when(size.between(own.total() / bound - 1e-9, own.total() * bound + 1e-9), 2.0 * shared / (size + own.total()))

    kind = "struct<dice: double, at: int>"
    each = F.array(*[F.struct(dice(own).alias("dice"), F.lit(-i).alias("at")) for i, (_, own) in enumerate(sets)]).cast(f"array<{kind}>")
    found = rows.select("_id", _once(F.array_max(F.filter(each, lambda x: x["dice"] >= threshold))).alias("_best")).where("_best is not null")
    names = F.array(*[F.lit(n) for n, _ in sets], F.lit(""))
    found = found.select("_id", F.get(names, -F.col("_best.at")).alias("licence"), F.col("_best.dice").alias("dice"), F.lit(1).alias("segment"))
    if sets:
        found = found.unionByName(_runs(docs.select(F.col(doc_id).alias("_id"), norm.alias("_norm")), sets, threshold))
    dice, n = F.max(F.when(F.col("segment") == 1, F.col("dice"))), F.sum("segment")
    return found.groupBy(F.col("_id").alias(doc_id), "licence").agg(F.coalesce(dice, F.max("dice")).alias("similarity"), F.greatest(n, F.lit(1)).cast("long").alias("segments"))


def _runs(rows: DataFrame, sets: list[tuple[str, Counter]], threshold: float) -> DataFrame:
    """(_id, licence, dice, segment = 0) of the runs of lines of normalised texts (_id, _norm) that name a licence."""
    bound = (2 - threshold) / threshold
    every = sorted({x for _, b in sets for x in b})
    about = rows.sparkSession.createDataFrame([(i, n, b.total(), dict(b)) for i, (n, b) in enumerate(sets)], "t int, licence string, total int, own map<string, int>")

    rows = rows.where(F.col("_norm").contains("\n")).select(F.monotonically_increasing_id().alias("_row"), "_id", _once(F.col("_norm")).alias("_norm"))
    rows = rows.select("_row", "_id", "_norm", _once(F.split(F.trim(F.translate("_norm", "\n", " ")), " +")).alias("_words"))
    size = F.size("_words") - 1
    pairs = F.zip_with(F.slice("_words", 1, size), F.slice("_words", 2, size), lambda a, b: F.concat_ws(" ", a, b))
    rows = rows.where(size > 0).select("_row", "_id", "_norm", _once(pairs).alias("_pairs"))
    known = F.filter(F.transform("_pairs", lambda x, i: F.when(x.isin(every), F.struct(i.alias("at"), x.alias("b")))), lambda x: x.isNotNull())
    rows = rows.select("_row", "_id", "_norm", _once(known).alias("_known"))
    rows = rows.select("_row", "_id", "_norm", "_known", _once(F.array_distinct("_known.b")).alias("_kinds")).where(F.size("_kinds") > 0)
    # distinct bigrams of the template that a text must hold at least
    enough = [F.when(F.size(F.array_intersect("_kinds", F.split(F.lit("|".join(sorted(b))), r"\|"))) >= ceil(b.total() / bound - 1e-9) - (b.total() - len(b)), F.lit(i)) for i, (_, b) in enumerate(sets)]
    rows = rows.select("_row", "_id", "_norm", "_known", F.explode(F.array_compact(F.array(*enough))).alias("t"))

    # words before each line and up to its end; lines without words aside
    sizes = F.transform(F.split("_norm", "\n", -1), lambda x: F.size(F.filter(F.split(x, " +"), lambda w: w != "")))
    rows = rows.join(F.broadcast(about), "t").select("*", _once(F.filter(sizes, lambda n: n > 0)).alias("_sizes"))
    ends = F.aggregate("_sizes", F.array().cast("array<int>"), lambda done, n: F.concat(done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + n)))
    rows = rows.select("_row", "_id", "t", "licence", "total", "own", "_known", "_sizes", _once(ends).alias("_ends"))
    mine = F.filter("_known", lambda x: F.map_contains_key("own", x["b"]))
    rows = rows.select("_row", "_id", "t", "licence", "total", "own", "_sizes", "_ends", _once(mine).alias("_mine"))
    # a bigram counts in a run if so many of its like as the template has don't come before it there
    before = F.transform("_mine", lambda x: F.struct(x["at"].alias("at"), F.coalesce(F.try_element_at(F.filter("_mine", lambda y: (y["b"] == x["b"]) & (y["at"] < x["at"])), -F.try_element_at("own", x["b"]))["at"], F.lit(-1)).alias("before")))
    rows = rows.select("_row", "_id", "t", "licence", "total", "_sizes", "_ends", _once(before).alias("_mine"))

    rows = rows.select("*", F.posexplode("_ends").alias("_i", "_first")).withColumn("_from", F.col("_first") - F.get("_sizes", F.col("_i")))
    # a run of which the first line has nothing of the template is no better than the run without it
    touches = F.exists("_mine", lambda x: (x["at"] >= F.col("_from")) & (x["at"] < F.col("_first")))
    within = lambda e: (e >= F.col("_first")) & (e - F.col("_from") - 1).between(F.col("total") / bound - 1e-9, F.col("total") * bound + 1e-9)
    rows = rows.where(touches).select("_row", "_id", "t", "licence", "total", "_mine", "_from", F.explode(F.filter("_ends", within)).alias("_to"))
    shared = F.size(F.filter("_mine", lambda x: (x["at"] >= F.col("_from")) & (x["at"] < F.col("_to") - 1) & (x["before"] < F.col("_from"))))
    rows = rows.select("_row", "_id", "t", "licence", "_from", "_to", "total", shared.cast("int").alias("shared"))
    rows = rows.withColumn("dice", 2.0 * F.col("shared") / (F.col("_to") - F.col("_from") - 1 + F.col("total"))).where(F.col("dice") >= threshold)
    run = F.struct("shared", "dice", "t", "licence", F.col("_from").alias("from"), F.col("_to").alias("to"))
    meets = lambda x, y: (y["from"] < x["to"]) & (x["from"] < y["to"])
    # of each template's runs that meet the likeliest; of those of several licences the ones that share most with their template
    less = lambda x: F.exists("_all", lambda y: meets(x, y) & (y["t"] == x["t"]) & (y["dice"] > x["dice"]))
    more = lambda x, y: (y["shared"] > x["shared"]) | ((y["shared"] == x["shared"]) & ((y["dice"] > x["dice"]) | ((y["dice"] == x["dice"]) & (y["t"] < x["t"]))))
    beaten = lambda x: F.exists("_all", lambda y: meets(x, y) & (y["licence"] != x["licence"]) & more(x, y))
    rows = rows.groupBy("_row", "_id").agg(F.collect_list(run).alias("_all")).select("_id", _once(F.filter("_all", lambda x: ~less(x))).alias("_all"))
    rows = rows.select("_id", F.explode(F.filter("_all", lambda x: ~beaten(x))).alias("run"))
    return rows.select("_id", F.col("run.licence").alias("licence"), F.col("run.dice").alias("dice"), F.lit(0).alias("segment"))


def duckdb_sql() -> str:
    """The same in DuckDB, by way of a join of the segments' bigrams with the templates'."""
    rows = ", ".join(f"({i}, '{n}', '{t.replace(chr(39), chr(39) * 2)}')" for i, (n, t) in enumerate(TEMPLATES))
    norm = r"string_split_regex(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' +')"
    grams = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH templates(t, licence, body) AS (VALUES {rows}),
own AS (SELECT t, b, count(*) AS c, sum(count(*)) OVER (PARTITION BY t) AS total FROM (SELECT t, unnest({grams}) AS b FROM (SELECT t, {norm.format('body')} AS w FROM templates)) GROUP BY t, b),
parts AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents
  UNION ALL SELECT doc_id, unnest(p) FROM (SELECT doc_id, regexp_split_to_array(text, '\\n[^\\p{{L}}\\p{{N}}\\n]*\\n[^\\p{{L}}\\p{{N}}]*') AS p FROM documents) WHERE len(p) > 1
  UNION ALL SELECT doc_id, text FROM documents WHERE contains(text, chr(10))),
words AS (SELECT row_number() OVER () AS n, doc_id, {norm.format('s')} AS w FROM parts),
grams AS (SELECT n, doc_id, len(w) - 1 AS size, unnest({grams}) AS b FROM words WHERE len(w) BETWEEN 2 AND 1000),
counted AS (SELECT n, doc_id, size, b, count(*) AS c FROM grams GROUP BY ALL),
pairs AS (SELECT n, doc_id, t, 2.0::DOUBLE * sum(least(counted.c, own.c))::BIGINT / (size + total)::BIGINT AS dice FROM counted JOIN own USING (b) GROUP BY n, doc_id, t, size, total),
best AS (SELECT doc_id, licence, dice FROM pairs JOIN templates USING (t) WHERE dice >= {THRESHOLD} QUALIFY row_number() OVER (PARTITION BY n ORDER BY dice DESC, licence) = 1)
SELECT doc_id, licence, max(dice) AS similarity, count(*) AS segments FROM best GROUP BY ALL"""
