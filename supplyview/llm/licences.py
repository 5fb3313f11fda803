"""Licence scans: Dice coefficient over word bigrams against licence templates.

DataFrame functions only. Texts are lower-cased; whatever is not a-z, 0-9 or a line feed
becomes a space. Units of a text are its lines, its paragraphs (between blank lines) of more
than one line, and the whole if it has more than one paragraph. A unit of n bigrams can
reach Dice t with a template of m only if n lies within [m t / (2 - t), m (2 - t) / t]:
units outside all templates' bounds are dropped while the text is at hand, and a unit
meets only templates whose bounds hold it. Dice is 2 |common| / (n + m), where a
bigram counts as often as it occurs in both.

Outside the units that match a licence, word windows of any place and size within the bounds are
compared as well, across lines and paragraphs, so a notice inside a line or of several
paragraphs is found. The best window begins and ends at bigrams of the template and has at
least m t / (2 - t) of them; only places so dense are tried, each start with all ends. Of
windows that overlap, the best counts. Texts without any of the words that every match
must have (``anchors``) are dropped first.

Result: one row per (doc_id, licence) with the best Dice and the number of units and windows
that reach the threshold. Null, empty and one-word texts match nothing. Rows with the same doc_id add
up; a null doc_id is a key like any other. Very long texts are compared whole; an empty
table gives no rows. Templates may be replaced; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.8
WINDOWS = "array<struct<common:int,start:int,end:int,dice:double>>"

# The wording of licences and of their usual notices.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the "
        "GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version. This program is distributed in the hope "
        "that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for "
        "more details. You should have received a copy of the GNU General Public License along with "
        "this program. If not, see <https://www.gnu.org/licenses/>."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy "
        "of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
}


def words_of(text: str) -> list[str]:
    """Words of a template, as the scan sees them."""
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def template_bigrams(templates: dict[str, str]) -> list[tuple[str, str, int, int]]:
    """(licence, bigram, its number, number of all bigrams)."""
    out = []
    for name, text in templates.items():
        w = words_of(text)
        pairs = Counter(f"{a} {b}" for a, b in zip(w, w[1:]))
        out += [(name, pair, n, len(w) - 1) for pair, n in sorted(pairs.items())]
    return out


def bounds(m: int, threshold: float) -> tuple[float, float]:
    """Numbers of bigrams that can reach the threshold with a template of ``m``."""
    return m * threshold / (2 - threshold), m * (2 - threshold) / threshold


def anchors(templates: dict[str, str], threshold: float) -> list[str]:
    """Words of which every match has at least one: without their bigrams too few are left.

    Long words first, as they are the rarer ones.
    """
    out: set[str] = set()
    for text in templates.values():
        w = words_of(text)
        pairs = list(zip(w, w[1:]))
        most = needed(len(pairs), threshold) - 1
        for word in sorted(set(w), key=lambda x: (x not in out, -len(x), x)):
            if sum(not out & set(p) for p in pairs) <= most:
                break
            out.add(word)
    return sorted(out)


def needed(m: int, threshold: float) -> int:
    """Bigrams in common with a template of ``m`` without which no unit reaches the threshold."""
    return max(1, math.ceil(bounds(m, threshold)[0] - 1e-9))


def _tidy(text: Column) -> Column:
    """Single spaces, none at the ends of lines or of the text."""
    plain = F.regexp_replace(F.lower(text), r"[^a-z0-9\n]+", " ")
    return F.trim(F.regexp_replace(plain, r" ?\n ?", "\n"))


def _n_bigrams(unit: Column) -> Column:
    return F.length(unit) - F.length(F.replace(unit, F.lit(" "), F.lit("")))


def _bigrams(unit: Column) -> Column:
    words = F.split(unit, " ")
    first = F.slice(words, F.lit(1), F.size(words) - 1)
    second = F.slice(words, F.lit(2), F.size(words) - 1)
    return F.zip_with(first, second, lambda a, b: F.concat(a, F.lit(" "), b))


def _flat(unit: Column) -> Column:
    """Lines joined; line feeds at the ends go."""
    return F.trim(F.regexp_replace(unit, "\n+", " "))


def _starts(text: Column, feeds: str) -> Column:
    """Numbers of the words that begin the text or follow the line feeds."""
    marked = F.regexp_replace(F.trim(text, F.lit("\n")), feeds, " \u0001")
    words = F.split(F.regexp_replace(marked, "\n", " "), " ")
    return F.array_compact(F.transform(words, lambda w, i: F.when((i == 0) | w.startswith("\u0001"), i)))


def units(text: Column, least: float, most: float) -> Column:
    """(number of the first word, unit) of the units of a tidy text whose size is between the bounds."""
    def placed(found: Column, starts: Column) -> Column:
        return F.zip_with(found, starts, lambda u, i: F.struct(i.alias("start"), u.alias("unit")))

    def fits(x: Column) -> Column:
        return _n_bigrams(x["unit"]).between(least, most)

    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    # Those without a word begin nowhere.
    paragraphs = placed(F.filter(F.split(text, "\n\n+"), lambda x: _flat(x) != ""), _starts(text, "\n\n+"))
    long_enough = F.transform(
        F.filter(paragraphs, lambda x: x["unit"].contains("\n")),
        lambda x: F.struct(x["start"].alias("start"), _flat(x["unit"]).alias("unit")),
    )
    whole = placed(F.array(F.when(text.contains("\n\n"), _flat(text))), F.array(F.lit(0)))
    return F.filter(F.concat(placed(lines, _starts(text, "\n+")), long_enough, whole), fits)


def outside(hits: Column, spans: Column) -> Column:
    """The hits that no span holds, in order."""
    def within(h: Column) -> Column:
        return F.exists(spans, lambda s: (s["start"] <= h["pos"]) & (h["pos"] <= s["start"] + s["n"] - 1))

    return F.sort_array(F.filter(hits, lambda h: ~within(h)))


def windows(hits: Column, m: Column, needed: Column, most: Column, threshold: float) -> Column:
    """(start, end, dice) of the windows that reach the threshold, by start.

    ``hits`` are the places of the template's bigrams, each with the place after which a window
    must begin to count it: that of the same bigram as many before as the template has.
    Columns that occur in functions of elements are to be columns of the table, not expressions.
    """
    def best(hits: Column, i: Column) -> Column:
        """The best window from hit i on."""
        start = F.get(hits, i)["pos"]
        none = F.struct(
            F.lit(0).alias("common"), start.alias("start"), start.alias("end"), F.lit(0.0).alias("dice")
        )

        def step(acc: Column, h: Column) -> Column:
            common = acc["common"] + F.when(h["before"] < start, 1).otherwise(0)
            dice = 2 * common / (h["pos"] - start + 1 + m)
            better = dice > acc["dice"]
            return F.struct(
                common.alias("common"), start.alias("start"),
                F.when(better, h["pos"]).otherwise(acc["end"]).alias("end"),
                F.when(better, dice).otherwise(acc["dice"]).alias("dice"),
            )

        return F.aggregate(F.slice(hits, i + 1, most), none, step)

    # A window needs so many hits within its largest size; few places have them.
    dense = F.filter(
        F.sequence(F.lit(0), F.size(hits) - needed),
        lambda i: F.get(hits, i + needed - 1)["pos"] - F.get(hits, i)["pos"] < most,
    )
    found = F.filter(F.transform(dense, lambda i: best(hits, i)), lambda w: w["dice"] >= threshold)
    return F.when(F.size(hits) >= needed, found).otherwise(F.array().cast(WINDOWS))


def apart(found: Column) -> Column:
    """Of windows that overlap, the best."""
    def keep(acc: Column, w: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        return (
            F.when((F.size(acc) == 0) | (last["end"] < w["start"]), F.concat(acc, F.array(w)))
            .when(w["dice"] > last["dice"], F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(w)))
            .otherwise(acc)
        )

    return F.aggregate(found, F.array().cast(WINDOWS), keep)


def scan(
    docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, licence, dice, n_units) of all matches."""
    spark: SparkSession = docs.sparkSession
    templates = templates or TEMPLATES
    known = template_bigrams(templates)
    low, high = bounds(1, threshold)
    least, most = low * min(m for *_, m in known), high * max(m for *_, m in known)
    words = F.split(_flat(F.col("text")), " ")
    some = F.array(*[F.lit(w) for w in anchors(templates, threshold)])
    tidy = docs.select(
        "doc_id", _tidy(F.col("text")).alias("text"), F.monotonically_increasing_id().alias("row_id")
    )
    numbered = tidy.filter(F.arrays_overlap(words, some))
    # The text itself, number 0, is where windows are looked for.
    text = F.array(F.struct(F.lit(0).alias("start"), _flat(F.col("text")).alias("unit")))
    cut = numbered.select(
        "doc_id", "row_id", F.posexplode(F.concat(text, units(F.col("text"), least, most))).alias("unit_no", "unit")
    ).select(
        "doc_id", "row_id", "unit_no", F.col("unit.start").alias("start"),
        _n_bigrams(F.col("unit.unit")).alias("n"), _bigrams(F.col("unit.unit")).alias("pairs"),
    )
    rows = [(*k, needed(k[3], threshold), math.floor(bounds(k[3], threshold)[1] + 1e-9)) for k in known]
    table = spark.createDataFrame(rows, "licence string, bigram string, times int, m int, needed int, most int")
    in_text = F.col("unit_no") == 0
    met = (
        cut.select("doc_id", "row_id", "unit_no", "start", "n", F.posexplode("pairs").alias("pos", "bigram"))
        .join(F.broadcast(table), "bigram")  # the templates: given, a few hundred rows
        .filter(in_text | ((F.col("n") >= F.col("m") * low) & (F.col("n") <= F.col("m") * high)))
    )
    # Only bigrams that a fitting template has are shuffled.
    common = met.groupBy("row_id", "licence", "unit_no", "bigram").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "start", "n", "m", "needed", "most", "times")],
        F.count(F.lit(1)).alias("count"),
        F.sort_array(F.collect_list(F.when(in_text, F.col("pos")))).alias("places"),
    )
    before = F.transform("places", lambda p, i: F.struct(
        p.alias("pos"), F.coalesce(F.get("places", i - F.col("times")), F.lit(-1)).alias("before")
    ))
    by_unit = (
        common.groupBy("row_id", "licence", "unit_no")
        .agg(
            *[F.first(c).alias(c) for c in ("doc_id", "start", "n", "m", "needed", "most")],
            (2 * F.sum(F.least("count", "times")) / (F.first("n") + F.first("m"))).alias("dice"),
            F.flatten(F.collect_list(F.when(in_text, before))).alias("hits"),
        )
        .filter(F.when(in_text, F.size("hits") >= F.col("needed")).otherwise(F.col("dice") >= threshold))
    )
    span = F.struct("start", "n", "dice")
    by_row = by_unit.groupBy("row_id", "licence").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "m", "needed", "most")],
        F.collect_list(F.when(~in_text, span)).alias("spans"),
        F.flatten(F.collect_list(F.when(in_text, F.col("hits")))).alias("hits"),
    )
    # One column after the other: an expression inside a function of elements runs for each.
    found = (
        by_row.withColumn("hits", outside(F.col("hits"), F.col("spans")))
        .withColumn("windows", windows(*[F.col(c) for c in ("hits", "m", "needed", "most")], threshold))
        .withColumn("windows", apart(F.col("windows")))
        .select("doc_id", "licence", F.explode(F.concat("spans.dice", "windows.dice")).alias("dice"))
    )
    return found.groupBy("doc_id", "licence").agg(
        F.max("dice").alias("dice"), F.count(F.lit(1)).alias("n_units")
    )


def scan_sql(templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> str:
    """The same scan in SQL."""
    rows = ", ".join(f"('{l}', '{b}', {n}, {m})" for l, b, n, m in template_bigrams(templates or TEMPLATES))
    return rf"""
WITH template(licence, bigram, times, m) AS (VALUES {rows}),
tidy AS (
    SELECT doc_id, trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9
]+', ' ', 'g'), ' ?
 ?', chr(10), 'g'), ' ') AS t
    FROM documents WHERE text IS NOT NULL
),
cut AS (
    SELECT doc_id, unnest(string_split(t, chr(10))) AS unit FROM tidy
    UNION ALL
    SELECT doc_id, trim(regexp_replace(p, '
+', ' ', 'g'), ' ')
    FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '

+')) AS p FROM tidy) WHERE contains(p, chr(10))
    UNION ALL
    SELECT doc_id, trim(regexp_replace(t, '
+', ' ', 'g'), ' ') FROM tidy WHERE contains(t, chr(10) || chr(10))
),
numbered AS (
    SELECT row_number() OVER () AS unit_id, doc_id, string_split(unit, ' ') AS w FROM cut
),
pairs AS (
    SELECT unit_id, doc_id, len(w) - 1 AS n, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS bigram
    FROM numbered
),
common AS (
    SELECT unit_id, doc_id, licence, n, m, least(count(*), times) AS c
    FROM pairs JOIN template USING (bigram)
    GROUP BY unit_id, doc_id, licence, n, m, bigram, times
),
found AS (
    SELECT unit_id, doc_id, licence, 2 * sum(c) / (n + m) AS dice
    FROM common GROUP BY unit_id, doc_id, licence, n, m
)
SELECT doc_id, licence, max(dice)::DOUBLE AS dice, count(*) AS n_units
FROM found WHERE dice >= {threshold} GROUP BY doc_id, licence
"""
