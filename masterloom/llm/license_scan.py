"""License scans: normalised text against license templates, by Dice over word bigrams.

A text is looked at line by line, block by block (between empty lines) and as a whole.
Each such unit is normalised (lower case, words of letters and digits only) and becomes
the set of its word bigrams, as 64-bit hashes.  Dice is 2 |A and B| / (|A| + |B|); it
cannot reach the threshold t unless the smaller set has at least t / (2 - t) of the
larger one's size, so only templates within these bounds are intersected.  The best
template counts, of equals the first by name.

A license inside other text, wrapped or in paragraphs, is no such unit.  So the text's
words are searched too: a window is as long as a template and begins with one of its
bigrams, and each license's best window counts where no unit of the document has that
license.  A text that lacks t / (2 - t) of a template's bigrams has no such window, so
nearly all templates are pruned by one intersection with all templates' bigrams together.
Work on a window is bounded by its template's length.

Only DataFrame functions are used.  A unit never leaves its task: rows are shuffled only
for units and windows that match, and to put their counts beside the documents.

Null and empty texts, and units of fewer than two words, match nothing.  Rows that share
an id share the result, with the hits of all; null ids are one id.  Extra columns are
not read.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from masterloom.llm.common import column

THRESHOLD = 0.8

#: License id, and the notices and texts by which it is known.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND "
        "FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE "
        "FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
        "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
        "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
        "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
        "with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used "
        "to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE "
        "IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
        "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
        "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "EPL-2.0": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    "GPL-2.0": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-3.0": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
        "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    "proprietary": ("All rights reserved.",),
}

# Short identifiers in source files, by license id; the GNU ones have two forms more.
for _name in [n for n in TEMPLATES if n != "proprietary"]:
    _forms = ("", "-only", "-or-later") if "GPL" in _name else ("",)
    TEMPLATES[_name] += tuple(f"SPDX-License-Identifier: {_name}{form}" for form in _forms)

_BETWEEN_WORDS = r"[^\p{L}\p{N}]+"
_BETWEEN_BLOCKS = r"\n[ \t\r]*\n"


def normalised_words(text: Column) -> Column:
    return F.split(F.trim(F.lower(F.regexp_replace(text, _BETWEEN_WORDS, " "))), " ")


def bigrams(words: Column) -> Column:
    """The distinct word bigrams of an array, hashed."""
    return F.array_distinct(bigrams_in_order(words))


def bigrams_in_order(words: Column) -> Column:
    first, second = F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words))
    return F.zip_with(first, second, lambda a, b: F.xxhash64(a, b))


def template_bigrams(
    spark: SparkSession, templates: Mapping[str, tuple[str, ...]], made_by: Callable[[Column], Column] = bigrams
) -> list[tuple[str, list[int]]]:
    """License and bigrams of every template, in the order of licenses."""
    rows = [(number, name, text) for number, (name, text) in enumerate((n, t) for n in sorted(templates) for t in templates[n])]
    made = spark.createDataFrame(rows, "number int, name string, text string")
    made = made.withColumn("words", normalised_words(F.col("text"))).withColumn("bigrams", made_by(F.col("words")))
    return [(r["name"], r["bigrams"]) for r in made.orderBy("number").collect()]


def units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``kind`` (line, block, text), ``number`` and ``text`` of every unit."""
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    rows = rows.withColumn("lines", F.split("text", "\n", -1)).withColumn("blocks", F.split("text", _BETWEEN_BLOCKS, -1))

    def of(kind: str, values: Column) -> Column:
        return F.transform(values, lambda t, i: F.struct(F.lit(kind).alias("kind"), (i + 1).alias("number"), t.alias("text")))

    none = F.array().cast("array<string>")
    every = F.concat(
        of("line", F.col("lines")),
        of("block", F.when(F.size("blocks") > 1, F.col("blocks")).otherwise(none)),
        of("text", F.when(F.size("lines") > 1, F.array("text")).otherwise(none)),
    )
    # The outer forms, here and below: for the others the planner infers a filter on the
    # array, which goes below all steps and computes each of them again.
    return rows.select("id", F.explode_outer(every).alias("unit")).select("id", "unit.*").filter("text IS NOT NULL")


def _share(threshold: float) -> float:
    """The smaller set's least share of the larger one, a little less so that rounding loses no match."""
    return threshold / (2 - threshold) * (1 - 1e-9)


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id``, ``kind``, ``number``, ``license`` and ``dice`` of every unit that matches."""
    known = template_bigrams(docs.sparkSession, templates)
    share = _share(threshold)
    shortest, longest = (f(len(grams) for _, grams in known) for f in (min, max))
    # Arrays of at most one element, exploded at the end: each step is computed once, and
    # only if the step before leaves something.  No more bigrams than words but one.
    words = F.filter(F.array(normalised_words(F.col("text"))), lambda w: F.size(w) - 1 >= share * shortest)
    grams = F.filter(F.transform(words, bigrams), lambda g: (F.size(g) >= share * shortest) & (share * F.size(g) <= longest))
    found = units(docs, id_col, text_col).select("id", "kind", "number", F.explode_outer(grams).alias("grams"))
    found = found.filter("grams IS NOT NULL").withColumn("n", F.size("grams"))
    best = []
    for place, (name, grams) in enumerate(known):
        near = (F.col("n") >= share * len(grams)) & (share * F.col("n") <= len(grams))
        # One text literal, which the planner folds to an array once.
        wanted = F.split(F.lit(",".join(map(str, grams))), ",").cast("array<bigint>")
        dice = F.when(near, 2.0 * F.size(F.array_intersect("grams", wanted)) / (F.col("n") + len(grams)))
        best.append(F.struct(F.coalesce(dice, F.lit(0.0)).alias("dice"), F.lit(-place).alias("order"), F.lit(name).alias("license")))
    first = F.array(F.greatest(*best) if len(best) > 1 else best[0])
    # Exploded rather than filtered: the comparison is made, and planned, once.
    hit = F.explode_outer(F.filter(first, lambda b: b["dice"] >= threshold)).alias("hit")
    found = found.select("id", "kind", "number", hit).filter("hit IS NOT NULL")
    return found.select("id", "kind", "number", "hit.license", "hit.dice")


def _longs(values: Sequence[int]) -> Column:
    """One text literal, which the planner folds to an array once."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def scan_windows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``id``, ``kind`` (window), ``number`` (of its first word), ``license`` and ``dice`` of each license's best window."""
    known = [(name, grams) for name, grams in template_bigrams(docs.sparkSession, templates, bigrams_in_order) if grams]
    if not known:
        none = docs.limit(0).select(column(id_col).alias("id"))
        return none.selectExpr("id", "'window' AS kind", "0 AS number", "'' AS license", "0D AS dice")
    share = _share(threshold)
    distinct = [sorted(set(grams)) for _, grams in known]
    least = min(map(len, distinct))
    together = _longs(sorted({g for grams in distinct for g in grams}))
    rows = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    words = F.filter(F.array(normalised_words(F.col("text"))), lambda w: F.size(w) > share * least)
    grams = F.transform(words, lambda w: bigrams_in_order(w))
    shared = F.transform(grams, lambda g: F.struct(g.alias("grams"), F.array_intersect(together, g).alias("shared")))
    found = rows.select("id", F.explode_outer(F.filter(shared, lambda s: F.size(s["shared"]) >= share * least)).alias("s"))
    found = found.filter("s IS NOT NULL").select("id", "s.*")
    near = [
        F.when(F.size(F.array_intersect("shared", _longs(d))) >= share * len(d), F.struct(*[F.lit(v).alias(n) for n, v in (("place", i), ("length", len(g)))]))
        for i, ((_, g), d) in enumerate(zip(known, distinct))
    ]
    found = found.select("id", "grams", F.explode_outer(F.filter(F.array(*near), lambda n: n.isNotNull())).alias("near"))
    found = found.filter("near IS NOT NULL").select("id", "grams", "near.*")
    wanted = F.get(F.array(*[_longs(d) for d in distinct]), F.col("place"))
    found = found.withColumn("wanted", wanted)
    places = F.transform("grams", lambda g, i: F.when(F.array_contains("wanted", g), i))

    def judged(i: Column) -> Column:
        own = F.array_distinct(F.slice(F.col("grams"), i + 1, F.col("length")))
        return F.struct((2.0 * F.size(F.array_intersect(own, "wanted")) / (F.size(own) + F.size("wanted"))).alias("dice"), (-i).alias("order"))

    best = F.array(F.array_max(F.transform(F.filter(places, lambda i: i.isNotNull()), judged)))
    names = F.array(*[F.lit(name) for name, _ in known])
    found = found.select("id", F.get(names, F.col("place")).alias("license"), F.explode_outer(F.filter(best, lambda b: b["dice"] >= threshold)).alias("hit"))
    found = found.filter("hit IS NOT NULL").groupBy("id", "license").agg(F.max("hit").alias("hit"))
    return found.select("id", F.lit("window").alias("kind"), (1 - F.col("hit.order")).alias("number"), "license", "hit.dice")


def license_of_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``id``, ``n_hits``, and ``license``, ``dice``, ``kind``, ``number`` of the best hit, for every row.

    Hits are units that match, and of licenses that no unit of the document has the best
    window.  Of hits that are equally alike the first by license, then unit, is the best.
    """
    hits = scan(docs, id_col, text_col, **options).unionByName(scan_windows(docs, id_col, text_col, **options))
    order = F.struct((-F.col("dice")).alias("o"), "license", "kind", "number")
    unit = F.when(F.col("kind") != "window", order)
    each = hits.groupBy("id", "license").agg(F.count(unit).alias("n"), F.min(unit).alias("unit"), F.min(order).alias("any"))
    each = each.select(F.col("id").alias("h_id"), F.greatest("n", F.lit(1)).alias("n"), F.coalesce("unit", "any").alias("best"))
    summed = each.groupBy("h_id").agg(F.sum("n").alias("n_hits"), F.min("best").alias("best"))
    rows = docs.select(column(id_col).alias("id"))
    rows = rows.join(summed, F.col("id").eqNullSafe(F.col("h_id")), "left")
    return rows.select(
        "id",
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
        "best.license",
        (-F.col("best.o")).alias("dice"),
        "best.kind",
        "best.number",
    )


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: The same for DuckDB, with the bigrams as texts, for documents with distinct ids.
ORACLE = rf"""
WITH known AS (
  SELECT * FROM (VALUES {", ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name in TEMPLATES for text in TEMPLATES[name])}) t(license, text)
), texts AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines, string_split_regex(text, '\n[ \t\r]*\n') AS blocks FROM documents WHERE text IS NOT NULL
), units AS (
  SELECT doc_id, 'line' AS kind, unnest(lines) AS unit, generate_subscripts(lines, 1) AS number FROM texts
  UNION ALL SELECT doc_id, 'block', unnest(blocks), generate_subscripts(blocks, 1) FROM texts WHERE len(blocks) > 1
  UNION ALL SELECT doc_id, 'text', text, 1 FROM texts WHERE len(lines) > 1
), words AS (
  SELECT *, string_split(trim(lower(regexp_replace(unit, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), ' ') AS w FROM units
), grams AS (
  SELECT *, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM words
), template_words AS (
  SELECT license, string_split(trim(lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), ' ') AS w FROM known
), template_grams AS (
  SELECT license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t FROM template_words
), compared AS (
  SELECT doc_id, kind, number, license, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
  FROM grams JOIN template_grams ON len(g) >= 0.66 * len(t) AND 0.66 * len(g) <= len(t)
), best AS (
  SELECT doc_id, kind, number, license, dice FROM compared WHERE dice >= {THRESHOLD}::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY doc_id, kind, number ORDER BY dice DESC, license) = 1
), whole AS (
  SELECT doc_id, string_split(trim(lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]+', ' ', 'g'))), ' ') AS w FROM texts
), whole_grams AS (
  SELECT doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS g FROM whole
), near AS (
  SELECT doc_id, license, g, t, len(w) - 1 AS length FROM whole_grams JOIN
    (SELECT license, w, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS t FROM template_words)
    ON len(list_intersect(g, t)) >= 0.66 * len(t)
), begun AS (
  SELECT *, unnest(list_filter(range(1, len(g) + 1), lambda i: list_contains(t, g[i]))) AS number FROM near
), windows AS (
  SELECT doc_id, license, number, 2.0::DOUBLE * len(list_intersect(own, t)) / (len(own) + len(t)) AS dice
  FROM (SELECT doc_id, license, number, t, list_distinct(g[number : number + length - 1]) AS own FROM begun)
), hits AS (
  SELECT doc_id, kind, number, license, dice FROM best
  UNION ALL
  SELECT doc_id, 'window', number, license, dice FROM windows ANTI JOIN best USING (doc_id, license) WHERE dice >= {THRESHOLD}::DOUBLE
  QUALIFY row_number() OVER (PARTITION BY doc_id, license ORDER BY dice DESC, number) = 1
), summed AS (
  SELECT doc_id, count(*) AS n_hits, min(ROW(-dice, license, kind, number)) AS b FROM hits GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_hits, 0) AS n_hits, b[2] AS license, -(b[1]) AS dice, b[3] AS kind, b[4]::INTEGER AS number
FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id
"""
