"""License scans with built-in functions only: Dice coefficient over the word bigrams of normalised text.

Units are the lines of a text, the whole text, and runs of its words around dense template hits. A unit is lower-cased, everything but letters and digits
becomes a blank, and its different word bigrams (64-bit hashes of two words) are compared with those of
licence templates. A coefficient
of ``t`` needs sizes within a factor of ``(2 - t) / t``, so a unit whose size fits no template goes no further,
and a bigram meets only templates whose bounds hold the size of its unit. Bigrams meet templates by an
equi-join with the template table, which is a fixed list (or one of checked size); common bigrams are counted
per unit and template, and the count gives the coefficient. No unit is ever paired with all templates.

Runs of words find licences that are wrapped over lines, commented, or stand within a longer line. Only texts that hold
enough of a template's different bigrams to reach the similarity at all go on. In these every bigram weighs ``2 - t`` if
it is the template's and ``-t`` if not; a run whose weights add up to ``t`` times the template's size has a coefficient of
``t`` or more, and some run does if any run reaches ``t``. The heaviest run is found by running sums and a running minimum
over the hits, and its coefficient is computed from its own bigrams. A bigram that was met less than the largest
unit's size before weighs as one that is not the template's, so that two copies are two runs, of which the heavier
counts. A run is reported for templates that match no line and not the whole text, and of overlapping runs the one of
the highest coefficient.

Defined results: null and empty texts, and units of one word, match nothing. The lowest template name wins
among equal coefficients. Equal rows (same key and text) are reported once for each unit. Rows without a key
are reported without one, by their text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.frames import BROADCAST_ROWS, col
from millrace.session import materialize

SIMILARITY = 0.8

#: Texts of licences and the notices that refer to them.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0 header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required "
     "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions "
     "and limitations under the License."),
    ("BSD-2-Clause notice", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause notice", "Released under the BSD 3-Clause License."),
    ("BSD notice", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0 notice", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0 notice", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0 notice", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0 sentence", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0 sentence", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0 sentence", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0 notice", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0 notice", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0 notice", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0 header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
     "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
     "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received "
     "a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("LGPL-3.0 notice", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0 notice", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
     "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
     "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING "
     "FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
     "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT notice", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished "
     "to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
     "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
     "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
     "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
     "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MPL-2.0 notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for "
     "any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
     "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
)


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def bigrams(unit: Column) -> Column:
    """Hashes of the different pairs of neighbouring words of a unit whose words stand between blanks."""
    def pairs(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.array_distinct(F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.xxhash64(a, b)))

    return bound(F.filter(F.split(unit, " "), lambda w: w != ""), pairs)


def unit_bigrams(text: Column) -> Column:
    """The bigrams of the whole text, then those of each line; the text is normalised once."""
    normal = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")
    units = bound(normal, lambda t: F.concat(F.array(F.replace(t, F.lit("\n"), F.lit(" "))), F.split(t, "\n")))
    return F.transform(units, bigrams)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``license``, the size of a template, and one row for each of its bigrams."""
    rows = spark.createDataFrame(list(templates), "license string, template string")
    sized = rows.select("license", unit_bigrams(F.col("template"))[0].alias("bigrams"))
    return sized.select("license", F.size("bigrams").alias("template_size"), F.explode("bigrams").alias("bigram"))


def bounds(similarity: float) -> float:
    """How many times larger one of two sets may be, at most."""
    return (2 - similarity) / similarity


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates: DataFrame | None = None,
         similarity: float = SIMILARITY) -> DataFrame:
    """The best template of every unit that matches one.

    Columns: the key, ``text_hash``, ``line`` (from 1; 0 for the whole text), ``license``, ``unit_size`` and
    ``template_size`` (bigrams), ``common`` and ``dice``.
    """
    table = template_table(df.sparkSession) if templates is None else templates
    sizes = [r["template_size"] for r in table.select("template_size").distinct().collect()]
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    most = bounds(similarity)
    # a generator computes its rows once; a projection would be repeated in the filter on it
    units = df.where(col(text).isNotNull()).select(
        col(key).alias("id"), F.xxhash64(col(text)).alias("text_hash"), F.posexplode(unit_bigrams(col(text))).alias("line", "bigrams"))
    size, fits = F.size("bigrams"), F.lit(False)
    for low, high in merged_ranges(sizes, most):
        fits = fits | size.between(low, high)
    sized = units.where(fits)
    each = sized.select("id", "text_hash", "line", size.alias("unit_size"), F.explode("bigrams").alias("bigram"))
    t = table.withColumnRenamed("bigram", "template_bigram")
    meets = (
        (F.col("bigram") == F.col("template_bigram"))
        & (F.col("unit_size") <= F.col("template_size") * most) & (F.col("template_size") <= F.col("unit_size") * most)
    )
    unit = ["id", "text_hash", "line", "unit_size"]
    counted = each.join(F.broadcast(t) if few else t, meets).groupBy(*unit, "license", "template_size").agg(
        F.size(F.collect_set("bigram")).alias("common"))
    dice = F.round(2 * F.col("common") / (F.col("unit_size") + F.col("template_size")), 9)
    best = Window.partitionBy("id", "text_hash", "line").orderBy(F.desc("dice"), "license")
    return (
        counted.withColumn("dice", dice).where(F.col("dice") >= similarity)
        .withColumn("place", F.row_number().over(best)).where("place = 1")
        .select(F.col("id").alias(key), "text_hash", "line", "license", "unit_size", "template_size", "common", "dice")
    )


def runs(df: DataFrame, key: str = "doc_id", text: str = "text", templates: DataFrame | None = None,
         similarity: float = SIMILARITY) -> DataFrame:
    """The best run of words of every text and template that reaches the similarity, of overlapping ones the best.

    Columns as :func:`scan` has them, without ``line``, and ``first_word`` (from 1) and ``n_words``.
    """
    table = template_table(df.sparkSession) if templates is None else templates
    few = table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    t = table.withColumnRenamed("bigram", "template_bigram")
    t = F.broadcast(t) if few else t
    hit, thousandths = F.col("bigram") == F.col("template_bigram"), round(1000 * similarity)
    normal = F.trim(F.regexp_replace(F.lower(col(text)), r"[^\p{L}\p{N}]+", " "))
    texts = df.where(col(text).isNotNull()).select(col(key).alias("id"), F.xxhash64(col(text)).alias("text_hash"), normal.alias("words"))
    pair = ["id", "text_hash", "license", "template_size"]

    # texts that hold so many of a template's bigrams that some run may reach the similarity
    seen = texts.select("id", "text_hash", F.explode(bigrams(F.col("words"))).alias("bigram")).join(t, hit)
    enough = F.col("n") * (2000 - thousandths) >= thousandths * F.col("template_size")
    wanted = materialize(seen.groupBy(*pair).agg(F.count("*").alias("n")).where(enough).select(*pair))
    small = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    ids = wanted.select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_hash")).distinct()
    same_text = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    chosen = texts.join(F.broadcast(ids) if small else ids, same_text, "left_semi").groupBy("id", "text_hash").agg(F.first("words").alias("words"))
    held = materialize(chosen.select("id", "text_hash", every_bigram(F.col("words")).alias("bigrams")))

    each = held.select("id", "text_hash", F.posexplode("bigrams").alias("pos", "bigram")).withColumn("pos", F.col("pos") + 1)
    w = wanted.select(*(F.col(c).alias(f"w_{c}") for c in pair))
    same_pair = F.col("id").eqNullSafe(F.col("w_id")) & (F.col("text_hash") == F.col("w_text_hash"))
    hits = each.join(t, hit).join(w, same_pair & (F.col("license") == F.col("w_license"))).select(*pair, "pos", "bigram")
    before = F.lag("pos").over(Window.partitionBy(*pair, "bigram").orderBy("pos"))
    new = hits.withColumn("before", before).where(F.col("before").isNull() | (F.col("pos") - F.col("before") > F.col("template_size") * bounds(similarity)))
    along = Window.partitionBy(*pair).orderBy("pos")
    placed = new.withColumn("k", F.row_number().over(along).cast("long"))
    start = F.struct((2000 * (F.col("k") - 1) - thousandths * (F.col("pos") - 1)).alias("sum"), (-F.col("pos")).alias("pos"))
    least = F.min(start).over(along.rowsBetween(Window.unboundedPreceding, 0))
    weighed = placed.withColumn("least", least).withColumn("weight", 2000 * F.col("k") - thousandths * F.col("pos") - F.col("least.sum"))
    heavy = weighed.where(F.col("weight") >= thousandths * F.col("template_size"))
    best = heavy.groupBy(*pair).agg(F.max(F.struct("weight", (-F.col("pos")).alias("end"), F.col("least.pos").alias("start"))).alias("b"))
    found = best.select(*pair, (-F.col("b.start")).alias("first_word"), (F.col("b.start") - F.col("b.end") + 2).alias("n_words"))

    own = found.join(held.select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_hash"), "bigrams"), same_text).drop("of_id", "of_hash")
    sets = table.groupBy(F.col("license").alias("of_license")).agg(F.collect_set("bigram").alias("template"))
    unit = F.array_distinct(F.slice("bigrams", F.col("first_word").cast("int"), (F.col("n_words") - 1).cast("int")))
    sized = own.join(F.broadcast(sets) if few else sets, F.col("license") == F.col("of_license")).withColumn("unit", unit)
    sized = sized.withColumn("unit_size", F.size("unit")).withColumn("common", F.size(F.array_intersect("unit", "template")))
    dice = F.round(2 * F.col("common") / (F.col("unit_size") + F.col("template_size")), 9)
    judged = materialize(sized.withColumn("dice", dice).where(F.col("dice") >= similarity).select(
        *pair, "first_word", "n_words", "unit_size", "common", "dice"))
    other = judged.select(*(F.col(c).alias(f"o_{c}") for c in judged.columns))
    overlaps = (
        F.col("id").eqNullSafe(F.col("o_id")) & (F.col("text_hash") == F.col("o_text_hash"))
        & (F.col("first_word") < F.col("o_first_word") + F.col("o_n_words")) & (F.col("o_first_word") < F.col("first_word") + F.col("n_words")))
    better = (F.col("o_dice") > F.col("dice")) | ((F.col("o_dice") == F.col("dice")) & (
        (F.col("o_n_words") > F.col("n_words")) | ((F.col("o_n_words") == F.col("n_words")) & (F.col("o_license") < F.col("license")))))
    return judged.join(other, overlaps & better, "left_anti").withColumnRenamed("id", key)


def every_bigram(words: Column) -> Column:
    """Hashes of all pairs of neighbouring words, in order."""
    def pairs(w: Column) -> Column:
        n = F.greatest(F.size(w) - 1, F.lit(0))
        return F.zip_with(F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.xxhash64(a, b))

    return bound(F.filter(F.split(words, " "), lambda w: w != ""), pairs)


def licenses(df: DataFrame, key: str = "doc_id", text: str = "text", templates: DataFrame | None = None,
             similarity: float = SIMILARITY) -> DataFrame:
    """All matches: those of lines and whole texts, and runs of words for templates that match neither.

    Columns as :func:`scan` has them, and ``first_word`` and ``n_words``; ``line`` is null for runs, these two are null
    for lines and whole texts.
    """
    whole = materialize(scan(df, key, text, templates, similarity))
    known = whole.select(col(key).alias("k"), F.col("text_hash").alias("h"), F.col("license").alias("l")).distinct()
    found = runs(df, key, text, templates, similarity).join(
        known, col(key).eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h")) & (F.col("license") == F.col("l")), "left_anti")
    return whole.unionByName(found.withColumn("line", F.lit(None).cast("int")), allowMissingColumns=True)


def merged_ranges(sizes: list[int], most: float) -> list[tuple[float, float]]:
    """The sizes of units that fit some template, as ranges that don't touch."""
    found: list[tuple[float, float]] = []
    for low, high in sorted((s / most, s * most) for s in sizes):
        if found and low <= found[-1][1]:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    return found
