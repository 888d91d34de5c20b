"""License notices in texts, in DataFrame functions only.

Texts and templates are compared as sets of 5-word shingles. A template of up to ``c`` words lies whole in one of the
windows of ``2 * c`` words that start every ``c`` words. Windows retrieve templates through MinHash bands of one row:
the number of bands follows from the least Jaccard similarity that a window with 0.8 of a template's shingles can
have, so that such a window fails to collide with probability ``MISS`` at most. A band collides only where a window
holds the template's own minimal shingle, so texts and windows without any template shingle are left out before
signatures are computed; that loses no collision. Retrieved pairs are verified by exact containment of the shingles' words.

Templates are configuration: short notices and the full texts of the folder ``licenses``, on the driver, not a table that
grows with the corpus. Results depend on the text alone, so they are kept by its SHA-256.
"""

from __future__ import annotations

import math
import re
from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ._scratch import Scratch
from ._skew import join_counted

SHINGLE, CONTAINMENT, MISS = 5, 0.8, 1e-6
#: Public notices by the licenses' short names.
NOTICES = [
    ("AGPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@cache
def known_templates() -> tuple[tuple[str, str], ...]:
    """The notices, then the full texts of the folder ``licenses``, whose names end in ``-text``."""
    files = sorted(resources.files(__package__).joinpath("licenses").iterdir(), key=lambda f: f.name)
    return (*NOTICES, *((f.name.removesuffix(".txt") + "-text", f.read_text(encoding="utf-8")) for f in files if f.name.endswith(".txt")))


def template_words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def template_class(n_words: int) -> int:
    """Step of the windows for a template: the power of two from its length on, 8 at least."""
    return max(8, 1 << (n_words - 1).bit_length())


def bands_for(n_shingles: int, step: int) -> int:
    """Bands of one row so that a window holding ``CONTAINMENT`` of the template misses it with probability ``MISS``."""
    shared = math.ceil(CONTAINMENT * n_shingles)
    jaccard = shared / (2 * step - SHINGLE + 1 + n_shingles - shared)
    return math.ceil(math.log(MISS) / math.log(1 - jaccard))


def _words(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "[^a-z0-9]+", " "))
    return F.when(plain != "", F.split(plain, " ")).otherwise(F.array().cast("array<string>"))


_SHINGLES = "CASE WHEN size(w) >= 5 THEN transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])) ELSE array() END"
_SIGNATURE = "transform(sequence(0, bands - 1), b -> array_min(transform(part, x -> xxhash64(x, b))))"
_SIGNED_BY = "transform(sequence(0, bands - 1), b -> array_min(transform(part, x -> named_struct('value', xxhash64(x, b), 'shingle', x))))"
#: Distinct shingles as words.
_SPELLED = "array_distinct(transform(sequence(0, size(w) - 5), i -> concat_ws(' ', w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4])))"


def _by_value(found) -> dict[int, set[tuple[int, str]]]:
    """(step, name) of the templates with each value of a signature."""
    out: dict[int, set[tuple[int, str]]] = {}
    for row in found:
        for x in row["signature"]:
            out.setdefault(x["value"], set()).add((row["step"], row["license"]))
    return out


def _longs(values) -> Column:
    """An array of numbers in ascending order as one literal, which the optimizer folds."""
    values = sorted(values)
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_licenses, licenses (names in order, joined by commas), containment (the best).

    A document has a license if a window holds at least 0.8 of the template's distinct 5-word shingles, case and
    punctuation aside. Null, empty and short texts have none; containment is then 0. Whole texts are scanned; a long one
    takes about 100 bytes a word in its task. Templates under five words are refused. Repeated rows and rows without doc_id are scanned like others; other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    rows = []
    for name, text in known_templates() if templates is None else templates:
        words = template_words(text)
        if len(words) < SHINGLE:
            raise ValueError(f"template {name} is shorter than {SHINGLE} words")
        step = template_class(len(words))
        shingles = len({tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)})
        rows.append((name, words, step, bands_for(shingles, step)))
    known = spark.createDataFrame(rows, "license string, w array<string>, step int, bands int")
    known = known.select("license", "step", "w", F.max("bands").over(Window.partitionBy("step")).alias("bands")).repartition(max(1, len(rows)), "license")  # long ones are of few steps
    known = known.select("license", "step", "bands", F.array_distinct(F.expr(_SHINGLES)).alias("part"), F.expr(_SPELLED).alias("template"))
    known = known.select("license", "step", "bands", "template", F.expr(_SIGNED_BY).alias("signature"))
    found = known.select("license", "step", "bands", "signature").collect()  # a row for each template
    values = _longs({x["value"] for r in found for x in r["signature"]})
    # of each class of templates the shingles that can collide
    minimal = {(r["step"], r["bands"]): set() for r in found}
    for r in found:
        minimal[r["step"], r["bands"]] |= {x["shingle"] for x in r["signature"]}
    any_class = _longs(set().union(*minimal.values()))

    sha = F.sha2("text", 256).alias("sha")
    # each step comes out of a generator, so that no later step or filter computes it anew for every element
    worded = docs.select("text").select(sha, F.explode(F.array(_words(F.col("text")))).alias("w"))
    shingled = worded.select("sha", "w", F.explode(F.array(F.expr(_SHINGLES))).alias("s"))
    near = shingled.where(F.arrays_overlap("s", any_class))
    classes = [F.struct(F.lit(step).alias("step"), F.lit(bands).alias("bands"), _longs(found).alias("minimal")) for (step, bands), found in sorted(minimal.items())]
    classes = F.array(*classes) if classes else F.array().cast("array<struct<step:int,bands:int,minimal:array<bigint>>>")
    cut = F.expr(f"transform(sequence(0, (size(s) - 1) div step), k -> slice(s, cast(k * step + 1 as int), 2 * step - {SHINGLE - 1}))")
    by_class = near.select("sha", "w", "s", F.inline(classes)).where(F.arrays_overlap("s", "minimal"))
    windows = by_class.select("sha", "step", "bands", "minimal", "w", F.posexplode(cut).alias("window", "part"))
    spoken = F.expr("slice(w, cast(window * step + 1 as int), 2 * step)").alias("w")
    signed = windows.where(F.arrays_overlap("part", "minimal")).select("sha", "step", "window", spoken, F.explode(F.array(F.expr(_SIGNATURE))).alias("signature"))
    # a window's candidates are names, found within its row; the words of templates come once for each candidate
    by_value = sorted(_by_value(found).items())
    names = F.split(F.lit("|".join(",".join(f"{step}:{license}" for step, license in sorted(found_by)) for _, found_by in by_value)), "[|]")  # of each value in turn
    held = _longs(value for value, _ in by_value)
    met = F.transform(F.filter("signature", lambda v: F.array_contains(values, v)), lambda v: F.split(F.element_at(names, F.array_position(held, v).cast("int")), ","))
    prefix = F.concat(F.col("step").cast("string"), F.lit(":"))
    own = F.transform(F.filter(F.array_distinct(F.flatten(met)), lambda x: x.startswith(prefix)), lambda x: F.substr(x, F.length(prefix) + 1))
    retrieved = signed.select("sha", "w", F.explode(own).alias("license"))
    spelled = retrieved.join(F.broadcast(known.select("license", "template")), "license").select("sha", "license", "template", F.explode(F.array(F.expr(_SPELLED))).alias("part"))  # each template once
    containment = F.size(F.array_intersect("template", "part")) / F.size("template")
    passed = spelled.select("sha", "license", containment.alias("containment")).where(F.col("containment") >= CONTAINMENT)
    best = passed.groupBy("sha", "license").agg(F.max("containment").alias("containment"), F.count(F.lit(1)).alias("n"))
    by_text = best.groupBy("sha").agg(
        F.count(F.lit(1)).alias("n_licenses"), F.array_join(F.array_sort(F.collect_list("license")), ",").alias("licenses"), F.max("containment").alias("containment"), F.max("n").alias("n")
    )
    by_text = Scratch(spark, "licenses").save("matches", by_text)
    # a license file may be copied often; texts that are null meet nothing, so they are dealt out
    total = by_text.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(sha, F.concat(F.lit("null "), F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))).alias("sha"))
    return join_counted(rows, by_text, ["sha"], total, ["doc_id"], "left").select(
        "doc_id", F.coalesce("n_licenses", F.lit(0)).cast("long").alias("n_licenses"), F.coalesce("licenses", F.lit("")).alias("licenses"), F.coalesce("containment", F.lit(0.0)).alias("containment")
    )


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    rows = []
    for name, text in known_templates():
        words = template_words(text)
        rows.append(f"('{name}', {template_class(len(words))}, '{' '.join(words)}')")
    return f"""
WITH known(license, step, words) AS (VALUES {", ".join(rows)}),
spelled AS (SELECT license, step, string_split(words, ' ') AS w FROM known),
t AS (SELECT *, count(*) OVER (PARTITION BY license) AS n FROM (SELECT DISTINCT license, step, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] || ' ' || w[i + 5] AS g
  FROM (SELECT license, step, w, unnest(range(0, len(w) - 4)) AS i FROM spelled) x) y),
d AS (SELECT row_number() OVER () AS rid, doc_id,
  list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' '), lambda x: x <> '') AS w FROM documents),
s AS (SELECT rid, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] || ' ' || w[i + 5] AS g
  FROM (SELECT rid, w, unnest(range(0, len(w) - 4)) AS i FROM d WHERE len(w) >= 5) x),
h AS (SELECT s.rid, s.i, t.* FROM s JOIN t USING (g)),
o AS (SELECT rid, license, n, g, i // step - k AS win FROM h CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1) y
  WHERE i // step - k >= 0 AND i - (i // step - k) * step < 2 * step - {SHINGLE - 1}),
c AS (SELECT rid, license, max(cnt::DOUBLE / n) AS containment FROM (SELECT rid, license, n, win, count(DISTINCT g) AS cnt FROM o GROUP BY rid, license, n, win) x
  WHERE cnt::DOUBLE / n >= {CONTAINMENT}::DOUBLE GROUP BY rid, license),
r AS (SELECT rid, count(*) AS n_licenses, string_agg(license, ',' ORDER BY license) AS licenses, max(containment) AS containment FROM c GROUP BY rid)
SELECT doc_id, CAST(coalesce(n_licenses, 0) AS BIGINT) AS n_licenses, coalesce(licenses, '') AS licenses, coalesce(containment, 0.0::DOUBLE) AS containment FROM d LEFT JOIN r USING (rid)
"""


ORACLE_SQL = _oracle()
