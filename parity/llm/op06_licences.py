"""Licence scan: Dice coefficient over word bigrams, in DataFrame functions only.

A text's units are its lines and, where a paragraph (lines without a blank one
between) has more than one line, its paragraphs.  Unit and template are
normalised alike: A-Z to a-z, every run of other characters than a-z and 0-9
one space.  With the sets of word bigrams A and B, the coefficient is
2|A n B| / (|A| + |B|); a unit matches a template at 0.8 or more.  Only
templates of a size between |A| * 0.8 / 1.2 and |A| * 1.2 / 0.8 can reach
that, so the others are left out before any intersection is built.  Bigrams
are compared by 64-bit hashes.

Everything happens within a document's row: nothing is shuffled, and templates
are literals of the plan (a fixed list).

Nulls, ties, emptiness: a null or empty text matches nothing (licence and dice
null, n_matches 0); of equal coefficients the licence first in alphabetical
order is named; a null doc_id stays null; repeated rows each give their row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.llm import common
from parity.llm.op01_quality_lines import let

MIN_DICE_PERCENT = 80

# Licence notices as they are published.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "Proprietary": [
        "All rights reserved.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()


def bigrams_of(template: str) -> list[tuple[str, str]]:
    """Distinct word bigrams of a template, in order."""
    w = re.sub(r"[^a-z0-9]+", " ", common.lower_ascii(template)).split()
    return list(dict.fromkeys(zip(w, w[1:])))


def size_bounds(n: int, percent: int = MIN_DICE_PERCENT) -> tuple[int, int]:
    """Sizes of a set that can reach the coefficient with one of ``n``."""
    return ceil(n * percent / (200 - percent)), floor(n * (200 - percent) / percent)


def _templates(percent: int, templates: dict[str, list[str]]) -> Column:
    made = []
    for licence, texts in templates.items():
        for t in texts:
            grams = bigrams_of(t)
            lo, hi = size_bounds(len(grams), percent)
            made.append(F.struct(
                F.lit(licence).alias("licence"), F.lit(len(grams)).alias("n"), F.lit(lo).alias("lo"),
                F.lit(hi).alias("hi"),
                F.array(*[F.xxhash64(F.lit(a), F.lit(b)) for a, b in grams]).alias("grams")))
    return F.array(*made)


def _matches(unit: Column, at: Column, percent: int, templates: Column, least_words: int) -> Column:
    """(ratio, licence, unit) of the templates that a unit matches."""
    words = F.split(F.trim(F.regexp_replace(F.translate(unit, _UPPER, _LOWER), "[^a-z0-9]+", " ")), " ")
    none = F.array().cast("array<struct<dice:double,licence:string,unit:int>>")

    def of_grams(g: Column) -> Column:
        near = F.filter(templates, lambda t: F.size(g).between(t["lo"], t["hi"]))
        scored = F.transform(near, lambda t: F.struct(
            t["licence"].alias("licence"), F.size(F.array_intersect(t["grams"], g)).alias("both"),
            (t["n"] + F.size(g)).alias("sizes")))
        good = F.filter(scored, lambda s: 200 * s["both"] >= percent * s["sizes"])
        return F.transform(good, lambda s: F.struct(
            (2 * s["both"] / s["sizes"]).alias("dice"), s["licence"].alias("licence"), at.alias("unit")))

    def of_words(w: Column) -> Column:
        grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.xxhash64(
            F.element_at(w, i), F.element_at(w, i + 1))))
        return F.when(F.size(w) < least_words, none).otherwise(let(grams, of_grams))

    return let(words, of_words)


def scan(docs: DataFrame, percent: int = MIN_DICE_PERCENT,
         templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row a document: doc_id, licence and dice of its best match,
    n_matches (lines that match a template), licences (all, in order)."""
    templates = TEMPLATES if templates is None else templates
    least = 1 + min(size_bounds(len(bigrams_of(t)), percent)[0] for x in templates.values() for t in x)
    text = F.col("text")
    lines = F.split(text, "\n")
    blocks = F.filter(F.split(text, "\n[\\x20\\x09-\\x0D]*\n"), lambda x: F.contains(x, F.lit("\n")))
    per_unit = F.transform(F.concat(lines, blocks), lambda u, i: _matches(
        u, i, percent, _templates(percent, templates), max(2, least)))
    found = common.doc_columns(docs).select("doc_id", F.flatten(per_unit).alias("m"))
    best = F.element_at(F.sort_array(F.transform(F.col("m"), lambda x: F.struct(
        (-x["dice"]).alias("less"), x["licence"].alias("licence")))), 1)
    return (found.withColumn("best", F.when(F.size("m") > 0, best))
            .select("doc_id", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("dice"),
                    F.size(F.array_distinct(F.transform("m", lambda x: x["unit"]))).cast("long").alias("n_matches"),
                    F.array_join(F.array_sort(F.array_distinct(F.transform("m", lambda x: x["licence"]))), ",")
                    .alias("licences")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.read(spark, sf_dir, "documents"))


def _sql() -> str:
    rows = ",\n  ".join("('{}', ['{}'])".format(licence, "', '".join(f"{a} {b}" for a, b in bigrams_of(t)))
                        for licence, texts in TEMPLATES.items() for t in texts)
    return rf"""
WITH t(licence, grams) AS (VALUES
  {rows}),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (SELECT doc_id, string_split(text, chr(10)) || list_filter(
        string_split_regex(text, '\n[\x20\x09-\x0D]*\n'), lambda x: contains(x, chr(10))) AS units FROM d),
e AS (SELECT doc_id, unnest(range(1, len(units) + 1)) AS i, units FROM u),
w AS (SELECT doc_id, i, string_split(trim(regexp_replace(translate(units[i], '{_UPPER}', '{_LOWER}'),
        '[^a-z0-9]+', ' ', 'g'), ' '), ' ') AS ws FROM e),
g AS (SELECT doc_id, i, list_distinct(list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1])) AS grams
      FROM w WHERE len(ws) >= 2),
s AS (SELECT doc_id, i, licence, len(list_intersect(t.grams, g.grams)) AS shared, len(t.grams) + len(g.grams) AS sizes
      FROM g JOIN t ON 200 * least(len(g.grams), len(t.grams)) >= {MIN_DICE_PERCENT} * (len(t.grams) + len(g.grams))),
m AS (SELECT doc_id, i, licence, 2 * shared / sizes AS dice FROM s WHERE 200 * shared >= {MIN_DICE_PERCENT} * sizes),
a AS (SELECT doc_id, arg_min(licence, (-dice, licence)) AS licence, max(dice) AS dice, count(DISTINCT i) AS n_matches,
        array_to_string(list_sort(list(DISTINCT licence)), ',') AS licences FROM m GROUP BY doc_id)
SELECT doc_id, licence, dice, coalesce(n_matches, 0) AS n_matches, coalesce(licences, '') AS licences
FROM d LEFT JOIN a USING (doc_id)
"""


SQL = _sql()
