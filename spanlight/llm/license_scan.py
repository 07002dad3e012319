"""Licence scan: normalised text against licence templates, Dice coefficient over word bigrams.

The units compared are the lines, the paragraphs and the whole of a text. A unit of a bigrams can reach
the coefficient t with a template of b bigrams only if t/(2-t)*b <= a <= (2-t)/t*b, and only if it holds
one of a few words of the template: of its b bigrams at most b - ceil(t/(2-t)*b) may be missing, so one
word out of that many bigrams plus one must be there. Units that fail either bound are left out
before any bigram is made. What is left is joined to the bigrams of the templates by hash.

All of it is DataFrame work. The template side is a literal table with the size of the list given.

Defined cases: null and empty texts match nothing; units of less than two words have no bigrams and match
nothing; repeated rows are reported each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import computed_once
from .common import ascii_lower

# Notices by which works under these licences are marked.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0-or-later": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "All-rights-reserved": "All rights reserved.",
}
THRESHOLD = 0.8


def words(text: Column) -> Column:
    """Words of the normalised text: A-Z folded, every other sign than letters of a-z, digits and non-ASCII is a gap."""
    return F.split(F.trim(F.regexp_replace(ascii_lower(text), r"[^a-z0-9\x{80}-\x{10FFFF}]+", " ")), " ")


def _plain_words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.translate({c: c + 32 for c in range(65, 91)}))


def _least(size: int, threshold: float) -> int:
    """Fewest bigrams of a template of this size that a match must share; also the least size of a match."""
    t = Fraction(str(threshold))
    return max(1, math.ceil(t * size / (2 - t)))


def _most(size: int, threshold: float) -> int:
    t = Fraction(str(threshold))
    return math.floor((2 - t) * size / t)


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and licence found: doc_id, license, dice (the best unit's), n_units."""
    spark = docs.sparkSession
    bigrams = {name: sorted(set(zip(w, w[1:]))) for name, text in templates.items() if len(w := _plain_words(text)) > 1}
    must = sorted({max(pair, key=len) for pairs in bigrams.values()
                   for pair in sorted(pairs, key=lambda p: -max(map(len, p)))[:len(pairs) - _least(len(pairs), threshold) + 1]})
    low = min((_least(len(p), threshold) for p in bigrams.values()), default=1)
    high = max((_most(len(p), threshold) for p in bigrams.values()), default=0)
    wanted = spark.createDataFrame(
        [(" ".join(pair), name, len(pairs), _least(len(pairs), threshold), _most(len(pairs), threshold))
         for name, pairs in bigrams.items() for pair in pairs],
        "bigram string, license string, size int, least int, most int")

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.monotonically_increasing_id().alias("n"))
    units = F.array_distinct(F.concat(F.split(text, "\n"), F.split(text, r"\n[ \t]*\n"), F.array(text)))
    parts = rows.select("doc_id", "n", F.posexplode(units).alias("unit", "part"))
    # The words are made once per unit, behind a generator, and looked at by all that follows.
    found = (computed_once(parts, w=words(F.col("part"))).drop("part")
             # distinct bigrams are at most the words less one, and a unit of many words may repeat few
             .where((F.size("w") > low) & F.arrays_overlap("w", F.array(*[F.lit(m) for m in must]).cast("array<string>"))))
    pairs = F.when(F.size("w") > 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i)))))
    sized = computed_once(found, b=pairs).where((F.size("b") >= low) & (F.size("b") <= high))
    shared = (sized.select("doc_id", "n", "unit", F.size("b").alias("a"), F.explode("b").alias("bigram"))
              .join(F.broadcast(wanted), "bigram")  # the list of templates that the caller wrote down
              .where((F.col("a") >= F.col("least")) & (F.col("a") <= F.col("most")))
              .groupBy("doc_id", "n", "unit", "license", "a", "size").agg(F.count(F.lit(1)).alias("both")))
    dice = 2 * F.col("both") / (F.col("a") + F.col("size"))
    return (shared.where(dice >= threshold).groupBy("doc_id", "n", "license")
            .agg(F.round(F.max(dice), 6).alias("dice"), F.count(F.lit(1)).alias("n_units")).drop("n"))


def sql(templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same scan without any pruning, as DuckDB SQL."""
    listed = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in templates.items())
    norm = "string_split(trim(regexp_replace(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g')), ' ')"
    grams = "list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH l AS (SELECT license, {norm.format('notice')} AS w FROM (VALUES {listed}) t(license, notice)),
lb AS (SELECT license, len({grams}) AS size, unnest({grams}) AS bigram FROM l),
d AS (SELECT doc_id, row_number() OVER () AS n, coalesce(text, '') AS text FROM documents),
u AS (SELECT DISTINCT doc_id, n, unnest(list_concat(string_split(text, chr(10)), string_split_regex(text, '\\n[ \\t]*\\n'), [text])) AS unit FROM d),
w AS (SELECT doc_id, n, unit, {norm.format('unit')} AS w FROM u),
b AS (SELECT doc_id, n, unit, len({grams}) AS a, unnest({grams}) AS bigram FROM w WHERE len(w) > 1),
s AS (SELECT doc_id, n, unit, license, 2 * count(*) / (a + size) AS dice FROM b JOIN lb USING (bigram) GROUP BY doc_id, n, unit, license, a, size)
SELECT doc_id, license, round(max(dice), 6) AS dice, count(*) AS n_units FROM s WHERE dice >= {threshold} GROUP BY doc_id, n, license"""
