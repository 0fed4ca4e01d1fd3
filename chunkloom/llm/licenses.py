"""Licence scans by the Dice coefficient over word bigrams, in DataFrame operations only.

Texts are normalised to lower-case words. Each line, each paragraph of several lines,
and each text of several paragraphs is a unit. The size of a unit's bigram set bounds
the Dice coefficient that a template can reach, so templates come in by an equi-join
on the sizes at which they can still match. Before that, a unit has to hold enough
bigrams that occur in templates at all. What is left is compared exactly.

Matches are few and have no texts, so only they and the row keys are shuffled. The
templates are a parameter of bounded size and are broadcast.

Words are runs of digits, letters after lower-casing A-Z, and characters beyond
ASCII. Null and empty texts, and units of fewer than two words, match nothing.
Templates of fewer than two words match nothing. Equal coefficients go to the
template whose name, then text, is smaller. Rows that repeat an id and a text share
their matches. Other columns stay; `licenses` and `matches` replace columns of these
names. An empty table gives no rows, without templates nothing matches.
"""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.line_dedup import held
from chunkloom.llm.tables import own_names

LEAST = 0.8
MOST_TEMPLATES = 2000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Short public notices by licence.
TEMPLATES = [
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("proprietary", "All rights reserved."),
]


def bigrams_of(text: str) -> list[str]:
    """Distinct bigrams of a template, sorted."""
    words = re.findall(WORD, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def words_of(text) -> Column:
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def size_bounds(size: int, least: float) -> tuple[int, int]:
    """The smallest and largest bigram set whose Dice coefficient with one of `size` can reach `least`."""
    fits = [n for n in range(1, int(size * 2 / least) + 2) if 2 * min(n, size) >= least * (n + size)]
    return min(fits), max(fits)


def units(rows: DataFrame, text: str) -> DataFrame:
    """Unit rows: kind, at (number among its kind), unit."""
    parts = held(rows.filter(F.col(text).isNotNull()), _lines=F.split(text, "\n", -1), _paragraphs=F.split(text, "\n[ \t]*\n", -1))
    unit = lambda kind, value, at: F.struct(F.lit(kind).alias("kind"), at.alias("at"), value.alias("unit"))
    several = F.filter(
        F.transform("_paragraphs", lambda x, i: unit("paragraph", x, i)),
        lambda x: F.contains(x["unit"], F.lit("\n")),
    )
    whole = F.when(F.size("_paragraphs") > 1, F.array(unit("text", F.col(text), F.lit(0))))
    none = F.array().cast("array<struct<kind:string,at:int,unit:string>>")
    every = F.concat(F.transform("_lines", lambda x, i: unit("line", x, i)), several, F.coalesce(whole, none))
    kept = [c for c in rows.columns if c != text]
    return parts.select(*kept, F.inline(every))


@own_names("id_column", "text")
def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    least: float = LEAST,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows with licenses (sorted names) and matches (kind, at, license, dice of the best template per unit)."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"more than {MOST_TEMPLATES} templates")
    results = "array<struct<kind:string,at:int,license:string,dice:double>>"
    kept = docs.drop("licenses", "matches")
    known = [(name, body, grams) for name, body in sorted(templates) if (grams := bigrams_of(body))]
    if not known:
        return kept.withColumns({"licenses": F.array().cast("array<string>"), "matches": F.array().cast(results)})
    spark = docs.sparkSession
    bounds = [size_bounds(len(grams), least) for *_, grams in known]
    sized = [(n, name, i, grams) for i, ((name, _, grams), (low, high)) in enumerate(zip(known, bounds)) for n in range(low, high + 1)]
    table = F.broadcast(spark.createDataFrame(sized, "n_grams int, license string, template int, theirs array<string>"))
    every = F.array(*[F.lit(g) for g in sorted({g for *_, grams in known for g in grams})])

    low = F.lit(-(2**63)).cast("bigint")
    keyed = kept.withColumns({"_id": F.coalesce(F.col(id_column).cast("bigint"), low), "_text": F.coalesce(F.xxhash64(text), F.lit(0))})
    rows = held(units(keyed.select("_id", "_text", text), text), _words=words_of(F.col("unit"))).drop("unit")
    # With more words than this, even a unit that repeats them may have few bigrams: only the least number is a bound here.
    rows = rows.filter(F.size("_words") - 1 >= min(x for x, _ in bounds))
    pair = F.transform("_words", lambda w, i: F.concat(F.get("_words", i - 1), F.lit(" "), w))
    rows = held(rows, _grams=F.array_distinct(F.filter(pair, lambda x: x.isNotNull()))).withColumn("n_grams", F.size("_grams"))
    rows = rows.filter(F.col("n_grams").between(min(x for x, _ in bounds), max(x for _, x in bounds)))
    # 2 c >= least (a + b) and b >= c give c >= least a / (2 - least): so many of a unit's bigrams occur in one template.
    rows = rows.filter(F.size(F.array_intersect("_grams", every)) >= F.col("n_grams") * (least / (2 - least)) - 1e-9)
    common = F.size(F.array_intersect("_grams", "theirs"))
    dice = 2 * common / (F.col("n_grams") + F.size("theirs"))
    found = rows.join(table, "n_grams").withColumn("dice", dice.cast("double")).filter(F.col("dice") >= least)
    unit = ["_id", "_text", "kind", "at"]
    # A set, since repeated rows give their units several times.
    best = found.groupBy(*unit).agg(F.min_by(F.struct("license", "dice"), F.struct(-F.col("dice"), "template")).alias("best"))
    of_row = best.groupBy("_id", "_text").agg(
        F.array_sort(F.collect_set("best.license")).alias("licenses"),
        F.array_sort(F.collect_list(F.struct("kind", "at", "best.license", "best.dice"))).alias("matches"),
    )
    joined = keyed.join(of_row, ["_id", "_text"], "left")
    return joined.select(
        *kept.columns,
        F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"),
        F.coalesce("matches", F.array().cast(results)).alias("matches"),
    )
