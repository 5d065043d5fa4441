"""Licence notices by the Dice coefficient over word bigrams, in DataFrame functions only.

A text's units are its lines, its paragraphs of several lines, its sentences, the
whole text, and windows of each template's number of words, so a notice is also
found inside a longer line. Windows begin with a template's bigram and hold as
many of its bigrams as a match needs. All units count alike. They are lower-cased
and reduced to words of a-z and 0-9; their distinct word bigrams are compared
with those of licence templates. Two sets of sizes a and b can reach a
coefficient of t only if b * t / (2 - t) <= a <= b * (2 - t) / t, so units outside
the bounds of all templates are dropped before bigrams are formed, and templates
outside a unit's bounds before bigrams are counted.

Texts that cannot hold a match go first. A match has at least b * t / (2 - t) of
a template's b bigrams, so it has one of any b - ceil(b * t / (2 - t)) + 1 of them.
One pattern looks for these bigrams, the longest of each template, in every
whole text; only texts with one of them are cut into units.

Defined results: null and empty texts have no unit and no row, a text of one
word has no bigram and no row; units of equal words count once, repeated rows of a
doc_id as one document; further columns are ignored; an empty table gives no
row. A null doc_id is a document of its own. Long texts are handled whole; one
text's units stay in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.shared import stored

#: Least coefficient of a match.
LEAST = 0.8

# Public licence notices by name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-header",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    (
        "MIT-grant",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC-grant",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-grant",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    ("Apache-2.0-spdx", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause-spdx", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause-spdx", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL-2.0-spdx", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-3.0-spdx", "SPDX-License-Identifier: GPL-3.0"),
    ("ISC-spdx", "SPDX-License-Identifier: ISC"),
    ("LGPL-3.0-spdx", "SPDX-License-Identifier: LGPL-3.0"),
    ("MIT-spdx", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0-spdx", "SPDX-License-Identifier: MPL-2.0"),
)
#: Ends of sentences, with the white space after them.
_SENTENCE_END = "[.!?;][\\t-\\r ]+"


def _words(column):
    return F.filter(F.split(column, " "), lambda w: w != "")


def _pairs(words):
    """Bigrams of an array of words in their order."""
    # Filters may be moved below this, so it has to hold for no word as well.
    return F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def _bigrams(words):
    """Distinct bigrams of an array of words."""
    return F.array_distinct(_pairs(words))


def template_bigrams(spark, templates=TEMPLATES) -> DataFrame:
    """license, size (number of distinct bigrams) and bigram of all templates."""
    rows = spark.createDataFrame(list(templates), "license string, notice string")
    words = _words(_reduced("notice"))
    return rows.select("license", _bigrams(words).alias("bigrams")).select(
        "license", F.size("bigrams").alias("size"), F.explode("bigrams").alias("bigram")
    )


def _needed(size, low):
    return F.ceil(size * low - 1e-9).cast("int")


def _telling(known: DataFrame, low: float) -> str:
    """A pattern that every lower-cased text with a match contains."""
    # The longest bigrams are the rarest as a rule; any choice of as many is right.
    placed = known.withColumn(
        "place", F.row_number().over(Window.partitionBy("license").orderBy(F.desc(F.length("bigram")), "bigram"))
    )
    rows = placed.where(F.col("place") <= F.col("size") - _needed(F.col("size"), low) + 1).select("bigram").distinct()
    pairs = sorted(r["bigram"].replace(" ", "[^a-z0-9]++") for r in rows.collect())
    return "(?<![a-z0-9])(?:" + "|".join(pairs) + ")(?![a-z0-9])"


def find_licenses(docs: DataFrame, templates=TEMPLATES, least: float = LEAST) -> DataFrame:
    """doc_id, license, dice (of the best unit) and n_units (matching units) for every notice found in ``docs``."""
    spark = docs.sparkSession
    known = template_bigrams(spark, templates)  # as many rows as the templates have bigrams
    sizes = [r["size"] for r in known.select("size").distinct().collect()]
    low = least / (2 - least)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stored(rows.where(F.lower("text").rlike(_telling(known, low))), "licenses-texts")
    units = _units(rows).unionAll(_windows(rows, known, templates, low))
    found = _dice(units, known, sizes, least)
    return found.groupBy("doc_id", "license").agg(F.max("dice").alias("dice"), F.count("*").alias("n_units"))


def _reduced(column):
    return F.regexp_replace(F.lower(column), "[^a-z0-9]+", " ")


def _units(rows: DataFrame) -> DataFrame:
    """doc_id and unit: lines, paragraphs, sentences and the whole of the texts (doc_id, text)."""
    clean = F.regexp_replace(F.lower("text"), "[^a-z0-9\n]+", " ")
    return rows.select("doc_id", "text", clean.alias("clean")).select(
        "doc_id",
        F.explode(
            F.array_distinct(
                F.concat(
                    F.split("clean", "\n"),
                    F.transform(F.split("clean", "\n *\n"), lambda p: F.replace(p, F.lit("\n"), F.lit(" "))),
                    F.transform(F.split(F.lower("text"), _SENTENCE_END), _reduced),
                    F.array(F.replace("clean", F.lit("\n"), F.lit(" "))),
                )
            )
        ).alias("unit"),
    )


def _windows(rows: DataFrame, known: DataFrame, templates, low: float) -> DataFrame:
    """doc_id and unit: windows of the texts (doc_id, text) that may hold a notice."""
    spark = rows.sparkSession
    lengths = spark.createDataFrame(list(templates), "license string, notice string").select(
        "license", F.size(_words(_reduced("notice"))).alias("n_words")
    )
    # Bigrams a match has in common with its template at least.
    needs = known.join(F.broadcast(lengths), "license").withColumn("needed", _needed(F.col("size"), low))
    texts = rows.withColumn("text_", F.xxhash64("text"))
    words = _words(_reduced("text"))
    pairs = texts.select("doc_id", "text_", words.alias("words")).select(
        "doc_id", "text_", F.posexplode(_pairs(F.col("words"))).alias("place", "bigram")
    )
    hits = (
        pairs.join(F.broadcast(needs), "bigram")
        .groupBy("doc_id", "text_", "license", "needed", "n_words")
        .agg(F.sort_array(F.collect_set("place")).alias("places"))
    )
    starts = F.filter(
        "places", lambda p, i: F.get(F.col("places"), i + F.col("needed") - 1) <= p + F.col("n_words") - 2
    )
    windows = hits.select("doc_id", "text_", "n_words", F.explode(starts).alias("start")).distinct()
    windows = windows.groupBy("doc_id", "text_").agg(F.collect_list(F.struct("start", "n_words")).alias("windows"))
    near = windows.withColumnRenamed("doc_id", "doc_id_").withColumnRenamed("text_", "hash_")
    holding = texts.join(near, texts.doc_id.eqNullSafe(near.doc_id_) & (texts.text_ == near.hash_))
    # At a text's end windows move back to keep their length: a tail of a notice is no unit of its own.
    last = F.size("words")
    inside = holding.select("doc_id", "windows", words.alias("words")).select(
        "doc_id",
        F.transform(
            "windows",
            lambda w: F.concat_ws(
                " ", F.slice("words", F.greatest(F.lit(0), F.least(w["start"], last - w["n_words"])) + 1, w["n_words"])
            ),
        ).alias("inside"),
    )
    return inside.select("doc_id", F.explode(F.array_distinct("inside")).alias("unit"))


def _dice(units: DataFrame, known: DataFrame, sizes: list[int], least: float) -> DataFrame:
    """doc_id, license, unit and dice of the units (doc_id, unit) that match."""
    low, high = least / (2 - least), (2 - least) / least
    # A word has a letter and a blank at least: shorter and longer texts than any
    # template allows go before their words are formed. Words have no upper length.
    units = units.where(F.length("unit") >= 2 * min(sizes, default=0) * low)
    words = _words("unit")
    units = units.select("doc_id", words.alias("words")).where(F.size("words") - 1 >= min(sizes, default=0) * low)
    # Repeated bigrams make the set smaller than the words, so only the set has an upper bound.
    units = units.select("doc_id", F.xxhash64(F.concat_ws(" ", "words")).alias("unit"), _bigrams(F.col("words")).alias("bigrams"))
    units = units.where(F.size("bigrams").between(min(sizes, default=0) * low, max(sizes, default=0) * high))
    grams = units.select("doc_id", "unit", F.size("bigrams").alias("n"), F.explode("bigrams").alias("bigram"))
    matched = grams.join(F.broadcast(known), "bigram").where(
        (F.col("n") >= F.col("size") * low) & (F.col("n") <= F.col("size") * high)
    )
    both = matched.groupBy("doc_id", "unit", "n", "license", "size").agg(F.countDistinct("bigram").alias("both"))
    dice = both.select("doc_id", "license", "unit", (2 * F.col("both") / (F.col("n") + F.col("size"))).alias("dice"))
    return dice.where(F.col("dice") >= least)
