"""Licence notices in texts: Dice coefficient of word bigrams with templates, pruned by size."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names and wording of common licence notices, from the licences' own instructions for use.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "MIT line": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software."),
    "BSD line": "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version."),
    "GPL-2.0 notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version."),
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _words(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def _bigrams(plain: Column) -> Column:
    words = F.split(plain, " ")
    return F.array_distinct(F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
                                       lambda a, b: F.xxhash64(a, b)))


def notices(docs: DataFrame, at_least: float = 0.8) -> DataFrame:
    """(doc_id, version, place, licence, dice): the most similar template of each line and of each whole text of several
    lines (place -1), where Dice over sets of word bigrams is `at_least` that.

    A unit is compared with templates whose size lets Dice reach the bound, 2 * smaller >= at_least * (sum of sizes),
    and of these only with those it shares a bigram with: units outside all sizes go by their number of words, before any
    bigram is made; bigrams meet the few hundred of the templates (a fixed, broadcast list) in one join, and their
    counts are merged before the shuffle. Ties: the licence first by name. `docs` has (doc_id, version, text).
    """
    spark = docs.sparkSession
    made = spark.createDataFrame(list(TEMPLATES.items()), "licence string, text string")
    made = made.select("licence", _bigrams(_words(F.col("text"))).alias("b"))
    made = made.select("licence", F.size("b").alias("of"), F.explode("b").alias("bigram"))
    counts = [len(t.split()) for t in TEMPLATES.values()]
    ratio = (2 - at_least) / at_least
    # Distinct bigrams are fewer than words, and normal words can be more than those between spaces: bounds with room.
    least = max(2, math.floor(min(counts) * 0.5 / ratio))
    units = docs.select("doc_id", "version", F.posexplode(F.split("text", "\n")).alias("place", "line")) \
        .unionByName(docs.where(F.instr("text", "\n") > 0).select("doc_id", "version", F.lit(-1).alias("place"), F.col("text").alias("line")))
    plain = units.select("doc_id", "version", "place", F.explode(F.array(_words(F.col("line")))).alias("plain"))
    wordy = plain.where(F.substring_index("plain", " ", least - 1) != F.col("plain"))
    sets = wordy.select("doc_id", "version", "place", F.explode(F.array(_bigrams(F.col("plain")))).alias("b"))
    largest = ratio * max(counts) * 2
    found = sets.where(F.size("b") <= math.ceil(largest)).select("doc_id", "version", "place", F.size("b").alias("n"), F.explode("b").alias("bigram"))
    shared = found.join(F.broadcast(made), "bigram").where(2 * F.least("n", "of") >= at_least * (F.col("n") + F.col("of")))
    dice = (2 * F.count("*")) / (F.first("n") + F.first("of"))
    each = shared.groupBy("doc_id", "version", "place", "licence").agg(dice.alias("dice")).where(F.col("dice") >= at_least)
    ranked = each.groupBy("doc_id", "version", "place").agg(F.max("dice").alias("dice"), F.min_by("licence", F.struct(-F.col("dice"), "licence")).alias("licence"))
    return ranked.select("doc_id", "version", "place", "licence", "dice")


def scanned(docs: DataFrame, at_least: float = 0.8) -> DataFrame:
    """A row for each row of `docs`: doc_id, n_notices, licences (distinct names in order, comma-joined), best_dice.

    Null and empty texts and texts without a notice: 0, an empty string, 0. Rows that repeat doc_id and text get
    equal results. Only doc_id and text play a part. No rows: no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("version"), "text")
    # One copy of repeated rows counts; their key holds what differs.
    found = notices(rows, at_least).groupBy("doc_id", "version").agg(
        F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("names"), F.max("dice").alias("dice"))
    found = found.withColumnsRenamed({"doc_id": "id", "version": "v"})
    both = rows.drop("text").join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("v")), "left")
    return both.select("doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_notices"),
                       F.coalesce("names", F.lit("")).alias("licences"), F.coalesce("dice", F.lit(0.0)).alias("best_dice"))
