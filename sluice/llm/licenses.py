"""License notices in texts: MinHash bands over overlapping windows, confirmed on the shingles.

Only DataFrame functions are used. A text becomes a list of lower-case words and its shingles three
words each. For every length of a template there are windows of that length plus a step, a step
apart, so one of them holds the whole of any notice. Windows meet templates in bands of minimum
hashes; a match must hold the wanted share of the template's shingles, and all of those that tell its
name and version. Of the matches whose name stands at the same place of a text, the license with the largest share stays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Short notices and the headers that the licenses themselves give for use in files.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("GPL-3.0", "under the terms of the GNU General Public License version 3 as published by the Free Software Foundation"),
    ("GPL-2.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.0-or-later", "under the terms of the GNU Library General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1-or-later", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0-or-later", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0-or-later", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
)

# Shingles that tell a license from its siblings: a template that has one is found only where that one stands. Names, then versions.
NAMES = (
    "gnu general public", "gnu lesser general", "gnu library general", "gnu affero general", "the mit license", "the apache license", "mozilla public license", "cc by nc",
    "creative commons attribution", "commons attribution sharealike", "commons attribution noderivatives", "commons attribution noncommercial",
)
MARKS = NAMES + (
    "license version 2", "license version 3", "either version 2", "either version 3", "version 2 of", "version 2 1", "version 2 0", "v 2 0", "nc 4 0",
    "attribution 4 0", "sharealike 4 0", "noderivatives 4 0", "noncommercial 4 0", "attribution noncommercial sharealike", "attribution noncommercial noderivatives",
)

SHINGLE = 3
LEAST = 0.8
# A window that holds LEAST of a template and a step more has a similarity of at least 0.8 / (1 + 1/8 + 0.2) = 0.6, so all
# bands miss it with a chance below (1 - 0.6 ** 2) ** 24 = 3e-5.
BANDS, ROWS, STEPS = 24, 2, 8
# Windows of one notice that reach LEAST lie within so many thousandths of its length of the one that holds it whole, and are found with it.
CUT = round(1000 * (1 - LEAST + 1 / STEPS)) + 1


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it occurs inside of functions."""
    return F.get(F.transform(F.array(value), use), 0)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words_: Column) -> Column:
    """Runs of three words in order; fewer words are one shingle."""

    def cut(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))
        return F.when(F.size(w) > 0, many).otherwise(F.array().cast("array<string>"))

    return let(words_, cut)


def hashed(words_: Column) -> Column:
    """The hashes of the shingles, without building their strings."""

    def cut(w: Column) -> Column:
        n = F.greatest(F.size(w) - SHINGLE + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(*[F.get(w, i + (j - 1)) for j in range(SHINGLE)]))

    return let(words_, cut)


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def bands(items: Column) -> Column:
    """A key per band of minimum hashes."""

    def minima(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.lit(BANDS * ROWS)), lambda k: F.array_min(F.transform(own, lambda h: F.xxhash64(h, k))))

    def keys(least: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, *[F.get(least, b * ROWS + r) for r in range(ROWS)]))

    return let(let(items, minima), keys)


def scan(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates: Sequence[tuple[str, str]] = TEMPLATES, least: float = LEAST
) -> DataFrame:
    """``doc_id, license, n_windows, first_word, containment`` for every document and license found in it.

    ``containment`` is the largest share of a template's shingles in one window, ``first_word``
    (from 0) the begin of the first window that reaches ``least``. Null and empty texts
    have no row. The shingles in ``MARKS`` that a template has must all stand in the window or one around it. Matches whose name stands at the
    same place of a text compete: the license with the largest share around the name stays, at a tie the one with the
    longer template. Rows that share an id are reported together, also those with a null id. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame([(n, name, t) for n, (name, t) in enumerate(templates)], "template int, license string, notice string")
    known = known.withColumn("w", words(F.col("notice"))).withColumn("parts", F.array_distinct(shingles(F.col("w")))).withColumn("length", F.size("w"))
    known = known.withColumn("marks", F.array_intersect("parts", strings(MARKS))).withColumn("name", F.get(F.array_intersect("parts", strings(NAMES)), 0))
    # The catalogue is a constant of the program: a dozen rows reach the driver.
    rows = known.select("length", hashed(F.col("w")).alias("h")).collect()
    of_length: dict[int, set[int]] = {}
    for r in rows:
        of_length.setdefault(r["length"], set()).update(r["h"])
    all_hashes = F.array(*[F.lit(h) for h in sorted(set().union(*of_length.values()))]) if of_length else F.array().cast("array<bigint>")

    # A text without any shingle of a template holds none, so its windows are not hashed.
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.where(F.arrays_overlap(hashed(words(F.col("text"))), all_hashes)).select("doc_id", words(F.col("text")).alias("w"))
    texts = texts.withColumn("row", F.xxhash64("w"))
    classes = F.array(
        *[
            F.struct(F.lit(n + max(1, n // STEPS) - 1).alias("size"), F.lit(max(1, n // STEPS)).alias("step"), F.lit(n).alias("length"))
            for n in sorted(of_length)
        ]
    )
    texts = texts.withColumn("c", F.explode(classes))
    size, step = F.col("c.size"), F.col("c.step")

    def near(w: Column) -> Column:
        """The windows that hold a shingle of a template, chosen on the hashes before any is cut out."""
        starts = let(
            hashed(w),
            lambda h: F.filter(
                F.sequence(F.lit(0), F.size(w) - 1, step),
                lambda i: F.arrays_overlap(F.slice(h, i + 1, F.greatest(size - SHINGLE + 1, F.lit(1))), all_hashes),
            ),
        )
        return F.transform(starts, lambda i: F.struct(i.alias("first"), F.slice(w, i + 1, size).alias("w")))

    windows = texts.select("doc_id", "row", F.col("c.length").alias("length"), F.explode(let(F.col("w"), near)).alias("at"))
    windows = windows.select("doc_id", "row", "length", "at.first", "at.w").withColumn("h", F.array_distinct(hashed(F.col("w"))))
    placed = windows.withColumn("key", F.explode(bands(F.col("h"))))
    index = known.select("template", "license", "parts", "marks", "name", "length", F.explode(bands(F.array_distinct(hashed(F.col("w"))))).alias("key"))
    met = placed.join(F.broadcast(index), ["length", "key"]).dropDuplicates(["doc_id", "row", "length", "first", "template", "w"])
    own, part = F.col("own"), Window.partitionBy("doc_id", "row", "template").orderBy((1000 * F.col("first") / F.col("length")).cast("long")).rangeBetween(-CUT, CUT)
    found = met.withColumn("own", shingles(F.col("w"))).withColumn("containment", F.size(F.array_intersect(own, F.col("parts"))) / F.size("parts"))
    found = found.where(F.col("containment") >= least).withColumn("sure", F.size(F.array_except("marks", own)) == 0)
    # A template without a name has no sibling and competes with itself only.
    at = F.array_position(own, F.col("name"))
    begin = at - F.array_position("parts", F.col("name")) + 1 - SHINGLE
    aligned = F.slice(own, F.greatest(begin, F.lit(1)).cast("int"), F.size("parts") + 2 * SHINGLE)
    share = F.when(F.col("sure") & F.coalesce(at > 0, F.lit(False)), F.size(F.array_intersect(aligned, F.col("parts"))) / F.size("parts"))
    found = found.withColumn("place", F.coalesce((F.col("first") + at).cast("string"), F.col("license"))).withColumn("share", share)
    best = F.max(F.struct(F.coalesce("share", F.lit(0.0)), F.size("parts"), "license")).over(Window.partitionBy("doc_id", "row", "place"))
    won = F.col("sure") & (F.col("name").isNull() | (F.col("license") == F.col("best.license")))
    return (
        found.withColumn("best", best)
        .withColumn("won", F.max(won).over(part))
        .where("won")
        .groupBy("doc_id", "license")
        .agg(
            F.count("*").alias("n_windows"),
            F.min("first").cast("long").alias("first_word"),
            F.max("containment").alias("containment"),
        )
    )
