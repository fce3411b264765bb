"""License scans: MinHash bands over overlapping windows, then exact containment, all native.

A text's windows are as long as twice the templates of a size class and overlap by half, so a notice
always lies whole in one of them. Bands of one coordinate retrieve the templates that may lie in a
window: a notice of which three quarters are there shares at least ``MIN_SIMILARITY`` of the union with
its window and is missed by all ``BANDS`` coordinates with a chance under 1 in 100,000. The exact share
of the template's shingles inside the window then decides.

A coordinate's least value can only agree where the window holds a shingle of the template, so texts
without any such shingle leave in the first pass. Everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import stored

SHINGLE = 5
BANDS = 64
MIN_CONTAINMENT = 0.75
# Three quarters of a template just over half the class size, in a window of four times its size.
MIN_SIMILARITY = 0.75 / 4.25
MAX_TEMPLATE_SHINGLES = 100_000
SEPARATORS = "[^a-z0-9]+"

# Notices and opening passages of well-known licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "LGPL-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation"
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain",
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted"
    ),
}


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def shingles(of: Column) -> Column:
    """Hashes of all runs of five words, in order; none for shorter texts."""
    runs = F.transform(
        F.sequence(F.lit(1), F.size(of) - SHINGLE + 1),
        lambda at: F.xxhash64(F.array_join(F.slice(of, at, SHINGLE), " ")),
    )
    return F.when(F.size(of) >= SHINGLE, runs).otherwise(F.array().cast("array<bigint>"))


def shingles_of_text(text: Column) -> Column:
    """A generator of one row: the shingles of a text, whose words are split once, not once a shingle."""
    return F.explode(F.transform(F.array(words(text)), shingles))


def coordinates(of: Column) -> Column:
    """The least value of each of the hash functions on a set of shingles."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.array_min(F.transform(of, lambda h: F.xxhash64(h, k)))
    )


def template_rows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """license_id, distinct shingles, their number, and the half window of the template's size class."""
    given = spark.createDataFrame(sorted(templates.items()), "license_id string, text string")
    split = given.select("license_id", shingles_of_text(F.col("text")).alias("shingles"))
    made = split.select("license_id", F.array_distinct("shingles").alias("set"))
    total = F.size("set")
    half = F.pow(F.lit(2), F.ceil(F.log2(total))).cast("int")
    return made.where(total > 0).select("license_id", "set", total.alias("total"), half.alias("half"))


def find_licenses(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """One row per document and license found in it: doc_id, license_id, matched, total, containment, first_word.

    matched counts the distinct shingles of the template in the best window, first_word is where the
    first of its shingles starts in any window that matches. Null and short texts, and rows without an id, give nothing; rows
    that repeat a doc_id count together. Templates under five words are never found.
    """
    known = template_rows(spark, templates or TEMPLATES)
    limit = known.agg(F.sum("total")).first()[0] or 0
    if limit > MAX_TEMPLATE_SHINGLES:
        raise ValueError(f"the templates have {limit} shingles, more than {MAX_TEMPLATE_SHINGLES}")
    every = [row["h"] for row in known.select(F.explode("set").alias("h")).distinct().collect()]
    halves = [row["half"] for row in known.select("half").distinct().collect()]
    if not every:
        return spark.createDataFrame([], "doc_id bigint, license_id string, matched int, total int, containment double, first_word int")

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = rows.where("doc_id IS NOT NULL").select("doc_id", shingles_of_text(F.col("text")).alias("shingles"))
    wanted = F.array(*[F.lit(h) for h in every])
    kept = stored(
        spark,
        hashed.where(F.arrays_overlap("shingles", wanted)).withColumn("row", F.monotonically_increasing_id()),
        "license-texts",
    )
    # Windows that hold a template's shingle, per size class; window n starts at n times the half.
    places = kept.select("row", F.posexplode("shingles").alias("at", "shingle")).where(F.col("shingle").isin(every))
    sides = F.explode(F.array(*[F.lit(h) for h in halves])).alias("half")
    first = F.floor(F.col("at") / F.col("half"))
    spread = places.select("row", "at", "shingle", sides).withColumn(
        "window", F.explode(F.when(first > 0, F.array(first - 1, first)).otherwise(F.array(first)))
    )
    windows = spread.select("row", "half", "window").distinct()
    start = (F.col("window") * F.col("half") + 1).cast("int")
    signed = windows.join(kept.select("row", "shingles"), "row").select(
        "row", "half", "window", F.posexplode(coordinates(F.slice("shingles", start, 2 * F.col("half")))).alias("band", "least")
    )
    bands = known.select("license_id", "half", F.posexplode(coordinates(F.col("set"))).alias("band", "least"))
    retrieved = signed.join(F.broadcast(bands), ["half", "band", "least"]).select("row", "half", "window", "license_id").distinct()
    # Exact containment of the template's shingles in each window that was retrieved.
    parts = known.select("license_id", "total", F.explode("set").alias("shingle"))
    held = (
        retrieved.join(spread, ["row", "half", "window"])
        .join(F.broadcast(parts), ["license_id", "shingle"])
        .groupBy("row", "license_id", "half", "window")
        .agg(
            F.countDistinct("shingle").cast("int").alias("matched"),
            F.first("total").alias("total"),
            F.min("at").alias("first_word"),
        )
        .where(F.col("matched") >= MIN_CONTAINMENT * F.col("total"))
    )
    return (
        held.join(kept.select("row", "doc_id"), "row")
        .groupBy("doc_id", "license_id")
        .agg(F.max("matched").alias("matched"), F.first("total").alias("total"), F.min("first_word").alias("first_word"))
        .withColumn("containment", F.col("matched") / F.col("total"))
    )


def oracle_sql(templates: dict[str, str] | None = None) -> str:
    """The same by exact containment in every window, without bands."""
    values = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in (templates or TEMPLATES).items()
    )
    split = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: w <> '')"
    run = f"array_to_string(list_slice(words, i, i + {SHINGLE - 1}), ' ')"
    return f"""
WITH given(license_id, text) AS (VALUES {values}),
template_words AS (SELECT license_id, {split} AS words FROM given),
template_shingles AS (
  SELECT DISTINCT license_id, {run} AS shingle
  FROM (SELECT license_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM template_words)
),
template_sizes AS (
  SELECT license_id, count(*) AS total, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS half
  FROM template_shingles GROUP BY license_id
),
doc_words AS (SELECT doc_id, {split} AS words FROM documents WHERE doc_id IS NOT NULL),
doc_shingles AS (
  SELECT doc_id, i - 1 AS pos, {run} AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {SHINGLE - 2})) AS i FROM doc_words)
),
hits AS (
  SELECT doc_id, license_id, total, half, pos, shingle
  FROM doc_shingles JOIN template_shingles USING (shingle) JOIN template_sizes USING (license_id)
),
placed AS (
  SELECT *, pos // half AS win FROM hits
  UNION ALL SELECT *, pos // half - 1 AS win FROM hits WHERE pos // half > 0
),
held AS (
  SELECT doc_id, license_id, win, count(DISTINCT shingle) AS matched, any_value(total) AS total, min(pos) AS first_word
  FROM placed GROUP BY doc_id, license_id, win
)
SELECT doc_id, license_id, CAST(max(matched) AS INTEGER) AS matched, CAST(any_value(total) AS INTEGER) AS total,
  max(matched) / any_value(total) AS containment, CAST(min(first_word) AS INTEGER) AS first_word
FROM held WHERE matched >= {MIN_CONTAINMENT} * total GROUP BY doc_id, license_id
"""
