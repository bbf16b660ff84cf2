"""License scans: MinHash bands over overlapping windows find templates, exact containment verifies.

A template of s five-word shingles is looked for in windows of twice its size class c (the power
of two at or above s) that start every c shingles, so an occurrence lies whole in some window.
Window and template then have a Jaccard similarity of at least LEAST / 4 at the least accepted
containment; with ``BANDS`` one-row bands both share a band with a probability of at least
1 - (1 - LEAST / 4) ** BANDS = 0.9992.

Before that, two exact sieves: a text is cut into shingles only if it has one of a few words of
which every template shingle has one, and a window is signed only if it has a template shingle.
Neither can lose a match, as a match shares at least one shingle.

All on DataFrame functions. Templates are few and bounded; they are the only thing broadcast.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 32
LEAST = 0.8

# Identifiers and the notices they stand for.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Licensed under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
            " documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2"),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
            " General Public License as published by the Free Software Foundation"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
            " that the following conditions are met"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
)

# Words of the notices that most English texts have.
COMMON = (
    "a", "an", "and", "any", "are", "as", "at", "by", "can", "do", "for", "form", "from", "in", "is", "it", "may", "met",
    "not", "of", "or", "that", "the", "this", "to", "under", "use", "with", "without", "you",
)


def _words(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def telling_words(templates: tuple[tuple[str, str], ...]) -> list[str]:
    """A small set of words such that every shingle of every template has one; long words first."""
    shingles = {tuple(w[i : i + SHINGLE]) for _, t in templates for w in [_words(t)] for i in range(max(1, len(w) - SHINGLE + 1))}
    found: list[str] = []
    plain = set(COMMON)
    while shingles:
        counts: dict[str, int] = {}
        for s in shingles:
            for w in set(s):
                counts[w] = counts.get(w, 0) + 1
        best = max(counts, key=lambda w: (w not in plain, counts[w] * len(w) ** 2, w))
        found.append(best)
        shingles = {s for s in shingles if best not in s}
    return found


def families(templates: tuple[tuple[str, str], ...]) -> list[int]:
    """Number of the first template of which each shares half of its shingles, directly or not."""
    own = [{tuple(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)} for w in (_words(t) for _, t in templates)]
    found = list(range(len(own)))
    for n, mine in enumerate(own):
        for m in range(n):
            if 2 * len(mine & own[m]) >= min(len(mine), len(own[m])) > 0:
                old, new = found[n], found[m]
                found = [new if f == old else f for f in found]
    return found


def _normal_words(text: Column) -> Column:
    bare = F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.split(bare, " ")


def _shingles(words: Column) -> Column:
    """Hashes of all five-word shingles; shorter texts have none."""
    return F.when(
        F.size(words) >= SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _held(df: DataFrame, name: str) -> DataFrame:
    """Have a column computed once: the optimizer would copy its expression into each use, lambdas included."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(name)).alias(name))


def _bands(shingles: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1), F.lit(BANDS)),
        lambda k: F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, k))),
    )


def _places() -> tuple[Column, Column]:
    """Positions of a template's shingles in a window (to be held as ``at``), and the places it has there: stretches as long as it, from one of its shingles to the last, with enough of it.

    If none has enough, as with words put in between, the whole stretch from its first shingle to its last.
    """
    width = F.size("own")
    at = F.filter(F.sequence(F.lit(0), F.size("window") - 1), lambda i: F.array_contains("own", F.get("window", i)))

    def stretch(first: Column) -> Column:
        held = F.filter("at", lambda i: (i >= first) & (i < first + width))
        kinds = F.size(F.array_distinct(F.transform(held, lambda i: F.get("window", i))))
        return F.struct((kinds / width).alias("strength"), (F.col("start") + first).alias("low"),
                        (F.col("start") + F.array_max(held)).alias("high"))

    whole = F.struct(F.col("containment").alias("strength"), (F.col("start") + F.array_min("at")).alias("low"),
                     (F.col("start") + F.array_max("at")).alias("high"))
    dense = F.filter(F.transform("at", stretch), lambda p: p["strength"] >= LEAST)
    return at, F.when(F.size(dense) > 0, dense).otherwise(F.array(whole))


def _each_license(verified: DataFrame) -> DataFrame:
    """doc_id, family, license, b (best containment and template), stands: whether some place has no better sibling.

    Places of a family that overlap, directly or not, form one group; in it the strongest are taken
    first, and one that overlaps a stronger one taken before is left out.
    """
    at, places = _places()
    found = _held(verified.withColumn("at", at), "at").withColumn("p", F.explode(places))
    best = F.max(F.struct("containment", (-F.col("template")).alias("n")))
    placed = found.select("*", "p.*").groupBy("doc_id", "family", "license", "strength", "low", "high").agg(best.alias("b"))
    in_order = Window.partitionBy("doc_id", "family").orderBy("low", "high", "license", "strength")
    reached = F.max("high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("low") <= reached, 0).otherwise(1)
    grouped = placed.withColumn("opens", opens).withColumn("island", F.sum("opens").over(in_order))
    members = F.sort_array(F.collect_list(F.struct("strength", "low", "high", "license", "b")), asc=False)
    met = grouped.groupBy("doc_id", "family", "island").agg(members.alias("met"))
    taken = F.aggregate("met", F.slice("met", 1, 0), lambda done, p: F.when(
        F.exists(done, lambda q: (q["strength"] > p["strength"]) & (q["low"] <= p["high"]) & (p["low"] <= q["high"])), done
    ).otherwise(F.concat(done, F.array(p))))
    judged = _held(met.withColumn("taken", taken), "taken").select("doc_id", "family", "taken", F.explode("met").alias("p"))
    return judged.groupBy("doc_id", "family", F.col("p.license").alias("license")).agg(
        F.max("p.b").alias("b"), F.bool_or(F.array_contains("taken", F.col("p"))).alias("stands")
    )


def template_table(spark: SparkSession, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """template, license, family, own (shingles), class_size: one row a template of five words or more."""
    rows = [(n, name, text, f) for n, ((name, text), f) in enumerate(zip(templates, families(templates)))]
    table = spark.createDataFrame(rows, "template int, license string, notice string, family int")
    table = table.withColumn("own", F.array_distinct(_shingles(_normal_words(F.col("notice"))))).where(F.size("own") > 0)
    size = F.pow(F.lit(2), F.ceil(F.log2(F.size("own").cast("double")) - 1e-9)).cast("int")
    return table.select("template", "license", "family", "own", size.alias("class_size"))


def scan_licenses(df: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, row_id: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """doc_id, license, containment, template: the best containment of each license in each document.

    Containment is the share of a template's shingles in one window, at least ``LEAST``. Null,
    blank and very short texts have none; of one family of
    notices each place of a document keeps the best only (all of them if tied); rows with equal ids are one document; an empty table
    gives no rows.
    """
    spark = df.sparkSession
    if not templates:
        return spark.createDataFrame([], "doc_id bigint, license string, containment double, template int")
    known = template_table(spark, templates)
    sizes = sorted(r[0] for r in known.select("class_size").distinct().collect())
    every = sorted({h for r in known.select("own").collect() for h in r[0]})
    all_shingles = F.split(F.lit(",".join(map(str, every))), ",").cast("array<bigint>")
    telling = F.array(*[F.lit(w) for w in telling_words(templates)])
    cut = _held(df.select(F.col(row_id).alias("doc_id"), _normal_words(F.col(text)).alias("words")), "words").where(
        F.arrays_overlap("words", telling)
    )
    hashed = _held(cut.select("doc_id", _shingles(F.col("words")).alias("all")), "all").where(
        F.arrays_overlap("all", all_shingles)
    )

    def windows(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.size("all") - 1, F.lit(size))
        cut_out = F.transform(starts, lambda s: F.struct(
            F.lit(size).alias("class_size"), s.alias("start"), F.slice(F.col("all"), s + 1, 2 * size).alias("window")
        ))
        return F.filter(cut_out, lambda w: F.arrays_overlap(w["window"], all_shingles))

    found = hashed.select("doc_id", F.explode(F.concat(*[windows(s) for s in sizes])).alias("w")).select("doc_id", "w.*")
    signed = found.select("*", F.posexplode(_bands(F.col("window"))).alias("band", "value"))
    signs = known.select("template", "license", "family", "own", F.col("class_size").alias("size"),
                         F.posexplode(_bands(F.col("own"))).alias("its_band", "its_value"))
    met = signed.join(
        F.broadcast(signs),
        (F.col("band") == F.col("its_band")) & (F.col("value") == F.col("its_value")) & (F.col("class_size") == F.col("size")),
    ).select("doc_id", "start", "window", "template", "license", "family", "own").distinct()
    share = F.size(F.array_intersect("window", "own")) / F.size("own")
    verified = met.withColumn("containment", share).where(F.col("containment") >= LEAST)
    # Notices that differ in a word or two, such as versions, all match one place: the best of a place stays.
    nearest = F.max("b.containment").over(Window.partitionBy("doc_id", "family"))
    each = _each_license(verified).withColumn("nearest", nearest)
    return each.where(F.col("stands") | (F.col("b.containment") == F.col("nearest"))).select(
        "doc_id", "license", F.col("b.containment").alias("containment"), (-F.col("b.n")).alias("template")
    )
