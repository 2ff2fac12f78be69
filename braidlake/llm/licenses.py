"""License scans: MinHash bands over overlapping windows retrieve templates, shingles confirm them.

Texts and templates become lower-case tokens (runs of a-z and 0-9). A window of ``window`` tokens is
sketched by the minima of its token pairs under ``bands`` permutations (the pair's hash XOR a constant),
one minimum to a band. Windows start every ``stride`` tokens, so that a stretch of
window - stride + 1 tokens lies whole in one of them. Against a template window with Jaccard
similarity j, a band collides with probability j and one of the bands with 1 - (1 - j) ^ bands:
99.99 % for j = 0.55, which two half-overlapping windows reach.

A collision only proposes. The template's distinct pairs must then be found to ``contained`` in the
tokens around the window (the template's length on both sides), which is exact.

Only windows that hold a pair of some template are sketched: no other window can share a minimum.

All of it is built-in functions. Documents are not shuffled: the template bands are broadcast, whose size
``templates`` bounds by raising an error, and only confirmed matches leave a task.

Results for odd input: NULL, empty and blank texts and texts without tokens match nothing; texts of any length are scanned
whole; a text shorter than a window is one window; repeated rows are scanned once (equal doc_id and
text); rows with a NULL doc_id are scanned too; a template of one token has that token as its only
shingle; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.llm.common import bind
from braidlake.llm.line_dedup import constants

MOST_BANDS = 200_000  # rows of the broadcast table

# Notices as projects print them.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        "and associated documentation files, to deal in the Software without restriction."
    ),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This library is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
}


@dataclass(frozen=True)
class Settings:
    window: int = 8
    stride: int = 4
    bands: int = 12
    contained: float = 0.92  # an Affero notice holds 0.91 of the plain GPL one


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def pairs(held: Column) -> Column:
    """Hashes of neighbouring tokens; of the token itself if there is but one."""
    two = F.transform(
        F.slice(held, 1, F.size(held) - 1), lambda t, i: F.xxhash64(t, F.get(held, i + 1))
    )
    one = F.transform(held, lambda t: F.xxhash64(t))
    return F.when(F.size(held) > 1, two).otherwise(one)


def starts(hashes: Column, s: Settings) -> Column:
    """First pair (from 1) of every window; the last window ends with the text."""
    last = F.greatest(F.lit(1), F.size(hashes) - (s.window - 2))
    return F.array_distinct(F.concat(F.sequence(F.lit(1), last, F.lit(s.stride)), F.array(last)))


def band_keys(hashes: Column, first: Column, s: Settings) -> Column:
    """Keys of the windows, band by band: windows of band 0, then those of band 1, and so on."""

    def of(c: int) -> Column:
        def least(i: Column) -> Column:
            return F.array_min(F.transform(F.slice(hashes, i, s.window - 1), lambda h: h.bitwiseXOR(F.lit(c))))

        return F.transform(first, least)

    return F.concat(*[of(c) for c in constants(s.bands)])


def sketched(text: Column, s: Settings, known: Column | None = None) -> Column:
    """Struct of the number of tokens, p (their pairs), first (window starts) and keys of a text.

    A window's minimum is that of a template only if the window holds the template's pair, so with
    ``known``, the pairs of all templates, windows without any of them are left out before they are sketched.
    """

    def parts(t: Column, p: Column, first: Column) -> Column:
        return F.struct(
            F.size(t).alias("length"), p.alias("p"), first.alias("first"), band_keys(p, first, s).alias("keys")
        )

    def worthwhile(p: Column) -> Column:
        if known is None:
            return starts(p, s)
        none = F.array().cast("array<int>")
        holding = lambda met: F.filter(starts(p, s), lambda i: F.arrays_overlap(F.slice(p, i, s.window - 1), met))
        return bind(F.array_intersect(p, known), lambda met: F.when(F.size(met) == 0, none).otherwise(holding(met)))

    return bind(
        tokens(text), lambda t: bind(pairs(t), lambda p: bind(worthwhile(p), lambda first: parts(t, p, first)))
    )


def templates(spark: SparkSession, texts: Mapping[str, str], s: Settings) -> tuple[DataFrame, DataFrame]:
    """(name, shingles, length) and (key, name) of the templates."""
    rows = spark.createDataFrame(sorted(texts.items()), "name string, text string")
    held = rows.select("name", sketched(F.col("text"), s).alias("w")).filter("w.length > 0")
    known = held.select("name", F.array_distinct("w.p").alias("shingles"), F.col("w.length").alias("length"))
    return known, held.select(F.explode("w.keys").alias("key"), "name").distinct()


def scan(docs: DataFrame, texts: Mapping[str, str] = NOTICES, s: Settings = Settings()) -> DataFrame:
    """(doc_id, license, containment, first_token) of every notice found, a row per document and license.

    ``containment`` is the best found, ``first_token`` the number of the first window with a match.
    """
    spark = docs.sparkSession
    known, keys = templates(spark, texts, s)
    bound = keys.count()
    if bound > MOST_BANDS:
        raise ValueError(f"{bound} template bands; at most {MOST_BANDS} are broadcast")
    table = F.broadcast(keys.join(known, "name"))
    every = known.agg(F.array_distinct(F.flatten(F.collect_list("shingles"))).alias("known"))
    text = F.col("text").cast("string")
    # As rows of a generator the sketch is computed once, however often its parts are read.
    scanned = docs.select(F.col("doc_id").cast("long"), text.alias("text")).join(F.broadcast(every)).select(
        "doc_id", F.xxhash64("text").alias("mark"), F.inline(F.array(sketched(F.col("text"), s, F.col("known"))))
    )
    hits = scanned.select("doc_id", "mark", "p", "first", F.posexplode("keys").alias("at", "key")).join(table, "key")
    place = F.get("first", F.expr("at % size(first)"))
    around = F.slice(
        F.col("p"), F.greatest(F.lit(1), place - F.col("length")), F.lit(s.window) + 2 * F.col("length")
    )
    part = F.size(F.array_intersect("shingles", around)) / F.size("shingles")
    return (
        hits.select("doc_id", "mark", "name", place.alias("first_token"), part.alias("containment"))
        .filter(F.col("containment") >= s.contained)
        .groupBy("doc_id", "mark", F.col("name").alias("license"))
        .agg(F.max("containment").alias("containment"), F.min("first_token").cast("long").alias("first_token"))
        .drop("mark")
    )
