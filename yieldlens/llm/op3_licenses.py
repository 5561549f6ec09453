"""License scans by Dice coefficient over word bigrams (DataFrame functions only).

Units are the lines of a text and the whole text.  A unit is lower-cased (A-Z) and cut into words; its size is its number
of word bigrams.  Dice = 2 * shared different bigrams / (sum of both sizes) can reach the threshold t only for sizes from
k * t / (2 - t) to k * (2 - t) / t of a template of size k, so a unit's word count alone rules out most templates, and
bigrams are made only for units with a template left.  Everything happens in the document's row: no shuffle.

Templates are a parameter, (name, text) pairs; the defaults are common notices.

Cases: null and empty texts, and units of one word, match nothing; the best template of a unit counts, ties by name;
repeated rows are rated alike; a long text is one count of words; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .op5_quality import _let
from .op8_decontamination import WORDS, lowered
from .text import table

THRESHOLD = 0.8

# fixed values: common licence notices
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met:"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("MIT", "Released under the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files"),
    ("proprietary", "All rights reserved."),
)


def bigrams(text: str) -> list[str]:
    """Word bigrams of a template, in order, repeats kept."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def _bounds(size: int, threshold: float) -> tuple[int, int]:
    return math.ceil(size * threshold / (2 - threshold) - 1e-9), math.floor(size * (2 - threshold) / threshold + 1e-9)


def best_match(unit: Column, templates: Sequence[tuple[str, str]], threshold: float) -> Column:
    """(dice, name) of the best template of a lower-cased unit, or null."""
    rows = []
    for name, text in templates:
        pairs = bigrams(text)
        lo, hi = _bounds(len(pairs), threshold)
        rows.append(F.struct(F.lit(name).alias("name"), F.lit(len(pairs)).alias("k"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"),
                             F.array(*[F.lit(p) for p in sorted(set(pairs))]).alias("pairs")))
    all_ = F.array(*rows)

    def rated(left: Column) -> Column:
        def from_words(words: Column) -> Column:
            pairs = F.transform(F.slice(words, F.lit(1), F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
            return _let(pairs, lambda p: F.array_max(F.filter(F.transform(left, lambda t: F.struct(
                (2.0 * F.size(F.array_intersect(p, t["pairs"])) / (F.size(p) + t["k"])).alias("dice"), t["name"].alias("name"))),
                lambda m: m["dice"] >= threshold)))
        return _let(F.regexp_extract_all(unit, F.lit(WORDS), F.lit(0)), from_words)

    size = F.regexp_count(unit, F.lit(WORDS)) - 1
    left = _let(size, lambda n: F.filter(all_, lambda t: (n >= t["lo"]) & (n <= t["hi"]) & (n > 0)))
    return _let(left, lambda some: F.when(F.size(some) > 0, rated(some)))


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_lines (lines that match a template), licenses (their names and that of the whole text, sorted), best (highest
    Dice), whole (the whole text matches) for every document."""
    rows = docs.select("doc_id", lowered(F.coalesce(F.col("text"), F.lit(""))).alias("_text"))
    rows = rows.select("doc_id", "_text", F.array_compact(F.transform(
        F.split("_text", "\n"), lambda line: best_match(line, templates, threshold))).alias("_lines"))
    rows = rows.select("doc_id", "_lines", best_match(F.col("_text"), templates, threshold).alias("_whole"))
    found = F.concat(F.col("_lines"), F.array_compact(F.array("_whole")))
    return rows.select(
        "doc_id", F.size("_lines").cast("long").alias("n_lines"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["name"]))), ",").alias("licenses"),
        F.array_max(F.transform(found, lambda m: m["dice"])).alias("best"), F.col("_whole").isNotNull().alias("whole"))


def op3_licenses(spark, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def quoted(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    values = []
    for name, text in TEMPLATES:
        pairs = bigrams(text)
        lo, hi = _bounds(len(pairs), THRESHOLD)
        values.append(f"({quoted(name)}, {len(pairs)}, {lo}, {hi}, [{', '.join(quoted(p) for p in sorted(set(pairs)))}])")
    return rf"""
WITH t(name, k, lo, hi, pairs) AS (VALUES {', '.join(values)}),
d AS (SELECT row_number() OVER () AS r, doc_id,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
u AS (SELECT r, i, false AS whole, l AS x FROM (SELECT r, unnest(string_split(x, chr(10))) AS l,
        unnest(range(len(string_split(x, chr(10))))) AS i FROM d)
      UNION ALL SELECT r, -1, true, x FROM d),
w AS (SELECT r, i, whole, regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM u),
p AS (SELECT r, i, whole, len(ws) - 1 AS n, ws FROM w WHERE len(ws) > 1),
m AS (SELECT r, i, whole, name, 2.0 * len(list_intersect([ws[j] || ' ' || ws[j + 1] for j in range(1, len(ws))], pairs)) / (n + k) AS dice
      FROM p JOIN t ON n BETWEEN lo AND hi),
b AS (SELECT r, i, whole, max(struct_pack(dice := dice, name := name)) AS z FROM m WHERE dice >= {THRESHOLD} GROUP BY r, i, whole),
g AS (SELECT r, count(*) FILTER (NOT whole) AS n, bool_or(whole) AS whole, max(z.dice) AS best,
        array_to_string(list_sort(list_distinct(list(z.name))), ',') AS licenses FROM b GROUP BY r)
SELECT d.doc_id, CAST(coalesce(g.n, 0) AS BIGINT) AS n_lines, coalesce(g.licenses, '') AS licenses, g.best AS best,
       coalesce(g.whole, false) AS whole FROM d LEFT JOIN g ON d.r = g.r
"""


SQL = _sql()
