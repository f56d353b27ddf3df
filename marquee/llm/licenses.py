"""License scans: TF-IDF cosine to templates, then inheritance along directories.

A unit of text, which is a whole file, a line, or as many neighbouring words of a
line as a template has, is a sparse vector of word counts times inverse document
frequencies, which come from all words of all files. A line with a unit close to
a template holds a statement of that licence, whatever else the line says. A file called LICENSE or the like, or one that is as a whole close to a
template, speaks for its directory; a file without a statement takes the licence
of its nearest ancestor directory that has one. Only DataFrame operations are
used.
"""

from __future__ import annotations

import math
from functools import reduce
from importlib import resources
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.decontaminate import text_words
from marquee.llm.shared import stored

# Statements of common licences; fixed values.
TEMPLATES = (
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "Apache-2.0", "MIT", "ISC", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause",
        "BSD-3-Clause", "MPL-1.1", "MPL-2.0", "CC0-1.0", "Unlicense")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("ISC", "Released under the ISC License"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-2.0", "Licensed under the GNU Library General Public License, version 2"),
    ("LGPL-2.1", "Licensed under the GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"),
    ("CC0-1.0", "Licensed under CC0 1.0"),
    *((f"CC-{kind}-{version}", f"Licensed under CC {kind} {version}")
      for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for version in ("2.0", "2.5", "3.0", "4.0")),
    ("proprietary", "Copyright, all rights reserved"),
)
# Words, beside numbers, that tell one licence from its neighbours: a match holds all of its template's ...
VARIANTS = frozenset("apache mit isc gpl lgpl agpl gnu lesser library affero mozilla mpl bsd cc cc0 by sa nc nd unlicense".split())
# ... and none of these that its template has not.
NARROWING = frozenset("lgpl agpl lesser library affero sa nc nd".split())
# Files of ``license_texts`` and the words of their titles and conditions that a copy must hold.
TEXTS = {
    "Apache-2.0": "apache license version 2 0 january 2004", "BSD-2-Clause": "redistributions binary disclaimer merchantability",
    "BSD-3-Clause": "redistributions binary disclaimer merchantability neither endorse", "CC0-1.0": "cc0 1 0 universal waiver",
    "GPL-1.0": "gnu general public license version 1 february 1989", "GPL-2.0": "gnu general public license version 2 june 1991",
    "GPL-3.0": "gnu general public license version 3 29 june 2007", "ISC": "permission fee granted disclaims merchantability",
    "LGPL-2.0": "gnu library general public license version 2 june 1991", "LGPL-2.1": "gnu lesser general public license version 2 1 february 1999",
    "LGPL-3.0": "gnu lesser general public license version 3 29 june 2007", "MIT": "permission hereby granted sublicense merchantability noninfringement",
    "MPL-1.1": "mozilla public license version 1 1", "MPL-2.0": "mozilla public license version 2 0",
}
FILE_NAMES = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.\-_][^/]*)?$"


def full_texts() -> list[tuple[str, str, str]]:
    """(license, text, words that a copy must hold) of the stored licence texts."""
    folder = resources.files("marquee.llm") / "license_texts"
    return [(name, (folder / f"{name}.txt").read_text(), held) for name, held in TEXTS.items()]


def _templates(spark, templates) -> list[tuple[str, list[str], list[str]]]:
    """(license, words, words that a match must hold) of the given templates."""
    if not templates:
        return []
    rows = spark.createDataFrame([(*x, None)[:3] for x in templates], "license string, text string, held string")
    rows = rows.select("license", text_words(F.col("text")).alias("words"), text_words(F.col("held")).alias("held"))
    return [(r["license"], r["words"], r["held"] or sorted({w for w in r["words"] if w in VARIANTS or w.isdigit()})) for r in rows.collect()]


def _weighed(found: list[tuple[str, list[str], list[str]]], idf: dict[str, float], least: float):
    """Rows (k, license, term, weight for a dot product, whether a match must hold it) and the terms of which a match holds at least one."""
    data, anchors = [], set()
    for k, (name, words, must) in enumerate(found):
        weight = {w: words.count(w) * idf[w] for w in words}
        norm = math.sqrt(sum(x * x for x in weight.values()))
        data += [(k, name, w, x / norm * idf[w], w in must) for w, x in weight.items()]
        light = 0.0
        for w, x in sorted(weight.items(), key=lambda y: (y[1], y[0])):
            light += (x / norm) ** 2
            if light >= least * least - 1e-9:  # terms lighter than this cannot reach the threshold together
                anchors.add(w)
    return data, sorted(anchors)


def _closest(units: DataFrame, template: DataFrame, seen: DataFrame, total: int, key: str, least: float) -> DataFrame:
    """``key`` and best (minus similarity, license) over the units (``key``, words) that are close to a template.

    A unit counts only if it holds the words that the template asks for and no narrowing word that the template lacks.
    """
    counts = units.select(key, F.explode("words").alias("term")).groupBy(key, "term").agg(F.count("*").alias("n"))
    idf = F.log(F.lit(float(total + 1)) / (F.coalesce("files", F.lit(0)) + 1)) + 1
    weighed = counts.join(seen, "term", "left").withColumn("x", F.col("n") * idf)
    norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    needs = template.groupBy("k").agg(F.count_if("must").alias("needed"))
    narrow = F.col("term").isin(sorted(NARROWING))
    narrowed = counts.filter(narrow).groupBy(key).agg(F.count("*").alias("narrowed"))
    dots = counts.join(template, "term").groupBy(key, "k", "license").agg(
        F.sum(F.col("n") * F.col("w")).alias("dot"), F.count_if("must").alias("held"), F.count_if(narrow).alias("own"))
    dots = dots.join(F.broadcast(needs), "k").filter("held = needed").join(narrowed, key, "left").filter("coalesce(narrowed, 0) = own")
    close = dots.join(norms, key).withColumn("similarity", F.round(F.col("dot") / F.col("norm"), 6)).filter(F.col("similarity") >= least)
    return close.groupBy(key).agg(F.min(F.struct((-F.col("similarity")).alias("s"), "license")).alias("best"))


def _line_units(lines: DataFrame, anchor: Column, sizes: list[int]) -> DataFrame:
    """(line, unit) of distinct ``lines`` (line, words): each line, and its runs of as many words as a template has, with an anchor in them.

    A run is cut out around each anchor, so a long line gives no more than its anchors do.
    """
    widest = sizes[-1]
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(anchor, F.col("words")[i]))
    around = F.transform(places, lambda i: F.struct(
        F.slice("words", F.greatest(i - widest + 2, F.lit(1)), F.least(i + widest, F.size("words")) - F.greatest(i - widest + 1, F.lit(0))).alias("near"),
        F.least(i, F.lit(widest - 1)).alias("at")))
    near = lines.select("line", F.explode(around).alias("x")).select("line", "x.*").distinct()

    def runs(size: int) -> Column:
        last = F.greatest(F.size("near") - size, F.lit(0))
        first = F.least(F.greatest(F.col("at") - size + 1, F.lit(0)), last)
        return F.transform(F.sequence(first, F.least("at", last)), lambda i: F.array_join(F.slice("near", i + 1, size), " "))

    found = near.select("line", F.explode(F.array_distinct(F.concat(*map(runs, sizes)))).alias("unit"))
    return found.unionByName(lines.select("line", F.array_join("words", " ").alias("unit"))).distinct()


def directory(path: Column) -> Column:
    """The part before the last slash; the empty root without one."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def inherited(paths: DataFrame, speaking: DataFrame) -> DataFrame:
    """(dir, best, distance): the nearest directory at or above that of each path for which ``speaking`` (dir, best) has a licence."""
    parts = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - i), "/").alias("above"), i.alias("distance")))
    steps = paths.select(directory(F.col("path")).alias("dir")).distinct().select("dir", F.explode(above).alias("x")).select("dir", "x.*")
    met = steps.join(speaking.withColumnRenamed("dir", "above"), "above")
    return met.groupBy("dir").agg(F.min(F.struct("distance", "best")).alias("m")).select("dir", "m.best", "m.distance")


def scan_licenses(files: DataFrame, templates=TEMPLATES, least: float = 0.7, path_col: str = "path", text_col: str = "text",
                  keep: tuple[str, ...] = (), texts=None) -> DataFrame:
    """``keep``, ``path_col``, license, similarity, via and distance per row.

    ``via`` is 'file' for a licence file, 'header' for another file with a
    statement, 'inherited' for a file that takes the licence of a directory
    ``distance`` levels up (0: its own); all are null if there is none. The closest template wins, ties
    the smaller name, also among the licence files of a directory. Rows that
    repeat a path share what is found in any of them. A null or empty text has no
    statement but may inherit; nothing is found for a null path. Other columns
    are ignored; an empty table gives no rows, and without templates nothing is found.
    ``templates`` are (license, statement), ``texts`` (license, whole text, words that a copy must hold), by default ``full_texts``.
    """
    spark = files.sparkSession
    texts = full_texts() if texts is None else texts
    rows = files.select(F.col(path_col).alias("path"), F.col(text_col).alias("text")).filter("path is not null")
    found, full = _templates(spark, templates), _templates(spark, texts)
    # a table of all words, of which only those of the given templates are collected
    held = rows.select(F.explode(F.array_distinct(text_words(F.col("text")))).alias("term"))
    seen = stored(held.groupBy("term").agg(F.count("*").alias("files")))
    total = rows.count()
    terms = sorted({w for _, words, _ in found + full for w in words})
    known = {r["term"]: r["files"] for r in seen.filter(F.col("term").isin(terms)).collect()}
    idf = {w: math.log((total + 1) / (known.get(w, 0) + 1)) + 1 for w in terms}
    data, anchors = _weighed(found, idf, least)
    # the words of the given templates only
    schema = "k int, license string, term string, w double, must boolean"
    template = F.broadcast(spark.createDataFrame(data, schema))
    text_template = F.broadcast(spark.createDataFrame(_weighed(full, idf, least)[0], schema))
    anchor = F.array(*map(F.lit, anchors)).cast("array<string>")

    # the words are cut once per file; a copy of a full text holds all that it must
    asked = F.array(*map(F.lit, sorted({*anchors, *(w for _, _, must in full for w in must)}))).cast("array<string>")
    copy = lambda held: reduce(or_, (
        F.size(F.array_intersect(held, F.array(*map(F.lit, must)))) == len(set(must)) for _, _, must in full), F.lit(False))
    near = stored(rows.filter(F.exists(
        F.array(F.array_intersect(text_words(F.col("text")), asked)), lambda held: F.arrays_overlap(held, anchor) | copy(held))))
    # a line that many files hold is cut into runs once, and a unit that many lines hold is measured once
    lines = near.select("path", F.explode(F.split("text", "\n")).alias("line"))
    lines = stored(lines.filter(F.arrays_overlap(text_words(F.col("line")), anchor)).distinct())
    cut = lines.select("line").distinct().withColumn("words", text_words(F.col("line")))
    units = stored(_line_units(cut, anchor, sorted({len(words) for _, words, _ in found if words} or {1})))
    measured = _closest(units.select("unit").distinct().withColumn("words", F.split("unit", " ")), template, seen, total, "unit", least)
    by_line = stored(units.join(measured, "unit").groupBy("line").agg(F.min("best").alias("best")))
    header = lines.join(by_line, "line").groupBy("path").agg(F.min("best").alias("best"))
    whole = _closest(near.select("path", text_words(F.col("text")).alias("words")), template, seen, total, "path", least)
    if full:
        copies = near.select("path", text_words(F.col("text")).alias("words")).filter(copy(F.col("words")))
        copied = _closest(copies, text_template, seen, total, "path", least)
        whole = whole.unionByName(copied).groupBy("path").agg(F.min("best").alias("best"))
    own = stored(header.withColumnRenamed("best", "header").join(whole.withColumnRenamed("best", "whole"), "path", "full").select(
        "path", F.coalesce("whole", "header").alias("best"),
        F.when(F.col("whole").isNotNull() | F.col("path").rlike(FILE_NAMES), "file").otherwise("header").alias("via")))
    speaking = own.filter("via = 'file'").groupBy(directory(F.col("path")).alias("dir")).agg(F.min("best").alias("best"))
    above = stored(inherited(rows, speaking)).select("dir", F.col("best").alias("above"), "distance")

    every = files.select(*keep, F.col(path_col).alias("path")).withColumn("dir", directory(F.col("path")))
    joined = every.join(own, "path", "left").join(above, "dir", "left").withColumn("chosen", F.coalesce("best", "above"))
    return joined.select(
        *keep, F.col("path").alias(path_col), F.col("chosen.license").alias("license"), (-F.col("chosen.s")).alias("similarity"),
        F.coalesce("via", F.when(F.col("above").isNotNull(), "inherited")).alias("via"),
        F.when(F.col("via").isNull(), F.col("distance")).alias("distance"))
