"""License scans: MinHash bands over overlapping windows, then exact containment.

DataFrame operations only. Everything about the templates, which are a short
fixed list, becomes literals or a table of bounded size.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, text_or_empty

#: License statements by name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "you may not use this file except in compliance with the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-3.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("GPL-2.0-or-later", "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    ("AGPL-3.0-or-later", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("LGPL-3.0-or-later", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
)
#: Share of a template's shingles that a window must hold, and chance at most that a window which does is not retrieved.
CONTAINMENT, MISS = 0.8, 1e-6


def _words(text):
    """Lower-case runs of letters a-z and digits; anything else parts words."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _with_shingles(rows: DataFrame, text, name: str = "s") -> DataFrame:
    """Add the hashed pairs of neighbouring words of a text. The words are a column of their own, made once a row."""
    words = fresh(rows, 1)[0]
    pairs = F.zip_with(F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
    return rows.withColumn(words, _words(text)).withColumn(name, pairs).drop(words)


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """``template, license, shingles`` (distinct) of the templates that have a shingle."""
    made = spark.createDataFrame([(i, name, text) for i, (name, text) in enumerate(templates)], "template int, license string, text string")
    return _with_shingles(made, F.col("text")).select("template", "license", F.array_distinct("s").alias("shingles")).where(F.size("shingles") > 0)


def bands(least: int, window: int, miss: float = MISS) -> int:
    """Bands of one MinHash each that a window needs to be retrieved.

    ``least`` of a template's shingles lie in a window of ``window`` shingles,
    so the two sets are alike in least / window at the worst, and each band
    meets with this chance.
    """
    alike = min(0.999, least / window)
    return max(8, math.ceil(math.log(miss) / math.log(1 - alike)))


def _windows(kind: int, longest: int, mine: list[int]):
    """The windows of a class over ``s`` that hold a shingle of its templates, from ``hits``, the places of all known shingles."""
    window = 3 * longest
    own = F.filter("hits", lambda i: F.get("s", i).isin(mine))
    around = lambda i: F.sequence(F.greatest(F.lit(0), F.floor(i / longest).cast("int") - 2), F.floor(i / longest).cast("int"))

    def cut(k):
        start = k * longest + 1
        w = F.array_distinct(F.slice("s", start, F.lit(window)))
        # The surroundings: a statement that the window's edge cuts lies within them.
        wide = F.slice("s", F.greatest(F.lit(1), start - longest), F.lit(window + 2 * longest))
        return F.struct(F.lit(kind).alias("kind"), start.alias("position"), w.alias("w"), wide.alias("wide"), F.filter(w, lambda h: h.isin(mine)).alias("held"))

    return F.transform(F.array_distinct(F.flatten(F.transform(own, around))), cut)


def license_matches(docs: DataFrame, templates=TEMPLATES, containment: float = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text", resolve: bool = False) -> DataFrame:
    """``doc_id, template, license, position, containment, windows`` for each template a text holds.

    For templates of about the same length, windows of three times the longest
    template are laid over the shingles of a text, each beginning one third on,
    so that any place a template can stand lies within a window with room for
    words put in. Each window has as many one-value MinHash bands as the worst
    case asks for; a band that meets one of a template retrieves it, and the
    match counts if the window holds ``containment`` of the template's shingles
    exactly. ``position`` is the first shingle of the first such window,
    ``containment`` the best share and ``windows`` how many matched.

    A band meets a template's where the template's shingle of least hash is in the
    window and no other shingle of the window has a lesser hash. So the bands of
    a template are looked up by their least shingles, and of a window only those
    are worked out that can meet; windows without a shingle of a template are not even cut.
    All of a text is done where it lies; only matches move.

    With ``resolve`` a window does not match a template if all that it and its
    surroundings hold of it is part of another template of which they hold a
    greater share; ties stay.

    Null or empty text, or one without a shingle: no row. Rows of one id, and
    rows without an id, are matched each by its own text; rows equal in id and
    text count as one. Empty table or no templates: no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    known = template_table(spark, templates).collect()  # the short fixed list
    schema = "doc_id long, template int, license string, position int, containment double, windows long"
    if not known:
        return spark.createDataFrame([], schema)
    classes: dict[int, list] = {}
    for t in known:
        classes.setdefault(max(2, math.ceil(math.log2(len(t["shingles"])))), []).append(t)
    every = sorted({h for t in known for h in t["shingles"]})
    text = text_or_empty(text_col)
    rows = _with_shingles(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("row"), text.alias("text")), F.col("text")).select("doc_id", "row", "s")
    hits = F.filter(F.transform("s", lambda h, i: F.when(h.isin(every), i)), lambda i: i.isNotNull())
    rows = rows.select("doc_id", "row", "s", hits.alias("hits"))
    windows, bands_of = [], []
    for kind, some in classes.items():
        longest, shortest = (f(len(t["shingles"]) for t in some) for f in (max, min))
        windows.append(_windows(kind, longest, sorted({h for t in some for h in t["shingles"]})))
        bands_of += [(kind, t["template"], t["license"], list(t["shingles"]), bands(math.ceil(containment * shortest), 3 * longest + shortest)) for t in some]
    least = F.array_min(F.transform("t", lambda h: F.struct(F.xxhash64(h, F.col("band")).alias("hash"), h.alias("x"))))
    table = spark.createDataFrame(bands_of, "kind int, template int, license string, t array<long>, bands int").withColumn("band", F.explode(F.sequence(F.lit(1), F.col("bands"))))
    table = table.select("kind", "template", "license", "t", "band", least.alias("least")).select("kind", "template", "license", "t", "band", "least.x", "least.hash")
    cuts = rows.select("doc_id", "row", F.explode(F.concat(*windows)).alias("c")).select("doc_id", "row", "c.kind", "c.position", "c.w", "c.wide", F.explode("c.held").alias("x"))
    met = cuts.join(F.broadcast(table), ["kind", "x"]).where(F.forall("w", lambda h: F.xxhash64(h, F.col("band")) >= F.col("hash")))
    met = met.withColumn("share", F.size(F.array_intersect("w", "t")) / F.size("t")).where(F.col("share") >= containment)
    if resolve:
        others = F.array(*[F.array(*[F.lit(h) for h in t["shingles"]]) for t in known])
        held, share = F.array_intersect("wide", "t"), lambda t: F.size(F.array_intersect("wide", t)) / F.size(t)
        met = met.where(~F.exists(others, lambda o: (share(o) > share(F.col("t"))) & (F.size(F.array_except(held, o)) == 0)))
    right = met.groupBy("doc_id", "row", "template", "license", "position").agg(F.max("share").alias("share"))
    out = right.groupBy("doc_id", "row", "template", "license").agg(F.min("position").alias("position"), F.max("share").alias("containment"), F.count("*").alias("windows"))
    return out.select("doc_id", "template", "license", "position", "containment", "windows")
