"""Licence scans: passages compared to licence templates by the Dice coefficient of their word bigrams.

A passage is a line of a document, the whole document, or a window of its words across line breaks, with the
words of `common.words`. Sizes prune first: for the coefficient to reach `dice`, a passage must have between b * dice / (2 - dice) and
b * (2 - dice) / dice bigrams, for b bigrams of the template, so most passages are dropped by their length
and most others meet few templates. What is left is joined to the templates' bigrams, a small table of
checked size, and shared bigrams are counted. A line keeps its best template, the first by name of equals.

A window begins and ends with a bigram of its template and is no longer than the template's upper bound. Of
windows that overlap, the best stays (of equals the first by name, then by place). It is a finding of the line
in which it begins, unless a line that it touches, or the whole text, has its licence already. Windows are
found within a row: bigrams of any template are picked by a hash set, and only starts with enough of them in
reach are looked at.

Defined cases: NULL texts and lines of less than two words have no finding; repeated bigrams count once;
equal rows give equal rows; an empty table or no template gives no finding. Input columns are carried; those
named as a result are replaced.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowmill.llm.common import WORD_GAP, row_key, with_columns, words
from rowmill.plans.storage import materialise

DICE = 0.75
BROADCAST_BYTES = 16_000_000

# Usual notices that refer to a licence, and its identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright to this work (CC0 1.0)."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "Copyright. All rights reserved."),
)


def bigrams(ws: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    pairs = F.zip_with(ws, F.slice(ws, 2, F.size(ws)), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.array_distinct(F.filter(pairs, lambda p: p.isNotNull()))


def template_bigrams(text: str) -> list[str]:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    ws = [w for w in re.split(WORD_GAP, lower) if w]
    return sorted({f"{a} {b}" for a, b in zip(ws, ws[1:])})


def bounds(size: int, dice: float) -> tuple[int, int]:
    """The smallest and largest number of bigrams that can reach the coefficient with size ones."""
    return math.ceil(size * dice / (2 - dice) - 1e-9), math.floor(size * (2 - dice) / dice + 1e-9)


def once(value: Column, name: str) -> Column:
    """A column that is computed once: filters on it stay above this explosion of one value."""
    return F.explode(F.array(value)).alias(name)


def best_windows(candidates: Column) -> Column:
    """The best of windows that overlap; candidates: (order, licence, begin, end, dice), ends inclusive."""
    none = F.slice(candidates, 1, 0)
    meets = lambda taken, w: F.exists(
        taken, lambda t: (t["begin"] <= w["end"]) & (w["begin"] <= t["end"])
    )
    return F.aggregate(
        F.array_sort(candidates), none, lambda taken, w: F.when(meets(taken, w), taken).otherwise(F.concat(taken, F.array(w)))
    )


def windows(docs: DataFrame, doc_id: str, text: str, templates: tuple[tuple[str, str], ...], dice: float) -> DataFrame:
    """_k1, _k2 and windows (line, last, licence, dice) of the rows that have any."""
    known = [(name, own, *bounds(len(own), dice)) for name, own in ((n, template_bigrams(b)) for n, b in templates) if own]
    picked = sorted({g for _, own, _, _ in known for g in own})
    ws = F.col("_w")
    pairs = F.zip_with(ws, F.slice(ws, 2, F.size(ws)), lambda a, b: F.concat(a, F.lit(" "), b))
    within = lambda grams: lambda h: h["gram"].isin(grams)
    hits = F.filter(F.transform(pairs, lambda g, i: F.struct(i.alias("at"), g.alias("gram"))), within(picked))
    rows = docs.select(*row_key(doc_id, text), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = rows.select("*", once(words(F.col("_t")), "_w")).select("*", once(hits, "_h"))
    rows = rows.where(F.size("_h") >= min(low for _, _, low, _ in known))

    met = F.array(
        *[
            F.struct(
                F.lit(name).alias("licence"), F.lit(len(own)).alias("size"), F.lit(low).alias("low"),
                F.lit(high).alias("high"), F.filter("_h", within(own)).alias("own"),
            )
            for name, own, low, high in known
        ]
    )

    def scored(t: Column, begin: Column, reach: Column) -> Column:
        """Windows of template t from a bigram to each one in reach."""

        def window(end: Column) -> Column:
            both = F.size(F.array_distinct(F.transform(F.filter(reach, lambda h: h["at"] <= end["at"]), lambda h: h["gram"])))
            n = F.size(bigrams(F.slice(ws, begin["at"] + 1, end["at"] - begin["at"] + 2)))
            value = 2.0 * both / (n + t["size"])
            return F.struct(
                (-value).alias("order"), t["licence"].alias("licence"), begin["at"].alias("begin"),
                end["at"].alias("end"), value.alias("dice"),
            )

        return F.filter(F.transform(reach, window), lambda w: w["dice"] >= dice)

    def of_template(t: Column) -> Column:
        def from_start(begin: Column, i: Column) -> Column:
            reach = F.filter(F.slice(t["own"], i + 1, t["high"]), lambda h: h["at"] < begin["at"] + t["high"])
            # Bound to a name, so that it is made once.
            return F.flatten(F.transform(F.array(reach), lambda r: scored(t, begin, r)))

        # The hit that makes a window large enough must be in reach; NULL where there is none.
        far = lambda begin, i: F.get(t["own"], i + t["low"] - 1)["at"] < begin["at"] + t["high"]
        none = F.array().cast("array<struct<order:double,licence:string,begin:int,end:int,dice:double>>")
        return F.flatten(F.transform(t["own"], lambda b, i: F.when(far(b, i), from_start(b, i)).otherwise(none)))

    enough = F.filter(met, lambda t: F.size(t["own"]) >= t["low"])
    rows = rows.select("_k1", "_k2", "_t", "_w", once(enough, "_m")).where(F.size("_m") > 0)
    rows = rows.select("_k1", "_k2", "_t", once(F.flatten(F.transform("_m", of_template)), "_c")).where(F.size("_c") > 0)
    rows = rows.groupBy("_k1", "_k2").agg(F.first("_t").alias("_t"), F.first("_c").alias("_c"))
    sizes = F.transform(F.split("_t", "\n", -1), lambda line: F.size(words(line)))
    rows = rows.select("_k1", "_k2", best_windows(F.col("_c")).alias("_c"), sizes.alias("_n"))

    def line_of(word: Column) -> Column:
        def step(state: Column, n: Column) -> Column:
            at = state["at"] + n
            return F.struct(at.alias("at"), (state["line"] + (at <= word).cast("int")).alias("line"))

        return F.aggregate("_n", F.struct(F.lit(0).alias("at"), F.lit(0).alias("line")), step)["line"]

    placed = F.transform(
        "_c",
        lambda w: F.struct(
            line_of(w["begin"]).alias("line"), line_of(w["end"] + 1).alias("last"),
            w["licence"].alias("licence"), w["dice"].alias("dice"),
        ),
    )
    return rows.select("_k1", "_k2", placed.alias("windows"))


def find_licences(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES, dice: float = DICE,
) -> DataFrame:
    """docs with findings: (line, licence, dice) by line; -1 is the whole text, a window has its first line."""
    spark = docs.sparkSession
    rows = []
    for k, (name, body) in enumerate(templates):
        own = template_bigrams(body)
        rows += [(g, k, name, len(own), *bounds(len(own), dice)) for g in own]
    own = docs.select(F.struct("*").alias("row"), *row_key(doc_id, text))
    if not rows:
        kind = "array<struct<line:int,licence:string,dice:double>>"
        return with_columns(own, "row", {"findings": F.array().cast(kind)})
    low, high = min(r[4] for r in rows), max(r[5] for r in rows)
    known = spark.createDataFrame(
        rows, "gram string, template int, licence string, size int, low int, high int"
    )
    if sum(len(r[0]) + len(r[2]) + 40 for r in rows) <= BROADCAST_BYTES:
        known = F.broadcast(known)

    whole = F.coalesce(F.col(text), F.lit(""))
    # The whole text is a passage only if it can be short enough: it has no fewer gaps than bigrams.
    lines = F.split(whole, "\n", -1)
    passages = docs.select(*row_key(doc_id, text), F.posexplode(lines).alias("line", "passage"))
    several = F.contains(whole, F.lit("\n"))
    passages = passages.union(
        docs.where(several).select(*row_key(doc_id, text), F.lit(-1).alias("line"), whole.alias("passage"))
    )
    sized = (
        passages.select("_k1", "_k2", "line", once(words(F.col("passage")), "_w"))
        .where(F.size("_w") > low)
        .select("_k1", "_k2", "line", once(bigrams(F.col("_w")), "grams"))
        .where(F.size("grams").between(low, high))
    )
    picked = sorted({r[0] for r in rows})
    own_of_any = F.filter("grams", lambda g: g.isin(picked))
    shared = (
        sized.select("_k1", "_k2", "line", F.size("grams").alias("n"), F.explode(own_of_any).alias("gram"))
        .join(known, "gram")
        .where(F.col("n").between(F.col("low"), F.col("high")))
        .groupBy("_k1", "_k2", "line", "n", "template", "licence", "size")
        .agg(F.count_distinct("gram").alias("both"))
        .withColumn("dice", 2.0 * F.col("both") / (F.col("n") + F.col("size")))
        .where(F.col("dice") >= dice)
    )
    best = shared.groupBy("_k1", "_k2", "line").agg(
        F.min(F.struct((-F.col("dice")).alias("order"), "licence", "dice")).alias("best")
    )
    found = best.groupBy("_k1", "_k2").agg(
        F.collect_list(F.struct("line", "best.licence", "best.dice")).alias("findings")
    )
    kind = "array<struct<line:int,licence:string,dice:double>>"
    wider = windows(docs, doc_id, text, templates, dice)
    found = found.join(wider, ["_k1", "_k2"], "full").withColumn(
        "findings", F.coalesce("findings", F.array().cast(kind))
    )
    has = lambda w: F.exists(
        "findings",
        lambda f: (f["licence"] == w["licence"]) & ((f["line"] == -1) | f["line"].between(w["line"], w["last"])),
    )
    more = F.transform(
        F.filter("windows", lambda w: ~has(w)),
        lambda w: F.struct(w["line"], w["licence"], w["dice"]),
    )
    more = F.coalesce(more.cast(kind), F.array().cast(kind))
    found = found.select("_k1", "_k2", F.array_sort(F.concat("findings", more)).alias("findings"))
    # Written, so that both sides of the join are plain shuffles that can be split.
    joined = own.join(materialise(found), ["_k1", "_k2"], "left")
    return with_columns(joined, "row", {"findings": F.coalesce("findings", F.array().cast(kind))})


def report(found: DataFrame) -> DataFrame:
    """Per document: findings, distinct licences and the best coefficient."""
    named = F.array_sort(F.array_distinct(F.transform("findings", lambda f: f["licence"])))
    listed = F.transform("findings", lambda f: F.concat_ws(":", f["line"].cast("string"), f["licence"]))
    return found.select(
        "doc_id",
        F.size("findings").cast("long").alias("n_findings"),
        F.array_join(named, ",").alias("licences"),
        F.array_join(listed, ",").alias("lines"),
        F.coalesce(F.array_max(F.transform("findings", lambda f: f["dice"])), F.lit(0.0)).alias("best"),
    )
