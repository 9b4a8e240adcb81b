"""License scans: a trained paragraph classifier in DataFrame functions only.

A paragraph is a line and, where it ends within a sentence, the lines that follow it, up
to WRAP in all; of a longer run of such lines each begins a paragraph from the WRAPth on.
Features are the word 1- to 3-grams of the templates.  Anchors
are words of the templates without which no line can be confirmed, and short names
of the families; no sample has a say in them.  A softmax regression over families and
an unknown class is fitted on varied templates and on background lines: at most LINES
lines, of CHARS characters at most, of each of at most SAMPLE texts of any length (the
bound of what is collected for training).  One temperature, fitted on variants left out
of the training, calibrates it.

A paragraph without an anchor shares too few n-grams with any template to be confirmed,
whatever the model says of it, and is not reported.  Distinct paragraphs are classified
once and joined back.  A predicted family is confirmed when the paragraph shares enough
3-grams with one of the family's templates.

Null and empty texts have no lines.  Repeated rows are reported each, and a null id stays
null.  Of equally likely families the first by name holds, the unknown class last.  Very
long texts are read line by line.  Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, sampled, stored

# Notices that licence families are declared with.
TEMPLATES = {
    "apache": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Use of this source code is governed by a BSD-style license", "SPDX-License-Identifier: BSD-3-Clause", "Released under the BSD License."],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: GPL-3.0-or-later", "Licensed under the GPL."],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only", "Licensed under the LGPL."],
    "mit": ["Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "SPDX-License-Identifier: MIT", "Licensed under the MIT License."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
}
# Lines about licences that declare none.
LOOK_ALIKES = [
    "The driver showed a valid driving license to the officer.",
    "A license fee is due every year.",
    "She is a licensed engineer and holds a public office.",
    "The library is open to the public free of charge.",
    "Version 2.0 was released with a general overhaul.",
    "Permission to enter must be asked for at the gate.",
    "All rights reserved by the author of this work.",
    "The commons was licensed to the creative crowd by the town.",
    "Apache is also the name of a people.",
    "The license of the restaurant was not renewed.",
]
UNKNOWN = "unknown"
#: Texts, lines of each and characters of a line that serve as background, at most.
SAMPLE, LINES, CHARS = 300, 40, 1000
#: Words put around notices, and background lines that stand for no licence, at most.
FILLER, ODD = 5000, 200
VARIANTS = 40
#: Short names of families, and words too frequent to look for.
NAMES = ["apache", "bsd", "cc by", "cc-by", "creative commons", "gpl", "licence", "license", "mit license", "mozilla public", "mpl"]
PLAIN = set("a and any are by following in is it may not of or that the this to use version with you".split())
SURE = 0.6
SHARED = 0.4
#: Lines of a paragraph, at most, and how the last line of a sentence ends.
WRAP = 6
ENDS = r"[.!?:;][\"')\]]*\s*$"
TOKEN = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"


def words(line: str) -> list[str]:
    return re.findall(TOKEN, line.translate(str.maketrans(UPPER, LOWER)))


def grams(ws: list[str]) -> set[str]:
    return {" ".join(ws[i : i + n]) for n in (1, 2, 3) for i in range(len(ws) - n + 1)}


def longest_grams(line: str) -> list[str]:
    """The line's 3-grams, or what it has of the next shorter ones."""
    ws = words(line)
    n = min(3, len(ws))
    return sorted({" ".join(ws[i : i + n]) for i in range(len(ws) - n + 1)})


def varied(line: str, filler: list[str], rng: random.Random) -> str:
    """The line with words lost, changed and put around it."""
    ws = [w for w in line.split() if rng.random() > 0.06]
    ws = [rng.choice(filler) if rng.random() < 0.03 else w for w in ws]
    before, after = (rng.choices(filler, k=rng.choice([0, 0, 2, 5])) for _ in range(2))
    return " ".join([*before, *ws, *after])


def gate() -> list[str]:
    """NAMES and the words without which no line can be confirmed; they depend on the templates only.

    A line is confirmed when it has SHARED of a template's longest n-grams.  Words are taken
    until the n-grams of each template that hold none of them are fewer than that.
    """
    own = [longest_grams(t) for ts in TEMPLATES.values() for t in ts]
    chosen: list[str] = []

    def free(gs: list[str]) -> list[str]:
        return [g for g in gs if not any(w in chosen for w in g.split())]

    while left := [f for gs in own if len(f := free(gs)) >= SHARED * len(gs)]:
        gain: dict[str, int] = {}
        for f in left:
            for g in f:
                for w in set(g.split()) - PLAIN:
                    gain[w] = gain.get(w, 0) + 1
        chosen.append(max(sorted(gain), key=gain.get))
    return sorted({*chosen, *NAMES})


class Classifier:
    """Softmax regression over sparse n-grams, fitted on the driver."""

    def __init__(self, background: list[str], seed: int = 3):
        rng = random.Random(seed)
        known = [grams(words(t)) for ts in TEMPLATES.values() for t in ts]
        plain = []
        for line in background:
            g = grams(words(line))
            if not any(len(g & k) >= 0.5 * len(k) for k in known):
                plain.append(line)
        filler = [w for line in plain for w in line.split()][:FILLER] or ["and", "so", "on"]
        self.anchors = gate()
        self.families = [*sorted(TEMPLATES), UNKNOWN]
        vocabulary = sorted(set().union(*known))
        self.index = {g: i for i, g in enumerate(vocabulary)}
        rows, y = [], []
        for k, family in enumerate(sorted(TEMPLATES)):
            for t in TEMPLATES[family]:
                for v in range(VARIANTS):
                    rows.append(t if v == 0 else varied(t, filler, rng))
                    y.append(k)
        odd = LOOK_ALIKES + rng.sample(plain, min(ODD, len(plain)))
        for line in odd:
            for _ in range(8 if line in LOOK_ALIKES else 1):
                rows.append(varied(line, filler + self.anchors, rng))
                y.append(len(TEMPLATES))
        x = np.zeros((len(rows), len(vocabulary) + 1))
        x[:, -1] = 1
        for i, line in enumerate(rows):
            for g in grams(words(line)):
                if (j := self.index.get(g)) is not None:
                    x[i, j] = 1
        target = np.eye(len(self.families))[y]
        held = np.arange(len(rows)) % 4 == 3
        w = np.zeros((x.shape[1], len(self.families)))
        speed = np.zeros_like(w)
        for _ in range(300):
            p = self.softmax(x[~held] @ w)
            grad = x[~held].T @ (target[~held] - p) / (~held).sum() - 1e-4 * w
            speed = 0.9 * speed + grad
            w += 0.5 * speed
        logits = x[held] @ w
        losses = {t: -np.log((self.softmax(logits * t) * target[held]).sum(axis=1) + 1e-12).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0)}
        self.weights = w * min(losses, key=losses.get)

    @staticmethod
    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def holds(c: Column, anchors: list[str]) -> Column:
    """Whether the text has an anchor as a substring; anchors that hold another add nothing."""
    least = [a for a in anchors if not any(b != a and b in a for b in anchors)]
    return c.rlike("(?i)" + "|".join(map(re.escape, least)))


def paragraphs(text: Column, anchors: list[str]) -> Column:
    """Array of struct(at, content): paragraphs that hold an anchor, their first line and their lines."""
    line = F.split(text, "\n")
    blank = lambda x: F.trim(x) == ""
    # whether a line goes on in the next one
    goes = F.transform(line, lambda x, j: ~blank(x) & ~x.rlike(ENDS) & ~blank(F.coalesce(F.get(line, j + 1), F.lit(""))))

    def one(x: Column, pair: Column, j: Column) -> Column:
        content, on = x, F.lit(True)
        for k in range(1, WRAP):
            on = on & F.get(pair["goes"], j + (k - 1))
            content = F.when(on, F.concat(content, F.lit("\n"), F.get(pair["line"], j + k))).otherwise(content)
        return content

    def begins(pair: Column, j: Column) -> Column:
        before = [F.coalesce(F.get(pair["goes"], j - k), F.lit(False)) for k in range(1, WRAP)]
        whole = before[0]
        for b in before[1:]:
            whole = whole & b
        return ~before[0] | whole

    both = F.struct(line.alias("line"), goes.alias("goes"))
    # a one-element array stands for a name, so that lines and flags are worked out once
    found = F.transform(F.array(both), lambda p: F.filter(F.transform(p["line"], lambda x, j: F.struct(j.alias("at"), F.when(begins(p, j), one(x, p, j)).alias("content"))), lambda s: s["content"].isNotNull() & holds(s["content"], anchors)))
    return F.flatten(found)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, line, family, probability, similarity, confirmed; a row for each paragraph with an anchor, at its first line with one."""
    spark = docs.sparkSession
    # of each text the lines of least hash, so that a long text counts as much as a short one
    few = F.slice(F.array_sort(F.transform(F.array_distinct(F.split("text", "\n")), lambda x: F.struct(F.xxhash64(x).alias("h"), F.substring(x, 1, CHARS).alias("line")))), 1, LINES)
    sample = sampled(docs.select("text").where(F.length("text") > 0), SAMPLE, "text").select(few.getField("line").alias("lines"))
    model = Classifier([line for r in sample.toLocalIterator() for line in r["lines"]])
    lines = docs.select("doc_id", "text").where(holds(F.col("text"), model.anchors)).select("doc_id", F.explode(paragraphs(F.col("text"), model.anchors)).alias("p"))
    first = F.array_position(F.transform(F.split("p.content", "\n"), lambda x: holds(x, model.anchors)), True)
    lines = lines.select("doc_id", (F.col("p.at") + F.greatest(first - 1, F.lit(0))).cast("int").alias("line"), lower(F.col("p.content")).alias("content"))
    lines = stored(lines.withColumns({"k1": F.xxhash64("content"), "k2": F.xxhash64(F.lit(1), "content")}), "lines")
    distinct = lines.groupBy("k1", "k2").agg(F.first("content").alias("content"))
    ws = distinct.select("k1", "k2", F.regexp_extract_all("content", F.lit(f"({TOKEN})"), 1).alias("w"))

    def runs(n: int) -> Column:
        last = F.size("w") - n + 1
        return F.when(last < 1, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), " ")))

    found = stored(ws.select("k1", "k2", F.array_distinct(runs(1)).alias("g1"), F.array_distinct(runs(2)).alias("g2"), F.array_distinct(runs(3)).alias("g3")), "grams")
    size = range(len(model.families))
    weights = spark.createDataFrame([(g, *map(float, model.weights[i])) for g, i in model.index.items()], "gram string, " + ", ".join(f"w{k} double" for k in size))
    each = found.select("k1", "k2", F.explode(F.concat("g1", "g2", "g3")).alias("gram"))
    # the model's size is fixed by the templates
    sums = each.join(F.broadcast(weights), "gram").groupBy("k1", "k2").agg(*(F.sum(f"w{k}").alias(f"s{k}") for k in size))
    bias = [float(b) for b in model.weights[-1]]
    logits = [F.coalesce(F.col(f"s{k}"), F.lit(0.0)) + bias[k] for k in size]
    top = F.greatest(*logits)
    total = sum((F.exp(z - top) for z in logits), F.lit(0.0))
    best = F.coalesce(*(F.when(z >= top, F.lit(model.families[k])) for k, z in enumerate(logits)))

    def likeness(template: str) -> Column:
        own = longest_grams(template)
        return F.size(F.array_intersect("long", F.array(*map(F.lit, own)))) / float(len(own))

    pairs = [(F.lit(family), F.greatest(F.lit(0.0), *map(likeness, ts))) for family, ts in sorted(TEMPLATES.items())]
    shares = F.create_map(*(x for pair in pairs for x in pair))
    judged = (
        found.withColumn("long", F.concat("g1", "g2", "g3"))
        .join(sums, ["k1", "k2"], "left")
        .select("k1", "k2", "long", best.alias("best"), (1 / total).alias("probability"), shares.alias("shares"))
        .withColumn("family", F.when(F.col("probability") >= SURE, F.col("best")).otherwise(UNKNOWN))
        .select("k1", "k2", "family", F.round("probability", 6).alias("probability"), F.coalesce(F.element_at("shares", F.col("family")), F.lit(0.0)).alias("similarity"))
    )
    out = lines.select("doc_id", "line", "k1", "k2").join(judged, ["k1", "k2"])
    return out.select("doc_id", "line", "family", "probability", "similarity", ((F.col("family") != UNKNOWN) & (F.col("similarity") >= SHARED)).alias("confirmed"))
