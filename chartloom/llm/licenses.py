"""Licence notices in documents: a trained classifier of word windows, confirmed by comparison with templates.

A paragraph is a run of lines up to a line without letters or digits, so hard-wrapped notices are whole, also in comments. Wherever a paragraph holds word pairs of a template close together (within ``SPREAD`` times its
length), the window that the template would fill there is classified. Features of a window are its distinct words and word pairs
(lower case, letters and digits). A logistic regression per family, fitted on the template notices and on ordinary sentences that use
the same words, gives each feature a weight; the margin between a family's own templates and everything else calibrates its score.
A window counts if its family's score is one half or more and if it holds ``CONFIRM`` of the word pairs of a template of that family.
Words outside a window have no say, so a notice is found in a paragraph of any length. Where windows overlap, the one with most pairs
of its template is the notice (LGPL before GPL); all notices that do not overlap are kept, of one family or of several.

The corpus side is built-in functions only: paragraphs without any cue word of a template are passed over, which loses nothing, because
every template keeps less than ``CONFIRM`` of its pairs when the pairs without a cue are taken away (checked when the model is made),
and so are those that hold too few pairs of every template; the others are a table in the shared folder. Different paragraphs are searched once, different windows scored once, by joins with tables whose size the templates bound.

Defined cases: NULL and empty texts have no paragraph; a document is reported once, with all families found in it; rows that share an
id are reported with the notices of all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.common import quoted, written

CONFIRM = 0.6
#: A line break before a line without letters or digits.
BREAK = r"\n[^\p{L}\p{N}\n]*+(?=\n)"
#: How many template lengths a notice may be spread over by words put in between.
SPREAD = 2

#: Usual notices of licence families: fixed values.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "This project is available under the terms of the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD", "Released under the BSD License."),
    ("BSD", "Licensed under the 3-Clause BSD License."),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("GPL", "Licensed under the GNU GPL version 2 or later."),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("AGPL", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC0", "Released under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Ordinary sentences with words of notices: they belong to no family.
OTHERS = [
    "The driver had to show a license and the papers of the car.", "This work is the first version of the source of the river.",
    "The software was released in version 2.0 after a long delay.", "She was granted permission to use the files of the museum.",
    "He works at MIT and gives a public lecture on free software.", "The Apache helicopter was sold under the terms of the treaty.",
    "The general public is free to visit the library at any time.", "A license is needed to sell this product in the city.",
    "The following conditions are met in the northern part of the country.", "All rights reserved. No part of this work may be copied.",
    "The GNU is an animal of the African plains, also called wildebeest.", "The public domain is a topic of international law.",
    "Common attribution errors in version 4 of the study.", "Creative people in the commons of the town.", "Any person obtaining a copy of the book pays for it.",
    "You may not use this road except in winter.", "The binary source forms of the stars.", "The clause of the contract was subject to changes.",
    "Mozilla and other companies released a public statement.", "Licensed doctors are available under the old law.",
]

STOP = "a an and are as at by for in is it of on or the this that to with you be not may can".split()


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def pairs(w: Column) -> Column:
    """Adjacent words joined by a blank."""
    return F.when(F.size(w) > 1, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w) - 1), lambda a, b: F.concat_ws(" ", a, b))).otherwise(
        F.array().cast("array<string>")
    )


def features(w: Column) -> Column:
    return F.array_distinct(F.concat(w, pairs(w)))


def pairs_of(text: str) -> list[str]:
    """The different word pairs of a template."""
    w = re.findall("[a-z0-9]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(w, w[1:], strict=False)})


def cue_words(confirm: float = CONFIRM) -> list[str]:
    """Words of the templates without common ones, but enough that no template can be confirmed without one of them."""
    cues: set[str] = set()
    for _, text in TEMPLATES:
        w = re.findall("[a-z0-9]+", text.lower())
        own = set(w) - set(STOP)
        grams = set(zip(w, w[1:], strict=False))
        if sum(not (a in own or b in own) for a, b in grams) >= confirm * len(grams):
            own = set(w)
        cues |= own
    return sorted(cues)


@dataclass(frozen=True)
class Model:
    weights: DataFrame  # family, feature, weight
    scales: DataFrame  # family, middle, slope: calibration of the margin
    templates: DataFrame  # family, template, pair, place (of the pair, from 0), pairs (different ones), size (words)


def grams_of(text: str) -> list[str]:
    """Features of a training text, as ``features`` makes them of a line."""
    return sorted({*re.findall("[a-z0-9]+", text.lower()), *pairs_of(text)})


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.5, ridge: float = 0.003) -> tuple[np.ndarray, float]:
    """Weights and intercept by gradient descent; both classes weigh the same."""
    w, b = np.zeros(x.shape[1]), 0.0
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) * share
        w -= rate * (x.T @ error + ridge * w)
        b -= rate * error.sum()
    return w, b


def values(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A literal table; texts hold no quotes."""

    def cell(v) -> str:
        return f"'{v}'" if isinstance(v, str) else f"{v!r}D" if isinstance(v, float) else str(v)

    return spark.sql(f"SELECT * FROM VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)} AS t({columns})")


def train(spark: SparkSession) -> Model:
    """One sparse logistic regression per family; the training texts are the two lists above."""
    texts, labels = [t for _, t in TEMPLATES] + OTHERS, [f for f, _ in TEMPLATES] + [""] * len(OTHERS)
    names = sorted({g for t in texts for g in grams_of(t)})
    place = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(texts), len(names)))
    for r, t in enumerate(texts):
        x[r, [place[g] for g in grams_of(t)]] = 1
    weights, scales = [], []
    for family in sorted({f for f, _ in TEMPLATES}):
        y = np.array([f == family for f in labels], float)
        w, b = logistic(x, y)
        margin = x @ w + b
        low, high = margin[y > 0].min(), margin[y == 0].max()
        weights += [(family, g, float(v)) for g, v in zip(names, w, strict=True) if abs(v) > 0.01]
        weights.append((family, "", float(b)))
        scales.append((family, float(low + high) / 2, float(6 / max(low - high, 1.0))))
    grams = []
    for k, (f, t) in enumerate(TEMPLATES):
        w = re.findall("[a-z0-9]+", t.lower())
        place = {p: i for i, p in reversed(list(enumerate(map(" ".join, zip(w, w[1:], strict=False)))))}
        grams += [(f, k, p, i, len(place), len(w)) for p, i in sorted(place.items())]
    return Model(
        values(spark, "family, feature, weight", weights), values(spark, "family, middle, slope", scales),
        values(spark, "family, template, pair, place, pairs, size", grams),
    )


def holds_one(text: Column, confirm: float) -> Column:
    """Whether a paragraph holds ``confirm`` of the pairs of some template, wherever they stand."""
    known = F.array_intersect(pairs(words(text)), F.array(*[F.lit(p) for p in sorted({p for _, t in TEMPLATES for p in pairs_of(t)})]))
    each = F.array(*[
        F.struct(F.array(*map(F.lit, pairs_of(t))).alias("pairs"), F.lit(confirm * len(pairs_of(t))).alias("least")) for _, t in TEMPLATES
    ])
    # the known pairs are few and made once per paragraph, the templates then pass over them
    return F.exists(F.transform(F.array(known), lambda k: F.exists(each, lambda t: F.size(F.array_intersect(k, t["pairs"])) >= t["least"])), lambda x: x)


def windows(different: DataFrame, model: Model, confirm: float) -> DataFrame:
    """``key, family, template, held, low, high``: stretches of words (from 1) that hold ``confirm`` of a template's pairs.

    ``different``: ``key, words``. A stretch begins and ends at a pair of the template, and is as wide as the template is there.
    """
    hits = different.select("key", F.size("words").alias("n"), F.posexplode(pairs(F.col("words"))).alias("at", "pair")).join(model.templates, "pair")
    group = ["key", "n", "family", "template", "pairs", "size"]
    enough = hits.groupBy(*group).agg(F.collect_list(F.struct("at", "place")).alias("hits")).filter(
        F.size(F.array_distinct("hits.place")) >= confirm * F.col("pairs")
    )
    longest = SPREAD * max(len(re.findall("[a-z0-9]+", t.lower())) for _, t in TEMPLATES)
    following = Window.partitionBy("key", "template").orderBy("at").rowsBetween(0, longest - 1)
    starts = enough.select(*group, F.inline("hits")).withColumn("next", F.collect_list(F.struct("at", "place")).over(following))
    near = F.filter("next", lambda h: h["at"] - F.col("at") < SPREAD * F.col("size") - 1)
    # only ends that add a pair of the template: any other end only makes the window wider
    upto = starts.withColumn("next", near).filter(F.size(F.array_distinct("next.place")) >= confirm * F.col("pairs")).select(
        *group, "at", "place", "next", F.posexplode("next").alias("k", "last")
    ).withColumn("seen", F.slice("next.place", 1, F.col("k"))).filter(~F.array_contains("seen", F.col("last.place")))
    held = F.size(F.array_distinct("seen")) + 1
    return upto.withColumn("pairs_held", held).filter(F.col("pairs_held") >= confirm * F.col("pairs")).select(
        "key", "family", "template", "at", "pairs_held", (F.col("pairs_held") / F.col("pairs")).alias("held"),
        F.greatest(F.lit(1), F.col("at") - F.col("place") + 1).alias("low"),
        F.least(F.col("n"), F.col("last.at") + F.col("size") - F.col("last.place")).alias("high"),
    )


def notices(found: DataFrame) -> DataFrame:
    """The windows that are notices: of overlapping ones the best, then the best of what does not overlap it, and so on."""
    # a window around another one of its template with as many pairs tells nothing more: first the best end of a start
    start = Window.partitionBy("key", "template", "at").orderBy(F.desc("pairs_held"), "high")
    found = found.withColumn("r", F.row_number().over(start)).filter("r = 1")
    later = Window.partitionBy("key", "template").orderBy("at").rowsBetween(1, SPREAD * max(len(t.split()) for _, t in TEMPLATES) * 2)
    found = found.withColumn("later", F.collect_list(F.struct("high", "pairs_held")).over(later)).filter(
        ~F.exists("later", lambda o: (o["high"] <= F.col("high")) & (o["pairs_held"] >= F.col("pairs_held")))
    )
    # groups of windows that overlap from one to the next
    order = Window.partitionBy("key").orderBy("low", "high", "template", "at")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = found.withColumn("new", F.when(F.col("low") <= reach, 0).otherwise(1))
    island = island.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    ranked = F.struct(
        (-F.col("pairs_held")).alias("rank"), (-F.col("held")).alias("less"), (F.col("high") - F.col("low")).alias("width"), (-F.col("score")).alias("worse"),
        "family", "low", "high", "held", "score",
    )
    best_first = island.groupBy("key", "island").agg(F.array_sort(F.collect_list(ranked)).alias("all"))
    kept = F.aggregate(
        "all", F.slice("all", 1, 0),
        lambda kept, w: F.when(F.exists(kept, lambda k: (k["low"] <= w["high"]) & (w["low"] <= k["high"])), kept).otherwise(F.concat(kept, F.array(w))),
    )
    return best_first.select("key", F.explode(kept).alias("w")).select("key", "w.low", "w.family", "w.score", "w.held")


def paragraphs(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """Notices: id, paragraph (from 0), word (where it begins there, from 1), family, score, held (share of the template's pairs)."""
    cues = F.array(*[F.lit(c) for c in cue_words(confirm)])
    texts = docs.select(quoted(id_col).alias("id"), F.posexplode(F.split(quoted(text_col).cast("string"), BREAK)).alias("paragraph", "text"))
    near = texts.filter(F.arrays_overlap(words(F.col("text")), cues)).filter(holds_one(F.col("text"), confirm))
    near = written(near.withColumn("key", F.sha2("text", 256)), "license-paragraphs")
    # every different paragraph is searched once, however many documents have it
    different = near.groupBy("key", "text").agg(F.count(F.lit(1)).alias("n")).select("key", words(F.col("text")).alias("words"))
    found = windows(different, model, confirm).join(different, "key").withColumn(
        "window", F.array_join(F.slice("words", F.col("low"), F.col("high") - F.col("low") + 1), " ")
    ).drop("words")
    spread = found.select("family", "window").distinct().select(
        "family", "window", F.explode(F.concat(features(F.split("window", " ")), F.array(F.lit("")))).alias("feature")
    )
    margins = spread.join(model.weights, ["family", "feature"]).groupBy("family", "window").agg(F.sum("weight").alias("margin"))
    scored = margins.join(model.scales, "family").select(
        "family", "window", (1 / (1 + F.exp(-F.col("slope") * (F.col("margin") - F.col("middle"))))).alias("score")
    )
    confirmed = notices(found.join(scored.filter("score >= 0.5"), ["family", "window"]))
    return near.select("id", "paragraph", "key").join(confirmed, "key").select("id", "paragraph", F.col("low").alias("word"), "family", "score", "held")


def licenses(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", confirm: float = CONFIRM) -> DataFrame:
    """Per row: id, n_notices (that do not overlap), families (comma-joined, by name), score (the highest)."""
    found = paragraphs(docs, model or train(docs.sparkSession), id_col, text_col, confirm)
    per_doc = found.groupBy(F.col("id").alias("__id")).agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("f"), F.max("score").alias("s")
    )
    rows = docs.select(quoted(id_col).alias("id"))
    return rows.join(per_doc, F.col("id").eqNullSafe(F.col("__id")), "left").select(
        "id", F.coalesce("n", F.lit(0)).alias("n_notices"), F.coalesce("f", F.lit("")).alias("families"), F.coalesce("s", F.lit(0.0)).alias("score")
    )
