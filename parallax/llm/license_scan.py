"""Licence scan in DataFrame operations only: a trained paragraph classifier.

A paragraph is a line.  Features are its word bigrams and trigrams (lower case, letters,
digits and dots) that occur in a notice, each worth 1 / sqrt(such n-grams of the paragraph),
and their share of all n-grams of the paragraph.  A multinomial logistic regression is
fitted on the notices below and on the paragraphs of at most ``TRAIN_DOCS`` distinct texts,
drawn by hash, that share no trigram with a notice; ``HELD_DOCS`` further texts and
held-back variants of the notices calibrate it (Platt scaling of the margin between the best
family and no licence).  If the texts drawn give no such paragraph to fit on, or none to calibrate
with, ``PLAIN`` stands in.  Fitting uses these bounded samples; every paragraph is scored.

Scoring joins n-grams with the table of learned weights (one row for each n-gram of the
notices, broadcast) and sums the weights by paragraph, so paragraphs without a learned n-gram leave no row: their
score is the intercept, which stands for no licence.  A found family is confirmed when
at least ``MIN_SHARE`` of a notice's n-grams occur in the paragraph or of the paragraph's in
the notice; else the licence is ``unknown``.

Results for odd input: null or empty text has no paragraph; equal paragraphs of one document
are each reported with their line number, a repeated row once; a null id is carried; without
documents nothing is found; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, Normalizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.llm.common import written

TRAIN_DOCS = 400
HELD_DOCS = 200
MIN_SHARE = 0.6
LICENCE_AT = 0.5
NONE = "none"

# Short public licence notices by family.
NOTICES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Distributed under the terms of the Apache License, Version 2.0."],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This software is distributed under the terms of the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "SPDX-License-Identifier: MIT"],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Released under the GNU General Public License, version 2 or later.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later"],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause"],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Available under CC BY-NC-SA 4.0 for non-commercial use only."],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License, CC BY-SA 4.0."],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "This document has been released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights."],
    "proprietary": [
        "All rights reserved.",
        "Copyright by the authors. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher."],
}
FAMILIES = sorted(NOTICES)


# Sentences without a licence.
PLAIN = [
    "The river was high after two days of rain and the bridge stayed closed.",
    "She read the letter twice before she put it back on the table.",
    "The meeting begins at nine and ends before lunch.",
    "Prices rose by two percent in the first half of the year.",
    "Add the flour slowly and stir until the dough is smooth.",
    "The team lost the last game of the season by one goal."]

_GAP = r"(?:[^\p{L}\p{N}.]|\.(?![\p{L}\p{N}]))+"


def _words(text: Column) -> Column:
    return F.split(F.lower(text), _GAP)


def grams(text: Column) -> Column:
    """Distinct bigrams and trigrams of a paragraph."""
    return _grams(F.filter(_words(text), lambda x: x != ""))


def _pairs(text: Column) -> Column:
    """Hashes of the bigrams of a paragraph (and of a few more pairs at its ends)."""
    w = _words(text)
    return F.zip_with(w, F.slice(w, 2, 1 << 30), lambda a, b: F.xxhash64(a, b))


def _grams(w: Column) -> Column:
    after = lambda k: F.slice(w, F.lit(k), F.size(w))
    two = F.zip_with(w, after(2), lambda a, b: F.concat_ws(" ", a, b))
    three = F.zip_with(two, after(3), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(F.slice(two, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))),
                                     F.slice(three, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))))


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) of the paragraphs that have a letter or digit."""
    return (docs.select("doc_id", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
            .filter(F.col("line").rlike(r"[\p{L}\p{N}]")))


def _notices(spark) -> DataFrame:
    """(family, template, line, held): the notices; those held back have a few words before
    and after and calibrate the classifier."""
    rows = [(f, i * 100 + j, text) for i, f in enumerate(FAMILIES) for j, text in enumerate(NOTICES[f])]
    base = spark.createDataFrame(rows, "family string, template long, line string")
    held = base.withColumn("line", F.concat(F.lit("Note: "), "line", F.lit(" See the file for details.")))
    return base.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))


def _vectors(rows: DataFrame, known: list[str]) -> DataFrame:
    counter = CountVectorizerModel.from_vocabulary(known, inputCol="grams", outputCol="counts")
    unit = Normalizer(inputCol="counts", outputCol="unit", p=2.0).transform(counter.setBinary(True).transform(rows))
    hits = F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in known])))
    return VectorAssembler(inputCols=["unit", "share"], outputCol="features").transform(
        unit.withColumn("share", hits / F.size("grams")))


class Classifier:
    """``weights``: (gram, w), scores of the families against no licence; ``bias`` and
    ``share``: the intercepts and the weights of the share of known n-grams; ``scale`` and
    ``shift`` of the calibration; ``templates``: (family, template, size, gram)."""

    def __init__(self, weights: DataFrame, bias: list[float], share: list[float], templates: DataFrame):
        self.weights, self.bias, self.share, self.templates = weights, bias, share, templates
        self.scale, self.shift = 1.0, 0.0


def _drawn(docs: DataFrame) -> DataFrame:
    """(text, held): distinct texts drawn by hash, at most ``TRAIN_DOCS`` to fit on and
    ``HELD_DOCS`` to calibrate with on average.  Copies are one text."""
    texts = docs.filter("text is not null").select("text", F.md5("text").alias("digest"))
    first = texts.select("digest").distinct().orderBy(F.xxhash64("digest", F.lit("draw")), "digest").limit(TRAIN_DOCS + HELD_DOCS)
    few = texts.join(F.broadcast(first), "digest", "left_semi").groupBy("digest").agg(F.min("text").alias("text"))
    return few.select("text", (F.pmod(F.xxhash64("text"), F.lit(TRAIN_DOCS + HELD_DOCS)) < HELD_DOCS).alias("held"))


def train(docs: DataFrame) -> Classifier:
    spark = docs.sparkSession
    notices = written(_notices(spark).withColumn("grams", grams(F.col("line"))), "licence-notices")
    templates = notices.filter("not held").select("family", "template", F.size("grams").cast("double").alias("size"),
                                                  F.explode("grams").alias("gram"))
    plain = (_drawn(docs).select("held", F.explode(F.split("text", "\n")).alias("line")).distinct()
             .withColumn("grams", grams(F.col("line"))).filter(F.size("grams") > 0))
    marks = [r.gram for r in templates.select("gram").distinct().collect() if r.gram.count(" ") == 2]
    plain = plain.filter(~F.exists("grams", lambda g: g.isin(marks))).select(F.lit(NONE).alias("family"), "grams", "held")
    plain = written(plain, "licence-plain")
    sides = {r.held for r in plain.select("held").distinct().collect()}
    spare = spark.createDataFrame([(NONE, text, held) for held in (False, True) if held not in sides for text in PLAIN],
                                  "family string, line string, held boolean").select("family", grams(F.col("line")).alias("grams"), "held")
    rows = written(notices.select("family", "grams", "held").unionByName(plain).unionByName(spare), "licence-train")
    fit_rows = rows.filter("not held")
    classes = [NONE, *FAMILIES]
    known = sorted(r.gram for r in templates.select("gram").distinct().collect())
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")) - 1
    per = {r.family: r.n for r in fit_rows.groupBy("family").agg(F.count("*").alias("n")).collect()}
    # families weigh alike, no licence three times as much
    weight = F.element_at(F.create_map(*[F.lit(x) for c, n in per.items() for x in (c, (3.0 if c == NONE else 1.0) / n)]),
                          F.col("family"))
    train_rows = _vectors(fit_rows, known).withColumn("label", index.cast("double")).withColumn("weight", weight)
    fitted = LogisticRegression(family="multinomial", regParam=1e-4, maxIter=40, weightCol="weight").fit(train_rows)
    coef, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    against = [[float(x) for x in coef[c] - coef[0]] for c in range(1, len(classes))]
    table = [(g, [w[k] for w in against]) for k, g in enumerate(known)]
    weights = written(spark.createDataFrame(table, "gram string, w array<double>"), "licence-weights")
    model = Classifier(weights, [float(b - bias[0]) for b in bias[1:]], [w[-1] for w in against], templates)
    held = written(rows.filter("held").withColumn("id", F.monotonically_increasing_id()), "licence-held")
    scored = _scores(held.select("id", F.size("grams").alias("n"), F.explode_outer("grams").alias("gram")), ["id", "n"], model)
    margins = held.join(scored, "id", "left").select(
        (F.col("family") != NONE).cast("double").alias("label"),
        F.coalesce(F.array_max("z"), F.lit(max(model.bias))).alias("margin"))
    platt = LogisticRegression(regParam=1e-3, maxIter=40).fit(
        VectorAssembler(inputCols=["margin"], outputCol="features").transform(margins))
    model.scale, model.shift = float(platt.coefficients[0]), float(platt.intercept)
    return model


def _scores(rows: DataFrame, keys: list[str], model: Classifier) -> DataFrame:
    """(keys, z, found): the score of each family against no licence, from the known n-grams
    of ``rows`` (keys with n, gram).  Paragraphs without a known n-gram are absent."""
    hit = rows.join(F.broadcast(model.weights), "gram")  # one row for each n-gram of the notices
    once = hit.groupBy(*keys, "gram").agg(F.first("w").alias("w"))  # a repeated row counts once
    k = F.count("*")
    z = [F.sum(F.col("w")[i]) / F.sqrt(k) + F.lit(s) * k / F.first("n") + F.lit(b)
         for i, (s, b) in enumerate(zip(model.share, model.bias))]
    return once.groupBy(*keys).agg(F.array(*z).alias("z"), F.collect_set("gram").alias("found"))


def scan(docs: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, line_no, family, probability, template_share): every paragraph that is a
    licence with a probability of at least ``LICENCE_AT``."""
    # a known n-gram holds a known bigram, so a cheap look for those drops most lines unharmed
    pairs = [r.h for r in model.templates.filter(F.size(F.split("gram", " ")) == 2).select(
        F.xxhash64(F.split("gram", " ")[0], F.split("gram", " ")[1]).alias("h")).distinct().collect()]
    lines = (_lines(docs).filter(F.arrays_overlap(_pairs(F.col("line")), F.array(*[F.lit(h) for h in pairs])))
             .withColumn("line_hash", F.xxhash64("line")).withColumn("grams", grams(F.col("line"))))
    keys = ["doc_id", "line_no", "line_hash", "n"]
    rows = lines.select("doc_id", "line_no", "line_hash", F.size("grams").alias("n"),
                        F.explode_outer("grams").alias("gram"))
    scored = _scores(rows, keys, model)
    p = 1 / (1 + F.exp(-(F.lit(model.scale) * F.array_max("z") + F.lit(model.shift))))
    likely = (scored.withColumn("probability", p).filter(F.col("probability") >= LICENCE_AT)
              .withColumn("best", F.element_at(F.array(*[F.lit(f) for f in FAMILIES]),
                                               F.array_position("z", F.array_max("z")).cast("int"))))
    likely = written(likely, "licence-likely")
    shares = (likely.select("doc_id", "line_no", "line_hash", "n", "best", F.explode("found").alias("gram"))
              .join(F.broadcast(model.templates.withColumnRenamed("family", "best")), ["best", "gram"])
              .groupBy("doc_id", "line_no", "line_hash", "n", "template", "size").agg(F.count("*").alias("k"))
              .groupBy("doc_id", "line_no", "line_hash")
              .agg(F.max(F.greatest(F.col("k") / F.col("size"), F.col("k") / F.col("n"))).alias("template_share")))
    shares = shares.toDF("_d", "_l", "_h", "template_share")
    on = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("line_no") == F.col("_l")) & (F.col("line_hash") == F.col("_h"))
    share = F.coalesce("template_share", F.lit(0.0))
    return likely.join(shares, on, "left").select(
        "doc_id", "line_no", F.when(share >= MIN_SHARE, F.col("best")).otherwise("unknown").alias("family"),
        F.round("probability", 6).alias("probability"), F.round(share, 6).alias("template_share"))


def report(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", "text")
    return scan(slim, train(slim))
