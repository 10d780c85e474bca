"""Licence scans: a sparse n-gram logistic regression over paragraphs, with a calibrated unknown
class, whose predictions are confirmed against licence templates.  DataFrame functions only.

A paragraph is a line of a document.  Its features are the word pairs and triples that occur in any
template; all others have no weight.  A multinomial logistic regression with an L1 penalty (``pyspark.ml``)
learns the families and the class ``unknown`` from variants of the templates (words left out, text around
them) and from paragraphs of a bounded sample of documents, at most about ``SAMPLE_DOCS`` by a hash of the id.  A
temperature is then fitted on a held-out fold, so the probabilities of ``unknown`` and the families are
calibrated.  A paragraph is predicted to be a licence if ``unknown`` is not the likeliest class and the
family has at least ``LEAST`` of the probability; it is confirmed if it holds ``CONFIRM`` of the pairs of
one of the family's templates.

A notice that is wrapped over neighbouring lines (with a word each) is found by its joined words: at each template
n-gram, ``REACH`` times the template's words from there hold ``CONFIRM`` of its n-grams, over more than one line.
Texts without a tell-tale word of a template (see ``tell_tale``) are left aside first.
It is reported from its first to its last line, with the family's probability for the n-grams it holds, whatever
class is the likeliest.

Scale: one pass splits the texts and joins word pairs and triples with the weights by broadcast (as many
rows as the templates have n-grams).  A paragraph without a weighted n-gram has the score of the empty
one, which is ``unknown``, so only the few others are shuffled, by document and line; copies and hot
sources make no group.

Defined results: null, empty and blank texts have no paragraph with a licence; rows that repeat an id and
text give one result per paragraph, rows with the same id and other texts are scanned on their own; a null
id is kept as null; with an empty table there is nothing to learn ``unknown`` from and nothing to scan.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelrec.llm.common import table, written

UNKNOWN = "unknown"
SAMPLE_DOCS = 3000
SAMPLE_LINES = 8             # lines of a sampled document
LEAST = 0.5
CONFIRM = 0.7
REACH = 1.5                  # words of a wrapped notice, as a multiple of its template's
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
WORDS = r"[\p{Alnum}\P{ASCII}]+"

#: Well-known notices, by SPDX family name.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "This project is licensed under the Apache License 2.0.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is licensed under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
    ),
    "Proprietary": (
        "All rights reserved.",
        "Copyright by the authors. All rights reserved.",
        "No part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher.",
    ),
}


# --- paragraphs and n-grams ----------------------------------------------------------------

def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0))


def _grams(words: Column) -> Column:
    """Pairs and triples of a word array."""
    at = lambda k: F.concat_ws(" ", *[F.get(words, k + j) for j in range(2)])
    pairs = F.when(F.size(words) > 1, F.transform(F.sequence(F.lit(0), F.size(words) - 2), at)).otherwise(F.array().cast("array<string>"))
    at3 = lambda k: F.concat_ws(" ", *[F.get(words, k + j) for j in range(3)])
    triples = F.when(F.size(words) > 2, F.transform(F.sequence(F.lit(0), F.size(words) - 3), at3)).otherwise(F.array().cast("array<string>"))
    return F.concat(pairs, triples)


def templates(spark: SparkSession) -> DataFrame:
    rows = [(k, f, t) for k, (f, t) in enumerate((f, t) for f, ts in TEMPLATES.items() for t in ts)]
    return spark.createDataFrame(rows, "template int, family string, text string")


def lines(docs: DataFrame) -> DataFrame:
    """``doc_id, line, text`` of every line with a word."""
    d = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    return d.where(F.col("text").rlike(WORDS))


# --- training -----------------------------------------------------------------------------------

def training_set(docs: DataFrame) -> DataFrame:
    """``family, words, fold``: template variants, and paragraphs of sampled documents as ``unknown``."""
    spark = docs.sparkSession
    n = docs.count()
    kept = docs if n <= SAMPLE_DOCS else docs.where(
        F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < int(SAMPLE_DOCS / n * (1 << 30)))
    sample = (lines(kept).withColumn("_h", F.xxhash64("doc_id", "line"))
              .where((F.col("line") < 2) | (F.pmod("_h", F.lit(4)) == 0)).where(F.col("line") < 4 * SAMPLE_LINES))
    t = templates(spark).withColumn("w", _words(F.col("text")))
    known = t.select("template", "family", F.explode(F.array_distinct(_grams(F.col("w")))).alias("g"))
    # a sampled line that holds most pairs of a template is no example of the unknown
    s = sample.select("_h", _words(F.col("text")).alias("words"))
    hits = (s.select("_h", F.explode(F.array_distinct(_grams(F.col("words")))).alias("g")).join(F.broadcast(known), "g")
            .groupBy("_h", "template").agg(F.count(F.lit(1)).alias("n")))
    sizes = known.groupBy("template").agg(F.count(F.lit(1)).alias("m"))
    licensed = hits.join(sizes, "template").where(F.col("n") * 2 >= F.col("m")).select("_h").distinct()
    unknown = s.join(licensed, "_h", "left_anti").select(F.lit(UNKNOWN).alias("family"), F.slice("words", 1, 400).alias("words"),
                                                         F.pmod(F.col("_h"), F.lit(5)).cast("int").alias("fold"))
    # variants: each word left out, and each with text from the sample around it
    v = t.select("family", "w", F.explode(F.sequence(F.lit(-1), F.size("w") - 1)).alias("k"), "template")
    cut = F.when(F.col("k") < 0, F.col("w")).otherwise(F.concat(F.slice("w", 1, F.greatest(F.col("k"), F.lit(0))),
                                                                F.slice("w", F.col("k") + 2, F.size("w"))))
    v = v.select("family", cut.alias("w"), F.pmod(F.xxhash64("template", "k"), F.lit(5)).cast("int").alias("fold"),
                 F.pmod(F.xxhash64("template", "k", F.lit(2)), F.lit(200)).alias("slot")).where(F.size("w") > 1)
    around = (s.select(F.pmod("_h", F.lit(200)).alias("slot"), F.struct("_h", F.slice("words", 1, 12).alias("words")).alias("x"))
              .groupBy("slot").agg(F.min("x").alias("x")))
    mixed = v.join(around, "slot").select("family", F.concat("x.words", "w").alias("words"), "fold")
    mixed2 = v.join(around, "slot").select("family", F.concat("w", "x.words").alias("words"), "fold")
    plain = v.select("family", F.col("w").alias("words"), "fold")
    return plain.unionByName(plain).unionByName(mixed).unionByName(mixed2).unionByName(unknown)


class Model:
    """Weights per n-gram and class, intercepts, and the temperature."""

    def __init__(self, classes: list[str], grams: list[str], weights: list[list[float]], bias: list[float], temperature: float):
        self.classes, self.grams, self.weights, self.bias, self.temperature = classes, grams, weights, bias, temperature

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(g, w) for g, w in zip(self.grams, self.weights) if any(w)]
        return spark.createDataFrame(rows, "gram string, w array<double>")


def _likelihood(scores: Column, at: Column, temperature: float) -> Column:
    """Softmax probability of the class number ``at`` (from 0)."""
    own = F.element_at(scores, (at + 1).cast("int"))
    return 1 / F.aggregate(F.transform(scores, lambda x: F.exp((x - own) / temperature)), F.lit(0.0), lambda a, x: a + x)


def fit(docs: DataFrame) -> Model:
    spark = docs.sparkSession
    classes = [UNKNOWN, *TEMPLATES]
    vocabulary = sorted(r["g"] for r in templates(spark).select(F.explode(_grams(_words(F.col("text")))).alias("g")).distinct().collect())
    index = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("family")) - 1
    data = written(training_set(docs).select("family", _grams(F.col("words")).alias("grams"), index.cast("double").alias("label"), "fold"), "licenses")
    # the unknown and the known weigh the same, and so do the known among themselves
    counts = {int(r["label"]): r["count"] for r in data.where("fold > 0").groupBy("label").count().collect()}
    known = max(1, len(counts) - (0 in counts))
    share = F.lit(0.0)
    for k, n in counts.items():
        share = F.when(F.col("label") == k, F.lit((0.5 if k == 0 else 0.5 / known) / n * sum(counts.values()))).otherwise(share)
    data = data.withColumn("share", share)
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True).transform(data)
    lr = LogisticRegression(family="multinomial", regParam=1e-4, elasticNetParam=1.0, maxIter=60, standardization=False, weightCol="share")
    model = lr.fit(vectors.where("fold > 0"))
    matrix, bias = model.coefficientMatrix.toArray(), list(model.interceptVector.toArray())
    bias += [-30.0] * (len(classes) - len(bias))                  # classes that no row had
    weights = [[float(matrix[c][k]) if c < len(matrix) else 0.0 for c in range(len(classes))] for k in range(len(vocabulary))]
    raw = Model(classes, vocabulary, weights, [float(b) for b in bias], 1.0)
    # calibration: the temperature with the least log loss on the held-out fold
    held = data.where("fold = 0").withColumn("_n", F.monotonically_increasing_id())
    held = written(held.select("_n", "label", "share", "grams"), "held")
    z = _scores(held.select("_n", "label", "share", F.explode_outer(F.array_distinct("grams")).alias("gram")), ["_n", "label", "share"], raw)
    scores = F.array(*[F.col(f"z{k}") for k in range(len(classes))])
    loss = [F.sum(-F.log(F.greatest(_likelihood(scores, F.col("label"), t), F.lit(1e-12))) * F.col("share")) for t in TEMPERATURES]
    found = z.agg(*[x.alias(str(k)) for k, x in enumerate(loss)]).first()
    ranked = [(found[k], t) for k, t in enumerate(TEMPERATURES) if found[k] is not None]
    raw.temperature = min(ranked)[1] if ranked else 1.0
    return raw


def _scores(grams: DataFrame, key: list[str], model: Model) -> DataFrame:
    """Rows (key, gram) -> a score per class; a key without a weighted n-gram has the intercepts."""
    j = grams.join(F.broadcast(model.table(grams.sparkSession)), "gram", "left")
    return j.groupBy(*key).agg(*[(F.coalesce(F.sum(F.get("w", k)), F.lit(0.0)) + b).alias(f"z{k}") for k, b in enumerate(model.bias)])


# --- scanning ------------------------------------------------------------------------------------

def scan(docs: DataFrame, model: Model, least: float = LEAST, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id, text`` -> ``doc_id, line, family, probability, similarity, confirmed, text`` for each
    paragraph that is predicted to be a licence."""
    spark = docs.sparkSession
    weights = F.broadcast(model.table(spark))
    p = lines(docs.select("doc_id", "text")).withColumn("_w", _words(F.col("text")))
    p = p.select("doc_id", "line", "text", "_w", F.posexplode_outer("_w").alias("_k", "_a"))
    # every word with the one after it, and with the two after it
    b, c = F.get("_w", F.col("_k") + 1), F.get("_w", F.col("_k") + 2)
    two = F.when(b.isNotNull(), F.concat("_a", F.lit(" "), b))
    three = F.when(c.isNotNull(), F.concat("_a", F.lit(" "), b, F.lit(" "), c))
    first = weights.select(F.col("gram").alias("_g2"), F.col("w").alias("_w2"))
    second = weights.select(F.col("gram").alias("_g3"), F.col("w").alias("_w3"))
    hit = (p.withColumn("_g2", two).withColumn("_g3", three)
           .join(F.broadcast(first), "_g2", "left").join(F.broadcast(second), "_g3", "left")
           .where("_w2 is not null or _w3 is not null"))
    # an n-gram counts once in a paragraph
    hit = hit.select("doc_id", "line", "text", F.explode(F.filter(F.array(F.struct(F.col("_g2").alias("g"), F.col("_w2").alias("w")),
                                                                          F.struct(F.col("_g3").alias("g"), F.col("_w3").alias("w"))),
                                                                  lambda x: x["w"].isNotNull())).alias("x"))
    hit = hit.select("doc_id", "line", "text", "x.g", "x.w").dropDuplicates(["doc_id", "line", "text", "g"])
    z = hit.groupBy("doc_id", "line", "text").agg(*[(F.sum(F.get("w", k)) + x).alias(f"z{k}") for k, x in enumerate(model.bias)])
    z = z.select("doc_id", "line", "text", F.array(*[F.col(f"z{k}") for k in range(len(model.classes))]).alias("_z"))
    z = z.withColumn("_at", F.array_position("_z", F.array_max("_z")) - 1)        # of equals the first
    best = z.where("_at > 0").select("doc_id", "line", "text", F.element_at(F.array(*[F.lit(c) for c in model.classes]), (F.col("_at") + 1).cast("int")).alias("family"),
                                     _likelihood(F.col("_z"), F.col("_at"), model.temperature).alias("p"))
    best = best.where(F.col("p") >= least)
    # confirmation: the share of a template's n-grams that the paragraph holds
    t = templates(spark).select(F.col("family").alias("_f"), F.array_distinct(_grams(_words(F.col("text")))).alias("_t"))
    own = best.select("doc_id", "line", "text", "family", "p", F.array_distinct(_grams(_words(F.col("text")))).alias("_g"))
    j = own.join(F.broadcast(t), F.col("family") == F.col("_f"))
    share = F.size(F.array_intersect("_g", "_t")) / F.size("_t")
    out = j.groupBy("doc_id", "line", "text").agg(F.first("family").alias("family"), F.first("p").alias("probability"),
                                                  F.max(share).alias("similarity"))
    return out.select("doc_id", "line", "family", "probability", "similarity", (F.col("similarity") >= confirm).alias("confirmed"), "text")


def tell_tale(words: list[str], grams: list[str], confirm: float = CONFIRM) -> set[str]:
    """Words of a template, the longest first, without which fewer than ``confirm`` of its n-grams are left: a text
    that has none of them can't hold the notice."""
    chosen: set[str] = set()
    for word in sorted(set(words), key=lambda w: (-len(w), w)):
        if grams and sum(chosen.isdisjoint(g.split(" ")) for g in grams) / len(grams) < confirm:      # as similarity is compared
            break
        chosen.add(word)
    return chosen


def wrapped(docs: DataFrame, model: Model, confirm: float = CONFIRM) -> DataFrame:
    """``doc_id, line, last_line, family, probability, similarity, confirmed`` for each notice whose words are
    spread over neighbouring lines and hold ``confirm`` of a template's n-grams."""
    spark = docs.sparkSession
    t = templates(spark).withColumn("_w", _words(F.col("text"))).withColumn("_all", F.array_distinct(_grams(F.col("_w"))))
    known = t.select("template", "family", F.size("_w").alias("n"), F.size("_all").alias("m"), F.explode("_all").alias("g"))
    # with CONFIRM of its n-grams a template of four words or more has a triple, a shorter one a pair
    rare = [r["g"] for r in known.where((F.size(F.split("g", " ")) == 3) | (F.col("n") < 4)).select("g").distinct().collect()]
    # zipped, as the optimizer may put the word array in place of its name: inside a lambda it would be made for each word
    w = _words(F.col("text"))
    zipped = F.arrays_zip(w.alias("a"), F.slice(w, 2, F.size(w)).alias("b"), F.slice(w, 3, F.size(w)).alias("c"))
    near_words = F.concat(F.transform(zipped, lambda x: F.concat_ws(" ", x["a"], x["b"])), F.transform(zipped, lambda x: F.concat_ws(" ", x["a"], x["b"], x["c"])))
    # one lookup a word settles the texts without any tell-tale word; the n-grams of the others are made
    tell = sorted(set().union(*(tell_tale(r["_w"], r["_all"], confirm) for r in t.select("_w", "_all").collect())))
    has_tell = F.arrays_overlap(w, F.array(*[F.lit(x) for x in tell]))
    d = docs.select("doc_id", "text").where(F.col("text").contains("\n") & has_tell & F.arrays_overlap(near_words, F.array(*[F.lit(g) for g in sorted(rare)])))
    own = ["doc_id", "_h1", "_h2"]
    a = F.flatten(F.transform(F.split("text", "\n"), lambda x, i: F.transform(_words(x), lambda w: F.struct(i.alias("line"), w.alias("w")))))
    d = d.select("doc_id", F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), "text").alias("_h2"), a.alias("_a")).dropDuplicates(own)
    places = F.arrays_zip(F.col("_a").alias("a"), F.slice("_a", 2, F.size("_a")).alias("b"), F.slice("_a", 3, F.size("_a")).alias("c"))
    p = d.where(F.size("_a") > 1).select(*own, F.posexplode(places).alias("pos", "x")).select(*own, "pos", "x.a", "x.b", "x.c")
    near = F.col("b.line") - F.col("a.line") <= 1             # no blank line between
    near3 = near & (F.col("c.line") - F.col("b.line") <= 1)
    two = F.when(near, F.struct(F.concat_ws(" ", "a.w", "b.w").alias("g"), F.col("b.line").alias("last")))
    three = F.when(near3, F.struct(F.concat_ws(" ", "a.w", "b.w", "c.w").alias("g"), F.col("c.line").alias("last")))
    # neighbouring lines with words are one block
    jump = F.when(F.col("a.line") - F.lag("a.line").over(Window.partitionBy(*own).orderBy("pos")) > 1, 1).otherwise(0)
    p = p.withColumn("block", F.sum(jump).over(Window.partitionBy(*own).orderBy("pos")))
    p = p.select(*own, "block", "pos", F.col("a.line").alias("line"), F.explode(F.array_compact(F.array(two, three))).alias("x"))
    hit = p.select(*own, "block", "pos", "line", "x.last", "x.g").join(F.broadcast(known), "g")
    spot = [*own, "block", "template"]
    ahead = lambda n: Window.partitionBy(*spot).orderBy("pos").rangeBetween(0, n)
    longest = int(REACH * max(r["n"] for r in t.select(F.size("_w").alias("n")).collect()))
    within = F.collect_list(F.struct("pos", "g", "last")).over(ahead(longest))
    hit = hit.withColumn("_x", F.filter(within, lambda x: x["pos"] < F.col("pos") + F.floor(F.col("n") * REACH)))
    hit = hit.withColumn("_all", F.transform("_x", lambda x: x["g"])).withColumn("_g", F.array_distinct("_all"))
    hit = hit.withColumn("similarity", F.size("_g") / F.col("m")).where(F.col("similarity") >= confirm)
    # up to where the last of the n-grams is first met
    hit = hit.withColumn("_x", F.filter("_x", lambda x, i: F.array_position("_all", x["g"]) == i + 1))
    hit = hit.withColumn("end", F.array_max(F.transform("_x", lambda x: x["pos"]))).withColumn("last_line", F.array_max(F.transform("_x", lambda x: x["last"])))
    # of a template's places whose words overlap the likest, of equals the shortest and then the first
    order = Window.partitionBy(*own, "template").orderBy("pos", "end", "g")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    hit = hit.withColumn("_new", F.when(reached >= F.col("pos"), 0).otherwise(1)).withColumn("_part", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    likest = Window.partitionBy(*own, "template", "_part").orderBy(F.desc("similarity"), F.col("end") - F.col("pos"), "pos", "g")
    best = hit.withColumn("_r", F.row_number().over(likest)).where("_r = 1").select(*own, "template", "family", "_part", "pos", "end", "line", "last_line", "similarity", "_g")
    # of templates that hold for the same words (half of them or more) the likest, of equals the first
    keys = [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in own]
    likelier = F.expr("y.similarity > x.similarity or (y.similarity = x.similarity and y.template < x.template)")
    common = F.expr("2 * (least(x.end, y.end) - greatest(x.pos, y.pos)) >= least(x.end - x.pos, y.end - y.pos)")
    best = best.alias("x").join(best.alias("y"), keys[0] & keys[1] & keys[2] & likelier & common, "left_anti").where("last_line > line")
    weights = F.broadcast(model.table(spark))
    z = best.select(*own, "template", "family", "_part", "line", "last_line", "similarity", F.explode("_g").alias("gram")).join(weights, "gram", "left")
    z = z.groupBy(*own, "template", "family", "_part", "line", "last_line", "similarity").agg(
        F.array(*[F.coalesce(F.sum(F.get("w", k)), F.lit(0.0)) + x for k, x in enumerate(model.bias)]).alias("_z"))
    at = F.array_position(F.array(*[F.lit(c) for c in model.classes]), F.col("family")) - 1
    return z.select("doc_id", "line", "last_line", "family", _likelihood(F.col("_z"), at, model.temperature).alias("probability"),
                    "similarity", F.lit(True).alias("confirmed"))


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs)
    one = scan(docs, model).withColumn("last_line", F.col("line"))
    return (one.drop("text").unionByName(wrapped(docs, model))
            .select("doc_id", "line", "last_line", "family", F.round("probability", 6).alias("probability"), "similarity", "confirmed"))
