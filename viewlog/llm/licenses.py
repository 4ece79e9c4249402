"""License scan: a trained paragraph classifier confirmed by template comparison.

A multinomial logistic regression over sparse word n-grams (presence of words
and word pairs) tells licence families and "unknown" apart. It is trained on
windows of the family templates and on the paragraphs of a bounded sample of
documents, labelled by how much of a template they contain. Half of the rows
that are no whole templates are left out of the fit and calibrate the odds of
"known against unknown". A paragraph counts as a licence if its calibrated
probability is at least one half; it is confirmed if it shares enough word pairs
with a template of the predicted family.

Only DataFrame functions and Spark ML run. N-grams are features only if they hold
an anchor: a template word that is rare in the sample's other paragraphs. A
paragraph without any anchor has no features and hence the classifier's
constant answer for those, so all paragraphs are decided while only those with
an anchor are scored; nothing of the corpus is shuffled or collected. The
sample is ``sample_docs`` documents at most, the vocabulary follows the
templates.

Defined results: a null or empty text has no paragraphs; a paragraph is a line
that is not blank; repeated rows are separate documents with equal findings; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewlog.llm.common import once, written

# Licence families and the notices they are known by.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation.",
    ],
    "mpl-2.0": [
        "Released under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
}
# Sentences of other kinds, so that the unknown class is never without examples.
OTHERS = [
    "The meeting starts at nine and ends before lunch.",
    "All rights reserved by the organisers of the event.",
    "You need a driving licence to rent a car here.",
    "The public library opens its doors to any person free of charge.",
    "She read the terms of the contract and signed every copy.",
    "The software update fixes two errors in the file menu.",
    "His work was published by a small foundation in spring.",
    "Without further notice the conditions may change.",
]

SAMPLE_DOCS = 400
WINDOW_WORDS = (5, 8, 12, 20)
#: An anchor occurs in at most this share of the sample's other paragraphs.
ANCHOR_SHARE = 0.005
LABEL_OVERLAP = 0.8
CONFIRM_OVERLAP = 0.6
UNKNOWN = "unknown"


def paragraph_words(paragraph: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(paragraph), r"[^\p{L}\p{N}]+", " ")), " ")


def _pairs(words: Column) -> Column:
    return F.array_distinct(F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))),
                                       F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))),
                                       lambda a, b: F.concat(a, F.lit(" "), b)))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, line_no, words`` of every line with a letter or digit."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line_no", "line"))
    return once(rows, "words", paragraph_words(F.col("line"))).drop("line").where(F.col("words")[0] != "")


def _literal(value, schema: str) -> Column:
    """A constant of the plan, whatever its size here: templates and what follows from them."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def _template_rows(docs: DataFrame) -> DataFrame:
    """``family, template, words`` of every template."""
    rows = [{"family": f, "template": t} for f, ts in TEMPLATES.items() for t in ts]
    one = docs.sparkSession.range(1).select(F.explode(_literal(rows, "array<struct<family:string,template:string>>")).alias("r"))
    return one.select("r.family", "r.template", paragraph_words(F.col("r.template")).alias("words"))


def overlap(words: Column, template_words: Column) -> Column:
    """Shared word pairs, as a share of the template's or, for at least five, of the paragraph's."""
    own, other = _pairs(words), _pairs(template_words)
    both = F.size(F.array_intersect(own, other))
    return F.greatest(both / F.greatest(F.size(other), F.lit(1)),
                      F.when(F.size(own) >= 5, both / F.size(own)).otherwise(F.lit(0.0)))


def training_rows(docs: DataFrame, id_col: str, text_col: str, sample_docs: int) -> DataFrame:
    """``family, words, whole, weight``: template windows, labelled paragraphs of the sample, other sentences.

    Whole templates, together, weigh as much as all windows of their template;
    families weigh alike, and unknown as much as all families.
    """
    templates = _template_rows(docs)
    windows = [templates.select("family", "template", "words", F.lit(True).alias("whole"))]
    for n in WINDOW_WORDS:
        starts = F.sequence(F.lit(1), F.greatest(F.size("words") - n + 1, F.lit(1)))
        windows.append(templates.where(F.size("words") > n).select(
            "family", "template", F.explode(F.transform(starts, lambda i: F.slice("words", i, n))).alias("words"), F.lit(False).alias("whole")))
    own = windows[0]
    for w in windows[1:]:
        own = own.union(w)
    chosen = docs.orderBy(F.xxhash64(F.col(id_col)), F.col(id_col)).limit(sample_docs)
    seen = paragraphs(chosen, id_col, text_col).select("words").distinct()
    all_ = _literal([{"family": f, "template": t} for f, ts in TEMPLATES.items() for t in ts], "array<struct<family:string,template:string>>")
    shares = F.transform(all_, lambda r: F.struct(overlap(F.col("words"), paragraph_words(r["template"])).alias("share"), r["family"].alias("family")))
    near = seen.withColumn("best", F.array_max(shares))
    kind = F.lit("").alias("template")
    labelled = near.select(F.when(F.col("best.share") >= LABEL_OVERLAP, F.col("best.family")).when(F.col("best.share") < 0.3, F.lit(UNKNOWN)).alias("family"),
                           kind, "words", F.lit(False).alias("whole")).where("family is not null")
    others = docs.sparkSession.range(1).select(F.explode(_literal(OTHERS, "array<string>")).alias("t"))
    others = others.select(F.lit(UNKNOWN).alias("family"), kind, paragraph_words(F.col("t")).alias("words"), F.lit(True).alias("whole"))
    rows = written(own.union(labelled).union(others), "training")
    groups = rows.groupBy("family", "template", "whole").agg(F.count("*").alias("n"))
    parts = groups.groupBy("family").agg(F.count("*").alias("parts"))
    mass = F.when(F.col("family") == UNKNOWN, F.lit(float(len(TEMPLATES)))).otherwise(F.lit(1.0))
    rows = rows.join(groups, ["family", "template", "whole"]).join(parts, "family")
    return written(rows.select("family", "words", "whole", (100 * mass / F.col("parts") / F.col("n")).alias("weight")), "training")


class Classifier:
    """The fitted model: anchors, vocabulary, regression, calibration."""

    def __init__(self, training: DataFrame) -> None:
        self.families = [UNKNOWN, *sorted(TEMPLATES)]
        unknown = training.where(F.col("family") == UNKNOWN)
        n_unknown = unknown.count()
        common = {r["w"] for r in unknown.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").count()
                  .where(F.col("count") > max(1.0, ANCHOR_SHARE * n_unknown)).collect()}  # words of the bounded sample
        known = training.where(F.col("family") != UNKNOWN).select(F.explode("words").alias("w")).distinct().collect()
        self.anchors = sorted({r["w"] for r in known} - common)
        grams = training.where(F.col("family") != UNKNOWN).select(F.explode(self.grams(F.col("words"))).alias("g")).distinct()
        self.vocabulary = sorted(r["g"] for r in grams.collect())
        self.counts = CountVectorizerModel.from_vocabulary(self.vocabulary, "grams", "features")
        self.counts.setBinary(True)
        label = F.lit(0)
        for i, f in enumerate(self.families):
            label = F.when(F.col("family") == f, F.lit(i)).otherwise(label)
        rows = self.featured(training.withColumn("label", label.cast("double")))
        part = F.pmod(F.xxhash64(F.concat_ws(" ", "words")), F.lit(2))
        rows = rows.withColumn("part", part).orderBy("label", F.concat_ws(" ", "words"), "weight").coalesce(1)
        fit = LogisticRegression(family="multinomial", regParam=0.0005, maxIter=100, standardization=False, weightCol="weight")
        self.model = fit.fit(rows.where("whole or part = 0"))
        odds = self.odds(rows.where("not whole and part = 1")).withColumn("y", (F.col("label") > 0).cast("double"))
        odds = VectorAssembler(inputCols=["z"], outputCol="x").transform(odds.select("z", "y"))
        self.scale, self.shift = 1.0, 0.0
        if odds.select("y").distinct().count() == 2:
            platt = LogisticRegression(featuresCol="x", labelCol="y", regParam=0.01, standardization=False).fit(odds)
            self.scale, self.shift = float(platt.coefficients[0]), float(platt.intercept)

    def grams(self, words: Column) -> Column:
        """Words and word pairs that hold an anchor."""
        anchors = _literal(self.anchors, "array<string>")
        pairs = F.filter(_pairs(words), lambda g: F.arrays_overlap(F.split(g, " "), anchors))
        return F.concat(F.array_intersect(words, anchors), pairs)

    def featured(self, rows: DataFrame) -> DataFrame:
        return self.counts.transform(once(rows, "grams", self.grams(F.col("words"))))

    def odds(self, rows: DataFrame) -> DataFrame:
        """Adds the best family ``best`` and ``z``, the log odds of any family against unknown."""
        out = once(self.model.transform(rows), "p", vector_to_array("probability"))
        known = F.slice("p", 2, len(self.families) - 1)
        best = F.array_position(known, F.array_max(known)).cast("int") + 1
        names = F.array(*(F.lit(f) for f in self.families))
        unknown = F.greatest(F.col("p")[0], F.lit(1e-12))
        return out.withColumn("best", F.element_at(names, best)).withColumn("z", F.log(F.greatest(1 - F.col("p")[0], F.lit(1e-12)) / unknown))

    def probability(self, z: Column) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.scale) * z + F.lit(self.shift))))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per licence paragraph: ``doc_id, line_no, family, probability, template_overlap, confirmed``."""
    model = Classifier(training_rows(docs, id_col, text_col, sample_docs))
    anchors = _literal(model.anchors, "array<string>")
    rows = paragraphs(docs, id_col, text_col).where(F.arrays_overlap("words", anchors))
    found = model.odds(model.featured(rows)).withColumn("probability", F.round(model.probability(F.col("z")), 6)).where("probability >= 0.5")
    by_family = _literal([{"family": f, "templates": ts} for f, ts in TEMPLATES.items()], "array<struct<family:string,templates:array<string>>>")
    own = F.filter(by_family, lambda t: t["family"] == F.col("best"))[0]["templates"]
    share = F.array_max(F.transform(own, lambda t: overlap(F.col("words"), paragraph_words(t))))
    return once(found, "template_overlap", F.round(share, 6)).select(
        "doc_id", "line_no", F.col("best").alias("family"), "probability", "template_overlap",
        (F.col("template_overlap") >= CONFIRM_OVERLAP).alias("confirmed"))
