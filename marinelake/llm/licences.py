"""Licence notices in paragraphs, in DataFrame functions and Spark's own regression.

A sparse multinomial logistic regression over word n-grams is trained on notices of
each licence family, embedded in paragraphs of the corpus, against other paragraphs.
Its probabilities are calibrated on held-out rows; what stays below the calibrated
bar, or is confirmed by no template of the predicted family, is ``unknown``.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marinelake.llm.common import kept_table, text_rows
from marinelake.llm.registry import query, table

#: Documents whose paragraphs are the training background, about, and paragraphs
#: taken from them at most: the bound on the training sample.
SAMPLED_DOCUMENTS = 1500
BACKGROUND = 4000
#: Word n-grams that the model may use, at most.
MAX_GRAMS = 4000
#: Share of background paragraphs above which an n-gram says nothing about licences.
COMMON = 0.002
#: False alarms among held-out background paragraphs that the bar allows.
FALSE_ALARMS = 0.002
#: Share of a template's n-grams that confirm it.
CONFIRMED = 0.6
NONE, UNKNOWN = "none", "unknown"

# Notices of licence families, and sentences that only look like them.
TEMPLATES = {
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction.',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ],
    "mpl": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Published under the Creative Commons Attribution license.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike license.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "SPDX-License-Identifier: CC0-1.0",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": [
        "All rights reserved.",
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher.",
        "This software is proprietary and confidential; unauthorized copying is prohibited.",
    ],
}
LOOK_ALIKES = [
    "He lost his driving license on the way to the public house.",
    "The general public was free to modify its opinion.",
    "A poetic license is not granted to every author.",
    "The license plate of the car was found in the source of the river.",
    "Students may redistribute their time under the terms of the school.",
    "The version of the story released last year was published by a small house.",
    "She reserved the right table for all guests.",
    "The Apache helicopter landed near the common.",
    "MIT researchers released a study about software.",
    "Creative people commonly work in public places.",
    "Permission to enter the domain was granted by the person in charge.",
    "The fishing license costs four dollars and the permission of the owner.",
]


def _with_grams(df: DataFrame, content: str) -> DataFrame:
    """``grams``: distinct words, pairs and triples of words, in small letters. The words
    are a column of their own, for a lambda would cut the text anew in every step. For
    the same reason rows are exploded by ``explode_outer``: from the inner kind Spark
    derives a filter on the array, which it evaluates below, without that column."""
    words = F.col("words")
    df = df.withColumn("words", F.regexp_extract_all(F.lower(content), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))

    def runs(n: int) -> Column:
        # Shorter than n: the whole once more, which array_distinct takes away.
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))

    return df.withColumn("grams", F.array_distinct(F.concat(words, runs(2), runs(3)))).drop("words")


def paragraphs(rows: DataFrame) -> DataFrame:
    """``doc_id, paragraph, content``: the lines of each text that hold a word, numbered from 0."""
    lines = rows.select("doc_id", F.posexplode(F.split("text", r"\R")).alias("paragraph", "content"))
    return lines.where(F.col("content").rlike(r"[\p{L}\p{N}]"))


def _local(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows of fixed values as a frame."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _training_rows(docs: DataFrame) -> DataFrame:
    """``content, label, held_out``: templates alone and inside background paragraphs,
    look-alikes, and background. Background paragraphs that name licences are left out."""
    spark, n = docs.sparkSession, max(docs.count(), 1)
    share = int(min(1.0, SAMPLED_DOCUMENTS / n) * (1 << 20))
    sample = paragraphs(docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share)).select("content").distinct()
    plain = sample.where(~F.lower("content").rlike(r"licen[sc]|copyright|rights reserved|public domain|spdx"))
    background = kept_table(plain.orderBy(F.xxhash64("content"), "content").limit(BACKGROUND), "background")
    notices = [{"i": i, "notice": t, "label": f} for i, (f, t) in enumerate((f, t) for f, own in TEMPLATES.items() for t in own)]
    fixed = _local(spark, notices, "i:int,notice:string,label:string")
    place = F.pmod(F.xxhash64("content", F.lit(1)), F.lit(2 * len(notices))).cast("int")
    carriers = background.withColumn("i", place).where(F.col("i") < len(notices))
    cut = F.split("content", " ")
    head = F.array_join(F.slice(cut, F.lit(1), F.least(F.size(cut), F.lit(12))), " ")
    embedded = carriers.join(F.broadcast(fixed), "i").select(F.concat_ws(" ", head, "notice").alias("content"), "label")
    others = _local(spark, [{"content": t} for t in LOOK_ALIKES], "content:string").select("content", F.lit(NONE).alias("label"))
    rows = embedded.union(background.select("content", F.lit(NONE))).union(others)
    held = F.pmod(F.xxhash64("content", F.lit(2)), F.lit(4)) == 0
    rows = rows.select("content", "label", held.alias("held_out"))
    return rows.union(fixed.select(F.col("notice"), "label", F.lit(False))).union(fixed.select(F.col("notice"), "label", F.lit(False)))


class LicenceModel:
    """Weights per n-gram, intercepts, temperature and bar; all of fixed size."""

    def __init__(self, labels, weights, intercepts, temperature, bar):
        self.labels, self.weights, self.intercepts = labels, weights, intercepts
        self.temperature, self.bar = temperature, bar


def train_licences(docs: DataFrame) -> LicenceModel:
    """Train on ``docs`` (``doc_id, text``); also works where there is no background at all."""
    rows = _with_grams(_training_rows(docs), "content")
    labels = [*TEMPLATES, NONE]
    label = F.array_position(F.array(*map(F.lit, labels)), F.col("label")).cast("double") - 1
    rows = kept_table(rows.withColumn("y", label), "licence-training")
    of_template = rows.where("y < %d" % len(TEMPLATES)).select(F.explode_outer("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    negative = rows.where(F.col("label") == NONE)
    total = negative.count()
    common = negative.select(F.explode_outer("grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > max(3.0, COMMON * total))
    notices = _local(docs.sparkSession, [{"t": t} for own in TEMPLATES.values() for t in own], "t:string")
    known = _with_grams(notices, "t").select(F.explode_outer("grams").alias("gram")).distinct()
    chosen = of_template.join(known, "gram", "left_semi").join(common, "gram", "left_anti").orderBy(F.desc("n"), "gram").limit(MAX_GRAMS)
    vocabulary = [r["gram"] for r in chosen.collect()]  # at most MAX_GRAMS
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, "grams", "features").setBinary(True).transform(rows)
    learner = LogisticRegression(featuresCol="features", labelCol="y", family="multinomial", regParam=0.002, elasticNetParam=0.2, maxIter=60)
    model = learner.fit(vectors.where("not held_out").select("features", "y"))
    scored = model.transform(vectors.where("held_out").select("features", "y"))
    held = [(r["z"], int(r["y"])) for r in scored.select(vector_to_array("rawPrediction").alias("z"), "y").collect()]  # bounded as the sample
    seen = model.coefficientMatrix.toArray().T.tolist()
    classes = len(model.interceptVector)
    weights = [{"gram": g, "w": [*w, *[0.0] * (len(labels) - classes)]} for g, w in zip(vocabulary, seen)]
    intercepts = [*model.interceptVector.toArray().tolist(), *[0.0] * (len(labels) - classes)]
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=lambda t: sum(-_log_share(z, y, t) for z, y in held if y < len(z)))
    alarms = sorted(1 - math.exp(_log_share(z, len(labels) - 1, temperature)) for z, y in held if y == len(labels) - 1 and y < len(z))
    bar = max(0.5, alarms[min(len(alarms) - 1, int((1 - FALSE_ALARMS) * len(alarms)))]) if alarms else 0.5
    return LicenceModel(labels, weights, intercepts, temperature, min(bar, 0.95))


def _log_share(z: list[float], y: int, temperature: float) -> float:
    top = max(z)
    return (z[y] - top) / temperature - math.log(sum(math.exp((v - top) / temperature) for v in z))


def scan_licences(docs: DataFrame, model: LicenceModel | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, paragraph, license, probability, similarity, content`` of every paragraph
    that is more likely a licence notice than none.

    ``paragraph`` is the number of the line in the whole text, ``license`` a family or
    ``unknown``, ``probability`` that of the likeliest family, ``similarity`` the share
    of its best template that the paragraph holds. Paragraphs without an n-gram of the
    model have the intercepts' prediction, ``none``, and drop out. Null and empty texts
    have no paragraphs; rows that agree in id and text are reported once."""
    rows = text_rows(docs, doc_id, text)
    spark = docs.sparkSession
    model = model or train_licences(rows)
    weights = F.broadcast(kept_table(_local(spark, model.weights, "gram:string,w:array<double>"), "licence-weights"))  # at most MAX_GRAMS rows
    grams = _with_grams(paragraphs(rows), "content").select("doc_id", "paragraph", "content", F.explode_outer("grams").alias("gram"))
    hits = grams.join(weights, "gram").select("doc_id", "paragraph", "content", "gram", "w").distinct()
    hits = kept_table(hits, "licence-hits")
    paragraph = ["doc_id", "paragraph", "content"]
    sums = [F.sum(F.col("w")[i]).alias(f"z{i}") for i in range(len(model.labels))]
    z = hits.groupBy(*paragraph).agg(*sums)
    logits = F.array(*((F.col(f"z{i}") + b) / model.temperature for i, b in enumerate(model.intercepts)))
    odds = F.transform(F.col("logits"), lambda x: F.exp(x - F.array_max("logits")))
    total = F.aggregate("odds", F.lit(0.0), lambda a, x: a + x)
    scored = z.withColumn("logits", logits).withColumn("odds", odds).withColumn("p", F.transform("odds", lambda x: x / total))
    families = F.slice("p", 1, len(model.labels) - 1)
    best = F.array_position(families, F.array_max(families))
    scored = scored.select(*paragraph, F.element_at(F.array(*map(F.lit, model.labels)), best.cast("int")).alias("family"), F.array_max(families).alias("probability"), F.element_at("p", -1).alias("p_none"))
    likely = scored.where("p_none < 0.5")
    templates = _local(spark, [{"t": i, "notice": n, "family": f} for i, (f, n) in enumerate((f, n) for f, own in TEMPLATES.items() for n in own)], "t:int,notice:string,family:string")
    parts = _with_grams(templates, "notice").select("t", "family", F.explode_outer("grams").alias("gram")).join(weights.select("gram"), "gram")
    parts = parts.join(parts.groupBy("t").agg(F.count(F.lit(1)).alias("size")), "t")
    parts = F.broadcast(kept_table(parts, "licence-templates"))  # the fixed templates only
    shared = hits.select(*paragraph, "gram").join(parts, "gram").groupBy(*paragraph, "family", "t", "size").agg(F.count(F.lit(1)).alias("n"))
    similar = shared.groupBy(*paragraph, "family").agg(F.max(F.col("n") / F.col("size")).alias("similarity"))
    same = [likely[c].eqNullSafe(similar[c]) for c in [*paragraph, "family"]]
    joined = likely.join(similar, same, "left").select(*(likely[c] for c in [*paragraph, "family", "probability"]), F.coalesce(similar["similarity"], F.lit(0.0)).alias("similarity"))
    sure = (F.col("probability") >= model.bar) & (F.col("similarity") >= CONFIRMED)
    return joined.select("doc_id", "paragraph", F.when(sure, F.col("family")).otherwise(UNKNOWN).alias("license"), "probability", "similarity", "content")


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))
