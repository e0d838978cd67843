"""Licence scans: a trained paragraph classifier over word n-grams.

A multinomial logistic regression with an L1 penalty learns licence families
and an unknown class from the sentences of the templates below (whole and in
windows) and from all distinct ordinary paragraphs of the input. Its features
are the n-grams of the templates, as no other can speak for a family, so the
model has a fixed size; ordinary paragraphs with the same n-grams are one
training row that weighs as much as they do. Scanning is DataFrame code only:
the features of each distinct paragraph are counted once, and every one gets
the probabilities of the families. A family is reported when its probability passes a threshold
calibrated on all held-out ordinary paragraphs, a fifth, and confirmed when the
paragraph's word trigrams are contained in one of the family's templates.

A paragraph is a line of the text. Defined cases: null and empty texts give no
rows; null ids are carried; rows that repeat an id are told apart by a row
number and scanned each; other columns are ignored; without ordinary paragraphs
the threshold is `LEAST`.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vigil.llm.common import stage, unstage

LEAST, MOST, FALSE_SHARE = 0.6, 0.95, 0.001   # lowest and highest threshold; share of held-out ordinary paragraphs allowed above it
STEPS = 1000                                  # the threshold is a multiple of 1 / STEPS
CONFIRMED = 0.5
UNKNOWN = "unknown"

#: Fixed texts: notices by which licences of each family are commonly declared.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "This project is licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
            "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."],
    "Apache": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: Apache-2.0",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2 or later.", "SPDX-License-Identifier: GPL-3.0-or-later",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["This library is licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: LGPL-2.1-only",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License."],
    "BSD": ["Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "MPL": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.", "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC": ["Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
           "Content is available under the Creative Commons Attribution-ShareAlike License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "PublicDomain": ["This is free and unencumbered software released into the public domain.", "To the extent possible under law, the author has waived all copyright under CC0 1.0 Universal.", "SPDX-License-Identifier: CC0-1.0"],
    "Proprietary": ["All rights reserved.", "Copyright (c) 2020 the company. All rights reserved.", "This document is proprietary and confidential; unauthorized copying is strictly prohibited."],
}


#: A character that is part of a word, whatever stands around it (a dot only between others).
WORD = r"(?i)[a-z0-9\x{80}-\x{10FFFF}]"


def words(text: Column) -> Column:
    """Lower-cased words of letters, digits and inner dots, an empty array for none."""
    clean = F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9.\x{80}-\x{10FFFF}]+|\.(?![a-z0-9])", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " +"))


def ngrams(tokens: Column, n: int) -> Column:
    """The word n-grams of an array of words, joined by one space."""
    if n == 1:
        return tokens
    place = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(place, lambda i: F.array_join(F.slice(tokens, i, n), " "))


def grams(tokens: Column) -> Column:
    """Features: words and pairs, as often as they stand there."""
    pairs = F.zip_with(tokens, F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, F.filter(pairs, lambda x: x.isNotNull()))


def paragraphs(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, paragraph, text) of the lines, numbered from 0; `row` tells rows apart that repeat an id, within one reading."""
    docs = df.select(F.monotonically_increasing_id().alias("row"), df[id_col].cast("long").alias("doc_id"), df[text_col].cast("string").alias("text"))
    lines = docs.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "text"))
    return lines.where(F.col("text").rlike(WORD))


def template_rows(spark: SparkSession) -> DataFrame:
    """(family, template, text)."""
    rows = [(f, i, t) for f, ts in TEMPLATES.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "family string, template int, text string")


def template_grams(spark: SparkSession) -> DataFrame:
    """(family, grams): templates whole, with other words before them and in windows of 8 words."""
    whole = template_rows(spark).withColumn("tokens", words(F.col("text")))
    windows = whole.where(F.size("tokens") > 12).select("family", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("tokens") - 7, F.lit(4)), lambda i: F.slice("tokens", i, 8))).alias("tokens"))
    # Licence lines with other words around them.
    framed = whole.join(F.broadcast(spark.createDataFrame([(p,) for p in ("", "notice", "please note that this file is", "see")], "p string")), F.lit(True)).select(
        "family", F.concat(F.split("p", " "), "tokens").alias("tokens"))
    return whole.select("family", "tokens").unionByName(windows).unionByName(framed).select("family", grams(F.col("tokens")).alias("grams"))


def counted(rows: DataFrame, counter: CountVectorizerModel) -> DataFrame:
    """`rows` with the features of their text."""
    return counter.transform(rows.withColumn("tokens", words(F.col("text"))).withColumn("grams", grams(F.col("tokens")))).drop("tokens", "grams")


def distinct_texts(lines: DataFrame, counter: CountVectorizerModel) -> DataFrame:
    """(h, plain, features) of the distinct texts, staged: `h` a hash of the text, `plain` whether it is ordinary."""
    plain = ~F.col("text").rlike(r"(?i)licen[sc]e|copyright|rights reserved|spdx|public domain|creative commons")
    texts = counted(lines.select(F.xxhash64("text").alias("h"), plain.alias("plain"), "text"), counter)
    return stage(texts.select("h", "plain", "features").distinct(), "texts")


def features(spark: SparkSession) -> tuple[CountVectorizerModel, DataFrame]:
    """What counts the n-grams of the templates, and `template_grams`."""
    known = stage(template_grams(spark).coalesce(1), "templates")  # some hundred rows
    vocabulary = sorted(r[0] for r in known.select(F.explode("grams")).distinct().collect())  # those of the templates above
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="features", binary=True), known


def train(counter: CountVectorizerModel, known: DataFrame, plain: DataFrame) -> tuple[LogisticRegressionModel, float]:
    """(model, threshold) from the templates and the ordinary texts (h, features).

    A fifth of the ordinary texts is held out; the threshold is the probability
    of a family that at most FALSE_SHARE of them reach. Texts with the same
    n-grams are one row that weighs as much as they do.
    """
    spark = plain.sparkSession
    ordinary = stage(plain.groupBy("features", (F.pmod("h", F.lit(5)) == 0).alias("held")).agg(F.count(F.lit(1)).alias("n")), "ordinary")
    size = ordinary.where("NOT held").agg(F.sum("n")).first()[0] or 1
    # A family's few rows weigh as much as a tenth of the ordinary ones. One row of no words, so that the unknown class is there without any ordinary paragraph.
    silent = spark.createDataFrame([(UNKNOWN, [])], "family string, grams array<string>")
    weight = F.lit(size / 10) / F.count(F.lit(1)).over(Window.partitionBy("family"))
    families = F.array(*map(F.lit, [*TEMPLATES, UNKNOWN]))
    fixed = counter.transform(known.unionByName(silent)).select("family", weight.alias("weight"), "features")
    some = ordinary.where("NOT held").select(F.lit(UNKNOWN).alias("family"), F.col("n").cast("double").alias("weight"), "features")
    fit = fixed.unionByName(some).select((F.array_position(families, F.col("family")) - 1).cast("double").alias("label"), "weight", "features")
    model = LogisticRegression(family="multinomial", weightCol="weight", regParam=2e-4, elasticNetParam=1.0, maxIter=50, standardization=False).fit(fit)
    steps = best_family(ordinary.where("held"), model).groupBy(F.floor(F.greatest("probability", F.lit(LEAST - 1 / STEPS)) * STEPS).alias("step")).agg(F.sum("n").alias("n")).collect()  # a row a step
    unstage(ordinary)
    allowed, above, threshold = FALSE_SHARE * sum(r["n"] for r in steps), 0, LEAST
    for r in sorted(steps, key=lambda r: -r["step"]):
        above += r["n"]
        if above > allowed:
            threshold = (r["step"] + 1) / STEPS
            break
    return model, max(LEAST, min(threshold, MOST))


def best_family(rows: DataFrame, model: LogisticRegressionModel) -> DataFrame:
    """`rows` with the best family that isn't unknown, and its probability."""
    rows = model.transform(rows).withColumn("p", vector_to_array("probability")).drop("rawPrediction", "prediction", "probability")
    named = F.slice("p", 1, len(TEMPLATES))
    rows = rows.withColumn("probability", F.array_max(named))
    return rows.withColumn("family", F.element_at(F.array(*map(F.lit, TEMPLATES)), F.array_position(named, F.col("probability")).cast("int"))).drop("p", "features")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph with a licence: doc_id, paragraph, family, probability, template, containment, confirmed, text."""
    spark = df.sparkSession
    lines = paragraphs(df, id_col, text_col)
    counter, known = features(spark)
    distinct = distinct_texts(lines, counter)
    model, threshold = train(counter, known, distinct.where("plain"))
    wanted = stage(best_family(distinct, model).where(F.col("probability") >= threshold).select("h").distinct(), "wanted")
    # The hash only chooses lines; what is reported is computed from the lines themselves.
    chosen = stage(lines.withColumn("h", F.xxhash64("text")).join(wanted, "h", "left_semi").drop("h"), "licences")
    unstage(known, distinct, wanted)
    texts = best_family(counted(chosen, counter), model).where(F.col("probability") >= threshold).withColumn("tokens", words(F.col("text")))
    shape = lambda t: F.array_distinct(F.when(F.size(t) >= 3, ngrams(t, 3)).otherwise(F.array(F.array_join(t, " "))))
    known = template_rows(spark).select("family", "template", shape(words(F.col("text"))).alias("known"))
    compared = texts.withColumn("own", shape(F.col("tokens"))).join(F.broadcast(known), "family")  # the templates above
    share = F.size(F.array_intersect("own", "known")) / F.least(F.size("own"), F.size("known"))
    key = ["row", "doc_id", "paragraph", "text", "family", "probability"]
    best = compared.groupBy(*key).agg(F.max(F.struct(share.alias("containment"), (-F.col("template")).alias("t"))).alias("best"))
    return best.select("doc_id", "paragraph", "family", F.round("probability", 6).alias("probability"), (-F.col("best.t")).alias("template"),
                       F.round("best.containment", 6).alias("containment"), (F.col("best.containment") >= CONFIRMED).alias("confirmed"), "text")


def op5_licence_scan(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
