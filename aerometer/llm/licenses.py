"""License scans: a trained paragraph classifier whose finds templates confirm.

A paragraph is a line, or a line with up to WRAPPED - 1 lines that follow it without a blank one
between: notices are often wrapped. A sparse multinomial logistic regression over hashed word 1- to
3-grams tells license families from `unknown`; its confidence is calibrated on rows kept apart; a
family counts only if a template of it is found in the paragraph as well, and in several lines only
if the first of them is needed for that. Everything is built from DataFrame functions and JVM
transforms.

The classifier sees only paragraphs that a template could confirm: to hold a share `FOUND` of a
template's word pairs a paragraph must hold one of its anchor words, chosen so that the pairs without
any are fewer than that share. What the anchors pass over is therefore unknown by definition.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer.llm.common import text_of, written

#: Notices by license family, written out as they are used in files and pages.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license.", "This project is licensed under the terms of the MIT license.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Released under the Apache 2.0 license.",
                   "You may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS"],
    "BSD": ["Released under the BSD License.", "Licensed under the 3-Clause BSD License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 2.",
            "Released under the GPL.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
            "You should have received a copy of the GNU General Public License along with this program."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3.", "Released under the LGPL.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.", "Released under the AGPL."],
    "MPL": ["Licensed under the Mozilla Public License, version 2.0.",
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights to this work."],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "Released under the Unlicense."],
    "Proprietary": ["Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission.",
                    "This document is confidential and proprietary and may not be copied or distributed.",
                    "All rights reserved."],
}
#: Identifiers of the SPDX list by family, each a template of its own.
SPDX = {
    "MIT": ["MIT", "MIT-0"], "Apache-2.0": ["Apache-2.0"], "BSD": ["0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause"],
    "GPL": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "LGPL": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"], "MPL": ["MPL-1.1", "MPL-2.0"],
    "CC-BY": ["CC-BY-3.0", "CC-BY-4.0"], "CC-BY-SA": ["CC-BY-SA-3.0", "CC-BY-SA-4.0"], "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC-BY-ND": ["CC-BY-ND-4.0"], "CC0": ["CC0-1.0"], "ISC": ["ISC"], "Unlicense": ["Unlicense"],
}
for _family, _ids in SPDX.items():
    TEMPLATES[_family] += [f"SPDX-License-Identifier: {i}" for i in _ids]
#: Sentences with words of licenses that are none.
OTHERS = ["The driver was licensed in the city and drove the car home.", "Permission to enter the hall was granted by the guard.",
          "The museum released a copy of the old work.", "A new version of the software was released to the public.",
          "The general public may use the library without a fee.", "All rights of the people shall be law in the land.",
          "The source of the river is in the mountains.", "She works under the terms of a contract.", "The license plate of the car was red.",
          "He obtained a fishing license under the rules.", "The apache river runs under the bridge.", "Copies of the notice were distributed in the city.",
          "The warranty of the machine ended in May.", "A commercial break followed the show.", "MIT is a university near Boston."]
UNKNOWN = "unknown"
#: Share of a template's word pairs a paragraph must hold.
FOUND = 0.6
#: Lines of a wrapped paragraph at most.
WRAPPED = 4
#: Documents whose lines teach the unknown class, about, by hash.
SAMPLE_DOCS = 400
#: Variants made of each template; hashed features.
VARIANTS, HASHED = 24, 1 << 13
_LINE = "\n"
_WORDS = r"([\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*)"


def line_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(1))


def word_pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def plain_words(text: str) -> list[str]:
    """What line_words gives, for the templates."""
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def anchors(found: float = FOUND) -> list[str]:
    """Words one of which every paragraph holds that has a share `found` of some template's word pairs."""
    templates = [plain_words(t) for ts in TEMPLATES.values() for t in ts]
    use = {w: sum(w in t for t in templates) for t in templates for w in t}
    chosen: set[str] = set()
    # rare function words are poor anchors, so longer and then more shared words come first
    for t in templates:
        pairs = word_pairs(t)
        for w in sorted(set(t), key=lambda w: (w not in chosen, -min(len(w), 7), -use[w], w)):
            if sum(not chosen & set(p) for p in pairs) < found * len(pairs):
                break
            chosen.add(w)
    return sorted(chosen)


def anchor_pattern(found: float = FOUND) -> str:
    return r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(re.escape(w) for w in anchors(found)) + r")(?![\p{L}\p{N}])"


def paragraphs(docs: DataFrame, pattern: str | None = None) -> DataFrame:
    """doc_id, line (from 0), its text and that of its paragraph of several lines, and how many those are.

    Of all lines, or of those whose paragraph matches the pattern.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.where(F.col("text").rlike(pattern)) if pattern else rows
    lines = rows.select("doc_id", F.split("text", _LINE).alias("all")).select("doc_id", "all", F.posexplode("all").alias("line", "text"))
    # a blank line ends the paragraph
    joined = F.array_join(F.slice("all", F.col("line") + 1, F.lit(WRAPPED)), _LINE)
    lines = lines.select("doc_id", "line", "text", F.get(F.split(joined, r"\n\s*(?:\n|$)", 2), F.lit(0)).alias("wrapped"))
    lines = lines.withColumn("n_lines", F.size(F.split("wrapped", _LINE)).cast("long"))
    return lines.where(F.col("wrapped").rlike(pattern)) if pattern else lines


def featured(lines: DataFrame, text: str = "text", mark: str = "") -> DataFrame:
    """lines with columns words, pairs and features (hashed 1- to 3-grams) of a text; mark is added to the names."""
    df = lines.withColumn("words" + mark, line_words(F.col(text)))
    df = NGram(n=2, inputCol="words" + mark, outputCol="pairs" + mark).transform(df)
    df = NGram(n=3, inputCol="words" + mark, outputCol="_three").transform(df)
    df = df.withColumn("_grams", F.concat("words" + mark, "pairs" + mark, "_three"))
    return HashingTF(inputCol="_grams", outputCol="features" + mark, numFeatures=HASHED, binary=True).transform(df).drop("_grams", "_three")


@dataclass
class LicenseModel:
    """A fitted classifier, its families by class number and the calibration of its confidence."""

    classifier: LogisticRegressionModel
    families: list[str]
    steps: list[tuple[float, float]]


def training_rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(text, family, apart): variants of the templates with words left out or a line before them, and others.

    The unknown class is taught by the sentences listed and by lines of about SAMPLE_DOCS documents
    chosen by hash, those with anchor words left out (they may be licenses themselves).
    """
    n = docs.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE_DOCS / max(n, 1)))
    lines = paragraphs(docs.where(F.col("doc_id").isNotNull() & share)).where(~F.col("text").rlike(anchor_pattern()))
    around = written(lines.where(F.length("text") > 0).select("text", F.xxhash64("doc_id", "line").alias("h")), "license-lines")
    marked = [(f, t, f"{f}-{i}") for f, ts in TEMPLATES.items() for i, t in enumerate(ts)] + [(UNKNOWN, t, f"other-{i}") for i, t in enumerate(OTHERS)]
    made = spark.createDataFrame(marked, "family string, text string, name string").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("v")).withColumn("h", F.xxhash64("name", "v"))
    # every variant but the first leaves out about one word in twelve
    dropped = F.array_join(F.filter(F.split("text", " "), lambda w, i: (F.col("v") == 0) | (F.pmod(F.xxhash64("h", i), F.lit(12)) > 0)), " ")
    made = made.select("family", dropped.alias("text"), "v", "h")
    numbered = around.select(F.pmod("h", F.lit(97)).alias("slot"), F.col("text").alias("lead"))
    lead = numbered.groupBy("slot").agg(F.min("lead").alias("lead"))
    # a third of the variants follow some line, as they do in a paragraph of several lines
    made = made.withColumn("slot", F.when(F.col("v") % 3 == 2, F.pmod("h", F.lit(97)))).join(lead, "slot", "left").select(
        F.concat_ws(" ", "lead", "text").alias("text"), "family", (F.pmod(F.shiftright("h", 9), F.lit(4)) == 0).alias("apart"))
    return made.unionByName(around.select("text", F.lit(UNKNOWN).alias("family"), (F.pmod(F.shiftright("h", 9), F.lit(4)) == 0).alias("apart")))


def fit(spark: SparkSession, docs: DataFrame) -> LicenseModel:
    families = [UNKNOWN, *sorted(TEMPLATES)]
    number = F.create_map(*[F.lit(x) for i, f in enumerate(families) for x in (f, float(i))])
    rows = written(featured(training_rows(spark, docs).withColumn("label", number[F.col("family")])).select(
        "label", "features", "apart").repartition(6), "license-train")
    model = LogisticRegression(family="multinomial", regParam=2e-4, elasticNetParam=0.9, maxIter=40).fit(rows.where("NOT apart"))
    told = model.transform(rows.where("apart")).select(
        F.array_max(F.slice(vector_to_array("probability"), 2, len(families))).alias("p"),
        ((F.col("prediction") == F.col("label")) & (F.col("label") > 0)).cast("double").alias("right"))
    iso = IsotonicRegression(featuresCol="p", labelCol="right").fit(told)
    return LicenseModel(model, families, [(float(x), float(y)) for x, y in zip(iso.boundaries, iso.predictions)])


def calibrated(p: Column, steps: list[tuple[float, float]]) -> Column:
    case = F.when(p <= steps[0][0], F.lit(steps[0][1]))
    for (x0, y0), (x1, y1) in zip(steps, steps[1:]):
        case = case.when(p <= x1, F.lit(y0) + (p - x0) * ((y1 - y0) / (x1 - x0) if x1 > x0 else 0.0))
    return case.otherwise(F.lit(steps[-1][1]))


def judged(lines: DataFrame, model: LicenseModel, text: str, mark: str) -> DataFrame:
    """lines with told<mark>: the classifier's family of a text, its confidence and the family's best template.

    The template's struct holds likeness, the share of its pairs in the text, its name, and rest, the
    share without the words of the line itself (that share equals likeness where mark is empty).
    """
    df = model.classifier.copy({model.classifier.featuresCol: "features" + mark}).transform(featured(lines, text, mark))
    df = df.withColumn("probs", vector_to_array("probability")).drop("probability", "rawPrediction", "prediction", "features" + mark)
    df = df.withColumn("p", F.array_max(F.slice("probs", 2, len(model.families))))
    df = df.withColumn("guess", F.get(F.array(*[F.lit(f) for f in model.families]), (F.array_position("probs", F.col("p")) - 1).cast("int")))
    templates = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(f"{f}-{i}").alias("name"),
                                   F.array(*[F.lit(" ".join(p)) for p in sorted(word_pairs(plain_words(t)))]).alias("pairs"))
                          for f, ts in TEMPLATES.items() for i, t in enumerate(ts)])
    pairs = F.col("pairs" + mark)
    after = F.slice(pairs, F.size("words") + 1, F.greatest(F.size(pairs), F.lit(1))) if mark else pairs
    share = lambda t, held: F.size(F.array_intersect(t["pairs"], held)) / F.size(t["pairs"])
    df = df.withColumn("after", after).withColumn("best", F.array_max(F.transform(
        F.filter(templates, lambda t: t["family"] == F.col("guess")), lambda t: F.struct(
            share(t, pairs).alias("likeness"), t["name"].alias("name"), share(t, F.col("after")).alias("rest")))))
    return df.withColumn("told" + mark, F.struct(
        "guess", calibrated(F.col("p"), model.steps).alias("confidence"), F.col("best.name").alias("template"),
        F.col("best.likeness").alias("likeness"), F.col("best.rest").alias("rest"))).drop(
        "probs", "p", "guess", "best", "after", *(["words" + mark, "pairs" + mark] if mark else ["pairs"]))


def scan(docs: DataFrame, model: LicenseModel | None = None, found: float = FOUND) -> DataFrame:
    """Every line that holds a license anchor or begins a wrapped notice, with the family it is classified as.

    Returns doc_id, line, n_lines (of the paragraph judged: 1, or as many as a notice is wrapped over,
    WRAPPED at most), family (`unknown` where the calibrated confidence is below one half or no
    template confirms it), guess (the classifier's family), confidence, template (name of the best of
    that family) and likeness (share of its word pairs found). A line that is a notice by itself is
    judged alone, any other with the lines behind it. Null and empty texts, and lines without an
    anchor, have no row; texts and lines of any length are read whole; repeated rows are scanned each;
    an empty table gives no rows.
    """
    spark = docs.sparkSession
    model = model or fit(spark, docs)
    pattern = anchor_pattern(found)
    lines = paragraphs(docs, pattern).withColumn("anchored", F.col("text").rlike(pattern))
    # written, as a filter on what is told would be pushed below the classifier and repeat it for each use
    lines = written(judged(judged(lines, model, "text", ""), model, "wrapped", "_wrapped").select(
        "doc_id", "line", "n_lines", "anchored", "told", "told_wrapped"), "license-told")
    sure = lambda t: F.coalesce((t["confidence"] >= 0.5) & (t["likeness"] >= found), F.lit(False))
    alone, wrapped = F.col("told"), F.col("told_wrapped")
    spread = ~sure(alone) & (F.col("n_lines") > 1) & sure(wrapped) & (wrapped["rest"] < found)
    lines = lines.withColumn("spread", spread).where(F.col("spread") | F.col("anchored"))
    told = F.when(F.col("spread"), wrapped).otherwise(alone)
    return lines.withColumn("as", told).select(
        "doc_id", F.col("line").cast("long").alias("line"), F.when(F.col("spread"), F.col("n_lines")).otherwise(F.lit(1).cast("long")).alias("n_lines"),
        F.when(sure(F.col("as")), F.col("as.guess")).otherwise(F.lit(UNKNOWN)).alias("family"),
        "as.guess", "as.confidence", "as.template", "as.likeness")
