"""Licence scan: a trained paragraph classifier that templates confirm.

A paragraph is a line of a text. Those of its words and word pairs that some template has are a sparse vector; a
multinomial logistic regression with an L1 part (so most weights are zero) names a licence family or ``unknown``. It is
trained on stretches of the templates (at least ``STRETCH`` of a notice) and, for ``unknown``, on all paragraphs of the
corpus but those that look like a template. Equal vectors are counted and go in once with that weight, which is the same
loss. A quarter of the unknown paragraphs, by a hash of their words, is held back to set the probability that a family must
exceed: none of them passes it. What passes is compared with the family's templates: the share of word triples that the
shorter side has in common must be ``CONFIRM``. Everything is DataFrame functions and Spark's own estimator; the
paragraphs are read once and their vectors written, for the fit, the probability and the scan.

Defined cases: a null or empty text has no paragraph; paragraphs of fewer than three words are unknown; rows are read one
by one, equal rows give equal results, null keys are kept; with no unknown paragraph only the templates are told apart and
the least probability is ``LEAST``; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

STRETCH, LEAST, CONFIRM = 0.6, 0.5, 0.6
#: A paragraph of this likeness to a template is no example of an unknown one.
ALIKE = 0.3

#: Notices as the licences' own instructions word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
FAMILIES = tuple(dict.fromkeys(family for family, _ in TEMPLATES))


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _triples(w: Column) -> Column:
    """Distinct word triples; all words as one where there are fewer."""
    size = F.size(w)
    return F.array_distinct(F.when(size < 3, F.array(F.xxhash64(w))).otherwise(F.transform(
        F.sequence(F.lit(0), F.greatest(size - 3, F.lit(0))), lambda i: F.xxhash64(F.slice(w, i + 1, 3)))))


def paragraphs(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``paragraph`` (from 0) and ``w`` of the lines with three words or more."""
    lines = docs.select(docs[key].alias("key"), F.posexplode(F.split(F.coalesce(docs[text], F.lit("")), "\n")).alias("paragraph", "line"))
    return lines.select("key", "paragraph", words(F.col("line")).alias("w")).where(F.size("w") >= 3)


def _likeness(w: Column, families: Column | None = None) -> Column:
    """Largest share of common triples with a template, of the given family or of any."""
    own = _triples(w)
    shares = []
    for family, notice in TEMPLATES:
        there = _triples(words(F.lit(notice)))
        share = F.size(F.array_intersect(own, there)) / F.least(F.size(own), F.size(there))
        shares.append(share if families is None else F.when(families == family, share).otherwise(0.0))
    return F.greatest(*shares)


def _template_grams(n: int) -> list[list[str]]:
    """Runs of ``n`` words of the templates, each once."""
    split = [re.findall("[a-z0-9]+", notice.lower()) for _, notice in TEMPLATES]
    return [list(g) for g in dict.fromkeys(tuple(w[i:i + n]) for w in split for i in range(len(w) - n + 1))]


def _features(rows: DataFrame) -> DataFrame:
    """Word pairs, then one sparse vector of the words and pairs that the templates have."""
    pairs = NGram(n=2, inputCol="w", outputCol="pairs").transform(rows)
    words_and_pairs = [" ".join(g) for n in (1, 2) for g in _template_grams(n)]
    vectors = CountVectorizerModel.from_vocabulary(words_and_pairs, inputCol="grams", outputCol="features").setBinary(True)
    return vectors.transform(pairs.withColumn("grams", F.concat("w", "pairs"))).drop("pairs", "grams")


def _read(docs: DataFrame, key: str, text: str) -> DataFrame:
    """All paragraphs, written: ``key``, ``paragraph``, ``features``, ``held`` (of the quarter held back), ``known`` (looks like a
    template) and ``w``, the words, where a word triple is a template's; elsewhere they are like no template and ``w`` is null."""
    triples = F.array(*[F.xxhash64(F.array(*[F.lit(w) for w in g])) for g in _template_grams(3)])
    rows = _features(paragraphs(docs, key, text)).withColumn("near", F.arrays_overlap(_triples(F.col("w")), triples))
    return written(rows.select(
        "key", "paragraph", "features", (F.pmod(F.xxhash64("w"), F.lit(4)) == 0).alias("held"),
        F.when(F.col("near"), _likeness(F.col("w")) >= ALIKE).otherwise(False).alias("known"), F.when(F.col("near"), F.col("w")).alias("w")), "paragraphs")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[LogisticRegressionModel, float]:
    """The classifier and the probability that a family must exceed."""
    return _train(_read(docs, key, text))


def _train(lines: DataFrame) -> tuple[LogisticRegressionModel, float]:
    spark = lines.sparkSession
    notices = spark.createDataFrame(TEMPLATES, "family string, notice string").select("family", words(F.col("notice")).alias("all"))
    starts = notices.select("family", "all", F.explode(F.sequence(F.lit(1), F.size("all"))).alias("a"))
    stretches = starts.select("family", "all", "a", F.explode(F.sequence(F.lit(1), F.size("all"))).alias("n")).where(
        (F.col("n") >= F.ceil(F.size("all") * STRETCH)) & (F.col("a") + F.col("n") - 1 <= F.size("all")) & (F.col("n") >= 3))
    known = _features(stretches.select("family", F.slice("all", F.col("a"), F.col("n")).alias("w"))).select("family", "features", F.lit(1).alias("n"))
    other = written(lines.where(~F.col("known")).groupBy("held", "features").agg(F.count(F.lit(1)).alias("n")), "unknown-vectors")
    rows = known.union(other.where(~F.col("held")).select(F.lit("unknown"), "features", "n"))
    share = rows.groupBy("family").agg(F.sum("n").alias("all"))
    names = F.array(*[F.lit(f) for f in (*FAMILIES, "unknown")])
    rows = written(rows.join(F.broadcast(share), "family").select(
        "features", (F.array_position(names, F.col("family")) - 1).cast("double").alias("label"), (1000.0 * F.col("n") / F.col("all")).alias("weight")), "licence-fit")
    model = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-3, elasticNetParam=0.5, maxIter=50).fit(rows)
    best = model.transform(other.where("held")).select(F.array_max(F.slice(vector_to_array("probability"), 1, len(FAMILIES))).alias("p"))
    top = best.agg(F.max("p")).first()[0]
    return model, max(LEAST, min(0.99, top or 0.0))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each paragraph that is not unknown: key, paragraph, family, probability, likeness and ``confirmed``."""
    lines = _read(docs, key, text)
    model, least = _train(lines)
    scored = model.transform(lines).select("key", "paragraph", "w", vector_to_array("probability").alias("p"))
    families = F.slice("p", 1, len(FAMILIES))
    named = scored.withColumn("probability", F.array_max(families)).where(F.col("probability") > least).withColumn(
        "family", F.get(F.array(*[F.lit(f) for f in FAMILIES]), (F.array_position(families, F.col("probability")) - 1).cast("int")))
    out = named.withColumn("likeness", F.when(F.col("w").isNull(), F.lit(0.0)).otherwise(_likeness(F.col("w"), F.col("family"))))
    return out.select(F.col("key").alias(key), "paragraph", "family", "probability", "likeness", (F.col("likeness") >= CONFIRM).alias("confirmed"))
