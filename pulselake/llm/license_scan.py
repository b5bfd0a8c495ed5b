"""License scans with a trained paragraph classifier.

Paragraphs (lines) become sparse counts of hashed word n-grams. A logistic
regression, trained here on public licence notices and on ordinary paragraphs
of the corpus, tells notices from ordinary text; a multinomial one, trained on
the notices, tells licence families apart. The probability of a family is the
product of both. A paragraph counts as unknown below a probability that is
calibrated on all ordinary paragraphs, and where ordinary text is likelier than
any family. A prediction is
confirmed by comparison with the notices: a notice must share enough of the
word pairs of the shorter one. Pairs of two function words tell nothing and do
not count, so a paragraph without any other word of a notice cannot be
confirmed; such paragraphs are left out before they are cut into words, and
neither trained on nor scored. The family is that of the notice that shares most, which tells families apart
that differ by a word; ties go to the predicted family, then to the first by name.

Training, scoring and comparison are DataFrame operations of Spark and its
machine-learning library; no Python runs on the executors. Every ordinary
paragraph that is scored is trained on too, equal ones once, and counts for the
calibration.

Results:

* one row for each input row, NULL and repeated ids included;
* NULL, empty and blank texts have no paragraphs and no licences;
* repeated findings in one document count each, families once;
* without ordinary paragraphs the model knows notices only;
* an empty table gives an empty table.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulselake.llm.common import stored

FEATURES = 2**15
# Share of ordinary paragraphs that may pass as licensed.
FALSE_SHARE = 0.0005
# Probabilities are told apart up to one part of so many.
STEPS = 1_000_000
# Weight of an ordinary paragraph in the fit, a notice having 1, and of all together: beyond it they share it, or notices
# would count for ever less.
ORDINARY_WEIGHT, ORDINARY_TOTAL = 0.5, 1500.0
# Paragraphs in a task of the fit.
FIT_ROWS = 200_000
SHARED_PAIRS = 0.6
ORDINARY = "none"

# Public licence notices by family: fixed values.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is licensed under the Apache License 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU General Public License v2.0.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License 2.0.",
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
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "reserved": [
        "All rights reserved.",
        "Copyright 2020 Example Corporation. All rights reserved.",
        "No part of this publication may be reproduced or transmitted without the prior written permission of the publisher.",
    ],
}
FAMILIES = (ORDINARY, *NOTICES)
# Words that notices share with any text: fixed values.
FUNCTION_WORDS = frozenset(
    "a all along an and any are at be by can copy do either for form free from has have if in into is it its may no not "
    "obtain of on one or other out part person project should subject that the these they this to use was with without "
    "work you your".split()
)


def words(text: Column) -> Column:
    """Lower-case words of letters, digits and inner dots, dashes or pluses."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.+-][\p{L}\p{N}]+)*"), F.lit(0))


def pairs(tokens: Column) -> Column:
    """Neighbouring words joined by a blank."""
    left = F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))
    right = F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1)))
    return F.zip_with(left, right, lambda a, b: F.concat_ws(" ", a, b))


def hashed(df: DataFrame) -> DataFrame:
    """Sparse n-gram counts ``features`` of ``words``."""
    grams = df.withColumn("grams", F.concat("words", pairs(F.col("words"))))
    return HashingTF(numFeatures=FEATURES, inputCol="grams", outputCol="features").transform(grams).drop("grams")


def notice_words(text: str) -> list[str]:
    """The same words as :func:`words` finds, for the notices."""
    return re.findall(r"[^\W_]+(?:[.+-][^\W_]+)*", text.lower())


def markers() -> list[str]:
    """Words of the notices other than function words."""
    return sorted({w for texts in NOTICES.values() for t in texts for w in notice_words(t)} - FUNCTION_WORDS)


def any_of(listed: list[str]) -> str:
    """A pattern for any of some words, by their common beginnings: a letter is tried once, not once for each word."""
    ends = {w[:1]: [v[1:] for v in listed if v[:1] == w[:1]] for w in listed}
    branches = [re.escape(first).replace("\\-", "-") + any_of(rest) for first, rest in ends.items() if first]
    if not branches:
        return ""
    return f"(?:{'|'.join(branches)}){'?' if '' in ends else ''}"


def may_be_licensed(line: Column) -> Column:
    """Whether a line holds a word that could confirm a notice."""
    listed = markers()
    first = "".join(sorted({re.escape(w[0]) for w in listed}))
    return F.lower(line).rlike(rf"(?<![\p{{L}}\p{{N}}])(?=[{first}]){any_of(listed)}(?![\p{{L}}\p{{N}}])")


def marks_of_families() -> list[tuple[str, list[str]]]:
    """Per family the words that no notice of another family has."""
    held = {f: {w for t in texts for w in notice_words(t)} for f, texts in NOTICES.items()}
    return [(f, sorted(own - set().union(*(o for g, o in held.items() if g != f)))) for f, own in held.items()]


def notices(spark: SparkSession) -> DataFrame:
    rows = [(family, text) for family, texts in NOTICES.items() for text in texts]
    return spark.createDataFrame(rows, "family string, notice string").withColumn("words", words(F.col("notice")))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``row``, ``place`` and ``line`` of every line with letters or digits."""
    lines = docs.select("row", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    return lines.where(F.col("line").rlike(r"[\p{L}\p{N}]"))


def telling_pairs(tokens: Column) -> Column:
    """The distinct word pairs (words, if there are none) that are not function words only."""
    common = sorted(FUNCTION_WORDS)
    left = F.slice(tokens, 1, F.greatest(F.size(tokens) - 1, F.lit(0)))
    right = F.slice(tokens, 2, F.greatest(F.size(tokens), F.lit(1)))
    told = F.zip_with(left, right, lambda a, b: F.when(~(a.isin(common) & b.isin(common)), F.concat_ws(" ", a, b)))
    single = F.filter(tokens, lambda w: ~w.isin(common))
    return F.array_distinct(F.when(F.size(tokens) > 1, F.array_compact(told)).otherwise(single))


def notice_pairs(text: str) -> list[str]:
    """The same pairs as :func:`telling_pairs` finds, for the notices."""
    tokens = notice_words(text)
    found = zip(tokens, tokens[1:], strict=False) if len(tokens) > 1 else zip(tokens, strict=False)
    return list(dict.fromkeys(" ".join(p) for p in found if not set(p) <= FUNCTION_WORDS))


def with_hits(lines: DataFrame, name: str) -> DataFrame:
    """``lines``, stored, with the number ``n_pairs`` of their telling pairs and the ``hits``, those of any notice."""
    listed = sorted({p for texts in NOTICES.values() for t in texts for p in notice_pairs(t)})
    graded = lines.withColumn("grams", telling_pairs(F.col("words")))
    hits = F.filter("grams", lambda p: p.isin(listed))
    return stored(graded.withColumn("n_pairs", F.size("grams")).withColumn("hits", hits).drop("grams"), name)


def against_notices() -> list[tuple[str, Column]]:
    """Family of each notice, and the share of pairs that it has in common with a line (see :func:`with_hits`)."""
    return [(f, shared_pairs(notice_pairs(t))) for f, texts in NOTICES.items() for t in texts]


def shared_pairs(notice: list[str]) -> Column:
    """Share of the pairs of the shorter text found in the other."""
    common = F.size(F.array_intersect("hits", F.array(*map(F.lit, notice))))
    shorter = F.greatest(F.least("n_pairs", F.lit(len(notice))), F.lit(1))
    return F.when(F.size("hits") > 0, common / shorter).otherwise(0.0)


def ordinary_words(candidates: DataFrame) -> DataFrame:
    """The distinct ``words`` of paragraphs that share less than half of their pairs with any notice."""
    distinct = candidates.select("words").distinct()
    graded = with_hits(distinct, "license-grams")
    # The notices are a fixed, short list; each line is held against all of them.
    like = F.greatest(*[share for _, share in against_notices()])
    return graded.where(like < 0.5).select("words")


def calibrated(scores: DataFrame) -> float:
    """Least probability, in whole steps, that all but the accepted share of the column ``p`` stay below."""
    step = F.least(F.floor(F.col("p") * STEPS), F.lit(STEPS - 1)).cast("long")
    # At most one row for each step.
    rows = scores.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    room = FALSE_SHARE * sum(r.n for r in rows)
    for r in sorted(rows, reverse=True):
        room -= r.n
        if room < 0:
            return (r.step + 1) / STEPS
    return 0.0


class Model:
    """Whether a paragraph is licensed, by one regression, and its family, by another on the features of the notices."""

    def __init__(self, notice: LogisticRegressionModel, family: LogisticRegressionModel, own: VectorSlicer):
        self.notice, self.family, self.own = notice, family, own

    def licensed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the probability ``licensed`` that they are no ordinary text."""
        made = ["rawPrediction", "probability", "prediction"]
        scored = self.notice.transform(rows)
        return scored.withColumn("licensed", F.element_at(vector_to_array("probability"), 2)).drop(*made)

    def families(self, rows: DataFrame) -> DataFrame:
        """``rows`` that one family fits better than ordinary text, with this ``family`` and its ``probability``."""
        scored = self.family.transform(self.own.transform(rows))
        place = F.col("prediction").cast("int") + 1
        likelihood = F.element_at(vector_to_array("probability"), place) * F.col("licensed")
        named = scored.select(
            *rows.columns,
            F.element_at(F.array(*[F.lit(f) for f in NOTICES]), place).alias("family"),
            likelihood.alias("probability"),
        )
        return named.where(F.col("probability") > 1 - F.col("licensed"))


def fitted(rows: DataFrame, kind: str, label: str, features: str = "features") -> LogisticRegressionModel:
    # All gradients of a task are sent in each step, so a task has many paragraphs.
    tasks = max(1, -(-rows.count() // FIT_ROWS))
    return LogisticRegression(
        family=kind, featuresCol=features, labelCol=label, regParam=0.0001, elasticNetParam=0.5, maxIter=60, weightCol="weight", standardization=False
    ).fit(rows.coalesce(tasks))


def train(spark: SparkSession, candidates: DataFrame) -> tuple[Model, float]:
    """A model, and the probability below which a paragraph is unknown, from the ``words`` of all paragraphs to score.

    Of each notice there are its whole text, its first two thirds and copies that
    lack every third or fifth word, but none that lacks all words by which the
    notice differs from other families. Ordinary paragraphs that share half of
    their pairs with a notice take no part; of all others equal ones count once, in
    the fit, where their weight together is bounded, and for the threshold.
    """
    labels = F.array(*[F.lit(f) for f in FAMILIES])
    given = notices(spark)
    size = F.size("words")
    drop = lambda n, r: F.filter("words", lambda w, i: i % n != r)
    variants = [F.col("words"), F.slice("words", 1, F.ceil(size * 2 / 3)), *[drop(3, r) for r in range(3)], *[drop(5, r) for r in range(5)]]
    positive = reduce(
        DataFrame.unionByName,
        [
            given.where((size > 4) | F.lit(k == 0)).select("family", F.col("words").alias("whole"), v.alias("words"))
            for k, v in enumerate(variants)
        ],
    )
    marks = F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)).cast("array<string>") for f in marks_of_families() for x in f])
    mark = F.array_intersect(marks[F.col("family")], F.col("whole"))
    positive = positive.where((F.size(mark) == 0) | F.arrays_overlap("words", mark)).drop("whole")
    ordinary = ordinary_words(candidates)
    weight = min(ORDINARY_WEIGHT, ORDINARY_TOTAL / max(ordinary.count(), 1))
    ordinary = ordinary.select(F.lit(ORDINARY).alias("family"), "words", F.lit(weight).alias("weight"))
    rows = hashed(positive.withColumn("weight", F.lit(1.0)).unionByName(ordinary))
    number = (F.array_position(labels, F.col("family")) - 1).cast("double")
    notice = (F.col("family") != ORDINARY).cast("double")
    rows = stored(rows.select(number.alias("number"), notice.alias("notice"), "weight", "features"), "license-fit")
    known = rows.where("notice = 1").withColumn("number", F.col("number") - 1)
    # Features that no notice has would get no weight among families; the number of variants is fixed.
    indices = {int(i) for r in known.select("features").collect() for i in r.features.indices}
    own = VectorSlicer(inputCol="features", outputCol="own", indices=sorted(indices))
    model = Model(fitted(rows, "binomial", "notice"), fitted(own.transform(known), "multinomial", "number", "own"), own)
    scores = model.licensed(rows.where("notice = 0").select("features"))
    return model, max(0.5, calibrated(scores.select(F.col("licensed").alias("p"))))


def find_licenses(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id``, ``n_paragraphs``, ``n_licensed`` and ``families`` of every row, and all findings.

    Findings have ``row``, ``place`` of the line, ``family``, ``probability``
    and ``shared``, the part of word pairs that confirmed them.
    """
    spark = docs.sparkSession
    numbered = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), "text"
    )
    lines = paragraphs(numbered).where(may_be_licensed(F.col("line")))
    candidates = stored(lines.select("row", "place", words(F.col("line")).alias("words")), "license-lines")
    model, least = train(spark, candidates)
    licensed = model.licensed(hashed(candidates)).where(F.col("licensed") >= least)
    chosen = with_hits(model.families(licensed).drop("features", "licensed"), "license-chosen")
    best = F.least(
        *[
            F.struct((-share).alias("unshared"), (F.lit(f) != F.col("family")).alias("other"), F.lit(f).alias("family"))
            for f, share in against_notices()
        ]
    )
    confirmed = chosen.select("row", "place", "probability", best.alias("b")).select(
        "row", "place", F.col("b.family").alias("family"), "probability", (-F.col("b.unshared")).alias("shared")
    )
    found = stored(confirmed.where(F.col("shared") >= SHARED_PAIRS), "license-findings")
    by_row = found.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_licensed"), F.array_sort(F.collect_set("family")).alias("families")
    )
    filled = F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[\p{L}\p{N}]"))
    counted = numbered.select(
        "row", "doc_id", F.when(F.col("text").isNull(), 0).otherwise(F.size(filled)).cast("long").alias("n_paragraphs")
    )
    rows = counted.join(by_row, "row", "left").select(
        "doc_id",
        "n_paragraphs",
        F.coalesce("n_licensed", F.lit(0)).cast("long").alias("n_licensed"),
        F.coalesce(F.array_join("families", ","), F.lit("")).alias("families"),
    )
    return rows, found
