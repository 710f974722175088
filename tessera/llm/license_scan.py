"""License scans by a trained paragraph classifier, in DataFrame functions only.

Paragraphs (lines) are split into words; words and word pairs are hashed into
sparse features, and a multinomial logistic regression gives each paragraph a
licence family or none.  It is trained on the notices below, whole and
cropped, and on a bounded sample of the corpus's own paragraphs as the class
``none``.  A second, one-feature regression, fitted on rows that the first did
not see, calibrates the probability that a paragraph is a known notice.
In a paragraph of any length that holds a notice, the stretch with most of its
word pairs is scored instead of the whole.  Predictions are confirmed by
comparing word pairs with the family's notices; a paragraph that looks like a
licence but fits no notice is ``unknown``.

Scoring is one pass without a shuffle; nothing but model weights is broadcast.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import bounded_sample

NONE, UNKNOWN = "none", "unknown"

# Usual notices by family.
NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "This project is released under the terms of the Apache License 2.0."),
    ("apache-2.0", "You may not use this file except in compliance with the Apache License, Version 2.0."),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("mit", "This software is distributed under the terms of the MIT license."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software under the terms of the GNU General Public License, version 2 or later."),
    ("gpl", "Distributed under the GNU GPL v3."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("lgpl", "Distributed under the terms of the GNU LGPL."),
    ("agpl", "Licensed under the GNU Affero General Public License, version 3."),
    ("agpl", "Distributed under the terms of the GNU AGPL v3."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("bsd", "Licensed under the BSD 2-Clause License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("mpl-2.0", "Licensed under the Mozilla Public License 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright to this work under CC0 1.0."),
    ("cc0", "Released into the public domain under CC0 1.0 Universal."),
    ("isc", "Licensed under the ISC License."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
    ("all-rights-reserved", "Copyright. All rights reserved. No part may be reproduced without permission."),
    # Full standard headers.
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions:"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
             "(at your option) any later version."),
    ("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
             "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
             "(at your option) any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
)


def _literal_pairs(notice: str) -> list[str]:
    """The distinct word pairs of a notice above (ASCII)."""
    words = re.findall("[a-z0-9]+", notice.lower())
    return list(dict.fromkeys(f"{x} {y}" for x, y in zip(words, words[1:])))


FORMS = [(f, _literal_pairs(n)) for f, n in NOTICES]
KNOWN = sorted({p for _, pairs in FORMS for p in pairs})


def paragraph_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, paragraph, text, words``: the lines that hold a word, counted
    from 0 over all lines of a document."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("paragraph", "text"))
    return once(lines, "words", words_of(F.col("text"))).where(F.size("words") > 0)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is computed once a row: filters and projections over
    it don't repeat the expression."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def pairs_of(words: Column) -> Column:
    """Two-word runs; a single word stays as it is."""
    pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1),
                       lambda x, y: F.concat(x, F.lit(" "), y))
    return F.when(F.size(words) > 1, pairs).otherwise(words)


def with_spots(rows: DataFrame, least: float) -> DataFrame:
    """Adds ``spots`` - the notices of which a stretch of the line, at most
    half as long again, holds the share ``least`` of the word pairs, with the
    best share - and ``spot``, the words of the best stretch or null."""
    pairs, hits = F.col("_pairs"), F.col("_hits")
    rows = once(rows, "_pairs", pairs_of(F.col("words")))
    rows = once(rows, "_hits", F.filter(F.transform(pairs, lambda p, i: F.when(p.isin(KNOWN), i)),
                                        lambda i: i.isNotNull()))
    forms = F.array(*[F.struct(F.lit(f).alias("family"), F.array(*map(F.lit, own)).alias("own"))
                      for f, own in FORMS])
    here = F.array_distinct(F.transform(hits, lambda i: pairs[i]))
    rows = once(rows, "_forms", F.when(F.size(hits) > 1, F.filter(
        forms, lambda f: F.size(F.array_intersect(f["own"], here)) >= least * F.size(f["own"]))))

    def reach(f: Column) -> Column:
        return F.ceil(1.5 * F.size(f["own"])).cast("int")

    def stretches(f: Column) -> Column:
        starts = F.filter(hits, lambda i: F.array_contains(f["own"], pairs[i]))
        return F.array_max(F.transform(starts, lambda i: F.struct(
            (F.size(F.array_intersect(F.slice(pairs, i + 1, reach(f)), f["own"])) / F.size(f["own"])).alias("share"),
            F.size(f["own"]).alias("n"), i.alias("start"), f["family"].alias("family"), f["own"].alias("own"))))

    rows = once(rows, "spots", F.filter(F.transform("_forms", stretches), lambda s: s["share"] >= least))
    rows = once(rows, "_best", F.array_max("spots"))
    best = F.col("_best")
    last = F.array_max(F.filter(hits, lambda i: (i >= best["start"]) & (i < best["start"] + reach(best))
                                & F.array_contains(best["own"], pairs[i])))
    spot = F.when(best.isNotNull(), F.slice("words", best["start"] + 1, last - best["start"] + 2))
    return once(rows, "spot", spot).drop("_pairs", "_hits", "_forms", "_best")


def _notices(df: DataFrame) -> DataFrame:
    each = F.array(*[F.struct(F.lit(f).alias("family"), F.lit(n).alias("notice")) for f, n in NOTICES])
    return df.sparkSession.range(1).select(F.inline(each)).withColumn("words", words_of(F.col("notice")))


def _features(rows: DataFrame, buckets: int) -> DataFrame:
    terms = F.when(F.size("words") > 1, F.concat("words", pairs_of(F.col("words")))).otherwise(F.col("words"))
    return HashingTF(numFeatures=buckets, binary=True, inputCol="terms", outputCol="features").transform(
        rows.withColumn("terms", terms))


def training_rows(docs: DataFrame, sample: int) -> DataFrame:
    """``family, words, fold``: the notices whole and without up to a third of
    their words at either end, and at most ``sample`` paragraphs of ``sample / 2``
    documents (smallest hashes) that share no third of their word pairs with a
    notice and hold no half of one."""
    notices = _notices(docs)
    n = F.size("words")
    cut = F.explode(F.sequence(F.lit(0), F.floor(n / 3).cast("int")))
    crops = notices.withColumn("cut", cut).select(
        "family", F.explode(F.array(F.slice("words", F.col("cut") + 1, n - F.col("cut")),
                                    F.slice("words", F.lit(1), n - F.col("cut")))).alias("words")).distinct()
    known = notices.select(F.explode(pairs_of(F.col("words"))).alias("p")).agg(F.collect_set("p").alias("known"))
    some = bounded_sample(docs.select("doc_id", "text"), sample // 2, "doc_id")
    lines = (paragraph_rows(some).select("words").orderBy(F.xxhash64("words"), "words").limit(sample).distinct()
             .crossJoin(F.broadcast(known))  # one row
             .where(3 * F.size(F.array_intersect(F.array_distinct(pairs_of(F.col("words"))), "known"))
                    < F.size(F.array_distinct(pairs_of(F.col("words"))))).select(F.lit(NONE).alias("family"), "words"))
    lines = with_spots(lines, 0.5).where("spot IS NULL").select("family", "words")
    return crops.unionByName(lines).withColumn("fold", F.pmod(F.xxhash64("words"), F.lit(4)))


class LicenseModel:
    """Family regression, its calibration and their settings."""

    def __init__(self, docs: DataFrame, sample: int = 3000, buckets: int = 1 << 14, steps: int = 25):
        self.buckets = buckets
        self.families = [NONE, *dict.fromkeys(f for f, _ in NOTICES)]
        number = F.array_position(F.array(*map(F.lit, self.families)), F.col("family")) - 1
        rows = _features(training_rows(docs, sample), buckets).withColumn("label", number.cast("double"))
        # Notices and none weigh the same in all.
        share = rows.groupBy("family").count().collect()
        known = sum(r["count"] for r in share if r["family"] != NONE)
        other = sum(r["count"] for r in share if r["family"] == NONE)
        weight = F.when(F.col("family") == NONE, 1.0 / max(other, 1)).otherwise(1.0 / known) * (known + other) / 2
        rows = rows.withColumn("weight", weight).select("family", "fold", "features", "label", "weight")
        rows = rows.coalesce(2).persist()  # a bounded sample, read once a step
        fit = LogisticRegression(maxIter=steps, regParam=1e-3, family="multinomial", weightCol="weight")
        seen = rows.where("fold > 0")
        self.regression = fit.fit(seen)
        held = self._odds(self.regression.transform(rows.where("fold = 0")))
        held = held.withColumn("label", (F.col("family") != NONE).cast("double"))
        self.slope, self.offset = 1.0, 0.0
        if held.select("label").distinct().count() == 2:
            ready = VectorAssembler(inputCols=["odds"], outputCol="x").transform(held.select("odds", "label", "weight"))
            scale = LogisticRegression(featuresCol="x", maxIter=50, regParam=1e-2, weightCol="weight").fit(ready)
            self.slope, self.offset = float(scale.coefficients[0]), float(scale.intercept)
        rows.unpersist()

    def _odds(self, scored: DataFrame) -> DataFrame:
        """Adds the best family and the log odds of any family against none."""
        scored = once(scored, "p", vector_to_array("probability"))
        p = F.col("p")
        best = F.array_max(F.slice(p, 2, len(self.families) - 1))
        none = F.greatest(F.least(p[0], F.lit(1 - 1e-12)), F.lit(1e-12))
        return scored.withColumn("odds", F.log((1 - none) / none)).withColumn(
            "best", F.array(*map(F.lit, self.families))[F.array_position(F.slice(p, 2, len(self.families) - 1), best)
                                                        .cast("int")])

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``best`` and ``probability``, the calibrated one, to rows with
        ``words``."""
        scored = self._odds(self.regression.transform(_features(rows, self.buckets)))
        known = 1 / (1 + F.exp(-(F.col("odds") * self.slope + self.offset)))
        return scored.withColumn("known", known).drop("terms", "features", "rawPrediction", "probability",
                                                      "prediction", "odds", "p").withColumnRenamed("known", "probability")


def scan_licenses(docs: DataFrame, least: float = 0.5, confirm: float = 0.6, sample: int = 3000) -> DataFrame:
    """``doc_id, paragraph, family, probability, similarity, confirmed``: the
    paragraphs of ``docs(doc_id, text)`` whose calibrated probability of a
    known licence notice is at least ``least``.

    A line that holds a notice is judged by the stretch that holds most of it.
    ``similarity`` is the largest Dice share of the line's word pairs with a
    notice of the predicted family or, if more, the share of such a notice's
    word pairs that a stretch of the line holds; from ``confirm`` on the prediction is confirmed,
    below it the family is ``unknown``.  Null, empty and wordless texts give
    no row, repeated rows and ids a row each, a null id stays; very long
    paragraphs are read whole; other columns are ignored.
    """
    model = LicenseModel(docs, sample)
    rows = with_spots(paragraph_rows(docs), confirm).select(
        "doc_id", "paragraph", F.col("words").alias("line"), F.coalesce("spot", "words").alias("words"), "spots")
    hits = model.score(rows).where(F.col("probability") >= least)
    forms = _notices(docs).groupBy("family").agg(F.collect_list(F.array_distinct(pairs_of(F.col("words"))))
                                                 .alias("forms"))
    own = F.array_distinct(pairs_of(F.col("line")))
    alike = F.transform("forms", lambda f: 2 * F.size(F.array_intersect(f, own)) / (F.size(f) + F.size(own)))
    # ``forms`` has a row for each family of the notices above.
    out = hits.join(F.broadcast(forms), hits.best == forms.family).withColumn(
        "similarity", F.greatest(F.array_max(alike), F.array_max(F.transform(
            F.filter("spots", lambda s: s["family"] == F.col("best")), lambda s: s["share"]))))
    sure = F.col("similarity") >= confirm
    return out.select("doc_id", "paragraph", F.when(sure, F.col("best")).otherwise(UNKNOWN).alias("family"),
                      "probability", "similarity", sure.alias("confirmed"))
