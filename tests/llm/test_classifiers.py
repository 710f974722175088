"""Language, toxicity and licence models: gradients, accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import language_id as lang, license_scan, toxicity

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, toxic string"
ODD = [(None, "Bonjour tout le monde", None, "x"), (1, None, "fr", "x"), (2, "", "fr", "x"), (3, "123 ... 456", None, "x"),
       (4, "der und die " * 3000, None, "x"), (4, "der und die " * 3000, None, "x")]


def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_backpropagation_through_time():
    rng = np.random.default_rng(0)
    net = lang.train([(b"abc abc", "x"), (b"xyz xyzz", "y")] * 4, hidden=3, epochs=1)
    for d in (net.forward, net.backward):
        for k in ("inputs", "gates", "state"):
            setattr(d, k, getattr(d, k).astype(np.float64))
    net.out, net.bias = net.out.astype(np.float64), net.bias.astype(np.float64)
    x = rng.integers(97, 104, (7, 4))
    mask = np.ones((7, 4))
    mask[5:, 1] = 0
    y, weight = np.array([0, 1, 1, 0]), np.array([1.0, 2.0, 0.5, 1.0])

    def loss():
        total = sum(float((-np.log(p[y, np.arange(4)]) * m * weight).sum())
                    for p, m in zip(net.positions(x, mask), mask, strict=True))
        return total / mask.sum()

    grads = lang._gradients(net, x, mask, y, weight)
    arrays = [getattr(d, k) for d in (net.forward, net.backward) for k in ("inputs", "gates", "state")] \
        + [net.out, net.bias]
    for a, g in zip(arrays, grads, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = a[at]
        a[at] = old + 1e-5
        up = loss()
        a[at] = old - 1e-5
        down = loss()
        a[at] = old
        assert abs((up - down) / 2e-5 - g[at]) < 1e-4 * max(1, abs(g[at]))


def test_language_held_out_accuracy_and_order(spark):
    got = lang.language_id(docs(spark)).join(docs(spark).select("doc_id", "lang"), "doc_id")
    right, n = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.93
    assert got.where("score < 0 OR score > 1").count() == 0


def test_language_odd_rows(spark):
    model = lang.fit(docs(spark))
    given = spark.createDataFrame(ODD, SCHEMA).withColumn("score", F.lit("clash"))
    got = sorted(((r.doc_id or 0), r.held_out, r.lang_pred, r.score) for r in lang.identify(given, model).collect())
    assert [g[2] for g in got] == ["fr", "und", "und", "und", "de", "de"] and got[1][3] == 0
    assert got[4] == got[5]
    assert lang.identify(given.limit(0), model).count() == 0
    assert lang.fit(given.where("lang = 'none'")) is None
    assert {r.lang_pred for r in lang.identify(given, None).collect()} == {"und"}
    labels = model.label_positions("und der die")
    assert len(labels) == 11 and set(labels) <= set(model.languages)


def test_one_batch_equals_single_documents(spark):
    model = lang.fit(docs(spark))
    texts = [r.text for r in docs(spark).limit(20).collect()]
    raw = [t.encode() for t in texts]
    ends = np.cumsum([0, *map(len, raw)])
    both = model.pooled(np.frombuffer(b"".join(raw), np.uint8), ends[:-1], ends[1:])
    for one, t in zip(both, raw, strict=True):
        alone = model.pooled(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0]
        assert np.allclose(one, alone, atol=1e-5)


def test_toxicity_accuracy(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = toxicity.toxicity(docs(spark), labels).withColumnRenamed("toxic", "found").join(labels, "doc_id")
    t = {(r.toxic, r.found): r.n for r in got.groupBy("toxic", "found").agg(F.count("*").alias("n")).collect()}
    assert t.get((1, True), 0) >= 0.85 * (t.get((1, True), 0) + t.get((1, False), 0))
    assert t.get((0, True), 0) <= 0.02 * t[(0, False)]
    assert got.where("severity < 0 OR severity > 3 OR grade < 0 OR grade > 3").count() == 0
    means = [r.m for r in got.groupBy("grade").agg(F.avg("severity").alias("m")).orderBy("grade").collect()]
    assert means == sorted(means)


def test_ordinal_fit_shares_weights_and_orders_cuts():
    rng = np.random.default_rng(1)
    rows = [{0: float(k), 1: float(rng.random())} for k in range(4) for _ in range(100)]
    model = toxicity.fit_ordinal(rows, np.repeat(np.arange(4), 100), ["a", "b"], 4)
    assert (np.diff(model.cuts) > 0).all() and model.weights[0] > 5 * abs(model.weights[1])
    expected = [model.grade_odds(model.weights[0] * k).sum() for k in range(4)]
    assert expected == sorted(expected)


def test_toxicity_odd_rows(spark):
    given = spark.createDataFrame(ODD, SCHEMA)
    none = spark.createDataFrame([(4, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(given, none).collect()  # one class only: no model
    assert len(got) == len(ODD) and not any(r.toxic or r.severity or r.grade for r in got)
    model = toxicity.fit(docs(spark), spark.read.parquet(f"{DATA}/labels.parquet"))
    got = {(r.doc_id, r.toxic) for r in toxicity.grade(given, model).collect()}
    assert got == {(None, False), (1, False), (2, False), (3, False), (4, False)}
    assert toxicity.grade(given.limit(0), model).count() == 0


NOTICE = {"apache": "apache-2.0", "GNU General": "gpl", "the MIT License": "mit", "BY-NC": "cc-by-nc", "All rights": "all-rights-reserved"}


def test_licences_against_the_lines(spark):
    got = {(r.doc_id, r.paragraph): r for r in license_scan.scan_licenses(docs(spark)).collect()}
    want = {}
    for r in docs(spark).collect():
        for i, line in enumerate((r.text or "").split("\n")):
            for mark, family in NOTICE.items():
                if mark.lower() in line.lower() and len(line) < 90:
                    want[r.doc_id, i] = family
    assert want and {k: r.family for k, r in got.items() if r.confirmed} == want
    assert all(0 <= r.probability <= 1 for r in got.values())


def test_licences_odd_rows(spark):
    given = spark.createDataFrame([*ODD, (9, "Das ist.\n\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0!\n", None, "x"),
                                   (9, "Das ist.\n\nLICENSED UNDER THE APACHE LICENSE, VERSION 2.0!\n", None, "x")], SCHEMA)
    some = docs(spark).select("doc_id", "text").unionByName(given.select("doc_id", "text"))
    got = [(r.doc_id, r.paragraph, r.family) for r in license_scan.scan_licenses(some).where("doc_id = 9 OR doc_id IS NULL")
           .where("confirmed").collect()]
    assert got == [(9, 2, "apache-2.0")] * 2
    assert license_scan.scan_licenses(given.limit(0)).count() == 0


EMBEDDED = [
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies."),
    ("all-rights-reserved", "Copyright (c) 2020 Acme Corp. All rights reserved."),
    ("apache-2.0", "{} Licensed under the Apache License, Version 2.0. {}"),
    ("mit", "{} Released under the MIT License. {}"),
    ("all-rights-reserved", "{} All rights reserved. {}"),
    ("cc-by-nc", "{} Licensed under CC BY-NC 4.0. {}"),
    (None, "{} The rights of all are reserved to the public under the terms of law. {}"),
]


def test_licences_inside_long_paragraphs(spark):
    prose = next(r.text for r in docs(spark).where("length(text) > 4000").orderBy("doc_id").collect()).replace("\n", " ")
    rows = [(10_000_000 + i, t.format(prose[:size], prose[size:2 * size]))
            for size in (200, 2000) for i, (_, t) in enumerate(EMBEDDED, 100 * size)]
    given = docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.family for r in license_scan.scan_licenses(given).where("doc_id >= 10000000 AND confirmed").collect()}
    assert got == {10_000_000 + i: f for size in (200, 2000) for i, (f, _) in enumerate(EMBEDDED, 100 * size) if f}


def test_licences_of_lines_without_length_condition(spark):
    got = {(r.doc_id, r.paragraph): r.family for r in license_scan.scan_licenses(docs(spark)).where("confirmed").collect()}
    want = {(r.doc_id, i): family for r in docs(spark).collect() for i, line in enumerate((r.text or "").split("\n"))
            for mark, family in NOTICE.items() if mark.lower() in line.lower()}
    assert want and got == want


def test_licence_scan_runs_no_python(spark):
    plan = license_scan.scan_licenses(docs(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
