"""Toxicity grades by cumulative-link ordinal regression.

``P(grade <= k) = sigmoid(cut_k - w . x)``: one weight vector for all ordered
cuts.  ``x`` holds log counts of sparse text features: words and word
beginnings of 4 to 6 letters.  Output is the expected severity.

The labels are binary, so grades are made from them: 0 for documents that are
not toxic; toxic ones are ranked by how many words with a feature of the toxic
class they hold and cut into three equal grades.

Training takes at most ``sample`` labelled documents (smallest hash of the
id) without repeated texts; counts are summed in tasks, and only the chosen
features' counts come to the driver.  Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.common import bounded_sample, emit, worker_cache

_WORD = re.compile(r"[^\W\d_]+")
_COUNTS = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
_ROWS = pa.schema([("toxic", pa.int32()), ("ids", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))])
_GRADED = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()),
                     ("toxic", pa.bool_())])


def features_of(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [word] + [f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n]


class FeatureIndex(dict):
    """White-space free chunk -> the numbers of the known features in it."""

    def __init__(self, features: list[str], limit: int = 200_000):
        super().__init__()
        self.number = {f: i for i, f in enumerate(features)}
        self.limit = limit

    def __missing__(self, chunk: str) -> tuple[int, ...]:
        known = self.number
        out = tuple(known[f] for w in _WORD.findall(chunk) for f in features_of(w) if f in known)
        if len(chunk) <= 100:
            if len(self) >= self.limit:
                self.clear()
            self[chunk] = out
        return out

    def counts(self, text: str | None) -> Counter:
        return Counter(chain.from_iterable(map(self.__getitem__, (text or "").lower().split())))


@dataclass
class OrdinalModel:
    features: list[str]
    weights: np.ndarray
    cuts: np.ndarray

    def grade_odds(self, score: float) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..."""
        return 1 / (1 + np.exp(np.clip(self.cuts - score, -60, 60)))

    def score(self, counts: Counter) -> float:
        return sum(self.weights[f] * np.log1p(n) for f, n in counts.items())


def fit_ordinal(rows: list[dict[int, float]], grades: np.ndarray, features: list[str], levels: int,
                steps: int = 300, rate: float = 0.05, penalty: float = 1e-4) -> OrdinalModel:
    """Maximum likelihood by full gradient steps (Adam); grade 0 and the
    grades above it weigh the same in all."""
    above = grades > 0
    weight = np.where(above, 0.5 / max(above.sum(), 1), 0.5 / max((~above).sum(), 1))
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.fromiter(chain.from_iterable(rows), np.intp, len(doc))
    val = np.fromiter(chain.from_iterable(r.values() for r in rows), float, len(doc))
    w, first, gaps = np.zeros(len(features)), 1.0, np.zeros(levels - 2)
    params = np.concatenate([w, [first], gaps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, cuts = params[:len(features)], _cuts(params[len(features):])
        score = np.bincount(doc, val * w[col], len(rows))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        high, low = _sigmoid(edges[grades + 1] - score), _sigmoid(edges[grades] - score)
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = weight * high * (1 - high) / p, weight * low * (1 - low) / p
        d_score = d_high - d_low  # of the negative log likelihood
        d_edges = (np.bincount(grades, d_low, levels + 1) - np.bincount(grades + 1, d_high, levels + 1))[1:levels]
        tail = np.cumsum(d_edges[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, val * d_score[doc], len(features)) + penalty * w, tail[:1],
                               tail[1:] * np.exp(params[len(features) + 1:])])
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        params = params - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
    return OrdinalModel(features, params[:len(features)], _cuts(params[len(features):]))


def _cuts(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``toxic, text`` of at most ``sample`` labelled documents, each text once
    (toxic if any of its labels is)."""
    chosen = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
              .where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = bounded_sample(chosen, sample, "doc_id")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("text IS NOT NULL")
    return (text.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` pairs of numbers
            .groupBy("text").agg(F.max("toxic").alias("toxic")).select("toxic", "text"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8000, keep: int = 600, levels: int = 4,
        seen: int = 8) -> OrdinalModel | None:
    """The model, or None if the sample holds only one class."""
    rows = labelled_sample(docs, labels, sample).persist()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean = Counter(), Counter()
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = set(_WORD.findall(text.as_py().lower()))
                (toxic if label else clean).update({f for w in words for f in features_of(w)})
        yield from emit(_COUNTS, (((f, toxic[f], clean[f]), len(f) + 16) for f in toxic | clean))

    totals = {r["toxic"] > 0: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        rows.unpersist()
        return None
    t, c, share = F.col("t"), F.col("c"), bad / (bad + good)
    chi = (t - (t + c) * share) ** 2 / ((t + c) * share)
    picked = (rows.mapInArrow(count, "feature string, toxic long, clean long").groupBy("feature")
              .agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).where(t + c >= seen)
              .orderBy(chi.desc(), "feature").limit(keep).select("feature", (t / (t + c) > share).alias("bad"))
              .collect())
    features = [r["feature"] for r in picked]
    marks = {i for i, r in enumerate(picked) if r["bad"]}
    known = docs.sparkSession.sparkContext.broadcast(features)

    def vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = FeatureIndex(known.value)

        def out():
            for b in batches:
                for label, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    n = index.counts(text.as_py())
                    yield (int(label > 0), list(n), list(n.values())), 8 * len(n)
        yield from emit(_ROWS, out())

    got = rows.mapInArrow(vector, "toxic int, ids array<int>, counts array<int>").collect()  # at most ``sample``
    got.sort(key=lambda r: (r["toxic"], r["ids"], r["counts"]))
    rows.unpersist()
    vectors = [{i: float(np.log1p(n)) for i, n in zip(r["ids"], r["counts"], strict=True)} for r in got]
    toxic = np.array([r["toxic"] for r in got])
    marked = np.array([sum(n for i, n in zip(r["ids"], r["counts"], strict=True) if i in marks) for r in got])
    grades = np.zeros(len(got), np.intp)
    steps = np.quantile(marked[toxic > 0], np.arange(1, levels - 1) / (levels - 1))
    grades[toxic > 0] = 1 + np.searchsorted(steps, marked[toxic > 0], side="right")
    return fit_ordinal(vectors, grades, features, levels)


def grade(docs: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """``doc_id, severity, grade, toxic`` for every row of ``docs(doc_id,
    text)``: the expected grade, the most probable one (the lower of equals)
    and whether a grade above 0 is more likely than not.

    Null and empty texts score as texts without features; without a model all
    is 0.  Whole texts count; repeated rows and null ids stay; other columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        features = tuple(m.features) if m else ()
        index = worker_cache(("features", features), lambda: FeatureIndex(list(features)))

        def out():
            for b in batches:
                for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    if m is None:
                        yield (doc, 0.0, 0, False), 40
                        continue
                    at_least = m.grade_odds(m.score(index.counts(text.as_py())))
                    each = -np.diff(np.concatenate([[1.0], at_least, [0.0]]))
                    yield (doc, float(at_least.sum()), int(each.argmax()), bool(at_least[0] >= 0.5)), 40
        yield from emit(_GRADED, out())

    return rows.mapInArrow(score, "doc_id long, severity double, grade int, toxic boolean")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on labelled documents and grades all."""
    return grade(docs, fit(docs, labels))
