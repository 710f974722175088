"""Target-distribution importance resampling over hashed word features.

A document's features are its runs of 1 to ``ngrams`` consecutive words; a
feature's bucket is the crc32 of its bytes modulo ``buckets``.  Buckets that
are frequent in the target texts and rare in the documents have a high gain, a
document's weight is the sum of its features' gains, and the documents with
the highest weight plus Gumbel noise are drawn: sampling without replacement in
proportion to exp(weight / 1000).

The vocabulary has a head and a tail:

* The head - the most frequent words and word pairs - is found by mergeable
  frequent-item summaries (a summary beyond its size loses its smallest count
  from all entries), so a task sends at most ``head`` words and pairs, however
  many it reads.  It is broadcast: a word with its crc32 state, from which the
  crc32 of a longer run goes on, and a pair with its bucket.
* Any other feature, the tail, takes its crc32 directly.

Both ways give the same buckets, so the totals are exact whatever the head is.
Totals have one row a bucket; only those reach the driver.

Odd rows: a null or wordless text has no features, weight 0, and is not drawn
for ``min_words`` > 0.  A null id takes noise as the id ``''`` and stands after
all ids with its score; of rows that repeat an id each is a document of its
own.  Empty tables give an empty result.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import emit, stored
from tessera.operators.ranking import exclusive_prefix_sum

HEAD = 20_000          # words, and pairs, of the broadcast vocabulary
HEAD_BYTES = 64        # longer words are never in the head, which bounds it
TOTALS = 1 << 17       # distinct features a task counts before it adds them up

# Bytes of words as they are, A-Z lower-cased, any other byte a blank.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
                    for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


class Vocabulary:
    """Buckets of features: head words by their crc32 states, head pairs by
    their buckets, the rest directly."""

    def __init__(self, words: list[bytes], pairs: list[tuple[bytes, bytes]], buckets: int):
        self.buckets = buckets
        self.states = {w: crc32(w) for w in words}
        self.pairs = {p: self.run_bucket(p) for p in pairs}

    def state(self, word: bytes) -> int:
        known = self.states.get(word)
        return crc32(word) if known is None else known

    def run_bucket(self, run: tuple[bytes, ...]) -> int:
        state = self.state(run[0])
        for word in run[1:]:
            state = crc32(word, crc32(b" ", state))
        return state % self.buckets

    def counts(self, words: list[bytes], ngrams: int) -> Iterator[tuple[Counter, int]]:
        """The runs of each length with how often they occur."""
        yield Counter(words), 1
        if ngrams > 1:
            yield Counter(pairwise(words)), 2
        for n in range(3, ngrams + 1):
            yield Counter(zip(*(words[i:] for i in range(n)))), n

    def bucket(self, feature, n: int) -> int:
        if n == 1:
            return self.state(feature) % self.buckets
        known = self.pairs.get(feature) if n == 2 else None
        return self.run_bucket(feature) if known is None else known


def shrink(summary: Counter, size: int) -> None:
    """Cuts a frequent-item summary to ``size`` entries: the next largest
    count is taken from all.  Items of more than a ``size``-th of all
    occurrences always stay."""
    if len(summary) > size:
        cut = sorted(summary.values(), reverse=True)[size]
        for item in [i for i, n in summary.items() if n <= cut]:
            del summary[item]
        for item in summary:
            summary[item] -= cut


_HEAD = pa.schema([("first", pa.binary()), ("second", pa.binary()), ("n", pa.int64())])


def head_vocabulary(docs: DataFrame, ngrams: int, head: int = HEAD) -> tuple[list[bytes], list[tuple[bytes, bytes]]]:
    """The most frequent words, and pairs if runs hold pairs, of all texts, by
    summaries of at most ``head`` entries a task: all whose count is at least
    the least power of two that leaves no more than ``head`` of them."""

    def summarise(batches):
        words, pairs = Counter(), Counter()
        for batch in batches:
            for text in batch.column(0):
                own = words_of(text.as_py())
                words.update(own)
                if ngrams > 1:
                    pairs.update(pairwise(own))
                for summary in (words, pairs):
                    if len(summary) > 8 * head:
                        shrink(summary, 2 * head)
        shrink(words, head)
        shrink(pairs, head)
        rows = [(w, None, n) for w, n in words.items() if len(w) <= HEAD_BYTES]
        rows += [(a, b, n) for (a, b), n in pairs.items() if len(a) + len(b) <= HEAD_BYTES]
        yield from emit(_HEAD, ((r, 80) for r in rows))

    counted = (docs.select("text").mapInArrow(summarise, "first binary, second binary, n long")
               .groupBy("first", "second").agg(F.sum("n").alias("n")))
    counted = stored(counted, "head").withColumn("size", F.floor(F.log2("n")).cast("int"))
    kind = F.col("second").isNotNull().alias("pair")
    # Items by the power of two of their count: from which one on they fit.
    sizes = {(r["pair"], r["size"]): r["items"] for r in counted.groupBy(kind, "size").agg(
        F.count("*").alias("items")).collect()}

    def top(pair: bool) -> list:
        least, room = 64, head
        while least and (room := room - sizes.get((pair, least - 1), 0)) >= 0:
            least -= 1
        rows = counted.where((kind == pair) & (F.col("size") >= least)).collect()
        return sorted(rows, key=lambda r: (-r["n"], r["first"], r["second"]))

    words = [bytes(r["first"]) for r in top(False)]
    return words, [(bytes(r["first"]), bytes(r["second"])) for r in top(True)]


def bucket_totals(docs: DataFrame, vocabulary: Broadcast, ngrams: int) -> dict[int, int]:
    """How many features of all texts fall into each bucket."""

    def total(batches):
        v = vocabulary.value
        totals, counts = np.zeros(v.buckets, np.int64), [Counter() for _ in range(ngrams)]

        def settle():
            for n, c in enumerate(counts, 1):
                for feature, k in c.items():
                    totals[v.bucket(feature, n)] += k
                c.clear()

        for batch in batches:
            for text in batch.column(0):
                for c, n in v.counts(words_of(text.as_py()), ngrams):
                    counts[n - 1].update(c)
                if sum(map(len, counts)) > TOTALS:
                    settle()
        settle()
        full = np.flatnonzero(totals)
        yield pa.record_batch([pa.array(full, pa.int32()), pa.array(totals[full], pa.int64())], names=["bucket", "n"])

    rows = docs.select("text").mapInArrow(total, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in rows.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int) -> list[int]:
    """1000 times the log ratio of a bucket's smoothed shares, rounded down."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    return [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all)))
            for b in range(buckets)]


_WEIGHTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                      ("weight", pa.int64())])


def weigh(docs: DataFrame, target: DataFrame, ngrams: int = 1, buckets: int = 10_000, head: int = HEAD) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row of ``docs``
    (``doc_id long, text string``) against the texts of ``target``."""
    sc = docs.sparkSession.sparkContext
    vocabulary = sc.broadcast(Vocabulary(*head_vocabulary(docs, ngrams, head), buckets))
    gain = sc.broadcast(gains(bucket_totals(docs, vocabulary, ngrams), bucket_totals(target, vocabulary, ngrams),
                              buckets))

    def rows(batches):
        v, g = vocabulary.value, gain.value
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                n_features = weight = 0
                for c, n in v.counts(words, ngrams):
                    n_features += max(0, len(words) - n + 1)
                    weight += sum(k * g[v.bucket(feature, n)] for feature, k in c.items())
                yield (doc_id, len(words), n_features, weight), 32

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: emit(_WEIGHTS, rows(batches)), "doc_id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Gumbel noise of a document, 1000-fold and rounded down, from its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, ngrams: int = 1, buckets: int = 10_000, min_words: int = 20,
             percent: int = 10, seed: int = 2024, head: int = HEAD) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document.  Of the
    documents with ``min_words`` words or more, ``percent`` in a hundred
    (rounded down) are drawn by score, ties by smaller id; ``rank`` counts
    them from 1 and is null for all others.  Ranks come from a range sort and
    a prefix sum over its pieces."""
    scored = weigh(docs, target, ngrams, buckets, head).withColumn("score", F.col("weight") + noise(seed))
    scored = stored(scored, "scored")
    able = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    drawn = scored.where(able).count() * percent // 100
    order = F.struct((-F.col("score")).alias("score"), F.col("doc_id").isNull().alias("none"), "doc_id", "n_features")
    at = exclusive_prefix_sum(scored.where(able).withColumn("_order", order), "_order", F.lit(1).cast("long"), "_at")
    rank = F.when(F.col("_at") < drawn, F.col("_at") + 1).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    return at.select(*columns, rank.alias("rank")).unionByName(
        scored.where(~able).select(*columns, F.lit(None).cast("long").alias("rank")))
