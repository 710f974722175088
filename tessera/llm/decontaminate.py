"""Benchmark decontamination: BM25 with block-max WAND over the test items.

The items are the indexed documents and every training passage is a query.
Passages are windows of words that overlap so that each item's words, in a
row, lie in one window.  An item's score is the BM25 weight of its words that
the passage holds, as a share of the item's whole weight, so one threshold
holds for short and long items.  Items are cut into blocks, and every term has
its largest score in each block.  Blocks whose bounds over a passage's words
stay below the threshold are found for all passages of a text at once; WAND
then searches the other blocks and gives all items above the threshold.  Hits are verified on the words: the
question (all sentences but the last) and the answer (the last one) must each
be found in the passage by ``verify`` of their five-word runs.

The index is made by Spark and never passes through the driver.  Items are
cut into shards of about ``shard_bytes`` of text; term counts, weights and
posting lists come from grouped aggregates over all items and are stored by
shard in the checkpoint folder.  The texts are read once: a task takes a block
of them through all shards and holds one shard at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window, functions as F

from tessera.functions.files import filesystem_for, qualify
from tessera.llm.common import emit, shared_path, stored, without_ids, worker_cache

_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
K1, B, RUN = 1.2, 0.75, 5
BLOCKS = 64  # at most, of at least 4 items
COMMON = 24  # words by which items of a kind are put together
TEXT_BLOCK = 32 << 20  # bytes of texts that are held against one shard after the other
_COUNTED = pa.schema([("item_id", pa.int64()), ("text", pa.string()), ("n", pa.int64()),
                      ("terms", pa.list_(pa.string())), ("tf", pa.list_(pa.int64()))])
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                    ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def runs(words: list[str]) -> set[tuple[str, ...]]:
    """Distinct five-word runs; fewer words make one, none none."""
    n = min(RUN, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def question_and_answer(text: str) -> tuple[set, set]:
    """The runs of all sentences but the last that has a word, and of that;
    a single sentence is a question without answer."""
    parts = [p for p in map(words_of, _SENTENCE.split(text)) if p]
    if len(parts) < 2:
        return runs(sum(parts, [])), set()
    return runs(sum(parts[:-1], [])), runs(parts[-1])


@dataclass
class Postings:
    items: list[int]       # increasing
    scores: list[float]    # share of the item's weight
    bound: float


class BlockMaxIndex:
    """Inverted index of items (id, text); ``lists`` has for each term the
    positions of the items that hold it, increasing, and their scores."""

    def __init__(self, items: list[tuple[int, str]], lists: Iterable[tuple[str, list[int], list[float]]]):
        self.ids = [i for i, _ in items]
        self.parts = [question_and_answer(t) for _, t in items]
        self.longest = max(len(words_of(t)) for _, t in items)
        self.number, self.postings = {}, []
        for term, at, scores in lists:
            self.number[term] = len(self.postings)
            self.postings.append(Postings(at, scores, max(scores)))
        self.block = max(4, -(-len(items) // BLOCKS))
        # Largest scores by term and block; the last row is that of unknown words.
        self.tops = np.zeros((len(self.postings) + 1, -(-len(items) // self.block)), np.float32)
        for term, p in enumerate(self.postings):
            np.maximum.at(self.tops[term], np.asarray(p.items) // self.block, p.scores)

    def search(self, terms: list[int], threshold: float, live: np.ndarray) -> list[tuple[int, float]]:
        """All items whose score is at least ``threshold``; ``live`` marks the
        blocks whose bounds reach it."""
        limit = threshold - 1e-9
        starts = (np.flatnonzero(live) * self.block).tolist()
        cursors = [c for t in terms if _advance(c := [0, 0, self.postings[t]], starts[0])] if starts else []
        out = []
        while cursors:
            cursors.sort(key=_first)
            bound, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                bound += c[2].bound
                if bound >= limit:
                    pivot = i
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            if not live[item // self.block]:  # to the next block that can reach the threshold
                at = bisect_left(starts, item)
                if at == len(starts):
                    break
                cursors = [c for c in cursors if c[0] >= starts[at] or _advance(c, starts[at])]
            elif cursors[0][0] == item:
                while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                    pivot += 1
                score = sum(c[2].scores[c[1]] for c in cursors[:pivot + 1])
                if score >= limit:
                    out.append((item, score))
                cursors = [c for i, c in enumerate(cursors) if i > pivot or _advance(c, item + 1)]
            else:
                cursors = [c for c in cursors if c[0] >= item or _advance(c, item)]
        return out

    def passages(self, numbers: np.ndarray, threshold: float) -> Iterator[tuple[int, int, list[int], np.ndarray]]:
        """(start, end, distinct terms, live blocks) of the passages with a
        live block.  A passage is three steps of words and begins at every
        step; a step is half the longest item."""
        step = max(16, -(-self.longest // 2))
        n, unknown = len(numbers), len(self.postings)
        order = np.argsort(numbers, kind="stable")
        before = np.full(n, -1)
        again = numbers[order[1:]] == numbers[order[:-1]]
        before[order[1:][again]] = order[:-1][again]
        steps = -(-n // step)
        at = np.arange(n) // step
        padded = np.full(steps * step, unknown)
        padded[:n] = numbers
        bounds = np.zeros((max(1, steps - 2), self.tops.shape[1]), np.float32)
        for low in range(0, steps, 256):  # bounded memory on long texts
            high = min(low + 256, steps)
            gain = self.tops[padded[low * step:high * step]].reshape(high - low, step, -1)
            for back in range(3):  # the passage that began ``back`` steps ago; a word counts once
                fresh = np.zeros((high - low) * step, np.float32)
                here = slice(low * step, min(high * step, n))
                fresh[:here.stop - here.start] = before[here] < (at[here] - back) * step
                sums = np.einsum("bkr,bk->br", gain, fresh.reshape(high - low, step))
                first = np.arange(low, high) - back
                ok = (first >= 0) & (first < len(bounds))
                bounds[first[ok]] += sums[ok]
        live = bounds >= threshold - 1e-4
        for p in np.flatnonzero(live.any(axis=1)).tolist():
            start, end = p * step, min(n, (p + 3) * step)
            terms = np.unique(numbers[start:end])
            yield start, end, terms[terms != unknown].tolist(), live[p]


def _first(cursor: list) -> int:
    return cursor[0]


def _advance(cursor: list, item: float) -> bool:
    """Moves a cursor to the first item not below ``item``; False at the end."""
    items = cursor[2].items
    at = bisect_left(items, item, cursor[1])
    if at == len(items):
        return False
    cursor[0], cursor[1] = items[at], at
    return True


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items that hold a word, with their word counts."""
    def rows():
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if tf := Counter(words_of(text)):
                    yield (item, text, tf.total(), list(tf), list(tf.values())), 2 * len(text)
    yield from emit(_COUNTED, rows())


def store_index(benchmark: DataFrame, shard_bytes: int) -> tuple[str, list[int]]:
    """Stores the index of ``benchmark(item_id, text)`` and returns its folder
    and the numbers of its shards.

    ``items/shard=K`` holds the distinct items (``at, item_id, text``) and
    ``lists/shard=K`` their posting lists (``term, at, score``), ``at`` the
    item's position in the shard.  Counts are of all rows.  The driver gets
    three totals, ``COMMON`` words and the shards' numbers.
    """
    path = qualify(shared_path(benchmark.sparkSession, "leak-index"), benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = stored(items.where("text IS NOT NULL").mapInArrow(
        _counted, "item_id long, text string, n long, terms array<string>, tf array<long>"), "items")
    size, total, mean = items.agg(F.sum(F.octet_length("text")), F.count("*"), F.avg("n")).first()
    if not total:
        return path, []
    counts = stored(items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")),
                    "counts")
    common = [r["term"] for r in counts.orderBy(F.desc("df"), "term").limit(COMMON).collect()]
    kind = F.array(*[F.array_contains("terms", w) for w in common])
    shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(-(-size // shard_bytes))).cast("int")
    order = Window.partitionBy("shard").orderBy(kind, "item_id", "text")  # a shard is bounded
    items = stored(items.dropDuplicates(["item_id", "text"]).withColumn("shard", shard)
                   .withColumn("at", F.row_number().over(order) - 1), "items")
    tf, df = F.col("tf"), F.col("df")
    weight = F.log(1 + (total - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("n") / mean))
    terms = items.select("shard", "at", "n", F.inline(F.arrays_zip(F.col("terms").alias("term"), "tf")))
    held = (terms.join(counts, "term").groupBy("shard", "at")
            .agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("w")))).alias("held")))
    whole = F.aggregate("held", F.lit(0.0), lambda sum_, h: sum_ + h["w"])
    lists = (held.withColumn("whole", whole).select("shard", "at", "whole", F.inline("held"))
             .groupBy("shard", "term").agg(F.sort_array(F.collect_list(F.struct("at", (F.col("w") / F.col("whole"))
                                                                                .alias("score")))).alias("list"))
             .select("shard", "term", F.col("list.at").alias("at"), F.col("list.score").alias("score")))
    part = F.pmod(F.xxhash64("term"), F.lit(4))  # at most four files a shard
    lists.repartition("shard", part).write.partitionBy("shard").parquet(f"{path}/lists")
    items.select("shard", "at", "item_id", "text").repartition("shard").write.partitionBy("shard").parquet(f"{path}/items")
    return path, sorted(r["shard"] for r in items.select("shard").distinct().collect())


def load_index(path: str, shard: int) -> BlockMaxIndex:
    """A shard's index, read inside a task."""
    fs, at = filesystem_for(path)

    def table(name: str, key: str) -> list[list]:
        got = pq.read_table(f"{at}/{name}/shard={shard}", filesystem=fs, partitioning=None, use_threads=False)
        return [c.to_pylist() for c in got.sort_by(key).columns]

    _, ids, texts = table("items", "at")
    return BlockMaxIndex(list(zip(ids, texts, strict=True)), zip(*table("lists", "term"), strict=True))


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, verify: float = 0.8,
               shard_bytes: int = 1 << 20) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap``: one row
    for each document of ``docs(doc_id, text)`` and item of
    ``benchmark(item_id, text)`` that it leaks (the best passage).

    Null, empty and wordless texts and items match nothing.  Repeated rows of
    a document or item give one row a pair of ids; rows with a null doc_id are
    reported as null; an item without an answer has null there.  Whole texts
    are searched; other columns are ignored.
    """
    path, shards = store_index(benchmark, shard_bytes)
    least = TEXT_BLOCK if len(shards) > 1 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for block in _gathered(batches, least):
                for shard in shards:
                    index = worker_cache(("leaks", path, shard), lambda shard=shard: load_index(path, shard))
                    for b in block:
                        for doc, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                            for hit in _leaks(words_of(text.as_py()), index, threshold, verify):
                                yield (doc, *hit), 64
        yield from emit(_FOUND, out())

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(run, "doc_id long, item_id long, score double, question_overlap double, "
                                 "answer_overlap double")
    best = F.max(F.struct("score", "question_overlap", "answer_overlap")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def _gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in lists of at least ``least`` bytes."""
    block, size = [], 0
    for b in batches:
        block.append(b)
        size += b.nbytes
        if size >= least:
            yield block
            block, size = [], 0
    if block:
        yield block


def _leaks(words: list[str], index: BlockMaxIndex, threshold: float, verify: float
           ) -> Iterator[tuple[int, float, float, float | None]]:
    """(item_id, score, question overlap, answer overlap) of the verified hits
    of a text's passages."""
    if not words:
        return
    numbers = np.fromiter(map(index.number.get, words, repeat(len(index.postings))), np.int64, len(words))
    for start, end, terms, live in index.passages(numbers, threshold):
        hits = index.search(terms, threshold, live)
        if not hits:
            continue
        here = runs(words[start:end]) | _short_runs(words[start:end], index, hits)
        for item, score in hits:
            question, answer = index.parts[item]
            q = len(question & here) / len(question)
            a = len(answer & here) / len(answer) if answer else None
            if q >= verify and (a is None or a >= verify):
                yield index.ids[item], score, q, a


def _short_runs(words: list[str], index: BlockMaxIndex, hits: list[tuple[int, float]]) -> set[tuple[str, ...]]:
    """Runs as short as those of the hits' questions and answers of under five
    words."""
    sizes = {len(r) for item, _ in hits for part in index.parts[item] for r in part if len(r) < RUN}
    return {tuple(words[i:i + n]) for n in sizes for i in range(len(words) - n + 1)}


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document leaks no item; rows without an id
    stay."""
    return without_ids(docs, find_leaks(docs, benchmark).where("doc_id IS NOT NULL"))
