"""Upkeep of stored inverted indexes: merging, and a compact form.

An index is what ``text_index.posting_lists`` (``word, block, doc_ids``) or
``posting_lists_with_counts`` (``word, block, postings``) gives, stored as a
table.  New documents are indexed on their own, and the two indexes become one:
neither index's texts are read again.

Merging works on whole blocks.  Blocks of the wanted size are taken as they
are, others are cut at the borders of the wanted ones inside their row; then
blocks of one ``(word, block)`` meet in one shuffle and are merged.  A group has
at most one block of ``block_size`` entries from each index, however common the
word.

The compact form keeps a block as the gaps between its ids, in bytes of seven
bits each, low bits first, the eighth set on all but a number's last byte.
Every ``SKIP`` postings a *skip entry* holds the id there and the byte behind
it, so a lookup decodes one stretch of a block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessera.operators.text_index import DEFAULT_BLOCK_SIZE, block_of

SKIP = 128


# --- merging ---------------------------------------------------------------------

def _form(index: DataFrame) -> tuple[str, T.DataType]:
    """The list column of an index and the type of its ids."""
    if "postings" in index.columns:
        return "postings", index.schema["postings"].dataType.elementType["doc_id"].dataType
    return "doc_ids", index.schema["doc_ids"].dataType.elementType


def _starts(entries: Column, differs) -> Column:
    """0-based positions of entries that differ from the one before."""
    return F.filter(F.sequence(F.lit(0), F.size(entries) - 1),
                    lambda i: (i == 0) | differs(F.get(entries, i), F.get(entries, i - 1)))


def recut(index: DataFrame, block_size: int) -> DataFrame:
    """The index in blocks of ``block_size`` ids.  Lists are sorted, so a
    block's entries lie side by side: each list is sliced at the borders."""
    column, _ = _form(index)
    id_of = (lambda e: e["doc_id"]) if column == "postings" else (lambda e: e)
    of = lambda e: block_of(id_of(e).cast("long"), block_size)
    lists = index.where(F.size(column) > 0).select("word", F.col(column).alias("_all"))
    inside = of(F.get("_all", F.lit(0))) == of(F.element_at("_all", -1))
    cuts = F.when(inside, F.array(F.lit(0))).otherwise(_starts(F.col("_all"), lambda a, b: of(a) != of(b)))
    cut = lists.withColumn("_cuts", cuts)
    slices = F.transform("_cuts", lambda s, j: F.slice(
        "_all", s + 1, F.coalesce(F.get("_cuts", j + 1), F.size("_all")) - s))
    rows = cut.select("word", F.explode(slices).alias(column))
    return rows.select("word", of(F.get(column, F.lit(0))).alias("block"), column)


def merge_indexes(*indexes: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """One index over the documents of several, in blocks of ``block_size``
    ids.  An id in more than one index comes out once: its counts are added, as
    if its rows had been indexed together.  The blocks given may have any size.
    Ids must be integers: text ids are blocked by their place among all ids,
    which another index changes."""
    if len({_form(i) for i in indexes}) != 1:
        raise ValueError("the indexes must have the same form and the same type of ids")
    column, id_type = _form(indexes[0])
    if not isinstance(id_type, T.IntegralType):
        raise ValueError(f"only indexes over integer ids can be merged, not {id_type.simpleString()}")
    rows = reduce(DataFrame.unionByName, [recut(i, block_size) for i in indexes])
    grouped = rows.groupBy("word", "block").agg(F.collect_list(column).alias("_lists"))
    if column == "doc_ids":
        merged = F.array_sort(F.array_distinct(F.flatten("_lists")))
        return grouped.select("word", "block", F.when(F.size("_lists") == 1, F.get("_lists", F.lit(0)))
                              .otherwise(merged).alias(column))
    ordered = grouped.withColumn("_all", F.when(F.size("_lists") == 1, F.get("_lists", F.lit(0)))
                                 .otherwise(F.sort_array(F.flatten("_lists"))))
    ids = F.col("_all")["doc_id"]
    once = (F.size("_lists") == 1) | (F.size(F.array_distinct(ids)) == F.size(ids))
    starts = ordered.withColumn("_starts", F.when(~once, _starts(F.col("_all"), lambda a, b: a["doc_id"] != b["doc_id"])))
    summed = F.transform("_starts", lambda s, j: F.struct(
        F.get("_all", s)["doc_id"].alias("doc_id"),
        F.aggregate(F.slice("_all", s + 1, F.coalesce(F.get("_starts", j + 1), F.size("_all")) - s),
                    F.lit(0).cast("long"), lambda n, e: n + e["n"]).alias("n")))
    return starts.select("word", "block", F.when(F.col("_starts").isNull(), F.col("_all")).otherwise(summed).alias(column))


# --- compact form ------------------------------------------------------------------

COMPACT = "word string, block long, n long, first long, skip_ids array<long>, skip_at array<int>, gaps binary"
_COMPACT = pa.schema([("word", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("first", pa.int64()),
                      ("skip_ids", pa.list_(pa.int64())), ("skip_at", pa.list_(pa.int32())), ("gaps", pa.binary())])


def put_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative numbers as bytes of seven bits; and where each number starts."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1 << (7 * k))
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    for k in range(int(sizes.max(initial=0))):
        at = sizes > k
        low = (values[at] >> np.uint64(7 * k)) & np.uint64(0x7F)
        out[starts[at] + k] = low.astype(np.uint8) | ((sizes[at] > k + 1) * np.uint8(0x80))
    return out, starts


def get_numbers(data: bytes | np.ndarray) -> np.ndarray:
    """The numbers that ``put_numbers`` wrote."""
    b = np.frombuffer(data, np.uint8)
    if not len(b):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(b < 0x80)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(b)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((b & 0x7F).astype(np.uint64) << (7 * place).astype(np.uint64), starts)


def _encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        bounds = lists.offsets.to_numpy()
        sizes = np.diff(bounds)
        ids = lists.values.to_numpy()[bounds[0]:bounds[-1]]
        firsts = np.cumsum(sizes) - sizes
        gaps = np.diff(ids, prepend=ids[:1])
        gaps[firsts] = 0
        keep = np.ones(len(ids), bool)
        keep[firsts] = False                 # a list's first id is a column of its own
        data, starts = put_numbers(gaps[keep])
        at = np.append(starts, len(data))    # byte behind posting i is that of gap i + 1
        behind = np.cumsum(keep)             # gaps up to and with posting i
        base = at[behind[firsts]]
        skips = [np.arange(SKIP, n, SKIP) for n in sizes]
        raw = data.tobytes()
        ends = at[behind[firsts + sizes - 1]]
        yield pa.RecordBatch.from_arrays([
            batch.column("word"), batch.column("block"), pa.array(sizes, pa.int64()), pa.array(ids[firsts], pa.int64()),
            pa.array([ids[f + s] for f, s in zip(firsts, skips)], pa.list_(pa.int64())),
            pa.array([(at[behind[f + s]] - o).astype(np.int32) for f, s, o in zip(firsts, skips, base)],
                     pa.list_(pa.int32())),
            pa.array([raw[a:b] for a, b in zip(base, ends)], pa.binary())], schema=_COMPACT)


def compact(index: DataFrame) -> DataFrame:
    """Posting lists (``word, block, doc_ids``) with their ids as gaps:
    ``word, block, n, first, skip_ids, skip_at, gaps``."""
    lists = index.where(F.size("doc_ids") > 0).select("word", "block", F.col("doc_ids").cast("array<long>").alias("ids"))
    return lists.mapInArrow(_encode, COMPACT)


def _decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = batch.column("n").to_numpy()
        firsts = np.cumsum(sizes) - sizes
        steps = np.zeros(int(sizes.sum()), np.int64)
        keep = np.ones(len(steps), bool)
        keep[firsts] = False
        steps[keep] = get_numbers(b"".join(batch.column("gaps").to_pylist())).astype(np.int64)
        ids = np.cumsum(steps)
        ids += np.repeat(batch.column("first").to_numpy() - ids[firsts], sizes)
        offsets = pa.array(np.append(firsts, len(ids)), pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("block"),
                                          pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int64()))],
                                         names=["word", "block", "doc_ids"])


def expand(stored: DataFrame) -> DataFrame:
    """The posting lists (``word, block, doc_ids``) of a compact index."""
    return stored.select("word", "block", "n", "first", "gaps").mapInArrow(
        _decode, "word string, block long, doc_ids array<long>")


def _holds(first: int, skip_ids: list[int], skip_at: list[int], gaps: bytes, doc: int) -> bool:
    """Whether a block holds an id, from the stretch behind the last skip
    entry not beyond it."""
    k = int(np.searchsorted(np.array(skip_ids, np.int64), doc, side="right"))
    start, at = (skip_ids[k - 1], skip_at[k - 1]) if k else (first, 0)
    if doc <= start:
        return doc == start
    end = skip_at[k] if k < len(skip_at) else len(gaps)
    ids = start + np.cumsum(get_numbers(gaps[at:end]).astype(np.int64))
    return bool(np.any(ids == doc))


def lookup(stored: DataFrame, asked: DataFrame, block_size: int = DEFAULT_BLOCK_SIZE) -> DataFrame:
    """``(word, doc_id, found)`` for the pairs ``asked`` (``word, doc_id``) of a
    compact index in blocks of ``block_size``: a pair meets the one block it
    can be in, of which one stretch is decoded."""
    pairs = asked.select("word", F.col("doc_id").cast("long").alias("doc_id")).withColumn(
        "block", block_of(F.col("doc_id"), block_size))

    def look(batches):
        for batch in batches:
            cells = zip(*(batch.column(c).to_pylist() for c in ("first", "skip_ids", "skip_at", "gaps", "doc_id")))
            found = [row[0] is not None and _holds(*row) for row in cells]
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("doc_id"), pa.array(found)],
                                             names=["word", "doc_id", "found"])

    met = pairs.join(stored, ["word", "block"], "left")
    return met.select("word", "doc_id", "first", "skip_ids", "skip_at", "gaps").mapInArrow(
        look, "word string, doc_id long, found boolean")
