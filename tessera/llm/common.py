"""Shared helpers of the corpus operators: tables, stored intermediates,
range cuts and connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.session import checkpoint_dir

# Output batches of Python steps are closed at about this many bytes.
BATCH_BYTES = 8 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared checkpoint folder and
    read again: cuts the lineage, and survives lost executors."""
    return stored_at(df, shared_path(df.sparkSession, name))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes an intermediate table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def bounded_sample(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """At most ``size`` rows, those with the smallest hash of ``keys``, in that
    order.  Rows far above the limit are left out by their hash, so that tasks
    send few more than ``size`` rows in all."""
    total, order = df.count(), F.xxhash64(*keys)
    if total > 3 * size:
        share = 2 * size / total  # twice as many as are kept, on average
        df = df.where(F.pmod(order, F.lit(1 << 30)) < int(share * (1 << 30)))
    return df.orderBy(F.pmod(order, F.lit(1 << 30)), *keys).limit(size)


SMALL_ROWS = 2_000_000  # ids or pairs of ids that are broadcast: 32 MB


def small(stored_rows: DataFrame) -> DataFrame:
    """Ids or pairs of ids, marked for broadcast if there are few enough;
    beyond that Spark joins them as it sees fit."""
    return F.broadcast(stored_rows) if stored_rows.count() <= SMALL_ROWS else stored_rows


def without_ids(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id - null counts as one - is not in
    ``rejected``.  The ids are stored and counted, so that the texts are not
    shuffled to meet a few of them."""
    ids = small(stored(rejected.select(F.col("doc_id").alias("_id")).distinct(), "rejected"))
    return docs.join(ids, docs["doc_id"].eqNullSafe(F.col("_id")), "left_anti")


_CACHE: dict[object, object] = {}


def worker_cache(key: object, make: Callable[[], object]):
    """A value that a Python worker keeps between its tasks: one at a time, so
    that a worker that goes on to another operator gives its memory back."""
    if key not in _CACHE:
        if _CACHE:
            _CACHE.clear()
            gc.collect()
            give_back()
        _CACHE[key] = make()
    return _CACHE[key]


def give_back() -> None:
    """Hands free memory of this process back to the system.  Workers outlive
    their tasks, and freed memory otherwise stays with the process."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


class Batches:
    """Collects output rows and yields record batches of bounded bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [[] for _ in schema], 0

    def add(self, row: tuple, size: int) -> bool:
        for column, value in zip(self.rows, row, strict=True):
            column.append(value)
        self.size += size + 32
        return self.size >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        out = pa.record_batch([pa.array(c, f.type) for c, f in zip(self.rows, self.schema, strict=True)],
                              schema=self.schema)
        self.rows, self.size = [[] for _ in self.schema], 0
        return out


def emit(schema: pa.Schema, rows: Iterable[tuple[tuple, int]]) -> Iterator[pa.RecordBatch]:
    """Record batches of (row, bytes) pairs."""
    out = Batches(schema)
    for row, size in rows:
        if out.add(row, size):
            yield out.take()
    if out.rows[0]:
        yield out.take()
    give_back()


# --- range cuts --------------------------------------------------------------

def range_cuts(df: DataFrame, keys: list[str], parts: int, per_part: int = 60) -> list[tuple]:
    """At most ``parts - 1`` increasing cut points of the key tuples, from a
    sample of about ``per_part`` keys a part (bounded by the part count, never
    by the data).  No key may be null.  A tuple that ends in a row hash lets a
    hot key span several parts."""
    total = df.count()
    if parts < 2 or not total:
        return []
    share = min(1.0, parts * per_part / total)
    picked = df.select(*keys)
    if share < 1.0:
        picked = picked.sample(share, seed=17)
    rows = sorted(tuple(r) for r in picked.limit(4 * parts * per_part).collect())
    cuts = [rows[len(rows) * i // parts] for i in range(1, parts)] if rows else []
    return sorted(set(cuts))


def part_of(cuts: list[tuple], key: tuple) -> int:
    return bisect_right(cuts, key)


def part_count(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


# --- connected components ------------------------------------------------------

def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 64) -> DataFrame:
    """``(id, component)`` for every id in ``edges``: the smallest id that can
    be reached.  Alternating large-star and small-star steps; every step is a
    grouped minimum and a join, each round's edges are stored, and a hub's
    rows are never gathered in one value.  Null or self edges are dropped."""
    spark = edges.sparkSession
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u <> v").distinct())
    path = shared_path(spark, "components")
    e = stored_at(e, path)
    for _ in range(rounds):
        large = _star(e, large=True)
        small_path = shared_path(spark, "components")
        small = stored_at(_star(large, large=False), small_path)
        # Stable when every u has one v, and no v is itself a u.
        many = small.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u").limit(1)
        chained = small.join(small.select(F.col("v").alias("u")).distinct(), "u", "left_semi").select("u").limit(1)
        done = many.unionByName(chained).isEmpty()
        remove_path(spark, path)
        e, path = small, small_path
        if done:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
    raise RuntimeError(f"components: not stable after {rounds} rounds")


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Large star: every greater neighbour of ``u`` is linked to the least of
    u and its neighbours; small star: every lesser one is."""
    both = e.select("u", "v")
    if large:
        both = both.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.where("v <= u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
