"""Embedding near-duplicates by NN-descent.

1. Equal vectors of a label form a class; its smallest id stands for it.
2. A neighbour graph starts from the leaves of random hyperplane trees: rows
   are sorted by (tree, label, side bits, projection) and compared in blocks
   of at most ``LEAF`` rows, so a leaf of any size costs in proportion.  The
   side bits follow the label's own size, and so does the number of trees: two
   vectors at the threshold share a leaf with a chance above ``recall``.
3. It is refined by neighbours-of-neighbours joins: all neighbours of a vector,
   both ways, meet and are compared, in salted groups where one has many.  Each
   keeps its ``width`` nearest, however far.  Rounds end when few links come.
4. A list that is saturated - its ``width`` nearest all reach the threshold -
   is enlarged to the vector's whole component, whose members are compared in
   tiles that only give link counts.
5. Recall is audited by brute force for a sample of vectors outside such
   components, which grows with the rows, against all rows; each vector with a
   link weighs the same.  Below ``recall`` more trees are added and 3 to 5 run
   again.  If no vector of the sample has a link, the chance in 2 stands alone.

Similarities are in double precision.  Links below the threshold are dropped.
"""

from __future__ import annotations

import logging
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import bounded_sample, components, emit, small, stored

log = logging.getLogger(__name__)

LEAF, TILE, GROUP = 256, 512, 64
ASKED, LEAST_AUDITED = 2048, 100
_EDGE = "a long, b long, sim double"
_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("sim", pa.float64())])
_LEAVES = pa.schema([("leaf", pa.string()), ("at", pa.float64()), ("id", pa.int64())])


def usable(vec: Column) -> Column:
    """Whether a vector can link: no null or non-finite component, not zero."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def _runs(batches: Iterator[pa.RecordBatch], limit: int, lap: int) -> Iterator[tuple[str, list[pa.Array]]]:
    """(key, other columns) for runs of equal first column, at most ``limit``
    rows at once; the next piece of a longer run repeats the last ``lap``."""
    key, held = None, None

    def pieces(rows: pa.Table, end: bool):
        while rows.num_rows > limit or end and rows.num_rows:
            yield key, [c.combine_chunks() for c in rows.slice(0, limit).columns[1:]]
            if rows.num_rows <= limit:
                return
            rows = rows.slice(limit - lap)
        yield None, rows

    for b in batches:
        names = b.column(0).to_pylist()
        cuts = [0, *(i for i in range(1, len(names)) if names[i] != names[i - 1]), len(names)]
        for start, end in zip(cuts, cuts[1:]):
            if start == end:
                continue
            if names[start] != key:
                if held is not None:
                    yield from ((k, c) for k, c in pieces(held, True) if k is not None)
                key, held = names[start], None
            new = pa.Table.from_batches([b.slice(start, end - start)])
            held = new if held is None else pa.concat_tables([held, new])
            for k, c in pieces(held, False):
                if k is None:
                    held = c
                else:
                    yield k, c
    if held is not None:
        yield from ((k, c) for k, c in pieces(held, True) if k is not None)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Unit rows in double precision; the vectors have one length."""
    m = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the norm
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _nearest(ids: np.ndarray, m: np.ndarray, width: int, threshold: float, bars: np.ndarray | None = None,
             others: int | None = None):
    """Edge arrays (a, b, sim): of each row's ``width`` nearest those that
    reach the threshold and, of the ``others`` nearest, those above its bar."""
    sims = m @ m.T
    sims[ids[:, None] == ids[None, :]] = -2.0
    k = min(width, len(ids) - 1)
    near = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(sims, near, 1)
    keep = best > (-2.0 if bars is None else bars[:, None])
    if others is not None and others < k:
        keep &= best >= -np.partition(-best, others - 1, axis=1)[:, others - 1:others]
    keep = (keep | (best >= threshold)) & (best > -2.0)
    return np.broadcast_to(ids[:, None], near.shape)[keep], ids[near[keep]], best[keep]


def _edges(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Edge arrays in record batches of bounded size."""
    held, rows = [], 0
    for arrays in found:
        held.append(arrays)
        rows += len(arrays[0])
        if rows >= 1 << 16:
            yield pa.record_batch([np.concatenate(c) for c in zip(*held)], schema=_EDGES)
            held, rows = [], 0
    if rows:
        yield pa.record_batch([np.concatenate(c) for c in zip(*held)], schema=_EDGES)


def label_trees(count: int, threshold: float, miss: float, least: int) -> tuple[int, int]:
    """(side bits, trees) for a label of ``count`` classes: leaves of about
    ``LEAF / 2`` rows, and so many trees that two vectors at the threshold
    share a leaf of at least one with probability ``1 - miss``."""
    bits = max(0, int(np.ceil(np.log2(max(1, count) / (LEAF // 2)))))
    same = (1 - np.arccos(min(1.0, max(-1.0, threshold))) / np.pi) ** bits
    return bits, least if same >= 1 else max(least, int(np.ceil(np.log(miss) / np.log1p(-same))))


def _trees(reps: DataFrame, attempt: int, threshold: float, miss: float, least: int) -> DataFrame:
    """``leaf, at, id``: each vector's leaf in each tree of its label and its
    place there; every attempt doubles the trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}

        def plane(length: int, t: int) -> np.ndarray:
            if (length, t) not in planes:
                planes[length, t] = np.random.default_rng([5, attempt, t]).normal(size=(length, 49))
            return planes[length, t]

        def out():
            for label, (ids, classes, vectors) in _runs(batches, 2048, 0):
                m, numbers = _matrix(vectors), ids.to_pylist()
                bits, trees = label_trees(classes[0].as_py(), threshold, miss, least)
                for t in range(trees << attempt):
                    p = m @ plane(m.shape[1], t)[:, :bits + 1]
                    codes = (p[:, 1:] > 0) @ (1 << np.arange(bits)) if bits else np.zeros(len(p), int)
                    for n, code, at in zip(numbers, codes.tolist(), p[:, 0].tolist(), strict=True):
                        yield (f"{attempt}.{t}/{label}/{code}", at, n), 60
        yield from emit(_LEAVES, out())

    return reps.select("label", "id", "classes", "vec").mapInArrow(run, "leaf string, at double, id long")


def _start(reps: DataFrame, attempt: int, width: int, threshold: float, miss: float, least: int) -> DataFrame:
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(_trees(reps, attempt, threshold, miss, least), "leaves").join(reps.select("id", "vec"), "id") \
        .select("leaf", "at", "id", "vec")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _edges(_nearest(ids.to_numpy(), _matrix(vectors), width, threshold, others=width // 4)
                          for _, (_, ids, vectors) in _runs(batches, LEAF, LEAF // 2) if len(ids) > 1)

    return (placed.repartitionByRange(parts, "leaf", "at", "id").sortWithinPartitions("leaf", "at", "id")
            .mapInArrow(run, _EDGE))


def _shortest(edges: DataFrame, width: int) -> DataFrame:
    """Each vector's ``width`` nearest; a vector has at most ``width`` edges
    from each source, so its window is small."""
    best = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return best.withColumn("r", rank).where(F.col("r") <= width).drop("r")


def _descend(lists: DataFrame, reps: DataFrame, width: int, threshold: float, turn: int) -> DataFrame:
    """Edges among the neighbours, both ways, of each vector and itself that
    are links or nearer than the last of a full list."""
    ways = lists.select(F.col("a").alias("mid"), F.col("b").alias("id")).unionByName(
        lists.select(F.col("b").alias("mid"), F.col("a").alias("id"))).distinct()
    own = lists.select(F.col("a").alias("mid")).distinct().withColumn("id", F.col("mid"))
    ways = ways.unionByName(own)
    sizes = ways.groupBy("mid").agg(F.ceil(F.count("*") / GROUP).alias("groups")).where("groups > 1")
    group = F.concat_ws("/", "mid", F.pmod(F.xxhash64("id", F.lit(turn)), F.coalesce("groups", F.lit(1))))
    bars = lists.groupBy("a").agg(F.when(F.count("*") >= width, F.min("sim")).alias("bar"))
    known = reps.select("id", "vec").join(bars.withColumnRenamed("a", "id"), "id", "left").select(
        "id", F.coalesce("bar", F.lit(-2.0)).alias("bar"), "vec")
    rows = (ways.join(sizes, "mid", "left").select(group.alias("mid"), "id")
            .join(known, "id").select("mid", "id", "bar", "vec"))
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _edges(_nearest(ids.to_numpy(), _matrix(vectors), width, threshold, bars.to_numpy())
                          for _, (ids, bars, vectors) in _runs(batches, 4 * GROUP, GROUP) if len(ids) > 1)

    return rows.repartition(parts, "mid").sortWithinPartitions("mid", "id").mapInArrow(run, _EDGE)


def _counted(reps: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """``id, links``: exact link counts (of vectors) inside each component of
    ``groups(id, component)``, by tiles."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    rows = (groups.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .select(F.concat_ws("/", "component", F.least("block", "other"), F.greatest("block", "other"))
                    .alias("tile"), "block", "id")
            .join(reps.select("id", "size", "vec"), "id").select("tile", "block", "id", "size", "vec"))
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64())])
    parts = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for _, (block, ids, size, vectors) in _runs(batches, 1 << 20, 0):  # a tile is whole
                block, ids, size, m = block.to_numpy(), ids.to_numpy(), size.to_numpy(), _matrix(vectors)
                low, high = block == block.min(), block == block.max()
                links = np.zeros(len(ids), np.int64)
                near = (m[low] @ m[high].T >= threshold) & (ids[low][:, None] != ids[high][None, :])
                links[low] += near @ size[high]
                if not (low & high).any():
                    links[high] += near.T @ size[low]
                for i, n in zip(ids.tolist(), links.tolist(), strict=True):
                    yield (i, n), 16
        yield from emit(schema, out())

    return (rows.repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(run, "id long, links long")
            .groupBy("id").agg(F.sum("links").alias("links")))


def _audit(reps: DataFrame, found: DataFrame, exact: DataFrame, threshold: float, sample: int) -> tuple[float, int]:
    """(recall, vectors): the share of a vector's links, found by brute force
    against all rows of its label, that ``found(id, links)`` has, as the mean
    over the asked vectors with a link, and how many those are.  Vectors of
    ``exact(id)`` are not asked, as their links are complete.  The asked set
    grows with the root of the rows, and further while few have a link."""
    rows = reps.join(exact, "id", "left_anti")
    count = rows.count()
    size = max(sample, 16 * int(np.ceil(np.sqrt(count))))
    for _ in range(3):
        got, seen = _audited(reps, found, bounded_sample(rows, size, "id"), min(size, count), threshold)
        if seen >= LEAST_AUDITED or size >= count:
            break
        size *= 2
    return got, seen


def _audited(reps: DataFrame, found: DataFrame, asked: DataFrame, size: int, threshold: float) -> tuple[float, int]:
    asked = stored(asked.select("label", "id", "vec"), "asked")
    blocks = max(1, -(-size // ASKED))
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64())])
    true = None
    for block in range(blocks):
        queries: dict[str, tuple[list, list]] = {}
        for r in asked.where(F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)) == block).collect():  # about ASKED
            queries.setdefault(r["label"], ([], []))[0].append(r["id"])
            queries[r["label"]][1].append(r["vec"])
        shared = reps.sparkSession.sparkContext.broadcast(
            {k: (np.array(i), _matrix(pa.array(v, pa.list_(pa.float64())))) for k, (i, v) in queries.items()})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            def out():
                for label, (ids, size, vectors) in _runs(batches, 1024, 0):
                    if label in shared.value:
                        asked_ids, m = shared.value[label]
                        near = (m @ _matrix(vectors).T >= threshold) & (asked_ids[:, None] != ids.to_numpy()[None, :])
                        at, other = np.nonzero(near)
                        links = np.bincount(at, size.to_numpy()[other], len(asked_ids))
                        for i in np.flatnonzero(links).tolist():
                            yield (int(asked_ids[i]), int(links[i])), 16
            yield from emit(schema, out())

        part = reps.select("label", "id", "size", "vec").mapInArrow(run, "id long, links long")
        true = part if true is None else true.unionByName(part)
    true = true.groupBy("id").agg(F.sum("links").alias("links"))
    have, seen = true.join(found.withColumnRenamed("links", "got"), "id", "left").agg(
        F.avg(F.least("links", F.coalesce("got", F.lit(0))) / F.col("links")), F.count("*")).first()
    return (1.0 if have is None else have), seen


def near_vectors(vectors: DataFrame, threshold: float = 0.93, width: int = 16, trees: int = 8, rounds: int = 4,
                 recall: float = 0.98, sample: int = 256) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for ``vectors(vec_id,
    embedding, label)``: vectors of one label link at cosine >= ``threshold``.

    ``n_links`` counts the other vectors linked directly, ``component_id`` is
    the smallest vec_id that links reach, ``kept`` marks the row that has it.
    Vectors that are null, empty or zero or hold null or non-finite
    components, and those with a null label, link with nothing; nor do
    vectors of different lengths.  Rows that repeat in all three columns count
    once; a null vec_id has null as component and is kept.  Other columns are
    ignored; an empty table gives none.  At least ``trees`` trees a label.
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding",
                           F.col("label").cast("string").alias("label")).distinct()
    given = stored(given.withColumn("ok", usable(F.col("embedding")) & F.col("label").isNotNull()
                                    & F.col("vec_id").isNotNull()), "vectors")
    key = F.concat_ws("/", F.size("embedding"), "label")
    reps = stored(given.where("ok").groupBy(key.alias("label"), F.col("embedding").alias("vec"))
                  .agg(F.min("vec_id").alias("id"), F.count("*").alias("size")), "reps")
    labels = small(stored(reps.groupBy("label").agg(F.count("*").alias("classes")), "labels"))
    reps = stored(reps.join(labels, "label").repartition("label", "id").sortWithinPartitions("label"), "reps")
    links, lists, found = None, None, None
    for attempt in range(4):
        more = _start(reps, attempt, width, threshold, (1 - recall) / 2, trees)
        seen = more if links is None else more.unionByName(links).unionByName(lists)
        seen = stored(seen.groupBy("a", "b").agg(F.max("sim").alias("sim")), "edges")
        lists = stored(_shortest(seen, width), "lists")
        links = seen.where(F.col("sim") >= threshold)
        before = links.count()
        for turn in range(rounds):
            got = stored(_descend(lists, reps, width, threshold, 10 * attempt + turn), "edges")
            lists = stored(_shortest(got.unionByName(lists), width), "lists")
            links = stored(links.unionByName(got.where(F.col("sim") >= threshold)).groupBy("a", "b")
                           .agg(F.max("sim").alias("sim")), "links")
            had, before = before, links.count()
            if before <= 1.001 * had:
                break
        groups = stored(components(links.select("a", "b")), "groups")
        full = links.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") >= width).select(F.col("a").alias("id"))
        wide = groups.join(full, "id").select("component").distinct()
        whole = groups.join(wide, "component", "left_semi")
        exact = _counted(reps, whole, threshold)
        few = (links.join(groups.withColumnRenamed("id", "a"), "a").join(wide, "component", "left_anti")
               .select("a", "b").unionByName(links.join(groups.withColumnRenamed("id", "a"), "a")
                                             .join(wide, "component", "left_anti")
                                             .select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
               .join(reps.select(F.col("id").alias("b"), "size"), "b")
               .groupBy(F.col("a").alias("id")).agg(F.sum("size").alias("links")))
        found = stored(exact.unionByName(few), "found")
        reached, audited = _audit(reps, found, whole.select("id"), threshold, sample)
        log.info("near_vectors: attempt %d, recall %.4f over %d audited vectors with a link", attempt, reached, audited)
        if reached >= recall:
            break
    else:
        warnings.warn(f"near_vectors: audited recall {reached:.3f} below {recall}", stacklevel=2)
    ends = reps.select("label", F.col("vec").alias("embedding"), "id", "size") \
        .join(found, "id", "left").join(groups, "id", "left").select(
        F.col("label").alias("key"), "embedding", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    out = given.withColumn("key", F.when(F.col("ok"), key)).join(ends, ["key", "embedding"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
