"""Many globs against one manifest.

Joining every path with every glob is a cross join.  Instead the *head* of a
glob - its text up to the first sign that is not literal - is a key interval:
all paths that start with it.  Paths and heads are cut into the same ranges of
similar size; a glob goes to every range its interval meets.  In a range both
are sorted, and one sweep keeps a stack of the heads that the current path
starts with.  Only the globs on the stack are tried, each as a regular
expression on the rest of the path behind its head.

Cuts are points of (path, hash), so a folder - or one path - with a third of
all entries spans as many ranges as its share.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.functions.paths import glob_to_regex
from tessera.operators.layout import default_parallelism
from tessera.operators.ranking import range_cuts
from tessera.session import checkpoint_dir

LAST_SIGN = "\U0010ffff"
_SPECIAL = re.compile(r"[*?\[{\\]")


def glob_head(pattern: str) -> str:
    """The literal text that every match of a glob starts with."""
    m = _SPECIAL.search(pattern)
    return pattern if not m else pattern[:m.start()]


_KEYED = pa.schema([("part", pa.int32()), ("key", pa.string()), ("pattern", pa.string())])
KEYED = "part int, key string, pattern string"
ROWS = 10_000


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in key order, a head before the paths it fits."""
    schema = pa.schema([("uri", pa.string()), ("pattern", pa.string())])

    def rows():
        stack: list[tuple[str, list[tuple[str, re.Pattern]]]] = []
        for batch in batches:
            for key, pattern in zip(batch.column("key").to_pylist(), batch.column("pattern").to_pylist()):
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if pattern is None:
                    for head, globs in stack:
                        for glob, rest in globs:
                            if rest.fullmatch(key, len(head)):
                                yield key, glob
                    continue
                if not stack or stack[-1][0] != key:
                    stack.append((key, []))
                stack[-1][1].append((pattern, re.compile(glob_to_regex(pattern[len(key):])[1:-1], re.S)))

    return _batches(rows(), schema)


def match_patterns(manifest: DataFrame, patterns: DataFrame, parts: int | None = None) -> DataFrame:
    """``(uri, pattern)`` for every entry of ``manifest`` (``uri``) and every
    distinct glob of ``patterns`` (``pattern``) that matches its whole path, by
    the rules of ``functions.paths.glob_to_regex``.  An entry that is listed
    twice matches twice; NULL paths and globs match nothing."""
    spark = manifest.sparkSession
    checkpoint_dir(spark)
    parts = parts or max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    paths = manifest.where("uri IS NOT NULL").select("uri", F.xxhash64("uri", F.monotonically_increasing_id())
                                                     .alias("mark")).checkpoint()
    cuts = range_cuts(paths, ["uri", "mark"], parts)

    def place(batches):
        rows = ((bisect_right(cuts, (uri, mark)), uri, None) for b in batches
                for uri, mark in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        return _batches(rows, _KEYED)

    def spread(batches):
        def rows():
            for b in batches:
                for glob in b.column(0).to_pylist():
                    head = glob_head(glob)
                    first = bisect_left(cuts, (head,)) if head else 0
                    last = bisect_left(cuts, (head + LAST_SIGN,)) if head else len(cuts)
                    for part in range(first, last + 1):
                        yield part, head, glob
        return _batches(rows(), _KEYED)

    globs = patterns.where("pattern IS NOT NULL").select("pattern").distinct()
    both = paths.mapInArrow(place, KEYED).unionByName(globs.mapInArrow(spread, KEYED))
    return (both.repartitionById(len(cuts) + 1, F.col("part"))
            .sortWithinPartitions("part", "key", F.col("pattern").isNull())
            .select("key", "pattern").mapInArrow(_sweep, "uri string, pattern string"))
