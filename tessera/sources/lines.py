"""Lines with their numbers and byte offsets, from splits of files.

A text input format hands a mapper each line with its byte offset.  Spark's
text source drops both the offset and the order of lines over splits.  Here
files are cut into byte splits, and a line belongs to the split that holds its
first byte; its end may lie in a later one.  The first pass counts the lines
of every split; a prefix sum over the splits of each file
(``ranking.exclusive_prefix_sum``) gives the number of a split's first line;
the second pass reads the lines and numbers them on from there.  Only the splits'
counts are shuffled, never lines, and no task sees more than a split and the
end of its last line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.functions.files import filesystem_for
from tessera.operators.layout import default_parallelism
from tessera.operators.ranking import exclusive_prefix_sum

SPLIT_BYTES = 64 << 20
BUFFER = 1 << 20
TAIL = 16 << 10     # least bytes of a read, also behind a split's end
BATCH_BYTES = 8 << 20


def _split_lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """``(offset, line)`` of the lines whose first byte is in ``[start, end)``.
    A line ends with LF, CR or CR LF, which is not part of it."""
    at = max(0, start - 1)          # the byte before tells whether a line starts here
    f.seek(at)
    data, done, more = b"", 0, True  # data[done:] starts at byte ``at`` of the file
    known = {b"\n": -1, b"\r": -1}   # where in ``data`` the next of each is, its length if there is none

    def fill() -> bool:
        nonlocal data, done, more
        if more:
            chunk = f.read(min(BUFFER, max(end - at - (len(data) - done), TAIL)))
            for byte, place in known.items():
                known[byte] = place - done if place < len(data) else -1
            data, done, more = data[done:] + chunk, 0, bool(chunk)
        return more

    def next_of(byte: bytes, seen: int) -> int:
        if known[byte] < seen:
            found = data.find(byte, seen)
            known[byte] = found if found >= 0 else len(data)
        return known[byte]

    def line_end(limit: int | None = None) -> tuple[int, int] | None:
        """Where the line in hand ends and the next one starts, in ``data``;
        None if it has no end, or none before byte ``limit``."""
        seen = done
        while True:
            e = min(next_of(b"\n", seen), next_of(b"\r", seen))
            if e < len(data):
                if data[e:e + 1] == b"\r" and e + 1 == len(data) and more:
                    seen = e - done
                    fill()
                    continue
                return e, e + 2 if data[e:e + 2] == b"\r\n" else e + 1
            seen = len(data) - done
            if limit is not None and at + seen >= limit or not fill():
                return None

    fill()
    if start:
        found = line_end(end)   # splits inside a long line do not read on to its end
        if found is None:
            return
        at, done = at + found[1] - done, found[1]
    while at < end:
        found = line_end()
        if found is None:
            if done < len(data):
                yield at, data[done:]
            return
        yield at, data[done:found[0]]
        at, done = at + found[1] - done, found[1]


def file_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(path, split, split_end)`` of the files ``(uri, len)``."""
    starts = F.sequence(F.lit(0).cast("long"), F.col("len") - 1, F.lit(split_bytes).cast("long"))
    cut = files.where("file_type = 'file' AND len > 0").select(
        F.col("uri").alias("path"), F.col("len").cast("long").alias("len"))
    return cut.withColumn("split", F.explode(starts)).select(
        "path", "split", F.least(F.col("split") + split_bytes, F.col("len")).alias("split_end"))


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = []
        for path, split, end in _rows([batch]):
            fs, local = filesystem_for(path)
            with fs.open_input_file(local) as f:
                lines.append(sum(1 for _ in _split_lines(f, split, end)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.int64())],
                                         names=["path", "split", "split_end", "lines"])


_LINES = pa.schema([("path", pa.string()), ("line_no", pa.int64()), ("start", pa.int64()), ("value", pa.string())])


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for path, split, end, number in _rows(batches):
        fs, local = filesystem_for(path)
        with fs.open_input_file(local) as f:
            for k, (at, line) in enumerate(_split_lines(f, split, end)):
                out.append((path, number + k, at, line.decode("utf-8")))
                size += len(line) + 64
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _LINES)], schema=_LINES)
                    out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), _LINES)], schema=_LINES)


def numbered_lines(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(path, line_no, start, value)`` of every line of the files of a
    manifest (``uri, len, file_type``): its number in the file from 0, the
    offset of its first byte, and its text (UTF-8; other bytes fail the job).
    A last line without an end counts, an empty file has no line."""
    spark = files.sparkSession
    n = default_parallelism(spark)
    counted = file_splits(files, split_bytes).repartition(n, "path", "split").mapInArrow(
        _count, "path string, split long, split_end long, lines long")
    numbered = exclusive_prefix_sum(counted, "split", F.col("lines"), "number", group_col="path").select(
        "path", "split", "split_end", F.col("number").cast("long").alias("number")).checkpoint()
    return numbered.repartition(n, "path", "split").mapInArrow(
        _read, "path string, line_no long, start long, value string")
