"""Byte ranges as work: files merged in order, large files copied by many tasks.

A *range* says which bytes of a source go where in a target:
``(src, src_start, dest, dest_start, length)``.  A file larger than
``range_bytes`` is many ranges, so no task ever moves a whole large file, and a
target made of many files is filled by many tasks at once.

* ``merge_in_order`` - the files of a manifest, in path order, as one file, byte
  for byte.  A file's place in the target is the sum of the lengths before it
  (``ranking.exclusive_prefix_sum``).
* ``copy_ranges``    - each file to its destination, by ranges.

Both write by ``write_ranges``, in three steps of small jobs:

1. every target gets a temporary file of its full length beside it,
2. every task writes its ranges at their offsets, reads them back and compares
   the checksum with that of the source bytes,
3. a target whose ranges are all right and cover its length is renamed into
   place; any other is removed and reported.

A range always puts the same bytes at the same place, so a retried or
speculative task repeats what is there and harms nothing.  HDFS files cannot
be written at an offset: there a range is a file of its own, and step 3 joins
them with the name node's ``concat``, which moves no bytes (by Hadoop's
contract; not run here).  Other file systems are refused.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tessera.functions.files import filesystem_for, is_local, qualify
from tessera.functions.paths import parent_str
from tessera.operators.copy import TEMP_PREFIX, move_over
from tessera.operators.layout import default_parallelism
from tessera.operators.ranking import exclusive_prefix_sum
from tessera.session import checkpoint_dir

RANGE_BYTES = 256 << 20
BUFFER = 4 << 20

RANGE_STATUS = "dest string, dest_start long, length long, crc32 long, ok boolean, message string"
_STATUS = pa.schema([("dest", pa.string()), ("dest_start", pa.int64()), ("length", pa.int64()), ("crc32", pa.int64()),
                     ("ok", pa.bool_()), ("message", pa.string())])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _emit(rows: Iterable[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    out = []
    for row in rows:
        out.append(row)
        if len(out) == size:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def in_ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    """``files`` (``src, dest, dest_start, length``) cut into ranges of at most
    ``range_bytes``.  A file without bytes has no range."""
    if range_bytes < 1:
        raise ValueError("range_bytes must be at least 1 byte")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    cut = files.where("length > 0").withColumn("src_start", F.explode(starts))
    return cut.select("src", "src_start", "dest", (F.col("dest_start") + F.col("src_start")).alias("dest_start"),
                      F.least(F.col("length") - F.col("src_start"), F.lit(range_bytes)).alias("length"))


def _temporary(dest: str, run: str) -> str:
    """The unfinished form of a target, beside it."""
    return f"{(parent_str(dest) or '/').rstrip('/')}/{TEMP_PREFIX}{run}.{os.path.basename(dest)}"


def _part(dest: str, run: str, start: int) -> str:
    return f"{_temporary(dest, run)}.{start:020d}"


def _prepare_fn(run: str):
    """Temporary files of full length; local file systems only."""
    def prepare(batches):
        def rows():
            for dest, length in _rows(batches):
                try:
                    with open(filesystem_for(_temporary(dest, run))[1], "ab") as f:
                        f.truncate(length)
                    yield dest, 0, length, None, True, "prepared"
                except OSError as e:
                    yield dest, 0, length, None, False, f"{type(e).__name__}: {e}"
        return _emit(rows(), _STATUS)
    return prepare


def _chunks(uri: str, start: int, length: int) -> Iterator[bytes]:
    fs, path = filesystem_for(uri)
    with fs.open_input_file(path) as f:
        f.seek(start)
        while length > 0:
            chunk = f.read(min(BUFFER, length))
            if not chunk:
                return
            length -= len(chunk)
            yield chunk


def _write(src: str, src_start: int, dest: str, dest_start: int, length: int, run: str) -> tuple[int, int]:
    """Writes one range; its length and the checksum of the source's bytes."""
    crc = written = 0
    if is_local(dest):
        with open(filesystem_for(_temporary(dest, run))[1], "r+b") as out:
            out.seek(dest_start)
            for chunk in _chunks(src, src_start, length):
                out.write(chunk)
                crc, written = zlib.crc32(chunk, crc), written + len(chunk)
    else:
        part, ctx = _part(dest, run, dest_start), TaskContext.get()
        fs, path = filesystem_for(part)
        own = f"{path}.{ctx.taskAttemptId() if ctx else uuid.uuid4().hex}"
        with fs.open_output_stream(own) as out:
            for chunk in _chunks(src, src_start, length):
                out.write(chunk)
                crc, written = zlib.crc32(chunk, crc), written + len(chunk)
        move_over(fs, own, path)
    return written, crc


def _crc_at(dest: str, dest_start: int, length: int, run: str) -> int:
    crc = 0
    at, start = (_temporary(dest, run), dest_start) if is_local(dest) else (_part(dest, run, dest_start), 0)
    for chunk in _chunks(at, start, length):
        crc = zlib.crc32(chunk, crc)
    return crc


def _write_fn(run: str):
    def write(batches):
        def rows():
            for src, src_start, dest, dest_start, length in _rows(batches):
                try:
                    written, crc = _write(src, src_start, dest, dest_start, length, run)
                    if written != length:
                        yield dest, dest_start, written, crc, False, f"{src} ends {length - written} bytes early"
                    elif _crc_at(dest, dest_start, length, run) != crc:
                        yield dest, dest_start, written, crc, False, "the target holds other bytes than the source"
                    else:
                        yield dest, dest_start, written, crc, True, "written"
                except OSError as e:
                    yield dest, dest_start, 0, None, False, f"{type(e).__name__}: {e}"
        return _emit(rows(), _STATUS)
    return write


def _finish_fn(run: str):
    """Renames whole targets into place, removes the others."""
    def finish(batches):
        def rows():
            for dest, length, whole, message in _rows(batches):
                fs, tmp = filesystem_for(_temporary(dest, run))
                try:
                    if whole:
                        move_over(fs, tmp, filesystem_for(dest)[1])
                    elif fs.get_file_info(tmp).type == pafs.FileType.File:
                        fs.delete_file(tmp)
                    yield dest, 0, length, None, whole, message
                except OSError as e:
                    yield dest, 0, length, None, False, f"{type(e).__name__}: {e}"
        return _emit(rows(), _STATUS)
    return finish


def _concat(spark, run: str, done: DataFrame, ranges: DataFrame) -> None:
    """Joins the parts of whole targets on HDFS, target by target: one call of
    the name node each, with the names of one target's parts."""
    conf = spark._jsc.hadoopConfiguration()
    Path = spark._jvm.org.apache.hadoop.fs.Path
    for row in done.toLocalIterator():
        starts = sorted(r["dest_start"] for r in ranges.where(F.col("dest") == row["dest"]).select("dest_start").collect())
        parts = [Path(_part(row["dest"], run, s)) for s in starts]
        fs, tmp = parts[0].getFileSystem(conf), Path(_temporary(row["dest"], run))
        fs.rename(parts[0], tmp)
        if parts[1:]:
            array = spark._sc._gateway.new_array(Path, len(parts) - 1)
            for i, p in enumerate(parts[1:]):
                array[i] = p
            fs.concat(tmp, array)


def write_ranges(ranges: DataFrame, targets: DataFrame, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Fills ``targets`` (``dest, length``) from ``ranges``; returns the status
    of the ranges and that of the targets, both stored.  Ranges of one target
    that lie side by side go to one task, ``tasks`` in all."""
    spark = targets.sparkSession
    checkpoint_dir(spark)
    tasks, run = tasks or default_parallelism(spark), uuid.uuid4().hex[:12]
    targets = targets.select("dest", F.col("length").cast("long").alias("length")).checkpoint()
    local = F.col("dest").startswith("file:") | ~F.col("dest").contains("://")
    hdfs = targets.where(~local)
    if not hdfs.where(~F.col("dest").rlike("^(hdfs|viewfs)://")).isEmpty():
        raise ValueError("files can be written by ranges on local file systems and HDFS only")
    ready = (targets.where(local).repartition(tasks, "dest").mapInArrow(_prepare_fn(run), RANGE_STATUS).checkpoint())
    usable = ready.where("ok").select("dest").unionByName(hdfs.select("dest"))
    work = ranges.join(usable, "dest", "left_semi").select("src", "src_start", "dest", "dest_start", "length")
    status = (work.repartitionByRange(tasks, "dest", "dest_start").sortWithinPartitions("dest", "dest_start")
              .mapInArrow(_write_fn(run), RANGE_STATUS).checkpoint())
    filled = status.groupBy("dest").agg(
        F.sum(F.when(F.col("ok"), F.col("length"))).alias("written"),
        F.first(F.when(~F.col("ok"), F.col("message")), ignorenulls=True).alias("fault"))
    judged = (targets.join(filled, "dest", "left")
              .join(ready.where("NOT ok").select("dest", F.col("message").alias("unready")), "dest", "left"))
    fault = F.coalesce("unready", "fault")
    whole = fault.isNull() & (F.coalesce("written", F.lit(0)) == F.col("length"))
    short = F.concat(F.coalesce("written", F.lit(0)).cast("string"), F.lit(" bytes written of "), F.col("length"))
    judged = judged.select("dest", "length", whole.alias("whole"),
                           F.when(whole, F.lit("written")).otherwise(F.coalesce(fault, short)).alias("message"))
    judged = judged.checkpoint()
    _concat(spark, run, judged.where(F.col("whole") & ~local & (F.col("length") > 0)).select("dest"), work)
    finished = judged.repartition(tasks, "dest").mapInArrow(_finish_fn(run), RANGE_STATUS).checkpoint()
    return status, finished.select("dest", "length", "ok", "message")


def _raise_faults(finished: DataFrame) -> None:
    bad = finished.where(~F.col("ok")).limit(3).collect()
    if bad:
        raise RuntimeError("files not written: " + "; ".join(f"{r['dest']}: {r['message']}" for r in bad))


def merge_in_order(manifest: DataFrame, dest: str, range_bytes: int = RANGE_BYTES,
                   tasks: int | None = None) -> DataFrame:
    """Merges the files of ``manifest`` (``uri, len``), byte for byte and in
    path order, into the file ``dest``, replacing one that is there.  Returns
    the places of the files in it, ``(uri, start, length)``.  Nothing is put
    between files, files without bytes have a place of length 0, and an empty
    manifest gives an empty file.  Raises, and leaves the target as it was, if
    a file is shorter than listed or cannot be read."""
    spark = manifest.sparkSession
    dest = qualify(dest, spark)
    files = manifest.where(F.col("file_type") == "file").select("uri", F.col("len").cast("long").alias("length"))
    places = exclusive_prefix_sum(files, "uri", F.col("length"), "start").select(
        "uri", F.col("start").cast("long").alias("start"), "length").checkpoint()
    ranges = in_ranges(places.select(F.col("uri").alias("src"), F.lit(dest).alias("dest"),
                                     F.col("start").alias("dest_start"), "length"), range_bytes)
    target = places.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("length")).select(F.lit(dest).alias("dest"), "length")
    _, finished = write_ranges(ranges, target, tasks)
    _raise_faults(finished)
    return places


def copy_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES, tasks: int | None = None,
                ignore_errors: bool = False) -> DataFrame:
    """Copies files ``(src_uri, dest, src_len)`` by ranges; returns
    ``(dest, length, ok, message)``, one row a file.  A failed file fails the
    call unless ``ignore_errors``; its destination is left as it was."""
    given = files.select(F.col("src_uri").alias("src"), "dest", F.lit(0).cast("long").alias("dest_start"),
                         F.col("src_len").cast("long").alias("length"))
    _, finished = write_ranges(in_ranges(given, range_bytes), given.select("dest", "length"), tasks)
    if not ignore_errors:
        _raise_faults(finished)
    return finished


def range_digests(ranges: DataFrame) -> DataFrame:
    """``(uri, start, length, sha256)`` of byte ranges of files, read in
    tasks piece by piece; a range beyond the end of its file fails the job."""
    schema = pa.schema([("uri", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("sha256", pa.string())])

    def digests(batches):
        def rows():
            for uri, start, length in _rows(batches):
                digest, left = hashlib.sha256(), length
                for chunk in _chunks(uri, start, length):
                    digest.update(chunk)
                    left -= len(chunk)
                if left:
                    raise ValueError(f"{uri}: {left} bytes missing of the {length} from {start}")
                yield uri, start, length, digest.hexdigest()
        return _emit(rows(), schema)

    n = default_parallelism(ranges.sparkSession)
    return ranges.select("uri", F.col("start").cast("long"), F.col("length").cast("long")).repartition(
        n, "uri", "start").mapInArrow(digests, "uri string, start long, length long, sha256 string")
