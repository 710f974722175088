"""Distributed copy of a planned tree, with one status row per entry.

Steps (``copy_tree``):

1. list source and destination trees on the executors (``list_tree``),
2. add the folders above every source entry, plan with a full outer join
   on the destination path (``manifest.copy_plan``),
3. folder step: every folder entry is created (or kept) - this step runs to
   its end before any file is written, so parents exist before children,
4. file step: each file is written to an attempt-specific temporary name
   in its destination folder, its length is checked against the source
   listing, and it is moved over the destination name in one rename.

A retried or speculative task writes its own temporary file (named with the
run id and the task attempt id), so it never breaks another attempt's
output.  The final rename replaces an existing file in one step on local file
systems; HDFS refuses to rename onto a file, so there the old one is deleted
just before; on other file systems an entry that would replace a file fails
with a message that says so.  When the file step is over, temporary files of this run that lost
attempts left behind are swept from the touched folders.  Work is spread over
``tasks`` tasks (the cluster's width unless given) by a hash of the path.
Status rows leave a task batch by batch.  Status rows: ``(uri, dest, action, ok, bytes, message)``.

With ``range_bytes`` a file larger than that is copied by many tasks, range by
range (``operators.ranges``).

With ``journal`` - a folder that outlives the run - every task notes the
entries it has finished, ``(dest, len, mtime)`` of the source as listed, in
small files of its own, each renamed into place when it is whole.  A later run
with the same journal leaves out what an earlier one finished, however that
one ended: an entry is left out if the journal has its destination with the
source's length and time, and the destination still has that length.  What a
lost task had not noted is copied again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.files import filesystem_for, path_exists, qualify
from tessera.functions.paths import parent_str, strip_slash_str
from tessera.operators.layout import default_parallelism
from tessera.operators.manifest import copy_plan, copy_work, with_parent_folders
from tessera.operators.placement import assign_slots, batch_index, place_by_slot, slot_count
from tessera.operators.ranking import exclusive_prefix_sum

STATUS_SCHEMA = "uri string, dest string, action string, ok boolean, bytes long, message string"
STATUS_ARROW = pa.schema([("uri", pa.string()), ("dest", pa.string()), ("action", pa.string()),
                          ("ok", pa.bool_()), ("bytes", pa.int64()), ("message", pa.string())])
BUFFER = 1 << 20
STATUS_ROWS = 1000


def _batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t.type) for c, t in zip(cols, STATUS_ARROW)], schema=STATUS_ARROW)


def _exists(fs, path) -> pafs.FileType:
    return fs.get_file_info(path).type


def _make_dirs_fn(dest_base: str):
    """Folder step; ``dest_base`` (the destination root's parent) must exist."""
    def make_dirs(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        base_fs, base_path = filesystem_for(dest_base)
        base_ok = None          # checked once per task, on first need
        for batch in batches:
            out = []
            d = batch.to_pydict()
            for src, dest, planned in zip(d["src_uri"], d["dest"], d["action"]):
                fs, path = filesystem_for(dest)
                kind = _exists(fs, path)
                if kind == pafs.FileType.Directory:
                    if planned == "mkdir":   # made by another task's recursive mkdir in this run
                        out.append((src, dest, "mkdir", True, 0, "created in this run"))
                    else:
                        out.append((src, dest, "exists", True, 0, "destination folder exists"))
                    continue
                if base_ok is None:
                    base_ok = _exists(base_fs, base_path) == pafs.FileType.Directory
                if not base_ok:
                    out.append((src, dest, "mkdir", False, 0, f"no folder {dest_base} to copy into"))
                    continue
                try:
                    fs.create_dir(path, recursive=True)
                    out.append((src, dest, "mkdir", True, 0, "created"))
                except OSError as e:
                    out.append((src, dest, "mkdir", False, 0, f"{type(e).__name__}: {e}"))
            yield _batch(out)
    return make_dirs


TEMP_PREFIX = ".tessera."


def move_over(fs, tmp: str, dest: str) -> None:
    """Renames a finished file to its name, over a file that is there."""
    if not isinstance(fs, pafs.LocalFileSystem) and _exists(fs, dest) != pafs.FileType.NotFound:
        if not isinstance(fs, pafs.HadoopFileSystem):
            raise OSError(f"replacing {dest} is not supported on this file system")
        fs.delete_file(dest)
    fs.move(tmp, dest)


def _copy_one(src: str, dest: str, src_len: int, attempt: str) -> tuple[bool, int, str]:
    sfs, spath = filesystem_for(src)
    dfs, dpath = filesystem_for(dest)
    folder = parent_str(dpath) or "/"
    if _exists(dfs, folder) != pafs.FileType.Directory:
        return False, 0, f"no folder {folder} at the destination"
    tmp = folder.rstrip("/") + f"/{TEMP_PREFIX}{attempt}.{os.path.basename(dpath)}"
    written = 0
    try:
        with sfs.open_input_stream(spath) as i, dfs.open_output_stream(tmp) as o:
            while True:
                chunk = i.read(BUFFER)
                if not chunk:
                    break
                o.write(chunk)
                written += len(chunk)
        size = dfs.get_file_info(tmp).size
        if src_len is not None and size != src_len:
            dfs.delete_file(tmp)
            return False, size, f"{size} bytes at the destination, {src_len} listed at the source"
        move_over(dfs, tmp, dpath)
        return True, written, "copied"
    except OSError as e:
        try:
            if _exists(dfs, tmp) == pafs.FileType.File:
                dfs.delete_file(tmp)
        except OSError:
            pass
        return False, written, f"{type(e).__name__}: {e}"


def _copy_files_fn(run_id: str, journal: str | None = None, journal_rows: int = STATUS_ROWS):
    """File step; temporary names carry the run id and the task attempt id."""
    def copy_files(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        ctx = TaskContext.get()
        attempt = f"{run_id}.{ctx.taskAttemptId() if ctx is not None else uuid.uuid4().hex}"
        if journal is None:
            yield from _copy_batches(batches, attempt)
            return
        notes = _Notes(journal, attempt, journal_rows)
        try:
            yield from _copy_batches(batches, attempt, notes)
        finally:      # a task that fails notes what it has finished
            notes.write()
    return copy_files


# --- journal of finished entries ------------------------------------------------

JOURNAL_SCHEMA = "dest string, len long, mtime long"


class _Notes:
    """Finished entries of one task attempt, written in files of ``rows``."""

    def __init__(self, journal: str, attempt: str, rows: int):
        self.journal, self.attempt, self.rows = journal, attempt, rows
        self.lines, self.files = [], 0

    def add(self, dest: str, length: int | None, mtime: int | None) -> None:
        self.lines.append(json.dumps({"dest": dest, "len": length, "mtime": mtime}))
        if len(self.lines) >= self.rows:
            self.write()

    def write(self) -> None:
        if not self.lines:
            return
        fs, folder = filesystem_for(self.journal)
        fs.create_dir(folder, recursive=True)
        name = f"{folder.rstrip('/')}/{self.attempt}.{self.files:06d}.json"
        with fs.open_output_stream(f"{name}.tmp") as out:
            out.write("".join(line + "\n" for line in self.lines).encode())
        move_over(fs, f"{name}.tmp", name)
        self.lines, self.files = [], self.files + 1


def read_journal(spark: SparkSession, journal: str) -> DataFrame:
    """``(dest, len, mtime)`` of the entries that runs with this journal have
    finished, ``mtime`` in microseconds; empty before the first."""
    if not path_exists(spark, journal):
        return spark.createDataFrame([], JOURNAL_SCHEMA)
    return spark.read.schema(JOURNAL_SCHEMA).option("pathGlobFilter", "*.json").json(journal).distinct()


def left_to_copy(files: DataFrame, journal: DataFrame) -> DataFrame:
    """File entries (``dest, src_len, dest_len, src_mtime``) without those the
    journal has, unless their destination has another length by now."""
    note = journal.select(F.col("dest").alias("_dest"), F.col("len").alias("_len"), F.col("mtime").alias("_mtime"))
    same = ((F.col("dest") == F.col("_dest")) & F.col("src_len").eqNullSafe(F.col("_len"))
            & F.unix_micros("src_mtime").eqNullSafe(F.col("_mtime")) & (F.col("dest_len") == F.col("src_len")))
    return files.join(note, same, "left_anti")


_SWEEP_SCHEMA = "folder string, removed long"


def _sweep_fn(run_id: str):
    """Remove temporary files this run's lost attempts left in a folder."""
    prefix = f"{TEMP_PREFIX}{run_id}."

    def sweep(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        folders, removed = [], []
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                fs, path = filesystem_for(folder)
                n = 0
                for info in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)):
                    if info.type == pafs.FileType.File and info.base_name.startswith(prefix):
                        fs.delete_file(info.path)
                        n += 1
                folders.append(folder)
                removed.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(folders, pa.string()), pa.array(removed, pa.int64())],
                                         names=["folder", "removed"])
    return sweep


def _copy_batches(batches: Iterable[pa.RecordBatch], attempt: str,
                  notes: _Notes | None = None) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        out = []
        d = batch.to_pydict()
        times = d.get("src_micros") or [None] * batch.num_rows
        for src, dest, n, action, mtime in zip(d["src_uri"], d["dest"], d["src_len"], d["action"], times):
            ok, written, msg = _copy_one(src, dest, n, attempt)
            if ok and notes:
                notes.add(dest, n, mtime)
            out.append((src, dest, action, ok, written, msg))
            if len(out) >= STATUS_ROWS:
                yield _batch(out)
                out = []
        yield _batch(out)


def balanced_file_tasks(files: DataFrame, task_bytes: int, groups: int) -> DataFrame:
    """Place file entries so each task copies about ``task_bytes``.

    Files are hashed into ``groups`` groups; inside a group, a running byte
    total in destination order cuts them into batches of ``task_bytes``
    (a bigger file is a batch of its own); batches get consecutive slots
    (``placement``) and each slot becomes one task.  Only the slot count
    reaches the driver.
    """
    keyed = files.withColumn("part_id", F.pmod(F.xxhash64("dest"), F.lit(groups)).cast("int"))
    before = exclusive_prefix_sum(keyed, "dest", F.coalesce(F.col("src_len"), F.lit(0)).cast("long"),
                                  "bytes_before", group_col="part_id")
    batched = before.withColumn("batch", (F.col("bytes_before") / F.lit(task_bytes)).cast("int"))
    index = batch_index(batched).checkpoint()
    n = slot_count(index).first().n_slots or 0
    slotted = assign_slots(batched, index).drop("part_id", "bytes_before", "batch")
    if n == 0:                      # no files to copy
        return slotted.drop("slot")
    return place_by_slot(slotted, n).drop("slot")


def run_copy(plan: DataFrame, dest_root: str, tasks: int | None = None, ignore_errors: bool = False,
             task_bytes: int | None = None, range_bytes: int | None = None, journal: str | None = None) -> DataFrame:
    """Carry out a copy plan; returns the (materialised) status table.

    Files are spread over ``tasks`` tasks (default: the cluster's width) by a hash of the destination path, or - with
    ``task_bytes`` - balanced so each task copies about that many bytes.
    With ``ignore_errors=False`` a failed entry fails the call after both
    steps ran, with the number of failures in the message.

    ``range_bytes`` has files above that size copied by many tasks.  With
    ``journal`` (the plan then needs ``src_mtime``, see
    ``copy_plan(with_times=True)``) finished entries are noted there, and
    those an earlier run noted are reported as ``skip`` and not copied.
    """
    spark = plan.sparkSession
    # The folder step and the file step both read the plan: materialise it
    # once instead of running its joins twice.
    tasks = tasks or default_parallelism(plan.sparkSession)
    journal = journal and qualify(journal, spark)
    times = ["dest_len", "src_mtime"] if journal else []
    work = copy_work(plan).select("src_uri", "dest", "file_type", "src_len", "action", *times).checkpoint()
    root = strip_slash_str(dest_root)
    base = parent_str(root) or root
    dirs = (work.where(F.col("file_type") == "dir").select("src_uri", "dest", "action")
            .repartition(tasks, "dest").mapInArrow(_make_dirs_fn(base), STATUS_SCHEMA).checkpoint())
    file_work = work.where(F.col("file_type") == "file").select("src_uri", "dest", "src_len", "action", *times)
    statuses = [dirs]
    if journal:
        left = left_to_copy(file_work, read_journal(spark, journal)).checkpoint()
        skipped = file_work.join(left.select("dest"), "dest", "left_anti").select(
            F.col("src_uri").alias("uri"), "dest", F.lit("skip").alias("action"), F.lit(True).alias("ok"),
            F.lit(0).cast("long").alias("bytes"), F.lit("copied by an earlier run").alias("message"))
        statuses.append(skipped.checkpoint())
        file_work = left.select("src_uri", "dest", "src_len", "action", F.unix_micros("src_mtime").alias("src_micros"))
    if range_bytes:
        large = file_work.where(F.col("src_len") > range_bytes)
        statuses.append(_copy_large(large, range_bytes, tasks, journal))
        file_work = file_work.where(F.coalesce(F.col("src_len") <= range_bytes, F.lit(True)))
    placed = (balanced_file_tasks(file_work, task_bytes, tasks) if task_bytes
              else file_work.repartition(tasks, "dest"))
    run_id = uuid.uuid4().hex[:12]
    files = placed.mapInArrow(_copy_files_fn(run_id, journal), STATUS_SCHEMA).checkpoint()
    statuses.append(files)
    # All attempts of the file step are over: temporary files of this run
    # still present belong to lost attempts.
    touched = files.select(F.regexp_replace("dest", "/[^/]*$", "").alias("folder")).distinct()
    touched.mapInArrow(_sweep_fn(run_id), _SWEEP_SCHEMA).write.format("noop").mode("overwrite").save()
    status = reduce(DataFrame.unionByName, statuses)
    if not ignore_errors:
        failed = status.where(~F.col("ok")).count()
        if failed:
            raise RuntimeError(f"{failed} copy entries failed; see the status table "
                               f"(run with ignore_errors=True to get it)")
    return status


def _copy_large(files: DataFrame, range_bytes: int, tasks: int, journal: str | None) -> DataFrame:
    """Status rows of files copied by ranges, noted in the journal when whole."""
    from tessera.operators.ranges import copy_ranges

    copied = copy_ranges(files, range_bytes, tasks, ignore_errors=True).select(
        F.col("dest").alias("_dest"), "ok", F.col("length").alias("bytes"), "message")
    done = files.join(copied, F.col("dest") == F.col("_dest")).checkpoint()
    if journal:
        finished = done.where("ok").select("dest", F.col("src_len").alias("len"), F.col("src_micros").alias("mtime"))
        finished.write.mode("append").json(journal)
    return done.select(F.col("src_uri").alias("uri"), "dest", "action", "ok",
                       F.when(F.col("ok"), F.col("bytes")).otherwise(F.lit(0)).alias("bytes"),
                       F.when(F.col("ok"), F.lit("copied")).otherwise(F.col("message")).alias("message"))


def copy_summary(status: DataFrame) -> DataFrame:
    """``(action, ok, entries, bytes)`` over a status table."""
    return status.groupBy("action", "ok").agg(F.count(F.lit(1)).alias("entries"),
                                             F.sum("bytes").alias("bytes"))


def copy_tree(spark: SparkSession, source_root: str, dest_root: str, tasks: int | None = None,
              ignore_errors: bool = False, task_bytes: int | None = None, range_bytes: int | None = None,
              journal: str | None = None) -> DataFrame:
    """Copy the tree at ``source_root`` into ``dest_root`` (the source folder's
    own name is kept below it); returns the status table.  The options are
    those of ``run_copy``."""
    from tessera.sources.files import ENTRY_SCHEMA, list_tree

    source_root, dest_root = (strip_slash_str(qualify(p, spark)) for p in (source_root, dest_root))
    src = with_parent_folders(list_tree(spark, source_root, tasks), strip_slash_str(source_root))
    dfs, dpath = filesystem_for(strip_slash_str(dest_root))
    if dfs.get_file_info(dpath).type == pafs.FileType.Directory:
        dst = list_tree(spark, dest_root, tasks)
    else:
        dst = spark.createDataFrame([], ENTRY_SCHEMA)
    plan = copy_plan(src, dst, source_root, dest_root, with_times=journal is not None)
    return run_copy(plan, dest_root, tasks, ignore_errors, task_bytes, range_bytes, journal)
