"""File manifests: a recursive listing done by the executors.

``list_tree`` walks a tree in levels.  Each level is one Spark job: the
frontier folders are spread over tasks, every task walks below its folders
(depth first, one directory read per folder) until it has listed a budget
of entries, and the folders it did not reach become the next level.  The
driver only loops over levels - it never holds the listing - and each level
is checkpointed to the shared checkpoint folder so a lost executor re-reads
a level instead of re-listing the tree.

Rows: ``(uri, len, file_type, mtime)``, root included, symbolic links left
out, as in the copy tool this mirrors.  Listing errors fail the job.
"""

from __future__ import annotations

import datetime
import os
from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.files import filesystem_for, is_local, qualify
from tessera.functions.paths import parent_chain, parent_path, strip_slash_str
from tessera.session import checkpoint_dir

ENTRY_ARROW = pa.schema([("uri", pa.string()), ("len", pa.int64()), ("file_type", pa.string()),
                         ("mtime", pa.timestamp("us", tz="UTC"))])
ENTRY_SCHEMA = "uri string, len long, file_type string, mtime timestamp"
BATCH_ROWS = 10_000


def _join(folder: str, name: str) -> str:
    return folder + name if folder.endswith("/") else folder + "/" + name


def _entries_local(folder: str, local: str):
    with os.scandir(local) as it:
        for e in it:
            if e.is_symlink():
                continue
            st = e.stat(follow_symlinks=False)
            kind = "dir" if e.is_dir(follow_symlinks=False) else ("file" if e.is_file(follow_symlinks=False) else None)
            if kind is None:
                continue
            yield _join(folder, e.name), (0 if kind == "dir" else st.st_size), kind, st.st_mtime_ns // 1000


def _entries_remote(folder: str):
    fs, path = filesystem_for(folder)
    for info in fs.get_file_info(pafs.FileSelector(path, recursive=False)):
        if info.type == pafs.FileType.Directory:
            kind, size = "dir", 0
        elif info.type == pafs.FileType.File:
            kind, size = "file", info.size
        else:
            continue
        mtime = info.mtime_ns // 1000 if info.mtime_ns is not None else None
        yield _join(folder, info.base_name), size, kind, mtime


def _stat(uri: str):
    fs, path = filesystem_for(uri)
    if is_local(uri):
        st = os.stat(path, follow_symlinks=False)
        kind = "dir" if os.path.isdir(path) else "file"
        return uri, (0 if kind == "dir" else st.st_size), kind, st.st_mtime_ns // 1000
    info = fs.get_file_info(path)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    kind = "dir" if info.type == pafs.FileType.Directory else "file"
    return uri, (0 if kind == "dir" else info.size), kind, None if info.mtime_ns is None else info.mtime_ns // 1000


WALK_ARROW = pa.schema(list(ENTRY_ARROW) + [("frontier", pa.bool_())])
WALK_SCHEMA = ENTRY_SCHEMA + ", frontier boolean"
WALK_BUDGET = 10_000     # entries one task lists below its folders before handing on


def _to_batch(rows, schema=ENTRY_ARROW) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _entries(folder: str):
    return (_entries_local(folder, filesystem_for(folder)[1]) if is_local(folder)
            else _entries_remote(folder))


def _walk_fn(budget: int):
    """Entries below each input folder, depth first, until ``budget``
    entries were listed for that folder; sub-folders not reached are
    returned as frontier rows (``frontier = true``) for the next level.
    Each entry is returned once: by the listing of its own folder."""
    def walk(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for start in batch.column(0).to_pylist():
                stack, listed = [start], 0
                while stack and listed < budget:
                    folder = stack.pop()
                    for uri, size, kind, mtime in _entries(folder):
                        rows.append((uri, size, kind, mtime, False))
                        listed += 1
                        if kind == "dir":
                            stack.append(uri)
                        if len(rows) >= BATCH_ROWS:
                            yield _to_batch(rows, WALK_ARROW)
                            rows = []
                for folder in stack:
                    rows.append((folder, 0, "dir", None, True))
                    if len(rows) >= BATCH_ROWS:
                        yield _to_batch(rows, WALK_ARROW)
                        rows = []
        if rows:
            yield _to_batch(rows, WALK_ARROW)
    return walk


def list_tree(spark: SparkSession, root: str, tasks: int | None = None,
              budget: int = WALK_BUDGET) -> DataFrame:
    """Recursive manifest of ``root`` (a path or URI).

    Each level is one job: the frontier folders are spread over ``tasks``
    tasks, and each task walks below its folders until it has listed
    ``budget`` entries per folder; folders it did not reach form the next
    level.  A small tree is listed in one job, a big one level by level
    over all tasks, until no folder is left.  Each level is checkpointed.
    """
    if budget < 1:
        raise ValueError("budget must be at least 1 entry")
    checkpoint_dir(spark)
    tasks = tasks or spark.sparkContext.defaultParallelism
    root = strip_slash_str(qualify(root, spark))
    # The root is one file-system call: the driver makes it (a missing root
    # fails here, before any job).
    uri, size, kind, mtime = _stat(root)
    when = None if mtime is None else datetime.datetime.fromtimestamp(mtime / 1e6, tz=datetime.timezone.utc)
    top = spark.createDataFrame([(uri, size, kind, when)], ENTRY_SCHEMA)
    parts = [top]
    if kind != "dir":
        return top
    return reduce(DataFrame.unionByName, [top, *_walk(spark.createDataFrame([(root,)], "uri string"), tasks, budget)])


def _walk(frontier: DataFrame, tasks: int, budget: int) -> list[DataFrame]:
    """The entries below the folders ``frontier`` (``uri``), a level each."""
    parts = []
    while not frontier.isEmpty():
        level = (frontier.repartition(tasks, "uri")
                 .mapInArrow(_walk_fn(budget), WALK_SCHEMA).checkpoint())
        parts.append(level.where(~F.col("frontier")).drop("frontier"))
        frontier = level.where(F.col("frontier")).select("uri")
    return parts


# --- refresh of a stored listing ---------------------------------------------------

def _stat_fn(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """Each path as it is now; a path that is gone, or is now a symbolic link
    or another thing that listings leave out, has no type."""
    for batch in batches:
        rows = []
        for uri in batch.column(0).to_pylist():
            try:
                if is_local(uri) and os.path.islink(filesystem_for(uri)[1]):
                    raise FileNotFoundError(uri)
                rows.append(_stat(uri))
            except (FileNotFoundError, NotADirectoryError):
                rows.append((uri, None, None, None))
        yield _to_batch(rows)


def _list_fn(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """The entries directly inside each folder."""
    for batch in batches:
        rows = []
        for folder in batch.column(0).to_pylist():
            for entry in _entries(folder):
                rows.append(entry)
                if len(rows) >= BATCH_ROWS:
                    yield _to_batch(rows)
                    rows = []
        yield _to_batch(rows)


def refresh_tree(spark: SparkSession, root: str, stored: DataFrame, tasks: int | None = None,
                 budget: int = WALK_BUDGET, check_files: bool = False) -> DataFrame:
    """The manifest of ``root`` as it is now, from one stored earlier.

    A folder's time changes when an entry is added, removed or renamed in it.
    So only the stored folders are looked at, one call each; those of another
    time are listed again, and folders that were not stored are walked.  What
    a removal or a new kind of entry means for the entries below it is found by
    joins along the parents of the folders that went.  All else is taken from the
    stored rows.

    A file that is rewritten in place leaves its folder's time as it was; with
    ``check_files`` every file of an unchanged folder is looked at, too.
    Changes within the tick of the file system's clock in which a folder was
    listed can go unseen.  Listing errors fail the job."""
    checkpoint_dir(spark)
    tasks = tasks or spark.sparkContext.defaultParallelism
    root = strip_slash_str(qualify(root, spark))
    stored = stored.select("uri", "len", "file_type", "mtime")
    folders = stored.where(F.col("file_type") == "dir").select("uri", F.col("mtime").alias("was"))
    now = folders.select("uri").repartition(tasks, "uri").mapInArrow(_stat_fn, ENTRY_SCHEMA).checkpoint()
    gone = now.where(F.coalesce(F.col("file_type") != "dir", F.lit(True))).select(F.col("uri").alias("_gone"))
    below = F.explode(F.concat(parent_chain(F.col("uri"), root), F.array("uri")))
    dead = (now.select("uri", below.alias("_above")).join(gone, F.col("_above") == F.col("_gone"), "left_semi")
            .select("uri").distinct())
    alive = now.join(dead, "uri", "left_anti").join(folders, "uri").checkpoint()
    if alive.where(F.col("uri") == root).isEmpty():   # nothing stored, or another kind of root
        return list_tree(spark, root, tasks, budget)
    same = alive.where(F.col("mtime").eqNullSafe(F.col("was"))).select(F.col("uri").alias("_folder"))
    fresh = (alive.where(~F.col("mtime").eqNullSafe(F.col("was"))).select("uri").repartition(tasks, "uri")
             .mapInArrow(_list_fn, ENTRY_SCHEMA).checkpoint())
    unknown = fresh.where(F.col("file_type") == "dir").join(alive, "uri", "left_anti").select("uri").checkpoint()
    kept = stored.where(F.col("uri") != root).withColumn("_parent", parent_path(F.col("uri")))
    kept = kept.join(same, F.col("_parent") == F.col("_folder"), "left_semi").drop("_parent")
    files = kept.where(F.col("file_type") != "dir")
    if check_files:
        files = (files.select("uri").repartition(tasks, "uri").mapInArrow(_stat_fn, ENTRY_SCHEMA)
                 .where(F.col("file_type").isNotNull()))
    own = alive.drop("was")
    inside = own.join(kept.where(F.col("file_type") == "dir").select("uri"), "uri", "left_semi")
    parts = [own.where(F.col("uri") == root), files, inside, fresh, *_walk(unknown, tasks, budget)]
    return reduce(DataFrame.unionByName, [p.select("uri", "len", "file_type", "mtime") for p in parts])
