"""Operators over file manifests ``(uri, len, file_type, mtime)``.

``file_type`` is ``'file'`` or ``'dir'``.  A manifest is an ordinary
DataFrame - from ``sources.files.list_tree`` or any table of that schema -
so planning a copy, sizing folders or filtering names are joins and
aggregates, not loops over a listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.paths import (base_name, glob_to_regex, is_under, parent_chain,
                                     parent_path, rebase_path, strip_slash)

MANIFEST_SCHEMA = "uri string, len long, file_type string, mtime timestamp"


def rebase(manifest: DataFrame, source_root: str, dest_root: str) -> DataFrame:
    """Adds ``dest``: where each entry lands when ``source_root`` is copied
    into ``dest_root`` (the source folder's own name is kept)."""
    return manifest.withColumn("dest", rebase_path(F.col("uri"), source_root, dest_root))


def with_parent_chains(manifest: DataFrame, root: str) -> DataFrame:
    """Adds ``parents``: the folders above each entry up to ``root``, top first."""
    return manifest.withColumn("parents", parent_chain(F.col("uri"), root))


def with_parent_folders(manifest: DataFrame, root: str) -> DataFrame:
    """The entries plus every folder above them up to ``root``, each once.

    Folders taken from paths have ``len = 0`` and no ``mtime``; a folder
    that is also listed keeps its listed row.  The expansion is a per-row
    ``explode``; de-duplication is a keyed aggregate with map-side partial
    work, so a folder shared by a billion files is reduced in every map
    task before the shuffle.  The aggregate keeps only fixed-width buffers
    (a listed flag, length, a folder flag, time), so Spark runs it as a hash
    aggregate; a manifest lists each path once, so the maxima over listed
    rows are that row's values.
    """
    none = F.lit(None)
    own = F.struct("uri", F.lit(1).alias("listed"), F.col("len").cast("long").alias("len"),
                   (F.col("file_type") == "dir").cast("int").alias("is_dir"),
                   F.col("mtime").cast("timestamp").alias("mtime"))
    above = F.transform(parent_chain(F.col("uri"), root), lambda p: F.struct(
        p.alias("uri"), F.lit(0).alias("listed"), none.cast("long").alias("len"), F.lit(1).alias("is_dir"),
        none.cast("timestamp").alias("mtime")))
    # One scan: each entry becomes itself and the folders above it.
    rows = manifest.select(F.explode(F.concat(F.array(own), above)).alias("e")).select("e.*")
    is_listed = F.col("listed") == 1
    agg = rows.groupBy("uri").agg(
        F.max("listed").alias("listed"),
        F.max(F.when(is_listed, F.col("len"))).alias("len"),
        F.max(F.when(is_listed, F.col("is_dir"))).alias("listed_dir"),
        F.max(F.when(is_listed, F.col("mtime"))).alias("mtime"))
    return agg.select(
        "uri",
        F.when(F.col("listed") == 1, F.col("len")).otherwise(F.lit(0).cast("long")).alias("len"),
        F.when((F.col("listed") == 0) | (F.col("listed_dir") == 1), F.lit("dir"))
         .otherwise(F.lit("file")).alias("file_type"),
        "mtime")


def copy_plan(source: DataFrame, dest: DataFrame, source_root: str, dest_root: str,
              with_times: bool = False) -> DataFrame:
    """Full outer join of the rebased source manifest with the destination
    manifest on the destination path.

    Output ``(src_uri, dest, file_type, src_len, dest_len, action)``:
    ``create`` (nothing at the destination), ``replace`` (a file is there and
    is copied over), ``mkdir`` / ``exists`` for folders, ``keep`` for entries
    found only at the destination (they are left alone).  ``with_times`` adds
    ``src_mtime``, the source's time.
    """
    times = [F.col("mtime").alias("src_mtime")] if with_times else []
    s = rebase(source, source_root, dest_root).select(
        F.col("uri").alias("src_uri"), "dest", F.col("file_type").alias("src_type"),
        F.col("len").alias("src_len"), *times)
    d = dest.select(strip_slash(F.col("uri")).alias("dest"), F.col("file_type").alias("dest_type"),
                    F.col("len").alias("dest_len"))
    j = s.join(d, "dest", "full_outer")
    action = (F.when(F.col("src_uri").isNull(), F.lit("keep"))
               .when((F.col("src_type") == "dir") & F.col("dest_type").isNull(), F.lit("mkdir"))
               .when(F.col("src_type") == "dir", F.lit("exists"))
               .when(F.col("dest_type").isNull(), F.lit("create"))
               .otherwise(F.lit("replace")))
    return j.select("src_uri", "dest", F.coalesce("src_type", "dest_type").alias("file_type"),
                    "src_len", "dest_len", action.alias("action"), *(["src_mtime"] if with_times else []))


def copy_work(plan: DataFrame) -> DataFrame:
    """Plan entries that have a source side (everything but ``keep``)."""
    return plan.where(F.col("src_uri").isNotNull())


def with_parent(manifest: DataFrame) -> DataFrame:
    """Adds ``parent``: the folder holding each entry."""
    return manifest.withColumn("parent", parent_path(F.col("uri")))


def folder_sizes(manifest: DataFrame) -> DataFrame:
    """Per folder: bytes and number of the entries directly inside it
    (folders count with their own length, as a listing does)."""
    return (with_parent(manifest).where(F.col("parent").isNotNull())
            .groupBy("parent")
            .agg(F.sum("len").alias("bytes"), F.count(F.lit(1)).alias("entries")))


def listed_entries(manifest: DataFrame, paths: DataFrame, path_col: str = "folder",
                   folders_only: bool = False) -> DataFrame:
    """Manifest rows a listing of each path gives: the entries directly
    inside it, or the file itself for a file path; each entry once even when
    both it and its folder are listed.  The path list joins by semi/anti
    joins, broadcast when small.  ``folders_only`` - the caller knows every
    path is a folder - skips the second pass for file paths."""
    f = paths.select(strip_slash(F.col(path_col)).alias("p"))
    m = with_parent(manifest)
    within = m.join(f, m["parent"] == f["p"], "left_semi")
    if folders_only:
        return within.drop("parent")
    files = (m.where(F.col("file_type") == "file")
              .join(f, strip_slash(m["uri"]) == f["p"], "left_semi")
              .join(f, m["parent"] == f["p"], "left_anti"))
    return within.unionByName(files).drop("parent")


def _per_path(manifest: DataFrame, *totals) -> DataFrame:
    """Aggregates over the listing of every path: each entry counts for its
    folder, and a file for its own path.  Reduced before any join, so a folder
    with a third of all entries is one row a map task."""
    places = F.when(F.col("file_type") == "file", F.array(parent_path(F.col("uri")), strip_slash(F.col("uri")))) \
        .otherwise(F.array(parent_path(F.col("uri"))))
    listed = manifest.select("uri", "len", "mtime", F.explode(places).alias("path"))
    return listed.where(F.col("path").isNotNull()).groupBy("path").agg(*totals)


def path_sizes(manifest: DataFrame, paths: DataFrame, path_col: str = "folder") -> DataFrame:
    """``(path, bytes, entries)`` of one-level listings of the given paths:
    the lengths of the entries directly inside a folder, a file's own length
    for a file path, ``0`` for an empty folder or a missing path."""
    f = paths.select(strip_slash(F.col(path_col)).alias("path")).distinct()
    sized = _per_path(manifest, F.sum("len").alias("bytes"), F.count(F.lit(1)).alias("entries"))
    return (f.join(sized, "path", "left")
             .select("path", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"),
                     F.coalesce("entries", F.lit(0)).cast("long").alias("entries")))


def file_sizes(manifest: DataFrame, folders: DataFrame, folder_col: str = "folder",
               folders_only: bool = False) -> DataFrame:
    """``(uri, len)`` of what a listing of each path gives (``listed_entries``)."""
    return listed_entries(manifest, folders, folder_col, folders_only).select("uri", "len")


def name_contains(manifest: DataFrame, mark: str, negate: bool = False, whole_path: bool = False) -> DataFrame:
    """Entries whose last path part - or whole path - contains ``mark`` (``*``
    is dropped from the mark, so this is a plain substring test), or does not."""
    m = mark.replace("*", "")
    place = F.col("uri") if whole_path else base_name(F.col("uri"))
    cond = place.contains(m)
    return manifest.where(~cond if negate else cond)


def inside(manifest: DataFrame, folder: str) -> DataFrame:
    """Entries directly inside ``folder``."""
    return with_parent(manifest).where(F.col("parent") == strip_slash(F.lit(folder))).drop("parent")


def siblings(manifest: DataFrame, path: str) -> DataFrame:
    """Other entries of the folder holding ``path`` (the path itself is left out)."""
    p = strip_slash(F.lit(path))
    return (with_parent(manifest)
            .where((F.col("parent") == parent_path(F.lit(path))) & (strip_slash(F.col("uri")) != p))
            .drop("parent"))


def entry_times(manifest: DataFrame, folder: str | None = None) -> DataFrame:
    """``(uri, mtime)`` of every entry, or of the entries directly inside
    ``folder``."""
    return (manifest if folder is None else inside(manifest, folder)).select("uri", "mtime")


def path_first_times(manifest: DataFrame, paths: DataFrame, path_col: str = "folder") -> DataFrame:
    """``(path, first_time)``: modification time of the first entry (by
    name) a listing of each path gives - the file itself for a file path;
    NULL for an empty folder or a missing path."""
    f = paths.select(strip_slash(F.col(path_col)).alias("path")).distinct()
    return f.join(_per_path(manifest, F.min_by("mtime", "uri").alias("first_time")), "path", "left")


def first_entry_time(manifest: DataFrame, group_col: str = "parent", name_col: str = "uri",
                     time_col: str = "mtime") -> DataFrame:
    """Per group: time of the entry that sorts first by name."""
    return manifest.groupBy(group_col).agg(F.min_by(time_col, name_col).alias("first_time"))


def any_match(manifest: DataFrame, pattern: str, col: str = "uri") -> DataFrame:
    """One row ``found``: does any entry match the regular expression?

    Stops at the first match: each task keeps at most one row."""
    hit = manifest.where(F.col(col).rlike(pattern)).select(F.lit(1).alias("x")).limit(1)
    return hit.agg((F.count(F.lit(1)) > 0).alias("found"))


def name_lists(manifest: DataFrame, block_size: int = 1000, sep: str = ",") -> DataFrame:
    """Folder listings as text: ``(parent, block, names)`` with the entry
    names of each folder sorted and joined by ``sep``.

    A folder's listing is cut into blocks of ``block_size`` names by each
    name's exact position in the sorted listing (``ranking.group_positions``),
    so one text never grows with the folder; joining the blocks of a folder
    in block order gives the whole listing.
    """
    from tessera.operators.ranking import group_positions

    entries = with_parent(manifest).where(F.col("parent").isNotNull()).select(
        "parent", base_name(F.col("uri")).alias("name"))
    pos = group_positions(entries, "parent", "name")
    block = (F.col("pos") / F.lit(block_size)).cast("long").alias("block")
    return (pos.groupBy("parent", block)
            .agg(F.array_join(F.sort_array(F.collect_list("name")), sep).alias("names")))


def glob_entries(manifest: DataFrame, pattern: str, col: str = "uri") -> DataFrame:
    """Entries whose path matches a glob (``/data/2024-*/part-?.txt``,
    ``/logs/{a,b}/*``), as a file-system glob status would list them."""
    return manifest.where(F.col(col).rlike(glob_to_regex(pattern)))


def any_glob_match(manifest: DataFrame, pattern: str, col: str = "uri") -> DataFrame:
    """One row ``found``: does any entry match the glob?"""
    return any_match(manifest, glob_to_regex(pattern), col)


def below_root(manifest: DataFrame, root: str) -> DataFrame:
    """Entries at or below ``root``."""
    return manifest.where(is_under(strip_slash(F.col("uri")), root))
