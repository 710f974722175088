"""A stored cell table in hash buckets, where a put rewrites only what it touches.

Layout below the table's folder:

* ``data/<version>-<run>/bucket=<b>/part-*`` - cells of the buckets that a put wrote,
* ``manifest/<version>``                     - ``(bucket, folder)``: where each
  bucket's cells are now.  A version exists once Spark has committed its
  manifest, so a put that fails leaves the table as it was, and readers of an
  older version go on undisturbed.

A row key's bucket is its hash modulo the number of buckets.  A put finds the
buckets of its batch - at most as many as the table has -, reads those alone,
and joins them with the batch's newest row per cell.  A stored bucket holds a
cell once, so this takes no aggregate over the table; the batch is reduced
first.  Rows stay as ``cells.put_cells`` would leave them: the newest version
wins, on equal versions the batch, then the larger value.  New files are cut
by size (``rebalance``), so a row key with a third of all cells is written by
many tasks.  Folders of older versions stay until ``drop_old`` removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.functions.files import path_exists
from tessera.operators.cells import CELL_COLUMNS, CELL_KEY, CELL_SCHEMA, get_rows

BUCKETS = 64
MANIFEST = "bucket int, folder string, buckets int"


def bucket_of(row_key: Column, buckets: int | Column) -> Column:
    return F.pmod(F.xxhash64(row_key), F.lit(buckets) if isinstance(buckets, int) else buckets).cast("int")


def _newest(rows: DataFrame) -> DataFrame:
    m = F.max(F.struct("version", "value")).alias("m")
    return rows.groupBy(*CELL_KEY).agg(m).select(*CELL_KEY, "m.value", "m.version")


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit() and path_exists(spark, f"{path}/manifest/{n}/_SUCCESS"))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """``(bucket, folder, buckets)`` of a version, the newest unless given."""
    known = _versions(spark, path)
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"{path}: no table version {'' if version is None else version}")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest/{known[-1] if version is None else version:08d}")


def _write(cells: DataFrame, buckets: int, kept: DataFrame, path: str, version: int) -> int:
    """Writes a version: ``cells`` as new buckets, ``kept`` as they are."""
    spark = cells.sparkSession
    folder = f"{path}/data/{version:08d}-{uuid.uuid4().hex[:12]}"
    with_bucket = cells.select(*CELL_COLUMNS, bucket_of(F.col("row_key"), buckets).alias("bucket"))
    with_bucket.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(folder)
    written = spark.read.schema(f"{CELL_SCHEMA}, bucket int").parquet(folder).select("bucket").distinct()
    new = written.select("bucket", F.lit(folder).alias("folder"), F.lit(buckets).alias("buckets"))
    # A version of an empty table still tells its number of buckets.
    anchor = spark.createDataFrame([(None, folder, buckets)], MANIFEST)
    kept.where("bucket IS NOT NULL").unionByName(new).unionByName(anchor).coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/manifest/{version:08d}")
    return version


def create(cells: DataFrame, path: str, buckets: int = BUCKETS) -> int:
    """Stores ``cells`` - each cell's newest row - as version 0 of a new table."""
    spark = cells.sparkSession
    if path_exists(spark, path):
        raise FileExistsError(path)
    return _write(_newest(cells.select(*CELL_COLUMNS)), buckets, spark.createDataFrame([], MANIFEST), path, 0)


def read(spark: SparkSession, path: str, version: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """The table's cells; of the buckets in ``only`` (``bucket``) if given.
    Only the folders of these buckets are read: the manifest has at most a row
    a bucket, and goes through the driver as the list of paths."""
    entries = manifest(spark, path, version).where("bucket IS NOT NULL")
    if only is not None:
        entries = entries.join(only.select("bucket").distinct(), "bucket", "left_semi")
    paths = [f"{r['folder']}/bucket={r['bucket']}" for r in entries.collect()]
    if not paths:
        return spark.createDataFrame([], CELL_SCHEMA)
    return spark.read.schema(CELL_SCHEMA).parquet(*paths).select(*CELL_COLUMNS)


def put(batch: DataFrame, path: str) -> int:
    """Puts a batch of cells into the table; returns the new version."""
    spark = batch.sparkSession
    now = manifest(spark, path).checkpoint()
    buckets = now.first()["buckets"]
    latest = _newest(batch.select(*CELL_COLUMNS)).withColumn("bucket", bucket_of(F.col("row_key"), buckets)).checkpoint()
    touched = latest.select("bucket").distinct()
    old = read(spark, path, only=touched)
    b, t = latest.alias("b"), old.alias("t")
    same = None
    for c in CELL_KEY:
        eq = F.col(f"b.{c}").eqNullSafe(F.col(f"t.{c}"))
        same = eq if same is None else same & eq
    both = b.withColumn("in_batch", F.lit(True)).alias("b").join(t.withColumn("in_table", F.lit(True)).alias("t"),
                                                                 same, "full_outer")
    # A NULL version is older than any other.
    older = F.col("t.version").isNotNull() & (F.col("b.version").isNull() | (F.col("b.version") < F.col("t.version")))
    wins = F.col("b.in_batch").isNotNull() & (F.col("t.in_table").isNull() | ~older)
    merged = both.select(*[F.when(wins, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in CELL_COLUMNS])
    kept = now.join(touched, "bucket", "left_anti")
    return _write(merged, buckets, kept, path, _versions(spark, path)[-1] + 1)


def get(keys: DataFrame, path: str, key_col: str = "row_key") -> DataFrame:
    """``(row_key, family, qualifier, value)`` of the row keys, from their
    buckets alone."""
    spark = keys.sparkSession
    buckets = manifest(spark, path).first()["buckets"]
    only = keys.select(bucket_of(F.col(key_col), buckets).alias("bucket"))
    return get_rows(read(spark, path, only=only), keys, key_col)


def drop_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Removes all versions but the newest ``keep`` and the data folders that
    none of those uses; returns how many folders went."""
    known = _versions(spark, path)
    gone, left = known[:-keep], known[-keep:]
    used = {r["folder"].rsplit("/", 1)[-1] for v in left for r in manifest(spark, path, v).select(
        "folder").distinct().collect()}
    jpath, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    folders = [jpath(f"{path}/manifest/{v:08d}") for v in gone]
    data = jpath(f"{path}/data")
    fs = data.getFileSystem(conf)
    # Folders of a later number belong to a put that is under way.
    folders += [s.getPath() for s in fs.listStatus(data) if s.getPath().getName() not in used
                and int(s.getPath().getName().split("-")[0]) <= known[-1]]
    for f in folders:
        fs.delete(f, True)
    return len(folders)
