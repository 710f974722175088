"""Text sinks through Spark's file commit protocol (task output is
committed only once per task, so retried tasks leave no partial files)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F


def key_value_lines(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """``key TAB v1 v2 ...`` as a single ``value`` column.  A NULL is written
    as an empty field, so the fields after it keep their places."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    vals = F.concat_ws(" ", *[text(v) for v in values])
    return df.select(F.concat_ws("\t", text(key), vals).alias("value"), F.col(key).alias("_k"))


def write_key_values(df: DataFrame, path: str, key: str, values: Sequence[str],
                     num_files: int | None = None, mode: str = "errorifexists") -> None:
    """Write ``key TAB v1 v2 ...`` lines.

    With ``num_files`` the rows are hash-partitioned by key into that many
    files (the two-reducer layout of a classic job); without it the
    aggregate's own partitioning is kept, which scales with the data.  An
    output folder that is already there is refused unless ``mode`` says else.
    """
    lines = key_value_lines(df, key, values)
    if num_files:
        lines = lines.repartition(num_files, "_k")
    lines.select("value").write.mode(mode).text(path)


def compact_text(spark: SparkSession, source: str | Sequence[str], dest: str,
                 file_bytes: int = 256 << 20, num_files: int | None = None) -> bool:
    """Merge many text files (a glob or list) into files of about
    ``file_bytes`` (or ``num_files`` files) at ``dest``, replacing what was
    there.  Works on lines: a missing last
    newline no longer glues two files' lines together, and the order of
    lines across files is not kept (``operators.ranges.merge_in_order`` merges
    byte for byte, in order).  A target that holds some of the sources is
    refused: replacing it would delete what is still to be read.  When nothing
    matches ``source`` the target is left as it is and ``False`` is returned."""
    try:
        lines = spark.read.text(source)
        at = spark._jvm.org.apache.hadoop.fs.Path(dest)
        target = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toUri().getPath().rstrip("/")
        paths = spark.read.format("binaryFile").load(source).select(F.regexp_replace("path", "^[a-z0-9]+:(//[^/]*)?", ""))
        if not paths.toDF("path").where(F.col("path").startswith(target + "/") | (F.col("path") == target)).isEmpty():
            raise ValueError(f"{dest} holds files that are to be merged: choose another target")
        if not num_files:  # sizes only: the contents are not read
            size = spark.read.format("binaryFile").load(source).agg(F.sum("length")).first()[0] or 0
            num_files = max(1, -(-size // file_bytes))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return False
        raise
    lines.coalesce(num_files).write.mode("overwrite").text(dest)
    return True
