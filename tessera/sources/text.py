"""Text-based readers: delimited tables, text lines, whole files, headers.

All of them are Spark data sources underneath; globs in a path (``*``,
``?``, ``[ab]``, ``{a,b}``) are expanded by Spark's file index, and
``glob_filter`` maps to ``pathGlobFilter`` for a filter on file names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessera.operators.layout import default_parallelism


def _field(raw: F.Column, dtype: T.DataType, null_value: str) -> F.Column:
    """One text field as the declared type; unparsable text is NULL."""
    value = F.when(raw == F.lit(null_value), F.lit(None).cast("string")).otherwise(raw)
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # no blanks or decimals, as a Hive int column reads them
        return F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast(dtype))
    return value.try_cast(dtype)


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                   sep: str = "::", null_value: str = "\\N") -> DataFrame:
    """A delimited text table with a separator of one or more characters.

    Behaves like a Hive table over ``::``-separated text: fields are taken in
    order; text that does not parse as the declared type reads as NULL;
    missing trailing fields are NULL and extra ones are dropped; an empty
    field is ``''`` in a string column; ``\\N`` marks NULL.  There is no
    quoting.  Lines are read with Spark's splittable text source.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    parts = F.split(F.col("value"), re.escape(sep), -1)
    return spark.read.text(path).select(*[
        _field(F.get(parts, i), f.dataType, null_value).alias(f.name)
        for i, f in enumerate(schema.fields)])


def register_delimited(spark: SparkSession, name: str, path: str | Sequence[str],
                       schema: T.StructType | str, sep: str = "::") -> DataFrame:
    """Read a delimited folder (``read_delimited``) and register it as a
    temporary view, so SQL written for an external table runs unchanged."""
    df = read_delimited(spark, path, schema, sep)
    df.createOrReplaceTempView(name)
    return df


def read_lines(spark: SparkSession, path: str | Sequence[str], glob_filter: str | None = None,
               recursive: bool = False, with_path: bool = False) -> DataFrame:
    """Text lines of all files below ``path`` as ``value string``.

    Files are split into blocks and read in parallel, one line per row.
    ``with_path`` adds ``path`` from the file metadata.
    """
    reader = spark.read
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.text(path)
    if with_path:
        df = df.select(F.col("_metadata.file_path").alias("path"), "value")
    return df


def read_whole_files(spark: SparkSession, path: str | Sequence[str],
                     glob_filter: str | None = None, recursive: bool = False) -> DataFrame:
    """One row per file: ``path string, value string`` with the whole text
    (UTF-8).

    Built on Spark's ``binaryFile`` source; each file is one value, so this
    is meant for files that fit in an executor's memory (configs, small
    documents).  Spark's file sources skip zero-length files; to get ``''``
    for them, read a manifest's paths with ``read_file_texts``.
    """
    reader = spark.read.format("binaryFile")
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select("path", F.decode("content", "UTF-8").alias("value"))


_HEADER_SCHEMA = T.StructType([T.StructField("path", T.StringType()),
                               T.StructField("header", T.StringType())])


HEADER_BYTES = 16 << 20
TEXT_BYTES = 32 << 20  # texts sent on at once


def _first_line(fs, local_path: str, chunk: int = 1 << 16) -> str | None:
    """First line of one file, read in chunks until a line end; blank -> None.
    A first line beyond ``HEADER_BYTES`` raises."""
    buf = bytearray()
    seen = 0
    with fs.open_input_stream(local_path) as stream:
        while True:
            data = stream.read(chunk)
            if not data:
                break
            buf.extend(data)
            cut = min((i for i in (buf.find(b"\n", seen), buf.find(b"\r", seen)) if i >= 0), default=-1)
            if cut >= 0:
                del buf[cut:]
                break
            seen = len(buf)
            if seen > HEADER_BYTES:
                raise ValueError(f"{local_path}: no line end in the first {HEADER_BYTES} bytes")
    line = buf.decode("utf-8")
    return None if not line.strip() else line


_TEXT_SCHEMA = T.StructType([T.StructField("path", T.StringType()),
                             T.StructField("value", T.StringType())])


def read_file_texts(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Whole text (UTF-8) of each file named in ``paths``: ``path, value``;
    an empty file gives ``''``; a missing file and bytes that are not UTF-8
    fail the job."""
    from tessera.functions.files import filesystem_for

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out_paths, out_texts, size = [], [], 0
            for p in batch.column(0).to_pylist():
                fs, local = filesystem_for(p)
                with fs.open_input_stream(local) as stream:
                    raw = stream.read()
                out_texts.append(raw.decode("utf-8"))
                out_paths.append(p)
                size += len(raw)
                if size >= TEXT_BYTES:
                    yield _text_batch(out_paths, out_texts)
                    out_paths, out_texts, size = [], [], 0
            yield _text_batch(out_paths, out_texts)

    return _dealt(paths, path_col).mapInArrow(texts, _TEXT_SCHEMA)


def _text_batch(paths: list[str], texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(texts, pa.string())],
                                      names=["path", "value"])


def _dealt(paths: DataFrame, path_col: str) -> DataFrame:
    """The paths, dealt over the cluster: a short list is one partition."""
    n = default_parallelism(paths.sparkSession)
    return paths.select(F.col(path_col).alias("path")).repartition(n, "path")


def read_headers(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """First line of each file named in ``paths``: ``path, header``.

    Only the bytes up to the first line end are read, so a header of a huge
    file costs one small read.  A missing file raises; an empty or blank
    first line gives NULL; bytes that are not UTF-8 fail.  The paths are dealt
    over all tasks.
    """
    from tessera.functions.files import filesystem_for

    def headers(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            out_paths, out_heads = [], []
            for p in batch.column(0).to_pylist():
                fs, local = filesystem_for(p)
                out_paths.append(p)
                out_heads.append(_first_line(fs, local))
            yield pa.RecordBatch.from_arrays([pa.array(out_paths, pa.string()),
                                              pa.array(out_heads, pa.string())],
                                             names=["path", "header"])

    return _dealt(paths, path_col).mapInArrow(headers, _HEADER_SCHEMA)


def number_range(spark: SparkSession, n: int, prefix: str = "id-") -> DataFrame:
    """``range(n)`` with the computed columns of the number-range example:
    ``id bigint, name string`` (literal joined to the id) and
    ``id2 double`` (the id cast to double and multiplied by 1.0)."""
    return spark.range(n).select(
        "id",
        F.concat(F.lit(prefix), F.col("id")).alias("name"),
        (F.col("id").cast("double") * F.lit(1.0)).alias("id2"),
    )


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """An in-line collection of rows (small literals written in code)."""
    return spark.createDataFrame(list(rows), schema)
