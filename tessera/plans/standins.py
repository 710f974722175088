"""Stand-in inputs built from the test tables.

Each function only reshapes a table into the schema an operator expects
(renames, casts, text formatting).  None of them does any of the
operator's own work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators.layout import scan_spread
from tessera.session import scratch_path
from tessera.sources.tables import table

# Fixed values of the stand-ins.
SOURCE_ROOT = "/web"
DEST_ROOT = "/backup"
CELL_FAMILY = "e"
CELL_BATCH_START = "2024-01-16 00:00:00"   # puts from here on form the second batch


def ratings(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """``(linkid, movieid, rate)`` and ``(linkid, userid)``: each order line is
    a rating of a part, rated with its quantity, by its order's customer."""
    l = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey")
    return (l.select(F.col("l_orderkey").alias("linkid"), F.col("l_partkey").alias("movieid"),
                     F.col("l_quantity").cast("int").alias("rate")),
            o.select(F.col("o_orderkey").alias("linkid"), F.col("o_custkey").alias("userid")))


def users(spark: SparkSession, d: str) -> DataFrame:
    """``(userid, sex, age)`` from customers: segment and nation key."""
    return table(spark, d, "customer", "c_custkey", "c_mktsegment", "c_nationkey").select(
        F.col("c_custkey").alias("userid"), F.col("c_mktsegment").alias("sex"),
        F.col("c_nationkey").alias("age"))


def movies(spark: SparkSession, d: str) -> DataFrame:
    """``(movieid, moviename)`` from parts."""
    return table(spark, d, "part", "p_partkey", "p_name").select(
        F.col("p_partkey").alias("movieid"), F.col("p_name").alias("moviename"))


def employees(spark: SparkSession, d: str) -> DataFrame:
    """``t(name, sal, job, deptno)`` from customers."""
    return table(spark, d, "customer", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("sal"),
        F.col("c_nationkey").alias("job"), F.col("c_mktsegment").alias("deptno"))


def jobs(spark: SparkSession, d: str) -> DataFrame:
    """``t1(sal, job)`` from suppliers."""
    return table(spark, d, "supplier", "s_acctbal", "s_nationkey").select(
        F.col("s_acctbal").alias("sal"), F.col("s_nationkey").alias("job"))


def traffic_lines(spark: SparkSession, d: str) -> DataFrame:
    """Tab-separated log lines (``value``), ten fields each: field 1 is the
    supplier, field 8 the quantity, field 9 the tax in hundredths; the other
    fields are filler taken from the same order line."""
    l = scan_spread(table(spark, d, "lineitem", "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber",
                          "l_returnflag", "l_linestatus", "l_quantity", "l_tax"), "l_orderkey", "l_linenumber")
    return l.select(F.concat_ws(
        "\t", "l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag",
        "l_linestatus", "l_orderkey", "l_partkey",
        F.col("l_quantity").cast("int"), F.round(F.col("l_tax") * 100).cast("int")).alias("value"))


def mixed_traffic_lines(spark: SparkSession, d: str) -> DataFrame:
    """Log lines as ``traffic_lines`` gives them for the first line of an
    order; second lines are blank, third ones short, fourth ones end in two
    empty fields, fifth ones have two more fields."""
    l = table(spark, d, "lineitem", "l_suppkey", "l_linenumber", "l_quantity")
    eight = F.concat_ws("\t", F.lit("a"), "l_suppkey", F.lit("c"), F.lit("d"), F.lit("e"), F.lit("f"), F.lit("g"),
                        F.lit("h"))
    q = F.col("l_quantity").cast("int").cast("string")
    full = F.concat_ws("\t", eight, q, F.lit("7"))
    n = F.col("l_linenumber")
    return l.select(F.when(n == 2, F.lit("  ")).when(n == 3, F.lit("a\tb\tc"))
                    .when(n == 4, F.concat(eight, F.lit("\t\t")))
                    .when(n == 5, F.concat(full, F.lit("\tx\ty"))).otherwise(full).alias("value"))


def _version(ts: F.Column) -> F.Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def cell_puts(spark: SparkSession, d: str) -> DataFrame:
    """Events as cell puts with their time ``ts``, which cuts the batches."""
    e = table(spark, d, "events", "user_id", "event_type", "props", "ts")
    return e.select(F.col("user_id").cast("string").alias("row_key"),
                    F.lit(CELL_FAMILY).alias("family"),
                    F.col("event_type").alias("qualifier"),
                    F.col("props").alias("value"),
                    _version(F.col("ts")).alias("version"),
                    F.col("ts"))


def first_batch(puts: DataFrame) -> DataFrame:
    return puts.where(F.col("ts") < F.lit(CELL_BATCH_START).cast("timestamp_ntz")).drop("ts")


def second_batch(puts: DataFrame) -> DataFrame:
    return puts.where(F.col("ts") >= F.lit(CELL_BATCH_START).cast("timestamp_ntz")).drop("ts")


def cell_keys(spark: SparkSession, d: str, segment: str) -> DataFrame:
    """A batch of row keys: the customers of one segment."""
    c = table(spark, d, "customer", "c_custkey", "c_mktsegment")
    return c.where(F.col("c_mktsegment") == segment).select(
        F.col("c_custkey").cast("string").alias("row_key"))


def page_files(spark: SparkSession, d: str) -> DataFrame:
    """A file manifest: each page is a file ``/web/<host>/<lang>/page-<id>.html``
    whose length is the byte length of its html."""
    p = table(spark, d, "pages", "page_id", "url", "html")
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    lang = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^/?#]*)", 1)
    return p.select(
        F.concat(F.lit(SOURCE_ROOT + "/"), host, F.lit("/"), lang, F.lit("/page-"),
                 F.col("page_id"), F.lit(".html")).alias("uri"),
        F.octet_length("html").cast("long").alias("len"),
        F.lit("file").alias("file_type"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60 % 86_399).alias("mtime"),
        "url")


def listed_paths(spark: SparkSession, d: str) -> DataFrame:
    """Paths to list (``folder``): the folder of each page whose url has a
    fragment, the file of each https page, and one that is not there."""
    pages = page_files(spark, d)
    folders = pages.where(F.col("url").contains("#")).select(F.regexp_replace("uri", "/[^/]*$", "").alias("folder"))
    files = pages.where(F.col("url").startswith("https:")).select(F.col("uri").alias("folder"))
    gone = pages.select(F.concat("uri", F.lit(".gone")).alias("folder"))
    return folders.unionByName(files).unionByName(gone).distinct()


def text_id_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents under text ids (``source/number``)."""
    t = scan_spread(table(spark, d, "documents", "doc_id", "source", "text"), "doc_id")
    return t.select(F.concat_ws("/", "source", "doc_id").alias("doc_id"), "text")


def source_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents under the number of their source: ids repeat over rows."""
    t = scan_spread(table(spark, d, "documents", "doc_id", "source", "text"), "doc_id")
    return t.select(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("long").alias("doc_id"), "text")


def backup_files(spark: SparkSession, d: str) -> DataFrame:
    """Destination manifest: an earlier copy holding the https pages, plus an
    empty stale ``.old`` file next to each page whose url has a fragment."""
    pages = page_files(spark, d)
    copied = pages.where(F.col("url").startswith("https:")).select(
        F.concat(F.lit(DEST_ROOT), F.col("uri")).alias("uri"), "len", "file_type", "mtime")
    stale = pages.where(F.col("url").contains("#")).select(
        F.concat(F.lit(DEST_ROOT), F.col("uri"), F.lit(".old")).alias("uri"),
        F.lit(0).cast("long").alias("len"), "file_type", "mtime")
    return copied.unionByName(stale)


def event_entries(spark: SparkSession, d: str) -> DataFrame:
    """Events as entries of one folder per event type: ``(parent, uri, mtime)``."""
    e = table(spark, d, "events", "event_id", "event_type", "ts")
    return e.select(F.col("event_type").alias("parent"), F.col("event_id").alias("uri"),
                    F.col("ts").alias("mtime"))


def document_files(spark: SparkSession, d: str) -> str:
    """The folder of a new tree of text files: 50 documents a file, a text
    and a line end each, by id; the path order of the files is that of the ids."""
    t = table(spark, d, "documents", "doc_id", "text")
    path = scratch_path(spark, "document-files")
    bucket = F.lpad(F.floor(F.col("doc_id") / 50).cast("string"), 8, "0")
    (t.select(bucket.alias("bucket"), "doc_id", "text").repartition("bucket").sortWithinPartitions("bucket", "doc_id")
      .select("bucket", "text").write.partitionBy("bucket").text(path))
    return path
