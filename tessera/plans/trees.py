"""Queries that write a test table as files, work on the files and read them
back: sources, sinks, merges, copies and listings.

Each query writes below a new folder of the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.functions.parse import utf8_bytes, utf8_text
from tessera.operators import patterns as patterns_op, placement, ranges, traffic
from tessera.operators.copy import copy_summary as copy_summary_op, copy_tree
from tessera.plans import standins as si
from tessera.session import scratch_path
from tessera.sinks.files import remove_files, write_files
from tessera.sinks.text import compact_text, write_key_values
from tessera.sources.files import list_tree, refresh_tree
from tessera.sources.lines import numbered_lines
from tessera.sources.tables import table
from tessera.sources.text import read_delimited, read_file_texts, read_headers, read_lines, read_whole_files

SLOTS = 16
LINE_SPLIT = 10_000        # bytes of a split in the line query
RANGE = 100_000            # bytes of a range in the copy and merge queries
Query = Callable[[SparkSession, str], DataFrame]


def _part_files(spark: SparkSession, folder: str) -> DataFrame:
    """The data files of a folder that Spark wrote."""
    return list_tree(spark, folder).where((F.col("file_type") == "file") & F.col("uri").rlike("/part-[^/]*$"))


def _bucket(uri: str = "uri") -> F.Column:
    return F.regexp_extract(uri, "bucket=([0-9]+)/", 1)


def merge_in_order(spark: SparkSession, d: str) -> DataFrame:
    """All documents written as files of 50, merged into one file in path
    order: place and checksum of each file's bytes in it."""
    files = _part_files(spark, si.document_files(spark, d))
    dest = scratch_path(spark, "merged")
    places = ranges.merge_in_order(files, dest, RANGE)
    found = ranges.range_digests(places.select(F.lit(dest).alias("uri"), "start", "length"))
    return (places.select(_bucket().alias("bucket"), "start").join(found, "start")
            .select("bucket", "start", F.col("length").alias("bytes"), "sha256"))


def copy_ranges(spark: SparkSession, d: str) -> DataFrame:
    """All documents as one file, copied by ranges: each range's checksum at
    the destination."""
    source, dest = scratch_path(spark, "merged"), scratch_path(spark, "copied")
    ranges.merge_in_order(_part_files(spark, si.document_files(spark, d)), source, 1 << 20)
    entry = list_tree(spark, source).select(F.col("uri").alias("src_uri"), F.lit(dest).alias("dest"),
                                            F.col("len").alias("src_len"))
    copied = ranges.copy_ranges(entry, RANGE).select(F.lit("").alias("src"), "dest", F.lit(0).cast("long")
                                                     .alias("dest_start"), "length")
    cut = ranges.in_ranges(copied, RANGE)
    return ranges.range_digests(cut.select(F.col("dest").alias("uri"), F.col("dest_start").alias("start"), "length")) \
        .select("start", F.col("length").alias("bytes"), "sha256")


def _page_rows(spark: SparkSession, d: str) -> DataFrame:
    """``page_files`` with the page's number, host and html."""
    contents = table(spark, d, "pages", "page_id", "html")
    return (si.page_files(spark, d).withColumn("page_id", F.regexp_extract("uri", "page-([0-9-]+)", 1).cast("long"))
            .withColumn("host", F.regexp_extract("uri", "^/web/([^/]+)", 1)).join(contents, "page_id"))


def _write_pages(rows: DataFrame, folder: str) -> None:
    write_files(rows.select(F.concat(F.lit(folder), "uri").alias("path"), F.col("html").alias("content")))


def copy_resume(spark: SparkSession, d: str) -> DataFrame:
    """All pages as files, copied in two runs with one journal.  In the first
    a file stands where the folder of one host - that of the first page -
    should be, so that host's pages fail; the second copies those alone.
    Status of every file in both runs."""
    source, dest = scratch_path(spark, "web"), scratch_path(spark, "backup")
    pages = _page_rows(spark, d)
    _write_pages(pages, source)
    block = pages.agg(F.concat(F.lit(f"{dest}/web/"), F.min_by("host", "page_id")).alias("path")).checkpoint()
    write_files(block.withColumn("content", F.lit("in the way")))
    journal, runs = scratch_path(spark, "journal"), []
    for run in (1, 2):
        status = copy_tree(spark, f"{source}/web", dest, ignore_errors=True, journal=journal)
        runs.append(status.where(F.col("uri").endswith(".html")).select(
            F.regexp_extract("uri", "/page-([0-9-]+)[.]html$", 1).cast("long").alias("page_id"),
            F.lit(run).alias("run"), "action", "ok", "bytes"))
        if run == 1:
            remove_files(block)
    return runs[0].unionByName(runs[1])


def manifest_refresh(spark: SparkSession, d: str) -> DataFrame:
    """All pages as files, listed and stored; then the folder of the first
    page's host goes, and of the others' files each fifth goes, each next one
    is replaced by its url, and each next one gets a companion two folders down.
    The stored listing brought up to date."""
    top, pages = scratch_path(spark, "web"), _page_rows(spark, d)
    _write_pages(pages, top)
    stored = scratch_path(spark, "manifest")
    list_tree(spark, f"{top}/web").write.parquet(stored)
    gone = pages.agg(F.min_by("host", "page_id").alias("gone"))
    remove_files(gone.select(F.concat(F.lit(f"{top}/web/"), "gone").alias("path")))
    rest = pages.join(F.broadcast(gone), F.col("host") != F.col("gone"))
    kind, path = F.pmod("page_id", F.lit(5)), F.concat(F.lit(top), "uri")
    remove_files(rest.where(kind == 0).select(path.alias("path")))
    write_files(rest.where(kind == 1).select(path.alias("path"), F.col("url").alias("content")))
    companion = F.regexp_replace(path, "/([^/]*)[.]html$", "/new/deep/$1.txt")
    write_files(rest.where(kind == 2).select(companion.alias("path"), F.col("url").alias("content")))
    now = refresh_tree(spark, f"{top}/web", spark.read.parquet(stored))
    return now.select(F.regexp_extract("uri", "(/web(/.*)?)$", 1).alias("uri"), "len", "file_type")


def match_patterns(spark: SparkSession, d: str) -> DataFrame:
    """All page files that each of many globs matches: per host its one-digit
    pages and its English and French pages, and the folder of each page that
    has a fragment."""
    pages = si.page_files(spark, d)
    host = F.regexp_extract("uri", "^/web/([^/]+)", 1)
    globs = F.array(F.concat(F.lit("/web/"), host, F.lit("/*/page-?.html")),
                    F.concat(F.lit("/web/"), host, F.lit("/{en,fr}/*.html")),
                    F.when(F.col("url").contains("#"), F.regexp_replace("uri", "/[^/]*$", "/*")))
    patterns = pages.select(F.explode(globs).alias("pattern")).where("pattern IS NOT NULL").distinct()
    return patterns_op.match_patterns(pages.select("uri"), patterns)


def slots_by_size(spark: SparkSession, d: str) -> DataFrame:
    """Page files dealt to 16 slots by size and placed: files and bytes of each
    slot, and whether one task holds it."""
    dealt = placement.slots_by_size(si.page_files(spark, d).select("uri", "len"), "len", "uri", SLOTS)
    placed = placement.place_by_slot(dealt, SLOTS).withColumn("task", F.spark_partition_id())
    return placed.groupBy("slot").agg(F.count("*").alias("files"), F.sum("len").alias("bytes"),
                                      (F.countDistinct("task") == 1).alias("one_task"))


def line_offsets(spark: SparkSession, d: str) -> DataFrame:
    """Number, byte offset and checksum of every line of the documents written
    as files of 50, read in splits of 10,000 bytes."""
    files = _part_files(spark, si.document_files(spark, d))
    lines = numbered_lines(files, split_bytes=LINE_SPLIT)
    return lines.select(_bucket("path").alias("bucket"), "line_no", "start", F.octet_length("value").cast("long")
                        .alias("bytes"), F.md5("value").alias("md5"))


def delimited_rows(spark: SparkSession, d: str) -> DataFrame:
    """All order lines as ``::``-separated text, read again by a schema: some
    lines have an empty flag, a NULL mark, a quantity that is no number, a field
    too many or too few."""
    l, n = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_returnflag"), F.col("l_linenumber")
    quantity = F.when(n == 5, F.lit("1x")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    flag = F.when(n == 3, F.lit("")).when(n == 4, F.lit("\\N")).otherwise(F.col("l_returnflag"))
    line = F.concat_ws("::", "l_orderkey", "l_linenumber", "l_partkey", quantity, F.col("l_extendedprice"))
    full = F.concat(line, F.lit("::"), flag)
    path = scratch_path(spark, "delimited")
    l.select(F.when(n == 6, line).when(n == 7, F.concat(full, F.lit("::more"))).otherwise(full)).write.text(path)
    return read_delimited(spark, path, "orderkey long, line int, partkey long, quantity int, price double, flag string")


def text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of all documents written as files of 50, how often each occurs in
    its file."""
    lines = read_lines(spark, f"{si.document_files(spark, d)}/*", glob_filter="part-*", with_path=True)
    return lines.groupBy(_bucket("path").alias("bucket"), "value").agg(F.count("*").alias("n"))


def compacted_lines(spark: SparkSession, d: str) -> DataFrame:
    """All documents written as files of 50, compacted to larger files: how
    often each line occurs."""
    dest = scratch_path(spark, "compact")
    compact_text(spark, f"{si.document_files(spark, d)}/*/part-*", dest)
    return read_lines(spark, dest).groupBy("value").agg(F.count("*").alias("n"))


def first_lines(spark: SparkSession, d: str) -> DataFrame:
    """First line of each file of 50 documents."""
    files = _part_files(spark, si.document_files(spark, d))
    return read_headers(files, "uri").select(_bucket("path").alias("bucket"), "header")


def _page_tree(spark: SparkSession, d: str) -> str:
    top = scratch_path(spark, "web")
    _write_pages(_page_rows(spark, d), top)
    return top


def tree_listing(spark: SparkSession, d: str) -> DataFrame:
    """All pages written as files, listed."""
    listed = list_tree(spark, f"{_page_tree(spark, d)}/web")
    return listed.select(F.regexp_extract("uri", "(/web(/.*)?)$", 1).alias("uri"), "len", "file_type")


def whole_files(spark: SparkSession, d: str) -> DataFrame:
    """All pages written as files, each read as one text: checksum and length."""
    texts = read_whole_files(spark, f"{_page_tree(spark, d)}/web", recursive=True)
    return _page_sums(texts)


def whole_files_of_paths(spark: SparkSession, d: str) -> DataFrame:
    """The same, by the paths of a listing."""
    files = list_tree(spark, f"{_page_tree(spark, d)}/web").where("file_type = 'file'")
    return _page_sums(read_file_texts(files, "uri"))


def glob_files(spark: SparkSession, d: str) -> DataFrame:
    """Page files that a glob names - the English and French ones of hosts that
    start with ``m.`` or ``www.`` - each read as one text."""
    return _page_sums(read_whole_files(spark, f"{_page_tree(spark, d)}/web/{{m,www}}.*/[ef][nr]", "page-*.html"))


def _page_sums(texts: DataFrame) -> DataFrame:
    return texts.select(F.regexp_extract("path", "/page-([0-9-]+)[.]html$", 1).cast("long").alias("page_id"),
                        F.md5("value").alias("md5"), F.length("value").cast("long").alias("chars"))


def key_value_lines(spark: SparkSession, d: str) -> DataFrame:
    """Traffic totals written as key, tab and values to two files, read again."""
    path = scratch_path(spark, "totals")
    totals = traffic.traffic_totals(si.traffic_lines(spark, d))
    write_key_values(totals, path, "key", ["up", "down", "total"], num_files=2)
    return read_lines(spark, path, glob_filter="part-*")


def copy_summary(spark: SparkSession, d: str) -> DataFrame:
    """All pages written as files and copied: entries and bytes by action."""
    status = copy_tree(spark, f"{_page_tree(spark, d)}/web", scratch_path(spark, "backup"), task_bytes=1 << 20)
    return copy_summary_op(status)


def spread_work(spark: SparkSession, d: str) -> DataFrame:
    """Page files spread over 8 tasks: how many files and bytes in all, and
    whether each task has its share."""
    files = si.page_files(spark, d).select("uri", "len")
    per_task = placement.spread(files, 8).groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.sum("len").alias("bytes"))
    sources = files.select(F.spark_partition_id()).distinct().count()
    return per_task.agg(F.count("*").alias("tasks"), F.sum("n").alias("files"), F.sum("bytes").alias("bytes"),
                        (F.max("n") - F.min("n") <= sources).alias("even"))


def placed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Order lines placed by the slot of their batch: rows of each slot, and the
    task that holds them."""
    l = table(spark, d, "lineitem", "l_linenumber", "l_quantity")
    keys = l.select(F.col("l_linenumber").alias("part_id"), F.col("l_quantity").cast("int").alias("batch"))
    index = placement.batch_index(keys).checkpoint()
    slotted = placement.assign_slots(keys, index)
    placed = placement.place_by_slot(slotted, placement.slot_count(index).first()["n_slots"])
    return placed.groupBy("slot", F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"))


def utf8_cells(spark: SparkSession, d: str) -> DataFrame:
    """Texts of all documents stored as bytes and turned into text again."""
    path = scratch_path(spark, "bytes")
    table(spark, d, "documents", "doc_id", "text").select(
        "doc_id", utf8_bytes(F.col("text")).alias("raw")).write.parquet(path)
    return spark.read.parquet(path).select("doc_id", F.octet_length("raw").cast("long").alias("bytes"),
                                           utf8_text(F.col("raw")).alias("text"))


QUERIES: dict[str, Query] = {
    "delimited_rows": delimited_rows,
    "text_lines": text_lines,
    "compacted_lines": compacted_lines,
    "first_lines": first_lines,
    "tree_listing": tree_listing,
    "whole_files": whole_files,
    "whole_files_of_paths": whole_files_of_paths,
    "glob_files": glob_files,
    "key_value_lines": key_value_lines,
    "copy_summary": copy_summary,
    "spread_work": spread_work,
    "placed_batches": placed_batches,
    "utf8_cells": utf8_cells,
    "copy_resume": copy_resume,
    "manifest_refresh": manifest_refresh,
    "match_patterns": match_patterns,
    "slots_by_size": slots_by_size,
    "line_offsets": line_offsets,
    "merge_in_order": merge_in_order,
    "copy_ranges": copy_ranges,
}

_BODIES = """t AS (SELECT lpad(CAST(doc_id // 50 AS VARCHAR), 8, '0') AS bucket, doc_id,
                       coalesce(text, '') || chr(10) AS line FROM documents),
     f AS (SELECT bucket, string_agg(line, '' ORDER BY doc_id) AS body FROM t GROUP BY bucket)"""

_HOSTS = """p AS (SELECT *, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host,
                          regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]*)', 1) AS lang FROM pages),
     m AS (SELECT *, '/web/' || host || '/' || lang AS folder, CAST(strlen(html) AS BIGINT) AS len,
                  '/web/' || host || '/' || lang || '/page-' || page_id || '.html' AS uri FROM p)"""

_LINES = f"""{_BODIES},
     l AS (SELECT bucket, regexp_replace(x, '(\\r\\n|\\r|\\n)$', '') AS value
           FROM (SELECT bucket, unnest(regexp_extract_all(body, '[^\\r\\n]*(\\r\\n|\\r|\\n)')) AS x FROM f))"""

_SLOTS = """k AS (SELECT l_linenumber AS part_id, CAST(l_quantity AS INTEGER) AS batch FROM lineitem),
     m AS (SELECT part_id, max(batch) AS max_batch FROM k GROUP BY part_id),
     i AS (SELECT part_id, max_batch, CAST(COALESCE(sum(max_batch + 1) OVER (ORDER BY part_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS slot_offset FROM m)"""

ORACLE: dict[str, str] = {
    "delimited_rows": r"""
        SELECT l_orderkey AS orderkey, CAST(l_linenumber AS INTEGER) AS line, l_partkey AS partkey,
               CASE WHEN l_linenumber <> 5 THEN CAST(l_quantity AS INTEGER) END AS quantity,
               CAST(l_extendedprice AS DOUBLE) AS price,
               CASE l_linenumber WHEN 3 THEN '' WHEN 4 THEN NULL WHEN 6 THEN NULL ELSE l_returnflag END AS flag
        FROM lineitem""",
    "text_lines": f"""
        WITH {_LINES}
        SELECT bucket, value, count(*) AS n FROM l GROUP BY bucket, value""",
    "compacted_lines": f"""
        WITH {_LINES}
        SELECT value, count(*) AS n FROM l GROUP BY value""",
    "first_lines": f"""
        WITH {_BODIES}, h AS (SELECT bucket, regexp_extract(body, '^[^\\r\\n]*') AS header FROM f)
        SELECT bucket, CASE WHEN trim(header) <> '' THEN header END AS header FROM h""",
    "tree_listing": f"""
        WITH {_HOSTS}
        SELECT uri, len, 'file' AS file_type FROM m
        UNION ALL
        SELECT uri, CAST(0 AS BIGINT), 'dir'
        FROM (SELECT '/web' AS uri UNION SELECT '/web/' || host FROM m UNION SELECT folder FROM m)""",
    "whole_files": "SELECT page_id, md5(html) AS md5, CAST(length(html) AS BIGINT) AS chars FROM pages",
    "whole_files_of_paths": "SELECT page_id, md5(html) AS md5, CAST(length(html) AS BIGINT) AS chars FROM pages",
    "glob_files": f"""
        WITH {_HOSTS}
        SELECT page_id, md5(html) AS md5, CAST(length(html) AS BIGINT) AS chars
        FROM m WHERE regexp_matches(host, '^(m|www)[.]') AND lang IN ('en', 'er', 'fn', 'fr')""",
    "key_value_lines": """
        SELECT l_suppkey || chr(9) || CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) || ' '
               || CAST(sum(CAST(round(l_tax * 100) AS INTEGER)) AS BIGINT) || ' '
               || CAST(sum(CAST(l_quantity AS INTEGER) + CAST(round(l_tax * 100) AS INTEGER)) AS BIGINT) AS value
        FROM lineitem GROUP BY l_suppkey""",
    "copy_summary": f"""
        WITH {_HOSTS},
             e AS (SELECT 'create' AS action, len FROM m
                   UNION ALL
                   SELECT 'mkdir', 0 FROM (SELECT '/web' AS uri UNION SELECT '/web/' || host FROM m
                                           UNION SELECT folder FROM m))
        SELECT action, true AS ok, count(*) AS entries, CAST(sum(len) AS BIGINT) AS bytes FROM e GROUP BY action""",
    "spread_work": f"""
        WITH {_HOSTS}
        SELECT CAST(least(8, count(*)) AS BIGINT) AS tasks, CAST(count(*) AS BIGINT) AS files,
               CAST(sum(len) AS BIGINT) AS bytes, true AS even FROM m""",
    "placed_batches": f"""
        WITH {_SLOTS}
        SELECT slot, slot AS task, count(*) AS n
        FROM (SELECT slot_offset + batch % (max_batch + 1) AS slot FROM k JOIN i USING (part_id)) GROUP BY slot""",
    "utf8_cells": "SELECT doc_id, strlen(text) AS bytes, text FROM documents",
    "manifest_refresh": f"""
        WITH {_HOSTS},
             k AS (SELECT *, ((page_id % 5) + 5) % 5 AS kind FROM m
                   WHERE host <> (SELECT arg_min(host, page_id) FROM m)),
             f AS (SELECT uri, CASE WHEN kind = 1 THEN CAST(strlen(url) AS BIGINT) ELSE len END AS len
                   FROM k WHERE kind <> 0
                   UNION ALL
                   SELECT folder || '/new/deep/page-' || page_id || '.txt', CAST(strlen(url) AS BIGINT)
                   FROM k WHERE kind = 2),
             dirs AS (SELECT '/web' AS uri UNION SELECT '/web/' || host FROM k UNION SELECT folder FROM k
                      UNION SELECT folder || '/new' FROM k WHERE kind = 2
                      UNION SELECT folder || '/new/deep' FROM k WHERE kind = 2)
        SELECT uri, len, 'file' AS file_type FROM f
        UNION ALL SELECT uri, CAST(0 AS BIGINT), 'dir' FROM dirs""",
    "match_patterns": f"""
        WITH {_HOSTS},
             g AS (SELECT '/web/' || host || '/*/page-?.html' AS pattern,
                          '/web/' || replace(host, '.', '[.]') || '/[^/]*/page-[^/][.]html' AS r FROM m
                   UNION SELECT '/web/' || host || '/{{en,fr}}/*.html',
                          '/web/' || replace(host, '.', '[.]') || '/(en|fr)/[^/]*[.]html' FROM m
                   UNION SELECT folder || '/*', replace(folder, '.', '[.]') || '/[^/]*' FROM m WHERE contains(url, '#'))
        SELECT m.uri, g.pattern FROM m JOIN g ON regexp_full_match(m.uri, g.r)""",
    "slots_by_size": f"""
        WITH {_HOSTS},
             r AS (SELECT len, CAST((row_number() OVER (ORDER BY len DESC, uri) - 1) % {SLOTS} AS INTEGER) AS slot FROM m)
        SELECT slot, count(*) AS files, CAST(sum(len) AS BIGINT) AS bytes, true AS one_task FROM r GROUP BY slot""",
    "line_offsets": f"""
        WITH {_BODIES},
             l AS (SELECT bucket, unnest(regexp_extract_all(body, '[^\\r\\n]*(\\r\\n|\\r|\\n)')) AS line,
                          unnest(range(0, len(regexp_extract_all(body, '[^\\r\\n]*(\\r\\n|\\r|\\n)')))) AS line_no FROM f)
        SELECT bucket, line_no, CAST(coalesce(sum(strlen(line)) OVER (PARTITION BY bucket ORDER BY line_no
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
               strlen(rtrim(line, chr(13) || chr(10))) AS bytes, md5(rtrim(line, chr(13) || chr(10))) AS md5
        FROM l""",
    "copy_resume": """
        WITH p AS (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) =
                       (SELECT regexp_extract(arg_min(url, page_id), '^[a-z]+://([^/?#]+)', 1) FROM pages) AS broken,
                       CAST(strlen(html) AS BIGINT) AS bytes FROM pages)
        SELECT page_id, 1 AS run, 'create' AS action, NOT broken AS ok, CASE WHEN broken THEN 0 ELSE bytes END AS bytes
        FROM p
        UNION ALL
        SELECT page_id, 2, CASE WHEN broken THEN 'create' ELSE 'skip' END, true, CASE WHEN broken THEN bytes ELSE 0 END
        FROM p""",
    "merge_in_order": f"""
        WITH {_BODIES}
        SELECT bucket, CAST(coalesce(sum(strlen(body)) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING
                   AND 1 PRECEDING), 0) AS BIGINT) AS start, strlen(body) AS bytes, sha256(body) AS sha256
        FROM f""",
    "copy_ranges": f"""
        WITH {_BODIES},
             h AS (SELECT hex(string_agg(body, '' ORDER BY bucket)) AS h FROM f),
             r AS (SELECT h, unnest(range(0, len(h) // 2, {RANGE})) AS start FROM h),
             p AS (SELECT start, unhex(substr(h, 2 * start + 1, {2 * RANGE})) AS b FROM r)
        SELECT start, CAST(octet_length(b) AS BIGINT) AS bytes, sha256(b) AS sha256 FROM p""",
}
