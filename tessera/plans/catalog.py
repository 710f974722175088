"""Registered queries: one per operator family, each with DuckDB oracle SQL.

Every query reads the whole tables of a data folder.  ``QUERIES[name]``
takes ``(spark, data_dir)`` and returns a DataFrame; ``ORACLE[name]`` is
the same result in SQL over views named like the tables.  Column names
match between the two.  Posting lists are given as text so that arrays
render the same in both engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.operators import cell_buckets, cells, index_store, manifest, placement, relational, text_index, traffic
from tessera.operators.layout import scan_spread
from tessera.plans import standins as si, trees
from tessera.session import scratch_path

# Fixed query parameters.
MOVIE_ID = 1616            # movie of the per-attribute average
SEGMENT_M = "BUILDING"     # user group of the top-titles query
SEGMENT_F = "AUTOMOBILE"   # user group of the top-user query
MIN_TOTAL = 50             # titles need more ratings than this
TOP_K = 10
SAL_LOW, SAL_HIGH = 1000, 2000
DEPT = "BUILDING"
PREFIX = "order-"
BLOCK = text_index.DEFAULT_BLOCK_SIZE
SMALL_BLOCK = 250          # posting_blocks: small blocks, so test data spans many of them
CELL_BUCKETS = 16
KEY_SEGMENT = "MACHINERY"  # row keys fetched / deleted in the cell table
NAME_MARK = "*page-1*"
MATCH_PATTERN = r"page-42\.html$"
FOLDER_NAME = "en"
SIBLING = "/web/tionsh.example.net"
LIST_BLOCK = 25            # names per listing text (small, so folders span several blocks)

Query = Callable[[SparkSession, str], DataFrame]


def avg_rate_by_attr(spark: SparkSession, d: str) -> DataFrame:
    """Average rate of one movie per user age (nation key)."""
    return relational.average_rating_by(si.ratings(spark, d), si.users(spark, d), MOVIE_ID, "age")


def top_titles_for_segment(spark: SparkSession, d: str) -> DataFrame:
    """Top 10 titles by average rate among one segment's users, titles with more than 50 ratings."""
    return relational.top_titles(si.ratings(spark, d), si.users(spark, d), si.movies(spark, d),
                                 F.col("sex") == SEGMENT_M, MIN_TOTAL, TOP_K)


def top_titles_of_top_user(spark: SparkSession, d: str) -> DataFrame:
    """Top 10 titles by average rate of the most active user of one segment."""
    return relational.top_titles_of_top_user(si.ratings(spark, d), si.users(spark, d),
                                             si.movies(spark, d), F.col("sex") == SEGMENT_F, TOP_K)


def stacked_filters(spark: SparkSession, d: str) -> DataFrame:
    """Names with 1000 < balance < 2000 through stacked filters and a constant condition."""
    return relational.stacked_range_filter(si.employees(spark, d), SAL_LOW, SAL_HIGH)


def set_difference(spark: SparkSession, d: str) -> DataFrame:
    """Distinct jobs of one department's well-paid staff, minus the jobs of better-paid suppliers."""
    t = si.employees(spark, d)
    left = t.where((F.col("sal") > SAL_LOW) & (F.lit(1) == F.lit(1))).where(F.col("deptno") == DEPT)
    right = si.jobs(spark, d).where(F.col("sal") > SAL_HIGH)
    return relational.distinct_except(left, right, ["job"])


def computed_columns(spark: SparkSession, d: str) -> DataFrame:
    """Order keys with a text name and a double column."""
    o = spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey")
    return relational.computed_columns(o, "o_orderkey", PREFIX)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return scan_spread(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), "doc_id")


def posting_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Posting lists with counts in blocks of 250 document ids, as text."""
    pl = text_index.posting_lists_with_counts(_documents(spark, d), block_size=SMALL_BLOCK)
    return pl.select("word", "block", text_index.render_postings(F.col("postings")).alias("postings"))


def term_counts(spark: SparkSession, d: str) -> DataFrame:
    """Count of each word in each document."""
    return text_index.term_counts(_documents(spark, d))


def inverted_index(spark: SparkSession, d: str) -> DataFrame:
    """Sorted document ids per word (and block), as text."""
    pl = text_index.posting_lists(_documents(spark, d), block_size=BLOCK)
    return pl.select("word", "block", text_index.render_ids(F.col("doc_ids")).alias("doc_ids"))


def inverted_index_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sorted (document, count) pairs per word (and block), as text."""
    pl = text_index.posting_lists_with_counts(_documents(spark, d), block_size=BLOCK)
    return pl.select("word", "block", text_index.render_postings(F.col("postings")).alias("postings"))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def index_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two stored indexes with counts, of the documents with even and odd ids
    and with small and large blocks, merged into one, as text."""
    docs = _documents(spark, d)
    halves = [_stored(text_index.posting_lists_with_counts(docs.where(F.pmod("doc_id", F.lit(2)) == k), block_size=size),
                      f"index-{k}") for k, size in ((0, SMALL_BLOCK), (1, BLOCK))]
    merged = index_store.merge_indexes(*halves, block_size=BLOCK)
    return merged.select("word", "block", text_index.render_postings(F.col("postings")).alias("postings"))


def posting_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Posting lists stored as gaps and decoded again, as text, with the
    postings and the bytes of their gaps."""
    stored = _stored(index_store.compact(text_index.posting_lists(_documents(spark, d), block_size=BLOCK)), "gaps")
    lists = index_store.expand(stored).select("word", "block", text_index.render_ids(F.col("doc_ids")).alias("doc_ids"))
    sizes = stored.select("word", "block", "n", F.octet_length("gaps").cast("long").alias("gap_bytes"))
    return lists.join(sizes, ["word", "block"])


def posting_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Which documents hold the first word of the document after them, by
    lookups in a stored index of gaps."""
    docs = _documents(spark, d)
    stored = _stored(index_store.compact(text_index.posting_lists(docs, block_size=SMALL_BLOCK)), "gaps")
    asked = docs.where("text IS NOT NULL").select((F.col("doc_id") - 1).alias("doc_id"),
                                                  F.get(F.split("text", " ", -1), F.lit(0)).alias("word"))
    return index_store.lookup(stored, asked, SMALL_BLOCK)


def traffic_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per-key up / down / total sums parsed from tab-separated log lines."""
    return traffic.traffic_totals(si.traffic_lines(spark, d))


def traffic_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Per-key sums over log lines of which some are blank, short or end in
    empty fields and so don't count."""
    return traffic.traffic_totals(si.mixed_traffic_lines(spark, d))


def text_id_index(spark: SparkSession, d: str) -> DataFrame:
    """Sorted text document ids per word in blocks of 250 documents, as text."""
    pl = text_index.posting_lists(si.text_id_documents(spark, d), block_size=SMALL_BLOCK)
    return pl.select("word", "block", text_index.render_ids(F.col("doc_ids")).alias("doc_ids"))


def repeated_id_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sorted (document, count) pairs per word where many rows share an id."""
    pl = text_index.posting_lists_with_counts(si.source_documents(spark, d))
    return pl.select("word", "block", text_index.render_postings(F.col("postings")).alias("postings"))


def _slot_keys(spark: SparkSession, d: str) -> DataFrame:
    l = spark.read.parquet(f"{d}/lineitem.parquet")
    return l.select("l_orderkey", "l_linenumber", F.col("l_linenumber").alias("part_id"),
                    F.col("l_quantity").cast("int").alias("batch"))


def batch_index(spark: SparkSession, d: str) -> DataFrame:
    """Largest batch and first slot of each partition."""
    return placement.batch_index(_slot_keys(spark, d))


def batch_slots(spark: SparkSession, d: str) -> DataFrame:
    """Slot of every (partition, batch) key."""
    keys = _slot_keys(spark, d)
    return placement.assign_slots(keys, placement.batch_index(keys))


def _cell_table(spark: SparkSession, d: str) -> DataFrame:
    puts = si.cell_puts(spark, d)
    return cells.put_cells(si.first_batch(puts), si.second_batch(puts))


def cells_put(spark: SparkSession, d: str) -> DataFrame:
    """Cell table after putting the later events onto the earlier ones."""
    return _cell_table(spark, d)


def cells_merge(spark: SparkSession, d: str) -> DataFrame:
    """The later events merged into a cell table that holds cells repeatedly."""
    puts = si.cell_puts(spark, d)
    return cells.merge_cells(si.first_batch(puts), si.second_batch(puts))


def cells_put_buckets(spark: SparkSession, d: str) -> DataFrame:
    """A stored table of the earlier events in hash buckets after putting the
    later ones into the buckets they touch."""
    puts, path = si.cell_puts(spark, d), scratch_path(spark, "cells")
    cell_buckets.create(si.first_batch(puts), path, CELL_BUCKETS)
    cell_buckets.put(si.second_batch(puts), path)
    return cell_buckets.read(spark, path)


def cells_get_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Cells of one segment's customer keys, from their buckets of a stored table."""
    path = scratch_path(spark, "cells")
    cell_buckets.create(_cell_table(spark, d), path, CELL_BUCKETS)
    return cell_buckets.get(si.cell_keys(spark, d, KEY_SEGMENT), path)


def cells_get(spark: SparkSession, d: str) -> DataFrame:
    """Cells of one segment's customer keys."""
    return cells.get_rows(_cell_table(spark, d), si.cell_keys(spark, d, KEY_SEGMENT))


def cells_delete(spark: SparkSession, d: str) -> DataFrame:
    """Cell table without one segment's customer keys."""
    return cells.delete_rows(_cell_table(spark, d), si.cell_keys(spark, d, KEY_SEGMENT))


def rebase_paths(spark: SparkSession, d: str) -> DataFrame:
    """Destination of every page file when /web is copied into /backup."""
    return manifest.rebase(si.page_files(spark, d), si.SOURCE_ROOT, si.DEST_ROOT).select("uri", "dest")


def parent_folders(spark: SparkSession, d: str) -> DataFrame:
    """Page files plus every folder above them, each once."""
    return manifest.with_parent_folders(si.page_files(spark, d), si.SOURCE_ROOT).select(
        "uri", "len", "file_type")


def copy_plan(spark: SparkSession, d: str) -> DataFrame:
    """Copy plan of /web into /backup against an earlier backup."""
    return manifest.copy_plan(si.page_files(spark, d), si.backup_files(spark, d),
                              si.SOURCE_ROOT, si.DEST_ROOT)


def copy_plan_sources(spark: SparkSession, d: str) -> DataFrame:
    """Copy plan entries that have a source."""
    return manifest.copy_work(copy_plan(spark, d))


def folder_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and entry count directly inside each folder."""
    tree = manifest.with_parent_folders(si.page_files(spark, d), si.SOURCE_ROOT)
    return manifest.folder_sizes(tree)


def file_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Sizes of the files directly inside the folders named 'en'."""
    tree = manifest.with_parent_folders(si.page_files(spark, d), si.SOURCE_ROOT)
    from tessera.functions.paths import base_name
    folders = tree.where((F.col("file_type") == "dir") & (base_name(F.col("uri")) == FOLDER_NAME))
    return manifest.file_sizes(tree, folders.select(F.col("uri").alias("folder")), folders_only=True)


def name_filter(spark: SparkSession, d: str) -> DataFrame:
    """Page files whose name contains 'page-1'."""
    return manifest.name_contains(si.page_files(spark, d), NAME_MARK).select("uri", "len")


def name_filter_not(spark: SparkSession, d: str) -> DataFrame:
    """Page files whose whole path does not contain 'page-1'."""
    return manifest.name_contains(si.page_files(spark, d), NAME_MARK, negate=True, whole_path=True).select("uri", "len")


def siblings(spark: SparkSession, d: str) -> DataFrame:
    """The other entries beside one top-level folder of the tree."""
    tree = manifest.with_parent_folders(si.page_files(spark, d), si.SOURCE_ROOT)
    return manifest.siblings(tree, SIBLING).select("uri", "file_type")


def entry_times(spark: SparkSession, d: str) -> DataFrame:
    """Time of every page file."""
    return _micros(manifest.entry_times(si.page_files(spark, d)), "mtime")


def path_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Bytes and entries of the listings of folders, files and missing paths."""
    return manifest.path_sizes(si.page_files(spark, d), si.listed_paths(spark, d))


def path_first_times(spark: SparkSession, d: str) -> DataFrame:
    """Time of the first entry of the same listings."""
    return _micros(manifest.path_first_times(si.page_files(spark, d), si.listed_paths(spark, d)), "first_time")


def _micros(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.unix_micros(col))


def first_seen_per_type(spark: SparkSession, d: str) -> DataFrame:
    """Time of the first event (by id) of each event type."""
    first = manifest.first_entry_time(si.event_entries(spark, d))
    return first.select(F.col("parent").alias("event_type"),
                        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                        F.col("first_time")).alias("first_time"))


def any_match(spark: SparkSession, d: str) -> DataFrame:
    """Whether any page file matches a pattern."""
    return manifest.any_match(si.page_files(spark, d), MATCH_PATTERN)


def name_list(spark: SparkSession, d: str) -> DataFrame:
    """Comma-joined folder listings in blocks of 25 names."""
    tree = manifest.with_parent_folders(si.page_files(spark, d), si.SOURCE_ROOT)
    return manifest.name_lists(tree, LIST_BLOCK)


QUERIES: dict[str, Query] = {
    "avg_rate_by_attr": avg_rate_by_attr,
    "top_titles_for_segment": top_titles_for_segment,
    "top_titles_of_top_user": top_titles_of_top_user,
    "stacked_filters": stacked_filters,
    "set_difference": set_difference,
    "computed_columns": computed_columns,
    "term_counts": term_counts,
    "inverted_index": inverted_index,
    "inverted_index_counts": inverted_index_counts,
    "posting_blocks": posting_blocks,
    "text_id_index": text_id_index,
    "repeated_id_counts": repeated_id_counts,
    "index_merge": index_merge,
    "posting_gaps": posting_gaps,
    "posting_lookup": posting_lookup,
    "traffic_totals": traffic_totals,
    "traffic_rejects": traffic_rejects,
    "batch_index": batch_index,
    "batch_slots": batch_slots,
    "cells_put": cells_put,
    "cells_merge": cells_merge,
    "cells_put_buckets": cells_put_buckets,
    "cells_get_buckets": cells_get_buckets,
    "cells_get": cells_get,
    "cells_delete": cells_delete,
    "rebase_paths": rebase_paths,
    "parent_folders": parent_folders,
    "copy_plan": copy_plan,
    "copy_plan_sources": copy_plan_sources,
    "folder_sizes": folder_sizes,
    "file_sizes": file_sizes,
    "name_filter": name_filter,
    "name_filter_not": name_filter_not,
    "siblings": siblings,
    "entry_times": entry_times,
    "path_sizes": path_sizes,
    "path_first_times": path_first_times,
    "first_seen_per_type": first_seen_per_type,
    "any_match": any_match,
    "name_list": name_list,
}

# ---------------------------------------------------------------- oracle SQL

_RATINGS = """r AS (SELECT o.o_custkey AS userid, l.l_partkey AS movieid,
                      CAST(l.l_quantity AS INTEGER) AS rate
               FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_WORDS = "w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents)"

def _block_sql(b: int) -> str:
    return f"(doc_id - ((doc_id % {b}) + {b}) % {b}) // {b}"


_BLOCK = _block_sql(BLOCK)

_PAGES = """pm AS (SELECT '/web/' || regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) || '/'
                       || regexp_extract(url, '^[a-z]+://[^/?#]+/([^/?#]*)', 1)
                       || '/page-' || CAST(page_id AS VARCHAR) || '.html' AS uri,
                   CAST(strlen(html) AS BIGINT) AS len, 'file' AS file_type, url,
                   (1700000000 + page_id * 60 % 86399) * 1000000 AS mtime
            FROM pages)"""

_LISTED = _PAGES + """,
     listed AS (SELECT regexp_replace(uri, '/[^/]*$', '') AS path FROM pm WHERE contains(url, '#')
                UNION SELECT uri FROM pm WHERE starts_with(url, 'https:')
                UNION SELECT uri || '.gone' FROM pm),
     hit AS (SELECT l.path, p.uri, p.len, p.mtime FROM listed l
             LEFT JOIN pm p ON l.path = p.uri OR l.path = regexp_replace(p.uri, '/[^/]*$', ''))"""

_TREE = _PAGES + """,
     pf AS (SELECT DISTINCT array_to_string(parts[1:i], '/') AS uri
            FROM (SELECT parts, unnest(generate_series(2, len(parts) - 1)) AS i
                  FROM (SELECT string_split(uri, '/') AS parts FROM pm))),
     tree AS (SELECT uri, len, file_type FROM pm
              UNION ALL
              SELECT uri, CAST(0 AS BIGINT), 'dir' FROM pf
              WHERE (uri = '/web' OR starts_with(uri, '/web/')) AND uri NOT IN (SELECT uri FROM pm))"""

_PARENT = "CASE WHEN regexp_replace(uri, '/[^/]*$', '') = '' THEN '/' ELSE regexp_replace(uri, '/[^/]*$', '') END"

_CELLS = f"""c AS (SELECT CAST(user_id AS VARCHAR) AS row_key, 'e' AS family, event_type AS qualifier,
                      props AS value, epoch_us(ts) AS version,
                      CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END AS seq
               FROM events),
     cur AS (SELECT row_key, family, qualifier, value, version FROM (
               SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier
                                            ORDER BY version DESC, seq DESC, value DESC) AS rn
               FROM c) WHERE rn = 1),
     k AS (SELECT CAST(c_custkey AS VARCHAR) AS row_key FROM customer WHERE c_mktsegment = '{KEY_SEGMENT}')"""

_SLOTS = """k AS (SELECT l_orderkey, l_linenumber, l_linenumber AS part_id,
                      CAST(l_quantity AS INTEGER) AS batch FROM lineitem),
     m AS (SELECT part_id, max(batch) AS max_batch FROM k GROUP BY part_id),
     i AS (SELECT part_id, max_batch,
                  CAST(COALESCE(sum(max_batch + 1) OVER (ORDER BY part_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS slot_offset
           FROM m)"""

_PLAN = _PAGES + """,
     s AS (SELECT uri AS src_uri, '/backup' || uri AS dest, 'file' AS src_type, len AS src_len FROM pm),
     d AS (SELECT '/backup' || uri AS dest, 'file' AS dest_type, len AS dest_len FROM pm
           WHERE starts_with(url, 'https:')
           UNION ALL
           SELECT '/backup' || uri || '.old', 'file', CAST(0 AS BIGINT) FROM pm
           WHERE contains(url, '#')),
     plan AS (SELECT s.src_uri, COALESCE(s.dest, d.dest) AS dest,
                     COALESCE(src_type, dest_type) AS file_type, src_len, dest_len,
                     CASE WHEN s.src_uri IS NULL THEN 'keep'
                          WHEN src_type = 'dir' AND dest_type IS NULL THEN 'mkdir'
                          WHEN src_type = 'dir' THEN 'exists'
                          WHEN dest_type IS NULL THEN 'create'
                          ELSE 'replace' END AS action
              FROM s FULL OUTER JOIN d ON s.dest = d.dest)"""

ORACLE: dict[str, str] = {
    "avg_rate_by_attr": f"""
        WITH {_RATINGS}
        SELECT c.c_nationkey AS age, avg(r.rate) AS avgrate
        FROM r JOIN customer c ON r.userid = c.c_custkey
        WHERE r.movieid = {MOVIE_ID}
        GROUP BY c.c_nationkey""",
    "top_titles_for_segment": f"""
        WITH {_RATINGS}
        SELECT p.p_name AS moviename, avg(r.rate) AS avgrate, count(*) AS total
        FROM r JOIN customer c ON r.userid = c.c_custkey
               JOIN part p ON r.movieid = p.p_partkey
        WHERE c.c_mktsegment = '{SEGMENT_M}'
        GROUP BY p.p_name HAVING count(*) > {MIN_TOTAL}
        ORDER BY avgrate DESC, moviename LIMIT {TOP_K}""",
    "top_titles_of_top_user": f"""
        WITH {_RATINGS},
             top AS (SELECT r.userid, count(*) AS total
                     FROM r JOIN customer c ON r.userid = c.c_custkey
                     WHERE c.c_mktsegment = '{SEGMENT_F}'
                     GROUP BY r.userid ORDER BY total DESC, r.userid LIMIT 1)
        SELECT p.p_name AS moviename, avg(r.rate) AS avgrate
        FROM part p JOIN r ON p.p_partkey = r.movieid JOIN top ON r.userid = top.userid
        GROUP BY p.p_name ORDER BY avgrate DESC, moviename LIMIT {TOP_K}""",
    "stacked_filters": f"""
        SELECT c_name AS name FROM customer WHERE c_acctbal > {SAL_LOW} AND c_acctbal < {SAL_HIGH}""",
    "set_difference": f"""
        SELECT DISTINCT c_nationkey AS job FROM customer
        WHERE c_acctbal > {SAL_LOW} AND 1 = 1 AND c_mktsegment = '{DEPT}'
        EXCEPT
        SELECT s_nationkey AS job FROM supplier WHERE s_acctbal > {SAL_HIGH}""",
    "computed_columns": f"""
        SELECT o_orderkey AS id, concat('{PREFIX}', o_orderkey) AS name,
               CAST(o_orderkey AS DOUBLE) * 1.0 AS id2
        FROM orders""",
    "term_counts": f"""
        WITH {_WORDS}
        SELECT word, doc_id, count(*) AS n FROM w GROUP BY word, doc_id""",
    "inverted_index": f"""
        WITH {_WORDS}, p AS (SELECT DISTINCT word, doc_id FROM w)
        SELECT word, {_BLOCK} AS block,
               string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids
        FROM p GROUP BY word, block""",
    "inverted_index_counts": f"""
        WITH {_WORDS}, c AS (SELECT word, doc_id, count(*) AS n FROM w GROUP BY word, doc_id)
        SELECT word, {_BLOCK} AS block,
               string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY doc_id) AS postings
        FROM c GROUP BY word, block""",
    "index_merge": f"""
        WITH {_WORDS}, c AS (SELECT word, doc_id, count(*) AS n FROM w GROUP BY word, doc_id)
        SELECT word, {_BLOCK} AS block,
               string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY doc_id) AS postings
        FROM c GROUP BY word, block""",
    "posting_gaps": f"""
        WITH {_WORDS}, p AS (SELECT DISTINCT word, doc_id, {_BLOCK} AS block FROM w),
             g AS (SELECT *, doc_id - lag(doc_id) OVER (PARTITION BY word, block ORDER BY doc_id) AS gap FROM p)
        SELECT word, block, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids, count(*) AS n,
               CAST(coalesce(sum(1 + CAST(gap >= 128 AS INTEGER) + CAST(gap >= 16384 AS INTEGER)), 0) AS BIGINT)
                   AS gap_bytes
        FROM g GROUP BY word, block""",
    "posting_lookup": f"""
        WITH {_WORDS}, p AS (SELECT DISTINCT word, doc_id FROM w),
             a AS (SELECT doc_id - 1 AS doc_id, string_split(text, ' ')[1] AS word FROM documents WHERE text IS NOT NULL)
        SELECT a.word, a.doc_id, p.word IS NOT NULL AS found FROM a LEFT JOIN p USING (word, doc_id)""",
    "posting_blocks": f"""
        WITH {_WORDS}, c AS (SELECT word, doc_id, count(*) AS n FROM w GROUP BY word, doc_id)
        SELECT word, {_block_sql(SMALL_BLOCK)} AS block,
               string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY doc_id) AS postings
        FROM c GROUP BY word, block""",
    "traffic_totals": """
        SELECT CAST(l_suppkey AS VARCHAR) AS key,
               CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS up,
               CAST(sum(CAST(round(l_tax * 100) AS INTEGER)) AS BIGINT) AS down,
               CAST(sum(CAST(l_quantity AS INTEGER) + CAST(round(l_tax * 100) AS INTEGER)) AS BIGINT) AS total
        FROM lineitem GROUP BY l_suppkey""",
    "traffic_rejects": """
        WITH f AS (SELECT *, 'a' || chr(9) || l_suppkey || chr(9) || 'c' || chr(9) || 'd' || chr(9) || 'e' || chr(9)
                             || 'f' || chr(9) || 'g' || chr(9) || 'h' AS eight FROM lineitem),
             v AS (SELECT CASE l_linenumber WHEN 2 THEN '  ' WHEN 3 THEN 'a' || chr(9) || 'b' || chr(9) || 'c'
                          WHEN 4 THEN eight || chr(9) || chr(9)
                          WHEN 5 THEN eight || chr(9) || CAST(l_quantity AS INTEGER) || chr(9) || '7' || chr(9) || 'x'
                                      || chr(9) || 'y'
                          ELSE eight || chr(9) || CAST(l_quantity AS INTEGER) || chr(9) || '7' END AS value FROM f),
             s AS (SELECT value, string_split(rtrim(value, chr(9)), chr(9)) AS p FROM v),
             ok AS (SELECT p[2] AS key, CAST(p[9] AS BIGINT) AS up, CAST(p[10] AS BIGINT) AS down
                    FROM s WHERE trim(value) <> '' AND len(p) >= 10)
        SELECT key, CAST(sum(up) AS BIGINT) AS up, CAST(sum(down) AS BIGINT) AS down,
               CAST(sum(up + down) AS BIGINT) AS total
        FROM ok GROUP BY key""",
    "text_id_index": f"""
        WITH t AS (SELECT source || '/' || doc_id AS id, text FROM documents),
             n AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS k FROM (SELECT DISTINCT id FROM t)),
             p AS (SELECT DISTINCT word, id, k
                   FROM (SELECT t.id, k, unnest(string_split(text, ' ')) AS word FROM t JOIN n USING (id)))
        SELECT word, k // {SMALL_BLOCK} AS block, string_agg(id, ',' ORDER BY k) AS doc_ids
        FROM p GROUP BY word, block""",
    "repeated_id_counts": f"""
        WITH t AS (SELECT TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) AS doc_id, text FROM documents),
             w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM t WHERE doc_id IS NOT NULL),
             c AS (SELECT word, doc_id, count(*) AS n FROM w GROUP BY word, doc_id)
        SELECT word, {_BLOCK} AS block,
               string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(n AS VARCHAR), ',' ORDER BY doc_id) AS postings
        FROM c GROUP BY word, block""",
    "name_filter_not": f"""
        WITH {_PAGES}
        SELECT uri, len FROM pm WHERE NOT contains(uri, '{NAME_MARK.replace('*', '')}')""",
    "siblings": f"""
        WITH {_TREE}
        SELECT uri, file_type FROM tree WHERE uri <> '/' AND {_PARENT} = '/web' AND uri <> '{SIBLING}'""",
    "entry_times": f"""
        WITH {_PAGES}
        SELECT uri, mtime FROM pm""",
    "path_sizes": f"""
        WITH {_LISTED}
        SELECT path, CAST(coalesce(sum(len), 0) AS BIGINT) AS bytes, count(uri) AS entries FROM hit GROUP BY path""",
    "path_first_times": f"""
        WITH {_LISTED}
        SELECT path, arg_min(mtime, uri) AS first_time FROM hit GROUP BY path""",
    "cells_merge": f"""
        WITH {_CELLS}
        SELECT row_key, family, qualifier, value, version FROM cur""",
    "batch_index": f"""
        WITH {_SLOTS}
        SELECT part_id, max_batch, slot_offset FROM i""",
    "batch_slots": f"""
        WITH {_SLOTS}
        SELECT k.l_orderkey, k.l_linenumber, k.part_id, k.batch,
               i.slot_offset + k.batch % (i.max_batch + 1) AS slot
        FROM k JOIN i ON k.part_id = i.part_id""",
    "cells_put": f"""
        WITH {_CELLS}
        SELECT row_key, family, qualifier, value, version FROM cur""",
    "cells_put_buckets": f"""
        WITH {_CELLS}
        SELECT row_key, family, qualifier, value, version FROM cur""",
    "cells_get_buckets": f"""
        WITH {_CELLS}
        SELECT row_key, family, qualifier, value FROM cur
        WHERE row_key IN (SELECT row_key FROM k)""",
    "cells_get": f"""
        WITH {_CELLS}
        SELECT row_key, family, qualifier, value FROM cur
        WHERE row_key IN (SELECT row_key FROM k)""",
    "cells_delete": f"""
        WITH {_CELLS}
        SELECT row_key, family, qualifier, value, version FROM cur
        WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.row_key = cur.row_key)""",
    "rebase_paths": f"""
        WITH {_PAGES}
        SELECT uri, '/backup' || uri AS dest FROM pm""",
    "parent_folders": f"""
        WITH {_TREE}
        SELECT uri, len, file_type FROM tree""",
    "copy_plan": f"""
        WITH {_PLAN}
        SELECT * FROM plan""",
    "copy_plan_sources": f"""
        WITH {_PLAN}
        SELECT * FROM plan WHERE src_uri IS NOT NULL""",
    "folder_sizes": f"""
        WITH {_TREE}
        SELECT {_PARENT} AS parent, CAST(sum(len) AS BIGINT) AS bytes, count(*) AS entries
        FROM tree WHERE uri <> '/' GROUP BY 1""",
    "file_sizes": f"""
        WITH {_TREE}
        SELECT uri, len FROM tree
        WHERE regexp_extract(uri, '/([^/]*)/[^/]*$', 1) = '{FOLDER_NAME}'""",
    "name_filter": f"""
        WITH {_PAGES}
        SELECT uri, len FROM pm
        WHERE contains(regexp_extract(uri, '([^/]*)$', 1), '{NAME_MARK.replace('*', '')}')""",
    "first_seen_per_type": """
        SELECT event_type, epoch_us(arg_min(ts, event_id)) AS first_time
        FROM events GROUP BY event_type""",
    "name_list": f"""
        WITH {_TREE},
             e AS (SELECT {_PARENT} AS parent, regexp_extract(uri, '([^/]*)$', 1) AS name
                   FROM tree WHERE uri <> '/'),
             p AS (SELECT parent, name,
                          (row_number() OVER (PARTITION BY parent ORDER BY name) - 1) // {LIST_BLOCK} AS block
                   FROM e)
        SELECT parent, block, string_agg(name, ',' ORDER BY name) AS names
        FROM p GROUP BY parent, block""",
    "any_match": f"""
        WITH {_PAGES}
        SELECT count(*) > 0 AS found
        FROM (SELECT 1 FROM pm WHERE regexp_matches(uri, '{MATCH_PATTERN}') LIMIT 1)""",
}

QUERIES |= trees.QUERIES
ORACLE |= trees.ORACLE
