"""Command-line runs of the batch jobs.

    python -m tessera copy SOURCE DEST [--tasks N] [--ignore-errors] [--range-bytes N] [--journal FOLDER]
    python -m tessera traffic INPUT OUTPUT [--files N]
    python -m tessera index DOCS OUTPUT [--counts] [--block-size N] [--onto STORED_INDEX]
    python -m tessera cells put TABLE BATCH OUT     (--new: TABLE is not there yet)
    python -m tessera cells get TABLE KEYS OUT      (key, column and value as text lines)
    python -m tessera cells delete TABLE KEYS OUT

Options of ``spark-submit`` (master, memory, ``--py-files``) apply as usual;
the session reads ``spark.checkpoint.dir`` from the cluster configuration.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from tessera.session import build_session


def main(argv: list[str] | None = None) -> int:
    """Run one command; returns the exit code."""
    p = argparse.ArgumentParser(prog="tessera")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("copy", help="copy a file tree as a Spark job")
    c.add_argument("source")
    c.add_argument("dest")
    c.add_argument("--tasks", type=int, default=None, help="copy tasks (default: the cluster's width)")
    c.add_argument("--ignore-errors", action="store_true")
    c.add_argument("--task-bytes", type=int, default=None,
                   help="balance files so each task copies about this many bytes")
    c.add_argument("--range-bytes", type=int, default=None,
                   help="files above this size are copied by many tasks, so many bytes each")
    c.add_argument("--journal", default=None,
                   help="folder that notes finished files; a later run with it copies only what is left")
    t = sub.add_parser("traffic", help="per-key totals of tab-separated logs")
    t.add_argument("input")
    t.add_argument("output")
    t.add_argument("--files", type=int, default=None, help="number of output files")
    i = sub.add_parser("index", help="inverted index of a parquet table (doc_id, text)")
    i.add_argument("docs")
    i.add_argument("output")
    i.add_argument("--counts", action="store_true")
    i.add_argument("--block-size", type=int, default=None)
    i.add_argument("--onto", default=None, help="a stored index of other documents to merge with")
    ce = sub.add_parser("cells", help="put / get / delete on a stored cell table (parquet folders)")
    ce.add_argument("action", choices=["put", "get", "delete"])
    ce.add_argument("table")
    ce.add_argument("arg", help="put: batch folder; get/delete: text file of row keys, one per line")
    ce.add_argument("out", nargs="?", help="put/delete: folder for the new table version; get: folder for the lines")
    ce.add_argument("--new", action="store_true", help="put: start a table that is not there yet")
    a = p.parse_args(argv)

    spark = build_session(app=f"tessera-{a.cmd}")
    if a.cmd == "copy":
        from tessera.operators.copy import copy_summary, copy_tree
        status = copy_tree(spark, a.source, a.dest, tasks=a.tasks, ignore_errors=a.ignore_errors,
                           task_bytes=a.task_bytes, range_bytes=a.range_bytes, journal=a.journal)
        copy_summary(status).show(truncate=False)
    elif a.cmd == "traffic":
        from tessera.operators.traffic import traffic_totals
        from tessera.sinks.text import write_key_values
        from tessera.sources.text import read_lines
        totals = traffic_totals(read_lines(spark, a.input))
        write_key_values(totals, a.output, "key", ["up", "down", "total"], num_files=a.files)
    elif a.cmd == "index":
        from tessera.operators import text_index as ti
        docs = spark.read.parquet(a.docs)
        kw = {"block_size": a.block_size} if a.block_size else {}
        out = ti.posting_lists_with_counts(docs, **kw) if a.counts else ti.posting_lists(docs, **kw)
        if a.onto:
            from tessera.operators.index_store import merge_indexes
            out = merge_indexes(spark.read.parquet(a.onto), out, **kw)
        out.write.mode("errorifexists").parquet(a.output)
    elif a.cmd == "cells":
        _cells(spark, a)
    return 0


def _cells(spark, a) -> None:
    from tessera.functions.files import path_exists
    from tessera.operators import cells

    # A mistyped or unreachable table must not pass for an empty one: the put
    # would write a version that holds the batch alone.
    if a.new and (a.action != "put" or path_exists(spark, a.table)):
        raise SystemExit(f"--new is for a put into a table that is not there; {a.table}: {a.action}")
    table = (spark.createDataFrame([], cells.CELL_SCHEMA) if a.new
             else spark.read.parquet(a.table).select(*cells.CELL_COLUMNS))
    if not a.out:
        raise SystemExit(f"cells {a.action} needs an output folder")
    if a.action == "put":
        batch = spark.read.parquet(a.arg).select(*cells.CELL_COLUMNS)
        cells.save_version(cells.merge_cells(table, batch), a.out)
        return
    keys = spark.read.text(a.arg).select(F.col("value").alias("row_key")).where(F.col("row_key") != "")
    if a.action == "get":
        found = cells.get_rows(table, keys)
        text = lambda c: F.coalesce(F.col(c), F.lit(""))
        column = F.concat_ws(":", text("family"), text("qualifier"))
        found.select(F.concat_ws("\t", text("row_key"), column, text("value")).alias("value")) \
            .write.mode("errorifexists").text(a.out)
    else:
        cells.save_version(cells.delete_rows(table, keys), a.out)


if __name__ == "__main__":
    sys.exit(main())
