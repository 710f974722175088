"""Time the headline queries on one data folder.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: seconds}, "sf"}.  Each query is run to completion with
a no-op write (all rows produced, nothing collected) and timed as the best
of ``BENCH_RUNS`` runs (default 3); a first warm-up query is not counted.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.operators.layout import SCAN_PARTITIONS  # noqa: E402
from tessera.plans import catalog  # noqa: E402
from tessera.session import build_session, sized_conf  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))   # best of RUNS per query

HEADLINE = [
    "avg_rate_by_attr", "top_titles_for_segment", "top_titles_of_top_user",
    "stacked_filters", "set_difference", "computed_columns",
    "term_counts", "inverted_index", "inverted_index_counts", "posting_blocks", "traffic_totals",
    "batch_index", "batch_slots", "cells_put", "cells_get", "cells_delete",
    "rebase_paths", "parent_folders", "copy_plan", "copy_plan_sources",
    "folder_sizes", "file_sizes", "name_filter", "first_seen_per_type", "any_match",
    "name_list", "cells_merge", "text_id_index", "repeated_id_counts", "traffic_rejects",
    "name_filter_not", "siblings", "entry_times", "path_sizes", "path_first_times",
    "index_merge", "posting_gaps", "posting_lookup", "cells_put_buckets", "cells_get_buckets", "merge_in_order",
    "copy_ranges", "copy_resume", "manifest_refresh", "match_patterns", "slots_by_size", "line_offsets",
    "delimited_rows", "text_lines", "compacted_lines", "first_lines", "tree_listing", "whole_files",
    "whole_files_of_paths", "glob_files", "key_value_lines", "copy_summary", "spread_work", "placed_batches",
    "utf8_cells",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    input_bytes = sum(os.path.getsize(os.path.join(data_dir, f)) for f in os.listdir(data_dir))
    conf = sized_conf(input_bytes, cpus)
    conf["spark.driver.memory"] = "16g"
    conf[SCAN_PARTITIONS] = str(cpus)  # the test tables are one row group each
    spark = build_session(f"local[{cpus}]", app="tessera-bench", extra=conf)
    run(catalog.QUERIES["traffic_totals"](spark, data_dir))   # warm-up
    times, errors = {}, {}
    for name in HEADLINE:
        best = None
        try:
            for _ in range(RUNS):
                t0 = time.perf_counter()
                run(catalog.QUERIES[name](spark, data_dir))
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # report and go on: one failure must not hide the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)", data_dir)
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else data_dir}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
