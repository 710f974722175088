"""Single-node comparison point: time each oracle SQL in DuckDB (best of
two runs, results materialised into a temp table).

    python scripts/duckdb_timings.py [data_dir] [threads]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from scripts.oracle_check import TABLES  # noqa: E402
from tessera.plans.catalog import ORACLE  # noqa: E402


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    con = duckdb.connect()
    con.execute(f"SET threads={threads}")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    times = {}
    for name, sql in ORACLE.items():
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.execute(f"CREATE OR REPLACE TEMP TABLE _r AS {sql}")
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"engine": "duckdb", "threads": threads, "total": round(sum(times.values()), 3),
                      "queries": times}))


if __name__ == "__main__":
    main()
