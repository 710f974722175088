"""Throughput of the file operators on a real tree.

The pages of a data folder are written as files ``<host>/<lang>/page-<id>.html``
under a fresh scratch folder (set-up, not timed); then the listing
(``list_tree``) and the copy (``copy_tree``) are timed, and a single-process
``shutil.copytree`` of the same tree is timed for comparison.

    python scripts/copy_bench.py [data_dir] [tasks]
"""

from __future__ import annotations

import json
import os
import re
import shutil
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pyarrow.parquet as pq  # noqa: E402

from tessera.operators.copy import copy_summary, copy_tree  # noqa: E402
from tessera.session import build_session  # noqa: E402
from tessera.sources.files import list_tree  # noqa: E402


def build_tree(data_dir: str, root: str) -> tuple[int, int]:
    t = pq.read_table(f"{data_dir}/pages.parquet", columns=["page_id", "url", "html"]).to_pylist()
    n = size = 0
    for r in t:
        m = re.match(r"^[a-z]+://([^/?#]+)/([^/?#]*)", r["url"])
        host, lang = (m.group(1), m.group(2)) if m else ("unknown", "")
        folder = os.path.join(root, host, lang or "_")
        os.makedirs(folder, exist_ok=True)
        data = r["html"].encode("utf-8")
        with open(os.path.join(folder, f"page-{r['page_id']}.html"), "wb") as f:
            f.write(data)
        n += 1
        size += len(data)
    return n, size


def main():
    data_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    tasks = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    base = tempfile.mkdtemp(prefix="tessera-copy-bench-")
    src, dst, ref = f"{base}/src", f"{base}/dst", f"{base}/ref"
    os.makedirs(dst)
    files, size = build_tree(data_dir, src)
    spark = build_session(f"local[{tasks}]", app="tessera-copy-bench", shuffle_partitions=tasks)
    list_tree(spark, src, tasks).count()        # warm-up

    t0 = time.perf_counter()
    entries = list_tree(spark, src, tasks).count()
    t_list = time.perf_counter() - t0

    t0 = time.perf_counter()
    status = copy_tree(spark, src, dst, tasks=tasks)
    t_copy = time.perf_counter() - t0
    summary = {f"{r.action}/{r.ok}": r.entries for r in copy_summary(status).collect()}

    t0 = time.perf_counter()
    shutil.copytree(src, ref)
    t_ref = time.perf_counter() - t0
    print(json.dumps({"files": files, "bytes": size, "entries": entries, "tasks": tasks,
                      "list_sec": round(t_list, 3), "copy_sec": round(t_copy, 3),
                      "shutil_copytree_sec": round(t_ref, 3), "status": summary, "scratch": base}))


if __name__ == "__main__":
    main()
