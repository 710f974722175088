"""Property tests: operators against brute-force Python models of the
reference programs' semantics."""

import collections

from hypothesis import given, settings, strategies as st, HealthCheck

from tessera.functions.paths import parent_chain
from tessera.operators import text_index as ti
from tessera.operators.traffic import parse_traffic

SETTINGS = dict(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))

word = st.sampled_from(["a", "b", "ab", "", "é", "x\ny", "B"])
texts = st.lists(st.lists(word, max_size=12).map(" ".join), min_size=1, max_size=8)


@settings(**SETTINGS)
@given(texts)
def test_term_counts_match_split_and_count(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = sorted((r.word, r.doc_id, r.n) for r in ti.term_counts(df).collect())
    want = sorted((w, i, n) for i, t in enumerate(docs)
                  for w, n in collections.Counter(t.split(" ")).items())
    assert got == want


def java_split(line: str, sep: str = "\t"):
    parts = line.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts if line else [""]


field = st.sampled_from(["1", "-2", "+3", "k", "", "kk", "20"])
lines = st.lists(st.lists(field, min_size=0, max_size=13).map("\t".join), min_size=1, max_size=10)


@settings(**SETTINGS)
@given(lines)
def test_field_selection_matches_java_split(spark, rows):
    rows = [r for r in rows if not r.strip() or all(
        f.lstrip("+-").isdigit() for f in java_split(r)[8:10])] or [""]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    got = sorted((r.key, r.up, r.down) for r in parse_traffic(df).collect())
    want = []
    for r in rows:
        if not r.strip():
            continue
        p = java_split(r)
        if len(p) >= 10:
            want.append((p[1], int(p[8]), int(p[9])))
    assert got == sorted(want)


segment = st.sampled_from(["a", "b", "web", "x y"])


@settings(**SETTINGS)
@given(st.lists(segment, min_size=1, max_size=6))
def test_parent_chain_matches_prefixes(spark, parts):
    path = "/" + "/".join(parts)
    df = spark.createDataFrame([(path,)], "p string")
    got = df.select(parent_chain(df["p"], "/a").alias("c")).first().c
    prefixes = ["/" + "/".join(parts[:i]) for i in range(1, len(parts))]
    want = [p for p in prefixes if p == "/a" or p.startswith("/a/")]
    assert got == want


def rebase_model(path: str, root: str, dest: str) -> str:
    base = root.rsplit("/", 1)[0] or "/"
    rel = path[len(base):].lstrip("/")
    return dest.rstrip("/") + "/" + rel


@settings(**SETTINGS)
@given(st.lists(segment, min_size=0, max_size=4), st.lists(segment, min_size=1, max_size=3))
def test_rebase_matches_model(spark, below, root_parts):
    from tessera.functions.paths import rebase_path
    root = "/" + "/".join(root_parts)
    path = root + ("/" + "/".join(below) if below else "")
    df = spark.createDataFrame([(path,)], "p string")
    got = df.select(rebase_path(df["p"], root, "/bak/").alias("d")).first().d
    assert got == rebase_model(path, root, "/bak")


name = st.text(alphabet="ab.-_x", min_size=0, max_size=6)
glob = st.text(alphabet="ab.*?-x", min_size=1, max_size=5)


@settings(max_examples=200, deadline=None)
@given(glob, name)
def test_glob_matches_fnmatch_within_one_part(pattern, text):
    import fnmatch
    import re
    from tessera.functions.paths import glob_to_regex
    assert bool(re.search(glob_to_regex(pattern), text)) == fnmatch.fnmatchcase(text, pattern)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", "hot"]), st.integers(0, 50), st.integers(0, 9)),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 7))
def test_prefix_sum_matches_running_sum(spark, rows, pieces):
    from pyspark.sql import functions as F
    from tessera.operators.ranking import exclusive_prefix_sum
    df = spark.createDataFrame(rows, "g string, o int, v int")
    out = exclusive_prefix_sum(df, "o", F.col("v").cast("long"), "before", group_col="g", partitions=pieces)
    got = {(r.g, r.o): r.before for r in out.collect()}
    want, run = {}, {}
    for g, o, v in sorted(rows):
        want[(g, o)] = run.get(g, 0)
        run[g] = run.get(g, 0) + v
    assert got == want
