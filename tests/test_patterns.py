"""Many globs in one sweep against each glob alone; work dealt by size."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.functions.paths import glob_to_regex
from tessera.operators import patterns as P, placement
from tessera.operators.manifest import glob_entries


def _match(spark, paths, globs, parts=5):
    got = P.match_patterns(spark.createDataFrame([(p,) for p in paths], "uri string"),
                           spark.createDataFrame([(g,) for g in globs], "pattern string"), parts)
    return sorted(tuple(r) for r in got.collect())


def test_equals_each_glob_alone(spark):
    deal = random.Random(3)
    part = lambda: deal.choice(["a", "ab", "b.c", "d-1", "é", "x y", "\U0001F600", "z\n"])
    paths = ["/" + "/".join(part() for _ in range(deal.randint(1, 4))) for _ in range(400)] + ["/", "/hot/x"]
    globs = ["*", "/*", "/a/*", "/a*/*", "/a/?", "/{a,ab}/*", "/a/b.c", "/ab/*/[a-d]*", "/ab/*/[!a-d]*", "/hot/x", "",
             "/a/\\*", "/é/*", "/\U0001F600/*/*", "/a/*", None, "/a", "/none/*", "[", "/b.c/[", "/*/*/*/*", "/x y/?*"]
    want = sorted((p, g) for g in {g for g in globs if g is not None} for p in paths
                  if re.fullmatch(glob_to_regex(g)[1:-1], p, re.S))
    for parts in (1, 2, 7, 40):
        assert _match(spark, paths + [None], globs, parts) == want
    frame = spark.createDataFrame([(p,) for p in paths if not p.endswith("\n")], "uri string")
    for g in ("/a*/*", "/{a,ab}/*", "/ab/*/[!a-d]*"):
        assert sorted(r.uri for r in glob_entries(frame, g).collect()) == sorted(
            p for p, q in want if q == g and not p.endswith("\n"))


def test_empty_sides(spark):
    assert _match(spark, [], ["*"]) == [] and _match(spark, ["/a"], []) == []


def test_hot_folder_and_hot_path_span_ranges(spark):
    paths = [f"/hot/f{i:05d}" for i in range(3000)] + ["/hot/same"] * 1500 + [f"/d{i}/x" for i in range(500)]
    manifest = spark.createDataFrame([(p,) for p in paths], "uri string")
    globs = spark.createDataFrame([("/hot/*",), ("/hot/s*",), ("/d1*/x",)], "pattern string")
    got = P.match_patterns(manifest, globs, 20)
    sizes = got.where("uri LIKE '/hot/%'").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 12 and max(r["count"] for r in sizes) < 6000 / 5
    assert got.count() == 4500 + 1500 + 111
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan


def test_heads():
    assert [P.glob_head(g) for g in ("/a/b*", "/a?", "[x]", "/p{a,b}", "/l\\*", "/plain", "")] == [
        "/a/b", "/a", "", "/p", "/l", "/plain", ""]


@pytest.mark.parametrize("n_slots", [1, 3, 16])
def test_slots_by_size(spark, n_slots):
    deal = random.Random(n_slots)
    rows = [(f"f{i}", None if i % 50 == 0 else int(deal.paretovariate(0.8) * 100)) for i in range(2000)]
    given = spark.createDataFrame(rows, "uri string, len long").repartition(7)
    dealt = placement.slots_by_size(given, "len", "uri", n_slots)
    ordered = sorted(rows, key=lambda r: (-(r[1] or 0), r[0]))
    assert {r.uri: r.slot for r in dealt.collect()} == {u: k % n_slots for k, (u, _) in enumerate(ordered)}
    loads = [0] * n_slots
    for k, (_, size) in enumerate(ordered):
        loads[k % n_slots] += size or 0
    largest = ordered[0][1]
    assert max(loads) <= sum(loads) / n_slots + largest and max(loads) - min(loads) <= largest
    assert placement.slots_by_size(given.limit(0), "len", "uri", n_slots).count() == 0
