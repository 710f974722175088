import glob
import os

import pytest

from tessera.operators.traffic import traffic_totals
from tessera.sinks.text import write_key_values
from tessera.sources.text import read_lines
from conftest import write


def line(key, up, down, n=10, tail=""):
    f = [f"f{i}" for i in range(max(n, 10))]
    f[1], f[8], f[9] = key, str(up), str(down)
    return "\t".join(f[:n]) + tail


def test_edge_lines(spark, tmp):
    big = 2_000_000_000
    lines = [
        "",                              # blank
        "   \t  ",                       # blank (white space only)
        line("k1", 1, 2),
        line("k1", 3, 4, n=11),          # extra field
        line("k2", 5, 6, n=9),           # too short: dropped
        line("k3", 7, 8) + "\t\t\t",     # trailing tabs do not count but do not hurt
        "\t".join(["a", "k4", "", "", "", "", "", "", "9", "1"]),   # empty fields inside count
        "\t".join(["a", "k5", "", "", "", "", "", "", "9"]) + "\t\t",  # 9 fields + trailing tabs: dropped
        line("big", big, big),
        line("big", big, big),
        line("neg", -5, "+7"),
    ]
    write(f"{tmp}/in/part-0.txt", "\n".join(lines) + "\n")
    got = {r.key: (r.up, r.down, r.total) for r in traffic_totals(read_lines(spark, f"{tmp}/in")).collect()}
    assert got == {"k1": (4, 6, 10), "k3": (7, 8, 15), "k4": (9, 1, 10),
                   "big": (2 * big, 2 * big, 4 * big), "neg": (-5, 7, 2)}


@pytest.mark.parametrize("bad", ["x1", " 12 ", "1.5", "", "2147483648"])
def test_bad_int_fails_the_job(spark, tmp, bad):
    write(f"{tmp}/in/a.txt", line("k", bad, 1) + "\n")
    with pytest.raises(Exception, match="not an int"):
        traffic_totals(read_lines(spark, f"{tmp}/in")).collect()


def test_key_value_sink_two_files(spark, tmp):
    write(f"{tmp}/in/a.txt", "\n".join(line(f"k{i}", i, 2 * i) for i in range(20)) + "\n")
    totals = traffic_totals(read_lines(spark, f"{tmp}/in"))
    write_key_values(totals, f"{tmp}/out", "key", ["up", "down", "total"], num_files=2)
    parts = [p for p in glob.glob(f"{tmp}/out/part-*") if os.path.getsize(p) > 0]
    assert len(parts) <= 2
    rows = sorted(l.rstrip("\n") for p in parts for l in open(p))
    assert "k3\t3 6 9" in rows and len(rows) == 20


def test_unicode_blank_lines_are_skipped(spark, tmp):
    blank_wide = "　\t" * 10          # ideographic spaces and tabs only: blank
    nbsp = "\t".join([" ", "k", "", "", "", "", "", "", "1", "2"])  # no-break space is not blank
    write(f"{tmp}/in/a.txt", blank_wide + "\n" + nbsp + "\n")
    got = {r.key: r.total for r in traffic_totals(read_lines(spark, f"{tmp}/in")).collect()}
    assert got == {"k": 3}


def test_bad_int_fails_without_ansi_too(spark):
    old = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "false")
        df = spark.createDataFrame([(line("k", "2147483648", 1),)], "value string")
        with pytest.raises(Exception, match="not an int"):
            traffic_totals(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_equal_lines_stay_where_they_are(spark):
    from pyspark.sql import functions as F
    from tessera.operators.traffic import traffic_totals
    full = F.concat_ws("\t", F.lit("a"), F.col("id") % 3, *[F.lit("x")] * 6, F.lit("1"), F.lit("2"))
    lines = spark.range(0, 1000, numPartitions=4).select(F.when(F.col("id") % 10 != 0, F.lit("")).otherwise(full).alias("value"))
    plan = traffic_totals(lines)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(value" not in plan
    assert sorted((r.key, r.up, r.down) for r in traffic_totals(lines).collect()) == [("0", 34, 68), ("1", 33, 66), ("2", 33, 66)]
