"""Per-key traffic totals over tab-separated log lines.

A line counts when it is not blank and has at least ``min_fields`` fields
after Java-style splitting (trailing empty fields do not count).  Field
``key_field`` is the key; fields ``up_field`` and ``down_field`` are 32-bit
ints parsed strictly - a value that is not an int fails the job.  Totals
are BIGINT, so sums past 2**31 - 1 stay exact.

Plan: one scan, projections (each line is split once), and one aggregate
whose partial sums are computed in each map task, so a key holding a third
of all lines still leaves every map task as a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.functions.parse import not_blank, split_fields, strict_int


def _parse_all(lines: DataFrame, line_col: str = "value", key_field: int = 1,
               up_field: int = 8, down_field: int = 9, min_fields: int = 10,
               sep: str = "\t") -> DataFrame:
    """Every line with ``counted`` (1 or 0); key and values are NULL for lines
    that do not count, so their fields are never parsed."""
    v = F.col(line_col)
    split = lines.select(not_blank(v).alias("nb"), split_fields(v, sep).alias("f"))
    f = F.col("f")
    checked = split.select("f", (F.col("nb") & (F.size(f) >= min_fields)).alias("ok"))
    ok = F.col("ok")
    return checked.select(
        F.when(ok, F.get(f, key_field)).alias("key"),
        F.when(ok, strict_int(F.get(f, up_field), f"field {up_field}")).alias("up"),
        F.when(ok, strict_int(F.get(f, down_field), f"field {down_field}")).alias("down"),
        ok.cast("int").alias("counted"))


def parse_traffic(lines: DataFrame, **parse_options) -> DataFrame:
    """``(key string, up int, down int)`` per counted line."""
    return _parse_all(lines, **parse_options).where(F.col("counted") == 1).drop("counted")


def traffic_totals(lines: DataFrame, **parse_options) -> DataFrame:
    """``(key, up, down, total)`` with BIGINT sums per key.

    Lines that do not count are not filtered out row by row: they fall into
    one NULL-key group (reduced to a row per map task by the partial
    aggregate) that is dropped after the aggregate.  A row filter would be
    pushed below the projections by the optimizer and make every line be
    split twice.
    """
    parsed = _parse_all(lines, **parse_options)
    up, down = F.col("up").cast("long"), F.col("down").cast("long")
    totals = parsed.groupBy("key").agg(F.sum(up).alias("up"), F.sum(down).alias("down"),
                                       F.sum(up + down).alias("total"),
                                       F.max("counted").alias("counted"))
    return totals.where(F.col("counted") == 1).drop("counted")
