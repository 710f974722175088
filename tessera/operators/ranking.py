"""Running sums and positions in a sort order, without a single-task window.

``Window.orderBy(o)`` with no partition, or ``Window.partitionBy(g)`` on a
group holding a third of all rows, puts those rows in one task.  The
helpers here compute the same values in pieces:

1. range-partition on ``(g, o)`` - Spark samples the keys and cuts them into
   ranges of similar size, so a big group spreads over many partitions;
2. tag every row with its range partition (its *piece*) and take running
   sums inside each ``(piece, group)`` - at most one partition's rows;
3. total each ``(piece, group)`` and take, per group, the running sum of
   those totals in piece order - one row per piece, so at most the number
   of range partitions per group (a setting, not the data size);
4. value = offset of the piece + running sum inside the piece.

The tagged rows are checkpointed to the shared checkpoint folder before
steps 2-4 read them twice, so both reads see the same piece tags even
after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.operators.layout import default_parallelism
from tessera.session import checkpoint_dir


def exclusive_prefix_sum(df: DataFrame, order_col: str, value: Column, out_col: str,
                         group_col: str | None = None, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out_col``: the sum of ``value`` over the rows before this
    one in ``order_col`` order (within ``group_col`` when given; NULL is a
    group too).  Rows with equal order values are taken in any order and
    stay in one piece, so the order column should be close to unique."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [group_col] if group_col else []
    tagged = (df.withColumn("_v", value)
                .repartitionByRange(n, *keys, order_col)
                .withColumn("_piece", F.spark_partition_id())
                .checkpoint())
    inside = (Window.partitionBy("_piece", *keys).orderBy(order_col)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = tagged.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0)))
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy("_piece", *keys).agg(F.sum("_v").alias("_t"))
               .withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
               .drop("_t"))
    offsets = offsets.withColumnRenamed("_piece", "_p")
    same = local["_piece"] == offsets["_p"]
    if group_col:
        offsets = offsets.withColumnRenamed(group_col, "_g")
        same = (local["_piece"] == offsets["_p"]) & local[group_col].eqNullSafe(offsets["_g"])
    return (local.join(offsets, same).drop("_p", "_g")
            .withColumn(out_col, F.col("_off") + F.col("_in"))
            .drop("_piece", "_v", "_in", "_off"))


def group_positions(df: DataFrame, group_col: str, order_col: str,
                    partitions: int | None = None, out_col: str = "pos") -> DataFrame:
    """``df`` plus ``out_col``: 0-based position of the row within its group
    when the group is sorted by ``order_col`` (ties in any order)."""
    out = exclusive_prefix_sum(df, order_col, F.lit(1).cast("long"), out_col, group_col, partitions)
    return out.withColumn(out_col, F.col(out_col).cast("long"))


def range_cuts(df: DataFrame, keys: list[str], parts: int, per_part: int = 60) -> list[tuple]:
    """At most ``parts - 1`` increasing cut points of the key tuples, from a
    sample of about ``per_part`` keys a part: bounded by the parts, never by
    the data.  No key may be NULL.  A last key that is a hash of the row lets a
    hot first key span several parts."""
    total = df.count()
    if parts < 2 or not total:
        return []
    picked, share = df.select(*keys), min(1.0, parts * per_part / total)
    if share < 1.0:
        picked = picked.sample(share, seed=23)
    rows = sorted(tuple(r) for r in picked.limit(4 * parts * per_part).collect())
    return sorted({rows[len(rows) * i // parts] for i in range(1, parts)}) if rows else []
