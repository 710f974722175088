"""Scan layout for tables stored as few large row groups.

Parquet splits a file no finer than its row groups, so a table written as one
row group is read by one task.  ``scan_spread`` re-deals such a scan by a key
before CPU-heavy per-row work.  It does so only when the caller's session asks
for it with ``spark.tessera.scanPartitions`` (a task count); without that
setting a scan keeps its splits, which at scale are many.  The same setting
always gives the same plan, whatever the size of the input.

The keys must identify rows well (a document or order id), so that equal lines
or values don't meet in one task; it is used on scans only, never ahead of a
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SCAN_PARTITIONS = "spark.tessera.scanPartitions"


def default_parallelism(spark) -> int:
    """Cores of the cluster, or the shuffle width where that is not exposed."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # sessions without a SparkContext (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scan_spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df``, hash-partitioned on ``keys`` when the session says so."""
    n = df.sparkSession.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(n), *keys) if n else df
