"""Batch slots: place (partition, batch) keys on consecutive task slots.

Each partition ``p`` with largest batch ``m_p`` gets ``m_p + 1`` slots; the
first slot of ``p`` is the sum of ``m + 1`` over the partitions before it
(ascending partition order).  A key ``(p, b)`` goes to slot
``offset(p) + b % (m_p + 1)``.  A key whose partition is not in the index
fails the job.

The running offsets come from ``ranking.exclusive_prefix_sum``, which never
orders all partition ids in one task, so the index may be as large as the
data makes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessera.operators.ranking import exclusive_prefix_sum
from tessera.session import checkpoint_dir

BROADCAST_ROWS = 1_000_000  # rows of three numbers: some tens of megabytes


def batch_index(keys: DataFrame, part_col: str = "part_id", batch_col: str = "batch") -> DataFrame:
    """``(part_id, max_batch, slot_offset)``, one row per partition."""
    m = keys.groupBy(F.col(part_col).alias("part_id")).agg(F.max(batch_col).alias("max_batch"))
    with_offset = exclusive_prefix_sum(m, "part_id", (F.col("max_batch") + 1).cast("long"), "slot_offset")
    return with_offset.select("part_id", "max_batch", F.col("slot_offset").cast("int").alias("slot_offset"))


def slot_count(index: DataFrame) -> DataFrame:
    """One row: ``n_slots`` = sum of ``max_batch + 1``."""
    return index.agg(F.sum(F.col("max_batch") + 1).cast("int").alias("n_slots"))


def assign_slots(keys: DataFrame, index: DataFrame, part_col: str = "part_id",
                 batch_col: str = "batch") -> DataFrame:
    """``keys`` plus a ``slot`` column; unknown partitions raise.

    The index has a row a partition, but its estimated size follows the keys
    it was made from.  So it is checkpointed and counted: up to
    ``BROADCAST_ROWS`` rows of three numbers it is broadcast, and the keys are
    not shuffled; a larger one is joined as Spark sees fit.  The result is the
    same either way.
    """
    idx = index.select(F.col("part_id").alias("_p"), "max_batch", "slot_offset")
    checkpoint_dir(keys.sparkSession)
    idx = idx.checkpoint()
    if idx.count() <= BROADCAST_ROWS:
        idx = F.broadcast(idx)
    j = keys.join(idx, keys[part_col] == idx["_p"], "left")
    missing = F.raise_error(F.concat(F.lit("partition not in the slot index: "),
                                     F.col(part_col).cast("string")))
    slot = F.when(F.col("_p").isNull(), missing.cast("int")).otherwise(
        F.col("slot_offset") + F.col(batch_col) % (F.col("max_batch") + 1))
    return j.withColumn("slot", slot).drop("_p", "max_batch", "slot_offset")


def place_by_slot(df: DataFrame, n_slots: int, slot_col: str = "slot") -> DataFrame:
    """One task per slot: row with slot ``s`` lands in partition ``s``."""
    return df.repartitionById(n_slots, F.col(slot_col))


def spread(df: DataFrame, n_tasks: int) -> DataFrame:
    """Spread a work list evenly over ``n_tasks`` tasks (round robin)."""
    return df.repartition(n_tasks)


def slots_by_size(df: DataFrame, size_col: str, key_col: str, n_slots: int) -> DataFrame:
    """``df`` plus ``slot``: the rows, largest first, dealt to ``n_slots`` slots
    in turns.

    The rank by size (NULL counts as 0, ties by ``key_col``) is a distributed
    prefix sum over a range sort, so no task orders all rows.  Sizes fall along
    the ranks; so the row that slot 0 gets in a turn is at most as large as the
    one that any other slot got in the turn before, and no two slots differ by
    more than the largest row: the fullest slot holds at most the mean plus the
    largest size."""
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    order = F.struct((-size).alias("size"), F.col(key_col).alias("key"))
    ranked = exclusive_prefix_sum(df.withColumn("_order", order), "_order", F.lit(1).cast("long"), "_rank")
    return ranked.withColumn("slot", F.pmod(F.col("_rank"), F.lit(n_slots)).cast("int")).drop("_order", "_rank")
