import pytest
from pyspark.sql import functions as F

from tessera.operators.placement import assign_slots, batch_index, place_by_slot, slot_count, spread


def test_slot_table(spark):
    keys = spark.createDataFrame([(0, 0), (0, 2), (0, 1), (1, 0), (2, 1), (2, 0)], "part_id int, batch int")
    idx = {r.part_id: (r.max_batch, r.slot_offset) for r in batch_index(keys).collect()}
    assert idx == {0: (2, 0), 1: (0, 3), 2: (1, 4)}
    assert slot_count(batch_index(keys)).first().n_slots == 6
    probe = spark.createDataFrame([(1, 7), (0, 2), (2, 1)], "part_id int, batch int")
    got = {(r.part_id, r.batch): r.slot for r in assign_slots(probe, batch_index(keys)).collect()}
    assert got == {(1, 7): 3, (0, 2): 2, (2, 1): 5}


def test_unknown_partition_raises(spark):
    keys = spark.createDataFrame([(0, 0)], "part_id int, batch int")
    probe = spark.createDataFrame([(9, 0)], "part_id int, batch int")
    with pytest.raises(Exception, match="not in the slot index"):
        assign_slots(probe, batch_index(keys)).collect()


def test_place_by_slot_one_slot_per_task(spark):
    keys = spark.createDataFrame([(p, b) for p in range(3) for b in range(p + 1)], "part_id int, batch int")
    slotted = assign_slots(keys, batch_index(keys))
    n = slot_count(batch_index(keys)).first().n_slots
    placed = place_by_slot(slotted, n).withColumn("pid", F.spark_partition_id())
    assert all(r.pid == r.slot for r in placed.collect())
    assert spread(keys, 4).rdd.getNumPartitions() == 4


def test_prefix_sum_over_many_pieces(spark):
    from tessera.operators.ranking import exclusive_prefix_sum
    df = spark.createDataFrame([(i, i % 3) for i in range(200)], "k int, v int")
    got = {r.k: r.off for r in exclusive_prefix_sum(df, "k", F.col("v").cast("long"), "off", partitions=7).collect()}
    run = 0
    for i in range(200):
        assert got[i] == run
        run += i % 3


def test_sized_conf_scales():
    from tessera.session import sized_conf
    small = sized_conf(40 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    big = sized_conf(100 << 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20


def test_prefix_sum_keeps_a_null_group(spark):
    from pyspark.sql import functions as F
    from tessera.operators.ranking import exclusive_prefix_sum, group_positions
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "g string, o int")
    got = sorted((str(r.g), r.o, r.s) for r in exclusive_prefix_sum(df, "o", F.col("o").cast("long"), "s", "g").collect())
    assert got == [("None", 3, 0), ("None", 4, 3), ("a", 1, 0), ("a", 2, 1)]
    assert group_positions(df, "g", "o").columns == ["g", "o", "pos"]
