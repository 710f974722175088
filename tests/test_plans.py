"""Plan properties the scale design relies on (see PLANS.md)."""

import re

import pytest

from tessera.plans import catalog

DATA = "/root/testdata/sf0.001"


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = executed(catalog.QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scans(spark):
    plan = executed(catalog.QUERIES["avg_rate_by_attr"](spark, DATA))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(l_partkey,1616\)", plan)
    plan = executed(catalog.QUERIES["stacked_filters"](spark, DATA))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(c_acctbal,1000.0\), LessThan\(c_acctbal,2000.0\)", plan)
    assert "ReadSchema: struct<c_name:string,c_acctbal:double>" in plan


def test_long_form_sums_map_side(spark):
    plan = executed(catalog.QUERIES["term_counts"](spark, DATA)).splitlines()
    keyed = [i for i, l in enumerate(plan) if "Exchange hashpartitioning(word" in l]
    assert len(keyed) == 1 and "partial_sum" in plan[keyed[0] + 1]


def test_postings_with_counts_move_once(spark):
    plan = executed(catalog.QUERIES["inverted_index_counts"](spark, DATA))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1


@pytest.mark.parametrize("name", ["top_titles_for_segment", "top_titles_of_top_user"])
def test_user_filter_below_the_fact_join(spark, name):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    depth = lambda l: len(l) - len(l.lstrip(" :+-"))
    semi = [depth(l) for l in plan if "LeftSemi" in l]
    fact = [depth(l) for l in plan if re.search(r"Join Inner, .*linkid", l)]
    assert semi and fact and max(semi) > min(fact) and min(semi) > min(fact)


def test_slots_leave_the_keys_in_place(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        plan = executed(catalog.QUERIES["batch_slots"](spark, DATA))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning(part_id" not in plan and "BroadcastHashJoin" in plan


def test_manifest_scans(spark):
    for name, most in (("parent_folders", 1), ("folder_sizes", 1), ("file_sizes", 2)):
        assert executed(catalog.QUERIES[name](spark, DATA)).split("== Initial Plan ==")[0].count("FileScan") <= most, name


def test_paths_are_reduced_before_the_join(spark):
    for name in ("path_sizes", "path_first_times"):
        plan = executed(catalog.QUERIES[name](spark, DATA)).split("== Initial Plan ==")[0]
        assert plan.index("Join") < plan.index("partial_"), name


def test_posting_lists_one_aggregate_shuffle(spark):
    plan = executed(catalog.QUERIES["inverted_index"](spark, DATA))
    assert len(re.findall(r"Exchange hashpartitioning\(word", plan)) == 1


def test_ratings_aggregated_per_movie_before_title_join(spark):
    plan = executed(catalog.QUERIES["top_titles_for_segment"](spark, DATA))
    title_join = plan.index("[movieid")
    assert "keys=[movieid" in plan[title_join:]


def test_except_shuffles_only_partial_aggregates(spark):
    # every shuffle of the set difference carries de-duplicated keys, never raw rows
    plan = executed(catalog.QUERIES["set_difference"](spark, DATA)).splitlines()
    exchanges = [i for i, l in enumerate(plan) if "Exchange hashpartitioning" in l]
    assert exchanges
    for i in exchanges:
        assert "HashAggregate" in plan[i + 1]
    assert any("LeftAnti" in l for l in plan)


def test_traffic_shuffles_partial_sums_only(spark):
    plan = executed(catalog.QUERIES["traffic_totals"](spark, DATA)).splitlines()
    keyed = [i for i, l in enumerate(plan) if "Exchange hashpartitioning(key" in l]
    assert len(keyed) == 1 and "partial_sum" in plan[keyed[0] + 1]
