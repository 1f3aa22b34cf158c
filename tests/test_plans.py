"""Shapes the plans must not have: loops over pairs of rows, or a window over the whole of a large table."""

import pytest
from pyspark.sql import functions as F

from spanledger.operators import change_data as D
from spanledger.operators import intervals as iv
from spanledger.operators import quality as Q
from spanledger.operators.ranking import row_number_by
from spanledger.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def operators(spark, policy):
    rows = X.phone_rows(spark, SF).filter("mdm_customer_rk is not null")
    s, e, keys = "business_start_dt", "business_end_dt", ["phone_num"]
    feed = X.feed(spark, SF)
    stage = D.stage_new_changes(feed, None)
    known = D.history_keys(X.empty_history(spark).unionByName(D.insert_new(stage, X.empty_history(spark))))
    yield "fragment", iv.fragment(rows, keys, s, e, policy)
    yield "segment_stats", iv.segment_stats(rows, keys, s, e, [F.max("mdm_customer_rk").alias("m")], policy)
    yield "coalesce_intervals", iv.coalesce_intervals(rows, keys, s, e, policy)
    yield "best_in_overlap", iv.best_in_overlap(rows, keys, s, e, "mdm_customer_rk", "best", policy)
    yield "other_owner_overlap", iv.other_owner_overlap(rows, "phone_num", "mdm_customer_rk", s, e)
    yield "overlap_classify", iv.overlap_classify(rows, keys, s, e)
    yield "overlap_conflicts", iv.overlap_conflicts(rows, "phone_num", "mdm_customer_rk", s, e)
    yield "row_number_by", row_number_by(rows, keys, s, "n", policy=policy)
    yield "temporal_join", iv.temporal_join(
        X.contacts(spark, SF), X.cross_reference(spark, SF), {"counterparty_rk": "counterparty_rk"}
    )
    yield "null_aware_anti", D.stage_new_changes(feed, stage)
    yield "capture_changes", D.capture_changes(
        X.old_snapshot(spark, SF), X.new_snapshot(spark, SF), ["o_orderkey"], F.lit("2024-01-01").cast("timestamp_ntz")
    )
    yield "insert_changes", D.insert_changes(stage, known)
    yield "close_and_coalesce", D.close_and_coalesce(D.insert_changes(stage, known), policy=policy)
    yield "tagged_difference", Q.tagged_difference(feed, feed, ["id", "stamp"])


def test_no_pair_loops_and_no_whole_table_windows(spark, policy):
    for name, df in operators(spark, policy):
        plan = plan_of(df)
        for shape in ["BroadcastNestedLoopJoin", "CartesianProduct", "Exchange SinglePartition", "Python"]:
            assert shape not in plan, f"{name}: {shape}"


def test_hot_list_is_the_only_hinted_broadcast(spark):
    from tests.conftest import SPLIT

    rows = X.phone_rows(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(iv.fragment(rows, ["phone_num"], "business_start_dt", "business_end_dt", SPLIT))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the list is bounded by each key's share of all rows, not by a cap
    assert plan.count("BroadcastExchange") <= 2 and "TakeOrderedAndProject" not in plan and "Limit" not in plan
    assert "SortMergeJoin" in plan


def test_global_islands_window_sees_one_row_per_day(spark):
    rows = X.phone_rows(spark, SF).filter("business_start_dt <= business_end_dt")
    plan = plan_of(iv.coalesce_intervals_global(rows, ["phone_num"], "business_start_dt", "business_end_dt"))
    window = plan.index("Window")
    below = plan[window:]
    assert "SinglePartition" in below and below.index("SinglePartition") < below.index("HashAggregate")
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("column", ["value", "props"])
def test_scan_reads_only_needed_columns(spark, column):
    plan = plan_of(X.feed(spark, SF))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all(f"{column}:" not in line for line in schemas)


def test_calendar_bounds_reach_the_scan(spark, tmp_path):
    path = f"{tmp_path}/rows"
    X.phone_rows(spark, SF).write.parquet(path)
    days = X.event_calendar_days(spark, SF)
    joined = iv.range_join_days(spark.read.parquet(path), days, "date_actual", "business_start_dt", "business_end_dt")
    pushed = next(line for line in plan_of(joined).splitlines() if "PushedFilters" in line)
    assert "LessThanOrEqual(business_start_dt" in pushed
