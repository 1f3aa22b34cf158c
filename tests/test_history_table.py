"""The bucketed history: equal to naive loads, no shuffle of what is stored, counts observed while writing."""

import os

import pytest
from pyspark.sql import functions as F

from spanledger.operators import change_data as D
from spanledger.operators.audit import LOG_SCHEMA
from spanledger.plans import requests as R
from spanledger.scale import SkewPolicy
from spanledger.sources.fixtures import empty_history
from spanledger.sources.history_table import HistoryTable
from tests.conftest import PLAIN, SPLIT
from tests.test_history import FEED, T0, at, change, naive_load, random_feed, versions


def staged(spark, rows):
    return D.stage_new_changes(spark.createDataFrame(rows, FEED), None)


@pytest.mark.parametrize("seed,late,policy", [(1, False, PLAIN), (2, True, PLAIN), (3, False, SPLIT), (4, True, SPLIT)])
def test_loads_equal_naive_ones(spark, tmp_path, seed, late, policy):
    first, second = random_feed(seed, late)
    table = HistoryTable(spark, f"{tmp_path}/h", buckets=4, policy=policy)
    table.load(staged(spark, first))
    assert versions(table.read()) == naive_load([], first)
    # another number of buckets from now on
    table = HistoryTable(spark, f"{tmp_path}/h", buckets=3, policy=policy)
    table.load(staged(spark, second))
    assert versions(table.read()) == naive_load(naive_load([], first), second)
    table.load(staged(spark, second))
    assert versions(table.read()) == naive_load(naive_load([], first), second)
    # the newest and the one before it
    assert sorted(os.listdir(f"{tmp_path}/h")) == ["version=2-buckets=3", "version=3-buckets=3"]


def test_late_change_is_settled_by_a_later_load(spark, tmp_path):
    table, history = HistoryTable(spark, str(tmp_path), buckets=4), empty_history(spark)
    loads = [
        [change(1, "accepted", "I", 0), change(1, "paused", "U", 4), change(1, "executed", "U", 6)],
        [change(1, "executed", "U", 2), change(1, "executed", "U", 4.5)],
        [change(2, "accepted", "I", 7)],
    ]
    for rows in loads:
        stage = staged(spark, rows)
        history = spark.createDataFrame(D.load_history(history, stage).history.collect(), history.schema)
        table.load(stage)
    assert versions(table.read()) == versions(history)


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    table = HistoryTable(spark, f"{tmp_path}/h", buckets=4)
    first, second = random_feed(5)
    table.load(staged(spark, first))
    plan = table.merged(staged(spark, second))._jdf.queryExecution().executedPlan().toString()
    # the batch once, to the buckets; the join kinds of the two-pass load are gone
    assert plan.count("Exchange") == 1 and "hashpartitioning(hash_key" in plan and "Join" not in plan
    assert plan.count("Bucketed: true") == 1
    table.load(staged(spark, second))
    for changed in table.changed(staged(spark, second)):
        plan = changed._jdf.queryExecution().executedPlan().toString()
        for scan in plan.split("FileScan")[1:]:
            assert "Bucketed: true" in scan or "hash_key" not in scan.split("[")[1] or "Bucketed: false" not in scan


def test_steps_checks_and_log(spark, tmp_path):
    first = [change(1, "accepted", "I", 0), change(1, "complited", "U", 1), change(3, "paused", "I", 1)]
    second = [change(1, "executed", "U", 2), change(1, "paused", "D", 3), change(1, None, "D", 4), change(2, "x", "U", 2)]
    table, plain = HistoryTable(spark, f"{tmp_path}/h", buckets=2, log=f"{tmp_path}/log"), empty_history(spark)
    for n, rows in enumerate((first, second)):
        load, want = table.load(staged(spark, rows), f"2024-01-0{n + 1} 00:00:00"), D.load_history(plain, staged(spark, rows))
        assert sorted(map(tuple, load.steps.collect())) == sorted(map(tuple, want.steps.collect()))
        plain = spark.createDataFrame(want.history.collect(), plain.schema)
        assert versions(table.read()) == versions(plain)
    found = {r.check_name: r.n for r in load.checks.collect()}
    assert found == {"check_new_status": 0, "check_update_finished": 1, "check_delete_unfinished": 1, "check_unknown_entity": 1}
    log = [r for r in spark.read.schema(LOG_SCHEMA).parquet(f"{tmp_path}/log").orderBy("id").collect()]
    messages = [r.message for r in log if r.stamp.day == 2]
    assert {"start", "stop", "changes of known entities", "check_unknown_entity"} <= set(messages)
    # inserts of nothing and checks that found nothing leave no row
    assert "new entities" not in messages and "check_new_status" not in messages
    assert len({r.id for r in log}) == len(log)


def test_a_failed_load_leaves_the_table(spark, tmp_path):
    table = HistoryTable(spark, f"{tmp_path}/h", buckets=2)
    table.load(staged(spark, [change(1, "accepted", "I", 0)]))
    with pytest.raises(Exception, match="same stamp"):
        table.load(staged(spark, [change(1, "paused", "U", 1), change(1, "executed", "U", 1)]))
    assert table.version() == 1 and [v[1] for v in versions(table.read())] == ["accepted"]
    table.load(staged(spark, [change(1, "paused", "U", 1)]))
    assert [v[1] for v in versions(table.read())] == ["accepted", "paused"]


def test_empty_tables_and_null_keys(spark, tmp_path):
    table = HistoryTable(spark, f"{tmp_path}/h", buckets=2)
    assert table.read().count() == 0 and table.version() == 0
    table.load(staged(spark, [change(1, "accepted", "I", 0)]).limit(0))
    assert table.read().count() == 0
    stage = staged(spark, [change(1, "accepted", "I", 0), change(2, "paused", "U", 1)]).withColumn("hash_key", F.lit(None).cast("binary"))
    assert versions(D.merge_load(empty_history(spark), stage)) == versions(D.load_history(empty_history(spark), stage).history)


@pytest.mark.parametrize("late", [False, True])
def test_kept_up_mart_equals_a_rebuild(spark, tmp_path, late):
    first, second = random_feed(7, late)
    hours = [[(c[0], c[1], T0, at(c[5].hour * 24), c[4], at((c[5] - T0).seconds // 3600 * 30)) for c in rows] for rows in (first, second)]
    table = HistoryTable(spark, f"{tmp_path}/h", buckets=3, policy=SkewPolicy())
    table.load(staged(spark, hours[0]))
    totals = spark.createDataFrame(R.step_totals(R.history_day_grain(table.read())).collect(), "day date, measure string, step long")
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-03', DATE '2024-01-14')) AS date_actual")
    from spanledger.operators.calendar import dim_date

    table.load(staged(spark, hours[1]))
    before, after = table.changed(staged(spark, hours[1]))
    kept = R.keep_up_steps(totals, R.history_day_grain(before), R.history_day_grain(after))
    whole = R.dim_work(dim_date(days, [], []), R.history_day_grain(table.read()))
    got = R.work_from_steps(dim_date(days, [], []), kept)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
