"""How much one task holds and what is shuffled, judged by plans."""

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from spanledger.operators import intervals as iv
from spanledger.operators.change_data import close_and_coalesce
from spanledger.scale import SkewPolicy, found_hot_keys
from spanledger.session import JOINS_IN_PLACE, settings


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_versions_are_dealt_into_bounded_parts(spark):
    at = datetime(2024, 1, 1)
    rows = [(k, k % 3 + day // 2, at + timedelta(days=day), datetime(5999, 1, 1)) for k in range(10) for day in range(4)]
    df = spark.createDataFrame(rows, "k long, v long, valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz")
    dealt = close_and_coalesce(df, "all", ["k"], task_rows=8)
    assert "hashpartitioning(k" in plan(dealt) and ", 5), REPARTITION_BY_NUM" in plan(dealt)
    assert sorted(dealt.collect()) == sorted(close_and_coalesce(df, "all", ["k"]).collect())


def test_segment_lookups_stay_where_they_are(spark, monkeypatch):
    first = date(2024, 1, 1)
    rows = [(k, i % 2, first + timedelta(days=i), first + timedelta(days=i + 5), i) for k in range(4) for i in range(6)]
    df = spark.createDataFrame(rows, "k long, o long, s date, e date, w long")
    with settings(spark, **JOINS_IN_PLACE, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        segs = iv._segment_flags(df, "k", "s", "e", "w", None)
        assert "hashpartitioning(k" in plan(segs) and plan(segs).count("Exchange") <= 4
        assert not any("Exchange" in line and "level" in line for line in plan(segs).splitlines())
        assert segs.count() == 4 * 10
        monkeypatch.setattr(iv, "SPANS_PER_TASK", 6)
        dealt = iv._segment_flags(df, "k", "s", "e", "w", "o")
        assert ", 4), REPARTITION_BY_NUM" in plan(dealt)
        bounded = sorted(dealt.collect())
    assert bounded == sorted(iv._segment_flags(df, "k", "s", "e", "w", "o").collect())


def test_no_hot_key_found(spark):
    df = spark.range(100).select((F.col("id") % 50).alias("k"))
    assert found_hot_keys(df, ["k"], SkewPolicy(hot_rows=3)) is None
    assert found_hot_keys(df, ["k"], SkewPolicy(hot_rows=1)).count() == 50


def test_overlaps_are_classified_after_one_shuffle(spark, monkeypatch):
    at = datetime(2024, 1, 1)
    rows = [(k, at + timedelta(hours=i), at + timedelta(hours=i + 1 + k * i % 5)) for k in range(10) for i in range(4)]
    df = spark.createDataFrame(rows, "k long, a timestamp_ntz, b timestamp_ntz")
    found = iv.overlap_classify(df, ["k"], "a", "b")
    assert plan(found).count("Exchange") == 1 and "Join" not in plan(found)
    monkeypatch.setattr(iv, "SPANS_PER_TASK", 8)
    dealt = iv.overlap_classify(df, ["k"], "a", "b")
    assert "hashpartitioning(k" in plan(dealt) and ", 5), REPARTITION_BY_NUM" in plan(dealt)
    assert sorted(dealt.collect()) == sorted(found.collect())
