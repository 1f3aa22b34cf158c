"""Splitting of hot keys changes the plan, never the result."""

import random

import pytest
from pyspark.sql import functions as F

from spanledger.operators.intervals import coalesce_intervals, merge_flagged, next_value
from spanledger.operators.ranking import row_number_by, surrogate_key
from spanledger.scale import SkewPolicy, hot_keys, salted_join
from spanledger.sources.tables import update_from
from tests.conftest import PLAIN, SPLIT


def rows(seed=1, n=200):
    r = random.Random(seed)
    return [(r.choice(["a", "a", "a", "b", None]), r.randrange(5), i) for i in range(n)]


def test_hot_list_is_bounded(spark):
    df = spark.createDataFrame([(i % 50, i) for i in range(1000)], "k int, v int")
    assert hot_keys(df, ["k"], SkewPolicy(hot_rows=5)).count() == 50
    assert hot_keys(df, ["k"], SkewPolicy(hot_rows=5, share=49)).count() == 0
    assert hot_keys(df, ["k"], SkewPolicy(hot_rows=5, share=51)).count() == 50
    assert hot_keys(df, ["k"], SkewPolicy(hot_rows=1000)) is None
    assert {r._pieces for r in hot_keys(df, ["k"], SkewPolicy(hot_rows=3)).collect()} == {7}


def test_salted_join_kinds(spark):
    left = spark.createDataFrame(rows(), "k string, w int, id int")
    right = spark.createDataFrame([("a", 1), ("a", 3), ("c", 9)], "k string, x int")
    for how in ["inner", "left", "left_semi", "left_anti"]:
        for residual in [None, F.col("w") < F.col("x")]:
            plain, split = (
                sorted(map(repr, salted_join(left, right, ["k"], residual, how, p).collect())) for p in (PLAIN, SPLIT)
            )
            assert plain == split


def test_row_number_is_total_and_equal_in_both_plans(spark):
    df = spark.createDataFrame(rows(), "k string, w int, id int")
    plain, split = (
        sorted(map(repr, row_number_by(df, ["k"], "w", "n", policy=p).collect())) for p in (PLAIN, SPLIT)
    )
    assert plain == split
    numbers = {}
    for r in row_number_by(df, ["k"], "w", "n", policy=SPLIT).collect():
        numbers.setdefault(r.k, []).append((r.w, r.n))
    for found in numbers.values():
        found.sort(key=lambda x: x[1])
        assert [n for _, n in found] == list(range(1, len(found) + 1))
        assert [w for w, _ in found] == sorted(w for w, _ in found)


def test_row_number_counts_copies(spark):
    df = spark.createDataFrame([("a", 1)] * 9 + [("a", 0)], "k string, w int")
    got = sorted(r.n for r in row_number_by(df, ["k"], "w", "n", policy=SPLIT).collect())
    assert got == list(range(1, 11))


def test_surrogate_key(spark):
    names = spark.createDataFrame([("b",), ("a",)], "name string")
    old = spark.createDataFrame([(7,)], "id int")
    dense = surrogate_key(names, old, "id", dense=True, order=["name"]).collect()
    assert {r.name: r.id for r in dense} == {"a": 8, "b": 9}
    many = surrogate_key(spark.range(200).withColumn("g", F.col("id") % 3), None, "key", dense=True, order=["g"]).collect()
    assert [(r.g, r.id) for r in sorted(many, key=lambda r: r.key)] == sorted((k % 3, k) for k in range(200))
    assert sorted(r.key for r in many) == list(range(1, 201))
    loose = surrogate_key(names, None, "id", dense=False).collect()
    assert len({r.id for r in loose}) == 2


def test_very_many_copies_are_listed_in_ranges(spark, monkeypatch):
    from spanledger.operators import ranking

    monkeypatch.setattr(ranking, "COPIES_PER_TASK", 4)
    df = spark.createDataFrame([("a", 1)] * 11 + [("a", 0), ("b", 5)], "k string, w int")
    got = sorted((r.k, r.w, r.n) for r in row_number_by(df, ["k"], "w", "n", policy=SPLIT).collect())
    assert got == [("a", 0, 1)] + [("a", 1, n) for n in range(2, 13)] + [("b", 5, 1)]


@pytest.mark.parametrize("kind", ["int", "bigint", "date", "timestamp", "timestamp_ntz"])
def test_points_of_any_type_follow_each_other(spark, kind):
    cast = {"int": "at", "bigint": "at", "date": "date_add(date'2024-01-01', at)"}
    value = cast.get(kind, f"cast(timestamp'2024-01-01' + make_interval(0, 0, 0, 0, at) AS {kind})")
    points = spark.createDataFrame([("a", n) for n in (1, 2, 9, 10, 11, 100, -5)] + [("b", 3)], "k string, at int")
    df = points.selectExpr("k", f"CAST({value} AS {kind}) AS at")
    plain, split = (sorted(map(repr, next_value(df, ["k"], "at", "n", p).collect())) for p in (PLAIN, SkewPolicy(hot_rows=2, slot_width=4)))
    assert plain == split
    spans = df.filter("k = 'a'").selectExpr("k", "at AS s", "at AS e")
    plain, split = (
        sorted(map(repr, coalesce_intervals(spans, ["k"], "s", "e", p).collect())) for p in (PLAIN, SkewPolicy(hot_rows=2, slot_width=4))
    )
    assert plain == split


def test_other_types_are_refused_at_any_size(spark):
    df = spark.createDataFrame([("a", "x")], "k string, at string")
    for policy in (PLAIN, SPLIT):
        with pytest.raises(TypeError):
            next_value(df, ["k"], "at", "n", policy)


def test_equal_digests_are_told_apart(spark):
    df = spark.createDataFrame([("k", 1, "a|b", "c"), ("k", 1, "a", "b|c"), ("k", 1, "~", None), ("k", 1, None, "~")], "k string, w int, x string, y string")
    plain, split = (sorted(map(repr, row_number_by(df, ["k"], "w", "n", policy=p).collect())) for p in (PLAIN, SPLIT))
    assert plain == split


def test_update_from_refuses_a_key_twice(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k int, v string")
    assert {(r.k, r.v) for r in update_from(target, source, ["k"], ["v"]).collect()} == {(1, "x"), (2, "b"), (None, "c")}
    with pytest.raises(Exception, match="twice"):
        update_from(target, source.union(source), ["k"], ["v"]).collect()


def test_merge_flagged_refuses_open_bounds(spark):
    df = spark.sql("SELECT 'a' AS k, 1 AS w, date'2024-01-01' AS s, CAST(NULL AS date) AS e")
    with pytest.raises(Exception, match="bound"):
        merge_flagged(df, "k", "s", "e", "w").collect()
