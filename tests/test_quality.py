"""Checks on empty input, on hand-made faults, and against brute force."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from spanledger.operators import quality as Q

SCHEMA = "c int, p string, s date, e date, f boolean"


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def value(df):
    return df.first()[0]


def overlap(a, b):
    return max(a[2], b[2]) < min(a[3], b[3])


def random_rows(seed, n=40):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        s = r.randrange(20)
        rows.append((r.choice([1, 2, 3, None]), r.choice(["x", "y", None]), day(s), day(s + r.randrange(6)), r.random() < 0.5))
    return rows


def test_empty_input(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert value(Q.null_key_count(none, "c")) is None
    assert value(Q.minus_one_key_count(none, "c")) is None
    assert Q.duplicate_keys(none, ["c", "p"]).count() == 0
    assert value(Q.null_count(none, "c")) == 0
    assert Q.history_overlaps(none, ["c", "p"], "s", "e").count() == 0
    assert value(Q.history_gaps(none, ["c", "p"], "s", "e")) is None
    assert value(Q.future_versions(none, "s", F.current_date())) == 0
    assert value(Q.reversed_versions(none, "s", "e")) == 0
    assert value(Q.single_flag_holder(none, "f", "p", "c", "s", "e")) is None
    assert value(Q.duplicate_flag_errors(none, "f", "p", "c", "s", "e")) is None


def test_flagged_row_without_conflict_gives_zero(spark):
    df = spark.createDataFrame([(None, "x", day(0), day(1), True)], SCHEMA)
    assert value(Q.single_flag_holder(df, "f", "p", "c", "s", "e")) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_flag_checks(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)

    def conflict(a, b):
        return a[1] is not None and a[1] == b[1] and None not in (a[0], b[0]) and a[0] != b[0] and overlap(a, b)

    flagged = [r for r in rows if r[4]]
    assert value(Q.single_flag_holder(df, "f", "p", "c", "s", "e")) == sum(conflict(a, b) for a in flagged for b in flagged)
    shared = {(a[1], a[2]) for a in rows for b in rows if conflict(a, b)}
    wrong = max(int(((r[1], r[2]) in shared) != r[4]) for r in rows)
    assert value(Q.duplicate_flag_errors(df, "f", "p", "c", "s", "e")) == wrong
    right = spark.createDataFrame([(*r[:4], (r[1], r[2]) in shared) for r in rows], SCHEMA)
    assert value(Q.duplicate_flag_errors(right, "f", "p", "c", "s", "e")) == 0


@pytest.mark.parametrize("seed", [3, 4])
def test_gaps(spark, seed):
    rows = random_rows(seed)
    groups = {}
    for r in rows:
        groups.setdefault(r[:2], []).append(r[2:4])
    gaps = 0
    for spans in groups.values():
        spans.sort()
        gaps += sum(a[1] != b[0] for a, b in zip(spans, spans[1:]))
    assert value(Q.history_gaps(spark.createDataFrame(rows, SCHEMA), ["c", "p"], "s", "e")) == gaps


def test_gap_with_null_end(spark):
    rows = [(1, "x", day(0), None, True), (1, "x", day(2), day(3), True), (1, "x", day(3), None, True)]
    assert value(Q.history_gaps(spark.createDataFrame(rows, SCHEMA), ["c", "p"], "s", "e")) == 1


def test_overlap_combinations(spark):
    rows = [(1, "x", day(0), day(9), True), (1, "x", day(2), day(3), True), (2, "x", day(0), day(1), True), (None, "x", day(0), day(1), True)]
    got = Q.history_overlaps(spark.createDataFrame(rows, SCHEMA), ["c", "p"], "s", "e").collect()
    assert sorted(r.result for r in got) == [0, 1, 1]


def test_keys_nulls_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 11), (3, 11)], "id int, parent int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert sorted(r.id for r in Q.orphans(child, "parent", parent, "pk").collect()) == [3, 3]
    assert [tuple(r) for r in Q.duplicate_keys(child, ["id"]).collect()] == [(3, 2)]
    assert {r.column_name: r.nulls for r in Q.not_null(child, ["id", "parent"]).collect()} == {"id": 0, "parent": 1}


def test_tagged_difference(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "c"), (3, "c")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "d")], "id int, v string")
    got = sorted(tuple(r) for r in Q.tagged_difference(a, b, ["id", "v"]).collect())
    assert got == [("report", 3, "c"), ("src", 4, "d")]


def test_quality_run_joins_without_broadcast(spark, monkeypatch):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before, seen = spark.conf.get(name), []
    plain = Q.history_overlap_rows

    def watched(*args):
        seen.append(spark.conf.get(name))
        return plain(*args)

    monkeypatch.setattr(Q, "history_overlap_rows", watched)
    rows = [(1, "a", "t", day(0), day(5), False, True, True), (2, "a", "t", day(3), day(9), False, True, True)]
    columns = """mdm_customer_rk long, phone_num string, phone_type_cd string, business_start_dt date, business_end_dt date,
        duplication_flg boolean, main_dup_flg boolean, main_phone_flg boolean"""
    found = dict(Q.quality_run(spark.createDataFrame(rows, columns), F.lit(day(4))).collect())
    assert seen == ["-1"] and spark.conf.get(name) == before
    assert found["check_duplicate_flag"] == 2 and found["check_single_main_customer"] == 2
    assert found["check_history_overlaps"] == 0 and found["check_future_versions"] == 0
