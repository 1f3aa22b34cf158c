"""Shared layouts: the quality run, joins of keys hot on both sides, replaced partitions."""

import glob
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanledger.operators import intervals as iv
from spanledger.operators import quality as Q
from spanledger.scale import SkewPolicy
from spanledger.sources.tables import replace_partitions

COLUMNS = (
    "mdm_customer_rk long, phone_num string, phone_type_cd string, business_start_dt date, business_end_dt date, "
    "duplication_flg boolean, main_dup_flg boolean, main_phone_flg boolean"
)
DAY = date(2024, 1, 1)


def phones(seed, n=60):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        start = DAY + timedelta(days=r.randint(0, 30))
        rows.append((r.choice([1, 2, 3, -1, None]), r.choice(["a", "b", "c"]), r.choice("xy"), start,
                     start + timedelta(days=r.randint(-2, 12)), *[r.choice([True, False]) for _ in range(3)]))
    return rows + rows[:4]


def plain_counts(rows, as_of):
    def meet(p, q):
        return max(p[3], q[3]) < min(p[4], q[4])

    def related(p, q):
        (a, b), (c, d) = p[3:5], q[3:5]
        same = p[0] is not None and p[0] == q[0] and p[1] == q[1]
        return same and (a < c and d <= b or c < a and b <= d or a < c < b < d or c < a < d < b)

    def conflicts(flag, key, owner):
        held = [p for p in rows if p[flag]]
        return sum(p[key] == q[key] and None not in (p[key], p[owner], q[owner]) and p[owner] != q[owner] and meet(p, q) for p in held for q in held)

    keys = [(p[0], p[2], p[3], p[1]) for p in rows]
    shared = {(p[1], p[3]) for p in rows for q in rows if p[1] == q[1] and None not in (p[0], q[0]) and p[0] != q[0] and meet(p, q)}
    gaps = 0
    for key in {(p[0], p[1]) for p in rows}:
        own = sorted(p[3:5] for p in rows if (p[0], p[1]) == key)
        gaps += sum(b[0] != a[1] for a, b in zip(own, own[1:]))
    return {
        "check_null_key": sum(p[0] is None for p in rows), "check_minus_one_key": sum(p[0] == -1 for p in rows),
        "check_attribute_filled": sum(p[0] is None for p in rows), "check_future_versions": sum(p[3] > as_of for p in rows),
        "check_reversed_versions": sum(p[3] > p[4] for p in rows), "check_duplicate_key": sum(keys.count(k) > 1 for k in set(keys)),
        "check_history_overlaps": len({(p[0], p[1], p[3], p[4]) for p in rows if any(related(p, q) for q in rows)}),
        "check_history_gaps": gaps, "check_single_main_customer": conflicts(6, 1, 0), "check_single_best_phone": conflicts(7, 0, 1),
        "check_duplicate_flag": sum(p[5] != ((p[1], p[3]) in shared) for p in rows),
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_run(spark, seed):
    rows, as_of = phones(seed), DAY + timedelta(days=20)
    got = Q.quality_run(spark.createDataFrame(rows, COLUMNS), F.lit(as_of))
    assert {r.check_name: r.result for r in got.collect()} == plain_counts(rows, as_of)
    empty = Q.quality_run(spark.createDataFrame([], COLUMNS), F.lit(as_of))
    assert {r.result for r in empty.collect()} == {0} and empty.count() == 11


def test_checks_read_their_layout_in_place(spark):
    layout = Q._layout(spark.createDataFrame(phones(3), COLUMNS), "phone_num", "business_start_dt")
    keys, bounds = ["mdm_customer_rk", "phone_num"], ["business_start_dt", "business_end_dt"]
    same_key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(same_key)
    spark.conf.set(same_key, "false")
    try:
        for check in (
            Q.duplicate_keys(layout, [*keys, bounds[0]]),
            Q.history_overlap_rows(layout, keys, *bounds),
            Q.history_gaps(layout, keys, *bounds),
            Q.duplicate_flag_rows(layout, "duplication_flg", "phone_num", "mdm_customer_rk", *bounds),
            iv.overlap_conflicts(layout.filter("main_dup_flg"), "phone_num", "mdm_customer_rk", *bounds),
        ):
            plan = check._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan and "hashpartitioning" not in plan
    finally:
        spark.conf.set(same_key, before)


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz"])
@pytest.mark.parametrize("closed", [True, False])
def test_keys_hot_on_both_sides(spark, kind, closed):
    r = random.Random(7)
    step = timedelta(days=1) if kind == "date" else timedelta(hours=5)
    zero = DAY if kind == "date" else datetime(2024, 1, 1)

    def rows(n):
        out = []
        for _ in range(n):
            start = zero + step * r.randint(0, 300)
            end = r.choice([start + step * r.randint(-1, 40), start, zero.replace(year=2999)])
            out.append((r.choice([1, 1, 1, 2, None]), start, end, r.randint(0, 99)))
        return out + [(1, None, zero, 5), (1, zero, None, 6)]

    schema = f"k int, effective_from_date {kind}, effective_to_date {kind}, v int"
    left = spark.createDataFrame(rows(60), schema)
    right = spark.createDataFrame(rows(50), schema).withColumnsRenamed({"v": "w", "k": "k2"})
    plain, cut = (
        sorted(map(repr, iv.temporal_join(left, right, {"k": "k2"}, keep_right=["w"], closed=closed, policy=p).collect()))
        for p in (SkewPolicy(), SkewPolicy(hot_rows=5))
    )
    assert plain == cut and len(plain) > 100


def test_replaced_partitions(spark, tmp_path):
    target = f"{tmp_path}/t"
    rows = [(k % 4, k) for k in range(40)]
    spark.createDataFrame(rows, "p int, v int").write.partitionBy("p").parquet(target)
    before = {p: sorted(glob.glob(f"{target}/p={p}/*.parquet")) for p in range(4)}
    new = spark.createDataFrame([(1, 100), (7, 7)], "p int, v int")
    replace_partitions(new, target, ["p"], touched=spark.createDataFrame([(1,), (2,), (7,)], "p int"))
    after = {p: sorted(glob.glob(f"{target}/p={p}/*.parquet")) for p in range(4)}
    assert after[0] == before[0] and after[3] == before[3] and after[1] != before[1]
    got = sorted((r.p, r.v) for r in spark.read.parquet(target).collect())
    assert got == sorted([*[x for x in rows if x[0] in (0, 3)], (1, 100), (7, 7)])
