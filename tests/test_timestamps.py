"""Overlap tests and whole-table islands on timestamps, against plain loops, with and without slots."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanledger.operators import intervals as iv

T0 = datetime(2024, 3, 1)
SCHEMA = "k string, owner int, a timestamp_ntz, b timestamp_ntz"


def periods(seed, n=60, reversed_too=True):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        start = T0 + timedelta(minutes=r.randint(0, 600), microseconds=r.choice([0, 1]))
        rows.append((r.choice("xy"), r.choice([1, 2, 3, None]), start, start + timedelta(minutes=r.randint(-20 if reversed_too else 0, 90))))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("equal", [False, True])
def test_overlap_classify(spark, policy, seed, equal):
    rows = periods(seed)
    got = iv.overlap_classify(spark.createDataFrame(rows, SCHEMA), ["k"], "a", "b", equal, policy)
    want = set()
    for k, _, a, b in set((r[0], None, r[2], r[3]) for r in rows):
        others = [(c, d) for i, (x, _, c, d) in enumerate(rows) if x == k]
        outside = any(a < c and d <= b for c, d in others)
        inside = any(c < a and b <= d for c, d in others)
        if equal:
            twin = others.count((a, b)) > 1
            outside = outside or twin or any(c == a and d < b for c, d in others)
            inside = inside or twin or any(c == a and d > b for c, d in others)
        right, left = any(a < c < b < d for c, d in others), any(c < a < d < b for c, d in others)
        want.add((k, a, b, outside, inside, right, left))
    assert set(map(tuple, got.collect())) == want


def test_point_numbers(spark, policy):
    points = sorted({(r[0], r[2]) for r in periods(3)})
    df = spark.createDataFrame(points, "k string, a timestamp_ntz")
    got = {(r.k, r.a): r.n for r in iv.point_numbers(df, ["k"], "a", "n", policy).collect()}
    assert got == {(k, a): 1 + sum(x == k and y < a for x, y in points) for k, a in points}


@pytest.mark.parametrize("seed", [4, 5])
def test_whole_table_islands(spark, policy, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(80):
        start = T0 + timedelta(minutes=r.randint(0, 3000))
        rows.append((r.choice("xyz"), 1, start, start + timedelta(minutes=r.choice([0, 5, 30, 200]))))
    spans, islands = sorted((a, b) for _, _, a, b in rows), []
    for a, b in spans:
        if islands and a <= islands[-1][1]:
            islands[-1][1] = max(islands[-1][1], b)
        else:
            islands.append([a, b])
    grouped = {}
    for k, _, a, b in rows:
        at = max(i for i, (first, _) in enumerate(islands) if first <= a)
        low, high = grouped.get((k, at), (a, b))
        grouped[k, at] = (min(low, a), max(high, b))
    got = iv.coalesce_intervals_global(spark.createDataFrame(rows, SCHEMA), ["k"], "a", "b", policy=policy)
    assert sorted(map(tuple, got.collect())) == sorted((k, *v) for (k, _), v in grouped.items())


def test_windows_of_islands_see_slots(spark):
    """No window over rows is a single partition: those without a key run over one row for each slot."""
    df = spark.range(1000).select((F.lit(T0) + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("a")).withColumn("b", F.col("a"))
    plan = iv.global_islands(df, "a", "b")._jdf.queryExecution().analyzed().toString()
    single = [line for line in plan.splitlines() if "Window [" in line and line.rstrip().endswith("NULLS FIRST]") and "], [_slot" in line]
    assert single and all("_slot" in line for line in single)


@pytest.mark.parametrize("seed", [6, 7])
def test_owners_and_conflicts(spark, seed):
    rows = periods(seed)
    df = spark.createDataFrame(rows, SCHEMA)

    def meet(p, q):
        return p[0] == q[0] and None not in (p[1], q[1]) and p[1] != q[1] and max(p[2], q[2]) < min(p[3], q[3])

    shared = {(p[0], p[2], p[3]) for p in rows if any(meet(p, q) for q in rows)}
    assert set(map(tuple, iv.other_owner_overlap(df, "k", "owner", "a", "b").collect())) == shared
    counts = {r.k: int(r.conflicts) for r in iv.overlap_conflicts(df, "k", "owner", "a", "b").collect()}
    assert counts == {k: sum(meet(p, q) for p in rows for q in rows if p[0] == k) for k in "xy"}


def test_reversed_rows_cover_nothing(spark):
    rows = [r for r in periods(8) if r[1] is not None]
    kept = [r for r in rows if r[3] >= r[2]]
    both = [sorted(map(tuple, iv.coalesce_intervals(spark.createDataFrame(x, SCHEMA), ["k", "owner"], "a", "b").collect())) for x in (rows, kept)]
    assert both[0] == both[1] and len(kept) < len(rows)


@pytest.mark.parametrize("seed", [9, 10])
def test_owners_of_hot_keys(spark, policy, seed):
    rows = periods(seed)
    found = iv.other_owner_overlap(spark.createDataFrame(rows, SCHEMA), "k", "owner", "a", "b", policy).collect()
    owned = [r for r in rows if r[1] is not None]
    assert {tuple(r) for r in found} == {
        (p[0], p[2], p[3])
        for p in owned
        if any(p[0] == q[0] and p[1] != q[1] and max(p[2], q[2]) < min(p[3], q[3]) for q in owned)
    }


def test_no_frame_up_to_the_last_row(spark):
    """Spark evaluates such a frame anew for every row, which is quadratic in the points of a key."""
    df = spark.createDataFrame(periods(11), SCHEMA)
    for made in (iv.other_owner_overlap(df, "k", "owner", "a", "b"), iv.overlap_classify(df, ["k"], "a", "b")):
        assert "unboundedfollowing" not in made._jdf.queryExecution().executedPlan().toString().lower()


@pytest.mark.parametrize("seed", [12, 13])
def test_overlap_classify_of_long_keys(spark, seed):
    """Ranges of several block sizes, keys that need fewer, reversed rows."""
    r = random.Random(seed)
    rows = []
    for k, n, longest in (("x", 150, 2000), ("y", 40, 3), ("z", 30, 400)):
        for _ in range(n):
            start = T0 + timedelta(minutes=r.randint(0, 2000))
            rows.append((k, 1, start, start + timedelta(minutes=r.randint(-5, longest))))
    want = set()
    for k, _, a, b in rows:
        others = [(c, d) for x, _, c, d in rows if x == k]
        want.add((k, a, b, any(a < c and d <= b for c, d in others), any(c < a and b <= d for c, d in others),
                  any(a < c < b < d for c, d in others), any(c < a < d < b for c, d in others)))
    got = iv.overlap_classify(spark.createDataFrame(rows, SCHEMA), ["k"], "a", "b")
    assert set(map(tuple, got.collect())) == want
