"""Interval operators against brute force in plain Python, with and without splitting of hot keys."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanledger.operators import intervals as iv

D0 = date(2024, 1, 1)
T0 = datetime(2024, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def random_rows(seed, n=60, keys=2, owners=3, span=25, longest=9, zero=True):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        s = r.randrange(span)
        rows.append((f"k{r.randrange(keys)}", r.randrange(owners), day(s), day(s + r.randrange(0 if zero else 1, longest))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, o int, s date, e date")


def collect(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def overlap(a, b):
    return max(a[2], b[2]) < min(a[3], b[3])


def islands(rows, key):
    """Naive gaps and islands per key; touching counts."""
    groups = defaultdict(list)
    for r in rows:
        groups[key(r)].append((r[-2], r[-1]))
    out = []
    for k, spans in groups.items():
        spans.sort()
        cur = list(spans[0])
        for s, e in spans[1:]:
            if s <= cur[1]:
                cur[1] = max(cur[1], e)
            else:
                out.append((*k, *cur))
                cur = [s, e]
        out.append((*k, *cur))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_fragment(spark, policy, seed):
    rows = random_rows(seed)
    points = defaultdict(set)
    for k, _, s, e in rows:
        points[k] |= {s, e}
    want = []
    for k, o, s, e in rows:
        p = sorted(points[k])
        want += [(k, o, a, b) for a, b in zip(p, p[1:]) if max(a, s) < min(b, e)]
    got = iv.fragment(frame(spark, rows), ["k"], "s", "e", policy)
    assert collect(got, "k", "o", "s", "e") == sorted(want, key=repr)


def test_fragments_are_equal_or_disjoint(spark, policy):
    pieces = [tuple(r) for r in iv.fragment(frame(spark, random_rows(3)), ["k"], "s", "e", policy).collect()]
    for a in pieces:
        for b in pieces:
            if a[0] == b[0] and overlap(a, b):
                assert a[2:] == b[2:]


def test_fragment_open_and_timestamps(spark, policy):
    rows = [("a", 1, T0, T0 + timedelta(hours=5)), ("a", 2, T0 + timedelta(hours=2), None), ("a", 3, T0, T0)]
    rows += [("a", 10 + i, T0 + timedelta(minutes=i), T0 + timedelta(minutes=i + 1)) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o int, s timestamp_ntz, e timestamp_ntz")
    got = iv.fragment(df, ["k"], "s", "e", policy)
    points = sorted({x for r in rows for x in r[2:] if x})
    want = []
    for k, o, s, e in rows:
        want += [(k, o, a, b) for a, b in zip(points, points[1:]) if s <= a and (e is None or b <= e)]
    assert collect(got, "k", "o", "s", "e") == sorted(want, key=repr)


@pytest.mark.parametrize("seed", [4, 5])
def test_coalesce_dates(spark, policy, seed):
    rows = random_rows(seed, n=30)
    got = iv.coalesce_intervals(frame(spark, rows), ["k", "o"], "s", "e", policy)
    assert collect(got, "k", "o", "s", "e") == islands(rows, lambda r: r[:2])


@pytest.mark.parametrize("seed", range(3))
def test_coalesce_timestamps(spark, policy, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(50):
        s = T0 + timedelta(minutes=r.randrange(60 * 30))
        rows.append((r.choice(["a", "b"]), r.choice([1, None]), s, s + timedelta(minutes=r.choice([0, 1, 20, 300]))))
    df = spark.createDataFrame(rows, "k string, o int, s timestamp_ntz, e timestamp_ntz")
    once = iv.coalesce_intervals(df, ["k", "o"], "s", "e", policy)
    got = collect(once, "k", "o", "s", "e")
    assert got == islands(rows, lambda x: x[:2])
    assert collect(iv.coalesce_intervals(once, ["k", "o"], "s", "e", policy), "k", "o", "s", "e") == got


def test_coalesce_touching_equal_starts_zero_length(spark, policy):
    rows = [("a", 1, day(0), day(2)), ("a", 1, day(2), day(3)), ("a", 1, day(0), day(1)), ("a", 1, day(5), day(5))]
    got = iv.coalesce_intervals(frame(spark, rows), ["k", "o"], "s", "e", policy)
    assert collect(got, "s", "e") == [(day(0), day(3)), (day(5), day(5))]


def test_global_islands_bridge_gaps(spark):
    rows = [("a", 1, day(0), day(2)), ("b", 1, day(1), day(5)), ("a", 1, day(5), day(6)), ("a", 1, day(8), day(9))]
    whole = iv.coalesce_intervals_global(frame(spark, rows), ["k"], "s", "e")
    assert collect(whole.filter("k = 'a'"), "s", "e") == [(day(0), day(6)), (day(8), day(9))]
    own = iv.coalesce_intervals(frame(spark, rows), ["k"], "s", "e")
    assert collect(own.filter("k = 'a'"), "s", "e") == [(day(0), day(2)), (day(5), day(6)), (day(8), day(9))]


def test_temporal_join_closed_and_half_open(spark):
    left = frame(spark, [("a", 1, day(0), day(3)), ("a", 2, day(5), day(6)), ("b", 3, day(0), day(9))])
    right = spark.createDataFrame([("a", "x", day(3), day(5))], "k string, v string, s date, e date")
    closed = iv.temporal_join(left, right, {"k": "k"}, "s", "e", ["v"])
    assert collect(closed, "o", "s", "e", "v") == [(1, day(3), day(3), "x"), (2, day(5), day(5), "x")]
    assert iv.temporal_join(left, right, {"k": "k"}, "s", "e", ["v"], closed=False).count() == 0


@pytest.mark.parametrize("seed", [6, 7])
def test_other_owner_overlap(spark, seed):
    rows = random_rows(seed, n=40, owners=2, longest=5) + [("k0", None, day(3), day(7)), (None, 1, day(0), day(9))]
    want = {
        (a[0], a[2], a[3])
        for a in rows
        for b in rows
        if a[0] is not None and a[0] == b[0] and None not in (a[1], b[1]) and a[1] != b[1] and overlap(a, b)
    }
    got = iv.other_owner_overlap(frame(spark, rows), "k", "o", "s", "e")
    assert collect(got, "k", "s", "e") == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("longest", [4, 12, 60])
def test_overlap_classify(spark, seed, longest):
    rows = random_rows(100 + seed, n=25, keys=2, span=60, longest=longest)
    rows.append(("k0", 1, day(9), day(4)))
    rows.append(("k1", 1, day(0), date(2999, 12, 31)))
    want = set()
    for c in rows:
        near = [d for d in rows if d[0] == c[0]]
        want.add(
            (
                c[0],
                c[2],
                c[3],
                any(c[2] < d[2] and d[3] <= c[3] for d in near),
                any(d[2] < c[2] and c[3] <= d[3] for d in near),
                any(c[2] < d[2] < c[3] < d[3] for d in near),
                any(d[2] < c[2] < d[3] < c[3] for d in near),
            )
        )
    got = iv.overlap_classify(frame(spark, rows), ["k"], "s", "e")
    flags = ["outside_flg", "inside_flg", "right_flg", "left_flg"]
    assert collect(got, "k", "s", "e", *flags) == sorted(want, key=repr)


def test_overlap_classify_equal_start(spark):
    rows = [("a", 1, day(0), day(5)), ("a", 2, day(0), day(3)), ("b", 1, day(0), day(1))]
    plain = iv.overlap_classify(frame(spark, rows), ["k"], "s", "e")
    assert not any(r.outside_flg or r.inside_flg for r in plain.collect())
    seen = iv.overlap_classify(frame(spark, rows), ["k"], "s", "e", include_equal_start=True)
    assert collect(seen, "k", "e", "outside_flg", "inside_flg") == [
        ("a", day(3), False, True),
        ("a", day(5), True, False),
        ("b", day(1), False, False),
    ]


@pytest.mark.parametrize("seed", [8, 9])
def test_overlap_conflicts(spark, seed):
    rows = random_rows(seed, n=40)
    want = defaultdict(int)
    for a in rows:
        if a[2] < a[3]:
            want[a[0]] += sum(a[0] == b[0] and a[1] != b[1] and overlap(a, b) for b in rows)
    got = iv.overlap_conflicts(frame(spark, rows), "k", "o", "s", "e").collect()
    assert {r.k: int(r.conflicts) for r in got} == dict(want)


def test_best_in_overlap(spark, policy):
    pieces = iv.fragment(frame(spark, random_rows(10)), ["k"], "s", "e", policy)
    rows = [tuple(r) for r in pieces.withColumn("w", F.when(F.col("o") > 0, F.col("o"))).collect()]
    df = spark.createDataFrame(rows, "k string, o int, s date, e date, w int")
    best = iv.best_in_overlap(df, ["k"], "s", "e", "w", "best", policy)
    want = []
    for a in rows:
        weights = [b[4] for b in rows if b[0] == a[0] and overlap(a, b) and b[4] is not None]
        want.append((*a, bool(weights) and a[4] == max(weights)))
    assert collect(best, "k", "o", "s", "e", "w", "best") == sorted(want, key=repr)


def test_range_join_days(spark):
    days = spark.createDataFrame([(day(i),) for i in range(5)], "d date")
    rows = [("a", 1, day(-3), day(1)), ("a", 2, day(3), date(2999, 12, 31)), ("a", 3, day(9), day(12)), ("a", 4, day(3), day(2))]
    got = iv.range_join_days(frame(spark, rows), days, "d", "s", "e")
    assert collect(got, "o", "d") == [(1, day(0)), (1, day(1)), (2, day(3)), (2, day(4))]
