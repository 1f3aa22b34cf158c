"""``merge_flagged`` against fragmenting, flagging and merging in plain Python."""

import random
from datetime import date, timedelta

import pytest

from spanledger.operators.intervals import merge_flagged


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def naive(rows, owned):
    out = set()
    for r in rows:
        key, owner, _, w, s, e = r
        near = [x for x in rows if x[0] == key and x[4] < x[5]]
        points = sorted({p for x in near for p in x[4:]})
        flags = {}
        for a, b in zip(points, points[1:]):
            if not (s <= a and b <= e):
                continue
            active = [x for x in near if x[4] <= a and b <= x[5]]
            shared = owned and len({x[1] for x in active}) > 1
            weights = [x[3] for x in active if x[3] is not None]
            flags.setdefault((shared, bool(weights) and w == max(weights)), []).append((a, b))
        for (shared, main), spans in flags.items():
            out.add((*r[:4], min(a for a, _ in spans), max(b for _, b in spans), shared, main))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("owned", [True, False])
def test_equals_fragmenting(spark, policy, seed, owned):
    r = random.Random(seed)
    rows = []
    for i in range(40):
        s = r.randrange(30)
        e = s + r.choice([0, 1, 3, 10, 25])
        rows.append((r.choice("ab"), r.randrange(2), i, r.choice([1, 2, 3, 4, None]), day(s), day(e)))
    rows.append(("c", 1, 99, 5, day(0), date(2999, 12, 31)))
    df = spark.createDataFrame(rows, "k string, o int, id int, w int, s date, e date")
    got = merge_flagged(df, "k", "s", "e", "w", "o" if owned else None, policy=policy)
    found = sorted((tuple(x) for x in got.select("k", "o", "id", "w", "s", "e", "_shared", "_main").collect()), key=repr)
    assert found == naive(rows, owned)
