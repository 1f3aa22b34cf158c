import math
import random

import pytest

import numpy as np

from spanledger.llm import vector_join
from spanledger.llm.vector_join import JoinParams, near_vectors


def brute(rows, cosine):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        top = max(map(abs, v))
        v = [x / top for x in v]
        size = math.sqrt(sum(x * x for x in v))
        return [x / size for x in v]

    units = [unit(v) for _, v in rows]
    near = [[] for _ in rows]
    for a, u in enumerate(units):
        for b, w in enumerate(units):
            if a != b and u and w and len(u) == len(w) and sum(x * y for x, y in zip(u, w)) >= cosine:
                near[a].append(b)
    out = []
    for a, (vec_id, _) in enumerate(rows):
        seen, queue = {a}, [a]
        while queue:
            for b in near[queue.pop()]:
                if b not in seen:
                    seen.add(b)
                    queue.append(b)
        least = min((rows[b][0] for b in seen if rows[b][0] is not None), default=None)
        out.append((vec_id, len(near[a]), least, vec_id is not None and vec_id == least))
    return sorted(out, key=repr)


SMALL = JoinParams(axis_sample=40, axes=3, interval=16, leaf=5, fan_out=3)


def found(spark, rows, kind="double", params=SMALL):
    df = spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, n int")
    return sorted(map(tuple, near_vectors(df, params).collect()), key=repr)


@pytest.mark.parametrize("cosine", [0.9, 0.2])
def test_against_brute_force(spark, cosine):
    r = random.Random(2)
    centres = [[r.gauss(0, 1) for _ in range(5)] for _ in range(12)]
    rows = []
    for k in range(150):
        spread = r.choice([0.05, 0.3, 1])
        rows.append((k, [x + r.gauss(0, spread) for x in r.choice(centres)]))
    rows += [(300 + k, centres[0]) for k in range(30)]
    rows += [(400 + k, [x * (k + 1) for x in centres[1]]) for k in range(10)]
    params = JoinParams(cosine=cosine, axis_sample=40, axes=3, interval=16, leaf=5, fan_out=3)
    assert found(spark, rows, params=params) == brute(rows, cosine)


def test_odd_rows(spark):
    rows = [(1, None), (2, [0.0, -0.0]), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (None, [1.0, 0.0]),
            (8, [1.0, 0.01]), (8, [1.0, 0.01]), (9, [1e300, 1e298]), (10, [1e-300, 0.0]), (11, [0.0, 1.0]), (12, [-0.0, 1.0]),
            (13, [1.0, 0.0, 0.0]), (14, []), (15, [2.0]), (16, [-3.0])]
    assert found(spark, rows) == brute(rows, 0.9)
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert found(spark, [(1, None), (2, [0.0])]) == brute([(1, None), (2, [0.0])], 0.9)


def test_blocks_meet_without_a_shuffle(spark, monkeypatch):
    """What is shuffled must not grow with the pairs of blocks that are near each other."""
    plans, close = [], vector_join.close_blocks
    def seen(blocks, eps):
        pairs = close(blocks, eps)
        plans.append(pairs._jdf.queryExecution().executedPlan().toString())
        assert blocks.count() > 3
        return pairs

    monkeypatch.setattr(vector_join, "close_blocks", seen)
    r = random.Random(4)
    rows = [(k, [r.gauss(0, 1) for _ in range(6)]) for k in range(200)]
    assert found(spark, rows) == brute(rows, 0.9)
    assert len(plans) == 1 and "CartesianProduct" in plans[0] and "Exchange" not in plans[0]


@pytest.mark.parametrize("size", [(40, 56), (7, 9)])
def test_trees_and_hits(size):
    rng = np.random.default_rng(3)
    for share in (0.0, 0.01, 0.05, 0.5, 1.0):
        near = rng.random(size) < share
        assert np.array_equal(vector_join._true_at(near), np.flatnonzero(near))
        if not near.any():
            continue

        def parts(rows, columns):
            of = np.arange(sum(size))
            for x, y in zip(rows, columns + size[0]):
                of[of == of[x]] = of[y]
            return [frozenset(np.flatnonzero(of == k).tolist()) for k in np.unique(of)]

        rows, columns = vector_join._tree_links(near)
        assert near[rows, columns].all() and len(rows) < sum(size)
        assert set(parts(rows, columns)) == set(parts(*np.nonzero(near)))
