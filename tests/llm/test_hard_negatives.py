import math
import random
from fractions import Fraction

import numpy as np

from spanledger.llm.hard_negatives import NegativeParams, bit_planes, hard_negatives, order_key, score_of, scores, subset_sums, whole_numbers

SMALL = NegativeParams(positives=3, negatives=4, every=5, block_rows=15, anchor_rows=4)
LONG = (1 << 63) - 1


def brute(rows, params):
    known = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % params.labels if vec_id % params.moved == 0 else label
        known.append((vec_id, label, [math.floor(Fraction(x) * params.scale) for x in v]))
    out = []
    for at, (anchor, label, a) in enumerate(known):
        if anchor % params.every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, other != label) for n, (i, other, v) in enumerate(known) if n != at and len(v) == len(a))
        for minus, positive, _ in [s for s in scored if not s[2]][: params.positives]:
            inside = [s for s in scored if s[2] and params.low * -minus <= 100 * -s[0] <= params.high * -minus]
            for rank, (score, negative, _) in enumerate(inside[: params.negatives], 1):
                out.append((anchor, positive, rank, negative, *(max(-LONG - 1, min(LONG, -x)) for x in (minus, score))))
    return sorted(out)


def found(spark, rows, params=SMALL):
    df = spark.createDataFrame([(*r, 1, b"x") for r in rows], "vec_id long, embedding array<double>, label int, rank int, planes binary")
    return sorted(map(tuple, hard_negatives(df, params).collect()))


def test_tables_and_planes_give_exact_products():
    r = random.Random(3)
    for bits in (1, 9, 30, 70, 1000):
        rows = [[r.randint(-(1 << bits), 1 << bits) for _ in range(11)] for _ in range(9)]
        values = np.array(rows, np.int64 if bits < 60 else object)
        packed, width = bit_planes(values)
        assert packed.shape == (9, width, 2)
        anchor = rows[0]
        assert [int(x) for x in scores(anchor, packed.transpose(1, 2, 0))] == [sum(a * b for a, b in zip(anchor, v)) for v in rows]
    sums = subset_sums([1, -2, 4, 8, 0, 5, 7, 9, 100])
    assert sums[0][0b10000110] == -2 + 4 + 9 and sums[1][1] == 100 and sums[1][2] == 0


def test_whole_numbers_are_floors():
    x = [[0.3, -0.3, 0.0, -1 / 256], [1e300, -1e300, 2.0**60, 5e-324]]
    want = [[math.floor(Fraction(v) * 256) for v in row] for row in x]
    assert whole_numbers(x[:1], 256).tolist() == want[:1]
    assert whole_numbers(x, 256).tolist() == want


def test_keys_sort_like_numbers():
    r = random.Random(2)
    numbers = [0, 1, -1, 255, 256, -255, -256, 1 << 64, -(1 << 64), (1 << 2100) + 5] + [r.randint(-(1 << r.randint(1, 300)), 1 << r.randint(1, 300)) for _ in range(500)]
    assert sorted(numbers) == sorted(numbers, key=order_key)
    assert [score_of(order_key(n)) for n in numbers] == numbers


def test_against_brute_force(spark):
    r = random.Random(1)
    centres = [[r.gauss(0, 1) for _ in range(10)] for _ in range(4)]
    rows = [(k, [c + r.gauss(0, 1) + 0.5 for c in centres[k % 4]], k % 4) for k in range(160)]
    rows += [(300 + k, [0.5] * 10, 1 + k % 2) for k in range(40)]  # ties, a label larger than a block
    got = found(spark, rows)
    assert got == brute(rows, SMALL) and len(got) > 200
    assert found(spark, rows, NegativeParams(every=5)) == brute(rows, NegativeParams(every=5))


def test_odd_rows(spark):
    v = [1.0, 2.0]
    rows = [(0, v, 3), (5, [2.0, 2.0], 3), (5, [2.0, 2.0], 3), (1, [1.0, None], 3), (2, None, 3), (3, [float("nan"), 1.0], 3),
            (4, [float("inf"), 1.0], 3), (None, v, 3), (6, v, None), (7, [1.0, 0.5], 3), (8, [0.5, 0.9], 1), (9, [0.4, 0.4], -2),
            (10, [1.0, 2.0, 3.0], 3), (11, [1.0, 1.0, 1.0], 3), (12, [0.5, 0.5, 0.5], 0), (13, [], 3), (-5, [2.0, 2.0], 1)]
    assert found(spark, rows) == brute(rows, SMALL) != []
    assert found(spark, [(0, [1.0], 1)]) == []
    assert hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_components_of_any_size(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 2.0], 1), (2, [5e29, 0.0], 2), (3, [6e29, 1.0], 2), (4, [1.0, 1.0], 1), (5, [1.0, 0.0], 2), (6, [1e-3, 1.0], 2)]
    rows += [(10, [1e306, -1.0], 1), (15, [2.0, 1.0], 2), (16, [3.0, 1.0], 2), (17, [1.5, 0.5], 1)]
    params = NegativeParams(every=5, block_rows=4, anchor_rows=2)
    assert found(spark, rows, params) == brute(rows, params) != []


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in df.collect()]
    assert sorted(map(tuple, hard_negatives(df).collect())) == brute(rows, NegativeParams()) != []
