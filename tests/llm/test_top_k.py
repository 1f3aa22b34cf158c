import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from spanledger.llm.top_k import TopKParams, meetings, pivot_table, top_k

SMALL = TopKParams(k=3, every=5, pivots=6, pivot_sample=30, block_rows=20, query_rows=4)


def brute(rows, params):
    whole = [
        (i, [math.floor(params.scale * Fraction(x)) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (query_id, q) in enumerate(whole):
        if query_id % params.every:
            continue
        scored = [(-sum(a * b for a, b in zip(q, v)), i) for n, (i, v) in enumerate(whole) if n != at and len(v) == len(q)]
        out += [(query_id, rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[: params.k], 1)]
    return sorted(out)


def found(spark, rows, params=SMALL):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    return sorted(map(tuple, top_k(df, params).collect()))


def test_against_brute_force(spark):
    r = random.Random(1)
    rows = [(k, [r.choice([-1.0, 0.0, 0.5, 1.0]) if k % 3 else r.gauss(0, 1) for _ in range(6)]) for k in range(120)]
    rows += [(500 + k, [0.25] * 6) for k in range(40)]  # ties
    rows += [(900, [50.0] + [0.0] * 5), (901, [-50.0] + [0.0] * 5), (1000, [0.0] * 6)]
    assert found(spark, rows) == brute(rows, SMALL)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (5, [3.0, -1.0]), (5, [3.0, -1.0]), (10, [1.0, 2.0, 3.0]), (11, [1.0, 1.0, 1.0]), (12, []), (-5, [2.0, 2.0])]
    assert found(spark, rows) == brute(rows, SMALL)
    assert found(spark, [(0, [1.0])]) == []
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty).count() == 0


def test_components_of_any_finite_size(spark):
    r = random.Random(2)
    rows = [(k, [r.choice([1e30, -3e25, 7e20, 123456.75, 2.0**45, 0.5, -1.25]) * r.random() for _ in range(4)]) for k in range(60)]
    rows += [(k, [r.gauss(0, 1) for _ in range(4)]) for k in range(60, 120)]
    rows += [(200, [1e308, -1e308, 1e308, 1.0]), (201, [1e308, 1e308, 0.0, 0.0]), (205, [1.0, 0.0, 0.0, 0.0])]
    low, high = -(1 << 63), (1 << 63) - 1
    want = [(a, b, c, max(low, min(high, score))) for a, b, c, score in brute(rows, SMALL)]
    assert found(spark, rows) == want


def test_queries_go_only_where_bounds_allow(spark):
    """Ten far clusters: a query's answers are near it, so most rings are never sent to it."""
    r = random.Random(3)
    centres = [[40 * math.cos(c), 40 * math.sin(c), 0.0] for c in range(10)]
    rows = [(k, [x + r.gauss(0, 0.3) for x in centres[k % 10]]) for k in range(1500)]
    params = TopKParams(k=3, every=25, pivots=10, pivot_sample=300, block_rows=50, query_rows=16)
    assert found(spark, rows, params) == brute(rows, params)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    measured, pivots = pivot_table(df, params)
    candidates, queries = meetings(measured, pivots, params)
    keys = ["cell", "ring", "block"]
    queries_asked, all_blocks, query_blocks = 60, 1500 // params.block_rows, -(-60 // params.query_rows)
    sent = queries.select("row", *keys).count()
    assert sent == queries.select("row", *keys).distinct().count()
    assert sent < queries_asked * all_blocks / 3 and candidates.count() < 1500 * query_blocks / 3
    sizes = [x["count"] for x in candidates.groupBy(*keys, "query_block").count().collect()]
    assert max(sizes) <= 2 * params.block_rows


def test_many_copies_are_dealt_over_blocks(spark):
    rows = [(k, [0.5, 0.25]) for k in range(300)] + [(1000 + k, [float(k), 1.0]) for k in range(40)]
    assert found(spark, rows) == brute(rows, SMALL)
    candidates, _ = meetings(*pivot_table(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), SMALL), SMALL)
    sizes = [x["count"] for x in candidates.groupBy("cell", "ring", "block", "query_block").count().collect()]
    assert max(sizes) <= 2 * SMALL.block_rows


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, top_k(df).collect())) == brute(rows, TopKParams())
