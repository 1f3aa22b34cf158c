import math

import pytest
from pyspark.sql import functions as F

from spanledger.llm.mixing import MixTarget, mix_sources, mixed_documents


def documents(spark, extra=()):
    rows, k = [], 0
    for source, docs, words in (("big", 400, 20), ("mid", 100, 10), ("small", 30, 7), (None, 9, 11), ("void", 4, 0)):
        for n in range(docs):
            rows.append((k, " ".join(["w"] * (words + n % 3 * (words > 0))), source, "x"))
            k += 1
    return spark.createDataFrame([*rows, *extra], "doc_id long, text string, source string, mix_copies string")


def mixed(df, target):
    rows = df.select("doc_id", "source", F.size(F.filter(F.split("text", " "), lambda w: w != "")).alias("n")).collect()
    size = {r.doc_id: r.n for r in rows}
    got = {}
    for r in mix_sources(df.drop("mix_copies"), target).collect():
        assert r.mix_tokens == size[r.doc_id]
        got.setdefault(r.source, []).append((r.mix_copies, r.mix_tokens, r.mix_weight))
    return got


def tempered(tokens, a):
    total = sum(tokens.values())
    power = {s: (t / total) ** a for s, t in tokens.items()}
    return {s: p / sum(power.values()) for s, p in power.items()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights.values()) / math.log(len(weights))


@pytest.mark.parametrize("blocks", [4, 1024])
@pytest.mark.parametrize("goal", [{"entropy": 0.9}, {"max_epochs": 4.0}, {"max_epochs": 2.5, "least_epochs": 1.0}, {"entropy": 0.97, "budget": 3000}])
def test_weights_and_budgets(spark, goal, blocks):
    target = MixTarget(**goal, blocks=blocks)
    got = mixed(documents(spark), target)
    tokens = {s: sum(n for _, n, _ in rows) for s, rows in got.items() if s != "void"}
    total = sum(tokens.values())

    def meets(a):
        w = tempered(tokens, a)
        if target.entropy:
            return entropy(w) >= target.entropy
        budget = total if target.least_epochs is None else max(t / w[s] for s, t in tokens.items())
        return max(w[s] * budget / t for s, t in tokens.items()) <= target.max_epochs

    grid = [k / 4000 for k in range(4001) if meets(k / 4000)]
    a = max(grid) if target.entropy else min(grid)
    want = tempered(tokens, a)
    budget = target.budget or (total if target.least_epochs is None else max(t / want[s] for s, t in tokens.items()))
    for source, rows in got.items():
        copies = {c for c, _, _ in rows}
        if source == "void":
            assert copies == {1} and {w for *_, w in rows} == {0.0}
            continue
        weight = rows[0][2]
        assert weight == pytest.approx(want[source], rel=2e-3)
        assert len(copies) <= 2 and max(copies) - min(copies) <= 1
        spent = sum(c * n for c, n, _ in rows)
        exact = weight * budget
        assert exact * (1 - 2e-3) - 24 <= spent <= exact * (1 + 2e-3) + 1
    if target.least_epochs:
        assert min(min(c for c, _, _ in rows) for rows in got.values()) == 1


def test_repeated_rows_and_copies(spark):
    df = documents(spark, [(1000, "a b c", "same", "x")] * 60)
    target = MixTarget(max_epochs=3.0, least_epochs=1.0, blocks=8)
    rows = mix_sources(df.drop("mix_copies"), target).filter("source = 'same'").collect()
    assert len(rows) == 60 and len({r.mix_copies for r in rows}) <= 2
    plain = df.drop("mix_copies")
    whole = mixed_documents(plain, target)
    assert whole.columns == plain.columns
    assert whole.count() == sum(r.mix_copies for r in mix_sources(plain, target).collect())


def test_odd_tables(spark):
    target = MixTarget(entropy=0.9)
    schema = "doc_id long, text string, source string"
    assert mix_sources(spark.createDataFrame([], schema), target).count() == 0
    void = spark.createDataFrame([(1, None, "a"), (None, "", None)], schema)
    assert [r.mix_copies for r in mix_sources(void, target).collect()] == [1, 1]
    one = spark.createDataFrame([(1, "a b", "a"), (None, "c " * 50000, "a"), (2, None, "a")], schema)
    assert [r.mix_copies for r in mix_sources(one, target).collect()] == [1, 1, 1]
    with pytest.raises(ValueError):
        MixTarget()


def test_sharper_than_the_sources(spark):
    rows, k = [], 0
    for source, docs in (("a", 300), ("b", 280), ("c", 260), ("d", 240)):
        for _ in range(docs):
            rows.append((k, "w " * 10, source))
            k += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(df, MixTarget(entropy=0.9)).collect()
    weights = {r.source: r.mix_weight for r in got}
    assert entropy(weights) == pytest.approx(0.9, abs=1e-6)
    power = {s: math.log(weights[s]) - math.log(weights["d"]) for s in weights}
    size = {"a": 300, "b": 280, "c": 260, "d": 240}
    exponents = {power[s] / math.log(size[s] / size["d"]) for s in "abc"}
    assert max(exponents) - min(exponents) < 1e-6 and min(exponents) > 1
    copies = {s: sum(r.mix_copies for r in got if r.source == s) for s in size}
    assert all(abs(copies[s] - weights[s] * 1080) < 1.001 for s in size) and {r.mix_copies for r in got} >= {0, 1, 2}


def test_columns_of_any_name(spark):
    names = ["mix_copies", "_tokens", "_source", "_at", "_block", "_turn", "doc", "_copy", "col"]
    df = documents(spark).drop("mix_copies")
    for name in names:
        df = df.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    target = MixTarget(max_epochs=2.5, least_epochs=1.0)
    whole = mixed_documents(df, target)
    assert whole.columns == df.columns
    assert all(r[n] == f"{n}{r.doc_id}" for r in whole.collect() for n in names)
    counted = mix_sources(df, target)
    assert counted.columns == [*[c for c in df.columns if c != "mix_copies"], "mix_copies", "mix_tokens", "mix_weight", "mix_turn"]
    assert sum(r.mix_copies for r in counted.collect()) == whole.count()
