import random

import pytest

from spanledger.llm.components import connected_components


def brute(links):
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    inside = {x for a, b in links if a != b for x in (a, b)}
    return {x: find(x) for x in inside}


@pytest.mark.parametrize("task_links", [7, 500_000])
def test_against_brute_force(spark, task_links):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(300, 360)]
    star = [(9000, k) for k in range(9001, 9060)]
    some = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(60)]
    links = [*chain, *star, *some, *some[:10], (5, 5), (-3, -9), (2**62, -(2**62))]
    rng.shuffle(links)
    got = connected_components(spark.createDataFrame(links, "a long, b long"), task_links).collect()
    assert {r.node: r.root for r in got} == brute(links)
    assert len(got) == len({r.node for r in got})


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
