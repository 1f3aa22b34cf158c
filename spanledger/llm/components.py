"""Connected components of a link table, as joins and groupings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanledger.session import materialize

#: Links that one task connects by itself before each round.
TASK_LINKS = 500_000


def connected_components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``links`` (a, b: long).

    Rounds of three steps until the set of links stays the same: every task turns its at most ``task_links`` links into stars
    around their smallest nodes; a large-star and a small-star step then link every node to its smallest neighbour. Links never
    outnumber the first ones. Every round is stored, which cuts the lineage. Self links and repeated links change
    nothing; no links, no rows. A node with very many links is one join key on one side only, with one row on the other: a join
    that AQE splits.
    """
    greater, less = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    stars = materialize(links.select(greater, less).filter("a <> b").distinct(), "links")
    state = _state(stars)
    while state[0]:
        local = _locally(stars, max(1, -(-state[0] // task_links)))
        stars = materialize(_small_star(_large_star(local)), "links")
        before, state = state, _state(stars)
        if state == before:
            break
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(links: DataFrame) -> tuple:
    mixed = F.sum(F.xxhash64("a", "b").bitwiseAND((1 << 40) - 1))
    return tuple(links.agg(F.count("*"), mixed).first())


def stars_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task as stars, by passing on the smallest number along links and along what it points to."""
    held = [tuple(c.to_numpy() for c in batch.columns) for batch in batches if batch.num_rows]
    if not held:
        return
    a, b = (np.concatenate(x) for x in zip(*held))
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = places[: len(a)], places[len(a) :]
    low = np.arange(len(nodes))
    while True:
        least = np.minimum(low[left], low[right])
        new = low.copy()
        # a node's old root learns of the smaller one as well
        for at in (left, right, low[left], low[right]):
            np.minimum.at(new, at, least)
        new = new[new]
        if np.array_equal(new, low):
            break
        low = new
    other = np.flatnonzero(low != np.arange(len(nodes)))
    yield pa.record_batch([pa.array(nodes[other]), pa.array(nodes[low[other]])], ["a", "b"])


def _locally(links: DataFrame, parts: int) -> DataFrame:
    return links.repartition(parts).mapInArrow(stars_of, "a long, b long")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of it and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return (
        both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of these."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")
    return moved.unionByName(low.select("a", F.col("low").alias("b"))).distinct()
