"""Exact top-k by inner product with a table of distances to pivots."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanledger.llm.common import sample_by_dim
from spanledger.llm.hard_negatives import order_key, whole_numbers
from spanledger.session import materialize


@dataclass(frozen=True)
class TopKParams:
    """``pivot_sample``: rows (smallest hash of their id) among which pivots are chosen farthest first; the pivot table holds every row.
    ``rings``: parts, at most, of the rows nearest to one pivot, by their distance to it. ``block_rows``/``query_rows``: vectors in one
    block of candidates or queries."""

    k: int = 5
    every: int = 50
    scale: int = 256
    pivots: int = 24
    pivot_sample: int = 2000
    rings: int = 64
    block_rows: int = 4096
    query_rows: int = 2048


#: Whole numbers from here on are scored as unbounded integers, without bounds: sums of products could leave 64 bits.
_LARGEST = 1 << 24
_NO_FLOOR = np.iinfo(np.int64).min
_WIDE_CELL = -1


def finite_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v (components as doubles). Null vectors and those holding null or non-finite components are left out, as are
    empty ones and null ids."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).filter(F.coalesce(finite, F.lit(False)))
        .select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        .filter("vec_id IS NOT NULL")
    )


def choose_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Farthest first from the row farthest from the mean."""
    if not len(sample):
        return sample
    gap = ((sample - sample.mean(axis=0)) ** 2).sum(axis=1)
    chosen = [int(gap.argmax())]
    gap = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def _pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of whole numbers; squares are exact below 2**53."""
    squares = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(squares, 0))


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where all partial sums fit, else in 64-bit integers."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def search_block(query, own_row, floor, candidates, norms, rows, ids, table, to_pivots, k: int):
    """Best ``k`` of one candidate block for one query: their places and scores.

    With d(q, x)^2 = q.q + x.x - 2 q.x, a lower bound of d bounds q.x from above; the lower bound is the largest over pivots
    of |d(q, p) - d(x, p)|. Candidates are evaluated in descending bound, a slice at a time, until no bound left reaches the k-th
    best score so far (``floor`` at first). Equal bounds go on, since ties count.
    """
    own = float(query.astype(np.float64) @ query)
    low = np.abs(table - to_pivots).max(axis=1)
    bound = (norms + own - low * low) / 2 + 1e-9 * (norms + own + 1) + 1e-12 * to_pivots.max() ** 2
    worth = np.flatnonzero((bound >= floor) & (rows != own_row))
    order = worth[np.argsort(-bound[worth], kind="stable")]
    best_at, best, at, step = np.empty(0, np.int64), np.empty(0, np.int64), 0, 64
    while at < len(order) and bound[order[at]] >= floor:
        part = order[at : at + step]
        best = np.r_[best, _scores(query[None, :], candidates[part])[0]]
        best_at = np.r_[best_at, part]
        rank = np.lexsort((rows[best_at], ids[best_at], -best))[:k]
        best, best_at = best[rank], best_at[rank]
        if len(best) == k:
            floor = max(floor, int(best[-1]))
        at, step = at + step, 2 * step
    return best_at, best


def _measured(sample: dict[int, np.ndarray], sample_rows: dict[int, np.ndarray], pivots: dict[int, np.ndarray], params: TopKParams):
    """Adds to rows the distances to the pivots, the nearest one, and for queries the k-th best score within the sample. Wide rows have
    their whole numbers as text and no distances."""
    k = params.k

    def narrow(part: pd.DataFrame, dim: int) -> pd.DataFrame:
        x = whole_numbers(part.v.tolist(), params.scale)
        table = _pivot_distances(x.astype(np.float64), pivots[dim].astype(np.float64))
        floors = np.full(len(part), _NO_FLOOR)
        asks = np.flatnonzero(part.asks)
        if len(asks) and len(sample[dim]) > k:
            scores = _scores(x[asks], sample[dim])
            scores[part.row.to_numpy()[asks][:, None] == sample_rows[dim][None, :]] = _NO_FLOOR
            floors[asks] = np.partition(scores, len(sample[dim]) - k, axis=1)[:, len(sample[dim]) - k]
        cell = table.argmin(axis=1)
        return pd.DataFrame(
            {"vec_id": part.vec_id, "row": part.row, "dim": part.dim, "asks": part.asks, "wide": False, "floor": floors, "cell": cell,
             "away": table.min(axis=1), "norm": (x.astype(np.float64) ** 2).sum(axis=1), "t": list(table), "v": [r.tobytes() for r in x],
             "whole": None}
        )

    def wide(part: pd.DataFrame) -> pd.DataFrame:
        x = whole_numbers(part.v.tolist(), params.scale)
        return pd.DataFrame(
            {"vec_id": part.vec_id, "row": part.row, "dim": part.dim, "asks": part.asks, "wide": True, "floor": _NO_FLOOR,
             "cell": _WIDE_CELL, "away": 0.0, "norm": 0.0, "t": None, "v": None, "whole": [",".join(map(str, r)) for r in x]}
        )

    def run(frames):
        for frame in frames:
            for (dim, is_wide), part in frame.groupby(["dim", "wide"]):
                yield wide(part) if is_wide else narrow(part, dim)

    return run


def _exact(frame: pd.DataFrame) -> np.ndarray:
    """Whole numbers of any size, a row for each row."""
    out = [list(map(int, w.split(","))) if wide else np.frombuffer(v, np.int64).tolist() for wide, v, w in zip(frame.wide, frame.v, frame.whole)]
    return np.array(out, object)


def _searcher(k: int):
    def search(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        ids, rows = candidates.vec_id.to_numpy(), candidates.row.to_numpy()

        def found(query_id, query_row, places, scores):
            for at, score in zip(places, map(int, scores)):
                near_long = max(_NO_FLOOR, min(-_NO_FLOOR - 1, score))
                out.append((query_id, query_row, ids[at], rows[at], near_long, order_key(score)))

        bounded = len(candidates) and not candidates.wide.iloc[0]
        narrow = queries[~queries.wide.astype(bool)] if bounded else queries[:0]
        if len(narrow):
            x = np.stack([np.frombuffer(v, np.int64) for v in candidates.v])
            table, norms = np.stack(candidates.t.tolist()), candidates.norm.to_numpy()
            for q in narrow.itertuples():
                own = np.frombuffer(q.v, np.int64)
                found(q.vec_id, q.row, *search_block(own, q.row, int(q.floor), x, norms, rows, ids, table, np.asarray(q.t), k))
        rest = queries[queries.wide.astype(bool)] if bounded else queries
        if len(candidates) and len(rest):
            x = _exact(candidates)
            for q, own in zip(rest.itertuples(), _exact(rest)):
                scores = x @ own
                best = sorted(np.flatnonzero(rows != q.row), key=lambda n: (-scores[n], ids[n], rows[n]))[:k]
                found(q.vec_id, q.row, best, scores[best])
        return pd.DataFrame(out, columns=["query_id", "query_row", "vec_id", "row", "score", "key"])

    return search


def pivot_table(vectors: DataFrame, params: TopKParams = TopKParams()) -> tuple[DataFrame, int]:
    """The stored table of all rows with their distances to the pivots of their vector length, and the largest number of pivots."""
    numbered = materialize(
        finite_vectors(vectors).select(
            "vec_id", F.monotonically_increasing_id().alias("row"), F.size("v").alias("dim"), "v",
            (F.col("vec_id") % params.every == 0).alias("asks"),
            F.exists("v", lambda x: F.abs(x) * params.scale >= _LARGEST).alias("wide"),
        ),
        "finite-vectors",
    )
    narrow = numbered.filter("NOT wide")
    # one row for each length of vectors
    sizes = {r.dim: r.n for r in narrow.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    some = sample_by_dim(narrow, sizes, params.pivot_sample, "row", ["dim", "row", "v"])
    sample = {d: whole_numbers([r.v for r in some if r.dim == d], params.scale).reshape(-1, d) for d in sizes}
    sample_rows = {d: np.array([r.row for r in some if r.dim == d], np.int64) for d in sizes}
    pivots = {d: choose_pivots(x.astype(np.float64), params.pivots) for d, x in sample.items()}
    measured = numbered.mapInPandas(
        _measured(sample, sample_rows, pivots, params),
        "vec_id long, row long, dim int, asks boolean, wide boolean, floor long, cell int, away double, norm double, t array<double>, "
        "v binary, whole string",
    )
    return materialize(measured, "pivot-table"), max([0, *map(len, pivots.values())])


def _placed(measured: DataFrame, params: TopKParams) -> DataFrame:
    """Rows with the ring of their cell they lie in, at most ``rings`` a pivot, cut at even distances."""
    cells = measured.groupBy("dim", "cell").agg(
        F.min("away").alias("inner"), F.max("away").alias("outer"),
        F.least(F.lit(params.rings), F.ceil(F.count("*") / params.block_rows)).cast("int").alias("rings"),
    )
    part = F.try_divide(F.col("away") - F.col("inner"), F.col("outer") - F.col("inner"))
    ring = F.least(F.col("rings") - 1, F.floor(F.coalesce(part, F.lit(0.0)) * F.col("rings")).cast("int"))
    return measured.join(F.broadcast(cells), ["dim", "cell"]).withColumn("ring", ring).drop("inner", "outer", "rings")


def meetings(measured: DataFrame, pivots: int, params: TopKParams = TopKParams()) -> tuple[DataFrame, DataFrame]:
    """(candidates, queries) as they are shipped, with the keys of the groups in which they meet.

    Rows are blocked by nearest pivot and distance to it. The smallest and largest distance of a ring's rows to every pivot bound
    all its inner products with a query; a query is sent only to rings that can reach its floor, and a ring only to groups of queries sent
    to it. A ring of many rows is dealt into blocks by hash, its queries likewise. Wide rows form blocks that meet all queries.
    """
    placed = _placed(measured, params)
    edges = [f(F.get("t", i)).alias(f"{name}_{i}") for i in range(pivots) for name, f in (("least", F.min), ("most", F.max))]
    rings = materialize(
        placed.groupBy("dim", "cell", "ring").agg(
            F.ceil(F.count("*") / params.block_rows).cast("int").alias("blocks"), F.max("norm").alias("ring_norm"), *edges
        ),
        "rings",
    )
    asks = measured.filter("asks").drop("asks", "cell", "away")
    gaps = [F.greatest(F.get("t", i) - F.col(f"most_{i}"), F.col(f"least_{i}") - F.get("t", i)) for i in range(pivots)]
    low = F.greatest(F.lit(0.0), F.lit(0.0), *gaps)
    norms = F.col("ring_norm") + F.col("norm")
    bound = (norms - low * low) / 2 + F.lit(1e-9) * (norms + 1) + F.lit(1e-12) * F.pow(F.array_max("t"), 2)
    reach = F.col("wide") | (F.col("cell") == _WIDE_CELL) | (bound >= F.col("floor").cast("double"))
    # at most (pivots + 1) * rings rows for one length of vectors
    sent = asks.join(F.broadcast(rings), "dim").filter(reach).drop("ring_norm", *[f"{n}_{i}" for i in range(pivots) for n in ("least", "most")])
    asked = sent.groupBy("dim", "cell", "ring").agg(F.ceil(F.count("*") / params.query_rows).cast("int").alias("query_blocks"))
    asked = materialize(asked, "asked-rings")
    ring, deal = ["dim", "cell", "ring"], lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    candidates = (
        placed.join(F.broadcast(rings.select(*ring, "blocks").join(F.broadcast(asked), ring)), ring)
        .withColumn("block", deal("blocks")).withColumn("query_block", every("query_blocks"))
    )
    queries = (
        sent.join(F.broadcast(asked), ring).withColumn("query_block", deal("query_blocks")).withColumn("block", every("blocks"))
    )
    keys = [*ring, "block", "query_block"]
    payload = ["vec_id", "row", "wide", "v", "whole", "t"]
    return candidates.select(*keys, *payload, "norm"), queries.select(*keys, *payload, "floor")


def top_k(vectors: DataFrame, params: TopKParams = TopKParams()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query with all other rows, ties to the smaller
    vec_id.

    Queries are rows whose id is divisible by ``every``. Queries and candidates meet in blocks, only where the pivot bounds allow one of
    the k highest scores; a block gives at most ``k`` rows a query. Rows with a null id, and vectors that are null, empty, or hold null or
    non-finite components take no part; vectors of different lengths do not meet. A repeated row is another row: it may answer its
    twin, and asks for itself. Fewer than ``k`` others: all of them. Components of any finite size are scored exactly; a score beyond a
    long is returned as the nearest long. An empty table gives an empty one; columns other than id and vector are not read.
    """
    keys = ["dim", "cell", "ring", "block", "query_block"]
    # both sides come from one table: new columns, so that names mean one side
    sides = (df.select(*[F.col(c).alias(c) for c in df.columns]).groupBy(*keys) for df in meetings(*pivot_table(vectors, params), params))
    candidates, queries = sides
    found = candidates.cogroup(queries).applyInPandas(
        _searcher(params.k), "query_id long, query_row long, vec_id long, row long, score long, key binary"
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("key"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= params.k)
    return ranked.select("query_id", "rank", "vec_id", "score")
