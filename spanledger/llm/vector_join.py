"""Near-duplicate vectors by an epsilon grid order join on principal dimensions."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import sample_by_dim
from spanledger.llm.components import connected_components, stars_of
from spanledger.session import materialize, settings


@dataclass(frozen=True)
class JoinParams:
    """``axis_sample``: vectors (smallest hash) from which the principal axes are found; they only steer the skipping.
    ``axes``: leading axes for cells and bounding boxes, ``bound_axes``: for upper bounds of products. ``interval``/``leaf``: vectors
    in an interval of the sequence and in a tile. ``fan_out``: intervals that are stored as one block, and tiles of a product."""

    cosine: float = 0.9
    axis_sample: int = 4096
    axes: int = 8
    interval: int = 1024
    leaf: int = 256
    fan_out: int = 16
    bound_axes: int = 24


#: Bytes of vectors in a block, and in the blocks that one task of the join reads of each side.
BLOCK_BYTES, SIDE_BYTES = 1 << 22, 1 << 26
#: Vectors of a block and blocks of a partition are numbered within a node's 63 bits.
_IN_BLOCK, _IN_PART = 1 << 20, 1 << 18
#: More than rounding takes from a product of unit vectors in single precision.
_ROUNDING = 1e-5


def _keyed(kind: str):
    """vec_id, key (digest of the vector's bytes), dim, v (bytes); without a usable vector the last three are null."""
    schema = pa.schema([("vec_id", pa.int64()), ("key", pa.binary()), ("dim", pa.int32()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            dims = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            # a null component becomes NaN; -0.0 becomes 0.0
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.dtype(kind).type(0)
            stops = np.cumsum(dims)
            some = np.flatnonzero(dims)
            usable = np.zeros(len(dims), bool)
            if len(some):
                starts = (stops - dims)[some]
                usable[some] = np.logical_and.reduceat(np.isfinite(values), starts) & np.logical_or.reduceat(values != 0, starts)
            size, whole = values.itemsize, values.tobytes()
            made = [whole[(e - n) * size : e * size] if ok else None for e, n, ok in zip(stops.tolist(), dims.tolist(), usable.tolist())]
            keys = [None if v is None else hashlib.sha256(v).digest() for v in made]
            sizes = pa.array(dims.astype(np.int32), mask=~usable)
            yield pa.record_batch([batch.column(0), pa.array(keys, pa.binary()), sizes, pa.array(made, pa.binary())], schema=schema)

    return run


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; scaled first, so that no square overflows or vanishes."""
    x = vectors.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(units: np.ndarray, count: int) -> np.ndarray:
    """Columns: directions of largest spread."""
    if not len(units):
        return np.zeros((units.shape[1], 0))
    spread = np.cov(units.T).reshape(units.shape[1], units.shape[1])
    return np.linalg.eigh(np.nan_to_num(spread))[1][:, ::-1][:, :count]


def _cells(axes: dict[int, np.ndarray], params: JoinParams, eps: float, kind: str):
    """Vectors with their grid cell on the leading axes, as text that sorts in grid order, and the place on the first axis. Copies
    within a batch become one row."""
    schema = pa.schema([("key", pa.binary()), ("dim", pa.int32()), ("v", pa.binary()), ("n", pa.int64()), ("first", pa.int64()),
                        ("cell", pa.string()), ("place", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            met: dict[bytes, int] = {}
            group = np.array([met.setdefault(k, len(met)) for k in batch.column(1).to_pylist()], np.int64)
            taken = np.zeros(len(met), np.int64)
            taken[group[::-1]] = np.arange(len(group))[::-1]
            grouped = pa.table({"g": pa.array(group), "id": batch.column(0)}).group_by("g", use_threads=False).aggregate([("id", "min")])
            first = grouped.sort_by("g").column("id_min").combine_chunks().cast(pa.int64())
            batch = batch.take(pa.array(taken))
            dims = batch.column(2).to_numpy()
            cells, places = np.empty(len(dims), object), np.zeros(len(dims))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                part = np.frombuffer(b"".join(batch.column(3).take(pa.array(rows)).to_pylist()), kind).reshape(-1, dim)
                at = _unit(part) @ axes[dim][:, : params.axes]
                grid = np.floor((at + 1) / eps).astype(np.int64).clip(0, 0xFFFF)
                cells[rows] = [row.astype(">u2").tobytes().hex() for row in grid]
                if at.shape[1]:
                    places[rows] = at[:, 0]
            counts = np.bincount(group, minlength=len(met)).astype(np.int64)
            columns = [batch.column(1), batch.column(2), batch.column(3), pa.array(counts), first, pa.array(cells, pa.string()), pa.array(places)]
            yield pa.record_batch(columns, schema=schema)

    return run


_BLOCK = "block long, dim int, low array<double>, high array<double>, vectors binary, copies binary, keys binary, firsts array<bigint>"


def _blocks(axes: dict[int, np.ndarray], params: JoinParams, kind: str):
    """Merge copies among the sorted rows of a partition and cut them into blocks with bounding boxes."""
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * _IN_PART
        held: list[list] = []

        def out(rows: list[list]) -> pa.RecordBatch:
            nonlocal number
            dim, vectors = rows[0][1], b"".join(r[2] for r in rows)
            places = _unit(np.frombuffer(vectors, kind).reshape(-1, dim)) @ axes[dim][:, : params.axes]
            made = [
                pa.array([number], pa.int64()), pa.array([dim], pa.int32()),
                pa.array([places.min(axis=0).tolist()], pa.list_(pa.float64())),
                pa.array([places.max(axis=0).tolist()], pa.list_(pa.float64())),
                pa.array([vectors], pa.binary()),
                pa.array([np.array([r[3] for r in rows], np.int64).tobytes()], pa.binary()),
                pa.array([b"".join(r[0] for r in rows)], pa.binary()),
                pa.array([[r[4] for r in rows]], pa.list_(pa.int64())),
            ]
            number += 1
            return pa.record_batch(made, ["block", "dim", "low", "high", "vectors", "copies", "keys", "firsts"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if held and held[-1][0] == row[0]:
                    last = held[-1]
                    last[3] += row[3]
                    last[4] = min((x for x in (last[4], row[4]) if x is not None), default=None)
                    continue
                if held and (len(held) == _block_rows(held[0][1], width, params) or held[0][1] != row[1]):
                    yield out(held)
                    held = []
                held.append(list(row))
        if held:
            yield out(held)

    return run


def _block_rows(dim: int, width: int, params: JoinParams) -> int:
    return max(1, min(params.interval * params.fan_out, _IN_BLOCK, BLOCK_BYTES // (dim * width)))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, key, n, first: a row for each different vector, from the rows of blocks."""
    for batch in batches:
        for block, copies, keys, firsts in zip(*(batch.column(i) for i in range(4))):
            n, keys = np.frombuffer(copies.as_py(), np.int64), keys.as_py()
            yield pa.record_batch(
                [pa.array(block.as_py() * _IN_BLOCK + np.arange(len(n))), pa.array([keys[i : i + 32] for i in range(0, len(keys), 32)], pa.binary()),
                 pa.array(n), firsts.values],
                ["node", "key", "n", "first"],
            )


def _apart(low_a: str, high_a: str, low_b: str, high_b: str) -> Column:
    """Squared distance of two boxes."""
    gap = F.zip_with(
        F.zip_with(low_a, high_b, lambda x, y: x - y), F.zip_with(low_b, high_a, lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    return F.aggregate(gap, F.lit(0.0), lambda total, x: total + x * x)


def close_blocks(blocks: DataFrame, eps: float) -> DataFrame:
    """Every pair of blocks, a block with itself too, whose boxes are within ``eps``: the columns of one as ``a_...``, of the other as
    ``b_...``. Tasks read the stored blocks of both sides; nothing is shuffled, so pairs take no disk whatever their number."""
    left, right = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    # not an equality, which would be shuffled
    alike = (F.col("a_dim") <= F.col("b_dim")) & (F.col("a_dim") >= F.col("b_dim")) & (F.col("a_block") <= F.col("b_block"))
    near = _apart("a_low", "a_high", "b_low", "b_high") <= eps * eps * (1 + 1e-9)
    return left.join(right.hint("shuffle_replicate_nl"), alike & near)


@dataclass
class _Block:
    number: int
    units: np.ndarray
    bounds: np.ndarray
    copies: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray


def _loaded(number: int, dim: int, vectors: bytes, copies: bytes, axes: np.ndarray, params: JoinParams, kind: str) -> _Block:
    """``bounds``: places on the axes and what of the length is off them, so that their products are no less than those of ``units``."""
    units = _unit(np.frombuffer(vectors, kind).reshape(-1, dim))
    places = units @ axes
    off = np.sqrt(np.maximum(0, 1 - (places * places).sum(axis=1)))
    bounds = np.column_stack([places, off]).astype(np.float32)
    cuts = range(0, len(units), params.leaf)
    low, high = (np.stack([f(places[c : c + params.leaf, : params.axes], axis=0) for c in cuts]) for f in (np.min, np.max))
    n = np.frombuffer(copies, np.int64)
    return _Block(number, units, bounds, n, low, high, np.zeros(len(n), np.int64))


def _tree_links(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (rows, columns) that connect whatever the true entries of ``near`` connect."""
    rows_left, columns_left = near.any(axis=1), near.any(axis=0)
    rows, columns = [], []
    for start in np.flatnonzero(rows_left):
        if not rows_left[start]:
            continue
        rows_left[start] = False
        queue = [start]
        while queue and columns_left.any():
            row = queue.pop()
            fresh = np.flatnonzero(near[row] & columns_left)
            columns_left[fresh] = False
            rows.append(np.full(len(fresh), row))
            columns.append(fresh)
            for column in fresh:
                if not rows_left.any():
                    break
                others = np.flatnonzero(near[:, column] & rows_left)
                rows_left[others] = False
                queue += others.tolist()
                rows.append(others)
                columns.append(np.full(len(others), column))
    return np.concatenate(rows), np.concatenate(columns)


def _true_at(near: np.ndarray) -> np.ndarray:
    """``np.flatnonzero``, eight entries at a time where that is possible: nearly all are false."""
    flat = near.ravel()
    if flat.size % 8:
        return np.flatnonzero(flat)
    words = np.flatnonzero(flat.view(np.uint64))
    at, byte = np.nonzero(flat.reshape(-1, 8)[words])
    return words[at] * 8 + byte


def _links_of(a: _Block, b: _Block, params: JoinParams, eps: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Adds to the blocks' totals how many rows each vector is linked with in the other; enough links (places in ``a``, in ``b``) to
    connect what all connect. Tiles apart by more than ``eps`` are skipped, products first bounded on the leading axes."""
    same, leaf, found = a is b, params.leaf, []
    gap = np.maximum(0, np.maximum(a.low[:, None] - b.high[None], b.low[None] - a.high[:, None]))
    close = (gap * gap).sum(axis=2) <= eps * eps * (1 + 1e-9)
    if same:
        close = np.triu(close)
    for i in np.flatnonzero(close.any(axis=1)):
        tiles = np.flatnonzero(close[i])
        for run in np.split(tiles, np.flatnonzero(np.diff(tiles) > 1) + 1):
            for k in range(0, len(run), params.fan_out):
                some = run[k : k + params.fan_out]
                x, y = slice(i * leaf, (i + 1) * leaf), slice(some[0] * leaf, (some[-1] + 1) * leaf)
                near = a.bounds[x] @ b.bounds[y].T >= np.float32(params.cosine - _ROUNDING)
                hits = _true_at(near)
                if not len(hits):
                    continue
                if len(hits) * 64 > near.size:
                    near &= a.units[x] @ b.units[y].T >= params.cosine
                    if same:
                        near &= np.arange(near.shape[0])[:, None] + x.start < np.arange(near.shape[1])[None] + y.start
                    if near.any():
                        a.total[x] += near @ b.copies[y]
                        b.total[y] += a.copies[x] @ near
                        rows, columns = _tree_links(near)
                        found.append((rows + x.start, columns + y.start))
                    continue
                rows, columns = np.divmod(hits, near.shape[1])
                rows, columns = rows + x.start, columns + y.start
                if same:
                    rows, columns = rows[rows < columns], columns[rows < columns]
                fits = np.einsum("ij,ij->i", a.units[rows], b.units[columns]) >= params.cosine
                rows, columns = rows[fits], columns[fits]
                if len(rows):
                    np.add.at(a.total, rows, b.copies[columns])
                    np.add.at(b.total, columns, a.copies[rows])
                    found.append((rows, columns))
    return found


def _joiner(axes: dict[int, np.ndarray], params: JoinParams, eps: float, kind: str):
    """Pairs of blocks to a, b (link, n null) and a, n (number of rows linked with node a, b null)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home: _Block | None = None
        totals: dict[int, np.ndarray] = {}

        def loaded(row: dict, side: str) -> _Block:
            number, dim = row[f"{side}_block"], row["a_dim"]
            block = _loaded(number, dim, row[f"{side}_vectors"], row[f"{side}_copies"], axes[dim], params, kind)
            block.total = totals.setdefault(number, block.total)
            return block

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if home is None or home.number != row["a_block"]:
                    home = loaded(row, "a")
                other = home if row["b_block"] == home.number else loaded(row, "b")
                links = _links_of(home, other, params, eps)
                if links:
                    left, right = (np.concatenate(x) for x in zip(*links))
                    pairs = pa.record_batch([pa.array(home.number * _IN_BLOCK + left), pa.array(other.number * _IN_BLOCK + right)], ["a", "b"])
                    for star in stars_of(iter([pairs])):
                        yield pa.record_batch([*star.columns, pa.nulls(star.num_rows, pa.int64())], schema=schema)
        for number, total in totals.items():
            some = np.flatnonzero(total)
            if len(some):
                yield pa.record_batch([pa.array(number * _IN_BLOCK + some), pa.nulls(len(some), pa.int64()), pa.array(total[some])], schema=schema)

    return run


def near_vectors(vectors: DataFrame, params: JoinParams = JoinParams(), id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links (other rows linked directly), component_id (smallest vec_id reachable), kept, for every row.

    Rows link at a cosine, in double precision, of at least ``cosine``. Vectors that are null, empty, zero, or hold null or
    non-finite components link with nothing and are their own component; vectors of different lengths do not link. Equal
    vectors are compared once and counted as often as they occur; links are never listed, only counted, with enough of them to
    connect what all connect. A null id stays null, is never kept, and counts as a link; repeated rows are rows of their own;
    an empty table gives an empty one; other columns are not read.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    kind = "float32" if _element(given) == "float" else "float64"
    given = given.withColumn("v", F.col("v").cast("array<float>" if kind == "float32" else "array<double>"))
    rows = materialize(given.mapInArrow(_keyed(kind), "vec_id long, key binary, dim int, v binary"), "vectors")
    usable = rows.filter("key IS NOT NULL")
    # one row for each length of vectors
    sizes = {r.dim: r.n for r in usable.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    some = sample_by_dim(usable.withColumn("chance", F.xxhash64("vec_id", "key")), sizes, params.axis_sample, "chance", ["dim", "v"])
    axes = {
        d: principal_axes(_unit(np.frombuffer(b"".join(r.v for r in some if r.dim == d), kind).reshape(-1, d)), max(params.axes, params.bound_axes))
        for d in sizes
    }
    # two unit vectors at this cosine are so far apart; projections are no farther
    eps = math.sqrt(max(0.0, 2 - 2 * params.cosine))
    celled = usable.select("vec_id", "key", "dim", "v").mapInArrow(
        _cells(axes, params, max(eps, 1e-6), kind), "key binary, dim int, v binary, n long, first long, cell string, place double"
    )
    cores, total, width = spark.sparkContext.defaultParallelism, sum(sizes.values()), np.dtype(kind).itemsize
    in_blocks = sum(-(-n // (2 * _block_rows(d, width, params))) for d, n in sizes.items())
    parts = max(1, in_blocks, min(cores, -(-total // params.interval)))
    order = ["dim", "cell", "place", "key"]
    ordered = celled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut = materialize(ordered.select("key", "dim", "v", "n", "first").mapInArrow(_blocks(axes, params, kind), _BLOCK), "blocks")
    # every part of one side meets every part of the other in a task
    side = {
        "spark.sql.files.maxPartitionBytes": str(SIDE_BYTES),
        "spark.sql.files.openCostInBytes": "0",
        "spark.sql.files.minPartitionNum": str(math.isqrt(8 * cores)),
        # two blocks in a row
        "spark.sql.execution.arrow.maxRecordsPerBatch": "4",
    }
    with settings(spark, **side):
        pairs = close_blocks(cut.select("block", "dim", "low", "high", "vectors", "copies"), eps)
        kept = pairs.select("a_block", "a_dim", "a_vectors", "a_copies", "b_block", "b_vectors", "b_copies")
        found = materialize(kept.mapInArrow(_joiner(axes, params, eps, kind), "a long, b long, n long"), "found")
    different = cut.select("block", "copies", "keys", "firsts").mapInArrow(_nodes, "node long, key binary, n long, first long")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    roots = connected_components(found.filter("b IS NOT NULL").select("a", "b"))
    known = (
        different.join(counts, "node", "left").join(roots, "node", "left")
        .select("key", "first", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root"))
    )
    known = materialize(known, "known-vectors")
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = known.join(smallest, "root").select("key", "n_links", "component_id")
    linked = usable.select("vec_id", "key").join(classes, "key").select("vec_id", "n_links", "component_id")
    alone = rows.filter("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    return linked.unionByName(alone).withColumn("kept", kept)


def _element(frame: DataFrame) -> str:
    return frame.schema["v"].dataType.elementType.simpleString()
