"""Hard negatives by exact inner products, scored by table lookups in packed bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanledger.scale import BROADCAST_ROWS, salted_join
from spanledger.session import materialize


@dataclass(frozen=True)
class NegativeParams:
    """``low``/``high``: percent of the positive's score between which a negative's score lies. ``moved``: rows whose id is
    divisible by it get the next of ``labels`` labels. ``block_rows``/``anchor_rows``: candidates and anchors of one block."""

    positives: int = 5
    negatives: int = 10
    every: int = 100
    scale: int = 256
    low: int = 30
    high: int = 90
    moved: int = 7
    labels: int = 10
    block_rows: int = 16_384
    anchor_rows: int = 1024


#: Dimensions whose subset sums make one table.
GROUP = 8
_LONG = (1 << 63) - 1


def whole_numbers(vectors: list, scale: int) -> np.ndarray:
    """floor(scale * component) exactly: in 64 bits, or as unbounded integers (doubles are fractions) where one does not fit."""
    x = np.array([np.asarray(v, np.float64) for v in vectors], np.float64)
    if np.abs(x).max(initial=0) < (1 << 53) / scale:
        return np.floor(x * scale).astype(np.int64)
    out = np.empty(x.shape, object)
    for place, value in np.ndenumerate(x):
        top, bottom = float(value).as_integer_ratio()
        out[place] = top * scale // bottom
    return out


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, int]:
    """Two's complement bits of whole numbers, packed over groups of eight dimensions: uint8 (row, plane, group), lowest plane
    first, the last plane is the sign; and the number of planes. Any number of bits."""
    width = int(np.maximum(values, ~values).max(initial=0)).bit_length() + 1
    rows, dim = values.shape
    planes = np.zeros((rows, width, -(-dim // GROUP) * GROUP), np.uint8)
    for plane in range(width):
        planes[:, plane, :dim] = ((values >> plane) & 1).astype(np.uint8)
    return np.packbits(planes, axis=2, bitorder="little"), width


def subset_sums(anchor: list[int]) -> np.ndarray:
    """Sums of all 256 subsets of each group of eight dimensions: (group, subset); by doubling, one addition for each entry."""
    padded = list(anchor) + [0] * (-len(anchor) % GROUP)
    small = max(map(abs, padded), default=0) < 1 << 56
    tables = np.zeros((len(padded) // GROUP, 1 << GROUP), np.int64 if small else object)
    for group, table in enumerate(tables):
        for bit in range(GROUP):
            table[1 << bit : 2 << bit] = table[: 1 << bit] + padded[group * GROUP + bit]
    return tables


def scores(anchor: list[int], planes: np.ndarray) -> np.ndarray:
    """Exact inner products of the anchor with rows given as planes (plane, group, row): for each plane, from the sign down, the
    sum so far is doubled and the tables' entries at the plane's bytes are added. In 64 bits where every sum fits, else in
    unbounded integers."""
    tables = subset_sums(anchor)
    width = len(planes)
    if tables.dtype != object and sum(map(abs, anchor)).bit_length() + width > 62:
        tables = tables.astype(object)
    total = np.zeros(planes.shape[2], tables.dtype)
    for plane in range(width - 1, -1, -1):
        found = tables[0].take(planes[plane, 0])
        for group in range(1, len(tables)):
            found = found + tables[group].take(planes[plane, group])
        total = 2 * total - found if plane == width - 1 else 2 * total + found
    return total


def order_key(score: int) -> bytes:
    """Bytes that sort like whole numbers of any size: a size with the sign, then the magnitude (its complement if negative)."""
    size = (abs(score).bit_length() + 7) // 8
    if score < 0:
        return (0x8000 - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + score).to_bytes(size, "big")
    return (0x8000 + size).to_bytes(2, "big") + score.to_bytes(size, "big")


def score_of(key: bytes) -> int:
    size = int.from_bytes(key[:2], "big") - 0x8000
    body = int.from_bytes(key[2:], "big")
    return body if size >= 0 else body + 1 - (1 << 8 * -size)


def _as_long(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def labelled_vectors(vectors: DataFrame, params: NegativeParams, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """row, vec_id, label (moved where due), dim, asks, whole (components as text), planes (bytes of bit planes), width."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label: Column = F.col(label_col).cast("long")
    known = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.alias("label"),
                       F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(finite, F.lit(False)).alias("finite"))
        .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("finite") & (F.size("v") > 0))
        .withColumn("label", F.when(F.col("vec_id") % params.moved == 0, (F.col("label") + 1) % params.labels).otherwise(F.col("label")))
        .select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.size("v").alias("dim"),
                (F.col("vec_id") % params.every == 0).alias("asks"), "v")
    )

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, part in frame.groupby("dim"):
                whole = whole_numbers(part.pop("v").tolist(), params.scale)
                planes, width = bit_planes(whole)
                yield part.assign(
                    whole=[",".join(map(str, x)) if asks else None for x, asks in zip(whole, part.asks)],
                    width=width, planes=[p.tobytes() for p in planes],
                )

    packed = known.mapInPandas(
        pack, "row long, vec_id long, label long, dim int, asks boolean, whole string, width int, planes binary"
    )
    return materialize(packed, "bit-planes")


def _planes_of(frame: pd.DataFrame) -> np.ndarray:
    """(plane, group, row) of a block's rows, the sign plane repeated up to the widest row."""
    groups = -(-int(frame.dim.iloc[0]) // GROUP)
    widest = int(frame.width.max())
    out = np.empty((widest, groups, len(frame)), np.uint8)
    for n, (width, packed) in enumerate(zip(frame.width, frame.planes)):
        own = np.frombuffer(packed, np.uint8).reshape(width, groups)
        out[:width, :, n] = own
        out[width:, :, n] = own[-1]
    return out


def _best(found: np.ndarray, at: np.ndarray, ids: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Of the places ``at``, the first ``count`` by falling score, then id, then row."""
    if found.dtype == object:
        return np.array(sorted(at, key=lambda n: (-found[n], ids[n], rows[n]))[:count], np.int64)
    if len(at) > count:
        least = np.partition(found[at], len(at) - count)[len(at) - count]
        at = at[found[at] >= least]
    return at[np.lexsort((rows[at], ids[at], -found[at]))][:count]


def _positives(count: int):
    def search(candidates: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(anchors):
            planes, ids, rows = _planes_of(candidates), candidates.vec_id.to_numpy(), candidates.row.to_numpy()
            for row, whole in zip(anchors.row, anchors.whole):
                found = scores([int(x) for x in whole.split(",")], planes)
                for n in _best(found, np.flatnonzero(rows != row), ids, rows, count):
                    out.append((row, ids[n], rows[n], order_key(int(found[n]))))
        return pd.DataFrame(out, columns=["anchor", "positive_id", "positive", "key"])

    return search


def _negatives(params: NegativeParams):
    def search(candidates: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(anchors):
            planes, ids, rows = _planes_of(candidates), candidates.vec_id.to_numpy(), candidates.row.to_numpy()
            labels = candidates.label.to_numpy()
            for row, label, whole, keys in zip(anchors.row, anchors.label, anchors.whole, anchors["keys"]):
                found = scores([int(x) for x in whole.split(",")], planes)
                other = np.flatnonzero(labels != label)
                for key in {bytes(k) for k in keys}:
                    score = score_of(key)
                    # the window in whole numbers, so that no product leaves 64 bits
                    low, high = -(-params.low * score // 100), params.high * score // 100
                    if found.dtype != object:
                        low, high = max(low, -_LONG - 1), min(high, _LONG)
                    if low > high:
                        continue
                    inside = other[(found[other] >= low) & (found[other] <= high)]
                    for n in _best(found, inside, ids, rows, params.negatives):
                        out.append((row, key, ids[n], rows[n], order_key(int(found[n]))))
        return pd.DataFrame(out, columns=["anchor", "positive_key", "negative_id", "negative", "key"])

    return search


def _met(candidates: DataFrame, anchors: DataFrame, keys: list[str], search, ddl: str) -> DataFrame:
    # both sides come from one table: new columns, so that names mean one side
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns]).groupBy(*keys) for df in (candidates, anchors))
    return left.cogroup(right).applyInPandas(search, ddl)


def _block(blocks: Column | str) -> Column:
    return F.pmod(F.xxhash64("row"), F.col(blocks) if isinstance(blocks, str) else blocks).cast("int")


def _numbers(blocks: Column | str) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.col(blocks) if isinstance(blocks, str) else blocks) - 1))


def _to_long(column: str) -> Column:
    def convert(keys: pd.Series) -> pd.Series:
        return keys.map(lambda key: _as_long(score_of(key)))

    return F.pandas_udf(convert, "long")(column)


def hard_negatives(vectors: DataFrame, params: NegativeParams = NegativeParams(), id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Every anchor (id divisible by ``every``) is scored against every other row of its vector length, each pair once: in blocks of
    its own label for its positives, then in blocks of all rows for the negatives in the windows of these positives. A block of any
    label, however frequent, holds about ``block_rows`` rows; it returns at most ``positives`` rows for an anchor, or ``negatives`` for
    a window, which are merged by a window function.

    Rows with a null id, label or vector, an empty vector, or null or non-finite components take no part; vectors of different lengths do
    not meet. Ties go to the smaller id. A repeated row is another row: it may answer its twin, and asks for itself. Anchors without
    another row of their label, and windows without rows, give nothing. Components of any finite size are scored exactly; a
    score beyond a long is returned as the nearest long. An empty table gives an empty one; other columns are not read.
    """
    known = labelled_vectors(vectors, params, id_col, vector_col, label_col)
    wide = ["row", "vec_id", "label", "dim", "width", "planes"]
    per_label = known.groupBy("dim", "label").agg(
        F.ceil(F.count("*") / params.block_rows).cast("int").alias("blocks"),
        F.ceil(F.count_if("asks") / params.anchor_rows).cast("int").alias("anchor_blocks"),
    )
    keys = ["dim", "label", "block", "anchor_block"]
    # labels without an anchor have no positives to look for
    asked = per_label.filter("anchor_blocks > 0")
    if asked.count() <= BROADCAST_ROWS:
        sized = known.join(F.broadcast(asked), ["dim", "label"])
    else:
        sized = salted_join(known, asked, ["dim", "label"])
    own = sized.withColumn("block", _block("blocks")).select(*wide, "block", _numbers("anchor_blocks").alias("anchor_block"))
    asking = (
        sized.filter("asks").withColumn("anchor_block", _block("anchor_blocks"))
        .select("row", "dim", "label", "whole", "anchor_block", _numbers("blocks").alias("block"))
    )
    first = _met(own, asking, keys, _positives(params.positives), "anchor long, positive_id long, positive long, key binary")
    by_score = Window.partitionBy("anchor").orderBy(F.desc("key"), "positive_id", "positive")
    positives = materialize(
        first.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") <= params.positives), "positives"
    )

    sizes = known.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks")).first()
    blocks = F.lit(max(1, -(-sizes.n // params.block_rows)))
    anchor_blocks = F.lit(max(1, -(-sizes.asks // params.anchor_rows)))
    windows = positives.groupBy(F.col("anchor").alias("row")).agg(F.collect_set("key").alias("keys"))
    windowed = known.filter("asks").join(windows, "row").withColumn("anchor_block", _block(anchor_blocks))
    found = _met(
        known.withColumn("block", _block(blocks)).select(*wide, "block", _numbers(anchor_blocks).alias("anchor_block")),
        windowed.select("row", "dim", "label", "whole", "keys", "anchor_block", _numbers(blocks).alias("block")),
        ["dim", "block", "anchor_block"], _negatives(params),
        "anchor long, positive_key binary, negative_id long, negative long, key binary",
    )
    by_score = Window.partitionBy("anchor", "positive_key").orderBy(F.desc("key"), "negative_id", "negative")
    ranked = found.withColumn("rank", F.row_number().over(by_score).cast("int")).filter(F.col("rank") <= params.negatives)
    named = known.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        positives.select("anchor", "positive_id", F.col("key").alias("positive_key"))
        .join(ranked, ["anchor", "positive_key"]).join(named, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", _to_long("positive_key").alias("positive_score"),
                _to_long("key").alias("negative_score"))
    )
