"""Handling of keys that own a large share of all rows.

A window or a join puts one key into one task. The helpers here find the few keys for which that would hurt and
split only those: joins by salt, windows by ordered slots. Results are the same with and without splitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class SkewPolicy:
    """``hot_rows``: rows of one key that one task may hold. ``share``: a key with less than one in ``share`` of all rows is never
    hot, so there are at most ``share`` hot keys. ``slot``: time unit that splits a hot key in a window over timestamps;
    ``slot_width``: the same for whole numbers. ``slot_hours``: slots of rows that take part in each slot they last through."""

    hot_rows: int = 1_000_000
    share: int = 10_000
    slot: str = "hour"
    slot_width: int = 3600
    slot_hours: int = 24


DEFAULT_POLICY = SkewPolicy()
BROADCAST_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows and more than one in ``share`` of all, with the number of pieces to cut them
    into, each of at most ``hot_rows`` rows.

    None if the whole table is no larger than ``hot_rows``, so that there can be none; for a stored table that count comes
    from file footers. ``df`` is read again by what follows, so it should be a stored table or a narrow projection of one.
    """
    total = df.count()
    if total <= policy.hot_rows:
        return None
    least = max(policy.hot_rows, total // policy.share)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > least)
        .select(
            *[F.col(k).alias(f"_hot_{k}") for k in keys],
            F.ceil(F.col("_n") / policy.hot_rows).cast("int").alias("_pieces"),
        )
    )


def found_hot_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame | None:
    """As ``hot_keys``, but None also if counting finds no such key: a split plan would only read and shuffle the table more often."""
    hot = hot_keys(df, keys, policy)
    return None if hot is None or hot.isEmpty() else hot


def mark_hot(df: DataFrame, hot: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Add ``_pieces`` (NULL for ordinary keys). The broadcast list is bounded by the policy's ``share``."""
    if hot is None:
        return df.withColumn("_pieces", F.lit(None).cast("int"))
    same = F.lit(True)
    for k in keys:
        same = same & df[k].eqNullSafe(hot[f"_hot_{k}"])
    return df.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{k}" for k in keys])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    residual: Column | None = None,
    how: str = "inner",
    policy: SkewPolicy = DEFAULT_POLICY,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi join (``inner``, ``left``, ``left_semi``, ``left_anti``) in which hot keys of ``left`` are cut into pieces.

    Each left row goes to one piece by a hash of its content; matching right rows go to every piece, so ``right``
    should be small per key. ``residual`` may name any non-key column, which must differ between the sides. ``counted``:
    a stored table with the same keys per row to look for hot keys in.
    """
    hot = found_hot_keys(left if counted is None else counted, keys, policy)
    renamed = {k: f"_r_{k}" for k in keys}
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(renamed[k]))
    if residual is not None:
        on = on & residual
    if hot is None:
        return left.join(right.withColumnsRenamed(renamed), on, how).drop(*renamed.values())
    salt = F.pmod(F.xxhash64(*left.columns), F.col("_pieces").cast("long")).cast("int")
    spread = mark_hot(left, hot, keys).withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_pieces")
    copied = (
        mark_hot(right, hot, keys)
        .withColumn("_r_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_pieces")
        .withColumnsRenamed(renamed)
    )
    return spread.join(copied, on & (F.col("_salt") == F.col("_r_salt")), how).drop(
        "_salt", "_r_salt", *renamed.values()
    )


def in_bounded_parts(df: DataFrame, keys: Sequence[str], total: int, rows: int) -> DataFrame:
    """Deal the ``total`` rows by ``keys`` into partitions of about ``rows`` rows, however many that makes. Adaptive execution sizes partitions
    by their packed bytes, which say little of what the sorts and windows of a task hold. Few rows stay as they are."""
    parts = -(-total // rows)
    return df.repartition(parts, *keys) if parts > 1 else df


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the row count was checked; beyond the bound the join shuffles both sides."""
    return F.broadcast(df) if df.count() <= max_rows else df


def split_hot(
    df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys and rows of hot keys (None if there cannot be any), so that only the latter pay for
    being split. ``counted``: a stored table with the same keys per row to look for hot keys in."""
    hot = found_hot_keys(df if counted is None else counted, keys, policy)
    if hot is None:
        return df, None
    marked = mark_hot(df, hot, keys)
    is_hot = F.col("_pieces").isNotNull()
    return marked.filter(~is_hot).drop("_pieces"), marked.filter(is_hot).drop("_pieces")


def time_slot(df: DataFrame, at: str, policy: SkewPolicy = DEFAULT_POLICY) -> Column:
    """The part of its range ``at`` falls into; slots sort like ``at``. Timestamps, dates and whole numbers only."""
    kind = df.schema[at].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc(policy.slot, F.col(at)).cast(kind)
    if isinstance(kind, T.DateType):
        return F.trunc(F.col(at), "month")
    if isinstance(kind, T.IntegralType):
        return F.floor(F.col(at) / F.lit(policy.slot_width)).cast("long")
    raise TypeError(f"{at} is {kind.simpleString()}: only timestamps, dates and whole numbers are cut into slots")


def slot_number(kind: T.DataType, at: Column, policy: SkewPolicy = DEFAULT_POLICY) -> Column:
    """Whole number of the slot of ``at``, so that slots can be counted through: months of dates, ``slot_hours`` of timestamps,
    ``slot_width`` of whole numbers."""
    if isinstance(kind, T.DateType):
        return (F.year(at) * 12 + F.month(at)).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.floor(F.unix_micros(at.cast("timestamp")) / F.lit(policy.slot_hours * 3_600_000_000)).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.floor(at / F.lit(policy.slot_width)).cast("long")
    raise TypeError(f"{kind.simpleString()} is not cut into slots")
