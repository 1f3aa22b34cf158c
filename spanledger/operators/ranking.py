"""Row numbers and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanledger.functions import row_digest
from spanledger.scale import DEFAULT_POLICY, SkewPolicy, split_hot
from spanledger.session import materialize


COPIES_PER_TASK = 1_000_000


def row_number_by(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    out: str,
    tie: str | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
    counted: DataFrame | None = None,
) -> DataFrame:
    """``row_number() over (partition by keys order by at, tie)``; ``tie`` defaults to a digest of the whole row.

    ``counted``: a stored table with the same keys per row in which to look for hot keys, if ``df`` is not stored.
    """
    d = df
    if tie is None:
        d, tie = df.withColumn("_tie", row_digest(df.columns)), "_tie"
    # equal digests of different rows are told apart by the rows themselves
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(at, tie, *df.columns)).cast("long")
    ordinary, hot = split_hot(d, keys, policy, counted)
    done = ordinary.withColumn(out, number).select(*df.columns, out)
    if hot is None:
        return done
    return done.unionByName(_number_hot(hot, keys, at, tie, out).select(*df.columns, out))


def _number_hot(df: DataFrame, keys: Sequence[str], at: str, tie: str, out: str) -> DataFrame:
    """Rows of hot keys: copies are counted first, then each key is cut by (``at``, first digits of the digest), which
    follows the order. A cut starts from the number of rows in the cuts before it."""
    cut = F.struct(F.col(at), F.substring(tie, 1, 3)).alias("_cut")
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies")).select("*", cut)
    order = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        df.groupBy(*keys, cut)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_copies", F.coalesce(F.sum("_rows").over(order), F.lit(0)))
        .select(*keys, "_cut", "_copies", F.lit(0).alias("_own"))
    )
    running = Window.partitionBy(*keys, "_cut").orderBy("_own", at, tie, *[c for c in df.columns if c not in (at, tie)]).rowsBetween(Window.unboundedPreceding, 0)
    numbered = (
        distinct.withColumn("_own", F.lit(1))
        .unionByName(carried, allowMissingColumns=True)
        .withColumn("_to", F.sum("_copies").over(running))
        .filter(F.col("_own") == 1)
        .withColumn("_from", F.col("_to") - F.col("_copies") + 1)
    )
    # one row per copy again; very many copies are first cut into ranges that different tasks list
    several = F.col("_copies") > COPIES_PER_TASK
    few = numbered.filter(~several)
    step = F.lit(COPIES_PER_TASK).cast("long")
    many = (
        numbered.filter(several)
        .withColumn("_from", F.explode(F.sequence("_from", "_to", step)))
        .repartition("_from")
        .withColumn("_to", F.least(F.col("_from") + step - 1, F.col("_to")))
    )
    return few.unionByName(many).withColumn(out, F.explode(F.sequence("_from", "_to")))


def surrogate_key(
    new: DataFrame, existing: DataFrame | None, key: str, dense: bool, order: Sequence[str] = ()
) -> DataFrame:
    """Number new rows after the largest existing key.

    ``dense``: 1, 2, 3 .. in ``order`` (rows equal in it by their other columns): rows are range-partitioned and numbered within
    their partition, from the number of rows in the partitions before it. Otherwise unique ascending values with gaps, without
    a shuffle.
    """
    top = 0
    if existing is not None:
        top = existing.agg(F.max(key)).first()[0] or 0
    if not dense:
        return new.withColumn(key, (F.monotonically_increasing_id() + 1).cast("long") + F.lit(top))
    every = [*order, *[c for c in new.columns if c not in order]]
    parts = int(new.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # stored, so that the counts and the numbers see the same partitions
    ranged = materialize(new.repartitionByRange(parts, *every).withColumn("_part", F.spark_partition_id()), "ranged")
    # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*every))
    numbered = ranged.join(F.broadcast(offsets), "_part").withColumn(key, number.cast("long") + F.col("_before") + F.lit(top))
    return numbered.select(*new.columns, key)
