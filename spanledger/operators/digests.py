"""Comparison of stored tables by checksums of their key ranges: rows are read only where the checksums differ."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanledger.operators.change_data import capture_changes
from spanledger.operators.quality import tagged_difference
from spanledger.session import scratch_path

RANGE = "digest_range"


def row_digests(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. NULLs count by their place: (NULL, x) and (x, NULL) differ."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return tuple(F.xxhash64(F.lit(seed), *parts) for seed in (17, 4099))


def range_digests(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per range: number of rows and the sums of their hashes, whatever the order of rows. Sums, unlike exclusive ors, tell
    copies of one row from copies of another; partial sums are combined before the shuffle."""
    sums = [F.sum(h.cast("decimal(20,0)")).alias(f"digest_{k}") for k, h in enumerate(row_digests(columns))]
    return rows.groupBy(RANGE).agg(F.count("*").alias("digest_rows"), *sums)


def whole_number_range(key: str, low: int, high: int, ranges: int) -> Column:
    """Number of the range of ``key``, about ``ranges`` equal ones between ``low`` and ``high``; keys outside get numbers beyond."""
    width = max(1, -(-(high - low + 1) // ranges))
    return F.expr(f"CAST(`{key}` AS BIGINT) div {width}L")


@dataclass(frozen=True)
class DigestedTable:
    """Rows stored in one folder per key range, beside the digests of the ranges."""

    path: str
    schema: T.StructType

    @classmethod
    def write(cls, df: DataFrame, columns: Sequence[str], range_of: Column, path: str | None = None) -> DigestedTable:
        """``range_of`` is a function of the key alone, with the same value for a key in every table compared; NULL is a range too. Large
        ranges go to several tasks and files. An empty table has no ranges."""
        rows = df.select(*columns, range_of.cast("long").alias(RANGE))
        made = cls(path or scratch_path(df.sparkSession, "digested"), rows.schema)
        rows.hint("rebalance", RANGE).write.partitionBy(RANGE).parquet(f"{made.path}/rows")
        range_digests(made.rows(df.sparkSession), columns).write.parquet(f"{made.path}/digests")
        return made

    @property
    def columns(self) -> list[str]:
        return [c for c in self.schema.names if c != RANGE]

    def digests(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/digests")

    def rows(self, spark: SparkSession, ranges: Sequence[int | None] | None = None) -> DataFrame:
        """The rows, or those of some ranges: folders of others are not read."""
        every = spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        if ranges is None:
            return every
        kept = F.col(RANGE).isin([r for r in ranges if r is not None])
        return every.filter(kept | F.col(RANGE).isNull() if None in ranges else kept)


def differing_ranges(spark: SparkSession, a: DigestedTable, b: DigestedTable) -> list[int | None]:
    """The ranges whose digests differ or that only one table has; at most one for each stored folder, which the driver lists anyway."""
    mine, theirs = a.digests(spark).alias("a"), b.digests(spark).alias("b")
    names = [c for c in mine.columns if c != RANGE]
    differ = F.lit(False)
    for c in names:
        differ = differ | ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = mine.join(theirs, F.col(f"a.{RANGE}").eqNullSafe(F.col(f"b.{RANGE}")), "full").filter(differ)
    return [r[0] for r in joined.select(F.coalesce(f"a.{RANGE}", f"b.{RANGE}")).collect()]


def _differing_rows(spark: SparkSession, a: DigestedTable, b: DigestedTable) -> tuple[DataFrame, DataFrame]:
    if a.columns != b.columns:
        raise ValueError("tables to compare must have the same columns")
    ranges = differing_ranges(spark, a, b)
    return a.rows(spark, ranges), b.rows(spark, ranges)


def difference_by_digest(spark: SparkSession, a: DigestedTable, b: DigestedTable) -> DataFrame:
    """``tagged_difference`` of two stored tables over their columns: only ranges with different digests are read and shuffled."""
    mine, theirs = _differing_rows(spark, a, b)
    return tagged_difference(mine, theirs, a.columns)


def capture_by_digest(spark: SparkSession, old: DigestedTable, new: DigestedTable, keys: Sequence[str], stamp: Column) -> DataFrame:
    """``capture_changes`` between two stored snapshots. Ranges follow the key, so a changed, new or gone key is in a range that differs."""
    before, after = _differing_rows(spark, old, new)
    return capture_changes(before.drop(RANGE), after.drop(RANGE), keys, stamp)
