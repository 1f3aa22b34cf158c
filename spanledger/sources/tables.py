"""Reading, writing and rebuilding tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger import constants as C


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def snapshot_transfer(source: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Replace the stage table at ``target`` by the given columns of ``source``; executors copy in parallel."""
    source.select(*columns).write.mode("overwrite").parquet(target)
    return source.sparkSession.read.parquet(target)


def replace_partitions(df: DataFrame, target: str, by: Sequence[str], touched: DataFrame | None = None) -> None:
    """Replace the partitions of the table at ``target`` for which ``df`` has rows, or all those listed in ``touched`` (which may be left
    empty); files of other partitions stay as they are. ``df`` must not read ``target``."""
    spark = df.sparkSession
    dealt = df.hint("rebalance", *by)  # one file for a partition where that is enough
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(target)
    if touched is not None:
        # a touched partition without rows is not written, so it is dropped; one row for each of these
        gone = touched.select(*by).distinct().join(df.select(*by).distinct(), list(by), "left_anti").collect()
        for row in gone:
            folder = spark._jvm.org.apache.hadoop.fs.Path(target, "/".join(f"{c}={row[c]}" for c in by))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def jdbc_source(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Database table, read in ``partitions`` ranges of ``partition_column`` so that no single task pulls it all."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=str(partitions)
        )
    return reader.load()


def jdbc_replace(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Truncate and refill a database table, keeping its definition."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", "true").options(
        **options
    ).mode("overwrite").save()


def seed_rows(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """Literal dictionary rows, part of the plan itself."""
    structs = [F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row, strict=True)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add missing columns with their default. A column that is there keeps its NULLs."""
    return df.withColumns({c: value for c, value in defaults.items() if c not in df.columns})


def validity_defaults() -> dict[str, Column]:
    return {
        "effective_from_date": F.lit(C.FIRST_DATE).cast("date"),
        "effective_to_date": F.lit(C.LAST_DATE).cast("date"),
    }


def technical_defaults(as_of: Column | None = None) -> dict[str, Column]:
    now = F.current_timestamp().cast("timestamp_ntz") if as_of is None else as_of
    return {"user": F.current_user(), "deleted_flg": F.lit(False), "processed_dttm": now}


def append_rows(df: DataFrame, target: str) -> None:
    df.write.mode("append").parquet(target)


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``target`` with ``columns`` replaced where ``source`` has the key. A key twice in ``source`` is an error."""
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("a key occurs twice in the source")).cast("boolean"))
    matchable = source.dropna(subset=list(keys))  # a NULL key matches nothing
    new = (
        matchable.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys])
        .agg(F.first(F.struct(*columns)).alias("_new"), once.alias("_once"))
        .filter(F.col("_once").isNull())
        .drop("_once")
    )
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    joined = target.join(new, on, "left")
    return joined.select(
        *[
            F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )


def row_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Number of rows lost between two states of a table."""
    counts = before.agg(F.count(F.lit(1)).alias("n")).unionByName(
        after.agg((-F.count(F.lit(1))).alias("n"))
    )
    return counts.agg(F.sum("n").alias("count_row"))
