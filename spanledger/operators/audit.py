"""Audit log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.operators.ranking import surrogate_key

LOG_SCHEMA = (
    "id bigint, category int, source string, destination string, message string, type_operation string, "
    "count_row bigint, stamp timestamp_ntz"
)


def audit_rows(steps: DataFrame, stamp: Column) -> DataFrame:
    """Log rows for finished steps. Inserts, updates and deletes of nothing are not logged.

    ``steps``: message, category, source, destination, type_operation, count_row; one row per step.
    """
    silent = F.col("type_operation").isin("insert", "update", "delete") & (F.col("count_row") == 0)
    return steps.filter(~silent).select(
        F.col("category").cast("int").alias("category"),
        "source",
        "destination",
        "message",
        "type_operation",
        F.col("count_row").cast("long").alias("count_row"),
        stamp.alias("stamp"),
    )


def write_audit(
    spark: SparkSession,
    path: str,
    source: str,
    destination: str = "",
    message: str = "",
    category: int = 0,
    type_operation: str = "",
    count_row: int = 0,
    stamp: Column | None = None,
) -> bool:
    """Append one log row; numbers continue after the largest in the log. True if a row was written."""
    step = spark.range(1).select(
        F.lit(message).alias("message"),
        F.lit(category).alias("category"),
        F.lit(source).alias("source"),
        F.lit(destination).alias("destination"),
        F.lit(type_operation).alias("type_operation"),
        F.lit(count_row).alias("count_row"),
    )
    if type_operation in ("insert", "update", "delete") and count_row == 0:
        return False
    log = spark.read.schema(LOG_SCHEMA).parquet(path) if _exists(spark, path) else None
    top = 0 if log is None else (log.agg(F.max("id")).first()[0] or 0)
    now = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
    row = audit_rows(step, now).select(F.lit(top + 1).cast("long").alias("id"), "*")
    row.coalesce(1).write.mode("append").parquet(path)
    return True


def append_audit(spark: SparkSession, path: str, rows: DataFrame) -> None:
    """Append the rows of ``audit_rows`` in one write; ids ascend after the largest in the log, with gaps."""
    log = spark.read.schema(LOG_SCHEMA).parquet(path) if _exists(spark, path) else None
    numbered = surrogate_key(rows, log, "id", dense=False)
    numbered.select(*[f.split()[0] for f in LOG_SCHEMA.split(", ")]).write.mode("append").parquet(path)


def load_log(steps: DataFrame, checks: DataFrame, source: str, destination: str) -> DataFrame:
    """A load as steps for ``audit_rows``: its start, its steps, its checks that found something, its end."""
    names = ["message", "category", "type_operation", "count_row"]
    zero = F.lit(0).cast("long").alias("count_row")
    edge = steps.sparkSession.range(1).select(F.lit(0).alias("category"), F.lit("").alias("type_operation"), zero)
    found = checks.filter(F.col("n") > 0).select(
        F.col("check_name").alias("message"), "category", F.lit("").alias("type_operation"), F.col("n").alias("count_row")
    )
    every = edge.withColumn("message", F.lit("start")).select(names)
    for part in (steps, found, edge.withColumn("message", F.lit("stop"))):
        every = every.unionByName(part.select(names))
    return every.withColumn("source", F.lit(source)).withColumn("destination", F.lit(destination))


def _exists(spark: SparkSession, path: str) -> bool:
    from spanledger.sources.tables import path_exists

    return path_exists(spark, path)


def audit_view(log: DataFrame) -> DataFrame:
    """The log without data-generator events, newest first. ``_`` in the pattern is a wildcard."""
    return log.filter(~F.col("source").like("oltp_src_system.mod_%")).orderBy(F.desc("id"))
