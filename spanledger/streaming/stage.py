"""Incremental loads as Structured Streaming jobs that drain what has arrived and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.operators.change_data import stage_new_changes
from spanledger.sources.history_table import HistoryTable
from spanledger.sources.tables import path_exists

FEED_SCHEMA = (
    "id bigint, status_nm string, create_dttm timestamp_ntz, update_dttm timestamp_ntz, operation string, "
    "stamp timestamp_ntz"
)
STAGE_SCHEMA = FEED_SCHEMA + ", hash_key binary, is_processed_flg boolean, stamp_day date"


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STAGE_SCHEMA).parquet(path).drop("stamp_day")


def append_unseen(batch: DataFrame, stage_path: str) -> None:
    """Append rows of the batch not yet staged; a repeated batch appends nothing.

    A staged row can only match on an equal stamp, so of the stage, partitioned by day, just the batch's days are read. A row
    without a stamp is an error.
    """
    spark = batch.sparkSession
    # one row per day of the batch
    days = [r.day for r in batch.select(F.to_date("stamp").alias("day")).distinct().collect()]
    if None in days:
        raise ValueError("a row of the feed has no stamp")
    if not days:
        return
    seen = None
    if path_exists(spark, stage_path):
        seen = spark.read.schema(STAGE_SCHEMA).parquet(stage_path).filter(F.col("stamp_day").isin(days))
    fresh = stage_new_changes(batch, seen).withColumn("stamp_day", F.to_date("stamp"))
    fresh.write.mode("append").partitionBy("stamp_day").parquet(stage_path)


def stage_available(spark: SparkSession, feed_path: str, stage_path: str, checkpoint: str, **options: str) -> None:
    """Stage all feed files that arrived since the last run."""
    feed = spark.readStream.schema(FEED_SCHEMA).options(**options).parquet(feed_path)
    query = (
        feed.writeStream.foreachBatch(lambda batch, _: append_unseen(batch, stage_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def load_available(table: HistoryTable, stage_path: str, checkpoint: str, **options: str) -> None:
    """Load all stage files that arrived since the last run. The checkpoint stands in for the processed flag; a batch that is
    repeated after a failure changes nothing, because its versions are in the table."""
    stage = table.spark.readStream.schema(STAGE_SCHEMA).options(**options).parquet(stage_path)
    query = (
        stage.writeStream.foreachBatch(lambda batch, _: table.load(batch.drop("stamp_day")) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
