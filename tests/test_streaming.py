"""Streaming loads give the batch result, also when a batch is repeated."""

import os

import pytest
from pyspark.sql import functions as F

from spanledger.operators import change_data as D
from spanledger.sources.fixtures import empty_history
from spanledger.session import shared_folder
from spanledger.sources.history_table import HistoryTable
from spanledger.streaming import stage as S
from tests.test_history import FEED, at, change, random_feed, versions


def drop(spark, rows, path, number):
    df = spark.createDataFrame(rows, FEED).withColumn("id", F.col("id").cast("long"))
    df.coalesce(1).write.parquet(f"{path}/part={number}")


def test_stream_equals_batch(spark, tmp_path):
    feed, stage, root = f"{tmp_path}/feed", f"{tmp_path}/stage", f"{tmp_path}/history"
    first, second = random_feed(21)
    table = HistoryTable(spark, root, buckets=4)
    for number, rows in enumerate([first, second]):
        drop(spark, rows, feed, number)
        S.stage_available(spark, f"{feed}/*", stage, f"{tmp_path}/c1")
        S.load_available(table, stage, f"{tmp_path}/c2")
    whole = D.load_history(empty_history(spark), D.stage_new_changes(spark.createDataFrame(first + second, FEED), None))
    assert versions(table.read()) == versions(whole.history)
    # the same rows again: nothing new is staged, nothing changes
    S.append_unseen(spark.createDataFrame(second, FEED), stage)
    assert S.read_stage(spark, stage).count() == len(first) + len(second)
    before = versions(table.read())
    S.load_available(table, stage, f"{tmp_path}/c2")
    assert versions(table.read()) == before


def test_streams_and_loads_by_hand_meet(spark, tmp_path):
    """A second stream, a new checkpoint and a load by hand lose nothing; a repeated batch changes nothing."""
    table = HistoryTable(spark, f"{tmp_path}/history", buckets=4)
    for name, ids in (("one", (1, 2)), ("two", (3, 4))):
        drop(spark, [change(i, "accepted", "I", i) for i in ids], f"{tmp_path}/{name}", 0)
        S.stage_available(spark, f"{tmp_path}/{name}/*", f"{tmp_path}/stage-{name}", f"{tmp_path}/c-{name}")
        S.load_available(table, f"{tmp_path}/stage-{name}", f"{tmp_path}/l-{name}")
        by_hand = spark.createDataFrame([change(10 + ids[0], "accepted", "I", 9)], FEED)
        table.load(D.stage_new_changes(by_hand, None))
    before = versions(table.read())
    assert {v[0] for v in before} == {1, 2, 3, 4, 11, 13}
    table.load(S.read_stage(spark, f"{tmp_path}/stage-one"))
    assert versions(table.read()) == before


def test_rows_without_a_stamp_are_refused(spark, tmp_path):
    rows = [(5, "accepted", at(0), at(0), "I", None)]
    with pytest.raises(ValueError):
        S.append_unseen(spark.createDataFrame(rows, FEED), f"{tmp_path}/stage")


def test_a_load_leaves_no_intermediates(spark, tmp_path):
    held = spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark)
    found = f"{held.removeprefix('file://').removeprefix('file:')}/{spark.sparkContext.applicationId}"
    before = set(os.listdir(found)) if os.path.isdir(found) else set()
    feed = [change(i, "accepted", "I", 0) for i in range(5)]
    HistoryTable(spark, f"{tmp_path}/h", buckets=2).load(D.stage_new_changes(spark.createDataFrame(feed, FEED), None))
    assert set(os.listdir(found)) == before
