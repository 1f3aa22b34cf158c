"""Snapshot to history for tables that only offer their current content (job metadata)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import ntz
from spanledger.operators.change_data import capture_changes, close_and_coalesce
from spanledger.scale import DEFAULT_POLICY, SkewPolicy
from spanledger.session import materialize
from spanledger.sources.tables import snapshot_transfer


# a version goes through two windows and two aggregates of one task, some 2 KB with all columns of a metadata table
VERSIONS_PER_TASK = 250_000


@dataclass(frozen=True)
class SnapshotTable:
    """A table copied as a whole on every run: the columns to copy and the key its history follows."""

    columns: Sequence[str]
    key: Sequence[str]

    def transfer(self, source: DataFrame, target: str) -> DataFrame:
        return snapshot_transfer(source, self.columns, target)

    def history(self, history: DataFrame | None, old: DataFrame, new: DataFrame, stamp: Column) -> DataFrame:
        return snapshot_history(history, old.select(*self.columns), new.select(*self.columns), self.key, stamp)


DAG_CODE = SnapshotTable(C.DAG_CODE_COLUMNS, ["fileloc"])
DAG_INFORMATION = SnapshotTable(C.DAG_INFORMATION_COLUMNS, ["dag_id"])


def versions_from_changes(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Open versions for every change; a delete keeps its key only."""
    payload = [c for c in changes.columns if c not in (*key, "operation", "stamp")]
    deleted = F.col("operation") == "D"
    return changes.select(
        *key,
        *[F.when(~deleted, F.col(c)).alias(c) for c in payload],
        F.col("stamp").alias("valid_from_dttm"),
        ntz(C.OPEN_END).alias("valid_to_dttm"),
        deleted.alias("deleted_flg"),
        F.when(deleted, F.col("stamp")).alias("deleted_dttm"),
    )


def snapshot_history(
    history: DataFrame | None,
    old: DataFrame,
    new: DataFrame,
    key: Sequence[str],
    stamp: Column,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """History after one more snapshot: compare, append versions, close and coalesce."""
    versions = versions_from_changes(capture_changes(old, new, key, stamp), key)
    if history is not None:
        versions = history.unionByName(versions)
    versions = materialize(versions, "snapshot-versions")
    return close_and_coalesce(versions, key=key, policy=policy, task_rows=VERSIONS_PER_TASK)
