"""Stored history: a Spark table bucketed and sorted by its key, written anew by each load.

A load scans the table once and shuffles only its batch, to the table's buckets. Each load writes a folder of its own; readers take
the newest one that is complete, so nothing that is being read is overwritten and a load that dies leaves the table as it was.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spanledger.operators.audit import append_audit, audit_rows, load_log
from spanledger.operators.change_data import (
    FROM,
    HISTORY,
    load_history,
    merge_load,
    observed_checks,
    observed_steps,
    unseen_changes,
    unsettled_keys,
)
from spanledger.scale import DEFAULT_POLICY, SkewPolicy, hot_keys, mark_hot
from spanledger.session import intermediates

SCHEMA = (
    "id bigint, status_nm string, create_dttm timestamp_ntz, hash_key binary, valid_from_dttm timestamp_ntz, "
    "valid_to_dttm timestamp_ntz, deleted_flg boolean, deleted_dttm timestamp_ntz"
)
KEY = "hash_key"


def _name(folder: str) -> str:
    """Catalog name of the table in a folder."""
    return f"history_{hashlib.md5(folder.encode()).hexdigest()}"


@dataclass
class Load:
    """A finished load: its number, what its steps did, what its checks found."""

    version: int
    steps: DataFrame
    checks: DataFrame


class HistoryTable:
    """``buckets``: of the versions this object writes; a version is read with the buckets it was written with. ``log``: folder of
    an audit log to which each load adds its start, steps, findings and end."""

    def __init__(
        self, spark: SparkSession, root: str, buckets: int = 256, policy: SkewPolicy = DEFAULT_POLICY, log: str | None = None
    ):
        self.spark, self.root, self.buckets, self.policy, self.log = spark, root, buckets, policy, log

    # --- versions ---

    def _folders(self, complete: bool = True) -> dict[int, tuple[str, int]]:
        """Version -> (folder, buckets); the newest two and those that failed."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(path):
            return {}
        found = {}
        for status in system.listStatus(path):
            named = re.fullmatch(r"version=(\d+)-buckets=(\d+)", status.getPath().getName())
            done = self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if named and (not complete or system.exists(done)):
                found[int(named[1])] = (f"{self.root}/{status.getPath().getName()}", int(named[2]))
        return found

    def version(self) -> int:
        return max(self._folders(), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        """The history after a load (the last one), as a scan of bucketed files."""
        folders = self._folders()
        version = max(folders, default=0) if version is None else version
        if version not in folders:
            return self.spark.createDataFrame([], SCHEMA)
        folder, buckets = folders[version]
        name = _name(folder)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({SCHEMA}) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}, {FROM}) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )
        return self.spark.table(name).select(*HISTORY)

    def _write(self, history: DataFrame) -> int:
        number = max(self._folders(complete=False), default=0) + 1
        folder = f"{self.root}/version={number}-buckets={self.buckets}"
        typed = history.select(*[F.col(c.split()[0]).cast(c.split()[1]) for c in SCHEMA.split(", ")])
        typed.write.bucketBy(self.buckets, KEY).sortBy(KEY, FROM).option("path", folder).saveAsTable(_name(folder))
        return number

    def _drop_before(self, version: int) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for number, (folder, _) in self._folders(complete=False).items():
            if number < version:
                self.spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")
                place = path(folder)
                place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)

    # --- loads ---

    def _to_buckets(self, batch: DataFrame) -> DataFrame:
        """The batch dealt like the stored files; only this is shuffled."""
        stored = self._folders().get(self.version())
        return batch.repartition(stored[1] if stored else self.buckets, KEY)

    def merged(
        self, batch: DataFrame, arrived: Observation | None = None, closed: Observation | None = None
    ) -> DataFrame:
        """The history with ``batch`` loaded. Hot keys go by time slots, apart from the others."""
        history = self.read()
        hot = hot_keys(history, [KEY], self.policy)
        if hot is None:
            return merge_load(history, self._to_buckets(batch), arrived=arrived, closed=closed)
        is_hot = F.col("_pieces").isNotNull()
        stored, coming = mark_hot(history, hot, [KEY]), mark_hot(batch, hot, [KEY])
        ordinary = merge_load(
            stored.filter(~is_hot).drop("_pieces"), self._to_buckets(coming.filter(~is_hot).drop("_pieces")),
            arrived=arrived, closed=closed,
        )
        large = stored.filter(is_hot).drop("_pieces")
        large = load_history(large, unseen_changes(coming.filter(is_hot).drop("_pieces"), large), policy=self.policy)
        return ordinary.unionByName(large.history)

    def load(self, stage: DataFrame, stamp: str | None = None) -> Load:
        """Load the unprocessed rows of ``stage`` as the next version. Steps and checks are counted while the version is written; with
        hot keys in the table they cover the other keys. ``stamp``: of the log rows, by default the present."""
        batch = stage.filter(~F.col("is_processed_flg"))
        before, arrived, closed, written = self.version(), Observation(), Observation(), Observation()
        with intermediates(self.spark):
            merged = self.merged(batch, arrived, closed).observe(written, F.count(F.lit(1)).alias("rows"))
            number = self._write(merged)
        self._drop_before(before)
        steps = observed_steps(self.spark, arrived.get, closed.get, written.get["rows"])
        checks = observed_checks(self.spark, arrived.get)
        if self.log is not None:
            at = F.current_timestamp().cast("timestamp_ntz") if stamp is None else F.lit(stamp).cast("timestamp_ntz")
            append_audit(self.spark, self.log, audit_rows(load_log(steps, checks, "stage", "history"), at))
        return Load(number, steps, checks)

    def changed(self, stage: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Versions of the keys that the last load (of ``stage``) may have changed, before and after it: the keys of its batch and
        those that the load before left unsettled. Both tables are scanned in their buckets, not shuffled."""
        after = self.version()
        before = max((v for v in self._folders() if v < after), default=0)
        keys = self._to_buckets(stage.select(KEY).distinct())
        touched = keys.unionByName(unsettled_keys(self.read(before)).select(KEY)).distinct()
        return tuple(self.read(v).join(touched, KEY, "left_semi") for v in (before, after))
