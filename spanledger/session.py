"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "spanledger", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# sides of a join that are partitioned by some of its columns alike stay where they are
JOINS_IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for the actions run within the block."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster without one is an error, because
    a machine-local folder is lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="spanledger-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate that several later steps read, and read it back.

    The written columns stay prunable and the lineage is cut, so a lost executor re-reads files instead of
    recomputing the joins behind them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if getattr(_kept, "paths", None):
        _kept.paths[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


_kept = threading.local()


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Deletes what ``materialize`` wrote within the block, in this thread, when the block ends."""
    _kept.paths = [*getattr(_kept, "paths", []), []]
    try:
        yield
    finally:
        for path in _kept.paths.pop():
            _delete(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def release_materialized(spark: SparkSession) -> None:
    """Delete all intermediates of this application. Frames built on them cannot be read afterwards."""
    _delete(spark, _own_folder(spark))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
