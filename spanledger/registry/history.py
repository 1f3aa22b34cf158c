"""Change capture, staging and versioned history."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanledger.functions import ntz
from spanledger.operators import change_data as D
from spanledger.operators.audit import LOG_SCHEMA
from spanledger.operators.digests import DigestedTable, capture_by_digest, whole_number_range
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import case
from spanledger.registry.sql_inputs import HISTORY_COLUMNS, OPEN
from spanledger.session import materialize, scratch_path
from spanledger.sources import fixtures as X
from spanledger.sources.history_table import HistoryTable
from spanledger.streaming.stage import load_available, read_stage, stage_available

STAMP = "2024-02-01 00:00:00"


def hex_key(df):
    return df.withColumn("hash_key", F.lower(F.hex("hash_key")))


def staged(spark, sf):
    return materialize(D.stage_new_changes(X.feed(spark, sf), None), "stage")


def batches(spark, sf):
    """The stage cut in two by stamp."""
    stage = staged(spark, sf)
    return before_cut(stage), stage.filter(F.col("stamp") >= ntz(X.SECOND_BATCH_FROM))


def before_cut(stage):
    return stage.filter(F.col("stamp") < ntz(X.SECOND_BATCH_FROM))


def loaded(spark, sf) -> D.LoadResult:
    return D.load_history(X.empty_history(spark), staged(spark, sf))


CAPTURED = """SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NULL THEN o.o_orderpriority ELSE n.o_orderpriority END AS o_orderpriority,
       CASE WHEN o.o_orderkey IS NULL THEN 'I' WHEN n.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS operation,
       TIMESTAMP '2024-02-01' AS stamp
FROM fx_old_snapshot o FULL OUTER JOIN fx_new_snapshot n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_custkey IS DISTINCT FROM n.o_custkey
   OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority"""


@case("capture_changes", CAPTURED)
def _(spark, sf):
    return D.capture_changes(X.old_snapshot(spark, sf), X.new_snapshot(spark, sf), ["o_orderkey"], ntz(STAMP))


@case("capture_changes_by_digest", CAPTURED)
def _(spark, sf):
    snapshots = X.old_snapshot(spark, sf), X.new_snapshot(spark, sf)
    low, high = snapshots[0].agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    of = whole_number_range("o_orderkey", low or 0, high or 0, 64)
    old, new = (DigestedTable.write(df, df.columns, of) for df in snapshots)
    return capture_by_digest(spark, old, new, ["o_orderkey"], ntz(STAMP))


@case(
    "metadata_snapshot_history",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, valid_from_dttm,
       lead(valid_from_dttm, 1, {OPEN}) OVER (PARTITION BY o_orderkey ORDER BY valid_from_dttm) AS valid_to_dttm,
       deleted_flg, deleted_dttm
FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, TIMESTAMP '2024-01-01' AS valid_from_dttm,
             FALSE AS deleted_flg, CAST(NULL AS TIMESTAMP) AS deleted_dttm FROM fx_old_snapshot
      UNION ALL
      SELECT o_orderkey, CASE WHEN operation <> 'D' THEN o_custkey END, CASE WHEN operation <> 'D' THEN o_orderstatus END,
             CASE WHEN operation <> 'D' THEN o_orderpriority END, stamp, operation = 'D',
             CASE WHEN operation = 'D' THEN stamp END FROM ({CAPTURED}) c) v""",
)
def _(spark, sf):
    from spanledger.plans.metadata import snapshot_history

    old, new = X.old_snapshot(spark, sf), X.new_snapshot(spark, sf)
    first = snapshot_history(None, old.limit(0), old, ["o_orderkey"], ntz("2024-01-01 00:00:00"))
    return snapshot_history(materialize(first, "metadata"), old, new, ["o_orderkey"], ntz(STAMP))


def _metadata_sql(table: str, value: str) -> str:
    pick = f"SELECT 'f' || CAST(o_orderkey AS VARCHAR) AS k, {value} AS v FROM"
    return f"""SELECT '{table}' AS table_name, k, v, valid_from_dttm,
       lead(valid_from_dttm, 1, {OPEN}) OVER (PARTITION BY k ORDER BY valid_from_dttm) AS valid_to_dttm, deleted_flg
FROM (SELECT k, v, TIMESTAMP '2024-01-01' AS valid_from_dttm, FALSE AS deleted_flg FROM ({pick} fx_old_snapshot) a
      UNION ALL
      SELECT coalesce(n.k, o.k), n.v, TIMESTAMP '2024-02-01', n.k IS NULL
      FROM ({pick} fx_old_snapshot) o FULL JOIN ({pick} fx_new_snapshot) n ON o.k = n.k
      WHERE n.k IS NULL OR o.k IS NULL OR o.v IS DISTINCT FROM n.v) versions"""


@case(
    "metadata_tables_history",
    _metadata_sql("dag_code", "coalesce(o_orderstatus, '-') || ':' || o_orderpriority")
    + "\nUNION ALL\n"
    + _metadata_sql("dag_information", "CAST(o_custkey AS VARCHAR) || coalesce(o_orderstatus, '-')"),
)
def _(spark, sf):
    """Both metadata tables from two copies of the source to their history."""
    from spanledger import constants as C
    from spanledger.plans.metadata import DAG_CODE, DAG_INFORMATION

    key = F.concat(F.lit("f"), F.col("o_orderkey").cast("string"))
    status = F.coalesce("o_orderstatus", F.lit("-"))
    other = {c: F.lit(None).cast("string") for c in C.DAG_INFORMATION_COLUMNS}
    filled = {
        "dag_code": (DAG_CODE, {"fileloc": key, "source_code": F.concat(status, F.lit(":"), "o_orderpriority")}, "source_code"),
        "dag_information": (
            DAG_INFORMATION, other | {"dag_id": key, "owners": F.concat(F.col("o_custkey").cast("string"), status)}, "owners"
        ),
    }
    parts = []
    for name, (table, columns, value) in filled.items():
        old, new = (
            table.transfer(frame.select(*[c.alias(n) for n, c in columns.items()]), scratch_path(spark, name))
            for frame in (X.old_snapshot(spark, sf), X.new_snapshot(spark, sf))
        )
        first = materialize(table.history(None, old.limit(0), old, ntz("2024-01-01 00:00:00")), name)
        parts.append(
            table.history(first, old, new, ntz(STAMP)).select(
                F.lit(name).alias("table_name"), F.col(table.key[0]).alias("k"), F.col(value).alias("v"),
                "valid_from_dttm", "valid_to_dttm", "deleted_flg",
            )
        )
    return parts[0].unionByName(parts[1])


@case(
    "null_aware_anti",
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM fx_new_snapshot
WHERE (o_orderkey, o_custkey, o_orderstatus) NOT IN (SELECT (o_orderkey, o_custkey, o_orderstatus) FROM fx_old_snapshot)
  AND NOT EXISTS (SELECT 1 FROM fx_old_snapshot o WHERE o.o_orderkey = fx_new_snapshot.o_orderkey
                  AND o.o_custkey = fx_new_snapshot.o_custkey
                  AND (o.o_orderstatus = fx_new_snapshot.o_orderstatus OR fx_new_snapshot.o_orderstatus IS NULL
                       OR o.o_orderstatus IS NULL))""",
)
def _(spark, sf):
    new = X.new_snapshot(spark, sf).select("o_orderkey", "o_custkey", "o_orderstatus")
    return D.null_aware_anti(new, X.old_snapshot(spark, sf), ["o_orderkey", "o_custkey"], ["o_orderstatus"])


def _with_nulls(table: str, side: int) -> str:
    return f"""(SELECT CASE WHEN o_orderkey % {997 + side} = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
        CASE WHEN o_orderkey % {11 + side} = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderstatus FROM {table})"""


def with_nulls(df, side: int):
    key = F.col("o_orderkey")
    return df.select(
        F.when(key % (997 + side) != 0, key).alias("o_orderkey"), F.when(key % (11 + side) != 0, F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
    )


@case(
    "not_in_any_nulls",
    f"""SELECT * FROM {_with_nulls("fx_new_snapshot", 0)} a WHERE NOT EXISTS (
  SELECT 1 FROM {_with_nulls("fx_old_snapshot", 2)} b
  WHERE (a.o_orderkey = b.o_orderkey OR a.o_orderkey IS NULL OR b.o_orderkey IS NULL)
    AND (a.o_custkey = b.o_custkey OR a.o_custkey IS NULL OR b.o_custkey IS NULL)
    AND (a.o_orderstatus = b.o_orderstatus OR a.o_orderstatus IS NULL OR b.o_orderstatus IS NULL))""",
)
def _(spark, sf):
    """No column is declared NOT NULL; NULLs stand in each, on both sides."""
    new, old = with_nulls(X.new_snapshot(spark, sf), 0), with_nulls(X.old_snapshot(spark, sf), 2)
    return D.not_in(new, old, ["o_orderkey", "o_custkey", "o_orderstatus"])


@case(
    "stage_new_changes",
    """SELECT id, status_nm, create_dttm, update_dttm, operation, stamp, hash_key, FALSE AS is_processed_flg FROM keyed_feed f
WHERE NOT EXISTS (SELECT 1 FROM fx_feed s WHERE s.stamp < TIMESTAMP '2024-01-16' AND s.id = f.id
  AND s.operation = f.operation AND s.stamp = f.stamp)""",
)
def _(spark, sf):
    feed = X.feed(spark, sf)
    stage = D.stage_new_changes(X.first_batch(feed), None)
    return hex_key(D.stage_new_changes(feed, stage))


@case("unprocessed_batch", "SELECT id, operation, stamp FROM fx_feed WHERE stamp >= TIMESTAMP '2024-01-16'")
def _(spark, sf):
    done = F.col("stamp") < ntz(X.SECOND_BATCH_FROM)
    stage = D.stage_new_changes(X.feed(spark, sf), None).withColumn("is_processed_flg", done)
    return D.unprocessed_batch(stage).select("id", "operation", "stamp")


@case("scd2_insert_new", f"SELECT {HISTORY_COLUMNS} FROM once_new")
def _(spark, sf):
    return hex_key(D.insert_new(staged(spark, sf), D.history_keys(X.empty_history(spark)))).select(*D.HISTORY)


@case("scd2_insert_changes", f"SELECT {HISTORY_COLUMNS} FROM part2_changes")
def _(spark, sf):
    first, second = batches(spark, sf)
    history = D.load_history(X.empty_history(spark), first).history
    known = D.history_keys(history)
    return hex_key(D.insert_changes(second, known.unionByName(D.history_keys(D.insert_new(second, known))))).select(
        *D.HISTORY
    )


@case("scd2_close", f"SELECT {HISTORY_COLUMNS} FROM once_closed")
def _(spark, sf):
    stage = staged(spark, sf)
    new = D.insert_new(stage, D.history_keys(X.empty_history(spark)))
    versions = materialize(new.unionByName(D.insert_changes(stage, D.history_keys(new))), "versions")
    return hex_key(D.close_versions(versions)).select(*D.HISTORY)


@case("scd2_coalesce", f"SELECT {HISTORY_COLUMNS} FROM once_history")
def _(spark, sf):
    stage = staged(spark, sf)
    new = D.insert_new(stage, D.history_keys(X.empty_history(spark)))
    versions = materialize(new.unionByName(D.insert_changes(stage, D.history_keys(new))), "versions")
    return hex_key(D.coalesce_versions(materialize(D.close_versions(versions), "closed")))


@case(
    "mark_processed",
    """SELECT id, operation, stamp, hash_key, stamp < TIMESTAMP '2024-01-16' AS is_processed_flg FROM keyed_feed""",
)
def _(spark, sf):
    stage = staged(spark, sf)
    marked = D.mark_processed(stage, before_cut(stage))
    return hex_key(marked).select("id", "operation", "stamp", "hash_key", "is_processed_flg")


@case("load_history", f"SELECT {HISTORY_COLUMNS} FROM once_history")
def _(spark, sf):
    return hex_key(loaded(spark, sf).history)


def loaded_table(spark, sf, **options) -> tuple[HistoryTable, list]:
    """A stored history after two loads, and the batches."""
    parts = batches(spark, sf)
    table = HistoryTable(spark, scratch_path(spark, "history-table"), buckets=16, **options)
    for batch, stamp in zip(parts, LOAD_STAMPS):
        table.load(batch, stamp)
    return table, list(parts)


LOAD_STAMPS = ["2024-01-16 00:00:00", "2024-02-01 00:00:00"]


@case("load_history_incremental", f"SELECT {HISTORY_COLUMNS} FROM part2_history")
def _(spark, sf):
    """Two loads into a bucketed table, which only the batch is shuffled for."""
    return hex_key(loaded_table(spark, sf)[0].read()).select(*D.HISTORY)


def staged_by_stream(spark, sf) -> str:
    """Write the feed as files in two drops and stage them with the streaming job."""
    root = scratch_path(spark, "stream")
    feed = X.feed(spark, sf).withColumn("drop", (F.col("stamp") >= ntz(X.SECOND_BATCH_FROM)).cast("int"))
    feed.write.partitionBy("drop").parquet(f"{root}/feed")
    for _ in range(2):
        stage_available(spark, f"{root}/feed/*", f"{root}/stage", f"{root}/stage-checkpoint")
    return root


@case("stage_new_changes_stream", "SELECT id, operation, stamp, hash_key FROM keyed_feed")
def _(spark, sf):
    stage = read_stage(spark, f"{staged_by_stream(spark, sf)}/stage")
    return hex_key(stage).select("id", "operation", "stamp", "hash_key")


@case("load_history_stream", f"SELECT {HISTORY_COLUMNS} FROM once_history")
def _(spark, sf):
    root = staged_by_stream(spark, sf)
    table = HistoryTable(spark, f"{root}/history", buckets=16)
    load_available(table, f"{root}/stage", f"{root}/history-checkpoint")
    return hex_key(table.read())


@case("load_steps", """SELECT 'new entities' AS message, 0 AS category, 'insert' AS type_operation, count(*) AS count_row FROM once_new
UNION ALL SELECT 'changes of known entities', 0, 'insert', count(*) FROM once_changes
UNION ALL SELECT 'version ends', 0, 'update', count(*) FROM once_versions
UNION ALL SELECT 'merged versions', 1, '', (SELECT count(*) FROM once_versions) - (SELECT count(*) FROM once_history)
UNION ALL SELECT 'stage rows marked', 0, 'update', count(*) FROM once_batch""")
def _(spark, sf):
    return loaded(spark, sf).steps


@case("current_state", "SELECT * FROM recovered")
def _(spark, sf):
    return D.current_state(loaded(spark, sf).history)


def _checks_sql(load: str) -> str:
    return f"""SELECT 'check_new_status' AS check_name, 2 AS category, count(hash_key) AS n FROM {load}_batch
WHERE operation = 'I' AND status_nm <> 'accepted' AND hash_key NOT IN (SELECT hash_key FROM {load}_before)
UNION ALL
SELECT 'check_update_finished', 2, count(s.hash_key) FROM {load}_batch s,
  (SELECT hash_key, coalesce(status_nm, 'complited') AS status_nm FROM {load}_known WHERE valid_to_dttm = {OPEN}) h
WHERE s.operation = 'U' AND h.status_nm IN ('complited', 'canselled') AND s.hash_key = h.hash_key
UNION ALL
SELECT 'check_delete_unfinished', 2, count(hash_key) FROM {load}_batch
WHERE operation = 'D' AND status_nm NOT IN ('complited', 'canselled') AND hash_key IN (SELECT hash_key FROM {load}_known)
UNION ALL
SELECT 'check_unknown_entity', 3, count(hash_key) FROM {load}_batch
WHERE operation IN ('U', 'D') AND hash_key NOT IN (SELECT hash_key FROM {load}_known)"""


CHECKS = _checks_sql("part2")


def _log_sql(load: str, stamp: str) -> str:
    return f"""SELECT message, category, type_operation, n AS count_row, 'stage' AS source, 'history' AS destination,
       TIMESTAMP '{stamp}' AS stamp
FROM (SELECT 'start' AS message, 0 AS category, '' AS type_operation, 0 AS n UNION ALL SELECT 'stop', 0, '', 0
      UNION ALL SELECT 'new entities', 0, 'insert', count(*) FROM {load}_new
      UNION ALL SELECT 'changes of known entities', 0, 'insert', count(*) FROM {load}_changes
      UNION ALL SELECT 'version ends', 0, 'update', count(*) FROM {load}_versions WHERE valid_to_dttm = {OPEN}
      UNION ALL SELECT 'merged versions', 1, '', (SELECT count(*) FROM {load}_versions) - (SELECT count(*) FROM {load}_history)
      UNION ALL SELECT 'stage rows marked', 0, 'update', count(*) FROM {load}_batch
      UNION ALL SELECT check_name, category, '', n FROM ({_checks_sql(load)}) c WHERE n > 0) l
WHERE NOT (type_operation IN ('insert', 'update') AND n = 0)"""


@case("load_audit", "\nUNION ALL\n".join(_log_sql(f"part{k + 1}", stamp) for k, stamp in enumerate(LOAD_STAMPS)))
def _(spark, sf):
    """The audit log that two loads leave, its counts observed while the history is written."""
    path = scratch_path(spark, "load-log")
    loaded_table(spark, sf, log=path)
    return spark.read.schema(LOG_SCHEMA).parquet(path).drop("id")


def second_load_checks(spark, sf):
    first, second = batches(spark, sf)
    history = D.load_history(X.empty_history(spark), first).history
    return D.history_checks(second, materialize(history, "history"))


@case("load_checks", CHECKS)
def _(spark, sf):
    return second_load_checks(spark, sf)


for _name in ["check_new_status", "check_update_finished", "check_delete_unfinished", "check_unknown_entity"]:

    @case(_name, f"SELECT n AS result FROM ({CHECKS}) c WHERE check_name = '{_name}'")
    def _(spark, sf, name=_name):
        return second_load_checks(spark, sf).filter(F.col("check_name") == name).select(F.col("n").alias("result"))
