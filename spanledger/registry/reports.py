"""Request marts, reports, accounts and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import ntz
from spanledger.operators import change_data as D
from spanledger.operators.audit import LOG_SCHEMA, append_audit, audit_rows, audit_view
from spanledger.operators.calendar import dim_date
from spanledger.operators.digests import DigestedTable, difference_by_digest, whole_number_range
from spanledger.plans import requests as R
from spanledger.plans.accounts import describe_accounts
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import case
from spanledger.registry.history import hex_key, loaded, loaded_table
from spanledger.session import materialize, scratch_path
from spanledger.sources import fixtures as X

HOLIDAYS = ["2024-01-01", "2024-02-23", "2024-05-09"]
MOVED = ["2024-04-29", "2024-04-30"]


def calendar(spark, sf):
    return dim_date(X.event_calendar_days(spark, sf), HOLIDAYS, MOVED)


def work(spark, sf):
    return R.dim_work(calendar(spark, sf), R.history_day_grain(loaded(spark, sf).history))


@case("dim_date", "SELECT * FROM calendar")
def _(spark, sf):
    return calendar(spark, sf)


@case("history_day_grain", "SELECT * FROM day_history")
def _(spark, sf):
    return hex_key(R.history_day_grain(loaded(spark, sf).history))


@case("dim_work", "SELECT * FROM work")
def _(spark, sf):
    return work(spark, sf)


@case(
    "conditional_daily_counts",
    """SELECT day, count(*) FILTER (m = 'complited') AS complited, count(*) FILTER (m = 'canselled') AS canselled,
       count(*) FILTER (m = 'accepted') AS accepted, count(*) FILTER (m = 'paused') AS paused,
       count(*) FILTER (m = 'deleted') AS deleted
FROM (SELECT valid_from_dttm AS day, status_nm AS m FROM day_history WHERE status_nm IS NOT NULL AND status_nm <> 'executed'
      UNION ALL SELECT deleted_dttm, 'deleted' FROM day_history WHERE deleted_flg) e GROUP BY day""",
)
def _(spark, sf):
    history = R.history_day_grain(loaded(spark, sf).history)
    days = F.array(F.to_date("valid_from_dttm"), F.to_date("deleted_dttm"))
    # one row: the days on which anything starts or is deleted
    bounds = history.agg(F.min(F.array_min(days)), F.max(F.array_max(days))).first()
    first, last = (str(d or "1970-01-01") for d in bounds)
    starts = [m for m in C.MEASURES if m.endswith("_per_day")]
    daily = R.daily_measures(history, first, last).select(
        "day", *[F.col(m).alias(m.removesuffix("_per_day")) for m in starts]
    )
    return daily.filter(F.expr(" + ".join(m.removesuffix("_per_day") for m in starts)) > 0)


@case(
    "calendar_left_joins",
    """SELECT c.date_actual, coalesce(e.n, 0) AS events, coalesce(s.n, 0) AS signups FROM calendar c
LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1) e ON c.date_actual = e.d
LEFT JOIN (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1) s
  ON c.date_actual = s.d""",
)
def _(spark, sf):
    daily = (
        X.table(spark, sf, "events")
        .groupBy(F.to_date("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "signup").alias("signups"))
    )
    joined = calendar(spark, sf).join(daily, F.col("date_actual") == F.col("day"), "left")
    return joined.select("date_actual", *[F.coalesce(c, F.lit(0)).alias(c) for c in ["events", "signups"]])


@case(
    "agg_per_week",
    """SELECT day_of_week, CAST(sum(complited_per_day) AS BIGINT) AS complited, CAST(sum(canselled_per_day) AS BIGINT) AS canselled,
       CAST(sum(accepted_per_day) AS BIGINT) AS accepted, CAST(sum(paused_per_day) AS BIGINT) AS paused,
       CAST(sum(deleted_per_day) AS BIGINT) AS deleted, CAST(sum(executed_during_day) AS BIGINT) AS executed_during_day,
       CAST(sum(paused_during_day) AS BIGINT) AS paused_during_day
FROM work GROUP BY day_of_week ORDER BY day_of_week""",
)
def _(spark, sf):
    return R.agg_per_week(work(spark, sf))


@case("history_day_grain_refreshed", "SELECT * FROM day_history_2")
def _(spark, sf):
    """The day-grain table of a history after one load; after the second, only months it touched are replaced."""
    table, (_, second) = loaded_table(spark, sf)
    path = scratch_path(spark, "day-grain")
    grain = R.with_month(R.history_day_grain(table.read(table.version() - 1)))
    grain.write.partitionBy(R.MONTH).parquet(path)
    R.refresh_day_grain(table.read(), *table.changed(second), path)
    return hex_key(spark.read.schema(grain.schema).parquet(path).drop(R.MONTH))


def kept_up(spark, sf):
    """Daily step totals of a stored history after one load, brought up to the second by the keys it touched."""
    table, (first, second) = loaded_table(spark, sf)
    before, after = table.changed(second)
    old = materialize(R.step_totals(R.history_day_grain(table.read(table.version() - 1))), "daily-steps")
    return R.keep_up_steps(old, R.history_day_grain(before), R.history_day_grain(after))


@case("dim_work_kept_up", "SELECT * FROM work_2")
def _(spark, sf):
    return R.work_from_steps(calendar(spark, sf), kept_up(spark, sf))


@case(
    "agg_per_week_kept_up",
    """SELECT day_of_week, CAST(sum(complited_per_day) AS BIGINT) AS complited, CAST(sum(canselled_per_day) AS BIGINT) AS canselled,
       CAST(sum(accepted_per_day) AS BIGINT) AS accepted, CAST(sum(paused_per_day) AS BIGINT) AS paused,
       CAST(sum(deleted_per_day) AS BIGINT) AS deleted, CAST(sum(executed_during_day) AS BIGINT) AS executed_during_day,
       CAST(sum(paused_during_day) AS BIGINT) AS paused_during_day
FROM work_2 GROUP BY day_of_week""",
)
def _(spark, sf):
    return R.agg_per_week(R.work_from_steps(calendar(spark, sf), kept_up(spark, sf)))


def _corr_sql(strict: bool) -> str:
    rows = []
    for row in C.MEASURES:
        cells = []
        for column in C.MEASURES:
            left = row
            if not strict and row == "canselled_per_day" and column.endswith("_during_day"):
                left = "complited_per_day"
            value = f"corr({left}, {column})"
            cells.append(f"round(CASE WHEN isnan({value}) THEN NULL ELSE {value} END, 6) + 0.0::DOUBLE AS {column}")
        where = " WHERE date_actual <= DATE '2024-01-20'" if strict or row == "paused_during_day" else ""
        rows.append(f"SELECT '{row}' AS agg_name, {', '.join(cells)} FROM work{where}")
    return "\nUNION\n".join(rows)


def _rounded(matrix):
    return matrix.select("agg_name", *[F.round(m, 6).alias(m) for m in C.MEASURES])


@case("corr_matrix", _corr_sql(False))
def _(spark, sf):
    return _rounded(R.corr_matrix(work(spark, sf), F.lit(X.AS_OF).cast("date")))


@case("corr_matrix_strict", _corr_sql(True))
def _(spark, sf):
    return _rounded(R.corr_matrix(work(spark, sf), F.lit(X.AS_OF).cast("date"), strict=True))


#: Key ranges of a table compared by digests.
RANGES = 64


def _reconcile(spark, sf):
    recovered = D.current_state(loaded(spark, sf).history)
    return recovered, X.request_source(X.feed(spark, sf))


RECONCILED = """SELECT 'report' AS source, a.* FROM recovered a EXCEPT SELECT 'report' AS source, b.* FROM fx_source b
UNION SELECT 'src' AS source, b.* FROM fx_source b EXCEPT SELECT 'src' AS source, a.* FROM recovered a"""


@case("reconcile_full", RECONCILED)
def _(spark, sf):
    return R.difference_full(*_reconcile(spark, sf))


@case(
    "reconcile_partial",
    """SELECT 'report' AS source, a.id, a.status_nm, a.create_dttm FROM recovered a
EXCEPT SELECT 'report' AS source, b.id, b.status_nm, b.create_dttm FROM fx_source b
UNION SELECT 'src' AS source, b.id, b.status_nm, b.create_dttm FROM fx_source b
EXCEPT SELECT 'src' AS source, a.id, a.status_nm, a.create_dttm FROM recovered a""",
)
def _(spark, sf):
    return R.difference_partial(*_reconcile(spark, sf))


@case("reconcile_full_by_digest", RECONCILED)
def _(spark, sf):
    recovered, source = _reconcile(spark, sf)
    low, high = source.agg(F.min("id"), F.max("id")).first()
    of = whole_number_range("id", low or 0, high or 0, RANGES)
    a, b = (DigestedTable.write(df, ["id", "status_nm", "create_dttm", "update_dttm"], of) for df in (recovered, source))
    return difference_by_digest(spark, a, b)


@case(
    "account_descr",
    """SELECT account_rk, counterparty_rk, account_currency_cd,
       (SELECT account_plan_name FROM fx_plan p WHERE p.account_plan_cd = substring(a.account_rk, 1, 3)) || ' / ' ||
       (SELECT account_plan_name FROM fx_plan p WHERE p.account_plan_cd = substring(a.account_rk, 1, 5)) AS account_descr
FROM fx_account a""",
)
def _(spark, sf):
    accounts = X.accounts(spark, sf)
    return describe_accounts(accounts, materialize(X.account_plan(accounts), "plan"))


@case(
    "write_audit",
    """SELECT category, source, destination, message, type_operation, count_row, TIMESTAMP '2024-01-20' AS stamp FROM fx_log
WHERE NOT (type_operation IN ('insert', 'update', 'delete') AND count_row = 0)""",
)
def _(spark, sf):
    path = scratch_path(spark, "log")
    append_audit(spark, path, audit_rows(X.audit_log(spark, sf), ntz(X.AS_OF + " 00:00:00")))
    return spark.read.schema(LOG_SCHEMA).parquet(path).drop("id")


@case("audit_view", r"SELECT * FROM fx_log WHERE source NOT LIKE 'oltp_src_system.mod_%' ORDER BY id DESC")
def _(spark, sf):
    return audit_view(X.audit_log(spark, sf))
