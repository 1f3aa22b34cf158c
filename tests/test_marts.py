"""Mart steps: quirks kept on purpose, calendars, reports, accounts, tables, audit."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import code_score, ntz
from spanledger.operators.audit import LOG_SCHEMA, audit_view, write_audit
from spanledger.operators.calendar import date_series, dim_date
from spanledger.plans import phone as P
from spanledger.plans import requests as R
from spanledger.plans.accounts import describe_accounts
from spanledger.session import materialize
from spanledger.sources import tables as S


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


FIRST, LAST = date(1900, 1, 1), date(2999, 12, 31)
CONTACT = (
    "counterparty_rk int, contact_type_cd string, contact_desc string, contact_quality_code string, "
    "trust_system_flg boolean, src_cd string, effective_from_date date, effective_to_date date"
)


def phone_mart(spark, contacts, policy, links=((1, 1), (2, 2), (3, 3))):
    ids = sorted({c[0] for c in contacts} | {b for _, b in links})
    customers = spark.createDataFrame(
        [(i, "1", "MDMP", FIRST, LAST) for i in ids],
        "counterparty_rk int, counterparty_type_cd string, src_cd string, effective_from_date date, effective_to_date date",
    )
    kinds = spark.createDataFrame(
        [("1", C.INDIVIDUAL, "MDMP", FIRST, LAST)],
        "counterparty_type_cd string, counterparty_type_desc string, src_cd string, effective_from_date date, "
        "effective_to_date date",
    )
    xref = spark.createDataFrame(
        [(a, b, "RTLL", FIRST, LAST) for a, b in links],
        "counterparty_rk int, uniq_counterparty_rk int, src_cd string, effective_from_date date, effective_to_date date",
    )
    return P.PhoneMart(customers, kinds, spark.createDataFrame(contacts, CONTACT), xref, policy)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_shared_phone_has_one_main_customer(spark, policy):
    mart = phone_mart(
        spark,
        [
            (1, "HomePhone", "p", "GOOD", False, "RTLL", day(0), day(10)),
            (2, "HomePhone", "p", "BAD", True, "RTLL", day(5), day(15)),
        ],
        policy,
    ).mart()
    got = rows(mart, "mdm_customer_rk", "business_start_dt", "business_end_dt", "duplication_flg", "main_dup_flg")
    assert got == [
        (1, day(0), day(5), False, True),
        (1, day(5), day(10), True, False),
        (2, day(10), day(15), False, True),
        (2, day(5), day(10), True, True),
    ]


def test_unlisted_type_has_no_weight_and_no_flags(spark, policy):
    mart = phone_mart(spark, [(1, "Pigeon", "p", "GOOD", True, "MDMP", day(0), day(3))], policy).mart()
    assert rows(mart, "main_dup_flg", "main_phone_flg") == [(False, False)]


def test_zero_length_survives_joins_but_not_fragmenting(spark, policy):
    mart = phone_mart(
        spark,
        [
            (1, "HomePhone", "p", "GOOD", True, "MDMP", day(0), day(0)),
            (1, "HomePhone", "p", "GOOD", True, "MDMP", day(0), day(2)),
        ],
        policy,
    )
    assert mart.ranked().count() == 2
    assert rows(mart.mart(), "business_start_dt", "business_end_dt") == [(day(0), day(2))]


def test_sources_are_filtered_before_ranking(spark, policy):
    mart = phone_mart(
        spark,
        [
            (1, "HomePhone", "p", "GOOD", True, "OTHR", day(0), day(9)),
            (1, "HomePhone", "p", "GOOD", True, "RTLL", day(1), day(9)),
        ],
        policy,
    )
    assert rows(mart.ranked(), "rang_start_phone_num", "rang_start_client_num") == [(1, 1)]


def test_rank_carries_into_the_digits_above(spark):
    ranks = [(1, 1, 1, 5, 5, 3), (1, 1, 1, 5, 5, 10003)]
    df = spark.createDataFrame(ranks, "d int, range_trust_num int, range_quality_num int, range_src_num int, range_type_num int, r int")
    got = [r.w for r in df.select(P._weight(F.col("d"), "r").alias("w")).collect()]
    assert got == [111550003, 111560003]


def test_code_score(spark):
    df = spark.createDataFrame([("WAYN",), ("OTHR",)], "s string")
    assert [r.x for r in df.select(code_score(F.col("s"), C.SOURCE_SCORE).alias("x")).collect()] == [4, None]


def test_calendar_2023(spark):
    cal = {
        r.date_actual: r
        for r in dim_date(date_series(spark, "2023-01-01", "2023-12-31"), C.HOLIDAYS_2023, C.MOVED_DAYS_OFF_2023).collect()
    }
    assert len(cal) == 365 and sum(r.is_holiday for r in cal.values()) == 14
    new_year = cal[date(2023, 1, 1)]
    assert (new_year.date_key, new_year.week, new_year.day_of_week, new_year.is_weekday) == (20230101, 52, 7, True)
    assert cal[date(2023, 2, 24)].is_weekday and not cal[date(2023, 2, 22)].is_weekday


HIST = (
    "id int, status_nm string, create_dttm date, hash_key binary, valid_from_dttm date, valid_to_dttm date, "
    "deleted_flg boolean, deleted_dttm date"
)


def test_dim_work_counts(spark):
    k = b"k"
    history = [
        (1, "accepted", day(0), k, day(0), day(1), False, None),
        (1, "executed", day(0), k, day(1), day(3), False, None),
        (1, "paused", day(0), k, day(3), LAST, False, None),
        (2, "executed", day(0), k, day(-30), day(0), False, None),
        (2, None, day(0), k, day(2), LAST, True, day(2)),
        (3, "executed", day(0), k, day(2), day(2), False, None),
        (4, "executed", day(0), k, day(40), day(50), False, None),
    ]
    days = date_series(spark, "2024-01-01", "2024-01-05").filter(F.dayofmonth("date_actual") != 4)
    work = R.dim_work(dim_date(days), spark.createDataFrame(history, HIST)).orderBy("date_actual").collect()
    assert [r.date_actual.day for r in work] == [1, 2, 3, 5]
    assert [r.accepted_per_day for r in work] == [1, 0, 0, 0]
    assert [r.deleted_per_day for r in work] == [0, 0, 1, 0]
    assert [r.executed_during_day for r in work] == [1, 1, 2, 0]
    assert [r.paused_during_day for r in work] == [0, 0, 0, 1]
    assert [r.complited_per_day for r in work] == [0, 0, 0, 0]


def test_correlation_oddities(spark):
    values = [(day(i), i, i * i, 5 - i, i % 2, 7, i * 3, i % 3) for i in range(6)]
    work = spark.createDataFrame(values, "date_actual date, " + ", ".join(f"{m} int" for m in C.MEASURES))
    got = {r.agg_name: r for r in R.corr_matrix(work, F.lit(day(3))).collect()}
    strict = {r.agg_name: r for r in R.corr_matrix(work, F.lit(day(3)), strict=True).collect()}
    assert got["complited_per_day"].complited_per_day == pytest.approx(1)
    assert got["deleted_per_day"].complited_per_day is None
    assert got["canselled_per_day"].executed_during_day == got["complited_per_day"].executed_during_day
    assert strict["canselled_per_day"].executed_during_day != strict["complited_per_day"].executed_during_day
    assert got["paused_during_day"].complited_per_day == pytest.approx(strict["paused_during_day"].complited_per_day)
    assert strict["accepted_per_day"].complited_per_day == pytest.approx(-1)


PLAN = "account_plan_cd string, account_plan_name string, effective_from_date date, effective_to_date date"


def test_account_description(spark):
    accounts = spark.createDataFrame([("40817x", None), ("45206x", "old")], "account_rk string, account_descr string")
    plan = spark.createDataFrame([("408", "retail", FIRST, LAST), ("40817", "cards", FIRST, LAST), ("452", "loans", FIRST, LAST)], PLAN)
    assert rows(describe_accounts(accounts, plan), "account_rk", "account_descr") == [
        ("40817x", "retail / cards"),
        ("45206x", None),
    ]


def test_two_dictionary_rows_for_a_used_prefix_fail(spark):
    accounts = spark.createDataFrame([("40817x", None)], "account_rk string, account_descr string")
    plan = [("408", "old", FIRST, day(0)), ("408", "new", day(1), LAST), ("40817", "cards", FIRST, LAST)]
    unused = [("999", "a", FIRST, LAST), ("999", "b", FIRST, LAST)]
    df = spark.createDataFrame(plan + unused, PLAN)
    with pytest.raises(PySparkException):
        describe_accounts(accounts, df).collect()
    dated = describe_accounts(accounts, df, as_of=F.lit(day(5)))
    assert rows(dated, "account_descr") == [("new / cards",)]


def test_defaults_keep_explicit_nulls(spark):
    df = spark.createDataFrame([(1, None)], "id int, effective_to_date date")
    row = S.apply_defaults(df, S.validity_defaults() | S.technical_defaults()).first()
    assert row.effective_to_date is None and row.effective_from_date == FIRST and row.deleted_flg is False
    assert row.user and row.processed_dttm


def test_seeds_and_update(spark):
    target = S.seed_rows(spark, [(1, "a"), (2, "b")], ["id", "v"])
    source = S.seed_rows(spark, [(2, "B"), (3, "C")], ["id", "v"])
    assert rows(S.update_from(target, source, ["id"], ["v"]), "id", "v") == [(1, "a"), (2, "B")]
    cleared = source.withColumn("v", F.lit(None).cast("string"))
    assert rows(S.update_from(target, cleared, ["id"], ["v"]), "id", "v") == [(1, "a"), (2, None)]


def test_snapshot_transfer_replaces(spark, tmp_path):
    path = f"{tmp_path}/t"
    S.snapshot_transfer(spark.range(5).withColumn("x", F.lit(1)), ["id"], path)
    again = S.snapshot_transfer(spark.range(2), ["id"], path)
    assert again.columns == ["id"] and again.count() == 2


def test_audit_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    stamp = ntz("2024-01-01 00:00:00")
    assert write_audit(spark, path, "job()", "table", type_operation="insert", count_row=3, stamp=stamp)
    assert not write_audit(spark, path, "job()", "table", type_operation="insert", count_row=0, stamp=stamp)
    assert write_audit(spark, path, "job()", type_operation="start")
    assert write_audit(spark, path, "oltp_src_system.mod_x()", type_operation="start")
    assert write_audit(spark, path, "oltp_src_system.modXy()", type_operation="start")
    log = spark.read.schema(LOG_SCHEMA).parquet(path)
    assert [(r.id, r.source) for r in audit_view(log).collect()] == [(2, "job()"), (1, "job()")]
    assert log.filter("id = 1").first().stamp == datetime(2024, 1, 1)


def test_materialize_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), b"x")], "a int, t timestamp_ntz, b binary")
    kept = materialize(df, "kept")
    assert kept.dtypes == df.dtypes and kept.collect() == df.collect()


def test_release_deletes_intermediates(spark):
    from pathlib import Path

    from spanledger.session import release_materialized

    file = Path(materialize(spark.range(3), "gone").inputFiles()[0].removeprefix("file:").replace("///", "/"))
    assert file.exists()
    release_materialized(spark)
    assert not file.exists()


def test_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from spanledger.session import shared_folder

    fake = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: None), sparkContext=SimpleNamespace(master="yarn")
    )
    with pytest.raises(RuntimeError):
        shared_folder(fake)
