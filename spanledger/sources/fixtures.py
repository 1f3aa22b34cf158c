"""Operator inputs derived from the supplied tables, so that every query grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import ntz
from spanledger.scale import salted_join
from spanledger.sources.tables import seed_rows

OLD_SNAPSHOT_END = "1998-01-01 00:00:00"
NEW_SNAPSHOT_START = "1996-01-01 00:00:00"
SECOND_BATCH_FROM = "2024-01-16 00:00:00"
AS_OF = "2024-01-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_event_type(*values: str):
    kinds = ["click", "view", "signup", "purchase", "error"]
    return F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in zip(kinds, values)])


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    sources = F.array(*[F.lit(s) for s in ["MDMP", "WAYN", "RTLL", "RTLS", "CFTB", "OTHR"]])
    day = F.to_date("ts")
    return e.select(
        user.alias("counterparty_rk"),
        _by_event_type(
            "NotificPhone", "ATMPhone", "MobilePersonalPhone", "MobileWorkNumber", "HomePhone"
        ).alias("contact_type_cd"),
        F.concat(
            F.lit("+7-"), (user - user % 2).cast("string"), F.lit("-"), (event % 4).cast("string")
        ).alias("contact_desc"),
        F.when(event % 3 == 0, "GOOD_1").otherwise("BAD").alias("contact_quality_code"),
        (F.col("value") > 20).alias("trust_system_flg"),
        F.get(sources, (event % 6).cast("int")).alias("src_cd"),
        day.alias("effective_from_date"),
        F.date_add(day, (event % 20 + 1).cast("int")).alias("effective_to_date"),
    )


def counterparties(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("counterparty_rk")).distinct()
    return users.select(
        "counterparty_rk",
        F.when(F.col("counterparty_rk") % 5 == 0, "0").otherwise("1").alias("counterparty_type_cd"),
        F.lit("MDMP").alias("src_cd"),
        F.lit("2023-12-01").cast("date").alias("effective_from_date"),
        F.lit(C.LAST_DATE).cast("date").alias("effective_to_date"),
    )


def counterparty_types(spark: SparkSession) -> DataFrame:
    rows = [("0", "юридическое лицо", "MDMP"), ("1", C.INDIVIDUAL, "MDMP")]
    d = seed_rows(spark, rows, ["counterparty_type_cd", "counterparty_type_desc", "src_cd"])
    return d.withColumn("effective_from_date", F.lit(C.FIRST_DATE).cast("date")).withColumn(
        "effective_to_date", F.lit(C.LAST_DATE).cast("date")
    )


def cross_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("counterparty_rk")).distinct()
    return users.select(
        "counterparty_rk",
        (F.col("counterparty_rk") - F.col("counterparty_rk") % 3).alias("uniq_counterparty_rk"),
        F.lit("RTLL").alias("src_cd"),
        F.lit(C.FIRST_DATE).cast("date").alias("effective_from_date"),
        F.lit(C.LAST_DATE).cast("date").alias("effective_to_date"),
    )


def phone_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone-mart-shaped rows with faults of every kind the checks look for."""
    event, user, day = F.col("event_id"), F.col("user_id"), F.to_date("ts")
    later = F.date_add(day, (event % 20).cast("int"))
    swap = event % 101 == 0
    return table(spark, sf_dir, "events").select(
        F.when(event % 97 == 0, F.lit(None))
        .when(event % 89 == 0, F.lit(-1).cast("long"))
        .otherwise(user - user % 3)
        .alias("mdm_customer_rk"),
        F.col("event_type").alias("phone_type_cd"),
        F.when(swap, later).otherwise(day).alias("business_start_dt"),
        F.when(swap, day).otherwise(later).alias("business_end_dt"),
        F.concat(
            F.lit("+7-"), (user - user % 2).cast("string"), F.lit("-"), (event % 4).cast("string")
        ).alias("phone_num"),
        (event % 7 == 0).alias("notification_flg"),
        (F.col("event_type") == "view").alias("atm_flg"),
        (F.col("value") > 20).alias("trust_system_flg"),
        (event % 5 == 0).alias("duplication_flg"),
        (event % 3 == 0).alias("main_dup_flg"),
        (event % 4 == 0).alias("main_phone_flg"),
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of requests: one entity per user, its first event the insert."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    first = e.groupBy("user_id").agg(F.min(F.struct("ts", "event_id")).alias("first"))
    rows = salted_join(e, first, ["user_id"])
    is_first = F.col("event_id") == F.col("first.event_id")
    odd_status, dropped = F.col("user_id") % 10 == 1, F.col("user_id") % 10 == 2
    before_delete = F.when(F.col("event_id") % 2 == 0, C.COMPLITED).otherwise(C.PAUSED)
    later = F.coalesce(
        _by_event_type(C.EXECUTED, C.PAUSED, C.COMPLITED, C.CANSELLED), before_delete
    )
    return rows.filter(~(is_first & dropped)).select(
        F.col("user_id").alias("id"),
        F.when(is_first & odd_status, C.PAUSED).when(is_first, C.ACCEPTED).otherwise(later).alias("status_nm"),
        F.col("first.ts").alias("create_dttm"),
        F.col("ts").alias("update_dttm"),
        F.when(is_first, "I").when(F.col("event_type") == "error", "D").otherwise("U").alias("operation"),
        F.col("ts").alias("stamp"),
    )


def first_batch(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("stamp") < ntz(SECOND_BATCH_FROM))


def request_source(changes: DataFrame) -> DataFrame:
    """Source state behind the feed: last change of each entity unless it is a delete."""
    last = changes.groupBy("id").agg(
        F.max_by(F.struct("status_nm", "create_dttm", "update_dttm", "operation"), "stamp").alias("r")
    )
    return last.filter(F.col("r.operation") != "D").select("id", "r.status_nm", "r.create_dttm", "r.update_dttm")


def empty_history(spark: SparkSession) -> DataFrame:
    at = F.lit(None).cast("timestamp_ntz")
    return spark.range(0).select(
        "id",
        F.lit(None).cast("string").alias("status_nm"),
        at.alias("create_dttm"),
        F.lit(None).cast("binary").alias("hash_key"),
        at.alias("valid_from_dttm"),
        at.alias("valid_to_dttm"),
        F.lit(None).cast("boolean").alias("deleted_flg"),
        at.alias("deleted_dttm"),
    )


def old_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") < ntz(OLD_SNAPSHOT_END))
    return orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


def new_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= ntz(NEW_SNAPSHOT_START))
    status = F.when(F.col("o_orderkey") % 7 == 0, "X").when(F.col("o_orderkey") % 11 == 0, None)
    return orders.select(
        "o_orderkey", "o_custkey", status.otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority"
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    code = F.concat(
        F.when(c % 2 == 0, "408").otherwise("452"),
        F.lpad((c % 100).cast("string"), 2, "0"),
        F.lpad(c.cast("string"), 15, "0"),
    )
    return table(spark, sf_dir, "customer").select(
        code.alias("account_rk"),
        c.alias("counterparty_rk"),
        F.lit(None).cast("string").alias("account_descr"),
        F.lit("810").alias("account_currency_cd"),
    )


def account_plan(accounts_df: DataFrame) -> DataFrame:
    """A dictionary with gaps: three characters for one group only, five for the lower half."""
    code = F.col("account_rk")
    short = accounts_df.filter(code.like("408%")).select(F.substring(code, 1, 3).alias("account_plan_cd"))
    long = accounts_df.filter(F.substring(code, 4, 2) < "50").select(F.substring(code, 1, 5).alias("account_plan_cd"))
    return (
        short.union(long)
        .distinct()
        .withColumn("account_plan_name", F.concat(F.lit("plan "), F.col("account_plan_cd")))
        .withColumn("effective_from_date", F.lit(C.FIRST_DATE).cast("date"))
        .withColumn("effective_to_date", F.lit(C.LAST_DATE).cast("date"))
    )


def event_calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of the years in which events happened."""
    bounds = table(spark, sf_dir, "events").agg(
        F.trunc(F.min("ts").cast("date"), "year").alias("a"),
        F.date_sub(F.add_months(F.trunc(F.max("ts").cast("date"), "year"), 12), 1).alias("b"),
    )
    return bounds.filter(F.col("a").isNotNull()).select(F.explode(F.sequence("a", "b")).alias("date_actual"))


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-shaped rows: one per event, some written by a generator."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        event.alias("id"),
        (event % 4).cast("int").alias("category"),
        F.when(event % 3 == 0, F.concat(F.lit("oltp_src_system.mod_"), F.col("event_type")))
        .when(event % 3 == 1, F.concat(F.lit("oltp_src_system.modx"), F.col("event_type")))
        .otherwise(F.concat(F.lit("dwh_stage."), F.col("event_type")))
        .alias("source"),
        F.lit("").alias("destination"),
        F.lit("").alias("message"),
        F.when(event % 2 == 0, "insert").otherwise("start").alias("type_operation"),
        (event % 5).alias("count_row"),
        F.col("ts").alias("stamp"),
    )
