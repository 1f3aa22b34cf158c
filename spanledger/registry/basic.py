"""Projections, predicates, plain joins, aggregates, windows, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanledger import constants as C
from spanledger.functions import code_score, date_key, entity_hash, interval_text, iso_day_of_week, ntz
from spanledger.operators.ranking import row_number_by
from spanledger.plans.requests import correlation
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import case
from spanledger.registry.sql_inputs import weight_sql
from spanledger.session import materialize
from spanledger.sources import fixtures as X


def rows():
    return F.count(F.lit(1)).alias("n")


# --- projections and predicates ------------------------------------------------------------------------------------


@case("project_rename", "SELECT counterparty_rk AS client_rk, contact_desc AS phone_num FROM fx_contact")
def _(spark, sf):
    return X.contacts(spark, sf).select(
        F.col("counterparty_rk").alias("client_rk"), F.col("contact_desc").alias("phone_num")
    )


@case(
    "extend",
    "SELECT *, effective_to_date - effective_from_date AS days, contact_type_cd = 'ATMPhone' AS atm_flg FROM fx_contact",
)
def _(spark, sf):
    return X.contacts(spark, sf).withColumns(
        {
            "days": F.date_diff("effective_to_date", "effective_from_date").cast("long"),
            "atm_flg": F.col("contact_type_cd") == "ATMPhone",
        }
    )


@case(
    "searched_case",
    """SELECT contact_desc, src_cd, CASE src_cd WHEN 'MDMP' THEN 5 WHEN 'WAYN' THEN 4 WHEN 'RTLL' THEN 3 WHEN 'RTLS' THEN 2
       WHEN 'CFTB' THEN 1 END AS range_src_num, CASE WHEN trust_system_flg THEN 1 ELSE 0 END AS range_trust_num
FROM fx_contact""",
)
def _(spark, sf):
    return X.contacts(spark, sf).select(
        "contact_desc",
        "src_cd",
        code_score(F.col("src_cd"), C.SOURCE_SCORE).alias("range_src_num"),
        F.when(F.col("trust_system_flg"), 1).otherwise(0).alias("range_trust_num"),
    )


@case(
    "in_list",
    """SELECT id, status_nm, stamp, status_nm NOT IN ('complited', 'canselled') AS is_open FROM fx_feed
WHERE operation IN ('U', 'D')""",
)
def _(spark, sf):
    return (
        X.feed(spark, sf)
        .filter(F.col("operation").isin("U", "D"))
        .select("id", "status_nm", "stamp", (~F.col("status_nm").isin(*C.FINISHED)).alias("is_open"))
    )


@case(
    "comparison",
    """SELECT mdm_customer_rk, phone_num, business_start_dt, business_end_dt FROM fx_phone
WHERE business_start_dt <= business_end_dt AND business_start_dt > DATE '2024-01-05' AND mdm_customer_rk <> -1""",
)
def _(spark, sf):
    start = F.col("business_start_dt")
    return (
        X.phone_rows(spark, sf)
        .filter((start <= F.col("business_end_dt")) & (start > F.lit("2024-01-05").cast("date")))
        .filter(F.col("mdm_customer_rk") != -1)
        .select("mdm_customer_rk", "phone_num", "business_start_dt", "business_end_dt")
    )


@case(
    "null_tests",
    """SELECT phone_num, mdm_customer_rk IS NULL AS no_customer, phone_num IS NOT NULL AS has_phone FROM fx_phone""",
)
def _(spark, sf):
    return X.phone_rows(spark, sf).select(
        "phone_num",
        F.col("mdm_customer_rk").isNull().alias("no_customer"),
        F.col("phone_num").isNotNull().alias("has_phone"),
    )


@case(
    "boolean_predicate",
    "SELECT phone_num, business_start_dt FROM fx_phone WHERE main_dup_flg AND NOT main_phone_flg OR atm_flg",
)
def _(spark, sf):
    return (
        X.phone_rows(spark, sf)
        .filter((F.col("main_dup_flg") & ~F.col("main_phone_flg")) | F.col("atm_flg"))
        .select("phone_num", "business_start_dt")
    )


@case(
    "like_pattern",
    """SELECT c.contact_desc, c.contact_quality_code LIKE '%GOOD%' AS good, c.contact_quality_code NOT LIKE 'B_D' AS not_bad
FROM fx_contact c""",
)
def _(spark, sf):
    quality = F.col("contact_quality_code")
    return X.contacts(spark, sf).select(
        "contact_desc", quality.like("%GOOD%").alias("good"), (~quality.like("B_D")).alias("not_bad")
    )


@case("literal_tag", "SELECT 'report' AS source, o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    return X.table(spark, sf, "orders").select(F.lit("report").alias("source"), "o_orderkey", "o_orderstatus")


@case("parameterised_column", "SELECT count(1) AS result FROM fx_phone WHERE mdm_customer_rk IS NULL")
def _(spark, sf):
    def missing(column: str):
        return X.phone_rows(spark, sf).filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("result"))

    return missing("mdm_customer_rk")


# --- plain joins ---------------------------------------------------------------------------------------------------


@case(
    "left_join_right_filter",
    """SELECT c.counterparty_rk, t.counterparty_type_desc FROM fx_counterparty c
LEFT JOIN fx_type t ON c.counterparty_type_cd = t.counterparty_type_cd WHERE t.counterparty_type_desc = 'физическое лицо'""",
)
def _(spark, sf):
    types = X.counterparty_types(spark).select("counterparty_type_cd", "counterparty_type_desc")
    return (
        X.counterparties(spark, sf)
        .join(types.filter(F.col("counterparty_type_desc") == C.INDIVIDUAL), "counterparty_type_cd")
        .select("counterparty_rk", "counterparty_type_desc")
    )


@case(
    "equi_inner_join",
    "SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderstatus FROM lineitem l, orders o WHERE l.l_orderkey = o.o_orderkey",
)
def _(spark, sf):
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    orders = X.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@case(
    "semi_join",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM fx_old_snapshot)",
)
def _(spark, sf):
    old = X.old_snapshot(spark, sf).select("o_orderkey")
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.join(old, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")


@case(
    "anti_join",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM fx_old_snapshot)",
)
def _(spark, sf):
    old = X.old_snapshot(spark, sf).select("o_orderkey")
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return lines.join(old, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")


@case(
    "existence_flag",
    """SELECT o_orderkey, (o_orderkey, o_custkey) IN (SELECT (o_orderkey, o_custkey) FROM fx_new_snapshot) AS kept_flg
FROM fx_old_snapshot""",
)
def _(spark, sf):
    kept = X.new_snapshot(spark, sf).select("o_orderkey", "o_custkey").distinct().withColumn("_kept", F.lit(True))
    return (
        X.old_snapshot(spark, sf)
        .join(kept, ["o_orderkey", "o_custkey"], "left")
        .select("o_orderkey", F.col("_kept").isNotNull().alias("kept_flg"))
    )


# --- aggregates ----------------------------------------------------------------------------------------------------


@case(
    "grouped_count",
    """SELECT phone_type_cd, count(*) AS rows_n, count(1) AS ones_n, count(mdm_customer_rk) AS customers_n
FROM fx_phone GROUP BY phone_type_cd""",
)
def _(spark, sf):
    return (
        X.phone_rows(spark, sf)
        .groupBy("phone_type_cd")
        .agg(
            F.count("*").alias("rows_n"),
            F.count(F.lit(1)).alias("ones_n"),
            F.count("mdm_customer_rk").alias("customers_n"),
        )
    )


@case(
    "global_flag_sum",
    """SELECT CAST(sum(CASE WHEN main_dup_flg THEN 1 ELSE 0 END) AS BIGINT) AS result,
       (SELECT CAST(sum(1) AS BIGINT) FROM fx_phone WHERE phone_num IS NULL) AS nothing FROM fx_phone""",
)
def _(spark, sf):
    return X.phone_rows(spark, sf).agg(
        F.sum(F.when(F.col("main_dup_flg"), 1).otherwise(0)).alias("result"),
        F.sum(F.when(F.col("phone_num").isNull(), 1)).alias("nothing"),
    )


@case(
    "grouped_sum",
    "SELECT l_returnflag, sum(l_linenumber)::BIGINT AS lines, count(*) AS n FROM lineitem GROUP BY l_returnflag",
)
def _(spark, sf):
    return X.table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.sum("l_linenumber").alias("lines"), rows())


@case(
    "grouped_min_max",
    """SELECT contact_desc, min(effective_from_date) AS first_day, max(effective_to_date) AS last_day
FROM fx_contact GROUP BY contact_desc""",
)
def _(spark, sf):
    return (
        X.contacts(spark, sf)
        .groupBy("contact_desc")
        .agg(F.min("effective_from_date").alias("first_day"), F.max("effective_to_date").alias("last_day"))
    )


@case(
    "global_bool_max",
    "SELECT max(CAST(NOT (duplication_flg = main_dup_flg) AS INTEGER)) AS result FROM fx_phone",
)
def _(spark, sf):
    differs = ~(F.col("duplication_flg") == F.col("main_dup_flg"))
    return X.phone_rows(spark, sf).agg(F.max(differs.cast("int")).alias("result"))


@case(
    "having",
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12",
)
def _(spark, sf):
    return X.table(spark, sf, "orders").groupBy("o_custkey").agg(rows()).filter(F.col("n") > 12)


@case("distinct_rows", "SELECT DISTINCT mdm_customer_rk, phone_num FROM fx_phone")
def _(spark, sf):
    return X.phone_rows(spark, sf).select("mdm_customer_rk", "phone_num").distinct()


@case(
    "group_by_tuple",
    "SELECT atm_flg, main_dup_flg, main_phone_flg, count(*) AS n FROM fx_phone GROUP BY (atm_flg, main_dup_flg, main_phone_flg)",
)
def _(spark, sf):
    return X.phone_rows(spark, sf).groupBy("atm_flg", "main_dup_flg", "main_phone_flg").agg(rows())


@case(
    "corr",
    """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) + 0.0::DOUBLE AS quantity_price,
       CASE WHEN isnan(corr(l_quantity, 1.0)) THEN NULL ELSE corr(l_quantity, 1.0) END AS constant_side
FROM lineitem GROUP BY l_returnflag""",
)
def _(spark, sf):
    return (
        X.table(spark, sf, "lineitem")
        .withColumn("one", F.lit(1.0))
        .groupBy("l_returnflag")
        .agg(
            F.round(correlation("l_quantity", "l_extendedprice", F.lit(True)), 6).alias("quantity_price"),
            correlation("l_quantity", "one", F.lit(True)).alias("constant_side"),
        )
    )


@case(
    "row_count_delta",
    "SELECT (SELECT count(*) FROM fx_old_snapshot) - (SELECT count(*) FROM fx_new_snapshot) AS count_row",
)
def _(spark, sf):
    from spanledger.sources.tables import row_delta

    return row_delta(X.old_snapshot(spark, sf), X.new_snapshot(spark, sf))


# --- windows -------------------------------------------------------------------------------------------------------

NUMBERED = ["counterparty_rk", "contact_desc", "effective_from_date", "effective_to_date", "src_cd"]
_DIGEST = """md5(concat_ws('|', CAST(counterparty_rk AS VARCHAR), contact_desc, CAST(effective_from_date AS VARCHAR),
             CAST(effective_to_date AS VARCHAR), src_cd))"""


@case(
    "row_number_per_phone",
    f"""SELECT *, row_number() OVER (PARTITION BY contact_desc ORDER BY effective_from_date, {_DIGEST}) AS rank
FROM (SELECT {", ".join(NUMBERED)} FROM fx_contact) c""",
)
def _(spark, sf):
    return row_number_by(X.contacts(spark, sf).select(*NUMBERED), ["contact_desc"], "effective_from_date", "rank")


@case(
    "row_number_per_client",
    f"""SELECT *, row_number() OVER (PARTITION BY counterparty_rk ORDER BY effective_from_date, {_DIGEST}) AS rank
FROM (SELECT {", ".join(NUMBERED)} FROM fx_contact) c""",
)
def _(spark, sf):
    return row_number_by(X.contacts(spark, sf).select(*NUMBERED), ["counterparty_rk"], "effective_from_date", "rank")


@case(
    "lead_per_phone",
    """SELECT contact_desc, pt AS seg_start, lead(pt) OVER w AS seg_end
FROM (SELECT contact_desc, effective_from_date AS pt FROM fx_contact
      UNION SELECT contact_desc, effective_to_date FROM fx_contact) p
WINDOW w AS (PARTITION BY contact_desc ORDER BY pt)""",
)
def _(spark, sf):
    from spanledger.operators.intervals import next_value

    points = (
        X.contacts(spark, sf)
        .select("contact_desc", F.explode(F.array("effective_from_date", "effective_to_date")).alias("seg_start"))
        .distinct()
    )
    return next_value(points, ["contact_desc"], "seg_start", "seg_end")


@case(
    "lead_with_default",
    """SELECT id, stamp, lead(stamp, 1, TIMESTAMP '2999-12-31 23:59:59') OVER (PARTITION BY id ORDER BY stamp) AS next_stamp
FROM fx_feed""",
)
def _(spark, sf):
    from spanledger.operators.intervals import next_value

    points = materialize(X.feed(spark, sf).select("id", "stamp"), "points")
    led = next_value(points, ["id"], "stamp", "next_stamp")
    return led.withColumn("next_stamp", F.coalesce("next_stamp", ntz(C.OPEN_END)))


@case(
    "running_max",
    """SELECT DISTINCT contact_desc, effective_from_date, max(effective_to_date) OVER (PARTITION BY contact_desc
       ORDER BY effective_from_date RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING) AS reach
FROM fx_contact""",
)
def _(spark, sf):
    per_day = (
        X.contacts(spark, sf)
        .groupBy("contact_desc", "effective_from_date")
        .agg(F.max("effective_to_date").alias("longest"))
    )
    before = (
        Window.partitionBy("contact_desc")
        .orderBy("effective_from_date")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return per_day.select("contact_desc", "effective_from_date", F.max("longest").over(before).alias("reach"))


@case(
    "running_sum",
    """SELECT DISTINCT contact_desc, effective_from_date,
       count(*) OVER (PARTITION BY contact_desc ORDER BY effective_from_date) AS started FROM fx_contact""",
)
def _(spark, sf):
    per_day = X.contacts(spark, sf).groupBy("contact_desc", "effective_from_date").agg(rows())
    upto = Window.partitionBy("contact_desc").orderBy("effective_from_date")
    return per_day.select("contact_desc", "effective_from_date", F.sum("n").over(upto).alias("started"))


# --- sort and set operations ---------------------------------------------------------------------------------------


@case(
    "sort_report",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY 1, 2 DESC",
)
def _(spark, sf):
    counted = X.table(spark, sf, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(rows())
    return counted.orderBy("o_orderpriority", F.desc("o_orderstatus"))


@case(
    "union_distinct",
    "SELECT o_custkey, o_orderstatus FROM fx_old_snapshot UNION SELECT o_custkey, o_orderstatus FROM fx_new_snapshot",
)
def _(spark, sf):
    old, new = (s(spark, sf).select("o_custkey", "o_orderstatus") for s in (X.old_snapshot, X.new_snapshot))
    return old.union(new).distinct()


@case(
    "except_distinct",
    "SELECT o_custkey, o_orderstatus FROM fx_new_snapshot EXCEPT SELECT o_custkey, o_orderstatus FROM fx_old_snapshot",
)
def _(spark, sf):
    old, new = (s(spark, sf).select("o_custkey", "o_orderstatus") for s in (X.old_snapshot, X.new_snapshot))
    return new.subtract(old)


@case(
    "tagged_symmetric_difference",
    """SELECT 'report' AS source, a.* FROM fx_new_snapshot a EXCEPT SELECT 'report' AS source, b.* FROM fx_old_snapshot b
UNION SELECT 'src' AS source, b.* FROM fx_old_snapshot b EXCEPT SELECT 'src' AS source, a.* FROM fx_new_snapshot a""",
)
def _(spark, sf):
    from spanledger.operators.quality import tagged_difference

    new, old = X.new_snapshot(spark, sf), X.old_snapshot(spark, sf)
    return tagged_difference(new, old, new.columns)


# --- scalar functions ----------------------------------------------------------------------------------------------


@case(
    "greatest_least",
    """SELECT phone_num, greatest(business_start_dt, business_end_dt, NULL) AS later, least(business_start_dt, business_end_dt)
       AS earlier, greatest(mdm_customer_rk, NULL) AS only_customer FROM fx_phone""",
)
def _(spark, sf):
    nothing = F.lit(None)
    return X.phone_rows(spark, sf).select(
        "phone_num",
        F.greatest("business_start_dt", "business_end_dt", nothing.cast("date")).alias("later"),
        F.least("business_start_dt", "business_end_dt").alias("earlier"),
        F.greatest("mdm_customer_rk", nothing.cast("long")).alias("only_customer"),
    )


@case("coalesce_default", "SELECT phone_num, coalesce(mdm_customer_rk, 0) AS mdm_customer_rk FROM fx_phone")
def _(spark, sf):
    return X.phone_rows(spark, sf).select(
        "phone_num", F.coalesce("mdm_customer_rk", F.lit(0)).alias("mdm_customer_rk")
    )


@case(
    "concat_null",
    "SELECT phone_num, phone_num || ' / ' || CAST(mdm_customer_rk AS VARCHAR) AS label FROM fx_phone",
)
def _(spark, sf):
    label = F.concat("phone_num", F.lit(" / "), F.col("mdm_customer_rk").cast("string"))
    return X.phone_rows(spark, sf).select("phone_num", label.alias("label"))


@case(
    "substring_prefix",
    "SELECT account_rk, substring(account_rk, 1, 3) AS three, substring(account_rk, 1, 5) AS five FROM fx_account",
)
def _(spark, sf):
    return X.accounts(spark, sf).select(
        "account_rk",
        F.substring("account_rk", 1, 3).alias("three"),
        F.substring("account_rk", 1, 5).alias("five"),
    )


@case("digest_sha256", "SELECT account_rk, sha256(account_rk) AS digest FROM fx_account")
def _(spark, sf):
    digest = F.unhex(F.sha2("account_rk", 256))
    return X.accounts(spark, sf).select("account_rk", F.lower(F.hex(digest)).alias("digest"))


@case(
    "interval_text",
    """SELECT event_id, CAST(date_diff('day', DATE '1900-01-01', CAST(ts AS DATE)) AS VARCHAR) || ' days'
       || CASE WHEN CAST(ts AS TIME) = TIME '00:00:00' THEN '' ELSE ' ' || CAST(CAST(ts AS TIME) AS VARCHAR) END AS text
FROM events""",
)
def _(spark, sf):
    return X.table(spark, sf, "events").select("event_id", interval_text(F.col("ts")).alias("text"))


@case("entity_hash", "SELECT id, stamp, hash_key FROM keyed_feed")
def _(spark, sf):
    key = F.lower(F.hex(entity_hash(F.col("id"), F.col("create_dttm"))))
    return X.feed(spark, sf).select("id", "stamp", key.alias("hash_key"))


@case("truncate_day", "SELECT event_id, CAST(date_trunc('day', ts) AS DATE) AS day FROM events")
def _(spark, sf):
    return X.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))


@case(
    "date_parts",
    """SELECT o_orderkey, CAST(date_part('year', o_orderdate) AS INTEGER) AS y, CAST(date_part('quarter', o_orderdate) AS INTEGER) AS q,
       CAST(date_part('month', o_orderdate) AS INTEGER) AS m, CAST(date_part('day', o_orderdate) AS INTEGER) AS d,
       CAST(date_part('week', o_orderdate) AS INTEGER) AS iso_week,
       CAST(date_part('isodow', o_orderdate) AS INTEGER) AS iso_day,
       CAST(date_part('year', o_orderdate) * 10000 + date_part('month', o_orderdate) * 100
            + date_part('day', o_orderdate) AS INTEGER) AS date_key FROM orders""",
)
def _(spark, sf):
    day = F.to_date("o_orderdate")
    return X.table(spark, sf, "orders").select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.quarter(day).alias("q"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
        F.weekofyear(day).alias("iso_week"),
        iso_day_of_week(day).alias("iso_day"),
        date_key(day).alias("date_key"),
    )


@case(
    "contact_weight",
    f"""SELECT phone_num, business_start_dt, rang_start_phone_num, {weight_sql("1", "rang_start_phone_num")} AS weight
FROM ranked_contacts""",
)
def _(spark, sf):
    from spanledger.plans.phone import _weight
    from spanledger.registry.phone import mart

    return (
        mart(spark, sf)
        .ranked()
        .select(
            "phone_num",
            "business_start_dt",
            "rang_start_phone_num",
            _weight(F.lit(1), "rang_start_phone_num").alias("weight"),
        )
    )


@case(
    "casts",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_text, CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS user_int,
       CAST(ts AS DATE) AS day, CAST(value > 20 AS INTEGER) AS flag, TIMESTAMP '2999-12-31 23:59:59' AS open_end FROM events""",
)
def _(spark, sf):
    return X.table(spark, sf, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("user_text"),
        F.col("user_id").cast("string").cast("int").alias("user_int"),
        F.col("ts").cast("date").alias("day"),
        (F.col("value") > 20).cast("int").alias("flag"),
        ntz(C.OPEN_END).alias("open_end"),
    )


@case(
    "clock_functions",
    "SELECT c_custkey, TRUE AS dated_today, TRUE AS one_stamp, TRUE AS has_user, FALSE AS deleted_flg FROM customer",
)
def _(spark, sf):
    """Rows stamped with the real clock and user: what holds of the stamps whenever the query runs."""
    from spanledger.sources.tables import apply_defaults, technical_defaults

    stamped = apply_defaults(X.table(spark, sf, "customer").select("c_custkey"), technical_defaults())
    now = F.current_timestamp().cast("timestamp_ntz")
    return stamped.select(
        "c_custkey",
        (F.to_date("processed_dttm") == F.current_date()).alias("dated_today"),
        (F.col("processed_dttm") == now).alias("one_stamp"),
        F.col("user").isNotNull().alias("has_user"),
        "deleted_flg",
    )


@case(
    "prefix_lookup",
    """SELECT account_rk, (SELECT account_plan_name FROM fx_plan p WHERE p.account_plan_cd = substring(a.account_rk, 1, 5))
       AS plan_name FROM fx_account a""",
)
def _(spark, sf):
    from spanledger.plans.accounts import prefix_lookup

    accounts = X.accounts(spark, sf)
    return prefix_lookup(
        accounts, "account_rk", 5, X.account_plan(accounts), "account_plan_cd", "account_plan_name", "plan_name"
    ).select("account_rk", "plan_name")

