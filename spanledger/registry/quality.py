"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanledger.operators import quality as Q
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import CASES, case
from spanledger.registry.intervals import INSIDE, LEFT, OUTSIDE, RIGHT
from spanledger.sources import fixtures as X

START, END, CUSTOMER, PHONE = "business_start_dt", "business_end_dt", "mdm_customer_rk", "phone_num"


@case(
    "check_null_key",
    "SELECT CAST(sum(CASE WHEN mdm_customer_rk IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS result FROM fx_phone",
)
def _(spark, sf):
    return Q.null_key_count(X.phone_rows(spark, sf), CUSTOMER)


@case(
    "check_minus_one_key",
    "SELECT CAST(sum(CASE WHEN mdm_customer_rk = -1 THEN 1 ELSE 0 END) AS BIGINT) AS result FROM fx_phone",
)
def _(spark, sf):
    return Q.minus_one_key_count(X.phone_rows(spark, sf), CUSTOMER)


@case(
    "check_duplicate_key",
    """SELECT mdm_customer_rk, phone_type_cd, business_start_dt, phone_num, count(*) AS "count" FROM fx_phone
GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
)
def _(spark, sf):
    return Q.duplicate_keys(X.phone_rows(spark, sf), [CUSTOMER, "phone_type_cd", START, PHONE])


@case("check_attribute_filled", "SELECT count(1) AS result FROM fx_phone WHERE mdm_customer_rk IS NULL")
def _(spark, sf):
    return Q.null_count(X.phone_rows(spark, sf), CUSTOMER)


def _member(condition: str) -> str:
    return f"""(c.mdm_customer_rk, c.business_start_dt, c.business_end_dt, c.phone_num) IN
  (SELECT (c.mdm_customer_rk, c.business_start_dt, c.business_end_dt, c.phone_num) FROM fx_phone c, fx_phone d
   WHERE c.mdm_customer_rk = d.mdm_customer_rk AND c.phone_num = d.phone_num AND {condition})"""


@case(
    "check_history_overlaps",
    f"""SELECT CASE WHEN o OR i OR r OR l THEN 1 ELSE 0 END AS result
FROM (SELECT coalesce({_member(OUTSIDE)}, FALSE) AS o, coalesce({_member(INSIDE)}, FALSE) AS i,
             coalesce({_member(RIGHT)}, FALSE) AS r, coalesce({_member(LEFT)}, FALSE) AS l FROM fx_phone c) f
GROUP BY o, i, r, l""",
)
def _(spark, sf):
    return Q.history_overlaps(X.phone_rows(spark, sf), [CUSTOMER, PHONE], START, END)


@case(
    "check_history_gaps",
    """SELECT CAST(sum(CASE WHEN nxt = business_end_dt OR nxt IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS result
FROM (SELECT business_end_dt, lead(business_start_dt, 1) OVER (PARTITION BY mdm_customer_rk, phone_num
        ORDER BY business_start_dt, business_end_dt) AS nxt FROM fx_phone) v""",
)
def _(spark, sf):
    return Q.history_gaps(X.phone_rows(spark, sf), [CUSTOMER, PHONE], START, END)


@case(
    "check_future_versions",
    "SELECT count(*) AS result FROM fx_phone WHERE business_start_dt > DATE '2024-01-20'",
)
def _(spark, sf):
    return Q.future_versions(X.phone_rows(spark, sf), START, F.lit(X.AS_OF).cast("date"))


@case("check_reversed_versions", "SELECT count(*) AS result FROM fx_phone WHERE business_start_dt > business_end_dt")
def _(spark, sf):
    return Q.reversed_versions(X.phone_rows(spark, sf), START, END)


def _holders(flag: str, key: str, owner: str) -> str:
    return f"""SELECT CAST(sum(n) AS BIGINT) AS result
FROM (SELECT (SELECT count(*) FROM fx_phone b WHERE b.{key} = a.{key}
        AND greatest(b.business_start_dt, a.business_start_dt) < least(b.business_end_dt, a.business_end_dt)
        AND b.{owner} <> a.{owner} AND b.{flag}) AS n FROM fx_phone a WHERE a.{flag}) c"""


@case("check_single_main_customer", _holders("main_dup_flg", PHONE, CUSTOMER))
def _(spark, sf):
    return Q.single_flag_holder(X.phone_rows(spark, sf), "main_dup_flg", PHONE, CUSTOMER, START, END)


@case("check_single_best_phone", _holders("main_phone_flg", CUSTOMER, PHONE))
def _(spark, sf):
    return Q.single_flag_holder(X.phone_rows(spark, sf), "main_phone_flg", CUSTOMER, PHONE, START, END)


@case(
    "check_duplicate_flag",
    """SELECT max(CAST(NOT (expected = duplication_flg) AS INTEGER)) AS result
FROM (SELECT coalesce((phone_num, business_start_dt) IN
        (SELECT DISTINCT (a.phone_num, a.business_start_dt) FROM fx_phone a JOIN fx_phone b
          ON a.phone_num = b.phone_num AND a.mdm_customer_rk <> b.mdm_customer_rk
          AND greatest(a.business_start_dt, b.business_start_dt) < least(a.business_end_dt, b.business_end_dt)), FALSE)
        AS expected, duplication_flg FROM fx_phone) d""",
)
def _(spark, sf):
    return Q.duplicate_flag_errors(X.phone_rows(spark, sf), "duplication_flg", PHONE, CUSTOMER, START, END)


EXPECTED = """EXISTS (SELECT 1 FROM fx_phone a, fx_phone b WHERE a.phone_num = p.phone_num
      AND a.business_start_dt = p.business_start_dt AND b.phone_num = a.phone_num AND b.mdm_customer_rk <> a.mdm_customer_rk
      AND a.business_start_dt < a.business_end_dt AND b.business_start_dt < b.business_end_dt
      AND a.business_start_dt < b.business_end_dt AND b.business_start_dt < a.business_end_dt)"""
WRONG_FLAGS = f"""SELECT phone_num, business_start_dt, count(*) AS wrong FROM fx_phone p
WHERE duplication_flg <> {EXPECTED} GROUP BY 1, 2"""


@case("duplicate_flag_rows", WRONG_FLAGS)
def _(spark, sf):
    return Q.duplicate_flag_rows(X.phone_rows(spark, sf), "duplication_flg", PHONE, CUSTOMER, START, END)


def _any(condition: str) -> str:
    return f"""EXISTS (SELECT 1 FROM fx_phone d WHERE d.mdm_customer_rk = c.mdm_customer_rk AND d.phone_num = c.phone_num
    AND {condition})"""


OVERLAPPING = f"""SELECT * FROM (SELECT DISTINCT mdm_customer_rk, phone_num, business_start_dt, business_end_dt,
  {_any(OUTSIDE)} AS outside_flg, {_any(INSIDE)} AS inside_flg, {_any(RIGHT)} AS right_flg, {_any(LEFT)} AS left_flg
  FROM fx_phone c) f WHERE outside_flg OR inside_flg OR right_flg OR left_flg"""


@case("history_overlap_rows", OVERLAPPING)
def _(spark, sf):
    return Q.history_overlap_rows(X.phone_rows(spark, sf), [CUSTOMER, PHONE], START, END)


def _sum_of(name: str) -> str:
    return f"SELECT '{name}' AS check_name, coalesce(max(result), 0) AS result FROM ({CASES[name][1]}) x"


def _count_of(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS check_name, count(*) AS result FROM ({sql}) x"


SINGLE = ["check_null_key", "check_minus_one_key", "check_attribute_filled", "check_history_gaps", "check_future_versions",
          "check_reversed_versions", "check_single_main_customer", "check_single_best_phone"]


@case(
    "quality_run",
    "\nUNION ALL\n".join(
        [_sum_of(name) for name in SINGLE]
        + [
            _count_of("check_duplicate_key", CASES["check_duplicate_key"][1]),
            _count_of("check_history_overlaps", OVERLAPPING),
            f"SELECT 'check_duplicate_flag', CAST(coalesce(sum(wrong), 0) AS BIGINT) FROM ({WRONG_FLAGS}) x",
        ]
    ),
)
def _(spark, sf):
    return Q.quality_run(X.phone_rows(spark, sf), F.lit(X.AS_OF).cast("date"))


@case(
    "check_primary_key",
    """SELECT l_orderkey, l_linenumber, count(*) AS "count" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(spark, sf):
    return Q.duplicate_keys(X.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@case(
    "check_not_null",
    """SELECT 'mdm_customer_rk' AS column_name, count(*) AS nulls FROM fx_phone WHERE mdm_customer_rk IS NULL
UNION ALL SELECT 'phone_num', count(*) FROM fx_phone WHERE phone_num IS NULL""",
)
def _(spark, sf):
    return Q.not_null(X.phone_rows(spark, sf), [CUSTOMER, PHONE])


@case(
    "check_foreign_key",
    """SELECT l_orderkey, l_linenumber FROM lineitem l
WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fx_old_snapshot o WHERE o.o_orderkey = l.l_orderkey)""",
)
def _(spark, sf):
    lines = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return Q.orphans(lines, "l_orderkey", X.old_snapshot(spark, sf), "o_orderkey")
