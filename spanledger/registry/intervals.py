"""Interval operators on contact intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanledger.operators import intervals as iv
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import CTES, case
from spanledger.registry.sql_inputs import islands_sql
from spanledger.session import materialize
from spanledger.sources import fixtures as X

START, END = "business_start_dt", "business_end_dt"

CTES["fx_span"] = """
SELECT mdm_customer_rk, phone_num, phone_type_cd, business_start_dt, business_end_dt FROM fx_phone"""


def spans(spark, sf):
    """All phone rows: some without an owner, some that end before they start."""
    return X.phone_rows(spark, sf).select("mdm_customer_rk", "phone_num", "phone_type_cd", START, END)


@case(
    "temporal_join",
    """SELECT c.counterparty_rk, c.contact_desc, x.uniq_counterparty_rk,
       greatest(c.effective_from_date, x.effective_from_date) AS effective_from_date,
       least(c.effective_to_date, x.effective_to_date) AS effective_to_date
FROM fx_contact c JOIN fx_xref x ON c.counterparty_rk = x.counterparty_rk
WHERE greatest(c.effective_from_date, x.effective_from_date) <= least(c.effective_to_date, x.effective_to_date)""",
)
def _(spark, sf):
    left = X.contacts(spark, sf).select("counterparty_rk", "contact_desc", "effective_from_date", "effective_to_date")
    return iv.temporal_join(
        left,
        X.cross_reference(spark, sf),
        {"counterparty_rk": "counterparty_rk"},
        keep_right=["uniq_counterparty_rk"],
    )


FRAGMENTS = """SELECT {columns}, s.a AS business_start_dt, s.b AS business_end_dt
FROM (SELECT {key}, pt AS a, lead(pt) OVER (PARTITION BY {key} ORDER BY pt) AS b
      FROM (SELECT {key}, business_start_dt AS pt FROM fx_span UNION SELECT {key}, business_end_dt FROM fx_span) p) s
JOIN fx_span t ON s.{key} = t.{key} AND greatest(t.business_start_dt, s.a) < least(t.business_end_dt, s.b)
WHERE s.b IS NOT NULL"""
CTES["span_pieces"] = FRAGMENTS.format(key="phone_num", columns="t.mdm_customer_rk, t.phone_type_cd, t.phone_num")


@case("fragment", "SELECT * FROM span_pieces")
def _(spark, sf):
    return iv.fragment(spans(spark, sf), ["phone_num"], START, END)


@case(
    "fragment_fill",
    FRAGMENTS.format(key="mdm_customer_rk", columns="t.mdm_customer_rk, t.phone_type_cd, t.phone_num"),
)
def _(spark, sf):
    rows = spans(spark, sf)
    keys = ["mdm_customer_rk"]
    return iv.fill_segments(rows, iv.segments(rows, keys, START, END), keys, START, END)


@case(
    "other_owner_overlap",
    """SELECT DISTINCT phone_num, business_start_dt, business_end_dt FROM fx_span a
WHERE EXISTS (SELECT 1 FROM fx_span b WHERE b.phone_num = a.phone_num AND b.mdm_customer_rk <> a.mdm_customer_rk
              AND b.business_start_dt < a.business_end_dt AND a.business_start_dt < b.business_end_dt
              AND a.business_start_dt < a.business_end_dt AND b.business_start_dt < b.business_end_dt)""",
)
def _(spark, sf):
    return iv.other_owner_overlap(spans(spark, sf), "phone_num", "mdm_customer_rk", START, END)


def _relation(name: str, condition: str) -> str:
    return f"""(c.mdm_customer_rk, c.business_start_dt, c.business_end_dt, c.phone_num) IN
  (SELECT (c.mdm_customer_rk, c.business_start_dt, c.business_end_dt, c.phone_num) FROM fx_span c, fx_span d
   WHERE c.mdm_customer_rk = d.mdm_customer_rk AND c.phone_num = d.phone_num AND {condition}) AS {name}"""


OUTSIDE = "c.business_start_dt < d.business_start_dt AND d.business_end_dt <= c.business_end_dt"
INSIDE = "d.business_start_dt < c.business_start_dt AND c.business_end_dt <= d.business_end_dt"
RIGHT = (
    "c.business_start_dt < d.business_start_dt AND d.business_start_dt < c.business_end_dt "
    "AND c.business_end_dt < d.business_end_dt"
)
LEFT = (
    "d.business_start_dt < c.business_start_dt AND c.business_start_dt < d.business_end_dt "
    "AND d.business_end_dt < c.business_end_dt"
)


@case(
    "overlap_classify",
    f"""SELECT DISTINCT c.mdm_customer_rk, c.phone_num, c.business_start_dt, c.business_end_dt,
{_relation("outside_flg", OUTSIDE)}, {_relation("inside_flg", INSIDE)}, {_relation("right_flg", RIGHT)},
{_relation("left_flg", LEFT)} FROM fx_span c WHERE c.mdm_customer_rk IS NOT NULL""",
)
def _(spark, sf):
    return iv.overlap_classify(spans(spark, sf), ["mdm_customer_rk", "phone_num"], START, END)


@case(
    "range_join_days",
    """SELECT d.date_actual, s.phone_num, s.mdm_customer_rk, s.phone_type_cd, s.business_start_dt, s.business_end_dt
FROM fx_days d, fx_span s WHERE s.business_start_dt <= d.date_actual AND d.date_actual <= s.business_end_dt""",
)
def _(spark, sf):
    return iv.range_join_days(spans(spark, sf), X.event_calendar_days(spark, sf), "date_actual", START, END)


CTES["weighted_pieces"] = "SELECT *, length(phone_type_cd) + mdm_customer_rk % 7 AS weight FROM span_pieces"


@case(
    "best_in_overlap",
    """SELECT a.*, coalesce(a.weight = (SELECT max(b.weight) FROM weighted_pieces b WHERE a.phone_num = b.phone_num
       AND greatest(a.business_start_dt, b.business_start_dt) < least(a.business_end_dt, b.business_end_dt)), FALSE) AS best_flg
FROM weighted_pieces a""",
)
def _(spark, sf):
    weight = (F.length("phone_type_cd") + F.col("mdm_customer_rk") % 7).alias("weight")
    pieces = materialize(iv.fragment(spans(spark, sf), ["phone_num"], START, END).select("*", weight), "pieces")
    return iv.best_in_overlap(pieces, ["phone_num"], START, END, "weight", "best_flg")


@case(
    "overlap_count",
    """SELECT phone_num, CAST(sum(n) AS BIGINT) AS conflicts
FROM (SELECT a.phone_num, (SELECT count(*) FROM fx_span b WHERE a.phone_num = b.phone_num
        AND greatest(a.business_start_dt, b.business_start_dt) < least(a.business_end_dt, b.business_end_dt)
        AND a.mdm_customer_rk <> b.mdm_customer_rk) AS n
      FROM fx_span a WHERE a.business_start_dt < a.business_end_dt AND a.mdm_customer_rk IS NOT NULL) c
GROUP BY phone_num""",
)
def _(spark, sf):
    counted = iv.overlap_conflicts(spans(spark, sf), "phone_num", "mdm_customer_rk", START, END)
    return counted.select("phone_num", F.col("conflicts").cast("long").alias("conflicts"))


@case(
    "coalesce_intervals",
    islands_sql(
        "(SELECT * FROM fx_span WHERE business_start_dt <= business_end_dt)", "mdm_customer_rk, phone_num", START, END,
        "mdm_customer_rk, phone_num",
    ),
)
def _(spark, sf):
    return iv.coalesce_intervals(spans(spark, sf), ["mdm_customer_rk", "phone_num"], START, END)


@case(
    "coalesce_intervals_timestamps",
    islands_sql(
        "(SELECT user_id, event_type, ts AS valid_from, ts + to_hours(CAST(event_id % 72 AS INTEGER)) AS valid_to FROM events)",
        "user_id, event_type",
        "valid_from",
        "valid_to",
        "user_id, event_type",
    ),
)
def _(spark, sf):
    hours = F.make_dt_interval(F.lit(0), (F.col("event_id") % 72).cast("int"))
    rows = X.table(spark, sf, "events").select(
        "user_id", "event_type", F.col("ts").alias("valid_from"), (F.col("ts") + hours).alias("valid_to")
    )
    return iv.coalesce_intervals(rows, ["user_id", "event_type"], "valid_from", "valid_to")


CTES["fx_sparse"] = """
SELECT 'p' || CAST(o_custkey % 40 AS VARCHAR) AS phone_num,
       sparse_day AS business_start_dt,
       sparse_day + CAST(o_orderkey % 3 AS INTEGER) AS business_end_dt
FROM (SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) + CAST(date_part('day', o_orderdate) AS INTEGER) % 19 AS sparse_day
      FROM orders) o"""


@case("coalesce_intervals_global", islands_sql("fx_sparse", "phone_num", START, END))
def _(spark, sf):
    """Short intervals of a few phones, all moved into the first 19 days of their month, so that the table has gaps: whole-table
    islands differ from per-key ones."""
    return iv.coalesce_intervals_global(sparse_spans(spark, sf), ["phone_num"], START, END)


def sparse_spans(spark, sf):
    day = F.date_add(F.trunc(F.to_date("o_orderdate"), "month"), F.dayofmonth("o_orderdate") % 19)
    return X.table(spark, sf, "orders").select(
        F.concat(F.lit("p"), (F.col("o_custkey") % 40).cast("string")).alias("phone_num"),
        day.alias(START),
        F.date_add(day, (F.col("o_orderkey") % 3).cast("int")).alias(END),
    )


# --- the same on timestamps ----------------------------------------------------------------------------------------

CTES["fx_period"] = """
SELECT user_id, user_id % 7 AS line, event_type, ts AS valid_from, ts + to_minutes(CAST(event_id % 600 AS INTEGER)) AS valid_to
FROM events"""


def periods(spark, sf):
    """Events as periods of up to ten hours; some are empty."""
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("event_id") % 600).cast("int"))
    return X.table(spark, sf, "events").select(
        "user_id", (F.col("user_id") % 7).alias("line"), "event_type", F.col("ts").alias("valid_from"),
        (F.col("ts") + minutes).alias("valid_to"),
    )


_ANY_OTHER = """b.line = a.line AND b.user_id <> a.user_id AND b.valid_from < b.valid_to AND a.valid_from < a.valid_to
  AND b.valid_from < a.valid_to AND a.valid_from < b.valid_to"""


@case(
    "other_owner_overlap_timestamps",
    f"""SELECT DISTINCT line, valid_from, valid_to FROM fx_period a
WHERE EXISTS (SELECT 1 FROM fx_period b WHERE {_ANY_OTHER})""",
)
def _(spark, sf):
    return iv.other_owner_overlap(periods(spark, sf), "line", "user_id", "valid_from", "valid_to")


@case(
    "overlap_count_timestamps",
    f"""SELECT a.line, (SELECT count(*) FROM fx_period a2, fx_period b WHERE a2.line = a.line AND
  {_ANY_OTHER.replace("a.", "a2.")}) AS conflicts FROM (SELECT DISTINCT line FROM fx_period WHERE valid_from < valid_to) a""",
)
def _(spark, sf):
    counted = iv.overlap_conflicts(periods(spark, sf), "line", "user_id", "valid_from", "valid_to")
    return counted.select("line", F.col("conflicts").cast("long").alias("conflicts"))


def _stands(name: str, condition: str) -> str:
    return f"EXISTS (SELECT 1 FROM fx_period d WHERE d.user_id = c.user_id AND {condition}) AS {name}"


@case(
    "overlap_classify_timestamps",
    f"""SELECT DISTINCT c.user_id, c.valid_from, c.valid_to,
{_stands("outside_flg", "c.valid_from < d.valid_from AND d.valid_to <= c.valid_to")},
{_stands("inside_flg", "d.valid_from < c.valid_from AND c.valid_to <= d.valid_to")},
{_stands("right_flg", "d.valid_from > c.valid_from AND d.valid_from < c.valid_to AND d.valid_to > c.valid_to")},
{_stands("left_flg", "d.valid_from < c.valid_from AND d.valid_to > c.valid_from AND d.valid_to < c.valid_to")}
FROM fx_period c""",
)
def _(spark, sf):
    return iv.overlap_classify(periods(spark, sf), ["user_id"], "valid_from", "valid_to")


CTES["fx_blink"] = """
SELECT user_id % 40 AS line, ts AS valid_from, ts + to_seconds(CAST(event_id % 90 AS INTEGER)) AS valid_to FROM events"""


@case("coalesce_intervals_global_timestamps", islands_sql("fx_blink", "line", "valid_from", "valid_to"))
def _(spark, sf):
    """Periods of up to 90 seconds, so that the table has gaps."""
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("event_id") % 90)
    rows = X.table(spark, sf, "events").select(
        (F.col("user_id") % 40).alias("line"), F.col("ts").alias("valid_from"), (F.col("ts") + seconds).alias("valid_to")
    )
    return iv.coalesce_intervals_global(rows, ["line"], "valid_from", "valid_to")
