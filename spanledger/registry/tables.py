"""Scans, loads and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import ntz
from spanledger.operators.calendar import date_series
from spanledger.operators.ranking import surrogate_key
from spanledger.registry import sql_inputs  # noqa: F401
from spanledger.registry.base import case
from spanledger.session import materialize, scratch_path
from spanledger.sources import fixtures as X
from spanledger.sources import tables as S


@case("snapshot_transfer", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def _(spark, sf):
    return S.snapshot_transfer(
        X.table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"], scratch_path(spark, "transfer")
    )


@case(
    "seed_rows",
    """SELECT t.cd AS counterparty_type_cd, t.name AS counterparty_type_name, count(*) AS counterparties
FROM (VALUES ('0', 'Юридическое лицо'), ('1', 'Физическое  лицо')) t(cd, name)
JOIN fx_counterparty c ON c.counterparty_type_cd = t.cd GROUP BY 1, 2""",
)
def _(spark, sf):
    kinds = S.seed_rows(spark, C.COUNTERPARTY_TYPES, ["counterparty_type_cd", "counterparty_type_name"])
    counted = X.counterparties(spark, sf).groupBy("counterparty_type_cd").agg(
        F.count(F.lit(1)).alias("counterparties")
    )
    return kinds.join(counted, "counterparty_type_cd")


@case(
    "apply_defaults",
    """SELECT c_custkey, c_name, DATE '1900-01-01' AS effective_from_date, DATE '2999-12-31' AS effective_to_date,
       FALSE AS deleted_flg, TIMESTAMP '2024-01-20' AS processed_dttm FROM customer""",
)
def _(spark, sf):
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_name")
    defaults = S.validity_defaults() | S.technical_defaults(ntz(X.AS_OF + " 00:00:00"))
    return S.apply_defaults(rows, defaults).drop("user")


@case(
    "surrogate_key",
    """SELECT m.m + row_number() OVER (ORDER BY priority) AS key, priority
FROM (SELECT DISTINCT o_orderpriority AS priority FROM orders) p, (SELECT max(n_nationkey) AS m FROM nation) m""",
)
def _(spark, sf):
    fresh = X.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority")).distinct()
    existing = X.table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"))
    return surrogate_key(fresh, existing, "key", dense=True, order=["priority"]).select("key", "priority")


@case(
    "surrogate_key_distributed",
    "SELECT count(*) AS key_count, count(*) AS distinct_keys, TRUE AS above_existing FROM lineitem",
)
def _(spark, sf):
    """The keys themselves follow the partitions, so their properties are compared."""
    rows = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    existing = X.table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"))
    top = existing.agg(F.max("key")).first()[0]
    return surrogate_key(rows, existing, "key", dense=False).agg(
        F.count("key").alias("key_count"),
        F.countDistinct("key").alias("distinct_keys"),
        (F.min("key") > F.lit(top)).alias("above_existing"),
    )


@case(
    "staged_rebuild",
    "SELECT src_cd, contact_type_cd, count(*) AS contacts FROM person_contacts GROUP BY 1, 2",
)
def _(spark, sf):
    from spanledger.plans import phone as P

    customers = materialize(P.individual_customers(X.counterparties(spark, sf), X.counterparty_types(spark)), "step")
    resolved = materialize(P.resolve_global_id(X.contacts(spark, sf), X.cross_reference(spark, sf)), "step")
    return (
        P.individual_contacts(resolved, customers)
        .groupBy("src_cd", "contact_type_cd")
        .agg(F.count(F.lit(1)).alias("contacts"))
    )


@case(
    "append_insert_select",
    """SELECT o_orderkey, o_orderstatus FROM fx_old_snapshot UNION ALL SELECT o_orderkey, o_orderstatus FROM fx_new_snapshot""",
)
def _(spark, sf):
    target = scratch_path(spark, "append")
    S.append_rows(X.old_snapshot(spark, sf).select("o_orderkey", "o_orderstatus"), target)
    S.append_rows(X.new_snapshot(spark, sf).select("o_orderkey", "o_orderstatus"), target)
    return spark.read.parquet(target)


@case("full_refresh", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(spark, sf):
    target = scratch_path(spark, "refresh")
    S.append_rows(X.old_snapshot(spark, sf).select("o_orderkey", "o_orderstatus"), target)
    return S.snapshot_transfer(X.table(spark, sf, "orders"), ["o_orderkey", "o_orderstatus"], target)


@case(
    "update_from",
    """SELECT o.o_orderkey, CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus
FROM fx_old_snapshot o LEFT JOIN fx_new_snapshot n ON o.o_orderkey = n.o_orderkey""",
)
def _(spark, sf):
    old = X.old_snapshot(spark, sf).select("o_orderkey", "o_orderstatus")
    return S.update_from(old, X.new_snapshot(spark, sf), ["o_orderkey"], ["o_orderstatus"])


@case(
    "temp_relation",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
)
def _(spark, sf):
    X.table(spark, sf, "orders").createOrReplaceTempView("temp_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n FROM temp_orders GROUP BY o_orderstatus")


@case(
    "named_view",
    "SELECT counterparty_rk, effective_from_date, effective_to_date, counterparty_type_cd FROM customers",
)
def _(spark, sf):
    from spanledger.plans.phone import individual_customers

    individual_customers(X.counterparties(spark, sf), X.counterparty_types(spark)).createOrReplaceTempView(
        "v_individual_customers"
    )
    return spark.sql("SELECT * FROM v_individual_customers")


@case("show_table", "SELECT * FROM fx_account")
def _(spark, sf):
    X.accounts(spark, sf).createOrReplaceTempView("account")
    return spark.table("account")


@case(
    "date_series",
    """SELECT CAST(d AS DATE) AS date_actual
FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d FROM events) s""",
)
def _(spark, sf):
    first, last = X.table(spark, sf, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return date_series(spark, str(first), str(last))


@case(
    "current_run_clock",
    "SELECT event_id, TIMESTAMP '2024-01-20' AS processed_dttm, ts > TIMESTAMP '2024-01-20' AS is_future FROM events",
)
def _(spark, sf):
    as_of = ntz(X.AS_OF + " 00:00:00")
    return X.table(spark, sf, "events").select(
        "event_id", as_of.alias("processed_dttm"), (F.col("ts") > as_of).alias("is_future")
    )
