"""Data-quality checks. A clean table gives 0, NULL for a sum over no rows, or no rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanledger.operators.intervals import other_owner_spans, overlap_classify, overlap_conflicts
from spanledger.session import JOINS_IN_PLACE, NO_BROADCAST, scratch_path, settings


def _flag_sum(df: DataFrame, condition: Column) -> DataFrame:
    return df.agg(F.sum(F.when(condition, 1).otherwise(0)).cast("long").alias("result"))


def null_key_count(df: DataFrame, key: str) -> DataFrame:
    return _flag_sum(df, F.col(key).isNull())


def minus_one_key_count(df: DataFrame, key: str) -> DataFrame:
    return _flag_sum(df, F.col(key) == -1)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once. Serves business keys and declared primary keys."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def null_count(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("result"))


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One scan for all columns declared NOT NULL."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    known = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_parent"), "left_anti")


def history_overlaps(
    df: DataFrame, keys: Sequence[str], start: str, end: str, include_equal_start: bool = False
) -> DataFrame:
    """One 0/1 row per occurring combination of overlap relations."""
    flags = ["outside_flg", "inside_flg", "right_flg", "left_flg"]
    classified = overlap_classify(df, keys, start, end, include_equal_start).select(*flags)
    unknown = F.lit(False)
    for c in (*keys, start, end):
        unknown = unknown | F.col(c).isNull()
    incomplete = df.filter(unknown).select(*[F.lit(False).alias(f) for f in flags])
    found = classified.unionByName(incomplete).distinct()
    hit = F.col(flags[0]) | F.col(flags[1]) | F.col(flags[2]) | F.col(flags[3])
    return found.select(hit.cast("int").alias("result"))


def history_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Versions whose end is not the start of the next one; the last version of a key may end anywhere.

    Rows are ordered by start, then end. Rows sharing a start are counted by aggregation, so the window sees one row
    per key and distinct start.
    """
    per_start = df.groupBy(*keys, start).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(start) == F.col(end)).alias("_empty"),
        F.max(end).alias("_last_end"),
    )
    following = F.lead(start).over(Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_last()))
    last_is_empty = F.coalesce(F.col("_last_end") == F.col(start), F.lit(False)).cast("long")
    # a row before another with the same start is fine only if it is empty
    inner = F.when(F.col(start).isNull(), 0).otherwise(F.col("_n") - 1 - (F.col("_empty") - last_is_empty))
    outer = F.when(F.col("_following").isNull(), 0).when(F.col("_following") == F.col("_last_end"), 0).otherwise(1)
    return (
        per_start.withColumn("_following", following)
        .agg(F.sum(inner + outer).cast("long").alias("result"))
    )


def future_versions(df: DataFrame, start: str, as_of: Column) -> DataFrame:
    return df.filter(F.col(start) > as_of).agg(F.count(F.lit(1)).alias("result"))


def reversed_versions(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(F.col(start) > F.col(end)).agg(F.count(F.lit(1)).alias("result"))


def single_flag_holder(df: DataFrame, flag: str, key: str, owner: str, start: str, end: str) -> DataFrame:
    """Conflicts between flagged rows of one key with different owners at one time; NULL if nothing is flagged."""
    flagged = df.filter(F.col(flag))
    conflicts = overlap_conflicts(flagged, key, owner, start, end).agg(F.sum("conflicts").alias("c"))
    rows = flagged.agg(F.count(F.lit(1)).alias("n"))
    parts = conflicts.select("c", F.lit(None).cast("long").alias("n")).unionByName(
        rows.select(F.lit(None).cast("decimal(38,0)").alias("c"), "n")
    )
    return parts.agg(
        F.when(F.max("n") > 0, F.coalesce(F.max("c"), F.lit(0).cast("decimal(38,0)"))).cast("long").alias("result")
    )


def duplicate_flag_errors(df: DataFrame, flag: str, key: str, owner: str, start: str, end: str) -> DataFrame:
    """1 if some row's flag differs from the recomputed one, 0 if none does, NULL if nothing can be compared.

    Rows are compared per (key, start): an aggregate says which flag values occur there.
    """
    shared = other_owner_spans(df, key, owner, start, end).withColumnsRenamed({key: "_key"})
    owned_end = F.when(F.col(owner).isNotNull(), F.col(end))
    per_start = df.groupBy(key, start).agg(
        F.max(owned_end).alias("_end"),
        F.max(F.col(flag).cast("int")).alias("_any"),
        F.min(F.col(flag).cast("int")).alias("_all"),
    )
    on = (F.col(key) == F.col("_key")) & (F.col(start) == F.col("_at"))
    joined = per_start.join(shared, on, "left")
    expected = F.coalesce(F.col("_shared_from") < F.col("_end"), F.lit(False))
    wrong = F.when(expected, F.lit(1) - F.col("_all")).otherwise(F.col("_any"))
    return joined.agg(F.max(wrong).alias("result"))


def duplicate_flag_rows(df: DataFrame, flag: str, key: str, owner: str, start: str, end: str) -> DataFrame:
    """(key, start, wrong): where and on how many rows the flag differs from the recomputed one. A NULL flag is not wrong."""
    shared = other_owner_spans(df, key, owner, start, end).withColumnsRenamed({key: "_key"})
    per_start = df.groupBy(key, start).agg(
        F.max(F.when(F.col(owner).isNotNull(), F.col(end))).alias("_end"),
        F.count_if(F.col(flag)).alias("_set"),
        F.count_if(~F.col(flag)).alias("_unset"),
    )
    joined = per_start.join(shared, (F.col(key) == F.col("_key")) & (F.col(start) == F.col("_at")), "left")
    expected = F.coalesce(F.col("_shared_from") < F.col("_end"), F.lit(False))
    wrong = F.when(expected, F.col("_unset")).otherwise(F.col("_set"))
    return joined.select(key, start, wrong.alias("wrong")).filter("wrong > 0")


def history_overlap_rows(
    df: DataFrame, keys: Sequence[str], start: str, end: str, include_equal_start: bool = False
) -> DataFrame:
    """The distinct intervals that stand in some overlap relation to another of their key, with the four flags."""
    flags = ["outside_flg", "inside_flg", "right_flg", "left_flg"]
    return overlap_classify(df, keys, start, end, include_equal_start).filter(" OR ".join(flags))


@dataclass(frozen=True)
class CheckedTable:
    """Column names of a table of owned, effective-dated rows, for ``quality_run``."""

    owner: str = "mdm_customer_rk"
    key: str = "phone_num"
    kind: str = "phone_type_cd"
    start: str = "business_start_dt"
    end: str = "business_end_dt"
    shared_flag: str = "duplication_flg"
    key_flag: str = "main_dup_flg"
    owner_flag: str = "main_phone_flg"


def _layout(df: DataFrame, key: str, start: str) -> DataFrame:
    """``df`` stored in buckets of ``key``: what groups, orders or joins by it afterwards needs no shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, "layout")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, key)
    name = f"layout_{path.rsplit('-', 1)[1]}"
    dealt.write.bucketBy(buckets, key).sortBy(key, start).option("path", path).saveAsTable(name)
    return spark.table(name)


def quality_run(df: DataFrame, as_of: Column, table: CheckedTable = CheckedTable()) -> DataFrame:
    """All checks of the table as (check_name, result), every result a count.

    The table is scanned once for each of its two layouts: dealt by key, while the counts that need one row only are observed, and dealt
    by owner for the one check that goes by owner. The checks that compare rows read their layout in place; none shuffles rows
    again, as all their groups, windows and joins include the key of the layout. Each gives one number, so the driver sees eleven.
    No join is by broadcast: the planner would judge what is derived from a layout by its packed files, which say little of its rows.
    """
    t, spark = table, df.sparkSession
    seen = Observation()
    start, end, owner = F.col(t.start), F.col(t.end), F.col(t.owner)
    counted = df.select(t.owner, t.key, t.kind, t.start, t.end, t.shared_flag, t.key_flag, t.owner_flag).observe(
        seen,
        F.count_if(owner.isNull()).alias("check_null_key"),
        F.count_if(owner == -1).alias("check_minus_one_key"),
        F.count_if(owner.isNull()).alias("check_attribute_filled"),
        F.count_if(start > as_of).alias("check_future_versions"),
        F.count_if(start > end).alias("check_reversed_versions"),
    )
    by_key = _layout(counted, t.key, t.start)
    by_owner = _layout(df.select(t.owner, t.key, t.start, t.end, t.owner_flag), t.owner, t.start)

    def total(rows: DataFrame, value: Column) -> int:
        return rows.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("n")).first().n

    one = F.lit(1)
    checks = {
        "check_duplicate_key": lambda: total(duplicate_keys(by_key, [t.owner, t.kind, t.start, t.key]), one),
        "check_history_overlaps": lambda: total(history_overlap_rows(by_key, [t.owner, t.key], t.start, t.end), one),
        "check_history_gaps": lambda: total(history_gaps(by_key, [t.owner, t.key], t.start, t.end), F.col("result")),
        "check_single_main_customer": lambda: total(
            overlap_conflicts(by_key.filter(t.key_flag), t.key, t.owner, t.start, t.end), F.col("conflicts")
        ),
        "check_duplicate_flag": lambda: total(
            duplicate_flag_rows(by_key, t.shared_flag, t.key, t.owner, t.start, t.end), F.col("wrong")
        ),
        "check_single_best_phone": lambda: total(
            overlap_conflicts(by_owner.filter(t.owner_flag), t.owner, t.key, t.start, t.end), F.col("conflicts")
        ),
    }
    # rows with one layout key are in one bucket, so joins on more columns than it need no other order
    with settings(spark, **JOINS_IN_PLACE, **NO_BROADCAST):
        results = seen.get | {name: check() for name, check in checks.items()}
    return spark.createDataFrame(sorted(results.items()), "check_name string, result long")


def tagged_difference(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows only in ``a`` tagged ``report`` and only in ``b`` tagged ``src``: ``((A-B) union C) - D`` over
    tagged rows, done as one aggregation (NULLs equal, copies combined before the shuffle)."""
    both = a.select(*columns, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionAll(
        b.select(*columns, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
        .filter(F.col("_a") != F.col("_b"))
        .select(F.when(F.col("_a") == 1, "report").otherwise("src").alias("source"), *columns)
    )
