"""Account dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.scale import broadcast_if_small


def prefix_lookup(
    df: DataFrame, code: str, length: int, dictionary: DataFrame, cd: str, name: str, out: str, as_of: Column | None = None
) -> DataFrame:
    """Name of the dictionary row whose code is the first ``length`` characters; NULL if none, an error if several
    match a looked-up row. ``as_of`` restricts the dictionary to the versions valid on that date (last day included)."""
    valid = dictionary
    if as_of is not None:
        valid = dictionary.filter(as_of.between(F.col("effective_from_date"), F.col("effective_to_date")))
    names = valid.groupBy(F.col(cd).alias("_cd")).agg(F.count(F.lit(1)).alias("_n"), F.max(name).alias("_name"))
    names = broadcast_if_small(names)
    joined = df.join(names, F.substring(code, 1, length) == F.col("_cd"), "left")
    several = F.raise_error(F.concat(F.lit("more than one dictionary row for prefix "), F.col("_cd")))
    found = F.when(F.col("_n") > 1, several.cast("string")).otherwise(F.col("_name"))
    return joined.withColumn(out, found).drop("_cd", "_n", "_name")


def describe_accounts(account: DataFrame, plan: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Set ``account_descr`` to the names of the three- and five-character code prefixes; NULL if either is missing."""
    columns = account.columns
    named = prefix_lookup(account, "account_rk", 3, plan, "account_plan_cd", "account_plan_name", "_three", as_of)
    named = prefix_lookup(named, "account_rk", 5, plan, "account_plan_cd", "account_plan_name", "_five", as_of)
    return named.withColumn("account_descr", F.concat("_three", F.lit(" / "), "_five")).select(*columns)
