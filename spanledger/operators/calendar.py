"""Calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import date_key, iso_day_of_week


def date_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, bounds included, as ``date_actual``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date_actual")
    )


def dim_date(days: DataFrame, holidays: Sequence[str] = (), moved_days_off: Sequence[str] = ()) -> DataFrame:
    """Calendar attributes for ``date_actual``. ``is_weekday`` is true on days off (Saturday, Sunday, moved days):
    name and meaning are kept as users know them."""
    day = F.col("date_actual")

    def listed(dates: Sequence[str]):
        return day.isin(*[F.lit(d).cast("date") for d in dates]) if dates else F.lit(False)

    off = iso_day_of_week(day).isin(6, 7) | listed(moved_days_off)
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_day_of_week(day).alias("day_of_week"),
        off.alias("is_weekday"),
        listed(holidays).alias("is_holiday"),
        F.year(day).alias("fiscal_year"),
    ).select(*C.CALENDAR_COLUMNS)
