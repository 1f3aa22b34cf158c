"""Request warehouse: day grain, daily mart and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanledger import constants as C
from spanledger.operators.quality import tagged_difference
from spanledger.sources.tables import replace_partitions

STATUS_MEASURE = {
    C.COMPLITED: "complited_per_day",
    C.CANSELLED: "canselled_per_day",
    C.ACCEPTED: "accepted_per_day",
    C.PAUSED: "paused_per_day",
}
SPAN_MEASURE = {C.EXECUTED: "executed_during_day", C.PAUSED: "paused_during_day"}


def history_day_grain(history: DataFrame) -> DataFrame:
    return history.select(
        "id",
        "status_nm",
        F.to_date("create_dttm").alias("create_dttm"),
        "hash_key",
        F.to_date("valid_from_dttm").alias("valid_from_dttm"),
        F.to_date("valid_to_dttm").alias("valid_to_dttm"),
        "deleted_flg",
        F.to_date("deleted_dttm").alias("deleted_dttm"),
    )


MONTH = "from_month"


def with_month(day_history: DataFrame) -> DataFrame:
    """The day grain with the month in which a version begins, by which its table is partitioned."""
    return day_history.withColumn(MONTH, F.date_format("valid_from_dttm", "yyyy-MM"))


def refresh_day_grain(history: DataFrame, before: DataFrame, after: DataFrame, target: str) -> None:
    """Bring the day-grain table at ``target`` up to a changed history: only months in which a version of a changed key began, before
    or after the change, are written anew."""
    months = with_month(history_day_grain(before)).select(MONTH).union(with_month(history_day_grain(after)).select(MONTH)).distinct()
    grain = with_month(history_day_grain(history))
    # bounded broadcast: one row for a month
    replace_partitions(grain.join(F.broadcast(months), MONTH, "left_semi"), target, [MONTH], touched=months)


def _events(first: str | None, last: str | None) -> Column:
    """What one version adds to the daily measures: (day, measure, step). A version valid over several days is a +1 on
    its first day and a -1 after its last, clipped to the calendar, instead of one row per day."""

    def event(day: Column, measure: Column | str, step: int) -> Column:
        name = F.lit(measure) if isinstance(measure, str) else measure
        return F.struct(day.alias("day"), name.alias("measure"), F.lit(step).alias("step"))

    status, start, stop = F.col("status_nm"), F.col("valid_from_dttm"), F.col("valid_to_dttm")
    begun = F.coalesce(*[F.when(status == value, F.lit(m)) for value, m in STATUS_MEASURE.items()])
    events = [
        F.when(begun.isNotNull(), event(start, begun, 1)),
        F.when(F.col("deleted_flg"), event(F.col("deleted_dttm"), "deleted_per_day", 1)),
    ]
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    inside = (start <= stop) & (start <= high) & (stop >= low)
    for value, measure in SPAN_MEASURE.items():
        lasting = (status == value) & inside
        events.append(F.when(lasting, event(F.greatest(start, low), measure, 1)))
        events.append(F.when(lasting & (stop < high), event(F.date_add(stop, 1), measure, -1)))
    return F.filter(F.array(*events), lambda e: e.isNotNull())


def daily_measures(day_history: DataFrame, first, last) -> DataFrame:
    """One scan of the history, reduced map-side to one row per day; then a running sum over calendar-many rows."""
    steps = (
        day_history.filter(F.col("hash_key").isNotNull())
        .select(F.explode(_events(first, last)).alias("e"))
        .select("e.*")
        .filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    )
    return steps.groupBy("day").agg(
        *[F.sum(F.when(F.col("measure") == m, F.col("step")).otherwise(0)).cast("long").alias(m) for m in C.MEASURES]
    )


def dim_work(calendar: DataFrame, day_history: DataFrame) -> DataFrame:
    """Calendar with seven measures per day, 0 where nothing happened.

    The calendar's bounds are read first (one row). Its day-sized join and running sums are bounded by the calendar.
    """
    first, last = calendar.agg(F.min("date_actual"), F.max("date_actual")).first()
    return _on_calendar(calendar, daily_measures(day_history, first, last))


def _on_calendar(calendar: DataFrame, daily: DataFrame) -> DataFrame:
    # full outer: a step on a day the calendar leaves out still counts for the days after it
    joined = calendar.join(daily, F.col("date_actual") == F.col("day"), "full_outer")
    running = Window.orderBy(F.coalesce("date_actual", "day")).rowsBetween(Window.unboundedPreceding, 0)
    filled = {m: F.coalesce(F.col(m), F.lit(0).cast("long")) for m in C.MEASURES}
    spans = set(SPAN_MEASURE.values())
    return joined.select(
        *C.CALENDAR_COLUMNS, *[(F.sum(c).over(running) if m in spans else c).alias(m) for m, c in filled.items()]
    ).filter(F.col("date_actual").isNotNull())


def step_totals(day_history: DataFrame) -> DataFrame:
    """(day, measure, step): all that versions add to the daily measures, clipped to no calendar, summed to one row per day and
    measure. Such totals of parts of a history add up to those of the whole, so they can be kept up; ``work_from_steps`` makes the
    mart of them."""
    every = day_history.filter(F.col("hash_key").isNotNull())
    return _total(every.select(F.explode(_events(C.FIRST_DATE, C.LAST_DATE)).alias("e")).select("e.*"))


def _total(steps: DataFrame) -> DataFrame:
    summed = steps.groupBy("day", "measure").agg(F.sum("step").cast("long").alias("step"))
    return summed.filter((F.col("step") != 0) & F.col("day").isNotNull())


def keep_up_steps(totals: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """``step_totals`` of a changed history from those before the change: what the changed keys' versions ``before`` added is taken
    back, what their versions ``after`` it add is added. Reads only these versions and one row per day and measure."""
    taken = step_totals(before).withColumn("step", -F.col("step"))
    return _total(totals.unionByName(taken).unionByName(step_totals(after)))


def work_from_steps(calendar: DataFrame, totals: DataFrame) -> DataFrame:
    """``dim_work`` of the history behind ``step_totals``."""
    first, last = calendar.agg(F.min("date_actual"), F.max("date_actual")).first()
    spans = set(SPAN_MEASURE.values())
    # what began before the calendar lasts into its first day
    lasting = F.col("measure").isin(*spans)
    day = F.when(lasting, F.greatest("day", F.lit(first).cast("date"))).otherwise(F.col("day"))
    clipped = totals.withColumn("day", day).filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    daily = clipped.groupBy("day").agg(
        *[F.sum(F.when(F.col("measure") == m, F.col("step")).otherwise(0)).cast("long").alias(m) for m in C.MEASURES]
    )
    return _on_calendar(calendar, daily)


def agg_per_week(work: DataFrame) -> DataFrame:
    """Sums by ISO weekday; four names lose their suffix."""
    return (
        work.groupBy("day_of_week")
        .agg(*[F.sum(m).cast("long").alias(m.removesuffix("_per_day")) for m in C.MEASURES])
        .orderBy("day_of_week")
    )


def correlation(x: str, y: str, keep: Column) -> Column:
    """Pearson correlation; NULL when a side does not vary."""
    a, b = F.when(keep, F.col(x)), F.when(keep, F.col(y))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def corr_matrix(work: DataFrame, as_of: Column, strict: bool = False, measures: Sequence[str] = tuple(C.MEASURES)):
    """7 x 7 correlations as one aggregation over one scan, one output row per measure.

    Computed are the co-moments of the pairs (28 with those of each measure with itself), whose partial sums merge; a cell is a
    quotient of three of them, NULL when a side does not vary. By default two known oddities are kept: the row
    ``canselled_per_day`` repeats the ``complited_per_day`` values of the two during-day columns, and only the row
    ``paused_during_day`` leaves out days after ``as_of``. ``strict`` gives the true matrix up to ``as_of``.
    """
    upto = F.col("date_actual") <= as_of
    cells = {}
    for row in measures:
        for column in measures:
            left = row
            if not strict and row == "canselled_per_day" and column in SPAN_MEASURE.values():
                left = "complited_per_day"
            cells[row, column] = (left, column, strict or row == "paused_during_day")

    def name(x: str, y: str, cut: bool) -> str:
        return f"{'cut' if cut else 'all'}:{min(x, y)}:{max(x, y)}"

    def moment(x: str, y: str, cut: bool) -> Column:
        a, b = (F.when(upto, F.col(c)) if cut else F.col(c) for c in (min(x, y), max(x, y)))
        return F.covar_pop(a, b).alias(name(x, y, cut))

    needed = {
        name(*pair, cut): moment(*pair, cut) for x, y, cut in cells.values() for pair in ((x, x), (x, y), (y, y))
    }

    def cell(x: str, y: str, cut: bool) -> Column:
        of = [F.col(f"`{name(*pair, cut)}`") for pair in ((x, y), (x, x), (y, y))]
        return F.try_divide(of[0], F.sqrt(of[1]) * F.sqrt(of[2]))

    rows = F.array(
        *[F.struct(F.lit(r).alias("agg_name"), *[cell(*cells[r, c]).alias(c) for c in measures]) for r in measures]
    )
    return work.agg(*needed.values()).select(F.explode(rows).alias("r")).select("r.*")


def difference_full(recovered: DataFrame, source: DataFrame) -> DataFrame:
    columns = ["id", "status_nm", "create_dttm", "update_dttm"]
    return tagged_difference(recovered, source, columns).orderBy("id", "create_dttm", "update_dttm")


def difference_partial(recovered: DataFrame, source: DataFrame) -> DataFrame:
    columns = ["id", "status_nm", "create_dttm"]
    return tagged_difference(recovered, source, columns).orderBy("id", "create_dttm")
