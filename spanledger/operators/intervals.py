"""Interval operators: intersection joins, fragmenting, coalescing, overlap tests.

Intervals are half-open unless a function says otherwise. Windows run over *distinct points* of a key, not over its
rows: for dates their number is bounded by the calendar, for timestamps hot keys are cut into time slots. The running counts and
extremes of the overlap tests (``other_owner_*``, ``overlap_*``) are the exception: on timestamps, all distinct points of a key
pass through one window. ``other_owner_*`` cut hot keys into slots for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from spanledger.scale import (
    DEFAULT_POLICY,
    SkewPolicy,
    found_hot_keys,
    in_bounded_parts,
    mark_hot,
    salted_join,
    slot_number,
    split_hot,
    time_slot,
)

BEFORE = Window.unboundedPreceding


def temporal_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    start: str = "effective_from_date",
    end: str = "effective_to_date",
    keep_right: Sequence[str] = (),
    closed: bool = True,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Equi join on ``on`` (left column -> right column) keeping pairs whose intervals intersect.

    Returns the left columns with the interval replaced by the intersection, plus ``keep_right``. A NULL bound is open. Keys that are hot on the left are
    cut by time on both sides: a row takes part in every slot its interval meets, and a pair is given in the slot of its later
    start alone, which both intervals meet.
    """
    r = right.select(
        *[F.col(rc).alias(f"_on_{i}") for i, rc in enumerate(on.values())],
        F.col(start).alias("_r_start"),
        F.col(end).alias("_r_end"),
        *keep_right,
    )
    low, high = F.greatest(start, "_r_start"), F.least(end, "_r_end")
    condition = low <= high if closed else low < high
    for i, lc in enumerate(on):
        condition = condition & (F.col(lc) == F.col(f"_on_{i}"))
    columns = [low.alias(c) if c == start else high.alias(c) if c == end else F.col(c) for c in left.columns]

    keys, others = list(on), [f"_on_{i}" for i in range(len(on))]
    hot = found_hot_keys(left, keys, policy)
    if hot is None:
        return left.join(r, condition, "inner").select(*columns, *keep_right)
    is_hot = F.col("_pieces").isNotNull()
    marked_left = mark_hot(left, hot, keys)
    marked_right = mark_hot(r.withColumnsRenamed(dict(zip(others, keys))), hot, keys).withColumnsRenamed(dict(zip(keys, others)))
    plain = marked_left.filter(~is_hot).drop("_pieces").join(marked_right.filter(~is_hot).drop("_pieces"), condition, "inner")
    hot_left, hot_right = marked_left.filter(is_hot).drop("_pieces"), marked_right.filter(is_hot).drop("_pieces")
    # one row: later starts lie between these, so open bounds need no slots beyond them
    starts = hot_left.select(F.col(start).alias("s")).unionAll(hot_right.select("_r_start"))
    kind = left.schema[start].dataType
    least, most = (F.lit(x).cast(kind) for x in starts.agg(F.min("s"), F.max("s")).first())
    cut_left = _in_slots(hot_left, start, end, least, most, "_slot", policy)
    cut_right = _in_slots(hot_right, "_r_start", "_r_end", least, most, "_r_slot", policy)
    later = F.coalesce(slot_number(kind, F.coalesce(low, least), policy), F.lit(0))
    cut = cut_left.join(cut_right, condition & (F.col("_slot") == F.col("_r_slot")) & (F.col("_slot") == later), "inner")
    return plain.select(*columns, *keep_right).unionByName(cut.select(*columns, *keep_right))


def _in_slots(df: DataFrame, start: str, end: str, least: Column, most: Column, slot: str, policy: SkewPolicy) -> DataFrame:
    """Rows once for every time slot from their start to their end, within [``least``, ``most``]. A NULL bound is open."""
    kind = df.schema[start].dataType
    first, upto = (
        F.coalesce(slot_number(kind, at, policy), F.lit(0))
        for at in (F.coalesce(F.col(start), least), F.least(F.coalesce(F.col(end), most), most))
    )
    kept = df.filter(F.coalesce(F.col(start) <= F.col(end), F.lit(True)))
    return kept.withColumn(slot, F.explode(F.sequence(first, F.greatest(first, upto))))


def next_value(
    df: DataFrame, keys: Sequence[str], at: str, out: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Add the next larger ``at`` of the key. ``df`` must be distinct on key and ``at``."""
    ordinary, hot = _by_heat(df, keys, at, policy)
    done = ordinary.withColumn(out, F.lead(at).over(Window.partitionBy(*keys).orderBy(at)))
    if hot is None:
        return done
    return done.unionByName(lead_in_slots(hot, keys, at, out).drop("_slot"))


def _by_heat(
    df: DataFrame, keys: Sequence[str], at: str, policy: SkewPolicy, counted: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Split off hot keys and give them ``_slot``. Distinct dates of a key are few whatever the number of rows.
    ``counted``: a relation that is cheaper to count, whose hot keys are those of ``df``."""
    slot = time_slot(df, at, policy)  # refuses other types at any size
    if isinstance(df.schema[at].dataType, T.DateType):
        return df, None
    ordinary, hot = split_hot(df, keys, policy, counted)
    return ordinary, None if hot is None else hot.withColumn("_slot", slot)


def lead_in_slots(slotted: DataFrame, keys: Sequence[str], at: str, out: str) -> DataFrame:
    """``lead(at)`` per key over (key, slot) windows. The first value of each slot of a hot key is also handed to the
    slot before it, so no window ever holds a whole hot key."""
    per_key = Window.partitionBy(*keys).orderBy("_slot")
    borrowed = (
        slotted.groupBy(*keys, "_slot")
        .agg(F.min(at).alias(at))
        .withColumn("_slot", F.lag("_slot").over(per_key))
        .filter(F.col("_slot").isNotNull())
        .withColumn("_borrowed", F.lit(True))
    )
    own = slotted.withColumn("_borrowed", F.lit(False))
    window = Window.partitionBy(*keys, "_slot").orderBy(at, "_borrowed")
    return (
        own.unionByName(borrowed, allowMissingColumns=True)
        .withColumn(out, F.lead(at).over(window))
        .filter(~F.col("_borrowed"))
        .drop("_borrowed")
    )


def segments(
    df: DataFrame, keys: Sequence[str], start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Elementary segments of each key: neighbouring distinct start/end points as ``seg_start``, ``seg_end``."""
    points = (
        df.select(*keys, F.explode(F.array(start, end)).alias("seg_start"))
        .filter(F.col("seg_start").isNotNull())
        .distinct()
    )
    return next_value(points, keys, "seg_start", "seg_end", policy).filter(F.col("seg_end").isNotNull())


def fill_segments(
    df: DataFrame, segs: DataFrame, keys: Sequence[str], start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row per source row and elementary segment inside it; ``start``/``end`` become the segment's.

    Segment ends are source ends, so overlap and containment are the same. A NULL bound is open. Columns of ``segs``
    beyond the segment are kept.
    """
    contained = (F.col(start).isNull() | (F.col("seg_start") >= F.col(start))) & (
        F.col(end).isNull() | (F.col("seg_end") <= F.col(end))
    )
    joined = salted_join(df, segs, keys, contained, policy=policy)
    return (
        joined.drop(start, end)
        .withColumnsRenamed({"seg_start": start, "seg_end": end})
        .select(*df.columns, *[c for c in segs.columns if c not in (*keys, "seg_start", "seg_end")])
    )


def fragment(
    df: DataFrame, keys: Sequence[str], start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Split each row at every start/end point of its key."""
    return fill_segments(df, segments(df, keys, start, end, policy), keys, start, end, policy)


def segment_stats(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    aggs: Sequence[Column],
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Aggregates over the rows active in each elementary segment; segments without rows are left out.

    The aggregation is partial right after the join, so fragments themselves are not shuffled.
    """
    filled = fill_segments(df, segments(df, keys, start, end, policy), keys, start, end, policy)
    return (
        filled.groupBy(*keys, start, end)
        .agg(*aggs)
        .withColumnsRenamed({start: "seg_start", end: "seg_end"})
    )


def best_in_overlap(
    fragments: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    weight: str,
    out: str,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Flag the rows whose weight is the largest among overlapping rows of the key.

    Input must be fragments: rows of a key equal or disjoint in time, so overlapping rows share both bounds. NULL
    weight is never best.
    """
    groups = [*keys, start, end]
    best = fragments.filter(F.col(start) < F.col(end)).groupBy(*groups).agg(F.max(weight).alias("_best"))
    joined = salted_join(fragments, best, groups, how="left", policy=policy)
    return joined.withColumn(out, F.coalesce(F.col(weight) == F.col("_best"), F.lit(False))).drop("_best")


# --- coalescing ----------------------------------------------------------------------------------------------------


def _mark_islands(points: DataFrame, window: Window, start: str, end: str) -> DataFrame:
    """Add ``_island``: the start of the island a point belongs to. Needs points in start order, NULL start first."""
    reach = F.max(end).over(window.rowsBetween(BEFORE, -1))
    opens = F.col(start).isNotNull() & (F.col("_reach").isNull() | (F.col("_reach") < F.col(start)))
    return (
        points.withColumn("_reach", reach)
        .withColumn("_opens", F.when(opens, F.col(start)))
        .withColumn("_island", F.max("_opens").over(window.rowsBetween(BEFORE, 0)))
    )


def coalesce_intervals(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    policy: SkewPolicy = DEFAULT_POLICY,
    hot_by: Sequence[str] | None = None,
) -> DataFrame:
    """Merge touching or overlapping intervals with equal ``keys`` (NULLs equal). A row that ends before it starts covers nothing
    and is left out; bounds may not be NULL.

    ``hot_by``: the subset of ``keys`` whose hot values are cut into time slots (default: all).
    """
    df = df.filter(F.coalesce(F.col(end) >= F.col(start), F.lit(True)))
    ordinary, hot = _by_heat(df, list(hot_by or keys), start, policy)
    done = coalesce_whole(ordinary, keys, start, end)
    return done if hot is None else done.unionByName(coalesce_in_slots(hot, keys, start, end))


def coalesce_whole(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    points = df.groupBy(*keys, start).agg(F.max(end).alias(end))
    marked = _mark_islands(points, Window.partitionBy(*keys).orderBy(start), start, end)
    return (
        marked.groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .select(*keys, start, end)
    )


def coalesce_in_slots(slotted: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    points = slotted.groupBy(*keys, "_slot", start).agg(F.max(end).alias(end))
    slots = points.groupBy(*keys, "_slot").agg(F.max(end).alias(end))
    order = Window.partitionBy(*keys).orderBy("_slot")
    # what earlier slots reach to enters each slot of a hot key as a row without a start
    carried = (
        slots.withColumn("_carry", F.max(end).over(order.rowsBetween(BEFORE, -1)))
        .withColumn("_later", F.lead("_slot").over(order).isNotNull())
        .select(*keys, "_slot", F.lit(None).cast(slotted.schema[start].dataType).alias(start), F.col("_carry").alias(end), "_later")
    )
    both = points.withColumn("_later", F.lit(False)).unionByName(carried)
    in_slot = Window.partitionBy(*keys, "_slot")
    marked = _mark_islands(both, in_slot.orderBy(F.col(start).asc_nulls_first()), start, end).withColumn(
        "_later", F.max("_later").over(in_slot)
    )
    pieces = (
        marked.filter(F.col(start).isNotNull())
        .groupBy(*keys, "_slot", "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end), F.max("_later").alias("_later"))
        .withColumn("_last", F.max("_island").over(in_slot))
    )
    edge = F.col("_island").isNull() | (F.col("_later") & (F.col("_island") == F.col("_last")))
    inner = pieces.filter(~edge).select(*keys, start, end)
    # only pieces at slot borders, at most two per slot, are put together across slots
    across = Window.partitionBy(*keys).orderBy("_slot", F.col("_island").asc_nulls_first())
    borders = (
        pieces.filter(edge)
        .withColumn("_island", F.last("_island", ignorenulls=True).over(across.rowsBetween(BEFORE, 0)))
        .groupBy(*keys, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .select(*keys, start, end)
    )
    return inner.unionByName(borders)


def global_islands(spans: DataFrame, start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Map each distinct start to the start of its island, islands taken over the whole table.

    On dates a single-partition window sees one row per calendar day. On timestamps and whole numbers windows see the starts of one
    slot; only one row for each slot, with what reaches beyond it, meets in one partition.
    """
    points = spans.groupBy(start).agg(F.max(end).alias(end))
    if isinstance(spans.schema[start].dataType, T.DateType):
        return _mark_islands(points, Window.orderBy(start), start, end).select(F.col(start).alias("_day"), "_island")
    slotted = points.withColumn("_slot", time_slot(points, start, policy))
    opened = coalesce_in_slots(slotted, [], start, end).select(F.col(start).alias("_opens"))
    marked = slotted.join(opened, F.col(start) == F.col("_opens"), "left")
    before = Window.orderBy("_slot").rowsBetween(BEFORE, -1)
    carried = marked.groupBy("_slot").agg(F.max("_opens").alias("_last")).select("_slot", F.max("_last").over(before).alias("_carry"))
    within = Window.partitionBy("_slot").orderBy(start).rowsBetween(BEFORE, 0)
    return marked.join(carried, "_slot").select(
        F.col(start).alias("_day"), F.coalesce(F.max("_opens").over(within), "_carry").alias("_island")
    )


def coalesce_intervals_global(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    spans: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """As ``coalesce_intervals``, but islands are found over the whole table and grouped by ``keys`` afterwards, so
    rows of other keys can bridge a gap. Needs ``end >= start``. Dates, timestamps or whole numbers.

    ``spans``: a smaller relation with the same distinct (start, end) pairs, if the caller has one.
    """
    islands = global_islands(df if spans is None else spans, start, end, policy)
    if isinstance(df.schema[start].dataType, T.DateType):
        islands = F.broadcast(islands)  # at most one row per day of the calendar
    tagged = df.join(islands, F.col(start) == F.col("_day"))
    return (
        tagged.groupBy("_island", *keys)
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .select(*keys, start, end)
    )


# --- overlap tests -------------------------------------------------------------------------------------------------


def _running(
    points: DataFrame,
    key: str,
    at: str,
    value: str,
    out: str,
    policy: SkewPolicy,
    counted: DataFrame,
    least_later: bool = False,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the key's points up to each, or with ``least_later`` its minimum from each on.

    Frames grow from the first row of their order, as Spark evaluates a frame up to the last row anew for every row. Hot
    keys go slot by slot, each slot with what the slots before it in the order come to.
    """

    def ahead(column: str) -> Column:
        return F.col(column).desc() if least_later else F.col(column).asc()

    fold = F.min if least_later else F.sum
    ordinary, hot = _by_heat(points, [key], at, policy, counted)
    upto = Window.partitionBy(key).orderBy(ahead(at)).rowsBetween(BEFORE, 0)
    done = ordinary.withColumn(out, fold(value).over(upto))
    if hot is None:
        return done
    earlier = Window.partitionBy(key).orderBy(ahead("_slot")).rowsBetween(BEFORE, -1)
    carried = hot.groupBy(key, "_slot").agg(fold(value).alias("_part")).select(
        F.col(key).alias("_key"), F.col("_slot").alias("_of"), fold("_part").over(earlier).alias("_carry")
    )
    within = fold(value).over(Window.partitionBy(key, "_slot").orderBy(ahead(at)).rowsBetween(BEFORE, 0))
    carry = F.col("_carry")
    whole = F.least(within, carry) if least_later else within + F.coalesce(carry, F.lit(0))
    joined = hot.join(carried, (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_of")))
    return done.unionByName(joined.withColumn(out, whole).select(*done.columns))


def _owner_counts(
    valid: DataFrame, key: str, owner: str, start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Per key and start or end point of its rows: ``_owners``, how many distinct owners are active from ``_at`` on.

    Owners' intervals are merged first, so a running sum of +1/-1 counts distinct owners.
    """
    merged = coalesce_intervals(valid.select(key, owner, start, end), [key, owner], start, end, policy)
    # a column of its own for the key: only then does the union see that both sides may be partitioned alike
    own = F.col(key).alias(key)
    steps = merged.select(
        own,
        F.inline(
            F.array(
                F.struct(F.col(start).alias("_at"), F.lit(1).alias("_step")),
                F.struct(F.col(end).alias("_at"), F.lit(-1).alias("_step")),
            )
        ),
    )
    asked = valid.select(own, F.explode(F.array(start, end)).alias("_at"), F.lit(0).alias("_step"))
    points = steps.unionByName(asked).groupBy(key, "_at").agg(F.sum("_step").alias("_step"))
    return _running(points, key, "_at", "_step", "_owners", policy, valid.select(key)).select(key, "_at", "_owners")


def other_owner_spans(
    df: DataFrame, key: str, owner: str, start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Per key and day point: ``_shared_from``, the first point at or after it from which two owners overlap."""
    valid = df.filter((F.col(start) < F.col(end)) & F.col(key).isNotNull() & F.col(owner).isNotNull())
    counts = _owner_counts(valid, key, owner, start, end, policy)
    shared = counts.select(key, "_at", F.when(F.col("_owners") > 1, F.col("_at")).alias("_shared"))
    return _running(shared, key, "_at", "_shared", "_shared_from", policy, valid.select(key), least_later=True).select(
        key, "_at", "_shared_from"
    )


def other_owner_overlap(
    df: DataFrame, key: str, owner: str, start: str, end: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Distinct (key, start, end) for which another owner holds the key at an overlapping time."""
    shared = other_owner_spans(df, key, owner, start, end, policy).withColumnsRenamed({key: "_key"})
    rows = df.filter(F.col(owner).isNotNull()).select(key, start, end).distinct()
    on = (F.col(key) == F.col("_key")) & (F.col(start) == F.col("_at")) & (F.col("_shared_from") < F.col(end))
    return rows.join(shared, on, "left_semi")


def overlap_conflicts(df: DataFrame, key: str, owner: str, start: str, end: str) -> DataFrame:
    """Per key: the number of ordered pairs of overlapping rows with different owners, as decimal ``conflicts``.

    Overlapping pairs are counted, not listed: of all rows, those that start before my end less those that end by my
    start. Pairs of one owner are subtracted.
    """
    valid = df.filter((F.col(start) < F.col(end)) & F.col(key).isNotNull() & F.col(owner).isNotNull())

    def overlapping_pairs(keys: list[str]) -> DataFrame:
        points = (
            valid.select(
                *keys,
                F.inline(
                    F.array(
                        F.struct(F.col(start).alias("_at"), F.lit(1).alias("_s"), F.lit(0).alias("_e")),
                        F.struct(F.col(end).alias("_at"), F.lit(0).alias("_s"), F.lit(1).alias("_e")),
                    )
                ),
            )
            .groupBy(*keys, "_at")
            .agg(F.sum("_s").alias("_s"), F.sum("_e").alias("_e"))
        )
        window = Window.partitionBy(*keys).orderBy("_at")
        started = F.coalesce(F.sum("_s").over(window.rowsBetween(BEFORE, -1)), F.lit(0)).cast("decimal(19,0)")
        ended = F.sum("_e").over(window.rowsBetween(BEFORE, 0)).cast("decimal(19,0)")
        starts, ends = F.col("_s").cast("decimal(18,0)"), F.col("_e").cast("decimal(18,0)")
        return (
            points.withColumn("_started", started)
            .withColumn("_ended", ended)
            .groupBy(*keys)
            .agg(F.sum(ends * F.col("_started") - starts * F.col("_ended")).cast("decimal(38,0)").alias("_pairs"))
        )

    own = F.col(key).alias(key)
    every = overlapping_pairs([key]).select(own, "_pairs")
    same = overlapping_pairs([key, owner]).select(own, (-F.col("_pairs")).alias("_pairs"))
    return every.unionByName(same).groupBy(key).agg(F.sum("_pairs").cast("decimal(38,0)").alias("conflicts"))


_LEVELS = 12
_DAY_SHIFT = 1_000_000


def _cut_into_blocks(df: DataFrame, first: str, last: str) -> DataFrame:
    """Cut the day range [first, last] into aligned blocks of 4^level days, at most six per level. Replaces the two
    columns by ``level`` and ``block``."""
    size, parent = F.col("_size"), F.col("_size") * 4
    low = F.ceil(F.col(first) / size).cast("long")
    high = F.floor((F.col(last) + 1) / size).cast("long") - 1
    # blocks whose parent fits too are covered one level up
    up_low = F.ceil(F.col(first) / parent).cast("long") * 4
    up_high = (F.floor((F.col(last) + 1) / parent).cast("long") - 1) * 4 + 3
    top = F.floor(F.log(4.0, F.col(last) - F.col(first) + 1) + 0.001).cast("int")
    none = F.array().cast("array<bigint>")

    def run(a: Column, b: Column) -> Column:
        return F.when(b >= a, F.sequence(a, b)).otherwise(none)

    return (
        df.withColumn("level", F.explode(F.sequence(F.lit(0), top)))
        .withColumn("_size", F.get(_sizes(), F.col("level")))
        .withColumns({"_low": low, "_high": high, "_up_low": up_low, "_up_high": up_high})
        .withColumn(
            "block",
            F.explode(
                F.when(F.col("_up_low") > F.col("_up_high"), run(F.col("_low"), F.col("_high"))).otherwise(
                    F.concat(run(F.col("_low"), F.col("_up_low") - 1), run(F.col("_up_high") + 1, F.col("_high")))
                )
            ),
        )
        .drop(first, last, "_size", "_low", "_high", "_up_low", "_up_high")
    )


def _sizes() -> Column:
    return F.array(*[F.lit(4**k).cast("long") for k in range(_LEVELS)])


def point_numbers(
    points: DataFrame, keys: Sequence[str], at: str, out: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Number the distinct points of each key from 1 in their order. Hot keys are numbered slot by slot, each slot after the counts
    of those before it."""
    ordinary, hot = _by_heat(points, keys, at, policy)
    order = Window.partitionBy(*keys).orderBy(at)
    done = ordinary.withColumn(out, F.row_number().over(order).cast("long"))
    if hot is None:
        return done
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(BEFORE, -1)
    counts = hot.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n")).select(
        *keys, "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    in_slot = Window.partitionBy(*keys, "_slot").orderBy(at)
    numbered = hot.join(counts, [*keys, "_slot"]).withColumn(out, F.row_number().over(in_slot) + F.col("_before"))
    return done.unionByName(numbered.select(*points.columns, F.col(out).cast("long").alias(out)))


def overlap_classify(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    include_equal_start: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Distinct (keys, start, end) with four flags, each true if some other row of the key stands in that relation:

    ``outside_flg`` a later start, an end not later; ``inside_flg`` an earlier start, an end not earlier;
    ``right_flg`` starts inside, ends later; ``left_flg`` starts earlier, ends inside. Starts compare strictly, so
    rows with the same start are not seen unless ``include_equal_start`` (then the longer row counts as outside, the
    shorter as inside, on one start).

    Nothing pairs rows with rows. Hot keys and dates go by ``_classify_by_lookups``. The rows of other keys are shuffled once, by key, and
    classified where they are. The first two flags are running extremes. The other two ask whether, among the distinct bounds between
    a row's own, some row starts that ends later, or some row ends that started earlier: the bounds of the key are numbered and
    collected in aligned blocks of 4^k, a row looks at the blocks that make up its range. Blocks are kept up to the size that some row
    of the key needs.
    """
    keys = list(keys)
    known = F.col(start).isNotNull() & F.col(end).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    rows = df.filter(known).select(*keys, start, end)
    if isinstance(df.schema[start].dataType, T.DateType):
        return _classify_by_lookups(rows, keys, start, end, include_equal_start, policy)
    time_slot(df, start, policy)  # refuses other types at any size
    ordinary, hot = split_hot(rows, keys, policy)
    dealt = in_bounded_parts(ordinary.repartition(*keys), keys, rows.count(), SPANS_PER_TASK)
    done = _classify_in_place(dealt, keys, start, end, include_equal_start)
    if hot is None:
        return done
    return done.unionByName(_classify_by_lookups(hot, keys, start, end, include_equal_start, policy))


def _classify_in_place(rows: DataFrame, keys: list[str], start: str, end: str, include_equal_start: bool) -> DataFrame:
    """``overlap_classify`` of rows that are dealt by key, without another shuffle."""
    spans = rows.groupBy(*keys, start, end).agg(F.count(F.lit(1)).alias("_copies"))
    ends = F.array(
        F.struct(F.col(start).alias("_at"), F.lit(0).alias("_side")), F.struct(F.col(end).alias("_at"), F.lit(1).alias("_side"))
    )
    points = spans.select("*", F.inline(ends))
    # before a row's start come the rows of earlier starts, and of its start with shorter ends, which are not longer; before its end
    # those of earlier ends, and of its end with later starts
    order = Window.partitionBy(*keys).orderBy("_at", "_side", end, F.col(start).desc())
    before = order.rowsBetween(BEFORE, -1)
    is_start = F.col("_side") == 0
    inside = F.max(F.when(is_start, F.col(end))).over(before) >= F.col(end)
    outside = F.max(F.when(~is_start, F.col(start))).over(before) > F.col(start)
    inside, outside = is_start & F.coalesce(inside, F.lit(False)), ~is_start & F.coalesce(outside, F.lit(False))
    if include_equal_start:
        twin = F.col("_copies") > 1
        shorter = F.lag("_at").over(order) == F.col("_at")
        longer = (F.lead("_at").over(order) == F.col("_at")) & (F.lead("_side").over(order) == 0)
        outside = outside | (is_start & (F.coalesce(shorter, F.lit(False)) | twin))
        inside = inside | (is_start & (F.coalesce(longer, F.lit(False)) | twin))
    numbered = points.withColumns({"_inside": inside, "_outside": outside}).withColumn(
        "_n", F.dense_rank().over(Window.partitionBy(*keys).orderBy("_at")).cast("long")
    )
    ranged = numbered.groupBy(*keys, start, end).agg(
        F.max("_inside").alias("_inside"),
        F.max("_outside").alias("_outside"),
        F.max(F.when(is_start, F.col("_n"))).alias("_n_start"),
        F.max(F.when(~is_start, F.col("_n"))).alias("_n_end"),
    )
    # bounds strictly between a row's own
    between = F.col("_n_end") - F.col("_n_start") - 1
    # of the largest block that fits; -1 for an empty range
    top = F.when(between > 0, F.floor(F.log(4.0, between) + 0.001)).otherwise(-1).cast("int")
    largest = Window.partitionBy(*keys).orderBy(F.col("_top").desc()).rowsBetween(BEFORE, 0)
    levelled = (
        ranged.withColumn("_top", top)
        .withColumn("_most", F.greatest(F.max("_top").over(largest), F.lit(0)))
        .withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("_most"))))
    )
    size = F.get(_sizes(), F.col("_level"))
    parent = size * 4
    first, last = F.col("_n_start") + 1, F.col("_n_end") - 1
    low, high = F.ceil(first / size).cast("long"), F.floor((last + 1) / size).cast("long") - 1
    # blocks whose parent fits too are looked at one level up
    up_low, up_high = F.ceil(first / parent).cast("long") * 4, (F.floor((last + 1) / parent).cast("long") - 1) * 4 + 3
    none = F.array().cast("array<bigint>")

    # numbers of a block: its starts, its ends and, after them, the rows that look at it
    def coded(a: Column, b: Column) -> Column:
        return F.when(b >= a, F.sequence(a * 4 + 2, b * 4 + 2, F.lit(4).cast("long"))).otherwise(none)

    asked = F.when(F.col("_level") > F.col("_top"), none).otherwise(
        F.when(up_low > up_high, coded(low, high)).otherwise(F.concat(coded(low, up_low - 1), coded(up_high + 1, high)))
    )
    own = F.array(
        F.floor(F.col("_n_start") / size).cast("long") * 4, F.floor(F.col("_n_end") / size).cast("long") * 4 + 1
    )
    met = levelled.select(
        *keys, start, end, "_inside", "_outside", "_level", F.explode(F.concat(own, asked)).alias("_code")
    ).select("*", F.shiftright("_code", 2).alias("_block"), F.col("_code").bitwiseAND(3).alias("_kind"))
    block = Window.partitionBy(*keys, "_level", "_block").orderBy("_kind").rowsBetween(BEFORE, 0)
    looked = met.withColumns(
        {
            "_latest": F.max(F.when(F.col("_kind") == 0, F.col(end))).over(block),
            "_earliest": F.min(F.when(F.col("_kind") == 1, F.col(start))).over(block),
        }
    ).filter((F.col("_kind") == 2) | ((F.col("_kind") == 0) & (F.col("_level") == 0)))
    asks = F.col("_kind") == 2
    flags = {
        "outside_flg": F.col("_outside"),
        "inside_flg": F.col("_inside"),
        "right_flg": asks & (F.col("_latest") > F.col(end)),
        "left_flg": asks & (F.col("_earliest") < F.col(start)),
    }
    found = looked.groupBy(*keys, start, end).agg(*[F.max(made).alias(name) for name, made in flags.items()])
    return found.select(*keys, start, end, *[F.coalesce(name, F.lit(False)).alias(name) for name in flags])


def _classify_by_lookups(
    rows: DataFrame, keys: list[str], start: str, end: str, include_equal_start: bool, policy: SkewPolicy
) -> DataFrame:
    """``overlap_classify`` for keys of any number of rows.

    The first two flags are running extremes over distinct starts. The other two ask, for a point, which interval strictly covering
    it starts last or ends first: intervals are cut into aligned blocks of 4^k days, a point looks up the blocks it lies in. Bounds of
    other types than dates are first replaced by their number among the distinct bounds of the key.
    """
    spans = rows.groupBy(*keys, start, end).agg(F.count(F.lit(1)).alias("_copies"))

    order, back = Window.partitionBy(*keys).orderBy(start), Window.partitionBy(*keys).orderBy(F.col(start).desc())
    reach = (
        spans.groupBy(*keys, start)
        .agg(F.max(end).alias("_longest"), F.min(end).alias("_shortest"))
        .withColumn("_earlier_end", F.max("_longest").over(order.rowsBetween(BEFORE, -1)))
        .withColumn("_later_end", F.min("_shortest").over(back.rowsBetween(BEFORE, -1)))
    )

    points = spans.select(*keys, F.explode(F.array(start, end)).alias("_at")).distinct()
    if isinstance(rows.schema[start].dataType, T.DateType):
        numbered = points.withColumn("_day", _day("_at"))
        inner = spans.select(*keys, start, end, (_day(start) + 1).alias("_first"), (_day(end) - 1).alias("_last"))
    else:
        numbered = point_numbers(points, keys, "_at", "_day", policy)
        begin, stop = (
            numbered.select(*keys, F.col("_at").alias(bound), (F.col("_day") + step).alias(name))
            for bound, step, name in ((start, 1, "_first"), (end, -1, "_last"))
        )
        inner = spans.drop("_copies").join(begin, [*keys, start]).join(stop, [*keys, end])
    inner = inner.filter(F.col("_first") <= F.col("_last"))
    covered = (
        _cut_into_blocks(inner, "_first", "_last")
        .groupBy(*keys, "level", "block")
        .agg(F.max(start).alias("_last_start"), F.min(end).alias("_first_end"))
    )
    stabbed = (
        numbered.select(*keys, "_at", "_day", F.posexplode(_sizes()).alias("level", "_size"))
        .withColumn("block", F.floor(F.col("_day") / F.col("_size")).cast("long"))
        .join(covered, [*keys, "level", "block"])
        .groupBy(*keys, "_at")
        .agg(F.max("_last_start").alias("_last_start"), F.min("_first_end").alias("_first_end"))
    )
    at_start = stabbed.select(*keys, F.col("_at").alias(start), "_first_end")
    at_end = stabbed.select(*keys, F.col("_at").alias(end), "_last_start")
    joined = (
        spans.join(reach, [*keys, start])
        .join(at_start, [*keys, start], "left")
        .join(at_end, [*keys, end], "left")
    )
    outside, inside = F.col("_later_end") <= F.col(end), F.col("_earlier_end") >= F.col(end)
    if include_equal_start:
        twin = F.col("_copies") > 1
        outside = F.coalesce(outside, F.lit(False)) | (F.col("_shortest") < F.col(end)) | twin
        inside = F.coalesce(inside, F.lit(False)) | (F.col("_longest") > F.col(end)) | twin
    return joined.select(
        *keys,
        start,
        end,
        F.coalesce(outside, F.lit(False)).alias("outside_flg"),
        F.coalesce(inside, F.lit(False)).alias("inside_flg"),
        F.coalesce(F.col("_last_start") > F.col(start), F.lit(False)).alias("right_flg"),
        F.coalesce(F.col("_first_end") < F.col(end), F.lit(False)).alias("left_flg"),
    )


# --- flagged fragments, merged per row -----------------------------------------------------------------------------


def _day(name: str) -> Column:
    return (F.unix_date(F.col(name)) + _DAY_SHIFT).cast("long")


# each gives two segments and these a row for every block size
SPANS_PER_TASK = 100_000


def _segment_flags(valid: DataFrame, key: str, start: str, end: str, weight: str, owner: str | None) -> DataFrame:
    """Elementary segments that hold a row: ``_from``, ``_to``, ``_best`` (largest weight active), ``_shared`` (two
    owners active). Rows are reduced to distinct intervals and cut into day blocks; segments look their blocks up.

    The distinct intervals are dealt by key, so that blocks, segments and, with ``JOINS_IN_PLACE``, lookups stay where they are."""
    spans = valid.groupBy(key, start, end).agg(F.max(weight).alias("_w")).repartition(key)
    spans = in_bounded_parts(spans, [key], valid.count(), SPANS_PER_TASK)
    covered = (
        _cut_into_blocks(
            spans.select(key, "_w", _day(start).alias("_first"), (_day(end) - 1).alias("_last")), "_first", "_last"
        )
        .groupBy(key, "level", "block")
        .agg(F.max("_w").alias("_w"))
    )
    segs = segments(spans, [key], start, end).withColumnsRenamed({"seg_start": "_from", "seg_end": "_to"})
    best = (
        segs.select(key, "_from", "_to", _day("_from").alias("_day"), F.posexplode(_sizes()).alias("level", "_size"))
        .withColumn("block", F.floor(F.col("_day") / F.col("_size")).cast("long"))
        .join(covered, [key, "level", "block"])
        .groupBy(key, "_from", "_to")
        .agg(F.max("_w").alias("_best"))
    )
    if owner is None:
        return best.withColumn("_shared", F.lit(False))
    counts = _owner_counts(valid, key, owner, start, end).withColumnRenamed("_at", "_from")
    return best.join(counts, [key, "_from"]).withColumn("_shared", F.col("_owners") > 1).drop("_owners")


def merge_flagged(
    rows: DataFrame,
    key: str,
    start: str,
    end: str,
    weight: str,
    owner: str | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Fragment by ``key``, flag each fragment (``_shared``: another owner is active; ``_main``: no active row weighs
    more) and merge the fragments of a row with equal flags to one interval, without listing fragments.

    Each row gives at most four rows. Bounds come from equi joins with per-segment tables: the first and last segment
    of a row that does not have it as best, with a pointer past those that do; and the segments where its weight is
    best. ``keep`` stores the segment table between uses. Dates only; empty rows are dropped. A NULL bound, which
    ``fragment`` takes as open, is an error: a row without one has no last segment to end with.
    """
    bounded = F.when(F.col(start).isNull() | F.col(end).isNull(), F.raise_error(F.lit("a bound is NULL")).cast("boolean"))
    valid = rows.filter(F.coalesce(bounded, F.col(start) < F.col(end)) & F.col(key).isNotNull())
    segs = _segment_flags(valid, key, start, end, weight, owner)
    segs = segs if keep is None else keep(segs)
    alike = Window.partitionBy(key, "_shared").orderBy("_from")
    alike_back = Window.partitionBy(key, "_shared").orderBy(F.col("_from").desc())
    pointed = (
        segs.withColumn("_run_begins", ~F.col("_best").eqNullSafe(F.lag("_best").over(alike)))
        .withColumn("_run_ends", ~F.col("_best").eqNullSafe(F.lead("_best").over(alike)))
        .withColumn(
            "_skip_on", F.min(F.when(F.col("_run_begins"), F.col("_from"))).over(alike_back.rowsBetween(BEFORE, -1))
        )
        .withColumn("_skip_back", F.max(F.when(F.col("_run_ends"), F.col("_to"))).over(alike.rowsBetween(BEFORE, -1)))
    )
    forward = Window.partitionBy(key).orderBy(F.col("_from").desc()).rowsBetween(BEFORE, 0)
    backward = Window.partitionBy(key).orderBy("_from").rowsBetween(BEFORE, 0)
    on = F.struct(F.col("_from").alias("at"), F.col("_best").alias("best"), F.col("_skip_on").alias("skip"))
    back = F.struct(F.col("_to").alias("at"), F.col("_best").alias("best"), F.col("_skip_back").alias("skip"))
    kinds = [False] if owner is None else [False, True]
    looked = pointed.select(
        F.col(key).alias("_key"),
        "_from",
        "_to",
        *[F.min(F.when(F.col("_shared") == x, on)).over(forward).alias(f"_on_{x}") for x in kinds],
        *[F.max(F.when(F.col("_shared") == x, back)).over(backward).alias(f"_back_{x}") for x in kinds],
    )
    begins = looked.select(F.col("_key").alias(key), F.col("_from").alias(start), *[f"_on_{x}" for x in kinds])
    ends = looked.select(F.col("_key").alias(key), F.col("_to").alias(end), *[f"_back_{x}" for x in kinds])
    span = F.struct(F.col("_from").alias("a"), F.col("_to").alias("b"))
    mains = (
        segs.filter(F.col("_best").isNotNull())
        .groupBy(F.col(key).alias("_key3"), F.col("_best").alias("_best3"))
        .agg(*[F.collect_list(F.when(F.col("_shared") == x, span)).alias(f"_main_{x}") for x in kinds])
    )
    joined = salted_join(valid, begins, [key, start], policy=policy)
    joined = salted_join(joined, ends, [key, end], policy=policy, counted=valid)
    joined = joined.join(mains, (F.col(key) == F.col("_key3")) & (F.col(weight) == F.col("_best3")), "left")

    def piece(x: bool, main: bool, low: Column, high: Column) -> Column:
        made = F.struct(F.lit(x).alias("_shared"), F.lit(main).alias("_main"), low.alias("_low"), high.alias("_high"))
        return F.when((low < F.col(end)) & (high > F.col(start)), made)

    def other(pointer: str) -> Column:
        at = F.col(pointer)
        return F.when(F.coalesce(at["best"] == F.col(weight), F.lit(False)), at["skip"]).otherwise(at["at"])

    pieces = []
    for x in kinds:
        own = F.filter(F.col(f"_main_{x}"), lambda d: (d["a"] >= F.col(start)) & (d["b"] <= F.col(end)))
        pieces.append(piece(x, False, other(f"_on_{x}"), other(f"_back_{x}")))
        pieces.append(
            piece(x, True, F.array_min(F.transform(own, lambda d: d["a"])), F.array_max(F.transform(own, lambda d: d["b"])))
        )
    others = [c for c in rows.columns if c not in (start, end)]
    return joined.select(
        *others, F.inline(F.filter(F.array(*pieces), lambda p: p.isNotNull()))
    ).select(*others, F.col("_low").alias(start), F.col("_high").alias(end), "_shared", "_main")


# --- days ----------------------------------------------------------------------------------------------------------


def range_join_days(df: DataFrame, days: DataFrame, day: str, start: str, end: str) -> DataFrame:
    """One row per (day of ``days``, row of ``df``) with ``start <= day <= end``.

    Intervals are clipped to the calendar before they are listed day by day, so an open end costs nothing.
    ``days``: one row per date. Broadcast is bounded by the calendar.
    """
    # one row, so the bounds become literals that reach the scan of df
    first, last = days.agg(F.min(day), F.max(day)).first()
    low, high = F.greatest(F.col(start), F.lit(first)), F.least(F.col(end), F.lit(last))
    clipped = df.filter((F.col(start) <= F.lit(last)) & (F.col(end) >= F.lit(first)) & (F.col(start) <= F.col(end)))
    listed = clipped.withColumn(day, F.explode(F.sequence(low, high)))
    return listed.join(F.broadcast(days.select(day).distinct()), day)
