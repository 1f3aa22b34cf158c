"""Change capture, staging and versioned history."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanledger import constants as C
from spanledger.functions import entity_hash, ntz
from spanledger.operators.intervals import (
    coalesce_in_slots,
    coalesce_intervals,
    coalesce_whole,
    lead_in_slots,
    next_value,
)
from spanledger.operators.quality import duplicate_keys
from spanledger.scale import DEFAULT_POLICY, SkewPolicy, broadcast_if_small, in_bounded_parts, split_hot, time_slot
from spanledger.session import materialize

FEED = ["id", "status_nm", "create_dttm", "update_dttm", "operation", "stamp"]
HISTORY = [
    "id",
    "status_nm",
    "create_dttm",
    "hash_key",
    "valid_from_dttm",
    "valid_to_dttm",
    "deleted_flg",
    "deleted_dttm",
]
VERSION = ["id", "status_nm", "create_dttm", "hash_key", "deleted_flg", "deleted_dttm"]


def null_aware_anti(left: DataFrame, right: DataFrame, required: Sequence[str], nullable: Sequence[str]) -> DataFrame:
    """``(required, nullable) NOT IN (right)`` with SQL's NULL rules: a left row goes if some right row is equal or
    unknown on every column. ``required`` columns hold no NULL on either side, so they carry the hash join."""
    columns = [*required, *nullable]
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    condition = F.lit(True)
    for c in required:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    for c in nullable:
        condition = condition & F.coalesce(F.col(c) == F.col(f"_r_{c}"), F.lit(True))
    return left.join(r, condition, "left_anti")


def not_in(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(columns) NOT IN (right)`` with SQL's NULL rules, where any column may be NULL on either side: a left row goes if some
    right row is equal or unknown on every column. Repeated rows stay repeated.

    Rows are told apart by which columns are NULL; only patterns that occur are listed (one row each, whatever the tables' size).
    A pair of patterns leaves the columns that both know, so each needs an equi anti join and nothing compares row by row.
    """
    columns = list(columns)

    def pattern(prefix: str = "") -> Column:
        return sum((F.col(prefix + c).isNull().cast("int") * (1 << k) for k, c in enumerate(columns)), F.lit(0))

    other = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    here, there = (
        sorted(r.p for r in df.select(p.alias("p")).distinct().collect())
        for df, p in ((left, pattern()), (other, pattern("_r_")))
    )
    parts = []
    for mine in here:
        part = left.filter(pattern() == mine)
        by_known: dict[tuple[str, ...], list[int]] = {}
        for theirs in there:
            known = tuple(c for k, c in enumerate(columns) if not (mine | theirs) >> k & 1)
            by_known.setdefault(known, []).append(theirs)
        if () in by_known:
            continue  # unknown on every column
        for known, theirs in by_known.items():
            on = F.lit(True)
            for c in known:
                on = on & (F.col(c) == F.col(f"_r_{c}"))
            keys = other.filter(pattern("_r_").isin(theirs)).select(*[f"_r_{c}" for c in known])
            part = part.join(keys, on, "left_anti")
        parts.append(part)
    return reduce(DataFrame.unionAll, parts) if parts else left.filter(F.lit(False))


def capture_changes(old: DataFrame, new: DataFrame, key: Sequence[str], stamp: Column) -> DataFrame:
    """Compare two snapshots: new image with ``I``/``U``, old image with ``D``, unchanged rows left out. NULL keys are equal."""
    payload = [c for c in new.columns if c not in key]
    o = old.select(*key, F.struct(*payload).alias("_old"))
    n = new.select(*key, F.struct(*payload).alias("_new"))
    o, n = (df.withColumnsRenamed({k: f"{side}{k}" for k in key}) for df, side in ((o, "_o_"), (n, "_n_")))
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}"))
    present = F.coalesce(F.col("_new").isNotNull(), F.lit(False))
    both = o.join(n, same, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(
        *[F.when(present, F.col(f"_n_{k}")).otherwise(F.col(f"_o_{k}")).alias(k) for k in key], "_old", "_new"
    )
    operation = F.when(F.col("_old").isNull(), "I").when(F.col("_new").isNull(), "D").otherwise("U")
    image = F.coalesce("_new", "_old")
    return both.select(
        *key, *[image[c].alias(c) for c in payload], operation.alias("operation"), stamp.alias("stamp")
    )


def with_entity_hash(df: DataFrame, key: str = "id", created: str = "create_dttm") -> DataFrame:
    return df.withColumn("hash_key", entity_hash(F.col(key), F.col(created)))


def stage_new_changes(feed: DataFrame, stage: DataFrame | None) -> DataFrame:
    """Feed rows not yet staged, with key and an unset processed flag. Copies inside the feed stay copies."""
    fresh = feed.select(*FEED)
    if stage is not None:
        fresh = null_aware_anti(
            fresh, stage, ["id", "operation", "stamp"], ["status_nm", "create_dttm", "update_dttm"]
        )
    return with_entity_hash(fresh).withColumn("is_processed_flg", F.lit(False))


def unprocessed_batch(stage: DataFrame) -> DataFrame:
    return stage.filter(~F.col("is_processed_flg"))


def mark_processed(stage: DataFrame, batch: DataFrame) -> DataFrame:
    """Set the flag on stage rows matching the batch by operation, stamp and key."""
    match = ["operation", "stamp", "hash_key"]
    used = batch.select(*[F.col(c).alias(f"_b_{c}") for c in match]).distinct().withColumn("_used", F.lit(True))
    on = F.lit(True)
    for c in match:
        on = on & (F.col(c) == F.col(f"_b_{c}"))
    flag = F.when(F.col("_used"), True).otherwise(F.col("is_processed_flg"))
    return stage.join(used, on, "left").withColumn("is_processed_flg", flag).select(*stage.columns)


# --- versioned history ---------------------------------------------------------------------------------------------


def history_keys(history: DataFrame) -> DataFrame:
    return history.select("hash_key").distinct()


def insert_new(batch: DataFrame, known: DataFrame, accepted: Column | None = None) -> DataFrame:
    """Open versions for inserts of unknown keys. ``accepted`` restricts which inserts count (default: by status)."""
    wanted = (F.col("status_nm") == C.ACCEPTED) if accepted is None else accepted
    return (
        batch.filter((F.col("operation") == "I") & wanted)
        .join(known.select("hash_key"), "hash_key", "left_anti")
        .select(
            "id",
            "status_nm",
            "create_dttm",
            "hash_key",
            F.col("stamp").alias("valid_from_dttm"),
            ntz(C.OPEN_END).alias("valid_to_dttm"),
            F.lit(False).alias("deleted_flg"),
            F.lit(None).cast("timestamp_ntz").alias("deleted_dttm"),
        )
    )


def insert_changes(batch: DataFrame, known: DataFrame) -> DataFrame:
    """Open versions for updates and deletes of known keys; a delete leaves a tombstone without status."""
    deleted = F.col("operation") == "D"
    return (
        batch.filter(F.col("operation").isin("U", "D"))
        .join(known.select("hash_key"), "hash_key", "left_semi")
        .select(
            "id",
            F.when(~deleted, F.col("status_nm")).alias("status_nm"),
            "create_dttm",
            "hash_key",
            F.col("stamp").alias("valid_from_dttm"),
            ntz(C.OPEN_END).alias("valid_to_dttm"),
            deleted.alias("deleted_flg"),
            F.when(deleted, F.col("stamp")).alias("deleted_dttm"),
        )
    )


FROM, TO = "valid_from_dttm", "valid_to_dttm"


def _end_versions(led: DataFrame, close: str) -> DataFrame:
    ended = F.coalesce("_next", ntz(C.OPEN_END))
    if close == "open_only":
        ended = F.when(F.col(TO) == ntz(C.OPEN_END), ended).otherwise(F.col(TO))
    return led.withColumn(TO, ended).drop("_next")


def close_versions(
    history: DataFrame, close: str = "open_only", key: Sequence[str] = ("hash_key",), policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """End each open version where the next one of its key starts. ``close="all"`` re-ends closed versions too, which
    also repairs the neighbour of a late change."""
    return _end_versions(next_value(history, list(key), FROM, "_next", policy), close)


def coalesce_versions(history: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> DataFrame:
    """Merge touching or overlapping versions of a key with equal attributes."""
    return coalesce_intervals(history, VERSION, FROM, TO, policy, hot_by=["hash_key"]).select(*HISTORY)


def close_and_coalesce(
    versions: DataFrame,
    close: str = "open_only",
    key: Sequence[str] = ("hash_key",),
    policy: SkewPolicy = DEFAULT_POLICY,
    task_rows: int | None = None,
) -> DataFrame:
    """Both steps; ordinary keys need one shuffle for them, hot keys go by time slots.

    ``task_rows``: about how many rows of ordinary keys one task may hold, for ``versions`` that are a stored table.
    """
    keys = list(key)
    attributes = [c for c in versions.columns if c not in (FROM, TO)]
    ordinary, hot = split_hot(versions, keys, policy)
    if task_rows is not None:
        ordinary = in_bounded_parts(ordinary, keys, versions.count(), task_rows)
    led = ordinary.withColumn("_next", F.lead(FROM).over(Window.partitionBy(*keys).orderBy(FROM)))
    done = coalesce_whole(_end_versions(led, close), attributes, FROM, TO)
    if hot is not None:
        led = lead_in_slots(hot.withColumn("_slot", time_slot(hot, FROM, policy)), keys, FROM, "_next")
        done = done.unionByName(coalesce_in_slots(_end_versions(led, close), attributes, FROM, TO))
    return done.select(*versions.columns)


def current_state(history: DataFrame) -> DataFrame:
    """Open, not deleted versions in the shape of the source."""
    return history.filter(~F.col("deleted_flg") & (F.col("valid_to_dttm") == ntz(C.OPEN_END))).select(
        "id", "status_nm", "create_dttm", F.col("valid_from_dttm").alias("update_dttm")
    )


def unsettled_keys(history: DataFrame) -> DataFrame:
    """Keys whose next load could still change something: an open version that is not the last one."""
    is_open = F.col("valid_to_dttm") == ntz(C.OPEN_END)
    return (
        history.groupBy("hash_key")
        .agg(
            F.max("valid_from_dttm").alias("_last"),
            F.min(F.when(is_open, F.col("valid_from_dttm"))).alias("_open"),
        )
        .filter(F.col("_open") < F.col("_last"))
        .select("hash_key")
    )


def history_checks(batch: DataFrame, history: DataFrame) -> DataFrame:
    """The four load checks as (check, category, n), against the history before the load.

    Both sides are first reduced to one row per key, so no key is large in the join.
    """
    op, status = F.col("operation"), F.col("status_nm")
    finished = status.isin(*C.FINISHED)
    per_key = batch.groupBy("hash_key").agg(
        F.count_if((op == "I") & (status != C.ACCEPTED)).alias("odd_new"),
        F.count_if((op == "I") & (status == C.ACCEPTED)).alias("good_new"),
        F.count_if(op == "U").alias("updates"),
        F.count_if((op == "D") & ~finished).alias("odd_deletes"),
        F.count_if(op.isin("U", "D")).alias("changes"),
    )
    over = F.coalesce(status, F.lit(C.COMPLITED)).isin(*C.FINISHED) & (F.col("valid_to_dttm") == ntz(C.OPEN_END))
    seen = history.groupBy("hash_key").agg(F.count_if(over).alias("over"))
    joined = per_key.join(seen, "hash_key", "left")
    old = F.col("over").isNotNull()
    known = old | (F.col("good_new") > 0)

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name)

    sums = joined.agg(
        total(F.when(~old, F.col("odd_new")), "check_new_status"),
        total(F.when(old, F.col("updates") * F.col("over")), "check_update_finished"),
        total(F.when(known, F.col("odd_deletes")), "check_delete_unfinished"),
        total(F.when(~known, F.col("changes")), "check_unknown_entity"),
    )
    return sums.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"), F.lit(category).alias("category"), F.col(name).alias("n")
                    )
                    for name, category in [
                        ("check_new_status", 2),
                        ("check_update_finished", 2),
                        ("check_delete_unfinished", 2),
                        ("check_unknown_entity", 3),
                    ]
                ]
            )
        ).alias("c")
    ).select("c.*")


# --- one pass over stored and arriving versions --------------------------------------------------------------------

#: Counts that ``merge_load`` observes: what its steps did, and the load checks with their categories.
CHECK_CATEGORIES = {
    "check_new_status": 2,
    "check_update_finished": 2,
    "check_delete_unfinished": 2,
    "check_unknown_entity": 3,
}


def merge_load(
    history: DataFrame,
    batch: DataFrame,
    close: str = "open_only",
    arrived: Observation | None = None,
    closed: Observation | None = None,
) -> DataFrame:
    """The history after a load of ``batch``, read once and without joins: stored and arriving versions are one relation, and
    windows over ``hash_key`` decide which arrivals count, end the open versions and merge equal neighbours.

    Where both sides are partitioned by ``hash_key`` alike (a bucketed table, a batch repartitioned to its buckets), nothing is
    shuffled beyond that. Results are those of ``load_history``. A change that the history already holds (same start, same
    attributes) is left out, so a repeated batch changes nothing; another version from the same stamp is an error.

    ``arrived`` and ``closed`` observe the counts of steps and checks while the result is written, so none is computed apart.
    """
    op, open_end = F.col("_op"), ntz(C.OPEN_END)
    deleted = F.col("operation") == "D"
    # a column of its own for the key: only then does the union see that both sides are partitioned alike
    columns = [F.col(c).alias(c) if c == "hash_key" else F.col(c) for c in HISTORY]
    stored = history.select(*columns, F.lit(None).cast("string").alias("_op"), F.lit(None).cast("string").alias("_said"))
    incoming = batch.select(
        F.col("id").cast(history.schema["id"].dataType).alias("id"),
        F.when(~deleted, F.col("status_nm")).alias("status_nm"),
        "create_dttm",
        "hash_key",
        F.col("stamp").alias(FROM),
        open_end.alias(TO),
        F.coalesce(deleted, F.lit(False)).alias("deleted_flg"),
        F.when(deleted, F.col("stamp")).alias("deleted_dttm"),
        F.col("operation").alias("_op"),
        F.col("status_nm").alias("_said"),
    )
    old, finished = op.isNull(), F.col("_said").isin(*C.FINISHED)
    good = F.coalesce((op == "I") & (F.col("_said") == C.ACCEPTED), F.lit(False))
    over = old & F.coalesce(F.col("status_nm"), F.lit(C.COMPLITED)).isin(*C.FINISHED) & (F.col(TO) == open_end)
    per_key, per_version = Window.partitionBy("hash_key"), Window.partitionBy("hash_key", FROM, "status_nm", "deleted_flg")
    marked = (
        stored.unionByName(incoming)
        .withColumn("_held", F.max(old).over(per_key) & F.col("hash_key").isNotNull())
        .withColumn("_opened", F.max(good).over(per_key))
        .withColumn("_over", F.count_if(over).over(per_key))
        .withColumn("_again", F.max(old).over(per_version) & ~old)
    )
    held, known = F.col("_held"), F.col("_held") | F.col("_opened")
    change = F.coalesce(op.isin("U", "D"), F.lit(False))
    new = good & ~held
    if arrived is not None:
        marked = marked.observe(
            arrived,
            F.count_if(new).alias("new"),
            F.count_if(change & known & F.col("hash_key").isNotNull()).alias("change"),
            F.count_if(~old).alias("processed"),
            F.count_if((op == "I") & (F.col("_said") != C.ACCEPTED) & ~held).alias("check_new_status"),
            F.sum(F.when((op == "U") & held, F.col("_over")).otherwise(0)).alias("check_update_finished"),
            F.count_if((op == "D") & ~finished & known).alias("check_delete_unfinished"),
            F.count_if(change & ~known).alias("check_unknown_entity"),
        )
    kept = marked.filter(old | new | (change & known & F.col("hash_key").isNotNull() & ~F.col("_again"))).select(*HISTORY)
    twice = F.raise_error(F.lit("a key has two versions from the same stamp")).cast("timestamp_ntz")
    following = F.lead(FROM).over(Window.partitionBy("hash_key").orderBy(FROM))
    led = kept.withColumn("_next", following).withColumn(
        "_next", F.when(F.col("_next") == F.col(FROM), twice).otherwise(F.col("_next"))
    )
    if closed is not None:
        led = led.observe(closed, F.count(F.lit(1)).alias("versions"), F.count_if(F.col(TO) == open_end).alias("open"))
    return coalesce_whole(_end_versions(led, close), VERSION, FROM, TO).select(*HISTORY)


def unseen_changes(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of the batch whose version (key, start, attributes) the history does not hold yet."""
    held = history.select(
        F.col("hash_key").alias("_key"), F.col(FROM).alias("_at"), F.col("status_nm").alias("_status"), F.col("deleted_flg").alias("_dead")
    )
    dead = F.coalesce(F.col("operation") == "D", F.lit(False))
    status = F.when(~dead, F.col("status_nm"))
    same = (F.col("hash_key") == F.col("_key")) & (F.col("stamp") == F.col("_at"))
    return batch.join(held, same & (dead == F.col("_dead")) & status.eqNullSafe(F.col("_status")), "left_anti")


def observed_steps(spark: SparkSession, arrived: dict, closed: dict, rows: int) -> DataFrame:
    """The steps of a ``merge_load`` from its observed counts, in the form of ``LoadResult.steps``."""
    counts = [
        ("new entities", 0, "insert", arrived["new"]),
        ("changes of known entities", 0, "insert", arrived["change"]),
        ("version ends", 0, "update", closed["open"]),
        ("merged versions", 1, "", closed["versions"] - rows),
        ("stage rows marked", 0, "update", arrived["processed"]),
    ]
    return spark.createDataFrame(counts, "message string, category int, type_operation string, count_row long")


def observed_checks(spark: SparkSession, arrived: dict) -> DataFrame:
    """The checks of a ``merge_load`` from its observed counts, in the form of ``history_checks``."""
    found = [(name, category, arrived[name] or 0) for name, category in CHECK_CATEGORIES.items()]
    return spark.createDataFrame(found, "check_name string, category int, n long")


@dataclass
class LoadResult:
    history: DataFrame
    recomputed: DataFrame
    stage: DataFrame
    checks: DataFrame
    steps: DataFrame


def _load_steps(versions: DataFrame, recomputed: DataFrame, batch: DataFrame) -> DataFrame:
    """What each step of a load did, as rows for the audit log: message, category, type_operation, count_row."""
    origin = F.col("_origin")
    counted = versions.agg(
        F.count_if(origin == "new").alias("new"),
        F.count_if(origin == "change").alias("change"),
        F.count_if(F.col("valid_to_dttm") == ntz(C.OPEN_END)).alias("open"),
        F.count(F.lit(1)).alias("merged"),
        F.lit(0).cast("long").alias("processed"),
    )
    zero = F.lit(0).cast("long")
    kept = recomputed.agg(
        zero.alias("new"), zero.alias("change"), zero.alias("open"), (-F.count(F.lit(1))).alias("merged"), zero.alias("processed")
    )
    done = batch.agg(
        zero.alias("new"), zero.alias("change"), zero.alias("open"), zero.alias("merged"), F.count(F.lit(1)).alias("processed")
    )
    total = counted.unionByName(kept).unionByName(done).agg(
        *[F.sum(c).alias(c) for c in ["new", "change", "open", "merged", "processed"]]
    )
    steps = [
        ("new entities", 0, "insert", "new"),
        ("changes of known entities", 0, "insert", "change"),
        ("version ends", 0, "update", "open"),
        ("merged versions", 1, "", "merged"),
        ("stage rows marked", 0, "update", "processed"),
    ]
    rows = [
        F.struct(
            F.lit(message).alias("message"),
            F.lit(category).alias("category"),
            F.lit(operation).alias("type_operation"),
            F.col(c).alias("count_row"),
        )
        for message, category, operation, c in steps
    ]
    return total.select(F.inline(F.array(*rows)))


def load_history(
    history: DataFrame,
    stage: DataFrame,
    close: str = "open_only",
    recompute: str = "all",
    also: DataFrame | None = None,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> LoadResult:
    """One load of unprocessed stage rows into the history.

    ``recompute="touched"`` recomputes only keys in the batch (and in ``also``, meant for ``unsettled_keys`` of the
    load before) and passes all other versions through; with ``also`` kept up, results equal ``"all"``. Two versions of
    one key from the same stamp are an error, since which of them comes last would be arbitrary.
    """
    batch = unprocessed_batch(stage)
    old = history.select(*HISTORY)
    rest = None
    if recompute == "touched":
        touched = batch.select("hash_key")
        if also is not None:
            touched = touched.unionByName(also.select("hash_key"))
        touched = broadcast_if_small(materialize(touched.distinct(), "touched"))
        rest = old.join(touched, "hash_key", "left_anti")
        old = old.join(touched, "hash_key", "left_semi")
    known = history_keys(old)
    new = insert_new(batch, known)
    changes = insert_changes(batch, known.unionByName(history_keys(new)))
    # written once: the steps below read it several times, each a few columns
    tagged = materialize(
        old.withColumn("_origin", F.lit("old"))
        .unionByName(new.withColumn("_origin", F.lit("new")))
        .unionByName(changes.withColumn("_origin", F.lit("change"))),
        "versions",
    )
    double = duplicate_keys(tagged, ["hash_key", FROM]).limit(1).count()
    if double:
        raise ValueError("a key has two versions from the same stamp")
    recomputed = close_and_coalesce(tagged.drop("_origin"), close, policy=policy)
    return LoadResult(
        history=recomputed if rest is None else rest.select(*HISTORY).unionByName(recomputed),
        recomputed=recomputed,
        stage=mark_processed(stage, batch),
        checks=history_checks(batch, old),
        steps=_load_steps(tagged, recomputed, batch),
    )
