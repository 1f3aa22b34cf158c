"""Staging and history: parity cases and invariants."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from spanledger import constants as C
from spanledger.functions import interval_text, ntz
from spanledger.operators import change_data as D
from spanledger.plans.metadata import snapshot_history
from spanledger.session import materialize
from spanledger.sources.fixtures import empty_history
from tests.conftest import PLAIN

T0 = datetime(2024, 1, 1, 10)
OPEN = datetime(2999, 12, 31, 23, 59, 59)
FEED = "id int, status_nm string, create_dttm timestamp_ntz, update_dttm timestamp_ntz, operation string, stamp timestamp_ntz"


def at(hours):
    return T0 + timedelta(hours=hours)


def change(i, status, op, hours):
    return (i, status, T0, at(hours), op, at(hours))


def staged(spark, rows):
    return materialize(D.stage_new_changes(spark.createDataFrame(rows, FEED), None), "stage")


def load(spark, rows, policy=PLAIN):
    return materialize(D.load_history(empty_history(spark), staged(spark, rows), policy=policy).history, "history")


def versions(history):
    return sorted(
        (
            (r.id, r.status_nm, r.valid_from_dttm, r.valid_to_dttm, r.deleted_flg, r.deleted_dttm)
            for r in history.collect()
        ),
        key=repr,
    )


def naive_load(old, batch):
    """One load in plain Python, rows as (id, status, from, to, deleted, deleted_at)."""
    known = {r[0] for r in old}
    out = [list(r) for r in old]
    out += [[c[0], c[1], c[5], OPEN, False, None] for c in batch if c[4] == "I" and c[1] == "accepted" and c[0] not in known]
    known = {r[0] for r in out}
    for c in batch:
        if c[4] in "UD" and c[0] in known:
            dead = c[4] == "D"
            out.append([c[0], None if dead else c[1], c[5], OPEN, dead, c[5] if dead else None])
    starts = {}
    for r in out:
        starts.setdefault(r[0], []).append(r[2])
    for r in out:
        if r[3] == OPEN:
            r[3] = min([s for s in starts[r[0]] if s > r[2]], default=OPEN)
    groups = {}
    for r in out:
        groups.setdefault((r[0], r[1], r[4], r[5]), []).append((r[2], r[3]))
    merged = []
    for (i, st, dead, when), spans in groups.items():
        spans.sort()
        cur = list(spans[0])
        for s, e in spans[1:]:
            if s <= cur[1]:
                cur[1] = max(cur[1], e)
            else:
                merged.append((i, st, *cur, dead, when))
                cur = [s, e]
        merged.append((i, st, *cur, dead, when))
    return sorted(merged, key=repr)


def random_feed(seed, late=False):
    r = random.Random(seed)
    rows = []
    for i in range(4):
        rows.append(change(i, "accepted", "I", 0))
        for h in range(1, 9):
            op = r.choice("UUUD")
            rows.append(change(i, r.choice(["executed", "paused", "complited"]), op, h))
    cut = [[c for c in rows if c[5] < at(4)], [c for c in rows if c[5] >= at(4)]]
    if late:
        first = [c for c in rows if c[4] == "I" or r.random() < 0.5]
        cut = [first, [c for c in rows if c not in first]]
    return cut


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("late", [False, True])
def test_two_loads_equal_naive(spark, policy, seed, late):
    first, second = random_feed(seed, late)
    one = load(spark, first, policy)
    assert versions(one) == naive_load([], first)
    batch = staged(spark, second)
    two = D.load_history(one, batch, policy=policy).history
    assert versions(two) == naive_load(naive_load([], first), second)
    also = D.unsettled_keys(one)
    touched = D.load_history(one, batch, recompute="touched", also=also, policy=policy).history
    assert versions(touched) == naive_load(naive_load([], first), second)


def test_batches_equal_one_batch_in_order(spark):
    first, second = random_feed(9)
    one = load(spark, first)
    two = D.load_history(one, staged(spark, second)).history
    whole = load(spark, first + second)
    assert versions(two) == versions(whole)
    by_id = {}
    for v in versions(whole):
        by_id.setdefault(v[0], []).append(v)
    for rows in by_id.values():
        rows.sort(key=lambda v: v[2])
        assert [v[3] for v in rows] == [v[2] for v in rows[1:]] + [OPEN]


def test_not_accepted_insert_is_dropped_but_processed(spark):
    stage = staged(spark, [change(1, "paused", "I", 0), change(1, "executed", "U", 1)])
    result = D.load_history(empty_history(spark), stage)
    assert result.history.count() == 0
    assert all(r.is_processed_flg for r in result.stage.collect())
    counts = {r.check_name: r.n for r in result.checks.collect()}
    assert counts["check_new_status"] == 1 and counts["check_unknown_entity"] == 1


def test_checks_against_existing_history(spark):
    old = load(spark, [change(1, "accepted", "I", 0), change(1, "complited", "U", 1)])
    batch = staged(
        spark,
        [change(1, "executed", "U", 2), change(1, "paused", "D", 3), change(1, None, "D", 4), change(2, "x", "U", 2)],
    )
    counts = {r.check_name: r.n for r in D.history_checks(batch, old).collect()}
    assert counts == {
        "check_new_status": 0,
        "check_update_finished": 1,
        "check_delete_unfinished": 1,
        "check_unknown_entity": 1,
    }


def test_checks_of_nothing_are_zero(spark):
    empty = staged(spark, [])
    assert [r.n for r in D.history_checks(empty, empty_history(spark)).collect()] == [0, 0, 0, 0]


def test_late_change_modes(spark, policy):
    old = load(spark, [change(1, "accepted", "I", 0), change(1, "paused", "U", 4)])
    late = staged(spark, [change(1, "executed", "U", 2)])
    parity = versions(D.load_history(old, late, policy=policy).history)
    assert (1, "accepted", at(0), at(4), False, None) in parity
    repaired = versions(D.load_history(old, late, close="all", policy=policy).history)
    assert (1, "accepted", at(0), at(2), False, None) in repaired


def test_tombstone_stays_open_and_leaves_current_state(spark):
    stage = staged(spark, [change(1, "accepted", "I", 0), change(1, "complited", "D", 1), change(2, "accepted", "I", 0)])
    history = D.load_history(empty_history(spark), stage).history
    assert (1, None, at(1), OPEN, True, at(1)) in versions(history)
    assert [(r.id, r.update_dttm) for r in D.current_state(history).collect()] == [(2, at(0))]


def test_one_stamp_twice_is_found_by_key_check(spark):
    from spanledger.operators.quality import duplicate_keys

    stage = staged(spark, [change(1, "accepted", "I", 0), change(1, "paused", "U", 1), change(1, "executed", "U", 1)])
    known = D.history_keys(D.insert_new(stage, D.history_keys(empty_history(spark))))
    rows = D.insert_changes(stage, known)
    assert duplicate_keys(rows, ["hash_key", "valid_from_dttm"]).count() == 1


def null_rows(seed):
    r = random.Random(seed)
    pick = lambda *v: r.choice(v)
    return [
        (pick(1, 2), pick("a", "b", None), pick(T0, None), pick(T0, None), pick("I", "U"), at(pick(0, 1)))
        for _ in range(12)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_null_aware_anti_is_not_in(spark, seed):
    left, right = null_rows(seed), null_rows(seed + 50)[:4]

    def dropped(a):
        return any(all(x is None or y is None or x == y for x, y in zip(a, b)) for b in right)

    got = D.null_aware_anti(
        spark.createDataFrame(left, FEED),
        spark.createDataFrame(right, FEED),
        ["id", "operation", "stamp"],
        ["status_nm", "create_dttm", "update_dttm"],
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(a) for a in left if not dropped(a))


@pytest.mark.parametrize("seed", range(4))
def test_not_in_with_nulls_in_every_column(spark, seed):
    r = random.Random(seed)
    rows = lambda n: [tuple(r.choice([1, 2, 3, None]) for _ in range(3)) for _ in range(n)]
    left, right = rows(30) * 2, [x for x in rows(5 - seed) if x != (None, None, None)]

    def dropped(a):
        return any(all(x is None or y is None or x == y for x, y in zip(a, b)) for b in right)

    schema = "a int, b int, c int"
    frames = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = D.not_in(*frames, ["a", "b", "c"])
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(a) for a in left if not dropped(a))
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    assert D.not_in(frames[0], spark.createDataFrame([(None, None, None)], schema), ["a", "b", "c"]).count() == 0
    assert D.not_in(frames[0], frames[1].limit(0), ["a", "b", "c"]).count() == len(left)


def test_capture_changes_of_null_keys(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "a2"), (1, "b")], "k int, v string")
    got = D.capture_changes(old, new, ["k"], ntz("2024-01-01 00:00:00")).collect()
    assert [(r.k, r.v, r.operation) for r in got] == [(None, "a2", "U")]


def test_staging_twice_adds_nothing_and_keeps_copies(spark):
    rows = [change(1, "accepted", "I", 0)] * 2
    feed = spark.createDataFrame(rows, FEED)
    stage = D.stage_new_changes(feed, None)
    assert stage.count() == 2
    assert D.stage_new_changes(feed, stage).count() == 0


def test_interval_text(spark):
    cases = {
        "2023-05-06 10:11:12.5": "45050 days 10:11:12.5",
        "1900-01-01 00:00:00": "00:00:00",
        "1900-01-02 00:00:00": "1 day",
        "1900-01-01 01:02:03": "01:02:03",
        "1901-01-01 00:00:00": "365 days",
        "1899-12-30 22:00:00": "-1 days -02:00:00",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.select("t", interval_text(F.col("t").cast("timestamp_ntz")).alias("x")).collect()
    assert {r.t: r.x for r in got} == cases


def test_missing_creation_time_has_a_key(spark):
    row = (1, "accepted", None, T0, "I", T0)
    assert staged(spark, [row]).first().hash_key is not None


def test_capture_changes(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (5, None)], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d"), (5, None)], "k int, v string")
    got = D.capture_changes(old, new, ["k"], ntz("2024-01-01 00:00:00")).collect()
    assert sorted((r.k, r.v, r.operation) for r in got) == [(2, "b", "U"), (3, "c", "D"), (4, "d", "I")]


def test_snapshot_history_over_three_snapshots(spark, policy):
    snaps = [[(1, "a"), (2, "b")], [(1, "a2"), (2, "b")], [(2, "b"), (3, "c")]]
    frames = [spark.createDataFrame(s, "k int, v string") for s in snaps]
    history, before = None, frames[0].limit(0)
    for n, now in enumerate(frames):
        history = snapshot_history(history, before, now, ["k"], ntz(f"2024-01-0{n + 1} 00:00:00"), policy)
        before = now
    got = sorted(((r.k, r.v, r.valid_from_dttm.day, r.valid_to_dttm.year, r.deleted_flg) for r in history.collect()), key=repr)
    assert got == sorted(
        [
            (1, "a", 1, 2024, False),
            (1, "a2", 2, 2024, False),
            (1, None, 3, 2999, True),
            (2, "b", 1, 2999, False),
            (3, "c", 3, 2999, False),
        ],
        key=repr,
    )


def test_metadata_table_from_copy_to_history(spark, tmp_path):
    from spanledger.plans.metadata import DAG_CODE, DAG_INFORMATION

    source = spark.createDataFrame([("a.py", "x = 1", 5)], "fileloc string, source_code string, size int")
    old = DAG_CODE.transfer(source, f"{tmp_path}/old")
    new = DAG_CODE.transfer(source.withColumn("source_code", F.lit("x = 2")), f"{tmp_path}/new")
    history = DAG_CODE.history(None, old, new, ntz("2024-01-01 00:00:00")).collect()
    assert [(r.fileloc, r.source_code, r.deleted_flg) for r in history] == [("a.py", "x = 2", False)]
    assert len(DAG_INFORMATION.columns) == 23 and DAG_INFORMATION.key == ["dag_id"]


def test_open_end_constant():
    assert datetime.fromisoformat(C.OPEN_END) == OPEN


def test_a_load_refuses_one_stamp_twice(spark):
    stage = staged(spark, [change(1, "accepted", "I", 0), change(1, "paused", "U", 1), change(1, "executed", "U", 1)])
    with pytest.raises(ValueError, match="same stamp"):
        D.load_history(empty_history(spark), stage)
