"""Tables compared by checksums of key ranges give what comparing all rows gives, and read only the ranges that differ."""

import random
import re

import pytest
from pyspark.sql import functions as F

from spanledger.operators.change_data import capture_changes
from spanledger.operators.digests import (
    DigestedTable, capture_by_digest, difference_by_digest, differing_ranges, whole_number_range,
)
from spanledger.operators.quality import tagged_difference

SCHEMA = "id long, name string, kind string, amount double"


def stored(spark, rows, of=None):
    df = spark.createDataFrame(rows, SCHEMA)
    return df, DigestedTable.write(df, df.columns, whole_number_range("id", 0, 999, 20) if of is None else of)


def some_rows(seed, n=300):
    rng = random.Random(seed)
    pick = lambda: (rng.choice([None, *range(-200, 1200)]), rng.choice([None, "a", "b"]), rng.choice([None, "a"]), rng.choice([None, 0.5, -0.0]))
    return [pick() for _ in range(n)]


def ordered(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_difference_equals_that_of_all_rows(spark, seed):
    rows = some_rows(seed)
    rng = random.Random(seed)
    other = [r for r in rows if r[0] is None or r[0] // 50 % 3 or rng.random() < 0.8] + some_rows(seed + 50, 12)
    (a, da), (b, db) = stored(spark, rows), stored(spark, other)
    want = ordered(tagged_difference(a, b, a.columns))
    assert want and ordered(difference_by_digest(spark, da, db)) == want
    assert ordered(difference_by_digest(spark, da, stored(spark, rows[::-1])[1])) == []


@pytest.mark.parametrize(
    "mine, theirs",
    [
        ([(1, None, "a", None)], [(1, "a", None, None)]),  # a NULL counts by its place
        ([(1, "a", "a", 0.5)] * 2, [(1, "b", "a", 0.5)] * 2),  # copies of one row, copies of another
        ([(None, "a", "a", 0.5)], []),  # a key without a value is a range too
        ([], [(1, None, None, None)]),
        ([], []),
    ],
)
def test_small_tables(spark, mine, theirs):
    (a, da), (b, db) = stored(spark, mine), stored(spark, theirs)
    assert ordered(difference_by_digest(spark, da, db)) == ordered(tagged_difference(a, b, a.columns))


def test_repeated_rows_differ_in_digest_but_not_in_result(spark):
    row = (5, "a", "b", 1.0)
    (_, da), (_, db) = stored(spark, [row]), stored(spark, [row, row])
    assert differing_ranges(spark, da, db) == [0] and difference_by_digest(spark, da, db).count() == 0


def test_only_folders_of_differing_ranges_are_read(spark):
    rows = [(k, f"n{k}", None, float(k)) for k in range(1000)]
    changed = [*rows[:420], (420, "other", None, 420.0), *rows[421:]]
    (a, da), (b, db) = stored(spark, rows), stored(spark, changed)
    assert differing_ranges(spark, da, db) == [8]
    found = difference_by_digest(spark, da, db)
    assert ordered(found) == ordered(tagged_difference(a, b, a.columns))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[[^\]]*digest_range", plan)) == 2
    read = da.rows(spark, [8]).select(F.input_file_name()).distinct().collect()
    assert read and all("digest_range=8/" in r[0] for r in read)


def test_captured_changes(spark):
    old = [(k, f"n{k % 7}", None, 1.0) for k in range(0, 1000, 3)] + [(None, "x", "y", 2.0)]
    new = [r for r in old if r[0] is None or r[0] % 90] + [(2000 + k, "new", None, None) for k in range(5)]
    new = [(k, "moved" if k == 333 else n, kind, x) for k, n, kind, x in new]
    (a, da), (b, db) = stored(spark, old), stored(spark, new)
    stamp = F.lit("2024-01-01").cast("timestamp_ntz")
    want = ordered(capture_changes(a, b, ["id"], stamp))
    assert ordered(capture_by_digest(spark, da, db, ["id"], stamp)) == want and len(want) == 18


def test_tables_of_other_columns_are_refused(spark):
    a = stored(spark, [])[1]
    other = spark.createDataFrame([], "id long, name string")
    b = DigestedTable.write(other, other.columns, whole_number_range("id", 0, 9, 2))
    with pytest.raises(ValueError):
        difference_by_digest(spark, a, b)
