import random
from datetime import datetime, timedelta

import pytest

from caseflow.functions.time import ntz
from caseflow.operators.incremental import since_watermark, upsert_latest
from caseflow.operators.upsert import changes, one_per_key, upsert, upsert_with_audit
from tests.conftest import rows

SCHEMA = "k string, v string, n int"
T1 = datetime(2025, 1, 1)
T2 = T1 + timedelta(days=1)


@pytest.fixture
def target(spark):
    return spark.createDataFrame([("a", "old", 1), ("b", "old", 2), ("c", None, None)], SCHEMA)


@pytest.fixture
def source(spark):
    return spark.createDataFrame([("b", "new", 2), ("c", "set", 3), ("d", None, 4)], SCHEMA)


MERGED = [("a", "old", 1), ("b", "new", 2), ("c", "set", 3), ("d", None, 4)]


def test_upsert(target, source):
    assert rows(upsert(target, source, ["k"])) == MERGED


def test_upsert_is_idempotent(target, source):
    once = upsert(target, source, ["k"])
    assert rows(upsert(once, source, ["k"])) == MERGED
    assert tuple(changes(once, upsert(once, source, ["k"]), ["k"]).first()) == (4, 4, 0)


def test_changes_counts_new_gone_and_different(target, source):
    assert tuple(changes(target, source, ["k"]).first()) == (3, 3, 4)


def test_empty_sides(spark, target, source):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(upsert(empty, source, ["k"])) == rows(source)
    assert rows(upsert(target, empty, ["k"])) == rows(target)


def test_duplicate_source_key_is_an_error(target, source):
    with pytest.raises(Exception, match="duplicate merge key"):
        upsert(target, source.unionByName(source), ["k"]).collect()


def test_duplicate_source_key_takes_the_latest(spark, target):
    batch = spark.createDataFrame([("a", "x", 5), ("a", "y", 9), ("a", "z", 7)], SCHEMA)
    assert rows(upsert(target, batch, ["k"], order_by="n").filter("k = 'a'")) == [("a", "y", 9)]


def test_equal_order_values_pick_the_same_row(spark):
    batch = [("a", v, 1) for v in "qwert"]
    got = {
        rows(one_per_key(spark.createDataFrame(order, SCHEMA), ["k"], "n"))[0]
        for order in (batch, batch[::-1])
    }
    assert len(got) == 1


def test_composite_keys(spark):
    t = spark.createDataFrame([("a", "x", 1), ("a", "y", 2)], SCHEMA)
    s = spark.createDataFrame([("a", "y", 9)], SCHEMA)
    assert rows(upsert(t, s, ["k", "v"])) == [("a", "x", 1), ("a", "y", 9)]


def test_audit_columns(target, source):
    stamp = ntz(T1)
    loaded = target.withColumns({"_loaded_at": stamp, "_updated_at": stamp})
    merged = upsert_with_audit(loaded, source, ["k"], T2)
    assert rows(merged) == [
        ("a", "old", 1, T1, T1),
        ("b", "new", 2, T1, T2),
        ("c", "set", 3, T1, T2),
        ("d", None, 4, T2, T2),
    ]
    again = upsert_with_audit(merged, source, ["k"], T2)
    assert rows(again) == rows(merged)


def test_audited_merge_rejects_duplicates(target, source):
    stamp = ntz(T1)
    loaded = target.withColumns({"_loaded_at": stamp, "_updated_at": stamp})
    with pytest.raises(Exception, match="duplicate merge key"):
        upsert_with_audit(loaded, source.unionByName(source), ["k"], T2).collect()


def test_latest_row_wins_also_out_of_order(spark, target):
    batch = spark.createDataFrame(
        [("a", "stale", 0), ("a", "fresh", 7), ("a", "mid", 3), ("b", "stale", 1), ("e", "new", 1)], SCHEMA
    )
    merged = upsert_latest(target, batch, ["k"], "n")
    assert rows(merged) == [("a", "fresh", 7), ("b", "old", 2), ("c", None, None), ("e", "new", 1)]


def test_watermark_keeps_rows_at_the_mark(spark, target):
    feed = spark.createDataFrame([("x", "late", 1), ("y", "at", 2), ("z", "after", 3)], SCHEMA)
    assert rows(since_watermark(feed, target, "n"), "k") == [("y",), ("z",)]
    empty = spark.createDataFrame([], SCHEMA)
    assert since_watermark(feed, empty, "n").count() == 3


def test_a_new_source_column_is_null_in_the_rows_that_stay(spark, target):
    source = spark.createDataFrame([("b", "new", 2, "extra")], SCHEMA + ", e string")
    assert rows(upsert(target, source, ["k"])) == [
        ("a", "old", 1, None), ("b", "new", 2, "extra"), ("c", None, None, None),
    ]
    stamp = ntz(T1)
    loaded = target.withColumns({"_loaded_at": stamp, "_updated_at": stamp})
    merged = upsert_with_audit(loaded, source, ["k"], T2)
    assert rows(merged, "k", "e", "_loaded_at", "_updated_at") == [
        ("a", None, T1, T1), ("b", "extra", T1, T2), ("c", None, T1, T1),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_a_run_of_batches_matches_a_dictionary(spark, seed):
    rng = random.Random(seed)
    state, table = {}, spark.createDataFrame([], SCHEMA)
    for step in range(4):
        batch = {f"k{rng.randrange(12)}": (rng.choice(["x", "y", None]), step) for _ in range(rng.randrange(8))}
        state.update(batch)
        source = spark.createDataFrame([(k, *v) for k, v in batch.items()], SCHEMA)
        table = upsert(table, source, ["k"])
    assert rows(table) == sorted((k, *v) for k, v in state.items())
