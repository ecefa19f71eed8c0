import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators import dims
from caseflow.sources.snapshots import SnapshotTable
from tests.conftest import rows

KEY, ATTRS, SK = "id", ("name", "region"), "sk"
SCHEMA = "id string, name string, region string"
DAY = [date(2025, 1, 1), date(2025, 2, 1), date(2025, 3, 1)]
OPEN = date(9999, 12, 31)
TS = datetime(2025, 1, 1)


def load(spark, dim, as_of, *source):
    df = spark.createDataFrame(list(source), SCHEMA)
    return dims.apply_changes(dim, df, KEY, ATTRS, SK, as_of, TS)


def versions(dim):
    return rows(dim, "id", "name", "region", "valid_from", "valid_to", "is_current")


@pytest.fixture(scope="module")
def first(spark):
    return load(
        spark, None, DAY[0],
        ("same", "n", "EU"), ("moved", "n", "EU"), ("gone", "n", "EU"), ("null", None, "EU"), ("lost", "n", "EU"),
    )


SECOND = [
    ("same", "n", "EU"), ("moved", "n", "US"), ("null", None, "EU"), ("lost", "n", None), ("new", "n", "EU"),
]


def test_first_load_opens_every_key(first):
    assert versions(first)[0] == ("gone", "n", "EU", DAY[0], OPEN, True)
    assert sorted(r.sk for r in first.collect()) == [1, 2, 3, 4, 5]


def test_changed_and_new_rows(spark, first):
    source = spark.createDataFrame(SECOND, SCHEMA)
    assert rows(dims.changed_versions(first, source, KEY, ATTRS), "id") == [("lost",), ("moved",)]
    assert rows(dims.new_versions(first, source, KEY, ATTRS), "id") == [("lost",), ("moved",), ("new",)]


def test_second_load_expires_and_inserts(spark, first):
    end = date(2025, 1, 31)
    assert versions(load(spark, first, DAY[1], *SECOND)) == [
        ("gone", "n", "EU", DAY[0], OPEN, True),  # a vanished key stays current
        ("lost", "n", "EU", DAY[0], end, False),
        ("lost", "n", None, DAY[1], OPEN, True),  # a change to NULL is a change
        ("moved", "n", "EU", DAY[0], end, False),
        ("moved", "n", "US", DAY[1], OPEN, True),
        ("new", "n", "EU", DAY[1], OPEN, True),
        ("null", None, "EU", DAY[0], OPEN, True),  # NULL equals NULL
        ("same", "n", "EU", DAY[0], OPEN, True),
    ]


def test_rerun_changes_nothing(spark, first):
    once = load(spark, first, DAY[1], *SECOND)
    assert versions(load(spark, once, DAY[2], *SECOND)) == versions(once)


def test_revert_opens_a_third_version(spark, first):
    once = load(spark, first, DAY[1], ("moved", "n", "US"))
    back = load(spark, once, DAY[2], ("moved", "n", "EU")).filter("id = 'moved'")
    assert rows(back, "region", "valid_from", "is_current") == [
        ("EU", DAY[0], False), ("EU", DAY[2], True), ("US", DAY[1], False),
    ]


def test_surrogate_keys_stay_and_go_on(spark, first):
    second = load(spark, first, DAY[1], *SECOND)
    before = dict(rows(first, "id", "sk"))
    kept = dict(rows(second.filter(F.col("valid_from") == F.lit(DAY[0])), "id", "sk"))
    assert kept == before
    assert sorted(r.sk for r in second.collect()) == list(range(1, 9))


def test_numbers_are_dense_unique_and_repeatable(spark):
    ids = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("id"))
    first = {r.id: r.n for r in dims.number_rows(ids, "id", "n", 100).collect()}
    again = {r.id: r.n for r in dims.number_rows(ids.repartition(17), "id", "n", 100).collect()}
    assert first == again and sorted(first.values()) == list(range(101, 5101))


def test_numbering_nothing(spark):
    empty = spark.createDataFrame([], "id string")
    assert dims.number_rows(empty, "id", "n").count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_lookup_as_of(spark, request, first, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    second = load(spark, first, DAY[1], *SECOND)
    cases = spark.createDataFrame(
        [
            ("before", "moved", date(2024, 1, 1)),  # the earliest version is open to the past
            ("old", "moved", date(2025, 1, 31)),
            ("new", "moved", DAY[1]),
            ("early", "new", date(2020, 1, 1)),
            ("unknown", "x", DAY[1]),
            ("nokey", None, DAY[1]),
            ("noday", "moved", None),
        ],
        "c string, id string, d date",
    )
    found = dims.lookup_as_of(cases, second, "id", F.col("d"), ("sk", "region"), "c")
    assert rows(found, "c", "region") == [
        ("before", "EU"), ("early", "EU"), ("new", "US"), ("noday", None), ("nokey", None), ("old", "EU"), ("unknown", None),
    ]


def test_second_change_on_one_day_is_never_looked_up(spark, first):
    once = load(spark, first, DAY[1], ("moved", "n", "US"))
    twice = load(spark, once, DAY[1], ("moved", "n", "APAC"))
    empty = twice.filter("valid_to < valid_from")
    assert rows(empty, "region") == [("US",)]
    case = spark.createDataFrame([("c", "moved", DAY[1]), ("d", "moved", DAY[0])], "c string, id string, d date")
    found = dims.lookup_as_of(case, twice, "id", F.col("d"), ("region",), "c")
    assert rows(found, "c", "region") == [("c", "APAC"), ("d", "EU")]


def test_one_current_version_per_key(spark, first):
    dim = load(spark, load(spark, first, DAY[1], *SECOND), DAY[2], ("moved", None, None), ("new", "n", "EU"))
    assert dims.current(dim).groupBy("id").count().filter("count > 1").count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_a_run_of_loads_matches_a_history_kept_by_hand(spark, tmp_path, seed):
    rng = random.Random(seed)
    table = SnapshotTable(spark, str(tmp_path), {"is_current": T.BooleanType()})
    history = {}  # key -> list of [name, region, valid_from, valid_to]
    for step in range(4):
        day = date(2025, 1 + step, 1)
        source = {f"k{i}": (rng.choice(["n", None]), rng.choice(["EU", "US", None])) for i in range(8) if rng.random() < 0.7}
        for key, values in source.items():
            past = history.setdefault(key, [])
            if past and tuple(past[-1][:2]) == values:
                continue
            if past:
                past[-1][3] = day - timedelta(days=1)
            past.append([*values, day, OPEN])
        dim = table.write(load(spark, table.read_before(step), day, *[(k, *v) for k, v in source.items()]), step)
        want = [(k, *v, v[3] == OPEN) for k, past in history.items() for v in past]
        assert versions(dim) == sorted(want, key=lambda r: [(x is None, str(x)) for x in r])
        assert sorted(r.sk for r in dim.collect()) == list(range(1, len(want) + 1))
