from datetime import datetime

import pytest

from caseflow.schemas import strings
from caseflow.sources.snapshots import ChangeTable, SnapshotTable
from caseflow.streaming.ingest import ingest_new_files
from caseflow.streaming.upsert import merge_batch, upsert_new_files
from pyspark.sql import types as T
from tests.conftest import rows

TS = datetime(2025, 1, 1)
SCHEMA = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("v", T.StringType()), T.StructField("n", T.IntegerType())]
)


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_files_load_once(spark, tmp_path):
    feed = tmp_path / "in"
    feed.mkdir()

    def run():
        return ingest_new_files(
            spark, str(feed), strings("id", "v"), f"{tmp_path}/out", f"{tmp_path}/checkpoint", TS
        )

    (feed / "one.csv").write_text("id,v\n1,a\n2,NULL\n")
    assert rows(run(), "id", "v") == [("1", "a"), ("2", None)]
    assert run().count() == 2
    (feed / "two.csv").write_text("id,v\n3,c\n")
    assert rows(run(), "id", "v") == [("1", "a"), ("2", None), ("3", "c")]


def test_snapshots_replace_and_survive_a_broken_write(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.read(SCHEMA).count() == 0
    table.write(batch(spark, ("a", "x", 1)))
    table.write(table.read().unionByName(batch(spark, ("b", "y", 2))))
    assert rows(table.read()) == [("a", "x", 1), ("b", "y", 2)]
    broken = tmp_path / "batch-000000000002"
    broken.mkdir()
    (broken / "part-0.parquet").write_text("half a file")
    assert table.batches() == [0, 1] and table.read().count() == 2
    assert table.write(batch(spark, ("c", "z", 3))).count() == 1 and table.batches() == [0, 1, 2]


def test_change_table_merges_replays_and_compacts(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path), SCHEMA, ["k"], "n")
    assert table.read().count() == 0
    merge_batch(table, batch(spark, ("a", "old", 1), ("b", "old", 1)), 0, 3)
    merge_batch(table, batch(spark, ("a", "new", 2), ("b", "stale", 0)), 1, 3)
    want = [("a", "new", 2), ("b", "old", 1)]
    assert rows(table.read()) == want
    merge_batch(table, batch(spark, ("a", "other", 9)), 1, 3)  # a replay of batch 1
    assert rows(table.read()) == want and table.pending() == 2
    merge_batch(table, batch(spark, ("c", "late", 1)), 2, 3)  # the third batch compacts
    assert table.pending() == 0 and table.base.batches() == [2]
    assert rows(table.read()) == want + [("c", "late", 1)]
    assert rows(table.compact()) == want + [("c", "late", 1)]
    merge_batch(table, batch(spark, ("c", "later", 5)), 3, 3)
    assert rows(table.read()) == want + [("c", "later", 5)]


def test_stream_merges_each_file_once(spark, tmp_path):
    table = ChangeTable(spark, f"{tmp_path}/table", SCHEMA, ["k"], "n")

    def run():
        return upsert_new_files(table, f"{tmp_path}/in", f"{tmp_path}/checkpoint", compact_every=2)

    batch(spark, ("a", "x", 1), ("b", "y", 1)).write.mode("append").parquet(f"{tmp_path}/in")
    assert rows(run()) == [("a", "x", 1), ("b", "y", 1)]
    batch(spark, ("a", "z", 3), ("a", "older", 2), ("b", "stale", 0)).write.mode("append").parquet(f"{tmp_path}/in")
    assert rows(run()) == [("a", "z", 3), ("b", "y", 1)]
    assert rows(run()) == [("a", "z", 3), ("b", "y", 1)]
