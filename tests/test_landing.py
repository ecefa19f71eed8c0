from datetime import datetime

from caseflow.functions.text import clean_strings
from caseflow.schemas import strings
from caseflow.sources import landing
from tests.conftest import rows

SCHEMA = strings("id", "name", "note")
TS = datetime(2025, 1, 1)

DAMAGED = '''id,name,note
1, plain ,kept
2,"quoted, comma",NULL
3,short
4,long,one,extra
5,null,\\N
6,"say ""hi""",
7,  ,x
'''


def test_damaged_rows_load_and_are_quarantined(spark, tmp_path):
    (tmp_path / "feed.csv").write_text(DAMAGED)
    landed = landing.land_csv(spark, str(tmp_path), SCHEMA, TS)
    assert rows(landed, "id", "name", "note") == [
        ("1", "plain", "kept"),
        ("2", "quoted, comma", None),
        ("3", "short", None),
        ("4", "long", "one"),
        ("5", None, None),
        ("6", 'say "hi"', None),
        ("7", None, "x"),
    ]
    bad = landing.quarantine(landing.read_text_rows(spark, str(tmp_path), SCHEMA))
    assert rows(bad, "id", landing.CORRUPT) == [("3", "3,short"), ("4", "4,long,one,extra")]


def test_landed_rows_carry_time_and_file(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("id,name,note\n1,a,b\n")
    row = landing.land_csv(spark, str(tmp_path), SCHEMA, TS).first()
    assert row["_loaded_at"] == TS and row["_source_file"].endswith("/feed.csv")


def test_header_only_file_is_empty(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("id,name,note\n")
    assert landing.land_csv(spark, str(tmp_path), SCHEMA, TS).count() == 0


def test_columns_bind_by_position(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("x,y,z\n1,a,b\n")
    assert rows(landing.land_csv(spark, str(tmp_path), SCHEMA, TS), "id", "name") == [("1", "a")]


def test_load_audit_counts_per_file(spark, tmp_path):
    for name, n in (("one.csv", 2), ("two.csv", 3)):
        (tmp_path / name).write_text("id,name,note\n" + "1,a,b\n" * n)
    table = landing.land_csv(spark, str(tmp_path), SCHEMA, TS)
    audit = landing.load_audit({"feed": table, "again": table})
    counts = {(r.tbl, r._source_file.rsplit("/", 1)[1]): r.row_count for r in audit.collect()}
    assert counts == {
        ("feed", "one.csv"): 2, ("feed", "two.csv"): 3, ("again", "one.csv"): 2, ("again", "two.csv"): 3,
    }


def test_clean_strings_leaves_other_types(spark):
    df = spark.createDataFrame([(1, "NULL")], "n int, s string")
    assert tuple(clean_strings(df).first()) == (1, None)
