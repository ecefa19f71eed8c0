"""Runs that cost what they touch: months, files, marks, damaged lines."""

import re
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators import staging
from caseflow.operators.incremental import since_mark, upsert_latest
from caseflow.plans import checks, registry
from caseflow.plans.warehouse import Warehouse
from caseflow.schemas import strings
from caseflow.sources import landing, ledger
from caseflow.sources.marks import Marks
from caseflow.sources.months import MonthTable, in_months
from tests.conftest import SMALL, rows

TS = datetime(2025, 1, 1)
CASE = T.StructType(
    [T.StructField("case_id", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("created_month", T.IntegerType())]
)


def test_months_are_replaced_taken_over_or_emptied(spark, tmp_path):
    months = MonthTable(spark, str(tmp_path))

    def write(data, run, touched=None):
        return months.write(spark.createDataFrame(data, CASE), run, touched)

    assert months.before(0) is None
    write([("a", 1, 202401), ("b", 1, 202402), ("c", 1, None), ("d", 1, 202404)], 0)
    kept = {f for f in months.folders(0) if "202402" in f}
    after = write([("a", 2, 202403), ("c", 2, None)], 1, {202401, 202403, None})
    assert rows(after) == [("a", 2, 202403), ("b", 1, 202402), ("c", 2, None), ("d", 1, 202404)]
    assert kept < set(months.folders(1)) and months.touched(1) == {202401, 202403, None} and months.touched(0) is None
    assert rows(months.before(1)) == [("a", 1, 202401), ("b", 1, 202402), ("c", 1, None), ("d", 1, 202404)]
    assert rows(write([("x", 9, 202401)], 1)) == rows(after)  # a run that is there is not written again
    write([], 2, set())
    assert rows(months.before(3)) == rows(after)
    write([("z", 3, 202401)], 3)
    assert rows(months.before(4)) == [("z", 3, 202401)]
    plan = after.filter(in_months({202402}))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*created_month", plan)


def test_a_run_writes_the_months_it_touches(spark):
    w = registry.touched_runs(spark, SMALL)
    w.fact  # noqa: B018
    touched = MonthTable(spark, f"{w.root}/stg_cases").touched(1)
    assert touched == set(range(199801, 199813))
    renamed = w.fact.filter(F.col("customer_name") == "Renamed")
    more = {r[0] for r in renamed.select("created_month").distinct().collect()}
    in_fact = MonthTable(spark, f"{w.root}/fact_cases")
    assert in_fact.touched(1) == touched | more and more - touched
    files = w.fact.select("created_month", "_updated_at", F.input_file_name().alias("file")).collect()
    for row in files:
        run = 1 if row["created_month"] in in_fact.touched(1) else 0
        assert f"/batch={run}/" in row["file"] and row["_updated_at"] == w.run_ts - timedelta(days=1 - run)
    assert any("/batch=0/" in r["file"] for r in files)


def test_a_case_that_moves_to_another_month_is_there_once(spark, tmp_path):
    schema = "case_id string, created_at string, closed_at string, customer_id string, agent_id string, category string, priority string, status string"

    def run(number, data):
        ts = TS + timedelta(days=number)
        cases = spark.createDataFrame(data, schema)
        feeds = {"cases": cases, "customers": spark.createDataFrame([("u", "n", "r", None)], strings("customer_id", "customer_name", "region", "signup_date")),
                 "agents": spark.createDataFrame([("a", "n", "t")], strings("agent_id", "agent_name", "team"))}
        extract = {name: landing.land(df, ts, F.lit("f")) for name, df in feeds.items()}
        return Warehouse(spark, extract, str(tmp_path), ts, ts.date(), run_id=number)

    one = [("1", "2024-01-05", None, "u", "a", "c", "p", "Open"), ("2", "2024-01-06", None, "u", "a", "c", "p", "Open"),
           ("3", "bad", None, "u", "a", "c", "p", "Open")]
    run(0, one).fact  # noqa: B018
    moved = run(1, [("1", "2024-03-01", None, "u", "a", "c", "p", "Open"), ("3", "2024-02-01", None, "u", "a", "c", "p", "Open")])
    assert rows(moved.fact, "case_id", "created_month") == [("1", 202403), ("2", 202401), ("3", 202402)]
    again = run(1, one)  # a repeated run is a no-op
    assert rows(again.fact, "case_id", "created_month") == rows(moved.fact, "case_id", "created_month")


def test_rules_reach_the_fact_the_monitor_and_later_runs(spark, tmp_path):
    schema = "case_id string, created_at string, closed_at string, customer_id string, agent_id string, category string, priority string, status string"
    closed, order = staging.further_rules()
    rules = (closed, order._replace(counts=False), staging.Rule("vip", F.col("priority") == "Urgent", counts=False))

    def run(number, data):
        ts = TS + timedelta(days=number)
        feeds = {"cases": spark.createDataFrame(data, schema),
                 "customers": spark.createDataFrame([("u", "n", "r", None)], strings("customer_id", "customer_name", "region", "signup_date")),
                 "agents": spark.createDataFrame([("a", "n", "t")], strings("agent_id", "agent_name", "team"))}
        extract = {name: landing.land(df, ts, F.lit("f")) for name, df in feeds.items()}
        return Warehouse(spark, extract, str(tmp_path), ts, ts.date(), run_id=number, rules=rules)

    w = run(0, [
        ("1", "2024-01-05", "soon", "u", "a", "c", "Urgent", "Closed"), ("2", "2024-01-06", "2024-01-06", "u", "a", "c", None, "Closed"),
        ("3", "2024-01-06", "2024-01-07", "u", "a", "c", "Low", "Closed"),
    ])
    flags = ("case_id", "invalid_closed_at", "invalid_resolution_order", "vip", "has_any_dq_flag")
    want = [("1", True, False, True, True), ("2", False, True, False, False), ("3", False, False, False, False)]
    assert rows(w.fact, *flags) == want
    assert w.monitor.select("dq_flagged", *[r.name for r in rules]).first() == (1, 1, 1, 1)
    assert w.monitor_history.count() == 1
    later = run(1, [("3", "2024-01-06", "??", "u", "a", "c", "Low", "Closed")])
    assert rows(later.fact, *flags) == [*want[:2], ("3", True, False, False, True)]
    history = checks.dq_drift_by_load(later.monitor_history)
    assert rows(history, "run_id", "dq_flagged", "dq_flag_pct", "previous_pct", "spike") == [(0, 1, 33.3, None, False), (1, 2, 66.7, 33.3, True)]


def test_upsert_latest_reads_the_target_once_in_full(spark, tmp_path):
    data = [(i, "x", TS) for i in range(50)]
    spark.createDataFrame(data, "id int, wide string, at timestamp_ntz").write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    batch = spark.createDataFrame(
        [(1, "new", TS + timedelta(1)), (1, "newer", TS + timedelta(2)), (2, "old", TS - timedelta(1)), (3, "none", None), (99, "in", None)],
        target.schema,
    )
    merged = upsert_latest(target, batch, ["id"], "at")
    got = {r["id"]: r["wide"] for r in merged.collect()}
    assert len(got) == merged.count() == 51
    assert (got[1], got[2], got[3], got[99]) == ("newer", "x", "x", "in")
    plan = upsert_latest(target, batch, ["id"], "at")._jdf.queryExecution().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(s for s in set(schemas)) == ["id:int", "id:int,wide:string,at:timestamp_ntz"]
    physical = plan[plan.index("== Physical Plan") :]
    assert physical.count("wide:string") == 1


def test_marks_are_stored_and_never_go_back(spark, tmp_path):
    marks = Marks(spark, str(tmp_path))
    feed = spark.createDataFrame([(1, TS), (2, None)], "id int, at timestamp_ntz")
    assert marks.before("f", 0) is None and since_mark(feed, None, "at").count() == 2
    marks.advance("f", feed, "at", 0)
    marks.advance("f", feed.limit(0), "at", 1)
    marks.advance("f", feed.withColumn("at", F.col("at") - F.expr("interval 1 day")), "at", 2)
    assert [marks.before("f", n) for n in (1, 2, 3)] == ["2025-01-01 00:00:00"] * 3
    later = feed.withColumn("at", F.col("at") - F.expr("interval 1 second"))
    assert rows(since_mark(later, marks.before("f", 3), "at"), "id") == [(2,)]


QUOTED = strings("id", "name", "note")


def test_line_breaks_in_quotes_and_a_missing_quote(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,"two\nlines",x\n2,"three ""\n\nlines"" , a",y\n3,plain,\n')
    (tmp_path / "b.csv").write_text('id,name,note\n4,plain,"q, uoted"\n5,short\n')
    (tmp_path / "c.csv").write_text('id,name,note\n6,"open,z\n7,fine,w\n8,fine,v\n')
    odd = {r["file"][-5:]: r["odd_lines"] for r in landing.broken_lines(spark, str(tmp_path)).collect()}
    assert odd == {"a.csv": 4, "c.csv": 1}
    landed = landing.land_csv(spark, str(tmp_path), QUOTED, TS, keep_damaged=True)
    landed = spark.createDataFrame(landed.collect(), landed.schema)  # as RAW keeps it
    got = {r["id"]: (r["name"], r["note"]) for r in landed.collect()}
    assert got["1"] == ("two\nlines", "x") and got["2"] == ('three "\n\nlines" , a', "y") and got["3"] == ("plain", None)
    assert got["4"] == ("plain", "q, uoted") and got["7"] == ("fine", "w") and got["8"] == ("fine", "v")
    damaged = rows(landing.quarantine(landed), landing.CORRUPT)
    assert ("5,short",) in damaged and ('6,"open,z',) in damaged and len(damaged) == 2
    counts = landing.load_counts({"t": landed}, {"t": landing.quarantine(landed)})
    assert sorted((r["_source_file"][-5:], r["row_count"], r["damaged_lines"]) for r in counts.collect()) == [
        ("a.csv", 3, 0), ("b.csv", 2, 1), ("c.csv", 3, 1)
    ]
    assert landing.land_csv(spark, [], QUOTED, TS).columns == landing.land_csv(spark, str(tmp_path), QUOTED, TS).columns


def test_the_ledger_lists_a_replaced_file_again(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("x\n1\n")
    found = ledger.new_files(spark, str(folder), None, 0)
    first = spark.createDataFrame(found.collect(), found.schema)
    assert first.count() == 1
    assert ledger.new_files(spark, str(folder), first, 1).count() == 0
    (folder / "b.csv").write_text("x\n2\n")
    (folder / "a.csv").write_text("x\n1\n3\n")
    assert sorted(r["path"][-5:] for r in ledger.new_files(spark, str(folder), first, 1).collect()) == ["a.csv", "b.csv"]


def test_sketches_follow_the_months_of_all_runs_since(spark, tmp_path):
    """Run 1 does not ask for the sketches; run 2 renews its months as well, and no others."""
    feeds = {"customers": spark.createDataFrame([("u", "n", "r", None)], strings("customer_id", "customer_name", "region", "signup_date")),
             "agents": spark.createDataFrame([("a", "n", "t")], strings("agent_id", "agent_name", "team"))}
    schema = strings("case_id", "created_at", "closed_at", "customer_id", "agent_id", "category", "priority", "status")

    def run(number, data):
        ts = TS + timedelta(days=number)
        cases = spark.createDataFrame([(i, at, None, "u", "a", "c", "p", "Open") for i, at in data], schema)
        extract = {name: landing.land(df, ts, F.lit("f")) for name, df in (feeds | {"cases": cases}).items()}
        return Warehouse(spark, extract, str(tmp_path), ts, ts.date(), run_id=number)

    def counts(w):
        return rows(w.sketches.select("created_month", "total_cases"))

    assert counts(run(0, [("1", "2024-01-05"), ("2", "2024-02-06"), ("3", "bad")])) == [(202401, 1), (202402, 1), (None, 1)]
    run(1, [("4", "2024-01-07"), ("3", "2024-03-01")]).fact  # noqa: B018
    assert counts(run(2, [("5", "2024-04-01")])) == [(202401, 2), (202402, 1), (202403, 1), (202404, 1)]
    assert MonthTable(spark, f"{tmp_path}/fact_sketches").touched(2) == {202401, 202403, 202404, None}
