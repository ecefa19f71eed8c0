from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from caseflow.operators import calendar as cal
from caseflow.operators import dims, staging
from caseflow.operators.fact import FACT_COLUMNS, created_between, fact_source, load_fact
from caseflow.plans import analytics, checks, reporting
from caseflow.plans.warehouse import Warehouse, landed
from caseflow.schemas import AGENT_ATTRIBUTES, CUSTOMER_ATTRIBUTES, RAW_AGENTS, RAW_CASES, RAW_CUSTOMERS
from tests.conftest import rows

TS = datetime(2025, 6, 1)
LATER = datetime(2025, 6, 2)
DAY0 = "2025-01-01T00:00:00"


def closed_after(hours):
    return str(datetime(2025, 1, 1 + hours // 24, hours % 24)).replace(" ", "T")


def make_fact(spark, cases, customers=(("CU1", "Ann", "eu", "2021-01-01"),), agents=(("AG1", "Bo", "T1"),)):
    sc = staging.stage_customers(spark.createDataFrame(list(customers), RAW_CUSTOMERS), TS)
    sa = staging.stage_agents(spark.createDataFrame(list(agents), RAW_AGENTS), TS)
    raw = spark.createDataFrame(list(cases), RAW_CASES)
    customer_orphans = staging.orphan_keys(raw, "customer_id", sc, "customer_id")
    agent_orphans = staging.orphan_keys(raw, "agent_id", sa, "agent_id")
    staged = staging.stage_cases(raw, customer_orphans, agent_orphans, TS)
    dc = dims.apply_changes(None, sc, "customer_id", CUSTOMER_ATTRIBUTES, "sk_customer", date(2025, 1, 1), TS)
    da = dims.apply_changes(None, sa, "agent_id", AGENT_ATTRIBUTES, "sk_agent", date(2025, 1, 1), TS)
    return load_fact(None, fact_source(staged, dc, da), TS)


def case(id, hours=10, priority="High", status="Closed", customer="CU1", agent="AG1", category="Billing"):
    closed = closed_after(hours) if hours is not None else None
    return (id, DAY0, closed, customer, agent, category, priority, status)


def test_fact_row(spark):
    row = make_fact(spark, [case("C1", 36)]).first()
    assert (row.region, row.team, row.customer_name, row.agent_name) == ("EU", "T1", "Ann", "Bo")
    assert (row.created_date_key, row.closed_date_key, row.is_resolved) == (20250101, 20250102, True)
    assert (row.sk_customer, row.sk_agent, row["_loaded_at"], row["_updated_at"]) == (1, 1, TS, TS)


def test_fact_keeps_orphans_and_null_status(spark):
    fact = make_fact(spark, [case("C1", customer="CU9"), case("C2", status=None, agent=None)])
    assert rows(fact, "case_id", "sk_customer", "sk_agent", "is_resolved") == [
        ("C1", None, 1, True), ("C2", 1, None, None),
    ]


def test_fact_merge_refreshes_all_but_the_load_time(spark):
    first = make_fact(spark, [case("C1"), case("C2")])
    second = make_fact(spark, [case("C2", priority="Low"), case("C3")])
    merged = load_fact(first, second.select(*FACT_COLUMNS), LATER)
    assert rows(merged, "case_id", "priority", "_loaded_at", "_updated_at") == [
        ("C1", "High", TS, TS), ("C2", "Low", TS, LATER), ("C3", "High", LATER, LATER),
    ]


def calendar(spark):
    return cal.calendar(cal.date_spine(spark))


def test_sla_boundaries(spark):
    cases = [
        case("equal", 24), case("over", 25), case("none", 10, "Odd"), case("open", None, status="Open"),
        case("orphan", 10, customer="CU9"),
    ]
    fact = make_fact(spark, cases)
    enriched = reporting.case_enriched(fact, calendar(spark), reporting.sla_policy(spark))
    assert rows(enriched, "case_id", "sla_met") == [
        ("equal", True), ("none", None), ("open", None), ("orphan", None), ("over", False),
    ]
    sla = reporting.priority_sla(fact, reporting.sla_policy(spark))
    assert rows(sla, "priority", "resolved_clean_cases", "met_sla", "breached_sla", "sla_attainment_pct") == [
        ("High", 2, 1, 1, 50.0), ("Odd", 1, 0, 0, 0.0),
    ]


def test_dates_outside_the_calendar_have_no_calendar_columns(spark):
    short = cal.calendar(cal.date_spine(spark, date(2025, 1, 2), date(2025, 1, 3)))
    row = reporting.case_enriched(make_fact(spark, [case("C1", 36)]), short, reporting.sla_policy(spark)).first()
    assert (row.created_date, row.created_month, row.closed_date) == (None, None, date(2025, 1, 2))


def test_default_calendar(spark):
    dim = calendar(spark)
    assert tuple(cal.calendar_bounds(dim).first()) == (20200101, 20301231, 4018)
    leap, edge = (dim.filter(F.col("date_key") == k).first() for k in (20240229, 20241230))
    assert (leap.day_of_week, leap.day_of_week_num, leap.month_name, leap.quarter_label) == ("Thu", 4, "Feb", "Q1 2024")
    assert (edge.week_of_year, edge.is_weekend, edge.is_weekday) == (1, False, True)
    sunday = dim.filter("date_key = 20250105").first()
    assert (sunday.day_of_week, sunday.day_of_week_num, sunday.is_weekend) == ("Sun", 0, True)


def test_ranks_keep_ties_and_put_untimed_agents_last(spark):
    hours = {"a": 10, "b": 20, "c": 30, "d": 30, "e": 40, "f": None}
    agents = [(k, k, "T1") for k in hours] + [("g", "g", "T2"), ("h", "h", "T2")]
    cases = [case(f"C{k}", h, agent=k, status="Closed" if h else "Open") for k, h in hours.items()]
    cases += [case("Cg", None, agent="g", status="Open"), case("Ch", 5, agent="h")]
    top = analytics.top3_agents_per_team(make_fact(spark, cases, agents=agents))
    assert rows(top, "team", "agent_name", "rank_in_team") == [
        ("T1", "a", 1), ("T1", "b", 2), ("T1", "c", 3), ("T1", "d", 3), ("T2", "g", 2), ("T2", "h", 1),
    ]


def test_populations(spark):
    fact = make_fact(spark, [case("C1", 10), case("C2", 30, customer="CU9"), case("C3", None), case("C4", None, status="Open")])
    # clean and resolved only
    assert tuple(analytics.overall_resolution(fact).first()) == (10.0, 0.42, 1)
    # all cases; durations of resolved ones include the orphan
    team = analytics.team_rollup(fact).first()
    assert (team.total_cases, team.resolved_cases, team.closure_rate_pct, team.avg_resolution_hours) == (4, 3, 75.0, 20.0)
    shares = analytics.status_share(fact)
    assert rows(shares, "status", "pct_of_total") == [("Closed", 75.0), ("Open", 25.0)]


def test_shares_of_nothing(spark):
    fact = make_fact(spark, [case("C1")]).filter("false")
    assert analytics.status_share(fact).count() == 0
    assert tuple(analytics.overall_resolution(fact).first()) == (None, None, 0)


@pytest.mark.parametrize(
    "change, healthy",
    [
        ({}, True),
        ({"resolution_hours": "cast(-1 as decimal(10,2))"}, False),
        ({"sk_customer": "cast(null as bigint)"}, False),
        ({"sk_agent": "cast(null as bigint)"}, False),
    ],
)
def test_monitor(spark, change, healthy):
    fact = make_fact(spark, [case("C1")]).withColumns({c: F.expr(e) for c, e in change.items()})
    monitor = reporting.dq_monitor(fact, TS)
    assert monitor.first().pipeline_healthy is healthy
    assert reporting.open_health_alert(monitor).count() == (0 if healthy else 1)


def test_monitor_of_an_empty_fact(spark):
    row = reporting.dq_monitor(make_fact(spark, [case("C1")]).filter("false"), TS).first()
    assert (row.fact_rows, row.dq_flag_pct, row.pipeline_healthy, row.checked_at) == (0, None, False, TS)


def test_drift_spots_a_spike(spark):
    months = [(1, 10, 1), (2, 10, 1), (3, 10, 4)]
    data = [(20250001 + m * 100, i < bad) for m, n, bad in months for i in range(n)]
    fact = spark.createDataFrame(data, "created_date_key int, has_any_dq_flag boolean").withColumn(
        "is_resolved", F.lit(True)
    )
    drift = checks.dq_drift_monthly(fact)
    assert rows(drift, "month", "dq_flag_pct", "change_points", "spike") == [
        (date(2025, 1, 1), 10.0, None, False), (date(2025, 2, 1), 10.0, 0.0, False), (date(2025, 3, 1), 40.0, 30.0, True),
    ]


def test_reconciliation_reports_a_difference(spark):
    raw_customers = spark.createDataFrame([("CU1", "Ann", "eu", "2021-01-01")], RAW_CUSTOMERS)
    raw_agents = spark.createDataFrame([("AG1", "Bo", "T1")], RAW_AGENTS)
    cases = [case("C1", 10), case("C2", 20)]
    raw = spark.createDataFrame(cases, RAW_CASES)
    good = checks.metric_reconciliation(make_fact(spark, cases), raw, raw_customers, raw_agents)
    assert good.filter("not ok").count() == 0
    short = make_fact(spark, cases[:1])
    bad = checks.metric_reconciliation(short, raw, raw_customers, raw_agents).filter("not ok")
    assert ("cases", "all", 2.0, 1.0) in rows(bad, "metric", "slice", "expected", "actual")


def test_date_range_reads_only_its_months(spark, tmp_path):
    fact = make_fact(spark, [case("C1")]).withColumn("created_month", F.lit(202501))
    fact = fact.unionByName(fact.withColumns({"created_month": F.lit(202502), "created_date_key": F.lit(20250201)}))
    fact.write.partitionBy("created_month").parquet(f"{tmp_path}/fact")
    picked = created_between(spark.read.parquet(f"{tmp_path}/fact"), 20250115, 20250228)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "created_month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows(picked, "created_date_key") == [(20250201,)]


def test_views_are_published(spark):
    fact = make_fact(spark, [case("C1")])
    reporting.publish({"region_summary": reporting.region_summary(fact)})
    assert spark.sql("select region, total_cases from region_summary").collect() == [("EU", 1)]


def make_warehouse(spark, root, cases, customers=(("CU1", "Ann", "eu", "2021-01-01"),), run_ts=TS, **options):
    feeds = {
        "cases": spark.createDataFrame(list(cases), RAW_CASES),
        "customers": spark.createDataFrame(list(customers), RAW_CUSTOMERS),
        "agents": spark.createDataFrame([("AG1", "Bo", "T1")], RAW_AGENTS),
    }
    return Warehouse(
        spark, landed(feeds, run_ts), str(root), run_ts, run_ts.date(),
        (date(2025, 1, 1), date(2025, 12, 31)), **options,
    )


def test_a_repeated_key_is_an_error_on_the_first_load(spark, tmp_path):
    twice = [("CU1", "Ann", "eu", "2021-01-01"), ("CU1", "Eve", "eu", "2021-01-01"), (None, "x", "eu", None)]
    with pytest.raises(ValueError, match="duplicate key in customers: .*CU1"):
        make_warehouse(spark, tmp_path / "a", [case("C1")], twice).fact.count()
    with pytest.raises(ValueError, match="duplicate key in cases: .*C1"):
        make_warehouse(spark, tmp_path / "b", [case("C1"), case("C1", 20)]).fact.count()


def test_own_policy_and_sql_names_follow_the_run(spark, tmp_path):
    policy = spark.createDataFrame([("High", 5, "x")], "priority string, target_resolution_hrs int, note string")
    make_warehouse(spark, tmp_path, [case("C1", 10)], policy=policy).publish()
    met = "select case_id, target_resolution_hrs, sla_met from case_enriched order by 1"
    assert rows(spark.sql(met)) == [("C1", 5, False)]
    longer = policy.withColumn("target_resolution_hrs", F.lit(12))
    make_warehouse(
        spark, tmp_path, [case("C2", 15)], run_ts=LATER, run_id=1, policy=longer
    ).publish()
    assert rows(spark.sql(met)) == [("C1", 12, True), ("C2", 12, False)]
    joined = "select c.region, count(*) from fact_cases f join dim_customer c using (sk_customer) group by 1"
    assert rows(spark.sql(joined)) == [("EU", 2)]
    assert rows(spark.sql("select * from sla_policy")) == [("High", 12)]
    repeated = policy.union(policy)
    with pytest.raises(ValueError, match="duplicate key in the SLA policy"):
        make_warehouse(spark, tmp_path, [], policy=repeated, run_id=2).sla
