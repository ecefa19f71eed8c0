"""Every query by name, as a function of the session and the folder of the source tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions.text import clean_strings
from caseflow.functions.time import date_key, ntz
from caseflow.operators import calendar as cal
from caseflow.operators import contracts, dims, sketches, staging
from caseflow.operators.fact import FACT_COLUMNS, created_between, fact_source_as_of, load_fact
from caseflow.operators.incremental import since_mark, since_watermark, upsert_latest
from caseflow.operators.upsert import changes, upsert, upsert_with_audit
from caseflow.plans import analytics, checks, reporting
from caseflow.plans.warehouse import RUN_TS, SPAN, Warehouse, landed, source_feeds, stored_feeds, warehouse
from caseflow.schemas import (
    ACCEPTED_CATEGORIES,
    ACCEPTED_PRIORITIES,
    ACCEPTED_STATUSES,
    ACCEPTED_TEAMS,
    AGENT_WIDTHS,
    CASE_WIDTHS,
    CUSTOMER_ATTRIBUTES,
    CUSTOMER_WIDTHS,
    DQ_FLAGS,
    NULL_TOKENS,
    RAW_AGENTS,
    RAW_CASES,
    RAW_CUSTOMERS,
)
from caseflow.sources import casemodel, landing
from caseflow.sources.casemodel import table
from caseflow.sources.marks import Marks
from caseflow.sources.snapshots import ChangeTable
from caseflow.streaming.ingest import ingest_new_files
from caseflow.streaming.upsert import upsert_new_files
from caseflow.workspace import scratch

Query = Callable[[SparkSession, str], DataFrame]

FIRST_EXTRACT = date(1996, 1, 1)
SECOND_EXTRACT = date(1998, 7, 1)
ACCEPTED_SOURCE_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _text(*columns: str) -> list:
    return [F.col(c).cast("string").alias(c) for c in columns]


def _double(*columns: str) -> list:
    return [F.col(c).cast("double").alias(c) for c in columns]


def _on_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(warehouse(spark, sf_dir).fact)


def _on_warehouse(report: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(warehouse(spark, sf_dir))


# --- RAW --------------------------------------------------------------------


def _landing_feed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A source feed as a folder of CSV files; absent close times are written as any token."""
    feed = source_feeds(spark, sf_dir)[name]
    if name == "cases":
        token = F.element_at(
            F.array(*[F.lit(t) for t in NULL_TOKENS]),
            (F.length("case_id") % len(NULL_TOKENS) + 1).cast("int"),
        )
        absent = F.coalesce(F.col("closed_at"), F.lit("")) == ""
        feed = feed.withColumn("closed_at", F.when(absent, token).otherwise(F.col("closed_at")))
    path = f"{scratch(spark, 'landing')}/{name}.csv"
    (
        feed.write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", name == "customers")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landing_feed(spark, sf_dir, "customers")
    customers = landing.land_csv(spark, feed, RAW_CUSTOMERS, RUN_TS)
    return customers.select(
        *RAW_CUSTOMERS.names,
        *_text("_loaded_at"),
        landing.feed_name(F.col("_source_file")).alias("_source_file"),
    )


def raw_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = _landing_feed(spark, sf_dir, "cases")
    cases = landing.land_csv(spark, feed, RAW_CASES, RUN_TS)
    return cases.select("case_id", "closed_at", "agent_id", "status")


def raw_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of category Other lack the status, those of Billing have a field too many."""
    path = scratch(spark, "ragged")
    text = [F.coalesce(F.col(c), F.lit("")) for c in RAW_CASES.names]
    line = (
        F.when(F.col("category") == "Other", F.concat_ws(",", *text[:-1]))
        .when(F.col("category") == "Billing", F.concat_ws(",", *text, F.lit("extra")))
        .otherwise(F.concat_ws(",", *text))
    )
    casemodel.source_cases(spark, sf_dir).select(line.alias("value")).write.text(path)
    rows = landing.read_text_rows(spark, path, RAW_CASES, header=False)
    kept = clean_strings(rows.select(*RAW_CASES.names, F.col(landing.CORRUPT).isNotNull().alias("damaged")))
    return kept.select("case_id", "customer_id", "category", "priority", "status", "damaged")


def raw_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = {"cases": RAW_CASES, "customers": RAW_CUSTOMERS, "agents": RAW_AGENTS}
    tables = {
        name: landing.land_csv(spark, _landing_feed(spark, sf_dir, name), schema, RUN_TS).withColumn(
            "_source_file", landing.feed_name(F.col("_source_file"))
        )
        for name, schema in feeds.items()
    }
    return landing.load_audit(tables).orderBy("tbl")


def incremental_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arrive twice, the load runs three times, and each row is there once."""
    cases = casemodel.source_cases(spark, sf_dir)
    root = scratch(spark, "ingest")
    early = F.col("category").isin("Technical", "Account")
    loaded = None
    for arrival in (early, ~early, None):
        if arrival is not None:
            cases.filter(arrival).write.mode("append").option("header", True).csv(f"{root}/in")
        loaded = ingest_new_files(
            spark, f"{root}/in", RAW_CASES, f"{root}/raw_cases", f"{root}/checkpoint", RUN_TS
        )
    per_case = loaded.groupBy("category", "status", "case_id").agg(F.count("*").alias("n"))
    return per_case.groupBy("category", "status").agg(
        F.sum("n").alias("row_count"), F.count("case_id").alias("case_count")
    )


def raw_quoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the customer names hold a line break, a quote and a comma."""
    feed = source_feeds(spark, sf_dir)["customers"]
    number = F.substring("customer_id", 3, 20).cast("long")
    long_name = F.concat("customer_name", F.lit('\nDept "x", 2'))
    path = f"{scratch(spark, 'quoted')}/customers.csv"
    for broken, several in ((number % 3 == 0, 4), (number % 3 != 0, 2)):
        named = feed.filter(broken).withColumn("customer_name", F.when(number % 3 == 0, long_name).otherwise(F.col("customer_name")))
        named.repartition(several).write.mode("append").option("header", True).option("escape", '"').csv(path)
    return landing.land_csv(spark, path, RAW_CUSTOMERS, RUN_TS).select(*RAW_CUSTOMERS.names)


def _ragged_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Case files of three kinds: lines of category Other lack the status, those of Billing have a field too many."""
    root = scratch(spark, "ragged_feeds")
    cases = source_feeds(spark, sf_dir)["cases"]
    kinds = {
        "short": cases.filter(F.col("category") == "Other").drop("status"),
        "long": cases.filter(F.col("category") == "Billing").withColumn("extra", F.lit("extra")),
        "whole": cases.filter(~F.col("category").isin("Other", "Billing")),
    }
    for name, rows in kinds.items():
        writer = rows.write.option("header", True).option("emptyValue", "")
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/{name}")
    paths = {"cases": f"{root}/*"} | {n: _landing_feed(spark, sf_dir, n) for n in ("customers", "agents")}
    return Warehouse.from_csv(spark, paths, scratch(spark, "ragged_runs"), RUN_TS, span=SPAN)


def load_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged lines of a load, as they stand in the files."""
    lines = _ragged_warehouse(spark, sf_dir).quarantine("cases")
    return lines.select(landing.feed_name(F.col("_source_file")).alias("_source_file"), "line")


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and damaged lines of a load, by the folder of their file."""
    counts = _ragged_warehouse(spark, sf_dir).load_counts()
    by_folder = counts.groupBy("tbl", landing.feed_name(F.col("_source_file")).alias("_source_file"))
    return by_folder.agg(F.sum("row_count").alias("row_count"), F.sum("damaged_lines").alias("damaged_lines"))


def pipeline_file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs over folders that grow twice: the third finds nothing new, the last repeats the second."""
    feeds, root = source_feeds(spark, sf_dir), scratch(spark, "ledger")
    folders = {name: f"{root}/in/{name}" for name in feeds}
    early = F.col("category").isin("Technical", "Account")
    w = None
    for run, arrival in ((0, early), (1, ~early), (2, None), (1, None)):
        if arrival is not None:
            came = feeds | {"cases": feeds["cases"].filter(arrival)} if run == 0 else {"cases": feeds["cases"].filter(arrival)}
            for name, rows in came.items():
                writer = rows.write.mode("append").option("header", True).option("ignoreLeadingWhiteSpace", False)
                writer.option("ignoreTrailingWhiteSpace", False).csv(folders[name])
        run_ts = RUN_TS + timedelta(days=run)
        w = Warehouse.from_folders(spark, folders, f"{root}/tables", run_ts, run_id=run, span=SPAN)
        for name in feeds:
            w.landed(name)
    w = Warehouse.from_folders(spark, folders, f"{root}/tables", run_ts, run_id=3, span=SPAN)
    landed_rows = w.raw("cases").groupBy("category", F.col("_run_id").alias("run"))
    return landed_rows.agg(F.count("*").alias("row_count"), F.count_distinct("case_id").alias("case_count"))


# --- staging ----------------------------------------------------------------


def stage_cases(w: Warehouse) -> DataFrame:
    return w.stg_cases.select(
        "case_id", *_text("created_at", "closed_at"), "customer_id", "agent_id", "category",
        "priority", "status", *_double("resolution_hours"), "resolution_bucket", *DQ_FLAGS,
        "has_any_dq_flag",
    )


def stage_customers(w: Warehouse) -> DataFrame:
    return w.stg_customers.select("customer_id", *CUSTOMER_ATTRIBUTES)


def parse_timestamps(w: Warehouse) -> DataFrame:
    return staging.parse_cases(w.source("cases")).select(
        "case_id", *_text("created_at", "closed_at"), F.col("_created_text").alias("created_text")
    )


DECLARED_FORMATS = ("MM/dd/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy/MM/dd HH:mm", "dd-MMM-yyyy HH:mm:ss")


def _other_formats(cases: DataFrame, column: str) -> Column:
    """The ISO text of most cases as another format; what is no time stays."""
    text = F.col(column)
    year, month, day = (F.substring(text, a, n) for a, n in ((1, 4), (6, 2), (9, 2)))
    clock, kind = F.substring(text, 12, 8), F.substring("case_id", 2, 20).cast("long") % 10
    names = F.array(*[F.lit(n) for n in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()])
    other = (
        F.when(kind < 7, F.concat(day, F.lit("/"), month, F.lit("/"), year, F.lit(" "), clock))
        .when(kind == 7, F.concat(year, F.lit("/"), month, F.lit("/"), day, F.lit(" "), F.substring(clock, 1, 5)))
        .when(kind == 8, F.concat(day, F.lit("-"), F.get(names, month.try_cast("int") - 1), F.lit("-"), year, F.lit(" "), clock))
    )
    return F.when(text.rlike(r"^\d{4}-") & other.isNotNull(), other).otherwise(text)


def parse_timestamp_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged times of an extract in four formats, of which the declared first also reads some days as months."""
    feeds = source_feeds(spark, sf_dir)
    cases = feeds["cases"]
    feeds["cases"] = cases.withColumns({c: _other_formats(cases, c) for c in ("created_at", "closed_at")})
    root = scratch(spark, "formats")
    w = Warehouse(spark, landed(feeds, RUN_TS), root, RUN_TS, RUN_TS.date(), SPAN, formats=DECLARED_FORMATS)
    return w.stg_cases.select("case_id", *_text("created_at", "closed_at"), *_double("resolution_hours"))


RANGE = (199701, 199912)


def agents_by_range_sketch(w: Warehouse) -> DataFrame:
    """Cases of a range by region, and whether the agents of its merged sketches are within the stated error."""
    found = sketches.range_estimates(w.sketches, *RANGE, ["region"])
    exact = created_between(w.fact, RANGE[0] * 100 + 1, RANGE[1] * 100 + 31).groupBy(F.col("region").alias("r"))
    agents = exact.agg(F.count_distinct("agent_name").alias("agents"))
    near = F.abs(F.col("agent_count") - F.col("agents")) <= F.greatest(F.col("agents") * sketches.AGENT_ERROR, F.lit(0))
    both = found.join(agents, F.col("region").eqNullSafe(F.col("r")))
    return both.select("region", "total_cases", near.alias("agents_within_error"))


def median_by_range_sketch(w: Warehouse) -> DataFrame:
    """Timed cases of a range by team, and whether the rank of the merged median is within the stated error."""
    found = sketches.range_estimates(w.sketches, *RANGE, ["team"])
    cases = created_between(w.fact, RANGE[0] * 100 + 1, RANGE[1] * 100 + 31)
    hours = cases.select(F.col("team").alias("t"), (sketches.hundredths() / 100).alias("h")).filter("h is not null")
    placed = hours.join(found, F.col("team").eqNullSafe(F.col("t")))
    below, upto = (F.count_if(c) / F.count("*") for c in (F.col("h") < F.col("median_hours"), F.col("h") <= F.col("median_hours")))
    slack = sketches.RANK_ERROR + 1 / F.count("*")
    near = (below <= 0.5 + slack) & (upto >= 0.5 - slack)
    return placed.groupBy("team", "timed_cases").agg(near.alias("median_within_error"))


def date_keys(w: Warehouse) -> DataFrame:
    return w.stg_cases.select(
        "case_id",
        date_key(F.col("created_at")).alias("created_date_key"),
        date_key(F.col("closed_at")).alias("closed_date_key"),
    )


# --- dimensions -------------------------------------------------------------


def first_extract(w: Warehouse) -> DataFrame:
    """Customers as first delivered: those of Asia come later."""
    known = w.stg_customers.select("customer_id", *CUSTOMER_ATTRIBUTES)
    return known.filter(~F.col("region").eqNullSafe("ASIA"))


def second_extract(w: Warehouse) -> DataFrame:
    """As delivered next: Africa is gone, Asia is new, Europe is renamed, and the Middle East
    has lost its sign-up dates."""
    return (
        w.stg_customers.select("customer_id", *CUSTOMER_ATTRIBUTES)
        .filter(~F.col("region").eqNullSafe("AFRICA"))
        .withColumns(
            {
                "signup_date": F.when(~F.col("region").eqNullSafe("MIDDLE EAST"), F.col("signup_date")),
                "region": F.when(F.col("region") == "EUROPE", "EMEA").otherwise(F.col("region")),
            }
        )
    )


def _history(w: Warehouse, name: str, dim: DataFrame | None, source: DataFrame, as_of: date) -> DataFrame:
    return w.table(
        name,
        lambda _: dims.apply_changes(
            dim, source, "customer_id", CUSTOMER_ATTRIBUTES, "sk_customer", as_of, RUN_TS
        ),
        {"is_current": T.BooleanType()},
    )


def dim_first(w: Warehouse) -> DataFrame:
    return _history(w, "customer_history_1", None, first_extract(w), FIRST_EXTRACT)


def dim_second(w: Warehouse) -> DataFrame:
    return _history(w, "customer_history_2", dim_first(w), second_extract(w), SECOND_EXTRACT)


def _versions(dim: DataFrame) -> DataFrame:
    return dim.select(
        "customer_id", *CUSTOMER_ATTRIBUTES, "valid_from", "valid_to", "is_current"
    )


def scd2_changed(w: Warehouse) -> DataFrame:
    changed = dims.changed_versions(dim_first(w), second_extract(w), "customer_id", CUSTOMER_ATTRIBUTES)
    return changed.select("customer_id", *CUSTOMER_ATTRIBUTES)


def scd2_new_versions(w: Warehouse) -> DataFrame:
    return dims.new_versions(dim_first(w), second_extract(w), "customer_id", CUSTOMER_ATTRIBUTES)


def scd2_expire(w: Warehouse) -> DataFrame:
    return _versions(
        dims.expire(
            dim_first(w), second_extract(w), "customer_id", CUSTOMER_ATTRIBUTES, SECOND_EXTRACT
        )
    )


def scd2_insert(w: Warehouse) -> DataFrame:
    return _versions(dim_second(w).filter(F.col("valid_from") == F.lit(SECOND_EXTRACT)))


def scd2_apply(w: Warehouse) -> DataFrame:
    return _versions(dim_second(w))


def scd2_no_delete(w: Warehouse) -> DataFrame:
    """Current versions whose key the last extract no longer has."""
    gone = dims.current(dim_second(w)).join(second_extract(w), "customer_id", "left_anti")
    return gone.groupBy("region", "valid_to").agg(F.count("*").alias("customers"))


def surrogate_keys(w: Warehouse) -> DataFrame:
    """Keys are dense, unique and the same after a reload."""
    before = dim_first(w).select("sk_customer", F.col("customer_id").alias("known_id"))
    after = dim_second(w).select("sk_customer", "customer_id")
    return (
        after.join(before, "sk_customer", "left")
        .groupBy("sk_customer")
        .agg(F.count("*").alias("n"), F.count_if(F.col("customer_id") == F.col("known_id")).alias("kept"))
        .agg(
            F.sum("n").alias("versions"),
            F.count("sk_customer").alias("distinct_keys"),
            F.min("sk_customer").alias("min_key"),
            F.max("sk_customer").alias("max_key"),
            F.sum("kept").alias("kept_keys"),
        )
    )


def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from the first to the last order."""
    day = F.col("o_orderdate").cast("date")
    bounds = table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return cal.days(bounds, F.col("first"), F.col("last"))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar(date_spine(spark, sf_dir))


def date_dim_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_bounds(dim_date(spark, sf_dir))


# --- upsert -----------------------------------------------------------------


def case_extracts(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Two overlapping extracts: cases known before 2000 while all were open, then every case
    with a close time in its staged state."""
    columns = ["case_id", "status", "priority", "resolution_hours"]
    early = F.coalesce(date_key(F.col("created_at")) < 20000101, F.lit(True))
    first = w.stg_cases.filter(early).select(*columns).withColumns(
        {"status": F.lit("Open"), "resolution_hours": F.lit(None).cast("decimal(10,2)")}
    )
    return first, w.stg_cases.filter(F.col("closed_at").isNotNull()).select(*columns)


def merge_upsert(w: Warehouse) -> DataFrame:
    first, second = case_extracts(w)
    merged = upsert(first, second, ["case_id"])
    return merged.select("case_id", "status", "priority", *_double("resolution_hours"))


def merge_audit_columns(w: Warehouse) -> DataFrame:
    """Load the first extract on one day and the second on the next."""
    first, second = case_extracts(w)
    day_one = ntz(RUN_TS)
    loaded = first.withColumns({"_loaded_at": day_one, "_updated_at": day_one})
    merged = upsert_with_audit(loaded, second, ["case_id"], RUN_TS + timedelta(days=1))
    return merged.select(
        "case_id", "status", *_double("resolution_hours"), *_text("_loaded_at", "_updated_at")
    )


def merge_schema_change(w: Warehouse) -> DataFrame:
    """A batch with a column more and one less than the target, through each of the three merges."""
    first, second = case_extracts(w)
    day_one, day_two = ntz(RUN_TS), ntz(RUN_TS + timedelta(days=1))
    target = first.select("case_id", "status", "priority")
    batch = second.select("case_id", "status", F.lit("web").alias("channel"))
    audited = target.withColumns({"_loaded_at": day_one, "_updated_at": day_one})
    merged = {
        "upsert": upsert(target, batch, ["case_id"]),
        "audit": upsert_with_audit(audited, batch, ["case_id"], RUN_TS + timedelta(days=1)),
        "latest": upsert_latest(
            target.withColumn("at", day_one), batch.withColumn("at", day_two), ["case_id"], "at"
        ),
    }
    shown = [
        df.select(F.lit(name).alias("merge"), "case_id", "status", "priority", "channel")
        for name, df in merged.items()
    ]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


def merge_idempotent(w: Warehouse) -> DataFrame:
    first, second = case_extracts(w)
    once = upsert(first, second, ["case_id"])
    return changes(once, upsert(once, second, ["case_id"]), ["case_id"])


def fact_reload_idempotent(w: Warehouse) -> DataFrame:
    """The fact merged again with the same rows: nothing but the update time may move."""
    again = load_fact(w.fact, w.fact.select(*FACT_COLUMNS), RUN_TS + timedelta(days=1))
    kept = [*FACT_COLUMNS, "_loaded_at"]
    return changes(w.fact.select(*kept), again.select(*kept), ["case_id"])


def pipeline_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from the three feeds as CSV files, up to a report."""
    paths = {name: _landing_feed(spark, sf_dir, name) for name in ("cases", "customers", "agents")}
    w = Warehouse.from_csv(spark, paths, scratch(spark, "from_csv"), RUN_TS, span=SPAN)
    return reporting.region_summary(w.fact)


def pipeline_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over one root: early cases first, then an extract of all of them.

    The second run merges every layer; cases of the first keep their load time.
    """
    root = scratch(spark, "runs")
    feeds = source_feeds(spark, sf_dir)
    early = {**feeds, "cases": feeds["cases"].filter(F.col("created_at") < "1998")}
    second_ts = RUN_TS + timedelta(days=1)
    Warehouse(spark, landed(early, RUN_TS), root, RUN_TS, RUN_TS.date(), SPAN).fact  # noqa: B018
    second = Warehouse(spark, landed(feeds, second_ts), root, second_ts, second_ts.date(), SPAN, run_id=1)
    return second.fact.groupBy("region", "status", *_text("_loaded_at", "_updated_at")).agg(
        F.count("*").alias("cases"),
        F.count_if("has_any_dq_flag").alias("flagged"),
        F.sum("resolution_hours").cast("double").alias("hours"),
    )


def _later_parents(spark: SparkSession, sf_dir: str, again: Column) -> Warehouse:
    """The second of two runs: the first lacks a third of the customers, the second delivers only
    these, the cases that are new and those that ``again`` selects, and no agent."""
    root = scratch(spark, "parents")
    feeds = stored_feeds(spark, sf_dir)
    known = F.coalesce(F.col("created_at") < "1998", F.lit(False))
    withheld = F.pmod(F.xxhash64("customer_id"), F.lit(3)) == 0
    cases, customers = feeds["cases"], feeds["customers"]
    first = {**feeds, "cases": cases.filter(known), "customers": customers.filter(~withheld)}
    second = {
        "cases": cases.filter(~known | again),
        "customers": customers.filter(withheld),
        "agents": feeds["agents"].filter(F.lit(False)),
    }
    later = RUN_TS + timedelta(days=1)
    Warehouse(spark, landed(first, RUN_TS), root, RUN_TS, RUN_TS.date(), SPAN).fact  # noqa: B018
    return Warehouse(spark, landed(second, later), root, later, later.date(), SPAN, run_id=1)


def pipeline_late_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that arrive a run after their cases: flags and figures as of one load of all."""
    w = _later_parents(spark, sf_dir, F.lit(False))
    return w.fact.groupBy("region", "status").agg(
        F.count("*").alias("cases"),
        F.count_if("has_any_dq_flag").alias("flagged"),
        F.count_if("dq_flag_orphan_customer").alias("orphans"),
        F.count_if(F.col("sk_customer").isNotNull()).alias("matched"),
        F.sum(F.when(~F.col("has_any_dq_flag"), F.col("resolution_hours"))).cast("double").alias("hours"),
    )


def pipeline_delta_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the layers after a second run that delivers changes only, some cases again."""
    w = _later_parents(spark, sf_dir, F.col("category") == "Technical")
    violations = contract_relationships(w).select("object", F.col("violations").alias("n"), "ok")
    layers = check_rows_preserved(w).select(F.col("layer").alias("object"), F.col("row_count").alias("n"), "ok")
    figures = metric_reconciliation(w).agg(F.count("*").alias("n"), F.bool_and("ok").alias("ok"))
    landed_rows = w.raw("cases").agg(F.count("*").alias("n"))
    return contracts.union_all(
        [
            violations,
            layers,
            figures.select(F.lit("figures").alias("object"), "n", "ok"),
            landed_rows.select(F.lit("landed").alias("object"), "n", F.lit(True).alias("ok")),
        ]
    )


def touched_runs(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The second of two runs: the first has the cases of 1998 as open, the second delivers these again and
    gives three customers a new name."""
    feeds, root = stored_feeds(spark, sf_dir), scratch(spark, "touched")
    of_1998 = F.coalesce(F.substring("created_at", 1, 4) == "1998", F.lit(False))
    first = feeds["cases"].withColumn("status", F.when(of_1998, "Open").otherwise(F.col("status")))
    renamed = F.col("customer_id").isin("CU1", "CU2", "CU3")
    named = feeds["customers"].withColumn("customer_name", F.when(renamed, F.lit("Renamed")).otherwise(F.col("customer_name")))
    later = RUN_TS + timedelta(days=1)
    Warehouse(spark, landed(feeds | {"cases": first}, RUN_TS), root, RUN_TS, RUN_TS.date(), SPAN).fact  # noqa: B018
    second = {"cases": feeds["cases"].filter(of_1998), "customers": named.filter(renamed), "agents": feeds["agents"].limit(0)}
    return Warehouse(spark, landed(second, later), root, later, later.date(), SPAN, run_id=1)


def pipeline_touched_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that writes the months it touches, against a load of everything at once."""
    w = touched_runs(spark, sf_dir)
    return w.fact.groupBy("created_month", "status", (F.col("customer_name") == "Renamed").alias("renamed")).agg(
        F.count("*").alias("cases"),
        F.count_if("has_any_dq_flag").alias("flagged"),
        F.sum("resolution_hours").cast("double").alias("hours"),
    )


def dq_rules_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven flags in the fact and the monitor: of the two further ones, one counts and one does not."""
    closed, order = staging.further_rules()
    rules = (closed, order._replace(counts=False))
    extract = landed(source_feeds(spark, sf_dir), RUN_TS)
    w = Warehouse(spark, extract, scratch(spark, "rules"), RUN_TS, RUN_TS.date(), SPAN, rules=rules)
    counted = w.fact.groupBy(*[r.name for r in rules], "has_any_dq_flag").agg(F.count("*").alias("cases"))
    monitored = F.struct("dq_flagged", *[F.col(r.name).alias(f"all_{r.name}") for r in rules])
    return counted.withColumn("_all", w.monitor.select(monitored).scalar()).select("*", "_all.*").drop("_all")


def sla_custom_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attainment under targets of the user's own: two priorities differ, one has no target, one is not in use."""
    targets = [("Urgent", 400.0), ("High", 900.5), ("Low", 120.0), ("Planned", 2000.0)]
    policy = spark.createDataFrame(targets, "priority string, target_resolution_hrs double")
    extract = landed(source_feeds(spark, sf_dir), RUN_TS)
    w = Warehouse(spark, extract, scratch(spark, "policy"), RUN_TS, RUN_TS.date(), SPAN, policy=policy)
    used = reporting.policy_coverage(w.fact, w.sla).select("priority", "total_cases")
    return used.join(priority_sla(w), "priority", "left")


def pipeline_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that hold a key twice: the latest row by an order column is merged, whatever the order they came in."""
    w = warehouse(spark, sf_dir)
    stored = w.stg_cases.select("case_id", "category", "status", F.col("created_at").alias("changed_at"))
    later = stored.filter(F.col("category").isin("Billing", "Other") & F.col("changed_at").isNotNull())
    again = [
        later.withColumns({"status": F.lit(f"Delivery {n}"), "changed_at": F.col("changed_at") + F.expr(f"interval {n} day")})
        for n in (2, 3, 1)
    ]
    merged = upsert_latest(stored, reduce(DataFrame.unionByName, again), ["case_id"], "changed_at")
    return merged.groupBy("category", "status").agg(F.count("*").alias("cases"), F.countDistinct("case_id").alias("keys"))


def dq_drift_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads by category; all customers of the last one are unknown."""
    feeds, root = stored_feeds(spark, sf_dir), scratch(spark, "loads")
    cases = feeds["cases"]
    lost = F.concat(F.lit("lost-"), "customer_id")
    for run, category in enumerate(("Technical", "Account", "Billing")):
        came = cases.filter(F.col("category") == category)
        came = came.withColumn("customer_id", lost) if run == 2 else came
        run_ts = RUN_TS + timedelta(days=run)
        given = landed(feeds | {"cases": came}, run_ts)
        w = Warehouse(spark, given, root, run_ts, run_ts.date(), SPAN, run_id=run)
        w.monitor_history  # noqa: B018
    return checks.dq_drift_by_load(w.monitor_history)


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published views by SQL: after a first run, and again after a second that adds the later cases."""
    root = scratch(spark, "published")
    early = F.coalesce(F.col("created_at") < "1998", F.lit(False))
    found = []
    for run in range(2):
        run_ts = RUN_TS + timedelta(days=run)
        session = spark.newSession()
        given = landed(source_feeds(session, sf_dir), run_ts)
        if run == 0:
            given["cases"] = given["cases"].filter(early)
        Warehouse(session, given, root, run_ts, run_ts.date(), SPAN, run_id=run).publish()
        rows = session.sql(
            f"""SELECT {run} AS run, e.region, count(*) AS cases, sum(int(e.has_any_dq_flag)) AS flagged,
              max(m.fact_rows) AS fact_rows, max(s.total_cases) AS summary_cases
            FROM case_enriched e JOIN data_quality_monitor m ON true LEFT JOIN region_summary s ON s.region <=> e.region
            GROUP BY e.region"""
        )
        path = f"{root}/shown-{run}"
        rows.write.parquet(path)
        found.append(spark.read.parquet(path))
    return contracts.union_all(found)


def _versioned_cases(w: Warehouse) -> tuple[DataFrame, DataFrame]:
    """Change feeds with an update time: all cases as opened, then every case with a close
    time as staged, together with a stale repeat of its opening."""
    columns = ["case_id", "status", "priority"]
    opened = w.stg_cases.select(
        "case_id", F.lit("Open").alias("status"), "priority",
        ntz(datetime(2001, 1, 1)).alias("updated_at"),
    )
    closed = w.stg_cases.filter(F.col("closed_at").isNotNull())
    moved = closed.select(
        *columns, ntz(datetime(2001, 2, 1)).alias("updated_at")
    )
    stale = closed.select(
        "case_id", F.lit("Stale").alias("status"), "priority",
        ntz(datetime(2000, 12, 1)).alias("updated_at"),
    )
    return opened, moved.unionByName(stale)


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both feeds arrive as files; a streaming run merges each, a third run finds nothing."""
    root = scratch(spark, "changes")
    feeds = _versioned_cases(warehouse(spark, sf_dir))
    cases = ChangeTable(spark, f"{root}/cases", feeds[0].schema, ["case_id"], "updated_at")
    merged = None
    for feed in (*feeds, None):
        if feed is not None:
            feed.write.mode("append").parquet(f"{root}/in")
        merged = upsert_new_files(cases, f"{root}/in", f"{root}/checkpoint")
    return merged.select("case_id", "status", "priority", *_text("updated_at"))


def incremental_batch(w: Warehouse) -> DataFrame:
    """The batch form: only rows from the high-water mark on are read and merged."""
    target, feed = _versioned_cases(w)
    fresh = since_watermark(feed, target, "updated_at")
    merged = upsert_latest(target, fresh, ["case_id"], "updated_at")
    return merged.select("case_id", "status", "priority", *_text("updated_at"))


def incremental_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs that each take what came since the mark the run before has stored, and a third without news."""
    root = scratch(spark, "marks")
    marks = Marks(spark, f"{root}/marks")
    feeds = _versioned_cases(warehouse(spark, sf_dir))
    cases = ChangeTable(spark, f"{root}/cases", feeds[0].schema, ["case_id"], "updated_at")
    taken = []
    source = feeds[0].limit(0)
    for run in range(3):
        if run < 2:
            source = source.unionByName(feeds[run])
        fresh = since_mark(source, marks.before("cases", run), "updated_at")
        cases.append(fresh, run)
        taken.append(fresh.agg(F.lit(run).alias("run"), F.count("*").alias("taken")))
        marks.advance("cases", fresh, "updated_at", run)
    newest = cases.read().groupBy("status").agg(F.count("*").alias("cases"))
    return contracts.union_all(taken).select(
        F.concat(F.lit("run "), F.col("run").cast("string")).alias("object"), F.col("taken").alias("n")
    ).unionByName(newest.select(F.col("status").alias("object"), F.col("cases").alias("n")))


def incremental_late_rows(w: Warehouse) -> DataFrame:
    """Cases of Billing are not yet in the target; they come with a time before its mark or none."""
    columns = ["case_id", "status", "priority"]
    billing = F.coalesce(F.col("category") == "Billing", F.lit(False))
    target = w.stg_cases.filter(~billing).select(*columns, ntz(datetime(2001, 1, 1)).alias("updated_at"))
    late = F.when(F.col("closed_at").isNotNull(), ntz(datetime(2000, 12, 30)))
    feed = w.stg_cases.filter(billing).select(*columns, late.alias("updated_at"))
    fresh = since_watermark(feed, target, "updated_at", timedelta(days=3))
    merged = upsert_latest(target, fresh, ["case_id"], "updated_at")
    return merged.select(*columns, *_text("updated_at"))


# --- fact and views ---------------------------------------------------------


def fact_cases(w: Warehouse) -> DataFrame:
    return w.fact.select(
        "case_id", "created_date_key", "closed_date_key", "status", "priority", "category",
        *_text("created_at", "closed_at"), *_double("resolution_hours"), "resolution_bucket",
        "is_resolved", "customer_name", "region", "agent_name", "team", *DQ_FLAGS,
        "has_any_dq_flag", *_text("_loaded_at", "_updated_at"),
        F.col("sk_customer").isNotNull().alias("has_customer"),
        F.col("sk_agent").isNotNull().alias("has_agent"),
    )


def case_enriched(w: Warehouse) -> DataFrame:
    e = w.enriched
    shown = {"created_at": "string", "closed_at": "string", "resolution_hours": "double",
             "target_resolution_hrs": "double"}
    return e.select(*[F.col(c).cast(shown[c]).alias(c) if c in shown else F.col(c) for c in e.columns])


def priority_sla(w: Warehouse) -> DataFrame:
    return reporting.priority_sla(w.fact, w.sla).withColumn(
        "target_resolution_hrs", F.col("target_resolution_hrs").cast("double")
    )


def sla_policy(w: Warehouse) -> DataFrame:
    return reporting.policy_coverage(w.fact, w.sla).withColumn(
        "target_resolution_hrs", F.col("target_resolution_hrs").cast("double")
    )


def asof_region_volume(w: Warehouse) -> DataFrame:
    """Volume by the region that held when the case was created."""
    as_of = fact_source_as_of(w.stg_cases, dim_second(w), w.dim_agent)
    return as_of.groupBy("region", F.year("created_at").alias("created_year")).agg(
        F.count("*").alias("total_cases"), F.count_if(F.col("sk_customer").isNull()).alias("unmatched")
    )


def _monitor(w: Warehouse) -> DataFrame:
    return reporting.dq_monitor(w.fact, RUN_TS).drop("checked_at")


# --- contracts --------------------------------------------------------------


def contract_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    return contracts.union_all(
        [
            contracts.unique(w.source("cases"), ["case_id"], "cases"),
            contracts.unique(w.source("customers"), ["customer_id"], "customers"),
            contracts.unique(w.source("agents"), ["agent_id"], "agents"),
            contracts.unique(
                table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"
            ),
        ]
    )


def contract_not_null(w: Warehouse) -> DataFrame:
    return contracts.union_all(
        [
            contracts.not_null(w.source("cases"), ["case_id", "customer_id", "agent_id"], "cases"),
            contracts.not_null(w.source("customers"), ["customer_id"], "customers"),
            contracts.not_null(w.source("agents"), ["agent_id"], "agents"),
        ]
    )


def contract_widths(w: Warehouse) -> DataFrame:
    return contracts.union_all(
        [
            contracts.max_length(w.source("cases"), CASE_WIDTHS, "cases"),
            contracts.max_length(w.source("customers"), CUSTOMER_WIDTHS, "customers"),
            contracts.max_length(w.source("agents"), AGENT_WIDTHS, "agents"),
        ]
    )


def contract_accepted_values(w: Warehouse) -> DataFrame:
    return contracts.union_all(
        [
            contracts.unexpected_values(
                w.source("cases"),
                {
                    "priority": ACCEPTED_PRIORITIES,
                    "status": ACCEPTED_STATUSES,
                    "category": ACCEPTED_CATEGORIES,
                },
                "cases",
            ),
            contracts.unexpected_values(
                w.source("customers"), {"region": ACCEPTED_SOURCE_REGIONS}, "customers"
            ),
            contracts.unexpected_values(w.source("agents"), {"team": ACCEPTED_TEAMS}, "agents"),
        ]
    )


def contract_relationships(w: Warehouse) -> DataFrame:
    cases = w.source("cases")
    return contracts.union_all(
        [
            contracts.relationship(
                cases, "customer_id", w.source("customers"), "customer_id", "cases", "customers"
            ),
            contracts.relationship(cases, "agent_id", w.source("agents"), "agent_id", "cases", "agents"),
        ]
    )


def contract_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = warehouse(spark, sf_dir)
    sources = {"cases": "orders", "customers": "customer", "agents": "supplier"}
    return contracts.expected_row_counts(
        {name: w.raw(name) for name in sources},
        {name: table(spark, sf_dir, source) for name, source in sources.items()},
    )


def layer_row_counts(w: Warehouse) -> DataFrame:
    return contracts.row_counts(
        {
            "raw.cases": w.raw("cases"),
            "raw.customers": w.raw("customers"),
            "raw.agents": w.raw("agents"),
            "stg.stg_cases": w.stg_cases,
            "dim.dim_customer": w.dim_customer,
            "dim.dim_agent": w.dim_agent,
            "dim.dim_date": w.dim_date,
            "facts.fact_cases": w.fact,
        }
    )


def check_rows_preserved(w: Warehouse) -> DataFrame:
    return contracts.rows_preserved(
        {"raw": w.source("cases"), "staged": w.stg_cases, "fact": w.fact}, "case_id"
    )


def metric_reconciliation(w: Warehouse) -> DataFrame:
    return checks.metric_reconciliation(
        w.fact, w.source("cases"), w.source("customers"), w.source("agents")
    )


def all_queries() -> dict[str, Query]:
    on_fact = {
        "overall_resolution": analytics.overall_resolution,
        "resolution_by_priority": analytics.resolution_by_priority,
        "resolution_by_category": analytics.resolution_by_category,
        "resolution_by_team": analytics.resolution_by_team,
        "resolution_distribution": analytics.resolution_distribution,
        "closure_by_category": analytics.closure_by_category,
        "closure_by_priority": analytics.closure_by_priority,
        "status_share": analytics.status_share,
        "segment_drilldown": analytics.segment_drilldown,
        "pivot_category_status": analytics.pivot_category_status,
        "pivot_priority_status": analytics.pivot_priority_status,
        "agent_scorecard_full": analytics.agent_scorecard_full,
        "team_rollup": analytics.team_rollup,
        "top3_agents_per_team": analytics.top3_agents_per_team,
        "region_volume": analytics.region_volume,
        "region_by_category": analytics.region_by_category,
        "top10_customers": analytics.top10_customers,
        "monthly_volume": analytics.monthly_volume,
        "region_quarter": analytics.region_quarter,
        "agent_scorecard": reporting.agent_scorecard,
        "region_summary": reporting.region_summary,
        "top10_agents_by_closure": reporting.top10_agents_by_closure,
        "fact_dq_counts": checks.fact_dq_counts,
        "check_negative_resolution": checks.negative_resolution,
        "check_closed_missing_resolution": checks.closed_missing_resolution,
        "check_unmatched_keys": checks.unmatched_keys,
        "check_duration_implies_closed": checks.duration_implies_closed,
        "sanity_by_priority": checks.sanity_by_priority,
        "metric_extremes": checks.metric_extremes,
        "dq_drift_monthly": checks.dq_drift_monthly,
    }
    on_warehouse = {
        "preview_ordered": lambda w: analytics.preview(fact_cases(w), "case_id"),
        "stage_cases": stage_cases,
        "stage_customers": stage_customers,
        "stage_agents": lambda w: w.stg_agents.select("agent_id", "agent_name", "team"),
        "parse_timestamps": parse_timestamps,
        "resolution_hours": lambda w: w.stg_cases.select("case_id", *_double("resolution_hours")),
        "resolution_bucket": lambda w: w.stg_cases.groupBy("resolution_bucket").agg(
            F.count("*").alias("cases"),
            *[f(F.col("resolution_hours")).cast("double").alias(n)
              for n, f in (("min_hours", F.min), ("max_hours", F.max))],
        ),
        "dq_flags": lambda w: w.stg_cases.select("case_id", *DQ_FLAGS, "has_any_dq_flag"),
        "dq_flags_extended": lambda w: staging.extended_flags(w.source("cases")),
        "orphan_flags": lambda w: w.stg_cases.groupBy(
            "dq_flag_orphan_customer", "dq_flag_orphan_agent", "status"
        ).agg(F.count("*").alias("cases")),
        "date_keys": date_keys,
        "dq_summary": lambda w: contracts.dq_summary(w.stg_cases),
        "scd2_changed": scd2_changed,
        "scd2_new_versions": scd2_new_versions,
        "scd2_expire": scd2_expire,
        "scd2_insert": scd2_insert,
        "scd2_apply": scd2_apply,
        "scd2_no_delete": scd2_no_delete,
        "surrogate_keys": surrogate_keys,
        "merge_upsert": merge_upsert,
        "merge_audit_columns": merge_audit_columns,
        "merge_schema_change": merge_schema_change,
        "merge_idempotent": merge_idempotent,
        "fact_reload_idempotent": fact_reload_idempotent,
        "incremental_batch": incremental_batch,
        "incremental_late_rows": incremental_late_rows,
        "fact_cases": fact_cases,
        "asof_region_volume": asof_region_volume,
        "sla_policy": sla_policy,
        "case_enriched": case_enriched,
        "priority_sla": priority_sla,
        "monthly_trend": lambda w: reporting.monthly_trend(w.fact, w.dim_date),
        "dq_monitor": _monitor,
        "open_health_alert": lambda w: reporting.open_health_alert(_monitor(w)),
        "pruned_date_range": lambda w: analytics.created_range_trend(w.fact, 19970101, 19991231),
        "contract_not_null": contract_not_null,
        "contract_widths": contract_widths,
        "contract_accepted_values": contract_accepted_values,
        "contract_relationships": contract_relationships,
        "layer_row_counts": layer_row_counts,
        "check_rows_preserved": check_rows_preserved,
        "metric_reconciliation": metric_reconciliation,
    }
    direct = {
        "raw_scan": raw_scan,
        "raw_null_tokens": raw_null_tokens,
        "raw_bad_rows": raw_bad_rows,
        "raw_load_audit": raw_load_audit,
        "raw_quoted_lines": raw_quoted_lines,
        "parse_timestamp_formats": parse_timestamp_formats,
        "agents_by_range_sketch": _on_warehouse(agents_by_range_sketch),
        "median_by_range_sketch": _on_warehouse(median_by_range_sketch),
        "dq_rules_custom": dq_rules_custom,
        "dq_drift_by_load": dq_drift_by_load,
        "sql_views": sql_views,
        "load_quarantine": load_quarantine,
        "load_counts": load_counts,
        "incremental_marks": incremental_marks,
        "pipeline_file_ledger": pipeline_file_ledger,
        "pipeline_touched_months": pipeline_touched_months,
        "incremental_file_load": incremental_file_load,
        "incremental_upsert": incremental_upsert,
        "pipeline_from_csv": pipeline_from_csv,
        "pipeline_repeated_keys": pipeline_repeated_keys,
        "sla_custom_policy": sla_custom_policy,
        "pipeline_second_run": pipeline_second_run,
        "pipeline_late_parent": pipeline_late_parent,
        "pipeline_delta_checks": pipeline_delta_checks,
        "date_spine": date_spine,
        "dim_date": dim_date,
        "date_dim_bounds": date_dim_bounds,
        "contract_row_counts": contract_row_counts,
        "contract_unique": contract_unique,
    }
    return {
        **{n: _on_fact(q) for n, q in on_fact.items()},
        **{n: _on_warehouse(q) for n, q in on_warehouse.items()},
        **direct,
    }
