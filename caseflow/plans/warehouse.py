"""The layers RAW -> STG -> DIM -> FACT as tables, loaded by numbered runs.

Each layer is written as Parquet into the shared workspace on first use and read back, so a
report scans a few columns of the fact instead of deriving it again, and a lost executor
costs a re-read rather than a recomputation of the chain. A later run over the same root adds
its extract to RAW and merges it into the other tables of the run before it; repeating a run
changes nothing. A parent that arrives after its cases clears their orphan flags. Staged cases and
the fact are split by month of creation, and a run reads and writes the months it touches: those of its
cases, also where they were before, those of cases whose parent has come, and in the fact those of
cases whose customer or agent has a new version.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.functions.time import vote_formats
from caseflow.operators import calendar as cal
from caseflow.operators import dims, fact, sketches, staging
from caseflow.operators.upsert import last_delivered, require_unique, upsert
from caseflow.plans import reporting
from caseflow.schemas import (
    AGENT_ATTRIBUTES,
    CALENDAR_END,
    CALENDAR_START,
    CUSTOMER_ATTRIBUTES,
    RAW_AGENTS,
    RAW_CASES,
    RAW_CUSTOMERS,
    SLA_SCHEMA,
)
from caseflow.sources import casemodel, landing, ledger
from caseflow.sources.landing import land
from caseflow.sources.months import MONTH, MonthTable, in_months, month_of, months_of
from caseflow.sources.snapshots import SnapshotTable
from caseflow.workspace import hadoop_path, scratch

# Business key of each feed.
KEYS = {"cases": "case_id", "customers": "customer_id", "agents": "agent_id"}

# Landed columns of each feed.
FEEDS = {"cases": RAW_CASES, "customers": RAW_CUSTOMERS, "agents": RAW_AGENTS}

# Guards the shared registries below and the locks of the single tables.
_registry = threading.Lock()


def _side_by_side(spark: SparkSession, *steps: Callable[[], DataFrame]) -> list[DataFrame]:
    """Build tables that do not depend on each other at the same time, under the caller's job group and tags."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [started.result() for started in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


@dataclass
class Warehouse:
    """Tables by layer; each is built from the layers before it when first asked for.

    ``extract`` holds the landed frames of this run: cases, customers and agents. ``policy`` replaces
    the built-in SLA targets: priority and target_resolution_hrs, one row per priority. ``rules`` are flags
    beyond the built-in ones; they reach staging, the fact and the monitor. ``formats`` are those of the cases'
    timestamps beside ISO, for example ``dd/MM/yyyy HH:mm``: the one that reads most values of an extract goes first.
    """

    spark: SparkSession
    extract: dict[str, DataFrame]
    root: str
    run_ts: datetime
    as_of: date
    span: tuple[date, date] = (CALENDAR_START, CALENDAR_END)
    run_id: int = 0
    policy: DataFrame | None = None
    rules: tuple[staging.Rule, ...] = ()
    formats: tuple[str, ...] = ()
    _tables: dict[str, DataFrame] = field(default_factory=dict)
    _locks: dict[str, threading.Lock] = field(default_factory=dict)

    @classmethod
    def from_csv(
        cls, spark: SparkSession, paths: dict[str, str], root: str, run_ts: datetime, **options
    ) -> Warehouse:
        """A run over CSV files of cases, customers and agents. Damaged lines stay beside the rows they gave."""
        extract = {
            n: landing.land_csv(spark, paths[n], schema, run_ts, keep_damaged=True) for n, schema in FEEDS.items()
        }
        return cls(spark, extract, root, run_ts, run_ts.date(), **options)

    @classmethod
    def from_folders(
        cls, spark: SparkSession, folders: dict[str, str], root: str, run_ts: datetime, run_id: int = 0, **options
    ) -> Warehouse:
        """A run over the files that came to the folders of the feeds since the runs before it.

        The ledger of a feed lists each file once, by path, length and time, and is written with the run;
        a file that was replaced counts as new. A run without a new file of a feed lands no row of it.
        """
        w = cls(spark, {}, root, run_ts, run_ts.date(), run_id=run_id, **options)
        for name, schema in FEEDS.items():
            fresh = w.table(
                f"files_{name}", lambda _, f=folders[name], n=name: ledger.new_files(spark, f, w.loaded_files(n), run_id)
            )
            paths = [r["path"] for r in fresh.select("path").toLocalIterator()]
            w.extract[name] = landing.land_csv(spark, sorted(paths), schema, run_ts, keep_damaged=True)
        return w

    def loaded_files(self, feed: str) -> DataFrame | None:
        """The ledger of a feed before this run, None before the first."""
        earlier = self._earlier(f"files_{feed}")
        return earlier.read_all_before(self.run_id) if earlier else None

    def table(
        self,
        name: str,
        build: Callable[[DataFrame | None], DataFrame],
        partition_by: dict[str, T.DataType] | None = None,
    ) -> DataFrame:
        """The named table after this run; ``build`` gets it as the run before left it.

        A second thread that asks for the table waits for the first instead of writing it too.
        """
        with _registry:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._tables:
                snapshot = SnapshotTable(self.spark, f"{self.root}/{name}", partition_by)
                previous = snapshot.read_before(self.run_id)
                self._tables[name] = snapshot.write(build(previous), self.run_id)
            return self._tables[name]

    def _by_month(
        self, name: str, build: Callable[[DataFrame | None], tuple[DataFrame, set[int | None] | None]]
    ) -> DataFrame:
        """Like :meth:`table` for a table split by month: ``build`` gives rows, and the months they replace."""
        with _registry:
            lock = self._locks.setdefault(name, threading.Lock())
        with lock:
            if name not in self._tables:
                months = MonthTable(self.spark, f"{self.root}/{name}")
                rows, touched = build(months.before(self.run_id))
                self._tables[name] = months.write(rows, self.run_id, touched)
            return self._tables[name]

    # RAW: the landed text of every run, each in its own folder that no later run touches
    def landed(self, feed: str) -> DataFrame:
        """The rows of this run's extract."""
        return self.table(
            f"raw_{feed}", lambda _: self.extract[feed].withColumn("_run_id", F.lit(self.run_id).cast("long"))
        )

    def _earlier(self, table: str) -> SnapshotTable | None:
        """The table if runs before this one have written it."""
        snapshot = SnapshotTable(self.spark, f"{self.root}/{table}")
        return snapshot if snapshot.before(self.run_id) else None

    def raw(self, feed: str) -> DataFrame:
        """The rows of all extracts up to this run's."""
        landed, earlier = self.landed(feed), self._earlier(f"raw_{feed}")
        if earlier is None:
            return landed
        return earlier.read_all_before(self.run_id).unionByName(landed, allowMissingColumns=True)

    def source(self, feed: str) -> DataFrame:
        """RAW without the rows whose key a later run delivered again; rows without a key stay."""
        if self._earlier(f"raw_{feed}") is None:
            return self.landed(feed)
        return last_delivered(self.raw(feed), KEYS[feed], "_run_id")

    def quarantine(self, feed: str) -> DataFrame:
        """The damaged lines of this run's files, apart from the rows they gave: file, line, run."""

        def build(_: DataFrame | None) -> DataFrame:
            rows = self.landed(feed)
            if landing.CORRUPT not in rows.columns:
                rows = rows.withColumn(landing.CORRUPT, F.lit(None).cast("string"))
            lines = landing.quarantine(rows).withColumnRenamed(landing.CORRUPT, "line")
            return lines.select("_source_file", "line", "_run_id", "_loaded_at")

        return self.table(f"quarantine_{feed}", build)

    def load_counts(self) -> DataFrame:
        """Rows and damaged lines of every file this run has landed."""
        return landing.load_counts({feed: self.landed(feed) for feed in KEYS}, {feed: self.quarantine(feed) for feed in KEYS})

    # STG: customers and agents first, because cases look both up. One row per key from the first run on: a key
    # that an extract repeats is an error
    def _unique(self, feed: str) -> None:
        key = KEYS[feed]
        require_unique(self.landed(feed).filter(F.col(key).isNotNull()), [key], feed)

    def _staged(self, feed: str, rows: DataFrame) -> DataFrame:
        def build(previous: DataFrame | None) -> DataFrame:
            if previous is not None:
                return upsert(previous, rows, [KEYS[feed]])
            self._unique(feed)
            return rows

        return self.table(f"stg_{feed}", build)

    @property
    def stg_customers(self) -> DataFrame:
        return self._staged(
            "customers", staging.stage_customers(self.landed("customers"), self.run_ts)
        )

    @property
    def stg_agents(self) -> DataFrame:
        return self._staged("agents", staging.stage_agents(self.landed("agents"), self.run_ts))

    def _orphans(self, fk: str, parent: DataFrame) -> DataFrame:
        """Keys without a parent among the cases of this run and of the runs before it."""

        def build(_: DataFrame | None) -> DataFrame:
            used = self.landed("cases").select(fk)
            earlier = MonthTable(self.spark, f"{self.root}/stg_cases").before(self.run_id)
            if earlier is not None:
                used = used.unionByName(earlier.select(fk))
            return staging.orphan_keys(used, fk, parent, fk)

        return self.table(f"orphans_{fk}", build)

    def _settled(self, cases: DataFrame, fk: str, orphans: DataFrame) -> DataFrame:
        """``cases`` that were orphans before this run and have a parent now."""
        known = self._earlier(f"orphans_{fk}")
        came = known.read_before(self.run_id).join(orphans, "fk", "left_anti")
        return cases.join(came, F.col(fk) == F.col("fk"), "left_semi")

    @property
    def stg_cases(self) -> DataFrame:
        def build(previous: DataFrame | None) -> tuple[DataFrame, set[int | None] | None]:
            keys = ("customer_id", "agent_id")
            parents = (lambda: self.stg_customers, lambda: self.stg_agents)
            orphans = _side_by_side(
                self.spark, *[lambda k=k, p=p: self._orphans(k, p()) for k, p in zip(keys, parents, strict=True)]
            )
            cases = self.landed("cases")
            formats = vote_formats(cases, ("created_at", "closed_at"), self.formats)
            staged = staging.stage_cases(cases, *orphans, self.run_ts, self.rules, formats)
            staged = staged.withColumn(MONTH, month_of(F.col("created_at")))
            if previous is None:
                self._unique("cases")
                return staged.hint("rebalance", MONTH), None
            moved = previous.select("case_id", MONTH).join(staged.select("case_id"), "case_id", "left_semi")
            settled = [self._settled(previous.select(k, MONTH), k, o) for k, o in zip(keys, orphans, strict=True)]
            touched = set().union(*map(months_of, (staged, moved, *settled)))
            merged = upsert(previous.filter(in_months(touched)), staged, ["case_id"])
            return staging.with_current_orphans(merged, *orphans, self.rules).hint("rebalance", MONTH), touched

        return self._by_month("stg_cases", build)

    # DIM: split by is_current, so the fact load does not read expired versions
    def _dimension(
        self, name: str, source: DataFrame, key: str, attributes: tuple[str, ...], surrogate: str
    ) -> DataFrame:
        return self.table(
            name,
            lambda previous: dims.apply_changes(
                previous, source, key, attributes, surrogate, self.as_of, self.run_ts
            ),
            {"is_current": T.BooleanType()},
        )

    @property
    def dim_customer(self) -> DataFrame:
        return self._dimension(
            "dim_customer", self.stg_customers, "customer_id", CUSTOMER_ATTRIBUTES, "sk_customer"
        )

    @property
    def dim_agent(self) -> DataFrame:
        return self._dimension(
            "dim_agent", self.stg_agents, "agent_id", AGENT_ATTRIBUTES, "sk_agent"
        )

    # replaced as a whole by every run
    @property
    def dim_date(self) -> DataFrame:
        return self.table(
            "dim_date", lambda _: cal.calendar(cal.date_spine(self.spark, *self.span))
        )

    @property
    def sla(self) -> DataFrame:
        if self.policy is None:
            return reporting.sla_policy(self.spark)
        policy = self.policy.select(*[F.col(f.name).cast(f.dataType) for f in SLA_SCHEMA])
        return self.table("sla_policy", lambda _: require_unique(policy, ["priority"], "the SLA policy"))

    # FACT: follows the staged cases and the current dimension versions
    def _new_versions(self, name: str, dim: DataFrame, key: str, surrogate: str) -> DataFrame:
        """Keys whose current version began in this run."""
        now = dims.current(dim).select(key, surrogate)
        return now.join(self._earlier(name).read_before(self.run_id).select(surrogate), surrogate, "left_anti").select(key)

    @property
    def fact(self) -> DataFrame:
        def build(previous: DataFrame | None) -> tuple[DataFrame, set[int | None] | None]:
            _side_by_side(
                self.spark, lambda: self.landed("cases"), lambda: self.dim_customer, lambda: self.dim_agent
            )
            cases, touched = self.stg_cases, None
            if previous is not None:
                touched = MonthTable(self.spark, f"{self.root}/stg_cases").touched(self.run_id)
            if touched is not None:
                for name, dim, key, surrogate in (
                    ("dim_customer", self.dim_customer, "customer_id", "sk_customer"),
                    ("dim_agent", self.dim_agent, "agent_id", "sk_agent"),
                ):
                    changed = self._new_versions(name, dim, key, surrogate)
                    touched |= months_of(cases.select(key, MONTH).join(changed, key, "left_semi"))
                cases, previous = cases.filter(in_months(touched)), previous.filter(in_months(touched))
            flags = [r.name for r in self.rules]
            rows = fact.fact_source(cases, self.dim_customer, self.dim_agent, flags)
            if previous is not None:
                previous = previous.drop(MONTH)
            return fact.clustered_by_month(fact.load_fact(previous, rows, self.run_ts, flags)), touched

        return self._by_month("fact_cases", build)

    @property
    def sketches(self) -> DataFrame:
        """Sketches by month, region and team. A run writes the months that the fact has replaced since they were last written."""

        def build(previous: DataFrame | None) -> tuple[DataFrame, set[int | None] | None]:
            rows, touched = self.fact, None
            if previous is not None:
                months = MonthTable(self.spark, f"{self.root}/fact_cases")
                last = max(r for r in MonthTable(self.spark, f"{self.root}/fact_sketches").runs() if r < self.run_id)
                since = [months.touched(r) for r in months.runs() if last < r <= self.run_id]
                touched = None if None in since else set().union(*since)
            if touched is not None:
                rows = rows.filter(in_months(touched))
            return sketches.month_sketches(rows, ("region", "team")), touched

        return self._by_month("fact_sketches", build)

    # RPT
    @property
    def enriched(self) -> DataFrame:
        return reporting.case_enriched(self.fact, self.dim_date, self.sla)

    @property
    def monitor(self) -> DataFrame:
        return reporting.dq_monitor(self.fact, self.run_ts, [r.name for r in self.rules])

    @property
    def monitor_history(self) -> DataFrame:
        """The monitor as every run up to this one has seen it, one row each."""
        seen = self.table("monitor", lambda _: self.monitor.withColumn("run_id", F.lit(self.run_id).cast("long")))
        earlier = self._earlier("monitor")
        return seen if earlier is None else earlier.read_all_before(self.run_id).unionByName(seen, allowMissingColumns=True)

    def publish(self) -> None:
        """Register the fact, the dimensions, the SLA targets and the reporting views by name."""
        reporting.publish(
            {
                "fact_cases": self.fact,
                "dim_customer": self.dim_customer,
                "dim_agent": self.dim_agent,
                "dim_date": self.dim_date,
                "sla_policy": self.sla,
                "case_enriched": self.enriched,
                "agent_scorecard": reporting.agent_scorecard(self.fact),
                "region_summary": reporting.region_summary(self.fact),
                "priority_sla": reporting.priority_sla(self.fact, self.sla),
                "monthly_trend": reporting.monthly_trend(self.fact, self.dim_date),
                "data_quality_monitor": self.monitor,
                "data_quality_history": self.monitor_history,
            }
        )


# --- the case model over the order tables -------------------------------------

# Run parameters of the order-derived warehouse: fixed, so that runs repeat exactly.
RUN_TS = datetime(2001, 9, 1)
AS_OF = date(2001, 9, 1)
SPAN = (date(1995, 1, 1), date(2002, 12, 31))

_SOURCES = ("orders", "lineitem", "customer", "supplier", "nation", "region")
_roots: dict[tuple, str] = {}
_built: dict[tuple, Warehouse] = {}


def source_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three source feeds as text, damage included."""
    return {
        "cases": casemodel.source_cases(spark, sf_dir),
        "customers": casemodel.source_customers(spark, sf_dir),
        "agents": casemodel.source_agents(spark, sf_dir),
    }


def stored_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The feeds for several runs that each take a part of the cases: these join the largest tables, so they are
    derived once and read by every run."""
    feeds, path = source_feeds(spark, sf_dir), scratch(spark, "case-feed")
    feeds["cases"].write.parquet(path)
    return feeds | {"cases": spark.read.schema(feeds["cases"].schema).parquet(path)}


def landed(feeds: dict[str, DataFrame], run_ts: datetime) -> dict[str, DataFrame]:
    return {name: land(feed, run_ts, F.lit(f"{name}.csv")) for name, feed in feeds.items()}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the source tables: a changed input gets a new warehouse."""
    state = []
    for name in _SOURCES:
        fs, path = hadoop_path(spark, f"{sf_dir}/{name}.parquet")
        summary = fs.getContentSummary(path)
        state.append(
            (summary.getLength(), summary.getFileCount(), fs.getFileStatus(path).getModificationTime())
        )
    return tuple(state)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of the case model over the order tables in ``sf_dir``.

    Its tables are written once per application; another session of the application gets its
    own frames over the same tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    session = (*key, spark._jsparkSession.hashCode())
    with _registry:
        if session not in _built:
            root = _roots.setdefault(key, scratch(spark, "warehouse"))
            extract = landed(source_feeds(spark, sf_dir), RUN_TS)
            _built[session] = Warehouse(spark, extract, root, RUN_TS, AS_OF, SPAN)
        return _built[session]
