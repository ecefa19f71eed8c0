"""Expected results as DuckDB SQL over the source tables.

Written from the semantics alone and without the Spark code. Rounded figures use integer
arithmetic on counts and hundredths of hours, so no floating point sum can move a digit.
"""

from __future__ import annotations

RAW = """
lines AS (
  SELECT l_orderkey, max(l_shipdate) AS ship, min(l_suppkey) AS supp FROM lineitem GROUP BY 1
),
src_cases AS (
  SELECT o_orderkey AS k, 'C' || o_orderkey AS case_id,
    CASE WHEN o_orderkey % 101 = 0 THEN 'not-a-date'
         ELSE strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)), '%Y-%m-%dT%H:%M:%S') END AS created_at,
    CASE WHEN o_orderkey % 23 = 0 THEN ''
         WHEN ship IS NULL THEN NULL
         WHEN o_orderkey % 5 = 0 THEN strftime(o_orderdate + to_hours(CAST(o_orderkey % 24 + o_orderkey % 160 AS INT)), '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(ship + to_hours(CAST(o_orderkey * 7 % 24 AS INT)), '%Y-%m-%dT%H:%M:%S') END AS closed_at,
    CASE WHEN o_orderkey % 53 = 0 THEN 'CU-X' || o_custkey ELSE 'CU' || o_custkey END AS customer_id,
    'AG' || supp AS agent_id,
    CASE o_orderkey % 4 WHEN 0 THEN 'Technical' WHEN 1 THEN 'Account' WHEN 2 THEN 'Billing' ELSE 'Other' END AS category,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
         WHEN '5-LOW' THEN 'Low' ELSE 'Unspecified' END AS priority,
    CASE WHEN o_orderstatus = 'F' THEN ' Closed ' WHEN o_orderstatus = 'O' THEN 'Open'
         WHEN o_orderkey % 2 = 0 THEN 'In Progress' ELSE 'On Hold' END AS status
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
),
src_customers AS (
  SELECT 'CU' || c_custkey AS customer_id, c_name AS customer_name,
    CASE WHEN c_custkey % 2 = 0 THEN '  ' || lower(r_name) ELSE r_name || ' ' END AS region,
    CASE WHEN c_custkey % 97 = 0 THEN 'bad'
         ELSE strftime(DATE '1994-01-01' + CAST(c_custkey % 1500 AS INT), '%Y-%m-%d') END AS signup_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
),
src_agents AS (
  SELECT 'AG' || s_suppkey AS agent_id, s_name AS agent_name,
    CASE s_nationkey % 4 WHEN 0 THEN 'Billing' WHEN 1 THEN 'Tier 1' WHEN 2 THEN 'Tier 2' ELSE 'Escalations' END AS team
  FROM supplier
),
raw_cases AS (
  SELECT case_id, nullif(trim(created_at), '') AS created_at, nullif(trim(closed_at), '') AS closed_at,
    customer_id, agent_id, category, priority, trim(status) AS status, k
  FROM src_cases
),
raw_customers AS (
  SELECT customer_id, customer_name, trim(region) AS region, signup_date FROM src_customers
)"""

STG = (
    RAW
    + """,
stg_customers AS (
  SELECT customer_id, customer_name, upper(region) AS region, TRY_CAST(signup_date AS DATE) AS signup_date
  FROM raw_customers
),
stg_agents AS (SELECT * FROM src_agents),
timed AS (
  SELECT c.*, TRY_CAST(c.created_at AS TIMESTAMP) AS opened, TRY_CAST(c.closed_at AS TIMESTAMP) AS shut,
    sc.customer_id IS NULL AS orphan_customer, sa.agent_id IS NULL AS orphan_agent
  FROM raw_cases c
  LEFT JOIN stg_customers sc ON c.customer_id = sc.customer_id
  LEFT JOIN stg_agents sa ON c.agent_id = sa.agent_id
),
measured AS (
  SELECT *, CASE WHEN status = 'Closed' AND shut > opened THEN date_diff('second', opened, shut) END AS secs FROM timed
),
stg AS (
  SELECT case_id, opened, shut, customer_id, agent_id, category, priority, status,
    CAST((2 * secs + 36) // 72 AS BIGINT) AS cents,
    CASE WHEN secs IS NULL THEN NULL WHEN secs < 24 * 3600 THEN '<24h' WHEN secs < 72 * 3600 THEN '1-3 days'
         ELSE '>3 days' END AS resolution_bucket,
    status = 'Closed' AND closed_at IS NULL AS dq_flag_closed_no_timestamp,
    status IN ('Open', 'On Hold', 'In Progress') AND closed_at IS NOT NULL AS dq_flag_status_ts_mismatch,
    opened IS NULL AS dq_flag_invalid_created_at,
    orphan_customer AS dq_flag_orphan_customer,
    orphan_agent AS dq_flag_orphan_agent,
    created_at AS created_text, closed_at AS closed_text
  FROM measured
),
stg_cases AS (
  SELECT *, dq_flag_closed_no_timestamp OR dq_flag_status_ts_mismatch OR dq_flag_invalid_created_at
    OR dq_flag_orphan_customer OR dq_flag_orphan_agent AS has_any_dq_flag
  FROM stg
)"""
)

DAY_KEY = "year({0}) * 10000 + month({0}) * 100 + day({0})"

FACT = (
    STG
    + f""",
fact AS (
  SELECT s.*, s.status = 'Closed' AS is_resolved,
    CAST({DAY_KEY.format("s.opened")} AS INT) AS created_date_key,
    CAST({DAY_KEY.format("s.shut")} AS INT) AS closed_date_key,
    c.customer_name, c.region, a.agent_name, a.team,
    c.customer_id IS NOT NULL AS has_customer, a.agent_id IS NOT NULL AS has_agent
  FROM stg_cases s
  LEFT JOIN stg_customers c ON s.customer_id = c.customer_id
  LEFT JOIN stg_agents a ON s.agent_id = a.agent_id
),
clean AS (SELECT * FROM fact WHERE NOT has_any_dq_flag AND is_resolved AND cents IS NOT NULL)"""
)

POLICY = "('Urgent', 8.0), ('High', 24.0), ('Medium', 72.0), ('Low', 120.0)"

ENRICHED = (
    FACT
    + """,
calendar AS (
  SELECT CAST(d AS DATE) AS d FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2002-12-31', INTERVAL 1 DAY) t(d)
),
policy AS (
  SELECT * FROM (VALUES """
    + POLICY
    + """) p(priority, target)
),
enriched AS (
  SELECT f.*, o.d AS created_date, year(o.d) AS created_year,
    'Q' || quarter(o.d) || ' ' || year(o.d) AS created_quarter, strftime(o.d, '%b') AS created_month,
    dayofweek(o.d) IN (0, 6) AS created_on_weekend,
    x.d AS closed_date, 'Q' || quarter(x.d) || ' ' || year(x.d) AS closed_quarter,
    CAST(p.target AS DOUBLE) AS target_resolution_hrs,
    CASE WHEN NOT has_any_dq_flag AND is_resolved AND cents IS NOT NULL THEN cents <= p.target * 100 END AS sla_met
  FROM fact f
  LEFT JOIN calendar o ON o.d = CAST(f.opened AS DATE)
  LEFT JOIN calendar x ON x.d = CAST(f.shut AS DATE)
  LEFT JOIN policy p ON p.priority = f.priority
)"""
)

HISTORY = (
    FACT
    + """,
extract_1 AS (SELECT * FROM stg_customers WHERE region IS DISTINCT FROM 'ASIA'),
extract_2 AS (
  SELECT customer_id, customer_name, CASE WHEN region = 'EUROPE' THEN 'EMEA' ELSE region END AS region,
    CASE WHEN region IS DISTINCT FROM 'MIDDLE EAST' THEN signup_date END AS signup_date
  FROM stg_customers WHERE region IS DISTINCT FROM 'AFRICA'
),
moved AS (
  SELECT a.customer_id FROM extract_1 a JOIN extract_2 b USING (customer_id)
  WHERE a.customer_name IS DISTINCT FROM b.customer_name OR a.region IS DISTINCT FROM b.region
    OR a.signup_date IS DISTINCT FROM b.signup_date
),
expired AS (
  SELECT customer_id, customer_name, region, signup_date, DATE '1996-01-01' AS valid_from,
    CASE WHEN customer_id IN (SELECT customer_id FROM moved) THEN DATE '1998-06-30' ELSE DATE '9999-12-31' END AS valid_to,
    customer_id NOT IN (SELECT customer_id FROM moved) AS is_current
  FROM extract_1
),
fresh AS (
  SELECT customer_id, customer_name, region, signup_date FROM extract_2
  WHERE customer_id IN (SELECT customer_id FROM moved) OR customer_id NOT IN (SELECT customer_id FROM extract_1)
),
inserted AS (
  SELECT *, DATE '1998-07-01' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current FROM fresh
),
versions AS (SELECT * FROM expired UNION ALL SELECT * FROM inserted)"""
)

EXTRACTS = (
    FACT
    + """,
first_cases AS (
  SELECT case_id, 'Open' AS status, priority, CAST(NULL AS DOUBLE) AS resolution_hours
  FROM stg_cases WHERE opened IS NULL OR opened < TIMESTAMP '2000-01-01'
),
second_cases AS (
  SELECT case_id, status, priority, cents / 100.0 AS resolution_hours FROM stg_cases WHERE shut IS NOT NULL
)"""
)

FLAG_COLUMNS = """dq_flag_closed_no_timestamp, dq_flag_status_ts_mismatch, dq_flag_invalid_created_at,
  dq_flag_orphan_customer, dq_flag_orphan_agent, has_any_dq_flag"""


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """``numerator / denominator`` rounded half up at ``scale`` digits, by integer division."""
    unit = 10**scale
    return (
        f"CASE WHEN ({denominator}) > 0 THEN ((2 * {unit} * CAST({numerator} AS HUGEINT) + ({denominator}))"
        f" // (2 * ({denominator}))) / {unit}.0 END"
    )


def pct(part: str, whole: str, scale: int = 1) -> str:
    return half_up(f"100 * ({part})", whole, scale)


def avg_hours(total: str, n: str, scale: int = 1) -> str:
    return half_up(total, f"100 * ({n})", scale)


TOTAL = "count(*) AS total_cases"
RESOLVED = "count(*) FILTER (is_resolved) AS resolved_cases"
CLOSURE = pct("count(*) FILTER (is_resolved)", "count(*)") + " AS closure_rate_pct"
AVG_RESOLVED = (
    avg_hours(
        "coalesce(sum(cents) FILTER (is_resolved), 0)", "count(cents) FILTER (is_resolved)"
    )
    + " AS avg_resolution_hours"
)
AVG_CLEAN = avg_hours("sum(cents)", "count(*)") + " AS avg_resolution_hours"


def median(values: str) -> str:
    """Median hours at one digit; the two middle hundredths are summed before dividing."""
    n = f"len({values})"
    pair = f"{values}[({n} + 1) // 2] + {values}[{n} // 2 + 1]"
    return half_up(pair, f"CASE WHEN {n} > 0 THEN 200 ELSE 0 END", 1) + " AS median_resolution_hours"


CLEAN_VALUES = "list(cents ORDER BY cents)"
RESOLVED_VALUES = "coalesce(list(cents ORDER BY cents) FILTER (is_resolved AND cents IS NOT NULL), [])"


def status_count(status: str, name: str) -> str:
    return f"count(*) FILTER (status = '{status}') AS {name}"


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def _resolution_by(key: str, extra: str = "") -> str:
    return _q(
        FACT,
        f"SELECT {key}, count(*) AS resolved_cases, {AVG_CLEAN}, {median(CLEAN_VALUES)}{extra} FROM clean GROUP BY {key}",
    )


def _closure_by(*keys: str) -> str:
    k = ", ".join(keys)
    return f"SELECT {k}, {TOTAL}, {RESOLVED}, {CLOSURE} FROM fact GROUP BY {k}"


def _pivot(key: str) -> str:
    cells = ", ".join(
        [
            status_count("Closed", "closed"),
            status_count("In Progress", "in_progress"),
            status_count("On Hold", "on_hold"),
            status_count("Open", "open_cases"),
        ]
    )
    return _q(FACT, f"SELECT {key}, {cells}, {TOTAL} FROM fact GROUP BY {key}")


AGENTS = (
    f"SELECT agent_name, team, {TOTAL}, {RESOLVED}, {CLOSURE}, {AVG_RESOLVED}, {median(RESOLVED_VALUES)}, "
    "count(*) FILTER (has_any_dq_flag) AS dq_flagged_cases{extra} FROM fact GROUP BY agent_name, team"
)

REGION = (
    f"SELECT region, {TOTAL}, {RESOLVED}, {CLOSURE}, {AVG_RESOLVED}, "
    f"{status_count('On Hold', 'on_hold_cases')}, {status_count('Open', 'open_cases')} FROM fact GROUP BY region"
)

MONITOR = f"""SELECT fact_rows, dq_flagged, dq_flag_pct, negative_resolution_rows, orphan_customers, orphan_agents,
  closed_missing_resolution, fact_rows > 0 AND negative_resolution_rows = 0 AND orphan_customers = 0
    AND orphan_agents = 0 AS pipeline_healthy
FROM (SELECT count(*) AS fact_rows, count(*) FILTER (has_any_dq_flag) AS dq_flagged,
  {pct("count(*) FILTER (has_any_dq_flag)", "count(*)")} AS dq_flag_pct,
  count(*) FILTER (cents < 0) AS negative_resolution_rows,
  count(*) FILTER (NOT has_customer) AS orphan_customers,
  count(*) FILTER (NOT has_agent) AS orphan_agents,
  count(*) FILTER (status = 'Closed' AND cents IS NULL) AS closed_missing_resolution FROM fact) t"""

CALENDAR = f"""SELECT CAST({DAY_KEY.format("d")} AS INT) AS date_key, d AS full_date,
  strftime(d, '%a') AS day_of_week, CAST(dayofweek(d) AS INT) AS day_of_week_num, CAST(day(d) AS INT) AS day_of_month,
  CAST(weekofyear(d) AS INT) AS week_of_year, CAST(month(d) AS INT) AS month_num, strftime(d, '%b') AS month_name,
  CAST(quarter(d) AS INT) AS quarter_num, 'Q' || quarter(d) || ' ' || year(d) AS quarter_label,
  CAST(year(d) AS INT) AS year_num, dayofweek(d) IN (0, 6) AS is_weekend, dayofweek(d) NOT IN (0, 6) AS is_weekday
FROM spine"""

SPINE = """spine AS (
  SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM orders
)"""

CASE_ROW = f"""case_id, CAST(opened AS VARCHAR) AS created_at, CAST(shut AS VARCHAR) AS closed_at,
  category, priority, status, cents / 100.0 AS resolution_hours, resolution_bucket, {FLAG_COLUMNS}"""

FACT_ROW = f"""SELECT {CASE_ROW}, created_date_key, closed_date_key, is_resolved, customer_name, region, agent_name,
  team, has_customer, has_agent, '2001-09-01 00:00:00' AS _loaded_at, '2001-09-01 00:00:00' AS _updated_at FROM fact"""


def _unique(name: str, table: str, keys: str) -> str:
    return (
        f"SELECT 'unique' AS \"check\", '{name}' AS object, count(*) AS violations, count(*) = 0 AS ok"
        f" FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1) u"
    )


def _not_null(name: str, table: str, column: str) -> str:
    n = f"count(*) FILTER ({column} IS NULL OR trim({column}) = '')"
    return (
        f"SELECT 'not_null' AS \"check\", '{name}.{column}' AS object, {n} AS violations, {n} = 0 AS ok FROM {table}"
    )


def _widths(name: str, table: str, widths: dict[str, int]) -> list[str]:
    return [
        f"SELECT 'max_length' AS \"check\", '{name}.{c}' AS object, count(*) FILTER (length({c}) > {n}) AS violations,"
        f" count(*) FILTER (length({c}) > {n}) = 0 AS ok FROM {table}"
        for c, n in widths.items()
    ]


def _accepted(name: str, table: str, column: str, values: str) -> str:
    return (
        f"SELECT '{name}.{column}' AS object, {column} AS value, count(*) AS row_count FROM {table}"
        f" WHERE {column} IS NULL OR {column} NOT IN ({values}) GROUP BY {column}"
    )


def _relationship(fk: str, parent: str, parent_name: str) -> str:
    n = f"count(*) FILTER ({fk} IS NULL OR {fk} NOT IN (SELECT {fk} FROM {parent}))"
    return (
        f"SELECT 'relationships' AS \"check\", 'cases.{fk} -> {parent_name}.{fk}' AS object,"
        f" {n} AS violations, {n} = 0 AS ok FROM raw_cases"
    )


def _extremes(table: str, key: str, value: str, low: str, high: str) -> str:
    grouped = f"(SELECT {key} AS slice, CAST({value} AS DOUBLE) AS value FROM {table} WHERE {key} IS NOT NULL GROUP BY {key})"
    return (
        f"(SELECT '{low}' AS metric, slice, value FROM {grouped} a ORDER BY value, slice LIMIT 1) UNION ALL "
        f"(SELECT '{high}', slice, value FROM {grouped} b ORDER BY value DESC, slice LIMIT 1)"
    )


_CLEAN_AVG = avg_hours("sum(cents)", "count(*)")
_CLOSURE = pct("count(*) FILTER (is_resolved)", "count(*)")


def _metric(name: str, table: str, key: str | None, value: str) -> str:
    slice_ = f"coalesce({key}, '(none)')" if key else "'all'"
    group = f" GROUP BY {key}" if key else ""
    return (
        f"SELECT '{name}' AS metric, {slice_} AS slice, CAST({value} AS DOUBLE) AS v FROM {table}{group}"
    )


RECONCILED = " UNION ALL ".join(
    [
        _metric("cases", "fact", None, "count(*)"),
        _metric("flagged", "fact", None, "count(*) FILTER (has_any_dq_flag)"),
        _metric("clean_resolved", "clean", None, "count(*)"),
        _metric("avg_hours", "clean", None, _CLEAN_AVG),
        _metric("avg_hours_by_priority", "clean", "priority", _CLEAN_AVG),
        _metric("avg_hours_by_team", "clean", "team", _CLEAN_AVG),
        _metric("cases_by_region", "fact", "region", "count(*)"),
        _metric("closed_by_region", "fact", "region", "count(*) FILTER (is_resolved)"),
        _metric("closed_by_priority", "fact", "priority", "count(*) FILTER (is_resolved)"),
    ]
)


def oracle_sql() -> dict[str, str]:
    share = "sum(count(*)) OVER ()"
    return {
        # RAW
        "raw_scan": _q(
            RAW,
            "SELECT *, '2001-09-01 00:00:00' AS _loaded_at, 'customers.csv' AS _source_file FROM raw_customers",
        ),
        "raw_null_tokens": _q(RAW, "SELECT case_id, closed_at, agent_id, status FROM raw_cases"),
        "raw_bad_rows": _q(
            RAW,
            "SELECT case_id, customer_id, category, priority, CASE WHEN category <> 'Other' THEN status END AS status,"
            " category IN ('Other', 'Billing') AS damaged FROM raw_cases",
        ),
        "raw_load_audit": """SELECT 'cases' AS tbl, 'cases.csv' AS _source_file, count(*) AS row_count FROM orders
UNION ALL SELECT 'customers', 'customers.csv', count(*) FROM customer
UNION ALL SELECT 'agents', 'agents.csv', count(*) FROM supplier""",
        "incremental_file_load": _q(
            RAW,
            "SELECT category, status, count(*) AS row_count, count(DISTINCT case_id) AS case_count"
            " FROM raw_cases GROUP BY category, status",
        ),
        "preview_ordered": _q(FACT, FACT_ROW + " ORDER BY case_id LIMIT 20"),
        # staging
        "stage_cases": _q(STG, f"SELECT {CASE_ROW}, customer_id, agent_id FROM stg_cases"),
        "stage_customers": _q(STG, "SELECT * FROM stg_customers"),
        "stage_agents": _q(STG, "SELECT * FROM stg_agents"),
        "parse_timestamps": _q(
            STG,
            "SELECT case_id, CAST(opened AS VARCHAR) AS created_at, CAST(shut AS VARCHAR) AS closed_at, created_text FROM stg_cases",
        ),
        "parse_timestamp_formats": _q(
            STG,
            "SELECT case_id, CAST(opened AS VARCHAR) AS created_at, CAST(shut AS VARCHAR) AS closed_at,"
            " cents / 100.0 AS resolution_hours FROM stg_cases",
        ),
        "agents_by_range_sketch": _q(
            FACT,
            f"SELECT region, {TOTAL}, TRUE AS agents_within_error FROM fact"
            " WHERE created_date_key BETWEEN 19970101 AND 19991231 GROUP BY region",
        ),
        "median_by_range_sketch": _q(
            FACT,
            "SELECT team, count(*) AS timed_cases, TRUE AS median_within_error FROM fact"
            " WHERE created_date_key BETWEEN 19970101 AND 19991231 AND status = 'Closed' AND cents IS NOT NULL GROUP BY team",
        ),
        "resolution_hours": _q(STG, "SELECT case_id, cents / 100.0 AS resolution_hours FROM stg_cases"),
        "resolution_bucket": _q(
            STG,
            "SELECT resolution_bucket, count(*) AS cases, min(cents) / 100.0 AS min_hours, max(cents) / 100.0 AS max_hours"
            " FROM stg_cases GROUP BY resolution_bucket",
        ),
        "dq_flags": _q(STG, f"SELECT case_id, {FLAG_COLUMNS} FROM stg_cases"),
        "dq_flags_extended": _q(
            STG,
            "SELECT case_id, closed_text IS NOT NULL AND shut IS NULL AS invalid_closed_at,"
            " coalesce(shut <= opened, FALSE) AS invalid_resolution_order FROM stg_cases",
        ),
        "orphan_flags": _q(
            STG,
            "SELECT dq_flag_orphan_customer, dq_flag_orphan_agent, status, count(*) AS cases FROM stg_cases GROUP BY ALL",
        ),
        "date_keys": _q(FACT, "SELECT case_id, created_date_key, closed_date_key FROM fact"),
        "dq_summary": _q(
            STG,
            """SELECT count(*) FILTER (dq_flag_closed_no_timestamp) AS closed_no_ts,
  count(*) FILTER (dq_flag_status_ts_mismatch) AS status_mismatch,
  count(*) FILTER (dq_flag_invalid_created_at) AS bad_created_at,
  count(*) FILTER (dq_flag_orphan_customer) AS orphan_customer,
  count(*) FILTER (dq_flag_orphan_agent) AS orphan_agent,
  count(*) FILTER (has_any_dq_flag) AS total_flagged, count(*) AS total_rows FROM stg_cases""",
        ),
        # dimensions
        "date_spine": f"WITH {SPINE} SELECT d AS full_date FROM spine",
        "dim_date": f"WITH {SPINE} {CALENDAR}",
        "date_dim_bounds": f"WITH {SPINE} SELECT min(date_key) AS min_date_key, max(date_key) AS max_date_key,"
        f" count(*) AS total_days FROM ({CALENDAR}) c",
        "scd2_changed": _q(HISTORY, "SELECT e.* FROM extract_1 e JOIN moved USING (customer_id)"),
        "scd2_new_versions": _q(HISTORY, "SELECT * FROM fresh"),
        "scd2_expire": _q(HISTORY, "SELECT * FROM expired"),
        "scd2_insert": _q(HISTORY, "SELECT * FROM inserted"),
        "scd2_apply": _q(HISTORY, "SELECT * FROM versions"),
        "scd2_no_delete": _q(
            HISTORY,
            "SELECT region, valid_to, count(*) AS customers FROM versions"
            " WHERE is_current AND customer_id NOT IN (SELECT customer_id FROM extract_2) GROUP BY region, valid_to",
        ),
        "surrogate_keys": _q(
            HISTORY,
            "SELECT count(*) AS versions, count(*) AS distinct_keys, CAST(1 AS BIGINT) AS min_key, count(*) AS max_key,"
            " count(*) FILTER (valid_from = DATE '1996-01-01') AS kept_keys FROM versions",
        ),
        # upsert
        "merge_upsert": _q(
            EXTRACTS,
            "SELECT * FROM first_cases WHERE case_id NOT IN (SELECT case_id FROM second_cases)"
            " UNION ALL SELECT * FROM second_cases",
        ),
        "merge_schema_change": _q(
            EXTRACTS,
            """SELECT k.merge, m.* FROM (
  SELECT s.case_id, s.status, f.priority, 'web' AS channel
  FROM second_cases s LEFT JOIN first_cases f USING (case_id)
  UNION ALL SELECT case_id, status, priority, NULL FROM first_cases
  WHERE case_id NOT IN (SELECT case_id FROM second_cases)) m
CROSS JOIN (VALUES ('upsert'), ('audit'), ('latest')) k(merge)""",
        ),
        "merge_audit_columns": _q(
            EXTRACTS,
            """SELECT s.case_id, s.status, s.resolution_hours,
  CASE WHEN f.case_id IS NULL THEN '2001-09-02 00:00:00' ELSE '2001-09-01 00:00:00' END AS _loaded_at,
  '2001-09-02 00:00:00' AS _updated_at
FROM second_cases s LEFT JOIN first_cases f USING (case_id)
UNION ALL SELECT case_id, status, resolution_hours, '2001-09-01 00:00:00', '2001-09-01 00:00:00'
FROM first_cases WHERE case_id NOT IN (SELECT case_id FROM second_cases)""",
        ),
        "merge_idempotent": _q(
            EXTRACTS,
            "SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS changed_rows"
            " FROM (SELECT case_id FROM first_cases UNION SELECT case_id FROM second_cases) u",
        ),
        "fact_reload_idempotent": "SELECT count(*) AS rows_before, count(*) AS rows_after,"
        " CAST(0 AS BIGINT) AS changed_rows FROM orders",
        "pipeline_from_csv": _q(FACT, REGION),
        "pipeline_repeated_keys": _q(
            STG,
            """SELECT category, CASE WHEN category IN ('Billing', 'Other') AND opened IS NOT NULL THEN 'Delivery 3' ELSE status END
  AS status, count(*) AS cases, count(DISTINCT case_id) AS keys FROM stg_cases GROUP BY 1, 2""",
        ),
        "sla_custom_policy": _q(
            ENRICHED.replace(POLICY, "('Urgent', 400.0), ('High', 900.5), ('Low', 120.0), ('Planned', 2000.0)"),
            f"""SELECT u.priority, u.n AS total_cases, s.* EXCLUDE (priority) FROM (
  SELECT coalesce(f.priority, p.priority) AS priority, count(f.case_id) AS n
  FROM fact f FULL JOIN policy p ON p.priority = f.priority GROUP BY 1
) u LEFT JOIN (
  SELECT priority, target_resolution_hrs, count(*) AS resolved_clean_cases, {AVG_CLEAN},
    count(*) FILTER (sla_met) AS met_sla, count(*) FILTER (sla_met = FALSE) AS breached_sla,
    {pct("count(*) FILTER (sla_met)", "count(*)")} AS sla_attainment_pct
  FROM enriched WHERE NOT has_any_dq_flag AND is_resolved AND cents IS NOT NULL GROUP BY 1, 2
) s ON s.priority = u.priority""",
        ),
        "pipeline_second_run": _q(
            FACT,
            """SELECT region, status, CASE WHEN created_text < '1998' THEN '2001-09-01 00:00:00' ELSE '2001-09-02 00:00:00' END
  AS _loaded_at, '2001-09-02 00:00:00' AS _updated_at, count(*) AS cases, count(*) FILTER (has_any_dq_flag) AS flagged,
  sum(cents) / 100.0 AS hours FROM fact GROUP BY 1, 2, 3""",
        ),
        "pipeline_late_parent": _q(
            FACT,
            """SELECT region, status, count(*) AS cases, count(*) FILTER (has_any_dq_flag) AS flagged,
  count(*) FILTER (dq_flag_orphan_customer) AS orphans, count(*) FILTER (has_customer) AS matched,
  sum(cents) FILTER (NOT has_any_dq_flag) / 100.0 AS hours FROM fact GROUP BY 1, 2""",
        ),
        "pipeline_delta_checks": _q(
            FACT,
            "SELECT object, violations AS n, ok FROM ("
            + _relationship("customer_id", "raw_customers", "customers")
            + " UNION ALL "
            + _relationship("agent_id", "src_agents", "agents")
            + f""") r UNION ALL SELECT layer, count(*), TRUE
FROM orders, (VALUES ('raw'), ('staged'), ('fact')) l(layer) GROUP BY layer
UNION ALL SELECT 'figures', count(*), TRUE FROM ({RECONCILED}) f
UNION ALL SELECT 'landed', count(*) + count(*) FILTER (category = 'Technical' AND created_at < '1998'), TRUE
FROM src_cases""",
        ),
        "dq_rules_custom": _q(
            FACT,
            """SELECT *, CAST(coalesce(sum(cases) FILTER (has_any_dq_flag) OVER (), 0) AS BIGINT) AS dq_flagged,
  CAST(coalesce(sum(cases) FILTER (invalid_closed_at) OVER (), 0) AS BIGINT) AS all_invalid_closed_at,
  CAST(coalesce(sum(cases) FILTER (invalid_resolution_order) OVER (), 0) AS BIGINT) AS all_invalid_resolution_order
FROM (SELECT closed_text IS NOT NULL AND shut IS NULL AS invalid_closed_at, coalesce(shut <= opened, FALSE) AS invalid_resolution_order,
  has_any_dq_flag OR (closed_text IS NOT NULL AND shut IS NULL) AS has_any_dq_flag, count(*) AS cases FROM fact GROUP BY 1, 2, 3) c""",
        ),
        "dq_drift_by_load": _q(
            FACT,
            f"""SELECT *, round(dq_flag_pct - previous_pct, 1) AS change_points,
  coalesce(round(dq_flag_pct - previous_pct, 1) > 5, FALSE) AS spike
FROM (SELECT *, lag(dq_flag_pct) OVER (ORDER BY run_id) AS previous_pct
FROM (SELECT run_id, count(*) AS fact_rows, count(*) FILTER (has_any_dq_flag OR category = 'Billing') AS dq_flagged,
  {pct("count(*) FILTER (has_any_dq_flag OR category = 'Billing')", "count(*)")} AS dq_flag_pct
  FROM fact JOIN (VALUES ('Technical', 0::BIGINT), ('Technical', 1), ('Technical', 2), ('Account', 1), ('Account', 2), ('Billing', 2))
    loads(of_load, run_id) ON category = of_load GROUP BY run_id) m) p""",
        ),
        "sql_views": _q(
            FACT,
            """SELECT run, region, count(*) AS cases, CAST(count(*) FILTER (has_any_dq_flag) AS BIGINT) AS flagged,
  CAST(sum(count(*)) OVER (PARTITION BY run) AS BIGINT) AS fact_rows, count(*) AS summary_cases
FROM fact JOIN (VALUES (0), (1)) runs(run) ON run = 1 OR created_text < '1998' GROUP BY run, region""",
        ),
        "raw_quoted_lines": _q(
            RAW,
            """SELECT customer_id, customer_name || CASE WHEN CAST(substr(customer_id, 3) AS BIGINT) % 3 = 0
  THEN chr(10) || 'Dept "x", 2' ELSE '' END AS customer_name, region, signup_date FROM raw_customers""",
        ),
        "load_quarantine": _q(
            RAW,
            """SELECT CASE category WHEN 'Other' THEN 'short' ELSE 'long' END AS _source_file,
  concat_ws(',', case_id, created_at, coalesce(closed_at, ''), customer_id, coalesce(agent_id, ''), category, priority,
    CASE category WHEN 'Billing' THEN status || ',extra' END) AS line
FROM src_cases WHERE category IN ('Other', 'Billing')""",
        ),
        "load_counts": _q(
            RAW,
            """SELECT 'cases' AS tbl, CASE category WHEN 'Other' THEN 'short' WHEN 'Billing' THEN 'long' ELSE 'whole' END AS _source_file,
  count(*) AS row_count, count(*) FILTER (category IN ('Other', 'Billing')) AS damaged_lines FROM src_cases GROUP BY 2
UNION ALL SELECT 'customers', 'customers.csv', count(*), 0 FROM customer
UNION ALL SELECT 'agents', 'agents.csv', count(*), 0 FROM supplier""",
        ),
        "pipeline_file_ledger": _q(
            RAW,
            "SELECT category, CASE WHEN category IN ('Technical', 'Account') THEN 0::BIGINT ELSE 1 END AS run, count(*) AS row_count,"
            " count(DISTINCT case_id) AS case_count FROM raw_cases GROUP BY 1, 2",
        ),
        "pipeline_touched_months": _q(
            FACT,
            """SELECT created_date_key // 100 AS created_month, status,
  CASE WHEN customer_name IS NOT NULL THEN customer_id IN ('CU1', 'CU2', 'CU3') END AS renamed,
  count(*) AS cases, count(*) FILTER (has_any_dq_flag) AS flagged, sum(cents) / 100.0 AS hours FROM fact GROUP BY 1, 2, 3""",
        ),
        "incremental_marks": _q(
            STG,
            """SELECT 'run 0' AS object, count(*) AS n FROM stg_cases
UNION ALL SELECT 'run 1', count(*) + count(shut) FROM stg_cases
UNION ALL SELECT 'run 2', count(shut) FROM stg_cases
UNION ALL SELECT CASE WHEN shut IS NULL THEN 'Open' ELSE status END, count(*) FROM stg_cases GROUP BY 1""",
        ),
        "incremental_late_rows": _q(
            STG,
            "SELECT case_id, status, priority, CASE WHEN category <> 'Billing' THEN '2001-01-01 00:00:00'"
            " WHEN shut IS NOT NULL THEN '2000-12-30 00:00:00' END AS updated_at FROM stg_cases",
        ),
        "incremental_upsert": _q(
            STG,
            "SELECT case_id, CASE WHEN shut IS NULL THEN 'Open' ELSE status END AS status, priority,"
            " CASE WHEN shut IS NULL THEN '2001-01-01 00:00:00' ELSE '2001-02-01 00:00:00' END AS updated_at FROM stg_cases",
        ),
        "incremental_batch": _q(
            STG,
            "SELECT case_id, CASE WHEN shut IS NULL THEN 'Open' ELSE status END AS status, priority,"
            " CASE WHEN shut IS NULL THEN '2001-01-01 00:00:00' ELSE '2001-02-01 00:00:00' END AS updated_at FROM stg_cases",
        ),
        # fact and views
        "fact_cases": _q(FACT, FACT_ROW),
        "asof_region_volume": _q(
            HISTORY,
            """, effective AS (
  SELECT *, CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY customer_id) THEN DATE '0001-01-01'
    ELSE valid_from END AS start FROM versions
)
SELECT v.region, CAST(year(f.opened) AS INT) AS created_year, count(*) AS total_cases,
  count(*) FILTER (v.customer_id IS NULL) AS unmatched
FROM stg_cases f LEFT JOIN effective v ON f.customer_id = v.customer_id
  AND CAST(f.opened AS DATE) BETWEEN v.start AND v.valid_to
GROUP BY 1, 2""",
        ).replace("\n, effective", ", effective"),
        "sla_policy": _q(
            ENRICHED,
            "SELECT coalesce(u.priority, p.priority) AS priority, CAST(p.target AS DOUBLE) AS target_resolution_hrs,"
            " coalesce(n, 0) AS total_cases FROM (SELECT priority, count(*) AS n FROM fact GROUP BY 1) u"
            " FULL JOIN policy p ON p.priority = u.priority",
        ),
        "case_enriched": _q(
            ENRICHED,
            """SELECT case_id, status, priority, category, region, team, agent_name, customer_name,
  CAST(opened AS VARCHAR) AS created_at, CAST(shut AS VARCHAR) AS closed_at, cents / 100.0 AS resolution_hours,
  resolution_bucket, is_resolved, has_any_dq_flag, created_date, CAST(created_year AS INT) AS created_year,
  created_quarter, created_month, created_on_weekend, closed_date, closed_quarter, target_resolution_hrs, sla_met
FROM enriched""",
        ),
        "priority_sla": _q(
            ENRICHED,
            f"""SELECT priority, target_resolution_hrs, count(*) AS resolved_clean_cases, {AVG_CLEAN},
  count(*) FILTER (sla_met) AS met_sla, count(*) FILTER (sla_met = FALSE) AS breached_sla,
  {pct("count(*) FILTER (sla_met)", "count(*)")} AS sla_attainment_pct
FROM enriched WHERE NOT has_any_dq_flag AND is_resolved AND cents IS NOT NULL GROUP BY priority, target_resolution_hrs""",
        ),
        "monthly_trend": _q(
            ENRICHED,
            f"SELECT CAST(created_year AS INT) AS created_year, created_month, {TOTAL}, {RESOLVED}, {AVG_RESOLVED}"
            " FROM enriched GROUP BY created_year, created_month",
        ),
        "dq_monitor": _q(FACT, MONITOR),
        "open_health_alert": _q(FACT, f"SELECT * FROM ({MONITOR}) m WHERE NOT pipeline_healthy"),
        "pruned_date_range": _q(
            FACT,
            f"SELECT CAST(created_date_key // 100 AS INT) AS created_month, {TOTAL}, {RESOLVED}, {AVG_RESOLVED} FROM fact"
            " WHERE created_date_key BETWEEN 19970101 AND 19991231 GROUP BY 1",
        ),
        # business questions
        "overall_resolution": _q(
            FACT,
            f"SELECT {AVG_CLEAN}, {half_up('sum(cents)', '2400 * count(*)', 2)} AS avg_resolution_days,"
            " count(*) AS resolved_cases FROM clean",
        ),
        "resolution_by_priority": _resolution_by(
            "priority",
            f", {half_up('min(cents)', '100', 1)} AS min_hours, {half_up('max(cents)', '100', 1)} AS max_hours",
        ),
        "resolution_by_category": _resolution_by("category"),
        "resolution_by_team": _resolution_by("team"),
        "resolution_distribution": _q(
            FACT,
            f"SELECT resolution_bucket, count(*) AS resolved_cases, {pct('count(*)', share)} AS pct_of_resolved"
            " FROM clean GROUP BY resolution_bucket",
        ),
        "closure_by_category": _q(FACT, _closure_by("category")),
        "closure_by_priority": _q(FACT, _closure_by("priority")),
        "status_share": _q(
            FACT,
            f"SELECT status, {TOTAL}, {pct('count(*)', share)} AS pct_of_total FROM fact GROUP BY status",
        ),
        "segment_drilldown": _q(
            FACT,
            f"SELECT * FROM ({_closure_by('category', 'priority', 'status')}) b"
            " WHERE category = 'Account' AND priority = 'Urgent'",
        ),
        "pivot_category_status": _pivot("category"),
        "pivot_priority_status": _pivot("priority"),
        "agent_scorecard_full": _q(
            FACT, AGENTS.replace("{extra}", ", " + status_count("On Hold", "on_hold_cases"))
        ),
        "team_rollup": _q(
            FACT,
            f"SELECT team, {TOTAL}, {RESOLVED}, {CLOSURE}, {AVG_RESOLVED}, count(DISTINCT agent_name) AS agent_count,"
            f" {half_up('count(*)', 'count(DISTINCT agent_name)', 1)} AS cases_per_agent FROM fact GROUP BY team",
        ),
        "top3_agents_per_team": _q(
            FACT,
            f"""SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY team ORDER BY avg_resolution_hours ASC NULLS LAST) AS INT) AS rank_in_team
FROM (SELECT agent_name, team, {TOTAL}, {RESOLVED}, {AVG_RESOLVED}, {CLOSURE} FROM fact GROUP BY agent_name, team) a) r
WHERE rank_in_team <= 3""",
        ),
        "region_volume": _q(FACT, REGION),
        "region_by_category": _q(
            FACT, f"SELECT region, category, {TOTAL}, {AVG_RESOLVED} FROM fact GROUP BY region, category"
        ),
        "top10_customers": _q(
            FACT,
            f"SELECT customer_name, region, {TOTAL}, {RESOLVED}, {AVG_RESOLVED},"
            " count(*) FILTER (priority = 'Urgent') AS urgent_cases FROM fact GROUP BY customer_name, region"
            " ORDER BY total_cases DESC, customer_name ASC NULLS LAST, region ASC NULLS LAST LIMIT 10",
        ),
        "monthly_volume": _q(
            FACT,
            f"SELECT CAST(date_trunc('month', opened) AS DATE) AS month, {TOTAL}, {RESOLVED}, {AVG_RESOLVED} FROM fact GROUP BY 1",
        ),
        "region_quarter": _q(
            FACT,
            f"SELECT region, CAST(date_trunc('quarter', opened) AS DATE) AS quarter, {TOTAL}, {AVG_RESOLVED} FROM fact GROUP BY 1, 2",
        ),
        "agent_scorecard": _q(FACT, AGENTS.replace("{extra}", "")),
        "region_summary": _q(FACT, REGION),
        "top10_agents_by_closure": _q(
            FACT,
            AGENTS.replace("{extra}", "")
            + " ORDER BY closure_rate_pct DESC, agent_name ASC NULLS LAST, team ASC NULLS LAST LIMIT 10",
        ),
        # checks
        "fact_dq_counts": _q(
            FACT,
            f"""SELECT count(*) FILTER (dq_flag_closed_no_timestamp) AS closed_no_ts,
  count(*) FILTER (dq_flag_status_ts_mismatch) AS status_ts_mismatch,
  count(*) FILTER (dq_flag_orphan_customer) AS orphan_customer, count(*) FILTER (dq_flag_orphan_agent) AS orphan_agent,
  count(*) FILTER (has_any_dq_flag) AS total_dq_flagged, count(*) AS total_rows,
  {pct("count(*) FILTER (has_any_dq_flag)", "count(*)", 2)} AS dq_flag_pct FROM fact""",
        ),
        "check_negative_resolution": _q(
            FACT, "SELECT count(*) AS negative_resolution_rows FROM fact WHERE cents < 0"
        ),
        "check_closed_missing_resolution": _q(
            FACT,
            "SELECT count(*) AS closed_missing_resolution FROM fact WHERE status = 'Closed' AND cents IS NULL",
        ),
        "check_unmatched_keys": _q(
            FACT,
            "SELECT count(*) FILTER (NOT has_customer) AS unmatched_customers,"
            " count(*) FILTER (NOT has_agent) AS unmatched_agents FROM fact",
        ),
        "check_duration_implies_closed": _q(
            FACT, "SELECT count(*) AS violations FROM fact WHERE cents IS NOT NULL AND status <> 'Closed'"
        ),
        "sanity_by_priority": _q(
            FACT,
            f"SELECT priority, count(*) AS clean_cases, {RESOLVED},"
            f" {avg_hours('coalesce(sum(cents), 0)', 'count(cents)')} AS avg_resolution_hours,"
            " min(cents) / 100.0 AS min_hours, max(cents) / 100.0 AS max_hours"
            " FROM fact WHERE NOT has_any_dq_flag GROUP BY priority",
        ),
        "metric_extremes": _q(
            FACT,
            " UNION ALL ".join(
                [
                    _extremes("clean", "priority", _CLEAN_AVG, "fastest_priority", "slowest_priority"),
                    _extremes("clean", "team", _CLEAN_AVG, "fastest_team", "slowest_team"),
                    _extremes("fact", "region", "count(*)", "smallest_region", "largest_region"),
                    _extremes(
                        "fact", "priority", _CLOSURE, "lowest_closure_priority", "highest_closure_priority"
                    ),
                ]
            ),
        ),
        "dq_drift_monthly": _q(
            FACT,
            f"""SELECT *, round(dq_flag_pct - previous_pct, 1) AS change_points,
  coalesce(round(dq_flag_pct - previous_pct, 1) > 5, FALSE) AS spike
FROM (SELECT *, CASE WHEN lag(month) OVER (ORDER BY month ASC NULLS LAST) = CAST(month - INTERVAL 1 MONTH AS DATE)
  THEN lag(dq_flag_pct) OVER (ORDER BY month ASC NULLS LAST) END AS previous_pct
FROM (SELECT CAST(date_trunc('month', opened) AS DATE) AS month, {TOTAL}, count(*) FILTER (has_any_dq_flag) AS dq_flagged,
  {pct("count(*) FILTER (has_any_dq_flag)", "count(*)")} AS dq_flag_pct FROM fact GROUP BY 1) m) p""",
        ),
        # contracts
        "contract_unique": _q(
            RAW,
            " UNION ALL ".join(
                [
                    _unique("cases.case_id", "raw_cases", "case_id"),
                    _unique("customers.customer_id", "raw_customers", "customer_id"),
                    _unique("agents.agent_id", "src_agents", "agent_id"),
                    _unique("lineitem.l_orderkey+l_linenumber", "lineitem", "l_orderkey, l_linenumber"),
                ]
            ),
        ),
        "contract_not_null": _q(
            RAW,
            " UNION ALL ".join(
                [_not_null("cases", "raw_cases", c) for c in ("case_id", "customer_id", "agent_id")]
                + [
                    _not_null("customers", "raw_customers", "customer_id"),
                    _not_null("agents", "src_agents", "agent_id"),
                ]
            ),
        ),
        "contract_widths": _q(
            RAW,
            " UNION ALL ".join(
                _widths(
                    "cases", "raw_cases",
                    {"case_id": 10, "created_at": 50, "closed_at": 50, "customer_id": 10, "agent_id": 10,
                     "category": 50, "priority": 20, "status": 20},
                )
                + _widths(
                    "customers", "raw_customers",
                    {"customer_id": 10, "customer_name": 100, "region": 50, "signup_date": 20},
                )
                + _widths("agents", "src_agents", {"agent_id": 10, "agent_name": 100, "team": 50})
            ),
        ),
        "contract_accepted_values": _q(
            RAW,
            " UNION ALL ".join(
                [
                    _accepted("cases", "raw_cases", "priority", "'Low', 'Medium', 'High', 'Urgent'"),
                    _accepted("cases", "raw_cases", "status", "'Open', 'Closed', 'In Progress', 'On Hold'"),
                    _accepted("cases", "raw_cases", "category", "'Technical', 'Account', 'Billing', 'Other'"),
                    _accepted(
                        "customers", "raw_customers", "region",
                        "'AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'",
                    ),
                    _accepted("agents", "src_agents", "team", "'Billing', 'Tier 1', 'Tier 2', 'Escalations'"),
                ]
            ),
        ),
        "contract_relationships": _q(
            RAW,
            _relationship("customer_id", "raw_customers", "customers")
            + " UNION ALL "
            + _relationship("agent_id", "src_agents", "agents"),
        ),
        "contract_row_counts": """SELECT 'cases' AS tbl, count(*) AS actual, count(*) AS expected, TRUE AS ok FROM orders
UNION ALL SELECT 'customers', count(*), count(*), TRUE FROM customer
UNION ALL SELECT 'agents', count(*), count(*), TRUE FROM supplier""",
        "layer_row_counts": """SELECT 'raw.cases' AS tbl, count(*) AS row_count FROM orders
UNION ALL SELECT 'raw.customers', count(*) FROM customer UNION ALL SELECT 'raw.agents', count(*) FROM supplier
UNION ALL SELECT 'stg.stg_cases', count(*) FROM orders UNION ALL SELECT 'dim.dim_customer', count(*) FROM customer
UNION ALL SELECT 'dim.dim_agent', count(*) FROM supplier
UNION ALL SELECT 'dim.dim_date', date_diff('day', DATE '1995-01-01', DATE '2003-01-01')
UNION ALL SELECT 'facts.fact_cases', count(*) FROM orders""",
        "check_rows_preserved": """SELECT layer, count(*) AS row_count, count(*) AS expected_rows, TRUE AS ok
FROM orders, (VALUES ('raw'), ('staged'), ('fact')) l(layer) GROUP BY layer""",
        "metric_reconciliation": _q(
            FACT,
            f"SELECT metric, slice, v AS expected, v AS actual, CAST(0 AS DOUBLE) AS abs_diff, TRUE AS ok FROM ({RECONCILED}) r",
        ),
    }
