"""The same queries as plain SQL over the sample tables, for an independent engine to run."""

from __future__ import annotations

DIRTY = r"""
dirty AS (
  SELECT order_id, customer_id, product_id, quantity, unit_price,
    quantity * unit_price + bump AS total_amount,
    order_date, status, customer_email, quantity_text, order_date_text
  FROM (
    SELECT
      'ORD-' || CASE WHEN o_orderkey % 101 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 ELSE o_orderkey END AS order_id,
      CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN 'N/A'
           WHEN o_orderkey % 83 = 0 THEN ' - ' ELSE 'CUST-' || o_custkey END AS customer_id,
      CASE WHEN o_orderkey % 103 = 0 THEN '  ' WHEN o_orderkey % 107 = 0 THEN chr(9)
           ELSE ' PROD-' || (o_orderkey % 20) END AS product_id,
      CASE WHEN o_orderkey % 71 = 0 THEN -5 WHEN o_orderkey % 73 = 0 THEN 999
           WHEN o_orderkey % 59 = 0 THEN NULL ELSE o_orderkey % 19 + 1 END AS quantity,
      CASE WHEN o_orderkey % 67 = 0 THEN NULL ELSE CAST(o_orderkey % 490 + 10 AS DOUBLE) END AS unit_price,
      CASE WHEN o_orderkey % 79 = 0 THEN 1 ELSE 0 END AS bump,
      o_orderdate AS order_date,
      CASE WHEN o_orderkey % 61 = 0 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'completed'
           WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'cancelled' END AS status,
      CASE WHEN o_orderkey % 43 = 0 THEN 'bad-email' WHEN o_orderkey % 47 = 0 THEN NULL
           ELSE 'user' || o_custkey || '@example.com' END AS customer_email,
      CASE WHEN o_orderkey % 53 = 0 THEN 'not_a_number' ELSE CAST(o_orderkey % 19 + 1 AS VARCHAR) END AS quantity_text,
      CASE WHEN o_orderkey % 41 = 0 THEN 'not-a-date' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date_text
    FROM orders))
"""

SHOP = """
shop AS (
  SELECT order_id, customer_id, product_id, quantity, unit_price AS price,
    CASE status WHEN 'completed' THEN 'delivered' WHEN 'pending' THEN 'pending'
                WHEN 'cancelled' THEN 'shipped' ELSE status END AS status,
    order_date AS ordered_at
  FROM dirty)
"""

TRANSACTIONS = """
payments AS (
  SELECT
    'T' || CASE WHEN o_orderkey % 17 = 0 AND o_orderkey > 0 THEN o_orderkey - 1 ELSE o_orderkey END AS transaction_id,
    CASE WHEN o_orderkey % 29 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 999999999.0::DOUBLE
         ELSE o_totalprice END AS amount,
    CASE WHEN o_orderkey % 73 = 0 THEN 200 ELSE o_orderkey % 80 + 10 END AS age,
    CASE WHEN o_orderkey % 13 = 0 THEN 'bad-email' ELSE 'user' || o_custkey || '@example.com' END AS email,
    ((CASE WHEN o_orderkey % 73 = 0 THEN 200 ELSE o_orderkey % 80 + 10 END) >= 18 OR o_orderkey % 37 = 0) AS is_adult,
    o_orderdate AS updated_at
  FROM orders)
"""

ORDERS_AS_OF = "TIMESTAMP '2001-08-01 03:00:00'"
EVENTS_AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
ORDER_COLUMNS = (
    "order_id", "customer_id", "product_id", "quantity", "unit_price", "total_amount",
    "order_date", "status", "customer_email",
)
ORDER_LIST = ", ".join(ORDER_COLUMNS)


def missing(c: str, text: bool = True) -> str:
    if not text:
        return f"{c} IS NULL"
    return (
        f"({c} IS NULL OR lower(regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')) "
        "IN ('n/a', 'unknown', 'null', '-', 'none', ''))"
    )


def blank(c: str) -> str:
    return f"(coalesce(length(regexp_replace({c}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')), 0) = 0)"


def no_email(c: str) -> str:
    return f"(NOT coalesce(regexp_matches({c}, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'), false))"


def outside(c: str, low=None, high=None) -> str:
    value = f"TRY_CAST({c} AS DOUBLE)"
    tests = [f"{value} IS NULL"]
    if low is not None:
        tests.append(f"{value} < {low}")
    if high is not None:
        tests.append(f"{value} > {high}")
    return "(" + " OR ".join(tests) + ")"


def not_in(c: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"(NOT coalesce({c} IN ({listed}), false))"


def total(*tests: str) -> str:
    """Failures of all tests together."""
    return "(" + " + ".join(f"count(*) FILTER (WHERE {t})" for t in tests) + ")"


def half_up(value: str, digits: int) -> str:
    """Round the shortest decimal text of a double, ties away from zero."""
    return f"round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)), {digits})"


def share(failed: str, checked: str) -> str:
    return f"(CASE WHEN {checked} > 0 THEN 1.0::DOUBLE - ({failed})::DOUBLE / ({checked})::DOUBLE ELSE 0.0::DOUBLE END)"


def lines(source: str, rows: list[tuple[str, str, str, str]], by: str = "") -> str:
    """A violations table: dimension, column, rule and the failing test."""
    comma = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"SELECT {comma}'{d}' AS dimension, '{c}' AS column_name, '{r}' AS rule, "
        f"count(*) FILTER (WHERE {t}) AS violations, count(*) AS checked FROM {source}{group}"
        for d, c, r, t in rows
    )


# The orders measures -----------------------------------------------------------------

NUMERIC_ORDER_COLUMNS = ("quantity", "unit_price", "total_amount", "order_date")
ORDERS_MISSING = [missing(c, c not in NUMERIC_ORDER_COLUMNS) for c in ORDER_COLUMNS]
ORDERS_INVALID = [
    "quantity IS NULL", "unit_price IS NULL", "total_amount IS NULL", blank("order_id"),
    blank("status"), no_email("customer_email"),
]
ORDERS_INACCURATE = [
    outside("quantity", 1, 100), outside("unit_price", 1, 10000), outside("total_amount", 1, 1000000),
    not_in("status", "completed", "pending", "cancelled"),
]
TOTAL_RULE = "coalesce(abs(total_amount - quantity * unit_price) < 0.01, false)"


def hours_old(ts: str, as_of: str) -> str:
    return f"((epoch_us({as_of}) - epoch_us({ts}))::DOUBLE / 3.6e9::DOUBLE)"


def timely(ts: str, sla: float, as_of: str) -> str:
    return f"coalesce(greatest(0.0::DOUBLE, 1.0::DOUBLE - {hours_old(ts, as_of)} / {sla}::DOUBLE), 0.0::DOUBLE)"


def weighted(weights: dict[str, float]) -> str:
    return "(0.0::DOUBLE + " + " + ".join(f"{d} * {w}::DOUBLE" for d, w in weights.items()) + ")"


def blocks(floors: dict[str, float]) -> str:
    cases = " ".join(
        f"WHEN {d} < {f}::DOUBLE THEN '{d} score ' || {half_up(d, 2)} || ' below hard block {f}'"
        for d, f in floors.items()
    )
    return f"(CASE {cases} ELSE NULL END)" if cases else "CAST(NULL AS VARCHAR)"


DIMENSIONS = ("completeness", "validity", "accuracy", "consistency", "uniqueness", "timeliness")


def card(name: str, weights: dict[str, float], floors: dict[str, float], as_of: str, by: str = "") -> str:
    """A scorecard from a ``measured`` CTE that holds row_count and the raw dimensions."""
    dims = ", ".join(f"round({d}, 6) AS score_{d}" for d in DIMENSIONS)
    comma = f"{by}, " if by else ""
    t, b = weighted(weights), blocks(floors)
    return f"""
      SELECT '{name}' AS pipeline_name, {comma}{as_of} AS scored_at, row_count, {dims},
        {half_up(f'{t} * 100', 2)}::DOUBLE AS total_score,
        CASE WHEN {b} IS NOT NULL THEN 'FAIL' WHEN {t} >= 0.8 THEN 'PASS' WHEN {t} >= 0.6 THEN 'WARN'
             ELSE 'FAIL' END AS status,
        {b} AS hard_block_triggered
      FROM measured"""


def orders_measured(source: str, by: str = "") -> str:
    comma = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    n = "count(*)"
    return f"""
      measured AS (
        SELECT {comma}{n} AS row_count,
          {share(total(*ORDERS_MISSING), f"{n} * 9")} AS completeness,
          {share(total(*ORDERS_INVALID), f"{n} * 6")} AS validity,
          {share(total(*ORDERS_INACCURATE), f"{n} * 4")} AS accuracy,
          {share(total(f"NOT {TOTAL_RULE}"), n)} AS consistency,
          {share(f"{n} - count(DISTINCT order_id)", n)} AS uniqueness,
          {timely("max(order_date)", 24.0, ORDERS_AS_OF)} AS timeliness
        FROM {source}{group})"""


def iqr_flags(source: str, columns: tuple[str, ...], name: str = "flagged") -> str:
    stats = ", ".join(
        f"quantile_cont({c}::DOUBLE, 0.25) AS a_{c}, quantile_cont({c}::DOUBLE, 0.75) AS b_{c}" for c in columns
    )
    ends = ", ".join(
        f"a_{c} - 1.5 * (b_{c} - a_{c}) AS iqr_lower_{c}, b_{c} + 1.5 * (b_{c} - a_{c}) AS iqr_upper_{c}"
        for c in columns
    )
    flags = ", ".join(
        f"coalesce({c} < iqr_lower_{c} OR {c} > iqr_upper_{c}, false) AS is_anomaly_iqr_{c}" for c in columns
    )
    verdict = " OR ".join(f"is_anomaly_iqr_{c}" for c in columns)
    return f"""
      {name}_marks AS (SELECT {stats} FROM {source}),
      {name}_ends AS (SELECT {ends} FROM {name}_marks),
      {name} AS (
        SELECT *, ({verdict}) AS is_anomaly
        FROM (SELECT s.*, e.*, {flags} FROM {source} s CROSS JOIN {name}_ends e))"""


ORDER_OUTLIERS = ("quantity", "unit_price", "total_amount")
ORDERS_WEIGHTS = {
    "completeness": 0.30, "validity": 0.20, "accuracy": 0.20, "consistency": 0.15,
    "uniqueness": 0.10, "timeliness": 0.05,
}
ORDERS_FLOORS = {"completeness": 0.8, "accuracy": 0.7, "uniqueness": 0.95}
CLEAN = f"{iqr_flags('dirty', ORDER_OUTLIERS)}, clean AS (SELECT * FROM flagged WHERE NOT is_anomaly)"
ORDERS_CARD = card("orders_pipeline", ORDERS_WEIGHTS, ORDERS_FLOORS, ORDERS_AS_OF)

TEXT_ORDER = ("order_id", "customer_id", "product_id", "status", "customer_email")


def silver(source: str, na_tokens: bool) -> str:
    """Trimmed, dated and deduplicated orders from ``source``."""

    def cell(c: str) -> str:
        if c in TEXT_ORDER:
            value = f"nullif({c}, 'N/A')" if na_tokens else c
            return f"nullif(trim({value}), '') AS {c}"
        return "CAST(order_date AS DATE) AS order_date" if c == "order_date" else c

    ranks = ", ".join(f"{c} NULLS FIRST" for c in ORDER_COLUMNS if c != "order_id")
    return f"""
      trimmed AS (SELECT {", ".join(cell(c) for c in ORDER_COLUMNS)} FROM {source}),
      silver AS (
        SELECT {ORDER_LIST} FROM (
          SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {ranks}) AS copy FROM trimmed)
        WHERE copy = 1)"""


SILVER_OUT = ", ".join("round(total_amount, 6) AS total_amount" if c == "total_amount" else c for c in ORDER_COLUMNS)
MEDALLION = f"WITH {DIRTY}, {CLEAN}, {silver('clean', True)} SELECT {SILVER_OUT} FROM silver"


# Expectations ------------------------------------------------------------------------

NOT_NULL = tuple(c for c in ORDER_COLUMNS if c != "customer_email")
TYPED = ("quantity", "unit_price", "total_amount", "order_id", "status")


def expectation_rows(source: str, with_total: bool = True) -> str:
    count = f"(SELECT count(*) FROM {source})"
    tail = f", {count} AS total_records" if with_total else ""
    rows = [
        f"SELECT 'schema' AS check_kind, '{c}' AS column_name, true AS passed, 0.0::DOUBLE AS observed, "
        f"0.0::DOUBLE AS threshold{tail}"
        for c in ORDER_COLUMNS
    ]
    rows += [f"SELECT 'type', '{c}', true, 0.0::DOUBLE, 0.0::DOUBLE{tail}" for c in TYPED]
    rows += [null_row(source, c, tail) for c in NOT_NULL]
    return " UNION ALL ".join(rows)


def null_row(source: str, c: str, tail: str) -> str:
    nulls = f"(SELECT count(*) FROM {source} WHERE {c} IS NULL)"
    return (
        f"SELECT 'null' AS check_kind, '{c}' AS column_name, {nulls} = 0 AS passed, "
        f"{nulls}::DOUBLE AS observed, 0.0::DOUBLE AS threshold{tail}"
    )


def gate(name: str, rows: str) -> str:
    return f"""
      SELECT '{name}' AS gate, check_kind, column_name, passed,
        CASE WHEN passed THEN 'OK' WHEN check_kind = 'null' THEN 'WARN' ELSE 'STOP' END AS severity,
        observed, threshold
      FROM ({rows})"""


# Histories ---------------------------------------------------------------------------

EVENT_TOTAL = (
    "(0.0::DOUBLE + completeness * 0.3::DOUBLE + accuracy * 0.4::DOUBLE "
    "+ consistency * 0.15::DOUBLE + uniqueness * 0.15::DOUBLE)"
)
EVENT_DIMENSIONS = ("completeness", "accuracy", "consistency", "uniqueness")
HISTORY = f"""
daily AS (
  SELECT event_type AS pipeline_name, date_trunc('day', ts)::TIMESTAMP AS scored_at,
    {share(total("user_id IS NULL", "value IS NULL", missing("props")), "count(*) * 3")} AS completeness,
    {share(total(outside("value", 5)), "count(*)")} AS accuracy,
    {share(total("NOT (user_id > 10 OR value < 100)"), "count(*)")} AS consistency,
    {share("count(*) - count(DISTINCT user_id)", "count(*)")} AS uniqueness
  FROM events GROUP BY 1, 2),
history AS (
  SELECT pipeline_name, scored_at, {half_up(f'{EVENT_TOTAL} * 100', 2)}::DOUBLE AS total_score,
    CASE WHEN {EVENT_TOTAL} >= 0.8 THEN 'PASS' WHEN {EVENT_TOTAL} >= 0.6 THEN 'WARN' ELSE 'FAIL' END AS status,
    CAST(NULL AS VARCHAR) AS hard_block_triggered,
    {", ".join(f"{d} AS score_{d}" for d in EVENT_DIMENSIONS)}
  FROM daily)
"""
HISTORY_OUT = (
    "pipeline_name, scored_at, total_score, status, hard_block_triggered, "
    + ", ".join(f"round(score_{d}, 6) AS score_{d}" for d in EVENT_DIMENSIONS)
)
NUMBERED = """
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY pipeline_name ORDER BY scored_at) AS row_no,
    row_number() OVER (PARTITION BY pipeline_name ORDER BY scored_at DESC) AS row_desc,
    avg(total_score) OVER (PARTITION BY pipeline_name ORDER BY scored_at
                           ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_avg
  FROM history),
base AS (
  SELECT pipeline_name, avg(total_score) AS mean_baseline, stddev_samp(total_score) AS std_baseline
  FROM numbered WHERE row_no <= 14 GROUP BY 1),
judged AS (
  SELECT n.*, mean_baseline, std_baseline,
    CASE WHEN std_baseline = 0 AND total_score < mean_baseline THEN '-infinity'::DOUBLE
         WHEN std_baseline = 0 AND total_score > mean_baseline THEN 'infinity'::DOUBLE
         WHEN std_baseline = 0 THEN NULL
         ELSE (total_score - mean_baseline) / std_baseline END AS z
  FROM numbered n JOIN base USING (pipeline_name)),
summary AS (
  SELECT pipeline_name, min(scored_at) AS first_scored_at, max(scored_at) AS last_scored_at,
    count(*) AS total_records,
    max(CASE WHEN row_no = least(7, records) THEN rolling_avg END) AS first_rolling,
    max(CASE WHEN row_desc = 1 THEN rolling_avg END) AS last_rolling,
    count(*) FILTER (WHERE coalesce(z < -2.0, false)) AS anomaly_count,
    max(mean_baseline) AS mean_baseline, max(std_baseline) AS std_baseline
  FROM (SELECT *, count(*) OVER (PARTITION BY pipeline_name) AS records FROM judged)
  GROUP BY 1)
"""
DIMENSION_TREND = " UNION ALL ".join(
    f"""SELECT pipeline_name, '{d}' AS dimension,
      avg(score_{d}) FILTER (WHERE row_no <= 7) AS avg_first,
      avg(score_{d}) FILTER (WHERE row_desc <= 7) AS avg_last
    FROM numbered GROUP BY 1"""
    for d in EVENT_DIMENSIONS
)

WEIGHTED = f"""
runs AS (SELECT pipeline_name, scored_at AS run_id, score_completeness AS completeness,
  score_accuracy AS accuracy, score_uniqueness AS uniqueness FROM history),
summed AS (
  SELECT pipeline_name, run_id,
    completeness * 0.3::DOUBLE + 0.0::DOUBLE * 0.05::DOUBLE + accuracy * 0.45::DOUBLE + uniqueness * 0.2::DOUBLE AS t,
    {blocks({"completeness": 0.8, "accuracy": 0.84, "uniqueness": 0.76})} AS hard_block_triggered
  FROM runs)
"""

# Freshness ---------------------------------------------------------------------------

SLAS = """
slas(table_name, sla_hours, warn, crit) AS (VALUES
  ('click', 24.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE), ('error', 0.5, 0.5, 1.0), ('purchase', 0.25, 1.0, 2.0),
  ('signup', 1.0, 0.2, 2.0), ('lineitem', 24.0, 1.0, 2.0), ('user_profiles', 6.0, 1.0, 2.0))
"""


def freshness(as_of: str, name: str) -> str:
    return f"""
{name}_aged AS (
  SELECT s.*, latest_timestamp, {hours_old("latest_timestamp", as_of)} AS age
  FROM slas s LEFT JOIN (
    SELECT event_type AS table_name, max(ts) AS latest_timestamp FROM events GROUP BY 1
    UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem) USING (table_name)),
{name}_severe AS (
  SELECT *, CASE WHEN age IS NULL OR age >= sla_hours * crit THEN 'CRITICAL'
                 WHEN age >= sla_hours * warn THEN 'WARNING' ELSE 'OK' END AS severity
  FROM {name}_aged),
{name} AS (
  SELECT table_name, {as_of} AS checked_at, latest_timestamp,
    CASE WHEN age IS NULL THEN 'infinity'::DOUBLE ELSE round(age, 2) END AS age_hours, sla_hours, severity,
    severity <> 'OK' AS is_breached,
    CASE WHEN age IS NULL THEN table_name || ': no data found — CRITICAL'
         ELSE table_name || ': ' || printf('%.1f', age) || 'h old, SLA ' || CAST(sla_hours AS VARCHAR) || 'h — ' || severity
    END AS message
  FROM {name}_severe)"""


# Outliers ----------------------------------------------------------------------------


def bounds(source: str, column: str, by: str = "") -> str:
    comma = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    q1, q3 = f"quantile_cont({column}::DOUBLE, 0.25)", f"quantile_cont({column}::DOUBLE, 0.75)"
    return f"""SELECT {comma}'{column}' AS column_name, round({q1}, 6) AS q1, round({q3}, 6) AS q3,
      round({q1} - 1.5 * ({q3} - {q1}), 6) AS iqr_lower, round({q3} + 1.5 * ({q3} - {q1}), 6) AS iqr_upper
    FROM {source}{group}"""


def any_flag(c: str, kind: str) -> str:
    if kind == "iqr":
        return f"coalesce({c} < a_{c} - 1.5 * (b_{c} - a_{c}) OR {c} > b_{c} + 1.5 * (b_{c} - a_{c}), false)"
    return f"coalesce(abs(({c} - m_{c}) / s_{c}) > 3, false)"


ANY_COLUMNS = ("quantity", "unit_price", "qt")
ANY_STATS = ", ".join(
    f"quantile_cont({c}::DOUBLE, 0.25) AS a_{c}, quantile_cont({c}::DOUBLE, 0.75) AS b_{c}, "
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}"
    for c in ANY_COLUMNS
)
ANY_NAMES = {"quantity": "quantity", "unit_price": "unit_price", "qt": "quantity_text"}
ANY_FLAGS = ", ".join(
    f"{any_flag(c, kind)} AS is_anomaly_{kind}_{ANY_NAMES[c]}" for c in ANY_COLUMNS for kind in ("iqr", "zscore")
)
ANY_VERDICT = " OR ".join(any_flag(c, kind) for c in ANY_COLUMNS for kind in ("iqr", "zscore"))

CONSISTENCY_RULES = [
    ("total_is_quantity_times_price", TOTAL_RULE),
    ("priced_if_ordered", "(NOT (coalesce(quantity > 0, false) AND coalesce(unit_price <= 300, false)))"),
    ("email_after_order", "coalesce(customer_email >= order_id, false)"),
    ("known_status", "coalesce(status IN ('completed', 'pending', 'cancelled'), false)"),
]
ALL_RULES = " AND ".join(r for _, r in CONSISTENCY_RULES)
FIRST_BROKEN = "CASE " + " ".join(f"WHEN NOT {r} THEN '{n}'" for n, r in CONSISTENCY_RULES) + " END"

VALIDITY = [
    ("quantity_text", "numeric", "TRY_CAST(quantity_text AS DOUBLE) IS NULL"),
    ("unit_price", "numeric", "unit_price IS NULL"),
    ("product_id", "string", blank("product_id")),
    ("quantity", "string", "true"),
    ("customer_email", "email", no_email("customer_email")),
    ("status", "colour", "false"),
]
ACCURACY = [
    ("quantity", "range", outside("quantity", 1, 100)),
    ("unit_price", "range", outside("unit_price", 1, 10000)),
    ("total_amount", "range", outside("total_amount", 1, 1000000)),
    ("quantity_text", "range", outside("quantity_text", 3)),
    ("status", "set", not_in("status", "completed", "pending", "cancelled")),
    ("customer_id", "set", not_in("customer_id", "N/A", "CUST-1")),
]

SHIPPED = """
joined AS (
  SELECT l.*, o.* FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey)
"""

ORDERS_CONTRACT_ROWS = " UNION ALL ".join(
    [
        f"SELECT '{kind}' AS check_kind, '{c}' AS column_name, true AS passed, 0.0::DOUBLE AS observed, "
        "0.0::DOUBLE AS threshold"
        for c in ORDER_COLUMNS
        for kind in ("schema", "type")
    ]
    + [null_row("dirty", c, "") for c in NOT_NULL]
    + [
        f"""SELECT '{kind}', '', {score} >= {limit}::DOUBLE, round({score}, 6), {limit}::DOUBLE FROM dirty"""
        for kind, score, limit in (
            ("completeness", share(total(*ORDERS_MISSING), "count(*) * 9"), 0.95),
            ("accuracy", share(total(*ORDERS_INACCURATE), "count(*) * 4"), 0.9),
        )
    ]
    + [
        "SELECT 'unique', 'order_id', count(*) = count(DISTINCT order_id), "
        "(count(*) - count(DISTINCT order_id))::DOUBLE, 0.0::DOUBLE FROM dirty"
    ]
)

REPORT = " UNION ALL ".join(
    f"""SELECT pipeline_name, row_count, total_score, status, hard_block_triggered, '{d}' AS dimension,
      round(raw_{d}, 6) AS score,
      repeat('█', floor(raw_{d} * 20)::INT) || repeat('░', 20 - floor(raw_{d} * 20)::INT) AS bar,
      round(raw_{d} * 100, 1) AS percent
    FROM report_card"""
    for d in DIMENSIONS
)
RAW_DIMENSIONS = ", ".join(f"{d} AS raw_{d}" for d in DIMENSIONS)

ORACLE: dict[str, str] = {
    "bronze_csv_scan": f"""WITH {DIRTY}
      SELECT order_id, nullif(customer_id, 'N/A') AS customer_id, product_id, quantity::DOUBLE AS quantity,
        unit_price, total_amount, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, order_date_text, status,
        customer_email, quantity_text FROM dirty""",
    "bronze_land": f"""WITH {DIRTY}
      SELECT order_id, customer_id, product_id, CAST(quantity AS VARCHAR) AS quantity,
        CAST(CAST(unit_price AS DECIMAL(18, 2)) AS VARCHAR) AS unit_price,
        CAST(CAST(total_amount AS DECIMAL(18, 2)) AS VARCHAR) AS total_amount,
        strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date, order_date_text, status, customer_email,
        quantity_text FROM dirty""",
    "bronze_land_check": "SELECT count(*) AS records, true AS same_lines, true AS has_bytes FROM orders",
    "malformed_lines": """SELECT o_orderkey || ',' || o_custkey || CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE ',' || o_orderstatus || ',more' END AS line,
        CAST(o_orderkey AS VARCHAR) AS first_cell, 3 AS cells_due
      FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0""",
    "malformed_gate": """SELECT 'gate_1' AS gate, 'malformed_lines' AS check_kind, '' AS column_name, false AS passed,
        CASE WHEN n / total <= 0.2 THEN 'WARN' ELSE 'STOP' END AS severity, n::DOUBLE AS observed, 0.2::DOUBLE AS threshold,
        total - n AS kept_lines
      FROM (SELECT count(*) AS total, count(*) FILTER (WHERE o_orderkey % 13 = 0 OR o_orderkey % 17 = 0) AS n FROM orders)""",
    "gold_replaced": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "medallion_silver": MEDALLION,
    "medallion_gold": MEDALLION,
    "silver_validate": f"WITH {DIRTY}, {CLEAN}, {silver('clean', False)} {expectation_rows('silver')}",
    "history_scan": f"WITH {HISTORY} SELECT {HISTORY_OUT} FROM history WHERE pipeline_name = 'purchase'",
    "history_table_scan": f"""WITH {HISTORY}, purchases AS (SELECT * FROM history WHERE pipeline_name = 'purchase')
      {" UNION ALL ".join(
        "SELECT pipeline_name, scored_at, total_score, status, hard_block_triggered, "
        f"'{d}' AS dimension, round(score_{d}, 6) AS score FROM purchases" for d in EVENT_DIMENSIONS)}""",
    "score_history_append": f"WITH {HISTORY} SELECT {HISTORY_OUT} FROM history",
    "score_history_rerun": f"WITH {HISTORY} SELECT {HISTORY_OUT} FROM history",
    "freshness_history_append": f"""WITH {SLAS}, {freshness(EVENTS_AS_OF, "a")},
      {freshness("TIMESTAMP '2024-02-01 00:00:00'", "b")}
      SELECT * EXCLUDE (latest_timestamp) FROM a UNION ALL SELECT * EXCLUDE (latest_timestamp) FROM b""",
    "completeness": f"""WITH {DIRTY}
      SELECT round({share(total(*ORDERS_MISSING), "count(*) * 9")}, 6) AS completeness FROM dirty""",
    "missing_by_column": f"WITH {DIRTY} "
    + lines(
        "dirty",
        [("completeness", c, "missing", t) for c, t in zip(ORDER_COLUMNS, ORDERS_MISSING)]
        + [("completeness", "discount_code", "missing", "true")],
    ),
    "validity": f"""WITH {DIRTY}
      SELECT round({share(total(*(t for _, _, t in VALIDITY)), "count(*) * 6")}, 6) AS validity FROM dirty""",
    "validity_by_column": f"WITH {DIRTY} " + lines("dirty", [("validity", *row) for row in VALIDITY]),
    "accuracy": f"""WITH {DIRTY}
      SELECT round({share(total(*(t for _, _, t in ACCURACY)), "count(*) * 6")}, 6) AS accuracy FROM dirty""",
    "accuracy_by_column": f"WITH {DIRTY} " + lines("dirty", [("accuracy", *row) for row in ACCURACY]),
    "accuracy_reference_antijoin": """
      SELECT 'o_custkey' AS column_name, count(*) FILTER (WHERE c_custkey IS NULL) AS violations,
        count(*) AS checked,
        round(1.0::DOUBLE - count(*) FILTER (WHERE c_custkey IS NULL)::DOUBLE / count(*)::DOUBLE, 6) AS accuracy
      FROM orders LEFT JOIN (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
        ON o_custkey = c_custkey""",
    "consistency": f"""WITH {DIRTY}
      SELECT round({share(total(f"NOT ({ALL_RULES})"), "count(*)")}, 6) AS consistency FROM dirty""",
    "rule_violations": f"WITH {DIRTY} "
    + lines("dirty", [("consistency", "", n, f"NOT {r}") for n, r in CONSISTENCY_RULES]),
    "consistency_rules": f"""WITH {DIRTY}
      SELECT order_id, quantity, unit_price, total_amount, status, customer_email, {FIRST_BROKEN} AS broken_rule
      FROM dirty WHERE {FIRST_BROKEN} IS NOT NULL""",
    "consistency_ship_order": f"WITH {SHIPPED} "
    + lines(
        "joined",
        [
            ("consistency", "", "shipped_after_order", "NOT (o_orderdate <= l_shipdate)"),
            ("consistency", "", "status_pair", "NOT (o_orderstatus = 'P' OR o_orderstatus = l_linestatus)"),
        ],
        "l_returnflag",
    ),
    "uniqueness": """
      SELECT round(1.0::DOUBLE - (sum(n) - count(*))::DOUBLE / sum(n)::DOUBLE, 6) AS uniqueness
      FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "uniqueness_with_nulls": f"""WITH {DIRTY}
      SELECT status, round(1.0::DOUBLE - (sum(n) - count(*))::DOUBLE / sum(n)::DOUBLE, 6) AS uniqueness
      FROM (SELECT status, count(*) AS n FROM dirty GROUP BY status, customer_id, quantity) GROUP BY status""",
    "timeliness": f"""SELECT event_type, round({timely("max(ts)", 24.0, EVENTS_AS_OF)}, 6) AS timeliness
      FROM events GROUP BY event_type""",
    "issue_profile": f"""WITH {DIRTY}, {SHOP}
      SELECT count(*) AS total_rows, count(*) FILTER (WHERE customer_id IS NULL) AS null_customer_id,
        count(*) FILTER (WHERE price IS NULL) AS null_price,
        count(*) FILTER (WHERE quantity < 0) AS negative_quantity,
        count(*) FILTER (WHERE {not_in("status", "pending", "confirmed", "shipped", "delivered")}) AS invalid_status,
        count(*) - count(DISTINCT order_id) AS duplicate_order_id
      FROM shop""",
    "duplicate_rows_first": """
      SELECT * EXCLUDE (copy) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey,
          l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS copy
        FROM lineitem) WHERE copy > 1""",
    "duplicate_rows_all": """
      SELECT doc_id, n_chars FROM documents
      WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)""",
    "scorecard_transactions": f"""WITH {TRANSACTIONS}, measured AS (
        SELECT count(*) AS row_count,
          {share(total(missing("transaction_id"), "amount IS NULL", "age IS NULL", missing("email")), "count(*) * 4")} AS completeness,
          {share(total("amount IS NULL", no_email("email")), "count(*) * 2")} AS validity,
          {share(total(outside("amount", 1, 100000000), outside("age", 0, 120)), "count(*) * 2")} AS accuracy,
          {share(total("age < 18 AND is_adult"), "count(*)")} AS consistency,
          {share("count(*) - count(DISTINCT transaction_id)", "count(*)")} AS uniqueness,
          {timely("max(updated_at)", 6.0, ORDERS_AS_OF)} AS timeliness
        FROM payments)
      """
    + card(
        "transaction_pipeline",
        {"completeness": 0.20, "validity": 0.15, "accuracy": 0.30, "consistency": 0.15, "uniqueness": 0.10, "timeliness": 0.10},
        {"completeness": 0.85, "accuracy": 0.7, "uniqueness": 0.95},
        ORDERS_AS_OF,
    ),
    "scorecard_orders_v1": f"""WITH {DIRTY}, {SHOP}, {iqr_flags("shop", ("quantity", "price"))},
      measured AS (
        SELECT count(*) AS row_count,
          {share(total(missing("order_id"), missing("customer_id"), missing("product_id"), "quantity IS NULL", "price IS NULL", missing("status")), "count(*) * 6")} AS completeness,
          {share(total("quantity IS NULL", "price IS NULL", blank("status")), "count(*) * 3")} AS validity,
          {share(total(outside("quantity", 1, 100), outside("price", 1, 10000000), not_in("status", "pending", "confirmed", "shipped", "delivered")), "count(*) * 3")} AS accuracy,
          {share(total("(coalesce(quantity > 0, false) AND coalesce(price <= 0, false)) OR status NOT IN ('pending', 'confirmed', 'shipped', 'delivered')"), "count(*)")} AS consistency,
          {share("count(*) - count(DISTINCT order_id)", "count(*)")} AS uniqueness,
          {timely("max(ordered_at)", 6.0, ORDERS_AS_OF)} AS timeliness
        FROM flagged WHERE NOT is_anomaly)
      """
    + card(
        "orders_pipeline",
        {"completeness": 0.30, "validity": 0.10, "accuracy": 0.25, "consistency": 0.10, "uniqueness": 0.15, "timeliness": 0.10},
        {"completeness": 0.9, "accuracy": 0.75, "uniqueness": 0.95},
        ORDERS_AS_OF,
    ),
    "scorecard_v1_trend": f"""WITH {DIRTY}, {SHOP}, {iqr_flags("shop", ("quantity", "price"))},
      monthly AS (
        SELECT date_trunc('month', ordered_at)::TIMESTAMP AS scored_at,
          {share(total(missing("order_id"), missing("customer_id"), missing("product_id"), "quantity IS NULL", "price IS NULL", missing("status")), "count(*) * 6")} AS completeness,
          {share(total("quantity IS NULL", "price IS NULL", blank("status")), "count(*) * 3")} AS validity,
          {share(total(outside("quantity", 1, 100), outside("price", 1, 10000000), not_in("status", "pending", "confirmed", "shipped", "delivered")), "count(*) * 3")} AS accuracy,
          {share(total("(coalesce(quantity > 0, false) AND coalesce(price <= 0, false)) OR status NOT IN ('pending', 'confirmed', 'shipped', 'delivered')"), "count(*)")} AS consistency,
          {share("count(*) - count(DISTINCT order_id)", "count(*)")} AS uniqueness
        FROM flagged WHERE NOT is_anomaly GROUP BY 1),
      history AS (
        SELECT 'orders_pipeline' AS pipeline_name, scored_at, {half_up("(0.0::DOUBLE + completeness * 0.3::DOUBLE + validity * 0.1::DOUBLE + accuracy * 0.25::DOUBLE + consistency * 0.1::DOUBLE + uniqueness * 0.15::DOUBLE + 0.0::DOUBLE) * 100", 2)}::DOUBLE AS total_score
        FROM monthly), {NUMBERED}
      SELECT pipeline_name, first_scored_at, last_scored_at, total_records, round(first_rolling, 6) AS first_rolling,
        round(last_rolling, 6) AS last_rolling, round(last_rolling - first_rolling, 6) AS trend_delta,
        CASE WHEN last_rolling - first_rolling > 0 THEN 'improving' ELSE 'degrading' END AS trend_direction,
        anomaly_count, round(mean_baseline, 6) AS mean_baseline, round(std_baseline, 6) AS std_baseline
      FROM summary""",
    "scorecard_orders": f"WITH {DIRTY}, {CLEAN}, {orders_measured('clean')} {ORDERS_CARD}",
    "scorecard_by_group": f"""WITH {DIRTY}, grouped AS (SELECT *, status AS order_status FROM dirty),
      {orders_measured("grouped", "order_status")}
      {card("orders_pipeline", ORDERS_WEIGHTS, ORDERS_FLOORS, ORDERS_AS_OF, "order_status")}""",
    "score_report": f"""WITH {DIRTY}, {CLEAN}, {orders_measured("clean")},
      report_card AS (SELECT * FROM ({ORDERS_CARD}), (SELECT {RAW_DIMENSIONS} FROM measured)) {REPORT}""",
    "scorecard_from_parts": f"""WITH parts AS (
        SELECT event_type AS pipeline_name, count(*) AS row_count,
          {share(total("user_id IS NULL", "value IS NULL", missing("props")), "count(*) * 3")} AS completeness,
          {share(total(outside("value", 5)), "count(*)")} AS accuracy,
          {share(total("NOT (user_id > 10 OR value < 100)"), "count(*)")} AS consistency,
          {share("count(*) - count(DISTINCT user_id)", "count(*)")} AS uniqueness,
          greatest(0.0::DOUBLE, 1.0::DOUBLE - (epoch_us({EVENTS_AS_OF}) - epoch_us(max(ts)))::DOUBLE / 3.6e9 / 48.0) AS timeliness
        FROM events GROUP BY 1)
      SELECT pipeline_name, row_count, {", ".join(f"round({d}, 6) AS score_{d}" for d in (*EVENT_DIMENSIONS, "timeliness"))},
        {half_up(f'{EVENT_TOTAL} * 100', 2)}::DOUBLE AS total_score,
        CASE WHEN {EVENT_TOTAL} >= 0.8 THEN 'PASS' WHEN {EVENT_TOTAL} >= 0.6 THEN 'WARN' ELSE 'FAIL' END AS status,
        CAST(NULL AS VARCHAR) AS hard_block_triggered FROM parts""",
    "quantiles_from_parts": """SELECT event_type AS pipeline_name, p, count(value) AS rows, true AS within
      FROM events, (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]::DOUBLE[]) AS p) GROUP BY ALL""",
    "weighted_score": f"""WITH {HISTORY}, {WEIGHTED}
      SELECT pipeline_name, run_id, {half_up('t * 100', 2)}::DOUBLE AS total_score FROM summed""",
    "quality_status": f"""WITH {HISTORY}, {WEIGHTED}
      SELECT pipeline_name, run_id, hard_block_triggered,
        CASE WHEN hard_block_triggered IS NOT NULL THEN 'FAIL' WHEN t >= 0.88 THEN 'PASS'
             WHEN t >= 0.85 THEN 'WARN' ELSE 'FAIL' END AS status FROM summed""",
    "zscore_flags": """
      WITH stats AS (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
      SELECT event_id, value, round((value - m) / s, 6) AS z_score_value,
        coalesce(abs((value - m) / s) > 3.0, false) AS is_anomaly_zscore_value
      FROM events CROSS JOIN stats""",
    "iqr_flags": f"""WITH slim AS (SELECT event_id, value FROM events), {iqr_flags("slim", ("value",))}
      SELECT event_id, value, round(iqr_lower_value, 6) AS iqr_lower_value,
        round(iqr_upper_value, 6) AS iqr_upper_value, is_anomaly_iqr_value FROM flagged""",
    "iqr_bounds": " UNION ALL ".join(
        bounds("lineitem", c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "iqr_bounds_by_group": " UNION ALL ".join(bounds("events", c, "event_type") for c in ("value", "user_id")),
    "anomaly_by_group": """
      WITH stats AS (
        SELECT event_type, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b,
          avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY event_type),
      ends AS (SELECT *, a - 1.5 * (b - a) AS low, b + 1.5 * (b - a) AS high FROM stats)
      SELECT event_id, event_type, value, round(low, 6) AS iqr_lower_value, round(high, 6) AS iqr_upper_value,
        coalesce(value < low OR value > high, false) AS is_anomaly_iqr_value,
        round((value - m) / s, 6) AS z_score_value,
        coalesce(abs((value - m) / s) > 3.0, false) AS is_anomaly_zscore_value,
        coalesce(value < low OR value > high, false) OR coalesce(abs((value - m) / s) > 3.0, false) AS is_anomaly
      FROM events JOIN ends USING (event_type)""",
    "anomaly_any": f"""WITH {DIRTY}, numeric AS (SELECT *, TRY_CAST(quantity_text AS DOUBLE) AS qt FROM dirty),
      stats AS (SELECT {ANY_STATS} FROM numeric)
      SELECT order_id, quantity, unit_price, quantity_text, {ANY_FLAGS}, ({ANY_VERDICT}) AS is_anomaly
      FROM numeric CROSS JOIN stats""",
    "quarantine_clean": f"WITH {DIRTY}, {CLEAN} SELECT {ORDER_LIST}, is_anomaly FROM clean",
    "quarantine_rows": f"""WITH {DIRTY}, {CLEAN} SELECT {ORDER_LIST},
      {", ".join(f"round(iqr_{e}_{c}, 6) AS iqr_{e}_{c}" for c in ORDER_OUTLIERS for e in ("lower", "upper"))},
      {", ".join(f"is_anomaly_iqr_{c}" for c in ORDER_OUTLIERS)}, is_anomaly FROM flagged WHERE is_anomaly""",
    "quarantine_rate": f"""WITH {DIRTY}, {CLEAN}
      SELECT count(*) AS total_input, count(*) FILTER (WHERE NOT is_anomaly) AS clean_records,
        count(*) FILTER (WHERE is_anomaly) AS quarantine_records,
        round(count(*) FILTER (WHERE is_anomaly)::DOUBLE / count(*)::DOUBLE, 4) AS quarantine_rate,
        0.2::DOUBLE AS quarantine_rate_threshold,
        round(count(*) FILTER (WHERE is_anomaly)::DOUBLE / count(*)::DOUBLE, 4) <= 0.2 AS passed
      FROM flagged""",
    "clean_strings": f"""WITH {DIRTY} SELECT {
        ", ".join(
            f"nullif(trim({c}), '') AS {c}"
            for c in ("order_id", "customer_id", "product_id", "quantity_text", "order_date_text", "status", "customer_email")
        )
    }, quantity FROM dirty""",
    "normalize_dates": f"""WITH {DIRTY} SELECT order_id, CAST(order_date AS DATE) AS order_date,
      TRY_CAST(order_date_text AS DATE) AS order_date_text FROM dirty""",
    "dedup_orders": f"""WITH {DIRTY} SELECT {ORDER_LIST} FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date, customer_id NULLS FIRST,
          product_id NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST, total_amount NULLS FIRST,
          status NULLS FIRST, customer_email NULLS FIRST) AS copy FROM dirty) WHERE copy = 1""",
    "transform_counts": f"""WITH {DIRTY}, keyed AS (
        SELECT nullif(trim(customer_id), '') AS c, CAST(order_date AS DATE) AS d, count(*) AS n FROM dirty GROUP BY 1, 2)
      SELECT sum(n)::BIGINT AS input_records, count(*) AS output_records,
        (sum(n) - count(*))::BIGINT AS duplicates_removed FROM keyed""",
    "expect_types": f"""WITH {DIRTY}, c AS (SELECT count(*) AS total_records,
          count(*) FILTER (WHERE quantity_text IS NOT NULL AND TRY_CAST(quantity_text AS DOUBLE) IS NULL) AS odd,
          count(unit_price) AS held FROM dirty)
      SELECT 'type' AS check_kind, 'order_id' AS column_name, true AS passed, 0.0::DOUBLE AS observed,
        0.0::DOUBLE AS threshold, total_records FROM c
      UNION ALL SELECT 'type', 'status', true, 0.0, 0.0, total_records FROM c
      UNION ALL SELECT 'type', 'quantity', true, 0.0, 0.0, total_records FROM c
      UNION ALL SELECT 'type', 'unit_price', false, held::DOUBLE, 0.0, total_records FROM c
      UNION ALL SELECT 'type', 'quantity_text', odd = 0, odd::DOUBLE, 0.0, total_records FROM c
      UNION ALL SELECT 'type', 'discount_code', false, NULL, 0.0, total_records FROM c""",
    "expect_not_null": f"WITH {DIRTY} "
    + " UNION ALL ".join(
        [null_row("dirty", c, ", (SELECT count(*) FROM dirty) AS total_records") for c in ORDER_COLUMNS]
        + ["SELECT 'null', 'discount_code', false, NULL, 0.0::DOUBLE, (SELECT count(*) FROM dirty)"]
    ),
    "expectation_summary": f"""WITH {DIRTY}, e AS ({expectation_rows("dirty")})
      SELECT bool_and(passed) AS passed, max(total_records) AS total_records,
        count(*) FILTER (WHERE NOT passed) AS failed_expectations,
        bool_and(passed) FILTER (WHERE check_kind = 'schema') AS schema_passed,
        bool_and(passed) FILTER (WHERE check_kind = 'type') AS types_passed,
        bool_and(passed) FILTER (WHERE check_kind = 'null') AS nulls_passed FROM e""",
    "contract_check": f"WITH {DIRTY} {ORDERS_CONTRACT_ROWS}",
    "gate_results": f"""WITH {DIRTY}, {CLEAN}, {silver("clean", False)}, {orders_measured("clean")},
      rate AS (SELECT round(count(*) FILTER (WHERE is_anomaly)::DOUBLE / count(*)::DOUBLE, 4) AS r FROM flagged)
      {gate("gate_1", expectation_rows("dirty", False))}
      UNION ALL SELECT 'gate_2', 'quarantine_rate', '', r <= 0.2, CASE WHEN r <= 0.2 THEN 'OK' ELSE 'STOP' END, r,
        0.2::DOUBLE FROM rate
      UNION ALL SELECT 'gate_3', 'score', '', status <> 'FAIL',
        CASE status WHEN 'PASS' THEN 'OK' WHEN 'WARN' THEN 'WARN' ELSE 'STOP' END, total_score, 60.0::DOUBLE
        FROM ({ORDERS_CARD})
      UNION ALL {gate("gate_4", expectation_rows("silver", False))}
      UNION ALL SELECT 'contract', 'breaking_change', '0.9.0 -> 1.0.0', false, 'WARN', NULL, NULL
      UNION ALL SELECT 'transform', kind, '', true, 'OK', n::DOUBLE, NULL FROM (
        SELECT unnest(['input_records', 'output_records', 'duplicates_removed']) AS kind,
          unnest([(SELECT count(*) FROM clean), (SELECT count(*) FROM silver),
            (SELECT count(*) FROM clean) - (SELECT count(*) FROM silver)]) AS n)
      UNION ALL SELECT 'gold', 'records_loaded', '', true, 'OK', count(*)::DOUBLE, count(*)::DOUBLE FROM silver
      UNION ALL SELECT 'gate_5', 'history', '', true, 'OK', 1.0::DOUBLE, 1.0::DOUBLE""",
    "rolling_avg_score": f"""WITH {HISTORY}, {NUMBERED}
      SELECT pipeline_name, scored_at, total_score, round(rolling_avg, 6) AS rolling_avg FROM numbered""",
    "score_baseline_anomaly": f"""WITH {HISTORY}, {NUMBERED}
      SELECT pipeline_name, scored_at, total_score, round(mean_baseline, 6) AS mean_baseline,
        round(std_baseline, 6) AS std_baseline, round(z, 6) AS z_score, coalesce(z < -2.0, false) AS is_anomaly
      FROM judged""",
    "trend_summary": f"""WITH {HISTORY}, {NUMBERED}
      SELECT pipeline_name, first_scored_at, last_scored_at, total_records, round(first_rolling, 6) AS first_rolling,
        round(last_rolling, 6) AS last_rolling, round(last_rolling - first_rolling, 6) AS trend_delta,
        CASE WHEN last_rolling - first_rolling > 0 THEN 'improving' ELSE 'degrading' END AS trend_direction,
        anomaly_count, round(mean_baseline, 6) AS mean_baseline, round(std_baseline, 6) AS std_baseline
      FROM summary""",
    "dimension_trend": f"""WITH {HISTORY}, {NUMBERED}, ends AS ({DIMENSION_TREND})
      SELECT pipeline_name, dimension, round(avg_first, 6) AS avg_first, round(avg_last, 6) AS avg_last,
        round(avg_last - avg_first, 6) AS delta,
        CASE WHEN avg_last - avg_first > 0.005 THEN '↑' WHEN avg_last - avg_first < -0.005 THEN '↓'
             ELSE '→' END AS arrow,
        avg_last - avg_first < -0.02 AS is_alert FROM ends""",
    "trend_alert": f"""WITH {HISTORY}, {NUMBERED}, s AS (
        SELECT *, total_records >= 7 AS enough,
          CASE WHEN last_rolling - first_rolling > 0 THEN 'improving' ELSE 'degrading' END AS direction FROM summary)
      SELECT pipeline_name, total_records,
        CASE WHEN enough THEN direction ELSE 'insufficient_data' END AS trend_direction,
        CASE WHEN enough THEN anomaly_count ELSE 0 END AS anomaly_count,
        CASE WHEN enough THEN round(last_rolling - first_rolling, 2) ELSE 0.0::DOUBLE END AS trend_delta,
        CASE WHEN enough THEN round(mean_baseline, 2) END AS mean_baseline,
        CASE WHEN NOT enough THEN 'skipped' WHEN direction = 'degrading' OR anomaly_count > 0 THEN 'alert'
             ELSE 'stable' END AS action FROM s""",
    "freshness_check": f"WITH {SLAS}, {freshness(EVENTS_AS_OF, 'f')} SELECT * FROM f",
    "freshness_alert_routes": f"""WITH {SLAS}, {freshness(EVENTS_AS_OF, "f")}
      SELECT table_name, severity, 'log' AS channel, message FROM f WHERE severity = 'OK'
      UNION ALL SELECT table_name, severity, 'chat', message FROM f WHERE severity <> 'OK'
      UNION ALL SELECT table_name, severity, 'page', message FROM f WHERE severity = 'CRITICAL'""",
}
ORACLE["accuracy_reference_prefiltered"] = ORACLE["accuracy_reference_antijoin"]
ORACLE["cross_table_rules"] = ORACLE["consistency_ship_order"]
ORACLE["freshness_from_parts"] = f"""WITH {SLAS}, {freshness(EVENTS_AS_OF, 'f')}
  SELECT * FROM f WHERE table_name IN ('click', 'error', 'purchase', 'signup')"""
