"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL states each query from first principles over the driver's tables; the
Spark side is built from the library's operators. Both alias every column the
same way. Exact decimals leave both engines as text. What a faulty cell is worth follows
from the arithmetic that placed the fault, never from parsing its text.
"""

from __future__ import annotations

from ..schema import MART_COLUMNS
from ..schema import ORDER_COLUMNS as COLUMNS
from ..schema import REQUIRED_AT_INGEST as REQUIRED

# Customer sequence, purchases and typed order lines (mirrors sources.testdata).
BASE = """
co AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS order_status,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
         CAST(hour(o_orderdate) AS INTEGER) AS order_hour_of_day,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS order_number,
         lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_date
  FROM orders),
cs AS (
  SELECT order_id, user_id, order_status, order_date, order_dow, order_hour_of_day, order_number,
         CAST(CASE WHEN prev_date IS NULL THEN NULL
                   ELSE least(30, date_diff('day', prev_date, order_date)) END AS INTEGER) AS days_since_prior_order
  FROM co),
pu AS (
  SELECT l.l_orderkey AS order_id, l.l_partkey AS product_id, CAST(l.l_quantity AS INTEGER) AS quantity,
         cs.user_id, cs.order_status, cs.order_number, cs.order_dow, cs.order_hour_of_day,
         cs.days_since_prior_order, cs.order_date,
         CAST(CASE WHEN cs.order_date > min(cs.order_date) OVER (PARTITION BY cs.user_id, l.l_partkey)
                   THEN 1 ELSE 0 END AS INTEGER) AS reordered
  FROM lineitem l JOIN cs ON l.l_orderkey = cs.order_id),
ol AS (
  SELECT pu.order_id, pu.user_id, pu.order_number, pu.order_dow, pu.order_hour_of_day,
         pu.days_since_prior_order, pu.product_id, p.p_name AS product_name, p.p_type AS aisle,
         p.p_brand AS department, pu.quantity, CAST(p.p_retailprice AS DECIMAL(26,6)) AS unit_price,
         pu.reordered, pu.order_date
  FROM pu JOIN part p ON pu.product_id = p.p_partkey),
cl AS (
  SELECT *, CAST(round(quantity * unit_price, 2) AS DECIMAL(33,2)) AS line_revenue,
         CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
         coalesce(reordered, 0) AS is_reordered
  FROM ol
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL AND quantity IS NOT NULL
    AND unit_price IS NOT NULL AND order_date IS NOT NULL AND quantity > 0 AND unit_price >= 0)
"""


def half_up(num: str, den: str, scale: int) -> str:
    """SQL for round(num/den, scale) half away from zero on integers, as decimal text."""
    k = 10**scale
    whole = f"sign({num}) * ((2 * {k} * abs(CAST({num} AS HUGEINT)) + {den}) // (2 * CAST({den} AS HUGEINT)))"
    return f"CAST(CAST({whole} AS DECIMAL(24,0)) * CAST('{1 / k:.{scale}f}' AS DECIMAL({scale},{scale})) AS VARCHAR)"


def cents(expr: str) -> str:
    return f"CAST({expr} * 100 AS HUGEINT)"


def money(expr: str) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(38,2)) AS VARCHAR)"


def with_base(body: str, extra: str = "") -> str:
    ctes = BASE + ("," + extra if extra else "")
    return f"WITH {ctes}\n{body}"


MART_SQL = {
    "order_summary": f"""
SELECT sales_month, order_id, min(user_id) AS user_id, CAST(sum(quantity) AS BIGINT) AS order_items,
       {money('sum(line_revenue)')} AS order_revenue
FROM cl GROUP BY sales_month, order_id""",
    "monthly_sales": f"""
SELECT sales_month, count(*) AS order_count,
       count(DISTINCT user_id) AS customer_count,
       CAST(sum(order_items) AS BIGINT) AS item_count,
       {money('sum(order_revenue)')} AS gross_revenue,
       {half_up(cents('sum(order_revenue)'), 'count(*) * 100', 2)} AS avg_order_value
FROM (SELECT sales_month, order_id, min(user_id) AS user_id, sum(quantity) AS order_items,
             sum(line_revenue) AS order_revenue
      FROM cl GROUP BY sales_month, order_id) po
GROUP BY sales_month""",
    "top_products": f"""
SELECT product_id, product_name, department, count(DISTINCT order_id) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS total_quantity, {money('sum(line_revenue)')} AS gross_revenue,
       {half_up('sum(is_reordered)', 'count(*)', 4)} AS reorder_rate
FROM cl GROUP BY product_id, product_name, department""",
    "customer_metrics": f"""
SELECT user_id, count(DISTINCT order_id) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS item_count, {money('sum(line_revenue)')} AS gross_revenue,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       count(DISTINCT sales_month) AS active_months,
       count(DISTINCT order_id) > 1 AS retention_flag
FROM cl GROUP BY user_id""",
    "category_performance": f"""
SELECT department, count(DISTINCT order_id) AS order_count,
       count(DISTINCT product_id) AS product_count,
       CAST(sum(quantity) AS BIGINT) AS item_count, {money('sum(line_revenue)')} AS gross_revenue
FROM cl GROUP BY department""",
    "ml_customer_features": f"""
SELECT user_id, count(DISTINCT order_id) AS order_count,
       CAST(sum(quantity) AS BIGINT) AS item_count, {money('sum(line_revenue)')} AS gross_revenue,
       {half_up(cents('sum(line_revenue)'), 'count(*) * 100', 2)} AS avg_line_revenue,
       {half_up('sum(quantity)', 'count(*)', 2)} AS avg_item_quantity,
       {half_up('sum(is_reordered)', 'count(*)', 4)} AS reorder_rate,
       count(DISTINCT department) AS department_count,
       count(DISTINCT sales_month) AS active_months,
       max(order_date) AS last_order_date, count(DISTINCT order_id) > 1 AS repeat_customer_label
FROM cl GROUP BY user_id""",
}


# ---- text lines with faults, and validation (mirrors sources.testdata.faulted_lines) ----

RAW = """
rw AS (
  SELECT
    CASE WHEN order_id % 41 = 0 THEN 'x' || CAST(order_id AS VARCHAR) ELSE CAST(order_id AS VARCHAR) END AS order_id,
    CASE WHEN order_id % 19 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CAST(order_number AS VARCHAR) AS order_number,
    CAST(order_dow AS VARCHAR) AS order_dow,
    CAST(order_hour_of_day AS VARCHAR) AS order_hour_of_day,
    CASE WHEN order_id % 53 = 0 AND days_since_prior_order IS NOT NULL
         THEN CAST(days_since_prior_order AS VARCHAR) || '.0'
         ELSE CAST(days_since_prior_order AS VARCHAR) END AS days_since_prior_order,
    CAST(product_id AS VARCHAR) AS product_id,
    CASE WHEN order_id % 67 = 0 THEN product_name || ', "quoted" name' ELSE product_name END AS product_name,
    aisle,
    CASE WHEN order_id % 29 = 0 THEN NULL ELSE department END AS department,
    CASE WHEN order_id % 17 = 0 THEN '0' WHEN order_id % 43 = 0 THEN '2.5'
         WHEN order_id % 71 = 0 THEN ' ' || CAST(quantity AS VARCHAR) || ' '
         ELSE CAST(quantity AS VARCHAR) END AS quantity,
    CASE WHEN order_id % 23 = 0 THEN 'abc' WHEN order_id % 37 = 0 THEN '-1' WHEN order_id % 59 = 0 THEN 'NaN'
         WHEN order_id % 61 = 0 THEN 'Infinity' WHEN order_id % 73 = 0 THEN '1e3' WHEN order_id % 79 = 0 THEN '5.'
         WHEN order_id % 101 = 0 THEN '1000000000000.5' WHEN order_id % 103 = 0 THEN '100000000000000000.25'
         WHEN order_id % 107 = 0 THEN '1e21'
         ELSE CAST(CAST(unit_price AS DECIMAL(12,2)) AS VARCHAR) END AS unit_price,
    CASE WHEN order_id % 47 = 0 THEN '' ELSE CAST(reordered AS VARCHAR) END AS reordered,
    CASE WHEN order_id % 31 = 0 THEN 'notadate'
         WHEN order_id % 83 = 0 THEN year(order_date) || '-' || month(order_date) || '-' || day(order_date)
         WHEN order_id % 89 = 0 THEN CAST(order_date AS VARCHAR) || 'T10:00:00'
         ELSE CAST(order_date AS VARCHAR) END AS order_date,
    -- what each cell is worth
    CASE WHEN order_id % 41 <> 0 THEN order_id END AS v_order_id,
    CASE WHEN order_id % 19 <> 0 THEN user_id END AS v_user_id,
    order_number AS v_order_number, order_dow AS v_order_dow, order_hour_of_day AS v_order_hour_of_day,
    days_since_prior_order AS v_days_since_prior_order, product_id AS v_product_id,
    CASE WHEN order_id % 67 = 0 THEN product_name || ', "quoted" name' ELSE product_name END AS v_product_name,
    aisle AS v_aisle, CASE WHEN order_id % 29 <> 0 THEN department END AS v_department,
    CASE WHEN order_id % 17 = 0 THEN 0 WHEN order_id % 43 = 0 THEN NULL ELSE quantity END AS v_quantity,
    CASE WHEN order_id % 23 = 0 THEN NULL WHEN order_id % 37 = 0 THEN -1 WHEN order_id % 59 = 0 THEN NULL
         WHEN order_id % 61 = 0 THEN NULL WHEN order_id % 73 = 0 THEN 1000 WHEN order_id % 79 = 0 THEN 5
         WHEN order_id % 101 = 0 THEN 1000000000000.5
         WHEN order_id % 103 = 0 THEN CAST('100000000000000000.25' AS DECIMAL(26,6)) WHEN order_id % 107 = 0 THEN NULL
         ELSE CAST(CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(26,6)) END AS v_unit_price,
    CASE WHEN order_id % 47 = 0 THEN 0 ELSE reordered END AS v_reordered,
    CASE WHEN order_id % 31 <> 0 THEN order_date END AS v_order_date
  FROM ol)"""


def blank(x: str) -> str:
    return f"({x} IS NULL OR {x} = '')"


_missing = "concat_ws(',', " + ", ".join(f"CASE WHEN {blank(c)} THEN '{c}' END" for c in sorted(REQUIRED)) + ")"
_ids = "\n".join(
    f"         WHEN v_{c} IS NULL THEN 'invalid_integer:{c}'" for c in ("order_id", "user_id", "product_id", "reordered")
)
VALIDATED = (
    "\nvt0 AS (SELECT rw.*, " + _missing + " AS missing FROM rw),\nvt AS (SELECT vt0.*, CASE WHEN missing <> '' THEN 'missing_required:' || missing\n"
    "         WHEN v_quantity IS NULL OR v_unit_price IS NULL THEN 'invalid_numeric'\n"
    "         WHEN v_quantity <= 0 OR v_unit_price < 0 THEN 'out_of_range'\n" + _ids + "\n"
    f"         WHEN NOT {blank('days_since_prior_order')} AND v_days_since_prior_order IS NULL"
    " THEN 'invalid_integer:days_since_prior_order'\n       END AS reject_reason FROM vt0)"
)

ACCEPTED_COLS = ", ".join(
    (f"CAST(CAST(v_{c} AS DECIMAL(26,6)) AS VARCHAR) AS {c}" if c == "unit_price" else f"v_{c} AS {c}") for c in COLUMNS
)
RAW_COLS = ", ".join(COLUMNS)


def with_validation(body: str, extra: str = "") -> str:
    return with_base(body, RAW + "," + VALIDATED + ("," + extra if extra else ""))


VALIDATION_SQL = {
    "validate_accepted": f"SELECT {ACCEPTED_COLS} FROM vt WHERE reject_reason IS NULL",
    "validate_rejected": f"SELECT {RAW_COLS}, reject_reason FROM vt WHERE reject_reason IS NOT NULL",
    "reject_summary": "SELECT reject_reason, count(*) AS rejected_lines FROM vt WHERE reject_reason IS NOT NULL"
                      " GROUP BY reject_reason",
    "ingest_counts": "SELECT count(*) AS total_lines, count(*) FILTER (WHERE reject_reason IS NULL) AS accepted_lines,"
                     " count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected_lines FROM vt",
}


# ---- normalised baskets (mirrors sources.testdata basket tables and operators.baskets) ----

BASKETS = """
bo AS (
  SELECT order_id, user_id, CASE WHEN order_status = 'P' THEN 'train' ELSE 'prior' END AS eval_set,
         order_number, order_dow, order_hour_of_day, days_since_prior_order
  FROM cs),
opu AS (
  SELECT order_id, product_id, reordered, CASE WHEN order_status = 'P' THEN 'train' ELSE 'prior' END AS split
  FROM pu),
ai AS (SELECT CAST(dense_rank() OVER (ORDER BY aisle) AS INTEGER) AS aisle_id, aisle
       FROM (SELECT DISTINCT p_type AS aisle FROM part)),
de AS (SELECT CAST(dense_rank() OVER (ORDER BY department) AS INTEGER) AS department_id, department
       FROM (SELECT DISTINCT p_brand AS department FROM part)),
pr AS (SELECT p_partkey AS product_id, p_name AS product_name, ai.aisle_id, de.department_id
       FROM part JOIN ai ON p_type = ai.aisle JOIN de ON p_brand = de.department),
gaps AS (SELECT *, CASE WHEN order_number = 1 OR days_since_prior_order IS NULL THEN 0
                        ELSE days_since_prior_order END AS gap FROM bo),
cal AS (
  SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
         DATE '2025-01-01' + CAST(sum(gap) OVER (PARTITION BY user_id ORDER BY order_number, order_id
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER)
           AS order_date
  FROM gaps),
calm AS (SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS sales_month FROM cal),
bl AS (
  SELECT opu.split, opu.order_id, calm.user_id, calm.eval_set, opu.product_id, pr.product_name, ai.aisle,
         de.department, opu.reordered, calm.order_date, calm.sales_month
  FROM opu JOIN calm ON opu.order_id = calm.order_id JOIN pr ON opu.product_id = pr.product_id
       JOIN de ON pr.department_id = de.department_id JOIN ai ON pr.aisle_id = ai.aisle_id)"""

_BASKET_PRODUCTS = f"""
SELECT product_id, product_name, department, count(DISTINCT order_id) AS order_count,
       count(*) AS item_count, {half_up('sum(reordered)', 'count(*)', 4)} AS reorder_rate
FROM bl GROUP BY product_id, product_name, department"""

_BASKET_CUSTOMERS = """
SELECT user_id, count(DISTINCT order_id) AS order_count, count(*) AS item_count,
       min(order_date) AS first_order_date, max(order_date) AS last_order_date,
       count(DISTINCT sales_month) AS active_months, count(DISTINCT order_id) > 1 AS retention_flag
FROM bl GROUP BY user_id"""

_BASKET_FEATURES = f"""
SELECT user_id, count(DISTINCT order_id) AS order_count, count(*) AS item_count,
       {half_up('count(*)', 'count(DISTINCT order_id)', 2)} AS avg_basket_lines,
       {half_up('sum(reordered)', 'count(*)', 4)} AS reorder_rate,
       count(DISTINCT department) AS department_count,
       count(DISTINCT sales_month) AS active_months,
       max(order_date) AS last_order_date, count(DISTINCT order_id) > 1 AS repeat_customer_label
FROM bl GROUP BY user_id"""

BASKET_SQL = {
    "dim_products": "SELECT product_id, product_name, aisle_id, department_id FROM pr",
    "basket_union": "SELECT order_id, product_id, reordered, split FROM opu",
    "order_calendar": "SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, order_date,"
                      " sales_month FROM calm",
    "calendar_increments": "SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, order_date,"
                           " sales_month FROM calm",
    "basket_lines": "SELECT * FROM bl",
    "orphan_lines": """
SELECT split, order_id, CASE WHEN product_id % 61 = 0 THEN -1 - product_id ELSE product_id END AS product_id,
       CASE WHEN product_id % 61 = 0 THEN 'product' WHEN product_id % 53 = 0 THEN 'department' ELSE 'aisle' END
         AS missing_reference
FROM bl WHERE product_id % 61 = 0 OR product_id % 53 = 0 OR product_id % 59 = 0""",
    "resolved_lines": "SELECT * FROM bl WHERE product_id % 61 <> 0 AND product_id % 53 <> 0 AND product_id % 59 <> 0",
    "basket_files": "SELECT * FROM bl",
    "orders_without_lines": "SELECT * REPLACE (days_since_prior_order || '.0' AS days_since_prior_order) FROM bo"
                            " WHERE order_id NOT IN (SELECT order_id FROM opu)",
    "basket_monthly": f"""
SELECT sales_month, count(*) AS order_count, count(DISTINCT user_id) AS customer_count,
       CAST(sum(order_lines) AS BIGINT) AS item_count, {half_up('sum(order_lines)', 'count(*)', 2)} AS avg_basket_size
FROM (SELECT sales_month, order_id, min(user_id) AS user_id, count(*) AS order_lines FROM bl
      GROUP BY sales_month, order_id) po
GROUP BY sales_month""",
    "basket_products": _BASKET_PRODUCTS,
    "basket_customers": _BASKET_CUSTOMERS,
    "basket_category": """
SELECT department, count(DISTINCT order_id) AS order_count,
       count(DISTINCT product_id) AS product_count, count(*) AS item_count
FROM bl GROUP BY department""",
    "basket_customer_features": _BASKET_FEATURES,
}


def with_baskets(body: str) -> str:
    return with_base(body, BASKETS)


# Gaps that cannot be count as no days; first orders have no gap.
_BAD_GAP = "order_number > 1 AND (order_id % 7 = 0 OR order_id % 11 = 0 OR order_id % 13 = 0 OR order_id % 17 = 0)"
BAD_GAP_SQL = {
    "unreadable_gaps": f"""
SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day,
       CASE WHEN order_id % 7 = 0 THEN '99999999' WHEN order_id % 11 = 0 THEN '-5' WHEN order_id % 13 = 0 THEN 'soon'
            ELSE '2000000000000' END AS days_since_prior_order
FROM bo WHERE {_BAD_GAP}""",
    "calendar_with_bad_gaps": f"""
SELECT order_id, user_id, eval_set, order_number, order_dow, order_hour_of_day, order_date,
       CAST(date_trunc('month', order_date) AS DATE) AS sales_month
FROM (SELECT *, DATE '2025-01-01' + CAST(sum(CASE WHEN {_BAD_GAP} THEN 0 ELSE gap END)
                OVER (PARTITION BY user_id ORDER BY order_number, order_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS order_date FROM gaps)""",
}


# ---- connectors, contracts, streaming -------------------------------------------------------

TYPED_COLS = ", ".join(
    (f"CAST(CAST(v_{c} AS DECIMAL(26,6)) AS VARCHAR) AS {c}" if c == "unit_price" else f"v_{c} AS {c}") for c in COLUMNS
)

ACCEPTED_CLEAN = """
acc AS (SELECT """ + ", ".join(f"v_{c} AS {c}" for c in COLUMNS) + """ FROM vt WHERE reject_reason IS NULL
  AND NOT coalesce(order_id NOT LIKE 'x%' AND (TRY_CAST(order_id AS BIGINT) % 107 = 0
    OR TRY_CAST(order_id AS BIGINT) % 109 = 0 OR TRY_CAST(order_id AS BIGINT) % 113 = 0), false)),
acl AS (
  SELECT *, CAST(round(quantity * unit_price, 2) AS DECIMAL(33,2)) AS line_revenue,
         CAST(date_trunc('month', order_date) AS DATE) AS sales_month, coalesce(reordered, 0) AS is_reordered
  FROM acc
  WHERE order_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL AND quantity IS NOT NULL
    AND unit_price IS NOT NULL AND order_date IS NOT NULL AND quantity > 0 AND unit_price >= 0)"""

FAULTY = """
fl AS (
  SELECT * REPLACE (CASE WHEN product_id % 97 <> 0 THEN product_name END AS product_name,
                    CASE WHEN product_id % 89 = 0 AND order_id % 2 = 0 THEN department || ' II' ELSE department END
                      AS department)
  FROM cl)"""


def _violations_sql() -> str:
    parts = []
    for mart, (key, cols) in MART_COLUMNS.items():
        nulls = " OR ".join(f"{c} IS NULL" for c in cols)
        parts.append(
            f"SELECT '{mart}' AS mart, count(*) AS row_count, count(*) FILTER (WHERE {nulls}) AS null_rows,"
            f" count({key}) - count(DISTINCT {key}) AS excess_key_rows"
            f" FROM ({MART_SQL[mart].replace('FROM cl ', 'FROM fl ')}) m"
        )
    return "\nUNION ALL\n".join(parts)


_JSON_TEXT = ("product_name", "aisle", "department", "order_date")
_JSON = " || ',' || ".join(
    f"'\"{c}\":' || coalesce(" + (
        f"'\"' || replace(CAST(v_{c} AS VARCHAR), '\"', '\\\"') || '\"'" if c in _JSON_TEXT
        else f"CAST(CAST(v_{c} AS DECIMAL(26,6)) AS VARCHAR)" if c == "unit_price" else f"CAST(v_{c} AS VARCHAR)"
    ) + ", 'null')"
    for c in COLUMNS
)
_ENCODED = f"""
SELECT key, value, sha256(value) || '-' || row_number() OVER (PARTITION BY value) AS message_id
FROM (SELECT CAST(v_order_id AS VARCHAR) AS key, '{{' || {_JSON} || '}}' AS value FROM vt WHERE reject_reason IS NULL) t"""

# The streamed feed: messages of some orders are cut off, followed by text, or hold two objects.
_KEY = "TRY_CAST(order_id AS BIGINT)"
CUT = f"(order_id NOT LIKE 'x%' AND ({_KEY} % 107 = 0 OR {_KEY} % 109 = 0 OR {_KEY} % 113 = 0))"
_WHOLE = f"NOT coalesce({CUT}, false)"
_RAW_JSON = " || ',' || ".join(
    f"'\"{c}\":' || coalesce('\"' || replace({c}, '\"', '\\\"') || '\"', 'null')" for c in COLUMNS
)

_FEED_KEY = "coalesce(TRY_CAST(replace(order_id, 'x', '') AS BIGINT), 0)"
_FEED_REASON = (
    f"CASE WHEN {_FEED_KEY} % 127 = 0 OR {_FEED_KEY} % 131 = 0 THEN 'malformed_row' ELSE reject_reason END"
)

CONNECTOR_SQL = {
    "csv_rejects_by_source": (
        "validation",
        f"SELECT 'feed=' || CAST({_FEED_KEY} % 8 AS VARCHAR) AS source, {_FEED_REASON} AS reject_reason,"
        f" count(*) AS rejected_lines FROM vt WHERE {_FEED_REASON} IS NOT NULL GROUP BY ALL",
    ),
    "csv_accepted_lines": (
        "validation",
        VALIDATION_SQL["validate_accepted"].replace(
            "v_product_name AS product_name",
            f"CASE WHEN {_FEED_KEY} % 5 = 0 THEN v_product_name || chr(10) || 'second line' ELSE v_product_name END"
            " AS product_name",
        )
        + f" AND {_FEED_KEY} % 127 <> 0 AND {_FEED_KEY} % 131 <> 0",
    ),
    "src_csv_orders": ("validation", f"SELECT {TYPED_COLS} FROM vt0"),
    "sink_csv_roundtrip": ("base", MART_SQL["top_products"]),
    "encode_messages": ("validation", _ENCODED),
    "decode_messages": ("validation", VALIDATION_SQL["validate_accepted"]),
    "contract_violations": ("faulty", _violations_sql()),
    "landing_by_month": ("base", None),
    "stream_ingest": ("validation", f"{VALIDATION_SQL['validate_accepted']} AND {_WHOLE}"),
    "stream_quarantine": (
        "validation",
        f"SELECT {RAW_COLS}, reject_reason, order_id AS message_key, NULL AS corrupt_text FROM vt"
        f" WHERE reject_reason IS NOT NULL AND {_WHOLE} UNION ALL SELECT "
        + ", ".join(f"NULL AS {c}" for c in COLUMNS)
        + f", 'corrupt_message', order_id, CASE WHEN {_KEY} % 107 = 0 THEN substr(body, 1, 20)"
        f" WHEN {_KEY} % 109 = 0 THEN body || ' trailing' ELSE body || body END"
        f" FROM (SELECT *, '{{' || {_RAW_JSON} || '}}' AS body FROM vt WHERE {CUT})",
    ),
    "stream_batch_counts": (
        "validation",
        "SELECT CAST(2 AS BIGINT) AS batches, count(*) AS read_messages, CAST(0 AS BIGINT) AS repeated_messages,"
        f" count(*) FILTER (WHERE reject_reason IS NULL AND {_WHOLE}) AS accepted_lines,"
        f" count(*) FILTER (WHERE reject_reason IS NOT NULL OR NOT {_WHOLE}) AS rejected_lines FROM vt",
    ),
    **{f"stream_{name}": ("accepted", MART_SQL[name].replace("FROM cl ", "FROM acl ")) for name in MART_COLUMNS},
    "stream_dedup": ("validation", f"{VALIDATION_SQL['validate_accepted']} AND {_WHOLE}"),
}


def _connector_sql(kind: str, body: str | None, name: str) -> str:
    if kind == "base":
        return with_base(body) if body else None
    if kind == "faulty":
        return with_base(body, FAULTY)
    if kind == "validation":
        return with_validation(body)
    return with_validation(body, ACCEPTED_CLEAN)


def oracle_sql() -> dict[str, str]:
    sql = {
        "clean_orders": with_base(
            "SELECT order_id, user_id, order_number, order_dow, order_hour_of_day, days_since_prior_order,"
            " product_id, product_name, aisle, department, quantity, CAST(CAST(unit_price AS DECIMAL(26,6)) AS VARCHAR) AS unit_price,"
            " reordered, order_date, CAST(line_revenue AS VARCHAR) AS line_revenue, sales_month, is_reordered"
            " FROM cl"
        ),
    }
    for name, body in MART_SQL.items():
        sql[name] = with_base(body)
    for name, body in VALIDATION_SQL.items():
        sql[name] = with_validation(body)
    for name, body in {**BASKET_SQL, **BAD_GAP_SQL}.items():
        sql[name] = with_baskets(body)
    for name, (kind, body) in CONNECTOR_SQL.items():
        sql[name] = _connector_sql(kind, body, name)
    sql["landing_by_month"] = sql["clean_orders"]
    return sql
