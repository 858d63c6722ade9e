"""Independent SQL for every registered query that SQL can express.

The text runs in DuckDB over the driver's tables.  Column names equal the
Spark side's aliases.  Engine differences handled here: ``sum`` of an int is
HUGEINT in DuckDB (cast to BIGINT), NULL ordering is spelled out, and ties
before a LIMIT are broken the same way as in Spark.

Sums and averages are taken in whole millionths (HUGEINT, exact) and rounded
half away from zero by integer arithmetic on the absolute value, because
DuckDB divides decimals as doubles.
"""

from __future__ import annotations

from tillroll.operators.report import PROFILE_COLUMNS
from tillroll.schemas import TRANSACTION_COLUMNS
from tillroll.sources.transactions import TRANSACTIONS_VIEW_SQL

_T = f"WITH transactions AS ({TRANSACTIONS_VIEW_SQL})\n"

_AGE = """CASE WHEN customer_age < 25 THEN '18-24'
  WHEN customer_age < 35 THEN '25-34'
  WHEN customer_age < 45 THEN '35-44'
  WHEN customer_age < 55 THEN '45-54'
  ELSE '55+' END"""


def _profile_sql(cols: list[str], digits: int = 4) -> str:
    parts = []
    for c in cols:
        stats = {
            "count": f"CAST(COUNT({c}) AS DOUBLE)",
            "mean": _avg(c, digits),
            "stddev": f"ROUND(STDDEV_SAMP({c}), {digits})",
            "min": f"CAST(MIN({c}) AS DOUBLE)",
            "max": f"CAST(MAX({c}) AS DOUBLE)",
        }
        for stat, expr in stats.items():
            parts.append(
                f"SELECT '{c}' AS column_name, '{stat}' AS summary, {expr} AS value FROM transactions"
            )
    return "\nUNION ALL\n".join(parts)


def _wide_profile_sql(cols: list[str]) -> str:
    long = f"SELECT * FROM ({_profile_sql(cols)}) p"
    picks = ", ".join(f"MAX(CASE WHEN column_name = '{c}' THEN value END) AS {c}" for c in cols)
    return f"SELECT summary, {picks} FROM ({long}) q GROUP BY summary"


def _millionths(col: str) -> str:
    return f"SUM(CAST(CAST({col} AS DECIMAL(18,6)) * 1000000 AS HUGEINT))"


def _half_away(total: str, by: str, digits: int) -> str:
    """``total / by`` millionths, to ``digits``, half away from zero."""
    return (f"SIGN({total}) * CAST((2 * ABS({total}) * {10**digits} + {by} * 1000000)"
            f" // (2 * {by} * 1000000) AS DOUBLE) / {10**digits}")


def _sum(col: str, digits: int = 2) -> str:
    return _half_away(_millionths(col), "1", digits)


def _avg(col: str, digits: int = 2) -> str:
    n = f"CAST(COUNT({col}) AS HUGEINT)"
    return f"CASE WHEN COUNT({col}) > 0 THEN {_half_away(_millionths(col), n, digits)} END"


_AVERAGES = {
    "ROUND(SUM(total_amount), 2)": _sum("total_amount"),
    "ROUND(AVG(total_amount), 2)": _avg("total_amount"),
    "ROUND(AVG(discount_pct), 2)": _avg("discount_pct"),
    "ROUND(AVG(customer_age), 1)": _avg("customer_age", 1),
}


def _exact(sql: str) -> str:
    for plain, exact in _AVERAGES.items():
        sql = sql.replace(plain, exact)
    return sql


_SALES_BY_CATEGORY = """SELECT category, COUNT(transaction_id) AS transactions,
  ROUND(SUM(total_amount), 2) AS total_revenue,
  ROUND(AVG(total_amount), 2) AS avg_transaction,
  ROUND(AVG(discount_pct), 2) AS avg_discount
FROM transactions GROUP BY category"""

_TOP_PRODUCTS = """SELECT category, product_name,
  ROUND(SUM(total_amount), 2) AS revenue,
  CAST(SUM(quantity) AS BIGINT) AS units_sold
FROM transactions GROUP BY category, product_name
ORDER BY revenue DESC NULLS LAST, category ASC NULLS FIRST,
  product_name ASC NULLS FIRST
LIMIT 20"""

_TOP_WITH_DISCOUNT = f"""SELECT t.category, t.product_name, t.revenue, t.units_sold, c.avg_discount
FROM ({_TOP_PRODUCTS}) t
LEFT JOIN ({_SALES_BY_CATEGORY}) c ON t.category = c.category
ORDER BY t.revenue DESC NULLS LAST, t.category, t.product_name"""

# Per-step SQL over a table named ``transactions`` (any source with the
# eleven columns): the oracle below prefixes the TPC-H view, the randomized
# tests register their own rows under that name.
STEP_SQL: dict[str, str] = {
    "load_shape": "SELECT CAST(COUNT(*) AS BIGINT) AS row_count, "
    "CAST(11 AS BIGINT) AS column_count FROM transactions",
    "basic_stats": _profile_sql(PROFILE_COLUMNS),
    "basic_stats_wide": _wide_profile_sql(PROFILE_COLUMNS),
    "sales_by_category": _SALES_BY_CATEGORY + "\nORDER BY total_revenue DESC",
    "sales_by_region": """SELECT region, COUNT(transaction_id) AS transactions,
  ROUND(SUM(total_amount), 2) AS total_revenue,
  ROUND(AVG(customer_age), 1) AS avg_age
FROM transactions GROUP BY region ORDER BY total_revenue DESC""",
    "top_products": _TOP_PRODUCTS,
    "top_products_with_discount": _TOP_WITH_DISCOUNT,
    "top_products_with_broadcast": _TOP_WITH_DISCOUNT,
    "monthly_trends": """SELECT strftime(date, '%Y-%m') AS year_month,
  COUNT(transaction_id) AS transactions, ROUND(SUM(total_amount), 2) AS revenue
FROM transactions GROUP BY 1 ORDER BY 1""",
    "age_group_analysis": f"""SELECT {_AGE} AS age_group, COUNT(transaction_id) AS transactions,
  ROUND(AVG(total_amount), 2) AS avg_spend, ROUND(SUM(total_amount), 2) AS total_spend
FROM transactions GROUP BY 1 ORDER BY 1""",
    "payment_analysis": """SELECT payment_method, COUNT(transaction_id) AS count,
  ROUND(SUM(total_amount), 2) AS total_revenue, ROUND(AVG(total_amount), 2) AS avg_amount
FROM transactions GROUP BY payment_method ORDER BY count DESC""",
    "window_ranking": """SELECT category, product_name, total_amount, rnk AS rank FROM (
  SELECT category, product_name, total_amount,
    CAST(RANK() OVER (PARTITION BY category ORDER BY total_amount DESC NULLS LAST) AS BIGINT) AS rnk
  FROM transactions) r
WHERE rnk <= 3 ORDER BY category, rnk""",
    "grouped_sales": "\nUNION ALL\n".join(
        f"""SELECT '{dim}' AS dimension, CAST({key} AS VARCHAR) AS member,
  COUNT(transaction_id) AS transactions, ROUND(SUM(total_amount), 2) AS total_revenue,
  ROUND(AVG(total_amount), 2) AS avg_amount, ROUND(AVG(discount_pct), 2) AS avg_discount,
  ROUND(AVG(customer_age), 1) AS avg_age
FROM transactions GROUP BY {key}"""
        for dim, key in [
            ("category", "category"),
            ("region", "region"),
            ("month", "strftime(date, '%Y-%m')"),
            ("age_group", _AGE),
            ("payment_method", "payment_method"),
        ]
    ),
    # The CSV written by the sink and read back equals the aggregate.
    "csv_round_trip": _SALES_BY_CATEGORY,
    "category_value_counts": "SELECT category, COUNT(*) AS count FROM transactions"
    " GROUP BY category ORDER BY count DESC, category",
    "transactions_head": "SELECT * FROM transactions ORDER BY transaction_id, date, category,"
    " product_name, quantity, unit_price, discount_pct, total_amount, region, customer_age,"
    " payment_method LIMIT 3",
}
# The same answers over the whole table written as CSV, and over a fact table
# that is materialized first.
STEP_SQL["csv_transactions"] = STEP_SQL["sales_by_category"]
STEP_SQL["csv_load_shape"] = STEP_SQL["load_shape"]
STEP_SQL["tuned_grouped_sales"] = STEP_SQL["grouped_sales"]
STEP_SQL["tuned_top_products"] = STEP_SQL["top_products_with_broadcast"]
STEP_SQL["tuned_window_ranking"] = STEP_SQL["window_ranking"]

STEP_SQL["cached_grouped_sales"] = STEP_SQL["grouped_sales"]
STEP_SQL["cached_window_ranking"] = STEP_SQL["window_ranking"]
STEP_SQL["cached_top_products"] = STEP_SQL["top_products_with_broadcast"]

# -- comparison tables -------------------------------------------------------

STEP_SQL["year_over_year"] = """WITH sides AS (
  SELECT category, CAST(year(date) AS INT) AS year, CAST(month(date) AS INT) AS month,
    ROUND(SUM(total_amount), 2) AS revenue
  FROM transactions GROUP BY ALL)
SELECT a.category, a.year, a.month, a.revenue, b.revenue AS next_revenue,
  CASE WHEN a.revenue > 0 THEN b.revenue / a.revenue END AS ratio
FROM sides a JOIN sides b ON a.category IS NOT DISTINCT FROM b.category
  AND a.month = b.month AND b.year = a.year + 1"""



def _grid(row: str, column: str, name: str) -> str:
    return f"""WITH cells AS (
  SELECT {row}, {column} AS {name}, COUNT(transaction_id) AS transactions,
    ROUND(SUM(total_amount), 2) AS revenue
  FROM transactions GROUP BY ALL),
grid AS (
  SELECT * FROM (SELECT DISTINCT {row} FROM cells), (SELECT DISTINCT {name} FROM cells)),
filled AS (
  SELECT g.{row}, g.{name}, coalesce(transactions, 0) AS transactions,
    coalesce(revenue, 0.0) AS revenue
  FROM grid g LEFT JOIN cells c ON g.{row} IS NOT DISTINCT FROM c.{row}
    AND g.{name} IS NOT DISTINCT FROM c.{name}),
ordered AS (
  SELECT *, lag(revenue, 1, 0.0) OVER (PARTITION BY {row} ORDER BY {name} NULLS FIRST) AS previous
  FROM filled)
SELECT {row}, {name}, transactions, revenue,
  CASE WHEN previous > 0 THEN revenue / previous ELSE 1.0 END AS ratio FROM ordered"""


STEP_SQL["category_month_grid"] = _grid("category", "strftime(date, '%Y-%m')", "year_month")
STEP_SQL["payment_day_grid"] = _grid("payment_method", "strftime(date, '%Y-%m-%d')", "day")


def _matrix(row: str, name: str) -> str:
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    cells = ", ".join(f"""coalesce(max(CASE WHEN region = '{r}' THEN revenue END), 0.0) AS "{r}\"""" for r in regions)
    return f"""WITH cells AS (
  SELECT {row} AS {name}, region, ROUND(SUM(total_amount), 2) AS revenue FROM transactions GROUP BY ALL)
SELECT {name}, {cells} FROM cells GROUP BY {name}"""


STEP_SQL["month_region_matrix"] = _matrix("strftime(date, '%Y-%m')", "year_month")
STEP_SQL["age_region_matrix"] = _matrix(_AGE, "age_group")


def _by_label(label: str) -> str:
    return f"""SELECT {label} AS payment_method, COUNT(transaction_id) AS transactions,
  ROUND(SUM(total_amount), 2) AS revenue FROM transactions GROUP BY 1"""


STEP_SQL["payment_aliases"] = _by_label(
    "CASE payment_method WHEN '1-URGENT' THEN 'first' WHEN '2-HIGH' THEN 'first'"
    " WHEN '5-LOW' THEN 'last' ELSE payment_method END")
STEP_SQL["payment_aliases_table"] = _by_label(
    "CASE WHEN payment_method[1] IN ('1', '2', '3')"
    " THEN split_part(payment_method, '-', -1) ELSE payment_method END")

STEP_SQL["payment_summary"] = f"""WITH groups AS ({_by_label("payment_method")}),
listed(position, payment_method) AS (VALUES
  (1, '5-LOW'), (2, '4-NOT SPECIFIED'), (3, '3-MEDIUM'), (4, '2-HIGH'), (5, '1-URGENT'), (6, 'Cash'))
SELECT position, l.payment_method, transactions, revenue, (SELECT max(revenue) FROM groups) AS max_revenue
FROM listed l LEFT JOIN groups g ON g.payment_method = l.payment_method"""

STEP_SQL["daily_sales"] = """WITH per_day AS (
  SELECT date, COUNT(transaction_id) AS transactions, ROUND(SUM(total_amount), 2) AS revenue
  FROM transactions GROUP BY date),
span AS (SELECT min(date) AS low, max(date) AS high FROM per_day),
days AS (SELECT low, CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
SELECT CAST(day - low AS INT) AS day_number, strftime(day, '%Y-%m-%d') AS day,
  strftime(day + 30, '%Y-%m-%d') AS due, coalesce(transactions, 0) AS transactions,
  coalesce(revenue, 0.0) AS revenue
FROM days LEFT JOIN per_day ON date = day"""

_TYPES = {"BIGINT": "bigint", "DATE": "date", "VARCHAR": "string", "INTEGER": "int", "DOUBLE": "double"}
STEP_SQL["column_types"] = (
    "WITH told AS (SELECT row_number() OVER () - 1 AS position, column_name, CASE column_type "
    + " ".join(f"WHEN '{d}' THEN '{s}'" for d, s in _TYPES.items())
    + " END AS data_type FROM (DESCRIBE SELECT * FROM transactions)),\ncounted AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS non_null FROM transactions" for c in TRANSACTION_COLUMNS)
    + ")\nSELECT CAST(position AS INT) AS position, column_name, data_type, non_null"
    " FROM told JOIN counted USING (column_name)")

# Sums and averages are written as ROUND(..) above for reading, and computed
# exactly in the text that runs.
STEP_SQL = {name: _exact(sql) for name, sql in STEP_SQL.items()}



def _on_view(sql: str) -> str:
    """The SQL over the transaction view, whatever other names it defines."""
    return _T.rstrip() + ",\n" + sql[5:] if sql.startswith("WITH ") else _T + sql


ORACLE_SQL: dict[str, str] = {name: _on_view(sql) for name, sql in STEP_SQL.items()}

# -- nested documents: the same numbers from the flat tables -----------------

_LINES = """WITH lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id, CAST(l_quantity AS INT) AS quantity,
    CAST(FLOOR(l_discount * 100 + 0.5) AS INT) AS discount_pct,
    CAST((CAST(FLOOR(l_extendedprice * 100 + 0.5) AS BIGINT)
      * (100 - CAST(FLOOR(l_discount * 100 + 0.5) AS BIGINT)) + 50) // 100 AS DOUBLE) / 100 AS total_amount
  FROM lineitem)
"""

ORACLE_SQL["order_documents"] = _LINES + _exact("""SELECT line, COUNT(*) AS lines,
  CAST(SUM(quantity) AS BIGINT) AS quantity, ROUND(SUM(total_amount), 2) AS revenue,
  CAST(SUM(discount_pct) AS BIGINT) AS discount_points
FROM lines GROUP BY line""")
ORACLE_SQL["order_documents_in_parts"] = ORACLE_SQL["order_documents"]
ORACLE_SQL["order_sizes"] = _LINES + f""", per_order AS (
  SELECT order_id, COUNT(*) AS lines, {_millionths("total_amount")} AS worth,
    min(struct_pack(line, part_id, quantity, discount_pct, total_amount)).total_amount AS amount
  FROM lines GROUP BY order_id)
SELECT CAST(lines AS BIGINT) AS lines, COUNT(*) AS orders,
  {_half_away("SUM(worth)", "1", 2)} AS revenue, {_sum("amount")} AS first_line_revenue
FROM per_order GROUP BY lines"""
ORACLE_SQL["conversation_documents"] = """SELECT role, COUNT(*) AS turns,
  CAST(SUM(length(text)) AS BIGINT) AS chars, COUNT(*) FILTER (nth = 1) AS openings
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth FROM conversations)
GROUP BY role"""
