"""Randomized: report steps on random transactions (NULLs anywhere, refunds,
sub-cent amounts) equal the same SQL run by DuckDB on the same rows, value for
value: sums and averages are exact on both sides, by different formulas.
"""

import datetime as dt

import duckdb
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import txn
from tillroll.operators import compare, report
from tillroll.plans.onepass import grouped_sales
from tillroll.plans.oracle import STEP_SQL

STEPS = {
    "sales_by_category": report.sales_by_category,
    "sales_by_region": report.sales_by_region,
    "top_products": report.top_products,
    "top_products_with_discount": report.top_products_with_discount,
    "monthly_trends": report.monthly_trends,
    "age_group_analysis": report.age_group_analysis,
    "payment_analysis": report.payment_analysis,
    "window_ranking": report.window_ranking,
    "grouped_sales": grouped_sales,
    "year_over_year": compare.year_over_year,
    "category_month_grid": compare.category_month_grid,
    "payment_day_grid": compare.payment_day_grid,
    "daily_sales": compare.daily_sales,
    "payment_summary": compare.payment_summary,
}
MONEY = {"total_revenue", "avg_transaction", "avg_discount", "revenue", "avg_age",
         "avg_spend", "total_spend", "avg_amount", "total_amount"}

maybe = lambda s: st.one_of(st.none(), s)
row = st.fixed_dictionaries({
    "transaction_id": maybe(st.integers(1, 50)),
    "date": maybe(st.dates(dt.date(2022, 1, 1), dt.date(2023, 12, 31))),
    "category": maybe(st.sampled_from(["A", "B", "C"])),
    "product_name": maybe(st.sampled_from(["p", "q", "r", "s"])),
    "quantity": maybe(st.integers(1, 10)),
    "unit_price": maybe(st.integers(100, 9999).map(lambda c: c / 100)),
    "discount_pct": maybe(st.sampled_from([0, 5, 10, 15, 20, 25])),
    "total_amount": maybe(st.sampled_from([1.0, 2.5, 2.5, 7.25, 10.0, 99.99, 0.01, -1.5, -2.5, 0.004, -0.0051])),
    "region": maybe(st.sampled_from(["North", "South"])),
    "customer_age": maybe(st.integers(10, 80)),
    "payment_method": maybe(st.sampled_from(["Cash", "Card"])),
})


def _norm(names, rows):
    out = []
    for r in rows:
        out.append(tuple(
            ("~", v + 0.0) if n in MONEY and isinstance(v, float) else v
            for n, v in zip(names, r)
        ))
    return sorted(out, key=repr)


def _close(a, b):
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, tuple) and isinstance(v, tuple):
                if u[1] != v[1]:
                    return False
            elif u != v:
                return False
    return True


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=0, max_size=40))
def test_steps_equal_duckdb(spark, records):
    df = txn(spark, records)
    con = duckdb.connect()
    frame = pd.DataFrame.from_records(records, columns=df.columns)
    frame = frame.astype({"transaction_id": "Int64", "quantity": "Int64", "discount_pct": "Int64",
                          "customer_age": "Int64", "unit_price": "Float64", "total_amount": "Float64"})
    frame["date"] = pd.to_datetime(frame["date"]).dt.date
    con.register("raw", frame)
    con.execute("CREATE TABLE transactions AS SELECT * REPLACE (CAST(date AS DATE) AS date) FROM raw")
    for name, fn in STEPS.items():
        got = fn(df)
        names = got.columns
        cur = con.execute(STEP_SQL[name])
        onames = [d[0] for d in cur.description]
        assert sorted(onames) == sorted(names), name
        want = [tuple(r[onames.index(n)] for n in names) for r in cur.fetchall()]
        assert _close(_norm(names, [tuple(r) for r in got.collect()]), _norm(names, want)), name
