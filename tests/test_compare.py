"""Comparison tables: pairs, grids, matrices, aliases, fixed orders, calendars."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import day, txn
from tillroll.operators import compare
from tillroll.sources.transactions import testdata_transactions

from conftest import SF_SMALL, rows


def sale(i, category, date, amount, **more):
    return {"transaction_id": i, "category": category, "date": day(date) if date else None,
            "total_amount": amount, **more}


@pytest.fixture
def sales(spark):
    return txn(spark, [
        sale(1, "A", "2022-01-05", 10.0), sale(2, "A", "2023-01-09", 25.0), sale(3, "A", "2022-02-01", 3.0),
        sale(4, None, "2022-01-01", 0.0), sale(5, None, "2023-01-31", 4.0), sale(6, "B", "2023-01-01", 1.0),
        sale(7, "A", "2024-01-01", 5.0), sale(8, "A", None, 7.0)])


def test_pairs_need_both_sides(sales):
    assert rows(compare.year_over_year(sales)) == [
        (None, 2022, 1, 0.0, 4.0, None), ("A", 2022, 1, 10.0, 25.0, 2.5), ("A", 2023, 1, 25.0, 5.0, 0.2)]


def test_grid_has_every_cell(sales):
    got = {(r.category, r.year_month): (r.transactions, r.revenue, r.ratio)
           for r in compare.category_month_grid(sales).collect()}
    months = [None, "2022-01", "2022-02", "2023-01", "2024-01"]
    assert set(got) == {(c, m) for c in (None, "A", "B") for m in months}
    assert got["A", "2022-01"] == (1, 10.0, 10.0 / 7.0)  # after the month of the rows without a date
    assert got["A", "2022-02"] == (1, 3.0, 0.3)
    assert got["B", "2022-01"] == (0, 0.0, 1.0) and got["B", "2023-01"] == (1, 1.0, 1.0)
    assert got["B", "2024-01"] == (0, 0.0, 0.0)


def test_grid_refuses_too_many_members(sales):
    with pytest.raises(Exception, match="more than 2 members of year_month"):
        compare.sales_grid(sales, "category", F.date_format("date", "yyyy-MM"), "year_month", max_members=2).collect()


def test_grid_of_no_rows(spark):
    assert rows(compare.category_month_grid(txn(spark, []))) == []


def test_matrix(spark):
    df = txn(spark, [
        sale(1, "A", "2022-01-05", 10.0, region="N`x"), sale(2, "A", "2022-01-09", 25.0, region="S.a"),
        sale(3, "A", "2022-02-01", 3.0, region=None), sale(4, "A", "2022-02-01", 1.0, region="N`x")])
    got = compare.month_region_matrix(df)
    assert got.columns == ["year_month", "N`x", "S.a", "(null)"]
    assert rows(got) == [("2022-01", 10.0, 25.0, 0.0), ("2022-02", 1.0, 0.0, 3.0)]
    fixed = compare.month_region_matrix(df, ["S.a", "West"])
    assert rows(fixed) == [("2022-01", 25.0, 0.0), ("2022-02", 0.0, 0.0)]
    with pytest.raises(ValueError, match="more than 2"):
        compare.members_of(df, "region", 2)
    with pytest.raises(ValueError, match="NULL"):
        compare.members_of(df.union(txn(spark, [{"region": "(null)"}])), "region")


def test_aliases(spark):
    df = txn(spark, [{"transaction_id": i, "payment_method": p, "total_amount": 1.0}
                     for i, p in enumerate(["Cash", "Card", "card", None, "Cash"])])
    got = lambda a: sorted((r[0] or "-") for r in rows(
        compare.with_aliases(df, "payment_method", a).select("payment_method")))
    assert got({"card": "Card"}) == ["-", "Card", "Card", "Cash", "Cash"]
    assert got({}) == ["-", "Card", "Cash", "Cash", "card"]
    table = spark.createDataFrame([("card", "Card"), ("card", "Zzz"), ("Cash", None), (None, "x")], "n string, a string")
    assert got(table) == ["-", "Card", "Card", "Cash", "Cash"]
    with pytest.raises(ValueError, match="table"):
        got({str(i): "x" for i in range(compare.MAX_LITERAL + 1)})


def test_long_alias_table_is_not_broadcast_by_hint(spark, monkeypatch):
    from tillroll.operators import joins

    df, names = txn(spark, []), spark.range(1000).select(F.col("id").cast("string").alias("n"), F.lit("a").alias("a"))
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(compare.with_aliases(df, "region", names))
    monkeypatch.setattr(joins, "planned_bytes", lambda d: 1 << 40)
    assert not hinted(compare.with_aliases(df, "region", names))


def test_fixed_order_keeps_absent_members(spark):
    df = txn(spark, [
        {"transaction_id": 1, "payment_method": "Cash", "total_amount": 5.0},
        {"transaction_id": 2, "payment_method": "Other", "total_amount": 50.0},
        {"transaction_id": 3, "payment_method": None, "total_amount": 2.0}])
    got = compare.payment_summary(df, ["Gift", "Cash"])
    assert rows(got) == [(1, "Gift", None, None, 50.0), (2, "Cash", 1, 5.0, 50.0)]
    assert [r[4] for r in rows(compare.payment_summary(df.limit(0)))] == [None] * 6


def test_calendar_has_empty_days(spark):
    df = txn(spark, [sale(1, "A", "2024-02-27", 1.0), sale(2, "A", "2024-03-01", 2.5), sale(3, "A", None, 9.0)])
    assert rows(compare.daily_sales(df, due_days=2)) == [
        (0, "2024-02-27", "2024-02-29", 1, 1.0), (1, "2024-02-28", "2024-03-01", 0, 0.0),
        (2, "2024-02-29", "2024-03-02", 0, 0.0), (3, "2024-03-01", "2024-03-03", 1, 2.5)]
    assert rows(compare.daily_sales(df.filter("date IS NULL"))) == []
    far = txn(spark, [sale(1, "A", "0001-01-01", 1.0), sale(2, "A", "9999-12-31", 1.0)])
    with pytest.raises(Exception, match="days from first to last"):
        compare.daily_sales(far).collect()
    assert compare.calendar(df).agg(F.max("day")).first()[0] == dt.date(2024, 3, 1)


def test_ratio_guard(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double")
    assert [r[0] for r in rows(df.select(compare.guarded_ratio(F.col("a"), F.col("b"))))] == [0.5, 1.0, 1.0, None]


def scans(df):
    """Tables read by the plan that ran, reused parts not counted."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return Counter(re.findall(r"ReadSchema: struct<(\w+)", plan))


@pytest.mark.parametrize("step", [
    compare.category_month_grid, compare.payment_day_grid, compare.month_region_matrix,
    compare.payment_summary, compare.daily_sales])
def test_only_the_aggregate_is_read_again(spark, step):
    """The fact table's one pass is over when the result's plan is made."""
    found = scans(step(testdata_transactions(spark, SF_SMALL)))
    assert found and not any(c.startswith(("l_", "o_", "p_", "c_")) for c in found)


def test_pairs_come_from_one_aggregate(spark):
    found = scans(compare.year_over_year(testdata_transactions(spark, SF_SMALL)))
    assert found["l_orderkey"] == 1
