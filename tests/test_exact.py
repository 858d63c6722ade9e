"""Exact sums and averages against Python's exact arithmetic."""

import math
import random
from fractions import Fraction

import pytest

from helpers import txn
from tillroll.functions import exact_avg, exact_sum
from tillroll.operators import report

VALUES = {
    "half": [5.0] * 78 + [4.0, 4.0],  # 398 / 80 = 4.975 exactly
    "one refund": [-1.5],
    "negative": [-1.5, -2.5, -10.0],
    "negative half": [-0.01, 0.0, 0.0, -0.01],
    "fractional": [12.5, 7.5],
    "sub-cent": [0.004, 0.004, 0.004],
    "mixed": [0.01, -0.02, 10.0, 2.5, -99.99, 7.25, 0.3, 0.0005],
    "random": [round(random.Random(1).uniform(-1000, 1000), 4) for _ in range(500)],
}


def half_away(q: Fraction, digits: int) -> float:
    """Round an exact fraction half away from zero."""
    whole = math.floor(abs(q) * 10**digits + Fraction(1, 2))
    return (1 if q >= 0 else -1) * whole / 10**digits


@pytest.mark.parametrize("name", VALUES)
@pytest.mark.parametrize("digits", [1, 2, 4])
def test_sum_and_average(spark, name, digits):
    values = VALUES[name]
    exact = [Fraction(str(v)) for v in values]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    want = (half_away(sum(exact), digits), half_away(sum(exact) / len(exact), digits))
    for n in (1, 4, 13):
        got = df.repartition(n).agg(exact_sum("x", digits), exact_avg("x", digits)).first()
        assert tuple(got) == want


def test_no_values(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(df.agg(exact_sum("x"), exact_avg("x")).first()) == (None, None)


def test_refunds_in_the_report(spark):
    df = txn(spark, [{"transaction_id": i, "category": "A", "total_amount": a, "discount_pct": 5}
                     for i, a in enumerate([-1.5, -2.5, -10.0])])
    assert report.sales_by_category(df).collect() == [("A", 3, -14.0, -4.67, 5.0)]


def _all_forms(spark, df):
    """The average discount of each category, by every form that computes it."""
    from tillroll.plans.onepass import grouped_sales, one_pass
    from tillroll.plans.tuned import tuned_report

    plain = {r.category: r.avg_discount for r in report.sales_by_category(df).collect()}
    with one_pass(df) as res:
        shared = {r.category: r.avg_discount for r in res["sales_by_category"].collect()}
    long = {r.member: r.avg_discount for r in grouped_sales(df).filter("dimension = 'category'").collect()}
    tops = [{r.category: r.avg_discount for r in f.collect()} for f in (
        report.top_products_with_discount(df), report.top_products_with_lookup(df))]
    with tuned_report(df, storage="cache", one_pass_groups=True) as t:
        tops.append({r.category: r.avg_discount for r in t.top_products().collect()})
    return [plain, shared, long, *tops]


def test_large_groups_are_rounded_once(spark):
    """5,000 hundredths over 10,001 rows is just under half a hundredth."""
    ids = spark.range(10_001).repartition(7)
    df = ids.selectExpr(
        "id AS transaction_id", "DATE'2022-01-01' AS date", "'A' AS category", "'p' AS product_name",
        "1 AS quantity", "1D AS unit_price", "IF(id < 5000, 0.01D, 0D) AS discount_pct", "1D AS total_amount",
        "'N' AS region", "30 AS customer_age", "'Cash' AS payment_method")
    for got in _all_forms(spark, df):
        assert got == {"A": 0.0}


def test_random_large_groups(spark):
    r = random.Random(5)
    data = [(i, r.choice("AB"), r.randint(-10**7, 10**7) / 10**6) for i in range(20_000)]
    df = spark.createDataFrame(data, "transaction_id long, category string, discount_pct double").selectExpr(
        "transaction_id", "DATE'2022-01-01' AS date", "category", "'p' AS product_name", "1 AS quantity",
        "1D AS unit_price", "discount_pct", "1D AS total_amount", "'N' AS region", "30 AS customer_age",
        "'Cash' AS payment_method")
    own = {c: [Fraction(str(v)) for _, k, v in data if k == c] for c in "AB"}
    want = {c: half_away(sum(v) / len(v), 2) for c, v in own.items()}
    for got in _all_forms(spark, df):
        assert got == want
