"""One pass for five group-bys gives the per-step results exactly."""

from helpers import day, txn
from tillroll.operators import report
from tillroll.plans.onepass import one_pass
from tillroll.sources.transactions import testdata_transactions

from conftest import SF_SMALL, rows

STEPS = {
    "sales_by_category": report.sales_by_category,
    "sales_by_region": report.sales_by_region,
    "monthly_trends": report.monthly_trends,
    "age_group_analysis": report.age_group_analysis,
    "payment_analysis": report.payment_analysis,
}


def _check(df):
    with one_pass(df) as res:
        for name, fn in STEPS.items():
            got, want = res[name], fn(df)
            assert got.columns == want.columns, name
            assert rows(got) == rows(want), name


def test_equals_steps_on_testdata(spark):
    fact = testdata_transactions(spark, SF_SMALL).cache()
    try:
        _check(fact)
    finally:
        fact.unpersist()


def test_null_keys_stay_their_own_groups(spark):
    _check(txn(spark, [
        {"transaction_id": 1, "category": None, "region": None, "date": None,
         "customer_age": None, "payment_method": None, "total_amount": 3.0, "discount_pct": 5},
        {"transaction_id": None, "category": "A", "region": "N", "date": day("2022-03-04"),
         "customer_age": 30, "payment_method": "Cash", "total_amount": 2.0, "discount_pct": 0},
        {"transaction_id": 3, "category": "A", "region": "N", "date": day("2022-03-09"),
         "customer_age": 61, "payment_method": "Cash", "total_amount": None, "discount_pct": 10},
    ]))


def test_empty(spark):
    _check(txn(spark, []))
