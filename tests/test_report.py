"""Report steps: the semantics the reference's report relies on."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from helpers import day, txn
from tillroll.functions import age_group, line_total
from tillroll.operators import report
from tillroll.sources.transactions import testdata_transactions

from conftest import SF_SMALL, rows


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_age_bands_nulls_and_bounds(spark):
    ages = [None, 10, 18, 24, 25, 34, 35, 44, 45, 54, 55, 75]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(age_group("age")).collect()]
    assert got == ["55+", "18-24", "18-24", "18-24", "25-34", "25-34", "35-44",
                   "35-44", "45-54", "45-54", "55+", "55+"]


def test_line_total_half_cent_rounds_up(spark):
    df = spark.createDataFrame([(8689.05, 0.10), (100.0, 0.0), (0.05, 0.10)], "p double, d double")
    got = [r[0] for r in df.select(line_total(F.col("p"), F.col("d"))).collect()]
    assert got == [7820.15, 100.0, 0.05]


def test_null_id_not_counted_but_amount_summed(spark):
    df = txn(spark, [
        {"transaction_id": 1, "category": "A", "total_amount": 10.0, "discount_pct": 5},
        {"transaction_id": None, "category": "A", "total_amount": 5.0, "discount_pct": 5},
        {"transaction_id": 3, "category": "A", "total_amount": 1.0, "discount_pct": 10},
        {"transaction_id": 4, "category": "A", "total_amount": None, "discount_pct": 10},
    ])
    (r,) = rows(report.sales_by_category(df))
    assert r == ("A", 3, 16.0, round(16.0 / 3, 2), 7.5)


def test_null_category_is_a_group_and_gets_no_discount(spark):
    df = txn(spark, [
        {"transaction_id": 1, "category": None, "product_name": "x", "total_amount": 50.0,
         "quantity": 1, "discount_pct": 20},
        {"transaction_id": 2, "category": "B", "product_name": "y", "total_amount": 10.0,
         "quantity": 2, "discount_pct": 10},
    ])
    cats = {r[0]: r for r in rows(report.sales_by_category(df))}
    assert set(cats) == {None, "B"}
    top = rows(report.top_products_with_discount(df))
    assert top == [(None, "x", 50.0, 1, None), ("B", "y", 10.0, 2, 10.0)]
    assert rows(report.top_products_with_lookup(df, report.sales_by_category(df))) == top
    assert rows(report.top_products_with_lookup(df)) == top


def test_window_ranking_keeps_ties_and_null_amount_last(spark):
    amounts = [9.0, 8.0, 7.0, 7.0, 1.0, None]
    df = txn(spark, [
        {"transaction_id": i, "category": "A", "product_name": f"p{i}", "total_amount": a}
        for i, a in enumerate(amounts)
    ] + [{"transaction_id": 99, "category": "B", "product_name": "q", "total_amount": None}])
    got = rows(report.window_ranking(df))
    assert [(c, r) for c, _, _, r in got] == [("A", 1), ("A", 2), ("A", 3), ("A", 3), ("B", 1)]
    assert got[-1][2] is None


def test_top_products_tie_break(spark):
    recs = [
        {"transaction_id": i, "category": c, "product_name": p, "total_amount": 5.0, "quantity": 1}
        for i, (c, p) in enumerate([("B", "z"), ("A", "z"), ("A", "a"), ("C", "m")])
    ]
    got = rows(report.top_products(txn(spark, recs), n=3))
    assert [(c, p) for c, p, _, _ in got] == [("A", "a"), ("A", "z"), ("B", "z")]


def test_top_with_discount_equals_join_on_real_data(spark):
    fact = testdata_transactions(spark, SF_SMALL).cache()
    try:
        a = rows(report.top_products_with_discount(fact))
        b = rows(report.top_products_with_lookup(fact, report.sales_by_category(fact)))
        assert a == b and len(a) == 20
    finally:
        fact.unpersist()


def test_empty_table(spark):
    df = txn(spark, [])
    for step in (report.sales_by_category, report.sales_by_region, report.monthly_trends,
                 report.age_group_analysis, report.payment_analysis, report.window_ranking,
                 report.top_products, report.top_products_with_discount):
        assert step(df).count() == 0
    prof = {(c, s): v for c, s, v in rows(report.column_profile(df))}
    assert prof[("total_amount", "count")] == 0.0
    assert prof[("total_amount", "mean")] is None
    assert rows(report.load_shape(df))[0][:2] == (0, 11)


def test_monthly_labels_sort_as_text(spark):
    df = txn(spark, [
        {"transaction_id": 1, "date": day("2023-10-02"), "total_amount": 1.0},
        {"transaction_id": 2, "date": day("2023-02-01"), "total_amount": 2.0},
        {"transaction_id": 3, "date": day("2023-02-28"), "total_amount": 3.0},
    ])
    assert rows(report.monthly_trends(df)) == [("2023-02", 2, 5.0), ("2023-10", 1, 1.0)]


def test_profile_matches_describe(spark):
    fact = testdata_transactions(spark, SF_SMALL)
    prof = {(c, s): v for c, s, v in rows(report.column_profile(fact))}
    desc = {r["summary"]: r for r in report.basic_stats(fact).collect()}
    for c in report.PROFILE_COLUMNS:
        for stat in report.PROFILE_STATS:
            assert float(desc[stat][c]) == pytest.approx(prof[(c, stat)], abs=5.1e-5)


def test_cross_foot(spark):
    fact = testdata_transactions(spark, SF_SMALL).cache()
    try:
        total_n = fact.count()
        total = fact.agg(F.sum("total_amount")).first()[0]
        for step, n_col, amt_col in [
            (report.sales_by_category, "transactions", "total_revenue"),
            (report.sales_by_region, "transactions", "total_revenue"),
            (report.monthly_trends, "transactions", "revenue"),
            (report.age_group_analysis, "transactions", "total_spend"),
            (report.payment_analysis, "count", "total_revenue"),
        ]:
            out = step(fact).agg(F.sum(n_col), F.sum(amt_col)).first()
            assert out[0] == total_n
            assert out[1] == pytest.approx(total, abs=0.01 * 100)
    finally:
        fact.unpersist()


def test_plans_keep_the_scalable_operators(spark):
    fact = testdata_transactions(spark, SF_SMALL)
    assert "WindowGroupLimit" in plan_text(report.window_ranking(fact))
    assert "TakeOrderedAndProject" in plan_text(report.top_products(fact))
    linear = plan_text(report.top_products_with_discount(fact))
    assert "WindowGroupLimit" in linear and "Expand" in linear and "LeftOuter" not in linear
    lookup = report.top_products_with_lookup(fact)
    lookup.collect()
    joined = plan_text(lookup)
    assert "BroadcastHashJoin" in joined and "LeftOuter" in joined and "ReusedExchange" in joined
    # Only the needed columns reach the lineitem scan.
    scan = plan_text(report.sales_by_region(fact))
    assert "l_extendedprice" in scan and "l_quantity" not in scan


def test_totals_do_not_depend_on_partitioning(spark):
    fact = testdata_transactions(spark, SF_SMALL).cache()
    try:
        for step in (report.sales_by_category, report.sales_by_region, report.top_products):
            base = rows(step(fact))
            for n in (1, 4, 13, 50):
                assert rows(step(fact.repartition(n))) == base
    finally:
        fact.unpersist()


def test_wide_profile_is_the_long_one_turned(spark):
    fact = testdata_transactions(spark, SF_SMALL)
    long = {(r[0], r[1]): r[2] for r in rows(report.column_profile(fact))}
    wide = report.wide_profile(fact)
    assert wide.columns == ["summary", *report.PROFILE_COLUMNS]
    for r in wide.collect():
        assert all(r[c] == long[c, r.summary] for c in report.PROFILE_COLUMNS)


def test_value_counts_head_and_types(spark):
    df = txn(spark, [{"transaction_id": i, "category": c} for i, c in
                     [(5, "B"), (2, "A"), (9, "A"), (1, None), (3, "A")]])
    assert rows(report.category_value_counts(df)) == [("A", 3), (None, 1), ("B", 1)]
    assert [r.transaction_id for r in report.table_head(df).collect()] == [1, 2, 3]
    assert rows(report.column_types(df))[:2] == [(0, "transaction_id", "bigint"), (1, "date", "date")]


def test_profile_does_not_depend_on_partitioning(spark):
    fact = testdata_transactions(spark, SF_SMALL).cache()
    try:
        base = sorted(rows(report.column_profile(fact)))
        for n in (1, 3, 13):
            assert sorted(rows(report.column_profile(fact.repartition(n)))) == base
    finally:
        fact.unpersist()
