"""Synthetic transactions: invariants and partition independence."""

from pyspark.sql import functions as F

from tillroll.operators import report
from tillroll.sources.generate import CATEGORIES, PRICE_CENTS, PRODUCTS, gen_transactions

from conftest import rows


def test_invariants(spark):
    df = gen_transactions(spark, 20_000, partitions=4).cache()
    try:
        assert df.count() == 20_000
        assert df.select(F.count_distinct("transaction_id")).first()[0] == 20_000
        assert df.agg(F.min("transaction_id"), F.max("transaction_id")).first() == (1, 20_000)
        got = {(r[0], r[1]) for r in df.select("category", "product_name").distinct().collect()}
        allowed = {(c, p) for c, ps in PRODUCTS.items() for p in ps}
        assert got <= allowed and len(got) == 36
        for (cat, lo, hi) in df.groupBy("category").agg(F.min("unit_price"), F.max("unit_price")).collect():
            c_lo, c_hi = PRICE_CENTS[CATEGORIES.index(cat)]
            assert c_lo / 100 <= lo and hi <= c_hi / 100
        bounds = df.agg(F.min("quantity"), F.max("quantity"), F.min("customer_age"),
                        F.max("customer_age"), F.min("date"), F.max("date")).first()
        assert tuple(bounds[:4]) == (1, 10, 18, 75)
        assert str(bounds[4]) >= "2022-01-01" and str(bounds[5]) <= "2023-12-31"
        assert {r[0] for r in df.select("discount_pct").distinct().collect()} == {0, 5, 10, 15, 20, 25}
        # total = round(price * qty * (1 - disc/100), 2), half up, in cents
        bad = df.filter(
            F.abs(F.col("total_amount") - F.floor(
                F.round(F.col("unit_price") * 100) * F.col("quantity")
                * (100 - F.col("discount_pct")) / 100 + 0.5) / 100) > 1e-9
        ).count()
        assert bad == 0
    finally:
        df.unpersist()


def test_partitioning_does_not_change_rows(spark):
    a = gen_transactions(spark, 5_000, partitions=1)
    b = gen_transactions(spark, 5_000, partitions=7)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_value_counts_and_head(spark):
    df = gen_transactions(spark, 3_000, partitions=3)
    counts = rows(report.category_value_counts(df))
    assert sum(c for _, c in counts) == 3_000
    assert [c for _, c in counts] == sorted((c for _, c in counts), reverse=True)
    head = rows(df.orderBy("transaction_id").limit(3))
    assert [r[0] for r in head] == [1, 2, 3]
