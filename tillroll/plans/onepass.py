"""Five group-by steps of the report from one pass over the fact table.

Sales by category, region, month, age group and payment method all read the
same rows and differ only in the grouping key.  The rows are first grouped by
all five keys together, which leaves at most the product of five small domains;
the grouping sets then run on that, so the five-fold expansion never touches
the big side.  Sums are exact decimals, so they add up to the same results as
the per-step functions in ``tillroll.operators.report``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import age_group, year_month
from tillroll.operators import report
from tillroll.operators.report import average_of

# (step, grouping column), in grouping-set order
_KEYS = [
    ("sales_by_category", "category"),
    ("sales_by_region", "region"),
    ("monthly_trends", "_month"),
    ("age_group_analysis", "age_group"),
    ("payment_analysis", "payment_method"),
]


def _gid(position: int) -> int:
    """``grouping_id()`` of the set holding only key ``position``: a bit is
    set for every key that is *not* grouped, the first key highest."""
    n = len(_KEYS)
    return sum(1 << (n - 1 - j) for j in range(n) if j != position)


_AVERAGED = ("total_amount", "discount_pct", "customer_age")


def grouped_aggregate(df: DataFrame) -> DataFrame:
    """All five groupings, tagged by ``_gid``, with the sums of each."""
    keys = [k for _, k in _KEYS]
    cells = df.groupBy(
        "category", "region", report.month_start(),
        age_group("customer_age").alias("age_group"), "payment_method",
    ).agg(*report.sales_sums(*_AVERAGED))
    sums = [c for c in cells.columns if c not in keys]
    return cells.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("_gid"), *(F.sum(f"`{c}`").alias(c) for c in sums))


def split_results(agg: DataFrame) -> dict[str, DataFrame]:
    """The five step results, selected from ``grouped_aggregate`` output."""
    shown = {
        "sales_by_category": report.category_columns,
        "sales_by_region": report.region_columns,
        "monthly_trends": report.month_columns,
        "age_group_analysis": report.age_columns,
        "payment_analysis": report.payment_columns,
    }
    return {step: shown[step](agg.filter(F.col("_gid") == _gid(i)))
            for i, (step, _) in enumerate(_KEYS)}


# Dimension names of ``grouped_sales``, in grouping-set order.
DIMENSIONS = ["category", "region", "month", "age_group", "payment_method"]


def grouped_sales(df: DataFrame) -> DataFrame:
    """The five groupings as one long table, from one pass.

    One row per (dimension, member): the member is the group's key as text
    (a month as ``yyyy-MM``), with transactions, revenue, average amount,
    average discount and average age.  Same aggregate as ``one_pass``, with
    no persisted state, so it can be returned as a single DataFrame.
    """
    agg = grouped_aggregate(df)
    dimension = F.element_at(
        F.create_map(*[x for i, d in enumerate(DIMENSIONS) for x in (F.lit(_gid(i)), F.lit(d))]),
        F.col("_gid"),
    )
    member = F.coalesce(
        *[
            F.when(F.col("_gid") == _gid(i), F.col(k) if k != "_month" else year_month(k))
            for i, (_, k) in enumerate(_KEYS)
        ]
    )
    return agg.select(
        dimension.alias("dimension"),
        member.alias("member"),
        F.col("_transactions").alias("transactions"),
        report.revenue("total_revenue"),
        average_of("total_amount").alias("avg_amount"),
        average_of("discount_pct").alias("avg_discount"),
        average_of("customer_age", 1).alias("avg_age"),
    ).orderBy("dimension", "member")


@contextmanager
def one_pass(df: DataFrame) -> Iterator[dict[str, DataFrame]]:
    """Compute the five groupings once; yield their results; release."""
    agg = grouped_aggregate(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        agg.count()
        yield split_results(agg)
    finally:
        agg.unpersist()
