"""The report steps, one function each, over the flat transaction table.

Every function takes a DataFrame and returns a DataFrame; none runs an
action.  Results are ordered as in the reference's console report, with
explicit tie-breakers where a ``limit`` would otherwise be nondeterministic.

Scale notes (each group-by below has few output groups, so Spark's partial
aggregation shrinks every partition to a handful of rows before the shuffle;
a hot key that holds a third of the table costs nothing extra):

* ``window_ranking`` keeps the ``rank <= k`` filter directly above the
  window, so Catalyst inserts ``WindowGroupLimit`` on both sides of the
  shuffle and only the top rows of each input partition move.
* ``top_products`` is a ``TakeOrderedAndProject``: each task keeps n rows.
* ``top_products_with_discount`` reads the fact table once: the category
  lookup is rolled up from the product aggregate, not recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import (
    age_group,
    exact,
    exact_avg,
    exact_sum,
    quotient,
    rounded,
    year_month,
)

PROFILE_COLUMNS = ["unit_price", "quantity", "total_amount", "customer_age"]
PROFILE_STATS = ["count", "mean", "stddev", "min", "max"]
# The output column names below are fixed values.


# -- load ------------------------------------------------------------------


def load_shape(df: DataFrame) -> DataFrame:
    """Row count, column count and non-empty partition count in one pass."""
    return (
        df.select(F.spark_partition_id().alias("_pid"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("_pid").alias("partition_count"),
        )
        .select(
            "row_count",
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            "partition_count",
        )
    )


# -- profile ---------------------------------------------------------------


def basic_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """The reference's ``describe``: count, mean, stddev, min, max, as text."""
    return df.describe(*(cols or PROFILE_COLUMNS))


def column_profile(
    df: DataFrame, cols: list[str] | None = None, digits: int = 4
) -> DataFrame:
    """Numeric long form of ``basic_stats``: (column_name, summary, value).

    One global aggregate (partial per task, one tiny final merge), then the
    single wide row is turned into rows.  ``stddev`` is the sample standard
    deviation, as in ``describe``; the mean comes from an exact sum.
    """
    cols = cols or PROFILE_COLUMNS
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(name).alias("summary"),
                F.col(f"`{c}.{name}`").alias("value"),
            )
            for c in cols
            for name in PROFILE_STATS
        ]
    )
    return _statistics(df, cols, digits).select(F.inline(rows))


def wide_profile(
    df: DataFrame, cols: list[str] | None = None, digits: int = 4
) -> DataFrame:
    """The shape of ``describe``, numeric: (summary, one column per input)."""
    cols = cols or PROFILE_COLUMNS
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("summary"), *(F.col(f"`{c}.{name}`").alias(c) for c in cols)
            )
            for name in PROFILE_STATS
        ]
    )
    return _statistics(df, cols, digits).select(F.inline(rows))


def _statistics(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    """One row with a double ``column.statistic`` for each."""

    def stat(c: str, name: str) -> Column:
        if name == "mean":
            return exact_avg(c, digits)
        if name == "stddev":
            return F.round(F.stddev_samp(c), digits)
        return {"count": F.count, "min": F.min, "max": F.max}[name](c).cast("double")

    return df.agg(*[stat(c, name).alias(f"{c}.{name}") for c in cols for name in PROFILE_STATS])


# -- group-by steps --------------------------------------------------------


def sales_by(df: DataFrame, key: Column | str, *averages: str) -> DataFrame:
    """The shared core: transactions, exact revenue and exact sums of
    ``averages`` (``_sum.<column>``, ``_n.<column>``) per key."""
    return df.groupBy(key).agg(*sales_sums(*averages))


def sales_sums(*averages: str) -> list[Column]:
    return [
        F.count("transaction_id").alias("_transactions"),
        F.sum(exact("total_amount")).alias("_sum.total_amount"),
        *(F.sum(exact(c)).alias(f"_sum.{c}") for c in averages if c != "total_amount"),
        *(F.count(c).alias(f"_n.{c}") for c in averages),
    ]


def revenue(name: str) -> Column:
    return rounded(F.col("`_sum.total_amount`"), 2).alias(name)


def average_of(column: str, digits: int = 2) -> Column:
    return quotient(F.col(f"`_sum.{column}`"), F.col(f"`_n.{column}`"), digits)


def category_columns(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "category", F.col("_transactions").alias("transactions"), revenue("total_revenue"),
        average_of("total_amount").alias("avg_transaction"),
        average_of("discount_pct").alias("avg_discount"),
    ).orderBy(F.desc("total_revenue"))


def region_columns(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "region", F.col("_transactions").alias("transactions"), revenue("total_revenue"),
        average_of("customer_age", 1).alias("avg_age"),
    ).orderBy(F.desc("total_revenue"))


def month_columns(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        year_month("_month").alias("year_month"), F.col("_transactions").alias("transactions"),
        revenue("revenue"),
    ).orderBy("year_month")


def age_columns(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "age_group", F.col("_transactions").alias("transactions"),
        average_of("total_amount").alias("avg_spend"), revenue("total_spend"),
    ).orderBy("age_group")


def payment_columns(grouped: DataFrame) -> DataFrame:
    return grouped.select(
        "payment_method", F.col("_transactions").alias("count"), revenue("total_revenue"),
        average_of("total_amount").alias("avg_amount"),
    ).orderBy(F.desc("count"))


def month_start() -> Column:
    """The month's first day: rows are grouped by a 4-byte date, and only the
    aggregated rows are formatted as text."""
    return F.trunc("date", "month").alias("_month")


def sales_by_category(df: DataFrame) -> DataFrame:
    return category_columns(sales_by(df, "category", "total_amount", "discount_pct"))


def sales_by_region(df: DataFrame) -> DataFrame:
    return region_columns(sales_by(df, "region", "customer_age"))


def monthly_trends(df: DataFrame) -> DataFrame:
    """Per ``yyyy-MM`` label; the labels sort as text."""
    return month_columns(sales_by(df, month_start()))


def age_group_analysis(df: DataFrame) -> DataFrame:
    return age_columns(sales_by(df, age_group("customer_age").alias("age_group"), "total_amount"))


def payment_analysis(df: DataFrame) -> DataFrame:
    return payment_columns(sales_by(df, "payment_method", "total_amount"))


def category_value_counts(df: DataFrame) -> DataFrame:
    """Rows per category, most frequent first."""
    return df.groupBy("category").count().orderBy(F.desc("count"), "category")


# -- products --------------------------------------------------------------

def _top_order() -> list:
    return [F.desc("revenue"), F.asc("category"), F.asc("product_name")]


def top_products(df: DataFrame, n: int = 20) -> DataFrame:
    """Top ``n`` (category, product) pairs by rounded revenue."""
    return (
        df.groupBy("category", "product_name")
        .agg(
            exact_sum("total_amount").alias("revenue"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy(*_top_order())
        .limit(n)
    )


def top_products_with_discount(df: DataFrame, n: int = 20) -> DataFrame:
    """Top products plus their category's average discount, in one pass.

    Same rows as a left join of ``top_products`` with the per-category
    average discount (a NULL category matches nothing, so its discount is
    NULL), planned as a single linear chain over the fact table, with no
    second pass and nothing broadcast:

    1. one grouping-sets aggregate yields the (category, product) rows and
       the per-category rows together (partial aggregation in every task);
    2. per category, ``row_number <= n + 1`` keeps the category row (ordered
       first) and that category's top ``n`` products.  The global top ``n`` is
       contained in the union of the per-category ones, and Catalyst runs
       this filter as ``WindowGroupLimit`` before the shuffle, so at most
       ``n + 1`` rows per category leave each task;
    3. a second window on the same partitioning copies the category average
       onto its product rows, and a final top ``n`` picks the answer.

    ``top_products_with_lookup`` keeps the shape of a join instead.
    """
    levels = df.groupingSets(
        [["category", "product_name"], ["category"]], "category", "product_name"
    ).agg(
        F.grouping_id().alias("_gid"),
        F.sum(exact("total_amount")).alias("_revenue"),
        F.sum("quantity").alias("units_sold"),
        F.sum(exact("discount_pct")).alias("_disc_sum"),
        F.count("discount_pct").alias("_disc_n"),
    )
    staged = levels.select(
        "category",
        "product_name",
        (F.col("_gid") != 0).alias("_is_cat"),
        rounded(F.col("_revenue"), 2).alias("revenue"),
        "units_sold",
        quotient(F.col("_disc_sum"), F.col("_disc_n")).alias("_avg"),
    )
    ranked = Window.partitionBy("category").orderBy(
        F.desc("_is_cat"), F.desc("revenue"), F.asc("product_name")
    )
    cat_avg = F.max(F.when(F.col("_is_cat"), F.col("_avg"))).over(
        Window.partitionBy("category")
    )
    return (
        staged.withColumn("_rn", F.row_number().over(ranked))
        .filter(F.col("_rn") <= n + 1)
        .withColumn("avg_discount", F.when(F.col("category").isNotNull(), cat_avg))
        .filter(~F.col("_is_cat"))
        .select("category", "product_name", "revenue", "units_sold", "avg_discount")
        .orderBy(*_top_order())
        .limit(n)
    )


def top_products_with_lookup(
    df: DataFrame, category_stats: DataFrame | None = None, n: int = 20
) -> DataFrame:
    """The same as a join: top products LEFT JOIN a category table.

    ``category_stats`` is a ``sales_by_category`` result the caller already
    holds.  Without one, both sides come from one aggregate per product (the
    category level is rolled up from it, and Spark reuses its shuffle), so the
    table is read once.  The join is the planner's: adaptive execution
    broadcasts the lookup when its measured size allows.
    """
    products = df.groupBy("category", "product_name").agg(
        F.sum(exact("total_amount")).alias("_revenue"),
        F.sum("quantity").alias("units_sold"),
        F.sum(exact("discount_pct")).alias("_sum"),
        F.count("discount_pct").alias("_n"),
    )
    if category_stats is None:
        lookup = products.groupBy("category").agg(
            quotient(F.sum("_sum"), F.sum("_n")).alias("avg_discount"))
    else:
        lookup = category_stats.select("category", "avg_discount")
    top = (
        products.select(
            "category", "product_name", rounded(F.col("_revenue"), 2).alias("revenue"), "units_sold")
        .orderBy(*_top_order())
        .limit(n)
    )
    return (
        top.join(lookup, on="category", how="left")
        .select("category", "product_name", "revenue", "units_sold", "avg_discount")
        .orderBy(*_top_order())
    )


# -- ranking ---------------------------------------------------------------


def window_ranking(df: DataFrame, top: int = 3) -> DataFrame:
    """Top ``top`` transactions per category by amount, ties kept (``rank``).

    The ``rank <= top`` filter sits directly on the window, so Catalyst
    plans ``WindowGroupLimit`` before the shuffle: each task sends on only
    its top rows per category (plus ties at the cut), and a hot category
    costs no more than a cold one.  Ties are part of the answer; if a huge
    number of rows tie at the cut, the output itself is that large.
    """
    w = Window.partitionBy("category").orderBy(F.desc("total_amount"))
    return (
        df.select("category", "product_name", "total_amount")
        .withColumn("rank", F.rank().over(w))
        .filter(F.col("rank") <= top)
        .select(
            "category",
            "product_name",
            "total_amount",
            F.col("rank").cast("bigint").alias("rank"),
        )
        .orderBy("category", "rank")
    )


# -- a look at the table ----------------------------------------------------


def table_head(df: DataFrame, n: int = 3) -> DataFrame:
    """The first ``n`` rows in the order of all columns."""
    return df.orderBy(*df.columns).limit(n)


def column_values(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, non_null) of the table's columns.

    The values are counted in one pass, and the one row of counts is unfolded.
    """
    counts = df.agg(*(F.count(F.col(c)).alias(str(i)) for i, c in enumerate(df.columns)))
    told = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                     F.col(str(i)).alias("non_null")) for i, (c, t) in enumerate(df.dtypes)]
    return counts.select(F.inline(F.array(*told))).orderBy("position")


def column_types(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type) of the table's columns."""
    return column_values(df).drop("non_null")
