"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each one reads the whole of the given tables; nothing is sampled, capped or
filtered to keep it cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import age_group
from tillroll.operators import compare, documents, report
from tillroll.operators.joins import broadcast_if_small
from tillroll.plans.onepass import grouped_sales
from tillroll.plans.tuned import held_while, materialize
from tillroll.session import scratch_path
from tillroll.sources.sinks import stored, write_csv
from tillroll.sources.transactions import read_transactions, testdata_table, testdata_transactions

Query = Callable[[SparkSession, str], DataFrame]


def _on_transactions(step: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(testdata_transactions(spark, sf_dir))

    run.__name__ = step.__name__
    return run


def _shape(df: DataFrame) -> DataFrame:
    # The partition count depends on the session, not the data: the oracle
    # checks rows and columns.
    return report.load_shape(df).select("row_count", "column_count")


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the category aggregate as one CSV file, read it back."""
    stats = report.sales_by_category(testdata_transactions(spark, sf_dir))
    path = write_csv(stats, scratch_path(spark, "category_stats"), single_file=True)
    schema = "category string, transactions bigint, total_revenue double, " \
        "avg_transaction double, avg_discount double"
    return spark.read.schema(schema).csv(path, header=True)


def _on_csv(step: Callable[[DataFrame], DataFrame]) -> Query:
    """The step over the whole transaction table written as CSV, many files."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = write_csv(testdata_transactions(spark, sf_dir), scratch_path(spark, "csv"))
        return step(read_transactions(spark, path))

    return run


def _on_fact(step: Callable[[DataFrame], DataFrame]) -> Query:
    """The step over the fact table, built once and held in the shared folder."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, _ = materialize(testdata_transactions(spark, sf_dir), "table")
        return step(fact)

    return run


def _on_cache(step: Callable[[DataFrame], DataFrame]) -> Query:
    """The step over the fact table held in the executors' memory and disks, for
    as long as somebody holds the result."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        fact, _ = materialize(testdata_transactions(spark, sf_dir), "cache")
        return held_while(step(fact), fact)

    return run


def _cached_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top products over the cached fact table, joined to a persisted category
    table that is hinted for broadcast once its stored size is known."""
    fact, _ = materialize(testdata_transactions(spark, sf_dir), "cache")
    lookup, _ = materialize(report.sales_by_category(fact), "cache")
    lookup.count()
    return held_while(report.top_products_with_lookup(fact, broadcast_if_small(lookup)), fact, lookup)


def _order_documents(step: Callable[[DataFrame], DataFrame], max_items: int = documents.MAX_ITEMS) -> Query:
    """The step over one JSON document per order, its lines as an array."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return step(documents.nested(
            documents.order_lines(spark, sf_dir), documents.ORDER_KEY, documents.LINE_ORDER,
            documents.LINE_FIELDS, max_items=max_items))

    return run


def _conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles over one JSON document per conversation, its turns as an array."""
    rows = testdata_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return documents.turns_by_role(documents.nested(rows, ["conv_id"], ["turn"], ["role", "text"]))


def _payment_aliases_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment labels without their number, the aliases taken from the orders."""
    label = F.col("o_orderpriority")
    names = testdata_table(spark, sf_dir, "orders").select(label.alias("name")).distinct().select(
        "name", F.when(_is_pressing(F.col("name")), F.substring_index("name", "-", -1)).alias("alias"))
    return _by_payment(compare.with_aliases(testdata_transactions(spark, sf_dir), "payment_method", names))


def _is_pressing(label: Column) -> Column:
    return F.substring(label, 1, 1).isin("1", "2", "3")


def _by_payment(df: DataFrame) -> DataFrame:
    return compare.revenue_by(df, "payment_method").orderBy("payment_method")


# Two labels that mean the same to the report.
PAYMENT_ALIASES = {"1-URGENT": "first", "2-HIGH": "first", "5-LOW": "last"}


def _payment_aliases(df: DataFrame) -> DataFrame:
    return _by_payment(compare.with_aliases(df, "payment_method", PAYMENT_ALIASES))


def _age_region_matrix(df: DataFrame) -> DataFrame:
    """Revenue by age group and region."""
    cells = compare.revenue_by(df, age_group("customer_age").alias("age_group"), "region")
    return compare.pivot_matrix(stored(cells, "matrix-cells"), "age_group", "region", "revenue").orderBy("age_group")


QUERIES: dict[str, Query] = {
    "load_shape": _on_transactions(_shape),
    "basic_stats": _on_transactions(report.column_profile),
    "basic_stats_wide": _on_transactions(report.wide_profile),
    "sales_by_category": _on_transactions(report.sales_by_category),
    "sales_by_region": _on_transactions(report.sales_by_region),
    "top_products": _on_transactions(report.top_products),
    "top_products_with_discount": _on_transactions(report.top_products_with_discount),
    "top_products_with_broadcast": _on_transactions(report.top_products_with_lookup),
    "monthly_trends": _on_transactions(report.monthly_trends),
    "age_group_analysis": _on_transactions(report.age_group_analysis),
    "payment_analysis": _on_transactions(report.payment_analysis),
    "window_ranking": _on_transactions(report.window_ranking),
    "grouped_sales": _on_transactions(grouped_sales),
    "category_value_counts": _on_transactions(report.category_value_counts),
    "transactions_head": _on_transactions(report.table_head),
    "csv_round_trip": _csv_round_trip,
    "csv_transactions": _on_csv(report.sales_by_category),
    "csv_load_shape": _on_csv(_shape),
    "tuned_grouped_sales": _on_fact(grouped_sales),
    "tuned_top_products": _on_fact(report.top_products_with_lookup),
    "tuned_window_ranking": _on_fact(report.window_ranking),
    "cached_grouped_sales": _on_cache(grouped_sales),
    "cached_window_ranking": _on_cache(report.window_ranking),
    "cached_top_products": _cached_top_products,
    "order_documents": _order_documents(documents.lines_by_position),
    "order_documents_in_parts": _order_documents(documents.lines_by_position, max_items=3),
    "order_sizes": _order_documents(documents.order_sizes),
    "conversation_documents": _conversation_documents,
    "year_over_year": _on_transactions(compare.year_over_year),
    "category_month_grid": _on_transactions(compare.category_month_grid),
    "payment_day_grid": _on_transactions(compare.payment_day_grid),
    "month_region_matrix": _on_transactions(compare.month_region_matrix),
    "age_region_matrix": _on_transactions(_age_region_matrix),
    "payment_aliases": _on_transactions(_payment_aliases),
    "payment_aliases_table": _payment_aliases_table,
    "payment_summary": _on_transactions(compare.payment_summary),
    "daily_sales": _on_transactions(compare.daily_sales),
    "column_types": _on_transactions(report.column_values),
}
