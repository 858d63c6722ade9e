"""Reports over nested documents: orders with their lines, conversations with their turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import exact_sum, line_total, to_cents
from tillroll.session import scratch_path
from tillroll.sources.documents import (
    MAX_ITEMS,
    document_schema,
    read_documents,
    to_documents,
    unfold,
    write_documents,
)
from tillroll.sources.transactions import testdata_table

ORDER_KEY, LINE_ORDER = ["order_id"], ["line"]
LINE_FIELDS = ["part_id", "quantity", "discount_pct", "total_amount"]


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as they go into documents; one scan, no join."""
    return testdata_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part_id"), F.col("l_quantity").cast("int").alias("quantity"),
        to_cents(F.col("l_discount")).cast("int").alias("discount_pct"),
        line_total(F.col("l_extendedprice"), F.col("l_discount")).alias("total_amount"))


def nested(
    rows: DataFrame, key: list[str], order: list[str], fields: list[str], *, max_items: int = MAX_ITEMS
) -> DataFrame:
    """The rows as documents, written as JSON to the shared folder and read again."""
    spark = rows.sparkSession
    docs = to_documents(rows, key, order, fields, max_items=max_items)
    path = write_documents(docs, scratch_path(spark, "documents"))
    return read_documents(spark, path, document_schema(rows.schema, key, order, fields))


def lines_by_position(docs: DataFrame) -> DataFrame:
    """Lines, quantity, revenue and average discount by the line's number."""
    return unfold(docs).groupBy("line").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("quantity"),
        exact_sum("total_amount").alias("revenue"),
        F.sum("discount_pct").alias("discount_points"),
    ).orderBy("line")


def order_sizes(docs: DataFrame) -> DataFrame:
    """How many orders have how many lines, what those orders are worth, and the
    revenue of their first lines; read from the arrays without unfolding them.

    Parts of one order are added up first.
    """
    cents = F.aggregate(
        "items", F.lit(0).cast("decimal(28,2)"),
        lambda total, x: (total + x["total_amount"].cast("decimal(18,2)")).cast("decimal(28,2)"))
    per_order = docs.groupBy("order_id").agg(
        F.sum(F.size("items")).alias("lines"), F.sum(cents).alias("_worth"),
        F.min(F.element_at("items", 1)).alias("_first"))
    return per_order.groupBy("lines").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("_worth").cast("double").alias("revenue"),
        exact_sum("_first.total_amount").alias("first_line_revenue"),
    ).orderBy("lines")


def turns_by_role(docs: DataFrame) -> DataFrame:
    """Turns, characters and opening turns of each role, over documents of conversations."""
    return unfold(docs).groupBy("role").agg(
        F.count(F.lit(1)).alias("turns"), F.sum(F.char_length("text")).alias("chars"),
        F.count_if((F.col("part") == 0) & (F.col("item_index") == 0)).alias("openings"),
    ).orderBy("role")
