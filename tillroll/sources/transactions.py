"""Readers for the transaction fact table.

``read_transactions`` reads the reference's own layout (CSV with a header,
or parquet) from any Hadoop-compatible URI.  ``testdata_transactions``
derives the same eleven columns from a TPC-H-like star schema, which is the
data the checks and the benchmark run on.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import line_total, to_cents
from tillroll.schemas import TPCH, TRANSACTION_COLUMNS, TRANSACTIONS

def read_transactions(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    infer_schema: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Read the flat transaction table.

    CSV columns are found by the names in the header, in any order, and cast to
    the declared types; schema inference costs a full extra pass over the file,
    so it is opt-in.  A cell that does not fit its type becomes NULL, or fails
    the job when ``strict``; ``bad_cells`` counts such rows.  Files of one
    folder must have the same header: each task compares its file's with the
    first one's and fails the job where they differ, rather than misread it.
    Folders of different headers are read apart (``read_folders``).
    """
    reader = spark.read
    if fmt == "csv":
        if infer_schema:
            return reader.csv(path, header=True, inferSchema=True)
        raw = _raw_csv(spark, path)
        cast = "cast" if strict else "try_cast"
        return raw.select([
            F.expr(f"{cast}(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name)
            for f in TRANSACTIONS.fields
        ])
    if fmt == "parquet":
        return reader.parquet(path)
    if fmt == "json":
        return reader.schema(TRANSACTIONS).json(path)
    raise ValueError(f"unknown format {fmt!r}")


def read_folders(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """The rows of several inputs, each read by its own header."""
    parts = [read_transactions(spark, p, **options) for p in paths]
    return functools.reduce(DataFrame.unionByName, parts)


def _raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header that every file must have."""
    first = spark.read.csv(path, header=True)
    missing = [f.name for f in TRANSACTIONS.fields if f.name not in first.columns]
    if missing:
        raise ValueError(f"the header lacks {', '.join(missing)}")
    # A task compares the names of the columns it parses, in each file it opens.
    return spark.read.schema(first.schema).options(header=True, enforceSchema=False).csv(path)


def bad_cells(spark: SparkSession, path: str) -> DataFrame:
    """One row: rows of the CSV, and rows with a cell that does not fit its type."""
    raw = _raw_csv(spark, path)
    bad = F.lit(False)
    for f in TRANSACTIONS.fields:
        typed = F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})")
        bad = bad | (F.col(f.name).isNotNull() & typed.isNull())
    return raw.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(bad).alias("bad_rows"))


def testdata_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the TPC-H-like tables, read with its declared schema."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in TPCH:
        return spark.read.schema(TPCH[name]).parquet(path)
    return spark.read.parquet(path)


def testdata_transactions(
    spark: SparkSession, sf_dir: str, read: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """One transaction per line item of the TPC-H-like tables.

    Mapping: id = order key, date = order date, category = part type,
    product = part name, price = part retail price, discount in whole
    percent, total = extended price net of discount (integer cents, rounded
    half up per row), region = the customer's region, age = 18 + custkey
    mod 58, payment method = order priority.

    Join order is written out on purpose (Catalyst keeps it without CBO):
    the two tiny geography tables are folded into ``customer`` first, the
    enriched customers into ``orders``, and only then is ``lineitem`` (the
    one big side) joined, on the order key and then on the part key, both
    as sort-merge joins.  The other joins are the planner's: it broadcasts a
    side only when its size, known from the file statistics, is under
    ``spark.sql.autoBroadcastJoinThreshold`` (nation and region always are).
    Column pruning reaches every scan, so a step that needs three columns
    reads three columns plus the join keys.

    ``read`` maps a table name to a DataFrame, for inputs laid out
    differently (``tillroll.sources.layout.bucket_testdata``: a lineitem
    bucketed on the order key joins orders without being shuffled).
    """
    t = read or (lambda name: testdata_table(spark, sf_dir, name))

    region = t("region").select("r_regionkey", "r_name")
    nation = t("nation").select("n_nationkey", "n_regionkey")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "r_name"
    )

    customer = (
        t("customer")
        .select("c_custkey", "c_nationkey")
        .join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.col("r_name").alias("region"),
            (F.lit(18) + F.col("c_custkey") % 58).cast("int").alias("customer_age"),
        )
    )
    orders = (
        t("orders")
        .select(
            "o_orderkey",
            "o_custkey",
            F.col("o_orderdate").cast("date").alias("date"),
            F.col("o_orderpriority").alias("payment_method"),
        )
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    part = t("part").select(
        "p_partkey",
        F.col("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("unit_price"),
    )
    # Per-row values are computed in the scan, before any shuffle: the net
    # total and the whole-percent discount travel instead of the raw price
    # and discount, and the order date as a date rather than a timestamp.
    lineitem = t("lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_quantity").cast("int").alias("quantity"),
        to_cents(F.col("l_discount")).cast("int").alias("discount_pct"),
        line_total(F.col("l_extendedprice"), F.col("l_discount")).alias("total_amount"),
    )

    # lineitem is the table that grows without bound: both of its joins are
    # shuffle (sort-merge) joins at every size, so the plan tested on a
    # laptop is the plan that runs at 100 TB, the join work is spread over
    # all shuffle partitions even when an input file is a single row group,
    # and AQE can split a skewed key (a hot order or part) on the lineitem
    # side.  The smaller joins are left to the planner.
    fact = lineitem.join(
        orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    ).join(part.hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
    return fact.withColumnRenamed("l_orderkey", "transaction_id").select(*TRANSACTION_COLUMNS)


# The same view as SQL text for DuckDB (``//`` divides integers).  The oracle
# queries are written on top of it.
TRANSACTIONS_VIEW_SQL = """
SELECT l.l_orderkey AS transaction_id, CAST(o.o_orderdate AS DATE) AS date,
  p.p_type AS category, p.p_name AS product_name,
  CAST(l.l_quantity AS INT) AS quantity, p.p_retailprice AS unit_price,
  CAST(FLOOR(l.l_discount * 100 + 0.5) AS INT) AS discount_pct,
  CAST((CAST(FLOOR(l.l_extendedprice * 100 + 0.5) AS BIGINT)
     * (100 - CAST(FLOOR(l.l_discount * 100 + 0.5) AS BIGINT)) + 50) // 100 AS DOUBLE) / 100
     AS total_amount,
  r.r_name AS region, CAST(18 + c.c_custkey % 58 AS INT) AS customer_age,
  o.o_orderpriority AS payment_method
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""
