"""Synthetic transactions, generated as a Spark job.

Each column is a pure function of the row id: draws come from md5 of
``"<id>|<salt>"``, four 32-bit draws per digest, so the output does not
depend on how ``spark.range`` splits the ids, and the same rows can be
rebuilt in SQL by any engine with md5 (see ``generated_transactions_sql``).
Money is computed in integer cents and rounded half up, so there is no
binary-float rounding anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import default_parallelism

# These must equal the reference generator's lists.
START_DATE = "2022-01-01"
DAYS = 730
CATEGORIES = ["Electronics", "Clothing", "Food & Beverages", "Books", "Sports & Outdoors", "Home & Garden"]
REGIONS = ["North", "South", "East", "West", "Central"]
PAYMENT_METHODS = ["Cash", "Credit Card", "Debit Card", "Online Transfer", "Mobile Payment"]
PRODUCTS = {
    "Electronics": ["Laptop", "Smartphone", "Tablet", "Headphones", "Smart Watch", "Camera"],
    "Clothing": ["T-Shirt", "Jeans", "Dress", "Jacket", "Shoes", "Hat"],
    "Food & Beverages": ["Coffee", "Tea", "Snacks", "Juice", "Energy Drink", "Water"],
    "Books": ["Novel", "Textbook", "Magazine", "Comic", "Cookbook", "Biography"],
    "Sports & Outdoors": ["Running Shoes", "Yoga Mat", "Bicycle", "Tent", "Backpack", "Weights"],
    "Home & Garden": ["Plant Pot", "Tool Set", "Lamp", "Cushion", "Curtains", "Rug"],
}
PRICE_RANGES = {
    "Electronics": (50.0, 2000.0),
    "Clothing": (10.0, 200.0),
    "Food & Beverages": (1.0, 30.0),
    "Books": (5.0, 80.0),
    "Sports & Outdoors": (15.0, 500.0),
    "Home & Garden": (5.0, 150.0),
}
DISCOUNTS = [0, 5, 10, 15, 20, 25]
QUANTITY_MAX = 10
AGE_MIN, AGE_MAX = 18, 75

# Derived, in category order: products per category slot, and each price
# range in whole cents with inclusive bounds.
_PRODUCT_LISTS = [PRODUCTS[c] for c in CATEGORIES]
PRICE_CENTS = [(round(PRICE_RANGES[c][0] * 100), round(PRICE_RANGES[c][1] * 100)) for c in CATEGORIES]

# (salt, block) of each draw; a block is 8 hex digits of the digest.
_DRAWS = {
    "day": ("a", 0),
    "category": ("a", 1),
    "product": ("a", 2),
    "price": ("a", 3),
    "quantity": ("b", 0),
    "discount": ("b", 1),
    "region": ("b", 2),
    "age": ("b", 3),
    "payment": ("c", 0),
}


def _draw(id_col: Column, name: str) -> Column:
    salt, block = _DRAWS[name]
    digest = F.md5(F.concat(id_col.cast("string"), F.lit(f"|{salt}")))
    return F.conv(F.substring(digest, 1 + 8 * block, 8), 16, 10).cast("bigint")


def _lit_array(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


# Rows per generating task when the caller does not choose: large enough
# to amortise task start, small enough that one task's output (~100 bytes a
# row) stays well under a typical 128 MB file split.
ROWS_PER_TASK = 1_000_000


def gen_transactions(
    spark: SparkSession, n: int, partitions: int | None = None
) -> DataFrame:
    """``n`` transactions with ids 1..n, spread over ``partitions`` tasks.

    By default the task count grows with ``n`` (one per ``ROWS_PER_TASK``
    rows, at least the cluster's default parallelism), so generating 100x
    the rows uses 100x the tasks, not 100x longer tasks.
    """
    if partitions is None:
        partitions = max(default_parallelism(spark), -(-n // ROWS_PER_TASK))
    ids = spark.range(1, n + 1, 1, partitions).withColumnRenamed("id", "transaction_id")
    tid = F.col("transaction_id")
    cat_idx = (_draw(tid, "category") % len(CATEGORIES)).cast("int")
    products = F.array(*[_lit_array(p) for p in _PRODUCT_LISTS])
    lo = _lit_array([c[0] for c in PRICE_CENTS])
    hi = _lit_array([c[1] for c in PRICE_CENTS])

    staged = ids.select(
        "transaction_id",
        cat_idx.alias("_cat"),
        _draw(tid, "day").alias("_day"),
        _draw(tid, "product").alias("_prod"),
        _draw(tid, "price").alias("_price"),
        (F.lit(1) + _draw(tid, "quantity") % QUANTITY_MAX).cast("int").alias("quantity"),
        F.element_at(_lit_array(DISCOUNTS), (_draw(tid, "discount") % len(DISCOUNTS) + 1).cast("int"))
        .alias("discount_pct"),
        F.element_at(_lit_array(REGIONS), (_draw(tid, "region") % len(REGIONS) + 1).cast("int"))
        .alias("region"),
        (F.lit(AGE_MIN) + _draw(tid, "age") % (AGE_MAX - AGE_MIN + 1)).cast("int").alias("customer_age"),
        F.element_at(
            _lit_array(PAYMENT_METHODS), (_draw(tid, "payment") % len(PAYMENT_METHODS) + 1).cast("int")
        ).alias("payment_method"),
    )
    slot = F.col("_cat") + 1
    lo_c, hi_c = F.element_at(lo, slot), F.element_at(hi, slot)
    cents = (lo_c + F.col("_price") % (hi_c - lo_c + 1)).cast("bigint")
    total_cents = F.floor(
        (cents * F.col("quantity") * (F.lit(100) - F.col("discount_pct")) + 50) / 100
    )
    return staged.select(
        "transaction_id",
        F.date_add(F.lit(START_DATE).cast("date"), (F.col("_day") % DAYS).cast("int")).alias("date"),
        F.element_at(_lit_array(CATEGORIES), slot).alias("category"),
        F.element_at(F.element_at(products, slot), (F.col("_prod") % 6 + 1).cast("int"))
        .alias("product_name"),
        "quantity",
        (cents.cast("double") / 100).alias("unit_price"),
        "discount_pct",
        (total_cents.cast("double") / 100).alias("total_amount"),
        "region",
        "customer_age",
        "payment_method",
    )


def gen_like_table(spark: SparkSession, table: DataFrame, partitions: int | None = None) -> DataFrame:
    """As many transactions as ``table`` has rows (a parquet count is metadata)."""
    return gen_transactions(spark, table.count(), partitions)


# -- the same rows as SQL (DuckDB dialect), for the oracle ---------------------


def _sql_list(values: list) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _sql_draw(name: str) -> str:
    salt, block = _DRAWS[name]
    return (
        f"CAST(('0x' || substr(md5(CAST(id AS VARCHAR) || '|{salt}'), {1 + 8 * block}, 8)) AS BIGINT)"
    )


def generated_transactions_sql(count_table: str = "lineitem") -> str:
    """DuckDB text for ``gen_transactions`` with n = rows of ``count_table``."""
    products = "[" + ", ".join(_sql_list(p) for p in _PRODUCT_LISTS) + "]"
    lo = _sql_list([c[0] for c in PRICE_CENTS])
    hi = _sql_list([c[1] for c in PRICE_CENTS])
    return f"""SELECT transaction_id,
  DATE '{START_DATE}' + CAST(day_h % {DAYS} AS INTEGER) AS date,
  ({_sql_list(CATEGORIES)})[slot] AS category,
  ({products})[slot][CAST(prod_h % 6 + 1 AS INTEGER)] AS product_name,
  quantity,
  CAST(cents AS DOUBLE) / 100 AS unit_price,
  discount_pct,
  CAST((cents * quantity * (100 - discount_pct) + 50) // 100 AS DOUBLE) / 100 AS total_amount,
  region, customer_age, payment_method
FROM (
  SELECT *, CAST(({lo})[slot] + price_h % (({hi})[slot] - ({lo})[slot] + 1) AS BIGINT) AS cents
  FROM (
    SELECT id AS transaction_id,
      CAST({_sql_draw('category')} % {len(CATEGORIES)} + 1 AS INTEGER) AS slot,
      {_sql_draw('day')} AS day_h,
      {_sql_draw('product')} AS prod_h,
      {_sql_draw('price')} AS price_h,
      CAST(1 + {_sql_draw('quantity')} % {QUANTITY_MAX} AS INTEGER) AS quantity,
      ({_sql_list(DISCOUNTS)})[CAST({_sql_draw('discount')} % {len(DISCOUNTS)} + 1 AS INTEGER)] AS discount_pct,
      ({_sql_list(REGIONS)})[CAST({_sql_draw('region')} % {len(REGIONS)} + 1 AS INTEGER)] AS region,
      CAST({AGE_MIN} + {_sql_draw('age')} % {AGE_MAX - AGE_MIN + 1} AS INTEGER) AS customer_age,
      ({_sql_list(PAYMENT_METHODS)})[CAST({_sql_draw('payment')} % {len(PAYMENT_METHODS)} + 1 AS INTEGER)]
        AS payment_method
    FROM range(1, (SELECT COUNT(*) FROM {count_table}) + 1) t(id)
  ) d
) p"""
