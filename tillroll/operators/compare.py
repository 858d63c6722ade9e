"""Comparison tables over transactions: pairs, grids, matrices, ordered members.

Every report here works on one aggregate of its input, and the big table is read
once.  Pairing joins the aggregate with itself, and Spark reuses its shuffle.
Where a dimension, a bound or a maximum is taken from the aggregate as well,
Spark would prune its columns and so compute it again: there it is written to
the shared folder first, small as it is (``sinks.stored``).

Dimensions come from the data.  Where a result is the product of two of them,
or has a column per member, the number of members is checked when the query runs
and too many fail it with a message; nothing is cut off.

A NULL key is a member of its own throughout, as in the group-bys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import exact_sum, year_month
from tillroll.operators.joins import broadcast_if_small
from tillroll.sources.sinks import stored

#: Members of a dimension that a grid's rows are multiplied by, and columns of a matrix.
MAX_MEMBERS, MAX_COLUMNS = 100_000, 1_000

#: Days as text.
ISO = "yyyy-MM-dd"

#: Aliases written into the plan as a literal; more belong in a table.
MAX_LITERAL = 500


def revenue_by(df: DataFrame, *keys: Column | str) -> DataFrame:
    """The aggregate the comparisons start from: keys, transactions, revenue."""
    return df.groupBy(*keys).agg(
        F.count("transaction_id").alias("transactions"), exact_sum("total_amount").alias("revenue"))


def guarded_ratio(value: Column, base: Column, empty: float | None = 1.0) -> Column:
    """``value / base``, or ``empty`` where the base is not above zero (or NULL)."""
    return F.when(base > 0, value / base).otherwise(F.lit(empty).cast("double"))


# -- pairing ----------------------------------------------------------------


def paired(sides: DataFrame, by: list[str], period: str, step: int, values: list[str]) -> DataFrame:
    """Each row of an aggregate beside the one of ``period + step`` with the same ``by``.

    Inner: only keys present on both sides.  ``sides`` must have at most one row
    per (``by``, ``period``), as an aggregate by them has.  Both sides are the
    same aggregate, whose shuffle is done once: that needs equal plans below it,
    hence one filter for both and comparisons that are null-safe throughout (any
    other would push a filter of its own into one side).  A NULL in ``by`` pairs
    with a NULL; a NULL period pairs with nothing.
    """
    sides = sides.filter(F.col(period).isNotNull())
    later = sides.select(
        *(F.col(c).alias(f"_{c}") for c in by), (F.col(period) - step).alias("_period"),
        *(F.col(v).alias(f"next_{v}") for v in values))
    match = F.col(period).eqNullSafe(F.col("_period"))
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return sides.join(later, match).drop("_period", *(f"_{c}" for c in by))


def year_over_year(df: DataFrame) -> DataFrame:
    """Category and month of a year against the same month of the next year.

    year, month, revenue and next_revenue, and their ratio (NULL when the
    earlier revenue is not above zero).  Months without sales in one of the two
    years have no row.
    """
    sides = revenue_by(
        df, "category", F.year("date").alias("year"), F.month("date").alias("month")
    ).select("category", "year", "month", "revenue")
    both = paired(sides, ["category", "month"], "year", 1, ["revenue"])
    return both.select(
        "category", "year", "month", "revenue", "next_revenue",
        guarded_ratio(F.col("next_revenue"), F.col("revenue"), None).alias("ratio"),
    ).orderBy("category", "year", "month")


# -- dense grid -------------------------------------------------------------


def _bounded(members: Column, limit: int, what: str) -> Column:
    """An array of members, or an error when the query runs and finds too many."""
    return F.when(F.size(members) <= limit, members).otherwise(F.raise_error(F.concat(
        F.lit(f"more than {limit} members of {what} for a grid: "), F.size(members).cast("string"))))


def dense_grid(
    cells: DataFrame, row: str, column: str, defaults: dict[str, float], *, max_members: int = MAX_MEMBERS
) -> DataFrame:
    """Every member of ``row`` with every member of ``column``; absent cells get defaults.

    ``cells`` has at most one row per (``row``, ``column``).  The members of
    ``column`` become one array, checked for its size, that each member of
    ``row`` is unfolded with; the grid is then left-joined to the cells.
    """
    empty = F.lit(None).cast(cells.schema[column].dataType)
    # collect_set leaves NULL out, so it is put back if it occurs.
    members = cells.agg(
        F.sort_array(F.collect_set(column)).alias("_known"), F.max(F.col(column).isNull()).alias("_null")
    ).select(F.when(F.col("_null"), F.array_append("_known", empty)).otherwise(F.col("_known")).alias("_all"))
    members = members.select(_bounded(F.col("_all"), max_members, column).alias("_all"))
    grid = cells.select(row).distinct().select(
        row, F.explode(members.scalar()).alias(column))
    own = cells.select(F.col(row).alias("_row"), F.col(column).alias("_column"), *defaults)
    joined = grid.join(
        own, F.col(row).eqNullSafe(F.col("_row")) & F.col(column).eqNullSafe(F.col("_column")), "left")
    return joined.select(row, column, *(
        F.coalesce(v, F.lit(d).cast(cells.schema[v].dataType)).alias(v) for v, d in defaults.items()))


def sales_grid(df: DataFrame, row: str, column: Column, name: str, *, max_members: int = MAX_MEMBERS) -> DataFrame:
    """Transactions and revenue of every ``row`` in every period ``column``: 0 where
    nothing was sold.

    ``ratio`` is the period's revenue against the one before it in the grid, 1.0
    where that is zero or there is none.
    """
    cells = stored(revenue_by(df, row, column.alias(name)), "grid-cells")
    grid = dense_grid(cells, row, name, {"transactions": 0, "revenue": 0.0}, max_members=max_members)
    before = F.lag("revenue", 1, 0.0).over(Window.partitionBy(row).orderBy(name))
    return grid.withColumn("previous", before).select(
        row, name, "transactions", "revenue",
        guarded_ratio(F.col("revenue"), F.col("previous")).alias("ratio"),
    ).orderBy(row, name)


def category_month_grid(df: DataFrame) -> DataFrame:
    return sales_grid(df, "category", year_month("date"), "year_month")


def payment_day_grid(df: DataFrame) -> DataFrame:
    return sales_grid(df, "payment_method", F.date_format("date", ISO), "day")


# -- pivot ------------------------------------------------------------------

#: Column of the NULL member.
NULL_COLUMN = "(null)"


def members_of(df: DataFrame, column: str, limit: int = MAX_COLUMNS) -> list[str]:
    """The members of a column as text, sorted, a NULL last; refused beyond ``limit``.

    At most ``limit + 1`` values reach the driver.
    """
    found = [r[0] for r in df.select(F.col(column).cast("string")).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{column} has more than {limit} members: too many columns for a matrix")
    if NULL_COLUMN in found and None in found:
        raise ValueError(f"{column} has NULL and the text {NULL_COLUMN!r}")
    return sorted(v for v in found if v is not None) + [NULL_COLUMN] * (None in found)


def pivot_matrix(
    cells: DataFrame, row: str, column: str, value: str, *, empty: float = 0.0,
    columns: list[str] | None = None, max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """One row per member of ``row``, one column per member of ``column``.

    ``cells`` is an aggregate with at most one row per (``row``, ``column``), so
    the pivot only rearranges it.  Without ``columns`` the members are looked up
    first (:func:`members_of`).  Cells that do not occur hold ``empty``.
    """
    columns = columns if columns is not None else members_of(cells, column, max_columns)
    name = F.coalesce(F.col(column).cast("string"), F.lit(NULL_COLUMN))
    wide = cells.select(row, name.alias("_member"), value).groupBy(row).pivot("_member", columns).agg(F.first(value))
    return wide.select(row, *(F.coalesce(F.col(_quoted(c)), F.lit(empty)).alias(c) for c in columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def month_region_matrix(df: DataFrame, regions: list[str] | None = None) -> DataFrame:
    """Revenue, months down and regions across, 0.0 where nothing was sold."""
    cells = revenue_by(df, year_month("date").alias("year_month"), "region")
    if regions is None:
        cells = stored(cells, "matrix-cells")
    return pivot_matrix(cells, "year_month", "region", "revenue", columns=regions).orderBy("year_month")


# -- aliases ----------------------------------------------------------------


def with_aliases(df: DataFrame, column: str, aliases: dict[str, str] | DataFrame) -> DataFrame:
    """``column`` with names replaced by their aliases; other names pass through.

    A dict becomes a literal map, evaluated in place.  A table (name, alias) is
    joined: broadcast if its planned size is small, else as the planner decides.
    If a name occurs twice in the table the first alias in order counts, so rows
    never multiply; a NULL alias leaves the name as it is.
    """
    if isinstance(aliases, dict):
        if len(aliases) > MAX_LITERAL:
            raise ValueError(f"more than {MAX_LITERAL} aliases: pass them as a table")
        if not aliases:
            return df
        mapped = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
        return df.withColumn(column, F.coalesce(F.element_at(mapped, F.col(column)), F.col(column)))
    name, alias = aliases.columns[:2]
    one = aliases.groupBy(F.col(name).alias("_name")).agg(F.min(alias).alias("_alias")).filter("_alias IS NOT NULL")
    return (
        df.join(broadcast_if_small(one), F.col(column) == F.col("_name"), "left")
        .withColumn(column, F.coalesce("_alias", column)).drop("_name", "_alias")
    )


# -- members in a fixed order -----------------------------------------------


def in_order(groups: DataFrame, key: str, members: list[str]) -> DataFrame:
    """The groups of ``members``, in that order; absent ones are rows of NULLs.

    Groups that are not listed are left out.  ``position`` counts from 1.
    """
    spark = groups.sparkSession
    listed = spark.range(1).select(
        F.posexplode(F.array(*map(F.lit, members)).cast("array<string>")).alias("_at", "_member"))
    values = [c for c in groups.columns if c != key]
    return (
        listed.join(groups, F.col("_member") == F.col(key), "left")
        .select((F.col("_at") + 1).alias("position"), F.col("_member").alias(key), *values)
        .orderBy("position")
    )


#: Order of the payment labels in the summary.
PAYMENT_ORDER = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT", "Cash"]


def payment_summary(df: DataFrame, members: list[str] | None = None) -> DataFrame:
    """Payment methods in a fixed order, each with the largest revenue of any group.

    Groups that are not listed count for the maximum.
    """
    groups = stored(revenue_by(df, "payment_method"), "payment-groups")
    largest = groups.agg(F.max("revenue")).scalar()
    return in_order(groups, "payment_method", members or PAYMENT_ORDER).withColumn("max_revenue", largest)


# -- calendar ---------------------------------------------------------------


def calendar(df: DataFrame, date: str = "date", *, max_days: int = MAX_MEMBERS) -> DataFrame:
    """(day_number, day): every day from the table's first to its last.

    Days are the first day plus a number of days.  A table without dates has none.
    """
    span = df.agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    days = F.datediff("_last", "_first")
    numbers = F.when(days < max_days, F.sequence(F.lit(0), days)).when(
        days.isNotNull(), F.raise_error(F.lit(f"more than {max_days} days from first to last")))
    return span.select("_first", F.explode(numbers).alias("day_number")).select(
        "day_number", F.date_add("_first", F.col("day_number")).alias("day"))


def daily_sales(df: DataFrame, *, due_days: int = 30) -> DataFrame:
    """Transactions and revenue of every day, days without sales included.

    Days and due days (``due_days`` later) are ISO text.  Rows without a date
    are on no day.
    """
    per_day = stored(revenue_by(df, "date"), "daily-sales")
    days = calendar(per_day).join(per_day, F.col("day") == F.col("date"), "left")
    return days.select(
        "day_number", F.date_format("day", ISO).alias("day"),
        F.date_format(F.date_add("day", due_days), ISO).alias("due"),
        F.coalesce("transactions", F.lit(0)).alias("transactions"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
    ).orderBy("day_number")
