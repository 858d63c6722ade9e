"""Column expressions shared by the report steps.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age bands of the report, as upper bounds (exclusive)
# and labels, checked in this order.  Anything else, NULL included, is "55+".
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_DEFAULT = "55+"


def age_group(age: Column | str) -> Column:
    """Multi-branch CASE over the age bands.

    A NULL age fails every ``<`` test, so it falls through to the default,
    and an age under 18 lands in the first band: both as in the reference.
    """
    age = F.col(age) if isinstance(age, str) else age
    expr = None
    for bound, label in AGE_BANDS:
        expr = F.when(age < bound, label) if expr is None else expr.when(age < bound, label)
    return expr.otherwise(AGE_DEFAULT)


def year_month(date: Column | str) -> Column:
    """``yyyy-MM`` text label of a date or timestamp; sorts lexically."""
    date = F.col(date) if isinstance(date, str) else date
    return F.date_format(date, "yyyy-MM")


def to_cents(amount: Column) -> Column:
    """A non-negative amount in hundredths, rounded half up, as bigint.

    ``floor(x * 100 + 0.5)`` is plain IEEE arithmetic: every engine gets the
    same integer, and Spark keeps it in generated code.  (``round`` on a
    double goes through ``BigDecimal`` per row, and engines disagree on
    exact halves after scaling.)
    """
    return F.floor(amount * 100 + 0.5)


def line_total(price: Column, discount: Column) -> Column:
    """Net line amount: price less discount, rounded half up to cents.

    Computed in integer cents: ``(cents * (100 - pct) + 50) div 100``.  The
    division by 100 is exact in a double for any value below 2^53, so the
    floor of it is the integer quotient.
    """
    gross = to_cents(price)
    pct = to_cents(discount)
    net_cents = F.floor((gross * (F.lit(100) - pct) + 50) / 100)
    return net_cents.cast("double") / 100


def exact(values: Column | str) -> Column:
    """A number as a decimal with six places, so that sums of it are exact.

    A sum of doubles depends on the order in which partitions are merged; a
    sum of decimals does not.  ``decimal(18,6)`` holds amounts up to 10^12 and
    widens by ten digits in a sum.
    """
    x = F.col(values) if isinstance(values, str) else values
    return x.cast("decimal(18,6)")


def exact_sum(values: Column | str, digits: int = 2) -> Column:
    """Aggregate: the sum, rounded half away from zero, as a double."""
    return rounded(F.sum(exact(values)), digits)


def exact_avg(values: Column | str, digits: int = 2) -> Column:
    """Aggregate: the average of the exact sum, rounded half away from zero."""
    x = F.col(values) if isinstance(values, str) else values
    return quotient(F.sum(exact(x)), F.count(x), digits)


def quotient(total: Column, n: Column, digits: int = 2) -> Column:
    """An exact sum over a count, rounded half away from zero; NULL for no values.

    A decimal division keeps as few as six digits and rounding its result would
    round twice.  So the rounded quotient is taken as a whole number instead:
    ``floor(|total| * 10^digits / n + 1/2)``, over one common denominator.
    """
    n = F.nullif(n, F.lit(0)).cast("decimal(19,0)")
    size = F.abs(total).cast("decimal(30,6)") * F.lit(2 * 10**digits).cast("decimal(6,0)")
    whole = F.call_function("div", size + n, n * F.lit(2).cast("decimal(1,0)"))
    return F.signum(total) * whole / F.lit(10.0**digits)


def rounded(value: Column, digits: int) -> Column:
    """A decimal rounded half away from zero, as a double."""
    return F.round(value, digits).cast("double")
