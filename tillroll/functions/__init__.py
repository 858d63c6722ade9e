"""Built-in column expressions used by the operators."""

from tillroll.functions.columns import (
    AGE_BANDS,
    AGE_DEFAULT,
    age_group,
    exact,
    exact_avg,
    exact_sum,
    line_total,
    quotient,
    rounded,
    to_cents,
    year_month,
)

__all__ = [
    "AGE_BANDS", "AGE_DEFAULT", "age_group", "exact", "exact_avg", "exact_sum", "line_total",
    "quotient", "rounded", "to_cents", "year_month",
]
