"""Window specifications shared by the per-loan operators.

Every per-loan window uses the same partitioning and the same ordering, so the
window stages of the job share one hash partitioning by ``deal_id`` and one sort
by (``deal_id``, ``factor_date``): Catalyst plans no exchange and no re-sort
between them. Whole-loan aggregates use the shared ordering with an unbounded
frame, for that reason, instead of an unordered window. Frames are running or
whole-loan (linear per loan); a (current row, unbounded following) frame is
avoided because Spark recomputes it for every row.

Expressions are written as SQL text and parsed once each (see
``stagecraft.functions.dates``); two Column forms remain for the operators that
compose few expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

KEY = "deal_id"
DATE = "factor_date"

_SPEC = f"PARTITION BY {KEY} ORDER BY {DATE}"
BY_LOAN = f"OVER ({_SPEC})"
WHOLE_LOAN = f"OVER ({_SPEC} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
UP_TO_CURRENT = f"OVER ({_SPEC} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def trailing_sql(points: int) -> str:
    """The current row and the ``points - 1`` rows before it."""
    return f"OVER ({_SPEC} ROWS BETWEEN {points - 1} PRECEDING AND CURRENT ROW)"


def first_date_sql(cond: str) -> str:
    """Earliest ``factor_date`` of the loan where ``cond`` holds (NULL if none)."""
    return f"min(CASE WHEN {cond} THEN {DATE} END) {WHOLE_LOAN}"


def last_date_sql(cond: str) -> str:
    """Latest ``factor_date`` of the loan where ``cond`` holds (NULL if none)."""
    return f"max(CASE WHEN {cond} THEN {DATE} END) {WHOLE_LOAN}"


def per_loan_sql(value: str) -> str:
    """A value that is constant within a loan, spread to every row of it."""
    return f"max({value}) {WHOLE_LOAN}"


def exprs(mapping: dict[str, str]) -> dict[str, Column]:
    """Parse a {column: SQL expression} mapping (for ``withColumns``)."""
    return {name: F.expr(sql) for name, sql in mapping.items()}


def by_loan() -> WindowSpec:
    return Window.partitionBy(KEY).orderBy(DATE)


def up_to_current() -> WindowSpec:
    return by_loan().rowsBetween(Window.unboundedPreceding, Window.currentRow)
