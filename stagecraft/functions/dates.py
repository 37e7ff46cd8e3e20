"""Date helpers shared by every operator.

All of them are plain Column expressions, so they stay inside whole-stage
codegen and push down wherever Catalyst can push them.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

def prev_month_end_py(d: _dt.date) -> _dt.date:
    """Driver-side form of :func:`prev_month_end_sql` for job parameters."""
    first = d.replace(day=1)
    return first - _dt.timedelta(days=1)


def date_lit(d: _dt.date | str) -> Column:
    """Typed DATE literal, so comparisons with date columns need no cast."""
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d).cast("date")


# -- SQL-text forms --------------------------------------------------------
# Building Column trees costs one JVM round trip per node; the operators build
# each expression as SQL text and parse it once with ``F.expr`` instead.


def sql_string(value: str) -> str:
    """A SQL string literal (backslash and quote escaped)."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def sql_date(d: _dt.date) -> str:
    return f"DATE'{d.isoformat()}'"


def month_diff_sql(start: str, end: str) -> str:
    """Number of calendar month boundaries crossed from ``start`` to ``end``.

    2019-01-31 -> 2019-02-28 is 1 and 2019-01-30 -> 2019-02-01 is 1: only the
    year and month parts count. This is neither ``months_between`` (fractional)
    nor ``timestampdiff(MONTH, ..)`` (whole elapsed months). NULL in, NULL out.
    """
    return f"((year({end}) - year({start})) * 12 + (month({end}) - month({start})))"


def prev_month_end_sql(d: str) -> str:
    """Last day of the month before ``d`` (2019-03-31 and 2019-03-15 -> 2019-02-28)."""
    return f"last_day(add_months({d}, -1))"
