"""NPL date reset for restructured loans.

For a restructured (TDR) loan with an NPL date before the restructuring:

* cured in between (an x-month zero event, at least x months after the NPL
  date and before the restructuring) -> NPL date becomes NULL and the loan is
  *transferred* to the non-NPL branch with a cure flag;
* otherwise -> NPL date becomes the month-end before the restructuring.

An NPL date on or after the restructuring is kept. Everything is per loan, so
it is a whole-loan window on the existing partitioning, not a join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagecraft.functions.dates import month_diff_sql, prev_month_end_sql
from stagecraft.operators.windows import exprs, last_date_sql
from stagecraft.sources.params import StageParams


def _before_tdr() -> str:
    """Restructured loan whose NPL date precedes the restructuring."""
    return "npl_date IS NOT NULL AND restructure_start_date IS NOT NULL AND npl_date < restructure_start_date"


def cure_between_date(params: StageParams) -> Column:
    """O9 (whole-loan window): latest x-point zero event at least x months after the
    NPL date and before the restructuring, for loans with NPL before restructuring."""
    return F.expr(
        last_date_sql(
            f"{_before_tdr()} AND dpd_x_nontdrm_event = 1 "
            f"AND {month_diff_sql('npl_date', 'factor_date')} >= {params.x} "
            "AND factor_date < restructure_start_date"
        )
    )


def reset_to_month_end() -> str:
    """The reset replaces the NPL date with the month-end before the restructuring."""
    return f"({_before_tdr()} AND zerobetween_date IS NULL)"


def reset_columns() -> dict[str, Column]:
    """O10/O11 from ``zerobetween_date``: the reset NPL date and the transfer flag."""
    before = _before_tdr()
    return exprs(
        {
            "npl_date_reset": f"CASE WHEN {before} AND zerobetween_date IS NULL "
            f"THEN {prev_month_end_sql('restructure_start_date')} "
            f"WHEN {before} THEN CAST(NULL AS DATE) ELSE npl_date END",
            "transferred": f"coalesce({before}, false) AND zerobetween_date IS NOT NULL",
        }
    )
