"""Days-past-due bands and 0/1 event flags.

Fixed values that must equal the source job for identical results:
  non-performing (NPL)      : DPD > 90
  stage-2 point             : 30 < DPD <= 90
  performing                : DPD <= 30
  excluded segment pools    : 2, 3, 4, 6, 7
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (see module docstring).
NPL_THRESHOLD = 90
STAGE2_LOWER = 30
EXCLUDED_POOLS = (2, 3, 4, 6, 7)


def is_npl(v: Column) -> Column:
    return v > NPL_THRESHOLD


def is_npl_sql(v: str) -> str:
    return f"({v} > {NPL_THRESHOLD})"


def is_stage2_point_sql(v: str) -> str:
    return f"({v} > {STAGE2_LOWER} AND {v} <= {NPL_THRESHOLD})"


def flag_sql(cond: str) -> str:
    """0/1 int flag; an unknown (NULL) condition counts as 0."""
    return f"CASE WHEN {cond} THEN 1 ELSE 0 END"
