"""Stage decision tables for the three loan branches.

Each table is written once, first match wins, and expands to one struct-valued
CASE (see ``stagecraft.functions.decision``). Fixed values that must equal the
source job: status codes 'c1'/'c2'/'c3', stage-3 flag 'Y'/'N', paths
'c3-c2-c1' and 'c2-c1', condition numbers 1-18.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.functions.bands import NPL_THRESHOLD, STAGE2_LOWER
from stagecraft.functions.dates import month_diff_sql, sql_date
from stagecraft.functions.decision import Sql, decide
from stagecraft.sources.params import StageParams

OUTCOME_TYPES = {
    "condition_no": "int",
    "prev_status": "string",
    "calculated_stage": "int",
    "stg3_flag": "string",
    "path_tdr": "string",
    "m_stg2": "int",
    "cure_flag": "int",
}
OUTCOME_COLUMNS = list(OUTCOME_TYPES)

# Fixed values.
PATH_FROM_STAGE3 = "c3-c2-c1"
PATH_FROM_STAGE2 = "c2-c1"


def _outcome(cond, prev, stage, stg3, path, m, cure=None) -> dict:
    return {
        "condition_no": cond,
        "prev_status": prev,
        "calculated_stage": stage,
        "stg3_flag": stg3,
        "path_tdr": path,
        "m_stg2": m,
        "cure_flag": cure,
    }


def _months_to(params: StageParams):
    rep = sql_date(params.reporting_date)
    return lambda col: Sql(month_diff_sql(col, rep))


def branch_a(params: StageParams) -> str:
    """Restructured after (or with) an NPL: cure 3 -> 1, possibly back to 2."""
    months = _months_to(params)
    rules = [
        ("a_zero3_start IS NULL", _outcome(1, "c3", 3, "Y", PATH_FROM_STAGE3, 0)),
        ("a_zero9_date IS NULL", _outcome(2, "c2", 2, "Y", PATH_FROM_STAGE3, months("a_zero3_start"))),
        ("a_stage2_first IS NULL", _outcome(3, "c1", 1, "N", None, 0)),
        ("a_zero3_end > a_stage2_last", _outcome(4, "c1", 1, "N", None, 0)),
        ("a_zero3_end < a_stage2_first", _outcome(5, "c2", 2, "N", PATH_FROM_STAGE2, months("a_stage2_first"))),
        (
            "a_zero3_end < a_stage2_last AND a_zero_before_last2 IS NOT NULL",
            _outcome(6, "c2", 2, "N", PATH_FROM_STAGE2, months("a_stage2_after_zero")),
        ),
    ]
    return decide(rules, _outcome(None, None, None, None, None, None), OUTCOME_TYPES)


def branch_b(params: StageParams) -> str:
    """Restructured without an NPL (or cured before the restructuring)."""
    months = _months_to(params)
    cure = Sql("CASE WHEN transferred = 1 THEN 1 END")
    lt = "b_zero3_last < b_stage2_last"
    rules = [
        ("b_stage2_first IS NULL", _outcome(7, "c1", 1, "N", None, 0, cure)),
        ("b_zero3_last IS NULL", _outcome(8, "c2", 2, "N", PATH_FROM_STAGE2, months("b_stage2_first"), cure)),
        ("b_zero3_last > b_stage2_last", _outcome(9, "c1", 1, "N", None, 0, cure)),
        (
            f"{lt} AND b_zero_before_last2 IS NULL",
            _outcome(10, "c2", 2, "N", PATH_FROM_STAGE2, months("b_stage2_last"), cure),
        ),
        (
            f"{lt} AND b_stage2_after_zero IS NULL",
            _outcome(11, "c2", 2, "N", PATH_FROM_STAGE2, months("b_stage2_last"), cure),
        ),
        (lt, _outcome(12, "c2", 2, "N", PATH_FROM_STAGE2, months("b_stage2_after_zero"), cure)),
    ]
    return decide(rules, _outcome(None, "c1", 1, "N", PATH_FROM_STAGE2, 0, cure), OUTCOME_TYPES)


def branch_c(params: StageParams) -> str:
    """Never restructured: stage from DPD at the reporting date, NPL history and cure."""
    low = f"c_dpd_t <= {STAGE2_LOWER}"
    mid = f"c_dpd_t > {STAGE2_LOWER} AND c_dpd_t <= {NPL_THRESHOLD}"
    high = f"c_dpd_t > {NPL_THRESHOLD}"
    months = Sql("c_streak - 1")
    cured = "npl_date IS NOT NULL AND c_last_cure_date IS NOT NULL"
    rules = [
        (f"npl_date IS NULL AND {low}", _outcome(12, None, 1, "N", None, 0)),
        (f"npl_date IS NULL AND {mid}", _outcome(13, None, 2, "N", None, months)),
        (f"npl_date IS NULL AND {high}", _outcome(14, None, 3, "Y", None, 0)),
        ("npl_date IS NOT NULL AND c_last_cure_date IS NULL", _outcome(15, None, 3, "Y", None, 0)),
        (f"{cured} AND {low}", _outcome(16, None, 1, "N", None, 0, 1)),
        (f"{cured} AND {mid}", _outcome(17, None, 2, "N", None, months, 1)),
        (f"{cured} AND {high}", _outcome(18, None, 3, "Y", None, 0, 1)),
    ]
    return decide(rules, _outcome(None, None, 1, "N", None, 0), OUTCOME_TYPES)


BRANCH_SQL = (
    "CASE WHEN restructure_start_date IS NOT NULL AND npl_date IS NOT NULL THEN 'A' "
    "WHEN restructure_start_date IS NOT NULL THEN 'B' "
    "WHEN c_has_rep_row = 1 THEN 'C' END"
)


def classify(per_loan: DataFrame, params: StageParams) -> DataFrame:
    """Adds ``branch`` ('A', 'B', 'C'; NULL = no output row) and the outcome columns.

    A = restructured with an NPL date after the reset, B = restructured without
    one (incl. loans with no timeline), C = never restructured with a timeline
    row at the reporting date. The branches are disjoint.
    """
    decision = (
        f"CASE branch WHEN 'A' THEN {branch_a(params)} WHEN 'B' THEN {branch_b(params)} "
        f"ELSE {branch_c(params)} END"
    )
    return (
        per_loan.withColumn("branch", F.expr(BRANCH_SQL))
        .where("branch IS NOT NULL")
        .withColumn("_outcome", F.expr(decision))
        .selectExpr("*", *[f"_outcome.{c} AS {c}" for c in OUTCOME_COLUMNS])
        .drop("_outcome")
    )


# O24: months in stage 2 as published: m + 1 when in stage 2, else 0.
PUBLISHED_MONTHS_SQL = "CAST(CASE WHEN calculated_stage = 2 THEN m_stg2 + 1 ELSE 0 END AS INT)"
