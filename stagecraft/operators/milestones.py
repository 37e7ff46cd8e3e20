"""Per-loan milestone dates: "first/last event after an anchor" (SURVEY O12, O16, O17, O22).

Each milestone is the earliest or latest timeline date of a loan at which an
event flag is set and the date lies after/before earlier milestones. Written
as chained conditional whole-loan windows on the one partitioning by loan,
then one hash aggregate to a row per loan - instead of a chain of self-joins
and group-bys (each of which would shuffle and sort the event table again).

Branch A (restructured, NPL date kept after the reset), milestones ``a_*``:
  zero3_start/zero3_end  first/last 3-point zero event >= 3 months after NPL
  zero9_date             first 9-point event >= 9 months after zero3_start
  stage2_first/last      first/last stage-2 point after zero9_date
  zero_before_last2      last 3-point zero event strictly between them
  stage2_after_zero      first stage-2 point after that, before stage2_last

Branch B (restructured, no NPL date), milestones ``b_*`` (all on or after the
restructuring date ``rsd``):
  stage_before_tdr       NULL if rsd precedes the window; 2 if the loan has a
                         timeline row at the month-end before rsd; else 1
  stage2_run_start       start of the stage-2 run covering that month-end
  stage2_first           stage2_run_start if known, else first stage-2 point
  stage2_last            last stage-2 point
  zero3_first/last       first/last 3-point zero event
  zero_before_last2      last 3-point zero event before stage2_last
  stage2_after_zero      first stage-2 point between that and stage2_last

Branch C (never restructured), ``c_*``: DPD at the reporting date, last cure
date (x-point zero event >= x months after NPL), current stage-2 streak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.functions.dates import month_diff_sql, prev_month_end_sql, sql_date
from stagecraft.operators.windows import DATE, KEY, exprs, first_date_sql, last_date_sql, per_loan_sql
from stagecraft.sources.params import StageParams

A_COLUMNS = [
    "a_zero3_start",
    "a_zero3_end",
    "a_zero9_date",
    "a_stage2_first",
    "a_stage2_last",
    "a_zero_before_last2",
    "a_stage2_after_zero",
]
C_COLUMNS = ["c_dpd_t", "c_has_rep_row", "c_last_cure_date", "c_streak"]


def candidate_rows_sql(params: StageParams) -> str:
    """Rows that can matter for a milestone or a per-loan value.

    Every milestone is the date of a row with an event flag set; the per-loan
    values also read the reporting-date row, the row before the restructuring,
    the imputed rows (for the write-back) and constants carried by any row (the
    first one is kept). Dropping the rest
    before the chained windows shrinks every level (about a third of the rows on
    the natural fixture) without changing any result.
    """
    return (
        "NOT observed OR dpd_3m_event = 1 OR dpd_9m_event = 1 OR dpd3090_event = 1 OR dpd_x_nontdrm_event = 1 "
        f"OR factor_date = {sql_date(params.reporting_date)} "
        f"OR factor_date = {prev_month_end_sql('restructure_start_date')} OR row_no = 1"
    )


def zero3_candidates(params: StageParams) -> dict[str, str]:
    """First link of chain A for both possible reset NPL dates, as whole-loan windows.

    The reset NPL date of a branch-A loan is either its NPL date or the month-end
    before its restructuring, so the first link (3-point zero events at least 3
    months after it) can be computed for both in the same window level as the
    reset itself; :func:`zero3_choice` then picks one. This saves a window level.
    """
    e3 = "dpd_3m_event = 1"
    out = {}
    for suffix, anchor in (("npl", "npl_date"), ("pme", prev_month_end_sql("restructure_start_date"))):
        cond = f"{e3} AND {month_diff_sql(anchor, 'factor_date')} >= 3"
        out[f"a_zero3_start_{suffix}"] = first_date_sql(cond)
        out[f"a_zero3_end_{suffix}"] = last_date_sql(cond)
    return out


def zero3_choice(reset_to_month_end: str) -> dict[str, str]:
    """``a_zero3_start`` / ``a_zero3_end`` for the loan's reset NPL date."""
    return {
        f"a_zero3_{part}": f"CASE WHEN {reset_to_month_end} THEN a_zero3_{part}_pme ELSE a_zero3_{part}_npl END"
        for part in ("start", "end")
    }


def milestone_rows(events: DataFrame, params: StageParams) -> DataFrame:
    """Adds the chained milestone columns to every timeline row (whole-loan windows).

    Expects the final event table with ``npl_date`` (after the reset),
    ``restructure_start_date``, the flags, ``row_no``, ``run_start``/``run_start_row``
    and the first link of chain A (``a_zero3_start``/``a_zero3_end``, see
    :func:`zero3_candidates`).
    """
    e3, e9 = "dpd_3m_event = 1", "dpd_9m_event = 1"
    two, cure = "dpd3090_event = 1", "dpd_x_nontdrm_event = 1"
    rep = sql_date(params.reporting_date)
    before_tdr = prev_month_end_sql("restructure_start_date")
    after_tdr = "factor_date >= restructure_start_date"

    level1 = {
        # A
        "a_zero9_date": first_date_sql(f"{e9} AND {month_diff_sql('a_zero3_start', 'factor_date')} >= 9"),
        # B
        "b_row_before_tdr": per_loan_sql(f"CASE WHEN factor_date = {before_tdr} THEN 1 END"),
        "b_run_before_tdr": per_loan_sql(f"CASE WHEN factor_date = {before_tdr} AND {two} THEN run_start END"),
        "b_stage2_after_tdr": first_date_sql(f"{two} AND {after_tdr}"),
        "b_stage2_last": last_date_sql(f"{two} AND {after_tdr}"),
        "b_zero3_first": first_date_sql(f"{e3} AND {after_tdr}"),
        "b_zero3_last": last_date_sql(f"{e3} AND {after_tdr}"),
        # C
        "c_dpd_t": per_loan_sql(f"CASE WHEN factor_date = {rep} THEN factor_value END"),
        "c_has_rep_row": per_loan_sql(f"CASE WHEN factor_date = {rep} THEN 1 END"),
        "c_last_cure_date": last_date_sql(
            f"{cure} AND {month_diff_sql('npl_date', 'factor_date')} >= {params.x}"
        ),
        "c_streak": per_loan_sql(f"CASE WHEN factor_date = {rep} AND {two} THEN row_no - run_start_row + 1 END"),
    }
    level2 = {
        "a_stage2_first": first_date_sql(f"{two} AND factor_date > a_zero9_date"),
        "a_stage2_last": last_date_sql(f"{two} AND factor_date > a_zero9_date"),
        "b_zero_before_last2": last_date_sql(f"{e3} AND factor_date < b_stage2_last AND {after_tdr}"),
    }
    level3 = {
        "a_zero_before_last2": last_date_sql(
            f"{e3} AND factor_date > a_stage2_first AND factor_date < a_stage2_last"
        ),
    }
    out = events
    for level in (level1, level2, level3):
        out = out.withColumns(exprs(level))
    return out


def stage_before_tdr_sql(params: StageParams) -> str:
    """Stage just before the restructuring: NULL if it precedes the window, 2 if the
    loan has a timeline row at the month-end before it, else 1 (also for loans
    without any timeline row, so it is applied after the join to the population)."""
    return (
        f"CAST(CASE WHEN restructure_start_date < {sql_date(params.min_factor_date)} THEN NULL "
        "WHEN b_row_before_tdr IS NOT NULL THEN 2 ELSE 1 END AS INT)"
    )


def per_loan_milestones(rows: DataFrame, params: StageParams) -> DataFrame:
    """Collapse the milestone rows to one row per loan (hash aggregate on the
    existing partitioning), with its imputed rows. ``own`` is 1 on a loan's own row. The last link of each chain is computed here."""
    two = "dpd3090_event = 1"
    in_window = f"max(restructure_start_date) >= {sql_date(params.min_factor_date)}"
    stage_before = (
        f"CASE WHEN {in_window} AND max(b_row_before_tdr) IS NOT NULL THEN 2 WHEN {in_window} THEN 1 END"
    )
    run_start = f"CASE WHEN ({stage_before}) = 2 THEN max(b_run_before_tdr) END"
    loan_values = [
        "npl_date_initial",
        "npl_date",
        "zerobetween_date",
        *[c for c in A_COLUMNS if c != "a_stage2_after_zero"],
        "b_stage2_last",
        "b_zero3_first",
        "b_zero3_last",
        "b_zero_before_last2",
        *C_COLUMNS,
    ]
    once = "CASE WHEN sum(own) > 1 THEN raise_error('duplicate deal_id in population snapshot') ELSE "
    aggs = [f"max({c}) AS {c}" for c in loan_values] + [
        f"{once}max(restructure_start_date) END AS restructure_start_date",
        "max(CAST(transferred AS INT)) AS transferred",
        f"min(CASE WHEN {two} AND factor_date > a_zero_before_last2 AND factor_date < a_stage2_last "
        f"THEN factor_date END) AS a_stage2_after_zero",
        "max(b_row_before_tdr) AS b_row_before_tdr",
        # Bounded by the calendar's length; a row without a date is no timeline row.
        f"collect_list(CASE WHEN NOT observed THEN named_struct('{DATE}', {DATE}, 'factor_value', factor_value) END) "
        "AS imputed",
        f"{run_start} AS b_stage2_run_start",
        f"coalesce({run_start}, max(b_stage2_after_tdr)) AS b_stage2_first",
        f"min(CASE WHEN {two} AND factor_date > b_zero_before_last2 AND factor_date < b_stage2_last "
        f"AND factor_date >= restructure_start_date THEN factor_date END) AS b_stage2_after_zero",
    ]
    return rows.groupBy(KEY).agg(*[F.expr(a) for a in aggs])
