"""Runs of consecutive stage-2 points per loan - gaps and islands.

A run id is the running count of non-stage-2 points up to the row: all
stage-2 points of one run share it. That is one running-sum window instead
of a correlated count per row (quadratic per loan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.functions.dates import date_lit
from stagecraft.operators.windows import DATE, KEY, UP_TO_CURRENT, exprs, up_to_current
from stagecraft.sources.params import StageParams

FLAG = "dpd3090_event"


def stage2_runs(events: DataFrame) -> DataFrame:
    """One row per run: ``start_date``, ``end_date``, ``streak`` (points in the run)."""
    two = F.col(FLAG)
    return (
        events.withColumn("run_group", F.sum(1 - two).over(up_to_current()))
        .where(two == 1)
        .groupBy(KEY, "run_group")
        .agg(
            F.min(DATE).alias("start_date"),
            F.max(DATE).alias("end_date"),
            F.count(F.lit(1)).alias("streak"),
        )
        .drop("run_group")
    )


def current_streak(runs: DataFrame, params: StageParams) -> DataFrame:
    """O20: the run that ends at the reporting date."""
    return runs.where(F.col("end_date") == date_lit(params.reporting_date))


def run_start_columns() -> dict[str, F.Column]:
    """On stage-2 rows, the start date and start row of the run they belong to.

    Expects ``row_no`` and ``prev_stage2`` (the previous row's flag, see
    ``stagecraft.operators.events.rolling_stats``).
    """
    starts_run = f"{FLAG} = 1 AND (prev_stage2 IS NULL OR prev_stage2 = 0)"
    return exprs(
        {
            "run_start": f"CASE WHEN {FLAG} = 1 THEN "
            f"last(CASE WHEN {starts_run} THEN {DATE} END, true) {UP_TO_CURRENT} END",
            "run_start_row": f"CASE WHEN {FLAG} = 1 THEN "
            f"last(CASE WHEN {starts_run} THEN row_no END, true) {UP_TO_CURRENT} END",
        }
    )
