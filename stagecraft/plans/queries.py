"""Registered queries: one per operator of SURVEY section 2 (keys of section 7.3).

Every query takes ``(spark, sf_dir)``, derives the staging inputs from the
tables in ``sf_dir`` (natural fixture; ``*_arch`` keys use the archetype
fixture) and returns one named intermediate of the staging plan. Output
columns and types match the SQL oracle in ``tools/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagecraft.functions.dates import month_diff_sql, prev_month_end_sql, sql_date
from stagecraft.operators import events as ev
from stagecraft.operators import runs
from stagecraft.operators import timeline as tl
from stagecraft.operators.asof import event_after, rows_in_interval
from stagecraft.operators.classify import OUTCOME_COLUMNS
from stagecraft.operators.events import EVENT_FLAGS
from stagecraft.operators.windows import DATE, KEY
from stagecraft.plans.staging import EVENT_BASE_COLUMNS, PUBLISHED_COLUMNS, StagePlan
from stagecraft.sources.fixtures import archetype_inputs, fractional_inputs, late_inputs, natural_inputs
from stagecraft.sources.params import params_frame
from stagecraft.sources.storage import missing_rows

Query = Callable[[SparkSession, str], DataFrame]

A_MILESTONES = {
    "a_zero3_start": "zero3_start",
    "a_zero3_end": "zero3_end",
    "a_zero9_date": "zero9_date",
    "a_stage2_first": "stage2_first",
    "a_stage2_last": "stage2_last",
    "a_zero_before_last2": "zero_before_last2",
    "a_stage2_after_zero": "stage2_after_zero",
}
B_MILESTONES = {
    "b_stage2_first": "stage2_first",
    "b_stage2_last": "stage2_last",
    "b_zero3_first": "zero3_first",
    "b_zero3_last": "zero3_last",
    "b_zero_before_last2": "zero_before_last2",
    "b_stage2_after_zero": "stage2_after_zero",
}


def natural_plan(spark: SparkSession, sf_dir: str) -> StagePlan:
    return StagePlan(*natural_inputs(spark, sf_dir))


def archetype_plan(spark: SparkSession, sf_dir: str) -> StagePlan:
    return StagePlan(*archetype_inputs(spark, sf_dir))


def fractional_plan(spark: SparkSession, sf_dir: str) -> StagePlan:
    return StagePlan(*fractional_inputs(spark, sf_dir))


def late_plan(spark: SparkSession, sf_dir: str) -> StagePlan:
    return StagePlan(*late_inputs(spark, sf_dir))


def _renamed(mapping: dict[str, str]) -> list:
    return [F.col(k).alias(v) for k, v in mapping.items()]


# -- each query body takes a StagePlan --------------------------------------
def q_param_dates(p: StagePlan) -> DataFrame:
    return params_frame(p.inputs.entity, p.params)


def q_src_population(p: StagePlan) -> DataFrame:
    return p.snapshot


def q_src_dpd_window(p: StagePlan) -> DataFrame:
    return p.observations.select(KEY, DATE, "factor_value")


def q_population_normalised(p: StagePlan) -> DataFrame:
    return p.population


def q_spine_dates(p: StagePlan) -> DataFrame:
    return tl.spine_dates(p.observations)


def q_spine_start(p: StagePlan) -> DataFrame:
    return tl.spine_starts(p.observations, p.population, p.params)


def q_spine(p: StagePlan) -> DataFrame:
    return p.spine.select(KEY, DATE)


def q_spine_filled_na(p: StagePlan) -> DataFrame:
    return p.spine.select(
        KEY, DATE, F.col("obs_value").alias("factor_value"), F.col("observed").cast("int").alias("is_observed")
    )


def q_fill_groups(p: StagePlan) -> DataFrame:
    return tl.fill_groups(p.spine)


def q_fill_head_tail(p: StagePlan) -> DataFrame:
    return p.filled.select(KEY, DATE, F.col("obs_value").alias("factor_value"), "head", "tail")


def q_fill_value(p: StagePlan) -> DataFrame:
    return p.filled.select(KEY, DATE, "head", "tail", "factor_value")


def q_impute_writeback(p: StagePlan) -> DataFrame:
    return p.imputed


def q_roll_max_x(p: StagePlan) -> DataFrame:
    return p.events.select(KEY, DATE, "row_no", "max_x_nontdrm")


def q_event_base(p: StagePlan) -> DataFrame:
    return p.events.select(*EVENT_BASE_COLUMNS)


def q_event_flags(p: StagePlan) -> DataFrame:
    return p.events.select(*EVENT_BASE_COLUMNS, *EVENT_FLAGS)


def q_last_npl_date(p: StagePlan) -> DataFrame:
    return ev.last_npl_dates(p.observations, p.imputed, p.params)


def _has_npl(p: StagePlan) -> DataFrame:
    return p.per_loan.where(F.col("npl_date_initial").isNotNull() & F.col("restructure_start_date").isNotNull())


def q_cured_before_tdr(p: StagePlan) -> DataFrame:
    return _has_npl(p).where(F.col("zerobetween_date").isNotNull()).select(
        KEY,
        F.col("restructure_start_date").alias("restructure_date"),
        F.col("npl_date_initial").alias("npl_date"),
        "zerobetween_date",
    )


def q_npl_date_reset(p: StagePlan) -> DataFrame:
    return _has_npl(p).select(
        KEY, F.col("restructure_start_date").alias("restructure_date"), "zerobetween_date", "npl_date"
    )


def q_npl_date_rewritten(p: StagePlan) -> DataFrame:
    return p.events_final.select(KEY, "npl_date", "restructure_start_date", DATE, "factor_value", *EVENT_FLAGS)


def q_milestones_a(p: StagePlan) -> DataFrame:
    return p.branch("A").select(
        KEY, "npl_date", F.col("restructure_start_date").alias("restructure_date"), *_renamed(A_MILESTONES)
    )


def q_classify_a(p: StagePlan) -> DataFrame:
    return p.branch("A").select(
        KEY,
        "npl_date",
        F.col("restructure_start_date").alias("restructure_date"),
        *_renamed(A_MILESTONES),
        *OUTCOME_COLUMNS,
    )


def q_stage2_runs(p: StagePlan) -> DataFrame:
    return p.stage2_runs


def q_current_streak(p: StagePlan) -> DataFrame:
    return runs.current_streak(p.stage2_runs, p.params)


def q_tdr_no_npl(p: StagePlan) -> DataFrame:
    return p.branch("B").select(KEY, "restructure_start_date")


def q_stage_before_tdr(p: StagePlan) -> DataFrame:
    return p.branch("B").select(
        KEY,
        "restructure_start_date",
        F.col("b_stage_before_tdr").alias("stage_before_restructure"),
        F.col("b_stage2_run_start").alias("last2_before_restructure_date"),
    )


def q_milestones_b(p: StagePlan) -> DataFrame:
    return p.branch("B").select(KEY, "restructure_start_date", *_renamed(B_MILESTONES))


def q_classify_b(p: StagePlan) -> DataFrame:
    return p.branch("B").select(KEY, "restructure_start_date", *_renamed(B_MILESTONES), *OUTCOME_COLUMNS)


def q_cure_flag_b(p: StagePlan) -> DataFrame:
    return p.branch("B").select(KEY, "cure_flag")


def q_nontdr_population(p: StagePlan) -> DataFrame:
    return p.branch("C").select(KEY, "npl_date", F.col("c_dpd_t").alias("dpd_t"))


def q_last_cure_date(p: StagePlan) -> DataFrame:
    return p.branch("C").select(
        KEY, "npl_date", F.col("c_dpd_t").alias("dpd_t"), F.col("c_last_cure_date").alias("last_cure_date")
    )


def q_classify_c(p: StagePlan) -> DataFrame:
    return p.branch("C").select(
        KEY,
        "npl_date",
        F.col("c_dpd_t").alias("dpd_t"),
        F.col("c_last_cure_date").alias("last_cure_date"),
        *OUTCOME_COLUMNS,
    )


def q_publish_stage_status(p: StagePlan) -> DataFrame:
    return p.stage_status.select(*PUBLISHED_COLUMNS)


def q_scalar_dates(p: StagePlan) -> DataFrame:
    rep = sql_date(p.params.reporting_date)
    return p.population.selectExpr(
        KEY,
        f"{prev_month_end_sql('restructure_start_date')} AS restructure_prev_month_end",
        f"{month_diff_sql('value_date', rep)} AS months_on_book",
        f"{month_diff_sql('restructure_start_date', rep)} AS months_since_restructure",
    )


# -- operators over two tables, and what a run does ---------------------------
def q_append_missing(p: StagePlan) -> DataFrame:
    """The imputed rows that a table lacks which holds those of even months already (its ids
    padded, its dates timestamps)."""
    held = p.imputed.where(f"month({DATE}) % 2 = 0").selectExpr(f"{KEY} || '  ' AS {KEY}", f"CAST({DATE} AS TIMESTAMP) AS {DATE}")
    return missing_rows(p.imputed, held, [KEY, DATE])


def q_event_after_restructure(p: StagePlan) -> DataFrame:
    """For each loan: the first observation with over 30 days after its restructuring, the last one
    three or more months after its origination, and the first from its origination on."""
    late = p.observations.where("factor_value > 30").select(KEY, DATE)
    loans = p.population.select(KEY, "value_date", "restructure_start_date")
    loans = event_after(loans, late, KEY, "restructure_start_date", DATE, "first_late")
    loans = event_after(loans, late, KEY, "value_date", DATE, "last_late", which="last", months=3)
    return event_after(loans, late, KEY, "value_date", DATE, "first_from_origination", inclusive=True)


def q_observations_in_runs(p: StagePlan) -> DataFrame:
    """Each observation of a loan, with the stage-2 run that it lies in, if any."""
    points = p.observations.where(f"{KEY} IS NOT NULL").select(KEY, DATE, "factor_value")
    return rows_in_interval(points, p.stage2_runs, KEY, DATE, "start_date", "end_date", keep=("streak",))


def q_run_counts(p: StagePlan) -> DataFrame:
    """What a run drops and fills, as its report gives it: one row."""
    plan = StagePlan(p.inputs, p.params, measured=True)
    plan.per_loan.write.format("noop").mode("overwrite").save()
    counts = plan.measures()
    return p.inputs.dpd.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))


NATURAL = {
    "param_dates": q_param_dates,
    "src_population": q_src_population,
    "src_dpd_window": q_src_dpd_window,
    "population_normalised": q_population_normalised,
    "spine_dates": q_spine_dates,
    "spine_start": q_spine_start,
    "spine": q_spine,
    "spine_filled_na": q_spine_filled_na,
    "fill_groups": q_fill_groups,
    "fill_head_tail": q_fill_head_tail,
    "fill_value": q_fill_value,
    "impute_writeback": q_impute_writeback,
    "roll_max_x": q_roll_max_x,
    "event_base": q_event_base,
    "event_flags": q_event_flags,
    "last_npl_date": q_last_npl_date,
    "cured_before_tdr": q_cured_before_tdr,
    "npl_date_reset": q_npl_date_reset,
    "npl_date_rewritten": q_npl_date_rewritten,
    "milestones_a": q_milestones_a,
    "classify_a": q_classify_a,
    "stage2_runs": q_stage2_runs,
    "current_streak": q_current_streak,
    "tdr_no_npl": q_tdr_no_npl,
    "stage_before_tdr": q_stage_before_tdr,
    "milestones_b": q_milestones_b,
    "classify_b": q_classify_b,
    "cure_flag_b": q_cure_flag_b,
    "nontdr_population": q_nontdr_population,
    "last_cure_date": q_last_cure_date,
    "classify_c": q_classify_c,
    "publish_stage_status": q_publish_stage_status,
    "scalar_dates": q_scalar_dates,
    "append_missing": q_append_missing,
    "event_after_restructure": q_event_after_restructure,
    "observations_in_runs": q_observations_in_runs,
    "run_counts": q_run_counts,
}
# Every query again on the archetype fixture: NULL and missing DPD values, gaps,
# excluded and NULL pools, two snapshots, loans without any DPD row,
# restructurings before the window and cures before restructuring.
# Not the parameters: the fixture's are fixed, so that query would read no stored value.
ARCHETYPE = {f"{key}_arch": body for key, body in NATURAL.items() if key != "param_dates"}
# What fractional DPD decides, on the natural fixture with fractional values.
FRACTIONAL = {f"{key}_dec": NATURAL[key] for key in ("event_flags", "last_npl_date", "publish_stage_status")}
# Rows that an earlier run imputed, beside observed rows that came late.
LATE = {
    f"{key}_late": NATURAL[key]
    for key in ("spine_filled_na", "impute_writeback", "last_npl_date", "stage2_runs", "publish_stage_status", "run_counts")
}


def _bind(body: Callable[[StagePlan], DataFrame], build: Callable[[SparkSession, str], StagePlan]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return body(build(spark, sf_dir))

    query.__name__ = body.__name__
    query.__doc__ = body.__doc__
    return query


def queries() -> dict[str, Query]:
    out = {k: _bind(v, natural_plan) for k, v in NATURAL.items()}
    out.update({k: _bind(v, archetype_plan) for k, v in ARCHETYPE.items()})
    out.update({k: _bind(v, fractional_plan) for k, v in FRACTIONAL.items()})
    out.update({k: _bind(v, late_plan) for k, v in LATE.items()})
    return out
