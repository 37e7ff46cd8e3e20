"""Observed-date timeline per loan and gap filling.

The time axis is *observed*, not calendar: the spine of a loan holds every
month-end that anybody in the portfolio reported, from the later of the window
start and the loan's origination up to the reporting date, and only for loans
with at least one observation in the window. Missing or NULL values are filled
with the larger of the previous and the next known value of the same loan.

Plan shape (the point of this module):

* the population (one row per loan) and the observations are each hash
  partitioned by ``deal_id`` once;
* spine rows are generated per loan with ``explode`` over the observed calendar,
  a list that the window's length bounds (one date per day at most); no join is
  needed for it;
* spine and observations are unioned (Spark keeps the common partitioning) and
  collapsed per (loan, date) with a hash aggregate - no exchange;
* every later window runs on that partitioning after one sort.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagecraft.functions.bands import is_npl_sql
from stagecraft.functions.dates import sql_date
from stagecraft.operators.windows import (
    BY_LOAN,
    DATE,
    KEY,
    UP_TO_CURRENT,
    by_loan,
    exprs,
    last_date_sql,
    per_loan_sql,
)
from stagecraft.sources.params import StageParams

# Timeline rows per task of the per-loan stages (a row is ~150-250 bytes wide
# through the window levels, so this keeps a task's working set near 0.5 GB).
TARGET_ROWS_PER_PARTITION = 2_000_000


def partitions_for(loans: int, calendar_points: int, at_least: int,
                   rows_per_partition: int = TARGET_ROWS_PER_PARTITION) -> int:
    """Partition count for the per-loan stages: enough that the timeline
    (at most ``loans x calendar_points`` rows) fits ``rows_per_partition`` per
    task, and never fewer than ``at_least`` (the session's shuffle partitions)."""
    bound = max(loans, 0) * max(calendar_points, 1)
    return max(at_least, -(-bound // rows_per_partition), 1)


def observed_calendar(obs: DataFrame) -> list[_dt.date]:
    """Distinct observation dates in the window.

    Runs one small job (a one-column scan and a distinct). The result holds at most one
    date for each day from the window start to the reporting date.
    """
    return sorted(r[0] for r in obs.select(DATE).distinct().collect() if r[0] is not None)


def spine_dates(obs: DataFrame) -> DataFrame:
    """A2: the portfolio-wide observed calendar as a DataFrame."""
    return obs.select(DATE).distinct()


def loan_start_sql(params: StageParams) -> str:
    """First admissible spine date of a loan: later of window start and origination."""
    m = sql_date(params.min_factor_date)
    # Not greatest(): a NULL origination must give no start at all.
    return f"CASE WHEN {m} > value_date THEN {m} ELSE value_date END"


def spine_starts(obs: DataFrame, population: DataFrame, params: StageParams) -> DataFrame:
    """One row per observed loan with its spine start; NULL start when the loan is not
    in the population (such loans get no spine)."""
    loans = obs.select(KEY).distinct()
    return loans.join(population.select(KEY, "value_date"), KEY, "left").select(
        KEY, F.expr(loan_start_sql(params)).alias("min_factor_date")
    )


def by_loan_partitions(df: DataFrame, partitions: int) -> DataFrame:
    """Hash partition by loan into an explicit number of partitions.

    Explicit on purpose: the population and the observations are small before
    the spine explodes them (x calendar length), so adaptive execution would
    coalesce them into a handful of tasks. A fixed count also keeps the two
    sides co-partitioned, so their union needs no further exchange.
    """
    return df.repartition(partitions, KEY)


def loans_packed(population: DataFrame, partitions: int) -> DataFrame:
    """The population hash partitioned by loan: the key, and origination and restructuring
    date in one array, so that the spine and the closing per-loan rows ask for the same
    columns and read one exchange."""
    return by_loan_partitions(
        population.selectExpr(KEY, "array(value_date, restructure_start_date) AS loan_dates"), partitions
    )


def spine_candidates(loans: DataFrame, params: StageParams, calendar: list[_dt.date]) -> DataFrame:
    """(deal_id, restructure_start_date, factor_date) for every population loan and calendar
    date on or after its start; ``loans`` comes from :func:`loans_packed`, and the spine is
    exploded in place."""
    cal = f"array({', '.join(sql_date(d) for d in calendar)})" if calendar else "CAST(array() AS array<date>)"
    return (
        loans.selectExpr(KEY, "loan_dates[0] AS value_date", "loan_dates[1] AS restructure_start_date")
        .selectExpr(KEY, "restructure_start_date", f"explode(filter({cal}, d -> d >= {loan_start_sql(params)})) AS {DATE}")
    )


def timeline(spine: DataFrame, obs: DataFrame, partitions: int) -> DataFrame:
    """Union of spine rows and observations, one row per (loan, date).

    Columns: ``obs_value`` (observed DPD in its stored type, NULL if missing or observed
    NULL), ``n_obs`` (base rows), ``n_spine`` (population rows), ``restructure_start_date``.
    Observations outside the spine are kept: they still count for the NPL date. Rows without
    a loan id belong to no loan; they only count for the calendar.

    Where ``obs`` tells imputed rows apart (``imputed``), an observed row supersedes an imputed
    one of its key, also by a NULL value; ``n_superseded`` counts the latter.
    """
    value_type = obs.schema["factor_value"].dataType
    spine_rows = spine.select(
        KEY,
        DATE,
        F.lit(None).cast(value_type).alias("obs_value"),
        F.lit(0).alias("n_obs"),
        F.lit(1).alias("n_spine"),
        "restructure_start_date",
    )
    obs_rows = by_loan_partitions(obs.where(F.col(KEY).isNotNull()), partitions).select(
        KEY,
        DATE,
        F.col("factor_value").alias("obs_value"),
        F.lit(1).alias("n_obs"),
        F.lit(0).alias("n_spine"),
        F.lit(None).cast("date").alias("restructure_start_date"),
    )
    if "imputed" in obs.columns:
        return _with_precedence(spine_rows, obs, partitions)
    return (
        spine_rows.unionByName(obs_rows)
        .groupBy(KEY, DATE)
        .agg(
            F.max("obs_value").alias("obs_value"),
            F.sum("n_obs").alias("n_obs"),
            F.sum("n_spine").alias("n_spine"),
            F.max("restructure_start_date").alias("restructure_start_date"),
        )
    )


def _with_precedence(spine_rows: DataFrame, obs: DataFrame, partitions: int) -> DataFrame:
    """The timeline where observed rows go before imputed ones, in the same one aggregate."""
    own = by_loan_partitions(obs.where(F.col(KEY).isNotNull()), partitions).selectExpr(
        KEY, DATE, "factor_value AS obs_value", "imputed", "1 AS n_obs", "0 AS n_spine", "CAST(NULL AS DATE) AS restructure_start_date"
    )
    both = spine_rows.withColumn("imputed", F.lit(None).cast("boolean")).unionByName(own)
    chosen = "CASE WHEN n_real > 0 THEN {} ELSE {} END"
    return (
        both.groupBy(KEY, DATE)
        .agg(
            F.expr("max(CASE WHEN NOT imputed THEN obs_value END) AS real_value"),
            F.expr("max(CASE WHEN imputed THEN obs_value END) AS imputed_value"),
            F.expr("count_if(NOT imputed) AS n_real"),
            F.expr("count_if(imputed) AS n_imputed"),
            F.sum("n_spine").alias("n_spine"),
            F.max("restructure_start_date").alias("restructure_start_date"),
        )
        .selectExpr(
            KEY,
            DATE,
            f"{chosen.format('real_value', 'imputed_value')} AS obs_value",
            f"{chosen.format('n_real', 'n_imputed')} AS n_obs",
            "n_spine",
            "restructure_start_date",
            f"{chosen.format('n_imputed', '0')} AS n_superseded",
        )
    )


def preferred(obs: DataFrame) -> DataFrame:
    """Observations (deal_id, factor_date, factor_value) without the imputed rows that an observed
    row of their key supersedes."""
    if "imputed" not in obs.columns:
        return obs.select(KEY, DATE, "factor_value")
    # false < true, so the least struct is an observed row where there is one.
    first = obs.groupBy(KEY, DATE).agg(F.min(F.struct("imputed", "factor_value")).alias("row"))
    return first.select(KEY, DATE, "row.factor_value")


# A duplicate key of a loan in the population would fan out the result in the source job, so
# it is an error. Rows of other loans don't matter there and don't here.
_CHECKED = (
    "CASE WHEN n_spine > 1 THEN raise_error('duplicate deal_id in population snapshot') "
    "WHEN most_obs > 1 THEN raise_error('duplicate (deal_id, factor_date) in DPD source') "
    "ELSE n_obs > 0 END"
)


def loans_without_spine(tl: DataFrame) -> DataFrame:
    """Adds ``no_spine`` (the loan has observations only) and ``first_row`` (the loan's first date)."""
    return tl.withColumns(
        exprs({"no_spine": f"{per_loan_sql('n_spine')} = 0", "first_row": f"lag({DATE}, 1) {BY_LOAN} IS NULL"})
    )


def spine_of_observed_loans(tl: DataFrame) -> DataFrame:
    """Keep spine rows of loans with at least one observation in the window.

    Adds ``observed`` (a base row exists), per-loan ``restructure_start_date`` and
    ``npl_observed`` (latest base row with DPD > 90, including rows before origination),
    ``head`` (last known value at or before the date) and ``tail`` (first known value at or
    after it), all in one window level: a running ``last`` and ``lead(.., 1) IGNORE NULLS``,
    both linear per loan. The values of off-spine rows (observations before origination,
    which all precede the spine) are masked out of head and tail.
    """
    spine_value = "CASE WHEN n_spine > 0 THEN obs_value END"
    level = {
        "most_obs": per_loan_sql("n_obs"),
        "restructure_start_date": per_loan_sql("restructure_start_date"),
        "npl_observed": last_date_sql(f"n_obs > 0 AND {is_npl_sql('obs_value')}"),
        "head": f"last({spine_value}, true) {UP_TO_CURRENT}",
        "tail": f"coalesce({spine_value}, lead({spine_value}, 1) IGNORE NULLS {BY_LOAN})",
    }
    rows = tl.withColumns(exprs(level)).where("n_spine > 0 AND most_obs > 0")
    return rows.withColumn("observed", F.expr(_CHECKED)).drop("n_obs", "n_spine", "most_obs", "n_superseded")


def fill_rule(value: str, head: str, tail: str) -> str:
    """Observed value if any; else the larger of head and tail, where a missing
    head gives the tail and a missing tail counts as 0 against the head."""
    return (
        f"CASE WHEN {value} IS NOT NULL THEN {value} WHEN {head} IS NULL THEN {tail} "
        f"WHEN {head} >= coalesce({tail}, 0) THEN {head} ELSE {tail} END"
    )


def fill(spine_rows: DataFrame) -> DataFrame:
    """O4: ``factor_value`` = filled value from ``head`` and ``tail`` (computed by
    :func:`spine_of_observed_loans`)."""
    return spine_rows.withColumn("factor_value", F.expr(fill_rule("obs_value", "head", "tail")))


def fill_groups(spine_rows: DataFrame) -> DataFrame:
    """N1/N2: running count of known values, ascending (``head_group``) and
    descending (``tail_group``). Rows of one group share the same head/tail."""
    known = F.when(F.col("obs_value").isNull(), 0).otherwise(1)
    desc = Window.partitionBy(KEY).orderBy(F.col(DATE).desc())
    return spine_rows.select(
        KEY,
        DATE,
        F.col("obs_value").alias("factor_value"),
        F.sum(known).over(by_loan()).alias("head_group"),
        F.sum(known).over(desc).alias("tail_group"),
    )
