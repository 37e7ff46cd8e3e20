"""Rolling DPD statistics, event flags and the last NPL date.

All rolling frames are ROWS frames over the loan's observed timeline, so
"n months" means n timeline points. They share one window specification with
``row_number``, so Spark evaluates them in a single window operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.functions.bands import NPL_THRESHOLD, flag_sql, is_npl, is_npl_sql, is_stage2_point_sql
from stagecraft.functions.dates import date_lit
from stagecraft.operators.windows import BY_LOAN, DATE, KEY, exprs, last_date_sql, trailing_sql
from stagecraft.operators.timeline import preferred
from stagecraft.sources.params import StageParams

# Stamped on imputed DPD rows: the factor type is fixed; the entity code is a run
# parameter (set it to the entity of the DPD table), this is only its default.
IMPUTED_FACTOR_TYPE = "DPD"
DEFAULT_ENTITY_CODE = "ENTITY"

EVENT_FLAGS = ["dpd_12m_event", "dpd_9m_event", "dpd_3m_event", "dpd3090_event", "dpd_x_nontdrm_event"]


def rolling_stats(filled: DataFrame, params: StageParams) -> DataFrame:
    """``row_no`` and the 3/9/12/x-point rolling sum and maxima of the filled DPD.

    ``npl_date`` = latest date with DPD > 90 over the base rows (``npl_observed``,
    computed upstream) and the imputed rows (unobserved spine rows).
    ``prev_stage2`` is the previous row's stage-2 flag (for the run starts).
    """
    v = "factor_value"
    level = {
        "row_no": f"row_number() {BY_LOAN}",
        "sum_dpd_3m": f"sum({v}) {trailing_sql(3)}",
        "max_dpd_9m": f"max({v}) {trailing_sql(9)}",
        "max_dpd_12m": f"max({v}) {trailing_sql(12)}",
        "max_x_nontdrm": f"CAST(max({v}) {trailing_sql(params.x)} AS INT)",
        "npl_imputed": last_date_sql(f"NOT observed AND {is_npl_sql(v)}"),
        "prev_stage2": f"lag({flag_sql(is_stage2_point_sql(v))}, 1) {BY_LOAN}",
    }
    return filled.withColumns(exprs(level)).withColumn("npl_date", F.expr("greatest(npl_observed, npl_imputed)"))


def event_flags(stats: DataFrame, params: StageParams) -> DataFrame:
    """The five 0/1 flags (a NULL statistic gives 0)."""
    flags = {
        "dpd_12m_event": "max_dpd_12m = 0 AND row_no >= 12",
        "dpd_9m_event": f"max_dpd_9m <= {NPL_THRESHOLD} AND factor_value = 0 AND row_no > 8",
        "dpd_3m_event": "sum_dpd_3m = 0 AND row_no >= 3",
        "dpd3090_event": is_stage2_point_sql("factor_value"),
        "dpd_x_nontdrm_event": f"max_x_nontdrm = 0 AND row_no >= {params.x}",
    }
    return stats.withColumns(exprs({k: flag_sql(c) for k, c in flags.items()}))


def imputed_rows(
    rows: DataFrame, params: StageParams, modified_by: str, entity_code: str = DEFAULT_ENTITY_CODE
) -> DataFrame:
    """S10/O5: spine rows with no base row (deal_id, factor_date, factor_value), audit-stamped,
    ready to append.

    Base rows whose value was NULL are filled in memory but not written back:
    their key already exists.
    """
    cols = [
        KEY,
        F.lit(entity_code).alias("entity"),
        F.lit(IMPUTED_FACTOR_TYPE).alias("factor_type"),
        DATE,
        "factor_value",
    ]
    cols.append(F.expr(params.run_ts_sql).alias("last_modified"))
    cols.append(F.lit(modified_by).alias("modified_by"))
    return rows.select(*cols)


def last_npl_dates(obs: DataFrame, imputed: DataFrame, params: StageParams) -> DataFrame:
    """O8 as a standalone operator: latest NPL date per loan over base plus imputed
    rows inside the window (a pre-aggregation before any join)."""
    rows = preferred(obs).unionByName(imputed.select(KEY, DATE, "factor_value"))
    d = F.col(DATE)
    return (
        rows.where(
            is_npl(F.col("factor_value"))
            & (d >= date_lit(params.min_factor_date))
            & (d <= date_lit(params.reporting_date))
        )
        .groupBy(KEY)
        .agg(F.max(DATE).alias("npl_date"))
    )
