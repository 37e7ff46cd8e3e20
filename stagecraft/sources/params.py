"""Run parameters.

The job is driven by three scalars read from two tiny tables plus a window
start. They are resolved on the driver once, before any heavy work, and then
used as typed literals, so Catalyst can fold them and push the date window
into the scan.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagecraft.functions.dates import prev_month_end_py

# Fixed value: config key of the cure length in months.
CURE_MONTHS_CONFIG_ID = 7002


class ParameterError(ValueError):
    """Raised before any write when the run parameters are unusable."""


@dataclasses.dataclass(frozen=True)
class StageParams:
    """Resolved parameters of one staging run.

    ``min_factor_date``   first month-end of the observation window
    ``segmentation_date`` snapshot date of the population (the entity's cob date)
    ``reporting_date``    month-end before the segmentation date
    ``cure_months``       consecutive zero-DPD months that count as a cure ("x")
    ``run_ts``            audit timestamp stamped on written rows, without a zone (as the
                          source job's); required in a run
    """

    min_factor_date: _dt.date
    segmentation_date: _dt.date
    cure_months: int
    run_ts: _dt.datetime | None = None

    def __post_init__(self) -> None:
        if self.segmentation_date is None:
            raise ParameterError("segmentation (cob) date is NULL")
        if self.min_factor_date is None:
            raise ParameterError("window start is NULL")
        if self.cure_months is None or int(self.cure_months) < 1:
            raise ParameterError(f"cure length must be >= 1 month, got {self.cure_months!r}")
        if self.reporting_date < self.min_factor_date:
            raise ParameterError(
                f"reporting date {self.reporting_date} precedes window start {self.min_factor_date}"
            )

    @property
    def reporting_date(self) -> _dt.date:
        return prev_month_end_py(self.segmentation_date)

    @property
    def run_ts_sql(self) -> str:
        """The audit timestamp of every row that a run writes: one expression for both
        sinks, and no zone in it, so neither process nor session zone can shift it."""
        if self.run_ts is None:
            return "CAST(NULL AS TIMESTAMP_NTZ)"
        return f"CAST('{self.run_ts.replace(tzinfo=None).isoformat(sep=' ')}' AS TIMESTAMP_NTZ)"

    @property
    def x(self) -> int:
        return int(self.cure_months)


def _single_scalar(df: DataFrame, column: str, what: str):
    # Two rows at most reach the driver: enough to tell "one" from "many".
    rows = df.select(column).limit(2).collect()
    if len(rows) != 1:
        raise ParameterError(f"{what}: expected exactly one row, found {len(rows)}{'+' if len(rows) > 1 else ''}")
    return rows[0][0]


def resolve_params(
    entity: DataFrame,
    config: DataFrame,
    min_factor_date: _dt.date,
    run_ts: _dt.datetime | None = None,
) -> StageParams:
    """Read the cob date (one-row ``entity``) and the cure length (``config`` key 7002)."""
    cob = _single_scalar(entity, "cob_date", "entity.cob_date")
    if isinstance(cob, _dt.datetime):
        cob = cob.date()
    x = _single_scalar(
        config.where(F.col("config_id") == CURE_MONTHS_CONFIG_ID).select(
            F.col("config_value").cast("int").alias("x")
        ),
        "x",
        f"config {CURE_MONTHS_CONFIG_ID}",
    )
    return StageParams(min_factor_date=min_factor_date, segmentation_date=cob, cure_months=x, run_ts=run_ts)


def params_frame(entity: DataFrame, params: StageParams) -> DataFrame:
    """The resolved parameters as a one-row DataFrame built over ``entity``."""
    from stagecraft.functions.dates import date_lit, prev_month_end_sql

    return entity.select(
        date_lit(params.min_factor_date).alias("min_factor_date"),
        F.to_date("cob_date").alias("segmentation_date"),
        F.expr(prev_month_end_sql("to_date(cob_date)")).alias("reporting_date"),
        F.lit(params.x).cast("int").alias("x_nontdr"),
    )
