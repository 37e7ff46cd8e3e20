"""Input tables of a staging run and their filtered scans.

The job reads four tables:

``entity``      one row, ``cob_date``
``config``      ``config_id``, ``config_value``
``population``  loan snapshot: ``deal_tfi_id``, ``reporting_date``, ``value_date``,
                ``segment_pool_id``, ``restructure_start_date``
``dpd``         month-end days past due: ``deal_id``, ``factor_date``, ``factor_value``

Both scans keep predicates on plain columns and select only the columns used,
so a parquet/Delta source sees ``PushedFilters`` and a narrow ``ReadSchema``.
Ids that are strings are right-trimmed here, once, as blanks at the end don't tell
ids apart in the source job. DPD values keep the type they are stored in.
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame

from stagecraft.functions.bands import EXCLUDED_POOLS
from stagecraft.functions.dates import sql_date, sql_string
from stagecraft.sources.params import StageParams


@dataclasses.dataclass(frozen=True)
class StageInputs:
    entity: DataFrame
    config: DataFrame
    population: DataFrame
    dpd: DataFrame


def read_inputs(spark, paths: dict[str, str], fmt: str = "parquet") -> StageInputs:
    """Load the four tables from storage (any format Spark reads; parquet by default)."""
    reader = spark.read.format(fmt)
    return StageInputs(
        entity=reader.load(paths["entity"]),
        config=reader.load(paths["config"]),
        population=reader.load(paths["population"]),
        dpd=reader.load(paths["dpd"]),
    )


def id_sql(df: DataFrame, column: str) -> str:
    """A loan id without blanks at its end (other types as they are)."""
    return f"rtrim({column})" if df.schema[column].dataType.typeName() == "string" else column


def population_snapshot(population: DataFrame, params: StageParams) -> DataFrame:
    """S1: the snapshot at the segmentation date, originated by the reporting date,
    excluding segment pools 2, 3, 4, 6, 7 (a NULL pool is excluded too)."""
    pools = ", ".join(str(p) for p in EXCLUDED_POOLS)
    return population.where(
        f"reporting_date = {sql_date(params.segmentation_date)} "
        f"AND value_date <= {sql_date(params.reporting_date)} "
        f"AND NOT segment_pool_id IN ({pools})"
    ).selectExpr(
        f"{id_sql(population, 'deal_tfi_id')} AS deal_tfi_id",
        "to_date(reporting_date) AS reporting_date",
        "to_date(value_date) AS value_date",
        "CAST(segment_pool_id AS INT) AS segment_pool_id",
        "to_date(restructure_start_date) AS restructure_start_date",
    )


def normalise_population(snapshot: DataFrame, params: StageParams) -> DataFrame:
    """O2: restamp to the reporting date and forget restructurings after it.

    Output is keyed by ``deal_id`` (renamed from ``deal_tfi_id``).
    """
    rep = sql_date(params.reporting_date)
    return snapshot.selectExpr(
        "deal_tfi_id AS deal_id",
        f"{rep} AS reporting_date",
        "value_date",
        "segment_pool_id",
        f"CASE WHEN restructure_start_date > {rep} THEN CAST(NULL AS DATE) ELSE restructure_start_date END "
        "AS restructure_start_date",
    )


def dpd_window(dpd: DataFrame, params: StageParams, imputed_by: str | None = None) -> DataFrame:
    """S2: observations from the window start to the reporting date, three columns; the
    value as it is stored (integer, decimal or floating point).

    Rows that an earlier run imputed look like observations (H6). Where the table says who wrote
    a row (``modified_by``), a fourth column ``imputed`` tells them apart: those by ``imputed_by``."""
    origin = []
    if imputed_by is not None and "modified_by" in dpd.columns:
        origin = [f"coalesce(rtrim(modified_by) = {sql_string(imputed_by)}, false) AS imputed"]
    return dpd.where(
        f"factor_date >= {sql_date(params.min_factor_date)} AND factor_date <= {sql_date(params.reporting_date)}"
    ).selectExpr(f"{id_sql(dpd, 'deal_id')} AS deal_id", "to_date(factor_date) AS factor_date", "factor_value", *origin)
