"""The end-to-end run and its two sinks.

The job has two outputs:

* the stage status table, fully replaced;
* the imputed DPD rows, appended to the DPD table or another one (only keys that it lacks).

Both are derived from one materialised table with a row per loan, without another shuffle of
it. The result is written first and the imputed rows last, so no job of this run reads the DPD
table after it has been appended to. :mod:`stagecraft.sources.storage` says what replacing and
appending guarantee, :mod:`stagecraft.sources.stages` how a run that was cut off goes on.
"""

from __future__ import annotations

import dataclasses

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stagecraft.functions.dates import sql_date
from stagecraft.operators.windows import DATE, KEY
from stagecraft.plans.staging import StagePlan
from stagecraft.sources.params import ParameterError, StageParams
from stagecraft.sources.stages import RunStage
from stagecraft.sources.storage import append_rows, exists, matched_to, missing_rows, read_table, replace_table
from stagecraft.sources.tables import StageInputs


@dataclasses.dataclass
class RunReport:
    """What a run did.

    Counts of what it dropped or filled come with the jobs that it runs anyway; they are None
    where the run went on from an earlier attempt's table, which computed none of them:
    ``rows_without_id``        DPD rows in the window without a loan id
    ``unmatched_rows``         DPD rows in the window of loans without a timeline (not in the
                               population, or originated after the last observed date)
    ``unmatched_loans``        loans of those rows
    ``superseded_rows``        rows imputed by an earlier run that an observed row has come for
    ``filled_rows``            observed rows without a value that were filled
    ``loans``                  loans with a timeline or a result
    ``loans_without_rep_row``  loans never restructured that have no row at the reporting date,
                               and so no result
    """

    result_rows: int
    imputed_rows: int
    materialised: str  # "checkpoint", "persist" or "stage"
    resumed: bool = False
    rows_without_id: int | None = None
    unmatched_rows: int | None = None
    unmatched_loans: int | None = None
    superseded_rows: int | None = None
    filled_rows: int | None = None
    loans: int | None = None
    loans_without_rep_row: int | None = None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``), if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current and current.startswith("file:") and not sc.master.startswith("local"):
        raise ParameterError(f"checkpoint folder {current} is local to each machine of the cluster")
    if current and not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir()


def materialise(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once. ``checkpoint`` cuts the lineage (a lost executor costs no
    recomputation) and needs a checkpoint folder; ``persist`` keeps blocks on the executors
    and recomputes lost ones."""
    if how == "checkpoint":
        if not checkpoint_dir(df.sparkSession):
            raise ParameterError("set spark.checkpoint.dir, or ask for materialise_by='persist'")
        return df.checkpoint(eager=True)
    if how != "persist":
        raise ParameterError(f"unknown way to materialise: {how!r}")
    out = df.persist(StorageLevel.MEMORY_AND_DISK)
    out.count()
    return out


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder, which stage tables go below; an error without one."""
    folder = checkpoint_dir(spark)
    if not folder:
        raise ParameterError("set spark.checkpoint.dir, or name a stage folder")
    return folder


def run_stage_status(
    inputs: StageInputs,
    params: StageParams,
    result_target: str,
    imputed_target: str | None = None,
    fmt: str = "parquet",
    materialise_by: str = "checkpoint",
    versioned: bool = False,
    run_id: str | None = None,
    stage_folder: str | None = None,
    **plan_options,
) -> RunReport:
    """Run the whole job: publish the stage status (replacing it), then append the
    imputed DPD rows to ``imputed_target`` (the DPD table) if given. ``params.run_ts`` is
    stamped on the rows of both.

    With a ``run_id`` the per-loan table is a stage table below ``stage_folder`` (else the
    checkpoint folder): another attempt with that id goes on from it, and it is deleted when the
    run has succeeded. ``versioned`` publishes a path as a version."""
    if params.run_ts is None:
        raise ParameterError("a run needs run_ts, the audit timestamp of the rows it writes")
    spark = inputs.dpd.sparkSession
    stage = before = None
    if run_id is not None:
        materialise_by = "stage"
        stage = RunStage(spark, stage_folder or f"{shared_folder(spark).rstrip('/')}/stagecraft-runs", run_id)
        before = stage.resumable(params, plan_options)
    if before is not None:
        params = before
        lazy = StagePlan(inputs, params, per_loan=stage.read(), **plan_options)
    else:
        lazy = StagePlan(inputs, params, measured=True, **plan_options)
    if imputed_target is not None and exists(spark, imputed_target, fmt):
        matched_to(lazy.imputed, read_table(spark, imputed_target, fmt))  # fails before anything is written
    if before is not None:
        per_loan = lazy.per_loan
    elif stage is not None:
        per_loan = stage.write(lazy.per_loan, params, plan_options)
    else:
        per_loan = materialise(lazy.per_loan, materialise_by)
    plan = StagePlan(inputs, params, per_loan=per_loan, **plan_options)
    try:
        replace_table(plan.stage_status, result_target, fmt, versioned)
        # Count what was written (file footers), not by running the plan again.
        n_result = read_table(spark, result_target, fmt).count()
        if imputed_target is None:
            n_imputed = per_loan.agg(F.sum(F.size("imputed"))).first()[0] or 0
        else:
            # Last: nothing of this run reads the DPD table after this append.
            n_imputed = _append_imputed(plan, imputed_target, fmt)
    finally:
        if materialise_by == "persist":
            per_loan.unpersist()
    if stage is not None:
        stage.drop()
    return RunReport(n_result, n_imputed, materialise_by, resumed=before is not None, **lazy.measures())


def _append_imputed(plan: StagePlan, target: str, fmt: str) -> int:
    """Append the imputed rows that ``target`` lacks; returns how many."""
    spark, params = plan.inputs.dpd.sparkSession, plan.params
    rows = plan.imputed
    if exists(spark, target, fmt):
        held = read_table(spark, target, fmt)
        window = f"{DATE} >= {sql_date(params.min_factor_date)} AND {DATE} <= {sql_date(params.reporting_date)}"
        rows = matched_to(missing_rows(rows, held, [KEY, DATE], window), held)
    count = Observation()
    append_rows(rows.observe(count, F.count(F.lit(1)).alias("rows")), target, fmt)
    return count.get["rows"]
