"""The staging job as one lazy Spark plan.

``StagePlan`` wires the operators together; each attribute is a named
intermediate DataFrame (the counterpart of one temp table of the source job),
built lazily and only once. (Building one runs small jobs: the calendar and the
population count.) Physical shape of the whole job:

    population --hash(deal_id)--> explode calendar --+
                                                      +-- union -> aggregate (deal,date)
    dpd window --hash(deal_id)-----------------------+      -> 1 sort, 6 window levels
    population (the same exchange), a row per loan ---- union -> aggregate per loan -> classify

The inputs are shuffled once each by ``deal_id``; there is no shuffle and no join
after that. Rows per loan are bounded by the calendar length (checked), so no
loan can be a hot key.

``per_loan`` has everything that both sinks need, a row per loan: the milestones,
and the loan's imputed rows as an array that the calendar's length bounds. A run
materialises that table and derives both sinks from it row by row.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stagecraft.functions.dates import sql_string
from stagecraft.operators import classify as cls
from stagecraft.operators import events as ev
from stagecraft.operators import milestones as ms
from stagecraft.operators import npl as npl_ops
from stagecraft.operators import runs
from stagecraft.operators import timeline as tl
from stagecraft.operators.windows import DATE, KEY, exprs
from stagecraft.sources.params import StageParams
from stagecraft.sources.tables import StageInputs, dpd_window, normalise_population, population_snapshot

DEFAULT_MODIFIED_BY = "stage_status"
DEFAULT_IMPUTE_MODIFIED_BY = "stage_status(impute)"

EVENT_BASE_COLUMNS = [
    KEY,
    "npl_date",
    "restructure_start_date",
    DATE,
    "factor_value",
    "row_no",
    "sum_dpd_3m",
    "max_dpd_9m",
    "max_dpd_12m",
    "max_x_nontdrm",
]
PUBLISHED_COLUMNS = [KEY, "prev_status", "stg3_flag", "path_tdr", "m_stg2", "cure_flag", "last_modified", "modified_by"]


class StagePlan:
    def __init__(
        self,
        inputs: StageInputs,
        params: StageParams,
        *,
        partitions: int | None = None,
        modified_by: str = DEFAULT_MODIFIED_BY,
        impute_modified_by: str = DEFAULT_IMPUTE_MODIFIED_BY,
        entity_code: str = ev.DEFAULT_ENTITY_CODE,
        per_loan: DataFrame | None = None,
        measured: bool = False,
    ) -> None:
        """``per_loan``: the materialised table of that name, if there is one. ``measured``: count
        what is dropped and filled while ``per_loan`` is computed (see :meth:`measures`)."""
        self.inputs = inputs
        self.params = params
        self._partitions = partitions
        self.modified_by = modified_by
        self.impute_modified_by = impute_modified_by
        self.entity_code = entity_code
        self._per_loan = per_loan
        self._observed: list[Observation] = []
        self._measured = measured and per_loan is None

    def _measure(self, df: DataFrame, **counts: str) -> DataFrame:
        """``df``, counted on its way: no job and no column of its own."""
        if not self._measured:
            return df
        self._observed.append(Observation())
        return df.observe(self._observed[-1], *[F.expr(c).alias(name) for name, c in counts.items()])

    def measures(self) -> dict[str, int]:
        """The counts, once a job has computed ``per_loan``; empty if the plan isn't measured."""
        return {name: value or 0 for o in self._observed for name, value in o.get.items()}

    # -- sources ------------------------------------------------------------
    @functools.cached_property
    def snapshot(self) -> DataFrame:
        return population_snapshot(self.inputs.population, self.params)

    @functools.cached_property
    def population(self) -> DataFrame:
        return normalise_population(self.snapshot, self.params)

    @functools.cached_property
    def partitions(self) -> int:
        """Partitions of the per-loan stages: as given, else sized from the timeline
        bound (population loans x calendar points; one count job), and at least
        ``spark.sql.shuffle.partitions``."""
        if self._partitions is not None:
            return self._partitions
        spark = self.inputs.dpd.sparkSession
        at_least = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        return tl.partitions_for(self.population.count(), len(self.calendar), at_least)

    @functools.cached_property
    def population_by_loan(self) -> DataFrame:
        """The population hash partitioned by loan; read twice, shuffled once."""
        return tl.loans_packed(self.population, self.partitions)

    @functools.cached_property
    def observations(self) -> DataFrame:
        return dpd_window(self.inputs.dpd, self.params, self.impute_modified_by)

    # -- timeline and fill --------------------------------------------------
    @functools.cached_property
    def calendar(self):
        return tl.observed_calendar(self.observations)

    @functools.cached_property
    def spine_candidates(self) -> DataFrame:
        return tl.spine_candidates(self.population_by_loan, self.params, self.calendar)

    @functools.cached_property
    def timeline(self) -> DataFrame:
        counted = self._measure(self.observations, rows_without_id=f"count_if({KEY} IS NULL)")
        return tl.timeline(self.spine_candidates, counted, self.partitions)

    @functools.cached_property
    def spine(self) -> DataFrame:
        """Spine rows with the observed value (NULL if missing) and ``observed``."""
        if not self._measured:
            return tl.spine_of_observed_loans(self.timeline)
        superseded = {"superseded_rows": "sum(n_superseded)"} if "n_superseded" in self.timeline.columns else {}
        own = self._measure(
            tl.loans_without_spine(self.timeline),
            **superseded,
            unmatched_rows="sum(CASE WHEN no_spine THEN n_obs END)",
            unmatched_loans="count_if(no_spine AND first_row)",
        )
        return tl.spine_of_observed_loans(own.drop("no_spine", "first_row"))

    @functools.cached_property
    def filled(self) -> DataFrame:
        return self._measure(
            tl.fill(self.spine), filled_rows="count_if(observed AND obs_value IS NULL AND factor_value IS NOT NULL)"
        )

    @functools.cached_property
    def imputed(self) -> DataFrame:
        """The rows to write back: from ``per_loan`` if it is materialised, else all that is needed
        is the filled timeline (no event, milestone or aggregate per loan)."""
        if self._per_loan is not None:
            rows = self._per_loan.select(KEY, F.explode("imputed").alias("row")).select(KEY, "row.*")
        else:
            rows = self.filled.where("NOT observed")
        return ev.imputed_rows(rows, self.params, self.impute_modified_by, self.entity_code)

    # -- events -------------------------------------------------------------
    @functools.cached_property
    def events(self) -> DataFrame:
        """Event table with the NPL date as first derived (before the reset)."""
        return ev.event_flags(ev.rolling_stats(self.filled, self.params), self.params)

    @functools.cached_property
    def events_final(self) -> DataFrame:
        """Event table after the NPL reset: ``npl_date`` is the reset date,
        ``npl_date_initial`` the original; plus stage-2 run starts."""
        # One window level for the cure-between lookup, the run starts and both
        # candidates of the first milestone of chain A.
        level = self.events.withColumns(
            {
                "zerobetween_date": npl_ops.cure_between_date(self.params),
                **runs.run_start_columns(),
                **exprs(ms.zero3_candidates(self.params)),
            }
        )
        chosen = level.withColumns(exprs(ms.zero3_choice(npl_ops.reset_to_month_end())))
        return chosen.withColumns(npl_ops.reset_columns()).withColumnsRenamed(
            {"npl_date": "npl_date_initial", "npl_date_reset": "npl_date"}
        )

    # -- per-loan milestones and classification -----------------------------
    @functools.cached_property
    def per_loan(self) -> DataFrame:
        if self._per_loan is not None:
            return self._per_loan
        candidates = self.events_final.where(ms.candidate_rows_sql(self.params))
        rows = ms.milestone_rows(candidates, self.params)
        # A row of its own for each loan: restructured loans without any timeline row still
        # get a result (branch B). It has no date and no flags, so no milestone sees it.
        own = self.population_by_loan.selectExpr(KEY, "loan_dates[1] AS restructure_start_date", "1 AS own")
        loans = ms.per_loan_milestones(rows.unionByName(own, allowMissingColumns=True), self.params)
        return self._measure(
            loans.withColumn("b_stage_before_tdr", F.expr(ms.stage_before_tdr_sql(self.params))),
            loans="count(1)",
            loans_without_rep_row="count_if(restructure_start_date IS NULL AND c_has_rep_row IS NULL)",
        )

    @functools.cached_property
    def classified(self) -> DataFrame:
        return cls.classify(self.per_loan, self.params)

    @functools.cached_property
    def stage_status(self) -> DataFrame:
        """O24: the published result, one row per loan."""
        return self.classified.selectExpr(
            KEY,
            "prev_status",
            "stg3_flag",
            "path_tdr",
            f"{cls.PUBLISHED_MONTHS_SQL} AS m_stg2",
            "cure_flag",
            f"{self.params.run_ts_sql} AS last_modified",
            f"{sql_string(self.modified_by)} AS modified_by",
        )

    # -- views used by individual operator queries --------------------------
    def branch(self, name: str) -> DataFrame:
        return self.classified.where(F.col("branch") == name)

    @functools.cached_property
    def stage2_runs(self) -> DataFrame:
        return runs.stage2_runs(self.events_final)
