"""Natural fixture (FIXTURES.md section 3) at sf0.001: counts and invariants."""

import pytest

from conftest import SF_SMALL
from stagecraft.plans.staging import StagePlan
from stagecraft.sources.fixtures import natural_inputs


@pytest.fixture(scope="module")
def plan(spark):
    return StagePlan(*natural_inputs(spark, SF_SMALL))


def test_counts(plan):
    assert plan.population.count() == 150
    assert plan.observations.count() == 1410
    assert plan.filled.count() == 10179
    assert plan.imputed.count() == 8976
    assert plan.stage_status.count() == 150


def test_timeline_keys_unique(plan):
    f = plan.filled
    assert f.count() == f.select("deal_id", "factor_date").distinct().count()


def test_branches_partition_the_output(plan):
    counts = {r.branch: r["count"] for r in plan.classified.groupBy("branch").count().collect()}
    assert sum(counts.values()) == plan.stage_status.count()
    assert set(counts) <= {"A", "B", "C"}


def test_partition_count_does_not_change_result(spark, plan):
    other = StagePlan(plan.inputs, plan.params, partitions=3)
    a = sorted(tuple(r) for r in plan.stage_status.collect())
    b = sorted(tuple(r) for r in other.stage_status.collect())
    assert a == b


def test_input_order_does_not_change_result(spark, plan):
    from stagecraft.sources.tables import StageInputs

    shuffled = StageInputs(
        entity=plan.inputs.entity,
        config=plan.inputs.config,
        population=plan.inputs.population.orderBy("value_date", "deal_tfi_id"),
        dpd=plan.inputs.dpd.repartition(5).orderBy("factor_value"),
    )
    other = StagePlan(shuffled, plan.params)
    assert sorted(tuple(r) for r in plan.stage_status.collect()) == sorted(
        tuple(r) for r in other.stage_status.collect()
    )


def test_every_population_loan_is_accounted_for(plan):
    # H3: population = published rows + never-restructured loans without a row at the reporting date
    pop = plan.population
    dropped = plan.per_loan.where("restructure_start_date IS NULL AND c_has_rep_row IS NULL").count()
    assert pop.count() == plan.stage_status.count() + dropped
