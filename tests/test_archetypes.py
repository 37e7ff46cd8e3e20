"""Golden archetypes (FIXTURES.md section 2): every reachable condition, at sf0.001."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stagecraft.operators.classify import PUBLISHED_MONTHS_SQL
from stagecraft.plans.staging import StagePlan
from stagecraft.sources.fixtures import ARCHETYPES, archetype_inputs

# name -> (branch, condition, stage, prev_status, stg3_flag, path_tdr, published m_stg2, cure_flag)
EXPECTED = {
    "R01": ("C", 12, 1, None, "N", None, 0, None),
    "R02": ("C", 13, 2, None, "N", None, 3, None),
    "R03": ("C", 15, 3, None, "Y", None, 0, None),
    "R04": ("C", 16, 1, None, "N", None, 0, 1),
    "R05": ("C", 17, 2, None, "N", None, 2, 1),
    "R06": ("C", None, 1, None, "N", None, 0, None),
    "R08": ("A", 1, 3, "c3", "Y", "c3-c2-c1", 0, None),
    "R09": ("A", 2, 2, "c2", "Y", "c3-c2-c1", 5, None),
    "R10": ("A", 2, 2, "c2", "Y", "c3-c2-c1", 7, None),
    "R11": ("A", 3, 1, "c1", "N", None, 0, None),
    "R12": ("A", 4, 1, "c1", "N", None, 0, None),
    "R13": ("A", 5, 2, "c2", "N", "c2-c1", 6, None),
    "R14": ("A", 6, 2, "c2", "N", "c2-c1", 6, None),
    "R15": ("A", 6, 2, "c2", "N", "c2-c1", None, None),
    "R16": ("B", 7, 1, "c1", "N", None, 0, None),
    "R17": ("B", 8, 2, "c2", "N", "c2-c1", 7, None),
    "R18": ("B", 8, 2, "c2", "N", "c2-c1", 15, None),
    "R19": ("B", 9, 1, "c1", "N", None, 0, None),
    "R20": ("B", 11, 2, "c2", "N", "c2-c1", 1, None),
    "R21": ("B", 12, 2, "c2", "N", "c2-c1", 4, None),
    "R22": ("B", None, 1, "c1", "N", "c2-c1", 0, None),
    "R23": ("B", 7, 1, "c1", "N", None, 0, 1),
    "R24": ("B", 8, 2, "c2", "N", "c2-c1", 4, 1),
    "R25": ("B", 9, 1, "c1", "N", None, 0, 1),
    "R26": ("B", 7, 1, "c1", "N", None, 0, None),
    "R27": ("B", 7, 1, "c1", "N", None, 0, None),
    "R28": ("C", 12, 1, None, "N", None, 0, None),
    "R29": ("C", 15, 3, None, "Y", None, 0, None),
    "R30": ("C", 12, 1, None, "N", None, 0, None),
    "R31": ("C", 13, 2, None, "N", None, 6, None),
    "R32": ("C", 16, 1, None, "N", None, 0, 1),
    "R33": ("C", 16, 1, None, "N", None, 0, 1),
    "R34": ("C", 13, 2, None, "N", None, 5, None),
    "R35": ("A", 3, 1, "c1", "N", None, 0, None),
    "R36": ("C", 15, 3, None, "Y", None, 0, None),
    "R37": ("C", 15, 3, None, "Y", None, 0, None),
    "R38": ("C", 16, 1, None, "N", None, 0, 1),
    "R39": ("C", 15, 3, None, "Y", None, 0, None),
    "R40": ("C", 15, 3, None, "Y", None, 0, None),
}
NO_ROW = {"R07"}


@pytest.fixture(scope="module")
def arch_plan(spark):
    return StagePlan(*archetype_inputs(spark, SF_SMALL))


@pytest.fixture(scope="module")
def arch_results(arch_plan):
    df = arch_plan.classified.select(
        "deal_id", "branch", "condition_no", "calculated_stage", "prev_status", "stg3_flag", "path_tdr",
        F.expr(PUBLISHED_MONTHS_SQL).alias("m_pub"), "cure_flag",
    )
    return {r.deal_id: tuple(r)[1:] for r in df.collect()}


def test_every_archetype_matches(arch_results):
    seen = set()
    for deal, got in arch_results.items():
        name = ARCHETYPES[int(deal[1:]) % len(ARCHETYPES)][0]
        assert name not in NO_ROW, deal
        assert got == EXPECTED[name], (deal, name)
        seen.add(name)
    assert seen == set(EXPECTED)


def test_expected_counts(arch_plan):
    assert arch_plan.population.count() == 129
    assert arch_plan.stage_status.count() == 125
    assert arch_plan.imputed.count() == 85


def test_output_keys_unique(arch_plan):
    out = arch_plan.stage_status
    assert out.count() == out.select("deal_id").distinct().count()


def test_dropped_loans_are_the_ones_without_reporting_row(arch_plan):
    dropped = arch_plan.per_loan.where("restructure_start_date IS NULL AND c_has_rep_row IS NULL")
    names = {ARCHETYPES[int(r.deal_id[1:]) % len(ARCHETYPES)][0] for r in dropped.collect()}
    assert names == NO_ROW
    assert arch_plan.population.count() == arch_plan.stage_status.count() + dropped.count()
