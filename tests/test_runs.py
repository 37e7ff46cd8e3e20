from portfolio import MONTHS, PARAMS, inputs
from stagecraft.plans.staging import StagePlan


def test_stage2_runs_gaps_and_islands(spark):
    # flags 0,1,1,0,1 -> runs (Feb..Mar, 2) and (May..May, 1)
    values = [0, 45, 45, 0, 45]
    plan = StagePlan(inputs(spark, [("A", m, v) for m, v in enumerate(values)], ["A"]), PARAMS)
    runs = sorted(tuple(r) for r in plan.stage2_runs.select("start_date", "end_date", "streak").collect())
    assert runs == [(MONTHS[1], MONTHS[2], 2), (MONTHS[4], MONTHS[4], 1)]
    # the run ending at the reporting date is the current streak
    row = plan.per_loan.where("deal_id = 'A'").first()
    assert row.c_streak == 1


def test_rolling_flags(spark):
    values = [0, 0, 0, 45, 120]
    plan = StagePlan(inputs(spark, [("A", m, v) for m, v in enumerate(values)], ["A"]), PARAMS)
    ev = plan.events.orderBy("factor_date").collect()
    assert [r.row_no for r in ev] == [1, 2, 3, 4, 5]
    assert [r.sum_dpd_3m for r in ev] == [0, 0, 0, 45, 165]
    assert [r.dpd_3m_event for r in ev] == [0, 0, 1, 0, 0]
    assert [r.dpd3090_event for r in ev] == [0, 0, 0, 1, 0]
    assert {r.npl_date for r in ev} == {MONTHS[4]}
