import pytest
from pyspark.sql import functions as F

from portfolio import MONTHS, PARAMS, inputs
from stagecraft.plans.staging import StagePlan

# B reports every month, so the portfolio calendar has all five month-ends.
CALENDAR = [("B", m, 0) for m in range(5)]


def _filled(spark, rows, loans, **kw):
    plan = StagePlan(inputs(spark, CALENDAR + rows, ["B", *loans]), PARAMS, **kw)
    out = {}
    for r in plan.filled.orderBy("deal_id", "factor_date").collect():
        out.setdefault(r.deal_id, []).append(r.factor_value)
    return plan, out


def test_fill_takes_larger_neighbour(spark):
    # NULL (missing), 5, NULL (observed NULL), 2, NULL (missing)
    _, got = _filled(spark, [("A", 1, 5), ("A", 2, None), ("A", 3, 2)], ["A"])
    assert got["A"] == [5, 5, 5, 2, 2]


def test_fill_all_null_stays_null(spark):
    _, got = _filled(spark, [("C", m, None) for m in range(5)], ["C"])
    assert got["C"] == [None] * 5


def test_fill_negative_head_with_missing_tail_is_null(spark):
    _, got = _filled(spark, [("D", 0, -4)], ["D"])
    assert got["D"] == [-4, None, None, None, None]


def test_imputed_rows_are_only_missing_keys(spark):
    plan, _ = _filled(spark, [("A", 1, 5), ("A", 2, None), ("A", 3, 2)], ["A"])
    keys = sorted((r.deal_id, r.factor_date) for r in plan.imputed.collect())
    # Observed NULL (A, March) is filled in memory but not written back.
    assert keys == [("A", MONTHS[0]), ("A", MONTHS[4])]


def test_loan_without_population_row_gets_no_timeline(spark):
    plan = StagePlan(inputs(spark, CALENDAR + [("Z", 0, 120)], ["B"]), PARAMS)
    assert plan.filled.where("deal_id = 'Z'").count() == 0


def test_daily_calendar_of_more_than_5000_dates(spark):
    """The longest calendar that a window of 14 years can have: a date for each day."""
    import dataclasses
    import datetime as dt

    from stagecraft.sources.tables import StageInputs

    start = dt.date(2005, 4, 30)
    params = dataclasses.replace(PARAMS, min_factor_date=start)
    days = (params.reporting_date - start).days + 1
    base = inputs(spark, [], ["A", "B"])
    daily = spark.range(days).selectExpr("'B' AS deal_id", f"date_add(DATE'{start}', CAST(id AS INT)) AS factor_date", "0 AS factor_value")
    one = spark.createDataFrame([("A", params.reporting_date, 45)], "deal_id string, factor_date date, factor_value int")
    population = base.population.withColumn("value_date", F.lit(start))
    plan = StagePlan(StageInputs(base.entity, base.config, population, daily.union(one)), params)
    assert days > 5000 and len(plan.calendar) == days
    got = plan.filled.groupBy("deal_id").agg(F.count("*"), F.sum("factor_value")).collect()
    assert sorted(tuple(r) for r in got) == [("A", days, 45 * days), ("B", days, 0)]


def test_duplicate_observation_fails(spark):
    plan = StagePlan(inputs(spark, CALENDAR + [("B", 2, 30)], ["B"]), PARAMS)
    with pytest.raises(Exception, match="duplicate"):
        plan.filled.collect()


def test_rows_that_the_job_drops_do_no_harm(spark):
    """Duplicates of loans outside the population, excluded pools and rows without an id."""
    from stagecraft.sources.tables import StageInputs

    base = inputs(spark, CALENDAR + [("Z", 1, 5), ("Z", 1, 6), ("P", 2, 5), ("P", 2, 5)], ["B", "P"], pools={"P": 4})
    unnamed = spark.createDataFrame([(None, MONTHS[0], 120), (None, MONTHS[0], 120)], base.dpd.schema)
    plan = StagePlan(StageInputs(base.entity, base.config, base.population, base.dpd.union(unnamed)), PARAMS)
    assert {r.deal_id for r in plan.filled.collect()} == {"B"}
    assert [r.deal_id for r in plan.stage_status.collect()] == ["B"]


def test_blanks_at_the_end_of_ids_do_not_matter(spark):
    from stagecraft.sources.tables import StageInputs

    base = inputs(spark, CALENDAR + [("A", 4, 45)], ["B", "A"])
    padded = base.population.withColumn("deal_tfi_id", F.concat("deal_tfi_id", F.lit("   ")))
    plan = StagePlan(StageInputs(base.entity, base.config, padded, base.dpd), PARAMS)
    assert sorted(r.deal_id for r in plan.stage_status.collect()) == ["A", "B"]


def test_fractional_values_keep_their_bands(spark):
    """0.5, 0.5, 0.5, 90.5, 30.5: an NPL date at 90.5, no zero event, a stage-2 point at 30.5."""
    from stagecraft.sources.tables import StageInputs

    base = inputs(spark, CALENDAR, ["A", "B"])
    values = [0.5, 0.5, 0.5, 90.5, 30.5]
    for kind in ("double", "decimal(10,2)"):
        rows = spark.createDataFrame([("A", MONTHS[i], v) for i, v in enumerate(values)], "deal_id string, factor_date date, factor_value double")
        dpd = base.dpd.unionByName(rows).withColumn("factor_value", F.col("factor_value").cast(kind))
        plan = StagePlan(StageInputs(base.entity, base.config, base.population, dpd), PARAMS)
        events = plan.events.where("deal_id = 'A'").orderBy("factor_date").collect()
        assert [float(e.factor_value) for e in events] == values
        assert {e.npl_date for e in events} == {MONTHS[3]}
        assert [e.dpd_3m_event for e in events] == [0] * 5
        assert [e.dpd3090_event for e in events] == [0, 0, 0, 0, 1]
        assert [e.max_x_nontdrm for e in events] == [0, 0, 0, 90, 90]


def test_duplicate_population_row_without_observations_fails(spark):
    from stagecraft.sources.tables import StageInputs

    base = inputs(spark, CALENDAR, ["B", "R"], rsd={"R": MONTHS[2]})
    twice = base.population.unionByName(base.population.where("deal_tfi_id = 'R'"))
    with pytest.raises(Exception, match="duplicate deal_id"):
        StagePlan(StageInputs(base.entity, base.config, twice, base.dpd), PARAMS).stage_status.collect()


def test_duplicate_population_row_fails(spark):
    from stagecraft.sources.tables import StageInputs

    base = inputs(spark, CALENDAR, ["B"])
    twice = StageInputs(base.entity, base.config, base.population.unionByName(base.population), base.dpd)
    with pytest.raises(Exception, match="duplicate deal_id"):
        StagePlan(twice, PARAMS).filled.collect()


def test_population_filter_and_restamp(spark):
    plan = StagePlan(
        inputs(spark, CALENDAR, ["B", "P2", "PN", "R"], pools={"P2": 2, "PN": None},
               rsd={"R": MONTHS[4].replace(day=1).replace(month=6)}),
        PARAMS,
    )
    rows = {r.deal_id: r for r in plan.population.collect()}
    assert sorted(rows) == ["B", "R"]
    assert rows["R"].restructure_start_date is None  # after the reporting date
    assert all(r.reporting_date == PARAMS.reporting_date for r in rows.values())


def test_partition_count_grows_with_the_timeline_bound():
    from stagecraft.operators.timeline import partitions_for

    assert partitions_for(1_500, 79, at_least=8) == 8
    # reference scale: 1.56M loans x 23 points, and a thousand times that
    assert partitions_for(1_555_590, 23, at_least=200) == 200
    assert partitions_for(1_555_590_000, 23, at_least=200) == 17_890


def test_empty_window_leaves_only_restructured_loans(spark):
    # No observation in the window: no calendar, no timeline; every restructured
    # loan is classified by condition 7 and non-restructured loans get no row.
    rows = [("A", 0, 120)]
    base = inputs(spark, rows, ["A", "R"], rsd={"R": MONTHS[2]})
    from stagecraft.sources.tables import StageInputs

    empty = StageInputs(base.entity, base.config, base.population, base.dpd.where("factor_date > DATE'2030-01-01'"))
    plan = StagePlan(empty, PARAMS)
    assert plan.calendar == []
    got = [(r.deal_id, r.branch, r.condition_no, r.calculated_stage) for r in plan.classified.collect()]
    assert got == [("R", "B", 7, 1)]
