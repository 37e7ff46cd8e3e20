"""Plan regression: the job shuffles each input once (by loan), and nothing after the union.

The last test runs with adaptive execution on, over the table that a run materialises.
"""

import re

import pytest

from conftest import SF_SMALL
from stagecraft.plans.staging import StagePlan
from stagecraft.sources.fixtures import archetype_inputs, natural_inputs
from stagecraft.sources.sinks import materialise


@pytest.fixture
def static_planning(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_exchanges_only_on_inputs(spark, static_planning):
    lines = executed(StagePlan(*natural_inputs(spark, SF_SMALL)).stage_status)
    exchanges = [line for line in lines if "Exchange " in line and "ReusedExchange" not in line]
    # population, observations, and the fixture's own (deal_id, factor_date) aggregate of orders
    assert len(exchanges) == 3, "\n".join(exchanges)
    assert all("hashpartitioning(deal_id" in line for line in exchanges)
    assert sum("ReusedExchange" in line for line in lines) == 1  # the population, for the rows of its own
    assert not any("Join" in line for line in lines)
    windows = [line for line in lines if "Window [" in line]
    sorts = [line for line in lines if "Sort [deal_id" in line and "factor_date" in line]
    assert len(windows) == 6
    assert len(sorts) == 1  # one sort serves every window level


@pytest.mark.parametrize("fixture", [natural_inputs, archetype_inputs])
def test_both_sinks_follow_from_the_materialised_table(spark, fixture):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    inputs, params = fixture(spark, SF_SMALL)
    lazy = StagePlan(inputs, params)
    plan = StagePlan(inputs, params, per_loan=materialise(lazy.per_loan))
    for sink in (plan.stage_status, plan.imputed):
        sink.collect()
        text = "\n".join(executed(sink))
        assert "Scan ExistingRDD" in text
        assert not re.search("Exchange|Sort|Window|Aggregate|Join", text), text
    assert sorted(map(tuple, plan.stage_status.collect())) == sorted(map(tuple, lazy.stage_status.collect()))


@pytest.mark.parametrize("fixture", [natural_inputs, archetype_inputs])
def test_imputed_rows_need_the_filled_timeline_only(spark, static_planning, fixture):
    inputs, params = fixture(spark, SF_SMALL)
    lazy = StagePlan(inputs, params)
    text = "\n".join(executed(lazy.imputed))
    assert "collect_list" not in text and len(re.findall(r"Window \[", text)) <= 2, text
    from_loans = StagePlan(inputs, params, per_loan=lazy.per_loan)
    assert sorted(map(str, lazy.imputed.collect())) == sorted(map(str, from_loans.imputed.collect()))
