"""First or last event after an anchor, and rows inside an interval, against brute force."""

import datetime as dt
import random

import pytest

from stagecraft.operators.asof import event_after, rows_in_interval


def day(n):
    return dt.date(2019, 1, 1) + dt.timedelta(days=n)


def tables(spark, seed):
    """Keys without the other side, null keys and dates, repeated rows, and one key with most rows."""
    r = random.Random(seed)
    key = lambda: r.choice([1] * 6 + [2, 3, 4, None])
    date = lambda: r.choice([None, *range(0, 200, 7)])
    left = [(key(), date(), i) for i in range(300)] + [(9, 5, 300)]
    right = [(key(), date()) for _ in range(200)] + [(8, 5)]
    frame = lambda rows, schema: spark.createDataFrame([tuple(day(x) if j == 1 and x is not None else x for j, x in enumerate(t)) for t in rows], schema)
    return left, right, frame(left, "k int, anchor date, i int"), frame(right, "k int, event date")


@pytest.mark.parametrize("which", ["first", "last"])
@pytest.mark.parametrize("inclusive", [False, True])
def test_event_after_against_brute_force(spark, which, inclusive):
    left, right, anchors, events = tables(spark, 1)
    got = {r["i"]: r["found"] for r in event_after(anchors, events, "k", "anchor", "event", "found", which, inclusive).collect()}
    assert len(got) == len(left)
    for k, a, i in left:
        fit = [e for j, e in right if k is not None and j == k and None not in (a, e) and (e > a or (inclusive and e == a))]
        expected = (min if which == "first" else max)(fit) if fit else None
        assert got[i] == (None if expected is None else day(expected))


def test_event_after_some_months(spark):
    anchors = spark.createDataFrame([(1, dt.date(2019, 1, 31)), (2, dt.date(2019, 1, 31))], "k int, a date")
    events = spark.createDataFrame([(1, dt.date(2019, 2, 28)), (1, dt.date(2019, 4, 1)), (2, dt.date(2018, 12, 1))], "k int, e date")
    got = event_after(anchors, events, "k", "a", "e", months=2).orderBy("k").collect()
    assert [r["event_date"] for r in got] == [dt.date(2019, 4, 1), None]
    with pytest.raises(ValueError, match="which"):
        event_after(anchors, events, "k", "a", "e", which="nearest")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_rows_in_interval_against_brute_force(spark, how):
    left, _, points, _ = tables(spark, 2)
    r = random.Random(5)
    spans = [(r.choice([1, 1, 2, 3, None]), s, s + r.choice([-3, 0, 10, 40]), r.randrange(3)) for s in (r.randrange(180) for _ in range(40))]
    intervals = spark.createDataFrame([(k, day(s), day(e), v) for k, s, e, v in spans + spans[:3]], "k int, s date, e date, v int")
    got = rows_in_interval(points, intervals, "k", "anchor", "s", "e", how, keep=("v",))
    assert got.columns == ["k", "anchor", "i", "s", "e", "v"]
    expected = []
    for k, a, i in left:
        fit = sorted({(s, e, v) for j, s, e, v in spans if None not in (k, a) and j == k and s <= a <= e})
        shown = [(day(s), day(e), v) for s, e, v in fit] or ([(None, None, None)] if how == "left" else [])
        expected += [(k, None if a is None else day(a), i, *x) for x in shown]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)
    with pytest.raises(ValueError, match="both tables"):
        rows_in_interval(points, intervals.withColumnRenamed("v", "i"), "k", "anchor", "s", "e", keep=("i",))


def test_plans_have_no_inequality_join(spark):
    _, _, anchors, events = tables(spark, 3)
    intervals = events.selectExpr("k", "event AS s", "date_add(event, 9) AS e")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (event_after(anchors, events, "k", "anchor", "event"), rows_in_interval(anchors, intervals, "k", "anchor", "s", "e")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("SortMergeJoin") == 1
            # The table that is looked up from is shuffled once; both sides of the join by its own exchanges.
            assert plan.count("Exchange hashpartitioning(k") == 3 and plan.count("_hash") > 0
            assert "partial_collect_set" in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
