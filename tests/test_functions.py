import datetime as dt

from pyspark.sql import functions as F

from stagecraft.functions.dates import month_diff_sql, prev_month_end_py, prev_month_end_sql
from stagecraft.functions.decision import Sql, decide

D = dt.date


def test_month_diff_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(D(2019, 1, 31), D(2019, 2, 28)), (D(2019, 1, 30), D(2019, 2, 1)), (D(2019, 2, 28), D(2019, 1, 31)),
         (D(2017, 4, 30), D(2019, 2, 28)), (None, D(2019, 2, 28))],
        "a date, b date",
    )
    got = [r[0] for r in df.selectExpr(month_diff_sql("a", "b")).collect()]
    assert got == [1, 1, -1, 22, None]


def test_prev_month_end(spark):
    df = spark.createDataFrame([(D(2019, 3, 31),), (D(2019, 3, 15),), (D(2020, 3, 1),), (None,)], "d date")
    assert [r[0] for r in df.selectExpr(prev_month_end_sql("d")).collect()] == [D(2019, 2, 28), D(2019, 2, 28), D(2020, 2, 29), None]
    assert prev_month_end_py(D(2019, 3, 31)) == D(2019, 2, 28)
    assert prev_month_end_py(D(2001, 8, 31)) == D(2001, 7, 31)


def test_loan_start_is_the_later_date_and_unknown_without_origination(spark):
    from stagecraft.operators.timeline import loan_start_sql
    from stagecraft.sources.params import StageParams

    params = StageParams(min_factor_date=D(2017, 4, 30), segmentation_date=D(2019, 3, 31), cure_months=12)
    df = spark.createDataFrame([(D(2017, 1, 1),), (D(2018, 1, 1),), (None,)], "value_date date")
    got = [r[0] for r in df.selectExpr(loan_start_sql(params)).collect()]
    assert got == [D(2017, 4, 30), D(2018, 1, 1), None]


def test_decision_table_first_match_and_default(spark):
    rules = [("v IS NULL", {"k": 0, "s": "null"}), ("v > 10", {"k": 2, "s": Sql("concat('big', v)")}),
             ("v > 5", {"k": 1})]
    expr = decide(rules, {"k": None, "s": "small"}, {"k": "int", "s": "string"})
    df = spark.createDataFrame([(None,), (20,), (7,), (1,)], "v int")
    got = [tuple(r) for r in df.select(F.expr(expr).alias("o")).select("o.k", "o.s").collect()]
    assert got == [(0, "null"), (2, "big20"), (1, "small"), (None, "small")]


def test_sql_string_round_trips(spark):
    from stagecraft.functions.dates import sql_string

    for value in ["stage_status", "it's", "back\\slash", "mixed \\' quote"]:
        assert spark.sql(f"SELECT {sql_string(value)} AS v").first().v == value
