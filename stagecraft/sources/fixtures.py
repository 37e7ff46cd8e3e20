"""Deterministic staging inputs derived from the supplied TPC-H-style tables.

Two fixtures (FIXTURES.md), both built with Spark from ``customer`` and ``orders``
so that their size grows with the scale factor:

* ``natural``   - every customer is a loan, its orders are DPD observations:
                  gap-heavy series over 79 month-ends, reaching most conditions.
* ``archetype`` - every customer follows one of 40 hand-made 23-month DPD paths
                  (picked by ``c_custkey % 40``), reaching every reachable condition.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagecraft.functions.dates import date_lit, sql_date
from stagecraft.sources.params import CURE_MONTHS_CONFIG_ID, StageParams, resolve_params
from stagecraft.sources.tables import StageInputs

# ---------------------------------------------------------------------------
# Natural fixture. Window start, origination/restructuring rules.
NATURAL_MIN_FACTOR_DATE = _dt.date(1995, 1, 31)
NATURAL_BASE_DATE = _dt.date(1995, 1, 15)
NATURAL_CURE_MONTHS = 12
RUN_TS = _dt.datetime(2024, 1, 31, 12, 0, 0)

# ---------------------------------------------------------------------------
# Archetype fixture. Calendar and the 40 archetype rows
# (name, DPD path over 2017-04 .. 2019-02, value_date, restructure_start_date).
# Path characters: 0 -> 0, 1 -> 15, 2 -> 45, 3 -> 120 DPD, n -> row with NULL DPD,
# . -> no row.
ARCH_MIN_FACTOR_DATE = _dt.date(2017, 4, 30)
ARCH_COB_DATE = _dt.date(2019, 3, 31)
ARCH_PREVIOUS_SNAPSHOT = _dt.date(2019, 2, 28)
ARCH_CURE_MONTHS = 12
ARCH_CODES = {"0": 0, "1": 15, "2": 45, "3": 120}
ARCH_POOLS = {40: 2, 39: None, 30: 7, 26: 3, 17: 4, 9: 6, 3: 5}
ARCHETYPES = [
    ("R01", "00100010000000100010000", "2017-04-15", None),
    ("R02", "00000000000010000000222", "2017-04-15", None),
    ("R03", "00000000000012330000000", "2017-04-15", None),
    ("R04", "00012330000000000000000", "2017-04-15", None),
    ("R05", "02300000000000000010022", "2017-04-15", None),
    ("R06", "nnnnnnnnnnnnnnnnnnnnnnn", "2017-04-15", None),
    ("R07", ".......................", "2017-04-15", None),
    ("R08", "00000001230000123312123", "2017-04-15", "2018-02-15"),
    ("R09", "00000000000012330000000", "2017-04-15", "2018-04-15"),
    ("R10", "00012330000000000000000", "2017-04-15", "2018-06-15"),
    ("R11", "33000000000000000000000", "2017-04-15", "2017-04-15"),
    ("R12", "30000000000002000000000", "2017-04-15", "2017-04-15"),
    ("R13", "30000000000000001222222", "2017-04-15", "2017-04-15"),
    ("R14", "30000000000002000221222", "2017-04-15", "2017-04-15"),
    ("R15", "30000000000002000111112", "2017-04-15", "2017-04-15"),
    ("R16", "00100010000000100010000", "2017-04-15", "2018-02-15"),
    ("R17", "00100010000000102221222", "2017-04-15", "2018-06-15"),
    ("R18", "00100010222211111111111", "2017-04-15", "2018-04-15"),
    ("R19", "00100012200000000000000", "2017-04-15", "2017-10-15"),
    ("R20", "00100012200000000000002", "2017-04-15", "2017-10-15"),
    ("R21", "00100012200000100002222", "2017-04-15", "2017-10-15"),
    ("R22", "00100012200000000000000", "2017-04-15", "2018-01-15"),
    ("R23", "33000000000000000000000", "2017-04-15", "2018-12-15"),
    ("R24", "33000000000000000002222", "2017-04-15", "2018-11-15"),
    ("R25", "33000000000000002200000", "2017-04-15", "2018-07-15"),
    ("R26", ".......................", "2017-04-15", "2018-02-15"),
    ("R27", "00000000000000000000000", "2017-04-15", "2016-12-15"),
    ("R28", "00100010000000100010000", "2017-04-15", "2019-03-31"),
    ("R29", "0012..2000..330....0000", "2017-04-15", None),
    ("R30", "....2220000000000000000", "2017-04-15", None),
    ("R31", "000000000000000002.....", "2017-04-15", None),
    ("R32", "0000000..30....00000000", "2017-04-15", None),
    ("R33", "0000000nn30nnnn00000000", "2017-04-15", None),
    ("R34", "00000000000000000222222", "2018-10-15", None),
    ("R35", "33000000000000000000000", "2017-09-15", "2017-12-15"),
    ("R36", "000000000..30..00000000", "2017-04-15", None),
    ("R37", "000000000nn30..00000000", "2017-04-15", None),
    ("R38", "0.30000000000000000000n", "2017-04-15", None),
    ("R39", "00000000003..0000000000", "2017-04-15", None),
    ("R40", "00000000003nn0000000000", "2017-04-15", None),
]


def _deal_key(c) -> F.Column:
    return F.concat(F.lit("D"), c.cast("string"))


def _config(spark: SparkSession, x: int) -> DataFrame:
    return spark.createDataFrame([(CURE_MONTHS_CONFIG_ID, str(x))], "config_id int, config_value string")


def natural_inputs(spark: SparkSession, sf_dir: str) -> tuple[StageInputs, StageParams]:
    """Loans = customers, observations = orders (max DPD per loan and month-end)."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderdate", "o_totalprice")

    # The cob date is the month-end of the latest order.
    entity = orders.agg(F.last_day(F.to_date(F.max("o_orderdate"))).alias("cob_date"))
    config = _config(spark, NATURAL_CURE_MONTHS)
    params = resolve_params(entity, config, NATURAL_MIN_FACTOR_DATE, RUN_TS)

    base = sql_date(NATURAL_BASE_DATE)
    population = customer.selectExpr(
        "concat('D', CAST(c_custkey AS STRING)) AS deal_tfi_id",
        f"{sql_date(params.segmentation_date)} AS reporting_date",
        f"add_months({base}, CAST(c_custkey % 24 AS INT)) AS value_date",
        "1 AS segment_pool_id",
        f"CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS DATE) "
        f"ELSE add_months({base}, CAST(20 + (c_custkey * 7) % 56 AS INT)) END AS restructure_start_date",
    )
    dpd = (
        orders.selectExpr(
            "concat('D', CAST(o_custkey AS STRING)) AS deal_id",
            "last_day(to_date(o_orderdate)) AS factor_date",
            "CAST(floor(o_totalprice) AS BIGINT) % 10 AS bucket",
        )
        .selectExpr(
            "deal_id",
            "factor_date",
            "CASE WHEN bucket <= 5 THEN 0 WHEN bucket = 6 THEN 20 WHEN bucket IN (7, 8) THEN 60 "
            "WHEN bucket = 9 THEN 120 END AS factor_value",
        )
        .groupBy("deal_id", "factor_date")
        .agg(F.max("factor_value").alias("factor_value"))
    )
    return StageInputs(entity=entity, config=config, population=population, dpd=dpd), params


def archetype_table(spark: SparkSession) -> DataFrame:
    rows = [
        (i, name, path, _dt.date.fromisoformat(vd), _dt.date.fromisoformat(rsd) if rsd else None)
        for i, (name, path, vd, rsd) in enumerate(ARCHETYPES)
    ]
    return spark.createDataFrame(
        rows, "arch_idx int, arch_name string, path string, value_date date, restructure_start_date date"
    )


def archetype_inputs(spark: SparkSession, sf_dir: str) -> tuple[StageInputs, StageParams]:
    """Every customer follows archetype ``c_custkey % 40`` (FIXTURES.md section 2)."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    # 40 fixed rows: a proven size bound, so broadcasting it is safe.
    arch = F.broadcast(archetype_table(spark))
    deals = customer.join(arch, (F.col("c_custkey") % len(ARCHETYPES)) == F.col("arch_idx"))

    entity = customer.agg(F.max(date_lit(ARCH_COB_DATE)).alias("cob_date"))
    config = _config(spark, ARCH_CURE_MONTHS)
    params = resolve_params(entity, config, ARCH_MIN_FACTOR_DATE, RUN_TS)

    k = F.col("c_custkey")
    # Pools by c_custkey % 41: every excluded one, one that is not in use, and none.
    pool = F.lit(1)
    for rest, value in ARCH_POOLS.items():
        pool = F.when(k % 41 == rest, F.lit(value)).otherwise(pool)
    population = deals.select(
        _deal_key(k).alias("deal_tfi_id"),
        F.explode(F.array(date_lit(ARCH_PREVIOUS_SNAPSHOT), date_lit(ARCH_COB_DATE))).alias("reporting_date"),
        "value_date",
        pool.cast("int").alias("segment_pool_id"),
        "restructure_start_date",
    )

    m = F.col("m")
    code = F.substring(F.col("path"), (m + 1).cast("int"), 1)
    value = (
        F.when(m == -1, F.lit(120))
        .when(m == 23, F.lit(45))
        .when(code == "n", F.lit(None).cast("int"))
        .otherwise(F.create_map(*[x for kv in ARCH_CODES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])[code])
    )
    dpd = (
        deals.select(_deal_key(k).alias("deal_id"), "path", F.explode(F.sequence(F.lit(-1), F.lit(23))).alias("m"))
        .where((m < 0) | (m > 22) | (code != "."))
        .select(
            "deal_id",
            F.last_day(F.add_months(date_lit(ARCH_MIN_FACTOR_DATE), m)).alias("factor_date"),
            value.cast("int").alias("factor_value"),
        )
    )
    # Rows that the job ignores: the same date twice for a loan outside the population, rows
    # without a loan id (their dates count for the calendar), and blanks at the end of ids.
    outside = customer.where("c_custkey % 50 = 0").selectExpr(
        "concat('X', CAST(c_custkey AS STRING)) AS deal_id",
        f"{sql_date(ARCH_MIN_FACTOR_DATE)} AS factor_date",
        "explode(array(60, 120)) AS factor_value",
    )
    unnamed = outside.selectExpr("CAST(NULL AS STRING) AS deal_id", "factor_date", "factor_value")
    padded = dpd.withColumn("deal_id", F.concat("deal_id", F.lit("  ")))
    dpd = padded.unionByName(outside).unionByName(unnamed)
    return StageInputs(entity=entity, config=config, population=population, dpd=dpd), params


def fractional_inputs(spark: SparkSession, sf_dir: str) -> tuple[StageInputs, StageParams]:
    """The natural fixture with fractional DPD: 0.5, 30.5 and 90.5 among the values, so that a
    value cut to a whole number falls into another band."""
    inputs, params = natural_inputs(spark, sf_dir)
    value = (
        F.when(F.col("factor_value") == 0, F.when(F.dayofyear("factor_date") % 3 == 0, 0.5).otherwise(0.0))
        .when(F.col("factor_value") == 20, 30.5)
        .when(F.col("factor_value") == 60, F.when(F.dayofyear("factor_date") % 2 == 0, 90.5).otherwise(60.25))
        .otherwise(F.col("factor_value").cast("double"))
    )
    return dataclasses.replace(inputs, dpd=inputs.dpd.withColumn("factor_value", value)), params


def late_inputs(spark: SparkSession, sf_dir: str) -> tuple[StageInputs, StageParams]:
    """The natural fixture after an earlier run: loans with an even number have imputed rows a
    month after each observed one, beside which late observed rows have come for some."""
    inputs, params = natural_inputs(spark, sf_dir)
    real = inputs.dpd.withColumn("modified_by", F.lit("load"))
    imputed = inputs.dpd.where("CAST(substr(deal_id, 2) AS BIGINT) % 2 = 0").selectExpr(
        "deal_id", "last_day(add_months(factor_date, 1)) AS factor_date", "60 AS factor_value", "'stage_status(impute)' AS modified_by"
    )
    return dataclasses.replace(inputs, dpd=real.unionByName(imputed)), params


FIXTURES = {"natural": natural_inputs, "archetype": archetype_inputs, "fractional": fractional_inputs, "late": late_inputs}
