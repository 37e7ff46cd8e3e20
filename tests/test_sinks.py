import dataclasses
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stagecraft.sources.fixtures import archetype_inputs
from stagecraft.sources.params import ParameterError
from stagecraft.sources.sinks import run_stage_status
from stagecraft.sources.storage import matched_to, replace_table
from stagecraft.sources.tables import StageInputs


def test_run_writes_result_then_imputed_rows_and_is_idempotent(spark):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="stagecraft-sink-", dir="/tmp")
    dpd_path, out_path = os.path.join(work, "dpd"), os.path.join(work, "stage_status")
    table = inputs.dpd.selectExpr(
        "*", "'E1' AS entity", "'DPD' AS factor_type", "CAST(NULL AS TIMESTAMP_NTZ) AS last_modified", "'load' AS modified_by"
    )
    table.write.parquet(dpd_path)
    dpd = spark.read.parquet(dpd_path)
    run_inputs = StageInputs(inputs.entity, inputs.config, inputs.population, dpd)

    first = run_stage_status(run_inputs, params, out_path, imputed_target=dpd_path)
    assert first.result_rows == 125
    assert first.imputed_rows == 85
    assert first.materialised == "checkpoint"
    result1 = sorted(tuple(r) for r in spark.read.parquet(out_path).collect())

    # Second run over the table with the imputed rows: nothing new to impute, same result.
    dpd2 = spark.read.parquet(dpd_path).select("deal_id", "factor_date", "factor_value")
    second = run_stage_status(StageInputs(inputs.entity, inputs.config, inputs.population, dpd2), params, out_path)
    assert second.imputed_rows == 0
    result2 = sorted(tuple(r) for r in spark.read.parquet(out_path).collect())
    assert result1 == result2
    assert sorted(os.listdir(work)) == ["dpd", "stage_status"]  # nothing is left of the swap


@pytest.mark.parametrize("kind,date", [("decimal(10,2)", "date"), ("double", "timestamp"), ("bigint", "timestamp_ntz")])
def test_append_takes_the_types_of_the_table(spark, kind, date):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="stagecraft-types-", dir="/tmp")
    base = inputs.dpd.select(
        "deal_id", F.col("factor_date").cast(date), F.col("factor_value").cast(kind), F.lit("E1").alias("entity"),
        F.lit("DPD").alias("factor_type"), F.lit(None).cast("timestamp").alias("last_modified"), F.lit("x").alias("modified_by"),
        F.lit(7).alias("batch"),
    )
    base.write.parquet(f"{work}/dpd")
    run_inputs = dataclasses.replace(inputs, dpd=spark.read.parquet(f"{work}/dpd"))
    first = run_stage_status(run_inputs, params, f"{work}/out", imputed_target=f"{work}/dpd")
    again = spark.read.parquet(f"{work}/dpd")
    types = lambda frame: [(f.name, f.dataType) for f in frame.schema]
    assert types(again) == types(base) and again.where("batch IS NULL").count() == first.imputed_rows > 0
    second = run_stage_status(dataclasses.replace(inputs, dpd=again), params, f"{work}/out", imputed_target=f"{work}/dpd")
    assert second.imputed_rows == 0 and second.result_rows == first.result_rows


def test_append_refuses_unknown_columns_before_any_write(spark):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="stagecraft-unknown-", dir="/tmp")
    inputs.dpd.write.parquet(f"{work}/dpd")  # without the audit columns
    with pytest.raises(ParameterError, match="entity"):
        run_stage_status(inputs, params, f"{work}/out", imputed_target=f"{work}/dpd")
    assert os.listdir(work) == ["dpd"]
    rows = spark.createDataFrame([(1,)], "a int")
    assert matched_to(rows, spark.createDataFrame([], "b string, a bigint")).collect() == [(None, 1)]


@pytest.mark.parametrize("fmt", ["parquet", "table"])
def test_a_failed_replacement_leaves_the_old_result(spark, fmt):
    work = tempfile.mkdtemp(prefix="stagecraft-replace-", dir="/tmp")
    target = f"{work}/out" if fmt == "parquet" else f"stage_status_{os.path.basename(work).replace('-', '_')}"
    read = lambda: sorted(r[0] for r in (spark.read.parquet(target) if fmt == "parquet" else spark.table(target)).collect())
    try:
        replace_table(spark.range(3), target, fmt)
        failing = spark.range(8).selectExpr("CASE WHEN id = 5 THEN raise_error('midway') ELSE id END AS id")
        with pytest.raises(Exception, match="midway"):
            replace_table(failing, target, fmt)
        assert read() == [0, 1, 2]
        replace_table(spark.range(2), target, fmt)
        assert read() == [0, 1]
    finally:
        if fmt == "table":
            spark.sql(f"DROP TABLE IF EXISTS {target}")


def test_one_audit_timestamp_whatever_the_zones(spark):
    """Session zone Bangkok, process zone as it is: both sinks say what run_ts says."""
    inputs, params = archetype_inputs(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="stagecraft-zones-", dir="/tmp")
    params = dataclasses.replace(params, run_ts=dt.datetime(2019, 4, 1, 12, 0))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
    try:
        run_stage_status(inputs, params, f"{work}/out", imputed_target=f"{work}/imputed")
        for name in ("out", "imputed"):
            stamps = spark.read.parquet(f"{work}/{name}").select("last_modified").distinct().collect()
            assert [r[0] for r in stamps] == [dt.datetime(2019, 4, 1, 12, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_run_needs_an_audit_timestamp(spark):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    with pytest.raises(ParameterError, match="run_ts"):
        run_stage_status(inputs, dataclasses.replace(params, run_ts=None), "/tmp/never-written")


def test_command_line_run(spark):
    from stagecraft.__main__ import main

    inputs, params = archetype_inputs(spark, SF_SMALL)
    work = tempfile.mkdtemp(prefix="stagecraft-cli-", dir="/tmp")
    paths = {}
    for name in ("entity", "config", "population", "dpd"):
        paths[name] = os.path.join(work, name)
        getattr(inputs, name).write.parquet(paths[name])
    out = main(
        [*(x for n, p in paths.items() for x in (f"--{n}", p)),
         "--min-factor-date", str(params.min_factor_date), "--result", os.path.join(work, "out"),
         "--impute-into", os.path.join(work, "imputed"), "--run-ts", "2019-04-01T00:00:00"],
        spark=spark,
    )
    assert out == {"reporting_date": "2019-02-28", "result_rows": 125, "imputed_rows": 85,
                   "materialised": "checkpoint"}
    written = spark.read.parquet(os.path.join(work, "out"))
    assert "last_modified" in written.columns and written.count() == 125
