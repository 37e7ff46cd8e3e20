"""Replacing, appending and going on after a lost driver."""

import dataclasses
import datetime as dt
import os
import re
import tempfile
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stagecraft.plans.staging import StagePlan
from stagecraft.sources import sinks, storage
from stagecraft.sources.fixtures import archetype_inputs, late_inputs
from stagecraft.sources.params import ParameterError
from stagecraft.sources.sinks import run_stage_status
from stagecraft.sources.stages import RunStage


@pytest.fixture
def work():
    return tempfile.mkdtemp(prefix="stagecraft-storage-", dir="/tmp")


@pytest.fixture
def table(spark):
    name = f"target_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def location(spark, name):
    return storage.CatalogTable.of(spark, name).location.removeprefix("file:")


def files_below(folder):
    return [f for _, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


# -- replacing a catalog table -----------------------------------------------------
def test_replacing_an_unpartitioned_table(spark, table):
    storage.replace_table(spark.createDataFrame([("a", 1)], "name string, n int"), table, "table")
    first = location(spark, table)
    for round_ in (2, 3):
        storage.replace_table(spark.createDataFrame([(round_, "b")], "n bigint, name string"), table, "table")
        assert rows_of(spark.table(table)) == [("b", round_)]
        assert spark.table(table).dtypes == [("name", "string"), ("n", "int")]  # its types, by name
    assert not files_below(first)
    assert re.fullmatch(re.escape(first) + "-v[0-9a-f]{32}", location(spark, table))  # no chain of marks


def test_replacing_a_partitioned_table(spark, table):
    """Partitions that stay, go and come; odd values; a null partition; two partition columns."""
    schema = "id int, day date, kind string"
    day = dt.date(2019, 2, 28)
    old = [(1, day, "x"), (2, day, "it's/odd=1 %"), (3, None, "gone"), (4, day, None)]
    new = [(10, day, "x"), (11, day, "x"), (12, day, "it's/odd=1 %"), (13, dt.date(2019, 3, 31), "new"), (14, None, None)]
    storage.replace_table(spark.createDataFrame(old, schema), table, "table", partition_by=["day", "kind"])
    first = location(spark, table)
    shaped = lambda rows: sorted([(i, d, k) for i, d, k in rows], key=repr)
    assert rows_of(spark.table(table).select("id", "day", "kind")) == shaped(old)
    storage.replace_table(spark.createDataFrame(new, schema), table, "table")
    assert rows_of(spark.table(table).select("id", "day", "kind")) == shaped(new)
    assert not files_below(first)
    partitions = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert len(partitions) == 4 and all(os.path.isdir(f"{location(spark, table)}/{p}") for p in partitions)
    # A pruned read sees the same, and an append goes on from it.
    assert spark.table(table).where("kind = 'new'").count() == 1
    storage.append_rows(spark.createDataFrame([(20, "x", day)], "id int, kind string, day date"), table, "table")
    assert spark.table(table).where("kind = 'x'").count() == 3
    storage.replace_table(spark.createDataFrame([], schema), table, "table")
    assert spark.table(table).count() == 0 and spark.sql(f"SHOW PARTITIONS {table}").count() == 0


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_failing_write_leaves_the_table(spark, table, partitioned):
    parts = ["p"] if partitioned else []
    storage.replace_table(spark.range(6).selectExpr("id", "id % 3 AS p"), table, "table", partition_by=parts)
    before, home = rows_of(spark.table(table)), location(spark, table)
    failing = spark.range(8).selectExpr("CASE WHEN id = 5 THEN raise_error('midway') ELSE id END AS id", "id % 4 AS p")
    with pytest.raises(Exception, match="midway"):
        storage.replace_table(failing, table, "table")
    assert rows_of(spark.table(table)) == before and location(spark, table) == home
    assert not [n for n in os.listdir(os.path.dirname(home)) if n.startswith(os.path.basename(home) + "-v")]
    with pytest.raises(ParameterError, match="other"):
        storage.replace_table(spark.range(1).withColumn("other", F.lit(1)), table, "table")


def test_a_failing_switch_is_undone(spark, table, monkeypatch):
    storage.replace_table(spark.range(6).selectExpr("id", "id % 3 AS p"), table, "table", partition_by=["p"])
    before, home = rows_of(spark.table(table)), location(spark, table)
    run, done = spark.sql, []

    def failing(text, *args, **kwargs):
        if text.startswith("ALTER TABLE") and "ADD IF NOT EXISTS" in text:
            raise RuntimeError("catalog is gone")
        done.append(text)
        return run(text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", lambda self, *a, **k: failing(*a, **k))
    with pytest.raises(RuntimeError, match="catalog"):
        storage.replace_table(spark.range(8).selectExpr("id + 100 AS id", "id % 4 AS p"), table, "table")
    monkeypatch.undo()
    assert any("SET LOCATION" in t for t in done)
    spark.catalog.refreshTable(table)
    assert rows_of(spark.table(table)) == before and location(spark, table) == home


def test_a_run_into_a_partitioned_table(spark, table):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    empty = StagePlan(inputs, params).stage_status.limit(0)
    storage.replace_table(empty, table, "table", partition_by=["prev_status"])
    for _ in range(2):
        report = run_stage_status(inputs, params, table, fmt="table")
        assert report.result_rows == 125 == spark.table(table).select("deal_id").distinct().count() == spark.table(table).count()


# -- versioned paths ------------------------------------------------------------------
def test_versions_of_a_path(spark, work):
    target = f"{work}/out"
    for n in (3, 5, 2, 4):
        storage.replace_table(spark.range(n), target, "parquet", versioned=True)
        assert storage.read_table(spark, target, "parquet").count() == n
    folders = [x for x in os.listdir(f"{target}/_versions") if x != "_pointers"]
    assert len(folders) == storage.KEPT_VERSIONS
    # Once versioned it stays so; an attempt that fails is no version; appending is refused.
    failing = spark.range(8).selectExpr("CASE WHEN id = 5 THEN raise_error('midway') ELSE id END AS id")
    with pytest.raises(Exception, match="midway"):
        storage.replace_table(failing, target, "parquet")
    assert storage.read_table(spark, target, "parquet").count() == 4
    assert sorted(x for x in os.listdir(f"{target}/_versions") if x != "_pointers") == sorted(folders)
    with pytest.raises(ParameterError, match="versions"):
        storage.append_rows(spark.range(1), target, "parquet")


def test_a_plain_path_is_not_made_versioned(spark, work):
    spark.range(2).write.parquet(f"{work}/plain")
    with pytest.raises(ParameterError, match="outside of versions"):
        storage.replace_table(spark.range(1), f"{work}/plain", "parquet", versioned=True)
    with pytest.raises(ParameterError, match="no complete version"):
        storage.read_versioned(spark, f"{work}/nothing", "parquet")


def test_a_reader_always_finds_a_whole_version(spark, work):
    """Reads all through many replacements: version n holds n * 100 rows, all of them n."""
    target = f"{work}/out"
    version = lambda n: spark.range(n * 100).selectExpr(f"{n} AS n")
    storage.replace_table(version(1), target, "parquet", versioned=True)
    stop, found, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                told = storage.read_table(spark, target, "parquet").agg(F.count("*"), F.min("n"), F.max("n")).first()
                found.append(tuple(told))
            except Exception as e:  # noqa: BLE001
                failed.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(2, 8):
        storage.replace_table(version(n), target, "parquet", versioned=True)
    stop.set()
    reader.join()
    assert not failed and len(found) > 3
    assert all(low == high and count == 100 * low for count, low, high in found)
    assert [x[1] for x in found] == sorted(x[1] for x in found)


def test_a_run_publishes_a_version(spark, work):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    for _ in range(2):
        assert run_stage_status(inputs, params, f"{work}/out", versioned=True).result_rows == 125
    assert storage.read_table(spark, f"{work}/out", "parquet").count() == 125


# -- appending what is missing -----------------------------------------------------------
@pytest.mark.parametrize("fmt", ["parquet", "table"])
def test_a_second_run_adds_nothing_to_a_separate_table(spark, work, table, fmt):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    target = table if fmt == "table" else f"{work}/imputed"
    result = f"{table}_result" if fmt == "table" else f"{work}/out"
    try:
        first = run_stage_status(inputs, params, result, target, fmt=fmt)
        second = run_stage_status(inputs, params, result, target, fmt=fmt)
        held = storage.read_table(spark, target, fmt)
        assert (first.imputed_rows, second.imputed_rows) == (85, 0)
        assert held.count() == held.select("deal_id", "factor_date").distinct().count() == 85
        # A run that got half of its rows in: the replay adds the others.
        half = rows_of(held.where("crc32(deal_id) % 2 = 0"))
        part = spark.createDataFrame(half, held.schema)
        other = f"{table}_half" if fmt == "table" else f"{work}/half"
        storage.append_rows(part, other, fmt)
        replay = run_stage_status(inputs, params, result, other, fmt=fmt)
        assert replay.imputed_rows == 85 - len(half) and 0 < len(half) < 85
        assert rows_of(storage.read_table(spark, other, fmt)) == rows_of(held)
    finally:
        for name in (f"{table}_result", f"{table}_half"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_missing_rows_compares_keys_as_the_scans_read_them(spark):
    day = dt.date(2019, 2, 28)
    rows = spark.createDataFrame([("a", day, 1), ("b", day, 2), (None, day, 3)], "deal_id string, factor_date date, v int")
    held = spark.createDataFrame([("a  ", dt.datetime(2019, 2, 28, 13), "x")], "deal_id string, factor_date timestamp, v string")
    assert rows_of(storage.missing_rows(rows, held, ["deal_id", "factor_date"])) == [("b", day, 2), (None, day, 3)]
    assert storage.missing_rows(rows, held.limit(0), ["deal_id", "factor_date"]).count() == 3


# -- going on after a lost driver ------------------------------------------------------------
def test_a_run_goes_on_from_its_stage(spark, work, monkeypatch):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    options = {"run_id": "2019-03-31", "stage_folder": f"{work}/stages"}
    whole = run_stage_status(inputs, params, f"{work}/expected", f"{work}/expected-imputed")
    append = sinks.append_rows

    def lost(*args):
        raise KeyboardInterrupt("driver lost")

    monkeypatch.setattr(sinks, "append_rows", lost)
    with pytest.raises(KeyboardInterrupt):
        run_stage_status(inputs, params, f"{work}/out", f"{work}/imputed", **options)
    monkeypatch.setattr(sinks, "append_rows", append)
    assert os.path.exists(f"{work}/stages/2019-03-31/marker.json")
    with pytest.raises(ParameterError, match="cure_months"):
        run_stage_status(inputs, dataclasses.replace(params, cure_months=6), f"{work}/out", **options)
    # The second attempt, later: it computes nothing of the plan and keeps the first one's time.
    broken = dataclasses.replace(inputs, population=inputs.population.withColumn("value_date", F.expr("raise_error('recomputed')")))
    later = dataclasses.replace(params, run_ts=dt.datetime(2030, 1, 1))
    report = run_stage_status(broken, later, f"{work}/out", f"{work}/imputed", **options)
    assert report.resumed and report.materialised == "stage" and report.loans is None
    assert (report.result_rows, report.imputed_rows) == (whole.result_rows, whole.imputed_rows)
    for name in ("", "-imputed"):
        got = spark.read.parquet(f"{work}/out" if not name else f"{work}/imputed")
        assert rows_of(got) == rows_of(spark.read.parquet(f"{work}/expected{name}"))
    assert os.listdir(f"{work}/stages") == []  # deleted after success


def test_a_stage_without_marker_is_written_again(spark, work):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    spark.range(3).write.parquet(f"{work}/stages/r1/table")  # lost while writing
    report = run_stage_status(inputs, params, f"{work}/out", run_id="r1", stage_folder=f"{work}/stages")
    assert not report.resumed and report.result_rows == 125 and report.loans == 129
    with pytest.raises(ParameterError, match="run id"):
        RunStage(spark, work, "../x")


# -- counts and precedence ----------------------------------------------------------------
def test_counts_cost_no_job(spark, work):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    tracker = spark.sparkContext.statusTracker()

    def jobs(measured):
        group = uuid.uuid4().hex
        spark.sparkContext.setJobGroup(group, "")
        plan = StagePlan(inputs, params, measured=measured)
        plan.per_loan.write.format("noop").mode("overwrite").save()
        got = plan.measures()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group)), got

    plain, counted = jobs(False), jobs(True)
    assert plain[0] == counted[0] and plain[1] == {}
    assert counted[1]["rows_without_id"] == 6 and counted[1]["unmatched_loans"] > 0
    text = StagePlan(inputs, params, measured=True).per_loan._jdf.queryExecution().executedPlan().toString()
    assert text.count("CollectMetrics") >= 4


def test_a_run_reports_its_counts(spark, work):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    report = run_stage_status(inputs, params, f"{work}/out")
    assert report.rows_without_id == 6 and report.loans - report.loans_without_rep_row == report.result_rows
    assert report.filled_rows > 0 and report.unmatched_rows >= report.unmatched_loans > 0 and report.superseded_rows is None


def test_a_late_observed_row_goes_before_an_imputed_one(spark, work):
    inputs, params = archetype_inputs(spark, SF_SMALL)
    audit = "'E1' AS entity, 'DPD' AS factor_type, CAST(NULL AS TIMESTAMP_NTZ) AS last_modified, 'load' AS modified_by"
    inputs.dpd.selectExpr("*", *audit.split(", ")).write.parquet(f"{work}/dpd")
    read = lambda: dataclasses.replace(inputs, dpd=spark.read.parquet(f"{work}/dpd"))
    first = run_stage_status(read(), params, f"{work}/out", f"{work}/dpd")
    imputed = spark.read.parquet(f"{work}/dpd").where("modified_by <> 'load'")
    late = imputed.where("crc32(deal_id) % 2 = 0").selectExpr("* EXCEPT (factor_value, modified_by)", "15 AS factor_value", "'load' AS modified_by")
    late = spark.createDataFrame(late.collect(), late.schema)
    late.write.mode("append").parquet(f"{work}/dpd")
    second = run_stage_status(read(), params, f"{work}/out", f"{work}/dpd")
    assert second.imputed_rows == 0 and second.superseded_rows == late.count() and 0 < late.count() < first.imputed_rows
    # As if the late rows had been there from the start (those still missing imputed again).
    fresh = dataclasses.replace(inputs, dpd=spark.read.parquet(f"{work}/dpd").where("modified_by = 'load'").select("deal_id", "factor_date", "factor_value"))
    expected = StagePlan(fresh, params).timeline.where("deal_id IS NOT NULL AND n_obs > 0").select("deal_id", "factor_date", "obs_value")
    got = StagePlan(read(), params).timeline.where("deal_id IS NOT NULL AND n_obs > 0").select("deal_id", "factor_date", "obs_value")
    assert set(rows_of(expected)) <= set(rows_of(got))
    # Two observed rows of one key are still an error.
    late.limit(1).write.mode("append").parquet(f"{work}/dpd")
    with pytest.raises(Exception, match="duplicate"):
        run_stage_status(read(), params, f"{work}/out")


def test_precedence_keeps_the_plan(spark):
    """Three exchanges but for the fixture's own, also with imputed rows among the observations."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = StagePlan(*late_inputs(spark, SF_SMALL)).stage_status._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "Join" not in plan and plan.count("hashpartitioning(deal_id") <= 5
