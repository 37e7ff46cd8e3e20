"""Differential check: registered queries against the independent DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from tools.compare import digest

KEYS = [
    "param_dates", "fill_value", "event_flags", "npl_date_reset", "stage2_runs", "stage_before_tdr",
    "classify_a", "classify_b", "classify_c", "publish_stage_status", "publish_stage_status_arch",
    "stage_before_tdr_arch",  # restructured loans without any DPD row
    "src_population_arch", "impute_writeback_arch", "last_npl_date_arch", "spine_start_arch",
    "event_flags_dec", "last_npl_date_dec", "publish_stage_status_dec",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("customer", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    from stagecraft.plans import queries
    from tools import oracle

    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF_SMALL)
    res = con.execute(entry.oracle_sql()[key])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    s_hash, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    o_hash, _ = digest(o_cols, res.fetchall())
    assert s_hash == o_hash


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["deal_id", "prev_status", "stg3_flag", "path_tdr", "m_stg2", "cure_flag", "last_modified", "modified_by"]
    assert df.count() == 150
