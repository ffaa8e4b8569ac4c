"""Every query with an oracle equals its DuckDB SQL on the smoke data."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck_connect
from sessionlens.plans import catalog

SQL = catalog.oracle_sql()  # those of the optional package are tested with it


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    r = compare(E.queries()[key](spark, SF_SMALL), SQL[key], con)
    assert r["ok"], r


def test_every_query_registered_has_callable():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 180


@pytest.mark.parametrize("key", ["fn_epoch", "time_since_prev", "localize_utc", "asof_clicks",
                                 "sessions_with_min_gap_count", "hourly_ctr", "diff_prev_nonnull",
                                 "hourly_ctr_stream"])
def test_results_do_not_depend_on_session_time_zone(spark, con, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = compare(E.queries()[key](spark, SF_SMALL), SQL[key], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r
