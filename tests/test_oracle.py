"""Every registered query with a SQL counterpart gives the same rows on DuckDB."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == ""


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    df = entry.entry(spark)
    assert df.columns[0] == "cycle" and df.count() > 0


def test_features_are_complete(spark):
    from aerometer.operators import models as md

    cols = set(QUERIES["feature_table"](spark, SF_DIR).columns)
    for wanted in (md.SOCIAL_FEATURES, md.TARIFF_FEATURES, md.FORECAST_FEATURES, md.WEATHER_FEATURES,
                   md.peak_features(True)):
        assert set(wanted) <= cols
    assert not {"energy_sum", "energy_min", "hh_range"} & set(md.peak_features())
