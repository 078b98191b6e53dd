"""Every query with SQL gives the same rows in Spark and DuckDB."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, differences

ORACLES = entry.oracle_sql()
MODELS_TOO_SLOW = {"k_diagnostics", "model_forecast", "random_search", "customer_summary", "demand_intervals"}


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, sf_dir, db):
    mine = entry.queries()[name](spark, sf_dir).toPandas()
    assert differences(mine, db.sql(ORACLES[name]).df()) == ""
    assert len(mine) > 0


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(ORACLES) - MODELS_TOO_SLOW))
def test_runs(name, spark, sf_dir):
    assert entry.queries()[name](spark, sf_dir).limit(1).count() == 1


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_a_shifted_frame_is_noticed(spark, sf_dir, db):
    """The comparison fails when the rolling frame is off by one row."""
    mine = entry.queries()["feat_rolling"](spark, sf_dir).toPandas()
    shifted = ORACLES["feat_rolling"].replace("AND 1 PRECEDING", "AND CURRENT ROW")
    assert "rolling_mean_4" in differences(mine, db.sql(shifted).df())


def test_the_other_deviation_is_noticed(spark, sf_dir, db):
    mine = entry.queries()["feat_rolling"](spark, sf_dir).toPandas()
    other = ORACLES["feat_rolling"].replace("stddev_samp", "stddev_pop")
    assert "rolling_std_4" in differences(mine, db.sql(other).df())
