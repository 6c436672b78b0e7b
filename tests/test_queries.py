"""Every named query against its SQL in DuckDB, on the smallest data set."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest

import __spark_entry__ as entry_points
from ridemill import fixtures, oracles, workload

duckdb = pytest.importorskip("duckdb")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The smallest data set has no outlier in the run or on the day, and no unknown route.
EMPTY_HERE = {"trip_outliers_run", "trip_outliers_day", "anti_routes"} if SF_DIR.endswith("sf0.001") else set()
QUERIES, SQL = workload.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows):
    def plain(value):
        if isinstance(value, dt.datetime):
            return value.isoformat()
        return repr(value)

    return sorted(tuple(plain(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    rows = found.select(*columns).collect()
    expected = duck.execute(SQL[name])
    assert sorted(d[0] for d in expected.description) == columns
    order = sorted(range(len(columns)), key=lambda i: expected.description[i][0])
    wanted = [tuple(row[i] for i in order) for row in expected.fetchall()]
    assert canonical(rows) == canonical(wanted)
    if name not in EMPTY_HERE:
        assert rows, "a query without rows checks nothing"


def test_quarantine_holds_a_rejected_row_once_however_often_lookups_list_its_keys(spark, tmp_path):
    """Vehicle numbers are cut to four digits, so a larger table of them holds one number many times."""
    day = dt.datetime(2024, 1, 20, 8)
    events = [(i, day + dt.timedelta(minutes=i), 1000, "purchase", 4.0, f"p{i}") for i in range(1, 300)]
    vehicles = [(key, "s", 1, 0.0) for key in (1000, *range(10000, 10010), *range(100000, 100020))]
    rows = {"events": events, "supplier": vehicles, "nation": [(key, "n", 0) for key in (1, 1, 2)]}
    connection = duckdb.connect()
    for name, own in rows.items():
        spark.createDataFrame(own, fixtures.LAYOUTS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = workload.quarantine_roundtrip(spark, str(tmp_path))
    wanted = connection.execute(SQL["quarantine_roundtrip"])
    names = [d[0] for d in wanted.description]
    wanted = canonical(wanted.fetchall())
    assert len(wanted) > 5
    assert canonical(found.select(*names).collect()) == wanted
    assert all(path.endswith(".json.gz") for path in found.inputFiles())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())


def test_flagship_query(spark):
    assert entry_points.entry(spark).count() > 0
