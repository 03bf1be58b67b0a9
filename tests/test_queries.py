"""Every catalogue query against its SQL oracle (DuckDB) on the smallest
test tables; the driver runs the same comparison at sf0.01."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from compare import TABLES, _rows  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "deviceid", "variableid", "avg_value"]
    assert df.count() > 0


# the training-data queries have tests of their own
OWN = sorted(n for n in entry.queries() if not re.match(r"op\d+_|pipeline$", n))


def test_every_query_has_oracle():
    assert not set(OWN) - set(entry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)
