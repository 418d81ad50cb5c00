"""Every SQL-checked query equals its DuckDB oracle (sf0.001; the driver uses sf0.01)."""

import pytest

from tools.oracle_check import canon
import __spark_entry__ as E
from conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    r = duck.sql(E.oracle_sql()[key])
    dcols, drows = r.columns, r.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert canon(scols, srows) == canon(dcols, drows)


def test_every_query_has_a_callable():
    q = E.queries()
    assert set(E.oracle_sql()) <= set(q)
    assert len(q) >= 120


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"area", "time_slot", "n", "n_categories", "avg_age"}
