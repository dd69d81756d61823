"""Every query that has SQL gives its rows."""

import pytest

from voxframe.plans.catalogue import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(frame):
    def text(x):
        if x is None or x != x:
            return "null"
        return repr(float(x)) if isinstance(x, float) else str(x)

    columns = sorted(frame.columns)
    return sorted(tuple(text(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, duck, name):
    own, other = QUERIES[name](spark, DATA).toPandas(), duck.sql(ORACLE_SQL[name]).df()
    assert sorted(own.columns) == sorted(other.columns)
    assert plain(own) == plain(other)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
