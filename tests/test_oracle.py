"""Every registered query with an SQL oracle equals DuckDB on sf0.001."""

import pytest

import __spark_entry__ as se
from tests.conftest import SF_SMALL
from tests.oracle import digest, duck

ORACLE = se.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    a, la = digest(df.columns, rows)
    b, lb = digest(rel.columns, orows)
    assert a == b, (sorted(set(la) - set(lb))[:3], sorted(set(lb) - set(la))[:3])


def test_every_query_has_docstring_and_runs_lazily(spark):
    qs = se.queries()
    assert len(qs) >= 80
    for name, fn in qs.items():
        assert fn.__doc__, name


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.columns == ["query_id", "rank", "score", "doc_id", "segment", "text"]
    rows = df.collect()
    assert len(rows) > 0
    assert all(1 <= r.rank <= 5 and r.score >= 0.75 for r in rows)
