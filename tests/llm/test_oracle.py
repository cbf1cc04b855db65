"""Every query with a SQL text equals DuckDB on the small tables; all are registered."""

import pytest

import __spark_entry__ as entry
from shiplens.llm.queries import ORACLE, QUERIES
from shiplens.plans.check import _rows, duck_connect


def test_all_operators_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    mine, cols = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck_connect(sf_dir).execute(ORACLE[name])
    theirs, other = _rows([d[0] for d in res.description], res.fetchall())
    assert cols == other and sorted(map(repr, mine)) == sorted(map(repr, theirs))
