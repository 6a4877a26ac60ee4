"""Queries with SQL give the same rows in DuckDB."""

import pytest

from skein.llm.oracle import ORACLE
from skein.llm.queries import QUERIES


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_same_rows(spark, duck, sf_dir, key):
    mine, theirs = QUERIES[key](spark, sf_dir), duck.sql(ORACLE[key])
    names = sorted(mine.columns)
    assert names == sorted(theirs.columns)
    at = [theirs.columns.index(n) for n in names]
    assert sorted(map(str, (tuple(r[n] for n in names) for r in mine.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in theirs.fetchall())
