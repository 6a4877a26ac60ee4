"""Every key with an oracle: Spark result == DuckDB result (rows, columns, values)."""

import math
from collections import Counter

import pytest

import __spark_entry__ as entry
from skein.plans.oracle import ORACLE
from skein.plans.registry import QUERIES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


FLAT = ("string", "int", "bigint", "double", "boolean", "float")


def assert_flat(sdf):
    for f in sdf.schema.fields:
        assert f.dataType.simpleString() in FLAT, (f.name, f.dataType.simpleString())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, sf_dir, key):
    sdf = QUERIES[key](spark, sf_dir)
    assert_flat(sdf)
    scols = sdf.columns
    srows = sdf.collect()
    res = duck.sql(ORACLE[key])
    dcols = res.columns
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    s_idx = [scols.index(dcols[i]) for i in order]
    sc = Counter(tuple(_norm(r[i]) for i in s_idx) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in order) for r in drows)
    assert sc == dc, (list((sc - dc).elements())[:3], list((dc - sc).elements())[:3])


def test_every_key_has_a_callable():
    assert set(ORACLE) == set(QUERIES)  # no key without an oracle
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 50  # ten literal prompts, forty benchmark items
    assert df.columns == ["prompt_id", "context", "metadata"]
    assert all(r.context.startswith("*** Nodes:") for r in rows)
