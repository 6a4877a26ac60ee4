from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm import whitening as W
from skein.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(x):
    """Eigenvalues and vectors of the exact covariance of integer rows."""
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    c = [[n * v - t for v, t in zip(r, s)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in c), n ** 3)) for j in range(d)] for i in range(d)])
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values)
    return s, cov, values[order], basis[:, order], [sum(v * v for v in r) for r in c]


def integers(embedding):
    return [int(np.floor(64 * float(c))) + 1_000_000 for c in embedding]


def check(rows, vectors, k):
    x = [integers(v) for _, v in vectors]
    n = len(x)
    s, cov, values, basis, deviation = brute(x)
    want = {}
    for (vec_id, _), row, d in zip(vectors, x, deviation):
        centred = np.array([float(Fraction(n * v - t, n)) for v, t in zip(row, s)])
        want[vec_id] = (centred @ basis[:, :k] / np.sqrt(values[:k]), d)
    assert len(rows) == n * k
    signs = {}
    for r in rows:
        w, d = want[r["vec_id"]]
        c = r["component"] - 1
        assert r["n"] == n and r["deviation"] == d and r["identity_error"] <= 1e-10
        assert abs(abs(r["whitened"]) - abs(w[c])) < 1e-8
        if abs(w[c]) > 1e-6:
            signs.setdefault(c, set()).add(r["whitened"] * w[c] > 0)
        assert r["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    assert all(len(v) == 1 for v in signs.values())  # one sign for all rows


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    vectors = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(QUERIES["op11_polarisation_whitening"](spark, sf).collect(), vectors, 32)


def test_polarisation_is_exact(spark):
    """Wide values, far from 0: the covariance has one rounding, whatever the partitioning."""
    rng = np.random.default_rng(3)
    raw = [(i, [float(a) for a in rng.integers(-2 ** 30, 2 ** 30, 3)] + [float(rng.integers(0, 3)) + 1e9]) for i in range(60)]
    docs = spark.createDataFrame(raw, "vec_id long, embedding array<double>")
    _, cov, *_ = brute([integers(v) for _, v in raw])
    fits = [W.fit(W.usable(docs.repartition(p))) for p in (1, 7)]
    for f in fits:
        assert (f.covariance == cov).all()
    assert (fits[0].vectors == fits[1].vectors).all()


def test_deviation_of_wide_values(spark):
    raw = [(i, [float(a), float(a * a % 17)]) for i, a in enumerate((-2 ** 20, 5, 77, 2 ** 20))]
    rows = W.whiten(spark.createDataFrame(raw, "vec_id long, embedding array<double>")).collect()
    *_, deviation = brute([integers(v) for _, v in raw])
    assert {r["vec_id"]: r["deviation"] for r in rows} == dict(enumerate(deviation))


def test_unusable_rows_ties_and_repeats(spark):
    nan, inf = float("nan"), float("inf")
    raw = [(1, [0.5, 1.0, 2.0]), (1, [0.5, 1.0, 2.0]), (2, None), (3, [nan, 0.0, 0.0]), (4, [inf, 0.0, 0.0]), (5, [0.0, -inf, 1.0]), (6, [None, 0.0, 0.0]),
           (None, [0.25, -1.0, 0.125]), (7, [-0.5, 0.01, 3.0]), (8, [-0.0, 0.7, -3.0])]
    docs = spark.createDataFrame(raw, SCHEMA)
    for name in ("v", "component", "n", "whitened", "deviation", "__row"):
        docs = docs.withColumn(name, F.lit("mine"))
    rows = W.whiten(docs).collect()
    assert len(rows) == 5 * 3 and {r["vec_id"] for r in rows} == {1, None, 7, 8} and {r["n"] for r in rows} == {5}
    assert all(r["identity_error"] < 1e-9 and abs(sum(x["explained"] for x in rows) - 5) < 1e-9 for r in rows)


def test_directions_without_variance(spark):
    raw = [(i, [float(i), 2.0 * i, 1.0]) for i in range(20)]  # rank 1
    rows = W.whiten(spark.createDataFrame(raw, SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in rows) and len(rows) == 60
    assert rows[0]["identity_error"] < 1e-9
    one = W.whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r["component"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, 0.0), (2, 0, None, None, 0.0)]


def test_empty_and_uneven(spark):
    none = W.whiten(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whiten(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    with pytest.raises(ValueError, match="entries"):
        W.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], SCHEMA))


def test_more_rows_than_a_tile(spark):
    rng = np.random.default_rng(5)
    raw = [(i, [float(a) for a in v]) for i, v in enumerate(rng.normal(size=(5_000, 5)) @ rng.normal(size=(5, 5)))]
    rows = W.whiten(spark.createDataFrame(raw, "vec_id long, embedding array<double>").coalesce(1), components=2).collect()
    check(rows, raw, 2)
