import re

import numpy as np
import pytest
import xxhash
from edge import edge_docs, empty_docs, texts
from pyspark.sql import functions as F

from skein.llm import simhash_vptree as S
from skein.llm.queries import QUERIES


def brute_fp(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, bits=3):
    """Smallest id reachable, by repeated relaxation over all pairs."""
    fp = np.array(fps, dtype=np.uint64)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= bits
    low = np.array([2**62 if i is None else i for i in ids])
    while True:
        new = np.where(near, low[None, :], 2**62).min(axis=1)
        if (new == low).all():
            return [None if x == 2**62 else int(x) for x in low]
        low = new


def test_query_matches_brute_force(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op1_simhash_vptree"](spark, sf_dir).collect()}
    docs = sorted(texts(spark, sf_dir).items())
    fps = [brute_fp(t) for _, t in docs]
    comp = brute_components([i for i, _ in docs], fps)
    assert len(got) == len(docs)
    for (i, _), fp, c in zip(docs, fps, comp):
        assert got[i]["fingerprint"] == f"{fp:016x}" and got[i]["component_id"] == c


def test_edges(spark):
    docs = edge_docs(spark)
    got = S.near_duplicates(docs).collect()
    rows = docs.select("doc_id", "text").collect()
    want = brute_components([r[0] for r in rows], [brute_fp(r[1]) for r in rows])
    assert sorted(((str(r[0]), r[1], str(r[2])) for r in got)) == sorted(
        ((str(r[0]), f"{brute_fp(r[1]):016x}", str(c)) for r, c in zip(rows, want)))
    assert S.near_duplicates(empty_docs(spark)).count() == 0


def clustered(n, seed=3):
    """Fingerprints around common centres, a chain, one very dense ball, and random ones."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, size=n // 8, dtype=np.uint64)
    flips = [np.uint64(1) << rng.integers(0, 64, size=n, dtype=np.uint64) for _ in range(4)]
    a = rng.choice(base, size=n)
    near = a ^ flips[0] ^ flips[1]
    ball = np.bitwise_xor(np.uint64(0xDEADBEEF12345678), flips[2] ^ flips[3])
    chain = np.cumsum(np.ones(20, dtype=np.uint64)) ** 2
    return np.unique(np.concatenate([base, near, ball[: n // 2], chain, rng.integers(0, 2**63, size=n, dtype=np.uint64)]))


@pytest.mark.parametrize("options", [dict(sample_leaf=4, min_leaf=8), dict(sample_leaf=4, min_leaf=8, leaf_rows=37),
                                     dict(sample=64, sample_leaf=4, min_leaf=4), dict()])
def test_forest_equals_all_pairs(spark, options):
    """Small leaves, split leaves, a small sample and the defaults give the same components."""
    fps = clustered(700)
    df = spark.createDataFrame([(int(i), int(x)) for i, x in enumerate(fps.view(np.int64))], "doc_id long, fp long")
    got = {r["fp"]: r["component_id"] for r in S.groups(df, 3, **options).collect()}
    want = brute_components(list(range(len(fps))), fps)
    assert [got[int(x)] for x in fps.view(np.int64)] == want


def test_router_meets_every_close_pair():
    rng = np.random.default_rng(1)
    pts = rng.integers(0, 2**32, size=4000, dtype=np.uint64).astype(np.uint32)
    pts[2000:] = pts[:2000] ^ (np.uint32(1) << rng.integers(0, 32, size=2000).astype(np.uint32))
    nodes = S.build_tree(pts, len(pts), sample_leaf=16, min_leaf=16)
    met, homes = set(), 0
    for _, home, visit in S.route(nodes, pts, 1):
        homes += len(home)
        everyone = np.concatenate([home, visit])
        close = np.bitwise_count(pts[home][:, None] ^ pts[everyone][None, :]) <= 1
        met |= {(min(home[i], everyone[j]), max(home[i], everyone[j])) for i, j in zip(*np.nonzero(close))}
    assert homes == len(pts) and len(nodes) > 30
    assert all((i, i + 2000) in met for i in range(2000))


def test_xxhash_is_the_public_one():
    assert xxhash.xxh64_intdigest(b"", 42) == xxhash.xxh64("", seed=42).intdigest()
    assert S.simhash(b"A b", 3) == xxhash.xxh64_intdigest(b"a b", 42)


def test_keep_one(spark, sf_dir):
    docs = edge_docs(spark)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])[:12]) for r in kept.collect())
    groups = S.groups(S.fingerprints(docs), 3).select("root").distinct().count()
    assert len(got) == groups
    assert ("1", "The quick br") in got and not any(i == "2" for i, _ in got)
    assert sum(i == "7" for i, _ in got) == 2 and sum(t in ("None", "") for _, t in got) == 1
    assert S.keep_one(empty_docs(spark)).count() == 0


def test_keep_one_same_groups(spark, sf_dir):
    from skein.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents")
    comp = QUERIES["op1_simhash_vptree"](spark, sf_dir).select("component_id").distinct()
    kept = S.keep_one(docs)
    assert {r[0] for r in kept.select("doc_id").collect()} == {r[0] for r in comp.collect()}
    assert kept.where(F.col("text").isNull()).count() <= 1
