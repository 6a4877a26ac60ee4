import math
import zlib
from collections import Counter

import numpy as np
import pytest
from edge import edge_docs, empty_docs, texts
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.llm import backoff_lm as L
from skein.llm.common import held_out
from skein.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
END = b"\n"


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


class Brute:
    """The model straight from its definition: recursion over dictionaries of words."""

    def __init__(self, train, mass=L.MASS):
        self.mass = mass
        self.c = Counter(w for t in train for w in tokens(t))
        self.n, self.v = self.c.total(), len(self.c)
        once, twice = (sum(x == i for x in self.c.values()) for i in (1, 2))
        self.d = once / (once + 2 * twice) if once and twice else 0.5
        self.g = Counter()
        for t in train:
            w = tokens(t)
            for k in (2, 3):
                self.g.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))

    def p(self, h, w):
        if not h:
            return (self.c[w] - self.d) / self.n if w in self.c else self.d * self.v / self.n
        seen = self.c[h[0]] if len(h) == 1 else self.g[h]
        m = self.mass[len(h) - 1]
        return (self.g[(*h, w)] + m * self.p(h[1:], w)) / (seen + m)

    def score(self, text):
        w = tokens(text)
        return sum(math.log10(self.p(tuple(w[max(0, i - 2):i]), x)) for i, x in enumerate(w))

    def base(self, text):
        return sum(math.log10((self.c[x] + 1) / (self.n + self.v + 1)) for x in tokens(text))


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def check(got, rows, model):
    got = sorted(got, key=lambda r: (str(r["doc_id"]), r["n_tokens"], r["base_score"]))
    want = sorted(rows, key=lambda r: (str(r[0]), len(tokens(r[1])), model.base(r[1])))
    assert len(got) == len(want)
    for r, (i, t) in zip(got, want):
        assert (r["doc_id"], r["held_out"], r["n_tokens"], r["train_tokens"]) == (i, held(i), len(tokens(t)), model.n)
        assert r["n_known"] == sum(x in model.c for x in tokens(t))
        assert r["base_score"] == pytest.approx(model.base(t), rel=1e-9)
        assert r["score"] == pytest.approx(model.score(t), rel=1e-9)


def test_query_matches_brute_force(spark, sf_dir):
    rows = list(texts(spark, sf_dir).items())
    check(QUERIES["op3_backoff_lm"](spark, sf_dir).collect(), rows, Brute([t for i, t in rows if not held(i)]))


def test_blocks_do_not_matter(spark, sf_dir):
    from skein.sources.tables import read_table
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    held_rows = held_out(F.col("doc_id"), 7, 2)
    a = {r["doc_id"]: tuple(r) for r in L.held_out_scores(docs, held_rows).collect()}
    b = {r["doc_id"]: tuple(r) for r in L.held_out_scores(docs.repartition(5), held_rows, block_bytes=9_000).collect()}
    assert a == b


def test_a_state_is_a_distribution(spark, sf_dir):
    rows = list(texts(spark, sf_dir).items())
    m = Brute([t for i, t in rows if not held(i)])
    for h in [h for h, _ in m.g.most_common(40) if len(h) == 2 and END not in h][:6]:  # nothing follows the end
        assert sum(m.p(h, w) for w in m.c) + m.p(h, b"unknown word") == pytest.approx(1.0, abs=1e-6)


def test_rare_ngrams_count(spark):
    """No rate: what two texts of many share raises the score, however large the rest is."""
    rest = [(i, " ".join(f"w{i}x{j % 50}" for j in range(200))) for i in range(300)]
    shared = "a rare but whole sentence that only two of the texts hold"
    rows = rest + [(1000, shared), (1001, shared)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in L.held_out_scores(docs, F.lit(False)).collect()}
    model = Brute([t for _, t in rows])
    alone = Brute([t for _, t in rows[:-1]])
    assert got[1000] == got[1001] == pytest.approx(model.score(shared), rel=1e-9)
    assert model.score(shared) > alone.score(shared)


def test_long_texts_are_cut_into_lanes(spark):
    rows = [(1, " ".join(f"v{j * j % 97}" for j in range(3 * L.LANE + 5))), (2, "v1 v4 v9 " * 700), (3, "x" * 3_000_000 + " v1"),
            (4, " ".join(f"v{j * j % 97}" for j in range(L.LANE - 1)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(L.held_out_scores(docs, held_out(F.col("doc_id"), 7, 2)).collect(), rows, Brute([t for i, t in rows if not held(i)]))


@given(st.lists(st.binary(max_size=40), max_size=12))
def test_tokens_are_the_words(values):
    keys, sizes = L.Hasher().texts(values)
    words = [w for v in values for w in [*v.lower().split(), END]]
    assert sizes.tolist() == [len(v.split()) + 1 for v in values]
    assert len({*zip(words, keys.tolist())}) == len({*words}) == len({*keys.tolist()})


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=30, unique=True))
def test_keys_and_counts_survive_the_way(values):
    keys = np.array(sorted(values), dtype=np.uint64)
    assert L.unsteps(L.steps(keys), len(keys)).tolist() == keys.tolist()
    counts = np.array([v >> 8 for v in values])
    assert L.unpacked(L.packed(counts), len(counts)).tolist() == counts.tolist()


def test_text_is_shuffled_once(spark, sf_dir):
    df = QUERIES["op3_backoff_lm"](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_held_out_texts_score_above_the_base(spark):
    rows = [r for r in QUERIES["op3_backoff_lm"](spark, SF).collect() if r["held_out"]]
    assert len(rows) > 100 and sum(r["score"] > r["base_score"] for r in rows) > 0.95 * len(rows)


def test_edges(spark):
    docs = edge_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = L.held_out_scores(docs, held_out(F.col("doc_id"), 7, 2)).collect()
    check(got, rows, Brute([t for i, t in rows if not held(i)]))
    assert L.held_out_scores(empty_docs(spark), F.lit(False)).count() == 0
    untrained = L.held_out_scores(docs, F.lit(True)).collect()
    assert len(untrained) == 13 and all(r["score"] == 0 and r["base_score"] == 0 and r["n_known"] == 0 for r in untrained)
