import hashlib
from collections import Counter

import pytest
import xxhash
from edge import edge_docs, empty_docs, texts
from pyspark.sql import functions as F

from skein.llm import imatch as I
from skein.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def terms_of(text):
    return set((text or "").encode().lower().split())


def brute_lexicon(values):
    df = Counter(t for x in values for t in terms_of(x))
    return {t for t, c in df.items() if I.LOW * len(values) <= c <= I.HIGH * len(values)}


def brute_fp(text, lexicon):
    chosen = sorted(terms_of(text) & lexicon) or sorted(terms_of(text))
    if not chosen:
        return "00" + "...." * 64
    low = max(0, len(chosen).bit_length() - 2)
    out = f"{low:02x}"
    for level in range(low, low + 4):
        for f in range(16):
            inside = [t for t in chosen if xxhash.xxh64(t, seed=2 + f).intdigest() % 2**level == 0]
            data = b"".join(xxhash.xxh64(t, seed=1).intdigest().to_bytes(8, "little") for t in inside)
            out += f"{xxhash.xxh64(data).intdigest() % 65536:04x}" if inside else "...."
    return out


def signed(data):
    h = xxhash.xxh64(data, seed=42).intdigest()
    return h - 2**64 if h >= 2**63 else h


def expected(rows):
    """rows: (doc_id, text); the contract computed on one list."""
    lexicon = brute_lexicon([t for _, t in rows])
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1].encode()), r[1].encode()))
    out = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        n = len(t) // 3
        e = t[:len(t) - n] + nxt[:n]
        a, b, c = (brute_fp(x, lexicon) for x in (t, e, nxt))
        out.append((str(i), len(t), hashlib.sha256(e.encode()).hexdigest(), a, b, I.likeness(a, b), I.likeness(a, c)))
    return sorted(out)


def test_query_matches_brute_force(spark, sf_dir):
    got = sorted((str(r[0]), *r[1:]) for r in QUERIES["op2_imatch"](spark, sf_dir).collect())
    assert got == expected(list(texts(spark, sf_dir).items()))


def test_edits_are_nearer_than_other_texts(spark):
    rows = QUERIES["op2_imatch"](spark, SF).collect()
    docs = texts(spark, SF)
    long = [r for r in rows if len(set((docs[r["doc_id"]] or "").split())) >= 20]
    mean = lambda c: sum(r[c] for r in long) / len(long)
    assert mean("near_edited") > 0.25 and mean("near_next") < 0.1
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)
    by_text = {}
    for r in rows:
        by_text.setdefault(docs[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_edges(spark):
    docs = edge_docs(spark)
    lexicon = I.lexicon(docs.select("text"))
    got = sorted((str(r[0]), *r[1:]) for r in I.robustness(docs, lexicon).collect())
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert I.robustness(empty_docs(spark), set()).count() == 0
    one = docs.where("doc_id = 1")
    assert I.robustness(one, lexicon).first()["near_next"] == 1.0
    assert {r["doc_id"]: r["fingerprint"] for r in I.fingerprints(docs, lexicon).collect()}[1] == dict((x[0], x[3]) for x in got)["1"]


def test_range_bounds_are_no_texts(spark, monkeypatch):
    ranges, real = [], I.write_table

    def seen(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        ranges.extend(x.split("rangepartitioning(")[1] for x in plan.split("\n") if "rangepartitioning(" in x)
        return real(df, name)

    monkeypatch.setattr(I, "write_table", seen)
    I.robustness(edge_docs(spark), set())
    assert ranges and all(x.startswith("doc_id#") and x.count("text#") == x.count("xxhash64(text#") == 1 for x in ranges), ranges


def test_lexicon_does_not_depend_on_partitions(spark):
    from skein.sources.tables import read_table
    docs = read_table(spark, SF, "documents", "text")
    a = I.lexicon(docs, 0.02, 0.5)
    assert a == I.lexicon(docs.repartition(13), 0.02, 0.5)
    df = Counter(t for r in docs.collect() for t in terms_of(r[0]))
    assert a == {t for t, c in df.items() if 20 <= c <= 500}


def test_shuffled_count_equals_the_two_pass_count(spark, monkeypatch):
    from skein.llm import common
    docs = edge_docs(spark).select("text").withColumn("text", F.coalesce("text", F.lit("")))
    a = common.frequent(docs, I._add_documents, 0.1)
    assert a == common.frequent(docs, I._add_documents, 0.1, max_candidates=1) and a[1] == 13


@pytest.mark.parametrize("a,b,want", [("00" + "...." * 64, "00" + "...." * 64, 1.0), ("00" + "abcd" * 64, "00" + "...." * 64, 0.0),
                                      ("00" + "abcd" * 64, "09" + "abcd" * 64, 0.0), ("00" + "abcd" * 64, "01" + "abcd" * 64, 1.0)])
def test_likeness(a, b, want):
    assert I.likeness(a, b) == want
