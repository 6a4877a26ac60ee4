import hashlib
import re

import pytest
from edge import CLASH, ROWS, edge_docs, empty_docs, texts
from pyspark.sql import functions as F

from skein.llm import fill_in_middle as M
from skein.llm.queries import QUERIES

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i: 8 * i + 8], 16) for i in range(4))
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def same(row, doc_id, text, **options):
    n, form, prefix, middle, output = expected(doc_id, text, **options)
    assert (row["n"], row["form"], row["prefix_chars"], row["middle_chars"]) == (n, form, prefix, middle)
    assert row["output_sha256"] == sha(output) and row["restored_sha256"] == sha(text or "")


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_brute_force(spark, sf):
    docs = texts(spark, f"/root/testdata/sf{sf}")
    rows = QUERIES["op13_counted_fill"](spark, f"/root/testdata/sf{sf}").collect()
    assert len(rows) == len(docs)
    for r in rows:
        same(r, r["doc_id"], docs[r["doc_id"]])
    assert {r["form"] for r in rows} == {"plain", "psm", "spm"}


def test_edges(spark):
    for options in ({"rate": 100, "spm_rate": 0}, {"rate": 100, "spm_rate": 100}, {"rate": 0}, {"seed": 7}):
        got = sorted(M.digests(edge_docs(spark), **options).collect(), key=str)
        assert len(got) == len(ROWS)
        want = sorted((str(expected(r[0], r[1], options.get("seed", 42), options.get("rate", 50), options.get("spm_rate", 80))[:4]) + sha(r[1] or "") for r in ROWS))
        assert sorted(str((r["n"], r["form"], r["prefix_chars"], r["middle_chars"])) + r["restored_sha256"] for r in got) == want
    assert M.digests(empty_docs(spark)).count() == 0
    kept = M.transform(edge_docs(spark)).select("row.*")
    assert set(CLASH) <= set(kept.columns) and kept.where(F.col("size") == "mine").count() == len(ROWS)


def test_marks_and_odd_texts(spark):
    odd = ["<P>", "a <S> b", "x<M", "<", "<<P", "S>a <", "<S a P> <M b", "a\x0bb\x0cc\rd\te\nf", "   x\u0085", "😀 😀\n\n", "  ", "\n a", "a ", "$1 \\ $2 \\E \\Q {2}+", "\x00 \x00"]
    rows = [(i, t) for i, t in enumerate(odd * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in M.digests(docs, rate=100).collect():
        same(r, r["doc_id"], rows[r["doc_id"]][1], rate=100)


def test_very_long_text_needs_no_stack(spark):
    text = "a  b\n😀 ü " * 200_000 + "x" * 500_000 + " " * 500_000
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    for r in M.digests(docs, rate=100).collect():
        same(r, r["doc_id"], text, rate=100)


def test_plan_is_row_local(spark, sf_dir):
    plan = QUERIES["op13_counted_fill"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow"))
