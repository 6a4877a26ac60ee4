import hashlib
import re

import pytest
from edge import edge_docs, empty_docs, texts

from skein.llm import decontaminate as D
from skein.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def word_list(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=13):
    table = {}
    for i, t in items:
        w = word_list(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            table.setdefault(tuple(w[k:k + width]), set()).add(i)
    sizes = {len(k) for k in table}
    for i, t in docs:
        w, hit, found = word_list(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (ids := table.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= ids
        ids = sorted(str(x) for x in found if x is not None)
        yield (str(i), len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w))


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_query_matches_brute_force(spark, sf_dir):
    got = sorted((str(r[0]), *r[1:]) for r in QUERIES["op8_aho_corasick"](spark, sf_dir).collect())
    assert got == sorted(brute(texts(spark, sf_dir).items(), texts(spark, sf_dir, "benchmark", "item_id").items()))
    assert any(r[5] for r in got)


ITEMS = [(1, "quick brown fox jumps"), (2, "over THE lazy dog near the river bank today the end is here and more follows now"), (3, None), (4, "..."),
         (5, "word"), (6, "word"), (None, "some words"), (1, "an id"), (7, "x1 word2 x2 word3 x3 word4 x4 word5 x5 word6 x6 word7 x7 word8 x8 word9")]


@pytest.mark.parametrize("size", [60, 200, 1 << 20])
def test_edges_and_slices(spark, size):
    docs = edge_docs(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.matches(docs, items, slice_bytes=size)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((str(r[0]), *r[1:]) for r in found.select(COLUMNS).collect()) == sorted(brute(rows, ITEMS))
    one = found.where("doc_id = 1").first()
    text = rows[0][1].encode()
    assert [text[s["start"]:s["end"]] for s in one["spans"]] == [b"quick brown fox jumps"]
    assert D.matches(empty_docs(spark), items).count() == 0


def test_no_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = D.matches(edge_docs(spark), none).select(COLUMNS).collect()
    assert len(got) == 13 and not any(r["contaminated"] or r["n_hit"] for r in got)


def test_a_slice_is_scanned_before_the_next_is_read(spark, sf_dir, monkeypatch):
    from skein.llm import decontaminate
    from skein.sources.tables import read_table
    docs, items = read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text")
    events, slices, write = [], decontaminate._slices, decontaminate.write_table

    def read(*args):
        n, parts = slices(*args)
        return n, (events.append("read") or p for p in parts)

    monkeypatch.setattr(decontaminate, "_slices", read)
    monkeypatch.setattr(decontaminate, "write_table", lambda df, name: events.append("scan") or write(df, name))
    whole = decontaminate.matches(docs, items).drop("spans")
    assert events == ["read"]
    size = items.selectExpr("sum(octet_length(text) + 16)").first()[0]
    cut = decontaminate.matches(docs, items, slice_bytes=size // 3 + 1).drop("spans")
    assert events[1:] == ["read", "scan"] * 3
    assert sorted(cut.collect(), key=str) == sorted(whole.collect(), key=str)
