"""Term counts as one row per item, and their product with a batch of queries."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from skein.operators import fulltext as ft
from skein.operators import term_rows, topk
from skein.operators import vectors as vec


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _words(rnd, n):
    return " ".join(f"w{min(rnd.randrange(200), rnd.randrange(200))}" for _ in range(n))


def test_item_rows_count_what_postings_count(spark):
    """Items with several rows (and a null key) add up their counts; items without a term have none."""
    rnd = random.Random(3)
    rows = [("node", f"n{i % 40}", _words(rnd, i % 7)) for i in range(90)] + [("edge", None, "a b a"), ("edge", None, "a c x"), ("edge", "e", None), ("edge", "f", "?!")]
    items = spark.createDataFrame(rows, "kind string, item_id string, text string")
    got = term_rows.term_rows(items, ["kind", "item_id"], "text")
    assert got.count() == got.select("kind", "item_id").distinct().count()
    a = sorted(map(str, term_rows.long_form(got, ["kind", "item_id"]).select("kind", "item_id", "term", F.col("tf").cast("long").alias("tf")).collect()))
    assert a == sorted(map(str, ft.postings(items).select("kind", "item_id", "term", "tf").collect()))


def test_each_text_is_cut_once(spark, monkeypatch):
    """The words of an item are found by one regular expression, in no filter besides; their number is counted from the item rows."""
    rows = [("node", f"n{i}", x) for i, x in enumerate(["Ab  ab,é-É", " \n?", "", None, "ß١x 2²", "a b a"])]
    items = spark.createDataFrame(rows, "kind string, item_id string, text string")
    plans, write = [], term_rows.write_table
    monkeypatch.setattr(term_rows, "write_table", lambda df, name: plans.append(plan(df)) or write(df, name))
    got = term_rows.term_rows(items, ["kind", "item_id"], "text")
    assert plans[0].count("regexp_") == 1
    assert sorted((r.item_id, r.dl, sorted(zip(r.terms, r.tfs))) for r in got.collect()) == [
        ("n0", 4, [("ab", 2), ("é", 2)]), ("n4", 2, [("2²", 1), ("ß١x", 1)]), ("n5", 3, [("a", 2), ("b", 1)])]
    index = ft.FullTextIndex(term_rows.long_form(got, ["kind", "item_id"]), got.limit(0), got)
    monkeypatch.setattr(ft, "write_table", lambda df, name: plans.append(plan(df)) or write(df, name))
    assert {(r.kind, r.term, r.df) for r in index.terms.collect()} == {("node", t, 1) for t in ("ab", "é", "2²", "ß١x", "a", "b")}
    assert "arrays_zip" not in plans[-1]


def test_search_shuffles_no_hit(spark):
    rnd = random.Random(5)
    nodes = spark.createDataFrame([(f"n{i}", f"name{i}", "person", _words(rnd, 1 + i % 30), "") for i in range(300)], "node_id string, name string, labeled string, description string, metadata string")
    edges = spark.createDataFrame([(f"e{i}", f"n{i}", f"n{i + 1}", "to", _words(rnd, 3)) for i in range(299)], "edge_id string, src_id string, dst_id string, rel_type string, description string")
    prompts = spark.createDataFrame([(i, _words(rnd, 1 + 3 * i)) for i in range(12)] + [(50, "zzz")], "prompt_id int, prompt string")
    index = ft.FullTextIndex.build(nodes, edges)
    exp = ft.expanded_terms(ft.query_terms(prompts), index.terms)
    hits = ft.search(exp, index)
    assert "Exchange" not in plan(hits) and "Exchange" not in plan(index.postings)
    full = ft.weigh_query(exp, index).join(index.weighted(), ["kind", "term"]).groupBy("prompt_id", "kind", "item_id").agg(F.sum(F.col("wq") * F.col("w")).alias("s"))
    want = {(r.prompt_id, r.kind, r.item_id): r.s for r in full.collect()}
    got = {(r.prompt_id, r.kind, r.item_id): r.score for r in hits.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-9 for k in want)
    for k in (1, 7, 40):
        top = {tuple(r) for r in ft.best_hits(exp, index, k).hits.select("prompt_id", "kind", "item_id", "score", "rank").collect()}
        assert top == {tuple(r) for r in ft.top_hits(hits, k).select("prompt_id", "kind", "item_id", "score", "rank").collect()}


def test_large_batches_and_ties(spark, monkeypatch):
    """Several blocks and tiles, many equal scores, rare and common terms: the k best by score, then item."""
    monkeypatch.setattr(term_rows, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(term_rows, "TILE_SCORES", 1000)
    monkeypatch.setattr(term_rows, "COMMON_TERMS", 10)
    rnd = random.Random(7)
    docs = [(i, [(t, rnd.choice([0.25, 0.5])) for t in rnd.sample(range(60), rnd.randint(1, 6))]) for i in range(700)]
    queries = [(q, [(t, rnd.choice([0.5, 1.0])) for t in rnd.sample(range(60), 4)]) for q in range(50)]
    table = pa.table({"query_id": pa.array([q for q, ts in queries for _ in ts], pa.int64()), "term": [f"t{t}" for _, ts in queries for t, _ in ts], "wq": [w for _, ts in queries for _, w in ts]})
    batch = pa.RecordBatch.from_pydict({"pk": pa.array([i for i, _ in docs], pa.int64()), "terms": [[f"t{t}" for t, _ in ts] for _, ts in docs], "weights": [[w for _, w in ts] for _, ts in docs]})
    q = term_rows.Queries(table.column("query_id").combine_chunks(), table.column("term").combine_chunks(), table.column("wq").to_numpy())
    best = {}
    for first, i, start, s in q.tiles(batch, lambda b, row: b.column("weights").flatten().to_numpy()):
        best.setdefault((i, start), term_rows.Best(5, s.shape[1])).add(s, term_rows._values(batch.column("pk"))[first: first + len(s)])
    got = {(start + c, k, round(x, 9)) for (_, start), b in best.items() for c, k, x in zip(b.q, b.keys, b.s)}
    weights = {i: dict(ts) for i, ts in docs}
    want = set()
    for a, ts in queries:
        scored = [(-round(sum(w * d[t] for t, w in ts if t in d), 9), i) for i, d in weights.items() if any(t in d for t, _ in ts)]
        want |= {(a, i, -s) for s, i in sorted(scored)[:5]}
    assert len(best) == 4 and got == want


def test_sparse_paths_agree(spark):
    """Vectors as rows, in long form, and the search with bounds; copies and null ids among the rows."""
    rnd = random.Random(9)
    rows = [(i, _words(rnd, 1 + i % 25)) for i in range(150)] + [(5, "w1 w2 w2"), (None, "w1 w3"), (160, "w1 w1"), (161, "w1 w1"), (162, None)]
    docs = spark.createDataFrame(rows, "pk long, text string")
    sparse, idf = vec.sparse_rows(docs)
    by_join = vec.weigh(vec.term_frequencies(docs), idf)
    a, b, c = ({(r.id, r.term): r.w for r in x.collect()} for x in (by_join, vec.long_vectors(sparse), vec.long_vectors(vec.sparse_rows(docs, max_words=0)[0])))
    assert a.keys() == b.keys() == c.keys() and all(abs(a[k] - b[k]) < 1e-12 and abs(a[k] - c[k]) < 1e-12 for k in a)
    q = sparse.where("id % 10 = 0")
    found = vec.sparse_topk(q, sparse, 4, exclude_self=True)
    assert plan(found).count("Exchange") == 1  # each task's best, ranked
    want = {tuple(r) for r in vec.sparse_search(q, sparse, 4, True, max_query_rows=0).hits.select("query_id", "pk", "score", "rank").collect()}
    assert {tuple(r) for r in found.collect()} == want
    assert {tuple(r) for r in vec.sparse_topk(vec.long_vectors(q), vec.long_vectors(sparse), 4, True).collect()} == want
    assert isinstance(vec.sparse_search(q, sparse, 4), topk.TopK)


def test_words_are_sent_as_one_string(spark):
    """Items are stored with one string of terms, cut as ``terms`` cuts it in any script, and counted by group without exploding them."""
    texts = ["straße–„Ünï“ Abc_d e", "İstanbul x́ Ⅷ ²½", "中文,字 😀b ߊ٣ ﬁ", " –", "", None, "a", "b\tb\x0bB\x00c", "ΣΑΣ ǅ ª"] * 3
    items = spark.createDataFrame([("node" if i % 2 else "edge", f"n{i}", x) for i, x in enumerate(texts)], "kind string, item_id string, text string")
    got = term_rows.term_rows(items, ["kind", "item_id"], "text")
    assert got.schema["words"].dataType.simpleString() == "string" and "regexp" not in plan(got)
    post = ft.postings(items)
    a = sorted(map(str, term_rows.long_form(got, ["kind", "item_id"]).select("kind", "item_id", "term", F.col("tf").cast("long").alias("tf"), F.col("dl").cast("int")).collect()))
    assert a == sorted(map(str, post.select("kind", "item_id", "term", "tf", F.col("dl").cast("int")).collect()))
    want = sorted(map(str, ft.term_stats(post).collect()))
    for rows in (got, got.drop("words")):
        counted = term_rows.item_counts(rows, "kind")
        assert sorted(map(str, counted.collect())) == want and "Generate" not in plan(counted)


def test_index_terms_meet_a_batch_where_they_are_read(spark):
    """The corpus's terms are neither shuffled nor joined in one task: pairs are checked before any exchange."""
    vocab = spark.createDataFrame([(k, f"wrd{i}", 1) for i in range(200) for k in ("node", "edge")], "kind string, term string, df long")
    q = spark.createDataFrame([(1, 0, "word7", True), (2, 0, "wrd77", True)], "prompt_id int, pos int, term string, is_fuzzy boolean")
    cand = ft._candidates(q.selectExpr("term as query_term"), vocab)
    assert "hashpartitioning" not in plan(cand) and "BroadcastHashJoin" in plan(cand)
    got = ft.fuzzy_expand(q, vocab)
    near = [x for x in plan(got).splitlines() if "levenshtein" in x]
    assert near and got.groupBy("prompt_id", "kind", "term").count().where("count > 1").count() == 0
    assert got.where("prompt_id = 1 AND term = 'wrd7' AND distance = 1").count() == 2
