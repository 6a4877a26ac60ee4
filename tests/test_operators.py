"""Hand-computed edge cases and property tests for single operators."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skein.functions.ordering import with_row_index
from skein.operators import fulltext as ft
from skein.operators import graph as gr
from skein.operators import metrics as mt
from skein.operators import multimodel as mm
from skein.operators import prep
from skein.operators import sentences as sn
from skein.operators import vectors as vec

NODE_SCHEMA = "node_id string, name string, labeled string, description string, metadata string"
EDGE_SCHEMA = "edge_id string, src_id string, dst_id string, rel_type string, description string"


def _lists(spark, texts, strip=False):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sn.sentence_lists(df, strip=strip).orderBy("doc_id").collect()
    return [r.sentences for r in rows]


# ----------------------------------------------------------------- sentences

def test_split_edge_cases(spark):
    out = _lists(spark, ["", None, "...", "This is a test. This is another test.",
                         "One!  Two?\nThree"])
    assert out[0] == [] and out[1] == []
    assert out[2] == ["..."]
    assert out[3] == ["This is a test.", " This is another test."]
    assert out[4] == ["One!", "  Two?", "Three"]


def test_split_batch_mode_strips(spark):
    out = _lists(spark, ["  a b.\t c d!  "], strip=True)
    assert out[0] == ["a b.", "c d!", ""]


def test_custom_delimiters(spark):
    df = spark.createDataFrame([(1, "a;b. c")], "doc_id long, text string")
    rows = sn.sentence_lists(df, delimiters=";").first().sentences
    assert rows == ["a;", "b. c"]


def test_keep_necessary_fail_open(spark):
    df = spark.createDataFrame([(1, 0, "short one"), (1, 1, None)], "doc_id long, pos int, sentence string")
    kept = sn.keep_necessary(sn.with_prompt(df), scorer=lambda p, s: F.lit(None).cast("int"))
    assert kept.count() == 2


def test_label_decode_unknown(spark):
    df = spark.createDataFrame([(0,), (1,), (5,)], "c int")
    got = [r[0] for r in df.select(sn.label_decode(F.col("c"))).collect()]
    assert got == ["unnecessary", "necessary", "unknown"]


# ----------------------------------------------------------------- full text

def test_fuzzy_weights(spark):
    vocab = spark.createDataFrame([("node", t, 1) for t in
                                   ["cat", "cart", "cast", "dog", "at", "catalog", "scat", "cta"]],
                                  "kind string, term string, df long")
    q = spark.createDataFrame([(1, 0, "cat", True)], "prompt_id int, pos int, term string, is_fuzzy boolean")
    band = {(r.term, r.distance, round(r.weight, 6)) for r in ft.fuzzy_expand(q, vocab).collect()}
    # weight = 1 - d / min(len); 'at' (d=1, min len 2) -> 0.5; 'cta' is a swap of neighbours: d=1 -> 2/3
    assert ("cat", 0, 1.0) in band and ("cart", 1, round(1 - 1 / 3, 6)) in band
    assert ("at", 1, 0.5) in band and ("cta", 1, round(1 - 1 / 3, 6)) in band
    assert not any(t == "dog" or t == "catalog" for t, _, _ in band)


def _edits(a: str, b: str) -> int:
    """Optimal string alignment distance, by its table."""
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_edit_distance_with_swaps(spark):
    import random
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 7))) for _ in range(260)})
    pairs = [(a, b) for a in words for b in words[::4]] + [("ab", "ba"), ("ca", "abc"), ("abcd", "badc"), ("x" * 40 + "ab", "x" * 40 + "ba")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", ft.edit_distance("a", "b").alias("d")).collect()
    assert [(r.a, r.b, r.d) for r in got] == [(a, b, min(3, _edits(a, b))) for a, b in pairs]
    assert [r.d for r in got[-4:]] == [1, 3, 2, 1]


def _top_by_full_sums(spark, query, postings, k):
    import collections
    weights, sums = collections.defaultdict(list), collections.defaultdict(float)
    for t, i, w in postings:
        weights[t].append((i, w))
    for q, t, wq in query:
        for i, w in weights[t]:
            sums[q, i] += wq * w
    out = {}
    for (q, i), s in sums.items():
        out.setdefault(q, []).append((-round(s, 9), i))
    return {q: [(i, -s) for s, i in sorted(v)[:k]] for q, v in out.items()}


def test_top_k_with_bounds_is_exact_and_reads_less(spark):
    """Zipf-like terms, ties, queries with few hits and one without: the same rows as full sums."""
    import random

    from skein.operators import topk
    rnd = random.Random(11)
    df = {f"t{j}": max(2, 3000 // (j + 1)) for j in range(120)}
    postings = [(t, i, round(rnd.choice([1, 0.9, 0.5, 0.3, 0.1]) * rnd.random() + 1e-3, 3)) for t, n in df.items() for i in rnd.sample(range(3000), n)]
    postings += [("same", i, 0.25) for i in range(500)] + [("rare", 7, 0.5), ("rare", 3, 0.5)]
    idf = {t: math.log(1 + 3000 / n) for t, n in df.items()} | {"same": 1.0, "rare": 4.0}
    queries = {q: rnd.sample(sorted(df), n) for q, n in enumerate((1, 2, 5, 20, 60))} | {90: ["t0", "t1", "t100"], 91: ["same"], 92: ["rare"], 93: ["rare", "same", "t0"]}
    query = [(q, t, idf[t]) for q, ts in queries.items() for t in ts]
    q = spark.createDataFrame(query, "q long, term string, wq double")
    p = spark.createDataFrame(postings, "term string, item long, w double").withColumn("level", topk.level_of(F.col("w")))
    for k in (1, 10, 40):
        run = topk.run(q, p, topk.levels_table(p, ["term"]), k, ["q"], ["term"], "item", count_read=True)
        got = {}
        for r in run.hits.orderBy("q", "rank").collect():
            got.setdefault(r.q, []).append((r.item, r.score))
        want = _top_by_full_sums(spark, query, postings, k)
        assert got.keys() == want.keys()
        for key in want:
            assert [i for i, _ in got[key]] == [i for i, _ in want[key]], key
            assert all(abs(a - b) < 2e-9 for (_, a), (_, b) in zip(got[key], want[key]))
        total = sum(len([1 for x in postings if x[0] == t]) for _, t, _ in query)
        assert run.read < 0.8 * total, (k, run.read, total)


def test_search_reads_fewer_postings_than_it_has(spark, sf_dir):
    from skein.plans import registry
    from skein.sources import fixtures as fx
    _, _, index = registry._index(spark, sf_dir)
    exp = ft.expanded_terms(ft.query_terms(fx.prompts(spark, sf_dir)), index.terms)
    run = ft.best_hits(exp, index, k=10, count_read=True)
    total = exp.select("prompt_id", "kind", "term").distinct().join(index.terms, ["kind", "term"]).agg(F.sum("df")).first()[0]
    assert run.read < total
    full = {(r.prompt_id, r.kind, r.item_id, r.rank) for r in ft.top_hits(ft.search(exp, index), 10).collect()}
    assert full == {(r.prompt_id, r.kind, r.item_id, r.rank) for r in run.hits.collect()}


def test_fuzzy_candidates_lose_no_term(spark):
    """Every pair within the bound, over short, long and repetitive words."""
    import random
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 7))) for _ in range(250)}
    words |= {w + "x" * 40 for w in list(words)[:10]} | {"y" + w + "x" * 39 for w in list(words)[:10]}
    vocab = spark.createDataFrame([("node", w, 1) for w in sorted(words)], "kind string, term string, df long")
    asked = sorted(words)[::6] + ["x" * 41, "abab"]
    q = spark.createDataFrame([(i, 0, w, True) for i, w in enumerate(asked)], "prompt_id int, pos int, term string, is_fuzzy boolean")
    got = {(r.query_term, r.term, r.distance) for r in ft.fuzzy_expand(q, vocab, max_expansions=10_000).collect()}
    want = {(a, b, d) for a in asked for b in words if (d := _edits(a, b)) <= 2 and d < min(len(a), len(b))}
    assert got == want


def test_prompts_that_share_a_term_cost_one(spark):
    """2,000 prompts with the same last word: the candidates are those of one."""
    vocab = spark.createDataFrame([("node", f"word{i}", 1) for i in range(300)], "kind string, term string, df long")
    q = spark.range(2000).selectExpr("cast(id as int) as prompt_id", "0 as pos", "concat('word', cast(id % 1 + 7 as string)) as term", "true as is_fuzzy")
    one = ft._candidates(q.limit(1).selectExpr("term as query_term").distinct(), vocab).count()
    assert ft._candidates(q.selectExpr("term as query_term").distinct(), vocab).count() == one
    out = ft.fuzzy_expand(q, vocab)
    assert out.count() == 2000 * 50
    assert "BroadcastNestedLoopJoin" not in out._jdf.queryExecution().executedPlan().toString()


def test_cut_keeps_single_hit_and_uses_population_std(spark):
    hits = spark.createDataFrame([(1, "node", "a", 3.0), (2, "node", "x", 2.0), (2, "node", "y", 4.0),
                                  (2, "node", "z", 6.0)], "prompt_id int, kind string, item_id string, score double")
    kept = ft.cluster_cut(ft.score_stats(ft.top_hits(hits))).orderBy("prompt_id", "item_id").collect()
    assert [(r.prompt_id, r.item_id) for r in kept] == [(1, "a"), (2, "z")]
    std = math.sqrt(((2 - 4) ** 2 + 0 + (6 - 4) ** 2) / 3)
    assert abs(kept[1].threshold - round(6 - std, 9)) < 1e-12


def test_top_k_limits_and_breaks_ties_by_id(spark):
    rows = [(1, "node", f"i{k:02d}", 1.0) for k in range(50)]
    hits = spark.createDataFrame(rows, "prompt_id int, kind string, item_id string, score double")
    top = ft.top_hits(hits, 40).collect()
    assert len(top) == 40 and max(r.item_id for r in top) == "i39"


# --------------------------------------------------------------------- graph

def _graph(spark):
    nodes = spark.createDataFrame([
        ("a", "A", "person", "da", "m1"), ("b", "B", None, "db", None), ("c", "C", "event", "dc", "m3"),
        ("d", "D", "person", "dd", "x, y"), ("e", "E", "person", "de", None)], NODE_SCHEMA)
    edges = spark.createDataFrame([
        ("e1", "a", "b", "r", "ab"), ("e2", "a", "b", "r", "ab2"), ("e3", "a", "a", "self", "aa"),
        ("e4", "b", "c", "r", "bc"), ("e5", "a", "d", "r", "ad"), ("e6", "d", "e", "r", "de")], EDGE_SCHEMA)
    return nodes, edges


def test_adjacency_self_loop_once_parallel_twice(spark):
    _, edges = _graph(spark)
    adj = gr.adjacency(edges).where("node_id = 'a'").collect()
    assert sorted(r.edge_id for r in adj) == ["e1", "e2", "e3", "e5"]


def test_optional_expansion_keeps_unmatched_endpoints(spark):
    nodes, edges = _graph(spark)
    hits = spark.createDataFrame([(1, "e5", 1.0)], "prompt_id int, item_id string, score double")
    eps = gr.edge_endpoint_set(hits, edges)
    exp = gr.neighbors_optional(eps, gr.adjacency(edges), nodes).collect()
    by_ep = {}
    for r in exp:
        by_ep.setdefault(r.endpoint_id, set()).add(r.neighbor_id)
    # a: neighbours b (NULL label fails), a itself (endpoint) -> none, kept with NULL
    assert by_ep["a"] == {None}
    # d: neighbour e (person) allowed; a is an endpoint -> excluded
    assert by_ep["d"] == {"e"}


def test_isolated_hit_vanishes_from_inner_match(spark):
    nodes, edges = _graph(spark)
    hits = spark.createDataFrame([(1, "zz", 1.0), (1, "c", 1.0)], "prompt_id int, item_id string, score double")
    rows = gr.neighbors_inner(hits, gr.adjacency(edges)).collect()
    assert {r.item_id for r in rows} == {"c"}


def test_empty_relation_descriptions_are_dropped(spark):
    nodes, edges = _graph(spark)
    extra = spark.createDataFrame([("e7", "a", "e", "r", ""), ("e8", "a", "c", "r", None)], EDGE_SCHEMA)
    edges = edges.unionByName(extra)
    prompts = spark.createDataFrame([(1, "da")], "prompt_id int, prompt string")
    g = gr.GraphRetrieval.run(prompts, nodes, edges)
    rels = {r.description for r in g.context_relations().collect()}
    assert rels and "" not in rels and None not in rels
    assert {"ab", "ab2", "aa", "ad"} <= rels


def test_index_roundtrip_and_termless_prompt(spark, tmp_path):
    nodes, edges = _graph(spark)
    idx = ft.FullTextIndex.build(nodes, edges)
    idx.save(str(tmp_path / "idx"))
    again = ft.FullTextIndex.load(spark, str(tmp_path / "idx"))
    cols = ["kind", "item_id", "term", "tf", "dl"]
    assert sorted(map(tuple, idx.postings.select(*cols).collect())) == \
        sorted(map(tuple, again.postings.select(*cols).collect()))
    prompts = spark.createDataFrame([(1, "???"), (2, "da")], "prompt_id int, prompt string")
    out = {r.prompt_id: r for r in gr.GraphRetrieval.run(prompts, nodes, edges, again).retrieve(prompts).collect()}
    assert out[1].context == "*** Nodes:\n\n\n*** Relationships" and out[1].metadata == ""
    assert "A: is a person of description: da" in out[2].context


# ------------------------------------------------------------------- vectors

def test_fusion_with_zero_weight_is_single_list(spark):
    s = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.5)], "query_id long, pk long, score double")
    d = spark.createDataFrame([(1, 11, 0.8), (1, 12, 0.7)], "query_id long, pk long, score double")
    f = vec.weighted_fusion(s, d, sparse_weight=0.0, dense_weight=1.0, normalize="none").collect()
    got = {r.pk: r.score for r in f}
    assert got == {10: 0.0, 11: 0.8, 12: 0.7}


def test_atan_normalisation(spark):
    s = spark.createDataFrame([(1, 10, 1.0)], "query_id long, pk long, score double")
    d = spark.createDataFrame([], "query_id long, pk long, score double")
    r = vec.weighted_fusion(s, d).first()
    assert abs(r.score - round(0.7 * (0.5 + math.atan(1.0) / math.pi), 9)) < 1e-12


def test_dense_topk_paths_agree(spark):
    import random
    rnd = random.Random(7)
    chunks = spark.createDataFrame([(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(200)],
                                   "pk long, dense_vector array<float>")
    queries = chunks.where("pk % 20 = 3").select(F.col("pk").alias("query_id"), "dense_vector")
    a = {tuple(r) for r in vec.dense_topk(queries, chunks, 3, exclude_self=True).collect()}
    b = {tuple(r) for r in vec.dense_topk(queries, chunks, 3, exclude_self=True, max_broadcast_bytes=0).collect()}
    assert a == b and len(a) == 30


def _vectors(spark, rows):
    return spark.createDataFrame(rows, "pk long, dense_vector array<float>")


def test_dense_topk_skips_scores_that_are_not_finite(spark):
    chunks = _vectors(spark, [(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [0.5, 0.0]), (4, [float("inf"), 0.0])]).coalesce(1)
    q = chunks.where("pk = 1").select(F.col("pk").alias("query_id"), "dense_vector")
    for bound in (vec.MAX_BROADCAST_BYTES, 0):
        got = [(r.pk, r.score) for r in vec.dense_topk(q, chunks, 3, max_broadcast_bytes=bound).orderBy("rank").collect()]
        assert got == [(1, 1.0), (3, 0.5)]


def test_dense_vectors_of_unequal_length_are_an_error(spark):
    import pytest
    chunks = _vectors(spark, [(1, [1.0, 0.0]), (2, [1.0])])
    with pytest.raises(ValueError, match="components"):
        vec.dense_topk(chunks.withColumnRenamed("pk", "query_id"), chunks, 1)
    with pytest.raises(Exception, match="2 components"):
        vec.dense_topk(chunks.where("pk = 1").withColumnRenamed("pk", "query_id"), chunks, 1).collect()


def test_dense_kernel_is_exact_over_many_tiles():
    """Ties included, whatever the tiles; temporary arrays stay at a tile's size."""
    import tracemalloc

    import numpy as np
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(9000, 4)), 1)
    ids, q = np.arange(2100), x[:2100]
    tracemalloc.start()
    got = vec._local_topk(ids, q, np.arange(9000), x, 4, True)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * 8 * vec.TILE_QUERIES * vec.TILE_CHUNKS + 64 * x.size
    for i in (0, 1023, 1024, 2099):
        s = x @ q[i]
        s[i] = -np.inf
        kth = np.sort(s)[-4]
        want = set(np.flatnonzero(s >= kth - 1e-9).tolist())
        mine = got[got.query_id == i]
        assert set(mine.pk) == want and np.allclose(mine.score, s[mine.pk])


def test_softmax_of_far_scores(spark):
    df = spark.createDataFrame([([800.0, 1.0],), ([-800.0, -800.0],)], "scores array<double>")
    assert [r[0] for r in df.select(mt.softmax("scores")).collect()] == [[1.0, 0.0], [0.5, 0.5]]


def test_collection_keys_separate_their_parts(spark):
    from skein.sources import collection as colx
    rows = spark.createDataFrame([("a", "bc", 1), ("ab", "c", 2), ("ab", "c", 3)], "path string, text string, n long")
    assert colx.assign_pk(rows).select("pk").distinct().count() == 2
    assert colx.assign_pk(rows, "n").select("pk").distinct().count() == 3


def test_checkpoint_folder_is_required_on_a_cluster():
    import pytest

    from skein.session import checkpoint_dir

    class Fake:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Fake())


def test_pairing_checks_both_sides(spark):
    import pytest
    prompts = spark.createDataFrame([(1, "p"), (2, "q")], "k long, prompt string")
    lists = spark.createDataFrame([(1,), (2,)], "k long")
    sn.check_pairing(prompts, lists, "k")
    for a, b in ((prompts.where("k = 1"), lists), (prompts, lists.where("k = 1"))):
        with pytest.raises(ValueError):
            sn.check_pairing(a, b, "k")
    sents = spark.createDataFrame([(1, 0, "a sentence")], "k long, pos int, sentence string")
    out = {r.k: r.label for r in sn.predict_nested(prompts, sents, "k", ["pos"], lists=lists).collect()}
    assert out[2] is None and out[1] is not None


# ------------------------------------------------------------- preparation

@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=3), min_size=12, max_size=80))
def test_stratified_split_is_exact_partition(spark, labels):
    counts = {c: labels.count(c) for c in set(labels)}
    df = spark.createDataFrame([(i, c) for i, c in enumerate(labels)], "row_id long, label_id int")
    out = prep.stratified_split(df, check_min_class=False).collect()
    assert sorted(r.row_id for r in out) == list(range(len(labels)))
    n_test = sum(r.split == "test" for r in out)
    assert n_test == math.ceil(0.2 * len(labels) - 1e-9)
    for c, n in counts.items():
        t = sum(r.split == "test" and r.label_id == c for r in out)
        assert abs(t - 0.2 * n) < 1.0 + 1e-9


def test_stratified_split_rejects_one_row_class(spark):
    df = spark.createDataFrame([(i, 0) for i in range(10)] + [(10, 1)], "row_id long, label_id int")
    try:
        prep.stratified_split(df)
        raise AssertionError("expected ValueError")
    except ValueError as exc:
        assert "at least 2" in str(exc)


def test_oversample_balances_with_existing_rows(spark):
    df = spark.createDataFrame([(i, 0 if i < 30 else 1 + i % 2) for i in range(42)], "row_id long, label_id int")
    out = prep.oversample(df).collect()
    major = [r for r in out if r.label_id == 0]
    rest = [r for r in out if r.label_id != 0]
    assert len(major) == len(rest) == 30
    assert all(30 <= r.row_id < 42 for r in rest)


def test_balance_orders(spark):
    df = spark.createDataFrame([(i, 0 if i < 40 else 1) for i in range(50)], "row_id long, label_id int")
    a = prep.balance_and_split(df, "split_then_balance").collect()
    test_ids = {r.row_id for r in a if r.split == "test"}
    train_ids = {r.row_id for r in a if r.split == "train"}
    assert not test_ids & train_ids                      # no row on both sides
    tr = [r for r in a if r.split == "train"]
    assert sum(r.label_id == 0 for r in tr) == sum(r.label_id == 1 for r in tr)
    b = prep.balance_and_split(df, "balance_then_split").collect()
    assert len(b) == 80 and sum(r.split == "test" for r in b) == 16


def test_collection_create_insert_and_length_rule(spark, tmp_path):
    from skein.sources import collection as colx
    name = "coll_" + tmp_path.name.replace("-", "_")
    table = colx.create_collection(spark, name, str(tmp_path / "coll"))
    assert table.count() == 0
    rows = spark.createDataFrame(
        [("short text", "p/1", "c", "m", [0.1, 0.2]), ("x" * 16385, "p/2", "c", "m", None)],
        "text string, path string, context string, metadata string, dense_vector array<float>")
    rejected = colx.insert_rows(rows, name)
    assert [r.path for r in rejected.collect()] == ["p/2"]
    again = colx.create_collection(spark, name)
    got = again.collect()
    assert len(got) == 1 and got[0].path == "p/1" and got[0].pk > 0
    info = colx.collection_info(again, spark.createDataFrame([(got[0].pk, "t", 1.0)], "id long, term string, w double"))
    r = info.first()
    assert (r.n_rows, r.n_sparse, r.n_dense) == (1, 1, 1)


def test_collection_batches_are_inserted_once(spark, tmp_path):
    """A repeated batch adds no row, a failed attempt shows none, and a later attempt completes it."""
    import pytest

    from skein.sources import collection as colx
    name, place = "batches_" + tmp_path.name.replace("-", "_"), str(tmp_path / "it's here")
    colx.create_collection(spark, name, place)
    rows = spark.createDataFrame([(f"text {i}", f"p/{i}", "c", "m", [0.1]) for i in range(10)], "text string, path string, context string, metadata string, dense_vector array<float>")
    colx.insert_rows(rows, name, "one")
    colx.insert_rows(rows, name, "one")
    assert colx.create_collection(spark, name).count() == 10
    broken = rows.withColumn("context", F.when(F.col("path") == "p/7", F.raise_error(F.lit("lost"))).otherwise(F.col("context")))
    with pytest.raises(Exception, match="lost"):
        colx.insert_rows(broken, name, "two")
    assert colx.create_collection(spark, name).count() == 10 and colx.batches(spark, name) == ["one"]
    colx.insert_rows(rows, name, "two")
    colx.insert_rows(rows, name)  # without an id: a batch of its own
    got = colx.create_collection(spark, name)
    assert got.count() == 30 and got.columns == colx.COLUMNS and len(colx.batches(spark, name)) == 3
    with pytest.raises(ValueError, match="batch id"):
        colx.insert_rows(rows, name, "../up")


def test_written_tables_can_be_dropped(spark):
    """Only the named tables go; a table that another frame reads stays."""
    import os

    from skein.session import _WRITTEN, drop_written_tables, table_scope, write_table
    before = len(_WRITTEN.get(id(spark.sparkContext), []))
    live = write_table(spark.range(7), "live")
    one, two = write_table(spark.range(5), "one"), write_table(spark.range(6), "two")
    path_one, path_two = list(_WRITTEN[id(spark.sparkContext)])[-2:]
    assert drop_written_tables(spark, one.where("id > 2"), path_two) == 2
    assert not os.path.exists(path_one) and not os.path.exists(path_two)
    assert live.count() == 7 and len(_WRITTEN[id(spark.sparkContext)]) == before + 1
    with table_scope(spark):
        inner = write_table(spark.range(3), "inner")
        path = _WRITTEN[id(spark.sparkContext)][-1]
        assert inner.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path) and live.count() == 7
    assert drop_written_tables(spark, live) == 1


def _hub_graph(spark, leaves, hits):
    """A hub 'h' with ``leaves`` neighbours and ``hits`` hit relationships, all at the hub."""
    nodes = spark.createDataFrame([("h", "h", "place", "d", "m")] + [(f"n{i}", f"n{i}", "person", f"d{i}", f"m{i}") for i in range(leaves)], NODE_SCHEMA)
    edges = spark.createDataFrame([(f"e{i}", f"n{i}", "h", "t", f"x{i}") for i in range(leaves)] + [("e0b", "h", "n0", "t", "y"), ("loop", "h", "h", "t", "z")], EDGE_SCHEMA)
    rows = [(1, f"e{i}", float(i % 3)) for i in range(hits)]
    return nodes, edges, spark.createDataFrame(rows, "prompt_id long, item_id string, score double")


def test_hub_neighbourhood_is_stored_once(spark):
    nodes, edges, hits = _hub_graph(spark, 300, 40)
    ends = gr.edge_endpoint_set(hits, edges)
    hoods = gr.neighborhoods(ends, gr.adjacency(edges), nodes)
    assert hoods.count() == 301 + 41  # the hub's edges once; those of 40 leaves
    out = gr.neighbors_optional(ends, gr.adjacency(edges), nodes)
    assert out.where("endpoint_id = 'h' and neighbor_id is not null").count() == 39 * 300 + 299  # every hit at the hub, without its own leaf


def test_last_hits_stand_for_all_hits(spark):
    """Distinct neighbours and the last write per neighbour equal those of the full product."""
    for hits in (1, 2, 5):
        nodes, edges, rows = _hub_graph(spark, 6, hits)
        rows = rows.unionByName(spark.createDataFrame([(1, "loop", 1.0), (1, "e0b", 0.0), (2, "e0", 1.0), (2, "e0b", 2.0), (3, "loop", 1.0)], rows.schema))
        ends = gr.edge_endpoint_set(rows, edges)
        adj = gr.adjacency(edges)
        product = gr.neighbors_optional(ends, adj, nodes).where("neighbor_id is not null").collect()
        want = {}
        for r in product:
            key = (r.prompt_id, r.endpoint_id, r.nb_edge_id, r.neighbor_id)
            want[key] = max(want.get(key, (-9.0, "")), (-r.score, r.item_id))
        got = gr.shown_neighbors(gr.neighborhoods(ends, adj, nodes), ends).collect()
        assert {(r.prompt_id, r.endpoint_id, r.nb_edge_id, r.neighbor_id): (-r.score, r.item_id) for r in got} == want
        assert len(got) == len(want)


def test_row_index_by_beginnings(spark):
    import random
    rnd = random.Random(3)
    lines = [rnd.choice(["", "a" * 50, "a" * 50 + "b", "é"]) + rnd.choice("xyzé") * rnd.randrange(30) for _ in range(400)]
    df = spark.createDataFrame([(i % 2, t) for i, t in enumerate(lines)], "g long, line string")
    got = with_row_index(df, ["line"], "i", group_by=["g"], num_partitions=6, boundary_chars=4).collect()
    for g in (0, 1):
        own = sorted((r.i, r.line) for r in got if r.g == g)
        assert [i for i, _ in own] == list(range(200))
        assert [t for _, t in own] == sorted((t for i, t in enumerate(lines) if i % 2 == g), key=lambda t: t.encode())


def test_row_index_is_global_and_grouped(spark):
    df = spark.range(0, 500).select((F.col("id") * 7 % 500).alias("v"), (F.col("id") % 3).alias("g"))
    idx = with_row_index(df, ["v"], "i", num_partitions=7).orderBy("v").collect()
    assert [r.i for r in idx] == list(range(500))
    grp = with_row_index(df, ["v"], "i", group_by=["g"], num_partitions=5).collect()
    for g in range(3):
        vals = sorted((r.v, r.i) for r in grp if r.g == g)
        assert [i for _, i in vals] == list(range(len(vals)))


def test_quota_boundary_by_refinement(spark):
    """Every class's quota exactly, however often the boundary bucket is refined."""
    import hashlib
    df = spark.range(6000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 < 2, 0).when(F.col("id") < 2900, 1).otherwise(F.col("id") % 7 + 2).alias("label_id"))
    rows = [(r.row_id, r.label_id) for r in df.collect()]
    keyed = df.withColumn("_key", F.md5(F.concat(F.lit("42:"), F.col("row_id").cast("string"))))
    by_class = {}
    for i, c in rows:
        by_class.setdefault(c, []).append((hashlib.md5(f"42:{i}".encode()).hexdigest(), i))
    quota = {c: (0 if c == 5 else 1 if c == 6 else len(v) if c == 7 else len(v) // 3) for c, v in by_class.items()}
    quotas = spark.createDataFrame(list(quota.items()), "label_id long, n_test long")
    want = {c: sorted(v)[quota[c] - 1] for c, v in by_class.items() if quota[c]}
    for most in (1, 40, 10 ** 6):
        got = prep.quota_cutoffs(keyed.repartition(3), quotas, max_bucket=most).collect()
        assert {r.label_id: (r.cut_key, r.cut_id) for r in got} == want


def test_split_and_oversample_move_no_text(spark):
    from skein.session import write_table
    rows = write_table(spark.createDataFrame([(i, i % 5 // 4, f"text {i}") for i in range(200)], "row_id long, label_id int, input_text string"), "pairs")
    split = prep.stratified_split(rows)
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    assert split.where("split = 'test'").count() == 40
    drawn = prep.oversample(rows).select("row_id", "label_id", "copy_id")
    assert "input_text" not in drawn._jdf.queryExecution().executedPlan().toString()


def test_fixed_length_encoding(spark):
    df = spark.createDataFrame([(1, "b a b"), (2, "c " * 10)], "row_id long, input_text string")
    vocab = prep.build_vocabulary(df)
    enc = {r.row_id: r for r in prep.encode_fixed_length(df, vocab, max_length=4).collect()}
    ids = {r.term: r.token_id for r in vocab.collect()}
    assert enc[1].input_ids == [ids["b"], ids["a"], ids["b"], 0]
    assert enc[1].attention_mask == [1, 1, 1, 0]
    assert enc[2].input_ids == [ids["c"]] * 4 and enc[2].attention_mask == [1, 1, 1, 1]


# ------------------------------------------------------------------ metrics

def test_report_totals_match_confusion(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (2, 2), (1, 3)], "label int, prediction int")
    rep = {r.class_name: r for r in mt.classification_report(df).collect()}
    cm = mt.confusion_matrix(df).collect()
    assert len(cm) == 16 and sum(r.n for r in cm) == 6
    assert rep["accuracy"].support == 6
    assert abs(rep["accuracy"].f1 - sum(r.n for r in cm if r.true_class == r.pred_class) / 6) < 1e-12
    assert rep["3"].support == 0 and rep["3"].precision == 0.0


def test_binary_metrics_undefined_is_zero(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    r = mt.binary_metrics(df).first()
    assert (r.precision, r.recall, r.f1, r.accuracy) == (0.0, 0.0, 0.0, 0.5)


# --------------------------------------------------------------- multimodel

def test_label_normalisation(spark):
    df = spark.createDataFrame([("1",), ("7",), ("LABEL_1",), ("LABEL_9",), ("LABEL_x",), ("positive",)], "l string")
    label, err = mm.normalize_label(F.col("l"), {0: "neg", 1: "pos"})
    got = [(r[0], r[1]) for r in df.select(label, err).collect()]
    assert got == [("pos", None), ("7", None), ("pos", None), ("LABEL_9", None),
                   (None, "invalid literal for int() with base 10: 'x'"), ("positive", None)]


def test_select_models_range():
    specs = [mm.ModelSpec("a", mm.CLASSIFY), mm.ModelSpec("b", mm.CLASSIFY)]
    assert [s.name for s in mm.select_models(specs, "2")] == ["b"]
    assert len(mm.select_models(specs, "all")) == 2
    try:
        mm.select_models(specs, "3")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
