"""Physical plan checks: the shapes the operators are designed to get."""

from pyspark.sql import functions as F

from skein.plans.registry import QUERIES
from skein.operators import fulltext as ft
from skein.sources import fixtures as fx


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_uses_window_group_limit(spark, sf_dir):
    df = QUERIES["ft_top40"](spark, sf_dir)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in p


def test_no_cartesian_or_nested_loop_joins(spark, sf_dir):
    for key in ("graph_retrieve", "hybrid_search", "ask_pipeline", "stratified_split", "oversample",
                "encode_fixed_length", "confusion_matrix", "multi_model_score"):
        p = plan(QUERIES[key](spark, sf_dir))
        assert "CartesianProduct" not in p, key
        assert "BroadcastNestedLoopJoin" not in p, key


def test_dense_search_is_a_block_product(spark, sf_dir):
    p = plan(QUERIES["dense_topk"](spark, sf_dir))
    assert "MapInPandas" in p and "WindowGroupLimit" in p


def test_no_python_in_relational_keys(spark, sf_dir):
    for key in ("graph_retrieve", "sentence_split_stripped", "necessary_sentences", "stratified_split",
                "classification_report", "sparse_topk", "ask_pipeline"):
        p = plan(QUERIES[key](spark, sf_dir))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_scan_reads_only_needed_columns(spark, sf_dir):
    p = plan(QUERIES["binary_metrics"](spark, sf_dir))
    # labels has doc_id, quality, toxic; the metrics need quality and toxic only
    assert "ReadSchema: struct<quality:int,toxic:int>" in p


def test_index_builds_move_no_texts(spark, sf_dir):
    """Exchanges of the term counts hold ids, terms and counts, never a text."""
    import re

    from skein.operators import vectors as vec
    nodes, edges = fx.graph_nodes(spark, sf_dir), fx.graph_edges(spark, sf_dir)
    items = ft.index_items(spark.createDataFrame(nodes.limit(5).collect(), nodes.schema), spark.createDataFrame(edges.limit(5).collect(), edges.schema))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("pk"), "text")
    for df in (ft.postings(items), vec.term_frequencies(docs)):
        p = df._jdf.queryExecution().executedPlan().toString()
        moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
        assert moved and not any("text" in m or "toks" in m for m in moved), p
        assert "partial_count" in p


def test_graph_expansion_carries_no_texts(spark, sf_dir):
    from skein.operators import graph as gr
    g = gr.GraphRetrieval.run(fx.prompts(spark, sf_dir), *_graph(spark, sf_dir))
    for df in (g.node_rows, g.endpoints, g.expansion):
        assert not any("description" in c or c == "text" for c in df.columns), df.columns


def _graph(spark, sf_dir):
    from skein.session import write_table
    return write_table(fx.graph_nodes(spark, sf_dir), "nodes"), write_table(fx.graph_edges(spark, sf_dir), "edges")


def test_expression_models_share_one_scan(spark, sf_dir):
    p = plan(QUERIES["multi_model_score"](spark, sf_dir))
    assert p.count("FileScan parquet") == 1


def test_search_filter_is_pushed_to_postings_join(spark, sf_dir):
    nodes, edges = fx.graph_nodes(spark, sf_dir), fx.graph_edges(spark, sf_dir)
    idx = ft.FullTextIndex.build(nodes, edges)
    exp = ft.expanded_terms(ft.query_terms(fx.prompts(spark, sf_dir)), idx.terms)
    df = ft.search(exp, idx).where(F.col("kind") == "edge")
    p = plan(df)
    assert "CartesianProduct" not in p
