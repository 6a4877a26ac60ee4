"""The streaming entry point gives the same rows as the batch pipeline."""

import os
import tempfile

from skein.plans import ask as ak
from skein.plans import queries_models as qm
from skein.sources import fixtures as fx
from skein.streaming import prompts as sp


def test_pipeline_filter_with_model_keeps_order(spark):
    from skein.operators import train as tr
    rows = [(i, f"keep this {i}" if i % 2 else f"drop that {i}", i % 2) for i in range(40)]
    model = tr.fit(spark.createDataFrame(rows, "row_id long, text string, label_id int"),
                   ["unnecessary", "necessary"], reg_param=0.01)
    df = spark.createDataFrame([(1, "q", "keep this 1. drop that 2. keep this 3."), (2, "q", "")],
                               "prompt_id int, prompt string, graph_context string")
    out = {r.prompt_id: r.graph_context for r in
           ak.filter_context_with_model(df, "graph_context", "prompt", model).collect()}
    assert out[1] == "keep this 1. keep this 3." and out[2] == ""


def test_answer_step_and_failure_gives_null(spark):
    df = spark.createDataFrame([(1, "ctx a", "", "who?"), (2, "ctx b", "v", "what?")],
                               "prompt_id int, graph_context string, vector_context string, prompt string")
    from pyspark.sql import functions as F
    with_text = df.withColumn("prompt_text", ak.render_prompt(F.col("graph_context"), F.col("vector_context"),
                                                              F.col("prompt")))
    ok = {r.prompt_id: r for r in ak.answer(with_text, lambda s: s.str.len().astype(str)).collect()}
    assert ok[1].llm_response == str(len(ok[1].prompt_text))
    assert ok[1].prompt_text.startswith("Using the provided contexts") and "context1: ctx a" in ok[1].prompt_text
    assert ok[1].prompt_text.endswith("question: who?\n            ")

    def broken(s):
        raise RuntimeError("server down")
    bad = ak.answer(with_text, broken).collect()
    assert all(r.llm_response is None and r.llm_error == "server down" for r in bad)

    def some(s):
        if s.str.contains("what").any():
            raise RuntimeError("no answer to that")
        return s.str.len().astype(str)
    mixed = {r.prompt_id: r for r in ak.answer(with_text.coalesce(1), some).collect()}
    assert mixed[1].llm_response == str(len(mixed[1].prompt_text)) and mixed[1].llm_error is None
    assert mixed[2].llm_response is None and mixed[2].llm_error == "no answer to that"


def test_dense_weight_needs_vectors(spark, sf_dir):
    import pytest
    prompts = spark.createDataFrame([(1, "the")], "prompt_id long, prompt string")
    with pytest.raises(ValueError):
        ak.vector_contexts(prompts, ak.Sources())


def test_stream_matches_batch(spark, sf_dir):
    base = tempfile.mkdtemp(prefix="stream-", dir=os.path.dirname(sp.checkpoint_dir(spark)) or None)
    inbox, out = os.path.join(base, "in"), os.path.join(base, "out")
    prompts = fx.prompts(spark, sf_dir).where("prompt_id <= 10")
    prompts.where("prompt_id <= 5").write.parquet(os.path.join(inbox, "part1"))
    prompts.where("prompt_id > 5").write.parquet(os.path.join(inbox, "part2"))
    src = qm._sources(spark, sf_dir)
    config = {"pipeline": {"graph_retriever": True, "vector_retriever": True}, "components": {"vector_retriever": {"dense_weight": 0}}}
    q = sp.start(spark, os.path.join(inbox, "*"), out, config, src, name="t" + os.path.basename(base)[-6:])
    q.awaitTermination(600)
    got = spark.read.parquet(out).drop("batch_id")
    want = ak.ask(prompts, config, src)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
