"""Registered queries: models (F1-F3, F9, A1, A6, D5), multi-model scoring (G),
question pipeline (H)."""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skein.functions.text import terms
from skein.operators import multimodel as mm
from skein.operators import prep
from skein.operators import sentences as sn
from skein.operators import train as tr
from skein.operators import vectors as vec
from skein.plans import ask as ak
from skein.plans.registry import _index, r6, register
from skein.session import checkpoint_dir, cut_lineage, track, write_table
from skein.sources import fixtures as fx
from skein.sources import training_csv

# ------------------------------------------------------------------ models


def _binary_data(spark, sf_dir):
    """SequenceClassifier path: E1 text, E3/E4 fixed labels, E9 split, E10 weights."""
    rows = prep.map_fixed_labels(prep.input_text_keep(fx.training_pairs(spark, sf_dir)))
    rows = rows.withColumnRenamed("label", "label_id").withColumnRenamed("input_text", "text")
    split = write_table(prep.stratified_split(rows).select("row_id", "text", "label_id", "split"), "split")  # read by every pass of a fit
    train = prep.with_class_weights(split.where(F.col("split") == "train"))
    return train, split.where(F.col("split") == "test")


BINARY_NAMES = [sn.LABEL_NAMES[0], sn.LABEL_NAMES[1]]


def _binary_model(spark, sf_dir, **kw):
    train, valid = _binary_data(spark, sf_dir)
    model = tr.fit(train, BINARY_NAMES, weight_col="weight", **kw)
    return model, valid


@register("fit_binary")
def q_fit_binary(spark, sf_dir):
    """What must hold for any good fit: rows scored, positives, better than chance on both classes."""
    model, valid = _binary_model(spark, sf_dir)
    pred = tr.predict_table(model, valid)
    y, p = F.col("label_id"), F.col("prediction")
    counts = pred.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("n_positive"),
                      (F.count_if((y == 1) & (p == 1)) / F.count_if(y == 1) + F.count_if((y == 0) & (p == 0)) / F.count_if(y == 0)).alias("both"))
    return counts.select("n", "n_positive", (F.col("both") > 1).alias("better_than_chance"))


def _multiclass(spark, sf_dir):
    frame = fx.multiclass_frame(spark, sf_dir)
    rows, table = prep.encode_labels(frame)
    names = [r["label"] for r in table.orderBy("label_id").collect()]  # class names (few)
    split = write_table(prep.stratified_split(rows).select("row_id", "text", "label_id", "split"), "split")
    model = tr.fit(split.where(F.col("split") == "train"), names, family="multinomial")
    return model, split.where(F.col("split") == "test")


@register("fit_multiclass")
def q_fit_multiclass(spark, sf_dir):
    """Support of every class, and whether the accuracy beats the largest class's share."""
    from skein.operators import metrics as mt
    model, valid = _multiclass(spark, sf_dir)
    pred = tr.predict_table(model, valid).withColumnRenamed("label_id", "label")
    report = cut_lineage(mt.classification_report(pred).where(~F.col("class_name").isin("macro avg", "weighted avg")))
    largest = report.where("class_name <> 'accuracy'").agg((F.max("support") / F.sum("support")).alias("s")).first()["s"]
    return report.select("class_name", "support", F.when(F.col("class_name") == "accuracy", F.col("f1") > largest).alias("beats_majority"))


@register("predict_table")
def q_predict_table(spark, sf_dir):
    model, valid = _multiclass(spark, sf_dir)
    names = list(model.stages[-1].getLabels())
    return tr.predict_table(model, valid).select("row_id", "label_id", (F.col("predicted_label").isin(names) & F.col("p_max").between(0, 1)).alias("known"))


@register("select_best")
def q_select_best(spark, sf_dir):
    """Every setting with whether it was picked rightly: the pick has the greatest metric, the first of equals."""
    from skein.operators import metrics as mt
    train, valid = _binary_data(spark, sf_dir)
    grid = [{"reg_param": 0.0}, {"reg_param": 0.01}, {"reg_param": 0.1}]

    def f1(pred):
        return mt.binary_metrics(pred.withColumnRenamed("label_id", "label"))

    values, idx, _ = tr.select_best(train, valid, BINARY_NAMES, grid, f1, "f1", weight_col="weight")
    rows = [(i, str(grid[i]), all(values[idx] > v if j < idx else values[idx] >= v for j, v in enumerate(values))) for i in range(len(grid))]
    return spark.createDataFrame(rows, "candidate_order int, setting string, best_is_first_maximum boolean")


@register("fitted_models_score")
def q_fitted_models_score(spark, sf_dir):
    """Three fitted models over every document in one scan, each row equal to the model's own transform."""
    rows, table = prep.encode_labels(fx.multiclass_frame(spark, sf_dir))
    names = [r["label"] for r in table.orderBy("label_id").collect()]  # class names (few)
    grid = [{"reg_param": 0.01}, {"reg_param": 0.1}, {"reg_param": 0.01, "max_iter": 5}]
    models = tr.fit_settings(rows.select("row_id", "text", "label_id"), names, grid, family="multinomial")
    specs = [mm.ModelSpec(f"setting {i}", mm.CLASSIFY, spark_model=m, label_mapping=dict(enumerate(names))) for i, m in enumerate(models)]
    docs = _doc_rows(spark, sf_dir)
    together = mm.score_all(docs, specs).select("row_id", "model", "label", "score")
    alone = None
    for spec in specs:
        own = spec.spark_model.transform(docs).select("row_id", F.lit(spec.name).alias("model"), F.col("predicted_label").alias("own_label"),
                                                      F.array_max(vector_to_array("probability")).alias("own_score"))
        alone = own if alone is None else alone.unionByName(own)
    same = (F.col("label") == F.col("own_label")) & (F.abs(F.col("score") - F.col("own_score")) < 1e-9)
    return together.join(alone, ["row_id", "model"]).select("row_id", "model", same.alias("same"))


@register("scan_training_csv")
def q_scan_training_csv(spark, sf_dir):
    path = os.path.join(checkpoint_dir(spark), "training-csv-" + uuid.uuid4().hex)
    track(spark, path)
    training_csv.write(fx.training_pairs(spark, sf_dir), path)
    return training_csv.read(spark, path)


@register("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    model, valid = _binary_model(spark, sf_dir)
    path = os.path.join(checkpoint_dir(spark), "model-" + uuid.uuid4().hex)
    track(spark, path)
    tr.save(model, path)
    again = tr.load(path)
    a = tr.predict_table(model, valid).select("row_id", F.col("prediction").alias("before"), F.col("p_max").alias("p"))
    b = tr.predict_table(again, valid).select("row_id", F.col("prediction").alias("after"), F.col("p_max").alias("q"))
    return a.join(b, "row_id").select("row_id", ((F.col("before") == F.col("after")) & (F.abs(F.col("p") - F.col("q")) < 1e-9)).alias("same"))


@register("predict_pairs")
def q_predict_pairs(spark, sf_dir):
    model, _ = _binary_model(spark, sf_dir)
    s = sn.split(fx.sentence_texts(spark, sf_dir), "doc_id", "text", strip=True)
    out = sn.predict_pairs(sn.with_prompt(s), model=model)
    return out.select("doc_id", F.col("pos").cast("int").alias("pos"), F.col("label").isin(*sn.LABEL_NAMES.values()).alias("known"))


# -------------------------------------------------------------- multi-model

# Label mappings of the derived model outputs.
OUTCOME_NAMES = {0: "negative", 1: "positive"}


def derived_models() -> list[mm.ModelSpec]:
    """Four SQL-expressible models over (row_id, text): numeric labels, LABEL_n
    labels (with a malformed one), plain names, and a generator whose score is
    present only for odd rows."""
    rid = F.col("row_id")
    return [
        mm.ModelSpec("digits", mm.CLASSIFY, label_mapping=OUTCOME_NAMES, expr=lambda t: F.struct(
            (rid % 8).cast("string").alias("label"), ((rid % 997) / 997.0).alias("score"))),
        mm.ModelSpec("prefixed", mm.CLASSIFY, label_mapping=OUTCOME_NAMES, expr=lambda t: F.struct(
            F.concat(F.lit("LABEL_"), F.when(rid % 37 == 0, F.lit("x")).otherwise((rid % 10).cast("string")))
            .alias("label"), ((rid % 991) / 991.0).alias("score"))),
        mm.ModelSpec("named", mm.CLASSIFY, expr=lambda t: F.struct(
            F.when(F.length(t) > 2000, F.lit("positive")).otherwise(F.lit("negative")).alias("label"),
            ((rid % 983) / 983.0).alias("score"))),
        mm.ModelSpec("writer", mm.GENERATE, expr=lambda t: F.struct(
            F.concat(F.size(terms(t)).cast("string"), F.lit(" terms")).alias("generated_text"),
            F.when(rid % 2 == 1, (rid % 101) / 101.0).alias("score"))),
    ]


def _doc_rows(spark, sf_dir):
    return fx.read_table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "row_id")


def _scored(spark, sf_dir, selection="all"):
    return mm.score_all(_doc_rows(spark, sf_dir), mm.select_models(derived_models(), selection))


@register("multi_model_score")
def q_multi_model_score(spark, sf_dir):
    s = _scored(spark, sf_dir)
    return s.select("row_id", "model", "task", "label", r6("score").alias("score"), "generated_text", "error")


@register("label_normalize")
def q_label_normalize(spark, sf_dir):
    per_model = []
    for spec in derived_models():
        if spec.task != mm.CLASSIFY:
            continue
        raw = spec.expr(F.col("text"))["label"]
        label, err = mm.normalize_label(raw, spec.label_mapping)
        per_model.append(F.struct(F.lit(spec.name).alias("model"), raw.alias("raw_label"), label.alias("label"), err.alias("error")))
    return _doc_rows(spark, sf_dir).select("row_id", F.explode(F.array(*per_model)).alias("r")).select("row_id", "r.*")  # one scan


def fragile_batch(texts: pd.Series) -> pd.DataFrame:
    """A batch model that fails on some inputs (text length divisible by 7)."""
    if (texts.str.len() % 7 == 0).any():
        bad = texts[texts.str.len() % 7 == 0].iloc[0]
        raise ValueError(f"cannot score a text of {len(bad)} characters")
    return pd.DataFrame({"label": (texts.str.len() % 2).astype(str), "score": 0.5})


@register("model_errors")
def q_model_errors(spark, sf_dir):
    spec = mm.ModelSpec("fragile", mm.CLASSIFY, batch_fn=fragile_batch, label_mapping=OUTCOME_NAMES)
    s = mm.score_all(_doc_rows(spark, sf_dir), [spec])
    return s.select("row_id", "model", "label", "error")


@register("result_lines")
def q_result_lines(spark, sf_dir):
    return mm.result_lines(_scored(spark, sf_dir))


# ------------------------------------------------------------------ pipeline

def _sources(spark, sf_dir) -> ak.Sources:
    nodes, edges, index = _index(spark, sf_dir)
    coll = write_table(fx.chunk_collection(spark, sf_dir), "chunks")
    sparse, idf = vec.sparse_rows(coll.select("pk", "text"))
    return ak.Sources(nodes=nodes, edges=edges, index=index, collection=coll, doc_sparse=sparse, idf=idf)


def _merged(spark, sf_dir):
    prompts = fx.prompt_vectors(spark, sf_dir)
    src = _sources(spark, sf_dir)
    return prompts, ak.merge_contexts(prompts.drop("dense_vector"), ak.graph_contexts(prompts, src), ak.vector_contexts(prompts, src))


@register("merge_contexts")
def q_merge_contexts(spark, sf_dir):
    _, m = _merged(spark, sf_dir)
    return m.select("prompt_id", "graph_context", "vector_context")


@register("render_prompt")
def q_render_prompt(spark, sf_dir):
    _, m = _merged(spark, sf_dir)
    return m.select("prompt_id", ak.render_prompt(F.col("graph_context"), F.col("vector_context"),
                                                  F.col("prompt")).alias("prompt_text"))


PIPELINE_CONFIG = {
    "pipeline": {"prompt_splitter": False, "router": False, "graph_retriever": True,
                 "vector_retriever": True, "sentence_classifier": True, "llm": False},
    "components": {"vector_retriever": {"limit": 4}, "sentence_splitter": {"split_char": ".!?\n"}},
}


@register("ask_pipeline")
def q_ask_pipeline(spark, sf_dir):
    return ak.ask(fx.prompt_vectors(spark, sf_dir), PIPELINE_CONFIG, _sources(spark, sf_dir)) \
             .select("prompt_id", "graph_context", "vector_context")


def measured(texts: pd.Series) -> pd.Series:
    """A stand-in for the chat model: the prompt's length; it fails on lengths divisible by 7."""
    if (texts.str.len() % 7 == 0).any():
        raise ValueError("cannot answer")
    return texts.str.len().astype(str) + " characters"


@register("ask_answer")
def q_ask_answer(spark, sf_dir):
    """The whole pipeline with the answer step on; prompts whose call fails have no answer."""
    config = {"pipeline": PIPELINE_CONFIG["pipeline"] | {"llm": True}, "components": PIPELINE_CONFIG["components"] | {"llm": {"fn": measured}}}
    return ak.ask(fx.prompt_vectors(spark, sf_dir), config, _sources(spark, sf_dir)).select("prompt_id", "llm_response", "llm_error")


@register("filter_context")
def q_filter_context(spark, sf_dir):
    prompts = fx.prompts(spark, sf_dir)
    nodes, edges, index = _index(spark, sf_dir)
    g = ak.graph_contexts(prompts, ak.Sources(nodes=nodes, edges=edges, index=index))
    j = prompts.join(g, "prompt_id", "left")
    return j.select("prompt_id", ak.filter_context(F.coalesce("graph_context", F.lit("")), F.col("prompt"))
                    .alias("filtered_context"))
