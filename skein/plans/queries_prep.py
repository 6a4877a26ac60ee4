"""Registered queries: sentences (D), training-data preparation (E), metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from skein.operators import metrics as mt
from skein.operators import prep
from skein.operators import sentences as sn
from skein.plans.registry import r6, register
from skein.session import write_table
from skein.sources import fixtures as fx

# --------------------------------------------------------------- sentences


def _split(spark, sf_dir, strip):
    s = sn.split(fx.sentence_texts(spark, sf_dir), "doc_id", "text", strip=strip)
    return s.select("doc_id", F.col("pos").cast("int").alias("pos"), "sentence")


@register("sentence_split")
def q_sentence_split(spark, sf_dir):
    return _split(spark, sf_dir, strip=False)


@register("sentence_split_stripped")
def q_sentence_split_stripped(spark, sf_dir):
    return _split(spark, sf_dir, strip=True)


@register("sentence_split_edge")
def q_sentence_split_edge(spark, sf_dir):
    lists = sn.sentence_lists(fx.sentence_texts(spark, sf_dir), strip=False)
    return lists.select("doc_id", F.size("sentences").cast("int").alias("n_sentences"),
                        F.array_join("sentences", " || ").alias("sentences"))


def conversation_sentences(spark, sf_dir):
    """(conv_id, turn, pos, sentence) of the assistant turns, stripped."""
    replies = fx.conversation_replies(spark, sf_dir)
    lists = sn.sentence_lists(replies, strip=True)
    return lists.select("conv_id", "turn", F.posexplode("sentences").alias("pos", "sentence")) \
                .withColumn("pos", F.col("pos").cast("int"))


@register("pair_text")
def q_pair_text(spark, sf_dir):
    j = fx.conversation_prompts(spark, sf_dir).join(conversation_sentences(spark, sf_dir), "conv_id")
    return j.select("conv_id", "turn", "pos", sn.pair_text("prompt", "sentence").alias("pair_text"))


@register("label_decode")
def q_label_decode(spark, sf_dir):
    e = fx.eval_scores(spark, sf_dir).withColumn("prediction", mt.argmax("scores"))
    return e.select("row_id", "prediction", sn.label_decode(F.col("prediction")).alias("label"))


@register("necessary_sentences")
def q_necessary_sentences(spark, sf_dir):
    s = sn.split(fx.sentence_texts(spark, sf_dir), "doc_id", "text", strip=True)
    kept = sn.keep_necessary(sn.with_prompt(s))
    return kept.select("doc_id", F.col("pos").cast("int").alias("pos"), "sentence")


@register("predict_nested")
def q_predict_nested(spark, sf_dir):
    out = sn.predict_nested(fx.conversation_prompts(spark, sf_dir), conversation_sentences(spark, sf_dir),
                            "conv_id", ["turn", "pos"],
                            lists=fx.read_table(spark, sf_dir, "conversations", "conv_id").distinct())
    return out.select("conv_id", "turn", "pos", "sentence", "label")


# ------------------------------------------------------------ preparation

def _pairs(spark, sf_dir):
    return fx.training_pairs(spark, sf_dir)


def _encoded(spark, sf_dir):
    rows, _ = prep.encode_labels(prep.input_text_drop(_pairs(spark, sf_dir)))
    return rows


@register("input_text_keep")
def q_input_text_keep(spark, sf_dir):
    return prep.input_text_keep(_pairs(spark, sf_dir)).select("row_id", "input_text")


@register("input_text_drop")
def q_input_text_drop(spark, sf_dir):
    return prep.input_text_drop(_pairs(spark, sf_dir)).select("row_id", "input_text", "label")


@register("dropped_counts")
def q_dropped_counts(spark, sf_dir):
    return prep.drop_report(_pairs(spark, sf_dir))


@register("label_clean")
def q_label_clean(spark, sf_dir):
    return _pairs(spark, sf_dir).select("row_id", prep.clean_label("label").alias("label_clean"))


@register("label_map_fixed")
def q_label_map_fixed(spark, sf_dir):
    m = prep.map_fixed_labels(prep.input_text_keep(_pairs(spark, sf_dir)))
    return m.select("row_id", "input_text", "label")


@register("label_encode")
def q_label_encode(spark, sf_dir):
    return prep.label_table(prep.input_text_drop(_pairs(spark, sf_dir)))


@register("class_counts")
def q_class_counts(spark, sf_dir):
    return prep.class_counts(_encoded(spark, sf_dir))


@register("majority_split")
def q_majority_split(spark, sf_dir):
    return prep.majority_split(_encoded(spark, sf_dir)).select("row_id", "label_id", "part")


@register("oversample")
def q_oversample(spark, sf_dir):
    return prep.oversample(_encoded(spark, sf_dir)).select("row_id", "label_id", "copy_id")


def split_rows(spark, sf_dir):
    """The dirty training pairs keep a one-row class at sf0.001 (' Unnecessary '),
    so the registered queries switch the minimum-class check off."""
    return prep.stratified_split(_encoded(spark, sf_dir), check_min_class=False)


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return split_rows(spark, sf_dir).select("row_id", "label_id", "split")


@register("class_weights")
def q_class_weights(spark, sf_dir):
    train = split_rows(spark, sf_dir).where(F.col("split") == "train")
    w = prep.class_weights(train)
    return w.select("label_id", "n", r6("weight").alias("weight"))


def _fixed_length(spark, sf_dir):
    rows = write_table(_encoded(spark, sf_dir).select("row_id", "label_id", "input_text"), "encode")  # read three times
    vocab = prep.build_vocabulary(rows)
    return rows, prep.encode_fixed_length(rows, vocab, max_length=128)


@register("encode_fixed_length")
def q_encode_fixed_length(spark, sf_dir):
    _, enc = _fixed_length(spark, sf_dir)
    return enc.select("row_id", F.array_join("input_ids", " ").alias("input_ids"),
                      F.array_join("attention_mask", " ").alias("attention_mask"))


@register("training_columns")
def q_training_columns(spark, sf_dir):
    rows, enc = _fixed_length(spark, sf_dir)
    t = prep.training_columns(enc, rows)
    return t.select("row_id", F.array_join("input_ids", " ").alias("input_ids"),
                    F.array_join("attention_mask", " ").alias("attention_mask"), "labels")


# ---------------------------------------------------------------- metrics

def _multiclass(spark, sf_dir):
    return fx.eval_scores(spark, sf_dir).withColumn("prediction", mt.argmax("scores"))


@register("argmax_class")
def q_argmax_class(spark, sf_dir):
    return _multiclass(spark, sf_dir).select("row_id", "label", "prediction")


@register("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    m = mt.binary_metrics(fx.eval_binary(spark, sf_dir))
    return m.select(*[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@register("classification_report")
def q_classification_report(spark, sf_dir):
    r = mt.classification_report(_multiclass(spark, sf_dir))
    return r.select("class_name", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), "support")


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(_multiclass(spark, sf_dir))


@register("avg_loss_accuracy")
def q_avg_loss_accuracy(spark, sf_dir):
    e = _multiclass(spark, sf_dir).withColumn("probs", mt.softmax("scores"))
    m = mt.avg_loss_accuracy(e)
    return m.select(r6("avg_loss").alias("avg_loss"), r6("accuracy").alias("accuracy"), "n")


# Candidate rules for best_candidate (predict quality 1 when the
# document is longer than the threshold).
LENGTH_THRESHOLDS = (500, 1000, 2000, 4000)


@register("best_candidate")
def q_best_candidate(spark, sf_dir):
    lab = fx.read_table(spark, sf_dir, "labels", "doc_id", "quality")
    docs = fx.read_table(spark, sf_dir, "documents", "doc_id", "n_chars")
    j = lab.join(docs, "doc_id").withColumn(
        "rule", F.explode(F.array(*[F.struct(F.lit(i).alias("candidate_order"), F.lit(t).alias("threshold"))
                                    for i, t in enumerate(LENGTH_THRESHOLDS)])))
    j = j.select("quality", "n_chars", "rule.*").withColumn(
        "prediction", (F.col("n_chars") > F.col("threshold")).cast("int"))
    y, p = F.col("quality"), F.col("prediction")
    per = j.groupBy("candidate_order", "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == p).alias("hit"),
        F.count_if((p == 1) & (y == 1)).alias("tp"), F.count_if(p == 1).alias("pp"),
        F.count_if(y == 1).alias("ap"))
    per = per.select(F.concat(F.lit("length>"), F.col("threshold").cast("string")).alias("candidate"),
                     "candidate_order",
                     F.round(F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("pp") + F.col("ap")), F.lit(0.0)), 9)
                     .alias("f1"))
    best = mt.best_candidate(per, "f1")
    return best.select(F.col("best").alias("candidate"), r6("best_f1").alias("f1"))
