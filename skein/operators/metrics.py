"""Evaluation: one aggregation pass per report, no driver loops."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROB_FLOOR = 1e-15


def argmax(scores) -> F.Column:
    """0-based index of the first maximum of an array column."""
    s = scores if isinstance(scores, F.Column) else F.col(scores)
    return (F.array_position(s, F.array_max(s)) - 1).cast("int")


def softmax(scores) -> F.Column:
    s = scores if isinstance(scores, F.Column) else F.col(scores)
    top = F.array_max(s)  # scores far from 0 must not overflow
    total = F.aggregate(F.transform(s, lambda x: F.exp(x - top)), F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(s, lambda x: F.exp(x - top) / total)


def _ratio(num, den) -> F.Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def binary_metrics(df: DataFrame, label_col: str = "label", pred_col: str = "prediction",
                   positive=1) -> DataFrame:
    """accuracy, precision, recall, F1 of the positive class; 0 when undefined."""
    y, p = F.col(label_col), F.col(pred_col)
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(y == p).alias("hit"),
                 F.count_if((p == positive) & (y == positive)).alias("tp"),
                 F.count_if(p == positive).alias("pp"),
                 F.count_if(y == positive).alias("ap"))
    prec, rec = _ratio(F.col("tp"), F.col("pp")), _ratio(F.col("tp"), F.col("ap"))
    return agg.select(_ratio(F.col("hit"), F.col("n")).alias("accuracy"), prec.alias("precision"),
                      rec.alias("recall"),
                      _ratio(2 * F.col("tp"), F.col("pp") + F.col("ap")).alias("f1"))


def _classes(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    return df.select(F.col(label_col).alias("cls")).union(df.select(F.col(pred_col).alias("cls"))).distinct()


def classification_report(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """rows per class plus 'accuracy', 'macro avg', 'weighted avg'
    (precision, recall, f1, support). Class names are the class values as text."""
    y, p = F.col(label_col), F.col(pred_col)
    # Per class true / predicted / correct counts from one exploded pass.
    marks = df.select(F.explode(F.array(
        F.struct(y.alias("cls"), F.lit(1).alias("t"), F.lit(0).alias("pr"), (y == p).cast("int").alias("c")),
        F.struct(p.alias("cls"), F.lit(0).alias("t"), F.lit(1).alias("pr"), F.lit(0).alias("c")))).alias("m"))
    per = marks.groupBy(F.col("m.cls").alias("cls")).agg(
        F.sum("m.t").alias("support"), F.sum("m.pr").alias("pred"), F.sum("m.c").alias("tp"))
    per = per.select("cls", "support",
                     _ratio(F.col("tp"), F.col("pred")).alias("precision"),
                     _ratio(F.col("tp"), F.col("support")).alias("recall"),
                     _ratio(2 * F.col("tp"), F.col("pred") + F.col("support")).alias("f1"),
                     "tp")
    rows = per.select(F.col("cls").cast("string").alias("class_name"), "precision", "recall", "f1",
                      F.col("support").cast("bigint").alias("support"))
    # Summary rows come from the per-class table (one row per class).
    summ = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                   F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                   F.sum(F.col("precision") * F.col("support")).alias("wp"),
                   F.sum(F.col("recall") * F.col("support")).alias("wr"),
                   F.sum(F.col("f1") * F.col("support")).alias("wf"))
    summary = summ.select(F.explode(F.array(
        _report_row("accuracy", F.lit(None), F.lit(None), _ratio(F.col("tp"), F.col("n")), F.col("n")),
        _report_row("macro avg", F.col("mp"), F.col("mr"), F.col("mf"), F.col("n")),
        _report_row("weighted avg", _ratio(F.col("wp"), F.col("n")), _ratio(F.col("wr"), F.col("n")),
                    _ratio(F.col("wf"), F.col("n")), F.col("n")))).alias("r"))
    return rows.unionByName(summary.select("r.*"))


def _report_row(name, precision, recall, f1, support) -> F.Column:
    return F.struct(F.lit(name).alias("class_name"), precision.cast("double").alias("precision"),
                    recall.cast("double").alias("recall"), f1.cast("double").alias("f1"),
                    support.cast("bigint").alias("support"))


def confusion_matrix(df: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(true, predicted, n) for every pair of classes, zeros kept (long form)."""
    counts = df.groupBy(F.col(label_col).alias("true_class"), F.col(pred_col).alias("pred_class")) \
               .agg(F.count(F.lit(1)).alias("n"))
    classes = _classes(df, label_col, pred_col).agg(F.sort_array(F.collect_list("cls")).alias("cs"))
    grid = classes.select(F.explode("cs").alias("true_class"), "cs") \
                  .select("true_class", F.explode("cs").alias("pred_class"))
    return grid.join(counts, ["true_class", "pred_class"], "left") \
               .select("true_class", "pred_class", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def avg_loss_accuracy(df: DataFrame, prob_col: str = "probs", label_col: str = "label",
                      pred_col: str = "prediction") -> DataFrame:
    """F8: mean cross-entropy (probabilities floored at 1e-15) and accuracy."""
    p_true = F.element_at(F.col(prob_col), F.col(label_col) + 1)
    return df.agg(F.avg(-F.log(F.greatest(p_true, F.lit(PROB_FLOOR)))).alias("avg_loss"),
                  F.avg((F.col(label_col) == F.col(pred_col)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def best_candidate(metrics: DataFrame, metric: str, candidate_col: str = "candidate",
                   order_col: str = "candidate_order") -> DataFrame:
    """candidate with the greatest metric; the earliest wins a tie."""
    return metrics.agg(
        F.max_by(candidate_col, F.struct(F.col(metric), -F.col(order_col))).alias("best"),
        F.max(metric).alias("best_" + metric))
