"""Scoring every row with several models.

A model is one of
* an expression model: a function Column(text) -> struct(label, score) or
  struct(generated_text, score), evaluated JVM-side;
* a fitted Spark ML ``PipelineModel`` (classification);
* a pandas batch function ``fn(pd.Series) -> pd.DataFrame`` run with
  ``mapInPandas`` (Arrow batches). A failing batch is halved until the failing
  rows stand alone, so one bad row only sets that row's ``error``; a function
  may instead return an ``error`` column of its own.

All results land in one long table ``(row_id, model, task, label, score,
generated_text, output, error)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Callable

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSIFY = "text-classification"
GENERATE = "text-generation"

RESULT_SCHEMA = ("row_id long, model string, task string, label string, score double, "
                 "generated_text string, output string, error string")


@dataclass
class ModelSpec:
    name: str
    task: str
    expr: Callable[[F.Column], F.Column] | None = None
    spark_model: Any = None
    batch_fn: Callable[[pd.Series], pd.DataFrame] | None = None
    label_mapping: dict = field(default_factory=dict)


def select_models(models: list[ModelSpec], selection: str) -> list[ModelSpec]:
    """'all' or comma-separated 1-based numbers; an out-of-range number raises."""
    if selection.strip().lower() == "all":
        return list(models)
    picked = []
    for part in selection.split(","):
        i = int(part.strip())
        if not 1 <= i <= len(models):
            raise ValueError(f"model number {i} out of range 1..{len(models)}")
        picked.append(models[i - 1])
    return picked


def load_spark_models(paths: dict[str, str], mappings: dict[str, dict] | None = None
                      ) -> tuple[list[ModelSpec], dict[str, str]]:
    """Load saved Spark ML pipelines by name. Models that cannot be loaded are
    left out and reported as ``{name: error}``, the others are returned."""
    from pyspark.ml import PipelineModel
    specs, failed = [], {}
    for name, path in paths.items():
        try:
            specs.append(ModelSpec(name, CLASSIFY, spark_model=PipelineModel.load(path),
                                   label_mapping=(mappings or {}).get(name, {})))
        except Exception as exc:  # noqa: BLE001 - report and go on with the rest
            failed[name] = str(exc).splitlines()[0] if str(exc) else type(exc).__name__
    return specs, failed


def normalize_label(label: F.Column, mapping: dict) -> tuple[F.Column, F.Column]:
    """(label, error). Digits -> mapping by number; text with '_' -> the
    number after the last '_' -> mapping; unmapped or other labels stay. A
    non-number after '_' is an error, as in the reference."""
    if mapping:
        m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(int(k)), F.lit(v))])
    else:
        m = F.create_map().cast("map<int,string>")
    digits = label.rlike("^[0-9]+$")
    tail = F.element_at(F.split(label, "_"), -1)
    tail_num = tail.try_cast("int")
    out = (F.when(digits, F.coalesce(F.try_element_at(m, label.try_cast("int")), label))
            .when(label.contains("_") & tail_num.isNotNull(), F.coalesce(F.try_element_at(m, tail_num), label))
            .when(label.contains("_"), F.lit(None))
            .otherwise(label))
    err = F.when(~digits & label.contains("_") & tail_num.isNull(),
                 F.concat(F.lit("invalid literal for int() with base 10: '"), tail, F.lit("'")))
    return out, err


def _null(kind: str = "string") -> F.Column:
    return F.lit(None).cast(kind)


def _expr_result(spec: ModelSpec) -> F.Column:
    """Result struct of an expression model over ``text``."""
    r = spec.expr(F.col("text"))
    label, score, generated, output, error = _null(), _null("double"), _null(), _null(), _null()
    if spec.task == CLASSIFY:
        label, error = normalize_label(r["label"], spec.label_mapping)
        score = F.when(error.isNull(), r["score"].cast("double"))
    elif spec.task == GENERATE:
        score, generated = r["score"].cast("double"), r["generated_text"]
    else:
        output = r.cast("string")
    return F.struct(F.lit(spec.name).alias("model"), F.lit(spec.task).alias("task"), label.cast("string").alias("label"),
                    score.alias("score"), generated.cast("string").alias("generated_text"), output.alias("output"),
                    error.cast("string").alias("error"))


def _from_exprs(df: DataFrame, specs: list[ModelSpec]) -> DataFrame:
    """All expression models in one scan."""
    return df.select("row_id", F.explode(F.array(*[_expr_result(s) for s in specs])).alias("r")).select("row_id", "r.*")


def _text_stages(model) -> tuple[list, tuple]:
    """The tokenizer and term-frequency stages a pipeline starts with, and what identifies them."""
    kinds = [type(st).__name__ for st in model.stages[:2]]
    if kinds != ["RegexTokenizer", "HashingTF"]:
        return [], ()
    words, tf = model.stages[:2]
    return [words, tf], (words.getInputCol(), words.getOutputCol(), words.getPattern(), words.getGaps(), words.getMinTokenLength(), words.getToLowercase(),
                         tf.getInputCol(), tf.getOutputCol(), tf.getNumFeatures(), tf.getBinary())


def _from_spark_models(df: DataFrame, specs: list[ModelSpec]) -> DataFrame:
    """All fitted pipelines in one scan. Each adds one struct (its prediction and probability) to
    the row and the next pipeline goes on from there. Pipelines that start with the same tokenizer
    and term frequencies share them, so a text is cut and hashed once per such group."""
    out, base, done = df, df.columns, []
    groups: dict[tuple, list[ModelSpec]] = {}
    for spec in specs:
        shared = _text_stages(spec.spark_model)[1]
        groups.setdefault(shared if shared else (spec.name, id(spec)), []).append(spec)
    for members in groups.values():
        shared = _text_stages(members[0].spark_model)[0]
        for stage in shared:
            out = stage.transform(out)
        ready = [stage.getOutputCol() for stage in shared]
        for spec in members:
            name = f"__model{len(done)}"
            for stage in spec.spark_model.stages[len(shared):]:
                out = stage.transform(out)
            raw = F.col("prediction").cast("int").cast("string")
            label, err = normalize_label(raw, spec.label_mapping)
            result = F.struct(F.lit(spec.name).alias("model"), F.lit(CLASSIFY).alias("task"), label.alias("label"),
                              F.array_max(vector_to_array("probability")).alias("score"), _null().alias("generated_text"),
                              _null().alias("output"), err.alias("error"))
            out = out.select(*base, *ready, *done, result.alias(name))
            done.append(name)
        out = out.select(*base, *done)
    return out.select("row_id", F.explode(F.array(*done)).alias("r")).select("row_id", "r.*")


def _from_batch(df: DataFrame, spec: ModelSpec) -> DataFrame:
    fn, name, task = spec.batch_fn, spec.name, spec.task

    def attempt(values: pd.Series) -> tuple[list[dict], list]:
        """Rows and errors; a failing batch is halved until the failing rows
        stand alone. A batch function may also return its own ``error`` column."""
        try:
            res = fn(values)
            rows = res.to_dict("records")
            return rows, [None if pd.isna(r.get("error")) else str(r.get("error")) for r in rows]
        except Exception as exc:  # noqa: BLE001 - isolate the failing rows
            if len(values) == 1:
                return [{}], [str(exc)]
        middle = len(values) // 2
        a, b = (attempt(part.reset_index(drop=True)) for part in (values.iloc[:middle], values.iloc[middle:]))
        return a[0] + b[0], a[1] + b[1]

    def run(batches):
        for pdf in batches:
            rows, errors = attempt(pdf["text"]) if len(pdf) else ([], [])
            out = pd.DataFrame({"row_id": pdf["row_id"].to_numpy(), "model": name, "task": task})
            for c in ("label", "score", "generated_text", "output"):
                out[c] = pd.Series([r.get(c) if e is None else None for r, e in zip(rows, errors)], dtype=object)
            out["score"] = pd.to_numeric(out["score"], errors="coerce")
            out["error"] = pd.Series(errors, dtype=object)
            yield out

    scored = df.select("row_id", "text").mapInPandas(run, RESULT_SCHEMA)
    if task == CLASSIFY:
        label, err = normalize_label(F.col("label"), spec.label_mapping)
        scored = scored.withColumn("error", F.coalesce("error", err)) \
                       .withColumn("label", F.when(F.col("label").isNotNull(), label))
    return scored


def score_all(df: DataFrame, models: list[ModelSpec]) -> DataFrame:
    """G1 + G3: every row (row_id, text) through every model, one long table."""
    exprs = [m for m in models if m.expr is not None]
    parts = [_from_exprs(df, exprs)] if exprs else []
    fitted = [m for m in models if m.expr is None and m.spark_model is not None]
    parts += [_from_spark_models(df, fitted)] if fitted else []
    for spec in models:
        if spec.expr is not None or spec.spark_model is not None:
            continue
        if spec.batch_fn is not None:
            parts.append(_from_batch(df, spec))
        else:
            raise ValueError(f"model {spec.name} has nothing to run")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def result_lines(results: DataFrame) -> DataFrame:
    """One printable line per (row, model). A generator without a score
    prints ``None``."""
    score_text = F.coalesce(F.col("score").cast("string"), F.lit("None"))
    line = (F.when(F.col("error").isNotNull(), F.concat(F.col("model"), F.lit(": Error - "), F.col("error")))
             .when(F.col("label").isNotNull(),
                   F.concat(F.col("model"), F.lit(": "), F.col("label"), F.lit(" (Confidence: "),
                            F.format_string("%.4f", F.col("score")), F.lit(")")))
             .when(F.col("generated_text").isNotNull(),
                   F.concat(F.col("model"), F.lit(": Generated Text - "), F.col("generated_text"),
                            F.lit(" (Score: "), score_text, F.lit(")")))
             .otherwise(F.concat(F.col("model"), F.lit(": "), F.coalesce(F.col("output"), F.lit("")))))
    return results.select("row_id", "model", line.alias("line"))
