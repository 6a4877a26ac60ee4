"""Model fitting and prediction with Spark ML.

The reference fine-tunes neural classifiers on one machine; here the same data path
ends in a distributed linear model over hashed tf-idf text features. The class
weights of the reference's weighted loss become ``weightCol`` (Spark divides
by the weight sum, as a weighted mean loss does); ``weight_decay`` becomes
``regParam``. The label mapping travels inside the fitted pipeline
(``IndexToString``), so saved models decode their own predictions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.session import write_table

# Fixed values of the text features.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
NUM_FEATURES = 1 << 16
REG_PARAM = 0.01
MAX_ITER = 50
# Fits that run at the same time.
PARALLEL_FITS = 3


def text_classifier(labels: list[str], text_col: str = "text", label_col: str = "label_id",
                    weight_col: str | None = None, reg_param: float = REG_PARAM,
                    max_iter: int = MAX_ITER, family: str = "auto") -> Pipeline:
    """Tokenise -> hashed tf -> idf -> logistic regression -> label name."""
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, regParam=reg_param,
                            maxIter=max_iter, family=family)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="tokens", pattern=TOKEN_SPLIT, toLowercase=True),
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=NUM_FEATURES),
        IDF(inputCol="tf", outputCol="features"),
        lr,
        IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels),
    ])


def fit(train: DataFrame, labels: list[str], **kw) -> PipelineModel:
    """F1 (with ``weight_col``) / F2 (``family='multinomial'``).

    The terms of the training texts are counted and written once: the idf, the regression's
    summary and its blocks are a pass each, and cut no text again."""
    *text_stages, idf, regression, decode = text_classifier(labels, **kw).getStages()
    counting = Pipeline(stages=text_stages).fit(train)  # neither stage learns: no pass
    columns = [regression.getLabelCol(), *([kw["weight_col"]] if kw.get("weight_col") else [])]
    counted = write_table(counting.transform(train).select(*columns, idf.getInputCol()), "training-terms")
    weights = idf.fit(counted)
    return PipelineModel(stages=[*counting.stages, weights, regression.fit(weights.transform(counted)), decode])


def predict_table(model: PipelineModel, df: DataFrame, id_col: str = "row_id",
                  label_col: str = "label_id") -> DataFrame:
    """(id, label, prediction, predicted_label, p_max)."""
    out = model.transform(df)
    return out.select(id_col, label_col, F.col("prediction").cast("int").alias("prediction"),
                      "predicted_label",
                      F.array_max(vector_to_array("probability")).alias("p_max"))


def save(model: PipelineModel, path: str, timestamped: bool = False) -> str:
    """Write (overwrite) to a shared folder; with ``timestamped`` into a
    new ``model_<UTC time>`` folder under ``path``. Returns the folder."""
    if timestamped:
        import datetime
        stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y%m%d_%H%M%S")
        path = f"{path.rstrip('/')}/model_{stamp}"
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def fit_settings(train: DataFrame, labels: list[str], grid: list[dict], **kw) -> list[PipelineModel]:
    """One fitted pipeline per setting (arguments of ``text_classifier`` for the regression).

    The text stages do not depend on the settings: they are fitted once and the training vectors
    are written once, so texts are read once however many settings there are. The fits, each a
    distributed job of its own, run from ``PARALLEL_FITS`` threads over the vector table."""
    stages = text_classifier(labels, **kw).getStages()
    text_stages, regression, decode = stages[:-2], stages[-2], stages[-1]
    features = Pipeline(stages=text_stages).fit(train)
    columns = [regression.getLabelCol(), "features", *([kw["weight_col"]] if kw.get("weight_col") else [])]
    vectors = write_table(features.transform(train).select(*columns), "training-vectors")

    def one(params: dict) -> PipelineModel:
        own = text_classifier(labels, **{**kw, **params}).getStages()[-2]
        return PipelineModel(stages=[*features.stages, own.fit(vectors), decode])

    with ThreadPoolExecutor(PARALLEL_FITS) as pool:
        return list(pool.map(one, grid))


def select_best(train: DataFrame, valid: DataFrame, labels: list[str], grid: list[dict],
                metric_fn, metric: str, **kw):
    """fit one model per setting, keep the one with the greatest metric
    (the first wins ties): (all values, index of the best, its model). Training and validation
    texts are turned into vectors once (``fit_settings``)."""
    models = fit_settings(train, labels, grid, **kw)
    held = write_table(PipelineModel(models[0].stages[:-2]).transform(valid).drop("tokens", "tf"), "validation-vectors")
    values = [metric_fn(PipelineModel(m.stages[-2:]).transform(held)).first()[metric] for m in models]
    best = max(range(len(grid)), key=lambda i: (values[i], -i))
    return values, best, models[best]
