"""Model keys (rows-only in the driver check) and their invariants."""

import pytest
from pyspark.sql import functions as F

from skein.plans.oracle import ORACLE
from skein.plans.registry import QUERIES

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_keys_run(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.count() >= 0
    assert len(df.columns) > 0
    for f in df.schema.fields:
        assert f.dataType.simpleString() in ("string", "int", "bigint", "double", "boolean"), f


def test_model_roundtrip_equal_predictions(spark, sf_dir):
    df = QUERIES["model_roundtrip"](spark, sf_dir)
    assert df.count() > 0
    assert df.where(~F.col("same")).count() == 0


def test_binary_metrics_in_range(spark, sf_dir):
    from skein.operators import metrics as mt
    from skein.operators import train as tr
    from skein.plans import queries_models as qm
    model, valid = qm._binary_model(spark, sf_dir)
    r = mt.binary_metrics(tr.predict_table(model, valid).withColumnRenamed("label_id", "label")).first()
    for c in ("accuracy", "precision", "recall", "f1"):
        assert 0.0 <= r[c] <= 1.0


def test_multiclass_beats_majority_baseline(spark):
    # Languages are easy to tell apart from words: the fitted model must beat
    # always answering the most frequent language.
    sf = "/root/testdata/sf0.01"
    rep = {r.class_name: r for r in QUERIES["fit_multiclass"](spark, sf).collect()}
    assert rep["accuracy"].beats_majority and rep["accuracy"].support == sum(r.support for k, r in rep.items() if k != "accuracy")


def test_load_report_and_score_with_saved_model(spark, tmp_path):
    from skein.operators import multimodel as mm
    from skein.operators import train as tr
    rows = [(i, "alpha beta" if i % 2 else "gamma delta", i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "row_id long, text string, label_id int")
    model = tr.fit(df, ["zero", "one"], reg_param=0.1)
    path = tr.save(model, str(tmp_path), timestamped=True)
    assert "/model_" in path
    specs, failed = mm.load_spark_models({"good": path, "missing": str(tmp_path / "nope")},
                                         {"good": {0: "zero", 1: "one"}})
    assert [s.name for s in specs] == ["good"] and set(failed) == {"missing"}
    expr = mm.ModelSpec("len", mm.CLASSIFY, expr=lambda t: F.struct(
        (F.length(t) % 2).cast("string").alias("label"), F.lit(1.0).alias("score")))
    out = mm.score_all(df.select("row_id", "text"), specs + [expr])
    assert out.count() == 60
    got = {r.row_id: r.label for r in out.where("model = 'good'").collect()}
    assert got[1] == "one" and got[0] == "zero"


def test_duplicated_row_equals_double_weight(spark):
    # The class-weighted loss: a row counted twice equals the row with weight 2
    # (checked on fixed features; the idf stage itself is fitted on rows).
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense([float(i % 3), float(i % 5), 1.0]), float(i % 2)) for i in range(40)]
    base = spark.createDataFrame(rows, ["row_id", "features", "label"])
    dup = base.unionByName(base.where("row_id = 3")).withColumn("weight", F.lit(1.0))
    wtd = base.withColumn("weight", F.when(F.col("row_id") == 3, 2.0).otherwise(1.0))
    lr = LogisticRegression(weightCol="weight", regParam=0.1, tol=1e-10, maxIter=200)
    c1 = lr.fit(dup).coefficients.toArray()
    c2 = lr.fit(wtd).coefficients.toArray()
    assert abs(c1 - c2).max() < 1e-4


def test_settings_share_their_features(spark):
    """Each setting's model equals a fit of its own; the training texts are read once for all."""
    from pyspark.ml.functions import vector_to_array

    from skein.operators import metrics as mt
    from skein.operators import train as tr
    rows = [(i, ("alpha beta " if i % 2 else "gamma delta ") + f"w{i % 7}", i % 2) for i in range(60)]
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "row_id long, text string, label_id int")
    grid = [{"reg_param": 0.5}, {"reg_param": 0.01}, {"reg_param": 0.01, "max_iter": 3}, {"reg_param": 0.1}]
    models = tr.fit_settings(df.mapInArrow(counted, df.schema), ["zero", "one"], grid)
    assert reads.value == 2 * len(rows)  # once for the document frequencies, once for the vectors, whatever the grid
    for params, model in zip(grid, models):
        own = tr.fit(df, ["zero", "one"], **params)
        a, b = ({r.row_id: r.p for r in m.transform(df).select("row_id", vector_to_array("probability")[1].alias("p")).collect()} for m in (model, own))
        assert all(abs(a[i] - b[i]) < 1e-6 for i in b)
    values, best, model = tr.select_best(df, df, ["zero", "one"], grid, lambda p: mt.binary_metrics(p.withColumnRenamed("label_id", "label")), "f1")
    assert len(values) == 4 and best == values.index(max(values)) and "predicted_label" in model.transform(df).columns


def test_fitted_models_share_one_scan(spark):
    from skein.operators import multimodel as mm
    from skein.operators import train as tr
    from skein.session import write_table
    rows = [(i, "alpha beta" if i % 2 else "gamma delta", i % 2) for i in range(40)]
    df = write_table(spark.createDataFrame(rows, "row_id long, text string, label_id int"), "models")
    models = [*tr.fit_settings(df, ["zero", "one"], [{"reg_param": 0.1}, {"reg_param": 1.0}]), tr.fit(df, ["zero", "one"], max_iter=2)]
    specs = [mm.ModelSpec(f"m{i}", mm.CLASSIFY, spark_model=m, label_mapping={0: "zero", 1: "one"}) for i, m in enumerate(models)]
    out = mm.score_all(df.select("row_id", "text"), specs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and out.count() == 120
    assert {(r.row_id, r.label) for r in out.where("model = 'm2'").collect()} == {(i, "one" if y else "zero") for i, _, y in rows}


def test_training_texts_are_cut_once(spark, monkeypatch):
    """A fit and its passes read one written table of term counts, and equal the plain pipeline's fit."""
    from skein.operators import train as tr
    written = []
    keep = tr.write_table
    monkeypatch.setattr(tr, "write_table", lambda df, name: written.append(df.columns) or keep(df, name))
    rows = [(i, ("good fine day", "bad poor night", "odd thing")[i % 3] + f" w{i % 7}", float(i % 3)) for i in range(60)]
    train = spark.createDataFrame(rows, "row_id long, text string, label_id double")
    model = tr.fit(train, ["a", "b", "c"], family="multinomial")
    assert written == [["label_id", "tf"]]
    plain = tr.text_classifier(["a", "b", "c"], family="multinomial").fit(train)
    a, b = ({r.row_id: r for r in tr.predict_table(m, train).collect()} for m in (model, plain))
    assert [type(s) for s in model.stages] == [type(s) for s in plain.stages]
    assert a.keys() == b.keys() and all(a[i].predicted_label == b[i].predicted_label and abs(a[i].p_max - b[i].p_max) < 1e-6 for i in a)
