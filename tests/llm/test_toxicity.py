import zlib

import pytest
from edge import edge_docs, empty_docs
from pyspark.sql import functions as F

from skein.llm import toxicity as T
from skein.llm.queries import QUERIES
from skein.sources.tables import read_table

SF = "/root/testdata/sf0.1"


def auc(rows):
    """Share of (toxic, other) pairs in the right order, ties half."""
    ranked = sorted(s for s, _ in rows)
    import bisect
    bad, good = [s for s, y in rows if y], sorted(s for s, y in rows if not y)
    assert ranked and bad and good
    return sum(bisect.bisect_left(good, s) + bisect.bisect_right(good, s) for s in bad) / 2 / len(bad) / len(good)


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op7_toxicity"](spark, SF).collect()


def test_held_out_accuracy(spark, scored):
    labels = {r["doc_id"]: r["toxic"] for r in read_table(spark, SF, "labels").collect()}
    assert len(scored) == read_table(spark, SF, "documents").count()
    for r in scored:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    held = [(r["score"], labels[r["doc_id"]], r["predicted"]) for r in scored if r["held_out"] and r["doc_id"] in labels]
    assert auc([x[:2] for x in held]) > 0.97
    hits = sum(p for _, y, p in held if y)
    assert hits >= 0.9 * sum(y for _, y, _ in held) and sum(p for _, y, p in held if not y) <= 0.01 * len(held)


def test_held_out_labels_are_not_used(spark):
    small = "/root/testdata/sf0.01"
    docs, labels = read_table(spark, small, "documents", "doc_id", "text"), read_table(spark, small, "labels", "doc_id", "toxic")
    turned = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in T.held_out_scores(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_features():
    s = T.Scanner({"idiot": 5.0, "veju*": 3.0, "scum": 2.5})
    f = lambda text: dict(zip(T.FEATURES, s.features(text)))
    x = f("You are an IDIOT, vejuxyz! and 1d10t sc*m id.iot")
    assert x["lexicon_count"] > 0 and x["stem_count"] > 0 and x["near_second_person"] > 0 and x["hidden_count"] > 0 and x["disguised_words"] > 0
    assert f("i d i o t")["hidden_count"] > 0 and f("iiidiot")["stretched_words"] > 0 and f("idiooot")["hidden_count"] > 0
    assert f("")["words"] == 0 and f("  ")["lexicon_density"] == 0
    assert f("you are kind")["near_second_person"] == 0 and f("you are kind")["second_person_density"] > 0


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 0), (8, None), (None, 1), (7, 0), (7, 0)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    rows = T.score(docs, model).collect()
    assert len(rows) == 13 and all(0 <= r["score"] <= 1 for r in rows)
    kept = T.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    none = T.fit(docs, labels.where("toxic = 9"))
    assert {r["score"] for r in T.score(docs, none).collect()} == {0.0}
    assert {r["score"] for r in T.score(docs, T.fit(docs, labels.where("toxic = 1"))).collect()} == {1.0}
    assert T.score(empty_docs(spark), model).count() == 0 and T.keep_clean(empty_docs(spark), labels).count() == 0
