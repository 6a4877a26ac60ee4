"""Rows that every operator has to bear."""
from pyspark.sql import functions as F

from skein.sources.tables import read_table

LONG = " ".join(f"word{i % 977} x{i}" for i in range(20_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "a", 1),
    (2, "the QUICK brown fox jumps over the lazy dog near the river bank today.", "en", "a", 2),
    (3, None, "en", None, None),
    (4, "", None, "a", 0),
    (5, " \t\n ", "fr", "a", 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "word", "en", "a", 4),
    (7, "word", "en", "a", 4),
    (7, "another text with the same id", "de", "b", 1),
    (None, "a text without an id and with some words", "en", "a", 3),
    (None, None, None, None, None),
    (8, "Ünïcödé ▁ text  with　wide  spaces \u0000 and 😀 emoji<s>", "de", "b", 9),
    (9, "MIT License.  All rights reserved.\nLicensed under CC BY-NC 4.0.", "en", "b", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators add themselves.
CLASH = ["fp", "key", "size", "shard", "slot", "component_id", "score", "root", "block", "features", "perplexity", "__row"]


def edge_docs(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    for name in CLASH:
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(spark, sf_dir, table="documents", key="doc_id", value="text"):
    """{key: value} of a whole table on the driver (tests only)."""
    return {r[0]: r[1] for r in read_table(spark, sf_dir, table, key, value).collect()}
