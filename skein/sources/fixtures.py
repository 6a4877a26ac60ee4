"""Deterministic inputs derived from the driver's tables (see FIXTURES.md).

Every derivation is plain relational work on ``documents``, ``labels``,
``embeddings`` and ``conversations`` so that its size grows with theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.ordering import with_row_index
from skein.functions.text import sentence_pattern
from skein.sources.tables import read_table

# The ten graph prompts of FIXTURES.md, in id order.
PROMPTS = [
    (1, "with by ionreat"),
    (2, "doc12"),
    (3, "src6"),
    (4, "src13"),
    (5, "the eringing"),
    (6, "les eauxmentre"),
    (7, "und enstöung"),
    (8, "self notes"),
    (9, "doc30"),
    (10, "zzzzqqq"),
]

# Node labels by doc_id % 4 (3 = missing).
DOC_LABELS = {0: "person", 1: "organization", 2: "event"}

# Literal texts added to the sentence input, ids -1..-3.
SENTENCE_EXTRA = [(-1, ""), (-2, "..."), (-3, "This is a test. This is another test.")]


# Evaluation scores: sums of this many consecutive embedding values.
SCORE_BLOCKS = 4


def _doc_id_str(c) -> F.Column:
    return F.concat(F.lit("doc"), c.cast("string"))


def _docs_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    name_id = F.when((F.col("doc_id") % 31 == 0) & (F.col("doc_id") > 60),
                     F.col("doc_id") - 60).otherwise(F.col("doc_id"))
    return d.withColumn("node_id", _doc_id_str(F.col("doc_id"))) \
            .withColumn("name", _doc_id_str(name_id))


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nodes(node_id, name, labeled, description, metadata): documents, sources
    and, as nodes without any edge, benchmark items."""
    d = _docs_named(spark, sf_dir)
    labeled = F.when(F.col("doc_id") % 4 == 0, F.lit(DOC_LABELS[0])) \
               .when(F.col("doc_id") % 4 == 1, F.lit(DOC_LABELS[1])) \
               .when(F.col("doc_id") % 4 == 2, F.lit(DOC_LABELS[2]))
    doc_nodes = d.select(
        "node_id", "name", labeled.alias("labeled"),
        F.col("text").alias("description"),  # the whole text
        F.when(F.col("doc_id") % 3 == 0, F.concat_ws(", ", "source", "lang")).alias("metadata"))
    src_nodes = (d.groupBy("source")
                  .agg(F.array_join(F.sort_array(F.collect_set("lang")), " ").alias("langs"))
                  .select(F.concat(F.lit("src:"), "source").alias("node_id"),
                          F.col("source").alias("name"),
                          F.lit("place").alias("labeled"),
                          F.concat_ws(" ", "source", "langs").alias("description"),
                          F.lit(None).cast("string").alias("metadata")))
    item_id = F.concat(F.lit("item"), F.col("item_id").cast("string"))
    item_nodes = read_table(spark, sf_dir, "benchmark", "item_id", "text").select(
        item_id.alias("node_id"), item_id.alias("name"), F.lit("event").alias("labeled"),
        F.col("text").alias("description"), F.lit(None).cast("string").alias("metadata"))
    return doc_nodes.unionByName(src_nodes).unionByName(item_nodes)


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """edges(edge_id, src_id, dst_id, rel_type, description), directed."""
    d = _docs_named(spark, sf_dir)
    src_node = F.concat(F.lit("src:"), F.col("source"))
    published = d.select(F.concat(F.lit("pub:"), F.col("doc_id").cast("string")).alias("edge_id"),
                         F.col("node_id").alias("src_id"), src_node.alias("dst_id"),
                         F.lit("published_in").alias("rel_type"),
                         F.concat_ws(" published in ", "name", "source").alias("description"))
    # "next document of the same source": number documents per source with the
    # range-partitioned index (no single-task window per source), then an
    # equi-join of position i with position i + 1, all on thin rows; the text
    # is joined to the finished pairs.
    ordered = with_row_index(d.select("doc_id", "source", "node_id"),
                             order_by=["doc_id"], group_by=["source"], name="pos")
    nxt = ordered.select("source", (F.col("pos") - 1).alias("pos"),
                         F.col("node_id").alias("next_node"))
    pairs = ordered.join(nxt, on=["source", "pos"], how="inner").select("doc_id", "node_id", "next_node")
    follows = (pairs.join(d.select("doc_id", "text"), "doc_id")
                      .select(F.concat(F.lit("fol:"), F.col("doc_id").cast("string")).alias("edge_id"),
                              F.col("node_id").alias("src_id"), F.col("next_node").alias("dst_id"),
                              F.lit("follows").alias("rel_type"),
                              F.col("text").alias("description")))  # the whole text
    cites = (d.where(F.col("doc_id") % 10 == 0)
              .select(F.concat(F.lit("cit:"), F.col("doc_id").cast("string")).alias("edge_id"),
                      F.col("node_id").alias("src_id"), src_node.alias("dst_id"),
                      F.lit("cites").alias("rel_type"),
                      F.concat_ws(" cites ", "name", "source").alias("description")))
    mentions = (d.where(F.col("doc_id") % 97 == 0)
                 .select(F.concat(F.lit("men:"), F.col("doc_id").cast("string")).alias("edge_id"),
                         F.col("node_id").alias("src_id"), F.col("node_id").alias("dst_id"),
                         F.lit("mentions").alias("rel_type"),
                         F.concat(F.lit("self note "), F.col("doc_id").cast("string")).alias("description")))
    return published.unionByName(follows).unionByName(cites).unionByName(mentions)


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q: prompt_id LONG, prompt STRING: the benchmark items' texts (ids from
    1000) and the ten literal prompts, which reach the edge cases."""
    items = read_table(spark, sf_dir, "benchmark", "item_id", "text")
    literal = spark.createDataFrame(PROMPTS, "prompt_id long, prompt string")
    return literal.unionByName(items.select((F.col("item_id") + 1000).alias("prompt_id"), F.col("text").alias("prompt")))


def turn_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``prompts`` and the first user turn of every conversation (ids from 1e9)."""
    turns = conversation_prompts(spark, sf_dir).select((F.col("conv_id") + 1_000_000_000).alias("prompt_id"), "prompt")
    return prompts(spark, sf_dir).unionByName(turns)


def prompt_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q with a vector: prompt i carries the embedding with ``vec_id`` i (none: NULL)."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    q = prompts(spark, sf_dir).withColumn("vec_id", F.when(F.col("prompt_id") >= 1000, F.col("prompt_id") - 1000)
                                          .otherwise(F.col("prompt_id") + 100))
    return q.join(e, "vec_id", "left").select("prompt_id", "prompt", F.col("embedding").alias("dense_vector"))


# ---------------------------------------------------------------- vectors (V)

def chunk_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V without sparse weights: pk, text, path, context, metadata, dense_vector."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return (d.join(e, d.doc_id == e.vec_id, "left")
             .select(F.col("doc_id").alias("pk"), "text",
                     F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string")).alias("path"),
                     F.concat_ws(" ", "source", "lang", F.lit("document"),
                                 F.col("doc_id").cast("string")).alias("context"),
                     F.concat_ws(", ", "source", "lang").alias("metadata"),
                     F.col("embedding").alias("dense_vector")))


def vector_query_ids(collection: DataFrame) -> DataFrame:
    """Query rows of V (a batch standing in for prompts): every chunk whose key
    is divisible by 100 and that has a vector, so the batch grows with the
    collection."""
    return (collection.where((F.col("pk") % 100 == 0) & F.col("dense_vector").isNotNull())
                      .select(F.col("pk").alias("query_id"), "text", "dense_vector"))


# -------------------------------------------------------------- sentences (S)

def sentence_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S: documents(doc_id, text) plus three literal edge-case rows."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    extra = spark.createDataFrame(SENTENCE_EXTRA, "doc_id long, text string")
    return d.unionByName(extra)


def conversation_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: prompt = text of the first user turn."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return (c.where(F.col("role") == "user")
             .groupBy("conv_id")
             .agg(F.min_by("text", "turn").alias("prompt")))


def conversation_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant texts per conversation: conv_id, turn, text."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return c.where(F.col("role") == "assistant").select("conv_id", "turn", "text")


# ------------------------------------------------------------ training (P, E)

def training_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: row_id, prompt, sentence, label (raw, dirty) from labels ⋈ documents:
    one row per sentence of every labelled document. ``row_id`` = doc_id * 1e9
    + position (a text of at most 2^31 bytes has fewer sentences than 1e9)."""
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality")
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "source")
    j = lab.join(d, "doc_id", "inner")
    i = F.col("doc_id")
    base = F.when(F.col("quality") == 1, F.lit("necessary")).otherwise(F.lit("unnecessary"))
    styled = F.when(F.col("quality") == 1, F.lit(" Necessary ")).otherwise(F.lit(" Unnecessary "))
    label = (F.when(i % 19 == 0, F.lit(None).cast("string"))
              .when(i % 11 == 0, F.lit("maybe"))
              .when(i % 5 == 0, styled)
              .otherwise(base))
    j = j.select("doc_id", "quality", "source", F.posexplode_outer(F.regexp_extract_all("text", F.lit(sentence_pattern()), 0)).alias("pos", "s"))
    return j.select(
        (i * 1_000_000_000 + F.coalesce("pos", F.lit(0))).alias("row_id"),
        F.when(i % 17 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("Is this passage from "), F.col("source"), F.lit(" useful?")))
         .alias("prompt"),
        F.when(i % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("s")).alias("sentence"),
        label.alias("label"))


def multiclass_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiclass training table: row_id, text, label = language."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return d.select(F.col("doc_id").alias("row_id"), "text", F.col("lang").alias("label"))


def eval_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E binary: row_id, label = quality, prediction = 1 - toxic."""
    lab = read_table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return lab.select(F.col("doc_id").alias("row_id"), F.col("quality").alias("label"),
                      (F.lit(1) - F.col("toxic")).alias("prediction"))


def eval_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E multiclass: row_id, label = label % 4, scores = sums over four equal
    blocks of all embedding values, rounded to 6 places."""
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    width = (F.size("embedding") / SCORE_BLOCKS).cast("int")

    def block(k: int):
        part = F.slice("embedding", F.lit(k) * width + 1, width)
        return F.round(F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x.cast("double")), 6)

    return e.select(F.col("vec_id").alias("row_id"), (F.col("label") % 4).alias("label"),
                    F.array(*[block(k) for k in range(SCORE_BLOCKS)]).alias("scores"))
