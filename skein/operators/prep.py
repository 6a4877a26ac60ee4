"""Training-data preparation.

Random steps of the reference (oversampling, the stratified split) are
replaced by md5 ranking, so results do not depend on partitioning or on the
number of executors. Global numbering uses the range-partitioned index of
``skein.functions.ordering`` instead of single-task windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.ordering import with_row_index
from skein.functions.text import SEP_MARK, md5_bucket, pair_text, py_strip, terms
from skein.session import cut_lineage, write_table

# Label mapping of the binary trainer, pandas' text for a missing value.
FIXED_LABELS = {"unnecessary": 0, "necessary": 1}
MISSING_TEXT = "nan"
SEED = 42
TEST_SIZE = 0.2
PAD_ID, UNK_ID = 0, 1


# ---------------------------------------------------------------- E1 - E4

def input_text_keep(df: DataFrame) -> DataFrame:
    """Missing prompt/sentence become the word 'nan'; every row stays."""
    return df.withColumn("input_text", F.concat(F.coalesce("prompt", F.lit(MISSING_TEXT)),
                                                F.lit(SEP_MARK),
                                                F.coalesce("sentence", F.lit(MISSING_TEXT))))


def input_text_drop(df: DataFrame) -> DataFrame:
    """NULL propagates into input_text; rows missing it or the label go."""
    return df.withColumn("input_text", pair_text("prompt", "sentence")) \
             .dropna(subset=["input_text", "label"])


def drop_report(df: DataFrame) -> DataFrame:
    """E2 counts in one pass: input, dropped, remaining."""
    ok = F.concat(F.col("prompt"), F.lit(SEP_MARK), F.col("sentence")).isNotNull() & F.col("label").isNotNull()
    return df.agg(F.count(F.lit(1)).alias("n_input"),
                  F.count_if(~ok).alias("n_dropped"),
                  F.count_if(ok).alias("n_remaining"))


def clean_label(c) -> F.Column:
    """Str -> strip -> lower (a missing label reads 'nan' as in pandas)."""
    col = c if isinstance(c, F.Column) else F.col(c)
    return F.lower(py_strip(F.coalesce(col.cast("string"), F.lit(MISSING_TEXT))))


def map_fixed_labels(df: DataFrame, mapping: dict | None = None) -> DataFrame:
    """Clean, map to ids, drop unmapped rows; ``label`` becomes INT."""
    mapping = FIXED_LABELS if mapping is None else mapping
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(v))])
    return (df.withColumn("label", F.try_element_at(m, clean_label("label")).cast("int"))
              .dropna(subset=["label"]))


# ---------------------------------------------------------------- E5 - E7

# Classes up to which a per-class table is broadcast and numbered in one task;
# free-text labels beyond it take the shuffled way.
MAX_CLASSES = 100_000


def per_class(table: DataFrame) -> DataFrame:
    """A table of one row per class, marked for broadcast if its count allows it."""
    return F.broadcast(table) if table.limit(MAX_CLASSES + 1).count() <= MAX_CLASSES else table


def label_table(df: DataFrame, label_col: str = "label") -> DataFrame:
    """E5: (label, label_id) for the sorted distinct labels (a tiny table)."""
    d = df.select(F.col(label_col).alias("label")).distinct()
    return with_row_index(d, ["label"], "label_id").withColumn("label_id", F.col("label_id").cast("int"))


def encode_labels(df: DataFrame, label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """Adds ``label_id``; returns (encoded rows, label table for decoding)."""
    table = label_table(df, label_col)
    return df.join(per_class(table.withColumnRenamed("label", label_col)), label_col, "inner"), table


def class_counts(df: DataFrame, label_col: str = "label_id") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))


def majority_class(df: DataFrame, label_col: str = "label_id") -> DataFrame:
    """One row: the most frequent class; a tie goes to the smallest class id."""
    counts = class_counts(df, label_col)
    return counts.agg(F.max_by(label_col, F.struct(F.col("n"), -F.col(label_col))).alias("majority"))


def majority_split(df: DataFrame, label_col: str = "label_id") -> DataFrame:
    """Adds ``part`` = 'majority' for the top class, 'rest' for all others."""
    maj = majority_class(df, label_col).first()["majority"]  # one class id
    return df.withColumn("part", F.when(F.col(label_col) == F.lit(maj), F.lit("majority"))
                         .otherwise(F.lit("rest")))


# ---------------------------------------------------------------------- E8

def oversample(df: DataFrame, label_col: str = "label_id", id_col: str = "row_id",
               seed: int = SEED) -> DataFrame:
    """The pooled rest, drawn with replacement up to the majority size, is
    appended to the majority. Draw i picks rest row ``md5(seed:i) mod n_rest``
    in ``id_col`` order. Adds ``copy_id`` (-1 for majority rows)."""
    spark = df.sparkSession
    # All counting and numbering runs on ids and classes, written once; the rows themselves are
    # read once and meet the finished draws.
    thin = write_table(df.select(label_col, id_col), "oversample")
    parts = majority_split(thin, label_col)
    maj = F.lit(majority_class(thin, label_col).first()["majority"])
    sizes = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}  # two row counts
    n_major, n_rest = sizes.get("majority", 0), sizes.get("rest", 0)
    major = df.where(F.col(label_col) == maj).withColumn("copy_id", F.lit(-1).cast("long"))
    if n_rest == 0:
        return major
    rest = with_row_index(parts.where(F.col("part") == "rest").select(id_col), [id_col], "_ridx")
    picks = spark.range(n_major).select(
        F.col("id").alias("copy_id"),
        (md5_bucket(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 15) % F.lit(n_rest))
        .alias("_ridx"))
    drawn = picks.join(rest, "_ridx", "inner").select(id_col, "copy_id")
    return major.unionByName(df.where(F.col(label_col) != maj).join(drawn, id_col, "inner"))


# ---------------------------------------------------------------------- E9

def split_quotas(df: DataFrame, label_col: str = "label_id", test_size: float = TEST_SIZE) -> DataFrame:
    """Per class: n and the exact number of test rows.

    Total test rows = ceil(test_size · N); each class gets floor(test_size · n),
    the rest go one each to the classes with the largest remainders (ties: by
    class). Decimal arithmetic keeps the quotas exact.
    """
    frac = F.lit(str(test_size)).cast("decimal(20,10)")
    # The class table has one row per class: windows over all of it are cheap.
    w_all = Window.partitionBy(F.lit(0))
    c = class_counts(df, label_col).withColumn("n_total", F.sum("n").over(w_all))
    c = c.withColumn("exact", F.col("n").cast("decimal(30,10)") * frac) \
         .withColumn("base", F.floor("exact").cast("long")) \
         .withColumn("rem", F.col("exact") - F.col("base")) \
         .withColumn("n_test_total", F.ceil(F.col("n_total").cast("decimal(30,10)") * frac).cast("long"))
    order = Window.orderBy(F.desc("rem"), F.asc(label_col))  # a handful of classes
    c = c.withColumn("left", F.col("n_test_total") - F.sum("base").over(w_all)) \
         .withColumn("rrank", F.row_number().over(order))
    return c.select(label_col, "n", (F.col("base") + F.when(F.col("rrank") <= F.col("left"), 1).otherwise(0))
                    .cast("long").alias("n_test"))


# Rows of a class's boundary bucket that are ranked by a window.
MAX_BUCKET = 50_000
# Hex digits by which a refinement lengthens the key prefix: 4096 buckets each.
PREFIX_DIGITS = 3


def quota_cutoffs(keys: DataFrame, quotas: DataFrame, label_col: str = "label_id", id_col: str = "row_id", max_bucket: int = MAX_BUCKET) -> DataFrame:
    """(label, cut_key, cut_id): the last row that is within its class's quota, in the order of
    ``_key``, then id. Classes with quota 0 have no row.

    A distributed selection instead of a sort: the keys of a class are counted by a prefix, the
    running count finds the bucket that holds the boundary, and that bucket alone is counted by a
    longer prefix, until it is small enough to rank. Each pass reads thin rows and moves one
    partial count per bucket; a class with a third of all rows is as cheap as any other."""
    bound = quotas.where(F.col("n_test") > 0).select(label_col, F.lit("").alias("_prefix"), F.col("n_test").alias("_left"))
    digits = 0
    while True:
        inside = keys.join(per_class(bound), [F.col(label_col) == F.col("_label"), F.substring("_key", 1, digits) == F.col("_prefix")]) if digits else \
            keys.join(per_class(bound.drop("_prefix").withColumnRenamed(label_col, "_label")), F.col(label_col) == F.col("_label"))
        if digits and (largest <= max_bucket or digits >= 32):
            break
        digits += PREFIX_DIGITS
        counts = inside.groupBy(label_col, F.substring("_key", 1, digits).alias("_prefix"), "_left").agg(F.count(F.lit(1)).alias("_n"))
        running = F.sum("_n").over(Window.partitionBy(label_col).orderBy("_prefix"))
        at = counts.withColumn("_upto", running).where((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left")))
        bound = cut_lineage(at.select(F.col(label_col).alias("_label"), "_prefix", (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"), "_n"))
        largest = bound.agg(F.max("_n")).first()[0] or 0  # one number
    rank = F.row_number().over(Window.partitionBy(label_col).orderBy("_key", id_col))
    last = inside.withColumn("_rank", rank).where(F.col("_rank") == F.col("_left"))
    return last.select(label_col, F.col("_key").alias("cut_key"), F.col(id_col).alias("cut_id"))


def stratified_split(df: DataFrame, label_col: str = "label_id", id_col: str = "row_id",
                     test_size: float = TEST_SIZE, seed: int = SEED,
                     check_min_class: bool = True) -> DataFrame:
    """Adds ``split`` ('train'/'test') with exact per-class test quotas.

    Within a class rows are ranked by md5(seed:id) then id (unique); the first ``n_test`` go to
    test. The quota boundary of each class is selected on thin rows, and the rows themselves only
    compare their own key with it: no row is sorted or moved. As in the reference, a class with
    fewer than two rows is an error unless ``check_min_class`` is off (then such a class is split
    by the same quota rule).
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    thin = write_table(df.select(label_col, id_col), "split-keys")
    if check_min_class:
        small = class_counts(thin, label_col).where(F.col("n") < 2).limit(1).collect()  # <= 1 row
        if small:
            raise ValueError(f"class {small[0][label_col]!r} has only {small[0]['n']} row; "
                             "a stratified split needs at least 2 per class")
    quotas = cut_lineage(split_quotas(thin, label_col, test_size).select(label_col, "n_test"))
    cutoffs = cut_lineage(quota_cutoffs(thin.withColumn("_key", key), quotas, label_col, id_col))
    marked = df.withColumn("_key", key).join(per_class(cutoffs), label_col, "left")
    within = (F.col("_key") < F.col("cut_key")) | ((F.col("_key") == F.col("cut_key")) & (F.col(id_col) <= F.col("cut_id")))
    return marked.withColumn("split", F.when(within, F.lit("test")).otherwise(F.lit("train"))).drop("_key", "cut_key", "cut_id")


def balance_and_split(df: DataFrame, order: str = "split_then_balance", label_col: str = "label_id",
                      id_col: str = "row_id", test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """E8 + E9 in either order; adds ``split``.

    ``split_then_balance`` (default) oversamples the training part only, so no
    copy of a row lands on both sides. ``balance_then_split`` is the
    reference's order: copies of one row can appear in train and test.
    """
    if order == "split_then_balance":
        split = stratified_split(df, label_col, id_col, test_size, seed)
        train = oversample(split.where(F.col("split") == "train").drop("split"), label_col, id_col, seed)
        test = split.where(F.col("split") == "test").drop("split").withColumn("copy_id", F.lit(-1).cast("long"))
        return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    if order == "balance_then_split":
        bal = oversample(df, label_col, id_col, seed)
        # copies need their own id for the ranking; keep the original id too
        key = F.concat_ws(":", F.col(id_col).cast("string"), F.col("copy_id").cast("string"))
        bal = bal.withColumn("_sid", key)
        out = stratified_split(bal, label_col, "_sid", test_size, seed)
        return out.drop("_sid")
    raise ValueError(f"unknown order {order!r}")


# --------------------------------------------------------------------- E10

def class_weights(train: DataFrame, label_col: str = "label_id") -> DataFrame:
    """(label, n, weight = 1 / n) from the training part."""
    return class_counts(train, label_col).withColumn("weight", F.lit(1.0) / F.col("n"))


def with_class_weights(train: DataFrame, label_col: str = "label_id") -> DataFrame:
    w = per_class(cut_lineage(class_weights(train, label_col).select(label_col, "weight")))
    return train.join(w, label_col, "inner")


# ------------------------------------------------------------- E11 - E12

# Terms up to which the vocabulary is broadcast (some 100 bytes a row).
MAX_VOCABULARY = 500_000


def build_vocabulary(df: DataFrame, text_col: str = "input_text") -> DataFrame:
    """(term, token_id): ids from 2 by frequency desc, then term (0 pad, 1 unknown)."""
    counts = df.select(F.explode(terms(text_col)).alias("term")).groupBy("term").count()
    idx = with_row_index(counts, [F.desc("count"), F.asc("term")], "_v")
    return idx.select("term", (F.col("_v") + 2).cast("int").alias("token_id"))


def encode_fixed_length(df: DataFrame, vocab: DataFrame, id_col: str = "row_id",
                        text_col: str = "input_text", max_length: int = 128) -> DataFrame:
    """(id, input_ids, attention_mask), truncated / padded to ``max_length``.

    Only the first ``max_length`` terms of a row are looked up (the array is cut
    before it is exploded), so long texts cost no more than short ones.
    """
    toks = df.select(id_col, F.posexplode_outer(F.slice(terms(text_col), 1, max_length)).alias("pos", "term"))
    if vocab.limit(MAX_VOCABULARY + 1).count() <= MAX_VOCABULARY:
        vocab = F.broadcast(vocab)  # checked: no occurrence moves before its id is known
    ids = toks.join(vocab, "term", "left").select(
        id_col, F.when(F.col("term").isNotNull(), F.struct("pos", F.coalesce("token_id", F.lit(UNK_ID)).alias("tid"))).alias("at"))
    per_row = ids.groupBy(id_col).agg(F.transform(F.sort_array(F.collect_list("at")), lambda x: x["tid"]).alias("ids"))
    pad = F.array_repeat(F.lit(PAD_ID), max_length)
    return per_row.select(
        id_col,
        F.slice(F.concat("ids", pad), 1, max_length).alias("input_ids"),
        F.slice(F.concat(F.array_repeat(F.lit(1), F.size("ids")), F.array_repeat(F.lit(0), max_length)),
                1, max_length).alias("attention_mask"))


def training_columns(encoded: DataFrame, labels: DataFrame, id_col: str = "row_id",
                     label_col: str = "label_id") -> DataFrame:
    """Keep only input_ids, attention_mask and ``labels``."""
    return encoded.join(labels.select(id_col, F.col(label_col).alias("labels")), id_col, "inner") \
                  .select(id_col, "input_ids", "attention_mask", "labels")
