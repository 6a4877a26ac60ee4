"""Sentences: split, score, filter.

Sentence lists are kept in long form ``(id, pos, sentence)``; order inside a
list is the ``pos`` column, so nothing is regrouped per text unless a caller
asks for the joined text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import SENTENCE_DELIMITERS, pair_text, py_strip, split_sentences, terms

# Default classifier prompt and the label names by class id.
DEFAULT_PROMPT = "Is this sentence necessary for understanding the context?"
LABEL_NAMES = {0: "unnecessary", 1: "necessary"}
UNKNOWN = "unknown"
NECESSARY = "necessary"


def sentence_lists(df: DataFrame, text_col: str = "text", strip: bool = False,
                   delimiters: str = SENTENCE_DELIMITERS) -> DataFrame:
    """Adds ``sentences`` ARRAY<STRING> (stripped in batch mode)."""
    arr = split_sentences(F.col(text_col), delimiters)
    if strip:
        arr = F.transform(arr, py_strip)
    return df.withColumn("sentences", arr)


def split(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", strip: bool = False,
          delimiters: str = SENTENCE_DELIMITERS) -> DataFrame:
    """(id, pos, sentence) rows; empty text gives no row."""
    lists = sentence_lists(df.select(id_col, text_col), text_col, strip, delimiters)
    return lists.select(id_col, F.posexplode("sentences").alias("pos", "sentence"))


def label_decode(class_id, mapping: dict | None = None) -> F.Column:
    """Class id -> label name, ``unknown`` outside the mapping."""
    mapping = LABEL_NAMES if mapping is None else mapping
    m = F.create_map(*[x for k, v in sorted(mapping.items()) for x in (F.lit(k), F.lit(v))])
    cid = class_id if isinstance(class_id, F.Column) else F.col(class_id)
    return F.coalesce(F.try_element_at(m, cid.cast("int")), F.lit(UNKNOWN))


def rule_scorer(prompt, sentence, min_terms: int = 8) -> F.Column:
    """Fixed, SQL-expressible scorer (class id): 1 when the sentence shares a
    term with the prompt or has at least ``min_terms`` terms, else 0."""
    p = prompt if isinstance(prompt, F.Column) else F.col(prompt)
    s = sentence if isinstance(sentence, F.Column) else F.col(sentence)
    return scored_by_terms(terms(p), s, min_terms)


def scored_by_terms(prompt_terms: F.Column, sentence: F.Column, min_terms: int = 8) -> F.Column:
    """``rule_scorer`` for a prompt whose terms are already extracted."""
    st = terms(sentence)
    shared = F.arrays_overlap(st, prompt_terms)
    return F.when(shared | (F.size(st) >= min_terms), F.lit(1)).otherwise(F.lit(0))


def with_prompt(df: DataFrame, prompt_col: str | None = None) -> DataFrame:
    """Missing or empty prompt -> the default prompt."""
    p = F.col(prompt_col) if prompt_col else F.lit(None).cast("string")
    return df.withColumn("prompt", F.coalesce(F.nullif(p, F.lit("")), F.lit(DEFAULT_PROMPT)))


def predict_pairs(df: DataFrame, scorer=None, model=None, mapping: dict | None = None) -> DataFrame:
    """Label every (prompt, sentence) row.

    ``scorer`` is a Column function (prompt, sentence) -> class id; ``model``
    a fitted Spark ML model reading ``text`` and writing ``prediction``.
    """
    out = df.withColumn("text", pair_text("prompt", "sentence"))
    if model is not None:
        out = model.transform(out).withColumn("class_id", F.col("prediction").cast("int"))
        out = out.drop("prediction", "rawPrediction", "probability", "features", "tokens", "tf")
    else:
        out = out.withColumn("class_id", (scorer or rule_scorer)(F.col("prompt"), F.col("sentence")))
    return out.withColumn("label", F.when(F.col("class_id").isNull(), F.lit(None))
                          .otherwise(label_decode(F.col("class_id"), mapping)))


def keep_necessary(sentences: DataFrame, scorer=None, model=None) -> DataFrame:
    """Rows whose label is ``necessary``; rows that could not be scored
    (NULL label) are kept, as the reference keeps everything on failure."""
    scored = predict_pairs(sentences, scorer, model)
    return scored.where(F.col("label").isNull() | (F.col("label") == NECESSARY))


def check_pairing(prompts: DataFrame, lists: DataFrame, key: str) -> None:
    """D8 guard: every list needs a prompt and every prompt a list (which may
    be empty: ``lists`` has a row per list, not per sentence). One job."""
    both = (prompts.select(key).distinct().withColumn("_p", F.lit(1))
            .join(lists.select(key).distinct().withColumn("_l", F.lit(1)), key, "full"))
    row = both.agg(F.count_if(F.col("_p").isNull()).alias("no_prompt"), F.count_if(F.col("_l").isNull()).alias("no_list")).first()
    if row["no_prompt"] or row["no_list"]:
        raise ValueError(f"{row['no_prompt']} sentence lists without a prompt, {row['no_list']} prompts without a list")


def predict_nested(prompts: DataFrame, sentences: DataFrame, key: str, order_cols: list,
                   scorer=None, model=None, lists: DataFrame | None = None) -> DataFrame:
    """Per prompt its sentences with labels, in ``order_cols`` order.

    ``lists`` names the sentence lists by key (default: those with a sentence);
    a prompt with an empty list keeps one row with NULL sentence and label.
    """
    check_pairing(prompts, sentences if lists is None else lists, key)
    j = prompts.join(sentences, key, "left")
    scored = predict_pairs(j.where(F.col("sentence").isNotNull()), scorer, model)
    empty = j.where(F.col("sentence").isNull()).withColumn("label", F.lit(None).cast("string"))
    cols = [key, *order_cols, "sentence", "label"]
    return scored.select(*cols).unionByName(empty.select(*cols))
