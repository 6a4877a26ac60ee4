"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text (``FEATURES``): densities and counts of lexicon words and of word stems, of lexicon
words that only show after undoing an obfuscation, lexicon words near a second person, shares of
capitals, exclamation marks and other punctuation, rates of disguised and stretched words.

The lexicon is learned: words and word beginnings of 4 to 6 characters whose odds in toxic
documents are at least ``MIN_ODDS`` (logarithm) above those in others, by ``MIN_Z`` standard errors.
Rows that train the trees get their features from a lexicon learned without their fold, so that
the trees see features as they look on new texts. ``CALIBRATION`` of the ``FOLDS`` folds is kept from the trees and
fits the isotonic calibration.

Fitting uses at most ``FIT_ROWS`` labelled documents (chosen by a hash of their id, so the choice is
the same on any partitioning). Scoring is row-local over all documents. Without both labels among
the training rows every score is the share of label 1 (0 without rows); if the calibration
fold lacks a label the trees' own probabilities are the scores. Null and empty texts are texts
without words; repeated rows are scored each; a null doc_id counts as an empty id for its fold.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import give_back, held_out, pack, unpack, utf8
from skein.session import write_table

#: Labelled documents that a fit uses at most.
FIT_ROWS = 20_000
FOLDS, CALIBRATION = 4, 0
MIN_ODDS, MIN_Z, MIN_TOXIC = 2.0, 3.0, 3
STRONG = 4.0
NEAR = 5
PREDICTED = 0.7
FEATURES = ["lexicon_density", "lexicon_count", "strong_count", "lexicon_kinds", "stem_density", "stem_count", "hidden_count", "near_second_person",
            "second_person_density", "capitals", "capital_words", "exclamations", "punctuation", "disguised_words", "stretched_words", "words"]

# Second persons of English, German, French and Spanish.
SECOND_PERSON = {"you", "your", "yours", "yourself", "u", "du", "dich", "dir", "dein", "deine", "deiner", "ihr", "euch", "euer", "tu", "te", "toi", "ton", "ta",
                 "tes", "vous", "votre", "vos", "tú", "ti", "tus", "usted", "ustedes", "vosotros", "vuestro"}
# Characters that stand for letters.
STANDS_FOR = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "€": "e"})

LEXICON, STRONG_WORD, STEM, HIDDEN, PERSON, CAPITALS, DISGUISED, STRETCHED, SINGLE = (1 << i for i in range(9))
_EDGE = "".join(chr(c) for c in range(33, 128) if not chr(c).isalnum()) + "¡¿«»„“”‘’…"
_ENDS = "!?.,;:"
_INNER = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]+\d+[^\W\d_]+|[^\W\d_]_+[^\W\d_]")
_SAME = re.compile(r"(.)\1{2,}")
_JUNK = re.compile(r"[^\w]|_")


def plain(word: str) -> str:
    return word.strip(_EDGE).lower()


def keys_of(word: str) -> list[str]:
    """Lexicon keys of a plain word: itself and, marked, its beginnings."""
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) >= n)] if word else []


def revealed(word: str) -> str:
    """A word without stand-in characters, separators and stretched letters."""
    inner = word.rstrip(_ENDS)
    return _SAME.sub(r"\1", _JUNK.sub("", inner.lower().translate(STANDS_FOR)))


class Scanner:
    """Features of texts under one lexicon (key -> log odds); remembers what it knows of a word, in
    two generations, so that a full memory forgets only what was not used since it was last full."""

    #: Words of a generation.
    LIMIT = 100_000

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.known, self.older = lexicon, {}, {}
        self.stems = {k[:-1] for k in lexicon if k.endswith("*")}
        self.spellings = {k for k in lexicon if len(k) >= 4 and not k.endswith("*")}
        self.lengths = sorted({len(k) for k in self.spellings})

    def bits(self, word: str) -> int:
        core = word.rstrip(_ENDS)
        if core.isalpha():  # letters and sentence marks: nothing stands for a letter, nothing parts them
            p, hidden = core.lower(), None
        else:
            p, hidden = plain(word), True
        lex, out = self.lexicon, 0
        if p in lex:
            out |= LEXICON | (STRONG_WORD if lex[p] >= STRONG else 0)
        if p[:4] in self.stems or p[:5] in self.stems or p[:6] in self.stems:
            out |= STEM
        stretched = _SAME.search(p) is not None
        if not out and (hidden or stretched) and (r := revealed(word)) != p and r in lex:
            out |= HIDDEN
        if p in SECOND_PERSON:
            out |= PERSON
        if len(word) > 1 and word.isupper():
            out |= CAPITALS
        if hidden and _INNER.search(word):
            out |= DISGUISED
        if stretched:
            out |= STRETCHED
        if len(p) == 1:
            out |= SINGLE
        return out

    def spelled(self, words: list[str], bits: np.ndarray) -> int:
        """Lexicon words that are spelled out letter by letter."""
        single = np.flatnonzero(bits & SINGLE)
        found = 0
        if len(single) >= 4:
            for run in np.split(single, np.flatnonzero(np.diff(single) > 1) + 1):
                if len(run) >= 4:
                    line = "".join(plain(words[i]) for i in run)
                    found += any(line[i: i + n] in self.spellings for n in self.lengths for i in range(len(line) - n + 1))
        return found

    def look_up(self, words: list[str]) -> list[int]:
        known = self.known
        codes = list(map(known.get, words))
        if None in codes:
            if len(known) > self.LIMIT:
                self.older, self.known = known, {}
                known = self.known
            older = self.older
            for w, code in zip(words, codes):
                if code is None and w not in known:
                    code = older.get(w)
                    known[w] = self.bits(w) if code is None else code
            codes = [known[w] if code is None else code for w, code in zip(words, codes)]
        return codes

    def features(self, text: str) -> list[float]:
        words = text.split()
        bits = np.array(self.look_up(words), dtype=np.int64)
        n, chars = max(1, len(words)), max(1, len(text))
        lex, person = np.flatnonzero(bits & (LEXICON | HIDDEN | STEM)), np.flatnonzero(bits & PERSON)
        near = 0
        if len(lex) and len(person):
            at = np.searchsorted(person, lex)
            left = np.abs(lex - person[np.maximum(at - 1, 0)])
            right = np.abs(person[np.minimum(at, len(person) - 1)] - lex)
            near = int((np.minimum(left, right) <= NEAR).sum())
        count = {b: int(np.count_nonzero(bits & b)) for b in (LEXICON, STRONG_WORD, STEM, HIDDEN, CAPITALS, DISGUISED, STRETCHED)}
        kinds = len({plain(words[i]) for i in np.flatnonzero(bits & LEXICON)})
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        capitals = int(np.count_nonzero((raw >= 65) & (raw <= 90)))
        marks = text.count("!")
        other = int(np.count_nonzero((raw > 32) & (raw < 127))) - int(np.count_nonzero((raw >= 48) & (raw <= 57) | (raw >= 97) & (raw <= 122))) - capitals - marks
        hidden = count[HIDDEN] + (self.spelled(words, bits) if self.lexicon else 0)
        return [count[LEXICON] / n, math.log1p(count[LEXICON]), math.log1p(count[STRONG_WORD]), math.log1p(kinds), count[STEM] / n, math.log1p(count[STEM]),
                math.log1p(hidden), near / n, len(person) / n, capitals / chars, count[CAPITALS] / n, marks / chars, other / chars, count[DISGUISED] / n,
                count[STRETCHED] / n, math.log1p(len(words))]


def features_column(lexicons: dict[int, dict[str, float]]):
    """Column function (text, fold) -> array of ``FEATURES``; an unknown fold means the whole lexicon (-1)."""

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scanners: dict[int, Scanner] = {}
        for t, f in batches:
            out = []
            for value, own in zip(t, f):
                if own not in scanners:
                    scanners[own] = Scanner(lexicons.get(own, lexicons[-1]))
                out.append(scanners[own].features(value or ""))
            yield pd.Series(out)
        scanners.clear()
        give_back()

    return features


def term_stats(rows: DataFrame) -> DataFrame:
    """fold, label, term, docs over rows with fold, label and text; term null counts the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            acc: dict = {}
            for fold, label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                found = {k for w in set(map(plain, text.decode().split())) for k in keys_of(w)}
                for k in (None, *found):
                    acc[fold, label, k] = acc.get((fold, label, k), 0) + 1
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in acc], pa.int32()), pa.array([k[1] for k in acc], pa.int32()),
                                              pa.array([k[2] for k in acc], pa.string()), pa.array(list(acc.values()), pa.int64())], ["fold", "label", "term", "docs"])

    return rows.select("fold", "label", "text").mapInArrow(run, "fold int, label int, term string, docs long").groupBy("fold", "label", "term").agg(F.sum("docs").alias("docs"))


def learn_lexicons(rows: DataFrame, folds: int = FOLDS) -> dict[int, dict[str, float]]:
    """{fold: lexicon learned without it, -1: lexicon of all rows}; at most the terms of ``FIT_ROWS`` documents."""
    stats = term_stats(rows).groupBy("term").agg(*[F.coalesce(F.sum(F.when((F.col("fold") == f) & (F.col("label") == v), F.col("docs"))), F.lit(0)).alias(f"n{f}_{v}")
                                                   for f in range(folds) for v in (0, 1)])
    stats = write_table(stats, "toxicity-terms")
    row = stats.where("term is null").first()
    both = [sum(row[f"n{f}_{v}"] for f in range(folds)) for v in (0, 1)]
    clean, toxic = (sum((F.col(f"n{f}_{v}") for f in range(folds)), F.lit(0)) for v in (0, 1))
    # a term that any of the lexicons may hold: its odds over all folds decide first
    odds = F.log((toxic + 0.5) / (both[1] + 1)) - F.log((clean + 0.5) / (both[0] + 1))
    chosen = stats.where(F.col("term").isNotNull() & (toxic >= MIN_TOXIC) & (odds >= MIN_ODDS)).collect()
    out: dict[int, dict[str, float]] = {}
    for left in (*range(folds), -1):
        use = [f for f in range(folds) if f != left]
        docs = [sum(row[f"n{f}_{v}"] for f in use) for v in (0, 1)]
        out[left] = {}
        for r in chosen:
            a, b = sum(r[f"n{f}_1"] for f in use), sum(r[f"n{f}_0"] for f in use)
            if a >= MIN_TOXIC:
                odds = math.log((a + 0.5) / (docs[1] + 1)) - math.log((b + 0.5) / (docs[0] + 1))
                if odds >= MIN_ODDS and odds / math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= MIN_Z:
                    out[left][r["term"]] = odds
    return out


class Toxicity:
    """A fitted model: lexicons, trees and calibration (either may be missing)."""

    def __init__(self, lexicons: dict[int, dict[str, float]], trees, calibration, share: float):
        self.lexicons, self.trees, self.calibration, self.share = lexicons, trees, calibration, share

    def add_score(self, df: DataFrame, text: Column, name: str = "__score") -> DataFrame:
        """``df`` with a score column."""
        if self.trees is None:
            return df.withColumn(name, F.lit(float(self.share)))
        features = features_column({-1: self.lexicons[-1]})(text, F.lit(-1))
        out = self.trees.transform(df.withColumn("__features", array_to_vector(features)))
        out = out.withColumn("__p", vector_to_array("__probability")[1])
        if self.calibration is not None:
            out = self.calibration.transform(out.withColumn("__pv", array_to_vector(F.array("__p")))).withColumn(name, F.col("__calibrated"))
            out = out.drop("__pv", "__calibrated")
        else:
            out = out.withColumn(name, F.col("__p"))
        out = out.withColumn(name, F.least(F.greatest(F.col(name), F.lit(0.0)), F.lit(1.0)))
        return out.drop("__features", "__raw", "__probability", "__prediction", "__p")


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id", label: str = "toxic", fit_rows: int = FIT_ROWS,
        trees: int = 30, depth: int = 3) -> Toxicity:
    """Fit on the labelled documents of ``docs`` (callers leave held-out rows out of ``labels``)."""
    marked = (labels.where(F.col(label).isin(0, 1)).select(F.col(label_id).cast("long").alias("label_id"), F.col(label).cast("int").alias("label"))
              .dropDuplicates(["label_id"]).orderBy(F.xxhash64("label_id"), "label_id").limit(fit_rows))
    # fit_rows narrow rows at most; the texts are those of the chosen documents
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(FOLDS)).cast("int")
    rows = write_table(rows.join(F.broadcast(marked), rows["doc_id"] == marked["label_id"]).select("text", "label", fold.alias("fold")), "toxicity-fit")
    share = rows.agg(F.avg("label")).first()[0]
    if not share or share == 1:
        return Toxicity({-1: {}}, None, None, share or 0.0)
    lexicons = learn_lexicons(rows)
    dense = write_table(rows.select("label", "fold", features_column(lexicons)(F.col("text"), F.col("fold")).alias("f"))
                        .select(F.col("label").cast("double").alias("label"), "fold", "f"), "toxicity-features")
    dense = dense.withColumn("__features", array_to_vector("f"))
    classifier = (GBTClassifier(featuresCol="__features", labelCol="label", predictionCol="__prediction", maxIter=trees, maxDepth=depth, stepSize=0.2, minInstancesPerNode=10,
                                seed=42, maxBins=64).setProbabilityCol("__probability").setRawPredictionCol("__raw"))
    part = dense.where(F.col("fold") != CALIBRATION).coalesce(4)
    one = part.agg(F.avg("label")).first()[0]
    if not one or one == 1:
        part = dense.coalesce(4)
    model = classifier.fit(part)
    kept = model.transform(dense.where(F.col("fold") == CALIBRATION)).select("label", vector_to_array("__probability")[1].alias("p"))
    kept = kept.select("label", array_to_vector(F.array("p")).alias("__pv"))
    seen = kept.agg(F.avg("label"), F.count_if(F.col("label") == 1)).first()
    calibration = None
    if seen[0] and seen[0] < 1 and seen[1] >= 5:
        calibration = IsotonicRegression(featuresCol="__pv", labelCol="label", predictionCol="__calibrated").fit(kept)
    return Toxicity(lexicons, model, calibration, share)


def score(docs: DataFrame, model: Toxicity, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score for every row."""
    return model.add_score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text")), F.col("__text")).select("doc_id", F.col("__score").alias("score"))


def held_out_scores(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder: int = 1, **options) -> DataFrame:
    """doc_id, held_out, score, predicted; labels of held-out rows are not used."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"), modulus, remainder)), **options)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), "score",
                                     (F.col("score") >= PREDICTED).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the rows scored ``PREDICTED`` or more."""
    model = fit(docs, labels, text=text, **options)
    return unpack(model.add_score(pack(docs), F.col(f"__row.{text}")).where(F.col("__score") < PREDICTED))
