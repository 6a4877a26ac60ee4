"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the terms whose inverse document frequency lies in a chosen band, that is whose
share of documents is between ``LOW`` and ``HIGH``. A document is its sorted distinct lexicon terms,
and a slot of its fingerprint is the hash of those among them that are in one randomised subset of
the lexicon. There are ``FAMILIES`` families of nested subsets: in family f the subset of level j
keeps a term with probability 2**-j. A slot stays equal as long as no term of its subset comes or
goes, so sparse subsets survive edits, and which levels are sparse depends on the number of terms:
a document uses the ``LEVELS`` levels around the logarithm of its number of terms.

The likeness of two fingerprints is the share of equal slots among the slots of the levels both
have in which at least one has a term; equal fingerprints have likeness 1.

A text without any lexicon term uses all its distinct terms; without any term its slots are all
empty. Null texts count as empty. The lexicon is found exactly (``frequent``) and shipped: it has
at most (mean distinct terms of a document) / LOW terms however many documents there are, and its
size is checked.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import frequent, sha256, utf8, words
from skein.session import write_table

#: The band of document shares (an idf between 2.3 and 6.9).
LOW, HIGH = 1e-3, 0.1
FAMILIES = 16
LEVELS = 4
MAX_LEXICON = 4_000_000
EMPTY = "...."
SEED = 1


def _add_documents(acc: Counter, texts: list[bytes]) -> int:
    for t in texts:
        acc.update(set(words(t)))
    return len(texts)


def lexicon(texts: DataFrame, low: float = LOW, high: float = HIGH) -> set[bytes]:
    """Terms of one text column whose share of the documents lies in the band."""
    found, n = frequent(texts, _add_documents, low)
    kept = {t for t, c in found.items() if c <= high * n}
    if len(kept) > MAX_LEXICON:
        raise ValueError(f"{len(kept)} terms in the band: choose a narrower one")
    return kept


class Hasher:
    """Fingerprints for one lexicon; remembers the hashes of terms it has met."""

    def __init__(self, terms: set[bytes], families: int = FAMILIES, levels: int = LEVELS):
        self.terms, self.families, self.levels, self.known = terms, families, levels, {}

    def _rows(self, chosen: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, level of each term in each family) of sorted terms."""
        if len(self.known) > 200_000:
            self.known = {}
        known, rows = self.known, []
        for t in chosen:
            row = known.get(t)
            if row is None:
                h = [xxhash.xxh64_intdigest(t, SEED + f) for f in range(self.families + 1)]
                # trailing zeros: the term is in the subsets of levels 0 to that number
                row = known[t] = (h[0], bytes(((x & -x).bit_length() - 1 if x else 63) for x in h[1:]))
            rows.append(row)
        hashes = np.array([r[0] for r in rows], dtype="<u8")
        return hashes, np.frombuffer(b"".join([r[1] for r in rows]), dtype=np.uint8).reshape(-1, self.families)

    def fingerprint(self, text: bytes) -> str:
        """Two hex digits of the lowest level, then four characters a slot, level by level."""
        everything = set(words(text))
        chosen = sorted(everything & self.terms) or sorted(everything)
        if not chosen:
            return "00" + EMPTY * (self.levels * self.families)
        hashes, rank = self._rows(chosen)
        lowest = max(0, len(chosen).bit_length() - 2)
        out = [f"{lowest:02x}"]
        digest = xxhash.xxh64_intdigest
        for level in range(lowest, lowest + self.levels):
            inside = rank >= level
            some = inside.any(axis=0)
            for f in range(self.families):
                out.append(f"{digest(hashes[inside[:, f]].tobytes()) & 0xFFFF:04x}" if some[f] else EMPTY)
        return "".join(out)


def likeness(a: str, b: str, families: int = FAMILIES) -> float:
    """0 to 1; see the module's text."""
    if a == b:
        return 1.0
    width = families * len(EMPTY)
    ways = []
    for x in (a, b):
        low = int(x[:2], 16)
        ways.append({low + i: x[2 + i * width: 2 + (i + 1) * width] for i in range((len(x) - 2) // width)})
    same = seen = 0
    for level in ways[0].keys() & ways[1].keys():
        x, y = ways[0][level], ways[1][level]
        for at in range(0, width, len(EMPTY)):
            s, t = x[at: at + 4], y[at: at + 4]
            if s != EMPTY or t != EMPTY:
                seen += 1
                same += s == t
    return same / seen if seen else 0.0


def fingerprints(docs: DataFrame, terms: set[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint for every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(terms)  # size checked in lexicon

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shipped.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([hasher.fingerprint(t) for t in utf8(b.column(1))], pa.string())], ["doc_id", "fingerprint"])

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, fingerprint string")


# ---- robustness against an edit ------------------------------------------------------------

def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of another text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


ROBUST = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "part", "kind", "text"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]


def _finished(hasher: Hasher, row: tuple, following: tuple) -> tuple:
    """Result row of (doc_id, text, fingerprint) and the next document's."""
    key, text, own = row
    changed = edited(text, following[1]).encode()
    other = hasher.fingerprint(changed)
    return key, len(text), sha256(changed), own, other, likeness(own, other), likeness(own, following[2])


def robustness(docs: DataFrame, terms: set[bytes], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row.

    The next document is the next in descending doc_id (null ids last; equal ids in the order of
    their texts' hashes, then of the texts), after the last the first. Documents are range-partitioned in that order
    (one shuffle of the texts) and each partition is one pass that looks a row ahead; only the last
    row of a partition waits for the first of the next, and these rows (two a partition) meet in a
    second, small step.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # range bounds are sampled on the driver: of ids and hashes, never of texts
    bounds = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    order = [*bounds, F.col("text")]
    # explicit: fewer partitions than rows, so that a partition is worth a pass
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = chosen.repartitionByRange(n, *bounds).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    shipped = spark.sparkContext.broadcast(terms)  # size checked in lexicon

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS)], _OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shipped.value)
        before, part = None, None
        for b in batches:
            rows = []
            for key, value, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                row = (key, value, hasher.fingerprint(value.encode()))
                if before is None:
                    rows.append((key, None, None, row[2], None, None, None, at, "head", value))
                else:
                    rows.append((*_finished(hasher, before, row), at, "done", None))
                before, part = row, at
                if len(rows) >= 1000:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)
        if before is not None:
            yield batch([(before[0], None, None, before[2], None, None, None, part, "tail", before[1])])

    schema = f"doc_id long, {ROBUST}, part int, kind string, text string"
    told = write_table(ranged.mapInArrow(run, schema), "imatch")
    done = told.where("kind = 'done'").select(*_OUT[:7])
    ends = told.where("kind <> 'done'").select("part", "kind", "doc_id", "text", "fingerprint")
    heads, tails = ends.where("kind = 'head'"), ends.where("kind = 'tail'")
    parts = [r[0] for r in heads.select("part").orderBy("part").collect()]  # at most one number per partition
    following = spark.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, next int")
    met = (tails.join(following, "part")
           .join(heads.select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("fingerprint").alias("next_fp")), "next")
           .select("doc_id", "text", "fingerprint", "next_text", "next_fp"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(shipped.value)
        for b in batches:
            rows = [_finished(hasher, r[:3], (None, *r[3:])) for r in zip(*(b.column(i).to_pylist() for i in range(5)))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(_KINDS[:7])], _OUT[:7])

    return done.unionByName(met.mapInArrow(finish, f"doc_id long, {ROBUST}"))
