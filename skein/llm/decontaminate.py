"""Benchmark decontamination with one Aho-Corasick automaton.

Items and texts are normalised alike: A-Z lower-cased, every other ASCII character that is not a
digit or a letter is a separator, all non-ASCII characters are word characters. A window is
``width`` consecutive words of an item (an item of fewer words, but not none, is one window).
All windows go into one automaton over the normalised text, bounded by spaces so that only whole
words match; a document is scanned once, and word numbers map matches back to byte offsets of
the original text.

The items are shipped to the workers, so their size is checked: beyond ``SLICE_BYTES`` of item
text they are cut into slices with an automaton each, and what the slices hit is merged. Usual
benchmarks are one slice, and the scan is row-local.

Null and empty texts have no words; an item without words has no window; the windows of an item
without an id count as hits but not as an item; equal windows of several items count for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm.common import give_back, pack, unpack, utf8
from skein.session import write_table

#: Bytes of item text per automaton (an automaton takes up to 500 times its items' bytes).
SLICE_BYTES = 512 * 1024
#: Words of a window.
WIDTH = 13

#: Byte table of the normalisation: lower-cased word characters, spaces for separators.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def item_words(text: bytes) -> list[bytes]:
    return text.translate(NORMAL).split()


def windows(text: bytes, width: int = WIDTH) -> list[tuple[bytes, ...]]:
    w = item_words(text)
    if not w:
        return []
    return [tuple(w[i: i + width]) for i in range(max(1, len(w) - width + 1))]


def automaton(items: list[tuple[str | None, bytes]], width: int = WIDTH):
    """Automaton whose values are (words, numbers of the items); byte strings go in as latin-1."""
    table: dict[tuple[bytes, ...], set[int]] = {}
    for number, (_, text) in enumerate(items):
        for w in windows(text, width):
            table.setdefault(w, set()).add(number)
    a = ahocorasick.Automaton()
    for w, numbers in table.items():
        a.add_word(" " + b" ".join(w).decode("latin-1") + " ", (len(w), tuple(numbers)))
    if table:
        a.make_automaton()
    return a if table else None


def scan(a, text: bytes) -> tuple[int, list[tuple[int, int]], set[int]]:
    """(words, hit ranges of word numbers, numbers of the items) of a text; ranges are merged."""
    w = item_words(text)
    if not w or a is None:
        return len(w), [], set()
    line = " " + b" ".join(w).decode("latin-1") + " "
    ranges: list[tuple[int, int]] = []
    items: set[int] = set()
    at = word = 0  # the words before offset ``at`` are counted
    for end, (n, numbers) in a.iter(line):
        word += line.count(" ", at, end)
        at = end
        items.update(numbers)
        ranges.append((word - n, word))
    merged: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(stop, merged[-1][1]))
        else:
            merged.append((start, stop))
    return len(w), merged, items


def byte_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte offsets in the original text of ranges of word numbers."""
    if not ranges:
        return []
    mask = np.frombuffer(text.translate(NORMAL), dtype=np.uint8) != 32
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(int(starts[a]), int(ends[b - 1])) for a, b in ranges]


def _slices(items: DataFrame, item_id: str, text: str, slice_bytes: int) -> tuple[int, Iterator[list[tuple[str | None, bytes]]]]:
    """Number of parts of about ``slice_bytes``, and the parts, one in the driver's memory at a time."""
    chosen = items.select(F.col(item_id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).distinct()
    total = chosen.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n = max(1, -(-int(total) // slice_bytes))
    part = F.pmod(F.xxhash64("id", "t"), F.lit(n))

    def rows(i: int) -> list[tuple[str | None, bytes]]:
        got = chosen.where(part == i).collect()  # about slice_bytes by the count above
        return sorted(((r["id"], r["t"].encode()) for r in got), key=lambda x: (x[0] is not None, x))

    return n, (rows(i) for i in range(n))


HITS = "array<struct<first_word:long,end_word:long,start:long,end:long>>"
_SPAN = pa.struct([(n, pa.int64()) for n in ("first_word", "end_word", "start", "end")])


def _scanned(docs: DataFrame, part: list[tuple[str | None, bytes]], width: int) -> DataFrame:
    """key, n_words, spans, items of every (key, text) row for one slice of the items."""
    shipped = docs.sparkSession.sparkContext.broadcast(part)  # size checked in _slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        a = automaton(own, width)
        for b in batches:
            n_words, spans, ids = [], [], []
            for t in utf8(b.column(1)):
                n, ranges, numbers = scan(a, t)
                n_words.append(n)
                spans.append([(x, y, s, e) for (x, y), (s, e) in zip(ranges, byte_spans(t, ranges))])
                ids.append(sorted({own[i][0] for i in numbers if own[i][0] is not None}))
            dicts = [[dict(zip(("first_word", "end_word", "start", "end"), x)) for x in row] for row in spans]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(dicts, pa.list_(_SPAN)),
                                              pa.array(ids, pa.list_(pa.string()))], ["key", "n_words", "spans", "items"])
        give_back()

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(run, f"key {kind}, n_words long, spans {HITS}, items array<string>")


def merged(spans: Column) -> Column:
    """Overlapping or touching word ranges as one, in order; they carry their byte ranges along."""
    start = F.array().cast(HITS)

    def add(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        both = F.struct(last["first_word"].alias("first_word"), F.greatest(last["end_word"], x["end_word"]).alias("end_word"),
                        last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        joins = (F.size(acc) > 0) & (x["first_word"] <= F.try_element_at(acc, F.lit(-1))["end_word"])
        return F.when(joins, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.sort_array(spans), start, add)


def matches(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", width: int = WIDTH, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (ids with an occurring window, sorted), items_sha256, spans
    (word and byte ranges that are hit) and contaminated for every row of ``docs``.

    Items of one slice need no shuffle. With more slices each is read, scans the documents and is
    let go before the next; the number of scans grows with the items (one for each slice), and
    what they hit (rows with hits only) meets by row content.
    """
    n_parts, parts = _slices(items, item_id, item_text, slice_bytes)
    keyed = docs.select(F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h")).alias("key"), F.col(text).alias("text"))
    found = _scanned(keyed, next(parts) if n_parts == 1 else [], width)  # several slices: no items, for n_words
    if n_parts > 1:
        hits = None
        for part in parts:
            one = _scanned(keyed, part, width).where(F.size("spans") > 0).dropDuplicates(["key"]).select("key", "spans", "items")
            one = write_table(one, "hits")  # its slice is not needed any more
            hits = one if hits is None else hits.union(one)
        # per document at most its own words and the items that occur in it
        both = hits.groupBy("key").agg(merged(F.flatten(F.collect_list("spans"))).alias("spans"),
                                       F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        base = found.select("key", "n_words").alias("a")
        found = (base.join(both.alias("b"), F.col("a.key").eqNullSafe(F.col("b.key")), "left")
                 .select("a.key", "n_words", F.coalesce("spans", F.array().cast(HITS)).alias("spans"),
                         F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end_word"] - x["first_word"])
    return (found.select(F.col("key.id").alias(doc_id), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                         "items", F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "spans")
            # contaminated: hit words are a twentieth of all words or more
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))))


def keep_uncontaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated rows."""
    rows = pack(docs).select("__row", F.col(f"__row.`{text}`").alias("text"))
    told = matches(rows, items, doc_id="__row", text="text", **options)
    return unpack(told.where(~F.col("contaminated")).select("__row"))
