"""Term counts as one row per item, and the product of such rows with a batch of queries.

An item's text is one row, so its terms are counted where the text is read and its counts stay one
row: ``(keys..., dl, words, tfs, terms)``, of which ``terms`` is made of ``words`` (the terms joined by
blanks, as they are stored and sent to tasks) when it is read. Nothing of a text is shuffled, and a score (a sum over an item's
own terms) needs no exchange either. A batch of queries is shipped to the tasks when its checked size
allows; each task multiplies tiles of items with it and returns its scores, or its best ``k`` a query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.functions.text import term_text
from skein.session import write_table

#: (query, term) rows that may be shipped to every task (some 30 bytes each).
MAX_QUERY_ROWS = 8_000_000
#: Queries of a block, and scores of one tile (8 bytes each).
BLOCK_QUERIES, TILE_SCORES = 1024, 2_000_000
#: Terms that the most queries have are multiplied as a matrix: this many, and entries of the matrix at most.
COMMON_TERMS, COMMON_ENTRIES = 512, 8_000_000
DIGITS = 9
#: Distinct terms that a task counts before it hands them on.
COUNTED_TERMS = 500_000


# ------------------------------------------------------------------ rows

def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


#: Whether a byte of ``term_text`` belongs to a term.
_OF_TERM = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the words of ``term_text`` values in order, their number per text)."""
    texts = pc.fill_null(texts, "")
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset: texts.offset + len(texts) + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0]: ends[-1]]
    ends = ends - ends[0]
    inside = _OF_TERM[whole]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    own = ends[:-1][ends[1:] > ends[:-1]]
    first[own] = inside[own]  # no word goes on from one text to the next
    sizes = np.diff(np.searchsorted(np.flatnonzero(first), ends))
    offsets = np.append(np.flatnonzero(first[inside]), np.count_nonzero(inside)).astype(np.int32)
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(whole[inside])), sizes


def _counted(b: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with its last column (an item's ``term_text``) as dl, words, tfs; items without a word are left out."""
    words, dl = _words(b.column(b.num_columns - 1))
    b, dl = b.filter(pa.array(dl > 0)), dl[dl > 0]
    coded = words.dictionary_encode()
    n = max(1, len(coded.dictionary))
    pairs, tf = np.unique(np.repeat(np.arange(len(dl)), dl) * n + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(pairs // n, minlength=len(dl)))])
    joined = pc.binary_join(_lists(offsets, coded.dictionary.take(pa.array(pairs % n))), " ")
    columns = [*b.columns[:-1], pa.array(dl, pa.int32()), joined, _lists(offsets, pa.array(tf, pa.int32()))]
    return pa.RecordBatch.from_arrays(columns, [*b.schema.names[:-1], "dl", "words", "tfs"])


def with_terms(rows: DataFrame) -> DataFrame:
    """Stored rows with their terms as a list."""
    return rows.withColumn("terms", F.split("words", " ")) if "words" in rows.columns else rows


def _sent(rows: DataFrame) -> DataFrame:
    """Rows as they go to Python: with one string instead of a list of strings, if they are stored so."""
    return rows.drop("terms") if "words" in rows.columns else rows


def _listed(b: pa.RecordBatch) -> pa.RecordBatch:
    """The batch with ``words``, if there, as the list ``terms``."""
    at = b.schema.get_field_index("words")
    if at < 0:
        return b
    words, sizes = _words(b.column(at))
    return b.set_column(at, "terms", _lists(np.concatenate([[0], np.cumsum(sizes)]), words))


def term_rows(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys..., dl, words, tfs, terms), one written row per item with a term; rows with equal keys (null too) are one item
    whose counts are added up (and whose dl is that of one of its rows)."""
    # a text goes to Python as one string, and without a filter on it here, which would have Spark look for its words twice
    words = df.select(*keys, term_text(F.col(text)).alias("words"))
    schema = ", ".join(f"{k} {words.schema[k].dataType.simpleString()}" for k in keys) + ", dl int, words string, tfs array<int>"
    rows = with_terms(write_table(words.mapInArrow(lambda batches: map(_counted, batches), schema), "terms"))
    again = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*[F.col(k).alias(f"_{k}") for k in keys])
    if not again.limit(1).count():
        return rows
    again = write_table(again, "repeated")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    merged = long_form(rows.join(again, same, "left_semi"), keys).groupBy(*keys, "term").agg(F.sum("tf").cast("int").alias("tf"), F.first("dl").alias("dl"))
    added = grouped(merged, keys).select(*keys, "dl", F.array_join("terms", " ").alias("words"), "tfs")
    stored = rows.join(again, same, "left_anti").drop("terms").unionByName(added)
    return with_terms(write_table(stored, "terms"))


def item_counts(rows: DataFrame, group: str) -> DataFrame:
    """(group, term, df): the items of a group that have a term. Each task adds up its items' lists (an item has a
    term once), so that its distinct terms are what is shuffled."""

    def added(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by([group, "term"]).aggregate([("n", "sum")]).rename_columns([group, "term", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in map(_listed, batches):
            for g in whole.column(group).unique().to_pylist():
                found = pc.value_counts(whole.filter(pc.equal(whole.column(group), g)).column("terms").flatten())
                held.append(pa.table([pa.array([g] * len(found), pa.string()), found.field("values"), found.field("counts")], [group, "term", "n"]))
                size += len(found)
            if size > 2 * COUNTED_TERMS:
                held = [added(held)]
                size = held[0].num_rows
                if size > COUNTED_TERMS:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from added(held).to_batches()

    partial = _sent(rows.select(group, *[c for c in ("words", "terms") if c in rows.columns])).mapInArrow(run, f"{group} string, term string, n long")
    return partial.groupBy(group, "term").agg(F.sum("n").alias("df"))


def long_form(rows: DataFrame, keys: list[str], values: str = "tfs", name: str = "tf", carry: tuple = ("dl",)) -> DataFrame:
    """(keys..., carried columns, term, value): one row per term of an item."""
    zipped = rows.select(*keys, *carry, F.explode(F.arrays_zip("terms", values)).alias("_x"))
    return zipped.select(*keys, *carry, F.col("_x.terms").alias("term"), F.col(f"_x.{values}").alias(name))


def grouped(postings: DataFrame, keys: list[str], values: str = "tfs", name: str = "tf", carry: tuple = ("dl",)) -> DataFrame:
    """Rows of long-form counts or weights (one exchange)."""
    per_item = postings.groupBy(*keys).agg(*[F.first(c).alias(c) for c in carry], F.collect_list(F.struct("term", name)).alias("_x"))
    return per_item.select(*keys, *carry, F.col("_x.term").alias("terms"), F.col(f"_x.{name}").alias(values))


# --------------------------------------------------------------- product

class Queries:
    """A batch of queries: each term's number, and per block of queries their weights, as a matrix for the terms
    that most queries have and as lists for the others."""

    def __init__(self, ids: pa.Array, words: pa.Array, weights: np.ndarray):
        coded, known = ids.dictionary_encode(), words.dictionary_encode()
        self.ids = coded.dictionary
        q, t = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), known.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(known.dictionary)
        order = np.argsort(-np.bincount(t, minlength=n), kind="stable")  # numbers by falling number of queries
        self.terms = known.dictionary.take(pa.array(order))
        number = np.empty(n, np.int64)
        number[order] = np.arange(n)
        t = number[t]
        self.common = min(n, COMMON_TERMS, max(1, COMMON_ENTRIES // max(1, len(self.ids))))
        self.blocks = []
        for start in range(0, len(self.ids), BLOCK_QUERIES):
            size = min(BLOCK_QUERIES, len(self.ids) - start)
            own = (q >= start) & (q < start + size)
            bq, bt, bw = q[own] - start, t[own], weights[own]
            head = bt < self.common
            matrix = np.zeros((self.common, size))
            matrix[bt[head], bq[head]] = bw[head]  # a query has a term once
            by_term = np.argsort(bt[~head], kind="stable")
            ends = np.searchsorted(bt[~head][by_term], np.arange(self.common, n + 1))
            self.blocks.append((start, size, matrix, ends, bq[~head][by_term], bw[~head][by_term]))

    def found(self, words: pa.Array) -> np.ndarray:
        """Numbers of words, -1 for those that no query has."""
        return pc.fill_null(pc.index_in(words, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def tiles(self, b: pa.RecordBatch, weigh: Callable[[pa.RecordBatch, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """(first row, block, first query, scores of rows x queries) of a batch of rows; 0: no term in common."""
        listed = b.column("terms")
        sizes = pc.list_value_length(listed).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(b.num_rows), sizes)
        term = self.found(listed.flatten())
        hit = term >= 0
        w, row, term = weigh(b, row)[hit], row[hit], term[hit]
        step = max(64, TILE_SCORES // max(1, min(BLOCK_QUERIES, len(self.ids))))
        for first in range(0, b.num_rows, step):
            n = min(step, b.num_rows - first)
            here = slice(*np.searchsorted(row, [first, first + n]))
            r, t, x = row[here] - first, term[here], w[here]
            head = t < self.common
            items = np.zeros((n, self.common))
            items[r[head], t[head]] = x[head]
            r, t, x = r[~head], t[~head] - self.common, x[~head]
            for i, (start, size, matrix, ends, queries, weights) in enumerate(self.blocks):
                scores = items @ matrix
                many = ends[t + 1] - ends[t]
                total = int(many.sum())
                if total:
                    at = np.arange(total) + np.repeat(ends[t] - (np.cumsum(many) - many), many)
                    scores += np.bincount(np.repeat(r, many) * size + queries[at], np.repeat(x, many) * weights[at], minlength=n * size).reshape(n, size)
                yield first, i, start, scores


_NULL = np.iinfo(np.int64).min


def _values(a: pa.Array) -> np.ndarray:
    """Item keys as an array that sorts nulls first (strings behind a mark, null as '')."""
    if pa.types.is_integer(a.type):
        return pc.fill_null(a, _NULL).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.array(["" if x is None else "=" + x for x in a.to_pylist()], dtype=object)


def _keys(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    if values.dtype == object:
        return pa.array([x[1:] if x else None for x in values], pa.string())
    return pa.array(values, mask=values == _NULL).cast(kind)


class Best:
    """The k best (score rounded, descending, then item) of each query of a block so far."""

    def __init__(self, k: int, size: int):
        self.k, self.floor = k, np.full(size, 0.0)
        self.q, self.s, self.keys = np.zeros(0, np.int64), np.zeros(0), None

    def add(self, scores: np.ndarray, keys: np.ndarray) -> None:
        near = scores >= np.maximum(self.floor - 10.0 ** -DIGITS, np.finfo(float).tiny)
        if near.sum() > 4 * self.k * len(self.floor) and len(scores) > self.k:
            kth = np.partition(scores, len(scores) - self.k, axis=0)[len(scores) - self.k]
            near &= scores >= kth - 10.0 ** -DIGITS
        r, q = np.nonzero(near)
        if not len(r):
            return
        every = np.concatenate([self.keys, keys]) if self.keys is not None else keys
        rank = np.unique(every, return_inverse=True)[1]
        old = len(every) - len(keys)
        where = np.concatenate([np.arange(old), r + old])
        q, s = np.concatenate([self.q, q]), np.concatenate([self.s, scores[r, q]])
        order = np.lexsort((rank[where], -np.round(s, DIGITS), q))
        q, s, where = q[order], s[order], where[order]
        start = np.searchsorted(q, q)
        keep = np.arange(len(q)) - start < self.k
        self.q, self.s, self.keys = q[keep], s[keep], every[where[keep]]
        last = np.arange(len(q)) - start == self.k - 1
        self.floor[q[last]] = np.round(s[last], DIGITS)


def scores(rows: DataFrame, query: pa.Table, by: str, item: str, weigh: Callable[[pa.RecordBatch, np.ndarray], np.ndarray], k: int | None = None,
           group: str | None = None, exclude_self: bool = False) -> DataFrame:
    """(by, [group], item, raw score) of all items that share a term with a query, or of each task's ``k`` best a query.

    ``query``: by, [group], term, wq, a term once a query (and group); ``rows``: [group], item, terms and what
    ``weigh`` reads, which gives the weight of each of the batch's terms (in list order, with its row number).
    With ``group`` queries meet items of their own group."""
    spark = rows.sparkSession
    names = query.column(group).unique().to_pylist() if group else [None]
    shipped = spark.sparkContext.broadcast({g: Queries(*[(part.column(c).combine_chunks()) for c in (by, "term")], part.column("wq").to_numpy())
                                            for g in names for part in [query.filter(pc.equal(query.column(group), g)) if group else query] if part.num_rows})
    kinds = {"int32": "int", "int64": "long", "string": "string", "large_string": "string"}
    item_type, by_type = rows.schema[item].dataType.simpleString(), kinds[str(query.schema.field(by).type)]
    schema = f"{by} {by_type}, " + (f"{group} string, " if group else "") + f"{item} {item_type}, score double"

    def out(q: Queries, g: str | None, which: np.ndarray, items: pa.Array, s: np.ndarray) -> pa.RecordBatch:
        columns = [q.ids.take(pa.array(which)), *([pa.array([g] * len(which), pa.string())] if group else []), items, pa.array(s)]
        return pa.RecordBatch.from_arrays(columns, [by, *([group] if group else []), item, "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for whole in map(_listed, batches):
            for g, q in shipped.value.items():
                b = whole.filter(pc.equal(whole.column(group), g)) if group else whole
                if exclude_self:  # a null key equals no query and differs from none
                    b = b.filter(pc.is_valid(b.column(item)))
                if not b.num_rows:
                    continue
                ids = b.column(item)
                own = pc.fill_null(pc.index_in(ids, value_set=q.ids.cast(ids.type)), -1).to_numpy(zero_copy_only=False) if exclude_self else None
                keys = _values(ids) if k else None
                for first, i, start, s in q.tiles(b, weigh):
                    if exclude_self:
                        col = own[first: first + len(s)] - start
                        mine = np.flatnonzero((col >= 0) & (col < s.shape[1]))
                        s[mine, col[mine]] = 0.0
                    if k is None:
                        r, c = np.nonzero(s > 0)
                        for at in range(0, len(r), 100_000):
                            yield out(q, g, c[at: at + 100_000] + start, ids.take(pa.array(r[at: at + 100_000] + first)), s[r[at: at + 100_000], c[at: at + 100_000]])
                        continue
                    kept = best.setdefault((g, i), Best(k, s.shape[1]))
                    kept.add(s, keys[first: first + len(s)])
        for (g, i), kept in best.items():
            if kept.keys is not None:
                yield out(shipped.value[g], g, kept.q + shipped.value[g].blocks[i][0], _keys(kept.keys, ids.type), kept.s)

    return _sent(rows).mapInArrow(run, schema)
