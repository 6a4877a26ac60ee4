"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import hashlib
import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one scoring block holds at most (a single longer document is a block alone).
BLOCK_BYTES = 16 * 1024 * 1024
#: Distinct keys a worker collects before it hands its partial counts to the shuffle.
FLUSH_KEYS = 400_000


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z (both are ASCII-only rules, and no
    byte of a multi-byte UTF-8 character is in either range)."""
    return text.lower().split()


def give_back() -> None:
    """Return a finished task's memory to the system: Spark keeps Python workers for later tasks,
    and what their allocators hold counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text modulo ``modulus`` equals ``remainder`` (a null id counts as '')."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus)) == remainder


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def block_of(docs: DataFrame, text: str, keys: list[str], block_bytes: int = BLOCK_BYTES) -> tuple[int, Column]:
    """The number of blocks, and a block number that depends on the row alone; blocks hold about
    ``block_bytes`` of text.

    One aggregate gives the number of blocks. Keys and text are hashed together, so a group of
    copies or a repeated key spreads over all blocks.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    return n, F.pmod(F.xxhash64(*keys, text), F.lit(n)).cast("long")


def partial_counts(batches: Iterable[pa.RecordBatch], count: Callable[[dict, pa.RecordBatch], None],
                   emit: Callable[[dict], pa.RecordBatch], flush: int = FLUSH_KEYS) -> Iterator[pa.RecordBatch]:
    """Map-side combine: ``count`` adds a batch to a dict, ``emit`` turns the dict into rows."""
    acc: dict = {}
    for batch in batches:
        count(acc, batch)
        if len(acc) >= flush:
            yield emit(acc)
            acc = {}
    if acc:
        yield emit(acc)


def pack(docs: DataFrame, name: str = "__row") -> DataFrame:
    """All columns of ``docs`` in one struct, so that added columns can't clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name))


def unpack(packed: DataFrame, name: str = "__row") -> DataFrame:
    return packed.select(f"{name}.*")


def unsigned(values: np.ndarray) -> np.ndarray:
    return values.astype(np.int64, copy=False).view(np.uint64)


#: Distinct keys of a chunk of the frequent-key count (a chunk's threshold grows with the chunk).
CHUNK_KEYS = 2_000_000
#: Frequent keys that may be shipped to every worker; beyond it they are counted by a shuffle.
MAX_CANDIDATES = 200_000


def frequent(texts: DataFrame, add: Callable[[Counter, list[bytes]], int], rate: float, finish: Callable[[Counter], None] | None = None,
             max_candidates: int = MAX_CANDIDATES, chunk_keys: int = CHUNK_KEYS, batch_rows: int = 512) -> tuple[dict, int]:
    """({key: count}, total) of all keys whose count is at least ``rate`` times the total.

    ``texts`` has one text column; ``add`` adds the counts of some texts and returns what they add
    to the total; ``finish`` adds keys that derive from a chunk's counts. Exact in two passes: a
    key that reaches the rate over everything reaches it in at least one chunk, so the first pass
    returns each chunk's own frequent keys (a few rows, not the long tail), and the second counts
    these candidates everywhere. If the candidates exceed ``max_candidates`` all keys are counted
    by a shuffle instead.
    """
    spark = texts.sparkSession
    schema = "k binary, c long"

    def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Counter, int]]:
        acc: Counter = Counter()
        total = 0
        for b in batches:
            for at in range(0, b.num_rows, batch_rows):
                total += add(acc, utf8(b.column(0).slice(at, batch_rows)))
                if len(acc) >= chunk_keys:
                    if finish:
                        finish(acc)
                    yield acc, total
                    acc, total = Counter(), 0
        if finish:
            finish(acc)
        yield acc, total
        del acc
        give_back()

    def rows(acc: dict, total: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([*acc, None], pa.binary()), pa.array([*acc.values(), total], pa.int64())], ["k", "c"])

    def local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for acc, total in chunks(batches):
            yield rows({k: c for k, c in acc.items() if c >= rate * total}, total)

    first = texts.mapInArrow(local, schema).groupBy("k").agg(F.sum("c").alias("c"))
    got = first.orderBy(F.col("k").asc_nulls_first()).limit(max_candidates + 2).collect()  # the total is the null key
    total = next((r["c"] for r in got if r["k"] is None), 0)
    if not total:
        return {}, 0
    if len(got) <= max_candidates + 1:
        shipped = spark.sparkContext.broadcast({bytes(r["k"]) for r in got if r["k"] is not None})

        def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for acc, n in chunks(batches):
                yield rows({k: acc[k] for k in shipped.value if k in acc}, n)

        counts = texts.mapInArrow(exact, schema)
    else:
        counts = texts.mapInArrow(lambda bs: (rows(*x) for x in chunks(bs)), schema)
    summed = counts.groupBy("k").agg(F.sum("c").alias("c"))
    kept = summed.where(F.col("k").isNotNull() & (F.col("c") >= F.lit(rate * total))).collect()
    return {bytes(r["k"]): r["c"] for r in kept}, total
