"""SentencePiece encoding and decoding through tables of distinct chunks.

When no piece of a vocabulary holds a whitespace marker after another character, merges never
cross the point where a word ends and the next run of markers begins. A text is then the
concatenation of its chunks (a run of markers and the word behind it), a chunk is segmented by
the library when a table does not hold it, and a document's ids are its chunks' ids joined by position.
Decoding goes through the same table. ``checked_model`` verifies the property (and the normaliser
settings it rests on) for the model at hand and refuses others.

The table of distinct chunks belongs to a task and is carried over its batches; above
``TABLE_CHUNKS`` entries it starts anew, so memory is bounded, and a chunk is segmented once a
task and again after each restart. Rows stay where they are: no
shuffle, and a lost task is recomputed from its input alone.

Null and empty texts encode to the begin and end ids and decode to an empty text. A literal
marker character in a text is a space to the library and decodes to a space here as there.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import give_back

#: Distinct chunks a task keeps.
TABLE_CHUNKS = 100_000
#: Rows that are segmented together and go back to Spark as one batch.
OUT_ROWS = 500
MARK = "▁"
#: A run of spaces and the word behind it, or the spaces at the end.
CHUNK = re.compile(r" *[^ ]+| +\Z")


def checked_model(path: str) -> bytes:
    """The model file's bytes, if its pieces can't cross whitespace markers."""
    import sentencepiece
    with open(path, "rb") as f:
        proto = f.read()
    sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
    crossing = [p for p in map(sp.id_to_piece, range(sp.get_piece_size())) if re.search(f"[^{MARK}]{MARK}", p)]
    probe = "  a  b "
    if crossing or sp.encode("a b") != sp.encode("a") + sp.encode("b") or sp.decode(sp.encode(probe)) != probe:
        raise ValueError(f"pieces of {path} cross whitespace markers, or its normaliser changes white space")
    return proto


class ChunkTable:
    """ids (little-endian 32-bit, packed) and decoded text of each distinct chunk seen so far.

    A chunk is kept without its first space: the library puts the marker before every text it
    encodes and takes it off every text it decodes.
    """

    def __init__(self, proto: bytes, size: int = TABLE_CHUNKS):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size, self.rows = size, {}
        self.marker = np.array([self.sp.piece_to_id(MARK)], dtype="<u4").tobytes()

    def split(self, text: str) -> list[str]:
        if MARK in text:
            text = text.replace(MARK, " ")
        plain = text.split(" ")
        if "" not in plain:
            return plain  # single spaces only: the chunks are the words
        return [c[1:] for c in CHUNK.findall(" " + text)] if text else []

    def add(self, chunks: list[str]) -> None:
        """Segment new chunks; one thread, as Spark runs a task per core."""
        ids = self.sp.encode(chunks, num_threads=1)
        for chunk, own, text in zip(chunks, ids, self.sp.decode(ids, num_threads=1) if chunks else []):
            packed = np.array(own, dtype="<u4").tobytes() if chunk else self.marker
            self.rows[chunk] = (packed, text)

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(packed ids with begin and end, decoded text) of each text."""
        first, last = (np.array([i], dtype="<u4").tobytes() for i in (self.sp.bos_id(), self.sp.eos_id()))
        split = [self.split(text) for text in texts]
        found = set().union(*split)
        missing = [c for c in found if c not in self.rows]
        if len(self.rows) + len(missing) > self.size:
            self.rows, missing = {}, list(found)
        self.add(missing)
        out = []
        for chunks in split:
            got = [self.rows[c] for c in chunks]
            out.append((first + b"".join([g[0] for g in got]) + last, " ".join([g[1] for g in got])))
        return out


def encode_decode(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text",
                  table_chunks: int = TABLE_CHUNKS) -> DataFrame:
    """doc_id, ids (begin, pieces, end as packed little-endian unsigned 32-bit integers; see
    ``unpacked``) and decoded text of every row. ``model``: path of the model file."""
    proto = checked_model(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ChunkTable(proto, table_chunks)
        for b in batches:
            for at in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(at, OUT_ROWS)
                out = table.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())],
                    ["doc_id", "ids", "decoded"])
        del table
        give_back()

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, ids binary, decoded string")


def unpacked(ids: bytes) -> list[int]:
    return np.frombuffer(ids, dtype="<u4").tolist()
