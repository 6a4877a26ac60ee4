import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from edge import edge_docs, empty_docs, texts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from skein.llm import swap_packing as S
from skein.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check_layout(rows, size):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by_sequence)


def test_query_equals_the_library_and_packs_tight(spark, tokenizer):
    sf = "/root/testdata/sf0.01"
    docs = texts(spark, sf)
    rows = QUERIES["op12_swap_packing"](spark, sf).collect()
    own = {}
    for r in rows:
        own.setdefault(r["doc_id"], []).append(r)
    assert own.keys() == docs.keys()
    total = 0
    for doc, text in docs.items():
        ids = ids_of(tokenizer, text)
        total += len(ids)
        parts = sorted(own[doc], key=lambda r: r["piece"])
        assert [p["piece"] for p in parts] == list(range(math.ceil(len(ids) / 4096)))
        for p in parts:
            cut = ids[4096 * p["piece"]: 4096 * (p["piece"] + 1)]
            assert (p["start"], p["length"]) == (4096 * p["piece"], len(cut))
            assert p["ids_crc32"] == zlib.crc32(np.array(cut, dtype="<u4").tobytes())
    assert check_layout(rows, 4096) <= math.ceil(total / 4096) + 1


def test_word_table_equals_the_library(tokenizer):
    odd = ["<|endoftext|>a", "it's don't 'tis 'Sie 'll", "x\u001cy z", "H̱a Å", "ΑΣ Σ", "İstanbul ǅ", "ab<|startoftext|>,", "'s", "", " ", "a\u0000b", "…word—x", "12ab3",
           "🙂🙂a", "Ünï,cö", "'", "\"'s\"", "(‘hi’)", "ßA_B_c", "don't's", "«é»", "a'", "'a", "x×y ÷", "  lead trail  ", "a b c\u0085d", "é word́.", "ª º µ"]
    encoder = S.WordEncoder(PATH)
    assert encoder.checked
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in odd]
    for limit in (10 ** 6, 3):  # also with a table that is always full
        encoder.table = S.Table(limit)
        for _ in range(3):
            assert encoder.encode(pa.array(odd)) == want
    r = random.Random(1)
    made = ["".join(r.choice("aZé ßİ'$<|.,!3̱́Σ\t ") for _ in range(r.randrange(40))) for _ in range(3_000)]
    assert encoder.encode(pa.array(made)) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in made]
    encoder.checked = False
    assert encoder.encode(pa.array(odd)) == want


def test_another_tokenizer_encodes_whole_texts():
    encoder = S.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not encoder.checked
    assert np.frombuffer(encoder.encode(pa.array(["two  words"]))[0], dtype="<u4").tolist() == encoder.tokenizer.encode("two  words", add_special_tokens=False).ids


def valid(bins, lengths, size):
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(0 < sum(lengths[i] for i in b) <= size for b in bins)


@pytest.mark.parametrize("low, high, n", [(1, 40, 900), (200, 480, 300), (300, 700, 300), (510, 515, 50), (1, 1000, 400), (1000, 1000, 20)])
def test_local_search_empties_bins(low, high, n):
    r = random.Random(low)
    lengths, size = [r.randint(low, high) for _ in range(n)], 1000
    start = S.best_fit(lengths, size)
    valid(start, lengths, size)
    end = S.local_search(start, lengths, size)
    valid(end, lengths, size)
    assert len(end) <= len(start)
    # from one document a bin, the search alone packs nearly as well
    alone = S.local_search([[i] for i in range(min(n, 120))], lengths[:120], size, 5_000)
    valid(alone, lengths[:120], size)
    assert len(alone) <= len(S.best_fit(lengths[:120], size)) + 1


def test_each_kind_of_exchange():
    def squares(bins, lengths):
        return sum(sum(lengths[i] for i in b) ** 2 for b in bins)

    for lengths, start, bins in (
            ([6, 3], [[0], [1]], 1),                                  # move
            ([7, 2, 1, 5, 3, 2], [[0, 1], [3, 4], [2, 5]], 2),        # moves and one for one
            ([5, 4, 3, 2, 6], [[0, 1], [2, 3], [4]], 2),              # two for one
            ([4, 3, 5, 8], [[0, 1], [2], [3]], 3)):                   # nothing fits better than 3 bins of 10
        end = S.local_search(start, lengths, 10)
        valid(end, lengths, 10)
        assert len(end) == bins and squares(end, lengths) >= squares(start, lengths)


def test_rounds_join_the_blocks_rests(spark):
    r = random.Random(2)
    rows = [(i, 0, 0, r.randint(1, 900), i) for i in range(3_000)]
    cut = spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long").repartition(5)
    got = S.place(cut, size=1000, block_pieces=750).collect()  # five blocks
    assert len(got) == 3_000 and check_layout(got, 1000) <= 1.015 * len(S.best_fit([x[3] for x in rows], 1000))


def test_edges(spark, tokenizer):
    docs = edge_docs(spark)
    got = S.pack(docs, PATH, max_tokens=64, block_pieces=50).collect()
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, i, min(64, n - 64 * i)) for r in docs.collect() for n in [len(ids_of(tokenizer, r["text"]))] for i in range(math.ceil(n / 64)))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["length"]) for r in got) == want
    check_layout(got, 64)
    assert S.pack(empty_docs(spark), PATH).count() == 0


def test_sequences_hold_the_documents_ids(spark, tokenizer):
    docs = spark.createDataFrame([(1, "one two three"), (2, None), (3, "a longer text of some more words, with marks"), (3, "a longer text of some more words, with marks"), (None, "four")],
                                 "doc_id long, text string")
    cut = S.pieces(docs, PATH, max_tokens=8, ids=True)
    placed = S.place(cut.drop("ids"), 8)
    by_sequence = {r["sequence_id"]: np.frombuffer(r["ids"], dtype="<u4").tolist() for r in S.assemble(placed, cut).collect()}
    pieces = {}
    for r in placed.collect():
        part = by_sequence[r["sequence_id"]][r["offset"]: r["offset"] + r["length"]]
        assert zlib.crc32(np.array(part, dtype="<u4").tobytes()) == r["ids_crc32"]
        pieces.setdefault((r["doc_id"], r["piece"]), []).append(part)
    assert sum(pieces[3, 0] + pieces[3, 1], []) == 2 * ids_of(tokenizer, docs.collect()[2]["text"])[:8] + 2 * ids_of(tokenizer, docs.collect()[2]["text"])[8:16]
    assert all(len(s) <= 8 for s in by_sequence.values())


def test_copies_spread_over_blocks(spark):
    cut = spark.range(4_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.lit(300).cast("long").alias("length"),
                                    F.lit(5).cast("long").alias("ids_crc32"))
    got = S.place(cut, size=1000, block_pieces=200).collect()
    assert check_layout(got, 1000) <= 4_000 / 3 + 20
