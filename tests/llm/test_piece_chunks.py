import hashlib
import struct

import public_tokenizers
import pytest
import sentencepiece
from edge import ROWS, edge_docs, empty_docs, texts
from hypothesis import given, settings
from hypothesis import strategies as st

from skein.llm import piece_chunks as P
from skein.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PROTO = P.checked_model(MODEL)


def library(text):
    ids = SP.encode(text or "", add_bos=True, add_eos=True)
    return ids, SP.decode(ids)


def test_query_equals_the_library(spark, sf_dir):
    got = {r["doc_id"]: r for r in QUERIES["op4_piece_chunks"](spark, sf_dir).collect()}
    docs = texts(spark, sf_dir)
    assert got.keys() == docs.keys()
    for i, t in docs.items():
        ids, back = library(t)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()


def test_edges(spark):
    got = P.encode_decode(edge_docs(spark), MODEL, table_chunks=50).collect()
    want = sorted((str(r[0]), *library(r[1])) for r in ROWS)
    assert sorted((str(r["doc_id"]), P.unpacked(r["ids"]), r["decoded"]) for r in got) == want
    assert P.encode_decode(empty_docs(spark), MODEL).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" ab▁é\n\t😀\u0000<s>0x41　�")) | st.characters(exclude_categories=["Cs"]), max_size=40), max_size=4))
def test_any_text(parts):
    table = P.ChunkTable(PROTO, size=7)
    for (ids, back), t in zip(table.encode(parts), parts):
        assert (P.unpacked(ids), back) == library(t)


def test_other_models_are_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(P, "MARK", "e")  # a marker that pieces do cross
    with pytest.raises(ValueError):
        P.checked_model(MODEL)
