"""Registered queries of this subpackage: callables (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.common import held_out
from skein.session import checkpoint_dir
from skein.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable) -> Callable:
    QUERIES[f.__name__] = f
    return f


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared one."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query
def op1_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.simhash_vptree import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, max_bits=3)


@query
def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.imatch import lexicon, robustness
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return robustness(docs, lexicon(docs.select("text")))


@query
def op3_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.backoff_lm import held_out_scores
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return held_out_scores(docs, held_out(F.col("doc_id"), 7, 2))


@query
def op4_piece_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from skein.llm.piece_chunks import encode_decode
    coded = encode_decode(read_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm import warc_bundles
    folder = new_folder(spark, "warc")
    warc_bundles.write(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder, min_revisit=0)
    back = warc_bundles.read(spark, folder, payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.kn_quality import score
    scored = score(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"), read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    return scored.select("doc_id", "lang", "n_tokens", "perplexity", "smoothed", "threshold", "kept")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.toxicity import held_out_scores
    return held_out_scores(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


@query
def op8_aho_corasick(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.decontaminate import matches
    found = matches(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.virtual_slots import shard_documents
    return shard_documents(read_table(spark, sf_dir, "documents", "doc_id", "text"), shards=16)


@query
def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.license_rules import scan
    return scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op11_polarisation_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.whitening import whiten
    return whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"), components=32)


@query
def op12_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from skein.llm.swap_packing import pack
    packed = pack(read_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), max_tokens=4096, end_id=1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op13_counted_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skein.llm.fill_in_middle import digests
    return digests(read_table(spark, sf_dir, "documents", "doc_id", "text"), seed=42, rate=50, spm_rate=80)
