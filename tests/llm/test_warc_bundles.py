import base64
import hashlib
import os

import zstandard
from edge import texts

from skein.llm import warc_bundles as W
from skein.llm.queries import QUERIES, new_folder

PAGES = [(3, "http://a/", "<p>same</p>"), (1, "http://b/\r\nX: y", "<p>same</p>"), (2, None, None), (5, "u", ""), (6, "u", "é" * 300_000),
         (6, "u", "é" * 300_000), (None, "u", "<p>same</p>"), (None, "u", "alone"), (9, "u", "WARC/1.1\r\n\r\nnot a record\r\n\r\n"), (8, "u", None)]


def expected(rows, min_revisit=0):
    first = {}
    for i, h in rows:
        d = (h or "").encode()
        if i is not None:
            first[d] = min(first.get(d, i), i)
    out = []
    for i, h in rows:
        d = (h or "").encode()
        to = None if first.get(d) == i or len(d) < min_revisit else first.get(d)
        out.append((str(i), len(d), base64.b32encode(hashlib.sha1(d).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark, sf_dir):
    got = QUERIES["op5_warc_bundles"](spark, sf_dir).collect()
    assert sorted(((str(r[0]), *r[1:]) for r in got), key=str) == expected(texts(spark, sf_dir, "pages", "page_id", "html").items())


def test_edges_and_payloads(spark):
    from pyspark.sql import functions as F
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("mine")).withColumn("first", F.lit(1))
    folder = new_folder(spark, "warc-test")
    for n in (0, 5):
        W.write(pages, folder + str(n), min_revisit=n, frame_bytes=300, bundle_bytes=2000)
        back = W.read(spark, folder + str(n)).collect()
        got = sorted(((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in back), key=str)
        assert got == expected([(i, h) for i, _, h in PAGES], n)
    kept = {(r["page_id"], bytes(r["payload"]).decode()) for r in back if r["record_type"] == "response"}
    assert (6, "é" * 300_000) in kept and (9, PAGES[8][2]) in kept
    assert {r["url"] for r in back if r["page_id"] == 1} == {"http://b/%0D%0AX: y"}
    one = W.lookup(spark, folder + "5", spark.createDataFrame([(9,), (3,), (77,)], "page_id long")).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in one) == [(3, "revisit", 1), (9, "response", None)]
    assert W.orphans(spark, folder + "5") == []
    none = spark.createDataFrame([], "page_id long, url string, html string")
    W.write(none, folder + "none")
    assert W.read(spark, folder + "none").count() == 0 and W.orphans(spark, folder + "none") == []


def test_frames_are_independent_and_the_stream_is_plain_zstd(spark, sf_dir):
    from skein.sources.tables import read_table
    folder = new_folder(spark, "warc-test")
    W.write(read_table(spark, sf_dir, "pages"), folder, frame_bytes=20_000)
    path = folder.removeprefix("file://") + "/bundles/"
    for name in os.listdir(path):
        with open(path + name, "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole.startswith(b"WARC/1.1\r\n") and len(list(W.records(whole))) >= 1
