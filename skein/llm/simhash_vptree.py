"""SimHash near-duplicates with vantage-point trees over the fingerprints.

A 64-bit fingerprint is the bitwise majority of the XXH64 hashes of a text's word shingles. Two
fingerprints link at ``max_bits`` or fewer differing bits; a document's component is everything
reachable over links.

Search. A difference of at most ``r`` bits leaves at most ``r // 2`` bits in the high or in the
low half, so each half gets a vantage-point tree of its own under the Hamming distance of that
half (a metric), searched with the radius ``r // 2``. Small radii are what makes triangle bounds
prune: in the whole fingerprint nearly all distances from a vantage point lie around 32.

1. A bounded sample of distinct fingerprints (``SAMPLE``) places vantage points and thresholds.
2. Every distinct fingerprint is routed to its home leaf, and along the branches that the
   triangle bounds can't exclude it is sent as a visitor to the other leaves whose region its
   ball overlaps. Two home points on either side of a boundary need to meet once: only the inner
   one crosses. A visitor takes every branch its ball overlaps.
3. A leaf is one group: home points are compared with all members over all 64 bits, and the leaf
   returns a spanning forest of its links, never all pairs. A leaf above ``LEAF_ROWS`` members is
   split into blocks and each pair of blocks is a group, so its size is bounded and no pair is lost.
4. The forests meet in a distributed star contraction (``components``).

Copies share a fingerprint, so all of this runs on distinct fingerprints, whatever the size of a
group of copies. Null and empty texts have the fingerprint zero and link like any other. A null
doc_id never becomes a component id unless its component has no other id (then the id is null);
repeated rows return one row each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import pack, unpack, unsigned, utf8, words
from skein.session import write_table

#: Distinct fingerprints that place the vantage points (2 MB on the driver at most).
SAMPLE = 262_144
#: Sampled points of a tree leaf; a leaf then holds this share of all fingerprints.
SAMPLE_LEAF = 32
#: Members of a leaf that one task compares; larger leaves are compared block by block.
LEAF_ROWS = 32_768
#: Fingerprints of a leaf below which a split costs more than it saves.
MIN_LEAF = 2_048
SEED = 42


def simhash(text: bytes, k: int) -> int:
    """Fingerprint of a whole text; 0 if it has no words."""
    w = words(text)
    if not w:
        return 0
    k = min(k, len(w))
    joined = b" ".join(w)
    lengths = np.fromiter(map(len, w), dtype=np.int64, count=len(w))
    ends = np.cumsum(lengths + 1) - 1
    spans = zip((ends - lengths)[: len(w) - k + 1].tolist(), ends[k - 1:].tolist())
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65_536):  # 4 MB of bits at a time
        part = hashes[at: at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def simhash_column(shingle: int = 3):
    """Column function: text -> fingerprint as a signed long."""

    @F.pandas_udf("long")
    def fingerprint(text: pd.Series) -> pd.Series:
        values = [simhash(t.encode() if t else b"", shingle) for t in text]
        return pd.Series(np.array(values, dtype=np.uint64).view(np.int64))

    return fingerprint


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """doc_id, fp (signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in utf8(b.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return ids.mapInArrow(run, "doc_id long, fp long")


# ---- the tree ------------------------------------------------------------------------------

def build_tree(points: np.ndarray, total: int, sample_leaf: int = SAMPLE_LEAF, min_leaf: int = MIN_LEAF) -> list[tuple]:
    """Nodes (vantage, threshold, inside, outside) of a tree over 32-bit points; a negative child
    is the leaf -1 - child. ``total``: the points that the sample stands for."""
    rng = np.random.default_rng(SEED)
    nodes: list[tuple] = []
    leaves = 0

    def grow(pts: np.ndarray) -> int:
        nonlocal leaves
        share = len(pts) / max(1, len(points)) * total
        if len(pts) > 2 * sample_leaf and share > 2 * min_leaf:
            # the vantage point whose median splits the points best, of a few candidates
            best = None
            for v in rng.integers(0, 2**32, size=8, dtype=np.uint64).astype(np.uint32):
                d = np.bitwise_count(pts ^ v)
                counts = np.bincount(d, minlength=33)
                inner = np.cumsum(counts)
                near = np.abs(inner * 2 - len(pts)) + counts + np.append(counts[1:], 0)
                t = int(np.argmin(near))
                if 0 < inner[t] < len(pts) and (best is None or near[t] < best[0]):
                    best = (near[t], int(v), t, d <= t)
            if best:
                at = len(nodes)
                nodes.append(())
                _, v, t, inside = best
                nodes[at] = (v, t, grow(pts[inside]), grow(pts[~inside]))
                return at
        leaves += 1
        return -leaves

    grow(points)
    return nodes


def route(nodes: list[tuple], points: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indexes of its home points, indexes of its visitors) of a batch of points."""
    todo = [(0 if nodes else -1, np.arange(len(points)), np.arange(0))]
    while todo:
        at, home, visit = todo.pop()
        if not len(home) and not len(visit):
            continue
        if at < 0:
            yield -1 - at, home, visit
            continue
        v, t, inside, outside = nodes[at]
        d = np.bitwise_count(points[home] ^ np.uint32(v)).astype(np.int16)
        e = np.bitwise_count(points[visit] ^ np.uint32(v)).astype(np.int16)
        todo.append((inside, home[d <= t], visit[e - radius <= t]))
        todo.append((outside, home[d > t], np.concatenate([visit[e + radius > t], home[(d <= t) & (d + radius > t)]])))


def halves(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (fp >> np.uint64(32)).astype(np.uint32), (fp & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def routed(distinct: DataFrame, trees: tuple[list, list], radius: int) -> DataFrame:
    """tree, leaf, home, fp: every fingerprint at its home leaf and where it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = unsigned(b.column(0).to_numpy(zero_copy_only=False))
            for tree, points in enumerate(halves(fp)):
                leaf, idx, home = [], [], []
                for at, own, visit in route(trees[tree], points, radius):
                    idx += [own, visit]
                    leaf.append(np.full(len(own) + len(visit), at, dtype=np.int32))
                    home += [np.ones(len(own), dtype=bool), np.zeros(len(visit), dtype=bool)]
                if idx:
                    i, n = np.concatenate(idx), sum(map(len, idx))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, tree, dtype=np.int32)), pa.array(np.concatenate(leaf)),
                         pa.array(np.concatenate(home)), pa.array(fp[i].view(np.int64))], ["tree", "leaf", "home", "fp"])

    return distinct.select("fp").mapInArrow(run, "tree int, leaf int, home boolean, fp long")


def leaf_forest(home: np.ndarray, visit: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between home points and all members."""
    everyone = np.concatenate([home, visit])
    linked = np.zeros(len(everyone), dtype=bool)
    for at in range(0, len(home), 256):
        rows = home[at: at + 256]
        for to in range(at, len(everyone), 4096):
            near = np.bitwise_count(rows[:, None] ^ everyone[None, to: to + 4096]) <= max_bits
            i, j = np.nonzero(near)
            other = i + at != j + to
            linked[i[other] + at] = True
            linked[j[other] + to] = True
    rest, edges = np.unique(everyone[linked]), []
    while len(rest):
        root, rest, stack = rest[0], rest[1:], [rest[0]]
        while stack and len(rest):
            hit = np.bitwise_count(rest ^ stack.pop()) <= max_bits
            if hit.any():
                edges += [(int(x), int(root)) for x in rest[hit]]
                stack += list(rest[hit])
                rest = rest[~hit]
    return edges


def links(distinct: DataFrame, max_bits: int, sample: int = SAMPLE, sample_leaf: int = SAMPLE_LEAF,
          min_leaf: int = MIN_LEAF, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """src, dst: links between distinct fingerprints that connect what lies within ``max_bits``."""
    total = distinct.count()
    picked = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample)
    pts = unsigned(picked.toPandas()["fp"].to_numpy(dtype=np.int64))
    trees = tuple(build_tree(p, total, sample_leaf, min_leaf) for p in halves(pts))
    members = routed(distinct, trees, max_bits // 2)
    # at most two rows per sampled point: bounded by SAMPLE
    blocks = (members.groupBy("tree", "leaf").count()
              .select("tree", "leaf", F.ceil(F.col("count") / leaf_rows).cast("int").alias("blocks")))
    tagged = (members.join(F.broadcast(blocks), ["tree", "leaf"])
              .withColumn("own", F.pmod(F.xxhash64("fp", "tree"), F.col("blocks")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("tree", "leaf", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "home", "fp"))

    def compare(table: pa.Table) -> pa.Table:
        fp, home = unsigned(table.column("fp").to_numpy()), table.column("home").to_numpy()
        edges = leaf_forest(fp[home], fp[~home], max_bits)
        pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.table({"src": pa.array(pairs[:, 0].copy()), "dst": pa.array(pairs[:, 1].copy())})

    return tagged.groupBy("tree", "leaf", "a", "b").applyInArrow(compare, "src long, dst long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable (alternating large-star and small-star steps).

    Each round is written to the shared folder; the rounds grow with the logarithm of a
    component's diameter, and leaf forests are stars already.
    """
    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = write_table(edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
                    .where("u <> v").distinct(), "edges")
    before = mark(e)
    while before[0]:
        both = e.union(e.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = write_table(small.select("u", F.col("m").alias("v"))
                        .union(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                        .where("u <> v").distinct(), "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def groups(fps: DataFrame, max_bits: int, **tree) -> DataFrame:
    """fp, root, component_id for every distinct fingerprint of (doc_id, fp) rows."""
    distinct = write_table(fps.groupBy("fp").agg(F.min("doc_id").alias("lead")), "fingerprints")
    roots = components(links(distinct, max_bits, **tree))
    rooted = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
              .select("fp", "lead", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("lead").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3, **tree) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row."""
    fps = write_table(fingerprints(docs, doc_id, text, shingle), "simhash")
    found = groups(fps, max_bits, **tree)
    return (fps.join(found, "fp", "left")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3,
             **tree) -> DataFrame:
    """``docs`` with one document of each component: the smallest (doc_id, hash of the row), nulls
    last; of rows equal in every column one stays."""
    # A null id sorts last, and equal ids fall back on the hash of the whole row.
    order = F.struct(F.col(f"__row.{doc_id}").isNull().alias("a"), F.col(f"__row.{doc_id}").cast("long").alias("b"),
                     F.xxhash64(*[F.col(f"__row.`{c}`") for c in docs.columns]).alias("c"))
    packed = pack(docs)
    packed = packed.withColumn("__fp", simhash_column(shingle)(F.col(f"__row.{text}"))).withColumn("__key", order)
    keys = write_table(packed.select(F.col("__fp").alias("fp"), F.col("__key.b").alias("doc_id"), F.col("__key").alias("key")), "simhash")
    found = groups(keys, max_bits, **tree)
    best = keys.groupBy("fp").agg(F.min("key").alias("key")).join(found, "fp")
    best = best.groupBy("root").agg(F.min(F.struct("key", "fp")).alias("best")).select("best.fp", "best.key")
    stay = packed.join(best, (packed["__fp"] == best["fp"]) & (packed["__key"] == best["key"]))
    return unpack(stay.dropDuplicates(["__fp", "__key"]))
