"""Full-text search over graph nodes and relationships.

The index is a set of plain tables:

* ``items(kind, item_id, dl, words, tfs, terms)`` – one row per item with its term counts;
  ``postings(kind, item_id, term, tf, dl)`` is its long form, one row per term of an
  item, carrying the item length so scoring needs no second join;
* ``term_stats(kind, term, df)`` – document frequency per term;
* ``corpus_stats(kind, n_items, avgdl)`` – one row per kind.

A query is a table of prompts. Non-final prompt terms match exactly; the
final term is fuzzy (edit distance <= 2 with swaps of neighbours as one edit, weight ``1 - d / min(len)``, at most
50 expansions). Scores are BM25 (k1 = 1.2, b = 0.75), summed per item and
rounded to 9 places before any ranking or cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.functions.text import terms
from skein.operators import term_rows, topk
from skein.session import cut_lineage, write_table

# Fixed values of the scoring model.
BM25_K1 = 1.2
BM25_B = 0.75
MAX_EDITS = 2
MAX_EXPANSIONS = 50
# Distinct fuzzy terms of a batch whose pieces are broadcast (some 10 KB each).
MAX_FUZZY_TERMS = 5_000
# (prompt, kind, term) rows of a batch that are broadcast (some 100 bytes each).
MAX_ASKED = 500_000
TOP_HITS = 40
SCORE_DIGITS = 9

NODE = "node"
EDGE = "edge"


# ------------------------------------------------------------------ B1 index

def index_items(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(kind, item_id, text): node text = name ' ' description; edge text = description."""
    n = nodes.select(F.lit(NODE).alias("kind"), F.col("node_id").alias("item_id"),
                     F.concat_ws(" ", "name", "description").alias("text"))
    e = edges.select(F.lit(EDGE).alias("kind"), F.col("edge_id").alias("item_id"),
                     F.col("description").alias("text"))
    return n.unionByName(e)


def postings(items: DataFrame) -> DataFrame:
    """(kind, item_id, term, tf, dl). Items without any term have no row.

    No text is shuffled: an item is one row, so the partial aggregation already
    counts its terms and only (item, term, tf) goes through the exchange."""
    toks = items.select("kind", "item_id", terms("text").alias("toks"))
    toks = toks.select("kind", "item_id", F.size("toks").alias("dl"),
                       F.explode("toks").alias("term"))
    return toks.groupBy("kind", "item_id", "term").agg(
        F.count(F.lit(1)).alias("tf"), F.first("dl").alias("dl"))


def term_stats(post: DataFrame) -> DataFrame:
    return post.groupBy("kind", "term").agg(F.count(F.lit(1)).alias("df"))


def corpus_stats(post: DataFrame) -> DataFrame:
    per_item = post.groupBy("kind", "item_id").agg(F.first("dl").alias("dl"))
    return per_item.groupBy("kind").agg(F.count(F.lit(1)).alias("n_items"),
                                        F.avg("dl").alias("avgdl"))


_ITEM = ["kind", "item_id"]


@dataclass
class FullTextIndex:
    postings: DataFrame
    corpus: DataFrame
    items: DataFrame                 # the postings, one row per item
    vocab: DataFrame | None = None   # counted when first asked for
    levels: DataFrame | None = None  # stored by ``save``; otherwise counted for a batch's terms

    @property
    def terms(self) -> DataFrame:
        """(kind, term, df), written when first asked for."""
        if self.vocab is None:
            self.vocab = write_table(term_rows.item_counts(self.items, "kind"), "vocab")
        return self.vocab

    def weighted(self) -> DataFrame:
        """(kind, term, item_id, w, level): the part of a term's BM25 weight that depends on the item."""
        norm = F.col("tf") / (F.col("tf") + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / F.col("avgdl")))
        rows = self.postings.join(F.broadcast(self.corpus.select("kind", "avgdl")), "kind")  # 1 row per kind
        return rows.select("kind", "term", "item_id", norm.alias("w"), topk.level_of(norm).alias("level"))

    def levels_of(self, query: DataFrame) -> DataFrame:
        """(kind, term, level, n, ub) of a batch's terms: from the stored table, or counted here
        (the postings of these terms meet a partial aggregate and never an exchange)."""
        if self.levels is not None:
            return self.levels
        asked = query.select("kind", "term").distinct()
        return topk.levels_table(self.weighted().join(asked, ["kind", "term"], "left_semi"), ["kind", "term"])

    @classmethod
    def build(cls, nodes: DataFrame, edges: DataFrame, materialize: bool = True) -> "FullTextIndex":
        """Index the graph. With ``materialize`` an item's terms are counted where its text is
        read and written once as one row to the shared checkpoint folder: nothing is shuffled
        but the ids, which shows items that have several rows."""
        if not materialize:
            post = postings(index_items(nodes, edges))
            return cls(post, corpus_stats(post), term_rows.grouped(post, _ITEM), term_stats(post))
        items = term_rows.term_rows(index_items(nodes, edges), _ITEM, "text")
        corpus = items.groupBy("kind").agg(F.count(F.lit(1)).alias("n_items"), F.avg("dl").alias("avgdl"))
        return cls(term_rows.long_form(items, _ITEM), cut_lineage(corpus), items)

    def save(self, path: str) -> None:
        """Persist the index as parquet tables, partitioned by kind and sorted
        by term inside each file (term filters then skip row groups)."""
        self.postings.sortWithinPartitions("kind", "term").write.mode("overwrite").partitionBy("kind") \
            .parquet(f"{path}/postings")
        stored = self.items.drop("terms") if "words" in self.items.columns else self.items
        stored.write.mode("overwrite").partitionBy("kind").parquet(f"{path}/items")
        self.terms.sortWithinPartitions("kind", "term").write.mode("overwrite").partitionBy("kind") \
            .parquet(f"{path}/terms")
        self.corpus.write.mode("overwrite").parquet(f"{path}/corpus")
        topk.levels_table(self.weighted(), ["kind", "term"]).sortWithinPartitions("kind", "term") \
            .write.mode("overwrite").partitionBy("kind").parquet(f"{path}/levels")

    @classmethod
    def load(cls, spark, path: str) -> "FullTextIndex":
        tables = [spark.read.parquet(f"{path}/{name}") for name in ("postings", "corpus", "items", "terms", "levels")]
        return cls(*tables[:2], term_rows.with_terms(tables[2]), *tables[3:])


# ------------------------------------------------------------ B2 query terms

def query_terms(prompts: DataFrame) -> DataFrame:
    """(prompt_id, pos, term, is_fuzzy): the last term of each prompt is fuzzy."""
    t = prompts.select("prompt_id", terms("prompt").alias("toks"))
    return t.select("prompt_id", F.size("toks").alias("n"),
                    F.posexplode("toks").alias("pos", "term")) \
            .select("prompt_id", "pos", "term", (F.col("pos") == F.col("n") - 1).alias("is_fuzzy"))


# ----------------------------------------------------------- B3 fuzzy expand

def _cut(part: str | int) -> str:
    """SQL: 0-based start of the ``part``-th even piece of a word of ``m`` characters.

    A distance below the shorter length is needed, so at most ``min(2, m - 1)`` edits
    count and the word has one piece more than that."""
    return f"cast(floor({part} * m / (least({MAX_EDITS}, m - 1) + 1)) as int)"


#: Pieces of an index term: (its length, piece number, piece), at most three.
_TERM_PIECES = f"""
    slice(array({', '.join(f"concat_ws('/', m, {p}, substr(term, {_cut(p)} + 1, {_cut(p + 1)} - {_cut(p)}))" for p in range(MAX_EDITS + 1))}),
          1, least({MAX_EDITS}, m - 1) + 1)"""

#: Where a piece of an index term can show in a query term of length n, for every term length
#: m within the bound. Of k + 1 pieces with k edits there is a whole one, number p, with at most
#: p edits before and k - p behind it, so it is moved by s with |s| <= p and |n - m - s| <= k - p.
_PLACES = f"""
    flatten(transform(sequence(greatest(n - {MAX_EDITS}, 1), n + {MAX_EDITS}), m ->
        flatten(transform(sequence(0, least({MAX_EDITS}, m - 1)), p ->
            filter(transform(filter(sequence(-p, p), s -> abs(n - m - s) <= least({MAX_EDITS}, m - 1) - p),
                             s -> named_struct('m', m, 'p', p, 'at', {_cut('p')} + s, 'len', {_cut('(p + 1)')} - {_cut('p')})),
                   x -> x.at >= 0 AND x.at + x.len <= n)))))"""

#: The query term's characters there: as they are, or with the first, the last or both
#: taken from beyond the piece, which undoes a swap across the piece's ends.
_QUERY_PIECES = f"""
    array_distinct(flatten(transform({_PLACES}, x -> transform(
        filter(array(substr(term, x.at + 1, x.len),
                     if(x.at >= 1, concat(substr(term, x.at, 1), substr(term, x.at + 2, x.len - 1)), null),
                     if(x.at + x.len < n, concat(substr(term, x.at + 1, x.len - 1), substr(term, x.at + x.len + 1, 1)), null),
                     if(x.at >= 1 AND x.at + x.len < n AND x.len >= 2,
                        concat(substr(term, x.at, 1), substr(term, x.at + 2, x.len - 2), substr(term, x.at + x.len + 1, 1)), null)),
               y -> y is not null),
        y -> concat_ws('/', x.m, x.p, y)))))"""


def _candidates(query: DataFrame, vocab: DataFrame) -> DataFrame:
    """(query_term, kind, term): an equi-join on pieces of the index terms; a pair with several equal
    pieces comes as often.

    Two edits leave one of a term's three pieces whole, moved by at most two places; a swap
    across a piece's end leaves the piece as one of the query side's widened keys. An index
    term has at most three keys; the many places where a piece can lie are generated from the
    distinct query terms, the small side, which is broadcast when a batch allows it: the index
    terms, which grow with the corpus, then meet it where they are read."""
    query = cut_lineage(query.select("query_term"))
    q = query.select("query_term", F.col("query_term").alias("term"), F.length("query_term").alias("n"))
    q = q.select("query_term", F.explode(F.expr(_QUERY_PIECES)).alias("key"))
    if query.count() <= MAX_FUZZY_TERMS:
        q = F.broadcast(q)
    v = vocab.select("kind", "term").withColumn("m", F.length("term"))
    v = v.select("kind", "term", F.explode(F.expr(_TERM_PIECES)).alias("key"))
    return v.join(q, "key").select("query_term", "kind", "term")


def _one_swap(a: str, b: str) -> str:
    """SQL: ``b`` is ``a`` with two neighbours swapped."""
    return f"""(length({a}) = length({b}) AND {a} <> {b} AND exists(sequence(1, greatest(length({a}) - 1, 1)),
        j -> {b} = concat(substr({a}, 1, j - 1), substr({a}, j + 1, 1), substr({a}, j, 1), substr({a}, j + 2))))"""


def edit_distance(a: str, b: str) -> F.Column:
    """Optimal string alignment distance of two string columns: insertions, deletions,
    substitutions and swaps of neighbours count 1 and no part is edited twice. Exact up to
    ``MAX_EDITS`` (2); a greater distance gives 3.

    The plain distance (built in, banded) decides first: 0 and 1 are final, and above 4 two
    swaps can't do it. At 3 a swap leaves one other edit, at 4 only a second swap, so at most 4
    less the distance of either's characters may be missing from the other. Then a swap at i splits ``a`` in two: the pair must stand in ``b``
    behind the same beginning or before the same end, and the other side may have one edit."""
    head, pair, tail = f"substr({a}, 1, i - 1)", f"concat(substr({a}, i + 1, 1), substr({a}, i, 1))", f"substr({a}, i + 2)"
    rest, front = f"substr({b}, i + 2)", f"substr({b}, 1, greatest(length({b}) - length({a}) + i - 1, 0))"

    def near(x: str, y: str) -> str:
        return f"(levenshtein({x}, {y}, 1) >= 0 OR {_one_swap(x, y)})"

    swapped = f"""exists(sequence(1, greatest(length({a}) - 1, 1)), i ->
        (startswith({b}, concat({head}, {pair})) AND {near(tail, rest)}) OR (endswith({b}, concat({pair}, {tail})) AND {near(head, front)}))"""
    strange = " AND ".join(f"length({x}) <= 4 - d" for x in (f"translate({a}, {b}, '')", f"translate({b}, {a}, '')"))
    # the plain distance is an argument of a lambda, so it is computed once a pair
    return F.expr(f"""
        get(transform(array(levenshtein({a}, {b}, {2 * MAX_EDITS})), d ->
            CASE WHEN d < 0 THEN 3 WHEN d < 2 THEN d WHEN d = 2 THEN if({_one_swap(a, b)}, 1, 2)
                 WHEN length({a}) >= 2 AND abs(length({a}) - length({b})) <= 4 - d AND {strange} AND {swapped} THEN 2 ELSE 3 END), 0)""")


def fuzzy_expand(qterms: DataFrame, vocab: DataFrame,
                 max_expansions: int = MAX_EXPANSIONS) -> DataFrame:
    """(prompt_id, kind, pos, query_term, term, distance, weight) for fuzzy terms.

    Expansion, distance check and the cut to ``max_expansions`` work on the
    distinct query terms; only the kept expansions are joined back to the
    prompts, so prompts that share a term cost one term.
    """
    fz = qterms.where("is_fuzzy").select("prompt_id", "pos", F.col("term").alias("query_term"))
    cand = _candidates(fz.select("query_term").distinct(), vocab)
    minlen = F.least(F.length("term"), F.length("query_term"))
    # the plain distance drops most pairs where they are found; only near pairs are shuffled
    scored = (cand.where(F.levenshtein("term", "query_term", 2 * MAX_EDITS) >= 0)
                  .withColumn("distance", edit_distance("term", "query_term"))
                  .where(F.col("distance") < F.least(minlen, F.lit(MAX_EDITS + 1)))
                  .withColumn("weight", F.lit(1.0) - F.col("distance") / minlen).distinct())
    w = Window.partitionBy("kind", "query_term").orderBy(F.desc("weight"), F.asc("term"))
    kept = scored.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_expansions).drop("_rn")
    return fz.join(kept, "query_term").select("prompt_id", "kind", "pos", "query_term", "term", "distance", "weight")


def expanded_terms(qterms: DataFrame, vocab: DataFrame) -> DataFrame:
    """Exact terms (weight 1, both kinds) plus fuzzy expansions."""
    exact = (qterms.where(~F.col("is_fuzzy"))
                   .withColumn("kind", F.explode(F.array(F.lit(NODE), F.lit(EDGE))))
                   .select("prompt_id", "kind", "pos", F.col("term").alias("query_term"), "term",
                           F.lit(0).alias("distance"), F.lit(1.0).alias("weight")))
    return exact.unionByName(fuzzy_expand(qterms, vocab))


# ------------------------------------------------------------ B4 / B5 search

def weigh_query(expanded: DataFrame, index: FullTextIndex) -> DataFrame:
    """(prompt_id, kind, term, wq): each prompt's distinct terms with the part of their BM25 weight
    that does not depend on the item (a term at several places counts as often)."""
    q = cut_lineage(expanded.groupBy("prompt_id", "kind", "term").agg(F.sum("weight").alias("weight")))
    asked = F.broadcast(q) if q.count() <= MAX_ASKED else q  # checked: the corpus's terms are not shuffled for a batch
    q = asked.join(index.terms, ["kind", "term"]).join(F.broadcast(index.corpus), "kind")  # corpus: 1 row per kind
    idf = F.log(F.lit(1.0) + (F.col("n_items") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return q.select("prompt_id", "kind", "term", (F.col("weight") * idf).alias("wq"))


def _product(query: DataFrame, index: FullTextIndex, k: int | None = None) -> DataFrame:
    """(prompt_id, kind, item_id, score) of the item rows' product with a batch that fits every task."""
    average = {r["kind"]: r["avgdl"] for r in index.corpus.collect()}  # 1 row per kind

    def weigh(b, row):
        tf, dl = b.column("tfs").flatten().to_numpy(), b.column("dl").to_numpy()
        return tf / (tf + BM25_K1 * (1 - BM25_B + BM25_B * dl / average[b.column("kind")[0].as_py()])[row])

    asked = query.where(F.col("prompt_id").isNotNull()).toArrow()
    raw = term_rows.scores(index.items, asked, "prompt_id", "item_id", weigh, k, group="kind")
    return raw.withColumn("score", F.round("score", SCORE_DIGITS))


def search(expanded: DataFrame, index: FullTextIndex) -> DataFrame:
    """(prompt_id, kind, item_id, score) – BM25 summed over matched terms, for every hit. An item is one
    row, so its scores are summed where it is read and no hit is shuffled; a batch that is too large
    for a task meets the postings by term."""
    query = cut_lineage(weigh_query(expanded, index))
    if query.count() <= term_rows.MAX_QUERY_ROWS:
        return _product(query, index)
    hits = query.join(index.weighted(), ["kind", "term"])
    return (hits.groupBy("prompt_id", "kind", "item_id")
                .agg(F.round(F.sum(F.col("wq") * F.col("w")), SCORE_DIGITS).alias("score")))


def best_hits(expanded: DataFrame, index: FullTextIndex, k: int = TOP_HITS, count_read: bool = False) -> topk.TopK:
    """The k best hits per (prompt, kind): each task keeps its own k best of the product, so only those
    are shuffled; a batch that is too large for a task is searched with bounds (``operators.topk``)."""
    query = cut_lineage(weigh_query(expanded, index))
    by = ["prompt_id", "kind"]
    if query.count() > term_rows.MAX_QUERY_ROWS:
        return topk.run(query, index.weighted(), index.levels_of(query), k, by, ["kind", "term"], "item_id", SCORE_DIGITS, count_read=count_read)
    # a posting is read once a batch
    read = (query.select("kind", "term").distinct().join(index.terms, ["kind", "term"]).agg(F.sum("df")).first()[0] or 0) if count_read else -1
    return topk.TopK(query, index.weighted(), None, None, read, topk.best(_product(query, index, k), by, "item_id", k))


# ---------------------------------------------------- B6-B9 top, stats, cut

def top_hits(hits: DataFrame, k: int = TOP_HITS) -> DataFrame:
    """Best k per (prompt, kind) of scored hits by score desc, item id asc (WindowGroupLimit)."""
    w = Window.partitionBy("prompt_id", "kind").orderBy(F.desc("score"), F.asc("item_id"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def score_stats(top: DataFrame, std_multiplier: float = 1.0) -> DataFrame:
    """Adds max_score, avg_score, std_score (population) and threshold."""
    w = Window.partitionBy("prompt_id", "kind")
    out = (top.withColumn("max_score", F.max("score").over(w))
              .withColumn("avg_score", F.avg("score").over(w))
              .withColumn("std_score", F.stddev_pop("score").over(w)))
    return out.withColumn("threshold", F.round(F.col("max_score") - std_multiplier * F.col("std_score"),
                                               SCORE_DIGITS))


def cluster_cut(stats: DataFrame) -> DataFrame:
    """Keep hits with score >= max - k * stddev; adds relative_score."""
    return (stats.where(F.col("score") >= F.col("threshold"))
                 .withColumn("relative_score", F.col("score") / F.col("max_score")))


def kept_hits(prompts: DataFrame, index: FullTextIndex, top_k: int = TOP_HITS,
              std_multiplier: float = 1.0) -> DataFrame:
    """Prompts to cut hits of both kinds: B2 -> B3 -> B4/B5 -> B6 -> B7 -> B8 -> B9."""
    exp = expanded_terms(query_terms(prompts), index.terms)
    return cluster_cut(score_stats(best_hits(exp, index, top_k).hits, std_multiplier))
