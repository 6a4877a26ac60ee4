"""Exact top-k over weighted postings, with bounds.

A query is a set of weighted terms, an item's score the sum of ``wq * w`` over the terms it
shares with the query. The postings of a term are grouped into **levels** of similar weight
(``LEVELS`` an octave); a small table holds each level's row count and its greatest weight, so a
level's contribution to a query's scores is bounded by ``wq * ub`` before a posting is read.

1. *Seed.* Each query reads its strongest levels until they hold some multiple of k postings. The
   exact scores of the k best items found there give a threshold: the k-th best of any k items.
2. *Skip.* If every term kept only contributions below x, an item that shows in none of the
   others' levels would score at most the sum of ``min(x, strongest level)`` over the terms. The
   greatest x that keeps this sum below the threshold is found in closed form; levels below x are
   not read for this query.
3. *Collect.* The other levels are joined and summed. What an item could still have in skipped
   levels of terms it was not seen with bounds its score; items whose bound is below the threshold
   (raised to the k-th best sum found) are out.
4. *Complete.* The scores of the few items left are summed over all their terms, through the item
   column of the postings, and ranked.

Nothing is capped: a query without a threshold (fewer than k items) reads all its levels. Levels
need neither a sort nor a window over a term's postings, so a term that every item has is no hot
key, and levels change only by counts when postings are added.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.session import cut_lineage

#: Levels an octave of weight.
LEVELS = 4
#: Postings that the seed of a query reads, in multiples of k.
SEED_POSTINGS = 8
#: Share of the threshold that wholly skipped terms may add.
WHOLE_TERMS = 0.5
#: Slack of every comparison of bounds: scores are rounded to 9 places.
SLACK = 1e-7


def level_of(weight: Column) -> Column:
    """Level of a positive weight (0 for 1, greater for smaller weights)."""
    return F.floor(-LEVELS * F.log2(weight)).cast("int")


def levels_table(postings: DataFrame, terms: list[str]) -> DataFrame:
    """(terms..., level, n, ub): one row per term and level, by partial aggregation."""
    return postings.groupBy(*terms, "level").agg(F.count(F.lit(1)).alias("n"), F.max("w").alias("ub"))


@dataclass
class TopK:
    """The steps of one batch (lazy but for the small tables that several steps read)."""
    query: DataFrame        # query columns, term columns, wq
    postings: DataFrame     # term columns, item, w, level
    chosen: DataFrame | None  # levels that are read: query, terms, level, wq, rest (None: all, no bounds)
    bounds: DataFrame | None  # per query: threshold, rest_sum, skipped
    read: int               # postings joined for the collecting step
    hits: DataFrame         # query, item, score, rank


def _score_exactly(candidates: DataFrame, query: DataFrame, postings: DataFrame, by: list[str], terms: list[str], item: str, digits: int) -> DataFrame:
    """(query, item, score) of given (query, item) pairs. The candidates meet the postings by item,
    so only postings of candidate items go on to the join with the query's terms."""
    met = postings.select(*terms, item, "w").join(candidates.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(item).alias("_item")), F.col(item) == F.col("_item"))
    on = [F.col(f"_{c}") == F.col(f"q_{c}") for c in by] + [F.col(c) == F.col(f"q_{c}") for c in terms]
    q = query.select(*[F.col(c).alias(f"q_{c}") for c in dict.fromkeys(by + terms)], "wq")
    scored = met.join(q, on).groupBy(*[F.col(f"q_{c}").alias(c) for c in by], item)
    return scored.agg(F.round(F.sum(F.col("wq") * F.col("w")), digits).alias("score"))


def best(scored: DataFrame, by: list[str], item: str, k: int, score: str = "score") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc(score), F.asc(item))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def run(query: DataFrame, postings: DataFrame, levels: DataFrame, k: int, by: list[str], terms: list[str], item: str,
        digits: int = 9, allowed: Callable[[], Column] | None = None, count_read: bool = False) -> TopK:
    """Top k items of each query by score descending, item ascending.

    ``query`` has the columns ``by`` (its key), ``terms`` (join columns; they may overlap with
    ``by``) and ``wq``, a positive weight, once per query and term. ``allowed`` is a condition on
    query and item columns that a hit must meet. ``count_read`` counts the collected postings."""
    keys = list(dict.fromkeys(by + terms))

    def permitted(df: DataFrame) -> DataFrame:
        return df.where(allowed()) if allowed else df

    # every level that a query's terms have, with the bound of its contribution
    bounded = cut_lineage(query.join(levels, terms).select(*keys, "level", "wq", "n", (F.col("wq") * F.col("ub")).alias("c")))

    # 1 seed
    strongest = Window.partitionBy(*by).orderBy(F.desc("c"), *[c for c in terms if c not in by], "level")
    seed = bounded.withColumn("before", F.coalesce(F.sum("n").over(strongest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    seed = seed.where(F.col("before") < SEED_POSTINGS * k).select(*keys, "level", "wq")
    found = permitted(seed.join(postings, [*terms, "level"]))
    partial = found.groupBy(*by, item).agg(F.sum(F.col("wq") * F.col("w")).alias("p"))
    first = cut_lineage(best(partial, by, item, k, "p").select(*by, item))
    exact = _score_exactly(first, query, postings, by, terms, item, digits)
    threshold = exact.groupBy(*by).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n_seed")) \
                     .select(*by, F.when(F.col("n_seed") >= k, F.col("least") - SLACK).otherwise(F.lit(-1.0)).alias("threshold"))

    # 2 skip: whole terms with the most postings for what they may add, up to a share of the
    # threshold; of the others, all levels below x = max over i of (what is left of the threshold -
    # the sum of the i weakest terms) / (the number of the other terms)
    per_term = bounded.groupBy(*keys).agg(F.max("c").alias("top"), F.sum("n").alias("df")).join(threshold, by, "left") \
                      .withColumn("threshold", F.coalesce("threshold", F.lit(-1.0)))
    own = [c for c in terms if c not in by]
    cheap = Window.partitionBy(*by).orderBy(F.col("top") / F.col("df"), *own)
    per_term = per_term.withColumn("whole", F.sum("top").over(cheap.rowsBetween(Window.unboundedPreceding, 0)) <= WHOLE_TERMS * F.col("threshold"))
    per_query = Window.partitionBy(*by)
    per_term = per_term.withColumn("left_over", F.col("threshold") - F.coalesce(F.sum(F.when(F.col("whole"), F.col("top"))).over(per_query), F.lit(0.0)))
    rising = Window.partitionBy(*by, "whole").orderBy("top", *own)
    weaker = F.coalesce(F.sum("top").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    others = F.count(F.lit(1)).over(Window.partitionBy(*by, "whole")) - F.row_number().over(rising) + 1
    cut = cut_lineage(per_term.withColumn("step", (F.col("left_over") - weaker) / others)
                      .withColumn("x", F.when(F.col("whole"), F.lit(float("inf"))).otherwise(F.max("step").over(Window.partitionBy(*by, "whole"))))
                      .select(*keys, "threshold", "x"))
    with_cut = bounded.join(cut, keys)
    skipped = F.col("c") < F.col("x")
    rest = with_cut.where(skipped).groupBy(*keys).agg(F.max("c").alias("rest"))  # what a skipped level of the term may add
    rests = rest.groupBy(*by).agg(F.sum("rest").alias("rest_sum"))
    bounds = cut_lineage(cut.select(*by, "threshold").distinct().join(rests, by, "left").select(*by, "threshold", F.coalesce("rest_sum", F.lit(0.0)).alias("rest_sum")))
    chosen = cut_lineage(with_cut.where(~skipped).join(rest, keys, "left").select(*keys, "level", "wq", "n", F.coalesce("rest", F.lit(0.0)).alias("rest")))
    read = (chosen.agg(F.sum("n")).first()[0] or 0) if count_read else -1

    # 3 collect: sum of contributions, and of what the seen terms can no longer add
    sums = permitted(chosen.drop("n").join(postings, [*terms, "level"])).groupBy(*by, item) \
        .agg(F.sum(F.col("wq") * F.col("w")).alias("p"), F.sum("rest").alias("seen_rest"))
    sums = cut_lineage(_bounded_by_best(sums, bounds, by, k))
    # 4 complete; where nothing was skipped the sums are the scores
    done = sums.where(F.col("rest_sum") == 0).select(*by, item, F.round("p", digits).alias("score"))
    open_ = _score_exactly(sums.where(F.col("rest_sum") > 0).select(*by, item), query, postings, by, terms, item, digits)
    return TopK(query, postings, chosen, bounds, read, best(done.unionByName(open_), by, item, k))


def _bounded_by_best(sums: DataFrame, bounds: DataFrame, by: list[str], k: int) -> DataFrame:
    """Items whose bound reaches the threshold. The k-th best sum is a lower bound of the k-th best
    score too; ``WindowGroupLimit`` keeps the k best a partition before they move."""
    kept = sums.join(bounds, by).where(F.col("p") + F.col("rest_sum") - F.col("seen_rest") >= F.col("threshold"))
    w = Window.partitionBy(*by).orderBy(F.desc("p"))
    kth = kept.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).groupBy(*by) \
              .agg(F.when(F.count(F.lit(1)) >= k, F.min("p") - SLACK).otherwise(F.lit(-1.0)).alias("kth"))
    return kept.join(kth, by).where(F.col("p") + F.col("rest_sum") - F.col("seen_rest") >= F.col("kth"))
