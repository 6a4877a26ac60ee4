"""Global row numbering without a single-task window.

``row_number()`` over a window without ``partitionBy`` (or with only a few
groups) sorts everything in one task. ``with_row_index`` gives the same
numbers with a range-partitioned sort: every partition numbers its rows
locally, a tiny table of per-partition counts gives the running offsets, and
the offsets join back. Only that count table (at most partitions + groups
rows) is combined in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.session import cut_lineage

MAX_OFFSETS = 200_000  # offset rows that are broadcast
_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row in partition


#: Common beginnings are looked at this many times as far.
LONGER = 16


def _range_by_beginnings(df: DataFrame, n: int, groups: list, key: str, chars: int) -> DataFrame:
    """Range partitions by the beginnings of ``key``, the longer ones where many rows share one."""
    short = F.substring(key, 1, chars)
    counts = cut_lineage(df.groupBy(short.alias("_begin")).agg(F.count(F.lit(1)).alias("_n")))
    common = counts.where(F.col("_n") * 4 * n > (counts.agg(F.sum("_n")).first()[0] or 0))  # fewer than 4 n rows
    marked = df.withColumn("_begin", short).join(F.broadcast(common.select("_begin", F.lit(True).alias("_common"))), "_begin", "left")
    begin = F.when(F.col("_common"), F.substring(key, 1, LONGER * chars)).otherwise(F.col("_begin"))
    return marked.withColumn("_begin", begin).repartitionByRange(n, *groups, "_begin").drop("_begin", "_common")


def with_row_index(df: DataFrame, order_by: list, name: str = "row_idx",
                   group_by: list | None = None,
                   num_partitions: int | None = None,
                   boundary_chars: int | None = None) -> DataFrame:
    """Add ``name``: 0-based position of the row in ``order_by`` order,
    restarting per ``group_by`` (meant for few groups: classes, sources).

    ``order_by`` must make the order total (end it with a unique key), so the
    result does not depend on partitioning and is recomputed identically after
    an executor loss.

    Spark samples range keys on the driver. For long string keys ``boundary_chars`` bounds what
    is sampled: boundaries are found on the first key's beginning alone, rows with an equal
    beginning share a partition, and the full keys order the rows inside it. (Beginnings are
    ordered as the keys are, so partitions stay in order; no tie lies across a boundary. Beginnings
    that a large part of a group shares are counted first and looked at ``LONGER`` times as far.)
    """
    spark = df.sparkSession
    groups = list(group_by or [])
    keys = groups + list(order_by)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *keys) if boundary_chars is None else _range_by_beginnings(df, n, groups, order_by[0], boundary_chars)
    ranged = (ranged.sortWithinPartitions(*keys)
                .withColumn("_mid", F.monotonically_increasing_id())
                .withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
                .withColumn("_local", F.col("_mid").bitwiseAND((1 << _LOCAL_BITS) - 1)))
    # Range bounds are sampled per execution; the counts and the join below
    # must see the same partitioning, so the numbered rows are written once
    # to the shared checkpoint folder (this also survives executor loss).
    ranged = cut_lineage(ranged)
    gcols = [F.col(g) for g in groups]
    counts = (ranged.groupBy("_pid", *gcols)
                    .agg(F.count(F.lit(1)).alias("_cnt"), F.min("_local").alias("_first")))
    w = Window.partitionBy(*gcols).orderBy("_pid") if groups else Window.orderBy("_pid")
    offsets = counts.withColumn(
        "_offset", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                              F.lit(0)))
    # At most (partitions + groups) rows; many groups are joined by shuffle.
    offsets = offsets.select("_pid", *groups, "_offset", "_first")
    if counts.limit(MAX_OFFSETS + 1).count() <= MAX_OFFSETS:
        offsets = F.broadcast(offsets)
    joined = ranged.join(offsets, on=["_pid", *groups], how="inner")
    return (joined.withColumn(name, (F.col("_offset") + F.col("_local") - F.col("_first")).cast("bigint"))
                  .drop("_mid", "_pid", "_local", "_offset", "_first"))
