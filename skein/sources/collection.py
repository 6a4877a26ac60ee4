"""Chunk collections as tables.

A collection is a parquet table ``(pk, text, path, context, metadata,
dense_vector)`` plus its sparse vectors in long form ``(pk, term, w)``.

Rows are inserted in batches. A batch is written to a staging folder that readers skip and then
moved to ``batch_id=<id>`` in one step, so a failed attempt leaves nothing visible. The folders are
the ledger of ids: a batch that is there already is not inserted again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Field length limits in bytes.
FIELD_LIMITS = {"text": 16384, "path": 8192, "context": 8192, "metadata": 4096}

COLLECTION_DDL = ("pk BIGINT, text STRING, path STRING, context STRING, metadata STRING, "
                  "dense_vector ARRAY<FLOAT>")
COLUMNS = ["pk", "text", "path", "context", "metadata", "dense_vector"]


def assign_pk(rows: DataFrame, discriminator: str | None = None) -> DataFrame:
    """Stable auto key: 60-bit prefix of md5 over path, text and, if rows may be
    equal in both, a ``discriminator`` column; no global sort needed. The parts
    are separated by a line end, so "a" + "bc" and "ab" + "c" differ."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("path", "text", *([discriminator] if discriminator else []))]
    return rows.withColumn("pk", F.conv(F.substring(F.md5(F.concat_ws("\n", *parts)), 1, 15), 16, 10).cast("bigint"))


def length_check(rows: DataFrame) -> DataFrame:
    """Adds ``<field>_bytes`` columns and ``accepted`` (all fields within limits)."""
    out = rows
    ok = F.lit(True)
    for field, limit in FIELD_LIMITS.items():
        out = out.withColumn(field + "_bytes", F.coalesce(F.octet_length(field), F.lit(0)))
        ok = ok & (F.col(field + "_bytes") <= limit)
    return out.withColumn("accepted", ok)


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_collection(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """Create the collection table if absent, else open the existing one."""
    if not spark.catalog.tableExists(name):
        place = location.replace("\\", "\\\\").replace("'", "\\'") if location else None
        loc = f" LOCATION '{place}'" if place else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({COLLECTION_DDL}, batch_id STRING) USING parquet PARTITIONED BY (batch_id){loc}")
    return spark.table(name).select(*COLUMNS)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(name)}").collect()}  # a few rows


def _location(spark: SparkSession, name: str) -> str:
    return _described(spark, name)["Location"].rstrip("/")


def insert_rows(rows: DataFrame, name: str, batch_id: str | None = None) -> DataFrame:
    """Insert the rows that pass the length rule as one batch; returns the rejected rows.

    A call can be repeated with the same ``batch_id`` (letters, digits, ``_``, ``.``, ``-``): the batch
    that was moved into place first stays, later ones add no row. Without an id each call is a batch."""
    spark = rows.sparkSession
    batch_id = batch_id or uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch_id):
        raise ValueError(f"batch id {batch_id!r} has other characters than letters, digits, '_', '.', '-'")
    checked = length_check(assign_pk(rows))
    root = _location(spark, name)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target, staged = path(f"{root}/batch_id={batch_id}"), path(f"{root}/_staging/{batch_id}-{uuid.uuid4().hex}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        checked.where("accepted").select(*COLUMNS).write.parquet(staged.toString())
        # a rename onto an existing folder would move into it: the one that comes second gives up
        if fs.exists(target) or not fs.rename(staged, target):
            fs.delete(staged, True)
    if _described(spark, name).get("Partition Provider") == "Catalog":  # the catalog keeps the list of folders
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD IF NOT EXISTS PARTITION (batch_id = '{batch_id}')")
    spark.catalog.refreshTable(name)
    return checked.where(~F.col("accepted"))


def batches(spark: SparkSession, name: str) -> list[str]:
    """Ids of the inserted batches in order (folder names, no data read)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_location(spark, name))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return sorted(n.removeprefix("batch_id=") for n in names if n.startswith("batch_id="))


def list_collections(spark: SparkSession, database: str | None = None) -> list[str]:
    """Table names in name order (catalog metadata, no data read)."""
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def collection_info(collection: DataFrame, sparse: DataFrame, name: str = "collection") -> DataFrame:
    """One row: name, row count, rows with a sparse vector, rows with a dense vector."""
    rows = collection.select(F.lit(1).alias("r"),
                             F.col("dense_vector").isNotNull().cast("int").alias("d"),
                             F.lit(None).cast("long").alias("sid"))
    ids = sparse.select(F.lit(0).alias("r"), F.lit(0).alias("d"), F.col("id").cast("long").alias("sid"))
    return rows.unionByName(ids).agg(
        F.lit(name).alias("name"), F.sum("r").cast("bigint").alias("n_rows"),
        F.countDistinct("sid").alias("n_sparse"), F.sum("d").cast("bigint").alias("n_dense"))
