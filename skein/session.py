"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder with the settings the operators are tuned for, plus the
lineage-cut helper that uses the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of the library assumes. AQE re-plans joins from runtime
# sizes (sides that turn out small become broadcasts, skewed partitions are
# split), so no join in the library forces a broadcast on data-derived input.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of DataFrames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "skein",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """Session for local runs and tests (on a cluster the submitter configures it)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if driver_memory:  # only effective when this call starts the JVM
        conf["spark.driver.memory"] = driver_memory
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read; it
    is an error there if it is unset. Only under a ``local`` master (tests, one
    machine) is a scratch folder created, once per session.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = _LOCAL_DIRS.get(id(spark.sparkContext))
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="skein-ckpt-")
        _LOCAL_DIRS[id(spark.sparkContext)] = path
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments reject core confs at run time
            pass
    return path


_LOCAL_DIRS: dict = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    path = checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: the lineage is cut, and the scan has real file sizes for the
    optimizer and pushes filters into parquet."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    track(df.sparkSession, path)
    return df.sparkSession.read.parquet(path)


#: Folders written by each session, in the order of writing.
_WRITTEN: dict = {}


def track(spark: SparkSession, path: str) -> None:
    """Count a folder that the caller wrote among those that ``drop_written_tables`` removes."""
    _WRITTEN.setdefault(id(spark.sparkContext), []).append(path)


def drop_written_tables(spark: SparkSession, *tables: DataFrame | str) -> int:
    """Delete written tables and return their count: those given by path, those that a given
    DataFrame reads, or, without any, all that this session wrote. Tables that are not named
    stay, so what other DataFrames read is safe."""
    written = _WRITTEN.get(id(spark.sparkContext), [])
    if tables:
        read = [f.split(":", 1)[-1].replace("///", "/") for t in tables if isinstance(t, DataFrame) for f in t.inputFiles()]
        named = {t.rstrip("/") for t in tables if isinstance(t, str)}
        paths = [p for p in written if p in named or any(f"{p.split(':', 1)[-1].replace('///', '/')}/" in f for f in read)]
    else:
        paths = list(written)
    _WRITTEN[id(spark.sparkContext)] = [p for p in written if p not in paths]
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        hp.getFileSystem(conf).delete(hp, True)
    return len(paths)


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside the ``with`` block are deleted at its end; the results must be
    written out or collected by then."""
    before = len(_WRITTEN.get(id(spark.sparkContext), []))
    try:
        yield
    finally:
        own = _WRITTEN.get(id(spark.sparkContext), [])[before:]
        if own:
            drop_written_tables(spark, *own)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read again: later steps don't recompute ``df`` and it
    survives lost executors. An eager ``checkpoint()`` would compute its input twice, once to
    count it and once to write it."""
    return write_table(df, "cut")
