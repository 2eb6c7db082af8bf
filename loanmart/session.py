"""Session construction and lineage cutting.

The builder only sets defaults that are safe on a cluster: adaptive query
execution with partition coalescing and skew-join splitting, UTC session time,
Arrow transfer for the few pandas-backed steps, and the UI off.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "loanmart", master: str | None = None,
              shuffle_partitions: int | None = None, max_partition_bytes: str | None = None) -> SparkSession:
    """Session with the defaults above; ``shuffle_partitions`` should be about
    the largest shuffle's bytes / 200 MB, ``max_partition_bytes`` (e.g.
    "256m") sizes scan splits."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if max_partition_bytes:
        conf["spark.sql.files.maxPartitionBytes"] = max_partition_bytes
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests, laptops) without that setting gets a
    private temporary folder; on a cluster the setting must exist.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="loanmart-ckpt-", dir=os.environ.get("LOANMART_SCRATCH"))
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Writes in this block delete their own shuffle files when they end; else those stay until the driver happens to collect
    its garbage, and the disk holds the shuffles of all steps of a job at once."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


_BY_COLUMNS: ContextVar[str] = ContextVar("by_columns", default="")


@contextmanager
def by_columns(name: str):
    """In this block ``cut_lineage`` stores rows as ``store_rows`` does, for steps whose results do not follow the partitions."""
    token = _BY_COLUMNS.set(name)
    try:
        yield
    finally:
        _BY_COLUMNS.reset(token)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared checkpoint folder (survives executor loss)."""
    if _BY_COLUMNS.get():
        return store_rows(df, _BY_COLUMNS.get())
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store_rows(df: DataFrame, name: str) -> DataFrame:
    """Written once as Parquet below the checkpoint folder and read back: a checkpoint of wide rows is neither compressed
    nor pruned to the columns that a pass reads.  Unlike with ``cut_lineage`` rows may lie in other partitions; rows with a
    type that Parquet cannot hold become a checkpoint."""
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    if not kinds or any("void" in k or "interval" in k for k in kinds):
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder, remembered for ``drop_scratch``."""
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what this process has written to scratch paths; frames that read
    from them cannot be used any more.  Returns the number of paths deleted."""
    conf, jvm, gone = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm, 0
    while _SCRATCH:
        path = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
