"""Sources and sinks: tables in, features and scores out.

Reads go through ``spark.read`` with an explicit schema for CSV (no schema
inference pass) and NaN mapped to NULL on floating columns, so all later
comparisons follow pandas' missing-value rules.  Parquet keeps predicate
push-down and column pruning: the NaN mapping is a projection Catalyst can
see through for every non-floating column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.functions.scalars import nan_to_null
from loanmart.session import scratch_path


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None, header: bool = True) -> DataFrame:
    """Read one table (parquet or headered CSV); empty CSV fields are NULL."""
    fmt = fmt or ("csv" if path.endswith(".csv") or path.endswith(".csv.gz") else "parquet")
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", header).option("mode", "FAILFAST").option("nanValue", "NaN")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        df = reader.csv(path)
    else:
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.format(fmt).load(path)
    return nan_to_null(df)


def write_features(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None,
                   mode: str = "overwrite") -> None:
    """Save a keyed feature table (``to_csv(index=False)`` equivalent)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def materialize(df: DataFrame, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Write once, read back: cuts lineage and survives executor loss.

    Without a path the table goes below the session's checkpoint folder
    (``spark.checkpoint.dir``), never to a machine-local folder.
    """
    spark = df.sparkSession
    if path is None:
        path = scratch_path(spark, "materialized")
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.format(fmt).load(path)


def score_frame(model, df: DataFrame, id_col: str, prob_col: str = "probability",
                out: str = "TARGET") -> DataFrame:
    """(id, probability of the positive class) from a fitted model."""
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(df)
    return scored.select(id_col, vector_to_array(F.col(prob_col))[1].alias(out))


def write_scores(model, df: DataFrame, path: str, id_col: str, out: str = "TARGET") -> None:
    score_frame(model, df, id_col, out=out).write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_bucketed(df: DataFrame, key: str, buckets: int | None = None, name: str = "bucketed", path: str | None = None,
                   rows_per_bucket: int = 2_000_000) -> DataFrame:
    """Write a child table hash-bucketed and sorted on its parent key, once.

    Every later aggregate or join on ``key`` (all blocks of one applicant
    table, and the mart joins when the parent is bucketed the same way)
    then runs without a shuffle.  Without ``buckets`` their number follows the
    rows.  All rows of one key share a bucket, so this is for keys of bounded
    size; a key with a large share of all rows is better left to aggregates
    that are partial before the shuffle.  The files go below the checkpoint
    folder unless a shared ``path`` is given; the table is registered in the
    session catalog under a unique name.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_per_bucket))
    place = scratch_path(spark, name)
    table = place.rsplit("/", 1)[-1].replace("-", "_")
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path or place).saveAsTable(table))
    return spark.table(table)
