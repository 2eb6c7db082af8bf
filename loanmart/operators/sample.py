"""Sort, limit, deterministic shuffles and splits, class partitions.

Randomness is always a function of the row id: ``md5(id:seed)``.  A split or
fold therefore does not change when the data is repartitioned, re-read or
recomputed after an executor loss (unlike ``randomSplit``/``rand``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.functions.scalars import hash_int
from loanmart.operators.windows import add_index
from loanmart.constants import N_FOLDS, SEED, TEST_SIZE


def sort_report(df: DataFrame, order: Sequence, ascending: bool | Sequence[bool] = True) -> DataFrame:
    """Global ordering (range-partitioned sort) for reports only."""
    return df.orderBy(*order, ascending=ascending)


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order (TakeOrderedAndProject, no full sort)."""
    return df.orderBy(*[F.asc_nulls_last(o) for o in order]).limit(n)


def hash_order(df: DataFrame, id_col: str, seed, name: str = "shuffle_key") -> DataFrame:
    """Reproducible random order: adds md5(id:seed) as an integer."""
    return df.withColumn(name, hash_int(id_col, seed))


def shuffle_rows(df: DataFrame, id_col: str, seed) -> DataFrame:
    """``sample(frac=1)``: all rows in a seeded random order."""
    return hash_order(df, id_col, seed, "_h").orderBy("_h", id_col).drop("_h")


def hash_split(df: DataFrame, id_col: str, test_frac: float = TEST_SIZE, seed=SEED) -> tuple[DataFrame, DataFrame]:
    """Train/test split by md5(id:seed) < test_frac * 2**32.

    Disjoint and covering, stable under repartitioning; one map-only filter
    per side, no shuffle.
    """
    cut = int(round(test_frac * 4294967296))
    h = hash_int(id_col, seed)
    return df.filter(h >= F.lit(cut)), df.filter(h < F.lit(cut))


def split_flag(df: DataFrame, id_col: str, test_frac: float = TEST_SIZE, seed=SEED, name: str = "is_test") -> DataFrame:
    cut = int(round(test_frac * 4294967296))
    return df.withColumn(name, (hash_int(id_col, seed) < F.lit(cut)).cast("int"))


def kfold_assign(df: DataFrame, id_col: str, label: str, k: int = N_FOLDS, seed=SEED, name: str = "fold") -> DataFrame:
    """Stratified fold numbers 0..k-1.

    Within each class, rows are ranked by md5(id:seed) and dealt round-robin,
    so every fold gets the class counts within one row (as a stratified
    k-fold does).  The rank is a distributed dense index over
    (label, hash, id) minus the class's first index, not a window over a
    whole class.  Only ids, labels and hashes are put in order; ``id_col`` is
    a key (without NULLs), by which the folds join the rows.
    """
    narrow = df.select(F.col(id_col), F.col(label).alias("_y"), hash_int(id_col, seed).alias("_h"))
    idx = add_index(narrow, order=["_y", "_h", id_col], name="_i", start=0)
    starts = idx.groupBy("_y").agg(F.min("_i").alias("_start")).withColumnRenamed("_y", "_y2")
    folds = idx.join(starts, F.col("_y").eqNullSafe(F.col("_y2")))
    folds = folds.select(id_col, F.pmod(F.col("_i") - F.col("_start"), F.lit(k)).cast("int").alias(name))
    return df.join(folds, id_col).select(*df.columns, name)


def class_partition(df: DataFrame, label: str, negative=0, positive=1) -> tuple[DataFrame, DataFrame]:
    """``df[label == 0]``, ``df[label == 1]`` (two filters of one input)."""
    return df.filter(F.col(label) == F.lit(negative)), df.filter(F.col(label) == F.lit(positive))


def balanced_union(*parts: DataFrame) -> DataFrame:
    """``pd.concat(axis=0)`` by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
