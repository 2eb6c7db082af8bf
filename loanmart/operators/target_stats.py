"""Ordered target statistics: categories as running means of the label (T1, category handling of the third learner).

The rows of a category are put in a hash order; a row gets the smoothed mean label of the rows before it, so its own label
never enters its feature.  New rows get the mean over all training rows of their category.

A category is parted by ranges of the hash: running sums are taken inside (category, range) and shifted by
the sums of the category's earlier ranges, so a category that holds a third of the rows is spread over all ranges.

Defined cases: NULL is a category; categories not seen in training get the prior; an empty table gives an empty
result; ids are unique, and equal hashes are in the order of ids; rows with a NULL label are told apart by ``fit_transform``:
they get a value but add nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.functions.scalars import hash_int

ROWS_PER_RANGE = 1_000_000


def _key(c: str) -> Column:
    s = F.col(f"`{c}`").cast("string")
    return F.when(s.isNull(), "0").otherwise(F.concat(F.lit("1"), s))


def _smoothed(total: Column, count: Column, prior: float, weight: float) -> Column:
    return (total.cast("double") + F.lit(weight * prior)) / (count.cast("double") + F.lit(float(weight)))


def ordered_means(df: DataFrame, id_col: str, label: str, col: str, out: str, prior: float, weight: float = 1.0, seed=1,
                  n_ranges: int = 1) -> DataFrame:
    """``df`` with ``out``: (sum of earlier labels + weight * prior) / (earlier rows + weight) within the category of ``col``."""
    width = -(-(1 << 32) // max(1, n_ranges))
    known = F.col(f"`{label}`").isNotNull()
    y = F.coalesce(F.col(f"`{label}`").cast("bigint"), F.lit(0))
    rows = df.withColumns({"_k": _key(col), "_h": hash_int(id_col, seed)}).withColumn("_r", F.floor(F.col("_h") / width).cast("int"))
    sums = rows.groupBy("_k", "_r").agg(F.sum(y).alias("_s"), F.sum(known.cast("bigint")).alias("_c"))
    before = Window.partitionBy("_k").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_k", "_r", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_os"),
                          F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_oc"))
    inside = Window.partitionBy("_k", "_r").orderBy("_h", id_col).rowsBetween(Window.unboundedPreceding, -1)
    joined = rows.withColumns({"_s": F.coalesce(F.sum(y).over(inside), F.lit(0)),
                               "_c": F.coalesce(F.sum(known.cast("bigint")).over(inside), F.lit(0))}).join(offsets, ["_k", "_r"])
    value = _smoothed(F.col("_s") + F.col("_os"), F.col("_c") + F.col("_oc"), prior, weight)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out], value.alias(out))


@dataclass
class OrderedTargetEncoder:
    """Encoder of string columns; ``stats``: one row per (column, category), with its label sum and row count."""

    cols: list[str]
    prior: float
    weight: float
    stats: DataFrame

    @classmethod
    def fit_transform(cls, df: DataFrame, id_col: str, label: str, cols: Sequence[str], weight: float = 1.0, seed=1,
                      rows_per_range: int = ROWS_PER_RANGE) -> tuple["OrderedTargetEncoder", DataFrame]:
        """(encoder, training rows with each column replaced by its ordered statistic)."""
        from loanmart.session import cut_lineage
        n, total, known = df.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("bigint")), F.count(label)).first()
        prior = float(total or 0) / known if known else 0.0
        cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _key(c).alias("k")) for c in cols])).alias("x"), label) \
            if cols else df.limit(0).select(F.struct(F.lit("").alias("column"), F.lit("").alias("k")).alias("x"), label)
        stats = cells.groupBy("x.column", "x.k").agg(F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0)).alias("total"),
                                                     F.count(label).alias("n"))
        out = df
        for c in cols:
            out = ordered_means(out, id_col, label, c, "_e", prior, weight, seed, -(-n // rows_per_range))
            out = out.select(*[F.col("_e").alias(x) if x == c else F.col(f"`{x}`") for x in df.columns])
        return cls(list(cols), prior, weight, cut_lineage(stats)), out

    def transform(self, df: DataFrame) -> DataFrame:
        """New rows: each column as the smoothed mean label of its category in training."""
        out = df
        for c in self.cols:
            mine = self.stats.filter(F.col("column") == c).select(F.col("k").alias("_k2"), "total", "n")
            joined = out.withColumn("_k", _key(c)).join(mine, F.col("_k") == F.col("_k2"), "left")
            value = F.coalesce(_smoothed(F.col("total"), F.col("n"), self.prior, self.weight), F.lit(self.prior))
            out = joined.select(*[value.alias(x) if x == c else F.col(f"`{x}`") for x in df.columns])
        return out
