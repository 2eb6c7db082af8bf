"""Feature preparation: correlation filter, imputation, encodings, scaling,
PCA.  Every ``fit`` is an aggregate whose result is bounded by the number of
columns or categories (never by rows); ``transform`` is a projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.constants import CORR_THRESHOLD, MISSING_CODE_LABEL, STRING_FILL

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def columns_of_type(df: DataFrame, strings: bool) -> list[str]:
    """``select_dtypes(include=object)`` / ``exclude=object`` on the schema."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) == strings
            and (strings or isinstance(f.dataType, NUMERIC + (T.BooleanType,)))]


# ------------------------------------------------------------ correlation P1

CORR_TILE = 512                                             # columns a side of one tile
CORR_VALUES = 1 << 22                                       # values multiplied at a time
CORR_PACKED = 1 << 17                                       # numbers in one packed row


def pairwise_corr(df: DataFrame, cols: Sequence[str], tile: int = CORR_TILE) -> DataFrame:
    """Pearson r of every column pair (i < j) on pairwise-complete rows.

    Each partition multiplies its blocks with NumPy (Gram matrices of the null mask and of globally centred
    values) and emits them as packed rows of bounded size, strips of the matrices; packed rows are added up one by
    one in two levels and only the sums are split into one row per pair.  Columns are taken in tiles: a task holds the sums of one pair of tiles, at
    most six times ``tile`` squared numbers whatever the number of columns, and reads the columns of those two
    tiles.  With more than one tile the columns are written once, so that each pair of tiles is a pruned scan.
    The driver only sees the column means.  Constant columns give NULL; fewer than two columns give no rows.
    """
    cols = list(cols)
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    tiles = [range(a, min(a + tile, len(cols))) for a in range(0, len(cols), tile)] or [range(0)]
    if len(tiles) > 1:
        from loanmart.session import cut_lineage
        numbers = cut_lineage(numbers)
    mu: list[float] = []
    for t in tiles:
        means = numbers.agg(F.count(F.lit(1)), *[F.avg(f"c{i}") for i in t]).first()[1:]
        mu += [float(m) if m is not None else 0.0 for m in means]
    s = None
    for a, one in enumerate(tiles):
        for other in tiles[a:]:
            part = _tile_sums(numbers, one, other, mu)
            s = part if s is None else s.unionByName(part)
    num = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    r = F.when((vx > 0) & (vy > 0), num / F.sqrt(vx * vy))
    names = F.array(*[F.lit(c) for c in cols]) if cols else F.array().cast("array<string>")
    return s.select(F.element_at(names, F.col("i") + 1).alias("col_i"), F.element_at(names, F.col("j") + 1)
                    .alias("col_j"), "i", "j", F.when(r > 1.0, 1.0).when(r < -1.0, -1.0).otherwise(r).alias("corr"))


def _tile_sums(numbers: DataFrame, one: range, other: range, mu: Sequence[float]) -> DataFrame:
    """Sums over the rows for the pairs (i in one, j in other, i < j): their number, and of the centred values x
    of i and y of j the sums, squares and products."""
    same = one == other
    d, e = len(one), len(other)
    shape, state = (6, d, e), "g int, k int, m binary"
    strip = max(1, CORR_PACKED // max(1, shape[0] * e))     # rows of the matrices in one packed row
    shift = [mu[i] for i in one], [mu[i] for i in other]
    pair_fields = ("n", "sx", "sy", "sxx", "syy", "sxy")
    cols = [f"c{i}" for i in one] + ([] if same else [f"c{i}" for i in other])

    def packed(part: int, k: int, sums) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int32()),
                                           pa.array([sums.tobytes()], pa.binary())], names=["g", "k", "m"])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        acc, part = np.zeros(shape), None
        step = max(1, CORR_VALUES // max(1, len(cols)))

        def block(b, first, mean):
            X = np.column_stack([b.column(first + k).to_numpy(zero_copy_only=False).astype("float64") for k in range(len(mean))])
            M = ~np.isnan(X)
            return np.where(M, X - np.asarray(mean), 0.0), M.astype("float64")

        for whole in batches:
            for at in range(0, whole.num_rows if cols else 0, step):
                b = whole.slice(at, step)
                part = b.column(len(cols))[0].as_py()
                X, Mx = block(b, 0, shift[0])
                Y, My = (X, Mx) if same else block(b, d, shift[1])
                sx, sxx = X.T @ My, (X * X).T @ My
                sy, syy = (sx.T, sxx.T) if same else (Mx.T @ Y, Mx.T @ (Y * Y))
                for k, m in enumerate((Mx.T @ My, sx, sy, sxx, syy, X.T @ Y)):
                    acc[k] += m
        for k, at in enumerate(range(0, d, strip) if part is not None else ()):
            yield packed(part, k, acc[:, at:at + strip])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        total, key = 0.0, (0, 0)
        for b in batches:
            for g, k, m in zip(b.column("g"), b.column("k"), b.column("m")):
                total, key = total + np.frombuffer(m.as_buffer(), "float64"), (g.as_py(), k.as_py())
        yield packed(*key, total)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        for b in batches:
            for k, m in zip(b.column(1), b.column(2)):
                sums = np.frombuffer(m.as_buffer(), "float64").reshape(shape[0], -1, e)
                at = k.as_py() * strip
                u, v = (x.ravel() for x in np.indices(sums.shape[1:]))
                if same:
                    u, v = u[v > u + at], v[v > u + at]
                i, j = np.asarray(one, "int32")[u + at], np.asarray(other, "int32")[v]
                yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j)] + [pa.array(x[u, v]) for x in sums], names=["i", "j", *pair_fields])

    blocks = numbers.select(*cols, F.spark_partition_id().alias("g")).mapInArrow(gram, state)
    fan = max(1, int(numbers.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    level = blocks.withColumn("g", F.col("g") % fan).groupBy("g", "k").applyInArrow(add, state)
    return level.groupBy("k").applyInArrow(add, state).mapInArrow(
        pairs, "i int, j int, " + ", ".join(f"{c} double" for c in pair_fields))


def correlated_columns(df: DataFrame, cols: Sequence[str], threshold: float = CORR_THRESHOLD) -> DataFrame:
    """Per column: largest r with any *earlier* column, and whether it is
    dropped (r > threshold, signed).  A dropped column still drops later
    ones, as in the upper-triangle rule."""
    pc = pairwise_corr(df, cols)
    worst = pc.groupBy("col_j", "j").agg(F.max("corr").alias("max_corr"))
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, pos int")
    out = names.join(worst, names["pos"] == worst["j"], "left")
    return out.select("column", "max_corr", F.coalesce(F.col("max_corr") > threshold, F.lit(False)).alias("dropped"))


def drop_correlated(df: DataFrame, cols: Sequence[str] | None = None, threshold: float = CORR_THRESHOLD,
                    exclude: Iterable[str] = ()) -> tuple[DataFrame, list[str]]:
    """Drop numeric columns correlated above ``threshold`` with an earlier one."""
    ex = set(exclude)
    cols = [c for c in (cols or columns_of_type(df, strings=False)) if c not in ex]
    if len(cols) < 2:
        return df, []
    flags = correlated_columns(df, cols, threshold).filter("dropped").select("column").collect()
    to_drop = [r[0] for r in flags]
    return df.drop(*to_drop), to_drop


# ------------------------------------------------------------- imputation P2

def impute_constant(df: DataFrame, string_fill: str = STRING_FILL, numeric_fill: float = 0,
                    exclude: Iterable[str] = ()) -> DataFrame:
    ex = set(exclude)
    s = {c: string_fill for c in columns_of_type(df, strings=True) if c not in ex}
    n = [c for c in columns_of_type(df, strings=False) if c not in ex]
    flags = [c for c in n if isinstance(df.schema[c].dataType, T.BooleanType)]
    out = df.fillna(s) if s else df
    out = out.fillna(bool(numeric_fill), subset=flags) if flags else out
    return out.fillna(numeric_fill, subset=n) if n else out


@dataclass
class MeanImputer:
    """Missing numbers -> training mean (fit on the training split only)."""

    means: dict[str, float | None]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "MeanImputer":
        row = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in cols]).first()
        return cls({c: row[c] for c in cols})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m).cast("double"))
                               for c, m in self.means.items()})


# -------------------------------------------------------------- encoding P3

def category_codes(df: DataFrame, cols: Sequence[str], fill: str | None = None) -> DataFrame:
    """Dictionary of all string columns in one pass: (pos, value, code).

    ``pos`` is the column's place in ``cols``, ``code`` the value's place in
    the column's sorted order.  Values are made distinct with a partial
    aggregate and numbered by a distributed index, so a column may have any
    number of values; missing ones count as ``fill`` or not at all.
    """
    from loanmart.operators.windows import add_index
    text = [F.col(f"`{c}`").cast("string") for c in cols]
    cells = F.array(*[F.struct(F.lit(i).alias("pos"), (t if fill is None else F.coalesce(t, F.lit(fill))).alias("value"))
                      for i, t in enumerate(text)])
    found = df.select(F.inline(cells)).filter("value IS NOT NULL").distinct()
    numbered = add_index(found, order=["pos", "value"], name="_n", start=0)
    first = numbered.groupBy("pos").agg(F.min("_n").alias("_first"))        # one row per column
    return numbered.join(F.broadcast(first), "pos").select("pos", "value", (F.col("_n") - F.col("_first")).alias("code"))


def _with_code(df: DataFrame, codes: DataFrame, pos: int, value: Column, out: str) -> DataFrame:
    """``df`` with the code of ``value`` (NULL if it is not in the dictionary) as ``out``."""
    own = codes.filter(F.col("pos") == pos).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    rest = [F.col(f"`{c}`") for c in df.columns if c != out]
    return df.join(own, value == F.col("_value"), "left").select(*rest, F.col("_code").alias(out))


@dataclass
class OneHot:
    """``get_dummies(drop_first=...)``: sorted categories, ``col_value``
    columns; missing = all zeros; unseen categories = all zeros.

    The result has one column per category, so the category list is part of
    the schema and comes to the driver; for columns with very many values use
    ``SparseOneHot``, whose result is one vector column."""

    categories: dict[str, list[str]]
    drop_first: bool = True

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> "OneHot":
        cells = F.array(*[F.struct(F.lit(i).alias("pos"), F.col(f"`{c}`").cast("string").alias("value")) for i, c in enumerate(cols)])
        found = df.select(F.inline(cells)).filter("value IS NOT NULL").distinct().collect() if cols else []
        return cls({c: sorted(r["value"] for r in found if r["pos"] == i) for i, c in enumerate(cols)}, drop_first)

    def transform(self, df: DataFrame) -> DataFrame:
        new: list[Column] = []
        for c, vals in self.categories.items():
            for v in (vals[1:] if self.drop_first else vals):
                new.append(F.when(F.col(c) == F.lit(v), 1).otherwise(0).alias(f"{c}_{v}"))
        keep = [F.col(x) for x in df.columns if x not in self.categories]
        return df.select(*keep, *new)


@dataclass
class LabelEncoder:
    """Integer code = position of the value in sorted order; missing is the
    string ``nan`` (values are encoded as strings, as ``astype(str)``).
    Unseen values are NULL.  Codes come by a join with the dictionary."""

    cols: list[str]
    codes: DataFrame
    missing: str = MISSING_CODE_LABEL

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str], missing: str = MISSING_CODE_LABEL) -> "LabelEncoder":
        return cls(list(cols), category_codes(df, cols, missing), missing)

    def transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        for i, c in enumerate(self.cols):
            df = _with_code(df, self.codes, i, F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.missing)), c)
        return df.select(*[F.col(f"`{c}`") for c in names])


@dataclass
class SparseOneHot:
    """One-hot encoding with the first category dropped, one sparse vector
    column ``<col>__onehot`` per string column, for any number of categories.
    Missing and unseen values are the zero vector, as is the first category;
    columns with fewer than two values say nothing and go."""

    cols: list[str]
    codes: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "SparseOneHot":
        cols = list(cols)
        if not cols:
            return cls([], df.sparkSession.createDataFrame([], "pos int, value string, code bigint"), {})
        codes = category_codes(df, cols)
        n = {r["pos"]: r["n"] for r in codes.groupBy("pos").agg(F.count(F.lit(1)).alias("n")).collect()}
        return cls(cols, codes, {c: n.get(i, 0) for i, c in enumerate(cols)})

    @property
    def outputs(self) -> list[str]:
        return [f"{c}__onehot" for c in self.cols if self.sizes[c] > 1]

    def transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import OneHotEncoder
        used = [c for c in self.cols if self.sizes[c] > 1]
        for i, c in enumerate(self.cols):
            if c in used:
                df = _with_code(df, self.codes, i, F.col(f"`{c}`").cast("string"), f"{c}__code")
                last = self.sizes[c] - 1                    # the encoder drops its last index: the first category's
                df = df.withColumn(f"{c}__code", F.when(F.col(f"{c}__code") > 0, F.col(f"{c}__code") - 1).otherwise(last).cast("double"))
        if used:
            top = df.sparkSession.createDataFrame([tuple(float(self.sizes[c] - 1) for c in used)],
                                                  ", ".join(f"`{c}__code` double" for c in used))
            model = OneHotEncoder(inputCols=[f"{c}__code" for c in used], outputCols=self.outputs, dropLast=True).fit(top)
            df = model.transform(df).drop(*[f"{c}__code" for c in used])
        return df.drop(*self.cols)


# -------------------------------------------------------------- scaling P4

@dataclass
class Standardizer:
    """(x - mean) / population std; a constant column is divided by 1."""

    stats: dict[str, tuple[float | None, float]]

    @classmethod
    def fit(cls, df: DataFrame, cols: Sequence[str]) -> "Standardizer":
        row = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
        stats = {}
        for c in cols:
            s = row[f"s_{c}"]
            stats[c] = (row[f"m_{c}"], s if s not in (None, 0.0) else 1.0)
        return cls(stats)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c) * F.lit(s) + F.lit(m) for c, (m, s) in self.stats.items()})


# ------------------------------------------------------------------ PCA P6

def pca_features(df: DataFrame, cols: Sequence[str], k: int, out: str = "pca", fit_on: DataFrame | None = None):
    """Assemble, standardise and project onto k principal components.

    Returns (frame with ``out`` vector column, fitted PipelineModel, summed
    explained variance ratio).  Fitted on ``fit_on`` (default: all rows).  The covariance is d x d on the driver:
    bounded by the column count, not the rows.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler

    k = min(k, len(cols))
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol="_raw", handleInvalid="keep"),
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        PCA(k=k, inputCol="_std", outputCol=out),
    ])
    model = pipe.fit(df if fit_on is None else fit_on)
    explained = float(sum(model.stages[-1].explainedVariance.toArray()))
    return model.transform(df).drop("_raw", "_std"), model, explained


def label_one_hot(y: Column) -> Column:
    """``to_categorical(y, 2)``: [1 - y, y]."""
    return F.array((F.lit(1) - y).cast("double"), y.cast("double"))
