"""Grouped aggregations (one hash aggregate per call, partial + final).

Every function here is a single ``groupBy(...).agg(...)``: Spark computes a
partial aggregate before the shuffle, so a key that holds a third of the rows
is reduced map-side and never lands whole on one task.  "Latest" values use
``max_by``/``min_by`` with a null guard instead of a sort, so no window and no
per-group buffer is needed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.functions.scalars import earliest_expr, latest_expr, safe_div

SUPPORTED = ("count", "sum", "mean", "min", "max", "std", "first", "last", "nunique", "size")


def agg_expr(col: str, fn: str, order: Sequence | None = None, where: Column | None = None) -> Column:
    """One aggregate with pandas semantics.

    ``sum`` of no values is 0 (pandas), ``mean`` of none is NULL, ``count``
    counts present values, ``first``/``last`` follow ``order`` (descending)
    and skip missing values.  ``where`` restricts the rows seen (conditional
    aggregation, used for pivots).
    """
    x = F.col(col)
    if where is not None:
        x = F.when(where, x)
    if fn == "count":
        return F.count(x)
    if fn == "sum":
        return F.coalesce(F.sum(x), F.lit(0))
    if fn == "mean":
        return F.avg(x)
    if fn == "min":
        return F.min(x)
    if fn == "max":
        return F.max(x)
    if fn == "std":
        return F.stddev_samp(x)
    if fn == "nunique":
        return F.count_distinct(x)
    if fn == "size":
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    if fn in ("first", "last"):
        if not order:
            raise ValueError(f"'{fn}' needs an order")
        return latest_expr(x, order) if fn == "first" else earliest_expr(x, order)
    raise ValueError(f"unsupported aggregate {fn!r}; use one of {SUPPORTED}")


def named_aggs(df: DataFrame, keys: str | Sequence[str], spec: Mapping[str, Sequence[str] | str],
               order: Sequence | None = None, sep: str = "_", prefix: str = "") -> DataFrame:
    """``groupby(keys).agg({col: [fn, ...]})`` with flattened ``col_fn`` names."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    exprs = []
    for col, fns in spec.items():
        for fn in ([fns] if isinstance(fns, str) else fns):
            exprs.append(agg_expr(col, fn, order).alias(f"{prefix}{col}{sep}{fn}"))
    return df.groupBy(*keys).agg(*exprs)


def latest(df: DataFrame, keys: str | Sequence[str], order: Sequence, cols: Sequence[str],
           prefix: str = "", suffix: str = "") -> DataFrame:
    """Latest present value of each column per key (order descending)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[latest_expr(c, order).alias(f"{prefix}{c}{suffix}") for c in cols])


def earliest(df: DataFrame, keys: str | Sequence[str], order: Sequence, cols: Sequence[str],
             prefix: str = "", suffix: str = "") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[earliest_expr(c, order).alias(f"{prefix}{c}{suffix}") for c in cols])


def latest_row(df: DataFrame, keys: str | Sequence[str], order: Sequence, cols: Sequence[str] | None = None,
               where: Column | None = None, prefix: str = "") -> DataFrame:
    """``df[where].sort_values(order, desc).groupby(k).first()``.

    Every column skips missing values on its own, so the result can combine
    several rows (pandas ``GroupBy.first``).  Keys with no row passing
    ``where`` are absent.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if where is not None:
        df = df.filter(where)
    cols = [c for c in (cols or df.columns) if c not in keys]
    return df.groupBy(*keys).agg(*[latest_expr(c, order).alias(f"{prefix}{c}") for c in cols])


def category_shares(df: DataFrame, key: str, cat: str, values: Mapping[str, str], id_col: str | None = None,
                    prefix: str = "ratio_") -> DataFrame:
    """Share of each category among the key's rows that have a category.

    A category the key never has gives NULL (absent after the pandas merge),
    not 0.  Rows with a missing category are left out, as in ``groupby``.
    """
    rows = df.filter(F.col(cat).isNotNull())
    if id_col is not None:
        rows = rows.filter(F.col(id_col).isNotNull())
    total = F.count(F.lit(1))
    exprs = [safe_div(F.nullif(F.count_if(F.col(cat) == F.lit(v)), F.lit(0)), total).alias(f"{prefix}{name}")
             for v, name in values.items()]
    return rows.groupBy(key).agg(*exprs)


def pivot_stats(df: DataFrame, key: str, cat: str, values: Mapping[str, str],
                spec: Mapping[str, Sequence[str]], order: Sequence | None = None,
                name_fmt: str = "{col}_{fn}_{label}") -> DataFrame:
    """Per-category statistics spread into columns (conditional aggregation).

    Equal to ``groupby([key, cat]).agg(spec)`` followed by one outer merge
    per listed category: a key without rows of a category gets NULL for all
    of that category's statistics.  Keys without any listed category are
    absent.  One hash aggregate, no joins.
    """
    rows = df.filter(F.col(cat).isin(list(values)))
    exprs = []
    for v, label in values.items():
        is_v = F.col(cat) == F.lit(v)
        present = F.count_if(is_v) > 0
        for col, fns in spec.items():
            for fn in fns:
                e = agg_expr(col, fn, order, where=is_v)
                exprs.append(F.when(present, e).alias(name_fmt.format(col=col, fn=fn, label=label)))
    return rows.groupBy(key).agg(*exprs)


def category_ratios(df: DataFrame, key: str, cat: str, values: Sequence[str], exclude: Sequence[str] = (),
                    name_fmt: str = "{cat}_{value}") -> DataFrame:
    """Mean of one-hot indicators per key (``get_dummies`` + ``mean``).

    Rows whose category is in ``exclude`` are dropped null-safely (rows with
    a missing category stay and count as all-zero).  A category never seen
    gives 0.0, unlike ``category_shares``.
    """
    for v in exclude:
        df = df.filter(~F.col(cat).eqNullSafe(F.lit(v)))
    exprs = [F.avg(F.when(F.col(cat) == F.lit(v), 1.0).otherwise(0.0)).alias(name_fmt.format(cat=cat, value=v))
             for v in values]
    return df.groupBy(key).agg(*exprs)


def latest_month_by_status(df: DataFrame, key: str, status: str, month: str,
                           open_value: str = "0", delin_value: str = "1",
                           names: tuple[str, str] = ("Months_latest_open", "Months_latest_delin")) -> DataFrame:
    """Most recent month of the 'open' and the 'late' status per credit.

    Only credits that have the open status are kept (left merge from the
    open side).  Months are compared numerically: larger = more recent.
    """
    is_open = F.col(status) == F.lit(open_value)
    is_delin = F.col(status) == F.lit(delin_value)
    out = (df.filter(F.col(status).isin(open_value, delin_value))
             .groupBy(key)
             .agg(F.count_if(is_open).alias("_n_open"),
                  F.max(F.when(is_open, F.col(month))).alias(names[0]),
                  F.max(F.when(is_delin, F.col(month))).alias(names[1])))
    return out.filter(F.col("_n_open") > 0).drop("_n_open")


def conditional_sums(df: DataFrame, key: str, terms: Mapping[str, Column]) -> DataFrame:
    """Sum of per-row expressions per key, 0 when all missing."""
    return df.groupBy(key).agg(*[F.coalesce(F.sum(e), F.lit(0)).alias(n) for n, e in terms.items()])


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()
