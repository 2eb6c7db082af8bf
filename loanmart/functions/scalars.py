"""Row-level expressions with pandas-compatible null semantics.

All helpers return Column expressions, so they stay inside whole-stage
codegen.  The rules they encode:

* missing numbers are SQL NULL (NaN is mapped to NULL at load time);
* division by zero gives NULL (``try_divide``) instead of an ANSI error;
* ``flag(cond)`` is 1 only when ``cond`` is true, so a NULL operand gives 0;
* "not equal" filters keep missing values (null-safe comparison);
* cap keeps NULL (``least`` would turn it into the cap).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """a / b, NULL when b is 0 or either side is NULL."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def null_if(c: ColumnOrName, value) -> Column:
    """Sentinel value -> NULL (e.g. 365243 days employed)."""
    return F.nullif(_c(c), F.lit(value))


def flag(cond: Column, true_value: int = 1, false_value: int = 0) -> Column:
    """np.where(cond, 1, 0): NULL conditions take the else arm."""
    return F.when(cond, F.lit(true_value)).otherwise(F.lit(false_value))


def cap(c: ColumnOrName, upper) -> Column:
    """np.where(x > k, k, x): values above k become k, NULL stays NULL."""
    col = _c(c)
    return F.when(col > F.lit(upper), F.lit(upper)).otherwise(col)


def replace_value(c: ColumnOrName, old, new) -> Column:
    col = _c(c)
    return F.when(col == F.lit(old), F.lit(new)).otherwise(col)


def map_values(c: ColumnOrName, mapping: Mapping) -> Column:
    """Series.map(dict): mapped values, anything else (and NULL) -> NULL."""
    col = _c(c)
    out = None
    for k, v in mapping.items():
        out = F.when(col == F.lit(k), F.lit(v)) if out is None else out.when(col == F.lit(k), F.lit(v))
    return out if out is not None else F.lit(None)


def drop_sentinel(df: DataFrame, column: str, *values) -> DataFrame:
    """Drop rows equal to any sentinel value; rows with a missing value stay."""
    cond = None
    for v in values:
        term = F.col(column).eqNullSafe(F.lit(v))
        cond = term if cond is None else (cond | term)
    return df if cond is None else df.filter(~cond)


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Map NaN to NULL on floating columns so comparisons follow pandas."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = floating if columns is None else floating.intersection(columns)
    if not targets:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in targets})


def order_key(order: Sequence[ColumnOrName]) -> Column:
    """Sort key for "descending, missing last": (order present, order..., tie...)."""
    cols = [_c(o) for o in order]
    return F.struct(cols[0].isNotNull().alias("_present"), *[c.alias(f"_o{i}") for i, c in enumerate(cols)])


def _guard(col: Column, where: Column | None) -> Column:
    return col.isNotNull() if where is None else (where & col.isNotNull())


def latest_expr(x: ColumnOrName, order: Sequence[ColumnOrName], where: Column | None = None) -> Column:
    """Value of x on the first row in (order desc, missing last) that has x.

    Equal to ``sort_values(order, ascending=False).groupby(k).agg(first)``,
    which skips missing values per column.  ``order`` ends with a unique
    tie-breaker; it is compared descending as well.  ``where`` limits the
    rows considered (conditional aggregation).
    """
    col = _c(x)
    return F.max_by(col, F.when(_guard(col, where), order_key(order)))


def earliest_expr(x: ColumnOrName, order: Sequence[ColumnOrName], where: Column | None = None) -> Column:
    """Value of x on the last row in (order desc, missing last) that has x."""
    col = _c(x)
    return F.min_by(col, F.when(_guard(col, where), order_key(order)))


def hash_hex(key: ColumnOrName, seed) -> Column:
    return F.md5(F.concat(_c(key).cast("string"), F.lit(f":{seed}")))


def hash_int(key: ColumnOrName, seed) -> Column:
    """Deterministic 32-bit integer from md5(key:seed); same value in DuckDB."""
    return F.conv(F.substring(hash_hex(key, seed), 1, 8), 16, 10).cast("bigint")


def hash_unit(key: ColumnOrName, seed) -> Column:
    """Deterministic uniform number in [0, 1) from md5(key:seed)."""
    return hash_int(key, seed) / F.lit(4294967296.0)


def r6(c: ColumnOrName, digits: int = 6) -> Column:
    return F.round(_c(c).cast("double"), digits)
