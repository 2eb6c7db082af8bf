"""Window operators: lags, latest-n flattening, padded sequences, indexes,
per-group samples.

Hot keys: Spark keeps a whole window partition on one task, so every
operator here bounds what one window partition can hold:

* ``latest_n_wide`` / ``padded_sequences`` filter ``row_number() <= n``
  directly after the window, which Spark plans as a partial
  ``WindowGroupLimit`` *before* the shuffle: at most n rows per key and map
  partition cross the network.
* ``pct_change`` splits each key by an order bucket (e.g. a year of months),
  takes the lag inside (key, bucket) and repairs the first row of every
  bucket from the last row of the key's previous non-empty bucket.
* ``sample_per_group`` with a per-group quota ranks narrow rows by a
  distributed index.
* ``add_index`` numbers rows by a global order through range partitions
  and per-partition offsets, never through a window without keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.functions.scalars import cap, hash_int, latest_expr, safe_div
from loanmart.session import cut_lineage
from loanmart.constants import SEQ_PAD, SEQ_ROWS


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in ([cs] if isinstance(cs, (str, Column)) else cs)]


def _desc(order: Sequence) -> list[Column]:
    return [F.desc_nulls_last(c) if isinstance(c, str) else c.desc_nulls_last() for c in order]


def _asc(order: Sequence) -> list[Column]:
    return [F.asc_nulls_last(c) if isinstance(c, str) else c.asc_nulls_last() for c in order]


def lag_prev(df: DataFrame, part: str | Sequence[str], order: Sequence, cols: Sequence[str],
             bucket: Column | None = None, suffix: str = "_prev") -> DataFrame:
    """Previous row's value (ascending order) of each column within ``part``.

    With ``bucket`` (a non-decreasing function of the order) the window runs
    per (part, bucket); the first row of each bucket takes the last row of
    the previous non-empty bucket of the same part, found on the small
    per-bucket table.  Exact, and a hot key is spread over its buckets.
    """
    part = [part] if isinstance(part, str) else list(part)
    if bucket is None:
        w = Window.partitionBy(*part).orderBy(*_asc(order))
        return df.withColumns({f"{c}{suffix}": F.lag(c).over(w) for c in cols})
    # a row without an order comes last, in a bucket of its own after all others
    b = "_lag_bucket"
    df = df.withColumn(b, bucket)
    w = Window.partitionBy(*part, b).orderBy(*_asc(order))
    rows = df.withColumn("_rn", F.row_number().over(w)).withColumns({f"{c}{suffix}": F.lag(c).over(w) for c in cols})
    order_key = F.struct(*[(F.col(o) if isinstance(o, str) else o) for o in order])
    last = df.groupBy(*part, b).agg(*[F.max_by(c, order_key).alias(f"_last_{c}") for c in cols])
    wb = Window.partitionBy(*part).orderBy(F.col(b).asc_nulls_last())
    carry = last.select(*[F.col(c).alias(f"_k_{c}") for c in [*part, b]],
                        *[F.lag(f"_last_{c}").over(wb).alias(f"_carry_{c}") for c in cols])
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*part, b]]
    on = same[0]
    for x in same[1:]:
        on = on & x
    out = rows.join(carry, on, "left").drop(*[f"_k_{c}" for c in [*part, b]])
    return out.withColumns({
        f"{c}{suffix}": F.when(F.col("_rn") == 1, F.col(f"_carry_{c}")).otherwise(F.col(f"{c}{suffix}"))
        for c in cols
    }).drop("_rn", b, *[f"_carry_{c}" for c in cols])


def pct_change_expr(x: Column, prev: Column, upper: float = 30.0) -> Column:
    """(x - prev) / (prev + 1), capped at ``upper``.

    prev = -1 makes the pandas quotient infinite: +inf is capped to
    ``upper``; -inf and 0/0 are given as NULL.
    """
    diff = x - prev
    den = prev + F.lit(1)
    return F.when((den == 0) & (diff > 0), F.lit(upper)).otherwise(cap(safe_div(diff, den), upper))


def pct_change(df: DataFrame, part: str, order: Sequence, col: str, out: str = "balance_pct_change",
               upper: float = 30.0, bucket: Column | None = None) -> DataFrame:
    """Month-on-month relative change of ``col`` per ``part`` (first row NULL)."""
    with_prev = lag_prev(df, part, order, [col], bucket=bucket, suffix="__prev")
    return with_prev.withColumn(out, pct_change_expr(F.col(col), F.col(f"{col}__prev"), upper)).drop(f"{col}__prev")


def top_n_rank(df: DataFrame, key: str | Sequence[str], order: Sequence, n: int, rn: str = "_rn") -> DataFrame:
    """Rows ranked 1..n per key in (order desc, missing last).

    The filter sits right on the window so Spark inserts a partial
    WindowGroupLimit before the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*_desc(order))
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)


def latest_n_parts(df: DataFrame, key: str, order: Sequence, cols: Sequence[str], n: int = 4,
                   first_skips_null: bool = False, name_fmt: str = "{col}{i}") -> list[DataFrame]:
    """``latest_n_wide`` as keyed parts (one part, or slot 0 and slots 1..n-1
    with ``first_skips_null``) so a caller can left-join them separately."""
    ranked = top_n_rank(df, key, order, n)
    slots = ranked.groupBy(key).agg(*[
        F.max(F.when(F.col("_rn") == i + 1, F.col(c))).alias(name_fmt.format(col=c, i=i))
        for i in range(n) for c in cols
        if not (first_skips_null and i == 0)
    ])
    if not first_skips_null:
        return [slots]
    first = df.groupBy(key).agg(*[latest_expr(c, order).alias(name_fmt.format(col=c, i=0)) for c in cols])
    return [first, slots]


def latest_n_wide(df: DataFrame, key: str, order: Sequence, cols: Sequence[str], n: int = 4,
                  first_skips_null: bool = False, name_fmt: str = "{col}{i}") -> DataFrame:
    """The n most recent rows per key flattened to columns ``col0..col{n-1}``.

    ``nth(i)`` semantics: slot i is the i-th row (0 = newest), missing
    values are kept.  With ``first_skips_null`` slot 0 is ``first()``
    instead: the newest present value of each column over all rows.
    """
    ranked = top_n_rank(df, key, order, n)
    slots = ranked.groupBy(key).agg(*[
        F.max(F.when(F.col("_rn") == i + 1, F.col(c))).alias(name_fmt.format(col=c, i=i))
        for i in range(n) for c in cols
        if not (first_skips_null and i == 0)
    ])
    if not first_skips_null:
        return slots.select(key, *[name_fmt.format(col=c, i=i) for i in range(n) for c in cols])
    first = df.groupBy(key).agg(*[latest_expr(c, order).alias(name_fmt.format(col=c, i=0)) for c in cols])
    return first.join(slots, on=key, how="full").select(
        key, *[name_fmt.format(col=c, i=i) for i in range(n) for c in cols])


def padded_sequences(parent: DataFrame, parent_key: str, child: DataFrame, key: str, order: Sequence,
                     cols: Sequence[str], n: int = SEQ_ROWS, pad: float = SEQ_PAD, out: str = "seq") -> DataFrame:
    """n newest child rows per parent as one row-major array of n*len(cols).

    Short histories are padded with ``pad`` rows at the end; a parent with
    no child rows gets n pad rows.  Parents are matched by key (join), so
    children of unknown parents never shift anyone's rows.
    """
    d = len(cols)
    ranked = top_n_rank(child.filter(F.col(key).isNotNull()), key, order, n)
    rows = ranked.select(key, "_rn", F.array(*[F.col(c).cast("double") for c in cols]).alias("_v"))
    seqs = (rows.groupBy(key)
                .agg(F.array_sort(F.collect_list(F.struct("_rn", "_v"))).alias("_s"))
                .select(F.col(key).alias("_k"),
                        F.flatten(F.transform("_s", lambda s: s["_v"])).alias("_flat")))
    full = F.concat(F.col("_flat"), F.array_repeat(F.lit(pad), F.lit(n * d) - F.size("_flat")))
    joined = parent.select(parent_key).join(seqs, parent[parent_key] == seqs["_k"], "left")
    return joined.select(parent_key, F.coalesce(full, F.array_repeat(F.lit(pad), n * d)).alias(out))


def add_index(df: DataFrame, order: Sequence[str] | None = None, name: str = "row_index",
              start: int = 1) -> DataFrame:
    """Surrogate row index.

    Without ``order``: unique, not dense (``monotonically_increasing_id``).
    With ``order`` (ending in a unique tie-breaker): dense ``start..`` in
    that order.  Rows are range-partitioned and sorted, numbered inside each
    partition, checkpointed (so the numbering is fixed), and shifted by the
    row count of all earlier partitions; the offset table has one row per
    partition, so broadcasting it is bounded by the partition count.
    """
    if not order:
        return df.withColumn(name, F.monotonically_increasing_id())
    ordered = (df.repartitionByRange(*[F.col(o).asc_nulls_last() for o in order])
                 .sortWithinPartitions(*[F.col(o).asc_nulls_last() for o in order])
                 .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = cut_lineage(ordered)
    pid = F.shiftright(F.col("_mid"), 33)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    out = ordered.join(F.broadcast(offsets), pid == offsets["_pid"], "left")
    return out.select(*df.columns, (F.coalesce(F.col("_off"), F.lit(0)) + pos + F.lit(start)).alias(name))


def sample_per_group(df: DataFrame, group: str, id_col: str, seed, quota: int | str = 1) -> DataFrame:
    """Keep ``quota`` rows per group, chosen by md5(id:seed) (reproducible).

    ``quota`` is a number or the name of a per-row quota column.  With a
    column the ids (unique) are numbered in (group, hash, id) order by a
    distributed index, and a row's rank is its number less its group's first:
    no task holds a whole group, and only narrow rows are put in order.
    """
    h = hash_int(id_col, seed)
    df = df.withColumn("_h", h)
    order = [F.col("_h").asc(), F.col(id_col).asc()]
    if isinstance(quota, int):
        w = Window.partitionBy(group).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= quota).drop("_rn", "_h")
    narrow = df.select(F.col(group).alias("_g"), F.col(id_col).alias("_id"), "_h", F.col(quota).alias("_q"))
    ranked = add_index(narrow, order=["_g", "_h", "_id"], name="_n", start=0)
    first = ranked.groupBy("_g").agg(F.min("_n").alias("_first")).withColumnRenamed("_g", "_g2")
    kept = ranked.join(first, F.col("_g").eqNullSafe(F.col("_g2"))).filter(F.col("_n") - F.col("_first") < F.col("_q"))
    return df.drop("_h").join(kept.select(F.col("_id").alias(id_col)), id_col, "left_semi").select(*[c for c in df.columns if c != "_h"])
