"""Relational feature synthesis along declared foreign keys.

An ``EntitySet`` names tables with their index and the parent -> child
edges.  ``synthesize`` builds, for a target table, one hash aggregate per
child keyed by the foreign key (partial aggregation before the shuffle) and
left-joins the results to the target.  With depth 2 a child is first
extended with the aggregates of its own children, so the target also gets
aggregates of aggregates.  A grandchild table is summed up once, into
mergeable states by its foreign key (``RowStates``).  Plan generation walks schema metadata on the
driver; all data work is Spark.

Default primitives: numeric sum, std, max, skew, min, mean; count of
rows; categorical num_unique and mode; boolean percent_true.  Naming
follows ``PRIM(child.column)`` and ``COUNT(child)``.  ``COUNT`` and ``SUM``
of a parent without children are 0, the others are missing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanmart.operators.joins import Relations

NUMERIC_PRIMS = ("sum", "std", "max", "skew", "min", "mean")
CATEGORICAL_PRIMS = ("num_unique", "mode")
BOOLEAN_PRIMS = ("percent_true",)
ZERO_DEFAULT = ("count", "sum")
# Roots that are split while moments are merged: those with more than 1/HOT_SHARE of all states, but at least HOT_LEAST.
HOT_SHARE, HOT_LEAST, SALTS = 256, 10_000, 64
_NUM_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass
class Entity:
    name: str
    df: DataFrame
    index: str
    ignore: tuple[str, ...] = ()


@dataclass
class EntitySet:
    """Tables keyed by name plus parent -> child foreign-key edges."""

    entities: dict[str, Entity] = field(default_factory=dict)
    relations: Relations = field(default_factory=Relations)

    def add(self, name: str, df: DataFrame, index: str, ignore: Sequence[str] = ()) -> "EntitySet":
        self.entities[name] = Entity(name, df, index, tuple(ignore))
        return self

    def relate(self, parent: str, parent_key: str, child: str, child_key: str | None = None) -> "EntitySet":
        self.relations.add(parent, parent_key, child, child_key)
        return self


def skew_expr(x: Column) -> Column:
    """Bias-corrected sample skewness (pandas): NULL below 3 values, 0 for a
    constant column."""
    n = F.count(x).cast("double")
    corr = F.sqrt(n * (n - 1)) / (n - 2)
    # stddev_samp is the STD primitive's own aggregate, so the constant test
    # shares its buffer instead of adding one.
    return F.when(n < 3, F.lit(None).cast("double")).when(F.stddev_samp(x) == 0, F.lit(0.0)) \
        .otherwise(F.skewness(x) * corr)


def prim_expr(prim: str, x: Column) -> Column:
    if prim == "sum":
        return F.sum(x)
    if prim == "std":
        return F.stddev_samp(x)
    if prim == "max":
        return F.max(x)
    if prim == "min":
        return F.min(x)
    if prim == "mean":
        return F.avg(x)
    if prim == "skew":
        return skew_expr(x)
    if prim == "num_unique":
        return F.count_distinct(x)
    if prim == "mode":
        return F.mode(x, True)
    if prim == "percent_true":
        return F.avg(F.coalesce(x.cast("double"), F.lit(0.0)))
    raise ValueError(prim)


def _kinds(df: DataFrame, skip: set[str]) -> tuple[list[str], list[str], list[str]]:
    num, cat, boo = [], [], []
    for f in df.schema.fields:
        if f.name in skip:
            continue
        if isinstance(f.dataType, T.BooleanType):
            boo.append(f.name)
        elif isinstance(f.dataType, _NUM_TYPES):
            num.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            cat.append(f.name)
    return num, cat, boo


def value_counts(child: DataFrame, fk: str, cols: Sequence[str]) -> DataFrame:
    """Rows per (parent ``_fk``, column number ``_c``, value ``_v``): rows become narrow triples that are counted
    partially before the shuffle.  Missing values are left out."""
    triples = child.filter(F.col(fk).isNotNull()).select(
        F.col(fk).alias("_fk"),
        F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"`{c}`").cast("string").alias("v"))
                            for i, c in enumerate(cols)])).alias("_t"))
    return (triples.filter(F.col("_t.v").isNotNull())
                   .groupBy("_fk", F.col("_t.c").alias("_c"), F.col("_t.v").alias("_v"))
                   .agg(F.count(F.lit(1)).alias("_n")))


def counted_stats(counts: DataFrame, child_name: str, cols: Sequence[str],
                  prims: Sequence[str] = CATEGORICAL_PRIMS) -> DataFrame:
    """NUM_UNIQUE and MODE from value counts: one row per (parent, column), spread back to columns by conditional
    aggregation.  Mode ties go to the smallest value."""
    per_col = counts.groupBy("_fk", "_c").agg(
        F.count(F.lit(1)).alias("_nu"),
        F.min_by("_v", F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias("_mode"))
    exprs = []
    for i, c in enumerate(cols):
        if "num_unique" in prims:
            exprs.append(F.max(F.when(F.col("_c") == i, F.col("_nu"))).alias(f"NUM_UNIQUE({child_name}.{c})"))
        if "mode" in prims:
            exprs.append(F.max(F.when(F.col("_c") == i, F.col("_mode"))).alias(f"MODE({child_name}.{c})"))
    return per_col.groupBy("_fk").agg(*exprs)


def category_stats(child: DataFrame, child_name: str, fk: str, cols: Sequence[str],
                   prims: Sequence[str] = CATEGORICAL_PRIMS) -> DataFrame:
    """NUM_UNIQUE and MODE of the categorical columns per parent."""
    return counted_stats(value_counts(child, fk, cols), child_name, cols, prims)


def aggregate_child(child: DataFrame, child_name: str, fk: str, skip: Sequence[str],
                    numeric: Sequence[str] = NUMERIC_PRIMS, categorical: Sequence[str] = CATEGORICAL_PRIMS,
                    boolean: Sequence[str] = BOOLEAN_PRIMS) -> DataFrame:
    """All primitives of one child, grouped by its foreign key.

    Numeric and boolean primitives share one hash aggregate; categorical
    ones are separate narrow aggregations joined on the key, which keeps the
    wide aggregate free of distinct/object aggregates (no Expand of wide
    rows, code generation stays on)."""
    num, cat, boo = _kinds(child, set(skip) | {fk})

    def col(c: str) -> Column:
        return F.col(f"`{c}`")
    n_rows = f"COUNT({child_name})"
    exprs = [prim_expr(p, col(c)).alias(f"{p.upper()}({child_name}.{c})") for c in num for p in numeric]
    exprs += [prim_expr(p, col(c)).alias(f"{p.upper()}({child_name}.{c})") for c in boo for p in boolean]
    rows = child.filter(F.col(fk).isNotNull())
    out = rows.groupBy(F.col(fk).alias("_fk")).agg(F.count(F.lit(1)).alias(n_rows), *exprs)
    if not categorical:
        return out
    stats = category_stats(child, child_name, fk, cat, categorical) if cat else None
    return _with_categories(out, stats, child_name, cat, categorical)


def _with_categories(out: DataFrame, stats: DataFrame | None, child_name: str, cat: Sequence[str],
                     prims: Sequence[str]) -> DataFrame:
    """Numeric features with the categorical ones after them; no value seen counts as 0 distinct ones."""
    names = [f"{p.upper()}({child_name}.{c})" for c in cat for p in prims]
    first = out.columns
    if stats is not None and names:
        out = out.join(stats, on="_fk", how="left")
    return out.select(*[(F.coalesce(F.col(f"`{x}`"), F.lit(0)) if x.startswith("NUM_UNIQUE(") and x in names
                         else F.col(f"`{x}`")).alias(x) for x in [*first, *names]])


@dataclass
class RowStates:
    """The rows of a table by one of its keys, summed up so that they can be summed up again by the key's own
    parent: counts, sums, extremes and central moments of numbers, true counts, value counts of categories.

    A grandchild table is read once into its states; its features per child and per root both come from them.
    Moments are merged about the mean of the merged group (sums first, then the moments about their mean), which
    keeps their accuracy where sums of powers would lose it."""
    name: str
    num: list[str]
    cat: list[str]
    boo: list[str]
    types: dict[str, T.DataType]
    numbers: DataFrame
    counts: DataFrame | None

    @classmethod
    def of(cls, df: DataFrame, name: str, fk: str, skip: set[str]) -> "RowStates":
        from loanmart.session import by_columns, cut_lineage
        num, cat, boo = _kinds(df, skip | {fk})
        exprs = [F.count(F.lit(1)).alias("_rows")]
        for i, c in enumerate(num):
            x = F.col(f"`{c}`")
            m2 = F.var_pop(x) * F.count(x)
            exprs += [F.count(x).alias(f"_n{i}"), F.sum(x).alias(f"_s{i}"), F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}"),
                      m2.alias(f"_m2{i}"),
                      F.coalesce(F.skewness(x) * F.pow(m2, F.lit(1.5)) / F.sqrt(F.count(x)), F.lit(0.0)).alias(f"_m3{i}")]
        exprs += [F.sum(F.coalesce(F.col(f"`{c}`").cast("long"), F.lit(0))).alias(f"_b{i}") for i, c in enumerate(boo)]
        numbers = df.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk")).agg(*exprs)
        with by_columns("states"):
            return cls(name, num, cat, boo, {f.name: f.dataType for f in df.schema.fields}, cut_lineage(numbers),
                       cut_lineage(value_counts(df, fk, cat)) if cat else None)

    def _mean(self, i: int) -> Column:
        """The mean as a double, exactly the value where all values are equal."""
        return F.when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), F.col(f"_lo{i}").cast("double")).otherwise(
            F.try_divide(F.col(f"_s{i}").cast("double"), F.col(f"_n{i}")))

    def lift(self, keys: DataFrame) -> "RowStates":
        """States by the parent: ``keys`` maps ``_fk`` to ``_root`` (one row per ``_fk``)."""
        from loanmart.session import by_columns, cut_lineage
        keys = keys.filter(F.col("_root").isNotNull())
        states = self.numbers.join(keys, "_fk")
        each = range(len(self.num))
        sums = states.groupBy("_root").agg(
            F.sum("_rows").alias("_rows"), F.count(F.lit(1)).alias("_kids"),
            *[e for i in each for e in (F.sum(f"_n{i}").alias(f"_n{i}"), F.sum(f"_s{i}").alias(f"_s{i}"),
                                        F.min(f"_lo{i}").alias(f"_lo{i}"), F.max(f"_hi{i}").alias(f"_hi{i}"))],
            *[F.sum(f"_b{i}").alias(f"_b{i}") for i in range(len(self.boo))])
        with by_columns("sums"):
            sums = cut_lineage(sums)
        if self.num:
            sums = sums.join(self._moments(states, sums), "_root")
        counts = None if self.counts is None else self.counts.join(keys, "_fk").groupBy(
            F.col("_root").alias("_fk"), "_c", "_v").agg(F.sum("_n").alias("_n"))
        return RowStates(self.name, self.num, self.cat, self.boo, self.types, sums.withColumnRenamed("_root", "_fk"), counts)

    def _moments(self, states: DataFrame, sums: DataFrame) -> DataFrame:
        """Second and third central moments by root.  A root with more than 1/HOT_SHARE of all states (so fewer
        than HOT_SHARE such roots) meets its mean in SALTS groups."""
        limit = max(self.numbers.count() / HOT_SHARE, HOT_LEAST)
        hot = [r[0] for r in sums.filter(F.col("_kids") > limit).select("_root").collect()]
        is_hot = F.col("_root").isin(hot)
        each = range(len(self.num))
        centre = sums.select("_root", *[self._mean(i).alias(f"_c{i}") for i in each])
        by = ["_root", "_salt"] if hot else ["_root"]
        if hot:
            salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
            centre = centre.withColumn("_salt", F.explode(salts))
            states = states.withColumn("_salt", F.when(is_hot, F.pmod(F.hash("_fk"), F.lit(SALTS))).otherwise(F.lit(0)))
        met = states.join(centre, by).select(*by, *[c for i in each for c in (
            f"_n{i}", f"_m2{i}", f"_m3{i}", (self._mean(i) - F.col(f"_c{i}")).alias(f"_d{i}"))])
        terms = []
        for i in each:
            n, d, m2, m3 = (F.col(f"{c}{i}") for c in ("_n", "_d", "_m2", "_m3"))
            terms += [F.sum(n).alias(f"_n{i}"), F.sum(n * d).alias(f"_m1{i}"), F.sum(m2 + n * d * d).alias(f"_m2{i}"),
                      F.sum(m3 + 3 * m2 * d + n * d * d * d).alias(f"_m3{i}")]
        total = met.groupBy(*by).agg(*terms)
        if hot:
            total = total.groupBy("_root").agg(*[F.sum(f"{m}{i}").alias(f"{m}{i}") for i in each for m in ("_n", "_m1", "_m2", "_m3")])
        out = []
        for i in each:                                      # the mean was rounded: move the moments by what is left
            n, m2, d = F.col(f"_n{i}"), F.col(f"_m2{i}"), F.try_divide(F.col(f"_m1{i}"), F.col(f"_n{i}"))
            out += [(m2 - n * d * d).alias(f"_m2{i}"), (F.col(f"_m3{i}") - 3 * d * m2 + 2 * n * d * d * d).alias(f"_m3{i}")]
        return total.select("_root", *out)

    def _prim(self, prim: str, i: int) -> Column:
        n, m2 = F.col(f"_n{i}"), F.col(f"_m2{i}")
        same = F.col(f"_lo{i}") == F.col(f"_hi{i}")
        if prim == "std":
            return F.when(n > 1, F.when(same, F.lit(0.0)).otherwise(F.sqrt(m2 / (n - 1))))
        if prim == "skew":
            g = F.sqrt(n) * F.col(f"_m3{i}") / F.pow(m2, F.lit(1.5))
            return F.when(n >= 3, F.when(same, F.lit(0.0)).otherwise(g * F.sqrt(n * (n - 1)) / (n - 2)))
        if prim == "mean":
            kind = self.types[self.num[i]]
            if isinstance(kind, T.DecimalType):             # the type that avg gives
                scale = min(kind.scale + 4, 38)
                return F.try_divide(F.col(f"_s{i}"), n).cast(T.DecimalType(min(kind.precision + 4, 38), scale))
            return self._mean(i)
        return F.col({"sum": f"_s{i}", "min": f"_lo{i}", "max": f"_hi{i}"}[prim])

    def features(self, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
        """What ``aggregate_child`` gives on the rows themselves."""
        out = self.numbers.select(
            "_fk", F.col("_rows").alias(f"COUNT({self.name})"),
            *[self._prim(p, i).alias(f"{p.upper()}({self.name}.{c})") for i, c in enumerate(self.num) for p in numeric],
            *[(F.col(f"_b{i}") / F.col("_rows")).alias(f"PERCENT_TRUE({self.name}.{c})") for i, c in enumerate(self.boo)])
        if self.counts is None or not categorical:
            return out
        return _with_categories(out, counted_stats(self.counts, self.name, self.cat, categorical), self.name, self.cat, categorical)


def _defaults(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    fills = {c for c in cols if c.split("(", 1)[0].lower() in ZERO_DEFAULT}
    if not fills:
        return df
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) if c in fills else F.col(f"`{c}`")
                       for c in df.columns])


def synthesize(es: EntitySet, target: str, depth: int = 2, numeric: Sequence[str] = NUMERIC_PRIMS,
               categorical: Sequence[str] = CATEGORICAL_PRIMS,
               ready: Mapping[tuple[str, str], RowStates] | None = None) -> DataFrame:
    """Target rows with the aggregate features of its children and, with
    depth 2, of its grandchildren: through each child (aggregates of
    aggregates) and lifted to the target by the child's key (aggregates of
    the grandchild rows themselves).  Both come from one set of states per
    grandchild; ``ready`` holds states that the caller has already built,
    by (parent, child)."""
    ent = es.entities[target]
    out = ent.df
    if depth <= 0:
        return out
    for edge in es.relations.children(target):
        child = es.entities[edge.child]
        cdf = child.df
        lower_edges = es.relations.children(edge.child) if depth > 1 else ()
        states = {(edge.child, low.child): _states(es, low) for low in lower_edges}
        if not lower_edges and ready and (target, edge.child) in ready:
            out = _attach(out, edge.parent_key, ready[target, edge.child].features(numeric, categorical))
            continue
        if lower_edges:
            # The extended child feeds the numeric and the categorical
            # aggregates: write it once instead of aggregating its own
            # children twice.  Rows of a parent are put side by side (a parent with very many in several places):
            # the partial sums of a parent are wider than its rows, and so leave a task once.
            from loanmart.session import store_rows
            cdf = synthesize(es, edge.child, depth - 1, numeric, categorical, states)
            cdf = store_rows(cdf.hint("rebalance", F.col(f"`{edge.child_key}`")), "child")
        skip = {child.index, edge.child_key, *child.ignore}
        agg = aggregate_child(cdf, edge.child, edge.child_key, sorted(skip), numeric, categorical)
        out = _attach(out, edge.parent_key, agg)
        for low in lower_edges:
            keys = child.df.select(F.col(low.parent_key).alias("_fk"), F.col(edge.child_key).alias("_root"))
            out = _attach(out, edge.parent_key, states[edge.child, low.child].lift(keys).features(numeric, categorical))
    return out


def _states(es: EntitySet, edge) -> RowStates:
    ent = es.entities[edge.child]
    return RowStates.of(ent.df, edge.child, edge.child_key, {ent.index, edge.child_key, *ent.ignore})


def _attach(out: DataFrame, key: str, agg: DataFrame) -> DataFrame:
    """Left-join a child's aggregates (keyed by ``_fk``) with their defaults."""
    new_cols = [c for c in agg.columns if c != "_fk"]
    return _defaults(out.join(agg, out[key] == agg["_fk"], "left").drop("_fk"), new_cols)


def dfs_transforms(df: DataFrame, dates: Sequence[str] = (), texts: Sequence[str] = ()) -> DataFrame:
    """Row transforms stacked by synthesis: day, month, year, weekday of
    dates; word and character counts of text."""
    new = {}
    for c in dates:
        new[f"DAY({c})"] = F.dayofmonth(c)
        new[f"MONTH({c})"] = F.month(c)
        new[f"YEAR({c})"] = F.year(c)
        new[f"WEEKDAY({c})"] = F.weekday(c)
    for c in texts:
        new[f"NUM_WORDS({c})"] = F.length(c) - F.length(F.regexp_replace(c, " ", "")) + 1
        new[f"NUM_CHARACTERS({c})"] = F.length(c)
    return df.withColumns(new)
