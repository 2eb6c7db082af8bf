"""Aggregates that are kept as states and merged with those of later rows.

A ``Totals`` part is one hash aggregate per key whose buffers are plain columns: sums, counts, extremes and, for
the newest or oldest present value, the largest or smallest (order, value) struct.  A ``NewestRows`` part keeps
the n newest rows of each key, a ``Pairs`` part the distinct rows of a mapping.  For all three

    finish(merge([build(a), build(b)])) == finish(build(a union b))

so a table that grows is read once: appended rows are built into a state of their own and merged with the stored
one, whose size follows the keys and not the rows.  Merging is a union and one more aggregate of the same kind,
partial before the shuffle, so it takes any number of states at once and a hot key arrives as one row per task.

Defined cases: rows without a key belong to no state; a key only in one state keeps it; states of empty tables
are empty and change nothing.  Repeated rows count as often as they occur (``Pairs``: once), so the same rows
must not be appended twice.  Sums of floating values are equal up to the order of addition.  A rank among rows
with equal order columns is undefined, as it is for the plain operators; ``order`` should end with a unique
column.  Statistics without a small exact state (distinct counts, modes, quantiles) are refused.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanmart.functions.scalars import order_key
from loanmart.operators.windows import top_n_rank

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class Measure:
    """One feature: ``parts`` names its state columns (aggregate over rows, way of merging), ``value`` gives the
    feature from them.  Measures with equal part names share the column."""
    name: str
    parts: Mapping[str, tuple[Column, str]] = field(hash=False)
    value: Column = field(hash=False)


def _one(name: str, part: str, agg: Column, how: str, value: Callable[[Column], Column] = lambda c: c) -> Measure:
    return Measure(name, {part: (agg, how)}, value(F.col(f"`{part}`")))


def combine(name: str, value: Callable[..., Column], *measures: Measure) -> Measure:
    """A feature computed from the values of others (ratios, means, conditions)."""
    parts: dict[str, tuple[Column, str]] = {}
    for m in measures:
        parts.update(m.parts)
    return Measure(name, parts, value(*[m.value for m in measures]))


def measure(fn: str, name: str, col: str | None = None, order: Sequence | None = None, where: Column | None = None,
            tag: str = "") -> Measure:
    """One aggregate with the meaning of ``agg.agg_expr``.  ``tag`` names the ``where`` condition: measures with
    the same function, column and tag share their state, so a tag must not stand for two conditions."""
    part = f"{fn}|{col or ''}|{tag}"
    if fn == "size":
        return _one(name, part, F.count(F.lit(1)) if where is None else F.count_if(where), "sum")
    x = F.col(col) if where is None else F.when(where, F.col(col))
    if fn == "count":
        return _one(name, part, F.count(x), "sum")
    if fn == "sum":
        return _one(name, part, F.sum(x), "sum", lambda c: F.coalesce(c, F.lit(0)))
    if fn in ("min", "max"):
        return _one(name, part, _MERGE[fn](x), fn)
    if fn == "mean":
        total = _one("", f"sum|{col}|{tag}", F.sum(x), "sum")
        return combine(name, lambda s, n: F.try_divide(s.cast("double"), n), total, measure("count", "", col, None, where, tag))
    if fn in ("first", "last"):
        if not order:
            raise ValueError(f"'{fn}' needs an order")
        pick = F.max if fn == "first" else F.min
        keyed = F.when(x.isNotNull(), F.struct(order_key(order).alias("o"), x.alias("x")))
        return _one(name, part, pick(keyed), "max" if fn == "first" else "min", lambda c: c["x"])
    raise ValueError(f"no mergeable state for {fn!r}")


@dataclass(frozen=True)
class Totals:
    """Measures per key."""
    key: str
    measures: Sequence[Measure]

    def _parts(self) -> dict[str, tuple[Column, str]]:
        out: dict[str, tuple[Column, str]] = {}
        for m in self.measures:
            out.update(m.parts)
        return out

    def build(self, rows: DataFrame) -> DataFrame:
        return rows.filter(F.col(self.key).isNotNull()).groupBy(self.key).agg(
            *[agg.alias(p) for p, (agg, _) in self._parts().items()])

    def merge(self, states: Sequence[DataFrame]) -> DataFrame:
        return _union(states).groupBy(self.key).agg(
            *[_MERGE[how](F.col(f"`{p}`")).alias(p) for p, (_, how) in self._parts().items()])

    def finish(self, state: DataFrame) -> DataFrame:
        return state.select(self.key, *[m.value.alias(m.name) for m in self.measures])


@dataclass(frozen=True)
class NewestRows:
    """The n newest rows of each key in (order desc, missing last), with the columns ``cols``."""
    key: str | Sequence[str]
    order: Sequence[str]
    cols: Sequence[str]
    n: int

    def build(self, rows: DataFrame) -> DataFrame:
        keys = [self.key] if isinstance(self.key, str) else list(self.key)
        present = F.lit(True)
        for k in keys:
            present = present & F.col(k).isNotNull()
        kept = list(dict.fromkeys([*keys, *self.order, *self.cols]))
        return top_n_rank(rows.filter(present).select(*kept), keys, self.order, self.n).drop("_rn")

    def merge(self, states: Sequence[DataFrame]) -> DataFrame:
        return self.build(_union(states))

    def finish(self, state: DataFrame) -> DataFrame:
        return state


@dataclass(frozen=True)
class Pairs:
    """Distinct rows of ``cols``, e.g. which parent a child key belongs to."""
    cols: Sequence[str]

    def build(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.cols).dropna().distinct()

    def merge(self, states: Sequence[DataFrame]) -> DataFrame:
        return self.build(_union(states))

    def finish(self, state: DataFrame) -> DataFrame:
        return state


Part = Totals | NewestRows | Pairs


def _union(states: Sequence[DataFrame]) -> DataFrame:
    out = states[0]
    for s in states[1:]:
        out = out.unionByName(s)
    return out
