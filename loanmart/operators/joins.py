"""Keyed joins of feature blocks.

Feature blocks are aggregates keyed by the applicant id, so each comes out
hash-partitioned on that key; chaining them with equi-joins on the same key
lets the sort-merge joins reuse that partitioning.  No broadcast is forced:
blocks grow with the data, so the strategy is left to AQE, which only
broadcasts a side whose measured size is below the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame


def outer_join_all(dfs: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """``reduce(merge(how='outer'))`` on a shared key; the key is coalesced."""
    on = [key] if isinstance(key, str) else list(key)
    _check_collisions(dfs, on)
    return reduce(lambda a, b: a.join(b, on=on, how="full"), dfs)


SPREAD_BYTES = 1 << 29          # bytes read, from which on a chain of joins keeps all its shuffle partitions


def _bytes_read(dfs: Sequence[DataFrame]) -> int:
    """Bytes of the stored tables below the frames, each counted as often as it is read; checkpoints have no size of their own."""
    total = 0
    for df in dfs:
        found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        leaves = [found.apply(i) for i in range(found.size())]
        total += sum(int(str(x.stats().sizeInBytes())) for x in leaves if x.nodeName() == "LogicalRelation")
    return total


def left_join_all(base: DataFrame, dfs: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """``base`` with the columns of all ``dfs``.

    All joins of the chain run in one stage, and a task holds the sorted rows of every side at once.  AQE would merge
    partitions until their compressed bytes reach its advised size, many times that in memory, so tasks spill; over large
    tables the base is partitioned by number, which leaves the session's partitions as they are.  No shuffle is added:
    the sides come by key in the same number of partitions.
    """
    on = [key] if isinstance(key, str) else list(key)
    _check_collisions([base, *dfs], on)
    if len(dfs) > 1 and _bytes_read([base, *dfs]) > SPREAD_BYTES:
        base = base.repartition(int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")), *on)
    return reduce(lambda a, b: a.join(b, on=on, how="left"), dfs, base)


def _check_collisions(dfs: Sequence[DataFrame], on: Sequence[str]) -> None:
    seen: dict[str, int] = {}
    for i, df in enumerate(dfs):
        for c in df.columns:
            if c in on:
                continue
            if c in seen:
                raise ValueError(f"column {c!r} appears in inputs {seen[c]} and {i}; prefix the blocks first")
            seen[c] = i


def with_prefix(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Rename every column except ``keep`` to ``prefix + name``."""
    return df.select(*[df[c].alias(c if c in keep else f"{prefix}{c}") for c in df.columns])


def join_with_prefix(left: DataFrame, right: DataFrame, key: str | Sequence[str], prefix: str,
                     how: str = "left") -> DataFrame:
    """Join that renames the right side's colliding columns (pandas would
    add ``_x``/``_y``).  A collision that survives the prefix raises."""
    on = [key] if isinstance(key, str) else list(key)
    clash = [c for c in right.columns if c not in on and c in left.columns]
    right = right.select(*[right[c].alias(f"{prefix}{c}" if c in clash else c) for c in right.columns])
    _check_collisions([left, right], on)
    return left.join(right, on=on, how=how)


def restrict_to(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is among the parent's keys (left semi join)."""
    pk = parent_key or key
    ids = parent.select(parent[pk].alias("_rk")).filter("_rk IS NOT NULL")
    return child.join(ids, child[key] == ids["_rk"], "left_semi")


def lift_key(child: DataFrame, parent: DataFrame, key: str, parent_cols: Sequence[str]) -> DataFrame:
    """Bring a grand-parent key onto child rows (inner join on the parent id)."""
    return child.join(parent.select(key, *parent_cols), on=key, how="inner")


@dataclass(frozen=True)
class Relationship:
    parent: str
    parent_key: str
    child: str
    child_key: str


@dataclass
class Relations:
    """Declared parent -> child foreign-key edges of a table set."""

    edges: list[Relationship] = field(default_factory=list)

    def add(self, parent: str, parent_key: str, child: str, child_key: str | None = None) -> "Relations":
        self.edges.append(Relationship(parent, parent_key, child, child_key or parent_key))
        return self

    def children(self, parent: str) -> list[Relationship]:
        return [e for e in self.edges if e.parent == parent]

    def parent_of(self, child: str) -> Relationship | None:
        for e in self.edges:
            if e.child == child:
                return e
        return None
