"""Ward linkage in bounded cells: one cluster per kept row.

Ward's criterion merges the two clusters whose union adds the least to the sum of squares.  A cluster is known by its
summary (rows, mean), so equal vectors are one summary from the start and summaries merge without their rows.

1. Equal vectors become one summary; their copies are merges of height 0.
2. Summaries are dealt into cells of at most ``cell_rows``: a cell that is larger is parted among the ``FAN`` of its own
   vectors with the smallest hashes, each vector going to the nearest, and so on.
3. Each cell is merged to the end by a nearest-neighbour chain with Lance-Williams updates (``chain``).  Heights never
   fall along a branch, so the lowest merges of a cell are a cut of its tree.
4. Of the merges of all cells the lowest N - n_clusters are kept, by a distributed order of (height, cell, step).

With all summaries in one cell this is plain Ward linkage; with more, clusters do not reach over a cell's border.  The
driver sees counts only; no task holds more than a cell, whatever share of the rows is equal.

Defined cases: rows with a NULL vector or id are left out; vectors must have one length; ``n_clusters`` at or above the
number of rows leaves each row alone; fewer clusters than cells give one cluster per cell (a smaller number
needs larger cells); ties of distances go to the vector whose smallest id comes first in text order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loanmart.functions.scalars import hash_int
from loanmart.operators.sample import balanced_union, class_partition
from loanmart.operators.windows import add_index
from loanmart.session import cut_lineage

CELL_ROWS, FAN = 2048, 16


def chain(x: np.ndarray, n: np.ndarray) -> list[tuple[int, int, float]]:
    """Ward merges of weighted points as (slot kept, slot merged into it, height), by rising height.

    A height is the growth of the sum of squares; a merged cluster lives on in the slot kept, the lower one.
    """
    m = len(x)
    size = n.astype(np.float64).copy()
    sq = (x * x).sum(1)
    d = np.maximum(sq[:, None] + sq[None, :] - 2 * (x @ x.T), 0.0) * (size[:, None] * size[None, :] / (size[:, None] + size[None, :]))
    np.fill_diagonal(d, np.inf)
    alive = np.ones(m, bool)
    path: list[int] = []
    merges = []
    for _ in range(m - 1):
        if not path:
            path.append(int(np.argmax(alive)))
        while True:
            a = path[-1]
            b = int(np.argmin(d[a]))
            if len(path) > 1 and d[a, path[-2]] <= d[a, b]:  # the one before is as near: a pair of nearest neighbours
                b = path[-2]
                break
            path.append(b)
        del path[-2:]
        i, j = min(a, b), max(a, b)
        h = d[i, j]
        merges.append((i, j, float(h)))
        total = size[i] + size[j] + size
        row = ((size[i] + size) * d[i] + (size[j] + size) * d[j] - size * h) / total
        row[~alive] = np.inf
        row[[i, j]] = np.inf
        d[i], d[:, i] = row, row
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        alive[j] = False
    # a parent is never below its children but by rounding, which the running maximum takes back
    top: dict[int, float] = {}
    lifted = []
    for i, j, h in merges:
        h = max(h, top.get(i, 0.0), top.get(j, 0.0))
        top[i] = h
        lifted.append((i, j, h))
    order = sorted(range(len(lifted)), key=lambda k: (lifted[k][2], k))
    return [lifted[k] for k in order]


def cells(points: DataFrame, cell_rows: int = CELL_ROWS, seed: int = 7) -> DataFrame:
    """``points`` (sid, x, ...) with ``cell``, a path of nearest vectors; no cell has more than ``cell_rows`` rows."""
    now = points.withColumn("cell", F.lit(""))
    while True:
        now = cut_lineage(now)
        large = now.groupBy("cell").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > cell_rows).select("cell")
        if large.isEmpty():
            return now
        order = Window.partitionBy("cell").orderBy(hash_int("sid", seed), "sid")
        few = (now.join(large, "cell", "left_semi").select("cell", "sid", "x").withColumn("r", F.row_number().over(order))
               .filter(F.col("r") <= FAN).groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("r", "x"))).alias("centres")))
        # centres: FAN vectors for each of at most rows / cell_rows cells
        def gap(c):
            return F.aggregate(F.zip_with("x", c["x"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

        best = F.array_min(F.transform("centres", lambda c: F.struct(gap(c).alias("d"), c["r"].alias("r"))))["r"]
        step = F.when(F.col("centres").isNull(), F.col("cell")).otherwise(F.concat("cell", F.lit("/"), best.cast("string")))
        now = now.join(few, "cell", "left").withColumn("cell", step).drop("centres")


def _merges(placed: DataFrame) -> DataFrame:
    """(cell, step, height, a, b): the merges of every cell; a and b are slots' ids."""
    def fn(t: pa.Table) -> pa.Table:
        t = t.sort_by("sid")
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        found = chain(x, t.column("n").to_numpy())
        sid = t.column("sid").to_pylist()
        return pa.table({"cell": pa.array([t.column("cell")[0].as_py()] * len(found), pa.string()),
                         "step": pa.array(range(len(found)), pa.int32()), "height": pa.array([m[2] for m in found], pa.float64()),
                         "a": pa.array([sid[m[0]] for m in found], pa.string()), "b": pa.array([sid[m[1]] for m in found], pa.string())})

    return placed.groupBy("cell").applyInArrow(fn, "cell string, step int, height double, a string, b string")


def _labels(kept: DataFrame) -> DataFrame:
    """(sid, top) of the summaries that kept merges join: the slot that they end in."""
    def fn(t: pa.Table) -> pa.Table:
        t = t.sort_by("step")
        into = dict(zip(t.column("b").to_pylist(), t.column("a").to_pylist()))

        def end(s):
            while s in into:
                s = into[s]
            return s
        return pa.table({"sid": pa.array(list(into), pa.string()), "top": pa.array([end(s) for s in into], pa.string())})

    return kept.groupBy("cell").applyInArrow(fn, "sid string, top string")


def ward_clusters(df: DataFrame, id_col: str, vec: str, n_clusters: int, cell_rows: int = CELL_ROWS, seed: int = 7) -> DataFrame:
    """``id_col``, ``cluster`` (text of an id in it) for every row of ``df``; ``n_clusters`` clusters in all.

    Ids are unique; vectors are taken as they are (standardise them before).
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{id_col}`").cast("string").alias("key"),
                     F.col(f"`{vec}`").cast("array<double>").alias("x")).filter("id IS NOT NULL AND x IS NOT NULL")
    rows = cut_lineage(rows)
    sums = rows.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("sid"))
    placed = cells(sums, cell_rows, seed)
    total = rows.count()
    spare = max(0, total - max(0, int(n_clusters)))          # merges to keep
    named = rows.join(placed.select("x", "sid", "n"), "x").select("id", "key", "sid", "n")
    copies = placed.agg(F.sum(F.col("n") - 1).alias("c")).first()["c"] or 0
    if copies > spare:                                      # some copies stay alone
        more = add_index(named.filter("key <> sid").select("key"), order=["key"], name="at").filter(F.col("at") <= spare)
        joined = named.join(more.select("key", F.lit(True).alias("in")), "key", "left")
        return joined.select(F.col("id").alias(id_col), F.when(F.col("in"), F.col("sid")).otherwise(F.col("key")).alias("cluster"))
    found = cut_lineage(_merges(placed))
    kept = add_index(found, order=["height", "cell", "step"], name="at").filter(F.col("at") <= spare - copies)
    top = _labels(kept.drop("at"))
    return named.join(top, "sid", "left").select(F.col("id").alias(id_col), F.coalesce("top", "sid").alias("cluster"))


def one_per_cluster(clusters: DataFrame, id_col: str, seed: int = 1) -> DataFrame:
    """``id_col`` of one row of each cluster, the one with the smallest md5(id:seed), and ``cluster_size``."""
    pick = F.min_by(F.col(id_col), F.struct(hash_int(id_col, seed), F.col(id_col)))
    return clusters.groupBy("cluster").agg(pick.alias(id_col), F.count(F.lit(1)).alias("cluster_size")).drop("cluster")


def standardised(df: DataFrame, vec: str) -> DataFrame:
    """``vec`` with every component at mean 0 and population deviation 1 (0 if it is constant)."""
    parts = df.select(F.posexplode(F.col(vec).cast("array<double>")).alias("i", "v")).groupBy("i").agg(
        F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect()                 # two numbers a component
    mean, dev = (F.array(*[F.lit(float(r[c])) for r in parts]) for c in ("m", "s"))
    centred = F.zip_with(F.col(vec).cast("array<double>"), mean, lambda a, b: a - b)
    return df.withColumn(vec, F.zip_with(centred, dev, lambda a, s: F.when(s > 0, a / s).otherwise(0.0)) if parts else F.col(vec))


def ward_undersample(df: DataFrame, id_col: str, label: str, vec: str, seed: int = 1, target: int | None = None,
                     cell_rows: int = CELL_ROWS, negative=0, positive=1) -> DataFrame:
    """One majority row for each of ``target`` Ward clusters (default: the minority's size), and the minority."""
    neg, pos = class_partition(df, label, negative, positive)
    target = pos.count() if target is None else target
    kept = one_per_cluster(ward_clusters(standardised(neg.select(id_col, vec), vec), id_col, vec, target, cell_rows, seed), id_col, seed)
    return balanced_union(neg.join(kept.select(id_col), id_col, "left_semi").select(*neg.columns), pos)
