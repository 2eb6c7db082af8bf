"""Class rebalancing: random and cluster-quota under-sampling, exact k-NN
and SMOTE over-sampling.

Row choices are functions of md5(id:seed), so they do not change when a task
is retried.  K-means starts depend on how rows are laid out, so rows are laid
out by a hash of their id into a number of partitions that follows the row
count before it is fitted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.functions.scalars import hash_int
from loanmart.operators.sample import balanced_union, class_partition
from loanmart.operators.windows import add_index


def take_by_hash(df: DataFrame, id_col: str, n: int, seed) -> DataFrame:
    """The n rows with the smallest md5(id:seed) (ties by id).  Ids and hashes
    alone are put in order by a distributed dense ranking; the rows follow
    by a semi-join."""
    narrow = df.select(F.col(id_col), hash_int(id_col, seed).alias("_h"))
    ranked = add_index(narrow, order=["_h", id_col], name="_i")
    return df.join(ranked.filter(F.col("_i") <= n).select(id_col), id_col, "left_semi").select(*df.columns)


def random_undersample(df: DataFrame, id_col: str, label: str, seed=1, ratio: float = 1.0,
                       negative=0, positive=1) -> DataFrame:
    """All positives plus ``ratio`` x as many negatives drawn by hash."""
    neg, pos = class_partition(df, label, negative, positive)
    n_pos = pos.count()
    return balanced_union(take_by_hash(neg, id_col, int(round(n_pos * ratio)), seed), pos)


# ------------------------------------------------------------ vector helpers

def _matrix(col) -> "np.ndarray":
    """Rows of an Arrow list column of doubles as one matrix."""
    import numpy as np
    col = col.combine_chunks() if hasattr(col, "combine_chunks") else col
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(col), -1) if len(col) else np.zeros((0, 0))


def _sq_dist(a, b):
    """Squared distances of all rows of two matrices, a few rows at a time."""
    import numpy as np
    out = np.empty((len(a), len(b)))
    step = max(1, (1 << 22) // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i:i + step, None, :] - b[None, :, :]
        out[i:i + step] = np.einsum("ijk,ijk->ij", diff, diff)
    return out


def _near_sq_dist(a, b):
    """(squared distances of all rows of two matrices by one matrix product, how far each row's may be off).  None if numbers
    are so large that products overflow.  Rows are moved to the middle of ``b`` first: far from zero little would be left."""
    import numpy as np
    if not a.size or not b.size:
        return None
    with np.errstate(all="ignore"):
        middle = b.mean(0)
        a, b = a - middle, b - middle
        aa, bb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        if not aa.max() + bb.max() < 1e300:
            return None
        d2 = a @ b.T
        d2 *= -2
        d2 += aa[:, None]
        d2 += bb[None, :]
    return d2, (aa + bb.max()) * (8 * (a.shape[1] + 8) * np.finfo("float64").eps)


def _pair_sq_dist(a, b, i, j):
    """Squared distances of the pairs a[i], b[j], as ``_sq_dist`` gives them."""
    import numpy as np
    out = np.empty(len(i))
    step = max(1, (1 << 22) // max(1, a.shape[1]))
    for at in range(0, len(i), step):
        diff = a[i[at:at + step]] - b[j[at:at + step]]
        out[at:at + step] = np.einsum("jk,jk->j", diff, diff)
    return out


def _closest(a, b, k: int, names=None, most=None, step: int = 256):
    """(row of a, row of b, distance) of the k rows of ``b`` closest to each row of ``a``, nearest first, ties by place in ``b``.

    A matrix product bounds all distances, and only pairs that may be among the k are computed as differences.
    ``names``: numbers of the rows of both (rows never meet their own number, ties by number); ``most``: the largest distance for each row."""
    import numpy as np
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    for at in range(0, len(a) if len(b) else 0, step):
        x = a[at:at + step]
        bounds = _near_sq_dist(x, b)
        if bounds is None:
            take = np.ones((len(x), len(b)), bool)
        else:
            near, off = bounds
        if names is not None:
            own = names[0][at:at + step, None] == names[1][None, :]
        if bounds is not None:
            if names is not None:
                near[own] = np.inf
            limit = np.partition(near, k - 1, axis=1)[:, k - 1] + 2 * off if k <= len(b) else np.full(len(x), np.inf)
            if most is not None:
                with np.errstate(over="ignore"):
                    limit = np.minimum(limit, np.square(most[at:at + step]) * (1 + 1e-9) + off)
            take = near <= limit[:, None]
        if names is not None:
            take &= ~own
        i, j = np.nonzero(take)
        d = np.sqrt(_pair_sq_dist(x, b, i, j))
        keep = np.isfinite(d) if most is None else np.isfinite(d) & (d <= most[at:at + step][i])
        i, j, d = i[keep], j[keep], d[keep]
        order = np.lexsort((j if names is None else names[1][j], d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        found.append((i[rank < k] + at, j[rank < k], d[rank < k]))
    return tuple(np.concatenate(c) for c in zip(*found))


def nearest_centroid(df: DataFrame, vec: str, centroids: list[tuple[int, list[float]]], out: str = "cluster"):
    """Index of the nearest centroid (first on ties) for every row, by NumPy
    blocks: no join, no shuffle."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import types as T
    ids = np.array([int(c) for c, _ in centroids])
    points = np.array([v for _, v in centroids], dtype="float64")
    keep = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*keep, T.StructField(out, T.IntegerType())])

    def assign(batches):
        for b in batches:
            if b.num_rows:
                best = _sq_dist(_matrix(b.column(len(keep))), points).argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(ids[best], pa.int32())], names=schema.names)

    cols = [F.col(f"`{f.name}`") for f in keep]
    return df.select(*cols, F.col(vec).cast("array<double>").alias("_vec")).mapInArrow(assign, schema)


def group_means(df: DataFrame, group: str, vec: str) -> list[tuple[int, list[float]]]:
    """Per-group mean vectors (k x d numbers to the driver); the length of
    the vectors comes from the data."""
    rows = df.select(group, F.posexplode(vec).alias("_i", "_v")).groupBy(group, "_i").agg(F.avg("_v").alias("_m")).collect()
    means: dict[int, dict[int, float]] = {}
    for r in rows:
        means.setdefault(r[group], {})[r["_i"]] = r["_m"]
    return sorted((g, [m[i] for i in sorted(m)]) for g, m in means.items())


# ------------------------------------------------------ quota under-sampling

def cluster_quotas(assigned: DataFrame, cluster: str, target: int) -> DataFrame:
    """Per-cluster quota round(target * size / N) by largest remainder, so
    the quotas sum to ``target``.  Exact decimal arithmetic; the table has
    one row per cluster (bounded by the cluster count)."""
    from pyspark.sql import Window
    sizes = assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("_size"))
    q = sizes.withColumn("_N", F.sum("_size").over(Window.partitionBy()))
    product = f"(cast({int(target)} as decimal(20,0)) * cast(_size as decimal(18,0)))"
    q = q.withColumn("_base", F.expr(f"{product} div _N")).withColumn("_rem", F.expr(f"mod({product}, _N)"))
    spare = F.lit(target) - F.sum("_base").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(F.desc("_rem"), F.asc(cluster)))
    return q.withColumn("quota", (F.col("_base") + F.when(rank <= spare, 1).otherwise(0)).cast("bigint")) \
        .select(cluster, "quota")


def quota_sample(assigned: DataFrame, id_col: str, cluster: str, target: int, seed) -> DataFrame:
    """Keep quota(cluster) rows per cluster, chosen by md5(id:seed)."""
    from loanmart.operators.windows import sample_per_group
    quotas = cluster_quotas(assigned, cluster, target)
    joined = assigned.join(quotas, on=cluster, how="inner")
    return sample_per_group(joined, cluster, id_col, seed, quota="quota").drop("quota")


def kmeans_assign(df: DataFrame, id_col: str, vec: str, k: int, seed: int = 1, out: str = "cluster", rows: int = 50_000):
    """Standardise, fit Spark ML KMeans (k-means||), assign clusters.  Rows
    are laid out by id, about ``rows`` to a partition, so that the same rows
    give the same start."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector

    from loanmart.session import cut_lineage
    parts = max(1, -(-df.count() // rows))
    data = df.repartition(parts, id_col).sortWithinPartitions(id_col).withColumn("_v", array_to_vector(F.col(vec)))
    data = cut_lineage(data)
    pipe = Pipeline(stages=[StandardScaler(inputCol="_v", outputCol="_z", withMean=True, withStd=True),
                            KMeans(k=k, seed=seed, featuresCol="_z", predictionCol=out, maxIter=20)])
    model = pipe.fit(data)
    return model.transform(data).drop("_v", "_z")


def cluster_undersample(df: DataFrame, id_col: str, label: str, vec: str, k: int | None = None, seed: int = 1,
                        target: int | None = None, negative=0, positive=1) -> DataFrame:
    """Cluster the majority class and keep a share of each cluster so that
    ``target`` majority rows (default: the minority size) remain, then
    append the minority.  Stand-in for one-per-cluster Ward sampling: the
    cluster count stays modest (default about sqrt(target)) instead of one
    cluster per kept row."""
    import math
    neg, pos = class_partition(df, label, negative, positive)
    n_pos = pos.count()
    target = n_pos if target is None else target
    k = k or max(2, int(math.sqrt(max(target, 1))))
    assigned = kmeans_assign(neg, id_col, vec, k, seed)
    kept = quota_sample(assigned, id_col, "cluster", target, seed).drop("cluster")
    return balanced_union(kept, pos)


# ---------------------------------------------------------------- exact kNN

PROBE_ROWS = 65_536                     # rows that a block of points meets at once
PROBE_VALUES = 1 << 22                  # numbers in the vectors of these rows
BATCH_VALUES = 1 << 20                  # numbers in the vectors of one batch of copied rows


def _pivot_cells(df: DataFrame, id_col: str, vec: str, k: int, block_rows: int, seed: int):
    """(points with cell, block and slice, probes): a probe sends a row to one
    slice of a block whose points may be among its k nearest.  A block that more
    than ``PROBE_ROWS`` rows ask (fewer, if their vectors are long) is there once for
    each slice of them.  See ``knn``."""
    import numpy as np
    import pyarrow as pa
    from loanmart.session import cut_lineage

    base = df.select(F.col(id_col).alias("_id"), F.col(vec).cast("array<double>").alias("_x"))
    kind = base.schema["_id"].dataType.simpleString()
    n = base.count()
    chosen = base.orderBy(hash_int("_id", seed), "_id").limit(max(1, int(n ** 0.5))).collect()
    pivots = np.array([r["_x"] for r in chosen], dtype="float64")
    width = max(1, pivots.shape[-1])
    met, batch = max(1, min(PROBE_ROWS, PROBE_VALUES // width)), max(1, BATCH_VALUES // width)

    def near(batches):
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column(1))
                row, best, d = _closest(x, pivots, 1)
                if len(row) < len(x):                       # no pivot at a finite distance
                    d2 = _sq_dist(x, pivots)
                    best = d2.argmin(1)
                    d = np.sqrt(d2[np.arange(len(best)), best])
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(best, pa.int32()), pa.array(d)],
                                                 names=["_id", "_x", "_c", "_d"])

    cells = base.mapInArrow(near, f"_id {kind}, _x array<double>, _c int, _d double")
    cells = cut_lineage(cells)
    sizes = cells.groupBy("_c").agg(F.max("_d").alias("r"), F.count(F.lit(1)).alias("n")).collect()     # one row per pivot
    reach, blocks = np.full(len(pivots), -np.inf), np.zeros(len(pivots), dtype="int64")
    for r in sizes:
        reach[r["_c"]], blocks[r["_c"]] = r["r"], -(-r["n"] // block_rows)
    per_cell = F.element_at(F.array(*[F.lit(int(x)) for x in blocks]), F.col("_c") + 1) if len(pivots) <= 4096 else None
    if per_cell is None:
        table = df.sparkSession.createDataFrame([(i, int(x)) for i, x in enumerate(blocks)], "_c int, _blocks bigint")
        cells = cells.join(table, "_c")
        per_cell = F.col("_blocks")
    points = cut_lineage(cells.withColumn("_s", F.pmod(F.xxhash64("_id"), per_cell).cast("int")).select("_id", "_x", "_c", "_s"))

    def own_radius(t: pa.Table) -> pa.Table:
        x = _matrix(t.column("_x"))
        r = np.full(len(x), np.inf)
        if len(x) > k:
            place = np.arange(len(x))
            row, _other, d = _closest(x, x, k, (place, place))
            last = np.flatnonzero(np.bincount(row, minlength=len(x)) == k)
            r[last] = d[np.searchsorted(row, last, "right") - 1]
        return pa.table({"_id": t.column("_id"), "_x": t.column("_x"), "_r": pa.array(r)})

    radius = cut_lineage(points.groupBy("_c", "_s").applyInArrow(own_radius, f"_id {kind}, _x array<double>, _r double"))
    first_block = np.concatenate([[0], np.cumsum(blocks)])

    def asked(batches):
        """(part of a batch, its rows asked for, their cells and blocks)."""
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                if not part.num_rows:
                    continue
                r = part.column(2).to_numpy()
                x = _matrix(part.column(1))
                bounds = _near_sq_dist(x, pivots)
                least = _sq_dist(x, pivots) if bounds is None else np.maximum(bounds[0] - bounds[1][:, None], 0)
                gap = np.sqrt(least) - reach[None, :]
                row, cell = np.nonzero(gap <= r[:, None] * (1 + 1e-9) + 1e-9)
                times = blocks[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                first = np.cumsum(times) - times
                yield part, row, cell, np.arange(len(row)) - np.repeat(first, times)

    def count(batches):
        n = np.zeros(first_block[-1], np.int64)
        for _part, _row, cell, block in asked(batches):
            n += np.bincount(first_block[cell] + block, minlength=len(n))
        hit = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(n[hit])], names=["b", "n"])

    slices = np.ones(first_block[-1], np.int64)
    for r in radius.mapInArrow(count, "b bigint, n bigint").groupBy("b").agg(F.sum("n").alias("n")).collect():      # one row per block
        slices[r["b"]] = max(1, -(-r["n"] // met))

    def probe(batches):
        for part, row, cell, block in asked(batches):
            q = part.column(3).to_numpy()[row] % slices[first_block[cell] + block]
            for at in range(0, len(row), batch):            # a row may ask every cell: its copies leave batch by batch
                some = slice(at, at + batch)
                i = pa.array(row[some])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(i), part.column(1).take(i), part.column(2).take(i), pa.array(cell[some], pa.int32()),
                     pa.array(block[some], pa.int32()), pa.array(q[some], pa.int32())], names=["_id", "_x", "_r", "_c", "_s", "_q"])

    def copies(batches):
        for b in batches:
            times = slices[first_block[b.column(2).to_numpy()] + b.column(3).to_numpy()]
            i = np.repeat(np.arange(b.num_rows), times)
            q = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
            for at in range(0, len(i), batch):
                some = pa.array(i[at:at + batch])
                yield pa.RecordBatch.from_arrays([*(c.take(some) for c in b.columns), pa.array(q[at:at + batch], pa.int32())],
                                                 names=["_id", "_x", "_c", "_s", "_q"])

    mark = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)).alias("_h")
    probes = radius.select("_id", "_x", "_r", mark).mapInArrow(probe, f"_id {kind}, _x array<double>, _r double, _c int, _s int, _q int")
    return points.mapInArrow(copies, f"_id {kind}, _x array<double>, _c int, _s int, _q int"), probes


def knn(df: DataFrame, id_col: str, vec: str, k: int = 5, cell_rows: int = 2048, seed: int = 7) -> DataFrame:
    """Exact k nearest neighbours (Euclidean) of every row among the rows.

    1. About sqrt(n) pivots are drawn by hash; each row goes to the cell of
       its nearest pivot, large cells are parted into blocks of ``cell_rows``.
    2. The k-th distance inside a row's own block bounds its radius r.
    3. By the triangle inequality a neighbour within r of x lies in a cell c
       with |x - pivot_c| - reach_c <= r; x is sent to the blocks of those
       cells only, and NumPy compares it there, keeping k rows.
    4. The k closest per row (ties by id) are kept.

    How many blocks step 3 leaves out depends on the data: many where rows
    form clusters, few or none for unclustered rows of many dimensions, where
    exact search has no better bound.  Rows sent grow with n times the number
    of cells reached, pairs are compared in memory and never become rows.
    Output: (id, nbr_id, nbr_rank 1..k, dist).
    """
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import Window

    kind = df.schema[id_col].dataType.simpleString()
    n = df.count()
    if n <= 1:
        return df.sparkSession.createDataFrame([], f"{id_col} {kind}, nbr_id {kind}, nbr_rank int, dist double")
    kk = min(k, n - 1)
    points, probes = _pivot_cells(df, id_col, vec, kk, cell_rows, seed)

    def closest(q: pa.Table, t: pa.Table) -> pa.Table:
        out_id, out_nbr, out_d = [], [], []
        if q.num_rows and t.num_rows:
            ids, mine = np.unique(np.array([*q.column("_id").to_pylist(), *t.column("_id").to_pylist()]), return_inverse=True)
            qi, ti = mine[:q.num_rows], mine[q.num_rows:]
            y = _matrix(t.column("_x"))
            x, r = _matrix(q.column("_x")), q.column("_r").to_numpy()
            i, j, d = _closest(x, y, kk, (qi, ti), r * (1 + 1e-9) + 1e-9)
            out_id, out_nbr, out_d = [i], [j], [d]
        i = pa.array(np.concatenate(out_id) if out_id else [], pa.int64())
        j = pa.array(np.concatenate(out_nbr) if out_nbr else [], pa.int64())
        return pa.table({"_id": q.column("_id").take(i), "_nid": t.column("_id").take(j),
                         "dist": pa.array(np.concatenate(out_d) if out_d else [], pa.float64())})

    cand = probes.groupBy("_c", "_s", "_q").cogroup(points.groupBy("_c", "_s", "_q")).applyInArrow(
        closest, f"_id {kind}, _nid {kind}, dist double")
    wk = Window.partitionBy("_id").orderBy("dist", "_nid")
    top = cand.withColumn("nbr_rank", F.row_number().over(wk)).filter(F.col("nbr_rank") <= kk)
    return top.select(F.col("_id").alias(id_col), F.col("_nid").alias("nbr_id"), "nbr_rank", "dist")


def smote(minority: DataFrame, id_col: str, vec: str, n_new: int, k: int = 5, seed: int = 1,
          neighbours: DataFrame | None = None) -> DataFrame:
    """SMOTE: ``n_new`` synthetic rows x + u * (y - x), y one of the k
    nearest minority neighbours of x.

    Synthetic row j uses the minority row at dense position j mod n (rows
    ordered by id), neighbour rank 1 + md5(id:j:seed:n) mod k and gap
    u = md5(id:j:seed:u) / 2**32.  Nothing is gathered: ids, base rows,
    neighbours and their vectors meet through equi-joins.  Output:
    (syn_id, id, nbr_id, vector).
    """
    from loanmart.functions.scalars import hash_unit
    base = minority.select(F.col(id_col).alias("_id"), F.col(vec).cast("array<double>").alias("_x"))
    n = base.count()
    if n == 0 or n_new <= 0:
        return minority.sparkSession.createDataFrame([], "syn_id bigint, id bigint, nbr_id bigint, "
                                                         "vector array<double>")
    if n < 2:
        raise ValueError("SMOTE needs at least two minority rows")
    nb = neighbours if neighbours is not None else knn(minority, id_col, vec, k)
    kk = min(k, n - 1)
    idx = add_index(base, order=["_id"], name="_i", start=0)
    # Synthetic ids come from a distributed range, not from exploding each
    # base row: with few minority rows and many copies the work still
    # spreads evenly.  Row j uses base row j mod n (an equi-join).
    ids = minority.sparkSession.range(n_new).select(F.col("id").alias("syn_id"), (F.col("id") % n).alias("_i"))
    jobs = ids.join(idx, on="_i", how="inner")
    key = F.concat(F.col("_id").cast("string"), F.lit(":"), F.col("syn_id").cast("string"))
    jobs = jobs.withColumn("_pick", (F.pmod(hash_int(key, f"{seed}:n"), F.lit(kk)) + 1).cast("int")) \
        .withColumn("_u", hash_unit(key, f"{seed}:u"))
    nbrs = nb.select(F.col(id_col).alias("_id"), F.col("nbr_rank").alias("_pick"), F.col("nbr_id"))
    with_nbr = jobs.join(nbrs, on=["_id", "_pick"], how="inner")
    yv = base.select(F.col("_id").alias("nbr_id"), F.col("_x").alias("_y"))
    out = with_nbr.join(yv, on="nbr_id", how="inner")
    vecs = F.zip_with("_x", "_y", lambda a, b: a + F.col("_u") * (b - a))
    return out.select("syn_id", F.col("_id").alias("id"), "nbr_id", vecs.alias("vector"))


def under_over_sample(df: DataFrame, id_col: str, label: str, vec: str, seed: int = 1, k: int = 5,
                      negative=0, positive=1) -> DataFrame:
    """Cluster under-sample the majority to ceil(N/2), then SMOTE the
    minority up to the same count.  Output: (row_id, label, vector, synthetic
    flag); synthetic ids follow the largest real id (text ids get a prefix),
    so ``row_id`` is a key."""
    n_total = df.count()
    half = -(-n_total // 2)
    neg, pos = class_partition(df, label, negative, positive)
    n_neg = neg.count()
    n_pos = pos.count()
    keep_neg = min(half, n_neg)
    if keep_neg < n_neg:
        import math
        assigned = kmeans_assign(neg, id_col, vec, max(2, int(math.sqrt(keep_neg))), seed)
        kept = quota_sample(assigned, id_col, "cluster", keep_neg, seed).drop("cluster")
    else:
        kept = neg
    syn = smote(pos, id_col, vec, max(keep_neg - n_pos, 0), k=k, seed=seed)
    syn = syn.withColumn("syn_id", synthetic_id(df, id_col))
    real = kept.select(*df.columns).unionByName(pos).select(F.col(id_col).alias("row_id"), F.col(label).alias("label"),
                                        F.col(vec).cast("array<double>").alias("vector"),
                                        F.lit(False).alias("synthetic"))
    fake = syn.select(F.col("syn_id").alias("row_id"), F.lit(positive).cast(df.schema[label].dataType).alias("label"),
                      "vector", F.lit(True).alias("synthetic"))
    return real.unionByName(fake)


def synthetic_id(df: DataFrame, id_col: str):
    """Id of synthetic row ``syn_id`` that no row of ``df`` has."""
    from pyspark.sql import types as T
    if isinstance(df.schema[id_col].dataType, T.StringType):
        return F.concat(F.lit("synthetic-"), F.col("syn_id").cast("string"))
    top = df.agg(F.max(id_col).alias("m")).first()["m"]
    return (F.col("syn_id") + F.lit(int(top if top is not None else -1) + 1)).cast(df.schema[id_col].dataType)


def random_under_smote(df: DataFrame, id_col: str, label: str, vec: str, seed: int = 1, k: int = 5,
                       negative=0, positive=1) -> DataFrame:
    """As ``under_over_sample``, the majority rows being drawn by hash."""
    n_total = df.count()
    neg, pos = class_partition(df, label, negative, positive)
    n_neg, n_pos = neg.count(), pos.count()
    keep = min(-(-n_total // 2), n_neg)
    kept = take_by_hash(neg, id_col, keep, seed) if keep < n_neg else neg
    syn = smote(pos, id_col, vec, max(keep - n_pos, 0), k=k, seed=seed).withColumn("syn_id", synthetic_id(df, id_col))
    real = kept.select(*df.columns).unionByName(pos.select(*df.columns))
    cols = [F.col(id_col).alias("row_id"), F.col(label).alias("label"), F.col(vec).cast("array<double>").alias("vector")]
    fake = syn.select(F.col("syn_id").alias("row_id"), F.lit(positive).cast(df.schema[label].dataType).alias("label"), "vector")
    return real.select(*cols, F.lit(False).alias("synthetic")).unionByName(fake.withColumn("synthetic", F.lit(True)))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    from pyspark.sql import Window
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
