"""Ward linkage against a plain version that compares all pairs at each step."""

import numpy as np
import pytest

from tests.conftest import SF001


def plain_ward(x, k):
    """Clusters (sets of row numbers) after merging the cheapest pair until k are left."""
    groups = [([i], v.copy()) for i, v in enumerate(x)]
    while len(groups) > k:
        c = np.array([g[1] for g in groups])
        n = np.array([len(g[0]) for g in groups], float)
        d = ((c[:, None] - c[None]) ** 2).sum(2) * (n[:, None] * n[None] / (n[:, None] + n[None]))
        d[np.tril_indices(len(n))] = np.inf
        i, j = np.unravel_index(np.argmin(d), d.shape)
        a, b = groups[i], groups[j]
        groups = [g for t, g in enumerate(groups) if t not in (i, j)]
        groups.append((a[0] + b[0], (a[1] * len(a[0]) + b[1] * len(b[0])) / (len(a[0]) + len(b[0]))))
    return {frozenset(g[0]) for g in groups}


def grouped(rows):
    out = {}
    for i, c in rows:
        out.setdefault(c, set()).add(i)
    return {frozenset(v) for v in out.values()}


@pytest.fixture(scope="module")
def vectors(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").limit(90).collect()
    return [(r[0], [float(v) for v in r[1]]) for r in rows]


@pytest.mark.parametrize("k", [1, 2, 9, 40, 90, 200])
def test_one_cell_is_plain_ward(spark, vectors, k):
    from loanmart.operators.ward import ward_clusters
    ids = [i for i, _ in vectors]
    got = grouped(ward_clusters(spark.createDataFrame(vectors, "vec_id bigint, x array<double>"), "vec_id", "x", k).collect())
    want = {frozenset(ids[i] for i in g) for g in plain_ward(np.array([v for _, v in vectors]), min(k, 90))}
    assert got == want


def test_copies_nulls_and_cells(spark):
    """Equal vectors are one summary; many cells still give the asked number of clusters; rows without a vector go."""
    from loanmart.operators.ward import cells, ward_clusters
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 5)) * 40
    rows = [(i, (centre[i % 12] + rng.normal(size=5)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]
    df = spark.createDataFrame([*rows, (5000, None), (None, [0.0] * 5)], "id bigint, x array<double>").repartition(6)
    placed = cells(spark.createDataFrame([(str(i), v) for i, v in rows[:400]], "sid string, x array<double>"), 60)
    assert max(r["count"] for r in placed.groupBy("cell").count().collect()) <= 60
    for k, cell in ((12, 2048), (100, 60), (100, 2048), (350, 60), (500, 60), (700, 60)):
        got = ward_clusters(df, "id", "x", k, cell).collect()
        assert len(got) == 700 and len({c for _, c in got}) == k
        if k <= 350:                                        # copies stay together
            assert len({c for i, c in got if i >= 1000 or i == 0}) == 1
    blobs = grouped((i if i < 1000 else 0, c) for i, c in ward_clusters(df, "id", "x", 12).collect())
    assert blobs == {frozenset(i for i in range(400) if i % 12 == b) for b in range(12)}
    assert ward_clusters(df.limit(0), "id", "x", 3).count() == 0


def test_undersampling_keeps_one_row_a_cluster(spark):
    from loanmart.operators.ward import one_per_cluster, standardised, ward_clusters, ward_undersample
    rng = np.random.default_rng(4)
    rows = [(i, int(i % 9 == 0), rng.normal(size=3).tolist() + [1.0]) for i in range(180)]
    df = spark.createDataFrame(rows, "id bigint, y int, x array<double>")
    out = ward_undersample(df, "id", "y", "x").collect()
    assert sum(r["y"] for r in out) == 20 and sum(1 - r["y"] for r in out) == 20
    assert {(r["id"], tuple(r["x"])) for r in out} <= {(i, tuple(v)) for i, _, v in rows}
    neg = np.array([v for _, y, v in rows if not y])
    ids = [i for i, y, _ in rows if not y]
    z = (neg - neg.mean(0)) / np.where(neg.std(0) > 0, neg.std(0), 1)
    want = {frozenset(ids[i] for i in g) for g in plain_ward(z, 20)}
    kept = {r["id"] for r in out if not r["y"]}
    assert all(len(kept & g) == 1 for g in want)
    c = ward_clusters(standardised(df.filter("y = 0"), "x"), "id", "x", 20)
    sizes = one_per_cluster(c, "id").collect()
    assert sorted(r["cluster_size"] for r in sizes) == sorted(map(len, want)) and {r["id"] for r in sizes} == kept


def test_query_against_plain(spark):
    """ward_undersample over the whole table: one kept row in each of plain Ward's clusters, and its size."""
    import __spark_entry__ as E
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
    maj = [(r[0], [float(v) for v in r[2]]) for r in rows if r[1] != 0]
    x = np.array([v for _, v in maj])
    want = plain_ward((x - x.mean(0)) / x.std(0), sum(r[1] == 0 for r in rows))
    got = {r["vec_id"]: r["cluster_size"] for r in E.queries()["ward_undersample"](spark, SF001).collect()}
    where = {maj[i][0]: g for g in want for i in g}
    assert len(got) == len(want) == len({where[i] for i in got}) and all(len(where[i]) == n for i, n in got.items())
