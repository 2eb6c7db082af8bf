"""Top-k inner products against all pairs."""

import math

import numpy as np
import pytest

from tests.conftest import SF001
from tests.llm.cases import by_id


def plain_top(rows, k, asks):
    """rows: (id, vector); (query_id, rank, vec_id, score) by comparing all pairs."""
    ok = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, v in ok:
        if asks(q):
            near = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return out


def test_op12_against_all_pairs(spark):
    from loanmart.llm.vector_search import op12_vector_search
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = plain_top(rows, 5, lambda i: i % 50 == 0)
    assert by_id(op12_vector_search(spark, SF001).collect()) == by_id(want) and want


@pytest.mark.parametrize("sizes", [(65536, 8192), (40, 3)])
def test_odd_vectors(spark, monkeypatch, sizes):
    """NULLs, NaN, infinities, other and no lengths, copies, equal scores, repeated rows and ids."""
    from pyspark.sql import functions as F
    from loanmart.llm import vector_search as S
    monkeypatch.setattr(S, "SLICE", sizes[0])
    monkeypatch.setattr(S, "LEAST_SLICE", min(sizes[0], S.LEAST_SLICE))
    monkeypatch.setattr(S, "QUERIES", sizes[1])
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(12, 35)) * rng.choice([0.01, 1, 900], 35)).tolist()
    rows = [(i, base[i % 12] if i % 3 else (rng.normal(size=35)).tolist()) for i in range(150)]
    rows += [(1000 + i, base[0]) for i in range(60)] + [(5, base[0]), (5, base[0]), (10, base[1])]
    rows += [(None, base[0]), (200, None), (205, [1.0, None]), (210, [math.nan] * 35), (215, [math.inf] * 35), (220, []), (225, []),
             (230, [1.0, 2.0]), (235, [1.0, 2.0]), (240, [-1.0, 2.0]), (245, [0.0] * 35), (250, [4.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, d int, ids string").repartition(4)
    for k in (1, 4, 300):
        got = S.top_k(df, F.col("id") % 5 == 0, k)
        assert by_id(got.collect()) == by_id(plain_top(rows, k, lambda i: i % 5 == 0))
    assert S.top_k(df.limit(0), F.col("id") % 5 == 0, 3).count() == 0


def test_bounds_drop_candidates():
    """Clustered vectors: most candidates go before the last dimensions, none of the best."""
    from loanmart.llm.vector_search import Columns
    rng = np.random.default_rng(8)
    centre = rng.normal(size=(40, 64)) * 300
    c = np.floor(centre[rng.integers(0, 40, 6000)] + rng.normal(size=(6000, 64)) * 20).astype(np.int64)
    q = c[::500]
    for j, (places, scores) in enumerate(Columns(c).search(q, 6)):
        true = c @ q[j]
        assert (true[places] == scores).all() and len(places) < 60
        assert set(np.flatnonzero(true >= np.sort(true)[-6])) <= set(places.tolist())
