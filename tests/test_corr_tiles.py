"""Correlation in column tiles against one tile and against pandas."""

import numpy as np
import pandas as pd
import pytest

from loanmart.operators import prep as P


def frame(spark, n, d, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[:, 1::3] = x[:, ::3][:, :x[:, 1::3].shape[1]] * 2 + 0.3 * x[:, 1::3] + 50
    x[rng.random((n, d)) < 0.1] = np.nan
    x[:, 4] = 7.0                                           # constant
    names = [f"v.{i}" for i in range(d)]                    # names with a dot
    pdf = pd.DataFrame(x, columns=names)
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), ", ".join(f"`{c}` double" for c in names)), pdf


@pytest.mark.parametrize("tile", [3, 4, 5, 512])
def test_tiles_give_the_same_pairs(spark, tile):
    df, pdf = frame(spark, 90, 11)
    got = {(r["i"], r["j"]): r["corr"] for r in P.pairwise_corr(df.repartition(3), df.columns, tile).collect()}
    assert len(got) == 11 * 10 // 2 and all(i < j for i, j in got)
    want = pdf.corr().to_numpy()
    for (i, j), r in got.items():
        assert (r is None) == (4 in (i, j)) and (r is None or r == pytest.approx(want[i, j], abs=1e-9))


def test_three_thousand_columns(spark):
    """Nine million numbers a matrix would be 72 MB each; a task holds tiles of 1,000 squared (8 MB each) and packed rows of 1 MB."""
    rng = np.random.default_rng(4)
    d, n = 3000, 40
    base = rng.normal(size=(n, d)).astype("float64")
    from pyspark.sql import functions as F
    small = spark.createDataFrame([(base[k].tolist(),) for k in range(n)], "a array<double>")
    df = small.select(*[F.col("a")[i].alias(f"x{i}") for i in range(d)])
    pairs = P.pairwise_corr(df, df.columns, 1000)
    assert pairs.count() == d * (d - 1) // 2
    want = np.corrcoef(base.T)
    for r in pairs.filter("(i * 7 + j) % 40009 = 0").collect():
        assert r["corr"] == pytest.approx(want[r["i"], r["j"]], abs=1e-9)


def test_no_rows_and_few_columns(spark):
    df, _ = frame(spark, 6, 6)
    assert {r["corr"] for r in P.pairwise_corr(df.limit(0), df.columns, 4).collect()} <= {None}
    assert P.pairwise_corr(df, df.columns[:1]).count() == 0 and P.pairwise_corr(df, []).count() == 0
