"""Driver contract: entry runs, every key has a query, SQL keys match DuckDB
on the smallest tables, synthesis matches pandas on a fixture."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001, rows

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "SK_ID_CURR" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.oracle_sql()) >= 80


#: Keys held against their SQL here, at least one of each kind; scripts/check_oracle.py runs all of them.
KEYS = """block_previous block_installment block_card feature_mart category_shares pivot_stats_by_category padded_sequences
surrogate_index kfold_assign metric_auc roc_points pr_points threshold_table metric_kappa correlation_matrix correlated_columns
dfs_depth1 dfs_depth2 feature_count knn_minority smote nearest_centroid cluster_quota_sample cluster_undersample
under_over_sample random_undersample one_hot_drop_first one_hot_high_cardinality label_encode impute_mean standard_scale
pca_variance lag_pct_change latest_n_wide_skipnull sample_per_group bucketed_previous_block feature_sink_roundtrip
sequence_embedding score_submission""".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF001}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_oracle_parity_sf0001(spark, con, key):
    import sys
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts"))
    from check_oracle import digest
    df = E.queries()[key](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    exp = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(got, df.columns)[0] == digest(exp, ocols)[0]


def test_synthesis_moments_match_pandas(spark):
    import pandas as pd
    from loanmart.operators import synth as D
    kids = [(1, 1, 2.0, "a"), (2, 1, 4.0, "b"), (3, 1, 9.0, "b"), (4, 2, 1.0, None), (5, 2, 1.0, "c"),
            (6, 2, 1.0, "c"), (7, 3, 5.0, "a")]
    es = D.EntitySet()
    es.add("p", spark.createDataFrame([(1,), (2,), (3,), (4,)], "pid bigint"), "pid")
    es.add("c", spark.createDataFrame(kids, "cid bigint, pid bigint, v double, s string"), "cid")
    es.relate("p", "pid", "c", "pid")
    out = {r["pid"]: r for r in rows(D.synthesize(es, "p", depth=1))}
    pdf = pd.DataFrame(kids, columns=["cid", "pid", "v", "s"])
    g = pdf.groupby("pid")
    for pid in (1, 2, 3):
        assert out[pid]["STD(c.v)"] == pytest.approx(g.v.std()[pid], nan_ok=True) or pid == 3
        skew = g.v.skew()[pid]
        assert (out[pid]["SKEW(c.v)"] is None) == pd.isna(skew)
        if not pd.isna(skew):
            assert out[pid]["SKEW(c.v)"] == pytest.approx(skew)
        assert out[pid]["NUM_UNIQUE(c.s)"] == g.s.nunique()[pid]
    assert out[1]["MODE(c.s)"] == "b" and out[2]["MODE(c.s)"] == "c" and out[3]["MODE(c.s)"] == "a"
    assert out[3]["STD(c.v)"] is None and out[2]["SKEW(c.v)"] == 0.0
    assert out[4]["COUNT(c)"] == 0 and out[4]["SUM(c.v)"] == 0 and out[4]["MEAN(c.v)"] is None


def test_import_needs_no_spark():
    """The driver may read oracle_sql() before any session exists."""
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as E; assert len(E.oracle_sql()) >= 80 and len(E.queries()) >= 90"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)
