"""Operator fixtures (sequences, correlation, encoders, metrics,
rebalancing) and plan-shape checks."""

import math
import random

import pytest
from pyspark.sql import functions as F

from loanmart.operators import metrics as M
from loanmart.operators import prep as P
from loanmart.operators import resample as R
from loanmart.operators import windows as W
from loanmart.operators.sample import hash_split, kfold_assign
from tests.conftest import rows


def test_seq_small(spark):
    parent = spark.createDataFrame([(a,) for a in (1, 2, 3, 4)], "k bigint")
    child = []
    for k, n in ((2, 2), (3, 5), (4, 7), (99, 3)):          # 99 is not a parent
        child += [(k, 100 * k + i, float(-i), float(i), float(k), float(i * i)) for i in range(n)]
    ch = spark.createDataFrame(child, "k bigint, cid bigint, t double, a double, b double, c double")
    seq = {r["k"]: r["seq"] for r in rows(W.padded_sequences(parent, "k", ch, "k", ["t", "cid"],
                                                              ["t", "a", "b", "c"], n=5, pad=-99.0))}
    assert all(len(v) == 20 for v in seq.values())
    assert seq[1] == [-99.0] * 20
    assert seq[2][:8] == [0.0, 0.0, 2.0, 0.0, -1.0, 1.0, 2.0, 1.0] and seq[2][8:] == [-99.0] * 12
    assert seq[4][:4] == [0.0, 0.0, 4.0, 0.0] and seq[4][16:] == [-4.0, 4.0, 4.0, 16.0]   # 5 newest of 7
    assert seq[3][16:] == [-4.0, 4.0, 3.0, 16.0]


def test_corr_small(spark):
    data = []
    for i in range(40):
        x = float(i % 7) + i * 0.1
        data.append((x, 2 * x, -x, 1.0, x if i % 3 else None, float((i * 13) % 5)))
    df = spark.createDataFrame(data, "x double, x2 double, negx double, const double, xgap double, noise double")
    cols = df.columns
    flags = {r["column"]: r for r in rows(P.correlated_columns(df, cols, 0.98))}
    assert flags["x2"]["dropped"] and flags["xgap"]["dropped"]       # pairwise complete r = 1
    assert not flags["negx"]["dropped"] and not flags["const"]["dropped"] and not flags["x"]["dropped"]
    assert flags["const"]["max_corr"] is None
    import numpy as np
    arr = np.array([[d[0], d[5]] for d in data])
    r = {(x["col_i"], x["col_j"]): x["corr"] for x in rows(P.pairwise_corr(df, cols))}
    assert r[("x", "noise")] == pytest.approx(np.corrcoef(arr.T)[0, 1], abs=1e-12)
    out, dropped = P.drop_correlated(df, cols)
    assert sorted(dropped) == ["x2", "xgap"] and "negx" in out.columns


def test_cat_small(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    filled = P.impute_constant(df, exclude=["id"])
    enc = P.OneHot.fit(filled, ["c"])
    assert enc.categories["c"] == ["Not_Applicable", "a", "b"]
    out = {r["id"]: r for r in rows(enc.transform(filled))}
    assert set(out[1]) == {"id", "c_a", "c_b"} and out[1]["c_b"] == 1 and out[2]["c_a"] == 1
    raw = {r["id"]: r for r in rows(P.OneHot.fit(df, ["c"]).transform(df))}
    assert set(raw[3]) == {"id", "c_b"} and raw[3]["c_b"] == 0
    codes = {r["id"]: r["c"] for r in rows(P.LabelEncoder.fit(df, ["c"]).transform(df))}
    assert codes == {1: 1, 2: 0, 3: 2}


def test_standardizer_roundtrip(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "id int, a double, b double")
    sc = P.Standardizer.fit(df, ["a", "b"])
    z = {r["id"]: r for r in rows(sc.transform(df))}
    assert z[1]["a"] == -1.0 and z[2]["a"] == 1.0 and z[1]["b"] == 0.0   # population std; constant -> 0
    back = {r["id"]: r for r in rows(sc.inverse(sc.transform(df)))}
    assert back[2]["a"] == pytest.approx(3.0) and back[3]["a"] is None


SCORES = [(1, 0, 0.05), (2, 0, 0.1), (3, 1, 0.1), (4, 0, 0.3), (5, 1, 0.7), (6, 1, 0.9)]


def test_score_small(spark):
    s = spark.createDataFrame(SCORES, "id int, label int, score double")
    c = rows(M.confusion(s, threshold=0.1))[0]
    assert (c["tn"], c["fp"], c["fn"], c["tp"]) == (2, 1, 1, 2)     # 0.1 is not above 0.1
    auc = rows(M.auc(s))[0]["auc"]
    pos = [x for _, y, x in SCORES if y == 1]
    neg = [x for _, y, x in SCORES if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute)
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert auc == pytest.approx(ev.evaluate(s.withColumn("label", F.col("label").cast("double"))))
    k = rows(M.kappa(s, threshold=0.1))[0]["kappa"]
    po, pe = 4 / 6, (3 * 3 + 3 * 3) / 36
    assert k == pytest.approx((po - pe) / (1 - pe))
    roc = rows(M.roc_points(s), ["threshold"])
    assert roc[-1]["threshold"] == 1.9 and roc[-1]["tpr"] == 0.0
    assert [r["threshold"] for r in roc[:-1]] == [0.05, 0.1, 0.3, 0.7, 0.9]
    pr = rows(M.pr_points(s), ["threshold"])
    assert [r["threshold"] for r in pr] == [0.1, 0.3, 0.7, 0.9, None]     # stops at full recall
    assert pr[-1]["precision"] == 1.0 and pr[0]["recall"] == 1.0


def test_prefix_sums_many_buckets(spark):
    data = [(float(i) / 997, i % 2) for i in range(997)]
    df = spark.createDataFrame(data, "score double, label int")
    g = M.prefix_sums(M.score_counts(df), "score", ["pos", "neg"], n_buckets=16)
    got = {r["score"]: (r["pos_cum"], r["neg_cum"]) for r in g.collect()}
    acc_p = acc_n = 0
    for s, y in sorted(data):
        acc_p += y
        acc_n += 1 - y
        assert got[s] == (acc_p, acc_n)


def test_minority_small(spark):
    rnd = random.Random(3)
    pts = [(i, [rnd.uniform(0, 10), rnd.uniform(0, 10)], 0) for i in range(8)]
    pts += [(100 + i, [rnd.uniform(0, 1), rnd.uniform(0, 1)], 1) for i in range(3)]
    df = spark.createDataFrame(pts, "id bigint, x array<double>, y int")
    mino = df.filter("y = 1")
    nn = rows(R.knn(mino, "id", "x", k=2, cell_rows=1), ["id", "nbr_rank"])
    assert len(nn) == 6
    syn = rows(R.smote(mino, "id", "x", 5, k=2, seed=1), ["syn_id"])
    assert [r["syn_id"] for r in syn] == [0, 1, 2, 3, 4]
    vec = {i: x for i, x, _ in pts}
    for r in syn:
        a, b, p = vec[r["id"]], vec[r["nbr_id"]], r["vector"]
        u = (p[0] - a[0]) / (b[0] - a[0])
        assert 0 <= u < 1 and p[1] == pytest.approx(a[1] + u * (b[1] - a[1]))
    bal = rows(R.under_over_sample(df, "id", "y", "x", seed=1))
    assert sum(r["label"] == 0 for r in bal) == sum(r["label"] == 1 for r in bal) == 6


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_knn_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    pts = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    df = spark.createDataFrame(pts, "id bigint, x array<double>")
    got = {(r["id"], r["nbr_rank"]): r["nbr_id"] for r in R.knn(df, "id", "x", k=3, cell_rows=8).collect()}
    for i, a in pts:
        d = sorted((math.dist(a, b), j) for j, b in pts if j != i)[:3]
        assert [got[(i, k + 1)] for k in range(3)] == [j for _, j in d]


def test_quota_sums_to_target(spark):
    df = spark.createDataFrame([(i, i % 3 if i < 70 else 3) for i in range(100)], "id int, cluster int")
    out = R.quota_sample(df, "id", "cluster", 17, seed=2)
    assert out.count() == 17
    per = {r["cluster"]: r["count"] for r in out.groupBy("cluster").count().collect()}
    assert per[3] in (5, 6)                       # 30 % of 17, largest remainder


def test_split_and_folds(spark):
    df = spark.range(2000).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    tr, te = hash_split(df, "id", 0.05, 1234)
    a, b = {r[0] for r in tr.select("id").collect()}, {r[0] for r in te.select("id").collect()}
    assert not a & b and len(a | b) == 2000 and 50 < len(b) < 150
    f = kfold_assign(df.repartition(7), "id", "y", k=5)
    counts = {(r["y"], r["fold"]): r["count"] for r in f.groupBy("y", "fold").count().collect()}
    assert all(counts[(1, k)] == 40 for k in range(5)) and all(counts[(0, k)] == 360 for k in range(5))


def test_add_index_dense(spark):
    df = spark.range(500).withColumn("k", (F.col("id") * 7919) % 500).repartition(5)
    idx = W.add_index(df, order=["k"], name="i")
    got = sorted((r["k"], r["i"]) for r in idx.collect())
    assert got == [(k, k + 1) for k in range(500)]


def test_latest_n_plan_shape(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("t"), F.rand(1).alias("v"))
    plan = W.latest_n_wide(df, "k", ["t"], ["v"], n=4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "BatchEvalPython" not in plan
