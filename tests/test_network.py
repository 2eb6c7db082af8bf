"""Data-parallel networks: gradients against finite differences, weights whatever the partitions, learning."""

import numpy as np
import pytest

from loanmart.operators import network as N
from loanmart.operators.network import NetParams, fit_network


@pytest.mark.parametrize("shape,layers", [
    ((6,), [N.Dense(5), N.BatchNorm(), N.Relu(), N.Dropout(0.3), N.Dense(1)]),
    ((5, 7, 1), [N.Conv(3, 5), N.Relu(), N.Pool(), N.Conv(2, 3), N.Relu(), N.Flat(), N.Dense(4), N.Relu(), N.Dense(1)]),
    ((4, 3), [N.Lstm(5), N.BatchNorm(), N.Dropout(0.2), N.Lstm(3), N.Flat(), N.Dense(1)])], ids=["dense", "conv", "lstm"])
def test_gradients(shape, layers):
    rng = np.random.default_rng(0)
    net = N.Net(shape, layers)
    w, s = net.start(3)
    w += rng.normal(size=len(w)) * 0.1
    x, y, rows = rng.normal(size=(9, int(np.prod(shape)))), rng.integers(0, 2, 9).astype(float), np.arange(9, dtype=np.uint64) * np.uint64(977)
    loss = lambda v: net.gradient(x, y, rows, 5, v, s)[0]
    grad = net.gradient(x, y, rows, 5, w, s)[1]
    for i in rng.choice(len(w), min(len(w), 60), replace=False):
        e = np.zeros(len(w))
        e[i] = 1e-5
        assert grad[i] == pytest.approx((loss(w + e) - loss(w - e)) / 2e-5, abs=2e-5)


def rows(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)) * [1, 5, 1, 1, 1, 0] + [0, 100, 0, 0, 0, 3]
    y = ((x[:, 0] * (x[:, 1] - 100) / 5 + x[:, 2] + 0.3 * rng.normal(size=n)) > 0.2).astype(int)
    x[rng.random((n, 6)) < 0.02] = np.nan
    return [(seed * 10 ** 6 + i, int(b), [None if np.isnan(v) else float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]


def test_weights_do_not_depend_on_partitions_and_the_net_learns(spark, tmp_path):
    from loanmart.operators.metrics import auc
    ddl = "id bigint, y int, x array<double>"
    train = spark.createDataFrame([*rows(900, 1), (5, None, [0.0] * 6), (6, 1, None)], ddl)
    p = NetParams(epochs=6, batch_rows=300, micro_rows=100, rate=0.02, valid_share=0.2)
    a = fit_network(train.repartition(1), "id", "y", "x", (6,), N.connected((16, 8), 0.1), p)
    b = fit_network(train.repartition(5), "id", "y", "x", (6,), N.connected((16, 8), 0.1), p)
    assert np.array_equal(a.weights, b.weights) and a.history == b.history and len(a.history) == 6
    assert a.history[-1][1] < a.history[0][1]
    got = a.score(spark.createDataFrame(rows(600, 2), ddl), ["id", "y"], "x")
    assert auc(got.select(got["y"].alias("label"), "score")).first()["auc"] > 0.75
    a.save(spark, f"{tmp_path}/net")
    again = N.NetModel.load(spark.newSession(), f"{tmp_path}/net")
    assert sorted(again.score(train.filter("x IS NOT NULL"), ["id"], "x").collect()) == sorted(a.score(train.filter("x IS NOT NULL"), ["id"], "x").collect())
    h = a.hidden(spark.createDataFrame(rows(10, 3), ddl), ["id"], "x", 2).collect()
    assert len(h) == 10 and all(len(r["hidden"]) == 16 and min(r["hidden"]) >= 0 for r in h)
    none = fit_network(train.limit(0), "id", "y", "x", (6,), N.connected((4,)), p)
    assert {r["score"] for r in none.score(train.filter("x IS NOT NULL"), ["id"], "x").collect()} == {0.5}


def test_early_stop_keeps_the_best(spark):
    rng = np.random.default_rng(7)                          # labels that nothing predicts: the held-out loss soon rises
    df = spark.createDataFrame([(i, int(rng.random() < 0.5), rng.normal(size=4).tolist()) for i in range(300)], "id bigint, y int, x array<double>")
    m = fit_network(df, "id", "y", "x", (4,), N.connected((20,), 0.0), NetParams(epochs=40, batch_rows=300, rate=0.1, patience=2, valid_share=0.3))
    losses = [x[2] for x in m.history]
    assert len(losses) < 40 and min(losses) == losses[-3]


@pytest.mark.parametrize("how", ["conv", "lstm"])
def test_learned_sequence_features(spark, how):
    """The label follows the change between a parent's two newest rows: the features tell it apart, padding alone does not."""
    from loanmart.plans.mart import learned_sequence_features
    rng = np.random.default_rng(9)
    parents, children = [], []
    for i in range(260):
        v = rng.normal(size=(int(rng.integers(2, 7)), 3))
        parents.append((i, int(v[0, 0] - v[1, 0] > 0)))
        children += [(i, 10 * i + k, -k, *map(float, r), "ab"[int(r[1] > 0)]) for k, r in enumerate(v)]
    parents += [(1000 + i, int(i % 2)) for i in range(6)]                       # no children
    parent = spark.createDataFrame(parents, "k bigint, y int")
    child = spark.createDataFrame(children, "k bigint, cid bigint, day int, a double, b double, c double, s string").repartition(3)
    p = NetParams(epochs=12, batch_rows=60, micro_rows=60, rate=0.01, valid_share=0.15, patience=12)
    out, model = learned_sequence_features(parent, "k", "y", child, "k", ["day", "cid"], ["a", "b", "c", "s"], how, k=8, test_size=0.2, params=p)
    assert out.columns == ["k", *[f"bfeat_{i}" for i in range(1, 9)]] and out.count() == 266
    assert model.history[-1][1] < 0.75 * model.history[0][1] and min(x[2] for x in model.history) < 0.62
