"""Fitted preparation and models: saved, loaded in another session, used on raw rows."""

import numpy as np
import pytest

from loanmart.operators.boosting import TreeParams
from loanmart.operators.network import NetParams
from loanmart.plans import mart as MT


@pytest.fixture(scope="module")
def mart(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        a, b, c = rng.normal(), rng.normal(), ["x", "y", "z", None][int(rng.integers(0, 4))]
        rows.append((i, int(a + (c == "x") + rng.normal() * 0.5 > 0.8), float(a), None if i % 9 == 0 else float(b), 2 * float(a), c, "one"))
    return spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, a double, b double, a2 double, c string, d string").repartition(3)


@pytest.mark.parametrize("cfg", [MT.RunConfig(test_size=0.25, max_iter=3, impute="mean"),
                                 MT.RunConfig(test_size=0.25, max_iter=3, resample="ward"),
                                 MT.RunConfig(test_size=0.25, model="leafwise", trees=TreeParams(n_trees=6, num_leaves=6)),
                                 MT.RunConfig(test_size=0.25, model="symmetric", trees=TreeParams(grow="symmetric", n_trees=6, max_depth=3)),
                                 MT.RunConfig(test_size=0.25, model="network", net=NetParams(epochs=8, batch_rows=150, rate=0.01, valid_share=0.1))],
                         ids=["onehot", "ward", "leafwise", "symmetric", "network"])
def test_saved_scorer_scores_raw_rows(spark, mart, tmp_path, cfg):
    metrics, scored, info = MT.run(mart, cfg)
    assert metrics.first()["auc"] > 0.75 and scored.count() > 60            # the label follows two columns closely
    prep, model = info["prepared"], info["model"]
    ready = MT.Ready([prep.id_col, prep.label], prep.features, MT.feature_width(prep.train, prep.features) if cfg.resample else None,
                     cfg.model == "network")
    MT.save_scorer(f"{tmp_path}/scorer", prep, model, ready)
    raw = mart.drop("TARGET")
    before = {r[0]: r["score"] for r in MT.score_rows(raw, prep, model, ready).collect()}
    after = {r[0]: r["score"] for r in MT.score_rows(raw, *MT.load_scorer(spark.newSession(), f"{tmp_path}/scorer")).collect()}
    assert before.keys() == after.keys() and len(before) == 400
    assert all(abs(before[i] - after[i]) < 1e-12 for i in before)          # a network's last bits follow the size of a batch
    held = {r["SK_ID_CURR"]: r["score"] for r in scored.collect()}
    assert all(abs(before[i] - s) < 1e-12 for i, s in held.items())


def test_presets():
    leaf, sym = MT.preset("leafwise"), MT.preset("symmetric", test_size=0.1)
    assert leaf.trees.num_leaves == 44 and leaf.encoding == "label" and sym.trees.grow == "symmetric" and sym.test_size == 0.1
