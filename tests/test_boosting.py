"""Ordered target statistics and histogram boosting against plain versions."""

import hashlib

import numpy as np
import pytest

from loanmart.operators.boosting import BoostedModel, TreeParams, fit_boosted


def order_of(i, seed):
    return int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:8], 16)


def test_ordered_means(spark):
    """NULL categories, one hot category over many ranges, NULL labels, new rows."""
    from pyspark.sql import functions as F
    from loanmart.operators.target_stats import OrderedTargetEncoder, ordered_means
    rng = np.random.default_rng(0)
    rows = [(i, ["hot", "hot", "a", "b", None][int(rng.integers(0, 5))], None if i % 17 == 0 else int(rng.random() < 0.3)) for i in range(500)]
    df = spark.createDataFrame(rows, "id bigint, c string, y int").repartition(5)
    known = [y for _, _, y in rows if y is not None]
    prior = sum(known) / len(known)
    want, seen = {}, {}
    for i, c, y in sorted(rows, key=lambda r: (order_of(r[0], 9), r[0])):
        s, n = seen.get(c, (0, 0))
        want[i] = (s + 2.0 * prior) / (n + 2.0)
        seen[c] = (s + (y or 0), n + (y is not None))
    for ranges in (1, 7, 64):
        got = {r["id"]: r["e"] for r in ordered_means(df, "id", "y", "c", "e", prior, 2.0, 9, ranges).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-12 for i in want)
    enc, train = OrderedTargetEncoder.fit_transform(df, "id", "y", ["c"], 2.0, 9, rows_per_range=50)
    assert train.columns == df.columns and all(abs(r["c"] - want[r["id"]]) < 1e-12 for r in train.collect())
    new = spark.createDataFrame([(1, "hot"), (2, None), (3, "unseen")], "id bigint, c string")
    got = {r["id"]: r["c"] for r in enc.transform(new).collect()}
    for i, c in ((1, "hot"), (2, None)):
        assert abs(got[i] - (seen[c][0] + 2 * prior) / (seen[c][1] + 2)) < 1e-12
    assert abs(got[3] - prior) < 1e-12
    assert OrderedTargetEncoder.fit_transform(df.filter(F.lit(False)), "id", "y", ["c"])[1].count() == 0


def table(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    x[:, 3] = rng.integers(0, 4, n)
    x[:, 4] = 1.0
    logit = 1.5 * x[:, 0] - 2 * (x[:, 1] > 0.4) + (x[:, 3] == 2) * 1.5 - 1
    y = (rng.random(n) < 1 / (1 + np.exp(-logit))).astype(int)
    x[rng.random((n, 5)) < 0.05] = np.nan
    x[:, 4] = 1.0
    return x, y


COLS = [f"f{j}" for j in range(5)]


def frame(spark, x, y, parts):
    rows = [(i, int(t), *[None if np.isnan(v) else float(v) for v in r]) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id bigint, y int, " + ", ".join(f"{c} double" for c in COLS)).repartition(parts)


def plain_tree(x, y, margin, edges, p):
    """Leaf-wise or symmetric growth with plain loops over rows' values: [(feature, threshold, rows)] and new margins."""
    q = 1 / (1 + np.exp(-margin))
    g, h = np.rint((q - y) * 2 ** 24) / 2 ** 24, np.rint(q * (1 - q) * 2 ** 24) / 2 ** 24
    worth = lambda m: np.sign(s := g[m].sum()) and max(abs(s) - p.reg_alpha, 0) ** 2 / (h[m].sum() + p.reg_lambda)
    goes = lambda f, e: np.isnan(x[:, f]) | (x[:, f] <= e)

    def cuts():
        for f in range(x.shape[1]):
            yield f, -np.inf
            for e in edges[f]:
                yield f, e

    def best(m):
        out = (0.0, None)
        for f, e in cuts():
            a, b = m & goes(f, e), m & ~goes(f, e)
            if min(a.sum(), b.sum()) < p.min_child_rows or min(h[a].sum(), h[b].sum()) < p.min_child_weight:
                continue
            gain = worth(a) + worth(b) - worth(m) - p.min_split_gain
            if gain > out[0] + 1e-9:
                out = (gain, (f, e, a, b))
        return out

    used = []
    if p.grow == "leaf":
        leaves = [(np.ones(len(y), bool), 0)]
        known = [best(leaves[0][0])]
        while len(leaves) < p.num_leaves:
            can = [i for i, k in enumerate(known) if k[1] and leaves[i][1] < p.max_depth]
            if not can:
                break
            i = max(can, key=lambda i: known[i][0])
            f, e, a, b = known[i][1]
            used.append((f, e, int(leaves[i][0].sum())))
            d = leaves[i][1] + 1
            leaves[i:i + 1], known[i:i + 1] = [(a, d), (b, d)], [best(a), best(b)]
        parts = [m for m, _ in leaves]
    else:
        parts = [np.ones(len(y), bool)]
        for _ in range(p.max_depth):
            scored = []
            for f, e in cuts():
                kids = [k for m in parts for k in (m & goes(f, e), m & ~goes(f, e))]
                scored.append((sum(worth(k) for k in kids) - sum(worth(m) for m in parts), f, e, kids))
            top = max(s[0] for s in scored)
            gain, f, e, kids = next(s for s in scored if s[0] > top - 1e-9)
            if gain <= p.min_split_gain:
                break
            used += [(f, e, int(m.sum())) for m in parts]
            parts = kids
    new = margin.copy()
    for m in parts:
        s = g[m].sum()
        new[m] -= p.learning_rate * np.sign(s) * max(abs(s) - p.reg_alpha, 0) / (h[m].sum() + p.reg_lambda)
    return used, new


@pytest.mark.parametrize("p", [
    TreeParams(n_trees=3, num_leaves=9, max_depth=6, bins=8, min_child_rows=15, learning_rate=0.3),
    TreeParams(n_trees=2, num_leaves=12, max_depth=3, bins=8, reg_alpha=1.5, reg_lambda=2.0, min_split_gain=0.4, min_child_weight=4.0),
    TreeParams(grow="symmetric", n_trees=2, max_depth=3, bins=8, learning_rate=0.3)])
def test_trees_are_those_of_the_plain_version(spark, p):
    x, y = table(900)
    df = frame(spark, x, y, 3)
    model = fit_boosted(df, "id", "y", COLS, p)
    margin, want = np.full(len(y), model.base), []
    for t in range(p.n_trees):
        used, margin = plain_tree(x, y, margin, model.edges, p)
        want += [(t, COLS[f], None if e == -np.inf else e, n) for f, e, n in used]
    got = [(t, c, e, n) for t, _, c, e, _, n in model.splits()]
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) >= 6
    scores = {r["id"]: r["score"] for r in model.score(df, ["id"]).collect()}
    assert all(abs(scores[i] - 1 / (1 + np.exp(-m))) < 1e-9 for i, m in enumerate(margin))


def test_partitions_do_not_matter_and_scores_are_good(spark, tmp_path):
    from loanmart.operators.metrics import auc
    x, y = table(2400, 3)
    p = TreeParams(n_trees=9, num_leaves=8, bins=16, col_share=0.8, row_share=0.7, learning_rate=0.2)
    edges = [sorted(set(np.nanquantile(x[:, j], np.arange(1, 16) / 16, method="lower").tolist())) for j in range(5)]
    fits = [fit_boosted(frame(spark, x[:1600], y[:1600], parts), "id", "y", COLS, p, edges) for parts in (1, 6)]
    assert fits[0].trees == fits[1].trees
    test = frame(spark, x[1600:], y[1600:], 2)
    got = fits[0].score(test, ["id", "y"])
    ours = auc(got.select(got["y"].alias("label"), "score")).first()["auc"]
    assert ours > 0.7
    fits[0].save(spark, f"{tmp_path}/model")
    again = BoostedModel.load(spark, f"{tmp_path}/model")
    assert again == fits[0] and sorted(again.score(test, ["id"]).collect()) == sorted(fits[0].score(test, ["id"]).collect())
    none = fit_boosted(frame(spark, x, y, 1).limit(0), "id", "y", COLS, p)
    assert none.trees == [] and {r["score"] for r in none.score(test, ["id"]).collect()} == {0.5}
