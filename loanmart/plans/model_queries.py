"""Model keys (§2.11, E9, S4).

A trained model's scores have no SQL form.  Each key trains on the whole
stand-in feature mart with the pipeline's own settings and returns facts that
SQL can check: which rows are scored, that scores are probabilities, that the
hard class follows the threshold, and that reported measures agree with the
ones SQL computes from the stored scores.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loanmart import constants as C
from loanmart.operators import models as T
from loanmart.operators.boosting import TreeParams
from loanmart.operators.network import NetParams
from loanmart.operators.sample import kfold_assign
from loanmart.operators.target_stats import OrderedTargetEncoder
from loanmart.plans import blocks as B
from loanmart.plans import mart as MT
from loanmart.plans import sqlkit as S
from loanmart.plans import standins as V
from loanmart.plans.oracle_views import with_views
from loanmart.plans.queries import build_mart, register
from loanmart.session import cut_lineage, scratch_path, shuffles_dropped, store_rows
from loanmart.sources.io import read_table

KEY, LABEL = "SK_ID_CURR", "TARGET"
# The stand-in label is the sign of c_acctbal, which AMT_CREDIT and two
# ratios built from it carry directly; they are left out of training.
LEAKS = ("AMT_CREDIT", "Credit_income_ratio", "Credit_term")
TEST_SIZE = 0.2                 # the stand-in tables are small; 5 % would leave a handful of positives
TRAINED = f"CODE_GENDER <> '{V.GENDER_SENTINEL}'"          # rows that cleaning keeps in the training table
HASHED = f"{S.hash_int(KEY, C.SEED)} < {int(round(TEST_SIZE * 4294967296))}"
HELD = f"{TRAINED} AND {HASHED}"

_PREPARED: dict = {}


def _prepared(spark, sf):
    """The prepared (checkpointed) mart, built once per application and scale."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _PREPARED:
        _PREPARED.clear()
        _PREPARED[key] = MT.prepare(build_mart(spark, sf), KEY, LABEL, test_size=TEST_SIZE, seed=C.SEED, exclude=LEAKS)
    return _PREPARED[key]


def _config(**more) -> MT.RunConfig:
    return MT.RunConfig(test_size=TEST_SIZE, exclude=LEAKS, **more)


def _facts(scored, threshold: float):
    """Scored rows as facts; a score that is not a probability shows."""
    s = cut_lineage(scored)
    return s.select(KEY, F.col(LABEL).cast("int").alias(LABEL), ((F.col("score") >= 0) & (F.col("score") <= 1)).alias("is_probability"),
                    (F.col("pred") == (F.col("score") > threshold).cast("int")).alias("class_follows"))


SCORED_SQL = with_views(f"SELECT {KEY}, {LABEL}, true AS is_probability, true AS class_follows FROM application WHERE {HELD}",
                        "application")


@register("gbt_scores", SCORED_SQL)
def gbt_scores(spark, sf):
    p = _prepared(spark, sf)
    model, ready, _info = MT.fit_model(p, _config())
    return _facts(T.score(model, ready(p.test), [KEY, LABEL], threshold=C.SCORE_THRESHOLD), C.SCORE_THRESHOLD)


@register("gbt_pca_scores", SCORED_SQL)
def gbt_pca_scores(spark, sf):
    """T1 second variant: standardise -> PCA -> boosted trees."""
    p = _prepared(spark, sf)
    model, ready, _info = MT.fit_model(p, _config(pca_n=C.PCA_COMPONENTS))
    return _facts(T.score(model, ready(p.test), [KEY, LABEL], threshold=C.SCORE_THRESHOLD), C.SCORE_THRESHOLD)


@register("mlp_scores", SCORED_SQL)
def mlp_scores(spark, sf):
    p = _prepared(spark, sf)
    model, ready, _info = MT.fit_model(p, _config(model="mlp", max_iter=50))
    return _facts(T.score(model, ready(p.test), [KEY, LABEL], threshold=C.SCORE_THRESHOLD), C.SCORE_THRESHOLD)


@register("cv_auc", with_views(f"""
    SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_rows, CAST(sum({LABEL}) AS BIGINT) AS n_pos, true AS auc_in_range,
           true AS mean_and_max_agree
    FROM (SELECT {LABEL}, (row_number() OVER (PARTITION BY {LABEL} ORDER BY {S.hash_int(KEY, C.SEED)}, {KEY}) - 1) % {C.N_FOLDS} AS fold
          FROM application WHERE {TRAINED} AND NOT ({HASHED})) AS f GROUP BY fold""", "application"))
def cv_auc(spark, sf):
    """Cross-validated AUC on stratified folds."""
    p = _prepared(spark, sf)
    folded = cut_lineage(kfold_assign(p.train, KEY, LABEL, k=C.N_FOLDS, seed=C.SEED))
    width = MT.feature_width(p.train, p.features)
    res = T.cv_auc(MT.build_pipeline(_config(), p.features, width), folded, label=LABEL)
    ok = abs(res["mean"] - sum(res["folds"]) / len(res["folds"])) < 1e-12 and res["max"] == max(res["folds"])
    aucs = spark.createDataFrame([(i, 0.0 <= float(a) <= 1.0, ok) for i, a in enumerate(res["folds"])],
                                 "fold int, auc_in_range boolean, mean_and_max_agree boolean")
    sizes = folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(LABEL).cast("long")).alias("n_pos"))
    return sizes.join(aucs, "fold").select("fold", "n_rows", "n_pos", "auc_in_range", "mean_and_max_agree")


SEARCH_DRAWS = 4


@register("random_search", f"SELECT {SEARCH_DRAWS} AS n_draws, true AS drawn_from_grid, true AS auc_in_range, true AS best_is_largest")
def random_search(spark, sf):
    """Random search over the full grid with stratified folds."""
    p = _prepared(spark, sf)
    folded = store_rows(kfold_assign(p.train, KEY, LABEL, k=C.N_FOLDS, seed=C.SEED), "folded")
    width = MT.feature_width(p.train, p.features)
    pipe = MT.build_pipeline(_config(), p.features, width)
    res = T.random_search(pipe, folded, T.GBT_GRID, n_iter=SEARCH_DRAWS, label=LABEL, parallelism=4)
    row = (len(res.fold_mean), all(v in T.GBT_GRID[k] for k, v in res.best_params.items()),
           all(0.0 <= a <= 1.0 for a in res.fold_mean), bool(res.best_auc == max(res.fold_mean)))
    return spark.createDataFrame([row], "n_draws int, drawn_from_grid boolean, auc_in_range boolean, best_is_largest boolean")


SEQ_COLS = ["DAYS_CREDIT", "AMT_CREDIT_SUM_DEBT", "CREDIT_DAY_OVERDUE", "DAYS_ENDDATE_FACT", "CREDIT_ACTIVE", "CREDIT_TYPE"]
SEQ_K = 50                      # five rows of four numbers and eight categories make 60 inputs


def _embedding(spark, sf, k=SEQ_K):
    return MT.sequence_embedding(V.application(spark, sf), KEY, V.bureau(spark, sf), KEY, ["DAYS_CREDIT", "SK_ID_BUREAU"],
                                 SEQ_COLS, n=C.SEQ_ROWS, k=k, test_size=TEST_SIZE)


@register("sequence_embedding", with_views(
    f"SELECT {KEY}, CAST({SEQ_K} AS INTEGER) AS n_features, true AS all_numbers, true AS train_mean_is_zero FROM application", "application"))
def sequence_embedding(spark, sf):
    """One row of features per application; on the rows they were fitted
    on, the components have a mean of zero."""
    e = cut_lineage(_embedding(spark, sf))
    cols = [c for c in e.columns if c.startswith(C.SEQ_PREFIX)]
    from loanmart.operators.sample import split_flag
    means = split_flag(e, KEY, TEST_SIZE, C.SEED, "_t").filter("_t = 0").agg(*[F.avg(c) for c in cols]).first()
    zero = all(abs(m) < 1e-8 for m in means)
    finite = F.lit(True)
    for c in cols:
        finite = finite & F.col(c).isNotNull() & ~F.isnan(c)
    return e.select(KEY, F.lit(len(cols)).alias("n_features"), finite.alias("all_numbers"), F.lit(zero).alias("train_mean_is_zero"))


COUNTED = f"(SELECT count(*) FROM application WHERE {HELD}) AS n_rows, (SELECT count(*) FROM application WHERE {HELD} AND {LABEL} = 1) AS n_pos"


def _curve_area(scores) -> float:
    """Area under the ROC curve by Spark ML (trapezoids over sorted distinct scores), the other way to the same number."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    raw = scores.select(F.col("y").cast("double").alias("label"), "score")
    return BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(raw)


def _measures(metrics, scored, threshold: float):
    """Hold-out size and whether the reported measures equal those computed anew from the stored scores."""
    s = scored.select(F.col(LABEL).cast("int").alias("y"), "score")
    hit, pos = F.col("score") > threshold, F.col("y") == 1
    again = s.agg(F.count_if(hit & pos).alias("tp2"), F.count_if(hit & ~pos).alias("fp2"), F.count_if(~hit & pos).alias("fn2"),
                  F.count_if(~hit & ~pos).alias("tn2"), F.count(F.lit(1)).alias("n_rows"), F.count_if(pos).alias("n_pos")).first().asDict()
    again["auc2"] = _curve_area(s) if 0 < again["n_pos"] < again["n_rows"] else float("nan")
    m = metrics.first()

    def near(a, b):
        return a is None and b is None or a is not None and b is not None and abs(a - b) < 1e-9
    prec = m["tp"] / (m["tp"] + m["fp"]) if m["tp"] + m["fp"] else None
    rec = m["tp"] / (m["tp"] + m["fn"]) if m["tp"] + m["fn"] else None
    f1 = 2 * prec * rec / (prec + rec) if prec and rec else None
    same = all(m[c] == again[f"{c}2"] for c in ("tp", "fp", "fn", "tn"))
    shares = near(m["precision"], prec) and near(m["recall"], rec) and (f1 is None or near(m["f1"], f1))
    return int(again["n_rows"]), int(again["n_pos"]), near(m["auc"], float(again["auc2"])), same, shares


MEASURES = "n_rows bigint, n_pos bigint, auc_agrees boolean, counts_agree boolean, shares_agree boolean"
MEASURES_SQL = with_views(f"SELECT {COUNTED}, true AS auc_agrees, true AS counts_agree, true AS shares_agree", "application")


@register("train_evaluate", MEASURES_SQL)
def train_evaluate(spark, sf):
    """The default run (boosted trees, threshold 0.1)."""
    metrics, scored, _info = MT.run(build_mart(spark, sf), _config())
    return spark.createDataFrame([_measures(metrics, scored, C.SCORE_THRESHOLD)], MEASURES)


@register("train_evaluate_resampled", MEASURES_SQL)
def train_evaluate_resampled(spark, sf):
    """E9 with cluster under-sampling + SMOTE and threshold 0.5."""
    cfg = _config(resample="cluster_smote", threshold=C.RESAMPLED_THRESHOLD)
    metrics, scored, _info = MT.run(build_mart(spark, sf), cfg)
    return spark.createDataFrame([_measures(metrics, scored, cfg.threshold)], MEASURES)


@register("compare_feature_sets", with_views(
    f"SELECT f.feature_set, f.more AS more_features, {COUNTED}, true AS auc_agrees, true AS counts_agree, true AS shares_agree "
    "FROM (VALUES ('base', false), ('with_sequence', true)) AS f(feature_set, more)", "application"))
def compare_feature_sets(spark, sf):
    """The same split and learner with and without the sequence features,
    which are fitted on that split's training part."""
    base = build_mart(spark, sf)
    with_seq = base.join(_embedding(spark, sf), on=KEY, how="left")
    rows, first = [], None
    for name, frame in (("base", base), ("with_sequence", with_seq)):
        metrics, scored, info = MT.run(frame, _config())
        first = info["features"] if first is None else first
        rows.append((name, info["features"] > first, *_measures(metrics, scored, C.SCORE_THRESHOLD)))
    return spark.createDataFrame(rows, f"feature_set string, more_features boolean, {MEASURES}")


@register("score_submission", with_views(f"SELECT {KEY}, true AS is_probability FROM application", "application"))
def score_submission(spark, sf):
    """Fit on the labelled mart, then score the unlabelled application
    table: the fitted preparation is applied to every row of it, and (id,
    probability) is saved as CSV in the checkpoint folder and read back."""
    p = _prepared(spark, sf)
    model, ready, _info = MT.fit_model(p, _config())
    unlabelled = build_mart(spark, sf, B.application_features(V.application(spark, sf).drop(LABEL), clean=False))
    path = scratch_path(spark, "scores")
    scored = MT.score_rows(unlabelled.drop(*LEAKS), p, model, ready)
    with shuffles_dropped(spark):
        scored.select(KEY, F.col("score").alias(LABEL)).write.mode("overwrite").option("header", True).csv(path)
    back = read_table(spark, path, schema=f"{KEY} bigint, {LABEL} double", fmt="csv")
    return back.select(KEY, ((F.col(LABEL) >= 0) & (F.col(LABEL) <= 1)).alias("is_probability"))


# ------------------------------------------------- boosted trees of this library

LEAFWISE = TreeParams(n_trees=5, num_leaves=16, max_depth=6, min_child_rows=10)


def _boosted(spark, sf, name: str, trees: TreeParams):
    cfg = _config(model=name, trees=trees)
    return MT.run(build_mart(spark, sf), cfg)


@register("leafwise_splits")
def leafwise_splits(spark, sf):
    """T1, leaf-wise learner: every split with its gain and rows.  (The source's minimum child weight of 44.8 leaves no
    split on the small stand-in tables, see ``mart.preset`` for its parameters.)"""
    _m, _s, info = _boosted(spark, sf, "leafwise", LEAFWISE)
    return spark.createDataFrame(info["model"].splits(), "tree int, node int, feature string, threshold double, gain double, n_rows bigint")


@register("leafwise_scores")
def leafwise_scores(spark, sf):
    """T1, leaf-wise learner: hold-out scores and classes."""
    _m, scored, _i = _boosted(spark, sf, "leafwise", LEAFWISE)
    return scored.select(KEY, F.col(LABEL).cast("int").alias(LABEL), "score", "pred")


@register("symmetric_scores")
def symmetric_scores(spark, sf):
    """T1, symmetric trees on ordered target statistics: hold-out scores and classes."""
    _m, scored, _i = _boosted(spark, sf, "symmetric", TreeParams(grow="symmetric", n_trees=5, max_depth=5, reg_lambda=5.0))
    return scored.select(KEY, F.col(LABEL).cast("int").alias(LABEL), "score", "pred")


NET = NetParams(epochs=3, batch_rows=400, valid_share=0.1)


@register("network_epochs")
def network_epochs(spark, sf):
    """T4: losses of each epoch of the connected network with dropout and batch statistics."""
    p = _prepared(spark, sf)
    _model, _ready, info = MT.fit_model(p, _config(model="network", net=NET))
    return spark.createDataFrame(info["history"], "epoch int, train_loss double, held_out_loss double")


@register("network_scores")
def network_scores(spark, sf):
    """T4: hold-out scores and classes of the connected network."""
    p = _prepared(spark, sf)
    model, ready, _info = MT.fit_model(p, _config(model="network", net=NET))
    scored = T.score(model, ready(p.test), [KEY, LABEL], threshold=C.SCORE_THRESHOLD)
    return scored.select(KEY, F.col(LABEL).cast("int").alias(LABEL), "score", "pred")


@register("learned_sequence_features")
def learned_sequence_features(spark, sf):
    """The hidden layer of the convolutional network over the five newest bureau rows of every application."""
    out, _net = MT.learned_sequence_features(V.application(spark, sf), KEY, LABEL, V.bureau(spark, sf), KEY, ["DAYS_CREDIT", "SK_ID_BUREAU"],
                                             SEQ_COLS, "conv", k=SEQ_K, test_size=TEST_SIZE, params=NetParams(epochs=2, batch_rows=600))
    return out


ENCODE_SEED = 21


@register("ordered_target_encode", S.rounded(f"""
    WITH r AS (SELECT d.doc_id, d.source, d.lang, l.toxic AS y, {S.hash_int('d.doc_id', ENCODE_SEED)} AS h
               FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
    p AS (SELECT avg(y) AS prior FROM r)
    SELECT doc_id,
           (coalesce(sum(y) OVER (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + prior)
           / (count(y) OVER (PARTITION BY source ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1) AS source,
           (coalesce(sum(y) OVER (PARTITION BY lang ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + prior)
           / (count(y) OVER (PARTITION BY lang ORDER BY h, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1) AS lang
    FROM r, p""", ["source", "lang"]))
def ordered_target_encode(spark, sf):
    """T1, category handling: running mean label of the earlier rows of the same source and language."""
    from loanmart.plans.queries import finish
    docs = V.table(spark, sf, "documents").select("doc_id", "source", "lang")
    rows = docs.join(V.table(spark, sf, "labels").select("doc_id", F.col("toxic").alias("y")), "doc_id")
    _enc, train = OrderedTargetEncoder.fit_transform(rows, "doc_id", "y", ["source", "lang"], seed=ENCODE_SEED, rows_per_range=100_000)
    return finish(train.select("doc_id", "source", "lang"))


@register("model_roundtrip", with_views(f"SELECT {KEY}, true AS same_score FROM application", "application"))
def model_roundtrip(spark, sf):
    """The raw mart scored with the fitted preparation and model, and with both after saving and loading."""
    p = _prepared(spark, sf)
    model, ready, _info = MT.fit_model(p, _config(max_iter=5))
    path = scratch_path(spark, "scorer")
    MT.save_scorer(path, p, model, ready)
    again = MT.load_scorer(spark, path)
    rows = build_mart(spark, sf, B.application_features(V.application(spark, sf).drop(LABEL), clean=False)).drop(*LEAKS)
    rows = store_rows(rows, "rows")
    before = MT.score_rows(rows, p, model, ready).select(KEY, F.col("score").alias("b"))
    after = MT.score_rows(rows, *again).select(KEY, F.col("score").alias("a"))
    return before.join(after, KEY).select(KEY, (F.col("a") == F.col("b")).alias("same_score"))
