"""Model training and scoring with Spark ML pipelines.

Boosted trees and the fully connected network are Spark ML estimators;
cross-validation uses an explicit, stratified, hash-based fold column so
folds do not move when data is repartitioned.  Random search draws
parameter points on the driver (a handful of numbers) and hands them to
``CrossValidator`` as ParamMaps.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanmart.constants import GBT_GRID, MLP_HIDDEN, SEED
from loanmart.operators.boosting import BoostedModel
from loanmart.operators.network import NetModel


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def boosted_trees(cols: Sequence[str], label: str = "label", pca_n: int | None = None, max_iter: int = 20,
                  max_depth: int = 5, step_size: float = 0.1, subsampling: float = 1.0, seed: int = SEED,
                  min_instances: int = 1, feature_subset: str = "all", min_gain: float = 0.0,
                  width: int | None = None) -> Pipeline:
    """Assembler (+ scaler + PCA when ``pca_n``) + GBTClassifier."""
    stages = [assembler(cols, "_raw")]
    feat = "_raw"
    if pca_n:
        stages += [StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
                   PCA(k=min(pca_n, width or len(cols)), inputCol="_std", outputCol="_pca")]
        feat = "_pca"
    stages.append(GBTClassifier(featuresCol=feat, labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                                stepSize=step_size, subsamplingRate=subsampling, seed=seed,
                                minInstancesPerNode=min_instances, featureSubsetStrategy=feature_subset,
                                minInfoGain=min_gain))
    return Pipeline(stages=stages)


def mlp_classifier(cols: Sequence[str], label: str = "label", hidden: Sequence[int] = MLP_HIDDEN,
                   max_iter: int = 50, seed: int = SEED, block_size: int = 128, width: int | None = None) -> Pipeline:
    """Standardised inputs -> sigmoid hidden layers -> softmax over 2 units.
    ``width``: number of inputs, if ``cols`` holds vector columns."""
    return Pipeline(stages=[
        assembler(cols, "_raw"),
        StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True),
        MultilayerPerceptronClassifier(featuresCol="_std", labelCol=label, layers=[width or len(cols), *hidden, 2],
                                       maxIter=max_iter, seed=seed, blockSize=block_size),
    ])


def score(model: PipelineModel | BoostedModel | NetModel, df: DataFrame, keep: Sequence[str], threshold: float = 0.5,
          out: str = "score") -> DataFrame:
    """Probability of the positive class and the hard class at ``threshold``.  ``model``: a fitted pipeline or
    boosted trees or a network of this library (the latter over ``x``)."""
    if isinstance(model, NetModel):
        return model.score(df, keep, "x", threshold).withColumnRenamed("score", out)
    if isinstance(model, BoostedModel):
        return model.score(df, keep, threshold).withColumnRenamed("score", out)
    scored = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return scored.select(*keep, p.alias(out), (p > threshold).cast("int").alias("pred"))


def draw_params(grid: Mapping[str, Sequence], n: int, seed: int = SEED) -> list[dict]:
    """n random points of a grid (seeded, with replacement like a random
    search over a discrete grid)."""
    rng = random.Random(seed)
    return [{k: rng.choice(list(v)) for k, v in grid.items()} for _ in range(n)]


@dataclass
class SearchResult:
    model: PipelineModel
    best_params: dict
    fold_mean: list[float]
    best_auc: float


def random_search(pipeline: Pipeline, train: DataFrame, grid: Mapping[str, Sequence], n_iter: int = 1,
                  fold_col: str = "fold", label: str = "label", seed: int = SEED,
                  parallelism: int = 2) -> SearchResult:
    """Cross-validated AUC for n random grid points; the best refit on all
    training rows.  Folds come from ``fold_col`` (see kfold_assign)."""
    est = pipeline.getStages()[-1]
    points = draw_params(grid, n_iter, seed)
    maps = [{est.getParam(k): (float(v) if isinstance(v, float) else v) for k, v in p.items()} for p in points]
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName="areaUnderROC")
    folds = train.select(fold_col).distinct().count()
    cv = CrossValidator(numFolds=folds, estimator=pipeline, estimatorParamMaps=maps, evaluator=ev, foldCol=fold_col,
                        parallelism=parallelism, seed=seed)
    cvm = cv.fit(train)
    best = max(range(len(points)), key=lambda i: cvm.avgMetrics[i])
    return SearchResult(cvm.bestModel, points[best], list(cvm.avgMetrics), float(cvm.avgMetrics[best]))


def cv_auc(pipeline: Pipeline, train: DataFrame, fold_col: str = "fold", label: str = "label") -> dict:
    """AUC per fold (fit on the other folds), with mean and max."""
    folds = sorted(r[0] for r in train.select(fold_col).distinct().collect())
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction")
    aucs = []
    for f in folds:
        model = pipeline.fit(train.filter(F.col(fold_col) != f))
        aucs.append(ev.evaluate(model.transform(train.filter(F.col(fold_col) == f))))
    return {"folds": aucs, "mean": sum(aucs) / len(aucs), "max": max(aucs)}
