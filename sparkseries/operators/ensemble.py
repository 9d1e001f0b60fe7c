"""One model over all rows: gradient-boosted trees from MLlib, with cross-validated tuning."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.operators.splits import fold_segments, labelled
from sparkseries.session import kept

# The tuning grid of the single tree-ensemble model.
MAX_DEPTH = (5, 10)
N_TREES = (30, 100)


def boosted_trees(label: str, max_depth: int = 5, n_trees: int = 30, seed: int = 7) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, maxDepth=max_depth, maxIter=n_trees, seed=seed)


def tree_pipeline(features: Sequence[str], label: str, estimator=None) -> Pipeline:
    """Assembler followed by an estimator (boosted trees unless another one is given)."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, estimator or boosted_trees(label)])


def fit_kept(pipeline: Pipeline, df: DataFrame) -> PipelineModel:
    """Fit on kept rows: tree fits read their input many times."""
    with kept(df) as rows:
        return pipeline.fit(rows)


def fit_trees(df: DataFrame, features: Sequence[str], label: str, **params) -> PipelineModel:
    """Fit one boosted-tree model on all series; runs jobs."""
    return fit_kept(tree_pipeline(features, label, boosted_trees(label, **params)), df.select(*features, label))


def time_fold_column(df: DataFrame, keys: Sequence[str], ts: str, k: int, out: str = "fold", block=None) -> DataFrame:
    """Label rows with `k` contiguous time blocks per series, for `CrossValidator.foldCol`."""
    return labelled(df, keys, ts, lambda at, total: F.floor((at - 1) * k / total).cast("int"), out, block)


def cross_validated_trees(
    features: Sequence[str],
    label: str,
    max_depth: Sequence[int] = MAX_DEPTH,
    n_trees: Sequence[int] = N_TREES,
    k: int = 3,
    fold_col: str = "fold",
    parallelism: int = 4,
    seed: int = 7,
) -> Pipeline:
    """Pipeline of assembler and grid search by RMSE; fit it on rows that carry `fold_col`.

    Each split trains on all other blocks, also later ones. For past-only folds use
    `past_only_scores`.
    """
    trees = boosted_trees(label, seed=seed)
    points = ParamGridBuilder().addGrid(trees.maxDepth, list(max_depth)).addGrid(trees.maxIter, list(n_trees)).build()
    tuner = CrossValidator(
        estimator=trees,
        estimatorParamMaps=points,
        evaluator=RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse"),
        numFolds=k,
        foldCol=fold_col,
        parallelism=parallelism,
        seed=seed,
    )
    return tree_pipeline(features, label, tuner)


def grid_table(model: PipelineModel) -> list[dict]:
    """Mean score of each grid point of a fitted `cross_validated_trees` pipeline."""
    tuned = model.stages[-1]
    return [
        {**{p.name: v for p, v in point.items()}, "rmse": float(score)}
        for point, score in zip(tuned.getEstimatorParamMaps(), tuned.avgMetrics)
    ]


def past_only_scores(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    features: Sequence[str],
    label: str,
    max_depth: Sequence[int] = MAX_DEPTH,
    n_trees: Sequence[int] = N_TREES,
    k: int = 10,
    seed: int = 7,
) -> DataFrame:
    """(max_depth, n_trees, fold, rmse) on expanding windows; runs one fit per fold and point."""
    segments = fold_segments(df, keys, ts, k).where("segment IS NOT NULL").select(*features, label, "segment")
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    found = []
    with kept(segments) as rows:
        for fold, depth, trees in itertools.product(range(k), max_depth, n_trees):
            estimator = boosted_trees(label, max_depth=depth, n_trees=trees, seed=seed)
            model = tree_pipeline(features, label, estimator).fit(rows.where(F.col("segment") <= fold))
            rmse = evaluator.evaluate(model.transform(rows.where(F.col("segment") == fold + 1)))
            found.append((depth, trees, fold, float(rmse)))
    return df.sparkSession.createDataFrame(found, "max_depth int, n_trees int, fold int, rmse double")


def feature_importances(model: PipelineModel, features: Sequence[str]) -> list[dict]:
    """Split-gain importance per feature of a fitted pipeline."""
    stage = model.stages[-1]
    trees = getattr(stage, "bestModel", stage)
    return [{"feature": f, "importance": float(v)} for f, v in zip(features, trees.featureImportances.toArray())]
