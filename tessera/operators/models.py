"""Model training, tuning, calibration and scoring (M1-M18, S12) on MLlib.

The reference's external boosters (XGBoost/LightGBM/CatBoost) and torch
models are replaced by the MLlib estimator with the same role; metrics are
defined identically (positive-class F1, ROC-AUC) so results are comparable
in kind, not bit for bit.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Mapping, Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Binarizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .calibrate import apply_isotonic, fit_isotonic
from .evaluate import coarse_threshold_search, curve_areas, f1_at_threshold, threshold_search
from .extra_trees import ExtraTrees

KINDS = ("gbt", "random_forest", "extra_trees", "bagging", "decision_tree", "logistic", "linear_svc",
         "gaussian_nb", "bernoulli_nb", "mlp", "dummy")


def estimator(kind: str, features: str = "features", label: str = "label", weight: str | None = None,
              seed: int = 42, n_features: int | None = None, **params):
    """M1-M7: an MLlib estimator for a reference model family."""
    w = {"weightCol": weight} if weight else {}
    common = dict(featuresCol=features, labelCol=label)
    if kind == "gbt":                       # M1 boosted trees
        return GBTClassifier(**common, **w, seed=seed, maxIter=params.pop("maxIter", 50),
                             maxDepth=params.pop("maxDepth", 5), **params)
    if kind == "random_forest":             # M2
        return RandomForestClassifier(**common, **w, seed=seed, numTrees=params.pop("numTrees", 100), **params)
    if kind == "extra_trees":               # M2: random cuts, no bootstrap
        return ExtraTrees(**common, weightCol=weight, seed=seed, **params)
    if kind == "bagging":                   # M2: bootstrap samples, all features
        return RandomForestClassifier(**common, **w, seed=seed, featureSubsetStrategy="all",
                                      numTrees=params.pop("numTrees", 10), **params)
    if kind == "decision_tree":             # M3
        return DecisionTreeClassifier(**common, **w, seed=seed, **params)
    if kind == "logistic":                  # M4 (weighted BCE)
        return LogisticRegression(**common, **w, maxIter=params.pop("maxIter", 100), **params)
    if kind == "linear_svc":                # M5 (no probability column: scores fall back, M18)
        return LinearSVC(**common, **w, **params)
    if kind == "gaussian_nb":               # M6
        return NaiveBayes(**common, **w, modelType="gaussian", **params)
    if kind == "bernoulli_nb":              # M6 on binarised features
        return Pipeline(stages=[Binarizer(inputCol=features, outputCol="__bin", threshold=0.0),
                                NaiveBayes(featuresCol="__bin", labelCol=label, **w, modelType="bernoulli",
                                           **params)])
    if kind == "mlp":                       # M7 (MLlib MLP has no weightCol)
        hidden = params.pop("hidden", [32, 16])
        if n_features is None:
            raise ValueError("mlp needs n_features")
        return MultilayerPerceptronClassifier(**common, seed=seed, layers=[n_features, *hidden, 2],
                                              maxIter=params.pop("maxIter", 100), **params)
    if kind == "dummy":                     # M8
        return None
    raise ValueError(f"unknown model kind {kind!r}")


def without_summary(model):
    """The model without its training summaries.

    A binary summary holds the session, which cannot be written once it has an observation: scoring with the
    model would then fail. Scores do not need it.
    """
    for stage in model.stages if isinstance(model, PipelineModel) else [model]:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.getActiveSession().sparkContext._jvm.scala.Option.empty())
    return model


def fit(est, train: DataFrame, params: Mapping | None = None):
    """Fit for scoring (see :func:`without_summary`)."""
    return without_summary(est.fit(train, params) if params else est.fit(train))


def positive_probability(pred: DataFrame, out: str = "p") -> DataFrame:
    """P(class 1) from ``probability``; models without one give the hard prediction."""
    if "probability" in pred.columns:
        return pred.withColumn(out, F.coalesce(F.get(vector_to_array("probability"), 1),
                                               F.col("prediction").cast("double")))
    return pred.withColumn(out, F.col("prediction").cast("double"))


def majority_class(train: DataFrame, label: str = "label") -> int:
    top = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), label).first()
    return int(top[label])


def fit_and_score(kind: str, train: DataFrame, score: DataFrame, features: str = "features", label: str = "label",
                  weight: str | None = None, n_features: int | None = None, **params) -> DataFrame:
    """Fit on ``train`` and add ``p`` (and ``prediction``) to ``score``."""
    if kind == "dummy":
        maj = majority_class(train, label)
        return score.withColumn("prediction", F.lit(float(maj))).withColumn("p", F.lit(float(maj)))
    model = fit(estimator(kind, features, label, weight, n_features=n_features, **params), train)
    return positive_probability(model.transform(score))


#: What a model that cannot be had or fitted raises; anything else (a crash of Spark) is not a model's failure
FIT_ERRORS = (ValueError, TypeError, IllegalArgumentException)


def compare_models(kinds: Sequence[str], train: DataFrame, val: DataFrame, features: str = "features",
                   label: str = "label", weight: str | None = None, n_features: int | None = None) -> DataFrame:
    """F1 (at 0.5), ROC-AUC and fit+score seconds per model.

    A model whose estimator refuses its parameters or data keeps its row, with ``error``; other errors are raised.
    """
    spark = train.sparkSession
    rows = []
    for k in kinds:
        t0 = time.time()
        try:
            scored = fit_and_score(k, train, val, features, label, weight, n_features).select(label, "p")
            f1 = f1_at_threshold(scored, 0.5, [], label).first()["f1"]
            auc = curve_areas(scored, [], label).first()["roc_auc"]
        except FIT_ERRORS as e:
            rows.append((k, None, None, time.time() - t0, f"{type(e).__name__}: {e}"))
            continue
        rows.append((k, float(f1), None if auc is None else float(auc), time.time() - t0, None))
    return spark.createDataFrame(rows, "model string, f1 double, roc_auc double, seconds double, error string")


def best_model(comparison: DataFrame) -> DataFrame:
    """L4: the row with the best F1 (first in model order on ties)."""
    return comparison.orderBy(F.col("f1").desc_nulls_last(), "model").limit(1)


# ---------------------------------------------------------------- M11/M12 tuning
# MLlib counterparts of the reference's search spaces (trees: count, depth, learning rate,
# row and feature subsampling, leaf size; forests: bootstrap and feature subsets; linear: penalty).
DEFAULT_GRIDS = {
    "gbt": {"maxIter": [100, 200, 300], "maxDepth": [3, 5, 7], "stepSize": [0.01, 0.05, 0.1, 0.2],
            "subsamplingRate": [0.8, 0.9, 1.0], "featureSubsetStrategy": ["0.8", "0.9", "all"],
            "minInstancesPerNode": [5, 10, 20]},
    "random_forest": {"numTrees": [100, 200, 300], "maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4],
                      "featureSubsetStrategy": ["sqrt", "log2", "0.8"], "bootstrap": [True, False]},
    "logistic": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "linear_svc": {"regParam": [0.0, 0.01, 0.1]},
    "mlp": {"stepSize": [0.001, 0.01], "maxIter": [300, 500]},
    "decision_tree": {"maxDepth": [5, 10, 15], "minInstancesPerNode": [1, 2, 4]},
}

def param_grid(est, grid: Mapping[str, Sequence], n_random: int | None = None, seed: int = 42):
    """M12 grid; with ``n_random`` a seeded random subset (random search)."""
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    maps = b.build()
    if n_random is not None and n_random < len(maps):
        maps = random.Random(seed).sample(maps, n_random)
    return maps


def cross_validate(est, grid, data: DataFrame, fold_col: str = "fold", label: str = "label",
                   metric: str = "f1", n_folds: int = 5) -> tuple[PipelineModel, list[float]]:
    """K-fold CV over a user fold column (W5), scored by positive-class F1 (or ROC-AUC).

    Returns the best parameters' model fitted on all rows (first on ties), and each parameter set's mean over folds.
    """
    if metric == "f1":
        ev = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    else:
        ev = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    sums = [0.0] * len(grid)
    for k in range(n_folds):
        train, held = data.where(F.col(fold_col) != k), data.where(F.col(fold_col) == k)
        for i, params in enumerate(grid):
            sums[i] += float(ev.evaluate(fit(est, train, params).transform(held)))
    means = [x / n_folds for x in sums]
    return fit(est, data, grid[means.index(max(means))]), means


def random_search(kind: str, data: DataFrame, n_random: int, fold_col: str = "fold", label: str = "label", features: str = "features",
                  n_folds: int = 5, seed: int = 42, grid: Mapping[str, Sequence] | None = None, weight: str | None = None) -> DataFrame:
    """M11 + M12: a seeded random subset of the model's search space (``DEFAULT_GRIDS`` or ``grid``), cross-validated.

    Returns params (JSON), mean_f1 and best, a row a parameter set.
    """
    est = estimator(kind, features, label, weight, seed=seed)
    maps = param_grid(est, grid or DEFAULT_GRIDS[kind], n_random, seed)
    _, means = cross_validate(est, maps, data, fold_col, label, n_folds=n_folds)
    named = [json.dumps({p.name: v for p, v in m.items()}, sort_keys=True) for m in maps]
    best = means.index(max(means))
    return data.sparkSession.createDataFrame([(n, m, i == best) for i, (n, m) in enumerate(zip(named, means))], "params string, mean_f1 double, best boolean")


def fold_loop(kind: str, data: DataFrame, fold_col: str = "fold", n_folds: int = 5, features: str = "features",
              label: str = "label", id_col: str = "id", n_features: int | None = None, **params) -> DataFrame:
    """Train on all folds but one, score the held-out fold; per fold the F1 at the best
    coarse threshold, that threshold, and ROC-AUC (summarised with ``evaluate.cv_summary``, A23)."""
    spark = data.sparkSession
    rows = []
    for k in range(n_folds):
        train = data.where(F.col(fold_col) != k)
        held = data.where(F.col(fold_col) == k)
        scored = fit_and_score(kind, train, held, features, label, n_features=n_features, **dict(params))
        s = scored.select(label, "p")
        best = coarse_threshold_search(s, []).first()
        auc = curve_areas(s, [], label).first()["roc_auc"]
        rows.append((k, float(best["best_f1"]), float(best["best_threshold"]), None if auc is None else float(auc)))
    return spark.createDataFrame(rows, "fold int, f1 double, threshold double, roc_auc double")


# ---------------------------------------------------------------- M1 / M13 early stopping
def boosted_with_early_stop(train: DataFrame, held: DataFrame, features: str = "features", label: str = "label", weight: str | None = None,
                            tol: float = 0.01, seed: int = 42, **params):
    """M1: boosted trees that stop when the held-out loss no longer falls by ``tol``; returns (model, history).

    history: trees, train_loss, held_loss (log loss of the margins) after each tree that is kept, and kept (all true).
    Held-out rows only decide when to stop.
    """
    flag = "is_held"
    while flag in train.columns:
        flag += "_"
    est = GBTClassifier(featuresCol=features, labelCol=label, seed=seed, validationIndicatorCol=flag, validationTol=tol, **({"weightCol": weight} if weight else {}), **params)
    model = fit(est, train.withColumn(flag, F.lit(False)).unionByName(held.withColumn(flag, F.lit(True))))
    losses = zip(model.evaluateEachIteration(train), model.evaluateEachIteration(held))
    return model, train.sparkSession.createDataFrame([(k, float(a), float(b)) for k, (a, b) in enumerate(losses, 1)], "trees int, train_loss double, held_loss double")


def train_in_passes(train: DataFrame, held: DataFrame, path: str, n_features: int, hidden: Sequence[int] = (32, 16), passes: int = 20, patience: int = 5,
                    steps: int = 5, features: str = "features", label: str = "label", seed: int = 42) -> tuple[object, DataFrame]:
    """A network trained pass by pass (``steps`` solver steps each, starting from the weights of the pass before).

    After each pass the model is written under ``path`` and the held-out rows are scored (``path``/scores, by pass);
    F1 is taken at the best coarse threshold. Training stops after ``patience`` passes without a better F1; the best
    pass's model is returned with the history: pass, f1, threshold, roc_auc, best. A rerun goes on from what is written.
    """
    spark, best, history, weights = train.sparkSession, (-1.0, 0), [], None
    for k in range(1, passes + 1):
        est = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, seed=seed, layers=[n_features, *hidden, 2], maxIter=steps, tol=0.0)
        if weights is not None:
            est = est.setInitialWeights(weights)
        model = fit(est, train)
        weights = model.weights
        model.write().overwrite().save(f"{path}/pass-{k:03d}")
        positive_probability(model.transform(held)).select(F.col(label).cast("int").alias("label"), "p").write.mode("overwrite").parquet(f"{path}/scores/pass={k}")
        scores = spark.read.schema("label int, p double").parquet(f"{path}/scores/pass={k}")
        at, auc = coarse_threshold_search(scores, []).first(), curve_areas(scores, []).first()["roc_auc"]
        history.append((k, float(at["best_f1"]), float(at["best_threshold"]), None if auc is None else float(auc)))
        if history[-1][1] > best[0]:
            best = (history[-1][1], k)
        if k - best[1] >= patience:
            break
    rows = [(*h, h[0] == best[1]) for h in history]
    return type(model).load(f"{path}/pass-{best[1]:03d}"), spark.createDataFrame(rows, "pass int, f1 double, threshold double, roc_auc double, best boolean")


# ---------------------------------------------------------------- M16 calibration
def isotonic_calibrated_scores(kind: str, train: DataFrame, score: DataFrame, fold_col: str = "fold",
                               n_folds: int = 3, features: str = "features", label: str = "label",
                               n_features: int | None = None, id_col: str = "id", weight: str | None = None, **params) -> DataFrame:
    """Per fold, fit on the other folds, fit isotonic regression on the held-out scores,
    and average the calibrated scores of the fold models over ``score`` rows."""
    scored = score.select(id_col, features)
    for k in range(n_folds):
        model = fit(estimator(kind, features, label, weight, n_features=n_features, **dict(params)), train.where(F.col(fold_col) % n_folds != k))
        held = positive_probability(model.transform(train.where(F.col(fold_col) % n_folds == k)))
        steps = fit_isotonic(held.select(F.col("p").alias("x"), F.col(label).cast("double").alias("y")))
        raw = positive_probability(model.transform(scored), f"raw{k}")
        scored = apply_isotonic(raw, steps, f"raw{k}", f"cal{k}").select(*scored.columns, f"cal{k}")
    mean = sum((F.col(f"cal{k}") for k in range(n_folds)), F.lit(0.0)) / n_folds
    return scored.select(id_col, mean.alias("p"))


def calibrated_threshold(calibrated: DataFrame, label: str = "label") -> DataFrame:
    """The decision threshold tuned again on calibrated scores (``p``, label): best_threshold, best_f1."""
    return threshold_search(calibrated.select(F.col(label).cast("int").alias("label"), "p"), [])


# ---------------------------------------------------------------- M17 scoring / S12 bundles
def check_feature_count(df: DataFrame, features: str, expected: int) -> None:
    """Refuse to score when any row's feature vector length differs from training."""
    n = F.size(vector_to_array(features))
    seen = df.agg(F.min(n).alias("least"), F.max(n).alias("most")).first()
    if seen["least"] is not None and (seen["least"], seen["most"]) != (expected, expected):
        raise ValueError(f"feature counts {seen['least']} to {seen['most']} != expected {expected}")


def score_batch(model: PipelineModel, df: DataFrame, features: str, expected: int, keep: Sequence[str] = ("id",)):
    """Checked batch scoring → keep columns + ``p``."""
    check_feature_count(df, features, expected)
    return positive_probability(model.transform(df)).select(*keep, "p")


def save_bundle(model: PipelineModel, meta: Mapping, path: str) -> None:
    """Model + metadata (threshold, F1, feature list) under one folder."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(dict(meta), sort_keys=True),)], "meta string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str) -> tuple[PipelineModel, dict]:
    model = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    return model, meta


def pipeline(stages) -> Pipeline:
    return Pipeline(stages=list(stages))
