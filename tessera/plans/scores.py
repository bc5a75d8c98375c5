"""Model score tables derived from the labeled documents.

Three "models" score every labeled document with a deterministic expression
of its id and label, so positives lean high and scores tie often (1,000
distinct values). A fold column (W5, 5 folds, stratified by label) supports
the cross-validation summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate, folds
from ..sources.tables import table
from .materialize import materialized

# Per model (name, id multiplier, label shift); p = ((id·a + label·b) mod 1000) / 1000.
MODEL_PARAMS = (("m_a", 7919, 300), ("m_b", 104729, 450), ("m_c", 15485863, 200))
FOLD_SEED = 42
N_FOLDS = 5


def labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    return docs.join(lab, "id")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label, model, p — one row per (labeled document, model)."""
    base = labeled(spark, sf_dir)
    per_model = F.array(*[
        F.struct(F.lit(m).alias("model"),
                 (F.pmod(F.col("id") * F.lit(a) + F.col("label") * F.lit(b), F.lit(1000)) / F.lit(1000.0)).alias("p"))
        for m, a, b in MODEL_PARAMS])
    return base.select("id", "label", F.inline(per_model))


def scores_with_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with the fold of each id, written once per session (a predictions table)."""
    def build():
        f = folds.stratified_folds(labeled(spark, sf_dir), "label", N_FOLDS, "id", FOLD_SEED)
        return scores(spark, sf_dir).join(f.select("id", "fold"), "id")
    return materialized(spark, "scores", sf_dir, build)


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """model, best_threshold, best_f1 (M14 on the scores), best_cv_score (mean fold F1 at 0.5);
    one row per model, written once per session (the model metadata of the bundles)."""
    def build():
        s = scores_with_folds(spark, sf_dir)
        th = evaluate.threshold_search(s, ["model"])
        per_fold = evaluate.f1_at_threshold(s, 0.5, ["model", "fold"])
        cv = evaluate.cv_summary(per_fold, "f1", ["model"]).select("model", F.col("mean").alias("best_cv_score"))
        return th.join(cv, "model")
    return materialized(spark, "model-table", sf_dir, build)
