"""Classification metrics and curves (A17-A26, W3-W4, M14-M15) over score tables.

A score table has grouping keys (e.g. ``model``), a 0/1 ``label`` and a
score ``p``. Curves are built from per-distinct-score counts and their exact
prefix sums (:mod:`.ranking`), so no metric needs a single-task window over
all rows. Threshold grids (≤ a few hundred values) are applied by bucketing
each distinct score against the sorted grid, never by pairing rows with
thresholds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import value_prefix_sums

PR_F1_EPS = 1e-10   # fixed value: added to P+R in the PR-curve F1
_K0 = "__key0"


def _ensure_keys(scores: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str], bool]:
    """Metrics group by keys; without keys a constant key is used and dropped afterwards."""
    keys = list(keys)
    if keys:
        return scores, keys, False
    return scores.withColumn(_K0, F.lit(0)), [_K0], True


def _done(out: DataFrame, added: bool) -> DataFrame:
    return out.drop(_K0) if added else out


def _pos(label: str) -> Column:
    return (F.col(label) == 1).cast("long")


def _neg(label: str) -> Column:
    return (F.col(label) != 1).cast("long")


def score_counts(scores: DataFrame, keys: Sequence[str], label: str = "label", p: str = "p") -> DataFrame:
    """Per (keys, distinct p): pos/neg counts, counts at or above p (tp, fp) and strictly above."""
    s = scores.where(F.col(label).isNotNull() & F.col(p).isNotNull()) \
        .select(*keys, p, _pos(label).alias("__pos"), _neg(label).alias("__neg"))
    pre = value_prefix_sums(s, keys, p, {"pos": "__pos", "neg": "__neg"})
    return pre.select(
        *keys, F.col(p).alias("threshold"), "pos", "neg",
        (F.col("pos_total") - F.col("pos_lt")).alias("tp"),
        (F.col("neg_total") - F.col("neg_lt")).alias("fp"),
        (F.col("pos_total") - F.col("pos_le")).alias("tp_above"),
        (F.col("neg_total") - F.col("neg_le")).alias("fp_above"),
        F.col("neg_lt").alias("neg_below"),
        F.col("pos_total").alias("n_pos"), F.col("neg_total").alias("n_neg"))


# ----------------------------------------------------------------- W3 / W4 curves

def pr_curve(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", p: str = "p") -> DataFrame:
    """Precision and recall when predicting positive for score ≥ threshold, per distinct score.

    (The conventional extra end point precision=1, recall=0 is not a row.)
    """
    scores, keys, added = _ensure_keys(scores, keys)
    c = score_counts(scores, keys, label, p)
    return _done(c.select(*keys, "threshold",
                          (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                          F.when(F.col("n_pos") > 0, F.col("tp") / F.col("n_pos")).otherwise(F.lit(1.0))
                          .alias("recall")), added)


def roc_curve(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", p: str = "p") -> DataFrame:
    """false/true positive rates at every distinct score (no intermediate points dropped)."""
    scores, keys, added = _ensure_keys(scores, keys)
    c = score_counts(scores, keys, label, p)
    return _done(c.select(*keys, "threshold", (F.col("fp") / F.col("n_neg")).alias("fpr"),
                          (F.col("tp") / F.col("n_pos")).alias("tpr")), added)


# ----------------------------------------------------------------- A20-A22 areas

def curve_areas(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                p: str = "p") -> DataFrame:
    """A20 ROC-AUC (ties count one half), A21 average precision (step), A22 PR-AUC (trapezoid).

    PR-AUC integrates precision over recall from the (recall 0, precision 1)
    end point through every distinct threshold, highest first.
    """
    scores, keys, added = _ensure_keys(scores, keys)
    c = score_counts(scores, keys, label, p)
    prec = F.col("tp") / (F.col("tp") + F.col("fp"))
    above = F.col("tp_above") + F.col("fp_above")
    prec_prev = F.when(above > 0, F.col("tp_above") / above).otherwise(F.lit(1.0))
    return _done(c.groupBy(*keys).agg(
        (F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
         / (F.first("n_pos") * F.first("n_neg"))).alias("roc_auc"),
        (F.sum(F.col("pos") * prec) / F.first("n_pos")).alias("average_precision"),
        (F.sum(F.col("pos") * (prec + prec_prev) / 2.0) / F.first("n_pos")).alias("pr_auc")), added)


# ----------------------------------------------------------------- thresholds

def threshold_metrics(scores: DataFrame, thresholds: Sequence[float], keys: Sequence[str] = ("model",),
                      label: str = "label", p: str = "p") -> DataFrame:
    """Confusion counts and positive-class F1 at each listed threshold (prediction: p ≥ t).

    Output: keys…, t_index (position in ``thresholds``), threshold, tp, fp, fn, tn, f1
    (F1 is 0 when undefined). Each distinct score is bucketed against the
    sorted grid; the grid per key is ``len(thresholds)`` rows.
    """
    scores, keys, added = _ensure_keys(scores, keys)
    grid = sorted(set(float(t) for t in thresholds))
    m = len(grid)
    arr = F.array(*[F.lit(g) for g in grid])
    s = scores.where(F.col(label).isNotNull() & F.col(p).isNotNull())
    pv = F.col(p).cast("double")
    per = (s.groupBy(*keys, p).agg(F.sum(_pos(label)).alias("pos"), F.sum(_neg(label)).alias("neg"))
           .withColumn("__idx", F.size(F.filter(arr, lambda g: g <= pv)))
           .groupBy(*keys, "__idx").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    kcols = list(keys)
    totals = per.groupBy(*kcols).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    # positions 1..m of the sorted grid; a score with __idx ≥ j is ≥ grid[j-1]
    rows = totals.select(*kcols, "n_pos", "n_neg", F.explode(F.sequence(F.lit(1), F.lit(m))).alias("__idx"))
    w = Window.partitionBy(*kcols).orderBy(F.col("__idx").desc()).rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(per, kcols + ["__idx"], "left").select(
        *kcols, "__idx", "n_pos", "n_neg",
        F.sum(F.coalesce("pos", F.lit(0))).over(w).alias("tp"),
        F.sum(F.coalesce("neg", F.lit(0))).over(w).alias("fp"))
    pos_of = F.array(*[F.lit(grid.index(float(t)) + 1) for t in thresholds])
    listed = F.posexplode(pos_of).alias("t_index", "__idx")
    keyed = totals.select(*kcols, listed)
    out = keyed.join(joined, kcols + ["__idx"])
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("n_pos") - tp
    tn = F.col("n_neg") - fp
    den = 2 * tp + fp + fn
    return _done(out.select(
        *kcols, F.col("t_index").cast("int").alias("t_index"),
        F.element_at(arr, F.col("__idx")).alias("threshold"),
        tp.cast("long").alias("tp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"),
        tn.cast("long").alias("tn"),
        F.when(den > 0, 2 * tp / den).otherwise(F.lit(0.0)).alias("f1")), added)


def linspace(start: float, stop: float, num: int) -> list[float]:
    """Evenly spaced grid, endpoints included (start + i·step, last point exactly ``stop``)."""
    return [float(x) for x in np.linspace(start, stop, num)]


# Threshold grids of the fine search and of the coarse search.
FINE_GRID = (linspace(0.01, 0.05, 20) + linspace(0.05, 0.15, 50) + linspace(0.15, 0.3, 30)
             + linspace(0.3, 0.9, 20))
COARSE_GRID = linspace(0.1, 0.9, 17)
CURVE_GRID = linspace(0.0, 1.0, 100)


def f1_at_threshold(scores: DataFrame, threshold: float = 0.5, keys: Sequence[str] = ("model",),
                    label: str = "label", p: str = "p") -> DataFrame:
    """Positive-class F1 of ``p ≥ threshold`` (0 when undefined)."""
    return threshold_metrics(scores, [threshold], keys, label, p).select(*keys, "threshold", "f1")


def f1_curve(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", p: str = "p") -> DataFrame:
    """F1 at 100 evenly spaced thresholds on [0, 1]."""
    return threshold_metrics(scores, CURVE_GRID, keys, label, p).select(*keys, "t_index", "threshold", "f1")


def _first_best(df: DataFrame, keys: Sequence[str], score: str, order: Column, cols: Sequence[str]) -> DataFrame:
    """L4: row with the highest ``score`` per key; ties → smallest ``order``."""
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in cols]),
                                          F.struct(F.col(score), -order)).alias("__b"))
    return best.select(*keys, *[F.col(f"__b.{c}").alias(c) for c in cols])


def coarse_threshold_search(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                            p: str = "p") -> DataFrame:
    """17 thresholds 0.1…0.9; starts at (0.5, 0.0) and moves only on strict improvement."""
    scores, keys, added = _ensure_keys(scores, keys)
    tm = threshold_metrics(scores, COARSE_GRID, keys, label, p)
    best = _first_best(tm, keys, "f1", F.col("t_index"), ["threshold", "f1"])
    return _done(best.select(*keys,
                       F.when(F.col("f1") > 0, F.col("threshold")).otherwise(F.lit(0.5)).alias("best_threshold"),
                       F.when(F.col("f1") > 0, F.col("f1")).otherwise(F.lit(0.0)).alias("best_f1")), added)


def threshold_search(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                     p: str = "p") -> DataFrame:
    """Argmax of F1 (with 1e-10 added to P+R) over the PR curve's thresholds (first maximum
    by ascending threshold), then the 120-point grid replaces it only on strict improvement
    (first grid point reaching the grid maximum)."""
    scores, keys, added = _ensure_keys(scores, keys)
    pr = pr_curve(scores, keys, label, p)
    f1pr = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + PR_F1_EPS)
    pr = pr.withColumn("f1", f1pr)
    pr_best = _first_best(pr, keys, "f1", F.col("threshold"), ["threshold", "f1"]).select(
        *keys, F.col("threshold").alias("pr_threshold"), F.col("f1").alias("pr_f1"))
    grid = threshold_metrics(scores, FINE_GRID, keys, label, p)
    g_best = _first_best(grid, keys, "f1", F.col("t_index"), ["threshold", "f1"])
    # one row per key from each search; the grid replaces the PR choice only on a strictly
    # higher F1 (on a tie the PR row's priority 1 wins)
    both = (pr_best.select(*keys, F.col("pr_threshold").alias("threshold"), F.col("pr_f1").alias("f1"),
                           F.lit(1).alias("__prio"))
            .unionByName(g_best.select(*keys, "threshold", "f1", F.lit(0).alias("__prio"))))
    best = both.groupBy(*keys).agg(F.max_by(F.struct("threshold", "f1"), F.struct("f1", "__prio")).alias("__b"))
    return _done(best.select(*keys, F.col("__b.threshold").alias("best_threshold"),
                             F.col("__b.f1").alias("best_f1")), added)


# ----------------------------------------------------------------- A17 / A18

def predict(scores: DataFrame, threshold: float | Column = 0.5, p: str = "p", out: str = "pred") -> DataFrame:
    """``p ≥ t`` → 1 else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scores.withColumn(out, (F.col(p) >= t).cast("int"))


def confusion_matrix(pred: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                     pred_col: str = "pred") -> DataFrame:
    """Counts per (keys, label, prediction)."""
    return pred.groupBy(*keys, label, pred_col).agg(F.count(F.lit(1)).alias("count"))


def classification_report(pred: DataFrame, keys: Sequence[str] = ("model",), label: str = "label",
                          pred_col: str = "pred") -> DataFrame:
    """precision/recall/F1/support per class, macro and weighted averages, accuracy.

    Output rows per key: class ∈ {each label value, 'macro avg', 'weighted avg', 'accuracy'}.
    Undefined ratios are 0 (zero_division=0).
    """
    kc = list(keys)
    cm = confusion_matrix(pred, keys, label, pred_col)
    sup = cm.groupBy(*kc, label).agg(F.sum("count").alias("support")).withColumnRenamed(label, "class")
    prd = cm.groupBy(*kc, pred_col).agg(F.sum("count").alias("predicted")).withColumnRenamed(pred_col, "class")
    tp = cm.where(F.col(label) == F.col(pred_col)).groupBy(*kc, label).agg(F.sum("count").alias("tp")) \
        .withColumnRenamed(label, "class")
    per = (sup.join(prd, kc + ["class"], "full").join(tp, kc + ["class"], "left")
           .select(*kc, "class", F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted"), F.coalesce("tp", F.lit(0)).alias("tp")))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.select(*kc, "class", prec.alias("precision"), rec.alias("recall"), "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    tot = per.groupBy(*kc).agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("w_r"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("w_f"),
        (F.sum("tp") / F.sum("support")).alias("acc"), F.sum("support").alias("n"))
    rows = per.select(*kc, F.col("class").cast("string").alias("class"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    def row(name, pr, rc, f1):
        return F.struct(F.lit(name).alias("class"), F.col(pr).alias("precision"), F.col(rc).alias("recall"),
                        F.col(f1).alias("f1"), F.col("n").cast("long").alias("support"))
    extra = tot.select(*kc, F.inline(F.array(row("macro avg", "m_p", "m_r", "m_f"),
                                             row("weighted avg", "w_p", "w_r", "w_f"),
                                             row("accuracy", "acc", "acc", "acc"))))
    return rows.unionByName(extra)


# ----------------------------------------------------------------- A23-A25

def cv_summary(fold_metrics: DataFrame, metric: str, keys: Sequence[str] = ("model",),
               fold: str = "fold") -> DataFrame:
    """Mean and population std of a per-fold metric, best fold (first maximum)."""
    return fold_metrics.groupBy(*keys).agg(
        F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"),
        F.max(metric).alias("best"),
        F.max_by(F.col(fold), F.struct(F.col(metric), -F.col(fold))).alias("best_fold"))


def score_summary(scores: DataFrame, keys: Sequence[str] = (), p: str = "p") -> DataFrame:
    """Mean / population std / min / max of a probability column."""
    g = scores.groupBy(*keys) if keys else scores
    return g.agg(F.avg(p).alias("mean"), F.stddev_pop(p).alias("std"), F.min(p).alias("min"),
                 F.max(p).alias("max"), F.count(p).alias("n"))


def score_histogram(scores: DataFrame, keys: Sequence[str] = ("model",), label: str = "label", p: str = "p",
                    bins: int = 50) -> DataFrame:
    """Density histogram of scores per class, ``bins`` equal bins over each class's
    [min, max] (the maximum falls in the last bin). Only non-empty bins are rows."""
    kc = list(keys) + [label]
    s = scores.where(F.col(p).isNotNull() & F.col(label).isNotNull())
    rng = s.groupBy(*kc).agg(F.min(p).alias("__lo"), F.max(p).alias("__hi"), F.count(F.lit(1)).alias("__n"))
    lo = F.when(F.col("__hi") > F.col("__lo"), F.col("__lo")).otherwise(F.col("__lo") - 0.5)
    hi = F.when(F.col("__hi") > F.col("__lo"), F.col("__hi")).otherwise(F.col("__hi") + 0.5)
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(p) - lo) / (hi - lo) * bins) + 1, F.lit(bins)).cast("int")
    # the ranges table has one row per (keys, class)
    binned = s.join(rng, kc).select(*kc, b.alias("bin"), lo.alias("__l"), width.alias("__w"), "__n")
    return binned.groupBy(*kc, "bin", "__l", "__w", "__n").agg(F.count(F.lit(1)).alias("count")).select(
        *kc, "bin", (F.col("__l") + (F.col("bin") - 1) * F.col("__w")).alias("bin_start"),
        (F.col("__l") + F.col("bin") * F.col("__w")).alias("bin_end"), "count",
        (F.col("count") / (F.col("__n") * F.col("__w"))).alias("density"))


def feature_importance(model, feature_names: Sequence[str], spark, top: int = 20) -> DataFrame:
    """Top-k features of a fitted tree model by importance."""
    imp = model.featureImportances.toArray().tolist()
    rows = list(zip(feature_names, [float(x) for x in imp]))
    return spark.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.col("importance").desc(), "feature").limit(top)
