"""Ensembles of model scores (N1-N9, W1) over a long ``(id, model, p)`` table.

Every combination is a ``groupBy(id)`` aggregate; model-level values
(weights, thresholds) live in a table with one row per model and are
attached by a join whose small side is bounded by the number of models.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import work_id
from .ranking import tie_ranked
from .util import attach_scalar

GEOMETRIC_EPS = 1e-10   # fixed value: added before the logarithm
VOTE_CUT = 0.5          # fixed value: a model votes positive when p > 0.5
DEFAULT_THRESHOLD = 0.5
TIE_BREAKERS = ("conservative", "aggressive", "round_down", "round_up", "prob_mean")


def model_weight(best_f1: Column | str = "best_f1", best_cv_score: Column | str = "best_cv_score",
                 default: float = 1.0) -> Column:
    """(best_f1, else best_cv_score)²; ``default`` when missing or ≤ 0."""
    f = F.col(best_f1) if isinstance(best_f1, str) else best_f1
    c = F.col(best_cv_score) if isinstance(best_cv_score, str) else best_cv_score
    s = F.coalesce(f, c)
    return F.when(s.isNull() | (s <= 0), F.lit(float(default))).otherwise(s * s)


def rank_transform(scores: DataFrame, keys: Sequence[str] = ("model",), p: str = "p",
                   out: str = "rank_p") -> DataFrame:
    """(number of strictly smaller scores) / (n − 1) within ``keys``; 0 for a single row.

    Equal to ``percent_rank``, but the rows carry their rank through one exchange (:func:`.ranking.tie_ranked`), so
    neither a model nor a tied score is ranked inside a single task. Rows without a score or key are left out.
    """
    ranked = tie_ranked(scores, keys, p, "__below", "__n")
    share = F.when(F.col("__n") > 1, F.col("__below") / (F.col("__n") - 1)).otherwise(F.lit(0.0))
    return ranked.withColumn(out, share).drop("__below", "__n")


def combine(scores: DataFrame, method: str = "weighted_mean", models: DataFrame | None = None,
            tie_breaker: str = "conservative", id_col: str = "id", model_col: str = "model",
            p: str = "p") -> DataFrame:
    """One ensemble probability per id.

    ``weighted_mean`` needs ``models`` with ``model, best_f1, best_cv_score``.
    ``vote`` returns the vote share as probability and also the tie-broken class
    ``vote_label`` (share > ½ → 1, = ½ → tie breaker, prob_mean: mean p ≥ 0.5).
    """
    if method == "mean":
        return scores.groupBy(id_col).agg(F.avg(p).alias("p"))
    if method == "weighted_mean":
        if models is None:
            raise ValueError("weighted_mean needs the models table")
        w = models.select(model_col, model_weight().alias("__w"))
        j = scores.join(w, model_col)
        return j.groupBy(id_col).agg((F.sum(F.col(p) * F.col("__w")) / F.sum("__w")).alias("p"))
    if method == "geometric_mean":
        return scores.groupBy(id_col).agg(F.exp(F.avg(F.log(F.col(p) + GEOMETRIC_EPS))).alias("p"))
    if method == "rank_mean":
        r = rank_transform(scores, [model_col], p, "__r")
        return r.groupBy(id_col).agg(F.avg("__r").alias("p"))
    if method == "vote":
        g = scores.groupBy(id_col).agg(
            F.sum((F.col(p) > VOTE_CUT).cast("long")).alias("__v"), F.count(F.lit(1)).alias("__n"),
            F.avg(p).alias("__mean"))
        share = F.col("__v") / F.col("__n")
        tie = F.col("__v") * 2 == F.col("__n")
        if tie_breaker == "conservative":
            broken = F.lit(0)
        elif tie_breaker == "aggressive":
            broken = F.lit(1)
        elif tie_breaker == "prob_mean":
            broken = (F.col("__mean") >= 0.5).cast("int")
        else:
            raise ValueError(f"unknown tie_breaker {tie_breaker!r}")
        label = F.when(tie, broken).otherwise((F.col("__v") * 2 > F.col("__n")).cast("int"))
        return g.select(id_col, share.alias("p"), label.cast("int").alias("vote_label"))
    raise ValueError(f"unknown method {method!r}")


def final_threshold(models: DataFrame | None = None, explicit: float | None = None) -> Column:
    """N7 as a one-row aggregate expression over ``models``: explicit, else the mean of
    the known thresholds, else 0.5."""
    if explicit is not None:
        return F.lit(float(explicit))
    return F.coalesce(F.avg("best_threshold"), F.lit(DEFAULT_THRESHOLD))


def break_ties(p: Column | str, threshold: Column | float, tie_breaker: str = "conservative") -> Column:
    """``p ≥ t`` → 1, and exactly ``p = t`` decided by the tie breaker."""
    pc = F.col(p) if isinstance(p, str) else p
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    if tie_breaker in ("conservative", "round_down"):
        at = F.lit(0)
    elif tie_breaker in ("aggressive", "round_up"):
        at = F.lit(1)
    elif tie_breaker == "prob_mean":   # our definition: the mean probability itself is ≥ 0.5
        at = (pc >= 0.5).cast("int")
    else:
        raise ValueError(f"unknown tie_breaker {tie_breaker!r}")
    return F.when(pc == t, at).otherwise((pc >= t).cast("int")).cast("int")


def submission(ensembled: DataFrame, threshold: Column | float, tie_breaker: str = "conservative",
               id_col: str = "id", p: str = "p") -> DataFrame:
    """``(work_id, label)`` rows."""
    return ensembled.select(work_id(id_col).alias("work_id"), break_ties(p, threshold, tie_breaker).alias("label"))


def submission_summary(sub: DataFrame) -> DataFrame:
    """Totals and shares of each predicted label."""
    counts = sub.groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    total = sub.agg(F.count(F.lit(1)).alias("__n"))
    return attach_scalar(counts, total).select("label", "count", (F.col("count") / F.col("__n")).alias("share"))
