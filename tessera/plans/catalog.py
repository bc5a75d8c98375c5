"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query reads the driver tables under ``sf_dir`` in full. Statistics are
rounded to 6 decimals on both sides so that summation order cannot change
the value hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.feature import StandardScaler as _StdScaler
from pyspark.ml.feature import VectorAssembler as _VA
from pyspark.ml.functions import vector_to_array as _v2a
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as DT
from ..functions import encode
from ..functions import nested as NF
from ..functions import text as TX
from ..operators import ensemble, evaluate, folds, stats
from ..operators import join as JN
from ..operators import model_ready as MR
from ..operators import models as MD
from ..operators import resample as RS
from ..operators import schema as SO
from ..operators import source_fields as SF
from ..operators import vectors as VC
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import files as FS
from ..sources.tables import table
from ..streaming import ingest
from . import records as RC
from . import scores as SC
from . import sqlbits as S
from . import works as W

ROUND = 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def rnd(c, digits: int = ROUND):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _feats(spark, sf_dir):
    """Materialised base features (see works.feature_table), without ``toxic``."""
    return W.feature_table(spark, sf_dir).drop("toxic")


def _train(spark, sf_dir):
    return _feats(spark, sf_dir).where(F.col("split") == "train")


CORR_FEATURES = W.TEXT_FEATURES + ["n_chars"]


# ------------------------------------------------------------------ F2-F4, F22-F25
@register("f_text_features", f"""
WITH {S.WORKS_CTE}
SELECT * FROM feats""")
def f_text_features(spark, sf_dir):
    return W.work_features(W.works(spark, sf_dir))


# ------------------------------------------------------------------ A6-A8
@register("a6_a7_correlations", f"""
WITH {S.WORKS_CTE},
long AS ({S.unpivot_features("(SELECT * FROM feats WHERE split = 'train')", CORR_FEATURES)}),
pairs AS (SELECT * FROM long WHERE x IS NOT NULL AND y IS NOT NULL),
pear AS (
  SELECT feature, count(*) AS n, corr(x, y) AS pearson_r
  FROM pairs GROUP BY feature
  HAVING count(*) >= 10 AND min(x) < max(x) AND min(y) < max(y)),
ranked AS (
  SELECT feature,
         rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
         rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry
  FROM pairs),
spear AS (SELECT feature, corr(rx, ry) AS spearman_r FROM ranked GROUP BY feature)
SELECT p.feature, p.n, round(p.pearson_r, 6) AS pearson_r, round(s.spearman_r, 6) AS spearman_r
FROM pear p LEFT JOIN spear s USING (feature)""")
def a6_a7_correlations(spark, sf_dir):
    r = stats.correlation_stats(_train(spark, sf_dir), CORR_FEATURES, "label")
    return r.select("feature", "n", rnd("pearson_r").alias("pearson_r"), rnd("spearman_r").alias("spearman_r"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-vs-label correlation report (A6-A8) on the text features, sorted by |r|."""
    return a6_a7_correlations(spark, sf_dir).orderBy(F.abs("pearson_r").desc(), "feature")


# ================================================================== evaluation (scores)

_SC = S.scores_cte()


def _scores(spark, sf_dir):
    return SC.scores_with_folds(spark, sf_dir).drop("fold")


@register("w3_pr_curve", f"""
WITH {_SC}
SELECT model, threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
       CASE WHEN n_pos > 0 THEN CAST(tp AS DOUBLE) / n_pos ELSE 1.0 END AS recall
FROM curve""")
def w3_pr_curve(spark, sf_dir):
    return evaluate.pr_curve(_scores(spark, sf_dir), ["model"])


@register("w4_roc_curve", f"""
WITH {_SC}
SELECT model, threshold, CAST(fp AS DOUBLE) / n_neg AS fpr, CAST(tp AS DOUBLE) / n_pos AS tpr FROM curve""")
def w4_roc_curve(spark, sf_dir):
    return evaluate.roc_curve(_scores(spark, sf_dir), ["model"])


@register("a20_a22_curve_areas", f"""
WITH {_SC},
c2 AS (SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS prec,
              CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / ((tp - pos) + (fp - neg))
                   ELSE 1.0 END AS prec_prev,
              n_neg - (fp) AS neg_below FROM curve)
SELECT model,
       round(sum(pos * (neg_below + neg / 2.0)) / (max(n_pos) * max(n_neg)), 6) AS roc_auc,
       round(sum(pos * prec) / max(n_pos), 6) AS average_precision,
       round(sum(pos * (prec + prec_prev) / 2.0) / max(n_pos), 6) AS pr_auc
FROM c2 GROUP BY model""")
def a20_a22_curve_areas(spark, sf_dir):
    a = evaluate.curve_areas(_scores(spark, sf_dir), ["model"])
    return a.select("model", rnd("roc_auc").alias("roc_auc"), rnd("average_precision").alias("average_precision"),
                    rnd("pr_auc").alias("pr_auc"))


@register("a17_confusion", f"""
WITH {_SC}
SELECT model, label, CAST(p >= 0.5 AS INTEGER) AS pred, count(*) AS count FROM scores GROUP BY ALL""")
def a17_confusion(spark, sf_dir):
    return evaluate.confusion_matrix(evaluate.predict(_scores(spark, sf_dir), 0.5), ["model"])


@register("a18_class_report", f"""
WITH {_SC},
pr AS (SELECT model, label, CAST(p >= 0.5 AS INTEGER) AS pred FROM scores),
cls AS (SELECT DISTINCT model, label AS class FROM pr UNION SELECT DISTINCT model, pred FROM pr),
per AS (
  SELECT c.model, c.class,
         (SELECT count(*) FROM pr WHERE pr.model = c.model AND pr.label = c.class) AS support,
         (SELECT count(*) FROM pr WHERE pr.model = c.model AND pr.pred = c.class) AS predicted,
         (SELECT count(*) FROM pr WHERE pr.model = c.model AND pr.pred = c.class AND pr.label = c.class) AS tp
  FROM cls c),
per2 AS (
  SELECT model, class, support, tp,
         CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall
  FROM per),
per3 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                        ELSE 0.0 END AS f1 FROM per2)
SELECT model, CAST(class AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM per3
UNION ALL
SELECT model, 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM per3 GROUP BY model
UNION ALL
SELECT model, 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM per3 GROUP BY model
UNION ALL
SELECT model, 'accuracy', round(CAST(sum(tp) AS DOUBLE) / sum(support), 6), round(CAST(sum(tp) AS DOUBLE) / sum(support), 6),
       round(CAST(sum(tp) AS DOUBLE) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM per3 GROUP BY model""")
def a18_class_report(spark, sf_dir):
    r = evaluate.classification_report(evaluate.predict(_scores(spark, sf_dir), 0.5), ["model"])
    return r.select("model", "class", rnd("precision").alias("precision"), rnd("recall").alias("recall"),
                    rnd("f1").alias("f1"), "support")


@register("a19_f1_at_threshold", f"""
WITH {_SC}, {S.grid_values('g', [0.5])}, t AS ({S.grid_f1('g')})
SELECT model, threshold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM t""")
def a19_f1_at_threshold(spark, sf_dir):
    return evaluate.f1_at_threshold(_scores(spark, sf_dir), 0.5, ["model"])


@register("a26_f1_curve", f"""
WITH {_SC}, {S.grid_values('g', evaluate.CURVE_GRID)}, t AS ({S.grid_f1('g')})
SELECT model, CAST(t_index AS INTEGER) AS t_index, threshold,
       CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM t""")
def a26_f1_curve(spark, sf_dir):
    return evaluate.f1_curve(_scores(spark, sf_dir), ["model"])


_COARSE_SQL = f"""
{S.grid_values('cg', evaluate.COARSE_GRID)}, ct AS ({S.grid_f1('cg')}),
cf AS (SELECT model, t_index, threshold,
              CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM ct),
cbest AS (SELECT model, arg_max(threshold, f1 * 1000 - t_index / 1000.0) AS thr, max(f1) AS f1 FROM cf GROUP BY model)"""


@register("m15_coarse_threshold", f"""
WITH {_SC}, {_COARSE_SQL}
SELECT model, CASE WHEN f1 > 0 THEN thr ELSE 0.5 END AS best_threshold,
       CASE WHEN f1 > 0 THEN f1 ELSE 0.0 END AS best_f1 FROM cbest""")
def m15_coarse_threshold(spark, sf_dir):
    return evaluate.coarse_threshold_search(_scores(spark, sf_dir), ["model"])


_M14_SQL = f"""
prc AS (SELECT model, threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
               CASE WHEN n_pos > 0 THEN CAST(tp AS DOUBLE) / n_pos ELSE 1.0 END AS recall FROM curve),
prf AS (SELECT model, threshold, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM prc),
prb AS (SELECT model, max(f1) AS pr_f1 FROM prf GROUP BY model),
prt AS (SELECT f.model, min(f.threshold) AS pr_threshold, max(b.pr_f1) AS pr_f1
        FROM prf f JOIN prb b ON f.model = b.model AND f.f1 = b.pr_f1 GROUP BY f.model),
{S.grid_values('fg', evaluate.FINE_GRID)}, ft AS ({S.grid_f1('fg')}),
ff AS (SELECT model, t_index, threshold,
              CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM ft),
fb AS (SELECT model, max(f1) AS g_f1 FROM ff GROUP BY model),
fbt AS (SELECT f.model, f.threshold AS g_threshold, b.g_f1 FROM ff f JOIN fb b ON f.model = b.model AND f.f1 = b.g_f1
        QUALIFY row_number() OVER (PARTITION BY f.model ORDER BY f.t_index) = 1),
m14 AS (SELECT p.model,
               CASE WHEN g.g_f1 > p.pr_f1 THEN g.g_threshold ELSE p.pr_threshold END AS best_threshold,
               CASE WHEN g.g_f1 > p.pr_f1 THEN g.g_f1 ELSE p.pr_f1 END AS best_f1
        FROM prt p JOIN fbt g USING (model))"""


@register("m14_threshold_search", f"""
WITH {_SC}, {_M14_SQL}
SELECT model, best_threshold, round(best_f1, 9) AS best_f1 FROM m14""")
def m14_threshold_search(spark, sf_dir):
    t = evaluate.threshold_search(_scores(spark, sf_dir), ["model"])
    return t.select("model", "best_threshold", rnd("best_f1", 9).alias("best_f1"))


@register("a25_score_histogram", f"""
WITH {_SC},
rng AS (SELECT model, label, min(p) AS lo0, max(p) AS hi0, count(*) AS n FROM scores GROUP BY ALL),
r2 AS (SELECT *, CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS lo,
                 CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS hi FROM rng),
b AS (SELECT s.model, s.label, CAST(least(floor((s.p - r.lo) / (r.hi - r.lo) * 50) + 1, 50) AS INTEGER) AS bin,
             r.lo, (r.hi - r.lo) / 50 AS w, r.n
      FROM scores s JOIN r2 r USING (model, label))
SELECT model, label, bin, round(lo + (bin - 1) * w, 9) AS bin_start, round(lo + bin * w, 9) AS bin_end,
       count(*) AS count, round(count(*) / (n * w), 6) AS density
FROM b GROUP BY model, label, bin, lo, w, n""")
def a25_score_histogram(spark, sf_dir):
    h = evaluate.score_histogram(_scores(spark, sf_dir), ["model"])
    return h.select("model", "label", "bin", rnd("bin_start", 9).alias("bin_start"), rnd("bin_end", 9).alias("bin_end"),
                    "count", rnd("density").alias("density"))


@register("w1_rank_transform", f"""
WITH {_SC}
SELECT id, label, model, p,
       CASE WHEN count(*) OVER (PARTITION BY model) > 1
            THEN CAST(rank() OVER (PARTITION BY model ORDER BY p) - 1 AS DOUBLE) / (count(*) OVER (PARTITION BY model) - 1)
            ELSE 0.0 END AS rank_p
FROM scores""")
def w1_rank_transform(spark, sf_dir):
    return ensemble.rank_transform(_scores(spark, sf_dir), ["model"])


@register("w5_stratified_folds", f"""
WITH {_SC}
SELECT id, label, fold FROM lfold""")
def w5_stratified_folds(spark, sf_dir):
    return folds.stratified_folds(SC.labeled(spark, sf_dir), "label", SC.N_FOLDS, "id", SC.FOLD_SEED)


@register("w6_stratified_split", f"""
WITH {_SC}
SELECT id, label, pos < floor(class_n * 0.2 + 0.5) AS is_test FROM lpos""")
def w6_stratified_split(spark, sf_dir):
    return folds.stratified_split(SC.labeled(spark, sf_dir), "label", test_fraction=0.2, id_col="id",
                                  seed=SC.FOLD_SEED)


@register("v8_undersample", f"""
WITH {_SC}
SELECT id, label FROM lpos WHERE pos < (SELECT min(class_n) FROM lpos)""")
def v8_undersample(spark, sf_dir):
    return folds.undersample(SC.labeled(spark, sf_dir), "label", "id", SC.FOLD_SEED)


@register("a23_cv_summary", f"""
WITH {_SC}, {S.grid_values('g', [0.5])}, t AS ({S.grid_f1('g', 'sfold', 'model, fold')}),
ff AS (SELECT model, fold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM t)
SELECT model, round(avg(f1), 6) AS mean, round(stddev_pop(f1), 6) AS std, max(f1) AS best,
       arg_max(fold, f1 * 1000 - fold / 1000.0) AS best_fold
FROM ff GROUP BY model""")
def a23_cv_summary(spark, sf_dir):
    s = SC.scores_with_folds(spark, sf_dir)
    per_fold = evaluate.f1_at_threshold(s, 0.5, ["model", "fold"])
    c = evaluate.cv_summary(per_fold, "f1", ["model"])
    return c.select("model", rnd("mean").alias("mean"), rnd("std").alias("std"), "best", "best_fold")


# ------------------------------------------------------------------ ensembles N1-N9
_MODELS_SQL = f"""{_M14_SQL},
cvf AS (SELECT model, fold, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1
        FROM ({S.grid_f1('g5', 'sfold', 'model, fold')})),
models AS (SELECT m.model, m.best_threshold, m.best_f1, c.best_cv_score
           FROM m14 m JOIN (SELECT model, avg(f1) AS best_cv_score FROM cvf GROUP BY model) c USING (model)),
mw AS (SELECT model, CASE WHEN coalesce(best_f1, best_cv_score) IS NULL OR coalesce(best_f1, best_cv_score) <= 0
                          THEN 1.0 ELSE coalesce(best_f1, best_cv_score) * coalesce(best_f1, best_cv_score) END AS w,
              best_threshold FROM models)"""
_ENS_HEAD = f"WITH {_SC}, {S.grid_values('g5', [0.5])}, {_MODELS_SQL}"


@register("n1_model_weights", f"""{_ENS_HEAD}
SELECT model, round(best_threshold, 9) AS best_threshold, round(w, 9) AS weight FROM mw""")
def n1_model_weights(spark, sf_dir):
    m = SC.model_table(spark, sf_dir)
    return m.select("model", rnd("best_threshold", 9).alias("best_threshold"),
                    rnd(ensemble.model_weight(), 9).alias("weight"))


@register("n2_n5_ensembles", f"""{_ENS_HEAD},
rk AS (SELECT id, model, p,
              CASE WHEN count(*) OVER (PARTITION BY model) > 1
                   THEN CAST(rank() OVER (PARTITION BY model ORDER BY p) - 1 AS DOUBLE) / (count(*) OVER (PARTITION BY model) - 1)
                   ELSE 0.0 END AS r FROM scores)
SELECT s.id,
       round(avg(s.p), 6) AS mean_p,
       round(sum(s.p * w.w) / sum(w.w), 6) AS weighted_p,
       round(exp(avg(ln(s.p + 1e-10))), 6) AS geometric_p,
       round(avg(k.r), 6) AS rank_p
FROM scores s JOIN mw w USING (model) JOIN rk k ON k.id = s.id AND k.model = s.model
GROUP BY s.id""")
def n2_n5_ensembles(spark, sf_dir):
    s = _scores(spark, sf_dir)
    models = SC.model_table(spark, sf_dir)
    mean = ensemble.combine(s, "mean").withColumnRenamed("p", "mean_p")
    wm = ensemble.combine(s, "weighted_mean", models).withColumnRenamed("p", "weighted_p")
    gm = ensemble.combine(s, "geometric_mean").withColumnRenamed("p", "geometric_p")
    rm = ensemble.combine(s, "rank_mean").withColumnRenamed("p", "rank_p")
    j = mean.join(wm, "id").join(gm, "id").join(rm, "id")
    return j.select("id", *[rnd(c).alias(c) for c in ("mean_p", "weighted_p", "geometric_p", "rank_p")])


@register("n6_vote", f"""
WITH {_SC}
SELECT id, CAST(sum(CAST(p > 0.5 AS BIGINT)) AS DOUBLE) / count(*) AS p,
       CAST(CASE WHEN 2 * sum(CAST(p > 0.5 AS BIGINT)) = count(*) THEN CAST(avg(p) >= 0.5 AS INTEGER)
                 ELSE CAST(2 * sum(CAST(p > 0.5 AS BIGINT)) > count(*) AS INTEGER) END AS INTEGER) AS vote_label
FROM scores GROUP BY id""")
def n6_vote(spark, sf_dir):
    return ensemble.combine(_scores(spark, sf_dir), "vote", tie_breaker="prob_mean")


@register("n7_n9_submission", f"""{_ENS_HEAD},
thr AS (SELECT coalesce(avg(best_threshold), 0.5) AS t FROM mw),
ens AS (SELECT s.id, sum(s.p * w.w) / sum(w.w) AS p FROM scores s JOIN mw w USING (model) GROUP BY s.id)
SELECT regexp_extract('https://openalex.org/W' || CAST(id AS VARCHAR), 'W[0-9]+', 0) AS work_id,
       CAST(CASE WHEN p = t THEN 0 WHEN p >= t THEN 1 ELSE 0 END AS INTEGER) AS label
FROM ens, thr""")
def n7_n9_submission(spark, sf_dir):
    s = _scores(spark, sf_dir)
    models = SC.model_table(spark, sf_dir)
    ens = ensemble.combine(s, "weighted_mean", models)
    thr = models.agg(ensemble.final_threshold().alias("__t"))
    from ..operators.util import attach_scalar
    with_t = attach_scalar(ens.withColumn("id", F.concat(F.lit("https://openalex.org/W"), F.col("id").cast("string"))),
                           thr)
    return ensemble.submission(with_t, F.col("__t"), "conservative")


@register("a24_score_summary", f"""
WITH {_SC}, e AS (SELECT id, avg(p) AS p FROM scores GROUP BY id)
SELECT round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS std, min(p) AS min, max(p) AS max, count(p) AS n FROM e""")
def a24_score_summary(spark, sf_dir):
    e = ensemble.combine(_scores(spark, sf_dir), "mean")
    s = evaluate.score_summary(e)
    return s.select(rnd("mean").alias("mean"), rnd("std").alias("std"), "min", "max", "n")


# ================================================================== nested records F1, F5-F21, F29-F32

_DOUBLE_TYPES = ("double", "float")


def _round_doubles(df: DataFrame, digits: int = ROUND) -> DataFrame:
    return df.select(*[rnd(f.name, digits).alias(f.name) if f.dataType.typeName() in _DOUBLE_TYPES else F.col(f.name)
                       for f in df.schema.fields])


@register("f5_f21_record_features", """
WITH fa AS (
  SELECT l_orderkey, l_quantity AS fh, l_extendedprice AS fc FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice) = 1),
a0 AS (
  SELECT l_orderkey,
         count(*) AS num_authors,
         count(DISTINCT 'I' || CAST(l_suppkey AS VARCHAR)) AS num_institutions,
         CAST(min(l_linenumber) AS DOUBLE) AS first_author_papers,
         max(l_quantity) AS max_author_h_index, avg(l_quantity) AS avg_author_h_index,
         sum(l_extendedprice) AS total_author_citations, avg(l_extendedprice) AS avg_author_citations,
         count(*) FILTER (WHERE l_linenumber <= 3) AS num_authorships,
         count(*) AS num_concepts, max(l_discount * 10) AS max_concept_score, avg(l_discount * 10) AS avg_concept_score,
         count(*) FILTER (WHERE l_discount * 10 >= 0.5) AS num_high_concepts,
         count(l_partkey) AS num_references, count(DISTINCT l_suppkey) AS num_related_works,
         count(*) FILTER (WHERE l_returnflag = 'R') AS num_grants,
         count(*) AS num_locations,
         count(*) AS num_topics, max(l_tax * 10) AS max_topic_score, avg(l_tax * 10) AS avg_topic_score,
         count(DISTINCT l_returnflag) AS num_keywords,
         count(*) FILTER (WHERE l_linestatus = 'O') AS num_mesh_terms,
         count(*) FILTER (WHERE l_discount > 0.08) AS num_sdgs
  FROM lineitem GROUP BY l_orderkey),
a AS (SELECT a0.*, fa.fh AS first_author_h_index, fa.fc AS first_author_citations FROM a0 JOIN fa USING (l_orderkey))
SELECT o.o_orderkey AS id,
       CAST(year(o.o_orderdate) AS BIGINT) AS publication_year,
       coalesce(o.o_orderpriority, 'unknown') AS type, coalesce(o.o_orderstatus, 'unknown') AS language,
       coalesce(a.num_authors, 0) AS num_authors, coalesce(a.num_institutions, 0) AS num_institutions,
       round(coalesce(a.first_author_h_index, 0.0), 6) AS first_author_h_index,
       round(coalesce(a.first_author_citations, 0.0), 6) AS first_author_citations,
       round(coalesce(a.first_author_papers, 0.0), 6) AS first_author_papers,
       round(coalesce(a.max_author_h_index, 0.0), 6) AS max_author_h_index,
       round(coalesce(a.avg_author_h_index, 0.0), 6) AS avg_author_h_index,
       round(coalesce(a.total_author_citations, 0.0), 6) AS total_author_citations,
       round(coalesce(a.avg_author_citations, 0.0), 6) AS avg_author_citations,
       coalesce(a.num_authorships, 0) AS num_authorships,
       round(o.o_totalprice / 1000, 6) AS venue_impact_factor,
       round(CAST(o.o_custkey % 100 AS DOUBLE), 6) AS venue_h_index,
       round(o.o_totalprice, 6) AS venue_citations,
       CAST(coalesce(o.o_orderstatus = 'O', false) AS INTEGER) AS is_oa_venue,
       CAST(coalesce(starts_with(o.o_orderpriority, '1'), false) AS INTEGER) AS is_in_doaj,
       coalesce(a.num_concepts, 0) AS num_concepts,
       round(coalesce(a.max_concept_score, 0.0), 6) AS max_concept_score,
       round(coalesce(a.avg_concept_score, 0.0), 6) AS avg_concept_score,
       coalesce(a.num_high_concepts, 0) AS num_high_concepts,
       CAST(coalesce(o.o_orderstatus = 'F', false) AS INTEGER) AS is_oa,
       CASE WHEN o.o_orderstatus = 'F' THEN 'gold' WHEN o.o_orderstatus = 'P' THEN 'green' ELSE 'closed' END AS oa_status,
       CAST(coalesce(o.o_orderpriority IN ('1-URGENT', '2-HIGH'), false) AS INTEGER) AS any_repository_has_fulltext,
       coalesce(a.num_references, 0) AS num_references, coalesce(a.num_related_works, 0) AS num_related_works,
       CAST(o.o_orderpriority = '1-URGENT' AS INTEGER) AS has_doi,
       CAST(coalesce(o.o_orderstatus = 'F', false) AS INTEGER) AS has_pmid,
       0 AS has_pmcid,
       coalesce(a.num_grants, 0) AS num_grants, CAST(coalesce(a.num_grants, 0) > 0 AS INTEGER) AS has_grants,
       coalesce(a.num_locations, 0) AS num_locations,
       coalesce(a.num_topics, 0) AS num_topics,
       round(coalesce(a.max_topic_score, 0.0), 6) AS max_topic_score,
       round(coalesce(a.avg_topic_score, 0.0), 6) AS avg_topic_score,
       coalesce(a.num_keywords, 0) AS num_keywords, coalesce(a.num_mesh_terms, 0) AS num_mesh_terms,
       coalesce(a.num_sdgs, 0) AS num_sdgs, CAST(coalesce(a.num_sdgs, 0) > 0 AS INTEGER) AS has_sdgs,
       CAST(2025 - year(o.o_orderdate) AS BIGINT) AS num_years_after_publication,
       CAST(trunc(epoch_us(TIMESTAMP '2025-01-01 00:00:00') - epoch_us(o.o_orderdate)) // 86400000000 AS BIGINT) AS days_since_updated,
       CAST((epoch_us(TIMESTAMP '2025-01-01 00:00:00') - epoch_us(date_trunc('day', o.o_orderdate))) // 86400000000 AS BIGINT) AS days_since_publication
FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey""")
def f5_f21_record_features(spark, sf_dir):
    return _round_doubles(RC.order_feature_table(spark, sf_dir))


# ================================================================== statistics and imputation

RAW_COLUMNS = ["id", "title", "abstract", "language", "type", "n_chars", "label", "toxic"]
NUMERIC_TRAIN = CORR_FEATURES + ["label", "toxic"]
CATEGORICAL_TRAIN = ["type", "language"]
CHI_FEATURES = ["type", "language", "size_class"]
SIZE_CLASS_CUT = 2000


def _feats_full(spark, sf_dir):
    return W.feature_table(spark, sf_dir)


def _missing_sql() -> str:
    parts = []
    for c in RAW_COLUMNS:
        parts.append(f"""SELECT '{c}' AS column,
  count(*) FILTER (WHERE split = 'train' AND {c} IS NULL) AS train_missing,
  count(*) FILTER (WHERE split = 'val' AND {c} IS NULL) AS val_missing,
  count(*) FILTER (WHERE split = 'test' AND {c} IS NULL) AS test_missing,
  count(*) FILTER (WHERE split = 'train' AND {c} IS NULL) / count(*) FILTER (WHERE split = 'train') AS train_pct,
  count(*) FILTER (WHERE split = 'val' AND {c} IS NULL) / count(*) FILTER (WHERE split = 'val') AS val_pct,
  count(*) FILTER (WHERE split = 'test' AND {c} IS NULL) / count(*) FILTER (WHERE split = 'test') AS test_pct
FROM works""")
    return f"WITH {S.WORKS_CTE}\n" + "\nUNION ALL\n".join(parts)


@register("a1_missingness", _missing_sql())
def a1_missingness(spark, sf_dir):
    w = W.works(spark, sf_dir)
    return stats.missingness_by_split(w.select(*RAW_COLUMNS, "split"), ["train", "val", "test"])


_A2_SQL = (f"WITH {S.WORKS_CTE},\nf2 AS (SELECT f.*, w.toxic FROM feats f JOIN works w USING (id))\n"
           + "\nUNION ALL\n".join(f"SELECT '{c}' AS column, round(median({c}), 6) AS median FROM f2 "
                                    f"WHERE split = 'train'" for c in NUMERIC_TRAIN))


@register("a2_medians", _A2_SQL)
def a2_medians(spark, sf_dir):
    train = _feats_full(spark, sf_dir).where(F.col("split") == "train")
    return stats.column_medians(train, NUMERIC_TRAIN).select("column", rnd("median").alias("median"))


@register("a3_modes", f"WITH {S.WORKS_CTE}\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, coalesce((SELECT {c} FROM feats WHERE split = 'train' AND {c} IS NOT NULL
        GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), '__missing__') AS mode""" for c in CATEGORICAL_TRAIN))
def a3_modes(spark, sf_dir):
    train = _feats_full(spark, sf_dir).where(F.col("split") == "train")
    return stats.column_modes(train, CATEGORICAL_TRAIN)


def _impute_sql() -> str:
    num = ",\n".join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM f2 WHERE split = 'train')), 6) AS {c}"
                     for c in NUMERIC_TRAIN)
    cat = ",\n".join(f"""coalesce({c}, (SELECT {c} FROM f2 WHERE split = 'train' AND {c} IS NOT NULL
        GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}""" for c in CATEGORICAL_TRAIN)
    return f"""WITH {S.WORKS_CTE}, f2 AS (SELECT f.*, w.toxic FROM feats f JOIN works w USING (id))
SELECT id, {cat}, {num}, split FROM f2"""


@register("a4_impute", _impute_sql())
def a4_impute(spark, sf_dir):
    full = _feats_full(spark, sf_dir).select("id", *CATEGORICAL_TRAIN, *NUMERIC_TRAIN, "split")
    spec = stats.fit_imputation(full.where(F.col("split") == "train").drop("split"), id_cols=["id"])
    out = stats.apply_imputation(full, spec)
    return _round_doubles(out)


def _chi_src(spark, sf_dir):
    t = _feats_full(spark, sf_dir).where((F.col("split") == "train") & F.col("label").isNotNull())
    return t.withColumn("size_class", F.when(F.col("n_chars") > SIZE_CLASS_CUT, "long").otherwise("short"))


_CHI_CTE = f"""{S.WORKS_CTE},
t AS (SELECT *, CASE WHEN n_chars > {SIZE_CLASS_CUT} THEN 'long' ELSE 'short' END AS size_class
      FROM feats WHERE split = 'train' AND label IS NOT NULL),
ct AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS x, label AS y, count(*) AS count FROM t GROUP BY ALL" for c in CHI_FEATURES)})"""


@register("a9_contingency", f"WITH {_CHI_CTE}\nSELECT feature, x, y, count FROM ct")
def a9_contingency(spark, sf_dir):
    return stats.contingency(_chi_src(spark, sf_dir), CHI_FEATURES, "label")


@register("a10_a11_chi_square", f"""WITH {_CHI_CTE},
xs AS (SELECT DISTINCT feature, x FROM ct), ys AS (SELECT DISTINCT feature, y FROM ct),
grid AS (SELECT xs.feature, xs.x, ys.y, coalesce(ct.count, 0) AS o
         FROM xs JOIN ys ON xs.feature = ys.feature LEFT JOIN ct ON ct.feature = xs.feature AND ct.x = xs.x AND ct.y = ys.y),
tot AS (SELECT feature, sum(o) AS n, count(DISTINCT x) AS r, count(DISTINCT y) AS k FROM grid GROUP BY feature),
rt AS (SELECT feature, x, sum(o) AS R FROM grid GROUP BY ALL), cts AS (SELECT feature, y, sum(o) AS C FROM grid GROUP BY ALL),
e AS (SELECT g.feature, g.o, CAST(rt.R AS DOUBLE) * cts.C / tot.n AS e, (tot.r - 1) * (tot.k - 1) AS dof
      FROM grid g JOIN rt USING (feature, x) JOIN cts USING (feature, y) JOIN tot USING (feature)),
chi AS (SELECT feature, sum(CASE WHEN dof = 1 THEN pow(abs(o - e) - least(0.5, abs(o - e)), 2) / e
                                 ELSE pow(o - e, 2) / e END) AS chi2, max(dof) AS dof FROM e GROUP BY feature)
SELECT c.feature, round(c.chi2, 6) AS chi2, CAST(c.dof AS BIGINT) AS dof,
       round(sqrt(c.chi2 / (t.n * (least(t.r, t.k) - 1))), 6) AS cramers_v, CAST(t.n AS BIGINT) AS n
FROM chi c JOIN tot t USING (feature) WHERE t.r >= 2 AND t.k >= 2""")
def a10_a11_chi_square(spark, sf_dir):
    c = stats.chi_square_stats(_chi_src(spark, sf_dir), CHI_FEATURES, "label")
    return c.select("feature", rnd("chi2").alias("chi2"), "dof", rnd("cramers_v").alias("cramers_v"), "n")


@register("a12_anova", f"""WITH {S.WORKS_CTE},
long AS ({S.unpivot_features("(SELECT * FROM feats WHERE split = 'train')", CORR_FEATURES)}),
g AS (SELECT feature, y, count(*) AS n, avg(x) AS mean, var_pop(x) AS var FROM long
      WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY feature, y HAVING count(*) > 1 AND var_pop(x) > 1e-10),
per AS (SELECT feature, count(*) AS k, sum(n) AS N, sum(n * mean) / sum(n) AS grand, sum(n * var) AS ssw
        FROM g GROUP BY feature HAVING count(*) >= 2),
ssb AS (SELECT g.feature, sum(g.n * pow(g.mean - p.grand, 2)) AS ssb FROM g JOIN per p USING (feature) GROUP BY g.feature)
SELECT feature, round((ssb / (k - 1)) / (ssw / (N - k)), 6) AS F, CAST(k - 1 AS BIGINT) AS df_between,
       CAST(N - k AS BIGINT) AS df_within
FROM per JOIN ssb USING (feature)""")
def a12_anova(spark, sf_dir):
    a = stats.anova_stats(_train(spark, sf_dir), CORR_FEATURES, "label")
    return a.select("feature", rnd("F").alias("F"), "df_between", "df_within")


@register("a14_label_diagnostics", f"""WITH {S.WORKS_CTE}
SELECT count(DISTINCT label) AS n_unique, count(DISTINCT label) <= 20 AS is_categorical, 'int' AS dtype
FROM feats WHERE split = 'train'""")
def a14_label_diagnostics(spark, sf_dir):
    return stats.label_diagnostics(_train(spark, sf_dir), "label")


@register("a15_class_counts", f"""WITH {S.WORKS_CTE},
c AS (SELECT label, count(*) AS count FROM feats WHERE split = 'train' AND label IS NOT NULL GROUP BY label)
SELECT label, count, count / (SELECT sum(count) FROM c) AS share,
       (SELECT sum(count) FILTER (WHERE label = 0) FROM c) / (SELECT sum(count) FILTER (WHERE label = 1) FROM c)
       AS imbalance_ratio
FROM c""")
def a15_class_counts(spark, sf_dir):
    return stats.class_counts(_train(spark, sf_dir), "label")


@register("a16_class_weights", f"""WITH {S.WORKS_CTE},
c AS (SELECT label, count(*) AS count FROM feats WHERE split = 'train' AND label IS NOT NULL GROUP BY label)
SELECT label, count, (SELECT sum(count) FROM c) / ((SELECT count(*) FROM c) * count) AS balanced_weight,
       CASE WHEN label = 1 THEN (SELECT sum(count) FILTER (WHERE label = 0) FROM c)
                                / (SELECT sum(count) FILTER (WHERE label = 1) FROM c) ELSE 1.0 END AS ratio_weight
FROM c""")
def a16_class_weights(spark, sf_dir):
    return stats.class_weights(_train(spark, sf_dir), "label")


# ================================================================== schema operators (P-series)
DUP_CANDIDATES = CORR_FEATURES + ["text_length"]


@register("p11_duplicate_columns", f"""WITH {S.WORKS_CTE}
SELECT 'text_length' AS column, 'n_chars' AS duplicate_of
WHERE (SELECT count(*) FROM documents WHERE abs(length(text) - n_chars) > 1e-8 + 1e-5 * abs(n_chars)) = 0""")
def p11_duplicate_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.length("text").alias("text_length"))
    full = _feats(spark, sf_dir).join(docs, "id")
    return SO.duplicate_columns(full, DUP_CANDIDATES)


@register("p12_binary_columns", f"""WITH {S.WORKS_CTE}
""" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column FROM feats WHERE split = 'train' HAVING count(*) FILTER (WHERE CAST({c} AS DOUBLE) NOT IN (0.0, 1.0)) = 0"
    for c in NUMERIC_TRAIN if c != "toxic"))
def p12_binary_columns(spark, sf_dir):
    return SO.binary_columns(_train(spark, sf_dir), [c for c in NUMERIC_TRAIN if c != "toxic"])


@register("p8_p9_model_ready", """
SELECT o_orderkey AS id, CAST(1 - CAST(coalesce(o_orderstatus = 'F', false) AS INTEGER) AS FLOAT) AS is_not_oa,
       CAST(o_totalprice AS FLOAT) AS venue_citations,
       CAST(coalesce((SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey), 0) AS FLOAT) AS num_authors
FROM orders o""")
def p8_p9_model_ready(spark, sf_dir):
    f = RC.order_feature_table(spark, sf_dir).select("id", "is_oa", "venue_citations", "num_authors")
    return SO.downcast_fill(SO.complement(f, "is_oa"), exclude=["id"]).select("id", "is_not_oa", "venue_citations",
                                                                          "num_authors")


# ================================================================== record-level functions
@register("f26_f35_clean_text", f"""WITH {S.WORKS_CTE},
c AS (SELECT id, title, abstract,
             CASE WHEN abstract IS NOT NULL AND abstract <> '' THEN coalesce(title, '') || '. ' || abstract
                  ELSE coalesce(title, '') END AS raw FROM works),
c2 AS (SELECT id, raw, regexp_replace(regexp_replace(raw, {S.q(S.WS + '+')}, ' ', 'g'),
                                     {S.q('[^' + S.WORD[1:-1] + S.WS[1:-1] + ".,!?;:'" + '"()-]')}, '', 'g') AS t FROM c)
SELECT id, CASE WHEN raw IS NULL OR raw = '' THEN '' ELSE trim(t) END AS embedding_text
FROM c2""")
def f26_f35_clean_text(spark, sf_dir):
    w = W.works(spark, sf_dir)
    return w.select("id", TX.embedding_text("title", "abstract").alias("embedding_text"))


@register("f36_work_id", """
SELECT page_id,
       CASE WHEN starts_with(url, 'W') AND length(url) > 1 AND NOT contains(url, '/') THEN url
            WHEN regexp_extract(url, 'W[0-9]+', 0) <> '' THEN regexp_extract(url, 'W[0-9]+', 0) ELSE url END AS from_url,
       'W' || CAST(page_id AS VARCHAR) AS from_bare,
       'W' || CAST(page_id AS VARCHAR) AS from_path
FROM pages""")
def f36_work_id(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", TX.work_id("url").alias("from_url"),
                    TX.work_id(F.concat(F.lit("W"), F.col("page_id").cast("string"))).alias("from_bare"),
                    TX.work_id(F.concat(F.col("url"), F.lit("/W"), F.col("page_id").cast("string"), F.lit("x")))
                    .alias("from_path"))


@register("f34_json_path", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events""")
def f34_json_path(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", NF.json_value("props", "$.k", "int").alias("k"), "event_type")


@register("f27_one_hot", f"""WITH {S.WORKS_CTE}
SELECT id, {", ".join(f"CAST(coalesce(language = '{v}', false) AS INTEGER) AS language_{v}" for v in ("de", "en", "es", "fr"))}
FROM feats""")
def f27_one_hot(spark, sf_dir):
    f = _feats(spark, sf_dir)
    vocab = encode.fit_vocabulary(f.where(F.col("split") == "train"), "language", null_label="unknown")
    return f.select("id", *encode.one_hot("language", vocab, null_label="unknown"))


# ================================================================== reports with p-values (rows-only checks)
@register("a8_correlation_report")
def a8_correlation_report(spark, sf_dir):
    return stats.correlation_report(_train(spark, sf_dir), CORR_FEATURES, "label")


@register("a10_chi_square_report")
def a10_chi_square_report(spark, sf_dir):
    return stats.chi_square_report(_chi_src(spark, sf_dir), CHI_FEATURES, "label")


@register("a12_anova_report")
def a12_anova_report(spark, sf_dir):
    return stats.anova_report(_train(spark, sf_dir), CORR_FEATURES, "label")


@register("a13_tukey_hsd")
def a13_tukey_hsd(spark, sf_dir):
    train = _train(spark, sf_dir)
    top = [r["feature"] for r in stats.anova_report(train, CORR_FEATURES, "label").limit(20).collect()]
    return stats.tukey_hsd(train, top, "label")


# ================================================================== sources and sinks (S-series)



def _scratch(spark, what: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


@register("s1_s3_jsonl_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def s1_s3_jsonl_roundtrip(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    path = _scratch(spark, "jsonl")
    FS.write_jsonl(ev, path)
    # one malformed line next to the good ones: the scan must drop it
    spark.createDataFrame([('{"event_id": 1, "ts": ',)], "value string").write.mode("append").text(path)
    return FS.read_jsonl(spark, path, ev.schema)


@register("s4_s5_union_align", f"""WITH {S.WORKS_CTE}, f2 AS (SELECT f.*, w.toxic FROM feats f JOIN works w USING (id))
SELECT id, label, toxic, n_chars, split FROM f2 WHERE split = 'train'
UNION ALL SELECT id, label, 0, n_chars, split FROM f2 WHERE split = 'val'
UNION ALL SELECT id, 0, toxic, n_chars, split FROM f2 WHERE split = 'test'""")
def s4_s5_union_align(spark, sf_dir):
    f = _feats_full(spark, sf_dir).select("id", "label", "toxic", "n_chars", "split")
    parts = [f.where(F.col("split") == "train"), f.where(F.col("split") == "val").drop("toxic"),
             f.where(F.col("split") == "test").drop("label")]
    return SO.union_aligned(parts, fill=0)


@register("s6_table_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in
    ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
     "embeddings", "pages", "benchmark", "labels", "conversations")))
def s6_table_counts(spark, sf_dir):
    from ..sources.tables import TABLES
    out = None
    for t in TABLES:
        c = table(spark, sf_dir, t).select(F.lit(t).alias("table_name")).groupBy("table_name") \
            .agg(F.count(F.lit(1)).alias("n_rows"))
        out = c if out is None else out.unionByName(c)
    return out


@register("s7_exact_sample", f"""
WITH d AS (SELECT doc_id, lang, row_number() OVER (ORDER BY {S.keys.seeded_key_sql('doc_id', 42)}, doc_id) - 1 AS pos
           FROM documents)
SELECT doc_id, lang FROM d WHERE pos < floor((SELECT count(*) FROM documents) * 0.1)""")
def s7_exact_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return folds.exact_sample(d, 0.1, "doc_id", 42)


@register("s13_stream_features", f"""WITH {S.WORKS_CTE}
SELECT id, type, language, title_length, abstract_length, has_abstract, title_word_count, abstract_word_count,
       nlp_char_count, nlp_word_count, nlp_avg_word_length, nlp_sentence_count, nlp_avg_sentence_length,
       nlp_capital_ratio, nlp_number_ratio, nlp_punctuation_ratio, n_chars FROM feats""")
def s13_stream_features(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    sink = _scratch(spark, "stream-sink")

    def to_features(docs: DataFrame) -> DataFrame:
        w = docs.select(F.col("doc_id").alias("id"), TX.first_line("text").alias("title"),
                        TX.after_first_line("text").alias("abstract"), F.col("lang").alias("language"),
                        F.col("source").alias("type"), "n_chars")
        return W.work_features(w.withColumn("label", F.lit(None).cast("int")).withColumn("split", F.lit(None)
                                                                                          .cast("string"))) \
            .drop("label", "split")

    ingest.ingest_available(spark, f"{sf_dir.rstrip('/')}/documents.parquet", schema, to_features, sink)
    return spark.read.parquet(sink)


# ================================================================== joins and vectors



def _emb(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


@register("j1_j3_join_embeddings", f"""WITH {S.WORKS_CTE}
SELECT w.id, w.label, e.embedding FROM works w JOIN labels l ON l.doc_id = w.id
LEFT JOIN embeddings e ON e.vec_id = w.id""")
def j1_j3_join_embeddings(spark, sf_dir):
    w = W.works(spark, sf_dir).select("id")
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    fam = {"sent": _emb(spark, sf_dir).select(F.col("vec_id").alias("id"), "embedding")}
    j = JN.attach_families(JN.attach_labels(w, lab), fam, check_unique=True)
    return j.select("id", "label", F.col("sent_embedding").alias("embedding"))


@register("v3_assemble", """
SELECT vec_id, list_concat([CAST(label AS DOUBLE), CAST(vec_id AS DOUBLE)], CAST(embedding AS DOUBLE[])) AS features
FROM embeddings""")
def v3_assemble(spark, sf_dir):
    e = _emb(spark, sf_dir)
    a = VC.assemble(e, ["label", "vec_id"], ["embedding"])
    return a.select("vec_id", _v2a("features").alias("features"))


_U_CTE = """u AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings),
st AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s FROM u GROUP BY dim)"""


@register("v6_scale_stats", f"""WITH {_U_CTE}
SELECT CAST(dim - 1 AS BIGINT) AS dim, round(m, 6) AS mean, round(s, 6) AS std FROM st""")
def v6_scale_stats(spark, sf_dir):
    m = VC.vector_moments(_emb(spark, sf_dir), "embedding")
    return m.select(F.col("dim").cast("long").alias("dim"), rnd("mean").alias("mean"), rnd("std").alias("std"))


@register("v6_scaled_embeddings", f"""WITH {_U_CTE}
SELECT vec_id, list(round((x - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 6) ORDER BY dim) AS scaled
FROM u JOIN st USING (dim) GROUP BY vec_id""")
def v6_scaled_embeddings(spark, sf_dir):
    e = _emb(spark, sf_dir)
    sc = VC.fit_array_scaler(e, "embedding")
    out = sc.transform(e, "embedding", "scaled")
    return out.select("vec_id", F.transform("scaled", lambda x: F.round(x, 6)).alias("scaled"))


def _sel_sql() -> str:
    cols = []
    for c in CORR_FEATURES:
        cols.append(f"""round(CASE WHEN (SELECT count(*) FILTER (WHERE CAST({c} AS DOUBLE) NOT IN (0.0, 1.0)) FROM tr) = 0
            THEN CAST({c} AS DOUBLE)
            ELSE (CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM tr))
                 / coalesce(nullif((SELECT stddev_pop({c}) FROM tr), 0), 1.0) END, 6) AS {c}""")
    return f"""WITH {S.WORKS_CTE}, tr AS (SELECT * FROM feats WHERE split = 'train')
SELECT id, {", ".join(cols)} FROM feats"""


@register("v7_selective_scale", _sel_sql())
def v7_selective_scale(spark, sf_dir):
    f = _feats(spark, sf_dir)
    train = f.where(F.col("split") == "train")
    (out,) = VC.selective_scale(train, [f.select("id", *CORR_FEATURES)], CORR_FEATURES)
    return out.select("id", *[rnd(F.col(c).cast("double")).alias(c) for c in CORR_FEATURES])


@register("v1_text_embedding")
def v1_text_embedding(spark, sf_dir):
    w = W.works(spark, sf_dir)
    t = w.select("id", "split", TX.embedding_text("title", "abstract").alias("text"))
    return VC.embed_text(t, "text", dim=64, fit_df=t.where(F.col("split") == "train")).select("id", "embedding")


@register("v4_v5_pca")
def v4_v5_pca(spark, sf_dir):
    e = _emb(spark, sf_dir)
    model = VC.fit_pca(e, "embedding", 8)
    ev = VC.explained_variance(model)
    out = VC.apply_pca(model, e, "embedding", "pca")
    return out.select("vec_id", "pca").withColumn("explained_variance_total", F.lit(float(sum(ev))))


# ================================================================== models (M1-M18, S12): rows-only checks
MODEL_FEATURES = CORR_FEATURES


def _model_frames(spark, sf_dir):
    f = _feats(spark, sf_dir).where(F.col("label").isNotNull())
    f = f.withColumn("label", F.col("label").cast("double"))
    va = _VA(inputCols=MODEL_FEATURES, outputCol="raw")
    train = va.transform(f.where(F.col("split") == "train"))
    hold = va.transform(f.where(F.col("split") != "train"))
    scaler = _StdScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(train)
    train = scaler.transform(train)
    hold = scaler.transform(hold)
    folds_ = folds.stratified_folds(train.select("id", "label"), "label", 5, "id", 42)
    # iterative fitting re-reads its input many times: cut the lineage into the shared checkpoint folder
    train = cut_lineage(train.join(folds_.select("id", "fold"), "id").select("id", "label", "raw", "features",
                                                                               "fold"))
    hold = cut_lineage(hold.select("id", "label", "features"))
    return train, hold


def _model_query(kind: str, **params):
    def q(spark, sf_dir):
        train, hold = _model_frames(spark, sf_dir)
        s = MD.fit_and_score(kind, train, hold, n_features=len(MODEL_FEATURES), **params)
        return s.select("id", F.lit(kind).alias("model"), "p")
    return q


for _name, _kind, _params in (("m1_gbt_scores", "gbt", {"maxIter": 20, "maxDepth": 3}),
                              ("m2_random_forest_scores", "random_forest", {"numTrees": 30}),
                              ("m2_bagging_scores", "bagging", {"numTrees": 10}),
                              ("m3_decision_tree_scores", "decision_tree", {}),
                              ("m4_logistic_scores", "logistic", {}),
                              ("m5_linear_svc_scores", "linear_svc", {}),
                              ("m6_naive_bayes_scores", "gaussian_nb", {}),
                              ("m7_mlp_scores", "mlp", {"maxIter": 50}),
                              ("m8_dummy_scores", "dummy", {})):
    register(_name)(_model_query(_kind, **_params))


register("m2_extra_trees_scores")(_model_query("extra_trees", numTrees=20, maxDepth=8))
register("m6_bernoulli_scores")(_model_query("bernoulli_nb"))


@register("m4_weighted_scores")
def m4_weighted_scores(spark, sf_dir):
    """M4 + A16: every class weighs the same in the loss."""
    train, hold = _model_frames(spark, sf_dir)
    weighted = stats.with_class_weight(train, "label", stats.class_weights(train, "label"), out="w")
    return MD.fit_and_score("logistic", weighted, hold, weight="w").select("id", F.lit("logistic").alias("model"), "p")


@register("m10_model_comparison")
def m10_model_comparison(spark, sf_dir):
    train, hold = _model_frames(spark, sf_dir)
    return MD.compare_models(["logistic", "decision_tree", "gaussian_nb", "dummy"], train, hold,
                             n_features=len(MODEL_FEATURES)).select("model", "f1", "roc_auc", "error")


def _with_folds(spark, sf_dir):
    """Train and validation rows together, with folds over both."""
    train, hold = _model_frames(spark, sf_dir)
    both = JN.union_splits([train.drop("fold", "raw"), hold])
    return cut_lineage(folds.stratified_folds(both, "label", 5, "id", 42))


@register("m11_cross_validation")
def m11_cross_validation(spark, sf_dir):
    """5-fold CV over the W5 folds with the scaler inside the pipeline (fitted per fold)."""
    train, _ = _model_frames(spark, sf_dir)
    lr = MD.estimator("logistic", features="scaled")
    pipe = MD.pipeline([_StdScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True), lr])
    grid = MD.param_grid(lr, {"regParam": [0.0, 0.1], "elasticNetParam": [0.0, 0.5]})
    _, metrics = MD.cross_validate(pipe, grid, train, "fold")
    return spark.createDataFrame([(i, m) for i, m in enumerate(metrics)], "param_set int, mean_f1 double")


@register("m11_m12_random_search")
def m11_m12_random_search(spark, sf_dir):
    """M11 + M12 + U1: a seeded third of the decision tree's search space over folds of train and validation rows."""
    return MD.random_search("decision_tree", _with_folds(spark, sf_dir), 3)


@register("m13_fold_loop")
def m13_fold_loop(spark, sf_dir):
    """M13 + A23: per-fold F1/threshold/AUC of a model, then their mean/std/best fold."""
    train, _ = _model_frames(spark, sf_dir)
    per_fold = MD.fold_loop("logistic", train, "fold", 5)
    return evaluate.cv_summary(per_fold.withColumn("model", F.lit("logistic")), "f1", ["model"])


@register("m1_early_stopping")
def m1_early_stopping(spark, sf_dir):
    """M1: losses of boosted trees after each tree, until the held-out loss stops falling."""
    train, hold = _model_frames(spark, sf_dir)
    _, history = MD.boosted_with_early_stop(train.select("id", "label", "features"), hold, maxIter=40, maxDepth=3)
    return history


@register("m13_training_passes")
def m13_training_passes(spark, sf_dir):
    """F1, threshold and AUC after each pass of a network that is trained until no pass is better."""
    train, hold = _model_frames(spark, sf_dir)
    _, history = MD.train_in_passes(train, hold, _scratch(spark, "passes"), len(MODEL_FEATURES), (16,), passes=8, patience=3, steps=10)
    return history


@register("m16_isotonic_calibration")
def m16_isotonic_calibration(spark, sf_dir):
    train, hold = _model_frames(spark, sf_dir)
    thirds = folds.stratified_folds(train.drop("fold"), "label", 3)
    return MD.isotonic_calibrated_scores("logistic", thirds, hold, "fold", 3)


@register("m16_calibrated_threshold")
def m16_calibrated_threshold(spark, sf_dir):
    """The threshold tuned again on the calibrated scores of the held-out rows."""
    train, hold = _model_frames(spark, sf_dir)
    thirds = folds.stratified_folds(train.drop("fold"), "label", 3)
    scores = MD.isotonic_calibrated_scores("logistic", thirds, hold, "fold", 3)
    return MD.calibrated_threshold(cut_lineage(scores.join(hold.select("id", "label"), "id")))


@register("m17_bundle_scoring")
def m17_bundle_scoring(spark, sf_dir):
    train, hold = _model_frames(spark, sf_dir)
    model = _Pipeline_fit(train)
    path = _scratch(spark, "bundle")
    MD.save_bundle(model, {"threshold": 0.5, "features": MODEL_FEATURES}, path)
    loaded, meta = MD.load_bundle(spark, path)
    s = MD.score_batch(loaded, hold, "features", len(meta["features"]), keep=["id"])
    return s.select("id", "p", (F.col("p") >= F.lit(meta["threshold"])).cast("int").alias("label"))


def _Pipeline_fit(train):
    return MD.pipeline([MD.estimator("logistic")]).fit(train)


# ================================================================== neighbours and resampling


def _emb_binary(spark, sf_dir):
    """Embeddings with a 0/1 label (class 0 against the rest: an imbalanced binary task)."""
    e = _emb(spark, sf_dir)
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"),
                    (F.col("label") == 0).cast("int").alias("label"))


@register("j5_knn_within_chunks", """WITH pairs AS (
SELECT a.vec_id AS id, b.vec_id AS neighbor_id, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d
          FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
ranked AS (SELECT id, neighbor_id, d, row_number() OVER (PARTITION BY id ORDER BY d, neighbor_id) AS rank FROM pairs)
SELECT CAST(id AS VARCHAR) AS id, CAST(neighbor_id AS VARCHAR) AS neighbor_id, CAST(rank AS INTEGER) AS rank,
       round(d, 5) AS distance
FROM ranked WHERE rank <= 5""")
def j5_knn_within_chunks(spark, sf_dir):
    """Neighbours over the whole table (the name is from when they were sought inside chunks)."""
    nb = RS.knn_table(_emb_binary(spark, sf_dir), 5)
    return nb.select(F.col("id").cast("string").alias("id"), F.col("neighbor_id").cast("string").alias("neighbor_id"), "rank",
                     rnd("distance", 5).alias("distance"))


_EMB_SPLIT_SQL = f"""eb AS (SELECT vec_id, embedding, CAST(label = 0 AS INTEGER) AS y FROM embeddings),
ep AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {S.keys.seeded_key_sql('vec_id', 42)}, vec_id) - 1 AS pos,
              count(*) OVER (PARTITION BY y) AS class_n FROM eb),
es AS (SELECT *, pos < floor(class_n * 0.2 + 0.5) AS is_test FROM ep)"""


@register("m9_knn_classifier", f"""WITH {_EMB_SPLIT_SQL},
pairs AS (SELECT q.vec_id AS id, b.y AS ny, list_distance(CAST(q.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d, b.vec_id AS nid
          FROM es q JOIN es b ON q.is_test AND NOT b.is_test),
top AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY id ORDER BY d, nid) <= 5)
SELECT CAST(id AS VARCHAR) AS id, avg(CAST(ny AS DOUBLE)) AS p, CAST(avg(CAST(ny AS DOUBLE)) > 0.5 AS DOUBLE) AS prediction
FROM top GROUP BY id""")
def m9_knn_classifier(spark, sf_dir):
    e = _emb_binary(spark, sf_dir)
    s = folds.stratified_split(e, "label", test_fraction=0.2, id_col="id", seed=42)
    train, test = s.where(~F.col("is_test")), s.where(F.col("is_test"))
    return RS.knn_classify(test, train, 5).withColumn("id", F.col("id").cast("string"))


@register("v9_v11_smote_enn")
def v9_v11_smote_enn(spark, sf_dir):
    return RS.resample(_emb_binary(spark, sf_dir), method="enn")


@register("v10_smote_tomek")
def v10_smote_tomek(spark, sf_dir):
    return RS.resample(_emb_binary(spark, sf_dir), method="tomek")


@register("v14_weighted_resample", f"""WITH eb AS (SELECT vec_id, CAST(label = 0 AS INTEGER) AS label FROM embeddings),
c AS (SELECT label, count(*) AS nc FROM eb GROUP BY label),
r AS (SELECT e.vec_id, e.label, ((SELECT count(*) FROM eb) / (SELECT count(*) FROM c)) / c.nc AS rate,
             CAST({S.keys.seeded_key_sql('e.vec_id', 42)} AS DOUBLE) / 2147483648.0 AS u
      FROM eb e JOIN c USING (label)),
k AS (SELECT vec_id, label, CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS INTEGER) AS copies
      FROM r)
SELECT vec_id AS id, label FROM k, range(copies) t(i)""")
def v14_weighted_resample(spark, sf_dir):
    e = _emb_binary(spark, sf_dir)
    return folds.weighted_resample(e, "label", id_col="id", seed=42).select("id", "label")


@register("a27_feature_importance")
def a27_feature_importance(spark, sf_dir):
    from ..operators import evaluate as EV
    train, _ = _model_frames(spark, sf_dir)
    model = MD.estimator("gbt", maxIter=20, maxDepth=3).fit(train)
    return EV.feature_importance(model, MODEL_FEATURES, spark, top=20)


@register("s9_s10_report_roundtrip", f"""WITH {S.WORKS_CTE},
c AS (SELECT label, count(*) AS count FROM feats WHERE split = 'train' AND label IS NOT NULL GROUP BY label)
SELECT label, count, (SELECT sum(count) FROM c) / ((SELECT count(*) FROM c) * count) AS balanced_weight,
       CASE WHEN label = 1 THEN (SELECT sum(count) FILTER (WHERE label = 0) FROM c)
                                / (SELECT sum(count) FILTER (WHERE label = 1) FROM c) ELSE 1.0 END AS ratio_weight,
       (SELECT count(*) FROM feats WHERE split = 'train') AS spec_rows
FROM c""")
def s9_s10_report_roundtrip(spark, sf_dir):
    """A report written as CSV (S9) and a spec written as JSON (S10), both read back."""
    train = _train(spark, sf_dir)
    rep = stats.class_weights(train, "label")
    path = _scratch(spark, "report")
    FS.write_report_csv(rep, f"{path}/class_weights")
    back = spark.read.option("header", True).schema(rep.schema).csv(f"{path}/class_weights")
    FS.write_spec(spark, {"rows": train.count()}, f"{path}/spec")
    rows = FS.read_spec(spark, f"{path}/spec")["rows"]
    return back.withColumn("spec_rows", F.lit(int(rows)).cast("long"))


# ================================================================== more than two groups (A12, A13 with 10 classes)
EMB_DIMS = 64   # every dimension


def _emb_dims(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return e.select(F.col("vec_id").alias("id"), "label",
                    *[F.col("embedding")[i].cast("double").alias(f"d{i}") for i in range(EMB_DIMS)])


@register("a12_anova_multigroup", f"""WITH long AS ({" UNION ALL ".join(
    f"SELECT 'd{i}' AS feature, CAST(embedding[{i + 1}] AS DOUBLE) AS x, CAST(label AS DOUBLE) AS y FROM embeddings"
    for i in range(EMB_DIMS))}),
g AS (SELECT feature, y, count(*) AS n, avg(x) AS mean, var_pop(x) AS var FROM long
      WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY feature, y HAVING count(*) > 1 AND var_pop(x) > 1e-10),
per AS (SELECT feature, count(*) AS k, sum(n) AS N, sum(n * mean) / sum(n) AS grand, sum(n * var) AS ssw
        FROM g GROUP BY feature HAVING count(*) >= 2),
ssb AS (SELECT g.feature, sum(g.n * pow(g.mean - p.grand, 2)) AS ssb FROM g JOIN per p USING (feature) GROUP BY g.feature)
SELECT feature, round((ssb / (k - 1)) / (ssw / (N - k)), 6) AS F, CAST(k - 1 AS BIGINT) AS df_between,
       CAST(N - k AS BIGINT) AS df_within
FROM per JOIN ssb USING (feature)""")
def a12_anova_multigroup(spark, sf_dir):
    a = stats.anova_stats(_emb_dims(spark, sf_dir), [f"d{i}" for i in range(EMB_DIMS)], "label")
    return a.select("feature", rnd("F").alias("F"), "df_between", "df_within")


@register("a13_tukey_multigroup")
def a13_tukey_multigroup(spark, sf_dir):
    return stats.tukey_hsd(_emb_dims(spark, sf_dir), [f"d{i}" for i in range(EMB_DIMS)], "label")


# ================================================================== nested records through JSON lines (S1 + F1-F21)
@register("f1_f21_nested_jsonl", """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
       CAST(year(l_shipdate) AS BIGINT) AS publication_year,
       coalesce(l_returnflag, 'unknown') AS type,
       CASE WHEN l_linestatus = 'O' THEN 'en' ELSE 'unknown' END AS language,
       CAST(2 AS BIGINT) AS num_authors,
       CAST(CASE WHEN l_returnflag = 'R' OR l_suppkey = l_partkey THEN 1 ELSE 2 END AS BIGINT) AS num_institutions,
       round(l_quantity, 6) AS first_author_h_index, round(l_extendedprice, 6) AS first_author_citations,
       round(CAST(l_linenumber AS DOUBLE), 6) AS first_author_papers,
       round(greatest(l_quantity, CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE l_tax * 100 END), 6) AS max_author_h_index,
       round((l_quantity + CASE WHEN l_linestatus = 'O' THEN 0.0 ELSE l_tax * 100 END) / 2, 6) AS avg_author_h_index,
       round(l_extendedprice + l_discount * 1000, 6) AS total_author_citations,
       round((l_extendedprice + l_discount * 1000) / 2, 6) AS avg_author_citations,
       CAST(1 AS BIGINT) AS num_authorships,
       round(l_extendedprice / 1000, 6) AS venue_impact_factor, round(CASE WHEN l_linestatus = 'F' THEN l_tax * 10 ELSE 0.0 END, 6) AS venue_h_index,
       round(l_quantity, 6) AS venue_citations,
       CAST(l_linestatus = 'O' AS INTEGER) AS is_oa_venue, CAST(l_returnflag = 'A' AS INTEGER) AS is_in_doaj,
       CAST(2 AS BIGINT) AS num_concepts, round(greatest(l_discount * 10, l_tax * 10), 6) AS max_concept_score,
       round((l_discount * 10 + l_tax * 10) / 2, 6) AS avg_concept_score,
       CAST(CAST(l_discount * 10 >= 0.5 AS INTEGER) + CAST(l_tax * 10 >= 0.5 AS INTEGER) AS BIGINT) AS num_high_concepts,
       CAST(l_returnflag = 'A' AS INTEGER) AS is_oa,
       CASE WHEN l_returnflag = 'A' THEN 'gold' WHEN l_returnflag = 'R' THEN 'bronze' ELSE 'closed' END AS oa_status,
       CAST(l_linenumber > 1 AND l_discount > 0.05 AS INTEGER) AS any_repository_has_fulltext,
       CAST(2 AS BIGINT) AS num_references, CAST(l_linestatus = 'O' AS BIGINT) AS num_related_works,
       CAST(l_linestatus = 'F' AS INTEGER) AS has_doi, CAST(l_returnflag = 'R' AS INTEGER) AS has_pmid, CAST(l_linestatus = 'O' AS INTEGER) AS has_pmcid,
       CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS BIGINT) AS num_grants,
       CAST(l_returnflag = 'R' AS INTEGER) AS has_grants,
       CAST(1 AS BIGINT) AS num_locations,
       CAST(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS BIGINT) AS num_topics,
       round(CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE l_tax * 5 END, 6) AS max_topic_score,
       round(CASE WHEN l_returnflag = 'N' THEN 0.0 ELSE l_tax * 5 END, 6) AS avg_topic_score,
       CAST(2 AS BIGINT) AS num_keywords, CAST(CASE WHEN l_returnflag = 'N' THEN 2 ELSE 0 END AS BIGINT) AS num_mesh_terms,
       CAST(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS BIGINT) AS num_sdgs,
       CAST(l_discount > 0.05 AS INTEGER) AS has_sdgs
FROM lineitem""")
def f1_f21_nested_jsonl(spark, sf_dir):
    rec = RC.line_records(spark, sf_dir)
    path = _scratch(spark, "records-jsonl")
    FS.write_jsonl(rec, path)                       # nested JSON lines, nulls omitted like absent keys
    back = FS.read_jsonl(spark, path, rec.schema)
    return _round_doubles(back.select("id", *NF.record_features(back.columns)))


@register("f37_synthetic_ids")
def f37_synthetic_ids(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark")
    return folds.synthetic_ids(b, "work_id", "W", 10).select("item_id", "work_id")


@register("f37_ordered_ids", """SELECT doc_id, 'W' || lpad(CAST(row_number() OVER (ORDER BY source NULLS FIRST, n_chars NULLS FIRST, doc_id) - 1 AS VARCHAR), 10, '0') AS work_id
FROM documents""")
def f37_ordered_ids(spark, sf_dir):
    """consecutive ids in the order of source, length and id."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return folds.synthetic_ids(d, "work_id", "W", 10, ["source", "n_chars", "doc_id"]).select("doc_id", "work_id")


# ================================================================== whole flows
@register("s8_model_ready", f"""WITH {S.WORKS_CTE},
f AS (SELECT w.id, w.split, w.language, w.title_length, l.toxic, w.n_chars FROM feats w LEFT JOIN labels l ON l.doc_id = w.id)
SELECT f.id, f.split, e.embedding AS sent_embedding, CAST(f.title_length AS FLOAT) AS title_length,
       CAST(coalesce(f.toxic, (SELECT median(toxic) FROM f WHERE split = 'train')) AS FLOAT) AS toxic, CAST(f.n_chars AS FLOAT) AS n_chars, f.language
FROM f LEFT JOIN embeddings e ON e.vec_id = f.id""")
def s8_model_ready(spark, sf_dir):
    """Model-ready splits written from a base with an all-null column and two
    embedding families, one of them without a test split, and read back."""
    base = _feats_full(spark, sf_dir).select("id", "title_length", "toxic", "n_chars", "language", F.lit(None).cast("double").alias("empty"), "split")
    splits = {s: base.where(F.col("split") == s).drop("split") for s in FS.SPLITS}
    root = _scratch(spark, "model-ready")
    vectors = _emb(spark, sf_dir).select(F.col("vec_id").alias("id"), "embedding").withColumn("split", W.split_of("id"))
    for family, have in (("sent", FS.SPLITS), ("lost", FS.SPLITS[:2])):
        for split in have:
            FS.write_parquet(vectors.where(F.col("split") == split).drop("split"), f"{root}/{family}_X_{split}.parquet")
    MR.build(spark, splits, root, f"{root}/out", buckets=8)
    return JN.union_splits([FS.load_split(spark, f"{root}/out", s).withColumn("split", F.lit(s)) for s in FS.SPLITS])


def _source_records(spark, sf_dir):
    """Suppliers as records with nested strings: a source whose keys differ from row to row, one key on the last row only."""
    s = table(spark, sf_dir, "supplier")
    last = s.agg(F.max("s_suppkey").alias("last"))
    rich = F.col("s_acctbal") > 0
    source = F.struct(
        F.concat(F.lit("S"), F.col("s_suppkey")).alias("id"), F.col("s_name").alias("display_name"), rich.alias("is_core"),
        F.when(rich, F.col("s_nationkey")).alias("works_count"), F.when(~rich, F.col("s_acctbal")).alias("apc_usd"),
        (F.col("s_suppkey") % 2 == 0).alias("is_scholarly"), F.when(F.col("s_suppkey") == last.scalar(), F.concat(F.lit("https://"), F.col("s_suppkey"))).alias("homepage"))
    place = F.struct(F.when(F.col("s_suppkey") % 5 != 0, source).alias("source"), F.lit("pdf").alias("pdf_url"))
    access = F.struct((F.col("s_suppkey") % 4 == 0).alias("any_repository_has_fulltext"))
    version = F.when(F.col("s_suppkey") % 3 == 0, "publishedVersion").when(F.col("s_suppkey") % 3 == 1, "acceptedVersion")
    return s.select(F.col("s_suppkey").alias("id"), F.to_json(place).alias("primary_location"), F.when(F.col("s_suppkey") % 7 != 0, F.to_json(access)).alias("open_access"), version.alias("version"), F.lit("cc").alias("license"))


@register("p14_p15_source_fields", """WITH m AS (SELECT max(s_suppkey) AS last FROM supplier), s AS (SELECT *, s_suppkey % 5 <> 0 AS has FROM supplier, m)
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 7 <> 0 AND s_suppkey % 4 = 0 THEN 1 ELSE 0 END AS any_repository_has_fulltext,
       CAST(s_suppkey % 3 = 1 AS INTEGER) AS "version_acceptedVersion", CAST(s_suppkey % 3 = 2 AS INTEGER) AS "version_noVersion", CAST(s_suppkey % 3 = 0 AS INTEGER) AS "version_publishedVersion",
       CASE WHEN has AND s_acctbal <= 0 THEN CAST(s_acctbal AS DOUBLE) END AS source_apc_usd,
       CASE WHEN has AND s_suppkey = last THEN 'https://' || s_suppkey END AS source_homepage,
       CASE WHEN has THEN CAST(s_suppkey % 2 = 0 AS DOUBLE) END AS source_is_scholarly,
       CASE WHEN has AND s_acctbal > 0 THEN CAST(s_nationkey AS DOUBLE) END AS source_works_count
FROM s""")
def p14_p15_source_fields(spark, sf_dir):
    """P14 + P15, F28, F29: the enabled steps in order; source keys are found in all rows, listed ones are left out."""
    rec = cut_lineage(_source_records(spark, sf_dir))
    flag = lambda d: d.withColumn("any_repository_has_fulltext", NF.fulltext_flag_from_string("open_access")).drop("open_access")
    versions = lambda d: encode.one_hot_encode(d, rec, "version", null_label="noVersion")
    fields = lambda d: SF.extract_fields(d, "primary_location")
    out = SO.compose(rec, [(True, flag), (True, versions), (True, fields), (False, lambda d: d.limit(0))])
    if "source_homepage" not in out.columns:               # the last supplier has no source in this table
        out = out.withColumn("source_homepage", F.lit(None).cast("string"))
    return out


@register("f28_sparse_one_hot", """WITH v AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS name FROM customer),
l AS (SELECT DISTINCT coalesce(name, 'unknown') AS name FROM v), i AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS index FROM l)
SELECT c_custkey AS id, CAST((SELECT count(*) + 1 FROM l) AS INTEGER) AS size, CAST(index AS INTEGER) AS index, CAST(1.0 AS DOUBLE) AS value
FROM v JOIN i ON i.name = coalesce(v.name, 'unknown')""")
def f28_sparse_one_hot(spark, sf_dir):
    """F27/F28 for an open vocabulary: customer names, null being a level."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("name"))
    model = encode.sparse_one_hot(c, "name", "name_at")
    return encode.sparse_pairs(encode.encode_sparse(model, c, "name", "name_at").select("id", "name_at"), "name_at")


@register("v4_fold_moments", """WITH u AS (SELECT vec_id % 5 AS fold, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings),
f AS (SELECT DISTINCT fold FROM u)
SELECT CAST(f.fold AS INTEGER) AS fold, CAST(u.dim AS INTEGER) AS dim, count(*) AS n, round(avg(x), 6) AS mean, round(var_samp(x), 6) AS var
FROM f JOIN u ON u.fold <> f.fold GROUP BY ALL""")
def v4_fold_moments(spark, sf_dir):
    """V4 + V15: per fold, the moments of the other folds' embeddings, by subtraction from those of all rows."""
    e = _emb(spark, sf_dir).withColumn("fold", F.col("vec_id") % 5)
    shift, moments = VC.fold_moments(e, "embedding")
    rows = [(fold, dim, n, float(shift[dim] + s[dim] / n), float((c[dim, dim] - s[dim] ** 2 / n) / (n - 1)))
            for fold, (n, s, c) in VC.outside_moments(moments).items() if fold is not None for dim in range(len(shift))]
    return spark.createDataFrame(rows, "fold int, dim int, n long, mean double, var double").withColumn("mean", rnd("mean")).withColumn("var", rnd("var"))


@register("v15_fold_pca")
def v15_fold_pca(spark, sf_dir):
    """Each embedding projected by the PCA of the folds that it is not in, with that fold's share of variance."""
    e = _emb(spark, sf_dir).withColumn("fold", (F.col("vec_id") % 5).cast("int"))
    model = VC.fold_pca(e, {"embedding": 8})["embedding"]
    kept = {fold: float(v.sum()) for fold, v in model.explained.items() if fold is not None}
    share = F.coalesce(*[F.when(F.col("fold") == k, F.lit(v)) for k, v in kept.items()])
    return model.transform(e.select("vec_id", "fold", "embedding"), "pca").select("vec_id", "fold", "pca", share.alias("explained"))


@register("v14_draw_with_replacement")
def v14_draw_with_replacement(spark, sf_dir):
    """As many draws as rows, with replacement, every class alike."""
    return folds.draw_with_replacement(_emb_binary(spark, sf_dir), "label").select("id", "label")


@register("n8_n9_submission_files", f"""WITH {S.scores_cte().strip()},
b AS (SELECT unnest(['aggressive', 'conservative', 'prob_mean', 'round_down', 'round_up']) AS tie_breaker),
r AS (SELECT tie_breaker, CAST(CASE WHEN p > 0.5 OR (p = 0.5 AND tie_breaker IN ('aggressive', 'prob_mean', 'round_up')) THEN 1 ELSE 0 END AS INTEGER) AS label FROM scores, b)
SELECT tie_breaker, label, count(*) AS count, count(*) / sum(count(*)) OVER (PARTITION BY tie_breaker) AS share FROM r GROUP BY tie_breaker, label""")
def n8_n9_submission_files(spark, sf_dir):
    """Every score as a submission row, written as CSV by each tie breaker, read back and counted."""
    scores = _scores(spark, sf_dir).withColumn("id", F.concat(F.lit("W"), F.col("id").cast("string")))
    out = None
    for breaker in sorted(ensemble.TIE_BREAKERS):
        path = _scratch(spark, f"submission-{breaker}")
        FS.write_csv(ensemble.submission(scores, 0.5, breaker), path)
        back = spark.read.schema("work_id string, label int").option("header", True).csv(path)
        part = ensemble.submission_summary(back).withColumn("tie_breaker", F.lit(breaker))
        out = part if out is None else out.unionByName(part)
    return out.select("tie_breaker", "label", "count", "share")


@register("s2_s4_s11_files", """SELECT doc_id, lang, n_chars, NULL::INTEGER AS quality, FALSE AS labelled FROM documents
UNION ALL SELECT doc_id, NULL, NULL, quality, TRUE FROM labels""")
def s2_s4_s11_files(spark, sf_dir):
    """JSON lines read by the schema inferred from all of them, united with labels keyed by id."""
    at = _scratch(spark, "inferred")
    FS.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), f"{at}/docs")
    docs = FS.read_jsonl(spark, f"{at}/docs").withColumn("labelled", F.lit(False))
    FS.write_labels(table(spark, sf_dir, "labels"), f"{at}/labels", "doc_id", "quality")
    both = FS.union_by_name([docs, FS.read_labels(spark, f"{at}/labels").withColumn("labelled", F.lit(True))])
    quality = dict(table(spark, sf_dir, "labels").dtypes)["quality"]
    chars = dict(table(spark, sf_dir, "documents").dtypes)["n_chars"]
    return both.select("doc_id", "lang", F.col("n_chars").cast(chars).alias("n_chars"), F.col("quality").cast(quality).alias("quality"), "labelled")


@register("f30_f33_strings", """SELECT o_orderkey AS id, 2025 - year(o_orderdate) AS num_years_after_publication,
       CASE WHEN o_orderkey % 7 <> 0 THEN CAST(trunc((epoch_us(TIMESTAMP '2025-01-01') - epoch_us(CAST(o_orderdate AS TIMESTAMP))) / 86400000000.0) AS BIGINT) END AS days_since_updated,
       CASE WHEN o_orderkey % 5 <> 0 THEN CAST(trunc((epoch_us(TIMESTAMP '2025-01-01') - epoch_us(date_trunc('day', CAST(o_orderdate AS TIMESTAMP)))) / 86400000000.0) AS BIGINT) END AS days_since_publication,
       CAST(CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 3 = 1 THEN 0 ELSE 1 END AS BIGINT) AS num_related_words
FROM orders""")
def f30_f33_strings(spark, sf_dir):
    """years, dates and list lengths from strings, some of them malformed."""
    o = table(spark, sf_dir, "orders")
    words = F.when(F.col("o_orderkey") % 3 == 0, F.lit('["a", {"b": 1}]')).when(F.col("o_orderkey") % 3 == 1, F.lit("no list [")).otherwise(F.lit("[null]"))
    when = F.col("o_orderdate").cast("timestamp_ntz")
    raw = o.select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("publication_year"), words.alias("words"),
                   F.when(F.col("o_orderkey") % 7 == 0, F.lit("yesterday")).otherwise(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("updated_date"),
                   F.when(F.col("o_orderkey") % 5 == 0, F.lit("2025-13-40")).otherwise(F.date_format(when, "yyyy-MM-dd")).alias("publication_date"))
    return raw.select("id", DT.years_after("publication_year", RC.AS_OF.year), *DT.date_features("updated_date", "publication_date", RC.AS_OF), NF.json_list_length("words").alias("num_related_words"))


@register("a14_label_codes", """WITH l AS (SELECT source, row_number() OVER (ORDER BY source) - 1 AS code FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL))
SELECT doc_id, CAST(coalesce(code, (SELECT count(*) FROM l)) AS DOUBLE) AS code FROM documents LEFT JOIN l USING (source)""")
def a14_label_codes(spark, sf_dir):
    """Codes of a label that is no number, in order of its values; without one the code after the last."""
    return stats.label_codes(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "code").select("doc_id", "code")


@register("l1_l2_longest", """SELECT CAST(row_number() OVER (ORDER BY n_chars DESC, doc_id) AS INTEGER) AS place, doc_id, n_chars FROM documents QUALIFY place <= 20""")
def l1_l2_longest(spark, sf_dir):
    """L1 + L2: the twenty longest documents in order, the place being that in the returned order."""
    top = table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id").limit(20)
    rows = [(k, *r) for k, r in enumerate(top.collect(), 1)]
    return spark.createDataFrame(rows, f"place int, doc_id {dict(top.dtypes)['doc_id']}, n_chars {dict(top.dtypes)['n_chars']}")
