"""Neighbour joins, the neighbour classifier and synthetic resampling over whole tables.

Neighbours are exact at any size (:mod:`.neighbours`). Random choices are functions of ids and positions, so a
recomputed task returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import seeded_key, seeded_unit
from ..session import cut_lineage
from .folds import class_positions
from .join import union_splits
from .neighbours import CHUNK, exact_neighbours

# Fixed values of the reference's resampling.
SMOTE_K = 5
ENN_K = 3
BASE_SEED = 42
RATIO = 0.35

def adaptive_ratio(n_rows: int) -> float:
    """The reference's minority/majority ratio by the number of rows (pass it as ``ratio``)."""
    if n_rows > 100_000:
        return 0.15
    if n_rows > 50_000:
        return 0.25
    return RATIO


# ---------------------------------------------------------------- J5 / M9 neighbour joins
def _rows(df: DataFrame, features: str, id_col: str, label: str | None, asks: bool) -> DataFrame:
    y = F.col(label).cast("int") if label else F.lit(0)
    return df.select(F.col(id_col).alias("id"), y.alias("label"), F.lit(asks).alias("asks"), F.col(features).cast("array<double>").alias("f"))


def knn_table(df: DataFrame, k: int, features: str = "features", id_col: str = "id", label: str | None = None,
              chunk: int = CHUNK) -> DataFrame:
    """The k nearest other rows of every row: id, neighbor_id, rank, distance (+ neighbor_label)."""
    out = exact_neighbours(_rows(df, features, id_col, label, True), k, True, chunk=chunk)
    return out if label else out.drop("neighbor_label")


def knn_join(query: DataFrame, base: DataFrame, k: int, features: str = "features", id_col: str = "id",
             label: str | None = None, chunk: int = CHUNK) -> DataFrame:
    """The k nearest ``base`` rows of every ``query`` row: id, neighbor_id, rank, distance (+ neighbor_label)."""
    both = _rows(query, features, id_col, None, True).unionByName(_rows(base, features, id_col, label, False))
    out = exact_neighbours(both, k, False, chunk=chunk)
    return out if label else out.drop("neighbor_label")


def knn_classify(query: DataFrame, base: DataFrame, k: int = 5, features: str = "features", id_col: str = "id",
                 label: str = "label", chunk: int = CHUNK) -> DataFrame:
    """M9: share of positive neighbours as the score, majority vote as the prediction."""
    nb = knn_join(query, base, k, features, id_col, label, chunk)
    return nb.groupBy("id").agg(F.avg(F.col("neighbor_label").cast("double")).alias("p")) \
        .withColumn("prediction", (F.col("p") > 0.5).cast("double"))


# ---------------------------------------------------------------- V9-V13 resampling
def smote(df: DataFrame, ratio: float = RATIO, k: int = SMOTE_K, seed: int = BASE_SEED, chunk: int = CHUNK) -> DataFrame:
    """V9: synthetic rows (id, label, features) so that minority ≈ ratio · majority (none if already there).

    ``df`` holds id, label and features. Draw ``j`` of the missing rows picks, by seeded keys of ``j``, a row of the
    smaller class, one of its k nearest in that class, and a point on the way there. Ids are ``syn-{j}``.
    """
    spark = df.sparkSession
    counts = sorted((r["n"], r["label"]) for r in df.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect())
    schema = "id string, label int, features array<double>"
    missing = int(ratio * counts[-1][0]) - counts[0][0] if len(counts) == 2 else 0
    if missing <= 0 or counts[0][0] < 2:
        return spark.createDataFrame([], schema)
    (n_min, minority) = counts[0]
    small = cut_lineage(class_positions(df.where(F.col("label") == minority), None, "id", seed).select("id", "pos", "features"))
    near = knn_table(small, k, chunk=chunk).select("id", "neighbor_id", "rank")
    wide = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"))
    draws = spark.range(missing).select(F.col("id").alias("j"), F.pmod(seeded_key("id", seed), F.lit(n_min)).alias("pos"))
    draws = draws.join(small, "pos").join(wide, "id").withColumn("rank", 1 + F.pmod(seeded_key("j", seed + 1), F.col("n_near")))
    draws = draws.join(near, ["id", "rank"]).join(small.select(F.col("id").alias("neighbor_id"), F.col("features").alias("far")), "neighbor_id")
    step = seeded_unit("j", seed + 2)
    point = F.zip_with("features", "far", lambda a, b: a + F.col("step") * (b - a))
    return draws.withColumn("step", step).select(F.concat(F.lit("syn-"), F.col("j")).alias("id"), F.lit(minority).cast("int").alias("label"), point.alias("features"))


def enn(df: DataFrame, k: int = ENN_K, chunk: int = CHUNK) -> DataFrame:
    """Rows whose k nearest neighbours all share their class (all classes cleaned); a row without any stays."""
    near = knn_table(df, k, label="label", chunk=chunk)
    around = near.groupBy("id").agg(F.min("neighbor_label").alias("__least"), F.max("neighbor_label").alias("__most"))
    kept = df.join(around, "id", "left").where("__least is null or (__least = label and __most = label)")
    return kept.drop("__least", "__most")


def tomek(df: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Without both rows of every Tomek link (mutual nearest neighbours of different classes)."""
    near = cut_lineage(knn_table(df, 1, label="label", chunk=chunk).select("id", "neighbor_id", "neighbor_label"))
    mutual = near.join(near.select(F.col("id").alias("neighbor_id"), F.col("neighbor_id").alias("id"), F.col("neighbor_label").alias("own")), ["id", "neighbor_id"])
    return df.join(mutual.where("own <> neighbor_label").select("id"), "id", "left_anti")


def resample(train: DataFrame, features: str = "features", label: str = "label", id_col: str = "id", method: str = "enn",
             ratio: float = RATIO, seed: int = BASE_SEED, chunk: int = CHUNK) -> DataFrame:
    """V9-V13 + U2: SMOTE to ``ratio`` over all rows, then ENN or Tomek links (``method``) over all rows.

    Output: id (string), label, features, synthetic. A table of a single class is returned untouched.
    """
    if method not in ("enn", "tomek", "none"):
        raise ValueError(method)
    rows = train.select(F.col(id_col).cast("string").alias("id"), F.col(label).cast("int").alias("label"), F.col(features).cast("array<double>").alias("features"))
    new = smote(rows, ratio, seed=seed, chunk=chunk)
    every = cut_lineage(union_splits([rows.withColumn("synthetic", F.lit(False)), new.withColumn("synthetic", F.lit(True))]))
    if method == "none":
        return every
    return enn(every, chunk=chunk) if method == "enn" else tomek(every, chunk)
