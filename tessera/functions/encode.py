"""One-hot encoding with a vocabulary fitted on the training split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEVELS = 1000   # a larger vocabulary is refused instead of exploding the schema


def fit_vocabulary(train: DataFrame, column: str, null_label: str | None = None,
                   max_levels: int = MAX_LEVELS) -> list[str]:
    """Distinct values of ``column`` on the training split (nulls → ``null_label`` if given), sorted.

    The distinct set is computed by Spark; at most ``max_levels + 1`` values
    ever reach the driver, and more than ``max_levels`` raises.
    """
    c = F.col(column).cast("string")
    if null_label is not None:
        c = F.coalesce(c, F.lit(null_label))
    vals = (train.select(c.alias("v")).where(F.col("v").isNotNull()).distinct()
            .limit(max_levels + 1).collect())
    if len(vals) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels; use sparse_one_hot")
    return sorted(r["v"] for r in vals)


def one_hot(column: str, vocabulary: Sequence[str], prefix: str | None = None, null_label: str | None = None,
            dtype: str = "int") -> list[Column]:
    """one ``{prefix}_{value}`` 0/1 column per vocabulary value (unknown values → all 0)."""
    c = F.col(column).cast("string")
    if null_label is not None:
        c = F.coalesce(c, F.lit(null_label))
    p = prefix or column
    return [F.coalesce(c == F.lit(v), F.lit(False)).cast(dtype).alias(f"{p}_{v}") for v in vocabulary]


def one_hot_encode(df: DataFrame, train: DataFrame, column: str, prefix: str | None = None,
                   null_label: str | None = None, drop: bool = True, dtype: str = "int") -> DataFrame:
    """Fit the vocabulary on ``train`` and apply it to ``df``."""
    vocab = fit_vocabulary(train, column, null_label)
    out = df.select("*", *one_hot(column, vocab, prefix, null_label, dtype))
    return out.drop(column) if drop else out


NULL_LEVEL = "unknown"


def sparse_one_hot(train: DataFrame, column: str, out: str, null_label: str = NULL_LEVEL) -> PipelineModel:
    """F27/F28 for an open vocabulary: a model whose ``transform`` adds the sparse vector ``out`` (apply with :func:`encode_sparse`).

    Levels are the values of ``train`` in alphabetic order, null counting as ``null_label``; one more place is for values
    that train does not have. A row holds one (index, 1.0), so a million levels cost no more columns than two.
    """
    rows = train.select(_level(column, null_label).alias(f"__{out}"))
    index = StringIndexer(inputCol=f"__{out}", outputCol=f"__{out}_at", stringOrderType="alphabetAsc", handleInvalid="keep")
    return Pipeline(stages=[index, OneHotEncoder(inputCol=f"__{out}_at", outputCol=out, dropLast=False, handleInvalid="error")]).fit(rows)


def _level(column: str, null_label: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(null_label))


def encode_sparse(model: PipelineModel, df: DataFrame, column: str, out: str, null_label: str = NULL_LEVEL) -> DataFrame:
    """``df`` with the sparse one-hot vector ``out`` of ``column``."""
    return model.transform(df.withColumn(f"__{out}", _level(column, null_label))).drop(f"__{out}", f"__{out}_at")


def sparse_pairs(df: DataFrame, vector: str) -> DataFrame:
    """``df`` with (index, value) of each entry of a sparse vector, and its ``size``, in place of the vector."""
    held = df.withColumn(vector, F.unwrap_udt(F.col(vector)))
    pairs = F.explode(F.arrays_zip(F.col(f"{vector}.indices").alias("index"), F.col(f"{vector}.values").alias("value")))
    rest = [c for c in df.columns if c != vector]
    return held.select(*rest, F.col(f"{vector}.size").alias("size"), pairs.alias("p")).select(*rest, "size", F.col("p.index").alias("index"), F.col("p.value").alias("value"))
