"""Vector features (V1-V7): text embeddings, assembly, PCA, scaling.

Embeddings are one ``array<float>`` (or ML vector) column per family, never
hundreds of scalar columns. Moments per dimension come from one
``Summarizer`` pass (a tree aggregate), and scaling is an array expression
with the fitted means/stds as literals (bounded by the dimension).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, HashingTF, IDF, Normalizer, RegexTokenizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- V1/V2 text → embedding
def embed_text(df: DataFrame, text_col: str, out: str = "embedding", dim: int = 64,
               model_fn: Callable[[], Callable[[np.ndarray], np.ndarray]] | None = None,
               batch_size: int = 64, fit_df: DataFrame | None = None) -> DataFrame:
    """V1: text → fixed-size ``array<float>``.

    With ``model_fn`` (returns a batch function: array of strings → 2-D array
    of ``dim`` columns, e.g. a transformer with masked mean pooling, V2), the
    model runs inside Arrow-batched tasks via ``predict_batch_udf``. Without
    it, a built-in model: tokens → hashed term counts (``dim`` buckets) →
    IDF fitted on ``fit_df`` (default: ``df``) → L2 normalisation.
    """
    if model_fn is not None:
        from pyspark.ml.functions import predict_batch_udf
        udf = predict_batch_udf(model_fn, return_type=T.ArrayType(T.FloatType()), batch_size=batch_size)
        return df.withColumn(out, udf(F.coalesce(F.col(text_col), F.lit(""))))
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern=r"(?U)\W+", toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=dim),
        IDF(inputCol="__tf", outputCol="__idf"),
        Normalizer(inputCol="__idf", outputCol="__vec", p=2.0),
    ])
    src = df.withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    model = pipe.fit((fit_df if fit_df is not None else df).withColumn(text_col,
                                                                      F.coalesce(F.col(text_col), F.lit(""))))
    res = model.transform(src)
    return res.withColumn(out, vector_to_array("__vec", "float32")).drop("__tok", "__tf", "__idf", "__vec")


def mean_pool(token_vectors: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """V2: masked mean of token vectors (batch, tokens, dim) → (batch, dim); padding ignored."""
    m = mask[..., None].astype(token_vectors.dtype)
    return (token_vectors * m).sum(axis=1) / np.maximum(m.sum(axis=1), 1.0)


# ---------------------------------------------------------------- V3 assemble
def to_vector(col: str) -> Column:
    return array_to_vector(F.col(col))


def assemble(df: DataFrame, numeric: Sequence[str], vectors: Sequence[str] = (), out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """V3: numeric columns + embedding arrays → one ML vector."""
    tmp = df
    names = list(numeric)
    for v in vectors:
        tmp = tmp.withColumn(f"__v_{v}", to_vector(v))
        names.append(f"__v_{v}")
    va = VectorAssembler(inputCols=names, outputCol=out, handleInvalid=handle_invalid)
    return va.transform(tmp).drop(*[f"__v_{v}" for v in vectors])


# ---------------------------------------------------------------- V4/V5 PCA
def fit_pca(train: DataFrame, col: str, k: int, sample_fraction: float | None = None,
            seed: int = 42) -> PipelineModel:
    """V4: centre (MLlib PCA does not) then project on the top-k components.

    Fitted on all training rows by default; ``sample_fraction`` keeps the
    reference's sub-sampled fit as an option.
    """
    src = train.withColumn("__x", to_vector(col)) if isinstance(train.schema[col].dataType, T.ArrayType) \
        else train.withColumn("__x", F.col(col))
    if sample_fraction is not None:
        src = src.sample(False, sample_fraction, seed)
    pipe = Pipeline(stages=[StandardScaler(inputCol="__x", outputCol="__c", withMean=True, withStd=False),
                            PCA(k=k, inputCol="__c", outputCol="__pca")])
    return pipe.fit(src)


def apply_pca(model: PipelineModel, df: DataFrame, col: str, out: str) -> DataFrame:
    src = df.withColumn("__x", to_vector(col)) if isinstance(df.schema[col].dataType, T.ArrayType) \
        else df.withColumn("__x", F.col(col))
    return model.transform(src).withColumn(out, vector_to_array("__pca", "float32")).drop("__x", "__c", "__pca")


def explained_variance(model: PipelineModel) -> list[float]:
    """V5: explained-variance ratio of each kept component."""
    return [float(x) for x in model.stages[-1].explainedVariance.toArray()]


# ---------------------------------------------------------------- V4 / V15: PCA inside folds
_CROSS = "fold int, i int, n long, s double, row array<double>"


def fold_moments(df: DataFrame, col: str, fold_col: str = "fold") -> tuple[np.ndarray, dict[int, tuple[int, np.ndarray, np.ndarray]]]:
    """(shift, {fold: (n, sums, cross products)}) of an array column, of the values minus ``shift``, in one pass.

    ``shift`` is the rough mean (of a first pass), so that the products lose no digits. A task hands on a line a fold
    and dimension; what comes to the driver is folds x dimensions**2 numbers, whatever the rows.
    """
    x = df.select(F.col(fold_col).cast("int").alias("fold"), F.col(col).cast("array<double>").alias("x")).where("x is not null")
    shift = np.array([r["mean"] for r in vector_moments(x, "x").orderBy("dim").collect()], dtype=float)

    def partial(frames):
        held = {}
        for frame in frames:
            for fold, part in frame.groupby("fold"):
                v = np.stack(part["x"].to_numpy()) - shift
                n, s, c = held.get(fold, (0, 0.0, 0.0))
                held[fold] = (n + len(v), s + v.sum(axis=0), c + v.T @ v)
        for fold, (n, s, c) in held.items():
            yield pd.DataFrame({"fold": fold, "i": np.arange(len(s)), "n": n, "s": s, "row": list(c)})

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": rows["fold"].iloc[:1], "i": rows["i"].iloc[:1], "n": [rows["n"].sum()], "s": [rows["s"].sum()], "row": [np.sum(np.stack(rows["row"].to_numpy()), axis=0)]})
    lines = x.mapInPandas(partial, _CROSS).groupBy("fold", "i").applyInPandas(total, _CROSS).orderBy("fold", "i").toPandas()
    return shift, {int(k): (int(p["n"].iloc[0]), p["s"].to_numpy(), np.stack(p["row"].to_numpy())) for k, p in lines.groupby("fold")}


def outside_moments(moments: dict[int, tuple[int, np.ndarray, np.ndarray]]) -> dict[int | None, tuple[int, np.ndarray, np.ndarray]]:
    """Per fold, the moments of all other folds (the total minus the fold's); ``None``: of all rows."""
    whole = tuple(sum(m[k] for m in moments.values()) for k in range(3))
    return {None: whole, **{fold: tuple(w - p for w, p in zip(whole, m)) for fold, m in moments.items()}}


@dataclass
class FoldPca:
    """PCA of one column, a model a fold, fitted on the other folds; ``None`` is the model of all rows."""

    col: str
    mean: dict
    components: dict            # [k, dimensions], the largest entry of each positive
    explained: dict             # share of variance of each component

    def transform(self, df: DataFrame, out: str, fold_col: str | None = "fold") -> DataFrame:
        """``df`` with each row's projection by the model that its fold had no part in (all rows' without ``fold_col``)."""
        mean, components = self.mean, self.components

        @F.pandas_udf("array<float>")
        def project(x: pd.Series, fold: pd.Series) -> pd.Series:
            done = pd.Series([None] * len(x), dtype=object)
            known = np.flatnonzero(x.notna().to_numpy())
            at = fold.to_numpy()
            for k in set(at[known].tolist()):
                mine = known[at[known] == k]
                key = None if k < 0 else int(k)
                y = (np.stack(x.to_numpy()[mine]).astype(float) - mean[key]) @ components[key].T
                for i, row in zip(mine, y.astype(np.float32)):
                    done.iat[i] = row
            return done
        fold = F.col(fold_col).cast("int") if fold_col else F.lit(-1)
        return df.withColumn(out, project(F.col(self.col).cast("array<double>"), fold))


def fold_pca(df: DataFrame, families: dict[str, int], fold_col: str = "fold") -> dict[str, FoldPca]:
    """V4 + V15: for each array column its PCA to so many components in every fold, from one pass over the rows."""
    out = {}
    for col, k in families.items():
        shift, moments = fold_moments(df, col, fold_col)
        mean, components, explained = {}, {}, {}
        for fold, (n, s, c) in outside_moments(moments).items():
            centre = s / n
            cov = (c - n * np.outer(centre, centre)) / max(n - 1, 1)
            value, vector = np.linalg.eigh(cov)
            top = np.argsort(-value, kind="stable")[:k]
            axes = vector[:, top].T
            axes = axes * np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])[:, None]
            mean[fold], components[fold], explained[fold] = shift + centre, axes, value[top] / value.sum()
        out[col] = FoldPca(col, mean, components, explained)
    return out


# ---------------------------------------------------------------- V6/V7 scaling
@dataclass
class ArrayScaler:
    """Per-dimension (x − mean) / std with population std (zero std → 1)."""
    mean: list[float]
    std: list[float]

    def transform(self, df: DataFrame, col: str, out: str | None = None) -> DataFrame:
        mean = F.array(*[F.lit(float(m)) for m in self.mean])
        std = F.array(*[F.lit(float(s) if s > 0 else 1.0) for s in self.std])
        scaled = F.transform(F.col(col), lambda x, i: (x.cast("double") - F.element_at(mean, i + 1))
                             / F.element_at(std, i + 1))
        return df.withColumn(out or col, scaled)


def vector_moments(df: DataFrame, col: str) -> DataFrame:
    """Per-dimension count, mean and population std of an array column (one Summarizer pass)."""
    v = df.select(to_vector(col).alias("__v")) if isinstance(df.schema[col].dataType, T.ArrayType) \
        else df.select(F.col(col).alias("__v"))
    s = v.select(Summarizer.metrics("mean", "variance", "count").summary(F.col("__v")).alias("s"))
    row = s.select(vector_to_array("s.mean").alias("mean"), vector_to_array("s.variance").alias("var"),
                   F.col("s.count").alias("n"))
    # Summarizer's variance is the sample variance; population = sample · (n − 1) / n
    return row.select(F.posexplode(F.arrays_zip("mean", "var")).alias("dim", "z"), "n").select(
        "dim", F.col("z.mean").alias("mean"),
        F.sqrt(F.greatest(F.col("z.var") * (F.col("n") - 1) / F.col("n"), F.lit(0.0))).alias("std"))


def fit_array_scaler(train: DataFrame, col: str) -> ArrayScaler:
    """V6: fit on the training rows (all of them)."""
    rows = vector_moments(train, col).orderBy("dim").collect()   # one row per dimension
    return ArrayScaler([r["mean"] for r in rows], [r["std"] for r in rows])


def column_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per scalar column (one aggregation)."""
    row = df.agg(*[e for c in columns for e in (F.avg(c).alias(f"m|{c}"), F.stddev_pop(c).alias(f"s|{c}"))]).first()
    return {c: (row[f"m|{c}"], row[f"s|{c}"]) for c in columns}


def scale_columns(df: DataFrame, moments: dict[str, tuple[float, float]], columns: Sequence[str]) -> DataFrame:
    """V6/V7 apply: listed columns → (x − mean)/std (std 0 → 1); others untouched."""
    cols = []
    for c in df.columns:
        if c in columns:
            m, s = moments[c]
            s = s if s and s > 0 else 1.0
            cols.append(((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def selective_scale(train: DataFrame, frames: Sequence[DataFrame], columns: Sequence[str]) -> list[DataFrame]:
    """V7: scale only non-binary columns, statistics from ``train``."""
    from .schema import binary_columns
    binary = {r["column"] for r in binary_columns(train, columns).collect()}
    scaled = [c for c in columns if c not in binary]
    mom = column_moments(train, scaled)
    return [scale_columns(f, mom, scaled) for f in frames]
