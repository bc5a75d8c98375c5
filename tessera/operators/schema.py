"""Column-level operators (P2-P15): drops, classification, alignment, casts, duplicates.

Decisions that depend on data (all-null, binary, duplicate columns) are one
aggregation pass each; the decision itself is a list of column names
(bounded by the schema) applied as a projection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import NUMERIC_TYPES, all_null_columns

# Closeness used by the duplicate-column test.
DUP_RTOL = 1e-5
DUP_ATOL = 1e-8


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


# ---------------------------------------------------------------- P2
def drop_all_null(train: DataFrame, others: Sequence[DataFrame] = (), keep: Sequence[str] = ("id",)):
    """Columns entirely null in ``train`` are dropped from train and every other split."""
    cols = [c for c in train.columns if c not in keep]
    dead = [r["column"] for r in all_null_columns(train, cols).collect()]
    out = [train.drop(*dead)] + [o.drop(*[c for c in dead if c in o.columns]) for o in others]
    return out, dead


# ---------------------------------------------------------------- P3-P6
def classify_columns(df: DataFrame, id_cols: Sequence[str] = ("id",),
                     embedding_prefixes: Sequence[str] = ()) -> dict[str, list[str]]:
    """Id / embedding / numeric / categorical column lists (from the schema only)."""
    out = {"id": [], "embedding": [], "numeric": [], "categorical": []}
    for f in df.schema.fields:
        if f.name in id_cols or f.name.lower() == "id":
            out["id"].append(f.name)
        elif any(f.name.startswith(p) for p in embedding_prefixes) or isinstance(f.dataType, T.ArrayType) \
                or f.dataType.typeName() == "vector":
            out["embedding"].append(f.name)
        elif isinstance(f.dataType, NUMERIC_TYPES) or isinstance(f.dataType, T.BooleanType):
            out["numeric"].append(f.name)
        else:
            out["categorical"].append(f.name)
    return out


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order, without duplicates."""
    seen, cols = set(), []
    for c in wanted:
        if c in df.columns and c not in seen:
            seen.add(c)
            cols.append(c)
    return df.select(*[_q(c) for c in cols])


def feature_set(df: DataFrame, groups: Mapping[str, Sequence[str]], use: Sequence[str]) -> DataFrame:
    """Project the regular features plus the chosen families (e.g. ``["regular", "specter2"]``)."""
    wanted: list[str] = []
    for g in use:
        wanted += list(groups.get(g, []))
    return select_available(df, wanted)


# ---------------------------------------------------------------- P7-P9
def align_to(df: DataFrame, reference: T.StructType | DataFrame, fill=0) -> DataFrame:
    """Add missing reference columns as ``fill`` cast to the reference type,
    drop extra columns, follow the reference order; existing nulls stay null."""
    schema = reference.schema if isinstance(reference, DataFrame) else reference
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(_q(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(fill).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def union_aligned(frames: Sequence[DataFrame], fill=0) -> DataFrame:
    """Union with the sorted union of all columns; a column missing from a frame is
    ``fill`` cast to the first-seen type."""
    types: dict[str, T.DataType] = {}
    for fr in frames:
        for f in fr.schema.fields:
            types.setdefault(f.name, f.dataType)
    schema = T.StructType([T.StructField(n, types[n]) for n in sorted(types)])
    out = None
    for fr in frames:
        a = align_to(fr, schema, fill)
        out = a if out is None else out.unionByName(a)
    return out


def complement(df: DataFrame, column: str, new: str | None = None) -> DataFrame:
    """``new = 1 - column`` and the source column dropped."""
    new = new or f"is_not_{column[3:]}" if column.startswith("is_") else (new or f"not_{column}")
    return df.withColumn(new, 1 - _q(column)).drop(column)


def downcast_fill(df: DataFrame, exclude: Sequence[str] = ("id",), fill: float = 0.0) -> DataFrame:
    """Every numeric column → float32 with nulls filled."""
    cols = []
    for f in df.schema.fields:
        if f.name not in exclude and isinstance(f.dataType, NUMERIC_TYPES):
            cols.append(F.coalesce(_q(f.name).cast("float"), F.lit(fill).cast("float")).alias(f.name))
        else:
            cols.append(_q(f.name))
    return df.select(*cols)


# ---------------------------------------------------------------- P11
def duplicate_columns(df: DataFrame, columns: Sequence[str], rtol: float = DUP_RTOL,
                      atol: float = DUP_ATOL) -> DataFrame:
    """Columns that repeat an earlier column within ``|a − b| ≤ atol + rtol·|b|`` on every row.

    The first column of a group stands for it: column j belongs to the first column i < j that it is
    close to and that belongs to no other. Pass 1 aggregates a
    signature per column (count, min, max, sum, max |x|); only pairs whose
    signatures allow closeness are verified, in one more pass.
    Output: column, duplicate_of.
    """
    spark = df.sparkSession
    cols = list(columns)
    if len(cols) < 2:
        return spark.createDataFrame([], "column string, duplicate_of string")
    sig = df.agg(*[e for c in cols for e in (
        F.count(_q(c)).alias(f"n|{c}"), F.min(_q(c).cast("double")).alias(f"lo|{c}"),
        F.max(_q(c).cast("double")).alias(f"hi|{c}"), F.sum(_q(c).cast("double")).alias(f"s|{c}"),
        F.max(F.abs(_q(c).cast("double"))).alias(f"m|{c}"))]).first().asDict()
    total = df.count()
    n = np.array([sig[f"n|{c}"] for c in cols], dtype=float)
    lo = np.array([np.nan if sig[f"lo|{c}"] is None else sig[f"lo|{c}"] for c in cols])
    hi = np.array([np.nan if sig[f"hi|{c}"] is None else sig[f"hi|{c}"] for c in cols])
    s = np.array([np.nan if sig[f"s|{c}"] is None else sig[f"s|{c}"] for c in cols])
    m = np.array([np.nan if sig[f"m|{c}"] is None else sig[f"m|{c}"] for c in cols])
    # necessary conditions for closeness on every row, checked for all pairs at once
    full = (n == total)
    tol = atol + rtol * m[None, :]                                     # tolerance uses |b| = column j
    ok = (np.abs(lo[:, None] - lo[None, :]) <= tol) & (np.abs(hi[:, None] - hi[None, :]) <= tol) \
        & (np.abs(s[:, None] - s[None, :]) <= total * tol) & full[:, None] & full[None, :]
    ok = np.triu(np.nan_to_num(ok, nan=False).astype(bool), k=1)
    cand = [(int(i), int(j)) for i, j in zip(*np.nonzero(ok))]
    close: set[tuple[int, int]] = set()
    if cand:
        checks = df.agg(*[F.max(F.abs(_q(cols[i]).cast("double") - _q(cols[j]).cast("double"))
                                - (F.lit(atol) + F.lit(rtol) * F.abs(_q(cols[j]).cast("double"))))
                          .alias(f"c{k}") for k, (i, j) in enumerate(cand)]).first()
        close = {cand[k] for k in range(len(cand)) if checks[f"c{k}"] is not None and checks[f"c{k}"] <= 0}
    # pairs in order: the first representative that is none's duplicate itself keeps the column
    first: dict[int, int] = {}
    for i, j in sorted(close):
        if i not in first:
            first.setdefault(j, i)
    return spark.createDataFrame([(cols[j], cols[i]) for j, i in sorted(first.items())], "column string, duplicate_of string")


# ---------------------------------------------------------------- P12
def binary_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric columns whose non-null values are all 0 or 1 → (column)."""
    row = df.agg(*[F.count_if(~_q(c).cast("double").isin(0.0, 1.0)).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "others").where(F.col("others") == 0).select("column")


# ---------------------------------------------------------------- P14-P15
def extract_struct(df: DataFrame, struct_col: str, prefix: str, drop: Sequence[str] = ()) -> DataFrame:
    """Every field of ``struct_col`` as ``{prefix}{field}``, minus ``drop``, struct removed."""
    st = df.schema[struct_col].dataType
    fields = [f.name for f in st.fields if f"{prefix}{f.name}" not in drop and f.name not in drop]
    return df.select(*[_q(c) for c in df.columns if c != struct_col],
                     *[_q(struct_col).getField(f).alias(f"{prefix}{f}") for f in fields])


def compose(df: DataFrame, steps: Sequence[tuple[bool, Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Apply the enabled steps in order (``df.transform`` chain)."""
    for enabled, fn in steps:
        if enabled:
            df = df.transform(fn)
    return df
