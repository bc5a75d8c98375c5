"""Joins of feature tables (J1-J4) and unions.

Every join is an equi-join on ``id``. Large sides are left to sort-merge
joins (AQE switches to broadcast at run time when a side turns out small;
that threshold is Spark's own size check). Id uniqueness is verified with
an aggregate, because a duplicated id would multiply rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_ids(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids that occur more than once (empty when the key is unique)."""
    return df.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, id_col: str = "id", what: str = "table") -> None:
    dup = duplicate_ids(df, id_col).limit(5).collect()
    if dup:
        raise ValueError(f"{what}: duplicate {id_col} values, e.g. {[r[id_col] for r in dup]}")


def attach_families(base: DataFrame, families: Mapping[str, DataFrame], id_col: str = "id",
                    emb_col: str = "embedding", check_unique: bool = False) -> DataFrame:
    """Left-join each family's ``(id, embedding)`` as column ``{family}_embedding``."""
    out = base
    for name, fam in families.items():
        if check_unique:
            assert_unique(fam, id_col, f"family {name}")
        out = out.join(fam.select(id_col, F.col(emb_col).alias(f"{name}_embedding")), id_col, "left")
    return out


def attach_labels(df: DataFrame, labels: DataFrame, id_col: str = "id", label: str = "label",
                  how: str = "inner", check_unique: bool = True) -> DataFrame:
    """Labels by id (never by row position)."""
    if check_unique:
        assert_unique(labels, id_col, "labels")
    return df.join(labels.select(id_col, label), id_col, how)


def union_splits(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name (train+val for CV; resampled + kept rows)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
