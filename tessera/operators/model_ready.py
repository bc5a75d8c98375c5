"""The model-ready tables (S3, S8, S14, J1, J2, P2-P6, P9, A4, A5) in one flow.

From a base table a split and the embedding families found beside them: columns that are all null in train go, medians
and modes of train are written as a spec and read back, every split is imputed by it, families that a split lacks are
left out, the others are joined by id, columns are put in order (ids, embeddings, numbers, categories) and narrowed to
float32, and each split is written once.

Base and families are written bucketed and sorted by id, with the same number of buckets: the joins of all families
then need no exchange, however many there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import discover_families, read_spec, write_parquet, write_spec
from . import schema, stats
from .join import assert_unique, attach_families


def bucketed(df: DataFrame, path: str, id_col: str = "id", buckets: int = 200) -> DataFrame:
    """``df`` written under ``path`` in buckets of ``id_col``, sorted by it, and read as such."""
    name = f"bucketed_{uuid.uuid4().hex}"
    df.write.mode("overwrite").format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(name)
    return df.sparkSession.table(name)


def joined_split(base: DataFrame, families: Mapping[str, DataFrame], id_col: str = "id", embedding: str = "embedding") -> DataFrame:
    """One split: families attached, columns in order, numbers as float32."""
    wide = attach_families(base, families, id_col, embedding)
    groups = schema.classify_columns(wide, [id_col], list(families))
    ordered = schema.select_available(wide, [*groups["id"], *groups["embedding"], *groups["numeric"], *groups["categorical"]])
    return schema.downcast_fill(ordered, exclude=[id_col])


def build(spark: SparkSession, base: Mapping[str, DataFrame], families_at: str, out: str, id_col: str = "id",
          embedding: str = "embedding", buckets: int = 200) -> tuple[list[str], dict[str, DataFrame]]:
    """Write ``{out}/{split}_model_ready`` for each split of ``base`` (the first one is train), and ``{out}/spec``.

    ``families_at`` holds ``{family}_X_{split}.parquet`` tables (id, embedding). Returns the families used and the plan
    of each split as it was written. Ids must be unique in every table.
    """
    splits = list(base)
    (train, *others), _ = schema.drop_all_null(base[splits[0]], [base[s] for s in splits[1:]], keep=[id_col])
    write_spec(spark, stats.fit_imputation(train, [id_col]), f"{out}/spec")
    spec = read_spec(spark, f"{out}/spec")
    used, plans = discover_families(spark, families_at, splits), {}
    for split, rows in zip(splits, [train, *others]):
        held = bucketed(stats.apply_imputation(rows, spec), f"{out}/work/{split}/base", id_col, buckets)
        assert_unique(held, id_col, split)
        found = {}
        for family in used:
            found[family] = bucketed(spark.read.parquet(f"{families_at}/{family}_X_{split}.parquet"), f"{out}/work/{split}/{family}", id_col, buckets)
            assert_unique(found[family], id_col, f"{family} of {split}")
        plans[split] = joined_split(held, found, id_col, embedding)
        write_parquet(plans[split], f"{out}/{split}_model_ready", mode="overwrite")
    return used, plans
