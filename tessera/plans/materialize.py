"""Tables written once per session into the shared checkpoint folder.

Derived tables that several queries read (feature tables, score tables,
fitted model tables) are pipeline artefacts: they are computed once, written
as parquet next to the checkpoints, and read back — so later plans scan a
pruned columnar file instead of recomputing (and rescanning) their inputs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_WRITTEN: dict[tuple[str, str, str, str], str] = {}


def _state(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of the input's tables: a changed input gives another state."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return ";".join(sorted(f"{s.getPath().getName()}:{s.getLen()}:{s.getModificationTime()}" for s in fs.listStatus(at))) if fs.exists(at) else ""


def materialized(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame],
                 partition_by: tuple[str, ...] = ()) -> DataFrame:
    key = (spark.sparkContext.applicationId, name, sf_dir, _state(spark, sf_dir))
    if key not in _WRITTEN:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        w = build().write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])
