"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir


class Scratch:
    """A fresh folder under ``spark.checkpoint.dir`` for one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write and reread: cuts lineage, and a lost executor costs no recomputation."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete written tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for name in names:
            at = jvm.org.apache.hadoop.fs.Path(self.path(name))
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
