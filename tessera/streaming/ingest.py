"""Incremental, exactly-once feature extraction with Structured Streaming.

New files in a landing folder are picked up by a file stream source,
turned into features by the same native expressions as the batch path, and
appended to a parquet sink. The checkpoint (in the shared checkpoint
folder) records which files were processed, so a restart — or a lost
executor — neither skips nor repeats a file. ``availableNow`` processes
everything present and stops, which replaces a hand-written chunk loop with
a progress file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def ingest_available(spark: SparkSession, source_dir: str, schema: T.StructType,
                     transform: Callable[[DataFrame], DataFrame], sink_dir: str,
                     checkpoint_dir: str | None = None, fmt: str = "parquet",
                     glob: str | None = None, max_files_per_trigger: int | None = None) -> None:
    """Process every file now in ``source_dir`` once and append the result to ``sink_dir``.

    ``source_dir`` may also name a single file, or a table that is a folder of files.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source_dir)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    if found is not None and len(found) == 1 and found[0].isFile():
        # a stream reads folders: that of the file, and of it only the file
        source_dir, glob = at.getParent().toString(), at.getName()
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = transform(reader.load(source_dir))
    ckpt = checkpoint_dir or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).option("path", sink_dir)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
