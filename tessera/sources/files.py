"""File sources and sinks.

Paths may be any Hadoop-compatible URI; listing goes through the Hadoop
FileSystem of the session, so the same code works on a cluster store.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
SPLITS = ("train", "val", "test")


# ---------------------------------------------------------------- S1/S2 JSON lines
def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
               keep_rejects: bool = False) -> DataFrame:
    """JSON-lines scan with an explicit schema.

    Malformed lines are dropped (``DROPMALFORMED``); with ``keep_rejects`` they
    are kept as rows whose ``_corrupt_record`` holds the raw line (``PERMISSIVE``).
    Without a schema one is inferred from the whole input (S2).
    """
    if schema is None:
        schema = infer_schema(spark, path)
    r = spark.read.option("mode", "PERMISSIVE" if keep_rejects else "DROPMALFORMED")
    if keep_rejects:
        schema = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return (r.option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT + "XXX")
            .schema(schema).json(path))


def infer_schema(spark: SparkSession, path: str | Sequence[str], sampling_ratio: float = 1.0) -> T.StructType:
    """Schema inferred from all parsable lines (or, on request, from a share of them)."""
    return spark.read.option("mode", "DROPMALFORMED").option("samplingRatio", str(sampling_ratio)).json(path).schema


def rejected_lines(df: DataFrame) -> DataFrame:
    """Rows a ``keep_rejects`` scan could not parse (whole rows: Spark refuses plans that read
    only the corrupt-record column of a raw file)."""
    return df.where(F.col(CORRUPT_COLUMN).isNotNull())


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# Lines a file at most: a compressed file is read by one task.
JSONL_FILE_LINES = 200_000


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink keeping microsecond timestamps (the default format keeps milliseconds).

    Lines repeat every key, so files are gzipped; each holds few enough lines for the scan to be spread over tasks.
    """
    (df.write.mode(mode).option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT + "XXX")
     .option("compression", "gzip").option("maxRecordsPerFile", JSONL_FILE_LINES).json(path))


# ---------------------------------------------------------------- S3/S9/S10/S11 sinks
def write_parquet(df: DataFrame, path: str, mode: str = "ignore", partition_by: Sequence[str] = ()) -> None:
    """S3: zstd parquet; ``ignore`` leaves an existing target untouched (idempotent re-runs)."""
    w = df.write.mode(mode).option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header. Reports are one row per feature/model, written as one file."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S9 for large outputs (submissions): one file per task, no single-task funnel."""
    df.write.mode(mode).option("header", True).csv(path)


def write_spec(spark: SparkSession, spec: Mapping, path: str) -> None:
    """The imputation spec as a one-row JSON table (re-readable with :func:`read_spec`)."""
    spark.createDataFrame([(json.dumps(spec, sort_keys=True),)], "spec string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_spec(spark: SparkSession, path: str) -> dict:
    row = spark.read.text(path).first()
    return json.loads(row[0])


def write_labels(df: DataFrame, path: str, id_col: str = "id", label: str = "label") -> None:
    """Labels keyed by id (never by position)."""
    df.select(id_col, label).write.mode("overwrite").parquet(path)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---------------------------------------------------------------- S4
def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenation of frames with differing columns; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- S8/S14 listing
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, directory: str, pattern: str = "*") -> list[str]:
    fs, p, jvm = _fs(spark, directory)
    st = fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, pattern))
    return sorted(s.getPath().getName() for s in (st or []))


def load_split(spark: SparkSession, base: str, split: str,
               names: Sequence[str] = ("{split}_model_ready", "{split}_model_ready_reduced")) -> DataFrame:
    """First existing dataset among ``names`` for a split (e.g. the reduced fallback)."""
    for n in names:
        for suffix in ("", ".parquet"):
            path = f"{base.rstrip('/')}/{n.format(split=split)}{suffix}"
            if exists(spark, path):
                return spark.read.parquet(path)
    raise FileNotFoundError(f"no dataset for split {split!r} under {base}")


def discover_families(spark: SparkSession, base: str, splits: Sequence[str] = SPLITS) -> list[str]:
    """Embedding families ``{family}_X_{split}.parquet`` present for every split."""
    found: dict[str, set[str]] = {}
    for name in list_names(spark, base, "*_X_*.parquet"):
        stem = name[: -len(".parquet")]
        fam, _, split = stem.rpartition("_X_")
        if fam and split in splits:
            found.setdefault(fam, set()).add(split)
    return sorted(f for f, s in found.items() if set(splits) <= s)
