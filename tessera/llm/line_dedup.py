"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` and lower-cased in A-Z; it is held as
two 64-bit hashes. Documents come in batches (by a hash of their id, so a document is in one
batch). Each batch is collapsed to ``(h1, h2, n_docs, last_doc)`` and merge-anti-joined with the runs: keys in no run
are fresh and become a run of level 0, the others are noted as *again* with their counts. ``fanout`` runs of a level
are compacted into one of the next; a key is in one run only, so that compaction is a merge. Runs, notes and the keys
of a batch are tables bucketed and sorted by (h1, h2), all alike: a batch is shuffled and sorted once, and the joins
with the runs read them bucket by bucket, without an exchange on either side.

Lines are dropped after the last batch, as a line goes only if its key is held by ``min_docs`` documents of all batches,
and stays in the largest doc_id that holds it (:func:`dropped_lines`). :meth:`LineRuns.fresh` is the same anti-join for
running ingestion, where only lines never seen before stay.

Hot lines: keys are distinct per document and partially aggregated before the shuffle, so a line
in a third of all documents is a few rows a task; the line side of the merge join is split by
adaptive skew handling. A document's lines are rebuilt from slices between dropped positions, so
the work is linear in the number of lines.

Edge cases: null or empty text is one empty line; keys under ``min_length`` code points always
stay; a repeated doc_id is one document for the counts, and each of its rows is rebuilt; a null
doc_id counts as one document, smaller than all others; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.llm.scratch import Scratch

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_DOCS, BATCHES, FANOUT = 20, 3, 4, 4
KEYS = "h1 long, h2 long, n_docs long, last_doc long"
#: Stands for a null doc_id in comparisons
NO_ID = -(1 << 63)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; ``lower`` does the same (and faster) if all characters are ASCII."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def line_hashes(text: Column, min_length: int = MIN_LENGTH) -> Column:
    """Array of (h1, h2) per line, null for lines whose key is too short."""
    keys = F.transform(F.split(ascii_lower(text), "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)))
    return F.transform(keys, lambda k: F.when(
        F.char_length(k) >= min_length, F.struct(F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(1), k).alias("h2"))))


class Run(NamedTuple):
    """A written table: its bucketed rows and the folder of its files."""

    rows: DataFrame
    path: str


class LineRuns:
    """Sorted runs of ``(h1, h2, n_docs, last_doc)`` in levels, kept under one folder (``buckets``: default, the shuffle partitions)."""

    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.root, self.fanout = spark, root, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[Run]] = []
        self.again: list[Run] = []
        self.made = 0

    def _bucketed(self, keys: DataFrame, name: str) -> Run:
        """``keys`` written in buckets of (h1, h2), a file each, sorted."""
        self.made += 1
        table, path = f"lines_{uuid.uuid4().hex}", f"{self.root}/{name}{self.made}"
        keys.repartition(self.buckets, "h1", "h2").write.format("parquet").option("path", path).bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(table)
        return Run(self.spark.table(table), path)

    def _plain(self, tables: list[Run]) -> DataFrame:
        """The rows of several bucketed tables as one plain table (a union of bucketed scans must not be grouped or joined as if in buckets)."""
        return self.spark.read.schema(KEYS).parquet(*[t.path for t in tables])

    def runs(self) -> list[DataFrame]:
        return [run.rows for level in self.levels for run in level]

    def fresh(self, lines: DataFrame) -> DataFrame:
        """Lines ``(.., h1, h2)`` whose key is in no run: the merge-anti-join with each of them."""
        for run in self.runs():
            lines = lines.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return lines

    def add(self, lines: DataFrame) -> None:
        """Add a batch of ``(doc, h1, h2)`` rows; batches share no document."""
        batch = self._bucketed(lines.groupBy("h1", "h2").agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("last_doc")), "batch")
        if not self.runs():
            return self._keep(batch, 0)
        run = self._bucketed(self.fresh(batch.rows), "level0-run")
        self.again.append(self._bucketed(batch.rows.join(run.rows.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti"), "again"))
        if len(self.again) >= self.fanout:
            self.again = [self._bucketed(self._sum(self.again), "again")]
        self._keep(run, 0)

    def _keep(self, run: Run, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._keep(self._bucketed(self._plain(full), f"level{level + 1}-run"), level + 1)

    def _sum(self, tables: list[Run]) -> DataFrame:
        return self._plain(tables).groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def keys(self) -> DataFrame:
        """All keys with their totals, written: each run's own counts and those noted again."""
        if not self.runs():
            return self.spark.createDataFrame([], KEYS)
        self.made += 1
        for k, total in enumerate(self._totals()):
            total.write.mode("append" if k else "overwrite").parquet(f"{self.root}/keys{self.made}")
        return self.spark.read.schema(KEYS).parquet(f"{self.root}/keys{self.made}")

    def _totals(self) -> list[DataFrame]:
        """The totals of each run's keys, by a join of buckets."""
        if len(self.again) > 1:
            self.again = [self._bucketed(self._sum(self.again), "again")]
        if not self.again:
            return self.runs()
        more = self.again[0].rows.toDF("h1", "h2", "more", "later").hint("merge")
        return [run.join(more, ["h1", "h2"], "left").select("h1", "h2", (F.col("n_docs") + F.coalesce("more", F.lit(0))).alias("n_docs"), F.greatest("last_doc", "later").alias("last_doc")) for run in self.runs()]


def dropped_lines(lines: DataFrame, runs: LineRuns, min_docs: int = MIN_DOCS) -> DataFrame:
    """Rows of ``lines`` (doc, h1, h2, ..) whose key is held by ``min_docs`` documents, the last of them another."""
    common = runs.keys().where(F.col("n_docs") >= min_docs).select("h1", "h2", "last_doc")
    return lines.join(common.hint("merge"), ["h1", "h2"]).where(F.col("doc") < F.col("last_doc"))


def without(lines: Column, positions: Column) -> Column:
    """Array ``lines`` without the (sorted, 0-based) ``positions``: the slices between them, in linear time."""
    bounds = F.concat(F.array(F.lit(-1)), positions, F.array(F.size(lines)))
    part = lambda i: F.slice(lines, F.element_at(bounds, i) + 2, F.element_at(bounds, i + 1) - F.element_at(bounds, i) - 1)
    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(positions) + 1), part))


def dedup_lines(docs: DataFrame, min_length: int = MIN_LENGTH, min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """doc_id, text (null as empty), n_lines, n_dropped, kept (the text left) of every document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "line-dedup")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("doc", F.coalesce("doc_id", F.lit(NO_ID)))
    rows = rows.withColumn("t1", F.xxhash64("text")).withColumn("t2", F.xxhash64(F.lit(1), "text"))
    digests = rows.select("doc", "t1", "t2", F.pmod(F.xxhash64("doc"), F.lit(batches)).alias("batch"), line_hashes(F.col("text"), min_length).alias("hashes"))
    digests = digests.where(F.exists("hashes", lambda h: h.isNotNull()))
    digests.write.partitionBy("batch").mode("overwrite").parquet(scratch.path("digests"))
    written = spark.read.schema(digests.schema).parquet(scratch.path("digests"))

    runs = LineRuns(spark, scratch.path("runs"), fanout)
    for batch in range(batches):
        mine = written.where(F.col("batch") == batch).select("doc", F.explode(F.array_distinct("hashes")).alias("h")).where("h is not null")
        runs.add(mine.select("doc", "h.h1", "h.h2"))

    lines = written.select("doc", "t1", "t2", F.posexplode("hashes").alias("pos", "h")).where("h is not null")
    gone = dropped_lines(lines.select("doc", "t1", "t2", "pos", "h.h1", "h.h2"), runs, min_docs)
    # collect_set: the positions of one text, also if its row is repeated
    gone = gone.groupBy("doc", "t1", "t2").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    parts = F.split("text", "\n", -1)
    return rows.join(gone, ["doc", "t1", "t2"], "left").select(
        "doc_id", "text", F.size(parts).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(without(parts, F.col("gone")), "\n")).alias("kept"))


def report(deduped: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
