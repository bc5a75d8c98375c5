"""Token counts: delta-maintained rollups by source, language and tokenizer version.

A batch holds the new count of (doc_id, tokenizer) pairs, or a null count to delete them. A commit looks
the pairs up in the ledger of what is counted now, and writes two parts under the batch's id: the
ledger rows of the batch, and signed additive totals (minus the old count under its old source
and language, plus the new one). Totals are the sum of all committed parts, so nothing is counted
again. A batch is committed by the job that writes its totals (Spark's ``_SUCCESS``); a ledger part
without it is ignored and overwritten by a rerun, and a batch id that is committed is not
applied again, so replays and restarts change nothing. :meth:`compact` folds old totals into one part, and the
ledger into a snapshot in buckets of its key, sorted: later commits join their batch with it without moving
it, and read besides only the ledger parts of the batches since.

Edge cases: null source or language is a value of its own; rows without doc_id or tokenizer take
no part; of rows that repeat a pair in a batch the largest (count, source, language) holds, a delete only if all
are; deleting what is not counted does nothing; an empty batch commits empty parts; totals without documents left are not
reported.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
KEYS = ["doc_id", "tokenizer"]
LEDGER = "doc_id long, tokenizer string, source string, lang string, n_tokens long, turn int"


class TokenRollups:
    """Rollups kept under ``root`` (shared storage), opened or reopened by path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[str]:
        """Batch ids whose totals are written."""
        if not self._fs.exists(self._path(f"{self.root}/totals")):
            return []
        parts = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/totals"))]
        return sorted(p for p in parts if self._fs.exists(self._path(f"{self.root}/totals/{p}/_SUCCESS")))

    def _ledger(self, batches: list[str]) -> DataFrame:
        paths = [f"{self.root}/ledger/{b}" for b in batches]
        return self.spark.read.schema(LEDGER).parquet(*paths) if paths else self.spark.createDataFrame([], LEDGER)

    def _folded(self, done: list[str]) -> tuple[str | None, int, set[str]]:
        """The newest compacted part (or None), the buckets of its snapshot (0: none), and the batches it holds."""
        folded = [b for b in done if b.startswith("compact-")]
        if not folded:
            return None, 0, set()
        newest = max(folded, key=lambda b: int(b.removeprefix("compact-")))
        rows = [r.asDict() for r in self.spark.read.parquet(f"{self.root}/folded/{newest}").collect()]
        return newest, max(r.get("buckets") or 0 for r in rows), {r["batch"] for r in rows}

    def _snapshot(self, name: str, buckets: int) -> DataFrame:
        """A written snapshot as a bucketed table, also in a session that did not write it."""
        table = f"ledger_{uuid.uuid4().hex}"
        self.spark.sql(f"create table {table} ({LEDGER}) using parquet clustered by ({', '.join(KEYS)}) sorted by ({', '.join(KEYS)}) into {buckets} buckets location '{self.root}/snapshots/{name}'")
        return self.spark.table(table)

    def _counted(self, new: DataFrame, batches: list[str]) -> DataFrame:
        """``new`` with what is counted now (``was``)."""
        name, buckets, held = self._folded(self.committed())
        since = [b for b in batches if not (buckets and b in held)]
        latest = self._ledger(since).groupBy(*KEYS).agg(F.max_by(F.struct("n_tokens", "source", "lang"), "turn").alias("was"))
        if not buckets:
            return new.join(latest, KEYS, "left")
        before = self._snapshot(name, buckets).select(*KEYS, F.struct("n_tokens", "source", "lang").alias("before"))
        known = new.repartition(buckets, *KEYS).join(before.hint("merge"), KEYS, "left")
        return known.join(latest, KEYS, "left").withColumn("was", F.coalesce("was", "before")).drop("before")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch of (doc_id, tokenizer, source, lang, n_tokens); False if it was applied before."""
        done = [b for b in self.committed() if not b.startswith("compact-")]
        if batch in done:
            return False
        rows = changes.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("tokenizer").cast("string").alias("tokenizer"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col("n_tokens").cast("long").alias("n_tokens"))
        new = rows.where("doc_id is not null and tokenizer is not null").groupBy(*KEYS).agg(F.max(F.struct("n_tokens", "source", "lang")).alias("new"))
        turn = len(done)
        joined = self._counted(new, done).where("new.n_tokens is not null or was.n_tokens is not null")
        part = f"{self.root}/ledger/{batch}"
        joined.select(*KEYS, F.col("new.source").alias("source"), F.col("new.lang").alias("lang"), F.col("new.n_tokens").alias("n_tokens"), F.lit(turn).alias("turn"),
                      F.col("was.source").alias("old_source"), F.col("was.lang").alias("old_lang"), F.col("was.n_tokens").alias("old_tokens")).write.mode("overwrite").parquet(part)
        written = self.spark.read.parquet(part)
        minus = written.where("old_tokens is not null").select(F.col("old_source").alias("source"), F.col("old_lang").alias("lang"), "tokenizer", F.lit(-1).alias("docs"), (-F.col("old_tokens")).alias("tokens"))
        plus = written.where("n_tokens is not null").select("source", "lang", "tokenizer", F.lit(1).alias("docs"), F.col("n_tokens").alias("tokens"))
        self._write(minus.union(plus).groupBy("source", "lang", "tokenizer").agg(F.sum("docs").cast("long").alias("n_docs"), F.sum("tokens").alias("n_tokens")), batch)
        return True

    def _write(self, sums: DataFrame, name: str) -> None:
        sums.write.mode("overwrite").parquet(f"{self.root}/totals/{name}")

    def _parts(self) -> list[str]:
        """Parts to add up: the newest compacted one, and the batches that it does not hold."""
        done = self.committed()
        newest, _, held = self._folded(done)
        return [*([newest] if newest else []), *(b for b in done if b not in held and not b.startswith("compact-"))]

    def compact(self) -> None:
        """Fold the totals of all committed batches into one part, and their ledger into a snapshot without deleted pairs."""
        done = self.committed()
        batches = [b for b in done if not b.startswith("compact-")]
        name = f"compact-{len(batches)}"
        if batches and name not in done:
            sums = self._sum(self._parts())
            newest, old, held = self._folded(done)
            rows = self._ledger([b for b in batches if not (old and b in held)])
            if old:     # read as plain files: a union with a bucketed table is not in buckets
                rows = rows.union(self.spark.read.schema(LEDGER).parquet(f"{self.root}/snapshots/{newest}"))
            now = rows.groupBy(*KEYS).agg(F.max_by(F.struct("source", "lang", "n_tokens", "turn"), "turn").alias("now")).select(*KEYS, "now.*").where("n_tokens is not null")
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            now.repartition(buckets, *KEYS).write.mode("overwrite").option("path", f"{self.root}/snapshots/{name}").bucketBy(buckets, *KEYS).sortBy(*KEYS).saveAsTable(f"ledger_{uuid.uuid4().hex}")
            self.spark.createDataFrame([(b, buckets) for b in batches], "batch string, buckets int").write.mode("overwrite").parquet(f"{self.root}/folded/{name}")
            self._write(sums, name)

    def _sum(self, parts: list[str]) -> DataFrame:
        rows = self.spark.read.schema(SUMS).parquet(*[f"{self.root}/totals/{p}" for p in parts]) if parts else self.spark.createDataFrame([], SUMS)
        return rows.groupBy("source", "lang", "tokenizer").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens of all documents counted now."""
        return self._sum(self._parts()).where("n_docs <> 0")
