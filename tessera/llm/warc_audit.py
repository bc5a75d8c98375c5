"""WARC fixity audit: Merkle trees over records and ordered offset ranges, compared from the root down.

A record's digest is the SHA-256 of its WARC bytes. A tree's leaves are the offsets of an archive in
order; a node of level L covers ``FAN ** L`` consecutive offsets and hashes its children's numbers
and digests in order, so at most ``FAN`` rows meet in one hash, whatever the archive's size. Two
replicas are compared by their roots; where a node differs, only its children are read from both
trees, down to the offsets that are changed, missing or extra. Levels are written tables.

Edge cases: several records at one offset make one leaf from their number, smallest, largest and summed
digests (partially aggregated, in any order); a record without offset is filed under -1, a null url or body
is empty; identical or two empty replicas give an empty report; against an empty one, all
offsets are missing or extra; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.scratch import Scratch

FAN_BITS = 6
FAN = 1 << FAN_BITS


def warc_record(url: Column, body: Column) -> Column:
    """The bytes of a WARC response record."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")


def leaves(records: DataFrame) -> DataFrame:
    """(node, digest, n) of each offset, from rows (offset, record)."""
    digest = records.select(F.coalesce(F.col("offset").cast("long"), F.lit(-1)).alias("node"), F.sha2("record", 256).alias("digest"))
    # repeated offsets: sums of the digests' 32-bit words do not depend on the order
    words = [F.sum(F.conv(F.substring("digest", 1 + 8 * k, 8), 16, 10).cast("long")).cast("string") for k in range(8)]
    some = digest.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), F.concat_ws(",", *words).alias("sums"))
    several = F.sha2(F.concat_ws("|", F.col("n").cast("string"), "low", "high", "sums").cast("binary"), 256)
    return some.select("node", F.when(F.col("n") == 1, F.col("low")).otherwise(several).alias("digest"), "n")


def parents(level: DataFrame) -> DataFrame:
    """The nodes one level up: hashes of up to FAN children in order."""
    up = level.groupBy(F.shiftright("node", FAN_BITS).alias("parent")).agg(
        F.array_sort(F.collect_list(F.struct("node", "digest"))).alias("children"), F.sum("n").alias("n"))
    named = F.transform("children", lambda c: F.concat_ws(":", c["node"].cast("string"), c["digest"]))
    return up.select(F.col("parent").alias("node"), F.sha2(F.array_join(named, ",").cast("binary"), 256).alias("digest"), "n")


def levels_for(largest: int) -> int:
    """Levels above the leaves until all offsets up to ``largest`` meet in one root."""
    return max(1, -(-max(largest, 1).bit_length() // FAN_BITS))


class MerkleTree:
    """The levels of an archive's tree, leaves first, as written tables."""

    def __init__(self, records: DataFrame, levels: int, scratch: Scratch, name: str):
        self.levels = [scratch.table(leaves(records), f"{name}-0")]
        for level in range(1, levels + 1):
            self.levels.append(scratch.table(parents(self.levels[-1]), f"{name}-{level}"))

    def root(self) -> DataFrame:
        return self.levels[-1]


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes whose digests differ or that only one side has."""
    left, right = a.select("node", F.col("digest").alias("digest_a")), b.select("node", F.col("digest").alias("digest_b"))
    return left.join(right, "node", "full_outer").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def compare(a: MerkleTree, b: MerkleTree, scratch: Scratch) -> DataFrame:
    """(offset, status, digest_a, digest_b) of every offset whose records differ."""
    bad = differing(a.root(), b.root())
    for level in range(len(a.levels) - 2, -1, -1):
        # only the children of differing nodes are looked at
        wanted = scratch.table(bad.select(F.col("node").alias("parent")), f"bad-{level + 1}")
        below = [tree.levels[level].withColumn("parent", F.shiftright("node", FAN_BITS)).join(wanted, "parent", "left_semi") for tree in (a, b)]
        bad = differing(*below)
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return bad.select(F.col("node").alias("offset"), status.alias("status"), "digest_a", "digest_b")


def audit(a: DataFrame, b: DataFrame) -> DataFrame:
    """Audit of replica ``b`` against ``a``, both rows (offset, record)."""
    scratch = Scratch(a.sparkSession, "warc-audit")
    largest = a.select("offset").union(b.select("offset")).agg(F.coalesce(F.max("offset"), F.lit(0)).cast("long")).first()[0]
    levels = levels_for(largest)
    return compare(MerkleTree(a, levels, scratch, "a"), MerkleTree(b, levels, scratch, "b"), scratch)
