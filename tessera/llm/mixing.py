"""Mixing sources to target weights by balanced (cube-method) sampling.

Sources share the corpus size by weight, no source above ``CAP`` times its own size. A source with
``target = r * size`` takes every document ``floor(r)`` times; whether a document is taken once
more has the inclusion probability ``r - floor(r)``, and those extra takes are drawn by the cube
method: probabilities are moved along the null space of the balancing constraints (number of
documents, number of tokens) until each is 0 or 1.

The flight runs in rounds. In each, documents of a source are dealt into groups of at most about
``GROUP`` rows (the number of groups follows the source's row count, so a source with a third of
all rows is just more groups); a group's flight keeps its two totals exactly and leaves at most two
documents undecided. The undecided meet in the next round, a factor of thousands fewer, until one
group a source is left; there the landing step rounds the last dozen documents, trying all ways, so as
to miss the token total least.

Randomness is a hash of (seed, doc_id, size); groups are sorted, so reruns and retried tasks agree.

Edge cases: null text has size 0; null source is a source of its own, ordered last; documents of
size 0 are drawn like others (they add nothing); repeated rows are separate documents; an empty
table gives an empty result; if all sizes are 0, every target is 0. A source of size 0 has target 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.codes import mix64
from tessera.llm.scratch import Scratch

WEIGHTS, CAP, GROUP, SEED = (5, 2, 1), 3.0, 2_000, 17
#: Documents of a source that are left to the landing step, beside the flight's last two
LANDING = 10
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Number of blank-separated words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, source_size, n_docs, target from rows (source, size).

    One row a source throughout; weights repeat over the sources in code-point order (null last).
    Filling up is ``target = min(cap * size, level * weight)``: the level rises while sources at
    their cap pass on their excess, one small aggregate a step.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    totals = Scratch(spark, "mix-sources").table(totals.withColumn("weight", weight), "totals")
    limit = F.col("source_size") * cap
    all_size = totals.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, at_cap = 0.0, -1
    while True:
        full = limit <= F.col("weight") * level if at_cap >= 0 else F.lit(False)
        n, held, free = totals.agg(
            F.coalesce(F.sum(F.when(full, 1)), F.lit(0)),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0))).first()
        if n == at_cap or not free:
            break
        at_cap, level = n, (all_size - held) / free
    return totals.select("source", "source_size", "n_docs", F.least(limit, F.col("weight") * level).alias("target"))


def _flight(p: np.ndarray, size: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Cube flight of one group, balanced on its count and its total of ``size``.

    Three undecided documents at a time are moved along the direction that keeps both totals,
    (s2 - s3, s3 - s1, s1 - s2), until one of them is decided; ties move along (1, -1, 0).
    """
    p = p.copy()
    eps = 1e-12
    held: list[int] = []
    for k in range(len(p)):
        if p[k] <= eps or p[k] >= 1 - eps:
            p[k] = 0.0 if p[k] < 0.5 else 1.0
            continue
        held.append(k)
        if len(held) < 3:
            continue
        a, b, c = held
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
        if u == (0.0, 0.0, 0.0):
            u = (1.0, -1.0, 0.0)
        up, down = np.inf, np.inf
        for v, i in zip(u, held):
            if v > 0:
                up, down = min(up, (1 - p[i]) / v), min(down, p[i] / v)
            elif v < 0:
                up, down = min(up, -p[i] / v), min(down, -(1 - p[i]) / v)
        step = up if luck[k] * (up + down) < down else -down
        for v, i in zip(u, held):
            p[i] += step * v
            if p[i] <= eps or p[i] >= 1 - eps:
                p[i] = 0.0 if p[i] < 0.5 else 1.0
        held = [i for i in held if 0.0 < p[i] < 1.0]
    return p


def _land(p: np.ndarray, size: np.ndarray, open_: np.ndarray) -> None:
    """Round the few ``open_`` documents so that their totals (tokens first, then number) are missed least."""
    bits = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    tokens = np.abs(bits @ size[open_] - p[open_] @ size[open_])
    number = np.abs(bits.sum(axis=1) - p[open_].sum())
    p[open_] = bits[int(np.argmin(tokens + 0.05 * size[open_].mean() * number))]


def _round(last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["luck", "doc", "size", "n"], kind="stable", ignore_index=True)
        size, p = rows["size"].to_numpy(dtype=float), rows["p"].to_numpy(dtype=float).copy()
        luck = mix64(rows["luck"].to_numpy(dtype=np.int64).view(np.uint64) + np.uint64(1))
        # the last flight leaves out LANDING documents, which the landing step needs for a close fit
        wait = np.flatnonzero((p > 0) & (p < 1))[:LANDING] if last else np.empty(0, np.int64)
        fly = np.setdiff1d(np.arange(len(p)), wait)
        p[fly] = _flight(p[fly], size[fly], (luck[fly] >> np.uint64(11)).astype(float) / 2.0 ** 53)
        if last:
            open_ = np.flatnonzero((p > 0) & (p < 1))
            if len(open_):
                _land(p, size, open_)
        return rows.assign(p=p)
    return run


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, group: int = GROUP, seed: int = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, times (how often the mix takes the document)."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    sizes = scratch.table(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        token_count(F.col("text").cast("string")).alias("size")), "sizes")
    targets = source_targets(sizes, weights, cap)
    # equal rows of one document are told apart by a count, so that each is drawn
    same = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    named = same.withColumn("no_source", F.col("source").isNull()).withColumn("source", F.coalesce("source", F.lit("")))
    t = targets.select(F.coalesce("source", F.lit("")).alias("source"), F.col("source").isNull().alias("no_source"), "source_size", "n_docs", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = named.join(t, ["source", "no_source"]).withColumn("base", F.floor(rate)).withColumn("p", rate - F.floor(rate))
    rows = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    # floor and remainder meet at whole rates
    rows = rows.withColumn("base", F.when(F.col("p") > 1 - 1e-9, F.col("base") + 1).otherwise(F.col("base"))).withColumn("p", F.when((F.col("p") > 1 - 1e-9) | (F.col("p") < 1e-9), 0.0).otherwise(F.col("p")))
    rows = rows.withColumn("luck", F.xxhash64(F.lit(seed), "doc_id", "size", "n")).withColumn("doc", F.coalesce("doc_id", F.lit(-1))).withColumn("no_id", F.col("doc_id").isNull()).drop("doc_id")  # pandas has no null integers

    done, open_rows, left, turn = [], rows, targets.agg(F.coalesce(F.max("n_docs"), F.lit(0))).first()[0], 0
    while True:
        last = left <= group
        # the number of groups of a source follows its rows; by the last round all is one group
        share = F.lit(1) if last else F.ceil(F.col("n_docs") / group)
        dealt = open_rows.withColumn("part", F.pmod(F.xxhash64("luck", F.lit(turn)), share))
        flown = scratch.table(dealt.groupBy("source", "no_source", "part").applyInPandas(_round(last), dealt.schema), f"round{turn}").drop("part")
        if last:
            done.append(flown)
            break
        undecided = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(flown.where(~undecided))
        open_rows = flown.where(undecided)
        counts = open_rows.groupBy("source", "no_source").agg(F.count(F.lit(1)).alias("n_docs"))
        left = counts.agg(F.coalesce(F.max("n_docs"), F.lit(0))).first()[0]
        open_rows = open_rows.drop("n_docs").join(counts, ["source", "no_source"]).select(*dealt.drop("part").columns)
        turn += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(F.when(~F.col("no_id"), F.col("doc")).alias("doc_id"), "size", F.when(~F.col("no_source"), F.col("source")).alias("source"), "source_size", "target", (F.col("base") + F.round("p")).cast("long").alias("times"))


def report(mixed: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def repeat_documents(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them, columns unchanged (documents taken 0 times go).

    Rows of one id (or of none), source and size are alike to the mix, which takes some of them once more than
    the others: those are the first by a hash of the whole row.
    """
    # takes of a source differ by one at most
    low = mixed.groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_size")) \
        .agg(F.min("times").alias("_mix_low"), F.max("times").alias("_mix_high"), F.sum("times").alias("_mix_all"), F.count(F.lit(1)).alias("_mix_n"))
    times = low.withColumn("_mix_more", F.col("_mix_all") - F.col("_mix_low") * F.col("_mix_n")).where("_mix_high > 0").drop("_mix_high", "_mix_all", "_mix_n")
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", token_count(F.col("text").cast("string")).alias("words"))
    same = rows["doc_id"].cast("long").eqNullSafe(times["_mix_id"]) & rows["source"].cast("string").eqNullSafe(times["_mix_source"]) & (rows["words"] == times["_mix_size"])
    joined = rows.join(times, same)
    alike = joined.where("_mix_more = 0").withColumn("_mix_times", F.col("_mix_low"))
    place = F.row_number().over(Window.partitionBy("_mix_id", "_mix_source", "_mix_size").orderBy(F.xxhash64("row")))
    drawn = joined.where("_mix_more > 0").withColumn("_mix_times", F.col("_mix_low") + (place <= F.col("_mix_more")).cast("long"))
    copies = alike.unionByName(drawn).where("_mix_times > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times").cast("int"))))
    return copies.select("row.*")
