"""Isotonic calibration by merged blocks.

Pool-adjacent-violators on a sorted list gives the best non-decreasing fit. It may be done in parts: each range of
scores is pooled by itself, then the blocks left over (weight, mean) are pooled again, which gives the same fit as one
pass over all rows. Equal scores are one point first (a partial aggregate), ranges are cut by score, and each task
hands on its blocks only. Their number is what the data's shape leaves, at most the number of distinct scores, so
ranges are merged by a tree: ``MERGE`` neighbouring ranges a task, until one is left. Beyond ``BINS`` points scores are
first put on an even grid, which bounds the last list; below, the fit is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

MERGE = 16
#: Distinct scores up to which the fit is exact; more are rounded to this many even steps
BINS = 1_000_000


def pool(low: np.ndarray, high: np.ndarray, weight: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks (lowest x, highest x, weight, mean) of the best non-decreasing fit to blocks in order of x."""
    a, b, w, m = [], [], [], []
    for lo, hi, n, y in zip(low.tolist(), high.tolist(), weight.tolist(), mean.tolist()):
        while m and m[-1] >= y:
            total = w[-1] + n
            y, lo = (m.pop() * w[-1] + y * n) / total, a.pop()
            n = total
            w.pop(), b.pop()
        a.append(lo), b.append(hi), w.append(n), m.append(y)
    return np.array(a), np.array(b), np.array(w), np.array(m)


def _pooled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks of a task's rows (low, high, weight, mean), which come in order of x."""
    held = None
    for frame in frames:
        if len(frame):
            rows = frame if held is None else pd.concat([held, frame], ignore_index=True)
            held = pd.DataFrame(dict(zip(("low", "high", "weight", "mean"), pool(*(rows[c].to_numpy() for c in ("low", "high", "weight", "mean"))))))
    if held is not None:
        yield held


_BLOCK = "low double, high double, weight double, mean double"


def fit_isotonic(points: DataFrame, x: str = "x", y: str = "y", weight: str | None = None, bins: int = BINS) -> DataFrame:
    """Blocks of the fit in order: low, high (of x), weight, mean. Rows with a null x or y take no part."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(x)).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), w.alias("w"))
    rows = rows.where("w > 0")
    same = rows.groupBy("x").agg(F.sum("w").alias("weight"), (F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("mean"))
    same = cut_lineage(same)
    n, least, most = same.agg(F.count(F.lit(1)), F.min("x"), F.max("x")).first()
    if n > bins:
        step = (most - least) / bins
        at = F.least(F.floor((F.col("x") - least) / step), F.lit(bins - 1))
        blocks = same.groupBy(at.alias("at")).agg(F.min("x").alias("low"), F.max("x").alias("high"), (F.sum(F.col("mean") * F.col("weight")) / F.sum("weight")).alias("mean"), F.sum("weight").alias("weight"))
    else:
        blocks = same.withColumnRenamed("x", "low").withColumn("high", F.col("low"))
    blocks = blocks.select("low", "high", "weight", "mean").repartitionByRange("low").sortWithinPartitions("low")
    blocks = cut_lineage(blocks.mapInPandas(_pooled, _BLOCK))
    parts = blocks.rdd.getNumPartitions()
    while parts > 1:
        # neighbouring ranges meet: a plain coalesce keeps their order only by chance, so they are cut by x again
        parts = -(-parts // MERGE)
        blocks = cut_lineage(blocks.repartitionByRange(parts, "low").sortWithinPartitions("low").mapInPandas(_pooled, _BLOCK))
    return blocks


def isotonic_value(x: Column, low: list[float], high: list[float], mean: list[float]) -> Column:
    """The fit at ``x``: a block's mean inside it, a straight line between two blocks, the first or last mean beyond."""
    ends = [p for pair in zip(low, high) for p in pair]
    values = [v for v in mean for _ in (0, 1)]

    @F.pandas_udf("double")
    def at(s: pd.Series) -> pd.Series:
        return pd.Series(np.where(s.isna(), np.nan, np.interp(s.to_numpy(dtype=float, na_value=0.0), ends, values)), index=s.index).astype(float).where(s.notna(), None)
    return at(x)


def apply_isotonic(df: DataFrame, blocks: DataFrame, x: str, out: str) -> DataFrame:
    """``df`` with the calibrated value of ``x`` (null without blocks); the blocks, at most ``BINS``, go to the tasks."""
    rows = blocks.orderBy("low").toPandas()
    if not len(rows):
        return df.withColumn(out, F.lit(None).cast("double"))
    return df.withColumn(out, isotonic_value(F.col(x), rows["low"].tolist(), rows["high"].tolist(), rows["mean"].tolist()))
