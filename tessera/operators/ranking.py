"""Exact ordered prefix sums without a global (single-task) window.

Ranks, medians, precision-recall and ROC curves all need, for every distinct
value ``x`` inside a key, the totals of rows with a smaller value. A plain
``Window.partitionBy(key).orderBy(x)`` sends every distinct value of a key to
one task. Instead:

1. collapse to distinct ``(key, x)`` with their sums (map-side combined);
2. range-partition these by ``(key, x)`` and note each row's slice. This is written once to the
   checkpoint folder, so the input is read once and a recomputed task sees the same slices;
3. a small ``(key, slice)`` table gives each slice's offset;
4. the running sum inside a ``(key, slice)`` plus its offset is the exact prefix sum.

The number of slices follows the shuffle partitions that AQE finds fit for the data. A value that
holds a third of all rows is one row after step 1, and a key with most of the values spreads over
many slices, so neither makes a hot task.

Where every row needs its place, the rows themselves are dealt and sorted (:func:`numbered`, :func:`tie_ranked`):
one exchange of the rows, written once; a row's index in its slice comes with the write, a table of a row a slice and
key gives the offsets, and nothing is joined back. Equal rows are dealt over slices like any others.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def value_prefix_sums(df: DataFrame, keys: Sequence[str], x: str, sums: Mapping[str, Column | str],
                      slices: int | None = None) -> DataFrame:
    """Per distinct ``(keys, x)``: the sums, and their running totals by ascending ``x``.

    Output columns: ``keys…, x``, every name in ``sums`` (this value's sum),
    ``{name}_le`` (sum over values ≤ x), ``{name}_lt`` (< x) and
    ``{name}_total`` (all values of the key). Rows where ``x`` or a key is null are
    ignored. Without keys the whole table is one key. ``slices`` fixes the number of slices.
    """
    keys = list(keys)
    names = list(sums)
    aggs = [F.sum(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in sums.items()]
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, x]])
    g = df.where(known).groupBy(*keys, x).agg(*aggs)
    dealt = g.repartitionByRange(slices, *keys, x) if slices else g.repartitionByRange(*keys, x)
    placed = cut_lineage(dealt.withColumn("__slice", F.spark_partition_id()))

    per_slice = placed.groupBy(*keys, "__slice").agg(*[F.sum(n).alias(f"__b_{n}") for n in names])
    wk = Window.partitionBy(*keys).orderBy("__slice")          # a row per slice of the key
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_slice.select(
        *keys, "__slice",
        *[F.coalesce(F.sum(f"__b_{n}").over(before), F.lit(0)).alias(f"__off_{n}") for n in names],
        *[F.sum(f"__b_{n}").over(whole).alias(f"{n}_total") for n in names],
    )

    ws = Window.partitionBy(*keys, "__slice").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(offsets, keys + ["__slice"])
    cols = [F.col(c) for c in keys] + [F.col(x)] + [F.col(n) for n in names]
    for n in names:
        le = F.col(f"__off_{n}") + F.sum(n).over(ws)
        cols += [le.alias(f"{n}_le"), (le - F.col(n)).alias(f"{n}_lt"), F.col(f"{n}_total")]
    return out.select(*cols)


def average_ranks(df: DataFrame, keys: Sequence[str], x: str, weight: Column | str | None = None,
                  slices: int | None = None) -> DataFrame:
    """1-based average (mid) rank of each distinct ``x`` within ``keys``.

    Output: ``keys…, x, n_x`` (rows with that value), ``rank`` and ``n`` (rows of the key).
    """
    w = F.lit(1).cast("long") if weight is None else (F.col(weight) if isinstance(weight, str) else weight)
    p = value_prefix_sums(df.withColumn("__w", w), keys, x, {"n_x": "__w"}, slices)
    return p.select(*keys, x, "n_x",
                    (F.col("n_x_lt") + (F.col("n_x") + 1) / 2.0).alias("rank"),
                    F.col("n_x_total").alias("n"))


def exact_median(long: DataFrame, key: str, x: str, slices: int | None = None) -> DataFrame:
    """Exact (interpolated) median of ``x`` per ``key``, nulls ignored.

    Uses the prefix sums instead of gathering every value of a key in one
    aggregation buffer: the median is read off the value(s) covering the
    middle position(s).
    """
    p = value_prefix_sums(long.withColumn("__one", F.lit(1).cast("long")), [key], x, {"c": "__one"}, slices)
    n = F.col("c_total")
    lo_pos = F.floor((n + 1) / 2)          # 1-based middle positions
    hi_pos = F.floor(n / 2) + 1
    covers = lambda pos: (F.col("c_lt") < pos) & (pos <= F.col("c_le"))
    picked = p.where(covers(lo_pos) | covers(hi_pos)).select(
        key,
        F.when(covers(lo_pos), F.col(x)).alias("__lo"),
        F.when(covers(hi_pos), F.col(x)).alias("__hi"))
    return picked.groupBy(key).agg(((F.max("__lo") + F.max("__hi")) / 2.0).alias("median"))


# ---------------------------------------------------------------- places carried by the rows
#: (key, slice) pairs up to which their table goes to every task
OFFSETS = 100_000
_ROW_BITS = 33          # Spark's monotonically_increasing_id: partition in the upper bits, row in the lower 33


def _dealt(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows sorted by (keys, order) over slices (as scanned without any), written, with ``__slice`` and ``__at`` (index in the slice)."""
    placed = df
    if [*keys, *order]:
        by = [*keys, *order, "__spread"]
        placed = df.withColumn("__spread", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("__spread")
    placed = placed.withColumn("__m", F.monotonically_increasing_id())
    return cut_lineage(placed.select(*df.columns, F.shiftright("__m", _ROW_BITS).alias("__slice"), F.col("__m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("__at")))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos", total: str | None = None) -> DataFrame:
    """``df`` with each row's 0-based place ``out`` among the rows of its key, by ``order`` (nulls first; ties in any order).

    ``total`` names a column for the key's number of rows. A null key is a key; no row is lost. One exchange of the rows,
    none without keys and order (places as scanned).
    """
    keys = list(keys)
    rows = _dealt(df, keys, order)
    slices = rows.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    key = Window.partitionBy(*keys)
    before = key.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(slices.select(*[F.col(c).alias(f"__key_{i}") for i, c in enumerate(keys)], F.col("__slice").alias("__s"),
                                        (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__n").over(key).alias("__total")))
    small = F.broadcast(offsets) if offsets.count() <= OFFSETS else offsets
    same = reduce(and_, [rows[c].eqNullSafe(F.col(f"__key_{i}")) for i, c in enumerate(keys)], F.col("__slice") == F.col("__s"))
    found = rows.join(small, same)
    return found.select(*df.columns, (F.col("__at") + F.col("__shift")).alias(out), *([F.col("__total").alias(total)] if total else []))


def _tie_starts(p: np.ndarray, new: np.ndarray) -> np.ndarray:
    """For sorted values, the index at which each one's run begins; ``new`` marks the first row of each key."""
    first = new.copy()
    first[1:] |= p[1:] != p[:-1]
    return np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))


def _key_numbers(batch: pa.RecordBatch, n_keys: int) -> tuple[np.ndarray, list[tuple]]:
    """First row of each run of equal keys in a sorted batch, and the keys of the runs."""
    rows = list(zip(*[batch.column(k).to_pylist() for k in range(n_keys)])) if n_keys else [()] * batch.num_rows
    new = np.array([True] + [a != b for a, b in zip(rows, rows[1:])])
    return new, [rows[k] for k in np.flatnonzero(new)]


def tie_ranked(df: DataFrame, keys: Sequence[str], x: str, below: str = "n_below", total: str = "n") -> DataFrame:
    """``df`` with the number of rows of the same key that have a smaller ``x`` (a double), and of all rows of the key.

    Rows with a null ``x`` or key are dropped, as ranks leave them out. One exchange of the rows; two scans of the
    written slices, first for a line a slice and key (its rows, first and last value, rows of the last value), then to
    number the rows. The lines are one a slice and key, and go through the driver.
    """
    keys = list(keys)
    n_keys = len(keys)
    known = reduce(and_, [F.col(c).isNotNull() for c in [*keys, x]])
    rows = _dealt(df.where(known), keys, [x])
    head = rows.select(*keys, F.col(x).cast("double").alias("__x"), "__slice")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new, names = _key_numbers(batch, n_keys)
                p, at = batch.column("__x").to_numpy(zero_copy_only=False), np.flatnonzero(new)
                end, start = np.append(at[1:], len(new)), _tie_starts(p, new)
                columns = [pa.array([name[k] for name in names], batch.schema.field(k).type) for k in range(n_keys)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, batch.column("__slice").take(pa.array(at)), pa.array(end - at), pa.array(p[at]), pa.array(p[end - 1]), pa.array(end - start[end - 1])],
                    names=[*keys, "__slice", "n", "low", "high", "tied"])
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys] + ["__slice long, n long, low double, high double, tied long"])
    found = head.mapInArrow(lines, schema).groupBy(*keys, "__slice", "high").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.sum("tied").alias("tied")) \
        .groupBy(*keys, "__slice").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max(F.struct("high", "tied")).alias("top")).collect()
    at: dict[tuple, dict] = {}
    for r in sorted(found, key=lambda r: r["__slice"]):
        here = at.setdefault(tuple(r[c] for c in keys), {"n": 0, "slices": {}, "high": None, "tied": 0})
        here["slices"][r["__slice"]] = (here["n"], here["high"], here["n"] - here["tied"])
        same = r["low"] == r["top"]["high"] == here["high"]     # the whole slice is the last value again
        here["tied"] = here["tied"] + r["n"] if same else r["top"]["tied"]
        here["n"] += r["n"]
        here["high"] = r["top"]["high"]
    offsets = {k: (v["n"], v["slices"]) for k, v in at.items()}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[int, float, int]] = {}         # rows so far, last value, where its run began
        for batch in batches:
            if not batch.num_rows:
                continue
            new, names = _key_numbers(batch, n_keys)
            p, slice_ = batch.column("__x").to_numpy(zero_copy_only=False), batch.column("__slice")[0].as_py()
            start, at = _tie_starts(p, new), np.flatnonzero(new)
            end = np.append(at[1:], len(new))
            less, every = np.empty(len(p), dtype=np.int64), np.empty(len(p), dtype=np.int64)
            for name, lo, hi in zip(names, at.tolist(), end.tolist()):
                done, last, began = held.get(name) or offsets[name][1][slice_]
                place = start[lo:hi] - lo + done
                if last is not None and p[lo] == last:
                    place[start[lo:hi] == lo] = began
                less[lo:hi], every[lo:hi] = place, offsets[name][0]
                held[name] = (done + hi - lo, float(p[hi - 1]), int(place[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carried] + [pa.array(less), pa.array(every)], names=titles)
    carried, titles = [f"__c{i}" for i in range(len(df.columns))], [*df.columns, below, total]
    wide = rows.select(*keys, F.col(x).cast("double").alias("__x"), "__slice", *[F.col(c).alias(f"__c{i}") for i, c in enumerate(df.columns)])
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + [f"`{below}` long, `{total}` long"])
    return wide.mapInArrow(number, out)
