"""Stratified folds, splits and class-balancing samples.

All of them number the rows of a class by a seeded hash key. The place is carried by the rows
(:func:`.ranking.numbered`): they are dealt and sorted once, over all tasks, so a class holding most of the rows is
numbered by many. A null label is a class; rows without an id are ordered by a hash of the whole row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import seeded_key, seeded_key_any
from .ranking import numbered
from .util import attach_scalar


def _key(df: DataFrame, id_col: str, seed: int):
    integral = df.schema[id_col].dataType.typeName() in ("long", "integer", "short", "byte")
    return seeded_key(id_col, seed) if integral else seeded_key_any(id_col, seed)


def class_positions(df: DataFrame, label: str | None, id_col: str = "id", seed: int = 42,
                    strata: Sequence[str] = ()) -> DataFrame:
    """Adds ``pos`` (0-based position inside the class in seeded order) and ``class_n``.

    Order: seeded hash key, then id; rows without an id by a hash of the row, so that they are spread and ordered alike
    in reruns. The (key, id) pair of others is unique, so the position is a true permutation. ``label=None`` ranks the
    whole table.
    """
    keys = list(strata) + ([label] if label is not None else [])
    k = df.withColumn("__h", F.coalesce(_key(df, id_col, seed), F.xxhash64(*df.columns)))
    return numbered(k, keys, ["__h", id_col], "pos", "class_n").drop("__h")


def stratified_folds(df: DataFrame, label: str, k: int = 5, id_col: str = "id", seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """Per class, shuffled, ``n // k`` rows per fold, the remainder in the last fold."""
    pos = class_positions(df, label, id_col, seed)
    size = F.floor(F.col("class_n") / k)
    fold = F.when(size == 0, F.lit(k - 1)).otherwise(F.least(F.floor(F.col("pos") / size), F.lit(k - 1)))
    return pos.withColumn(out, fold.cast("int")).drop("pos", "class_n")


def stratified_split(df: DataFrame, label: str, test_fraction: float | None = None,
                     test_size: int | None = None, id_col: str = "id", seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """Per class the first ``round(fraction·n_c)`` rows in seeded order (or a total
    ``test_size`` shared in proportion) go to the test side."""
    pos = class_positions(df, label, id_col, seed)
    if test_fraction is not None:
        cut = F.floor(F.col("class_n") * F.lit(float(test_fraction)) + 0.5)
    elif test_size is not None:
        tot = pos.groupBy(label).agg(F.first("class_n").alias("__nc")).agg(F.sum("__nc").alias("__total"))
        pos = attach_scalar(pos, tot)
        cut = F.floor(F.col("class_n") * F.lit(float(test_size)) / F.col("__total") + 0.5)
    else:
        raise ValueError("give test_fraction or test_size")
    return pos.withColumn(out, (F.col("pos") < cut)).drop("pos", "class_n", "__total")


def undersample(df: DataFrame, label: str, id_col: str = "id", seed: int = 42) -> DataFrame:
    """V8: keep, in every class, the first (smallest class size) rows in seeded order."""
    pos = class_positions(df, label, id_col, seed)
    smallest = pos.groupBy(label).agg(F.first("class_n").alias("__n")).agg(F.min("__n").alias("__m"))
    return attach_scalar(pos, smallest).where(F.col("pos") < F.col("__m")).drop("pos", "class_n", "__m")


def exact_sample(df: DataFrame, fraction: float, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Exactly ``int(total · fraction)`` rows, the first ones in seeded hash order.

    Rows are numbered, so the sample is a filter, not a sort-and-limit through one task.
    """
    pos = class_positions(df, None, id_col, seed)
    return pos.where(F.col("pos") < F.floor(F.col("class_n") * F.lit(float(fraction)))).drop("pos", "class_n")


COPY_BLOCK = 10_000   # copies of one row made inside one task at most


def weighted_resample(df: DataFrame, label: str, n: int | None = None, id_col: str = "id",
                      seed: int = 42) -> DataFrame:
    """Resampling with weight 1/class count, so each class contributes ``n / k`` rows.

    Every row is repeated ``floor(r)`` times plus once more when its seeded
    uniform falls below ``frac(r)`` (r = rows wanted / class size): the same
    expected counts as drawing with replacement, decided per row from the id,
    so a recomputed task gives the same rows. Large copy counts (a tiny class)
    are first split into blocks of ``COPY_BLOCK`` that are spread over tasks.
    """
    from ..functions.keys import seeded_unit
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc"))
    shape = counts.agg(F.count(F.lit(1)).alias("__k"), F.sum("__nc").alias("__n"))
    j = attach_scalar(df.join(counts, label), shape)
    want = (F.lit(float(n)) if n is not None else F.col("__n").cast("double")) / F.col("__k")
    rate = want / F.col("__nc")
    copies = F.floor(rate) + (seeded_unit(id_col, seed) < rate - F.floor(rate)).cast("long")
    c = j.withColumn("__copies", copies.cast("long")).where(F.col("__copies") > 0).drop("__nc", "__k", "__n")
    blocks = F.sequence(F.lit(0), F.floor((F.col("__copies") - 1) / COPY_BLOCK).cast("long"))
    spread = (c.withColumn("__block", F.explode(blocks))
              .withColumn("__in_block", F.least(F.lit(COPY_BLOCK).cast("long"),
                                                F.col("__copies") - F.col("__block") * COPY_BLOCK))
              .repartition(id_col, "__block"))
    return (spread.withColumn("__rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__in_block"))))
            .drop("__copies", "__block", "__in_block", "__rep"))


#: Rows whose draws are made together at the end of the halving
DRAW_BLOCK = 4096


def draws_of_range(seed: int, stratum: int, n_draws: int, n_rows: int, lo: int, hi: int) -> np.ndarray:
    """How often the rows ``lo`` to ``hi`` are drawn, of ``n_draws`` with replacement among ``n_rows`` rows.

    The whole range is halved, the draws of the left half being binomial, down to blocks, whose draws are multinomial.
    Every step has a generator of its own (seed, stratum, range), so any task gets the same counts for the same rows,
    and all counts add up to ``n_draws``.
    """
    out = np.zeros(hi - lo, dtype=np.int64)
    todo = [(0, n_rows, n_draws)]
    while todo:
        a, b, n = todo.pop()
        if n == 0 or b <= lo or a >= hi:
            continue
        rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, stratum, a, b])))
        if b - a <= DRAW_BLOCK:
            drawn = rng.multinomial(n, np.full(b - a, 1.0 / (b - a)))
            s, e = max(a, lo), min(b, hi)
            out[s - lo:e - lo] = drawn[s - a:e - a]
            continue
        mid = a + DRAW_BLOCK * (-(-(b - a) // DRAW_BLOCK) // 2)
        left = int(rng.binomial(n, (mid - a) / (b - a)))
        todo += [(a, mid, left), (mid, b, n - left)]
    return out


def draw_with_replacement(df: DataFrame, label: str, n: int | None = None, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Exactly ``n`` draws (default: as many as rows) with replacement, a row's weight being 1 / its class's count.

    A draw's class is even among the classes and its row even within the class; how often each class is drawn is one
    multinomial, and the rows' counts follow from their places in the seeded order of ids (:func:`draws_of_range`): the
    rows are moved once, and reruns or retried tasks draw the same. Rows drawn very often are spread over tasks.
    """
    rows = class_positions(df, label, id_col, seed)
    totals = rows.groupBy(label).agg(F.first("class_n").alias("n")).orderBy(label).collect()
    n = sum(r["n"] for r in totals) if n is None else n
    rng = np.random.Generator(np.random.Philox(np.random.SeedSequence([seed, len(totals)])))
    shares = rng.multinomial(n, np.full(len(totals), 1.0 / len(totals))).tolist() if totals else []
    drawn = {r[label]: (k, int(share), r["n"]) for k, (r, share) in enumerate(zip(totals, shares))}
    order = F.coalesce(*[F.when(F.col(label).eqNullSafe(F.lit(v)), F.lit(k)) for v, (k, _, _) in drawn.items()]) if drawn else F.lit(0)
    parts = {k: (share, size) for k, share, size in drawn.values()}

    @F.pandas_udf("long")
    def copies(stratum: pd.Series, pos: pd.Series) -> pd.Series:
        out = np.zeros(len(pos), dtype=np.int64)
        at, place = stratum.to_numpy(), pos.to_numpy()
        for k in np.unique(at):
            mine = np.flatnonzero(at == k)
            share, size = parts[int(k)]
            blocks = place[mine] // DRAW_BLOCK
            for b in np.unique(blocks):
                here = mine[blocks == b]
                lo = int(place[here].min())
                out[here] = draws_of_range(seed, int(k), share, size, lo, int(place[here].max()) + 1)[place[here] - lo]
        return pd.Series(out)
    counted = rows.withColumn("__copies", copies(order, F.col("pos"))).where("__copies > 0").drop("pos", "class_n")
    few = counted.where(F.col("__copies") <= COPY_BLOCK).withColumn("__rep", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("__copies") - 1) / COPY_BLOCK))
    many = counted.where(F.col("__copies") > COPY_BLOCK).withColumn("__block", F.explode(blocks)).repartition(id_col, "__block")
    many = many.withColumn("__rep", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPY_BLOCK).cast("long"), F.col("__copies") - F.col("__block") * COPY_BLOCK))))
    return few.drop("__copies", "__rep").unionByName(many.drop("__copies", "__block", "__rep"))


def synthetic_ids(df: DataFrame, out: str = "id", prefix: str = "W", width: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """consecutive ids ``W0, W1, …`` (``width`` zero-pads, e.g. ``W0000000012``) for rows without one.

    In the order of ``order``, else in scan order: then the rows are not moved at all, only written once with their
    index in the task, and a table of a row a task gives the offsets.
    """
    rows = numbered(df, [], list(order), "__pos")
    num = F.col("__pos").cast("string") if width is None else F.lpad(F.col("__pos").cast("string"), width, "0")
    return rows.withColumn(out, F.concat(F.lit(prefix), num)).drop("__pos")
