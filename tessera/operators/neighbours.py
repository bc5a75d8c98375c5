"""Exact nearest neighbours by pivot cells.

1. Equal vectors are one *point*, with its ``k + 1`` smallest ids: a group of copies of any size is looked up once and
   answers for all its rows. Ids per point are cut by a row-number limit, which Spark applies before the shuffle.
2. ``PIVOTS`` points at most, drawn by a hash of the vector, are pivots; every point lies in the cell of its nearest
   pivot. Dense regions have many pivots, as they have many points.
3. Cells are put together to blocks of neighbouring cells, of at most ``chunk`` points (a larger cell is one of its own).
   Points and blocks meet in groups of at most ``chunk`` points a side, by a shuffle; inside, each point is compared only
   with the cells that it asks for. What is shuffled grows by points times blocks, not points times cells.
4. Each point asks its own cell first. Its ``k``-th distance there, or the bound that the pivots' own nearest points give,
   whichever is less, is the radius that it still has to search.
5. A second round sends a point only to blocks with cells that may hold something within that radius, by the triangle
   inequality: cell j with pivot distances in [low, high] lies at least ``max(low - d, d - high)`` away from a point at
   distance d of the pivot, and at least ``(d**2 - own**2) / (2 * |p_j - p_own|)`` beyond the plane between the pivots.
6. Both rounds' results meet in the k nearest of each point, ties by id, and then of each row without itself.

The result is exact. What the second round costs depends on the data: clustered vectors meet few cells; vectors without
any structure in many dimensions meet most of them, as for any exact method: then all pairs are compared, a matrix product
and one comparison a pair, spread over the groups. ``chunk`` falls with the dimensions (``GROUP_VALUES``) and with the
number of points, so that a group stays small and there are many. Only pivots and a row of sizes and distances a cell go
through the driver. Vectors null or holding null or non-finite values take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PIVOTS, CHUNK, CELL = 1024, 32768, 2048
# Values of the vectors of one side of a group, at most (16 MB); sides that a small table is cut into.
GROUP_VALUES, SIDES = 1 << 21, 8
_SLACK = 1e-9


def nearest(x: np.ndarray, base: np.ndarray, k: int, block: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows of ``base`` (all, if fewer) for each row of ``x``: (indices, distances), ties by lower index."""
    k = min(k, len(base))
    if k <= 0 or not len(x):
        return np.zeros((len(x), 0), dtype=np.int64), np.zeros((len(x), 0))
    squares = (base * base).sum(axis=1)
    at, distance = np.empty((len(x), k), dtype=np.int64), np.empty((len(x), k))
    for s in range(0, len(x), block):
        part = x[s:s + block]
        mine = (part * part).sum(axis=1)
        # the expanded form only picks candidates, with room for its rounding; they are ranked by exact distances
        rough = mine[:, None] + squares[None, :] - 2.0 * part @ base.T
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1]
        row, col = np.nonzero(rough <= (kth + _SLACK * (1.0 + mine + squares.max()))[:, None])
        exact = np.sqrt(((part[row] - base[col]) ** 2).sum(axis=1))
        order = np.lexsort((col, exact, row))
        row, col, exact = row[order], col[order], exact[order]
        take = np.searchsorted(row, np.arange(len(part)))[:, None] + np.arange(k)
        at[s:s + len(part)], distance[s:s + len(part)] = col[take], exact[take]
    return at, distance


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances [rows, pivots]."""
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2.0 * x @ pivots.T, 0.0))


def _celled(pivots: np.ndarray):
    """Adds each point's cell and its distance to the pivot."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lo in range(0, len(frame), 4096):
                part = frame.iloc[lo:lo + 4096]
                d = _to_pivots(np.stack(part["f"].to_numpy()).astype(float), pivots)
                cell = d.argmin(axis=1)
                yield part.assign(cell=cell.astype(np.int64), out=d[np.arange(len(part)), cell])
    return run


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and sizes.min() != sizes.max():
        raise ValueError("vectors of different lengths")
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(len(lists), -1)


def _lists(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All items of the lists, and where the lists begin and end."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten(), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _nearest_in_cells(x: np.ndarray, wanted: np.ndarray, radius: np.ndarray, base: np.ndarray, bounds: np.ndarray, tie: np.ndarray, k: int, rows: int = 512):
    """For each row of ``x`` the k nearest base rows, of cells ``c`` (rows ``bounds[c]:bounds[c + 1]``) with ``wanted[row, c]``.

    Those farther than ``radius`` may miss. Yields (rows of x, rows of base, distances), k a row at most, ties by lower ``tie``.
    """
    squares = (base * base).sum(axis=1)
    across = np.concatenate([-2.0 * base, squares[:, None]], axis=1).T
    most = squares.max(initial=0.0)
    for lo in range(0, len(x), rows):
        part = x[lo:lo + rows]
        mine = (part * part).sum(axis=1)
        asked = np.concatenate([part, np.ones((len(part), 1))], axis=1)
        room = _SLACK * (1.0 + mine + most)
        # distances**2 less |x|**2, with room for rounding: below this lie the candidates; exact distances rank them
        with np.errstate(over="ignore"):
            least = radius[lo:lo + rows] ** 2 - mine + room
        row, col, exact = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for c in range(len(bounds) - 1):
            need = np.flatnonzero(wanted[lo:lo + rows, c])
            for s in range(bounds[c], bounds[c + 1] if len(need) else 0, CELL):
                e = min(s + CELL, bounds[c + 1])
                rough = (asked if len(need) == len(part) else asked[need]) @ across[:, s:e]
                near = rough <= least[need][:, None]
                if e - s > k and np.count_nonzero(near) > 4 * k * len(need):
                    least[need] = np.minimum(least[need], np.partition(rough, k - 1, axis=1)[:, k - 1] + 2 * room[need])
                    near = rough <= least[need][:, None]
                r, j = np.nonzero(near)
                if not len(r):
                    continue
                r, j = need[r], j + s
                row, col, exact = np.concatenate([row, r]), np.concatenate([col, j]), np.concatenate([exact, np.sqrt(((part[r] - base[j]) ** 2).sum(axis=1))])
                order = np.lexsort((tie[col], exact, row))
                row, col, exact = row[order], col[order], exact[order]
                first = np.searchsorted(row, np.arange(len(part)))
                place = np.arange(len(row)) - first[row]
                full = row[place == k - 1]
                least[full] = np.minimum(least[full], exact[place == k - 1] ** 2 - mine[full] + 2 * room[full])
                kept = place < k
                row, col, exact = row[kept], col[kept], exact[kept]
        yield row + lo, col, exact


def _compared(k: int):
    """The nearest owners (of the k nearest base points) for each asking point of a group."""
    def run(asks: pa.Table, base: pa.Table) -> pa.Table:
        asks, base = asks.combine_chunks(), base.combine_chunks()
        column = lambda table, name: table[name].chunk(0) if table[name].num_chunks else pa.array([], table[name].type)
        (owners, begins), (asked, ends) = _lists(column(base, "owners")), _lists(column(asks, "cells"))
        # cells one after the other; equally near points by their first ids
        at = pa.table({"cell": column(base, "cell"), "id": owners.field("id").take(pa.array(begins[:-1]))})
        order = pc.sort_indices(at, [("cell", "ascending"), ("id", "ascending")]).to_numpy()
        tie = np.empty(len(order), dtype=np.int64)
        tie[pc.sort_indices(at, [("id", "ascending")]).to_numpy()] = np.arange(len(order))
        cells, bounds = np.unique(at["cell"].to_numpy()[order], return_index=True)
        asked = asked.to_numpy(zero_copy_only=False)
        who, place = np.repeat(np.arange(asks.num_rows), np.diff(ends)), np.searchsorted(cells, asked)
        here = np.append(cells, -1)[place] == asked
        wanted = np.zeros((asks.num_rows, len(cells)), dtype=bool)
        wanted[who[here], place[here]] = True
        found = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        if asks.num_rows and base.num_rows:
            x, b = _matrix(column(asks, "f")), _matrix(column(base, "f"))[order]
            for row, col, far in _nearest_in_cells(x, wanted, asks["radius"].to_numpy(), b, np.append(bounds, len(order)), tie[order], k):
                start = begins[order[col]]
                many = begins[order[col] + 1] - start
                owner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start, many)
                found.append((np.repeat(row, many), np.repeat(far, many), owner))
        row, far, owner = (np.concatenate(v) for v in zip(*found))
        first = np.flatnonzero(np.diff(row, prepend=-1))
        near = pa.StructArray.from_arrays([pa.array(far), owners.field("id").take(pa.array(owner)), owners.field("label").take(pa.array(owner))], ["distance", "id", "label"])
        return pa.table({"point": column(asks, "point").take(pa.array(row[first])), "near": pa.ListArray.from_arrays(pa.array(np.append(first, len(row)).astype(np.int32)), near)})
    return run


def _blocks(pivots: np.ndarray, sizes: np.ndarray, chunk: int) -> np.ndarray:
    """Each cell's block: from cell to nearest cell not yet in one, of at most ``chunk`` points unless one cell has more."""
    between, left = _to_pivots(pivots, pivots), np.ones(len(pivots), dtype=bool)
    block, at, number, held = np.zeros(len(pivots), dtype=np.int64), 0, 0, 0
    for _ in range(len(pivots)):
        left[at] = False
        if held and held + sizes[at] > chunk:
            number, held = number + 1, 0
        block[at], held = number, held + sizes[at]
        at = int(np.where(left, between[at], np.inf).argmin())
    return block


def _bounded(pivots: np.ndarray, block: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray, k: int):
    """The other cells that may hold something within each point's radius, a row a point and block."""
    between = _to_pivots(pivots, pivots)
    by_block = np.argsort(block, kind="stable")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                d, own = _to_pivots(_matrix(part.column("f")), pivots), part.column("cell").to_numpy()
                radius = part.column("radius").to_numpy()
                # k owners lie within the k smallest of (distance to a pivot + its nearest points' distances)
                by_pivots = np.full(len(own), np.inf)
                for s in range(0, len(own), 64):
                    sums = (d[s:s + 64, :, None] + first[None, :, :]).reshape(len(d[s:s + 64]), -1)
                    by_pivots[s:s + 64] = np.partition(sums, k - 1, axis=1)[:, k - 1]
                radius = np.minimum(radius, by_pivots)
                mine = d[np.arange(len(own)), own]
                gap = between[own]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = np.where(gap > 0, (d * d - (mine * mine)[:, None]) / (2 * gap), 0.0)
                away = np.maximum(np.maximum(low[None, :] - d, d - high[None, :]), plane)
                radius = radius + 1e-7 * (1.0 + radius + mine)
                meet = away <= radius[:, None]
                meet[np.arange(len(own)), own] = False
                meet &= np.isfinite(low)[None, :]
                row, cell = np.nonzero(meet[:, by_block])
                cell = by_block[cell]
                start = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(block[cell], prepend=-1) != 0))
                take, ends = pa.array(row[start]), pa.array(np.append(start, len(row)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("point").take(take), part.column("f").take(take), pa.array(radius[row[start]]), pa.array(block[cell[start]]),
                                                  pa.ListArray.from_arrays(ends, pa.array(cell.astype(np.int64)))], ["point", "f", "radius", "block", "cells"])
    return run


def _chunks(n: str, chunk: int):
    return F.ceil(F.col(n) / chunk).cast("int")


def _meet(asks: DataFrame, base: DataFrame, k: int, chunk: int, near: str) -> DataFrame:
    """Points (point, f, radius, block, cells) against the base points (f, owners, cell, block) of their block, chunk by chunk."""
    n_asks = asks.groupBy("block").agg(F.count(F.lit(1)).alias("n_asks"))
    n_base = base.groupBy("block").agg(F.count(F.lit(1)).alias("n_base"))
    sizes = F.broadcast(cut_lineage(n_asks.join(n_base, "block").select("block", _chunks("n_asks", chunk).alias("a_parts"), _chunks("n_base", chunk).alias("b_parts"))))
    part = lambda parts, salt: F.pmod(F.xxhash64("f", F.lit(salt)), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = asks.join(sizes, "block").withColumn("i", part("a_parts", 1)).withColumn("j", every("b_parts")).select(*[F.col(c).alias(c) for c in ("block", "i", "j", "point", "f", "radius", "cells")])
    right = base.join(sizes, "block").withColumn("j", part("b_parts", 2)).withColumn("i", every("a_parts")).select(*[F.col(c).alias(c) for c in ("block", "i", "j", "f", "owners", "cell")])
    keys = ["block", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_compared(k), f"point long, near {near}")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest owners of each point, of several lists of at most k."""
    return found.groupBy("point").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))


def exact_neighbours(rows: DataFrame, k: int, itself: bool, pivots: int = PIVOTS, chunk: int = CHUNK) -> DataFrame:
    """``rows`` (id, label, asks, f) to id, neighbor_id, rank, distance, neighbor_label.

    With ``itself`` all rows ask and are asked, a row not itself; else those with ``asks`` ask the others.
    """
    id_type = rows.schema["id"].dataType.simpleString()
    owner, near = f"array<struct<id:{id_type},label:int>>", f"array<struct<distance:double,id:{id_type},label:int>>"
    finite = F.forall("f", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # one sort of a signed zero, so that equal vectors are equal keys
    rows = rows.where(finite).withColumn("f", F.transform("f", lambda x: x + F.lit(0.0)))
    asked, asking = (rows, rows) if itself else (rows.where("not asks"), rows.where("asks"))
    wanted = k + 1 if itself else k
    first = asked.withColumn("place", F.row_number().over(Window.partitionBy("f").orderBy("id"))).where(F.col("place") <= wanted)
    base = first.groupBy("f").agg(F.sort_array(F.collect_list(F.struct("id", "label"))).cast(owner).alias("owners"))
    base = cut_lineage(base)
    points = cut_lineage(asking.select("f").distinct().withColumn("point", F.monotonically_increasing_id()))
    n = base.count()
    size = max(1, min(pivots, -(-2 * n // min(chunk, CELL))))
    drawn = base.select("f", F.xxhash64("f").alias("h")).orderBy("h", "f").limit(size).collect()
    if not drawn:
        return rows.sparkSession.createDataFrame([], f"id {id_type}, neighbor_id {id_type}, rank int, distance double, neighbor_label int")
    at = np.array([r["f"] for r in drawn], dtype=float)
    chunk = max(1, min(chunk, GROUP_VALUES // max(1, at.shape[1]), max(CELL, -(-n // SIDES))))
    base = cut_lineage(base.mapInPandas(_celled(at), f"f array<double>, owners {owner}, cell long, out double"))
    points = cut_lineage(points.mapInPandas(_celled(at), "f array<double>, point long, cell long, out double"))
    low, high, sizes = np.full(len(drawn), np.inf), np.full(len(drawn), -np.inf), np.zeros(len(drawn), dtype=np.int64)
    for r in base.groupBy("cell").agg(F.min("out").alias("low"), F.max("out").alias("high"), F.count(F.lit(1)).alias("n")).collect():
        low[r["cell"]], high[r["cell"]], sizes[r["cell"]] = r["low"] - 1e-7 * (1 + r["low"]), r["high"] + 1e-7 * (1 + r["high"]), r["n"]
    block = _blocks(at, sizes, chunk)
    blocks = F.broadcast(rows.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(block)], "cell long, block long"))
    in_blocks = base.join(blocks, "cell").select("f", "owners", "cell", "block")
    own = points.join(blocks, "cell").select("point", "f", F.lit(float("inf")).alias("radius"), "block", F.array("cell").alias("cells"))
    best = _best(_meet(own, in_blocks, wanted, chunk, near), wanted)
    if len(drawn) > 1:
        best = cut_lineage(best)
        closest = np.full((len(drawn), wanted), np.inf)
        inner = base.withColumn("place", F.row_number().over(Window.partitionBy("cell").orderBy("out"))).where(F.col("place") <= wanted)
        for r in inner.select("cell", "place", "out").collect():
            closest[r["cell"], r["place"] - 1] = r["out"]
        radius = F.when(F.size("near") >= wanted, F.element_at("near", -1)["distance"]).otherwise(F.lit(float("inf")))
        reach = points.join(best.select("point", radius.alias("radius")), "point", "left").withColumn("radius", F.coalesce("radius", F.lit(float("inf"))))
        # counted and then made again: that is less than writing every visit down
        visits = cut_lineage(reach.select("point", "f", "cell", "radius")).mapInArrow(_bounded(at, block, low, high, closest, wanted),
                                                                                     "point long, f array<double>, radius double, block long, cells array<long>")
        more = _meet(visits, in_blocks, wanted, chunk, near)
        best = _best(best.unionByName(more), wanted)
    answered = asking.select("id", "f").join(points.select("f", "point"), "f").join(best, "point")
    mine = F.filter("near", lambda o: o["id"] != F.col("id")) if itself else F.col("near")
    return answered.select("id", F.posexplode(F.slice(mine, 1, k)).alias("place", "o")) \
        .select("id", F.col("o.id").alias("neighbor_id"), (F.col("place") + 1).alias("rank"), F.col("o.distance").alias("distance"), F.col("o.label").alias("neighbor_label"))
