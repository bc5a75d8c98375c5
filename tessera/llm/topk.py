"""Exact top-k inner-product search over a bit-sliced index.

Each vector component is quantised to ``floor(scale * x)``. Rows are dealt into blocks of about
``BLOCK_ROWS``; in a block every component is stored as bit slices: bitmap ``i`` has bit ``r`` set if
row ``r`` has bit ``i`` of (component - smallest). For a query, ``sum |q_d| * v_d`` (``v_d`` the slices of
component d, complemented where q_d < 0) is formed by adding bitmaps column by column with carry-save
adders, which gives the bit slices of all rows' scores at once. The low ``skip`` bits of the
components are left out of that sum, which makes it too small by at most a known slack. The k-th
largest sum is found from the most significant slice downward; all rows within the slack of it (the
boundary rows) get their score computed exactly, so the result is exact.

Queries are held in blocks of ``QUERY_ROWS`` and meet each index block once: the stated query set
against all rows, block by block. A block returns at most k rows a query, so what is shuffled to
the final ranking is k * blocks rows a query.

Wide vectors, with a component of 2**28 or more after quantising, do not fit the int32 slices. They and the
queries they meet go through :func:`_wide_search`: components in slices of ``LIMB`` bits, as many as the largest needs,
products of slices added up by weight and carried, rows ordered from the most significant slice downward.

Edge cases: a vector that is null or holds a null or non-finite component takes no part, nor does a null id; scores beyond a
long rank by their exact value and are reported as the nearest long; shorter vectors count as padded with zeros;
empty vectors score 0; rows that repeat an id are candidates each, except for queries of that id; a
repeated query id is asked once, with its smallest vector; ties go to the smaller id; with fewer than
k rows all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.scratch import Scratch

SCALE, K = 1024, 10
BLOCK_ROWS, QUERY_ROWS = 16_384, 1_024
#: Low bits of the components left out of the sliced sum
SKIP = 3
#: Quantised values from here on are wide
LIMIT = 1 << 28
#: Bits of a slice of wide values, and slices' sums that a task holds at once
LIMB, HELD_SUMS = 16, 1 << 23
FOUND = "query_id long, vec_id long, score long, over int, beyond binary"


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, q array<long>, x array<double>) of the vectors that take part; q is null where one is wide, x elsewhere."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    fine = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    wide = F.exists("x", lambda v: F.abs(v * scale) >= LIMIT)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(fine)
    return rows.select("vec_id", F.when(~wide, F.transform("x", lambda v: F.floor(v * scale))).alias("q"), F.when(wide, F.col("x")).alias("x"))


def _matrix(rows: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), dtype=np.int64)
    for k, v in enumerate(rows):
        out[k, :len(v)] = v
    return out


def _slices(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bit slices of a block: smallest value per component, bitmaps [dims, bits, words]."""
    low = values.min(axis=0)
    rest = (values - low).astype(np.uint64)
    bits = max(1, int(rest.max()).bit_length())
    words = -(-len(values) // 64)
    out = np.zeros((values.shape[1], bits, words * 8), dtype=np.uint8)
    for i in range(bits):
        flags = ((rest >> np.uint64(i)) & np.uint64(1)).astype(np.uint8).T
        packed = np.packbits(flags, axis=1, bitorder="little")
        out[:, i, :packed.shape[1]] = packed
    return low, out.view(np.uint64)


def _add(columns: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sum of bitmaps by weight: full adders turn three bitmaps of a weight into one and a carry."""
    total, at = [], 0
    while at < len(columns):
        stack = columns[at]
        have = np.concatenate(stack) if len(stack) > 1 else (stack[0] if stack else None)
        if have is None:
            total.append(None)
            at += 1
            continue
        carries = []
        while len(have) > 1:
            third = len(have) // 3
            if third:
                a, b, c = have[:third], have[third:2 * third], have[2 * third:3 * third]
                ab = a ^ b
                carries.append((a & b) | (ab & c))
                have = np.concatenate([ab ^ c, have[3 * third:]]) if len(have) > 3 * third else ab ^ c
            else:
                a, b = have[:1], have[1:]
                carries.append(a & b)
                have = a ^ b
        total.append(have[0])
        if carries:
            if at + 1 == len(columns):
                columns.append([])
            columns[at + 1].extend(carries)
        at += 1
    return total


def _top(total: list[np.ndarray | None], everyone: np.ndarray, k: int) -> int:
    """The k-th largest value of a sliced sum, from the most significant slice downward."""
    above, equal, value = 0, everyone, 0
    for i in range(len(total) - 1, -1, -1):
        ones = equal & total[i] if total[i] is not None else np.zeros_like(equal)
        n = int(np.bitwise_count(ones).sum())
        if above + n >= k:
            equal, value = ones, value | 1 << i
        else:
            above, equal = above + n, equal & ~ones
    return value


def _at_least(total: list[np.ndarray | None], everyone: np.ndarray, least: int) -> np.ndarray:
    """Bitmap of the rows whose sliced sum is at least ``least``."""
    if least <= 0:
        return everyone
    if least.bit_length() > len(total):
        return np.zeros_like(everyone)
    more, equal = np.zeros_like(everyone), everyone
    for i in range(len(total) - 1, -1, -1):
        ones = total[i] if total[i] is not None else np.zeros_like(everyone)
        if least >> i & 1:
            equal = equal & ones
        else:
            more, equal = more | (equal & ones), equal & ~ones
    return more | equal


class BlockIndex:
    """Bit-sliced index of one block of rows."""

    def __init__(self, ids: np.ndarray, values: np.ndarray, skip: int = SKIP):
        self.ids, self.values = ids, values
        low, maps = _slices(values)
        self.low = low
        self.skip = min(skip, maps.shape[1] - 1)
        self.maps = np.ascontiguousarray(maps[:, self.skip:])
        flags = np.zeros(maps.shape[2] * 64, dtype=np.uint8)
        flags[:len(ids)] = 1
        self.everyone = np.packbits(flags, bitorder="little").view(np.uint64)
        self.flipped = ~self.maps & self.everyone

    def query(self, query: np.ndarray, k: int) -> np.ndarray:
        """Positions of rows that hold the k best scores (and perhaps a few more)."""
        if len(self.ids) <= k:
            return np.arange(len(self.ids))
        weight = np.abs(query)
        bits = self.maps.shape[1]
        columns: list[list[np.ndarray]] = [[] for _ in range(bits + int(weight.max()).bit_length())]
        for j in range(int(weight.max()).bit_length()):
            on = (weight >> j & 1).astype(bool)
            for sign, maps in ((query > 0, self.maps), (query < 0, self.flipped)):
                mine = np.flatnonzero(on & sign)
                if len(mine):
                    picked = maps[mine]
                    for i in range(bits):
                        columns[i + j].append(picked[:, i])
        total = _add(columns)
        slack = int(weight.sum()) * ((1 << self.skip) - 1)
        # sums are in units of 2**skip; a row's full sum is less than slack above its sliced one
        least = _top(total, self.everyone, k) - (slack >> self.skip) - 1
        near = _at_least(total, self.everyone, least)
        return np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))


def _search(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, index = None, None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if held != row.block:
                    dims = row.dims
                    values = np.frombuffer(row.rows, dtype=np.int32).reshape(-1, dims).astype(np.int64) if dims else np.zeros((len(row.ids) // 8, 0), np.int64)
                    held, index = row.block, BlockIndex(np.frombuffer(row.ids, dtype=np.int64), values) if dims else None
                ids = np.frombuffer(row.ids, dtype=np.int64)
                asked = np.frombuffer(row.query_ids, dtype=np.int64)
                queries = np.frombuffer(row.queries, dtype=np.int32).reshape(len(asked), -1).astype(np.int64)
                out = []
                for query_id, q in zip(asked, queries):
                    at = index.query(q, k + 1) if index is not None else np.arange(len(ids))
                    at = at[ids[at] != query_id]
                    if len(at) < k and len(ids) > k + 1:  # the query's id is repeated here
                        at = np.flatnonzero(ids != query_id)
                    score = index.values[at] @ q if index is not None else np.zeros(len(at), np.int64)
                    best = np.lexsort((ids[at], -score))[:k]
                    out.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[at][best], "score": score[best]}))
                yield pd.concat(out, ignore_index=True) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    return run


def _limbs(part: pd.DataFrame, dims: int, scale: int) -> np.ndarray:
    """Values of rows as slices [limb, row, dim] of LIMB bits, the last one signed."""
    out = np.zeros((len(part), dims), dtype=object)
    for at, (q, x) in enumerate(zip(part["q"], part["x"])):
        # a product beyond a double comes from a whole number
        whole = q if q is not None else [int(np.floor(v * scale)) if np.isfinite(v * scale) else int(v) * scale for v in x]
        out[at, :len(whole)] = [int(v) for v in whole]
    limbs, low = [], (1 << LIMB) - 1
    while out.size and (out.min() < -(1 << 62) or out.max() >= 1 << 62):
        limbs.append((out & low).astype(np.int64))
        out = out >> LIMB
    rest = out.astype(np.int64)
    while rest.size and (rest.min() < -(1 << LIMB - 1) or rest.max() >= 1 << LIMB - 1):
        limbs.append(rest & low)
        rest = rest >> LIMB
    return np.stack([*limbs, rest])


def _sums(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as carried slices [limb, query, row], least significant first, the last one signed."""
    total = np.zeros((len(queries) + len(rows) + 2, queries.shape[1], rows.shape[1]), dtype=np.int64)
    for i, q in enumerate(queries.astype(np.float64)):
        for j, v in enumerate(rows.astype(np.float64)):
            for d in range(0, q.shape[1], 4096):      # exact in a double: 2 * LIMB + 12 bits
                total[i + j] += (q[:, d:d + 4096] @ v[:, d:d + 4096].T).astype(np.int64)
    for i in range(len(total) - 1):
        total[i + 1] += total[i] >> LIMB
        total[i] &= (1 << LIMB) - 1
    return total


def _wide_search(k: int, scale: int, width: int):
    """The k best of each block of rows for each query of a block, with ``width`` bytes for scores beyond a long."""
    def run(part: pd.DataFrame) -> pd.DataFrame:
        asked, rows = part[part["asks"]], part[~part["asks"]]
        ids = rows["vec_id"].to_numpy(np.int64)
        dims = max(len(v) for c in ("q", "x") for v in part[c] if v is not None)
        values, queries = _limbs(rows, dims, scale), _limbs(asked, dims, scale)
        step = max(1, HELD_SUMS // max(1, len(ids) * (len(values) + len(queries) + 2)))
        out = []
        for at in range(0, len(asked), step):
            sums = _sums(queries[:, at:at + step], values)
            for n, query_id in enumerate(asked["vec_id"].iloc[at:at + step].tolist()):
                order = np.lexsort((ids, *-sums[:, n]))
                for row in order[ids[order] != query_id][:k].tolist():
                    score = sum(int(limb) << LIMB * i for i, limb in enumerate(sums[:, n, row]))
                    near = min(max(score, -(1 << 63)), (1 << 63) - 1)
                    out.append((query_id, int(ids[row]), near, (score > near) - (score < near), None if score == near else (score + (1 << 8 * width - 1)).to_bytes(width, "big")))
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "over", "beyond"])
    return run


def _dealt(blocks: int) -> Column:
    """A block for each row of a written table, equal rows apart."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))


def _wide(rows: DataFrame, queries: DataFrame, n_wide: int, n_rows: int, n_queries: int, n_wide_queries: int, dims: int, k: int, scale: int, block_rows: int, query_rows: int) -> DataFrame:
    """Scores of wide rows for all queries, and of the other rows for wide queries (FOUND)."""
    largest = rows.agg(F.max(F.array_max(F.transform("x", lambda v: F.abs(v))))).first()[0]
    # twice the bits of the largest value and those of the number of products, and a sign
    width = (2 * ((int(largest) + 1) * scale).bit_length() + dims.bit_length() + 2) // 8 + 1
    block_rows = max(64, min(block_rows, (1 << 21) // dims))
    query_rows = max(64, min(query_rows, (1 << 21) // dims))
    parts = []
    for are_wide, n_row, asked, n_asked in ((True, n_wide, queries, n_queries), (False, n_rows - n_wide, queries.where("x is not null"), n_wide_queries)):
        blocks, query_blocks = max(1, -(-n_row // block_rows)), max(1, -(-n_asked // query_rows))
        mine = rows.where(F.col("x").isNotNull() if are_wide else F.col("x").isNull())
        mine = mine.select(F.lit(False).alias("asks"), "vec_id", "q", "x", _dealt(blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>")).alias("query_block"))
        asked = asked.select(F.lit(True).alias("asks"), "vec_id", "q", "x", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("block"), F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).alias("query_block"))
        if n_row and n_asked:
            parts.append(mine.union(asked).groupBy("block", "query_block").applyInPandas(_wide_search(k, scale, width), FOUND))
    return parts[0] if len(parts) == 1 else parts[0].union(parts[1])


def _blocks(ids: str, rows: str, key: str, dims: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id", kind="stable")
        values = _matrix(part["q"], dims).astype(np.int32)
        return pd.DataFrame({key: [part[key].iloc[0]], "dims": [dims], ids: [part["vec_id"].to_numpy(np.int64).tobytes()], rows: [values.tobytes()]})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row of ``is_query``, its own id excepted."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    every = scratch.table(quantised(vectors, scale), "quantised")
    size = F.coalesce(F.max(F.size("q")), F.lit(0)).alias("dims"), F.coalesce(F.max(F.size("x")), F.lit(0)).alias("wide_dims")
    n_every, rows, dims, wide_dims = every.agg(F.count(F.lit(1)), F.count("q"), *size).first()
    # a repeated query id is asked once, with its smallest vector
    all_queries = every.where(is_query).groupBy("vec_id").agg(F.min(F.struct("x", "q")).alias("v")).select("vec_id", "v.q", "v.x")
    n_all_queries, n_queries = all_queries.agg(F.count(F.lit(1)), F.count("q")).first()
    q, queries = every.where("q is not null").select("vec_id", "q"), all_queries.where("q is not null").select("vec_id", "q")
    blocks, query_blocks = max(1, -(-rows // block_rows)), max(1, -(-n_queries // query_rows))
    index = q.withColumn("block", _dealt(blocks)).groupBy("block").applyInPandas(
        _blocks("ids", "rows", "block", dims), "block long, dims int, ids binary, rows binary")
    asked = queries.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks))).groupBy("query_block").applyInPandas(
        _blocks("query_ids", "queries", "query_block", dims), "query_block long, dims int, query_ids binary, queries binary").drop("dims")
    index = scratch.table(index, "index")
    # each index block meets each query block once
    met = index.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<bigint>"))).join(asked, "query_block")
    # a task a pair of blocks at most; a task's pairs come by block, whose index is built once
    spread = met.repartition(max(1, min(blocks * query_blocks, 4096)), "block", "query_block").sortWithinPartitions("block")
    found = spread.select("block", "dims", "ids", "rows", "query_ids", "queries").mapInPandas(_search(k), "query_id long, vec_id long, score long")
    found = found.select("*", F.lit(0).alias("over"), F.lit(None).cast("binary").alias("beyond"))
    if rows < n_every:
        found = found.union(_wide(every, all_queries, n_every - rows, n_every, n_all_queries, n_all_queries - n_queries, max(dims, wide_dims, 1), k, scale, block_rows, query_rows))
    order = Window.partitionBy("query_id").orderBy(F.col("over").desc(), F.col("score").desc(), F.col("beyond").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
