"""Benchmark decontamination: broadcast set of normalised test n-grams, scanned over token windows.

Benchmark items and documents are lower-cased (A-Z) and cut into words. A window is
``width`` consecutive words of an item; a shorter item (of one word at least) is one window.
The set of windows is shipped to every task; each document's word windows are looked up by
hash and every hit is verified on the words themselves.

The set is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows, so its size has a bound
whatever the benchmark's size; with more than one block the documents are scanned once a block, each row
carrying its hits so far, and written between two blocks, so that one block at a time is in memory.

Edge cases: null or empty texts and items have no words and no windows; repeated document ids
(and null ones) are reported once per row; repeated items each
count; items without an id are hit like others but not named among ``items``; empty tables give empty results (no benchmark: nothing is hit).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tessera.llm.codes import ALNUM, LOWER, Lookup, Words, slices, windows, words_of
from tessera.llm.scratch import Scratch

WIDTH = 10
BLOCK_WINDOWS = 1_000_000

SPANS = "array<struct<first:int,last:int>>"
HITS = f"doc_id long, n_words long, spans {SPANS}, items array<string>"


def _window_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            w = words_of(batch.column("text"), ALNUM)
            norm = LOWER[w.data]
            out: dict[str, list] = {"width": [], "window": [], "item": []}
            for row, item in enumerate(batch.column("item").to_pylist()):
                lo, hi = w.first[row], w.first[row + 1]
                size = min(width, hi - lo)
                for at in range(lo, hi - size + 1 if size else lo):
                    out["width"].append(int(size))
                    out["window"].append(b" ".join(norm[w.start[k]:w.end[k]].tobytes() for k in range(at, at + size)))
                    out["item"].append(item)
            yield pa.RecordBatch.from_arrays([pa.array(out["width"], pa.int32()), pa.array(out["window"], pa.binary()), pa.array(out["item"], pa.string())], names=["width", "window", "item"])
    return run


def benchmark_windows(bench: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct (width, window, item) of a benchmark (item_id, text); windows of items without an id have a null item."""
    rows = bench.select(F.col("item_id").cast("string").alias("item"), "text")
    return rows.mapInArrow(_window_rows(width), "width int, window binary, item string").distinct()


class _Block:
    """Windows of one broadcast block: by width, a hash lookup, their words and their items."""

    def __init__(self, rows: list[tuple[int, bytes, str]]):
        self.by: dict[int, tuple[Lookup, list[bytes], list[list[str]]]] = {}
        for width in sorted({r[0] for r in rows}):
            items: dict[bytes, list[str]] = {}
            for w, window, item in rows:
                if w == width:
                    owners = items.setdefault(window, [])
                    if item is not None:
                        owners.append(item)
            keys = list(items)
            hashes = windows_of_lines(pa.array(keys, pa.binary()), width)
            self.by[width] = (Lookup(hashes), keys, [items[k] for k in keys])


def windows_of_lines(column: pa.Array, width: int) -> np.ndarray:
    """Window hash of each row that holds exactly ``width`` words."""
    w = words_of(column, ALNUM)
    return windows(w.hash, width)[w.first[:-1]] if len(column) else np.empty(0, np.uint64)


def _hits_of(held: _Block, w: Words) -> tuple[list[list], list[set]]:
    """Spans and items hit of each row."""
    n = len(w.first) - 1
    spans: list[list] = [[] for _ in range(n)]
    items: list[set] = [set() for _ in range(n)]
    for width, (lookup, keys, owners) in held.by.items():
        found = lookup.find(windows(w.hash, width))
        at = np.flatnonzero(found >= 0)
        row = np.searchsorted(w.first, at, side="right") - 1
        for k, r in zip(at[at + width <= w.first[row + 1]].tolist(), row[at + width <= w.first[row + 1]].tolist()):
            key = keys[found[k]]
            said = b" ".join(LOWER[w.data[w.start[j]:w.end[j]]].tobytes() for j in range(k, k + width))
            if said == key:
                first = k - int(w.first[r])
                mine = spans[r]
                if mine and mine[-1]["first"] <= first <= mine[-1]["last"]:
                    mine[-1]["last"] = max(mine[-1]["last"], first + width)
                else:
                    mine.append({"first": first, "last": first + width})
                items[r].update(owners[found[k]])
    return spans, items


def _scan(block: Broadcast):
    """Rows (doc_id, text, n_words, spans, items) with the block's hits added."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Block(block.value)
        for batch in slices(batches):
            w = words_of(batch.column("text"), ALNUM)
            spans, items = _hits_of(held, w)
            spans = [(old or []) + new for old, new in zip(batch.column("spans").to_pylist(), spans)]
            items = [sorted(new.union(old or [])) for old, new in zip(batch.column("items").to_pylist(), items)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text"), pa.array(np.diff(w.first), pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), pa.array(items, pa.list_(pa.string())),
            ], names=["doc_id", "text", "n_words", "spans", "items"])
    return run


def _blocks(bench: DataFrame, width: int, block_windows: int) -> Iterator[Broadcast]:
    """The windows of a benchmark, broadcast in blocks (one at least)."""
    rows = benchmark_windows(bench, width)
    blocks = max(1, -(-rows.count() // block_windows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    for block in range(blocks):
        held = [(r.width, bytes(r.window), r["item"]) for r in rows.where(F.col("block") == block).select("width", "window", "item").toLocalIterator()]
        yield bench.sparkSession.sparkContext.broadcast(held)


def find_hits(docs: DataFrame, bench: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Per document: doc_id, n_words, hit word ranges ``spans`` [first, last) and ``items`` hit.

    Spans of one row may overlap (several widths or blocks); see :func:`report` for totals.
    """
    return _found(docs, bench, width, block_windows).select("doc_id", "n_words", "spans", "items")


def _found(docs: DataFrame, bench: DataFrame, width: int, block_windows: int) -> DataFrame:
    """The rows (doc_id, text) with their hits in all blocks."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(None).cast(SPANS).alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    for k, held in enumerate(_blocks(bench, width, block_windows)):
        if k:
            rows = scratch.table(rows, f"found{k}")
            scratch.drop(f"found{k - 1}")
        rows = rows.mapInArrow(_scan(held), f"doc_id long, text string, n_words long, spans {SPANS}, items array<string>")
    return rows


def _hit_words(spans) -> F.Column:
    """Words inside the union of ``spans``: sorted ranges, each counted beyond the last end."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    step = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["last"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"]))).cast("long").alias("n"))
    return F.aggregate(F.array_sort(spans), start, step, lambda acc: acc["n"])


def report(hits: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = _hit_words(F.col("spans"))
    return hits.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def _clean(block: Broadcast):
    """The rows without a window of the block, whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Block(block.value)
        for batch in slices(batches):
            yield batch.filter(pa.array([not s for s in _hits_of(held, words_of(batch.column("text"), ALNUM))[0]], pa.bool_()))
    return run


def drop_contaminated(docs: DataFrame, bench: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Documents without any benchmark window, columns unchanged; each row goes by its own text only."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    for k, held in enumerate(_blocks(bench, width, block_windows)):
        if k:                                              # one block at a time is in memory
            rows = scratch.table(rows, f"clean{k}")
            scratch.drop(f"clean{k - 1}")
        rows = rows.mapInArrow(_clean(held), rows.schema)
    return rows.select("row.*")


def strip_spans(docs: DataFrame, bench: DataFrame, width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """doc_id and the text with every hit word removed (other bytes stay), each row by its own hits."""
    return _found(docs, bench, width, block_windows).mapInArrow(_strip, "doc_id long, text string")


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        w = words_of(batch.column("text"), ALNUM)
        out = []
        for row, (text, spans) in enumerate(zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())):
            if not spans:
                out.append(text)
                continue
            keep = np.ones(w.rows[row + 1] - w.rows[row], dtype=bool)
            for s in spans:
                a, b = w.first[row] + s["first"], w.first[row] + s["last"] - 1
                keep[w.start[a] - w.rows[row]:w.end[b] - w.rows[row]] = False
            out.append(w.data[w.rows[row]:w.rows[row + 1]][keep].tobytes().decode("utf-8"))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(out, pa.string())], names=["doc_id", "text"])


def sha256_of_items(items: list[str]) -> str:
    """The digest of :func:`report` for a list of item ids (for tests)."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
