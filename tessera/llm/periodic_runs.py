"""Periodic run detection by block convolution.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of at least
``max(LEAST, 2 * q)`` words, that no neighbouring word extends keeping q. At scale ``B`` (1, 2, 4, ...) the text is cut
into aligned blocks of B words. A run with period ``2B - 1 <= q <= 4B - 2`` holds such a block within its first q words,
and the block occurs again q words later. So the distances at which each block occurs again in the window
``2B - 1 ... 4B - 2`` after it are sought: the squared differences ``sum(x**2) + sum(y**2) - 2 * sum(x * y)`` of the block
with every place of the window come from one number theoretic transform of size 4B, exactly: words have small
integer codes, so that a sum stays below the prime, and zero means no mismatch. Codes may agree for other words;
each distance found seeds an extension on the words themselves, left and right, that gives the whole stretch.

Only blocks all of whose words occur again soon enough go to the transform (a block without that has no occurrence in
the window). Blocks inside a known run, at a multiple of its period, give that run again and are left out. Of the
stretches with the same ends the smallest period is the run's (two periods of one run: the smaller divides the other).

Documents are rows of one pass without a shuffle; a batch holds about a megabyte of text (one row at least) and
transforms are done ``CELLS`` values at a time.

Edge cases: null and empty texts and texts of blanks have no words and no runs; a null id is never rewritten by
``planted``; repeated rows are judged each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.codes import slices

LEAST = 12
#: 15 * 2**27 + 1 with the generator 31; products of residues stay below 2**62
PRIME, ROOT = np.uint64(2013265921), 31
CELLS = 1 << 20
RESULT = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>"


# ---------------------------------------------------------------- number theoretic transform
def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    size = 1
    while size < n:
        out[size:2 * size] = out[:min(size, n - size)] * np.uint64(pow(base, size, int(PRIME))) % PRIME
        size *= 2
    return out


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Transform of each row (a power of two long) modulo PRIME, in order, by halves."""
    n = rows.shape[1]
    root = pow(ROOT, (int(PRIME) - 1) // n, int(PRIME))
    twist = _powers(pow(root, -1, int(PRIME)) if inverse else root, max(n // 2, 1))
    # decimation in time without reordering: the axis of finished outputs grows, that of inputs shrinks
    x = rows.reshape(len(rows), n, 1)
    while x.shape[1] > 1:
        half, done = x.shape[1] // 2, x.shape[2]
        turn = twist[::n // (2 * done)][:done]
        even, odd = x[:, :half, :], x[:, half:, :] * turn % PRIME
        x = np.concatenate([even + odd, even + (PRIME - odd)], axis=2) % PRIME
    out = x.reshape(len(rows), n)
    return out * np.uint64(pow(n, -1, int(PRIME))) % PRIME if inverse else out


def occurrences(block: np.ndarray, window: np.ndarray) -> np.ndarray:
    """[rows, places]: whether each row's block (B codes) occurs at each of the 2B places of its window (3B - 1 codes)."""
    size = block.shape[1]
    a, b = np.zeros((len(block), 4 * size), np.uint64), np.zeros((len(block), 4 * size), np.uint64)
    a[:, :size] = block[:, ::-1]
    b[:, :3 * size - 1] = window
    product = transform(transform(a) * transform(b) % PRIME, inverse=True)[:, size - 1:3 * size - 1]
    squares = np.zeros((len(window), 3 * size), np.uint64)
    np.cumsum(window * window, axis=1, out=squares[:, 1:])
    total = (block * block).sum(axis=1)[:, None] + squares[:, size:] - squares[:, :2 * size]
    return total == 2 * product


# ---------------------------------------------------------------- runs of the words of a batch
def _again(word: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Distance of each word's next occurrence in its document (a large number without one)."""
    order = np.lexsort((np.arange(len(word)), word, owner))
    out = np.full(len(word), 1 << 40, dtype=np.int64)
    here, there = order[:-1], order[1:]
    same = (word[here] == word[there]) & (owner[here] == owner[there])
    out[here[same]] = (there - here)[same]
    return out


def _reach(word: np.ndarray, at: np.ndarray, distance: np.ndarray, limit: np.ndarray, way: int) -> np.ndarray:
    """How many words from ``at`` on (in direction ``way``) equal those ``distance`` later, at most ``limit``."""
    out, live, step = np.zeros(len(at), dtype=np.int64), np.flatnonzero(limit > 0), 8
    while len(live):
        before = out[live]
        for part in np.array_split(live, -(-len(live) * step // CELLS)):
            k = out[part][:, None] + np.arange(step)
            inside = k < limit[part][:, None]
            place = np.where(inside, at[part][:, None] + way * k, 0)
            same = inside & (word[place] == word[np.where(inside, place + distance[part][:, None], 0)])
            out[part] += np.where(same.all(axis=1), step, same.argmin(axis=1))
        live, step = live[out[live] - before == step], min(step * 4, 4096)
    return out


def find_runs(word: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, in order; ``word``: a number a word, ``first``: each document's first word, plus the end."""
    many = np.diff(first)
    owner = np.repeat(np.arange(len(many)), many)
    again = _again(word, owner)
    runs: list[np.ndarray] = []                                # rows of (start, end, period) in the batch's words
    size = 1
    while 2 * (2 * size - 1) <= (int(many.max()) if len(many) else 0):
        # aligned blocks that lie in their document with room for the nearest place
        per = np.maximum(many - (2 * size - 1), 0) // size
        document = np.repeat(np.arange(len(many)), per)
        block = np.arange(len(document)) - np.repeat(np.cumsum(per) - per, per)
        begin = first[document] + block * size
        if size == 1:
            far = again[begin]
        else:
            top = np.append(again, 0)
            edges = np.column_stack([begin, begin + size]).ravel()
            far = np.maximum.reduceat(top, edges)[::2] if len(edges) else begin
        begin, document = begin[far <= 4 * size - 2], document[far <= 4 * size - 2]
        seeds = [_seeds(word, begin[lo:hi], first[document[lo:hi] + 1], size) for lo, hi in _pieces(len(begin), CELLS // (4 * size))]
        if seeds:
            at, distance = (np.concatenate(x) for x in zip(*seeds))
            runs += _stretches(word, at, distance, first, runs, size, least)
        size *= 2
    if not runs:
        none = np.empty(0, np.int64)
        return none, none, none, none
    found = np.unique(np.concatenate(runs), axis=0)            # by start, end, period
    keep = np.ones(len(found), dtype=bool)
    keep[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    start, end, period = found[keep].T
    document = np.searchsorted(first, start, side="right") - 1
    order = np.lexsort((period, start))
    return document[order], (start - first[document])[order], (end - start)[order], period[order]


def _pieces(n: int, size: int) -> list[tuple[int, int]]:
    return [(lo, min(n, lo + max(size, 1))) for lo in range(0, n, max(size, 1))]


def _seeds(word: np.ndarray, begin: np.ndarray, stop: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of the occurrences of blocks in their windows."""
    top = int((int(PRIME) // (2 * size)) ** 0.5)               # a sum of squares of differences stays below PRIME
    code = lambda at: (word[at] % max(top, 2)).astype(np.uint64)
    block = code(begin[:, None] + np.arange(size))
    place = begin[:, None] + np.arange(2 * size - 1, 5 * size - 2)
    window = code(np.minimum(place, len(word) - 1))
    hit = occurrences(block, window)
    hit &= begin[:, None] + np.arange(2 * size - 1, 4 * size - 1) + size <= stop[:, None]
    row, shift = np.nonzero(hit)
    return begin[row], shift + 2 * size - 1


def _stretches(word: np.ndarray, at: np.ndarray, distance: np.ndarray, first: np.ndarray, known: list[np.ndarray], size: int, least: int) -> list[np.ndarray]:
    """Runs that grow from the seeds, as rows of (start, end, period)."""
    if known:
        # inside a known run (the one that reaches furthest), at a multiple of its period: the same run again
        held = np.concatenate(known)
        held = held[np.lexsort((-held[:, 2], held[:, 1], held[:, 0]))]
        best = np.maximum.accumulate(np.where(held[:, 1] == np.maximum.accumulate(held[:, 1]), np.arange(len(held)), 0))
        before = np.searchsorted(held[:, 0], at, side="right")
        run = held[best[np.maximum(before - 1, 0)]]
        fresh = (before == 0) | (at + distance + size > run[:, 1]) | (distance % run[:, 2] != 0)
        at, distance = at[fresh], distance[fresh]
    # neighbouring blocks at one distance are one stretch: the first stands for it
    order = np.lexsort((at, distance))
    at, distance = at[order], distance[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (distance[1:] != distance[:-1]) | (at[1:] != at[:-1] + size)
    at, distance = at[new], distance[new]
    if not len(at):
        return []
    document = np.searchsorted(first, at, side="right") - 1
    ahead = _reach(word, at, distance, first[document + 1] - distance - at, 1)
    back = _reach(word, at - 1, distance, at - first[document], -1)
    start, end = at - back, at + ahead + distance
    good = (ahead > 0) & (end - start >= np.maximum(least, 2 * distance))
    return [np.column_stack([start, end, distance])[good]] if good.any() else []


# ---------------------------------------------------------------- documents
def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a period written over the tail of one document in ten, by the id's crc32."""
    h, n = (zlib.crc32(str(doc_id).encode()), len(words)) if doc_id is not None else (1, 0)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def _judge(ids: list[int | None], texts: list[bytes], rewrite) -> dict[str, list]:
    words = [rewrite(t.split(), k) if rewrite else t.split() for k, t in zip(ids, texts)]
    first = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    flat = np.empty(int(first[-1]), dtype=object)
    flat[:] = [w for doc in words for w in doc]
    document, start, length, period = find_runs(pd.factorize(flat)[0].astype(np.int64), first)
    out = {name: [] for name in ("n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs")}
    bounds = np.searchsorted(document, np.arange(len(words) + 1))
    for k, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
        runs = list(zip(start[lo:hi].tolist(), length[lo:hi].tolist(), period[lo:hi].tolist()))
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        kept = words[k]
        if runs:
            change = np.zeros(len(kept) + 1, dtype=np.int64)
            np.add.at(change, [s + q for s, _, q in runs], 1)
            np.add.at(change, [s + n for s, n, _ in runs], -1)
            kept = [kept[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        row = (len(words[k]), len(runs), *best, 1000 * best[1] // best[2] if runs else None,
               hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), [dict(zip(("start", "length", "period"), r)) for r in runs])
        for name, value in zip(out, row):
            out[name].append(value)
    return out


def _run(rewrite):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            out = _judge(batch.column("doc_id").to_pylist(), texts, rewrite)
            longs = [pa.array(out[name], pa.int64()) for name in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")]
            row = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *longs, pa.array(out["runs_sha256"]), pa.array(out["collapsed_sha256"]), pa.array(out["runs"], pa.list_(row))],
                names=["doc_id", *list(out)[:-1], "runs"])
    return run


def detect(docs: DataFrame, rewrite=None) -> DataFrame:
    """Per row of ``docs``: its runs, the greatest of them, and digests of the list and of the text without repeats.

    ``rewrite(words, doc_id)`` may change a document's words first (``planted`` for the query).
    """
    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(_run(rewrite), RESULT)


def report(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
