"""Spelling variant grouping: Bloom-guided neighbourhoods of a vocabulary.

The vocabulary holds the words of at least ``LENGTH`` code points that occur at least ``OFTEN`` times. Two words are
near if one inserted, deleted or replaced code point turns one into the other.

1. Every word goes into the Bloom filter of its length, a shard; a filter is blocked, so that a probe reads one
   64-bit block. Blocks are made by a grouped ``bit_or`` and sent to the executors in rounds of at most ``BLOCKS``
   blocks (16 MB), so that a broadcast is bounded whatever the vocabulary; a length with more blocks is cut into
   shards by hash.
2. Each word generates its edits: every deletion, and every replacement by a character of the vocabulary's alphabet.
   Insertions are the other side's deletions. Edits are hashed from prefix sums, without being spelled out, and probed
   in the filter of their length.
3. Only positives are spelled out and shuffled to the exact join with the vocabulary, which removes the false ones.

A word's form is its most frequent near word (ties: smallest in code-point order) if that is at least ``TIMES`` as
frequent; its root is where following forms ends, found by pointer doubling (each step multiplies the frequency by
``TIMES`` at least, so a chain has few steps).

Edge cases: null text has no words; without a doc_id no character is deleted by ``written``; repeated rows count each;
extra columns are ignored; an empty vocabulary gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.codes import mix64
from tessera.llm.scratch import Scratch

LENGTH, OFTEN, TIMES = 6, 5, 5
#: Bits of filter a word, bits set a word, blocks a broadcast round, edits hashed at once
BITS, SET, BLOCKS, EDITS = 24, 5, 1 << 21, 1 << 20
RUN = "[a-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def written(doc_id: Column, run: Column) -> Column:
    """The run as the query takes it: one in 199, by the crc32 of ``<doc_id>:<run>``, loses a code point."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), run).cast("binary"))
    at = h % F.length(run)
    return F.when(h % 199 == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame, length: int = LENGTH, often: int = OFTEN) -> DataFrame:
    """word, n: words of the texts that are long and frequent enough."""
    runs = docs.select(F.col("doc_id").alias("_doc"), F.explode(F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(f"{RUN}{{{length},}}"), F.lit(0))).alias("_run"))
    words = runs.select(written(F.col("_doc"), F.col("_run")).alias("word")).where(F.length("word") >= length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= often)


# ---------------------------------------------------------------- filters
def _letters(words: pd.Series, length: int) -> np.ndarray:
    """[rows, length] code points plus one of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(-1, length).astype(np.uint64) + np.uint64(1)


def _scale(length: int) -> np.ndarray:
    out = np.full(length + 1, _P, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _place(total: np.ndarray, length: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and mask of hashed words of one length."""
    h = mix64(total ^ (np.uint64(length) << np.uint64(48)))
    block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    mask, bits = np.zeros(h.shape, np.uint64), mix64(h ^ _P)
    for k in range(SET):
        mask |= np.uint64(1) << ((bits >> np.uint64(6 * k)) & np.uint64(63))
    return block.astype(np.int64), mask


def blocks_of(words: int) -> int:
    """Blocks of the filter of so many words."""
    return max(1, words * BITS // 64 + 1)


def _placed(many: dict[int, int]):
    """Words to the block and mask that they set in the filter of their length."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            size = frame["word"].str.len()
            for length, part in frame.groupby(size):
                total = (_letters(part["word"], length) * _scale(length)[:-1]).sum(axis=1, dtype=np.uint64)
                block, mask = _place(total, length, many[length])
                yield pd.DataFrame({"length": np.int32(length), "block": block, "mask": mask.view(np.int64)})
    return run


def rounds_of(many: dict[int, int], most: int) -> list[list[tuple[int, int, int]]]:
    """Shards (length, first block, end block) of all filters, in rounds of at most ``most`` blocks."""
    rounds, room = [], 0
    for length, blocks in sorted(many.items()):
        lo = 0
        while lo < blocks:
            if not room:
                rounds.append([])
                room = most
            hi = min(blocks, lo + room)
            rounds[-1].append((length, lo, hi))
            room -= hi - lo
            lo = hi
    return rounds


# ---------------------------------------------------------------- probing
def _probes(many: dict[int, int], alphabet: str, sent):
    """Edits of words that are in the filters sent: word, n, near, shorter (whether by a deletion)."""
    letter = np.array([ord(c) for c in alphabet], dtype=np.uint64) + np.uint64(1)

    def found(total: np.ndarray, length: int) -> np.ndarray:
        hit = np.zeros(total.shape, dtype=bool)
        block, mask = _place(total, length, many[length])
        for lo, hi, held in sent.value.get(length, ()):
            mine = (block >= lo) & (block < hi)
            got = held[np.where(mine, block - lo, 0)]
            hit |= mine & ((got & mask) == mask)
        return hit

    def edits(frame: pd.DataFrame, length: int) -> Iterator[pd.DataFrame]:
        code, scale = _letters(frame["word"], length), _scale(length)
        ahead = np.zeros((len(frame), length + 1), dtype=np.uint64)
        np.cumsum(code * scale[:-1], axis=1, out=ahead[:, 1:])
        total = ahead[:, -1]
        word = frame["word"].to_numpy()
        rows, nears, shorter = [], [], []
        for i in range(length):
            if length - 1 in sent.value:
                gone = ahead[:, i] + (total - ahead[:, i + 1]) * _P_INV
                first = np.ones(len(frame), dtype=bool) if i == 0 else code[:, i] != code[:, i - 1]
                for k in np.flatnonzero(found(gone, length - 1) & first):
                    rows.append(k), nears.append(word[k][:i] + word[k][i + 1:]), shorter.append(True)
            if length in sent.value:
                changed = total[:, None] + (letter[None, :] - code[:, i:i + 1]) * scale[i]
                for k, c in zip(*np.nonzero(found(changed, length) & (letter[None, :] != code[:, i:i + 1]))):
                    rows.append(k), nears.append(word[k][:i] + alphabet[c] + word[k][i + 1:]), shorter.append(False)
            if len(rows) > 100_000 or i == length - 1:
                yield pd.DataFrame({"word": word[rows], "n": frame["n"].to_numpy()[rows], "near": pd.Series(nears, dtype=object), "shorter": np.array(shorter, dtype=bool)})
                rows, nears, shorter = [], [], []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, part in frame.groupby(frame["word"].str.len()):
                step = max(1, EDITS // max(length, len(alphabet)))
                for lo in range(0, len(part), step):
                    yield from edits(part.iloc[lo:lo + step], length)
    return run


def near_words(vocab: DataFrame, scratch: Scratch, most: int = BLOCKS) -> DataFrame:
    """word, n, near, near_n: each near pair in both directions."""
    spark = vocab.sparkSession
    many = {r.length: blocks_of(r.words) for r in vocab.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()}
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = "".join(sorted(r.c for r in letters.collect()))
    filters = scratch.table(vocab.select("word").mapInPandas(_placed(many), "length int, block long, mask long").groupBy("length", "block").agg(F.bit_or("mask").alias("mask")), "filters")
    path = scratch.path("positives")
    schema = "word string, n long, near string, shorter boolean"
    for shards in rounds_of(many, most):
        wanted = " or ".join(f"length = {length} and block >= {lo} and block < {hi}" for length, lo, hi in shards)
        blocks = filters.where(wanted).toPandas()               # at most ``most`` rows
        held: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for length, lo, hi in shards:
            mine = blocks[(blocks["length"] == length) & (blocks["block"] >= lo) & (blocks["block"] < hi)]
            bits = np.zeros(hi - lo, dtype=np.uint64)
            bits[mine["block"].to_numpy(np.int64) - lo] = mine["mask"].to_numpy(np.int64).view(np.uint64)
            held.setdefault(length, []).append((lo, hi, bits))
        sent = spark.sparkContext.broadcast(held)
        shortest, longest = min(held), max(held) + 1
        probing = vocab.where(F.length("word").between(shortest, longest))
        probing.mapInPandas(_probes(many, alphabet, sent), schema).write.mode("append").parquet(path)
        sent.unpersist()
    if not many:
        return spark.createDataFrame([], "word string, n long, near string, near_n long")
    exact = spark.read.schema(schema).parquet(path).join(vocab.toDF("near", "near_n"), "near")
    there, back = F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return exact.select(F.explode(F.when(F.col("shorter"), F.array(there, back)).otherwise(F.array(there))).alias("p")).select("p.*")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) of rows (word, form): the end of each word's chain of forms."""
    at = scratch.table(forms.select("word", F.col("form").alias("root")), "roots0")
    turn = 0
    while True:
        turn += 1
        further = scratch.table(at.join(at.toDF("root", "far"), "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), f"roots{turn}")
        at = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return at


def group_variants(docs: DataFrame, often: int = OFTEN, times: int = TIMES, most: int = BLOCKS) -> DataFrame:
    """word, n, n_near, form, form_n, root of the vocabulary of ``docs``."""
    scratch = Scratch(docs.sparkSession, "spelling")
    vocab = scratch.table(vocabulary(docs, often=often), "vocabulary")
    best = near_words(vocab, scratch, most).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    strong = -F.col("best.less") >= times * F.col("n")
    best = scratch.table(best.select("word", "n_near", F.when(strong, F.col("best.near")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "best")
    found = vocab.join(best, "word", "left").join(roots(best.where("form is not null"), scratch), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
