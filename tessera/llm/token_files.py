"""Token-id output: Arrow stream files of fixed-size-list batches, and their readers.

Documents are range-partitioned and sorted by doc_id; each partition encodes its texts, appends the
end id and packs the ids, document after document, into sequences of ``SEQUENCE`` ids. A part is two
Arrow stream files without buffer compression, so a memory-mapped file is read without copying:

* ``ids`` fixed_size_list<uint16|uint32>[SEQUENCE] and ``mask`` fixed_size_list<bool>[SEQUENCE]
  (false only in the padding that ends the last sequence of a part);
* the document table: doc_id, start (within the part), n_tokens.

Part files have a name of their own for each task attempt; only those in the manifest, which Spark
commits, count, so a retried task or a lost executor leaves no doubt. A document's corpus-wide start
is its start plus the ids of the parts before (one manifest row a part).

Texts are split into the tokenizer's pre-tokens with array operations; each distinct pre-token is
encoded once a worker by the tokenizers library's own model, and texts with characters whose class
is not the same in all Unicode versions go through the library whole. Tests hold the ids against the
library's ``encode`` on the same texts.

Edge cases: null text is empty (only the end id); rows that repeat a doc_id follow each other in
order of their text; a null doc_id sorts first and is kept; an empty table writes no ids. Special tokens' strings in
a text are ordinary text.
"""

from __future__ import annotations

import functools
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tessera.llm.codes import _power_tables, bytes_of, mix64, slices
from tessera.llm.scratch import Scratch

SEQUENCE, END_ID, BATCH_SEQUENCES = 2048, 2, 128
#: Distinct pre-tokens whose ids a worker keeps before it starts anew
CACHE = 700_000
LETTER, NUMBER, BLANK, OTHER, UNSURE = 1, 2, 3, 0, 9
# Unicode White_Space, and the contractions that the tokenizer splits off.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS = ["s", "t", "m", "d", "re", "ve", "ll"]


@functools.cache
def _classes() -> np.ndarray:
    """Class of each code point; UNSURE where Unicode versions differ or the point is unassigned."""
    out = np.full(0x110000, UNSURE, dtype=np.uint8)
    kind = {"L": LETTER, "N": NUMBER}
    for c in range(0x30000):
        char = chr(c)
        old, new = unicodedata.ucd_3_2_0.category(char), unicodedata.category(char)
        if "Cn" not in (old, new) and old != "Cs" and kind.get(old[0], OTHER) == kind.get(new[0], OTHER):
            out[c] = kind.get(new[0], OTHER)
    out[WHITE_SPACE] = BLANK
    return out


def pretoken_starts(points: np.ndarray, edge: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point; ``edge`` marks row starts (one longer)."""
    n = len(points)
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    # the last blank of a run before something else stands alone, or leads it if it is a space
    last = blank.copy()
    last[:-1] &= ~blank[1:] & ~edge[1:n]
    if n:
        last[-1] = False
    at = np.flatnonzero(last)
    start[at] = True
    start[at[points[at] == 32] + 1] = False
    # contractions at a start
    quote = np.flatnonzero((points == 39) & start)
    for ending in CONTRACTIONS:
        size = len(ending) + 1
        mine = quote[quote + size <= n]
        for k, char in enumerate(ending, 1):
            mine = mine[(points[mine + k] == ord(char)) & ~edge[mine + k]]
        start[mine + 1] = False
        more = mine[mine + size < n] + size
        more = more[(kind[more] == LETTER) & ~edge[more]]
        start[more] = True
    return start


class Encoder:
    """Ids of whole texts: pre-tokens by arrays, ids of each distinct one from the library, kept."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.kind = _classes()
        self.alphabet = self._alphabet()
        self._clear()

    def _alphabet(self) -> dict[int, str]:
        """The library's character for each byte, read off its pre-tokenizer."""
        out: dict[int, str] = {}
        for c in [*range(0x80), *range(0x80, 0x800, 0x3F), *range(0x80, 0x100), *range(0x800, 0xD800, 0x800), *range(0xE000, 0xFFFF, 0x800), *range(0x10000, 0x110000, 0x20000)]:
            said = "".join(p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(c)))
            out.update(zip(chr(c).encode("utf-8"), said))
        return out

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.empty(1 << 16, dtype=np.uint32)
        self.used = 0
        self.at, self.size = np.empty(1 << 16, dtype=np.int64), np.empty(1 << 16, dtype=np.int64)

    def _learn(self, keys: list[int], tokens: list[bytes]) -> None:
        table, tokenize, known = self.alphabet, self.model.tokenize, self.known
        got = [[t.id for t in tokenize(b.decode("latin-1").translate(table))] for b in tokens]
        n = sum(map(len, got))
        if self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(n, len(self.flat)), np.uint32)])
        at, more = len(known), len(got)
        while at + more > len(self.at):
            self.at, self.size = (np.concatenate([x, np.empty_like(x)]) for x in (self.at, self.size))
        known.update(zip(keys, range(at, at + more)))
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=more)
        self.size[at:at + more] = sizes
        self.at[at:at + more] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + n] = [i for ids in got for i in ids]
        self.used += n

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column, and the offset of each row's ids (one more than rows)."""
        data, rows = bytes_of(column)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        kind = self.kind[points]
        unsure = kind == UNSURE
        wide = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        place = np.zeros(len(points) + 1, dtype=np.int64)
        np.cumsum(wide, out=place[1:])
        edge = np.zeros(len(points) + 1, dtype=bool)
        edge[np.searchsorted(place, rows)] = True
        start = np.append(place[:-1][pretoken_starts(points, edge, kind)], len(data)).astype(np.int64)
        first = np.searchsorted(start, rows)                       # each row's first pre-token
        power, inverse = _power_tables(len(data) + 1)
        value = (data.astype(np.uint64) + np.uint64(1)) * power[:len(data)]
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(value, out=total[1:])
        length = np.diff(start)
        hashes = mix64((total[start[1:]] - total[start[:-1]]) * inverse[start[:-1]] + length.astype(np.uint64))
        distinct, sample, where = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE and len(self.known) > CACHE // 2:
            self._clear()
        keys = distinct.tolist()
        get = self.known.get
        entry = np.fromiter((get(key, -1) for key in keys), dtype=np.int64, count=len(keys))
        new = np.flatnonzero(entry < 0)
        if len(new):
            raw = data.tobytes()
            entry[new] = np.arange(len(self.known), len(self.known) + len(new))
            self._learn([keys[k] for k in new.tolist()], [raw[start[s]:start[s + 1]] for s in sample[new].tolist()])
        entry = entry[where]
        size = self.size[entry]
        begin = np.zeros(len(entry) + 1, dtype=np.int64)
        np.cumsum(size, out=begin[1:])
        source = self.at[entry] - begin[:-1]
        ids = self.flat[np.repeat(source, size) + np.arange(begin[-1])]
        offsets = begin[first]
        if unsure.any():
            ids, offsets = self._whole(column, ids, offsets, np.unique(np.searchsorted(rows, place[:-1][unsure], side="right") - 1))
        return ids, offsets

    def _whole(self, column: pa.Array, ids: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        texts = column.take(pa.array(rows)).to_pylist()
        said = dict(zip(rows.tolist(), self.tokenizer.encode_batch(texts, add_special_tokens=False)))
        parts = [np.asarray(said[r].ids, np.uint32) if r in said else ids[offsets[r]:offsets[r + 1]] for r in range(len(column))]
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)])


@functools.cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _open_out(uri: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    where.create_dir(path.rpartition("/")[0], recursive=True)
    return where.open_output_stream(path)


def sequence_schema(sequence: int, wide: bool) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.uint32() if wide else pa.uint16(), sequence)), ("mask", pa.list_(pa.bool_(), sequence))])


DOC_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
MANIFEST = "part int, ids_path string, docs_path string, n_docs long, n_tokens long"


def _sequences(ids: np.ndarray, schema: pa.Schema, sequence: int) -> pa.RecordBatch:
    n = -(-len(ids) // sequence) * sequence
    mask = np.arange(n) < len(ids)
    padded = np.concatenate([ids, np.zeros(n - len(ids), ids.dtype)])
    return pa.RecordBatch.from_arrays([
        pa.FixedSizeListArray.from_arrays(pa.array(padded), type=schema.field("ids").type),
        pa.FixedSizeListArray.from_arrays(pa.array(mask), type=schema.field("mask").type)], schema=schema)


def _write_part(root: str, path: str, sequence: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        wide = encoder.tokenizer.get_vocab_size() > 1 << 16
        schema, kind = sequence_schema(sequence, wide), np.uint32 if wide else np.uint16
        name, full = f"{root}/part-{uuid.uuid4().hex}", sequence * BATCH_SEQUENCES
        held, n_held, total, n_docs, out = [], 0, 0, 0, None
        for batch in slices(batches, most=1 << 20):
            if out is None:
                out = _open_out(f"{name}.ids.arrow"), _open_out(f"{name}.docs.arrow")
                writers = pa.ipc.new_stream(out[0], schema), pa.ipc.new_stream(out[1], DOC_SCHEMA)
            ids, offsets = encoder.encode(batch.column("text"))
            ends = np.insert(ids, offsets[1:], end_id).astype(kind)      # the end id after each row
            starts = offsets + np.arange(len(offsets))
            writers[1].write_batch(pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(starts[:-1] + total), pa.array(np.diff(starts))], schema=DOC_SCHEMA))
            total, n_docs = total + len(ends), n_docs + batch.num_rows
            held.append(ends)
            n_held += len(ends)
            if n_held >= full:
                ids = np.concatenate(held)
                cut = n_held // full * full
                for at in range(0, cut, full):
                    writers[0].write_batch(_sequences(ids[at:at + full], schema, sequence))
                held, n_held = [ids[cut:].copy()], n_held - cut
        if out is not None:
            if n_held:
                writers[0].write_batch(_sequences(np.concatenate(held), schema, sequence))
            for x in (*writers, *out):
                x.close()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([f"{name}.ids.arrow"]), pa.array([f"{name}.docs.arrow"]), pa.array([n_docs], pa.int64()), pa.array([total], pa.int64())],
                                             names=["part", "ids_path", "docs_path", "n_docs", "n_tokens"])
    return run


def write_token_files(docs: DataFrame, tokenizer: str, root: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Write the files under ``root`` (shared storage); the manifest, with each part's corpus-wide ``base``."""
    spark = docs.sparkSession
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # a repeated id, or none, may hold any number of rows: ranges are cut within it by the text's hash
    text = text.withColumn("digest", F.xxhash64("text"))
    ordered = text.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "text").select("doc_id", "text")
    manifest = ordered.mapInArrow(_write_part(f"{root}/files", tokenizer, sequence, end_id), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{root}/manifest")
    return read_manifest(spark, root)


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The committed parts in order (one row a part) with ``base``: all ids in the parts before."""
    parts = spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def open_stream(uri: str) -> pa.ipc.RecordBatchStreamReader:
    """Reader of a part file; local files are memory-mapped, so its batches are not copied."""
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(uri)
    return pa.ipc.open_stream(pa.memory_map(path) if isinstance(where, fs.LocalFileSystem) else where.open_input_file(path))


def sequences_of(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array]:
    """A batch's ids as an array [rows, sequence] on the file's own bytes, and its mask column."""
    ids = batch.column("ids")
    return ids.values.to_numpy(zero_copy_only=True).reshape(-1, ids.type.list_size), batch.column("mask")


def _ids(path: str) -> Iterator[np.ndarray]:
    """The ids of a part file without padding, batch by batch."""
    for batch in open_stream(path):
        ids, mask = sequences_of(batch)
        yield ids.reshape(-1)[mask.values.to_numpy(zero_copy_only=False)]


def _read_part(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in parts:
        for part in frame.itertuples(index=False):
            stream, chunk, at = _ids(part.ids_path), np.empty(0, np.uint16), 0
            for batch in open_stream(part.docs_path):
                crc = []
                for n in batch.column("n_tokens").to_pylist():
                    sum_ = 0
                    while n:
                        if at == len(chunk):
                            chunk, at = next(stream), 0
                        piece = chunk[at:at + n]
                        sum_ = zlib.crc32(piece.astype("<u4").tobytes(), sum_)
                        at, n = at + len(piece), n - len(piece)
                    crc.append(sum_)
                start = batch.column("start").to_numpy() + part.base
                yield pa.table([batch.column("doc_id"), pa.array(start), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                               names=["doc_id", "start", "n_tokens", "ids_crc32"]).to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get)


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files, about a part a task."""
    spread = manifest.repartition(max(1, manifest.count()), "ids_path")
    return spread.select("ids_path", "docs_path", "base").mapInPandas(_read_part, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_corpus(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Write all documents in the file format, read them back: one row a document."""
    scratch = Scratch(docs.sparkSession, "tokens")
    return read_documents(write_token_files(docs, tokenizer, scratch.root, sequence, end_id))
