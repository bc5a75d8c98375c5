"""Byte-fallback BPE encoding and decoding by each prefix's last piece.

An encoding of a merge vocabulary is settled by the last piece of each prefix of the text: that piece ends where
the prefix ends, and the piece before it is the last one of the shorter prefix, with which it must be *compatible*
(the pair, encoded again, stays a pair). Exactly one piece passes, so

1. a trie automaton of all pieces runs from every position and finds each piece that ends somewhere;
2. from left to right the one match whose predecessor is compatible is stored as the prefix's last piece;
3. the ids are read backwards from the end.

Compatibility is tested on the merge types of the vocabulary: a piece comes about by one last merge (its split), and
merges happen by rank, the left one first on ties. The seam between two pieces is taken back merge by merge, the
later one first; if the two pieces at the seam could have merged before the step taken back, the pair does not last.

No piece holds a blank mark after another character, so texts are cut before each run of blank marks, and each
distinct word is encoded once; words are cut again between characters that are neighbours in no piece. All steps are
NumPy over the words of a batch; what a task holds is bounded by ``slices`` and ``KEPT`` whatever the input.

Edge cases: null text is empty; an empty text has no ids and decodes to an empty text; characters outside the
vocabulary become byte pieces; a text's own blank mark (U+2581) reads back as a blank, as in the library; repeated
rows, null ids and extra columns pass through; clashing columns are refused. A text without any blank is one word,
whose steps take their time one by one (about 30 microseconds a character).
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessera.llm.codes import Lookup, mix64, slices

BLANK = "▁"
#: Words held by a worker, and slots of its table of tested pairs (a power of two)
KEPT, PAIRS = 400_000, 1 << 20
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*")
_NEVER = np.int64(1) << 40

codecs.register_error("one_byte", lambda e: ("�", e.start + 1))


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        if sp.normalize(" Ａ ﬁ\t") != f"{BLANK}{BLANK}Ａ{BLANK}ﬁ\t":
            raise ValueError("only models that leave texts as they are (but for blanks and one in front) are covered")
        self.n = n = sp.vocab_size()
        self.piece = [sp.id_to_piece(k) for k in range(n)]
        plain = [k for k in range(n) if not (sp.is_byte(k) or sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k))]
        self.byte0 = sp.piece_to_id("<0x00>")
        if not sp.is_byte(self.byte0):
            raise ValueError("only models with byte pieces are covered")
        self.bytes = [b"" if sp.is_control(k) else bytes([k - self.byte0]) if sp.is_byte(k) else self.piece[k].replace(BLANK, " ").encode() for k in range(n)]
        self.id = {self.piece[k]: k for k in plain}
        self._alphabet(plain)
        self._merges(plain, np.array([sp.get_score(k) for k in range(n)]))
        self._trie(plain)
        self.tested = np.zeros(PAIRS, dtype=np.uint64)
        self._forget()

    # ---------------------------------------------------------------- tables of the vocabulary
    def _alphabet(self, plain: list[int]) -> None:
        chars = sorted({c for k in plain for c in self.piece[k]})
        if any(c not in self.id for c in chars):
            raise ValueError("a piece holds a character that is no piece itself")
        if any(re.search(f"[^{BLANK}]{BLANK}", self.piece[k]) for k in plain):
            raise ValueError("a piece holds a blank mark after another character")
        self.code = np.zeros(0x110000, dtype=np.int32)          # 0: in no piece
        self.code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.width = len(chars) + 1
        near = {(a, b) for k in plain for a, b in zip(self.piece[k], self.piece[k][1:])}
        self.near = np.sort(np.array([self.code[ord(a)] * self.width + self.code[ord(b)] for a, b in near], dtype=np.int64))

    def _merges(self, plain: list[int], score: np.ndarray) -> None:
        """Rank of each piece, all pairs that merge, and the split of each piece that merges come to."""
        order = np.unique(-score[plain])
        self.length = np.array([len(p) for p in self.piece] + [1], dtype=np.int64)
        self.rank = np.full(self.n + 1, -1, dtype=np.int64)      # a character is there from the start
        self.rank[plain] = np.searchsorted(order, -score[plain])
        self.rank[self.length == 1] = -1
        rows = [(self.id[p[:at]], self.id[p[at:]], k) for k in plain if len(p := self.piece[k]) > 1 for at in range(1, len(p)) if p[:at] in self.id and p[at:] in self.id]
        left, right, whole = (np.array(x, dtype=np.int64) for x in zip(*rows))
        self.pairs, self.merged = Lookup(mix64(_pair(left, right))), np.append(self.rank[whole], _NEVER)
        self.left = self.right = np.full(self.n + 1, -1, dtype=np.int64)
        self.left, self.right = self.left.copy(), self.right.copy()
        size = self.length[whole]
        for n in range(2, int(size.max()) + 1):
            at = np.flatnonzero(size == n)
            known = lambda k: (self.length[k] == 1) | (self.left[k] >= 0)
            at = at[known(left[at]) & known(right[at])]
            if (np.maximum(self.rank[left[at]], self.rank[right[at]]) > self.rank[whole[at]]).all() and len(at):
                raise ValueError("a piece is made of later ones")
            at = at[np.maximum(self.rank[left[at]], self.rank[right[at]]) <= self.rank[whole[at]]]
            at = at[self._lasting(left[at], right[at], finished=False)]
            self.left[whole[at]], self.right[whole[at]] = left[at], right[at]
        self.reached = (self.length == 1) | (self.left >= 0)

    def _lasting(self, left: np.ndarray, right: np.ndarray, finished: bool = True) -> np.ndarray:
        """Which pairs stay pairs; unless ``finished``, apart from the merge of the two themselves.

        Limits are twice the rank of the step taken back: a merge over the seam of the same rank comes before
        a step on its right (odd limit), not before one on its left.
        """
        good = np.ones(len(left), dtype=bool)
        at, a, b = np.arange(len(left)), left.copy(), right.copy()
        limit = np.full(len(left), _NEVER if finished else -1, dtype=np.int64)
        while len(at):
            crossing = 2 * self.merged[self.pairs.find(mix64(_pair(a, b)))]
            bad = crossing < limit
            good[at[bad]] = False
            on_right = self.rank[b] >= self.rank[a]
            go = ~bad & (np.maximum(self.rank[a], self.rank[b]) >= 0)
            at, a, b, on_right = at[go], a[go], b[go], on_right[go]
            limit = np.where(on_right, 2 * self.rank[b] + 1, 2 * self.rank[a])
            a, b = np.where(on_right, a, self.right[a]), np.where(on_right, self.left[b], b)
        return good

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``_lasting`` with a table of the pairs tested before (the newest in each slot)."""
        key = (_pair(left, right) << np.uint64(1)) | (np.uint64(1) << np.uint64(63))
        slot = (mix64(key) & np.uint64(PAIRS - 1)).astype(np.int64)
        held = self.tested[slot]
        out = held == key + np.uint64(1)
        new = np.flatnonzero(~out & (held != key))
        if len(new):
            got = self._lasting(left[new], right[new])
            out[new] = got
            self.tested[slot[new]] = key[new] + got.astype(np.uint64)
        return out

    def _trie(self, plain: list[int]) -> None:
        node, step, self.accepts = {"": 0}, [], [-1]
        for k in sorted(plain, key=lambda k: self.piece[k]):
            p = self.piece[k]
            for at in range(1, len(p) + 1):
                if p[:at] not in node:
                    node[p[:at]] = len(node)
                    step.append((node[p[:at - 1]] * self.width + self.code[ord(p[at - 1])], node[p[:at]]))
                    self.accepts.append(-1)
            if self.reached[k]:
                self.accepts[node[p]] = k
        key, child = (np.array(x, dtype=np.int64) for x in zip(*step))
        self.steps, self.child, self.accepts = Lookup(mix64(key.astype(np.uint64))), np.append(child, -1), np.array(self.accepts, dtype=np.int64)

    # ---------------------------------------------------------------- encoding
    def _matches(self, code: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last character, piece) of every piece found in the words; ``stop``: end of each character's word."""
        begin, state, size = np.arange(len(code)), np.zeros(len(code), dtype=np.int64), 0
        at, found = [], []
        while len(begin):
            state = self.child[self.steps.find(mix64((state * self.width + code[begin + size]).astype(np.uint64)))]
            alive = state >= 0
            begin, state = begin[alive], state[alive]
            piece = self.accepts[state]
            hit = piece >= 0
            at.append(begin[hit] + size)
            found.append(piece[hit])
            size += 1
            more = begin + size < stop[begin]
            begin, state = begin[more], state[more]
        return np.concatenate(at), np.concatenate(found)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and how many each has."""
        point = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        code = self.code[point].astype(np.int64)
        length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        first = np.zeros(len(code), dtype=bool)
        first[np.cumsum(length)[:-1]] = True
        key = code[:-1] * self.width + code[1:]
        slot = np.minimum(np.searchsorted(self.near, key), len(self.near) - 1)
        first[1:] |= self.near[slot] != key
        first[0] = True
        start = np.flatnonzero(first)                           # of each part
        part = np.cumsum(first) - 1
        stop = np.append(start[1:], len(code))
        last = np.where(code == 0, self.n, -1)                  # the last piece of each prefix
        end, piece = self._matches(code, stop[part])
        begin, place = end - self.length[piece], end - start[part[end]]
        order = np.argsort(place.astype(np.uint16) if len(place) and place.max() < 1 << 16 else place, kind="stable")
        end, piece, begin = end[order], piece[order], begin[order]
        whole = begin < start[part[end]]
        bounds = np.searchsorted(place[order], np.arange(int(place.max()) + 2 if len(place) else 1))
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            e, p, lead = end[lo:hi], piece[lo:hi], whole[lo:hi]
            good = lead.copy()
            rest = np.flatnonzero(~lead)
            if len(rest):
                good[rest] = self.compatible(last[begin[lo:hi][rest]], p[rest])
            last[e[good]] = p[good]
        if (last < 0).any():
            raise ValueError("a prefix without a last piece: the vocabulary's merges do not settle it")
        # backwards from each part's end; steps are counted first, so that ids land in order
        at, steps, owner, where = stop - 1, np.zeros(len(start), dtype=np.int64), np.arange(len(start)), []
        while len(at):
            where.append((owner, at))
            steps[owner] += 1
            at = at - self.length[last[at]]
            more = at >= start[owner]
            at, owner = at[more], owner[more]
        begin = np.cumsum(steps)
        spot = np.empty(int(begin[-1]), dtype=np.int64)
        for k, (owner, at) in enumerate(where):
            spot[begin[owner] - 1 - k] = at
        ids, word = last[spot], np.searchsorted(np.cumsum(length), spot, side="right")
        strange = np.flatnonzero(ids == self.n)
        if len(strange):
            spelled = [chr(c).encode() for c in point[spot[strange]]]
            size = np.ones(len(ids), dtype=np.int64)
            size[strange] = [len(s) for s in spelled]
            ids, word, begin = np.repeat(ids, size), np.repeat(word, size), np.cumsum(size) - size
            for k, s in zip(begin[strange], spelled):
                ids[k:k + len(s)] = [self.byte0 + b for b in s]
        return ids.astype(np.int32), np.bincount(word, minlength=len(words))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.start = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _learn(self, words: list[str]) -> None:
        new = list(dict.fromkeys(w for w in words if w not in self.known))
        if not new:
            return
        ids, many = self._words(new)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(many)])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's begin (and the end)."""
        words, many = [], np.zeros(len(texts), dtype=np.int64)
        for k, text in enumerate(texts):
            if text:
                found = _WORD.findall(BLANK + text.replace(" ", BLANK))
                many[k] = len(found)
                words += found
        if len(self.known) > KEPT:
            self._forget()
        self._learn(words)
        number = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        size = self.start[number + 1] - self.start[number]
        shift = np.cumsum(size)
        ids = self.ids[np.arange(int(shift[-1]) if len(shift) else 0) + np.repeat(self.start[number] - shift + size, size)]
        return ids, np.concatenate([[0], shift])[np.concatenate([[0], np.cumsum(many)])] if len(shift) else np.zeros(len(texts) + 1, np.int64)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: blank marks are blanks, the one in front goes, stray bytes become U+FFFD one by one."""
        joined = b"".join(map(self.bytes.__getitem__, ids))
        first = next((k for k in ids if self.bytes[k]), None)
        if first is not None and not self.byte0 <= first < self.byte0 + 256 and joined[:1] == b" ":
            joined = joined[1:]
        return joined.decode("utf-8", "one_byte")


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    """One codec a worker process and model."""
    return PieceCodec(model)


def _free(docs: DataFrame, *names: str) -> None:
    clash = set(names) & set(docs.columns)
    if clash:
        raise ValueError(f"columns are taken: {sorted(clash)}")


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text, and with the text read back from them if ``decoded`` names a column."""
    _free(docs, ids, *([decoded] if decoded else []))
    schema = T.StructType(docs.schema.fields + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)] + ([T.StructField(decoded, T.StringType(), False)] if decoded else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for batch in slices(batches, text):
            flat, offsets = coder.encode(batch.column(text).to_pylist())
            columns = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))]
            if decoded:
                columns.append(pa.array([coder.decode(flat[lo:hi].tolist()) for lo, hi in zip(offsets[:-1], offsets[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(batch.columns + columns, names=batch.schema.names + [ids] + ([decoded] if decoded else []))
    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids (null ids: empty)."""
    _free(rows, decoded)
    schema = T.StructType(rows.schema.fields + [T.StructField(decoded, T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for batch in batches:
            texts = [coder.decode(x or []) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(texts, pa.string())], names=batch.schema.names + [decoded])
    return rows.mapInArrow(run, schema)


def report(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of rows with ``ids`` and ``decoded``."""
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
