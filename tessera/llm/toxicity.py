"""Toxicity: a lexicon learned from labels, matched by Levenshtein automata over its trie.

Learning (labels of training rows only): words and word beginnings (stems) of a bounded, stratified
sample of labelled documents are counted by label. All terms that go with the label far beyond
chance (of overlapping stems the strongest) make the lexicon, each weighed by its log odds: stems match words that begin so, whole words
match within an edit distance that grows with their length. Innocent words of training documents that the
lexicon would match, by a stem or as near misses, are exceptions, each for itself.

Matching: the lexicon's trie is intersected with Levenshtein automata into deterministic automata
over bytes (one for each ``HELD_STEMS`` stems or ``HELD`` words), built as texts need them and begun
anew beyond ``HELD_BYTES``; all distinct beginnings of a batch's words run through them together.

Scoring: each hit's weight is lowered if it is a near miss, and if its window is a quotation (within
quotation marks or after a reporting word). A document's sum, and the sum for its length, enter a logistic
curve fitted on the sample, with each label's rows weighed up to their number in all training labels.

Edge cases: null or empty text has no hits and the lowest score; rows that repeat a doc_id are scored
each; without training labels of both kinds the lexicon is empty and every score is about the share of toxic
labels (about 0 without labels); distances are in UTF-8 bytes; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.codes import ALNUM, LOWER, Words, slices, words_of
from tessera.llm.scratch import Scratch

#: Labelled rows of each kind that lexicon and curve are learned from, at most (smallest id hashes first)
SAMPLE_ROWS = 10_000
STEMS, LONGEST = range(4, 9), 24
#: Least ratio of rates and number of toxic documents of a term, slack of the test against chance, and
#: the most that one document counts for a term
RATIO, SUPPORT, SLACK, MOST = 8.0, 3, 0.5, 3
FUZZY, QUOTED, THRESHOLD = 0.6, 0.25, 0.3
WINDOW = 8
#: Whole words and stems of an automaton, bytes that all automata of a task keep of states, and words run through them at once
HELD, HELD_STEMS, HELD_BYTES, AT_ONCE = 16, 64, 96 << 20, 1 << 16
# Quotation marks, and words that report what others say.
QUOTES = ['"', "“", "”", "„", "«", "»", "‟", "‹", "›"]
REPORTING = "said says quote quoted quotes word words term called wrote dit disait écrit mot sagte schrieb wort dijo escribió palabra".split()


def held_out(doc_id: Column) -> Column:
    """Rows whose labels must not be learned from."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2


def edits(size: int) -> int:
    """Edit distance within which a whole word of ``size`` bytes is matched."""
    return 0 if size < 5 else 1 if size < 9 else 2


# --- learning -------------------------------------------------------------------------------

def _term_counts(sample: Broadcast):
    """Counts of sampled documents, toxic and not, per whole word and stem of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, toxic = sample.value
        for batch in slices(batches):
            doc = batch.column("doc_id").fill_null(0).to_numpy()
            at = np.minimum(np.searchsorted(ids, doc), max(len(ids) - 1, 0))
            mine = np.flatnonzero((ids[at] == doc) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)) if len(ids) else np.empty(0, np.int64)
            if not len(mine):
                continue
            w = words_of(batch.column("text").take(pa.array(mine)), ALNUM)
            mark = toxic[at[mine]]
            row = np.repeat(np.arange(len(mine)), np.diff(w.first))
            norm, size = LOWER[w.data], w.end - w.start
            key = np.zeros(len(row), dtype=np.uint64)
            for i in range(8):
                inside = size > i
                key[inside] |= norm[w.start[inside] + i].astype(np.uint64) << np.uint64(56 - 8 * i)
            for kind in (0, *STEMS):
                fit = np.flatnonzero((size >= 3) & (size <= LONGEST) if kind == 0 else size >= kind)
                value = w.hash[fit] if kind == 0 else key[fit] >> np.uint64(64 - 8 * kind)
                order = np.lexsort((value, row[fit]))
                value, fit = value[order], fit[order]
                new = np.ones(len(fit), dtype=bool)
                new[1:] = (value[1:] != value[:-1]) | (row[fit[1:]] != row[fit[:-1]])
                pair = np.flatnonzero(new)
                times = np.minimum(np.diff(np.append(pair, len(fit))), MOST)
                value, pair = value[pair], fit[pair]
                distinct, sample_at, where = np.unique(value, return_index=True, return_inverse=True)
                bad = mark[row[pair]]
                pos, neg, docs = (np.bincount(where, x, minlength=len(distinct)).astype(np.int64) for x in (times * bad, times * ~bad, bad))
                at_ = pair[sample_at]
                stop = w.end[at_] if kind == 0 else w.start[at_] + kind
                terms = [norm[a:b].tobytes() for a, b in zip(w.start[at_].tolist(), stop.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), kind, np.int32)), pa.array(terms, pa.binary()), pa.array(pos), pa.array(neg), pa.array(docs)], names=["kind", "term", "pos", "neg", "docs"])
    return run


class Lexicon:
    """Terms with their weights: stems, and whole words with the distance within which each is matched."""

    def __init__(self, stems: dict[bytes, float], words: dict[bytes, tuple[float, int]], exceptions: frozenset[bytes] = frozenset()):
        self.stems, self.words, self.exceptions = stems, words, exceptions


def _apart(stems: pd.DataFrame) -> pd.DataFrame:
    """Of stems with the same first bytes (strongest first, the longer of equals) those that neither begin with nor begin a stronger one."""
    stems = stems.assign(strength=stems["strength"].round(6), term=stems["term"].map(bytes)).sort_values(["strength", "kind", "term"], ascending=[False, False, True])
    kept, begun, out = set(), set(), []
    for stem in stems["term"]:
        begins = {stem[:k] for k in range(1, len(stem) + 1)}
        out.append(stem not in begun and not begins & kept)
        if out[-1]:
            kept.add(stem)
            begun |= begins
    return stems.loc[out, ["term", "odds"]]


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows that may be learned from; a repeated id is toxic if one row says so."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))


def draw_sample(train: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and labels of at most ``rows`` training rows of each label."""
    picked = sorted((r.doc_id, r.toxic) for kind in (1, 0) for r in train.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).collect())
    return np.array([p[0] for p in picked], dtype=np.int64), np.array([p[1] for p in picked], dtype=bool)


def learn(docs: DataFrame, sample: tuple[np.ndarray, np.ndarray], scratch: Scratch) -> Lexicon:
    """The lexicon of a labelled sample."""
    spark = docs.sparkSession
    if not sample[1].any() or sample[1].all():
        return Lexicon({}, {})
    held = spark.sparkContext.broadcast(sample)
    counted = _text(docs).mapInArrow(_term_counts(held), "kind int, term binary, pos long, neg long, docs long").groupBy("kind", "term").agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "docs")])
    counted = scratch.table(counted, "terms")
    # likelihood ratio of a term's counts against all of its kind, to be beyond what chance gives over that many terms
    kinds = counted.groupBy("kind").agg(F.log(F.count(F.lit(1))).alias("chance"), (F.sum("pos") / (F.sum("pos") + F.sum("neg"))).alias("base"))
    n, base = F.col("pos") + F.col("neg"), F.col("base")
    part = lambda k, share: F.when(k > 0, k * F.log(k / (n * share))).otherwise(0.0)
    odds = (F.col("pos") + 0.5) / (F.col("neg") + 0.5) * (1 - base) / base
    # a row a kind: 1 + len(STEMS); a join by key would put all whole words into one task
    rated = counted.join(F.broadcast(kinds), "kind").where((base > 0) & (base < 1)).withColumn("strength", part(F.col("pos"), base) + part(F.col("neg"), 1 - base)).withColumn("odds", odds)
    sure = rated.where((F.col("docs") >= SUPPORT) & (F.col("odds") >= RATIO) & (F.col("strength") >= F.col("chance") + SLACK))
    stems = sure.where("kind > 0").select(F.substring("term", 1, min(STEMS)).alias("lead"), "kind", "term", "strength", "odds").groupBy("lead").applyInPandas(_apart, "term binary, odds double")
    stems = {bytes(r.term): float(np.log(r.odds)) for r in stems.collect()}
    words = {bytes(r.term): (float(np.log(r.odds)), edits(len(r.term))) for r in sure.where("kind = 0").select("term", "odds").collect()}
    # innocent words that the lexicon would match are exceptions; all of them, as a near one stands for its term's distance
    common = rated.where((F.col("kind") == 0) & (F.col("neg") > 0) & (F.col("odds") < 2)).select("term")
    met = common.mapInArrow(_innocent(spark.sparkContext.broadcast(Lexicon(stems, words))), "term binary")
    return Lexicon(stems, words, frozenset(bytes(r.term) for r in scratch.table(met, "innocent").collect()))


def _innocent(lexicon: Broadcast):
    """Words that the lexicon matches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, automata = np.ones(256, dtype=bool), Automata(lexicon.value)
        for batch in batches:
            met = automata.match(words_of(batch.column("term"), whole)) != 0    # every term is one word here
            yield batch.filter(pa.array(met))
    return run


# --- matching -------------------------------------------------------------------------------

DEAD, FAR = 0, 100


class Prefixes:
    """Distinct beginnings of words (of ``width`` bytes at most), level by level: each one's last byte, and which one of the level before it goes on."""

    def __init__(self, w: Words, width: int):
        n, norm = len(w.start), LOWER[w.data]
        size = np.minimum(w.end - w.start, width)
        table = np.zeros((n, max(width, 1)), dtype=np.uint8)         # words hold no NUL
        for k in range(int(size.max(initial=0))):
            has = np.flatnonzero(size > k)
            table[has, k] = norm[w.start[has] + k]
        order = np.argsort(table.view(f"S{table.shape[1]}").ravel(), kind="stable")
        table, size = table[order], size[order]
        shared = np.full(n, -1)                                      # bytes that a word begins with like the one before
        differ = table[1:] != table[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.last = np.zeros(n, dtype=np.int64)                      # the place of each whole word among all of them
        node, before = np.zeros(n, dtype=np.int64), 1
        for k in range(1, int(size.max(initial=0)) + 1):
            begins = (size >= k) & (shared < k)
            at = np.flatnonzero(begins)
            self.levels.append((node[at], table[at, k - 1]))
            node = np.cumsum(begins) - 1
            ends = size == k
            self.last[order[ends]] = before + node[ends]
            before += len(at)


class Automaton:
    """Deterministic automaton of all words within the terms' edit distances, built as it is used.

    A state holds for each trie node the fewest edits with which the bytes read so far lead to it (``FAR``: none).
    State DEAD leads nowhere; the next ones, one a stem, are never left. Bytes of no term act alike: they share a
    class. All states that a batch newly needs at a position are made at once, a level of the trie after the other.
    """

    def __init__(self, lexicon: Lexicon):
        terms = [*((s, w, 0, True) for s, w in sorted(lexicon.stems.items())), *((t, w, most, False) for t, (w, most) in sorted(lexicon.words.items()))]
        self.weights = np.array([0.0, *(w for _, w, _, _ in terms)])
        self.width = max((len(t) + most + 1 for t, _, most, _ in terms), default=0)      # no longer word is a term
        self.fixed = len(lexicon.stems)           # states up to this one are DEAD and the stems
        # nodes of the trie level by level, so that a level's columns lie together
        beginnings = sorted({t[:k] for t, *_ in terms for k in range(len(t) + 1)} | {b""}, key=lambda x: (len(x), x))
        node = {x: k for k, x in enumerate(beginnings)}
        self.size, self.empty = len(node), len(node) == 1
        depth = np.array([len(x) for x in beginnings])
        self.levels = [slice(*np.searchsorted(depth, [d, d + 1])) for d in range(1, depth[-1] + 1)]
        self.parent = np.array([node[x[:-1]] for x in beginnings])
        used = sorted({x[-1] for x in beginnings[1:]})
        self.kind = np.zeros(256, dtype=np.uint8)                # class of a byte; 0: in no term
        self.kind[used] = np.arange(1, len(used) + 1)
        self.edge = np.array([0, *(self.kind[x[-1]] for x in beginnings[1:])], dtype=np.uint8)
        self.reach = np.zeros(self.size, dtype=np.uint8)         # edits that some word below a node allows
        words, stems = [], []
        for number, (term, weight, most, is_stem) in enumerate(terms, 1):
            for k in range(len(term) + 1):
                self.reach[node[term[:k]]] = max(self.reach[node[term[:k]]], most)
            if is_stem:
                stems.append((node[term], number))
            else:
                words.append((-weight, number, node[term], most))
        self.stem_at, self.stem_state = (np.array([x[k] for x in stems], dtype=np.int64) for k in (0, 1))
        # of words with as few edits the one of the highest weight, then the first
        words.sort()
        self.word_number, self.word_at, self.word_most = (np.array([w[k] for w in words], dtype=np.int64) for k in (1, 2, 3))
        self.forget()

    def forget(self) -> None:
        """Begin anew without states."""
        room = 2 * self.fixed + 64
        self.count, self.ids = 0, {}
        self.costs = np.empty((room, self.size), dtype=np.uint8)
        self.next = np.empty((room, int(self.kind.max()) + 1), dtype=np.int32)
        self.end, self.price = np.empty(room, dtype=np.int32), np.empty(room, dtype=np.int32)
        nowhere = np.full((1, self.size), FAR, dtype=np.uint8)
        self._add(np.repeat(nowhere, self.fixed + 1, axis=0))
        self.ids[nowhere.tobytes()] = DEAD
        self.next[:self.fixed + 1] = np.arange(self.fixed + 1)[:, None]
        self.end[:self.fixed + 1] = np.arange(self.fixed + 1)
        start = nowhere.copy()
        start[0, 0] = 0
        self.root = int(self._states(self._close(start))[0])

    def _close(self, cost: np.ndarray) -> np.ndarray:
        """With the nodes reached by leaving out bytes of a term."""
        for level in self.levels:
            np.minimum(cost[:, level], cost[:, self.parent[level]] + 1, out=cost[:, level])
        cost[cost > self.reach] = FAR
        return cost

    def _add(self, cost: np.ndarray) -> None:
        """Append states, with the best word that ends at each."""
        first, self.count = self.count, self.count + len(cost)
        if self.count > len(self.costs):
            room = 2 * self.count
            for name in ("costs", "next", "end", "price"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old[:first], np.empty((room - first, *old.shape[1:]), dtype=old.dtype)]))
        mine = slice(first, self.count)
        self.costs[mine], self.next[mine], self.end[mine], self.price[mine] = cost, -1, 0, 0
        if len(self.word_at):
            spent = cost[:, self.word_at].astype(np.int32)
            spent[spent > self.word_most] = FAR
            best = spent.argmin(axis=1)
            price = spent[np.arange(len(cost)), best]
            fits, number = price < FAR, self.word_number[best]
            self.end[mine] = np.where(fits, np.where(price > 0, -number, number), 0)
            self.price[mine] = np.where(fits, price, 0)

    def _states(self, cost: np.ndarray) -> np.ndarray:
        """Numbers of the states of these costs; new ones are added."""
        out, fresh, at = np.empty(len(cost), dtype=np.int32), [], self.count
        for k, key in enumerate(row.tobytes() for row in cost):
            number = self.ids.get(key)
            if number is None:
                number = self.ids[key] = at + len(fresh)
                fresh.append(k)
            out[k] = number
        if fresh:
            self._add(cost[fresh])
        return out

    def _follow(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The states after these states and byte classes."""
        old = self.costs[state]
        cost = old[:, self.parent] + (self.edge != kind[:, None])
        cost[:, 0] = FAR
        cost = self._close(np.minimum(cost, old + 1))
        to, goes_on = np.empty(len(cost), dtype=np.int32), np.ones(len(cost), dtype=bool)
        if len(self.stem_at):
            begun = cost[:, self.stem_at] == 0    # at most one, as bytes without an edit lead to one node
            goes_on = ~begun.any(axis=1)
            to[~goes_on] = self.stem_state[begun[~goes_on].argmax(axis=1)]
        to[goes_on] = self._states(cost[goes_on])
        return to

    @property
    def bytes(self) -> int:
        """About what the states take."""
        return self.count * (2 * self.size + 4 * self.next.shape[1] + 160)

    def match(self, w: Words) -> np.ndarray:
        """For each word the number of the term that it is, minus that number for a near miss, or 0."""
        state = self.states(Prefixes(w, self.width))      # adds to the states' ends
        return self.end[state]

    def states(self, prefixes: Prefixes) -> np.ndarray:
        """The state at the end of each word."""
        if self.empty:
            return np.zeros(len(prefixes.last), dtype=np.int32)
        out, wide = [np.array([self.root], dtype=np.int32)], self.next.shape[1]
        for parent, byte in prefixes.levels:
            state = out[-1][parent]
            live = np.flatnonzero(state > self.fixed)
            now, kind = state[live], self.kind[byte[live]]
            to = self.next[now, kind]
            new = to < 0
            if new.any():
                s, k = np.divmod(np.unique(now[new].astype(np.int64) * wide + kind[new]), wide)
                for part in range(0, len(s), 4096):
                    mine = slice(part, part + 4096)
                    found = self._follow(s[mine], k[mine].astype(np.uint8))
                    self.next[s[mine], k[mine]] = found
                to = self.next[now, kind]
            state[live] = to
            out.append(state)
        return np.concatenate(out)[prefixes.last]


class Automata:
    """The matches of one :class:`Automaton` of the whole lexicon, by several small ones: their states add up instead of combining."""

    def __init__(self, lexicon: Lexicon, held: int = HELD, held_stems: int = HELD_STEMS):
        stems, words = sorted(lexicon.stems.items()), sorted(lexicon.words.items())
        self.parts = [Automaton(Lexicon(dict(stems[k:k + held_stems]), {})) for k in range(0, len(stems), held_stems)]
        self.parts += [Automaton(Lexicon({}, dict(words[k:k + held]))) for k in range(0, len(words), held)]
        self.weights = np.array([0.0, *(x for part in self.parts for x in part.weights[1:])])
        self.width = max((part.width for part in self.parts), default=0)

    def match(self, w: Words) -> np.ndarray:
        """As :meth:`Automaton.match`: the shortest stem, else the fewest edits, the highest weight, the first term."""
        _, at, where = np.unique(w.hash, return_index=True, return_inverse=True)
        code = np.zeros(len(at), dtype=np.int32)
        for lo in range(0, len(at), AT_ONCE):
            some = at[lo:lo + AT_ONCE]
            code[lo:lo + AT_ONCE] = self._distinct(Words(w.data, w.rows, w.start[some], w.end[some], w.hash[some], w.first))
        return code[where]

    def _distinct(self, w: Words) -> np.ndarray:
        code, price, weight = np.zeros(len(w.start), dtype=np.int32), np.full(len(w.start), FAR), np.zeros(len(w.start))
        before, prefixes = 0, Prefixes(w, self.width)
        for part in self.parts:
            if part.bytes > HELD_BYTES // len(self.parts):
                part.forget()
            state = part.states(prefixes)
            hit = np.flatnonzero(part.end[state])
            got, cost = part.end[state[hit]], part.price[state[hit]] - (part.fixed > 0)      # stems go first
            got = got + np.sign(got) * np.int32(before)
            value = self.weights[np.abs(got)]
            better = (cost < price[hit]) | ((cost == price[hit]) & (cost >= 0) & (value > weight[hit]))
            hit, got, cost, value = hit[better], got[better], cost[better], value[better]
            code[hit], price[hit], weight[hit] = got, cost, value
            before += len(part.weights) - 1
        return code


# --- scoring --------------------------------------------------------------------------------

def _quoted(text: bytes, word: int, starts: np.ndarray, ends: np.ndarray, norm: bytes) -> bool:
    """Whether a hit's window of words is a quotation or a report."""
    lo, hi = max(0, word - WINDOW), min(len(starts), word + WINDOW + 1)
    before, after = text[starts[lo]:starts[word]], text[ends[word]:ends[hi - 1] + 1]
    if any(q in before for q in _QUOTE_BYTES) and any(q in after for q in _QUOTE_BYTES):
        return True
    return any(norm[starts[k]:ends[k]] in _REPORTING for k in range(max(0, word - 4), word))


_QUOTE_BYTES = [q.encode() for q in QUOTES]
_REPORTING = {r.encode() for r in REPORTING}


def _weigh(lexicon: Broadcast):
    """doc_id, weighed hits and number of words of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, exceptions = Automata(lexicon.value), lexicon.value.exceptions
        for batch in slices(batches):
            w = words_of(batch.column("text"), ALNUM)
            hit = automaton.match(w)
            weights = np.zeros(batch.num_rows)
            at = np.flatnonzero(hit)
            row = np.searchsorted(w.first, at, side="right") - 1
            last = -1
            for k, r in zip(at.tolist(), row.tolist()):
                if exceptions and LOWER[w.data[w.start[k]:w.end[k]]].tobytes() in exceptions:
                    continue
                if r != last:
                    lo, mine, last = w.rows[r], slice(w.first[r], w.first[r + 1]), r
                    raw = w.data[w.rows[r]:w.rows[r + 1]]
                    text, norm, starts, ends = raw.tobytes(), LOWER[raw].tobytes(), w.start[mine] - lo, w.end[mine] - lo
                value = automaton.weights[abs(hit[k])] * (1.0 if hit[k] > 0 else FUZZY)
                weights[r] += value * (QUOTED if _quoted(text, k - int(w.first[r]), starts, ends, norm) else 1.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(weights), pa.array(np.diff(w.first), pa.int64())], names=["doc_id", "weight", "n_words"])
    return run


def _text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def fit_curve(weight: np.ndarray, n_words: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> tuple[float, float, float]:
    """Logistic coefficients (offset, of log1p(weight), of log1p(weight in 100 words)); ridge, slopes not negative."""
    design = np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(100 * weight / (n_words + 10))], axis=1)
    beta = np.array([np.log((times[toxic].sum() + 0.5) / (times[~toxic].sum() + 0.5)), 0.0, 0.0])
    ridge = np.diag([1e-3, 1e-1, 1e-1])
    for free in ([0, 1, 2], [0, 1], [0, 2]):
        part, b = design[:, free], beta[free]
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(part @ b, -30, 30)))
            step = np.linalg.solve((part * (times * p * (1 - p))[:, None]).T @ part + ridge[np.ix_(free, free)], part.T @ (times * (toxic - p)) - ridge[np.ix_(free, free)] @ b)
            b = b + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
        if (b[1:] >= 0).all():
            break
    out = np.zeros(3)
    out[free] = b
    return float(out[0]), float(max(out[1], 0)), float(max(out[2], 0))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    train = scratch.table(training_labels(labels), "train")
    ids, toxic = draw_sample(train)
    lexicon = learn(docs, (ids, toxic), scratch)
    weighed = scratch.table(_text(docs).mapInArrow(_weigh(spark.sparkContext.broadcast(lexicon)), "doc_id long, weight double, n_words long"), "weighed")
    offset, by_weight, by_density = -30.0, 0.0, 0.0
    if len(ids):
        n_toxic, n_all = train.agg(F.sum("toxic"), F.count(F.lit(1))).first()
        drawn = spark.createDataFrame([(int(d), bool(t)) for d, t in zip(ids, toxic)], "doc_id long, toxic boolean")
        rows = weighed.join(drawn, "doc_id").groupBy("doc_id", "toxic").agg(F.max("weight").alias("weight"), F.max("n_words").alias("n_words")).orderBy("doc_id").toPandas()
        if len(rows):
            up = np.where(rows["toxic"], n_toxic / max(1, toxic.sum()), (n_all - n_toxic) / max(1, (~toxic).sum()))
            offset, by_weight, by_density = fit_curve(rows["weight"].to_numpy(float), rows["n_words"].to_numpy(float), rows["toxic"].to_numpy(bool), up)
    line = F.lit(offset) + F.lit(by_weight) * F.log1p("weight") + F.lit(by_density) * F.log1p(100 * F.col("weight") / (F.col("n_words") + 10))
    value = 1 / (1 + F.exp(-line))
    return weighed.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), value.alias("score"), (value >= threshold).cast("int").alias("predicted"))
