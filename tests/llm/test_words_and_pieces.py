"""Spelling variants, periodic runs and piece codec against brute force and the library."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import periodic_runs, piece_codec, queries, spelling
from tessera.llm.scratch import Scratch

SMOKE = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, word string, n long, ids_ string"
sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def corpus():
    """Few stems with misspellings, accents, repeated stretches, nulls, empties, repeated and null ids, a long text."""
    rnd = random.Random(11)
    stems = ["".join(rnd.choice("aeinrstéÿ") for _ in range(rnd.randint(5, 9))) for _ in range(25)]

    def typed(w):
        k, c = rnd.randrange(len(w)), rnd.choice("aeinrstéÿX")
        return rnd.choice([w, w, w, w, w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])
    texts = [" ".join(typed(rnd.choice(stems[:3] if rnd.random() < .6 else stems)) for _ in range(rnd.randint(0, 150))) for _ in range(120)]
    texts += [None, "", " \n ", "Ab" * 30_000, "x y " * 5_000, "漢字 漢字\t漢字 " * 5, "one-two_three4four ÀÉÎ×÷Þ", "a " * 14 + "b c " * 8 + "d e f " * 9, texts[0], texts[0]]
    rows = [(k, t, "clash", -1, "clash") for k, t in enumerate(texts)]
    return rows + [(7, "repeated id " * 9, None, None, None), (None, "no id " * 20, "x", 1, "y"), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


# ---------------------------------------------------------------- spelling variants
def brute_variants(rows):
    many = collections.Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            many[run] += 1
    words = {w: n for w, n in many.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))
    out = {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if o != w and abs(len(o) - len(w)) < 2 and near(w, o))
        form = others[0][1] if others and -others[0][0] >= 5 * n else None
        out[w] = [form, w, n, len(others), words[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {(w, *row) for w, row in out.items()}


def variants(df):
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


def test_variants_against_brute_force(docs, corpus):
    expected = brute_variants(corpus)
    assert len(expected) > 20 and any(row[1] for row in expected) and any(row[4] > 2 for row in expected)
    got = spelling.group_variants(docs)
    assert variants(got) == expected
    assert got.count() == len(expected)


def test_many_rounds_of_filters_change_nothing(docs, monkeypatch):
    whole = variants(spelling.group_variants(docs))
    monkeypatch.setattr(spelling, "EDITS", 64)
    assert variants(spelling.group_variants(docs, most=7)) == whole
    rounds = spelling.rounds_of({6: 10, 7: 3}, 4)
    assert rounds == [[(6, 0, 4)], [(6, 4, 8)], [(6, 8, 10), (7, 0, 2)], [(7, 2, 3)]]


def test_chains_of_forms_and_empty_tables(spark, docs):
    text = " ".join(["aaaaaa"] * 5 + ["aaaaab"] * 30 + ["aaaabb"] * 200 + ["aaabbb"] * 1100 + ["zzzzzz"] * 5 + ["zzzzzzz"] * 26 + ["zzzzzzy"] * 26)
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame([(None, text)], "doc_id long, text string")).collect()}
    assert [got[w].root for w in ("aaaaaa", "aaaaab", "aaaabb", "aaabbb")] == ["aaabbb"] * 4
    assert got["aaaaaa"].form == "aaaaab" and got["aaabbb"].form is None and got["aaaabb"].n_near == 2
    assert got["zzzzzz"].form == "zzzzzzy" and got["zzzzzz"].n_near == 2          # a tie: smallest in order
    assert spelling.group_variants(docs.limit(0)).collect() == []


def test_variant_filters_have_no_false_negatives(spark):
    words = ["".join(random.Random(k).choice("abcdé") for _ in range(6 + k % 5)) for k in range(3000)]
    vocab = spark.createDataFrame([(w, 5) for w in sorted(set(words))], "word string, n long")
    near = {(r.word, r.near) for r in spelling.near_words(vocab, Scratch(spark, "t"), most=300).collect()}
    held = set(words)
    edits = {(w, w[:i] + c + w[i + 1:]) for w in held for i in range(len(w)) for c in "abcdé" if w[i] != c} | {(w, w[:i] + w[i + 1:]) for w in held for i in range(len(w))}
    edits = {(a, b) for a, b in edits if b in held}
    assert near == edits | {(b, a) for a, b in edits}


# ---------------------------------------------------------------- periodic runs
def brute_runs(words):
    code = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.empty(0, int)
    out = {}
    for q in range(1, len(code) // 2 + 1):
        same = np.concatenate([[0], (code[:-q] == code[q:]).astype(int), [0]])
        edge = np.flatnonzero(np.diff(same))
        for s, e in zip(edge[::2], edge[1::2]):
            if e - s + q >= max(12, 2 * q):
                out.setdefault((int(s), int(e - s + q)), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()), sha(" ".join(w for i, w in enumerate(words) if i not in gone).encode()))


def test_runs_against_brute_force(docs, corpus):
    got = collections.Counter(tuple(r) for r in periodic_runs.report(periodic_runs.detect(docs, periodic_runs.planted)).collect())
    assert got == collections.Counter((k, *brute_row(k, t)) for k, t, *_ in corpus)
    assert any(r[1] > 1 for r in got)


def test_runs_of_the_smallest_table(spark):
    rows = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op12_periodic_runs(spark, SMOKE).collect()}
    assert got == {r.doc_id: brute_row(r.doc_id, r.text) for r in rows}


def test_runs_of_nested_repeats():
    rnd = random.Random(2)
    texts = []
    for _ in range(400):
        n, kinds = rnd.randint(0, 130), rnd.choice([1, 2, 3, 40])
        w = [rnd.randrange(kinds) for _ in range(n)]
        if n > 4 and rnd.random() < .6:
            a, p = rnd.randrange(n), 1 + n // rnd.randint(3, 9)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        texts.append(w)
    word = [0, 1]
    for _ in range(14):
        word = word + word[:int(len(word) / 1.618)]
    texts += [[1] * 5000, word, [k % 333 for k in range(3000)]]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    document, start, length, period = periodic_runs.find_runs(np.array([x for t in texts for x in t], dtype=np.int64), first)
    for k, t in enumerate(texts):
        mine = document == k
        assert list(zip(start[mine], length[mine], period[mine])) == brute_runs(t)


def test_block_occurrences_are_exact():
    rnd = np.random.default_rng(4)
    for size in (1, 2, 8, 64):
        window = rnd.integers(0, 3, (50, 3 * size - 1)).astype(np.uint64)
        block = np.array([row[k % (2 * size):][:size] for k, row in enumerate(window)])
        expected = [[(row[d:d + size] == b).all() for d in range(2 * size)] for row, b in zip(window, block)]
        assert (periodic_runs.occurrences(block, window) == np.array(expected)).all()
    rows = rnd.integers(0, int(periodic_runs.PRIME), (5, 32)).astype(np.uint64)
    assert (periodic_runs.transform(periodic_runs.transform(rows), inverse=True) == rows).all()


# ---------------------------------------------------------------- pieces
@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


def coded(df):
    return collections.Counter(tuple(r) for r in piece_codec.report(df).collect())


def by_library(sp, rows):
    out = collections.Counter()
    for k, text in rows:
        ids = sp.encode(text or "")
        out[(k, len(ids), sha(",".join(map(str, ids)).encode()), sha(sp.decode(ids).encode()))] += 1
    return out


def test_pieces_like_the_library(docs, corpus, library):
    assert coded(piece_codec.encode(docs, queries.PIECES, decoded="decoded")) == by_library(library, [r[:2] for r in corpus])
    assert piece_codec.encode(docs, queries.PIECES).columns == [*docs.columns, "ids"]


def test_pieces_of_the_smallest_table(spark, library):
    rows = spark.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").collect()
    assert collections.Counter(tuple(r) for r in queries.op13_pieces(spark, SMOKE).collect()) == by_library(library, rows)


def test_pieces_of_odd_texts(library):
    codec, rnd = piece_codec.codec(queries.PIECES), random.Random(9)
    pieces = list(codec.id)
    texts = ["", None, " ", "   ", "\n", "▁", "a▁b ▁▁ ", "é" * 50, " " * 70 + "x", "🦠\x00a", "<s><0x41> </s><unk>", "aaaa" * 300]
    texts += ["".join(rnd.choice("aab  bc ▁\n\t.é漢字ж🦠0123 ") for _ in range(rnd.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6))).replace("▁", rnd.choice("▁ ")) for _ in range(5000)]
    ids, start = codec.encode(texts)
    for text, lo, hi in zip(texts, start, start[1:]):
        mine = ids[lo:hi].tolist()
        assert mine == library.encode(text or "") and codec.decode(mine) == library.decode(mine)


def test_decoding_of_any_ids_and_forgetting(spark, library, monkeypatch):
    codec, rnd = piece_codec.PieceCodec(queries.PIECES), random.Random(3)
    for _ in range(2000):                       # bytes that are no text among them
        ids = [rnd.randrange(1, 270) if rnd.random() < .5 else rnd.randrange(1, 32000) for _ in range(rnd.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids)
    monkeypatch.setattr(piece_codec, "KEPT", 3)
    for text in ("the quick brown fox jumps", "over the lazy dog", "the end"):
        assert codec.encode([text])[0].tolist() == library.encode(text)
    rows = spark.createDataFrame([(1, [306, 1]), (2, None), (3, [])], "k long, ids array<int>")
    assert {r.k: r.decoded for r in piece_codec.decode(rows, queries.PIECES).collect()} == {1: library.decode([306, 1]), 2: "", 3: ""}
    assert piece_codec.encode(rows.select(F.lit("x").alias("text")).limit(0), queries.PIECES).count() == 0
    with pytest.raises(ValueError, match="ids"):
        piece_codec.encode(rows.select("ids", F.lit("x").alias("text")), queries.PIECES)
