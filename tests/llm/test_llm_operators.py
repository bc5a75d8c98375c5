"""Training-data operators on small fixtures: brute force, round trips and edge cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import decontaminate, line_dedup, mixing, near_dups, quality, queries, token_files, topk, toxicity, warc_audit
from tessera.llm.scratch import Scratch
from tessera.llm.token_rollups import TokenRollups

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string"
LABELS = "doc_id long, quality int, toxic int"


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, (text or "").translate(ASCII_LOWER))


@pytest.fixture(scope="module")
def corpus():
    """Documents with copies, near copies, shared lines, nulls, empties, a long text and clashing columns."""
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    texts = ["\n".join(line(rnd.randint(3, 15)) for _ in range(rnd.randint(1, 8))) for _ in range(60)]
    for k in range(20):                                    # near copies of a few texts, one word changed
        w = texts[k % 4].split(" ")
        w[rnd.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    texts += texts[:6] + ["  A Common LINE of more than twenty\n" + line(5) for _ in range(5)]
    texts += [None, "", " \n\t", "one", "one", "x " * 30_000, "Ünï 漢字 \U0001F9A0 it's", "a\n\nb\n"]
    return [(k, t, ("en", "de", None)[k % 3], ("a", "b", "c", "d", None)[0 if k % 3 == 0 else k % 5], None, "clash") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3)


def collected(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("width", [2, 5])
def test_near_dups_against_brute_force(docs, corpus, width):
    sets = {}
    for k, text, *_ in corpus:
        w = words(text)
        sets[k] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    label = {k: k for k in sets}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k
    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                label[max(x, y)] = min(x, y)
    got = {r.doc_id: r for r in near_dups.report(near_dups.components(docs, width)).collect()}
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert {k: r.component_id for k, r in got.items()} == {k: root(k) for k in sets}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_large_nodes_branch_and_chunks_compare(docs, monkeypatch):
    whole = sorted(collected(near_dups.components(docs)))
    monkeypatch.setattr(near_dups, "CHUNK", 2)
    assert sorted(collected(near_dups.components(docs, depth=1, small=2))) == whole


def test_keep_one_keeps_columns_and_one_of_each_group(docs, corpus):
    kept = near_dups.keep_one(docs, width=2)
    assert kept.columns == docs.columns
    expected = {r.doc_id for r in near_dups.report(near_dups.components(docs)).collect() if r.kept}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_near_dups_of_repeated_and_null_ids(spark):
    a, b = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    rows = [(1, a, "r"), (1, b, "r"), (2, a + " end", "r"), (3, b + " end", "r"), (None, a + " more", "r"), (None, "alone in the world", "r"),
            (None, "alone in the world", "r"), (None, None, "r"), (4, "", "r"), (9, a, "r"), (9, a, "r")]
    table = spark.createDataFrame(rows, "doc_id long, text string, row string")
    got = collections.Counter(tuple(r) for r in near_dups.report(near_dups.components(table)).collect())
    assert got == collections.Counter([(1, 39, 1, True), (1, 39, 1, True), (2, 40, 1, False), (3, 40, 1, False), (None, 40, 1, False), (None, 3, None, True),
                                       (None, 3, None, True), (None, 0, None, True), (4, 0, 4, True), (9, 39, 1, False), (9, 39, 1, False)])
    kept = near_dups.keep_one(table, width=2)
    assert kept.columns == table.columns
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter([(1, a), (1, b), (None, "alone in the world"), (None, None), (4, "")])
    assert near_dups.keep_one(table.limit(0)).count() == 0


def test_a_cloud_of_copies_is_one_group_and_pairs_come_once(spark):
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = [" ".join(w if rnd.random() > .06 else f"x{rnd.randrange(9999)}" for w in base) for _ in range(300)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(999, " ".join(base))]
    got = near_dups.components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80)
    sets = {k: set(t.split()) for k, t in rows}
    label = {k: k for k in sets}
    for _ in range(12):
        for x in sets:
            near = [label[y] for y in sets if 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
            label[x] = min(near)
    assert {r.doc_id: r.component_id for r in got.collect()} == label


def test_warc_audit_finds_what_differs(spark):
    a = spark.createDataFrame([(k, f"record {k}") for k in range(300)] + [(7, "again"), (None, "lost place")], "offset long, record string").withColumn("record", F.col("record").cast("binary"))
    b = spark.createDataFrame([(k, f"record {k}" if k != 130 else "rotten") for k in range(299)] + [(7, "again"), (None, "lost place"), (70_000, "new")], "offset long, record string").withColumn("record", F.col("record").cast("binary"))
    assert sorted((r.offset, r.status) for r in warc_audit.audit(a, b).collect()) == [(130, "changed"), (299, "missing"), (70_000, "extra")]
    assert warc_audit.audit(a, a).count() == 0
    assert {r.status for r in warc_audit.audit(a.limit(0), b).collect()} == {"extra"}
    tree = warc_audit.MerkleTree(a, 2, Scratch(spark, "t"), "x")
    root = {r.node: r for r in tree.root().collect()}
    assert root[0].n == 301 and root[-1].n == 1


def test_mixing_meets_targets(docs, corpus):
    rows = mixing.mix(docs, group=7).collect()
    size = {k: len(words(t)) for k, t, *_ in corpus}
    totals = collections.Counter()
    for k, _, _, source, *_ in corpus:
        totals[source] += size[k]
    taken, target = collections.Counter(), {}
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == totals[r.source] and 0 <= r.times <= 3
        taken[r.source] += r.size * r.times
        target[r.source] = r.target
    assert abs(sum(target.values()) - min(sum(totals.values()), 3 * sum(totals.values()))) < 1e-6 * sum(totals.values())
    assert all(t <= 3 * totals[s] + 1e-6 for s, t in target.items())
    for s in target:
        biggest = max(size[k] for k, *rest in corpus if rest[2] == s)
        assert abs(taken[s] - target[s]) <= biggest
    assert sorted(collected(mixing.mix(docs.repartition(5), group=7)), key=str) == sorted(map(tuple, rows), key=str)
    repeated = mixing.repeat_documents(docs, mixing.mix(docs, group=7))
    assert repeated.columns == docs.columns and repeated.count() == sum(r.times for r in rows)


def test_topk_against_brute_force(spark):
    rnd = np.random.default_rng(1)
    vectors = [(int(k), [float(x) for x in rnd.normal(size=8)]) for k in range(700)]
    vectors += [(701, None), (702, [1.0, None]), (703, [float("nan")] * 8), (704, [0.5, 0.25]), (705, vectors[3][1]), (None, [1.0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, block_rows=200, query_rows=3).collect()}
    fine = {k: np.floor(np.array(v + [0.0] * (8 - len(v))) * 1024).astype(int) for k, v in vectors if k is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    for query in (0, 100, 600):
        best = sorted((-int(fine[query] @ v), k) for k, v in fine.items() if k != query)[:10]
        assert [got[query, r] for r in range(1, 11)] == [(k, -s) for s, k in best]
    assert topk.top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2


def test_topk_of_wide_vectors_against_brute_force(spark):
    rnd = np.random.default_rng(2)
    sizes = [1.0, 2.0 ** 18, 1e9, 1e17, 1e200, 1.7e308]
    vectors = [(int(k), [float(x) for x in rnd.normal(size=5).clip(-1, 1) * sizes[0 if k % 3 else (k // 3) % len(sizes)]]) for k in range(150)]
    vectors += [(150, [2.0 ** 60]), (151, [2.0 ** 60, 1.0]), (152, vectors[10][1]), (9, vectors[20][1]), (153, []), (154, [float("inf"), 1.0]), (155, [1e30, None]), (None, [1e30])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)

    def whole(x):
        return int(np.floor(x * 1024)) if abs(x) < 1e300 else int(x) * 1024
    fine = [(k, [whole(x) for x in v] + [0] * (5 - len(v))) for k, v in vectors if k is not None and all(x is not None and np.isfinite(x) for x in v)]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, k=100, block_rows=40, query_rows=4).collect()}
    for query, q in [(k, v) for k, v in fine if k % 10 == 0]:
        best = sorted((-sum(a * b for a, b in zip(q, v)), k) for k, v in fine if k != query)[:100]
        assert [got[query, r] for r in range(1, 101)] == [(k, min(max(-s, -2 ** 63), 2 ** 63 - 1)) for s, k in best], query
    two = spark.createDataFrame([(0, [3e5, 1.0]), (1, [1.0, 2.0]), (2, [-4e5, 0.0])], "vec_id long, embedding array<float>")
    assert collected(topk.top_k(two, F.col("vec_id") == 0)) == [(0, 1, 1, 3072 * 10 ** 5 * 1024 + 1024 * 2048), (0, 2, 2, -3072 * 10 ** 5 * 4096 * 10 ** 5)]
    one = two.where("vec_id = 0").withColumn("q", F.lit("clash")).withColumn("block", F.lit(1))
    assert topk.top_k(one, F.col("vec_id") == 0).count() == 0


def test_rollups_are_idempotent_and_survive_reopening(spark):
    scratch = Scratch(spark, "rollup-test")
    rows = lambda *x: spark.createDataFrame(list(x), "doc_id long, tokenizer string, source string, lang string, n_tokens long")
    state = TokenRollups(spark, scratch.path("s"))
    assert state.totals().count() == 0
    assert state.commit("1", rows((1, "t", "a", "en", 10), (2, "t", None, None, 5), (2, "t", None, None, 4), (None, "t", "a", "en", 9)))
    assert state.commit("2", rows((1, "t", "b", "en", 7), (3, "t", "a", "en", None)))
    assert not TokenRollups(spark, scratch.path("s")).commit("1", rows((1, "t", "a", "en", 99)))
    expected = {("b", "en", "t", 1, 7), (None, None, "t", 1, 5)}
    assert set(collected(state.totals())) == expected
    state.compact()
    assert set(collected(TokenRollups(spark, scratch.path("s")).totals())) == expected
    state.commit("3", rows((2, "t", None, None, None), (1, "u", "b", "en", 1)))
    assert set(collected(state.totals())) == {("b", "en", "t", 1, 7), ("b", "en", "u", 1, 1)}


def test_rollups_join_the_snapshot_without_moving_it(spark):
    rnd = random.Random(8)
    scratch = Scratch(spark, "rollup-snapshots")
    schema = "doc_id long, tokenizer string, source string, lang string, n_tokens long, was string, turn string"
    now = {}
    for turn in range(4):
        batch = {(rnd.randrange(30), rnd.choice("tu")): (rnd.choice(["a", "b", None]), rnd.choice(["en", None]), rnd.choice([None, 1, 2, 3])) for _ in range(25)}
        now.update(batch)
        state = TokenRollups(spark, scratch.path("s"))      # reopened each time
        assert state.commit(f"b{turn}", spark.createDataFrame([(*k, *v, "clash", None) for k, v in batch.items()], schema))
        expected = collections.defaultdict(lambda: [0, 0])
        for (_, tokenizer), (source, lang, n) in now.items():
            if n is not None:
                expected[source, lang, tokenizer][0] += 1
                expected[source, lang, tokenizer][1] += n
        assert {r[:3]: list(r[3:]) for r in collected(state.totals())} == expected
        if turn in (1, 2):
            state.compact()
            state.compact()
    name, buckets, held = state._folded(state.committed())
    assert (name, held) == ("compact-3", {"b0", "b1", "b2"}) and buckets
    new = spark.createDataFrame([(1, "t", 5)], "doc_id long, tokenizer string, n long").groupBy("doc_id", "tokenizer").agg(F.max(F.struct("n")).alias("new"))
    plan = state._counted(new, sorted(held))._jdf.queryExecution().executedPlan().toString().splitlines()
    scan = next(k for k, line in enumerate(plan) if "Bucketed: true" in line)
    branch = plan[max(k for k in range(scan) if "SortMergeJoin" in plan[k] or "Exchange" in plan[k] and plan[k].index("Exchange") < plan[scan].index("FileScan")):scan + 1]
    assert "SortMergeJoin" in "".join(plan[:scan]) and not any("Exchange" in line for line in branch[1:])


def test_quality_rejects_junk_and_both_ways_agree(spark):
    rnd = random.Random(3)
    clean = [" ".join(rnd.choice(["the", "cat", "sat", "on", "a", "mat", "house", "with"]) for _ in range(40)) for _ in range(60)]
    junk = ["%%% ### !! " * 20, "zqxj " * 30]
    rows = [(k, t, "en") for k, t in enumerate(clean + junk)] + [(100, None, "en"), (101, "", "en"), (102, "kein Urteil", "de"), (103, clean[0], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)] + [(60, 0, 0)], LABELS)
    got = {r.doc_id: r for r in quality.classify(df, labels).collect()}
    assert all(got[k].kept for k in range(60)) and not got[60].kept and not got[61].kept
    assert not got[100].kept and got[100].perplexity is None and got[102].kept and got[102].perplexity is None and got[103].kept
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}
    scratch = Scratch(spark, "q")
    model = quality.train(df, labels.select("doc_id"), scratch)
    one, two = ({r.doc_id: r.loss for r in quality.score(df, model, scratch, model_rows=n).collect()} for n in (10 ** 9, 0))
    assert one.keys() == two.keys() and all((one[k] is None and two[k] is None) or abs(one[k] - two[k]) < 1e-6 for k in one)
    # order 1: the seen bytes' probabilities and the mass left to the others make one
    table = model.where("lang = 'en' and order = 1").collect()
    seen, back = [np.exp(r.logp) for r in table if r.logp is not None], next(np.exp(r.back) for r in table if r.back is not None)
    assert abs(sum(seen) + back * (256 - len(seen)) / 256 - 1) < 1e-9
    assert quality.classify(df, labels.limit(0)).where("kept").count() == len(rows) - 2
    assert quality.classify(df.limit(0), labels).count() == 0


def brute_quality(rows, trusted, held):
    """Losses, limits by language: interpolated modified Kneser-Ney over byte 5-grams, by hand."""
    stream = lambda text: b"\n" * 4 + (text or "").encode()
    cut = lambda text: [stream(text)[i:i + 5] for i in range(len((text or "").encode()))]
    models = {}
    for lang in {r[2] or "" for r in rows if r[0] in trusted - held and r[1]}:
        counts = {5: collections.Counter(g for r in rows if (r[2] or "") == lang and r[0] in trusted - held for g in cut(r[1]))}
        for o in (4, 3, 2, 1):
            counts[o] = collections.Counter(g[1:] for g in counts[o + 1])
        cuts, total, mass = {}, {}, {}
        for o, c in counts.items():
            many = [sum(n == k for n in c.values()) for k in range(1, 5)]
            y = many[0] / max(many[0] + 2 * many[1], 1)
            cuts[o] = [max(0.1, min(k - 0.1, k - (k + 1) * y * many[k] / max(many[k - 1], 1))) for k in (1, 2, 3)]
            total[o], mass[o] = collections.Counter(), collections.Counter()
            for g, n in c.items():
                total[o][g[:-1]] += n
                mass[o][g[:-1]] += cuts[o][min(n, 3) - 1]
        models[lang] = counts, cuts, total, mass

    def p(lang, gram):
        if not gram:
            return 1 / 256
        (counts, cuts, total, mass), o, context = models[lang], len(gram), gram[:-1]
        if not total[o][context]:
            return p(lang, gram[1:])
        n = counts[o][gram]
        return (max(n - cuts[o][min(n, 3) - 1], 0) if n else 0) / total[o][context] + mass[o][context] / total[o][context] * p(lang, gram[1:])
    losses = [(r[0], r[2] or "", len((r[1] or "").encode()), -sum(np.log(p(r[2] or "", g)) for g in cut(r[1])) if (r[2] or "") in models else None) for r in rows]
    limits = {}
    for lang in models:
        for ids in (trusted & held, trusted):
            bins = sorted(int(np.ceil(round(loss / n * 1000, 6))) for k, of, n, loss in losses if of == lang and k in ids and n)
            if bins and lang not in limits:
                at = next(i for i, _ in enumerate(bins) if sum(b <= bins[i] for b in bins) >= 0.995 * len(bins))
                limits[lang] = bins[at] / 1000 * (1 + 4 / len(bins))
    return losses, limits


def test_quality_against_kneser_ney_by_hand(spark):
    rnd = random.Random(11)
    clean = lambda n: " ".join(rnd.choice(["the", "cat", "sat", "on", "a", "mat", "ünder", "houses", "with"]) for _ in range(n))
    rows = [(k, clean(rnd.randint(1, 30)), ("en", "de", None)[k % 3]) for k in range(70)]
    rows += [(k, "".join(rnd.choice("xqz#%&\n") for _ in range(80)), "en") for k in range(70, 80)]
    rows += [(80, None, "en"), (81, "", "de"), (82, clean(4000), "en"), (5, clean(9), "de"), (83, clean(5), "fr"), (None, clean(6), "en")]
    labels = [(k, 1, 0) for k in range(60)] + [(70, 0, 0), (None, 1, 0), (3, 1, 0), (61, None, 0)]
    trusted = set(range(60))
    df = spark.createDataFrame([(*r, 1.0, "clash") for r in rows], "doc_id long, text string, lang string, loss double, n_bytes string").repartition(3)
    held = {r.doc_id for r in spark.range(60).withColumnRenamed("id", "doc_id").where(quality._held_out(F.col("doc_id"))).collect()}
    losses, limits = brute_quality(rows, trusted, held)
    got = sorted(quality.classify(df, spark.createDataFrame(labels, LABELS)).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_bytes))
    want = sorted(losses, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    assert len(got) == len(want)
    for r, (k, lang, n, loss) in zip(got, want):
        assert (r.doc_id, r.n_bytes) == (k, n)
        assert r.perplexity is None if not n or loss is None else r.perplexity == pytest.approx(np.exp(loss / n), rel=1e-6)
        assert r.threshold is None if lang not in limits else r.threshold == pytest.approx(np.exp(limits[lang]), rel=1e-6)
        assert r.kept == (n > 0 and (lang not in limits or loss / n <= limits[lang]))


def test_token_files_round_trip(spark, docs, corpus, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    expected, start = {}, 0
    for k, text, *_ in corpus:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        expected[k] = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    manifest = token_files.write_token_files(docs, queries.TOKENIZER, f"{tmp_path}/t", sequence=64)
    assert {r.doc_id: tuple(r)[1:] for r in token_files.read_documents(manifest).collect()} == expected
    part = manifest.first()
    batch = next(iter(token_files.open_stream(part.ids_path)))
    ids, mask = token_files.sequences_of(batch)
    assert ids.shape[1] == 64 and not ids.flags.owndata and len(mask) == len(ids)
    assert token_files.encode_corpus(docs.limit(0), queries.TOKENIZER).count() == 0


def test_encoder_splits_like_the_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    tokenizer.encode_special_tokens = True
    rnd = random.Random(2)
    letters = list("aZé'' 's 't 're 've 'll 'd'm  \n\n\t\r 09½!?.$ßñ  　漢あ́😀\U0001F9A0\u0085\x1c\x00ʼ٣​")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3000)] + ["", None, "<|endoftext|>", "'s"]
    ids, offsets = token_files.Encoder(queries.TOKENIZER).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def test_line_dedup_against_brute_force(docs, corpus):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)
    held = collections.defaultdict(set)
    for k, text, *_ in corpus:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(k)
    gone = {x: max(v) for x, v in held.items() if len(v) >= 3}
    got = {r.doc_id: tuple(r)[1:] for r in line_dedup.report(line_dedup.dedup_lines(docs, fanout=2)).collect()}
    for k, text, *_ in corpus:
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), k) == k]
        assert got[k] == (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    assert any(n for _, n, _ in got.values())


def test_runs_are_compacted_and_anti_joined(spark):
    runs = line_dedup.LineRuns(spark, Scratch(spark, "runs").path("r"), fanout=2, buckets=4)
    lines = lambda *x: spark.createDataFrame(list(x), "doc long, h1 long, h2 long")
    for batch in ([(1, 5, 5), (2, 5, 5)], [(3, 5, 5), (3, 6, 6)], [(4, 7, 7), (4, 5, 5)]):
        runs.add(lines(*batch))
    assert [len(level) for level in runs.levels] == [1, 1]
    held = [{tuple(r) for r in run.select("h1", "n_docs").collect()} for run in runs.runs()]
    assert held == [{(7, 1)}, {(5, 2), (6, 1)}]                  # a key is in the run of the batch that had it first
    assert set(collected(runs.keys().select("h1", "n_docs", "last_doc"))) == {(5, 4, 4), (6, 1, 3), (7, 1, 4)}
    assert [r.h1 for r in runs.fresh(lines((9, 5, 5), (9, 8, 8))).collect()] == [8]


def test_runs_are_joined_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = line_dedup.LineRuns(spark, Scratch(spark, "runs").path("r"), fanout=8, buckets=4)
        for k in range(3):
            runs.add(spark.range(100).selectExpr(f"id + {1000 * k} as doc", f"id + {50 * k} as h1", "id * 0 as h2"))
        batch = runs._bucketed(spark.range(400).selectExpr("id as h1", "id * 0 as h2"), "b").rows
        plan = runs.fresh(batch)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan
        totals = runs._totals()
        assert len(totals) == 3 and not any("Exchange" in t._jdf.queryExecution().executedPlan().toString() for t in totals)
        got = {r.h1: (r.n_docs, r.last_doc) for r in runs.keys().collect()}
        assert len(got) == 200 and got[75] == (2, 1025) and got[10] == (1, 10) and got[199] == (1, 2099)
        assert runs.fresh(batch).count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_toxicity_learns_terms_and_their_near_misses(spark):
    rnd = random.Random(4)
    fill = lambda: " ".join(rnd.choice(["stone", "river", "walks", "green", "table"]) for _ in range(30))
    rows = [(k, f"{fill()} {'horrible dreadful' if k % 4 == 0 else ''} {fill()}") for k in range(400)]
    extra = [(1000, fill() + " horible dreadfull " + fill()), (1001, None), (1002, ""), (1003, fill())]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)] + [(None, 1, 1)], LABELS)
    got = {r.doc_id: r for r in toxicity.score(df, labels).collect()}
    assert len(got) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())
    assert all(got[k].predicted == int(k % 4 == 0) for k in range(400))
    assert got[1000].score > got[1003].score and got[1001].predicted == 0 and got[1002].predicted == 0
    assert toxicity.score(df, labels.limit(0)).where("predicted = 1").count() == 0


def test_toxicity_keeps_the_distance_of_every_term(spark):
    rnd = random.Random(7)
    fill = lambda: " ".join(rnd.choice(["stone", "river", "walks", "green", "table"]) for _ in range(30))
    # horrible is a small part of its stem; grumble is innocent and near crumble
    said = lambda k: ("crumble " + ("horrible" if k % 16 == 0 else "horrid horror")) if k % 4 == 0 else "grumble"
    rows = [(k, f"{fill()} {said(k)} {fill()}") for k in range(400)]
    extra = [(1000, fill() + " hoprible"), (1001, fill() + " crimble"), (1002, fill() + " grumble"), (1003, fill())]
    df = spark.createDataFrame(rows + extra, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(400)], LABELS)
    got = {r.doc_id: r.score for r in toxicity.score(df, labels).collect()}
    assert got[1000] > got[1003] and got[1001] > got[1003] and abs(got[1002] - got[1003]) < 1e-12


def distance(a, b):
    """Levenshtein distance."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def brute_toxic_weights(rows, toxic):
    """Lexicon, exceptions and each row's (weight, number of words), by plain loops over all words and terms."""
    spans = lambda text: [(m.start(), m.end(), m.group().lower()) for m in re.finditer(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]
    tally = collections.defaultdict(lambda: [0, 0, 0])
    for k, text in rows:
        if k in toxic:
            found = collections.Counter()
            for _, _, w in spans(text):
                found.update([(0, w)] if 3 <= len(w) <= 24 else [])
                found.update((size, w[:size]) for size in range(4, 9) if len(w) >= size)
            for term, n in found.items():
                tally[term][not toxic[k]] += min(n, 3)
                tally[term][2] += toxic[k]
    rate = {}
    for kind in {kind for kind, _ in tally}:
        mine = {t: v for (of, t), v in tally.items() if of == kind}
        base = sum(v[0] for v in mine.values()) / sum(v[0] + v[1] for v in mine.values())
        for t, (pos, neg, n_docs) in mine.items():
            part = lambda k, share: k * np.log(k / ((pos + neg) * share)) if k else 0.0
            strength, odds = part(pos, base) + part(neg, 1 - base), (pos + 0.5) / (neg + 0.5) * (1 - base) / base
            rate[kind, t] = odds, strength, n_docs >= 3 and odds >= 8 and strength >= np.log(len(mine)) + 0.5
    stems = {}
    for (kind, t), (odds, strength, sure) in sorted(rate.items(), key=lambda r: (-round(r[1][1], 6), -r[0][0], r[0][1])):
        if kind and sure and not any(t.startswith(s) or s.startswith(t) for s in stems):
            stems[t] = np.log(odds)
    terms = {t: np.log(odds) for (kind, t), (odds, _, sure) in rate.items() if not kind and sure}

    def hit(w):
        for s, weight in stems.items():
            if w.startswith(s):
                return weight
        near = [(distance(w, t), -weight, t) for t, weight in terms.items() if abs(len(w) - len(t)) <= 2 and distance(w, t) <= toxicity.edits(len(t))]
        return -min(near)[1] * (0.6 if min(near)[0] else 1.0) if near else 0.0
    exceptions = {t for (kind, t), (odds, _, _) in rate.items() if not kind and odds < 2 and tally[kind, t][1] and hit(t)}
    out = []
    for k, text in rows:
        raw, w, weight = (text or "").encode(), spans(text), 0.0
        for i, (start, end, word) in enumerate(w):
            lo, hi = max(0, i - 8), min(len(w), i + 9)
            quotes = [q.encode() for q in toxicity.QUOTES]
            said = any(w[j][2].decode(errors="replace") in toxicity.REPORTING for j in range(max(0, i - 4), i))
            marked = any(q in raw[w[lo][0]:start] for q in quotes) and any(q in raw[end:w[hi - 1][1] + 1] for q in quotes)
            weight += 0.0 if word in exceptions else hit(word) * (0.25 if said or marked else 1.0)
        out.append((weight, len(w)))
    return stems, terms, exceptions, out


def test_toxicity_against_brute_force(spark):
    rnd = random.Random(13)
    plain = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(2, 9))) for _ in range(150)] + ["snorkel"]
    bad = ["grobalix", "Snorfel", "vexingdor", "quib"]
    text = lambda n: [rnd.choice(plain) for _ in range(n)]
    rows = []
    for k in range(240):
        w = text(rnd.randint(5, 30))
        if k % 3 == 0:
            for _ in range(rnd.randint(1, 3)):
                term = list(rnd.choice(bad))
                if rnd.random() < 0.3:
                    term[rnd.randrange(len(term))] = "x"
                w.insert(rnd.randrange(len(w)), "".join(term))
        elif k % 7 == 0:
            w += ["he", "said", '"' + rnd.choice(bad) + '"', "and", "snorkel"]
        rows.append((k, " ".join(w)))
    rows += [(240, None), (241, ""), (242, " ".join(text(20_000)) + " Grobalix"), (243, "snorfl grobaliks vexngdr"), (244, "« snorfel »"), (None, "snorfel")]
    labels = [(k, 1, int(k % 3 == 0)) for k in range(230)]
    train = {r.doc_id: bool(r.toxic) for r in toxicity.training_labels(spark.createDataFrame(labels, LABELS)).collect()}
    assert set(train) == {k for k, *_ in labels if zlib.crc32(str(k).encode()) % 4 != 2}
    stems, terms, exceptions, weights = brute_toxic_weights(rows, train)
    df = spark.createDataFrame([(*r, "clash", 0.5) for r in rows], "doc_id long, text string, weight string, toxic double").repartition(3)
    sample = toxicity.draw_sample(spark.createDataFrame([(k, int(t)) for k, t in train.items()], "doc_id long, toxic int"))
    learned = toxicity.learn(df, sample, Scratch(spark, "toxic-brute"))
    assert stems and terms and exceptions
    assert learned.stems == pytest.approx(stems) and learned.exceptions == exceptions
    assert {t: w for t, (w, _) in learned.words.items()} == pytest.approx(terms)

    mine = [(*w, train[k]) for (k, _), w in zip(rows, weights) if k in train]
    weight, n_words, toxic = (np.array(x) for x in zip(*mine))
    a, b, c = toxicity.fit_curve(weight, n_words, toxic, np.ones(len(mine)))
    design = np.stack([np.ones(len(mine)), np.log1p(weight), np.log1p(100 * weight / (n_words + 10))], axis=1)
    slope = design.T @ (toxic - 1 / (1 + np.exp(-design @ [a, b, c]))) - np.array([1e-3, 1e-1, 1e-1]) * [a, b, c]
    assert all(abs(g) < 1e-6 or (x == 0 and g < 0) for g, x in zip(slope, (a, b, c)))       # the ridge's optimum
    want = {k: 1 / (1 + np.exp(-(a + b * np.log1p(w) + c * np.log1p(100 * w / (n + 10))))) for (k, _), (w, n) in zip(rows, weights)}
    got = {r.doc_id: r for r in toxicity.score(df, spark.createDataFrame(labels, LABELS)).collect()}
    assert {k: r.score for k, r in got.items()} == pytest.approx(want)
    assert all(r.predicted == int(r.score >= 0.3) and r.held_out == (k is not None and zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items())


def test_several_automata_match_like_one():
    from tessera.llm.codes import ALNUM, words_of

    rnd = random.Random(8)
    word = lambda lo, hi: "".join(rnd.choice("abc") for _ in range(rnd.randint(lo, hi))).encode()
    terms = {t: (float(rnd.randint(1, 3)), toxicity.edits(len(t))) for t in (word(3, 10) for _ in range(40))}
    lexicon = toxicity.Lexicon({b"abca": 2.0, b"ccbb": 1.0}, terms)
    w = words_of(pa.array([" ".join(word(1, 11).decode() for _ in range(3000))]), ALNUM)
    one = toxicity.Automaton(lexicon)
    for held in (1, 7, 100):
        several = toxicity.Automata(lexicon, held)
        assert several.weights.tolist() == one.weights.tolist()
        for _ in range(2):
            assert (several.match(w) == one.match(w)).all()
            for part in several.parts:
                part.forget()


def test_automaton_is_levenshtein():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]
    from tessera.llm.codes import ALNUM, words_of

    rnd = random.Random(6)
    terms = {b"abcab": (1.0, 1), b"abbabacab": (1.0, 2), b"cab": (1.0, 0)}
    text = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 10))) for _ in range(3000)]
    code = toxicity.Automaton(toxicity.Lexicon({}, terms)).match(words_of(pa.array([" ".join(text)]), ALNUM))
    for word, c in zip(text, code):
        assert (c != 0) == any(distance(word.encode(), t) <= most for t, (_, most) in terms.items())
        assert (c > 0) == (word.encode() in terms)


def test_decontaminate_against_brute_force(spark, docs, corpus):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = [(1, corpus[0][1]), (2, " ".join(words(corpus[1][1])[3:20])), (3, "one"), (4, None), (5, "..."), (3, "one"), (12, corpus[0][1].upper().replace(" ", " -- "))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    held = collections.defaultdict(set)
    for item, text in items:
        w = words(text, pattern)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            held[tuple(w[i:i + n])].add(str(item))
    expected = {}
    for k, text, *_ in corpus:
        w, hit, found = words(text, pattern), set(), set()
        for n in {len(x) for x in held}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in held:
                    hit |= set(range(i, i + n))
                    found |= held[tuple(w[i:i + n])]
        expected[k] = (len(w), len(hit), len(found), decontaminate.sha256_of_items(list(found)), bool(hit))
    for block in (10 ** 6, 5):
        got = {r.doc_id: tuple(r)[1:] for r in decontaminate.report(decontaminate.find_hits(docs, bench, block_windows=block)).collect()}
        assert got == expected
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {k for k, e in expected.items() if not e[-1]}
    stripped = decontaminate.strip_spans(docs, bench)
    assert decontaminate.report(decontaminate.find_hits(stripped, bench.where("item_id <> 3"))).where("contaminated").count() == 0
    assert decontaminate.find_hits(docs, bench.limit(0)).where("size(spans) > 0").count() == 0


def test_hits_are_a_row_a_document_row_in_any_number_of_blocks(spark):
    rows = [(None, "a b c"), (None, "d e f g"), (None, "x y"), (5, "a b c a b c"), (5, "d e f"), (5, "d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, "a b c"), (2, "d e f"), (3, "p q")], "item_id long, text string")
    got = [sorted(collected(decontaminate.report(decontaminate.find_hits(df, bench, block_windows=n))), key=str) for n in (10 ** 6, 1)]
    assert got[0] == got[1] and sorted((str(r[0]), r[1], r[2]) for r in got[0]) == [("5", 3, 3), ("5", 3, 3), ("5", 6, 6), ("None", 2, 0), ("None", 3, 3), ("None", 4, 3)]


def test_items_without_an_id_are_hit(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, "x y"), (3, "k l m")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "b c"), (7, "k l"), (None, "k l")], "item_id long, text string")
    none, one = decontaminate.sha256_of_items([]), decontaminate.sha256_of_items(["7"])
    for block in (10 ** 6, 1):
        got = sorted(collected(decontaminate.report(decontaminate.find_hits(df, bench, block_windows=block))))
        assert got == [(1, 4, 2, 0, none, True), (2, 2, 0, 0, none, False), (3, 3, 2, 1, one, True)]
    assert [r.doc_id for r in decontaminate.drop_contaminated(df, bench).collect()] == [2]


def test_stages_decide_each_row_of_null_and_repeated_ids(spark, tmp_path):
    rnd = random.Random(9)
    say = lambda: " ".join(rnd.choice(["the", "cat", "sat", "on", "a", "mat", "house", "with"]) for _ in range(40))
    secret = "one two three four five six seven eight nine ten"
    good = [(k, say(), "en", "a", 1) for k in range(40)] + [(None, say(), "en", "a", 2) for _ in range(20)] + [(50, say(), "en", "a", 3)]
    junk = [(None, "", "en", "a", 4), (None, "%%% ### !! " * 20, "en", "a", 5), (50, "zqxj " * 30, "en", "a", 6)]
    leaks = [(None, say() + " " + secret, "en", "a", 7), (50, secret, "en", "a", 8), (None, say(), "en", "a", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars int"
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)], LABELS)
    kept = quality.keep_good(spark.createDataFrame(good + junk, schema).repartition(3), labels)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and sorted(collected(kept), key=str) == sorted(good, key=str)
    bench = spark.createDataFrame([(1, secret), (2, "never said here")], "item_id long, text string")
    df = spark.createDataFrame(good + leaks, schema).repartition(3)
    for block in (10 ** 6, 1):
        assert sorted(collected(decontaminate.drop_contaminated(df, bench, block_windows=block)), key=str) == sorted([*good, leaks[2]], key=str)


def test_mix_takes_rows_of_null_and_repeated_ids_each(spark):
    rows = [(None if k % 2 else k % 10, f"{k} " + "w " * (k % 5), ("a", "b", None)[k % 3], k) for k in range(300)]
    rows += [rows[1]] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n int").repartition(3)
    mixed = mixing.mix(df, group=20)
    taken, got = collections.Counter(), collections.Counter()
    for r in mixed.collect():
        taken[r.doc_id, r.source, r.size] += r.times
    repeated = mixing.repeat_documents(df, mixed)
    assert repeated.columns == df.columns
    for r in repeated.collect():
        got[r.doc_id, r.source, len(words(r.text))] += 1
    assert got == +taken


def test_pipeline_stages_keep_the_columns(spark, tmp_path, docs, corpus):
    docs.drop("n_words").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 50, 2)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, corpus[5][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    now, scratch = spark.read.parquet(f"{tmp_path}/documents.parquet"), Scratch(spark, "stages")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = scratch.table(stage(spark, now, str(tmp_path)), name)
        assert now.columns == columns
    assert now.where("text is null").count() == 0
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and sorted(r.doc_id for r in out.collect()) == sorted(r.doc_id for r in now.collect())


CLASHING = ["_said", "_judged_by", "_kept_id", "_mix_words", "_mix_times", "row", "row_", "label", "digest", "text_"]


def test_stages_keep_columns_named_like_their_own(spark, docs, corpus):
    table = docs
    for name in CLASHING:
        table = table.withColumn(name, F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    labels = spark.createDataFrame([(k, 1, 0) for k in range(40)], LABELS)
    bench = spark.createDataFrame([("i", corpus[3][1])], "item_id string, text string")
    for out in (quality.keep_good(table, labels), near_dups.keep_one(table), decontaminate.drop_contaminated(table, bench), decontaminate.drop_contaminated(table, bench, block_windows=2),
                mixing.repeat_documents(table, mixing.mix(table))):
        rows = out.collect()
        assert out.columns == table.columns and rows
        assert all(r[name] == f"{name} {r.doc_id}" for r in rows for name in CLASHING)


def test_strip_spans_goes_by_the_row(spark):
    passage = " ".join(f"p{k}" for k in range(12))
    table = spark.createDataFrame([(5, f"a {passage} b"), (5, "short"), (None, None), (None, f"{passage}!")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", passage), (None, "a  p0")], "item_id string, text string")
    for most in (1_000_000, 1):
        if most == 1:
            got = [tuple(r) for r in decontaminate.find_hits(table, bench, block_windows=1).select("doc_id", "n_words").collect()]
            assert sorted(got, key=str) == sorted([(5, 14), (5, 1), (None, 0), (None, 12)], key=str)
        rows = decontaminate.strip_spans(table, bench, block_windows=most).collect()
        assert sorted(((r.doc_id, r.text.split() if r.text is not None else None) for r in rows), key=str) == sorted([(5, ["b"]), (5, ["short"]), (None, None), (None, ["!"])], key=str)


def test_token_files_split_a_hot_id_and_read_parts_apart(spark, tmp_path):
    rows = [(None if k % 3 else k, f"text number {k}") for k in range(400)] + [(7, "same")] * 200
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = token_files.write_token_files(table, queries.TOKENIZER, str(tmp_path / "t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = manifest.orderBy("part").collect()
    assert len(parts) > 3 and max(p.n_docs for p in parts) < 400
    got = token_files.read_documents(manifest)
    assert got.rdd.getNumPartitions() == len(parts)
    found = sorted((r.start, r.doc_id, r.n_tokens) for r in got.collect())
    assert [f[1] for f in found] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0)) and len(found) == len(rows)
    assert all(a[0] + a[2] == b[0] for a, b in zip(found, found[1:]))
