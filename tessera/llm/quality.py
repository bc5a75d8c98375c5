"""Quality classifier: interpolated modified Kneser-Ney n-grams over the bytes of trusted text.

Trusted text (documents whose label ``quality`` is 1) is cut into byte 5-grams per language, counted
in the tasks and summed by a shuffle on the gram. Lower orders count distinct left neighbours, each
order has its three discounts from its counts of counts, and joins of an order with its contexts and
with the order below give every seen gram its interpolated probability and every context its back-off
mass. A document's perplexity is that of its bytes; it is rejected above its language's threshold: the
``QUANTILE`` of the perplexities of trusted documents held out of training (one in ``HOLD``, by a hash
of the id), raised by ``ALLOWANCE / n`` for n held-out documents, as the highest of a few says little.

Scoring looks grams up in the model. Up to ``MODEL_ROWS`` rows the model is broadcast (its size is
counted first); a larger one is joined: a document's distinct grams with their counts meet the
model's shards, order by order (:func:`score_by_join`). Both ways give the same sums.

Edge cases: a null or empty text has no perplexity and is rejected; a language without trusted text (null
is a language of its own) cannot be judged, so its documents stay, with null perplexity; rows that repeat
a doc_id are scored each; without any labels all texts but empty ones stay; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.codes import Lookup, bytes_of, slices
from tessera.llm.scratch import Scratch

ORDER, QUANTILE, HOLD, ALLOWANCE = 5, 0.995, 5, 4.0
MODEL_ROWS = 3_000_000
#: Distinct grams that a task holds before it emits them
HELD_GRAMS = 1_000_000
START = 10
DIGEST = "_judged_by"
#: Languages up to which their discounts are broadcast (a row of four numbers each)
LANGUAGES = 10_000
GRID = 1000


def _mask(order: int) -> int:
    return (1 << 8 * order) - 1


def grams(column: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The gram ending at each byte of every row (rows begin with order - 1 newlines), and row offsets."""
    data, rows = bytes_of(column)
    pad = order - 1
    size = np.diff(rows)
    row = np.repeat(np.arange(len(size)), size)
    stream = np.full(len(data) + pad * len(size), START, dtype=np.uint8)
    at = np.arange(len(data)) + pad * (row + 1)
    stream[at] = data
    out = np.zeros(len(data), dtype=np.uint64)
    for back in range(pad, -1, -1):
        out = (out << np.uint64(8)) | stream[at - back]
    return out, rows


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    langs = np.asarray(batch.column("lang").to_pylist(), dtype=object)
    for lang in sorted(set(langs)):
        yield lang, np.flatnonzero(langs == lang)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def emit() -> Iterator[pa.RecordBatch]:
        for lang, (gram, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])
        held.clear()

    for batch in slices(batches):
        for lang, rows in _by_lang(batch):
            gram, n = np.unique(grams(batch.column("text").take(pa.array(rows)))[0], return_counts=True)
            if lang in held:
                both = np.concatenate([held[lang][0], gram])
                gram, where = np.unique(both, return_inverse=True)
                n = np.bincount(where, np.concatenate([held[lang][1], n])).astype(np.int64)
            held[lang] = gram, n.astype(np.int64)
        if sum(len(g) for g, _ in held.values()) > HELD_GRAMS:
            yield from emit()
    yield from emit()


def _text(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *[c for c in docs.columns if c == DIGEST])


def _digest(docs: DataFrame) -> Column:
    """Digest of what a row is judged by: its language and its text."""
    lang, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "text"))
    return F.unhex(F.md5(F.concat(F.octet_length(lang).cast("string"), F.lit(":"), lang, text).cast("binary")))


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(HOLD)) == 0


def _discounted(counts: DataFrame, table) -> DataFrame:
    """With ``d``, the modified Kneser-Ney discount of each row's count in its language; ``table`` writes and rereads.

    The discounts are a row a language: broadcast up to ``LANGUAGES`` of them, so that a large language is not one task.
    """
    many = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double") for k in (1, 2, 3, 4)]
    by = counts.groupBy("lang").agg(*[c.alias(f"n{k}") for k, c in enumerate(many, 1)])
    y = F.col("n1") / F.greatest(F.col("n1") + 2 * F.col("n2"), F.lit(1.0))
    for k in (1, 2, 3):
        fit = k - (k + 1) * y * F.col(f"n{k + 1}") / F.greatest(F.col(f"n{k}"), F.lit(1.0))
        by = by.withColumn(f"d{k}", F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), fit)))
    d = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    by = table(by.select("lang", "d1", "d2", "d3"))
    by = F.broadcast(by) if by.count() <= LANGUAGES else by
    return counts.join(by, "lang").withColumn("d", d).drop("d1", "d2", "d3")


def train(docs: DataFrame, trusted: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """The model: (lang, order, gram, logp) of seen grams, (.., gram of a context, back) with null logp.

    ``trusted`` has the doc_ids to train on.
    """
    rows = _text(docs).join(trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi")
    top = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = {order: scratch.table(top, f"counts{order}")}
    for o in range(order - 1, 0, -1):
        below = counts[o + 1].groupBy("lang", F.col("gram").bitwiseAND(F.lit(_mask(o))).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        counts[o] = scratch.table(below, f"counts{o}")
    below, model = None, None
    for o in range(1, order + 1):
        seen = _discounted(counts[o], lambda by, o=o: scratch.table(by, f"discounts{o}")).withColumn("context", F.shiftright("gram", 8))
        contexts = seen.groupBy("lang", "context").agg(F.sum("n").alias("total"), (F.sum(F.col("d").cast("decimal(20,12)")).cast("double") / F.sum("n")).alias("back"))
        p = seen.join(contexts, ["lang", "context"]).withColumn("suffix", F.col("gram").bitwiseAND(F.lit(_mask(o - 1))))
        if below is None:
            p = p.withColumn("lower", F.lit(1.0 / 256))
        else:
            p = p.join(below.select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower")), ["lang", "suffix"])
        p = p.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("total") + F.col("back") * F.col("lower")).alias("p"))
        below = scratch.table(p, f"p{o}")
        logp = below.select("lang", F.lit(o).alias("order"), "gram", F.log("p").alias("logp"), F.lit(None).cast("double").alias("back"))
        back = contexts.select("lang", F.lit(o).alias("order"), F.col("context").alias("gram"), F.lit(None).cast("double").alias("logp"), F.log("back").alias("back"))
        model = logp.union(back) if model is None else model.union(logp).union(back)
    return scratch.table(model, "model")


class Model:
    """A language's model as arrays: lookups of grams and of contexts by order."""

    def __init__(self, order: int, table: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]):
        self.order = order
        self.seen = {o: (Lookup(k), v) for (o, is_gram), (k, v) in table.items() if is_gram}
        self.back = {o: (Lookup(k), v) for (o, is_gram), (k, v) in table.items() if not is_gram}

    def logp(self, gram: np.ndarray) -> np.ndarray:
        """Log probability of each gram's last byte, backing off where it was not seen."""
        out, todo = np.zeros(len(gram)), np.arange(len(gram))
        for o in range(self.order, 0, -1):
            lookup, value = self.seen[o]
            key = gram[todo] & np.uint64(_mask(o))
            at = lookup.find(key)
            hit = at >= 0
            out[todo[hit]] += value[at[hit]]
            todo, key = todo[~hit], key[~hit]
            lookup, value = self.back[o]
            at = lookup.find(key >> np.uint64(8))
            known = at >= 0
            out[todo[known]] += value[at[known]]
        out[todo] += np.log(1.0 / 256)
        return out


def _score(model: Broadcast, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: dict[str, Model] = {}
        for batch in slices(batches):
            loss = np.zeros(batch.num_rows)
            known = np.zeros(batch.num_rows, dtype=bool)
            for lang, rows in _by_lang(batch):
                if lang not in model.value:
                    continue
                if lang not in models:
                    models[lang] = Model(order, model.value[lang])
                gram, offsets = grams(batch.column("text").take(pa.array(rows)), order)
                total = np.concatenate([[0.0], np.cumsum(models[lang].logp(gram))])
                loss[rows], known[rows] = -np.diff(total[offsets]), True
            size = np.diff(bytes_of(batch.column("text"))[1])
            digest = [n for n in batch.schema.names if n == DIGEST]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(size), pa.array(loss, mask=~known), *[batch.column(n) for n in digest]], names=["doc_id", "lang", "n_bytes", "loss", *digest])
    return run


def _per_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct grams of each row with their counts."""
    for batch in slices(batches):
        gram, offsets = grams(batch.column("text"))
        size = np.diff(offsets)
        row = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((gram, row))
        gram, row = gram[order], row[order]
        new = np.ones(len(gram), dtype=bool)
        new[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(gram)))
        take = pa.array(row[first])
        yield pa.RecordBatch.from_arrays([batch.column("row").take(take), batch.column("lang").take(take), pa.array(gram[first].view(np.int64)), pa.array(n)], names=["row", "lang", "gram", "n"])


def score_by_join(docs: DataFrame, model: DataFrame, scratch: Scratch, order: int = ORDER) -> DataFrame:
    """The same sums with the model in shards: grams of documents joined with it, order by order."""
    text = _text(docs).withColumn("row", F.xxhash64("doc_id", "lang", "text"))
    rows = text.dropDuplicates(["row"]).select("row", "lang", "text").mapInArrow(_per_document, "row long, lang string, gram long, n long")
    known = model.select("lang").distinct()
    rows = rows.join(F.broadcast(known), "lang", "left_semi").withColumn("logp", F.lit(0.0)).withColumn("open", F.lit(True))
    for o in range(order, 0, -1):
        key, context = F.col("gram").bitwiseAND(F.lit(_mask(o))), F.shiftright(F.col("gram").bitwiseAND(F.lit(_mask(o))), 8)
        level = model.where(F.col("order") == o)
        rows = rows.withColumn("key", key).join(level.where("logp is not null").select("lang", F.col("gram").alias("key"), F.col("logp").alias("found")), ["lang", "key"], "left").drop("key")
        rows = rows.withColumn("key", context).join(level.where("back is not null").select("lang", F.col("gram").alias("key"), "back"), ["lang", "key"], "left").drop("key")
        step = F.when(F.col("found").isNotNull(), F.col("found")).otherwise(F.coalesce("back", F.lit(0.0)))
        rows = rows.withColumn("logp", F.when(F.col("open"), F.col("logp") + step).otherwise(F.col("logp"))).withColumn("open", F.col("open") & F.col("found").isNull()).drop("found", "back")
    rows = rows.withColumn("logp", F.when(F.col("open"), F.col("logp") + float(np.log(1.0 / 256))).otherwise(F.col("logp")))
    losses = scratch.table(rows.groupBy("row").agg(F.sum(-F.col("logp") * F.col("n")).alias("loss")), "losses")
    out = text.join(losses, "row", "left").join(F.broadcast(known.withColumn("judged", F.lit(True))), "lang", "left")
    return out.select("doc_id", "lang", F.octet_length("text").cast("long").alias("n_bytes"), F.when(F.col("judged"), F.coalesce("loss", F.lit(0.0))).alias("loss"), *[c for c in text.columns if c == DIGEST])


def score(docs: DataFrame, model: DataFrame, scratch: Scratch, order: int = ORDER, model_rows: int = MODEL_ROWS) -> DataFrame:
    """doc_id, lang (null as ''), n_bytes and loss (minus the log probability of the text)."""
    if model.count() > model_rows:
        return score_by_join(docs, model, scratch, order)
    tables: dict[str, dict] = {}
    for (lang,) in model.select("lang").distinct().orderBy("lang").collect():
        mine = model.where(F.col("lang") == lang)
        for o in range(1, order + 1):
            for is_gram, column in ((True, "logp"), (False, "back")):
                part = mine.where((F.col("order") == o) & F.col(column).isNotNull()).select("gram", column).toArrow()
                tables.setdefault(lang, {})[(o, is_gram)] = part["gram"].to_numpy().view(np.uint64), part[column].to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(tables)
    return _text(docs).mapInArrow(_score(held, order), "doc_id long, lang string, n_bytes long, loss double" + (f", {DIGEST} binary" if DIGEST in docs.columns else ""))


def thresholds(scored: DataFrame, trusted: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(lang, limit): highest loss a byte that a language's documents may have.

    The quantile is taken on a grid of 1 / GRID nats, so a language's losses are a bounded histogram.
    """
    held = scored.join(trusted.select("doc_id").distinct(), "doc_id", "left_semi").where((F.col("n_bytes") > 0) & F.col("loss").isNotNull())
    bins = held.groupBy("lang", F.ceil(F.col("loss") / F.col("n_bytes") * GRID).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("lang").orderBy("bin")
    bins = bins.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy("lang")))
    reached = bins.where(F.col("upto") >= F.lit(quantile) * F.col("all")).groupBy("lang").agg(F.min("bin").alias("bin"), F.max("all").alias("all"))
    return reached.select("lang", (F.col("bin") / GRID * (1 + ALLOWANCE / F.col("all"))).alias("limit"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """doc_id, n_bytes, perplexity (a byte), threshold, kept for each row of ``docs`` (and its digest, if ``docs`` has it)."""
    scratch = Scratch(docs.sparkSession, "quality")
    trusted = labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    model = train(docs, trusted.where(~_held_out(F.col("doc_id"))), scratch)
    scored = scratch.table(score(docs, model, scratch), "scored")
    limits = thresholds(scored, trusted.where(_held_out(F.col("doc_id"))), quantile)
    # a language without held-out documents goes by its training ones
    rest = thresholds(scored, trusted, quantile).join(limits.select("lang"), "lang", "left_anti")
    limits = scratch.table(limits.unionByName(rest), "limits")
    loss = F.col("loss") / F.col("n_bytes")
    out = scored.join(limits, "lang", "left")
    kept = (F.col("n_bytes") > 0) & F.coalesce(loss <= F.col("limit"), F.lit(True))
    return out.select("doc_id", "n_bytes", F.when(F.col("n_bytes") > 0, F.exp(loss)).alias("perplexity"), F.exp("limit").alias("threshold"), kept.alias("kept"), *[c for c in scored.columns if c == DIGEST])


def keep_good(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The documents that the classifier keeps, columns unchanged; rows of one id, or of none, are judged each."""
    rows = docs.select(F.struct("*").alias("row"), *[c for c in ("doc_id", "lang", "text") if c in docs.columns], _digest(docs).alias(DIGEST))
    bad = classify(rows, labels, quantile).where(~F.col("kept")).select(F.col("doc_id").alias("bad_id"), F.col(DIGEST).alias("bad")).distinct()
    return rows.join(bad, rows["doc_id"].cast("long").eqNullSafe(bad["bad_id"]) & (rows[DIGEST] == bad["bad"]), "left_anti").select("row.*")
