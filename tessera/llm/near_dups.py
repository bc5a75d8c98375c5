"""MinHash near-dedup: chosen-path set similarity join over word shingles.

A document's set holds its distinct shingles of ``width`` words (fewer words: the whole sequence as
one; none: empty, linked with nothing). Documents with the same set are one class. Each class has a
signature of ``POSITIONS`` minwise values. In each of ``TREES`` independent trees a class goes down
from the root: at every node the path itself picks a position, and the class moves to the child
named by its minwise value there, so two classes of similarity s part at a step with probability
1 - s. Nodes are looked at from ``DEPTH`` steps on, where unrelated classes rarely meet:

1. every class is compared with the most alike of its nodes' pivots (a node's pivot is the class whose nodes are
   fullest in all trees: in a cloud of copies of one text, that text), and found links are united;
2. a node whose classes are united is done, as further links in it change nothing. In other
   small nodes (at most ``SMALL`` components) the components are compared exhaustively by the
   signatures of their smallest members there; each pair that looks alike is given out by the
   first node in order that holds both, not by every tree they meet in. In larger nodes components of
   several classes meet all others, and single classes branch on by further minwise tokens, ``FORKS`` ways each;
3. two components found alike are compared on the full sets of all their members, in bounded chunks,
   one link found being enough.

Every link is confirmed on full sets with ``100 * |A & B| >= 80 * |A | B|``. A pair of similarity 0.8
meets in one tree with probability 0.8**5, so that 32 trees miss it with probability 3e-6; if all its
nodes are large, the first further branching misses it with probability 1e-4.

Groups of copies: exact copies are one class by a partial aggregate; a large group of near copies is
united through pivots, with one row a member, not a row a pair. Nothing is capped.

Edge cases: null text is empty; every row takes part with its own set, so rows that repeat a doc_id may lie in
different groups; rows without a doc_id take part, their group being named by its smallest id (null if it has none);
rows without words are in no group; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm.codes import NOT_SPACE, mix64, slices, windows, words_of
from tessera.llm.scratch import Scratch

WIDTH, PERCENT = 2, 80
POSITIONS, TREES, DEPTH, SMALL, CHUNK = 128, 32, 5, 64, 256
#: Ways on from a large node, and their length
FORKS, DEEPER = 6, 7
#: Signature similarity from which pairs are compared on their full sets: low enough for a link
#: between the components of two classes, not just between the classes
ALIKE, ALIKE_PIVOT = 0.4, 0.68
SEED = 0x5EED


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted in each row, and the offset of each row's."""
    w = words_of(column, NOT_SPACE)
    many = np.diff(w.first)
    row_of = lambda at: np.searchsorted(w.first, at, side="right") - 1
    full = windows(w.hash, width)
    at = np.arange(len(full))
    row = row_of(at)
    inside = at + width <= w.first[row + 1]
    values, row = [full[inside]], [row[inside]]
    for size in range(1, width):
        short = np.flatnonzero(many == size)
        if len(short):
            values.append(windows(w.hash, size)[w.first[short]])
            row.append(short)
    value, row = np.concatenate(values), np.concatenate(row)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(column) + 1))


def signatures(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minwise values [rows, POSITIONS] (16 bits each) of non-empty sets; rows without any are 0."""
    out = np.zeros((len(offsets) - 1, POSITIONS), dtype=np.uint16)
    full = np.flatnonzero(np.diff(offsets))
    if len(full):
        seeds = mix64(np.arange(1, 2 * POSITIONS + 1, dtype=np.uint64) * np.uint64(SEED))
        for k in range(POSITIONS):
            low = np.minimum.reduceat((value ^ seeds[k]) * (seeds[POSITIONS + k] | np.uint64(1)), offsets[:-1][full])
            out[full, k] = (mix64(low) >> np.uint64(48)).astype(np.uint16)
    return out


def _sums(value: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values modulo 2**64, as a signed number."""
    total = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(value, out=total[1:])
    return np.diff(total[offsets]).view(np.int64)


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            value, offsets = shingles(batch.column("text"), width)
            signature = signatures(value, offsets)
            yield pa.RecordBatch.from_arrays([
                batch.column("row"), batch.column("doc_id"), batch.column("digest"), pa.array(np.diff(offsets), pa.int64()), pa.array(_sums(value, offsets)), pa.array(_sums(mix64(value + np.uint64(SEED)), offsets)),
                pa.array([row.tobytes() for row in signature], pa.binary())], names=["row", "doc_id", "digest", "n_shingles", "s1", "s2", "signature"])
    return run


def _sets(width: int):
    """The full sets of the texts whose set has the sum wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            value, offsets = shingles(batch.column("text"), width)
            out = pa.RecordBatch.from_arrays([
                batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(value.view(np.int64)))], names=["id", "set"])
            yield out.filter(pa.array(_sums(value, offsets) == batch.column("s1").to_numpy()))
    return run


def _step(path: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """The child on each path: the path picks a position, the minwise value there names the child."""
    position = (path % np.uint64(POSITIONS)).astype(np.int64)
    value = signature[np.arange(len(path)), position].astype(np.uint64)
    return mix64(path ^ (value << np.uint64(8)) ^ position.astype(np.uint64))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint16).reshape(-1, POSITIONS)


def _plant(trees: int, depth: int):
    """Classes to the node of each tree that they reach after ``depth`` steps."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roots = mix64(np.arange(1, trees + 1, dtype=np.uint64) + np.uint64(SEED << 20))
        for frame in frames:
            if not len(frame):
                continue
            signature, parts = _matrix(frame["signature"]), []
            for root in roots:
                path = np.full(len(frame), root, dtype=np.uint64)
                for _ in range(depth):
                    path = _step(path, signature)
                parts.append(pd.DataFrame({"id": frame["id"], "node": path.view(np.int64)}))
            yield pd.concat(parts, ignore_index=True)
    return run


def _branch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes that each class of a large node reaches on FORKS ways of DEEPER steps more."""
    for frame in frames:
        if len(frame):
            signature, parts = _matrix(frame["signature"]), []
            root = frame["node"].to_numpy(np.int64).view(np.uint64)
            for fork in range(1, FORKS + 1):
                path = mix64(root + np.uint64(fork))
                for _ in range(DEEPER):
                    path = _step(path, signature)
                parts.append(pd.DataFrame({"id": frame["id"], "node": path.view(np.int64)}))
            yield pd.concat(parts, ignore_index=True)


def _alike(least: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                same = (_matrix(frame["sa"]) == _matrix(frame["sb"])).mean(axis=1)
                yield frame.assign(same=same).loc[same >= least, ["a", "b", "same"]]
    return run


def _exhaust(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of small nodes' components that look alike, each from the first node that holds both; a row is a node.

    Two single classes must look like a link; members of larger components may be more alike than those here. All is
    read off the Arrow buffers, so a batch costs little more than its bytes.
    """
    for batch in batches:
        held, found = batch.column("held"), [np.empty((0, 2), dtype=np.int64)]
        first, flat, here = held.offsets.to_numpy(), held.values, batch.column("node").to_numpy()
        labels, sizes = flat.field("label").to_numpy(), flat.field("n_label").to_numpy()
        signed, listed = flat.field("signature"), flat.field("nodes")
        edge, data = np.frombuffer(signed.buffers()[1], dtype=np.int32)[signed.offset:], np.frombuffer(signed.buffers()[2], dtype=np.uint8)
        start, others = listed.offsets.to_numpy(), listed.values.to_numpy()
        for k, (lo, hi) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            label, size = labels[lo:hi], sizes[lo:hi]
            signature = data[edge[lo]:edge[hi]].view(np.uint16).reshape(-1, POSITIONS)
            same = (signature[:, None, :] == signature[None, :, :]).mean(axis=2)
            least = np.where((size[:, None] == 1) & (size[None, :] == 1), ALIKE_PIVOT, ALIKE)
            alike = np.triu(same >= least, 1)
            owner, other = np.repeat(np.arange(hi - lo), np.diff(start[lo:hi + 1])), others[start[lo]:start[hi]]
            owner, other = owner[other < here[k]], other[other < here[k]]
            if len(other):
                _, which = np.unique(other, return_inverse=True)
                holds = np.zeros((hi - lo, which.max() + 1), dtype=np.float32)
                holds[owner, which] = 1
                alike &= holds @ holds.T == 0
            i, j = np.nonzero(alike)
            found.append(np.sort(np.column_stack([label[i], label[j]]), axis=1))
        pairs = np.concatenate(found)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _chunk_links(percent: int):
    """Links between the members of two chunks; one for each of the smaller side is enough."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        found = {"a": [], "b": []}
        big, few = rows[rows["large"]], rows[~rows["large"]]
        if len(big) and len(few):
            sets = [np.asarray(x, dtype=np.int64) for x in big["set"]]
            sizes = np.array([len(x) for x in sets])
            flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
            for id_, mine in zip(few["id"], few["set"]):
                mine = np.sort(np.asarray(mine, dtype=np.int64))
                at = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                both = np.bincount(owner[mine[at] == flat], minlength=len(sets))
                hit = np.flatnonzero(100 * both >= percent * (sizes + len(mine) - both))
                if len(hit):
                    found["a"].append(id_)
                    found["b"].append(big["id"].iloc[hit[0]])
        return pd.DataFrame(found).astype("int64")
    return run


def connected(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, label): the smallest id reachable over undirected links (a, b), for every linked id.

    Each round every id takes the smallest label among its neighbours and itself; after the first rounds,
    which settle stars, also the label of that label, so that long chains halve. Labels only fall:
    when their sum stays, they are final.
    """
    both = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b"))).alias("e")).select("e.a", "e.b").distinct()
    edges = scratch.table(both, f"{name}-edges")
    labels, last, turn = edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")), None, 0
    while True:
        labels = scratch.table(labels, f"{name}-{turn}")
        total = labels.agg(F.sum(F.col("label").cast("decimal(38,0)"))).first()[0]
        if total == last:
            return labels
        last, turn, held = total, turn + 1, labels
        labels = edges.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("label"))
        if turn > 3:
            labels = labels.join(held.toDF("label", "far"), "label").select("id", F.least("label", "far").alias("label"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, by their full sets."""
    joined = pairs.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b").join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    both = F.size(F.array_intersect("sa", "sb"))
    return joined.where(100 * both >= percent * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _labelled(ids: DataFrame, labels: DataFrame) -> DataFrame:
    """With the label of each id (itself without links)."""
    return ids.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, trees: int = TREES, depth: int = DEPTH, small: int = SMALL, row: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id; also row (the values of column ``row``) and the group's label."""
    scratch = Scratch(docs.sparkSession, "near-dups")
    text = docs.select((F.col(row) if row else F.lit(None)).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("digest", F.xxhash64("doc_id", "text"))
    described = scratch.table(text.mapInArrow(_describe(width), "row long, doc_id long, digest long, n_shingles long, s1 long, s2 long, signature binary"), "described")
    same = ["n_shingles", "s1", "s2"]
    # a class has a number of its own, its smallest doc_id, and one row that stands for it
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    heads = described.where("n_shingles > 0").groupBy(*same).agg(first, F.first("signature").alias("signature"))
    heads = heads.select(F.monotonically_increasing_id().alias("id"), *same, F.col("first.doc_id").alias("doc_id"), F.col("first.digest").alias("digest"), "signature")
    heads = scratch.table(heads, "classes")
    signed = heads.select("id", "signature")

    # nodes of the trees, from the depth at which they are looked at
    planted = scratch.table(signed.mapInPandas(_plant(trees, depth), "id long, node long"), "planted")
    nodes = planted.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    member = scratch.table(planted.join(nodes, "node").select("node", "id", "n"), "members")
    involved = heads.select("id", "s1", "digest").join(member.select("id").distinct(), "id", "left_semi")
    sets = text.select("digest", "text").join(involved, "digest").select("id", "text", "s1")
    sets = scratch.table(sets.mapInArrow(_sets(width), "id long, set array<long>").dropDuplicates(["id"]), "sets")

    # 1. each class with the pivot most like it; a node's pivot is the class with the fullest nodes in all trees
    weight = member.groupBy("id").agg(F.sum("n").alias("weight"))
    pivot = member.join(weight, "id").groupBy("node").agg(F.max(F.struct("weight", F.col("id"))).alias("top")).select("node", F.col("top.id").alias("pivot"))
    stars = member.join(pivot, "node").where("id <> pivot").select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    stars = stars.join(signed.toDF("a", "sa"), "a").join(signed.toDF("b", "sb"), "b")
    stars = stars.mapInPandas(_alike(ALIKE_PIVOT), "a long, b long, same double").groupBy("a").agg(F.max(F.struct("same", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    links = scratch.table(_confirmed(stars, sets, percent), "links1")
    labels = connected(links, scratch, "labels1")

    # 2. nodes that still hold several components
    sized = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n_label"))
    of_id = scratch.table(labels.join(sized, "label"), "sized-labels")
    similar, turn = None, 0
    while True:
        held = _labelled(member.select("node", "id"), of_id).withColumn("n_label", F.coalesce("n_label", F.lit(1)))
        held = held.groupBy("node", "label").agg(F.min("id").alias("id"), F.max("n_label").alias("n_label"))
        counted = held.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        open_ = scratch.table(held.join(counted, "node"), f"open{turn}")
        few = open_.where(F.col("n") <= small)
        # an id's small nodes: at most one a tree at first, and FORKS for each large node later
        few = few.join(few.groupBy("id").agg(F.collect_list("node").alias("nodes")), "id").join(signed, "id")
        nodes = few.groupBy("node").agg(F.collect_list(F.struct("label", "n_label", "signature", "nodes")).alias("held"))
        met = nodes.mapInArrow(_exhaust, "a long, b long")
        similar = met if similar is None else similar.union(met)
        large = open_.where(F.col("n") > small).join(signed, "id")
        if not large.limit(1).count():
            break
        # larger components meet all others of a large node here; single classes go on
        many = large.where("n_label > 1").select("node", F.col("label").alias("b"), F.col("signature").alias("sb"))
        across = large.select("node", F.col("label").alias("a"), F.col("signature").alias("sa")).join(many, "node").where("a <> b")
        across = across.select("a", "b", "sa", "sb").mapInPandas(_alike(ALIKE), "a long, b long, same double")
        similar = similar.union(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
        turn += 1
        member = scratch.table(large.where("n_label = 1").select("id", "node", "signature").mapInPandas(_branch, "id long, node long"), f"branched{turn}")
    pairs = similar.distinct()

    # 3. similar components on the full sets of their members
    late = _between(scratch.table(pairs, "similar"), labels, sets, percent, scratch)
    links = links.union(scratch.table(late, "links2"))
    labels = connected(links, scratch, "labels2")

    # classes to documents
    of_class = scratch.table(_labelled(heads.select(*same, "id", "doc_id"), labels).select(*same, "label", "doc_id"), "labelled")
    named = of_class.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_class = of_class.join(named, "label").select(*same, "label", "component_id")
    found = described.select("row", "doc_id", *same).join(of_class, same, "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "row", "label")


def _between(pairs: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links between the members of component pairs (a, b), compared chunk by chunk."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("label")).distinct()
    members = scratch.table(_labelled(sets.select("id"), labels).join(wanted, "label").select("label", "id"), "compared")
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    sized = scratch.table(pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b"), "sized")
    singles = _confirmed(sized.where("na = 1 and nb = 1").select("a", "b"), sets, percent)
    sized = sized.where("na > 1 or nb > 1")
    big, few = F.when(F.col("na") >= F.col("nb"), F.col("a")).otherwise(F.col("b")), F.when(F.col("na") >= F.col("nb"), F.col("b")).otherwise(F.col("a"))
    sized = sized.select(big.alias("big"), few.alias("few"), F.greatest("na", "nb").alias("n_big"))
    # all small sides of one large component are compared with its chunks together
    small_side = sized.join(members.select(F.col("label").alias("few"), "id"), "few").select("big", "n_big", "id").distinct()
    n_small = small_side.groupBy("big").agg(F.count(F.lit(1)).alias("n_few"))
    part = lambda count, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.ceil(F.col(count) / CHUNK))
    each = lambda count: F.explode(F.sequence(F.lit(0), F.ceil(F.col(count) / CHUNK) - 1))
    bigs = sized.select("big", "n_big").distinct().join(n_small, "big").join(members.select(F.col("label").alias("big"), "id"), "big")
    bigs = bigs.withColumn("i", part("n_big", 1)).withColumn("j", each("n_few")).join(sets, "id").select("big", "i", "j", "id", "set")
    fews = small_side.join(n_small, "big").withColumn("j", part("n_few", 2)).withColumn("i", each("n_big")).join(sets, "id").select("big", "i", "j", "id", "set")
    keys = ["big", "i", "j"]
    both = bigs.withColumn("large", F.lit(True)).unionByName(fews.withColumn("large", F.lit(False)))
    found = both.groupBy(*keys).applyInPandas(_chunk_links(percent), "a long, b long")
    return singles.union(found)


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row of each group (smallest id, rows without one last), columns unchanged; rows without words stay."""
    row = "row"
    while row in docs.columns:
        row += "_"
    rows = Scratch(docs.sparkSession, "near-dups-rows").table(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = components(rows, width, percent, row=row)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    gone = found.where("label is not null").join(found.where("label is not null").groupBy("label").agg(first), "label").where(F.col("row") != F.col("first.row"))
    return rows.join(gone.select(F.col("row").alias(row)), row, "left_anti").drop(row)
