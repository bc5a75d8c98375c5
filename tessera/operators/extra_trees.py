"""Extremely randomised trees (M2): level-wise growth, cuts drawn at random.

All trees grow together, a level at a time. In every open node each candidate feature gets one cut, drawn evenly from
the range that the feature has among the node's own rows; the cut with the highest fall of Gini impurity is taken.
There is no bootstrap: trees differ by their candidates and cuts only. A level is two aggregates over the rows, each
with partial sums in the tasks: the ranges of the open nodes' features, then the class weights left of each cut. Rows
are never rewritten: a task walks them down the trees grown so far, which are small (at most ``trees * 2**depth``
nodes) and the only thing that the driver holds.

Draws are hashes of (seed, tree, node, feature), so the model does not depend on partitions, order or retries.
Rows with a null label or null features take no part; features are numeric vectors of one length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Features looked at in a node: all up to this many, else this many drawn
LOOKED_AT = 64


def unit_draw(seed: int, *keys: np.ndarray) -> np.ndarray:
    """Even draws in [0, 1) from integer keys."""
    with np.errstate(over="ignore"):
        h = np.full(np.broadcast(*keys).shape, seed, dtype=np.uint64)
        for k in keys:
            h = (h ^ np.asarray(k).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
    return (h >> np.uint64(11)).astype(np.float64) / (1 << 53)


@dataclass
class Forest:
    """Trees as arrays [tree, node]; the children of node k are 2k + 1 and 2k + 2; feature -1 is a leaf."""

    trees: int
    depth: int
    feature: np.ndarray = field(init=False)
    cut: np.ndarray = field(init=False)
    p: np.ndarray = field(init=False)          # share of class 1 among the node's rows
    weight: np.ndarray = field(init=False)

    def __post_init__(self):
        shape = (self.trees, 2 ** (self.depth + 1) - 1)
        self.feature, self.cut = np.full(shape, -1, dtype=np.int32), np.zeros(shape)
        self.p, self.weight = np.zeros(shape), np.zeros(shape)

    def nodes(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The leaf of each row in a tree (as far as it is grown)."""
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            f = self.feature[tree, at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            if not len(rows):
                break
            at[rows] = 2 * at[rows] + 1 + (x[rows, f] > self.cut[tree, at[rows]])
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.mean([self.p[t, self.nodes(x, t)] for t in range(self.trees)], axis=0)


def looked_at(seed: int, tree: int, node: int, n_features: int) -> np.ndarray:
    """The features looked at in a node, in the order in which they become candidates."""
    return np.argsort(unit_draw(seed, np.int64(tree), np.int64(node), np.arange(n_features)), kind="stable")[:LOOKED_AT]


def _batches(frames: Iterator[pd.DataFrame]):
    for frame in frames:
        if len(frame):
            yield np.stack(frame["x"].to_numpy()).astype(float), frame["y"].to_numpy(float), frame["w"].to_numpy(float)


_RANGES = "tree int, node int, feature int, low double, high double, w double, pos double"
_SIDES = "tree int, node int, feature int, w double, pos double"


def _ranges(forest: Forest, open_: dict[int, dict[int, np.ndarray]]):
    """Ranges of the open nodes' features in each batch; feature -1 carries the node's weights."""
    def run(frames):
        for x, y, w in _batches(frames):
            out = []
            for tree, nodes in open_.items():
                at = forest.nodes(x, tree)
                order = np.argsort(at, kind="stable")
                here, first = np.unique(at[order], return_index=True)
                for node, rows in zip(here.tolist(), np.split(order, first[1:])):
                    if node in nodes:
                        f = nodes[node]
                        out.append((np.append(f, -1), np.append(x[np.ix_(rows, f)].min(axis=0), 0.0), np.append(x[np.ix_(rows, f)].max(axis=0), 0.0), tree, node, w[rows].sum(), (w * y)[rows].sum()))
            if out:
                sizes = [len(o[0]) for o in out]
                yield pd.DataFrame({"tree": np.repeat([o[3] for o in out], sizes), "node": np.repeat([o[4] for o in out], sizes), "feature": np.concatenate([o[0] for o in out]),
                                    "low": np.concatenate([o[1] for o in out]), "high": np.concatenate([o[2] for o in out]),
                                    "w": np.repeat([o[5] for o in out], sizes), "pos": np.repeat([o[6] for o in out], sizes)})
    return run


def _sides(forest: Forest, cuts: dict[int, dict[int, tuple[np.ndarray, np.ndarray]]]):
    """Weight and class-1 weight left of each cut, in each batch."""
    def run(frames):
        for x, y, w in _batches(frames):
            out = []
            for tree, nodes in cuts.items():
                at = forest.nodes(x, tree)
                order = np.argsort(at, kind="stable")
                here, first = np.unique(at[order], return_index=True)
                for node, rows in zip(here.tolist(), np.split(order, first[1:])):
                    if node in nodes:
                        f, cut = nodes[node]
                        left = x[np.ix_(rows, f)] <= cut
                        out.append((f, left.T @ w[rows], left.T @ (w * y)[rows], tree, node))
            if out:
                sizes = [len(o[0]) for o in out]
                yield pd.DataFrame({"tree": np.repeat([o[3] for o in out], sizes), "node": np.repeat([o[4] for o in out], sizes), "feature": np.concatenate([o[0] for o in out]),
                                    "w": np.concatenate([o[1] for o in out]), "pos": np.concatenate([o[2] for o in out])})
    return run


def gini_fall(w: np.ndarray, pos: np.ndarray, left: np.ndarray, left_pos: np.ndarray) -> np.ndarray:
    """Fall of weighted Gini impurity by a cut of a node."""
    def impurity(n, p):
        share = p / np.maximum(n, 1e-300)
        return n * 2 * share * (1 - share)
    return impurity(w, pos) - impurity(left, left_pos) - impurity(w - left, pos - left_pos)


class ExtraTrees:
    """Estimator: ``fit(df)`` gives a model with ``transform`` (prediction, probability)."""

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", weightCol: str | None = None, numTrees: int = 100, maxDepth: int = 10,
                 maxFeatures: int | None = None, minInstances: float = 2, seed: int = 42):
        self.features, self.label, self.weight = featuresCol, labelCol, weightCol
        self.trees, self.depth, self.most, self.least, self.seed = numTrees, maxDepth, maxFeatures, minInstances, seed

    def fit(self, df: DataFrame) -> "ExtraTreesModel":
        w = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        rows = cut_lineage(df.where(F.col(self.label).isNotNull() & F.col(self.features).isNotNull())
                           .select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y"), w.alias("w")).where("w > 0"))
        size = rows.agg(F.max(F.size("x"))).first()[0]
        forest = Forest(self.trees, self.depth)
        if size is None:
            return ExtraTreesModel(forest, self.features)
        most = self.most or max(1, int(size ** 0.5))
        open_ = {t: {0: looked_at(self.seed, t, 0, size)} for t in range(self.trees)}
        for level in range(self.depth + 1):
            found = rows.mapInPandas(_ranges(forest, open_), _RANGES).groupBy("tree", "node", "feature") \
                .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("w").alias("w"), F.sum("pos").alias("pos")).toPandas()
            cuts, totals = {}, {}
            for (tree, node), part in found.groupby(["tree", "node"]):
                whole = part[part["feature"] < 0].iloc[0]
                forest.weight[tree, node], forest.p[tree, node] = whole["w"], whole["pos"] / whole["w"]
                if level == self.depth or whole["w"] < self.least or not 0 < whole["pos"] < whole["w"]:
                    continue
                ranges = part.set_index("feature")
                varied = [f for f in open_[tree][node].tolist() if ranges.at[f, "low"] < ranges.at[f, "high"]][:most]
                if varied:
                    low, high = ranges.loc[varied, "low"].to_numpy(), ranges.loc[varied, "high"].to_numpy()
                    cut = low + (high - low) * unit_draw(self.seed + 1, np.int64(tree), np.int64(node), np.array(varied))
                    cuts.setdefault(int(tree), {})[int(node)] = (np.array(varied), np.where(cut < high, cut, low))
                    totals[tree, node] = (whole["w"], whole["pos"])
            if not cuts:
                break
            sides = rows.mapInPandas(_sides(forest, cuts), _SIDES).groupBy("tree", "node", "feature").agg(F.sum("w").alias("w"), F.sum("pos").alias("pos")).toPandas()
            open_ = {}
            for (tree, node), part in sides.groupby(["tree", "node"]):
                n, pos = totals[tree, node]
                f, cut = cuts[tree][node]
                part = part.set_index("feature").loc[f]
                best = int(np.argmax(np.round(gini_fall(n, pos, part["w"].to_numpy(), part["pos"].to_numpy()), 12)))
                forest.feature[tree, node], forest.cut[tree, node] = f[best], cut[best]
                for child in (2 * node + 1, 2 * node + 2):
                    open_.setdefault(int(tree), {})[int(child)] = looked_at(self.seed, tree, child, size)
        return ExtraTreesModel(forest, self.features)


class ExtraTreesModel:
    def __init__(self, forest: Forest, features: str):
        self.forest, self.features = forest, features

    def transform(self, df: DataFrame) -> DataFrame:
        forest = self.forest

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(forest.score(np.stack(x.to_numpy()).astype(float)) if len(x) else np.empty(0), dtype=float)
        scored = df.withColumn("probability", score(vector_to_array(self.features)))
        return scored.withColumn("prediction", (F.col("probability") > 0.5).cast("double")).withColumn("probability", array_to_vector(F.array(1 - F.col("probability"), F.col("probability"))))
