"""Gradient-boosted trees on histograms, for two or more classes.

Feature values become bins by quantile sketches, once. Rows are then kept in persisted blocks of bins
with their margins. A tree grows level by level: every block sums gradients and hessians per (node,
feature, bin), and the sums of each class and feature are added up in one task, which keeps them and finds the
feature's best cut of each node. Only these cuts reach the driver, which chooses among the features. Below the
root a pass sums the left children only; the right ones are what is left of their parents. One tree per class
grows in the same passes. The pass over the root also
applies the trees of the round before and takes the validation loss, so early stopping costs no pass. A
table of one block (``BLOCK_ROWS`` rows at most) is one task's work: that task's sums are the whole sums, and it
grows the same trees by the same code without an exchange.

Gradients count in whole multiples of 2^-24, so their sums do not depend on the order of addition: a lost
executor or another number of partitions gives the same trees. Lineage is cut by ``checkpoint()`` every
``CUT_AFTER`` rounds. Missing values (null, NaN) have a bin of their own, and each split learns their side.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import require_columns
from millrace.session import materialize, shared_dir, stored_side

BINS = 255
BLOCK_ROWS = 1 << 16
UNIT = float(1 << 24)
LEAST_GAIN = 1e-6
CUT_AFTER = 25
LOSS = (-1, -1)  # the key of the validation loss among those of classes and features
DRIVER_PARTS = 8  # partitions of blocks whose sums one task adds up, so that the driver need not

# Task functions travel inside the task, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class Tree:
    """Nodes in heap order: the children of ``i`` are ``2i + 1`` and ``2i + 2``; feature -1 marks a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (1 << (depth + 1)) - 1
        return cls(np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, bool), np.zeros(n))

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each column of ``bins`` after so many levels."""
        at = np.zeros(bins.shape[1], np.int32)
        rows = np.arange(bins.shape[1])
        for _ in range(levels):
            feature = self.feature[at]
            inner = feature >= 0
            if not inner.any():
                break
            found = bins[np.maximum(feature, 0), rows]
            left = np.where(found == 0, self.missing_left[at], found <= self.cut[at])
            at = np.where(inner, 2 * at + 2 - left, at)
        return at

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 1

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return self.value[self.nodes(bins, self.depth)]


def to_bins(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """0 for missing, else 1 + the number of edges below the value."""
    codes = np.searchsorted(edges, values, side="left") + 1
    return np.where(np.isnan(values), 0, codes).astype(np.uint8)


def probabilities(margins: np.ndarray) -> np.ndarray:
    """Class probabilities (rows) from margins: one row for two classes, else one per class."""
    if len(margins) == 1:
        p = 1 / (1 + np.exp(-margins[0]))
        return np.stack([1 - p, p])
    raised = np.exp(margins - margins.max(axis=0))
    return raised / raised.sum(axis=0)


@dataclass
class BoostedTrees:
    """A fitted model; ``rounds[t][c]`` is the tree of class ``c`` in round ``t``."""

    features: list[str]
    edges: list[np.ndarray]
    classes: int
    rounds: list[list[Tree]] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    @property
    def getNumTrees(self) -> int:  # this and ``stages`` are named as in Spark ML
        return len(self.rounds)

    @property
    def stages(self) -> list[BoostedTrees]:
        return [self]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (an array with a value per class) and ``prediction``."""
        require_columns(df, self.features)
        edges, rounds, margins = self.edges, self.rounds, 1 if self.classes == 2 else self.classes

        @F.pandas_udf("array<double>")
        def probability(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for rows in batches:
                bins = np.stack([to_bins(rows[c].to_numpy("float64", na_value=np.nan), e) for c, e in zip(rows, edges, strict=True)])
                total = np.zeros((margins, bins.shape[1]))
                for trees in rounds:
                    for c, tree in enumerate(trees):
                        total[c] += tree.scores(bins)
                yield pd.Series(list(probabilities(total).T))

        values = [F.col(c).cast("double").alias(f"_f{i}") for i, c in enumerate(self.features)]
        scored = df.withColumn("probability", probability(F.struct(*values)))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes as a table, and the edges of the bins beside it."""
        rows = [
            (t, c, i, int(tree.feature[i]), int(tree.cut[i]), bool(tree.missing_left[i]), float(tree.value[i]))
            for t, trees in enumerate(self.rounds)
            for c, tree in enumerate(trees)
            for i in range(len(tree.feature))
        ]
        columns = "round int, class int, node int, feature int, cut int, missing_left boolean, value double"
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        about = {"features": self.features, "edges": [e.tolist() for e in self.edges], "classes": self.classes}
        spark.createDataFrame([(json.dumps(about),)], "value string").write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        model = cls(about["features"], [np.array(e) for e in about["edges"]], about["classes"])
        # A model is bounded by its settings: rounds, classes, depth.
        nodes = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["round", "class", "node"])
        for _, trees in nodes.groupby("round"):
            model.rounds.append(
                [
                    Tree(t["feature"].to_numpy(np.int16), t["cut"].to_numpy(np.uint8), t["missing_left"].to_numpy(bool), t["value"].to_numpy())
                    for _, t in trees.groupby("class")
                ]
            )
        return model


@dataclass
class Block:
    """Rows of a partition: bins by feature, class, whether they are trained on, and margins by class."""

    bins: np.ndarray
    label: np.ndarray
    trained: np.ndarray
    margin: np.ndarray

    def gradients(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-loss, in whole units, by class."""
        p = probabilities(self.margin)
        if len(self.margin) == 1:
            p, truth, factor = p[1:], self.label[None, :] == 1, 1
        else:
            truth, factor = self.label[None, :] == np.arange(len(p))[:, None], 2
        return np.rint((p - truth) * UNIT), np.rint(np.maximum(factor * p * (1 - p), 1e-16) * UNIT)

    def loss(self) -> tuple[int, int]:
        """Summed log-loss of the rows held out, in whole units, and their number."""
        p = probabilities(self.margin[:, ~self.trained])
        own = p[self.label[~self.trained], np.arange(p.shape[1])]
        return int(np.rint(-np.log(np.maximum(own, 1e-15)) * UNIT).sum()), p.shape[1]

    def sums(self, trees: list[Tree], level: int, starts: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Gradients and hessians per node of the level and bin, by class and feature.

        Below the root only of the left children: what remains of the parent is the right child's.
        """
        step = 2 if level else 1
        nodes, first = (1 << level) // step, (1 << level) - 1
        gradient, hessian = self.gradients()
        out = {}
        for c, tree in enumerate(trees):
            at = tree.nodes(self.bins, level) - first
            rows = np.flatnonzero(self.trained & (at >= 0) & (at % step == 0))
            node = at[rows].astype(np.int64) // step
            weights = gradient[c, rows], hessian[c, rows]
            for f, codes in enumerate(self.bins):
                size = int(starts[f + 1] - starts[f])
                place = node * size + codes[rows]
                total = [np.bincount(place, w, nodes * size).astype(np.int64) for w in weights]
                out[c, f] = np.stack(total).reshape(2, nodes, size)
        return out

    def grown(self, trees: list[Tree]) -> Block:
        more = np.stack([tree.scores(self.bins) for tree in trees])
        return Block(self.bins, self.label, self.trained, self.margin + more)

    def fields(self) -> tuple:
        return self.bins, self.label, self.trained, self.margin


# Of one feature: nodes with rows, their gradients and hessians, and by the side of missing values each
# node's best gain, its cut, and gradients and hessians left of it.
Cuts = tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, ...]]]
AllCuts = dict[tuple[int, int], Cuts]  # by class and feature


@dataclass
class Settings:
    """What a tree depends on besides its sums; ``starts``: where each feature's bins begin, and their end."""

    starts: np.ndarray
    depth: int
    rate: float
    penalty: float
    least: float

    def cuts(self, sums: np.ndarray) -> Cuts:
        """The best cut of each node by one feature, given ``sums[gradient or hessian, node, bin]``."""
        part = lambda x, y: x**2 / (y + self.penalty)
        filled = np.flatnonzero(sums[1].any(axis=1))
        g, h = sums[:, filled] / UNIT
        whole_g, whole_h = g.sum(axis=1), h.sum(axis=1)
        own = part(whole_g, whole_h)
        found, rows = [], np.arange(len(filled))
        # Missing values go to the left or to the right; without any, both are the same.
        for side in (True, False) if sums[1, :, 0].any() else (True,):
            left_g = np.cumsum(g[:, 1:], axis=1) + side * g[:, :1]
            left_h = np.cumsum(h[:, 1:], axis=1) + side * h[:, :1]
            right_g, right_h = whole_g[:, None] - left_g, whole_h[:, None] - left_h
            gain = 0.5 * (part(left_g, left_h) + part(right_g, right_h) - own[:, None])
            gain[(left_h < self.least) | (right_h < self.least)] = -np.inf
            at = gain.argmax(axis=1)
            found.append((gain[rows, at], at, left_g[rows, at], left_h[rows, at]))
        return filled, whole_g, whole_h, found

    def split(self, cuts: list[Cuts], tree: Tree, level: int) -> bool:
        """Choose the splits of a level's nodes among the features' best cuts."""
        value = lambda x, y: -self.rate * x / (y + self.penalty)
        filled, whole_g, whole_h, _ = cuts[0]  # every feature's bins hold all rows
        first = (1 << level) - 1 + filled
        if level == 0:
            tree.value[0] = value(whole_g, whole_h)[0]
        best = np.full(len(filled), LEAST_GAIN)
        for k, side in enumerate((True, False)):
            for f, (_, _, _, found) in enumerate(cuts):
                if k == len(found):
                    continue
                top, at, left_g, left_h = found[k]
                for i in np.flatnonzero(top > best + 1e-12):
                    best[i], node = top[i], first[i]
                    tree.feature[node], tree.cut[node], tree.missing_left[node] = f, at[i] + 1, side
                    tree.value[2 * node + 1] = value(left_g[i], left_h[i])
                    tree.value[2 * node + 2] = value(whole_g[i] - left_g[i], whole_h[i] - left_h[i])
        return bool((best > LEAST_GAIN).any())

    def grow(self, trees: list[Tree], cuts: AllCuts, next_cuts) -> None:
        """Grow the trees of a round. ``cuts`` are those of the root, ``next_cuts(level)`` gives those of lower levels."""
        features = range(len(self.starts) - 1)
        for level in range(self.depth):
            cuts = next_cuts(level) if level else cuts
            # A list: every class's splits are chosen, also if the first of them has some.
            if not any([self.split([cuts[c, f] for f in features], tree, level) for c, tree in enumerate(trees)]):
                return


def _with_right(left: np.ndarray, parents: np.ndarray, tree: Tree, level: int) -> np.ndarray:
    """Sums of a level from those of its left children: the right child has what they leave of the parent,
    nothing if the parent is a leaf.
    """
    split = tree.feature[(1 << level - 1) - 1 : (1 << level) - 1] >= 0
    return np.stack([left, (parents - left) * split[None, :, None]], axis=2).reshape(2, 1 << level, -1)


def quantile_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of each feature's bins but the last, from one pass of mergeable quantile sketches."""
    shares = [i / (bins - 1) for i in range(1, bins - 1)]
    found = rows.approxQuantile(list(features), shares, 1 / (2 * bins))
    return [np.unique(np.array(values, np.float64)) for values in found]


def _blocks(rows: DataFrame, edges: list[np.ndarray], margins: int) -> RDD:
    """The fields of ``Block`` as tuples, which are quickly stored: rows are one column per feature, then ``_label``
    and ``_held``.
    """

    def packed(batches):
        columns = pa.Table.from_batches(batches).columns
        values = [c.to_numpy().astype(np.float64) for c in columns]
        bins = np.stack([to_bins(v, e) for v, e in zip(values, edges, strict=False)])
        label, trained = values[-2].astype(np.int16), values[-1] == 0
        return pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "label": [label.tobytes()], "trained": [trained.tobytes()]})

    def encode(batches):
        held, number = [], 0
        for batch in batches:
            held.append(batch)
            number += batch.num_rows
            if number >= BLOCK_ROWS:
                yield packed(held)
                held, number = [], 0
        if number:
            yield packed(held)

    stored = materialize(rows.mapInArrow(encode, "bins binary, label binary, trained binary"), "bins")

    def load(row):
        label = np.frombuffer(row["label"], np.int16).astype(np.int64)
        bins = np.frombuffer(row["bins"], np.uint8).reshape(len(edges), len(label))
        return bins, label, np.frombuffer(row["trained"], bool), np.zeros((margins, len(label)))

    return stored.rdd.map(load)


def _level(blocks: RDD, trees: list[Tree], level: int, settings: Settings, above: RDD | None) -> tuple[AllCuts, RDD, int, int]:
    """Cuts of a level, its sums by class and feature, and at the root the validation loss and its number of rows."""
    parts = min(len(trees) * (len(settings.starts) - 1), -(-blocks.getNumPartitions() // DRIVER_PARTS))

    def run(part):
        sums, loss, held = _summed((Block(*fields) for fields in part), trees, level, settings.starts)
        yield from sums.items()
        if level == 0:
            yield LOSS, np.array([loss, held], np.int64)

    added = blocks.mapPartitions(run).reduceByKey(lambda a, b: a + b, parts)
    if above is not None:
        both = added.join(above, parts)
        whole = lambda item: (item[0], _with_right(*item[1], trees[item[0][0]], level))
        added = both.map(whole, preservesPartitioning=True)
    added = added.persist(StorageLevel.MEMORY_AND_DISK)
    found = dict(added.map(lambda item: (item[0], item[1] if item[0] == LOSS else settings.cuts(item[1]))).collect())
    loss, held = found.pop(LOSS, (0, 0))
    return found, added, int(loss), int(held)


def _summed(blocks, trees: list[Tree], level: int, starts: np.ndarray) -> tuple[dict[tuple[int, int], np.ndarray], int, int]:
    sums, loss, held = {}, 0, 0
    for block in blocks:
        for key, more in block.sums(trees, level, starts).items():
            sums[key] = sums[key] + more if key in sums else more
        if level == 0:
            more, rows = block.loss()
            loss, held = loss + more, held + rows
    return sums, loss, held


class Progress:
    """Rounds so far and when to stop."""

    def __init__(self, rounds: int, patience: int | None):
        self.rounds, self.patience = rounds, patience
        self.trees: list[list[Tree]] = []
        self.losses: list[float] = []
        self.best = 0

    def over(self, loss: int, tested: int) -> bool:
        """Take the validation loss of the rounds so far; True if no further round is to be grown."""
        number = len(self.trees)
        if tested:
            self.losses.append(loss / UNIT / tested)
            self.best = number if self.losses[-1] < self.losses[self.best] else self.best
        return number == self.rounds or bool(self.patience and tested and number - self.best >= self.patience)


def _grow_in_task(blocks: list[Block], progress: Progress, margins: int, settings: Settings) -> Progress:
    """All rounds over the blocks of one task: its sums are the whole sums."""
    while True:
        trees = [Tree.empty(settings.depth) for _ in range(margins)]
        sums, loss, tested = _summed(blocks, trees, 0, settings.starts)
        if progress.over(loss, tested):
            return progress

        def next_cuts(level: int) -> AllCuts:
            nonlocal sums
            left = _summed(blocks, trees, level, settings.starts)[0]  # noqa: B023
            sums = {key: _with_right(left[key], sums[key], trees[key[0]], level) for key in left}  # noqa: B023
            return {key: settings.cuts(own) for key, own in sums.items()}

        settings.grow(trees, {key: settings.cuts(own) for key, own in sums.items()}, next_cuts)
        progress.trees.append(trees)
        blocks = [block.grown(trees) for block in blocks]


def _grow_on_cluster(blocks: RDD, progress: Progress, margins: int, settings: Settings, spark: SparkSession) -> Progress:
    """All rounds, one pass over the persisted blocks per level."""
    sc, stale = spark.sparkContext, None
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        while True:
            trees = [Tree.empty(settings.depth) for _ in range(margins)]
            cuts, sums, loss, tested = _level(blocks, trees, 0, settings, None)
            if stale is not None:
                stale.unpersist()
            if progress.over(loss, tested):
                sums.unpersist()
                return progress

            def next_cuts(level: int) -> AllCuts:
                nonlocal sums
                above = sums
                found, sums, _, _ = _level(blocks, trees, level, settings, above)  # noqa: B023
                above.unpersist()
                return found

            settings.grow(trees, cuts, next_cuts)
            sums.unpersist()
            progress.trees.append(trees)
            grown = blocks.map(lambda fields, trees=trees: Block(*fields).grown(trees).fields())
            grown = grown.persist(StorageLevel.MEMORY_AND_DISK)
            if len(progress.trees) % CUT_AFTER == 0:
                if not sc.getCheckpointDir():
                    sc.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
                grown.checkpoint()
            stale, blocks = blocks, grown
    finally:
        blocks.unpersist()
        if stale is not None:
            stale.unpersist()


def boost(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    classes: int = 2,
    validation: str | None = None,
    rounds: int = 100,
    depth: int = 6,
    rate: float = 0.1,
    patience: int | None = None,
    penalty: float = 1.0,
    least_hessian: float = 1.0,
    bins: int = BINS,
) -> BoostedTrees:
    """Boosted trees for the integer ``label`` 0 to ``classes - 1``.

    Rows where ``validation`` is true are not trained on. With ``patience``, growing ends after so many
    rounds without a better log-loss on them, and the model is cut off behind its best round. Rows without a
    label are left out; without rows to train on the model has no trees. ``bins`` is 255 at most.
    """
    if not 3 <= bins <= BINS:
        raise ValueError(f"bins must be 3 to {BINS}")
    held = F.coalesce(F.col(validation).cast("boolean"), F.lit(False)) if validation else F.lit(False)
    values = [F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)]
    labelled = require_columns(rows, [*features, label]).filter(F.col(label).isNotNull())
    ready = stored_side(labelled.select(*values, F.col(label).cast("int").alias("_label"), held.alias("_held")))
    shape = ready.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_held")).alias("trained")).first()
    if not shape["trained"]:
        return BoostedTrees(list(features), [np.empty(0) for _ in features], classes)
    edges = quantile_edges(ready.filter(~F.col("_held")), [f"_f{i}" for i in range(len(features))], bins)
    model = BoostedTrees(list(features), edges, classes)
    margins = 1 if classes == 2 else classes
    settings = Settings(np.cumsum([0, *[len(e) + 2 for e in edges]]), depth, rate, penalty, least_hessian)
    progress = Progress(rounds, patience)
    sc = rows.sparkSession.sparkContext
    # A partition for each core, or four if these still hold many blocks; a table of one block needs no exchange at all.
    full, cores = -(-shape["rows"] // BLOCK_ROWS), sc.defaultParallelism
    parts = max(1, min(full, cores if full < 16 * cores else 4 * cores))
    blocks = _blocks(ready.repartition(parts), edges, margins)
    if parts == 1:

        def run(part):
            done = _grow_in_task([Block(*fields) for fields in part], Progress(rounds, patience), margins, settings)
            plain = [[(t.feature, t.cut, t.missing_left, t.value) for t in trees] for trees in done.trees]
            yield plain, done.losses, done.best

        plain, progress.losses, progress.best = blocks.coalesce(1).mapPartitions(run).collect()[0]
        progress.trees = [[Tree(*t) for t in trees] for trees in plain]
    else:
        progress = _grow_on_cluster(blocks, progress, margins, settings, rows.sparkSession)
    model.rounds, model.losses = progress.trees, progress.losses
    if patience and model.losses:
        model.rounds = model.rounds[: max(progress.best, 1)]
    return model
