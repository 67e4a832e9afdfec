"""Second-order gradient boosting on binned inputs: level-wise, leaf-wise and symmetric trees.

Inputs are cut into bins once. A pass over the binned rows makes, for the nodes asked for, a table of
gradient sums, hessian sums and row counts by (node, input, bin), summed up in every task first; its
size does not depend on the number of rows. Splits are chosen from the sum of the tasks' tables. Of two siblings
only the one with fewer rows is asked for, the other one is the parent's table less that one. A level of a tree
is one pass; best-first growth asks for the children of several leaves at a time and takes them in order of gain.

A fit needs thousands of such passes over the same rows.
Rows that are one partition's worth are grown in one task, as a pass over them takes less time than starting
a job would; the task keeps gradients and the rows' nodes from pass to pass, and the driver gets the finished trees
alone. More rows are held as one numpy block a partition in a persisted RDD, built from a written table, so
that a lost executor costs its blocks; a pass is then a job whose tasks send their tables to the driver. Margins are
part of a block and brought up to date every RENEW trees; until then a pass adds the trees since.
"""

from __future__ import annotations

import heapq
import json
import pickle
import sys
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keepwell.session import staged

#: Bins of a numeric input; a category has one for each of its levels.
BINS = 64
#: Rows of a block, about (50 MB with 25 inputs), and blocks at most, each of which sends a table a pass to the driver.
#: On three executors of four cores an empty job takes about 80 ms, a pass over 200,000 rows in one task 25 to 40 ms.
BLOCK_ROWS, MOST_BLOCKS = 1_000_000, 8
#: Trees after which the margins in the blocks are brought up to date.
RENEW = 20
#: Leaves whose children best-first growth asks for at a time.
AHEAD = 8
#: Smoothing of a level's gradient ratio, extra penalty of a split by levels, and levels tried one against the rest.
CAT_SMOOTH, CAT_L2, ONE_HOT = 10.0, 10.0, 4


@dataclass(frozen=True)
class Settings:
    """How trees are grown. ``leaves`` asks for best-first growth, ``symmetric`` for one split a level."""

    rounds: int
    depth: int = 0
    leaves: int = 0
    symmetric: bool = False
    rate: float = 0.05
    l2: float = 1.0
    min_hessian: float = 1e-3
    min_rows: int = 1
    row_share: float = 1.0
    column_share: float = 1.0
    average_start: bool = False
    seed: int = 42


@dataclass
class Tree:
    """Nodes in arrays: a row goes left where its bin of ``feature`` is marked; leaves have no left child."""

    feature: list[int] = field(default_factory=list)
    goes_left: list[np.ndarray] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, bins: int) -> int:
        self.feature.append(0)
        self.goes_left.append(np.zeros(bins, bool))
        self.left.append(-1)
        self.right.append(-1)
        self.value.append(value)
        self.gain.append(0.0)
        return len(self.left) - 1

    def split(self, node: int, found: Split, values: tuple[float, float]) -> tuple[int, int]:
        bins = len(found.goes_left)
        self.feature[node], self.goes_left[node], self.gain[node] = found.feature, found.goes_left, found.gain
        self.left[node], self.right[node] = self.add(values[0], bins), self.add(values[1], bins)
        return self.left[node], self.right[node]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (
            np.array(self.feature), np.array(self.goes_left), np.array(self.left), np.array(self.right), np.array(self.value)
        )


@dataclass
class Split:
    gain: float
    feature: int
    goes_left: np.ndarray
    sums: tuple[np.ndarray, np.ndarray]  # (gradient, hessian, rows) of the left and the right side


def places(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The leaf of every row of bins."""
    return moved(tree, x, np.zeros(len(x), np.int64))


def moved(tree: tuple[np.ndarray, ...], x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The leaf of every row of bins, from the nodes ``at`` on, which are changed in place."""
    feature, goes_left, left, right, _ = tree
    moving = np.arange(len(x))
    while len(moving):
        moving = moving[left[at[moving]] >= 0]
        node = at[moving]
        at[moving] = np.where(goes_left[node, x[moving, feature[node]]], left[node], right[node])
    return at


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def sampled(key: np.ndarray, tree: int, share: float) -> np.ndarray:
    """Which rows a tree sees, from a hash of a row's key and the tree's number (public splitmix64 constants)."""
    if share >= 1:
        return np.ones(len(key), bool)
    z = key.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))).astype(np.float64) < share * 2.0**64


def with_trees(block: dict, trees: list[tuple]) -> dict:
    """The block with margins that the trees are added to."""
    out = block["margin"]
    for tree in trees:
        out = out + tree[4][places(tree, block["x"])]
    return block | {"margin": out}


def gradients(block: dict) -> tuple[np.ndarray, np.ndarray]:
    p = sigmoid(block["margin"])
    return (p - block["y"]) * block["w"], p * (1 - p) * block["w"]


def summed(
    columns: np.ndarray, own: np.ndarray, seen: np.ndarray, weights: tuple[np.ndarray, np.ndarray], nodes: int, bins: int
) -> np.ndarray:
    """(node, input, bin, 3) of the ``seen`` rows, whose number among the ``nodes`` is ``own``, negative for none."""
    rows = np.flatnonzero((own >= 0) & seen)
    first = own[rows] * bins
    taken = (weights[0][rows], weights[1][rows], None)
    out = np.empty((nodes, len(columns), bins, 3))
    for f, column in enumerate(columns):
        cell = first + column[rows]
        for k, weight in enumerate(taken):
            out[:, f, :, k] = np.bincount(cell, weights=weight, minlength=nodes * bins).reshape(-1, bins)
    return out


def numbered(nodes: list[int], size: int) -> np.ndarray:
    """The place of each node of a tree in ``nodes``, -1 for others."""
    slot = np.full(size, -1)
    slot[nodes] = np.arange(len(nodes))
    return slot


def tables(block: dict, tree: tuple, nodes: list[int], number: int, share: float, bins: int) -> np.ndarray:
    """(node, input, bin, 3): sums of gradient, hessian and rows of a block's rows in the ``nodes`` of the partial tree."""
    own = numbered(nodes, len(tree[2]))[places(tree, block["x"])]
    return summed(block["x"].T, own, sampled(block["key"], number, share), gradients(block), len(nodes), bins)


def _candidates(table: np.ndarray, category: np.ndarray, l2: float):
    """For one node's table: (order of bins, left sums after each place, l2) for every input."""
    bins = table.shape[1]
    order = np.tile(np.arange(bins), (table.shape[0], 1))
    penalty = np.full(table.shape[0], l2)
    for f in np.flatnonzero(category):
        used = table[f, :, 2] > 0
        ratio = np.where(used, table[f, :, 0] / (table[f, :, 1] + CAT_SMOOTH), np.inf)
        order[f] = np.argsort(ratio, kind="stable")
        if used.sum() > ONE_HOT:
            penalty[f] += CAT_L2
    left = np.cumsum(np.take_along_axis(table, order[:, :, None], axis=1), axis=1)
    return order, left, penalty


def best_split(table: np.ndarray, category: np.ndarray, allowed: np.ndarray, settings: Settings) -> Split | None:
    """The split of one node with the highest gain, the first of equals; none if no gain is above zero."""
    order, left, penalty = _candidates(table, category, settings.l2)
    total = left[0, -1]
    right = total - left
    fits = allowed[:, None] & (np.minimum(left[..., 1], right[..., 1]) >= settings.min_hessian)
    fits &= np.minimum(left[..., 2], right[..., 2]) >= max(1, settings.min_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = 0.5 * (
            left[..., 0] ** 2 / (left[..., 1] + penalty[:, None])
            + right[..., 0] ** 2 / (right[..., 1] + penalty[:, None])
            - total[0] ** 2 / (total[1] + settings.l2)
        )
    gain = np.where(fits, gain, -np.inf)
    f, place = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if not gain[f, place] > 1e-9:
        return None
    goes_left = np.zeros(table.shape[1], bool)
    goes_left[order[f, : place + 1]] = True
    return Split(float(gain[f, place]), int(f), goes_left, (left[f, place], right[f, place]))


def common_split(level: list[np.ndarray], allowed: np.ndarray, settings: Settings) -> tuple[int, int] | None:
    """The (input, bin) whose split of all nodes of a level adds most to the sum of G^2 / (H + l2)."""
    left = np.cumsum(np.stack(level), axis=2)
    right = left[:, :, -1:] - left
    # No rows, no gradient: an empty side adds nothing.
    score = sum((s[..., 0] ** 2 / (s[..., 1] + settings.l2)).sum(axis=0) for s in (left, right))
    score = np.where(allowed[:, None], score, -np.inf)
    score[:, -1] = -np.inf
    f, place = np.unravel_index(int(np.argmax(score)), score.shape)
    before = sum(t[0, :, 0].sum() ** 2 / (t[0, :, 1].sum() + settings.l2) for t in level)
    return (int(f), int(place)) if score[f, place] - before > 1e-9 else None


Ask = Callable[[tuple, list[int]], np.ndarray]


class Grower:
    """Grows one tree from the tables that ``ask`` returns for nodes of a partial tree."""

    def __init__(self, ask: Ask, bins: int, category: np.ndarray, allowed: np.ndarray, settings: Settings):
        self.ask, self.bins, self.category, self.allowed, self.settings = ask, bins, category, allowed, settings
        self.tree = Tree()
        self.tree.add(0.0, bins)
        self.table = {0: ask(self.tree.arrays(), [0])[0]}
        total = self.table[0][0].sum(axis=0)
        self.tree.value[0] = self.leaf(total)

    def leaf(self, sums: np.ndarray) -> float:
        return float(-self.settings.rate * sums[0] / (sums[1] + self.settings.l2)) if sums[2] else 0.0

    def open(self, splits: dict[int, Split]) -> None:
        """Split nodes and get their children's tables: the smaller by a pass, the other by subtraction."""
        asked, rest = [], []
        for node, found in splits.items():
            left, right = self.tree.split(node, found, (self.leaf(found.sums[0]), self.leaf(found.sums[1])))
            small, large = (left, right) if found.sums[0][2] <= found.sums[1][2] else (right, left)
            asked.append(small)
            rest.append((node, small, large))
        for (node, small, large), table in zip(rest, self.ask(self.tree.arrays(), asked), strict=True):
            self.table[small], self.table[large] = table, self.table[node] - table

    def found(self, node: int) -> Split | None:
        return best_split(self.table[node], self.category, self.allowed, self.settings)

    def level_wise(self) -> Tree:
        level = [0]
        for depth in range(self.settings.depth):
            splits = {n: s for n in level if (s := self.found(n)) is not None}
            if not splits:
                break
            if depth + 1 == self.settings.depth:  # nothing is asked of the last level
                for node, s in splits.items():
                    self.tree.split(node, s, (self.leaf(s.sums[0]), self.leaf(s.sums[1])))
                break
            self.open(splits)
            level = [c for n in splits for c in (self.tree.left[n], self.tree.right[n])]
        return self.tree

    def best_first(self) -> Tree:
        """Always the leaf with the highest gain next; the tables of what may come next are asked for together."""
        splits: dict[int, Split] = {}
        heap: list[tuple[float, int]] = []

        def push(node: int) -> None:
            if (s := self.found(node)) is not None:
                splits[node] = s
                heapq.heappush(heap, (-s.gain, node))

        push(0)
        opened, taken, leaves = set(), set(), 1
        while heap and leaves < self.settings.leaves:
            node = heap[0][1]
            if node not in opened:
                ahead = [n for _, n in sorted(heap) if n not in opened][: min(AHEAD, self.settings.leaves - leaves)]
                self.open({n: splits[n] for n in ahead})
                opened.update(ahead)
            heapq.heappop(heap)
            taken.add(node)
            leaves += 1
            push(self.tree.left[node])
            push(self.tree.right[node])
        for node in opened - taken:
            self.tree.left[node] = self.tree.right[node] = -1
            self.tree.gain[node] = 0.0
        return self.tree

    def same_split(self) -> Tree:
        """One split for all nodes of a level; an empty child has the value 0."""
        level = [0]
        for depth in range(self.settings.depth):
            chosen = common_split([self.table[n] for n in level], self.allowed, self.settings)
            if chosen is None:
                break
            f, place = chosen
            goes_left = np.arange(self.bins) <= place
            splits = {}
            for n in level:
                sides = self.table[n][f, goes_left].sum(axis=0), self.table[n][f, ~goes_left].sum(axis=0)
                both = sum(s[0] ** 2 / (s[1] + self.settings.l2) for s in sides)
                whole = sides[0] + sides[1]
                splits[n] = Split(float(both - whole[0] ** 2 / (whole[1] + self.settings.l2)), f, goes_left, sides)
            if depth + 1 == self.settings.depth:
                for node, s in splits.items():
                    self.tree.split(node, s, (self.leaf(s.sums[0]), self.leaf(s.sums[1])))
                break
            self.open(splits)
            level = [c for n in level for c in (self.tree.left[n], self.tree.right[n])]
        return self.tree

    def grow(self) -> Tree:
        if self.settings.leaves:
            return self.best_first()
        return self.same_split() if self.settings.symmetric else self.level_wise()


def block_of(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray | None], bins: int) -> dict:
    """A task's rows (x, y, w, key) as arrays, inputs in bins."""
    parts = [(np.zeros((0, len(cuts)), np.uint16), np.zeros(0), np.zeros(0), np.zeros(0, np.int64))]
    for batch in batches:
        if batch.num_rows:
            x = np.stack(batch.column("x").to_numpy(zero_copy_only=False))
            rest = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "key"))
            parts.append((binned(x, cuts, bins), *rest))
    x, y, w, key = (np.concatenate(p) for p in zip(*parts, strict=True))
    return {"x": x, "y": y, "w": w, "key": key}


def binned(x: np.ndarray, cuts: list[np.ndarray | None], bins: int) -> np.ndarray:
    """Bins of raw inputs: the number of cuts below a value; of a category its index (the last bin for any beyond)."""
    out = np.empty(x.shape, np.uint16)
    for f, c in enumerate(cuts):
        if c is None:
            out[:, f] = np.clip(x[:, f], 0, bins - 1)
        else:
            out[:, f] = np.searchsorted(c, x[:, f], side="left")
    return out


class InTask:
    """Passes over the one block of a task. What passes of one tree share is made once: gradients, the rows that
    the tree sees, and the nodes they are in, from which the next pass goes on."""

    def __init__(self, block: dict):
        self.block = block
        self.columns = np.ascontiguousarray(block["x"].T)
        self.number = -1

    def totals(self) -> np.ndarray:
        return _totals(self.block)

    def start(self, base: float) -> None:
        self.block = self.block | {"margin": np.full(len(self.block["y"]), base)}

    def ask(self, tree: tuple, nodes: list[int], number: int, share: float, bins: int) -> np.ndarray:
        if number != self.number:
            self.number, self.weights = number, gradients(self.block)
            self.seen = sampled(self.block["key"], number, share)
            self.at = np.zeros(len(self.seen), np.int64)
        moved(tree, self.block["x"], self.at)
        own = numbered(nodes, len(tree[2]))[self.at]
        return summed(self.columns, own, self.seen, self.weights, len(nodes), bins)

    def add(self, tree: tuple) -> None:
        self.block, self.number = with_trees(self.block, [tree]), -1


class ByJobs:
    """Passes over a persisted RDD of blocks, each of them a job."""

    def __init__(self, blocks: RDD):
        self.blocks, self.recent = blocks.persist(StorageLevel.MEMORY_AND_DISK), []

    def totals(self) -> np.ndarray:
        return np.sum(self.blocks.map(_totals).collect(), axis=0)

    def _renew(self, change: Callable[[dict], dict]) -> None:
        fresh = self.blocks.map(change).persist(StorageLevel.MEMORY_AND_DISK)
        fresh.count()
        self.blocks.unpersist()
        self.blocks, self.recent = fresh, []

    def start(self, base: float) -> None:
        self._renew(lambda b: b | {"margin": np.full(len(b["y"]), base)})

    def ask(self, *what) -> np.ndarray:
        recent = list(self.recent)
        return np.sum(self.blocks.map(lambda b: tables(with_trees(b, recent), *what)).collect(), axis=0)

    def add(self, tree: tuple) -> None:
        self.recent.append(tree)
        if len(self.recent) == RENEW:
            trees = self.recent
            self._renew(lambda b: with_trees(b, trees))


def _totals(block: dict) -> np.ndarray:
    return np.array([(block["y"] * block["w"]).sum(), block["w"].sum()])


def grown(rows: InTask | ByJobs, category: np.ndarray, bins: int, settings: Settings) -> dict:
    """All trees, and where margins start."""
    up, every = rows.totals()
    base = float(np.log(up / (every - up))) if settings.average_start and 0 < up < every else 0.0
    rows.start(base)
    rng = np.random.default_rng(settings.seed)
    inputs, trees = len(category), []
    for number in range(settings.rounds):
        allowed = np.zeros(inputs, bool)
        allowed[rng.permutation(inputs)[: max(1, int(settings.column_share * inputs))]] = True

        def ask(tree: tuple, nodes: list[int], number=number) -> np.ndarray:
            return rows.ask(tree, nodes, number, settings.row_share, bins)

        tree = Grower(ask, bins, category, allowed, settings).grow()
        rows.add(tree.arrays())
        trees.append(
            {"feature": tree.feature, "left": tree.left, "right": tree.right, "value": tree.value, "gain": tree.gain,
             "goes_left": [np.flatnonzero(m).tolist() for m in tree.goes_left]}
        )
    return {"base": base, "trees": trees}


def learned_cuts(train: DataFrame, features: Column, names: list[str], nominal: set[int], most: int = BINS) -> list:
    """For each numeric input the distinct values at most - 1 quantiles; None for a category. One job for all."""
    shares = [k / most for k in range(1, most)]
    array = train.select(features.alias("x"))
    asked = [F.percentile_approx(F.col("x")[f], shares, 10_000).alias(f"q{f}") for f in range(len(names)) if f not in nominal]
    found = array.agg(*asked).first().asDict() if asked else {}
    return [None if f in nominal else np.unique(np.array(found[f"q{f}"] or [], np.float64)) for f in range(len(names))]


def nominal_inputs(frame: DataFrame, column: str = "features") -> dict[int, int]:
    """Index and number of levels (one more for unseen ones) of the categories in a feature vector's metadata."""
    groups = frame.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"]: len(a.get("vals", [])) + 1 for a in groups.get("nominal", [])}


def fit(train: DataFrame, names: list[str], settings: Settings, label: str, weight: str, key: str) -> BoostedTreesModel:
    """Boosted trees on the vector column ``features`` of ``train``; logistic loss, labels 0 and 1, weights above 0.

    ``key`` is an id that row samples are drawn by and that orders the rows, so that a fit can be repeated.
    """
    spark = train.sparkSession
    nominal = nominal_inputs(train)
    x = vector_to_array("features")
    columns = [x.alias("x"), *[F.col(c).cast("double").alias(n) for c, n in ((label, "y"), (weight, "w"))]]
    rows = staged(train.select(*columns, F.xxhash64(key).alias("key")), "boosting-rows")
    cuts = learned_cuts(rows, F.col("x"), names, set(nominal))
    bins = max([BINS, *nominal.values()])
    category = np.array([f in nominal for f in range(len(names))])
    blocks = min(MOST_BLOCKS, -(-rows.count() // BLOCK_ROWS))

    def as_block(batches: Iterator[pa.RecordBatch]) -> dict:
        block = block_of(batches, cuts, bins)
        order = np.argsort(block["key"], kind="stable")
        return {k: v[order] for k, v in block.items()}

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = grown(InTask(as_block(batches)), category, bins, settings)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(found)])], names=["state"])

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(as_block(batches))], pa.binary())], names=["block"])

    if blocks <= 1:
        found = json.loads(staged(rows.repartition(1).mapInArrow(in_task, "state string"), "boosted").first()["state"])
    else:
        store = staged(rows.repartition(blocks, "key").mapInArrow(stored, "block binary"), "boosting-blocks")
        found = grown(ByJobs(store.rdd.map(lambda r: pickle.loads(r["block"]))), category, bins, settings)
    model = BoostedTreesModel()
    model.state = found | {
        "names": names, "bins": bins, "settings": asdict(settings),
        "cuts": [None if c is None else c.tolist() for c in cuts],
    }
    return model


class BoostedTreesModel(Model, MLWritable, MLReadable):
    """Adds ``risk`` and ``probability`` (of labels 0 and 1) to rows with a ``features`` vector; a stage of a stored pipeline."""

    def __init__(self):
        super().__init__()
        self.state: dict = {}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        state = self.state

        @F.pandas_udf("double")
        def risk(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            cuts = [None if c is None else np.array(c) for c in state["cuts"]]
            trees = [unpacked(t, state["bins"]) for t in state["trees"]]
            for x in batches:
                if len(x) == 0:
                    yield pd.Series([], dtype=float)
                    continue
                inputs, margin = binned(np.stack(x.to_numpy()), cuts, state["bins"]), np.full(len(x), state["base"])
                for tree in trees:
                    margin = margin + tree[4][places(tree, inputs)]
                yield pd.Series(sigmoid(margin))

        return dataset.withColumn("risk", risk(vector_to_array("features"))).withColumn(
            "probability", array_to_vector(F.array(1.0 - F.col("risk"), F.col("risk")))
        )

    @property
    def featureImportances(self):
        """Mean gain of the splits by each input over all trees, as shares of their sum."""
        gains, counts = np.zeros(len(self.state["names"])), np.zeros(len(self.state["names"]))
        for t in self.state["trees"]:
            for feature, left, gain in zip(t["feature"], t["left"], t["gain"], strict=True):
                if left >= 0:
                    gains[feature] += gain
                    counts[feature] += 1
        mean = np.divide(gains, counts, out=np.zeros_like(gains), where=counts > 0)
        return Vectors.dense(mean / mean.sum() if mean.sum() > 0 else mean)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


def unpacked(tree: dict, bins: int) -> tuple[np.ndarray, ...]:
    goes_left = np.zeros((len(tree["left"]), bins), bool)
    for node, marked in enumerate(tree["goes_left"]):
        goes_left[node, marked] = True
    return np.array(tree["feature"]), goes_left, np.array(tree["left"]), np.array(tree["right"]), np.array(tree["value"])


class _Writer(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        from pyspark.ml.util import DefaultParamsWriter

        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        rows = self.sparkSession.createDataFrame([(json.dumps(self.model.state),)], "state string")
        rows.coalesce(1).write.parquet(f"{path}/state")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        from pyspark.ml.util import DefaultParamsReader

        model = BoostedTreesModel()
        model._resetUid(DefaultParamsReader.loadMetadata(path, self.sparkSession)["uid"])
        model.state = json.loads(self.sparkSession.read.parquet(f"{path}/state").first()["state"])
        return model


def ordered_statistics(
    rows: DataFrame, columns: list[str], label: str, key: str, draw: Column, prior: float, role: str = "role"
) -> DataFrame:
    """``rows`` with ``<column>_stat``: a level's mean label, smoothed by one row of the ``prior``.

    A row of the train role sees the train rows before it in the order of ``draw`` and key, itself excluded; rows of
    other roles see all train rows. A level of any size is cut by the draw's leading digits: sums of the
    cuts before are added to running sums inside a cut, so no window holds a hot level. A null
    level is a level of its own, and one that training does not have gets the prior.
    """
    from pyspark.sql.window import Window

    drawn = rows.withColumn("_draw", draw).withColumn("_cut", F.floor(F.col("_draw") / (1 << 22)).cast("int"))
    train = F.col(role) == "train"
    for c in columns:
        counted = drawn.filter(train).groupBy(c, "_cut").agg(F.sum(label).alias("_s"), F.count(F.lit(1)).alias("_n"))
        # At most 1,024 cuts a level.
        before = Window.partitionBy(c).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counted.select(
            F.col(c).alias("_level"), F.col("_cut").alias("_of"),
            F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        )
        whole = counted.groupBy(F.col(c).alias("_level")).agg(F.sum("_s").alias("_all_s"), F.sum("_n").alias("_all_n"))
        inside = Window.partitionBy(c, "_cut", role).orderBy("_draw", key).rowsBetween(Window.unboundedPreceding, -1)
        running = drawn.withColumn("_rs", F.coalesce(F.sum(label).over(inside), F.lit(0))).withColumn(
            "_rn", F.coalesce(F.count(F.lit(1)).over(inside), F.lit(0))
        )
        joined = running.join(offsets, F.col(c).eqNullSafe(F.col("_level")) & (F.col("_cut") == F.col("_of")), "left").drop("_level", "_of")
        joined = joined.join(whole, F.col(c).eqNullSafe(F.col("_level")), "left").drop("_level")
        s = F.when(train, F.coalesce("_s0", F.lit(0)) + F.col("_rs")).otherwise(F.coalesce("_all_s", F.lit(0)))
        n = F.when(train, F.coalesce("_n0", F.lit(0)) + F.col("_rn")).otherwise(F.coalesce("_all_n", F.lit(0)))
        drawn = joined.withColumn(f"{c}_stat", (s + F.lit(prior)) / (n + 1)).drop(
            "_s0", "_n0", "_rs", "_rn", "_all_s", "_all_n"
        )
    return drawn.drop("_draw", "_cut")


# Sent to the executors by value, where the package is not installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__.partition(".")[0]])
