"""A random forest of unlimited depth, grown where the rows are.

Upper levels are grown over all partitions: tasks add up class counts per node, feature and bin, and only
the best split of each node reaches the driver. A node with at most ``task_rows`` rows is handed
over: one task gets its rows and grows the whole subtree on their exact values. So no process holds more than
``task_rows`` rows, the driver holds the upper levels only (about 2 n / ``task_rows`` nodes a tree), and depth
has no limit. A row's number of copies in a tree's bootstrap sample and a node's candidate
features are drawn from hashes, so a task that runs again draws the same.

A model is two tables; applying it sends trees to the tasks in portions of a bounded number of nodes.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, stage
from tidemark.sources.store import open_store

TREES = 100
SEED = 42
BINS = 64  # of a feature, while upper levels are grown
EDGE_ROWS = 20_000  # whose quantiles are the bins' edges
TASK_ROWS = 100_000  # rows of a subtree grown by one task
TREES_AT_ONCE = 10  # trees whose rows are shuffled at a time
CELLS = 4_000_000  # class counts a task adds up at a time
MODEL_NODES = 2_000_000  # nodes sent to the tasks at a time
MAX_CLASSES = 1_000
META = "deep_forest.json"  # its presence tells a saved model's kind
PROBABILITY, PREDICTION = "probability", "prediction"

_SUBTREE = (
    "tree int, node int, feature array<int>, threshold array<double>, left array<int>, "
    "right array<int>, shares array<double>"
)
# Bootstrap copies of a row: the chance of having at most 0, 1, 2, … (Poisson, mean 1).
_COPIES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def _mixed(*parts: np.ndarray | int) -> np.ndarray:
    """64 evenly spread bits for each combination of integers."""
    state = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for part in parts:
            state = state ^ np.asarray(part).astype(np.uint64)
            # Multipliers and shifts of a published 64-bit finaliser.
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                state = (state ^ (state >> np.uint64(shift))) * np.uint64(factor)
            state = state ^ (state >> np.uint64(31))
    return state


def copies(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bootstrap sample."""
    draw = (_mixed(rid, tree, seed) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.searchsorted(_COPIES, draw, side="right")


def candidates(n_features: int, tree: int, node: int, seed: int) -> np.ndarray:
    """All features in an order of their own for each node; the first few are tried first."""
    return np.argsort(_mixed(np.arange(n_features), tree, node, seed + 1), kind="stable")


# ---------------------------------------------------------------- trees


@dataclass
class Tree:
    """Nodes by number, the root 0. ``left`` is -1 - k at a leaf with shares ``k``."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    shares: list[list[float]] = field(default_factory=list)

    def add(self) -> int:
        for values, empty in ((self.feature, -1), (self.threshold, 0.0), (self.left, 0), (self.right, 0)):
            values.append(empty)
        return len(self.feature) - 1

    def split(self, node: int, feature: int, threshold: float) -> tuple[int, int]:
        self.feature[node], self.threshold[node] = int(feature), float(threshold)
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]

    def leaf(self, node: int, counts: np.ndarray) -> None:
        self.left[node] = -1 - len(self.shares)
        self.shares.append((counts / counts.sum()).tolist())

    def arrays(self) -> Flat:
        return Flat(
            np.array(self.feature, np.int32),
            np.array(self.threshold),
            np.array(self.left, np.int32),
            np.array(self.right, np.int32),
            np.array(self.shares),
        )


@dataclass
class Flat:
    """A tree as arrays, ready to be applied to many rows at once."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    shares: np.ndarray

    def ends(self, x: np.ndarray) -> np.ndarray:
        """The node each row ends in: one without a feature."""
        node = np.zeros(len(x), np.int32)
        moving = np.arange(len(x))
        while len(moving):
            moving = moving[self.feature[node[moving]] >= 0]
            at = node[moving]
            low = x[moving, self.feature[at]] <= self.threshold[at]
            node[moving] = np.where(low, self.left[at], self.right[at])
        return node


def _between(low: float, high: float) -> float:
    """A threshold that parts two neighbouring values."""
    middle = low + (high - low) / 2
    return middle if low <= middle < high else low


def best_cut(values: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int) -> tuple[float, float] | None:
    """``(score, threshold)`` of the best cut of a feature, None if it is constant.

    The score is the sum over both sides of the squared class weights divided by the
    side's weight: the higher, the lower the Gini impurity that is left.
    """
    order = np.argsort(values, kind="stable")
    sorted_values = values[order]
    if sorted_values[0] == sorted_values[-1]:
        return None
    weights = np.zeros((len(y), n_classes))
    weights[np.arange(len(y)), y[order]] = w[order]
    below = np.cumsum(weights, axis=0)
    above = below[-1] - below[:-1]
    below = below[:-1]
    score = (below**2).sum(1) / below.sum(1) + (above**2).sum(1) / np.maximum(above.sum(1), 1e-300)
    score[sorted_values[1:] == sorted_values[:-1]] = -1.0
    at = int(np.argmax(score))
    return float(score[at]), _between(sorted_values[at], sorted_values[at + 1])


def grow(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, n_classes: int, tried: int, tree: int, root: int, seed: int,
    max_depth: int | None = None,
) -> Tree:
    """A tree on the rows' exact values, grown until its leaves are pure or their rows equal.

    At each node ``tried`` features that are not constant are looked at.
    """
    made = Tree()
    work = [(made.add(), np.arange(len(y)), 0)]
    while work:
        node, rows, depth = work.pop()
        counts = np.bincount(y[rows], w[rows], n_classes)
        best, looked = None, 0
        if np.count_nonzero(counts) > 1 and depth != max_depth:
            for f in candidates(x.shape[1], tree, (root << 32) + node, seed):
                if looked == tried:
                    break
                cut = best_cut(x[rows, f], y[rows], w[rows], n_classes)
                if cut is not None:
                    looked += 1
                    if best is None or cut[0] > best[0]:
                        best = (*cut, f)
        if best is None:
            made.leaf(node, counts)
            continue
        low = x[rows, best[2]] <= best[1]
        left, right = made.split(node, best[2], best[1])
        work += [(left, rows[low], depth + 1), (right, rows[~low], depth + 1)]
    return made


# ---------------------------------------------------------------- fitting


@dataclass(frozen=True)
class _Task:
    """What tasks need to know of the training table."""

    n_features: int
    n_classes: int
    tried: int
    seed: int


def _numbers(batch: pa.RecordBatch, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n_features)
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), x


def _edges(rows: DataFrame, n: int, n_features: int) -> list[np.ndarray]:
    """Values of each feature between which upper levels may cut: about equally many rows apart.

    They are quantiles of about EDGE_ROWS rows chosen by hash, whatever the partitions; subtrees
    cut at exact values of all rows.
    """
    chosen = F.pmod(F.xxhash64("rid", "x"), F.lit(1 << 40)) < math.ceil(min(1.0, EDGE_ROWS / n) * (1 << 40))
    sample = np.array([r["x"] for r in rows.where(chosen).select("x").limit(4 * EDGE_ROWS).collect()])
    parts = [k / BINS for k in range(1, BINS)]
    return [np.unique(np.quantile(sample[:, f], parts, method="inverted_cdf")) for f in range(n_features)]


def _splits(
    rows: DataFrame, trees: list[Tree], wanted: list[tuple[int, int]], edges: list[np.ndarray], task: _Task
) -> list[Row]:
    """The best split of each wanted ``(tree, node)``: one row of class counts left and right of it."""
    flat = {t: trees[t].arrays() for t, _ in wanted}
    slots = {t: np.full(len(f.feature), -1) for t, f in flat.items()}
    features = np.array([candidates(task.n_features, t, n, task.seed)[: task.tried] for t, n in wanted])
    for k, (t, n) in enumerate(wanted):
        slots[t][n] = k
    shape = (len(wanted), task.tried, BINS, task.n_classes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(math.prod(shape))
        for batch in batches:
            rid, y, x = _numbers(batch, task.n_features)
            bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
            for t, tree in flat.items():
                w = copies(rid, t, task.seed)
                slot = slots[t][tree.ends(x)]
                held = np.flatnonzero((slot >= 0) & (w > 0))
                for j in range(task.tried):
                    bin_ = bins[held, features[slot[held], j]]
                    cell = ((slot[held] * task.tried + j) * BINS + bin_) * task.n_classes + y[held]
                    total += np.bincount(cell, w[held], len(total))
        table = total.reshape(len(wanted) * task.tried, -1)
        some = np.flatnonzero(table.sum(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(list(table[some]), pa.list_(pa.float64()))],
            ["place", "counts"],
        )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for place, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                below = np.cumsum(np.array(counts).reshape(BINS, task.n_classes), axis=0)
                all_, n_cuts = below[-1], len(edges[features.flat[place]])
                below = below[:n_cuts]
                above = all_ - below
                inside = (below.sum(1) > 0) & (above.sum(1) > 0)
                if inside.any():
                    score = (below**2).sum(1) / np.maximum(below.sum(1), 1e-300)
                    score += (above**2).sum(1) / np.maximum(above.sum(1), 1e-300)
                    at = int(np.argmax(np.where(inside, score, -1.0)))
                    row = (place // task.tried, place, float(score[at]), at, below[at].tolist(), above[at].tolist())
                    out.append(row)
            columns = list(zip(*out)) if out else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), *[pa.list_(pa.float64())] * 2]
            names = ["slot", "place", "score", "cut", "below", "above"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    counted = rows.mapInArrow(count, "place long, counts array<double>")
    summed = counted.groupBy("place").agg(
        vector_to_array(Summarizer.sum(array_to_vector(F.col("counts")))).alias("counts")
    )
    schema = "slot long, place long, score double, cut long, below array<double>, above array<double>"
    scored = summed.mapInArrow(choose, schema)
    top = F.max_by(F.struct("place", "cut", "below", "above"), F.struct("score", -F.col("place")))
    found = scored.groupBy("slot").agg(top.alias("best")).select("slot", "best.*").collect()
    return [(wanted[r["slot"]], int(features.flat[r["place"]]), r["cut"], r["below"], r["above"]) for r in found]


def _upper_levels(
    rows: DataFrame, n: int, trees: int, task: _Task, task_rows: int, max_depth: int | None
) -> tuple[list[Tree], list[dict[int, int]]]:
    """Trees whose unfinished nodes are small, and the depth of these by node."""
    made, handed = [Tree() for _ in range(trees)], [{} for _ in range(trees)]
    for tree in made:
        tree.add()
    if n <= task_rows or max_depth == 0:
        return made, [{0: 0} for _ in range(trees)]
    edges = _edges(rows, n, task.n_features)
    level = [(t, 0) for t in range(trees)]
    at_once = max(1, CELLS // (task.tried * BINS * task.n_classes))
    depth = 0
    while level:
        depth += 1
        following = []
        for low in range(0, len(level), at_once):
            part = level[low : low + at_once]
            found = _splits(rows, made, part, edges, task)
            # A node that no bin edge parts is finished by one task, whatever its size.
            for t, node in set(part) - {f[0] for f in found}:
                handed[t][node] = depth - 1
            for (t, node), feature, cut, below, above in found:
                sides = made[t].split(node, feature, edges[feature][cut])
                for child, counts in zip(sides, (np.array(below), np.array(above))):
                    if np.count_nonzero(counts) == 1 or depth == max_depth:
                        made[t].leaf(child, counts)
                    elif counts.sum() <= task_rows:
                        handed[t][child] = depth
                    else:
                        following.append((t, child))
        level = sorted(following)
    return made, handed


def _subtrees(
    rows: DataFrame, upper: list[Tree], handed: list[dict[int, int]], low: int, high: int, task: _Task,
    max_depth: int | None,
) -> DataFrame:
    """The subtrees of trees ``low`` to ``high`` - 1, each grown by one task. Equal rows are shuffled once."""
    flat = {t: upper[t].arrays() for t in range(low, high)}

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid, y, x = _numbers(batch, task.n_features)
            for t, tree in flat.items():
                w, node = copies(rid, t, task.seed), tree.ends(x)
                held = np.flatnonzero((w > 0) & (tree.left[node] == 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(held), t, np.int32)),
                        pa.array(node[held]),
                        pa.array(y[held]),
                        pa.array(w[held].astype(np.int64)),
                        batch.column(2).take(pa.array(held)),
                    ],
                    ["tree", "node", "y", "w", "x"],
                )

    def finish(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        t, node = table["tree"][0].as_py(), table["node"][0].as_py()
        x = table["x"].chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, task.n_features)
        left = None if max_depth is None else max_depth - handed[t][node]
        made = grow(
            x, table["y"].to_numpy(), table["w"].to_numpy(), task.n_classes, task.tried, t, node, task.seed, left
        )
        values = [t, node, made.feature, made.threshold, made.left, made.right, sum(made.shares, [])]
        names = [part.split()[0] for part in _SUBTREE.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64()),
                 pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.float64())]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds)], names)

    emitted = rows.mapInArrow(sent, "tree int, node int, y int, w long, x array<double>")
    together = emitted.groupBy("tree", "node", "y", "x").agg(F.sum("w").alias("w"))
    return together.groupBy("tree", "node").applyInArrow(finish, _SUBTREE)


def fit(
    df: DataFrame,
    label: str,
    columns: Sequence[str] | None = None,
    trees: int = TREES,
    seed: int = SEED,
    key: Sequence[str] = (),
    task_rows: int = TASK_ROWS,
    max_depth: int | None = None,
    features_per_split: int | None = None,
) -> DeepForest:
    """Fit a forest on numeric ``columns`` (default: all but the label) and a label 0, 1, 2, …

    ``features_per_split`` is the rounded root of their number by default. With a ``key`` the
    result does not hang on how the table is partitioned. Nulls are refused.
    """
    spark = df.sparkSession
    names = list(columns) if columns is not None else [c for c in df.columns if c not in (label, *key)]
    x = F.array(*[F.col(c).cast("double") for c in names])
    rid = F.xxhash64(*key) if key else F.monotonically_increasing_id()
    y = F.col(label).cast("double")
    rows = stage(df.select(rid.alias("rid"), y.cast("int").alias("y"), x.alias("x"), y.alias("told")), "forest-rows")
    odd = F.count_if(F.expr("exists(x, v -> v is null or isnan(v))") | (F.col("told") != F.col("y")))
    unlabelled = F.count_if(F.col("y").isNull() | (F.col("y") < 0))
    n, top, bad, without = rows.agg(F.count(F.lit(1)), F.max("y"), odd, unlabelled).first()
    if not n or bad or without:
        raise ValueError(f"of {n} rows {bad or without} lack a feature or have no class 0, 1, 2, …")
    if top >= MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    rows = rows.drop("told")
    tried = features_per_split or max(1, round(math.sqrt(len(names))))
    task = _Task(len(names), top + 1, min(tried, len(names)), seed)
    upper, handed = _upper_levels(rows, n, trees, task, task_rows, max_depth)
    path = scratch_path(spark, "deep-forest")
    for low in range(0, trees, TREES_AT_ONCE):
        high = min(low + TREES_AT_ONCE, trees)
        grown = _subtrees(rows, upper, handed, low, high, task, max_depth)
        grown.write.mode("append").parquet(f"{path}/subtrees")
    meta = {
        "columns": names,
        "n_classes": task.n_classes,
        "trees": [
            {"feature": t.feature, "threshold": t.threshold, "left": t.left, "right": t.right, "shares": t.shares}
            for t in upper
        ],
    }
    open_store(spark, path).put_if_absent(META, json.dumps(meta).encode())
    return DeepForest(spark, path)


# ---------------------------------------------------------------- applying


class DeepForest:
    """A fitted forest, kept as files."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        data = open_store(spark, path).read(META)
        if data is None:
            raise ValueError(f"no forest at {path}")
        meta = json.loads(data)
        self.columns: list[str] = meta["columns"]
        self.n_classes: int = meta["n_classes"]
        self.upper = [Tree(**t) for t in meta["trees"]]

    @staticmethod
    def is_at(spark: SparkSession, path: str) -> bool:
        return open_store(spark, path).read(META) is not None

    def write(self) -> DeepForest:
        """Itself, as ``model.write().save(path)`` is how models are saved."""
        return self

    def save(self, path: str) -> None:
        if DeepForest.is_at(self.spark, path):
            raise ValueError(f"there is a model at {path}")
        self.spark.read.schema(_SUBTREE).parquet(f"{self.path}/subtrees").write.parquet(f"{path}/subtrees")
        told = open_store(self.spark, self.path).read(META)
        open_store(self.spark, path).put_if_absent(META, told)

    def subtrees(self) -> DataFrame:
        return self.spark.read.schema(_SUBTREE).parquet(f"{self.path}/subtrees")

    def _portions(self) -> list[list[int]]:
        """Trees in groups of at most MODEL_NODES nodes, or of one tree."""
        sizes = dict(self.subtrees().groupBy("tree").agg(F.sum(F.size("feature"))).collect())
        groups, held = [[]], 0
        for t, tree in enumerate(self.upper):
            size = len(tree.feature) + sizes.get(t, 0)
            if groups[-1] and held + size > MODEL_NODES:
                groups.append([])
                held = 0
            groups[-1].append(t)
            held += size
        return groups

    def _whole(self, trees: list[int]) -> list[Flat]:
        """Trees with their subtrees put in the places they were handed over at."""
        found: dict[int, list[Row]] = {t: [] for t in trees}
        for row in self.subtrees().where(F.col("tree").isin(trees)).collect():  # MODEL_NODES nodes
            found[row["tree"]].append(row)
        return [self._joined(self.upper[t], found[t]) for t in trees]

    def _joined(self, upper: Tree, rows: list[Row]) -> Flat:
        parts = [upper.arrays()]
        shares = [np.array(upper.shares).reshape(-1, self.n_classes)]
        n_nodes, n_shares = len(upper.feature), len(upper.shares)
        head = parts[0]
        for row in rows:
            left, feature = np.array(row["left"], np.int32), np.array(row["feature"], np.int32)
            part = Flat(
                feature,
                np.array(row["threshold"]),
                np.where(feature >= 0, left + n_nodes, left - n_shares).astype(np.int32),
                np.array(row["right"], np.int32) + n_nodes,
                np.empty(0),
            )
            at = row["node"]  # takes the subtree's root
            head.feature[at], head.threshold[at] = part.feature[0], part.threshold[0]
            head.left[at], head.right[at] = part.left[0], part.right[0]
            parts.append(part)
            shares.append(np.array(row["shares"]).reshape(-1, self.n_classes))
            n_nodes, n_shares = n_nodes + len(feature), n_shares + len(shares[-1])
        names = ("feature", "threshold", "left", "right")
        return Flat(*(np.concatenate([getattr(p, n) for p in parts]) for n in names), np.concatenate(shares))

    def _voted(self, df: DataFrame, trees: list[int], before: bool) -> DataFrame:
        """``df`` with the sum of its leaves' class shares over ``trees``, added to what is there."""
        flat, columns, n_classes = self._whole(trees), self.columns, self.n_classes

        def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                index = batch.schema.get_field_index
                x = np.stack(
                    [batch.column(index(c)).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns], 1
                )
                if np.isnan(x).any():
                    raise ValueError("a row lacks a feature")
                total = np.zeros((len(x), n_classes))
                if before:
                    total += batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(total.shape)
                for tree in flat:
                    total += tree.shares[-1 - tree.left[tree.ends(x)]]
                kept = batch.columns[: batch.num_columns - before]
                votes = pa.array(list(total), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*kept, votes], [*batch.schema.names[: len(kept)], "votes"])

        fields = [f for f in df.schema.fields if not before or f.name != "votes"]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        return df.mapInArrow(vote, f"{schema}, votes array<double>")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (mean class shares of the leaves) and ``prediction`` (the first highest)."""
        portions = self._portions()
        voted = self._voted(df, portions[0], before=False)
        for trees in portions[1:]:
            voted = self._voted(stage(voted, "votes"), trees, before=True)
        n = len(self.upper)
        return voted.withColumn(PROBABILITY, F.transform("votes", lambda v: v / n)).withColumn(
            PREDICTION, (F.array_position("votes", F.array_max("votes")) - 1).cast("double")
        ).drop("votes")
