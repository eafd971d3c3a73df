"""Second-order histogram boosting.

Features are cut into at most ``bins`` bins once; rows are held in blocks, so that a task
handles arrays and no single rows.  A tree grows level by level, and each
level is one job: partitions add up gradient and row number per (node, feature, bin), the
sums of a feature meet in one place, which finds the feature's best split of every node.
Only these, one for each node and feature, reach the driver.  Jobs are many and short: they
run on an RDD of blocks, without a plan each, and the rows' new predictions are made in the
first job of the next tree.

* Gain of a split: [T(G_l)²/(H_l + l2) + T(G_r)²/(H_r + l2) - T(G)²/(H + l2)] x ``factor``,
  T shrinking by l1; it must exceed ``gamma``, and both sides need ``min_child_weight``
  hessian and ``min_child_rows`` rows.  A leaf is worth -T(G) / (H + l2) x learning rate.
  The loss is half the squared error: a row's gradient is prediction minus label, its
  hessian 1.
* ``max_leaves`` keeps the splits that best-first growth would make: those with the greatest
  least gain on their path.  A level expands only nodes that are still among them.
* ``subsample`` (drawn anew every ``subsample_every`` trees) and ``columns`` draw rows and
  features of a tree by a seeded hash of the row's number, so a rerun draws the same.
* ``symmetric`` trees make one split for all nodes of a level, the one with the greatest sum
  of gains, to which noise of ``random_strength`` x the gradients' spread, falling with the
  number of trees, is added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

# A row of the state is a block of at most an Arrow batch's rows: their numbers (int64), bins
# (uint8, one after the other), labels and predictions (float64).
_STATE = "row binary, bins binary, y binary, f binary"
_SPLIT = "node int, feature int, bin int, gain double, gl double, nl long, g double, n long"
#: Partitions whose sums meet in one task of a level's second stage (a feature's in one at most).
MEET = 8


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def bin_edges(df: DataFrame, x: str, p: int, bins: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last: quantiles of each feature, one job."""
    probs = F.array(*[F.lit((k + 1) / bins) for k in range(bins - 1)])
    value = [F.when(~F.isnan(F.col(x)[i]), F.col(x)[i]) for i in range(p)]
    row = df.agg(*[F.percentile_approx(v, probs, F.lit(20 * bins)).alias(f"q{i}") for i, v in enumerate(value)],
                 *[F.max(v).alias(f"m{i}") for i, v in enumerate(value)]).first()
    out = []
    for i in range(p):
        edges = np.unique(np.array(row[f"q{i}"] or [], float))
        out.append(edges[edges < row[f"m{i}"]] if len(edges) else edges)  # nothing lies above the greatest value
    return out


def _binned(batches: Iterator[pa.RecordBatch], edges: list[np.ndarray], start: float) -> Iterator[pa.RecordBatch]:
    p = len(edges)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.array(batch.column("x").flatten().to_numpy(zero_copy_only=False), np.float64).reshape(batch.num_rows, p)
        b = np.column_stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)]).astype(np.uint8)
        block = batch.column("row").to_numpy().astype(np.int64), b, batch.column("y").to_numpy().astype(np.float64), np.full(batch.num_rows, float(start))
        yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in block], names=["row", "bins", "y", "f"])


def _fewer(blocks: RDD) -> RDD:
    """Neighbouring partitions together, about four: blocks take a fifth of the rows' bytes, and are read one by one.
    Every core keeps an equal number."""
    cores = blocks.context.defaultParallelism
    return blocks.coalesce(cores * max(1, round(blocks.getNumPartitions() / (4 * cores))))


def _block(row) -> pa.RecordBatch:
    """A row of the state as a batch of its own."""
    return pa.RecordBatch.from_arrays([pa.array([bytes(v)], pa.binary()) for v in row], names=["row", "bins", "y", "f"])


def _joined(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    """One column of all blocks of a batch."""
    return np.frombuffer(b"".join(v.as_buffer() for v in batch.column(name)), kind)


def _matrix(batch: pa.RecordBatch, p: int) -> np.ndarray:
    return _joined(batch, "bins", np.uint8).reshape(-1, p)


def _squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's rows and the sum of their squared gradients."""
    n, total = 0, 0.0
    for batch in batches:
        e = _joined(batch, "f", np.float64) - _joined(batch, "y", np.float64)
        n, total = n + len(e), total + float(e @ e)
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total])], names=["n", "s"])


class Tree:
    """Nodes in the order they were made: feature (-1: leaf), bin, threshold, children, value."""

    def __init__(self):
        self.feature, self.bin, self.threshold, self.left, self.right, self.value, self.gain = [], [], [], [], [], [], []

    def add(self) -> int:
        for column, v in ((self.feature, -1), (self.bin, 0), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.value, 0.0), (self.gain, 0.0)):
            column.append(v)
        return len(self.feature) - 1

    def route(self, x: np.ndarray, cuts: list) -> np.ndarray:
        """The leaf of each row of x (bins with ``bin``, or values with ``threshold``)."""
        feature, left, right, cuts = (np.array(v) for v in (self.feature, self.left, self.right, cuts))
        at = np.zeros(len(x), np.int64)
        live = np.flatnonzero(feature[at] >= 0)
        while len(live):
            node = at[live]
            goes = x[live, feature[node]] <= cuts[node]
            at[live] = np.where(goes, left[node], right[node])
            live = live[feature[at[live]] >= 0]
        return at

    def cropped(self, keep: set[int]) -> "Tree":
        """The tree with only the splits in ``keep``."""
        out = Tree()
        stack = [(0, out.add())]
        while stack:
            old, new = stack.pop()
            out.value[new] = self.value[old]
            if old in keep:
                for c in ("feature", "bin", "threshold", "gain"):
                    getattr(out, c)[new] = getattr(self, c)[old]
                out.left[new], out.right[new] = out.add(), out.add()
                stack += [(self.left[old], out.left[new]), (self.right[old], out.right[new])]
        return out


def _drawn(row: np.ndarray, share: float, seed: int) -> np.ndarray:
    """A seeded choice of rows by their numbers."""
    if share >= 1:
        return np.ones(len(row), bool)
    h = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
    for shift, mul in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(mul)
    return (h ^ (h >> np.uint64(31))).astype(np.float64) / 2.0**64 < share


def _histograms(batches: Iterator[pa.RecordBatch], p: int, tree: Tree, open_nodes: list[int], features: list[int], width: int, share: float, seed: int) -> Iterator[pa.RecordBatch]:
    """This task's sums per (feature; node, bin), cells without rows left out."""
    place = np.full(len(tree.feature), -1)
    place[open_nodes] = np.arange(len(open_nodes))
    cells = len(open_nodes) * width
    g, n = np.zeros((len(features), cells)), np.zeros((len(features), cells), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch, p)
        at = place[tree.route(x, tree.bin)]
        own = np.flatnonzero((at >= 0) & _drawn(_joined(batch, "row", np.int64), share, seed))
        gradient = (_joined(batch, "f", np.float64) - _joined(batch, "y", np.float64))[own]
        first, by_feature = at[own] * width, np.ascontiguousarray(x[own].T)
        for k, f in enumerate(features):
            cell = first + by_feature[f]
            g[k] += np.bincount(cell, gradient, cells)
            n[k] += np.bincount(cell, minlength=cells)
    rows = [(f, np.flatnonzero(n[k])) for k, f in enumerate(features)]
    yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in rows], pa.int32()), pa.array([i.astype(np.int64).tobytes() for _, i in rows], pa.binary()),
                                      pa.array([g[k, i].tobytes() for k, (_, i) in enumerate(rows)], pa.binary()), pa.array([n[k, i].tobytes() for k, (_, i) in enumerate(rows)], pa.binary())],
                                     names=["feature", "cell", "g", "n"])


def _by_feature(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The sums of a partition as pairs keyed by feature."""
    for batch in batches:
        for f, *sums in zip(*(column.to_pylist() for column in batch.columns)):
            yield f, (part, *sums)


def _in_order(pairs: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """All pairs of a task as one batch; a feature's sums by their partition, so that reruns add up alike."""
    rows = sorted((f, *sums) for f, sums in pairs)
    columns = list(zip(*rows)) if rows else [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), *(pa.array(columns[i], pa.binary()) for i in (2, 3, 4))], names=["feature", "cell", "g", "n"])


def split_gains(g: np.ndarray, n: np.ndarray, how: dict) -> np.ndarray:
    """Gain of a split after each bin of (..., nodes, bins); -inf where it isn't allowed."""
    gl, nl = np.cumsum(g, -1), np.cumsum(n, -1)
    total, count = gl[..., -1:], nl[..., -1:]
    l1, l2 = how["l1"], how["l2"]

    def worth(a, h):
        return shrunk(a, l1) ** 2 / np.maximum(h + l2, 1e-12)
    gain = how["factor"] * (worth(gl, nl) + worth(total - gl, count - nl) - worth(total, count))
    least = max(how["min_child_rows"], how["min_child_weight"], 1)
    return np.where((nl >= least) & (count - nl >= least), gain, -np.inf)


def _best(batches: Iterator[pa.RecordBatch], open_nodes: list[int], width: int, how: dict, noise: tuple[float, int]) -> Iterator[pa.RecordBatch]:
    """Each feature's best split of every open node (symmetric: of all together)."""
    cells, sums = len(open_nodes) * width, {}
    for batch in batches:
        for f, cell, g, n in zip(*(batch.column(c).to_pylist() for c in ("feature", "cell", "g", "n"))):
            at = np.frombuffer(cell, np.int64)
            a, b = sums.setdefault(f, (np.zeros(cells), np.zeros(cells, np.int64)))
            a[at] += np.frombuffer(g, np.float64)
            b[at] += np.frombuffer(n, np.int64)
    out = []
    for f, (g, n) in sums.items():
        g, n = g.reshape(-1, width), n.reshape(-1, width)
        gain = split_gains(g, n, how)
        gl, nl = np.cumsum(g, 1), np.cumsum(n, 1)
        if how["symmetric"]:
            score = np.where(np.isfinite(gain), gain, 0.0).sum(0)
            score = score + noise[0] * np.random.default_rng([noise[1], f]).normal(size=width)
            bins = np.full(len(gain), int(np.argmax(np.where(np.isfinite(gain).any(0), score, -np.inf))))
            shown = np.full(len(gain), score[bins[0]] if np.isfinite(gain[:, bins[0]]).any() else -np.inf)
        else:
            bins = np.argmax(gain, 1)
            shown = gain[np.arange(len(gain)), bins]
        for k, b in enumerate(bins):
            out.append((open_nodes[k], f, int(b), float(shown[k]), float(gl[k, b]), int(nl[k, b]), float(gl[k, -1]), int(nl[k, -1])))
    cols = list(zip(*out)) if out else [[]] * 8
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in _SPLIT.split(", ")])


def _updated(batches: Iterator[pa.RecordBatch], p: int, tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        f = _joined(batch, "f", np.float64) + np.array(tree.value)[tree.route(_matrix(batch, p), tree.bin)]
        ends = np.cumsum([len(v.as_buffer()) // 8 for v in batch.column("f")])
        blocks = [part.tobytes() for part in np.split(f, ends[:-1])]
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("bins"), batch.column("y"), pa.array(blocks, pa.binary())], names=["row", "bins", "y", "f"])


class HistBooster(Estimator):
    """Boosted trees as the module's docstring describes them.  The fitted table is read three
    times: a long plan should be persisted."""

    def __init__(self, rounds: int = 100, learning_rate: float = 0.1, max_depth: int = 6, max_leaves: int | None = None, l1: float = 0.0, l2: float = 0.0, gamma: float = 0.0,
                 factor: float = 1.0, min_child_weight: float = 0.0, min_child_rows: int = 1, bins: int = 255, subsample: float = 1.0, subsample_every: int = 1,
                 columns: float = 1.0, symmetric: bool = False, random_strength: float = 0.0, featuresCol: str = "features", labelCol: str = "SP", seed: int = 120, checkpoint_every: int = 10):
        super().__init__()
        if not 2 <= bins <= 256:
            raise ValueError("bins: 2 to 256")
        self.hp = {k: v for k, v in locals().items() if k not in ("self", "__class__", "featuresCol", "labelCol")}
        self.featuresCol, self.labelCol = featuresCol, labelCol

    def _fit(self, df: DataFrame) -> "HistBoosterModel":
        hp = self.hp
        x = vector_to_array(F.col(self.featuresCol)) if isinstance(df.schema[self.featuresCol].dataType, type(_vector())) else F.col(self.featuresCol)
        rows = df.where(F.col(self.labelCol).isNotNull()).select(x.alias("x"), F.col(self.labelCol).cast("double").alias("y"), F.monotonically_increasing_id().alias("row"))
        first = rows.agg(F.max(F.size("x")).alias("p"), F.avg("y").alias("mean"), F.count("*").alias("n")).first()
        p, start = first["p"] or 0, first["mean"] if first["mean"] is not None else 0.0
        if not p:
            return HistBoosterModel(start, [], self.featuresCol)
        edges = bin_edges(rows, "x", p, hp["bins"])
        width = max(len(e) for e in edges) + 1
        ensure_checkpoint_dir(df.sparkSession)
        state = _fewer(rows.mapInArrow(lambda b: _binned(b, edges, start), _STATE).rdd).map(_block).persist(StorageLevel.MEMORY_AND_DISK)
        state.checkpoint()  # fixes the rows' numbers, in a fifth of the features' bytes
        held, trees = None, []
        for k in range(hp["rounds"]):
            tree = self._grown(state, p, edges, width, k, first["n"])
            if held is not None:  # the tree's first job has read, and so filled, the table after it
                held.unpersist()
            if tree is None:
                break
            trees.append(tree)
            if k + 1 == hp["rounds"]:
                break
            held, state = state, state.mapPartitions(lambda b, t=tree: _updated(b, p, t)).persist(StorageLevel.MEMORY_AND_DISK)
            if (k + 1) % hp["checkpoint_every"] == 0:
                state.checkpoint()
        state.unpersist()
        return HistBoosterModel(start, trees, self.featuresCol)

    def _grown(self, state: RDD, p: int, edges: list, width: int, k: int, n: int) -> Tree | None:
        hp = self.hp
        rng = np.random.default_rng([hp["seed"], k])
        features = sorted(rng.permutation(p)[: max(1, round(hp["columns"] * p))].tolist())
        draw = hp["seed"] * 1_000_003 + k // hp["subsample_every"]
        tree = Tree()
        root = tree.add()
        open_nodes, path, above = [root], {}, {}  # path: least gain on the way to a split
        spread = 0.0
        for depth in range(hp["max_depth"]):
            if hp["symmetric"] and hp["random_strength"] and not depth:
                sums = [b.to_pylist()[0] for b in state.mapPartitions(_squares).collect()]
                spread = float(np.sqrt(sum(r["s"] for r in sums) / max(1, sum(r["n"] for r in sums))))
            noise = (hp["random_strength"] * spread / (k + 1.0), int(rng.integers(1 << 31)))
            meet = min(len(features), -(-state.getNumPartitions() // MEET))
            sums = state.mapPartitionsWithIndex(lambda i, b: _by_feature(i, _histograms(b, p, tree, open_nodes, features, width, hp["subsample"], draw)))
            found = sums.partitionBy(meet).mapPartitions(lambda pairs: _best(_in_order(pairs), open_nodes, width, hp, noise)).collect()
            splits = pa.Table.from_batches(found)  # a row per open node and feature
            col = {n: splits.column(n).to_numpy() for n in splits.column_names}
            order = np.lexsort((col["bin"], col["feature"], -col["gain"], *(() if hp["symmetric"] else (col["node"],))))
            if hp["symmetric"] and len(order):  # the same split for all: the best by its sum
                top = order[0]
                order = np.flatnonzero((col["feature"] == col["feature"][top]) & (col["bin"] == col["bin"][top]))
            rows: dict = {}
            for i in order:
                rows.setdefault(int(col["node"][i]), {n: v[i].item() for n, v in col.items()})
            made = []
            for node in open_nodes:
                r = rows.get(node)
                if r is None or not r["n"]:
                    continue
                if not depth:
                    tree.value[node] = self._value(r["g"], r["n"])
                if not np.isfinite(r["gain"]) or (r["gain"] <= hp["gamma"] if not hp["symmetric"] else r["gain"] <= 0):
                    continue
                tree.feature[node], tree.bin[node], tree.gain[node] = r["feature"], r["bin"], r["gain"]
                tree.threshold[node] = float(edges[r["feature"]][r["bin"]]) if r["bin"] < len(edges[r["feature"]]) else np.inf
                tree.left[node], tree.right[node] = tree.add(), tree.add()
                tree.value[tree.left[node]] = self._value(r["gl"], r["nl"])
                tree.value[tree.right[node]] = self._value(r["g"] - r["gl"], r["n"] - r["nl"])
                above[tree.left[node]] = above[tree.right[node]] = node
                path[node] = min(r["gain"], path.get(above.get(node), np.inf))
                made.append(node)
            if hp["max_leaves"]:
                ranked = sorted(path, key=lambda s: (-path[s], s))
                kept = set(ranked[: hp["max_leaves"] - 1])
                made = [s for s in made if s in kept]
            open_nodes = [c for s in made for c in (tree.left[s], tree.right[s])]
            if not open_nodes:
                break
        if tree.feature[root] < 0:
            return None
        if hp["max_leaves"]:
            tree = tree.cropped(set(sorted(path, key=lambda s: (-path[s], s))[: hp["max_leaves"] - 1]))
        return tree

    def _value(self, g: float, n: float) -> float:
        return float(-shrunk(g, self.hp["l1"]) / max(n + self.hp["l2"], 1e-12) * self.hp["learning_rate"])


def _vector():
    from pyspark.ml.linalg import VectorUDT
    return VectorUDT()


class HistBoosterModel(Model):
    """start + the trees' leaf values, per Arrow batch; missing values go right."""

    def __init__(self, start: float, trees: list[Tree], featuresCol: str = "features", predictionCol: str = "prediction"):
        super().__init__()
        self.start, self.trees, self.featuresCol, self.predictionCol = start, trees, featuresCol, predictionCol

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), float(self.start))
        for t in self.trees:
            out += np.array(t.value)[t.route(x, t.threshold)]
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        model = self

        @F.pandas_udf(T.DoubleType())
        def scored(x: pd.Series) -> pd.Series:
            return pd.Series(model.predict(np.vstack(x.to_numpy())) if len(x) else np.zeros(0))

        col = F.col(self.featuresCol)
        x = vector_to_array(col) if isinstance(df.schema[self.featuresCol].dataType, type(_vector())) else col
        return df.withColumn(self.predictionCol, scored(x))

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession
        from ..session import write_json
        write_json(SparkSession.active(), path, {"start": self.start, "featuresCol": self.featuresCol, "trees": [vars(t) for t in self.trees]})

    @classmethod
    def load(cls, path: str) -> "HistBoosterModel":
        from pyspark.sql import SparkSession
        from ..session import read_json
        meta = read_json(SparkSession.active(), path)
        trees = []
        for columns in meta["trees"]:
            t = Tree()
            t.__dict__.update(columns)
            trees.append(t)
        return cls(meta["start"], trees, meta["featuresCol"])
