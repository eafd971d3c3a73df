"""Epsilon grid order join of embeddings.

Vectors of one label link when their cosine is at least ``threshold``; for vectors of
length 1 that is a distance of at most eps = sqrt(2 - 2 threshold).

1. Vectors alike in label and components are one node with a weight. Nodes of each
   dimension are joined on their own (steps 2 to 4), as vectors of two have no cosine.
2. Nodes are projected on the leading principal directions (from the second moments
   of all of them) and sorted in epsilon grid order: by label, then by the grid cells,
   eps wide, of the leading projections.
3. The sequence is cut into blocks; each block keeps the bounds of its projections.
   Blocks meet when their leading cells are neighbours and the boxes of their bounds
   are at most eps apart; a projection never lengthens a distance, so no other
   blocks hold a link.
4. A pair of blocks is joined by halving both intervals recursively, skipping halves
   whose boxes are farther apart than eps, down to small intervals whose cosines are
   multiplied out in double precision.

A block pair returns the links of each node as counts, and the links themselves only
as a forest, so a dense group costs no row per pair.  Components follow from the
forests.

Labels of any type are compared as text. Defined cases: vectors that are null, zero or
that hold null or non-finite components, and rows with a null label or
vec_id, link with nothing (n_links 0, component_id = vec_id); rows that repeat a
vec_id, with other components or another label, are nodes of their own with that id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, cut, partitions, sized_join, written
from .jaccard_join import EDGES, _forest

THRESHOLD = 0.98
DIRECTIONS = 8
BLOCK = 1024
SMALL = 128
#: Room for rounding when boxes are compared; the cosines themselves are compared exactly.
ROOM = 1e-6


def _moments(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Sums of the outer products of this task's unit vectors."""
    total = np.zeros((dim, dim))
    for batch in batches:
        x = _unit(batch.column("vector").to_pylist(), dim)
        total += x.T @ x
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["k", "v"])


def _raw(vectors: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(-1, dim)


def _unit(vectors: list[bytes], dim: int) -> np.ndarray:
    x = _raw(vectors, dim)
    x = x / np.abs(x).max(1, keepdims=True) if len(x) else x  # so that no square under- or overflows
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _projected(batches: Iterator[pa.RecordBatch], dim: int, axes: np.ndarray, eps: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        z = _unit(batch.column("vector").to_pylist(), dim) @ axes
        cells = np.floor(z / eps).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(cells), pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"])


def _blocks(batches: Iterator[pa.RecordBatch], dim: int, axes: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of one label, ``size`` at most, as one row each."""
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    label, ids, weights, vectors = None, [], [], []

    def out():
        nonlocal number
        z = _unit(vectors, dim) @ axes
        row = [[(part << 32) + number], [label], [ids], [weights], [b"".join(vectors)], [z.min(0).tolist()], [z.max(0).tolist()]]
        number += 1
        return pa.RecordBatch.from_arrays([pa.array(row[0]), pa.array(row[1], pa.string()), pa.array(row[2], pa.list_(pa.int64())), pa.array(row[3], pa.list_(pa.int64())),
                                           pa.array(row[4], pa.binary()), pa.array(row[5], pa.list_(pa.float64())), pa.array(row[6], pa.list_(pa.float64()))],
                                          names=["block", "label", "ids", "weights", "vectors", "low", "high"])

    for batch in batches:
        for g, i, w, v in zip(*(batch.column(c).to_pylist() for c in ("label", "node", "weight", "vector"))):
            if ids and (g != label or len(ids) == size):
                yield out()
                ids, weights, vectors = [], [], []
            label = g
            ids.append(i)
            weights.append(w)
            vectors.append(v)
    if ids:
        yield out()


def interval_join(a: np.ndarray, b: np.ndarray, za: np.ndarray, zb: np.ndarray, eps: float, threshold: float, same: bool, small: int = SMALL) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked rows of two sequences, i < j if they are the same one."""
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def join(i0, i1, j0, j1):
        gap = np.maximum(0, np.maximum(za[i0:i1].min(0) - zb[j0:j1].max(0), zb[j0:j1].min(0) - za[i0:i1].max(0)))
        if (gap * gap).sum() > (eps + ROOM) ** 2:
            return
        if i1 - i0 <= small and j1 - j0 <= small:
            i, j = np.nonzero(a[i0:i1] @ b[j0:j1].T >= threshold)
            i, j = i + i0, j + j0
            if same:
                i, j = i[i < j], j[i < j]
            found.append((i, j))
            return
        halves_a = [(i0, i1)] if i1 - i0 <= small else [(i0, (i0 + i1) // 2), ((i0 + i1) // 2, i1)]
        halves_b = [(j0, j1)] if j1 - j0 <= small else [(j0, (j0 + j1) // 2), ((j0 + j1) // 2, j1)]
        for x in halves_a:
            for y in halves_b:
                if not same or x[0] < y[1]:
                    join(*x, *y)

    if len(a) and len(b):
        join(0, len(a), 0, len(b))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _pair_links(dim: int, axes: np.ndarray, eps: float, threshold: float):
    def links(pair: pd.DataFrame) -> pd.DataFrame:
        pair = pair.sort_values("block")
        same = pair["one"].iat[0] == pair["two"].iat[0]
        one, two = pair.iloc[0], pair.iloc[-1]
        x, y = (_unit([r["vectors"]], dim) for r in (one, two))
        i, j = interval_join(x, y, x @ axes, y @ axes, eps, threshold, same)
        ids = [np.asarray(r["ids"], np.int64) for r in (one, two)]
        w = [np.asarray(r["weights"], np.int64) for r in (one, two)]
        rows = [_forest(i, j, *ids).assign(kind=0)]
        if same:
            n = np.bincount(i, weights=w[0][j], minlength=len(x)) + np.bincount(j, weights=w[0][i], minlength=len(x))
            rows.append(pd.DataFrame({"a": ids[0], "b": n.astype(np.int64), "kind": 1}))
        else:
            for k, (own, far) in enumerate(((i, j), (j, i))):
                n = np.bincount(own, weights=w[1 - k][far], minlength=len(ids[k]))
                rows.append(pd.DataFrame({"a": ids[k], "b": n.astype(np.int64), "kind": 1}))
        out = pd.concat(rows)
        return out[(out["kind"] == 0) | (out["b"] > 0)].astype("int64")
    return links


def principal(nodes: DataFrame, dim: int, directions: int) -> np.ndarray:
    """Leading principal directions (columns); dim x dim sums reach the driver."""
    sums = nodes.select("vector").mapInArrow(lambda b: _moments(b, dim), "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").toPandas()
    moments = sums["v"].to_numpy().reshape(dim, dim) if len(sums) else np.eye(dim)
    _, vectors = np.linalg.eigh(moments)
    return np.ascontiguousarray(vectors[:, ::-1][:, :directions])


def _joined(nodes: DataFrame, dim: int, threshold: float, block: int, directions: int) -> DataFrame:
    """Rows (a, b, kind): links of a forest (kind 0), numbers b of links of a (kind 1)."""
    spark = nodes.sparkSession
    eps = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    axes = principal(nodes, dim, min(directions, dim))
    keys = [F.col("cells")[k] for k in range(axes.shape[1])]
    placed = nodes.select("node", "label", "weight", "vector").mapInArrow(lambda b: _projected(b, dim, axes, eps), "node long, label string, weight long, vector binary, cells array<int>")
    order = ["label", *keys, "node"]
    placed = written(placed, "projected").repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    blocks = written(placed.select("label", "node", "weight", "vector").mapInArrow(lambda b: _blocks(b, dim, axes, block), "block long, label string, ids array<long>, weights array<long>, vectors binary, low array<double>, high array<double>"), "blocks")
    # pairs of blocks, from their bounds alone: one block stands in the cells of its
    # first direction that it covers, the other also in those beside them
    def cells(lo, hi):
        return F.sequence(F.floor(F.col("low")[0] / eps).cast("int") - lo, F.floor(F.col("high")[0] / eps).cast("int") + hi)
    one = blocks.select("label", F.col("block").alias("one"), F.col("low").alias("l1"), F.col("high").alias("h1"), F.explode(cells(0, 0)).alias("cell"))
    two = blocks.select("label", F.col("block").alias("two"), F.col("low").alias("l2"), F.col("high").alias("h2"), F.explode(cells(1, 1)).alias("cell"))
    gaps = F.zip_with(F.zip_with("l1", "h2", lambda x, y: x - y), F.zip_with("l2", "h1", lambda x, y: x - y), lambda x, y: F.greatest(F.lit(0.0), x, y))
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    pairs = one.join(two, ["label", "cell"]).where((F.col("one") <= F.col("two")) & (apart <= (eps + ROOM) ** 2)).select("one", "two").distinct()
    pairs = cut(pairs)
    sides = pairs.select("one", "two", F.explode(F.array_distinct(F.array("one", "two"))).alias("block"))
    both = sides.join(blocks.select("block", "ids", "weights", "vectors"), "block")
    return cut(both.groupBy("one", "two").applyInPandas(_pair_links(dim, axes, eps, threshold), "a long, b long, kind long"))


def _every_dimension(nodes: DataFrame, threshold: float, block: int, directions: int) -> DataFrame:
    """``_joined`` for the nodes of each dimension; the list of dimensions, a few numbers,
    reaches the driver."""
    size = (F.octet_length("vector") / 8).cast("int")
    dims = sorted(r["d"] for r in nodes.select(size.alias("d")).distinct().collect())
    return reduce(DataFrame.unionByName, [_joined(nodes.where(size == d), d, threshold, block, directions) for d in dims or [1]])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, directions: int = DIRECTIONS) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links,
    component_id, kept."""
    spark = vectors.sparkSession
    x = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists("e", lambda v: v != 0)
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("e") > 0) & finite, F.lit(False))
    packed = x.withColumn("good", good).mapInArrow(_pack, "vec_id long, label string, key binary, vector binary")
    packed = written(packed, "vectors")
    whole = packed.where("key is not null")
    nodes = cut(whole.groupBy("label", "key").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"), F.first("vector").alias("vector")))
    # a vec_id that repeats with other components gets nodes of its own
    twice = Window.partitionBy("node").orderBy("key", "label")
    names = cut(nodes.select("label", "key", "node", "weight", F.row_number().over(twice).alias("k")))
    clash = names.where("k > 1")
    rows = _every_dimension(_numbered(nodes, clash), threshold, block, directions)
    counts = rows.where("kind = 1").groupBy(F.col("a").alias("num")).agg(F.sum("b").alias("links"))
    label_of = components(cut(rows.where("kind = 0").select("a", "b")))
    numbered = _numbered(nodes, clash).select("label", "key", "weight", F.col("node").alias("num"))
    state = numbered.join(counts, "num", "left").join(label_of.withColumnRenamed("node", "num"), "num", "left")
    state = state.select("label", "key", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "num").alias("group"))
    state = cut(state)
    first = whole.join(state.select("label", "key", "group"), ["label", "key"]).groupBy("group").agg(F.min("vec_id").alias("low"))
    state = state.join(first, "group").select("label", "key", "n_links", "low")
    out = packed.join(state, ["label", "key"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("low", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _numbered(nodes: DataFrame, clash: DataFrame) -> DataFrame:
    """Nodes under distinct numbers: the smallest vec_id, or for the later ones of a
    repeated vec_id a negative hash of the content."""
    other = clash.select("label", "key", F.lit(True).alias("again"))
    joined = nodes.join(other, ["label", "key"], "left")
    number = F.when(F.col("again"), -F.abs(F.xxhash64("label", "key") / 2).cast("long") - 1).otherwise(F.col("node"))
    return joined.select(number.alias("node"), "label", "weight", "vector", "key").select("node", "label", "weight", "vector", "key")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Components as bytes (their number is the dimension) and a digest of them."""
    for batch in batches:
        vectors = [(np.array(e, np.float64) + 0.0).tobytes() if g else None for e, g in zip(batch.column("e").to_pylist(), batch.column("good").to_pylist())]
        keys = [hashlib.blake2b(v, digest_size=16).digest() if v else None for v in vectors]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["vec_id", "label", "key", "vector"])


def op7_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = """
WITH RECURSIVE x AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM x a JOIN x b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT low.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, low.vec_id = component_id AS kept
FROM low LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = low.vec_id
"""
