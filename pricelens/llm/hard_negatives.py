"""Hard negatives by an inverted multi-index.

For every anchor: its positives (the best rows of its own label), and for each positive
the best rows of other labels whose score lies in a window around the positive's.  Scores
are integer inner products; higher ones are first, ties by smaller vec_id.

1. Two codebooks, one for each half of the components, are fitted by k-means on at most
   ``SAMPLE`` rows (those of the least hash).  A row's cell is its nearest codeword in each
   half; a cell keeps the radius of its rows in each half.
2. Rows are sorted by cell and cut into shards of ``SHARD`` rows, so a shard holds
   neighbouring cells; a cell or a vector that a great many rows share spans shards.
3. In a shard, the codewords of each half are ordered by the bound of the half score, that
   of the codeword plus |half of the anchor| times the radius.  A heap over both orders
   (the multi-sequence algorithm) visits cells by falling sum of the bounds.  A cell whose
   own bounds fall outside all open windows is passed over.  The visit stops when the next
   sum is below what each window still takes, its floor or its k-th score: no row of a
   cell not visited can belong to the result.
4. Each anchor is first searched in its own shard.  The k-th scores found there go along
   with it to the other shards, which return only rows that come before them.  The results of all
   shards merge into the exact best ones.

Anchors meet shards in groups of at most ``GROUP``, so neither side of a task grows with
the table.

Defined cases: rows whose vec_id, label or vector is null, that have no components, or
whose components are null, not finite, or not below 2**22 in size when scaled (their
scores might not fit 64 bits) take no part; rows of different dimensions have no score and
never meet; a repeated vec_id is a row of its own each time, and as an anchor has a result
each time; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_table, partitions, written

#: Codewords per half, rows that they are fitted on, rounds of k-means.
CODEWORDS, SAMPLE, ROUNDS = 32, 8192, 8
#: Rows of a shard, anchors that meet it at once, rows scored together.
SHARD, GROUP, SCORED = 1 << 15, 1 << 13, 512
LARGEST = 1 << 22

ROWS = "num long, vec_id long, label long, dim int, vector binary"
SHARDS = "shard long, dim int, num binary, vec_id binary, label binary, cell binary, vectors binary"
FOUND = "num long, window int, score long, vec_id long, label long"


def _packed(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """Whole components as int32, null where a row takes no part."""
    for batch in batches:
        vectors = []
        for e in batch.column("e").to_pylist():
            v = None if not e or None in e else np.floor(np.array(e, np.float64) * scale)
            vectors.append(v.astype(np.int32).tobytes() if v is not None and np.isfinite(v).all() and np.abs(v).max() < LARGEST else None)
        yield pa.RecordBatch.from_arrays([batch.column("num"), batch.column("vec_id"), batch.column("label"),
                                          pa.array([len(v) // 4 if v else None for v in vectors], pa.int32()), pa.array(vectors, pa.binary())],
                                         names=["num", "vec_id", "label", "dim", "vector"])


def _matrix(raw: list[bytes] | bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw if isinstance(raw, bytes) else b"".join(raw), np.int32).reshape(-1, dim)


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 11) -> np.ndarray:
    """At most k codewords of the rows x."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    code = distinct[rng.permutation(len(distinct))[:k]].astype(np.float64)
    for _ in range(rounds):
        near = nearest(x, code)
        n = np.bincount(near, minlength=len(code))
        total = np.zeros_like(code)
        np.add.at(total, near, x)
        code[n > 0] = total[n > 0] / n[n > 0, None]
    return code


def nearest(x: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.argmin((code * code).sum(1) - 2 * (x @ code.T), axis=1) if len(x) else np.zeros(0, np.int64)


def codebooks(rows: DataFrame, codewords: int, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Two codebooks for each dimension; ``sample`` rows of each dimension at most, and
    dimensions are few.  Without a codebook one codeword at the origin stands for all."""
    dims = [r["dim"] for r in rows.select("dim").distinct().collect()]
    out = {}
    for dim in dims:
        some = rows.where(F.col("dim") == dim).orderBy(F.xxhash64("vector", "vec_id"), "num").limit(sample).select("vector").collect()
        x = _matrix([bytes(r["vector"]) for r in some], dim).astype(np.float64)
        half = dim // 2
        out[dim] = (k_means(x[:, :half], codewords), k_means(x[:, half:], codewords))
    return out


def _celled(batches: Iterator[pa.RecordBatch], books: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        cell = np.zeros(len(dims), np.int64)
        raw = batch.column("vector").to_pylist()
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            x = _matrix([raw[i] for i in own], int(dim)).astype(np.float64)
            one, two = books[int(dim)]
            cell[own] = nearest(x[:, : dim // 2], one) * len(two) + nearest(x[:, dim // 2 :], two)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])


def _sharded(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by dimension and cell as shards of one dimension each."""
    from pyspark import TaskContext

    part, number, held, count = TaskContext.get().partitionId(), 0, [], 0

    def out() -> pa.RecordBatch:
        nonlocal number, held, count
        t = pa.Table.from_batches(held)
        row = [(part << 32) + number, t.column("dim")[0].as_py(), *(t.column(c).to_numpy().astype(np.int64).tobytes() for c in ("num", "vec_id", "label", "cell")), b"".join(t.column("vector").to_pylist())]
        number, held, count = number + 1, [], 0
        return pa.RecordBatch.from_arrays([pa.array([row[0]]), pa.array([row[1]], pa.int32()), *[pa.array([v], pa.binary()) for v in row[2:]]],
                                          names=["shard", "dim", "num", "vec_id", "label", "cell", "vectors"])

    for batch in batches:
        dims = batch.column("dim").to_numpy()
        edges = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1), len(dims)]
        for i, j in zip(edges, edges[1:]):
            while i < j:
                if held and held[0].column("dim")[0].as_py() != dims[i]:
                    yield out()
                take = min(j - i, size - count)
                held.append(batch.slice(i, take))
                i, count = i + take, count + take
                if count == size:
                    yield out()
    if held:
        yield out()


class Shard:
    """The multi-index of some rows."""

    def __init__(self, row: dict, books: dict):
        dim = row["dim"]
        self.half = dim // 2
        self.code = books[dim]
        self.num, self.vec_id, self.label, cell = (np.frombuffer(row[c], np.int64) for c in ("num", "vec_id", "label", "cell"))
        order = np.lexsort((self.vec_id, cell))
        self.num, self.vec_id, self.label = self.num[order], self.vec_id[order], self.label[order]
        self.x = _matrix(row["vectors"], dim)[order].astype(np.int64)
        self.exact = float(np.abs(self.x).max(initial=0)) * LARGEST * dim < 2**53
        self.float = self.x.astype(np.float64)
        cell = cell[order]
        self.wide = len(self.code[1])
        self.at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        self.cells, self.end = cell[self.at], np.append(self.at[1:], len(cell))
        self.place = {int(c): k for k, c in enumerate(self.cells)}
        halves = self.float[:, : self.half], self.float[:, self.half :]
        words = cell // self.wide, cell % self.wide
        # radii of each cell, and of each codeword over its cells
        self.radius, self.widest = [], []
        for x, c, w in zip(halves, self.code, words):
            d = np.sqrt(((x - c[w]) ** 2).sum(1))
            self.radius.append(np.maximum.reduceat(d, self.at))
            widest = np.full(len(c), -np.inf)
            np.maximum.at(widest, w, d)
            self.widest.append(widest)

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        # whole numbers below 2**53 are exact in double precision
        if self.exact and np.abs(q).max(initial=0) < LARGEST:
            return (self.float[rows] @ q.astype(np.float64)).astype(np.int64)
        return self.x[rows] @ q

    def search(self, num: int, label: int, q: np.ndarray, low: np.ndarray, high: np.ndarray, least: np.ndarray, least_id: np.ndarray, same: bool, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window the scores and rows of the first k with low <= score <= high
        and at or before (least, least_id), of the anchor's label or of the others."""
        halves = q[: self.half].astype(np.float64), q[self.half :].astype(np.float64)
        norms = [np.sqrt((h * h).sum()) for h in halves]
        middle = [c @ h for c, h in zip(self.code, halves)]
        bound = [m + n * r for m, n, r in zip(middle, norms, self.widest)]
        order = [np.argsort(-b, kind="stable") for b in bound]
        order = [o[np.isfinite(b[o])] for o, b in zip(order, bound)]  # codewords without rows
        room = 1e-9 * (1 + sum(np.abs(b[np.isfinite(b)]).max(initial=0) for b in bound))
        floor = np.maximum(low, least)
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        if not len(order[0]) or not len(order[1]):
            return found
        heap, seen = [(-(bound[0][order[0][0]] + bound[1][order[1][0]]), 0, 0)], {(0, 0)}
        waiting, n = [], 0

        def score():
            nonlocal waiting, n
            rows = np.concatenate([np.arange(self.at[c], self.end[c]) for c in waiting])
            rows = rows[(self.label[rows] == label) == same]
            if same:
                rows = rows[self.num[rows] != num]
            s = self.scores(q, rows)
            for w in range(len(floor)):
                ok = (s >= floor[w]) & (s <= high[w]) & ((s != least[w]) | (self.vec_id[rows] <= least_id[w]))
                if not ok.any():
                    continue
                ss, rr = np.concatenate([found[w][0], s[ok]]), np.concatenate([found[w][1], rows[ok]])
                best = np.lexsort((self.num[rr], self.vec_id[rr], -ss))[:k]
                found[w] = ss[best], rr[best]
                if len(best) == k:
                    floor[w] = max(floor[w], int(ss[best[-1]]))
            waiting, n = [], 0

        while heap:
            top, i, j = heapq.heappop(heap)
            if -top + room < floor.min(initial=np.iinfo(np.int64).max):
                break
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(order[0]) and b < len(order[1]) and (a, b) not in seen:
                    seen.add((a, b))
                    heapq.heappush(heap, (-(bound[0][order[0][a]] + bound[1][order[1][b]]), a, b))
            one, two = order[0][i], order[1][j]
            c = self.place.get(int(one) * self.wide + int(two))
            if c is None:
                continue
            centre, spread = middle[0][one] + middle[1][two], norms[0] * self.radius[0][c] + norms[1] * self.radius[1][c] + room
            if ((centre + spread >= floor) & (centre - spread <= high)).any():
                waiting.append(c)
                n += self.end[c] - self.at[c]
                if n >= SCORED:
                    score()
        if waiting:
            score()
        return found


def _searched(books: dict, same: bool, k: int):
    def searched(shards: pa.Table, asks: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if shards.num_rows and asks.num_rows:
            shard = Shard(shards.to_pylist()[0], books)
            for a in asks.to_pylist():
                low, high, least, least_id = (np.array(a[c], np.int64) for c in ("low", "high", "least", "least_id"))
                q = _matrix(a["vector"], a["dim"])[0].astype(np.int64)
                for w, (s, r) in zip(a["windows"], shard.search(a["num"], a["label"], q, low, high, least, least_id, same, k)):
                    rows += zip([a["num"]] * len(s), [w] * len(s), s.tolist(), shard.vec_id[r].tolist(), shard.label[r].tolist())
        return arrow_table(rows, FOUND)
    return searched


def _first(found: DataFrame, k: int) -> DataFrame:
    """The best k rows of each anchor and window, with their rank."""
    order = Window.partitionBy("num", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class MultiIndex:
    """The shards of a table of (vec_id, label, embedding), built once."""

    def __init__(self, vectors: DataFrame, label: Column | str = "label", scale: float = 256.0, codewords: int = CODEWORDS, sample: int = SAMPLE, shard: int = SHARD, group: int = GROUP):
        spark = vectors.sparkSession
        x = vectors.select(F.monotonically_increasing_id().alias("num"), F.col("vec_id").cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
                           F.col("embedding").cast("array<double>").alias("e")).where("vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL")
        self.group = group
        self.rows = written(x.mapInArrow(lambda b: _packed(b, scale), ROWS).where("vector IS NOT NULL"), "rows")
        self.books = books = codebooks(self.rows, codewords, sample)
        celled = self.rows.mapInArrow(lambda b: _celled(b, books), ROWS + ", cell long")
        order = ["dim", "cell", "vec_id", "num"]
        placed = celled.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
        self.shards = written(placed.mapInArrow(lambda b: _sharded(b, shard), SHARDS), "shards")
        # shard numbers and the rows in them, for the first search
        self.home = written(self.shards.select("shard", "num").mapInArrow(_members, "shard long, num long"), "home")

    def _met(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """Search pairs of shard and asks (with ``shard`` and ``part``)."""
        asks = asks.withColumnsRenamed({"shard": "_shard", "part": "_part"})
        parts = asks.select(F.col("_shard").alias("shard"), F.col("_part").alias("part")).distinct()
        shards = self.shards.join(parts, "shard")
        return shards.groupBy("shard", "part").cogroup(asks.groupBy("_shard", "_part")).applyInArrow(_searched(self.books, same, k), FOUND)

    def search(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """The first k rows for each window of ``asks`` (num, dim, label, vector, and the
        arrays windows, low and high): ``FOUND`` and rank."""
        asks = written(asks.withColumns({"least": F.col("low"), "least_id": F.array_repeat(F.lit((1 << 63) - 1), F.size("low"))}), "asks")
        part = F.pmod(F.xxhash64("num"), F.lit(max(1, -(-asks.count() // self.group)))).alias("part")
        own = asks.join(self.home, "num").select(*asks.columns, "shard", part)
        near = written(self._met(own, same, k), "near")
        # what each window must reach in the other shards
        kth = near.groupBy("num", "window").agg(F.count("*").alias("n"), F.min("score").alias("score"), F.max_by("vec_id", F.struct(-F.col("score"), F.col("vec_id"))).alias("id")).where(F.col("n") >= k)
        kth = kth.select("num", "window", F.struct("score", "id").alias("kth")).groupBy("num").agg(F.map_from_entries(F.collect_list(F.struct("window", "kth"))).alias("kth"))
        ready = asks.join(kth, "num", "left").join(self.home, "num").withColumnRenamed("shard", "home")
        def reached(own: str, field: str) -> Column:
            return F.when(F.col("kth").isNotNull(), F.zip_with("windows", own, lambda w, v: F.coalesce(F.col("kth")[w][field], v))).otherwise(F.col(own)).alias(own)
        ready = ready.withColumns({"least": reached("least", "score"), "least_id": reached("least_id", "id")})
        others = self.shards.select("shard", "dim")
        far = ready.join(others, "dim").where("shard <> home").select(*asks.columns, "shard", part)
        return _first(near.unionByName(self._met(far, same, k)), k)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, raw in zip(batch.column("shard").to_pylist(), batch.column("num").to_pylist()):
            num = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(num), shard)), pa.array(num)], names=["shard", "num"])


def mine(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0, **index) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, label, embedding) for which
    ``is_anchor`` (on vec_id) holds: the first ``positives`` rows of an anchor's label, and for each
    the first ``negatives`` rows of other labels from ``low`` to ``high`` percent of its score."""
    at = MultiIndex(vectors, label, scale, **index)
    anchors = at.rows.where(is_anchor)
    ask = anchors.select("num", "dim", "label", "vector", F.array(F.lit(0)).alias("windows"), F.array(F.lit(-(1 << 62))).alias("low"), F.array(F.lit(1 << 62)).alias("high"))
    best = written(at.search(ask, True, positives).select("num", "rank", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")
    # whole numbers n with low * p <= 100 n <= high * p
    window = F.struct("rank", F.expr(f"({low} * positive_score + pmod(-{low} * positive_score, 100)) div 100").alias("low"), F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100").alias("high"))
    windows = best.groupBy("num").agg(F.array_sort(F.collect_list(window)).alias("w"))
    ask = anchors.join(windows, "num").select("num", "dim", "label", "vector", F.col("w.rank").alias("windows"), F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    worst = at.search(ask, False, negatives)
    ids = anchors.select("num", F.col("vec_id").alias("anchor_id"))
    return worst.join(best.withColumnRenamed("rank", "window"), ["num", "window"]).join(ids, "num").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors, F.col("vec_id") % 100 == 0, label)


SQL = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: floor(256 * v::DOUBLE)) AS e, row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
score AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM whole a JOIN whole b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
positive AS (
  SELECT ar, anchor_id, br, vec_id AS positive_id, score AS positive_score FROM score WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5),
negative AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positive p JOIN score s ON s.ar = p.ar AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 10
"""
