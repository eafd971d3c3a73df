"""Trie of conversation prefixes from ternary search trees.

1. Distinct turns (role, text) are numbered in their order, and conversations become
   arrays of numbers.  Equal sequences are one, with the number of its conversations, the
   smallest and the digest of all their ids, which stream through a task in sorted pieces.
2. Distinct sequences are sorted and cut into range shards of about ``SHARD`` turns.
3. A shard inserts its sequences into a ternary search tree over turn numbers, the median
   first and then the medians of both halves, so the search trees of siblings are balanced.
   Trie nodes are numbered as they appear, parents before children; one pass in the
   opposite order adds up children, leaves and savings, without recursion.
4. Nodes on the paths of a shard's first and last sequence may go on in other shards.
   They leave as two paths with what is known of each node; their other nodes are final.
   Paths of all shards are sorted, cut and inserted in the same way until one shard holds
   them all (each level is smaller by the number of sequences in a shard).

Defined cases: rows without conv_id are left out; null role or text is empty; turns that
share a number are ordered by role and text; conversations without turns end at the root;
an empty table gives an empty result; other columns are ignored.  A conversation's turn
numbers (24 bytes a turn while they are gathered) are one row: one conversation must fit a
task's memory, its texts need not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, partitions, written

#: Turns of a shard, sequences that it has at least, and ids that are joined to one piece of a list.
SHARD, FEWEST, PIECE = 50_000, 8, 1 << 14
NOTHING = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max

#: A path: its turns, and for the nodes from depth ``since`` on what is known of them.
PATH = "ids array<long>, sizes array<long>, since long, n array<long>, low array<long>, children array<long>, leaves array<long>, saved array<long>, ends array<string>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Final nodes (``ids`` null) and paths for the next level; a final node whose parent isn't yet
#: final names it by ``up``, and one that came with paths has its own ``key``.
OUT = f"shard long, up binary, key binary, {NODE}, {PATH}"


class Tree:
    """A trie whose siblings hang in binary search trees: a node has a turn, links to
    siblings with smaller and greater turns, and one to its children."""

    def __init__(self):
        self.turn, self.less, self.more, self.below = [-1], [-1], [-1], [-1]
        self.up, self.depth, self.size = [-1], [0], [0]
        self.n, self.low, self.end = [0], [_FAR], [None]
        self.children, self.leaves, self.saved = [0], [0], [0]

    def _new(self, turn: int, up: int, size: int) -> int:
        for column, value in ((self.turn, turn), (self.less, -1), (self.more, -1), (self.below, -1), (self.up, up), (self.depth, self.depth[up] + 1), (self.size, size),
                              (self.n, 0), (self.low, _FAR), (self.end, None), (self.children, 0), (self.leaves, 0), (self.saved, 0)):
            column.append(value)
        return len(self.turn) - 1

    def path(self, ids: list[int], sizes: list[int]) -> list[int]:
        """The nodes of a sequence, root first; those that lack are made."""
        turn, less, more, below = self.turn, self.less, self.more, self.below
        node, nodes = 0, [0]
        for t, size in zip(ids, sizes):
            at = below[node]
            if at < 0:
                at = below[node] = self._new(t, node, size)
            while turn[at] != t:
                side = less if t < turn[at] else more
                if side[at] < 0:
                    side[at] = self._new(t, node, size)
                at = side[at]
            node = at
            nodes.append(at)
        return nodes

    def insert(self, row: dict) -> None:
        nodes = self.path(row["ids"], row["sizes"])
        for k, node in enumerate(nodes[row["since"]:]):
            self.n[node] += row["n"][k]
            self.low[node] = min(self.low[node], row["low"][k])
            self.children[node] += row["children"][k]
            self.leaves[node] += row["leaves"][k]
            self.saved[node] += row["saved"][k]
            if row["ends"][k] is not None:
                self.end[node] = row["ends"][k]

    def add_up(self, open_nodes: set[int]) -> None:
        """Totals of subtrees, children before parents.  What passes to an open node is
        what closed children hold; an open node adds nothing to its parent yet."""
        n, size, up, children, leaves, saved = self.n, self.size, self.up, self.children, self.leaves, self.saved
        for node in range(len(up) - 1, -1, -1):
            if node in open_nodes:
                continue
            saved[node] += (n[node] - 1) * size[node]
            if not children[node]:
                leaves[node] = 1
            if node:
                children[up[node]] += 1
                leaves[up[node]] += leaves[node]
                saved[up[node]] += saved[node]


def median_first(n: int) -> Iterator[int]:
    """0 to n-1, each range's median before the others of the range."""
    stack = [(0, n)]
    while stack:
        i, j = stack.pop()
        if i < j:
            m = (i + j) // 2
            yield m
            stack += [(m + 1, j), (i, m)]


def _keys(ids: list[int]) -> list[bytes]:
    """The name of every prefix of a sequence."""
    h, out = hashlib.blake2b(digest_size=16), []
    out.append(h.digest())
    for t in ids:
        h.update(int(t).to_bytes(8, "little", signed=True))
        out.append(h.digest())
    return out


def shard_rows(rows: list[dict], shard: int, last: bool, keyed: bool) -> pa.Table:
    """The nodes and paths (``OUT``) of sorted sequences; the ``last`` shard has no
    open nodes; nodes that came with paths are ``keyed``."""
    tree = Tree()
    for k in median_first(len(rows)):
        tree.insert(rows[k])
    edges = [] if last else [(r, tree.path(r["ids"], r["sizes"])) for r in (rows[:1] if len(rows) == 1 else (rows[0], rows[-1]))]
    open_nodes = {n for _, nodes in edges for n in nodes}
    names: dict[int, bytes] = {}
    for r, nodes in edges:
        names.update(zip(nodes, _keys(r["ids"])))
    if keyed:
        for r in rows:
            names.update(zip(tree.path(r["ids"], r["sizes"]), _keys(r["ids"])))
    tree.add_up(open_nodes)
    closed = [n for n in range(len(tree.up)) if n not in open_nodes]
    waits = [tree.up[n] in open_nodes for n in closed]
    out = {
        "shard": [shard] * len(closed), "up": [names[tree.up[n]] if w else None for n, w in zip(closed, waits)], "key": [names[n] if keyed else None for n in closed],
        "conv_id": [tree.low[n] for n in closed], "depth": [tree.depth[n] for n in closed],
        "parent_conv_id": [None if w or not n else tree.low[tree.up[n]] for n, w in zip(closed, waits)],
        "n_convs": [tree.n[n] for n in closed], "n_children": [tree.children[n] for n in closed], "n_leaves": [tree.leaves[n] for n in closed],
        "saved_tokens": [tree.saved[n] for n in closed], "ends_sha256": [tree.end[n] or NOTHING for n in closed],
    }
    paths = {c: [None] * len(closed) for c in ("ids", "sizes", "since", "n", "low", "children", "leaves", "saved", "ends")}
    told: set[int] = set()
    for r, nodes in edges:
        own = [n for n in nodes if n not in told]
        told.update(own)
        for c in out:
            out[c].append(shard if c == "shard" else None)
        for c, v in (("ids", r["ids"]), ("sizes", r["sizes"]), ("since", len(nodes) - len(own)), *((c, [getattr(tree, c)[n] for n in own]) for c in ("n", "low", "children", "leaves", "saved")), ("ends", [tree.end[n] for n in own])):
            paths[c].append(v)
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    spec = [f.split() for f in OUT.split(", ")]
    return pa.Table.from_arrays([pa.array((out | paths)[c], kinds[k]) for c, k in spec], names=[c for c, _ in spec])


def _shards(batches: Iterator[pa.RecordBatch], size: int, last: bool, keyed: bool) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, number, held, weight = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for k in range(0, batch.num_rows, 1024):
            for row in batch.slice(k, 1024).to_pylist():
                held.append(row)
                weight += len(row["ids"]) + 1
                if weight >= size and len(held) >= FEWEST and not last:
                    yield from shard_rows(held, (part << 32) + number, last, keyed).to_batches(1 << 16)
                    number, held, weight = number + 1, [], 0
    if held:
        yield from shard_rows(held, (part << 32) + number, last, keyed).to_batches(1 << 16)


# ------------------------------------------------------- digests of id lists

def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and id as joined pieces of the list of each key."""
    from pyspark import TaskContext

    part, number, key, held = TaskContext.get().partitionId(), 0, None, []

    def out() -> pa.RecordBatch:
        nonlocal number, held
        number += 1
        row = pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([(part << 32) + number]), pa.array([len(held)]), pa.array([held[0]]), pa.array([",".join(map(str, held))])],
                                         names=["seq", "piece", "count", "low", "ids"])
        held = []
        return row

    for batch in batches:
        for k, i in zip(batch.column("seq").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (k != key or len(held) == size):
                yield out()
            key = k
            held.append(i)
    if held:
        yield out()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key and place: the digest of each key's whole list."""
    key, state, count, low, rows = None, None, 0, None, []

    def out() -> pa.RecordBatch:
        nonlocal rows
        cols = list(zip(*rows))
        rows = []
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3])], names=["seq", "count", "low", "ends"])

    for batch in batches:
        for k, _, c, lo, ids in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if k != key:
                if state is not None:
                    rows.append((key, count, low, state.hexdigest()))
                key, state, count, low = k, hashlib.sha256(ids.encode()), c, lo
            else:
                state.update(b"," + ids.encode())
                count += c
        if len(rows) >= 4096:
            yield out()
    if state is not None:
        rows.append((key, count, low, state.hexdigest()))
    if rows:
        yield out()


def ends(members: DataFrame) -> DataFrame:
    """Of rows (seq, conv_id): for each seq the number and the least of its ids and the
    digest of their ascending list.  Lists are joined where they lie sorted, and only
    pieces of them pass one after the other through the task of their seq."""
    n = partitions(members.sparkSession)
    placed = members.repartitionByRange(n, "seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    pieces = placed.mapInArrow(lambda b: _pieces(b, PIECE), "seq binary, piece long, count long, low long, ids string")
    return pieces.repartition(n, "seq").sortWithinPartitions("seq", "piece").mapInArrow(_digested, "seq binary, count long, low long, ends string")


# ------------------------------------------------------------------ Spark side

def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, ids, sizes (UTF-8 bytes) of the conversations in ``turns``."""
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id IS NOT NULL")
    name = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = rows.withColumn("name", name)
    # monotonically increasing numbers follow the sorted range partitions
    known = rows.groupBy("name").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    ranged = known.repartitionByRange(partitions(turns.sparkSession), "role", "text").sortWithinPartitions("role", "text")
    numbers = written(ranged.select("name", F.monotonically_increasing_id().alias("id"), F.octet_length("text").cast("long").alias("size")), "turns")
    coded = rows.select("conv_id", "turn", "name").join(numbers, "name")
    own = coded.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "size"))).alias("t"))
    return own.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def prefix_trie(convs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The nodes of the trie of ``convs`` (distinct conv_id; ids, sizes: array<long>)."""
    spark = convs.sparkSession
    n = partitions(spark)
    seq = F.unhex(F.md5(F.array_join(F.col("ids").cast("array<string>"), ",")))
    convs = written(convs.select("conv_id", "ids", "sizes", seq.alias("seq")), "sequences")
    last = ends(convs.select("seq", "conv_id"))
    texts = convs.groupBy("seq").agg(F.first("ids").alias("ids"), F.first("sizes").alias("sizes"))
    depth = F.size("ids") + 1
    whole = texts.join(last, "seq").select("ids", "sizes", F.lit(0).cast("long").alias("since"), F.array_repeat("count", depth).alias("n"), F.array_repeat("low", depth).alias("low"),
                                           *[F.array_repeat(F.lit(0).cast("long"), depth).alias(c) for c in ("children", "leaves", "saved")],
                                           F.concat(F.array_repeat(F.lit(None).cast("string"), depth - 1), F.array("ends")).alias("ends"))
    paths, done, level = written(whole, "paths"), [], 0
    while True:
        size = paths.agg(F.count("*").alias("paths"), F.coalesce(F.sum(F.size("ids") + 1), F.lit(0)).alias("turns")).first()
        # every level has fewer paths: FEWEST at least make two, and so does a partition's rest
        parts = min(n, size["paths"] // FEWEST)
        single = size["turns"] <= shard or parts < 2
        placed = paths.coalesce(1).sortWithinPartitions("ids") if single else paths.repartitionByRange(parts, "ids").sortWithinPartitions("ids")
        out = written(placed.mapInArrow(lean(_shards, shard, single, level > 0), OUT), "nodes")
        done.append(out.where("ids IS NULL"))
        if single:
            break
        paths = out.where("ids IS NOT NULL").select(*[f.split()[0] for f in PATH.split(", ")])
        level += 1
    names = [f.split()[0] for f in NODE.split(", ")]
    # parents that became final on a later level, for each shard that waits for them
    found = None
    for k, nodes in enumerate(done):
        if k + 1 < len(done):
            later = done[k + 1].select("key", "conv_id")
            for more in done[k + 2:]:
                later = later.union(more.select("key", "conv_id"))
            waits = nodes.where("up IS NOT NULL")
            lows = waits.select("shard", "up").distinct().join(later.withColumnsRenamed({"key": "up", "conv_id": "_low"}), "up")
            nodes = nodes.join(lows, ["shard", "up"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_low"))
        found = nodes.select(*names) if found is None else found.union(nodes.select(*names))
    return found


def rebuilt(convs: DataFrame, base: Column, keep: Column) -> DataFrame:
    """Each conversation with the first ``keep`` turns of conversation ``base`` in place
    of its own first ones."""
    asks = convs.select("conv_id", "ids", "sizes", base.alias("_base"), keep.cast("int").alias("_keep"))
    wanted = asks.groupBy("_base").agg(F.max("_keep").alias("_most"))
    heads = convs.withColumnRenamed("conv_id", "_base").join(wanted, "_base").select("_base", F.slice("ids", F.lit(1), F.col("_most")).alias("_ids"), F.slice("sizes", F.lit(1), F.col("_most")).alias("_sizes"))
    both = asks.join(heads, "_base", "left")
    none = F.array().cast("array<long>")

    def joined(own: str, head: str) -> Column:
        return F.concat(F.slice(F.coalesce(head, none), F.lit(1), F.col("_keep")), F.slice(own, F.col("_keep") + 1, F.size(own) + 1)).alias(own)
    return both.select("conv_id", joined("ids", "_ids"), joined("sizes", "_sizes"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = written(sequences(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "conversations")
    keep = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    return prefix_trie(rebuilt(convs, F.col("conv_id") - F.col("conv_id") % 5, keep))


SQL = """
WITH turns AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
-- crc32 of the decimal id, byte by byte and bit by bit
crc AS (
  SELECT conv_id, t, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda s, z: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384::BIGINT) ELSE s // 2 END)), 4294967295::BIGINT) % 9 AS h
  FROM turns),
conv AS (
  SELECT c.conv_id, list_concat(coalesce(b.t, [])[1:c.h], c.t[c.h + 1:]) AS t
  FROM crc c LEFT JOIN turns b ON b.conv_id = c.base),
prefix AS (SELECT conv_id, len(t) AS n, d, t[1:d] AS p FROM conv, unnest(range(0, len(t) + 1)) AS u(d)),
node AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256,
    (count(*) - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(p[d].text) END AS own
  FROM prefix GROUP BY p, d),
child AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
whole AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (p, d)),
above AS (SELECT p[1:k] AS p, k AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum(own)::BIGINT AS saved_tokens
  FROM whole, unnest(range(0, d + 1)) AS v(k) GROUP BY 1, 2)
SELECT w.conv_id, w.d::BIGINT AS depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, a.n_leaves, a.saved_tokens, w.ends_sha256
FROM whole w JOIN above a USING (p, d) LEFT JOIN node u ON w.d > 0 AND u.d = w.d - 1 AND u.p = w.p[1:w.d - 1]
"""
