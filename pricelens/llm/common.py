"""Helpers shared by the operators of this package: vectorised word hashing over
Arrow text buffers, size-checked joins, written intermediate tables and
connected components.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D with A-Z lower-cased;
a word is identified by a 64-bit hash (tabulated bytes, polynomial over the
position, finalised), so unrelated words collide with probability 2**-64.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pricelens.session import ensure_checkpoint_dir, scratch_path

WORD_RE = r"[^\x20\x09-\x0D]+"
#: Rows that a side of a join may have at most to be broadcast.
BROADCAST_ROWS = 1_000_000
#: Edges whose components one task finds at most; more take rounds of joins.
FEW_EDGES = 500_000
#: Bytes of texts that go to Python at a time.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (all operations modulo 2**64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE_CASED = _BYTE.copy()
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0xD1342543DE82EF95
_powers: dict[str, np.ndarray] = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        m = max(n, (1 << 20) + (1 << 17))
        for k, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(m, base, _U)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers["up"], _powers["down"]


def chunk_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte ranges start to end; by default case counts."""
    up, down = _power(len(buf) + 1)
    total = np.zeros(len(buf) + 1, _U)
    np.cumsum((_BYTE_CASED if table is None else table)[buf] * up[: len(buf)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U) * _U(0x9E3779B97F4A7C15))


def gram_hashes(buf: np.ndarray, size: int) -> np.ndarray:
    """``chunk_hashes`` of every run of ``size`` bytes, case counting."""
    n = len(buf) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    up, down = _power(len(buf) + 1)
    total = np.zeros(len(buf) + 1, _U)
    np.cumsum(_BYTE_CASED[buf] * up[: len(buf)], out=total[1:])
    h = total[size:] - total[:n]
    h *= down[:n]
    h += _U(size * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return mix(h)


class Words:
    """The words of some texts: ``hash``, byte ``start`` and ``end`` per word, and
    ``first`` (len texts + 1): text i holds words first[i] to first[i+1]."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        n = len(buf)
        self.buf, self.off = buf, off
        space = _SPACE[buf]
        begin, stop = ~space, ~space
        begin[1:] &= space[:-1]
        stop[:-1] &= space[1:]
        edge = off[:-1][off[:-1] < n]
        begin[edge] = ~space[edge]
        edge = edge[edge > 0] - 1
        stop[edge] = ~space[edge]
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.hash = chunk_hashes(buf, self.start, self.end, _BYTE)
        self.first = np.searchsorted(self.start, off)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.off) - 1), self.counts)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def row_texts(batch: pa.RecordBatch):
    """The texts of a batch made from ``rows_and_texts``."""
    if "_text" in batch.schema.names:
        return batch.column("_text")
    rows = batch.column("_row")
    return pc.struct_field(rows, [rows.type.get_field_index("text")])


def lean(work: Callable, *args) -> Callable:
    """``work`` (batches, *args) for mapInArrow.  Python workers outlive their tasks,
    so what the allocators keep is handed back to the machine at a task's end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches, *args)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)
    return run


def slices(off: np.ndarray, target: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``target`` bytes together, one text at least: numpy
    works on pieces that fit the processor's cache, and memory stays bounded."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + target, side="right")) - 1)
        yield i, j
        i = j


def word_slices(column, target: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    buf, off = text_buffer(column)
    for i, j in slices(off, target):
        yield i, j, Words(buf[off[i] : off[j]], off[i : j + 1] - off[i])


def shingle_sets(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their offsets.  A text of
    fewer words than ``size`` has its whole sequence as one shingle; one without
    words has none."""
    w, first, counts = words.hash, words.first, words.counts
    rng = [mix(np.full(1, k + 1, _U) * _U(0xA0761D6478BD642F))[0] | _U(1) for k in range(size)]
    parts, owners = [], []
    if len(w) >= size:
        m = len(w) - size + 1
        h = np.zeros(m, _U)
        for k in range(size):
            h += w[k : k + m] * rng[k]
        owner = words.text
        ok = owner[:m] == owner[size - 1 :]
        parts.append(mix(h[ok]))
        owners.append(owner[:m][ok])
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        h = np.zeros(len(short), _U)
        for k in range(size - 1):
            has = counts[short] > k
            h[has] += w[first[short][has] + k] * rng[k]
        parts.append(mix(h ^ (counts[short].astype(_U) << _U(56))))
        owners.append(short)
    if not parts:
        return np.zeros(0, _U), np.zeros(len(counts) + 1, np.int64)
    h, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[keep], owner[keep]
    return h, np.searchsorted(owner, np.arange(len(counts) + 1))


def ragged(values: np.ndarray, off: np.ndarray, kind=None) -> pa.ListArray:
    """An Arrow list column of values[off[i]:off[i+1]]."""
    arr = pa.array(values) if kind is None else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), arr)


def binaries(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """The raw bytes of values[off[i]:off[i+1]], as an Arrow binary column."""
    raw = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * raw.itemsize).astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())])


# ------------------------------------------ sums of keyed numbers between tasks
# A chunk of the corpus sends each distinct key (a 64-bit hash) once to the key's
# bucket; the bucket answers every chunk in the order of its sorted keys.

SENT = "chunk long, bucket int, keys binary, vals binary"
REPLY = "chunk long, bucket int, vals binary"


def packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def unpacked(x: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def bucket_bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin: buckets are ranges of the hash."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def sent(number: int, keys: np.ndarray, vals: np.ndarray, buckets: int) -> list[tuple]:
    at = bucket_bounds(keys, buckets)
    return [(number, b, packed(keys[x:y]), packed(vals[x:y])) for b, (x, y) in enumerate(zip(at, at[1:])) if y > x]


def arrow_table(rows: list[tuple], spec: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [f.split() for f in spec.split(", ")]
    cols = list(zip(*rows)) if rows else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


# ------------------------------------------------------------------ Spark side

def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, in a session whose Arrow batches hold about ``BATCH_BYTES`` unless it
    sets a size itself.  Spark builds a batch in buffers that double as they grow, on
    both sides of the pipe and once per task, so a partition's texts are not sent at once."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH, None) is None:
        conf.set(_BATCH, str(BATCH_BYTES))
    return docs


def row_of(df: DataFrame, keep: list[str] | None = None) -> Column:
    """``keep`` (all columns by default) as one struct column ``_row``: whatever their
    names, they can't clash with an operator's own columns beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]).alias("_row")


def rows_and_texts(docs: DataFrame, keep: list[str] | None, *more: Column) -> DataFrame:
    """``_row`` of ``docs``, ``more`` columns, and ``_text`` unless the row holds the
    text as a string already: texts go to Python once."""
    held = "text" in (docs.columns if keep is None else keep) and docs.schema["text"].dataType == StringType()
    return small_batches(docs).select(row_of(docs, keep), *([] if held else [F.col("text").cast("string").alias("_text")]), *more)


def word_count(text: Column | str) -> Column:
    """Number of words of a text (0 for null), on the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def in_fold(doc_id: Column | str, mod: int, rest: int) -> Column:
    """crc32 of doc_id as text, modulo ``mod``, equals ``rest``; false for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % mod == rest, F.lit(False))


def written(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write a table (with a writer's ``options``) into the shared checkpoint folder and read it back: lineage is
    cut, and later readers fetch only the columns they need."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing later reads."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: a lost executor re-reads it; the session's cleaner
    removes it once nothing refers to it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def sized_join(big: DataFrame, small: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with a side that is broadcast only if it is counted to hold at most
    ``BROADCAST_ROWS`` narrow rows; else a shuffle join that AQE can split.
    ``small`` should be a written or checkpointed table, as it is counted."""
    n = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on, how)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all edges of the partition: larger roots hook onto smaller ones."""
    ends = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if not sum(len(x) for x, _ in ends):
        return
    node, at = np.unique(np.concatenate([*(x for x, _ in ends), *(y for _, y in ends)]), return_inverse=True)
    i, j = at.reshape(2, -1)
    up = np.arange(len(node))
    while (up[i] != up[j]).any():
        np.minimum.at(up, np.maximum(up[i], up[j]), np.minimum(up[i], up[j]))
        while (up[up] != up).any():
            up = up[up]
    for k in range(0, len(node), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(node[k:k + 10_000]), pa.array(node[up[k:k + 10_000]])], names=["node", "component"])


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """Connected components of ``edges`` (a, b: long; a written or checkpointed table, as
    it is counted): node, component (its smallest node), for the nodes that have an edge.

    At most ``few`` edges are one task's arrays.  With more, each round takes the smallest label among the
    neighbours and then follows labels once (pointer jumping), so rounds grow with the logarithm of the
    diameter.  Every round is a checkpoint.  A hub's edges are combined before
    the shuffle, and its joins are ones that AQE splits.
    """
    edges = edges.select("a", "b").where("a <> b")
    if edges.count() <= few:
        return cut(edges.coalesce(1).mapInArrow(_labelled, "node long, component long"))
    both = cut(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        low = label.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("c"))
        parent = label.select(F.col("node").alias("c"), F.col("component").alias("up"))
        step = cut(low.join(parent, "c").select("node", "old", F.least("c", "up").alias("component")))
        label = step.select("node", "component")
        if step.where("component <> old").isEmpty():
            return label
