"""Removal of repeated byte passages by suffix arrays.

A byte of a document goes if a string of ``LENGTH`` bytes that covers it also starts in
a document with a smaller doc_id.

1. Texts are written as compressed chunks.  A text of ``LENGTH`` bytes or more that is
   whole in a document with a smaller doc_id loses all of its bytes, and goes.
2. Of every window of ``LENGTH`` bytes the
   smallest hash of a ``GRAM``-byte piece is its anchor, so equal windows have equal
   anchors, and adjacent windows mostly share theirs.  Anchors (about one per 16 bytes)
   are brought together by a shuffle on the hash; those met in one document only leave.
3. A chunk cuts out the segments of its windows whose anchor is met elsewhere, and deals
   each distinct one to its anchor's place, with the least and greatest doc_id it occurs in.
4. There segments are joined to strings of about ``BATCH`` bytes, whole anchors at a time,
   and sorted by the two-stage method: the suffixes smaller than their successors are
   sorted directly, the rest is induced by scanning the buckets of first bytes.  Adjacent
   common prefixes of at least ``LENGTH`` bytes make groups, and a group's least doc_id
   goes back to the chunks where some occurrence has a greater one.
5. Chunks lay the windows that lose on their bytes and hash what is left.

An anchor with more than ``HOT`` segments (a phrase in a great many contexts) is dealt
window by window, on the hash of the whole window, so that no place gets an unbounded
group; equal windows meet as before.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing; a row
without doc_id neither loses bytes nor takes any from others; rows that repeat a doc_id
are judged each by its own text and never against each other; strings may overlap, also
within a document; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binaries, chunk_hashes, discard, gram_hashes, lean, partitions, small_batches, text_buffer, written

LENGTH = 50
GRAM = 20
#: Bytes of text of a chunk, of a slice of one, and of a string that is sorted at once.
CHUNK = 4 << 20
SLICE = 1 << 19
BATCH = 1 << 20
#: Segments of one anchor above which it is dealt window by window.
HOT = 4096
#: Windows of a segment at most.
RUN = LENGTH - GRAM + 1

_U = np.uint64
_MOST = np.iinfo(np.int64).max
#: ``known``: has a doc_id; ``copy``: its text, not kept here, is whole in a smaller doc_id's.
CHUNKS = "chunk long, ids binary, known binary, copy binary, size binary, off binary, text binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


# --------------------------------------------------------------- suffix array

def words_at(x: np.ndarray, more: int) -> np.ndarray:
    """The 8 bytes from each position as one big-endian number; zeros follow the end."""
    y = np.zeros(len(x) + more + 8, np.uint8)
    y[: len(x)] = x
    out = np.zeros(len(x) + more, _U)
    for j in range(8):
        out = (out << _U(8)) | y[j : j + len(out)]
    return out


def _directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """``at`` (ascending) sorted by the first ``depth`` bytes of their suffixes; in ties,
    which the zeros after the end can cause, the shorter suffix is first."""
    at = at[::-1]
    at = at[np.argsort(words[at], kind="stable")]
    same = np.zeros(len(at), bool)
    same[1:] = words[at[1:]] == words[at[:-1]]
    for d in range(8, depth, 8):
        tied = same.copy()
        tied[:-1] |= same[1:]
        idx = np.flatnonzero(tied)
        if not len(idx):
            break
        group = np.cumsum(~same[idx])
        key = words[at[idx] + d]
        order = np.lexsort((key, group))
        at[idx], key = at[idx][order], key[order]
        same[idx[1:]] &= key[1:] == key[:-1]
    return at


def two_stage(x: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Suffix array of the bytes ``x``, sorted by ``depth`` bytes at least."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    if words is None:
        words = words_at(x, depth + 8)
    # a suffix is smaller than its successor if the byte after its run is greater
    edge = np.append(np.flatnonzero(x[:-1] != x[1:]), n - 1)
    rises = np.zeros(len(edge), bool)
    rises[:-1] = x[edge[:-1]] < x[edge[:-1] + 1]
    smaller = np.repeat(rises, np.diff(edge, prepend=-1))
    direct = _directly(words, np.flatnonzero(smaller), depth)
    first = np.searchsorted(x[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[x[n - 1]].append(np.array([n - 1]))  # before the empty suffix
    parts = []
    for c in range(256):
        bucket = []
        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(now):  # runs of c induce each other
            bucket.append(now)
            now = now[now > 0] - 1
            now = now[x[now] == c]
        bucket.append(direct[first[c] : first[c + 1]])
        bucket = np.concatenate(bucket)
        if not len(bucket):
            continue
        parts.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[x[before] > c]
        if len(before):
            byte = x[before]
            order = np.argsort(byte, kind="stable")
            kinds, at = np.unique(byte[order], return_index=True)
            for b, some in zip(kinds, np.split(before[order], at[1:])):
                waiting[b].append(some)
        waiting[c] = []
    return np.concatenate(parts)


def common_prefixes(words: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix with the one sorted before it (the first: 0), ``depth`` at most."""
    out = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for d in range(0, depth, 8):
        diff = words[order[alive] + d] ^ words[order[alive - 1] + d]
        out[alive[diff == 0]] += 8
        some = np.flatnonzero(diff)
        lead = diff[some]
        for b in range(1, 8):
            out[alive[some]] += (lead >> _U(64 - 8 * b)) == 0
        alive = alive[diff == 0]
    return np.minimum(out, depth)


# ------------------------------------------------------------------- anchors

def anchors(buf: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of adjacent windows with one anchor: first window, windows, anchor."""
    gram, run = min(GRAM, length), length - min(GRAM, length) + 1
    found = []
    total = max(0, len(buf) - length + 1)
    for s in range(0, total, SLICE):
        e = min(s + SLICE, total)
        low = gram_hashes(buf[s : e + length - 1], gram)
        span = 1
        while span * 2 <= run:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < run:
            low = np.minimum(low[: len(low) - (run - span)], low[run - span :])
        # windows that reach over the end of their text; so those of two texts never adjoin
        inner = off[np.searchsorted(off, s, side="right") : np.searchsorted(off, e + length - 1)]
        over = np.zeros(e - s + 1, np.int32)
        np.add.at(over, np.maximum(inner - length + 1 - s, 0), 1)
        np.add.at(over, np.minimum(inner - s, e - s), -1)
        start = np.flatnonzero(np.cumsum(over[:-1]) == 0)
        if not len(start):
            continue
        low, start = low[start], start + s
        new = np.ones(len(start), bool)
        new[1:] = (low[1:] != low[:-1]) | (start[1:] != start[:-1] + 1)
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(start)))
        # long runs (periodic text) in pieces
        pieces = -(-n // run)
        turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(start[at], pieces) + turn * run
        found.append((first, np.minimum(np.repeat(n, pieces) - turn * run, run), np.repeat(low[at], pieces)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return tuple(np.concatenate(f) for f in zip(*found))


class Chunk:
    """One row of the written chunks: the texts that have a doc_id can meet others."""

    def __init__(self, row: dict):
        self.copy, self.size = np.frombuffer(row["copy"], bool), np.frombuffer(row["size"], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(row["text"], max_output_size=max(1, int(np.frombuffer(row["off"], np.int64)[-1])))
        self.buf, self.off = np.frombuffer(raw, np.uint8), np.frombuffer(row["off"], np.int64)
        self.ids, self.known = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["known"], bool)

    def anchors(self, length: int) -> tuple[np.ndarray, ...]:
        """Runs as ``anchors`` gives them, and the doc of each; rows without doc_id have none."""
        first, n, anchor = anchors(self.buf, self.off, length)
        doc = np.searchsorted(self.off, first, side="right") - 1
        ok = self.known[doc] if len(doc) else np.zeros(0, bool)
        return first[ok], n[ok], anchor[ok], doc[ok]

    def segments(self, shared: np.ndarray, hot: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Occurrences whose anchor is in ``shared`` (sorted): first window, windows,
        anchor, doc, name; those in ``hot`` one window each, keyed by the window's hash.
        The name tells the run and the window in it; it doesn't depend on ``shared``."""
        first, n, anchor, doc = self.anchors(length)
        at = np.searchsorted(shared, anchor)
        run = np.flatnonzero((at < len(shared)) & (shared[np.minimum(at, len(shared) - 1)] == anchor)) if len(shared) else np.zeros(0, np.int64)
        first, n, anchor, doc = first[run], n[run], anchor[run], doc[run]
        alone = np.isin(anchor, hot)
        each = np.where(alone, n, 1)
        turn = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        single = np.repeat(alone, each)
        first, doc = np.repeat(first, each) + turn, np.repeat(doc, each)
        n, anchor = np.where(single, 1, np.repeat(n, each)), np.repeat(anchor, each)
        name = np.repeat(run, each) * (length + 1) + np.where(single, turn + 1, 0)
        if single.any():
            anchor[single] = _hashes(self.buf, first[single], first[single] + length)
        return first, n, anchor, doc, name

    def distinct(self, shared: np.ndarray, hot: np.ndarray, length: int):
        """The occurrences, the number of each one's segment, and the first occurrence
        of each segment; segments are told apart by 128 bits of anchor and bytes."""
        first, n, anchor, doc, name = self.segments(shared, hot, length)
        whole = _hashes(self.buf, first, first + n + length - 1)
        order = np.lexsort((whole, anchor))
        new = np.ones(len(order), bool)
        new[1:] = (anchor[order[1:]] != anchor[order[:-1]]) | (whole[order[1:]] != whole[order[:-1]])
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        return first, n, anchor, doc, name, number, order[new]


def _hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``chunk_hashes`` of short ranges, slice by slice of a long buffer."""
    out = np.zeros(len(start), _U)
    order = np.argsort(start, kind="stable")
    cuts = np.searchsorted(start[order], np.arange(0, len(buf) + SLICE, SLICE))
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        if i < j:
            own, s = order[i:j], k * SLICE
            out[own] = chunk_hashes(buf[s : int(end[own].max())], start[own] - s, end[own] - s)
    return out


# -------------------------------------------------------------- work of tasks

def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), 0
    held, weight = [], 0

    def out() -> pa.RecordBatch:
        nonlocal number, held, weight
        table = pa.Table.from_batches(held)
        buf, off = text_buffer(table.column("_text"))
        ids = table.column("_id").combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        digests = b"".join(hashlib.blake2b(buf[a:b].tobytes(), digest_size=16).digest() for a, b in zip(off[:-1], off[1:]))
        row = [(part << 32) + number, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(), known.tobytes(), np.zeros(len(known), bool).tobytes(),
               np.diff(off).astype(np.int64).tobytes(), off.astype(np.int64).tobytes(), zstandard.ZstdCompressor(level=6).compress(buf.tobytes()), digests]
        number, held, weight = number + 1, [], 0
        return pa.RecordBatch.from_arrays([pa.array([row[0]]), *[pa.array([v], pa.binary()) for v in row[1:]]], names=["chunk", "ids", "known", "copy", "size", "off", "text", "digests"])

    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            held.append(one)
            weight += len(one.column("_text")[0].as_buffer() or b"") if one.column("_text")[0].is_valid else 0
            if weight >= size:
                yield out()
    if held:
        yield out()


def _named(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The digests of texts that can lose bytes."""
    for batch in batches:
        for row in batch.to_pylist():
            size, ids = np.frombuffer(row["size"], np.int64), np.frombuffer(row["ids"], np.int64)
            some = np.flatnonzero(np.frombuffer(row["known"], bool) & (size >= length))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), row["chunk"])), pa.array(some), pa.array(ids[some]), pa.array([row["digests"][16 * i : 16 * i + 16] for i in some], pa.binary())],
                                             names=["chunk", "place", "id", "digest"])


def _marked(chunks: pa.Table, copies: pa.Table) -> pa.Table:
    """The chunk without the texts of its copies."""
    names = [f.split()[0] for f in CHUNKS.split(", ")]
    if not copies.num_rows:
        return chunks.select(names)
    row = chunks.to_pylist()[0]
    chunk = Chunk(row)
    copy = np.zeros(len(chunk.ids), bool)
    copy[copies.column("place").to_numpy()] = True
    left = np.where(copy, 0, chunk.size)
    off = np.concatenate([[0], np.cumsum(left)])
    text = b"".join(chunk.buf[a:b].tobytes() for a, b, c in zip(chunk.off[:-1], chunk.off[1:], copy) if not c)
    row |= {"copy": copy.tobytes(), "off": off.tobytes(), "text": zstandard.ZstdCompressor(level=6).compress(text)}
    return pa.Table.from_arrays([pa.array([row[c]], chunks.schema.field(c).type) for c in names], names=names)


def _met(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Each anchor of a chunk once: runs * 2 + 1 if it is in several documents."""
    for batch in batches:
        for row in batch.to_pylist():
            chunk = Chunk(row)
            _, _, anchor, doc = chunk.anchors(length)
            ids = chunk.ids[doc]
            order = np.lexsort((ids, anchor))
            anchor, ids = anchor[order], ids[order]
            at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
            n = np.diff(np.append(at, len(anchor)))
            several = ids[at] != ids[at + n - 1]
            for i in range(0, len(at), 1 << 16):
                j = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(anchor[at[j]].view(np.int64)), pa.array(np.full(len(at[j]), row["chunk"])), pa.array(n[j] * 2 + several[j])],
                                                 names=["anchor", "chunk", "n"])


def _shared(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor; those of anchors in several chunks or documents go on."""
    def out(anchor, chunk, n):
        at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        size = np.diff(np.append(at, len(anchor)))
        keep = (size > 1) | (np.add.reduceat(n & 1, at) > 0)
        many = np.add.reduceat(n >> 1, at) > hot
        keep, many = np.repeat(keep, size), np.repeat(many, size)
        return pa.RecordBatch.from_arrays([pa.array(chunk[keep]), pa.array(anchor[keep]), pa.array(many[keep])], names=["chunk", "anchor", "hot"])

    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        cols = [np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, ("anchor", "chunk", "n"))]
        if not len(cols[0]):
            continue
        last = int(np.searchsorted(cols[0], cols[0][-1]))  # the last anchor may go on
        held = [c[last:] for c in cols]
        if last:
            yield out(*[c[:last] for c in cols])
    if len(held[0]):
        yield out(*held)


def _listed(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    anchor = rows.column("anchor").to_numpy().view(_U)
    hot = rows.column("hot").to_numpy().astype(bool)
    return np.sort(anchor), np.sort(anchor[hot])


def _deal(length: int):
    def deal(chunks: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["anchor", "bytes", "chunk", "name", "low", "high"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        if not chunks.num_rows or not rows.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        row = chunks.to_pylist()[0]
        chunk = Chunk(row)
        first, n, anchor, doc, name, number, lead = chunk.distinct(*_listed(rows), length)
        low, high = np.full(len(lead), _MOST), np.full(len(lead), -_MOST)
        np.minimum.at(low, number, chunk.ids[doc])
        np.maximum.at(high, number, chunk.ids[doc])
        size = n[lead] + length - 1
        off = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(off[-1]) - np.repeat(off[:-1] - first[lead], size)
        return pa.Table.from_arrays([pa.array(anchor[lead].view(np.int64)), binaries(chunk.buf[at], off), pa.array(np.full(len(lead), row["chunk"])),
                                     pa.array(name[lead]), pa.array(low), pa.array(high)], names=names)
    return deal


def least_ids(buf: np.ndarray, off: np.ndarray, low: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For the distinct texts buf[off[i]:off[i+1]]: of each window, text by text, the
    least ``low`` of the texts that hold the same window, from the suffix array of all of
    them; and where each text's windows begin."""
    count = len(low)
    x = np.zeros(len(buf) + count, np.uint8)  # a zero after each text
    x[np.arange(len(buf)) + np.repeat(np.arange(count), np.diff(off))] = buf
    words = words_at(x, length + 8)
    order = two_stage(x, length, words)
    windows = np.maximum(0, np.diff(off) - length + 1)
    begin = np.concatenate([[0], np.cumsum(windows)])
    place = np.arange(begin[-1]) - np.repeat(begin[:-1] - off[:-1] - np.arange(count), windows)
    value = np.full(len(x), _MOST)  # of windows that stay in their text
    value[place] = np.repeat(low, windows)
    edge = np.flatnonzero(common_prefixes(words, order, length) < length)
    least = np.empty(len(x), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(value[order], edge), np.diff(np.append(edge, len(order))))
    return least[place], begin


def _replies(rows: pa.Table, length: int) -> pa.RecordBatch:
    """The replies to rows sorted by anchor and bytes, whole anchors: the least doc_id of
    each window (once if all windows have the same), if smaller than the row's greatest."""
    raw = rows.column("bytes").combine_chunks()
    anchor, chunk, name, low, high = (rows.column(c).to_numpy() for c in ("anchor", "chunk", "name", "low", "high"))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | pc.not_equal(raw[1:], raw[:-1]).to_numpy(zero_copy_only=False)
    at, text = np.flatnonzero(new), np.cumsum(new) - 1
    buf, off = text_buffer(raw.take(pa.array(at)).cast(pa.large_binary()).view(pa.large_string()))
    least, begin = least_ids(buf, off, np.minimum.reduceat(low, at), length)
    bottom, top = np.minimum.reduceat(least, begin[:-1]), np.maximum.reduceat(least, begin[:-1])
    told = np.flatnonzero(bottom[text] < high)
    t = text[told]
    size = np.where(bottom[t] == top[t], 1, np.diff(begin)[t])
    ends = np.concatenate([[0], np.cumsum(size)])
    values = least[np.arange(ends[-1]) - np.repeat(ends[:-1] - begin[t], size)]
    return pa.RecordBatch.from_arrays([pa.array(chunk[told]), pa.array(name[told]), binaries(values, ends)], names=["chunk", "name", "least"])


def _judge(batches: Iterator[pa.RecordBatch], length: int, size: int) -> Iterator[pa.RecordBatch]:
    """Segments sorted by anchor and bytes, in tables of whole anchors of about ``size`` bytes."""
    held, weight, enough = [], 0, 2 * size
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        weight += batch.nbytes
        if weight >= enough:
            rows = pa.Table.from_batches(held)
            anchor = rows.column("anchor").to_numpy()
            last = int(np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))[-1])  # the last anchor may go on
            if last:
                yield _replies(rows.slice(0, last), length)
                rows = rows.slice(last).combine_chunks()
            held, weight = rows.to_batches(), rows.nbytes
            enough = 2 * max(size, weight)
    if held:
        yield _replies(pa.Table.from_batches(held), length)


def _kept(length: int):
    def kept(chunks: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(chunks.to_pylist()[0])
        cover = np.zeros(len(chunk.buf) + 1, np.int64)
        if replies.num_rows:
            told = replies.column("name").to_numpy()
            all_anchors = chunk.anchors(length)[2]
            run, alone = all_anchors[told // (length + 1)], told % (length + 1) > 0
            first, n, _, doc, name, number, lead = chunk.distinct(np.unique(run), np.unique(run[alone]), length)
            values, off = text_buffer(replies.column("least").combine_chunks().cast(pa.large_binary()).view(pa.large_string()))
            values, off = values.view(np.int64), off // 8
            # each segment's reply, by the name of its first occurrence
            order = np.argsort(told)
            at = np.searchsorted(told[order], name[lead])
            has = (at < len(told)) & (told[order][np.minimum(at, len(told) - 1)] == name[lead])
            reply = np.where(has, order[np.minimum(at, len(told) - 1)], -1)[number]
            some = np.flatnonzero(reply >= 0)
            first, n, doc, reply = first[some], n[some], doc[some], reply[some]
            turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            same = np.diff(off)[reply] == 1
            least = values[np.repeat(off[:-1][reply], n) + np.where(np.repeat(same, n), 0, turn)]
            goes = least < np.repeat(chunk.ids[doc], n)
            lost = (np.repeat(first, n) + turn)[goes]
            cover += np.bincount(lost, minlength=len(cover)) - np.bincount(lost + length, minlength=len(cover))
        gone = np.cumsum(cover[:-1]) > 0
        off = chunk.off
        total = np.concatenate([[0], np.cumsum(gone)])
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        inner = off[:-1][off[:-1] < len(gone)]
        opens[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(opens)])
        digests = []
        for a, b in zip(off[:-1], off[1:]):
            left = chunk.buf[a:b] if total[b] == total[a] else chunk.buf[a:b][~gone[a:b]]
            digests.append(hashlib.sha256(left.tobytes()).hexdigest())
        removed, runs = total[off[1:]] - total[off[:-1]], spans[off[1:]] - spans[off[:-1]]
        return pa.Table.from_arrays([pa.array(chunk.ids, mask=~chunk.known), pa.array(chunk.size), pa.array(np.where(chunk.copy, chunk.size, removed)),
                                     pa.array(np.where(chunk.copy, 1, runs)), pa.array(digests, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return kept


# ------------------------------------------------------------------ Spark side

def remove_repeats(docs: DataFrame, length: int = LENGTH, chunk: int = CHUNK, hot: int = HOT, batch: int = BATCH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans
    (maximal runs), kept_sha256."""
    spark = docs.sparkSession
    n = partitions(spark)
    texts = small_batches(docs).select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text"))
    whole = written(texts.mapInArrow(lean(_chunks, chunk), CHUNKS + ", digests binary"), "texts")
    named = whole.drop("off", "text").mapInArrow(lambda b: _named(b, length), "chunk long, place long, id long, digest binary")
    first = named.groupBy("digest").agg(F.min("id").alias("low"))
    copies = named.join(first, "digest").where("id > low").select("chunk", "place")
    chunks = written(whole.drop("digests").groupBy("chunk").cogroup(copies.groupBy("chunk")).applyInArrow(_marked, CHUNKS), "chunks")
    discard(whole)
    met = chunks.mapInArrow(lean(_met, length), "anchor long, chunk long, n long")
    dealt = met.repartition(n, "anchor").sortWithinPartitions("anchor")
    shared = written(dealt.mapInArrow(lean(_shared, hot), "chunk long, anchor long, hot boolean"), "shared")
    segments = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_deal(length), "anchor long, bytes binary, chunk long, name long, low long, high long")
    sorted_ = segments.repartition(n, "anchor").sortWithinPartitions("anchor", "bytes")
    replies = written(sorted_.mapInArrow(lean(_judge, length, batch), "chunk long, name long, least binary"), "replies")
    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_kept(length), RESULT)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT r, doc_id, h, length(h) // 2 AS n FROM d),
-- every string of 50 bytes, cut from pieces of the text so that no cut scans it all
piece AS (SELECT r, doc_id, n, s, substr(h, (2 * s + 1)::BIGINT, 1122) AS h FROM n, unnest(range(0, greatest(n - 49, 0), 512)) AS u(s)),
win AS (SELECT r, doc_id, s + k AS p, substr(h, (2 * k + 1)::BIGINT, 100) AS w FROM piece, unnest(range(0, least(512, n - 49 - s))) AS v(k)),
low AS (SELECT w, min(doc_id) AS low FROM win GROUP BY w),
lost AS (SELECT r, p FROM win JOIN low USING (w) WHERE low < doc_id),
-- lost windows at most 50 apart run together
step AS (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 50 THEN 0 ELSE 1 END AS opens FROM lost),
run AS (SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM step),
span AS (SELECT r, run, min(p) AS a, max(p) + 50 AS b FROM run GROUP BY r, run),
rest AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS prev FROM span),
gone AS (
  SELECT r, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
    string_agg(substr(h, (2 * prev + 1)::BIGINT, (2 * (a - prev))::BIGINT), '' ORDER BY a) AS kept
  FROM rest JOIN n USING (r) GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, (2 * coalesce(last, 0) + 1)::BIGINT))) AS kept_sha256
FROM n LEFT JOIN gone USING (r)
"""
