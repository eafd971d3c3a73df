"""Best-two-fit packing of tokenised documents into sequences of ``capacity`` tokens.

A document is its token ids and one end id.  Only documents longer than a sequence
are cut, into pieces of the full length, the first piece taking the rest.

Best-two-fit fills a sequence greedily, always with the longest piece left that
fits; then it tries to replace the smallest piece by the two pieces left that fill
the widened gap best, if they fill more than that piece does.  Pieces of one length
are alike, so the driver packs *counts by length* (at most ``capacity`` numbers,
whatever the input): the same pattern of lengths is repeated as long as every
length in it lasts, which gives exactly the sequences that packing one by one gives.
The plan has a few entries for each length.  Every piece then finds its place from
its rank among the pieces of its length; ranks come from a range partitioning, so a
length that holds a third of all pieces is spread over many tasks.

Defined cases: null text is empty (the end id alone, length 1); an empty table packs
into nothing; repeated rows are packed once each, also under one doc_id or a null
one; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunk_hashes, cut, lean, partitions, slices, small_batches, text_buffer, written

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACES = PIECES + ", sequence_id long, offset long"
_CACHE_CHUNKS = 400_000
_SPECIAL = b"<|endoftext|>"
_BLANK = 32
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


class ByteBpe:
    """Token ids of a byte-level BPE as the tokenizer file gives them.

    A single blank between two other characters always begins a pre-token, so a
    text can be encoded as its blank-led chunks.  Distinct chunks of a slice, known
    by a 64-bit hash, are encoded once and kept for the next slices (up to a bound
    of chunks); the ids are then gathered, without a Python step for each word.
    Texts with blanks beside other white space, or white space beyond ASCII, are
    encoded whole; those that hold the special token's string go through the
    tokenizer itself.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.path, self._tokenizer = path, None
        self.bpe = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)
        self._reset()

    def _reset(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # sorted hashes, place in off
        self.ids, self.off = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        """By the tokenizer itself, which is only loaded if a text needs it."""
        from tokenizers import Tokenizer

        self._tokenizer = self._tokenizer or Tokenizer.from_file(self.path)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _ids(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text).astype(np.uint32)

    def _odd(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Texts that can't be cut at blanks."""
        white = _WHITE[buf]
        blank = buf == _BLANK
        bad = np.zeros(len(buf), bool)
        bad[1:] = blank[1:] & white[:-1] | white[1:] & blank[:-1]
        for lead, tails in ((b"\xc2", (b"\x85", b"\xa0")), (b"\xe1", (b"\x9a\x80",)), (b"\xe2", (b"\x80", b"\x81\x9f")), (b"\xe3", (b"\x80\x80",))):
            at = np.flatnonzero(buf[:-1] == lead[0])
            for tail in tails:
                hit = at[at + len(tail) < len(buf)]
                for k, x in enumerate(tail):
                    hit = hit[buf[hit + 1 + k] == x]
                if tail == b"\x80":  # general punctuation: only its spaces and separators
                    third = buf[np.minimum(hit + 2, len(buf) - 1)]
                    hit = hit[(third <= 0x8A) | (third == 0xA8) | (third == 0xA9) | (third == 0xAF)]
                bad[hit] = True
        has = np.zeros(len(off) - 1, bool)
        has[np.searchsorted(off, np.flatnonzero(bad), side="right") - 1] = True
        full = np.flatnonzero(np.diff(off))
        has[full[blank[off[full]] | blank[off[full + 1] - 1]]] = True
        if _SPECIAL in (raw := buf.tobytes()):
            has |= np.array([_SPECIAL in raw[a:b] for a, b in zip(off, off[1:])])
        return has

    def _learn(self, keys: np.ndarray, chunks: list[bytes]) -> None:
        led = [k for k, c in enumerate(chunks) if c[0] == _BLANK]
        heads = [k for k, c in enumerate(chunks) if c[0] != _BLANK]
        ids = [self._ids(b"".join([chunks[k] for k in led]).decode()), *(self._ids(chunks[k].decode()) for k in heads)]
        ends = np.cumsum(np.fromiter((len(chunks[k]) for k in led), np.int64, len(led)))
        upto = np.searchsorted(np.cumsum(self.width[ids[0]]), ends, side="left") + 1
        upto = np.concatenate([upto, len(ids[0]) + np.cumsum([len(x) for x in ids[1:]], dtype=np.int64)])
        place = np.empty(len(chunks), np.int64)
        place[led + heads] = len(self.off) - 1 + np.arange(len(chunks))
        self.off = np.concatenate([self.off, upto + self.off[-1]])
        self.ids = np.concatenate([self.ids, *ids])
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at = np.insert(self.keys, where, keys), np.insert(self.at, where, place)

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and their offsets."""
        if len(self.keys) > _CACHE_CHUNKS:
            self._reset()
        odd = self._odd(buf, off) if len(buf) else np.zeros(len(off) - 1, bool)
        first = np.zeros(len(buf) + 1, bool)
        first[:-1] = buf == _BLANK
        first[off] = True
        start = np.flatnonzero(first[:-1])
        stop = np.append(start[1:], len(buf))
        text = np.searchsorted(off, start, side="right") - 1
        plain = ~odd[text]
        start, stop, text = start[plain], stop[plain], text[plain]
        hashes, where, number = np.unique(chunk_hashes(buf, start, stop), return_index=True, return_inverse=True)
        near = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        new = self.keys[near] != hashes if len(self.keys) else np.ones(len(hashes), bool)
        if new.any():
            raw = buf.tobytes()
            self._learn(hashes[new], [raw[a:b] for a, b in zip(start[where[new]], stop[where[new]])])
        at = self.at[np.searchsorted(self.keys, hashes)][number]
        size = self.off[at + 1] - self.off[at]
        ends = np.cumsum(size)
        flat = self.ids[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.off[at] - (ends - size), size)]
        lengths = np.bincount(text, weights=size, minlength=len(off) - 1).astype(np.int64)
        if not odd.any():
            return flat, np.concatenate([[0], np.cumsum(lengths)])
        parts, done = [], 0
        for k in range(len(off) - 1):
            if odd[k]:
                raw = buf[off[k] : off[k + 1]].tobytes()
                ids = self._whole(raw.decode()) if _SPECIAL in raw else self._ids(raw.decode())
                lengths[k] = len(ids)
                parts.append(ids)
            else:
                parts.append(flat[done : done + lengths[k]])
                done += lengths[k]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])


def _pieces(batches: Iterator[pa.RecordBatch], files: tuple[str, str, str], capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    bpe = ByteBpe(*files)
    for batch in batches:
        buf, off = text_buffer(batch.column("text"))
        names = batch.column("doc_id").to_pylist()
        for i, j in slices(off):
            rows: list[tuple] = []
            ids, at = bpe.encode(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            for k in range(j - i):
                own = np.append(ids[at[k] : at[k + 1]], np.uint32(end_id)).astype("<u4")
                first = len(own) % capacity or capacity
                start = 0
                for p, end in enumerate(range(first, len(own) + 1, capacity)):
                    rows.append((names[i + k], p, start, end - start, zlib.crc32(own[start:end])))
                    start = end
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])


def tokenizer_files() -> tuple[str, str, str]:
    """Places of the public byte-level BPE and its pattern: the default parameter."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def token_pieces(docs: DataFrame, files: tuple[str, str, str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    files = files or tokenizer_files()
    return small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lean(_pieces, files, capacity, end_id), PIECES)


def _best_pair(left: np.ndarray, gap: int, more_than: int) -> tuple[int, int] | None:
    """Lengths a >= b still left with the largest a + b in (more_than, gap]; the
    longest a among equals."""
    have = np.flatnonzero(left)
    have = have[have < gap]
    if not len(have):
        return None
    other = np.searchsorted(have, gap - have, side="right") - 1  # longest b that fits beside each a
    other = np.minimum(other, np.arange(len(have)))
    twice = (other == np.arange(len(have))) & (left[have] < 2)
    other = np.where(twice, other - 1, other)
    total = np.where(other >= 0, have + have[np.maximum(other, 0)], 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(have[best]), int(have[other[best]])) if total[best] > more_than else None


def best_two_fit(counts: np.ndarray) -> list[tuple[list[int], int]]:
    """Patterns of a packing of counts[length] pieces into sequences of len(counts)-1
    tokens: (lengths in order, how often), the same as packing piece by piece."""
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    plan = []
    while left.any():
        pattern, room, now = [], capacity, left.copy()
        while room:
            have = np.flatnonzero(now[: room + 1])
            if not len(have):
                break
            longest = int(have[-1])
            n = int(min(now[longest], room // longest))
            pattern += [longest] * n
            now[longest] -= n
            room -= n * longest
        if room and len(pattern) > 1:
            smallest = pattern[-1]
            if pair := _best_pair(now, room + smallest, smallest):
                pattern[-1:] = pair
        used = np.bincount(pattern, minlength=capacity + 1)
        kinds = np.flatnonzero(used)
        # Each of these choices stands while every length of the pattern lasts and no
        # length comes back; the replaced smallest piece must also stay available.
        times = int((left[kinds] // used[kinds]).min())
        left -= used * times
        plan.append((pattern, times))
    return plan


def _segments(plan: list[tuple[list[int], int]], capacity: int) -> np.ndarray:
    """Rows (length, first rank, last rank + 1, first sequence, first offset, times):
    rank r lies in slot (r - first) // times of sequence first + (r - first) % times."""
    rows, taken, sequence = [], np.zeros(capacity + 1, np.int64), 0
    for pattern, times in plan:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            n = pattern.count(length)
            rows.append((length, taken[length], taken[length] + n * times, sequence, offset, times))
            taken[length] += n * times
            offset += n * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def _place(batches: Iterator[pa.RecordBatch], segments: np.ndarray, before: dict[int, list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    """Ranks of a partition's pieces (sorted by length) and their places."""
    part = TaskContext.get().partitionId()
    begun = dict(before.get(part, ()))
    wide = int(segments[:, 2].max()) + 1 if len(segments) else 1
    keys = segments[:, 0] * wide + segments[:, 1]
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = np.empty(len(length), np.int64)
        for n in np.unique(length):
            own = np.flatnonzero(length == n)
            rank[own] = begun[int(n)] + np.arange(len(own))
            begun[int(n)] += len(own)
        s = segments[np.searchsorted(keys, length * wide + rank, side="right") - 1]
        slot, turn = np.divmod(rank - s[:, 1], s[:, 5])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s[:, 3] + turn), pa.array(s[:, 4] + slot * length)],
                                         names=[*batch.schema.names, "sequence_id", "offset"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``, doc_id, piece) with
    sequence_id and offset."""
    spark = pieces.sparkSession
    spread = F.xxhash64("doc_id", "piece", "ids_crc32")
    ranged = cut(pieces.repartitionByRange(partitions(spark), "length", spread).sortWithinPartitions("length", spread))
    # at most one row for each partition and each length that a partition holds; the
    # range partitions give partitions + capacity rows together
    held = ranged.groupBy(F.spark_partition_id().alias("part"), "length").count().orderBy("length", "part").collect()
    counts, before = np.zeros(capacity + 1, np.int64), {}
    for row in held:
        before.setdefault(row["part"], []).append((row["length"], int(counts[row["length"]])))
        counts[row["length"]] += row["count"]
    segments = _segments(best_two_fit(counts), capacity)
    return ranged.select("doc_id", "piece", "start", "length", "ids_crc32").mapInArrow(lean(_place, segments, before), PLACES)


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pack_documents(docs: DataFrame, files: tuple[str, str, str] | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenise once (the pieces, without texts, are written), then pack."""
    return pack(written(token_pieces(docs, files, capacity, end_id), "pieces"), capacity)
