"""Language-model scores with Katz backoff over words and their bigrams.

Tokens are the words of a text and one end token; the context of the first is the
start.  Unigrams and bigrams are Good-Turing discounted for counts up to ``k``:

    P(w | v) = d(c(v w)) c(v w) / c(v)      if the bigram was seen in training
             = alpha(v) P(w)                otherwise,
    P(w)     = d(c(w)) c(w) / N             if the word was seen
             = what the discounts leave     for any unknown word (one class),

and alpha(v) makes the probabilities of v's continuations sum to 1 exactly.

Counts live in tables partitioned by a hash of the n-gram.  The corpus is held as
chunks of about ``chunk_tokens`` tokens, each with its own vocabulary.  A chunk sends
every distinct key once to the key's partition, with its count; the partition adds
up and answers each chunk in the order in which it was asked.  So a word or bigram
with a third of all tokens is one entry per chunk, and each task holds about as much
as a chunk.  The sums behind alpha(v) are gathered in the same way: one chunk, the
owner, contributes a seen bigram.

Special cases of the estimates: a Good-Turing discount outside (0, 1) is replaced by
(r - D) / r with D = n1 / (n1 + 2 n2), at most 0.9, or 0.5 without such counts; if the
unigram discounts leave less for unknown words than adding one half to each count
would, that smoothing is used; a context whose continuations all exceed k, so that
nothing is left, gives up 1 / (c(v) + 1).

Defined cases: a null or empty text is the end token alone; rows with a null doc_id
are training rows; without training tokens every probability is that of the one
unknown class, 1; repeated rows count and are scored each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import REPLY, SENT, Words, arrow_table, in_fold, mix, packed, partitions, sent, slices, small_batches, text_buffer, unpacked, written

K = 5
CHUNK_TOKENS = 1 << 20
END, START = np.uint64(0xE4D0FF1CE0000001), np.uint64(0x57A27000000000FF)
_LEFT, _RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F)
CHUNK = "chunk long, ids binary, known_ids binary, train binary, first binary, tokens binary, vocabulary binary"
STATE = SENT + ", docs binary"


def _planes(x: np.ndarray) -> np.ndarray:
    """uint32 values byte by byte: their mostly empty high bytes compress away."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T


def _chunked(batches: Iterator[pa.RecordBatch], chunk_tokens: int) -> Iterator[pa.RecordBatch]:
    base, made = TaskContext.get().partitionId() << 24, 0
    ids, known, train, counts, parts = [], [], [], [], []

    def out():
        nonlocal base, made
        words = np.concatenate(parts)
        vocabulary, index, times = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")  # frequent words get small numbers
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = [base + made, packed(np.array(ids, np.int64)), packed(np.array(known)), packed(np.array(train)),
               packed(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)), packed(_planes(place[index])), packed(vocabulary[order])]
        made += 1
        return pa.RecordBatch.from_arrays([pa.array([row[0]]), *(pa.array([x], pa.binary()) for x in row[1:])], names=[c.split()[0] for c in CHUNK.split(", ")])

    held = 0
    for batch in batches:
        buf, off = text_buffer(batch.column("text"))
        names, flags = batch.column("doc_id").to_pylist(), batch.column("train").to_pylist()
        for i, j in slices(off):
            w = Words(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            tokens = np.insert(w.hash, w.first[1:], END)
            parts.append(tokens)
            counts += (w.counts + 1).tolist()
            ids += [x or 0 for x in names[i:j]]
            known += [x is not None for x in names[i:j]]
            train += flags[i:j]
            held += len(tokens)
            if held >= chunk_tokens:
                yield out()
                ids, known, train, counts, parts, held = [], [], [], [], [], 0
    if ids:
        yield out()


class Chunk:
    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids, self.known = unpacked(row["ids"], np.int64), unpacked(row["known_ids"], bool)
        self.train, self.first = unpacked(row["train"], bool), unpacked(row["first"], np.int64)
        tokens = unpacked(row["tokens"], np.uint8).reshape(4, -1).T
        self.tokens = np.ascontiguousarray(tokens).view("<u4").ravel().astype(np.int64)
        self.names = np.append(unpacked(row["vocabulary"], np.uint64), START)  # the start is the last
        self.text = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.weight = self.train[self.text]

    def unigrams(self):
        """Sorted names, their order, and counts in training texts."""
        count = np.bincount(self.tokens, weights=self.weight, minlength=len(self.names)).astype(np.int64)
        count[-1] = self.train.sum()
        order = np.argsort(self.names)
        return self.names[order], order, count[order]

    def bigrams(self):
        """Sorted keys, first place of each, number of each token's, training counts."""
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[self.first[:-1]] = len(self.names) - 1
        key = mix(self.names[context] * _LEFT + self.names[self.tokens] * _RIGHT)
        keys, place, number = np.unique(key, return_index=True, return_inverse=True)
        return context, keys, place, number, np.bincount(number, weights=self.weight, minlength=len(keys)).astype(np.int64)


def _sender(buckets: int, order: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                if order == 1:
                    keys, _, count = c.unigrams()
                else:
                    _, keys, _, _, count = c.bigrams()
                yield from arrow_table(sent(c.number, keys, count, buckets), SENT).to_batches()
    return send


def _add_up(table: pa.Table) -> pa.Table:
    """A partition of counts: the answers, (count, owner) per asked key, and a row of
    chunk -1 with n_1 ... n_(K+1), the sum and the number of seen keys."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    keys = [unpacked(r["keys"], np.uint64) for r in rows]
    at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    names, place, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(number, weights=np.concatenate([unpacked(r["vals"], np.int64) for r in rows])).astype(np.int64)
    owner = np.zeros(at[-1], np.int64)
    owner[place] = 1
    answer = total[number] * 2 + owner
    seen = total[(total > 0) & (names != START)]
    stats = np.concatenate([np.bincount(np.minimum(seen, K + 2), minlength=K + 3)[1 : K + 2], [seen.sum(), len(seen)]])
    out = [(r["chunk"], r["bucket"], packed(answer[a:b])) for r, a, b in zip(rows, at, at[1:])]
    return arrow_table([*out, (-1, rows[0]["bucket"], packed(stats.astype(np.int64)))], REPLY)


def good_turing(n: np.ndarray, k: int = K) -> np.ndarray:
    """d[r] for r = 0 ... k + 1 (d[k + 1] = 1 stands for all larger counts), from
    n[r - 1] = number of types with count r."""
    d = np.ones(k + 2)
    n = n.astype(float)
    low = min(0.9, n[0] / (n[0] + 2 * n[1])) if n[0] and n[1] else 0.5
    common = (k + 1) * n[k] / n[0] if n[0] else 0.0
    for r in range(1, k + 1):
        star = (r + 1) * n[r] / (r * n[r - 1]) if n[r - 1] else 0.0
        gt = (star - common) / (1 - common) if common < 1 else 0.0
        d[r] = gt if 0 < gt < 1 else (r - low) / r
    return d


class Estimates:
    """What the driver keeps of the model: a few numbers."""

    def __init__(self, uni: np.ndarray, bi: np.ndarray, k: int = K):
        self.n, self.v = int(uni[-2]), int(uni[-1])
        self.d1, self.d2 = good_turing(uni[: k + 1], k), good_turing(bi[: k + 1], k)
        left = ((1 - self.d1[1 : k + 1]) * np.arange(1, k + 1) * uni[:k]).sum() / max(self.n, 1)
        self.floor = 0.5 / (self.n + 0.5 * (self.v + 1))
        self.half = left < self.floor
        self.unknown = self.floor if self.half else left

    def base(self, c: np.ndarray) -> np.ndarray:
        return (c + 0.5) / (self.n + 0.5 * (self.v + 1))

    def unigram(self, c: np.ndarray) -> np.ndarray:
        if self.half:
            return self.base(c)
        return np.where(c > 0, self.d1[np.minimum(c, K + 1)] * c / max(self.n, 1), self.unknown)


def _gather(replies: list[dict], which: int) -> np.ndarray:
    own = sorted((r for r in replies if r["which"] == which), key=lambda r: r["bucket"])
    return np.concatenate([unpacked(r["vals"], np.int64) for r in own])


def _scorer(est: Estimates, buckets: int):
    """A chunk with the answers to it: its documents' scores but for what depends on
    alpha, the (text, context) counts that do, and its sums for each context."""
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return arrow_table([], STATE)
        c, replies = Chunk(left.to_pylist()[0]), right.to_pylist()
        names, order, _ = c.unigrams()
        c1 = np.empty(len(names), np.int64)
        c1[order] = _gather(replies, 1) >> 1
        context, keys, place, number, _ = c.bigrams()
        answer = _gather(replies, 2)
        c2, owner = answer >> 1, answer & 1
        v, w = context[place], c.tokens[place]  # of each distinct bigram
        p1 = est.unigram(c1[w])
        seen = c2 > 0
        d = est.d2[np.minimum(c2, K + 1)] * c2
        logp = np.log10(np.where(seen, d / np.maximum(c1[v], 1), p1))
        n = len(c.ids)
        docs = np.stack([np.diff(c.first), np.bincount(c.text, weights=c1[c.tokens] > 0, minlength=n), np.bincount(c.text, weights=np.log10(est.base(c1[c.tokens])), minlength=n),
                         np.bincount(c.text, weights=logp[number], minlength=n)])
        own = seen & (owner == 1)
        s1 = np.bincount(v[own], weights=d[own], minlength=len(names))
        s2 = np.bincount(v[own], weights=p1[own], minlength=len(names))
        # contexts of unseen bigrams need alpha; those without a rare continuation
        # here may turn out to have nothing left
        rare = np.zeros(len(names), bool)
        rare[v[seen & (c2 <= K)]] = True
        token_seen = seen[number]
        open_ = ~token_seen | ~rare[context]
        code, times = np.unique((c.text[open_] * len(names) + context[open_]) * 2 + token_seen[open_], return_counts=True)
        vals = np.stack([s1, s2, c1], 1)[order]
        place_of = np.empty(len(names), np.int64)
        place_of[order] = np.arange(len(names))
        which = place_of[code // 2 % len(names)]
        needs = np.stack([code // 2 // len(names), which, code % 2, times])
        rows = [(*r, None) for r in sent(c.number, names[: len(names)], vals, buckets)]
        state = [packed(x) for x in (needs.astype(np.int64), docs)]
        return arrow_table([*rows, (c.number, -1, *state, _ids(c))], STATE)
    return score


def _ids(c: Chunk) -> bytes:
    return packed(np.stack([c.ids, c.known.astype(np.int64)]))


def _weights(unknown: float):
    """A partition of contexts: log10 alpha and log10 of what seen ones keep."""
    def weigh(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        keys = [unpacked(r["keys"], np.uint64) for r in rows]
        vals = np.concatenate([unpacked(r["vals"], np.float64).reshape(-1, 3) for r in rows])
        at = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
        _, place, number = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        s1, s2 = np.bincount(number, weights=vals[:, 0]), np.bincount(number, weights=vals[:, 1])
        count = vals[place, 2]
        left = 1 - s1 / np.maximum(count, 1)
        none = left < 1e-12
        left = np.where(none, 1 / (count + 1), left)
        alpha = np.where(count > 0, left / np.maximum(1 - s2, unknown), 1)
        kept = np.where(none & (count > 0), count / (count + 1), 1)
        answer = np.log10(np.stack([alpha, kept], 1))[number]
        return arrow_table([(r["chunk"], r["bucket"], packed(answer[a:b])) for r, a, b in zip(rows, at, at[1:])], REPLY)
    return weigh


RESULT = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _finisher(train_tokens: int):
    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return arrow_table([], RESULT)
        row = left.to_pylist()[0]
        needs, docs = unpacked(row["keys"], np.int64).reshape(4, -1), unpacked(row["vals"], np.float64).reshape(4, -1)
        ids, known = unpacked(row["docs"], np.int64).reshape(2, -1)
        weights = np.concatenate([unpacked(r["vals"], np.float64).reshape(-1, 2) for r in sorted(right.to_pylist(), key=lambda r: r["bucket"])])
        text, context, seen, times = needs
        more = np.bincount(text, weights=times * weights[context, seen], minlength=len(ids))
        return pa.Table.from_arrays([pa.array(ids, mask=known == 0), pa.array(docs[0].astype(np.int64)), pa.array(docs[1].astype(np.int64)),
                                     pa.array(np.full(len(ids), train_tokens)), pa.array(docs[2]), pa.array(docs[3] + more)], names=[f.split()[0] for f in RESULT.split(", ")])
    return finish


def _sums(replies: DataFrame) -> np.ndarray:
    """The statistics rows of the partitions, added up (K + 3 numbers a partition)."""
    rows = replies.where("chunk = -1").select("vals").collect()
    return np.sum([unpacked(r["vals"], np.int64) for r in rows], axis=0) if rows else np.zeros(K + 3, np.int64)


def katz_scores(docs: DataFrame, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """``docs``: doc_id, text, train (boolean).  One row per row: doc_id, n_tokens,
    n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce("train", F.lit(True)).alias("train"))
    chunks = written(rows.mapInArrow(lambda b: _chunked(b, chunk_tokens), CHUNK), "chunks")
    buckets = max(chunks.count(), partitions(spark))
    replies = [written(chunks.mapInArrow(_sender(buckets, order), SENT).groupBy("bucket").applyInArrow(_add_up, REPLY), f"counts{order}") for order in (1, 2)]
    est = Estimates(*(_sums(r) for r in replies))
    answers = replies[0].withColumn("which", F.lit(1)).union(replies[1].withColumn("which", F.lit(2))).where("chunk >= 0")
    state = written(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scorer(est, buckets), STATE), "state")
    weights = state.where("bucket >= 0").select("chunk", "bucket", "keys", "vals").groupBy("bucket").applyInArrow(_weights(est.unknown), REPLY)
    return state.where("bucket < 0").groupBy("chunk").cogroup(weights.select(*[F.col(c).alias(c) for c in weights.columns]).groupBy("chunk")).applyInArrow(_finisher(est.n), RESULT)


def op4_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (~in_fold("doc_id", 5, 1)).alias("train"))
    return katz_scores(docs).withColumn("held_out", in_fold("doc_id", 5, 1))
