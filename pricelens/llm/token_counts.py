"""Count-only Viterbi: how many pieces a unigram tokenizer cuts a text into.

The pieces and scores of a SentencePiece model are taken as a unigram vocabulary.
An Aho-Corasick automaton enumerates the pieces in a chunk; dynamic programming
carries, for each place, the best score and the number of pieces of the best way
there, nothing else.  Tie rules are the tokenizer's: places are reached from earlier
starts first, and only a better score replaces a way, so of equal ways the one whose
last piece is longest stays.  A character without a piece of its own costs the least
score of the vocabulary less 10 and counts as its bytes where the model falls back
to bytes, else a run of them counts as one.

A blank becomes U+2581, and one more stands before a text.  No
piece holds U+2581 behind another character, so a best way always cuts there: chunks
are counted alone, and each distinct chunk of a slice once, with a bounded cache.
Scores are added in double precision, where these vocabularies' scores (whole
numbers) add up exactly; a library that adds in single precision agrees as long as
its sums stay exact (below 2**24).

Defined cases: null or empty texts have 0 pieces and score 0; repeated rows are
counted each; an empty table gives an empty result; other columns are passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from .common import chunk_hashes, row_of, slices, text_buffer

BLANK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 300_000


class UnigramCounter:
    def __init__(self, pieces: dict[str, float], fall_back_to_bytes: bool):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.pieces = pieces
        self.unknown = (min(pieces.values()) if pieces else 0.0) - UNKNOWN_PENALTY
        self.bytes = fall_back_to_bytes
        self.keys, self.counts, self.scores = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)

    @classmethod
    def from_sentencepiece(cls, path: str) -> "UnigramCounter":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))}
        return cls(normal, any(sp.is_byte(i) for i in range(sp.get_piece_size())))

    def count(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a text whose blanks are U+2581."""
        n = len(text)
        best, number, run = [None] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        best[0] = 0.0
        ways: list[list] = [[] for _ in range(n + 1)]
        for end, (size, score) in self.automaton.iter(text):
            ways[end + 1].append((size, score))
        for end in range(1, n + 1):
            single = False
            for size, score in sorted(ways[end], reverse=True):  # earliest start first
                total = best[end - size] + score
                single = single or size == 1
                if best[end] is None or total > best[end]:
                    best[end], number[end], run[end] = total, number[end - size] + 1, False
            if not single:
                total = best[end - 1] + self.unknown
                if best[end] is None or total > best[end]:
                    more = len(text[end - 1].encode()) if self.bytes else 0 if run[end - 1] else 1
                    best[end], number[end], run[end] = total, number[end - 1] + more, True
        return number[n], best[n]

    def slice_counts(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and scores of the texts of a buffer."""
        if len(self.keys) > CACHE:
            self.keys, self.counts, self.scores = self.keys[:0], self.counts[:0], self.scores[:0]
        n = len(off) - 1
        first = np.zeros(len(buf) + 1, bool)
        blank = buf == 32
        first[:-1] = blank
        first[1:-1] &= ~blank[:-1]  # a run of blanks stays together
        edge = off[:-1][np.diff(off) > 0]
        first[edge] = True
        start = np.flatnonzero(first[:-1])
        stop = np.append(start[1:], len(buf))
        text = np.searchsorted(off, start, side="right") - 1
        head = np.zeros(len(buf) + 1, bool)
        head[edge] = True
        lead = head[start]  # these get the blank that stands before a text
        keys, where, index = np.unique(chunk_hashes(buf, start, stop) ^ (lead * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_inverse=True)
        near = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[near] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            raw = buf.tobytes()
            got = [self.count(BLANK * bool(b) + raw[x:y].decode().replace(" ", BLANK)) for x, y, b in zip(start[where[new]], stop[where[new]], lead[where[new]])]
            at = np.searchsorted(self.keys, keys[new])
            self.keys = np.insert(self.keys, at, keys[new])
            self.counts, self.scores = np.insert(self.counts, at, [c for c, _ in got]), np.insert(self.scores, at, [s for _, s in got])
        at = np.searchsorted(self.keys, keys)[index]
        return np.bincount(text, weights=self.counts[at], minlength=n).astype(np.int64), np.bincount(text, weights=self.scores[at], minlength=n)


def _counted(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    counter = UnigramCounter.from_sentencepiece(path)
    for batch in batches:
        buf, off = text_buffer(batch.column("_text"))
        got = [counter.slice_counts(buf[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in slices(off)]
        counts, scores = (np.concatenate([np.zeros(0, kind), *(g[k] for g in got)]) for k, kind in enumerate((np.int64, np.float64)))
        yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(counts), pa.array(scores)], names=["_row", "n_pieces", "best_score"])


def count_pieces(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """_row (a struct of ``keep``, by default all columns), n_pieces and best_score of
    each whole text."""
    ready = docs.select(row_of(docs, keep), F.col("text").cast("string").alias("_text"))
    schema = StructType([ready.schema["_row"]]).add("n_pieces", LongType()).add("best_score", DoubleType())
    return ready.mapInArrow(lambda b: _counted(b, path), schema)


def vocabulary_path() -> str:
    import public_tokenizers as P

    return P.path("piece_bpe_32k.model")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_pieces(docs, vocabulary_path(), keep=["doc_id"]).select("_row.doc_id", "n_pieces", "best_score")
