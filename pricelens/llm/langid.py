"""Language identification of mixed-language text.

A word is a run of letters (ASCII letters and bytes beyond ASCII).  The script of its
first letter, by code point range, narrows the candidate languages to those that use
that script; the word's score for a candidate is the log-probability of its byte
trigrams, word ends included, in that language.  Viterbi over the words of a text,
with a penalty for each change of language, labels spans.  The text's language is
the one with the most letters in its spans (of equals, the first by name), and its
score that share of the letters.

Trigram counts are gathered from all training texts: each task adds up its own
tables, and their sums (languages x 2**16 numbers, whatever the input) make the model.

Defined cases: ``und`` with score 0 for a null text or one without a letter; letters
in a script that no training text uses get the most frequent language, score 0;
without training rows everything is ``und``; repeated rows are judged each; an empty
table gives an empty result; other columns are passed on, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType

from .common import in_fold, lean, row_of, row_texts, rows_and_texts, slices, small_batches, text_buffer

SWITCH = 10.0
SMOOTH = 0.5
GRAMS = 1 << 16
SCRIPTS = 16
ACCEPT = 0.5  # the least score that the pipeline keeps
_END = 32

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[~_LETTER] = _END
#: Script by the first byte of a letter; 0x100 marks that the second byte decides.
_SCRIPT = np.zeros(256, np.int64)
_SCRIPT[65:91] = _SCRIPT[97:123] = _SCRIPT[0xC3:0xCC] = 1  # Latin
_SCRIPT[0xCD:0xD0] = 2  # Greek
_SCRIPT[0xD0:0xD4] = 3  # Cyrillic
_SCRIPT[0xD4:0xD6] = 4  # Armenian
_SCRIPT[0xD6:0xD8] = 5  # Hebrew
_SCRIPT[0xD8:0xDC] = 6  # Arabic
_SCRIPT[0xE4:0xEA] = 11  # Han
_SCRIPT[0xEB:0xED] = 9  # Hangul
_SECOND = {0xE0: [(0xA4, 0xA6, 7), (0xB8, 0xBA, 8)], 0xE1: [(0x84, 0x88, 9), (0xB8, 0xBC, 1)], 0xE3: [(0x81, 0x84, 10), (0x90, 0xC0, 11)], 0xEA: [(0xB0, 0xC0, 9)], 0xED: [(0x80, 0x9F, 9)]}  # Devanagari, Thai; Hangul, Latin; Kana, Han


class Letters:
    """Words of letters of some texts, and the trigram of each of their bytes."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        letter = _LETTER[buf]
        self.at = np.flatnonzero(letter)
        b = _FOLD[buf]
        before, after = np.empty_like(b), np.empty_like(b)
        before[1:], after[:-1] = b[:-1], b[1:]
        full = np.flatnonzero(np.diff(off))
        before[off[full]] = _END
        after[off[full + 1] - 1] = _END
        code = before * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77) + after * np.uint32(0xC2B2AE3D)
        code ^= code >> np.uint32(15)
        self.gram = ((code * np.uint32(0x2C1B3C6D)) >> np.uint32(16)).astype(np.int64)[self.at]
        first = np.zeros(len(buf) + 1, bool)
        first[:-1] = letter & (before == _END)
        self.start = np.flatnonzero(first[self.at])  # among the letters
        self.begin = self.at[self.start] if len(self.at) else np.zeros(0, np.int64)
        self.size = np.diff(np.append(self.start, len(self.at)))
        self.first = np.searchsorted(self.begin, off)
        lead = buf[self.begin]
        self.script = _SCRIPT[lead]
        for head, ranges in _SECOND.items():
            own = np.flatnonzero(lead == head)
            second = buf[np.minimum(self.begin[own] + 1, max(len(buf) - 1, 0))]
            for lo, hi, script in ranges:
                self.script[own[(second >= lo) & (second < hi)]] = script
        self.text = np.repeat(np.arange(len(off) - 1), np.diff(self.first))


@dataclass
class Model:
    langs: list[str]
    logp: np.ndarray  # languages x GRAMS
    uses: np.ndarray  # languages x SCRIPTS, bool
    common: int  # the most frequent language


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """This task's counts: (lang, key, n), keys from GRAMS on are scripts."""
    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        buf, off = text_buffer(batch.column("text"))
        lang = np.array(batch.column("lang").to_pylist(), object)
        for i, j in slices(off):
            x = Letters(buf[off[i] : off[j]], off[i : j + 1] - off[i])
            names, number = np.unique(lang[i:j].astype(str), return_inverse=True)
            of_word = number[x.text]
            of_gram = np.repeat(of_word, x.size)
            for k, name in enumerate(names):
                t = tables.setdefault(name, np.zeros(GRAMS + SCRIPTS, np.int64))
                t[:GRAMS] += np.bincount(x.gram[of_gram == k], minlength=GRAMS)
                t[GRAMS:] += np.bincount(x.script[of_word == k], minlength=SCRIPTS)
    for name, t in tables.items():
        own = np.flatnonzero(t)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(own)), pa.array(own.astype(np.int32)), pa.array(t[own])], names=["lang", "key", "n"])


def fit(docs: DataFrame) -> Model | None:
    """``docs``: text and lang of the rows to learn from."""
    rows = small_batches(docs).select(F.col("text").cast("string"), F.col("lang").cast("string")).where("text is not null and lang is not null")
    got = rows.mapInArrow(lean(_counted), "lang string, key int, n long").groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    if not len(got):
        return None
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(langs), GRAMS + SCRIPTS))
    counts[np.searchsorted(langs, got["lang"].to_numpy()), got["key"].to_numpy()] = got["n"]
    grams, scripts = counts[:, :GRAMS], counts[:, GRAMS:]
    logp = np.log((grams + SMOOTH) / (grams.sum(1, keepdims=True) + SMOOTH * GRAMS))
    uses = scripts > 0.001 * np.maximum(scripts.sum(1, keepdims=True), 1)
    return Model(langs, logp.astype(np.float32), uses, int(grams.sum(1).argmax()))


def best_path(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Viterbi labels of the words of many texts at once: step t takes the t-th word
    of every text that has one.  Of equal ways a text stays in its language, and the
    first language wins."""
    count = np.diff(first)
    order = np.argsort(-count, kind="stable")
    begin, count = first[:-1][order], count[order]
    longest = int(count[0]) if len(count) else 0
    active = np.searchsorted(-count, -np.arange(longest), side="left")  # texts with more than t words
    n, langs = len(order), scores.shape[1]
    back = np.zeros(scores.shape, np.uint8 if langs < 256 else np.uint16)
    own = np.arange(langs)
    best = np.zeros((n, langs), np.float64)
    for t in range(longest):
        m = active[t]
        word = begin[:m] + t
        if t:
            v = best[:m]
            top = v.argmax(1)
            jump = v[np.arange(m), top] - switch
            stay = v >= jump[:, None]
            back[word] = np.where(stay, own, top[:, None])
            best[:m] = np.where(stay, v, jump[:, None]) + scores[word]
        else:
            best[:m] = scores[word]
    path = np.zeros(len(scores), np.int64)
    now = best.argmax(1) if n else np.zeros(0, np.int64)
    for t in range(longest - 1, -1, -1):
        m = active[t]
        word = begin[:m] + t
        path[word] = now[:m]
        now[:m] = back[word, now[:m]]
    return path


def _word_scores(x: Letters, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Scores of each word by language, and which words count."""
    out = np.empty((len(x.start), len(model.langs)), np.float32)
    allowed = model.uses[:, x.script].T
    known = allowed.any(1)
    for k in range(len(model.langs)):
        out[:, k] = np.add.reduceat(model.logp[k][x.gram], x.start) if len(x.start) else 0
    out -= out.max(1, keepdims=True) if len(out) else 0
    out[~allowed] = -1e4
    out[~known] = 0
    return out, known


def _judged(batches: Iterator[pa.RecordBatch], model: Model, spans: bool) -> Iterator[pa.RecordBatch]:
    langs = np.array([*model.langs, "und"], object)
    for batch in batches:
        buf, off = text_buffer(row_texts(batch))
        for i, j in slices(off, 1 << 22):  # Viterbi runs over many texts at once
            base, parts = off[i], []
            for a, b in slices(off[i : j + 1]):
                x = Letters(buf[off[i + a] : off[i + b]], off[i + a : i + b + 1] - off[i + a])
                s, known = _word_scores(x, model)
                parts.append((s, known, x.size, x.begin + off[i + a] - base, np.diff(x.first)))
            s, known, size, begin = (np.concatenate([p[k] for p in parts]) for k in range(4))
            first = np.concatenate([[0], np.cumsum(np.concatenate([p[4] for p in parts]))])
            path = best_path(s, first)
            n, text = j - i, np.repeat(np.arange(j - i), np.diff(first))
            weight = np.bincount(text * len(model.langs) + path, weights=size * known, minlength=n * len(model.langs)).reshape(n, -1)
            total = weight.sum(1)
            pick = np.where(total > 0, weight.argmax(1), model.common)
            share = weight.max(1) / np.maximum(total, 1)
            for k in np.flatnonzero(~_has_ascii_letter(buf[off[i] : off[j]], off[i : j + 1] - off[i])):
                if not any(c.isalpha() for c in buf[off[i + k] : off[i + k + 1]].tobytes().decode("utf-8", "replace")):
                    pick[k], share[k] = len(model.langs), 0
            columns = [batch.column("_row").slice(i, n), pa.array(langs[pick], pa.string()), pa.array(share)]
            names = ["_row", "_lang_pred", "_score"]
            if spans:
                columns.append(pa.array([_spans(path[a:b], begin[a:b] - (off[i + k] - base), size[a:b], langs) for k, (a, b) in enumerate(zip(first, first[1:]))],
                                        pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))))
                names.append("spans")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _has_ascii_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    at = np.flatnonzero(_LETTER[buf] & (buf < 128))
    return np.diff(np.searchsorted(at, off)) > 0


def _spans(path, begin, size, langs) -> list[dict]:
    """Maximal runs of words of one language, in bytes of the text."""
    if not len(path):
        return []
    cut = np.flatnonzero(np.diff(path)) + 1
    heads, tails = np.concatenate([[0], cut]), np.concatenate([cut, [len(path)]]) - 1
    return [{"lang": langs[path[a]], "start": int(begin[a]), "end": int(begin[b] + size[b])} for a, b in zip(heads, tails)]


def predict(docs: DataFrame, model: Model | None, keep: list[str] | None = None, spans: bool = False) -> DataFrame:
    """_row (a struct of ``keep``, by default all columns), _lang_pred, _score and, if
    asked, spans (array of lang, start, end in UTF-8 bytes)."""
    span = ArrayType(StructType().add("lang", StringType()).add("start", LongType()).add("end", LongType()))
    if model is None:
        more = [F.array().cast(span).alias("spans")] if spans else []
        return docs.select(row_of(docs, keep), F.lit("und").alias("_lang_pred"), F.lit(0.0).alias("_score"), *more)
    ready = rows_and_texts(docs, keep)
    schema = StructType([ready.schema["_row"]]).add("_lang_pred", StringType()).add("_score", DoubleType())
    if spans:
        schema = schema.add("spans", span)
    return ready.mapInArrow(lean(_judged, model, spans), schema)


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~in_fold("doc_id", 4, 2)).select("text", "lang")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = predict(docs, fit(training_rows(docs)), keep=["doc_id"])
    out = out.select("_row.doc_id", "_lang_pred", "_score")
    return out.select("doc_id", in_fold("doc_id", 4, 2).alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_score").alias("score"))
