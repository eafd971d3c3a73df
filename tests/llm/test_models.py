"""Quality, language, Katz, piece counts: held-out accuracy, brute force, references."""
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelens.llm import katz, langid, quality_fm, token_counts
from pricelens.llm.common import in_fold, text_buffer

from .conftest import lower

LARGER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_held_out(spark):
    got = quality_fm.op2_quality_fm(spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.95
    assert got.loc[got["quality"] == 1, "predicted"].mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    v, w = rng.normal(size=(3, 9)), rng.normal(size=9)
    x = rng.normal(size=9) * (rng.random(9) < 0.6)
    col = np.flatnonzero(x)
    got = quality_fm.margin(0.3, w, v, 1, np.zeros(len(col), int), col, x[col])[0][0]
    pairs = sum((v[:, i] @ v[:, j]) * x[i] * x[j] for i in range(9) for j in range(i))
    assert got == pytest.approx(0.3 + w @ x + pairs)


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (7, 0), (2, 1), (None, 1), (6, None)], "doc_id long, label int")
    model = quality_fm.fit(odd, labels)
    out = quality_fm.score(odd, model)
    assert out.select("_row.*").columns == odd.columns and out.count() == odd.count()
    assert out.where("_score is null or isnan(_score)").count() == 0
    assert quality_fm.fit(none, labels) is None and quality_fm.score(odd, None).where("_score = 1").count() == odd.count()
    assert quality_fm.score(none, model).count() == 0


def test_language_held_out_and_mixed(spark, odd, none):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    model = langid.fit(langid.training_rows(docs))
    got = langid.op9_language_id(spark, LARGER).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got["lang"] == got["lang_pred"]).mean() > 0.97
    parts = {r["lang"]: r["text"][:400] for r in docs.where("lang in ('en', 'fr')").groupBy("lang").agg(F.first("text").alias("text")).collect()}
    mixed = spark.createDataFrame([(1, parts["en"] + "\n" + parts["fr"])], "doc_id long, text string")
    spans = langid.predict(mixed, model, spans=True).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "fr"]
    out = langid.predict(odd, model)
    by = {r["_row"]["doc_id"]: r for r in out.collect()}
    assert out.count() == odd.count() and by[3]["_lang_pred"] == by[4]["_lang_pred"] == by[7]["_lang_pred"] == "und" and by[3]["_score"] == 0
    assert by[8]["_lang_pred"] in model.langs
    assert langid.predict(none, model).count() == 0 and langid.fit(none) is None
    assert langid.predict(odd, None).where("_lang_pred = 'und'").count() == odd.count()


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(4)
    counts = [0, 5, 1, 4, 0, 6]
    first = np.concatenate([[0], np.cumsum(counts)])
    scores = rng.normal(size=(first[-1], 3)) * 4
    got = langid.best_path(scores, first, 2.5)
    for a, b in zip(first, first[1:]):
        best = -np.inf
        for code in range(3 ** (b - a)):
            path = [code // 3**k % 3 for k in range(b - a)]
            best = max(best, sum(scores[a + k, p] for k, p in enumerate(path)) - 2.5 * sum(x != y for x, y in zip(path, path[1:])))
        if b > a:
            path = got[a:b]
            assert sum(scores[a + k, p] for k, p in enumerate(path)) - 2.5 * (np.diff(path) != 0).sum() == pytest.approx(best)


def brute_katz(rows, k=katz.K):
    tokens = [WORD.findall(lower(t or "")) + ["</s>"] for _, t, _ in rows]
    uni, bi, ctx, after = Counter(), Counter(), Counter(), defaultdict(set)
    for ts, (_, _, train) in zip(tokens, rows):
        if train:
            ctx["<s>"] += 1
            for v, w in zip(["<s>", *ts], ts):
                uni[w] += 1
                bi[v, w] += 1
                after[v].add(w)
    ctx.update(uni)
    n, size = sum(uni.values()), len(uni)

    def discounts(c):
        times = Counter(c.values())
        return katz.good_turing(np.array([times[r] for r in range(1, k + 2)]))

    d1, d2, times = discounts(uni), discounts(bi), Counter(uni.values())
    unknown = sum((1 - d1[r]) * r * times[r] for r in range(1, k + 1)) / max(n, 1)
    half = unknown < 0.5 / (n + 0.5 * (size + 1))
    base = lambda w: (uni[w] + 0.5) / (n + 0.5 * (size + 1))
    one = lambda w: base(w) if half else d1[min(uni[w], k + 1)] * uni[w] / n if uni[w] else unknown

    def context(v):
        if not ctx[v]:
            return 1, 1
        left, kept = 1 - sum(d2[min(bi[v, w], k + 1)] * bi[v, w] for w in after[v]) / ctx[v], 1
        if left < 1e-12:
            left, kept = 1 / (ctx[v] + 1), ctx[v] / (ctx[v] + 1)
        return left / (1 - sum(one(w) for w in after[v])), kept

    def p(v, w):
        alpha, kept = context(v)
        return kept * d2[min(bi[v, w], k + 1)] * bi[v, w] / ctx[v] if bi[v, w] else alpha * one(w)

    for v in ["<s>", *list(uni)[:25]]:
        if ctx[v] and v != "</s>":
            assert sum(p(v, w) for w in [*uni, "<unknown>"]) == pytest.approx(1, abs=1e-9)
    return sorted((i or -1, len(ts), sum(uni[w] > 0 for w in ts), n, sum(math.log10(base(w)) for w in ts), sum(math.log10(p(v, w)) for v, w in zip(["<s>", *ts], ts))) for ts, (i, _, _) in zip(tokens, rows))


@pytest.mark.parametrize("chunk_tokens", [katz.CHUNK_TOKENS, 3000])
def test_katz(spark, odd, chunk_tokens):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).select("doc_id", "text").union(odd.select(F.col("doc_id") + 10**6, "text"))
    rows = [(r["doc_id"], r["text"], r["train"]) for r in docs.withColumn("train", ~in_fold("doc_id", 5, 1)).collect()]
    got = katz.katz_scores(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), chunk_tokens)
    got = sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got.collect())
    for a, b in zip(got, brute_katz(rows), strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9, abs=1e-9)


def test_katz_without_rows_or_training(spark, none):
    assert katz.katz_scores(none.select("doc_id", "text", F.lit(True).alias("train"))).count() == 0
    one = katz.katz_scores(spark.createDataFrame([(1, "a b", False)], "doc_id long, text string, train boolean")).first()
    assert (one["n_tokens"], one["n_known"], one["train_tokens"], one["score"]) == (3, 0, 0, 0.0)


def test_katz_folds():
    assert zlib.crc32(b"1") % 5 == zlib.crc32(str(1).encode()) % 5


def test_piece_counts_match_a_unigram_tokenizer(spark, odd, none):
    import sentencepiece
    from tokenizers import Tokenizer, models

    sp = sentencepiece.SentencePieceProcessor(model_file=token_counts.vocabulary_path())
    unigram = Tokenizer(models.Unigram([(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())], unk_id=0, byte_fallback=True))
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()] + ["", "a", " a", "a  b   c", "\n\nx\t z", "日本 🙂🙂 x", "é  à ", "   "]
    counter = token_counts.UnigramCounter.from_sentencepiece(token_counts.vocabulary_path())
    counts, _ = counter.slice_counts(*text_buffer(pa.array(texts)))
    assert counts.tolist() == [len(unigram.encode("▁" + t.replace(" ", "▁")).tokens) if t else 0 for t in texts]
    out = token_counts.count_pieces(odd, token_counts.vocabulary_path())
    assert out.count() == odd.count() and out.where("n_pieces = 0").count() == 3
    assert token_counts.count_pieces(none, token_counts.vocabulary_path()).count() == 0
