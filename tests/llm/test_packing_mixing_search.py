"""Packing, mixing, search, URL filter and the pipeline."""
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricelens.llm import jaccard_join, langid, mixing, packing, quality_fm, topk_search, url_filter
from pricelens.llm.queries import QUERIES, SQL

from .conftest import SF


def one_by_one(counts):
    left, capacity, out = counts.copy(), len(counts) - 1, []
    while left.any():
        pattern, room = [], capacity
        while have := [n for n in range(1, room + 1) if left[n]]:
            pattern.append(have[-1])
            left[have[-1]] -= 1
            room -= have[-1]
        if room and len(pattern) > 1:
            small, best = pattern[-1], None
            for a in np.flatnonzero(left):
                for b in np.flatnonzero(left):
                    if b <= a and (a != b or left[a] > 1) and small < a + b <= room + small and (best is None or (a + b, a) > best):
                        best = (a + b, a)
            if best:
                a, b = best[1], best[0] - best[1]
                left[a] -= 1
                left[b] -= 1
                left[small] += 1
                pattern[-1:] = [a, b]
        out.append([int(x) for x in pattern])
    return out


def test_best_two_fit_by_counts():
    rng = np.random.default_rng(1)
    for _ in range(120):
        counts = np.zeros(int(rng.integers(5, 30)) + 1, np.int64)
        counts[1:] = rng.integers(0, rng.choice([2, 5, 30]), len(counts) - 1)
        assert [p for p, times in packing.best_two_fit(counts) for _ in range(times)] == one_by_one(counts)


def check_packing(docs, rows):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_files()[0])
    places, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    want = defaultdict(list)
    for i, text in docs:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want[i] += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    return len(places), sum(n for own in places.values() for _, n in own)


def test_packing(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    sequences, tokens = check_packing([tuple(r) for r in docs.collect()], packing.op5_pack_sequences(spark, SF).collect())
    assert sequences <= 1.02 * tokens / 1024 + 1
    more = [(100, "a  b \n c <|endoftext|> d  "), (101, " x"), (102, "it's we'll x")]
    rows = odd.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    check_packing([tuple(r) for r in rows.collect()], packing.pack_documents(rows).collect())
    assert packing.pack_documents(none).count() == 0


def duck(sf=SF, **tables):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(SQL))
def test_against_sql(spark, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = duck().execute(SQL[name]).df()[got.columns.tolist()]
    order = got.columns.tolist()
    a, b = (x.sort_values(order).reset_index(drop=True) for x in (got, want))
    assert len(a) == len(b)
    for c in order:
        assert (a[c].fillna(-1) == b[c].fillna(-1)).all(), c


def test_mixing_targets_and_odd_rows(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = mixing.op10_mix_sources(spark, SF).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    for _, g in got.groupby("source"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= g["size"].max() / 2 + 1e-6
        assert (g["taken"] <= 2 * g["size"]).all()
    assert got["taken"].sum() == pytest.approx(1.5 * got["size"].sum(), rel=0.02)
    mixed = mixing.mix_sources(odd)
    assert mixed.columns == odd.columns and mixed.count() == mixing.mix_sources(odd).count()
    assert mixing.mix_sources(none).count() == 0


def test_index_rows_hold_counts_and_frequencies_in_place_of_weights(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    index = topk_search.build_index(docs, shard_words=5000)
    rows = index.collect()
    assert rows and set(rows[0].asDict()) == {f.split()[0] for f in topk_search.INDEX.split(", ")}
    for r in rows:
        terms, postings = (len(topk_search.unpacked(r[c], k)) for c, k in (("terms", "uint64"), ("docs", "int32")))
        assert len(topk_search.unpacked(r["tfs"], "int32")) == postings and len(topk_search.unpacked(r["dfs"], "int64")) == terms


def test_shard_search_equals_all_scores_whatever_was_found_before(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    shard = topk_search.Shard(max(topk_search.build_index(docs, shard_words=60_000).collect(), key=lambda r: len(r["ids"])).asDict(), block=4)
    rng = np.random.default_rng(1)
    for size in (1, 3, 40, 300):
        at = rng.choice(len(shard.terms), size, replace=False)
        times = rng.integers(1, 4, size)
        score = np.zeros(len(shard.ids))
        for t, q in zip(at, times):
            for p in range(shard.offsets[t], shard.offsets[t + 1]):
                score[shard.docs[p]] += q * shard.weight[p]
        want = sorted(((-round(s, 6), i) for i, s in zip(shard.ids.tolist(), score.tolist()) if s > 0))
        for k in (1, 5, 10_000):
            for least in (-1.0, -want[min(3, len(want) - 1)][0]):
                ids, scores = shard.search(np.append(at, -1), np.append(times, 1), k, least)
                assert ids.tolist() == [i for s, i in want if -s >= least - 1e-9][:k] and np.allclose(scores, [-s for s, i in want if -s >= least - 1e-9][:k], atol=2e-6)


def test_search_without_pruning(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    index = topk_search.build_index(docs, shard_words=20_000)
    few = topk_search.search(index, queries, k=3, query_set=4).orderBy("query_id", "rank").collect()
    all_ = topk_search.search(index, queries, k=10_000).where("rank <= 3").orderBy("query_id", "rank").collect()
    assert few == all_ and few
    odd_index = topk_search.build_index(odd)
    found = topk_search.search(odd_index, odd.select(F.col("doc_id").alias("query_id"), "text")).collect()
    assert {r["query_id"] for r in found} == {1, 2, 6, 7, 8} and all(r["doc_id"] is not None for r in found)
    assert topk_search.search(odd_index, none.select(F.col("doc_id").alias("query_id"), "text")).count() == 0
    assert topk_search.search(topk_search.build_index(none), queries).count() == 0


def brute_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h), len(p), v == "block", h, p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    if not fit:
        return host, path, None, None
    *_, h, p, v = max(fit)
    return host, path, f"{h}/{p}", v


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1?x#y", "https://example.net/de/", "x://net/", "http://sub.net?q=/", "http://example.com/de/3.html", "http://notexample.com/de/1",
            "http://w.example.org/fr/1", "http://example.org/en/1", "no scheme/en/", "", None, "http://", "http://h/a://b", "http://example.net", "HTTP://EXAMPLE.com/DE/1"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in url_filter.filter_urls(rows).collect():
        host, path, rule, verdict = brute_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), urls[r["page_id"]]
        assert r["verdict"] == (verdict or "allow")
    assert url_filter.filter_urls(rows.limit(0)).count() == 0


def test_url_templates_reject_bad_branches(spark):
    rows = [(k, f"http://host.com/{'junk' if k % 2 else 'good'}/{k}.html") for k in range(400)]
    rows += [(1000 + k, f"http://host.com/item/{'abcdefghij'[k % 10]}{k}x") for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(0, 400)], "url_key long, bad int")
    got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()}
    assert all(got[k] == ("block" if k % 2 else "allow") for k in range(400))
    paths = url_filter.templates(spark.createDataFrame([("h", f"/item/{k}q", None) for k in range(100)] + [("h", "/item/", None)], "host string, path string, bad long"))
    assert {r["template"] for r in paths.select("template").distinct().collect()} == {"/item/*", "/item"}


def test_url_branches_below_deeper_nodes(spark):
    rows = [("h.com", f"/shop/{'ab'[k % 2]}/x", k // 2 % 2) for k in range(20)] + [("h.com", "/shop/c/x", 1) for _ in range(6)] + [("h.com", "/shop/d/y", 0)]
    judged = url_filter.judged_templates(spark.createDataFrame(rows, "host string, path string, bad long"))
    branch = {r["template"]: r["branch"] for r in judged.collect()}
    assert branch == {"/shop/a/x": "/shop/{*}/x", "/shop/b/x": "/shop/{*}/x", "/shop/c/x": "/shop/c/x", "/shop/d/y": "/shop/d/y"}


def test_url_paths_of_any_depth(spark):
    rows = [(k, f"http://host.com/a/b/c/d/e/f/g/{'junk' if k % 2 else 'good'}/{k}.html") for k in range(200)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "url_key long, bad int")
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert len(got) == 200 and all(r["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got)


def test_pipeline_stages(spark, odd):
    """Each stage on what the one before kept, held against its operator's rule."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "language", "near_duplicates", "mixing", "packing"]
    ids = lambda d: {r["doc_id"] for r in d.select("doc_id").collect()}
    good = stages["quality"](spark, docs, SF).cache()
    model = quality_fm.fit(docs, quality_fm.training_labels(spark, SF))
    assert good.columns == docs.columns and ids(good) == ids(quality_fm.score(docs, model).where("_score >= 0.7").select("_row.doc_id"))
    spoken = stages["language"](spark, good, SF).cache()
    judged = langid.predict(good, langid.fit(langid.training_rows(good)))
    assert ids(spoken) == ids(judged.where("_lang_pred <> 'und' and _score >= 0.5").select("_row.doc_id"))
    single = stages["near_duplicates"](spark, spoken, SF).cache()
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(spoken).collect()}
    assert ids(single) == set(groups.values()) and single.count() == len(set(groups.values()))
    mixed = stages["mixing"](spark, single, SF).cache()
    assert mixed.columns == docs.columns and ids(mixed) <= ids(single)
    check_packing([(r["doc_id"], r["text"]) for r in mixed.collect()], stages["packing"](spark, mixed, SF).collect())
    once = stages["near_duplicates"](spark, odd, SF)
    assert sorted(r["doc_id"] or 0 for r in once.collect()) == [0, 0, 1, 3, 4, 5, 6, 7, 8] and once.columns == odd.columns
