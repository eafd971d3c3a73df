"""Jaccard join and embedding join against brute force."""
import os
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import common, embed_dedup, jaccard_join

from .conftest import lower

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def top(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def link(self, a, b):
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)


def brute(rows):
    shingles = {}
    for i, t in rows:
        w = WORD.findall(lower(t or ""))
        shingles[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    common, holders, sets = defaultdict(int), defaultdict(list), Sets(shingles)
    for i, s in shingles.items():
        for g in s:
            for j in holders[g]:
                common[j, i] += 1
            holders[g].append(i)
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(shingles[a]) + len(shingles[b]) - n):
            sets.link(a, b)
    return {i: (len(s), sets.top(i)) for i, s in shingles.items()}


def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(2000)]

    def edit(words, p):
        return [rng.choice(vocabulary) if rng.random() < p else x for x in words]

    base = [rng.choice(vocabulary) for _ in range(100)]
    near = edit(base, 0.08)
    texts = [" ".join(edit(base, rng.choice([0, 0.01, 0.03, 0.05]))) for _ in range(90)]
    texts += [" ".join(edit(near, rng.choice([0.01, 0.03]))) for _ in range(60)]
    texts += [" ".join([rng.choice(vocabulary) for _ in range(50)] + base[:60]) for _ in range(30)]
    texts += [None, "", " \n", "A b c", "a B C", "a b", "x " * 2000, texts[0], texts[0].upper().replace("W", "w")]
    return [(k + 10, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("leaf", [512, 20])
def test_jaccard_components(spark, leaf):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(docs, leaf=leaf).collect()}
    assert got == brute(rows)


def test_jaccard_odd_rows(odd, none):
    got = jaccard_join.jaccard_components(odd).collect()
    assert len(got) == odd.count()
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[1] == {(3, 1)} and by[2] == {(3, 1)} and by[3] == {(0, 3)} and by[5] == {(0, 5)}
    assert by[None] == {(3, None), (0, None)}
    assert jaccard_join.jaccard_components(none).count() == 0


def test_jaccard_two_texts_of_one_id(spark):
    a, b = ([f"{c}{k}" for k in range(80)] for c in "ab")
    rows = [(5, a), (5, b), (9, a[:-1] + ["x"]), (10, b[:-1] + ["y"]), (-4, [f"c{k}" for k in range(80)]), (11, a)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == [(-4, -4), (5, 5), (5, 5), (9, 5), (10, 5), (11, 5)]


def brute_vectors(rows):
    ok = {i: np.array(v, float) for i, v, g in rows if v is not None and g is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))}
    label = {i: g for i, _, g in rows}
    sets, n = Sets([i for i, _, _ in rows]), {i: 0 for i, _, _ in rows}
    for a in ok:
        for b in ok:
            if a < b and label[a] == label[b] and ok[a] @ ok[b] / np.linalg.norm(ok[a]) / np.linalg.norm(ok[b]) >= 0.98:
                n[a] += 1
                n[b] += 1
                sets.link(a, b)
    return {i: (n[i], sets.top(i)) for i, _, _ in rows}


@pytest.mark.parametrize("block", [1024, 16])
def test_embeddings(spark, block):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = []
    for k in range(240):
        v = centres[k % 6] + rng.normal(scale=rng.choice([0.02, 0.12, 0.2]), size=16)
        rows.append((k, [float(np.float32(x)) for x in v * rng.choice([1.0, 7.0])], int(k % 6 == 5) + int(rng.integers(2))))
    rows += [(300 + k, rows[0][1], rows[0][2]) for k in range(5)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [None] + [1.0] * 15, 1), (403, [float("nan")] + [1.0] * 15, 1), (404, rows[0][1], None), (405, [float("inf")] + [1.0] * 15, 1), (406, [], 1)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), block=block).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == brute_vectors(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_embeddings_empty(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_embeddings_of_several_dimensions_and_text_labels(spark):
    """Each dimension links within itself, a vec_id may repeat, labels compare as they come, other columns clash."""
    rng = np.random.default_rng(9)
    rows = []
    for dim, first, n in ((3, 0, 20), (2, 100, 30), (7, 200, 4)):
        centre = rng.normal(size=(2, dim))
        rows += [(first + k, [float(x) for x in centre[k % 2] + rng.normal(scale=0.1, size=dim)], "ab"[k % 2]) for k in range(n)]
    want = {}
    for dim in (2, 3, 7):
        want |= brute_vectors([r for r in rows if len(r[1]) == dim])
    again = [(0, [-x for x in rows[0][1]], rows[0][2]), (500, [-x for x in rows[0][1]], rows[0][2])]  # id 0 with other components
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows + again], "vec_id long, embedding array<double>, label string, node int, key int, good int")
    got = embed_dedup.near_duplicates(df, block=8).collect()
    assert len(got) == len(rows) + 2 and {"n_links", "component_id"} <= set(got[0].asDict())
    single = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got if r["vec_id"] not in (0, 500)}
    assert single == {k: v for k, v in want.items() if k != 0}
    assert sorted((r["n_links"], r["component_id"]) for r in got if r["vec_id"] in (0, 500)) == sorted([want[0], (1, 0), (1, 0)])


@pytest.mark.parametrize("few", [common.FEW_EDGES, 0])
def test_components_of_few_and_of_many_edges(spark, few):
    rng = np.random.default_rng(2)
    edges = [*((k, k + 1) for k in range(1000, 1100)), *((5, int(k)) for k in rng.integers(6, 90, 40)), (7, 7), (999, 999), (None, 3), (-4, -9), (-9, -4)]
    edges += [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (150, 2))]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    got = common.components(spark.createDataFrame(edges, "a long, b long").repartition(5), few).collect()
    assert {(r["node"], r["component"]) for r in got} == {(x, top(x)) for x in up} and len(got) == len(up)
    assert common.components(spark.createDataFrame([], "a long, b long"), few).count() == 0


def test_finished_tables_of_the_join_are_deleted(spark, monkeypatch):
    made, write = [], jaccard_join.written
    monkeypatch.setattr(jaccard_join, "written", lambda df, name, *a: made.append((name, write(df, name, *a))) or made[-1][1])
    words = [f"w{k}" for k in range(40)]
    docs = spark.createDataFrame([(k, " ".join(words[:38 + k % 3])) for k in range(9)], "doc_id long, text string")
    assert {r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()} == {0}
    files = {name: [f for f in df.inputFiles() if os.path.exists(f.removeprefix("file://"))] for name, df in made}
    assert files["signatures"] and not files["shared"] and not files["sets"] and not files["regions"]
