"""Hard negatives, the prefix trie and the removal of repeats against brute force."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import hard_negatives, prefix_trie, suffix_dedup

from .conftest import SF

# ------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int, num string, shard double"


def vectors(n=900, dim=8, seed=3, labels=4):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0.2, 0.5) for _ in range(dim)], rng.randrange(labels), "x", 0.5) for i in range(n)]
    for i in range(0, n, 3):  # a third is one vector
        rows[i] = (i, rows[0][1], rows[i][2], None, None)
    return rows


def whole(rows):
    out = []
    for k, (i, e, label, *_) in enumerate(rows):
        if i is None or label is None or not e or any(v is None or not math.isfinite(v) for v in e):
            continue
        x = np.floor(np.array(e, np.float32).astype(np.float64) * 256)
        if np.abs(x).max() < hard_negatives.LARGEST:
            out.append((k, i, label, x.astype(np.int64)))
    return out


def mined(rows):
    found = []
    rows = whole(rows)
    for k, i, label, x in rows:
        if i % 100:
            continue
        scored = [(-int(x @ y), j, other == label) for m, j, other, y in rows if m != k and len(y) == len(x)]
        for s, j, _ in sorted(r for r in scored if r[2])[:5]:
            near = sorted(r for r in scored if not r[2] and 30 * -s <= 100 * -r[0] <= 90 * -s)[:10]
            found += [(i, j, n + 1, m, -s, -t) for n, (t, m, _) in enumerate(near)]
    return sorted(found)


def negatives(spark, rows, **index):
    df = spark.createDataFrame(rows, VECTORS)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 100 == 0, **index).collect())


def test_negatives_equal_brute_force_over_many_shards(spark):
    rows = vectors()
    assert negatives(spark, rows, shard=64, group=3, codewords=6) == mined(rows)


def test_negatives_odd_rows(spark):
    rows = vectors(220, 6)
    odd = [None, [], [None] * 6, [float("nan")] * 6, [float("inf")] * 6, [1e30] * 6, [0.0] * 6, [0.5] * 3, [0.25] * 3]
    rows += [(200 + k, e, 1, "y", 1.0) for k, e in enumerate(odd)]
    rows += [(None, [0.1] * 6, 1, None, None), (300, [0.1] * 6, None, None, None), (100, rows[5][1], 2, None, None), (0, rows[0][1], 0, None, None), (400, [0.5] * 3, 0, "z", None)]
    assert negatives(spark, rows, shard=40, codewords=4) == mined(rows)


def test_negatives_of_nothing(spark):
    assert negatives(spark, []) == []


def test_index_skips_cells_and_stays_exact():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 300, (12, 8))
    x = np.floor(centres[rng.integers(0, 12, 4000)] + rng.normal(0, 8, (4000, 8))).astype(np.int32)
    books = {8: (hard_negatives.k_means(x[:, :4].astype(float), 12), hard_negatives.k_means(x[:, 4:].astype(float), 12))}
    one, two = books[8]
    cell = hard_negatives.nearest(x[:, :4].astype(float), one) * len(two) + hard_negatives.nearest(x[:, 4:].astype(float), two)
    num = np.arange(4000)
    label = rng.integers(0, 3, 4000)
    raw = {"dim": 8, "num": num.tobytes(), "vec_id": num.tobytes(), "label": label.tobytes(), "cell": cell.astype(np.int64).tobytes(), "vectors": x.tobytes()}
    shard = hard_negatives.Shard(raw, books)
    scored = []
    inner = shard.scores
    shard.scores = lambda q, rows: (scored.append(len(rows)), inner(q, rows))[1]
    q = x[17].astype(np.int64)
    far = 1 << 60
    ((s, r),) = shard.search(17, int(label[17]), q, np.array([-far]), np.array([far]), np.array([-far]), np.array([far]), True, 5)
    want = sorted((-int(q @ y.astype(np.int64)), i) for i, y in enumerate(x) if i != 17 and label[i] == label[17])[:5]
    assert [(-a, int(shard.vec_id[b])) for a, b in zip(s, r)] == want
    assert sum(scored) < 2000  # the certificate ends the visit early


# ----------------------------------------------------------------------- trie

TURNS = "conv_id long, turn long, role string, text string, ids string, name int"


def trie(convs):
    """{path: (members, ...)} of {conv_id: [(role, text), ...]}, node by node."""
    members, ended = defaultdict(list), defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
        ended[tuple(convs[c])].append(c)
    children = defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted((members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), children[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, ended[p])).encode()).hexdigest()) for p in members)


def told(rows):
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}


def answered(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect())


def conversations(seed=1, n=120):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 3 == 0:  # a third is one conversation
            rows += [(c, t, "user", f"same {t}", None, 1) for t in range(4)]
            continue
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "日本", "hello there"]) if t else "first turn of all", "x", 2))
    rows += [(1, None, None, None, None, None), (1, None, "user", "", None, None), (1, 2, "user", "tie", None, None), (1, 2, "assistant", "tie", None, None), (-7, 0, "user", "w " * 40000, None, None),
             (None, 0, "user", "nobody", None, None)] + [(500, t, "user", f"long {t % 7}", None, None) for t in range(600)]
    return rows


@pytest.mark.parametrize("shard", [40, 1 << 20])
def test_trie_equals_brute_force(spark, shard):
    rows = conversations()
    df = spark.createDataFrame(rows, TURNS).repartition(5)
    assert answered(prefix_trie.prefix_trie(prefix_trie.sequences(df), shard)) == trie(told(rows))


def test_trie_of_rebuilt_conversations(spark, tmp_path):
    rows = conversations(2, 90)
    rows = [r for r in rows if r[0] != 55]  # an absent base
    spark.createDataFrame(rows, TURNS).write.parquet(str(tmp_path / "conversations.parquet"))
    own = told(rows)
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + t[h:]
    assert any(not t for t in whole.values()) and any(len(t) < len(own[c]) for c, t in whole.items())
    assert answered(prefix_trie.op12_prefix_trie(spark, str(tmp_path))) == trie(whole)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(prefix_trie.sequences(spark.createDataFrame([], TURNS))).collect() == []


def test_sibling_trees_are_balanced():
    tree = prefix_trie.Tree()
    for k in prefix_trie.median_first(1000):
        tree.path([k], [1])
    height, now = 0, [tree.below[0]]
    while now:
        height, now = height + 1, [x for n in now for x in (tree.less[n], tree.more[n]) if x >= 0]
    assert sorted(prefix_trie.median_first(1000)) == list(range(1000)) and height == 10


# --------------------------------------------------------------- suffix arrays

def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(150):
        letters = rng.choice([b"ab", b"abc", bytes(range(256)), b"a", b"\0a"])
        x = np.frombuffer(bytes(rng.choice(letters) for _ in range(rng.randint(1, 200))) * rng.choice([1, 3]), np.uint8)
        depth = rng.choice([5, 8, 50, 1000])
        order, raw = suffix_dedup.two_stage(x, depth), x.tobytes()
        assert sorted(order) == list(range(len(x)))
        assert [raw[i:i + depth] for i in order] == sorted(raw[i:i + depth] for i in range(len(x)))
        prefix = suffix_dedup.common_prefixes(suffix_dedup.words_at(x, depth + 8), order, depth)
        for k in range(1, len(order)):
            a, b = (raw[order[j]:] + b"\0" * (depth + 8) for j in (k - 1, k))
            assert prefix[k] == next((i for i in range(depth) if a[i] != b[i]), depth)


def removed(rows, length=50):
    texts = [(i, (t or "").encode()) for i, t, *_ in rows]
    low = {}
    for i, b in sorted((t for t in texts if t[0] is not None), key=lambda t: t[0]):
        for p in range(len(b) - length + 1):
            low.setdefault(b[p:p + length], i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if i is not None and low[b[p:p + length]] < i:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((-1 if i is None else i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


def cleaned(df, **how):
    return sorted((-1 if r.doc_id is None else r.doc_id, *tuple(r)[1:]) for r in suffix_dedup.remove_repeats(df, **how).collect())


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(n) for n in (9, 15, 20, 60)]
    rows = []
    for i in range(150):
        parts = [text(rng.randint(0, 20))] + [p for _ in range(rng.randint(0, 3)) for p in (rng.choice(shared)[rng.randint(0, 6):], text(rng.randint(0, 9)))]
        rows.append((rng.randrange(140), " ".join(parts)))  # some ids repeat, with other texts
    rows += [(200 + i, rows[3][1]) for i in range(60)] + [(3, "x" * 5000), (4, "x" * 49), (5, "x" * 50), (300, "ab" * 700), (299, "ab" * 30), (301, "\0" * 400), (302, "\0" * 300)]
    return rows


@pytest.mark.parametrize("how", [{}, {"chunk": 900, "batch": 2000}, {"chunk": 3000, "hot": 5}])
def test_repeats_equal_brute_force(spark, passages, how):
    df = spark.createDataFrame(passages, "doc_id long, text string").repartition(4)
    assert cleaned(df, **how) == removed(passages)


def test_repeats_of_odd_rows(spark, odd, none):
    assert cleaned(odd) == removed([tuple(r)[:2] for r in odd.collect()])
    assert cleaned(none) == []


def test_repeats_of_other_lengths(spark, passages):
    df = spark.createDataFrame(passages[:80], "doc_id long, text string")
    assert cleaned(df, length=12) == removed(passages[:80], 12)


def test_repeats_are_removed_at_scale_factor(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert [tuple(r) for r in sorted(suffix_dedup.op13_suffix_dedup(spark, SF).collect())] == removed(rows)
