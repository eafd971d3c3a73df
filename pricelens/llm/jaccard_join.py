"""Jaccard metric-space join of documents on their word-shingle sets.

d(x, y) = 1 - |x & y| / |x | y| is a metric; two sets link when d <= 1 - threshold.

1. Sets.  Rows with equal sets (a 128-bit digest of the sorted shingle hashes) are
   one node with a number of its own, so copies are never compared with one another;
   doc_ids only name the components.
2. Isolated sets leave.  Linked sets share at least l shingles among the first
   n - ceil(t n) + l of each in hash order (l is about a tenth of n).  A set of whose
   first shingles fewer than that occur in any other set has no link.
3. Pivots.  The shingles left are ordered by how many sets hold them, rarest first,
   and cut once more by the same argument; linked sets still share one.  The sets
   that share a shingle follow one of them, their pivot.  A pivot with its followers
   is a region; two linked sets always meet in one.  Only sets that share rare
   shingles with a pivot come near it: from all others it is at distance 1.
4. Regions of at most ``leaf`` sets are joined exactly.  Larger ones recurse: some of
   their sets become pivots of a Voronoi partition, a set goes to its nearest pivot
   and, by the triangle inequality, to every pivot that is farther by at most twice
   the link distance.  Sets within the link distance of a pivot are linked to it, so
   only pairs with a set outside the region's largest component are left; up to
   ``leaf`` such outsiders are joined with the region's blocks at once.  Parts that a
   partition doesn't make smaller are joined, those at home with all, in blocks of ``leaf``.
   Pairs already connected, or that a pivot's distances rule out, are passed over.

Shingles are compared by 64-bit hashes: a pair of sets of a thousand shingles is
judged wrongly with a probability below 1e-13.

Defined cases: null, empty or blank texts have an empty set, n_shingles 0, and link
with nothing (component_id = doc_id); so do rows with a null doc_id, whose
component_id is null; rows that repeat a doc_id are judged each by its own text and
share components through that id; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import binaries, components, cut, discard, lean, partitions, ragged, shingle_sets, sized_join, small_batches, word_slices, written

THRESHOLD = (75, 100)
SHINGLE = 5
LEAF = 512
PIVOTS = 8
DEEPEST = 3
EDGES = "a long, b long"


def need(n, threshold=THRESHOLD):
    """Shingles that a set of n shares at least with a linked one."""
    return -(-n * threshold[0] // threshold[1])


def slack(n):
    """The l of step 2; it doesn't fall with n."""
    return 1 + n // 10


def _signatures(batches: Iterator[pa.RecordBatch], size: int, threshold) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in word_slices(batch.column("text")):
            h, off = shingle_sets(words, size)
            n = np.diff(off)
            digests = [hashlib.blake2b(h[a:b], digest_size=16).digest() for a, b in zip(off, off[1:])]
            head = np.where(n > 0, n - need(n, threshold) + slack(n), 0)
            keep = np.arange(len(h)) - np.repeat(off[:-1], n) < np.repeat(head, n)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(i, j - i), pa.array(n), pa.array(digests, pa.binary()), ragged(h[keep].view(np.int64), np.concatenate([[0], np.cumsum(np.minimum(head, n))]))],
                names=["doc_id", "n", "sig", "head"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, sig): the distinct ones whose token has two sigs or
    more, and all of the partition's first and last token, which may go on next door."""
    held = np.zeros((2, 0), np.int64)  # the last row so far
    out_already, first = False, None

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1])], names=["token", "sig64"])

    for batch in batches:
        rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        if not rows.shape[1]:
            continue
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
        rows = rows[:, new]
        t = rows[0]
        first = t[0] if first is None else first
        same = t[1:] == t[:-1]
        ok = t == first
        ok[1:] |= same
        ok[:-1] |= same
        last = bool(ok[-1])
        if held.shape[1] and out_already:
            if len(t) == 1:
                last = True
            ok[0] = False
        yield out(rows[:, ok])
        held, out_already = rows[:, -1:], last
    if held.shape[1] and not out_already:
        yield out(held)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, words in word_slices(batch.column("text")):
            h, off = shingle_sets(words, size)
            sig = [hashlib.blake2b(h[a:b], digest_size=16).digest() for a, b in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.binary()), binaries(h, off)], names=["sig", "shingles"])


def overlaps(a: list[np.ndarray], b: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each set of a with each of b, by products of
    membership matrices over ``step`` shingles at a time."""
    def flat(sets):
        return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    (ha, ra), (hb, rb) = flat(a), flat(b)
    both = np.intersect1d(ha, hb)
    out = np.zeros((len(a), len(b)), np.float64)
    ca, cb = np.searchsorted(both, ha), np.searchsorted(both, hb)
    ina = (ca < len(both)) & (both[np.minimum(ca, max(len(both) - 1, 0))] == ha) if len(both) else np.zeros(len(ha), bool)
    inb = (cb < len(both)) & (both[np.minimum(cb, max(len(both) - 1, 0))] == hb) if len(both) else np.zeros(len(hb), bool)
    ca, ra, cb, rb = ca[ina], ra[ina], cb[inb], rb[inb]
    for k in range(0, len(both), step):
        x, y = np.zeros((len(a), step), np.float32), np.zeros((len(b), step), np.float32)
        m = (ca >= k) & (ca < k + step)
        x[ra[m], ca[m] - k] = 1
        m = (cb >= k) & (cb < k + step)
        y[rb[m], cb[m] - k] = 1
        out += x @ y.T
    return out


def _similar(a, b, threshold) -> tuple[np.ndarray, np.ndarray]:
    """(linked, distance) of each set of a with each of b."""
    inter = overlaps(a, b)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - inter
    return threshold[1] * inter >= threshold[0] * union, 1 - inter / np.maximum(union, 1)


def _decode(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column]


def _forest(i: np.ndarray, j: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray) -> pd.DataFrame:
    """Links thinned to a forest: no more rows than documents, the same components."""
    up: dict[int, int] = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    rows = []
    for a, b in zip(ids_a[i].tolist(), ids_b[j].tolist()):
        x, y = top(a), top(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            rows.append((a, b))
    return pd.DataFrame(rows, columns=["a", "b"], dtype="int64")


def _leaf_links(threshold):
    def links(region: pd.DataFrame) -> pd.DataFrame:
        sets, ids = _decode(region["shingles"]), region["doc"].to_numpy()
        linked, _ = _similar(sets, sets, threshold)
        i, j = np.nonzero(np.triu(linked, 1))
        return _forest(i, j, ids, ids)
    return links


def _measured(threshold):
    """Distances of a block of a region's sets to the region's pivots, and the pivots
    that each is linked to."""
    def measure(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(pivots):
            return pd.DataFrame(columns=["region", "doc", "shingles", "home", "near", "far"])
        pivots = pivots.sort_values("doc")
        linked, far = _similar(_decode(rows["shingles"]), _decode(pivots["shingles"]), threshold)
        ids = pivots["doc"].to_numpy()
        out = rows[["region", "doc", "shingles", "home"]].copy()
        out["near"], out["far"] = [[int(x) for x in ids[row]] for row in linked], far.tolist()
        return out
    return measure


MEASURED = "region string, doc long, shingles binary, home boolean, near array<long>, far array<double>"


def _block_links(threshold):
    eps = 1 - threshold[0] / threshold[1] + 1e-9

    def links(block: pd.DataFrame) -> pd.DataFrame:
        """Pairs of the first block with the second, at least one of them at home."""
        a, b = block[block["side"] == 0], block[block["side"] == 1]
        if not len(a) or not len(b):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        may = (a["component"].to_numpy()[:, None] != b["component"].to_numpy()[None, :]) & (a["home"].to_numpy()[:, None] | b["home"].to_numpy()[None, :])
        x, y = np.stack(a["far"].to_numpy()), np.stack(b["far"].to_numpy())
        for p in range(x.shape[1]):
            may &= np.abs(x[:, p][:, None] - y[:, p][None, :]) <= eps
        rows, cols = np.flatnonzero(may.any(1)), np.flatnonzero(may.any(0))
        a, b = a.iloc[rows], b.iloc[cols]
        linked, _ = _similar(_decode(a["shingles"]), _decode(b["shingles"]), threshold)
        i, j = np.nonzero(linked & may[np.ix_(rows, cols)])
        return _forest(i, j, a["doc"].to_numpy(), b["doc"].to_numpy())
    return links


def region_links(rows: DataFrame, threshold=THRESHOLD, leaf: int = LEAF, pivots: int = PIVOTS, deepest: int = DEEPEST) -> DataFrame:
    """Links (a, b) that connect the same sets as all links inside the regions of
    ``rows`` (region string, doc long, shingles binary)."""
    spark = rows.sparkSession
    found = spark.createDataFrame([], EDGES)
    rows = rows.withColumn("home", F.lit(True))
    for depth in count():
        sizes = cut(rows.groupBy("region").agg(F.count("*").alias("size")))
        small = sized_join(rows, sizes.where(F.col("size") <= leaf).select("region"), "region")
        found = found.union(small.select("region", "doc", "shingles").groupBy("region").applyInPandas(_leaf_links(threshold), EDGES))
        large = sizes.where(F.col("size") > leaf)
        if large.isEmpty():
            return found
        blocks = F.ceil(F.col("size") / leaf).cast("int")
        rows = sized_join(rows, large, "region").withColumn("block", F.pmod(F.xxhash64("doc", F.lit(depth)), blocks).cast("int"))
        # one pivot from each of so many hash classes of a region's own sets
        draw = F.struct(F.xxhash64("doc", F.lit(depth + 100)).alias("o"), "doc", "shingles")
        drawn = cut(rows.where("home").groupBy("region", F.pmod(F.xxhash64("doc", F.lit(depth + 200)), F.lit(pivots)).alias("class"))
                    .agg(F.min(draw).alias("p"), F.max("size").alias("size")).select("region", "p.doc", "p.shingles", "size"))
        drawn = drawn.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
        drawn = drawn.select(*[F.col(c).alias(c) for c in ("region", "block", "doc", "shingles")])
        measured = written(rows.select("region", "block", "doc", "shingles", "home").groupBy("region", "block")
                           .cogroup(drawn.groupBy("region", "block")).applyInPandas(_measured(threshold), MEASURED), "measured")
        links = measured.select(F.col("doc").alias("a"), F.explode("near").alias("b")).where("a <> b")
        found = cut(found.union(links))
        label = components(found).withColumnRenamed("node", "doc")
        measured = measured.drop("near").join(label, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
        # a region's largest component needs no pairs of its own: only pairs with an
        # outsider are left, and they are found where the outsider is at home
        share = measured.groupBy("region", "component").agg(F.count("*").alias("n")).groupBy("region").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("most"))
        state = cut(share.where("size > most"))
        measured = cut(sized_join(measured, state, "region").withColumn("outside", F.col("component") != F.col("main")))
        few = F.col("size") - F.col("most") <= leaf
        found = found.union(_against(measured.where(few).withColumn("outsiders", F.col("size") - F.col("most")), "outside", "outsiders", threshold, leaf))
        # Voronoi parts with windows
        wide = 2 * (1 - threshold[0] / threshold[1]) + 1e-9
        nearest = F.array_min("far")
        parts = measured.where(~few).withColumn("nearest", nearest).withColumn("home_part", F.array_position("far", F.col("nearest")) - 1)
        parts = parts.select("*", F.posexplode("far").alias("part", "d")).where(F.col("d") <= F.col("nearest") + wide)
        parts = parts.select("doc", "shingles", "far", "component", F.col("size").alias("whole"), F.concat_ws(".", "region", "part").alias("region"),
                             (F.col("outside") & (F.col("part") == F.col("home_part"))).alias("home"))
        state = parts.groupBy("region").agg(F.count("*").alias("size"), F.sum(F.col("home").cast("int")).alias("homes"), F.max("whole").alias("whole"))
        state = cut(state.where("homes > 0").select("region", "size", "homes", ((F.col("size") > leaf) & ((F.col("size") > 0.8 * F.col("whole")) | F.lit(depth >= deepest))).alias("stuck")))
        parts = cut(sized_join(parts.drop("whole"), state, "region"))
        found = found.union(_against(parts.where("stuck"), "home", "homes", threshold, leaf))
        rows = parts.where("not stuck").select("region", "doc", "shingles", "home")


def _against(rows: DataFrame, few: str, count: str, threshold, leaf: int) -> DataFrame:
    """The sets of each region that are marked by ``few`` (``count`` of them) with all
    of the region's: every block of at most about ``leaf`` of the one with every such
    block of the other."""
    n, m = (F.ceil(F.col(c) / leaf).cast("int") for c in ("size", count))
    columns = ["region", "block", "few_block", "side", "doc", "shingles", "home", "far", "component"]
    every = rows.withColumns({"block": F.pmod(F.xxhash64("doc", F.lit(7)), n).cast("int"), "side": F.lit(0)}).withColumn("few_block", F.explode(F.sequence(F.lit(0), m - 1)))
    marked = rows.where(few).withColumns({"few_block": F.pmod(F.xxhash64("doc", F.lit(8)), m).cast("int"), "side": F.lit(1)}).withColumn("block", F.explode(F.sequence(F.lit(0), n - 1)))
    return every.select(columns).union(marked.select(columns)).groupBy("region", "block", "few_block").applyInPandas(_block_links(threshold), EDGES)


def jaccard_components(docs: DataFrame, size: int = SHINGLE, threshold=THRESHOLD, leaf: int = LEAF) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    docs = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = written(docs.mapInArrow(lean(_signatures, size, threshold), "doc_id long, n long, sig binary, head array<long>"), "signatures")
    sig64 = F.conv(F.hex(F.substring("sig", 1, 7)), 16, 10).cast("long").alias("sig64")
    sets = signed.where("doc_id is not null and n > 0")
    node = _numbered(cut(sets.groupBy("sig").agg(F.min("doc_id").alias("name"), F.first("n").alias("n")).withColumn("sig64", sig64)))

    # step 2: shingles of the heads that two sets or more hold
    heads = sets.select(F.explode("head").alias("token"), sig64)
    heads = heads.repartitionByRange(partitions(spark), "token", "sig64").sortWithinPartitions("token", "sig64")
    shared = written(heads.mapInArrow(lean(_shared), "token long, sig64 long"), "shared")
    df = shared.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = shared.join(df, "token").groupBy("sig64").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    # shingles that no other set holds come first in the order; of the others, a set
    # may share all but m - 1 with the smallest partner before it must share one
    smallest = F.ceil(F.col("n") * threshold[0] / F.lit(float(threshold[1])))
    last = F.size("tokens") - F.floor(smallest / 10).cast("int")
    kept = held.join(node, "sig64").withColumn("last", last).where("last > 0")
    tokens = cut(kept.select("doc", F.explode(F.expr("slice(tokens, 1, last)")).alias("t")).select("doc", "t.token"))
    discard(shared)

    # step 3: a pivot for each shingle
    lead = tokens.groupBy("token").agg(F.count("*").alias("k"), F.min(F.struct(F.xxhash64("doc").alias("o"), "doc")).alias("p")).where("k > 1")
    follow = tokens.join(lead.select("token", F.col("p.doc").alias("pivot")), "token").select("pivot", "doc").distinct()
    follow = cut(follow)
    members = cut(follow.select("doc").distinct().join(node.select("doc", "name", "sig"), "doc"))
    texts = sized_join(docs.withColumnRenamed("doc_id", "name"), cut(members.select("name").distinct()), "name")
    shingles = written(texts.select("text").mapInArrow(lean(_sets, size), "sig binary, shingles binary"), "sets")
    follow = follow.join(members.select("doc", "sig"), "doc")
    regions = written(follow.join(shingles.dropDuplicates(["sig"]), "sig").select(F.col("pivot").cast("string").alias("region"), "doc", "shingles"), "regions")
    discard(shingles)

    links = region_links(regions, threshold, leaf)
    same = components(cut(links.union(_repeated(signed, node))))
    discard(regions)
    # a component's name is the smallest of its sets' names
    label = cut(same.withColumnRenamed("node", "doc").join(node.select("doc", "name"), "doc"))
    lowest = cut(label.groupBy("component").agg(F.min("name").alias("lowest")))
    label = sized_join(label.select("doc", "component"), lowest, "component").select("doc", "lowest")
    named = node.join(label, "doc", "left").select("sig", F.coalesce("lowest", "name").alias("component"))
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("sig")).alias("sig"))
    return out.join(named, "sig", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _numbered(node: DataFrame) -> DataFrame:
    """Sets (sig, name, ...) with their numbers ``doc``: the name, or for the later ones
    of several sets of one name a hash of the digest that no other set has."""
    twice = cut(node.groupBy("name").agg(F.count("*").alias("k"), F.min("sig").alias("first")).where("k > 1").select("name", "first"))
    if twice.isEmpty():
        return node.withColumn("doc", F.col("name"))
    later = cut(sized_join(node, twice, "name").where("sig <> first").select("sig"))
    for salt in count():
        other = cut(later.withColumn("other", F.xxhash64("sig", F.lit(salt))))
        taken = other.join(node.select(F.col("name").alias("other")), "other")
        if taken.isEmpty() and other.groupBy("other").count().where("count > 1").isEmpty():
            return cut(node.join(other, "sig", "left").withColumn("doc", F.coalesce("other", "name")).drop("other"))


def _repeated(signed: DataFrame, node: DataFrame) -> DataFrame:
    """Links between the sets that one doc_id has, where rows repeat it."""
    many = signed.where("doc_id is not null and n > 0").groupBy("doc_id").agg(F.collect_set("sig").alias("sigs")).where(F.size("sigs") > 1)
    pairs = many.select(F.explode("sigs").alias("sig"), F.array_min("sigs").alias("hub")).where("sig <> hub")
    number = node.select("sig", "doc")
    return pairs.join(number.withColumnRenamed("doc", "a"), "sig").join(number.select(F.col("sig").alias("hub"), F.col("doc").alias("b")), "hub").select("a", "b")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))
