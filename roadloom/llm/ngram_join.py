"""N-gram Jaccard join by a MinHash LSH forest with exact verification.

A document's set is that of its WORDS-word shingles (of the lower-cased text's runs of letters and digits); documents
of one set are a class, so copies are never paired. Each class has a signature of TREES x DEPTH minima: in each tree a
path of DEPTH values in a prefix trie. The join starts at the leaves, where classes share whole paths, and verifies
the pairs that meet there. Each verified link of similarity s was met with probability 1 - (1 - s ** depth) ** TREES,
so the links found tell how many were missed (Horvitz-Thompson) and what recall any shorter prefix would have; the
prefixes are shortened to the longest such length and new pairs verified, until the estimated recall is RECALL. The
shortest length is the one at which even pairs at the threshold meet with that probability.

Only pairs that meet are verified, each once: at its longest shared prefix among the lengths used, in the first tree
where it is shared. A trie node's classes are dealt to blocks of about BLOCK classes and BLOCK_SHINGLES shingles;
every pair of blocks is one group of bounded size, which counts common shingles and returns, per class, its number of
links, the edges of a spanning forest, and a histogram of similarities. Nodes with the same classes are verified once.
A class is copied to each pair that its block is in, so rows read grow with a node's classes times its blocks, and
work with the square of the blocks, as exact numbers of links need; rows returned grow with the classes. Classes of
the result are connected components of verified links, found by minimum labels that pass through edges and jump, each
round written to the shared folder.

Defined cases: a text of one to four words has its whole word sequence as its only shingle; null, empty and wordless
texts are a class of their own for each row, without links; repeated rows are links of each other; a null doc_id
comes before all others and gives a null class; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches, text_rows

WORDS = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 8
RECALL = 0.9999
#: Classes and shingles in a block of verification, about.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22
#: Cells of an incidence matrix that are in memory at a time.
CELLS = 1 << 23
#: Steps of similarity in a histogram of links.
STEPS = 200
NO_ID = -(1 << 63)
_WORD = re.compile(r"[^\W_]+")


def met(similarity, depth: int):
    """Probability that a pair of this similarity shares a prefix of ``depth`` values in some tree."""
    return 1 - (1 - similarity**depth) ** TREES


def shortest(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold is met with the target recall."""
    return next((d for d in range(DEPTH, 1, -1) if met(threshold, d) >= recall), 1)


def next_depth(found: dict[float, int], depth: int, floor: int, recall: float = RECALL) -> int | None:
    """The longest prefix that is estimated to have the target recall, if ``depth`` has not; ``found`` counts links by similarity."""
    total = sum(n / met(s, depth) for s, n in found.items())
    enough = lambda d: sum(n * met(s, d) / met(s, depth) for s, n in found.items()) >= recall * total
    if not found:  # nothing to judge by
        return floor if depth > floor else None
    return None if depth <= floor or enough(depth) else next((d for d in range(depth - 1, floor, -1) if enough(d)), floor)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    import xxhash

    w = _WORD.findall((text or "").lower())
    if not w:
        return np.zeros(0, dtype=np.uint64)
    joined = [" ".join(w[i : i + WORDS]) for i in range(max(1, len(w) - WORDS + 1))]
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, joined), dtype=np.uint64, count=len(joined)))


_RNG = np.random.default_rng(41)
_FACTORS = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(1, 1 << 63, TREES * DEPTH, dtype=np.uint64)


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of the set under each of the hash functions."""
    out = np.full(len(_FACTORS), np.uint64((1 << 64) - 1))
    for i in range(0, len(s), 4096):
        h = (s[i : i + 4096] ^ (s[i : i + 4096] >> np.uint64(31)))[None, :] * _FACTORS[:, None] + _SHIFTS[:, None]
        out = np.minimum(out, (h ^ (h >> np.uint64(33))).min(axis=1))
    return out


def path(sig: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """The node of each tree's prefix of ``floor`` values, as a hash, and the values further down the tree."""
    v = sig.reshape(TREES, DEPTH)
    h = np.arange(TREES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(floor):
        h = (h ^ v[:, k] ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h.view(np.int64), (v[:, floor:] >> np.uint64(32)).astype(np.uint32).view(np.int32).ravel()


def at_depth(depth: int, floor: int) -> Column:
    """Nodes of a row's prefixes of ``depth`` values, from its columns ``nodes`` and ``deeper``."""
    if depth == floor:
        return F.col("nodes")
    step = DEPTH - floor
    return F.transform("nodes", lambda h, t: F.xxhash64(h, *(F.get("deeper", t * step + k) for k in range(depth - floor))))


def grown(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: it is merged at every size, never broadcast."""
    return df.hint("merge")


def components(members: DataFrame, scratch: Scratch) -> DataFrame:
    """(member, label): ``members`` has (node, member); members of a node hang together, the least of all is the label."""
    labels = scratch.cut(members.select("member", F.col("member").alias("label")).distinct())
    while True:
        low = members.join(grown(labels), "member").groupBy("node").agg(F.min("label").alias("low"))
        low = scratch.cut(low)
        best = members.join(grown(low), "node").groupBy("member").agg(F.min("low").alias("low"))
        best = scratch.cut(labels.join(grown(best), "member").select("member", F.col("label").alias("old"), F.least("label", "low").alias("label")))
        jump = best.select(F.col("member").alias("label"), F.col("label").alias("further"))
        new = scratch.cut(best.join(grown(jump), "label").select("member", "old", F.least("label", "further").alias("label")))
        changed = new.filter("old <> label").limit(1).count()
        scratch.drop(labels, low, best)
        labels = new.select("member", "label")
        labels._scratch_path = new._scratch_path
        if not changed:
            return labels


def _sketches(floor: int):
    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for f in frames:
            sets = [shingles(t) for t in f["text"]]
            paths = [path(signature(s), floor) if len(s) else (None, None) for s in sets]
            yield pd.DataFrame(
                {
                    "doc_id": f["doc_id"],
                    "k1": f["k1"],
                    "set_id": pd.array([xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None for s in sets], dtype="Int64"),
                    "size": np.array([len(s) for s in sets], dtype=np.int64),
                    "nodes": [p for p, _ in paths],
                    "deeper": [p for _, p in paths],
                }
            )

    return make


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s = [shingles(t).view(np.int64) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("member"), pa.array(s, pa.list_(pa.int64()))], names=["member", "s"])


def _common(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each of ``a`` with each of ``b``."""
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    ids = np.intersect1d(flat_a, flat_b)
    row_a, row_b = np.repeat(np.arange(len(a)), [len(x) for x in a]), np.repeat(np.arange(len(b)), [len(x) for x in b])

    def cells(flat: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        col = np.minimum(np.searchsorted(ids, flat), max(len(ids) - 1, 0))
        ok = ids[col] == flat if len(ids) else np.zeros(len(flat), dtype=bool)
        order = np.argsort(col[ok], kind="stable")
        return row[ok][order], col[ok][order]

    (ra, ca), (rb, cb) = cells(flat_a, row_a), cells(flat_b, row_b)
    out, wide = np.zeros((len(a), len(b)), dtype=np.float64), max(256, CELLS // max(len(a), len(b)))
    for lo in range(0, len(ids), wide):
        hi = min(lo + wide, len(ids))
        m = []
        for r, c, n in ((ra, ca, len(a)), (rb, cb, len(b))):
            i, j = np.searchsorted(c, [lo, hi])
            x = np.zeros((n, hi - lo), dtype=np.float32)
            x[r[i:j], c[i:j] - lo] = 1.0
            m.append(x)
        out += m[0] @ m[1].T
    return out


def _forest(rows: np.ndarray, cols: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the linked pairs."""
    up = list(range(n))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    out = []
    for i, j in zip(rows.tolist(), cols.tolist(), strict=True):
        p, q = root(i), root(j)
        if p != q:
            up[q] = p
            out.append((i, j))
    return out


def _rows(column: pa.ListArray) -> list[np.ndarray]:
    flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of rows of the same keys, across batches."""
    kept: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(c).to_numpy() for c in keys], axis=1)
        edges = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            own = tuple(k[x].tolist())
            if kept and own != last:
                yield pa.concat_batches(kept)
                kept = []
            kept.append(b.slice(x, y - x))
            last = own
    if kept:
        yield pa.concat_batches(kept)


def _share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the rows of ``a`` and ``b`` (classes x trees) have the same node in some tree."""
    out = np.zeros((len(a), len(b)), dtype=bool)
    for t in range(a.shape[1]):
        out |= a[:, t][:, None] == b[:, t][None, :]
    return out


def _verify(threshold: float):
    """Links of pairs of blocks: rows (member, other, links); without ``other`` links are counted, without ``member`` pairs by similarity."""

    def links(g: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        i, j, tree = (g.column(c)[0].as_py() for c in ("low", "high", "tree"))
        member, n, block = (g.column(c).to_numpy() for c in ("member", "n", "block"))
        sets, nodes, before = _rows(g.column("s")), np.stack(_rows(g.column("here"))), np.stack(_rows(g.column("before")))
        at = [np.flatnonzero(block == i), np.flatnonzero(block == j)]
        if not len(at[0]) or not len(at[1]):
            return
        # pairs that met deeper down or in an earlier tree have been verified there
        open_ = ~_share(before[at[0]], before[at[1]]) & ~_share(nodes[at[0], :tree], nodes[at[1], :tree])
        if i == j:
            open_ &= np.triu(np.ones(open_.shape, dtype=bool), 1)
        a, b = at[0][open_.any(axis=1)], at[1][open_.any(axis=0)]
        if not len(a):
            return
        open_ = open_[open_.any(axis=1)][:, open_.any(axis=0)]
        sa, sb = [sets[k] for k in a], [sets[k] for k in b]
        na, nb = np.array([len(x) for x in sa]), np.array([len(x) for x in sb])
        common = np.array([[float(len(np.intersect1d(sa[0], sb[0], assume_unique=True)))]]) if len(a) == len(b) == 1 else _common(sa, sb)
        union = na[:, None] + nb[None, :] - common
        near = open_ & (common >= threshold * union - 1e-9)
        r, c = np.nonzero(near)
        if not len(r):
            return
        for who, k in ((a, near @ n[b]), (b, near.T @ n[a])):
            yield member[who][k > 0], np.full((k > 0).sum(), NO_ID), k[k > 0]
        edges = np.array(_forest(a[r], b[c], len(member)))
        yield member[edges[:, 0]], member[edges[:, 1]], np.zeros(len(edges), dtype=np.int64)
        steps, times = np.unique(np.floor((common / union)[r, c] * STEPS + 1e-9).astype(np.int64), return_counts=True)
        yield np.full(len(steps), NO_ID), steps, times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for g in _groups(batches, ["node", "low", "high"]):
            for part in links(g):
                out.append(part)
                size += len(part[0])
            if size > 10_000:
                yield _columns(out)
                out, size = [], 0
        if out:
            yield _columns(out)

    return run


def _columns(parts: list[tuple]) -> pa.RecordBatch:
    known = lambda k: (x := np.concatenate([p[k] for p in parts]).astype(np.int64), x == NO_ID)
    arrays = [pa.array(x, pa.int64(), mask=none) for x, none in (known(0), known(1))]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(known(2)[0], pa.int64())], names=["member", "other", "links"])


def _met(near: DataFrame, held: DataFrame, done: DataFrame | None, depth: int, floor: int, before: int | None, threshold: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Verified links of pairs that meet at prefixes of ``depth`` but not of ``before``, and the keys of all nodes' sets of classes."""
    at = near.select("member", "size", F.posexplode(at_depth(depth, floor)).alias("tree", "node"))
    same = [F.count("*").alias("k"), F.sum("size").alias("shingles"), F.sum(F.xxhash64("member") % (1 << 40)).alias("h1"), F.bit_xor(F.xxhash64("member", F.lit(7))).alias("h2")]
    every = at.groupBy("node").agg(F.min("tree").alias("tree"), *same).filter("k > 1")
    every = scratch.cut(every.groupBy("k", "h1", "h2").agg(F.max("shingles").alias("shingles"), F.min(F.struct("tree", "node")).alias("at")))
    todo = (every.join(grown(done), ["k", "h1", "h2"], "left_anti") if done is not None else every).select("at.node", F.ceil(F.greatest(F.col("k") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    dealt = at.join(grown(todo), "node").withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))
    dealt = dealt.select("node", "tree", "member", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("node", "tree", "member", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    none = F.array().cast("array<bigint>")
    whole = held.select("member", "n", "s", at_depth(depth, floor).alias("here"), (at_depth(before, floor) if before else none).alias("before"))
    keys = ["node", "low", "high"]
    rows = dealt.join(grown(whole), "member").repartition(*keys).sortWithinPartitions(*keys)
    return scratch.cut(rows.mapInArrow(_verify(threshold), "member long, other long, links long")), every.select("k", "h1", "h2")


def classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, k1 (hash of the text), first (least doc_id and k1 of the row's class), n_links of each row; null ``first`` for texts without words."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "ngram-join")
    keyed = text_rows(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("k1"), "text")
    floor = shortest(threshold, recall)
    rows = scratch.cut(keyed.mapInPandas(_sketches(floor), "doc_id long, k1 long, set_id long, size long, nodes array<long>, deeper array<int>"))
    worded = rows.filter("set_id is not null").withColumnRenamed("set_id", "member")
    any_of = [F.any_value(c).alias(c) for c in ("size", "nodes", "deeper")]
    sets = scratch.cut(worded.groupBy("member").agg(F.min(F.struct("doc_id", "k1")).alias("first"), F.count("*").alias("n"), *any_of))
    # classes that meet any other at the shortest prefix; only their sets are needed
    at = sets.select("member", F.explode("nodes").alias("node"))
    shared = scratch.cut(at.groupBy("node").agg(F.count("*").alias("k")).filter("k > 1").select("node"))
    meeting = at.join(grown(shared), "node").select("member").distinct()
    near = scratch.cut(sets.join(grown(meeting), "member").select("member", "first.doc_id", "first.k1", "n", "size", "nodes", "deeper"))
    # a set is read once, from one of its rows: repeated rows give the same set
    of = keyed.join(grown(near.select("doc_id", "k1", "member")), ["doc_id", "k1"]).dropDuplicates(["doc_id", "k1"])
    held = of.select("member", "text").mapInArrow(_set_rows, "member long, s array<long>")
    held = scratch.cut(held.join(grown(near.select("member", "n", "nodes", "deeper")), "member"))
    links, done, before, depth, found = None, None, None, DEPTH, Counter()
    while depth is not None:
        new, done = _met(near.select("member", "size", "nodes", "deeper"), held, done, depth, floor, before, threshold, scratch)
        links = new if links is None else links.unionByName(new)
        for r in new.filter("member is null").groupBy("other").agg(F.sum("links").alias("n")).collect():
            found[min(1.0, max(threshold, (r["other"] + 0.5) / STEPS))] += r["n"]
        before, depth = depth, next_depth(found, depth, floor, recall)
    linked = links.filter("member is not null and other is null").groupBy("member").agg(F.sum("links").alias("links"))
    edges = links.filter("member is not null and other is not null").select(F.xxhash64("member", "other").alias("node"), F.explode(F.array("member", "other")).alias("member"))
    joined = components(scratch.cut(edges), scratch)
    whole = sets.select("member", "first", "n").join(grown(joined), "member", "left").join(grown(linked), "member", "left")
    whole = scratch.cut(whole.select("member", "first", "n", F.coalesce("label", "member").alias("label"), F.coalesce("links", F.lit(0)).alias("links")))
    least = scratch.cut(whole.groupBy("label").agg(F.min("first").alias("least")))
    per_set = scratch.cut(whole.join(grown(least), "label").select("member", F.col("least").alias("first"), (F.col("links") + F.col("n") - 1).alias("n_links")))
    some = worded.join(grown(per_set), "member").select("doc_id", "k1", "first", "n_links")
    none = rows.filter("set_id is null").select("doc_id", "k1", F.lit(None).cast("struct<doc_id:bigint,k1:bigint>").alias("first"), F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none)


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links of each row: the least doc_id of its class and the number of other rows at the threshold or above."""
    known = lambda c: F.when(c != NO_ID, c)
    first = F.coalesce(F.col("first.doc_id"), F.col("doc_id"))
    return classes(docs, threshold).select(known(F.col("doc_id")).alias("doc_id"), known(first).alias("class_id"), "n_links")


def keep_first(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of ``docs``, with its own columns: that of the least doc_id (null first) and, of these, the least hash of the text.

    Rows without words stay, but of rows that repeat doc_id and text one stays. Only these repeated rows are
    compared whole; all others stay where they are, but for the merge with the keys of rows that go.
    """
    own, key = docs.columns, ("_ngram_id", "_ngram_k1")
    while set(key) & set(own):
        key = tuple(k + "_" for k in key)
    scratch = Scratch(docs.sparkSession, "ngram-join")
    keys = [F.col("doc_id").alias(key[0]), F.col("k1").alias(key[1])]
    rest = scratch.cut(classes(docs, threshold).filter("first < struct(doc_id, k1)").select(*keys).distinct())
    keyed = docs.withColumns({key[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), key[1]: F.xxhash64(F.col("text").cast("string"))})
    twice = scratch.cut(keyed.groupBy(*key).count().filter("count > 1").select(*key))
    out = keyed.join(grown(rest), list(key), "left_anti")
    if not twice.isEmpty():
        once = out.join(grown(twice), list(key), "left_semi").dropDuplicates(list(key))
        out = out.join(grown(twice), list(key), "left_anti").select(*out.columns).unionByName(once.select(*out.columns))
    return out.select(*own)
