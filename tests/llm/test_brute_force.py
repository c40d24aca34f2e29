"""Pair, passage, vector and pipeline operators against brute force on small tables with nulls, ties and repeats."""

import hashlib
import random
from collections import Counter

import numpy as np

from roadloom.llm import decontamination, neighbours, ngram_join, secrets, substring_dedup

SCHEMA = "doc_id long, text string, k1 string, label string, n int"


def _docs(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    word = lambda: rng.choice(["ab", "cd", "é", "xyz", "q9"]) + str(rng.randrange(300))
    passage, base, out = [word() for _ in range(60)], [word() for _ in range(120)], []
    for i in range(60):
        w = [word() for _ in range(rng.randrange(1, 150))]
        if i % 3 == 0:
            w[5:5] = passage[rng.randrange(20) : 40 + rng.randrange(20)]
        if i % 5 == 0:
            w = list(base)
            w[rng.randrange(120)] = word()
        out.append((i, " \t".join(w)))
    out += [(100, out[5][1]), (101, out[5][1]), (102, None), (103, ""), (104, "one two"), (105, "one two"), (106, "  \n")]
    out += [(107, " ".join(passage + passage)), (None, " ".join(passage)), (2, out[2][1])]
    return [(d, t, "x", "y", 1) for d, t in out]


def test_substring_dedup(spark):
    rows = _docs()
    got = Counter(tuple(r) for r in substring_dedup.dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    first, want = {}, Counter()
    order = sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
    for d, text, *_ in order:
        w = substring_dedup.words(text)
        for i in range(len(w) - 19):
            key = tuple(w[i : i + 20])
            first[key] = min(first.get(key, (1 << 60, 0)), (-1 if d is None else d, i))
    for d, text, *_ in order:
        w = substring_dedup.words(text)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (-1 if d is None else d, i):
                gone[i : i + 20] = [True] * 20
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want


def test_ngram_join(spark):
    rows = _docs(4)
    got = Counter(tuple(r) for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect())
    sets = [set(ngram_join.shingles(r[1]).tolist()) for r in rows]
    up, links = list(range(len(rows))), [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                links[i], links[j] = links[i] + 1, links[j] + 1
                old, new = up[i], up[j]
                up = [new if u == old else u for u in up]
    least = {}
    for u, r in zip(up, rows, strict=True):
        least[u] = min(least.get(u, 1 << 60), -1 if r[0] is None else r[0])
    want = Counter((r[0], None if least[u] == -1 else least[u], k) for u, r, k in zip(up, rows, links, strict=True))
    assert got == want


def test_ngram_join_keeps_one_of_each_class(spark):
    docs = spark.createDataFrame(_docs(4), SCHEMA)
    kept = ngram_join.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and not {100, 101, 105} & set(ids) and {102, 103, 106} <= set(ids)


def test_of_one_class_one_row_stays_with_shared_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near, other = text + " more", " ".join(f"v{i}" for i in range(50))
    rows = [(1, text, "x", "y", 1), (1, near, "x", "y", 1), (None, other, "x", "y", 1), (None, other + " end", "x", "y", 1), (7, None, "x", "y", 1), (8, None, "x", "y", 1)]
    assert Counter(r.doc_id for r in ngram_join.keep_first(spark.createDataFrame(rows, SCHEMA)).collect()) == Counter([1, None, 7, 8])


def test_prefixes_shorten_until_the_recall_is_reached():
    floor = ngram_join.shortest()
    assert ngram_join.met(0.8, floor) >= ngram_join.RECALL > ngram_join.met(0.8, floor + 1)
    assert ngram_join.next_depth({0.99: 100}, 8, floor) is None
    assert ngram_join.next_depth({0.8: 100}, 8, floor) == floor and ngram_join.next_depth({}, 8, floor) == floor
    assert floor < ngram_join.next_depth({0.86: 100}, 8, floor) < 8
    assert ngram_join.next_depth({0.8: 100}, floor, floor) is None


def test_links_of_a_large_group_by_any_prefix(spark, monkeypatch):
    """Many near copies over several blocks, found at the leaves and by shortened prefixes."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(150)] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(w), "x", "y", 1))
    sets = [set(ngram_join.shingles(r[1]).tolist()) for r in rows]
    want = {r[0]: sum(len(s & t) >= 0.8 * len(s | t) for t in sets) - 1 for r, s in zip(rows, sets, strict=True)}
    assert {r.doc_id: r.n_links for r in ngram_join.join(spark.createDataFrame(rows, SCHEMA)).collect()} == want
    assert len({*want.values()}) > 3


def test_decontamination_by_partition(spark):
    rng = random.Random(7)
    items = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(n))) for i, n in enumerate((3, 5, 6, 12, 20, 60, 200, 200))]
    rows = [(i, " ".join(f"w{rng.randrange(500)}" for _ in range(150)) + " " + items[i % 8][1], "x", "y", 1) for i in range(24)]
    rows += [(50, " ".join(items[6][1].split()[:180]), "x", "y", 1), (51, " ".join(items[6][1].split()[:120]), "x", "y", 1), (52, None, "x", "y", 1)]
    docs, benchmark = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string")

    def shingles(text):
        w = (text or "").split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    want = {(d, i) for d, t, *_ in rows for i, x in items if shingles(x) and len(shingles(x) & shingles(t)) >= 0.8 * len(shingles(x))}
    assert {(r.doc_id, r.item_id) for r in decontamination.report(docs, benchmark).collect()} == want and (50, 6) in want and (51, 6) not in want
    assert {r.doc_id for r in decontamination.clean(docs, benchmark).collect()} == {r[0] for r in rows} - {d for d, _ in want}
    bounds = [(0, 2**62), (7, -(2**62))]
    seen = decontamination.shown(docs.selectExpr("doc_id", "text", "0L as k"), bounds).collect()
    n = Counter(r.partition for r in seen)
    assert all(r.h <= dict(bounds)[r.partition] for r in seen) and 0 < 2 * n[7] < n[0]
    assert decontamination.report(docs, benchmark.filter("false")).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in v], "c") for i, v in enumerate(rng.normal(size=(900, 16)))]
    rows += [(900, None, "c"), (901, [0.0] * 16, "c"), (902, [float("nan")] + [1.0] * 15, "c"), (903, [1.0, None] + [1.0] * 14, "c"), (904, [1.0], "c"), (None, [1.0] * 16, "c")]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")).collect()
    x, hits = np.array([r[1] for r in rows[:900]]), 0
    assert len(got) == 90 and {r.vec_id for r in got} <= set(range(900))
    for q in range(0, 900, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11)) and all(abs(d[r.vec_id] - r.score) < 1e-12 for r in own)
        d[q] = np.inf
        hits += len(set(np.argsort(d)[:10].tolist()) & {r.vec_id for r in own})
    assert hits >= 81


def test_repeated_queries_and_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 8)], "c") for i in range(1, 300) if i % 100]
    rows += [(100, [1.0] * 8, "c"), (100, [1.0] * 8, "c"), (200, [2.0, 1.0] * 4, "c")]
    rows = [r for r in rows if any(r[1])]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")).collect()
    for q, v, times in ((100, [1.0] * 8, 2), (200, [2.0, 1.0] * 4, 1)):
        d = sorted((float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum())), i) for i, x, _ in rows if i != q)[:10]
        own = Counter((r["rank"], r.vec_id, round(r.score, 9)) for r in got if r.query_id == q)
        assert sum(own.values()) == 10 * times and set(own.values()) == {times}
        assert sorted(s for _, _, s in own) == [round(s, 9) for s, _ in d]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.dedup(docs).count() == ngram_join.join(docs).count() == ngram_join.keep_first(docs).count() == 0
    assert neighbours.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_secrets_are_redacted(spark):
    rows = [(1, "x password = hunter22 y", "a", "b", 1), (2, None, "a", "b", 1), (3, "plain", "a", "b", 1), (3, "plain", "a", "b", 1)]
    out = secrets.redact(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    assert Counter(r.text for r in out.collect()) == Counter({"x <assign> y": 1, None: 1, "plain": 2})
