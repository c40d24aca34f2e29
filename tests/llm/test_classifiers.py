"""Classifiers, packing and decontamination: identities, odd tables, long texts, repeats and clashing columns."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from roadloom.llm import decontamination, language_id, lattice_lm, packing, quality, secrets, toxicity

SCHEMA = "doc_id long, text string, lang string, score string, _k string"
LABELS = "doc_id long, quality int, toxic int"


def _prose(lang: int, n: int, rng: random.Random) -> str:
    letters = ["kao", "zue", "tir", "mny", "vlo", "shg"][lang]
    return " ".join("".join(rng.choices(letters, k=4)) for _ in range(n))


def test_sum_of_squares_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    m = quality.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    at, x = rng.choice(50, 12, replace=False), rng.normal(size=12)
    pairs = sum(float(m.factors[i] @ m.factors[j]) * a * b for (i, a), (j, b) in itertools.combinations(zip(at, x, strict=True), 2))
    assert m.logit(at, x) == pytest.approx(0.3 + float(m.linear[at] @ x) + pairs)


def test_interactions_are_learned():
    """Two features that tell only together, as in an exclusive or."""
    rows = [(np.array(a), np.ones(len(a), np.float32)) for a in ([1], [2], [1, 2], [3]) for _ in range(100)]
    y = np.array([float(len(r[0]) == 1 and r[0][0] != 3) for r in rows], dtype=np.float32)
    m = quality.train(rows, y, epochs=200)
    one, two, both, none = (m.logit(np.array(a), np.ones(len(a))) for a in ([1], [2], [1, 2], [3]))
    assert min(one, two) > 0 > max(both, none)


def test_more_languages_than_bits(spark):
    rng = random.Random(1)
    rows = [(i, _prose(i % 6, 40, rng), f"l{i % 6}", "s", "k") for i in range(240)]
    rows += [(500, " ".join(_prose(0, 1, rng) + " " + _prose(1, 1, rng) for _ in range(20)), None, "s", "k"), (501, _prose(3, 30_000, rng), None, "s", "k"), (502, "12", None, "s", "k")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in language_id.identify(df).collect()}
    assert all(got[i].lang_pred == f"l{i % 6}" for i in range(240)) and got[501].lang_pred == "l3" and got[502].lang_pred == "und"
    assert got[500].ambiguous or got[500].lang_pred in ("l0", "l1")
    kept = language_id.keep_identified(df.withColumnRenamed("score", "_language"))
    assert kept.columns == ["doc_id", "text", "lang", "_language", "_k"] and {r.doc_id for r in kept.collect()} >= {*range(240), 501} and kept.filter("doc_id = 502").count() == 0


def test_one_language_or_none(spark):
    rng = random.Random(2)
    one = spark.createDataFrame([(i, _prose(0, 20, rng), "only", "s", "k") for i in range(20)], SCHEMA)
    assert {r.lang_pred for r in language_id.identify(one).collect()} == {"only"}
    assert language_id.identify(one.selectExpr("doc_id", "text", "cast(null as string) as lang")).count() == 20


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)
    some = spark.createDataFrame([(1, "a b c", "x", "s", "k"), (2, None, None, None, None)], SCHEMA)
    assert quality.score(docs, labels).count() == toxicity.score(docs, labels).count() == language_id.identify(docs).count() == packing.pack_documents(docs).count() == 0
    assert quality.score(some, labels).count() == toxicity.score(some, labels).count() == 2
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean(docs, items).count() == 0 and decontamination.clean(some, items).columns == some.columns and decontamination.clean(some, items).count() == 2


def test_long_texts_score_alike(spark):
    rng = random.Random(3)
    rows = [(i, _prose(i % 2, 60, rng), "x", "s", "k") for i in range(120)] + [(900, _prose(1, 40_000, rng), "x", "s", "k"), (900, _prose(1, 40_000, rng), "x", "s", "k")]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], LABELS)
    got = [r for r in quality.score(spark.createDataFrame(rows, SCHEMA), labels).collect() if r.doc_id == 900]
    assert len(got) == 2 and all(r.predicted == 1 for r in got)
    assert all(r.score == toxicity.BASE for r in toxicity.score(spark.createDataFrame(rows[-2:], SCHEMA), labels).collect())


def test_packing_needs_few_sequences(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["word"] * rng.randrange(1, 900)), "x", "s", "k") for i in range(400)] + [(7, None, None, None, None), (7, "word " * 6000, "x", "s", "k")]
    got = packing.pack_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    used, total = defaultdict(int), sum(r.length for r in got)
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048 and len(used) <= -(-total // 2048) * 1.02 + 1
    long_ = sorted((r.piece, r.length) for r in got if r.doc_id == 7 and (r.length > 1000 or r.piece))
    assert long_ == [(0, 2048), (1, 2048), (2, 1905)]


def test_plans_fill_every_sequence_from_the_start():
    rng = np.random.default_rng(5)
    for _ in range(20):
        counts = dict(Counter(rng.integers(1, 40, 200).tolist()))
        spans = defaultdict(list)
        for length, (first, base, offset) in packing.plan(counts, 64).items():
            ends = [*first[1:].tolist(), counts[length]]
            for a, b, s, o in zip(first.tolist(), ends, base.tolist(), offset.tolist(), strict=True):
                for k in range(b - a):
                    spans[s + k].append((o, length))
        assert sum(len(v) for v in spans.values()) == 200
        for v in spans.values():
            end = 0
            for o, n in sorted(v):
                assert o == end
                end += n
            assert end <= 64


def test_decontamination_of_odd_rows(spark):
    item = " ".join(f"i{k}" for k in range(12))
    docs = [(1, f"x {item} y", "l", "s", "k"), (1, "other text of this id altogether here", "l", "s", "k"), (2, None, None, None, None), (2, "", "l", "s", "k"), (None, item.upper(), "l", "s", "k"), (3, "x " * 30_000 + item, "l", "s", "k"), (3, "x " * 30_000 + item, "l", "s", "k")]
    items = spark.createDataFrame([(9, item, "a"), (9, item, "b"), (9, "entirely different words are in this one", "c"), (8, None, "d"), (7, "two words", "e")], "item_id long, text string, doc_id string")
    df = spark.createDataFrame(docs, SCHEMA)
    assert Counter((r.doc_id, r.item_id, r.n_shared) for r in decontamination.report(df, items).collect()) == Counter([(1, 9, 8), (None, 9, 8), (3, 9, 8)])
    left = decontamination.clean(df, items)
    assert left.columns == df.columns and Counter(r.doc_id for r in left.collect()) == Counter([1, 2, 2])


def test_operators_ignore_other_columns(spark):
    rows = [(i, "password = hunter22 and more", "l", "s", "k") for i in (5, 5, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "lang as base", "score as spans", "_k as k1", "1 as word")
    assert secrets.scan(df).count() == lattice_lm.score(df).count() == packing.pack_documents(df).count() == 3
    assert secrets.redact(df).columns == df.columns and {r.text for r in secrets.redact(df).collect()} == {"<assign> and more"}
