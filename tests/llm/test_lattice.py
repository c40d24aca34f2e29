"""The lattice language model against enumerated segmentations and counts made by hand."""

import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from roadloom.llm import lattice_lm

NAMES = ["<0x%02X>" % b for b in range(256)] + ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "aba", "é"]
WORDS = [b"a", b"ab", b"abab", "éab".encode(), "x☃a".encode(), b"abbaabab", b"a" * 400]
SCHEMA = "doc_id long, text string, word string, key int, t int"


def _segmentations(s: str):
    for cuts in product([0, 1], repeat=len(s) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(s)]
        yield [s[a:b] for a, b in zip(at, at[1:], strict=False)]


def _model():
    rng = np.random.default_rng(3)
    return lattice_lm.Lattice(NAMES, np.arange(len(NAMES), dtype=float), rng.integers(0, 50, len(NAMES)).astype(float), 4.0)


def _ways(m, word):
    """Pieces (bytes where a character has none) and probability of each segmentation."""
    logs = dict(zip(NAMES, m.logs.tolist(), strict=True))
    for seg in _segmentations("▁" + word.decode()):
        used = [p for x in seg for p in ([x] if x in logs else ["<0x%02X>" % b for b in x.encode()] if len(x) == 1 else [None])]
        if None not in used:
            yield used, math.exp(sum(logs[p] for p in used))


def test_marginals_and_expected_counts_equal_enumeration():
    m = _model()
    words = WORDS[:-1]
    got = m.words(words)
    want, counts = [], Counter()
    for w in words:
        ways = list(_ways(m, w))
        z = sum(p for _, p in ways)
        want.append(math.log(z))
        for used, p in ways:
            for x in used:
                counts[x] += p / z
    assert np.allclose(got, want)
    assert np.allclose(m.expected(words), [counts[n] for n in NAMES])
    assert np.isfinite(m.words(WORDS)).all() and len(m.words([])) == 0


def test_counts_and_scores(spark, monkeypatch):
    monkeypatch.setattr(lattice_lm, "HOT_WORDS", 6)
    rows = [(i, " ".join(["Ab", "cd\u00a0x", "É", f"w{i % 5}", "☃" * (i % 3 + 1)] * (1 + i % 4)), "c", 1, 1) for i in range(40)]
    rows += [(50, None, "c", 1, 1), (51, "", "c", 1, 1), (None, "ab only", "c", 1, 1), (3, rows[3][1], "c", 1, 1), (52, "long " * 5000, "c", 1, 1)]
    got = sorted(map(tuple, lattice_lm.score(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, *_ in rows]
    tokens = [[*(w.decode() for w in (t or "").encode().lower().split()), None] for _, t, *_ in rows]
    c = Counter(w for h, ws in zip(held, tokens, strict=True) for w in ws if not h)
    n, v = sum(c.values()), len(c)
    want = sorted(((r[0], h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for r, h, ws in zip(rows, held, tokens, strict=True)), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == pytest.approx(w[5]) and math.isfinite(g[6]) and g[7] < 0 for g, w in zip(got, want, strict=True))
    # the model's score by word: equal whether a word is known to all workers or joined
    monkeypatch.setattr(lattice_lm, "HOT_WORDS", 0)
    again = sorted(map(tuple, lattice_lm.score(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    assert np.allclose([g[5:] for g in got], [g[5:] for g in again])


def test_probabilities_of_tokens_sum_to_at_most_one(spark):
    rows = [(i, f"aa{i % 7}", "c", 1, 1) for i in range(60)]
    got = lattice_lm.score(spark.createDataFrame(rows + [(900, "", "c", 1, 1)], SCHEMA)).collect()
    end = next(r.score for r in got if r.doc_id == 900)
    kinds = {f"aa{i % 7}": 0.0 for i in range(7)}
    for r in got:
        if r.doc_id != 900:
            kinds[rows[r.doc_id][1]] = 10 ** (r.score - end)
    assert 0 < sum(kinds.values()) + 10**end <= 1 + 1e-9


def test_empty_table(spark):
    assert lattice_lm.score(spark.createDataFrame([], SCHEMA)).count() == 0
