"""Secret scans against a plain scan in Python, and texts with very many findings."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest

from roadloom.llm import secrets

SCHEMA = "doc_id long, text string, k1 string, base string, spans string"
BASE = [
    ("assign", re.compile(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
]
LEAST = {"assign": 6, "access": 20, "hex": 24}


def _plain(text):
    spans = []
    for rank, (kind, pattern) in enumerate(BASE):
        for m in pattern.finditer(text or ""):
            if len(m[1] if kind == "assign" else m[0]) >= LEAST[kind]:
                spans.append((m.start(), rank, m.end(), kind))
    spans.sort()
    return spans


def _digest(spans):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()


def _texts():
    rng = random.Random(4)
    parts = ["password=hunter22", "Token : 'ab'", 'API_key"="x1y2z3w4"', "AKIA" + "Q7" * 8, "AKIAQQ", "0123456789abcdef" * 2, "deadbeef", "secret=" + "ab12" * 8, "é☃", "\U0001f600", " ", "\n", "user = bob", "https://host.example/path", "passwd:=", "x" * 30]
    out = [" ".join(rng.choices(parts, k=rng.randrange(1, 30))) for _ in range(60)]
    out += ["".join(rng.choices(parts, k=rng.randrange(1, 400))) for _ in range(30)]
    return [*out, None, "", " "]


def test_base_spans_equal_a_plain_scan(spark):
    texts = _texts()
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in secrets.scan(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(texts):
        want = _plain(t)
        n = Counter(s[3] for s in want)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex, got[i].base_sha256) == (n["assign"], n["access"], n["hex"], _digest(want)), t
        assert {f"{k}:{a}:{b}" for a, _, b, k in want} <= set(got[i].spans.split(",")) or not want


@pytest.mark.parametrize("n", [127, 128, 129, 20_000])
def test_very_many_findings(spark, n):
    text = "☃ " + " ".join(f"token=abc{i:06d}" for i in range(n)) + " token: ab user = bob end"
    df = spark.createDataFrame([(1, text, "x", "y", "z")], SCHEMA)
    start = time.time()
    got = secrets.scan(df).first()
    want = _plain(text)
    assert (got.n_assign, got.base_sha256) == (n, _digest(want)) and got.n_linked >= 1
    masked = secrets.redact(df).first().text
    assert masked == "☃ " + " ".join(["<assign>"] * n) + " <short> <user> end"
    assert time.time() - start < 60


def test_masks_cut_texts_of_many_strides(spark):
    text = "é" * 20_000 + "password=hunter22" + "☃" * 9_000 + "password=hunter23" + "☃a" * 8_192
    assert secrets.redact(spark.createDataFrame([(1, text, "x", "y", "z")], SCHEMA)).first().text == text.replace("password=hunter22", "<assign>").replace("password=hunter23", "<assign>")


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert secrets.scan(none).count() == 0 and secrets.redact(none).count() == 0
