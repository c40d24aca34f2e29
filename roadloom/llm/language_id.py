"""Language identification with error-correcting output codes.

Each language has a codeword of bits. For each bit a binary classifier over hashed character n-grams (two and three
code points of the lower-cased text) says on which side the text lies; it is a log-ratio of the two sides' mean
n-gram distributions. Decoding is loss-weighted: each bit's logistic loss against a codeword's bit counts by how
well that bit separates that language on the training sample, and the language with the least loss wins. The two
nearest codewords give the probability ``score`` and the flag ``ambiguous``.

Defined cases: a null, empty or letterless text is ``und`` with score 0 and not ambiguous; without any labelled row
every text is ``und``; with one language every text with a letter is that language, score 1; ties go to the language
first in order; repeated rows each get their own result; rows of any width give the same columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, rank_in_sample, small_batches, text_rows

#: Labelled rows per language that the classifiers are fitted on (an upper bound in expectation, drawn by id hash).
FIT_ROWS = 1500
#: Languages that are learned, the commonest, at most.
LANGUAGES = 1000
BUCKETS = 1 << 15
CHUNK = 1 << 18
#: Two nearest codewords closer in probability than this make a text ambiguous.
AMBIGUOUS = 0.05
_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str | None) -> bool:
    """Whether any code point is a letter (Unicode category L)."""
    return bool(text) and (_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashed n-grams of the whole text, in pieces: ids under BUCKETS for two code points, above for three."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    a = np.where((a < 97) | ((a > 122) & (a < 192)), np.uint32(32), a)
    for i in range(0, max(1, len(a)), CHUNK):
        c = np.concatenate(([np.uint32(32)], a[i : i + CHUNK], [np.uint32(32)])).astype(np.uint32)
        two = c[:-1] * np.uint32(2654435761) + c[1:] * np.uint32(2246822519)
        three = two[:-1] * np.uint32(3266489917) + c[2:] * np.uint32(668265263)
        two = two[(c[:-1] != 32) | (c[1:] != 32)]
        three = three[(c[:-2] != 32) | (c[1:-1] != 32)]
        yield np.concatenate((two >> np.uint32(17), (three >> np.uint32(17)) + np.uint32(BUCKETS))).astype(np.int64)


def codebook(n: int, seed: int = 7) -> np.ndarray:
    """+1/-1 codewords, one row a language: exhaustive codes up to five languages, else the best of random ones."""
    if n <= 5:
        cols = [[1] + [1 if (k >> i) & 1 else -1 for i in range(n - 1)] for k in range((1 << (n - 1)) - 1)]
        return np.array(cols, dtype=np.float32).T.reshape(n, -1)
    rng, bits = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n)))
    best, reach = None, -1
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], size=(n, bits)).astype(np.float32)
        m = m[:, np.abs(m.sum(axis=0)) < n]
        d = (m.shape[1] - m @ m.T) / 2
        near = d[~np.eye(n, dtype=bool)].min()
        if near > reach:
            best, reach = m, near
    return best


class Model:
    """Fitted bits: weights a bucket, codewords, reliability of each bit for each language, temperature."""

    def __init__(self, langs: list[str], weights: np.ndarray, code: np.ndarray, trust: np.ndarray, scale: np.ndarray):
        self.langs, self.weights, self.code, self.trust, self.scale = langs, weights, code, trust, scale

    def margins(self, text: str) -> np.ndarray:
        """Mean log-ratio of each bit over the text's n-grams."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for g in grams(text):
            total += self.weights[g].sum(axis=0, dtype=np.float64)
            n += len(g)
        return total / max(n, 1)

    def losses(self, margins: np.ndarray) -> np.ndarray:
        """Weighted logistic loss against each codeword; margins may have leading axes."""
        z = margins[..., None, :] * self.scale * self.code
        return (self.trust * np.logaddexp(0.0, -z)).sum(axis=-1)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability, ambiguous."""
        if not self.langs or not has_letter(text):
            return "und", 0.0, False
        if len(self.langs) == 1:
            return self.langs[0], 1.0, False
        loss = self.losses(self.margins(text)) * self.code.shape[1]
        p = np.exp(loss.min() - loss)
        p /= p.sum()
        k = int(p.argmax())
        two = np.partition(p, -2)[-2:]
        return self.langs[k], float(p[k]), bool(two[1] - two[0] < AMBIGUOUS)


def _histograms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}

    def rows():
        for lang, h in sums.items():
            at = np.flatnonzero(h)
            yield pd.DataFrame({"lang": lang, "g": at, "n": h[at]})

    for f in frames:
        for lang, text in zip(f["lang"], f["text"], strict=True):
            if lang not in sums:
                if len(sums) >= 64:
                    yield from rows()
                    sums.clear()
                sums[lang] = np.zeros(2 * BUCKETS, dtype=np.int64)
            for g in grams(text):
                sums[lang] += np.bincount(g, minlength=2 * BUCKETS)
    yield from rows()


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on documents with text and a language whose fold (crc32 of the id, mod 4) is not 2."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "language-id")
    rows = text_rows(docs, F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    rows = rows.filter(fold("doc_id", 4) != 2)
    found = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()}
    langs = sorted(found)
    if not langs:
        return Model([], np.zeros((1, 1)), np.zeros((0, 0)), np.zeros((0, 0)), np.ones(1))
    share = spark.createDataFrame([(k, min(1.0, fit_rows / found[k])) for k in langs], "lang string, share double")
    drawn = rows.join(F.broadcast(share), "lang").filter(rank_in_sample("doc_id", 3) < F.col("share"))
    sample = scratch.cut(drawn.select("lang", "text").limit(2 * fit_rows * len(langs)))
    hist = sample.mapInPandas(_histograms, "lang string, g int, n long").groupBy("lang", "g").agg(F.sum("n").alias("n"))
    counts = np.full((len(langs), 2 * BUCKETS), 0.1)
    got = hist.toPandas()
    at = {k: i for i, k in enumerate(langs)}
    counts[got["lang"].map(at).to_numpy(dtype=int), got["g"].to_numpy()] += got["n"].to_numpy()
    if len(langs) == 1:
        scratch.drop(sample)
        return Model(langs, np.zeros((1, 1)), np.zeros((1, 0)), np.zeros((1, 0)), np.ones(1))
    prob = counts / counts.sum(axis=1, keepdims=True)
    code = codebook(len(langs))
    sides = [[prob[code[:, b] == s].mean(axis=0) for s in (1, -1)] for b in range(code.shape[1])]
    weights = np.stack([np.log(one) - np.log(other) for one, other in sides], axis=1).astype(np.float32)
    model = Model(langs, weights, code, np.ones_like(code), np.ones(code.shape[1]))
    shared = spark.sparkContext.broadcast(model)

    def margins(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"lang": f["lang"], "m": [shared.value.margins(t).tolist() for t in f["text"]]})

    seen = sample.mapInPandas(margins, "lang string, m array<double>").toPandas()
    shared.destroy()
    scratch.drop(sample)
    m = np.stack(seen["m"].to_numpy()) if len(seen) else np.zeros((0, code.shape[1]))
    y = seen["lang"].map(at).to_numpy(dtype=int) if len(seen) else np.zeros(0, dtype=int)
    right = (m * code[y] > 0).astype(float)
    trust = np.stack([(right[y == k].sum(axis=0) + 1.0) / ((y == k).sum() + 2.0) for k in range(len(langs))])
    trust = np.maximum(trust - 0.5, 1e-3)
    model.trust = trust / trust.sum(axis=1, keepdims=True)
    model.scale = 3.0 / np.maximum(np.abs(m).mean(axis=0) if len(m) else np.ones(code.shape[1]), 1e-6)
    return model


def with_prediction(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct ``into`` of lang_pred, score and ambiguous."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous"])

    return docs.withColumn(into, predict(F.col(text).cast("string")))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous for each row of ``docs``."""
    out = with_prediction(text_rows(docs), fit(docs))
    return out.select("doc_id", (F.coalesce(fold("doc_id", 4), F.lit(0)) == 2).alias("held_out"), "language.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose language is known and not ambiguous, with their own columns."""
    own, into = docs.columns, "_language"
    while into in own:
        into += "_"
    out = with_prediction(docs, fit(docs), into=into)
    return out.filter((F.col(f"{into}.lang_pred") != "und") & ~F.col(f"{into}.ambiguous")).select(*own)
