"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its distinct words (hashed, each weighing 1/sqrt of their number), binned statistics of its
structure (case, symbols, repetition, lengths of words and lines) and its length as metadata. The machine adds linear
weights and low-rank pairwise interactions, which the sum-of-squares identity scores in time linear in the features:
sum over factors of ((sum of v x)^2 - sum of (v x)^2) / 2.

It is fitted with AdaGrad on at most FIT_ROWS labelled rows, drawn by id hash; labels, lang, source and doc_id are
never features. Defined cases: null and empty texts score as a text without words; without labels, or with one
class only, every score is the share of label 1 (0.5 without any); repeated rows get equal scores; documents labelled
twice count twice in the sample; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, rank_in_sample, small_batches, text_rows

#: Upper bound of labelled rows (in expectation, by id hash) that the machine is fitted on.
FIT_ROWS = 8000
WORDS = 1 << 16
BINS = 16
N_STATS = 15
SIZE = WORDS + BINS * N_STATS
FACTORS = 8
#: Steps of the fit, at least: few labelled rows are gone through more often.
STEPS = 300
_CACHE_MOST = 200_000
_cache: dict[bytes, int] = {}


def word_ids(words: list[bytes]) -> np.ndarray:
    """Hash bucket of each word; a bounded cache spares hashing frequent words again."""
    if len(_cache) > _CACHE_MOST:
        _cache.clear()
    got = list(map(_cache.get, words))
    if None in got:
        for i, w in enumerate(words):
            if got[i] is None:
                got[i] = _cache[w] = zlib.crc32(w) & (WORDS - 1)
    return np.array(got, dtype=np.int64)


def _bin(x: float) -> int:
    """Bin of a share in [0, 1], finer towards 0."""
    return min(BINS - 1, int(BINS * np.sqrt(min(max(x, 0.0), 1.0))))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values of a whole text."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.lower().split()
    n, size = len(words), max(1, len(raw))
    h = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    upper, lower, digit = h[65:91].sum(), h[97:123].sum(), h[48:58].sum()
    marks = h[33:48].sum() + h[58:65].sum() + h[91:97].sum() + h[123:127].sum()
    odd = h[[35, 36, 37, 38, 42, 64, 94, 126]].sum()
    ids = word_ids(words) if n else np.zeros(0, dtype=np.int64)
    distinct = np.unique(ids)
    lines = raw.split(b"\n")
    beside = float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0
    top = np.bincount(np.searchsorted(distinct, ids)).max() / n if n else 0.0
    stats = (
        upper / max(1, upper + lower), digit / size, marks / size, odd / max(1, n), h[33] / max(1, n), h[124] / max(1, n),
        len(distinct) / max(1, n), beside, top, len(set(lines)) / len(lines), min(1.0, size / max(1, n) / 32),
        min(1.0, n / len(lines) / 64), h[46] / max(1, n), h[128:].sum() / size, min(1.0, np.log1p(n) / 12),
    )
    bins = np.array([WORDS + BINS * k + _bin(float(s)) for k, s in enumerate(stats)], dtype=np.int64)
    values = np.concatenate((np.full(len(distinct), 1 / np.sqrt(max(1, len(distinct)))), np.ones(len(bins))))
    return np.concatenate((distinct, bins)), values.astype(np.float32)


class Machine:
    """Bias, linear weights and factors."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def logit(self, at: np.ndarray, x: np.ndarray) -> float:
        """The machine's output, linear in the number of features."""
        v = self.factors[at] * x[:, None]
        total = v.sum(axis=0)
        return float(self.bias + self.linear[at] @ x + 0.5 * (total @ total - (v * v).sum()))

    def score(self, text: str | None) -> float:
        """Probability of label 1."""
        return float(1 / (1 + np.exp(-np.clip(self.logit(*features(text)), -30, 30))))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 6, batch: int = 128, seed: int = 1) -> Machine:
    """Fit by AdaGrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    m = Machine(float(np.log((share * len(labels) + 1) / ((1 - share) * len(labels) + 1))), np.zeros(SIZE, np.float32), np.zeros((SIZE, FACTORS), np.float32))
    if len(labels) == 0 or share in (0.0, 1.0):
        return m
    seen = np.unique(np.concatenate([a for a, _ in rows]))
    m.factors[seen] = rng.normal(0, 0.05, (len(seen), FACTORS)).astype(np.float32)
    g_bias, g_lin, g_fac = 1.0, np.full(SIZE, 1e-2, np.float32), np.full((SIZE, FACTORS), 1e-2, np.float32)
    for _ in range(max(epochs, -(-STEPS // -(-len(rows) // batch)))):
        order = rng.permutation(len(rows))
        for i in range(0, len(order), batch):
            take = order[i : i + batch]
            lens = np.array([len(rows[k][0]) for k in take])
            at, x = np.concatenate([rows[k][0] for k in take]), np.concatenate([rows[k][1] for k in take])
            starts, doc = np.concatenate(([0], np.cumsum(lens)[:-1])), np.repeat(np.arange(len(take)), lens)
            v = m.factors[at] * x[:, None]
            total = np.add.reduceat(v, starts, axis=0)
            out = m.bias + np.add.reduceat(m.linear[at] * x, starts) + 0.5 * ((total**2).sum(axis=1) - np.add.reduceat((v * v).sum(axis=1), starts))
            err = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - labels[take]).astype(np.float32) / len(take)
            e = err[doc] * x
            ids, back = np.unique(at, return_inverse=True)
            d_lin = np.bincount(back, weights=e, minlength=len(ids)) + 1e-5 * m.linear[ids]
            d_all = e[:, None] * (total[doc] - v)
            d_fac = np.stack([np.bincount(back, weights=d_all[:, f], minlength=len(ids)) for f in range(FACTORS)], axis=1) + 1e-4 * m.factors[ids]
            g_lin[ids] += d_lin**2
            g_fac[ids] += d_fac**2
            m.linear[ids] -= (0.1 * d_lin / np.sqrt(g_lin[ids])).astype(np.float32)
            m.factors[ids] -= (0.05 * d_fac / np.sqrt(g_fac[ids])).astype(np.float32)
            g_bias += float(err.sum()) ** 2
            m.bias -= 0.1 * float(err.sum()) / np.sqrt(g_bias)
    return m


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, left_out: int, most: int, seed: int) -> DataFrame:
    """At most about ``most`` labelled documents (text, y) outside the held-out fold, drawn by id hash.

    The labels drawn are bounded, so that they can be broadcast against the documents.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter("doc_id is not null and y is not null")
    known = known.filter(fold("doc_id", folds) != left_out)
    n = known.count()
    drawn = known.filter(rank_in_sample("doc_id", seed) < most / max(1, n)).limit(2 * most)
    return text_rows(docs).join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "y")


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    """Fit on labelled documents whose fold (crc32 of the id, mod 3) is not 1."""
    small_batches(docs.sparkSession)

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            got = [features(t) for t in f["text"]]
            yield pd.DataFrame({"doc_id": f["doc_id"], "at": [a.astype(np.int32).tobytes() for a, _ in got], "x": [x.tobytes() for _, x in got], "y": f["y"]})

    sample = labelled_sample(docs, labels, "quality", 3, 1, fit_rows, 11)
    got = sample.mapInPandas(extract, "doc_id long, at binary, x binary, y int").limit(4 * fit_rows).toPandas()
    got = got.assign(h=[zlib.crc32(a) for a in got["at"]]).sort_values(["doc_id", "h"])
    rows = [(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(x, np.float32)) for a, x in zip(got["at"], got["x"], strict=True)]
    return train(rows, (got["y"].to_numpy(dtype=float) == 1).astype(np.float32))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(fit(docs, labels))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(t) for t in texts], dtype="float64")

    out = text_rows(docs).withColumn("score", scored("text"))
    return out.select("doc_id", (F.coalesce(fold("doc_id", 3), F.lit(0)) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
