"""Substring deduplication with repeated-phrase automata.

Words are runs of code points other than ASCII white space, windows WINDOW consecutive words. Each window names one
phrase, the PHRASE-word sequence of least hash in it (leftmost on ties), so equal windows name equal phrases.

1. Phrases that windows name are counted by hash over all documents; those that occur more than once are confirmed.
2. Each document with a confirmed phrase is streamed through Aho-Corasick automata (pyahocorasick), compiled for
   shards of documents from the confirmed phrases' words, at most SHARD_PHRASES each, which locate every occurrence (hashes already name these places).
3. Windows around located phrases, by 96-bit hash, have a first occurrence: least doc_id, then least start. All
   later ones are removed from their documents.

Exact copies of a text need no phrases: all but the copy of least doc_id lose every word if they have WINDOW words.
Hot phrases and windows are counted with partial aggregation and joined from written tables, where skewed partitions
can be split. Nothing is collected to the driver and no pairs of documents are made.

Defined cases: null text has no words; under WINDOW words nothing is removed; rows that share a doc_id count as one
document, so that only earlier starts are earlier; rows that repeat as a whole are treated alike; a null doc_id comes
before all others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches, text_rows

WINDOW = 20
PHRASE = 8
#: Phrases in an automaton, at most (but for those of a single document).
SHARD_PHRASES = 20_000
#: Stands for a null doc_id.
NO_ID = -(1 << 63)


def words(text: str | None) -> list[bytes]:
    """The text's words in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mix(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * k) + b * np.uint64(0xC2B2AE3D27D4EB4F + 4 * k)
    x ^= x >> np.uint64(32)
    return x * np.uint64(0xD6E8FEB86659FD93)


def _power(h: np.ndarray, n: int, k: int) -> np.ndarray:
    """Hashes of all n-word sequences, by doubling."""
    done, size, have = None, 0, 1
    while True:
        if n & have:
            done = h if done is None else _mix(h[: len(h) - size], done[have:], k) if len(h) > size else h[:0]
            size += have
        if size == n:
            return done
        h, have = _mix(h[:-have], h[have:], k) if len(h) > have else h[:0], 2 * have


def named(w: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, phrase hashes and the position of the phrase that each window names."""
    import xxhash

    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    phrases = _power(h, PHRASE, 0)
    view = np.lib.stride_tricks.sliding_window_view(phrases, WINDOW - PHRASE + 1)
    return h, phrases, view.argmin(axis=1) + np.arange(len(view))


def _keys(ids: list[int], keys: list[int], counts: list[int]) -> dict[str, np.ndarray]:
    return {"doc_id": np.repeat(np.array(ids, dtype=np.int64), counts), "k1": np.repeat(np.array(keys, dtype=np.int64), counts)}


def _joined(arrays: list[np.ndarray], dtype: type) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, dtype=dtype)


def _phrases(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        ids, keys, counts, found = [], [], [], []
        for d, k, text in zip(f["doc_id"], f["k1"], f["text"], strict=True):
            w = words(text)
            if len(w) < WINDOW:
                continue
            _, h, at = named(w)
            # repeats inside a document count, too
            found.append(h[np.unique(at)].view(np.int64))
            ids.append(d), keys.append(k), counts.append(len(found[-1]))
        yield pd.DataFrame({**_keys(ids, keys, counts), "phrase": _joined(found, np.int64)})


def _shards(docs: list[tuple]) -> Iterator[tuple[list[tuple], set[str]]]:
    part, patterns = [], set()
    for d in docs:
        if part and len(patterns) + len(d[-1]) > SHARD_PHRASES:
            yield part, patterns
            part, patterns = [], set()
        part.append(d)
        patterns |= d[-1]
    if part:
        yield part, patterns


def _locate(w: list[bytes], automaton) -> np.ndarray:
    """Positions of the words where a phrase of the automaton starts."""
    text = " " + b" ".join(w).decode("utf-8", "surrogatepass") + " "
    ends = np.fromiter((e for e, _ in automaton.iter(text)), dtype=np.int64)
    gaps = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) == 32)
    return np.searchsorted(gaps, ends) - PHRASE


def _windows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import ahocorasick

    for f in frames:
        docs = []
        for d, k, text, confirmed in zip(f["doc_id"], f["k1"], f["text"], f["phrases"], strict=True):
            w = words(text)
            h, p, at = named(w)
            where = np.unique(at)
            where = where[np.isin(p[where].view(np.int64), confirmed)]
            docs.append((d, k, w, h, at, {" " + b" ".join(w[i : i + PHRASE]).decode("utf-8", "surrogatepass") + " " for i in where}))
        ids, keys, counts, starts, a, b = [], [], [], [], [], []
        for part, patterns in _shards(docs):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for s in patterns:
                automaton.add_word(s)
            automaton.make_automaton()
            for d, k, w, h, at, _ in part:
                located = np.zeros(len(w), dtype=bool)
                located[_locate(w, automaton) if patterns else []] = True
                start = np.flatnonzero(located[at])
                starts.append(start.astype(np.int32))
                a.append(_power(h, WINDOW, 1)[start].view(np.int64))
                b.append((_power(h, WINDOW, 2)[start] >> np.uint64(33)).astype(np.int32))
                ids.append(d), keys.append(k), counts.append(len(start))
        yield pd.DataFrame({**_keys(ids, keys, counts), "start": _joined(starts, np.int32), "a": _joined(a, np.int64), "b": _joined(b, np.int32)})


def covered(n: int, starts: np.ndarray) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``starts``."""
    steps = np.bincount(starts, minlength=n + 1)[: n + 1] - np.concatenate((np.zeros(WINDOW, dtype=np.int64), np.bincount(starts, minlength=n + 1)))[: n + 1]
    return np.cumsum(steps)[:n] > 0


def repeats(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keyed rows of ``docs`` (doc_id, k1, text) and a row (doc_id, k1, copy, starts) for each that has a repeat.

    ``copy`` marks rows whose whole text belongs to a smaller doc_id, else ``starts`` has the later windows.
    """
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "substring-dedup")
    keyed = text_rows(docs).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("k1"), "text")
    ids = scratch.cut(keyed.select("doc_id", "k1", F.xxhash64("text", F.lit(17)).alias("k2")))
    first = scratch.cut(ids.groupBy("k1", "k2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").drop("last"))
    copies = scratch.cut(ids.join(first, ["k1", "k2"]).filter("doc_id > first").select("doc_id", "k1").distinct())
    names = scratch.cut(keyed.mapInPandas(_phrases, "doc_id long, k1 long, phrase long").join(copies, ["doc_id", "k1"], "left_anti"))
    confirmed = scratch.cut(names.groupBy("phrase").agg(F.count("*").alias("n")).filter("n > 1").select("phrase"))
    lists = names.join(confirmed, "phrase").groupBy("doc_id", "k1").agg(F.collect_set("phrase").alias("phrases"))
    streamed = keyed.join(lists, ["doc_id", "k1"]).select("doc_id", "k1", "text", "phrases")
    windows = scratch.cut(streamed.mapInPandas(_windows, "doc_id long, k1 long, start int, a long, b int"))
    scratch.drop(names, confirmed)
    # the window's first place, and whether there is another
    place = F.struct("doc_id", "start")
    firsts = windows.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = scratch.cut(firsts.select("a", "b", F.col("first.doc_id").alias("first_id"), F.col("first.start").alias("first_start")))
    later = windows.join(firsts, ["a", "b"]).filter("doc_id > first_id or (doc_id = first_id and start > first_start)")
    found = later.groupBy("doc_id", "k1").agg(F.collect_set("start").alias("starts")).select("doc_id", "k1", F.lit(False).alias("copy"), "starts")
    every = scratch.cut(found.unionByName(copies.select("doc_id", "k1", F.lit(True).alias("copy"), F.array().cast("array<int>").alias("starts"))))
    scratch.drop(windows, firsts)
    return keyed, every


def kept_words(text: str | None, copy: bool | None, starts: np.ndarray | None) -> tuple[list[bytes], int]:
    """Words that stay, and the number of all."""
    w = words(text)
    if copy is True or copy is np.True_:
        return ([] if len(w) >= WINDOW else w), len(w)
    if starts is None or not len(starts):
        return w, len(w)
    gone = covered(len(w), np.asarray(starts, dtype=np.int64))
    return [x for x, g in zip(w, gone.tolist(), strict=True) if not g], len(w)


def dedup(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept words as ``text``) of each row."""
    keyed, every = repeats(docs)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for d, text, copy, starts in zip(f["doc_id"], f["text"], f["copy"], f["starts"], strict=True):
                kept, n = kept_words(text, copy, starts)
                joined = b" ".join(kept)
                out.append((n, n - len(kept), hashlib.sha256(joined).hexdigest(), *([joined.decode("utf-8", "surrogatepass")] if keep_text else [])))
            got = pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", *(["text"] if keep_text else [])])
            got.insert(0, "doc_id", pd.array([None if d == NO_ID else d for d in f["doc_id"]], dtype="Int64"))
            yield got

    rows = keyed.join(every, ["doc_id", "k1"], "left").select("doc_id", "text", "copy", "starts")
    return rows.mapInPandas(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", text string" if keep_text else ""))
