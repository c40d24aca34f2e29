"""Language-model scoring: marginal likelihood over the lattice of all subword segmentations.

The pieces are those of an existing public vocabulary; it is never trained. No file of unigram probabilities is
installed, so the vocabulary's scores, which rank its pieces, make a Zipf prior. From it, ROUNDS forward-backward passes
over all segmentations of the distinct training words give each piece's expected count (each distinct word counts once, as
the lattice speaks for words not seen yet), and prior and counts give unigram probabilities. A word's probability is
the sum over all its segmentations, by a forward recursion in log space over many words at a time; characters without
a piece go by their bytes. The lattice of a word seen in training has one more arc, the whole word, with its count less
a discount D = n1 / (n1 + 2 n2); the piece arcs carry what the discounts set free, so that probabilities of tokens sum
to one. With many training documents word arcs give most of the score. A text's score adds its words and one end;
``lattice_score`` is the part of the piece arcs alone.

Each distinct word's lattice is summed once. Words are counted with partial aggregation; the words of most
occurrences, HOT_WORDS at most, go to all workers as a table of checked size, which add them up where the text is; all
others (none of which can be more than one in HOT_WORDS of the tokens) are joined by word, and their values go back to
their rows. Only that table and the vocabulary's piece counts, bounded both, come to the driver.

Defined cases: null texts are empty; an empty text has one token, the end; a null doc_id counts as training; without
training documents N = V = 0, each token's base probability is 1 and pieces have their prior; repeated rows count and
score each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, fold, small_batches, text_rows

#: Weight of the prior, in pieces.
PRIOR = 2000.0
#: Forward-backward passes over the distinct training words.
ROUNDS = 2
#: Words that all workers know, at most, and bytes of such a word, at most.
HOT_WORDS, HOT_BYTES = 150_000, 64
#: Distinct words that a worker counts before it hands them on.
FLUSH_WORDS = 500_000
#: Cells of a block of words in the recursion.
CELLS = 1 << 16
#: Words that go through the recursion together, and bytes of them, at most (but for a single batch).
BLOCK_ROWS, BLOCK_BYTES = 1 << 15, 16 << 20
_EMPTY, _FACTOR = np.uint64(0x243F6A8885A308D3), np.uint64(0x9E3779B97F4A7C15)
_LN10 = math.log(10)


def default_vocabulary() -> str:
    """Path of the scoring vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


_pieces: dict[str, tuple[list[str], np.ndarray]] = {}


def pieces(path: str) -> tuple[list[str], np.ndarray]:
    """Names of a vocabulary file's usable pieces and their ranks by score; bytes come last."""
    if path not in _pieces:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ranks = np.array([max(0.0, min(1e5, -sp.get_score(i))) if not sp.is_byte(i) else 1e5 for i in usable])
        _pieces[path] = [sp.id_to_piece(i) for i in usable], ranks
    return _pieces[path]


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


class Lattice:
    """Unigram log probabilities of pieces, and recursions over all segmentations of many words at a time."""

    def __init__(self, names: list[str], ranks: np.ndarray, counts: np.ndarray, ends: float):
        prior = 1.0 / (2.0 + ranks)
        p = counts + PRIOR * prior / prior.sum()
        total = p.sum() + ends + 1.0
        self.logs = np.log(p / total)
        is_byte = [len(n) == 6 and n.startswith("<0x") for n in names]
        starts = sum(math.exp(lp) for n, lp in zip(names, self.logs.tolist(), strict=True) if n[0] == "▁")
        self.end = math.log((ends + 1.0) / total)
        self.end -= math.log(starts + math.exp(self.end))  # given that no word goes on
        self.byte = np.full(256, -np.inf)
        self.byte_id = np.full(256, -1, dtype=np.int64)
        table: dict[str, int] = {}
        for k, (name, b) in enumerate(zip(names, is_byte, strict=True)):
            if b:
                self.byte[int(name[3:5], 16)], self.byte_id[int(name[3:5], 16)] = self.logs[k], k
            else:
                table[name] = k
                for n in range(1, len(name)):
                    table.setdefault(name[:n], -1)
        self.longest = max(map(len, table))
        found = sorted((self._hash(s), k) for s, k in table.items())
        self.keys, self.ids = np.array([h for h, _ in found], dtype=np.uint64), np.array([k for _, k in found], dtype=np.int64)

    @staticmethod
    def _hash(s: str) -> int:
        h = int(_EMPTY)
        for c in s:
            h = (h + ord(c)) * int(_FACTOR) % (1 << 64)
        return h

    def _arcs(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Arcs of ``codes`` (position x word): length, places (position * words + word), pieces and log probabilities; piece -1 stands for bytes."""
        n, m = codes.shape
        flat = codes.ravel()
        at, h = np.arange(n * m), np.full(n * m, _EMPTY)
        for k in range(1, min(self.longest, n) + 1):
            fit = np.searchsorted(at, (n - k + 1) * m)
            at = at[:fit]
            h = (h[:fit] + flat[at + (k - 1) * m]) * _FACTOR
            f = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            ok = self.keys[f] == h
            piece = np.where(ok, self.ids[f], -1)
            if k == 1 and (piece < 0).any():
                odd = at[piece < 0]
                chars, where = np.unique(flat[odd], return_inverse=True)
                logs = np.array([sum(self.byte[b] for b in chr(c).encode("utf-8", "replace")) for c in chars.tolist()])
                yield 1, odd, np.full(len(odd), -1), logs[where]
            hit = piece >= 0
            yield k, at[hit], piece[hit], self.logs[piece[hit]]
            at, h = at[ok], h[ok]

    def _blocks(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length at a time: their numbers and code points (position x word)."""
        texts = ["▁" + w.decode("utf-8", "replace") for w in words]
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        order = np.argsort(lens, kind="stable")
        edges = np.flatnonzero(np.diff(lens[order], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            n = int(lens[order[a]])
            for i in range(a, b, max(1, CELLS // n)):
                who = order[i : min(b, i + max(1, CELLS // n))]
                raw = "".join([texts[k] for k in who.tolist()]).encode("utf-32-le", "surrogatepass")
                yield who, np.frombuffer(raw, dtype=np.uint32).reshape(len(who), n).T.astype(np.uint64, order="C")

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, list]:
        """Log sums of all ways to each position, flat as position * words + word, and the arcs by length."""
        n, m = codes.shape
        alpha = np.full((n + 1) * m, -np.inf)
        alpha[:m] = 0.0
        arcs = [(k, at, piece, lp, np.searchsorted(at, np.arange(n + 1) * m)) for k, at, piece, lp in self._arcs(codes)]
        for i in range(n):
            for k, at, _, lp, cut in arcs:
                a, b = cut[i], cut[i + 1]
                if a < b:
                    to = at[a:b] + k * m
                    alpha[to] = np.logaddexp(alpha[to], alpha[at[a:b]] + lp[a:b])
        return alpha, arcs

    def words(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, summed over all its segmentations."""
        out = np.empty(len(words))
        for who, codes in self._blocks(words):
            out[who] = self._forward(codes)[0][-len(who) :]
        return out

    def expected(self, words: list[bytes]) -> np.ndarray:
        """Expected counts of the pieces over all segmentations of the words, each word once, by forward-backward."""
        sums = np.zeros(len(self.logs))
        for who, codes in self._blocks(words):
            n, m = codes.shape
            alpha, arcs = self._forward(codes)
            beta = np.full((n + 1) * m, -np.inf)
            beta[-m:] = 0.0
            for i in range(n - 1, -1, -1):
                for k, at, _, lp, cut in arcs:
                    a, b = cut[i], cut[i + 1]
                    if a < b:
                        own = at[a:b]
                        beta[own] = np.logaddexp(beta[own], lp[a:b] + beta[own + k * m])
            z = alpha[-m:]
            for k, at, piece, lp, _ in arcs:
                share = np.exp(alpha[at] + lp + beta[at + k * m] - z[at % m])
                whole = piece >= 0
                sums += np.bincount(piece[whole], weights=share[whole], minlength=len(sums))
                if not whole.all():
                    for place, x in zip(at[~whole].tolist(), share[~whole].tolist(), strict=True):
                        for b in chr(int(codes.flat[place])).encode("utf-8", "replace"):
                            sums[self.byte_id[b]] += x
        return sums


def _tables(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of words put together to BLOCK_ROWS rows or BLOCK_BYTES bytes, as recursions pay by the block."""
    kept: list[pa.RecordBatch] = []
    rows = size = 0
    for b in batches:
        kept.append(b)
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows >= BLOCK_ROWS or size >= BLOCK_BYTES:
            yield pa.concat_batches(kept)
            kept, rows, size = [], 0, 0
    if rows:
        yield pa.concat_batches(kept)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and their counts in training rows (c) and in all (t)."""
    train, held = Counter(), Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        every = [*train, *(w for w in held if w not in train)]
        for i in range(0, len(every), 1 << 16):
            part = every[i : i + (1 << 16)]
            c = list(map(train.__getitem__, part))
            t = [x + held[w] if w in held else x for w, x in zip(part, c, strict=True)]
            yield _tables(word=pa.array(part, pa.binary()), c=pa.array(c, pa.int64()), t=pa.array(t, pa.int64()))
        train.clear()
        held.clear()

    for batch in batches:
        for text, own in zip(batch.column("text").to_pylist(), batch.column("train").to_pylist(), strict=True):
            (train if own else held).update(words_of(text))
            if len(train) + len(held) > FLUSH_WORDS:
                yield from flush()
    yield from flush()


def _hot_level(counts: DataFrame) -> float:
    """The least level (in eighths of an octave) of occurrences that HOT_WORDS words at most reach."""
    levels = counts.filter(F.octet_length("word") <= HOT_BYTES).groupBy(F.floor(F.log2("t") * 8).alias("level")).count().collect()
    n, least = 0, math.inf
    for level, k in sorted(((r["level"], r["count"]) for r in levels), reverse=True):
        n += k
        if n > HOT_WORDS:
            break
        least = level
    return least


def _expected(words: DataFrame, model: Lattice) -> np.ndarray:
    """Expected counts of the model's pieces in distinct words."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(shared.value.logs))
        for b in _gathered(batches):
            sums += shared.value.expected(b.column("word").to_pylist())
        at = np.flatnonzero(sums)
        yield _tables(piece=pa.array(at, pa.int32()), n=pa.array(sums[at]))

    out = np.zeros(len(model.logs))
    for r in words.mapInArrow(tally, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r["piece"]] = r["n"]
    shared.destroy()
    return out


def score(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score and lattice_score of each document."""
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "lattice")
    rows = text_rows(docs).withColumn("train", F.coalesce(fold("doc_id", 7), F.lit(0)) != 2)
    ends = rows.filter("train").count()
    counts = scratch.cut(rows.mapInArrow(_counted, "word binary, c long, t long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t")))
    times = lambda k: F.count(F.when(F.col("c") == k, 1))
    n_words, distinct, ones, twos = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), times(1), times(2)).first()
    total, kinds = n_words + ends, distinct + (1 if ends else 0)
    names, ranks = pieces(vocabulary or default_vocabulary())
    model = Lattice(names, ranks, np.zeros(len(names)), 0.0)
    learned = counts.filter("c > 0").select("word")
    for _ in range(ROUNDS):
        model = Lattice(names, ranks, _expected(learned, model), 1.0 if ends else 0.0)
    shared = spark.sparkContext.broadcast(model)
    floor = math.log10(total + kinds + 1)
    discount = min(0.95, max(0.05, ones / max(1, ones + 2 * twos)))
    rest = discount * kinds / total if total else 1.0

    def mixed(c: np.ndarray, lattice: np.ndarray) -> np.ndarray:
        """log10 of a word's arc and its pieces' arcs together."""
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(np.maximum(c - discount, 0.0) / max(1, total)), lattice + math.log(rest)) / _LN10

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _gathered(batches):
            c, lattice = b.column("c").to_numpy(), shared.value.words(b.column("word").to_pylist())
            yield _tables(word=b.column("word"), t=b.column("t"), known=pa.array((c > 0).astype(np.int64)), base=pa.array(np.log10(c + 1.0) - floor), score=pa.array(mixed(c, lattice)), lattice=pa.array(lattice / _LN10))

    values = scratch.cut(counts.mapInArrow(valued, "word binary, t long, known long, base double, score double, lattice double"))
    level = _hot_level(counts)
    is_hot = (F.octet_length("word") <= HOT_BYTES) & (F.floor(F.log2("t") * 8) >= F.lit(level))
    table = values.filter(is_hot).drop("t").toArrow()
    hot = spark.sparkContext.broadcast((table.column("word").to_pylist(), np.stack([table.column(k).to_numpy().astype(np.float64) for k in ("known", "base", "score", "lattice")], axis=1) if len(table) else np.zeros((0, 4))))
    end = np.array([float(ends > 0), math.log10((ends + 1) / (total + kinds + 1)), float(mixed(np.array([float(ends)]), np.array([model.end]))[0]), model.end / _LN10])
    index: dict[bytes, int] = {}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text with the sums over its hot words and its end, and one for each of its other words."""
        names, known = hot.value
        if not index:
            index.update(zip(names, range(len(names)), strict=True))
        for b in batches:
            sums, sizes, who, rest, n = [], [], [], [], []
            keys = b.column("key").to_pylist()
            for key, text in zip(keys, b.column("text").to_pylist(), strict=True):
                w = words_of(text)
                at = list(map(index.get, w))
                own = np.array([k for k in at if k is not None], dtype=np.int64)
                sums.append(known[own].sum(axis=0) + end)
                sizes.append(len(w) + 1)
                if len(own) < len(w):
                    c = Counter([x for x, k in zip(w, at, strict=True) if k is None])
                    who += [key] * len(c)
                    rest += c.keys()
                    n += c.values()
            sums = np.array(sums).reshape(-1, 4)
            none, k = len(rest), len(keys)
            pad = lambda x, kind: pa.concat_arrays([pa.array(x, kind), pa.nulls(none, kind)])
            yield _tables(
                key=pa.array(keys + who, pa.int64()), word=pa.concat_arrays([pa.nulls(k, pa.binary()), pa.array(rest, pa.binary())]), n=pa.concat_arrays([pa.array(sizes, pa.int64()), pa.array(n, pa.int64())]),
                doc_id=pa.concat_arrays([b.column("doc_id"), pa.nulls(none, pa.int64())]), held_out=pad([not t for t in b.column("train").to_pylist()], pa.bool_()),
                known=pad(sums[:, 0].astype(np.int64), pa.int64()), base=pad(sums[:, 1], pa.float64()), score=pad(sums[:, 2], pa.float64()), lattice=pad(sums[:, 3], pa.float64()),
            )

    schema = "key long, word binary, n long, doc_id long, held_out boolean, known long, base double, score double, lattice double"
    parts = scratch.cut(rows.withColumn("key", F.monotonically_increasing_id()).mapInArrow(summed, schema))
    rare = parts.filter("word is not null").select("key", "word", "n").join(values.filter(~is_hot).hint("merge"), "word")
    weighed = lambda c: (F.col("n") * F.col(c)).alias(c)
    rare = rare.select("key", F.lit(None).cast("long").alias("n"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), *map(weighed, ("known", "base", "score", "lattice")))
    whole = parts.filter("word is null").drop("word").unionByName(rare).groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n").alias("n"), *(F.sum(c).alias(c) for c in ("known", "base", "score", "lattice")))
    return whole.select("doc_id", "held_out", F.col("n").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score", F.col("lattice").alias("lattice_score"))
