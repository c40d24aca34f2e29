"""Best-fit packing of tokenised documents into sequences of a fixed capacity, planned on the driver.

A document's ids end with id 0; only documents longer than the capacity are cut, into full pieces and a rest. Pieces
are range-sorted by length, so that each has a rank among the pieces of its length. Lengths and gaps take at most
``capacity`` values, so the state of a round is the number of waiting pieces of each length and the runs of open
sequences of each gap: a bounded table, whatever the input. A round takes the longest waiting length, sweeps to its
successor among the gaps (the least gap that fits), matches pieces and sequences rank by rank (a sequence gets one
piece a round, which resolves conflicts), moves the sequences to their new gap, and repeats; where no gap fits, new
sequences open. The rounds run one after another on the driver, over this table (``plan``). Each step gives a run: ranks lo.. of a length go to sequences base.. at one offset. The pieces look up
their runs in parallel, in their range-sorted partitions.

The sorted pieces are a written table, so ranks (file and row number) stay the same if an executor is lost.

Defined cases: a null text is an empty one and gives the piece [0]; repeated rows are packed each; equal lengths are
ranked by doc_id and piece; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches, text_rows

CAPACITY = 2048
#: Distinct words whose ids a worker keeps, at most (between texts).
CACHE_WORDS = 1_000_000
#: Pieces in a range partition, about.
PARTITION_ROWS = 500_000
_BREAK = "\x00"


#: Words of printable ASCII and of the letters U+00C0 to U+00FF, which lower-case and compose one by one.
_PLAIN = re.compile(rb"(?:[!-~]|\xc3[\x80-\xbf])+")
_END = "\x01"


class WordBpe:
    """Ids of many plain words in a call, by the merges of a word-level BPE file with word ends.

    A piece's end becomes one more byte, which merges with the piece's last byte before all else, so that the file's
    order of merges is a table of ranks.
    """

    #: What the file must say of how text becomes pieces; with anything else the library does all the work.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, spec: dict):
        import regex
        import tiktoken

        suffix = spec["model"]["end_of_word_suffix"]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        end = _END.encode()

        def raw(token: str) -> bytes:
            stem = token.removesuffix(suffix)
            return bytes(letters[c] for c in stem) + (end if len(stem) < len(token) else b"")

        units = [bytes([b]) for b in range(256)]
        merged = [raw("".join(m.split(" ") if isinstance(m, str) else m)) for m in spec["model"]["merges"]]
        order = list(dict.fromkeys([*units, *(u + end for u in units if u != end), *merged]))
        special = {t["content"] for t in spec["added_tokens"]}
        self._special = re.compile(b"|".join(re.escape(t.encode()) for t in sorted(special)) or b"(?!)")
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self._ids = np.array([ids.get(t, 0) for t in order], dtype=np.uint32)
        self._last = np.array([t.endswith(end) for t in order])
        self._encode = tiktoken.Encoding("word-bpe", pat_str=f"[^{_END}]*{_END}", mergeable_ranks={t: r for r, t in enumerate(order)}, special_tokens={}).encode_ordinary
        self._pieces = regex.compile(self.PIECES).findall

    @classmethod
    def of(cls, path: str) -> WordBpe | None:
        """The encoder of a file, None if the file is of another kind."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, says = spec["model"], json.dumps([spec["normalizer"], spec["pre_tokenizer"]])
        kinds = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        same = model.get("type") == "BPE" and model.get("end_of_word_suffix") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix")
        return cls(spec) if same and kinds == ["NFC", "Replace", "Lowercase"] and json.dumps(cls.PIECES) in says else None

    def takes(self, word: bytes) -> bool:
        """Whether a word is plain and holds no special token's name."""
        return _PLAIN.fullmatch(word) is not None and self._special.search(word) is None

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and where each word's end."""
        pieces = [self._pieces(w.decode().lower()) for w in words]
        text = _END.join([_END.join(p) for p in pieces]) + _END
        ranks = np.array(self._encode(text), dtype=np.int64)
        ends = np.flatnonzero(self._last[ranks]) + 1
        return self._ids[ranks], ends[np.cumsum([len(p) for p in pieces]) - 1]


class Encoder:
    """Ids of whole texts. White space only separates words for this tokenizer, so ids are kept by word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordBpe.of(path)
        got = self.tokenizer.encode(_BREAK, add_special_tokens=False).ids
        self.mark = got[0] if len(got) == 1 else None
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.n_ids = np.empty(1 << 16, dtype=np.uint32), 0
        self.starts, self.lens, self.n = np.empty(1 << 15, dtype=np.int64), np.empty(1 << 15, dtype=np.int64), 0

    def _add(self, words: list[bytes], ids: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> None:
        """Keep words whose ids are the slices of ``ids`` from ``starts``."""
        k = self.n + len(words)
        while k > len(self.starts):
            self.starts, self.lens = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lens, 2 * len(self.lens))
        while self.n_ids + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.n_ids : self.n_ids + len(ids)] = ids
        self.starts[self.n : k], self.lens[self.n : k] = self.n_ids + starts, lens
        self.index.update(zip(words, range(self.n, k), strict=True))
        self.n, self.n_ids = k, self.n_ids + len(ids)

    def _learn(self, words: list[bytes]) -> None:
        """Encode new words, many in a call."""
        plain = [w for w in words if self.words.takes(w)] if self.words else []
        for i in range(0, len(plain), 4096):
            part = plain[i : i + 4096]
            ids, ends = self.words.encode(part)
            starts = np.concatenate(([0], ends[:-1]))
            self._add(part, ids, starts, ends - starts)
        if len(plain) < len(words):
            self._ask(list(set(words) - set(plain)))

    def _ask(self, words: list[bytes]) -> None:
        """Words that the library encodes: with a mark between them where they hold none."""
        plain = [w for w in words if b"\x00" not in w] if self.mark is not None else []
        for i in range(0, len(plain), 1024):
            part = plain[i : i + 1024]
            text = f" {_BREAK} ".encode().join(part).decode()
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            starts = np.concatenate(([0], cuts + 1))
            self._add(part, ids, starts, np.append(cuts, len(ids)) - starts)
        for w in set(words) - set(plain) if len(plain) < len(words) else ():
            ids = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, dtype=np.uint32)
            self._add([w], ids, np.zeros(1, np.int64), np.array([len(ids)]))

    def encode_all(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, without a final 0; words that are new in these texts are encoded together."""
        if len(self.index) > CACHE_WORDS:
            self._clear()
        split = [(t or "").encode("utf-8", "replace").split() for t in texts]
        new = set().union(*split).difference(self.index) if split else ()
        if new:
            self._learn(list(new))
        for words in split:
            k = np.fromiter(map(self.index.__getitem__, words), dtype=np.int64, count=len(words))
            lens = self.lens[k]
            first = np.cumsum(lens) - lens
            yield self.ids[np.repeat(self.starts[k] - first, lens) + np.arange(int(lens.sum()))]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one text."""
        return next(self.encode_all([text]))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_vocabulary() -> str:
    """Path of the packing vocabulary on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of each piece of each document.

    ``vocabulary`` is a path that executors can read; by default each finds the installed file.
    """
    small_batches(docs.sparkSession)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(vocabulary or default_vocabulary())
        for f in frames:
            out = []
            for doc_id, ids in zip(f["doc_id"], e.encode_all(f["text"].tolist()), strict=True):
                ids = np.append(ids, np.uint32(0)).astype("<u4")
                for k, a in enumerate(range(0, len(ids), capacity)):
                    p = ids[a : a + capacity]
                    out.append((None if doc_id is None or doc_id != doc_id else int(doc_id), k, a, len(p), zlib.crc32(p.tobytes()), *([p.astype(np.int32)] if keep_ids else [])))
            names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
            got = pd.DataFrame(out, columns=names)
            got["doc_id"] = got["doc_id"].astype("Int64")
            yield got

    return text_rows(docs).mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else ""))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the runs of its ranks: first rank, first sequence, offset in the sequence."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    runs: dict[int, list[tuple[int, int, int]]] = {}
    opened = 0

    def put(gap: int, base: int, n: int) -> None:
        if gap == 0:
            return
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append((base, n))

    for length in sorted(counts, reverse=True):
        left, rank, own = counts[length], 0, []
        while left:
            k = bisect_left(order, length)
            if k == len(order):
                n = -(-left // (capacity // length))
                put(capacity, opened, n)
                opened += n
                continue
            gap = order[k]
            base, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(k)
            take = min(n, left)
            if take < n:
                put(gap, base + take, n - take)
            own.append((rank, base, capacity - gap))
            put(gap - length, base, take)
            rank, left = rank + take, left - take
        runs[length] = own
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in runs.items() if v}


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with doc_id, piece, length) and the sequence_id and offset of each."""
    spark = parts.sparkSession
    scratch = Scratch(spark, "packing")
    parts = scratch.cut(parts)
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-parts.count() // PARTITION_ROWS))
    by = [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("start"), F.col("ids_crc32")]
    ordered = scratch.cut(parts.repartitionByRange(n_parts, *by).sortWithinPartitions(*by))
    placed = spark.read.schema(parts.schema).parquet(ordered._scratch_path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    scratch.drop(parts)
    # one row for each length in each range partition: lengths are sorted, so about partitions + capacity rows
    stretches = placed.groupBy("_file", "length").agg(F.min("_row").alias("first"), F.count("*").alias("n")).collect()
    ranks: dict[tuple[str, int], int] = {}
    counts: dict[int, int] = {}
    for r in sorted(stretches, key=lambda r: (r["length"], r["_file"])):
        ranks[r["_file"], r["length"]] = counts.get(r["length"], 0) - r["first"]
        counts[r["length"]] = counts.get(r["length"], 0) + r["n"]
    shared = spark.sparkContext.broadcast((ranks, plan(counts, capacity)))

    @F.pandas_udf("sequence_id long, offset long")
    def place(files: pd.Series, rows: pd.Series, lengths: pd.Series) -> pd.DataFrame:
        ranks, runs = shared.value
        seq, off = np.empty(len(rows), dtype=np.int64), np.empty(len(rows), dtype=np.int64)
        for (file, length), at in pd.DataFrame({"f": files, "l": lengths}).groupby(["f", "l"], sort=False).indices.items():
            lo, base, offset = runs[length]
            rank = rows.to_numpy()[at] + ranks[file, length]
            k = np.searchsorted(lo, rank, side="right") - 1
            seq[at], off[at] = base[k] + rank - lo[k], offset[k]
        return pd.DataFrame({"sequence_id": seq, "offset": off})

    out = placed.withColumn("_at", place("_file", "_row", "length"))
    return out.select(*parts.columns, "_at.sequence_id", "_at.offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents and their places."""
    return pack(pieces(docs, capacity=capacity), capacity)
