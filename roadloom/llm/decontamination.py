"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Words are runs of letters and digits of the lower-cased text, shingles five words. Test items are short and documents
long, so that resemblance is no guide; containment is. Items are partitioned by their number of shingles (powers of
two); each keeps the SKETCH smallest shingle hashes (its bottom-k MinHash), and the largest of them is its
partition's bound. A document that contains 0.8 of an item misses all SKETCH of them with probability 0.2 ** SKETCH,
so documents need to show a partition only the shingles whose hash is within its own bound: the longer its items, the
fewer (an item of SKETCH shingles or fewer shows all of its own, so its partition sees nearly all of a document's). One
shared sketch hash in a partition makes a candidate; candidates are verified by exact containment of the shingles' words.

Documents are never joined to documents and a candidate is one row per (document, item) that share a hash. The item
side is broadcast only after its size has been checked; beyond BROADCAST_ROWS the same join shuffles.

Defined cases: null and empty texts, and texts and items under five words, have no shingle and match nothing, as in
the query's SQL (an answer of one word would be found in nearly every document); an
empty benchmark matches nothing; repeated item_ids are separate items if their texts differ; rows that share a doc_id
but not the text are judged apart and give the better of their results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, text_rows

WORDS = 5
SKETCH = 8
THRESHOLD = 0.8
#: Rows and bytes of text up to which a checked side is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 16 << 20
WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Words of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _shingles(w: Column, of) -> Column:
    """Shingles by ``of``; the words are bound once, not looked up anew for each shingle."""

    def bound(w):
        return F.when(F.size(w) >= WORDS, F.transform(F.sequence(F.lit(0), F.size(w) - WORDS), lambda i: of([F.get(w, i + k) for k in range(WORDS)])))

    return F.transform(F.array(w), bound)[0]


def hashes(w: Column) -> Column:
    """64-bit hashes of the shingles, null under five words."""
    return _shingles(w, lambda c: F.xxhash64(*c))


def phrases(w: Column) -> Column:
    """The shingles as text."""
    return _shingles(w, lambda c: F.concat_ws(" ", *c))


def _key(text: Column) -> Column:
    """Two hashes of a text that stand for it."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(17)).alias("b"))


def _sized(df: DataFrame, rows: Column | None = None, text: str | None = None) -> DataFrame:
    """``df``, to be broadcast if the sum of ``rows`` (by default one each) and the bytes of a text column are within the bounds."""
    n, size = df.agg(F.sum(rows if rows is not None else F.lit(1)), F.sum(F.octet_length(text) if text else F.lit(0))).first()
    return F.broadcast(df) if (n or 0) <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def shown(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    """doc_id, k, partition and hash ``h`` of the shingles of ``rows`` that each of the (partition, bound) sees."""
    out = rows.withColumn("h", hashes(words(F.col("text")))).select("doc_id", "k", F.explode("h").alias("h"))
    seen = [F.when(F.col("h") <= F.lit(bound), F.lit(partition).cast("long")) for partition, bound in bounds]
    seen = F.filter(F.array(*seen), lambda p: p.isNotNull()) if seen else F.array().cast("array<bigint>")
    top = max((bound for _, bound in bounds), default=None)
    out = out.filter(F.col("h") <= F.lit(top)) if bounds else out.filter(F.lit(False))
    return out.select("doc_id", "k", "h", F.explode(seen).alias("partition"))


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, k, item_id, n_shingles, n_shared, containment of each contained item; ``k`` has two hashes of the text."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontamination")
    rows = text_rows(docs).withColumn("k", _key(F.col("text")))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).dropDuplicates(["item_id", "text"])
    items = items.withColumn("w", words(F.col("text"))).withColumn("item_k", F.xxhash64("text"))
    items = items.withColumn("phrases", F.array_distinct(phrases(F.col("w")))).filter("phrases is not null")
    items = items.withColumn("n_shingles", F.size("phrases").cast("long")).withColumn("partition", F.floor(F.log2("n_shingles")))
    items = scratch.cut(items.withColumn("sketch", F.slice(F.array_sort(F.array_distinct(hashes(F.col("w")))), 1, SKETCH)).drop("w", "text"))
    bounds = [tuple(r) for r in items.groupBy("partition").agg(F.max(F.array_max("sketch")).alias("bound")).collect()]
    sketches = _sized(items.select("partition", "item_id", "item_k", F.explode("sketch").alias("h")))
    candidates = scratch.cut(shown(rows, bounds).join(sketches, ["partition", "h"]).select("doc_id", "k", "item_id", "item_k").distinct())
    near = _sized(candidates.groupBy("k").agg(F.collect_set(F.struct("item_id", "item_k")).alias("items")), F.size("items"))
    texts = rows.select("k", "text").join(near, "k").dropDuplicates(["k"])
    said = texts.select("k", "items", F.explode(F.array_distinct(phrases(words(F.col("text"))))).alias("phrase"))
    wanted = items.select("item_id", "item_k", "n_shingles", F.explode("phrases").alias("phrase"))
    wanted = _sized(wanted, text="phrase")
    shared = said.join(wanted, "phrase").filter(F.array_contains("items", F.struct("item_id", "item_k")))
    verified = shared.groupBy("k", "item_id", "item_k", "n_shingles").agg(F.count("*").alias("n_shared"))
    verified = verified.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).filter(F.col("containment") >= THRESHOLD)
    return candidates.join(verified, ["k", "item_id", "item_k"]).select("doc_id", "k", "item_id", "n_shingles", "n_shared", "containment")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and the containment of each item that a document contains."""
    best = F.max(F.struct("containment", "n_shared", "n_shingles")).alias("best")
    return find(docs, benchmark).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text contains no item, with their own columns."""
    own, k = docs.columns, "_k"
    while k in own:
        k += "_"
    leaked = _sized(Scratch(docs.sparkSession, "leaked").cut(find(docs, benchmark).select(F.col("k").alias(k)).distinct()))
    return docs.withColumn(k, _key(F.col("text").cast("string"))).join(leaked, k, "left_anti").select(*own)
