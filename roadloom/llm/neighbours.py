"""Approximate nearest neighbours by multi-index hashing.

Codes: ROTATIONS rotations, each learned by iterative quantisation on a bounded sample of FIT_ROWS vectors, give one
bit a dimension. A code is split into eight-bit substrings, each with a table from substring to rows. By the
pigeonhole principle a code within Hamming radius r of a query's is within floor(r / m) of it in one of the first
r mod m + 1 substrings, or within floor(r / m) - 1 in another; probing these buckets retrieves every code within r.
Those are reranked by their float vectors in double precision. The radius is learned from the sample (the RADIUS
quantile of the Hamming distances of true neighbours in it) and grows for a query that finds too few.

Rows are dealt to shards by hash of their id, SHARD_ROWS in each about, and queries to blocks of QUERY_ROWS; each
(shard, block) is one task of bounded size that returns a query's nearest; these are merged by rank.

Defined cases: vectors that are null, zero, hold a null or a non-finite component or have another than the commonest
dimension (the larger of two as common) take no part; a query has every vector but those of its own vec_id as
candidates; with fewer candidates than ``top`` all are returned; equal distances go by vec_id; rows without vec_id
take no part; rows that repeat an id are candidates each (but not for a query of that id); a query row that repeats
an id has ranks of its own, so that each of its ranks appears once a row; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, rank_in_sample

#: Vectors that rotations and radius are fitted on, at most.
FIT_ROWS = 4096
ROTATIONS = 4
#: Share of the sample's true neighbours that the first radius takes in.
RADIUS = 0.97
SHARD_ROWS = 50_000
LEAST_SHARDS = 8
QUERY_ROWS = 8192
TOP = 10
_BITS = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def learn_rotations(x: np.ndarray, n: int = ROTATIONS, rounds: int = 20, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projections (dimension x bits) by iterative quantisation from ``n`` random starts."""
    mean, rng, out = x.mean(axis=0), np.random.default_rng(seed), []
    y = x - mean
    for _ in range(n):
        r = np.linalg.qr(rng.normal(size=(x.shape[1], x.shape[1])))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(y.T @ np.where(y @ r > 0, 1.0, -1.0))
            r = u @ v
        out.append(r)
    return mean, np.concatenate(out, axis=1)


class Coder:
    """Codes of vectors and the radius to begin with."""

    def __init__(self, sample: np.ndarray):
        self.mean, self.rotation = learn_rotations(sample)
        codes, some = self.code(sample), sample[:256]
        d = (some**2).sum(axis=1)[:, None] + (sample**2).sum(axis=1) - 2 * some @ sample.T
        np.fill_diagonal(d, np.inf)
        near = np.argsort(d, axis=1)[:, : min(TOP, len(sample) - 1)]
        far = [_BITS[codes[i] ^ codes[n]].sum(axis=1, dtype=np.int64) for i, n in enumerate(near)]
        self.radius = int(np.ceil(np.quantile(np.concatenate(far), RADIUS))) if len(sample) > 1 else self.rotation.shape[1]

    def code(self, x: np.ndarray) -> np.ndarray:
        """Codes as rows of bytes, one a substring."""
        return np.packbits((x - self.mean) @ self.rotation > 0, axis=1)


class Index:
    """Tables of the substrings of one shard's codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.m = codes, codes.shape[1]
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(self.m)]
        self.bounds = [np.searchsorted(codes[o, j], np.arange(257)) for j, o in enumerate(self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within the radius."""
        deep, extra = divmod(radius, self.m)
        hit = np.zeros(len(self.codes), dtype=bool)
        for j in range(self.m):
            reach = deep if j <= extra else deep - 1
            for s in np.flatnonzero(_BITS[np.arange(256) ^ int(code[j])] <= reach):
                a, b = self.bounds[j][s], self.bounds[j][s + 1]
                hit[self.order[j][a:b]] = True
        rows = np.flatnonzero(hit)
        return rows[_BITS[self.codes[rows] ^ code].sum(axis=1, dtype=np.int64) <= radius]


def usable(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id and v (array of doubles) of the rows that take part."""
    v = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v")).filter("vec_id is not null and v is not null")
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.filter(F.coalesce(ok, F.lit(False)) & F.exists("v", lambda x: x != 0))


def search(vectors: DataFrame, queries: DataFrame | None = None, top: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of each query's nearest; queries are by default the rows whose id divides by 100."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "neighbours")
    rows = scratch.cut(usable(vectors))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    schema = "query_id long, copy int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes[0]["d"], sizes[0]["count"]
    rows = rows.filter(F.size("v") == dim)
    asked = (rows.filter("vec_id % 100 = 0") if queries is None else usable(queries).filter(F.size("v") == dim)).select("vec_id", "v")
    drawn = rows.filter(rank_in_sample("vec_id", 11) < min(1.0, 1.2 * FIT_ROWS / n)).select("v").limit(FIT_ROWS).toPandas()["v"]
    sample = np.stack(drawn.to_numpy()) if len(drawn) else np.stack(rows.select("v").limit(FIT_ROWS).toPandas()["v"].to_numpy())
    coder = spark.sparkContext.broadcast(Coder(sample))
    shards, blocks = max(LEAST_SHARDS, -(-n // SHARD_ROWS)), max(1, -(-asked.count() // QUERY_ROWS))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    # repeated ids get their place by content, too
    data = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")).withColumn("block", every(blocks))
    # rows of one id are numbered, so that each is a query
    asked = asked.withColumn("copy", F.row_number().over(Window.partitionBy("vec_id").orderBy("v")))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int")).withColumn("shard", every(shards))

    def near(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if q.empty or x.empty:
            return pd.DataFrame({"query_id": [], "copy": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "copy": "int32", "vec_id": "int64"})
        c, v, ids = coder.value, np.stack(x["v"].to_numpy()), x["vec_id"].to_numpy()
        index, out, bits = Index(c.code(v)), [], c.rotation.shape[1]
        asked = np.stack(q["v"].to_numpy())
        for own, copy, a, code in zip(q["vec_id"], q["copy"], asked, c.code(asked), strict=True):
            radius = c.radius
            while True:
                at = index.within(code, min(radius, bits))
                at = at[ids[at] != own]
                if len(at) >= top or radius >= bits:
                    break
                radius += max(1, bits // 16)
            d = np.sqrt(((v[at] - a) ** 2).sum(axis=1))
            best = np.lexsort((ids[at], d))[:top]
            out.append(pd.DataFrame({"query_id": own, "copy": np.int32(copy), "vec_id": ids[at][best], "score": d[best]}))
        return pd.concat(out, ignore_index=True)

    found = asked.groupBy("shard", "block").cogroup(data.groupBy("shard", "block")).applyInPandas(near, schema)
    order = Window.partitionBy("query_id", "copy").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
