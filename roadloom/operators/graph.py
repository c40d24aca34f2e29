"""Distances along the lane network."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DISTANCE, DRIVABLE

KEY = "scenario_id"
#: Source lanes of a scenario that go through one task.
CHUNK = 256


def distances_from(sources: list[int], ids: list[int], lengths: dict[int, float], exits: dict[int, list[int]]) -> np.ndarray:
    """Travel from each source to each lane: a link costs the length of the lane that it leaves, once for each time it is listed; infinity if there is no way."""
    place = {i: k for k, i in enumerate(ids)}
    weight: dict[int, dict[int, float]] = {}
    for i in ids:
        for e in exits.get(i, ()):
            if e in place:
                own = weight.setdefault(i, {})
                own[e] = own.get(e, 0.0) + lengths[i]
    out = np.full((len(sources), len(ids)), np.inf)
    for row, s in enumerate(sources):
        far, heap = {s: 0.0}, [(0.0, s)]
        while heap:
            d, i = heapq.heappop(heap)
            if d > far[i]:
                continue
            for e, w in weight.get(i, {}).items():
                if d + w < far.get(e, np.inf):
                    far[e] = d + w
                    heapq.heappush(heap, (d + w, e))
        for i, d in far.items():
            out[row, place[i]] = d
    return out


def lane_distances(elements: DataFrame) -> DataFrame:
    """All pairs of drivable lanes of each scenario with their distance, in the map's order; scenarios without such lanes have no rows.

    The result grows with the square of a scenario's lanes, as the map's format asks; sources are dealt to chunks.
    """
    lanes = elements.filter(F.col("type").isin(*DRIVABLE)).select(KEY, "element_id", "seq", "length", F.coalesce("exit_lanes", F.array().cast("array<bigint>")).alias("exit_lanes"))
    chunk = (F.col("seq") / CHUNK).cast("int")
    every = lanes.withColumn("_chunk", chunk).select(KEY, "_chunk").distinct().join(lanes, KEY)

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq")
        ids = [int(i) for i in f["element_id"]]
        mine = (f["seq"] // CHUNK == f["_chunk"].iloc[0]).to_numpy()
        sources, at = [i for i, m in zip(ids, mine, strict=True) if m], np.flatnonzero(mine)
        d = distances_from(sources, ids, dict(zip(ids, f["length"].astype(float), strict=True)), {i: [int(x) for x in e] for i, e in zip(ids, f["exit_lanes"], strict=True)})
        n = len(ids)
        return pd.DataFrame({KEY: int(f[KEY].iloc[0]), "src": np.repeat(sources, n), "dst": np.tile(ids, len(sources)), "src_pos": np.repeat(at, n).astype(np.int32), "dst_pos": np.tile(np.arange(n), len(sources)).astype(np.int32), "distance": d.ravel()})

    return every.groupBy(KEY, "_chunk").applyInPandas(run, DISTANCE)


def reconstruct(ids: list[int], lengths: dict[int, float], exits: dict[int, list[int]], d: np.ndarray, src: int, dst: int) -> list[int]:
    """Lanes from src to dst read off the distances: the first exit that lies on a shortest way, at most as many hops as lanes."""
    place = {i: k for k, i in enumerate(ids)}
    if src not in place or dst not in place or not np.isfinite(d[place[src], place[dst]]):
        return []
    path = [src]
    for _ in range(len(ids)):
        at = path[-1]
        if at == dst:
            return path
        left = d[place[at], place[dst]]
        nxt = next((e for e in exits.get(at, ()) if e in place and abs(lengths[at] + d[place[e], place[dst]] - left) < 0.01), None)
        if nxt is None:
            return []
        path.append(nxt)
    return path if path[-1] == dst else []
