"""Road edges along shoulders: a kernel per scenario that sees its lanes and surfaces."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import shoulders as S
from ..functions.polylines import from_points, to_points
from ..schema import EDGE_TYPES, POINTS, is_lane

KEY = "scenario_id"
#: Share of a shoulder's area in intersections that makes it a part of the junction. Fixed value.
IN_JUNCTION = 0.5


def shoulder_edges(elements: DataFrame, surfaces: DataFrame, widening: float = 0.0) -> DataFrame:
    """``elements`` and their scenarios' shoulder edges, numbered on from the greatest id; scenarios without shoulders stay as they are."""
    lanes = elements.filter(is_lane() & F.col("polyline").isNotNull())
    beside = (F.coalesce(F.size("left_neighbor"), F.lit(0)) + F.coalesce(F.size("right_neighbor"), F.lit(0))) > 0
    lane = F.struct("element_id", "polyline", "left_boundary", "right_boundary", "entry_lanes", "exit_lanes", beside.alias("neighbours"), "in_junction")
    rows = lanes.select(KEY, "seq", F.lit("lane").alias("kind"), lane.alias("lane")).unionByName(surfaces.select(KEY, "seq", "kind", "outline"), allowMissingColumns=True)
    rows = rows.join(surfaces.filter("kind = 'shoulder'").select(KEY).distinct(), KEY, "left_semi")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq", kind="stable")
        ids = lambda x: [] if x is None else [int(i) for i in x]
        line = lambda p: None if p is None else from_points(p)
        own = [S.Lane(int(l["element_id"]), line(l["polyline"]), line(l["left_boundary"]), line(l["right_boundary"]), ids(l["entry_lanes"]), ids(l["exit_lanes"]), bool(l["neighbours"]), bool(l["in_junction"])) for l in f[f["kind"] == "lane"]["lane"]]
        outlines = lambda k: [from_points(o) for o in f[f["kind"] == k]["outline"]]
        found = S.Scene(own, outlines("shoulder"), outlines("junction")).edges(widening)
        return pd.DataFrame({KEY: np.full(len(found), f[KEY].iloc[0]), "k": np.arange(len(found), dtype=np.int32), "polyline": [to_points(p) for p in found]})

    found = rows.groupBy(KEY).applyInPandas(run, f"{KEY} long, k int, polyline {POINTS}")
    top = elements.groupBy(KEY).agg(F.max("element_id").alias("_id"), F.max("seq").alias("_seq"))
    none = F.array().cast("array<bigint>")
    new = found.join(top, KEY).select(
        KEY, (F.col("_id") + 1 + F.col("k")).alias("element_id"), (F.col("_seq") + 1 + F.col("k")).cast("int").alias("seq"), F.lit(EDGE_TYPES["boundary"]).alias("type"), "polyline", F.lit(-1.0).alias("speed_limit_mps"),
        *(none.alias(c) for c in ("entry_lanes", "exit_lanes", "left_neighbor", "right_neighbor")), F.lit(0.0).alias("length"), F.lit(False).alias("in_junction"), F.lit(-1).alias("speed_zone_idx"),
    )
    return elements.unionByName(new, allowMissingColumns=True)


def overlap_area(a: np.ndarray, b: np.ndarray) -> float:
    """Area that two polygons share: by slabs between all their vertices and crossings, in which both are trapezoids."""
    xs = np.unique(np.concatenate([a[:, 0], b[:, 0], _crossings(a, b)]))
    total = 0.0
    for x0, x1 in zip(xs[:-1], xs[1:], strict=True):
        if x1 - x0 < 1e-12:
            continue
        spans = [[_slice(p, x0 + (x1 - x0) * u) for u in (0.25, 0.75)] for p in (a, b)]
        for u in (0, 1):
            for lo, hi in spans[0][u]:
                total += (x1 - x0) / 2 * sum(max(0.0, min(hi, h) - max(lo, l)) for l, h in spans[1][u])
    return total


def _slice(ring: np.ndarray, x: float) -> list[tuple[float, float]]:
    p, q = ring, np.roll(ring, -1, axis=0)
    on = (p[:, 0] > x) != (q[:, 0] > x)
    ys = np.sort(p[on, 1] + (x - p[on, 0]) / (q[on, 0] - p[on, 0]) * (q[on, 1] - p[on, 1]))
    return list(zip(ys[::2], ys[1::2], strict=False))


def _crossings(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    r, s = np.roll(a, -1, axis=0) - a, np.roll(b, -1, axis=0) - b
    den = r[:, None, 0] * s[None, :, 1] - r[:, None, 1] * s[None, :, 0]
    w = b[None] - a[:, None]
    safe = np.where(np.abs(den) < 1e-15, 1.0, den)
    t = (w[..., 0] * s[None, :, 1] - w[..., 1] * s[None, :, 0]) / safe
    u = (w[..., 0] * r[:, None, 1] - w[..., 1] * r[:, None, 0]) / safe
    ok = (np.abs(den) >= 1e-15) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    return (a[:, None, 0] + t * r[:, None, 0])[ok]


def split_shoulders(shoulders: DataFrame, intersections: DataFrame) -> DataFrame:
    """Outlines (scenario_id, seq, outline) as surfaces: intersections and shoulders with half their area or more in them are of the kind junction, others shoulder; scenarios without shoulders have none."""
    rows = shoulders.select(KEY, "seq", F.lit(False).alias("_i"), "outline").unionByName(intersections.select(KEY, "seq", F.lit(True).alias("_i"), "outline")).join(shoulders.select(KEY).distinct(), KEY, "left_semi")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["_i", "seq"], ascending=[False, True], kind="stable")
        rings = [from_points(o)[:, :2] for o in f["outline"]]
        around = [r for r, i in zip(rings, f["_i"], strict=True) if i]
        kinds = []
        for r, i in zip(rings, f["_i"], strict=True):
            area = abs(S._area(r)) if len(r) >= 3 else 0.0
            kinds.append("junction" if i else "" if area == 0 else "junction" if sum(overlap_area(r, o) for o in around) >= IN_JUNCTION * area else "shoulder")
        out = pd.DataFrame({KEY: f[KEY], "kind": kinds, "seq": np.arange(len(f), dtype=np.int32), "outline": list(f["outline"])})
        return out[out["kind"] != ""]

    return rows.groupBy(KEY).applyInPandas(run, f"{KEY} long, kind string, seq int, outline {POINTS}")
