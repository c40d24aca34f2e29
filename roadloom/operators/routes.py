"""Routes of agents: a kernel per scenario and chunk of its tracks, with the scenario's lanes beside them."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import routes as R
from ..schema import AGENT_TYPES, DRIVABLE, is_edge
from .lines import straightest_exits

KEY = "scenario_id"
#: Tracks of a scenario that go through one task.
CHUNK = 64

__all__ = ["agent_routes", "control_states", "lane_paths", "straightest_exits"]


def _network(elements: pd.DataFrame) -> R.Network:
    line = lambda p: np.array([(v["x"], v["y"]) for v in p], dtype=np.float64).reshape(-1, 2)
    e = elements.sort_values("seq")
    lanes = [(int(i), line(p), [int(x) for x in out]) for i, t, p, out in zip(e["element_id"], e["type"], e["polyline"], e["exit_lanes"], strict=True) if t in DRIVABLE and p is not None and len(p)]
    edges = [line(p) for t, p in zip(e["type"], e["polyline"], strict=True) if 20 <= t <= 29 and p is not None]
    return R.Network(lanes, edges)


def agent_routes(tracks: DataFrame, elements: DataFrame, header: DataFrame, percent: float = 0.0, check: int = 0) -> DataFrame:
    """``tracks`` with route, route_gt_len and control_state.

    Vehicles are routed; others lose their route. A vehicle other than the ego (agent 0) must be valid at frame
    ``check``, on the road, and valid in ``percent`` of the frames from there on. An ego without a route is an error.
    """
    lanes = elements.filter(F.col("type").isin(*DRIVABLE) | is_edge()).select(KEY, "element_id", "seq", "type", "polyline", F.coalesce("exit_lanes", F.array().cast("array<bigint>")).alias("exit_lanes"))
    t = tracks.join(header.select(KEY, "scenario_length"), KEY).withColumn("_chunk", (F.col("seq") / CHUNK).cast("int"))
    chunks = t.select(KEY, "_chunk").distinct()
    schema = t.drop("scenario_length", "_chunk").schema
    columns = schema.names

    def run(mine: pd.DataFrame, lanes: pd.DataFrame) -> pd.DataFrame:
        if mine.empty:
            return mine.reindex(columns=columns)
        net = _network(lanes)
        length = int(mine["scenario_length"].iloc[0])
        if 0 < length <= check:
            raise ValueError(f"route_check_timestep={check} is out of range for scenario length {length}")
        least = math.ceil((length - check) * percent / 100)
        routes, known, states = [], [], []
        for r in mine.itertuples(index=False):
            xy = np.array([(p["x"], p["y"]) for p in r.position], dtype=np.float64).reshape(-1, 2)
            valid = np.asarray(r.valid).astype(bool)
            own, n = [], 0
            if r.kind == "agent" and r.type == AGENT_TYPES["vehicle"]:
                ego = r.track_id == 0
                own, n = R.route(net, xy, np.asarray(r.heading, dtype=float), valid, np.asarray(r.length, dtype=float), np.asarray(r.width, dtype=float), ego, check, least)
                if ego and not own:
                    raise ValueError(f"no route for the ego of scenario {r.scenario_id}")
            routes.append(own), known.append(n)
            states.append(R.control_state(bool(own), xy[valid]) if r.kind == "agent" else r.control_state)
        out = mine.assign(route=routes, route_gt_len=np.array(known, dtype=np.int32), control_state=states)
        return out[columns]

    # each chunk of a scenario's tracks sees its lanes
    beside = chunks.join(lanes, KEY).withColumnsRenamed({KEY: "_scenario", "_chunk": "_part"})
    return t.groupBy(KEY, "_chunk").cogroup(beside.groupBy("_scenario", "_part")).applyInPandas(run, schema)


def control_states(states: DataFrame, routed: DataFrame | None = None) -> DataFrame:
    """control_state of each track from its frames: 0 if in ``routed``, else 1 if a valid point is more than MOVING from the median valid point, else 2."""
    v = states.filter("valid = 1")
    track = [KEY, "track_id"]
    mid = v.groupBy(*track).agg(F.median("x").alias("mx"), F.median("y").alias("my"))
    d = F.sqrt((F.col("x") - F.col("mx")) * (F.col("x") - F.col("mx")) + (F.col("y") - F.col("my")) * (F.col("y") - F.col("my")))
    far = v.join(mid, track).groupBy(*track).agg(F.max(d).alias("extent"))
    out = states.select(*track).distinct().join(far, track, "left")
    moving = F.when(F.coalesce("extent", F.lit(0.0)) > R.MOVING, 1).otherwise(2)
    if routed is not None:
        out = out.join(routed.select(*track, F.lit(True).alias("_r")).distinct(), track, "left")
        moving = F.when(F.col("_r"), 0).otherwise(moving)
    return out.select(*track, moving.alias("control_state"))


def lane_paths(links: DataFrame, hops: int = R.HOPS) -> DataFrame:
    """The path between any two lanes at most ``hops`` links apart: fewest hops, then first in order of exits.

    ``links`` has (scenario_id, element_id, exit_id, ordinal). A round of joins per hop; each pair keeps one path, so rows stay bounded by pairs.
    """
    step = links.select(KEY, F.col("element_id").alias("at"), "exit_id", "ordinal")
    level = links.filter("element_id <> exit_id").select(KEY, F.col("element_id").alias("src"), F.col("exit_id").alias("dst"), F.array("ordinal").alias("by"), F.array("element_id", "exit_id").alias("path"))
    first = Window.partitionBy(KEY, "src", "dst").orderBy(F.size("by"), "by")
    best = lambda d: d.withColumn("_k", F.row_number().over(first)).filter("_k = 1").drop("_k")
    level = found = best(level)
    for _ in range(hops - 1):
        grown = level.withColumnRenamed("dst", "at").join(step, [KEY, "at"]).filter("exit_id <> src")
        grown = grown.select(KEY, "src", F.col("exit_id").alias("dst"), F.concat("by", F.array("ordinal")).alias("by"), F.concat("path", F.array("exit_id")).alias("path"))
        level = best(grown.join(found.select(KEY, "src", "dst"), [KEY, "src", "dst"], "left_anti"))
        found = found.unionByName(level)
    return found.select(KEY, "src", "dst", (F.size("path") - 1).alias("hops"), "path")
