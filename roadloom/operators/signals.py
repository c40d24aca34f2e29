"""Signal series (colour per track and frame), by windows over a track's frames."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lights as L
from ..functions import points as P
from ..schema import AGENT_TYPES, DRIVABLE, LIGHT
from .tracks import TRACK, _by_time

#: Frames before red that are yellow, frames from which a flip counts as real. Fixed values.
YELLOW = 20
SMOOTH = 30


def insert_yellow(series: DataFrame, frames: int = YELLOW) -> DataFrame:
    """``series`` (with colour G, R or other) in which the frames before each change from green to red are yellow (Y)."""
    turns = F.when((F.col("colour") == "R") & (F.lag("colour").over(_by_time()) == "G"), 1).otherwise(0)
    ahead = F.max("_turn").over(_by_time().rowsBetween(1, frames))
    return series.withColumn("_turn", turns).withColumn("colour", F.when(ahead == 1, "Y").otherwise(F.col("colour"))).drop("_turn")


def short_flips(series: DataFrame, frames: int = SMOOTH) -> DataFrame:
    """First and last frame of each short flip between two runs of the other colour.

    Runs of green and red alternate in a chain; they are read in turn, so a run that has bounded a flip on its right is
    the left bound of the next one, and only every second run of a chain can be a flip.
    """
    lit = F.col("colour").isin("G", "R")
    s = series.withColumn("chain", F.sum(F.when(lit, 0).otherwise(1)).over(_by_time())).filter(lit)
    by = Window.partitionBy(*TRACK, "chain").orderBy("t")
    s = s.withColumn("turn", F.when(F.lag("colour").over(by) != F.col("colour"), 1).otherwise(0)).withColumn("run", F.sum("turn").over(by))
    runs = s.groupBy(*TRACK, "chain", "run").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("frames"))
    runs = runs.withColumn("last_run", F.max("run").over(Window.partitionBy(*TRACK, "chain")))
    return runs.filter((F.col("run") % 2 == 1) & (F.col("run") < F.col("last_run")) & (F.col("frames") < frames)).select(*TRACK, "first_t", "last_t")


def interpolate(lights: DataFrame, elements: DataFrame, tracks: DataFrame, header: DataFrame) -> DataFrame:
    """``lights`` with states of junctions' connectors completed from vehicles: a kernel per scenario, which sees its drivable lanes, its vehicles and its lights.

    New lights follow the old ones; scenarios without any light stay as they are, since a junction needs an observed state.
    """
    lanes = elements.filter(F.col("type").isin(*DRIVABLE) & (F.size("polyline") >= 2)).select("scenario_id", "seq", F.lit("lane").alias("what"), F.struct("element_id", "polyline", "entry_lanes", "exit_lanes", "left_neighbor", "right_neighbor").alias("lane"))
    cars = tracks.filter((F.col("kind") == "agent") & (F.col("type") == AGENT_TYPES["vehicle"])).select("scenario_id", "seq", F.lit("car").alias("what"), F.struct("track_id", "position", "heading", "velocity", "valid").alias("car"))
    known = lights.select("scenario_id", "seq", F.lit("light").alias("what"), F.struct("light_id", "position", "states", "controlled_lane").alias("light"))
    every = lanes.unionByName(cars, allowMissingColumns=True).unionByName(known, allowMissingColumns=True)
    every = every.join(lights.select("scenario_id").distinct(), "scenario_id", "left_semi").join(header.select("scenario_id", "scenario_length", "dt"), "scenario_id")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq", kind="stable")
        n, dt, of = int(f["scenario_length"].iloc[0]), float(f["dt"].iloc[0]), lambda w: f[f["what"] == w][w]
        rows = lambda p, *c: np.array([[q[k] for k in c] for q in p], dtype=np.float64).reshape(-1, len(c))
        ids = lambda x: [] if x is None else [int(i) for i in x]
        table = {int(e["element_id"]): L.Lane(int(e["element_id"]), rows(e["polyline"], "x", "y", "z"), ids(e["entry_lanes"]), ids(e["exit_lanes"]), ids(e["left_neighbor"]), ids(e["right_neighbor"]), np.full(n, L.ABSENT)) for e in of("lane")}
        states = {int(x["light_id"]): {"position": [x["position"][c] for c in "xyz"], "states": ids(x["states"]), "controlled_lane": int(x["controlled_lane"])} for x in of("light")}
        for s in states.values():
            lane = table.get(s["controlled_lane"])
            if lane is not None:
                own = np.array(s["states"][:n], dtype=int)
                lane.seen[: len(own)] = np.where((own >= L.RED) & (own <= L.GREEN), own, L.UNKNOWN)
        cars = [(int(c["track_id"]), rows(c["position"], "x", "y", "z"), np.asarray(c["heading"], dtype=float), rows(c["velocity"], "x", "y"), np.asarray(c["valid"]).astype(bool)) for c in of("car")]
        out = L.interpolate(table, cars, states, dt, n)
        return pd.DataFrame(
            [(int(f["scenario_id"].iloc[0]), k, i, dict(zip("xyz", map(float, s["position"]), strict=True)), [int(x) for x in s["states"]], s["controlled_lane"]) for i, (k, s) in enumerate(out.items())],
            columns=["scenario_id", "light_id", "seq", "position", "states", "controlled_lane"],
        )

    return every.groupBy("scenario_id").applyInPandas(run, LIGHT)


def acceleration_weight(vertices: Column, a: Column) -> Column:
    """How much an acceleration tells so many vertices before the stop line."""
    d = vertices * L.VERTEX
    return F.when((d < -8) | ((a < 0) & (d < 0)) | (d >= 30), 0.0).when(d <= 15, 1.0).otherwise((d - 30) * (d - 30) / 225)


def speed_weight(vertices: Column, v: Column) -> Column:
    """How much a speed tells so many vertices before the stop line."""
    d = vertices * L.VERTEX
    full = F.when(v <= 12, F.lit(9.0) / 36 * (v - 6) * (v - 6) + 6).otherwise(F.least(v + 3, F.lit(30.0)))
    return F.when((d < -12) | (d > 2 * full), 0.0).when(d <= full, 1.0).otherwise((d - 2 * full) * (d - 2 * full) / (full * full))


def neighbour_kinds(pairs: DataFrame) -> DataFrame:
    """``pairs`` of lines (a, b) with what b is beside a: a true neighbour, a lane that splits off, or one that joins."""
    ends = lambda c: (F.get(c, F.lit(0)), F.element_at(c, -1))
    (a0, a1), (b0, b1) = ends("a"), ends("b")
    ux, uy, vx, vy = a1["x"] - a0["x"], a1["y"] - a0["y"], b1["x"] - b0["x"], b1["y"] - b0["y"]
    size = F.sqrt((ux * ux + uy * uy) * (vx * vx + vy * vy))
    cosine = F.when(size > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (ux * vx + uy * vy) / size)))
    along = F.coalesce(F.degrees(F.acos(cosine)) < L.PARALLEL, F.lit(False))
    start, end = P.distance(a0, b0), P.distance(a1, b1)
    near = F.when(along, L.TOUCH).otherwise(L.CLOSE)
    return pairs.withColumns({"neighbour": along, "splits": start < near, "joins": (start >= near) & (end < near)})
