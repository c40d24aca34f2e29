"""Oriented boxes of agents and their overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import points as P

KEY = "scenario_id"
#: Side of the cells that boxes are dealt to, in metres.
CELL = 10.0


def corners(x: Column, y: Column, heading: Column, length: Column, width: Column) -> Column:
    """Front right, front left, rear left and rear right corner."""
    c, s, h, w = F.cos(heading), F.sin(heading), length / 2, width / 2
    at = lambda a, b: F.struct((x + c * a - s * b).alias("x"), (y + s * a + c * b).alias("y"))
    return F.array(at(h, -w), at(h, w), at(-h, w), at(-h, -w))


def _apart(a: Column, b: Column, ux: Column, uy: Column) -> Column:
    """Whether boxes are apart along a direction."""
    along = lambda box: F.transform(box, lambda p: p["x"] * ux + p["y"] * uy)
    return (F.array_max(along(a)) < F.array_min(along(b))) | (F.array_max(along(b)) < F.array_min(along(a)))


def touch(a: Column, b: Column) -> Column:
    """Whether two boxes share a point: no side of either separates them."""
    sides = [(box[i], box[i + 1]) for box in (a, b) for i in (0, 1)]
    out = F.lit(False)
    for p, q in sides:
        out = out | _apart(a, b, q["x"] - p["x"], q["y"] - p["y"])
    return ~out


def overlapping(states: DataFrame, active: Column, cell: float = CELL) -> DataFrame:
    """Agents that are not ``active`` and touch an active one in a frame in which both are valid.

    Boxes are listed in the cells that they meet; the join is an equality on scenario, frame and cell, and existence is all that counts.
    """
    b = states.filter("valid = 1").withColumn("box", corners(*(F.col(c) for c in ("x", "y", "heading", "length", "width")))).withColumn("active", active)
    low = lambda c: F.floor(F.array_min(F.transform("box", lambda p: p[c])) / cell).cast("int")
    high = lambda c: F.floor(F.array_max(F.transform("box", lambda p: p[c])) / cell).cast("int")
    b = b.withColumn("gx", F.explode(F.sequence(low("x"), high("x")))).withColumn("gy", F.explode(F.sequence(low("y"), high("y"))))
    b = b.select(KEY, "track_id", "t", "box", "active", "gx", "gy")
    log, live = b.filter(~F.col("active")).alias("a"), b.filter("active").alias("b")
    meets = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in (KEY, "t", "gx", "gy")]
    on = meets[0] & meets[1] & meets[2] & meets[3] & touch(F.col("a.box"), F.col("b.box"))
    return log.join(live, on, "left_semi").select(KEY, "track_id").distinct()


def invalidate(tracks: DataFrame) -> DataFrame:
    """Agents without a route that touch a routed agent are never valid any more, without route, and stand still."""
    frame = F.arrays_zip("position", "heading", "length", "width", "valid")
    agents = tracks.filter("kind = 'agent'").select(KEY, "track_id", (F.size("route") > 0).alias("routed"), F.posexplode(frame).alias("t", "f"))
    states = agents.select(KEY, "track_id", "routed", "t", "f.position.x", "f.position.y", "f.heading", "f.length", "f.width", "f.valid")
    hit = overlapping(states, F.col("routed")).withColumn("_hit", F.lit(True)).withColumn("kind", F.lit("agent"))
    out = tracks.join(hit, [KEY, "kind", "track_id"], "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))
    none = F.array().cast("array<bigint>")
    return out.withColumns(
        {
            "valid": F.when(F.col("_hit"), F.transform("valid", lambda _: F.lit(0))).otherwise(F.col("valid")), "route": F.when(F.col("_hit"), none).otherwise(F.col("route")),
            "route_gt_len": F.when(F.col("_hit"), 0).otherwise(F.col("route_gt_len")), "control_state": F.when(F.col("_hit"), 2).otherwise(F.col("control_state")),
        }
    ).drop("_hit").select(*tracks.columns)


def extent(trajectory: Column) -> Column:
    """How far a trajectory's points are from their median point, at most; 0 under two points."""
    mid = lambda xs: P.let(F.array_sort(xs), lambda s: (F.get(s, ((F.size(s) - 1) / 2).cast("int")) + F.get(s, (F.size(s) / 2).cast("int"))) / 2)
    centre = F.struct(mid(F.transform(trajectory, lambda p: p["x"])).alias("x"), mid(F.transform(trajectory, lambda p: p["y"])).alias("y"))
    far = P.let(centre, lambda c: F.array_max(F.transform(trajectory, lambda p: P.distance(p, c, P.PLANE))))
    return F.when(F.size(trajectory) >= 2, far).otherwise(0.0)
