"""Traffic control operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import points as P
from ..schema import CONTROL_TYPES, LANE_TYPES, LIGHT_STATES, Scenarios, is_lane

#: Width of a lane without boundaries at its stop line, in metres. Fixed value.
WIDTH = 3.5


def compact_phases(zones: DataFrame, *keys: str) -> DataFrame:
    """``zones`` (junction_id, phase_idx) with phases numbered densely from 0 in each junction (of each ``keys``); junctions below 0 stay as they are.

    Distinct phases are ranked, not zones, so that a large junction is not sorted in one task.
    """
    by = [*keys, "junction_id"]
    phases = zones.filter("junction_id >= 0").select(*by, "phase_idx").distinct()
    dense = (F.row_number().over(Window.partitionBy(*by).orderBy("phase_idx")) - 1).cast("int")
    ranked = zones.join(phases.withColumn("dense_phase", dense), [*by, "phase_idx"], "left")
    return ranked.withColumn("dense_phase", F.coalesce("dense_phase", F.col("phase_idx").cast("int")))


def incoming_heading(lanes: DataFrame) -> DataFrame:
    """``lanes`` and ``heading``: the circular mean of their entry lanes' last segments, else that of their own first segment; null if there is none."""
    last = F.when(F.size("polyline") >= 2, P.direction(F.element_at("polyline", -2), F.element_at("polyline", -1)))
    ends = lanes.select("scenario_id", F.col("element_id").alias("entry"), last.alias("h")).filter("h is not null")
    entries = lanes.select("scenario_id", "element_id", F.explode("entry_lanes").alias("entry")).join(ends, ["scenario_id", "entry"])
    mean = entries.groupBy("scenario_id", "element_id").agg(F.atan2(F.avg(F.sin("h")), F.avg(F.cos("h"))).alias("_mean"))
    own = F.when(F.size("polyline") >= 2, P.direction(F.get("polyline", F.lit(0)), F.get("polyline", F.lit(1))))
    return lanes.join(mean, ["scenario_id", "element_id"], "left").withColumn("heading", F.coalesce("_mean", own)).drop("_mean")


def boundary_width(left: Column, right: Column) -> Column:
    """Distance of the boundaries' first vertices, WIDTH where there is none."""
    wide = F.when((F.size(left) > 0) & (F.size(right) > 0), P.distance(F.get(left, F.lit(0)), F.get(right, F.lit(0))))
    return P.let(wide, lambda w: F.when(w.isNotNull() & ~F.isnan(w) & (w > 0) & (w < float("inf")), w).otherwise(WIDTH))


def line_at_start(polyline: Column, width: Column, heading: Column) -> Column:
    """A stop line of a width across a heading through a lane's first vertex."""
    p = F.get(polyline, F.lit(0))
    at = lambda sign: F.struct((p["x"] - sign * width / 2 * F.sin(heading)).alias("x"), (p["y"] + sign * width / 2 * F.cos(heading)).alias("y"), p["z"].alias("z"))
    return F.array(at(-1), at(1))


def line_across(polygon: Column, heading: Column) -> Column:
    """The cut of a polygon across a heading through the mean of its vertices, its outermost points; null under two vertices.

    A polygon that is not cut twice gives half its width across the heading to either side of the mean.
    """

    def cut(ring: Column) -> Column:
        mean = lambda c: F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + p[c]) / F.size(ring)
        centre = F.struct(*(mean(c).alias(c) for c in P.SPACE))
        nx, ny = -F.sin(heading), F.cos(heading)

        def of(c: Column) -> Column:
            def hit(a: Column, i: Column) -> Column:
                b = F.get(ring, F.pmod(i + 1, F.size(ring)))
                ex, ey, wx, wy = b["x"] - a["x"], b["y"] - a["y"], a["x"] - c["x"], a["y"] - c["y"]
                den = ex * ny - ey * nx
                t, u = (ex * wy - ey * wx) / den, (nx * wy - ny * wx) / den
                return F.when(F.abs(den) > 1e-8, F.when(u.between(0, 1), F.struct(t.alias("t"), P.between(a, b, u).alias("p"))))

            hits = F.array_sort(F.filter(F.transform(ring, hit), lambda h: h.isNotNull()), lambda a, b: F.when(a["t"] < b["t"], -1).when(a["t"] > b["t"], 1).otherwise(0))
            across = F.transform(ring, lambda p: p["x"] * nx + p["y"] * ny)
            half = (F.array_max(across) - F.array_min(across)) / 2
            side = lambda s: F.struct((c["x"] + s * nx * half).alias("x"), (c["y"] + s * ny * half).alias("y"), c["z"].alias("z"))
            return P.let(hits, lambda h: F.when(F.size(h) >= 2, F.array(F.get(h, F.lit(0))["p"], F.element_at(h, -1)["p"])).otherwise(F.array(side(-1), side(1))))

        return P.let(centre, of)

    first, last = F.get(polygon, F.lit(0)), F.element_at(polygon, -1)
    same = F.lit(True)
    for c in P.SPACE:
        same = same & (F.abs(first[c] - last[c]) <= 1e-8 + 1e-5 * F.abs(last[c]))
    ring = F.when((F.size(polygon) > 1) & same, F.slice(polygon, 1, F.size(polygon) - 1)).otherwise(polygon)
    return P.let(ring, lambda r: F.when(F.size(r) >= 2, cut(r)))


def traffic_controls(s: Scenarios) -> DataFrame:
    """Lights, then stop zones for lanes without a light, in one ordered list.

    Lights of bike lanes and of lanes that are not in the map go; a stop zone loses lanes that a light covers and takes its heading from the first that is left.
    """
    lanes = incoming_heading(s.elements.filter(is_lane()))
    lanes = lanes.select("scenario_id", F.col("element_id").alias("lane"), "type", "heading", "polyline", "left_boundary", "right_boundary")
    usable = lanes.filter(F.col("type") != LANE_TYPES["bike_lane"]).drop("type").withColumnRenamed("lane", "controlled_lane")
    of_light = s.lights.join(usable, ["scenario_id", "controlled_lane"]).filter(F.col("heading").isNotNull() & (F.size("polyline") > 0))
    line = line_at_start(F.col("polyline"), boundary_width(F.col("left_boundary"), F.col("right_boundary")), F.col("heading"))
    none = lambda t: F.lit(-1).cast(t)
    lights = of_light.select(
        "scenario_id", F.col("light_id").alias("control_id"), F.col("seq"), F.lit(CONTROL_TYPES["traffic_light"]).alias("type"), F.array("controlled_lane").alias("controlled_lanes"),
        line.alias("stop_line"), "heading", "states", none("long").alias("junction_id"), none("int").alias("phase_idx"),
    )
    covered = lights.groupBy("scenario_id").agg(F.collect_set(F.col("controlled_lanes")[0]).alias("covered"), F.max("control_id").alias("top"), F.count("*").alias("n"))
    z = s.zones.join(covered, "scenario_id", "left").withColumn("controlled_lanes", F.filter("controlled_lanes", lambda x: ~F.array_contains(F.coalesce("covered", F.array().cast("array<bigint>")), x)))
    z = z.filter(F.size("controlled_lanes") > 0).withColumn("lane", F.col("controlled_lanes")[0])
    z = z.join(lanes.select("scenario_id", "lane", "heading"), ["scenario_id", "lane"]).filter("heading is not null").withColumn("stop_line", line_across(F.col("polygon"), F.col("heading"))).filter("stop_line is not null")
    signal = F.col("type") == CONTROL_TYPES["traffic_light"]
    whole = signal & (F.col("junction_id") >= 0) & (F.col("phase_idx") >= 0)
    z = z.join(s.header.select("scenario_id", "scenario_length"), "scenario_id")
    place = F.row_number().over(Window.partitionBy("scenario_id").orderBy("seq"))
    zones = z.select(
        "scenario_id", (F.coalesce(F.greatest(F.col("top"), F.lit(-1)), F.lit(-1)) + place).cast("long").alias("control_id"), (F.coalesce("n", F.lit(0)) + place - 1).cast("int").alias("seq"), "type", "controlled_lanes", "stop_line", "heading",
        F.when(signal, F.array_repeat(F.lit(LIGHT_STATES["unknown"]), F.greatest(F.col("scenario_length"), F.lit(0)))).otherwise(F.array().cast("array<int>")).alias("states"),
        F.when(whole, F.col("junction_id")).otherwise(none("long")).alias("junction_id"), F.when(whole, F.col("phase_idx")).otherwise(none("int")).alias("phase_idx"),
    )
    ordered = lights.withColumn("seq", (F.row_number().over(Window.partitionBy("scenario_id").orderBy("seq")) - 1).cast("int"))
    out = compact_phases(ordered.unionByName(zones), "scenario_id")
    return out.withColumn("phase_idx", F.col("dense_phase")).drop("dense_phase").select(*lights.columns)
