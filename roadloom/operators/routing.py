"""Map matching: points to lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DRIVABLE
from . import geometry

#: The match distance in metres, the least cosine of the angle between track and lane, the candidates a point keeps. Fixed values.
MATCH = 7.0
ALIGNED = 0.3
CANDIDATES = 7


def point_lane_distances(states: DataFrame, vertices: DataFrame, reach: float = MATCH) -> DataFrame:
    """Squared distance of each valid point to each lane within ``reach``, the cosine of the angle to the nearest segment, that segment and the share of it.

    A range join through grid cells of 2 x ``reach``: a segment is listed in every cell that its widened box meets, a
    point in one. So the join is an equality on (scenario, cell) and each (point, segment) pair meets once.
    """
    lanes = geometry.segments(vertices.filter(F.col("type").isin(*DRIVABLE)))
    cell = lambda c: F.floor(c / (2 * reach)).cast("int")
    span = lambda a, b: F.explode(F.sequence(cell(F.least(a, b) - reach), cell(F.greatest(a, b) + reach)))
    lanes = lanes.withColumn("gx", span(F.col("ax"), F.col("bx"))).withColumn("gy", span(F.col("ay"), F.col("by")))
    points = states.filter("valid = 1").select("scenario_id", "track_id", "t", "x", "y", "heading", cell(F.col("x")).alias("gx"), cell(F.col("y")).alias("gy"))
    near = points.join(lanes, ["scenario_id", "gx", "gy"])
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    near = near.withColumns({"dx": dx, "dy": dy}).withColumn("l2", F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")).filter("l2 > 1e-10")
    along = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((F.col("x") - F.col("ax")) * F.col("dx") + (F.col("y") - F.col("ay")) * F.col("dy")) / F.col("l2")))
    near = near.withColumn("u", along).withColumns({"px": F.col("x") - (F.col("ax") + F.col("u") * F.col("dx")), "py": F.col("y") - (F.col("ay") + F.col("u") * F.col("dy"))})
    near = near.withColumn("d2", F.col("px") * F.col("px") + F.col("py") * F.col("py")).filter(F.col("d2") <= reach * reach)
    # the nearest segment, the first of equally near ones, and its direction
    foot = F.struct("d2", "pt", "dx", "dy", "l2", "u")
    best = near.groupBy("scenario_id", "track_id", "t", "element_id", "heading").agg(F.min_by(foot, F.struct("d2", "pt")).alias("at"))
    norm = F.sqrt("at.l2") + 1e-6
    cosine = (F.col("at.dx") / norm) * F.cos("heading") + (F.col("at.dy") / norm) * F.sin("heading")
    return best.select("scenario_id", "track_id", "t", "element_id", "at.d2", cosine.alias("cosine"), "at.pt", "at.u")


def point_candidates(states: DataFrame, vertices: DataFrame, top: int = CANDIDATES) -> DataFrame:
    """The nearest lanes of each point among those that run its way, ties to the better aligned, then to the smaller lane."""
    w = Window.partitionBy("scenario_id", "track_id", "t").orderBy("d2", F.desc("cosine"), "element_id")
    near = point_lane_distances(states, vertices).filter(F.col("cosine") > ALIGNED)
    near = near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
    return near.select("scenario_id", "track_id", "t", "rank", "element_id", F.round(F.sqrt("d2"), 6).alias("distance"))
