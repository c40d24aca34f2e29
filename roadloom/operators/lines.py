"""Polyline operators over one row per vertex: equal subdivision, reversal, straightest exits, lanes near a track."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DRIVABLE, is_edge
from .geometry import ELEMENT, segments

#: Longest segment, margin of a track's box. Fixed values.
MAX_SEGMENT = 2.0
MARGIN = 12.0
#: Length of a segment that has a direction. Fixed value.
LEAST = 1e-6
#: Side of the cells that boxes are dealt to.
CELL = 200.0


def densify(vertices: DataFrame, longest: float = MAX_SEGMENT) -> DataFrame:
    """Each segment in equal parts of at most ``longest``, and the last vertex: pt, part, x, y, z; lengths are in space."""
    w = Window.partitionBy(*ELEMENT).orderBy("pt")
    v = vertices.withColumns({f"d{c}": F.coalesce(F.lead(c).over(w), c) - F.col(c) for c in "xyz"})
    length = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") + F.col("dz") * F.col("dz"))
    v = v.withColumn("n", F.greatest(F.ceil(length / longest), F.lit(1)).cast("int"))
    v = v.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    share = F.col("part") / F.col("n")
    return v.select(*ELEMENT, "pt", "part", *((F.col(c) + F.col(f"d{c}") * share).alias(c) for c in "xyz"))


def reverse_edges(vertices: DataFrame) -> DataFrame:
    """``vertices`` with the order of road edges' vertices reversed; pt need not be dense."""
    whole = Window.partitionBy(*ELEMENT)
    turned = F.min("pt").over(whole) + F.max("pt").over(whole) - F.col("pt")
    return vertices.withColumn("pt", F.when(is_edge(), turned).otherwise(F.col("pt")))


def straightest_exits(vertices: DataFrame, links: DataFrame) -> DataFrame:
    """For each lane of ``links`` (scenario_id, element_id, exit_id) the exit that goes on most nearly straight; ties to the smaller id."""
    s = segments(vertices).withColumns({"dx": F.col("bx") - F.col("ax"), "dy": F.col("by") - F.col("ay")})
    s = s.withColumn("l", F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))).filter(F.col("l") > LEAST)
    unit = F.struct((F.col("dx") / F.col("l")).alias("x"), (F.col("dy") / F.col("l")).alias("y"))
    ends = s.groupBy(*ELEMENT).agg(F.min_by(unit, "pt").alias("head"), F.max_by(unit, "pt").alias("tail"))
    # a lane without a long enough segment points nowhere, and takes part all the same
    nowhere = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    ends = vertices.select(*ELEMENT).distinct().join(ends, list(ELEMENT), "left").withColumns({c: F.coalesce(c, nowhere) for c in ("head", "tail")})
    exits = ends.select("scenario_id", F.col("element_id").alias("exit_id"), "head")
    pairs = links.join(ends.select(*ELEMENT, "tail"), list(ELEMENT)).join(exits, ["scenario_id", "exit_id"])
    dot = F.col("tail.x") * F.col("head.x") + F.col("tail.y") * F.col("head.y")
    best = F.max_by(F.struct("exit_id", dot.alias("dot")), F.struct(dot.alias("dot"), -F.col("exit_id"))).alias("b")
    return pairs.groupBy(*ELEMENT).agg(best).select(*ELEMENT, "b.exit_id", "b.dot")


def _box(rows: DataFrame, keys: list[str], margin: float) -> DataFrame:
    b = rows.groupBy(*keys).agg((F.min("x") - margin).alias("x0"), (F.max("x") + margin).alias("x1"), (F.min("y") - margin).alias("y0"), (F.max("y") + margin).alias("y1"))
    cell = lambda c: F.floor(F.col(c) / CELL).cast("int")
    b = b.withColumns({"cx": cell("x0"), "cy": cell("y0")})
    return b.withColumn("gx", F.explode(F.sequence("cx", cell("x1")))).withColumn("gy", F.explode(F.sequence("cy", cell("y1"))))


def lanes_near_tracks(states: DataFrame, vertices: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Lanes whose box meets the widened box of a track's valid points.

    Boxes are dealt to cells, so the join is an equality; a pair counts in the first cell that both have, so it meets once.
    """
    t = _box(states.filter("valid = 1"), ["scenario_id", "track_id"], margin).alias("t")
    e = _box(vertices.filter(F.col("type").isin(*DRIVABLE)), ["scenario_id", "element_id"], 0.0).alias("e")
    a, b = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"e.{c}"))
    meets = (a("scenario_id") == b("scenario_id")) & (a("gx") == b("gx")) & (a("gy") == b("gy"))
    meets &= (a("x0") <= b("x1")) & (b("x0") <= a("x1")) & (a("y0") <= b("y1")) & (b("y0") <= a("y1"))
    meets &= (a("gx") == F.greatest(a("cx"), b("cx"))) & (a("gy") == F.greatest(a("cy"), b("cy")))
    return t.join(e, meets).select("t.scenario_id", "t.track_id", "e.element_id")
