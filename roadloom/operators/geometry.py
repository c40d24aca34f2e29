"""Map geometry operators over one row per vertex."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ELEMENT = ("scenario_id", "element_id")


def _step() -> tuple:
    w = Window.partitionBy(*ELEMENT).orderBy("pt")
    dx, dy, dz = (F.col(c) - F.lag(c).over(w) for c in ("x", "y", "z"))
    return w, F.sqrt(dx * dx + dy * dy + dz * dz)


def arc_length(vertices: DataFrame) -> DataFrame:
    """``vertices`` with ``s``: the length of the line up to each vertex."""
    w, step = _step()
    return vertices.withColumn("step", F.coalesce(step, F.lit(0.0))).withColumn("s", F.sum("step").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("step")


def drop_duplicates(vertices: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """Vertices at least ``tolerance`` from the vertex before."""
    _, step = _step()
    return vertices.withColumn("step", step).filter(F.col("step").isNull() | (F.col("step") >= tolerance)).drop("step")


def segments(vertices: DataFrame) -> DataFrame:
    """One row per segment of each element: ax, ay, bx, by."""
    w = Window.partitionBy(*ELEMENT).orderBy("pt")
    out = vertices.withColumns({"bx": F.lead("x").over(w), "by": F.lead("y").over(w)}).filter("bx is not null")
    return out.select(*ELEMENT, "type", "pt", F.col("x").alias("ax"), F.col("y").alias("ay"), "bx", "by")


def recentre(vertices: DataFrame) -> DataFrame:
    """``vertices`` less the mean vertex of their scenario; the means are one row a scenario and join by it."""
    centre = vertices.groupBy("scenario_id").agg(*(F.avg(c).alias(f"c{c}") for c in "xyz"))
    return vertices.join(centre, "scenario_id").withColumns({c: F.col(c) - F.col(f"c{c}") for c in "xyz"}).drop("cx", "cy", "cz")


def bounds(vertices: DataFrame) -> DataFrame:
    """Least, greatest and middle coordinates of each scenario."""
    b = vertices.groupBy("scenario_id").agg(F.min("x").alias("min_x"), F.max("x").alias("max_x"), F.min("y").alias("min_y"), F.max("y").alias("max_y"))
    return b.withColumns({"mid_x": (F.col("min_x") + F.col("max_x")) / 2, "mid_y": (F.col("min_y") + F.col("max_y")) / 2})


def reindex(vertices: DataFrame) -> DataFrame:
    """Dense element ids from 0 in each scenario, in order of element_id."""
    e = vertices.groupBy(*ELEMENT).agg(F.count("*").alias("n_vertices"))
    return e.withColumn("dense_id", (F.row_number().over(Window.partitionBy("scenario_id").orderBy("element_id")) - 1).cast("int"))
