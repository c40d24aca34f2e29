"""Map element operators: one row per element with its points, so that nothing is shuffled."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import points as P
from ..functions.polylines import from_points, line_distances, simplify, to_points
from ..schema import DRIVABLE, POINTS, is_edge, is_lane

#: Lane width where it can't be measured, and the widest lane, in metres. Fixed values.
DEFAULT_WIDTH, WIDEST = 3.7, 50.0
#: Longest part of a polygon's edge, in metres. Fixed value.
SPACING = 5.0


def reverse_edges(elements: DataFrame) -> DataFrame:
    """Road edges the other way round."""
    return elements.withColumn("polyline", F.when(is_edge(), F.reverse("polyline")).otherwise(F.col("polyline")))


def close_polygons(elements: DataFrame, spacing: float = SPACING) -> DataFrame:
    """Polygons closed and their edges cut to ``spacing``."""
    return elements.withColumn("polygon", F.when(F.col("polygon").isNotNull(), P.ring(F.col("polygon"), spacing)))


def process_polylines(elements: DataFrame, longest: float = 10.0, tolerance: float = 0.1) -> DataFrame:
    """Lines of two or more points without repeated points, simplified (if ``tolerance`` > 0, from three points on) and cut (if ``longest`` > 0)."""

    @F.pandas_udf(POINTS)
    def fewer(lines: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else to_points(simplify(from_points(p), tolerance)) for p in lines], dtype=object)

    out = P.distinct_steps(F.col("polyline"))
    elements = elements.withColumn("_line", F.when(F.size("polyline") >= 2, out))
    if tolerance > 0:
        # the kernel sees only lines that can lose a vertex
        elements = elements.withColumn("_line", F.when(F.size("_line") >= 3, fewer(F.when(F.size("_line") >= 3, F.col("_line")))).otherwise(F.col("_line")))
    if longest > 0:
        elements = elements.withColumn("_line", P.let(F.col("_line"), lambda p: P.densify(p, longest)))
    return elements.withColumn("polyline", F.coalesce("_line", "polyline")).drop("_line")


def lane_widths(elements: DataFrame, default: float = DEFAULT_WIDTH) -> DataFrame:
    """``width`` of lanes at each vertex: the planar distances to both boundaries together, ``default`` where a boundary is missing or the sum is no positive number, WIDEST at most."""
    lane = is_lane() & F.col("polyline").isNotNull()

    def plane(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        flat = lines.flatten()
        xy = [pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(np.float64) for c in "xy"]
        return np.stack(xy), pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False).astype(np.int64)

    def widths(polyline: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        points, n = plane(polyline)
        wide = sum(line_distances(points, n, *plane(side)) for side in (left, right))
        wide = np.where(np.isfinite(wide) & (wide > 0), np.minimum(wide, WIDEST), min(default, WIDEST))
        empty = np.array(polyline.is_null().to_numpy(zero_copy_only=False), dtype=bool)
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(wide, pa.float64()), mask=pa.array(empty))

    # not deterministic for the optimizer: a filter on the widths, as explode brings one, would work them out again
    kernel = F.arrow_udf(widths, "array<double>").asNondeterministic()
    found = kernel(*(F.when(lane, F.col(c)) for c in ("polyline", "left_boundary", "right_boundary")))
    return elements.withColumn("_width", found).withColumn("width", F.when(lane, F.col("_width")).otherwise(F.col("width"))).drop("_width")


def lane_lengths(elements: DataFrame) -> DataFrame:
    """``length`` and ``cum_length`` of lanes, in space."""
    lane = is_lane() & F.col("polyline").isNotNull()
    out = elements.withColumn("cum_length", F.when(lane, P.arc(F.col("polyline"))).otherwise(F.col("cum_length")))
    return out.withColumn("length", F.when(lane, F.coalesce(F.element_at("cum_length", -1), F.lit(0.0))).otherwise(F.col("length")))


def drivable(elements: DataFrame) -> DataFrame:
    """Lanes that routes use, with at least a vertex."""
    return elements.filter(F.col("type").isin(*DRIVABLE) & (F.size("polyline") > 0))
