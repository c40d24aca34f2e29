"""Tables of driving scenarios: enums, type predicates and schemas.

A scenario is a bundle of tables that share ``scenario_id``; ``seq`` carries an entity's place in its scenario, since
order is part of the data model. Points are arrays of (x, y, z).
"""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Codes of types and states.
AGENT_TYPES = {"other": 0, "vehicle": 1, "pedestrian": 2, "cyclist": 3}
CONTROL_STATES = {"controllable": 0, "non_controllable_moving": 1, "non_controllable_static": 2}
LANE_TYPES = {"unknown": 0, "freeway": 1, "surface_street": 2, "bike_lane": 3, "bus_lane": 4}
LINE_TYPES = {"unknown": 10, "broken_single_white": 11, "solid_single_white": 12, "solid_double_white": 13, "broken_single_yellow": 14, "broken_double_yellow": 15, "solid_single_yellow": 16, "solid_double_yellow": 17, "passing_double_yellow": 18}
EDGE_TYPES = {"unknown": 20, "boundary": 21, "median": 22}
MISC_TYPES = {"unknown": 30, "crosswalk": 31, "speed_bump": 32}
LIGHT_STATES = {"unknown": 0, "red": 1, "yellow": 2, "green": 3, "off": 4}
CONTROL_TYPES = {"traffic_light": 1, "stop_sign": 2, "yield_sign": 3}
OBJECT_TYPES = {"traffic_sign": 1, "traffic_cone": 2, "traffic_light": 3, "barrier": 4, "generic_object": 5}

# Source labels and kinds to codes.
AGENT_LABELS = {"ego": 1, "vehicle": 1, "train": 0, "person": 2, "two_wheeler": 3, "animal": 0, "other": 0, "generic_object": 0}
OBJECT_LABELS = {"traffic_sign": 1, "traffic_cone": 2, "traffic_light": 3, "barrier": 4}
LANE_KINDS = {"undefined": 0, "freeway": 1, "surface_street": 2, "bike_lane": 3, "bus_lane": 4}
LINE_KINDS = {
    "none": 10, "unknown": 10, "dashed_white": 11, "solid_white": 12, "double_solid_white": 13, "dashed_yellow": 14, "double_dash_yellow": 15, "solid_yellow": 16,
    "double_solid_yellow": 17, "dash_solid_yellow": 18, "solid_dash_yellow": 18, "double_dash_white": 11, "dash_solid_white": 12, "solid_dash_white": 12, "solid_blue": 12,
}
EDGE_KINDS = {"unknown": 20, "road_edge_boundary": 21, "road_edge_median": 22}
ZONE_KINDS = {"traffic_light": 1, "stop_sign": 2, "yield_sign": 3, "turn_stop": 2}
LIGHT_STATUS = {"green": 3, "yellow": 2, "red": 1, "off": 4, "unknown": 0}

#: Types of lanes that routes and the lane graph use.
DRIVABLE = (LANE_TYPES["freeway"], LANE_TYPES["surface_street"])
#: Lists of lanes that a map element refers to.
REFS = ("entry_lanes", "exit_lanes", "left_neighbor", "right_neighbor")

POINTS = "array<struct<x:double,y:double,z:double>>"
SCENARIO = "scenario_id long, name string, dataset string, location string, scenario_length int, dt double, objects_of_interest array<bigint>, tracks_to_predict array<bigint>"
TRACK = (
    f"scenario_id long, kind string, track_id long, seq int, type int, position {POINTS}, heading array<double>, velocity array<struct<x:double,y:double>>, valid array<int>, "
    "length array<double>, width array<double>, height array<double>, route array<bigint>, route_gt_len int, control_state int"
)
ELEMENT = (
    f"scenario_id long, element_id long, seq int, type int, polyline {POINTS}, polygon {POINTS}, speed_limit_mps double, entry_lanes array<bigint>, exit_lanes array<bigint>, "
    f"left_boundary {POINTS}, right_boundary {POINTS}, left_neighbor array<bigint>, right_neighbor array<bigint>, length double, cum_length array<double>, width array<double>, "
    "lane_group_id long, in_junction boolean, speed_zone_idx int"
)
LIGHT = "scenario_id long, light_id long, seq int, position struct<x:double,y:double,z:double>, states array<int>, controlled_lane long"
ZONE = f"scenario_id long, seq int, type int, polygon {POINTS}, controlled_lanes array<bigint>, junction_id long, phase_idx int"
SURFACE = f"scenario_id long, kind string, seq int, outline {POINTS}"
CONTROL = f"scenario_id long, control_id long, seq int, type int, controlled_lanes array<bigint>, stop_line {POINTS}, heading double, states array<int>, junction_id long, phase_idx int"
DISTANCE = "scenario_id long, src long, dst long, src_pos int, dst_pos int, distance double"


@dataclasses.dataclass(frozen=True)
class Scenarios:
    """The tables of many scenarios; ``lights``, ``zones`` and ``surfaces`` are side tables of extraction."""

    header: DataFrame
    tracks: DataFrame
    elements: DataFrame
    lights: DataFrame | None = None
    zones: DataFrame | None = None
    surfaces: DataFrame | None = None
    controls: DataFrame | None = None
    distances: DataFrame | None = None


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_lane(c: str | Column = "type") -> Column:
    """Types 0 to 9."""
    return _col(c).between(0, 9)


def is_line(c: str | Column = "type") -> Column:
    """Types 10 to 19."""
    return _col(c).between(10, 19)


def is_edge(c: str | Column = "type") -> Column:
    """Types 20 to 29."""
    return _col(c).between(20, 29)


def is_yellow_line(c: str | Column = "type") -> Column:
    """Any of the yellow lines."""
    return _col(c).isin([v for k, v in LINE_TYPES.items() if "yellow" in k])


def is_broken_line(c: str | Column = "type") -> Column:
    """The single broken lines."""
    return _col(c).isin(LINE_TYPES["broken_single_white"], LINE_TYPES["broken_single_yellow"])


def is_crosswalk(c: str | Column = "type") -> Column:
    """Crosswalks."""
    return _col(c) == MISC_TYPES["crosswalk"]


def uses_polyline(c: str | Column = "type") -> Column:
    """Lanes, lines and edges; all others are polygons."""
    return _col(c).between(0, 29)


def geometry(c: str | Column = "type") -> Column:
    """The element's own geometry."""
    return F.when(uses_polyline(c), F.col("polyline")).otherwise(F.col("polygon"))


def min_points(c: str | Column = "type") -> Column:
    """Points that an element needs."""
    return F.when(uses_polyline(c), 2).otherwise(3)


def code(c: str | Column, codes: dict[str, int]) -> Column:
    """The code of a lower-cased name, null if unknown; the dictionary is a literal, no join."""
    pairs = [x for k, v in codes.items() for x in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), F.lower(_col(c)))


def name(c: str | Column, codes: dict[str, int]) -> Column:
    """The first name of a code."""
    first = {v: k for k, v in reversed(codes.items())}
    pairs = [x for v, k in first.items() for x in (F.lit(v), F.lit(k))]
    return F.try_element_at(F.create_map(*pairs), _col(c).cast("int"))


def type_name(c: str | Column = "type") -> Column:
    """Name of a map element's type."""
    return F.coalesce(*(name(c, t) for t in (LANE_TYPES, LINE_TYPES, EDGE_TYPES, MISC_TYPES)))
