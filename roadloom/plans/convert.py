"""The stages of a conversion in their order, and its bookkeeping."""

from __future__ import annotations

import dataclasses
import tomllib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import controls, elements, graph, overlap, refs, routes, shoulders, signals, validation, zones
from ..schema import Scenarios

Stage = Callable[[Scenarios, "Config"], Scenarios]


@dataclasses.dataclass(frozen=True)
class Config:
    """What a conversion is asked to do; a preset's values are defaults that arguments override."""

    datasets: tuple[str, ...] | None = None
    num_scenes: int | None = None
    scenario_id_field: str = "scene_uuid"
    duration_s: float = 0.0
    dt: float = 0.1
    map_only: bool = False
    validate_level: int = 1
    max_segment_length: float = 10.0
    area_threshold: float = 0.1
    min_route_valid_points: float = 0.0
    route_check_timestep: int = 0
    interpolate_tl: bool = False
    non_drivable_shoulders: bool = False
    ramp_widening_m: float = 0.0
    reverse_road_edges: bool = False
    invalid_agent_overlap: bool = False
    no_speed_zones: bool = False
    min_zone_extent_m: float = 100.0
    opposite_gap_m: float = 8.0
    no_reindex: bool = False
    emit_metadata: bool = False

    def __post_init__(self):
        if self.scenario_id_field not in ("scene_uuid", "log_name", "location"):
            raise ValueError(f"no such field: {self.scenario_id_field}")
        if self.validate_level not in (0, 1, 2):
            raise ValueError(f"validate_level is 0, 1 or 2, not {self.validate_level}")
        if not 0 <= self.min_route_valid_points <= 100 or self.route_check_timestep < 0:
            raise ValueError("min_route_valid_points is a percentage, route_check_timestep a frame")


def configured(preset: str | None = None, presets: str = "", **arguments) -> Config:
    """A configuration from a preset of a TOML text and arguments, which override it."""
    known = {f.name for f in dataclasses.fields(Config)}
    values = {}
    if preset:
        tables = tomllib.loads(presets)
        if preset not in tables:
            raise ValueError(f"unknown preset {preset}; known are {sorted(tables)}")
        values = dict(tables[preset])
        if unknown := sorted(set(values) - known):
            raise ValueError(f"preset {preset} has unknown keys: {unknown}")
    return Config(**values | arguments)


def _lights(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, lights=signals.interpolate(s.lights, s.elements, s.tracks, s.header))


def _shoulders(s: Scenarios, c: Config) -> Scenarios:
    return s if s.surfaces is None else dataclasses.replace(s, elements=shoulders.shoulder_edges(s.elements, s.surfaces, c.ramp_widening_m))


def _polylines(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, elements=elements.process_polylines(s.elements, c.max_segment_length, c.area_threshold))


def _polygons(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, elements=elements.close_polygons(s.elements))


def _reversed(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, elements=elements.reverse_edges(s.elements))


def _pruned(s: Scenarios, c: Config) -> Scenarios:
    return refs.prune(s)


def _controls(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, controls=controls.traffic_controls(s))


def _routes(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, tracks=routes.agent_routes(s.tracks, s.elements, s.header, c.min_route_valid_points, c.route_check_timestep))


def _overlaps(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, tracks=overlap.invalidate(s.tracks))


def _zones(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, elements=zones.speed_zones(s.elements, c.min_zone_extent_m, c.opposite_gap_m))


def _widths(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, elements=elements.lane_widths(s.elements))


def _lengths(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, elements=elements.lane_lengths(s.elements))


def _graph(s: Scenarios, c: Config) -> Scenarios:
    return dataclasses.replace(s, distances=graph.lane_distances(s.elements))


def _dense(s: Scenarios, c: Config) -> Scenarios:
    return refs.reindex(s)


def stages(c: Config) -> list[Stage]:
    """The stages that a configuration asks for, in order."""
    chosen = [
        (c.interpolate_tl, _lights), (c.non_drivable_shoulders, _shoulders), (c.reverse_road_edges, _reversed), (True, _polylines), (True, _polygons), (True, _pruned), (True, _controls), (True, _routes), (c.invalid_agent_overlap, _overlaps),
        (not c.no_speed_zones, _zones), (True, _widths), (True, _lengths), (True, _graph), (not c.no_reindex, _dense),
    ]
    return [stage for wanted, stage in chosen if wanted]


def run(s: Scenarios, c: Config) -> Scenarios:
    """All stages one after another; lazy until a table is read or written."""
    for stage in stages(c):
        s = stage(s, c)
    return s


def checked(s: Scenarios, c: Config) -> tuple[Scenarios, DataFrame]:
    """Scenarios that pass validation, and (scenario_id, error) of the others: one bad scenario does not stop the rest."""
    errors = validation.report(s, c.validate_level)
    bad = errors.groupBy("scenario_id").agg(F.concat(F.lit("Validation failed with "), F.count("*").cast("string"), F.lit(" errors: "), F.array_join(F.array_sort(F.collect_list("error")), "; ")).alias("error"))
    ids = bad.select("scenario_id")
    left = lambda t: None if t is None else t.join(ids, "scenario_id", "left_anti")
    return Scenarios(**{f.name: left(getattr(s, f.name)) for f in dataclasses.fields(s)}), bad


def safe(c: Column) -> Column:
    """A file name's part of letters, digits, dots, dashes and underlines."""
    part = F.regexp_replace(F.regexp_replace(F.trim(c), "[^A-Za-z0-9._-]+", "_"), "^[._-]+|[._-]+$", "")
    return F.when(F.length(part) > 0, part).otherwise("scenario")


def output_names(scenes: DataFrame, field: str = "scene_uuid") -> DataFrame:
    """``scenes`` with ``path``: data set, name and uuid joined by two underlines; maps without uuid by their location. A missing part is null."""
    own = F.coalesce(F.nullif(F.col(field), F.lit("")), F.nullif(F.col("location"), F.lit("")))
    parts = [safe(F.col("dataset")), safe(F.col("scene_uuid"))] if field == "scene_uuid" else [safe(F.col("dataset")), safe(own), safe(F.col("scene_uuid"))]
    scene = F.concat_ws("__", *parts)
    of_map = F.concat_ws("__", safe(F.col("dataset")), safe(F.col("location")))
    name = F.when(F.coalesce(F.col("scene_uuid"), F.lit("")) == "", of_map).otherwise(scene)
    return scenes.withColumn("path", F.when(F.coalesce(F.col("dataset"), F.lit("")) != "", F.concat(name, F.lit(".bin"))))


def duplicate_names(names: DataFrame) -> DataFrame:
    """Paths that more than one scenario would be written to."""
    return names.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")


def metadata(s: Scenarios, names: DataFrame, centre: DataFrame) -> DataFrame:
    """One row per scenario of what its consumers need: file, name, data set, length, step and centre."""
    out = s.header.join(names.select("scenario_id", F.col("path").alias("bin_path")), "scenario_id").join(centre, "scenario_id", "left")
    return out.select("bin_path", F.col("name").alias("scenario_id"), "dataset", "scenario_length", "dt", F.array("cx", "cy", "cz").alias("centroid"))


def exit_code(found: int, converted: int) -> int:
    """0 if anything was converted or nothing found."""
    return 0 if converted or not found else 1
