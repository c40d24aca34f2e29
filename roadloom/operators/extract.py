"""From recorded scenes and raw maps to scenario tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import points as P
from ..schema import AGENT_LABELS, EDGE_KINDS, LANE_KINDS, LIGHT_STATES, LIGHT_STATUS, LINE_KINDS, MISC_TYPES, OBJECT_LABELS, ZONE_KINDS, Scenarios, code
from .tracks import nested, scaffold, velocity_fill

KEY = "scenario_id"
#: Distance from the ego's path within which map objects are kept, in metres. Fixed value.
CORRIDOR = 250.0
#: Segments of a path that are held against an object together, and the slack in metres with which rounding can't decide. Fixed values.
PIECE, SLACK = 8, 1.0
#: Layers that a map is read from. Fixed values.
LAYERS = ("lane", "road_line", "road_edge", "crosswalk", "stop_zone")
_NO_POINTS = "array<struct<x:double,y:double,z:double>>"


def scenes(df: DataFrame, *, datasets=None, split_types=None, split_names=None, log_names=None, scene_uuids=None, dt: float = 0.1, duration: float | None = None, limit: int | None = None) -> DataFrame:
    """Scenes (dataset, split_type, split_name, log_name, scene_uuid, dt, duration_s, modalities) that pass all filters given and hold box detections; the first ``limit`` by log and uuid."""
    keep = F.exists("modalities", lambda m: m.startswith("box_detections_se3")) & (F.abs(F.col("dt") - dt) < 1e-9)
    for c, values in (("dataset", datasets), ("split_type", split_types), ("split_name", split_names), ("log_name", log_names), ("scene_uuid", scene_uuids)):
        if values:
            keep &= F.col(c).isin(list(values))
    if duration is not None:
        keep &= F.col("duration_s") >= duration
    out = df.filter(keep)
    return out if limit is None else out.orderBy("log_name", "scene_uuid").limit(limit)


def maps(paths: DataFrame, datasets: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Map files (column path) that end in .arrow, in order of their path; a dataset must be one of the path's parts."""
    out = paths.filter(F.col("path").endswith(".arrow"))
    if datasets:
        out = out.filter(F.arrays_overlap(F.split("path", "/"), F.array(*map(F.lit, datasets))))
    out = out.orderBy("path")
    return out if limit is None else out.limit(limit)


def scenario_name(column: str) -> Column:
    """A scene's name by a field; the location where the field is missing."""
    return F.coalesce(F.col(column), F.col("location"))


def centroids(ego: DataFrame, vertices: DataFrame, scenarios: DataFrame) -> DataFrame:
    """cx, cy, cz of each scenario: the ego's mean position, else that of routable lanes' vertices, else the origin."""
    a = ego.groupBy(KEY).agg(*(F.avg(c).alias(f"a{c}") for c in "xyz"))
    b = vertices.groupBy(KEY).agg(*(F.avg(c).alias(f"b{c}") for c in "xyz"))
    out = scenarios.select(KEY).distinct().join(a, KEY, "left").join(b, KEY, "left")
    return out.select(KEY, *(F.coalesce(f"a{c}", f"b{c}", F.lit(0.0)).alias(f"c{c}") for c in "xyz"))


def track_ids(detections: DataFrame) -> DataFrame:
    """Ids from 1 of each token in order of first sight (frame, then place in the frame), and the label of that sight; the ego is 0 and has no token."""
    at = F.struct("t", "place")
    first = detections.groupBy(KEY, "token").agg(F.min(at).alias("at"), F.min_by("label", at).alias("label"))
    return first.withColumn("track_id", F.row_number().over(Window.partitionBy(KEY).orderBy("at"))).select(KEY, "token", "track_id", "label")


def poses(frames: DataFrame, centre: DataFrame) -> DataFrame:
    """Frames about the scenario's centre, on the ground (z less half the height), valid."""
    out = frames.join(centre, KEY)
    z = F.col("z") - F.col("cz") - F.col("height") / 2
    return out.withColumns({"x": F.col("x") - F.col("cx"), "y": F.col("y") - F.col("cy"), "z": z, "valid": F.lit(1)}).drop("cx", "cy", "cz")


def states(ego: DataFrame, detections: DataFrame, centre: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Flat states of all tracks, and (scenario_id, track_id, label, token); of two sights of a token in a frame the later one counts."""
    own = [KEY, "t", "x", "y", "z", "heading", "length", "width", "height", "vx", "vy"]
    ids = track_ids(detections)
    last = F.row_number().over(Window.partitionBy(KEY, "token", "t").orderBy(F.desc("place")))
    # a later sight without velocity leaves that of the earlier one
    seen = F.max_by(F.when(F.col("vx").isNotNull(), F.struct("vx", "vy")), F.when(F.col("vx").isNotNull(), F.col("place"))).over(Window.partitionBy(KEY, "token", "t"))
    d = detections.withColumn("_v", seen).withColumn("_k", last).filter("_k = 1").withColumns({"vx": F.col("_v.vx"), "vy": F.col("_v.vy")})
    others = d.join(ids.select(KEY, "token", "track_id"), [KEY, "token"]).select(*own, "track_id")
    all_ = poses(ego.select(*own, F.lit(0).alias("track_id")).unionByName(others), centre)
    labels = ego.select(KEY).distinct().select(KEY, F.lit(None).cast("string").alias("token"), F.lit(0).alias("track_id"), F.lit("ego").alias("label"))
    return all_, labels.unionByName(ids.select(KEY, "token", "track_id", "label"))


def split_labels(labels: DataFrame) -> DataFrame:
    """``labels`` with kind and type: agents, objects, or null for labels of neither."""
    agent, thing = code("label", AGENT_LABELS), code("label", OBJECT_LABELS)
    return labels.withColumns({"kind": F.when(agent.isNotNull(), "agent").when(thing.isNotNull(), "object"), "type": F.coalesce(agent, thing)})


def targets(indices: DataFrame, tokens: DataFrame, labelled: DataFrame) -> DataFrame:
    """Agents that a list names by track index: ``indices`` (list, place, track_index), ``tokens`` (track_index, token); in the list's order, unknown ones left out."""
    agents = labelled.filter("kind = 'agent'").select(KEY, "token", F.col("track_id").cast("long").alias("track_id"))
    hit = indices.join(tokens, [KEY, "track_index"]).join(agents, [KEY, "token"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("place", "track_id"))), lambda s: s["track_id"])
    return hit.groupBy(KEY, "list").agg(ordered.alias("ids"))


def lights(detections: DataFrame, lanes: DataFrame, scenarios: DataFrame, centre: DataFrame) -> DataFrame:
    """A light per lane that is in the map and has a centre line: position of the line's start, and a state per frame, UNKNOWN where none is seen; the last of a frame counts. Lights are numbered by first sight, then lane."""
    known = lanes.filter(F.size("polyline") > 0).select(KEY, F.col("element_id").alias("lane_id"), F.get("polyline", F.lit(0)).alias("start"))
    d = detections.join(known, [KEY, "lane_id"]).withColumn("state", F.coalesce(code("status", LIGHT_STATUS), F.lit(LIGHT_STATES["unknown"])))
    per = d.groupBy(KEY, "lane_id", "t").agg(F.max_by("state", "place").alias("state"), F.min("place").alias("place"), F.first("start").alias("start"))
    seen = F.map_from_entries(F.collect_list(F.struct("t", "state")))
    out = per.groupBy(KEY, "lane_id").agg(seen.alias("seen"), F.min(F.struct("t", "place")).alias("at"), F.first("start").alias("start")).join(scenarios.select(KEY, "scenario_length"), KEY).join(centre, KEY)
    each = F.transform(F.sequence(F.lit(0), F.col("scenario_length") - 1), lambda t: F.coalesce(F.try_element_at("seen", t), F.lit(LIGHT_STATES["unknown"])))
    place = F.struct(*((F.col(f"start.{c}") - F.col(f"c{c}")).alias(c) for c in "xyz"))
    seq = (F.row_number().over(Window.partitionBy(KEY).orderBy("at", "lane_id")) - 1).cast("int")
    return out.select(KEY, F.col("lane_id").alias("light_id"), seq.alias("seq"), place.alias("position"), each.alias("states"), F.col("lane_id").alias("controlled_lane"))


def speed_limit(c: Column) -> Column:
    """The limit, -1 where it is unknown, 0 or no number."""
    return F.when(c.isNull() | (c == 0) | F.isnan(c), -1.0).otherwise(c.cast("double"))


def id_list(c: Column) -> Column:
    """A list of the id, empty for none."""
    return F.array_compact(F.array(c.cast("long")))


def routable(has_groups: Column) -> Column:
    """Lanes to drive on: never shoulders; undefined ones only with a group, where the map has groups."""
    kind = F.lower("lane_type")
    return (kind != "shoulder") & ((kind != "undefined") | ~has_groups | F.col("lane_group_id").isNotNull())


def centred(points: Column) -> Column:
    """Points less the centre."""
    return F.transform(points, lambda p: F.struct(*((p[c] - F.col(f"c{c}")).alias(c) for c in "xyz")))


def in_corridor(geometry: Column, path: Column, reach: float = CORRIDOR) -> Column:
    """Whether a vertex of an object is within ``reach`` of the ego's path, or a vertex of the path of the object's line."""
    near = lambda line, p: F.coalesce(P.to_line(line, p), F.array_min(F.transform(line, lambda q: P.distance(p, q, P.PLANE))))
    return F.exists(geometry, lambda p: near(path, p) <= reach) | F.exists(path, lambda p: near(geometry, p) <= reach)


def _box(points: Column) -> Column:
    """Least and greatest x and y of points."""
    return F.struct(*(f(points[c]).alias(n + c) for c in "xy" for n, f in (("lo_", F.array_min), ("hi_", F.array_max))))


def _apart(a: Column, b: Column, reach: float) -> Column:
    """Whether two boxes are further apart than ``reach`` in x or in y; a box without a place isn't."""
    gap = lambda c: F.greatest(a[f"lo_{c}"] - b[f"hi_{c}"], b[f"lo_{c}"] - a[f"hi_{c}"])
    over = lambda d: F.coalesce((d > reach) & ~F.isnan(d), F.lit(False))
    return over(gap("x")) | over(gap("y"))


def corridor(objects: DataFrame, paths: DataFrame, reach: float = CORRIDOR) -> DataFrame:
    """``objects`` (scenario_id, points, ...) that are ``in_corridor`` of their scenario's path (scenario_id, path).

    The path is cut into pieces that share their ends. Objects clearly out of reach by their boxes, and those with a vertex
    clearly within reach of one of the path, are settled without distances to segments; only the rest are measured, piece by piece.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("path") - 2, F.lit(0)), F.lit(PIECE))
    pieces = F.transform(starts, lambda i: F.slice("path", i + 1, PIECE + 1))
    pieces = F.transform(pieces, lambda p: F.struct(p.alias("line"), _box(p).alias("box")))
    size = F.size("path")
    marks = [F.get("path", k).alias(f"_mark{i}") for i, k in enumerate((F.lit(0), F.floor(size / 2).cast("int"), size - 1))]
    p = paths.filter(size > 0).select(KEY, _box(F.col("path")).alias("_box"), *marks, pieces.alias("_pieces"))
    geometry, box = F.col("points"), _box(F.col("points"))

    close = lambda a, b: F.coalesce(P.distance(a, b, P.PLANE) <= reach - SLACK, F.lit(False))

    def near(piece: Column) -> Column:
        sure = F.exists(geometry, lambda v: close(piece["line"][0], v))
        return ~_apart(box, piece["box"], reach + SLACK) & (sure | in_corridor(geometry, piece["line"], reach))

    # ends of the object against three vertices of the path come first, as they need no lambda
    sure = F.lit(False)
    for i in range(len(marks)):
        for end in (F.lit(0), F.size(geometry) - 1):
            sure = sure | close(F.col(f"_mark{i}"), F.get(geometry, end))
    return objects.join(p, KEY).filter(~_apart(box, F.col("_box"), reach + SLACK) & (sure | F.exists("_pieces", near))).select(*objects.columns)


def raw_elements(objects: DataFrame, centre: DataFrame) -> DataFrame:
    """Lanes, lines, edges and crosswalks of raw map objects (layer, object_id, kind, points, ...) about the scenario's centre; objects of unknown kinds go."""
    layer = F.lower("layer")
    kind = F.when(layer == "lane", code("kind", LANE_KINDS)).when(layer == "road_line", code("kind", LINE_KINDS)).when(layer == "road_edge", code("kind", EDGE_KINDS)).when(layer == "crosswalk", MISC_TYPES["crosswalk"])
    none = F.lit(None).cast(_NO_POINTS)
    out = objects.join(centre, KEY).withColumn("type", kind).filter(layer.isin(*LAYERS[:4]) & F.col("type").isNotNull())
    lane = layer == "lane"
    ids = lambda c: F.when(lane, F.coalesce(c, F.array().cast("array<bigint>"))).otherwise(F.array().cast("array<bigint>")).alias(c)
    return out.select(
        KEY, "object_id", layer.alias("layer"), "type", F.when(layer != "crosswalk", centred(F.col("points"))).otherwise(none).alias("polyline"), F.when(layer == "crosswalk", centred(F.col("points"))).otherwise(none).alias("polygon"),
        F.when(lane, speed_limit(F.col("speed_limit_mps"))).otherwise(-1.0).alias("speed_limit_mps"), ids("entry_lanes"), ids("exit_lanes"),
        F.when(lane, centred(F.col("left_boundary"))).alias("left_boundary"), F.when(lane, centred(F.col("right_boundary"))).alias("right_boundary"),
        F.when(lane, id_list(F.col("left_lane_id"))).otherwise(id_list(F.lit(None))).alias("left_neighbor"), F.when(lane, id_list(F.col("right_lane_id"))).otherwise(id_list(F.lit(None))).alias("right_neighbor"),
        F.when(lane, F.col("lane_group_id")).alias("lane_group_id"), "seq",
    )


def stop_zones(objects: DataFrame, lanes: DataFrame, centre: DataFrame) -> DataFrame:
    """Stop zones of known kinds with the lanes of theirs that are in the map; zones without any go."""
    ids = lanes.groupBy(KEY).agg(F.collect_set("element_id").alias("known"))
    z = objects.filter(F.lower("layer") == "stop_zone").withColumn("type", code("kind", ZONE_KINDS)).filter("type is not null").join(centre, KEY).join(ids, KEY)
    z = z.withColumn("controlled_lanes", F.filter("lane_ids", lambda i: F.array_contains("known", i))).filter(F.size("controlled_lanes") > 0)
    place = (F.row_number().over(Window.partitionBy(KEY).orderBy("seq")) - 1).cast("int")
    known = lambda c, t: F.coalesce(F.col(c), F.lit(-1)).cast(t)
    return z.select(KEY, place.alias("seq"), "type", centred(F.col("points")).alias("polygon"), "controlled_lanes", known("intersection_id", "long").alias("junction_id"), known("phase_idx", "int").alias("phase_idx"))


def number_elements(raw: DataFrame) -> DataFrame:
    """Lanes keep their ids and come first; all other elements are numbered on from the greatest lane id, in order."""
    lane = F.col("layer") == "lane"
    top = F.coalesce(F.max(F.when(lane, F.col("object_id"))).over(Window.partitionBy(KEY)), F.lit(-1))
    order = Window.partitionBy(KEY).orderBy((~lane).cast("int"), "seq")
    out = raw.withColumns({"_top": top, "_place": F.row_number().over(order), "_lanes": F.sum(lane.cast("int")).over(Window.partitionBy(KEY))})
    return out.withColumns({"element_id": F.when(lane, F.col("object_id")).otherwise(F.col("_top") + F.col("_place") - F.col("_lanes")).cast("long"), "seq": (F.col("_place") - 1).cast("int")}).drop("_top", "_place", "_lanes", "object_id")


def junction_lanes(lanes: DataFrame, groups: DataFrame) -> DataFrame:
    """``lanes`` with in_junction: whether a group of theirs (lane_ids, intersection_id) belongs to an intersection."""
    inside = groups.filter("intersection_id is not null").select(KEY, F.explode("lane_ids").alias("element_id")).distinct().withColumn("_in", F.lit(True))
    return lanes.join(inside, [KEY, "element_id"], "left").withColumn("in_junction", F.coalesce("_in", F.lit(False))).drop("_in")


def swap_reversed_refs(lanes: DataFrame) -> DataFrame:
    """Entries that end nearer to a lane's end than to its start become exits and the other way round (distances in space); references outside the lanes go.

    In the order of the lists: entries that stay, then exits that are entries; and likewise for exits, entries first.
    """
    ends = lanes.filter(F.size("polyline") > 0).select(KEY, F.col("element_id").alias("ref"), F.get("polyline", F.lit(0)).alias("rs"), F.element_at("polyline", -1).alias("re"))
    ids = lanes.select(KEY, F.col("element_id").alias("ref"))
    refs = lanes.select(KEY, "element_id", F.get("polyline", F.lit(0)).alias("s"), F.element_at("polyline", -1).alias("e"), F.explode(F.concat(
        F.transform("entry_lanes", lambda r, i: F.struct(F.lit(0).alias("list"), i.alias("place"), r.alias("ref"))), F.transform("exit_lanes", lambda r, i: F.struct(F.lit(1).alias("list"), i.alias("place"), r.alias("ref"))),
    )).alias("r")).select(KEY, "element_id", "s", "e", "r.*").join(ids, [KEY, "ref"], "left_semi").join(ends, [KEY, "ref"], "left")
    swap = F.when(F.col("list") == 0, P.distance(F.col("re"), F.col("s")) > P.distance(F.col("re"), F.col("e"))).otherwise(P.distance(F.col("rs"), F.col("e")) > P.distance(F.col("rs"), F.col("s")))
    refs = refs.withColumn("new", F.when(F.coalesce(swap, F.lit(False)), 1 - F.col("list")).otherwise(F.col("list")))
    # entries are read before exits, so in a new list those from the old entries come first
    pick = lambda k: F.transform(F.array_sort(F.collect_list(F.when(F.col("new") == k, F.struct("list", "place", "ref")))), lambda s: s["ref"])
    new = refs.groupBy(KEY, "element_id").agg(pick(0).alias("_entry"), pick(1).alias("_exit"))
    none = F.array().cast("array<bigint>")
    out = lanes.join(new, [KEY, "element_id"], "left")
    return out.withColumns({"entry_lanes": F.coalesce("_entry", none), "exit_lanes": F.coalesce("_exit", none)}).drop("_entry", "_exit")


def zero_heights(points: str) -> Column:
    """Points on the plane z = 0, for maps without heights."""
    return F.transform(points, lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), F.lit(0.0).alias("z")))


def scenarios(raw: dict[str, DataFrame]) -> Scenarios:
    """Scenario tables from recorded ones.

    ``raw`` has scenes (scenario_id, name, dataset, location, scenario_length, dt, has_z), ego and detections (one row
    per frame and sight), lights (sights), objects (raw map objects) and groups (lane_ids, intersection_id); missing
    tables are empty. Scenes with frames need an ego in each of them and a positive time step; others raise.
    """
    scenes = raw["scenes"]
    short = raw["ego"].groupBy(KEY).agg(F.countDistinct("t").alias("n"))
    bad = scenes.join(short, KEY, "left").filter((F.col("scenario_length") > 0) & ((F.coalesce("n", F.lit(0)) < F.col("scenario_length")) | ~(F.col("dt") > 0)))
    if wrong := [r[KEY] for r in bad.select(KEY).limit(5).collect()]:
        raise ValueError(f"scenes without an ego in every frame or without a time step: {wrong}")
    grouped = F.coalesce(F.exists(F.collect_set(F.col("lane_group_id").isNotNull()).over(Window.partitionBy(KEY)), lambda x: x), F.lit(False))
    objects = raw["objects"].withColumn("_groups", grouped)
    objects = objects.withColumn("lane_type", F.col("kind")).filter((F.lower("layer") != "lane") | routable(F.col("_groups")))
    vertices = objects.filter(F.lower("layer") == "lane").select(KEY, F.explode("points").alias("p")).select(KEY, "p.x", "p.y", "p.z")
    centre = centroids(raw["ego"], vertices, scenes)
    elements = number_elements(raw_elements(objects, centre))
    lanes = junction_lanes(swap_reversed_refs(infer_types(elements.filter(F.col("layer") == "lane"))), raw["groups"])
    rest = elements.filter(F.col("layer") != "lane").withColumn("in_junction", F.lit(False))
    elements = lanes.unionByName(rest, allowMissingColumns=True).drop("layer")
    elements = elements.withColumns({"length": F.lit(0.0), "cum_length": F.lit(None).cast("array<double>"), "width": F.lit(None).cast("array<double>"), "speed_zone_idx": F.lit(-1)})
    ids = lanes.select(KEY, "element_id")
    flat, labels = states(raw["ego"], raw["detections"], centre)
    split = split_labels(labels).filter("kind is not null")
    every = velocity_fill_by_scene(scaffold(flat, scenes), scenes)
    whole = nested(every.withColumn("type", F.lit(0))).drop("type").join(split.select(KEY, F.col("track_id"), "kind", "type"), [KEY, "track_id"])
    none = F.array().cast("array<bigint>")
    tracks = whole.withColumns({"track_id": F.col("track_id").cast("long"), "seq": F.col("track_id").cast("int"), "route": none, "route_gt_len": F.lit(0), "control_state": F.lit(2)})
    raw_lanes = objects.filter(F.lower("layer") == "lane").select(KEY, F.col("object_id").alias("element_id"), F.col("points").alias("polyline"))
    found = lights(raw["lights"], raw_lanes, scenes, centre)
    zones = stop_zones(objects, ids, centre)
    flatten = lambda df, *cols: df.join(scenes.select(KEY, "has_z"), KEY).withColumns({c: F.when(F.col("has_z"), F.col(c)).otherwise(zero_heights(c)) for c in cols}).drop("has_z")
    low = found.join(scenes.select(KEY, "has_z"), KEY).withColumn("position", F.when(F.col("has_z"), F.col("position")).otherwise(F.struct(F.col("position.x").alias("x"), F.col("position.y").alias("y"), F.lit(0.0).alias("z")))).drop("has_z")
    header = scenes.select(KEY, "name", "dataset", "location", "scenario_length", "dt", none.alias("objects_of_interest"), none.alias("tracks_to_predict"))
    return Scenarios(header, flatten(tracks, "position"), flatten(elements, "polyline", "polygon", "left_boundary", "right_boundary"), low, flatten(zones, "polygon"))


def velocity_fill_by_scene(frames: DataFrame, scenes: DataFrame) -> DataFrame:
    """Missing velocities by each scene's own time step."""
    out = velocity_fill(frames, 1.0).join(scenes.select(KEY, "dt"), KEY)
    seen = frames.select(KEY, "track_id", "t", (F.col("vx").isNotNull() & F.col("vy").isNotNull() & ~F.isnan("vx") & ~F.isnan("vy")).alias("_seen"))
    out = out.join(seen, [KEY, "track_id", "t"])
    return out.withColumns({c: F.when(F.col("_seen"), F.col(c)).otherwise(F.col(c) / F.col("dt")) for c in ("vx", "vy")}).drop("_seen", "dt")


def infer_types(lanes: DataFrame) -> DataFrame:
    """Lanes of unknown type take the type of the lanes that they are linked to, if that is one type; in the lanes' order, so that a lane sees what earlier ones took.

    Only scenarios with such lanes go through the kernel; links are taken as they are before any is swapped.
    """
    unknown = LANE_KINDS["undefined"]
    todo = lanes.filter(F.col("type") == unknown).select(KEY).distinct()
    rows = lanes.join(todo, KEY, "left_semi").select(KEY, "element_id", "seq", "type", F.concat("entry_lanes", "exit_lanes").alias("links"))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq", kind="stable")
        types = dict(zip(f["element_id"].tolist(), f["type"].tolist(), strict=True))
        for i, t, links in zip(f["element_id"].tolist(), f["type"].tolist(), f["links"], strict=True):
            if t == unknown:
                near = {types[int(x)] for x in links if int(x) in types}
                types[i] = near.pop() if len(near) == 1 else t
        return pd.DataFrame({KEY: f[KEY], "element_id": f["element_id"], "_type": [types[i] for i in f["element_id"].tolist()]})

    new = rows.groupBy(KEY).applyInPandas(run, f"{KEY} long, element_id long, _type int")
    return lanes.join(new, [KEY, "element_id"], "left").withColumn("type", F.coalesce("_type", "type")).drop("_type")
