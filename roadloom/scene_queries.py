"""Queries over whole scenes seen through the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom import schema
from roadloom.functions import points as P
from roadloom.operators import controls, elements, extract, overlap, refs, routes, signals, tracks, validation, viewer, zones
from roadloom.plans import convert
from roadloom.sources import bridge
from roadloom.sources.bridge import STATES_SQL, VERTICES_SQL

KEY = "scenario_id"


def _table(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def _round(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + 0.0 for c in columns})


def _agents(s: SparkSession, d: str) -> DataFrame:
    return tracks.nested(bridge.track_states(s, d)).withColumn("kind", F.lit("agent"))


def _lengths(s: SparkSession, d: str) -> DataFrame:
    n = bridge.track_states(s, d).groupBy(KEY).agg((F.max("t") + 1).alias("scenario_length"))
    return n.withColumn("dt", F.lit(0.1))


def _map(s: SparkSession, d: str) -> DataFrame:
    """Elements with polyline or polygon, and lane boundaries beside the line."""
    e = bridge.elements(s, d).withColumn("lined", schema.uses_polyline())
    beside = lambda sign: F.transform("points", lambda p: F.struct(p["x"].alias("x"), (p["y"] + sign * 1.75 + sign * p["x"] / 100).alias("y"), p["z"].alias("z")))
    none = F.array().cast("array<bigint>")
    return e.select(
        KEY, "element_id", F.col("element_id").cast("int").alias("seq"), "type", F.when(F.col("lined"), F.col("points")).alias("polyline"), F.when(~F.col("lined"), F.col("points")).alias("polygon"),
        "entry_lanes", "exit_lanes", none.alias("left_neighbor"), none.alias("right_neighbor"), beside(1).alias("left_boundary"), beside(-1).alias("right_boundary"),
        F.lit(None).cast("array<double>").alias("width"), F.lit(None).cast("array<double>").alias("cum_length"), F.lit(0.0).alias("length"),
    )


def validate_dynamic(s: SparkSession, d: str) -> DataFrame:
    """Tracks that are shorter than their scenario."""
    return validation.dynamic_states(_agents(s, d), _lengths(s, d))


def validate_sizes(s: SparkSession, d: str) -> DataFrame:
    """Tracks without height in a valid frame."""
    return validation.sizes(_agents(s, d))


def validate_refs(s: SparkSession, d: str) -> DataFrame:
    """Links to what is no lane."""
    return validation.lane_refs(_map(s, d))


def edge_z_overlap(s: SparkSession, d: str) -> DataFrame:
    """Edges that cross at different heights; the bridge's heights are taken tenfold."""
    e = _map(s, d).withColumn("polyline", F.transform("polyline", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (p["z"] * 10).alias("z"))))
    return _round(validation.edge_crossings(e), "dz")


def ring_close_densify(s: SparkSession, d: str) -> DataFrame:
    """Closed and densified polygons."""
    e = elements.close_polygons(_map(s, d)).filter("polygon is not null")
    return _round(e.select(KEY, "element_id", F.posexplode("polygon").alias("k", "p")).select(KEY, "element_id", "k", "p.x", "p.y", "p.z"), "x", "y", "z")


def lane_widths(s: SparkSession, d: str) -> DataFrame:
    """Widths of lanes at their vertices."""
    e = elements.lane_widths(_map(s, d).filter(schema.is_lane()))
    return _round(e.select(KEY, "element_id", F.posexplode("width").alias("pt", "width")), "width")


def lane_lengths(s: SparkSession, d: str) -> DataFrame:
    """Lengths of lanes in space."""
    return _round(elements.lane_lengths(_map(s, d)).filter(schema.is_lane()).select(KEY, "element_id", "length"), "length")


def heading_circular_mean(s: SparkSession, d: str) -> DataFrame:
    """Headings into lanes."""
    e = controls.incoming_heading(_map(s, d).filter(schema.is_lane())).filter("heading is not null")
    return _round(e.select(KEY, "element_id", "heading"), "heading")


def stop_line_cut(s: SparkSession, d: str) -> DataFrame:
    """Cuts of a box around the first vertex of each element across a heading of its own."""
    v = bridge.vertices(s, d).filter("pt = 0")
    at = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"), F.col("z").alias("z"))
    box = F.array(at(-2, -3), at(2, -3), at(2, 3), at(-2, 3))
    line = controls.line_across(box, (F.col("element_id") % 7) / 2 + 0.1)
    out = v.select(KEY, "element_id", line.alias("l")).select(KEY, "element_id", *((F.col("l")[k][c]).alias(f"{c}{k}") for k in (0, 1) for c in "xy"))
    return _round(out, "x0", "y0", "x1", "y1")


def control_state(s: SparkSession, d: str) -> DataFrame:
    """Control states of tracks; every fifth is taken for routed."""
    states = bridge.track_states(s, d)
    return routes.control_states(states, states.filter("track_id % 5 = 0"))


def lane_paths_3hop(s: SparkSession, d: str) -> DataFrame:
    """Paths of up to three links between lanes."""
    e = elements.drivable(_map(s, d))
    links = e.select(KEY, "element_id", F.posexplode("exit_lanes").alias("ordinal", "exit_id")).join(e.select(KEY, F.col("element_id").alias("exit_id")), [KEY, "exit_id"], "left_semi")
    out = routes.lane_paths(links)
    return out.select(KEY, "src", "dst", "hops", F.array_join(F.transform("path", lambda x: x.cast("string")), ">").alias("path"))


def zone_extent(s: SparkSession, d: str) -> DataFrame:
    """Extents of groups of lanes."""
    v = bridge.vertices(s, d)
    members = v.select(KEY, "element_id", F.floor(F.col("element_id") / 100).alias("zone")).distinct()
    return _round(zones.extents(v.select(KEY, "element_id", "x", "y"), members), "extent")


def agent_overlap(s: SparkSession, d: str) -> DataFrame:
    """Tracks that touch one of every third track, boxes two metres wider."""
    return overlap.overlapping(bridge.track_states(s, d).withColumn("width", F.col("width") + 2), F.col("track_id") % 3 == 0)


def junction_lanes(s: SparkSession, d: str) -> DataFrame:
    """Lanes of groups of ten orders of which every third lies in an intersection."""
    v = bridge.vertices(s, d).filter(schema.is_lane()).select(KEY, "element_id").distinct()
    group = F.floor(F.col("element_id") / 10)
    g = v.groupBy(KEY, group.alias("g")).agg(F.collect_list("element_id").alias("lane_ids")).withColumn("intersection_id", F.when(F.col("g") % 3 == 0, F.col("g")))
    return extract.junction_lanes(v, g)


def light_state_pivot(s: SparkSession, d: str) -> DataFrame:
    """A light on each user's lane, from its events; the map is taken by scenarios of 20 elements."""
    status = F.expr("case event_type when 'view' then 'green' when 'click' then 'red' when 'purchase' then 'yellow' else 'odd' end")
    states = bridge.track_states(s, d)
    seen = states.select(KEY, F.col("track_id").alias("lane_id"), "t", F.lit(0).alias("place"), F.expr("label as event_type")).withColumn("status", status)
    lanes = bridge.elements(s, d).select(F.floor(F.col("element_id") / bridge.USERS).alias(KEY), "element_id", F.col("points").alias("polyline"))
    centre = seen.select(KEY).distinct().select(KEY, *(F.lit(0.0).alias(f"c{c}") for c in "xyz"))
    out = extract.lights(seen, lanes, _lengths(s, d), centre)
    return out.select(KEY, "light_id", "seq", F.array_join(F.transform("states", lambda x: x.cast("string")), "").alias("states"))


def corridor_map_filter(s: SparkSession, d: str) -> DataFrame:
    """Elements near the path of the first track of their scenario."""
    states = bridge.track_states(s, d)
    first = states.groupBy(KEY).agg(F.min("track_id").alias("track_id"))
    path = F.transform(F.array_sort(F.collect_list(F.struct("t", "x", "y", "z"))), lambda p: F.struct(p["x"], p["y"], p["z"]))
    ego = states.join(first, [KEY, "track_id"], "left_semi").groupBy(KEY).agg(path.alias("path"))
    return extract.corridor(bridge.elements(s, d), ego).select(KEY, "element_id")


def topology_swap_refs(s: SparkSession, d: str) -> DataFrame:
    """Links whose ends tell that they point the other way."""
    e = extract.swap_reversed_refs(_map(s, d).filter(schema.is_lane()))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return e.select(KEY, "element_id", text("entry_lanes"), text("exit_lanes"))


def prune_map(s: SparkSession, d: str) -> DataFrame:
    """Elements with enough points, and their links to such elements."""
    none = s.createDataFrame([], schema.TRACK)
    kept = refs.prune(schema.Scenarios(s.createDataFrame([], schema.SCENARIO), none, _map(s, d))).elements
    text = F.array_join(F.transform("exit_lanes", lambda x: x.cast("string")), ",")
    return kept.select(KEY, "element_id", "type", text.alias("exit_lanes"))


def scene_filter(s: SparkSession, d: str) -> DataFrame:
    """Scenes of two sets, three types and a least duration."""
    o = _table(s, d, "orders")
    scenes = o.select(
        F.col("o_orderpriority").alias("dataset"), F.col("o_orderstatus").alias("split_type"), F.lit("s").alias("split_name"), (F.col("o_custkey") % 100).cast("string").alias("log_name"),
        F.col("o_orderkey").cast("string").alias("scene_uuid"), F.lit(0.1).alias("dt"), (F.col("o_orderkey") % 30).cast("double").alias("duration_s"),
        F.when(F.col("o_orderkey") % 4 > 0, F.array(F.lit("box_detections_se3.lidar"))).otherwise(F.array(F.lit("camera"))).alias("modalities"),
    )
    return extract.scenes(scenes, datasets=["1-URGENT", "2-HIGH"], split_types=["O", "F"], duration=10.0).select("dataset", "split_type", "log_name", "scene_uuid", "duration_s")


def map_discovery_topn(s: SparkSession, d: str) -> DataFrame:
    """The first hundred maps of a set by path."""
    o = _table(s, d, "orders")
    path = F.concat(F.lit("/maps/"), F.col("o_orderpriority"), F.lit("/m"), F.col("o_orderkey").cast("string"), F.when(F.col("o_orderkey") % 3 == 0, ".txt").otherwise(".arrow"))
    return extract.maps(o.select(path.alias("path")), ["1-URGENT"], 100)


def name_search(s: SparkSession, d: str) -> DataFrame:
    """Scenarios named by customers, by part of the name."""
    c = _table(s, d, "customer")
    return viewer.search_names(c.select(F.col("c_custkey").alias(KEY), F.concat(F.lit("Town "), F.col("c_custkey").cast("string")).alias("name")), "N 1")


def element_layers(s: SparkSession, d: str) -> DataFrame:
    """Elements of each drawing layer."""
    return viewer.layers(bridge.vertices(s, d).select(KEY, "element_id", "type").distinct())


def state_table(s: SparkSession, d: str) -> DataFrame:
    """The first frames of tracks with speed and heading in degrees."""
    out = viewer.state_rows(bridge.track_states(s, d).filter("vx is not null"))
    return _round(out.select(KEY, "track_id", "t", "speed", "degrees"), "speed", "degrees")


def line_marks(s: SparkSession, d: str) -> DataFrame:
    """Marks along lanes every three metres."""
    e = bridge.elements(s, d).filter(schema.is_lane()).select(KEY, "element_id", F.posexplode(viewer.marks(F.col("points"))).alias("k", "m"))
    return _round(e.select(KEY, "element_id", "k", "m.p.x", "m.p.y"), "x", "y")


def output_names(s: SparkSession, d: str) -> DataFrame:
    """Output paths of scenes."""
    o = _table(s, d, "orders")
    scenes = o.select(F.col("o_orderkey").alias(KEY), F.col("o_orderpriority").alias("dataset"), F.concat(F.lit(" log/"), F.col("o_custkey").cast("string")).alias("log_name"), F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderkey").cast("string")).alias("scene_uuid"), F.concat(F.lit("Town #"), (F.col("o_custkey") % 9).cast("string")).alias("location"))
    return convert.output_names(scenes, "log_name").select(KEY, "path")


def vehicle_boxes(s: SparkSession, d: str) -> DataFrame:
    """Corners of tracks' boxes in valid frames."""
    v = bridge.track_states(s, d).filter("valid = 1")
    box = overlap.corners(*(F.col(c) for c in ("x", "y", "heading", "length", "width")))
    return _round(v.select(KEY, "track_id", "t", F.posexplode(box).alias("corner", "p")).select(KEY, "track_id", "t", "corner", "p.x", "p.y"), "x", "y")


def route_crops(s: SparkSession, d: str) -> DataFrame:
    """Vertices of lanes that are left from the one nearest to a point on."""
    e = bridge.elements(s, d).filter(schema.is_lane())
    start = F.struct(F.lit(300.0).alias("x"), F.lit(20.0).alias("y"), F.lit(0.0).alias("z"))
    return e.select(KEY, "element_id", F.size(viewer.crop(F.col("points"), start)).alias("n_left"), F.round(P.length(F.col("points"), P.PLANE), 6).alias("length"))


def agent_routes(s: SparkSession, d: str) -> DataFrame:
    """Routes of all vehicles, solved in kernels."""
    none = F.array().cast("array<bigint>")
    first = _agents(s, d).withColumns({"seq": (F.col("track_id") % bridge.USERS).cast("int"), "track_id": F.col("track_id") + 1, "route": none, "route_gt_len": F.lit(0), "control_state": F.lit(2)})
    out = routes.agent_routes(first, _map(s, d), _lengths(s, d))
    return out.select(KEY, "track_id", F.size("route").alias("n_lanes"), "route_gt_len", "control_state", F.array_join(F.transform("route", lambda x: x.cast("string")), ">").alias("route"))


def simplified_lines(s: SparkSession, d: str) -> DataFrame:
    """Lines after the polyline stage: repeated points out, simplified, densified."""
    e = elements.process_polylines(_map(s, d).filter("polyline is not null"), 10.0, 0.1)
    return _round(e.select(KEY, "element_id", F.size("polyline").alias("n_points"), P.length(F.col("polyline")).alias("length")), "length")


def speed_zones(s: SparkSession, d: str) -> DataFrame:
    """Speed zones of lanes grouped by ten."""
    e = _map(s, d).withColumns({"speed_limit_mps": (F.col("element_id") % 3 * 5 + 10).cast("double"), "lane_group_id": F.floor(F.col("element_id") / 10), "in_junction": F.col("element_id") % 11 == 0, "speed_zone_idx": F.lit(-1)})
    return zones.speed_zones(e).filter(schema.is_lane()).select(KEY, "element_id", "speed_zone_idx")


def signal_states(s: SparkSession, d: str) -> DataFrame:
    """States of lights completed from vehicles; the bridge has few junctions, so most stay as they are."""
    states, frames = bridge.track_states(s, d), _lengths(s, d)
    state = F.expr("case label when 'view' then 3 when 'click' then 1 when 'purchase' then 2 else 0 end")
    seen = states.groupBy(KEY, "track_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("t", state.alias("s")))), lambda x: x["s"]).alias("states"))
    lights = seen.select(KEY, (F.col(KEY) * bridge.ORDERS + F.col("track_id") % bridge.USERS).alias("light_id"), (F.col("track_id") % bridge.USERS).cast("int").alias("seq"), F.struct(*(F.lit(0.0).alias(c) for c in "xyz")).alias("position"), "states")
    lights = lights.withColumn("controlled_lane", F.col("light_id"))
    cars = _agents(s, d).withColumn("seq", F.col("track_id").cast("int"))
    out = signals.interpolate(lights, _map(s, d), cars, frames)
    return out.select(KEY, "light_id", "seq", F.array_join(F.transform("states", lambda x: x.cast("string")), "").alias("states"))


def relevance_weights(s: SparkSession, d: str) -> DataFrame:
    """Weights of accelerations and speeds at distances from a stop line."""
    v = bridge.track_states(s, d).filter("vx is not null")
    n = (F.col("track_id") * 7 + F.col("t")) % 140 - 30
    speed, a = F.col("vx") - 15 + F.col("t") % 25, F.col("vx") - 16
    return _round(v.select(KEY, "track_id", "t", signals.acceleration_weight(n, a).alias("f"), signals.speed_weight(n, speed).alias("g")), "f", "g")


def neighbour_types(s: SparkSession, d: str) -> DataFrame:
    """What the lane one id on is beside each lane."""
    e = bridge.elements(s, d).filter(schema.is_lane()).select(KEY, "element_id", "points")
    other = e.select(KEY, (F.col("element_id") - 1).alias("element_id"), F.col("points").alias("b"))
    pairs = e.withColumnRenamed("points", "a").join(other, [KEY, "element_id"])
    return signals.neighbour_kinds(pairs).select(KEY, "element_id", "neighbour", "splits", "joins")


_MAP = f"{VERTICES_SQL}, elems as (select scenario_id, element_id, type, count(*) as n from vertices group by all), lanes as (select * from elems where type between 0 and 9)"
_LINKS = """links as (select a.scenario_id, a.element_id as a, b.element_id as b, k from e a, (values (40, 0), (48, 1)) o(step, k), e b where b.element_id = a.element_id + step and b.scenario_id = a.scenario_id)"""
_BOX = "[{'x': x + cos(heading) * length / 2 + sin(heading) * width / 2, 'y': y + sin(heading) * length / 2 - cos(heading) * width / 2}, {'x': x + cos(heading) * length / 2 - sin(heading) * width / 2, 'y': y + sin(heading) * length / 2 + cos(heading) * width / 2}, {'x': x - cos(heading) * length / 2 - sin(heading) * width / 2, 'y': y - sin(heading) * length / 2 + cos(heading) * width / 2}, {'x': x - cos(heading) * length / 2 + sin(heading) * width / 2, 'y': y - sin(heading) * length / 2 - cos(heading) * width / 2}]"


def _separate(ux: str, uy: str) -> str:
    along = lambda b: f"list_transform({b}, lambda p: p.x * {ux} + p.y * {uy})"
    return f"(list_max({along('a.box')}) < list_min({along('b.box')}) or list_max({along('b.box')}) < list_min({along('a.box')}))"


_SQL = {
    "validate_dynamic": f"""with {STATES_SQL}, n as (select scenario_id, track_id, count(*) as n from states group by all), m as (select scenario_id, max(t) + 1 as m from states group by all)
select n.scenario_id, 1 as level, 'Agent ' || track_id || ' ' || f || ' length ' || n || ' != scenario_length ' || m as error
from n join m using (scenario_id), unnest(['position', 'velocity', 'heading', 'valid', 'length', 'width', 'height']) u(f) where n <> m""",
    "validate_sizes": f"""with {STATES_SQL} select distinct scenario_id, 2 as level, 'Agent ' || track_id || ' has non-positive height' as error from states where valid = 1 and height <= 0""",
    "validate_refs": f"""with {_MAP}, r as (select scenario_id, element_id, key, element_id + step as ref from lanes, (values ('exit_lanes', 40), ('exit_lanes', 48), ('entry_lanes', -40), ('entry_lanes', -48)) k(key, step))
select r.scenario_id, 2 as level, 'Lane ' || r.element_id || ' ' || key || ' references non-existent lane ' || ref as error
from r left join lanes l on l.scenario_id = r.scenario_id and l.element_id = ref where l.element_id is null""",
    "edge_z_overlap": f"""with {VERTICES_SQL}, s as (select scenario_id, element_id, x as ax, y as ay, z * 10 as az, lead(x) over w as bx, lead(y) over w as by_, lead(z * 10) over w as bz from vertices where type between 20 and 29 window w as (partition by element_id order by pt)),
p as (select l.scenario_id, l.element_id as low_id, r.element_id as high_id, l.ax, l.ay, l.az, l.bz, r.az as cz, r.bz as dz2, l.bx - l.ax as rx, l.by_ - l.ay as ry, r.bx - r.ax as sx, r.by_ - r.ay as sy, r.ax - l.ax as wx, r.ay - l.ay as wy
  from s l join s r on l.scenario_id = r.scenario_id and l.element_id < r.element_id where l.bx is not null and r.bx is not null
    and least(l.ax, l.bx) <= greatest(r.ax, r.bx) and least(r.ax, r.bx) <= greatest(l.ax, l.bx) and least(l.ay, l.by_) <= greatest(r.ay, r.by_) and least(r.ay, r.by_) <= greatest(l.ay, l.by_)),
q as (select *, rx * sy - ry * sx as den, wx * ry - wy * rx as off_, rx * rx + ry * ry as r2, sx * sx + sy * sy as s2 from p),
o as (select *, (wx * sy - wy * sx) / den as t, off_ / den as u from q where abs(den) > 1e-12),
f as (select *, greatest(0.0, least((wx * rx + wy * ry) / r2, ((wx + sx) * rx + (wy + sy) * ry) / r2)) as t0, least(1.0, greatest((wx * rx + wy * ry) / r2, ((wx + sx) * rx + (wy + sy) * ry) / r2)) as t1
  from q where abs(den) <= 1e-12 and r2 > 0 and s2 > 0 and abs(off_) < 1e-12),
h as (select scenario_id, low_id, high_id, az, bz, cz, dz2, t, u from o where t between 0 and 1 and u between 0 and 1
  union all select scenario_id, low_id, high_id, az, bz, cz, dz2, t0, ((t0 * rx - wx) * sx + (t0 * ry - wy) * sy) / s2 from f where t0 <= t1
  union all select scenario_id, low_id, high_id, az, bz, cz, dz2, t1, ((t1 * rx - wx) * sx + (t1 * ry - wy) * sy) / s2 from f where t0 <= t1),
g as (select scenario_id, low_id, high_id, abs(az + (bz - az) * t - (cz + (dz2 - cz) * u)) as dz from h)
select scenario_id, low_id, high_id, round(min(dz), 6) + 0.0 as dz from g where dz > 0.5 and dz < 4.0 group by all""",
    "ring_close_densify": f"""with {VERTICES_SQL}, p as (select * from vertices where type = 31), e as (select element_id, max(pt) as m, arg_min(x, pt) as fx, arg_min(y, pt) as fy, arg_min(z, pt) as fz, arg_max(x, pt) as lx, arg_max(y, pt) as ly, arg_max(z, pt) as lz from p group by all),
c as (select scenario_id, element_id, pt, x, y, z from p union all
  select distinct p.scenario_id, e.element_id, m + 1, fx, fy, fz from e join p using (element_id) where not (abs(fx - lx) <= 1e-8 + 1e-5 * abs(lx) and abs(fy - ly) <= 1e-8 + 1e-5 * abs(ly) and abs(fz - lz) <= 1e-8 + 1e-5 * abs(lz))),
v as (select *, coalesce(lead(x) over w, x) - x as dx, coalesce(lead(y) over w, y) - y as dy, coalesce(lead(z) over w, z) - z as dz, lead(x) over w is null as tail from c window w as (partition by element_id order by pt)),
n as (select *, case when tail then 1 else cast(greatest(ceil(sqrt(dx * dx + dy * dy) / 5.0::double), 1) as integer) end as n from v), u as (select *, unnest(range(0, n)) as part from n)
select scenario_id, element_id, cast(row_number() over (partition by element_id order by pt, part) - 1 as integer) as k, round(x + dx * (part / n), 6) + 0.0 as x, round(y + dy * (part / n), 6) + 0.0 as y, round(z + dz * (part / n), 6) + 0.0 as z from u""",
    "lane_widths": f"""with {VERTICES_SQL}, l as (select * from vertices where type between 0 and 9), b as (select element_id, side, pt, x as ax, y + side * 1.75::double + side * x / 100 as ay from l, (values (1), (-1)) s(side)),
g as (select *, lead(ax) over w as bx, lead(ay) over w as by_ from b window w as (partition by element_id, side order by pt)),
d as (select l.scenario_id, l.element_id, l.pt, side, x, y, ax, ay, bx - ax as dx, by_ - ay as dy from l join g on l.element_id = g.element_id and bx is not null),
f as (select *, case when dx * dx + dy * dy > 0 then least(1.0, greatest(0.0, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy))) else 0.0 end as u from d),
m as (select scenario_id, element_id, pt, side, min(sqrt((ax + dx * u - x) * (ax + dx * u - x) + (ay + dy * u - y) * (ay + dy * u - y))) as d from f group by all),
w as (select scenario_id, element_id, pt, sum(d) as w from m group by all)
select l.scenario_id, l.element_id, l.pt, round(least(50.0, case when w > 0 then w else 3.7::double end), 6) + 0.0 as width from l left join w using (scenario_id, element_id, pt)""",
    "lane_lengths": f"""with {VERTICES_SQL}, d as (select *, x - lag(x) over w as dx, y - lag(y) over w as dy, z - lag(z) over w as dz from vertices where type between 0 and 9 window w as (partition by element_id order by pt))
select scenario_id, element_id, round(coalesce(sum(sqrt(dx * dx + dy * dy + dz * dz)), 0), 6) + 0.0 as length from d group by all""",
    "heading_circular_mean": f"""with {VERTICES_SQL}, s as (select *, lead(x) over w as bx, lead(y) over w as by_ from vertices where type between 0 and 9 window w as (partition by element_id order by pt)),
h as (select scenario_id, element_id, arg_min(atan2(by_ - y, bx - x), pt) as first_h, arg_max(atan2(by_ - y, bx - x), pt) as last_h from s where bx is not null group by all),
l as (select distinct scenario_id, element_id from s), i as (select l.scenario_id, l.element_id, avg(sin(last_h)) as s, avg(cos(last_h)) as c from l join h on h.scenario_id = l.scenario_id and h.element_id in (l.element_id - 40, l.element_id - 48) group by all)
select l.scenario_id, l.element_id, round(coalesce(atan2(s, c), first_h), 6) + 0.0 as heading from l left join i using (scenario_id, element_id) left join h using (scenario_id, element_id) where coalesce(s, first_h) is not null""",
    "stop_line_cut": f"""with {VERTICES_SQL}, v as (select *, -sin((element_id % 7) / 2 + 0.1::double) as nx, cos((element_id % 7) / 2 + 0.1::double) as ny from vertices where pt = 0),
e as (select *, x + ox as ax, y + oy as ay, px - ox as ex, py - oy as ey from v, (values (-2, -3, 2, -3), (2, -3, 2, 3), (2, 3, -2, 3), (-2, 3, -2, -3)) o(ox, oy, px, py)),
t as (select *, ex * ny - ey * nx as den, (ex * (ay - y) - ey * (ax - x)) as a, nx * (ay - y) - ny * (ax - x) as b from e),
h as (select scenario_id, element_id, a / den as t, ax + ex * (b / den) as hx, ay + ey * (b / den) as hy from t where abs(den) > 1e-8 and b / den between 0 and 1)
select scenario_id, element_id, round(arg_min(hx, t), 6) + 0.0 as x0, round(arg_min(hy, t), 6) + 0.0 as y0, round(arg_max(hx, t), 6) + 0.0 as x1, round(arg_max(hy, t), 6) + 0.0 as y1 from h group by all""",
    "control_state": f"""with {STATES_SQL}, m as (select scenario_id, track_id, median(x) as mx, median(y) as my from states where valid = 1 group by all),
e as (select s.track_id, max(sqrt((x - mx) * (x - mx) + (y - my) * (y - my))) as e from states s join m using (track_id) where valid = 1 group by all)
select distinct scenario_id, track_id, case when track_id % 5 = 0 then 0 when coalesce(e, 0) > 1 then 1 else 2 end as control_state from states left join e using (track_id)""",
    "lane_paths_3hop": f"""with {_MAP}, e as (select scenario_id, element_id from lanes where type in (1, 2)), {_LINKS},
p1 as (select scenario_id, a as src, b as dst, 1 as hops, [k] as ks, [a, b] as path from links),
p2 as (select p.scenario_id, src, l.b as dst, 2 as hops, list_append(ks, l.k) as ks, list_append(path, l.b) as path from p1 p join links l on p.dst = l.a),
p3 as (select p.scenario_id, src, l.b as dst, 3 as hops, list_append(ks, l.k) as ks, list_append(path, l.b) as path from p2 p join links l on p.dst = l.a),
u as (select * from p1 union all select * from p2 union all select * from p3)
select scenario_id, src, dst, hops, array_to_string(path, '>') as path from (select *, row_number() over (partition by src, dst order by hops, ks) as r from u where src <> dst) where r = 1""",
    "zone_extent": f"""with {VERTICES_SQL}, z as (select scenario_id, element_id // 100 as zone, max(x) - min(x) as dx, max(y) - min(y) as dy from vertices group by all)
select scenario_id, zone, round(sqrt(dx * dx + dy * dy), 6) + 0.0 as extent from z""",
    "agent_overlap": f"""with {STATES_SQL}, f as (select scenario_id, track_id, t, x, y, {_BOX} as box from (select * replace (width + 2 as width) from states) where valid = 1)
select distinct a.scenario_id, a.track_id from f a join f b on a.scenario_id = b.scenario_id and a.t = b.t and a.track_id % 3 <> 0 and b.track_id % 3 = 0 and abs(a.x - b.x) < 20 and abs(a.y - b.y) < 20
where not ({" or ".join(_separate(f"({box}.box[{i + 2}].x - {box}.box[{i + 1}].x)", f"({box}.box[{i + 2}].y - {box}.box[{i + 1}].y)") for box in "ab" for i in (0, 1))})""",
    "junction_lanes": f"""with {_MAP} select scenario_id, element_id, (element_id // 10) % 3 = 0 as in_junction from lanes""",
    "light_state_pivot": f"""with {STATES_SQL}, {VERTICES_SQL}, k as (select distinct element_id from vertices), m as (select scenario_id, max(t) as m from states group by all),
l as (select scenario_id, track_id, min(t) as first_t from states join k on k.element_id = track_id group by all),
f as (select l.scenario_id, l.track_id, unnest(range(0, m + 1)) as t from l join m using (scenario_id)),
s as (select f.scenario_id, f.track_id, f.t, case label when 'view' then 3 when 'click' then 1 when 'purchase' then 2 else 0 end as state from f left join states s on s.track_id = f.track_id and s.t = f.t),
a as (select scenario_id, track_id, string_agg(state::varchar, '' order by t) as states from s group by all)
select a.scenario_id, a.track_id as light_id, cast(row_number() over (partition by a.scenario_id order by first_t, a.track_id) - 1 as integer) as seq, states from a join l using (scenario_id, track_id)""",
    "corridor_map_filter": f"""with {STATES_SQL}, {VERTICES_SQL}, g as (select scenario_id, min(track_id) as track_id from states group by all),
p as (select s.scenario_id, t, x, y, lead(x) over w as bx, lead(y) over w as by_ from states s join g using (scenario_id, track_id) window w as (partition by scenario_id order by t)),
v as (select *, lead(x) over w as bx, lead(y) over w as by_ from vertices window w as (partition by element_id order by pt)),
a as (select distinct v.scenario_id, v.element_id from v join p on v.scenario_id = p.scenario_id,
  lateral (select case when p.bx is null or (p.bx - p.x) * (p.bx - p.x) + (p.by_ - p.y) * (p.by_ - p.y) = 0 then 0.0 else least(1.0, greatest(0.0, ((v.x - p.x) * (p.bx - p.x) + (v.y - p.y) * (p.by_ - p.y)) / ((p.bx - p.x) * (p.bx - p.x) + (p.by_ - p.y) * (p.by_ - p.y)))) end as u)
  where sqrt(power(p.x + u * coalesce(p.bx - p.x, 0) - v.x, 2) + power(p.y + u * coalesce(p.by_ - p.y, 0) - v.y, 2)) <= 250),
b as (select distinct v.scenario_id, v.element_id from v join p on v.scenario_id = p.scenario_id,
  lateral (select case when v.bx is null or (v.bx - v.x) * (v.bx - v.x) + (v.by_ - v.y) * (v.by_ - v.y) = 0 then 0.0 else least(1.0, greatest(0.0, ((p.x - v.x) * (v.bx - v.x) + (p.y - v.y) * (v.by_ - v.y)) / ((v.bx - v.x) * (v.bx - v.x) + (v.by_ - v.y) * (v.by_ - v.y)))) end as u)
  where sqrt(power(v.x + u * coalesce(v.bx - v.x, 0) - p.x, 2) + power(v.y + u * coalesce(v.by_ - v.y, 0) - p.y, 2)) <= 250)
select * from a union select * from b""",
    "topology_swap_refs": f"""with {_MAP}, n as (select scenario_id, element_id, arg_min(x, pt) as sx, arg_min(y, pt) as sy, arg_min(z, pt) as sz, arg_max(x, pt) as ex, arg_max(y, pt) as ey, arg_max(z, pt) as ez from vertices where type between 0 and 9 group by all),
r as (select a.scenario_id, a.element_id, list, place, b.element_id as ref, case when list = 0 then sqrt(power(b.ex - a.sx, 2) + power(b.ey - a.sy, 2) + power(b.ez - a.sz, 2)) > sqrt(power(b.ex - a.ex, 2) + power(b.ey - a.ey, 2) + power(b.ez - a.ez, 2))
    else sqrt(power(b.sx - a.ex, 2) + power(b.sy - a.ey, 2) + power(b.sz - a.ez, 2)) > sqrt(power(b.sx - a.sx, 2) + power(b.sy - a.sy, 2) + power(b.sz - a.sz, 2)) end as swap
  from n a, (values (0, 0, -40), (0, 1, -48), (1, 0, 40), (1, 1, 48)) o(list, place, step), n b where b.element_id = a.element_id + step and b.scenario_id = a.scenario_id),
m as (select *, case when swap then 1 - list else list end as new from r)
select n.scenario_id, n.element_id, coalesce(string_agg(ref::varchar, ',' order by list, place) filter (new = 0), '') as entry_lanes, coalesce(string_agg(ref::varchar, ',' order by list, place) filter (new = 1), '') as exit_lanes
from n left join m using (scenario_id, element_id) group by all""",
    "prune_map": f"""with {_MAP}, k as (select * from elems where n >= case when type < 30 then 2 else 3 end)
select a.scenario_id, a.element_id, a.type, coalesce(string_agg(b.element_id::varchar, ',' order by b.element_id), '') as exit_lanes from k a left join k b on b.scenario_id = a.scenario_id and b.element_id in (a.element_id + 40, a.element_id + 48) group by all""",
    "scene_filter": """select o_orderpriority as dataset, o_orderstatus as split_type, (o_custkey % 100)::varchar as log_name, o_orderkey::varchar as scene_uuid, (o_orderkey % 30)::double as duration_s from orders
where o_orderpriority in ('1-URGENT', '2-HIGH') and o_orderstatus in ('O', 'F') and o_orderkey % 30 >= 10 and o_orderkey % 4 > 0""",
    "map_discovery_topn": """select '/maps/' || o_orderpriority || '/m' || o_orderkey || '.arrow' as path from orders where o_orderpriority = '1-URGENT' and o_orderkey % 3 <> 0 order by path limit 100""",
    "name_search": """select c_custkey as scenario_id, 'Town ' || c_custkey as name from customer where lower('Town ' || c_custkey) like '%n 1%'""",
    "element_layers": f"""with {_MAP} select scenario_id, case when type between 1 and 9 then 'lane' when type = 11 then 'white_dashed' when type between 20 and 29 then 'edge' else 'crosswalk' end as layer, count(*) as n from elems group by all""",
    "state_table": f"""with {STATES_SQL} select scenario_id, track_id, t, round(sqrt(vx * vx + vy * vy), 6) + 0.0 as speed, round(degrees(heading), 6) + 0.0 as degrees from states where t < 50 and vx is not null""",
    "line_marks": f"""with {VERTICES_SQL}, s as (select *, lead(x) over w - x as dx, lead(y) over w - y as dy from vertices where type between 0 and 9 window w as (partition by element_id order by pt)),
g as (select *, sqrt(dx * dx + dy * dy) as d from s where dx is not null), f as (select *, sum(d) over (partition by element_id order by pt) - d as a from g where d >= 0.01),
m as (select *, unnest(range(0, 100)) as k from f)
select scenario_id, element_id, cast(k as integer) as k, round(x + dx * ((0.4::double * 3.0::double + k * 3.0::double - a) / d), 6) + 0.0 as x, round(y + dy * ((0.4::double * 3.0::double + k * 3.0::double - a) / d), 6) + 0.0 as y
from m where 0.4::double * 3.0::double + k * 3.0::double > a and 0.4::double * 3.0::double + k * 3.0::double <= a + d""",
    "output_names": """select o_orderkey as scenario_id, case when o_orderkey % 5 > 0 then o_orderpriority || '__log_' || o_custkey || '__' || o_orderkey else o_orderpriority || '__Town_' || o_custkey % 9 end || '.bin' as path
from (select o_orderkey, o_custkey, regexp_replace(o_orderpriority, '[^A-Za-z0-9._-]+', '_', 'g') as o_orderpriority from orders)""",
    "vehicle_boxes": f"""with {STATES_SQL}, f as (select scenario_id, track_id, t, {_BOX} as box from states where valid = 1), u as (select scenario_id, track_id, t, unnest(range(0, 4)) as corner, box from f)
select scenario_id, track_id, t, cast(corner as integer) as corner, round(box[corner + 1].x, 6) + 0.0 as x, round(box[corner + 1].y, 6) + 0.0 as y from u""",
    "relevance_weights": f"""with {STATES_SQL}, n as (select scenario_id, track_id, t, ((track_id * 7 + t) % 140 - 30) * 0.5::double as d, vx - 16 as a, vx - 15 + t % 25 as v from states where vx is not null),
w as (select *, case when v <= 12 then 9.0::double / 36 * (v - 6) * (v - 6) + 6 else least(v + 3, 30.0::double) end as full_ from n)
select scenario_id, track_id, t, round(case when d < -8 or (a < 0 and d < 0) or d >= 30 then 0.0::double when d <= 15 then 1.0::double else (d - 30) * (d - 30) / 225 end, 6) + 0.0 as f,
  round(case when d < -12 or d > 2 * full_ then 0.0::double when d <= full_ then 1.0::double else (d - 2 * full_) * (d - 2 * full_) / (full_ * full_) end, 6) + 0.0 as g from w""",
    "neighbour_types": f"""with {VERTICES_SQL}, e as (select scenario_id, element_id, arg_min(x, pt) as sx, arg_min(y, pt) as sy, arg_min(z, pt) as sz, arg_max(x, pt) as ex, arg_max(y, pt) as ey, arg_max(z, pt) as ez from vertices where type between 0 and 9 group by all),
p as (select a.scenario_id, a.element_id, sqrt(power(a.sx - b.sx, 2) + power(a.sy - b.sy, 2) + power(a.sz - b.sz, 2)) as s, sqrt(power(a.ex - b.ex, 2) + power(a.ey - b.ey, 2) + power(a.ez - b.ez, 2)) as e,
    a.ex - a.sx as ux, a.ey - a.sy as uy, b.ex - b.sx as vx, b.ey - b.sy as vy from e a join e b on b.element_id = a.element_id + 1 and b.scenario_id = a.scenario_id),
q as (select *, sqrt((ux * ux + uy * uy) * (vx * vx + vy * vy)) as size from p),
r as (select *, case when size > 0 then degrees(acos(greatest(-1.0, least(1.0, (ux * vx + uy * vy) / size)))) < 15 else false end as neighbour from q)
select scenario_id, element_id, neighbour, s < case when neighbour then 1 else 5 end as splits, s >= case when neighbour then 1 else 5 end and e < case when neighbour then 1 else 5 end as joins from r""",
    "route_crops": f"""with {VERTICES_SQL}, l as (select *, x - lag(x) over w as dx, y - lag(y) over w as dy from vertices where type between 0 and 9 window w as (partition by element_id order by pt)),
c as (select scenario_id, element_id, count(*) as n, arg_min(pt, {{'d': sqrt(power(x - 300, 2) + power(y - 20, 2)), 'pt': pt}}) as near_k, round(coalesce(sum(sqrt(dx * dx + dy * dy)), 0), 6) as length from l group by all)
select scenario_id, element_id, cast(n - near_k as integer) as n_left, length from c""",
}

_QUERIES = [
    validate_dynamic, validate_sizes, validate_refs, edge_z_overlap, ring_close_densify, lane_widths, lane_lengths, heading_circular_mean, stop_line_cut, control_state, lane_paths_3hop, zone_extent, agent_overlap, junction_lanes,
    light_state_pivot, corridor_map_filter, topology_swap_refs, prune_map, scene_filter, map_discovery_topn, name_search, element_layers, state_table, line_marks, output_names, vehicle_boxes, route_crops, relevance_weights, neighbour_types, agent_routes, simplified_lines, speed_zones, signal_states,
]


def queries() -> dict:
    """Name to (spark, sf_dir) -> DataFrame."""
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL."""
    return dict(_SQL)
