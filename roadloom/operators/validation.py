"""Checks of scenarios: each gives a row (scenario_id, level, error) per violation; no row means a sound scenario."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import points as P
from ..schema import Scenarios, is_crosswalk, is_edge, is_lane, uses_polyline
from .tracks import TRACK, _by_time

KEY = "scenario_id"
#: Longest step of the ego between neighbouring frames, and the heights between which crossing edges are an error, in metres. Fixed values.
STEP, BRIDGE_LOW, BRIDGE_HIGH = 5.0, 0.5, 4.0
#: Side of the cells that edges' segments are dealt to.
CELL = 20.0
FIELDS = ("position", "velocity", "heading", "valid", "length", "width", "height")


class ValidationError(Exception):
    """A scenario that breaks a rule."""


def _errors(df: DataFrame, level: int, checks: list[tuple[Column, Column]]) -> DataFrame:
    """Rows of the checks (condition, message) that hold."""
    found = F.array_compact(F.array(*(F.when(c, m) for c, m in checks)))
    return df.select(KEY, F.lit(level).alias("level"), F.explode(found).alias("error"))


def _text(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def _who(kind: str = "kind") -> Column:
    return F.initcap(F.col(kind))


def header(scenarios: DataFrame) -> DataFrame:
    """Length and time step."""
    n, dt = F.col("scenario_length"), F.col("dt")
    return _errors(scenarios, 1, [(n < 0, F.lit("metadata.scenario_length must be non-negative")), ((n > 0) & ~(dt > 0), F.lit("metadata.dt must be > 0 when scenario_length > 0"))])


def dynamic_states(tracks: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Fields of tracks that are missing or not one value per frame."""
    t = tracks.join(scenarios.select(KEY, "scenario_length"), KEY)
    n, who = F.col("scenario_length"), _text(_who(), " ", F.col("track_id").cast("string"))
    checks = []
    for f in FIELDS:
        size = F.size(f)
        checks += [(F.col(f).isNull(), _text(who, f" {f} is missing")), (F.col(f).isNotNull() & (n > 0) & (size != n), _text(who, f" {f} length ", size.cast("string"), " != scenario_length ", n.cast("string")))]
    return _errors(t, 1, checks)


def _shape(of: str, label: Column, least: int) -> list[tuple[Column, Column]]:
    few = F.size(of)
    return [(F.col(of).isNull(), _text(label, f" missing {of}")), (F.col(of).isNotNull() & (few < least), _text(label, f" {of} needs >= {least} points, got ", few.cast("string")))]


def map_elements(elements: DataFrame) -> DataFrame:
    """Geometry with too few points, and lanes without lists of entries and exits."""
    label = _text("Map ", F.col("element_id").cast("string"))
    checks = [(uses_polyline() & c, m) for c, m in _shape("polyline", label, 2)] + [(is_crosswalk() & c, m) for c, m in _shape("polygon", label, 3)]
    checks += [(is_lane() & F.col(k).isNull(), _text(label, f" missing or invalid {k}")) for k in ("entry_lanes", "exit_lanes")]
    return _errors(elements, 1, checks)


def stop_zones(zones: DataFrame) -> DataFrame:
    """Polygons with too few points, and zones without a list of lanes."""
    label = _text("StopZone ", F.col("seq").cast("string"))
    return _errors(zones, 1, [*_shape("polygon", label, 3), (F.col("controlled_lanes").isNull(), _text(label, " missing or invalid controlled_lanes"))])


def traffic_lights(lights: DataFrame, scenarios: DataFrame, elements: DataFrame) -> DataFrame:
    """Lights without a position, with a wrong number of states, or whose lane is no element of the map."""
    ids = elements.select(KEY, F.col("element_id").alias("controlled_lane"), F.lit(True).alias("known")).distinct()
    t = lights.join(scenarios.select(KEY, "scenario_length"), KEY).join(ids, [KEY, "controlled_lane"], "left")
    label, n, own = _text("TL ", F.col("light_id").cast("string")), F.col("scenario_length"), F.col("controlled_lane").cast("string")
    wrong = (n > 0) & (F.coalesce(F.size("states"), F.lit(0)) != n)
    checks = [
        (F.col("position").isNull(), _text(label, " position is missing")),
        (wrong, _text(label, " states length ", F.coalesce(F.size("states"), F.lit(0)).cast("string"), " != scenario_length ", n.cast("string"))),
        (F.col("known").isNull(), _text(label, " controlled_lane ", own, " not in map")),
    ]
    return _errors(t, 1, checks)


def _odd(x: Column) -> Column:
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def _odd_point(p: Column, axes: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (_odd(p[c]) for c in axes))


def not_finite(tracks: DataFrame, elements: DataFrame) -> DataFrame:
    """Fields of tracks and geometry of elements that hold a value that is no finite number."""
    who = _text(_who(), " ", F.col("track_id").cast("string"))
    test = {"position": lambda p: _odd_point(p, ("x", "y", "z")), "velocity": lambda p: _odd_point(p, ("x", "y"))}
    of = lambda f: F.coalesce(F.exists(f, test.get(f, lambda x: _odd(x.cast("double")))), F.lit(False))
    a = _errors(tracks, 2, [(of(f), _text(who, f" {f} contains NaN or Inf")) for f in FIELDS])
    label = _text("Map ", F.col("element_id").cast("string"))
    point = lambda k: F.coalesce(F.exists(k, lambda p: _odd_point(p, ("x", "y", "z"))), F.lit(False))
    return a.unionByName(_errors(elements, 2, [(point(k), _text(label, f" {k} contains NaN or Inf")) for k in ("polyline", "polygon")]))


def continuity(states: DataFrame, step: float = STEP) -> DataFrame:
    """For each track: whether any frame is valid, whether frames are missing between valid ones, and how many steps between neighbouring valid frames are too long."""
    w = _by_time()
    dx, dy = F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)
    adjacent = (F.col("valid") == 1) & (F.lag("valid").over(w) == 1) & (F.col("t") - F.lag("t").over(w) == 1)
    v = states.withColumn("jump", F.coalesce(adjacent & (F.sqrt(dx * dx + dy * dy) > step), F.lit(False)))
    on = F.when(F.col("valid") == 1, F.col("t"))
    gap = F.coalesce(F.max(on) - F.min(on) + 1 != F.count(on), F.lit(False))
    return v.groupBy(*TRACK).agg((F.count(on) > 0).alias("has_valid"), gap.alias("has_gap"), F.count(F.when(F.col("jump"), 1)).alias("n_jumps"))


def ego(tracks: DataFrame, scenarios: DataFrame, step: float = STEP) -> DataFrame:
    """A missing ego (agent 0) where there are agents, one that is never valid, of a wrong length, with gaps, or that jumps."""
    agents = tracks.filter("kind = 'agent'")
    first = agents.filter("track_id = 0").select(KEY, "valid", "position", F.lit(True).alias("there"))
    e = agents.select(KEY).distinct().join(first, KEY, "left").join(scenarios.select(KEY, "scenario_length"), KEY)
    n, v = F.col("scenario_length"), F.col("valid")
    missing = F.col("there").isNull()
    never = ~missing & ~F.exists(v, lambda x: x != 0)
    wrong = ~missing & ~never & (n > 0) & (F.size(v) != n)
    sound = ~missing & ~never & ~wrong
    at = F.filter(F.transform(v, lambda x, i: F.when(x != 0, i)), lambda i: i.isNotNull())
    gaps = F.array_max(at) - F.array_min(at) + 1 != F.size(at)
    plain = [
        (missing, F.lit("Ego agent (id=0) missing")), (never, F.lit("Ego agent has no valid frames")),
        (wrong, _text("Ego agent valid length ", F.size(v).cast("string"), " != scenario_length ", n.cast("string"))), (sound & gaps, F.lit("Ego agent has gaps in valid frames")),
    ]
    moved = P.steps(F.col("position"), lambda a, b, i: F.struct(i.alias("t"), P.distance(a, b, P.PLANE).alias("d"), ((F.get(v, i) != 0) & (F.get(v, i + 1) != 0)).alias("both")))
    jumps = e.filter(sound).select(KEY, F.explode(F.filter(moved, lambda s: s["both"] & (s["d"] > step))).alias("s"))
    text = F.format_string("Ego teleports at timestep %d: moved %.2fm", F.col("s.t"), F.col("s.d"))
    return _errors(e, 2, plain).unionByName(jumps.select(KEY, F.lit(2).alias("level"), text.alias("error")))


def lane_refs(elements: DataFrame) -> DataFrame:
    """Entries and exits of lanes that are no lanes of the scenario."""
    ids = elements.filter(is_lane()).select(KEY, F.col("element_id").alias("ref")).distinct()
    parts = []
    for k in ("entry_lanes", "exit_lanes"):
        at = elements.filter(is_lane()).select(KEY, "element_id", F.explode(k).alias("ref")).join(ids, [KEY, "ref"], "left_anti")
        parts.append(at.select(KEY, F.lit(2).alias("level"), _text("Lane ", F.col("element_id").cast("string"), f" {k} references non-existent lane ", F.col("ref").cast("string")).alias("error")))
    return parts[0].unionByName(parts[1])


def light_refs(lights: DataFrame, elements: DataFrame) -> DataFrame:
    """Lights whose lane is no lane."""
    ids = elements.filter(is_lane()).select(KEY, F.col("element_id").alias("controlled_lane")).distinct()
    bad = lights.join(ids, [KEY, "controlled_lane"], "left_anti")
    text = _text("TL ", F.col("light_id").cast("string"), " controlled_lane ", F.col("controlled_lane").cast("string"), " references non-lane element")
    return bad.select(KEY, F.lit(2).alias("level"), text.alias("error"))


def sizes(tracks: DataFrame) -> DataFrame:
    """Tracks with a size that is not positive in a valid frame."""
    who = _text(_who(), " ", F.col("track_id").cast("string"))
    bad = lambda k: F.coalesce(F.exists(F.arrays_zip("valid", F.col(k).alias("of")), lambda s: (s["valid"] != 0) & (s["of"] <= 0)), F.lit(False))
    return _errors(tracks, 2, [(bad(k), _text(who, f" has non-positive {k}")) for k in ("length", "width", "height")])


def segment_crossings(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Shares (t of a to b, u of c to d) at which two planar segments meet: one, or the two ends of what parallel ones share."""
    rx, ry, sx, sy = b["x"] - a["x"], b["y"] - a["y"], d["x"] - c["x"], d["y"] - c["y"]
    wx, wy = c["x"] - a["x"], c["y"] - a["y"]
    den, off, r2, s2 = rx * sy - ry * sx, wx * ry - wy * rx, rx * rx + ry * ry, sx * sx + sy * sy
    pair = lambda t, u: F.struct(t.alias("t"), u.alias("u"))
    once = F.filter(F.array(pair((wx * sy - wy * sx) / den, off / den)), lambda p: p["t"].between(0, 1) & p["u"].between(0, 1))
    lo, hi = (wx * rx + wy * ry) / r2, ((wx + sx) * rx + (wy + sy) * ry) / r2
    first, last = F.greatest(F.lit(0.0), F.least(lo, hi)), F.least(F.lit(1.0), F.greatest(lo, hi))
    on_other = lambda t: pair(t, ((t * rx - wx) * sx + (t * ry - wy) * sy) / s2)
    ends = F.when((F.abs(off) < 1e-12) & (first <= last), F.array(on_other(first), on_other(last)))
    return F.when(F.abs(den) > 1e-12, once).when((r2 > 0) & (s2 > 0), ends)


def edge_crossings(elements: DataFrame, cell: float = CELL) -> DataFrame:
    """Pairs of road edges that meet in the plane between BRIDGE_LOW and BRIDGE_HIGH metres apart in height: scenario_id, low_id, high_id and the least such difference.

    Segments are listed in the cells that their boxes meet; a pair counts in the first cell that both have.
    """
    part = F.explode(P.steps(F.col("polyline"), lambda a, b, i: F.struct(a.alias("a"), b.alias("b"))))
    s = elements.filter(is_edge() & (F.size("polyline") >= 2)).select(KEY, "element_id", part.alias("s")).select(KEY, "element_id", "s.a", "s.b")
    at = lambda f, c: F.floor(f(F.col(f"a.{c}"), F.col(f"b.{c}")) / cell).cast("int")
    s = s.withColumns({"cx": at(F.least, "x"), "cy": at(F.least, "y"), "ex": at(F.greatest, "x"), "ey": at(F.greatest, "y")})
    s = s.withColumn("gx", F.explode(F.sequence("cx", "ex"))).withColumn("gy", F.explode(F.sequence("cy", "ey")))
    left, right = s.alias("l"), s.alias("r")
    l, r = (lambda c: F.col(f"l.{c}")), (lambda c: F.col(f"r.{c}"))
    meets = (l(KEY) == r(KEY)) & (l("gx") == r("gx")) & (l("gy") == r("gy")) & (l("element_id") < r("element_id"))
    meets &= (l("gx") == F.greatest(l("cx"), r("cx"))) & (l("gy") == F.greatest(l("cy"), r("cy")))
    z = lambda a, b, u: a["z"] + (b["z"] - a["z"]) * u
    near = left.join(right, meets).withColumn("at", F.explode(segment_crossings(l("a"), l("b"), r("a"), r("b"))))
    dz = F.abs(z(l("a"), l("b"), F.col("at.t")) - z(r("a"), r("b"), F.col("at.u")))
    near = near.select(l(KEY).alias(KEY), l("element_id").alias("low_id"), r("element_id").alias("high_id"), dz.alias("dz")).filter((F.col("dz") > BRIDGE_LOW) & (F.col("dz") < BRIDGE_HIGH))
    return near.groupBy(KEY, "low_id", "high_id").agg(F.min("dz").alias("dz"))


def edge_heights(elements: DataFrame) -> DataFrame:
    """Edges that cross like a bridge that is too low."""
    text = F.format_string("Map edges %d and %d cross in XY with |dz|=%.2fm (sub-4m bridge)", "low_id", "high_id", "dz")
    return edge_crossings(elements).select(KEY, F.lit(2).alias("level"), text.alias("error"))


def report(s: Scenarios, level: int = 1) -> DataFrame:
    """All violations up to a level; those of level 2 only for scenarios that are clean at level 1."""
    first = [header(s.header), dynamic_states(s.tracks, s.header), map_elements(s.elements)]
    if s.zones is not None:
        first.append(stop_zones(s.zones))
    if s.lights is not None:
        first.append(traffic_lights(s.lights, s.header, s.elements))
    out = reduce(DataFrame.unionByName, first)
    if level <= 0:
        return out.limit(0)
    if level < 2:
        return out
    second = [not_finite(s.tracks, s.elements), lane_refs(s.elements), ego(s.tracks, s.header), sizes(s.tracks), edge_heights(s.elements)]
    if s.lights is not None:
        second.append(light_refs(s.lights, s.elements))
    return out.unionByName(reduce(DataFrame.unionByName, second).join(out.select(KEY).distinct(), KEY, "left_anti").select(*out.columns))
