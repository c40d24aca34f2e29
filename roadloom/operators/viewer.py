"""What a viewer asks of converted scenarios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import points as P
from ..schema import LINE_TYPES, is_edge, is_lane, is_line, is_yellow_line
from .overlap import corners
from .tracks import TRACK, _by_time

KEY = "scenario_id"
# Frames before and after now, metres of a spacing, rows of tables, default sizes of a box.
PAST, AHEAD = 20, 30
SPACING, FIRST, LEAST = 3.0, 0.4, 0.01
STATE_ROWS, VERTEX_ROWS = 50, 30
AGENT_BOX, OBJECT_BOX = (4.5, 2.0, 1.5), (1.0, 1.0, 1.0)
LIGHT_OFF = 4


def ego(tracks: DataFrame) -> DataFrame:
    """The first agent of each scenario."""
    return tracks.filter("kind = 'agent'").groupBy(KEY).agg(F.min_by("track_id", "seq").alias("track_id"))


def state_at(states: DataFrame, t: int) -> DataFrame:
    """Valid states at a frame."""
    return states.filter((F.col("t") == t) & (F.col("valid") == 1))


def has_route() -> Column:
    """Whether a track has a route."""
    return F.coalesce(F.size("route") > 0, F.lit(False))


def trajectories(states: DataFrame, now: int, past: int = PAST, ahead: int = AHEAD) -> DataFrame:
    """Runs of two or more valid frames within the frames around now: their first and last frame and points."""
    v = states.filter(F.col("t").between(max(0, now - past), now + ahead) & (F.col("valid") == 1)).withColumn("run", F.col("t") - F.row_number().over(_by_time()))
    points = F.array_sort(F.collect_list(F.struct("t", "x", "y", "z")))
    out = v.groupBy(*TRACK, "run").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), points.alias("points"))
    return out.filter("last_t > first_t").drop("run")


def crop(points: Column, start: Column) -> Column:
    """A line from its vertex nearest to a point on, the first of equally near ones."""
    near = F.array_min(F.transform(points, lambda p, i: F.struct(P.distance(p, start, P.PLANE).alias("d"), i.alias("i"))))
    return F.when(F.size(points) > 0, P.let(near["i"], lambda i: F.slice(points, i + 1, F.size(points)))).otherwise(points)


def route_lines(tracks: DataFrame, elements: DataFrame) -> DataFrame:
    """The lanes of each route in order, ``observed`` up to route_gt_len; the first is cropped to the track's first valid position."""
    on = F.element_at(F.filter(F.arrays_zip("position", "valid"), lambda s: s["valid"] == 1), 1)
    start = F.when(F.exists("valid", lambda v: v == 1), on["position"])
    r = tracks.filter(has_route()).select(KEY, "track_id", "route_gt_len", start.alias("start"), F.posexplode("route").alias("place", "element_id"))
    lanes = elements.select(KEY, "element_id", "polyline")
    line = F.when((F.col("place") == 0) & F.col("start").isNotNull(), crop(F.col("polyline"), F.col("start"))).otherwise(F.col("polyline"))
    return r.join(lanes, [KEY, "element_id"]).select(KEY, "track_id", "place", "element_id", (F.col("place") < F.col("route_gt_len")).alias("observed"), line.alias("points"))


def search_names(scenarios: DataFrame, text: str, column: str = "name") -> DataFrame:
    """Scenarios whose name holds a text, in any case, by name."""
    return scenarios.filter(F.contains(F.lower(column), F.lit(text.lower()))).orderBy(column)


def find(tracks: DataFrame, elements: DataFrame, controls: DataFrame, kind: str, scenario_id: int, entity_id: int) -> DataFrame:
    """One agent, object, road or control by its id."""
    tables = {"agent": (tracks.filter("kind = 'agent'"), "track_id"), "object": (tracks.filter("kind = 'object'"), "track_id"), "road": (elements, "element_id"), "control": (controls, "control_id")}
    table, key = tables[kind]
    return table.filter((F.col(KEY) == scenario_id) & (F.col(key) == entity_id))


def layer() -> Column:
    """The drawing layer of a map element."""
    solid = ~F.col("type").isin([v for k, v in LINE_TYPES.items() if "broken" in k])
    line = F.concat(F.when(is_yellow_line(), "yellow").otherwise("white"), F.lit("_"), F.when(solid, "solid").otherwise("dashed"))
    return F.when(is_lane() & (F.col("type") == 0), "lane_unknown").when(is_lane(), "lane").when(F.col("type") == 10, "line_unknown").when(is_line(), line).when(is_edge(), "edge").when(F.col("type") == 31, "crosswalk").otherwise("other")


def layers(elements: DataFrame) -> DataFrame:
    """Elements of each layer."""
    return elements.groupBy(KEY, layer().alias("layer")).agg(F.count("*").alias("n"))


def control_states(controls: DataFrame, now: int) -> DataFrame:
    """State of each control now (off where it has none) and the frames at which its state changes."""
    turns = F.filter(F.transform("states", lambda s, t: F.struct(t.alias("t"), F.get("states", t - 1).alias("before"), s.alias("after"))), lambda c: c["before"].isNotNull() & (c["before"] != c["after"]))
    return controls.select(KEY, "control_id", F.coalesce(F.get("states", F.lit(now)), F.lit(LIGHT_OFF)).alias("state"), turns.alias("changes"))


def box_sizes(kind: str = "agent") -> dict[str, Column]:
    """Sizes to draw: the defaults where a size is 0."""
    return {c: F.when(F.col(c) > 0, F.col(c)).otherwise(d) for c, d in zip(("length", "width", "height"), AGENT_BOX if kind == "agent" else OBJECT_BOX, strict=True)}


def counts(tracks: DataFrame, elements: DataFrame, controls: DataFrame) -> DataFrame:
    """Entities of each kind in each scenario."""
    every = tracks.select(KEY, "kind").unionByName(elements.select(KEY, F.lit("road").alias("kind"))).unionByName(controls.select(KEY, F.lit("control").alias("kind")))
    return every.groupBy(KEY, "kind").agg(F.count("*").alias("n"))


def bounds(elements: DataFrame, controls: DataFrame) -> DataFrame:
    """Least, greatest and middle coordinates of finite road and stop-line points; zeros for scenarios without any."""
    p = elements.select(KEY, F.explode_outer(F.coalesce("polyline", "polygon")).alias("p")).unionByName(controls.select(KEY, F.explode_outer("stop_line").alias("p")))
    finite = lambda c: F.when(~F.isnan(F.col(f"p.{c}")) & (F.abs(F.col(f"p.{c}")) < float("inf")), F.col(f"p.{c}"))
    b = p.groupBy(KEY).agg(*(F.coalesce(f(finite(c)), F.lit(0.0)).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))))
    return b.withColumns({f"mid_{c}": (F.col(f"min_{c}") + F.col(f"max_{c}")) / 2 for c in "xyz"})


def marks(points: Column, spacing: float = SPACING, first: float = FIRST) -> Column:
    """Points every ``spacing`` metres along a line, from ``first`` of the spacing on, with the heading there; segments under LEAST are passed over."""

    def of(table: Column) -> Column:
        total = F.aggregate(table, F.lit(0.0), lambda acc, s: acc + s["d"])
        starts = F.aggregate(table, F.array(F.lit(0.0)), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s["d"])))
        n = F.floor((total - first * spacing) / spacing).cast("int")

        def at(k: Column, at_: Column) -> Column:
            s = first * spacing + k * spacing
            # a mark at a vertex belongs to the segment before it
            i = F.least(F.greatest(F.size(F.filter(at_, lambda x: x < s)), F.lit(1)), F.size(table)) - 1
            seg = F.get(table, i)
            place = P.between(seg["a"], seg["b"], (s - F.get(at_, i)) / seg["d"])
            return F.struct(place.alias("p"), P.direction(seg["a"], seg["b"]).alias("heading"))

        return F.when(total >= first * spacing, P.let(starts, lambda a: F.transform(F.sequence(F.lit(0), n), lambda k: at(k, a)))).otherwise(F.array())

    long_ = F.filter(P.steps(points, lambda a, b, _: F.struct(a.alias("a"), b.alias("b"), P.distance(a, b, P.PLANE).alias("d"))), lambda s: s["d"] >= LEAST)
    return P.let(long_, of)


def box_ring(x: Column, y: Column, heading: Column, length: Column, width: Column) -> Column:
    """The closed ring of an oriented box: rear right, front right, front left, rear left, rear right."""
    return P.let(corners(x, y, heading, length, width), lambda c: F.array(c[3], c[0], c[1], c[2], c[3]))


def arrow(x: Column, y: Column, heading: Column, length: Column) -> Column:
    """From the middle 0.6 lengths ahead."""
    return F.array(F.struct(x.alias("x"), y.alias("y")), F.struct((x + F.cos(heading) * length * 0.6).alias("x"), (y + F.sin(heading) * length * 0.6).alias("y")))


def state_rows(states: DataFrame, rows: int = STATE_ROWS) -> DataFrame:
    """The first frames of each track with speed, and heading in degrees from 0 to 360."""
    out = states.filter(F.col("t") < rows).withColumn("speed", F.sqrt(F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")))
    return out.withColumn("degrees", F.pmod(F.degrees("heading"), F.lit(360.0)))


def vertex_rows(elements: DataFrame, rows: int = VERTEX_ROWS) -> DataFrame:
    """The first vertices of each element and the length up to them."""
    v = F.slice(F.coalesce("polyline", "polygon"), 1, rows)
    return elements.select(KEY, "element_id", "cum_length", F.posexplode(v).alias("pt", "p")).select(KEY, "element_id", "pt", "p.x", "p.y", "p.z", F.get("cum_length", F.col("pt")).alias("s"))


def nice_step(value: Column) -> Column:
    """The least of 1, 2, 5 and 10 times the power of ten below that is no less than the value; 1 for what is not positive."""
    power = F.pow(F.lit(10.0), F.floor(F.log10(value)))
    share = value / power
    return F.when(value > 0, power * F.when(share <= 1, 1).when(share <= 2, 2).when(share <= 5, 5).otherwise(10)).otherwise(1.0)


def axes(b: DataFrame) -> DataFrame:
    """Origin, height, foot, tick step and top of the axes beside each scene of ``bounds``."""
    span = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.lit(10.0))
    tall = F.col("max_z") - F.col("min_z")
    out = b.withColumn("span", span).withColumn("axis_height", F.when(tall > 1e-3, tall).otherwise(F.greatest(F.lit(10.0), F.col("span") * 0.15)))
    origin = F.array(F.col("min_x") - F.col("span") * 0.06, F.col("min_y") - F.col("span") * 0.06, F.col("min_z"))
    return out.select(KEY, origin.alias("origin"), "axis_height", F.greatest(F.col("span") * 0.04, F.lit(4.0)).alias("foot"), nice_step(F.col("axis_height") / 4).alias("tick_step"), (F.col("min_z") + F.col("axis_height")).alias("top_z"))


def ruler(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    """Planar distance of two points."""
    return F.hypot(bx - ax, by - ay)


def export_name(c: Column, fallback: str = "scenario") -> Column:
    """Name of a video of a scenario: path parts joined, without ending, of letters, digits, dots, dashes and underlines."""
    stem = F.regexp_replace(F.regexp_replace(c, r"[\\/]+", "__"), r"(?i)\.(bin|mp4)$", "")
    safe = F.regexp_replace(F.regexp_replace(stem, "[^A-Za-z0-9._-]+", "_"), "^[._]+|[._]+$", "")
    return F.concat(F.when(F.length(safe) > 0, safe).otherwise(fallback), F.lit(".mp4"))


def first_of(states: DataFrame) -> DataFrame:
    """Each track's first valid position."""
    w = Window.partitionBy(*TRACK).orderBy("t")
    return states.filter("valid = 1").withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")
