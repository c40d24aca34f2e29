"""Track operators: each partitions by track, so that a track's frames are sorted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TRACK = ("scenario_id", "track_id")


def _by_time():
    return Window.partitionBy(*TRACK).orderBy("t")


def velocity_fill(states: DataFrame, dt: float) -> DataFrame:
    """``states`` with vx, vy: 0 where invalid; where either is missing or not finite, the difference over the adjacent valid frames, else 0."""
    at = F.struct("t", "x", "y")
    seen = F.when(F.col("valid") == 1, at)
    before = F.last(seen, ignorenulls=True).over(_by_time().rowsBetween(Window.unboundedPreceding, -1))
    after = F.first(seen, ignorenulls=True).over(_by_time().rowsBetween(1, Window.unboundedFollowing))
    finite = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    out = states.withColumns({"_p": F.coalesce(before, at), "_q": F.coalesce(after, at), "_seen": finite("vx") & finite("vy")})
    span = (F.col("_q.t") - F.col("_p.t")) * F.lit(dt)

    def filled(v: str, c: str):
        rate = F.when(F.col("_q.t") > F.col("_p.t"), (F.col(f"_q.{c}") - F.col(f"_p.{c}")) / span).otherwise(0.0)
        return F.when(F.col("valid") != 1, 0.0).when(F.col("_seen"), F.col(v)).otherwise(rate)

    return out.withColumns({"vx": filled("vx", "x"), "vy": filled("vy", "y")}).drop("_p", "_q", "_seen")


def valid_segments(states: DataFrame, least: int = 2) -> DataFrame:
    """Maximal runs of ``least`` or more valid frames: first and last frame and their number."""
    valid = states.filter("valid = 1")
    island = F.col("t") - F.row_number().over(_by_time())
    runs = valid.withColumn("island", island).groupBy(*TRACK, "island").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("frames"))
    return runs.filter(F.col("frames") >= least).drop("island")


def scaffold(states: DataFrame, header: DataFrame) -> DataFrame:
    """Every frame of each track, 0 to scenario_length - 1: frames without a state are zeros with unknown velocity and valid 0."""
    frames = header.filter("scenario_length > 0").select("scenario_id", F.explode(F.sequence(F.lit(0), F.col("scenario_length") - 1)).alias("t"))
    every = states.select(*TRACK).distinct().join(frames, "scenario_id")
    out = every.join(states, [*TRACK, "t"], "left")
    zero = [c for c in ("x", "y", "z", "heading", "length", "width", "height") if c in states.columns]
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in zero} | {"valid": F.coalesce("valid", F.lit(0))})


def nested(states: DataFrame) -> DataFrame:
    """One row per track with its frames in order, as arrays."""
    frame = F.struct("t", "x", "y", "z", "heading", "vx", "vy", "valid", "length", "width", "height")
    out = states.groupBy(*TRACK).agg(F.min("type").alias("type"), F.array_sort(F.collect_list(frame)).alias("f"))
    each = lambda body: F.transform("f", body)
    return out.select(
        *TRACK, "type", each(lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y"), s["z"].alias("z"))).alias("position"), F.col("f.heading").alias("heading"),
        each(lambda s: F.struct(s["vx"].alias("x"), s["vy"].alias("y"))).alias("velocity"), F.col("f.valid").alias("valid"), F.col("f.length").alias("length"), F.col("f.width").alias("width"), F.col("f.height").alias("height"),
    )


def goal(states: DataFrame) -> DataFrame:
    """The last valid position of each track."""
    last = F.max_by(F.struct("t", "x", "y"), "t").alias("goal")
    return states.filter("valid = 1").groupBy(*TRACK).agg(last).select(*TRACK, F.col("goal.t").alias("goal_t"), F.col("goal.x").alias("goal_x"), F.col("goal.y").alias("goal_y"))


def transitions(states: DataFrame, column: str = "label") -> DataFrame:
    """Frames at which ``column`` differs from the frame before."""
    before = F.lag(column).over(_by_time())
    return states.withColumn("before", before).filter(F.col("before") != F.col(column)).select(*TRACK, "t", "before", F.col(column).alias("after"))


def last_known(states: DataFrame, known, frames: int = 10) -> DataFrame:
    """``states`` with ``last_known``: the latest non-null ``known`` in the last ``frames`` frames and this one."""
    return states.withColumn("last_known", F.last(known, ignorenulls=True).over(_by_time().rowsBetween(-frames, 0)))


def first_seen_ids(states: DataFrame) -> DataFrame:
    """Dense ids from 1 in order of first sight (then track_id) in each scenario, and the first label."""
    first = states.groupBy(*TRACK).agg(F.min("t").alias("first_t"), F.min_by("label", "t").alias("label"))
    return first.withColumn("seen_id", F.row_number().over(Window.partitionBy("scenario_id").orderBy("first_t", "track_id")))
