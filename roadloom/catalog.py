"""Registered queries of the scenario engine and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadloom import scene_queries
from roadloom.operators import affine, controls, geometry, lines, routing, signals, tracks, validation
from roadloom.sources.bridge import STATES_SQL, VERTICES_SQL, track_states, vertices

FLAGSHIP = "point_candidates_top7"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + 0.0 for c in columns})


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("zone_id"), (F.col("o_custkey") % 50 - 1).alias("junction_id"), (F.col("o_orderkey") % 7).alias("phase_idx"))


def _last_known(s: SparkSession, d: str) -> DataFrame:
    known = F.expr("case label when 'view' then 1 when 'click' then 2 when 'purchase' then 2 end")
    return tracks.last_known(track_states(s, d), known).select("scenario_id", "track_id", "t", "last_known")


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    colour = F.expr("case label when 'view' then 'G' when 'click' then 'R' else 'U' end")
    return track_states(spark, sf_dir).select("scenario_id", "track_id", "t", colour.alias("colour"))


def _exits(spark: SparkSession, sf_dir: str) -> DataFrame:
    lanes = vertices(spark, sf_dir).select("scenario_id", "element_id").distinct()
    return lanes.withColumn("exit_id", F.explode(F.array(F.col("element_id") + 40, F.col("element_id") + 48)))


def _paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    name = F.concat(F.col("event_type"), F.lit(" #"), (F.col("user_id") % 50).cast("string"))
    paths = e.select(F.regexp_replace(name, "[^A-Za-z0-9._-]+", "_").alias("path"))
    return paths.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "point_candidates_top7": lambda s, d: routing.point_candidates(track_states(s, d), vertices(s, d)),
    "velocity_fill": lambda s, d: _rounded(tracks.velocity_fill(track_states(s, d), 0.1).select("scenario_id", "track_id", "t", "vx", "vy"), "vx", "vy"),
    "valid_segments": lambda s, d: tracks.valid_segments(track_states(s, d)),
    "goal_last_valid": lambda s, d: tracks.goal(track_states(s, d)),
    "state_transitions": lambda s, d: tracks.transitions(track_states(s, d)),
    "raw_state_last_known": _last_known,
    "track_first_seen_ids": lambda s, d: tracks.first_seen_ids(track_states(s, d)),
    "label_split_counts": lambda s, d: track_states(s, d).groupBy("scenario_id", "label").agg(F.count("*").alias("frames"), F.sum("valid").alias("valid_frames")),
    "arc_length": lambda s, d: _rounded(geometry.arc_length(vertices(s, d)).select("scenario_id", "element_id", "pt", "s"), "s"),
    "polyline_dedupe": lambda s, d: geometry.drop_duplicates(vertices(s, d)),
    "centroid_recentre": lambda s, d: _rounded(geometry.recentre(vertices(s, d)), "x", "y", "z"),
    "scene_bounds": lambda s, d: geometry.bounds(vertices(s, d)),
    "reindex_dense": lambda s, d: geometry.reindex(vertices(s, d)),
    "phase_compact": lambda s, d: controls.compact_phases(_zones(s, d)),
    "polyline_densify": lambda s, d: _rounded(lines.densify(vertices(s, d)), "x", "y", "z"),
    "reverse_edges": lambda s, d: lines.reverse_edges(vertices(s, d)),
    "straightest_exit": lambda s, d: _rounded(lines.straightest_exits(vertices(s, d), _exits(s, d)), "dot"),
    "nearby_lanes_bbox": lambda s, d: lines.lanes_near_tracks(track_states(s, d), vertices(s, d)),
    "yellow_insert": lambda s, d: signals.insert_yellow(_series(s, d)),
    "short_intervals": lambda s, d: signals.short_flips(_series(s, d)),
    "validate_ego": lambda s, d: validation.continuity(track_states(s, d)),
    "output_path_dup_guard": _paths,
    "affine_variants": lambda s, d: _rounded(affine.variants(vertices(s, d), affine.catalogue()), "x", "y"),
}

_SERIES_SQL = f"""{STATES_SQL}, series as (select scenario_id, track_id, t, case label when 'view' then 'G' when 'click' then 'R' else 'U' end as colour from states)"""

_SQL = {
    "polyline_densify": f"""with {VERTICES_SQL}, v as (select *, coalesce(lead(x) over w, x) - x as dx, coalesce(lead(y) over w, y) - y as dy, coalesce(lead(z) over w, z) - z as dz from vertices window w as (partition by element_id order by pt)),
n as (select *, cast(greatest(ceil(sqrt(dx * dx + dy * dy + dz * dz) / 2.0::double), 1) as integer) as n from v),
p as (select *, cast(unnest(range(0, n)) as integer) as part from n)
select scenario_id, element_id, pt, part, round(x + dx * (part / n), 6) + 0.0 as x, round(y + dy * (part / n), 6) + 0.0 as y, round(z + dz * (part / n), 6) + 0.0 as z from p""",
    "reverse_edges": f"""with {VERTICES_SQL} select scenario_id, element_id, type,
  case when type between 20 and 29 then max(pt) over (partition by element_id) - pt else pt end as pt, x, y, z from vertices""",
    "straightest_exit": f"""with {VERTICES_SQL}, s as (select *, lead(x) over w - x as dx, lead(y) over w - y as dy from vertices window w as (partition by element_id order by pt)),
u as (select *, sqrt(dx * dx + dy * dy) as l from s where dx is not null),
g as (select scenario_id, element_id, arg_min(dx / l, pt) as hx, arg_min(dy / l, pt) as hy, arg_max(dx / l, pt) as tx, arg_max(dy / l, pt) as ty from u where l > 1e-6 group by all),
e as (select v.scenario_id, v.element_id, coalesce(hx, 0) as hx, coalesce(hy, 0) as hy, coalesce(tx, 0) as tx, coalesce(ty, 0) as ty from (select distinct scenario_id, element_id from vertices) v left join g using (element_id)),
p as (select a.scenario_id, a.element_id, b.element_id as exit_id, a.tx * b.hx + a.ty * b.hy as dot from e a join e b on b.element_id in (a.element_id + 40, a.element_id + 48) and a.scenario_id = b.scenario_id)
select scenario_id, element_id, exit_id, round(dot, 6) + 0.0 as dot from (select *, row_number() over (partition by element_id order by dot desc, exit_id) as k from p) where k = 1""",
    "nearby_lanes_bbox": f"""with {STATES_SQL}, {VERTICES_SQL},
a as (select scenario_id, track_id, min(x) - 12 as x0, max(x) + 12 as x1, min(y) - 12 as y0, max(y) + 12 as y1 from states where valid = 1 group by all),
b as (select scenario_id, element_id, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from vertices where type in (1, 2) group by all)
select a.scenario_id, track_id, element_id from a join b on a.scenario_id = b.scenario_id and a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1""",
    "yellow_insert": f"""with {_SERIES_SQL}, f as (select *, colour = 'R' and lag(colour) over (partition by track_id order by t) = 'G' as turn from series)
select scenario_id, track_id, t, case when exists (select 1 from f g where g.turn and g.track_id = f.track_id and g.t > f.t and g.t <= f.t + 20) then 'Y' else colour end as colour from f""",
    "short_intervals": f"""with {_SERIES_SQL}, c as (select *, count(*) filter (colour = 'U') over (partition by track_id order by t) as chain from series),
g as (select *, coalesce(lag(colour) over (partition by track_id, chain order by t) <> colour, false)::int as turn from c where colour <> 'U'),
r as (select *, sum(turn) over (partition by track_id, chain order by t) as run from g),
n as (select scenario_id, track_id, chain, run, min(t) as first_t, max(t) as last_t, count(*) as frames from r group by all),
m as (select *, max(run) over (partition by track_id, chain) as last_run from n)
select scenario_id, track_id, first_t, last_t from m where run % 2 = 1 and run < last_run and frames < 30""",
    "validate_ego": f"""with {STATES_SQL}, v as (select *, x - lag(x) over w as dx, y - lag(y) over w as dy, valid = 1 and lag(valid) over w = 1 and t - lag(t) over w = 1 as adjacent from states window w as (partition by track_id order by t))
select scenario_id, track_id, coalesce(max(valid), 0) = 1 as has_valid, coalesce(max(t) filter (valid = 1) - min(t) filter (valid = 1) + 1 <> count(*) filter (valid = 1), false) as has_gap,
  count(*) filter (adjacent and sqrt(dx * dx + dy * dy) > 5) as n_jumps from v group by all""",
    "output_path_dup_guard": """select path, count(*) as n from (select regexp_replace(event_type || ' #' || (user_id % 50), '[^A-Za-z0-9._-]+', '_', 'g') as path from events) group by path having count(*) > 1""",
    "point_candidates_top7": f"""with {STATES_SQL}, {VERTICES_SQL},
seg as (select * from (select scenario_id, element_id, pt, x as ax, y as ay, lead(x) over w as bx, lead(y) over w as "by"
  from vertices where type in (1, 2) window w as (partition by scenario_id, element_id order by pt)) where bx is not null),
near as (select p.scenario_id, track_id, t, element_id, pt, heading, x, y, ax, ay, bx - ax as dx, "by" - ay as dy
  from states p join seg s on p.scenario_id = s.scenario_id and x >= least(ax, bx) - 7.1 and x <= greatest(ax, bx) + 7.1
    and y >= least(ay, "by") - 7.1 and y <= greatest(ay, "by") + 7.1 where valid = 1),
foot as (select *, least(1.0, greatest(0.0, ((x - ax) * dx + (y - ay) * dy) / (dx * dx + dy * dy))) as u from near where dx * dx + dy * dy > 1e-10),
gap as (select *, x - (ax + u * dx) as px, y - (ay + u * dy) as py from foot),
best as (select scenario_id, track_id, t, element_id, heading, px * px + py * py as d2, dx / (sqrt(dx * dx + dy * dy) + 1e-6) * cos(heading) + dy / (sqrt(dx * dx + dy * dy) + 1e-6) * sin(heading) as c,
  row_number() over (partition by track_id, t, element_id order by px * px + py * py, pt) as k from gap where px * px + py * py <= 49)
select scenario_id, track_id, t, rank, element_id, round(sqrt(d2), 6) as distance
from (select *, cast(row_number() over (partition by scenario_id, track_id, t order by d2, c desc, element_id) as integer) as rank from best where k = 1 and c > 0.3) where rank <= 7""",
    "velocity_fill": f"""with {STATES_SQL},
n as (select *, coalesce(last_value(case when valid = 1 then {{'t': t, 'x': x, 'y': y}} end ignore nulls) over (partition by track_id order by t rows between unbounded preceding and 1 preceding), {{'t': t, 'x': x, 'y': y}}) as p,
  coalesce(first_value(case when valid = 1 then {{'t': t, 'x': x, 'y': y}} end ignore nulls) over (partition by track_id order by t rows between 1 following and unbounded following), {{'t': t, 'x': x, 'y': y}}) as q from states)
select scenario_id, track_id, t, round(case when valid <> 1 then 0 when vx is not null then vx when q.t > p.t then (q.x - p.x) / ((q.t - p.t) * 0.1::double) else 0 end, 6) + 0.0 as vx,
  round(case when valid <> 1 then 0 when vx is not null then vy when q.t > p.t then (q.y - p.y) / ((q.t - p.t) * 0.1::double) else 0 end, 6) + 0.0 as vy from n""",
    "valid_segments": f"""with {STATES_SQL},
i as (select *, t - row_number() over (partition by track_id order by t) as island from states where valid = 1)
select scenario_id, track_id, min(t) as first_t, max(t) as last_t, count(*) as frames from i group by scenario_id, track_id, island having count(*) >= 2""",
    "goal_last_valid": f"""with {STATES_SQL}
select scenario_id, track_id, max(t) as goal_t, arg_max(x, t) as goal_x, arg_max(y, t) as goal_y from states where valid = 1 group by all""",
    "state_transitions": f"""with {STATES_SQL}
select scenario_id, track_id, t, before, label as after from (select *, lag(label) over (partition by track_id order by t) as before from states) where before <> label""",
    "raw_state_last_known": f"""with {STATES_SQL}
select scenario_id, track_id, t, last_value(case label when 'view' then 1 when 'click' then 2 when 'purchase' then 2 end ignore nulls)
  over (partition by track_id order by t rows between 10 preceding and current row) as last_known from states""",
    "track_first_seen_ids": f"""with {STATES_SQL}, f as (select scenario_id, track_id, min(t) as first_t, arg_min(label, t) as label from states group by all)
select *, cast(row_number() over (partition by scenario_id order by first_t, track_id) as integer) as seen_id from f""",
    "label_split_counts": f"with {STATES_SQL} select scenario_id, label, count(*) as frames, cast(sum(valid) as bigint) as valid_frames from states group by all",
    "arc_length": f"""with {VERTICES_SQL}, d as (select *, x - lag(x) over w as dx, y - lag(y) over w as dy, z - lag(z) over w as dz from vertices window w as (partition by element_id order by pt))
select scenario_id, element_id, pt, round(sum(coalesce(sqrt(dx * dx + dy * dy + dz * dz), 0)) over (partition by element_id order by pt rows unbounded preceding), 6) + 0.0 as s from d""",
    "polyline_dedupe": f"""with {VERTICES_SQL}, d as (select *, x - lag(x) over w as dx, y - lag(y) over w as dy, z - lag(z) over w as dz from vertices window w as (partition by element_id order by pt))
select scenario_id, element_id, type, pt, x, y, z from d where dx is null or sqrt(dx * dx + dy * dy + dz * dz) >= 1e-9""",
    "centroid_recentre": f"""with {VERTICES_SQL}, c as (select scenario_id, avg(x) as cx, avg(y) as cy, avg(z) as cz from vertices group by all)
select scenario_id, element_id, type, pt, round(x - cx, 6) + 0.0 as x, round(y - cy, 6) + 0.0 as y, round(z - cz, 6) + 0.0 as z from vertices join c using (scenario_id)""",
    "scene_bounds": f"""with {VERTICES_SQL}
select scenario_id, min(x) as min_x, max(x) as max_x, min(y) as min_y, max(y) as max_y, (min(x) + max(x)) / 2 as mid_x, (min(y) + max(y)) / 2 as mid_y from vertices group by all""",
    "reindex_dense": f"""with {VERTICES_SQL}, e as (select scenario_id, element_id, count(*) as n_vertices from vertices group by all)
select *, cast(row_number() over (partition by scenario_id order by element_id) - 1 as integer) as dense_id from e""",
    "phase_compact": """select junction_id, phase_idx, zone_id, cast(case when junction_id < 0 then phase_idx else dense_rank() over (partition by junction_id order by phase_idx) - 1 end as integer) as dense_phase
from (select o_orderkey as zone_id, o_custkey % 50 - 1 as junction_id, o_orderkey % 7 as phase_idx from orders)""",
    "affine_variants": f"""with {VERTICES_SQL}, c as (select scenario_id, avg(x) as cx, avg(y) as cy from vertices group by all),
m(variant, a, b, c, d) as (values {", ".join(f"('{k}', {', '.join(f'{v!r}::double' for v in m)})" for k, m in affine.catalogue().items())})
select variant, v.scenario_id, element_id, pt, round(m.a * (x - cx) + m.b * (y - cy) + cx, 6) + 0.0 as x,
  round(m.c * (x - cx) + m.d * (y - cy) + cy, 6) + 0.0 as y from vertices v join c using (scenario_id), m""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to (spark, sf_dir) -> DataFrame."""
    return _QUERIES | scene_queries.queries()


def oracle_sql() -> dict[str, str]:
    """Name to DuckDB SQL."""
    return _SQL | scene_queries.oracle_sql()
