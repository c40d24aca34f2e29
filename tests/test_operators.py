"""Scenario operators on small scenes whose results are known."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadloom import scene_queries, schema
from roadloom.functions import codec, polylines, routes, zones
from roadloom.functions import points as P
from roadloom.operators import affine, controls, elements, extract, graph, overlap, refs, tracks, validation, viewer
from roadloom.operators import routes as route_operators
from roadloom.operators import zones as zone_operators
from roadloom.plans import convert
from roadloom.sources import binary


def _p(*xyz):
    return [dict(zip("xyz", map(float, (*p, 0.0)[:3]), strict=True)) for p in xyz]


def _element(i, t, line=None, polygon=None, **more):
    row = dict.fromkeys(c.split()[0] for c in schema.ELEMENT.replace("struct<x:double,y:double,z:double>", "p").split(", "))
    row |= {"scenario_id": 1, "element_id": i, "seq": i, "type": t, "polyline": line, "polygon": polygon, "speed_limit_mps": -1.0, "length": 0.0, "in_junction": False, "speed_zone_idx": -1}
    return row | {c: [] for c in schema.REFS} | more


def _elements(spark, *rows):
    return spark.createDataFrame([_element(*r) if isinstance(r, tuple) else r for r in rows], schema.ELEMENT)


def _track(i, xy, kind="agent", t=1, valid=None, **more):
    n = len(xy)
    row = {"scenario_id": 1, "kind": kind, "track_id": i, "seq": i, "type": t, "position": _p(*xy), "heading": [0.0] * n, "velocity": [{"x": 0.0, "y": 0.0}] * n, "valid": valid or [1] * n}
    return row | {"length": [4.0] * n, "width": [2.0] * n, "height": [1.5] * n, "route": [], "route_gt_len": 0, "control_state": 2} | more


def _tracks(spark, *rows):
    return spark.createDataFrame(list(rows), schema.TRACK)


def _header(spark, n=3, **more):
    row = {"scenario_id": 1, "name": "s", "dataset": "d", "location": "", "scenario_length": n, "dt": 0.1, "objects_of_interest": [], "tracks_to_predict": []}
    return spark.createDataFrame([row | more], schema.SCENARIO)


def _xyz(points):
    return [(p.x, p.y, p.z) for p in points]


def _values(spark, column, **lines):
    df = spark.createDataFrame([tuple(lines.values())], ", ".join(f"{k} {schema.POINTS}" for k in lines))
    return df.select(column).first()[0]


def test_types(spark):
    df = spark.createDataFrame([(t,) for t in range(0, 33)], "type int")
    got = df.select(schema.is_lane().alias("lane"), schema.is_line().alias("line"), schema.is_edge().alias("edge"), schema.is_yellow_line().alias("yellow"), schema.is_broken_line().alias("broken"), schema.is_crosswalk().alias("walk"), schema.uses_polyline().alias("lined"), schema.min_points().alias("least"), schema.type_name().alias("name"), "type").collect()
    assert [r.type for r in got if r.lane] == list(range(10)) and [r.type for r in got if r.line] == list(range(10, 20)) and [r.type for r in got if r.edge] == list(range(20, 30))
    assert [r.type for r in got if r.yellow] == [14, 15, 16, 17, 18] and [r.type for r in got if r.broken] == [11, 14] and [r.type for r in got if r.walk] == [31]
    assert all(r.lined == (r.type < 30) and r.least == (2 if r.type < 30 else 3) for r in got)
    assert [r.name for r in got if r.type in (2, 13, 21, 32)] == ["surface_street", "solid_double_white", "boundary", "speed_bump"]
    codes = spark.createDataFrame([("EGO",), ("Two_Wheeler",), ("barrier",), ("ghost",)], "label string").select(schema.code("label", schema.AGENT_LABELS).alias("a"), schema.code("label", schema.OBJECT_LABELS).alias("o")).collect()
    assert [tuple(r) for r in codes] == [(1, None), (3, None), (None, 4), (None, None)]


def test_lines(spark):
    line = _p((0, 0, 0), (3, 0, 0), (3, 4, 0))
    assert _values(spark, P.arc(F.col("a")), a=line) == [0, 3, 7] and _values(spark, P.length(F.col("a")), a=line) == 7
    assert _values(spark, P.arc(F.col("a")), a=_p((1, 1))) == [0] and _values(spark, P.length(F.col("a")), a=[]) == 0
    assert _xyz(_values(spark, P.densify(F.col("a"), 2.0), a=line)) == [(0, 0, 0), (1.5, 0, 0), (3, 0, 0), (3, 2, 0), (3, 4, 0)]
    assert _xyz(_values(spark, P.distinct_steps(F.col("a")), a=_p((0, 0), (0, 0), (1, 0), (1, 0, 1e-10), (2, 0)))) == [(0, 0, 0), (1, 0, 0), (2, 0, 0)]
    ring = _values(spark, P.ring(F.col("a"), 5.0), a=_p((0, 0, 1), (10, 0, 1), (10, 10, 3)))
    assert _xyz(ring)[:3] == [(0, 0, 1), (5, 0, 1), (10, 0, 1)] and _xyz(ring)[-1] == (0, 0, 1) and len(ring) == 8 and _xyz(ring)[3] == (10, 5, 2)
    assert len(_values(spark, P.ring(F.col("a"), 50.0), a=_p((0, 0), (1, 0), (1, 1), (0, 0)))) == 4
    rng = np.random.default_rng(1)
    xyz = rng.normal(size=(20, 3)) * 9
    assert np.allclose([(p.x, p.y, p.z) for p in _values(spark, P.densify(F.col("a"), 2.0), a=_p(*xyz))], polylines.densified(xyz, 2.0))
    assert np.allclose(_values(spark, P.arc(F.col("a")), a=_p(*xyz)), polylines.arc_lengths(xyz))


def test_simplification():
    kerb = np.array([(100 + 2.0 * i, 60.0, 7.2 - (0.2 * (i - 8) if i > 8 else 0)) for i in range(17)])
    got = polylines.simplify(kerb, 0.1)
    assert len(got) == 3 and got[1].tolist() == [116.0, 60.0, 7.2]
    bend = np.array([(0, 0, 0), (5, 0.05, 0), (10, 0, 0), (10, 5, 0), (10.05, 7, 0), (10, 10, 0)], dtype=float)
    assert polylines.simplify(bend, 0.1).tolist() == bend[[0, 2, 5]].tolist()
    assert len(polylines.simplify(bend, 0.01)) == 6
    # a chord that would cross another part of the line is not taken
    hook = np.array([(0, 0), (10, 0.0), (10, 1), (5, 0.04), (5, -0.5), (4.9, -1)], dtype=float)
    kept = polylines.simplified(hook, 0.6)
    chords = hook[kept]
    assert 3 in kept or not polylines._inner_crossing(chords[0], chords[1], chords[1:-1], chords[2:]).any()


def test_widths_lengths_and_edges(spark):
    left, right = _p((0, 1), (5, 1), (10, 1)), _p((0, -1), (7, -1), (7, -3), (10, -3))
    lane = _element(0, 2, _p((0, 0), (5, 0), (10, 0)), left_boundary=left, right_boundary=right)
    rows = _elements(spark, lane, (1, 2, _p((0, 0, 0), (3, 4, 0), (3, 4, 12))), (2, 21, _p((0, 0), (1, 0))), (3, 31, None, _p((0, 0), (1, 0), (1, 1))), (4, 2, _p((9, 9))))
    got = {r.element_id: r for r in elements.lane_lengths(elements.lane_widths(elements.close_polygons(elements.reverse_edges(rows)))).collect()}
    assert got[0].width == [2, 2, 4] and got[1].width == [3.7] * 3 and got[4].width == [3.7] and got[2].width is None
    assert got[1].cum_length == [0, 5, 17] and got[1].length == 17 and got[4].cum_length == [0] and got[4].length == 0
    assert _xyz(got[2].polyline) == [(1, 0, 0), (0, 0, 0)] and len(got[3].polygon) == 4 and got[0].polygon is None


def test_polyline_stage(spark):
    rows = _elements(spark, (0, 2, _p((0, 0), (0, 0), (8, 0.01), (16, 0))), (1, 2, _p((3, 3))), (2, 31, None, _p((0, 0), (1, 0), (1, 1))))
    got = {r.element_id: r for r in elements.process_polylines(rows, 10.0, 0.1).collect()}
    assert _xyz(got[0].polyline) == [(0, 0, 0), (8, 0, 0), (16, 0, 0)] and len(got[1].polyline) == 1 and got[2].polyline is None
    assert len(elements.process_polylines(rows, 0.0, 0.0).filter("element_id = 0").first().polyline) == 3


def test_velocity_fill(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, 1, t, v, float(x), 0.0, vx, vy) for t, (v, x, vx, vy) in enumerate([(1, 0, nan, nan), (0, 0, 7.0, 7.0), (1, 2, 9.0, 3.0), (0, 0, None, None), (1, 8, inf, 0.0)])] + [(1, 2, 0, 1, 5.0, 5.0, None, 1.0)]
    df = spark.createDataFrame(rows, "scenario_id long, track_id long, t int, valid int, x double, y double, vx double, vy double")
    got = {(r.track_id, r.t): (r.vx, r.vy) for r in tracks.velocity_fill(df, 0.5).collect()}
    assert got == {(1, 0): (2, 0), (1, 1): (0, 0), (1, 2): (9, 3), (1, 3): (0, 0), (1, 4): (6, 0), (2, 0): (0, 0)}


def test_validation(spark):
    nan = float("nan")
    rows = _elements(
        spark, (0, 2, _p((0, 0))), (1, 2, _p((0, 0), (1, 0))) , _element(2, 2, _p((0, 0), (1, 0)), exit_lanes=[1, 9], entry_lanes=[5]), (5, 21, _p((0, 0), (nan, 1))),
        (3, 31, None, _p((0, 0), (1, 1))), _element(4, 1, _p((0, 0), (1, 0)), entry_lanes=None), (6, 21, None),
    )
    err = lambda df: sorted(r.error for r in df.collect())
    assert err(validation.map_elements(rows)) == ["Map 0 polyline needs >= 2 points, got 1", "Map 3 polygon needs >= 3 points, got 2", "Map 4 missing or invalid entry_lanes", "Map 6 missing polyline"]
    assert err(validation.lane_refs(rows)) == ["Lane 2 entry_lanes references non-existent lane 5", "Lane 2 exit_lanes references non-existent lane 9"]
    assert err(validation.not_finite(_tracks(spark, _track(7, [(nan, 0)])), rows)) == ["Agent 7 position contains NaN or Inf", "Map 5 polyline contains NaN or Inf"]
    ego = lambda *a, n=4, **k: err(validation.ego(_tracks(spark, *a, **k), _header(spark, n)))
    line = [(0, 0), (1, 0), (7, 0), (8, 0)]
    assert ego(_track(3, line)) == ["Ego agent (id=0) missing"] and ego(_track(0, line, valid=[0] * 4)) == ["Ego agent has no valid frames"]
    assert ego(_track(0, line)) == ["Ego teleports at timestep 1: moved 6.00m"]
    # a step across a gap is no jump
    assert ego(_track(0, line, valid=[1, 0, 1, 1])) == ["Ego agent has gaps in valid frames"]
    assert ego(_track(0, line), n=5) == ["Ego agent valid length 4 != scenario_length 5"]
    assert err(validation.sizes(_tracks(spark, _track(1, line, height=[0.0, 1.0, 1.0, 1.0], valid=[0, 1, 1, 1]), _track(2, line, kind="object", width=[1.0, 0.0, 1.0, 1.0])))) == ["Object 2 has non-positive width"]
    assert err(validation.dynamic_states(_tracks(spark, _track(1, line, heading=None)), _header(spark, 5)))[0] == "Agent 1 heading is missing"
    assert err(validation.header(_header(spark, -1))) == ["metadata.scenario_length must be non-negative"] and err(validation.header(_header(spark, 3, dt=0.0))) != []
    lights = spark.createDataFrame([{"scenario_id": 1, "light_id": 8, "seq": 0, "position": None, "states": [0], "controlled_lane": 77}, {"scenario_id": 1, "light_id": 9, "seq": 1, "position": _p((0, 0))[0], "states": [0, 0, 0], "controlled_lane": 5}], schema.LIGHT)
    assert err(validation.traffic_lights(lights, _header(spark), rows)) == ["TL 8 controlled_lane 77 not in map", "TL 8 position is missing", "TL 8 states length 1 != scenario_length 3"]
    assert err(validation.light_refs(lights, rows)) == ["TL 8 controlled_lane 77 references non-lane element", "TL 9 controlled_lane 5 references non-lane element"]


def test_edges_that_cross_at_different_heights(spark):
    rows = [(0, 21, _p((0, 0, 0), (10, 0, 0))), (1, 21, _p((5, -5, 1), (5, 5, 3))), (2, 21, _p((7, -5, 9), (7, 5, 9))), (3, 21, _p((2, 0, 1), (30, 0, 1))), (4, 2, _p((1, -1, 2), (1, 1, 2)))]
    got = [(r.low_id, r.high_id, r.dz) for r in validation.edge_crossings(_elements(spark, *rows)).orderBy("low_id", "high_id").collect()]
    assert got == [(0, 1, 2.0), (0, 3, 1.0), (1, 3, 1.0)]
    s = schema.Scenarios(_header(spark), _tracks(spark, _track(0, [(0, 0)] * 3)), _elements(spark, *rows))
    assert validation.report(s, 1).count() == 0 and validation.report(s, 2).count() == 3 and validation.report(s, 0).count() == 0


def test_phases(spark):
    df = spark.createDataFrame([(7, 1), (7, 3), (7, 3), (-1, -1), (9, 4)], "junction_id long, phase_idx int")
    assert sorted((r.junction_id, r.phase_idx, r.dense_phase) for r in controls.compact_phases(df).collect()) == [(-1, -1, -1), (7, 1, 0), (7, 3, 1), (7, 3, 1), (9, 4, 0)]


def test_traffic_controls(spark):
    rows = _elements(spark, _element(0, 2, _p((0, 0), (10, 0)), exit_lanes=[1]), _element(1, 2, _p((10, 0), (20, 5)), entry_lanes=[0]), (2, 3, _p((0, 9), (5, 9))), _element(3, 2, _p((0, 20), (0, 30)), left_boundary=_p((-2, 20), (-2, 30)), right_boundary=_p((2, 20), (2, 30))))
    light = lambda i, lane: {"scenario_id": 1, "light_id": i, "seq": i, "position": _p((0, 0))[0], "states": [1, 2, 3], "controlled_lane": lane}
    zone = lambda i, t, ids, j=-1, p=-1: {"scenario_id": 1, "seq": i, "type": t, "polygon": _p((-1, 8), (1, 8), (1, 12), (-1, 12)), "controlled_lanes": ids, "junction_id": j, "phase_idx": p}
    s = schema.Scenarios(_header(spark), _tracks(spark, _track(0, [(0, 0)] * 3)), rows, spark.createDataFrame([light(1, 1), light(2, 2), light(3, 3), light(4, 99)], schema.LIGHT), spark.createDataFrame([zone(0, 2, [1, 2]), zone(1, 1, [0], 5, 6), zone(2, 1, [0], 5, -1), zone(3, 2, [3])], schema.ZONE))
    got = controls.traffic_controls(s).orderBy("seq").collect()
    assert [(r.control_id, r.type, r.controlled_lanes, r.states, r.junction_id, r.phase_idx) for r in got] == [(1, 1, [1], [1, 2, 3], -1, -1), (3, 1, [3], [1, 2, 3], -1, -1), (4, 2, [2], [], -1, -1), (5, 1, [0], [0, 0, 0], 5, 0), (6, 1, [0], [0, 0, 0], -1, -1)]
    assert got[0].heading == 0 and got[1].heading == pytest.approx(math.pi / 2) and got[3].heading == 0
    assert np.allclose(_xyz(got[0].stop_line), [(10, -1.75, 0), (10, 1.75, 0)]) and np.allclose(_xyz(got[1].stop_line), [(2, 20, 0), (-2, 20, 0)])
    assert np.allclose(_xyz(got[2].stop_line), [(0, 8, 0), (0, 12, 0)])


def test_overlap(spark):
    far = [(0, 0), (50, 0), (100, 0)]
    agents = [_track(0, far, route=[1], control_state=0), _track(1, [(3, 1), (90, 9), (0, 50)]), _track(2, [(0, 9), (50, 9), (100, 9)], route_gt_len=0), _track(3, [(0, 0)] * 3, valid=[0, 1, 1]), _track(4, far, kind="object")]
    got = {r.track_id: r for r in overlap.invalidate(_tracks(spark, *agents)).collect()}
    assert got[1].valid == [0, 0, 0] and [sum(got[i].valid) for i in (0, 2, 3, 4)] == [3, 3, 2, 3]
    box = spark.range(1).select(overlap.corners(F.lit(0.0), F.lit(0.0), F.lit(math.pi / 2), F.lit(4.0), F.lit(2.0)).alias("c")).first().c
    assert np.allclose([(p.x, p.y) for p in box], [(1, 2), (-1, 2), (-1, -2), (1, -2)])
    t = lambda x, h: spark.range(1).select(overlap.touch(overlap.corners(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(4.0), F.lit(2.0)), overlap.corners(F.lit(x), F.lit(0.0), F.lit(h), F.lit(4.0), F.lit(2.0)))).first()[0]
    assert t(4.0, 0.0) and not t(4.01, 0.0) and t(3.9, 0.7) and not t(4.2, 0.7 + math.pi / 2) is None
    moving = spark.createDataFrame([(1, 1, t, 1, float(x), 0.0) for t, x in enumerate((0, 0.5, 3))] + [(1, 2, 0, 1, 0.0, 0.0), (1, 3, 0, 0, 0.0, 0.0)], "scenario_id long, track_id long, t int, valid int, x double, y double")
    assert {r.track_id: r.control_state for r in route_operators.control_states(moving).collect()} == {1: 1, 2: 2, 3: 2}


def test_reindex_and_prune(spark):
    rows = _elements(spark, _element(10, 2, _p((0, 0), (1, 0)), exit_lanes=[20, 99]), _element(20, 2, _p((1, 0), (2, 0)), entry_lanes=[10]), (30, 2, _p((1, 1))), (40, 31, None, _p((0, 0), (1, 1))))
    t = _tracks(spark, _track(5, [(0, 0)], route=[10, 30, 20], route_gt_len=3), _track(8, [(0, 0)], kind="object"))
    light = [{"scenario_id": 1, "light_id": i, "seq": i, "position": _p((0, 0))[0], "states": [1], "controlled_lane": lane} for i, lane in ((1, 10), (2, 30))]
    zone = [{"scenario_id": 1, "seq": i, "type": 2, "polygon": _p((0, 0)), "controlled_lanes": ids, "junction_id": -1, "phase_idx": -1} for i, ids in enumerate(([30, 20], [40]))]
    s = schema.Scenarios(_header(spark, tracks_to_predict=[5, 6]), t, rows, spark.createDataFrame(light, schema.LIGHT), spark.createDataFrame(zone, schema.ZONE))
    s = refs.prune(s)
    assert sorted(r.element_id for r in s.elements.collect()) == [10, 20] and [r.light_id for r in s.lights.collect()] == [1] and [r.controlled_lanes for r in s.zones.collect()] == [[20]]
    assert [(r.route, r.route_gt_len) for r in s.tracks.filter("track_id = 5").collect()] == [([10, 20], 2)]
    control = spark.createDataFrame([{"scenario_id": 1, "control_id": 70, "seq": 0, "type": 1, "controlled_lanes": [20, 30], "stop_line": None, "heading": 0.0, "states": [], "junction_id": -1, "phase_idx": -1}], schema.CONTROL)
    d = spark.createDataFrame([(1, a, b, i, j, float(3 * i + j)) for i, a in enumerate((10, 15, 20)) for j, b in enumerate((10, 15, 20))], schema.DISTANCE)
    out = refs.reindex(schema.Scenarios(s.header, s.tracks, s.elements, controls=control, distances=d))
    assert sorted((r.element_id, r.exit_lanes, r.entry_lanes) for r in out.elements.collect()) == [(0, [1], []), (1, [], [0])]
    assert {(r.kind, r.track_id, tuple(r.route)) for r in out.tracks.collect()} == {("agent", 0, (0, 1)), ("object", 0, ())}
    assert out.header.first().tracks_to_predict == [0] and [(r.control_id, r.controlled_lanes) for r in out.controls.collect()] == [(0, [1])]
    assert sorted((r.src, r.dst, r.src_pos, r.dst_pos, r.distance) for r in out.distances.collect()) == [(0, 0, 0, 0, 0), (0, 1, 0, 1, 2), (1, 0, 1, 0, 6), (1, 1, 1, 1, 8)]


def test_lane_distances(spark):
    lane = lambda i, n, out, t=2: _element(i, t, _p((0, 0), (n, 0)), exit_lanes=out, length=float(n))
    rows = _elements(spark, lane(0, 5, [1, 2]), lane(1, 7, [3, 3]), lane(2, 1, [3]), lane(3, 2, []), lane(4, 9, [0], 3))
    got = {(r.src, r.dst): r.distance for r in graph.lane_distances(rows).collect()}
    assert len(got) == 16 and got[0, 3] == 6 and got[1, 3] == 14 and got[0, 0] == 0 and got[3, 0] == math.inf
    ids, d = [0, 1, 2, 3], np.array([[got[a, b] for b in range(4)] for a in range(4)])
    exits, lengths = {0: [1, 2], 1: [3], 2: [3], 3: []}, {0: 5.0, 1: 7.0, 2: 1.0, 3: 2.0}
    assert graph.reconstruct(ids, lengths, exits, d, 0, 3) == [0, 2, 3] and graph.reconstruct(ids, lengths, exits, d, 3, 0) == []


def _network():
    """A road of three lanes, a fork that turns away, and a parallel lane."""
    lanes = [(0, [(0, 0), (10, 0)], [1, 5]), (1, [(10, 0), (20, 0)], [2, 3]), (2, [(20, 0), (30, 0)], []), (3, [(20, 0), (20, 10)], []), (4, [(0, 3.5), (30, 3.5)], []), (5, [(10, 0), (10, 9)], [])]
    return routes.Network([(i, np.array(p, dtype=float), e) for i, p, e in lanes], [np.array([(0, -3.0), (30, -3.0)])])


def test_routes_by_brute_force():
    net = _network()
    rng = np.random.default_rng(0)
    for trial in range(30):
        x = np.sort(rng.uniform(0, 28, 6))
        xy = np.stack([x, rng.normal(0, 1.2, 6)], axis=1)
        if trial % 3 == 0:
            xy[2, 1] = 60
        obs = routes.observe(net, xy, np.zeros(6))
        got = routes.choose(net, obs, 6)
        best = None
        # all subsets of observations, all candidates
        for mask in range(1, 1 << len(obs)):
            part = [obs[k] for k in range(len(obs)) if mask >> k & 1]
            pool = [[]]
            for o in part:
                pool = [p + [(o[0], c)] for p in pool for c in o[1]]
            for seq in pool:
                p0, (_, d0, _) = seq[0]
                cost, ok = np.array([p0 * 50.0 + d0, p0, 0, 0, d0]), True
                for (pa, (la, _, sa)), (pb, (lb, db, sb)) in zip(seq[:-1], seq[1:], strict=True):
                    way = net.path(la, lb)
                    ok &= sb + 2.0 >= sa if la == lb else bool(way)
                    if not ok:
                        break
                    n = len(way) - 1
                    cost = cost + np.array([(pb - pa - 1) * 50.0 + n + 6.0 * (la != lb) + db, pb - pa - 1, n, la != lb, db])
                if ok:
                    left = 6 - seq[-1][0] - 1
                    cost = tuple(np.round(cost + np.array([left * 50.0, left, 0, 0, 0]), 9))
                    if best is None or cost < best[0]:
                        best = (cost, [c[0] for _, c in seq])
        assert routes.expand(net, got) == routes.expand(net, best[1])


def test_route_of_a_vehicle(spark):
    net = _network()
    xy = np.array([(1, 0), (8, 0.3), (13, 0), (18, 0)], dtype=float)
    box = (np.full(4, 4.0), np.full(4, 2.0))
    assert routes.route(net, xy, np.zeros(4), np.ones(4), *box, False) == ([0, 1, 2], 2)
    assert routes.route(net, xy + [0, -2.5], np.zeros(4), np.ones(4), *box, False) == ([], 0)
    assert routes.route(net, xy + [0, -2.5], np.zeros(4), np.ones(4), *box, True)[0][:2] == [0, 1]
    assert routes.route(net, xy, np.zeros(4), np.array([0, 1, 1, 1]), *box, False) == ([], 0) and routes.route(net, xy, np.zeros(4), np.array([1, 0, 0, 1]), *box, False, 0, 3) == ([], 0)
    assert net.path(0, 2) == (0, 1, 2) and net.path(0, 4) == () and net.path(2, 2) == (2,)
    assert net.onward([0]) == [0, 1, 2]
    rows = _elements(spark, *[_element(i, 2, _p(*line.tolist()), exit_lanes=net.exits[i]) for i, line in enumerate(net.lines)], (9, 21, _p((0, -3), (30, -3))))
    agents = _tracks(spark, _track(0, xy), _track(1, xy + [0, 0.1]), _track(2, xy, t=2), _track(3, [(90, 90)] * 4), _track(4, xy, kind="object", t=1))
    got = {r.track_id: (r.route, r.route_gt_len, r.control_state) for r in route_operators.agent_routes(agents, rows, _header(spark, 4)).collect()}
    assert got == {0: ([0, 1, 2], 2, 0), 1: ([0, 1, 2], 2, 0), 2: ([], 0, 1), 3: ([], 0, 2), 4: ([], 0, 2)}
    links = rows.filter("type = 2").select("scenario_id", "element_id", F.posexplode("exit_lanes").alias("ordinal", "exit_id"))
    paths = {(r.src, r.dst): tuple(r.path) for r in route_operators.lane_paths(links).collect()}
    assert paths == {(a, b): net.path(a, b) for a in net.ids for b in net.ids if a != b and net.path(a, b)}


def test_speed_zones(spark):
    line = lambda x0, x1, y=0.0: np.array([(x0, y), (x1, y)])
    make = lambda i, x0, x1, y=0.0, **k: zones.Lane(i, line(x0, x1, y), **{"limit": 10.0, "group": i} | k)
    lanes = [make(1, 0, 200, exits=[2], left=line(0, 200, 1.0)), make(2, 200, 400, entries=[1], exits=[9]), make(3, 0, 200, 3.5, group=1), make(4, 200, 0, 4.0, left=line(200, 0, 3.0)), make(5, 500, 700, limit=20.0), make(9, 400, 410, junction=True, entries=[2], exits=[6]), make(6, 410, 450, entries=[9])]
    assert zones.zones(lanes, least=0) == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 9: -1, 6: 2}
    # a short zone joins the one across the junction
    assert zones.zones(lanes) == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 9: -1, 6: 0}
    assert set(zones.zones([make(1, 0, 9, group=None)]).values()) == {-1} and zones.zones(lanes, least=0, gap=0)[4] == 1
    rows = _elements(spark, *[_element(l.id, 2, _p(*l.line.tolist()), speed_limit_mps=l.limit, entry_lanes=l.entries, exit_lanes=l.exits, left_boundary=None if l.left is None else _p(*l.left.tolist()), lane_group_id=l.group, in_junction=l.junction) for l in lanes])
    assert {r.element_id: r.speed_zone_idx for r in zone_operators.speed_zones(rows).collect()} == zones.zones(lanes)
    links = spark.createDataFrame([(1, 1, 2), (1, 3, 2), (1, 5, 6)], "scenario_id long, a long, b long")
    got = zone_operators.components(rows.select("scenario_id", "element_id"), links, lambda d: d.cache())
    assert {r.element_id: r.zone for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5, 9: 9}


def test_affine(spark):
    c = affine.catalogue()
    assert len(c) == 15 and len(affine.catalogue(["scale"])) == 3 and c["FlipX_ShXP"] == (-1.0, -0.17, 0.0, 1.0) and affine.catalogue(["flip"]) == {"FlipX": (-1.0, 0.0, 0.0, 1.0)}
    with pytest.raises(ValueError):
        affine.catalogue(["spin"])
    rows = _elements(spark, _element(0, 2, _p((0, 0), (100, 0)), width=[4.0, 4.0]), (1, 31, None, _p((0, 0), (0, 0), (100, 0))))
    got = {r.element_id: r for r in affine.apply(rows, c["ScX10"]).collect()}
    assert len(got[0].polyline) == 12 and got[0].polyline[0].x == pytest.approx(40 - 44) and got[0].width == [4.0] * 12
    got = {r.element_id: r for r in affine.apply(rows, c["FlipX"]).collect()}
    assert _xyz(got[0].polyline) == [(80, 0, 0), (-20, 0, 0)]
    assert np.allclose(affine.stretched_widths(np.array([2.0, 2.0]), np.array([(0, 0), (1, 0)], dtype=float), c["ScY10"]), 2.2)


def _scenario():
    track = {"id": 3, "type": 1, "position": np.array([(0, 0, 0), (6, 7, 8), (9, 9, 9)]), "heading": [0.5] * 3, "velocity": np.ones((3, 2)), "length": [4] * 3, "width": [2] * 3, "height": [1] * 3, "valid": [1, 1, 0]}
    lane = {"id": 5, "type": 2, "points": np.array([(0, 0, 0), (1, 1, 0)]), "entry_lanes": [], "exit_lanes": [6], "speed_limit_mps": 13.5, "length": 1.5, "cum_length": [0, 1.5], "width": [3.5, 3.5], "speed_zone_idx": 2}
    control = {"id": 1, "type": 1, "stop_line": np.array([(0, 0, 0), (1, 0, 0)]), "heading": 0.25, "states": [1, 2, 3], "controlled_lanes": [5], "junction_id": 4, "phase_idx": 0}
    meta = {"id": "scn", "dataset": "ds", "scenario_length": 3, "dt": 0.5, "objects_of_interest": [3], "tracks_to_predict": []}
    walk = {"id": 9, "type": 31, "points": np.array([(0, 0, 0), (1, 0, 0), (1, 1, 0)])}
    return {"agents": [track | {"route": [5], "route_gt_len": 1, "control_state": 0}], "objects": [track], "elements": [lane, walk], "controls": [control], "graph": {"lane_ids": [5], "distances": np.zeros((1, 1))}, "meta": meta}


def test_binary_round_trip(spark, tmp_path):
    data = codec.encode(_scenario())
    s = codec.decode(data)
    assert codec.encode(s) == data and s["agents"][0]["goal"] == [6, 7, 8] and s["elements"][0]["speed_zone_idx"] == 2 and s["meta"] == _scenario()["meta"]
    static = _scenario() | {"agents": [], "objects": [], "graph": None}
    assert codec.decode(codec.encode(static), static=True)["graph"] is None
    for bad, text in ((data, "not static"), (codec.encode(static)[:-3], "truncated"), (codec.encode(static) + b"xx", "trailing")):
        with pytest.raises(codec.StaticBinaryError, match=text):
            codec.decode(bad, static=True)
    # older files end after the metadata
    old = codec.encode(static).split(codec.PHASES)[0]
    got = codec.decode(old)
    assert got["controls"][0]["phase_idx"] == -1 and got["elements"][0]["speed_zone_idx"] == -1 and got["elements"][0]["width"].tolist() == [3.7, 3.7]
    with pytest.raises(ValueError, match="widths"):
        codec.encode(static | {"elements": [static["elements"][0] | {"width": [1.0]}]})
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.bin").write_bytes(data)
    (folder / "b.bin").write_bytes(data[:50])
    rows = binary.read(spark, str(folder)).cache()
    assert {(r.path.rsplit("/", 1)[1], r.error is None, r.name) for r in rows.collect()} == {("a.bin", True, "scn"), ("b.bin", False, None)}
    done = binary.write(rows.filter("error is null"), str(tmp_path / "out")).collect()
    assert [r.ok for r in done] == [True] and (tmp_path / "out" / "a.bin").read_bytes() == data
    again = binary.write(rows.filter("error is null"), str(tmp_path / "out")).collect()
    assert [r.ok for r in again] == [False] and binary.map_rows(rows).count() == 2


def test_extraction(spark):
    centre = spark.createDataFrame([(1, 10.0, 0.0, 1.0)], "scenario_id long, cx double, cy double, cz double")
    cols = "scenario_id long, t int, place int, token string, label string, x double, y double, z double, heading double, length double, width double, height double, vx double, vy double"
    see = lambda t, k, tok, lab, x=0.0, vx=None: (1, t, k, tok, lab, x, 0.0, 3.0, 0.1, 4.0, 2.0, 2.0, vx, vx)
    seen = spark.createDataFrame([see(0, 1, "b", "person"), see(0, 0, "a", "vehicle"), see(1, 0, "c", "barrier"), see(1, 1, "a", "train", 5.0, 1.0), see(1, 2, "a", "train", 6.0), see(2, 0, "d", "ghost")], cols)
    ego = spark.createDataFrame([see(t, 0, None, None, 10.0 + t, 2.0) for t in range(3)], cols)
    states, labels = extract.states(ego, seen, centre)
    got = {(r.track_id, r.t): (r.x, r.z, r.vx) for r in states.collect()}
    assert got[0, 2] == (2, 1, 2) and got[1, 1] == (-4, 1, 1.0) and got[1, 0] == (-10, 1, None) and len(got) == 8
    split = {r.track_id: (r.token, r.kind, r.type) for r in extract.split_labels(labels).collect()}
    assert split == {0: (None, "agent", 1), 1: ("a", "agent", 1), 2: ("b", "agent", 2), 3: ("c", "object", 4), 4: ("d", None, None)}
    full = tracks.scaffold(states.withColumn("valid", F.lit(1)), _header(spark)).collect()
    assert len(full) == 15 and sum(r.valid for r in full) == 8 and all(r.x == 0 and r.vx is None for r in full if not r.valid)
    index = spark.createDataFrame([(1, "tracks_to_predict", 0, 7), (1, "tracks_to_predict", 1, 6), (1, "tracks_to_predict", 2, 5)], "scenario_id long, list string, place int, track_index int")
    token = spark.createDataFrame([(1, 7, "b"), (1, 6, "c"), (1, 5, "a")], "scenario_id long, track_index int, token string")
    assert extract.targets(index, token, extract.split_labels(labels)).first().ids == [2, 1]
    lane = _elements(spark, (4, 2, _p((12, 1, 1), (20, 1, 1))), (5, 2, []))
    tl = spark.createDataFrame([(1, 4, 2, 0, "GREEN"), (1, 4, 2, 1, "RED"), (1, 5, 0, 0, "RED"), (1, 9, 0, 0, "RED"), (1, 4, 0, 0, "odd")], "scenario_id long, lane_id long, t int, place int, status string")
    light = extract.lights(tl, lane, _header(spark), centre).collect()
    assert len(light) == 1 and light[0].states == [0, 0, 1] and (light[0].position.x, light[0].position.y, light[0].position.z) == (2, 1, 0)
    one = spark.createDataFrame([(None, None, "undefined", None), (0.0, 3, "UNDEFINED", 5), (float("nan"), 4, "shoulder", 1), (9.0, 5, "freeway", None)], "v double, i long, lane_type string, lane_group_id long")
    got = one.select(extract.speed_limit(F.col("v")).alias("v"), extract.id_list(F.col("i")).alias("i"), extract.routable(F.lit(True)).alias("g"), extract.routable(F.lit(False)).alias("n")).collect()
    assert [tuple(r) for r in got] == [(-1, [], False, True), (-1, [3], True, True), (-1, [4], False, False), (9, [5], True, True)]
    assert [(r.cx, r.cy) for r in extract.centroids(ego.limit(0), ego, _header(spark)).collect()] == [(11, 0)] and [(r.cx, r.cz) for r in extract.centroids(ego.limit(0), ego.limit(0), _header(spark)).collect()] == [(0, 0)]


def test_map_extraction(spark):
    centre = spark.createDataFrame([(1, 1.0, 0.0, 0.0)], "scenario_id long, cx double, cy double, cz double")
    cols = f"scenario_id long, seq int, layer string, object_id long, kind string, points {schema.POINTS}, speed_limit_mps double, entry_lanes array<bigint>, exit_lanes array<bigint>, left_boundary {schema.POINTS}, right_boundary {schema.POINTS}, left_lane_id long, right_lane_id long, lane_group_id long, lane_ids array<bigint>, intersection_id long, phase_idx int"
    obj = lambda k, layer, i, kind, **m: {c.split()[0]: None for c in cols.replace("struct<x:double,y:double,z:double>", "p").split(", ")} | {"scenario_id": 1, "seq": k, "layer": layer, "object_id": i, "kind": kind, "points": _p((1, 0), (2, 0), (2, 1))} | m
    raw = spark.createDataFrame([obj(0, "road_line", 3, "solid_blue"), obj(1, "lane", 40, "freeway", left_lane_id=41), obj(2, "lane", 41, "bike_lane"), obj(3, "crosswalk", 7, None), obj(4, "road_edge", 9, "strange"), obj(5, "stop_zone", 1, "turn_stop", lane_ids=[40, 99], phase_idx=3), obj(6, "stop_zone", 2, "pedestrian_crossing", lane_ids=[40]), obj(7, "stop_zone", 3, "yield_sign", lane_ids=[99])], cols)
    got = extract.number_elements(extract.raw_elements(raw, centre)).orderBy("seq").collect()
    assert [(r.element_id, r.type, r.left_neighbor) for r in got] == [(40, 1, [41]), (41, 3, []), (42, 12, []), (43, 31, [])] and got[0].polyline[0].x == 0 and got[3].polygon[1].x == 1
    lanes = spark.createDataFrame([(1, 40), (1, 41)], "scenario_id long, element_id long")
    z = extract.stop_zones(raw, lanes, centre).collect()
    assert [(r.seq, r.type, r.controlled_lanes, r.junction_id, r.phase_idx) for r in z] == [(0, 2, [40], -1, 3)]
    groups = spark.createDataFrame([(1, [40], 5), (1, [41], None)], "scenario_id long, lane_ids array<bigint>, intersection_id long")
    assert {r.element_id: r.in_junction for r in extract.junction_lanes(lanes, groups).collect()} == {40: True, 41: False}
    rows = _elements(spark, _element(1, 2, _p((0, 0), (10, 0)), entry_lanes=[2, 77], exit_lanes=[3]), _element(2, 2, _p((20, 0), (10, 0)), exit_lanes=[1]), _element(3, 2, _p((-9, 0), (0, 0)), entry_lanes=[1]), _element(4, 2, []))
    got = {r.element_id: (r.entry_lanes, r.exit_lanes) for r in extract.swap_reversed_refs(rows).collect()}
    assert got == {1: ([3], [2]), 2: ([], [1]), 3: ([], [1]), 4: ([], [])}
    scenes = spark.createDataFrame([("d", "train", "s", f"l{i}", f"u{i}", 0.1, 9.0 + i, ["box_detections_se3.x"] if i else ["lidar"]) for i in range(4)], "dataset string, split_type string, split_name string, log_name string, scene_uuid string, dt double, duration_s double, modalities array<string>")
    assert [r.scene_uuid for r in extract.scenes(scenes, datasets=["d"], duration=10.5, limit=1).collect()] == ["u2"] and extract.scenes(scenes, split_types=["val"]).count() == 0
    paths = spark.createDataFrame([("/m/b/x.arrow",), ("/m/a/y.arrow",), ("/m/a/z.txt",)], "path string")
    assert [r.path for r in extract.maps(paths).collect()] == ["/m/a/y.arrow", "/m/b/x.arrow"] and extract.maps(paths, ["b"]).count() == 1
    near = spark.createDataFrame([(_p((0, 240), (0, 900)), _p((-5, 0), (5, 0))), (_p((0, 260), (0, 900)), _p((-5, 0), (5, 0)))], f"g {schema.POINTS}, e {schema.POINTS}")
    assert [r[0] for r in near.select(extract.in_corridor(F.col("g"), F.col("e"))).collect()] == [True, False]


def test_lights_first_seen_together_are_numbered_by_lane(spark):
    centre = spark.createDataFrame([(1, 0.0, 0.0, 0.0)], "scenario_id long, cx double, cy double, cz double")
    lanes = _elements(spark, *((i, 2, _p((i, 0), (i, 9))) for i in range(40)))
    seen = [(1, i, 0, 0, "red") for i in reversed(range(1, 40))] + [(1, 0, 1, 0, "red")]
    df = extract.lights(spark.createDataFrame(seen, "scenario_id long, lane_id long, t int, place int, status string"), lanes, _header(spark), centre)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}  # rows come from several partitions, as those of larger tables do
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = df.collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.light_id: r.seq for r in got} == {i: i - 1 for i in range(1, 40)} | {0: 39}


def test_types_of_undefined_lanes(spark):
    line = _p((0, 0), (1, 0))
    rows = _elements(spark, _element(1, 0, line, exit_lanes=[2]), _element(2, 0, line, exit_lanes=[3]), _element(3, 2, line), _element(4, 0, line, entry_lanes=[2], exit_lanes=[5]), _element(5, 1, line), _element(6, 0, line), _element(7, 0, line, entry_lanes=[2, 3]))
    assert {r.element_id: r.type for r in extract.infer_types(rows).collect()} == {1: 0, 2: 2, 3: 2, 4: 0, 5: 1, 6: 0, 7: 2}


def test_viewer(spark):
    line = _p((0, 0), (10, 0), (10, 0), (10, 10))
    t = _tracks(spark, _track(3, [(0, 0), (6, 1), (9, 0)], valid=[0, 1, 1], route=[5, 6], route_gt_len=1), _track(4, [(0, 0)] * 3, kind="object"))
    rows = _elements(spark, (5, 2, line), (6, 0, _p((10, 10), (20, 10))), (7, 16, line), (8, 11, line), (9, 31, None, line))
    assert viewer.ego(t).first().track_id == 3 and t.filter(viewer.has_route()).count() == 1
    got = viewer.route_lines(t, rows).orderBy("place").collect()
    assert [(r.element_id, r.observed, len(r.points)) for r in got] == [(5, True, 3), (6, False, 2)]
    assert {r.layer: r.n for r in viewer.layers(rows).collect()} == {"lane": 1, "lane_unknown": 1, "yellow_solid": 1, "white_dashed": 1, "crosswalk": 1}
    m = _values(spark, viewer.marks(F.col("a")), a=line)
    assert len(m) == 7 and (m[0].p.x, m[3].p.x) == (pytest.approx(1.2), pytest.approx(10)) or m[4].p.y == pytest.approx(3.2)
    ring = spark.range(1).select(viewer.box_ring(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(4.0), F.lit(2.0)).alias("r"), viewer.arrow(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(5.0)).alias("a")).first()
    assert [(p.x, p.y) for p in ring.r] == [(-2, -1), (2, -1), (2, 1), (-2, 1), (-2, -1)] and ring.a[1].x == 4
    names = spark.createDataFrame([("a/b.bin",), ("..",), ("x y.MP4",)], "n string")
    assert [r[0] for r in names.select(viewer.export_name(F.col("n"))).collect()] == ["a__b.mp4", "scenario.mp4", "x_y.mp4"]
    steps = spark.createDataFrame([(0.3,), (1.0,), (2.5,), (70.0,), (0.0,)], "v double").select(viewer.nice_step(F.col("v"))).collect()
    assert [round(r[0], 9) for r in steps] == [0.5, 1, 5, 100, 1]
    control = spark.createDataFrame([{"scenario_id": 1, "control_id": 1, "seq": 0, "type": 1, "controlled_lanes": [], "stop_line": _p((0, 0), (99, 0)), "heading": 0.0, "states": [1, 1, 3], "junction_id": -1, "phase_idx": -1}], schema.CONTROL)
    now = viewer.control_states(control, 5).first()
    assert now.state == 4 and [(c.t, c.before, c.after) for c in now.changes] == [(2, 1, 3)]
    b = viewer.bounds(rows, control).first()
    assert (b.min_x, b.max_x, b.mid_x, b.max_y) == (0, 99, 49.5, 10) and viewer.axes(viewer.bounds(rows, control)).first().axis_height == pytest.approx(14.85)
    assert {(r.kind, r.n) for r in viewer.counts(t, rows, control).collect()} == {("agent", 1), ("object", 1), ("road", 5), ("control", 1)}
    assert viewer.find(t, rows, control, "road", 1, 7).first().type == 16 and viewer.search_names(_header(spark, name="Big One"), "big").count() == 1
    flat = spark.createDataFrame([(1, 1, t, int(t != 2), float(t), 0.0, 0.0, 3.0, 4.0, -0.1) for t in range(60)], "scenario_id long, track_id long, t int, valid int, x double, y double, z double, vx double, vy double, heading double")
    assert [(r.first_t, r.last_t) for r in viewer.trajectories(flat, 10).orderBy("first_t").collect()] == [(0, 1), (3, 40)]
    rows50 = viewer.state_rows(flat)
    assert rows50.count() == 50 and rows50.first().speed == 5 and rows50.first().degrees == pytest.approx(360 - math.degrees(0.1)) and viewer.state_at(flat, 2).count() == 0
    assert viewer.vertex_rows(rows.limit(1)).count() == 4


def test_conversion(spark):
    lane = lambda i, a, b, out: _element(i, 2, _p(a, b), exit_lanes=out, lane_group_id=1, left_boundary=_p((a[0], 1.5), (b[0], 1.5)), right_boundary=_p((a[0], -1.5), (b[0], -1.5)))
    rows = _elements(spark, lane(10, (0, 0), (30, 0), [20]), lane(20, (30, 0), (60, 0), []), (30, 21, _p((0, 0.5))), (40, 31, None, _p((0, 5), (1, 5), (1, 6))))
    agents = _tracks(spark, _track(0, [(5, 0), (6, 0), (7, 0)]), _track(1, [(5.5, 0), (5.5, 0), (5.5, 0)], t=2))
    none = lambda s: spark.createDataFrame([], s)
    s = schema.Scenarios(_header(spark), agents, rows, none(schema.LIGHT), none(schema.ZONE))
    c = convert.configured("p", "[p]\ninvalid_agent_overlap = true\nmax_segment_length = 5.0", max_segment_length=10.0)
    assert c.invalid_agent_overlap and c.max_segment_length == 10 and len(convert.stages(c)) == 11 and len(convert.stages(convert.Config(no_speed_zones=True, no_reindex=True))) == 8
    with pytest.raises(ValueError):
        convert.configured("p", "[p]\nodd = 1")
    good, bad = convert.checked(s, convert.Config(validate_level=1))
    assert good.header.count() == 0 and "Map 30" in bad.first().error
    out = convert.run(s, c)
    got = {r.element_id: r for r in out.elements.collect()}
    assert sorted(got) == [0, 1, 2] and got[0].exit_lanes == [1] and len(got[0].polyline) == 4 and got[0].width == [3.0] * 4 and got[0].length == 30 and got[0].speed_zone_idx == 0
    assert {r.track_id: (r.route, sum(r.valid)) for r in out.tracks.collect()} == {0: ([0, 1], 3), 1: ([], 0)}
    assert {(r.src, r.dst): r.distance for r in out.distances.collect()} == {(0, 0): 0, (0, 1): 30, (1, 0): math.inf, (1, 1): 0}
    scenes = spark.createDataFrame([(1, "my set", "l/1", "u1", "x"), (2, "my set", "l 1", "u1", "x"), (3, "d", None, None, " Town 2 ")], "scenario_id long, dataset string, log_name string, scene_uuid string, location string")
    names = convert.output_names(scenes, "log_name")
    assert {r.scenario_id: r.path for r in names.collect()} == {1: "my_set__l_1__u1.bin", 2: "my_set__l_1__u1.bin", 3: "d__Town_2.bin"} and convert.duplicate_names(names).first().n == 2
    assert convert.exit_code(0, 0) == 0 and convert.exit_code(3, 0) == 1


def test_widths_are_worked_out_once_and_as_before(spark, monkeypatch):
    nan = float("nan")
    side = [_p((0, 2), (5, 3), (5, 3), (9, 1)), _p((0, -1), (9, -2)), _p((0, 2)), None, [], _p((nan, 1), (3, 4), (5, 6)), [None, *_p((3, 4), (5, 6))], _p((0, 400), (9, 400))]
    line = _p((0, 0), (4, 1), (20, -7))
    rows = [_element(10 * i + j, 2, line, left_boundary=a, right_boundary=b) for i, a in enumerate(side) for j, b in enumerate(side)]
    rows += [_element(100, 11, line, left_boundary=side[0], right_boundary=side[1], width=[1.0]), _element(101, 2, [], left_boundary=side[0], right_boundary=side[1]), _element(102, 2, None, line, width=[2.0]), _element(103, 2, [*line, None, *_p((nan, 0))], left_boundary=side[0], right_boundary=side[1])]
    df = elements.lane_widths(_elements(spark, *rows))

    def far(p, ends):
        xy = np.array([(nan, nan) if q is None else (q["x"], q["y"]) for q in ends or []]).reshape(-1, 2)
        d = polylines.segment_distances(np.array(p), xy[:-1], xy[1:]) if len(xy) > 1 else np.array([nan])
        return min((x for x in d.tolist() if x == x), default=nan)

    def width(p, a, b):
        w = far(p, a) + far(p, b)
        return min(50.0, w) if w > 0 else 3.7

    got = {r.element_id: r.width for r in df.select("element_id", "width").collect()}
    for i, a in enumerate(side):
        for j, b in enumerate(side):
            assert got[10 * i + j] == pytest.approx([width((p["x"], p["y"]), a, b) for p in line], abs=1e-12)
    assert got[100] == [1.0] and got[101] == [] and got[102] == [2.0] and got[103] == [*got[1], 3.7, 3.7] and set(got[77]) == {50.0}
    plan = df.select("element_id", F.posexplode("width"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT") == 0 and plan.count("widths(") == 1
    rng = np.random.default_rng(5)
    n, m = np.array([3, 0, 1, 4, 2]), np.array([5, 3, 1, 2, 0])
    points, lines = rng.normal(size=(2, n.sum())), rng.normal(size=(2, m.sum()))
    monkeypatch.setattr(polylines, "PAIRS", 5)
    near = polylines.line_distances(points, n, lines, m)
    cut = [np.split(x.T, np.cumsum(k)[:-1]) for x, k in ((points, n), (lines, m))]
    assert near == pytest.approx([far(p, [dict(zip("xy", q, strict=True)) for q in l]) for ps, l in zip(*cut, strict=True) for p in ps.tolist()], nan_ok=True)


def test_corridor_in_pieces_equals_whole_paths(spark):
    rng, nan = np.random.default_rng(3), float("nan")
    paths = [(k, _p(*np.cumsum(rng.normal(scale=0.4, size=(n, 2)), axis=0).tolist())) for k, n in enumerate((1, 2, 8, 9, 10, 17, 40))]
    paths += [(7, []), (8, None), (9, _p((nan, 0), (0, 0), (1, nan), (4, 0))), (10, [None, *_p((0, 0), (90, 0))]), (11, _p((-50, 3), (50, 3)))]
    objects = [(k, i, _p(*(rng.normal(scale=6, size=2) + rng.normal(size=(n, 2))).tolist())) for k in range(13) for i, n in enumerate([1, 2, 3, 6] * 20)]
    objects += [(k, 100 + i, o) for k in range(13) for i, o in enumerate(([], None, _p((0, 0), (nan, 2)), [None, *_p((1, 1), (2, 2))], _p((-400, 0), (400, 0)), _p((-400, 9), (400, 9)), _p((3, 0), (4, 0)), _p((4.5, 0), (5, 0))))]
    o = spark.createDataFrame(objects, f"scenario_id int, element_id int, points {schema.POINTS}")
    p = spark.createDataFrame(paths, f"scenario_id int, path {schema.POINTS}")
    for reach in (3.0, 0.5):
        want = {(r.scenario_id, r.element_id) for r in o.join(p, "scenario_id").filter(extract.in_corridor(F.col("points"), F.col("path"), reach)).collect()}
        got = extract.corridor(o, p, reach)
        rows = [(r.scenario_id, r.element_id) for r in got.collect()]
        assert got.columns == o.columns and set(rows) == want and 0 < len(rows) == len(want) < o.count()


def test_corridor_query_settles_by_boxes_first(spark):
    plan = scene_queries.corridor_map_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert -1 < plan.find("array_max(points") < plan.find("SQRT")
