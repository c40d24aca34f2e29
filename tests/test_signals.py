"""Completion of traffic-light states: its parts on known cases, and a whole crossing."""

import math

import numpy as np
import pytest

from roadloom import schema
from roadloom.functions import lights as L
from roadloom.operators import signals

G, R, Y = L.GREEN, L.RED, L.YELLOW
BENDS = {L.LEFT: [(0, 0), (5, 0), (8, 3), (8, 8)], L.STRAIGHT: [(0, 0), (5, 0), (10, 0)], L.RIGHT: [(0, 0), (5, 0), (8, -3), (8, -8)]}


def _line(*xy):
    return np.array([(x, y, 0.0) for x, y in xy])


@pytest.mark.parametrize(("n", "a", "want"), [(0, 1, 1), (30, 1, 1), (31, 1, 14.5**2 / 225), (60, 1, 0), (-20, 1, 0), (-16, 1, 1), (-17, 1, 0), (-2, -1, 0), (-2, 1, 1)])
def test_weight_of_an_acceleration(n, a, want):
    assert L.by_acceleration(n, float(a)) == pytest.approx(want)


@pytest.mark.parametrize(("n", "v", "want"), [(0, 0, 1), (30, 0, 1), (31, 0, 14.5**2 / 225), (60, 0, 0), (-24, 0, 1), (-25, 0, 0), (0, 6, 1), (12, 6, 1), (16, 6, 16 / 36), (24, 6, 0), (46, 20, 1), (60, 20, (30 - 46) ** 2 / 23**2), (92, 20, 0), (90, 30, 0.25), (120, 30, 0)])
def test_weight_of_a_speed(n, v, want):
    assert L.by_speed(n, float(v)) == pytest.approx(want)


def test_turns_and_angles():
    assert [L.turn_of(_line(*BENDS[t])) for t in (0, 1, 2)] == [0, 1, 2]
    assert L.between(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(90) and L.between(np.zeros(2), np.ones(2)) == 180


def _junction(turns, frames=40, seen=(), traffic=None, vertices=50):
    """A junction whose ways have approaches with the given turns; connectors are numbered in order."""
    ways, n = [], 0
    for w, way in enumerate(turns):
        ways.append([])
        for lane in way:
            ways[-1].append(L.Approach(100 + 10 * w + len(ways[-1]), vertices, np.array([1.0, 0]), [(n + k, t) for k, t in enumerate(lane)]))
            n += len(lane)
    table = {i: np.full(frames, L.ABSENT) for i in range(n)}
    for i, t, state in seen:
        table[i][t] = state
    return L.Junction(ways, table, traffic or {}, frames)


def test_slots():
    assert _junction([[[0, 1, 2]]]).slots == [(0, (0, 1, 2))]
    assert _junction([[[0], [1, 2]], [[2]]]).slots == [(0, (0,)), (0, (1, 2)), (1, (2,))]


@pytest.mark.parametrize(("seen", "t", "want"), [([(5, G)], 5, G), ([(5, R)], 5, R), ([(5, Y)], 5, G), ([(5, G)], 4, None), ([(5, G)], 16, None), ([(5, G)], 15, G), ([(3, R), (5, G)], 5, G), ([(5, L.UNKNOWN), (4, R)], 6, R), ([], 5, None)])
def test_observed_states(seen, t, want):
    assert _junction([[[1]]], seen=[(0, *s) for s in seen]).observed(t) == [want]


@pytest.mark.parametrize(("raw", "told", "sure", "want"), [(None, None, 0.0, (None, 0.0)), (None, G, 2.0, (G, 2.0)), (R, None, 0.0, (R, 0.1)), (G, G, 3.0, (G, 100.0)), (R, G, 0.9, (G, 0.9)), (R, G, 0.5, (R, 0.0))])
def test_merged_states(monkeypatch, raw, told, sure, want):
    j = _junction([[[1]]])
    monkeypatch.setattr(j, "observed", lambda t: [raw])
    monkeypatch.setattr(j, "_told", lambda w, g, t: (told, sure))
    states, weights = j.merged(0)
    assert (states[0], weights[0]) == want


def test_what_vehicles_tell():
    at = lambda rows: {100: rows}
    # (frame, vehicle, vertex of 50, speed, acceleration): three cars stand at the line, then drive, then brake
    stand = _junction([[[1]]], traffic=at([(t, c, 48 - c, 0.2, 0.0) for t in range(15, 25) for c in range(3)]))
    assert stand._told(0, (1,), 20) == (R, pytest.approx(math.log1p(3)))
    drive = _junction([[[1]]], traffic=at([(t, c, 48 - c, 8.0, 1.0) for t in range(15, 25) for c in range(3)]))
    assert drive._told(0, (1,), 20)[0] == G and drive._told(0, (1,), 0) == (None, 0.0)
    brake = _junction([[[1]]], traffic=at([(20, c, 48, 8.0, -2.0) for c in range(3)]))
    assert brake._told(0, (1,), 20)[0] == R
    # a car that enters the junction has green, unless its lane may turn right
    assert _junction([[[1]]], traffic={0: [(20, 1, 5, 3.0, 0.0)]})._told(0, (1,), 21) == (G, 100.0)
    assert _junction([[[1, 2]]], traffic={0: [(20, 1, 5, 3.0, 0.0)]})._told(0, (1, 2), 21)[0] is None
    assert _junction([[[1]]], traffic={0: [(20, 1, 5, 3.0, 0.0)]})._told(0, (1,), 23)[0] is None


def test_plans():
    four = _junction([[[1]] for _ in range(4)]).plans()
    assert len(four) == 10 and all(tuple(G if k == w else R for k in range(4)) in four for w in range(4))
    split = _junction([[[0], [1, 2]] for _ in range(4)]).plans()
    assert (G, R, R, R, G, R, R, R) in split and (R, G, R, R, R, G, R, R) in split and (G, G, R, R, G, G, R, R) in split
    assert len(_junction([[[0, 1]] for _ in range(4)]).plans()) == 6 and len(_junction([[[1]] for _ in range(3)]).plans()) == 6 and len(_junction([[[0, 1]] for _ in range(3)]).plans()) == 4


def test_right_turns_follow_their_way():
    j = _junction([[[1], [2]], [[1]], [[1]], [[1]]], seen=[(0, 5, G)])
    assert j.slots[:2] == [(0, (1,)), (0, (2,))] and j.moment(5)[:2] == (G, G)
    # a plan that is as good as any stays
    assert j.moment(30, (R, R, G, R, G)) == (R, R, G, R, G)


def test_flips_and_yellow():
    assert L.flips([G] * 5 + [R] * 3 + [G] * 5) == [(5, 7)] and L.flips([G] + [R] * 30 + [G]) == [] and L.flips([R, G, R, G, R]) == [(1, 1), (3, 3)]
    assert L.smoothed([(G, R)] * 3 + [(R, G)] * 2 + [(G, R)] * 3) == [(G, R)] * 8
    assert L.with_yellow([(G,)] * 5 + [(R,)] * 2, 3) == [(G,)] * 2 + [(Y,)] * 3 + [(R,)] * 2


def test_vehicles_on_lanes():
    lanes = {1: L.Lane(1, _line(*[(x, 0) for x in range(0, 60, 2)]), [], [], [], [], np.full(20, -1)), 2: L.Lane(2, _line((0, 3), (58, 3)), [], [], [], [], np.full(20, -1)), 3: L.Lane(3, _line((58, 0.1), (0, 0.1)), [], [], [], [], np.full(20, -1))}
    x = np.arange(20.0)
    car = (7, np.stack([x, 0 * x, 0 * x], axis=1), 0 * x, np.stack([0.01 * x**2, 0 * x], axis=1), np.ones(20, dtype=bool))
    got = L.assign(lanes, [car], 0.1, 20)
    assert got[2] == got[3] == [] and len(got[1]) == 20
    assert got[1][10] == (10, 7, 5, pytest.approx(1.0), pytest.approx(1.5)) and got[1][3][4] == 0.0
    assert L.assign(lanes, [(*car[:2], 0 * x + 1.0, *car[3:])], 0.1, 20)[1] == []


def _crossing(frames=60):
    """Four roads that meet, each with a lane in and one out and three connectors; ids 1-4 in, 11-14 out, 21.. connectors."""
    out, at = {}, [(0, -1), (1, 0), (0, 1), (-1, 0)]
    new = lambda i, line, a, b: out.update({i: L.Lane(i, line, a, b, [], [], np.full(frames, L.ABSENT))})
    turn = lambda p, r: (p[0] * r, p[1] * r)
    shift = lambda p, d: (p[0] - 2 * d[1], p[1] + 2 * d[0])
    connectors = {(i, j): 21 + 4 * i + j for i in range(4) for j in range(4) if i != j}
    for i, d in enumerate(at):
        start, end = shift(turn(d, 60), d), shift(turn(d, 10), d)
        new(i + 1, _line(*[(start[0] + (end[0] - start[0]) * k / 50, start[1] + (end[1] - start[1]) * k / 50) for k in range(51)]), [], [connectors[i, j] for j in range(4) if j != i])
        a, b = shift(turn(d, 10), (-d[0], -d[1])), shift(turn(d, 60), (-d[0], -d[1]))
        new(i + 11, _line(a, b), [connectors[j, i] for j in range(4) if j != i], [])
    for (i, j), c in connectors.items():
        p, q = out[i + 1].line[-1, :2], out[j + 11].line[0, :2]
        u, v = -np.array(at[i], dtype=float), np.array(at[j], dtype=float)
        size = np.linalg.norm(q - p) / 2
        pts = [(1 - t) ** 3 * p + 3 * (1 - t) ** 2 * t * (p + u * size) + 3 * (1 - t) * t**2 * (q - v * size) + t**3 * q for t in np.linspace(0, 1, 9)]
        new(c, _line(*pts), [i + 1], [j + 11])
    return out, connectors


def test_a_crossing(spark):
    lanes, connectors = _crossing()
    assert {L.turn_of(lanes[connectors[0, j]].line) for j in (1, 2, 3)} == {0, 1, 2}
    straight = connectors[0, 2]
    lanes[straight].seen[:] = G
    light = {straight: {"position": [0.0, 0.0, 0.0], "states": [G] * 60, "controlled_lane": straight}}
    got = L.interpolate(lanes, [], light, 0.1, 60)
    assert set(got) == set(connectors.values())
    for (i, _), c in connectors.items():
        assert set(got[c]["states"]) == {G if i == 0 else R}
    # with too few frames one plan holds throughout, and without an observation nothing is done
    assert set(L.interpolate(_crossing(12)[0] | {straight: L.Lane(straight, lanes[straight].line, [1], [13], [], [], np.full(12, G))}, [], {}, 0.1, 12)[connectors[1, 2]]["states"]) == {R}
    assert L.interpolate(_crossing()[0], [], {}, 0.1, 60) == {}
    blank = dict.fromkeys(c.split()[0] for c in schema.ELEMENT.replace("struct<x:double,y:double,z:double>", "p").split(", "))
    p = lambda a: [dict(zip("xyz", map(float, q), strict=True)) for q in a]
    rows = [blank | {"scenario_id": 1, "element_id": i, "seq": k, "type": 2, "polyline": p(l.line), "entry_lanes": l.entries, "exit_lanes": l.exits, "left_neighbor": [], "right_neighbor": []} for k, (i, l) in enumerate(_crossing()[0].items())]
    elements, lights = spark.createDataFrame(rows, schema.ELEMENT), spark.createDataFrame([{"scenario_id": 1, "light_id": straight, "seq": 0, "position": p([(0, 0, 0)])[0], "states": [3] * 60, "controlled_lane": straight}], schema.LIGHT)
    header = spark.createDataFrame([{"scenario_id": 1, "name": "s", "dataset": "d", "location": "", "scenario_length": 60, "dt": 0.1, "objects_of_interest": [], "tracks_to_predict": []}], schema.SCENARIO)
    out = {r.light_id: r.states for r in signals.interpolate(lights, elements, spark.createDataFrame([], schema.TRACK), header).collect()}
    assert out == {c: got[c]["states"] for c in got}


def test_junctions_and_stubs():
    lanes, connectors = _crossing()
    lanes[99] = L.Lane(99, _line((100, 100), (101, 100)), [], [1], [], [], np.full(60, -1))
    lanes[connectors[0, 2]].seen[3] = R
    got = L.clean(lanes)
    assert 99 not in got and got[connectors[0, 1]].splits == {connectors[0, 2], connectors[0, 3]} and got[connectors[0, 1]].joins == {connectors[2, 1], connectors[3, 1]}
    assert L.junctions(got) == [sorted(connectors.values())]
    assert [len(w) for w in L.ways(L.approaches(got, L.junctions(got)[0]))] == [1, 1, 1, 1]
    chain = {1: L.Lane(1, _line((0, 0), (30, 0)), [], [2], [], [], np.zeros(1)), 2: L.Lane(2, _line((30, 0), (34, 0.5)), [1], [], [], [], np.zeros(1)), 3: L.Lane(3, _line((34, 0), (60, 0)), [2], [], [], [], np.zeros(1))}
    assert L.is_stub(chain, 2) and not L.is_stub(chain, 1) and not L.is_stub(chain, 3)
    assert L.kinship(_line((0, 0), (30, 0)), _line((0, 0.5), (30, 3.5))) == (True, True, False) and L.kinship(_line((0, 0), (30, 0)), _line((0, 3), (20, 20))) == (False, True, False)
