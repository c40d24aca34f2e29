"""Edges along shoulders on a straight road whose results are known."""

import numpy as np
import pytest

from roadloom import schema
from roadloom.functions import shoulders as S
from roadloom.operators import shoulders as operators


def _road(i=0, x0=0.0, x1=20.0, y=0.0, **more):
    p = lambda dy: np.array([(x0, y + dy, 0.0), (x1, y + dy, 0.0)])
    return S.Lane(i, np.array([(x0, y, 0.0), ((x0 + x1) / 2, y, 0.0), (x1, y, 0.0)]), p(1.75), p(-1.75), **more)


def _box(x0=5.0, x1=15.0, y0=-1.75, y1=-4.0, z=0.0):
    return np.array([(x0, y0, z), (x1, y0, z), (x1, y1, z), (x0, y1, z), (x0, y0, z)])


def _area(x0, x1, y0=-6.0, y1=6.0, z=0.0):
    return _box(x0, x1, y0, y1, z)


def _edges(lanes, shoulders, junctions=(), widening=0.0):
    found = S.Scene(lanes, list(shoulders), list(junctions)).edges(widening)
    caps = [e for e in found if len(e) == 2 and np.ptp(e[:, 0]) < 1e-6]
    return [e for e in found if not any(e is c for c in caps)], caps


def test_runs_keep_the_road_on_their_right():
    (e,), caps = _edges([_road()], [_box()])
    assert not caps and (np.diff(e[:, 0]) < 0).all() and np.allclose(e[:, 1], -1.75) and abs(e[:, 0].min() - 5) <= 0.25 and abs(e[:, 0].max() - 15) <= 0.25
    (e,), _ = _edges([_road()], [_box() * [1, -1, 1]])
    assert (np.diff(e[:, 0]) > 0).all() and np.allclose(e[:, 1], 1.75)


@pytest.mark.parametrize(
    ("shoulders", "junctions", "runs", "caps"),
    [
        ([_box() + [0, -3, 0]], [], 0, 0), ([_box(y1=-2.15)], [], 0, 0), ([_box(9.0, 11.0)], [], 0, 0), ([], [], 0, 0), ([_box(y1=-2.4), _box(y0=-2.4, y1=-4.5)], [], 1, 0), ([_box(0.0, 12.0)], [], 1, 0),
        ([_box(0.0, 20.0)], [_area(-5.0, 25.0)], 0, 0), ([_box(0.0, 20.0)], [_area(-5.0, 10.0)], 1, 0), ([_box(0.0, 20.0)], [_area(-5.0, 25.0, 0.0)], 1, 0), ([_box(0.0, 10.0), _box(10.0, 20.0, y1=-2.55)], [], 1, 0),
        ([_box(0.0, 12.0), _box(12.0, 20.0, y1=-2.05)], [], 1, 0), ([_box(0.0, 9.0), _box(12.0, 20.0)], [], 1, 0), ([_box(4.0, 30.0)], [], 1, 1), ([_box(z=6.0)], [], 0, 0), ([_box(0.0, 20.0)], [_area(-5.0, 25.0, z=6.0)], 1, 0), ([_box(0.1, 10.0)], [], 1, 0),
    ],
)
def test_one_lane(shoulders, junctions, runs, caps):
    got = _edges([_road()], shoulders, junctions)
    assert (len(got[0]), len(got[1])) == (runs, caps)


def test_two_lanes():
    lanes = lambda: [_road(exits=[1]), _road(1, 20.0, 40.0, entries=[0], junction=True)]
    runs, (cap,) = _edges(lanes(), [_box(4.0, 40.0)], [_area(20.0, 45.0)])
    assert len(runs) == 1 and np.allclose(cap[:, 0], 20) and cap[0, 1] < cap[1, 1] and np.allclose(sorted(cap[:, 1]), [-4, -1.75], atol=0.1)
    for shoulders, junctions, n, m in (([_box(4.0, 40.0)], [], 2, 0), ([_box(1.0, 40.0)], [_area(20.0, 45.0)], 1, 1), ([_box(0.0, 20.0)], [_area(20.0, 45.0)], 1, 1), ([_box(0.0, 14.0)], [_area(20.0, 45.0)], 1, 0)):
        got = _edges(lanes(), shoulders, junctions)
        assert (len(got[0]), len(got[1])) == (n, m)
    _, (cap,) = _edges(lanes(), [_box(0.0, 19.5), _box(19.5, 20.0, y1=-2.0), _box(20.0, 40.0)], [_area(20.0, 45.0)])
    assert np.ptp(cap[:, 1]) >= 1.5
    runs, caps = _edges([*lanes(), _road(3, y=-5.75, exits=[4])], [_box(0.0, 20.0)], [_area(20.0, 45.0)])
    assert (len(runs), len(caps)) == (2, 1)


def test_stubs_are_looked_through():
    short = _road(1, 20.0, 20.0, entries=[0], exits=[2])
    assert [len(x) for x in _edges([_road(exits=[1]), short, _road(2, 20.0, 40.0, entries=[1])], [_box(0.0, 40.0)])] == [2, 0]
    two_metres = _road(1, 20.0, 21.6, entries=[0], exits=[2])
    assert [len(x) for x in _edges([_road(exits=[1]), two_metres, _road(2, 21.6, 40.0, entries=[1])], [_box(0.0, 20.0), _box(20.0, 21.6), _box(21.6, 40.0)])] == [3, 0]


def test_other_lanes_block_a_band():
    beside = S.Lane(1, np.array([(0, -2.75, 0), (10, -2.75, 0.0)]), np.array([(0, -1.0, 0), (10, -1, 0)]), np.array([(0, -4.5, 0), (10, -4.5, 0)]), junction=True)
    (e,), _ = _edges([_road(), beside], [_box(0.0, 20.0)])
    assert 9.5 <= e[:, 0].min() <= 10.5 and e[:, 0].max() >= 19
    across = S.Lane(1, np.array([(10, -6.0, 0), (10, 0, 0), (10, 6, 0)]), np.array([(8.5, -6.0, 0), (8.5, 6, 0)]), np.array([(11.5, -6.0, 0), (11.5, 6, 0)]), junction=True)
    runs = [e[:, 0] for e in _edges([_road(), across], [_box(0.0, 20.0)])[0] if np.allclose(e[:, 1], -1.75)]
    assert len(runs) == 2 and all(x.max() <= 8.6 or x.min() >= 11.4 for x in runs)


def test_ramps_are_widened():
    both = [_box(-10.0, 30.0, -1.75, -5.25), _box(-10.0, 30.0, 1.75, 5.25)]
    runs, caps = _edges([_road()], both, widening=1.0)
    assert (len(runs), len(caps)) == (2, 4) and all(np.allclose(np.abs(r[:, 1]), 2.75) for r in runs) and all(np.allclose(sorted(np.abs(c[:, 1])), [2.75, 5.25]) for c in caps)
    # with a neighbour it is no ramp
    assert all(np.allclose(np.abs(r[:, 1]), 1.75) for r in _edges([_road(neighbours=True)], both, widening=1.0)[0])
    assert S.tapered(np.array([(0.0, 0, 0), (8, 0, 0), (16, 0, 0)]), np.array([0.0, 3, 0.5])).tolist() == [0, 1, 0.5]


def test_polygons():
    square = _box(0.0, 4.0, 0.0, 4.0)[:, :2]
    assert S.inside(square, np.array([(2, 2), (4, 2), (5, 2), (0, 0)], dtype=float)).tolist() == [True, False, False, False]
    assert S.covered(square, np.array([-4.0, 2]), np.array([12.0, 2])) == [(0.25, 0.5)]
    assert operators.overlap_area(square, square + 2) == pytest.approx(4) and operators.overlap_area(square, square + 9) == 0
    triangle = np.array([(0, 0), (4, 0), (0, 4.0)])
    assert operators.overlap_area(square, triangle) == pytest.approx(8) and operators.overlap_area(triangle, triangle[::-1] + [1, 0]) == pytest.approx(4.5)
    assert S.steady(np.array([0.7, 1.2, 0.7, 0.1, 0.2, 1.0, -1.0, 2.0])).tolist() == [True] * 6 + [False, True] and S.steady(np.array([0, 1.0, 0])).all()


def test_operators(spark):
    p = lambda a: [dict(zip("xyz", map(float, q), strict=True)) for q in a]
    blank = dict.fromkeys(c.split()[0] for c in schema.ELEMENT.replace("struct<x:double,y:double,z:double>", "p").split(", "))
    l = _road()
    row = blank | {"element_id": 7, "seq": 0, "type": 2, "polyline": p(l.line), "left_boundary": p(l.left), "right_boundary": p(l.right), "entry_lanes": [], "exit_lanes": [], "left_neighbor": [], "right_neighbor": [], "in_junction": False}
    elements = spark.createDataFrame([row | {"scenario_id": 1}, row | {"scenario_id": 2}], schema.ELEMENT)
    outline = lambda s, k, a: (s, k, p(a))
    shoulders = spark.createDataFrame([outline(1, 0, _box(4.0, 30.0)), outline(1, 1, _box(40.0, 50.0))], f"scenario_id long, seq int, outline {schema.POINTS}")
    crossings = spark.createDataFrame([outline(1, 0, _area(44.0, 60.0)), outline(2, 0, _area(44.0, 60.0))], f"scenario_id long, seq int, outline {schema.POINTS}")
    surfaces = operators.split_shoulders(shoulders, crossings)
    assert sorted((r.scenario_id, r.kind) for r in surfaces.collect()) == [(1, "junction"), (1, "junction"), (1, "shoulder")]
    got = operators.shoulder_edges(elements, surfaces).collect()
    assert sorted((r.scenario_id, r.element_id, r.type) for r in got) == [(1, 7, 2), (1, 8, 21), (1, 9, 21), (2, 7, 2)]
