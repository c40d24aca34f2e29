"""The command line end to end on small scenes."""

import json

import numpy as np
import pytest

from roadloom import __main__ as command
from roadloom import schema
from roadloom.functions import codec
from roadloom.operators import extract
from roadloom.plans import convert
from tests.test_operators import _element, _header, _p, _scenario, _track


def test_convert(spark, tmp_path):
    lane = lambda i, a, b, out: _element(i, 2, _p(a, b), exit_lanes=out, lane_group_id=1)
    rows = [lane(10, (0, 0), (30, 0), [20]), lane(20, (30, 0), (60, 0), []), _element(40, 31, None, _p((0, 5), (1, 5), (1, 6)))]
    more = [r | {"scenario_id": 2} for r in rows] + [r | {"scenario_id": 3} for r in rows[:1]]
    header = [{"scenario_id": i, "name": f"s{i}", "dataset": "my set", "location": "", "scenario_length": 3, "dt": 0.1, "objects_of_interest": [], "tracks_to_predict": [0]} for i in (1, 2, 3)]
    tracks = [_track(0, [(5, 0), (6, 0), (7, 0)]) | {"scenario_id": i} for i in (1, 2)] + [_track(0, [(5, 0)]) | {"scenario_id": 3}]
    for name, data, ddl in (("header", header, schema.SCENARIO), ("tracks", tracks, schema.TRACK), ("elements", rows + more, schema.ELEMENT), ("lights", [], schema.LIGHT), ("zones", [], schema.ZONE)):
        spark.createDataFrame(data, ddl).write.parquet(str(tmp_path / "in" / name))
    status, failed = command.convert_tables(spark, str(tmp_path / "in"), str(tmp_path / "out"), convert.Config(emit_metadata=True))
    assert status == 0 and [r.what for r in failed.collect()] == ["3"]
    assert sorted(p.name for p in (tmp_path / "out").glob("*.bin")) == ["my_set__s1.bin", "my_set__s2.bin"]
    s = codec.decode((tmp_path / "out" / "my_set__s1.bin").read_bytes())
    assert [a["route"] for a in s["agents"]] == [[0, 1]] and s["agents"][0]["goal"] == [7, 0, 0] and s["graph"]["distances"].tolist() == [[0, 30], [np.inf, 0]]
    assert [(e["id"], len(e["points"])) for e in s["elements"]] == [(0, 4), (1, 4), (2, 4)] and s["meta"]["tracks_to_predict"] == [0] and s["elements"][0]["width"].tolist() == pytest.approx([3.7] * 4)
    lines = [json.loads(x) for f in (tmp_path / "out" / "metadata.jsonl").glob("*.json") for x in f.read_text().splitlines()]
    assert sorted(x["bin_path"] for x in lines) == ["my_set__s1.bin", "my_set__s2.bin"]
    args = command.parser().parse_args(["convert", "a", "b", "--validate_level", "2", "--invalid_agent_overlap", "--datasets", "x", "y"])
    assert args.validate_level == 2 and args.invalid_agent_overlap and args.datasets == ["x", "y"] and args.no_reindex is None


def test_augment(spark, tmp_path):
    static = _scenario() | {"agents": [], "objects": []}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "town.bin").write_bytes(codec.encode(static))
    done = command.augment_maps(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["scale", "flip"]).collect()
    assert len(done) == 1 + 3 + 1 + 3 and all(r.ok for r in done)
    flipped = codec.decode((tmp_path / "out" / "town_FlipX.bin").read_bytes(), static=True)
    centre = np.concatenate([e["points"] for e in static["elements"]])[:, 0].mean()
    assert np.allclose(flipped["elements"][0]["points"][:, 0], 2 * centre - np.array([0, 1])) and flipped["meta"]["id"] == "town_FlipX" and flipped["controls"][0]["heading"] == pytest.approx(np.pi - 0.25)
    assert codec.decode((tmp_path / "out" / "town.bin").read_bytes())["meta"]["id"] == "scn"
    assert not any(r.ok for r in command.augment_maps(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["flip"]).collect())


def test_scenarios_from_recorded_tables(spark):
    sight = "scenario_id long, t int, place int, token string, label string, x double, y double, z double, heading double, length double, width double, height double, vx double, vy double"
    see = lambda t, tok, lab, x, vx=None, s=1: (s, t, 0, tok, lab, x, 0.0, 3.0, 0.1, 4.0, 2.0, 2.0, vx, vx)
    obj = f"scenario_id long, seq int, layer string, object_id long, kind string, points {schema.POINTS}, speed_limit_mps double, entry_lanes array<bigint>, exit_lanes array<bigint>, left_boundary {schema.POINTS}, right_boundary {schema.POINTS}, left_lane_id long, right_lane_id long, lane_group_id long, lane_ids array<bigint>, intersection_id long, phase_idx int"
    blank = {c.split()[0]: None for c in obj.replace("struct<x:double,y:double,z:double>", "p").split(", ")} | {"scenario_id": 1}
    objects = [
        blank | {"seq": 0, "layer": "lane", "object_id": 5, "kind": "freeway", "points": _p((10, 0, 9), (20, 0, 9)), "lane_group_id": 1, "exit_lanes": [6, 99]}, blank | {"seq": 1, "layer": "lane", "object_id": 6, "kind": "undefined", "points": _p((20, 0), (30, 0))},
        blank | {"seq": 2, "layer": "road_edge", "object_id": 1, "kind": "unknown", "points": _p((10, 4), (30, 4))}, blank | {"seq": 3, "layer": "stop_zone", "object_id": 2, "kind": "stop_sign", "points": _p((9, 0), (11, 0), (10, 1)), "lane_ids": [5]},
    ]
    raw = {
        "scenes": spark.createDataFrame([(1, "a", "d", "", 3, 0.5, False)], "scenario_id long, name string, dataset string, location string, scenario_length int, dt double, has_z boolean"),
        "ego": spark.createDataFrame([see(t, None, None, 10.0 + t, 2.0) for t in range(3)], sight), "detections": spark.createDataFrame([see(0, "a", "person", 12.0), see(2, "a", "person", 16.0), see(1, "b", "ghost", 0.0)], sight),
        "lights": spark.createDataFrame([(1, 5, 1, 0, "red")], "scenario_id long, lane_id long, t int, place int, status string"), "objects": spark.createDataFrame(objects, obj),
        "groups": spark.createDataFrame([(1, [5], 3)], "scenario_id long, lane_ids array<bigint>, intersection_id long"),
    }
    s = extract.scenarios(raw)
    tracks = {r.track_id: r for r in s.tracks.collect()}
    assert sorted(tracks) == [0, 1] and tracks[1].type == 2 and tracks[1].valid == [1, 0, 1] and [v.x for v in tracks[1].velocity] == [4, 0, 4] and tracks[1].position[2].x == 5 and tracks[0].position[1].z == 0
    e = {r.element_id: r for r in s.elements.collect()}
    assert sorted(e) == [5, 6] and e[5].in_junction and e[5].polyline[0].x == -1 and e[5].polyline[0].z == 0 and e[5].exit_lanes == [] and e[6].type == 20
    assert [(r.light_id, r.states) for r in s.lights.collect()] == [(5, [0, 1, 0])] and s.zones.first().controlled_lanes == [5]
    with pytest.raises(ValueError, match="ego"):
        extract.scenarios(raw | {"ego": raw["ego"].filter("t < 2")})
    assert _header(spark).count() == 1
