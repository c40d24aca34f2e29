"""Binary scenario files as tables, and tables as binary files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import codec
from ..schema import POINTS, Scenarios, geometry

KEY = "scenario_id"
_TRACK = (
    f"id long, type int, position {POINTS}, heading array<double>, velocity array<struct<x:double,y:double>>, valid array<int>, length array<double>, width array<double>, height array<double>"
)
_ELEMENT = f"id long, type int, points {POINTS}, entry_lanes array<bigint>, exit_lanes array<bigint>, speed_limit_mps double, length double, cum_length array<double>, width array<double>, speed_zone_idx int"
_CONTROL = f"id long, type int, stop_line {POINTS}, heading double, states array<int>, controlled_lanes array<bigint>, junction_id long, phase_idx int"
SCENARIO = (
    f"path string, error string, name string, dataset string, scenario_length int, dt double, objects_of_interest array<bigint>, tracks_to_predict array<bigint>, "
    f"agents array<struct<{_TRACK}, route array<bigint>, route_gt_len int, control_state int, goal array<double>>>, objects array<struct<{_TRACK}>>, elements array<struct<{_ELEMENT}>>, "
    f"controls array<struct<{_CONTROL}>>, lane_ids array<bigint>, distances array<double>"
)


def _points(a) -> list[dict]:
    return [dict(zip("xyz", map(float, p), strict=False)) for p in np.asarray(a).tolist()]


def _rows(p) -> np.ndarray:
    return np.array([tuple(q.values()) if isinstance(q, dict) else tuple(q) for q in p], dtype=np.float64)


def to_row(s: dict, path: str = "") -> dict:
    """A decoded scenario as a row of SCENARIO."""
    track = lambda t: t | {"position": _points(t["position"]), "velocity": _points(t["velocity"])} | {k: np.asarray(t[k], dtype=float).tolist() for k in ("heading", "length", "width", "height")}

    def element(e: dict) -> dict:
        blank = dict.fromkeys(("entry_lanes", "exit_lanes", "speed_limit_mps", "length", "cum_length", "width", "speed_zone_idx"))
        return blank | e | {"points": _points(e["points"])} | {k: np.asarray(e[k]).tolist() for k in ("cum_length", "width") if e.get(k) is not None}

    m, g = s["meta"], s["graph"]
    return {
        "path": path, "error": None, "name": m["id"], "dataset": m["dataset"], "scenario_length": m["scenario_length"], "dt": m["dt"], "objects_of_interest": m["objects_of_interest"], "tracks_to_predict": m["tracks_to_predict"],
        "agents": [track(t) for t in s["agents"]], "objects": [track(t) for t in s["objects"]], "elements": [element(e) for e in s["elements"]], "controls": [c | {"stop_line": _points(c["stop_line"])} for c in s["controls"]],
        "lane_ids": g["lane_ids"] if g else [], "distances": np.asarray(g["distances"]).ravel().tolist() if g else [],
    }


def from_row(r: dict) -> dict:
    """The scenario of a row of SCENARIO, as ``codec.encode`` takes it."""
    track = lambda t: dict(t) | {"position": _rows(t["position"]), "velocity": _rows(t["velocity"])}
    n = len(r["lane_ids"])
    return {
        "agents": [track(t) for t in r["agents"]], "objects": [track(t) for t in r["objects"]], "elements": [dict(e) | {"points": _rows(e["points"])} for e in r["elements"]],
        "controls": [dict(c) | {"stop_line": _rows(c["stop_line"])} for c in r["controls"]], "graph": {"lane_ids": list(r["lane_ids"]), "distances": np.asarray(r["distances"], dtype=float).reshape(n, n)} if n else None,
        "meta": {"id": r["name"], "dataset": r["dataset"], "scenario_length": r["scenario_length"], "dt": r["dt"], "objects_of_interest": list(r["objects_of_interest"]), "tracks_to_predict": list(r["tracks_to_predict"])},
    }


def decoded(files: DataFrame, static: bool = False) -> DataFrame:
    """``files`` (path, content) as rows of SCENARIO; a file that can't be read gives a row with its ``error`` and nothing else."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for path, data in zip(f["path"], f["content"], strict=True):
                try:
                    out.append(to_row(codec.decode(bytes(data), path, static), path))
                except codec.StaticBinaryError as e:
                    out.append({"path": path, "error": str(e)})
            if out:
                yield pd.DataFrame(out).reindex(columns=_COLUMNS).astype(object).where(lambda d: d.notna(), None) if any(r["error"] for r in out) else pd.DataFrame(out, columns=_COLUMNS)

    return files.select("path", "content").mapInPandas(run, SCENARIO)


_COLUMNS = ["path", "error", "name", "dataset", "scenario_length", "dt", "objects_of_interest", "tracks_to_predict", "agents", "objects", "elements", "controls", "lane_ids", "distances"]


def read(spark: SparkSession, path: str, static: bool = False) -> DataFrame:
    """All .bin files under a path, of any file system that Spark reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").option("recursiveFileLookup", "true").load(path)
    return decoded(files, static)


def encoded(scenarios: DataFrame) -> DataFrame:
    """(path, content, error) of rows of SCENARIO; a scenario that can't be written has an error in place of content."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                try:
                    out.append((r["path"], codec.encode(from_row(r)), None))
                except (ValueError, KeyError, TypeError) as e:
                    out.append((r["path"], None, str(e)))
            yield pd.DataFrame(out, columns=["path", "content", "error"])

    return scenarios.mapInPandas(run, "path string, content binary, error string")


def write(scenarios: DataFrame, folder: str, overwrite: bool = False) -> DataFrame:
    """Write one file per scenario into a folder that all executors share and return (path, ok, error); a file appears whole or not at all, and is replaced only with ``overwrite``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os
        import uuid

        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        system.create_dir(base, recursive=True)
        for f in frames:
            out = []
            for path, data, error in zip(f["path"], f["content"], f["error"], strict=True):
                at = f"{base}/{os.path.basename(path)}"
                if error is None and not overwrite and system.get_file_info(at).type != fs.FileType.NotFound:
                    error = f"{at} exists"
                if error is None:
                    part = f"{base}/.{os.path.basename(path)}.{uuid.uuid4().hex}"
                    with system.open_output_stream(part) as o:
                        o.write(bytes(data))
                    system.move(part, at)
                out.append((at, error is None, error))
            yield pd.DataFrame(out, columns=["path", "ok", "error"])

    return encoded(scenarios).mapInPandas(run, "path string, ok boolean, error string")


def map_rows(scenarios: DataFrame) -> DataFrame:
    """One row per map element of decoded scenarios."""
    return scenarios.filter("error is null").select("path", F.posexplode("elements").alias("seq", "e")).select("path", "seq", "e.*")


def from_tables(s: Scenarios, names: DataFrame) -> DataFrame:
    """Rows of SCENARIO from scenario tables: one row per scenario, entities in their order, ``names`` gives the path. Scenarios come with all their tables or empty lists."""
    ordered = lambda df, fields, out: df.groupBy(KEY).agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", F.struct(*fields).alias("e")))), lambda x: x["e"]).alias(out))
    track = [F.col("track_id").alias("id"), "type", "position", "heading", "velocity", "valid", "length", "width", "height"]
    on = F.filter(F.arrays_zip("position", "valid"), lambda f: f["valid"] > 0)
    goal = F.when(F.size(on) > 0, F.element_at(on, -1)["position"])
    zero = F.lit(0.0)
    goal = F.array(*(F.coalesce(goal[c], zero) for c in "xyz")).alias("goal")
    agents = ordered(s.tracks.filter("kind = 'agent'"), [*track, "route", "route_gt_len", "control_state", goal], "agents")
    objects = ordered(s.tracks.filter("kind = 'object'"), track, "objects")
    points = geometry().alias("points")
    element = [F.col("element_id").alias("id"), "type", points, "entry_lanes", "exit_lanes", "speed_limit_mps", "length", "cum_length", "width", "speed_zone_idx"]
    rows = s.header.join(names.select(KEY, "path"), KEY).join(ordered(s.elements, element, "elements"), KEY, "left").join(agents, KEY, "left").join(objects, KEY, "left")
    if s.controls is not None:
        control = [F.col("control_id").alias("id"), "type", "stop_line", "heading", "states", "controlled_lanes", "junction_id", "phase_idx"]
        rows = rows.join(ordered(s.controls, control, "controls"), KEY, "left")
    if s.distances is not None:
        cells = F.array_sort(F.collect_list(F.struct("src_pos", "dst_pos", "distance")))
        ids = F.array_sort(F.collect_list(F.when(F.col("src_pos") == F.col("dst_pos"), F.struct("src_pos", "src"))))
        graph = s.distances.groupBy(KEY).agg(F.transform(cells, lambda c: c["distance"]).alias("distances"), F.transform(ids, lambda c: c["src"]).alias("lane_ids"))
        rows = rows.join(graph, KEY, "left")
    wanted = {f.name: f.dataType for f in _schema().fields}
    blank = {"error": F.lit(None).cast("string")}
    for c in ("agents", "objects", "elements", "controls", "lane_ids", "distances"):
        blank[c] = F.coalesce(F.col(c), F.array().cast(wanted[c])) if c in rows.columns else F.array().cast(wanted[c])
    return rows.withColumns(blank).select(*(F.col(c).cast(t).alias(c) for c, t in wanted.items()))


def _schema() -> StructType:
    return StructType.fromDDL(SCENARIO)


def transformed(scenarios: DataFrame, catalogue: dict) -> DataFrame:
    """Rows of SCENARIO with a ``variant`` under that variant's matrix (none for the empty name): geometry about the mean vertex, widths, stop lines, headings, lengths and the lane graph."""
    from ..functions.polylines import arc_lengths, densified
    from ..operators.affine import LONGEST, stretched_widths, stretches
    from ..operators.graph import distances_from

    def vary(s: dict, m) -> dict:
        every = np.concatenate([e["points"][:, :2] for e in s["elements"] if len(e["points"])])
        centre, matrix = every.mean(axis=0), np.array(m).reshape(2, 2)

        def move(xyz: np.ndarray) -> np.ndarray:
            out = np.array(xyz, dtype=np.float64)
            out[:, :2] = (out[:, :2] - centre) @ matrix.T + centre
            return out

        for e in s["elements"]:
            old, new = e["points"], move(e["points"])
            fine = densified(new, LONGEST) if stretches(m) else new
            if 0 <= e["type"] <= 9:
                e["width"] = np.interp(arc_lengths(fine), arc_lengths(new), stretched_widths(np.asarray(e["width"], dtype=float), old[:, :2], m))
                e["cum_length"] = arc_lengths(fine)
                e["length"] = float(e["cum_length"][-1]) if len(fine) else 0.0
            e["points"] = fine
        for c in s["controls"]:
            c["stop_line"] = move(c["stop_line"])
            x, y = matrix @ [np.cos(c["heading"]), np.sin(c["heading"])]
            c["heading"] = float(np.arctan2(y, x))
        lanes = [e for e in s["elements"] if e["type"] in (1, 2)]
        ids = [e["id"] for e in lanes]
        d = distances_from(ids, ids, {e["id"]: e["length"] for e in lanes}, {e["id"]: list(e["exit_lanes"]) for e in lanes})
        return s | {"graph": {"lane_ids": ids, "distances": d} if ids else None}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = [r if not r["variant"] else to_row(vary(from_row(r), catalogue[r["variant"]]), r["path"]) for r in f.to_dict("records")]
            yield pd.DataFrame(out).reindex(columns=_COLUMNS)

    return scenarios.mapInPandas(run, SCENARIO)
