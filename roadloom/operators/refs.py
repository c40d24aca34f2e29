"""Identity of scenario entities: dense ids, references, and elements that can't be written."""

from __future__ import annotations

import dataclasses

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import REFS, Scenarios, geometry, is_lane, min_points

KEY = "scenario_id"


def id_maps(entities: DataFrame, id_column: str, *keys: str) -> DataFrame:
    """Per scenario (and ``keys``) one row with ``ids``, a map from each id to its place from 0 in order of ``seq``."""
    one = F.array_sort(F.collect_list(F.struct("seq", F.col(id_column).cast("long").alias("id"))))
    dense = F.transform(one, lambda e, i: F.struct(e["id"].alias("key"), i.cast("long").alias("value")))
    return entities.groupBy(KEY, *keys).agg(F.map_from_entries(dense).alias("ids"))


def _through(refs: Column, ids: Column) -> Column:
    """References through a map of ids, in order; unknown ones go."""
    return F.filter(F.transform(refs, lambda r: F.try_element_at(ids, r)), lambda r: r.isNotNull())


def remap_refs(elements: DataFrame, maps: DataFrame) -> DataFrame:
    """All lists of references through the ``ids`` of their scenario."""
    out = elements.join(maps, KEY, "left")
    return out.withColumns({c: _through(F.col(c), F.col("ids")) for c in REFS}).drop("ids")


def remap_routes(tracks: DataFrame, maps: DataFrame) -> DataFrame:
    """Routes through the map's ids; their observed part is no longer than what is left."""
    out = tracks.join(maps, KEY, "left").withColumn("route", F.coalesce(_through(F.col("route"), F.col("ids")), F.array().cast("array<bigint>"))).drop("ids")
    return out.withColumn("route_gt_len", F.least("route_gt_len", F.size("route")))


def reindex(s: Scenarios) -> Scenarios:
    """All ids dense from 0 in the order of their table; references to what is gone vanish."""
    maps = id_maps(s.elements, "element_id")
    elements = remap_refs(s.elements, maps).join(maps, KEY).withColumn("element_id", F.col("ids")[F.col("element_id")]).drop("ids")
    own = id_maps(s.tracks, "track_id", "kind")
    tracks = remap_routes(s.tracks, maps).join(own, [KEY, "kind"]).withColumn("track_id", F.col("ids")[F.col("track_id")]).drop("ids")
    header = s.header.join(own.filter("kind = 'agent'").drop("kind"), KEY, "left")
    none = F.array().cast("array<bigint>")
    header = header.withColumns({c: F.coalesce(_through(F.col(c), F.col("ids")), none) for c in ("objects_of_interest", "tracks_to_predict")}).drop("ids")
    controls, distances = s.controls, s.distances
    if controls is not None:
        place = (F.row_number().over(Window.partitionBy(KEY).orderBy("seq")) - 1).cast("long")
        controls = controls.join(maps, KEY, "left").withColumns({"control_id": place, "controlled_lanes": _through(F.col("controlled_lanes"), F.col("ids"))}).drop("ids")
    if distances is not None:
        at = lambda c: F.try_element_at(F.col("ids"), F.col(c))
        distances = distances.join(maps, KEY).withColumns({"src": at("src"), "dst": at("dst")}).filter("src is not null and dst is not null").drop("ids")
        order = lambda c: (F.dense_rank().over(Window.partitionBy(KEY).orderBy(f"{c}_pos")) - 1).cast("int")
        distances = distances.withColumns({"src_pos": order("src"), "dst_pos": order("dst")})
    return dataclasses.replace(s, header=header, tracks=tracks, elements=elements, controls=controls, distances=distances)


def writable() -> Column:
    """Whether an element has the points that it needs."""
    return F.coalesce(F.size(geometry()) >= min_points(), F.lit(False))


def prune(s: Scenarios) -> Scenarios:
    """Without elements that have too few points, and without references, routes, lights and stop zones that point at nothing."""
    kept = s.elements.filter(writable())
    same = kept.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("element_id", "element_id"))).alias("ids"))
    out = dataclasses.replace(s, elements=remap_refs(kept, same), tracks=remap_routes(s.tracks, same))
    lanes = kept.filter(is_lane()).select(KEY, "element_id")
    if s.lights is not None:
        out = dataclasses.replace(out, lights=s.lights.join(lanes.withColumnRenamed("element_id", "controlled_lane"), [KEY, "controlled_lane"], "left_semi").select(*s.lights.columns))
    if s.zones is not None:
        ids = lanes.groupBy(KEY).agg(F.map_from_entries(F.collect_list(F.struct("element_id", "element_id"))).alias("ids"))
        zones = s.zones.join(ids, KEY).withColumn("controlled_lanes", _through(F.col("controlled_lanes"), F.col("ids"))).drop("ids")
        out = dataclasses.replace(out, zones=zones.filter(F.size("controlled_lanes") > 0).select(*s.zones.columns))
    return out
