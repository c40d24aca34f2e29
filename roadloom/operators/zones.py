"""Speed zones: a kernel per scenario, and components of links as DataFrame rounds."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import zones as Z
from ..schema import is_lane

KEY = "scenario_id"


def _xy(points) -> np.ndarray | None:
    return None if points is None else np.array([(p["x"], p["y"]) for p in points], dtype=np.float64).reshape(-1, 2)


def speed_zones(elements: DataFrame, least: float = Z.SHORT, gap: float = Z.GAP) -> DataFrame:
    """``elements`` with speed_zone_idx; elements that are no lanes keep theirs."""
    columns = ["element_id", "seq", "polyline", "speed_limit_mps", "entry_lanes", "exit_lanes", "left_boundary", "left_neighbor", "lane_group_id", "in_junction"]

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("seq")
        ids = lambda x: [] if x is None else [int(i) for i in x]
        lanes = [
            Z.Lane(int(r.element_id), _xy(r.polyline), float(r.speed_limit_mps), ids(r.entry_lanes), ids(r.exit_lanes), _xy(r.left_boundary), bool(ids(r.left_neighbor)), None if pd.isna(r.lane_group_id) else int(r.lane_group_id), bool(r.in_junction))
            for r in f.itertuples(index=False)
        ]
        got = Z.zones(lanes, least, gap)
        return pd.DataFrame({KEY: f[KEY].iloc[0], "element_id": list(got), "_zone": np.array(list(got.values()), dtype=np.int32)})

    lanes = elements.filter(is_lane() & (F.size("polyline") >= 2)).select(KEY, *columns)
    found = lanes.groupBy(KEY).applyInPandas(run, f"{KEY} long, element_id long, _zone int")
    return elements.join(found, [KEY, "element_id"], "left").withColumn("speed_zone_idx", F.coalesce("_zone", "speed_zone_idx")).drop("_zone").select(*elements.columns)


def extents(vertices: DataFrame, members: DataFrame) -> DataFrame:
    """Diagonal of the box around each zone: ``members`` has (scenario_id, element_id, zone)."""
    v = vertices.join(members, [KEY, "element_id"]).groupBy(KEY, "zone").agg(*(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("lo", F.min), ("hi", F.max))))
    d = lambda c: (F.col(f"hi_{c}") - F.col(f"lo_{c}")) * (F.col(f"hi_{c}") - F.col(f"lo_{c}"))
    return v.select(KEY, "zone", F.sqrt(d("x") + d("y")).alias("extent"))


def components(nodes: DataFrame, links: DataFrame, cut) -> DataFrame:
    """The least element of each node's component: labels pass along links and jump; ``cut`` writes a round's labels and reads them again."""
    pairs = links.select(KEY, "a", "b").unionByName(links.select(KEY, F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = cut(pairs)
    labels = cut(nodes.select(KEY, F.col("element_id").alias("a"), F.col("element_id").alias("label")))
    while True:
        near = pairs.join(labels.select(KEY, F.col("a").alias("b"), "label"), [KEY, "b"]).groupBy(KEY, "a").agg(F.min("label").alias("low"))
        low = labels.join(near, [KEY, "a"], "left").select(KEY, "a", F.col("label").alias("old"), F.least("label", F.coalesce("low", "label")).alias("label"))
        jump = low.select(KEY, F.col("a").alias("label"), F.col("label").alias("further"))
        new = cut(low.join(jump, [KEY, "label"]).select(KEY, "a", "old", F.least("label", "further").alias("label")))
        labels = new.select(KEY, "a", "label")
        if new.filter("old <> label").isEmpty():
            return labels.select(KEY, F.col("a").alias("element_id"), F.col("label").alias("zone"))
