"""A folder of binary scenarios watched as it fills, and frames of tracks as they come in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import binary

KEY = "scenario_id"


def scenarios(spark: SparkSession, folder: str, static: bool = False) -> DataFrame:
    """Each new .bin file under a folder as a row; a file that can't be read gives a row with its error."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.bin").load(folder)
    return binary.decoded(files, static)


def live_extents(frames: DataFrame, width: str = "10 seconds", late: str = "5 seconds") -> DataFrame:
    """Box and valid frames of each track in windows of event time; frames (scenario_id, track_id, ts, x, y, valid) that are later than ``late`` are dropped, so that state stays bounded."""
    seen = frames.filter("valid = 1").withWatermark("ts", late)
    out = seen.groupBy(F.window("ts", width), KEY, "track_id").agg(F.count("*").alias("frames"), *(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))))
    return out.select(KEY, "track_id", F.col("window.start").alias("start"), "frames", "min_x", "max_x", "min_y", "max_y")
