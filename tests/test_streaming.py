"""Streams give what batches give."""

import datetime

from roadloom.functions import codec
from roadloom.streaming import watch
from tests.test_operators import _scenario


def _all(stream, name, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name).collect()


def test_files_of_a_folder(spark, tmp_path):
    data = codec.encode(_scenario())
    (tmp_path / "a.bin").write_bytes(data)
    (tmp_path / "b.bin").write_bytes(data[:40])
    got = _all(watch.scenarios(spark, str(tmp_path)), "files", "append")
    assert sorted((r.path[-5:], r.error is None, r.name) for r in got) == [("a.bin", True, "scn"), ("b.bin", False, None)]


def test_extents_in_windows(spark, tmp_path):
    at = lambda s: datetime.datetime(2024, 1, 1, 0, 0, s)
    rows = [(1, 1, at(1), 0.0, 5.0, 1), (1, 1, at(4), 3.0, 2.0, 1), (1, 1, at(6), 99.0, 2.0, 0), (1, 1, at(12), 7.0, 7.0, 1), (2, 9, at(2), 1.0, 1.0, 1)]
    ddl = "scenario_id long, track_id long, ts timestamp, x double, y double, valid int"
    spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "f"))
    got = _all(watch.live_extents(spark.readStream.schema(ddl).parquet(str(tmp_path / "f"))), "extents", "complete")
    assert sorted((r.scenario_id, r.track_id, r.start.second, r.frames, r.min_x, r.max_x, r.max_y) for r in got) == [(1, 1, 0, 2, 0, 3, 5), (1, 1, 10, 1, 7, 7, 7), (2, 9, 0, 1, 1, 1, 1)]
