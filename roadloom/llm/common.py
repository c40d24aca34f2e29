"""Shared helpers of the training-data operators.

Intermediate tables go to the folder that the cluster names in ``spark.checkpoint.dir``; only where that is unset
and the master is local (tests, notebooks) is a folder of our own made, which goes at exit. On a cluster without the
setting nothing is written and an error says so.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows per Arrow batch that go to a Python worker: texts may be long, so batches stay small.
ARROW_ROWS = 512

_own_dir: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``, else one made here for local sessions."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dir:
        path = tempfile.mkdtemp(prefix="roadloom-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _own_dir[app] = f"file://{path}"
    return _own_dir[app]


def small_batches(spark: SparkSession) -> None:
    """Lower the Arrow batch size where it is larger; a batch of long texts must fit in a worker. The session keeps the setting, as results are computed later."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


_made: list[tuple[SparkSession, str]] = []


def _clear() -> None:
    """Remove all scratch tables of this program, if its session's JVM still answers."""
    for spark, base in _made:
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(base)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # noqa: BLE001  the program ends; nothing is left to do
            return


atexit.register(_clear)


class Scratch:
    """Written tables that cut lineage; ``drop`` frees those that later steps no longer read, and the program's end all others (results may be read until then)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        _made.append((spark, self.base))
        self._n = 0

    def cut(self, df: DataFrame) -> DataFrame:
        """``df`` written as Parquet and read again."""
        self._n += 1
        path = f"{self.base}/{self._n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete what ``cut`` wrote for these tables."""
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_rows(df: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (and ``more``), by name only, so that other columns can't clash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def fold(id_column: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    c = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def rank_in_sample(id_column: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone, the same in each run, to draw bounded samples."""
    return F.pmod(F.xxhash64(F.col(id_column), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
