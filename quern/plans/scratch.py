"""Where jobs keep what they write on the way."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


def _clear() -> None:
    for spark, path in _made:
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session may have been stopped
            return


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local folder only where that is unset and Spark runs in one process."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below root; it goes when the driver ends."""
    path = f"{root(spark)}/quern-{name}-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_clear)
    _made.append((spark, path))
    return path


def written(rows: DataFrame, name: str) -> DataFrame:
    """rows, written to a new folder and read back."""
    path = folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
