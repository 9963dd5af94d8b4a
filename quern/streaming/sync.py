"""The store's sync as a stream: each micro-batch is one change-capture run, so batch and stream share their code."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.store import Store, last_of


def latest(rows: DataFrame, key: str, at: str) -> DataFrame:
    """One row a key, the one of greatest (at, all fields)."""
    return last_of(rows, key, at)


def run_available(source: DataFrame, store: Store, checkpoint: str, *, at: str, now: Callable[[], int] = lambda: time.time_ns() // 1_000_000) -> None:
    """Take what is there, batch by batch, into the store and stop. The store orders records by `at` (its newest_by): rows that come
    late, and batches that come again, change nothing. Only the buckets of a batch's keys are read and written."""
    if store.newest_by != at or at not in store.fields:
        raise ValueError(f"the store must hold {at} and order its records by it")

    def batch(rows: DataFrame, number: int) -> None:
        store.sync(latest(rows, store.key, at).select(store.key, *store.fields), now=now(), full=False)

    query = source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def daily_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Events by day and type over event time with a watermark; works on streams and tables alike."""
    stamped = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return stamped.groupBy(F.window("at", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "event_type", "n")


def event_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(folder)
