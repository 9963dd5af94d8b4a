"""Checks on pulls and stores; each gives rows to look at, none stops a job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_ids(rows: DataFrame, key: str, inner: str | None = None) -> DataFrame:
    """One row: n_rows, n_ids, n_mismatched (rows whose inner id differs from the outer) and ok."""
    other = F.count_if(F.col(key) != F.col(inner)) if inner else F.lit(0).cast("long")
    out = rows.agg(F.count("*").alias("n_rows"), F.count_distinct(key).alias("n_ids"), other.alias("n_mismatched"))
    return out.withColumn("ok", (F.col("n_rows") == F.col("n_ids")) & (F.col("n_mismatched") == 0))


def full_pull(files: DataFrame, paging: DataFrame) -> DataFrame:
    """Per product (product, n_files, expected, full): files against max_multiple / base_multiple + 1."""
    expected = F.when(F.col("max_multiple") == 0, 1).otherwise(F.floor(F.col("max_multiple") / F.col("base_multiple")) + 1).cast("long")
    have = files.groupBy("product").agg(F.count("*").alias("n_files"))
    out = paging.select("product", expected.alias("expected")).join(have, "product", "left").withColumn("n_files", F.coalesce("n_files", F.lit(0)).cast("long"))
    return out.select("product", "n_files", "expected", (F.col("n_files") == F.col("expected")).alias("full"))


def page_ratio(pages: DataFrame, key: str, ok: str, least: float = 0.9) -> DataFrame:
    """Per document the share of pages that could be read, and whether it is above `least`."""
    return pages.groupBy(key).agg(F.avg(F.col(ok).cast("double")).alias("ratio")).withColumn("accepted", F.col("ratio") > least)


def consistent(index: DataFrame, payloads: DataFrame, key: str) -> DataFrame:
    """(key, problem) of index rows without payload and payloads without index row; empty if the store is sound."""
    a = index.select(key).join(payloads.select(key), key, "left_anti").withColumn("problem", F.lit("no payload"))
    b = payloads.select(key).join(index.select(key), key, "left_anti").withColumn("problem", F.lit("not in index"))
    return a.unionByName(b)


def retry_candidates(rows: DataFrame, have: DataFrame, key: str, *, now_ms: int, refresh: bool = False, retry: bool = False, days: int = 14, tag: str = "missing") -> DataFrame:
    """Records whose text should be fetched: those we have only on refresh; others if untagged, on retry, or recent."""
    h = have.select(F.col(key).alias("__k"))
    recent = F.col("created_ms") > now_ms - days * 86_400_000
    wanted = F.when(F.col("__k").isNotNull(), F.lit(refresh)).otherwise(~F.array_contains("tags", tag) | F.lit(retry) | recent)
    return rows.join(h, F.col(key) == F.col("__k"), "left").where(wanted).drop("__k")
