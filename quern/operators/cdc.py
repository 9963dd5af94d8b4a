"""Change capture between two keyed snapshots: what to add, update and delete, and which fields changed.

Everything here plans; writing is the store's business, so a dry run is a plan that is not applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def record_hash(columns) -> Column:
    """SHA-256 of the record as JSON with fields in the given order, null fields included."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def same(kind: str, a: Column, b: Column) -> Column:
    """Lists are compared as sets, other values as they are; null equals null."""
    if kind.startswith("array"):
        return a.eqNullSafe(b) | ((F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0))
    return a.eqNullSafe(b)


def _fields(df: DataFrame, key: str, compare) -> list[tuple[str, str]]:
    return [(c, t) for c, t in df.dtypes if c != key and (compare is None or c in compare)]


def plan(old: DataFrame, new: DataFrame, key: str, compare=None) -> DataFrame:
    """(key, op, old, new): op is add, update, delete or none; old and new are the records as structs, null where absent."""
    fields = _fields(old, key, compare)
    o = old.select(F.col(key).alias("__k"), F.struct(*old.columns).alias("old")).alias("o")
    n = new.select(F.col(key).alias("__k"), F.struct(*old.columns).alias("new")).alias("n")
    joined = o.join(n, F.col("o.__k") == F.col("n.__k"), "full")
    equal = F.lit(True)
    for c, t in fields:
        equal = equal & same(t, F.col("old")[c], F.col("new")[c])
    op = F.when(F.col("old").isNull(), "add").when(F.col("new").isNull(), "delete").when(~equal, "update").otherwise("none")
    return joined.select(F.coalesce("o.__k", "n.__k").alias(key), op.alias("op"), "old", "new")


def field_changes(ops: DataFrame, key: str, fields: list[tuple[str, str]]) -> DataFrame:
    """Long form of the updates: (key, field, prior, new, added, removed), values as text, lists as what came and went."""
    rows = []
    for c, t in fields:
        a, b = F.col("old")[c], F.col("new")[c]
        if t.startswith("array"):
            text = lambda x: F.array_join(F.array_sort(x), "|")
            none = F.lit(None).cast("string")
            row = F.struct(F.lit(c).alias("field"), none.alias("prior"), none.alias("new"), text(F.array_except(b, a)).alias("added"), text(F.array_except(a, b)).alias("removed"))
        else:
            none = F.lit(None).cast("string")
            row = F.struct(F.lit(c).alias("field"), a.cast("string").alias("prior"), b.cast("string").alias("new"), none.alias("added"), none.alias("removed"))
        rows.append(F.when(~same(t, a, b), row))
    changed = ops.where("op = 'update'").select(key, F.explode(F.array_compact(F.array(*rows))).alias("c"))
    return changed.select(key, "c.*")


def counters(ops: DataFrame) -> DataFrame:
    """Per operation the number of records; an add is not also an update."""
    return ops.groupBy("op").agg(F.count("*").alias("n"))


def missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Keys of target that source lacks."""
    return target.select(key).join(source.select(key), key, "left_anti")


def tolerated(lost: DataFrame, most: int) -> DataFrame:
    """The lost keys if they are at most `most`, else none: a larger loss is taken for a broken pull."""
    n = lost.agg(F.count("*").alias("__n"))
    return lost.crossJoin(F.broadcast(n)).where(F.col("__n") <= most).drop("__n")  # n is one row


def only_deletable(ops: DataFrame, deletable: DataFrame, key: str) -> DataFrame:
    """The operations with deletes outside deletable (key) turned into none: those records stay as they are."""
    may = deletable.select(F.col(key).alias("__k")).distinct().withColumn("__may", F.lit(True))
    kept = (F.col("op") == "delete") & F.col("__may").isNull()
    return ops.join(may, F.col(key) == F.col("__k"), "left").withColumn("op", F.when(kept, "none").otherwise(F.col("op"))).drop("__k", "__may")


def apply(ops: DataFrame, key: str, *, now: int, columns: list[str], deletable: DataFrame | None = None) -> DataFrame:
    """The snapshot after the operations: columns, and data_updated, which is now for what was added or updated and else what
    the old record has (null if it has none). Deletes outside deletable (key) are not made."""
    if deletable is not None:
        ops = only_deletable(ops, deletable, key)
    fresh = F.col("op").isin("add", "update")
    record = F.when(fresh, F.col("new")).otherwise(F.col("old"))
    stamped = "data_updated" in ops.schema["old"].dataType.names
    before = F.col("old")["data_updated"].cast("long") if stamped else F.lit(None).cast("long")
    live = ops.where("op <> 'delete'").select(record.alias("r"), F.when(fresh, F.lit(now).cast("long")).otherwise(before).alias("data_updated"))
    return live.select(*(F.col("r")[c].alias(c) for c in columns if c != "data_updated"), "data_updated")


def lost_with(target: DataFrame, source: DataFrame, key: str, details: DataFrame) -> DataFrame:
    """Keys of target that source lacks, with what details knows of them."""
    return missing(target, source, key).join(details, key)


def upsert_if_changed(current: DataFrame, stats: DataFrame, key: str, *, force: bool = False) -> DataFrame:
    """Rows of stats that are new or differ from current in any field (all of them if forced); absent rows of current stay."""
    fields = [c for c in stats.columns if c != key]
    c, s = current.alias("c"), stats.alias("s")
    joined = s.join(c, F.col(f"s.{key}") == F.col(f"c.{key}"), "left")
    differ = F.lit(force)
    for f in fields:
        differ = differ | ~F.col(f"s.{f}").eqNullSafe(F.col(f"c.{f}"))
    return joined.where(differ | F.col(f"c.{key}").isNull()).select("s.*")
