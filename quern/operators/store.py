"""Keyed record store: a versioned snapshot with change log, tombstones and tags.

Snapshot, log and tombstones of a run are one commit (see `versions`), so a failed run leaves the store as it was, a repeated
one adds nothing twice, and of two runs at the same time the second is made again or refused. Records are dealt to buckets by key.
Changes of some records are written beside their buckets and merged when they are read; a run that changes a large part writes the
buckets anew."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cdc
from .versions import Versions


def tag_add(tags: Column, tag: str) -> Column:
    return F.array_union(tags, F.array(F.lit(tag)))


def tag_remove(tags: Column, tag: str) -> Column:
    return F.array_remove(tags, tag)


def tag_replace(tags: Column, old: str, new: str) -> Column:
    """Only where the old tag is present."""
    return F.when(F.array_contains(tags, old), F.array_union(F.array_remove(tags, old), F.array(F.lit(new)))).otherwise(tags)


#: Changes of single records that are kept as such until their bucket is compacted: name -> (column, function of value and arguments).
PATCHES = {
    "add tag": ("tags", lambda tags, a: F.array_union(tags, a)),
    "remove tag": ("tags", lambda tags, a: F.array_except(tags, a)),
    "replace tag": ("tags", lambda tags, a: F.when(F.array_contains(tags, F.get(a, F.lit(0))), F.array_union(F.array_except(tags, F.slice(a, 1, 1)), F.slice(a, 2, 1))).otherwise(tags)),
    "tags": ("tags", lambda tags, a: a),
    "hash": ("hash", lambda hash_, a: F.get(a, F.lit(0))),
}
MANY = 4  # a run that changes more than one record in so many writes the buckets anew


def tagged(rows: DataFrame, tag: str) -> DataFrame:
    return rows.where(F.array_contains("tags", tag))


def with_tags(rows: DataFrame) -> DataFrame:
    """Rows that carry any tag."""
    return rows.where(F.size("tags") > 0)


def between(rows: DataFrame, column: str, after: int | None = None, before: int | None = None) -> DataFrame:
    """Rows with after < column < before, in epoch milliseconds; a missing bound is none."""
    if after is not None:
        rows = rows.where(F.col(column) > after)
    return rows if before is None else rows.where(F.col(column) < before)


def tombstones(ops: DataFrame, earlier: DataFrame | None, key: str) -> DataFrame:
    """(key, n, old): deleted records, numbered by the deletions of that key before them."""
    gone = ops.where("op = 'delete'").select(key, "old")
    if earlier is None:
        return gone.select(key, F.lit(1).cast("long").alias("n"), "old")
    before = earlier.groupBy(key).agg(F.count("*").alias("before"))
    return gone.join(before, key, "left").select(key, (F.coalesce("before", F.lit(0)) + 1).alias("n"), "old")


def first_of(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key: the least by the order columns ('-' in front: the greatest first), then by the whole row. Rows without a
    key go. An aggregation, so most rows go before the shuffle."""
    return _one_of(rows, key, order, F.min_by)


def last_of(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row a key: the greatest by the order columns, then by the whole row."""
    return _one_of(rows, key, order, F.max_by)


def _one_of(rows: DataFrame, key: str, order, choose) -> DataFrame:
    others = [c for c in rows.columns if c != key and c not in order]
    sortable = [c for c in others if "map<" not in dict(rows.dtypes)[c]]
    one = choose(F.struct(*rows.columns), F.struct(*order, *sortable))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(one.alias("__one")).select("__one.*")


def newest(versions: DataFrame, keep: int, *order) -> DataFrame:
    """The keep newest rows of a small listing, such as a store's versions."""
    return versions.orderBy(*order).limit(keep)


def sorted_by(rows: DataFrame, key: str, column: str = "data_created", ascending: bool = False) -> DataFrame:
    return rows.orderBy(F.col(column).asc() if ascending else F.col(column).desc(), key)


class Store:
    """Snapshots (key, fields, data_created, data_updated, hash, tags) below a folder.

    newest_by names a field by which records are ordered in time: a record that is not later than the store's (by that field,
    then by all fields) changes nothing, whenever it arrives. created names the field that is a record's date of creation at the
    source; without one it is the time of the run that added it."""

    def __init__(self, spark: SparkSession, folder: str, key: str, fields: list[str], *, newest_by: str | None = None, created: str | None = None, buckets: int = 16):
        self.spark, self.folder, self.key, self.fields = spark, folder.rstrip("/"), key, fields
        self.newest_by, self.created = newest_by, created
        self.versions = Versions(spark, folder, buckets, patches=PATCHES)

    def version(self) -> int:
        """The current version; 0 before the first write."""
        return self.versions.version()

    def read(self, version: int | None = None) -> DataFrame:
        return self.versions.read("rows", version)

    def count(self, version: int | None = None) -> int:
        """The number of records."""
        return self.read(version).count()

    def ids(self, version: int | None = None) -> DataFrame:
        """The keys of the records."""
        return self.read(version).select(self.key)

    def table(self, name: str) -> DataFrame | None:
        """changes or tombstones of all versions so far."""
        m = self.versions.manifest()
        return self.versions.read(name, manifest=m) if name in m["schemas"] else None

    def entries(self, ids: DataFrame, *columns: str) -> DataFrame:
        """The records of the keys in ids (all columns, or some, such as data_updated, data_created or hash)."""
        rows = self.read().join(ids.select(self.key).distinct(), self.key, "left_semi")
        return rows.select(self.key, *columns) if columns else rows

    def write(self, rows: DataFrame, logs: dict[str, DataFrame] | None = None) -> int:
        """Replace all records, by a writer that has read none."""
        return self.versions.commit({"rows": (rows, self.key, None)}, logs)

    def prepared(self, rows: DataFrame, now: int) -> DataFrame:
        """New records in the store's form."""
        created = F.col(self.created).cast("long") if self.created else F.lit(now).cast("long")
        return rows.select(self.key, *self.fields, created.alias("data_created"), F.lit(now).cast("long").alias("data_updated"), cdc.record_hash(self.fields).alias("hash"), F.array().cast("array<string>").alias("tags"))

    def _planned(self, old: DataFrame, new: DataFrame, full: bool) -> DataFrame:
        ops = cdc.plan(old, new, self.key, self.fields)
        if not full:  # what a partial pull lacks says nothing
            ops = ops.withColumn("op", F.when(F.col("op") == "delete", "absent").otherwise(F.col("op")))
        if self.newest_by:
            at = [self.newest_by, *(f for f in self.fields if f != self.newest_by)]
            place = lambda side: F.struct(*(F.col(side)[f].alias(f) for f in at))
            late = (F.col("op") == "update") & ~(place("new") > place("old"))
            ops = ops.withColumn("op", F.when(late, "late").otherwise(F.col("op")))
        return ops

    def sync(self, rows: DataFrame, *, now: int, full: bool = True, most_deletions: int | None = None, deletable: DataFrame | None = None, dry_run: bool = False) -> dict[str, int]:
        """Bring the store to rows (one a key). A pull that is not full deletes nothing, nor does one that lost too many; with
        deletable (key) only those records are deleted.

        Returns the counts by operation. A record whose hash differs while its fields are equal gets the new hash and nothing else.
        One version is read throughout; if another run changes it meanwhile, this one ends with versions.Conflict."""
        new = self.prepared(rows, now)
        c = self.versions.begin()
        if not c.at:
            if dry_run:
                return {"add": new.count()}
            c.replace("rows", new, self.key)
            return {"add": self.read(c.commit()).count()}
        seen = None if full else self.versions.touched(new, self.key)  # only the buckets of the new records are read
        old = c.read("rows", seen)
        ops = self._planned(old, new, full)
        if deletable is not None:
            ops = cdc.only_deletable(ops, deletable, self.key)
        ops = ops.withColumn("rehash", F.coalesce((F.col("op") == "none") & (F.col("old")["hash"] != F.col("new")["hash"]), F.lit(False))).persist()
        try:
            counted = {(r.op, r.rehash): r.n for r in ops.groupBy("op", "rehash").agg(F.count("*").alias("n")).collect()}  # six rows
            counts: dict[str, int] = {}
            for (op, _), n in counted.items():
                counts[op] = counts.get(op, 0) + n
            held = sum(counts.values())
            counts.pop("absent", None)
            deletes = most_deletions is None or counts.get("delete", 0) <= most_deletions
            if not full or not deletes:
                counts["delete"] = 0
            moved = sum(counts.get(op, 0) for op in ("add", "update", "delete")) + counted.get(("none", True), 0)
            if moved and not dry_run:
                self._apply(c, old, ops, now, deletes, anew=moved * MANY > held)
        finally:
            ops.unpersist()
        return counts

    def _apply(self, c, old: DataFrame, ops: DataFrame, now: int, deletes: bool, *, anew: bool) -> None:
        moved = ops.where(F.col("rehash") | F.col("op").isin("add", "update", *(("delete",) if deletes else ())))
        fields = [(f, t) for f, t in old.dtypes if f in self.fields]
        o, n = F.col("old"), F.col("new")
        changed = n.withField("tags", o["tags"]) if self.created else n.withField("data_created", o["data_created"]).withField("tags", o["tags"])
        taken = F.when(F.col("op") == "add", n).when(F.col("op") == "update", changed).when(F.col("op") == "none", o.withField("hash", F.coalesce(n["hash"], o["hash"]))).otherwise(o)
        record = lambda some: some.select(taken.alias("r")).select("r.*").select(old.columns)
        if anew:
            touched = self.versions.touched(moved, self.key)
            own = ops.where(self.versions.bucket(self.key).isin(touched))
            c.replace("rows", record(own.where("op <> 'delete'") if deletes else own), self.key, touched)
        else:
            c.put("rows", record(ops.where("op = 'add'")), fresh=True)
            c.put("rows", record(ops.where("op = 'update'")))
            c.patch("rows", ops.where("rehash").select(self.key, F.lit("hash").alias("op"), F.array(n["hash"]).alias("arg")), ["hash"])
            if deletes:
                c.drop("rows", ops.where("op = 'delete'"))
        stamp = F.lit(now).cast("long").alias("ts")
        c.append("changes", cdc.field_changes(ops, self.key, fields).select("*", stamp))
        if deletes:
            c.append("tombstones", self._tombstones(c, ops).select("*", stamp))
        c.commit()
        self.versions.upkeep()

    def _tombstones(self, c, ops: DataFrame) -> DataFrame:
        return tombstones(ops, c.read("tombstones") if c.has("tombstones") else None, self.key)

    def put(self, rows: DataFrame, *, now: int) -> None:
        """Insert or overwrite records, without tags. Writes these records only."""
        c = self.versions.begin()
        new = self.prepared(rows, now)
        if c.has("rows"):
            c.put("rows", new)
        else:
            c.replace("rows", new, self.key)
        c.commit()
        self.versions.upkeep()

    def delete(self, ids: DataFrame, *, now: int, keep: bool = True) -> None:
        """Drop the records of these keys; keep: as tombstones. Writes their keys and tombstones only."""
        c = self.versions.begin()
        self._deleted(c, c.read("rows", self.versions.touched(ids, self.key)), ids, now, keep)
        c.commit()
        self.versions.upkeep()

    def _deleted(self, c, rows: DataFrame, ids: DataFrame, now: int, keep: bool) -> None:
        gone = rows.join(ids.select(self.key).distinct(), self.key, "left_semi")
        c.drop("rows", gone)
        if keep:
            ops = gone.select(self.key, F.lit("delete").alias("op"), F.struct(*rows.columns).alias("old"))
            c.append("tombstones", self._tombstones(c, ops).withColumn("ts", F.lit(now).cast("long")))

    def delete_tagged(self, tag: str, *, now: int, keep: bool = True, dry_run: bool = False) -> DataFrame:
        """Delete the records with a tag; their keys, read from the version before."""
        c = self.versions.begin()
        rows = c.read("rows")
        ids = tagged(rows, tag).select(self.key)
        if not dry_run:
            self._deleted(c, rows, ids, now, keep)
            c.commit()
            self.versions.upkeep()
        return ids

    def set_hash(self, hashes: DataFrame) -> None:
        """Replace the stored hash by that in hashes (key, hash). Writes these hashes only."""
        self._patch(hashes.select(self.key, F.lit("hash").alias("op"), F.array("hash").alias("arg")), ["hash"])

    def _patch(self, rows: DataFrame, ops: list[str]) -> int:
        c = self.versions.begin()
        c.patch("rows", rows, ops)
        version = c.commit()
        self.versions.upkeep()
        return version

    def _tag(self, op: str, tags: list[str], ids: DataFrame | None) -> int:
        if ids is not None:
            return self._patch(ids.select(self.key).distinct().select(self.key, F.lit(op).alias("op"), F.array(*map(F.lit, tags)).alias("arg")), [op])
        c = self.versions.begin()
        c.patch_all("rows", op, tags)
        version = c.commit()
        self.versions.upkeep()
        return version

    def add_tag(self, tag: str, ids: DataFrame | None = None) -> int:
        """Tag the records of ids, which writes their keys, or all of them, which writes a manifest only; the version."""
        return self._tag("add tag", [tag], ids)

    def remove_tag(self, tag: str, ids: DataFrame | None = None) -> int:
        return self._tag("remove tag", [tag], ids)

    def replace_tag(self, old: str, new: str, ids: DataFrame | None = None) -> int:
        """Only where the old tag is present."""
        return self._tag("replace tag", [old, new], ids)

    def retag(self, change, ids: DataFrame | None = None) -> int:
        """Replace tags by change(tags), any function of the column, on all records or those of ids. Writes the records whose tags change."""
        c = self.versions.begin()
        rows = c.read("rows", None if ids is None else self.versions.touched(ids, self.key))
        if ids is not None:
            rows = rows.join(ids.select(self.key).distinct(), self.key, "left_semi")
        new = change(F.col("tags")).cast("array<string>")
        c.patch("rows", rows.where(~new.eqNullSafe(F.col("tags"))).select(self.key, F.lit("tags").alias("op"), new.alias("arg")), ["tags"])
        version = c.commit()
        self.versions.upkeep()
        return version

    def retag_to(self, rows: DataFrame) -> int:
        """Bring the tags of records to those in rows (key, tags), which were read from this store. Writes what differs."""
        c = self.versions.begin()
        now = c.read("rows").select(self.key, F.col("tags").alias("__now"))
        moved = rows.select(self.key, "tags").join(now, self.key).where(~F.col("tags").eqNullSafe(F.col("__now")))
        c.patch("rows", moved.select(self.key, F.lit("tags").alias("op"), F.col("tags").alias("arg")), ["tags"])
        version = c.commit()
        self.versions.upkeep()
        return version

    def retain(self, keep: int = 48, **options) -> None:
        """Drop all but the newest versions."""
        self.versions.retain(keep, **options)

    def wipe(self) -> None:
        """Drop the records; change log and tombstones stay."""
        c = self.versions.begin()
        if c.at:
            c.replace("rows", c.read("rows").limit(0), self.key)
            c.commit()
            self.retain(1)

    def clear_changes(self) -> None:
        """Empty the change log."""
        c = self.versions.begin()
        if c.has("changes"):
            c.clear("changes")
            c.commit()
