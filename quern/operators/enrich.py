"""Lookups and denormalisation: small dimensions joined to records, people lists to ids, topics to guests.

Spark chooses a broadcast when a dimension's size, as measured, is below its threshold, and a shuffled join otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people as P
from .store import last_of


def lookup(rows: DataFrame, dim: DataFrame, *, on: str, key: str, value: str, name: str, issue: str) -> DataFrame:
    """Add dim's value for each row's key as name; a key that is given and unknown adds to the array column issues."""
    d = dim.select(F.col(key).alias("__key"), F.col(value).alias("__value"))
    joined = rows.join(d, F.col(on) == F.col("__key"), "left")
    has = "issues" in rows.columns
    old = F.col("issues") if has else F.array().cast("array<string>")
    unknown = F.col(on).isNotNull() & (F.col(on).cast("string") != "") & F.col("__key").isNull()
    issues = F.when(unknown, F.concat(old, F.array(F.concat(F.lit(issue + ": "), F.col(on).cast("string"))))).otherwise(old)
    return joined.select(*(c for c in rows.columns if c != "issues"), F.col("__value").alias(name), issues.alias("issues"))


def tiers(product: Column, mapping: dict[str, list[str]]) -> Column:
    """The tiers of a product; null for an unknown one."""
    found = F.lit(None).cast("array<string>")
    for name, values in mapping.items():
        found = F.when(product == name, F.array(*map(F.lit, values))).otherwise(found)
    return found


def joined_list(*lists: Column, distinct: bool = True) -> Column:
    """Several lists as one: sorted and distinct, or with all duplicates in the order given. A single list stays as it is."""
    both = F.concat(*lists) if len(lists) > 1 else lists[0]
    return F.array_sort(F.array_distinct(both)) if distinct and len(lists) > 1 else both


def people_to_field(rows: DataFrame, dim: DataFrame, *, id_col: str, people_col: str, name: str, value: str, placeholder: str | None = None, ignorable=()) -> DataFrame:
    """(id, found, missing): the dim's value of each person in order, and the names that dim lacks. Ignorable names look up the
    placeholder; if dim lacks that too, they are missing."""
    out = people_to_fields(rows, dim, id_col=id_col, people_cols=[people_col], name=name, value=value, placeholder=placeholder, ignorable=ignorable)
    return out.select(id_col, F.col(f"{people_col}_found").alias("found"), F.col(f"{people_col}_missing").alias("missing"))


def people_to_fields(rows: DataFrame, dim: DataFrame, *, id_col: str, people_cols: list[str], name: str, value: str, placeholder: str | None = None, ignorable=()) -> DataFrame:
    """(id, <column>_found, <column>_missing for each people column): people_to_field of several columns by one join and one grouping."""
    none = F.array().cast("array<string>")
    entry = lambda c, k: F.transform(F.coalesce(F.col(c), none), lambda x: F.struct(F.lit(k).alias("field"), x.alias("person")))
    entries = [entry(c, k) for k, c in enumerate(people_cols)]
    each = rows.select(F.col(id_col).alias("__id"), F.posexplode_outer(F.concat(*entries)).alias("pos", "e")).select("__id", "pos", "e.field", "e.person")
    plain = P.strip_prefix(F.col("person"))
    asked = F.when(plain.isin(*ignorable), F.lit(placeholder)).otherwise(plain) if ignorable else plain
    d = dim.select(F.col(name).alias("__name"), F.col(value).alias("__value"))
    met = each.withColumn("asked", asked).join(d, F.col("asked") == F.col("__name"), "left")
    hit = F.col("__name").isNotNull()
    one = F.struct("pos", "field", hit.alias("hit"), F.col("__value").alias("value"), F.when(~hit, F.col("person")).alias("person"))
    out = met.groupBy("__id").agg(F.sort_array(F.collect_list(F.when(F.col("person").isNotNull(), one))).alias("p"))
    part = lambda k, found: F.filter("p", lambda x: (x["field"] == k) & (x["hit"] == F.lit(found)))
    fields = [(part(k, True)["value"].alias(f"{c}_found"), part(k, False)["person"].alias(f"{c}_missing")) for k, c in enumerate(people_cols)]
    return out.select(F.col("__id").alias(id_col), *(x for both in fields for x in both))


def all_or_nothing(found: Column, missing: Column) -> Column:
    """The found list only if nothing is missing."""
    return F.when(F.size(missing) > 0, F.array().cast("array<string>")).otherwise(found)


def unknown_people(rows: DataFrame, dim: DataFrame, *, people: list[str], name: str) -> DataFrame:
    """(person): distinct people of the list columns, prefixes stripped, that dim does not name."""
    each = rows.select(F.explode(F.concat(*map(F.col, people))).alias("raw")).select(P.strip_prefix(F.col("raw")).alias("person"))
    return each.where("person <> ''").distinct().join(dim.select(F.col(name).alias("person")), "person", "left_anti")


def guest_subjects(rows: DataFrame, *, people_col: str, subject_cols: list[str], ignored=()) -> DataFrame:
    """(guest, subjects): all subjects of the records that a guest is in, distinct and sorted, without names of guests."""
    each = rows.select(F.explode(people_col).alias("guest"), F.concat(*(F.coalesce(F.col(c), F.array().cast("array<string>")) for c in subject_cols)).alias("s"))
    each = each.where(~F.col("guest").isin(*ignored)) if ignored else each
    guests = each.select(F.col("guest").alias("subject")).distinct()
    pairs = each.select("guest", F.explode_outer("s").alias("subject")).distinct()
    clean = pairs.join(guests.withColumn("__is_guest", F.lit(True)), "subject", "left")
    kept = F.when(F.col("__is_guest").isNull() & F.col("subject").isNotNull(), F.col("subject"))
    return clean.groupBy("guest").agg(F.array_sort(F.collect_set(kept)).alias("subjects"))


def plain_names(rows: DataFrame, *, name: str, order: str) -> DataFrame:
    """Re-key by the name without prefix; of colliding names the last in order stays, empty names go."""
    return last_of(rows.withColumn(name, P.strip_prefix(F.col(name))).where(F.col(name) != ""), name, order)


def comment_stats(comments: DataFrame, key: str, *, likes="likes", dislikes="dislikes", reply="reply_to") -> DataFrame:
    """Per record with comments: their number, replies among them, and sums of likes and dislikes (missing: 0)."""
    zero = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long")
    return comments.groupBy(key).agg(F.count("*").alias("n_comments"), F.count_if(F.coalesce(F.col(reply).cast("string"), F.lit("")) != "").alias("n_replies"), zero(likes).alias("likes"), zero(dislikes).alias("dislikes"))


def needs_refresh(rows: DataFrame, target: DataFrame, key: str, *, consumed: tuple[str, ...], issue_tag: str) -> DataFrame:
    """rows with action: add if target lacks it, update if it is newer there than in target or carries one of the tags."""
    t = target.select(F.col(key).alias("__k"), F.col("data_updated").alias("__at"), F.col("tags").alias("__tags"))
    joined = rows.join(t, F.col(key) == F.col("__k"), "left")
    told = F.arrays_overlap("tags", F.array(*map(F.lit, consumed))) | F.array_contains("__tags", issue_tag)
    action = F.when(F.col("__k").isNull(), "add").when((F.col("data_updated") > F.col("__at")) | F.coalesce(told, F.lit(False)), "update").otherwise("none")
    return joined.withColumn("action", action).drop("__k", "__at", "__tags")
