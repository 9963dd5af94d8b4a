"""Outbox: per field what was last delivered and what is current; deltas, size gate, retry by state.

A unit is (key, pushed struct, current struct) with one schema for both structs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(kind: str, a: Column, b: Column) -> Column:
    """Lists are equal if they hold the same values equally often, in any order."""
    return F.array_sort(a).eqNullSafe(F.array_sort(b)) if kind.startswith("array") else a.eqNullSafe(b)


def _fields(units: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in units.schema["current"].dataType.fields]


def empty_of(kind: str) -> Column:
    """The value of a field that holds nothing: '', 0, false, no items; null for other types."""
    if kind == "string":
        return F.lit("")
    if kind == "boolean":
        return F.lit(False)
    if kind in ("int", "bigint", "double", "smallint", "float"):
        return F.lit(0).cast(kind)
    return F.array().cast(kind) if kind.startswith("array") else F.lit(None).cast(kind)


def create(rows: DataFrame, key: str) -> DataFrame:
    """Units of records that were never delivered: as delivered, every field holds nothing."""
    fields = [(c, t) for c, t in rows.dtypes if c != key]
    pushed = F.struct(*(empty_of(t).alias(c) for c, t in fields))
    current = F.struct(*(F.coalesce(F.col(c), empty_of(t)).alias(c) for c, t in fields))
    return rows.select(key, pushed.alias("pushed"), current.alias("current"))


def update(units: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Units with the records' values as current; a null field of a record says nothing, the unit's value stays. New keys are
    created, absent ones stay."""
    fresh = create(rows, key).alias("n")
    given = rows.select(F.col(key).alias("__k"), F.struct(*(c for c in rows.columns if c != key)).alias("__given")).alias("g")
    joined = units.alias("u").join(fresh, F.col(f"u.{key}") == F.col(f"n.{key}"), "full").join(given, F.col(f"n.{key}") == F.col("g.__k"), "left")
    new = F.struct(*(F.coalesce(F.col("g.__given")[c], F.col("u.current")[c], F.col("n.current")[c]).alias(c) for c, _ in _fields(units)))
    current = F.when(F.col("g.__k").isNull(), F.col("u.current")).otherwise(new)
    return joined.select(F.coalesce(f"u.{key}", f"n.{key}").alias(key), F.coalesce("u.pushed", "n.pushed").alias("pushed"), current.alias("current"))


def unit_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, field, prior, new) of the current values that differ, as JSON text; lists by what they hold."""
    b, a = before.select(F.col(key).alias("__k"), F.col("current").alias("b")), after.select(key, F.col("current").alias("a"))
    both = a.join(b, F.col(key) == F.col("__k"))
    rows = [F.when(~same(t, F.col("b")[c], F.col("a")[c]), F.struct(F.lit(c).alias("field"), _json(F.col("b")[c]).alias("prior"), _json(F.col("a")[c]).alias("new"))) for c, t in _fields(after)]
    return both.select(key, F.explode(F.array_compact(F.array(*rows))).alias("c")).select(key, "c.*")


def _json(value: Column) -> Column:
    return F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r"(?s)^\{\"v\":(.*)\}$", 1)


def delta(units: DataFrame, key: str, allowed: list[str] | None = None) -> DataFrame:
    """(key, fields, record): units with undelivered fields among the allowed ones, and those fields with the key as JSON."""
    fields = [(c, t) for c, t in _fields(units) if allowed is None or c in allowed]
    changed = [~same(t, F.col("pushed")[c], F.col("current")[c]) for c, t in fields]
    names = F.array_compact(F.array(*(F.when(x, F.lit(c)) for x, (c, _) in zip(changed, fields, strict=True))))
    record = F.to_json(F.struct(F.col(key), *(F.when(x, F.col("current")[c]).alias(c) for x, (c, _) in zip(changed, fields, strict=True))))
    return units.select(key, names.alias("fields"), record.alias("record")).where(F.size("fields") > 0)


def gate(deltas: DataFrame, most: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Deltas whose record has at most `most` bytes, and those that are too large."""
    size = F.octet_length("record")
    return deltas.where(size <= most), deltas.where(size > most).select("*", size.alias("bytes"))


def mark_pushed(units: DataFrame, delivered: DataFrame, key: str) -> DataFrame:
    """Units after delivery of (key, fields): pushed takes the current value of the delivered fields only, so what failed is
    different again next time."""
    d = delivered.select(F.col(key).alias("__k"), F.col("fields").alias("__f"))
    done = lambda c: F.coalesce(F.array_contains("__f", c), F.lit(False))
    pushed = F.struct(*(F.when(done(c), F.col("current")[c]).otherwise(F.col("pushed")[c]).alias(c) for c, _ in _fields(units)))
    return units.join(d, F.col(key) == F.col("__k"), "left").select(key, pushed.alias("pushed"), "current")


def resolved(deltas: DataFrame, texts: DataFrame, key: str, *, text: str = "transcript", short: str = "pseudo_transcript", full_below: int = 10_000) -> DataFrame:
    """Deltas with the hashes of texts replaced by the texts. texts: (key, text, pseudo).

    The text field gets the whole text. The short field gets the text in normal space if that has less than full_below bytes (0:
    never), and else the short text. A field without a text to put in is left out of record and fields, so it is tried again; a
    delta with no field left is none."""
    t = texts.select(F.col(key).alias("__k"), F.nullif(F.col("text"), F.lit("")).alias("__text"), F.nullif(F.col("pseudo"), F.lit("")).alias("__pseudo"))
    joined = deltas.join(t, F.col(key) == F.col("__k"), "left")
    normal = F.trim(F.regexp_replace("__text", r"\s+", " "))
    brief = F.when(F.octet_length(normal) < full_below, F.nullif(normal, F.lit(""))) if full_below else F.lit(None).cast("string")
    out = joined.withColumn("__short", F.coalesce(brief, F.col("__pseudo")))
    for name, value in ((text, "__text"), (short, "__short")):
        has = F.array_contains("fields", name)
        put = F.regexp_replace(F.col("record"), F.lit(rf',?"{name}":"[^"]*"'), F.lit(""))
        entry = F.regexp_extract(F.to_json(F.struct(F.col(value).alias(name))), r"(?s)^\{(.*)\}$", 1)
        filled = F.concat(F.left(put, F.length(put) - 1), F.lit(","), entry, F.lit("}"))
        out = out.withColumn("record", F.when(has & F.col(value).isNotNull(), filled).when(has, put).otherwise(F.col("record")))
        out = out.withColumn("fields", F.when(has & F.col(value).isNull(), F.array_remove("fields", name)).otherwise(F.col("fields")))
    return out.where(F.size("fields") > 0).select(deltas.columns)


def type_errors(records: DataFrame, key: str, record: str, template: dict[str, str], *, full_unit: bool = False) -> DataFrame:
    """(key, field, error) of JSON records against a template of field -> string, bigint, boolean or array<string>: unknown fields
    and other types; with full_unit each field must be an object of exactly pushed and current, both of the field's type."""
    text = F.col(record)
    parsed = F.try_parse_json(text)
    names = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    unknown = F.transform(F.array_except(names, F.array(*map(F.lit, template))), lambda n: F.struct(n.alias("field"), F.lit("unknown field").alias("error")))
    found = [unknown]

    def wrong(path: str, kind: str) -> Column:
        got = F.lower(F.schema_of_variant(F.try_variant_get(parsed, path, "variant")))
        fits = {"string": got == "string", "bigint": got == "bigint", "boolean": got == "boolean", "array<string>": got.isin("array<string>", "array<void>")}[kind]
        return ~F.coalesce(fits, F.lit(False))

    for name, kind in template.items():
        problem = lambda message, name=name: F.array(F.struct(F.lit(name).alias("field"), F.lit(message).alias("error")))
        none = F.array().cast("array<struct<field:string,error:string>>")
        path = f"$['{name}']"
        if full_unit:
            keys = F.json_object_keys(F.get_json_object(text, path))
            shape = ~F.coalesce(F.array_sort(keys) == F.array(F.lit("current"), F.lit("pushed")), F.lit(False))
            each = F.concat(*(F.when(wrong(f"{path}.{side}", kind), problem(f"{side} is not {kind}")).otherwise(none) for side in ("pushed", "current")))
            issue = F.when(shape, problem("not pushed and current")).otherwise(each)
        else:
            issue = F.when(wrong(path, kind), problem(f"not {kind}")).otherwise(none)
        found.append(F.when(F.array_contains(names, name), issue).otherwise(none))
    broken = F.array(F.struct(F.lit("").alias("field"), F.lit("not a record").alias("error")))
    errors = F.when(parsed.isNull() | F.json_object_keys(text).isNull(), broken).otherwise(F.concat(*found))
    return records.select(key, F.explode(errors).alias("e")).select(key, "e.*")


def replicas(rows: DataFrame, key: str, orders: dict[str, tuple[str, bool]]) -> dict[str, DataFrame]:
    """Named orders of an index: name -> (column, whether ascending); ties by key."""
    return {name: rows.orderBy(F.col(c).asc() if up else F.col(c).desc(), key) for name, (c, up) in orders.items()}


def deliver(deltas: DataFrame, key: str, send: Callable[[str, str], None], *, writers: int = 1, pause: float = 0.0, ledger: str | None = None, holds: Callable[[str], bool] | None = None, lease: float = 30.0) -> DataFrame:
    """(key, fields, error): call send(key, record) for each row in `writers` tasks; error is null on success. All writers together send
    one record every `pause` seconds at most, in time slots dealt to them.

    The result must be written before it is read twice, as reading it sends. With a ledger (a mounted folder, one for each delivery) a task
    that is tried again, or run twice, sends nothing again that is settled there; holds(id) asks the destination about what is in doubt, and
    lease is how many seconds a silent owner of a partition is waited for."""
    import itertools
    import time

    import pyarrow as pa
    from pyspark import TaskContext

    from .ledger import BOOKS, Ledger, Slots, local_path

    if ledger and any(local_path(ledger).glob("*.journal")):
        raise ValueError("a ledger of an older layout")
    names, begin = ["key", "fields", "error"], time.time()

    def run(batches):
        at = TaskContext.get().partitionId()
        slots, book, now = Slots(begin, pause, at, writers), None, None

        def paced(k, record) -> None:
            slots.wait()
            send(k, record)

        def plain(k, record) -> str | None:
            try:
                paced(k, record)
            except Exception as e:  # the row stays undelivered and says why
                return str(e)[:500]
            return None

        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True))
            if not ledger:
                errors = [plain(*row) for row in rows]
            else:
                errors = []
                for b, part in itertools.groupby(zip(batch.column(3).to_pylist(), rows, strict=True), lambda x: x[0]):
                    if b != now:
                        if book:
                            book.close()
                        book, now = Ledger(f"{ledger}/{b}", at, lease=lease), b
                    errors += book.each([row for _, row in part], paced, holds)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(errors, pa.string())], names)
        if book:
            book.close()

    kind = dict(deltas.dtypes)[key]
    rows = deltas.select(key, "fields", "record").repartition(writers, key)
    if ledger:
        rows = rows.withColumn("__book", F.pmod(F.xxhash64(key), F.lit(BOOKS)).cast("int")).sortWithinPartitions("__book")
    return rows.mapInArrow(run, f"key {kind}, fields array<string>, error string").withColumnRenamed("key", key)


def field_delta(theirs: DataFrame, ours: DataFrame, key: str, field: str) -> tuple[DataFrame, DataFrame]:
    """(key, prior, new) where both sides have the key and the list field differs ('' and the empty list are equal), and the keys
    that only ours has."""
    none = F.array().cast("array<string>")
    t = theirs.select(F.col(key).alias("__k"), F.array_sort(F.coalesce(F.col(field), none)).alias("prior"))
    o = ours.select(key, F.array_sort(F.coalesce(F.col(field), none)).alias("new"))
    both = o.join(t, F.col(key) == F.col("__k")).where(~F.col("prior").eqNullSafe(F.col("new"))).select(key, "prior", "new")
    return both, ours.select(key).join(theirs.select(key), key, "left_anti")


def list_delta(a: Column, b: Column) -> Column:
    """struct(in1not2, in2not1), order and repetition ignored."""
    return F.struct(F.array_sort(F.array_except(a, b)).alias("in1not2"), F.array_sort(F.array_except(b, a)).alias("in2not1"))
