"""Delivery to destinations: the push loop over search units, several indexes, and the rows of the customer-relations table.

A destination is an object with upsert(key, record) and delete(key) that raise on failure; it is sent to the tasks, several of which
deliver under one rate. Outcomes are written before they are read, since reading a delivery again would send it again; with a
ledger a task that is run again does not."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import outbox
from .store import tag_remove, tagged

Written = Callable[[DataFrame, str], DataFrame]  # writes a frame of that name somewhere shared and reads it back


class FileDestination:
    """A destination that keeps every call as a JSON file of a shared folder; tests and dry runs deliver to it."""

    def __init__(self, folder: str, fails: Callable[[str], bool] | None = None):
        self.folder, self.fails = folder, fails

    def _put(self, call: str, key, record) -> None:
        if self.fails and self.fails(str(key)):
            raise OSError(f"{call} refused")
        where = Path(self.folder)
        where.mkdir(parents=True, exist_ok=True)
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        (where / f"{name}.part").write_text(json.dumps({"call": call, "key": str(key), "record": record}))
        (where / f"{name}.part").rename(where / f"{name}.json")

    def upsert(self, key, record: str) -> None:
        self._put("upsert", key, json.loads(record))

    def delete(self, key) -> None:
        self._put("delete", key, None)

    def configure(self, name: str, settings: dict) -> None:
        """Keep the settings of an index or replica."""
        where = Path(self.folder) / "settings"
        where.mkdir(parents=True, exist_ok=True)
        (where / f"{name}.json").write_text(json.dumps(settings))

    def state(self) -> dict[str, dict]:
        """What the destination holds after all calls."""
        held: dict[str, dict] = {}
        for path in sorted(Path(self.folder).glob("*.json")):
            call = json.loads(path.read_text())
            if call["call"] == "delete":
                held.pop(call["key"], None)
            else:
                held.setdefault(call["key"], {}).update(call["record"])
        return held


def push(units: DataFrame, key: str, texts: DataFrame | None, destination, written: Written, *, allowed: list[str] | None = None, delete_tag: str = "delete", most_bytes: int = 100_000, full_below: int = 10_000, writers: int = 4, pause: float = 0.0, dry_run: bool = False, ledger: str | None = None) -> tuple[DataFrame, DataFrame]:
    """One run over units (key, pushed, current, tags, ...): (the units after it, (key, outcome, error)).

    Tagged units are deleted at the destination and, if that worked, here. Of the others the undelivered allowed fields are sent,
    with texts (key, text, pseudo) in the place of their hashes; what arrived is marked as pushed, so what failed is tried again.
    Outcomes: deleted, pushed, failed, too_large, unchanged; a dry run says what it would do and leaves the units alone."""
    gone = tagged(units, delete_tag)
    live = units.where(~F.array_contains("tags", delete_tag))
    deltas = outbox.delta(live.select(key, "pushed", "current"), key, allowed)
    if texts is not None:
        deltas = outbox.resolved(deltas, texts, key, full_below=full_below)
    good, large = outbox.gate(deltas, most_bytes)
    none = F.lit(None).cast("string")
    if dry_run:
        sent = good.select(key, "fields", none.alias("error"))
        dropped = gone.select(key, none.alias("error"))
    else:
        book = lambda part: f"{ledger}/{part}" if ledger else None
        sent = written(outbox.deliver(good, key, destination.upsert, writers=writers, pause=pause, ledger=book("sent")), "sent")
        calls = gone.select(key, F.array().cast("array<string>").alias("fields"), F.lit("").alias("record"))
        dropped = written(outbox.deliver(calls, key, lambda k, _: destination.delete(k), writers=writers, pause=pause, ledger=book("dropped")), "dropped").select(key, "error")
    outcome = lambda error, name: F.when(error.isNull(), name).otherwise("failed")
    report = sent.select(key, outcome(F.col("error"), "pushed").alias("outcome"), "error")
    report = report.unionByName(large.select(key, F.lit("too_large").alias("outcome"), F.concat(F.col("bytes").cast("string"), F.lit(" bytes")).alias("error")))
    report = report.unionByName(dropped.select(key, outcome(F.col("error"), "deleted").alias("outcome"), "error"))
    quiet = units.select(key).join(report.select(key), key, "left_anti")
    report = report.unionByName(quiet.select(key, F.lit("unchanged").alias("outcome"), none.alias("error")))
    if dry_run:
        return units, report
    marked = outbox.mark_pushed(units.select(key, "pushed", "current"), sent.where("error is null"), key).select(F.col(key).alias("__k"), F.col("pushed").alias("__pushed"))
    after = units.join(marked, F.col(key) == F.col("__k")).withColumn("pushed", F.col("__pushed")).select(units.columns)
    return after.join(dropped.where("error is null").select(key), key, "left_anti"), report


def configure(destination, settings: Callable[[str | None], dict], replicas: list[str]) -> None:
    """Settings of the main index and of its replicas to a destination."""
    destination.configure("main", settings(None))
    for name in replicas:
        destination.configure(name, settings(name))


@dataclass
class Index:
    """One search index: what builds its units, which fields it takes, where they go, and where the units are kept."""

    name: str
    fresh: Callable[[], DataFrame]
    allowed: list[str]
    destination: object
    load: Callable[[], DataFrame]
    save: Callable[[DataFrame], object]
    texts: Callable[[], DataFrame] | None = None
    options: dict = field(default_factory=dict)


def push_indexes(indexes: list[Index], plan: Callable[[DataFrame, DataFrame], DataFrame], written: Written, *, key: str = "id", dry_run: bool = False, may_go_on: Callable[[], bool] = lambda: True) -> dict[str, dict[str, int]]:
    """For each index: bring its units up to date (`plan(units, fresh)` gives op and the unit) and push them. The counts by outcome."""
    counts = {}
    for index in indexes:
        if not may_go_on():
            break
        units = written(plan(index.load(), index.fresh()).drop("op"), f"units-{index.name}")
        after, report = push(units, key, index.texts() if index.texts else None, index.destination, written, allowed=index.allowed, dry_run=dry_run, **index.options)
        if not dry_run:
            index.save(after)
        counts[index.name] = {r.outcome: r.n for r in report.groupBy("outcome").agg(F.count("*").alias("n")).collect()}  # five rows
    return counts


# ---- the customer-relations table ----


def crm_plan(local: DataFrame, remote: DataFrame, *, repush_tag: str = "repush") -> DataFrame:
    """(key, action, crm_id, record): what to send. local: (id, record struct with website_id, tags); remote: (website_id, crm_id).

    insert: only local; update: on both sides and tagged; delete: only remote; none; mismatch: the ids of the two sides and of the
    record are not one."""
    r = remote.select(F.col("website_id").alias("__r"), "crm_id")
    both = local.select("id", "record", "tags").join(r, F.col("id") == F.col("__r"), "full")
    tagged_ = F.array_contains("tags", repush_tag)
    action = (
        F.when(F.col("id").isNull(), "delete")
        .when(F.col("__r").isNull(), "insert")
        .when(tagged_ & (F.col("record.website_id") != F.col("id")), "mismatch")
        .when(tagged_, "update")
        .otherwise("none")
    )
    return both.select(F.coalesce("id", "__r").alias("id"), action.alias("action"), "crm_id", F.to_json("record").alias("record"))


def push_crm(local: DataFrame, remote: DataFrame, destination, written: Written, *, repush_tag: str = "repush", writers: int = 4, pause: float = 0.2, dry_run: bool = False, ledger: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(local after it, (id, action, error)): carry out crm_plan by writers that together send a call every `pause` seconds. The tag goes
    only with success. A mismatch stops the run before anything is sent."""
    plan = written(crm_plan(local, remote, repush_tag=repush_tag), "crm-plan")
    wrong = plan.where("action = 'mismatch'").limit(5).collect()
    if wrong:
        raise ValueError(f"ids disagree: {[r.id for r in wrong]}")
    work = plan.where("action in ('insert', 'update', 'delete')")
    none = F.lit(None).cast("string")
    if dry_run:
        return local, plan.select("id", "action", none.alias("error"))

    def send(key, call):
        action, crm_id, record = json.loads(call)
        if action == "delete":
            destination.delete(crm_id)
        else:
            destination.upsert(crm_id or key, record)

    calls = work.select("id", F.array().cast("array<string>").alias("fields"), F.to_json(F.array(F.col("action"), F.col("crm_id"), F.col("record"))).alias("record"))
    done = written(outbox.deliver(calls, "id", send, writers=writers, pause=pause, ledger=ledger), "crm-sent").select("id", "error")
    report = plan.join(done, "id", "left").select("id", "action", "error")
    cleared = report.where("action = 'update' and error is null").select(F.col("id").alias("__ok"))
    tags = F.when(F.col("__ok").isNotNull(), tag_remove(F.col("tags"), repush_tag)).otherwise(F.col("tags"))
    after = local.join(cleared, F.col("id") == F.col("__ok"), "left").withColumn("tags", tags).select(local.columns)
    return after, report


def push_lists(theirs: DataFrame, ours: DataFrame, key: str, field_name: str, destination, written: Written, *, writers: int = 4, pause: float = 0.2, dry_run: bool = False, ledger: str | None = None) -> tuple[DataFrame, int]:
    """Deliver one list field of the records that both sides have, where it differs: (key, prior, new, error), and how many keys only
    ours has. theirs has crm_id."""
    both, only = outbox.field_delta(theirs, ours, key, field_name)
    changed = written(both.join(theirs.select(key, "crm_id"), key), "list-changes")
    missing = only.count()
    if dry_run:
        return changed.select(key, "prior", "new", F.lit(None).cast("string").alias("error")), missing
    record = F.to_json(F.struct(F.col("new").alias(field_name)))
    calls = changed.select("crm_id", F.array().cast("array<string>").alias("fields"), record.alias("record"))
    done = written(outbox.deliver(calls, "crm_id", destination.upsert, writers=writers, pause=pause, ledger=ledger), "lists-sent").select("crm_id", "error")
    return changed.join(done, "crm_id").select(key, "prior", "new", "error"), missing
