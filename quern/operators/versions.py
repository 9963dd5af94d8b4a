"""Versioned tables below one folder: buckets of Parquet files with small files of changes on top, append-only logs, and a manifest
for each version that names them all.

A `Commit` is a transaction. It starts from one version, remembers which buckets it has read and which it writes, writes its data under
new names and then publishes the next manifest by a conditional create, which fails if that version is there. Then the versions
published meanwhile are compared with what this commit read or replaced: if they touch none of it, the commit is built anew on the
newest manifest and published after them, else it ends with `Conflict` and nothing of it is seen. Blind changes (put, drop, patch of
given keys) read nothing, so they are never refused. No commit is lost, and none is seen in part.

Merge on read: put, drop and patch write files in proportion to the changed keys, per bucket, and leave the buckets alone. A read takes
the rows of buckets and puts, leaves out those that a later drop or put names, and folds later patches over the others. A patch of
all rows is one entry of the manifest. Buckets whose changes have grown (by size against the bucket, or by number) are compacted by a
commit of their own; files of new keys alone are no changes but by their number, as a read takes them as they are. Tables of mode "sum" hold signed numbers: rows of one key add up, and keys whose sum is 0 are not there.

Logs are lists of segments; ten segments of a level are merged into one of the next, in order of the first column, so a log of n
commits has some ten times log n segments. The number of buckets doubles when their mean size passes a bound: the new buckets refer to the
files of the old one and read their own rows of them, until they are written anew, so doubling writes a manifest only."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RATIO, AT_LEAST, MOST_DELTAS, MOST_PATCHES = 0.25, 8 << 20, 16, 8  # when changes are folded into their bucket
WRITES = 8  # of one commit at the same time
OPEN, OPEN_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters", 8  # files of buckets that a task has open; more are sorted first, which may spill
FANOUT = 10  # segments of a log that are merged into one
BUCKET_BYTES = 512 << 20  # mean size of a bucket at which their number doubles
PLACED = 32 << 20  # from so many bytes on, rows made from buckets of the same key are written by the tasks that read them
GRACE_MS = 3_600_000  # younger files that no version names may belong to a commit under way


class Conflict(RuntimeError):
    """Another writer changed what this commit has read or replaced; it can be made again from the newest version."""


def _empty() -> dict:
    return {"schemas": {}, "keys": {}, "modes": {}, "buckets": {}, "patches": {}, "logs": {}, "facts": {}, "wrote": {}, "last": 0}


class Versions:
    """Manifest: schemas, keys and modes by table; buckets {table: {bucket: {base, bytes, seq, deltas}}}, base and deltas with `of`, the number
    of buckets when they were written, where that was another; patches {table: [{seq, op,
    arg}]} of all rows; logs {table: [{path, level}]}; facts; wrote {table: buckets or null for all}, what this version changed."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16, *, patches: dict[str, tuple[str, Callable[[Column, Column], Column]]] | None = None):
        """patches: name -> (column, function of its value and the arguments), the changes of single rows that tables know."""
        self.spark, self.folder, self.buckets, self.patches = spark, folder.rstrip("/"), buckets, patches or {}
        self._jvm = spark._jvm
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        if self.version():  # the number of buckets is settled by the store
            self.buckets = self.manifest()["facts"].get("buckets", buckets)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def numbers(self) -> list[int]:
        """The versions whose manifest is there, oldest first."""
        where = self._path("manifests")
        if not self._fs.exists(where):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(where)]
        return sorted(int(x[1:-5]) for x in names if x.startswith("v") and x.endswith(".json"))

    def version(self) -> int:
        return max(self.numbers(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return _empty()
        stream = self._fs.open(self._path(f"manifests/v{version}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> bool:
        """Make manifest the version manifest["last"], whole and only if that version is not there; whether it was made.

        A local file is linked and an HDFS file renamed without overwriting, both of which are one step; other stores must make
        creation without overwriting conditional, as object stores with conditional writes do."""
        final = self._path(f"manifests/v{manifest['last']}.json")
        self._fs.mkdirs(self._path("manifests"))
        data, scheme = json.dumps(manifest).encode(), self._fs.getUri().getScheme()
        if scheme not in ("file", "hdfs"):
            try:
                out = self._fs.create(final, False)
                out.write(data)
                out.close()
                return True
            except Exception:
                if self._fs.exists(final):
                    return False
                raise
        draft = self._path(f"drafts/{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        out.write(data)
        out.close()
        try:
            if scheme == "file":
                import os

                os.link(draft.toUri().getPath(), final.toUri().getPath())
            else:
                context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
                none = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                kinds = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
                kinds[0] = none
                context.rename(draft, final, kinds)
            return True
        except Exception:
            if self._fs.exists(final):
                return False
            raise
        finally:
            self._fs.delete(draft, False)

    def bucket(self, key: str, n: int | None = None):
        """The bucket of a key, as a column."""
        return F.pmod(F.xxhash64(F.col(key)), F.lit(n or self.buckets)).cast("int")

    def touched(self, ids: DataFrame, key: str) -> list[int]:
        """The buckets of the keys in ids: as many as there are buckets at most."""
        return [r.b for r in ids.select(self.bucket(key).alias("b")).distinct().collect()]

    def has(self, table: str, version: int | None = None) -> bool:
        return table in self.manifest(version)["schemas"]

    # ---- reading ----

    def read(self, table: str, version: int | None = None, buckets: list[int] | None = None, *, manifest: dict | None = None) -> DataFrame:
        """The rows of a table or log, or of some buckets of a table."""
        m = manifest or self.manifest(version)
        schema = StructType.fromJson(m["schemas"][table])
        if table in m["logs"]:
            return self._files(schema, [s["path"] for s in m["logs"][table]])
        held = {b: e for b, e in m["buckets"].get(table, {}).items() if buckets is None or int(b) in buckets}
        return self._merged(schema, m["keys"].get(table), m["modes"].get(table), held, m["patches"].get(table, []), m["facts"].get("buckets", self.buckets))

    def _files(self, schema: StructType, names: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{n}" for n in names)) if names else self.spark.createDataFrame([], schema)

    def _own(self, schema: StructType, names: list[str], key: str | None, shared: dict[str, tuple[int, ...]], n: int, then=lambda rows: rows) -> DataFrame:
        """The rows of files, by `then`; of a shared one only those of its buckets."""
        by: dict[tuple[int, ...], list[str]] = {}
        for name in dict.fromkeys(names):
            by.setdefault(shared.get(name, ()), []).append(name)
        rows = None
        for own, some in (by or {(): []}).items():
            part = self._files(schema, some)
            part = then(part.where(self.bucket(key, n).isin(*own)) if own else part)
            rows = part if rows is None else rows.unionByName(part)
        return rows

    def _sequenced(self, schema: StructType, deltas: list[dict], key: str | None, shared: dict[str, tuple[int, ...]], n: int) -> DataFrame:
        """The rows of files of changes with __seq, the version that brought them."""
        versions = {d["path"].split("/")[1]: d["seq"] for d in deltas}
        known = F.create_map(*(F.lit(x) for pair in versions.items() for x in pair))
        at = known[F.regexp_extract(F.col("_metadata.file_path"), "/data/([0-9a-f]+)/", 1)].cast("long")
        return self._own(schema, [d["path"] for d in deltas], key, shared, n, lambda rows: rows.withColumn("__seq", at))

    def _merged(self, schema: StructType, key: str | None, mode: str | None, held: dict[str, dict], everywhere: list[dict], n: int) -> DataFrame:
        names, refer = schema.names, {}
        for b, e in held.items():
            for path, of in [(e["base"], e.get("of", n)), *((d["path"], d.get("of", n)) for d in e["deltas"])]:
                refer.setdefault((path, of), []).append(int(b))
        shared = {path: tuple(sorted(own)) for (path, of), own in refer.items() if len(own) < n // of}  # some of its buckets have other files by now
        own = lambda some: self._own(schema, some, key, shared, n)
        deltas = [d for e in held.values() for d in e["deltas"]]
        bases = [e for e in held.values() if e["base"]]
        kind = lambda k: [d for d in deltas if d["kind"] == k]
        if mode == "sum":
            rows = own([e["base"] for e in bases] + [d["path"] for d in deltas])
            sums = [F.sum(c).alias(c) for c in names if c != key]
            return (rows.groupBy(key).agg(*sums).where(" or ".join(f"`{c}` <> 0" for c in names if c != key)) if deltas else rows).select(names)
        if not deltas and not any(p["seq"] > e["seq"] for p in everywhere for e in bases):
            return own([e["base"] for e in bases])
        if not kind("drops") and not kind("patch") and not everywhere:
            return own([e["base"] for e in bases] + [d["path"] for d in deltas])
        # a bucket holds what all patches up to its version have made, and all its files of changes are later
        upto = lambda e: max((p["seq"] for p in everywhere if p["seq"] <= e["seq"]), default=0)
        rows = None
        for seq in sorted({upto(e) for e in bases}):
            part = own([e["base"] for e in bases if upto(e) == seq]).withColumn("__seq", F.lit(seq).cast("long"))
            rows = part if rows is None else rows.unionByName(part)
        if kind("rows"):
            more = self._sequenced(schema, kind("rows"), key, shared, n)
            rows = more if rows is None else rows.unionByName(more)
        if rows is None:
            return self.spark.createDataFrame([], schema)
        if kind("drops"):
            gone = self._sequenced(StructType([schema[key]]), kind("drops"), key, shared, n).groupBy(F.col(key).alias("__key")).agg(F.max("__seq").alias("__gone"))
            rows = rows.join(gone, F.col(key) == F.col("__key"), "left").where("__gone is null or __seq >= __gone").drop("__key", "__gone")
        if kind("patch") or everywhere:
            rows = self._patched(rows, schema, key, kind("patch"), everywhere, shared, n)
        return rows.select(names)

    def _patched(self, rows: DataFrame, schema: StructType, key: str, deltas: list[dict], everywhere: list[dict], shared: dict[str, tuple[int, ...]], n: int) -> DataFrame:
        """Rows with the patches that came after them folded over them, in order."""
        entry = lambda seq, at, op, arg: F.struct(seq.cast("long").alias("seq"), at.cast("int").alias("at"), op.alias("op"), arg.cast("array<string>").alias("arg"))
        kind = "array<struct<seq:bigint,at:int,op:string,arg:array<string>>>"
        fixed = [entry(F.lit(p["seq"]), F.lit(p.get("at", 0)), F.lit(p["op"]), F.array(*map(F.lit, p["arg"]))) for p in everywhere]
        ops = F.array(*fixed).cast(kind)
        if deltas:
            form = StructType([schema[key], *StructType.fromDDL("op string, arg array<string>, at int").fields])
            own = self._sequenced(form, deltas, key, shared, n).groupBy(F.col(key).alias("__key")).agg(F.collect_list(entry(F.col("__seq"), F.col("at"), F.col("op"), F.col("arg"))).alias("__ops"))
            rows = rows.join(own, F.col(key) == F.col("__key"), "left")
            ops = F.concat(ops, F.coalesce("__ops", F.array().cast(kind)))
        used = {o for d in deltas for o in d["ops"]} | {p["op"] for p in everywhere}
        later = F.array_sort(F.filter(ops, lambda x: x["seq"] > F.col("__seq")))
        rows = rows.withColumn("__later", later)

        def patched(column: str) -> Column:
            own = sorted(o for o in used if self.patches[o][0] == column)

            def fold(value: Column, x: Column) -> Column:
                out = value
                for name in own:
                    out = F.when(x["op"] == name, self.patches[name][1](value, x["arg"])).otherwise(out)
                return out

            return F.aggregate("__later", F.col(column), fold).alias(column) if own else F.col(column)

        return rows.select(*(patched(c) for c in schema.names))

    # ---- writing ----

    def begin(self) -> Commit:
        return Commit(self)

    def commit(self, tables: dict[str, tuple[DataFrame, str, list[int] | None]], logs: dict[str, DataFrame] | None = None, facts: dict | None = None) -> int:
        """Replace buckets of tables and add to logs, as one version, by a writer that has read nothing.

        tables: name -> (rows, key, buckets): the rows of these buckets (None: of all) from now on. logs: name -> rows to add."""
        c = self.begin()
        for name, (rows, key, touched) in tables.items():
            c.replace(name, rows, key, touched)
        for name, rows in (logs or {}).items():
            c.append(name, rows)
        c.facts.update(facts or {})
        return c.commit()

    def _write(self, rows: DataFrame, key: str | None, placed: bool = False) -> dict[str, tuple[str, int]]:
        """Bucket -> (folder, bytes) of what was written, without those that got no row. placed: by the tasks that make the rows."""
        name = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("__bucket", self.bucket(key) if key else F.lit(0))
        dealt = dealt if placed else dealt.hint("rebalance", "__bucket")
        dealt.write.partitionBy("__bucket").parquet(f"{self.folder}/{name}")  # few files a bucket, large ones split
        found = [f.getPath() for f in self._fs.listStatus(self._path(name)) if f.isDirectory()]
        return {p.getName().split("=")[1]: (f"{name}/{p.getName()}", self._fs.getContentSummary(p).getLength()) for p in found if p.getName().startswith("__bucket=")}

    # ---- upkeep ----

    def due(self, m: dict | None = None) -> dict[str, list[int]]:
        """Table -> the buckets whose changes have grown enough to be folded into them."""
        m = m or self.manifest()
        out = {}
        for table, held in m["buckets"].items():
            fresh = lambda e: m["modes"].get(table) != "sum" and all(d["kind"] == "rows" for d in e["deltas"])  # noqa: E731, B023
            waiting = lambda e: 0 if fresh(e) else sum(d["bytes"] for d in e["deltas"])  # noqa: E731, B023
            full = len(m["patches"].get(table, [])) > MOST_PATCHES
            grown = [int(b) for b, e in held.items() if full or len(e["deltas"]) > MOST_DELTAS or waiting(e) > max(AT_LEAST, RATIO * e["bytes"])]
            if grown:
                out[table] = grown
        return out

    def compact(self, tables: dict[str, list[int]] | None = None) -> bool:
        """Fold the changes of buckets (None: of those that are due) into them; whether that was done. Blind changes made meanwhile stay on
        top; if a bucket was replaced meanwhile there is nothing to do."""
        c = self.begin()
        tables = self.due(c.manifest) if tables is None else tables
        for table, touched in tables.items():
            c.fold(table, touched)
        return self._kept_up(c, bool(tables))

    def merge_logs(self) -> bool:
        """Merge segments of logs where a level is full."""
        c = self.begin()
        found = False
        for table, segments in c.manifest["logs"].items():
            levels: dict[int, list[dict]] = {}
            for s in segments:
                levels.setdefault(s["level"], []).append(s)
            for level, own in levels.items():
                if len(own) >= FANOUT:
                    c.merge(table, own, level + 1)
                    found = True
        return self._kept_up(c, found)

    def grow(self) -> bool:
        """Double the number of buckets until their mean size in the largest table is under the bound."""
        c = self.begin()
        size = lambda e: e["bytes"] + sum(d["bytes"] for d in e["deltas"])
        largest = max((sum(map(size, held.values())) for held in c.manifest["buckets"].values()), default=0)
        n = self.buckets
        while largest > n * BUCKET_BYTES:
            n *= 2
        if n == self.buckets:
            return False
        c.split(n)
        done = self._kept_up(c, True)
        self.buckets = n if done else self.manifest()["facts"]["buckets"]
        return done

    def _kept_up(self, c: Commit, wanted: bool) -> bool:
        try:
            return wanted and c.commit() > 0
        except Conflict:
            return False

    def upkeep(self) -> None:
        """Whatever of this is due; called after a commit."""
        self.compact()
        self.merge_logs()
        self.grow()

    def retain(self, keep: int = 48, *, grace_ms: int = GRACE_MS) -> None:
        """Drop all but the newest versions, and the data that no version left names, unless it is younger than grace_ms."""
        import time

        numbers = self.numbers()
        for v in numbers[: max(0, len(numbers) - keep)]:
            self._fs.delete(self._path(f"manifests/v{v}.json"), False)
        named = set()
        for v in self.numbers():
            m = self.manifest(v)
            for held in m["buckets"].values():
                for e in held.values():
                    named.update(p.split("/")[1] for p in [e["base"], *(d["path"] for d in e["deltas"])] if p)
            named.update(s["path"].split("/")[1] for held in m["logs"].values() for s in held)
        for f in self._fs.listStatus(self._path("data")) if self._fs.exists(self._path("data")) else ():
            if f.getPath().getName() not in named and f.getModificationTime() <= time.time() * 1000 - grace_ms:
                self._fs.delete(f.getPath(), True)


class Commit:
    """One transaction: what it reads is what it started from; what it writes is written, all tables at the same time, and appears with
    commit()."""

    def __init__(self, versions: Versions):
        self.v = versions
        self.at = versions.version()
        self.manifest = versions.manifest(self.at)
        self.n = versions.buckets = self.manifest["facts"].get("buckets", versions.buckets)
        self.seen: dict[str, set[int] | None] = {}
        self.facts: dict = {}
        self._schemas: dict[str, tuple[dict, str | None, str | None]] = {}
        self._bases: dict[str, tuple[list[int] | None, dict, bool]] = {}  # buckets, what they become, whether they keep later changes
        self._deltas: dict[str, dict[str, list[dict]]] = {}
        self._patches: dict[str, list[dict]] = {}
        self._segments: dict[str, list[dict]] = {}
        self._merged: list[tuple[str, list[str], dict]] = []
        self._cleared: dict[str, list[str]] = {}
        self._writes: list[Callable[[], None]] = []
        self._later: list[Callable[[], None]] = []  # of what is made of what was written
        self._from = 0  # number of buckets that are split

    def has(self, table: str) -> bool:
        return table in self.manifest["schemas"]

    def read(self, table: str, buckets: list[int] | None = None) -> DataFrame:
        before = self.seen.get(table, set())
        self.seen[table] = None if buckets is None or before is None else before | set(buckets)
        return self.v.read(table, buckets=buckets, manifest=self.manifest)

    def _declare(self, table: str, rows: DataFrame | None, key: str | None, mode: str | None = None) -> str | None:
        key = key or self.manifest["keys"].get(table)
        if rows is not None:
            self._schemas[table] = (json.loads(rows.schema.json()), key, mode)
        return key

    def replace(self, table: str, rows: DataFrame, key: str, buckets: list[int] | None = None, *, mode: str | None = None, placed: bool = False) -> None:
        """rows are all rows of these buckets (None: of the table) from now on."""
        self._declare(table, rows, key, mode)
        self._becomes(table, rows, key, buckets, False, placed)

    def _becomes(self, table: str, rows: DataFrame, key: str, buckets: list[int] | None, folded: bool, placed: bool = False) -> None:
        def write() -> None:
            made = {b: {"base": p, "bytes": n, "deltas": []} for b, (p, n) in self.v._write(rows, key, placed).items()}
            self._bases[table] = (buckets, made, folded)

        self._bases[table] = (buckets, {}, folded)
        self._writes.append(write)

    def split(self, n: int) -> None:
        """A multiple of the buckets, which refer to the files of those that they were."""
        self._from, self.n = self.n, n

    def large(self, table: str) -> bool:
        """Whether rows that are made from this table's, of the same key, may be written where they are made."""
        held = self.manifest["buckets"].get(table, {}).values()
        return sum(e["bytes"] + sum(d["bytes"] for d in e["deltas"]) for e in held) >= PLACED

    def fold(self, table: str, buckets: list[int]) -> None:
        """Write buckets anew as they are read; changes that come meanwhile stay on top."""
        buckets = [b for b in buckets if str(b) in self.manifest["buckets"].get(table, {})]
        rows = self.v.read(table, buckets=buckets, manifest=self.manifest)
        self._becomes(table, rows, self.manifest["keys"][table], buckets, True)

    def _change(self, table: str, rows: DataFrame, key: str, kind: str, ops: list[str] = (), placed: bool = False) -> None:  # type: ignore[assignment]
        held = self._deltas.setdefault(table, {})

        def write() -> None:
            for b, (path, n) in self.v._write(rows, key, placed).items():
                held.setdefault(b, []).append({"path": path, "bytes": n, "kind": kind, "ops": list(ops)})

        self._writes.append(write)

    def put(self, table: str, rows: DataFrame, key: str | None = None, *, fresh: bool = False, placed: bool = False) -> None:
        """rows in the place of all rows of their keys; fresh: there are none of these keys."""
        key = self._declare(table, rows, key)
        if not fresh:
            self._change(table, rows.select(key).distinct(), key, "drops")
        self._change(table, rows, key, "rows", placed=placed)

    def drop(self, table: str, ids: DataFrame) -> None:
        key = self._declare(table, None, None)
        self._change(table, ids.select(key).distinct(), key, "drops")

    def add(self, table: str, rows: DataFrame, key: str) -> None:
        """Signed numbers that are added to those of their keys."""
        self._declare(table, rows, key, "sum")
        self._change(table, rows, key, "rows")

    def add_of(self, table: str, source: str, made: Callable[[DataFrame], DataFrame], key: str) -> None:
        """add of what is made of the rows that this commit puts to the table source, read back once they are written."""

        def write() -> None:
            schema = StructType.fromJson(self._schemas[source][0])
            paths = [d["path"] for own in self._deltas[source].values() for d in own if d["kind"] == "rows"]
            self._declare(table, rows := made(self.v._files(schema, paths)), key, "sum")
            held = self._deltas.setdefault(table, {})
            for b, (path, n) in self.v._write(rows, key).items():
                held.setdefault(b, []).append({"path": path, "bytes": n, "kind": "rows", "ops": []})

        self._later.append(write)

    def patch(self, table: str, rows: DataFrame, ops: list[str]) -> None:
        """rows (key, op, arg array<string>): changes of single rows; ops are the kinds that occur."""
        key = self._declare(table, None, None)
        self._change(table, rows.select(key, "op", F.col("arg").cast("array<string>").alias("arg"), F.lit(0).alias("at")), key, "patch", ops)

    def patch_all(self, table: str, op: str, arg: list[str]) -> None:
        """A change of every row that there is when this is published."""
        self._patches.setdefault(table, []).append({"op": op, "arg": arg})

    def append(self, log: str, rows: DataFrame) -> None:
        if log not in self.manifest["schemas"]:
            self._declare(log, rows, None)
        held = self._segments.setdefault(log, [])
        self._writes.append(lambda: held.extend({"path": p, "level": 0} for p, _ in self.v._write(rows, None).values()))

    def clear(self, log: str) -> None:
        """Take off a log what it held when this began."""
        self._cleared[log] = [s["path"] for s in self.manifest["logs"].get(log, [])]

    def merge(self, log: str, segments: list[dict], level: int) -> None:
        """Write segments of a log as one, in order of the first column."""
        schema = StructType.fromJson(self.manifest["schemas"][log])
        rows = self.v._files(schema, [s["path"] for s in segments])

        def write() -> None:
            made = self.v._write(rows.sort(schema.names[0]), None)
            self._merged.append((log, [s["path"] for s in segments], {"path": next(iter(made.values()))[0], "level": level} if made else {}))

        self._writes.append(write)

    def _wrote(self) -> dict:
        """Table -> buckets that this commit changes, null for all; a fold changes nothing that can be read."""
        out: dict[str, list[int] | None] = {t: None for t in self._patches}
        for t, by in self._deltas.items():
            out[t] = None if t in out else [int(b) for b in by]
        for t, (buckets, _, folded) in self._bases.items():
            if not folded:
                out[t] = None if buckets is None or out.get(t, []) is None else sorted({*buckets, *(out.get(t) or [])})
        return out

    def _check(self, newest: int) -> None:
        """Whether what other writers published since this began leaves what this has read or replaced alone."""
        guarded: dict[str, set[int] | None] = dict(self.seen)
        for t, (buckets, _, folded) in self._bases.items():
            if not folded:
                before = guarded.get(t, set())
                guarded[t] = None if buckets is None or before is None else before | set(buckets)
        there = set(self.v.numbers())
        for v in range(self.at + 1, newest + 1):
            if v not in there:
                raise Conflict(f"version {v} is gone, so what it changed cannot be told")
            m = self.v.manifest(v)
            if m["facts"].get("buckets", self.n) != (self.manifest["facts"].get("buckets", self.n)):
                raise Conflict(f"version {v} has another number of buckets")
            for t, changed in m["wrote"].items():
                mine = guarded.get(t, set())
                if (mine is None and (changed is None or changed)) or (mine and (changed is None or mine & set(changed))):
                    raise Conflict(f"version {v} changed {t} in buckets that this commit read or replaced")

    def _applied(self, m: dict) -> dict:
        """The manifest m with this commit on top."""
        seq = m["last"] + 1
        for t, (schema, key, mode) in self._schemas.items():
            m["schemas"][t] = schema
            if key:
                m["keys"][t] = key
            if mode:
                m["modes"][t] = mode
        for t, (buckets, made, folded) in self._bases.items():
            held = m["buckets"].get(t, {})
            if folded:
                for b in map(str, buckets or ()):
                    now, then = held.get(b), self.manifest["buckets"][t].get(b)
                    if now is None or then is None or now["base"] != then["base"]:
                        raise Conflict(f"bucket {b} of {t} was replaced meanwhile")
                    held[b] = {**made.get(b, {"base": None, "bytes": 0}), "seq": self.at, "deltas": [d for d in now["deltas"] if d["seq"] > self.at]}
            else:
                kept = {} if buckets is None else {b: e for b, e in held.items() if int(b) not in buckets}
                held = {**kept, **{b: {**e, "seq": seq} for b, e in made.items()}}
            m["buckets"][t] = held
        for t, by in self._deltas.items():
            held = m["buckets"].setdefault(t, {})
            for b, deltas in by.items():
                held.setdefault(b, {"base": None, "bytes": 0, "seq": 0, "deltas": []})["deltas"].extend({**d, "seq": seq} for d in deltas)
        for t, patches in self._patches.items():
            m["patches"].setdefault(t, []).extend({**p, "seq": seq, "at": k} for k, p in enumerate(patches))
        for t, patches in m["patches"].items():  # those that every bucket holds
            oldest = min((e["seq"] if e["base"] else min((d["seq"] for d in e["deltas"]), default=seq) for e in m["buckets"].get(t, {}).values()), default=seq)
            m["patches"][t] = [p for p in patches if p["seq"] > oldest]
        for log, gone in self._cleared.items():
            m["logs"][log] = [s for s in m["logs"].get(log, []) if s["path"] not in gone]
        for log, paths, made in self._merged:
            now = [s["path"] for s in m["logs"].get(log, [])]
            if not set(paths) <= set(now):
                raise Conflict(f"segments of {log} were merged or cleared meanwhile")
            at = now.index(paths[0])
            rest = [s for s in m["logs"][log] if s["path"] not in paths]
            m["logs"][log] = rest[:at] + ([made] if made else []) + rest[at:]
        for log in [*self._segments, *(t for t in self._schemas if t not in m["keys"])]:
            m["logs"].setdefault(log, [])
        for log, segments in self._segments.items():
            m["logs"][log].extend(segments)
        if self._from:
            times, of = self.n // self._from, self._from
            part = lambda x: {**x, "bytes": x["bytes"] // times, "of": x.get("of", of)}
            for t, held in m["buckets"].items():
                m["buckets"][t] = {str(int(b) + k * of): {**part(e), "deltas": list(map(part, e["deltas"]))} for b, e in held.items() for k in range(times)}
        m["facts"].update({"buckets": self.n, **self.facts})
        m["wrote"], m["last"] = self._wrote(), seq
        return m

    def commit(self) -> int:
        """Write and publish; the version. What others publish first is taken in, or ends this commit with Conflict."""
        conf = self.v.spark.conf
        before = conf.get(OPEN, None)
        conf.set(OPEN, str(OPEN_AT_ONCE))
        try:
            with ThreadPoolExecutor(WRITES) as pool:  # each is a Spark job of the thread that commits
                for writes in (self._writes, self._later):
                    for done in [pool.submit(inheritable_thread_target(self.v.spark)(w)) for w in writes]:
                        done.result()
        finally:
            conf.unset(OPEN) if before is None else conf.set(OPEN, before)
        self._writes.clear()
        self._later.clear()
        while True:
            newest = self.v.version()
            if newest != self.at:
                self._check(newest)
            manifest = self._applied(self.v.manifest(newest))
            if self.v._publish(manifest):
                return manifest["last"]
