"""WARC writing and a splittable reader.

Archives hold one gzip member a record. A reading task gets a byte range, looks for the gzip magic in it, takes a candidate as a
member only if it decompresses to a WARC header whose Content-Length fits the member, and owns the records whose members
start inside its range; it reads past the range's end to finish the last one. Members are decompressed in pieces, so a task's
memory is bounded by one piece and one header, and by one payload only when payloads are asked for. A member that begins with the
bytes of a WARC version is read until its header ends, however long that is; others are given up after a few bytes.

Writing tasks use new file names and return a manifest; only the manifest of attempts that Spark committed is read, so repeated
or lost attempts leave no trace in the result. Paths are opened with pyarrow's file systems (local, HDFS, object stores).

Defined cases: a null payload is empty; a null target gives a record without target; line ends in targets are percent-encoded;
an empty table gives no archive; of rows that repeat the smallest id of a payload all are responses; a row with a null id is a
response and refers to nothing; rows that share an id, or have none, get records of different names, and a revisit refers to the
first of them; other columns are never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, small_batches, split_join, stash

MAGIC = b"\x1f\x8b\x08"
PIECE = 1 << 18
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def record_id(key, digest: str, again: int = 0) -> str:
    """The name of the record of a key and payload; again tells rows apart that repeat both, or have no key."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{key}:{digest}:{again}')}>"


def record(key, uri: str | None, payload: bytes, digest: str, first=None, again: int = 0) -> bytes:
    """One record as a gzip member: a response, or with first a revisit of the record with that key."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if first is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if first is None else 'revisit'}", f"WARC-Record-ID: {record_id(key, digest, again)}", f"WARC-Date: {DATE}"]
    if uri:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if key is not None:
        head.append(f"X-Key: {key}")
    if first is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}", f"X-Refers-To-Key: {first}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _write(folder: str):
    def run(batches):
        system, base = open_fs(folder)
        name, out, size, n = f"part-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        for batch in batches:
            for key, uri, html, digest, first, again in zip(*batch.columns, strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(f"{base}/{name}", compression=None)
                member = record(key.as_py(), uri.as_py(), (html.as_py() or "").encode(), digest.as_py(), first.as_py(), again.as_py())
                out.write(member)
                size, n = size + len(member), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], ["path", "size", "records"])

    return run


def write_warc(pages: DataFrame, *, id_col="page_id", uri_col="url", payload_col="html", smallest: int = 100) -> DataFrame:
    """Write one record a row; the manifest (path, size, records) of the archives. Of equal payloads of at least `smallest`
    bytes the row of smallest id is the response and the others revisit it."""
    spark = pages.sparkSession
    small_batches(spark)
    body = F.coalesce(F.col(payload_col), F.lit(""))
    digest = F.sha2(body.cast("binary"), 256)
    small = stash(pages.where(F.octet_length(body) >= smallest).select(F.col(id_col).cast("long").alias("key"), digest.alias("digest")), "payload-digests")
    first = stash(small.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("held")).where("first < last").drop("last"), "first-payloads")
    again = split_join(small, first, "digest", "held").where("key > first").select("digest", "key", "first").distinct()
    rows = pages.select(F.col(id_col).cast("long").alias("k"), F.col(uri_col).cast("string").alias("uri"), F.col(payload_col).alias("html"), digest.alias("d"))
    rows = rows.join(again, (F.col("k") == F.col("key")) & (F.col("d") == F.col("digest")), "left").select("k", "uri", "html", "d", "first")
    number = F.when(F.col("k").isNull(), F.monotonically_increasing_id() + 1).otherwise(0)
    repeated = pages.groupBy(F.col(id_col).cast("long").alias("k")).count().where("k is not null and count > 1").select("k")
    if repeated.limit(1).count():  # rows that repeat an id: of those with one payload all but the first get a number
        place = F.row_number().over(Window.partitionBy("k", "d").orderBy(F.xxhash64("uri", "html"))) - 1
        several = rows.join(repeated, "k", "left_semi").withColumn("again", place.cast("long"))
        rows = rows.join(repeated, "k", "left_anti").withColumn("again", number).unionByName(several)
    else:
        rows = rows.withColumn("again", number)
    return stash(rows.mapInArrow(_write(scratch(spark, "warc")), "path string, size long, records long"), "warc-manifest")


class _Source:
    """Reads one archive forwards in pieces from any offset."""

    def __init__(self, handle, size: int):
        self.handle, self.size = handle, size

    def pieces(self, at: int):
        while at < self.size:
            self.handle.seek(at)
            piece = self.handle.read(min(PIECE, self.size - at))
            if not piece:
                return
            yield at, piece
            at += len(piece)

    def find(self, at: int, end: int) -> int | None:
        """The first magic that starts in [at, end)."""
        tail, where = b"", at
        for place, piece in self.pieces(at):
            data, where = tail + piece, place - len(tail)
            k = data.find(MAGIC)
            if k >= 0:
                return where + k if where + k < end else None
            if place + len(piece) >= end + len(MAGIC):
                return None
            tail = data[-2:]
        return None


def member(source: _Source, at: int, with_payload: bool):
    """The record whose gzip member starts at `at`: (dict, offset behind it), or None if there is none."""
    unzip, head, info, left, block = zlib.decompressobj(31), bytearray(), None, 0, None
    for place, piece in source.pieces(at):
        whole = len(piece)
        while True:
            try:
                data = unzip.decompress(piece, PIECE)
            except zlib.error:
                return None
            piece, got = unzip.unconsumed_tail, len(data)
            if info is None:
                looked = max(0, len(head) - 3)
                head += data
                if not head.startswith(b"WARC/1."[: len(head)]):
                    return None
                cut = head.find(b"\r\n\r\n", looked)
                if cut >= 0:
                    lines = bytes(head[:cut]).decode("utf-8", "replace").split("\r\n")
                    info = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
                    if "warc-type" not in info or not info.get("content-length", "").isdigit():
                        return None
                    left, block, data = int(info["content-length"]) + 4, _Block(info, with_payload), bytes(head[cut + 4 :])
            if info is not None and data:
                if len(data) > left:
                    return None
                body = left - 4
                if body > 0:
                    block.take(data[:body])
                left -= len(data)
            if unzip.eof or (not piece and got < PIECE):
                break
        if unzip.eof:
            if info is None or left:
                return None
            return block.done(), place + whole - len(unzip.unused_data)
    return None


class _Block:
    """A record's block: the HTTP head is cut off, the rest is the payload."""

    def __init__(self, info: dict, with_payload: bool):
        self.info, self.with_payload = info, with_payload
        self.http = info.get("content-type", "").startswith("application/http")
        self.head, self.length, self.sha, self.kept = b"", 0, hashlib.sha256(), []

    def take(self, data: bytes) -> None:
        if self.http and self.head is not None and not isinstance(self.head, dict):
            self.head += data
            cut = self.head.find(b"\r\n\r\n")
            if cut < 0:
                return
            lines = self.head[:cut].decode("utf-8", "replace").split("\r\n")
            data = self.head[cut + 4 :]
            self.head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        self.length += len(data)
        self.sha.update(data)
        if self.with_payload:
            self.kept.append(data)

    def done(self) -> dict:
        head = self.head if isinstance(self.head, dict) else {}
        revisit = self.info["warc-type"] == "revisit"
        length, digest = self.length, self.sha.hexdigest()
        if revisit:  # of the full payload, which the record it refers to holds
            length, digest = int(head.get("content-length") or 0), self.info.get("warc-payload-digest", "").removeprefix("sha256:")
        return {"type": self.info["warc-type"], "record_id": self.info.get("warc-record-id"), "uri": self.info.get("warc-target-uri"), "key": self.info.get("x-key"), "refers_to": self.info.get("x-refers-to-key"), "payload_bytes": length, "payload_digest": digest, "payload": b"".join(self.kept) if self.with_payload and not revisit else None}


SCHEMA = "path string, offset long, type string, record_id string, uri string, key string, refers_to string, payload_bytes long, payload_digest string, payload binary"
_ARROW = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()), ("key", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def records_in(source: _Source, start: int, end: int, with_payload: bool):
    """The records whose members start in [start, end), with their offsets."""
    at = start
    while at < end and (at := source.find(at, end)) is not None:
        got = member(source, at, with_payload)
        if got is None:
            at += 1
            continue
        yield at, got[0]
        at = got[1]


def _scan(with_payload: bool):
    def run(batches):
        for batch in batches:
            for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, name = open_fs(path)
                with system.open_input_file(name) as handle:
                    rows, held = [], 0
                    for at, row in records_in(_Source(handle, size), start, end, with_payload):
                        rows.append({"path": path, "offset": at, **row})
                        held += len(row["payload"] or b"") + 200
                        if held > 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return run


def read_warc(archives: DataFrame, *, split: int = 1 << 22, with_payload: bool = True) -> DataFrame:
    """Every record of the archives (path, size), read in byte ranges of `split` bytes."""
    ranges = archives.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split).cast("long"))).alias("start")).withColumn("end", F.least(F.col("start") + split, F.col("size")))
    total = archives.agg(F.sum("size")).first()[0] or 0
    return ranges.repartition(max(1, min(100_000, total // split)), "path", "start").mapInArrow(_scan(with_payload), SCHEMA)


def read_whole(archives: DataFrame, **options) -> DataFrame:
    """read_warc of a manifest (path, size, records), written to the shared folder; it raises if an archive gave another number of records
    than the manifest says."""
    out = stash(read_warc(archives, **options), "warc-records")
    got = out.groupBy("path").agg(F.count("*").alias("got"))
    both = archives.select("path", "records").join(got, "path", "left").where(~F.col("records").eqNullSafe(F.coalesce("got", F.lit(0))))
    wrong = both.limit(5).collect()
    if wrong:
        raise ValueError("records lost or added: " + ", ".join(f"{r.path}: {r.got} of {r.records}" for r in wrong))
    return out


def archives_at(spark: SparkSession, glob: str) -> DataFrame:
    """(path, size) of the files that match, listed by Spark without reading them."""
    return spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("size"))
