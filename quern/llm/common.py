"""Shared pieces of the training-data operators: the shared scratch folder and vectorised text hashing.

White space is ``[\\x20\\x09-\\x0D]`` everywhere; case folding touches A-Z only.
"""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import math
import struct
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CHUNK = 1 << 20  # bytes of text hashed at a time

HOT = 2048  # a key with more than this share of all rows is joined by broadcast: there are fewer such keys than this
MERGE_AT_ONCE = 256  # more tasks than this are merged in two steps

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local one only where that is unset and Spark runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; what lies there goes when the driver ends."""
    path = f"{shared_dir(spark)}/quern-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    if not _made:
        atexit.register(_clear)
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _clear() -> None:
    for spark, path in _made:
        try:
            delete(spark, path)
        except Exception:  # the session may have been stopped
            return


def stash(df: DataFrame, name: str, *, files: int | None = None, codec: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = scratch(spark, name)
    (df.coalesce(files) if files else df).write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._quern_path = path
    return out


def discard(*stashed: DataFrame) -> None:
    """Delete what stash wrote, once nothing reads it any more."""
    for df in stashed:
        delete(df.sparkSession, df._quern_path)
        _made.remove((df.sparkSession, df._quern_path))


def in_order(rows: DataFrame, *order) -> DataFrame:
    """rows, which must come from files, with `place`: from 0, in this order of all rows.

    Sorted by range and written; a place is the first of its task and the number in it. Rows that are alike are told apart by
    where they lie, so no value of the order is too frequent for a task."""
    salted = rows.withColumn("__at", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(*order, "__at").sortWithinPartitions(*order, "__at").drop("__at")
    ordered = stash(ordered.withColumn("__at", F.monotonically_increasing_id()), "in-order").withColumn("__task", F.shiftright("__at", 33))
    tasks = ordered.groupBy("__task").agg(F.count("*").alias("__held"))
    starts = tasks.select("__task", (F.sum("__held").over(Window.orderBy("__task")) - F.col("__held")).alias("__start"))
    return ordered.join(starts, "__task").select(*rows.columns, (F.col("__start") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).alias("place"))


def few(df: DataFrame) -> DataFrame:
    """The rows in at most a few partitions a core, without a shuffle: for tasks that each give out a structure of fixed size."""
    return df.coalesce(max(32, 4 * df.sparkSession.sparkContext.defaultParallelism))


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker and its JVM side hold at once; a smaller choice of the session's stays."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20)):
        now = str(spark.conf.get(key)).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return freed memory to the system: Python workers are used again by later stages, and their allocators keep what arrays held."""
    pa.default_memory_pool().release_unused()
    try:
        _libc().malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@functools.cache
def _libc():
    """The C library, told to keep no freed block of a megabyte or more (M_MMAP_THRESHOLD, which else grows with what is freed)."""
    lib = ctypes.CDLL("libc.so.6")
    lib.mallopt(-3, 1 << 20)
    return lib


def freed(run):
    """A mapInArrow function that gives memory back when it ends."""

    def wrapped(batches):
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more; else they stay until the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def let(value: F.Column, body) -> F.Column:
    """body(value) with value computed once: lambda variables are not expanded again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text) -> F.Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---- vectorised hashing (numpy, uint64 arithmetic wraps) ----

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2, _M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)
_S30, _S27, _S31, _S32 = np.uint64(30), np.uint64(27), np.uint64(31), np.uint64(32)
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    global _powers
    if len(_powers) < n:
        grown = np.full(1 << max(10, int(n).bit_length()), _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (the splitmix64 one)."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def _chunks(data: np.ndarray):
    """Slices of about CHUNK bytes that end at white space."""
    at = 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        while end < len(data):
            gap = np.flatnonzero(_SPACE[data[end : end + CHUNK]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + CHUNK, len(data))
        yield data[at:end]
        at = end


def word_hashes(data: np.ndarray) -> np.ndarray:
    """One uint64 for each word of the UTF-8 bytes, A-Z lower-cased; memory is bounded by CHUNK and the word count."""
    out = []
    for piece in _chunks(data):
        space = _SPACE[piece]
        edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(starts):
            continue
        lengths = ends - starts
        solid = _LOWER[piece][~space].astype(np.uint64) + np.uint64(1)
        first = np.cumsum(lengths) - lengths
        place = np.arange(len(solid)) - np.repeat(first, lengths)
        out.append(mix(np.add.reduceat(solid * powers(int(lengths.max()))[place], first)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingle_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the word windows in order; fewer words than size make one window, none make none."""
    if not len(w):
        return w
    n = min(size, len(w))
    acc = np.full(len(w) - n + 1, n, dtype=np.uint64) * _M3
    for k in range(n):
        acc = mix(acc * _M1 + w[k : len(w) - n + 1 + k])
    return acc


def texts_of(column: pa.ChunkedArray | pa.Array):
    """For each row of an Arrow string column its UTF-8 bytes as a uint8 array (null: empty), without copies."""
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        wide = pa.types.is_large_string(part.type)
        _, offsets, data = part.buffers()
        if not len(part):
            continue
        at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[part.offset : part.offset + len(part) + 1]
        whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        null = part.is_null().to_numpy(zero_copy_only=False)
        for k in range(len(part)):
            yield whole[:0] if null[k] else whole[at[k] : at[k + 1]]


def _word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes with the byte at which each word starts."""
    hashes, starts, at = [], [], 0
    for piece in _chunks(data):
        edge = np.diff(np.concatenate(([True], _SPACE[piece], [True])).view(np.int8))
        starts.append(np.flatnonzero(edge == -1) + at)
        hashes.append(word_hashes(piece))
        at += len(piece)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return join(hashes, np.uint64), join(starts, np.int64)


def groups_of(column: pa.Array):
    """Runs of consecutive rows holding about CHUNK bytes: (first row, list of their UTF-8 bytes)."""
    first, held, size = 0, [], 0
    for k, x in enumerate(texts_of(column)):
        if held and size + len(x) > CHUNK:
            yield first, held
            first, held, size = k, [], 0
        held.append(x)
        size += len(x)
    if held:
        yield first, held


def shingle_sets(texts: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, laid end to end, and the bounds between texts."""
    data = np.frombuffer(b" ".join(x.tobytes() for x in texts) + b" ", dtype=np.uint8)
    begins = np.cumsum([0] + [len(x) + 1 for x in texts])
    w, at = _word_spans(data)
    edges = np.searchsorted(at, begins)  # words of text k: edges[k] to edges[k + 1]
    counts = np.diff(edges)
    windows = shingle_hashes(w, size) if len(w) >= size else np.zeros(0, np.uint64)
    parts, bounds = [], np.zeros(len(texts) + 1, np.int64)
    for k, (s, e) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        own = windows[s : e - size + 1] if counts[k] >= size else shingle_hashes(w[s:e], size)
        if len(own) > 1:
            own = np.sort(own)
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        parts.append(own)
        bounds[k + 1] = bounds[k] + len(own)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), bounds


# ---- joins with keys that hold many rows ----


def split_join(rows: DataFrame, table: DataFrame, key: str, held: str) -> DataFrame:
    """rows inner join table, which has one row a key and in the column `held` the number of rows of that key.

    Keys with more than 1 / HOT of all rows, HOT of them at most, are joined by broadcast, where they stay in their tasks; the
    others by Spark's own choice. Rows without a partner go."""
    seen = table.agg(F.sum(held).alias("all"), F.max(held).alias("most")).first()
    bar = max(10_000, (seen["all"] or 0) // HOT)
    if (seen["most"] or 0) <= bar:
        return rows.join(table, key)
    hot = table.where(F.col(held) > bar)
    cold = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table.where(F.col(held) <= bar), key)
    return cold.unionByName(rows.join(F.broadcast(hot), key))


# ---- fixed-size bit sets and counters, summed over tasks in slices ----

SLICES = 64
_PACK = pa.Codec("zstd", 1)


def gathered(parts: DataFrame, step, finish=None) -> list:
    """Rows (slice int, data binary) of many tasks merged by step, a mapInArrow function from such rows to one row a slice; finish
    is a last one, over merged rows.

    Slices are dealt over tasks and streamed. Where there are many tasks, groups of them are merged first."""
    tasks = max(32, 4 * parts.sparkSession.sparkContext.defaultParallelism)  # few() allows no more
    if tasks > MERGE_AT_ONCE:
        groups = math.ceil(math.sqrt(tasks))
        grouped = parts.withColumn("of", F.pmod(F.spark_partition_id(), F.lit(groups))).repartition(SLICES * groups, "slice", "of")
        parts = grouped.select("slice", "data").mapInArrow(step, "slice int, data binary")
    step = freed(step)
    at_once = min(SLICES, max(4, parts.sparkSession.sparkContext.defaultParallelism))
    merged = parts.repartition(at_once, "slice").mapInArrow(step, "slice int, data binary")
    return (merged.mapInArrow(finish, "slice int, data binary") if finish else merged).collect()


def sums_of(combine, first: str, then: str):
    """A step for gathered: combine two arrays of type then; a task's own are of type first, told apart by a leading byte."""

    def step(batches):
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = x.as_py()
                part = np.frombuffer(zlib.decompress(x[1:]), then if x[0] else first).astype(then)
                have[k] = combine(have[k], part) if k in have else part
        yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int32()), pa.array([b"\1" + zlib.compress(x.tobytes(), 1) for x in have.values()], pa.binary())], ["slice", "data"])

    return step


def merged_slices(parts: DataFrame, combine, first: str = "u1", then: str | None = None) -> np.ndarray:
    """The tasks' arrays, given out by in_slices, combined into one; the driver receives one array, of a size that the caller's
    parameter fixes."""
    then = then or first
    found = {r.slice: np.frombuffer(zlib.decompress(r.data[1:]), then) for r in gathered(parts, sums_of(combine, first, then))}
    return np.concatenate([found[k] for k in range(SLICES)]) if len(found) == SLICES else np.zeros(0, then)


def in_slices(array: np.ndarray) -> pa.RecordBatch:
    step = len(array) // SLICES
    packed = [b"\0" + zlib.compress(array[k * step : (k + 1) * step].tobytes(), 1) for k in range(SLICES)]
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(packed, pa.binary())], ["slice", "data"])


class Compressed:
    """Pickled with its arrays compressed: a broadcast lies in a file of every executor until that collects garbage, and filters
    that are large for an input are mostly zeros."""

    def __getstate__(self) -> dict:
        return {k: (_PACK.compress(v.tobytes(), asbytes=True), v.dtype.str, v.nbytes) if isinstance(v, np.ndarray) else v for k, v in self.__dict__.items()}

    def __setstate__(self, state: dict) -> None:
        for k, v in state.items():
            packed = isinstance(v, tuple) and len(v) == 3 and isinstance(v[0], bytes)
            setattr(self, k, np.frombuffer(_PACK.decompress(v[0], v[2], asbytes=True), v[1]) if packed else v)


class Bits(Compressed):
    """An array to broadcast."""

    def __init__(self, array: np.ndarray):
        self.array = array


def set_bits(array: np.ndarray, at: np.ndarray) -> None:
    """Set bits at positions given in any order."""
    if not len(at):
        return
    at = np.unique(at)
    byte = (at >> np.uint64(3)).astype(np.int64)
    cut = np.flatnonzero(np.diff(byte, prepend=-1))
    array[byte[cut]] |= np.bitwise_or.reduceat(np.left_shift(1, (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8), cut)


def has_bit(array: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (array[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bloom_places(words: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of each 64-bit hash in a Bloom filter of so many 64-bit words, a power of two, and its two bits there. Sorted hashes
    have sorted words, so filters are filled and asked in order."""
    shift = 65 - words.bit_length()
    one = np.uint64(1)
    return (h >> np.uint64(shift) if shift < 64 else np.zeros(len(h), np.uint64)).astype(np.int64), (one << (h & np.uint64(63))) | (one << ((h >> np.uint64(6)) & np.uint64(63)))


def in_bloom(array: np.ndarray, h: np.ndarray) -> np.ndarray:
    word, mask = bloom_places(len(array), h)
    return (array[word] & mask) == mask


class TwiceFilter:
    """Two Bloom filters over hashes: once for those seen, twice for those seen before.

    bits is a power of two, 4096 at least. add takes the distinct hashes of a document. Merging two tasks keeps once = a | b and twice = s | t | (a & b), so every hash of
    two documents is in the merged twice filter; more hashes than suit the size only let more of the others in."""

    def __init__(self, bits: int, at_once: int = 250_000):
        self.at_once = at_once
        self.once, self.twice = np.zeros(bits // 64, np.uint64), np.zeros(bits // 64, np.uint64)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, hashes: np.ndarray) -> None:
        self.held.append(hashes)
        self.size += len(hashes)
        if self.size > self.at_once:
            self.take()

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """Work in what waits; the distinct hashes and how often they waited."""
        h, times = np.unique(np.concatenate(self.held), return_counts=True) if self.held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.held, self.size = [], 0
        self.mark(h, times)
        return h, times

    def mark(self, h: np.ndarray, times: np.ndarray) -> None:
        """Work in sorted distinct hashes and in how many documents they were."""
        if len(h):
            word, mask = bloom_places(len(self.once), h)
            seen = (times > 1) | ((self.once[word] & mask) == mask)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            self.once[word[first]] |= np.bitwise_or.reduceat(mask, first)
            self.twice[word[first]] |= np.bitwise_or.reduceat(np.where(seen, mask, np.uint64(0)), first)

    def slices(self) -> pa.RecordBatch:
        self.take()
        return _both(range(SLICES), np.split(self.once, SLICES), np.split(self.twice, SLICES))


def text_bytes(texts: DataFrame, text_col: str) -> int:
    """The bytes of all texts."""
    return int(texts.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0)


def power_above(n: float, least: int = 1 << 12) -> int:
    """The smallest power of two that is not below n, nor below least."""
    return max(least, 1 << max(0, math.ceil(n) - 1).bit_length())


def _both(slices, once, twice) -> pa.RecordBatch:
    packed = []
    for a, t in zip(once, twice, strict=True):
        size, a, t = a.nbytes, _PACK.compress(a, asbytes=True), _PACK.compress(t, asbytes=True)
        packed.append(struct.pack("<II", size, len(a)) + a + t)
    return pa.RecordBatch.from_arrays([pa.array(slices, pa.int32()), pa.array(packed, pa.binary())], ["slice", "data"])


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    size, cut = struct.unpack_from("<II", data)
    return tuple(np.frombuffer(_PACK.decompress(x, size, asbytes=True), np.uint64) for x in (data[8 : 8 + cut], data[8 + cut :]))


def _merge_twice(batches):
    have: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            once, twice = _unpack(x.as_py())
            if k in have:
                a, t = have[k]
                t |= twice
                t |= a & once
                a |= once
            else:
                have[k] = [once.copy(), twice.copy()]
    yield _both(list(have), [a for a, _ in have.values()], [t for _, t in have.values()])


def only_twice(batches):
    """Merged slices without their once filters."""
    for batch in batches:
        rows = [(k, x.as_py()) for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)]
        cut = [struct.pack("<I", struct.unpack_from("<I", x)[0]) + x[8 + struct.unpack_from("<I", x, 4)[0] :] if k < SLICES else x for k, x in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.binary())], ["slice", "data"])


def twice_of(found: dict[int, bytes], bits: int) -> np.ndarray:
    """The array of slices that went through only_twice."""
    size = struct.Struct("<I")
    parts = [np.frombuffer(_PACK.decompress(found[k][4:], size.unpack_from(found[k])[0], asbytes=True), np.uint64) for k in range(SLICES) if k in found]
    return np.concatenate(parts) if parts else np.zeros(bits // 64, np.uint64)


def merged_twice(parts: DataFrame, bits: int) -> np.ndarray:
    """The twice filter of all tasks from their TwiceFilter.slices: bits / 8 bytes for the driver before compression."""
    return twice_of({r.slice: r.data for r in gathered(parts, _merge_twice, only_twice)}, bits)


def id_filter(ids: DataFrame, bits: int = 1 << 23) -> np.ndarray:
    """A one-probe bit set of the longs in the only column: no false negatives, bits / 8 bytes whatever the input."""

    def run(batches):
        mine = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            set_bits(mine, mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)) % np.uint64(bits))
        yield in_slices(mine)

    out = merged_slices(few(ids).mapInArrow(freed(run), "slice int, data binary"), np.bitwise_or)
    return out if len(out) else np.zeros(bits // 8, np.uint8)


def in_filter(ids: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return has_bit(bits, mix(ids.astype(np.uint64)) % np.uint64(len(bits) * 8))


# ---- connected components ----


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label): the smallest node reachable over the edges (a, b); nodes without edges are absent.

    Alternates large-star and small-star until the edge set stops changing; every round is written to the shared folder. It
    raises if that takes more than most_rounds rounds; the rounds grow with the logarithm of the longest path."""
    e = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    print_of = lambda x: x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = print_of(e)
    for _ in range(most_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        old, e = e, stash(small, "edges")
        discard(old)
        now = print_of(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
