"""Importance resampling towards a target distribution, by hashed word runs.

Each document is scanned once. For every position the running zlib states of the last n starts are kept: a new word begins a state
of its own and extends the others by a space and itself, so all runs of 1 to n words are hashed with one step a run and no run
is ever built as a string. The scan emits the buckets of its runs and their counts; what the corpus and the target
hold in each bucket is summed from those, and so are the weights of the documents.

A bucket's gain is the floor of 1000 ln of target share over corpus share, with one added to each bucket. A document's weight
is the sum of gains over its runs; adding keyed Gumbel noise and taking the highest scores draws without replacement in proportion to the
exponentials of the weights. The draw sorts small rows (id, weight, score) by range; only their number is taken from it.

Memory: a scan holds a text and a megabyte of its words, and at most `buckets` counters a document; the driver receives `buckets`
gains. Defined cases: a null or wordless text has no runs and weight 0; a null id is hashed as an empty one; rows that repeat have equal
scores and are ranked one by one; an empty table, and one of short texts only, draw nothing; an empty target makes
buckets that the corpus seldom fills worth more; extra columns are not touched.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _chunks, freed, in_order, small_batches, stash, texts_of

BUCKETS = 10_000
#: Bytes that belong to words, lower-cased; all others become spaces.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Ring:
    """The running states of the last n starts, carried from piece to piece of a text."""

    def __init__(self, n: int):
        self.states: list[int | None] = [None] * (n + 1)  # at k: of the run of k words that ends with the last word

    def runs(self, words: list[bytes]) -> list[list[int]]:
        """For k = 1 .. n the states of the runs of k words that end in these words, in order."""
        if not words:
            return []
        spaced = [b" " + w for w in words]
        out = [list(map(zlib.crc32, words))]
        for k in range(2, len(self.states)):
            before = out[-1][:-1] if self.states[k - 1] is None else [self.states[k - 1], *out[-1][:-1]]
            out.append(list(map(zlib.crc32, spaced[len(spaced) - len(before) :], before)))
        for k, states in enumerate(out, 1):
            self.states[k] = states[-1] if states else None
        return out


def text_buckets(data: np.ndarray, n: int, size: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(words, buckets in order, their counts) of the runs of a text's UTF-8 bytes."""
    ring, words, total = Ring(n), 0, None
    for piece in _chunks(data):
        own = piece.tobytes().translate(_FOLD).split()
        words += len(own)
        found = ring.runs(own)
        if not found:
            continue
        at = np.concatenate([np.array(x, np.uint32) for x in found]) % np.uint32(size)
        if total is None and len(data) == len(piece):  # the whole text
            return words, *np.unique(at, return_counts=True)
        total = np.bincount(at, minlength=size) + (0 if total is None else total)
    if total is None:
        return words, np.zeros(0, np.uint32), np.zeros(0, np.int64)
    held = np.flatnonzero(total)
    return words, held, total[held]


def _scan(n: int, size: int):
    def run(batches):
        for batch in batches:
            rows = [text_buckets(x, n, size) for x in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([int(r[2].sum()) for r in rows], pa.int64()),
                    pa.array([np.diff(r[1].astype("<u4"), prepend=np.uint32(0)).astype("<u4").tobytes() for r in rows], pa.binary()),
                    pa.array([r[2].astype("<u4").tobytes() for r in rows], pa.binary()),
                ],
                ["id", "n_words", "n_features", "steps", "counts"],
            )

    return run


def bucket_counts(docs: DataFrame, *, id_col="doc_id", text_col="text", runs: int = 3, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, steps, counts): one scan of the documents, written to the shared folder. steps are the differences
    of the buckets in order, both are little-endian 32-bit numbers."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    found = rows.mapInArrow(freed(_scan(runs, buckets)), f"id {kind}, n_words long, n_features long, steps binary, counts binary")
    return stash(found, "run-buckets", codec="zstd")


def _numbers(batch: pa.RecordBatch):
    """For each row its buckets and their counts."""
    for s, c in zip(batch.column("steps"), batch.column("counts"), strict=True):
        yield np.cumsum(np.frombuffer(s.as_buffer(), "<u4"), dtype=np.int64), np.frombuffer(c.as_buffer(), "<u4").astype(np.int64)


def totals(scanned: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, held): each task gives out its sums, `buckets` rows at most."""

    def run(batches):
        have = np.zeros(buckets, np.int64)
        for batch in batches:
            for at, n in _numbers(batch):
                have[at] += n
        at = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(have[at], pa.int64())], ["bucket", "held"])

    return scanned.select("steps", "counts").mapInArrow(run, "bucket int, held long").groupBy("bucket").agg(F.sum("held").alias("held"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket, from the totals of both."""
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(corpus.withColumnRenamed("held", "s"), "bucket", "left").join(target.withColumnRenamed("held", "t"), "bucket", "left").fillna(0)
    all_s, all_t = (x.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0] for x in (corpus, target))
    ratio = ((F.col("t") + 1).cast("double") * F.lit(float(all_s + buckets))) / ((F.col("s") + 1).cast("double") * F.lit(float(all_t + buckets)))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def _weigh(gain: np.ndarray):
    def run(batches):
        for batch in batches:
            weight = [int(gain[at] @ n) for at, n in _numbers(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), batch.column("n_features"), pa.array(weight, pa.int64())], ["id", "n_words", "n_features", "weight"])

    return run


def noise(id_, seed) -> F.Column:
    """floor of 1000 times standard Gumbel noise, keyed by the seed and the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, runs: int = 3, buckets: int = BUCKETS, seed=42, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, n_words, n_features, weight, score, rank) of every document; rank is null for those not drawn.

    target has a column text_col. Of the documents with least_words words, percent in a hundred (rounded down) are drawn."""
    scanned = bucket_counts(docs, id_col=id_col, text_col=text_col, runs=runs, buckets=buckets)
    aim = bucket_counts(target.select(F.lit(0).alias("id"), F.col(text_col).alias("text")), id_col="id", text_col="text", runs=runs, buckets=buckets)
    gain = np.zeros(buckets, np.int64)
    held = [stash(totals(x, buckets), "run-totals", files=1) for x in (scanned, aim)]
    for r in gains(*held, buckets).collect():  # `buckets` rows
        gain[r.bucket] = r.gain
    kind = docs.schema[id_col].dataType.simpleString()
    weighed = scanned.mapInArrow(freed(_weigh(gain)), f"id {kind}, n_words long, n_features long, weight long")
    weighed = stash(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "weights")
    able = weighed.where(F.col("n_words") >= least_words)
    placed = in_order(able, F.col("score").desc(), F.col("id").asc_nulls_last())
    most = percent * able.count() // 100
    ranked = placed.withColumn("rank", F.when(F.col("place") < most, F.col("place") + 1)).drop("place")
    return ranked.unionByName(weighed.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def drawn_documents(docs: DataFrame, target: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The drawn documents in their own columns; rows that repeat an id of the draw are all taken."""
    out = resample(docs, target, id_col=id_col, text_col=text_col, **options).where("rank is not null").select(F.col("id").alias("__drawn")).distinct()
    return docs.join(out, docs[id_col].eqNullSafe(out["__drawn"]), "left_semi")
