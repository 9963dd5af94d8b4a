"""Line dedup with two Bloom filters: hashes seen once and hashes seen twice.

Each task sets its documents' line hashes in a once filter and, when a hash was there before, in a twice filter. Merging two
tasks keeps once = a | b and twice = ta | tb | (a & b), so every line of two documents is in the merged twice filter. Only
lines found there are shuffled, as 128-bit digests, for exact confirmation and the choice of the smallest document id; lines
that very many documents hold meet their smallest id by a broadcast of bounded size (`common.split_join`). The filters' size is the parameter filter_bits (16 MB by default), whatever the input: over more lines they let more lines
through to the exact step, never fewer.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; keys under min_chars code points are left alone.
Defined cases: a null or empty text is one empty line and stays empty; rows with a null id keep all lines and count for no
other row; rows that repeat an id are one document; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bits, TwiceFilter, discard, few, freed, in_bloom, merged_twice, small_batches, split_join, stash

BLANK = " \t\n\x0b\x0c\r"


def line_key(line: str, min_chars: int) -> bytes | None:
    line = line.strip(BLANK)
    return line.encode().lower() if len(line) >= min_chars else None


def _filters(min_chars: int, bits: int):
    """mapInArrow: a task's documents to its two filters, in compressed slices."""

    def run(batches):
        seen = TwiceFilter(bits, 50_000)
        for batch in batches:
            for text in batch.column(0):
                keys = {k for x in (text.as_py() or "").split("\n") if (k := line_key(x, min_chars)) is not None}
                if keys:
                    seen.add(np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys)))
        yield seen.slices()

    return run


def twice_filter(docs: DataFrame, id_col: str, text_col: str, min_chars: int, bits: int) -> np.ndarray:
    known = docs.where(F.col(id_col).isNotNull()).select(F.col(text_col))
    return merged_twice(few(known).mapInArrow(freed(_filters(min_chars, bits)), "slice int, data binary"), bits)


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _suspects(filter_b, min_chars: int):
    def run(batches):
        twice = filter_b.value.array
        for batch in batches:
            ids, keys = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = {k for x in (text.as_py() or "").split("\n") if (k := line_key(x, min_chars)) is not None}
                if not own:
                    continue
                own = list(own)
                h = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own))
                for k in np.flatnonzero(in_bloom(twice, h)):
                    ids.append(doc)
                    keys.append(digest(own[k]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return run


def _clean(min_chars: int):
    kind = pa.struct([("kept", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def run(texts: pa.Array, drops: pa.Array) -> pa.Array:
        out = []
        for text, drop in zip(texts, drops, strict=True):
            text, drop = text.as_py() or "", drop.as_py()
            lines = text.split("\n")
            if drop:
                drop = set(drop)
                stay = [x for x in lines if (k := line_key(x, min_chars)) is None or digest(k) not in drop]
                out.append({"kept": "\n".join(stay), "n_lines": len(lines), "n_dropped": len(lines) - len(stay)})
            else:
                out.append({"kept": text, "n_lines": len(lines), "n_dropped": 0})
        return pa.array(out, kind)

    return F.arrow_udf(run, "kept string, n_lines long, n_dropped long")


def dropped_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int, bits: int) -> DataFrame:
    """(doc_id, keys): the digests of the lines that the document loses."""
    spark = docs.sparkSession
    small_batches(spark)
    filter_b = spark.sparkContext.broadcast(Bits(twice_filter(docs, id_col, text_col, min_chars, bits)))
    known = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col))
    suspects = stash(known.mapInArrow(freed(_suspects(filter_b, min_chars)), "doc_id long, key binary"), "line-suspects")
    filter_b.unpersist()
    repeats = suspects.groupBy("key").agg(F.min("doc_id").alias("keep"), F.max("doc_id").alias("last"), F.count("*").alias("held")).where("keep < last").drop("last")
    repeats = stash(repeats, "repeated-lines")
    lost = stash(split_join(suspects, repeats, "key", "held").where("doc_id > keep").select("doc_id", "key"), "lost-lines")
    discard(suspects, repeats)
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def dedup_lines(docs: DataFrame, *, id_col="doc_id", text_col="text", min_chars: int = 10, filter_bits: int = 1 << 27) -> DataFrame:
    """(row, kept, n_lines, n_dropped): the input row as a struct, its text without the repeated lines, and the counts."""
    lost = dropped_keys(docs, id_col, text_col, min_chars, filter_bits).alias("l")
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row")).alias("d")
    both = d.join(lost, F.col(f"d.row.{id_col}") == F.col("l.doc_id"), "left")
    return both.select("d.row", _clean(min_chars)(F.col(f"d.row.{text_col}"), F.col("l.keys")).alias("c")).select("row", "c.*")


def deduped_documents(docs: DataFrame, *, id_col="doc_id", text_col="text", count_col: str | None = "n_chars", **options) -> DataFrame:
    """The documents with their kept lines as text and, where there is such a column, the new length; a null text stays null."""
    out = dedup_lines(docs, id_col=id_col, text_col=text_col, **options)
    kept = F.when(F.col(f"row.{text_col}").isNull(), None).otherwise(F.col("kept"))
    new = {text_col: kept, count_col: F.length(kept).cast("long") if count_col else None}
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns))
