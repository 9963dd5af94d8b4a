"""Phrases found in the corpus itself: collocation statistics by Spark, then the longest phrases of each text.

Candidates are runs of two to `longest` words that stand in one stretch, that is without a stop word or punctuation between. The words of
a phrase must attract each other: every two neighbours have a log-likelihood ratio of `least_ratio` or more and are seen together more
often than by chance. Candidates are then ordered by C-value, the logarithm of the length times the count, less what the
count owes to longer candidates around it."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

STRETCH = r"[^\p{L}\p{N}' ]+|(?<![\p{L}\p{N}'])(?:" + "|".join(T.STOP_WORDS) + r")(?![\p{L}\p{N}'])"
MARK = "|"  # no word holds it
SLICE = 32 << 20  # bytes of text whose words are numbered together
BITS, FACTOR = 134_217_689, 1_000_003  # a prime below 2 ** 27
MOST_PHRASES = 1_000_000  # phrases that are sent to every task, some tens of bytes each


def stretches(docs: DataFrame) -> DataFrame:
    """(doc_id, words): the words between two stop words or marks, in order of the text, where there are at least two."""
    parts = docs.select("doc_id", F.explode(F.split(F.lower("text"), STRETCH)).alias("part"))
    words = F.filter(F.split(F.trim("part"), " +"), lambda w: w != "")
    return parts.select("doc_id", words.alias("words")).where(F.size("words") > 1)


def _marked(docs: DataFrame) -> DataFrame:
    """The texts in lower case with their words between spaces and a MARK where a stretch ends at punctuation or at the text's end."""
    text = F.regexp_replace(F.lower("text"), r"[^\p{L}\p{N}' ]+", f" {MARK} ")
    return docs.where("text is not null").select(F.concat(text, F.lit(f" {MARK}")).alias("text"))


def _coded(batches, most: int = SLICE):
    """(words, codes) of each `most` bytes of marked texts: the distinct words, and the place in them of each word, -1 where a stretch ends."""
    for batch in batches:
        texts, at = batch.column(0), 0
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            found = pc.split_pattern(texts.slice(at, upto - at), " ").flatten().dictionary_encode()
            codes, words = found.indices.to_numpy().astype(np.int64), found.dictionary
            codes = codes[pc.not_equal(words, "").to_numpy(zero_copy_only=False)[codes]]
            stops = pc.is_in(words, value_set=pa.array([MARK, *T.STOP_WORDS])).to_numpy(zero_copy_only=False)
            codes[stops[codes]] = -1
            yield words, codes
            at = upto


def _pairs(batches):
    for words, codes in _coded(batches):
        both = (codes[:-1] >= 0) & (codes[1:] >= 0)
        key, n = np.unique(codes[:-1][both] * len(words) + codes[1:][both], return_counts=True)
        yield pa.RecordBatch.from_arrays([words.take(pa.array(key // len(words))), words.take(pa.array(key % len(words))), pa.array(n, pa.int64())], ["left_word", "right_word", "n"])


def collocations(docs: DataFrame, *, least: int = 1, keep=lambda rows, name: rows) -> DataFrame:
    """(left_word, right_word, n, ratio) of each two neighbouring words: how often they are, and the log-likelihood ratio of their being
    together, below zero where they are so less often than by chance. Pairs seen fewer than `least` times are left out after they were
    counted for the others. Tasks count the pairs of their texts before they are shuffled; keep(rows, name) may write rows that are
    read several times and give them back."""
    pairs = keep(_marked(docs).mapInArrow(_pairs, "left_word string, right_word string, n long").groupBy("left_word", "right_word").agg(F.sum("n").alias("n")), "pairs")
    left = pairs.groupBy("left_word").agg(F.sum("n").alias("a"))
    right = pairs.groupBy("right_word").agg(F.sum("n").alias("b"))
    total = left.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("t"))  # one row
    both = pairs.where(F.col("n") >= least).join(left, "left_word").join(right, "right_word").crossJoin(F.broadcast(total))
    x = lambda c: F.when(c > 0, c * F.log(c.cast("double"))).otherwise(F.lit(0.0))
    n, a, b, t = F.col("n"), F.col("a"), F.col("b"), F.col("t")
    cells = x(n) + x(a - n) + x(b - n) + x(t - a - b + n)
    margins = x(a) + x(t - a) + x(b) + x(t - b)
    sign = F.when(n.cast("double") * t >= a.cast("double") * b, 1.0).otherwise(-1.0)
    return both.select("left_word", "right_word", "n", (sign * F.lit(2.0) * (cells - margins + x(t))).alias("ratio"))


def _filter(good: DataFrame) -> np.ndarray:
    """A bit set of BITS bits with the pairs of good; 16 MB at most on the driver and in a task, whatever their number."""
    bit = (F.crc32(F.col("left_word").cast("binary")) * FACTOR + F.crc32(F.col("right_word").cast("binary"))) % BITS
    rows = good.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")).toArrow()
    bits = np.zeros(BITS // 64 + 1, np.int64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return bits.view(np.uint8)  # little-endian, so bit k is in byte k // 8


def _longer(docs: DataFrame, good: DataFrame, longest: int) -> DataFrame:
    """(phrase, size, n) of the runs of three to `longest` words whose neighbours are all in good, and of a few others that the filter takes for such."""
    shared = docs.sparkSession.sparkContext.broadcast(_filter(good))

    def run(batches):
        bits = shared.value
        for words, codes in _coded(batches):
            hashes = np.array([zlib.crc32(w.encode()) for w in words.to_pylist()], np.int64)
            at = np.flatnonzero((codes[:-1] >= 0) & (codes[1:] >= 0))
            bit = (hashes[codes[at]] * FACTOR + hashes[codes[at + 1]]) % BITS
            good_at = at[(bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0]
            is_good = np.zeros(len(codes), bool)
            is_good[good_at] = True
            at, known = good_at, codes[good_at]  # where the runs begin, and a number for all words but their last one
            for size in range(3, longest + 1):
                on = is_good[at + size - 2]  # the end of a run is no place behind the codes, which end with -1
                at, known = at[on], np.unique(known[on] * len(words) + codes[at[on] + size - 2], return_inverse=True)[1]
                _, first, n = np.unique(known * len(words) + codes[at + size - 1], return_index=True, return_counts=True)
                parts = [words.take(pa.array(codes[at[first] + k])) for k in range(size)]
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(*parts, " "), pa.array(np.full(len(n), size), pa.int32()), pa.array(n, pa.int64())], ["phrase", "size", "n"])

    return _marked(docs).mapInArrow(run, "phrase string, size int, n long").groupBy("phrase", "size").agg(F.sum("n").alias("n"))


def grams(words: Column, size: int) -> Column:
    """The runs of so many words, joined by one space."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda k: F.array_join(F.slice(words, k + 1, size), " "))
    return F.when(F.size(words) >= size, runs).otherwise(F.array().cast("array<string>"))


def phrases(docs: DataFrame, *, longest: int = 4, least: int = 5, least_ratio: float = 10.83, keep=lambda rows, name: rows) -> DataFrame:
    """(phrase, size, n, ratio, c_value) of the candidates seen `least` times or more whose neighbours attract each other; ratio is the
    least of its pairs. keep(rows, name) may write rows that are read twice and give them back.

    A phrase is not seen oftener than each of its pairs, so runs of more than two words are counted only where all their pairs may be
    good ones, by a filter of fixed size; the join with the good pairs decides."""
    pair = F.concat_ws(" ", "left_word", "right_word")
    good = keep(collocations(docs, least=least, keep=keep).where(F.col("ratio") >= least_ratio), "good")
    kept = good.select(pair.alias("phrase"), "n", F.lit(2).alias("size"), "ratio")
    if longest > 2:
        counted = _longer(docs, good, longest).where(F.col("n") >= least)
        pairs = counted.select("phrase", "n", "size", F.explode(grams(F.split("phrase", " "), 2)).alias("pair")).join(good.select(pair.alias("pair"), "ratio"), "pair")
        held = pairs.groupBy("phrase", "n", "size").agg(F.count("*").alias("held"), F.min("ratio").alias("ratio")).where(F.col("held") == F.col("size") - 1)
        kept = keep(kept.unionByName(held.drop("held")), "kept")
    inner = F.flatten(F.array(*(F.when(F.col("size") > k, grams(F.split("phrase", " "), k)).otherwise(F.array().cast("array<string>")) for k in range(2, longest))))
    around = kept.select(F.col("n").alias("__n"), F.explode(F.array_distinct(inner)).alias("__in")).groupBy("__in").agg(F.sum("__n").alias("__sum"), F.count("*").alias("__held"))
    own = kept.join(around, F.col("phrase") == F.col("__in"), "left")
    free = F.col("n") - F.coalesce(F.col("__sum") / F.col("__held"), F.lit(0.0))
    return own.select("phrase", "size", "n", "ratio", (F.log2(F.col("size").cast("double")) * free).alias("c_value"))


class Trie:
    """Phrases by their words, for the longest match."""

    def __init__(self, found: list[str]):
        self.root: dict = {}
        for p in found:
            node = self.root
            for w in p.split(" "):
                node = node.setdefault(w, {})
            node[""] = p

    def longest(self, words: list[str]) -> list[str]:
        """From left to right the longest phrase at each place, without overlaps."""
        out, at = [], 0
        while at < len(words):
            node, best, k = self.root, None, at
            while k < len(words) and (node := node.get(words[k])) is not None:
                k += 1
                if "" in node:
                    best = (k, node[""])
            if best:
                out.append(best[1])
            at = best[0] if best else at + 1
        return out


def mined_counts(docs: DataFrame, chosen: DataFrame, *, most: int = MOST_PHRASES) -> DataFrame:
    """(doc_id, term, count) of the phrases of chosen (phrase, c_value) in (doc_id, text): each stretch is cut into the longest ones, left to
    right. The `most` phrases of greatest c_value are used, a vocabulary size; they are all that the driver and the tasks hold."""
    top = [r.phrase for r in chosen.where("c_value > 0").orderBy(F.desc("c_value"), "phrase").limit(most).select("phrase").collect()]
    shared = docs.sparkSession.sparkContext.broadcast(Trie(top))

    def run(words: pa.Array) -> pa.Array:
        trie = shared.value
        return pa.array([trie.longest(w) for w in words.to_pylist()], pa.list_(pa.string()))

    found = stretches(docs).select("doc_id", F.explode(F.arrow_udf(run, "array<string>")("words")).alias("term"))
    return found.groupBy("doc_id", "term").agg(F.count("*").alias("count"))
