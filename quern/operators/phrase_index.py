"""A positional inverted index for phrase search.

Postings are rows (term, document, generation, places): the places of a term in a document, each as the difference to the one before. They
lie in buckets by term, so a search reads the buckets of its terms only. The dictionary has the number of documents of each
term. A document that is added again gets a new generation, and one that is removed leaves the table of live generations; its old
postings are passed over until `clean` drops them.

A phrase is text, not words: its first and last word may be parts of longer ones ("old pric" is in "gold prices"). Words inside a phrase
are terms as they are; an open end is looked up in the dictionary as the start, end or part of terms. Documents in which the places
fit one behind the other are the candidates, and only their texts are read for the snippets, which decide."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from .versions import Versions


def _absolute(steps: pa.Array) -> pa.Array:
    """Lists of differences as lists of places."""
    values, ends = steps.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(pa.compute.list_value_length(steps).to_numpy(zero_copy_only=False))
    upto = np.concatenate(([0], np.cumsum(values)))
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    places = upto[1:] - np.repeat(upto[starts], ends - starts)
    return pa.ListArray.from_arrays(pa.array(np.concatenate((starts[:1], ends)) if len(ends) else [0], pa.int32()), pa.array(places, pa.int32()))


def places(docs: DataFrame, key: str, *, unique: bool = False) -> DataFrame:
    """(term, key, places) of the tokens of (key, text): differences of the token numbers at which the term stands. Texts are shuffled by
    their key, once, and not the tokens, of which there are many times more bytes; unique: a key has one text, so nothing is."""
    placed = lambda t: F.transform(T.tokens(t), lambda w, k: F.struct(w.alias("term"), k.alias("place")))

    def runs(s: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"]))
        held = lambda at, p, k: F.transform(F.slice(s, p + 1, F.coalesce(F.get(at, k + 1), F.size(s)) - p), lambda x: x["place"])
        one = lambda at: F.transform(at, lambda p, k: F.struct(F.get(s, p)["term"].alias("term"), held(at, p, k).alias("p")))
        return F.when(F.size(s) > 0, T._once(first, one)).otherwise(F.array().cast("array<struct<term:string,p:array<int>>>"))

    there = docs.where(F.col("text").isNotNull())
    own = there.select(key, F.array("text").alias("texts")) if unique else there.groupBy(key).agg(F.collect_list("text").alias("texts"))
    found = own.select(key, F.explode(T._once(F.sort_array(F.flatten(F.transform("texts", placed))), runs)).alias("r")).select("r.term", key, "r.p")
    steps = F.transform("p", lambda x, k: x - F.coalesce(F.get("p", k - 1), F.lit(0)))
    return found.select("term", key, steps.alias("places"))


class PhraseIndex:
    """postings, dictionary (term, n) and live (key, generation) below a folder."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "doc_id", *, buckets: int = 16):
        self.spark, self.key = spark, key
        self.versions = Versions(spark, folder, buckets)

    def add(self, docs: DataFrame) -> None:
        """Index the texts of (key, text), one row a key, in the place of what was known of these documents; null texts are left out."""
        c, key = self.versions.begin(), self.key
        docs = docs.where(F.col("text").isNotNull() & F.col(key).isNotNull()).select(key, "text")
        generation = F.lit(c.at + 1).cast("long").alias("generation")
        c.put("postings", places(docs, key, unique=True).select("term", key, generation, "places"), "term", fresh=True)
        c.add_of("dictionary", "postings", lambda rows: rows.groupBy("term").agg(F.count("*").alias("n")), "term")
        c.put("live", docs.select(key, generation), key)
        c.commit()
        self.versions.upkeep()

    def remove(self, ids: DataFrame) -> None:
        """Documents that are gone; their postings stay until the next clean."""
        c = self.versions.begin()
        c.drop("live", ids.select(self.key))
        c.commit()

    def clean(self) -> None:
        """Write postings and dictionary anew without what is no longer live."""
        c = self.versions.begin()
        rows = c.read("postings").join(c.read("live"), [self.key, "generation"], "left_semi").select("term", self.key, "generation", "places")
        c.replace("postings", rows, "term")
        c.replace("dictionary", rows.groupBy("term").agg(F.count("*").alias("n")), "term", mode="sum")
        c.commit()

    def words(self, phrase: str) -> list[tuple[str, bool, bool]]:
        """The words of a phrase with whether they may go on to the left and right."""
        phrase = phrase.lower()
        one = self.spark.range(1).select(T.tokens(F.lit(phrase)).alias("w"), F.lit(phrase).rlike(f"^{T.TOKEN}").alias("left"), F.lit(phrase).rlike(f"{T.TOKEN}$").alias("right")).first()
        last = len(one.w) - 1
        return [(w, k == 0 and one.left, k == last and one.right) for k, w in enumerate(one.w)]

    def slots(self, phrase: str) -> DataFrame:
        """(term, slot): the terms that may stand for each word of the phrase."""
        known = self.versions.read("dictionary").select("term")
        out = None
        for k, (word, left, right) in enumerate(self.words(phrase)):
            term: Column = F.col("term")
            fits = term.contains(word) if left and right else term.endswith(word) if left else term.startswith(word) if right else term == word
            part = (known.where(fits) if left or right else self.spark.createDataFrame([(word,)], "term string")).withColumn("slot", F.lit(k))
            out = part if out is None else out.unionByName(part)
        if out is None:
            raise ValueError("the phrase has no letter or digit")
        return out

    def candidates(self, phrase: str) -> DataFrame:
        """(key, starts): documents with the words of the phrase at places that follow one another, and the place of the first word."""
        n = len(self.words(phrase))
        slots = self.slots(phrase).persist()
        try:
            touched = self.versions.touched(slots, "term")
        finally:
            slots.unpersist()
        m = self.versions.manifest()
        found = self.versions.read("postings", buckets=touched, manifest=m).join(slots, "term").join(self.versions.read("live", manifest=m), [self.key, "generation"], "left_semi")
        own = found.select(self.key, "slot", F.arrow_udf(_absolute, "array<int>")("places").alias("p"))
        starts = own.select(self.key, "slot", F.transform("p", lambda x: x - F.col("slot")).alias("starts"))
        per_slot = starts.groupBy(self.key, "slot").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts"))
        per_doc = per_slot.groupBy(self.key).agg(F.collect_list("starts").alias("all")).where(F.size("all") == n)
        meet = F.aggregate(F.slice("all", 2, max(1, n)), F.get("all", F.lit(0)), lambda acc, x: F.array_intersect(acc, x))
        return per_doc.select(self.key, F.array_sort(meet).alias("starts")).where(F.size("starts") > 0)

    def report(self, docs: DataFrame, texts, phrase: str, margin: int = 25) -> DataFrame:
        """analytics.phrase_report by the index. texts: (key, text), or a function that gives it for the documents of (key)."""
        ids = self.candidates(phrase).select(self.key)
        rows = texts(ids) if callable(texts) else texts.join(ids, self.key, "left_semi")
        hits = rows.select(F.col(self.key).alias("__k"), T.snippets(F.col("text"), phrase, margin).alias("hits"))
        live = self.versions.read("live").select(F.col(self.key).alias("__l"))
        found = docs.join(live, F.col(self.key) == F.col("__l"), "left").join(hits, F.col(self.key) == F.col("__k"), "left")
        rows = found.select(*docs.columns, F.col("__l").isNotNull().alias("has_text"), F.posexplode_outer("hits").alias("pos", "snippet"))
        outcome = F.when(~F.col("has_text"), "no text").when(F.col("snippet").isNull(), "not found").otherwise("found")
        return rows.select(*docs.columns, outcome.alias("outcome"), "pos", "snippet")
