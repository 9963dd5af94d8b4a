"""Mixing sources to target weights by hash-threshold histograms.

Every row has a keyed hash in [0, 2^60). For each source the words are summed by hash bucket, the bucket where the running
sum crosses the source's budget is found, and only that bucket is summed again by its next hash bits. Rows below the
threshold are taken: no sort of the rows, and the same rows in every run. Budgets are nested: a larger target takes a superset.

Defined cases: a null or blank text has size 0 and takes 0 words; the null source is a source of its own, last in order;
an empty table gives an empty result; repeated rows share one hash and are taken together; a null id is hashed by its text.
A source whose size is 0 has target 0. Clashing names of extra columns do no harm: results are built from the three columns named.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, word_count

BITS, STEP = 60, 12
WEIGHTS = (5, 2, 1)
MOST = 3


def keyed_hash(id_col: str, text_col: str, seed: str) -> F.Column:
    """60 bits of md5 over seed and id (for a null id: the text)."""
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("~"), F.coalesce(F.col(text_col), F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 15), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """From (source, source_size), one row a source, add target: shares by weight, stopped at most times the size, the excess
    reshared until none is above. The stopped sources are a prefix when ordered by size / weight, so one running sum finds them."""
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("long"))
    rising = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    weighted = weighted.withColumn("rank", F.row_number().over(rising))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weighted = (
        weighted.withColumn("rem", F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("rest_w", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("open", F.col("rem") * F.col("w") <= most * F.col("source_size") * F.col("rest_w"))
    )
    first = weighted.withColumn("lvl", F.min_by(F.when(F.col("open"), F.struct("rem", "rest_w")), F.when(F.col("open"), F.col("rank"))).over(everything))
    fair = (F.col("lvl.rem") * F.col("w")).cast("double") / F.col("lvl.rest_w")
    stopped = F.col("lvl").isNull() | ((F.col("lvl.rem") * F.col("w")) > most * F.col("source_size") * F.col("lvl.rest_w"))
    return first.select("source", "source_size", F.when(stopped, (most * F.col("source_size")).cast("double")).otherwise(fair).alias("target"))


def plan(rows: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """From (source, size, h), one row a document, the source table: target, whole copies of each row, and the hash threshold."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = stash(
        targets(sizes, weights, most)
        .withColumn("copies", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("int"))
        .withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")),
        "mix-goal",
        files=1,
    )
    edge = goal.select("source", F.col("budget").alias("left"), F.lit(0).cast("long").alias("prefix"))
    shift = BITS
    while shift:
        r, e, shift = rows.alias("r"), edge.alias("e"), shift - STEP
        inside = r.join(e, F.col("r.source").eqNullSafe(F.col("e.source")) & (F.shiftright("r.h", shift + STEP) == F.col("e.prefix")))
        sums = inside.groupBy("e.source", "e.left", F.shiftright("r.h", shift).alias("prefix")).agg(F.sum("r.size").alias("here"))
        running = Window.partitionBy("source").orderBy("prefix")
        cum = sums.withColumn("upto", F.sum("here").over(running)).withColumn("before", F.col("upto") - F.col("here"))
        edge = (
            cum.where(F.col("upto") > F.col("left"))
            .groupBy("source")
            .agg(F.min_by(F.struct("prefix", (F.col("left") - F.col("before")).alias("left"), "here"), "prefix").alias("x"))
            .select("source", "x.prefix", "x.left", "x.here")
        )
    # the last bucket holds one hash value: it goes to the nearer side of the budget
    cut = edge.select("source", (F.col("prefix") + F.when(F.col("here") - F.col("left") < F.col("left"), 1).otherwise(0)).alias("threshold"))
    g, c = goal.alias("g"), cut.alias("c")
    joined = g.join(c, F.col("g.source").eqNullSafe(F.col("c.source")), "left")
    return joined.select("g.source", "g.source_size", "g.target", "g.copies", F.coalesce("c.threshold", F.when(F.col("g.budget") > 0, F.lit(1 << BITS)).otherwise(0)).alias("threshold"))


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), keyed_hash(id_col, text_col, seed).alias("h"))


def mix_sources(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, most: int = MOST, seed: str = "mix") -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies (0 to most), taken = copies * size."""
    rows = stash(measured(docs, id_col, text_col, source_col, seed), "mix-rows")
    chosen = stash(plan(rows, weights, most), "mix-plan", files=1)
    r, p = rows.alias("r"), chosen.alias("p")
    copies = F.col("p.copies") + F.when(F.col("r.h") < F.col("p.threshold"), 1).otherwise(0)
    return r.join(p, F.col("r.source").eqNullSafe(F.col("p.source"))).select(
        "r.doc_id", "r.source", "r.size", "p.source_size", "p.target", copies.alias("copies"), (copies * F.col("r.size")).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, *, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, most: int = MOST, seed: str = "mix") -> DataFrame:
    """The documents themselves, each as often as the mix takes it, with the columns they came with."""
    rows = stash(measured(docs, id_col, text_col, source_col, seed).drop("doc_id"), "mix-rows")
    chosen = stash(plan(rows, weights, most), "mix-plan", files=1).alias("p")
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), keyed_hash(id_col, text_col, seed).alias("h"), F.col(source_col).alias("source")).alias("d")
    copies = F.col("p.copies") + F.when(F.col("d.h") < F.col("p.threshold"), 1).otherwise(0)
    taken = d.join(chosen, F.col("d.source").eqNullSafe(F.col("p.source"))).select("d.row", copies.alias("copies")).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
