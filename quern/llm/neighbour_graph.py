"""Approximate nearest neighbours by cosine: an NN-descent graph built with iterative Spark joins, searched greedily.

Nodes are the distinct vectors; of equal vectors the few smallest ids are kept with their node, which is all that a list of k
neighbours can need. The graph starts from groups of vectors on the same side of random planes and is improved by comparing
the neighbours of each node with each other, forward and reverse, where one of the two is new. A query starts from its own
node (or from fixed entry nodes) and in each round expands its best unexpanded candidates, until its beam has none.

Graph and search move vectors as one byte a component; the answer's best candidates are scored on the original vectors in double
precision, so the bytes can cost a candidate, never a score.

This is a randomised search: recall depends on degree, rounds, beam and expand, which are parameters, and is measured in
tests/llm against brute force. Reverse lists and beams are bounded, so hubs and near copies cost no more than other nodes.
Defined cases: vectors that are null, zero or hold null or non-finite components take no part, nor do vectors of another length
than most rows have (of lengths equally frequent the smallest counts); ties go to the smaller id;
with fewer candidates than k all are returned; rows that repeat an id with the same vector are one; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, release, small_batches, stash


def valid(v: str):
    x = F.col(v)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return x.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(x, lambda c: c != 0), F.lit(False))


def _rows(column: pa.Array) -> np.ndarray:
    """Unit vectors of packed bytes, as far as bytes tell."""
    x = np.frombuffer(b"".join(column.to_pylist()), dtype=np.int8).reshape(len(column), -1).astype(np.float32)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _packed(vectors: pa.Array) -> pa.Array:
    """Each vector as signed bytes, its largest component as 127."""
    out = []
    for x in vectors:
        v = x.values.to_numpy(zero_copy_only=False)
        out.append(np.rint(v / np.abs(v).max() * 127).astype(np.int8).tobytes())
    return pa.array(out, pa.binary())


def _dot(a: pa.Array, b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float32())
    return pa.array(np.einsum("ij,ij->i", _rows(a), _rows(b)).astype(np.float32), pa.float32())


def _cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        u, v = x.values.to_numpy(zero_copy_only=False), y.values.to_numpy(zero_copy_only=False)
        u, v = u / np.abs(u).max(), v / np.abs(v).max()
        out.append(float(u @ v / (np.linalg.norm(u) * np.linalg.norm(v))))
    return pa.array(out, pa.float64())


def _planes(bits: int, seed: int):
    def run(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.int64())
        x = _rows(vectors)
        side = x @ np.random.RandomState(seed).normal(size=(x.shape[1], bits)).astype(np.float32) > 0
        return pa.array(side @ (1 << np.arange(bits, dtype=np.int64)), pa.int64())

    return F.arrow_udf(run, "long")


def _by_key(batches, width: int):
    """Runs of rows with equal first column out of sorted batches, as tuples of numpy columns (the last one packed vectors)."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns[: width - 1]] + [_rows(batch.column(width - 1))]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        cuts = np.flatnonzero(np.diff(columns[0])) + 1
        edges = [0, *cuts.tolist()]
        for s, e in zip(edges, edges[1:], strict=False):
            yield [c[s:e] for c in columns]
        held = [c[edges[-1] :] for c in columns]
    if held is not None:
        yield held


def _emit(parts):
    a, b, s = (np.concatenate(x) if x else np.zeros(0) for x in parts)
    return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(s.astype(np.float32))], ["a", "b", "s"])


def _within(degree: int):
    """Columns (group, node, vector): the best edges inside each group."""

    def run(batches):
        parts: list[list] = [[], [], []]
        for _, node, v in _by_key(batches, 3):
            if len(node) < 2:
                continue
            sims = v @ v.T
            np.fill_diagonal(sims, -9)
            k = min(degree, len(node) - 1)
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            parts[0].append(np.repeat(node, k))
            parts[1].append(node[best].ravel())
            parts[2].append(np.take_along_axis(sims, best, 1).ravel())
            if sum(map(len, parts[0])) > 50_000:
                yield _emit(parts)
                parts = [[], [], []]
        yield _emit(parts)

    return run


def _local_join(most: int):
    """Columns (centre, member, fresh, worst, vector): pairs of members, one of them fresh, that improve on the member's worst edge."""

    def run(batches):
        parts: list[list] = [[], [], []]
        for _, node, fresh, worst, v in _by_key(batches, 5):
            node, first = np.unique(node, return_index=True)
            if len(node) < 2 or not fresh.any():
                continue
            fresh, worst, v = fresh[first].astype(bool), worst[first], v[first]
            sims = v @ v.T
            np.fill_diagonal(sims, -9)
            sims[~(fresh[:, None] | fresh[None, :])] = -9
            sims[sims <= worst[:, None]] = -9
            k = min(most, len(node) - 1)
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            s = np.take_along_axis(sims, best, 1).ravel()
            good = s > -5
            parts[0].append(np.repeat(node, k)[good])
            parts[1].append(node[best].ravel()[good])
            parts[2].append(s[good])
            if sum(map(len, parts[0])) > 50_000:
                yield _emit(parts)
                parts = [[], [], []]
        yield _emit(parts)

    return run


EDGE = "a long, b long, s float"


class Graph:
    """nodes (node, v), members (node, id) and edges (a, b, s): the index over every row."""

    def __init__(self, rows: DataFrame, *, id_col: str, vector_col: str, keep: int, degree: int = 24, group: int = 200, starts: int = 2, rounds: int = 8, pairs: int = 8):
        spark = rows.sparkSession
        small_batches(spark)
        good = rows.where(F.col(id_col).isNotNull() & valid(vector_col)).select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda c: c.cast("double") + 0.0).alias("original"))
        usual = good.groupBy(F.size("original").alias("n")).count().orderBy(F.desc("count"), "n").first()
        self.rows = stash(good.where(F.size("original") == (usual.n if usual else 0)).distinct(), "vectors")
        node = self.rows.groupBy("original").agg(F.min("id").alias("node"))
        r, n = self.rows.alias("r"), node.alias("n")
        placed = stash(r.join(n, F.col("r.original") == F.col("n.original")).select("n.node", "r.id"), "placed")
        few = Window.partitionBy("node").orderBy("id")
        self.members = stash(placed.withColumn("k", F.row_number().over(few)).where(F.col("k") <= keep).drop("k"), "members")
        self.placed = placed
        self.nodes = stash(node.select("node", F.arrow_udf(_packed, "binary")("original").alias("v")), "nodes")
        self.size = self.nodes.count()
        self.degree = degree
        self.edges = self._start(group, starts)
        self.news = self.size * degree
        for _ in range(rounds):
            self.edges, self.news = self._improve(pairs)
            if self.news <= 0.02 * self.size * degree:
                break

    def _best(self, edges: DataFrame) -> DataFrame:
        """The degree best edges of each node; an edge that was there before is not fresh."""
        one = edges.repartition("a").groupBy("a", "b").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
        order = Window.partitionBy("a").orderBy(F.desc("s"), "b")
        return one.withColumn("k", F.row_number().over(order)).where(F.col("k") <= self.degree).drop("k")

    def _start(self, group: int, starts: int) -> DataFrame:
        bits = max(0, math.ceil(math.log2(max(1, self.size) / group)))
        found = None
        for seed in range(starts):
            side = stash(self.nodes.withColumn("side", _planes(bits, seed)("v") if bits else F.lit(0).cast("long")), "sides")
            count = side.groupBy("side").agg(F.count("*").alias("held"))
            split = F.pmod(F.xxhash64("node", F.lit(seed)), F.ceil(F.col("held") / (2 * group)))
            grouped = side.join(count, "side").select(F.xxhash64("side", split).alias("g"), "node", "v")
            one = grouped.repartition("g").sortWithinPartitions("g").mapInArrow(_within(self.degree), EDGE)
            found = one if found is None else found.unionAll(one)
        return stash(self._best(found.withColumn("fresh", F.lit(1))), "graph")

    def _improve(self, pairs: int) -> tuple[DataFrame, int]:
        e = self.edges
        back = e.select(F.col("b").alias("c"), F.col("a").alias("u"), "fresh").withColumn("k", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("fresh"), F.xxhash64("u")))).where(F.col("k") <= self.degree).drop("k")
        around = e.select(F.col("a").alias("c"), F.col("b").alias("u"), "fresh").unionAll(back)
        if self.news < 0.3 * self.size * self.degree:  # many centres have nothing new around them
            around = around.join(around.where("fresh = 1").select("c").distinct(), "c", "left_semi")
        worst = e.groupBy("a").agg(F.when(F.count("*") >= self.degree, F.min("s")).otherwise(F.lit(-2.0).cast("float")).alias("worst"))
        known = self.nodes.join(worst, F.col("node") == F.col("a"), "left").select("node", F.coalesce("worst", F.lit(-2.0).cast("float")).alias("worst"), "v")
        rows = around.join(known, F.col("u") == F.col("node")).select("c", "u", "fresh", "worst", "v")
        new = rows.repartition("c").sortWithinPartitions("c").mapInArrow(_local_join(pairs), EDGE)
        merged = stash(self._best(e.withColumn("fresh", F.lit(0)).unionAll(new.withColumn("fresh", F.lit(1)))), "graph")
        discard(e)
        release(e.sparkSession)
        return merged, merged.where("fresh = 1").count()

    def search(self, queries: DataFrame, *, beam: int = 320, expand: int = 64, rounds: int = 100, entries: int = 8, answer: int = 16) -> DataFrame:
        """(query, node, s): the `answer` best nodes for each (query, v, start) row, start being its own node or null. A search ends
        when all of its beam is expanded, which a round brings nearer by a node of each query at least; it raises if `rounds` are not enough."""
        both = stash(self.edges.select("a", "b").unionAll(self.edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "adjacent")
        queries = stash(queries, "queries")
        dot = F.arrow_udf(_dot, "float")
        doors = self.nodes.orderBy(F.xxhash64("node")).limit(entries).select(F.col("node").alias("door"))  # `entries` rows
        start = queries.select("query", F.col("start").alias("node")).where("node is not null").unionAll(queries.select("query", F.explode(F.array(*(F.lit(r.door) for r in doors.collect())) if self.size else F.array().cast("array<long>")))).distinct()
        score = lambda pairs: pairs.join(self.nodes, "node").join(queries.select("query", F.col("v").alias("qv")), "query").select("query", "node", dot("v", "qv").alias("s"))
        state = stash(score(start).withColumn("done", F.lit(0)), "beam")
        order = Window.partitionBy("query").orderBy(F.desc("s"), "node")
        for _ in range(rounds):
            turn = state.withColumn("k", F.row_number().over(Window.partitionBy("query").orderBy("done", F.desc("s"), "node")))
            turn = stash(turn.withColumn("now", (F.col("done") == 0) & (F.col("k") <= expand)), "turn")
            near = turn.where("now").join(both, F.col("node") == F.col("a")).select("query", F.col("b").alias("node")).distinct()
            fresh = near.join(turn.select("query", "node"), ["query", "node"], "left_anti")
            kept = turn.select("query", "node", "s", F.when(F.col("now"), 1).otherwise(F.col("done")).alias("done"))
            best = kept.unionAll(score(fresh).withColumn("done", F.lit(0))).withColumn("k", F.row_number().over(order)).where(F.col("k") <= beam).drop("k")
            old = state
            state = stash(best, "beam")
            discard(old, turn)
            release(self.nodes.sparkSession)
            if not state.where("done = 0").limit(1).count():
                break
        else:
            raise RuntimeError(f"searches did not settle in {rounds} rounds")
        return state.withColumn("k", F.row_number().over(order)).where(F.col("k") <= answer).select("query", "node", "s")


def nearest(rows: DataFrame, *, id_col="vec_id", vector_col="embedding", every: int = 50, k: int = 5, **options) -> DataFrame:
    """For rows whose id is divisible by every: query_id, rank, vec_id, score of the k nearest other rows found."""
    search = {x: options.pop(x) for x in ("beam", "expand", "rounds_search", "entries", "answer") if x in options}
    if "rounds_search" in search:
        search["rounds"] = search.pop("rounds_search")
    search["answer"] = max(search.get("answer", 16), 2 * k + 1)
    g = Graph(rows, id_col=id_col, vector_col=vector_col, keep=k + 1, **options)
    asked = g.placed.where(F.col("id") % every == 0).select(F.col("id").alias("query"), "node").join(g.nodes, "node")
    found = g.search(asked.select("query", "v", F.col("node").alias("start")), **search)
    near = stash(found.join(g.members, "node").where("id <> query").select("query", "id"), "found")
    x, y = g.rows.select(F.col("id").alias("query"), F.col("original").alias("x")), g.rows.select("id", F.col("original").alias("y"))
    exact = near.join(x, "query").join(y, "id").select("query", "id", F.arrow_udf(_cosine, "double")("x", "y").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = exact.groupBy("query", "id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
