"""N-gram Jaccard join with prefix filters under several global token orders.

A document's set is its distinct word shingles (64-bit hashes). If two sets of sizes n, m have Jaccard >= t, then under any
global order the first n - ceil(t n) + 1 tokens of the one and the first m - ceil(t m) + 1 of the other share a token. The
filter holds under every order at once, so a pair must pass all of them: order one deals out the candidates, orders two and
three are intersected with it before any set is compared, and of the sets first a short form. All orders put shingles that no
other document has first (two Bloom filters over all documents) and frequent ones last (a fixed-size count sketch), and differ
in the hash that orders the others. The first shared token of a pair also bounds what can be shared behind it: with places i, j
in order one at most min(n - i, m - j) tokens are common, so most tokens that unrelated documents share by chance give no pair.

Links are wanted only as far as components need them, so a group of n near copies is not expanded into n^2 pairs: documents
with equal sets are one node, whose texts are read once; prefix tokens that one node alone holds go by another pair of Bloom
filters before they are dealt out; every holder of a token is first compared with the token's smallest holder; after the
components of those links are known, only pairs between different components remain. Small token groups give them as pairs;
large ones (of one smallest holder together) are dealt into blocks, every two blocks meet in one task, the three filters are
intersected there too, and only links that join components leave it. That compares all pairs of a large group that are not linked
yet, but moves each document only once for each block of the group.

What a filter cannot tell apart any more gives more candidates, never fewer, so the filters follow the corpus (`sizes`): those over all
tokens have one to two bits for each four bytes of text, the sketch one counter for 64 of these bits, 16 MB at most, and those over
prefix tokens 8 to 16 bits a token. Beyond 128 MB the filters over all tokens hold every second or fourth token only, chosen by hash: a
document whose tokens are mostly its own still has more of them than its prefix takes. Only then they grow on. Tokens, sets and documents
that more than 1 / 2048 of the rows share are joined by broadcast (`common.split_join`).

Defined cases: a document with fewer words than size has one shingle, its whole sequence; null, empty and blank texts have
none and link with nothing; a null id links with nothing and has a null component; rows that repeat an id are one node, each
with its own n_shingles; an empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICES, Bits, Compressed, TwiceFilter, components, discard, few, freed, groups_of, id_filter, in_bloom, in_filter, in_slices, merged_slices, merged_twice, mix, power_above, release, shingle_sets, small_batches, split_join, stash, text_bytes

SEEDS = tuple(np.uint64(x) for x in (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F))


# ---- what is known of every row, and of all tokens ----

FACTS = "doc_id long, key long, n long, print binary, slice int, data binary"


def sizes(n_bytes: int, most: int = 1 << 30) -> tuple[int, int, int]:
    """For texts of so many bytes: the bits of the filters over all tokens, of how many tokens they hold one, and the sketch's bits."""
    bits, every = power_above(n_bytes / 4, 1 << 16), 1
    sketch = min(24, bits.bit_length() - 7)
    while bits > most and every < 4:
        bits, every = bits // 2, every * 2
    return bits, every, sketch


def chosen(tokens: np.ndarray, every: int) -> np.ndarray:
    """Which tokens the filters over all tokens hold: one in `every`, a power of two, by bits that neither filter nor sketch uses."""
    return (tokens >> np.uint64(16)) & np.uint64(every - 1) == 0


def _facts(size: int, filter_bits: int, every: int, sketch_bits: int):
    """Columns (doc_id, key, text): size and digest of each row's set; then the task's filters in slices 0 .. SLICES and its sketch,
    one byte a cell (they stop at 255, which is frequent enough to be told apart), in the slices behind them."""

    def run(batches):
        seen, total = TwiceFilter(filter_bits), np.zeros(1 << sketch_bits, np.uint8)
        held: list[np.ndarray] = []

        def take():
            h, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            held.clear()
            mine = chosen(h, every)
            seen.mark(h[mine], times[mine])
            cells, first = np.unique((h >> np.uint64(64 - sketch_bits)).astype(np.int64), return_index=True)
            if len(cells):
                total[cells] = np.minimum(total[cells] + np.minimum(np.add.reduceat(times, first), 255), 255)

        for batch in batches:
            for first, texts in groups_of(batch.column(2)):
                tokens, bounds = shingle_sets(texts, size)
                held.append(tokens)
                if sum(map(len, held)) > 500_000:
                    take()
                n = np.diff(bounds)
                prints = [hashlib.blake2b(tokens[s:e].tobytes(), digest_size=16).digest() if e > s else None for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                none = pa.nulls(len(texts), pa.int32()), pa.nulls(len(texts), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(texts)), batch.column(1).slice(first, len(texts)), pa.array(n), pa.array(prints, pa.binary()), *none], FACT_NAMES)
        take()
        for more, part in ((0, seen.slices()), (SLICES, in_slices(total))):
            none = [pa.nulls(SLICES, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pc.add(part.column(0), pa.scalar(more, pa.int32())), part.column(1)], FACT_NAMES)

    return run


FACT_NAMES = [x.split()[0] for x in FACTS.split(", ")]


def _sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(a.astype(np.uint32) + b, 65_535).astype(np.uint16)


class Order(Compressed):
    """A token's class, which is first in all global orders: 0 for chosen tokens that the twice filter lacks, 1 for cells of the sketch at
    or below the mean count, rising with the logarithm of the excess."""

    def __init__(self, twice: np.ndarray, counts: np.ndarray, sketch_bits: int, every: int = 1):
        self.every = every
        mean = float(counts.mean()) if len(counts) else 0.0
        steps = np.floor(2 * np.log2(1 + np.maximum(0, np.arange(65_536) - mean) / (1 + 2 * np.sqrt(mean)))).astype(np.uint8)
        self.twice, self.classes, self.shift = twice, steps[counts] if len(counts) else np.zeros(1 << sketch_bits, np.uint8), 64 - sketch_bits

    def keys(self, tokens: np.ndarray) -> list[np.ndarray]:
        """The tokens' keys in each order; of equal keys the smaller token is first."""
        known = in_bloom(self.twice, tokens) | ~chosen(tokens, self.every)
        kind = np.zeros(len(tokens), np.uint64)
        kind[known] = self.classes[(tokens[known] >> np.uint64(self.shift)).astype(np.int64)] + np.uint64(1)
        return [(kind << np.uint64(56)) | (mix(tokens ^ seed) >> np.uint64(8)) for seed in SEEDS]


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def prefix(keys: np.ndarray, percent: int) -> np.ndarray:
    """Where the tokens of the prefix are, in their order; the tokens themselves are sorted, so a stable sort settles ties alike
    in all documents."""
    p = prefix_length(len(keys), percent)
    near = np.flatnonzero(keys <= np.partition(keys, p - 1)[p - 1]) if p < len(keys) else np.arange(len(keys))
    return near[np.argsort(keys[near], kind="stable")][:p]


SIGNATURE = "doc_id long, n long, p1 array<long>, p2 array<smallint>, p3 array<smallint>"


class Skip(Compressed):
    """Tells rows apart whose set a smaller document has: in the first bit set and not in the second, which holds what the first
    one wrongly has. A row that it lets through by mistake is a further node, no error."""

    def __init__(self, copies: np.ndarray, wrong: np.ndarray):
        self.copies, self.wrong = copies, wrong

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return in_filter(keys, self.copies) & ~in_filter(keys, self.wrong)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0] + [len(x) for x in rows])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0), kind))


def _signatures(order_b, skip_b, size: int, percent: int):
    def run(batches):
        order, skip = order_b.value, skip_b.value
        for batch in batches:
            batch = batch.filter(pa.array(~skip(batch.column(1).to_numpy(zero_copy_only=False))))
            for first, texts in groups_of(batch.column(2)):
                tokens, bounds = shingle_sets(texts, size)
                orders = order.keys(tokens)
                rows: list[list[np.ndarray]] = [[], [], []]
                for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    for k, keys in enumerate(orders):
                        own = tokens[s:e][prefix(keys[s:e], percent)] if e > s else tokens[:0]
                        rows[k].append((own if k == 0 else own & np.uint64(0x7FFF)).astype(np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(np.diff(bounds)), _lists(rows[0], pa.int64()), *(_lists([x.astype(np.int16) for x in rows[k]], pa.int16()) for k in (1, 2))],
                    ["doc_id", "n", "p1", "p2", "p3"],
                )

    return run


def _prefix_filter(bits: int):
    def run(batches):
        seen = TwiceFilter(bits)
        for batch in batches:
            seen.add(batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint64))
        yield seen.slices()

    return run


def _shared_tokens(twice_b):
    """Columns (doc, n, p1) to (token, doc, n, pos): the prefix tokens that two nodes may hold, with their place in order one."""

    def run(batches):
        for batch in batches:
            tokens, lengths = batch.column(2).flatten().to_numpy(zero_copy_only=False), np.diff(batch.column(2).offsets.to_numpy())
            row = np.repeat(np.arange(len(lengths)), lengths)
            place = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            hit = in_bloom(twice_b.value.array, tokens.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(tokens[hit]), batch.column(0).take(pa.array(row[hit])), batch.column(1).take(pa.array(row[hit])), pa.array(place[hit])], ["token", "doc", "n", "pos"])

    return run


# ---- sets and links ----


def _sets(wanted_b, size: int, short: bool):
    """(doc_id, tokens) of the wanted documents; the filter has no false negatives. Short: the tokens' last 16 bits, with repeats."""

    def packed(tokens: np.ndarray) -> bytes:
        return np.sort(tokens.astype(np.uint16)).tobytes() if short else tokens.tobytes()

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.flatnonzero(in_filter(ids, wanted_b.value.array))
            part = batch.take(pa.array(rows))
            for first, texts in groups_of(part.column(1)):
                tokens, bounds = shingle_sets(texts, size)
                yield pa.RecordBatch.from_arrays([part.column(0).slice(first, len(texts)), pa.array([packed(tokens[s:e]) for s, e in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())], ["doc_id", "tokens"])

    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of two sorted multisets, of which each value counts as often as both have it."""
    values, place = np.unique(np.concatenate([x, y]), return_inverse=True)
    return int(np.minimum(np.bincount(place[: len(x)], minlength=len(values)), np.bincount(place[len(x) :], minlength=len(values))).sum())


def _possible(percent: int):
    """Of the pairs with short tokens those whose multiset intersection, never less than the sets' own, allows a link."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(z.as_buffer(), np.uint16) for z in (x, y))
                most = _common(a, b)
                keep.append(100 * most >= percent * (len(a) + len(b) - most))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both = np.sort(np.concatenate([a, b]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _counts(sets: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Intersection sizes of all sets: matrix products over the tokens that two sets share, a slice of tokens at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    tokens, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], column[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(shared.sum()), width):
        s, e = np.searchsorted(place, (start, start + width))
        part = np.zeros((len(sets), width), np.float32)
        part[owner[s:e], place[s:e] - start] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _links(percent: int):
    """Sorted rows (group, block, doc, label, p2, p3, tokens), a group being one or two blocks: the links that join different
    labels. Only pairs that pass the filters of orders two and three as well are verified; order one has put them in a group."""

    def links(rows):
        blocks, docs, labels, p2, p3, tokens = zip(*rows, strict=True)
        n = np.array([len(x) // 8 for x in tokens])
        names, label = np.unique(labels, return_inverse=True)
        possible = (label[:, None] != label[None, :]) & (100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :]))
        if len(set(blocks)) > 1:
            possible &= np.not_equal.outer(np.array(blocks), np.array(blocks))
        for part in (p2, p3):
            if possible.any():
                possible &= _counts(part) > 0
        own = np.flatnonzero(possible.any(1))
        if not len(own):
            return
        both = _counts([np.frombuffer(tokens[k], np.uint64) for k in own])
        linked = possible[np.ix_(own, own)] & (100 * both >= percent * (n[own][:, None] + n[own][None, :] - both))
        root = list(range(len(names)))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
            i, j = own[i], own[j]
            a, b = find(label[i]), find(label[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                yield docs[i], docs[j]

    def run(batches):
        held, now, out = [], None, []
        for batch in batches:
            group, block, doc, label, p2, p3, tokens = batch.columns
            for k, g in enumerate(group.to_pylist()):
                if g != now:
                    out.extend(links(held) if len(held) > 1 else ())
                    held, now = [], g
                held.append((block[k].as_py(), doc[k].as_py(), label[k].as_py(), p2[k].values.to_numpy(), p3[k].values.to_numpy(), tokens[k].as_py()))
        out.extend(links(held) if len(held) > 1 else ())
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    return run


class Join:
    """The state of one join: the rows, the nodes' signatures and what has been compared."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int, percent: int, filter_bits: int | None, sketch_bits: int | None, split_above: int, block: int, block_tokens: int, most_bits: int):
        self.spark = docs.sparkSession
        small_batches(self.spark)
        self.size, self.percent, self.split_above, self.block, self.block_tokens = size, percent, split_above, block, block_tokens
        self.least_bits, self.most_bits = 1 << 12, most_bits
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
        bits, every, sketch = sizes(text_bytes(self.docs, "text") if filter_bits is None or sketch_bits is None else 0)
        filter_bits, every, sketch_bits = filter_bits or bits, 1 if filter_bits else every, sketch_bits or sketch
        facts = stash(few(self.docs).mapInArrow(freed(_facts(size, filter_bits, every, sketch_bits)), FACTS), "facts")
        parts = facts.where("slice is not null").select("slice", "data")
        twice = merged_twice(parts.where(F.col("slice") < SLICES), filter_bits)
        counts = merged_slices(parts.where(F.col("slice") >= SLICES).select((F.col("slice") - SLICES).alias("slice"), "data"), _sum, first="u1", then="u2")
        self.rows = stash(facts.where("slice is null").select("doc_id", "key", "n", "print"), "rows")
        discard(facts)
        self.order = self.spark.sparkContext.broadcast(Order(twice, counts, sketch_bits, every))

    def nodes(self) -> None:
        """equal: (print, rep, held), the smallest document of each set; placed: (doc_id, key, rep) of the rows with one; the
        signatures of the smallest documents, whose texts alone are read again."""
        live = self.rows.where("n > 0 and doc_id is not null")
        self.equal = stash(live.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("held")), "equal-sets")
        self.placed = stash(split_join(live.select("doc_id", "key", "print"), self.equal, "print", "held").select("doc_id", "key", "rep"), "placed")
        copies = id_filter(self.placed.where("doc_id <> rep").select("key"), 1 << 26)
        copies_b = self.spark.sparkContext.broadcast(Bits(copies))

        def maybe(batches):
            for batch in batches:
                yield batch.filter(pa.array(in_filter(batch.column(0).to_numpy(zero_copy_only=False), copies_b.value.array), pa.bool_()))

        wrong = id_filter(self.placed.where("doc_id = rep").select("key").mapInArrow(maybe, "key long"), 1 << 23)
        copies_b.unpersist()
        skip = self.spark.sparkContext.broadcast(Skip(copies, wrong))
        known = self.docs.where("doc_id is not null").mapInArrow(freed(_signatures(self.order, skip, self.size, self.percent)), SIGNATURE)
        self.signatures = stash(known.where("n > 0"), "signatures")
        self.order.unpersist()
        skip.unpersist()
        self.filters = self.signatures.select("doc_id", "p2", "p3")

    def fits(self, n, pos, m, place):
        """Whether sizes, and places of the shared token in order one, leave room for a link if the token is the first shared one."""
        n, pos, m, place = (F.col(x) for x in (n, pos, m, place))
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m)) & ((100 + self.percent) * F.least(n - pos, m - place) >= self.percent * (n + m))

    def holders(self) -> DataFrame:
        """(token, doc, n, pos, least, held): holders of each order-one prefix token that at least two nodes hold, where places and
        sizes leave room for a link; least is the smallest of them as struct(doc, n, pos)."""
        lists = self.signatures.select("doc_id", "n", "p1")
        held = lists.agg(F.sum(F.size("p1"))).first()[0] or 0
        bits = min(self.most_bits, max(self.least_bits, 1 << (8 * held - 1).bit_length() if held else 0))  # 8 to 16 a token
        twice = merged_twice(few(lists.select("p1")).mapInArrow(freed(_prefix_filter(bits)), "slice int, data binary"), bits)
        wanted = self.spark.sparkContext.broadcast(Bits(twice))
        tokens = stash(lists.mapInArrow(freed(_shared_tokens(wanted)), "token long, doc long, n long, pos long"), "prefix-tokens")
        wanted.unpersist()
        early = (100 + self.percent) * (F.col("n") - F.col("pos")) >= 2 * self.percent * F.col("n")  # of a pair the smaller set must hold it so
        whole = F.struct("doc", "n", "pos")
        group = tokens.groupBy("token").agg(F.min(whole).alias("least"), F.max(whole).alias("last"), F.count("*").alias("held"), F.max(early).alias("early"))
        useful = (F.col("held") > 2) | self.fits("least.n", "least.pos", "last.n", "last.pos")
        shared = stash(group.where("least.doc < last.doc and early").where(useful).drop("last", "early"), "shared-tokens")
        out = stash(split_join(tokens, shared, "token", "held"), "holders")
        discard(tokens, shared)
        release(self.spark)
        return out

    def passing(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) that share prefix tokens under orders two and three as well."""
        x, y = (self.filters.select(*(F.col(c).alias(f"{c}_{k}") for c in self.filters.columns)) for k in "ab")
        both = pairs.join(x, F.col("a") == F.col("doc_id_a")).join(y, F.col("b") == F.col("doc_id_b"))
        return both.where(F.arrays_overlap("p2_a", "p2_b") & F.arrays_overlap("p3_a", "p3_b")).select("a", "b")

    def sets(self, ids: DataFrame, short: bool = False) -> DataFrame:
        """(doc, tokens) of the documents whose id is in the only column of ids, and of a few more that the joins drop."""
        wanted = self.spark.sparkContext.broadcast(Bits(id_filter(ids, 1 << 26)))
        out = stash(self.docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(freed(_sets(wanted, self.size, short)), "doc long, tokens binary"), "sets")
        wanted.unpersist()
        return out

    def compared(self, pairs: DataFrame, short: bool) -> DataFrame:
        """The pairs whose sets (or 16-bit tokens) allow a link."""
        sets = self.sets(pairs.select("a").unionAll(pairs.select("b")).distinct(), short)
        x, y = sets.select(F.col("doc").alias("a"), F.col("tokens").alias("ta")), sets.select(F.col("doc").alias("b"), F.col("tokens").alias("tb"))
        joined = pairs.join(x, "a").join(y, "b").select("a", "b", "ta", "tb")
        out = stash(joined.mapInArrow(freed((_possible if short else _verify)(self.percent)), "a long, b long").distinct(), "candidates")
        discard(sets, pairs)
        release(self.spark)
        return out

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link: first by 16-bit tokens, which rule most others out at a quarter of the bytes, then by the sets."""
        passing = stash(self.passing(pairs), "candidates")
        release(self.spark)
        return self.compared(self.compared(passing, True), False)

    def remaining(self, holders: DataFrame, labels: DataFrame) -> DataFrame:
        """Links between different components among the holders of order-one tokens.

        Small token groups give pairs. Large ones are taken together by their smallest holder, dealt into blocks, and every two
        blocks are compared in one task, which gives out only the links that join two components."""
        h = holders.join(labels.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("label", "doc")).drop("held")
        known = stash(h, "labelled-holders")
        discard(holders)
        mixed = stash(known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("held")).where("lo < hi").select("token", "held"), "mixed-tokens")
        h = stash(split_join(known, mixed, "token", "held"), "mixed-holders")
        discard(known, mixed)
        small = h.where((F.col("held") <= self.split_above) & (F.col("doc") != F.col("least.doc"))).select("token", "doc", "label", "n", "pos")  # the least has met all others
        x, y = small.alias("x"), small.alias("y")
        meet = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.label") < F.col("y.label"))).where(self.fits("x.n", "x.pos", "y.n", "y.pos"))
        links = self.verified(meet.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct())
        large = stash(h.where(F.col("held") > self.split_above).select(F.col("least.doc").alias("least"), "doc", "n", "label").distinct(), "large-groups")
        discard(h)
        if large.limit(1).count():
            links = links.unionAll(self.in_blocks(large))
        return links

    def in_blocks(self, large: DataFrame) -> DataFrame:
        blocks = F.ceil(F.greatest(F.count("*") / self.block, F.sum("n") / self.block_tokens)).alias("blocks")
        count = stash(large.groupBy("least").agg(F.count("*").alias("held"), blocks), "group-sizes")
        sets = self.sets(large.select("doc").distinct()).join(self.filters.withColumnRenamed("doc_id", "doc"), "doc")
        own = F.pmod(F.xxhash64("doc"), F.col("blocks"))
        dealt = split_join(large, count, "least", "held").withColumn("mine", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        dealt = dealt.select(F.xxhash64("least", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"), "mine", "doc", "label")
        rows = dealt.join(sets, "doc").select("task", "mine", "doc", "label", "p2", "p3", "tokens").repartition("task").sortWithinPartitions("task")
        return rows.mapInArrow(freed(_links(self.percent)), "a long, b long")

    def run(self) -> DataFrame:
        self.nodes()
        holders = self.holders()
        star = holders.where(F.col("doc") != F.col("least.doc")).where(self.fits("n", "pos", "least.n", "least.pos"))
        first = self.verified(star.select(F.col("least.doc").alias("a"), F.col("doc").alias("b")).distinct())
        labels = stash(components(first), "labels")
        second = stash(self.remaining(holders, labels), "links")
        repeated = self.placed.groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("doc_id")
        one_node = self.placed.join(repeated, "doc_id", "left_semi").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
        final = components(labels.select(F.col("label").alias("a"), F.col("node").alias("b")).unionAll(second).unionAll(one_node))
        e, c = self.equal.alias("e"), final.alias("c")
        of_rep = stash(e.join(c, F.col("e.rep") == F.col("c.node"), "left").select("e.rep", "e.held", F.coalesce("c.label", "e.rep").alias("component")), "components")
        held = of_rep.groupBy("rep").agg(F.sum("held").alias("held"), F.min("component").alias("component"))  # repeated ids may stand for several sets
        known = split_join(self.placed.select("doc_id", "rep"), held, "rep", "held").groupBy("doc_id").agg(F.min("component").alias("component"))
        s, k = self.rows.select("doc_id", "n").alias("s"), known.alias("k")
        out = s.join(k, F.col("s.doc_id") == F.col("k.doc_id"), "left")
        discard(self.signatures)
        return out.select("s.doc_id", F.col("s.n").alias("n_shingles"), F.coalesce("k.component", "s.doc_id").alias("component_id"))


def row_key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def joined(docs: DataFrame, *, id_col="doc_id", text_col="text", size: int = 5, percent: int = 80, filter_bits: int | None = None, sketch_bits: int | None = None, split_above: int = 12, block: int = 128, block_tokens: int = 1 << 20, most_bits: int = 1 << 30) -> Join:
    return Join(docs, id_col, text_col, size, percent, filter_bits, sketch_bits, split_above, block, block_tokens, most_bits)


def jaccard_components(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: components of the links with Jaccard >= percent / 100."""
    return joined(docs, **options).run()


def one_of_each(docs: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """The documents without those whose component holds a smaller id; columns as they came. Of rows with the same id (or none)
    and the same text one stays; other rows that repeat an id, and null ids, stay."""
    join = joined(docs, id_col=id_col, text_col=text_col, **options)
    lost = join.run().where("component_id < doc_id").select(F.col("doc_id").alias("__lost")).distinct()
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), row_key(id_col, text_col).alias("key"))
    kept = d.join(lost, F.col(f"row.{id_col}") == F.col("__lost"), "left_anti")
    again = stash(join.rows.groupBy("key").count().where("count > 1").select("key"), "repeated-rows")
    if again.limit(1).count():
        place = Window.partitionBy("key").orderBy(F.xxhash64("row"))
        same = kept.join(again, "key", "left_semi").select("row", "key", F.row_number().over(place).alias("place"))
        kept = kept.join(again, "key", "left_anti").select("row").unionAll(same.where("place = 1").select("row"))
    return kept.select("row.*")
