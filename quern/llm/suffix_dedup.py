"""Suffix-array dedup: remove every byte covered by a string of `length` bytes that also starts in a document of smaller id.

Only suffixes at anchors are sorted. Anchors are the positions whose 24-byte gram has the smallest hash of some window of
`length` bytes; the choice depends on the window's bytes alone, so equal strings hold anchors at equal places and every match
is seen from an anchor inside it. An anchor's entry is the text from it on (`length` bytes) followed by the bytes before it,
backwards. Two Bloom filters (seen, seen twice) leave out the anchors whose gram no other document has; they have a bit or two for each
five bytes of text (`filter_size`), some three to six for each gram, up to 256 MB.

Tasks sort bounded runs of entries and exchange them front-coded: each entry as the length it shares with the one before and the
rest. The receivers merge the runs of a key range with a loser tree that carries the shared lengths: two entries are compared
only behind the prefix that both share with the last output, and the lengths in a run's coding are used as they are. Equal
entries collapse to the smallest document, in the run and again in the merge, so a passage or a copy that a third of the documents
hold costs an entry a run. All other matches are read off the merged lengths: entries whose texts agree for so many bytes from the
anchor on are neighbours in the merge, those that agree before it are neighbours once the left parts are sorted, and two entries
share a string if they are in one group of both kinds (`covered`).

Grams that very many documents hold are counted on the way (a summary of fixed size in each task, Misra and Gries) and spread:
for their anchors each string of `length` bytes around the anchor that two documents may have (a second pair of filters) is an
entry of its own, so they are dealt to all ranges and collapse like others. A gram that escapes the summary and has more than
GROUP entries in the merge gives its strings out, and Spark aggregates them: exact at any size, and rare.

Strings are judged on the input, and matches never cross documents.
Defined cases: a null or empty text has 0 bytes and no spans; shorter texts than `length` lose nothing; documents of equal id
do not count for each other, and each row of them is judged by itself; rows with a null id keep all; an empty table gives an
empty result; other columns are never read.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _PACK, SLICES, Compressed, TwiceFilter, _merge_twice, few, freed, gathered, in_bloom, merged_twice, mix, only_twice, power_above, small_batches, stash, text_bytes, texts_of, twice_of

GRAM = 24
SEGMENT = 1 << 18
RUN = 250_000
CHUNK = 400
BATCH = 20_000  # contexts that are decided together
GROUP = 150_000  # beyond so many contexts of one gram its strings are given out
COUNTED = 4096  # grams that a task's summary counts


def _doubled(x: np.ndarray, size: int, step):
    """Combine x[i .. i + size) for every i from powers of two; step(left, right, width of left)."""
    width, out = 1, x
    while width * 2 <= size:
        out = step(out[:-width], out[width:], width)
        width *= 2
    return out, width


def _slide(x: np.ndarray, size: int, f) -> np.ndarray:
    out, width = _doubled(x, size, lambda a, b, _: f(a, b))
    n = len(x) - size + 1
    return f(out[:n], out[size - width : size - width + n])


def _segment_anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(1, 0x9E3779B97F4A7C15, dtype=np.uint64)
    scale = {1: base}
    for w in (2, 4, 8, 16):
        scale[w] = scale[w // 2] * scale[w // 2]
    bytes8 = data.astype(np.uint64) + np.uint64(1)
    half, width = _doubled(bytes8, GRAM, lambda a, b, w: a * scale[w] + b)
    n = len(data) - GRAM + 1
    value = mix(half[:n] * np.uint64(0xD6E8FEB86659FD93) ^ half[GRAM - width : GRAM - width + n])
    span = length - GRAM + 1
    least = _slide(value, span, np.minimum)
    wide = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    at = np.flatnonzero(_slide(wide, span, np.maximum) == value)
    return at, value[at]


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions, ascending, and the hashes of their grams; long texts are worked in overlapping segments."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(data) <= SEGMENT + length:
        return _segment_anchors(data, length)
    places, values = [], []
    for s in range(0, len(data) - length + 1, SEGMENT):
        p, v = _segment_anchors(data[s : s + SEGMENT + length - 1], length)
        places.append(p + s)
        values.append(v)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(values)[first]


# ---- which grams may be in two documents, and which in very many ----


class Frequent:
    """Counts of the most frequent hashes, after Misra and Gries: a count is too low by at most the sum of all over COUNTED."""

    def __init__(self, keys=None, counts=None):
        self.keys, self.counts = np.zeros(0, np.uint64) if keys is None else keys, np.zeros(0, np.int64) if counts is None else counts

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        u, place = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([self.counts, counts]), minlength=len(u)).astype(np.int64)
        if len(u) > COUNTED:
            n -= np.partition(n, len(n) - COUNTED - 1)[len(n) - COUNTED - 1]
            u, n = u[n > 0], n[n > 0]
        self.keys, self.counts = u, n


def _anchors_of(batches, length: int):
    """(row in batch, batch, text, anchors, hashes) of the texts that are long enough. Anchors have small hashes, being the smallest
    of their windows; they are mixed once more, so that they fill the filters evenly."""
    for batch in batches:
        for k, text in enumerate(texts_of(batch.column(batch.num_columns - 1))):
            if len(text) >= length:
                at, value = anchors(text, length)
                yield k, batch, text, at, mix(value)


def _counted(length: int, bits: int):
    """Slices of the filters over grams; slice SLICES is the summary of the frequent ones."""

    def run(batches):
        f, often = TwiceFilter(bits, 1 << 60), Frequent()

        def take():
            h, times = f.take()
            often.add(h, times)

        for _, _, _, _, value in _anchors_of(batches, length):
            f.add(np.unique(value))
            if f.size > 250_000:
                take()
        take()
        yield f.slices()
        yield pa.RecordBatch.from_arrays([pa.array([SLICES], pa.int32()), pa.array([often.keys.tobytes() + often.counts.tobytes()], pa.binary())], ["slice", "data"])

    return run


def _merge_counted(batches):
    """Filters and summaries of several tasks as those of one."""
    often = Frequent()

    def filters():
        for batch in batches:
            is_summary = batch.column(0).to_numpy() == SLICES
            for x in batch.filter(pa.array(is_summary)).column(1):
                both = np.frombuffer(x.as_py(), np.uint64)
                often.add(both[: len(both) // 2], both[len(both) // 2 :].astype(np.int64))
            yield batch.filter(pa.array(~is_summary))

    yield from _merge_twice(filters())
    if len(often.keys):
        yield pa.RecordBatch.from_arrays([pa.array([SLICES], pa.int32()), pa.array([often.keys.tobytes() + often.counts.tobytes()], pa.binary())], ["slice", "data"])


class Suspects(Compressed):
    """What two documents may share: grams, and for frequent grams the strings around their anchors. Sizes are parameters."""

    def __init__(self, grams: np.ndarray, hot: np.ndarray):
        self.grams, self.hot, self.strings = grams, hot, None

    def split(self, at: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Anchors of suspected grams: the others, and those of frequent grams."""
        at, value = (x[in_bloom(self.grams, value)] for x in (at, value))
        if not len(self.hot):
            return at, at[:0]
        often = np.isin(value, self.hot)
        return at[~often], at[often]


def windows_around(text: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings of `length` bytes that hold the grams at these anchors start, and their hashes."""
    starts = np.unique(np.concatenate([np.clip(at - k, 0, len(text) - length) for k in range(length - GRAM + 1)])) if len(at) else at
    value = np.zeros(len(starts), np.uint64)
    for k in range(length):
        value = value * np.uint64(0x9E3779B97F4A7C15) + text[starts + k].astype(np.uint64) + np.uint64(1)
    return starts, mix(value)


def _counted_strings(suspects_b, length: int, bits: int):
    def run(batches):
        f, suspects = TwiceFilter(bits), suspects_b.value
        for _, _, text, at, value in _anchors_of(batches, length):
            _, hot = suspects.split(at, value)
            if len(hot):
                f.add(np.unique(windows_around(text, hot, length)[1]))
        yield f.slices()

    return run


def suspects_of(rows: DataFrame, length: int, bits: int, hot: int) -> Suspects:
    """The filters of all texts; grams that the summary finds in `hot` documents or more are frequent."""
    found = {r.slice: r.data for r in gathered(few(rows.select("text")).mapInArrow(freed(_counted(length, bits)), "slice int, data binary"), _merge_counted, only_twice)}  # bits / 8 bytes before compression, and the summary
    often = np.frombuffer(found.pop(SLICES, b""), np.uint64)
    keys, counts = often[: len(often) // 2], often[len(often) // 2 :].astype(np.int64)
    return Suspects(twice_of(found, bits), keys[counts >= hot])


# ---- sorted runs, front-coded ----
#
# An entry is a row of bytes, `length` from the anchor on and length - GRAM before it, backwards, both filled up with zeros where
# the text ends; how many bytes it has on both sides; the document, the row's hash and the anchor's place.


def rows_around(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    before = length - GRAM
    padded = np.zeros(before + len(text) + length, np.uint8)
    padded[before : before + len(text)] = text
    around = np.lib.stride_tricks.sliding_window_view(padded, before + length)[at]
    return np.concatenate([around[:, before:], around[:, before - 1 :: -1]], 1)


def shared_lengths(rows: np.ndarray) -> np.ndarray:
    """What each row shares with the one before it; 0 for the first."""
    differ = rows[1:] != rows[:-1]
    return np.concatenate([[0], np.where(differ.any(1), differ.argmax(1), rows.shape[1])]).astype(np.int64)


def united(doc, h, start, stop) -> tuple[np.ndarray, ...]:
    """Spans by (doc, h), those that overlap or touch as one."""
    if not len(doc):
        return doc, h, start, stop
    order = np.lexsort((start, h, doc))
    doc, h, start, stop = doc[order], h[order], start[order], stop[order]
    group = np.cumsum(np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])))
    reach = np.maximum.accumulate(stop + group * (stop.max() + 1)) - group * (stop.max() + 1)
    first = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (start[1:] > reach[:-1])))
    return doc[first], h[first], start[first], reach[np.append(first[1:], len(doc)) - 1]


NUMBERS = 5  # right, left, document, row hash, place


def encode_chunk(rows: np.ndarray, shared: np.ndarray, numbers: np.ndarray) -> bytes:
    """Sorted rows front-coded: the first whole, of the others what lies behind the shared length. numbers, one row an entry, are
    laid out by column and byte, so that bytes that are mostly zero lie together."""
    shared = np.append(0, shared[1:]).astype(np.uint8)
    rest = rows[np.arange(rows.shape[1]) >= shared[:, None]]
    planes = numbers.astype("<i8").view(np.uint8).reshape(len(rows), -1).T
    whole = shared.tobytes() + planes.tobytes() + rest.tobytes()
    return struct.pack("<IHI", len(rows), rows.shape[1], len(whole)) + _PACK.compress(whole, asbytes=True)


class Chunk:
    """A decoded chunk: the rows as strings, the shared lengths, the numbers by row, and the documents again."""

    def __init__(self, blob: bytes):
        n, width, size = struct.unpack_from("<IHI", blob)
        whole = np.frombuffer(_PACK.decompress(blob[10:], size, asbytes=True), np.uint8)
        shared, planes, rest = np.split(whole, [n, n + 8 * n * NUMBERS])
        numbers = np.ascontiguousarray(planes.reshape(-1, n).T).view("<i8")
        given = np.arange(width) >= shared[:, None]
        rows = np.zeros((n, width), np.uint8)
        rows[given] = rest
        source = np.maximum.accumulate(np.where(given, np.arange(n)[:, None], 0), 0)
        raw = rows[source, np.arange(width)].tobytes()
        self.strings = [raw[k : k + width] for k in range(0, n * width, width)]
        self.shared = shared.tolist()
        self.rows, self.doc, self.size = numbers.tolist(), numbers[:, 2].tolist(), n


MAPPED = "range int, first binary, blob binary, doc_id long, h long, start long, stop long"
_MAPPED = pa.schema([("range", pa.int32()), ("first", pa.binary()), ("blob", pa.binary()), ("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _flushed(rows: np.ndarray, numbers: np.ndarray, splitters: np.ndarray, length: int):
    """A run: its chunks, and the united spans of the entries that repeat an entry of a smaller document."""
    width = rows.shape[1]
    doc = (numbers[:, 2].view(np.uint64) ^ np.uint64(1 << 63)).astype(">u8").view(np.uint8).reshape(-1, 8)
    order = np.argsort(np.concatenate([rows, doc], 1).view(f"S{width + 8}").ravel(), kind="stable")
    rows, numbers = rows[order], numbers[order]
    shared = shared_lengths(rows)
    same = (shared == width) & np.append(False, (numbers[1:, :2] == numbers[:-1, :2]).all(1))
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(rows))))
    lost = numbers[:, 2] != numbers[leader, 2]  # a larger document in the same context: all of it is covered
    right, left, doc, h, place = numbers[lost].T
    spans = united(doc, h, place - left, place + right)
    for s in range(0, len(spans[0]), 5000):
        own = [x[s : s + 5000] for x in spans]
        n = len(own[0])
        yield pa.RecordBatch.from_arrays([pa.array((-1 - own[0] % (len(splitters) + 1)).astype(np.int32)), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), *map(pa.array, own)], schema=_MAPPED)
    rows, numbers, shared = rows[~lost], numbers[~lost], shared[~lost]
    borders = [0, *np.searchsorted(rows.view(f"S{width}").ravel(), splitters).tolist(), len(rows)]
    held = []
    for k, (s, e) in enumerate(zip(borders, borders[1:], strict=False)):
        for at in range(s, e, CHUNK):
            part = slice(at, min(at + CHUNK, e))
            held.append((k, rows[at].tobytes(), encode_chunk(rows[part], shared[part], numbers[part]), None, None, None, None))
            if len(held) == 200:
                yield _found_batch(held, _MAPPED)
                held = []
    yield _found_batch(held, _MAPPED)


def _found_batch(rows, schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _runs(suspects_b, splitters: list[bytes], length: int):
    """Documents to front-coded chunks of sorted runs, and to the spans that a run alone decides (range -1 - hash)."""
    width = 2 * length - GRAM
    borders = np.array(splitters, dtype=f"S{width}")

    def run(batches):
        suspects, rows, numbers, held = suspects_b.value, [], [], 0

        def take(found, right, left, doc, row, at):
            rows.append(found)
            numbers.append(np.stack([right, left, np.full(len(at), doc), np.full(len(at), row), at], 1))
            return len(at)

        for k, batch, text, at, value in _anchors_of(batches, length):
            at, hot = suspects.split(at, value)
            if not len(at) and not len(hot):
                continue
            doc, row = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            for s in range(0, len(at), RUN):
                part = at[s : s + RUN]
                held += take(rows_around(text, part, length), np.minimum(length, len(text) - part), np.minimum(length - GRAM, part), doc, row, part)
                if held > RUN:
                    yield from _flushed(np.concatenate(rows), np.concatenate(numbers), borders, length)
                    rows, numbers, held = [], [], 0
            if len(hot):
                starts, value = windows_around(text, hot, length)
                starts = starts[in_bloom(suspects.strings, value)]
                found = rows_around(text, starts, length)
                found[:, length:] = 0
                held += take(found, np.full(len(starts), length), np.zeros(len(starts), np.int64), doc, row, starts)
        if held:
            yield from _flushed(np.concatenate(rows), np.concatenate(numbers), borders, length)
        else:
            yield _found_batch([], _MAPPED)

    return run


# ---- the merge ----


def shared(a: bytes, b: bytes, at: int) -> int:
    """The length of the common prefix of two strings of one length, of which `at` bytes are known to agree."""
    x, y = a[at:], b[at:]
    if x == y:
        return len(a)
    return len(a) - ((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) // 8


class LoserTree:
    """Merges sorted chunks whose rows come with the length they share with their predecessor.

    A leaf's `known` is the length its head shares with the last output (-1: the leaf is used up). Of two leaves the one that
    shares more is smaller, and the loser shares just its own length with the winner; only equal lengths need bytes, and only those
    behind them. Equal strings come in order of documents."""

    def __init__(self):
        self.chunks: list[Chunk] = []
        self.at, self.heads, self.docs, self.known, self.tree = [], [], [], [], []
        self.winner, self.last = None, b""

    def _settle(self, w: int, stop: int) -> None:
        """Restate the lengths of the leaves that lost to w, and to them in turn, as shared with the last output: a loser shares
        with it what it shares with its winner, or what that one shares if it is less."""
        node, n = (w + len(self.heads)) // 2, len(self.heads)
        while node != stop and n > 1:
            loser = self.tree[node]
            self.known[loser] = min(self.known[loser], self.known[w])
            self._settle(loser, node)
            node //= 2

    def add(self, chunk: Chunk) -> None:
        if self.winner is not None:
            self._settle(self.winner, 0)
        free = next((k for k, x in enumerate(self.known) if x < 0), len(self.known))
        if free == len(self.known):
            for x in (self.chunks, self.at, self.heads, self.docs, self.known):
                x.append(None)
        self.chunks[free], self.at[free], self.heads[free], self.docs[free] = chunk, 0, chunk.strings[0], chunk.doc[0]
        self.known[free] = shared(self.last, chunk.strings[0], 0) if self.last else 0
        self._build()

    def _build(self) -> None:
        """Play anew, with the lengths that are known."""
        n = len(self.heads)
        self.tree = [0] * n
        front = [0] * n + list(range(n))
        for k in range(n - 1, 0, -1):
            front[k], self.tree[k] = self._play(front[2 * k], front[2 * k + 1])
        self.winner = front[1] if n > 1 else 0

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser) of two leaves; the loser's known becomes the length it shares with the winner."""
        known = self.known
        if known[a] != known[b] or known[a] < 0:
            return (a, b) if known[a] >= known[b] else (b, a)
        s, t = self.heads[a], self.heads[b]
        n = shared(s, t, known[a])
        if (s[n] < t[n]) if n < len(s) else (self.docs[a] <= self.docs[b]):
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    def head(self) -> bytes | None:
        """The smallest string."""
        return None if self.winner is None else self.heads[self.winner]

    def pop(self) -> tuple[int, Chunk, int]:
        """(length shared with the output before, chunk, place in it) of the smallest string."""
        w, known = self.winner, self.known
        out = known[w], self.chunks[w], self.at[w]
        chunk, at = self.chunks[w], self.at[w] + 1
        self.last = self.heads[w]
        if at < chunk.size:
            self.at[w], self.heads[w], self.docs[w], known[w] = at, chunk.strings[at], chunk.doc[at], chunk.shared[at]
        else:
            known[w] = -1
        n, tree = len(known), self.tree
        if n > 1:
            node, own = (w + n) // 2, known[w]
            while node:
                loser = tree[node]
                other = known[loser]
                if other > own:
                    tree[node], w, own = w, loser, other
                elif other == own and own >= 0:
                    w, tree[node] = self._play(w, loser)
                    own = known[w]
                node //= 2
        self.winner = w if known[w] >= 0 else None
        return out


REDUCED = "doc_id long, h long, start long, stop long, string binary"
_REDUCED = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("string", pa.binary())])


def covered(shared_right: np.ndarray, rows: np.ndarray, rights: np.ndarray, held: np.ndarray, docs: np.ndarray, length: int):
    """Contexts in merged order -> (context, j) for each string of `length` bytes that starts j bytes before the anchor of a
    context and that a smaller document has, in order of contexts and j.

    shared_right[i] is what row i shares with the one before it, rights and held how many bytes it has from the anchor on and
    before it. Contexts that agree for length - j bytes are a stretch of the merged order; contexts whose left parts agree for j
    bytes are a stretch of the left parts' order. The two stretches are numbered by counting borders, so nothing but shared
    lengths is looked at."""
    n, most = len(docs), length - GRAM
    wide = np.zeros((n, -(-most // 8) * 8), np.uint8)
    wide[:, :most] = rows[:, length:]
    order = np.lexsort((held, *wide.view(">u8").astype(np.uint64).T[::-1]))
    shared_left = np.minimum(shared_lengths(rows[order, length:]), np.minimum(held[order], np.append(0, held[order[:-1]])))
    beside = lambda x: np.maximum(x, np.append(x[1:], 0))
    near = np.minimum(beside(shared_right), rights)
    far = np.empty(n, np.int64)
    far[order] = beside(shared_left)
    far = np.minimum(far, held)
    hope = np.flatnonzero(near + far >= length)
    found = [np.zeros((0, 2), np.int64)]
    for j in range(most + 1) if len(hope) else ():
        own = hope[(near[hope] >= length - j) & (far[hope] >= j)]
        if len(own) < 2:
            continue
        stretch = np.empty(n, np.int64)
        stretch[order] = np.cumsum(shared_left < j)
        key = np.cumsum(shared_right < length - j)[own] * (n + 1) + stretch[own]
        by = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[by], prepend=-1))
        least = np.repeat(np.minimum.reduceat(docs[own[by]], first), np.diff(np.append(first, len(by))))
        lost = own[by][docs[own[by]] > least]
        found.append(np.stack([lost, np.full(len(lost), j)], 1))
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


class _Contexts:
    """Contexts in merged order, decided in batches that end between grams."""

    def __init__(self, length: int):
        self.length, self.width = length, 2 * length - GRAM
        self.ready: list[pa.RecordBatch] = []
        self.gone: list[tuple[int, int, int, int]] = []  # spans (doc, h, start, stop)
        self.strings: list[bytes] = []
        self.shared: list[int] = []
        self.numbers: list[list[int]] = []  # right, left, doc, h, place
        self.gram, self.given_out = 0, False

    def entry(self, k: int, chunk: Chunk, at: int) -> None:
        row, strings = chunk.rows[at], self.strings
        if k < GRAM:
            if len(strings) >= BATCH or self.given_out:
                self.close()
                strings = self.strings
            self.gram = len(strings)
        elif strings:
            if k == self.width:
                right, left, doc, h, place = row
                last = self.numbers[-1]
                if doc > last[2] and right == last[0] and left == last[1]:
                    self.gone.append((doc, h, place - left, place + right))
                    return
            if len(strings) - self.gram >= GROUP:
                self.give_out(keep=True)
                strings = self.strings
        strings.append(chunk.strings[at])
        self.shared.append(k)
        self.numbers.append(row)

    def give_out(self, keep: bool = False) -> None:
        """Give out the strings of the gram's contexts; the last one stays open while the gram goes on."""
        end = len(self.strings) - keep
        stay = [x[end:] for x in (self.strings, self.shared, self.numbers)]
        rows = []
        for string, (right, left, doc, h, place) in zip(self.strings[self.gram : end], self.numbers[self.gram : end], strict=True):
            whole = string[self.length : self.length + left][::-1] + string[:right]
            for j in range(max(0, left + right - self.length + 1)):
                rows.append((doc, h, place - left + j, place - left + j + self.length, hashlib.blake2b(whole[j : j + self.length], digest_size=16).digest()))
            if len(rows) > 20_000:
                self.ready.append(_found_batch(rows, _REDUCED))
                rows = []
        self.ready.append(_found_batch(rows, _REDUCED))
        for x in (self.strings, self.shared, self.numbers):
            del x[self.gram :]
        self.decide()
        self.strings, self.shared, self.numbers = stay
        self.given_out, self.gram = keep, 0

    def decide(self) -> None:
        if len(self.strings) > 1:
            numbers = np.array(self.numbers, np.int64)
            rows = np.frombuffer(b"".join(self.strings), np.uint8).reshape(len(numbers), -1)
            hits = covered(np.array(self.shared), rows, numbers[:, 0], numbers[:, 1], numbers[:, 2], self.length)
            if len(hits):
                first = np.append(True, (np.diff(hits[:, 0]) != 0) | (np.diff(hits[:, 1]) != 1))
                own = numbers[hits[first, 0]]
                self.emit(own[:, 2], own[:, 3], own[:, 4] - hits[np.append(first[1:], True), 1], own[:, 4] - hits[first, 1] + self.length)
        self.strings, self.shared, self.numbers = [], [], []
        if self.gone:
            self.emit(*np.array(self.gone, np.int64).T)
            self.gone = []

    def emit(self, *spans: np.ndarray) -> None:
        spans = united(*spans)
        self.ready.append(pa.RecordBatch.from_arrays([*map(pa.array, spans), pa.nulls(len(spans[0]), pa.binary())], schema=_REDUCED))

    def close(self) -> None:
        if self.given_out:
            self.give_out()
        self.decide()
        self.given_out, self.gram = False, 0


def _merge(length: int):
    def run(batches):
        contexts, tree, place = _Contexts(length), LoserTree(), None

        def drain(until: bytes | None):
            """Output what sorts before the next chunk's first string."""
            entry, pop, heads = contexts.entry, tree.pop, tree.heads
            while (w := tree.winner) is not None and (until is None or heads[w] < until):
                entry(*pop())
            if contexts.ready or len(contexts.gone) > 50_000:
                yield from given()

        def given():
            if len(contexts.gone) > 50_000:
                contexts.emit(*np.array(contexts.gone, np.int64).T)
                contexts.gone = []
            yield from contexts.ready
            contexts.ready = []

        for batch in batches:
            ranges = batch.column(0).to_numpy()
            decided = batch.filter(pa.array(ranges < 0))
            yield pa.RecordBatch.from_arrays([*decided.columns[3:], pa.nulls(len(decided), pa.binary())], schema=_REDUCED)
            for k in np.flatnonzero(ranges >= 0).tolist():
                if ranges[k] != place:
                    yield from drain(None)
                    contexts.close()
                    tree, place = LoserTree(), ranges[k]
                yield from drain(batch.column(1)[k].as_py())
                tree.add(Chunk(batch.column(2)[k].as_py()))
        yield from drain(None)
        contexts.close()
        yield from given()

    return run


def _splitters(docs: DataFrame, length: int, ranges: int, sample: int = 400) -> list[bytes]:
    """Borders of the key ranges from the anchors of a few documents (all of a small corpus); they only balance the work."""
    share = min(1.0, 4 * sample / max(1, docs.count()))
    heads = []
    for row in docs.where(F.pmod(F.xxhash64("doc_id", "h", F.lit(7)), F.lit(1 << 20)) < int(share * (1 << 20))).select(F.substring("text", 1, 20_000).alias("text")).limit(sample).collect():
        raw = row.text.encode()
        heads.extend(raw[p : p + GRAM] for p in anchors(np.frombuffer(raw, np.uint8), length)[0].tolist())
    heads.sort()
    return sorted({heads[len(heads) * k // ranges] for k in range(1, ranges)}) if heads else []


def filter_size(n_bytes: int, most: int = 1 << 31) -> int:
    """The bits of the filters over the grams of texts of so many bytes, of which about 7 in 100 are anchors."""
    return min(most, power_above(n_bytes / 5, 1 << 16))


def duplicate_spans(docs: DataFrame, *, length: int = 50, filter_bits: int | None = None, hot: int = 100_000) -> DataFrame:
    """From (doc_id, h, text) without nulls: spans (doc_id, h, start, stop) of the bytes to remove; they may overlap."""
    spark = docs.sparkSession
    if length < 2 * GRAM:
        raise ValueError(f"strings of {2 * GRAM} bytes or more only")
    small_batches(spark)
    rows = docs.where(F.octet_length("text") >= length).select("doc_id", "h", "text")
    filter_bits = filter_bits or filter_size(text_bytes(rows, "text"))
    suspects = suspects_of(rows, length, filter_bits, hot)
    if len(suspects.hot):
        bits = filter_bits // 4
        frequent = spark.sparkContext.broadcast(suspects)
        suspects.strings = merged_twice(few(rows.select("text")).mapInArrow(freed(_counted_strings(frequent, length, bits)), "slice int, data binary"), bits)
        frequent.unpersist()
    suspects_b = spark.sparkContext.broadcast(suspects)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    runs = rows.mapInArrow(freed(_runs(suspects_b, _splitters(rows, length, ranges), length)), MAPPED)
    merged = stash(runs.repartition("range").sortWithinPartitions("range", "first").mapInArrow(freed(_merge(length)), REDUCED), "suffix-spans")
    suspects_b.unpersist()
    strings = merged.where("string is not null")
    first = strings.groupBy("string").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least < last").drop("last")
    wide = strings.join(first, "string").where("doc_id > least").select("doc_id", "h", "start", "stop")
    return merged.where("string is null").select("doc_id", "h", "start", "stop").unionAll(wide)


def _cut():
    kind = pa.struct([("kept", pa.string()), ("kept_bytes", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def run(texts: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
        out = []
        for text, start, stop in zip(texts_of(texts), starts, stops, strict=True):
            kept, removed, runs = [], 0, 0
            if start.is_valid and len(start.values):
                same = np.zeros(len(start.values), np.int64)
                _, _, start, stop = united(same, same, start.values.to_numpy(), stop.values.to_numpy())
                removed, runs = int((stop - start).sum()), len(start)
                kept = [text[s:e].tobytes() for s, e in zip([0, *stop.tolist()], [*start.tolist(), len(text)], strict=True)]
            data = b"".join(kept) if runs else text.tobytes()
            out.append({"kept": data.decode("utf-8", "ignore"), "kept_bytes": data, "n_bytes": len(text), "n_removed": removed, "n_spans": runs})
        return pa.array(out, kind)

    return F.arrow_udf(run, "kept string, kept_bytes binary, n_bytes long, n_removed long, n_spans long")


def dedup_substrings(docs: DataFrame, *, id_col="doc_id", text_col="text", **options) -> DataFrame:
    """(row, kept, kept_bytes, n_bytes, n_removed, n_spans): the input row as a struct, what is left of its text and the counts.
    kept is kept_bytes as text, without characters that a removal has cut in two."""
    h = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), h.alias("h"), F.col(text_col).alias("text"))
    lost = duplicate_spans(known, **options).groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).select("doc_id", "h", "spans.start", "spans.stop").alias("l")
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col(id_col).cast("long").alias("k"), h.alias("h")).alias("d")
    both = d.join(lost, (F.col("d.k") == F.col("l.doc_id")) & (F.col("d.h") == F.col("l.h")), "left")
    return both.select("d.row", _cut()(F.col(f"d.row.{text_col}"), F.col("l.start"), F.col("l.stop")).alias("c")).select("row", "c.*")
