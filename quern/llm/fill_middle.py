"""Fill-in-the-middle by a parallel automaton scan.

One automaton over bytes counts tokens and looks for markers. A stretch of text is read from all of its states at once and gives its
transition function and, for each state it may be entered in, the number of tokens that end in it. Such functions compose
associatively, so stretches are read in any order and anywhere; composing them in order tells the state in which each is entered and the
tokens before it. Then the stretch in which a cut falls is known, and only that one is read again, from its entry state.

Texts of up to `chunk` bytes are one chunk, read in lanes of 256 bytes side by side. Longer ones are dealt out to the cluster as
chunks: their functions are composed per document (the text is one value, of 2 GB at most, so they are a few ten
thousand), and the chunks that hold the two cuts are read again where they lie.

A token is `[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+` or white space at the end. It ends where white space follows a word, or with the text.
Cuts are keyed by seed and id. Forms are plain, psm (prefix, suffix, middle) and spm (suffix, prefix, middle); texts that hold a marker, and
empty ones, stay plain, so that `restored` gives every text back.

Defined cases: null is an empty text, its output is empty; a null id is keyed as an empty one; rows that repeat have equal cuts; an
empty table gives an empty result; the document travels in the struct `row`, so names cannot clash; code points of several
bytes may lie across chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _SPACE, freed, groups_of, small_batches, stash

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LANE = 256
CHUNK = 1 << 15

# ---- the automaton ----
# Classes of bytes: white space, "<", a letter of a marker, ">", others, and the end of a lane, which changes nothing.
_BLANK, _OPEN, _LETTER, _CLOSE, _OTHER, _END = range(6)
# States: the parts of a marker read so far (none after white space, none in a word, "<", "<P"), each without and with one found before.
_STATES = 8
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[_SPACE] = _BLANK
_CLASS[[ord(PREFIX[0]), ord(PREFIX[2])]] = _OPEN, _CLOSE
_CLASS[[ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]] = _LETTER


def _step(state: int, kind: int) -> tuple[int, int]:
    """(next state, tokens that end before this byte)."""
    part, found = state % 4, state // 4
    if kind == _END:
        return state, 0
    if kind == _BLANK:
        return 4 * found, int(part > 0)
    if kind == _OPEN:
        return 4 * found + 2, 0
    if kind == _LETTER and part == 2:
        return 4 * found + 3, 0
    return (4 if part == 3 and kind == _CLOSE else 4 * found) + 1, 0


_NEXT = np.array([_step(s, k)[0] for k in range(6) for s in range(_STATES)], np.uint8)
_ENDS = np.array([_step(s, k)[1] for k in range(6) for s in range(_STATES)], np.uint8)


def _lanes(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, code points) of the texts cut into lanes, and the first lane of each text (and of none)."""
    sizes = np.array([len(x) for x in texts], np.int64)
    begins = np.concatenate(([0], np.cumsum(-(-sizes // LANE))))
    kinds = np.full(int(begins[-1]) * LANE, _END, np.uint8)
    chars = np.zeros(int(begins[-1]) * LANE, bool)
    for x, at in zip(texts, (begins * LANE).tolist(), strict=False):
        kinds[at : at + len(x)] = _CLASS[x]
        chars[at : at + len(x)] = (x & 0xC0) != 0x80
    return kinds.reshape(-1, LANE), chars.reshape(-1, LANE), begins


def _functions(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each lane and each state in which it may be entered: the state in which it is left and the tokens that end in it."""
    state = np.tile(np.arange(_STATES, dtype=np.uint8), (len(kinds), 1))
    ends = np.zeros((len(kinds), _STATES), np.int32)
    columns = np.ascontiguousarray(kinds.T) * np.uint8(_STATES)
    for column in columns:
        at = column[:, None] + state
        ends += _ENDS[at]
        state = _NEXT[at]
    return state, ends


def compose(first: tuple[np.ndarray, np.ndarray], then: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The function of two stretches one behind the other, for rows of functions; associative, with (0 .. 7, no tokens) as its unit."""
    state, ends = first
    return np.take_along_axis(then[0], state.astype(np.int64), 1), ends + np.take_along_axis(then[1], state.astype(np.int64), 1)


class Scan:
    """Texts read in lanes: the function and the code points of each, and of everything in it before each of its lanes."""

    def __init__(self, texts: list[np.ndarray]):
        kinds, points, self.begins = _lanes(texts)
        self.kinds, self.points = kinds, points
        state, ends = _functions(kinds)
        counts = np.diff(self.begins)
        here = points.sum(1, dtype=np.int64)
        self.chars_before = np.cumsum(here) - here  # of the whole group
        self.before = np.empty_like(state), np.empty(ends.shape, np.int64)
        self.whole = np.tile(np.arange(_STATES, dtype=np.uint8), (len(texts), 1)), np.zeros((len(texts), _STATES), np.int64)
        for k in range(int(counts.max(initial=0))):
            who = np.flatnonzero(counts > k)
            lane = self.begins[who] + k
            held = self.whole[0][who], self.whole[1][who]
            self.before[0][lane], self.before[1][lane] = held
            self.whole[0][who], self.whole[1][who] = compose(held, (state[lane], ends[lane]))
        upto = np.concatenate((self.chars_before, [here.sum()]))
        self.chars = upto[self.begins[1:]] - upto[self.begins[:-1]]

    def cuts(self, who: np.ndarray, entry: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Code points of text who up to the end of its token-th token (from 1), entered in state entry; all of them where no such
        token ends inside it."""
        out = self.chars[who].copy()
        lane = np.full(len(who), -1)
        for j, (w, e, t) in enumerate(zip(who.tolist(), entry.tolist(), token.tolist(), strict=True)):
            a, b = self.begins[w], self.begins[w + 1]
            if 0 < t <= self.whole[1][w, e]:
                lane[j] = a + np.searchsorted(self.before[1][a:b, e], t) - 1  # the last lane with fewer tokens before it
            elif t <= 0:
                out[j] = 0
        at = np.flatnonzero(lane >= 0)
        lane, entry = lane[at], entry[at]
        state, left = self.before[0][lane, entry].astype(np.int64), token[at] - self.before[1][lane, entry]
        chars = self.chars_before[lane] - self.chars_before[self.begins[who[at]]]
        for column, point in zip(self.kinds[lane].T, self.points[lane].T, strict=True):
            step = column * np.int64(_STATES) + state
            left = left - _ENDS[step]
            chars += point & (left > 0)
            state = _NEXT[step].astype(np.int64)
        out[at] = chars
        return out


# ---- cuts of documents ----

_FACTS = [("n", pa.int64()), ("marked", pa.bool_()), ("first", pa.int64()), ("second", pa.int64()), ("chars", pa.int64())]
FACTS = "n long, marked boolean, first long, second long, chars long"


def _targets(n: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


def _cuts_of(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    """n, whether a marker is held, and the two cuts in code points, of whole texts."""
    h1, h2 = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (h1, h2))
    parts = []
    for at, held in groups_of(texts):
        scan = Scan(held)
        size, every = np.array([len(x) for x in held]), np.arange(len(held))
        zero = np.zeros(len(held), np.int64)
        n = scan.whole[1][:, 0] + (size > 0)  # the last token ends with the text
        lo, hi = _targets(n, h1[at : at + len(held)], h2[at : at + len(held)])
        parts.append((n, scan.whole[0][:, 0] >= 4, scan.cuts(every, zero, lo), scan.cuts(every, zero, hi), scan.chars))
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] or [np.zeros(0)] * 5
    return pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FACTS, strict=True)], [k for k, _ in _FACTS])


CHUNKED = "key binary, chunk int, state binary, ends array<long>, chars long"


def _summaries(batches):
    """(key, chunk, data) to the function of each chunk."""
    for batch in batches:
        for at, held in groups_of(batch.column("data")):
            scan, part = Scan(held), batch.slice(at, len(held))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("chunk"), pa.array([x.tobytes() for x in scan.whole[0]], pa.binary()), pa.array(list(scan.whole[1]), pa.list_(pa.int64())), pa.array(scan.chars, pa.int64())],
                ["key", "chunk", "state", "ends", "chars"],
            )


RESOLVED = "key binary, n long, marked boolean, chars long, cut int, chunk int, entry int, token long, before long"


def _resolve(table: pa.Table) -> pa.Table:
    """Compose the functions of one document's chunks: where each of its two cuts falls, and how that chunk is entered."""
    rows = table.sort_by("chunk")
    state, ends = np.frombuffer(b"".join(rows["state"].to_pylist()), np.uint8).reshape(-1, _STATES), np.array(rows["ends"].to_pylist(), np.int64)
    entries, before, now, tokens = [], [], 0, 0
    for k in range(len(state)):  # one state is followed: the text's own
        entries.append(now)
        before.append(tokens)
        now, tokens = int(state[k, now]), tokens + int(ends[k, now])
    chars = np.cumsum(np.concatenate(([0], rows["chars"].to_numpy())))
    n = tokens + 1
    out = []
    for cut, token in enumerate(sorted((rows["h1"][0].as_py() % (n + 1), rows["h2"][0].as_py() % (n + 1)))):
        k = len(before) - 1 if token >= n else max(0, int(np.searchsorted(before, token)) - 1)  # the last chunk with fewer tokens before it
        out.append({"key": rows["key"][0].as_py(), "n": n, "marked": now >= 4, "chars": int(chars[-1]), "cut": cut, "chunk": int(rows["chunk"][k].as_py()), "entry": entries[k], "token": token - before[k], "before": int(chars[k])})
    return pa.Table.from_pylist(out, pa.schema([("key", pa.binary()), ("n", pa.int64()), ("marked", pa.bool_()), ("chars", pa.int64()), ("cut", pa.int32()), ("chunk", pa.int32()), ("entry", pa.int32()), ("token", pa.int64()), ("before", pa.int64())]))


def _select(data: pa.Array, entry: pa.Array, token: pa.Array) -> pa.Array:
    """Code points of each chunk up to the end of its token-th token."""
    entry, token = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (entry, token))
    found = [Scan(held).cuts(np.arange(len(held)), entry[at : at + len(held)], token[at : at + len(held)]) for at, held in groups_of(data)]
    return pa.array(np.concatenate(found) if found else np.zeros(0, np.int64), pa.int64())


def _distributed(long: DataFrame, chunk: int) -> DataFrame:
    """(key, cuts) for the documents of `long` (key, text, h1, h2), whose texts are dealt out in chunks."""
    size = F.octet_length("text")
    data = F.col("text").cast("binary")
    once = long.groupBy("key").agg(F.first("text").alias("text"), F.first("h1").alias("h1"), F.first("h2").alias("h2"))
    places = F.sequence(F.lit(0), F.floor((size - 1) / chunk).cast("int"))
    pieces = once.select("key", "h1", "h2", data.alias("data"), F.explode(places).alias("chunk"))
    pieces = pieces.select("key", "h1", "h2", "chunk", F.substring("data", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data"))
    pieces = stash(pieces.repartition("key", "chunk"), "long-chunks")
    found = pieces.select("key", "chunk", "data").mapInArrow(freed(_summaries), CHUNKED)
    keys = pieces.where("chunk = 0").select("key", "h1", "h2")
    placed = stash(found.join(keys, "key").groupBy("key").applyInArrow(_resolve, RESOLVED), "long-places")
    read = pieces.select("key", "chunk", "data").join(placed, ["key", "chunk"])
    cut = read.select("key", "n", "marked", "chars", "cut", (F.col("before") + F.arrow_udf(_select, "long")("data", "entry", "token")).alias("at"))
    both = cut.groupBy("key").agg(F.first("n").alias("n"), F.first("marked").alias("marked"), F.min("at").alias("first"), F.max("at").alias("second"), F.first("chars").alias("chars"))
    return both.select("key", F.struct("n", "marked", "first", "second", "chars").alias("cuts"))


def keyed(id_, seed) -> list[F.Column]:
    """Four unsigned 32-bit numbers of the SHA-256 of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transformed(docs: DataFrame, *, rate: int = 50, spm_rate: int = 80, seed=42, id_col="doc_id", text_col="text", chunk: int = CHUNK) -> DataFrame:
    """(row, n, form, prefix_chars, middle_chars, output): rate in a hundred are transformed, spm_rate in a hundred of these to spm.

    chunk: bytes of the longest text that one task reads as a whole."""
    small_batches(docs.sparkSession)
    h = keyed(docs[id_col], seed)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"), *(x.alias(f"h{k}") for k, x in enumerate(h, 1)))
    short = rows.where(F.octet_length("text") <= chunk).withColumn("cuts", F.arrow_udf(_cuts_of, FACTS)("text", "h1", "h2"))
    key = F.unhex(F.sha2(F.concat(F.col("h1").cast("string"), F.lit(":"), F.col("h2").cast("string"), F.lit(":"), F.col("text")).cast("binary"), 256))
    long = stash(rows.where(F.octet_length("text") > chunk).withColumn("key", key), "long-texts")
    cuts = stash(_distributed(long.select("key", "text", "h1", "h2"), chunk), "long-cuts")
    both = short.unionByName(long.join(cuts, "key").drop("key"))
    c, t = F.col("cuts"), F.col("text")
    plain = (F.octet_length(t) == 0) | c["marked"] | (F.col("h3") % 100 >= rate)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < spm_rate, "spm").otherwise("psm")
    middle_chars = c["second"] - c["first"]
    part = lambda start, length: t.substr(start.cast("int"), length.cast("int"))
    prefix, middle, suffix = part(F.lit(1), c["first"]), part(c["first"] + 1, middle_chars), part(c["second"] + 1, c["chars"] - c["second"])
    p, s, m = F.lit(PREFIX), F.lit(SUFFIX), F.lit(MIDDLE)
    output = F.when(F.col("form") == "plain", t).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(p, prefix, s, suffix, m, middle))
    cut = F.col("form") != "plain"
    return both.withColumn("form", form).select("row", c["n"].alias("n"), "form", F.when(cut, c["first"]).alias("prefix_chars"), F.when(cut, middle_chars).alias("middle_chars"), output.alias("output"))


def restored(output, form) -> F.Column:
    """The text, from the output and its form alone: no part holds a marker, so the first of each kind is the one that was set."""
    def between(first: str, then: str) -> F.Column:
        return F.substring_index(F.substr(output, F.lit(len(first) + 1)), then, 1)

    behind = lambda marker: F.substr(output, F.locate(marker, output) + len(marker))
    psm = F.concat(between(PREFIX, SUFFIX), behind(MIDDLE), F.substring_index(behind(SUFFIX), MIDDLE, 1))
    spm = F.concat(F.substring_index(behind(PREFIX), MIDDLE, 1), behind(MIDDLE), between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
