"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Pieces and ranks come from a SentencePiece model file (read on the driver, sent once; its size is that of the vocabulary).
A text is a space followed by itself; every space is a symbol of its own. Neighbouring symbols whose union is a piece are
candidates; the agenda takes the candidate of best rank, leftmost first. Every candidate of every occurrence of a word is drawn
for itself and skipped with the dropout rate. The draws of an occurrence are a sequence of its own, keyed by (seed, the document's
keys, its text, the place of the occurrence in it), so a run can be repeated exactly, whatever the partitions, and another seed gives
other segmentations. With dropout 0 the result is the library's own. Characters that are no piece become byte pieces, also the
character U+2581, so decoding gives back every text.

Merges never cross the unit borders used here: a border is set only before a space and around characters that no piece of the
vocabulary holds behind a letter or digit (computed from the vocabulary). What a unit becomes depends only on which of its
candidates are dropped, counted in the order in which the agenda meets them. The draws are taken as gaps between dropped
candidates (geometric). A bounded cache holds the pieces of frequent units without a drop, and their number of candidates: an
occurrence whose first gap is as long takes them. All others are worked out for themselves, many at a time: units of like length are
rows of an array, and each step takes every row's best candidate (`Encoder._merged`).

Defined cases: null and empty texts have no pieces and decode to the empty text; very long words use a heap; rows of the same
keys and text get the same pieces, `encoded_documents` numbers them with `copies` so that each is drawn for itself; an empty table
gives an empty result; other columns pass through unread, but for `copies`, which orders rows of the same id and text by them.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Compressed, mix, small_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NEVER = 1 << 60
NONE = (1 << 31) - 1  # the rank of no merge
PAD = (1 << 20) - 1
HEAP_ABOVE = 200
CACHE = 200_000  # units whose pieces without a drop are kept
LONGEST_ROW = 40  # units up to this length are worked out in rows, longer ones one by one
ROWS = 4096  # rows that are worked at a time
OFTEN = 3  # a unit is cached if a batch holds it so often
TOGETHER = 1 << 19  # characters that are encoded at a time
_MASK = (1 << 64) - 1
_ODD = np.uint64(0x9E3779B97F4A7C15)
_encoders: dict = {}


class Vocabulary(Compressed):
    """What encoding and decoding need of a model: piece to id, piece to rank, id to bytes."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids, self.ranks, self.bytes, self.byte_ids = {}, {}, [], [0] * 256
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.byte_ids[int(piece[3:5], 16)] = k
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            if model.is_control(k) or model.is_unknown(k):
                self.bytes.append(b"")
                continue
            piece = piece.replace("▁", " ")
            self.bytes.append(piece.encode())
            self.ids[piece] = k
            if len(piece) > 1:
                self.ranks[piece] = (-model.get_score(k), k)
        order = {p: n for n, p in enumerate(sorted(self.ranks, key=lambda p: self.ranks[p]))}
        tied = {}
        for p in order:  # equal scores are one rank: the leftmost candidate goes first
            tied.setdefault(self.ranks[p][0], order[p])
        self.ranks = {p: tied[self.ranks[p][0]] for p in order}
        behind = {}
        for p in self.ranks:
            for a, b in zip(p, p[1:], strict=False):
                behind.setdefault(b, set()).add(a)
        if any(a != " " for a in behind.get(" ", ())):
            raise ValueError("a piece holds a space behind another character")
        lone = "" if any("\n" in p for p in self.ranks) else "\n"
        marks = {c for c in map(chr, range(33, 127)) if not c.isalnum()} | set(lone)
        held = {c for c in map(chr, range(0x250)) if c.isalnum()} - {a for c in marks for a in behind.get(c, ())}
        w, m = "".join(map(re.escape, sorted(held))), "".join(map(re.escape, sorted(marks)))
        # a border stands before a space, before a mark that follows a letter or digit, and around a line end
        self._prepare()
        self.pattern = (f"{lone}|" if lone else "") + rf" *[^ {lone}{w}]*[{w}]*(?:[^ {w}{m}][^ {lone}{w}]*[{w}]*)*"


    def __setstate__(self, state: dict) -> None:
        super().__setstate__(state)
        self.symbol_of = self.symbol_of.copy()  # new characters are entered

    def _prepare(self) -> None:
        """Numbers for symbols (pieces by their ids, further characters behind them) and a hash table of the merges of two."""
        self.symbols, self.spelled = dict(self.ids), {}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c in {c for p in self.ids for c in p}:
            self._number(c)
        keys, ranks, made = [], [], []
        for p, r in self.ranks.items():
            for k in range(1, len(p)):
                a, b = self.symbols.get(p[:k]), self.symbols.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 20 | b)
                    ranks.append(r)
                    made.append(self.ids[p])
        self.slots = 1 << max(10, (2 * len(keys)).bit_length())
        self.table = np.full(self.slots, -1, np.int64)
        self.rank_of, self.made_of = np.full(self.slots + 1, NONE, np.int32), np.zeros(self.slots + 1, np.int32)
        keys = np.array(keys, np.int64)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.table[at[left]] < 0
            take, first = np.unique(at[left[free]], return_index=True)  # one key a free slot
            won = left[free][first]
            self.table[take], self.rank_of[take], self.made_of[take] = keys[won], np.array(ranks, np.int32)[won], np.array(made, np.int32)[won]
            left = np.setdiff1d(left, won)
            at[left] = np.where(self.table[at[left]] == keys[left], at[left], (at[left] + 1) % self.slots)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _ODD) >> np.uint64(65 - self.slots.bit_length())).astype(np.int64)

    def merges(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of the merge of each two symbols; the last one, which has rank NONE, if there is none."""
        keys = (a.astype(np.int64) << 20) | b
        at = self._slot(keys)
        held = self.table[at]
        out = np.where(held == keys, at, self.slots)
        left = np.flatnonzero((held != keys) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) % self.slots
            held = self.table[at[left]]
            found = held == keys[left]
            out[left[found]] = at[left[found]]
            left = left[~found & (held >= 0)]
        return out

    def _number(self, c: str) -> None:
        """Give a character its symbol: its piece, or a number behind the pieces, which stands for the pieces of its bytes."""
        if c not in self.symbols:
            self.symbols[c] = len(self.bytes) + len(self.spelled)
            self.spelled[self.symbols[c]] = [self.byte_ids[b] for b in c.encode()]
        self.symbol_of[ord(c)] = self.symbols[c]

    def numbers(self, text: str) -> np.ndarray:
        """The symbols of a text's characters."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        out = self.symbol_of[codes]
        if (out < 0).any():
            for c in np.unique(codes[out < 0]).tolist():
                self._number(chr(c))
            out = self.symbol_of[codes]
        return out

    def spell(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of runs of these lengths to pieces, and the runs' new lengths: characters without a piece become their bytes."""
        odd = np.flatnonzero(symbols >= len(self.bytes))
        if not len(odd):
            return symbols, lengths
        spelled = [self.spelled[x] for x in symbols[odd].tolist()]
        times = np.ones(len(symbols), np.int64)
        times[odd] = [len(x) for x in spelled]
        out, at = np.repeat(symbols, times), np.cumsum(times) - times
        for k, x in zip(at[odd].tolist(), spelled, strict=True):
            out[k : k + len(x)] = x
        upto = np.append(0, np.cumsum(times))
        ends = np.cumsum(lengths)
        return out, upto[ends] - upto[ends - lengths]


class Encoder:
    """Encodes texts for one vocabulary, dropout and seed; one for each worker, for its cache."""

    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int):
        self.v, self.seed, self.dropout = vocabulary, seed, dropout
        self.units = re.compile(vocabulary.pattern)
        self._clear()

    def _clear(self) -> None:
        """Start the cache anew; what it holds is found again as it is met."""
        self.roots: dict[str, int] = {}
        self.size, self.used = 0, 0
        self.draws, self.starts, self.lengths = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool = np.zeros(1 << 14, np.int32)

    def _keep(self, units: list[str], pieces: np.ndarray, starts: np.ndarray, lengths: np.ndarray, draws: np.ndarray) -> None:
        """Add units with their pieces and numbers of candidates."""
        n = self.size + len(units)
        while n > len(self.draws):
            self.draws, self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.draws, self.starts, self.lengths))
        while self.used + len(pieces) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(pieces)] = pieces
        self.draws[self.size : n], self.lengths[self.size : n] = draws, lengths
        self.starts[self.size : n] = self.used + starts
        self.roots.update(zip(units, range(self.size, n), strict=True))
        self.used, self.size = self.used + len(pieces), n

    def segment(self, unit: str, drops: Iterator[int]) -> tuple[list[int], int]:
        """Where the pieces begin, and the end, if the candidates at these places (ascending) are dropped; the number of candidates."""
        known, seen, n, drop = self.v.ranks.get, 0, len(unit), next(drops, NEVER)

        def rank(s: int, e: int) -> int:
            nonlocal seen, drop
            r = known(unit[s:e], NEVER)
            if r != NEVER:
                if seen == drop:
                    r, drop = NEVER, next(drops, NEVER)
                seen += 1
            return r

        if n > HEAP_ABOVE:
            return self._by_heap(n, rank), seen
        at, ranks = list(range(n + 1)), [rank(k, k + 2) for k in range(n - 1)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            k = ranks.index(best)
            del at[k + 1], ranks[k]
            if k:
                ranks[k - 1] = rank(at[k - 1], at[k + 1])
            if k < len(ranks):
                ranks[k] = rank(at[k], at[k + 2])
        return at, seen

    def _by_heap(self, n: int, rank) -> list[int]:
        after, before = list(range(1, n + 2)), list(range(-1, n))
        alive = [True] * n
        agenda = [(r, k, k + 1, k + 2) for k in range(n - 1) if (r := rank(k, k + 2)) != NEVER]
        heapq.heapify(agenda)
        while agenda:
            _, s, m, e = heapq.heappop(agenda)
            if not alive[s] or after[s] != m or m >= n or not alive[m] or after[m] != e:
                continue
            alive[m] = False
            after[s] = e
            if s and (r := rank(before[s], e)) != NEVER:
                heapq.heappush(agenda, (r, before[s], s, e))
            if e < n:
                before[e] = s
                if (r := rank(s, after[e])) != NEVER:
                    heapq.heappush(agenda, (r, s, e, after[e]))
        return [k for k in range(n) if alive[k]] + [n]

    def pieces(self, unit: str, at: list[int]) -> list[int]:
        out: list[int] = []
        for s, e in zip(at, at[1:], strict=False):
            piece = unit[s:e]
            k = self.v.ids.get(piece)
            if k is None:
                out.extend(self.v.byte_ids[b] for b in piece.encode())
            else:
                out.append(k)
        return out

    def gaps(self, keys: np.ndarray, turn: int) -> np.ndarray:
        """How many candidates are kept before the next dropped one, for each occurrence's key; the turn-th such number."""
        return np.full(len(keys), NEVER) if self.dropout <= 0 else self._turned(keys, np.full(len(keys), turn))

    def drops_of(self, key: int) -> Iterator[int]:
        """The dropped places of one occurrence, without end."""
        turn, place, one = 0, -1, np.array([key], np.uint64)
        while True:
            place += 1 + int(self.gaps(one, turn)[0])
            yield place
            turn += 1

    def _merged(self, sym: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of symbols, filled up with PAD, to rows of merged symbols, and the numbers of candidates met. own: the rows' keys for
        the draws; None: nothing is dropped. Each step takes the best candidate of every row that has one."""
        v, n, width = self.v, len(sym), sym.shape[1]
        done, counts = np.full_like(sym, PAD), np.zeros(n, np.int64)
        row = np.arange(n)
        slot = v.merges(sym[:, :-1].ravel(), sym[:, 1:].ravel()).reshape(n, width - 1)
        rank = v.rank_of[slot]
        there = rank != NONE
        seen = there.sum(1)
        drop, turn = np.full(n, NEVER), np.zeros(n, np.int64)

        def draw(which: np.ndarray) -> None:
            """The next dropped place of these rows."""
            drop[which] += 1 + self._turned(own[which], turn[which])
            turn[which] += 1

        if own is not None and self.dropout > 0:
            drop[:] = -1
            draw(row)
            nth = np.cumsum(there, 1) - 1
            while len(hit := np.flatnonzero(drop < seen)):
                at = ((nth[hit] == drop[hit, None]) & there[hit]).argmax(1)
                rank[hit, at] = NONE
                draw(hit)
        column = np.arange(width)
        while True:
            k = rank.argmin(1)
            here = np.arange(len(row))
            live = rank[here, k] != NONE
            if not live.all():
                gone = ~live
                done[row[gone]], counts[row[gone]] = sym[gone], seen[gone]
                row, sym, slot, rank, seen, drop, turn, k = (x[live] for x in (row, sym, slot, rank, seen, drop, turn, k))
                own = None if own is None else own[live]
                if not len(row):
                    return done, counts
                here = np.arange(len(row))
            new = v.made_of[slot[here, k]]
            after = column > k[:, None]
            sym = np.where(after, np.pad(sym[:, 1:], ((0, 0), (0, 1)), constant_values=PAD), sym)
            sym[here, k] = new
            after = column[:-1] >= k[:, None]
            slot = np.where(after, np.pad(slot[:, 1:], ((0, 0), (0, 1)), constant_values=v.slots), slot)
            rank = np.where(after, np.pad(rank[:, 1:], ((0, 0), (0, 1)), constant_values=NONE), rank)
            for side in (-1, 0):  # the candidate left of the new symbol comes first
                which = np.flatnonzero((k > 0) if side else (k < width - 1))
                at = k[which] + side
                found = v.merges(sym[which, at], sym[which, at + 1])
                r = v.rank_of[found]
                is_one = r != NONE
                dropped = is_one & (seen[which] == drop[which])
                seen[which] += is_one
                slot[which, at], rank[which, at] = found, np.where(dropped, NONE, r)
                if dropped.any():
                    draw(which[dropped])

    def _turned(self, keys: np.ndarray, turns: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            u = ((mix(keys + (turns + 1).astype(np.uint64) * _ODD) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        return (np.log(u) / (math.log1p(-self.dropout) if self.dropout < 1 else -math.inf)).astype(np.int64)

    def _worked(self, units: list[str], own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(pieces, where each unit's start, how many they are, candidates): units worked out for themselves, in rows of like lengths."""
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        order = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[order], LONGEST_ROW, "right"))
        parts, lengths, draws = [], np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        for s in range(0, short, ROWS):
            part = order[s : min(s + ROWS, short)]
            width = max(2, int(sizes[part[-1]]))
            sym = np.full((len(part), width), PAD, np.int32)
            sym[np.arange(width) < sizes[part][:, None]] = self.v.numbers("".join([units[k] for k in part.tolist()]))
            done, draws[part] = self._merged(sym, None if own is None else own[part])
            there = done != PAD
            pieces, lengths[part] = self.v.spell(done[there], there.sum(1))
            parts.append(pieces)
        for k in order[short:].tolist():
            at, draws[k] = self.segment(units[k], iter(()) if own is None or self.dropout <= 0 else self.drops_of(int(own[k])))
            parts.append(np.array(self.pieces(units[k], at), np.int32))
            lengths[k] = len(parts[-1])
        starts = np.empty(len(units), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        return np.concatenate([np.zeros(0, np.int32), *parts]), starts, lengths, draws

    def encode_all(self, texts: list[str | None], keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The pieces of the texts, one behind the other, and where each text's end. Keys tell documents, or copies of one, apart that
        have the same text."""
        if self.size > CACHE:
            self._clear()
        units, counts, base = [], [], []
        for text, key in zip(texts, keys, strict=True):
            own = self.units.findall(" " + text) if text else []
            if own and not own[-1]:  # the match at the end
                own.pop()
            units.extend(own)
            counts.append(len(own))
            of_key = xxhash.xxh3_64_intdigest(key.encode(), seed=self.seed & _MASK)
            base.append(xxhash.xxh3_64_intdigest((text or "").encode(), seed=of_key))
        counts = np.array(counts, np.int64)
        ends = np.cumsum(counts)
        if not units:
            return np.zeros(0, np.int32), ends * 0
        with np.errstate(over="ignore"):
            place = np.arange(len(units)) - np.repeat(ends - counts, counts)
            own = mix(np.repeat(np.array(base, np.uint64), counts) + (place + 1).astype(np.uint64) * _ODD)
        find = self.roots.get
        node = np.array([find(u, -1) for u in units], np.int64)
        new = Counter(units[k] for k in np.flatnonzero(node < 0).tolist())
        often = [u for u, n in new.items() if n >= OFTEN or self.dropout <= 0]
        if often:
            self._keep(often, *self._worked(often, None))
            node = np.array([find(u, -1) for u in units], np.int64)
        alone = node < 0
        alone[~alone] = self.gaps(own[~alone], 0) < self.draws[node[~alone]]
        rest = np.flatnonzero(alone)
        pieces, begins, lengths, _ = self._worked([units[k] for k in rest.tolist()], own[rest])
        pool = np.concatenate([self.pool[: self.used], pieces])
        starts, size = self.starts[node], self.lengths[node]
        starts[rest], size[rest] = self.used + begins, lengths
        upto = np.cumsum(size)
        out = pool[np.arange(upto[-1]) + np.repeat(starts - (upto - size), size)]
        return out, np.append(0, upto)[ends]

    def in_batches(self, texts: list[str | None], keys: list[str]) -> Iterator[np.ndarray]:
        """The pieces of each text; texts are worked a bounded number of characters at a time."""
        first, held = 0, 0
        for k, text in enumerate(texts):
            held += len(text or "")
            if held > TOGETHER or k + 1 == len(texts):
                out, ends = self.encode_all(texts[first : k + 1], keys[first : k + 1])
                yield from np.split(out, ends[:-1])
                first, held = k + 1, 0

    def encode(self, text: str | None, key: str = "") -> list[int]:
        return self.encode_all([text], [key])[0].tolist()


def decode(vocabulary: Vocabulary, ids) -> str:
    text = b"".join(map(vocabulary.bytes.__getitem__, ids)).decode()
    return text[1:] if text.startswith(" ") else text


class Codec:
    """Column functions for one vocabulary and one choice of dropout and seed."""

    def __init__(self, spark, model: str = MODEL, dropout: float = 0.1, seed: int = 1):
        small_batches(spark)
        self.shared = spark.sparkContext.broadcast(Vocabulary(model))
        self.name, self.options = model, (dropout, seed)

    def _encoder(self):
        shared, options, name = self.shared, self.options, self.name

        def get() -> Encoder:
            """One encoder, and so one cache, for each worker process and choice of options."""
            if (name, options) not in _encoders:
                _encoders.clear()
                _encoders[name, options] = Encoder(shared.value, *options)
            return _encoders[name, options]

        return get

    @staticmethod
    def _key(keys) -> F.Column:
        return F.to_json(F.struct(*(F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys))) if keys else F.lit("")

    def encode(self, text, *keys) -> F.Column:
        """The piece ids; the key columns tell rows of the same text apart."""
        get = self._encoder()

        def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
            rows = list(get().in_batches(texts.to_pylist(), keys.to_pylist()))
            ends = np.cumsum([0] + [len(x) for x in rows])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32), pa.int32()))

        return F.arrow_udf(run, "array<int>")(text, self._key(keys))

    def decode(self, ids) -> F.Column:
        shared = self.shared

        def run(rows: pa.Array) -> pa.Array:
            return pa.array([decode(shared.value, x.as_py() or ()) for x in rows], pa.string())

        return F.arrow_udf(run, "string")(ids)

    def digests(self, text, *keys) -> F.Column:
        """struct(n_pieces, pieces_sha256 of the ids as little-endian int32, decoded_sha256 of the text decoded from them)."""
        get, shared = self._encoder(), self.shared

        def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
            out = []
            for ids in get().in_batches(texts.to_pylist(), keys.to_pylist()):
                out.append({"n_pieces": len(ids), "pieces_sha256": hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest(), "decoded_sha256": hashlib.sha256(decode(shared.value, ids.tolist()).encode()).hexdigest()})
            return pa.array(out, pa.struct([("n_pieces", pa.int64()), ("pieces_sha256", pa.string()), ("decoded_sha256", pa.string())]))

        return F.arrow_udf(run, "n_pieces long, pieces_sha256 string, decoded_sha256 string")(text, self._key(keys))


def encoded_documents(docs: DataFrame, *, id_col="doc_id", text_col="text", pieces_col="pieces", copies: bool = False, **options) -> DataFrame:
    """The documents with the piece ids of their text in a further column (an old column of that name goes).

    copies: rows of the same id and text are numbered (one shuffle of the rows), so each has draws of its own."""
    codec = Codec(docs.sparkSession, **options)
    kept = [c for c in docs.columns if c != pieces_col]
    if not copies:
        return docs.select(*(docs[c] for c in kept), codec.encode(docs[text_col], docs[id_col]).alias(pieces_col))
    text = F.col("row." + text_col)
    alone = F.when(F.octet_length(F.coalesce(text, F.lit(""))) == 0, F.monotonically_increasing_id())  # nothing is drawn for empty texts
    same = Window.partitionBy("row." + id_col, F.xxhash64(text), "alone").orderBy(F.xxhash64("row"))
    rows = docs.select(F.struct(*(docs[c] for c in kept)).alias("row")).select("row", alone.alias("alone"))
    rows = rows.select("row", F.row_number().over(same).alias("copy"))
    return rows.select("row.*", codec.encode(text, F.col("row." + id_col), F.col("copy")).alias(pieces_col))
