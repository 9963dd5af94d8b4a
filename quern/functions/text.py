"""Text functions as Column expressions; only those that sort characters or words go through Arrow, where a lambda would be interpreted."""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

TOKEN = r"[\p{L}\p{N}]+"

# Contractions and lead words that are cut out of a term, in the order in which they are tried.
CUTS = (
    "'d", "'s", "'m", "'ll", "'re", "'ve", "n't ", "shouldnt ", "doesnt ", "] ",
    "your ", "youre ", "youll ", "youd ", "yeah ", " [", "dont ", "cant ",
    "wo n't", "ca n't", "theyve ", "theyre ", "theyll ", "theres ", "didnt ",
    "thats ", "similar ", "significant ", "separate ", "right ", "bit ",
    "recent ", "potential ", "particular ", "own ", "interesting ",
    "important ", "good ", "different ", "certain ",
)
VOID = "www."  # a term that holds this is dropped

# English stop words of the library's own choice.
STOP_WORDS = tuple("a about after all also an and any are as at be because been but by can could did do does for from had has have he her him his how i if in into is it its just like me more my no not of on one or our out over she so some than that the their them then there they this to up us was we were what when which who will with would you your".split())

NUMBER = r"^\s*[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:[eE][+-]?\d+(?:_\d+)*)?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"
WHOLE = r"^\s*[+-]?\d+(?:_\d+)*\s*$"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKEN})"), F.lit(1))


def is_number(term: Column) -> Column:
    """What a decimal parser accepts: signs, exponents, underscores between digits, inf and nan, padding."""
    return term.rlike(NUMBER)


def might_be_year(term: Column, least: int = 1700, most: int = 2100) -> Column:
    value = F.when(term.rlike(WHOLE) & (F.length(term) <= 18), F.replace(F.trim(term), F.lit("_"), F.lit("")).try_cast("long"))
    return F.coalesce(value.between(least, most), F.lit(False))


def clean_term(term: Column) -> Column:
    """Every test looks at the term as it came; of the cuts that it holds only the last one is made."""
    cut = reduce(lambda acc, item: F.when(term.contains(item), F.replace(term, F.lit(item), F.lit(""))).otherwise(acc), CUTS, term)
    void = term.contains(VOID) | (is_number(term) & ~might_be_year(term)) | (F.length(term) == 1)
    return F.trim(F.when(void, F.lit("")).otherwise(cut))


def normal_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def utf8_size(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def url_tail(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def day_of_ms(ms: Column) -> Column:
    """Epoch milliseconds to yyyy-MM-dd in the session's zone, which quern sets to UTC."""
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def _in_order(text: bytes) -> bytes:
    """The characters of UTF-8 in order; a byte that is not UTF-8 counts as a character."""
    if text.isascii():
        return np.repeat(np.arange(128, dtype=np.uint8), np.bincount(np.frombuffer(text, np.uint8), minlength=128)).tobytes()
    points = np.frombuffer(text.decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.sort(points).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogateescape")


def sorted_char_hash(text: Column) -> Column:
    """SHA-256 of the text's characters in order: equal for anagrams, by intent."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else hashlib.sha256(_in_order(t)).hexdigest() for t in texts.to_pylist()], pa.string())

    return F.arrow_udf(run, StringType())(text.cast("binary"))


def word_stream(words: Column) -> Column:
    """array<struct<offset, word>> to text: by offset, trimmed, empty words skipped."""
    bare = F.transform(F.array_sort(words), lambda w: F.trim(w["word"]))
    return F.array_join(F.filter(bare, lambda w: w != ""), " ")


def _once(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda's variable is not written out again at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


_COUNTS = ArrayType(StructType([StructField("term", StringType()), StructField("count", LongType())]))


def _counts(words: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy()
    found = words.flatten().dictionary_encode()
    terms, order = found.dictionary, pc.sort_indices(found.dictionary).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    key, n = np.unique(np.repeat(np.arange(len(sizes)), sizes) * len(order) + rank[found.indices.to_numpy()], return_counts=True)
    ends = np.searchsorted(key, np.arange(len(sizes) + 1) * len(order))
    entries = pa.StructArray.from_arrays([terms.take(pa.array(order[key % max(1, len(order))])), pa.array(n, pa.int64())], ["term", "count"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)


def counted(words: Column) -> Column:
    """array<struct<term, count>>: the distinct words in order and how often each is there. words holds no null."""
    return F.arrow_udf(lambda lists: _counts(lists), _COUNTS)(words)


def strongest(counts: Column) -> Column:
    """Of array<struct<term, count>> one entry a term, with the largest count; empty terms go."""
    last = lambda s: F.filter(s, lambda x, k: (x["term"] != "") & ~F.coalesce(F.get(s, k + 1)["term"] == x["term"], F.lit(False)))
    return _once(F.array_sort(counts), last)


MARK = "|"  # no word holds it
SLICE = 32 << 20  # bytes of text whose words are numbered together


def marked(text: Column) -> Column:
    """The text in lower case, with a MARK between spaces for what is neither word, apostrophe nor space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}' ]+", f" {MARK} ")


_NUMBER, _WHOLE = re.compile(NUMBER, re.ASCII), re.compile(WHOLE, re.ASCII)
_UNCLEAN = "(?s)" + NUMBER.replace(r"\s", r"[\s\x0b]") + "|^.$|" + "|".join(re.sub(r"([\[\].])", r"\\\1", c) for c in (VOID, *CUTS))  # what clean_term changes


def _clean(term: str) -> str:
    """clean_term of one term."""
    year = _WHOLE.match(term) and len(term) <= 18 and 1700 <= int(term.strip(" ").replace("_", "")) <= 2100
    if VOID in term or (_NUMBER.match(term) and not year) or len(term) == 1:
        return ""
    for item in reversed(CUTS):
        if item in term:
            return term.replace(item, "").strip(" ")
    return term.strip(" ")


def _cleaned(terms: pa.Array) -> pa.Array:
    some = pc.match_substring_regex(terms, _UNCLEAN)
    return pc.replace_with_mask(terms, some, pa.array([_clean(t) for t in terms.filter(some).to_pylist()], pa.string()))


def _joined(words: pa.Array, doc: np.ndarray, codes: np.ndarray, stops: np.ndarray, longest: int) -> tuple[np.ndarray, pa.Array]:
    """Each run of two to `longest` words between stops: its document and its words."""
    at = np.flatnonzero(~stops[codes])
    first = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(doc[at]) != 0)))[: len(at)])
    size = np.diff(np.concatenate((first, [len(at)])))
    docs, runs = [doc[:0]], [pa.array([], pa.string())]
    for n in range(2, longest + 1):
        start = at[first[size == n]]
        docs.append(doc[start])
        runs.append(pc.binary_join_element_wise(*(words.take(pa.array(codes[start + k])) for k in range(n)), " "))
    return np.concatenate(docs), pa.concat_arrays(runs)


def _full(texts: pa.Array, longest: int, whole: bool) -> pa.Array:
    """counted_runs of some texts."""
    parts = pc.split_pattern(texts, " ")
    found = parts.flatten().dictionary_encode()
    codes, doc = found.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), pc.list_value_length(parts).to_numpy())
    quoted = pc.match_substring(found.dictionary, "'").to_numpy(zero_copy_only=False)
    own = found.dictionary.filter(pa.array(quoted)).to_pylist()
    split = [[p for p in w.split("'") if p] for w in own]
    n, bare = len(quoted), [w.replace("'", "") for w in own]
    more = pa.concat_arrays([found.dictionary, pa.array(bare, pa.string()), pa.array([p for w in split for p in w], pa.string())]).dictionary_encode()
    words, again = more.dictionary, more.indices.to_numpy().astype(np.int64)  # words without the apostrophes come after the others
    stops = pc.is_in(words, value_set=pa.array([MARK, *STOP_WORDS])).to_numpy(zero_copy_only=False)
    some = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    there = some[codes]
    codes, doc = codes[there], doc[there]
    held, terms = [], []  # of each kind: documents and places of the terms in its own list of terms
    held.append((*_joined(words, doc, codes, stops, longest),))
    marks = quoted[codes]
    if whole:
        if marks.any():  # texts without an apostrophe give the same runs again
            bared = np.arange(n)
            bared[quoted] = again[n : n + len(own)]
            has = np.zeros(len(texts), bool)
            has[doc[marks]] = True
            mine = has[doc]
            d, c = doc[mine], bared[codes[mine]]
            held.append((*_joined(words, d[some[c]], c[some[c]], stops, longest),))
        size, first = np.zeros(n, np.int64), np.zeros(n, np.int64)
        size[quoted] = [len(w) for w in split]
        first[quoted] = n + len(own) + np.cumsum(size[quoted]) - size[quoted]
        times = size[codes[marks]]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        d = np.concatenate((doc[~marks], np.repeat(doc[marks], times)))
        c = np.concatenate((codes[~marks], again[np.repeat(first[codes[marks]], times) + inner]))
        held.append((d[~stops[c]], pa.DictionaryArray.from_arrays(pa.array(c[~stops[c]]), words)))
    keys, counts = [], []
    for d, t in held:  # raw terms are counted first
        t = t if isinstance(t, pa.DictionaryArray) else t.dictionary_encode()
        key, times = np.unique(d * max(1, len(t.dictionary)) + t.indices.to_numpy().astype(np.int64), return_counts=True)
        keys.append(key)
        counts.append(times)
        terms.append(t.dictionary)
    clean = pa.concat_arrays([_cleaned(t) for t in terms]).dictionary_encode()
    order = pc.sort_indices(clean.dictionary).to_numpy().astype(np.int64)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    final, void = rank[clean.indices.to_numpy()], pc.equal(clean.dictionary, "").to_numpy(zero_copy_only=False)[order]
    every, upto = [], 0
    for key, t in zip(keys, terms, strict=True):
        size = max(1, len(t))
        every.append(key // size * max(1, len(order)) + final[upto + key % size])
        upto += len(t)
    key, times = np.concatenate(every), np.concatenate(counts)
    by = np.lexsort((times, key))
    key, times = key[by], times[by]
    last = np.concatenate((np.diff(key) != 0, [True]))[: len(key)]  # the largest count of a term
    key, times = key[last], times[last]
    left = ~void[key % max(1, len(order))]
    key, times = key[left], times[left]
    ends = np.searchsorted(key, np.arange(len(texts) + 1) * max(1, len(order)))
    entries = pa.StructArray.from_arrays([clean.dictionary.take(pa.array(order[key % max(1, len(order))])), pa.array(times, pa.int64())], ["term", "count"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)


def counted_runs(text: Column, longest: int = 3, *, whole: bool = True) -> Column:
    """array<struct<term, count>> of a marked text: runs of two to `longest` words between stop words and marks; whole: also the runs of the text
    without apostrophes, and words. Each kind is counted raw and cleaned, a term keeps its largest count, and empty terms go."""

    def run(texts: pa.Array) -> pa.Array:
        ends, at, out = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64), 0, []
        while at < len(texts):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
            out.append(_full(texts.slice(at, upto - at), longest, whole))
            at = upto
        return pa.concat_arrays(out) if out else _full(texts, longest, whole)

    return F.arrow_udf(run, _COUNTS)(text)


def snippets(text: Column, phrase: str, margin: int = 25) -> Column:
    """Each hit, without overlaps, with up to margin characters on both sides; the left side never reaches into the hit before.

    The right side is cut from as many following parts as can fill it, so the work of a text grows with its length and hits."""
    phrase = phrase.lower()
    reach = -(-margin // len(phrase)) + 1  # parts behind a hit: all but the first are preceded by the phrase

    def cuts(parts: Column) -> Column:
        behind = lambda k: F.left(F.array_join(F.slice(parts, k + 2, reach), phrase), F.lit(margin))
        one = lambda k: F.concat(F.right(F.get(parts, k), F.lit(margin)), F.lit(phrase), behind(k))
        return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(0), F.size(parts) - 2), one)).otherwise(F.array().cast("array<string>"))

    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(_once(F.split(F.lower(text), "\\Q" + phrase + "\\E"), cuts))


def sorted_keys(map_: Column) -> Column:
    """The keys of a map in order."""
    return F.sort_array(F.map_keys(map_))


def fit_or_short(full: Column, short: Column, most: int = 10_000) -> Column:
    """The full text if its normal form is under `most` bytes, else the short one (null if there is none)."""
    normal = normal_space(full)
    return F.when(F.octet_length(normal) < most, normal).otherwise(short)


def or_default(value: Column, default) -> Column:
    """A missing or falsy value becomes the typed default: '', 0, False or an empty array."""
    if isinstance(default, (list, tuple)):
        return F.coalesce(value, F.array().cast("array<string>"))
    return F.coalesce(value, F.lit(default))
