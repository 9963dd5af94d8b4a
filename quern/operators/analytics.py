"""Term counts, document counts, TF-IDF, weighted summaries and phrase search over (doc_id, text)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import text as T

COMMON = 100_000  # terms whose weights are sent to every task, some tens of bytes each


def _of_texts(docs: DataFrame, *parts, unique: bool = False) -> DataFrame:
    """(doc_id, counts) by the functions of a text that give words: each one's words are counted over a document's texts, cleaned if it says so,
    and a term keeps its largest count. Only texts are shuffled, once, and not the words, of which there are many times more bytes; unique:
    a document has one text, so nothing is."""
    there = docs.where(F.col("text").isNotNull())
    own = there.select("doc_id", F.array("text").alias("texts")) if unique else there.groupBy("doc_id").agg(F.collect_list("text").alias("texts"))
    cleaned = lambda x: F.struct(T.clean_term(x["term"]).alias("term"), x["count"].alias("count"))
    found = [(T.counted(F.flatten(F.transform("texts", words))), clean) for words, clean in parts]
    found = [F.transform(c, cleaned) if clean else c for c, clean in found]
    return own.select("doc_id", (T.strongest(F.concat(*found)) if any(clean for _, clean in parts) else found[0]).alias("counts"))


def _rows(own: DataFrame, total: bool = False) -> DataFrame:
    counts = F.col("counts")
    if total:  # in the entries, so that it is computed once a document and not once a row
        entry = lambda x, n: F.struct(x["term"].alias("term"), x["count"].alias("count"), n.alias("total"))
        summed = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x["count"])
        counts = T._once(counts, lambda c: T._once(summed(c), lambda n: F.transform(c, lambda x: entry(x, n))))
    return own.select("doc_id", F.explode(counts).alias("c")).select("doc_id", "c.*")


def _words(stop_words: bool):
    return (lambda t: F.filter(T.tokens(t), lambda w: ~w.isin(*T.STOP_WORDS))) if stop_words else T.tokens


def _of_runs(docs: DataFrame, longest: int, whole: bool, unique: bool = False) -> DataFrame:
    """(doc_id, counts) of a document's runs of words; its texts are put together with a mark between, so no run goes on in the next one."""
    own = docs.where(F.col("text").isNotNull())
    own = own if unique else own.groupBy("doc_id").agg(F.array_join(F.collect_list("text"), "\n").alias("text"))
    return own.select("doc_id", T.counted_runs(T.marked(F.col("text")), longest, whole=whole).alias("counts"))


def term_counts(docs: DataFrame, *, stop_words: bool = False, clean: bool = False, total: bool = False, unique: bool = False) -> DataFrame:
    """(doc_id, term, count): distinct lower-cased words. Raw words are counted first; of words that clean to one term the
    largest count stays. With total, also the sum of a document's counts. unique: each doc_id is there once."""
    return _rows(_of_texts(docs, (_words(stop_words), clean), unique=unique), total)


def phrase_counts(docs: DataFrame, longest: int = 3) -> DataFrame:
    """(doc_id, term, count) of candidate phrases: runs of two to `longest` words between stop words and punctuation."""
    return _rows(_of_runs(docs, longest, False))


def merge_counts(*frames: DataFrame) -> DataFrame:
    """Several counts of the same documents: a term keeps the largest, empty terms go."""
    all_rows = frames[0]
    for f in frames[1:]:
        all_rows = all_rows.unionByName(f)
    return all_rows.where(F.col("term") != "").groupBy("doc_id", "term").agg(F.max("count").alias("count"))


def full_counts(docs: DataFrame, *, total: bool = False, unique: bool = False) -> DataFrame:
    """Phrases of the text, phrases of the text without apostrophes, and words, merged; total and unique as in term_counts."""
    return _rows(_of_runs(docs, 3, True, unique), total)


def document_counts(counts: DataFrame) -> DataFrame:
    """(term, n_docs); counts has one row a document and term, so no distinct is needed."""
    return counts.groupBy("term").agg(F.count("*").alias("n_docs"))


def add_documents(n_docs: DataFrame, n: int, counts: DataFrame, seen: DataFrame) -> tuple[DataFrame, int]:
    """Bring document counts up to date with the documents of counts that are not in seen (doc_id)."""
    fresh = counts.join(seen, "doc_id", "left_anti")
    more = n_docs.unionByName(document_counts(fresh)).groupBy("term").agg(F.sum("n_docs").alias("n_docs"))
    return more, n + fresh.select("doc_id").distinct().count()


def idf_of(n_docs: DataFrame, n) -> DataFrame:
    """(term, n_docs, idf) with idf = ln(n / (n_docs + 1)), negative for terms of all documents; n is a number or a column."""
    n = n if isinstance(n, Column) else F.lit(n)
    return n_docs.select("term", "n_docs", F.ln(n / (F.col("n_docs") + 1)).alias("idf"))


def idf(n_docs: DataFrame, counts: DataFrame) -> DataFrame:
    """idf_of with the number of documents that have terms in counts."""
    n = counts.select("doc_id").distinct().agg(F.count("*").alias("__n"))
    return idf_of(n_docs.crossJoin(F.broadcast(n)), F.col("__n"))  # n is one row


def weighted_parts(counts: DataFrame, weight: DataFrame) -> tuple[DataFrame, DataFrame]:
    """weighted in two parts: the terms whose weights are broadcast, in the tasks of counts, and the others."""
    share = F.col("count") / (F.col("total") if "total" in counts.columns else F.sum("count").over(Window.partitionBy("doc_id")))
    share = counts.select("doc_id", "term", share.alias("tf"))
    common = weight.orderBy("idf", "term").limit(COMMON).select("term", "idf", F.lit(True).alias("__common"))
    both = share.join(F.broadcast(common), "term", "left")
    rest = both.where("__common is null").select("doc_id", "term", "tf").join(weight.select("term", "idf"), "term")
    made = lambda rows: rows.select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("tfidf"))
    return made(both.where("__common")), made(rest)


def weighted(counts: DataFrame, weight: DataFrame) -> DataFrame:
    """(doc_id, term, tfidf): the term's share of the document's words times its idf, of weight (term, idf). The document's words are the
    column total of counts, where there is one.

    The weights of the COMMON commonest terms are broadcast, so that most rows stay in their tasks; the others are joined as
    Spark chooses. counts and weight are read more than once and should be written."""
    common, rest = weighted_parts(counts, weight)
    return common.unionByName(rest)


def tfidf(counts: DataFrame) -> DataFrame:
    """weighted, by the idf of the counts themselves."""
    return weighted(counts, idf(document_counts(counts), counts))


def top_terms(weights: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("doc_id").orderBy(F.desc(F.round("tfidf", 9)), "term")
    return weights.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _shrunk(count: np.ndarray, size: np.ndarray, limit: int, most_rounds: int) -> np.ndarray:
    """How often each term of a document is repeated: terms counted once go and the counts are divided by the smallest left, rounded up, at
    least once and until the text fits. size: what one repetition adds to the text."""
    n = count
    for k in range(most_rounds):
        if k and ((n * size).sum() <= limit or not n.any()):
            break
        n = np.where(n > 1, n, 0)
        if n.any():
            n = -(-n // n[n > 0].min())
    return n


def _summaries(own: DataFrame, more_than: int, limit: int | None, most_rounds: int) -> DataFrame:
    """pseudo_text of (doc_id, counts array<struct<term, count, skip>>), one row a document; skip may be left out."""

    def run(terms: pa.Array, counts: pa.Array, skips: pa.Array) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(terms).to_numpy()))).astype(np.int64)
        words, count, skip = terms.flatten(), counts.flatten().to_numpy(), skips.flatten().to_numpy(zero_copy_only=False).astype(bool)
        size = np.where(skip, 0, pc.binary_length(words).to_numpy().astype(np.int64) + 1)
        n = np.where(count > more_than, -(-count // (more_than + 1)), 0)
        if limit is not None:
            upto = np.concatenate(([0], np.cumsum(n * size)))[ends]
            for k in np.flatnonzero(upto[1:] - upto[:-1] > limit):
                at = slice(ends[k], ends[k + 1])
                n[at] = _shrunk(count[at], size[at], limit, most_rounds)
        left = np.concatenate(([0], np.cumsum(n > 0)))[ends]
        shown = np.flatnonzero((n > 0) & ~skip)
        lines = list(zip((-count[shown]).tolist(), words.take(pa.array(shown)).to_pylist(), n[shown].tolist(), strict=True))
        places = np.searchsorted(shown, ends)
        text = lambda k: "".join((t + "\n") * times for _, t, times in sorted(lines[places[k] : places[k + 1]]))
        return pa.array([text(k) if left[k + 1] > left[k] else None for k in range(len(terms))], pa.string())

    skip = F.col("counts.skip") if "skip" in own.schema["counts"].dataType.elementType.names else F.transform("counts", lambda x: F.lit(False))
    made = own.select("doc_id", F.arrow_udf(run, StringType())(F.col("counts.term"), F.col("counts.count"), skip).alias("pseudo"))
    return made.select("doc_id", "pseudo", F.when(F.col("pseudo").isNull(), "no terms left").alias("issue"))


def pseudo_text(counts: DataFrame, *, more_than: int = 2, limit: int | None = 50_000, ignored: DataFrame | None = None, most_rounds: int = 40) -> DataFrame:
    """(doc_id, pseudo, issue): each term of count over more_than, repeated ceil(count / (more_than + 1)) times on lines of its
    own, largest counts first. Above limit bytes all terms come back, and until the text fits: terms counted once go and the
    counts are divided by the smallest left, rounded up. Ignored terms take part in the counts, not in the text. No text left:
    pseudo is null and issue says so. ignored: (doc_id, terms).

    The terms of a document come together in one row, which is no larger than its text and a few bytes a term."""
    rows = counts.select("doc_id", "term", F.col("count").cast("long").alias("count"))
    entry = F.struct("term", "count")
    if ignored is not None:
        names = ignored.select(F.col("doc_id").alias("__d"), F.explode("terms").alias("__t")).distinct()
        rows = rows.join(names, (F.col("doc_id") == F.col("__d")) & (F.col("term") == F.col("__t")), "left")
        entry = F.struct("term", "count", F.col("__t").isNotNull().alias("skip"))
    return _summaries(rows.groupBy("doc_id").agg(F.collect_list(entry).alias("counts")), more_than, limit, most_rounds)


def pseudo_text_of(docs: DataFrame, *, more_than: int = 2, limit: int | None = 50_000, most_rounds: int = 40) -> DataFrame:
    """pseudo_text of the term_counts of docs (doc_id, text), made in the row of the document: only texts are shuffled."""
    own = _of_texts(docs, (_words(False), False)).where(F.size("counts") > 0)
    return _summaries(own, more_than, limit, most_rounds)


def phrase_report(docs: DataFrame, texts: DataFrame, phrase: str, margin: int = 25) -> DataFrame:
    """docs (doc_id, ...) left-joined with texts (doc_id, text): one row a snippet, or one that says why there is none."""
    found = docs.join(texts.select("doc_id", "text"), "doc_id", "left").withColumn("hits", T.snippets(F.col("text"), phrase, margin))
    rows = found.select(*docs.columns, F.col("text").isNotNull().alias("has_text"), F.posexplode_outer("hits").alias("pos", "snippet"))
    outcome = F.when(~F.col("has_text"), "no text").when(F.col("snippet").isNull(), "not found").otherwise("found")
    return rows.select(*docs.columns, outcome.alias("outcome"), "pos", "snippet")
