"""Texts of records and what is derived from them: choosing a source, change capture by hash, term counts, document counts, TF-IDF
and summaries kept as versioned tables, and their removal with the text.

A plan says what to do with each text; `TextStore` makes it so. Text, artefacts and log change in one commit, so an artefact never
outlives the text that it was made from, and every driver works only on the documents that lack its artefact.

Document counts are a table of signed numbers by term: each document adds one to its terms when it is counted and takes it off when its
text changes or goes. What waits to be counted is a log of documents, written with the term counts, and which documents are counted
is a table of its own, so an update writes in proportion to the documents that are new, and reads the term counts in their buckets.

Artefacts lie in the buckets of their documents, so what is made of large tables is written by the tasks that read them, without a shuffle.
Term counts are stored with the sum of their document's counts, `total`, which is not shown."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import people as P
from ..functions import text as T
from . import analytics
from .store import PATCHES, tag_add, tag_remove, tagged
from .versions import Versions

SOURCES = ("json", "pdf")  # tags of where a text came from, in the order in which they are preferred
ARTEFACTS = ("term_counts", "tfidf", "pseudo")
PENDING = "term string, epoch long"  # of what waits; no term: the document is gone, and with it what waited before that epoch
LISTED = 2_000_000  # keys that are sent to every task, so that the rows of some documents stay where they are
NAMES, READ, READERS = 10_000, 8 << 20, 32  # file names and bytes of texts in a batch, least number of tasks that read files


# ---- where a text comes from ----


def pages_text(pages: DataFrame, key: str, *, page: str = "page", extractors: tuple[str, ...] = ("first", "second"), least: float = 0.9) -> DataFrame:
    """(key, text, extractor): the pages' text, in order and trimmed, by the first extractor that read more than `least` of them and
    found any; null where none did. pages: (key, page, a column for each extractor, null where it failed on a page)."""
    parts = [F.array_sort(F.collect_list(F.when(F.col(e).isNotNull(), F.struct(F.col(page).alias("p"), F.col(e).alias("t"))))).alias(f"__{e}") for e in extractors]
    shares = [F.avg(F.col(e).isNotNull().cast("double")).alias(f"__share_{e}") for e in extractors]
    rows = pages.groupBy(key).agg(*parts, *shares)
    whole = {e: F.nullif(F.trim(F.array_join(F.col(f"__{e}.t"), "")), F.lit("")) for e in extractors}
    good = {e: F.when(F.col(f"__share_{e}") > least, whole[e]) for e in extractors}
    named = F.coalesce(*(F.when(good[e].isNotNull(), F.lit(e)) for e in extractors))
    return rows.select(key, F.coalesce(*good.values()).alias("text"), named.alias("extractor"))


def chosen_text(rows: DataFrame, key: str, *, json_words: str = "words", pdf_text: str = "pdf_text") -> DataFrame:
    """(key, text, source, report): the words of the JSON form if they make a text, else the PDF's text; text and source are null
    without either. report says of each form whether it was there and gave a text."""
    forms = {"json": (F.col(json_words), F.nullif(T.word_stream(F.col(json_words)), F.lit(""))), "pdf": (F.col(pdf_text), F.nullif(F.trim(pdf_text), F.lit("")))}
    state = lambda raw, got: F.when(raw.isNull(), "none").when(got.isNull(), "empty").otherwise("read")
    source = F.coalesce(*(F.when(got.isNotNull(), F.lit(name)) for name, (_, got) in forms.items()))
    report = F.concat_ws(" ", *(F.concat(F.lit(name + ":"), state(raw, got)) for name, (raw, got) in forms.items()))
    return rows.select(key, F.coalesce(*(got for _, got in forms.values())).alias("text"), source.alias("source"), report.alias("report"))


def pdf_pages(files: DataFrame, extract: Callable[[bytes], list[tuple[str | None, ...]]], extractors: tuple[str, ...] = ("first", "second")) -> DataFrame:
    """(path, page, a column for each extractor) of (path, content) files: extract gives a tuple a page, None where one failed.

    A file that cannot be opened has one page on which every extractor failed."""
    import pyarrow as pa

    names = ["path", "page", *extractors]

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    rows = extract(content)
                except Exception:  # the document is reported as unread
                    rows = [(None,) * len(extractors)]
                columns = [list(c) for c in zip(*rows, strict=True)] or [[] for _ in extractors]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows), pa.string()), pa.array(range(len(rows)), pa.int32()), *(pa.array(c, pa.string()) for c in columns)], names)

    return files.select("path", "content").mapInArrow(run, "path string, page int, " + ", ".join(f"{e} string" for e in extractors))


# ---- change capture ----


def text_plan(records: DataFrame, texts: DataFrame, fetched: DataFrame, key: str, *, force: bool = False) -> DataFrame:
    """(key, op, text, source, hash, data_created): what to do with each text.

    records: (key, data_created), what there is; texts: (key, hash), what we have; fetched: (key, text, source), what was found for
    the candidates. add: found and not had; update: found with another hash (or forced); missing: looked for, not had, not found;
    delete: had of a record that is gone; none: else."""
    r = records.select(F.col(key).alias("__r"), F.col("data_created").cast("long").alias("data_created"))
    h = texts.select(F.col(key).alias("__h"), F.col("hash").alias("__old"))
    f = fetched.select(F.col(key).alias("__f"), F.nullif(F.col("text"), F.lit("")).alias("text"), "source")
    both = r.join(h, F.col("__r") == F.col("__h"), "full").join(f, F.col("__r") == F.col("__f"), "left").withColumn("hash", T.sorted_char_hash(F.col("text")))
    found, had = F.col("text").isNotNull(), F.col("__h").isNotNull()
    op = (
        F.when(F.col("__r").isNull(), "delete")
        .when(found & ~had, "add")
        .when(found & (F.lit(force) | ~F.col("hash").eqNullSafe(F.col("__old"))), "update")
        .when(F.col("__f").isNotNull() & ~had, "missing")
        .otherwise("none")
    )
    return both.select(F.coalesce("__r", "__h").alias(key), op.alias("op"), "text", F.when(found, F.col("source")).alias("source"), "hash", "data_created")


def retagged_records(records: DataFrame, plan: DataFrame, key: str, *, missing: str | None = "transcript_missing") -> DataFrame:
    """records with the missing tag where nothing was found, and without it where a text was added; missing None changes nothing."""
    if missing is None:
        return records
    p = plan.select(F.col(key).alias("__k"), F.col("op").alias("__op"))
    new = F.when(F.col("__op") == "missing", tag_add(F.col("tags"), missing)).when(F.col("__op") == "add", tag_remove(F.col("tags"), missing)).otherwise(F.col("tags"))
    return records.join(p, F.col(key) == F.col("__k"), "left").withColumn("tags", new).select(records.columns)


def cascade(tables: dict[str, DataFrame], gone: DataFrame, key: str) -> dict[str, DataFrame]:
    """Every table without the rows of the keys in gone."""
    ids = gone.select(key).distinct()
    return {name: t.join(ids, key, "left_anti") for name, t in tables.items()}


def lacking(texts: DataFrame, artefact: DataFrame, key: str, *, most: int | None = None, force: bool = False) -> DataFrame:
    """Keys of texts without that artefact (with force: all), newest first if only `most` are wanted."""
    rows = texts if most is None else texts.orderBy(F.desc("data_created"), key).limit(most)
    ids = rows.select(key)
    return ids if force else ids.join(artefact.select(key).distinct(), key, "left_anti")


def with_artefacts(texts: DataFrame, artefacts: dict[str, DataFrame], key: str) -> DataFrame:
    """texts with has_<artefact> for each of them."""
    out = texts
    for name, rows in artefacts.items():
        out = out.join(rows.select(F.col(key).alias("__k")).distinct(), F.col(key) == F.col("__k"), "left").withColumn(f"has_{name}", F.col("__k").isNotNull()).drop("__k")
    return out


def ignored_terms(people: DataFrame, key: str, always: list[str], *lists: str) -> DataFrame:
    """(key, terms): the given terms and the tokens of the names in the people columns; for documents without people only the former."""
    fixed = F.array(*map(F.lit, always)).cast("array<string>")
    return people.select(key, F.array_distinct(F.concat(fixed, P.name_tokens(P.distinct_people(*map(F.col, lists))) if lists else fixed)).alias("terms"))


# ---- the store ----


class TextStore:
    """texts (key, text, hash, data_created, data_updated, tags), term_counts (key, term, count), doc_counts (term, n_docs), tfidf (key,
    term, tfidf), pseudo (key, pseudo, issue) and counted (key), the documents that doc_counts includes, below one folder."""

    def __init__(self, spark: SparkSession, folder: str, key: str = "doc_id", key_type: str = "bigint", *, counts: Callable[[DataFrame], DataFrame] = analytics.full_counts, buckets: int = 16):
        self.spark, self.key, self.key_type, self.counts = spark, key, key_type, counts
        self.versions = Versions(spark, folder, buckets, patches=PATCHES)
        self.kinds = {
            "texts": f"{key} {key_type}, text string, hash string, data_created long, data_updated long, tags array<string>",
            "term_counts": f"{key} {key_type}, term string, count long",
            "tfidf": f"{key} {key_type}, term string, tfidf double",
            "pseudo": f"{key} {key_type}, pseudo string, issue string",
            "doc_counts": "term string, n_docs long",
            "counted": f"{key} {key_type}",
            "pending": f"{key} {key_type}, {PENDING}",
            "totals": "name string, n long",
        }

    def read(self, name: str = "texts") -> DataFrame:
        return self._of(self.versions.begin(), name)

    def _of(self, c, name: str, touched: list[int] | None = None, *, total: bool = False) -> DataFrame:
        rows = c.read(name, touched) if c.has(name) else self.spark.createDataFrame([], self.kinds[name])
        return rows if total or name != "term_counts" else rows.select(self.key, "term", "count")

    def _only(self, rows: DataFrame, ids: DataFrame, every: DataFrame) -> tuple[DataFrame, bool]:
        """The rows of the documents in ids, and whether they stay in their tasks; every: the keys of all documents, of which ids are some. Both
        hold a key once. The shorter list, of those that are wanted or of the others, is broadcast, if it is short enough."""
        wanted, all_ = ids.count(), every.count()
        if wanted == all_:
            return rows, True
        if min(wanted, all_ - wanted) > LISTED:
            return rows.join(ids, self.key, "left_semi"), False
        if wanted <= all_ - wanted:
            return rows.join(F.broadcast(ids), self.key, "left_semi"), True
        return rows.join(F.broadcast(every.join(ids, self.key, "left_anti")), self.key, "left_anti"), True

    def sync(self, plan: DataFrame, *, now: int, dry_run: bool = False) -> dict[str, int]:
        """Make a text_plan so; the counts by operation. What was derived from changed and deleted texts goes, in the same commit."""
        plan = plan.persist()
        try:
            counts = {r.op: r.n for r in plan.groupBy("op").agg(F.count("*").alias("n")).collect()}  # five rows
            if not dry_run and set(counts) & {"add", "update", "delete"}:
                self._apply(plan, now)
        finally:
            plan.unpersist()
        return counts

    def _apply(self, plan: DataFrame, now: int) -> None:
        c, key = self.versions.begin(), self.key
        moved = plan.where("op in ('add', 'update', 'delete')").select(key)
        touched = self.versions.touched(moved, key)
        gone = plan.where("op in ('update', 'delete')").select(key)
        stamp = F.lit(now).cast("long").alias("data_updated")
        found = [key, "text", "hash", "data_created", stamp, F.array("source").alias("tags")]  # of texts that were not there, so nothing is joined
        if c.has("texts"):
            old = self._of(c, "texts", touched).select(F.col(key).alias("__k"), F.col("tags").alias("__tags"), F.col("data_created").alias("__created"))
            other = F.filter(F.coalesce("__tags", F.array().cast("array<string>")), lambda t: ~t.isin(*SOURCES))
            row = [key, "text", "hash", F.coalesce("__created", "data_created").alias("data_created"), stamp, F.concat(other, F.array("source")).alias("tags")]
            c.put("texts", plan.where("op = 'add'").select(*found), fresh=True)
            c.put("texts", plan.where("op = 'update'").join(old, F.col(key) == F.col("__k"), "left").select(*row))
            c.drop("texts", plan.where("op = 'delete'"))
        else:
            c.replace("texts", plan.where("op in ('add', 'update')").select(*found), key)
        for name in ARTEFACTS:
            if c.has(name):
                c.drop(name, gone)
        if c.has("counted"):
            had = self._of(c, "counted", touched).join(gone, key, "left_semi")
            off = self._of(c, "term_counts", touched).join(had, key, "left_semi").groupBy("term").agg((-F.count("*")).alias("n_docs"))
            c.add("doc_counts", off, "term")
            c.add("totals", had.agg((-F.count("*")).alias("n")).select(F.lit("counted").alias("name"), "n"), "name")
            c.drop("counted", had)
        if c.has("pending"):
            c.append("pending", gone.select(key, F.lit(None).cast("string").alias("term"), F.lit(c.at + 1).cast("long").alias("epoch")))
        c.append("log", moved.join(plan, key).select(key, "op", "hash", F.lit(now).cast("long").alias("ts")))
        c.commit()
        self.versions.upkeep()

    def delete_from(self, source: str, *, now: int) -> dict[str, int]:
        """Delete the texts that came from a source, with all that was derived from them."""
        none = F.lit(None).cast("string")
        return self.sync(tagged(self.read(), source).select(self.key, F.lit("delete").alias("op"), none.alias("text"), none.alias("source"), "hash", "data_created"), now=now)

    def missing(self, artefact: str, *, most: int | None = None, force: bool = False) -> DataFrame:
        return self._missing(self.versions.begin(), artefact, most, force)

    def _missing(self, c, artefact: str, most: int | None, force: bool) -> DataFrame:
        return lacking(self._of(c, "texts"), self._of(c, artefact), self.key, most=most, force=force)

    def _add(self, c, name: str, ids: DataFrame, rows: DataFrame, *more: DataFrame, anew: bool, placed: bool = False) -> None:
        """Rows of the documents in ids; anew: in the place of what they have; placed: rows, but not more, are written where they are made."""
        if not c.has(name):
            c.replace(name, rows, self.key, placed=placed)
        else:
            if anew:
                c.drop(name, ids)
            c.put(name, rows, fresh=True, placed=placed)
        for others in more:
            c.put(name, others, self.key, fresh=True)

    def update_term_counts(self, *, most: int | None = None) -> None:
        """Count the terms of the texts that have no counts."""
        c = self.versions.begin()
        rows, ids = self._of(c, "texts"), self._missing(c, "term_counts", most, False)
        docs, stay = self._only(rows, ids, rows.select(self.key))
        docs = docs.select(F.col(self.key).alias("doc_id"), "text")
        known = inspect.signature(self.counts).parameters
        made = self.counts(docs, **{name: True for name in ("unique", "total") if name in known})
        if c.has("term_counts") and "total" not in c.read("term_counts", []).columns:  # a store from before there were totals
            made = made.drop("total")
        elif "total" not in made.columns:
            made = made.withColumn("total", F.sum("count").over(Window.partitionBy("doc_id")))
        self._add(c, "term_counts", ids, made.withColumnRenamed("doc_id", self.key), anew=False, placed=stay and "unique" in known and c.large("texts"))
        c.append("pending", ids.select(self.key, F.lit("").alias("term"), F.lit(c.at + 1).cast("long").alias("epoch")))
        c.commit()
        self.versions.upkeep()

    def term_count(self, ids: DataFrame) -> DataFrame:
        """The counted terms of some documents, largest counts first."""
        return self.read("term_counts").join(ids.select(self.key), self.key, "left_semi").orderBy(self.key, F.desc("count"), "term")

    def update_pseudo(self, *, ignored: DataFrame | None = None, more_than: int = 2, limit: int | None = 50_000, most: int | None = None, force: bool = False) -> None:
        """Summaries of the counted texts that have none. ignored: (key, terms)."""
        c = self.versions.begin()
        counts = self._of(c, "term_counts")
        ids = self._missing(c, "pseudo", most, force)
        own = counts.join(ids, self.key, "left_semi").withColumnRenamed(self.key, "doc_id")
        skip = None if ignored is None else ignored.withColumnRenamed(self.key, "doc_id")
        made = analytics.pseudo_text(own, more_than=more_than, limit=limit, ignored=skip).withColumnRenamed("doc_id", self.key)
        self._add(c, "pseudo", ids.join(counts.select(self.key).distinct(), self.key, "left_semi"), made, anew=force)
        c.commit()
        self.versions.upkeep()

    def update_doc_counts(self, *, wipe: bool = False) -> int:
        """Add the terms of the documents that wait to be counted (wipe: count all anew); the number of documents counted."""
        c, key = self.versions.begin(), self.key
        total = lambda ids: ids.agg(F.count("*").alias("n")).select(F.lit("counted").alias("name"), "n")
        if wipe or not c.has("counted"):
            counts = self._of(c, "term_counts")
            ids = counts.select(key).distinct()
            c.replace("doc_counts", analytics.document_counts(counts), "term", mode="sum")
            c.replace("counted", ids, key)
            c.replace("totals", total(ids), "name", mode="sum")
        else:
            waiting = self._of(c, "pending")
            off = waiting.where("term is null").groupBy(key).agg(F.max("epoch").alias("__off"))
            fresh = waiting.where("term is not null").join(off, key, "left").where("__off is null or epoch > __off").select(key).distinct().persist()
            touched = self.versions.touched(fresh, key)
            there = self._of(c, "texts", touched).select(key)
            more, _ = self._only(self._of(c, "term_counts", touched), fresh.join(there, key, "left_semi"), there)
            ids = more.select(key).distinct()
            c.add("doc_counts", analytics.document_counts(more), "term")
            c.put("counted", ids, fresh=True)
            c.add("totals", total(ids), "name")
        c.clear("pending")
        c.commit()
        if not wipe and "fresh" in locals():
            fresh.unpersist()
        self.versions.upkeep()
        return self.n_counted()

    def n_counted(self) -> int:
        """The number of documents that the document counts include."""
        row = self.read("totals").first()
        return row.n if row else 0

    def update_tfidf(self, *, force: bool = False) -> None:
        """TF-IDF of the counted documents that have none, by the document counts as they are now."""
        c = self.versions.begin()
        n = self._of(c, "totals").first()
        ids = self._missing(c, "tfidf", None, force).join(self._of(c, "counted"), self.key, "left_semi")
        counts, stay = self._only(self._of(c, "term_counts", total=True), ids, self._of(c, "texts").select(self.key))
        counts = counts.withColumnRenamed(self.key, "doc_id")
        parts = analytics.weighted_parts(counts, analytics.idf_of(self._of(c, "doc_counts"), n.n if n else 0))
        parts = [p.withColumnRenamed("doc_id", self.key) for p in parts]
        self._add(c, "tfidf", ids, *parts, anew=force, placed=stay and "total" in counts.columns and c.large("term_counts"))
        c.commit()
        self.versions.upkeep()

    def export_text(self, name: str, column: str, folder: str) -> int:
        """Write one text file a document: folder/<key>.txt, from a column of texts or pseudo; how many there are now.

        Tasks write their own documents to the folder, which must be a file system that they reach: each file under a name of its own
        first, then renamed, so a task that is run again writes the same files."""
        import pyarrow as pa

        def run(batches):
            import os
            import re
            import uuid

            from pyarrow import fs

            where, root = fs.FileSystem.from_uri(folder)
            where.create_dir(root, recursive=True)
            local = isinstance(where, fs.LocalFileSystem)  # a third of the time by plain calls
            opened, move = (lambda path: open(path, "wb"), os.replace) if local else (where.open_output_stream, where.move)
            for batch in batches:
                for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    draft = f"{root}/.{uuid.uuid4().hex}"
                    with opened(draft) as out:
                        out.write(t.encode())
                    move(draft, f"{root}/{re.sub(r'[^A-Za-z0-9_.-]', '_', k)}.txt")
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

        rows = self.read(name).select(F.col(self.key).cast("string").alias("k"), F.col(column).alias("t")).where("t is not null")
        return rows.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n

    def import_texts(self, folder: str) -> DataFrame:
        """(key, text) of the files <key>.txt of a folder, which must be a file system that the tasks reach. One task gives out the names,
        and all read the files, so neither the driver nor the number of tasks grows with them."""
        import pyarrow as pa

        def names(batches):
            import itertools
            import os

            from pyarrow import fs

            for _ in batches:
                where, root = fs.FileSystem.from_uri(folder)
                local = isinstance(where, fs.LocalFileSystem)
                found = (f.name for f in os.scandir(root)) if local else (f.base_name for f in where.get_file_info(fs.FileSelector(root)))
                found = (n for n in found if n.endswith(".txt") and not n.startswith("."))
                while some := list(itertools.islice(found, NAMES)):
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["name"])

        made = lambda read, held: pa.RecordBatch.from_arrays([pa.array(read, pa.string()), pa.array(held, pa.binary())], ["name", "text"])

        def run(batches):
            from pyarrow import fs

            where, root = fs.FileSystem.from_uri(folder)
            for batch in batches:
                read, held, size = [], [], 0
                for name in batch.column(0).to_pylist():
                    with where.open_input_stream(f"{root}/{name}", compression=None) as x:
                        read.append(name)
                        held.append(x.read())
                    size += len(held[-1])
                    if size > READ:
                        yield made(read, held)
                        read, held, size = [], [], 0
                if held:
                    yield made(read, held)

        tasks = max(READERS, 4 * self.spark.sparkContext.defaultParallelism)
        files = self.spark.range(0, 1, 1, 1).mapInArrow(names, "name string").repartition(tasks, "name").mapInArrow(run, "name string, text binary")
        return files.select(F.regexp_extract("name", r"(?s)^(.*)\.txt$", 1).cast(self.key_type).alias(self.key), F.col("text").cast("string").alias("text"))


def hash_of(text: Column) -> Column:
    """The hash by which texts are compared: equal for anagrams, as in `functions.text`."""
    return T.sorted_char_hash(text)
