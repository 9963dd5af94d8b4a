"""Queries over transactions, merge on read, pulls, the phrase index and mined phrases, with the SQL that each is compared with."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ..operators import mining, store, texts
from ..operators.phrase_index import PhraseIndex, places
from ..operators.versions import Conflict
from ..sources import files, pull
from .catalogue import docs, query, table
from .scratch import folder, written


def _orders(spark, sf_dir) -> tuple[store.Store, object]:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    s = store.Store(spark, folder(spark, "store"), "o_orderkey", ["o_orderstatus"], buckets=4)
    s.sync(rows, now=1)
    return s, rows


@query("concurrent_commits", "select o_orderkey, concat_ws('|', case when o_orderkey % 3 = 0 then 'late' end, case when o_orderkey % 7 = 0 then 'seen' end) tags, true refused from orders where o_orderkey % 5 <> 0 and o_orderkey % 2 = 0")
def concurrent_commits(spark, sf_dir):
    """Interleaved writers of one store: a blind change is rebased over a deletion; a rewrite of rows that another writer tagged
    meanwhile is refused, and made again from the newest version."""
    s, rows = _orders(spark, sf_dir)
    first = s.versions.begin()
    late = rows.where("o_orderkey % 3 = 0").select("o_orderkey", F.lit("add tag").alias("op"), F.array(F.lit("late")).alias("arg"))
    first.patch("rows", late, ["add tag"])
    s.delete(rows.where("o_orderkey % 5 = 0"), now=2)
    first.commit()

    def halve(meanwhile) -> None:
        c = s.versions.begin()
        c.replace("rows", c.read("rows").where("o_orderkey % 2 = 0"), "o_orderkey")
        meanwhile()
        c.commit()

    refused = False
    try:
        halve(lambda: s.add_tag("seen", rows.where("o_orderkey % 7 = 0")))
    except Conflict:
        refused = True
        halve(lambda: None)
    return s.read().select("o_orderkey", F.array_join(F.array_sort("tags"), "|").alias("tags"), F.lit(refused).alias("refused"))


@query("merged_changes", """select o_orderkey, read, case when o_orderkey % 10 = 0 then 'put' else o_orderstatus end o_orderstatus, concat_ws('|', case when o_orderkey % 10 <> 0 then 'every' end, case when o_orderkey % 4 = 0 and o_orderkey % 10 <> 0 then 'four' end) tags,
case when o_orderkey % 6 = 0 then 'h' end hash from orders, (values ('merged'), ('folded')) v(read) where o_orderkey % 9 <> 0""")  # fmt: skip
def merged_changes(spark, sf_dir):
    """A store with changes on top of its buckets, as it is read and after the changes were folded into the buckets."""
    s, rows = _orders(spark, sf_dir)
    s.add_tag("4", rows.where("o_orderkey % 4 = 0"))
    s.replace_tag("4", "four")
    s.add_tag("every")
    s.delete(rows.where("o_orderkey % 9 = 0"), now=2)
    s.put(rows.where("o_orderkey % 10 = 0 and o_orderkey % 9 <> 0").select("o_orderkey", F.lit("put").alias("o_orderstatus")), now=3)
    s.set_hash(rows.where("o_orderkey % 6 = 0").select("o_orderkey", F.lit("h").alias("hash")))
    show = lambda name: s.read().select("o_orderkey", F.lit(name).alias("read"), "o_orderstatus", F.array_join(F.array_sort("tags"), "|").alias("tags"), F.when(F.col("hash") == "h", "h").alias("hash"))
    merged = written(show("merged"), "merged")
    s.versions.compact({"rows": list(range(4))})
    return merged.unionByName(show("folded"))


@query("store_counts", "select 'rows' what, count(*) n from orders where o_orderkey % 5 <> 0 union all select 'gone', count(*) from orders where o_orderkey % 5 = 0 union all select 'ids', count(distinct o_orderkey) from orders where o_orderkey % 5 <> 0")
def store_counts(spark, sf_dir):
    """The number of records and keys of a store, and of its tombstones."""
    s, rows = _orders(spark, sf_dir)
    s.delete(rows.where("o_orderkey % 5 = 0"), now=2)
    row = lambda what, df: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return row("rows", s.read()).unionByName(row("gone", s.table("tombstones"))).unionByName(row("ids", s.ids()))


@query("tags_all_rows", "select o_orderkey, case when o_orderkey % 2 = 0 then 'b|c' else 'b' end tags from orders")
def tags_all_rows(spark, sf_dir):
    """Tags added to, replaced in and removed from all records, each by an entry of the manifest."""
    s, rows = _orders(spark, sf_dir)
    s.add_tag("a")
    s.add_tag("x")
    s.add_tag("c", rows.where("o_orderkey % 2 = 0"))
    s.replace_tag("a", "b")
    s.remove_tag("x")
    return s.read().select("o_orderkey", F.array_join(F.array_sort("tags"), "|").alias("tags"))


@query("signed_doc_counts", """with t as (select doc_id, unnest(list_distinct(regexp_extract_all(lower(case when doc_id % 13 = 0 then text || ' again changed' else text end), '[\\p{L}\\p{N}]+'))) term from documents where doc_id % 17 <> 0)
select term, count(*) n_docs from t group by term""".replace("\\\\", "\\"))  # fmt: skip
def signed_doc_counts(spark, sf_dir):
    """Document counts after documents came in two runs, changed and went, by signed increments alone."""
    from ..operators import analytics

    d = docs(spark, sf_dir).where("text <> ''")
    s = texts.TextStore(spark, folder(spark, "texts"), counts=analytics.term_counts, buckets=4)

    def bring(rows, every) -> None:
        s.sync(texts.text_plan(every.select("doc_id", F.lit(0).alias("data_created")), s.read(), rows.select("doc_id", "text", F.lit("json").alias("source")), "doc_id"), now=1)
        s.update_term_counts()

    bring(d.where("doc_id % 50 <> 0"), d.where("doc_id % 50 <> 0"))
    s.update_doc_counts()
    bring(d.where("doc_id % 50 = 0"), d)
    changed = d.where("doc_id % 13 = 0").select("doc_id", F.concat("text", F.lit(" again changed")).alias("text"))
    bring(changed, d.where("doc_id % 17 <> 0"))
    s.update_doc_counts()
    return s.read("doc_counts")


# ---- pulls ----


@query("paged_pull", "select o_orderpriority product, o_orderkey, o_custkey from orders")
def paged_pull(spark, sf_dir):
    """Orders as pages of five products, read by tasks as a stream that breaks off once and goes on from its checkpoint."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_custkey")
    site, size = folder(spark, "site"), 4000
    names = [r[0] for r in rows.select("o_orderpriority").distinct().orderBy("o_orderpriority").collect()]  # five rows
    place = F.pmod(F.xxhash64("o_orderkey"), F.lit(6)).cast("int")
    rows.withColumn("page", place).repartition("o_orderpriority", "page").write.partitionBy("o_orderpriority", "page").parquet(site)
    plan = json.dumps([[n, size, 5 * size] for n in names])

    def pages(broken_at: int | None):
        def fetch(offset: int, options: dict):
            """A page of the product: the rows of its folder."""
            import urllib.parse

            import pyarrow.dataset as ds
            from pyarrow import fs

            if broken_at is not None and options["product"] == names[2] and offset >= broken_at:
                raise OSError("the site is down")
            name = urllib.parse.quote(options["product"], safe=" -")
            where, path = fs.FileSystem.from_uri(f"{site}/o_orderpriority={name}/page={offset // size}")
            if where.get_file_info(path).type == fs.FileType.NotFound:
                return []
            got = ds.dataset(path, filesystem=where, format="parquet").to_table()
            return [(options["product"], k, c) for k, c in zip(got["o_orderkey"].to_pylist(), got["o_custkey"].to_pylist(), strict=True)]

        return fetch

    at = folder(spark, "read")
    options = {"plan": plan, "pages_at_once": "7"}
    kind = "product string, o_orderkey long, o_custkey long"
    for name, broken_at in (("quern_orders_broken", size), ("quern_orders", None)):
        spark.dataSource.register(files.paged_source(name, kind, pages(broken_at)))
        try:
            got = files.read_pages(spark, name, at, options)
        except Exception:
            if broken_at is None:
                raise
    return got


# ---- phrases ----

PHRASES = ("the", "of the", "er the", "a s", "ing")


def _hits_sql(phrase: str) -> str:
    return f"""select doc_id, '{phrase}' phrase, (k - 1)::int pos, right(a[k], 25) || '{phrase}' || left(array_to_string(a[k + 1:], '{phrase}'), 25) snippet
from (select doc_id, a, unnest(range(1, len(a))) k from (select doc_id, string_split(lower(text), '{phrase}') a from documents))"""


def _index(spark, sf_dir) -> PhraseIndex:
    """All documents, a third of which were indexed with another text first and some of which were removed and came again."""
    d = docs(spark, sf_dir)
    index = PhraseIndex(spark, folder(spark, "phrases"), buckets=4)
    index.add(d.select("doc_id", F.when(F.col("doc_id") % 3 == 0, "the former text of the document").otherwise(F.col("text")).alias("text")))
    index.remove(d.where("doc_id % 5 = 0"))
    index.add(d.where("doc_id % 3 = 0 or doc_id % 5 = 0"))
    return index


@query("indexed_phrases", "with h as (" + " union all ".join(map(_hits_sql, PHRASES)) + ") select l.doc_id, p.phrase, case when d.doc_id is null then 'no text' when h.pos is null then 'not found' else 'found' end outcome, h.pos, h.snippet from labels l cross join (select unnest([" + ", ".join(f"'{p}'" for p in PHRASES) + "]) phrase) p left join (select doc_id from documents where text is not null) d using (doc_id) left join h on h.doc_id = d.doc_id and h.phrase = p.phrase")
def indexed_phrases(spark, sf_dir):
    """The phrase report by the positional index: whole words, and phrases whose ends are parts of words."""
    index, wanted = _index(spark, sf_dir), table(spark, sf_dir, "labels").select("doc_id")
    out = None
    for p in PHRASES:
        part = index.report(wanted, docs(spark, sf_dir), p).withColumn("phrase", F.lit(p))
        out = part if out is None else out.unionByName(part)
    return out.select("doc_id", "phrase", "outcome", "pos", "snippet")


@query("term_places", r"""with t as (select doc_id, unnest(range(len(l))) place, unnest(l) term from (select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') l from documents where text is not null))
select doc_id, term, count(*) n, min(place)::int first_place, max(place)::int last_place from t group by all""")
def term_places(spark, sf_dir):
    """The postings of the index: how often each term stands in a document, and where first and last."""
    p = places(docs(spark, sf_dir), "doc_id")
    return p.select("doc_id", "term", F.size("places").cast("long").alias("n"), F.get("places", F.lit(0)).alias("first_place"), F.aggregate("places", F.lit(0), lambda a, x: a + x).alias("last_place"))


_STRETCH_SQL = r"""st as (select doc_id, list_filter(string_split(trim(part), ' '), lambda w: w <> '') w from (select doc_id, unnest(regexp_split_to_array(regexp_replace(lower(text), '([^\p{L}\p{N}'' ]+)', '|', 'g'), '\|')) part from documents)),
tk as (select doc_id, row_number() over () s, w from st), fl as (select s, unnest(range(len(w))) k, unnest(w) t from tk),
br as (select *, sum((t in (STOPS))::int) over (partition by s order by k) g from fl), words as (select s, g, list(t order by k) w from br where t not in (STOPS) group by s, g having count(*) > 1)""".replace("STOPS", ", ".join(f"'{w}'" for w in mining.T.STOP_WORDS))
_PAIR_SQL = f"""{_STRETCH_SQL}, bi as (select w[k] left_word, w[k + 1] right_word, count(*) n from (select w, unnest(range(1, len(w))) k from words) group by all),
m as (select *, sum(n) over (partition by left_word) a, sum(n) over (partition by right_word) b, sum(n) over () t from bi),
x as (select left_word, right_word, n, (case when n::double * t >= a::double * b then 1 else -1 end) * 2 * (xl(n) + xl(a - n) + xl(b - n) + xl(t - a - b + n) - xl(a) - xl(t - a) - xl(b) - xl(t - b) + xl(t)) ratio from m)"""


def _with_xlogx(sql: str) -> str:
    """xl(v) written out as v ln v, 0 for 0."""
    out, at = [], 0
    while (k := sql.find("xl(", at)) >= 0:
        end = sql.index(")", k)
        v = sql[k + 3 : end]
        out.append(f"{sql[at:k]}(case when {v} > 0 then ({v})::double * ln(({v})::double) else 0 end)")
        at = end + 1
    return "".join(out) + sql[at:]


@query("collocations", _with_xlogx(f"with {_PAIR_SQL} select left_word, right_word, n, round(ratio, 4) ratio from x"))
def collocations(spark, sf_dir):
    """Two neighbouring words of a stretch: how often, and the log-likelihood ratio of their being together."""
    return mining.collocations(docs(spark, sf_dir), keep=written).withColumn("ratio", F.round("ratio", 4))


@query("mined_phrases", _with_xlogx(f"""with {_PAIR_SQL}, good as (select left_word, right_word, ratio from x where ratio >= 10.83),
gr as (select array_to_string(w[k:k + z - 1], ' ') phrase, any_value(w[k:k + z - 1]) p, any_value(z) size, count(*) n from (select w, z, unnest(range(1, len(w) - z + 2)) k from words, (values (2), (3), (4)) v(z)) group by 1 having count(*) >= 5),
pr as (select phrase, n, size, p[k] left_word, p[k + 1] right_word from (select *, unnest(range(1, size)) k from gr)),
kp as (select phrase, any_value(size) size, any_value(n) n, min(ratio) ratio from pr join good using (left_word, right_word) group by phrase having count(*) = any_value(size) - 1),
sub as (select distinct phrase, n, array_to_string(p[k:k + z - 1], ' ') inn from (select gr.*, z, unnest(range(1, size - z + 2)) k from gr join (values (2), (3)) v(z) on z < size where phrase in (select phrase from kp))),
ar as (select inn, sum(n) / count(*) avg_n from sub group by inn)
select phrase, size::int size, n, round(ratio, 4) ratio, round(log2(size) * (n - coalesce(avg_n, 0)), 6) c_value from kp left join ar on inn = phrase"""))
def mined_phrases(spark, sf_dir):
    """Phrases of two to four words that attract each other, with their C-value."""
    out = mining.phrases(docs(spark, sf_dir), keep=written)
    return out.select("phrase", "size", "n", F.round("ratio", 4).alias("ratio"), F.round("c_value", 6).alias("c_value"))


# ---- rows of a run ----


@query("probed_pages", "select o_orderpriority product, 24::bigint base_multiple, ((count(*) - 1) // 24 * 24)::bigint max_multiple from orders group by o_orderpriority")
def probed_pages(spark, sf_dir):
    """Page sizes and last pages of five products, found by probing pages of a site that holds the orders."""
    held = {r[0]: r[1] for r in table(spark, sf_dir, "orders").groupBy("o_orderpriority").count().collect()}  # five rows

    class Site:
        def page(self, kind, product, offset):
            return range(max(0, min(24, held[product] - offset)))

    found, errors = pull.probe_paging(spark, Site(), "videos", sorted(held), most=max(held.values()))
    if errors:
        raise ValueError(str(errors))
    stale = found.limit(1).withColumn("max_multiple", F.lit(1).cast("long"))
    return pull.updated_paging(stale, found)


@query("text_files", "select doc_id, length(text) chars, sha256(text) text_sha256 from documents where text <> ''")
def text_files(spark, sf_dir):
    """Texts written by tasks as one file a document, and read again."""
    d = docs(spark, sf_dir).where("text <> ''")
    s = texts.TextStore(spark, folder(spark, "texts"), buckets=2)
    s.sync(texts.text_plan(d.select("doc_id", F.lit(0).alias("data_created")), s.read(), d.select("doc_id", "text", F.lit("json").alias("source")), "doc_id"), now=1)
    at = folder(spark, "files")
    s.export_text("texts", "text", at)
    return s.import_texts(at).select("doc_id", F.length("text").cast("long").alias("chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query("publication_sync", """select o_orderkey::varchar id, case when o_orderkey % 9 = 0 then 99 else o_orderkey % 40 end::bigint pages, epoch_ms(o_orderdate)::bigint data_created, case when o_orderkey % 9 = 0 or o_orderkey % 7 = 0 then 2 else 1 end::bigint data_updated
from orders where o_orderkey % 11 <> 0""")  # fmt: skip
def publication_sync(spark, sf_dir):
    """Publications after two pulls: some are new, changed or gone."""
    from .sync_queries import publications

    key, fields = F.col("id").cast("long"), ["title", "pages", "assets", "published_on"]
    rows = publications(spark, sf_dir).select("id", "title", F.col("pages").cast("long").alias("pages"), "assets", "published_on")
    s = store.Store(spark, folder(spark, "publications"), "id", fields, created="published_on", buckets=4)
    s.sync(rows.where(key % 7 != 0), now=1)
    s.sync(rows.where(key % 11 != 0).withColumn("pages", F.when(key % 9 == 0, 99).otherwise(F.col("pages"))), now=2)
    return s.read().select("id", "pages", "data_created", "data_updated")


@query("pushed_indexes", """select name, outcome, count(*) n from (select 'all' name, case when o_orderkey % 5 = 0 then 'unchanged' else 'pushed' end outcome from orders union all
select 'some', case when o_orderkey % 5 = 0 then 'unchanged' else 'pushed' end from orders where o_orderkey % 2 = 0) group by all""")  # fmt: skip
def pushed_indexes(spark, sf_dir):
    """Two indexes brought up to date and pushed in turn to a folder; units that were pushed before are left alone."""
    from ..operators import delivery, records

    fresh = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).withColumn("hash", F.sha2(F.concat_ws("|", "id", "status", "priority"), 256))
    value = lambda: F.struct("status", "priority")
    old = fresh.where("id % 5 = 0").select("id", value().alias("pushed"), value().alias("current"), "hash", F.array().cast("array<string>").alias("tags"))

    class Nowhere:
        """The rows of interest are the outcomes."""

        def upsert(self, key, record):
            pass

        delete = upsert

    def index(name: str, where: str) -> delivery.Index:
        return delivery.Index(name, lambda: fresh.where(where), ["status", "priority"], Nowhere(), lambda: old.where(where), lambda rows: None)

    counts = delivery.push_indexes([index("all", "true"), index("some", "id % 2 = 0")], records.unit_plan, written)
    return spark.createDataFrame([(n, o, k) for n, c in counts.items() for o, k in c.items()], "name string, outcome string, n long")


@query("retained_versions", "select 'kept' what, 3::bigint n union all select 'rows', count(*) from orders where o_orderkey % 3 = 0")
def retained_versions(spark, sf_dir):
    """A store of many versions after all but the newest three were dropped; its rows are as they were."""
    s, rows = _orders(spark, sf_dir)
    for k in range(3):
        s.add_tag(f"t{k}")
    s.delete(rows.where("o_orderkey % 3 <> 0"), now=2)
    s.retain(3, grace_ms=0)
    row = lambda what, df: df.agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), "n")
    return row("kept", spark.createDataFrame([(v,) for v in s.versions.numbers()], "v long")).unionByName(row("rows", s.read().where("size(tags) = 3")))


@query("ledger_outcomes", "select o_orderkey, case when o_orderkey % 6 = 1 then 'refused' end error, 1::bigint sent from orders")
def ledger_outcomes(spark, sf_dir):
    """A delivery under a ledger that runs twice, as a retried task does: what was sent is not sent again, what was refused is."""
    from ..operators import outbox

    calls = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.lit("status")).alias("fields"), F.to_json(F.struct("o_orderstatus")).alias("record"))
    book, log, opened = folder(spark, "ledger"), folder(spark, "sent"), {}

    def send(key, record):
        import os
        import uuid

        from ..operators.ledger import local_path

        if key % 6 == 1:
            raise OSError("refused")
        if "out" not in opened:  # one file a task, in which each line is at once
            where = local_path(log) / f"process={os.getpid()}-{uuid.uuid4().hex}"
            where.mkdir(parents=True)
            opened["out"] = (where / "keys").open("a", buffering=1)
        opened["out"].write(f"{key}\n")

    for _ in range(2):
        out = written(outbox.deliver(calls, "o_orderkey", send, writers=4, ledger=book), "outcomes")
    sent = spark.read.text(f"{log}/*/keys").groupBy(F.col("value").cast("long").alias("o_orderkey")).agg(F.count("*").alias("sent"))
    return out.select("o_orderkey", "error").join(sent, "o_orderkey", "left").select("o_orderkey", "error", F.coalesce("sent", F.lit(1)).cast("long").alias("sent"))
