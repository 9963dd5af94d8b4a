"""Queries over record builders, text synchronisation, delivery and snapshots, with the SQL that each is compared with.

The tables stand in for the library's inputs: orders for videos and publications, customer for guests, nation and region for shows,
lineitem for comments, documents for texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import analytics, cdc, checks, delivery, enrich, outbox, records, store, texts
from ..sources import files, pull
from .catalogue import COUNTS_SQL, NOW, docs, query, table
from .scratch import folder, written

TIERS = {"1-URGENT": ["PRO"], "2-HIGH": ["PLUS", "PRO"], "3-MEDIUM": ["ESSENTIAL"]}
_TIERS_SQL = "case o_orderpriority when '1-URGENT' then 'PRO' when '2-HIGH' then 'PLUS|PRO' when '3-MEDIUM' then 'ESSENTIAL' end"


# ---- records ----


def videos(spark, sf_dir) -> DataFrame:
    """Orders as videos: every seventh without a show, every eleventh without a date."""
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    number = lambda c: F.concat(F.lit("Customer "), c.cast("string"))
    return o.select(
        key.cast("string").alias("id"), F.lit("video").alias("type"), F.when(key % 14 == 0, F.concat(F.lit("Night talk - "), key)).otherwise(F.concat(F.lit("Title "), key)).alias("title"),
        F.concat(F.lit("Dr. "), number(F.col("o_custkey")), F.lit(" and "), number(F.col("o_custkey") + 1)).alias("featuring"), F.when(key % 3 == 0, "").otherwise(number(F.col("o_custkey") % 10)).alias("interviewer"),
        F.lit("d").alias("description"), F.col("o_orderpriority").alias("product"), F.lit("t").alias("thumbnail"), F.when(key % 7 == 0, "").otherwise(F.concat(F.lit("http://site/shows/"), key % 30)).alias("show_url"),
        F.array(F.col("o_orderstatus"), F.lit("b")).alias("topics"), F.array(F.lit("b"), F.lit("a")).alias("tag_names"), F.array("o_orderstatus").alias("assets"), (key % 5 == 0).alias("is_free"),
        (key % 100).alias("likes"), (key % 9).alias("dislikes"), (key % 600).alias("duration"), F.when(key % 11 == 0, 0).otherwise(F.unix_millis(F.col("o_orderdate").cast("timestamp"))).alias("published_on"), F.lit(86_400_000).cast("long").alias("filmed_on"),
        (F.lit(NOW) - key % 4).alias("data_updated"), F.lit(NOW).alias("data_created"), F.when(key % 13 == 0, F.array(F.lit("changed"))).otherwise(F.array().cast("array<string>")).alias("tags"),
    )


def guests(spark, sf_dir) -> DataFrame:
    """Customers of an even region as guests."""
    c = table(spark, sf_dir, "customer").where("c_nationkey % 2 = 0")
    return c.select(F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("name"), F.concat(F.lit("rec"), F.col("c_custkey").cast("string")).alias("crm_id"))


def stats(spark, sf_dir) -> DataFrame:
    """Line items as comments, on orders that have a return."""
    rows = table(spark, sf_dir, "lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").cast("string").alias("id"), F.col("l_linenumber").alias("likes"), F.lit(1).alias("dislikes"), F.when(F.col("l_returnflag") == "R", "x").alias("reply_to"))
    tags = F.when(F.col("id").cast("long") % 17 == 0, F.array(F.lit("comments_changed"))).otherwise(F.array().cast("array<string>"))
    return enrich.comment_stats(rows, "id").withColumn("tags", tags)


def shows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("name"))


_STATS_SQL = "c as (select l_orderkey, count(*) n, count(*) filter (l_returnflag = 'R') r, sum(l_linenumber)::bigint li, count(*) di from lineitem where l_linenumber > 1 group by l_orderkey)"
_PEOPLE_SQL = """g as (select c_custkey from customer where c_nationkey % 2 = 0),
v as (select o.*, o_orderkey % 30 sid, a.c_custkey g1, b.c_custkey g2, i.c_custkey g3, n_name from orders o left join g a on a.c_custkey = o_custkey left join g b on b.c_custkey = o_custkey + 1
  left join g i on i.c_custkey = o_custkey % 10 and o_orderkey % 3 <> 0 left join nation on o_orderkey % 7 <> 0 and n_nationkey = o_orderkey % 30)"""


@query(
    "crm_record",
    f"""with {_STATS_SQL}, {_PEOPLE_SQL},
t as (select *, case when o_orderkey % 4 = 0 then 'add' when o_orderkey % 4 = 3 then 'older' when o_orderkey % 4 = 1 and (o_orderkey % 13 = 0 or o_orderkey % 19 = 0 or (o_orderkey % 17 = 0 and o_orderkey in (select l_orderkey from c))) then 'update' when o_orderkey % 4 = 1 then 'none' else 'update' end act,
  case when o_orderkey % 14 = 0 then 'Late' else n_name end shown from v),
k as (select *, case when shown is null or length(shown) % 2 = 1 then '' else 'show-' || shown end crm_show from t)
select o_orderkey::varchar id, act "action", case when w then crm_show end "show", case when w then case when g1 is null or g2 is null then '' else 'rec' || g1 || '|rec' || g2 end end featuring,
  case when w then case when g3 is null then '' else 'rec' || g3 end end interviewers, case when w then case when o_orderstatus < 'a' then o_orderstatus || '|a|b' end end topics,
  case when w and o_orderkey % 11 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end published_on, case when w then 'http://v/' || o_orderkey end link, case when w then {_TIERS_SQL} end tiers,
  case when w then c.n end n_comments, case when w then c.r end n_replies, case when w then c.li end comment_likes, case when w and o_orderkey % 5 = 0 then 'FREE' end is_free,
  case when w then concat_ws('; ', case when o_orderkey % 7 = 0 and o_orderkey % 14 <> 0 then 'no show id' when o_orderkey % 7 <> 0 and n_name is null then 'unknown show id: ' || sid end,
    case when shown is not null and length(shown) % 2 = 1 then 'show not found: ' || shown end,
    case when g1 is null and g2 is null then 'featuring not found: Dr. Customer ' || o_custkey || ', Customer ' || (o_custkey + 1) when g1 is null then 'featuring not found: Dr. Customer ' || o_custkey when g2 is null then 'featuring not found: Customer ' || (o_custkey + 1) end,
    case when o_orderkey % 3 <> 0 and g3 is null then 'interviewer not found: Customer ' || (o_custkey % 10) end,
    case when {_TIERS_SQL} is null then 'unknown product: ' || o_orderpriority end, case when o_orderkey % 11 = 0 then 'no date in published_on' end) else '' end issues
from (select *, act in ('add', 'update') w from k) k left join c on c.l_orderkey = k.o_orderkey
union all select 'gone-' || n_nationkey, 'delete', null, null, null, null, null, null, null, null, null, null, null, '' from nation""",
)
def crm_record(spark, sf_dir):
    v = videos(spark, sf_dir)
    key = F.col("id").cast("long")
    none = F.array().cast("array<string>")
    target = v.where(key % 4 != 0).select("id", F.when(key % 4 == 2, NOW - 5).when(key % 4 == 3, NOW + 5).otherwise(F.col("data_updated")).alias("data_updated"), F.when(key % 19 == 0, F.array(F.lit("issues"))).otherwise(none).alias("tags"))
    gone = table(spark, sf_dir, "nation").select(F.concat(F.lit("gone-"), F.col("n_nationkey").cast("string")).alias("id"), F.lit(NOW).alias("data_updated"), none.alias("tags"))
    n = shows(spark, sf_dir)
    crm_shows = n.select("name").where(F.length("name") % 2 == 0).unionByName(n.limit(1).select(F.lit("Late").alias("name"))).select("name", F.concat(F.lit("show-"), "name").alias("crm_id"))
    out = records.crm_records(v, target.unionByName(gone), shows=n, crm_shows=crm_shows, guests=guests(spark, sf_dir), stats=stats(spark, sf_dir), url_prefix="http://v/", tiers=TIERS, title_rules=[("Night talk - ", "Late")])
    text = lambda c, name: F.array_join(c, "|").alias(name)
    r = "record."
    return out.select(
        "id", "action", text(r + "show", "show"), text(r + "featuring", "featuring"), text(r + "interviewers", "interviewers"), text(r + "topics", "topics"), r + "published_on", r + "link", text(r + "available_to", "tiers"),
        r + "n_comments", r + "n_replies", r + "comment_likes", r + "is_free", F.array_join("issues", "; ").alias("issues"),
    )


@query("crm_issues", f"""with {_PEOPLE_SQL}, i as (select o_orderkey, (g1 is null or g2 is null)::int + (o_orderkey % 3 <> 0 and g3 is null)::int + ({_TIERS_SQL} is null)::int + (o_orderkey % 11 = 0)::int + (n_name is null or length(n_name) % 2 = 1)::int n from v)
select o_orderkey::varchar id, n from i where n > 0""")  # fmt: skip
def crm_issues(spark, sf_dir):
    v, n = videos(spark, sf_dir), shows(spark, sf_dir)
    target = v.limit(0).select("id", "data_updated", "tags")
    crm_shows = n.where(F.length("name") % 2 == 0).select("name", F.col("name").alias("crm_id"))
    made = records.crm_records(v, target, shows=n, crm_shows=crm_shows, guests=guests(spark, sf_dir), stats=stats(spark, sf_dir), url_prefix="", tiers=TIERS)
    return records.issue_table(made).select("id", "n")


_HASHED = "t as (select doc_id, sha256(array_to_string(list_sort(string_split(text, '')), '')) h from documents where text <> '')"


@query(
    "search_unit_video",
    f"""with {_STATS_SQL}, {_PEOPLE_SQL}, {_HASHED}
select o_orderkey::varchar id, concat_ws('|', case when g1 is not null then 'Customer ' || g1 end, case when g2 is not null then 'Customer ' || g2 end) featuring, coalesce('Customer ' || g3, '') interviewer, o_orderstatus || '|a|b' tags, coalesce(n_name, '') "show",
  'http://v/' || o_orderkey url, coalesce({_TIERS_SQL}, '') tiers, c.n n_comments, t.h transcript, case when o_orderkey % 2 = 0 and t.h is not null then sha256('short ' || o_orderkey) end pseudo_transcript,
  case when o_orderkey % 11 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end published_day
from v left join c on c.l_orderkey = o_orderkey left join t on t.doc_id = o_orderkey""",
)
def search_unit_video(spark, sf_dir):
    names = guests(spark, sf_dir).select("name")
    held = docs(spark, sf_dir).where("text <> ''").select(F.col("doc_id").cast("string").alias("id"), texts.hash_of(F.col("text")).alias("hash"))
    short = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("string").alias("id"), F.concat(F.lit("short "), F.col("o_orderkey").cast("string")).alias("pseudo"))
    out = records.video_units(videos(spark, sf_dir), shows=shows(spark, sf_dir), guests=names, stats=stats(spark, sf_dir), texts=held, summaries=short, url_prefix="http://v/", tiers=TIERS)
    text = lambda c: F.array_join(c, "|").alias(c)
    return out.select("id", text("featuring"), text("interviewer"), text("tags"), "show", "url", text("tiers"), "n_comments", "transcript", "pseudo_transcript", "published_day")


def publications(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.lit("issue").alias("type"), F.lit("t").alias("title"), F.lit("s").alias("summary"), F.lit("h").alias("thumbnail"), (F.col("o_orderkey") % 40).alias("pages"),
        F.array("o_orderstatus", F.lit("x")).alias("assets"), F.array(F.lit("x")).alias("topics"), F.lit(0).cast("long").alias("likes"), F.lit(0).cast("long").alias("dislikes"), F.col("o_orderpriority").alias("product"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("published_on"),
    )


@query("search_unit_publication", f"""with {_HASHED} select o_orderkey::varchar id, (o_orderkey % 40)::bigint pages, o_orderstatus || '|x|x' tags, 'http://p/' || o_orderkey url, coalesce({_TIERS_SQL}, '') tiers, t.h transcript, strftime(o_orderdate, '%Y-%m-%d') published_day,
  case when {_TIERS_SQL} is null then 'unknown product: ' || o_orderpriority else '' end issues from orders left join t on t.doc_id = o_orderkey""")  # fmt: skip
def search_unit_publication(spark, sf_dir):
    held = docs(spark, sf_dir).where("text <> ''").select(F.col("doc_id").cast("string").alias("id"), texts.hash_of(F.col("text")).alias("hash"))
    out = records.publication_units(publications(spark, sf_dir), texts=held, summaries=held.limit(0).select("id", F.lit("").alias("pseudo")), url_prefix="http://p/", tiers=TIERS)
    return out.select("id", F.col("pages").cast("long").alias("pages"), F.array_join("tags", "|").alias("tags"), "url", F.array_join("tiers", "|").alias("tiers"), "transcript", "published_day", F.array_join("issues", "; ").alias("issues"))


@query("unit_plan", """select o_orderkey::varchar id, case when o_orderkey % 5 = 0 then 'add' when o_orderkey % 3 = 0 then 'gone' when o_orderkey % 2 = 0 then 'update' else 'none' end op, case when o_orderkey % 5 <> 0 and o_orderkey % 3 = 0 then 'delete' else '' end tags,
  case when o_orderkey % 5 = 0 or (o_orderkey % 3 <> 0) then o_orderpriority || '|' || o_orderstatus else o_orderstatus || '|old' end "current" from orders where o_orderkey % 5 <> 0 or o_orderkey % 3 <> 0""")  # fmt: skip
def unit_plan(spark, sf_dir):
    """Units of orders: new ones, ones whose value or only hash changed, ones that are gone."""
    o, key = table(spark, sf_dir, "orders").where("o_orderkey % 5 <> 0 or o_orderkey % 3 <> 0"), F.col("o_orderkey")
    fresh = o.where("o_orderkey % 3 <> 0").select(key.cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.array("o_orderstatus", "o_orderpriority").alias("list"))
    fresh = fresh.withColumn("hash", cdc.record_hash(["id", "status", "list"]))
    old = o.where("o_orderkey % 5 <> 0")
    value = lambda: F.struct(F.col("o_orderstatus").alias("status"), F.when((key % 2 == 0) | (key % 3 == 0), F.array(F.lit("old"), F.col("o_orderstatus"))).otherwise(F.array("o_orderpriority", "o_orderstatus")).alias("list"))
    units = old.select(key.cast("string").alias("id"), value().alias("pushed"), value().alias("current"), F.lit("h").alias("hash"), F.array().cast("array<string>").alias("tags"))
    out = records.unit_plan(units, fresh)
    return out.select("id", "op", F.array_join("tags", "|").alias("tags"), F.array_join(F.sort_array("current.list", asc=True), "|").alias("current"))


# ---- delivery ----


class _Picky:
    """A destination that refuses some keys."""

    def __init__(self, refuses: int):
        self.refuses = refuses

    def upsert(self, key, record: str) -> None:
        if key % self.refuses == 1:
            raise OSError("refused")

    def delete(self, key) -> None:
        if key % self.refuses == 0:
            raise OSError("refused")


@query("push_loop", """with u as (select o_orderkey k, o_orderstatus cs, o_orderpriority cp, case when o_orderkey % 3 = 0 then 'Z' else o_orderstatus end ps, case when o_orderkey % 4 = 0 then '' else o_orderpriority end pp, o_orderkey % 10 = 0 tagged from orders),
s as (select *, ps <> cs or pp <> cp changed, case when tagged then k % 6 = 0 else k % 6 = 1 end refused from u),
o as (select *, case when tagged then case when refused then 'failed' else 'deleted' end when not changed then 'unchanged' when refused then 'failed' else 'pushed' end outcome from s)
select k o_orderkey, outcome, case when outcome <> 'deleted' then case when outcome = 'pushed' then cs else ps end end status, case when outcome <> 'deleted' then case when outcome = 'pushed' then cp else pp end end priority from o""")  # fmt: skip
def push_loop(spark, sf_dir):
    """One run of the push loop against a destination that refuses some calls: outcomes, and what is marked as pushed."""
    key = F.col("o_orderkey")
    pushed = F.struct(F.when(key % 3 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("status"), F.when(key % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"))
    tags = F.when(key % 10 == 0, F.array(F.lit("delete"))).otherwise(F.array().cast("array<string>"))
    units = table(spark, sf_dir, "orders").select("o_orderkey", pushed.alias("pushed"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("current"), tags.alias("tags"))
    after, report = delivery.push(units, "o_orderkey", None, _Picky(6), written, writers=4)
    return report.select("o_orderkey", "outcome").join(after.select("o_orderkey", "pushed.status", "pushed.priority"), "o_orderkey", "left")


@query("delta_with_texts", """with d as (select doc_id, trim(regexp_replace(text, '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g')) n, text, lang from documents)
select doc_id, case when text <> '' then sha256(text) end transcript, sha256(case when text <> '' and strlen(n) < 2000 and n <> '' then n when doc_id % 2 = 0 then 'short ' || doc_id end) pseudo,
  concat_ws('|', 'lang', case when text <> '' then 'transcript' end, case when (text <> '' and strlen(n) < 2000 and n <> '') or doc_id % 2 = 0 then 'pseudo_transcript' end) fields from d""".replace("\\\\", "\\"))  # fmt: skip
def delta_with_texts(spark, sf_dir):
    """Deltas in which hashes are replaced by the texts they stand for."""
    d = table(spark, sf_dir, "documents")
    units = outbox.create(d.select("doc_id", "lang", F.lit("h1").alias("transcript"), F.lit("h2").alias("pseudo_transcript")), "doc_id")
    held = d.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("short "), F.col("doc_id").cast("string"))).alias("pseudo"))
    out = outbox.resolved(outbox.delta(units, "doc_id"), held, "doc_id", full_below=2000)
    digest = lambda f: F.sha2(F.get_json_object("record", f"$.{f}").cast("binary"), 256)
    return out.select("doc_id", digest("transcript").alias("transcript"), digest("pseudo_transcript").alias("pseudo"), F.array_join("fields", "|").alias("fields"))


_TYPED = """r as (select o_orderkey, '{"status":' || case when o_orderkey % 3 = 0 then '7' else '"' || o_orderstatus || '"' end || ',"likes":' || case when o_orderkey % 4 = 0 then '"x"' else '5' end || ',"list":' || case when o_orderkey % 5 = 0 then '[1]' else '["a"]' end
  || case when o_orderkey % 7 = 0 then ',"extra":1' else '' end || case when o_orderkey % 11 = 0 then '' else '}' end rec from orders)"""


@query("unit_type_errors", f"""with {_TYPED}, ok as (select * from r where o_orderkey % 11 <> 0)
select o_orderkey, '' field, 'not a record' error from r where o_orderkey % 11 = 0 union all select o_orderkey, 'status', 'not string' from ok where o_orderkey % 3 = 0 union all select o_orderkey, 'likes', 'not bigint' from ok where o_orderkey % 4 = 0
union all select o_orderkey, 'list', 'not array<string>' from ok where o_orderkey % 5 = 0 union all select o_orderkey, 'extra', 'unknown field' from ok where o_orderkey % 7 = 0""")  # fmt: skip
def unit_type_errors(spark, sf_dir):
    key = F.col("o_orderkey")
    record = F.concat(
        F.lit('{"status":'), F.when(key % 3 == 0, "7").otherwise(F.concat(F.lit('"'), "o_orderstatus", F.lit('"'))), F.lit(',"likes":'), F.when(key % 4 == 0, '"x"').otherwise("5"), F.lit(',"list":'), F.when(key % 5 == 0, "[1]").otherwise('["a"]'),
        F.when(key % 7 == 0, ',"extra":1').otherwise(""), F.when(key % 11 == 0, "").otherwise("}"),
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", record.alias("record"))
    return outbox.type_errors(rows, "o_orderkey", "record", {"status": "string", "likes": "bigint", "list": "array<string>", "free": "boolean"})


@query("crm_push_plan", """select coalesce(o.k, r.k)::varchar id, case when o.k is null then 'delete' when r.k is null then 'insert' when o.k % 2 = 0 then 'update' else 'none' end "action", 'rec' || r.k crm_id
from (select o_orderkey k from orders where o_orderkey % 5 <> 0) o full join (select o_orderkey k from orders where o_orderkey % 3 <> 0) r on o.k = r.k""")  # fmt: skip
def crm_push_plan(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    key = F.col("k").cast("string")
    local = o.where("k % 5 <> 0").select(key.alias("id"), F.struct(key.alias("website_id")).alias("record"), F.when(F.col("k") % 2 == 0, F.array(F.lit("repush"))).otherwise(F.array().cast("array<string>")).alias("tags"))
    remote = o.where("k % 3 <> 0").select(key.alias("website_id"), F.concat(F.lit("rec"), key).alias("crm_id"))
    return delivery.crm_plan(local, remote).select("id", "action", "crm_id")


@query("subject_push", """with s as (select trim(regexp_replace(trim(n), '^DR[.]', '', 'i')) k, arg_max(l, n) l from (select case when c_custkey % 2 = 0 then 'Dr. ' else '' end || 'C' || (c_custkey // 2) n, list_sort(list_distinct([c_mktsegment])) l from customer) group by 1),
t as (select 'C' || c_custkey k, list_sort([c_mktsegment]) l from customer where c_custkey % 3 <> 0) select k guest, array_to_string(t.l, '|') prior, array_to_string(s.l, '|') as new from s join t using (k) where s.l <> t.l""")  # fmt: skip
def subject_push(spark, sf_dir):
    """Guests' subjects re-keyed by the name without prefix, against the table's: what differs."""
    c = table(spark, sf_dir, "customer")
    name = F.concat(F.when(F.col("c_custkey") % 2 == 0, "Dr. ").otherwise(""), F.lit("C"), F.floor(F.col("c_custkey") / 2).cast("string"))
    ours = enrich.plain_names(c.select(name.alias("guest"), F.array("c_mktsegment").alias("subjects"), name.alias("written")), name="guest", order="written").select("guest", "subjects")
    theirs = c.where("c_custkey % 3 <> 0").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("guest"), F.array("c_mktsegment").alias("subjects"))
    both, _ = outbox.field_delta(theirs, ours, "guest", "subjects")
    return both.select("guest", F.array_join("prior", "|").alias("prior"), F.array_join("new", "|").alias("new"))


@query("replica_orders", "(select 'by_date' replica, o_orderkey from orders order by o_orderdate desc, o_orderkey limit 50) union all (select 'by_price', o_orderkey from orders order by o_totalprice, o_orderkey limit 30)")
def replica_orders(spark, sf_dir):
    """The first pages of two named orders of an index."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    named = outbox.replicas(o, "o_orderkey", {"by_date": ("o_orderdate", False), "by_price": ("o_totalprice", True)})
    page = lambda name, n: named[name].limit(n).select(F.lit(name).alias("replica"), "o_orderkey")
    return page("by_date", 50).unionByName(page("by_price", 30))


# ---- texts ----

_PLAN_SQL = """r as (select doc_id, text from documents where doc_id % 11 <> 0), h as (select doc_id, text from documents where doc_id % 3 <> 0),
f as (select doc_id, case when doc_id % 5 = 0 then '' when doc_id % 7 = 0 then text || 'x' else text end t from documents where doc_id % 2 = 0),
p as (select coalesce(r.doc_id, h.doc_id) doc_id, case when r.doc_id is null then 'delete' when f.t <> '' and h.doc_id is null then 'add' when f.t <> '' and f.t <> h.text then 'update' when f.doc_id is not null and h.doc_id is null then 'missing' else 'none' end op
  from r full join h on r.doc_id = h.doc_id left join f on f.doc_id = r.doc_id)"""


def text_state(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records, the texts that we have, and what was fetched for the candidates."""
    d = docs(spark, sf_dir)
    had = d.where("doc_id % 3 <> 0").select("doc_id", "text", texts.hash_of(F.col("text")).alias("hash"))
    new = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    return d.where("doc_id % 11 <> 0").select("doc_id", F.col("doc_id").alias("data_created")), had, d.where("doc_id % 2 = 0").select("doc_id", new.alias("text"), F.when(F.col("doc_id") % 4 == 0, "json").otherwise("pdf").alias("source"))


@query("text_sync_ops", f"with {_PLAN_SQL} select * from p")
def text_sync_ops(spark, sf_dir):
    return texts.text_plan(*text_state(spark, sf_dir), "doc_id").select("doc_id", "op")


def _filled(spark, sf_dir) -> texts.TextStore:
    """A text store of the texts had, with counts, summaries and document counts."""
    _, had, _ = text_state(spark, sf_dir)
    s = texts.TextStore(spark, folder(spark, "texts"), counts=analytics.term_counts, buckets=4)
    none = had.limit(0)
    s.sync(texts.text_plan(had.select("doc_id", F.col("doc_id").alias("data_created")), none.select("doc_id", "hash"), had.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "json").otherwise("pdf").alias("source")), "doc_id"), now=1)
    s.update_term_counts()
    s.update_pseudo()
    s.update_doc_counts()
    return s


_STORE_SQL = f"with {_PLAN_SQL}, {COUNTS_SQL}, had as (select doc_id from h where text <> '')"


@query("derived_after_sync", f"""{_STORE_SQL}, stay as (select doc_id from had where doc_id not in (select doc_id from p where op in ('update', 'delete'))), now as (select doc_id from stay union select doc_id from p where op in ('add', 'update'))
select n.doc_id, (select count(*) from tc where tc.doc_id = n.doc_id and n.doc_id in (select doc_id from stay)) n_terms, n.doc_id in (select doc_id from stay) and n.doc_id in (select doc_id from tc) has_pseudo, case when n.doc_id in (select doc_id from p where op in ('add', 'update')) then 2 else 1 end::bigint data_updated from now n""")  # fmt: skip
def derived_after_sync(spark, sf_dir):
    """A text store after a sync: changed and deleted texts have lost what was derived from them."""
    s = _filled(spark, sf_dir)
    rows, _, fetched = text_state(spark, sf_dir)
    s.sync(texts.text_plan(rows, s.read(), fetched, "doc_id"), now=2)
    n = s.read("term_counts").groupBy("doc_id").agg(F.count("*").alias("n_terms"))
    out = texts.with_artefacts(s.read().select("doc_id", "data_updated").join(n, "doc_id", "left"), {"pseudo": s.read("pseudo")}, "doc_id")
    return out.select("doc_id", F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"), "has_pseudo", "data_updated")


@query("doc_counts_after_sync", f"""{_STORE_SQL}, stay as (select doc_id from had where doc_id not in (select doc_id from p where op in ('update', 'delete')))
select term, count(*) n_docs from tc where doc_id in (select doc_id from stay) group by term""")  # fmt: skip
def doc_counts_after_sync(spark, sf_dir):
    """Document counts follow the texts: those of changed and deleted documents are taken off."""
    s = _filled(spark, sf_dir)
    rows, _, fetched = text_state(spark, sf_dir)
    s.sync(texts.text_plan(rows, s.read(), fetched, "doc_id"), now=2)
    return s.read("doc_counts").select("term", F.col("n_docs").cast("long").alias("n_docs"))


@query("missing_artefacts", f"""{_STORE_SQL}, new as (select doc_id from p where op in ('add', 'update')) select doc_id, 'term_counts' artefact from new union all select doc_id, 'pseudo' from new
union all select doc_id, 'tfidf' from (select doc_id from had where doc_id not in (select doc_id from p where op = 'delete') union select doc_id from new)
union all select doc_id, 'term_counts' from had where doc_id not in (select doc_id from tc) and doc_id not in (select doc_id from p where op in ('update', 'delete'))
union all select doc_id, 'pseudo' from had where doc_id not in (select doc_id from tc) and doc_id not in (select doc_id from p where op in ('update', 'delete'))""")  # fmt: skip
def missing_artefacts(spark, sf_dir):
    s = _filled(spark, sf_dir)
    rows, _, fetched = text_state(spark, sf_dir)
    s.sync(texts.text_plan(rows, s.read(), fetched, "doc_id"), now=2)
    parts = [s.missing(a).withColumn("artefact", F.lit(a)) for a in texts.ARTEFACTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("cascade_delete", f"""{_STORE_SQL} select doc_id, (select count(*) from tc where tc.doc_id = had.doc_id) n_terms from had where doc_id % 2 <> 0""")
def cascade_delete(spark, sf_dir):
    """All texts of one source deleted, with their artefacts."""
    s = _filled(spark, sf_dir)
    s.delete_from("json", now=3)
    n = s.read("term_counts").groupBy("doc_id").agg(F.count("*").alias("n_terms"))
    return s.read().select("doc_id").join(n, "doc_id", "left").select("doc_id", F.coalesce("n_terms", F.lit(0)).cast("long").alias("n_terms"))


@query("stored_tfidf", f"""with {COUNTS_SQL}, n as (select count(distinct doc_id) n from tc), dc as (select term, count(*) c from tc group by term)
select doc_id, term, round("count" / sum("count") over (partition by doc_id) * ln(n.n / (dc.c + 1)), 9) tfidf from tc join dc using (term), n""")  # fmt: skip
def stored_tfidf(spark, sf_dir):
    """Counts, document counts and TF-IDF by the drivers over a text store, documents added in two runs."""
    d = docs(spark, sf_dir).where("text <> ''")
    s = texts.TextStore(spark, folder(spark, "texts"), counts=analytics.term_counts, buckets=4)
    for part in (d.where("doc_id % 2 = 0"), d):
        s.sync(texts.text_plan(part.select("doc_id", F.lit(0).alias("data_created")), s.read(), part.select("doc_id", "text", F.lit("json").alias("source")), "doc_id"), now=1)
        s.update_term_counts()
        s.update_doc_counts()
    s.update_tfidf()
    return s.read("tfidf").withColumn("tfidf", F.round("tfidf", 9))


@query("text_source", """select conv_id, case when conv_id % 3 = 0 then case when conv_id % 2 = 0 then 'pdf ' || conv_id end else w end chosen, case when conv_id % 3 <> 0 then 'json' when conv_id % 2 = 0 then 'pdf' end source,
case when conv_id % 3 = 0 then 'json:none' else 'json:read' end || case when conv_id % 2 = 0 then ' pdf:read' else ' pdf:empty' end report
from (select conv_id, string_agg(trim(text), ' ' order by turn, trim(text)) filter (trim(text) <> '') w from conversations group by conv_id)""")  # fmt: skip
def text_source(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").alias("offset"), F.trim("text").alias("word"))).alias("w"))
    rows = rows.select("conv_id", F.when(F.col("conv_id") % 3 != 0, F.col("w")).alias("words"), F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit(" pdf "), F.col("conv_id").cast("string"))).otherwise(" ").alias("pdf_text"))
    return texts.chosen_text(rows, "conv_id").select("conv_id", F.col("text").alias("chosen"), "source", "report")


@query("pdf_text", """with c as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn) r from conversations), s as (select conv_id, avg((length(text) > 30)::int) a, string_agg(text, '' order by turn, text) filter (length(text) > 30) t, string_agg(role, '' order by turn, role) u from c group by conv_id)
select conv_id, case when a > 0.9 and trim(t) <> '' then sha256(trim(t)) else sha256(trim(u)) end text_sha256, case when a > 0.9 and trim(t) <> '' then 'first' else 'second' end extractor from s""")  # fmt: skip
def pdf_text(spark, sf_dir):
    """Pages by two extractors: the first counts if it read more than nine tenths of them."""
    pages = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("page"), F.when(F.length("text") > 30, F.col("text")).alias("first"), F.col("role").alias("second"))
    return texts.pages_text(pages, "conv_id").select("conv_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), "extractor")


# ---- stores, snapshots, filters ----


def order_store(spark, sf_dir) -> store.Store:
    from .catalogue import snapshots

    old, new = (x.select("o_orderkey", "o_orderstatus", "o_totalprice") for x in snapshots(spark, sf_dir))
    s = store.Store(spark, folder(spark, "store"), "o_orderkey", ["o_orderstatus", "o_totalprice"], buckets=4)
    s.sync(old, now=1)
    s.sync(new, now=2, deletable=old.where("o_orderkey % 2 = 0"))
    return s


_OPS_SQL = """o as (select * from orders where o_orderkey % 7 <> 0), n as (select o_orderkey, case when o_orderkey % 13 = 0 then 'X' else o_orderstatus end s, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end t from orders where o_orderkey % 11 <> 0),
ops as (select coalesce(o.o_orderkey, n.o_orderkey) o_orderkey, case when o.o_orderkey is null then 'add' when n.o_orderkey is null then case when o.o_orderkey % 2 = 0 then 'delete' else 'none' end when o.o_orderstatus <> n.s or o.o_totalprice <> n.t then 'update' else 'none' end op, o.o_orderstatus os, n.s ns, o.o_totalprice ot, n.t nt from o full join n using (o_orderkey))"""


@query("store_sync", f"with {_OPS_SQL} select o_orderkey, coalesce(ns, os) o_orderstatus, round(coalesce(nt, ot), 2) o_totalprice, case when op = 'add' then 2 else 1 end::bigint data_created, case when op = 'none' then 1 else 2 end::bigint data_updated from ops where op <> 'delete'")
def store_sync(spark, sf_dir):
    """A store after two runs, the second of which may delete some of the lost records only."""
    return order_store(spark, sf_dir).read().select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice"), "data_created", "data_updated")


@query("store_log", f"with {_OPS_SQL} select o_orderkey, 'o_orderstatus' field, os prior, ns as new from ops where op = 'update' and os <> ns union all select o_orderkey, 'o_totalprice', null, null from ops where op = 'update' and ot <> nt union all select o_orderkey, 'tombstone', os, null from ops where op = 'delete'")
def store_log(spark, sf_dir):
    """The store's change log and tombstones; prices only as having changed."""
    s = order_store(spark, sf_dir)
    plain = lambda c: F.when(F.col("field") == "o_orderstatus", F.col(c)).alias(c)
    gone = s.table("tombstones").select("o_orderkey", F.lit("tombstone").alias("field"), F.col("old.o_orderstatus").alias("prior"), F.lit(None).cast("string").alias("new"))
    return s.table("changes").select("o_orderkey", "field", plain("prior"), plain("new")).unionByName(gone)


@query("apply_deletable", f"with {_OPS_SQL} select o_orderkey, round(coalesce(nt, ot), 2) o_totalprice from ops where op <> 'delete'")
def apply_deletable(spark, sf_dir):
    """The snapshot after operations of which some deletes are not allowed."""
    from .catalogue import operations

    may = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select("o_orderkey")
    out = cdc.apply(operations(spark, sf_dir), "o_orderkey", now=NOW, columns=["o_orderkey", "o_totalprice"], deletable=may)
    return out.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))


@query("delete_tagged", "select o_orderkey, case when o_orderkey % 4 = 0 then 'gone' else 'kept' end state from orders where o_orderkey % 3 <> 0")
def delete_tagged(spark, sf_dir):
    s = store.Store(spark, folder(spark, "store"), "o_orderkey", ["o_orderstatus"], buckets=4)
    s.sync(table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus"), now=1)
    s.retag(lambda t: store.tag_add(t, "out"), s.read().where("o_orderkey % 4 = 0"))
    s.delete_tagged("out", now=2)
    return s.read().select("o_orderkey", F.lit("kept").alias("state")).unionByName(s.table("tombstones").select("o_orderkey", F.lit("gone").alias("state")))


@query("stored_columns", "select o_orderkey, 5::bigint data_created, 7::bigint data_updated, 'h' || o_orderkey hash from orders where o_orderkey % 50 = 1")
def stored_columns(spark, sf_dir):
    """Fetches of single columns by id, after hashes were set."""
    s = store.Store(spark, folder(spark, "store"), "o_orderkey", ["o_orderstatus", "at"], created="at", buckets=4)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.lit(5).alias("at"))
    s.sync(rows, now=7)
    s.set_hash(rows.select("o_orderkey", F.concat(F.lit("h"), F.col("o_orderkey").cast("string")).alias("hash")))
    return s.entries(rows.where("o_orderkey % 50 = 1"), "data_created", "data_updated", "hash")


@query("date_range", f"select event_id from events where epoch_us(ts) // 1000 > (select min(epoch_us(ts) // 1000) + 86400000 from events) and epoch_us(ts) // 1000 < (select max(epoch_us(ts) // 1000) - 86400000 from events) and event_type <> 'click'")
def date_range(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    e = e.withColumn("tags", F.when(F.col("event_type") == "click", F.array().cast("array<string>")).otherwise(F.array("event_type")))
    low, high = e.agg(F.min("ms"), F.max("ms")).first()  # one row
    return store.with_tags(store.between(e, "ms", low + 86_400_000, high - 86_400_000)).select("event_id")


@query("crm_snapshot", "select c_mktsegment \"key\", min(c_custkey)::varchar first_id, arg_min(c_name, c_custkey) as name from customer where c_custkey % 9 <> 0 group by c_mktsegment")
def crm_snapshot(spark, sf_dir):
    """Raw rows of a remote table re-keyed: the first of each key stays, rows without the key go."""
    quoted = lambda c: F.concat(F.lit('" '), c, F.lit(' "'))
    given = F.when(F.col("c_custkey") % 9 != 0, F.create_map(F.lit("Segment"), quoted(F.col("c_mktsegment")), F.lit("Name"), quoted(F.col("c_name")))).otherwise(F.create_map(F.lit("Name"), quoted(F.col("c_name"))))
    raw = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("position"), F.col("c_custkey").cast("string").alias("id"), given.alias("fields"))
    return pull.rekeyed(raw, "Segment", ["id", "Name"]).select("key", F.col("id").alias("first_id"), F.col("Name").alias("name"))


@query("paging_update", "select event_type product, case when event_type < 'm' then 10 else 24 end::bigint base_multiple, count(*) max_multiple from events group by event_type")
def paging_update(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("product")).agg(F.count("*").alias("max_multiple"))
    old = n.select("product", F.lit(24).cast("long").alias("base_multiple"), F.when(F.col("product") < "m", 0).otherwise(F.col("max_multiple")).cast("long").alias("max_multiple"))
    fresh = n.where("product < 'm'").select("product", F.lit(10).cast("long").alias("base_multiple"), "max_multiple")
    return pull.updated_paging(old, fresh)


_ITEM = "'{\"id\":\"' || o_orderkey || '\",\"type\":\"v\",\"attributes\":{\"video_title\":' || case when o_orderkey % 3 = 0 then 'null' else '\"T' || o_orderkey || '\"' end || ',\"video_likes_count\":' || (o_orderkey % 7) || '}}'"


@query("video_records", "select o_orderkey::varchar id, case when o_orderkey % 3 = 0 then '' else 'T' || o_orderkey end title, (o_orderkey % 7)::bigint likes, 0::bigint dislikes, '' featuring, 0::bigint n_topics, false is_free from orders")
def video_records(spark, sf_dir):
    """Nested items with missing parts as typed records with defaults."""
    key = F.col("o_orderkey")
    title = F.when(key % 3 == 0, "null").otherwise(F.concat(F.lit('"T'), key, F.lit('"')))
    item = F.concat(F.lit('{"id":"'), key, F.lit('","type":"v","attributes":{"video_title":'), title, F.lit(',"video_likes_count":'), key % 7, F.lit("}}"))
    one = files.VIDEO.removeprefix("data array<").removesuffix(">")
    items = table(spark, sf_dir, "orders").select(F.from_json(item, one).alias("i")).select("i.*")
    return files.project(items, files.VIDEO_FIELDS).select("id", "title", "likes", "dislikes", "featuring", F.size("topics").cast("long").alias("n_topics"), "is_free")


@query("publication_records", "select o_orderkey::varchar id, 'P' || o_orderkey title, (o_orderkey % 40)::bigint pages, 0::bigint likes, '' summary, false is_published from orders")
def publication_records(spark, sf_dir):
    key = F.col("o_orderkey")
    item = F.concat(F.lit('{"id":"'), key, F.lit('","attributes":{"issue_title":"P'), key, F.lit('","issue_page_count":'), key % 40, F.lit("}}"))
    one = files.PUBLICATION.removeprefix("data array<").removesuffix(">")
    items = table(spark, sf_dir, "orders").select(F.from_json(item, one).alias("i")).select("i.*")
    return files.project(items, files.PUBLICATION_FIELDS).select("id", "title", "pages", "likes", "summary", "is_published")


@query("all_or_nothing", "select c_custkey, case when c_nationkey % 2 = 0 then '' else c_name end kept from customer")
def all_or_nothing(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    missing = F.when(F.col("c_nationkey") % 2 == 0, F.array("c_name")).otherwise(F.array().cast("array<string>"))
    return c.select("c_custkey", F.array_join(enrich.all_or_nothing(F.array("c_name"), missing), "|").alias("kept"))


@query("consistency", "select c_custkey, case when c_custkey % 3 = 0 then 'no payload' else 'not in index' end problem from customer where (c_custkey % 3 = 0) <> (c_custkey % 5 = 0)")
def consistency(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return checks.consistent(c.where("c_custkey % 5 <> 0"), c.where("c_custkey % 3 <> 0"), "c_custkey")


@query("lost_with_details", "select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 9 = 0)")
def lost_with_details(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return cdc.lost_with(c, table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", c.select("c_custkey", "c_name"))


@query("multi_source_field", "select o_orderkey, array_to_string(list_sort(list_distinct([o_orderstatus, 'z', o_orderpriority, 'z'])), '|') several, array_to_string([o_orderstatus, 'z', 'z'], '|') single, (o_orderkey % 30)::varchar tail, strftime(o_orderdate, '%Y-%m-%d') as day from orders")
def multi_source_field(spark, sf_dir):
    a, b = F.array(F.col("o_orderstatus"), F.lit("z")), F.array("o_orderpriority", F.lit("z"))
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.array_join(records.field_of("array<string>", a, b), "|").alias("several"), F.array_join(records.field_of("array<string>", F.array(F.col("o_orderstatus"), F.lit("z"), F.lit("z"))), "|").alias("single"),
        records.field_of("string", F.concat(F.lit("http://s/"), F.col("o_orderkey") % 30), tail=True).alias("tail"), records.field_of("bigint", ms, day=True).alias("day"),
    )


@query("incremental_doc_counts", f"with {COUNTS_SQL} select term, count(*) n_docs from tc group by term")
def incremental_doc_counts(spark, sf_dir):
    """Document counts of half the documents, brought up to date with the rest."""
    counts = analytics.term_counts(docs(spark, sf_dir))
    seen = counts.where("doc_id % 2 = 0")
    grown, _ = analytics.add_documents(analytics.document_counts(seen), 0, counts, seen.select("doc_id").distinct())
    return grown


@query("sorted_map_keys", "select c_custkey, array_to_string(list_sort([c_mktsegment, 'b' || c_nationkey, 'a']), '|') keys from customer")
def sorted_map_keys(spark, sf_dir):
    from ..functions import text as T

    m = F.create_map(F.col("c_mktsegment"), F.lit(1), F.concat(F.lit("b"), F.col("c_nationkey").cast("string")), F.lit(2), F.lit("a"), F.lit(3))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(T.sorted_keys(m), "|").alias("keys"))
