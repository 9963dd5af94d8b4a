"""Every query of the library by name, with the SQL it is compared with.

The tables stand in for the library's own inputs: documents for texts, orders and customer for keyed records, nation and region for
dimensions, conversations for word streams, events for comments and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import people as P
from ..functions import text as T
from ..operators import analytics, cdc, checks, enrich, outbox, store
from .scratch import written

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
NOW = 1_700_000_000_000


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)


TOKENS_SQL = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"
_CUT_SQL = "case " + " ".join(f"when contains(term, {quoted([c])}) then replace(term, {quoted([c])}, '')" for c in reversed(T.CUTS)) + " else term end"
_YEAR_SQL = rf"(regexp_matches(term, '{T.WHOLE}') and length(term) <= 18 and try_cast(replace(trim(term), '_', '') as bigint) between 1700 and 2100)"
CLEAN_SQL = f"trim(case when contains(term, 'www.') or (regexp_matches(term, '{T.NUMBER}') and not coalesce({_YEAR_SQL}, false)) or length(term) = 1 then '' else {_CUT_SQL} end)"
COUNTS_SQL = f"tc as (select doc_id, term, count(*) as \"count\" from (select doc_id, unnest({TOKENS_SQL}) term from documents) group by all)"
TFIDF_SQL = f"""{COUNTS_SQL}, n as (select count(distinct doc_id) n from tc), dc as (select term, count(*) c from tc group by term),
w as (select doc_id, term, "count" / sum("count") over (partition by doc_id) * ln(n.n / (dc.c + 1)) tfidf from tc join dc using (term), n)"""


# ---- text analytics ----


@query("term_count", f"with {COUNTS_SQL} select * from tc")
def term_count(spark, sf_dir):
    return analytics.term_counts(docs(spark, sf_dir))


@query("term_count_clean", f"""with {COUNTS_SQL}, c as (select doc_id, {CLEAN_SQL} t, "count" from tc where term not in ({quoted(T.STOP_WORDS)}))
select doc_id, t term, max("count") as "count" from c where t <> '' group by all""")  # fmt: skip
def term_count_clean(spark, sf_dir):
    return analytics.term_counts(docs(spark, sf_dir), stop_words=True, clean=True)


def _runs_sql(text: str) -> str:
    """Runs of two or three words between stop words and other marks, with their counts, as a subquery."""
    return rf"""(select doc_id, term, count(*) "count" from (select doc_id, grp, string_agg(tok, ' ' order by pos) term from (
  select *, sum(brk::int) over (partition by doc_id order by pos) grp from (select doc_id, pos, tok, tok in ({quoted(T.STOP_WORDS)}) or not regexp_matches(tok, '^[\p{{L}}\p{{N}}'']') brk
    from (select doc_id, unnest(l) tok, unnest(range(len(l))) pos from (select doc_id, regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}'']+|[^\p{{L}}\p{{N}}'' ]+') l from documents)))) where not brk
  group by doc_id, grp having count(*) between 2 and 3) group by doc_id, term)"""


BARE_TEXT = "replace(text, chr(39), '')"


@query("term_count_phrases", f"""with {COUNTS_SQL}, raw as (select * from {_runs_sql("text")} union all select * from {_runs_sql(BARE_TEXT)} union all select * from tc where term not in ({quoted(T.STOP_WORDS)})),
c as (select doc_id, {CLEAN_SQL} t, "count" from raw) select doc_id, t term, max("count") as "count" from c where t <> '' group by all""")  # fmt: skip
def term_count_phrases(spark, sf_dir):
    return analytics.full_counts(docs(spark, sf_dir))


@query("doc_count", f"with {COUNTS_SQL} select term, count(*) n_docs from tc group by term")
def doc_count(spark, sf_dir):
    return analytics.document_counts(analytics.term_counts(docs(spark, sf_dir)))


@query("idf", f"with {COUNTS_SQL}, n as (select count(distinct doc_id) n from tc) select term, count(*) n_docs, round(ln(any_value(n.n) / (count(*) + 1)), 9) idf from tc, n group by term")
def idf(spark, sf_dir):
    counts = analytics.term_counts(docs(spark, sf_dir))
    return analytics.idf(analytics.document_counts(counts), counts).withColumn("idf", F.round("idf", 9))


@query("tfidf", f"with {TFIDF_SQL} select doc_id, term, round(tfidf, 9) tfidf from w")
def tfidf(spark, sf_dir):
    return analytics.tfidf(written(analytics.term_counts(docs(spark, sf_dir), total=True), "counts")).withColumn("tfidf", F.round("tfidf", 9))


@query("tfidf_top5_per_doc", f"with {TFIDF_SQL}, r as (select doc_id, term, round(tfidf, 9) tfidf, row_number() over (partition by doc_id order by round(tfidf, 9) desc, term)::int rank from w) select * from r where rank <= 5")
def tfidf_top5(spark, sf_dir):
    return analytics.top_terms(analytics.tfidf(written(analytics.term_counts(docs(spark, sf_dir), total=True), "counts")), 5).select("doc_id", "term", F.round("tfidf", 9).alias("tfidf"), "rank")


@query("pseudo_text", f"""with {COUNTS_SQL} select d.doc_id, sha256(coalesce(p, '')) pseudo_sha256, p is null no_terms
from (select distinct doc_id from tc) d left join (select doc_id, string_agg(repeat(term || chr(10), ceil("count" / 3)::int), '' order by "count" desc, term) p from tc where "count" > 2 group by doc_id) using (doc_id)""")  # fmt: skip
def pseudo_text(spark, sf_dir):
    out = analytics.pseudo_text_of(docs(spark, sf_dir), limit=None)
    return out.select("doc_id", F.sha2(F.coalesce("pseudo", F.lit("")).cast("binary"), 256).alias("pseudo_sha256"), F.col("issue").isNotNull().alias("no_terms"))


@query("pseudo_text_capped", f"""with recursive {COUNTS_SQL}, f as (select doc_id, term, "count" c, ceil("count" / 3)::bigint n from tc where "count" > 2),
small as (select doc_id from (select distinct doc_id from tc) left join f using (doc_id) group by doc_id having coalesce(sum(n * (strlen(term) + 1)), 0) <= 400),
st as (select doc_id, term, "count" c, "count"::bigint n, 0 step from tc where doc_id not in (select doc_id from small)
  union all select doc_id, term, c, ceil(n / low)::bigint, step + 1 from (select *, min(case when n > 1 then n end) over (partition by doc_id) low, sum(n * (strlen(term) + 1)) over (partition by doc_id) sz from st) where n > 1 and (step = 0 or sz > 400)),
fin as (select doc_id, term, c, n from (select *, sum(n * (strlen(term) + 1)) over (partition by doc_id, step) sz from st where step > 0) where sz <= 400 union all select doc_id, term, c, n from f where doc_id in (select doc_id from small))
select d.doc_id, p pseudo, case when p is null then 'no terms left' end issue from (select distinct doc_id from tc) d
left join (select doc_id, string_agg(repeat(term || chr(10), n::int), '' order by c desc, term) p from fin group by doc_id) using (doc_id)""")  # fmt: skip
def pseudo_text_capped(spark, sf_dir):
    return analytics.pseudo_text_of(docs(spark, sf_dir), limit=400)


@query("text_switch", r"""with n as (select doc_id, trim(regexp_replace(text, '[ \t\n\x0b\f\r]+', ' ', 'g')) t from documents)
select doc_id, case when strlen(t) < 3000 then sha256(t) else 'short' end chosen, strlen(t)::bigint bytes from n""")  # fmt: skip
def text_switch(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.sha2(T.fit_or_short(F.col("text"), F.lit(None).cast("string"), 3000).cast("binary"), 256).alias("chosen"), T.utf8_size(T.normal_space(F.col("text"))).alias("bytes")).withColumn("chosen", F.coalesce("chosen", F.lit("short")))


PHRASE = "the"
_HITS_SQL = f"""s as (select doc_id, string_split(lower(text), '{PHRASE}') a from documents),
h as (select doc_id, a, unnest(range(1, len(a))) k from s),
hits as (select doc_id, (k - 1)::int pos, right(a[k], 25) || '{PHRASE}' || left(array_to_string(a[k + 1:], '{PHRASE}'), 25) snippet from h)"""


@query("phrase_snippets", f"with {_HITS_SQL} select * from hits")
def phrase_snippets(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.posexplode(T.snippets(F.col("text"), PHRASE)).alias("pos", "snippet"))


@query("phrase_report", f"""with {_HITS_SQL} select l.doc_id, l.quality, case when d.doc_id is null then 'no text' when h.pos is null then 'not found' else 'found' end outcome, h.pos, h.snippet
from labels l left join (select doc_id from documents) d using (doc_id) left join hits h on h.doc_id = d.doc_id""")  # fmt: skip
def phrase_report(spark, sf_dir):
    return analytics.phrase_report(table(spark, sf_dir, "labels").select("doc_id", "quality"), docs(spark, sf_dir), PHRASE)


@query("sorted_char_hash", "select doc_id, sha256(array_to_string(list_sort(string_split(text, '')), '')) hash from documents")
def sorted_char_hash(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.sorted_char_hash(F.col("text")).alias("hash"))


@query("word_stream_text", "select conv_id, string_agg(trim(text), ' ' order by turn, trim(text)) filter (trim(text) <> '') text from conversations group by conv_id")
def word_stream_text(spark, sf_dir):
    words = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct(F.col("turn").alias("offset"), F.trim("text").alias("word"))).alias("w"))
    return words.select("conv_id", T.word_stream(F.col("w")).alias("text"))


@query("year_number_filter", f"with t as (select distinct unnest({TOKENS_SQL}) term from documents) select term, regexp_matches(term, '{T.NUMBER}') is_number, coalesce({_YEAR_SQL}, false) is_year, {CLEAN_SQL} cleaned from t")
def year_number_filter(spark, sf_dir):
    terms = docs(spark, sf_dir).select(F.explode(T.tokens(F.col("text"))).alias("term")).distinct()
    return terms.select("term", T.is_number(F.col("term")).alias("is_number"), T.might_be_year(F.col("term")).alias("is_year"), T.clean_term(F.col("term")).alias("cleaned"))


@query("url_tail", "select page_id, list_last(string_split(url, '/')) tail from pages")
def url_tail(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.url_tail(F.col("url")).alias("tail"))


@query("epoch_ms_date", "select event_id, epoch_us(ts) // 1000 ms, strftime(ts, '%Y-%m-%d') as day from events")
def epoch_ms_date(spark, sf_dir):
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", ms.alias("ms"), T.day_of_ms(ms).alias("day"))


# ---- people ----

_PEOPLE_SQL = "p as (select r_regionkey, string_agg(n_name, ', ' order by n_name) || ', Jr. and DR. ' || r_name people from region join nation on n_regionkey = r_regionkey group by r_regionkey, r_name)"


def people(spark, sf_dir):
    both = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = both.groupBy("r_regionkey", "r_name").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    return names.select("r_regionkey", F.concat(F.array_join("names", ", "), F.lit(", Jr. and DR. "), "r_name").alias("people"))


_SPLIT_SQL = "list_transform(string_split(replace(replace(people, ' and ', ','), ', Jr.,', '--JRS--,'), ','), lambda x: trim(replace(trim(x), '--JRS--', ' Jr.')))"


@query("people_split", f"with {_PEOPLE_SQL} select r_regionkey, array_to_string({_SPLIT_SQL}, '|') people from p")
def people_split(spark, sf_dir):
    return people(spark, sf_dir).select("r_regionkey", F.array_join(P.split_people(F.col("people")), "|").alias("people"))


@query("distinct_people", f"with {_PEOPLE_SQL} select distinct unnest({_SPLIT_SQL}) person from p")
def distinct_people(spark, sf_dir):
    return people(spark, sf_dir).select(F.explode(P.distinct_people(P.split_people(F.col("people")))).alias("person")).distinct()


@query("people_tokens", """with w as (select c_custkey, string_split(lower(replace(c_name, '#', ' ')) || ' ' || lower(c_mktsegment), ' ') w from customer)
select c_custkey, array_to_string(list_sort(list_distinct(list_append(list_transform(range(1, len(w) + 1), lambda k: array_to_string(w[1:k], ' ')), w[len(w)]))), '|') tokens from w""")  # fmt: skip
def people_tokens(spark, sf_dir):
    name = F.concat_ws(" ", F.replace("c_name", F.lit("#"), F.lit(" ")), "c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(P.name_tokens(F.array(name)), "|").alias("tokens"))


@query("prefix_strip", rf"""select n_nationkey, prefix, trim(regexp_replace(trim(prefix || n_name), '^(?:{"|".join(p.replace(".", "[.]").replace("(", "[(]").replace(")", "[)]") for p in P.PREFIXES)})', '', 'i')) name
from nation, (values ('Dr. '), ('professor '), ('Brig. General (Ret) '), ('Mayor'), (' Ms '), ('')) v(prefix)""")  # fmt: skip
def prefix_strip(spark, sf_dir):
    prefixes = F.explode(F.array(*map(F.lit, ("Dr. ", "professor ", "Brig. General (Ret) ", "Mayor", " Ms ", "")))).alias("prefix")
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", prefixes).select("n_nationkey", "prefix", P.strip_prefix(F.concat("prefix", "n_name")).alias("name"))


@query("unknown_people", "select distinct n_name person from nation where n_name not in (select n_name from nation where n_regionkey < 2)")
def unknown_people(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    rows = n.select(F.array(F.concat(F.lit("Dr. "), "n_name")).alias("featuring"), F.array(F.col("n_name"), F.lit("")).alias("interviewer"))
    return enrich.unknown_people(rows, n.where("n_regionkey < 2"), people=["featuring", "interviewer"], name="n_name")


@query("guest_subjects", """with g as (select o_orderkey, 'G' || (o_custkey % 50) guest, [o_orderstatus, o_orderpriority, 'G' || (o_custkey % 7)] s from orders),
e as (select distinct guest, unnest(s) subject from g)
select a.guest, array_to_string(coalesce(list(subject order by subject) filter (subject not in (select guest from g)), []), '|') subjects from e a group by a.guest""")  # fmt: skip
def guest_subjects(spark, sf_dir):
    guest = F.concat(F.lit("G"), F.col("o_custkey") % 50)
    rows = table(spark, sf_dir, "orders").select(F.array(guest).alias("guests"), F.array("o_orderstatus", "o_orderpriority").alias("topics"), F.array(F.concat(F.lit("G"), F.col("o_custkey") % 7)).alias("tags"))
    out = enrich.guest_subjects(rows, people_col="guests", subject_cols=["topics", "tags"])
    return out.select("guest", F.array_join("subjects", "|").alias("subjects"))


@query("people_lookup", """select o_orderkey, 'N' || (o_custkey % 30) person, n_nationkey found, n_nationkey is null missing from orders left join nation on o_custkey % 30 = n_nationkey""")
def people_lookup(spark, sf_dir):
    dim = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("name"), "n_nationkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.array(F.concat(F.lit("N"), F.col("o_custkey") % 30)).alias("people"))
    out = enrich.people_to_field(rows, dim, id_col="o_orderkey", people_col="people", name="name", value="n_nationkey")
    return out.join(rows, "o_orderkey").select("o_orderkey", F.get("people", 0).alias("person"), F.get("found", 0).alias("found"), (F.size("missing") > 0).alias("missing"))


# ---- change capture and store ----

_SNAP_SQL = """o as (select o_orderkey, o_orderstatus, o_totalprice, [o_orderstatus, o_orderpriority] tags from orders where o_orderkey % 7 <> 0),
n as (select o_orderkey, case when o_orderkey % 13 = 0 then 'X' else o_orderstatus end o_orderstatus, case when o_orderkey % 5 = 0 then o_totalprice + 1 else o_totalprice end o_totalprice,
  case when o_orderkey % 17 = 0 then [o_orderpriority] else [o_orderpriority, o_orderstatus] end tags from orders where o_orderkey % 11 <> 0),
ops as (select coalesce(o.o_orderkey, n.o_orderkey) o_orderkey, case when o.o_orderkey is null then 'add' when n.o_orderkey is null then 'delete'
  when o.o_orderstatus <> n.o_orderstatus or o.o_totalprice <> n.o_totalprice or list_sort(list_distinct(o.tags)) <> list_sort(list_distinct(n.tags)) then 'update' else 'none' end op,
  o.o_orderstatus os, n.o_orderstatus ns, o.o_totalprice ot, n.o_totalprice nt, o.tags otags, n.tags ntags from o full join n on o.o_orderkey = n.o_orderkey)"""


def snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    r = table(spark, sf_dir, "orders")
    old = r.where("o_orderkey % 7 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice", F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    new = r.where("o_orderkey % 11 <> 0").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 13 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 17 == 0, F.array("o_orderpriority")).otherwise(F.array("o_orderpriority", "o_orderstatus")).alias("tags"),
    )
    return old, new


def operations(spark, sf_dir) -> DataFrame:
    return cdc.plan(*snapshots(spark, sf_dir), "o_orderkey")


@query("cdc_ops", f"with {_SNAP_SQL} select o_orderkey, op from ops")
def cdc_ops(spark, sf_dir):
    return operations(spark, sf_dir).select("o_orderkey", "op")


@query("cdc_counters", f"with {_SNAP_SQL} select op, count(*) n from ops group by op")
def cdc_counters(spark, sf_dir):
    return cdc.counters(operations(spark, sf_dir))


@query("cdc_field_diff", f"""with {_SNAP_SQL}, u as (select * from ops where op = 'update')
select o_orderkey, 'o_orderstatus' field, os prior, ns as new, null::varchar added, null::varchar removed from u where os <> ns
union all select o_orderkey, 'o_totalprice', round(ot, 2)::varchar, round(nt, 2)::varchar, null, null from u where ot <> nt
union all select o_orderkey, 'tags', null, null, array_to_string(list_sort(list_filter(ntags, lambda x: not list_contains(otags, x))), '|'), array_to_string(list_sort(list_filter(otags, lambda x: not list_contains(ntags, x))), '|')
  from u where list_sort(list_distinct(otags)) <> list_sort(list_distinct(ntags))""")  # fmt: skip
def cdc_field_diff(spark, sf_dir):
    out = cdc.field_changes(operations(spark, sf_dir), "o_orderkey", [("o_orderstatus", "string"), ("o_totalprice", "double"), ("tags", "array<string>")])
    number = lambda c: F.when(F.col("field") == "o_totalprice", F.round(F.col(c).try_cast("double"), 2).cast("string")).otherwise(F.col(c)).alias(c)
    return out.select("o_orderkey", "field", number("prior"), number("new"), "added", "removed")


@query("store_after_cdc", f"with {_SNAP_SQL} select o_orderkey, case when op = 'none' then os else ns end o_orderstatus, round(case when op = 'none' then ot else nt end, 2) o_totalprice, case when op <> 'none' then {NOW} end data_updated from ops where op <> 'delete'")
def store_after_cdc(spark, sf_dir):
    out = cdc.apply(operations(spark, sf_dir), "o_orderkey", now=NOW, columns=["o_orderkey", "o_orderstatus", "o_totalprice"])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 2))


@query("tombstones", f"with {_SNAP_SQL} select o_orderkey, (1 + (o_orderkey % 3 = 0)::int)::bigint n, os o_orderstatus from ops where op = 'delete'")
def tombstones(spark, sf_dir):
    earlier = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select("o_orderkey")
    out = store.tombstones(operations(spark, sf_dir), earlier, "o_orderkey")
    return out.select("o_orderkey", "n", F.col("old")["o_orderstatus"].alias("o_orderstatus"))


@query("deletion_gate", f"with {_SNAP_SQL}, l as (select o_orderkey from ops where op = 'delete') select o_orderkey, 'high' gate from l where (select count(*) from l) <= 100000000 union all select o_orderkey, 'low' from l where (select count(*) from l) <= 3")
def deletion_gate(spark, sf_dir):
    old, new = snapshots(spark, sf_dir)
    lost = cdc.missing(old, new, "o_orderkey")
    return cdc.tolerated(lost, 100_000_000).withColumn("gate", F.lit("high")).unionByName(cdc.tolerated(lost, 3).withColumn("gate", F.lit("low")))


@query("upsert_stats", f"with {_SNAP_SQL} select n.o_orderkey, n.o_orderstatus from n left join o using (o_orderkey) where o.o_orderkey is null or o.o_orderstatus <> n.o_orderstatus")
def upsert_stats(spark, sf_dir):
    old, new = (x.select("o_orderkey", "o_orderstatus") for x in snapshots(spark, sf_dir))
    return cdc.upsert_if_changed(old, new, "o_orderkey")


@query("anti_join", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderkey % 9 = 0)")
def anti_join(spark, sf_dir):
    return cdc.missing(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("semi_join", "select c_custkey from customer where c_custkey in (select o_custkey from orders where o_orderkey % 9 = 0)")
def semi_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 9 = 0").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(orders, "c_custkey", "left_semi")


@query("first_wins", "select user_id, event_id, event_type from events qualify row_number() over (partition by user_id order by ts, event_id) = 1")
def first_wins(spark, sf_dir):
    return store.first_of(table(spark, sf_dir, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query("latest_version", "select user_id, event_id, round(value, 6) as value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def latest_version(spark, sf_dir):
    return store.last_of(table(spark, sf_dir, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", F.round("value", 6).alias("value"))


@query("top_n_recent", "select event_id, user_id from events order by ts desc, event_id limit 25")
def top_n_recent(spark, sf_dir):
    return store.newest(table(spark, sf_dir, "events"), 25, F.desc("ts"), "event_id").select("event_id", "user_id")


@query("recent_filter", "select event_id from events where ts > (select max(ts) from events) - interval 14 day")
def recent_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    last = e.agg(F.max("ts").alias("last"))  # one row
    return e.join(F.broadcast(last), F.col("ts") > F.col("last") - F.expr("interval 14 days")).select("event_id")


@query("tag_ops", """with t as (select o_orderkey, [o_orderstatus, o_orderpriority] tags from orders)
select o_orderkey, array_to_string(case when list_contains(tags, 'new') then tags else list_append(tags, 'new') end, '|') added, array_to_string(list_filter(tags, lambda x: x <> 'F'), '|') removed,
array_to_string(case when list_contains(tags, 'O') then list_append(list_filter(tags, lambda x: x <> 'O'), 'open') else tags end, '|') replaced, list_contains(tags, 'P') tagged from t""")  # fmt: skip
def tag_ops(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    text = lambda c, n: F.array_join(c, "|").alias(n)
    return t.select("o_orderkey", text(store.tag_add(F.col("tags"), "new"), "added"), text(store.tag_remove(F.col("tags"), "F"), "removed"), text(store.tag_replace(F.col("tags"), "O", "open"), "replaced"), F.array_contains("tags", "P").alias("tagged"))


@query("list_delta", """with l as (select o_orderkey, [o_orderstatus, o_orderpriority, 'a'] a, ['a', o_orderpriority, case when o_orderkey % 2 = 0 then 'F' else 'b' end] b from orders)
select o_orderkey, array_to_string(list_sort(list_distinct(list_filter(a, lambda e: not list_contains(b, e)))), '|') in1not2, array_to_string(list_sort(list_distinct(list_filter(b, lambda e: not list_contains(a, e)))), '|') in2not1 from l""")  # fmt: skip
def list_delta(spark, sf_dir):
    a = F.array("o_orderstatus", "o_orderpriority", F.lit("a"))
    b = F.array(F.lit("a"), F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 2 == 0, "F").otherwise("b"))
    d = table(spark, sf_dir, "orders").select("o_orderkey", outbox.list_delta(a, b).alias("d"))
    return d.select("o_orderkey", F.array_join("d.in1not2", "|").alias("in1not2"), F.array_join("d.in2not1", "|").alias("in2not1"))


# ---- enrichment ----


@query("lookup_denorm", """select c_custkey, n_name nation, r_name region, case c_mktsegment when 'BUILDING' then 'PRO' when 'MACHINERY' then 'PLUS|PRO' else '' end tiers,
case when n_nationkey is null then 'unknown nation: ' || (c_nationkey) else '' end issues from customer left join nation on c_nationkey = n_nationkey and n_nationkey < 20 left join region on n_regionkey = r_regionkey""")  # fmt: skip
def lookup_denorm(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").where("n_nationkey < 20").select("n_nationkey", F.struct("n_name", "n_regionkey").alias("n"))
    rows = enrich.lookup(table(spark, sf_dir, "customer"), nation, on="c_nationkey", key="n_nationkey", value="n", name="n", issue="unknown nation")
    rows = enrich.lookup(rows.withColumn("rk", F.col("n.n_regionkey")), table(spark, sf_dir, "region"), on="rk", key="r_regionkey", value="r_name", name="region", issue="unknown region")
    tiers = enrich.tiers(F.col("c_mktsegment"), {"BUILDING": ["PRO"], "MACHINERY": ["PLUS", "PRO"]})
    return rows.select("c_custkey", F.col("n.n_name").alias("nation"), "region", F.coalesce(F.array_join(tiers, "|"), F.lit("")).alias("tiers"), F.array_join("issues", "|").alias("issues"))


@query("comment_stats", "select user_id, count(*) n_comments, count(*) filter (event_type = 'click') n_replies, sum(coalesce(json_extract(props, '$.k')::bigint, 0))::bigint likes, sum(floor(value))::bigint dislikes from events group by user_id")
def comment_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", F.get_json_object("props", "$.k").cast("long").alias("likes"), F.floor("value").alias("dislikes"), F.when(F.col("event_type") == "click", "x").otherwise("").alias("reply_to"))
    return enrich.comment_stats(rows, "user_id")


@query("tags_union", "select o_orderkey, array_to_string(list_sort(list_distinct([o_orderpriority, 'x', o_orderstatus, o_orderstatus])), '|') tags from orders")
def tags_union(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(enrich.joined_list(F.array("o_orderpriority", F.lit("x")), F.array("o_orderstatus", "o_orderstatus")), "|").alias("tags"))


@query("tags_union_all", "select o_orderkey, array_to_string([o_orderpriority, 'x', o_orderstatus, o_orderstatus], '|') tags from orders")
def tags_union_all(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(enrich.joined_list(F.array("o_orderpriority", F.lit("x")), F.array("o_orderstatus", "o_orderstatus"), distinct=False), "|").alias("tags"))


@query("refresh_actions", "select c_custkey, case when c_custkey % 4 = 0 then 'add' when c_custkey % 5 < 2 or c_mktsegment = 'BUILDING' then 'update' else 'none' end as \"action\" from customer")
def refresh_actions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    rows = c.select("c_custkey", (F.lit(10) - F.col("c_custkey") % 5).alias("data_updated"), F.array("c_mktsegment").alias("tags"))
    target = c.where("c_custkey % 4 <> 0").select("c_custkey", F.lit(8).alias("data_updated"), F.array(F.lit("ok")).alias("tags"))
    return enrich.needs_refresh(rows, target, "c_custkey", consumed=("BUILDING",), issue_tag="issues").select("c_custkey", "action")


# ---- checks ----


@query("dup_check", "select count(*) n_rows, count(distinct doc_id) n_ids, 0::bigint n_mismatched, count(*) = count(distinct doc_id) ok from documents")
def dup_check(spark, sf_dir):
    return checks.duplicate_ids(table(spark, sf_dir, "documents"), "doc_id", "doc_id")


@query("full_pull_check", "select event_type product, count(*) n_files, (400 // 24 + 1)::bigint expected, count(*) = 400 // 24 + 1 as \"full\" from events group by event_type")
def full_pull_check(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.col("event_type").alias("product"))
    paging = files.distinct().select("product", F.lit(24).alias("base_multiple"), F.lit(400).alias("max_multiple"))
    return checks.full_pull(files, paging)


@query("page_ratio", "select conv_id, round(avg((length(text) > 40)::int), 9) ratio, avg((length(text) > 40)::int) > 0.9 accepted from conversations group by conv_id")
def page_ratio(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", (F.length("text") > 40).cast("int").alias("ok"))
    return checks.page_ratio(rows, "conv_id", "ok").withColumn("ratio", F.round("ratio", 9))


@query("retry_candidates", "select doc_id from documents d where doc_id not in (select doc_id from labels) and (lang <> 'en' or doc_id % 100 > 85)")
def retry_candidates(spark, sf_dir):
    day = 86_400_000
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", F.array(F.lit("missing"))).otherwise(F.array().cast("array<string>")).alias("tags"), (NOW - (99 - F.col("doc_id") % 100) * day).alias("created_ms"))
    return checks.retry_candidates(rows, table(spark, sf_dir, "labels"), "doc_id", now_ms=NOW).select("doc_id")


# ---- outbox ----

_UNIT_SQL = "u as (select o_orderkey, o_orderstatus cs, o_orderpriority cp, case when o_orderkey % 3 = 0 then 'Z' else o_orderstatus end ps, case when o_orderkey % 4 = 0 then null else o_orderpriority end pp from orders)"


def units(spark, sf_dir) -> DataFrame:
    pushed = F.struct(F.when(F.col("o_orderkey") % 3 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("status"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority")).alias("priority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", pushed.alias("pushed"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("current"))


@query("delta_record", f"""with {_UNIT_SQL} select o_orderkey, '{{"o_orderkey":' || o_orderkey || case when ps <> cs then ',"status":"' || cs || '"' else '' end || case when pp is distinct from cp then ',"priority":"' || cp || '"' else '' end || '}}' record
from u where ps <> cs or pp is distinct from cp""")  # fmt: skip
def delta_record(spark, sf_dir):
    return outbox.delta(units(spark, sf_dir), "o_orderkey").select("o_orderkey", "record")


@query("mark_pushed", f"with {_UNIT_SQL} select o_orderkey, case when o_orderkey % 2 = 0 then cs else ps end status, case when o_orderkey % 2 = 0 then cp else pp end priority from u")
def mark_pushed(spark, sf_dir):
    u = units(spark, sf_dir)
    sent = outbox.delta(u, "o_orderkey").where("o_orderkey % 2 = 0")
    return outbox.mark_pushed(u, sent, "o_orderkey").select("o_orderkey", "pushed.status", "pushed.priority")


@query("outbox_size_gate", """with r as (select doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '","n":' || n_chars || '}' record from documents) select doc_id, strlen(record) <= 33 passed from r""")
def outbox_size_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("n_chars").alias("n"))
    good, large = outbox.gate(outbox.delta(outbox.create(rows, "doc_id"), "doc_id"), 33)
    return good.select("doc_id", F.lit(True).alias("passed")).unionByName(large.select("doc_id", F.lit(False).alias("passed")))


@query("field_delta_update", """with t as (select c_custkey, list_sort(list_distinct([c_mktsegment])) a from customer where c_custkey % 6 <> 0), s as (select o_custkey c_custkey, list_sort(list(distinct o_orderpriority)) b from orders where o_custkey % 2 = 0 group by o_custkey)
select c_custkey, array_to_string(a, '|') prior, array_to_string(b, '|') as new from t join s using (c_custkey) where a <> b""")  # fmt: skip
def field_delta_update(spark, sf_dir):
    theirs = table(spark, sf_dir, "customer").where("c_custkey % 6 <> 0").select("c_custkey", F.array("c_mktsegment").alias("topics"))
    ours = table(spark, sf_dir, "orders").where("o_custkey % 2 = 0").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_set("o_orderpriority").alias("topics"))
    both, _ = outbox.field_delta(theirs, ours, "c_custkey", "topics")
    return both.select("c_custkey", F.array_join("prior", "|").alias("prior"), F.array_join("new", "|").alias("new"))


# ---- streaming ----


@query("daily_counts", "select date_trunc('day', ts)::timestamp as day, event_type, count(*) n from events group by all")
def daily_counts(spark, sf_dir):
    from ..streaming import sync

    return sync.daily_counts(table(spark, sf_dir, "events")).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("stream_cdc", "select user_id, event_type, round(value, 6) as value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def stream_cdc(spark, sf_dir):
    """The store after an availableNow run over events equals the newest event of each user."""
    from ..streaming import sync
    from .scratch import folder

    base = folder(spark, "stream")
    source = sync.event_stream(spark, sf_dir, table(spark, sf_dir, "events").schema).select("user_id", "ts", F.struct("event_id", "event_type", "value").alias("last"))
    target = store.Store(spark, f"{base}/store", "user_id", ["ts", "last"], newest_by="ts")
    sync.run_available(source, target, f"{base}/checkpoint", at="ts")
    return target.read().select("user_id", "last.event_type", F.round("last.value", 6).alias("value"))


from . import state_queries, sync_queries  # noqa: E402, F401  (they register their queries)
