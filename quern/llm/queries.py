"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_middle, importance, jaccard_join, license_scan, line_dedup, mixing, neighbour_graph, quality_model, quality_rules, sentencepiece_bpe, sharding, suffix_dedup, warc

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query(
    "op1_ngram_jaccard_join",
    f"""
with recursive w as (select doc_id, {LOWER.format("array_to_string(" + WORDS + ", ' ')")} t, len({WORDS}) m from documents),
s as (select distinct doc_id, unnest(case when m = 0 then [] when m < 4 then [t]
        else list_transform(range(1, m - 2), lambda k: array_to_string(string_split(t, ' ')[k:k+3], ' ')) end) g from w),
n as (select doc_id, count(*) n from s group by 1),
link as (select a.doc_id a, b.doc_id b from s a join s b on a.g = b.g and a.doc_id <> b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
         group by all having 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
reach(d, r) as (select a, b from link union select reach.d, link.b from reach join link on link.a = reach.r)
select w.doc_id, coalesce(n.n, 0)::bigint n_shingles, least(w.doc_id, coalesce((select min(r) from reach where reach.d = w.doc_id), w.doc_id)) component_id
from w left join n using (doc_id)
""",
)
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


@query(
    "op2_warc",
    """
with p as (select page_id, octet_length(encode(coalesce(html, '')))::bigint payload_bytes, sha256(coalesce(html, '')) payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) keep from p)
select page_id, payload_bytes, payload_digest, case when payload_bytes >= 100 and page_id > keep then 'revisit' else 'response' end record_type,
       case when payload_bytes >= 100 and page_id > keep then keep end refers_to from f
""",
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages")), with_payload=False)
    return back.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))


@query(
    "op3_line_dedup",
    f"""
with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) ls from documents),
lines as (select doc_id, unnest(range(1, len(ls) + 1)) pos, unnest(ls) line from docs),
keyed as (select *, {LOWER.format(f"trim(line, {BLANKS})")} k from lines),
rep as (select k, min(doc_id) keep from keyed where length(k) >= 10 group by k having count(distinct doc_id) > 1),
marked as (select keyed.*, rep.k is not null and keyed.doc_id <> keep gone from keyed left join rep using (k))
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256
from marked group by doc_id
""",
)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_GRAMS = ", ".join(f"('{name}', '{gram}')" for name, text in license_scan.TEMPLATES.items() for gram in license_scan.bigrams(license_scan.plain_words(text)))


@query(
    "op6_license_scan",
    rf"""
with d as (select doc_id, coalesce(text, '') t from documents),
p as (select doc_id, t, string_split_regex(t, '\n[\x20\t\r]*\n') ps from d),
u as (select doc_id, unnest(list_concat(string_split(t, chr(10)), list_filter(ps, lambda x: contains(x, chr(10))), case when len(ps) > 1 then [t] else [] end)) unit from p),
w as (select doc_id, row_number() over () uid, regexp_extract_all({LOWER.format("unit")}, '[a-z0-9]+(?:\.[0-9]+)*') ws from u),
g as (select distinct doc_id, uid, unnest(list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1])) gram from w where len(ws) > 1),
n as (select uid, count(*) a from g group by uid),
tpl(name, gram) as (values {_GRAMS}),
tn as (select name, count(*) b from tpl group by name),
m as (select g.doc_id, g.uid, tpl.name, 2::double * count(*) / (any_value(a) + any_value(b)) dice from g join tpl using (gram) join n using (uid) join tn using (name)
      group by g.doc_id, g.uid, tpl.name having 2::double * count(*) / (any_value(a) + any_value(b)) >= 0.8),
best as (select * from m qualify row_number() over (partition by uid order by dice desc, name) = 1),
r as (select doc_id, count(*) n_units, string_agg(distinct name, ',' order by name) licences, min({{'d': -dice, 'n': name}}) x from best group by doc_id),
bg as (select doc_id, k, ws[k] || ' ' || ws[k + 1] gram from (select doc_id, ws, unnest(range(1, len(ws))) k from (select doc_id, regexp_extract_all({LOWER.format("t")}, '[a-z0-9]+(?:\.[0-9]+)*') ws from d))),
lim as (select name, b, greatest(1, ceil(b * 0.8::double / 1.2::double - 1e-9))::int least, floor(b * 1.2::double / 0.8::double + 1e-9)::int most from tn),
hit as (select doc_id, name, k, gram from bg join tpl using (gram)),
cand as (select doc_id, name, any_value(least) least, any_value(most) most from hit join lim using (name) group by doc_id, name having count(distinct gram) >= any_value(least)),
win as (select c.doc_id, c.name, c.least, x.k i, y.k j from cand c join hit x on x.doc_id = c.doc_id and x.name = c.name join hit y on y.doc_id = c.doc_id and y.name = c.name and y.k >= x.k and y.k < x.k + c.most),
held as (select w.doc_id, w.name, i, j, count(distinct z.gram) h from win w join hit z on z.doc_id = w.doc_id and z.name = w.name and z.k between i and j group by all having count(distinct z.gram) >= any_value(w.least)),
own as (select e.doc_id, e.name, i, j, any_value(h) h, count(distinct bg.gram) o from held e join bg on bg.doc_id = e.doc_id and bg.k between i and j group by all),
scored as (select own.*, 2::double * h / (o + b) dice from own join lim using (name)),
found as (select * from scored where dice >= 0.8 qualify row_number() over (partition by doc_id, name order by dice desc, i, j) = 1),
emb as (select doc_id, string_agg(name, ',' order by name) embedded from found f where not exists (select 1 from found g where g.doc_id = f.doc_id and g.dice > f.dice and g.j - g.i >= f.j - f.i and g.i <= f.j and f.i <= g.j) group by doc_id)
select d.doc_id, x.n licence, -x.d dice, coalesce(n_units, 0)::bigint n_units, coalesce(licences, '') licences, coalesce(embedded, '') embedded from d left join r using (doc_id) left join emb using (doc_id)
""".replace(chr(92) * 2, chr(92)),
)
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan.scan(table(spark, sf_dir, "documents")).withColumn("licences", F.array_join("licences", ","))
    return out.withColumn("embedded", F.array_join(F.sort_array("embedded.name"), ","))


@query("op7_nn_descent")
def op7_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_graph.nearest(table(spark, sf_dir, "embeddings"))


@query(
    "op8_mixing",
    f"""
with d as (select doc_id, source, len({WORDS}) size,
                  ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '~' || coalesce(text, ''))), 1, 15))::bigint h from documents),
s0 as (select source, sum(size)::bigint s, row_number() over (order by source nulls last) - 1 k from d group by source),
s1 as (select source, s, case k % 3 when 0 then 5 when 1 then 2 else 1 end::bigint w from s0),
s2 as (select *, row_number() over (order by s::double / w, source nulls last) rk from s1),
s3 as (select *, (select sum(s) from s2) - 3 * coalesce(sum(s) over b, 0) rem, (select sum(w) from s2) - coalesce(sum(w) over b, 0) rw
       from s2 window b as (order by rk rows between unbounded preceding and 1 preceding)),
lvl as (select min_by(rem, rk) rem, min_by(rw, rk) rw from s3 where rem * w <= 3 * s * rw),
t as (select source, s, case when lvl.rem is null or lvl.rem * w > 3 * s * lvl.rw then (3 * s)::double else (lvl.rem * w)::double / lvl.rw end target from s3, lvl),
t2 as (select *, case when s > 0 then least(floor(target / s), 3) else 0 end::bigint c from t),
h as (select source, h, sum(size)::bigint here from d group by all),
cum as (select h.source, h, here, target - c * s budget, sum(here) over (partition by h.source order by h) upto
        from h join t2 on h.source is not distinct from t2.source),
edge as (select source, min_by({{'h': h, 'l': budget - (upto - here), 'here': here}}, h) x from cum where upto > budget group by source),
thr as (select source, x.h + case when x.here - x.l < x.l then 1 else 0 end th from edge)
select d.doc_id, d.size, t2.s source_size, t2.target,
       (d.size * (t2.c + case when d.h < coalesce(th, case when target - c * s > 0 then 1152921504606846976 else 0 end) then 1 else 0 end))::bigint taken
from d join t2 on d.source is not distinct from t2.source left join thr on thr.source is not distinct from d.source
""",
)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", sentencepiece_bpe.Codec(spark).digests(F.col("text"), F.col("doc_id")).alias("d")).select("doc_id", "d.*")


@query(
    "op10_suffix_array",
    """
with d as (select doc_id, hex(encode(coalesce(text, ''))) hx, octet_length(encode(coalesce(text, '')))::bigint n from documents),
w as (select doc_id, k, substr(hx, 2 * k + 1, 100) s from (select doc_id, hx, unnest(range(n - 49)) k from d where n >= 50)),
f as (select s, min(doc_id) least from w group by s having min(doc_id) < max(doc_id)),
c as (select distinct doc_id, k from w join f using (s) where doc_id > least),
i as (select *, coalesce(k > lag(k) over (partition by doc_id order by k) + 50, true)::int first from c),
g as (select *, sum(first) over (partition by doc_id order by k) run from i),
r as (select doc_id, run, min(k) a, max(k) + 50 b from g group by doc_id, run),
p as (select r.*, coalesce(lag(b) over (partition by doc_id order by a), 0) before from r),
kept as (select d.doc_id, string_agg(substr(hx, 2 * before + 1, 2 * (a - before)), '' order by a) || substr(any_value(hx), 2 * max(b) + 1) hx, sum(b - a)::bigint n_removed, count(*) n_spans from p join d using (doc_id) group by d.doc_id)
select d.doc_id, n n_bytes, coalesce(n_removed, 0)::bigint n_removed, coalesce(n_spans, 0)::bigint n_spans, sha256(unhex(coalesce(kept.hx, d.hx))) kept_sha256 from d left join kept using (doc_id)
""",
)
def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"))


#: CRC-32 of a string's UTF-8 bytes, as the reflected polynomial prescribes; the table of 256 is made by its rule.
CRC_TABLE = "table8 as (select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n) order by n) t8 from (select unnest(range(256)) n))"


def crc32_sql(text: str) -> str:
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::bigint)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(c >> 8, t8[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295)"


@query(
    "op11_sharding",
    f"""
with {CRC_TABLE},
d as (select doc_id, source, coalesce('=' || source, '~') k, coalesce(text, '') t, octet_length(encode(coalesce(text, '')))::bigint + 8 size,
             ('0x' || substr(md5('shard:' || coalesce(doc_id::varchar, '~' || coalesce(text, ''))), 1, 15))::bigint h from documents),
c as (select d.*, {crc32_sql("t")} text_crc32 from d, table8),
r as (select *, row_number() over (partition by k order by h, doc_id nulls first, text_crc32) - 1 rank, count(*) over (partition by k) n from c),
f as (select *, (rank::double + ('0x' || substr(md5('shard-phase:' || k), 1, 13))::bigint::double / 4503599627370496::double) / n::double fraction from r),
p as (select *, row_number() over (order by fraction, k) - 1 place, count(*) over () total from f),
s as (select *, (place * 24) // total shard from p)
select doc_id, size, text_crc32, 'rows' law, shard::int shard, place - (shard * total + 23) // 24 slot, null::int grown_shard from s
""",
)
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.interleaved(table(spark, sf_dir, "documents"), 24)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op12_fill_middle",
    r"""
with d as (select doc_id, coalesce(text, '') t, sha256('42:' || coalesce(doc_id::varchar, '')) h from documents),
w as (select doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') u, ('0x' || h[1:8])::bigint h1, ('0x' || h[9:16])::bigint h2, ('0x' || h[17:24])::bigint h3, ('0x' || h[25:32])::bigint h4 from d),
c as (select *, len(u) n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain' when h4 % 100 < 80 then 'spm' else 'psm' end form from w),
p as (select doc_id, t, n, form, array_to_string(u[:a], '') prefix, array_to_string(u[a + 1:b], '') middle, array_to_string(u[b + 1:], '') suffix from c),
o as (select *, case form when 'plain' then t when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end output from p)
select doc_id, n::bigint n, form, case when form <> 'plain' then length(prefix) end::bigint prefix_chars, case when form <> 'plain' then length(middle) end::bigint middle_chars, sha256(output) output_sha256, sha256(t) restored_sha256 from o
""".replace(chr(92) * 2, chr(92)),
)
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.transformed(table(spark, sf_dir, "documents"))
    digest = lambda x: F.sha2(x.cast("binary"), 256)
    again = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(again).alias("restored_sha256"))


def _runs_sql(name: str, rows: str) -> str:
    """name(doc_id, m, f): the runs of one to three words, one row each."""
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".replace(chr(92) * 2, chr(92)).format(LOWER.format("coalesce(text, '')"))
    return f"""{name}_w as (select *, {words} ws from {rows}),
{name} as (select doc_id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda k: ws[k] || ' ' || ws[k + 1]), list_transform(range(1, len(ws) - 1), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2]))) f from {name}_w)"""


@query(
    "op13_importance",
    f"""
with {CRC_TABLE},
{_runs_sql("x", "documents")},
{_runs_sql("y", "(select item_id doc_id, text from benchmark)")},
b as (select f, {crc32_sql("f")} % 10000 bucket from (select distinct f from (select f from x union all select f from y)), table8),
s as (select bucket, count(*) s from x join b using (f) group by bucket),
t as (select bucket, count(*) t from y join b using (f) group by bucket),
g as (select k.bucket, floor(1000::double * ln(((coalesce(t, 0) + 1)::double * (select count(*) + 10000 from x)::double) / ((coalesce(s, 0) + 1)::double * (select count(*) + 10000 from y)::double)))::bigint gain
      from (select unnest(range(10000)) bucket) k left join s using (bucket) left join t using (bucket)),
q as (select doc_id, sum(gain)::bigint weight, count(*) n_features from x join b using (f) join g using (bucket) group by doc_id),
e as (select w.doc_id, len(ws) m, coalesce(n_features, 0)::bigint n_features, coalesce(weight, 0)::bigint weight, ('0x' || sha256('42:' || coalesce(w.doc_id::varchar, ''))[1:8])::bigint::double h from x_w w left join q using (doc_id)),
z as (select *, weight + floor(-1000::double * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint score from e),
r as (select doc_id, row_number() over (order by score desc, doc_id) r from z where m >= 20)
select z.doc_id, n_features, weight, score, case when r <= (select 5 * count(*) // 100 from r) then r end::bigint rank from z left join r using (doc_id)
""",
)
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
