import json
import math

import pytest
from pyspark.sql import functions as F

from quern.operators import analytics, cdc, checks, enrich, outbox
from quern.operators.store import Store
from quern.plans.control import LEVELS, Control, Stopped, may_delete, run_steps
from quern.sources import files, pull


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def shrink(terms, more_than, limit):
    """Plain form of the summary: {term: count} to text."""
    order = sorted(terms.items(), key=lambda x: (-x[1], x[0]))
    size = lambda x: sum(n * (len(t.encode()) + 1) for t, n in x)
    out = [(t, math.ceil(n / (more_than + 1))) for t, n in order if n > more_than]
    if size(out) > limit:
        out = order
        while True:
            out = [(t, n) for t, n in out if n > 1]
            if not out:
                break
            low = min(n for _, n in out)
            out = [(t, math.ceil(n / low)) for t, n in out]
            if size(out) <= limit:
                break
    return "".join((t + "\n") * n for t, n in out) if out else None


def test_pseudo_text_capped(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    counts = analytics.term_counts(docs)
    terms = {}
    for d, t, n in counts.collect():
        terms.setdefault(d, {})[t] = n
    for limit in (50_000, 400, 60):
        got = {r.doc_id: (r.pseudo, r.issue) for r in analytics.pseudo_text(counts, limit=limit).collect()}
        want = {d: shrink(x, 2, limit) for d, x in terms.items()}
        assert {d: p for d, (p, _) in got.items()} == want
        assert all((p is None) == (i is not None) for p, i in got.values())


def test_document_counts_grow_with_new_documents_only(spark):
    counts = spark.createDataFrame([(1, "a", 2), (1, "b", 1), (2, "a", 1), (3, "c", 5)], "doc_id int, term string, count long")
    old = counts.where("doc_id < 3")
    grown, n = analytics.add_documents(analytics.document_counts(old), 2, counts, old.select("doc_id").distinct())
    assert n == 3 and rows(grown) == rows(analytics.document_counts(counts))


def test_plan_and_apply_are_a_law(spark):
    old = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", []), (3, None, ["z"])], "k int, v string, l array<string>")
    new = spark.createDataFrame([(1, "a", ["y", "x"]), (3, "c", ["z"]), (4, "d", ["q"])], "k int, v string, l array<string>")
    ops = cdc.plan(old, new, "k")
    assert {r.k: r.op for r in ops.collect()} == {1: "none", 2: "delete", 3: "update", 4: "add"}
    after = cdc.apply(ops, "k", now=9, columns=["k", "v", "l"]).drop("data_updated")
    again = cdc.plan(after, new, "k")
    assert {r.op for r in again.collect()} == {"none"}
    assert rows(cdc.field_changes(ops, "k", [("v", "string"), ("l", "array<string>")])) == [(3, "v", None, "c", None, None)]


def test_deletion_gate_boundary(spark):
    lost = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert cdc.tolerated(lost, 3).count() == 3 and cdc.tolerated(lost, 2).count() == 0


def test_store(spark, tmp_path):
    kind = "id string, title string, topics array<string>"
    s = Store(spark, f"file://{tmp_path}/store", "id", ["title", "topics"])
    first = spark.createDataFrame([("a", "A", ["x"]), ("b", "B", []), ("c", "C", ["y"])], kind)
    assert s.sync(first, now=1) == {"add": 3}
    second = spark.createDataFrame([("a", "A2", ["x"]), ("b", "B", []), ("d", "D", [])], kind)
    assert s.sync(second, now=2, dry_run=True) == {"none": 1, "update": 1, "delete": 1, "add": 1} and s.version() == 1
    assert s.sync(second, now=2) == {"none": 1, "update": 1, "delete": 1, "add": 1}
    got = {r.id: (r.title, r.data_created, r.data_updated) for r in s.read().collect()}
    assert got == {"a": ("A2", 1, 2), "b": ("B", 1, 1), "d": ("D", 2, 2)}
    assert [(r.id, r.field, r.prior, r.new) for r in s.table("changes").collect()] == [("a", "title", "A", "A2")]
    assert [(r.id, r.n) for r in s.table("tombstones").collect()] == [("c", 1)]
    assert s.sync(second, now=3) == {"none": 3}
    assert s.sync(spark.createDataFrame([], kind), now=4, most_deletions=2)["delete"] == 0 and s.read().count() == 3
    assert s.sync(first, now=5, full=False)["delete"] == 0 and s.read().count() == 4
    s.retag(lambda t: F.array(F.lit("new")))
    assert s.read().where("array_contains(tags, 'new')").count() == 4
    s.retain(1)
    assert s.read().count() == 4
    s.wipe()
    assert s.read().count() == 0 and s.table("tombstones").count() == 1 and s.table("changes").count() == 2
    s.clear_changes()
    assert s.table("changes").count() == 0 and s.table("tombstones").count() == 1


def test_deletable_records_only_are_deleted(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new, may = old.where("k = 1"), old.where("k = 2")
    ops = cdc.plan(old, new, "k")
    assert rows(cdc.apply(ops, "k", now=9, columns=["k", "v"], deletable=may)) == [(1, "a", None), (3, "c", None)]
    stamped = old.withColumn("data_updated", F.lit(5))
    ops = cdc.plan(stamped, old.where("k <> 2").withColumn("v", F.when(F.col("k") == 1, "A").otherwise(F.col("v"))).withColumn("data_updated", F.lit(9)), "k", ["v"])
    assert rows(cdc.apply(ops, "k", now=9, columns=["k", "v"])) == [(1, "A", 9), (3, "c", 5)]
    s = Store(spark, f"file://{tmp_path}/store", "k", ["v"])
    s.sync(old, now=1)
    assert s.sync(new, now=2, deletable=may)["delete"] == 1 and sorted(r.k for r in s.read().collect()) == [1, 3]


def test_a_broken_commit_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    s = Store(spark, f"file://{tmp_path}/store", "k", ["v"], buckets=2)
    one = spark.createDataFrame([(k, "a") for k in range(6)], "k int, v string")
    s.sync(one, now=1)
    two = spark.createDataFrame([(k, "b") for k in range(5)], "k int, v string")

    def broken(manifest):
        raise OSError("stopped")

    with monkeypatch.context() as m:
        m.setattr(s.versions, "_publish", broken)
        try:
            s.sync(two, now=2)
            raise AssertionError
        except OSError:
            pass
    assert s.version() == 1 and {r.v for r in s.read().collect()} == {"a"} and s.table("changes") is None
    s.sync(two, now=3)
    assert s.table("changes").count() == 5 and [(r.k, r.n) for r in s.table("tombstones").collect()] == [(5, 1)]
    assert s.read(1).count() == 6 and s.read().count() == 5


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store", "k", ["v"], buckets=8)
    s.sync(spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v")), now=1)
    before = s.versions.manifest()["buckets"]["rows"]
    s.sync(spark.createDataFrame([(3, "b")], "k long, v string"), now=2, full=False)
    after = s.versions.manifest()["buckets"]["rows"]
    assert Store(spark, f"file://{tmp_path}/store", "k", ["v"], buckets=3).versions.buckets == 8
    assert sum(before[b] != after[b] for b in before) == 1 and s.read().count() == 200
    assert s.sync(spark.createDataFrame([(3, "b")], "k long, v string"), now=3, full=False)["none"] >= 1 and s.version() == 2


def test_store_entries(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store", "k", ["v"])
    s.put(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), now=1)
    s.put(spark.createDataFrame([(2, "c")], "k int, v string"), now=2)
    ids = spark.createDataFrame([(2,)], "k int")
    assert rows(s.entries(ids, "v", "data_updated")) == [(2, "c", 2)]
    s.retag(lambda t: F.array_union(t, F.array(F.lit("x"))), ids)
    s.set_hash(spark.createDataFrame([(1, "h")], "k int, hash string"))
    assert rows(s.entries(spark.createDataFrame([(1,)], "k int"), "hash")) == [(1, "h")]
    assert s.delete_tagged("x", now=3, dry_run=True).count() == 1 and s.read().count() == 2
    s.delete_tagged("x", now=3)
    assert [r.k for r in s.read().collect()] == [1] and s.table("tombstones").count() == 1


def test_outbox_retries_what_failed(spark):
    r = spark.createDataFrame([(1, "a", ["x"]), (2, "b", ["y"])], "id int, title string, tags array<string>")
    units = outbox.create(r, "id")

    def send(key, record):
        if key == 2:
            raise OSError("down")

    sent = outbox.deliver(outbox.delta(units, "id"), "id", send).persist()
    assert {x.id: x.error for x in sent.collect()} == {1: None, 2: "down"}
    units = outbox.mark_pushed(units, sent.where("error is null"), "id")
    assert [x.id for x in outbox.delta(units, "id").collect()] == [2]
    units = outbox.update(units, spark.createDataFrame([(1, "a2", ["x"])], r.schema), "id")
    assert {x.id: x.record for x in outbox.delta(units, "id", ["title"]).collect()} == {1: '{"id":1,"title":"a2"}', 2: '{"id":2,"title":"b"}'}


def test_lookup_reports_unknown_keys(spark):
    r = spark.createDataFrame([(1, "s1"), (2, "s9"), (3, ""), (4, None)], "id int, show string")
    dim = spark.createDataFrame([("s1", "Show")], "k string, name string")
    out = enrich.lookup(r, dim, on="show", key="k", value="name", name="show_name", issue="unknown show")
    assert {x.id: (x.show_name, x.issues) for x in out.collect()} == {1: ("Show", []), 2: (None, ["unknown show: s9"]), 3: (None, []), 4: (None, [])}


def test_people_to_field(spark):
    r = spark.createDataFrame([(1, ["Dr. A", "B"]), (2, ["more"]), (3, [])], "id int, people array<string>")
    dim = spark.createDataFrame([("A", "recA"), ("Nobody", "rec0")], "name string, rec string")
    out = enrich.people_to_field(r, dim, id_col="id", people_col="people", name="name", value="rec", placeholder="Nobody", ignorable=("more",))
    assert {x.id: (x.found, x.missing) for x in out.collect()} == {1: (["recA"], ["B"]), 2: (["rec0"], []), 3: ([], [])}


def test_people_of_several_fields_by_one_join(spark):
    r = spark.createDataFrame([(1, ["Dr. A", "B", "A"], ["B"]), (2, [], None), (3, None, ["A", None])], "id int, f array<string>, i array<string>")
    dim = spark.createDataFrame([("A", 7)], "name string, n int")
    out = enrich.people_to_fields(r, dim, id_col="id", people_cols=["f", "i"], name="name", value="n")
    assert rows(out) == [(1, [7, 7], ["B"], [], ["B"]), (2, [], [], [], []), (3, [], [], [7], [])]


def test_records_look_people_up_once(spark):
    from quern.plans import sync_queries

    for made in (sync_queries.crm_record, sync_queries.search_unit_video):
        plan = made(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Generate posexplode") == 1


def test_sources(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"data": [{"id": "1", "attributes": {"video_title": "T", "video_likes_count": 3, "video_topic_names": ["x"]}}]}')
    (tmp_path / "p2.json").write_text('{"data": [{"id": "2", "attributes": {"video_featuring": null}}]}')
    got = files.project(files.pages(spark, str(tmp_path), files.VIDEO), files.VIDEO_FIELDS).orderBy("id").collect()
    assert [(r.id, r.title, r.likes, r.topics, r.featuring, r.is_free) for r in got] == [("1", "T", 3, ["x"], "", False), ("2", "", 0, [], "", False)]
    assert files.line_list(spark, str(tmp_path / "none.txt")).count() == 0
    (tmp_path / "l.txt").write_text("ab\n cd \n1")
    assert [r.item for r in files.line_list(spark, str(tmp_path / "l.txt")).collect()] == ["ab", "cd", "1"]
    assert files.page_offsets(24, 48) == [0, 24, 48]
    assert files.last_page(lambda k: 24 if k <= 24 * 17 else 0, 24) == 24 * 17
    spark.dataSource.register(files.paged_source("numbers", "n int", lambda offset, options: [(offset + k,) for k in range(int(options["page_size"]))]))
    assert sorted(r.n for r in spark.read.format("numbers").option("page_size", "3").option("most", "6").load().collect()) == list(range(9))


def test_a_broken_off_read_goes_on_at_the_next_page(spark, tmp_path):
    """Each page is fetched once, though the stream broke off and a new source read on from its checkpoint."""
    calls = tmp_path / "calls"
    calls.mkdir()
    plan = json.dumps([["a", 3, 9], ["b", 2, 2], ["c", 5, 0]])

    def fetch(broken):
        def one(offset, options):
            if broken and options["product"] == "b":
                raise OSError("down")
            with (calls / f"{options['product']}-{offset}").open("a") as out:
                out.write("x")
            return [(f"{options['product']}{offset + k}",) for k in range(2)]

        return one

    options = {"plan": plan, "pages_at_once": "1"}
    spark.dataSource.register(files.paged_source("broken", "n string", fetch(True)))
    with pytest.raises(Exception, match="down"):
        files.read_pages(spark, "broken", f"file://{tmp_path}/read", options)
    assert sorted(p.name for p in calls.iterdir()) == ["a-0", "a-3", "a-6", "a-9"]
    spark.dataSource.register(files.paged_source("whole", "n string", fetch(False)))
    got = files.read_pages(spark, "whole", f"file://{tmp_path}/read", options)
    assert sorted(r.n for r in got.collect()) == sorted(f"{p}{o + k}" for p, o in (("a", 0), ("a", 3), ("a", 6), ("a", 9), ("b", 0), ("b", 2), ("c", 0)) for k in range(2))
    assert {p.read_text() for p in calls.iterdir()} == {"x"} and len(list(calls.iterdir())) == 7
    assert sorted(r.n for r in spark.read.format("whole").options(**options).load().collect()) == sorted(r.n for r in got.collect())


def test_pulls_fetch_on_executors(spark, tmp_path, monkeypatch):
    """The driver neither lists items nor makes frames of them."""

    class Site(pull.FolderSite):
        def page(self, kind, product, offset):
            return [{"id": f"{product}{offset + k}", "attributes": {}} for k in range(4 if offset < 8 else 2)] if product != "bad" else 1 / 0

        def table(self, name, fields, part=0, parts=1):
            return [{"id": f"r{part}-{k}", "fields": {"name": f"n{k}"}} for k in range(3)]

    p = pull.Pulls(spark, f"file://{tmp_path}/pulls", Site(str(tmp_path)), pages_at_once=2)
    paging = spark.createDataFrame([("x", 4, 8), ("y", 4, 4), ("bad", 4, 4)], pull.PAGING)
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    assert p.pull("videos", paging, ["x", "y"]) and p.versions.read("videos").count() == 18
    assert sorted(r.n for r in p.files("videos").collect()) == [2, 4, 4, 4, 4]
    assert not p.pull("videos", paging, ["x", "bad"]) and "videos" in p.errors and p.versions.read("videos").count() == 18
    assert not p.pull("videos", paging, ["x", "bad"], resume="r1") and p.pull("videos", paging, ["x", "y"], most=4, resume="r2")
    assert p.versions.read("videos").count() == 16
    t = pull.Snapshots(spark, f"file://{tmp_path}/crm", Site(str(tmp_path)), "guests", ["id", "name"], "id")
    assert t.load().count() == 12


def test_sources_write_reports(spark, tmp_path):
    r = spark.createDataFrame([(1, ["a", "b"], "x")], "id int, tags array<string>, other string")
    files.write_report(r, str(tmp_path / "r"), fields=["id", "tags"])
    assert rows(spark.read.csv(str(tmp_path / "r"), header=True)) == [("1", "a, b")]


def hits(text, phrase, margin):
    """Plain form of snippets."""
    text, out, end = text.lower(), [], 0
    while (at := text.find(phrase, end)) >= 0:
        left = text[end:at][-margin:] if margin else ""
        end = at + len(phrase)
        out.append(left + phrase + text[end : end + margin])
    return out


def test_snippets(spark):
    import random

    rng = random.Random(1)
    texts = ["the quick " * 20_000, "xTHEtheyThe", "", *("".join(rng.choice("the ") for _ in range(rng.randrange(200))) for _ in range(30))]
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    for margin in (4, 25):
        got = {r.k: r.s for r in frame.select("k", analytics.T.snippets(F.col("t"), "the", margin).alias("s")).collect()}
        assert got == {k: hits(t, "the", margin) for k, t in enumerate(texts)}
    assert spark.createDataFrame([(None,)], "t string").select(analytics.T.snippets(F.col("t"), "the").alias("s")).first().s == []


def test_phrase_report_has_three_outcomes(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id int, title string")
    t = spark.createDataFrame([(1, "say the word"), (2, "nothing")], "doc_id int, text string")
    got = rows(analytics.phrase_report(d, t, "the", 3))
    assert got == [(1, "a", "found", 0, "ay the wo"), (2, "b", "not found", None, None), (3, "c", "no text", None, None)]


def test_checks(spark):
    index = spark.createDataFrame([("a",), ("b",)], "id string")
    payloads = spark.createDataFrame([("b",), ("c",)], "id string")
    assert rows(checks.consistent(index, payloads, "id")) == [("a", "no payload"), ("c", "not in index")]
    paging = spark.createDataFrame([("p", 24, 48), ("q", 24, 0)], "product string, base_multiple int, max_multiple int")
    pulled = spark.createDataFrame([("p",)] * 3, "product string")
    assert rows(checks.full_pull(pulled, paging)) == [("p", 3, 3, True), ("q", 0, 1, False)]


def test_control(tmp_path):
    c = Control(str(tmp_path / "control.json"))
    done = []
    steps = [("one", lambda level: done.append(level.pull_most)), ("two", lambda level: 1 / 0), ("three", lambda level: c.set("jobs", False)), ("four", lambda level: done.append("never"))]
    try:
        run_steps(c, 1, steps)
        raise AssertionError
    except Stopped as e:
        assert str(e) == "four" and done == [48] and c.get("jobs") is True
    assert isinstance(run_steps(c, 2, steps[1:2])["two"], ZeroDivisionError)
    assert may_delete(LEVELS[2], pull_ok=True, ids_ok=True, full=True) and not may_delete(LEVELS[1], pull_ok=True, ids_ok=True, full=True)


def test_stream_in_two_runs_equals_one_batch(spark, tmp_path):
    from quern.streaming import sync

    kind = "id int, at int, v string"
    folder = tmp_path / "in"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")], kind).coalesce(1).write.parquet(str(folder / "x"))
    s = Store(spark, f"file://{tmp_path}/store", "id", ["at", "v"], newest_by="at")
    source = lambda: spark.readStream.schema(kind).parquet(str(folder / "*"))
    sync.run_available(source(), s, str(tmp_path / "cp"), at="at")
    spark.createDataFrame([(2, 3, "d"), (3, 1, "e"), (1, 1, "late")], kind).coalesce(1).write.parquet(str(folder / "y"))
    sync.run_available(source(), s, str(tmp_path / "cp"), at="at", now=lambda: 77)
    assert rows(s.read().select("id", "v")) == [(1, "c"), (2, "d"), (3, "e")]
    assert {r.id: r.data_updated for r in s.read().collect()}[2] == 77
