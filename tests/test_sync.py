"""Texts and their artefacts, records for the destinations, delivery, and the whole run over made-up files."""

import json

import pytest
from pyspark.sql import functions as F

from quern.operators import analytics, delivery, outbox, records, texts
from quern.plans import control, scratch
from quern.plans.run import Run, Setting
from quern.sources import pull


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- texts ----


def frame(spark, items, kind="doc_id long, text string, source string"):
    return spark.createDataFrame(items, kind)


def plan(spark, store, items, fetched, force=False):
    r = spark.createDataFrame([(k, 1) for k in items], "doc_id long, data_created long")
    return texts.text_plan(r, store.read().select("doc_id", "hash"), frame(spark, fetched), "doc_id", force=force)


def test_text_store(spark, tmp_path):
    s = texts.TextStore(spark, f"file://{tmp_path}/t", counts=analytics.term_counts, buckets=3)
    first = plan(spark, s, [1, 2, 3], [(1, "apple apple apple pear", "json"), (2, "pear pear pear plum", "pdf"), (3, "", None)])
    assert rows(first.select("doc_id", "op")) == [(1, "add"), (2, "add"), (3, "missing")]
    assert s.sync(first, now=1, dry_run=True) == {"add": 2, "missing": 1} and s.versions.version() == 0
    s.sync(first, now=1)
    assert [s.missing(a).count() for a in texts.ARTEFACTS] == [2, 2, 2]
    s.update_term_counts(most=1)
    assert s.missing("term_counts").count() == 1
    s.update_term_counts()
    s.update_pseudo(ignored=spark.createDataFrame([(2, ["pear"])], "doc_id long, terms array<string>"))
    assert rows(s.read("pseudo").select("doc_id", "pseudo")) == [(1, "apple\n"), (2, "")]
    assert s.update_doc_counts() == 2 and rows(s.read("doc_counts")) == [("apple", 1), ("pear", 2), ("plum", 1)]
    s.update_tfidf()
    want = analytics.tfidf(analytics.term_counts(s.read()))
    assert rows(s.read("tfidf").select("doc_id", "term", F.round("tfidf", 9))) == rows(want.select("doc_id", "term", F.round("tfidf", 9)))
    assert rows(s.term_count(spark.createDataFrame([(1,)], "doc_id long"))) == [(1, "apple", 3), (1, "pear", 1)]
    # an anagram has the same hash and counts as unchanged, unless forced
    assert s.sync(plan(spark, s, [1, 2], [(1, "apple apple pear apple", "json")]), now=2) == {"none": 2}
    assert s.sync(plan(spark, s, [1, 2], [(1, "plum", "pdf")]), now=3) == {"update": 1, "none": 1}
    assert [s.missing(a).count() for a in texts.ARTEFACTS] == [1, 1, 1] and rows(s.read("doc_counts")) == [("pear", 1), ("plum", 1)]
    assert {r.doc_id: r.tags for r in s.read().collect()} == {1: ["pdf"], 2: ["pdf"]} and rows(s.read("counted")) == [(2,)] and s.n_counted() == 1
    s.update_term_counts()
    assert s.update_doc_counts() == 2 and rows(s.read("doc_counts")) == [("pear", 1), ("plum", 2)]
    assert s.sync(plan(spark, s, [1], []), now=4) == {"delete": 1, "none": 1}
    assert rows(s.read("term_counts")) == [(1, "plum", 1)] and rows(s.read("doc_counts")) == [("plum", 1)] and s.read("tfidf").count() == 0
    s.delete_from("pdf", now=5)
    assert all(s.read(x).count() == 0 for x in ("texts", "term_counts", "pseudo", "tfidf", "doc_counts"))
    assert s.update_doc_counts(wipe=True) == 0


def test_text_files(spark, tmp_path):
    s = texts.TextStore(spark, f"file://{tmp_path}/t")
    s.sync(plan(spark, s, [1, 2], [(1, "one\ntwo", "json"), (2, "ü", "json")]), now=1)
    s.export_text("texts", "text", f"file://{tmp_path}/out")
    assert rows(s.import_texts(f"file://{tmp_path}/out")) == [(1, "one\ntwo"), (2, "ü")]


def test_text_files_are_read_by_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(texts, "READ", 3)
    s = texts.TextStore(spark, f"file://{tmp_path}/t", key="name", key_type="string")
    out = tmp_path / "out"
    out.mkdir()
    for k in range(400):
        (out / f"k{k}.txt").write_bytes(b"x" * (k % 7))
    for name, data in (("_a.txt", b"own"), (".draft.txt", b"no"), ("notes", b"no"), ("a.b.txt", "ü\r\n".encode())):
        (out / name).write_bytes(data)
    got = s.import_texts(f"file://{out}")
    assert rows(got) == sorted([*((f"k{k}", "x" * (k % 7)) for k in range(400)), ("_a", "own"), ("a.b", "ü\r\n")], key=str)
    assert "Scan text" not in got._jdf.queryExecution().executedPlan().toString() and got.rdd.getNumPartitions() <= 64


def test_missing_tags_and_cascade(spark):
    r = spark.createDataFrame([(1, ["x"]), (2, ["transcript_missing"]), (3, [])], "id int, tags array<string>")
    p = spark.createDataFrame([(1, "missing"), (2, "add")], "id int, op string")
    assert rows(texts.retagged_records(r, p, "id")) == [(1, ["x", "transcript_missing"]), (2, []), (3, [])]
    left = texts.cascade({"a": r, "b": r.select("id")}, p.select("id"), "id")
    assert [x.count() for x in left.values()] == [1, 1]


def test_pdf_pages(spark):
    files_ = spark.createDataFrame([("a", b"2"), ("b", b"x"), ("c", b"0")], "path string, content binary")

    def extract(content):
        return [(f"p{k} ", None if k else "q") for k in range(int(content))]

    pages = texts.pdf_pages(files_, extract)
    assert rows(pages) == [("a", 0, "p0 ", "q"), ("a", 1, "p1 ", None), ("b", 0, None, None)]
    assert rows(texts.pages_text(pages.withColumnRenamed("path", "id"), "id")) == [("a", "p0 p1", "first"), ("b", None, None)]


# ---- outbox and delivery ----


def test_resolved_texts_and_marks(spark, tmp_path):
    kind = "id string, title string, transcript string, pseudo_transcript string, tags array<string>"
    r = spark.createDataFrame([("a", "A", "h", "h", []), ("b", 'B "x"', "h", "h", []), ("c", "C", "h", "h", []), ("d", "", "", "", [])], kind)
    units = outbox.create(r.drop("tags"), "id").join(r.select("id", "tags"), "id")
    held = spark.createDataFrame([("a", "short  text", "ps"), ("b", "long " * 50, 'p "s"'), ("c", "", None)], "id string, text string, pseudo string")
    out = {x.id: (x.fields, json.loads(x.record)) for x in outbox.resolved(outbox.delta(units, "id"), held, "id", full_below=100).collect()}
    assert out["a"] == (["title", "transcript", "pseudo_transcript"], {"id": "a", "title": "A", "transcript": "short  text", "pseudo_transcript": "short text"})
    assert out["b"][1]["pseudo_transcript"] == 'p "s"' and out["b"][1]["title"] == 'B "x"' and out["b"][1]["transcript"] == "long " * 50
    assert out["c"] == (["title"], {"id": "c", "title": "C"}) and "d" not in out
    target = delivery.FileDestination(str(tmp_path / "index"), fails=lambda k: k == "b")
    after, report = delivery.push(units, "id", held, target, scratch.written, full_below=100)
    assert {x.id: x.outcome for x in report.collect()} == {"a": "pushed", "b": "failed", "c": "pushed", "d": "unchanged"}
    assert target.state()["a"]["transcript"] == "short  text" and "b" not in target.state()
    left = {x.id: x.fields for x in outbox.delta(after, "id").collect()}
    assert left == {"b": ["title", "transcript", "pseudo_transcript"], "c": ["transcript", "pseudo_transcript"]}
    _, dry = delivery.push(units, "id", held, target, scratch.written, full_below=100, dry_run=True)
    assert len(target.state()) == 2 and dry.where("outcome = 'pushed'").count() == 3
    gone = after.withColumn("tags", F.when(F.col("id") == "a", F.array(F.lit("delete"))).otherwise(F.col("tags")))
    rest, report = delivery.push(gone, "id", held, target, scratch.written, full_below=100, most_bytes=60)
    assert "a" not in target.state() and sorted(x.id for x in rest.collect()) == ["b", "c", "d"]
    assert {x.id: x.outcome for x in report.collect()}["b"] == "too_large"


def test_update_keeps_what_is_not_given(spark):
    units = outbox.create(spark.createDataFrame([("a", "A", 3)], "id string, title string, n int"), "id")
    new = outbox.update(units, spark.createDataFrame([("a", "B", None), ("b", "C", None)], "id string, title string, n int"), "id")
    assert {r.id: (r.current.title, r.current.n) for r in new.collect()} == {"a": ("B", 3), "b": ("C", 0)}
    assert rows(outbox.unit_changes(units, new, "id")) == [("a", "title", '"A"', '"B"')]


def test_type_errors_of_full_units(spark):
    good = '{"title":{"pushed":"","current":"x"},"likes":{"pushed":0,"current":2}}'
    bad = '{"title":{"pushed":"","current":2},"likes":{"current":2},"other":1}'
    r = spark.createDataFrame([(1, good), (2, bad), (3, "[]"), (4, None)], "id int, unit string")
    got = rows(outbox.type_errors(r, "id", "unit", {"title": "string", "likes": "bigint"}, full_unit=True))
    assert got == [(2, "likes", "not pushed and current"), (2, "other", "unknown field"), (2, "title", "current is not string"), (3, "", "not a record"), (4, "", "not a record")]


def test_crm_push(spark, tmp_path):
    kind = "id string, record struct<website_id:string,title:string>, tags array<string>"
    local = spark.createDataFrame([("a", ("a", "A"), ["repush"]), ("b", ("b", "B"), []), ("c", ("c", "C"), ["repush"]), ("d", ("d", "D"), ["repush"])], kind)
    remote = spark.createDataFrame([("a", "r1"), ("b", "r2"), ("d", "r4"), ("z", "r9")], "website_id string, crm_id string")
    target = delivery.FileDestination(str(tmp_path / "crm"), fails=lambda k: k == "r4")
    after, report = delivery.push_crm(local, remote, target, scratch.written, pause=0)
    assert rows(report.select("id", "action")) == [("a", "update"), ("b", "none"), ("c", "insert"), ("d", "update"), ("z", "delete")]
    assert {r.id: r.tags for r in after.collect()} == {"a": [], "b": [], "c": ["repush"], "d": ["repush"]}
    assert target.state()["r1"]["title"] == "A" and target.state()["c"]["title"] == "C"
    broken = local.withColumn("record", F.struct(F.lit("x").alias("website_id"), F.lit("t").alias("title")))
    with pytest.raises(ValueError):
        delivery.push_crm(broken, remote, target, scratch.written, pause=0)


def test_index_settings(tmp_path):
    target = delivery.FileDestination(str(tmp_path / "index"))
    delivery.configure(target, records.index_settings, list(records.REPLICAS))
    read = lambda name: json.loads((tmp_path / "index" / "settings" / f"{name}.json").read_text())
    assert read("main")["searchable"][0] == "pseudo_transcript" and read("main")["custom_ranking"] == [["published_on", False]]
    assert read("likes_descending")["ranking"][0] == ["desc", "likes"] and "custom_ranking" not in read("date_ascending") and target.state() == {}


def test_whole_publications(spark):
    f = spark.createDataFrame([("a", "f1", 3), ("b", "f2", 1)], "product string, file string, n long")
    assert pull.whole_publications(f, ["a", "b"]) and not pull.whole_publications(f, ["a", "c"])
    assert not pull.whole_publications(f.unionAll(f.limit(1)), ["a"])


def test_push_lists(spark, tmp_path):
    theirs = spark.createDataFrame([("A", "r1", ["x"]), ("B", "r2", [])], "key string, crm_id string, subjects array<string>")
    ours = spark.createDataFrame([("A", ["x", "y"]), ("B", None), ("C", ["z"])], "key string, subjects array<string>")
    target = delivery.FileDestination(str(tmp_path / "crm"))
    changed, only = delivery.push_lists(theirs, ours, "key", "subjects", target, scratch.written, pause=0)
    assert rows(changed) == [("A", ["x"], ["x", "y"], None)] and only == 1 and target.state() == {"r1": {"subjects": ["x", "y"]}}


# ---- sources ----


def test_paging(spark, tmp_path):
    site = make_site(tmp_path)
    paging, errors = pull.probe_paging(spark, site, "videos", ["tv", "none"])
    assert rows(paging) == [("tv", 4, 8)] and "none" in errors
    assert pull.paging_of(paging, "tv", "max_multiple") == 8 and pull.paging_of(paging, "x", "max_multiple") is None


def test_a_failed_pull_leaves_the_last(spark, tmp_path):
    site = make_site(tmp_path)
    p = pull.Pulls(spark, f"file://{tmp_path}/pulls", site)
    assert p.pull("shows", None, ["tv"]) and p.shows().count() == 2

    class Broken(pull.FolderSite):
        def page(self, kind, product, offset):
            raise OSError("down")

    p.site = Broken(str(tmp_path / "site"))
    assert not p.pull("shows", None, ["tv"]) and p.shows().count() == 2 and "down" in p.errors["shows"]


# ---- the whole run ----


def make_site(tmp_path, n=10, drop=()):
    """A site of n videos, two shows, two publications, guests, comments and texts."""
    base = tmp_path / "site"

    def put(name, value):
        path = base / f"{name}.json"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(value))

    items = []
    for k in range(n):
        if k in drop:
            continue
        items.append({"id": f"v{k}", "type": "video", "links": {"thumbnail": "t"}, "relationships": {"show": {"links": {"related": f"http://s/{k % 3}"}}}, "attributes": {"video_id": f"v{k}", "video_title": f"Title {k}", "video_featuring": "Dr. Ann Lee and Bob", "video_interviewer": "Bob" if k else "Nobody Known", "video_description": "d", "video_topic_names": ["gold"], "video_tag_names": ["rates"], "video_asset_names": [], "video_product_id": "tv", "video_likes_count": k, "video_filmed_on": 86_400_000, "video_published_on": 86_400_000 * (k + 1)}})
        put(f"comments/v{k}", [{"attributes": {"comment_likes_count": 2, "comment_reply_to_id": "x" if k % 2 else None}}] * (k % 3))
        if k != 1:
            put(f"texts/videos/v{k}", {"words": [[0, " gold "], [1, ""], [2, "gold gold gold rates"]]} if k % 2 else {"pdf_text": "silver " * 5})
    put("videos/tv", items)
    put("shows/tv", [{"id": str(k), "attributes": {"show_name": f"Show {k}"}} for k in range(2)])
    put("publications/tv", [{"id": f"p{k}", "type": "issue", "attributes": {"issue_id": f"p{k}", "issue_title": f"P{k}", "issue_product_id": "tv", "issue_published_on": 86_400_000, "issue_asset_names": ["a"], "issue_topic_names": ["a"]}} for k in range(2)])
    put("texts/publications/p0", {"pdf_text": "copper copper copper copper"})
    put("tables/guests", [{"id": "g1", "fields": {"name": "Ann Lee"}}, {"id": "g2", "fields": {"name": " Bob ", "subjects": ["old"]}}, {"id": "g3", "fields": {"name": "Bob"}}, {"id": "g4", "fields": {}}])
    put("tables/shows", [{"id": "s0", "fields": {"name": "S", "site_name": "Show 0"}}])
    put("tables/videos", [{"id": "rec-old", "fields": {"website_id": "gone"}}])
    return pull.FolderSite(str(base), page_size=4)


def make_run(spark, tmp_path, site, now, **options):
    setting = Setting(f"file://{tmp_path}/state", ["tv"], ["tv"], {"tv": ["ESSENTIAL"]}, video_url="http://v/", publication_url="http://p/", pause=0.0, buckets=2)
    sinks = {name: delivery.FileDestination(str(tmp_path / name)) for name in records.INDEXES}
    crm = delivery.FileDestination(str(tmp_path / "crm"))
    return Run(spark, setting, site, crm, sinks, control.Control(str(tmp_path / "control.json")), now=lambda: now, **options), crm, sinks


def failed(result):
    return {k: repr(v) for k, v in result.items() if isinstance(v, Exception)}


def test_run_at_three_levels(spark, tmp_path):
    site = make_site(tmp_path)
    run, crm, sinks = make_run(spark, tmp_path, site, 10**12)
    result = run.run(3)
    assert not failed(result)
    assert result["sync_videos"] == {"add": 10} and result["sync_publications"] == {"add": 2}
    assert result["video_texts"] == {"add": 9, "missing": 1} and result["publication_texts"] == {"add": 1, "missing": 1}
    assert result["crm_records"] == {"add": 10} and result["push_crm"] == {"insert": 10, "delete": 1}
    assert result["search"] == {"videos": {"pushed": 10}, "videos_full": {"pushed": 10}, "publications": {"pushed": 2}}
    assert result["subjects"]["changed"] == 2 and crm.state()["g2"] == {"subjects": ["gold", "rates"]}
    assert {r.id: r.issues for r in run.report["issues"].collect()}["v0"] == "interviewer not found: Nobody Known"
    assert rows(run.report["unknown people"]) == [("Nobody Known",)]
    state = sinks["videos"].state()
    assert state["v3"]["pseudo_transcript"] == "gold gold gold gold rates" and state["v3"]["show"] == "Show 0" and "pseudo_transcript" not in state["v1"]
    assert state["v4"]["n_comments"] == 1 and sinks["videos_full"].state()["v0"]["transcript"].startswith("silver silver")
    assert crm.state()["v3"]["show"] == ["s0"] and crm.state()["v3"]["featuring"] == ["g1", "g2"] and crm.state()["v0"]["interviewers"] == []
    # nothing new at level one: nothing is sent but what had an issue, or a changed comment
    again, crm, sinks = make_run(spark, tmp_path, site, 10**12 + 1)
    result = again.run(1)
    assert not failed(result) and result["sync_videos"].get("add", 0) == 0 and result["search"] == {"videos": {"unchanged": 10}}
    # a video that is gone, and one that changed, at level two
    site = make_site(tmp_path, n=11, drop=(2,))
    third, crm, sinks = make_run(spark, tmp_path, site, 10**12 + 2)
    result = third.run(2)
    assert not failed(result) and result["sync_videos"] == {"add": 1, "delete": 1, "none": 9}
    assert result["crm_records"]["delete"] == 1 and result["crm_records"]["add"] == 1
    assert result["search"]["videos"] == {"pushed": 1, "deleted": 1, "unchanged": 9} and "v2" not in sinks["videos"].state()


def test_dry_run_writes_nothing(spark, tmp_path):
    site = make_site(tmp_path, n=5)
    run, crm, sinks = make_run(spark, tmp_path, site, 1)
    run.run(2)
    before = run.videos.version(), run.transcripts.versions.version(), run.crm_local.version(), len(crm.state())
    dry, crm, _ = make_run(spark, tmp_path, make_site(tmp_path, n=7), 2, dry_run=True)
    result = dry.run(2)
    assert not failed(result) and result["sync_videos"]["add"] == 2
    assert (dry.videos.version(), dry.transcripts.versions.version(), dry.crm_local.version(), len(crm.state())) == before


def test_a_failed_pull_stops_the_job(spark, tmp_path):
    class Broken(pull.FolderSite):
        def page(self, kind, product, offset):
            if kind == "shows":
                raise OSError("down")
            return super().page(kind, product, offset)

    make_site(tmp_path, n=4)
    run, _, _ = make_run(spark, tmp_path, Broken(str(tmp_path / "site"), page_size=4), 1)
    with pytest.raises(control.Stopped):
        run.run(2)
    assert run.videos.version() == 0 and run.control.get("jobs") is True


def test_running_work_is_stopped_and_leaves_the_stores(spark, tmp_path):
    """The switch goes off while a Spark job of one step runs for minutes: it ends within seconds, and nothing of it is seen."""
    import threading
    import time

    from quern.operators.store import Store

    s = Store(spark, f"file://{tmp_path}/store", "k", ["v"])
    s.sync(spark.range(50).select(F.col("id").alias("k"), F.lit("a").alias("v")), now=1)
    c, began = control.Control(str(tmp_path / "control.json")), threading.Event()

    def slow(batches):
        for batch in batches:
            time.sleep(120)
            yield batch

    def step(level):
        began.set()
        rows = spark.range(0, 50, 1, 2).mapInArrow(slow, "id long").select(F.col("id").alias("k"), F.lit("b").alias("v"))
        s.sync(rows, now=2)

    seen = []
    steps = [("first", lambda level: seen.append("first"), ()), ("beside", lambda level: spark.range(10).count(), ()), ("slow", step, ("first",)), ("never", lambda level: seen.append("never"), ("slow",))]
    threading.Thread(target=lambda: began.wait(60) and time.sleep(2) or c.set("jobs", False)).start()
    start = time.time()
    with pytest.raises(control.Stopped):
        control.run_graph(c, 1, steps, spark.sparkContext)
    assert time.time() - start < 40 and seen == ["first"] and c.get("jobs") is True
    assert s.version() == 1 and {r.v for r in s.read().collect()} == {"a"}


def test_graph_of_steps(spark, tmp_path):
    import threading

    c, meet = control.Control(str(tmp_path / "control.json")), threading.Barrier(2, timeout=30)
    order = []
    side = lambda name: lambda level: (meet.wait(), order.append(name), name)[2]  # noqa: E731  both must run at the same time
    broken = lambda level: 1 / 0
    steps = [("a", side("a"), ()), ("b", side("b"), ()), ("bad", broken, ("a",)), ("last", lambda level: order.append("last") or level.deletions, ("bad", "b"))]
    got = control.run_graph(c, 2, steps, spark.sparkContext)
    assert list(got) == ["a", "b", "bad", "last"] and got["a"] == "a" and isinstance(got["bad"], ZeroDivisionError) and got["last"] is True and order[-1] == "last"
    for wrong in ([("a", broken, ("x",))], [("a", broken, ("b",)), ("b", broken, ("a",))]):
        with pytest.raises(ValueError):
            control.run_graph(c, 1, wrong, spark.sparkContext)


def test_old_versions_are_dropped_by_the_run(spark, tmp_path):
    from quern.operators.versions import Versions

    run, _, _ = make_run(spark, tmp_path, make_site(tmp_path, n=1), 1)
    run.setting.keep_versions = 2
    row = spark.createDataFrame([("tv", 1, 1)], pull.PAGING)
    for _ in range(4):
        Versions(spark, f"file://{tmp_path}/state/paging", 1).commit({"paging": (row, "product", None)})
    assert run.retention(control.LEVELS[1])["paging"] == 2 and run.paging.read("paging").count() == 1


# ---- the ledger ----


def test_a_killed_delivery_sends_each_record_once(spark, tmp_path):
    """A task dies midway; the job that runs again sends what was not sent, and asks about what is in doubt."""
    import os

    sent = tmp_path / "sent"
    sent.mkdir()
    deltas = spark.createDataFrame([(f"k{k}", ["f"], f"r{k}") for k in range(30)], "id string, fields array<string>, record string")

    def send(die):
        def one(key, record):
            if key == "k7" and not die:
                raise OSError("refused")
            with (sent / key).open("a") as out:
                out.write("x")
            if die and len(list(sent.iterdir())) == 12:
                os._exit(1)  # after it was sent, before it is settled

        return one

    from quern.operators.ledger import record_id

    ids = {record_id(f"k{k}", f"r{k}"): f"k{k}" for k in range(30)}
    book = f"file://{tmp_path}/ledger"
    with pytest.raises(Exception, match="."):
        outbox.deliver(deltas, "id", send(True), writers=2, ledger=book, lease=1.0).collect()
    first = {p.name for p in sent.iterdir()}
    assert 12 <= len(first) < 30
    out = outbox.deliver(deltas, "id", send(False), writers=2, ledger=book, lease=1.0, holds=lambda i: (sent / ids[i]).exists()).collect()
    assert {r.id for r in out if r.error} <= {"k7"} and len(out) == 30
    assert {p.read_text() for p in sent.iterdir()} == {"x"} and {f"k{k}" for k in range(30)} - {"k7"} <= {p.name for p in sent.iterdir()}
    again = outbox.deliver(deltas, "id", send(False), writers=2, ledger=book, lease=1.0).collect()
    assert len(again) == 30 and {p.read_text() for p in sent.iterdir()} == {"x"}


def test_two_attempts_at_the_same_time_send_once(tmp_path):
    import threading
    import time

    from quern.operators.ledger import Ledger, Slots

    sent = []

    def attempt():
        book = Ledger(str(tmp_path / "book"), 3, lease=20, wait=0.02)
        for k in range(20):
            book.once(k, "r", lambda k=k: (time.sleep(0.01), sent.append(k)))
        book.close()

    threads = [threading.Thread(target=attempt) for _ in range(3)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(sent) == list(range(20))
    slots, times = [Slots(time.time(), 0.05, k, 3) for k in range(3)], []

    def write(s):
        for _ in range(4):
            s.wait()
            times.append(time.time())

    threads = [threading.Thread(target=write, args=(s,)) for s in slots]
    [t.start() for t in threads]
    [t.join() for t in threads]
    times.sort()
    assert times[-1] - times[0] >= 0.05 * 10 and sum(b - a < 0.02 for a, b in zip(times, times[1:], strict=False)) <= 2
    with pytest.raises(ValueError):
        Ledger("s3://bucket/x", 0)


def test_a_ledger_syncs_groups_and_holds_one_book(spark, tmp_path, monkeypatch):
    """The disk is waited for a few times a group, not twice a record, and a partition's records lie in many journals."""
    import os

    from quern.operators.ledger import Ledger

    synced, real = [], os.fsync
    monkeypatch.setattr(os, "fsync", lambda f: (synced.append(f), real(f)))
    book, sent = Ledger(str(tmp_path / "one"), 0), []
    assert book.each([(k, "r") for k in range(1000)] + [(5, "r")], lambda k, _: sent.append(k)) == [None] * 1001
    book.close()
    assert sent == list(range(1000)) and len(synced) < 200
    again = Ledger(str(tmp_path / "one"), 0)
    assert len(again.settled) == 1000 and not again.doubtful and again.once(7, "r", lambda: sent.append(7)) is None and len(sent) == 1000
    deltas = spark.range(2000).select("id", F.array(F.lit("f")).alias("fields"), F.lit("r").alias("record"))
    assert outbox.deliver(deltas, "id", lambda k, r: None, writers=2, ledger=f"file://{tmp_path}/many").count() == 2000
    held = [len(p.read_text().splitlines()) for p in (tmp_path / "many").rglob("*.journal")]
    assert len(held) == 128 and max(held) < 200


def test_schedule_and_command_line(tmp_path):
    path = str(tmp_path / "control.json")
    c, ran, clock = control.Control(path), [], [0.0]
    jobs = {"frequent": (lambda now: True, lambda: ran.append("frequent")), "daily": (lambda now: now >= 60, lambda: ran.append("daily"))}
    s = control.Schedule(c, jobs, clock=lambda: clock[0], sleep=lambda _: clock.__setitem__(0, clock[0] + 30) or (clock[0] > 100 and s.stop()))
    s.run()
    assert ran == ["frequent", "frequent", "daily"] and c.get("everything") is False
    assert control.main([path, "enable"]) == "jobs=True everything=False" and control.main([path, "stop"]) == "jobs=False everything=False"
    assert control.main([path, "once"], lambda level: ran.append(level)) == "jobs=True everything=False" and ran[-1] == 1
    assert control.run_stamp(0) == "19700101-0000"
