"""Transactions, merge on read, logs and buckets of versioned tables."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from quern.operators import analytics, texts
from quern.operators import versions as V
from quern.operators.store import Store
from quern.operators.versions import Conflict, Versions


def held(s):
    return {r.k: (r.v, sorted(r.tags), r.hash) for r in s.read().collect()}


def store(spark, path, n=20, buckets=4, **options):
    s = Store(spark, f"file://{path}/store", "k", ["v"], buckets=buckets, **options)
    s.sync(spark.range(n).select(F.col("id").alias("k"), F.lit("a").alias("v")), now=1)
    return s


def ids(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "k long")


def size(s, folder=""):
    return s.versions._fs.getContentSummary(s.versions._path(folder)).getLength()


# ---- several writers ----


def test_a_second_writer_is_rebased_or_refused_never_lost(spark, tmp_path):
    s = store(spark, tmp_path)
    v = s.versions
    # blind changes of the same rows: both are there
    first, second = v.begin(), v.begin()
    first.patch("rows", ids(spark, 1, 2).select("k", F.lit("add tag").alias("op"), F.array(F.lit("x")).alias("arg")), ["add tag"])
    second.put("rows", s.prepared(spark.createDataFrame([(2, "b"), (50, "n")], "k long, v string"), 2))
    assert (second.commit(), first.commit()) == (2, 3)
    got = held(s)
    assert got[1][1] == ["x"] and got[2][:2] == ("b", ["x"]) and got[50][0] == "n" and len(got) == 21
    # what one has read and another has changed: refused, and nothing of it is seen
    reader = v.begin()
    reader.replace("rows", reader.read("rows").where("k < 10"), "k")
    s.add_tag("y", ids(spark, 3))
    with pytest.raises(Conflict):
        reader.commit()
    assert len(held(s)) == 21 and held(s)[3][1] == ["y"]
    # other buckets: rebased
    a, b = (v.touched(ids(spark, k), "k") for k in (1, next(k for k in range(20) if v.touched(ids(spark, k), "k") != v.touched(ids(spark, 1), "k"))))
    one, two = v.begin(), v.begin()
    one.replace("rows", one.read("rows", a).withColumn("v", F.lit("one")), "k", a)
    two.replace("rows", two.read("rows", b).withColumn("v", F.lit("two")), "k", b)
    one.commit()
    two.commit()
    assert {"one", "two"} <= {x for x, _, _ in held(s).values()}
    # another table and a log are left alone by both
    writer = v.begin()
    writer.append("changes", spark.createDataFrame([(1, "f", "p", "n", None, None, 5)], "k long, field string, prior string, new string, added string, removed string, ts long"))
    s.versions.commit({"other": (ids(spark, 9), "k", None)})
    writer.commit()
    assert v.read("other").count() == 1 and s.table("changes").where("ts = 5").count() == 1


def test_the_first_commit_of_two_is_kept(spark, tmp_path):
    one, two = (Versions(spark, f"file://{tmp_path}/v") for _ in range(2))
    a, b = one.begin(), two.begin()
    a.replace("t", ids(spark, 1), "k")
    b.replace("t", ids(spark, 2), "k")
    assert a.commit() == 1
    with pytest.raises(Conflict):
        b.commit()
    assert [r.k for r in two.read("t").collect()] == [1]


def test_writers_at_the_same_time(spark, tmp_path):
    s = store(spark, tmp_path, 12)
    failed = []

    def work(k):
        try:
            own = Store(spark, f"file://{tmp_path}/store", "k", ["v"])
            own.versions.upkeep = lambda: None
            own.add_tag(f"t{k}", ids(spark, k, 11))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=work, args=(k,)) for k in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and s.version() == 6
    assert held(s)[11][1] == [f"t{k}" for k in range(5)] and all(held(s)[k][1] == [f"t{k}"] for k in range(5))


def test_a_sync_that_was_overtaken_is_refused(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path)
    late = spark.range(20).select(F.col("id").alias("k"), F.lit("late").alias("v"))
    commit = V.Commit.commit

    def overtaken(self):
        monkeypatch.setattr(V.Commit, "commit", commit)
        Store(spark, f"file://{tmp_path}/store", "k", ["v"]).put(spark.createDataFrame([(4, "now")], "k long, v string"), now=2)
        return commit(self)

    monkeypatch.setattr(V.Commit, "commit", overtaken)
    with pytest.raises(Conflict):
        s.sync(late, now=3)
    assert held(s)[4][0] == "now" and held(s)[5][0] == "a" and s.table("changes") is None
    assert s.sync(late, now=3)["update"] == 20


# ---- merge on read ----


def test_changes_are_written_in_proportion(spark, tmp_path):
    s = store(spark, tmp_path, 60_000, 8)
    base = size(s, "data")
    for change in (lambda: s.add_tag("x", ids(spark, *range(10))), lambda: s.set_hash(ids(spark, 5).withColumn("hash", F.lit("h"))), lambda: s.delete(ids(spark, 7), now=2), lambda: s.add_tag("all"), lambda: s.retag(lambda t: F.array_union(t, F.array(F.lit("z"))), ids(spark, 1))):
        before = size(s, "data")
        change()
        assert size(s, "data") - before < base / 20
    few = spark.createDataFrame([(k, "b") for k in range(20, 40)], "k long, v string")
    before = size(s, "data")
    assert s.sync(few, now=3, full=False)["update"] == 20 and size(s, "data") - before < base / 10
    got = held(s)
    assert len(got) == 59_999 and got[1][1] == ["all", "x", "z"] and got[5][2] == "h" and got[25] == ("b", ["all"], got[25][2]) and got[59_999][1] == ["all"]
    assert s.versions.compact({"rows": list(range(8))})
    assert held(s) == got and s.versions.manifest()["patches"]["rows"] == [] and not any(e["deltas"] for e in s.versions.manifest()["buckets"]["rows"].values())


@pytest.mark.parametrize("seed", range(3))
def test_any_changes_equal_a_dictionary(spark, tmp_path, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(V, "MOST_DELTAS", 3)
    monkeypatch.setattr(V, "MOST_PATCHES", 2)
    s, want = store(spark, tmp_path, 12, 3), None
    want = held(s)
    for step in range(10):
        some = rng.sample(range(15), 3)
        op = rng.choice(["put", "delete", "tag", "untag", "replace", "all", "hash", "sync"])
        if op == "put":
            s.put(spark.createDataFrame([(k, f"p{step}") for k in some], "k long, v string"), now=step)
        elif op == "delete":
            s.delete(ids(spark, *some), now=step)
            want = {k: x for k, x in want.items() if k not in some}
        elif op == "tag":
            s.add_tag(f"t{step % 3}", ids(spark, *some))
            want = {k: (v, sorted({*t, f"t{step % 3}"}), h) if k in some else (v, t, h) for k, (v, t, h) in want.items()}
        elif op == "untag":
            s.remove_tag("t1")
            want = {k: (v, [x for x in t if x != "t1"], h) for k, (v, t, h) in want.items()}
        elif op == "replace":
            s.replace_tag("t0", "t9")
            want = {k: (v, sorted({"t9" if x == "t0" else x for x in t}), h) for k, (v, t, h) in want.items()}
        elif op == "all":
            s.add_tag(f"all{step}")
            want = {k: (v, sorted({*t, f"all{step}"}), h) for k, (v, t, h) in want.items()}
        elif op == "hash":
            s.set_hash(spark.createDataFrame([(k, f"h{step}") for k in some], "k long, hash string"))
            want = {k: (v, t, f"h{step}") if k in some else (v, t, h) for k, (v, t, h) in want.items()}
        else:
            s.sync(spark.createDataFrame([(k, f"s{step}") for k in some], "k long, v string"), now=step, full=False)
        got = held(s)
        if op in ("put", "sync"):  # values and tags by the model, hashes as they are
            name = op[0] + str(step)
            want |= {k: (name, [] if op == "put" or k not in want else want[k][1], got[k][2]) for k in some}
        assert got == want, (step, op)
    assert {b: len(e["deltas"]) for b, e in s.versions.manifest()["buckets"]["rows"].items() if len(e["deltas"]) > 8} == {}


def test_a_compaction_keeps_changes_that_come_meanwhile(spark, tmp_path):
    s = store(spark, tmp_path)
    s.add_tag("x", ids(spark, 1, 2))
    c = s.versions.begin()
    c.fold("rows", [0, 1, 2, 3])
    s.add_tag("y", ids(spark, 2))
    s.add_tag("all")
    c.commit()
    assert held(s)[2][1] == ["all", "x", "y"] and held(s)[3][1] == ["all"]
    late = s.versions.begin()
    late.fold("rows", [0, 1, 2, 3])
    s.versions.commit({"rows": (s.read().where("k < 5"), "k", None)})
    with pytest.raises(Conflict):
        late.commit()
    assert len(held(s)) == 5


def test_many_commits_leave_a_bounded_store(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}/v", 1)
    row = spark.createDataFrame([(1, 2)], "k int, n int").coalesce(1).cache()
    v.commit({"t": (row, "k", None)}, {"log": row})
    sizes = []
    for n in range(60):
        c = v.begin()
        c.append("log", row)
        c.patch_all("t", "none", [])
        c.commit()
        v.patches["none"] = ("n", lambda value, a: value)
        v.upkeep()
        sizes.append(len(v.manifest()["logs"]["log"]))
    assert max(sizes) <= 2 * V.FANOUT + 1 and v.read("log").count() == 61 and len(v.manifest()["patches"]["t"]) <= V.MOST_PATCHES + 1
    v.retain(3, grace_ms=0)
    assert len(v.numbers()) == 3 and v.read("log").count() == 61 and v.read("t").count() == 1
    assert len(v._fs.listStatus(v._path("data"))) <= 2 * V.FANOUT + 8


def test_files_of_a_commit_under_way_are_not_pruned(spark, tmp_path):
    s = store(spark, tmp_path)
    c = s.versions.begin()
    c.put("rows", s.prepared(spark.createDataFrame([(99, "z")], "k long, v string"), 2))
    s.add_tag("x")
    s.retain(2)
    c.commit()
    assert held(s)[99][0] == "z" and held(s)[1][1] == ["x"]


def test_buckets_double(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path, 400, 2)
    s.add_tag("x", ids(spark, 1))
    before = held(s)
    other = s.versions.begin()
    other.put("rows", s.prepared(spark.createDataFrame([(1000, "z")], "k long, v string"), 2))
    monkeypatch.setattr(V, "BUCKET_BYTES", size(s, "data") // 8)
    assert s.versions.grow() and s.versions.buckets >= 8 and held(s) == before
    with pytest.raises(Conflict):  # its files are dealt to the old buckets
        other.commit()
    assert Store(spark, f"file://{tmp_path}/store", "k", ["v"]).versions.buckets == s.versions.buckets


def test_sums_of_signed_numbers(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}/v", 3)
    part = lambda *rows: spark.createDataFrame(rows, "term string, n long")
    for rows in ([("a", 2), ("b", 1)], [("a", -1), ("c", 4)], [("b", -1), ("a", 5)]):
        c = v.begin()
        c.add("counts", part(*rows), "term")
        c.commit()
    want = [("a", 6), ("c", 4)]
    assert sorted(map(tuple, v.read("counts").collect())) == want
    assert v.compact({"counts": [0, 1, 2]}) and sorted(map(tuple, v.read("counts").collect())) == want


def test_document_counts_move_in_proportion(spark, tmp_path):
    s = texts.TextStore(spark, f"file://{tmp_path}/t", counts=analytics.term_counts, buckets=4)
    rng = random.Random(2)
    words = [f"word{k}" for k in range(4000)]
    every = [(k, " ".join(rng.choices(words, k=80)), "json") for k in range(1500)]

    def sync(rows, now):
        found = spark.createDataFrame(rows, "doc_id long, text string, source string")
        records = s.read().select("doc_id").unionByName(found.select("doc_id")).distinct().select("doc_id", F.lit(1).alias("data_created"))
        s.sync(texts.text_plan(records, s.read().select("doc_id", "hash"), found, "doc_id"), now=now)

    sync(every[:1480], 1)
    s.update_term_counts()
    assert s.update_doc_counts() == 1480
    base = size(s, "data")
    sync(every[1480:], 2)
    s.update_term_counts()
    before = size(s, "data")
    assert s.update_doc_counts() == 1500
    assert size(s, "data") - before < base / 15
    changed = [(k, "word1 other", "json") for k in range(5)]
    sync(changed, 3)  # counted ones change, and change again before they are counted
    s.update_term_counts()
    sync([(k, "word2 third", "json") for k in range(3)], 4)
    s.update_term_counts()
    assert s.update_doc_counts() == 1500
    want = {r.term: r.n_docs for r in analytics.document_counts(s.read("term_counts")).collect()}
    assert {r.term: r.n_docs for r in s.read("doc_counts").collect()} == want
    assert want["third"] == 3 and want["other"] == 2 and s.update_doc_counts(wipe=True) == 1500
    assert {r.term: r.n_docs for r in s.read("doc_counts").collect()} == want


def test_doubled_buckets_refer_to_the_files_of_the_old_ones(spark, tmp_path, monkeypatch):
    s = store(spark, tmp_path, 60, 2)
    s.put(spark.createDataFrame([(k, f"new{k}") for k in range(50, 70)], "k long, v string"), now=2)
    s.add_tag("x", ids(spark, 1, 2, 3, 60))
    s.delete(ids(spark, 4, 61), now=3)
    before, files = held(s), {str(p) for p in (tmp_path / "store" / "data").rglob("*.parquet")}
    for _ in range(2):  # and again, from buckets that share files
        monkeypatch.setattr(V, "BUCKET_BYTES", sum(e["bytes"] + sum(d["bytes"] for d in e["deltas"]) for e in s.versions.manifest()["buckets"]["rows"].values()) // (s.versions.buckets * 2) + 1)
        assert s.versions.grow()
    assert s.versions.buckets == 8 and held(s) == before
    assert {str(p) for p in (tmp_path / "store" / "data").rglob("*.parquet")} == files
    for b in range(8):
        own = {r.k for r in s.versions.read("rows", buckets=[b]).collect()}
        assert own == {r.k for r in s.read().where(s.versions.bucket("k") == b).select("k").collect()}
    monkeypatch.setattr(V, "BUCKET_BYTES", 512 << 20)
    s.delete(ids(spark, 5, 62), now=4)
    s.put(spark.createDataFrame([(6, "again"), (99, "late")], "k long, v string"), now=5)
    s.add_tag("y", ids(spark, 7))
    want = {k: x for k, x in before.items() if k not in (5, 62)}
    want[6], want[99], want[7] = ("again", []), ("late", []), (before[7][0], ["y"])
    plain = lambda: {k: x if k not in (6, 7, 99) else x[:2] for k, x in held(s).items()}
    assert plain() == want
    assert s.versions.compact({"rows": [1, 2, 7]}) and plain() == want  # some have files of their own by now
    assert s.versions.compact({"rows": list(range(8))}) and plain() == want
    v = Versions(spark, f"file://{tmp_path}/sums", 2)
    for part in ([("a", 2), ("b", 1), ("c", 1)], [("a", -1), ("c", -1), ("d", 4)]):
        c = v.begin()
        c.add("counts", spark.createDataFrame(part, "term string, n long"), "term")
        c.commit()
    monkeypatch.setattr(V, "BUCKET_BYTES", 1)
    assert v.grow() and v.compact({"counts": [0, 3]})
    assert sorted(map(tuple, v.read("counts").collect())) == [("a", 1), ("b", 1), ("d", 4)]


def test_files_of_new_keys_are_not_folded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "AT_LEAST", 0)
    v = Versions(spark, f"file://{tmp_path}/v", 2)
    for k in range(3):
        c = v.begin()
        c.put("t", spark.createDataFrame([(10 * k + j, j) for j in range(10)], "k long, n int"), "k", fresh=True)
        c.commit()
    assert v.due() == {} and v.read("t").count() == 30
    c = v.begin()
    c.drop("t", spark.createDataFrame([(j,) for j in range(10)], "k long"))
    c.commit()
    assert v.due() and v.read("t").count() == 20
    v.upkeep()
    assert v.read("t").count() == 20 and not any(e["deltas"] for e in v.manifest()["buckets"]["t"].values())


@pytest.mark.parametrize("listed", [0, 2_000_000])
def test_artefacts_are_written_where_their_texts_are_read(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(V, "PLACED", 0)
    monkeypatch.setattr(texts, "LISTED", listed)
    s = texts.TextStore(spark, f"file://{tmp_path}/t", counts=analytics.term_counts, buckets=2)
    write, placed = s.versions._write, []
    monkeypatch.setattr(s.versions, "_write", lambda rows, key, at=False: placed.append((tuple(rows.columns), at)) or write(rows, key, at))
    every = [(k, f"all w{k % 3} u{k}" if k else "--") for k in range(9)]
    for some in (every[:5], every):
        found = spark.createDataFrame(some, "doc_id long, text string").withColumn("source", F.lit("json"))
        s.sync(texts.text_plan(found.select("doc_id", F.lit(0).alias("data_created")), s.read(), found, "doc_id"), now=1)
        s.update_term_counts()
        assert s.update_doc_counts() == len(some) - 1
    s.update_tfidf()
    want = sorted(map(tuple, analytics.tfidf(analytics.term_counts(spark.createDataFrame(every, "doc_id long, text string"))).collect()))
    assert sorted(map(tuple, s.read("tfidf").collect())) == want and s.read("term_counts").columns == ["doc_id", "term", "count"]
    own = [at for columns, at in placed if columns == ("doc_id", "term", "count", "total")]
    assert own == ([True, True] if listed else [True, False]) and not any("epoch" in c and "word" in c for c, _ in placed)
    assert s.versions.read("pending").count() == 0
