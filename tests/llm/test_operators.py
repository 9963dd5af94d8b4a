"""Each operator against a brute-force version, over rows chosen to be awkward: nulls, empty and long texts, ties, repeats, clashing names."""

import gzip
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import common, jaccard_join, license_scan, line_dedup, mixing, neighbour_graph, quality_model, quality_rules, sentencepiece_bpe, suffix_dedup, warc
from quern.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KIND = "doc_id long, text string, lang string, source string, n_chars long, label int, row string, h long"


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = words(rng, 120)
    passage = " ".join(words(rng, 60))
    out = [None, "", " \n\t ", "one", "a b c", "a b c", "A  b\nC", "same words here now", "same words here now"]
    for k in range(40):  # near copies of one text: some pairs link, some do not
        w = list(base)
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    out += [" ".join(words(rng, 30)) + " " + passage + " " + " ".join(words(rng, 30)) for _ in range(15)]
    out += ["a common line of text\n" + " ".join(words(rng, 20)) + "\n  A COMMON line of text \nshort" for _ in range(6)]
    out += ["läufer über straße " * 30, "ab" * 3000, "x" * 700, "x" * 640 + "y", " ".join(words(rng, 6000)), "▁ \x00 \U0001f600 é é", "Released under the MIT License.\nok"]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k * 3 % 1009, t, "en", ["b", "a", None, "c"][k % 4], None, 1, "r", 7) for k, t in enumerate(texts)]
    rows.append((None, texts[20], "en", "a", 5, None, None, None))
    rows += [rows[21], (66, texts[40], "de", None, 2, None, "x", 1), (9, "", "en", "c", 0, 2, "r", None)]  # ids that repeat: a whole row, another text, an empty one
    return spark.createDataFrame(rows, KIND).repartition(5).cache()


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], KIND)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(name, compare):
    compare(name, QUERIES, ORACLE)


# ---- 1 ----


def shingles(text, size):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(text or "")]
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def linked_components(rows, size, percent):
    sets = [(d, shingles(t, size)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


@pytest.mark.parametrize(("size", "percent", "split", "block"), [(4, 85, 12, 128), (5, 80, 2, 8)])
def test_jaccard_components(docs, plain, size, percent, split, block):
    out = jaccard_join.jaccard_components(docs, size=size, percent=percent, filter_bits=1 << 16, sketch_bits=12, split_above=split, block=block)
    assert sorted(map(tuple, out.collect()), key=str) == linked_components(plain, size, percent)


def test_one_of_each_keeps_the_smallest(docs, plain):
    keep = {d for d, _, c in linked_components(plain, 5, 80) if d == c}
    out = jaccard_join.one_of_each(docs, filter_bits=1 << 16, sketch_bits=12)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == keep


def test_jaccard_of_nothing(nothing):
    assert jaccard_join.jaccard_components(nothing, filter_bits=1 << 16, sketch_bits=12).count() == 0


def test_prefixes_of_similar_sets_meet():
    rng = np.random.RandomState(3)
    order = jaccard_join.Order(rng.randint(0, 256, 1 << 7).astype(np.uint8), rng.randint(0, 90, 1 << 10).astype(np.uint16), 10)
    linked = 0
    for _ in range(400):
        a = np.unique(rng.randint(0, 2**63, rng.randint(1, 60)).astype(np.uint64))
        keep = rng.rand(len(a)) < 0.92
        b = np.unique(np.concatenate([a[keep], rng.randint(0, 2**63, rng.randint(0, 4)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not both or 100 * both < 85 * (len(a) + len(b) - both):
            continue
        linked += 1
        for k, (x, y) in enumerate(zip(order.keys(a), order.keys(b), strict=True)):
            p, q = a[jaccard_join.prefix(x, 85)].tolist(), b[jaccard_join.prefix(y, 85)].tolist()
            shared = [t for t in p if t in q]
            assert shared
            if k == 0:  # the first shared token passes the test of places
                assert (100 + 85) * min(len(a) - p.index(shared[0]), len(b) - q.index(shared[0])) >= 85 * (len(a) + len(b))
    assert linked > 100


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.node, r.label) for r in common.components(edges).collect()} == {(k, 0) for k in range(61)} | {(100, 100), (101, 100)}


def test_filters_merged_in_one_or_two_steps(spark, monkeypatch):
    rng = np.random.RandomState(7)
    docs_ = [np.unique(rng.randint(0, 3000, 40)).astype(np.uint64) for _ in range(120)]
    seen = Counter(h for d in docs_ for h in d.tolist())
    rows = spark.createDataFrame([(d.tolist(),) for d in docs_], "hashes array<long>").repartition(9)
    bits = 1 << 14

    def filters(batches):
        f = common.TwiceFilter(bits, 100)
        for batch in batches:
            for x in batch.column(0):
                f.add(common.mix(x.values.to_numpy().astype(np.uint64)))
        yield f.slices()

    found = []
    for most in (256, 2):
        monkeypatch.setattr(common, "MERGE_AT_ONCE", most)
        twice = common.merged_twice(rows.mapInArrow(filters, "slice int, data binary"), bits)
        hit = common.in_bloom(twice, common.mix(np.arange(3000).astype(np.uint64)))
        assert all(hit[h] for h, n in seen.items() if n > 1) and 0 < (~hit).sum()
        ids = common.id_filter(spark.range(0, 5000, 7).repartition(5).select("id"), 1 << 16)
        inside = common.in_filter(np.arange(5000), ids)
        assert inside[::7].all() and inside.sum() < 1200
        found.append((hit.tolist(), inside.tolist()))
    assert found[0][1] == found[1][1]


def test_hot_keys_are_joined_whole(spark, monkeypatch):
    rows = spark.range(30_000).select(F.when(F.col("id") < 15_000, 1).otherwise(F.col("id") % 3000).alias("k"), "id")
    table = rows.where("k <> 5").groupBy("k").agg(F.count("*").alias("held"), F.min("id").alias("least"))
    out = common.split_join(rows, table, "k", "held")
    assert out.count() == rows.where("k <> 5").count() and out.where("k = 1").select("least").distinct().count() == 1
    assert "BroadcastHashJoin" in out._jdf.queryExecution().toString()


# ---- 2 ----


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(2)
    big = "".join(rng.choice("abcdefghij \n") for _ in range(400_000))
    rows = [(1, "http://a/1", "p" * 120), (5, "http://a/5 x\n", "p" * 120), (3, None, "p" * 120), (2, "u", "p" * 99), (4, "u", "p" * 99), (6, "u", None), (7, "u", ""), (8, "u", "é" * 50), (9, "u", "é" * 50), (None, "u", "p" * 120), (10, "u", big), (11, "u", big), (1, "again", "p" * 120)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_warc_round_trip(pages):
    written = warc.write_warc(pages)
    for split in (1 << 22, 301):
        got = sorted(((r.key, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in warc.read_warc(written, split=split).collect()), key=str)
        want = []
        first = {}
        for r in pages.collect():
            b = (r.html or "").encode()
            if len(b) >= 100 and r.page_id is not None:
                first[b] = min(first.get(b, r.page_id), r.page_id)
        for r in pages.collect():
            b = (r.html or "").encode()
            again = b in first and r.page_id is not None and r.page_id > first[b]
            want.append((None if r.page_id is None else str(r.page_id), len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", str(first[b]) if again else None))
        assert got == sorted(want, key=str)
    back = warc.read_warc(written).collect()
    payloads = {r.key: bytes(r.payload) for r in back if r.type == "response"}
    assert payloads["6"] == b"" and len(payloads["10"]) == 400_000
    assert len({r.record_id for r in back}) == len(back)


def test_warc_long_targets_and_clashing_names(spark):
    """Headers longer than a piece are read whole; extra columns of any name do no harm."""
    urls = {1: "http://a/" + "x" * 300_000, 2: "http://b/" + "y " * 300_000, 3: "z" * 70_000, 4: "u"}
    rows = spark.createDataFrame([(k, u, "p" * 200, "k", 5, None) for k, u in urls.items()], "page_id long, url string, html string, k string, again int, first string").repartition(2)
    written = warc.write_warc(rows)
    for split in (1 << 22, 100):
        got = {r.key: (r.uri, r.refers_to, r.payload_bytes) for r in warc.read_warc(written, split=split).collect()}
        assert got == {str(k): (u.replace(" ", "%20"), None if k == 1 else "1", 200) for k, u in urls.items()}


def test_warc_reader_owns_what_starts_in_its_range(tmp_path):
    rng = random.Random(4)
    members = [warc.record(k, "u", bytes(rng.randrange(256) for _ in range(rng.randrange(3000))) + warc.MAGIC + b"x", "d") for k in range(20)]
    fake = gzip.compress(b"not a record") + warc.MAGIC + b"\x00" * 20
    data = b"".join(members[:10]) + fake + b"".join(members[10:])
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    for split in (len(data), 1000, 37):
        seen = []
        with path.open("rb") as handle:
            for start in range(0, len(data), split):
                seen += [r["key"] for _, r in warc.records_in(warc._Source(handle, len(data)), start, min(start + split, len(data)), True)]
        assert seen == [str(k) for k in range(20)]


def test_records_that_are_lost_are_noticed(spark):
    """A member whose bytes are broken is not read; read_whole says so, read_warc gives the others."""
    rows = spark.createDataFrame([(k, f"http://x/{k}", f"<p>{k}</p>" * 40) for k in range(12)], "page_id long, url string, html string").coalesce(1)
    written = warc.write_warc(rows)
    assert warc.read_whole(written).count() == 12
    with pytest.raises(ValueError, match="12 of 13"):
        warc.read_whole(written.withColumn("records", F.col("records") + 1))
    path = written.first().path.removeprefix("file:")
    data = bytearray(open(path, "rb").read())
    at = [m.start() for m in re.finditer(re.escape(warc.MAGIC), bytes(data))][5]
    data[at + 20 : at + 30] = b"\xff" * 10
    open(path, "wb").write(bytes(data))
    crc = __import__("pathlib").Path(path)
    (crc.parent / f".{crc.name}.crc").unlink(missing_ok=True)
    assert warc.read_warc(written).count() == 11
    with pytest.raises(ValueError, match="11 of 12"):
        warc.read_whole(written)


def test_warc_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(empty)).count() == 0


# ---- 3 ----


def line_key(x):
    return x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def lines_of(rows):
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if d is not None and len(line_key(x)) >= 10:
                held[line_key(x)].add(d)
    out = []
    for d, t in rows:
        ls = (t or "").split("\n")
        stay = [x for x in ls if d is None or len(held.get(line_key(x), ())) < 2 or min(held[line_key(x)]) == d]
        out.append((d, "\n".join(stay), len(ls), len(ls) - len(stay)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [1 << 27, 1 << 12])
def test_line_dedup(docs, plain, bits):
    out = line_dedup.dedup_lines(docs, filter_bits=bits)
    assert sorted(((r.row.doc_id, r.kept, r.n_lines, r.n_dropped) for r in out.collect()), key=str) == lines_of(plain)
    same = line_dedup.deduped_documents(docs, filter_bits=bits)
    assert same.columns == docs.columns and same.where("doc_id = 0").first().text is None


def test_line_dedup_of_nothing(nothing):
    assert line_dedup.dedup_lines(nothing, filter_bits=1 << 12).count() == 0


# ---- 4 ----


def counted(t):
    t = t or ""
    w = WORD.findall(t)
    seen = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    cover = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
    ls = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(ls) - len(set(ls)), len(cover)


def test_quality_counts(docs, plain):
    got = quality_rules.judge(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got if r.doc_id is not None) == sorted((d, *counted(t)) for d, t in plain if d is not None)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)


def test_quality_rules_tell_good_from_bad(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    r = quality_rules.judge(d).where("not base_failed").select("doc_id", "kept").join(truth.withColumnRenamed("quality", "label"), "doc_id").collect()
    assert all(x.kept for x in r if x.label == 1)
    assert sum(not x.kept for x in r if x.label == 0) >= 0.8 * sum(x.label == 0 for x in r)


def test_quality_verdict_is_nearer_to_labels_than_no_bad_vote(spark):
    """Rules that look too closely: a document of many words of which one rule disapproves alone stays, agreeing rules decide."""
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    truth = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").withColumnRenamed("quality", "label")
    bad = F.greatest(*(F.when(v < 0, 1).otherwise(0) for v in quality_rules.default_rules().values())) == 1
    r = quality_rules.judge(d).where("not base_failed").withColumn("bad", bad).join(truth, "doc_id").select("kept", "bad", "label").collect()
    wrong = sum(x.kept != (x.label == 1) for x in r)
    assert wrong < sum(x.bad == (x.label == 1) for x in r) and wrong <= 0.01 * len(r)
    assert any(x.kept and x.bad for x in r) and all(x.kept for x in r if x.label == 1)


def plain_posteriors(fitted, votes, belief, finds, rounds=30, weight=4.0):
    """The label model over single documents: expectation, then maximisation with a few documents of prior, in plain loops."""
    rules, n = len(votes[0]), len(fitted)
    given = {1: {1: belief, -1: 1 - belief}, -1: {1: 1 - finds, -1: finds}}
    first = {kind: [{**given[kind], 0: 1.0}] * rules for kind in (1, -1)}

    def expected(rows, share, tables):
        out = []
        for v in rows:
            g, b = share, 1 - share
            for k, x in enumerate(v):
                g, b = g * tables[1][k][x], b * tables[-1][k][x]
            out.append(g / (g + b))
        return out

    share, tables = 0.8, first
    for _ in range(rounds):
        p = expected(fitted, share, tables)
        tables = {1: [], -1: []}
        for k in range(rules):
            rate = sum(v[k] != 0 for v in fitted) / n
            for kind, own in ((1, p), (-1, [1 - x for x in p])):
                mean = {x: rate * given[kind][x] if x else 1 - rate for x in (1, 0, -1)}
                t = {x: (sum(o for o, v in zip(own, fitted) if v[k] == x) + weight * mean[x]) / (sum(own) + weight) for x in (1, 0, -1)}
                tables[kind].append({x: y or 1.0 for x, y in t.items()} if rate else first[kind][k])
        share = (sum(p) + 1) / (n + 2)
    return expected(votes, share, tables)


@pytest.mark.parametrize("own", [False, True])
def test_quality_verdict_equals_the_plain_model(spark, own):
    rng = random.Random(12)
    texts_ = [" ".join(rng.choice(["word", "thing", "THIS", "$$", "12", "a", "!!", "other,"][: rng.choice((3, 8))]) + rng.choice("abcdefgh") for _ in range(rng.randrange(5, 60))) for _ in range(250)] + [None, ""]
    d = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    known = quality_rules.counts(d, "doc_id", "text")
    few = {"long": F.when(F.col("n_words") > 40, 1).when(F.col("n_words") < 15, -1), "calm": F.when(F.col("n_shouts") == 0, 1).otherwise(-1), "never": F.lit(0), "digits": F.when(F.col("n_digits") > 4, -1).otherwise(0)}
    rules = few if own else quality_rules.default_rules()
    votes = {r.doc_id: tuple(x or 0 for x in r[1:]) for r in known.select("doc_id", *(v.alias(n) for n, v in rules.items())).collect()}
    got = quality_rules.judge(d, rules=few if own else None).collect()
    passed = [votes[r.doc_id] for r in got if not r.base_failed]
    want = dict(zip(votes, plain_posteriors(passed, list(votes.values()), quality_rules.BELIEF, quality_rules.FINDS), strict=True))
    assert 100 < len(passed) < len(got)
    for r in got:
        assert abs(r.quality - want[r.doc_id]) < 1e-9 and r.kept == (not r.base_failed and r.quality >= 0.5)


def test_quality_counts_of_the_rules(spark):
    rows = [(0, "a a b\n\nB3 ??! ## x#\n"), (1, None), (2, " \n"), (3, "one")]
    got = quality_rules.counts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").orderBy("doc_id")
    names = ["n_lines", "n_upper", "n_digits", "n_symbol_words", "n_symbol_runs", "n_shouts", "n_stutter", "n_distinct"]
    assert [tuple(r) for r in got.select(*names).collect()] == [(4, 1, 1, 2, 1, 1, 1, 6), (1, 0, 0, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0, 0, 0), (1, 0, 0, 0, 0, 0, 0, 1)]


def test_quality_rules_are_bounded(docs):
    with pytest.raises(ValueError):
        quality_rules.judge(docs, rules={f"r{k}": F.lit(1) for k in range(12)})


@pytest.mark.parametrize("right", [(0.95, 0.60, 0.55, 0.90), (0.9, 0.7, 0.55, 0.8)])
def test_label_model_moves_away_from_its_belief(right):
    rng = random.Random(3)
    votes = Counter()
    for _ in range(40_000):
        good = rng.random() < 0.6
        votes[tuple((1 if good == (rng.random() < a) else -1) if rng.random() < 0.9 else 0 for a in right)] += 1
    e = quality_rules.Estimate(sorted(votes.items()), 4, rounds=200)
    assert all(abs(a - b) < 0.05 for a, b in zip(e.accuracy, right, strict=True)), e.accuracy


def test_label_model_recovers_accuracies():
    rng = random.Random(1)
    votes = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.7
        votes[tuple((1 if good == (rng.random() < a) else -1) if rng.random() < 0.8 else 0 for a in (0.95, 0.9, 0.85, 0.9))] += 1
    e = quality_rules.Estimate(sorted(votes.items()), 4, belief=0.9)
    assert abs(e.prior - 0.7) < 0.05 and all(abs(a - b) < 0.05 for a, b in zip(e.accuracy, (0.95, 0.9, 0.85, 0.9), strict=True))


def test_label_model_finds_a_rule_that_guesses():
    rng = random.Random(2)
    votes = Counter()
    for _ in range(20_000):
        good = rng.random() < 0.95
        votes[tuple(1 if good == (rng.random() < a) else -1 for a in (0.95, 0.95, 0.95, 0.5))] += 1
    e = quality_rules.Estimate(sorted(votes.items()), 4)
    assert abs(e.prior - 0.95) < 0.02 and all(abs(a - b) < 0.03 for a, b in zip(e.accuracy, (0.95, 0.95, 0.95, 0.5), strict=True))
    few = quality_rules.Estimate([((1, 0), 3), ((0, 0), 5)], 2)
    assert few.accuracy[1] == 0.97 and all(0 < a < 1 for a in few.accuracy)


def test_quality_rules_of_nothing(nothing):
    assert quality_rules.judge(nothing).count() == 0


# ---- 5 ----


def test_classifier_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    r = quality_model.classify(d, truth).join(truth, "doc_id").where("held_out").collect()
    assert len(r) > 40 and sum(x.predicted == x.quality for x in r) >= 0.95 * len(r)


def plain_stats(text):
    """The statistics of one text, character class by character class."""
    b = (text or "").encode()
    if not b:
        return [0.0] * len(quality_model.STATS)
    space, count = set(b" \t\n\x0b\x0c\r"), lambda chars: sum(x in chars for x in b)
    ink = max(1, len(b) - count(space))
    w = [re.sub(rb"[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(rb"[^\x20\x09-\x0D]+", b)]
    m, lines = len(w), [x for x in b.split(b"\n") if x.strip()]
    windows = Counter(tuple(w[k : k + 5]) for k in range(max(1, m - 4))) if m else Counter()
    words = Counter(w)
    marked = sum(x in b"#*$%&|<>@^~{}[]\\=+_/!?" and y in space for x, y in zip(b, b[1:]))
    return [
        np.log1p(m), ink / max(m, 1), count(b"#*$%&|<>@^~{}[]\\=+_/") / ink, count(range(65, 91)) / ink, count(b"0123456789") / ink, count(b",;:'\"()-`") / ink, count(range(128, 256)) / ink, np.log1p(len(b) / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)), sum(n for n in windows.values() if n > 1) / max(1, sum(windows.values())), np.log1p(max(1, len(words))) / np.log1p(max(m, 1)), max(words.values(), default=0) / max(m, 1), marked / max(m, 1), ink / max(m, 1) > 12, count(space) / len(b), count(b"!?.") / max(m, 1),
    ]


def test_text_statistics(texts):
    for t in [*texts, "Ab! Ab? x_ y. \n\n#tag # 12 !\nAb! Ab?", "a\na\nb a a a a a a"]:
        assert np.allclose(quality_model.text_stats(np.frombuffer((t or "").encode(), np.uint8)), plain_stats(t)), t


def test_features_approximate_a_gaussian_kernel():
    rng = np.random.RandomState(1)
    x = rng.normal(size=(40, len(quality_model.STATS)))
    m = quality_model.Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), width=40_000)
    f = m.features(x)[:, :-1]
    exact = np.exp(-0.06 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(f @ f.T - exact).max() < 0.03


def test_fit_equals_normal_equations_in_one_piece(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    stats = quality_model.measured(d.repartition(7), "doc_id", "text")
    model = quality_model.fit(stats, truth.repartition(3))
    y = {r.doc_id: float(r.quality) for r in truth.collect()}
    rows = [(r.doc_id, np.array(r.stats)) for r in stats.collect() if r.doc_id in y]
    fold = lambda k: __import__("zlib").crc32(str(k).encode()) % 5
    x, goal = np.array([v for k, v in rows if 1 <= fold(k) <= 3]), np.array([y[k] for k, _ in rows if 1 <= fold(k) <= 3])
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale, np.sqrt(np.maximum(x.var(0), 1e-4)))
    f = model.features(x)
    ridge = 1e-3 * len(x) * np.diag([1.0] * (f.shape[1] - 1) + [1e-9])
    assert np.allclose(f @ np.linalg.solve(f.T @ f + ridge, f.T @ goal), f @ model.coef, atol=1e-6)
    held, truth_of_held = np.array([v for k, v in rows if fold(k) == 4]), np.array([y[k] for k, _ in rows if fold(k) == 4])
    place = np.clip((model.raw(held) + 0.5) / 2 * 2000, 0, 1999).astype(int)
    bins = sorted(set(place))
    n, good = np.array([(place == b).sum() for b in bins]), np.array([truth_of_held[place == b].sum() for b in bins])
    assert np.allclose(model.y, np.clip(minimax(n, good / n), 0.001, 0.999))


def minimax(w, v):
    """The monotone fit by its definition: the greatest of the least means."""
    mean = lambda j, k: float(np.dot(w[j : k + 1], v[j : k + 1]) / np.sum(w[j : k + 1]))
    n = len(v)
    return [max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]


def test_isotonic_equals_its_definition():
    rng = np.random.RandomState(0)
    for n in (1, 2, 7, 25):
        w, v = rng.randint(1, 5, n), np.round(rng.rand(n), 1)
        assert np.allclose(quality_model.isotonic(w, v), minimax(w, v))


def test_classifier_takes_labels_with_clashing_names(spark, docs):
    labels = spark.createDataFrame([(k * 3, k % 2, "t", 5) for k in range(40)], "doc_id long, quality int, text string, row int")
    got = quality_model.classify(docs.withColumn("stats", F.lit(1)).withColumn("quality", F.lit("x")).withColumn("fold", F.lit(2)), labels)
    want = quality_model.classify(docs, labels)
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in got.collect()) == sorted((str(r.doc_id), round(r.score, 9)) for r in want.collect())


def test_classifier_cases(spark, docs, nothing):
    labels = spark.createDataFrame([(0, 1), (3, 0), (3, None), (6, 1), (None, 1)], "doc_id long, quality int")
    r = quality_model.classify(docs, labels).collect()
    assert len(r) == docs.count() and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in r)
    assert all(x.score == 0.5 for x in quality_model.classify(docs, labels.limit(0)).collect())
    assert quality_model.classify(nothing, labels).count() == 0
    assert quality_model.accepted(docs, labels.limit(0)).columns == docs.columns


# ---- 6 ----


def test_license_cases(spark, docs, nothing):
    t = license_scan.TEMPLATES
    rows = [(1, t["mit-text"].replace(" and ", "\nand ")), (2, "x\n\n" + t["gpl-3.0-header"] + "\n\ny"), (3, "released under the mit license"), (4, "under license"), (5, None), (6, t["apache-2.0"] + "\n" + t["apache-2.0"])]
    got = {r.doc_id: (r.licence, r.n_units, r.licences) for r in license_scan.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    assert got[1][0] == "mit-text" and got[2][0] == "gpl-3.0-header" and got[3][0] == "mit" and got[4] == (None, 0, []) and got[5] == (None, 0, []) and got[6] == ("apache-2.0", 3, ["apache-2.0"])
    assert license_scan.scan(docs).where("licence = 'mit'").count() == 1 and license_scan.scan(nothing).count() == 0


def test_prefilter_has_the_borders_of_the_normal_form(spark):
    rows = [(1, "_All rights reserved_"), (2, "Released_under_the_MIT_License"), (3, "licensed under cc by 4.0x"), (4, "2.0released under the_mit_license"), (5, "unreserved")]
    got = {r.doc_id: r.licence for r in license_scan.scan(spark.createDataFrame(rows, "doc_id int, text string"), templates={k: license_scan.TEMPLATES[k] for k in ("all-rights-reserved", "mit", "cc-by-4.0")}).collect()}
    assert got == {1: "all-rights-reserved", 2: "mit", 3: "cc-by-4.0", 4: "mit", 5: None}
    rng = random.Random(3)
    words_ = ["4.0", "reserved", "mit", "2.0"]
    pattern = re.compile(license_scan.anchor_pattern(words_), re.A)
    for _ in range(20_000):
        text = "".join(rng.choice(["4.0", "reserved", "MIT", "2.0", "_", ".", "x", "7", " ", "é"]) for _ in range(rng.randrange(1, 7)))
        assert pattern.search(text) or not set(words_) & set(license_scan.plain_words(text)), text


def test_embedded_and_wrapped_notices(spark):
    t = license_scan.TEMPLATES
    rng = random.Random(8)
    around = lambda x: " ".join(words(rng, 40)) + " " + x + " " + " ".join(words(rng, 40))
    rows = {
        1: ("Copyright (c) 2024 Foo Inc. All rights reserved.", ["all-rights-reserved"]),
        2: ("Some text here. Released under the MIT License. More text follows on this line.", ["mit"]),
        3: (around(t["gpl-3.0-header"].replace(" ", "\n", 30)), ["gpl-3.0-header"]),
        4: (around("Licensed under the Apache License,\n\nVersion 2.0."), ["apache-2.0"]),
        5: (around(t["cc-by-sa-4.0-long"]), ["cc-by-sa-4.0-long"]),
        6: (around(t["isc"]) + "\n\n" + around(t["mit"]), ["isc", "mit"]),
        7: (around("a version of this license that is released under other rights"), []),
        8: (None, []),
        9: ("reserved", []),
    }
    got = {r.doc_id: sorted(x.name for x in r.embedded) for r in license_scan.scan(spark.createDataFrame([(k, x) for k, (x, _) in rows.items()], "doc_id int, text string")).collect()}
    assert got == {k: names for k, (_, names) in rows.items()}


def test_anchor_words_are_in_every_match():
    rng = random.Random(6)
    for text in license_scan.TEMPLATES.values():
        w = license_scan.plain_words(text)
        own, anchors = set(license_scan.bigrams(w)), license_scan.anchor_words(w, 0.8)
        for _ in range(300):
            other = [x for x in w if rng.random() > 0.1] + [f"z{k}" for k in range(rng.randrange(3))]
            grams = set(license_scan.bigrams(other))
            if grams and 2 * len(own & grams) >= 0.8 * (len(own) + len(grams)):
                assert anchors & set(other)


def test_windows_of_long_texts_in_linear_time(spark):
    """A megabyte of one licence, and near copies with words replaced: the best window is found, and twice the text takes no more than some twice the time."""
    import time

    text = license_scan.TEMPLATES["bsd-3-clause"]
    rng = random.Random(1)
    near = " ".join(w if rng.random() < 0.93 else f"zz{rng.randrange(99)}" for w in (text + " ") .split() * 8)
    scan = lambda t: license_scan.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).collect()[0]
    scan(text)
    took = []
    for n in (700, 1500):
        began = time.time()
        assert {(x.name, x.dice) for x in scan((text + " ") * n).embedded} == {("bsd", 1.0), ("bsd-3-clause", 1.0)}
        took.append(time.time() - began)
    assert took[1] < 4 * took[0] + 5
    words = license_scan.plain_words(near)
    grams = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    own = set(license_scan.bigrams(license_scan.plain_words(text)))
    reach = int(len(own) * 1.5 + 1e-9)
    best = max((2 * len(own & set(grams[i : j + 1])) / (len(set(grams[i : j + 1])) + len(own)) for i in range(len(grams)) if grams[i] in own for j in range(i, min(i + reach, len(grams))) if grams[j] in own and j > i + 60), default=0)
    got = {x.name: x.dice for x in scan(near).embedded}
    assert best >= 0.8 and got["bsd-3-clause"] == best


def test_ties_of_licences_go_to_the_smaller_name(spark):
    same = {"z": "one two three four", "a": "one two three four", "m": "other words here now"}
    r = license_scan.scan(spark.createDataFrame([(1, "one two three four"), (2, "x\none two three four\nother words here now")], "doc_id long, text string"), templates=same)
    got = {x.doc_id: (x.licence, x.n_units, x.licences, [e.name for e in x.embedded]) for x in r.collect()}
    assert got == {1: ("a", 1, ["a"], ["a", "z"]), 2: ("a", 2, ["a", "m"], ["a", "m", "z"])}


# ---- 7 ----


def test_nearest_neighbours(spark):
    rng = np.random.RandomState(0)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[700:760] = x[3]
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)]
    rows += [(5000, None, 1), (5050, [0.0] * 24, 1), (5100, [float("nan")] * 24, 1), (5150, [None] + [1.0] * 23, 1), (0, x[0].tolist(), 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    got = defaultdict(dict)
    for r in neighbour_graph.nearest(df, beam=96, expand=16).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    assert set(got) == set(range(0, 1500, 50))
    hits = 0
    for q, found in got.items():
        s = unit @ unit[q]
        s[q] = -9
        best = np.lexsort((np.arange(1500), -np.round(s, 12)))[:5]
        assert sorted(found) == [1, 2, 3, 4, 5]
        assert all(abs(s[v] - score) < 1e-9 for v, score in found.values())
        hits += len(set(best) & {v for v, _ in found.values()})
    assert hits >= 0.9 * 5 * len(got)
    assert [v for v, _ in (got[700][k] for k in range(1, 6))] == [3, 701, 702, 703, 704]


def test_recall_with_the_defaults_of_the_query(spark):
    rng = np.random.RandomState(5)
    centres = rng.normal(size=(300, 64))
    x = np.concatenate([centres[rng.randint(0, 300, 5000)] + 0.7 * rng.normal(size=(5000, 64)), rng.normal(size=(5000, 64))]).astype(np.float32)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = defaultdict(set)
    for r in neighbour_graph.nearest(df).collect():
        got[r.query_id].add(r.vec_id)
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    sims = unit[::50] @ unit.T
    sims[np.arange(200), np.arange(0, 10_000, 50)] = -9
    hits = sum(len(got[q * 50] & set(np.argsort(-row)[:5].tolist())) for q, row in enumerate(sims))
    assert hits >= 0.9 * 5 * 200


def test_nearest_with_unequal_lengths_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0], 1, 2), (50, [0.9, 0.1], 1, 2), (3, [0.0, 1.0], 1, 2), (100, [1.0], 1, 2), (4, [1.0, 0.0, 0.0], 1, 2), (5, [], 1, 2)]
    out = neighbour_graph.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int, v int")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(out)] == [(0, 1, 50), (0, 2, 3), (50, 1, 0), (50, 2, 3)]


def test_nearest_of_few(spark):
    kind = "vec_id long, embedding array<float>"
    r = neighbour_graph.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], kind)).collect()
    assert [(x.query_id, x["rank"], x.vec_id) for x in sorted(r)] == [(0, 1, 1), (0, 2, 2)]
    assert neighbour_graph.nearest(spark.createDataFrame([], kind)).count() == 0


# ---- 8 ----


def test_mixing(docs, plain):
    r = mixing.mix_sources(docs).collect()
    assert len(r) == docs.count() and all(x.copies in (0, 1, 2, 3) and x.taken == x.copies * x.size for x in r)
    total = defaultdict(int)
    taken = defaultdict(int)
    target = {}
    for x in r:
        total[x.source] += x.size
        taken[x.source] += x.taken
        target[x.source] = x.target
    weight = dict(zip(sorted((s for s in total if s is not None)) + [None], (5, 2, 1, 5), strict=True))
    want, open_ = {}, set(total)
    left = sum(total.values())
    while True:  # reshare until no source is above three times its size
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * total[s]}
        want |= {s: 3 * total[s] for s in above} if above else share
        left -= sum(3 * total[s] for s in above)
        open_ -= above
        if not above or not open_:
            break
    assert all(abs(target[s] - want[s]) < 1e-6 * max(1, want[s]) for s in total)
    assert all(abs(taken[s] - target[s]) <= max(x.size for x in r if x.source == s) for s in total)
    again = mixing.mix_sources(docs.repartition(2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, r))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() == sum(x.copies for x in r)


def test_mixing_of_nothing(nothing):
    assert mixing.mix_sources(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0


# ---- 9 ----


def drops_of(e, key):
    """The dropped places that the key of an occurrence draws, by the definition."""
    place, turn, mask = -1, 0, (1 << 64) - 1
    while e.dropout:
        x = (key + (turn + 1) * 0x9E3779B97F4A7C15) & mask
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        u = (((x ^ (x >> 31)) >> 11) + 0.5) / 2**53
        place += 1 + int(np.log(u) / np.log1p(-e.dropout))
        turn += 1
        yield place


def agenda(v, e, text, name=""):
    """Merges one by one: the best rank first, then the leftmost; candidates are counted as they come up and dropped ones passed over."""
    hash_, mask, out = __import__("xxhash").xxh3_64_intdigest, (1 << 64) - 1, []
    base = hash_(text.encode(), seed=hash_(name.encode(), seed=e.seed))
    for nth, unit in enumerate(filter(None, e.units.findall(" " + text))):
        own = int(common.mix(np.array([(base + (nth + 1) * 0x9E3779B97F4A7C15) & mask], np.uint64))[0])
        drops, seen, at, ranks = drops_of(e, own), 0, list(range(len(unit) + 1)), {}
        drop = next(drops, None)
        while True:
            for a, b in zip(at, at[2:], strict=False):
                if (a, b) not in ranks and unit[a:b] in v.ranks:
                    ranks[a, b] = None if seen == drop else v.ranks[unit[a:b]]
                    drop = next(drops) if seen == drop else drop
                    seen += 1
            best = min(((r, k) for k, x in enumerate(zip(at, at[2:], strict=False)) if (r := ranks.get(x)) is not None), default=None)
            if best is None:
                break
            del at[best[1] + 1]
        for s, t in zip(at, at[1:], strict=False):
            k = v.ids.get(unit[s:t])
            out += [k] if k is not None else [v.byte_ids[x] for x in unit[s:t].encode()]
    return out


def test_pieces(spark, docs, texts):
    import sentencepiece

    v = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.MODEL)
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.MODEL)
    rng = random.Random(9)
    odd = ["".join(rng.choice(" \n\tab.,é漢\U0001f600\"'1▁x(e)") for _ in range(rng.randrange(60))) for _ in range(300)]
    cases = [t for t in texts if t] + odd
    whole = sentencepiece_bpe.Encoder(v, 0.0, 1)
    dropped = sentencepiece_bpe.Encoder(v, 0.2, 3)
    other = sentencepiece_bpe.Encoder(v, 0.2, 4)
    for t in cases:
        if "▁" not in t:
            assert whole.encode(t) == library.encode(t)
        assert sentencepiece_bpe.decode(v, dropped.encode(t)) == t
    for t in filter(None, odd):
        assert dropped.encode(t) == agenda(v, dropped, t)
    assert any(dropped.encode(t) != other.encode(t) for t in cases)
    codec = sentencepiece_bpe.Codec(spark, dropout=0.2, seed=3)
    for r in docs.select("text", codec.decode(codec.encode(F.col("text"))).alias("back"), codec.digests(F.col("text")).alias("d")).collect():
        assert r.back == (r.text or "") and r.d.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()
    assert sentencepiece_bpe.encoded_documents(docs).columns == [*docs.columns, "pieces"]
    assert sentencepiece_bpe.encoded_documents(docs.withColumn("pieces", F.lit("old"))).select("pieces").dtypes == [("pieces", "array<int>")]


def test_a_long_word_takes_the_heap(monkeypatch):
    v = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.MODEL)
    e = sentencepiece_bpe.Encoder(v, 0.0, 2)
    unit = " " + "".join(random.Random(1).choice("theandxyz") for _ in range(600))
    long = e.segment(unit, iter(()))
    monkeypatch.setattr(sentencepiece_bpe, "HEAP_ABOVE", 10_000)
    assert e.segment(unit, iter(())) == long


def test_each_occurrence_is_drawn_for_itself(spark):
    v = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.MODEL)
    e = sentencepiece_bpe.Encoder(v, 0.1, 1)
    word, n = " information", 4000
    forms, text = Counter(), word * n
    ids, at = e.encode(text[1:], "7"), 0
    while at < len(ids):
        piece, end = b"", at
        while len(piece) < len(word):
            piece, end = piece + v.bytes[ids[end]], end + 1
        forms[tuple(ids[at:end])] += 1
        at = end
    root = e.roots[word]
    whole = forms[tuple(e.pool[e.starts[root] : e.starts[root] + e.lengths[root]].tolist())]
    assert len(forms) > 10 and whole >= 0.9 * n * 0.9 ** e.draws[root]
    assert ids == e.encode(text[1:], "7") != e.encode(text[1:], "8")
    some = e.gaps(np.arange(50_000, dtype=np.uint64), 0)
    assert abs(len(some) / (some.sum() + len(some)) - 0.1) < 0.003
    rows = spark.createDataFrame([(1, text[1:400], "a")] * 3 + [(2, text[1:400], "a"), (None, text[1:400], "a")], "doc_id int, text string, lang string")
    out = sentencepiece_bpe.encoded_documents(rows, copies=True).collect()
    again = sentencepiece_bpe.encoded_documents(rows.repartition(3), copies=True).collect()
    assert len({tuple(r.pieces) for r in out}) == 5 and Counter((r.doc_id, tuple(r.pieces)) for r in out) == Counter((r.doc_id, tuple(r.pieces)) for r in again)
    assert all(sentencepiece_bpe.decode(v, r.pieces) == r.text for r in out)


@pytest.mark.parametrize("dropout", [0.2, 0.9])
def test_draws_against_a_plain_agenda(monkeypatch, texts, dropout):
    v = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.MODEL)
    e = sentencepiece_bpe.Encoder(v, dropout, 3)
    long = "".join(random.Random(1).choice("theandxyz") for _ in range(600))
    cases = [t for t in texts if t and len(t) < 5000] + [f"some words, {long} and others of the information"]
    want = [agenda(v, e, t, "k") for t in cases]
    for _ in range(2):  # the second time from the cache
        assert [e.encode(t, "k") for t in cases] == want
    monkeypatch.setattr(sentencepiece_bpe, "CACHE", 3)
    monkeypatch.setattr(sentencepiece_bpe, "TOGETHER", 300)
    small = sentencepiece_bpe.Encoder(v, dropout, 3)
    assert [x.tolist() for x in small.in_batches([None, *cases, ""], ["k"] * (len(cases) + 2))] == [[], *want, []]


# ---- 10 ----


def covered(rows, length=50):
    first, out = {}, []
    for d, t in sorted(((d, t) for d, t in rows if d is not None), key=lambda x: x[0]):
        b = (t or "").encode()
        for k in range(len(b) - length + 1):
            first.setdefault(b[k : k + length], d)
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        if d is not None:
            for k in range(len(b) - length + 1):
                if first[b[k : k + length]] < d:
                    gone[k : k + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), kept))
    return sorted(out, key=str)


SIZES = ("RUN", "BATCH", "GROUP", "CHUNK", "SEGMENT")


@pytest.mark.parametrize(("sizes", "hot"), [((60_000, 20_000, 150_000, 400, 1 << 18), 8000), ((300, 3, 50_000, 7, 700), 1 << 60), ((300, 50, 50_000, 7, 1 << 18), 3), ((300, 20, 2, 7, 1 << 18), 1 << 60)])
def test_suffix_dedup(docs, plain, monkeypatch, sizes, hot):
    for name, value in zip(SIZES, sizes, strict=True):
        monkeypatch.setattr(suffix_dedup, name, value)
    out = suffix_dedup.dedup_substrings(docs, filter_bits=1 << 20, hot=hot)
    assert sorted(((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in out.collect()), key=str) == covered(plain)


def test_merged_lengths_tell_what_is_covered():
    """Rows around one anchor over a small alphabet, some cut short: the borders of stretches against all strings."""
    rng = random.Random(9)
    for _ in range(60):
        texts = []
        for _ in range(rng.randrange(2, 40)):
            left, right = (bytes(rng.choice(b"\0a") for _ in range(m)) for m in (rng.randrange(27), rng.randrange(24, 51)))
            texts.append((b"\0" * 24 + right[24:] if rng.random() < 0.9 else right, left, rng.randrange(12)))
        texts = sorted(set(texts), key=lambda x: (x[0].ljust(50, b"\0") + x[1].ljust(26, b"\0"), x[2]))
        rows = np.frombuffer(b"".join(r.ljust(50, b"\0") + x.ljust(26, b"\0") for r, x, _ in texts), np.uint8).reshape(len(texts), 76)
        numbers = np.array([(len(r), len(x), d) for r, x, d in texts])
        got = suffix_dedup.covered(suffix_dedup.shared_lengths(rows), rows, *numbers.T, 50)
        first = {}
        strings = [{j: (x[:j], r[: 50 - j]) for j in range(27) if len(x) >= j and len(r) >= 50 - j} for r, x, _ in texts]
        for own, (_, _, d) in zip(strings, texts, strict=True):
            for j, x in own.items():
                first[j, x] = min(first.get((j, x), d), d)
        assert [tuple(x) for x in got.tolist()] == [(i, j) for i, own in enumerate(strings) for j, x in own.items() if first[j, x] < texts[i][2]]


def test_frequent_hashes_are_counted():
    rng = np.random.RandomState(4)
    often = suffix_dedup.Frequent()
    for _ in range(40):
        h, n = np.unique(np.concatenate([rng.randint(0, 1 << 60, 20_000).astype(np.uint64), np.repeat(np.uint64([3, 5]), [900, 500])]), return_counts=True)
        often.add(h, n)
    counts = dict(zip(often.keys.tolist(), often.counts.tolist(), strict=True))
    assert len(counts) <= suffix_dedup.COUNTED and all(n - 40 * 21_400 / suffix_dedup.COUNTED <= counts[k] <= n for k, n in ((3, 36_000), (5, 20_000)))


def test_merge_with_few_comparisons():
    rng = random.Random(3)
    entries = [(bytes(rng.choice(b"ab") for _ in range(rng.choice((6, 30)))).ljust(30, b"\0"), rng.randrange(50), k) for k in range(3000)]
    runs = [sorted(entries[k::7]) for k in range(7)]

    def encoded(part):
        rows = np.frombuffer(b"".join(x for x, _, _ in part), np.uint8).reshape(len(part), -1)
        return suffix_dedup.encode_chunk(rows, suffix_dedup.shared_lengths(rows), np.array([(1, 2, d, 3, k) for _, d, k in part]))

    tree = suffix_dedup.LoserTree()
    chunks = sorted((r[k : k + 40] for r in runs for k in range(0, len(r), 40)), key=lambda c: c[0][0])
    got, last = [], bytes(30)
    while True:
        while chunks and ((head := tree.head()) is None or chunks[0][0][0] <= head):
            tree.add(suffix_dedup.Chunk(encoded(chunks.pop(0))))
        if tree.head() is None:
            break
        k, chunk, at = tree.pop()
        assert k == suffix_dedup.shared(last, chunk.strings[at], 0) or not got
        got.append((chunk.strings[at], chunk.doc[at]))
        last = chunk.strings[at]
    assert got == sorted((s, d) for s, d, _ in entries)


def test_equal_strings_hold_equal_anchors():
    rng = np.random.RandomState(8)
    text = rng.choice(np.frombuffer(b"abc ", np.uint8), 400)
    other = np.concatenate([rng.choice(np.frombuffer(b"xyz ", np.uint8), 77), text[100:180], rng.choice(np.frombuffer(b"xyz ", np.uint8), 90)])
    a, b = suffix_dedup.anchors(text, 50)[0], suffix_dedup.anchors(other, 50)[0]
    for k in range(31):
        inside = {x - 100 - k for x in a if 100 + k <= x <= 100 + k + 26} & {x - 77 - k for x in b if 77 + k <= x <= 77 + k + 26}
        assert inside


def test_suffix_dedup_of_nothing(nothing):
    assert suffix_dedup.dedup_substrings(nothing, filter_bits=1 << 20).count() == 0
