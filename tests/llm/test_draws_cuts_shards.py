"""Sharding, fill-in-the-middle and importance resampling against brute-force versions, over awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import common, fill_middle, importance, sharding

KIND = "doc_id long, text string, lang string, source string, n_chars long, shard int, row string, h long"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(11)
    word = lambda: rng.choice(["alpha", "Beta", "<P", "<", "P>", "<<P", "S>", "é", "Straße", "\U0001f600", "x" * 40, "a-b", "7", "M"])
    gap = lambda: rng.choice([" ", "  ", "\n", "\t\r", " \x0b\x0c ", " "])
    texts = [None, "", " ", "\n \t", "one", " one", "one ", "<P>", "a <S> b", "x<M>", "<P <P>", "<P\x20>", "ab" * 700, " " * 700, "é" * 600]
    texts += ["".join(word() + gap() for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += ["".join(word() + gap() for _ in range(n)) for n in (400, 1500, 6000)]  # chunks of 300 bytes: many
    rows = [(k * 7 % 1013, t, "en", ["b", "a", None, "c", "b"][k % 5], None, 3, "r", 7) for k, t in enumerate(texts)]
    rows += [(None, texts[30], "en", "solo", 5, None, None, None), (None, None, "en", "a", 5, None, None, None), rows[-1], rows[-1], rows[20], (rows[21][0], "another text " * 200, "de", "b", 1, 1, "r", 1)]
    return spark.createDataFrame(rows, KIND).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], KIND)


# ---- 11 ----


def interleaved(rows, shards, seed="shard"):
    """(doc_id, text, source) to (doc_id, text, shard, slot), with one sort for everything."""
    by = defaultdict(list)
    for d, t, s in rows:
        key = str(d) if d is not None else "~" + (t or "")
        h = int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:15], 16)
        by["~" if s is None else "=" + s].append((h, d is not None, d or 0, zlib.crc32((t or "").encode()), d, t))
    order = []
    for of, own in by.items():
        phase = int(hashlib.md5(f"{seed}-phase:{of}".encode()).hexdigest()[:13], 16) / 2.0**52
        for k, row in enumerate(sorted(own, key=lambda r: r[:4])):
            order.append(((float(k) + phase) / float(len(own)), of, row[4], row[5]))
    order.sort(key=lambda r: r[:2])
    n = len(order)
    return [(d, t, k * shards // n, k - -(-(k * shards // n) * n // shards)) for k, (_, _, d, t) in enumerate(order)]


def listed(out):
    return sorted(((r.row.doc_id, r.row.text, r.shard, r.slot) for r in out.select("row", "shard", "slot").collect()), key=str)


@pytest.mark.parametrize(("shards", "cells"), [(24, 4096), (5, 8), (1, 2), (300, 64)])
def test_interleaved_equals_one_sort(docs, shards, cells):
    want = interleaved([(r.doc_id, r.text, r.source) for r in docs.collect()], shards)
    out = sharding.interleaved(docs, shards, cells=cells)
    assert listed(out) == sorted(want, key=str)
    assert out.select("row.*").columns == docs.columns


def test_shards_match_the_mixture(spark):
    size = {"big": 4001, "mid": 1703, "small": 290, "tiny": 31, None: 977}
    names = [s for s, n in size.items() for _ in range(n)]
    rows = spark.createDataFrame([(k, f"t{k}", s) for k, s in enumerate(names)], "doc_id long, text string, source string")
    out = sharding.interleaved(rows, 24).select("row.source", "shard", "slot").collect()
    here, held = defaultdict(Counter), Counter()
    for r in out:
        here[r.shard][r.source] += 1
        held[r.shard] += 1
    assert set(held) == set(range(24)) and max(held.values()) - min(held.values()) <= 1
    for shard in range(24):
        assert sorted(r.slot for r in out if r.shard == shard) == list(range(held[shard]))
        for s, n in size.items():
            assert abs(here[shard][s] - n / 24) <= 2, (shard, s)


def test_rows_of_one_hash_are_numbered_by_task(spark):
    same = [(None, "the same text", "big", 1)] * 700 + [(None, "", "big", 2)] * 300
    other = [(k, f"t{k}", "big" if k % 3 else "b", 0) for k in range(500)]
    rows = spark.createDataFrame(same + other, "doc_id long, text string, source string, extra int").repartition(7)
    out = sharding.interleaved(rows, 7, hot_rows=50, cells=16)
    want = interleaved([(r.doc_id, r.text, r.source) for r in rows.collect()], 7)
    assert listed(out) == sorted(want, key=str)


def test_many_small_sources_spread(spark):
    rows = spark.createDataFrame([(k, "t", f"s{k}") for k in range(960)], "doc_id long, text string, source string")
    out = Counter(r.shard for r in sharding.interleaved(rows, 24).collect())
    assert out == {k: 40 for k in range(24)}


def test_written_shards_come_back_in_order(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 4)
    want = {(k, s): t for _, t, k, s in interleaved([(r.doc_id, r.text, r.source) for r in docs.collect()], 4)}
    for shard in range(4):
        back = sharding.read_shard(spark, str(tmp_path / "s"), shard)
        assert back.columns == docs.columns
        assert [r.text for r in back.collect()] == [want[shard, s] for s in range(sum(1 for k, _ in want if k == shard))]


def test_shards_of_nothing(nothing):
    assert sharding.interleaved(nothing).collect() == []


# ---- 12 ----

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def cut(d, text, rate=50):
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("chunk", "rate"), [(1 << 15, 100), (300, 100), (1, 50), (17, 100)])
def test_transformed_equals_the_pattern(docs, chunk, rate):
    some = docs if chunk > 20 else docs.where("length(text) < 300 or text is null")
    out = fill_middle.transformed(some, chunk=chunk, rate=rate).withColumn("again", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(out) == some.count()
    for r in out:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == cut(r.row.doc_id, r.row.text, rate)
        assert r.again == (r.row.text or "")
    assert {"plain", "spm", "psm"} <= {r.form for r in out} or chunk < 20


def test_functions_compose_associatively():
    rng = np.random.RandomState(2)
    parts = [rng.choice(np.frombuffer(b" <PSM>ab\n", np.uint8), rng.randint(0, 900)) for _ in range(60)]
    functions = [tuple(x[:1] for x in fill_middle.Scan([p]).whole) for p in parts]
    for k in range(0, 57, 3):
        a, b, c = functions[k : k + 3]
        left, right = fill_middle.compose(fill_middle.compose(a, b), c), fill_middle.compose(a, fill_middle.compose(b, c))
        whole = fill_middle.Scan([np.concatenate(parts[k : k + 3])]).whole
        for x, y, z in zip(left, right, whole, strict=True):
            assert (x == y).all() and (x == z).all()


def test_transform_of_nothing(nothing):
    assert fill_middle.transformed(nothing).collect() == []


# ---- 13 ----

RUN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def run_counts(text, runs=3, size=10_000):
    w = RUN.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(w[k : k + n]) for n in range(1, runs + 1) for k in range(len(w) - n + 1)]
    return len(w), Counter(zlib.crc32(g.encode()) % size for g in grams)


def resampled(rows, target, percent, least, size):
    found = [(d, *run_counts(t, size=size)) for d, t in rows]
    s, t = sum((c for _, _, c in found), Counter()), sum((run_counts(x, size=size)[1] for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[k] + 1) * (all_s + size)) / ((s[k] + 1) * (all_t + size)))) for k in range(size)]
    out = []
    for d, m, c in found:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] * n for k, n in c.items())
        out.append((d, m, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = Counter()
    ranks = []
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        ranks.append((r, k))
        drawn[r] += 1
    rest = Counter(out) - drawn
    return sorted([(r[0], *r[2:], k) for r, k in ranks] + [(r[0], *r[2:], None) for r in rest.elements()], key=str)


@pytest.mark.parametrize(("percent", "least", "size"), [(5, 20, 10_000), (40, 1, 97), (100, 0, 10_000)])
def test_resample_equals_brute_force(spark, docs, percent, least, size):
    target = spark.createDataFrame([("alpha beta straße",), ("7 m é alpha",), (None,), ("",)], "text string")
    out = importance.resample(docs, target, percent=percent, least_words=least, buckets=size)
    got = sorted(((r.id, r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=str)
    want = resampled([(r.doc_id, r.text) for r in docs.collect()], ["alpha beta straße", "7 m é alpha", None, ""], percent, least, size)
    assert got == want


def test_ring_carries_states_between_pieces(monkeypatch):
    monkeypatch.setattr(common, "CHUNK", 11)
    for text in ("", "one", "one two", "a b c d e f g h i j k l m n", "Ein-Wort über alles; <b>7</b>\n\n x", "y" * 60 + " z " + "w" * 30, " . , ; "):
        words, at, n = importance.text_buckets(np.frombuffer(text.encode(), np.uint8), 3, 10_000)
        assert (words, dict(zip(at.tolist(), n.tolist(), strict=True))) == (run_counts(text)[0], dict(run_counts(text)[1]))


def test_resample_draws_towards_the_target(spark):
    rng = random.Random(4)
    topic = [[f"{c}{k}" for k in range(60)] for c in "ab"]
    rows = [(k, " ".join(rng.choices(topic[k % 10 == 0], k=60))) for k in range(1000)]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(" ".join(rng.choices(topic[1], k=200)),)] * 5, "text string")
    out = importance.drawn_documents(docs, target)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == 50 and all(d % 10 == 0 for d in ids)


def test_resample_of_nothing(spark, docs, nothing):
    target = spark.createDataFrame([("alpha",)], "text string")
    assert importance.resample(nothing, target).collect() == []
    none = importance.resample(docs, target.limit(0)).where("rank is not null").count()
    assert none == docs.select(F.regexp_count(F.lower("text"), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")).alias("n")).where("n >= 20").count() * 5 // 100


def test_places_of_equal_rows(spark):
    rows = common.stash(spark.createDataFrame([(7,)] * 500 + [(k,) for k in range(100)], "x int").repartition(6), "rows")
    out = sorted((r.place, r.x) for r in common.in_order(rows, F.col("x").desc()).collect())
    assert [p for p, _ in out] == list(range(600)) and [x for _, x in out] == sorted([7] * 500 + list(range(100)), reverse=True)
