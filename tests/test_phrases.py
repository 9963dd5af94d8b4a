"""The phrase index against a scan, and mined phrases against plain versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.operators import analytics, mining
from quern.operators.phrase_index import PhraseIndex


@pytest.fixture(scope="module")
def held(spark):
    rng = random.Random(3)
    words = ["gold", "marigold", "price", "Prices", "the", "old", "is", "a", "ÜBER", "x1", "1", "don't", "re-price"]
    gap = lambda: rng.choice([" ", " ", " ", ", ", "  ", "\n", "; "])
    texts = ["".join(rng.choice(words) + gap() for _ in range(rng.randrange(0, 60))) for _ in range(80)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(200, None), (201, ""), (202, " ; "), (203, "gold " * 500), (204, "ab" * 900)]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


PHRASES = ["gold", "gold price", "old pri", "the old", "d", "is a ", " price, ", "gold, price", "über", "1 x", "t", "don't", "re-price", "price gold is the", "no such words", "gold gold gold", "ab", "\ngold"]


def scanned(docs, texts, phrase, margin=25):
    """Rows of a report by plain search."""
    out = []
    for d in docs:
        text = texts.get(d)
        found, at = [], 0
        while text is not None and (k := text.lower().find(phrase, at)) >= 0:
            left, at = text.lower()[at:k][-margin:], k + len(phrase)
            found.append(left + phrase + text.lower()[at : at + margin])
        out += [(d, "found", k, x) for k, x in enumerate(found)] or [(d, "no text" if text is None else "not found", None, None)]
    return sorted(out, key=str)


def test_index_equals_the_scan(spark, held, tmp_path, monkeypatch):
    index = PhraseIndex(spark, f"file://{tmp_path}/i", buckets=4)
    index.add(held.where("doc_id % 2 = 0"))
    index.add(held.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit("gold price is the old price")).otherwise(F.col("text"))))
    index.add(held.where("doc_id % 3 = 0"))
    index.remove(held.where("doc_id = 4"))
    docs = held.select("doc_id").unionByName(spark.createDataFrame([(900,)], "doc_id long"))
    left = held.where("doc_id <> 4")
    ids, known = [r.doc_id for r in docs.collect()], {r.doc_id: r.text for r in left.collect()}
    read, buckets = index.versions.read, []
    monkeypatch.setattr(index.versions, "read", lambda table, *a, **o: buckets.append((table, o.get("buckets"))) or read(table, *a, **o))
    for phrase in PHRASES:
        buckets.clear()
        assert sorted(map(tuple, index.report(docs, left, phrase).collect()), key=str) == scanned(ids, known, phrase), phrase
        only = {tuple(b) for t, b in buckets if t == "postings"}
        assert only and all(len(b) <= len(index.slots(phrase).select("term").distinct().collect()) for b in only)
    assert {len(b) for _, b in buckets if b is not None} <= {0, 1, 2}
    index.clean()
    want = scanned(ids, known, "gold price")
    assert sorted(map(tuple, index.report(docs, left, "gold price").collect()), key=str) == want == sorted(map(tuple, analytics.phrase_report(docs, left, "gold price").collect()), key=str)
    assert read("postings").where("doc_id = 4").count() == 0
    with pytest.raises(ValueError):
        index.report(docs, left, " - ")


def test_places_of_words(spark, held, tmp_path):
    index = PhraseIndex(spark, f"file://{tmp_path}/i")
    index.add(spark.createDataFrame([(1, "a b a b c"), (2, "b a"), (3, "a  B, a-b")], "doc_id long, text string"))
    got = {r.doc_id: r.starts for r in index.candidates(" a b ").collect()}
    assert got == {1: [0, 2], 3: [0, 2]}


# ---- mining ----

STOP = set(mining.T.STOP_WORDS)


def stretches(text):
    out, now, word = [], [], ""
    for ch in text.lower() + "|":
        if ch.isalnum() or ch == "'":
            word += ch
            continue
        if word:
            if word in STOP:
                out, now = [*out, now], []
            else:
                now.append(word)
            word = ""
        if ch != " ":
            out, now = [*out, now], []
    return [x for x in out if len(x) > 1]


def mined(texts, longest, least, ratio):
    runs = [s for t in texts if t for s in stretches(t)]
    pairs = Counter((a, b) for s in runs for a, b in zip(s, s[1:], strict=False))
    total, left, right = sum(pairs.values()), Counter(), Counter()
    for (a, b), n in pairs.items():
        left[a] += n
        right[b] += n
    x = lambda v: v * math.log(v) if v > 0 else 0.0

    def llr(a, b):
        n, p, q = pairs[a, b], left[a], right[b]
        g = 2 * (x(n) + x(p - n) + x(q - n) + x(total - p - q + n) - x(p) - x(total - p) - x(q) - x(total - q) + x(total))
        return g if n * total >= p * q else -g

    grams = Counter(tuple(s[k : k + z]) for s in runs for z in range(2, longest + 1) for k in range(len(s) - z + 1))
    kept = {g: n for g, n in grams.items() if n >= least and all(llr(a, b) >= ratio for a, b in zip(g, g[1:], strict=False))}
    out = {}
    for g, n in kept.items():
        around = [m for h, m in kept.items() if len(h) > len(g) and any(h[k : k + len(g)] == g for k in range(len(h) - len(g) + 1))]
        out[" ".join(g)] = (n, round(math.log2(len(g)) * (n - (sum(around) / len(around) if around else 0)), 6))
    return out


def longest_first(words, phrases):
    out, at = [], 0
    while at < len(words):
        fit = max((z for z in range(1, len(words) - at + 1) if " ".join(words[at : at + z]) in phrases), default=0)
        if fit:
            out.append(" ".join(words[at : at + fit]))
        at += fit or 1
    return out


def test_mined_phrases_and_segmentation(spark):
    rng = random.Random(8)
    fixed = ["interest rate", "central bank policy", "new york stock exchange", "gold price", "don't panic now"]
    noise = [f"w{k}" for k in range(30)] + ["the", "of", "and,", "."]
    texts = [" ".join(rng.choice(fixed) if rng.random() < 0.35 else rng.choice(noise) for _ in range(rng.randrange(0, 40))) for _ in range(120)] + [None, "", "gold price gold price"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = mining.phrases(docs, least=4).cache()
    want = mined(texts, 4, 4, 10.83)
    assert {r.phrase: (r.n, round(r.c_value, 6)) for r in found.collect()} == want and len(want) > 5 and "new york stock exchange" in want
    for most in (1000, 2):
        top = [p for p, (_, c) in sorted(want.items(), key=lambda x: (-x[1][1], x[0])) if c > 0][:most]
        counts = {(k, p): n for k, t in enumerate(texts) if t for p, n in Counter(p for s in stretches(t) for p in longest_first(s, set(top))).items()}
        got = {(r.doc_id, r.term): r["count"] for r in mining.mined_counts(docs, found, most=most).collect()}
        assert got == counts
    none = docs.where("text is null")
    assert mining.collocations(none).count() == 0 and mining.phrases(none).count() == 0


def test_pairs_are_counted_by_the_tasks_and_longer_runs_only_of_good_pairs(spark):
    import numpy as np
    import pyarrow as pa

    texts = ["a b c |", " |", "b  c d a |", "a b |"]
    for most in (1, 9, 1000):
        batch = pa.RecordBatch.from_arrays([pa.array([t.replace("a", "x") for t in texts])], ["text"])
        got = Counter()
        for b in mining._pairs([batch] if most == 1000 else [batch.slice(k, 1) for k in range(4)]):
            got.update({(r["left_word"], r["right_word"]): r["n"] for r in b.to_pylist()})
        coded = [w[c].as_py() if c >= 0 else None for words, codes in mining._coded([batch], most) for w, c in ((words, c) for c in codes)]
        assert got == {("x", "b"): 2, ("b", "c"): 2, ("c", "d"): 1, ("d", "x"): 1}
        assert coded == ["x", "b", "c", None, None, "b", "c", "d", "x", None, "x", "b", None]
    docs = spark.createDataFrame([(k, "gold price index; old gold. price list") for k in range(6)] + [(9, "gold price tag"), (10, None)], "doc_id long, text string")
    every = {(r.left_word, r.right_word): (r.n, r.ratio) for r in mining.collocations(docs).collect()}
    often = {(r.left_word, r.right_word): (r.n, r.ratio) for r in mining.collocations(docs, least=6).collect()}
    assert often == {p: x for p, x in every.items() if x[0] >= 6} and ("price", "tag") in every and ("price", "tag") not in often
    good = spark.createDataFrame([("gold", "price"), ("price", "index")], "left_word string, right_word string")
    assert {(r.phrase, r["size"], r.n) for r in mining._longer(docs, good, 4).collect()} == {("gold price index", 3, 6)}
    assert np.unpackbits(mining._filter(good)).sum() == 2


def test_places_shuffle_texts_and_not_tokens(spark):
    from quern.operators.phrase_index import places

    docs = spark.createDataFrame([(1, "B a b. b"), (1, "a, c"), (2, ""), (3, None), (None, "a a"), (4, "ü x ü")], "doc_id long, text string")
    made = places(docs, "doc_id")
    assert {(r.doc_id, r.term): r.places for r in made.collect()} == {(1, "b"): [0, 2, 1], (1, "a"): [0, 1], (1, "c"): [1], (None, "a"): [0, 1], (4, "ü"): [0, 2], (4, "x"): [1]}
    dealt = [line for line in made._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and all("term" not in line for line in dealt)


def test_index_shuffles_postings_alone_and_counts_what_it_wrote(spark, held, tmp_path, monkeypatch):
    from quern.operators import versions
    from quern.operators.phrase_index import places

    assert "Exchange" not in places(held, "doc_id", unique=True)._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, places(held, "doc_id", unique=True).collect())) == sorted(map(str, places(held, "doc_id").collect()))
    index = PhraseIndex(spark, f"file://{tmp_path}/i", buckets=2)
    frame, kept = type(held), []
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or self.cache())
    monkeypatch.setattr(versions, "AT_LEAST", 0)
    for part in (held.where("doc_id % 2 = 0"), held.where("doc_id % 2 = 1"), held.where("doc_id % 4 = 1")):
        index.add(part)
        n = {r.term: r.n for r in index.versions.read("dictionary").collect()}
        assert n == {r.term: r["count"] for r in index.versions.read("postings").groupBy("term").count().collect()}
    assert not any("places" in columns for columns in kept)
    assert all(e["base"] is None for e in index.versions.manifest()["buckets"]["postings"].values())  # new postings are not written twice
    monkeypatch.setattr(versions, "BUCKET_BYTES", 1 << 11)
    index.versions.grow()
    assert index.versions.buckets > 2
    docs, known = held.select("doc_id"), {r.doc_id: r.text for r in held.collect()}
    for phrase in ("gold price", "old pri"):
        assert sorted(map(tuple, index.report(docs, held, phrase).collect()), key=str) == scanned(list(known), known, phrase)
    index.add(held.where("doc_id = 2").withColumn("text", F.lit("late words")))
    assert {r.doc_id for r in index.candidates("late words").collect()} == {2}
