"""The pipeline's stages, each against a plain version over the stage before it."""

from collections import Counter, defaultdict

import numpy as np
import pytest
import corpus_pipeline
from quern.llm import quality_model, sentencepiece_bpe
from tests.llm.test_operators import WORD, lines_of, linked_components, minimax, plain_stats

SMALL = "/root/testdata/sf0.001"


def plain_kept(rows, labels):
    """The doc_ids that the classifier keeps: statistics, fit and calibration over all labelled rows at once."""
    x = np.array([plain_stats(t) for _, t in rows])
    y = defaultdict(list)
    for k, q in labels:
        if k is not None and q is not None:
            y[k].append(q)
    fold = np.array([9 if k is None else __import__("zlib").crc32(str(k).encode()) % 5 for k, _ in rows])
    goal = np.array([np.mean(y[k]) if k in y else np.nan for k, _ in rows])
    fit, hold = (fold >= 1) & (fold <= 3) & ~np.isnan(goal), (fold == 4) & ~np.isnan(goal)
    m = quality_model.Model(x[fit].mean(0), np.sqrt(np.maximum(x[fit].var(0), 1e-4)))
    f = m.features(x[fit])
    m.coef = np.linalg.solve(f.T @ f + 1e-3 * fit.sum() * np.diag([1.0] * (f.shape[1] - 1) + [1e-9]), f.T @ goal[fit])
    place = np.clip((m.raw(x[hold]) + 0.5) / 2 * 2000, 0, 1999).astype(int)
    bins = sorted(set(place))
    n = np.array([(place == b).sum() for b in bins])
    m.x, m.y = (np.array(bins) + 0.5) / 2000 * 2 - 0.5, np.clip(minimax(n, np.array([goal[hold][place == b].sum() for b in bins]) / n), 0.001, 0.999)
    return m.score(x)


def plain_targets(rows):
    """source -> words that the mix wants of it."""
    size = Counter()
    for source, text in rows:
        size[source] += len(WORD.findall(text or ""))
    names = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    open_, left, want = set(size), sum(size.values()), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 3 * size[s]}
        if not above:
            return want | share
        want |= {s: 3 * size[s] for s in above}
        left -= sum(3 * size[s] for s in above)
        open_ -= above
    return want


def check(spark, docs, sf_dir, labels):
    """Each stage against its plain version; the rows after the last."""
    columns = docs.columns
    named = dict(corpus_pipeline.STAGES)
    assert list(named) == ["quality classifier", "line dedup", "n-gram jaccard join", "mixing", "sentencepiece"]

    def at(name, d):
        out = named[name](spark, d, sf_dir)
        return spark.createDataFrame(out.collect(), out.schema)

    pairs = lambda d: [(r.doc_id, r.text) for r in d.collect()]
    good = at("quality classifier", docs)
    assert good.columns == columns
    rows = pairs(docs)
    kept = Counter(r for r, s in zip(rows, plain_kept(rows, labels), strict=True) if s >= 0.3)
    assert Counter(pairs(good)) == kept
    lines = at("line dedup", good)
    assert lines.columns == columns and all(r.text is None or r.n_chars == len(r.text) for r in lines.collect())
    assert sorted(((d, t or "") for d, t in pairs(lines)), key=str) == sorted(((d, t) for d, t, _, _ in lines_of(pairs(good))), key=str)
    single = at("n-gram jaccard join", lines)
    assert single.columns == columns
    linked = linked_components(pairs(lines), 5, 80)
    least = {d for d, _, c in linked if d == c}
    want = {(d, t) for d, t in pairs(lines) if d is None or d in least}
    assert Counter(pairs(single)) == Counter(want)  # rows that repeat id and text stay once
    mixed = at("mixing", single)
    assert mixed.columns == columns
    target, taken, longest = plain_targets([(r.source, r.text) for r in single.collect()]), Counter(), Counter()
    copies, there = Counter(pairs(mixed)), Counter(pairs(single))
    assert all(n <= 3 * there[r] for r, n in copies.items())
    for r in mixed.collect():
        taken[r.source] += len(WORD.findall(r.text or ""))
    for r in single.collect():
        longest[r.source] = max(longest[r.source], len(WORD.findall(r.text or "")))
    assert all(abs(taken[s] - t) <= longest[s] + 1e-6 for s, t in target.items())
    encoded = at("sentencepiece", mixed)
    v = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.MODEL)
    assert encoded.columns == [*columns, "pieces"] and encoded.count() == mixed.count()
    assert all(sentencepiece_bpe.decode(v, r.pieces) == (r.text or "") for r in encoded.collect())
    return encoded.collect()


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = [(r.doc_id, r.quality) for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()]
    check(spark, docs, SMALL, labels)


KIND = "doc_id long, text string, lang string, source string, n_chars long, row int, copies string, key long"


@pytest.fixture
def awkward(spark, tmp_path):
    """A folder of awkward documents: nulls, empty and long texts, ties, repeats and names that clash; and labels for some."""
    rng = __import__("random").Random(3)
    text = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    base = text(60)
    rows = [(k, base if k % 5 == 0 else text(rng.randrange(1, 90)), "en", ["a", "b", None][k % 3], 3, 1, "c", 2) for k in range(60)]
    rows += [(100, None, None, None, None, None, None, None), (101, "", "en", "a", 0, 1, "c", 2), (None, base, "en", "b", 1, 1, "c", 2), (None, base, "en", "b", 1, 1, "c", 2), rows[7], rows[7], (8, text(20), "de", "a", 1, 1, "c", 2), (102, text(30_000), "en", "b", 1, 1, "c", 2), (103, base + " more", "en", "a", 1, 1, "c", 2)]
    spark.createDataFrame(rows, KIND).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, int(k % 4 > 0), 0) for k in range(55)] + [(None, 1, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), [(k, q) for k, q, _ in labels]


def test_stages_over_awkward_documents(spark, awkward):
    folder, labels = awkward
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    staged, whole = check(spark, docs, folder, labels), corpus_pipeline.run(spark, folder)
    assert whole.columns == [*docs.columns, "pieces"] and len(staged) > 20
    assert Counter(map(str, whole.collect())) == Counter(map(str, staged))  # run() is the stages in turn


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], KIND).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == [x.split()[0] for x in KIND.split(", ")] + ["pieces"]
