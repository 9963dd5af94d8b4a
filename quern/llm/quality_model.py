"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

Statistics are computed from the whole text. Features cos(Wx + b) approximate a Gaussian kernel over the standardised
statistics; tasks sum the normal equations of their labelled rows, the driver adds a bounded number of those sums and solves.
Scores of a separate fold of labelled rows are binned and made monotone (pool adjacent violators), which gives probabilities.

Rows whose crc32(id) mod folds is 0 are held out; fold 4 calibrates, the others fit. At most max_labelled labelled rows are
used, chosen by hash of the id. Labels, language, source and id are no inputs of a score.

Defined cases: null and empty texts have all statistics 0 and get a score like others; a null id is held out; null labels are
ignored and several labels of one id are averaged; without labels every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .common import Bits, id_filter, in_filter, shingle_hashes, small_batches, stash, texts_of, word_hashes

STATS = ("log_words", "word_bytes", "symbols", "upper", "digits", "punctuation", "high_bytes", "line_bytes", "line_repeats", "window_repeats", "distinct_words", "top_word", "marked_words", "long_words", "blank", "exclaim")

_KIND = np.zeros(256, dtype=np.uint8)  # 1 symbol, 2 upper, 3 digit, 4 punctuation, 5 high, 6 space, 7 exclamation, 8 end mark
for _chars, _kind in ((b"#*$%&|<>@^~{}[]\\=+_/", 1), (bytes(range(65, 91)), 2), (b"0123456789", 3), (b",;:'\"()-`", 4), (bytes(range(128, 256)), 5), (b" \t\n\x0b\x0c\r", 6), (b"!?", 7), (b".", 8)):
    _KIND[list(_chars)] = _kind


def text_stats(data: np.ndarray) -> np.ndarray:
    """The STATS of one text's UTF-8 bytes."""
    n = len(data)
    out = np.zeros(len(STATS))
    if not n:
        return out
    count = np.bincount(_KIND[data], minlength=9)
    ink = max(1, n - count[6])
    w = word_hashes(data)
    m = len(w)
    lines = data.tobytes().split(b"\n")
    full = [x for x in lines if x.strip()]
    if m:
        _, words = np.unique(w, return_counts=True)
        windows, times = np.unique(shingle_hashes(w, 5), return_counts=True)
        repeated = times[times > 1].sum() / times.sum()
    else:
        words, repeated = np.zeros(1), 0.0
    marked = int(np.isin(_KIND[data[:-1]], (1, 7))[np.flatnonzero(_KIND[data[1:]] == 6)].sum()) if n > 1 else 0
    out[:] = (
        np.log1p(m), ink / max(m, 1), count[1] / ink, count[2] / ink, count[3] / ink, count[4] / ink, count[5] / ink, np.log1p(n / max(1, len(full))),
        1 - len(set(full)) / max(1, len(full)), repeated, np.log1p(len(words)) / np.log1p(max(m, 1)), words.max() / max(m, 1), marked / max(m, 1), ink / max(m, 1) > 12, count[6] / n, (count[7] + count[8]) / max(m, 1),
    )
    return out


@F.arrow_udf(ArrayType(DoubleType()))
def stats_of(texts: pa.Array) -> pa.Array:
    rows = [text_stats(x) for x in texts_of(texts)]
    ends = np.arange(len(rows) + 1, dtype=np.int32) * len(STATS)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0)))


class Model:
    """Standardise, project, ridge, calibrate; a few hundred kB at most, whatever the input."""

    def __init__(self, mean, scale, width: int = 256, gamma: float = 0.06, seed: int = 11):
        draw = np.random.RandomState(seed)
        self.mean, self.scale = mean, scale
        self.w = draw.normal(size=(len(mean), width)) * np.sqrt(2 * gamma)
        self.b = draw.uniform(0, 2 * np.pi, width)
        self.coef = np.zeros(width + 1)
        self.x, self.y = np.array([0.0, 1.0]), np.array([0.5, 0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2 / self.w.shape[1]), np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.concatenate([self.features(stats[k : k + 4096]) @ self.coef for k in range(0, len(stats), 4096)]) if len(stats) else np.zeros(0)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.x, self.y), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATS))


def _moments(batches):
    total = np.zeros((3, len(STATS)))
    for batch in batches:
        x = _matrix(batch.column(0))
        total += np.stack([np.full(len(STATS), len(x)), x.sum(0), (x * x).sum(0)])
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _normal(model: Model):
    def run(batches):
        size = len(model.coef)
        total = np.zeros((size, size + 1))
        for batch in batches:
            x, y = _matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            for k in range(0, len(x), 4096):
                f = model.features(x[k : k + 4096])
                total += np.hstack([f.T @ f, (f.T @ y[k : k + 4096])[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return run


def _binned(model: Model, bins: int):
    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            place = np.clip((model.raw(_matrix(batch.column(0))) + 0.5) / 2 * bins, 0, bins - 1).astype(int)
            for p, y in zip(place.tolist(), batch.column(1).to_pylist(), strict=True):
                total[p, 0] += 1
                total[p, 1] += y
        keys = sorted({p for p, _ in total})
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([float(total[p, 0]) for p in keys]), pa.array([float(total[p, 1]) for p in keys])], ["bin", "n", "good"])

    return run


def isotonic(weights, values) -> list[float]:
    """Pool adjacent violators: the non-decreasing fit of values with these weights."""
    blocks: list[list[float]] = []
    for w, v in zip(weights, values, strict=True):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks.pop()
            blocks.append([w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2])
    return [v for _, v, n in blocks for _ in range(n)]


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, stats) of every row, written once: all later steps read these few numbers instead of the texts."""
    small_batches(docs.sparkSession)
    return stash(docs.select(F.col(id_col).alias("doc_id"), stats_of(docs[text_col]).alias("stats")), "quality-stats")


def labelled(stats: DataFrame, labels: DataFrame, id_col: str, label_col: str, folds: int, max_labelled: int) -> DataFrame:
    """(fold, stats, y) of the labelled rows outside fold 0."""
    truth = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("key")).agg(F.avg(F.col(label_col)).cast("double").alias("y")).where((F.crc32(F.col("key").cast("string")) % folds) != 0)
    n = truth.count()
    if n > max_labelled:
        truth = truth.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(1e6 * max_labelled / n))
    d = stats.select("doc_id", "stats").join(truth, F.col("doc_id") == F.col("key"))
    return d.select((F.crc32(F.col("key").cast("string")) % folds).cast("int").alias("fold"), "stats", "y")


def fit(stats: DataFrame, labels: DataFrame, *, id_col="doc_id", label_col="quality", folds: int = 5, max_labelled: int = 2_000_000, sums: int = 16, ridge: float = 1e-3, bins: int = 2000) -> Model:
    """The model of the (doc_id, stats) rows that labels covers."""
    rows = stash(labelled(stats, labels, id_col, label_col, folds, max_labelled), "quality-labelled")
    part = rows.where(f"fold < {folds - 1}").coalesce(sums)
    total = sum((np.frombuffer(r.sums).reshape(3, -1) for r in part.select("stats").mapInArrow(_moments, "sums binary").collect()), np.zeros((3, len(STATS))))
    n = max(total[0, 0], 1.0)
    mean = total[1] / n
    model = Model(mean, np.sqrt(np.maximum(total[2] / n - mean**2, 1e-4)))
    if not total[0, 0]:
        return model
    normal = sum(np.frombuffer(r.sums).reshape(len(model.coef), -1) for r in part.select("stats", "y").mapInArrow(_normal(model), "sums binary").collect())
    model.coef = np.linalg.solve(normal[:, :-1] + ridge * n * np.diag([1.0] * (len(model.coef) - 1) + [1e-9]), normal[:, -1])
    held = rows.where(f"fold = {folds - 1}").coalesce(sums).select("stats", "y").mapInArrow(_binned(model, bins), "bin long, n double, good double")
    table = sorted(held.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect())  # at most bins rows
    if table:
        x = (np.array([r.bin for r in table]) + 0.5) / bins * 2 - 0.5
        y = isotonic([r.n for r in table], [r.good / r.n for r in table])
        model.x, model.y = x, np.clip(y, 0.001, 0.999)
    return model


def score_of(model: Model):
    @F.arrow_udf("double")
    def run(stats: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(stats)))

    return run


def text_score(model: Model):
    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        rows = [text_stats(x) for x in texts_of(texts)]
        return pa.array(model.score(np.array(rows).reshape(len(rows), len(STATS))))

    return run


def classify(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", threshold: float = 0.3, folds: int = 5, **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    stats = measured(docs, id_col, text_col)
    model = fit(stats, labels, id_col=id_col, folds=folds, **options)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True)).alias("held_out")
    return stats.select("doc_id", held, score_of(model)("stats").alias("score")).withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", label_col="quality", threshold: float = 0.3, **options) -> DataFrame:
    """The documents that the classifier does not reject, with the columns they came with. Statistics for the fit are taken of the
    documents that may have a label (a bit set of fixed size tells), those of the others only once, for their score."""
    spark = docs.sparkSession
    known = id_filter(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long")), 1 << 26)
    wanted = spark.sparkContext.broadcast(Bits(known))

    def maybe(batches):
        for batch in batches:
            hit = in_filter(batch.column(0).to_numpy(zero_copy_only=False), wanted.value.array)
            yield batch.filter(pa.array(hit))

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    model = fit(measured(rows.mapInArrow(maybe, "doc_id long, text string"), "doc_id", "text"), labels, id_col=id_col, label_col=label_col, **options)
    wanted.unpersist()
    scored = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), text_score(model)(docs[text_col]).alias("score"))
    return scored.where(F.col("score") >= threshold).select("row.*")
