"""Document quality: random Fourier features of text statistics, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from assay.llm.langid import held_out
from assay.scratch import Scratch

_FEATURES = 256
_BINS = 1024
_LOW, _HIGH = -0.5, 1.5

_CLASS = np.full(0x250, 6, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 space, 4 sentence signs, 5 other signs, 6 other letters and the rest
for _c in range(0x250):
    _s = chr(_c)
    _CLASS[_c] = 0 if _s.islower() else 1 if _s.isupper() else 2 if _s.isdigit() else 3 if _s.isspace() else 4 if _s in ".,;:?'\"()-" else 5 if _c < 0xC0 else 6


def statistics(text: str) -> list[float]:
    """About two dozen figures of a whole text, each of moderate size; all are defined for the empty text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = max(1, len(codes))
    kinds = np.bincount(_CLASS[np.minimum(codes, 0x24F)], minlength=7) / n
    words = text.split()
    w = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    lines = [s for s in text.split("\n") if s.strip()]
    counts = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    repeated = sum(c - 1 for c in triples.values())
    letters = max(1e-9, kinds[0] + kinds[1] + kinds[6])
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        lengths.mean(),
        lengths.std(),
        lengths.max() ** 0.5,
        *kinds.tolist(),
        kinds[1] / letters,
        text.count("!") / w,
        text.count("|") / w,
        sum(text.count(c) for c in "#$%&*@") / w,
        len(counts) / w**0.85,
        sum(map(eq, words, words[1:])) / w,
        repeated / w,
        max(counts.values(), default=0) / w,
        sum(map(str.isupper, words)) / w,
        (lengths <= 3).mean(),
        math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        sum(s.rstrip()[-1] in ".!?" for s in lines) / max(1, len(lines)),
        math.log1p(len(text) / max(1, len(lines))),
    ]


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        figures = [statistics(t or "") for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(figures, pa.list_(pa.float64()))], ["id", "held_out", "stats"])


class Kernel:
    """Standardises statistics and maps them to cosines whose products approximate a Gaussian kernel."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, width: float = 1.0, features: int = _FEATURES, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.mean, self.deviation = mean, np.where(deviation > 1e-12, deviation, 1.0)
        self.turn = rng.normal(size=(len(mean), features)) * width / math.sqrt(len(mean))
        self.shift = rng.uniform(0, 2 * math.pi, features)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.deviation, -6, 6)
        z = np.cos(x @ self.turn + self.shift) * math.sqrt(2 / len(self.shift))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _normal(batches: Iterator[pa.RecordBatch], kernel: Kernel) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if len(batch):
            z = kernel(_matrix(batch.column("stats")))
            zy = np.concatenate([z, np.array(batch.column("quality"), float)[:, None]], axis=1)
            total = zy.T @ zy if total is None else total + zy.T @ zy
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for b in batch.column(0).to_pylist():
            s = np.frombuffer(b)
            total = s if total is None else total + s
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators: centres and values of the non-decreasing step function closest to y."""
    blocks: list[list[float]] = []  # weight, sum of x, sum of y
    for a, b, w in zip(x, y, weight):
        blocks.append([w, a * w, b * w])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][0] >= blocks[-1][2] / blocks[-1][0]:
            w2, a2, b2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + w2, blocks[-1][1] + a2, blocks[-1][2] + b2]
    return np.array([b[1] / b[0] for b in blocks]), np.array([b[2] / b[0] for b in blocks])


class Scorer:
    """Kernel ridge scores with their calibration; monotone in the raw score."""

    def __init__(self, kernel: Kernel, coef: np.ndarray):
        self.kernel, self.coef, self.x, self.y = kernel, coef, np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.kernel(stats) @ self.coef, _LOW, _HIGH)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        r = self.raw(stats)
        # a thousandth of the raw score keeps apart what one step of the calibration joins
        return np.clip(0.999 * np.interp(r, self.x, self.y) + 0.001 * (r - _LOW) / (_HIGH - _LOW), 0.0, 1.0)


def _bins(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r = scorer.raw(_matrix(batch.column("stats"))) if len(batch) else np.zeros(0)
        bins = np.minimum(((r - _LOW) / (_HIGH - _LOW) * _BINS).astype(np.int32), _BINS - 1)
        yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("quality")], ["bin", "quality"])


def _score(batches: Iterator[pa.RecordBatch], scorer: Scorer | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        s = scorer(_matrix(batch.column("stats"))) if scorer and len(batch) else np.full(len(batch), 0.5)
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(s), pa.array((s >= 0.3).astype(np.int32))], ["id", "held_out", "score", "predicted"])


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held_out(F.col(id_col), folds).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_stats, "id long, held_out boolean, stats array<double>")


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", *, ridge: float = 1e-4, folds: int = 5) -> Scorer | None:
    """Learns from every labelled row that isn't held out; one remainder of the ids calibrates, the others fit.

    The driver gathers sums only: moments, normal equations (2 KB times the number of features, added up in two levels), and 1024 score bins.
    Null where no label can be used.
    """
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("double").alias("quality"))
    known = stats.where("not held_out and id is not null").join(y, "id")
    turn = F.crc32(F.col("id").cast("string")) % folds
    n_stats = len(statistics(""))
    s = F.col("stats")
    row = stats.agg(*[F.avg(s[k]).alias(f"m{k}") for k in range(n_stats)], *[F.stddev_pop(s[k]).alias(f"d{k}") for k in range(n_stats)]).first()
    if row["m0"] is None:
        return None
    kernel = Kernel(np.array([row[f"m{k}"] for k in range(n_stats)]), np.array([row[f"d{k}"] for k in range(n_stats)]))
    spark = stats.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sums = known.where(turn != folds - 1).select("stats", "quality").mapInArrow(lambda it: _normal(it, kernel), "sums binary")
    parts = sums.repartition(max(1, math.isqrt(width))).mapInArrow(_add, "sums binary").collect()
    if not parts:
        return None
    d = len(kernel.shift) + 2
    total = sum(np.frombuffer(p[0]) for p in parts).reshape(d, d)
    a, b, n = total[:-1, :-1], total[:-1, -1], total[-2, -2]
    scorer = Scorer(kernel, np.linalg.solve(a + ridge * n * np.eye(d - 1), b))
    bins = known.where(turn == folds - 1).select("stats", "quality").mapInArrow(lambda it: _bins(it, scorer), "bin int, quality double")
    got = sorted(bins.groupBy("bin").agg(F.count("*"), F.sum("quality")).collect())
    if got:
        k, n, y1 = (np.array(c, float) for c in zip(*got))
        scorer.x, scorer.y = isotonic(_LOW + (k + 0.5) * (_HIGH - _LOW) / _BINS, y1 / n, n)
    return scorer


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, folds: int = 5, scratch: Scratch | None = None) -> DataFrame:
    """One row ``(id, held_out, score, predicted)`` per row of ``docs``; score is the calibrated likelihood of label 1, predicted marks 0.3 and more.

    Whole texts are read once. Null text counts as empty; empty texts are scored by the same figures. Without
    any usable label every score is 0.5. Repeated rows and null ids keep their rows (null ids are never
    learned from); an empty table gives an empty result; other columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "quality")
    stats = scratch.save(text_statistics(docs, id_col, text_col, folds), "statistics")
    scorer = fit(stats, labels, id_col, label_col, folds=folds)
    return stats.mapInArrow(lambda it: _score(it, scorer), "id long, held_out boolean, score double, predicted int")
