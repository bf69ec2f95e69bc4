"""Quality scores: random Fourier features over document statistics, ridge regression by partition-summed normal
equations, isotonic calibration."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, strings

STATISTICS = ["chars", "words", "lines", "word_len", "long_words", "caps", "letters", "digits", "symbols", "ends", "bars", "bangs", "marks", "distinct", "top_word", "repeats", "line_repeats", "line_len", "short_lines", "title_words"]
_MARKED = re.compile(r"[^\w\s]{2,}(?=\s|$)")


def statistics(text: str | None) -> list[float]:
    """The numbers that stand for a document; all 0 for null, empty and blank texts."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    bytes_ = max(1, len(raw))
    upper = int(counts[65:91].sum())
    letters = upper + int(counts[97:123].sum()) + int(counts[128:].sum())
    digits = int(counts[48:58].sum())
    spaces = int(counts[[9, 10, 11, 12, 13, 32]].sum())
    lines = text.split("\n")
    seen = Counter(words)
    pairs = sum(map(str.__eq__, words, words[1:]))
    caps = sum(map(str.isupper, words))
    return [
        np.log1p(size), np.log1p(n), np.log1p(len(lines)),
        (size - spaces) / n, sum(len(w) > 12 for w in seen) / len(seen),
        caps / n, letters / bytes_, digits / bytes_, (bytes_ - letters - digits - spaces) / bytes_,
        int(counts[[46, 33, 63]].sum()) / n, int(counts[124]) / n, int(counts[33]) / n, len(_MARKED.findall(text)) / n,
        len(seen) / n ** 0.8, seen.most_common(1)[0][1] / n, pairs / n,
        1 - len(set(lines)) / len(lines), np.log1p(size / len(lines)), sum(len(x) < 20 for x in lines) / len(lines), sum(map(str.istitle, words)) / n,
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stats array<double>``, one row per row, reading whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = [statistics(t) for t in strings(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["doc_id", "stats"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, stats array<double>")


@dataclass
class QualityModel:
    """A fitted model: standardisation, the random features, their weights, the calibration's steps."""

    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        out = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.freq + self.phase)
        return np.concatenate((np.ones((len(z), 1)), out, z / 6), axis=1)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Between 0 and 1; a thousandth of it follows the uncalibrated score, which parts ties."""
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, self.knots, self.levels) + 0.001 * np.clip(raw, 0, 1)


def isotonic(weights: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence next to ``values`` in weighted squares (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for w, v in zip(weights.tolist(), values.tolist(), strict=True):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.repeat([b[1] for b in blocks], [int(b[2]) for b in blocks])


def _summed(frame: DataFrame, width: int, rows_of) -> np.ndarray:
    """The sum over all rows of ``rows_of(stats, label)``, a matrix: summed in each partition, then by row of the matrix."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                x = np.array(b.column(0).to_pylist(), np.float64).reshape(b.num_rows, len(STATISTICS))
                s = rows_of(x, np.array(b.column(1).to_pylist(), np.float64))
                total = s if total is None else total + s
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "v"])

    pieces = frame.select("stats", "y").mapInArrow(part, "i int, v array<double>")
    sums = pieces.groupBy("i").agg(*(F.sum(F.get("v", F.lit(j))).alias(f"c{j}") for j in range(width))) if width <= 64 else pieces.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    got = sums.collect()  # as many rows as the matrix has, or cells: bounded by the number of features
    if not got:
        return np.zeros((0, width))
    out = np.zeros((1 + max(r["i"] for r in got), width))
    for r in got:
        if width <= 64:
            out[r["i"]] = r[1:]
        else:
            out[r["i"], r["j"]] = r["x"]
    return out


def fit(labelled: DataFrame, features: int = 160, gamma: float = 0.02, ridge: float = 1e-3, bins: int = 500, seed: int = 11) -> QualityModel:
    """``labelled (doc_id, stats, y)`` with y 0 or 1, all of it, to a model.

    Rows whose crc32(doc_id) mod 5 is 1 calibrate, the others fit the ridge regression; with no rows to fit or
    to calibrate, the score is the mean label, or one half without labels. Sums of at most ``(features + 21)**2``
    numbers reach the driver.
    """
    d = len(STATISTICS)
    rng = np.random.default_rng(seed)
    freq, phase = rng.normal(size=(d, features)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, features)
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    train, held = labelled.where(part != 1), labelled.where(part == 1)
    moments = _summed(train, d + 2, lambda x, y: np.array([[len(x), *x.sum(0), y.sum()], [0, *(x * x).sum(0), 0]]))
    total = moments[0, 0] if len(moments) else 0
    mean = moments[0, 1:-1] / total if total else np.zeros(d)
    scale = np.sqrt(np.maximum(moments[1, 1:-1] / total - mean**2, 0)) if total else np.ones(d)
    scale[scale < 1e-9] = 1
    flat = QualityModel(mean, scale, freq, phase, np.zeros(1 + features + d), np.array([0.0, 1.0]), np.full(2, moments[0, -1] / total if total else 0.5))
    if not total:
        return flat
    width = 1 + features + d

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        f = flat.features(x)
        return np.concatenate((f.T @ f, (f.T @ y)[:, None]), axis=1)

    sums = _summed(train, width + 1, normal)
    weights = np.linalg.solve(sums[:, :width] + ridge * total * np.diag([1e-6] + [1.0] * (width - 1)), sums[:, width])
    model = QualityModel(mean, scale, freq, phase, weights, flat.knots, flat.levels)

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = np.clip(((model.raw(x) + 0.5) * (bins / 2)).astype(int), 0, bins - 1)
        return np.stack((np.bincount(at, minlength=bins), np.bincount(at, y, bins)), axis=1)

    hist = _summed(held, 2, binned)
    full = np.flatnonzero(hist[:, 0]) if len(hist) else []
    if len(full) < 2:
        model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    else:
        prior = hist[:, 1].sum() / hist[:, 0].sum()
        n, good = hist[full, 0], hist[full, 1]
        model.knots, model.levels = (full + 0.5) / (bins / 2) - 0.5, isotonic(n, (good + 0.5 * prior) / (n + 0.5))
    return model


def apply(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``stats (doc_id, stats)`` to ``doc_id, score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            x = np.array(part.column(1).to_pylist(), np.float64).reshape(part.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id) -> F.Column:
    """Whether no label of this document is learned: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on all rows with a 0/1 quality label that aren't held out. A document labelled twice counts twice."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("y")).where("y in (0, 1)")
    y = y.where(~held_out(F.col("doc_id")))
    return fit(stats.join(y, "doc_id"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs (doc_id, text, ...)``, ``labels (doc_id, quality, ...)`` to ``doc_id, held_out, score, predicted``.

    One row per row of ``docs``, repeated ones too. Null and empty texts have the score of all-zero statistics.
    A null doc_id is held out. Other columns are ignored. Without labels every score is one half.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    stats = scratch.save(with_statistics(docs), "stats")
    out = apply(stats, learn(stats, labels))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns; of repeated rows all or none.

    Each text is read once: its statistics are written beside the row. Null and empty texts have the score of all-zero
    statistics. A null doc_id has no label. Without labels every score is one half, so every row stays.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct(*docs.columns).alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows = [statistics(t) for t in strings(part.column(1))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.list_(pa.float64())), part.column(2)], names=["doc_id", "stats", "doc"])

    stats = scratch.save(whole.mapInArrow(run, f"doc_id long, stats array<double>, doc {whole.schema['doc'].dataType.simpleString()}"), "stats")
    model = learn(stats.select("doc_id", "stats"), labels)

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(column.to_numpy())) if len(column) else [], dtype=np.float64)

    return stats.where(score(F.col("stats")) >= threshold).select("doc.*")
