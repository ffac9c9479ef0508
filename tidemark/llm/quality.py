"""Text quality by a regularised quadratic discriminant over document statistics.

1. Statistics.  One pass over the texts turns each into ``len(NAMES)`` numbers: sizes as logarithms,
   shares as smoothed log-odds, entropies as they are, so that each is near a bell curve.  They are written
   once (a few numbers a document); everything after works on them.
2. Moments.  Count, sum and sum of outer products per label, over all labelled training rows: every
   task adds up its rows, Spark adds up the tasks by (label, place).  Nothing is sampled.
3. Covariances.  Each label's covariance is mixed with the pooled one by its own number of rows
   (``POOL`` rows' weight goes to the pooled), then shrunk towards a multiple of the identity, in units of the
   pooled deviations, by the closed-form weight of the oracle-approximating estimator.  Their Cholesky
   factors are computed once, inverted by substitution and shipped with the tasks.
4. Scores.  The log-density difference is half the difference of the squared Mahalanobis distances and of
   the log-determinants.  Discriminants of this kind are too sure of themselves, so a logistic
   curve over the difference, fitted on a fixed-size histogram of the training rows, makes it a probability.

Labels are learnt from rows whose crc32(id as text) is not divisible by 5 only; id, language and source
are no inputs.

Defined results: null and empty texts have the statistics of no characters and are scored like any
other; a null id is scored and is no training row; repeated rows each get their score; of several labels of an
id the greatest counts; without training rows of both labels every score is the share of label 1 among
those there are (0 if none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in, saved

POOL = 200.0   # rows' weight of the pooled covariance in each label's
LEAST = 0.05   # added to the pooled deviation of every statistic
LIMIT = 50.0   # bound of the log-density difference
STEP = 20      # bins of the calibration per unit of it (on a root scale)

NAMES = ["words", "word_bytes", "line_words", "upper", "digit", "stop", "shout", "symbol", "other_byte",
         "new_words", "new_lines", "new_pairs", "byte_entropy", "end_marks", "short_words"]

_CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
            "stop": b".,;:'\"()-", "shout": b"!?", "space": b" \t\r\x0b\x0c", "line": b"\n"}
_ASCII = np.zeros((256, 9))
for _k, _bytes in enumerate(_CLASSES.values()):
    _ASCII[list(_bytes), _k] = 1
_ASCII[128:, 8] = 1
_ASCII[:128, 7] = 1 - _ASCII[:128, :7].sum(1)


def log_odds(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    n = len(texts)
    hist = np.empty((n, 256))
    counts = np.empty((n, 7))
    for i, text in enumerate(texts):
        text = text or b""
        hist[i] = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        words, lines = text.split(), text.split(b"\n")
        counts[i] = (len(words), len(set(words)), len(lines), len(set(lines)), len(set(zip(words, words[1:]))),
                     sum(w[-1] in b".!?" for w in words), sum(len(w) < 4 for w in words))
    upper, lower, digit, stop, shout, _, _, symbol, other = (hist @ _ASCII).T
    words, new_words, lines, new_lines, new_pairs, ends, short = counts.T
    total = hist.sum(1)
    share = hist / np.maximum(total, 1)[:, None]
    entropy = -(share * np.log2(np.where(share > 0, share, 1))).sum(1)
    letters = upper + lower + other
    return np.stack([
        np.log1p(words), np.log((letters + digit + 1) / (words + 1)), np.log((words + 1) / (lines + 1)),
        log_odds(upper, upper + lower), log_odds(digit, total), log_odds(stop, total), log_odds(shout, total),
        log_odds(symbol, total), log_odds(other, total), log_odds(new_words, words), log_odds(new_lines, lines),
        log_odds(new_pairs, np.maximum(words - 1, 0)), entropy, log_odds(ends, words), log_odds(short, words)], 1)


def training_part(id_col: Column) -> Column:
    """Rows whose crc32(id as text) is not divisible by 5."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 != 0


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, stats) per row of ``docs``, written once."""
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_in(batches, "id", "text"):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(list(statistics(texts)), pa.list_(pa.float64()))],
                                             ["id", "stats"])

    return saved(plain.mapInArrow(run, "id long, stats array<double>"), "text-statistics")


def moments(known: DataFrame, width: int) -> dict[int, np.ndarray]:
    """Per label the sum of (1, x) (1, x)' over ``known(label, stats)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for labels, stats in rows_in(batches, "label", "stats"):
            x = np.column_stack([np.ones(len(stats)), np.array(stats)])
            y = np.array(labels)
            for label in set(labels):
                own = x[y == label]
                total[label] = total.get(label, 0) + own.T @ own
        for label, m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m.size, label), pa.int32()), pa.array(np.arange(m.size), pa.int32()),
                                              pa.array(m.ravel())], ["label", "place", "value"])

    summed = known.mapInArrow(run, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    out: dict[int, np.ndarray] = {}
    for r in summed.collect():  # two labels' matrices, whatever the rows
        out.setdefault(r["label"], np.zeros((width + 1) ** 2))[r["place"]] = r["value"]
    return {label: m.reshape(width + 1, width + 1) for label, m in out.items()}


class Gaussian(NamedTuple):
    mean: np.ndarray
    whiten: np.ndarray   # inverse of the Cholesky factor
    log_det: float

    def distance(self, x: np.ndarray) -> np.ndarray:
        """Squared Mahalanobis distances and the log-determinant."""
        return (((x - self.mean) @ self.whiten.T) ** 2).sum(1) + self.log_det


def shrinkage(s: np.ndarray, n: float) -> float:
    """Weight of the identity in the oracle-approximating estimator of a covariance from n rows."""
    d, square, trace = len(s), (s ** 2).sum(), np.trace(s)
    left = (n + 1 - 2 / d) * (square - trace ** 2 / d)
    return 1.0 if left <= 0 else float(min(1.0, ((1 - 2 / d) * square + trace ** 2) / left))


def discriminant(sums: dict[int, np.ndarray]) -> dict[int, Gaussian]:
    """Mean, factor and log-determinant per label, from the sums of ``moments``."""
    n = {y: m[0, 0] for y, m in sums.items()}
    mean = {y: m[0, 1:] / n[y] for y, m in sums.items()}
    scatter = {y: m[1:, 1:] - n[y] * np.outer(mean[y], mean[y]) for y, m in sums.items()}
    pooled = sum(scatter.values()) / sum(n.values())
    unit = np.sqrt(np.maximum(np.diag(pooled), 0)) + LEAST  # a constant statistic has no deviation
    out = {}
    for y in sums:
        s = (scatter[y] + POOL * pooled) / (n[y] + POOL) / np.outer(unit, unit)
        w = shrinkage(s, n[y] + POOL)
        s = (1 - w) * s + (w * np.trace(s) / len(s) + 1e-6) * np.eye(len(s))
        factor = np.linalg.cholesky(s)
        whiten = np.linalg.solve(factor, np.eye(len(s))) / unit
        out[y] = Gaussian(mean[y], whiten, 2 * float(np.log(np.diag(factor)).sum()))
    return out


def differences(stats: DataFrame, model: dict[int, Gaussian]) -> DataFrame:
    """``stats`` with ``x``: the log-density difference of label 1 over label 0, on a root scale."""
    names = [c for c in stats.columns if c != "stats"]
    kind = stats.select(*names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own = np.array(batch.column("stats").to_pylist())
                x = (model[0].distance(own) - model[1].distance(own)) / 2
                x = np.sign(x) * np.sqrt(np.minimum(np.abs(x), LIMIT ** 2))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(x)], [*names, "x"])

    return stats.mapInArrow(run, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kind] + ["x double"]))


def curve(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of a lightly ridged logistic curve over (x, label, count) bins."""
    w, ridge = np.zeros(2), np.diag([1e-3, 1e-1])
    x, y, n = (np.array(c, float) for c in zip(*bins))
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = (design * (n * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(slope, design.T @ (n * (y - p)) - ridge @ w)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", label_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (id, score, log_ratio), ``score`` the probability of label 1."""
    prepare(docs.sparkSession)
    stats = measured(docs, id_col, text_col)
    marked = (labels.select(F.col(label_id).cast("long").alias("lid"), F.col(label_col).cast("int").alias("label"))
              .filter(F.col("label").isin(0, 1) & training_part(F.col("lid")))
              .groupBy("lid").agg(F.max("label").alias("label")))

    def known(df: DataFrame, *columns: str) -> DataFrame:
        return df.join(marked, df["id"] == marked["lid"]).select("label", *columns)

    sums = moments(known(stats, "stats"), len(NAMES))
    if set(sums) != {0, 1}:
        prior = 1.0 if set(sums) == {1} else 0.0
        return stats.select(F.col("id").alias(id_col), F.lit(prior).alias("score"), F.lit(0.0).alias("log_ratio"))
    x = differences(stats, discriminant(sums))
    counted = known(x, F.round(F.col("x") * STEP) / STEP).toDF("label", "x").groupBy("x", "label").agg(F.count(F.lit(1)).alias("n"))
    a, b = curve([(r["x"], r["label"], r["n"]) for r in counted.collect()])  # at most 2 x 2 x LIMIT x STEP bins
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) + F.lit(b) * F.col("x"))))
    return x.select(F.col("id").alias(id_col), score.alias("score"), (F.signum("x") * F.col("x") * F.col("x")).alias("log_ratio"))
