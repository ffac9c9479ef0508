"""Toxicity by maximum-scoring segments of token log-odds.

1. Counts.  A bounded sample of the labelled training part, ``SAMPLE`` rows of each label by a
   hash of their ids, gives for every word the number of toxic and of clean documents with it.
   Words in fewer than ``KNOWN`` documents are pooled by their first 5 and 4 letters, so that a
   stem whose every form is rare is learnt from all of them, and common words say nothing about
   unseen words of the same beginning.
2. Weights.  Log-odds under an informative Dirichlet prior (the pooled counts, scaled); a word or
   beginning weighs nothing unless its z-score passes ``Z``.  A token takes the weight of the
   most specific of these that is known, less a drift that makes clean text score below zero.
3. Segments.  A linear-time scan finds all maximal-scoring segments of a document.
4. Calibration.  Segment scores of clean training documents have an exponential tail; its fitted
   rate and density give every segment an expected number of chance occurrences K n exp(-rate S)
   in a text of n tokens.  A document's evidence is the sum of rate S - ln(K n) over its
   significant segments; a logistic curve, fitted on a fixed-size histogram of the training
   documents' evidence, turns it into a probability.

Documents are scanned for the sample's counts (its ids are at most 2 x ``SAMPLE``, so they are
broadcast and no text is shuffled) and once for segments.  Tail and curve use all training rows.

Defined results: null or empty text has no segment and gets the curve's value at no evidence; a
null id is scored and is no training row; repeated rows each get their score; without both toxic
and clean training rows every score is 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in, saved, text_key, without

SAMPLE = 10_000    # labelled rows of each label that words are counted in
KNOWN = 5          # documents of the sample from which a word stands for itself
BEGINNINGS = (5, 4)
PRIOR = 300.0      # pseudo-documents of the Dirichlet prior
Z = 3.0
CAP = 6.0          # bound of a token's log-odds
DRIFT = 1.0
SIGNIFICANT = 0.05  # chance occurrences of a segment, at most
STRIP = ".,;:!?\"'()[]{}*_-#$%&"


def tokens(text: str | None) -> list[str]:
    return (text or "").lower().split()


def count_words(sample: DataFrame) -> DataFrame:
    """(word, t, c): toxic and clean documents of ``sample(text, toxic)`` per word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, labels in rows_in(batches, "text", "toxic"):
            seen = (Counter(), Counter())
            for text, toxic in zip(texts, labels):
                seen[toxic].update({w.strip(STRIP) for w in tokens(text)})
            words = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()),
                                              pa.array([seen[0][w] for w in words], pa.int64())], ["word", "t", "c"])

    counted = sample.select("text", "toxic").mapInArrow(run, "word string, t long, c long")
    return counted.groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def weighted(counts: DataFrame, n_t: int, n_c: int) -> DataFrame:
    """Adds ``odds``: log-odds of document counts under a Dirichlet prior of pooled shape, 0 where
    the z-score does not pass."""
    t, c = F.least(F.col("t"), F.lit(n_t)), F.least(F.col("c"), F.lit(n_c))  # pooled words may share documents
    alpha = F.lit(PRIOR) * (t + c + 1) / (n_t + n_c + 2)

    def logit(x: Column, n: int) -> Column:
        return F.log((x + alpha) / F.greatest(n + PRIOR - x - alpha, F.lit(1e-3)))

    delta = logit(t, n_t) - logit(c, n_c)
    z = delta / F.sqrt(1 / (t + alpha) + 1 / (c + alpha))
    return counts.withColumn("odds", F.when(z > Z, F.least(delta, F.lit(CAP))).otherwise(0.0))


def learn(sample: DataFrame, n_t: int, n_c: int) -> dict[str, float]:
    """Log-odds by "=word" and "^beginning"; words without weight are listed only where their
    beginning has one.  What reaches the driver is bounded by the sample."""
    counts = saved(count_words(sample), "word-counts").withColumn("n", F.col("t") + F.col("c"))
    words = weighted(counts.filter(F.col("n") >= KNOWN), n_t, n_c)
    parts = F.array(*[F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in BEGINNINGS])
    pooled = (counts.filter(F.col("n") < KNOWN).select(F.explode(F.filter(parts, lambda x: x.isNotNull())).alias("word"), "t", "c")
              .groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") + F.col("c") >= KNOWN))
    beginnings = {r["word"]: r["odds"] for r in weighted(pooled, n_t, n_c).filter("odds > 0").collect()}
    model = {"^" + w: x for w, x in beginnings.items()}
    model.update({"=" + r["word"]: r["odds"] for r in words.filter("odds > 0").collect()})
    if beginnings:
        listed = sample.sparkSession.createDataFrame([(b,) for b in beginnings], "b string")
        at = F.explode(F.filter(parts, lambda x: x.isNotNull()))
        plain = words.filter("odds = 0").select("word", at.alias("b")).join(F.broadcast(listed), "b", "left_semi")
        model.update({"=" + r["word"]: 0.0 for r in plain.select("word").distinct().collect()})
    return model


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score), in one pass."""
    kept: list[tuple[int, int, float, float]] = []  # start, end, sum before it, sum up to its end
    total = 0.0
    for k, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        start, left = k, before
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j -= 1
            if j < 0 or kept[j][3] >= total:
                kept.append((start, k + 1, left, total))
                break
            start, left = kept[j][0], kept[j][2]
            del kept[j:]
    return [(a, b, right - left) for a, b, left, right in kept]


class Weights:
    """Token weights, kept per task."""

    def __init__(self, model: dict[str, float]):
        self.model, self.known = model, {}

    def of(self, token: str) -> float:
        w = self.known.get(token)
        if w is None:
            if len(self.known) > 500_000:
                self.known.clear()
            word = token.strip(STRIP)
            names = ["=" + word, *("^" + word[:k] for k in BEGINNINGS if len(word) >= k)]
            w = self.known[token] = next((self.model[n] for n in names if n in self.model), 0.0) - DRIFT
        return w


def compressed(weights: list[float]) -> tuple[list[float], list[int]]:
    """The scores with each stretch of non-positive ones added up, and where each begins."""
    x = np.array(weights)
    positive = np.flatnonzero(x > 0)
    if not len(positive):
        return [], []
    total = np.concatenate(([0.0], np.cumsum(x)))
    gaps = total[positive[1:]] - total[positive[:-1] + 1]
    out = np.empty(2 * len(positive) - 1)
    out[::2], out[1::2] = x[positive], gaps
    at = np.empty(2 * len(positive) - 1, np.int64)
    at[::2], at[1::2] = positive, positive[:-1] + 1
    return out.tolist(), at.tolist()


def segments(text: str | None, weights: Weights) -> tuple[int, list[tuple[int, int, float]]]:
    """(tokens, maximal segments as token ranges with scores)."""
    own = tokens(text)
    scores, at = compressed([weights.of(w) for w in own])
    return len(own), [(at[a], at[b - 1] + 1, s) for a, b, s in maximal_segments(scores)]


def training_part(id_col: Column) -> Column:
    """Rows whose crc32(id as text) is not divisible by 5."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5 != 0


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", label_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: (id, score, passages array<struct<start,end,evidence>>)."""
    out = scored(docs, labels, id_col, text_col, label_col, label_id)
    return out.select(F.col("id").alias(id_col), "score", "passages")


def scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str = "toxic",
           label_id: str = "doc_id") -> DataFrame:
    """(id, key, score, passages) per row of ``docs``; ``key`` is ``text_key`` of its text."""
    spark = docs.sparkSession
    prepare(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"),
                        F.col(text_col).cast("string").alias("text"))
    marked = (labels.select(F.col(label_id).cast("long").alias("lid"), F.col(label_col).cast("int").alias("toxic"))
              .filter(F.col("toxic").isin(0, 1) & training_part(F.col("lid")))
              .groupBy("lid").agg(F.max("toxic").alias("toxic")))
    n = {r["toxic"]: min(r["n"], SAMPLE) for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [marked.filter(F.col("toxic") == y).orderBy(F.xxhash64("lid"), "lid").limit(SAMPLE) for y in (0, 1)]
    sample = plain.join(F.broadcast(picked[0].unionByName(picked[1])), F.col("id") == F.col("lid"))
    able = bool(n.get(0) and n.get(1))
    model = learn(sample, n[1], n[0]) if able else {}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(model)
        for ids, keys, texts in rows_in(batches, "id", "key", "text"):
            n, found = zip(*(segments(x, weights) for x in texts))
            found = [[{"start": a, "end": b, "s": s} for a, b, s in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(found, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("s", pa.float64())])))],
                ["id", "key", "n", "found"])

    found = saved(plain.mapInArrow(scan, "id long, key long, n long, found array<struct<start:int,end:int,s:double>>"), "segments")
    known = found.join(marked, found["id"] == marked["lid"])
    tail = (known.filter("toxic = 0")
            .agg(F.sum(F.size("found")).alias("k"), F.sum(F.aggregate("found", F.lit(0.0), lambda a, x: a + x["s"])).alias("s"),
                 F.sum("n").alias("n")).first())
    k, s, n = tail["k"] or 0, tail["s"] or 0.0, tail["n"] or 0
    rate, density = (k + 1) / (s + 1.0), (k + 1) / (n + 1.0)  # of segments among clean tokens

    def evidence(df: DataFrame) -> DataFrame:
        chance = F.log(F.lit(density) * F.greatest(F.col("n"), F.lit(1)))
        passages = F.filter(
            F.transform("found", lambda x: F.struct(x["start"], x["end"], (F.lit(rate) * x["s"] - chance).alias("evidence"))),
            lambda x: x["evidence"] > -math.log(SIGNIFICANT))
        df = df.withColumn("passages", passages)
        return df.withColumn("x", F.log1p(F.aggregate("passages", F.lit(0.0), lambda a, p: a + p["evidence"])))

    bins = (evidence(known).groupBy(F.round("x", 2).alias("x"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect())
    a, b = logistic([(r["x"], r["toxic"], r["n"]) for r in bins])
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) + F.lit(b) * F.col("x")))) if able else F.lit(0.0)
    return evidence(found).select("id", "key", score.alias("score"), "passages")


def logistic(bins: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope of a lightly ridged logistic curve over (x, label, count) bins."""
    w = np.zeros(2)
    if not bins:
        return 0.0, 0.0
    x, y, n = (np.array(c, float) for c in zip(*bins))
    design = np.stack([np.ones_like(x), x], 1)
    ridge = np.diag([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + ridge, design.T @ (n * (y - p)) - ridge @ w)
        w += step
        if abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without those scored at ``threshold`` or above; rows go by id and text, on which
    alone a score depends."""
    return without(docs, scored(docs, labels, id_col, text_col).filter(F.col("score") >= threshold), id_col, text_col)
