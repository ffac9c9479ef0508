"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a maximal stretch of words with smallest period q that is at least ``max(shortest,
exponent * q)`` words long.  Every word of a run occurs at least ``exponent`` times in it.

1. Splitting.  Words that occur fewer than ``exponent`` times within the current segment belong to
   no run of it: they split the segment.  The parts are counted again, and so on until nothing
   changes; parts shorter than ``shortest`` go.  All segments of a text are counted in one pass.
2. Lag scan.  A surviving segment is scanned at every lag q it can hold.  Words q apart agree over
   (exponent - 1) q places of a run, which hold exponent - 1 multiples of q, so only every q-th word is
   looked at: m / q comparisons for lag q, m log m for all lags.  Where ``exponent`` such words agree,
   and sums of powers say that the words between them do, the stretch is compared word by word and
   extended to both sides.
3. Smallest periods.  Lags go up in powers of two, runs of one power cover places for the next: a
   stretch that lies in a run of a smaller period has that smaller period (two periods p and q over
   p + q words make their greatest common divisor one), so it is no run of its own.

Texts are read once, in the tasks that scan them; nothing is shuffled, and one text is held at a time
beside its Arrow batch.  Words are the stretches of bytes other than space and the controls 9 to 13.

Defined results: null and empty texts have no words, no runs and an empty collapsed text; a null id
is a row like any other; repeated rows each get their result; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in

EXPONENT = 4
SHORTEST = 6
SCAN = 1 << 20  # comparisons of the lag scan made at once
PRIME, BASE = (1 << 31) - 1, 1_000_003

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def codes_of(words: list[bytes]) -> np.ndarray:
    """The words as numbers, in order of first occurrence."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def surviving(codes: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int]]:
    """Segments (start, end) in which every word occurs ``exponent`` times or more."""
    if len(codes) < shortest:
        return []
    often = np.bincount(codes)[codes] >= exponent
    at = np.flatnonzero(often)
    segment = np.zeros(len(at), np.int64)
    changed = True
    while changed and len(at):
        # parts of neighbouring places; those too short to hold a run go
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(segment) != 0)
        segment = np.cumsum(new) - 1
        at_least = np.bincount(segment)[segment] >= shortest
        at, segment = at[at_least], segment[at_least]
        # words counted again, each within its own segment
        _, place, n = np.unique(segment * (codes.max() + 1) + codes[at], return_inverse=True, return_counts=True)
        often = n[place] >= exponent
        changed = not often.all()
        at, segment = at[often], segment[often]
    if not len(at):
        return []
    ends = np.flatnonzero(np.append(np.diff(segment) != 0, True))
    starts = np.append(0, ends[:-1] + 1)
    return list(zip(at[starts].tolist(), (at[ends] + 1).tolist()))


def powers(n: int) -> np.ndarray:
    """The first n powers of ``BASE`` modulo ``PRIME``."""
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * (out[-1] * BASE % PRIME) % PRIME])
    return out[:n]


def sampled(x: np.ndarray, sums: np.ndarray, power: np.ndarray, lo: int, hi: int,
            exponent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags) with lo <= lag < hi where ``exponent`` words, each a lag apart, agree and so
    do the words between them; places are multiples of their lag, sorted by lag and place,
    ``SCAN`` comparisons at a time."""
    while lo < hi:
        lags = np.arange(lo, hi)
        counts = (len(x) - 1) // lags - (exponent - 2)
        upto = max(1, int(np.searchsorted(np.cumsum(counts), SCAN)))
        lags, counts = lags[:upto], counts[:upto]
        lo += upto
        lag = np.repeat(lags, counts)
        place = (np.arange(len(lag)) - np.repeat(np.cumsum(counts) - counts, counts)) * lag
        for k in range(1, exponent):
            same = x[place] == x[place + k * lag]
            place, lag = place[same], lag[same]
        # so does all between the first and the last sample: sums of powers tell, but for rare accidents
        n = (exponent - 2) * lag + 1
        left, right = sums[place + n] - sums[place], sums[place + lag + n] - sums[place + lag]
        same = (left * power[lag] - right) % PRIME == 0
        if same.any():
            yield place[same], lag[same]


def stretch(x: np.ndarray, place: int, lag: int) -> tuple[int, int] | None:
    """The maximal (start, end) around ``place`` whose words ``lag`` apart agree; None if the
    words from ``place`` on do not agree over one lag."""
    if not np.array_equal(x[place:place + lag], x[place + lag:place + 2 * lag]):
        return None
    end, step = place + lag, max(lag, 16)  # end: first place whose word differs from the one a lag on
    last = len(x) - lag
    while end < last:
        upto = min(end + step, last)
        differ = x[end:upto] != x[end + lag:upto + lag]
        if differ.any():
            end += int(differ.argmax())
            break
        end, step = upto, step * 2
    start, step = place, max(lag, 16)
    while start > 0:
        low = max(start - step, 0)
        differ = x[low:start] != x[low + lag:start + lag]
        if differ.any():
            start -= int(differ[::-1].argmax())
            break
        start, step = low, step * 2
    return start, end + lag


def lag_scan(x: np.ndarray, exponent: int, shortest: int) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of one segment."""
    runs: list[tuple[int, int, int]] = []
    longest = len(x) // exponent
    reach = np.zeros(len(x), np.int64)  # end of the furthest run found so far that holds a place
    power = powers(len(x))
    sums = np.concatenate([[0], np.cumsum((x + 1) * power % PRIME) % PRIME])
    lo = 1
    while lo <= longest:
        found: list[tuple[int, int, int]] = []
        for place, lag in sampled(x, sums, power, lo, min(2 * lo, longest + 1), exponent):
            new = reach[place] <= place + (exponent - 1) * lag
            place, lag = place[new], lag[new]
            k = 0
            while k < len(place):
                i, q = int(place[k]), int(lag[k])
                whole = stretch(x, i, q)
                k += 1
                if whole is not None:
                    start, end = whole
                    if end - start >= max(shortest, exponent * q) and reach[start] < end:
                        found.append((start, end - start, q))
                    # the samples of the same stretch are done
                    k += int(np.searchsorted(place[k:k + np.searchsorted(lag[k:], q, side="right")], end - q))
        for start, length, _ in found:
            part = reach[start:start + length]
            np.maximum(part, start + length, out=part)
        runs += found
        lo *= 2
    return runs


def runs_of(codes: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period), by start, then period."""
    out = []
    for a, b in surviving(codes, exponent, shortest):
        out += [(a + start, length, q) for start, length, q in lag_scan(codes[a:b], exponent, shortest)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return b" ".join([w for w, inside in zip(words, np.cumsum(edge).tolist()) if not inside])


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth id (by crc32), repeating a stretch from some place to their end."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT,
                  shortest: int = SHORTEST, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """One row per row of ``docs``: (id, n_words, runs, collapsed).  ``rewrite(id, words)``, if given,
    replaces a text's words before they are scanned."""
    if exponent < 3 or shortest < 1:
        raise ValueError("a run needs three periods and one word at least")
    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in rows_in(batches, "id", "text"):
            sizes, runs, kept = [], [], []
            for doc_id, text in zip(ids, texts):
                words = (text or b"").split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                own = runs_of(codes_of(words), exponent, shortest)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                kept.append(collapsed(words, own).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(runs, kind),
                                              pa.array(kept, pa.string())], ["id", "n_words", "runs", "collapsed"])

    out = plain.mapInArrow(scan, f"id long, n_words long, runs {RUNS}, collapsed string")
    return out.withColumnRenamed("id", id_col)
