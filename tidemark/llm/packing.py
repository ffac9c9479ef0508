"""Packing: order-preserving dynamic programming over window cuts.

Documents are range-partitioned by id, so each task holds a run of neighbouring documents and
packs it in order.  Window ends are chosen at document ends (free), sentence ends (a small
truncation penalty) or, where no sentence end is near enough, inside a sentence (a larger one).
With f(j) the least cost of cutting the tokens before position j into windows,

    f(j) = min over j - W <= i < j of f(i) + padding(j - i) + penalty(j) + window cost

and padding(j - i) = W - (j - i), so the minimum of f(i) + i over a sliding range decides: a
monotone queue gives it in O(1) a position.  Windows of a power-of-two length carry no padding
and are looked up beside the queue.  The stream is cut exactly: as soon as all live states
descend from one cut, everything before it is emitted and forgotten, so a task holds a bounded
stretch of tokens whatever its partition's size.

Token ids: a text is cut before every space that a non-space follows (the tokenizer's own
pattern never joins across such a place) and each distinct piece is encoded once per worker.

Defined results: a null text counts as empty and gives the end id alone; documents keep the
order of (id, row position), null ids first; repeated ids and repeated rows are packed each on
their own; an empty table gives no pieces.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in

WINDOW = 1024
SENTENCE_PENALTY = 1.0   # cutting a document between sentences, in tokens of padding
INSIDE_PENALTY = 16.0    # cutting inside a sentence
WINDOW_COST = 8.0        # each window, so that short ones need a reason
NEAREST = 12             # sentence ends closer than this to the last candidate are skipped
STRETCH = 1 << 21        # tokens planned at once
CACHED_PIECES = 1_000_000

_SPACED = re.compile(r" (?=\S)")
_ODD = re.compile(r" \s")
_BEYOND_LATIN = re.compile("[^" + chr(0) + "-" + chr(0x24F) + "]|<[|]")


class Encoder:
    """Ids of whole texts by pieces, each distinct piece encoded once."""

    def __init__(self, path: str, ranks_path: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.fast = None
        if ranks_path:  # the same vocabulary as ranks: equal ids for Latin text, in a fraction of the time
            import public_tokenizers
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def encode_piece(self, piece: str) -> bytes:
        if self.fast and not _BEYOND_LATIN.search(piece):
            ids = self.fast.encode_ordinary(piece)
        else:
            ids = self.full.encode(piece, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u4")
        parts = _SPACED.split(text) if _ODD.search(text) else text.split(" ")
        if parts[-1] == "" and len(parts) > 1:  # a last space has no word to go with
            parts.pop()
            parts[-1] += " "
        known = self.known
        if len(known) > CACHED_PIECES:
            known.clear()
        out = [self.encode_piece(parts[0])]
        for part in parts[1:]:
            ids = known.get(part)
            if ids is None:
                ids = known[part] = self.encode_piece(" " + part)
            out.append(ids)
        return np.frombuffer(b"".join(out), "<u4")

    def sentence_enders(self) -> np.ndarray:
        """True at ids whose piece ends a sentence or a line."""
        size = self.full.get_vocab_size()
        ends = np.zeros(size, bool)
        for piece, i in self.full.get_vocab().items():
            ends[i] = piece[-1:] in (".", "!", "?", chr(0x10A))  # the last: the byte alphabet's newline
        return ends


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, ranks_path: str | None) -> Encoder:
    """One encoder per worker process, kept for its later tasks."""
    if (path, ranks_path) not in _ENCODERS:
        _ENCODERS[path, ranks_path] = Encoder(path, ranks_path)
    return _ENCODERS[path, ranks_path]


def plan(candidates: list[int], penalties: list[float], window: int, last: bool) -> list[int]:
    """Window ends over positions 1..candidates[-1], increasing.

    Not ``last``: only the ends that every optimal continuation shares."""
    total = candidates[-1]
    short = [1 << k for k in range(5, window.bit_length() - 1) if 1 << k < window]
    pos, cost, back, at = [0], [0.0], [-1], {0: 0}
    key = [0.0]
    queue, hard = deque([0]), deque()
    soft, reach, n = 0, 0, len(candidates)

    def spawn(p: int) -> None:
        nonlocal reach
        limit = p + window
        while reach < n and candidates[reach] <= limit:
            reach += 1
        if limit < total and (reach == 0 or limit - candidates[reach - 1] + penalties[reach - 1] > INSIDE_PENALTY):
            hard.append(limit)

    spawn(0)
    while soft < n:
        p, pen = candidates[soft], penalties[soft]
        if hard and hard[0] < p:
            p, pen = hard.popleft(), INSIDE_PENALTY
        else:
            if hard and hard[0] == p:
                hard.popleft()
            soft += 1
        while pos[queue[0]] < p - window:
            queue.popleft()
        i = queue[0]
        c = key[i] + window - p
        for length in short:
            k = at.get(p - length)
            if k is not None and cost[k] < c:
                i, c = k, cost[k]
        c += pen + WINDOW_COST
        j = len(pos)
        pos.append(p)
        cost.append(c)
        back.append(i)
        at[p] = j
        c += p
        key.append(c)
        while queue and key[queue[-1]] >= c:
            queue.pop()
        queue.append(j)
        if not hard or hard[-1] < p + window:
            spawn(p)
    if last:
        j = len(pos) - 1
    else:
        live = {k for k in range(len(pos)) if pos[k] >= total - window}
        while len(live) > 1:  # the latest common ancestor of all states that a later window can start from
            newest = max(live)
            live.discard(newest)
            live.add(max(back[newest], 0))
        j = live.pop()
    ends = []
    while j > 0:
        ends.append(pos[j])
        j = back[j]
    return ends[::-1]


def split_tail(start: int, end: int, window: int) -> list[int]:
    """Ends for the last stretch: powers of two where they cost less than its padding."""
    length = end - start
    bits = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    if length >= window or len(bits) == 1 or (len(bits) - 1) * (INSIDE_PENALTY + WINDOW_COST) >= window - length:
        return [end]
    return (start + np.cumsum(bits)).tolist()


class Packer:
    """Packs one task's documents; ``add`` and ``finish`` yield pieces as column lists."""

    def __init__(self, enders: np.ndarray, window: int, first_sequence: int):
        self.enders, self.window, self.sequence = enders, window, first_sequence
        self.ids: list[np.ndarray] = []
        self.held = 0                     # tokens held
        self.docs: list[tuple] = []       # (id, tokens, start in the held stretch: may be negative)
        self.planned_at = STRETCH

    def add(self, doc_id, ids: np.ndarray):
        self.docs.append((doc_id, len(ids), self.held))
        self.ids.append(ids)
        self.held += len(ids)
        if self.held >= self.planned_at:
            yield from self.emit(False)

    def finish(self):
        if self.held:
            yield from self.emit(True)

    def candidates(self, ids: np.ndarray) -> tuple[list[int], list[float]]:
        doc_ends = np.array([s + n for _, n, s in self.docs], np.int64)
        sentences = np.flatnonzero(self.enders[ids[:-1]]) + 1
        sentences = sentences[~np.isin(sentences, doc_ends)]
        both = np.concatenate([doc_ends, sentences])
        free = np.concatenate([np.ones(len(doc_ends), bool), np.zeros(len(sentences), bool)])
        order = np.argsort(both, kind="stable")
        ends, pens, before = [], [], -NEAREST
        for p, is_doc in zip(both[order].tolist(), free[order].tolist()):
            if is_doc or p - before >= NEAREST:
                ends.append(p)
                pens.append(0.0 if is_doc else SENTENCE_PENALTY)
                before = p
        return ends, pens

    def emit(self, last: bool):
        ids = np.concatenate(self.ids)
        cuts = plan(*self.candidates(ids), self.window, last)
        if not cuts:  # nothing is settled yet: look again when the stretch has doubled
            self.ids, self.planned_at = [ids], 2 * self.held
            return
        if last:
            cuts[-1:] = split_tail(cuts[-2] if len(cuts) > 1 else 0, cuts[-1], self.window)
        done = cuts[-1]
        starts = np.array([max(s, 0) for _, _, s in self.docs], np.int64)
        edges = np.unique(np.concatenate([[0], cuts, starts[starts < done]]))
        a, b = edges[:-1], edges[1:]
        doc = np.searchsorted(starts, a, side="right") - 1
        window = np.searchsorted(cuts, a, side="right")
        window_start = np.concatenate([[0], cuts])[window]
        raw = np.ascontiguousarray(ids, "<u4")
        crc = [zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), b.tolist())]
        held_start = np.array([s for _, _, s in self.docs], np.int64)
        tokens = np.array([n for _, n, _ in self.docs], np.int64)
        yield ([self.docs[d][0] for d in doc.tolist()], a - held_start[doc], b - a, crc, tokens[doc],
               self.sequence + window, a - window_start)
        self.sequence += len(cuts)
        self.docs = [(i, n, s - done) for i, n, s in self.docs if s + n > done]
        self.ids = [ids[done:].copy()]
        self.held -= done
        self.planned_at = max(STRETCH, 2 * self.held)


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW, end_id: int = 0) -> DataFrame:
    """One row per piece: which ids of a document lie where in which sequence."""
    schema = PIECES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, ranks)
        packer = Packer(enc.sentence_enders(), window, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], "<u4")

        def out(columns):
            names = [c.split()[0] for c in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for ids, texts in rows_in(batches, "id", "text"):
            for doc_id, text in zip(ids, texts):
                for columns in packer.add(doc_id, np.concatenate([enc.encode(text or ""), end])):
                    yield out(columns)
        for columns in packer.finish():
            yield out(columns)

    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"),
                        F.col(text_col).cast("string").alias("text"))
    ordered = plain.repartitionByRange("id", "row").sortWithinPartitions("id", "row")
    return ordered.mapInArrow(run, schema)
