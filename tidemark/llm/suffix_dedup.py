"""Suffix-array dedup: every byte of a repeated passage but its first occurrence is removed.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier (smaller id, of
one id's different texts the smaller hash, or the same document and an earlier start).  Sorting every suffix of the corpus would shuffle a
hundred times its bytes, so suffixes are sorted where repeats can be:

1. Anchors.  Of the ``LENGTH - K + 1`` K-grams in a window, the one with the least hash (the
   leftmost of several) is its anchor, and equal windows have equal anchors at equal places.  A
   scan lists the anchors of all documents, about one in 33 bytes: the hash, a digest of the
   context that all windows of this anchor lie in, id and position.
2. Equal contexts.  Anchors with equal contexts repeat the earliest of them as a whole: the
   others' contexts are marked, first within each scan batch (so that a passage in a third of all
   documents leaves one row a batch), then across the corpus.
3. Suffix sorting.  Earliest contexts that share an anchor's K-gram but differ somewhere may
   still share windows.  Their bytes are fetched, and the suffixes that start at the anchors are
   sorted by deep-shallow sorting (as are the reversed left contexts): multikey quicksort on
   8-byte characters down to ``SHALLOW`` bytes, then a blind trie for each group that is still
   equal.  Neighbours' common prefixes in both orders tell, for each of the windows around an
   anchor, which anchors share it; all but the earliest are marked.
4. Marks are merged per document and cut out.

Defined results: a null text counts as empty; a null id's row keeps its text and is no source of
repeats; a document is an id and a text (told by its 64-bit hash ``key``): equal rows are one
document, no repeats of each other, and all are cut alike, while different texts of one id are
documents of their own, in order of their hash; texts under ``LENGTH`` bytes are whole; empty input
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in, saved

LENGTH, K = 100, 36
LEFT = LENGTH - K            # bytes before an anchor that its windows reach
SHALLOW = 40                 # depth of the multikey quicksort, a multiple of 8
PIECE = 1 << 20              # bytes of a document scanned at once
CHUNK = 25_000               # contexts sorted at once (more only for one K-gram's own contexts)


def kgram_hashes(b: np.ndarray) -> np.ndarray:
    """A mixed polynomial hash of every K-gram (K = 32 + 4), by doubling."""
    x = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    power, four, n = np.uint64(0x100000001B3), None, 1
    while n < 32:
        x = x[:-n] * power + x[n:]
        power = power * power
        n *= 2
        if n == 4:
            four, by_four = x, power
    m = len(b) - K + 1
    h = x[:m] * by_four + four[32:32 + m]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all windows of ``text``."""
    if len(text) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    b, out = np.frombuffer(text, np.uint8), []
    low = np.uint64((1 << 23) - 1)
    with np.errstate(over="ignore"):
        for at in range(0, len(b) - LENGTH + 1, PIECE):
            h = kgram_hashes(b[at:at + PIECE + LENGTH - 1])
            v = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # the leftmost of equal hashes
            width, span, least = LENGTH - K + 1, 1, v
            while span * 2 <= width:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            n = len(h) - width + 1
            if span < width:
                least = np.minimum(least[:n], least[width - span:width - span + n])
            p = (least & low).astype(np.int64)
            p = p[np.concatenate(([True], p[1:] != p[:-1]))]
            out.append((p + at, h[p]))
    p, h = (np.concatenate(c) for c in zip(*out))
    p, first = np.unique(p, return_index=True)
    return p, h[first]


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals, as maximal runs."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], s[1:] > e[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(s) - 1]))
    return s[new], e[last]


FOUND = "h long, digest long, id long, key long, pos long, stop long"  # stop < 0: an anchor, else a mark [pos, stop)


def found(*columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype(np.int64)) for c in columns],
                                      [c.split()[0] for c in FOUND.split(", ")])


def marks(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Marks merged per document; they travel under a hash of their id."""
    if not len(ids):
        return
    order = np.lexsort((keys, ids))
    ids, keys, starts, stops = ids[order], keys[order], starts[order], stops[order]
    cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])) + 1
    out = []
    for a, b in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(ids)])).tolist()):
        s, e = merged(starts[a:b], stops[a:b]) if b - a > 1 else (starts[a:b], stops[a:b])
        out.append((np.full(len(s), ids[a]), np.full(len(s), keys[a]), s, e))
    ids, keys, starts, stops = (np.concatenate(c) for c in zip(*out))
    with np.errstate(over="ignore"):
        yield found(ids * np.int64(0x5851F42D4C957F2D), np.zeros(len(ids), np.int64), ids, keys, starts, stops)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps 1 and 2 within a batch: earliest anchors of each context, marks for the others."""
    for ids, keys, texts in rows_in(batches, "id", "key", "text"):
        own, digests = [], []
        documents = {(ids[i], keys[i]): texts[i] for i in range(len(ids)) if ids[i] is not None and texts[i]}
        for (i, key), text in sorted(documents.items()):
            p, h = anchors(text)
            own.append((np.full(len(p), i, np.int64), np.full(len(p), key, np.int64), p, h))
            digests.extend([xxhash.xxh64_intdigest(text[a - LEFT if a > LEFT else 0:a + LENGTH], min(a, LEFT)) for a in p.tolist()])
        if not own:
            continue
        ids, keys, pos, h = (np.concatenate(c) for c in zip(*own))
        digest = np.array(digests, np.uint64)
        with np.errstate(over="ignore"):
            both = h * np.uint64(0x9E3779B97F4A7C15) ^ digest
        order = np.argsort(both, kind="stable")  # rows are in order of (id, key, position) already
        first = np.ones(len(order), bool)
        first[1:] = both[order[1:]] != both[order[:-1]]
        keep, rest = np.sort(order[first]), order[~first]
        yield found(h[keep].view(np.int64), digest[keep].view(np.int64), ids[keep], keys[keep], pos[keep], np.full(len(keep), -1))
        yield from marks(ids[rest], keys[rest], np.maximum(pos[rest] - LEFT, 0), pos[rest] + LENGTH)


def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 2 across the corpus, over rows sorted by ``h``: marks, and as anchors the earliest of
    each context where a K-gram has several contexts."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if held is not None:
            rows = np.concatenate([held, rows], axis=1)
        complete = np.searchsorted(rows[0], rows[0][-1])  # the last K-gram may go on in the next batch
        held = rows[:, complete:]
        yield from match_groups(rows[:, :complete])
    if held is not None:
        yield from match_groups(held)


def match_groups(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
    done = rows[:, rows[5] >= 0]
    if done.shape[1]:
        yield found(*done)
    h, digest, ids, keys, pos = rows[:5, rows[5] < 0]
    if len(h) < 2:
        return
    order = np.lexsort((pos, keys, ids, digest, h))
    h, digest, ids, keys, pos = (c[order] for c in (h, digest, ids, keys, pos))
    new_h = np.concatenate(([True], h[1:] != h[:-1]))
    new = new_h | np.concatenate(([True], digest[1:] != digest[:-1]))
    least = np.flatnonzero(new)[np.cumsum(new) - 1]  # the earliest of each context, which equal rows repeat
    later = (ids != ids[least]) | (keys != keys[least]) | (pos != pos[least])
    yield from marks(ids[later], keys[later], np.maximum(pos[later] - LEFT, 0), pos[later] + LENGTH)
    contexts = np.bincount(np.cumsum(new_h) - 1, weights=new)
    open_ = new & (contexts[np.cumsum(new_h) - 1] > 1)
    if open_.any():
        yield found(h[open_], digest[open_], ids[open_], keys[open_], pos[open_], np.full(int(open_.sum()), -1))


# ------------------------------------------------------------------------- deep-shallow sorting

def blind_order(strings: list[bytes]) -> list[int]:
    """Sorted order of ``strings`` by a blind trie: nodes hold only the depth at which their
    children differ; a new string is led to some leaf by those bytes alone, compared with it
    once, and hung in where the two part.  Equal strings share a leaf."""
    root = None  # leaf: list of indexes; inner node: (depth, {byte or -1 at the end: node})
    for i, s in enumerate(strings):
        if root is None:
            root = [i]
            continue
        node = root
        while type(node) is tuple:
            depth, children = node
            c = s[depth] if depth < len(s) else -1
            node = children[c] if c in children else next(iter(children.values()))
        t = strings[node[0]]
        m = min(len(s), len(t))
        x = int.from_bytes(s[:m], "big") ^ int.from_bytes(t[:m], "big")
        common = m - (x.bit_length() + 7) // 8
        if common == len(s) == len(t):
            node.append(i)
            continue
        here, there = (u[common] if common < len(u) else -1 for u in (s, t))
        node, parent, edge = root, None, None
        while type(node) is tuple and node[0] < common:
            parent, edge = node, s[node[0]]
            node = node[1][edge]
        if type(node) is tuple and node[0] == common:
            node[1][here] = [i]
            continue
        fresh = (common, {there: node, here: [i]})
        if parent is None:
            root = fresh
        else:
            parent[1][edge] = fresh
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if type(node) is tuple:
            stack.extend(node[1][c] for c in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(rows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte strings (zero-padded rows of ``lengths``) and the common prefix of
    each with its predecessor (-1 for the first)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    chars = padded.view(">u8").astype(np.uint64)
    shallow = min(SHALLOW // 8, chars.shape[1])
    out: list[np.ndarray] = []
    stack = [(np.arange(n), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) <= 1:
            out.append(group)
        elif depth == shallow:
            deep = [rows[i, depth * 8:lengths[i]].tobytes() if lengths[i] > depth * 8 else b"" for i in group.tolist()]
            out.append(group[blind_order(deep)])
        else:
            c = chars[group, depth]
            pivot = c[len(c) // 2]
            less, more = c < pivot, c > pivot
            if more.any():
                stack.append((group[more], depth))
            stack.append((group[~(less | more)], depth + 1))
            if less.any():
                stack.append((group[less], depth))
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    common = np.full(n, -1, np.int64)
    for a in range(1, n, 1 << 15):
        x, y = order[a - 1:min(n, a + (1 << 15)) - 1], order[a:a + (1 << 15)]
        differ = rows[x] != rows[y]
        prefix = np.where(differ.any(1), differ.argmax(1), width)
        common[a:a + len(y)] = np.minimum(prefix, np.minimum(lengths[x], lengths[y]))
    return order, common


def shared_windows(ids, keys, pos, left: list[bytes], right: list[bytes]) -> tuple[np.ndarray, ...]:
    """Marks (id, key, start, stop) among contexts: ``left`` are the reversed bytes before the
    anchors, ``right`` those from the anchors on."""
    n = len(ids)
    sides = []
    for strings, width in ((left, LEFT), (right, LENGTH)):
        rows = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8).reshape(n, width)
        lengths = np.array([len(s) for s in strings], np.int64)
        sides.append(deep_shallow(rows, lengths))
    (left_order, left_common), (right_order, right_common) = sides
    by_age = np.lexsort((pos, keys, ids))
    low, high = np.full(n, LENGTH), np.full(n, -1)
    left_class, right_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(LEFT + 1):  # the window that starts o bytes before the anchor
        left_class[left_order] = np.cumsum(left_common < o) if o else 0
        right_class[right_order] = np.cumsum(right_common < LENGTH - o)
        key = (right_class * (n + 1) + left_class)[by_age]
        _, first = np.unique(key, return_index=True)
        later = np.ones(n, bool)
        later[first] = False
        who = by_age[later]
        low[who] = np.minimum(low[who], o)
        high[who] = o
    hit = np.flatnonzero(high >= 0)  # windows around one anchor overlap, so their union is one run
    return ids[hit], keys[hit], pos[hit] - high[hit], pos[hit] - low[hit] + LENGTH


def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the listed anchors of each document."""
    for ids, keys, texts, places, hashes in rows_in(batches, "id", "key", "text", "places", "hashes"):
        out = [(h, i, k, p, t[max(0, p - LEFT):p][::-1], t[p:p + LENGTH])
               for i, k, t, own, hs in zip(ids, keys, texts, places, hashes) for p, h in zip(own, hs)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["h", "id", "key", "pos", "before", "after"])


def sort_suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 3 over rows sorted by ``h``, id, key and position: contexts of whole K-grams, about
    ``CHUNK`` at a time; what equal rows list again is left out."""
    held: list[list] = [[], [], [], [], [], []]
    last = None

    def out(end):
        part = [c[:end] for c in held]
        found_ = shared_windows(*(np.array(c, np.int64) for c in part[1:4]), *part[4:])
        for c in held:
            del c[:end]
        if len(found_[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in found_], ["id", "key", "pos", "stop"])

    for columns in rows_in(batches, "h", "id", "key", "pos", "before", "after"):
        places = list(zip(*columns[:4]))
        fresh = [a != b for a, b in zip(places, [last, *places])]
        last = places[-1]
        for c, more in zip(held, columns):
            c.extend(compress(more, fresh))
        if len(held[0]) >= CHUNK and held[0][0] != held[0][-1]:
            end = len(held[0])
            while held[0][end - 1] == held[0][-1]:
                end -= 1
            yield from out(end)
    if held[0]:
        yield from out(len(held[0]))


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text binary) per row; rows of equal id and text share their key."""
    text = F.col(text_col).cast("string").cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Marked runs per document: (id, key, starts array<long>, stops array<long>), unmerged."""
    prepare(docs.sparkSession)
    plain = documents(docs, id_col, text_col)
    listed = plain.mapInArrow(scan, FOUND)
    seen = saved(listed.repartition("h").sortWithinPartitions("h").mapInArrow(match, FOUND), "repeats")
    open_ = (seen.filter("stop < 0").groupBy("id", "key")
             .agg(F.collect_list(F.struct("pos", "h")).alias("at"))
             .select(F.col("id").alias("oid"), F.col("key").alias("okey"), F.col("at.pos").alias("places"), F.col("at.h").alias("hashes")))
    fetched = (plain.join(open_, (plain["id"] == open_["oid"]) & (plain["key"] == open_["okey"]), "left").filter("oid is not null")
               .select("id", "key", "text", "places", "hashes")
               .mapInArrow(contexts, "h long, id long, key long, pos long, before binary, after binary"))
    sorted_ = (fetched.repartition("h").sortWithinPartitions("h", "id", "key", "pos")
               .mapInArrow(sort_suffixes, "id long, key long, pos long, stop long"))
    both = seen.filter("stop >= 0").select("id", "key", "pos", "stop").unionByName(sorted_)
    return (both.groupBy("id", "key").agg(F.collect_list(F.struct("pos", "stop")).alias("m"))
            .select("id", "key", F.col("m.pos").alias("starts"), F.col("m.stop").alias("stops")))


def cut(text: bytes, starts, stops) -> tuple[int, int, bytes]:
    """(removed bytes, maximal removed runs, what is left)."""
    if not starts:
        return 0, 0, text
    s, e = merged(np.array(starts, np.int64), np.array(stops, np.int64))
    s, e = np.minimum(s, len(text)), np.minimum(e, len(text))
    s, e = s[s < e], e[s < e]
    edges = [0, *(x for pair in zip(s.tolist(), e.tolist()) for x in pair), len(text)]
    left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
    return len(text) - len(left), len(s), left


def with_marks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    plain = documents(docs, id_col, text_col)
    m = repeats(docs, id_col, text_col).withColumnsRenamed({"id": "mid", "key": "mkey"})
    return plain.join(m, (plain["id"] == m["mid"]) & (plain["key"] == m["mkey"]), "left").select("id", "text", "starts", "stops")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept binary) per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, starts, stops in rows_in(batches, "id", "text", "starts", "stops"):
            texts = [t or b"" for t in texts]
            removed, spans, kept = zip(*map(cut, texts, starts, stops))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in ([len(t) for t in texts], removed, spans)),
                 pa.array(kept, pa.binary())], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    out = with_marks(docs, id_col, text_col).mapInArrow(run, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeats cut out of its texts (a character that loses part of its bytes
    goes with them); null texts stay null; ``n_chars``, if there, follows."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, starts, stops = (batch.column(names.index(c)).to_pylist() for c in (text_col, "_starts", "_stops"))
            texts = [t if t is None or not s else cut(t.encode(), s, e)[2].decode("utf-8", "ignore")
                     for t, s, e in zip(texts, starts, stops)]
            columns = [pa.array(texts, pa.string()) if f.name == text_col else batch.column(names.index(f.name)) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    m = repeats(docs, id_col, text_col).select(F.col("id").alias("_mid"), F.col("key").alias("_mkey"), F.col("starts").alias("_starts"), F.col("stops").alias("_stops"))
    key = F.xxhash64(docs[text_col].cast("string").cast("binary"))
    out = docs.join(m, (docs[id_col] == m["_mid"]) & (key == m["_mkey"]), "left").drop("_mid", "_mkey").mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length(text_col), F.col("n_chars")).cast(schema["n_chars"].dataType))
    return out
