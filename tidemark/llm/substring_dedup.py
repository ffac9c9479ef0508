"""Substring dedup: near-equal paragraphs by MinHash banding.

Paragraphs are the lines of a text that hold a word; their items are 5-word shingles of the lower-case
words, a shorter line's its whole word sequence (so it is near to equal lines only).  Equal paragraphs collapse to a class first (a 64-bit hash of the words),
so a paragraph in a third of all documents is one item later on.  Classes get ``BANDS`` bands of
``ROWS`` minimum hashes, a tuning for high recall: a pair at Jaccard 0.8 shares a band with
probability 0.998.  Buckets with two or more classes are cut into tiles, members' shingle sets
are fetched, and a tile's task verifies exact Jaccard, skipping pairs that are connected already,
and returns a spanning forest.  Components of classes are clusters; of each cluster the first
paragraph (smallest id, then place) stays and the others are removed.

Documents that repeat a passage form a class (``passage_dedup``).  A passage is a removed paragraph of
``PASSAGE`` words or more, or one that makes up half its document, or, wherever it lies in its
paragraphs, ``SPAN`` words in a row: of the ``PASSAGE``-word windows in every ``SPAN`` words the one with the least
hash is listed, so documents that share ``SPAN`` words list a window in common.  A shorter line that
two documents share by chance is removed, but makes them no class.

Defined results: a null text has no paragraphs; a null id's row removes nothing and is no source;
a document is an id and a text: equal rows are one document, different texts of one id are searched and
cut each for itself (of equal ids, the first in the order of a hash of the text); an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Forest, colliding, components, groups_in, in_batches, pairs_of_tile, prepare, rows_in, saved, text_key

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 12, 4
TILE = 256
PASSAGE, SPAN = 20, 50  # words; windows of PASSAGE = 16 + 4
_RNG = np.random.default_rng(77)
_A = _RNG.integers(1, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_B = _RNG.integers(1, 1 << 62, BANDS * ROWS, dtype=np.int64).astype(np.uint64)


def paragraphs(text: str | None) -> list[tuple[int, list[bytes]]]:
    """(line number, lower-case words) of the lines that hold a word."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        words = line.lower().encode("utf-8", "surrogatepass").split()
        if words:
            out.append((i, words))
    return out


def class_of(words: list[bytes]) -> int:
    h = xxhash.xxh64_intdigest(b" ".join(words), 1)
    return h - (h >> 63 << 64)


def shingle_hashes(words: list[bytes]) -> list[int]:
    """Hashes of the word shingles, in order."""
    joined, digest, at, starts, ends = b" ".join(words), xxhash.xxh64_intdigest, 0, [], []
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    return [digest(joined[a:b]) for a, b in zip(starts, ends[WORDS - 1:] or ends[-1:])]


def shingles(words: list[bytes]) -> np.ndarray:
    """Distinct hashes of the word shingles, sorted."""
    return np.unique(np.array(shingle_hashes(words), np.uint64))


def bands(sets: list[list[int]]) -> np.ndarray:
    """Signed band keys (sets x bands): all sets' minimum hashes at once, one hash function after
    the other."""
    items = np.array([h for s in sets for h in s], np.uint64)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    keys = np.empty((len(sets), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(sets), band + 1, np.uint64)
            for j in range(band * ROWS, (band + 1) * ROWS):
                h = items * _A[j] + _B[j]
                h ^= h >> np.uint64(31)
                h *= np.uint64(0x9FB21C651E98DF25)
                key = (key ^ np.minimum.reduceat(h, starts)) * np.uint64(0xD6E8FEB86659FD93)
                key ^= key >> np.uint64(32)
            keys[:, band] = key
    return keys.view(np.int64)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if min(len(a), len(b)) < LEAST * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def list_paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, keys, texts in rows_in(batches, "id", "key", "text"):
        out = []
        for i, k, t in zip(ids, keys, texts):
            own = paragraphs(t) if i is not None else []
            total = sum(len(words) for _, words in own)
            out += [(i, k, n, class_of(words), len(words), total) for n, words in own]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["id", "key", "place", "class", "words", "of_words"])


def list_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Band keys of paragraphs of ``WORDS`` words or more; of shorter ones, equal words are the class already."""
    for ids, texts in rows_in(batches, "id", "text"):
        seen, sets, classes, held = set(), [], [], 0

        def out():
            keys = bands(sets)
            return pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(np.array(classes, np.int64), BANDS))], ["key", "class"])

        for i, text in zip(ids, texts):
            for _, words in paragraphs(text) if i is not None else ():
                c = class_of(words) if len(words) >= WORDS else None
                if c is not None and c not in seen:
                    seen.add(c)
                    sets.append(shingle_hashes(words))
                    classes.append(c)
                    held += len(words)
            if held > 1 << 17:
                yield out()
                sets, classes, held = [], [], 0
        if sets:
            yield out()


def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, class) over rows sorted by (key, class), for buckets of two or more classes.  The
    bucket's name is a hash of its members, so bands that collect the same classes agree."""
    def rows():
        for _, group in groups_in(batches, 1):
            members = list(dict.fromkeys(c for (c,) in group))
            if len(members) > 1:
                name = xxhash.xxh64_intdigest(np.array(members, np.int64).tobytes()) - (1 << 63)
                yield from ((name, c) for c in members)

    return in_batches(rows(), ["bucket", "class"])


def list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingle sets of the wanted paragraphs of each document."""
    for texts, wanted in rows_in(batches, "text", "places"):
        out = []
        for text, places in zip(texts, wanted):
            places = set(places)
            out += [(class_of(words), shingles(words).tobytes()) for n, words in paragraphs(text) if n in places]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["class", "items"])


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edges():
        for (_, ta, tb), rows in groups_in(batches, 3):
            parts, classes, items = zip(*rows)
            sets = [np.frombuffer(x, np.uint64) for x in items]
            left, right = pairs_of_tile(ta, tb, list(parts))
            forest = Forest(len(rows))
            for i in left:
                for j in right:
                    if (i < j or ta != tb) and forest.root(i) != forest.root(j) and jaccard(sets[i], sets[j]) >= LEAST:
                        forest.join(i, j)
                        yield classes[i], classes[j]

    return in_batches(edges(), ["a", "b"])


def windows(words: list[bytes]) -> np.ndarray:
    """Distinct hashes of the windows that are least in some ``SPAN`` words, sorted."""
    if len(words) < SPAN:
        return np.empty(0, np.uint64)
    x, power, n = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), np.uint64(0xD6E8FEB86659FD93), 1
    m, width = len(words) - PASSAGE + 1, SPAN - PASSAGE + 1
    with np.errstate(over="ignore"):
        while n < 16:
            x = x[:-n] * power + x[n:]
            power = power * power
            n *= 2
            if n == 4:
                four, by_four = x, power
        h = x[:m] * by_four + four[16:16 + m]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        least = h ^ (h >> np.uint64(32))
    n = 1
    while n * 2 <= width:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    k = m - width + 1
    return np.unique(np.minimum(least[:k], least[width - n:width - n + k]))


def list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for nodes, texts in rows_in(batches, "node", "text"):
        own = [windows(t.lower().encode("utf-8", "surrogatepass").split()) if node is not None and t else () for node, t in zip(nodes, texts)]
        if any(map(len, own)):
            h = np.concatenate([x for x in own if len(x)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array([n for n, x in zip(nodes, own) for _ in x], pa.int64())], ["h", "node"])


def to_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from the first document of each window to the others, over rows sorted by ``h``."""
    last = first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        new = np.append(h[0] != last, h[1:] != h[:-1])
        at = np.maximum.accumulate(np.where(new, np.arange(len(h)), -1))
        firsts = np.where(at < 0, first, node[at]) if at[0] < 0 else node[at]
        last, first = h[-1], firsts[-1]
        met = np.unique(np.stack([firsts, node])[:, firsts != node], axis=1)
        if met.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in met], ["a", "b"])


def paragraph_clusters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per paragraph: (id, key, place, words, of_words, cluster, first_id, first_key, first_place,
    removed), ``key`` the ``text_key`` of its text, ``of_words`` the words of all its text."""
    prepare(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    listed = saved(plain.mapInArrow(list_paragraphs, "id long, key long, place long, class long, words long, of_words long"), "paragraphs")
    keyed = plain.mapInArrow(list_bands, "key long, class long").repartition("key").sortWithinPartitions("key", "class")
    members = saved(keyed.mapInArrow(buckets, "bucket long, class long").distinct(), "buckets")
    # one paragraph of each class in a bucket, by document
    wanted = (listed.join(members.select("class").distinct(), "class", "left_semi").groupBy("class")
              .agg(F.min(F.struct("id", "key", "place")).alias("at"))
              .groupBy(F.col("at.id").alias("_id"), F.col("at.key").alias("_key")).agg(F.collect_list("at.place").alias("places")))
    sets = (plain.join(wanted, (plain["id"] == wanted["_id"]) & (plain["key"] == wanted["_key"])).select("text", "places")
            .mapInArrow(list_sets, "class long, items binary").dropDuplicates(["class"]))
    tiles = colliding(members, ["bucket"], "class", TILE).join(sets, "class")
    met = (tiles.select("bucket", "ta", "tb", "part", "class", "items")
           .repartition("bucket", "ta", "tb").sortWithinPartitions("bucket", "ta", "tb"))
    roots = components(met.mapInArrow(verify, "a long, b long"))
    clustered = (listed.join(roots, listed["class"] == roots["node"], "left")
                 .select("id", "key", "place", "words", "of_words", F.coalesce("component", "class").alias("cluster")))
    firsts = clustered.groupBy("cluster").agg(F.min(F.struct("id", "key", "place")).alias("first"), F.count(F.lit(1)).alias("n"))
    repeated = firsts.filter("n > 1").select(F.col("cluster").alias("_c"), F.col("first.id").alias("first_id"), F.col("first.place").alias("first_place"),
                                             F.col("first.key").alias("first_key"))
    out = clustered.join(repeated, clustered["cluster"] == repeated["_c"], "left")
    first = (F.col("id") == F.col("first_id")) & (F.col("key") == F.col("first_key")) & (F.col("place") == F.col("first_place"))
    return out.withColumn("removed", F.col("first_id").isNotNull() & ~first).drop("_c")


def paragraph_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (id, class_id, n_paragraphs, n_removed, removed).

    ``removed`` lists (place, first_id, first_place); ``class_id`` is the smallest document that
    a removed paragraph was first found in, or the document itself where nothing is removed."""
    return _per_document(docs, paragraph_clusters(docs, id_col, text_col), id_col, text_col).drop("_text_key")


def _per_document(docs: DataFrame, clusters: DataFrame, id_col: str, text_col: str) -> DataFrame:
    cut = F.when(F.col("removed"), F.struct("place", "first_id", "first_place"))
    # sets, as equal rows list their paragraphs twice
    per = (clusters.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
           .agg(F.size(F.collect_set("place")).alias("n"), F.array_sort(F.collect_set(cut)).alias("removed")))
    ids = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"))
    out = ids.join(per, (ids["id"] == per["_id"]) & (ids["key"] == per["_key"]), "left")
    none = F.array().cast("array<struct<place:long,first_id:long,first_place:long>>")
    removed = F.coalesce("removed", none)
    return out.select(F.col("id").alias(id_col),
                      F.coalesce(F.least(F.array_min(F.transform(removed, lambda x: x["first_id"])), F.col("id")), F.col("id")).alias("class_id"),
                      F.coalesce("n", F.lit(0)).cast("long").alias("n_paragraphs"), F.size(removed).cast("long").alias("n_removed"),
                      removed.alias("removed"), F.col("key").alias("_text_key"))


def passage_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``paragraph_dedup``, but ``class_id`` is the smallest document reachable over
    documents that repeat a passage of each other, itself included."""
    clusters = saved(paragraph_clusters(docs, id_col, text_col), "paragraph-clusters")

    def node(i, key):
        return F.when(F.col(i).isNotNull(), F.xxhash64(i, key))

    plain = docs.select(F.col(id_col).cast("long").alias("id"), text_key(F.col(text_col)).alias("key"), F.col(text_col).cast("string").alias("text"))
    nodes = plain.select("id", node("id", "key").alias("node"))
    listed = plain.select(node("id", "key").alias("node"), "text").mapInArrow(list_windows, "h long, node long")
    shared = listed.repartition("h").sortWithinPartitions("h").mapInArrow(to_first, "a long, b long")
    whole = clusters.filter(f"removed AND (words >= {PASSAGE} OR 2 * words >= of_words)")
    roots = components(shared.unionByName(whole.select(node("first_id", "first_key").alias("a"), node("id", "key").alias("b"))))
    members = roots.unionByName(roots.select(F.col("component").alias("node"), "component").distinct())
    least = members.join(nodes, "node").groupBy("component").agg(F.min("id").alias("_class"))
    classes = members.join(least, "component").select(F.col("node").alias("_member"), "_class")
    out = _per_document(docs, clusters, id_col, text_col)
    return (out.join(classes, node(id_col, "_text_key") == F.col("_member"), "left")
            .withColumn("class_id", F.coalesce("_class", id_col)).drop("_text_key", "_member", "_class"))
