"""Repeated ids, null ids and short lines: classes and documents go by what they hold."""

import math

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from tidemark.llm import embed_dedup, simhash, substring_dedup


def near(v, cosine, rng):
    """A vector at exactly this cosine to ``v``."""
    w = rng.standard_normal(len(v))
    w -= w @ v / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + math.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)


def links(spark, rows):
    df = spark.createDataFrame([(i, [float(x) for x in v], l) for i, v, l in rows], "vec_id long, embedding array<double>, label string")
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.vector_links(df).collect()), key=repr)


def test_one_id_under_two_vectors_and_two_labels(spark):
    rng = np.random.default_rng(1)
    a, b = rng.standard_normal(64), rng.standard_normal(64)
    rows = [(1, a, "x"), (1, b, "y"), (2, near(a, 0.97, rng), "x"), (3, near(b, 0.97, rng), "y"), (1, rng.standard_normal(64), "x")]
    assert links(spark, rows) == [(1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]


def test_null_ids_link_and_bridge(spark):
    rng = np.random.default_rng(2)
    a = rng.standard_normal(64)
    rows = [(7, a, "x"), (None, near(a, 0.96, rng), "x"), (None, a * 2, "x")]
    got = links(spark, rows)
    assert [g[1:3] for g in got if g[0] == 7] == [(2, 7)] and all(g[1] == 2 and g[2] == 7 and not g[3] for g in got if g[0] is None)
    alone = rng.standard_normal(64)
    assert links(spark, [(None, alone, "x"), (None, alone * 3, "x")]) == [(None, 1, None, True)] * 2


def test_recall_at_the_threshold(spark):
    """Pairs made at cosine 0.93 to 0.95 over 64 dimensions."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(400):
        v = rng.standard_normal(64)
        rows += [(2 * i, v, "x"), (2 * i + 1, near(v, rng.uniform(0.9301, 0.95), rng), "x")]
    found = sum(n for _, n, _, _ in links(spark, rows)) / 2
    assert 0.9 * 400 <= found <= 400


def test_fingerprints_linked_through_a_null_id(spark):
    reps = spark.createDataFrame([(0b0, 0b0), (0b11, 0b11), (0b1111, 0b1111)], "fp long, rep long")
    assert simhash.close_pairs(reps).distinct().count() == 2
    fps = spark.createDataFrame([(1, 1, 0b0), (None, 2, 0b11), (2, 3, 0b1111), (None, 4, 15 << 40)], "id long, key long, fp long")
    monkey = simhash.fingerprints
    try:
        simhash.fingerprints = lambda *a: fps
        got = sorted((r.id is None, r.id or 0, r.fp, r.component) for r in simhash.grouped(None, "id", "text").collect())
    finally:
        simhash.fingerprints = monkey
    assert got == [(False, 1, 0, 1), (False, 2, 15, 1), (True, 0, 3, 1), (True, 0, 15 << 40, None)]


def cut(docs, rows):
    return sorted(((r.doc_id, r.class_id, r.n_paragraphs, [x.place for x in r.removed]) for r in substring_dedup.paragraph_dedup(docs(rows)).collect()), key=repr)


def test_short_lines_and_texts_of_one_id(docs):
    long = "one two three four five six seven eight"
    rows = [(1, f"All rights reserved.\n{long}"), (2, "All rights reserved."), (3, "all  RIGHTS reserved.\nall rights"), (4, "word"), (5, "word\nother"),
            (6, "first text of six\nwith two lines"), (6, f"second text of six\n\n{long}"), (8, "same row twice"), (8, "same row twice"), (None, "word")]
    got = cut(docs, rows)
    assert got == sorted([(1, 1, 2, []), (2, 1, 1, [0]), (3, 1, 2, [0]), (4, 4, 1, []), (5, 4, 2, [0]), (6, 6, 2, []), (6, 1, 2, [2]),
                          (8, 8, 1, []), (8, 8, 1, []), (None, None, 0, [])], key=repr)


def test_a_very_long_text_and_a_line_in_every_document(docs):
    body = "\n".join(f"line {i} has its own {i * 7} words here" for i in range(20_000))
    rows = [(0, body), *((i, f"hot line\nown line {i} of this document {i}") for i in range(1, 400))]
    got = {r[0]: r for r in cut(docs, rows)}
    assert got[0][2] == 20_000 and got[1][3] == [] and all(0 in got[i][3] for i in range(2, 400))


def test_passages_inside_paragraphs_make_classes_and_short_lines_do_not(docs):
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, n))

    passage, other, line = prose(55), prose(50), "All rights reserved by the same few people."
    rows = [(1, f"{prose(200)} {passage} {prose(150)}\n{line}"), (2, f"{line}\n{prose(90)}\n{prose(31)} {passage.upper()}\n{other}"),
            (3, f"{prose(80)}\n{line}"), (4, f"{prose(300)} {other} {prose(10)}"), (5, f"{prose(120)} {' '.join(passage.split()[:15])} {prose(60)}"),
            (6, "copied short text"), (7, "copied short  text"), (7, f"{line}\n{prose(70)}"), (8, None), (None, passage), (9, f"{line}\n{prose(19)}")]
    out = substring_dedup.passage_dedup(docs(rows)).collect()
    got = sorted(((r.doc_id, r.class_id, r.n_removed) for r in out), key=repr)
    assert got == sorted([(1, 1, 0), (2, 1, 1), (3, 3, 1), (4, 1, 0), (5, 5, 0), (6, 6, 0), (7, 6, 1), (7, 7, 1), (8, 8, 0), (None, None, 0),
                          (9, 9, 1)], key=repr)
    assert substring_dedup.passage_dedup(docs([])).count() == 0


def test_any_fifty_words_in_a_row_list_a_common_window():
    rng = np.random.default_rng(4)
    for _ in range(50):
        run = [b"r%d" % x for x in rng.integers(0, 1 << 30, 50)]
        a, b = ([b"o%d" % x for x in rng.integers(0, 1 << 30, n)] for n in rng.integers(0, 200, 2))
        assert len(np.intersect1d(substring_dedup.windows(a + run + b), substring_dedup.windows(b + run + a)))
    assert not len(substring_dedup.windows([b"word"] * 49)) and len(substring_dedup.windows([b"word"] * 50)) == 1


def test_edges_of_a_window_that_spans_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(n, pa.int64())], ["h", "node"])
               for h, n in (([1, 2, 2], [5, 6, 7]), ([], []), ([2, 2], [8, 6]), ([2, 3, 3, 3], [9, 1, 4, 4]))]
    edges = [e for b in substring_dedup.to_first(iter(batches)) for e in zip(*(c.to_pylist() for c in b.columns))]
    assert edges == [(6, 7), (6, 8), (1, 4), (6, 9)]
