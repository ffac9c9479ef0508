"""Periodic runs, the quality classifier and the prefix trie against brute force or held-out labels."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import assert_same
from llm_fixtures import docs  # noqa: F401
from tidemark.llm import periodic, prefix_trie, quality, queries
from tidemark.llm.common import table

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------------------------------- runs

def brute_runs(w, exponent=4, shortest=6):
    """Every lag, word by word."""
    n, out = len(w), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            own = w[i:j + q]
            if len(own) >= max(shortest, exponent * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                out.append((i, len(own), q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    """A row of the registered query."""
    w = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        g, o = h // 10, list(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [o[i] if i < a else o[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in
           ("".join(f"{s},{size},{q}\n" for s, size, q in runs), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *sha)


def periodic_words(rng, most=120):
    v = rng.choice([1, 2, 3, 5, 30])
    w = [f"w{rng.randrange(v)}" for _ in range(rng.randrange(most))]
    for _ in range(rng.randrange(4)):
        p, a = rng.randrange(1, 9), rng.randrange(len(w) + 1)
        unit, size = [f"w{rng.randrange(v)}" for _ in range(p)], rng.randrange(1, 50)
        w[a:a + size] = (unit * (size // p + 1))[:size]
    return w


@pytest.mark.parametrize("exponent,shortest", [(4, 6), (3, 1), (3, 6), (5, 9)])
@pytest.mark.parametrize("scan", [1 << 20, 3])
def test_runs_of(monkeypatch, exponent, shortest, scan):
    monkeypatch.setattr(periodic, "SCAN", scan)
    rng, found = random.Random(exponent + shortest), 0
    for _ in range(400):
        w = periodic_words(rng)
        got = periodic.runs_of(periodic.codes_of([x.encode() for x in w]), exponent, shortest)
        assert got == brute_runs(w, exponent, shortest)
        found += len(got)
    assert found > 100


def test_splitting_recurses():
    """Words frequent in the text but rare in each part go in a later round."""
    w = [b"a", b"b"] * 4 + [b"x"] + [b"c", b"a"] * 2 + [b"y"] + [b"c"] * 6
    assert periodic.surviving(periodic.codes_of(w), 4, 6) == [(0, 8), (14, 20)]


def test_long_texts_in_bounded_time():
    """A lag scan that compared every word at every lag would need 10^11 comparisons here."""
    for w, runs in (([b"a"] * 600_000, [(0, 600_000, 1)]),
                    ([b"a"] * 300_000 + [b"b"] * 6 + [b"a"] * 299_994, [(0, 300_000, 1), (300_000, 6, 1), (300_006, 299_994, 1)]),
                    (([b"a"] * 50 + [b"b"]) * 4000, [(0, 50, 1), (0, 204_000, 51)] + [(51 * k, 50, 1) for k in range(1, 4000)])):
        assert periodic.runs_of(periodic.codes_of(w)) == runs


def test_runs_rows(docs):
    rng = random.Random(8)
    rows = [(i, " ".join(periodic_words(rng)).replace(" w1 ", "\t\nw1\x0b")) for i in range(120)]
    rows += [(500, None), (501, ""), (502, " \n "), (None, "x " * 9), (None, None), (7, rows[7][1]), (7, "é é é é é é    "),
             (503, "a a " * 40), (504, "long " * 30_000 + "end")]
    out = periodic.periodic_runs(docs(rows), rewrite=periodic.repeated_tail)
    got = out.select("doc_id", "n_words", F.size("runs").alias("n"), F.sha2("collapsed", 256).alias("c")).collect()
    want = [brute_row(*r) for r in rows if r[0] != 504]
    assert sorted(map(repr, [(r.doc_id, r.n, r.c) for r in got if r.doc_id != 504])) == sorted(map(repr, [(w[0], w[1], w[-1]) for w in want]))
    assert periodic.periodic_runs(docs([])).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs(rows), exponent=2)


def test_op11_query(spark):
    """The registered query's rows on the whole sf0.001 table, but the few texts too long for the
    brute force, which compares them at every lag."""
    got = {r[0]: tuple(r) for r in queries.op11_periodic_runs(spark, TINY).collect()}
    texts = {r.doc_id: r.text for r in table(spark, TINY, "documents").select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    short = {i: t for i, t in texts.items() if len(t or "") < 6000}
    assert len(short) > 150 and sum(got[i][1] > 0 for i in short) > 10
    for i, t in short.items():
        assert got[i] == brute_row(i, t)


# ---------------------------------------------------------------------------------------- quality

def test_statistics():
    text = b"One two two.\nOne two two.\nTHREE 4!"
    a, b, c = quality.statistics([text, b"", None])
    assert (b == c).all() and len(a) == len(quality.NAMES) and np.isfinite(a).all() and np.isfinite(b).all()
    at = dict(zip(quality.NAMES, a))
    assert at["words"] == np.log1p(8) and at["new_lines"] == np.log(2.5 / 1.5) and at["digit"] == np.log(1.5 / (len(text) - 1 + .5))


def test_moments_and_factors(spark):
    """The discriminant equals one from all rows at once; distances come from the inverse."""
    rng = np.random.default_rng(3)
    x = [rng.multivariate_normal(np.arange(4) * y, np.eye(4) + y * 0.5, 300) for y in (0, 1)]
    rows = [(y, list(map(float, r))) for y in (0, 1) for r in x[y]]
    sums = quality.moments(spark.createDataFrame(rows, "label int, stats array<double>").repartition(5), 4)
    for y in (0, 1):
        own = np.column_stack([np.ones(300), x[y]])
        assert np.allclose(sums[y], own.T @ own)
    model = quality.discriminant(sums)
    for y in (0, 1):
        assert np.allclose(model[y].mean, x[y].mean(0))
        precision = model[y].whiten.T @ model[y].whiten
        diff = x[1] - model[y].mean
        assert np.allclose(model[y].distance(x[1]), np.einsum("ij,jk,ik->i", diff, precision, diff) + model[y].log_det)
    near = np.linalg.inv(model[1].whiten.T @ model[1].whiten)
    assert np.abs(near - np.cov(x[1].T)).max() < 0.35  # shrunk a little only
    assert 0 <= quality.shrinkage(np.eye(4), 100) <= 1 and quality.shrinkage(np.diag([9., 1, 1, 1]), 10_000) < 0.01


def test_quality_held_out(spark):
    out = queries.op12_quality(spark, SMALL)
    rows = {r.doc_id: r for r in out.collect()}
    truth = {r.doc_id: r.quality for r in table(spark, SMALL, "labels").collect()}
    held = [i for i in truth if rows[i].held_out]
    assert len(rows) == table(spark, SMALL, "documents").count() and len(held) > 50
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in rows)
    assert np.mean([rows[i].predicted == truth[i] for i in held]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    good, bad = ([rows[i].score for i in held if truth[i] == y] for y in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.99


def test_quality_never_sees_held_out_labels(spark, docs):
    """Held-out labels turned round change no score; ids do not either."""
    d = table(spark, TINY, "documents")
    labels = table(spark, TINY, "labels")
    turned = labels.withColumn("quality", F.when(quality.training_part(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    a = {r.doc_id: r.score for r in quality.quality(d, labels).collect()}
    b = {r.doc_id: r.score for r in quality.quality(d, turned).collect()}
    assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-9 for i in a)
    extra = d.select("doc_id", "text").unionByName(d.select(F.lit(None).cast("long").alias("doc_id"), "text"))
    c = [r.score for r in quality.quality(extra, labels).filter("doc_id IS NULL").collect()]
    assert np.allclose(sorted(c), sorted(a.values()))


def test_quality_edges(docs, spark):
    rows = [(i, f"word{i} and more") for i in range(40)] + [(None, None), (50, ""), (50, "x" * 200_000), (51, "\n\n")]
    marked = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(None, 1, "x"), (3, None, "y"), (4, 7, "z")],
                                   "doc_id long, quality int, text string")
    out = quality.quality(docs(rows), marked).collect()
    assert len(out) == 44 and all(0 <= r.score <= 1 for r in out)
    none = quality.quality(docs(rows), marked.filter("quality = 1")).collect()
    assert {r.score for r in none} == {1.0} and len(none) == 44
    assert {r.score for r in quality.quality(docs(rows), marked.limit(0)).collect()} == {0.0}
    assert quality.quality(docs([]), marked).count() == 0


# ------------------------------------------------------------------------------------------- trie

def brute_trie(rows):
    """The registered query's rows, as a dictionary by sequence."""
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for s, m in nodes.items():
        below = [x for x in nodes if x[:len(s)] == s]
        kids = [x for x in below if len(x) == len(s) + 1]
        saved = sum((len(nodes[x]) - 1) * len(WORD.findall(x[-1][1])) for x in below if x)
        leaves = sum(not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in below) for x in below)
        ends = ",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(s))))
        out.append((min(m), len(s), min(nodes[s[:-1]]) if s else None, len(m), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie_rows(spark, rows, bits):
    table_ = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, at int")
    numbered = prefix_trie.digests(table_)
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.with_family_heads(numbered), bits).drop("path").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=repr)


@pytest.mark.parametrize("bits,block", [(8, 64), (2, 1), (3, 3)])
def test_trie(spark, monkeypatch, bits, block):
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rng, rows = random.Random(bits), []
    for c in [*range(0, 90), 10**9, 10**9 + 3, 119]:
        for t in range(rng.choice([1, 2, 3, 4, 7, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["a b", "a b", "c", "", "d e f"])))
    rows += [(200, None, None, None), (200, 3, "user", None), (200, None, "user", "z"), (201, 5, None, "a b"), (None, 0, "user", "a"),
             (202, 1, "user", "same"), (202, 1, "user", "same"), (203, 0, "a:b", "c"), (204, 0, "a", "b:c")]
    assert trie_rows(spark, rows, bits) == brute_trie(rows)


def test_trie_long_conversation_and_one_hot_prefix(spark):
    """A conversation of many blocks, and 300 equal ones over many shards."""
    rows = [(5, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(1000 + c, t, "user", "hello there") for c in range(300) for t in range(4)]
    got = trie_rows(spark, rows, 4)
    assert got == brute_trie(rows)


def test_trie_empty(spark):
    assert trie_rows(spark, [], 8) == []
    assert trie_rows(spark, [(None, 1, "user", "x")], 8) == []


def test_op13_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SMALL}/conversations.parquet')")
    assert_same(queries.op13_prefix_trie(spark, SMALL), con, queries.SQL["op13_prefix_trie"])
