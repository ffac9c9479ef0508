"""Exact, SimHash and suffix dedup against brute force."""

import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from tidemark.llm import exact_dedup, simhash, suffix_dedup

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1):
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 200)) for _ in range(25)]
    shared = words(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 5].upper()) for i in range(30)]
    for i in range(30):  # near copies and shared passages
        t = base[5 + i % 4].split()
        if t:
            t[rng.randrange(len(t))] = "changed"
        rows.append((200 + i, " ".join(t)))
        rows.append((300 + i, words(rng, 20) + " " + shared[: rng.randrange(80, len(shared))] + " " + words(rng, 9)))
    rows += [(400, None), (401, ""), (402, " \n\t "), (None, base[0]), (403, "é" * 300), (404, "a" * 501),
             (405, "Ünï " * 90), (406, "ab" * 200 + "é" + "ab" * 150), (407, base[6] * 3)]
    rng.shuffle(rows)
    return rows


def test_exact(docs):
    rows = corpus() + [(100, "again"), (100, "again")]
    got = {}
    for r in exact_dedup.exact_groups(docs(rows), "doc_id", exact_dedup.ascii_lower(F.col("text"))).collect():
        got.setdefault(r["doc_id"], []).append((r["keep_id"], r["group_size"], r["kept"], r["digest"]))
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(UP), []).append(i)
    want = {}
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want.setdefault(i, []).append((keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    left = exact_dedup.drop_copies(docs(rows))
    assert left.columns == docs(rows).columns
    assert {(r["text"] or "").translate(UP) for r in left.collect()} == set(groups)


def test_exact_empty(docs):
    empty = docs([])
    assert exact_dedup.exact_groups(empty, "doc_id", exact_dedup.ascii_lower(F.col("text"))).count() == 0
    assert exact_dedup.drop_copies(empty).count() == 0


def brute_fingerprint(text):
    own = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))).split()
    if not own:
        return 0
    shingles = [b" ".join(own[i:i + 3]) for i in range(max(1, len(own) - 2))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(ids, linked):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {i: root(i) for i in ids}


def test_simhash(docs):
    rows = [r for r in corpus(2) if r[0] is not None]
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component"]) for r in simhash.near_groups(docs(rows)).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    links = [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = brute_components(fps, links)
    assert got == {i: (fps[i], roots[i]) for i in fps}
    assert len(set(roots.values())) < len(roots)
    left = simhash.drop_near_copies(docs(rows))
    assert {r["doc_id"] for r in left.collect()} == set(roots.values())
    assert simhash.near_groups(docs([])).count() == 0


def test_simhash_pairs_with_hot_buckets(spark):
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        fps |= {f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(30)}
        fps |= {f ^ rng.getrandbits(20) for _ in range(10)}
    fps = sorted(fps)
    signed = [f - (f >> 63 << 64) for f in fps]
    df = spark.createDataFrame(list(zip(signed, range(len(fps)))), "fp long, rep long")
    want = {(min(a, b), max(a, b)) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 2}
    for hot in (2, 2000):
        got = {tuple(sorted((r["a"], r["b"]))) for r in simhash.close_pairs(df, hot).collect()}
        assert got == want


def brute_repeats(rows, n=100):
    seen, out = {}, {}
    for i, t in sorted((i, (t or "").encode()) for i, t in rows):
        gone = bytearray(len(t))
        for a in range(len(t) - n + 1):
            if t[a:a + n] in seen:
                gone[a:a + n] = b"\1" * n
            else:
                seen[t[a:a + n]] = (i, a)
        spans = sum(1 for a in range(len(t)) if gone[a] and (a == 0 or not gone[a - 1]))
        out[i] = (len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g))
    return out


def test_suffix(docs):
    rows = [r for r in corpus(4) if r[0] is not None]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in suffix_dedup.suffix_dedup(docs(rows)).collect()}
    want = brute_repeats(rows)
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 40 and any(w[2] > 1 for w in want.values())


def test_suffix_long_document_and_edges(docs, monkeypatch):
    rng = random.Random(5)
    long = words(rng, 4000)
    rows = [(2, long + "\n" + long[500:9000] + long[-400:]), (1, long[3000:3099]), (5, long[3000:3100]), (7, None), (None, long)]
    monkeypatch.setattr(suffix_dedup, "PIECE", 1000)
    p, h = suffix_dedup.anchors(long.encode())
    monkeypatch.undo()
    q, g = suffix_dedup.anchors(long.encode())
    assert (p == q).all() and (h == g).all()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
           for r in suffix_dedup.suffix_dedup(docs(rows)).collect()}
    whole = got.pop(None)
    assert whole == (len(long), 0, 0, long.encode())
    assert got == brute_repeats([r for r in rows if r[0] is not None])
    assert suffix_dedup.suffix_dedup(docs([])).count() == 0


def test_deep_shallow_sorts():
    import numpy as np

    rng = random.Random(6)
    base = bytes(rng.randrange(3) for _ in range(300))
    strings = [base[a:a + rng.randrange(0, 101)] for a in [rng.randrange(290) for _ in range(400)]] + [b"", b"\0", b"\0\0"] * 2
    rows = np.zeros((len(strings), 100), np.uint8)
    for i, s in enumerate(strings):
        rows[i, :len(s)] = np.frombuffer(s, np.uint8)
    order, common = suffix_dedup.deep_shallow(rows, np.array([len(s) for s in strings]))
    padded = [s.ljust(100, b"\0") for s in strings]
    assert [padded[i] for i in order] == sorted(padded)
    for i in range(1, len(order)):
        a, b = strings[order[i - 1]], strings[order[i]]
        lcp = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert common[i] == lcp
    some = [s for s in strings]
    assert [some[i] for i in suffix_dedup.blind_order(some)] == sorted(some)


def test_remove_repeats_keeps_columns(docs):
    rng = random.Random(7)
    passage = words(rng, 50)
    rows = [(1, passage + " é one"), (2, "two é " + passage), (3, None), (4, "")]
    out = suffix_dedup.remove_repeats(docs(rows))
    assert out.schema == docs(rows).schema
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[1] == rows[0][1] and got[3] is None and got[4] == ""
    assert got[2].startswith("two é") and len(got[2]) < 20


def test_suffix_repeated_ids(docs):
    rng = random.Random(8)
    once, other, passage = words(rng, 60), words(rng, 70), words(rng, 50)
    rows = [(1, once), (1, once), (2, other + passage), (2, words(rng, 40)), (2, passage + words(rng, 30)), (3, once[:150] + words(rng, 9)),
            (3, once[:150] + words(rng, 9)), (4, passage[20:] + words(rng, 3)), (4, passage[20:] + "x"), (5, passage * 2), (5, passage * 2)]
    rows += [(6, words(rng, 30) + passage[k:] + words(rng, 30)) for k in range(5)] * 3
    rng.shuffle(rows)

    def key(text):
        k = xxhash.xxh64_intdigest(text.encode(), 42)
        return k - (k >> 63 << 64)
    ordered = sorted(set(rows), key=lambda r: (r[0], key(r[1])))  # equal rows are one document
    cut = brute_repeats([(n, t) for n, (_, t) in enumerate(ordered)])
    want = {r: cut[n] for n, r in enumerate(ordered)}
    expected = sorted((i, *want[i, t]) for i, t in rows)
    assert want[1, once][1] == 0 and sum(w[1] > 0 for w in want.values()) > 6
    for parts in (1, 7):
        df = docs(rows).repartition(parts)
        got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                     for r in suffix_dedup.suffix_dedup(df).collect())
        assert got == expected
        left = sorted((r["doc_id"], r["text"]) for r in suffix_dedup.remove_repeats(df).collect())
        assert left == sorted((i, w[-1].decode()) for i, *w in expected)


def test_near_copies_go_by_row(docs):
    rng = random.Random(9)
    copy, far, clean, own, lone = (words(rng, 60) for _ in range(5))
    rows = [(1, copy), (2, far), (3, copy), (3, clean), (None, copy), (None, own), (None, lone), (None, lone), (7, copy), (7, far), (7, None)]
    assert len({brute_fingerprint(t) for _, t in rows}) == 6
    left = simhash.drop_near_copies(docs(rows))
    assert left.columns == docs(rows).columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert got == sorted([(1, copy), (2, far), (3, clean), (None, own), (None, lone), (None, lone), (7, None)], key=str)
    of = {(r["doc_id"], r["fp"] % 2**64): r["component"] for r in simhash.near_groups(docs(rows)).collect()}
    assert of[7, brute_fingerprint(copy)] == 1 and of[7, brute_fingerprint(far)] == 2 and of[7, 0] == 7


def test_suffix_sorting_holds_a_few_times_its_contexts():
    import tracemalloc

    n, rng = 20_000, np.random.default_rng(8)
    body = rng.integers(97, 123, 400_000).astype(np.uint8).tobytes()
    at = rng.integers(0, len(body) - 200, n).tolist()
    place = np.arange(n)
    left, right = [body[a:a + 64] for a in at], [body[a + 64:a + 164] for a in at]
    tracemalloc.start()
    try:
        suffix_dedup.shared_windows(place, place, place + 64, left, right)
        assert tracemalloc.get_traced_memory()[1] < 8 * n * 164  # 24 times before
    finally:
        tracemalloc.stop()
