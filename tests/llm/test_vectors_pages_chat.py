"""Paragraph dedup, WARC, chat, embeddings and toxicity against brute force or held-out labels."""

import hashlib
import io
import math
import random
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import duck
from llm_fixtures import docs  # noqa: F401
from test_dedup import brute_components, words
from tidemark.llm import chat, common, embed_dedup, queries, substring_dedup, toxicity, warc

SMALL = "/root/testdata/sf0.01"


# ----------------------------------------------------------------------------------- paragraphs

def paragraph_rows():
    rng = random.Random(1)
    rows, base = [], [words(rng, rng.randrange(30, 90), 5000) for _ in range(12)]
    for i in range(60):
        lines = [words(rng, rng.randrange(1, 60), 5000) for _ in range(3)]
        p = base[i % 12].split()
        for _ in range(rng.randrange(0, 3)):
            p[rng.randrange(len(p))] = "other"
        lines.insert(rng.randrange(4), " ".join(p))
        if i % 3 == 0:
            lines.append("Released under The same old license")
        rows.append((i, "\n".join(lines)))
    return rows + [(100, None), (101, ""), (102, "\n\n"), (None, rows[0][1]), (103, "one two three")]


def brute_paragraphs(rows):
    paras = [(i, n, w) for i, t in rows if i is not None for n, w in substring_dedup.paragraphs(t)]
    sets = [{tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for _, _, w in paras]  # a short line is one shingle
    links = [(a, b) for a in range(len(paras)) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    roots = brute_components(range(len(paras)), links)
    groups = {}
    for k, r in roots.items():
        groups.setdefault(r, []).append(paras[k][:2])
    removed = {}
    for g in groups.values():
        for p in sorted(g)[1:]:
            removed.setdefault(p[0], []).append((p[1], *min(g)))
    return removed, paras


@pytest.mark.parametrize("tile", [2, 256])
def test_paragraphs(docs, monkeypatch, tile):
    monkeypatch.setattr(substring_dedup, "TILE", tile)
    rows = paragraph_rows()
    removed, paras = brute_paragraphs(rows)
    out = substring_dedup.paragraph_dedup(docs(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = sorted(removed.get(r["doc_id"], []))
        assert [tuple(x) for x in r["removed"]] == want
        assert r["n_removed"] == len(want) and r["n_paragraphs"] == sum(p[0] == r["doc_id"] for p in paras)
        assert r["class_id"] == min([w[1] for w in want] + [r["doc_id"]], key=lambda x: math.inf if x is None else x)
    assert sum(map(len, removed.values())) > 40
    assert substring_dedup.paragraph_dedup(docs([])).count() == 0


# ----------------------------------------------------------------------------------------- WARC

def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, path string, id int")


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 300_000
    rows = [(5, "http://a/\r\nX: y", "same"), (3, None, "same"), (9, "u", None), (8, "u", ""), (1, "u", big), (None, "n", "same"),
            (4, "u", "WARC/1.1\r\n\r\nbody\r\n\r\n"), (6, "u", "HTTP/1.1 200\r\n\r\n")] + [(100 + i, "u", "many") for i in range(50)]
    archives = warc.archived(pages(spark, rows))
    got = {}
    for r in warc.read_warc(archives).collect():
        got[r["record_id"]] = r
    assert len(got) == len(rows)
    firsts = {}
    for i, _, h in rows:
        if i is not None:
            firsts[h or ""] = min(i, firsts.get(h or "", i))
    for i, url, h in rows:
        r, payload = got[f"<urn:page:{'' if i is None else i}>"], (h or "").encode()
        revisit = i != firsts[h or ""]
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (f"<urn:page:{firsts[h or '']}>" if revisit else None)
        assert r["payload_bytes"] == len(payload) and r["payload_digest"] == "sha1:" + warc.base32_sha1(payload)
        assert bytes(r["payload"]) == (b"" if revisit else payload)
    small = warc.write_warc(warc.record_types(pages(spark, rows), "page_id", "url", "html"), archives.first()["path"].rpartition("/")[0],
                            warc.train_dictionary([]), roll=200)
    assert small.count() > 10 and warc.read_warc(small).count() == len(rows)
    assert warc.read_warc(warc.archived(pages(spark, []))).count() == 0


def archive(records, dictionary=b"some plain content of a dictionary", compress_dictionary=False):
    out = io.BytesIO()
    writer = warc.Writer(out, dictionary)
    if compress_dictionary:
        packed = zstandard.compress(dictionary)
        out.seek(0)
        out.truncate()
        out.write(struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed)
    for headers, block in records:
        writer.record(headers, block)
    return out.getvalue()


BASE = [("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:1>"), ("WARC-Date", warc.DATE)]


def test_warc_frames_and_faults():
    blocks = [b"", b"x" * 100_000, b"\r\n\r\n", bytes(range(256)) * 50]
    for packed in (False, True):
        data = archive([(BASE, b) for b in blocks], compress_dictionary=packed)
        for chunk in (16, 1 << 20):
            assert [warc.parse(f)[1] for f in warc.frames(io.BytesIO(data), chunk)] == blocks
    data = archive([(BASE, b) for b in blocks])
    skipped = data + struct.pack("<II", 0x184D2A50, 3) + b"abc"
    assert len(list(warc.frames(io.BytesIO(skipped), 16))) == len(blocks)
    for bad in (b"", data[:20], data[:-3], data[8:], data + b"rubbish!", skipped[:-1]):
        with pytest.raises(warc.Malformed):
            list(warc.frames(io.BytesIO(bad)))
    for record in (b"WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n", b"HTTP/1.1\r\n\r\n", b"WARC/1.1\r\nno colon\r\n\r\n",
                   b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: a\r\nWARC-Date: b\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"):
        with pytest.raises(warc.Malformed):
            warc.parse(record)
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    good = {"warc-type": "response", "warc-payload-digest": "sha1:" + warc.base32_sha1(b"abc")}
    assert warc.checked(good, http) == (3, b"abc")
    for headers, block in ((good, http + b"d"), ({**good, "warc-payload-digest": "sha1:X"}, http), ({**good, "warc-type": "revisit"}, http),
                           ({**good, "warc-type": "revisit"}, http[:-3]), (good, b"abc")):
        with pytest.raises(warc.Malformed):
            warc.checked(headers, block)


# ----------------------------------------------------------------------------------------- chat

def test_chat_roles_held_out(spark):
    rows = common.table(spark, SMALL, "conversations")
    got = {(r["conv_id"], r["turn"]): r for r in chat.format_chat(rows).collect()}
    given = rows.filter(~chat.training_part(F.col("conv_id"))).collect()
    right = sum(got[r["conv_id"], r["turn"]]["role"] == r["role"] for r in given)
    assert len(got) == rows.count() and len(given) > 50 and right >= 0.97 * len(given)
    r = given[0]
    assert got[r["conv_id"], r["turn"]]["rendered"] == f"<|{r['role']}|>\n{r['text'].strip()}\n<|end|>\n"


def test_chat_viterbi_against_all_paths(monkeypatch):
    import itertools

    monkeypatch.setattr(chat, "COMMIT", 3)
    rng = random.Random(2)
    counts = {("move", a, b): rng.randrange(1, 50) for a in ("start", *chat.ROLES) for b in chat.ROLES}
    counts.update({("emit", f, v, r): rng.randrange(1, 50) for f in chat.FEATURES for v in "abc" for r in chat.ROLES})
    model = chat.Model({k: float(v) for k, v in counts.items()})
    for _ in range(30):
        seen = [tuple(rng.choice("abcd") for _ in chat.FEATURES) for _ in range(7)]
        path = chat.Viterbi(model)
        got = [r for o in seen for r in path.add(o)] + path.finish()

        def score(p):
            return sum(model.move[a, b] + model.score(o, b) for a, b, o in zip(("start", *p), p, seen))
        assert tuple(got) == max(itertools.product(chat.ROLES, repeat=7), key=score)


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, id string, place int"
    rows = [(c, t, r, x, "x", 1) for c in range(40) for t, (r, x) in enumerate([("user", "User: what is it?"), ("assistant", "### Assistant: it is. " * 20)])]
    rows += [(90, 0, None, "Human: hello there", "x", 1), (90, 1, None, "AI: hello. " * 15, "x", 1), (91, 0, "martian", None, "x", 1),
             (91, 0, None, "", "x", 1), (91, None, None, "again", "x", 1), (None, 1, None, "lost", "x", 1), (None, 1, None, "lost", "x", 1)]
    out = chat.format_chat(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == len(rows)
    by = {(r["conv_id"], r["turn"]): r for r in out}
    assert by[90, 0]["rendered"] == "<|user|>\nhello there\n<|end|>\n" and by[90, 1]["role"] == "assistant"
    nothing = chat.format_chat(spark.createDataFrame(rows, schema).withColumn("role", F.lit(None).cast("string")))
    assert nothing.count() == len(rows)
    assert chat.format_chat(spark.createDataFrame([], schema)).count() == 0


def test_chat_texts_of_several_speakers(spark, monkeypatch):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("user", "User: what is it?"), ("assistant", "### Assistant: it is. " * 20)])]
    talk = "Log of today\n\nUser: a\nmore of a\n\nAssistant: b\r\n[human] c\nUser: d\n\n<|im_start|>assistant\ne: f\nContext\n"
    plain = "One line\nthe user: said\nAnswer\n42"
    rows += [(90, 0, None, talk)] * 2 + [(91, 0, None, "Human: hi\nAI: hello\nHuman: bye"), (91, 1, None, "User: more"), (92, 0, None, plain)]
    want = [("user", "a\nmore of a", 2), ("assistant", "b", 5), ("user", "c\nd", 6), ("assistant", "e: f\nContext", 9)]
    for commit in (512, 1):
        monkeypatch.setattr(chat, "COMMIT", commit)
        out = chat.format_chat(spark.createDataFrame(rows, schema)).collect()

        def turns(conv, turn):
            return [(r["role"], r["rendered"].split("\n", 1)[1].rsplit("\n", 2)[0], r["line"]) for r in out if (r["conv_id"], r["turn"]) == (conv, turn)]
        got = turns(90, 0)
        again = [x[2] for x in got].index(0, 1)
        for part in (got[:again], got[again:]):  # equal rows do not mix; the unmarked beginning may have any role
            assert "\n".join(x for _, x, _ in part) == "Log of today\na\nmore of a\nb\nc\nd\ne: f\nContext"
            assert [x for x in part if x[2] > 2] == want[1:] and (part[1] == want[0] or part[0][1] == "Log of today\na\nmore of a")
        assert turns(91, 0) == [("user", "hi", 0), ("assistant", "hello", 1), ("user", "bye", 2)] and turns(91, 1)[0][1:] == ("more", 0)
        assert [x[1:] for x in turns(92, 0)] == [(plain, 0)]
    none = chat.format_chat(spark.createDataFrame(rows, schema).withColumn("role", F.lit(None).cast("string"))).collect()
    assert len(none) == len(rows) and {r["role"] for r in none} == {"user"}


# ----------------------------------------------------------------------------------- embeddings

def brute_vectors(rows, least=0.93):
    use = [(i, l, np.array(v, float)) for i, v, l in rows if v and l is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links = []
    for a, (i, l, v) in enumerate(use):
        for j, m, w in use[:a]:
            if l == m and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= least:
                links.append((i, j))
    return links


def test_vectors(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows, base = [], rng.standard_normal((12, 24))
    for i in range(300):
        v = base[i % 12] + (0 if i % 7 == 0 else rng.uniform(0, 0.35)) * rng.standard_normal(24)
        rows.append((i, v.astype(np.float32).tolist(), int(i % 3)))
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 24, 1), (403, [float("nan")] * 24, 1), (404, [None, *[1.0] * 23], 1), (405, rows[0][1], None),
             (406, [1.0, 2.0], 1), (407, [2.0, 4.0], 1), (408, [1e30] * 24, 2), (409, [1e-30] * 24, 2), (410, [float("inf")] * 24, 1)]
    df = spark.createDataFrame([(*r, "x", 2) for r in rows], "vec_id long, embedding array<float>, label int, rep string, n int")
    links = brute_vectors(rows)
    want = {i: 0 for i, _, _ in rows}
    for a, b in links:
        want[a] += 1
        want[b] += 1
    roots = brute_components(want, links)
    for tile in (4, 512):
        monkeypatch.setattr(embed_dedup, "TILE", tile)
        got = {r["vec_id"]: r for r in embed_dedup.vector_links(df).collect()}
        assert len(got) == len(rows)
        assert all(r["n_links"] <= want[i] for i, r in got.items())
        assert sum(r["n_links"] for r in got.values()) >= 0.93 * sum(want.values()) > 100
        assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (400, 401, 402, 403, 404, 405, 410))
        assert got[406]["n_links"] == got[407]["n_links"] == got[408]["n_links"] == 1
        assert sum(got[i]["component_id"] == roots[i] for i in got) >= 0.97 * len(got)
    assert embed_dedup.vector_links(df.limit(0)).count() == 0


def test_vectors_recall_on_the_table(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in common.table(spark, SMALL, "embeddings").collect()]
    links = brute_vectors(rows)
    got = {r["vec_id"]: r["n_links"] for r in queries.op8_embedding_dedup(spark, SMALL).collect()}
    assert sum(got.values()) >= 0.9 * 2 * len(links) and sum(got.values()) <= 2 * len(links)


# ------------------------------------------------------------------------------------- toxicity

def test_maximal_segments_against_definition():
    rng = random.Random(4)
    for _ in range(300):
        x = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(rng.randrange(0, 14))]

        def split(a, b):  # the recursive definition: the best segment, then both sides
            best = max(((sum(x[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
            if best[0] <= 0:
                return []
            i, n = -best[2], -best[1]
            return split(a, i) + [(i, i + n, best[0])] + split(i + n, b)
        got = toxicity.maximal_segments(x)
        assert sorted(s for _, _, s in got) == sorted(s for _, _, s in split(0, len(x)))
        c, at = toxicity.compressed([float(v) for v in x])
        assert sorted(s for _, _, s in toxicity.maximal_segments(c)) == sorted(s for _, _, s in got)


def test_toxicity_held_out(spark):
    rows = {r["doc_id"]: r for r in queries.op9_toxicity(spark, SMALL).collect()}
    labels = common.table(spark, SMALL, "labels").collect()
    held = [(rows[r["doc_id"]], r["toxic"]) for r in labels if r["doc_id"] in rows and rows[r["doc_id"]]["held_out"]]
    assert len(held) > 50 and sum(r["predicted"] == t for r, t in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_toxicity_edges(docs, spark):
    rng = random.Random(5)
    rows = [(i, words(rng, 60) + (" vile rotten vile scum" if i % 4 == 0 else "")) for i in range(400)]
    rows += [(1000, None), (1001, ""), (None, "vile scum vile scum"), (1002, "vile rotten scum " * 50), (1002, words(rng, 9))]
    labels = spark.createDataFrame([(i, int(i % 4 == 0), "x") for i in range(400)] + [(7, None, "x"), (None, 1, "x"), (8, 5, "x")],
                                   "doc_id long, toxic int, text string")
    out = toxicity.toxicity(docs(rows), labels).collect()
    assert len(out) == len(rows)
    score = {r["doc_id"]: r["score"] for r in out if r["doc_id"] != 1002}
    assert all((score[i] >= 0.5) == (i % 4 == 0) for i in range(400))
    assert score[1000] == score[1001] < 0.5 and max(r["score"] for r in out if r["doc_id"] == 1002) > 0.9 and score[None] > 0.5
    left = toxicity.drop_toxic(docs(rows), labels)
    assert left.columns == docs(rows).columns
    assert {r["doc_id"] for r in left.collect()} >= {i for i in range(400) if i % 4}
    none = toxicity.toxicity(docs(rows), labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r["score"] == 0 for r in none)
    assert toxicity.toxicity(docs([]), labels).count() == 0


def test_drop_toxic_goes_by_row(docs, spark):
    rng = random.Random(6)
    rows = [(i, words(rng, 60) + (" vile rotten vile scum" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    bad, clean = "vile rotten scum " * 50, [(None, words(rng, 40)), (None, None), (1002, words(rng, 9)), (1002, None)]
    left = toxicity.drop_toxic(docs(rows + clean + [(None, bad), (1002, bad), (1002, bad)]), labels)
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert sorted(got, key=str) == sorted([r for r in rows if r[0] % 4] + clean, key=str)


# ---------------------------------------------------------------------------------- query digests

def test_op2_query_against_brute_force(spark):
    from test_dedup import brute_repeats

    tiny = "/root/testdata/sf0.001"
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op2_suffix_dedup(spark, tiny).collect()}
    rows = [(r["doc_id"], r["text"]) for r in common.table(spark, tiny, "documents").collect()]
    assert got == {i: (*w[:3], hashlib.sha256(w[3]).hexdigest()) for i, w in brute_repeats(rows).items()}


def test_op5_query_against_brute_force(spark):
    from test_dedup import brute_fingerprint

    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op5_simhash(spark, "/root/testdata/sf0.001").collect()}
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in common.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    roots = brute_components(fps, [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert got == {i: (f"{fps[i]:016x}", roots[i]) for i in fps}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    from conftest import assert_same

    con = duck(SMALL)
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    assert_same(queries.QUERIES[name](spark, SMALL), con, queries.SQL[name])
