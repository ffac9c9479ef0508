"""Packing and BPE against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from llm_fixtures import docs  # noqa: F401
from tidemark.llm import bpe, packing

ODD = [None, "", " ", "a", "Hello  World's\n\n  x", "tabs\t \there \n \n end ", "end  ", " lead", "x<|endoftext|> y <|startoftext|>z",
       "ΟΔΥΣΣΑΣ Σ İstanbul ǅ", "e" + chr(0x301) + " " + chr(0x301) + "x", "日本語 テキスト です", "a\x1cb\x1d c\x85d" + chr(0xA0) + "e" + chr(0x2003) + "f" + chr(0x3000) + "g",
       "zero" + chr(0x200B) + "width " + chr(0x180E) + "x", "I'm you'll 12345 !!! ...", "🙂🙃 ok", "\x00nul\x00", "x" * 5000, "word " * 3000, "no end " * 400]


def rows(seed=1):
    rng = random.Random(seed)
    out = [(i, t) for i, t in enumerate(ODD)]
    for i in range(60):
        out.append((100 + i, " ".join(rng.choice(["the", "Thing", "of.", "été,", "x1", "schön.\n", "(a)"]) for _ in range(rng.randrange(900)))))
    return out + [(None, "nothing known. " * 9), (7, "again"), (7, "again")]


def test_encoder_pieces():
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    enc = packing.Encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(2)
    texts = [t or "" for t in ODD] + ["".join(rng.choice("ab' \n\t .é日<|1") for _ in range(40)) for _ in range(3000)]
    for t in texts:
        assert enc.encode(t).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_words_cut_like_the_tokenizer():
    tok = bpe.load(P.path("word_bpe_49k.json"))
    rng = random.Random(3)
    texts = [t or "" for t in ODD] + ["".join(rng.choice(["a", "B", "'s", " ", "\n", "\x1c", "\x85", chr(0x3000), "é", "Σ", chr(0x301), "1", "."]) for _ in range(30)) for _ in range(2000)]
    for t in texts:
        parts = [i for w in bpe.words_of(t) for i in tok.encode(w, add_special_tokens=False).ids]
        assert parts == tok.encode(t, add_special_tokens=False).ids, repr(t)


def check_pieces(got, data, tok, window=1024):
    want = {}
    for i, t in data:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.setdefault(i, []).append(ids)
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(by_doc) == set(want)
    for i, pieces in by_doc.items():
        if len(want[i]) > 1:
            assert sum(p[1] for p in pieces) == sum(map(len, want[i]))
            continue
        at, ids = 0, want[i][0]
        for start, length, crc, n in sorted(pieces):
            assert start == at and n == len(ids) and crc == zlib.crc32(ids[start:start + length].tobytes())
            at += length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, total


def test_pack(docs, monkeypatch):
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    data = rows()
    out = packing.pack(docs(data), P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"))
    padding, total = check_pieces(out.collect(), data, tok)
    assert padding < 0.03 * total
    assert packing.pack(docs([]), P.path("byte_bpe_50k.json")).count() == 0


def test_streamed_plan_equals_whole_plan():
    rng = random.Random(4)
    enders = np.zeros(100, bool)
    enders[:4] = True
    data = [(i, np.array([rng.randrange(100) for _ in range(rng.randrange(1, 700))], "<u4")) for i in range(400)]

    def packed(stretch):
        packer = packing.Packer(enders, 256, 0)
        packer.planned_at = stretch
        out = []
        packing.STRETCH, old = stretch, packing.STRETCH
        try:
            for i, ids in data:
                for columns in packer.add(i, ids):
                    out += list(zip(*[np.asarray(c).tolist() for c in columns]))
            for columns in packer.finish():
                out += list(zip(*[np.asarray(c).tolist() for c in columns]))
        finally:
            packing.STRETCH = old
        return out
    whole, parts = packed(1 << 30), packed(3000)
    sizes = {}
    for i, start, length, crc, n, seq, offset in parts:
        sizes[seq] = sizes.get(seq, 0) + length
    assert max(sizes.values()) <= 256
    assert sum(x[2] for x in parts) == sum(x[2] for x in whole) == sum(len(i) for _, i in data)
    assert abs(len({x[5] for x in parts}) - len({x[5] for x in whole})) <= 0.01 * len(sizes) + 1


def test_plan_is_optimal():
    """Against the plain quadratic recurrence over the same positions (soft cuts only)."""
    rng = random.Random(8)
    window = 64
    for _ in range(50):
        ends, p = [], 0
        while p < 600:
            p += rng.randrange(1, 14)
            ends.append(p)
        pens = [float(rng.choice([0, 1])) for _ in ends]
        old, packing.INSIDE_PENALTY = packing.INSIDE_PENALTY, 1e9
        try:
            cuts = packing.plan(ends, pens, window, True)
        finally:
            packing.INSIDE_PENALTY = old
        pen = dict(zip(ends, pens))

        def cost(a, b):
            n = b - a
            return (0 if n in (32, 64) else window - n) + pen[b] + packing.WINDOW_COST
        best = {0: 0.0}
        for b in ends:
            best[b] = min(best[a] + cost(a, b) for a in [0, *ends] if a < b and b - a <= window)
        assert cuts[-1] == ends[-1]
        assert abs(sum(cost(a, b) for a, b in zip([0, *cuts], cuts)) - best[ends[-1]]) < 1e-6


def test_bpe(docs):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    data = rows(5)
    for digest in (True, False):
        got = {}
        out = bpe.bpe(docs(data), P.path("word_bpe_49k.json"), digest=digest, block_bytes=20_000)
        for r in out.collect():
            got.setdefault(r[0], []).append(tuple(r)[1:])
        for i, t in data:
            ids = tok.encode(t or "", add_special_tokens=False).ids
            text = tok.decode(ids, skip_special_tokens=False)
            joined = " ".join(map(str, ids))
            want = (len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()) if digest else (len(ids), ids, text)
            assert want in got[i], (i, t)
        assert sum(map(len, got.values())) == len(data)
    assert bpe.bpe(docs([]), P.path("word_bpe_49k.json")).count() == 0
