"""BPE encoding and decoding over a table of distinct words.

A word is a run without white space: the tokenizer's pattern never joins across white space, so
the ids of a text are the ids of its words in order.

1. Every scan task cuts its documents into blocks of ``BLOCK`` bytes and lists each block's
   distinct words, dealt into buckets by a hash of the word.
2. A bucket's task meets every word of the corpus that hashes to it, encodes each distinct word
   once, and answers each block with the ids of its words.
3. The answers return to their block, whose documents wait there as sequences of word numbers:
   ids are joined back by position, and pieces by id (the vocabulary, whose size is fixed).

Word lists, answers and word numbers travel as compressed columns, so a word that every document
holds costs one entry per block, and the texts themselves are not shuffled.  Steps 1 and 3 both
read the documents, which must therefore be a table (or any plan that gives the same rows in
the same partitions twice); a block whose answers do not fit its word numbers stops the job.

Defined results: a null text counts as empty: no ids, and the empty text decoded; a null id stays
null; repeated rows each get their result; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in

BLOCK = 16 << 20
_NOT_SPACE_EVERYWHERE = re.compile("[\x1c-\x1f]")  # Python splits there, the tokenizer's pattern does not
# The Unicode white space of the tokenizer's pattern (fixed values).
_SPACE = re.compile("[" + "".join(map(chr, [
    *range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]+")


def words_of(text: str) -> list[str]:
    if _NOT_SPACE_EVERYWHERE.search(text):
        return [w for w in _SPACE.split(text) if w]
    return text.split()


def pack_ints(*columns) -> bytes:
    """Integer columns (below 2**32) as one compressed value; the bytes of equal weight go
    together, which makes small numbers nearly free."""
    out = [np.array([len(columns), *map(len, columns)], "<u4").tobytes()]
    for c in columns:
        out.append(np.ascontiguousarray(np.asarray(c, "<u4")).view(np.uint8).reshape(-1, 4).T.tobytes())
    return zstandard.compress(b"".join(out), 3)


def unpack_ints(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes = np.frombuffer(raw, "<u4", n, 4).tolist()
    out, at = [], 4 + 4 * n
    for size in sizes:
        planes = np.frombuffer(raw, np.uint8, 4 * size, at).reshape(4, size)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 4 * size
    return out


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int):
    """(block number, ids, texts), whole documents, about ``block_bytes`` of text each."""
    base, seq, ids, texts, size = 0, 0, [], [], 0
    for parts, some_ids, some_texts in rows_in(batches, "part", "id", "text"):
        base = parts[0] << 32
        for i, t in zip(some_ids, some_texts):
            ids.append(i)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= block_bytes:
                yield base + seq, ids, texts
                seq, ids, texts, size = seq + 1, [], [], 0
    if ids:
        yield base + seq, ids, texts


def numbered(texts: list[str], buckets: int) -> tuple[list[list[str]], np.ndarray, list[int]]:
    """The distinct words by bucket, each text's words as numbers (in that order, one array) and
    the words per text."""
    first: dict[str, int] = {}
    codes, lengths = [], []
    for text in texts:
        own = words_of(text)
        lengths.append(len(own))
        codes.extend([first.setdefault(w, len(first)) for w in own])
    home = np.fromiter((zlib.crc32(w.encode()) % buckets for w in first), np.int64, len(first))
    order = np.argsort(home, kind="stable")
    rank = np.empty(len(first), np.int64)
    rank[order] = np.arange(len(first))
    listed = list(first)
    by_bucket: list[list[str]] = [[] for _ in range(buckets)]
    for i in order.tolist():
        by_bucket[home[i]].append(listed[i])
    return by_bucket, rank[np.array(codes, np.int64)], lengths


def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    if tok.decoder is not None or tok.post_processor is not None:
        raise ValueError("words are joined by position only for a vocabulary without decoder and post-processor")
    return tok


ROUTED = "block long, bucket int, ids array<long>, payload binary"


def routed(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["block", "bucket", "ids", "payload"])


def bpe(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = True,
        block_bytes: int = BLOCK) -> DataFrame:
    """Ids and decoded text per document: (id, n_tokens, ids_sha256, decoded_sha256) or, without
    ``digest``, (id, n_tokens, ids array<int>, decoded string)."""
    spark = docs.sparkSession
    prepare(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def list_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, texts in blocks(batches, block_bytes):
            by_bucket, _, _ = numbered(texts, buckets)
            rows = [(block, b, None, zstandard.compress("\n".join(w).encode(), 3)) for b, w in enumerate(by_bucket) if w]
            if rows:
                yield routed(rows)

    def list_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, texts in blocks(batches, block_bytes):
            by_bucket, codes, lengths = numbered(texts, buckets)
            yield routed([(block, buckets, ids, pack_ints([sum(map(len, by_bucket))], lengths, codes))])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, known = load(tokenizer), {}
        for numbers, homes, payloads in rows_in(batches, "block", "bucket", "payload"):
            for block, home, payload in zip(numbers, homes, payloads):
                words = zstandard.decompress(payload).decode().split("\n")
                new = list(dict.fromkeys(w for w in words if w not in known))
                for i in range(0, len(new), 4096):
                    part = new[i:i + 4096]
                    for word, e in zip(part, tok.encode_batch_fast(part, add_special_tokens=False)):
                        known[word] = np.array(e.ids, "<u4").tobytes()
                own = [known[w] for w in words]
                yield routed([(block, home, None, pack_ints([len(x) // 4 for x in own], np.frombuffer(b"".join(own), "<u4")))])

    def join_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sha256(text):
            return hashlib.sha256(text.encode()).hexdigest()

        to_ids, to_text = (sha256, sha256) if digest else (lambda x: list(map(int, x.split())), str)
        tok = load(tokenizer)
        piece = [tok.id_to_token(i) or "" for i in range(tok.get_vocab_size(with_added_tokens=True))]
        decimal = list(map(str, range(len(piece))))
        block, counts, as_ids, as_text = None, [], [], []
        for numbers, homes, names, payloads in rows_in(batches, "block", "bucket", "ids", "payload"):
            for number, home, name, payload in zip(numbers, homes, names, payloads):
                if number != block:
                    block, counts, as_ids, as_text = number, [], [], []
                if home < buckets:  # an answer: ids of this bucket's words, in their order
                    n_ids, flat = unpack_ints(payload)
                    flat, at = flat.tolist(), 0
                    for n in n_ids.tolist():
                        counts.append(n)
                        as_ids.append(" ".join([decimal[i] for i in flat[at:at + n]]))
                        as_text.append(" ".join([piece[i] for i in flat[at:at + n]]))
                        at += n
                    continue
                expected, lengths, codes = unpack_ints(payload)
                if expected[0] != len(counts):
                    raise RuntimeError(f"block {number}: {len(counts)} words answered, {expected[0]} listed; the documents changed between two reads")
                n_of = np.array(counts, np.int64)
                at, out = 0, ([], [], [])
                for n in lengths.tolist():
                    own = codes[at:at + n]
                    at += n
                    out[0].append(int(n_of[own].sum()) if n else 0)
                    own = own.tolist()
                    for column, words, convert in ((out[1], as_ids, to_ids), (out[2], as_text, to_text)):
                        column.append(convert(" ".join([words[c] for c in own if counts[c]])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name, pa.int64()), pa.array(out[0], pa.int64()),
                     pa.array(out[1], pa.string() if digest else pa.list_(pa.int32())), pa.array(out[2], pa.string())],
                    ["id", "n_tokens", "a", "b"])
                block, counts, as_ids, as_text = None, [], [], []

    plain = docs.select(F.spark_partition_id().cast("long").alias("part"), F.col(id_col).cast("long").alias("id"),
                        F.col(text_col).cast("string").alias("text"))
    words = plain.mapInArrow(list_words, ROUTED).repartition(buckets, "bucket")
    waiting = plain.mapInArrow(list_documents, ROUTED)
    met = words.mapInArrow(encode_words, ROUTED).unionByName(waiting).repartition("block").sortWithinPartitions("block", "bucket")
    out = met.mapInArrow(join_back, f"id long, n_tokens long, {'a string' if digest else 'a array<int>'}, b string")
    names = ("ids_sha256", "decoded_sha256") if digest else ("ids", "decoded")
    return out.toDF(id_col, "n_tokens", *names)
