"""WARC archives compressed with Zstandard: writer and reader.

An archive starts with a skippable frame that holds the dictionary, then has one frame per
record.  Each writing task makes its own archives, of ``ROLL`` bytes at most and a record, under
names no other attempt uses; the table of archives that the job returns names those of the
attempts that Spark committed, so a retried task leaves no record twice.  The reader streams an
archive: it loads the dictionary from the leading frame, decodes one frame per record and checks
the header, the lengths and the digest.

Defined results (query rows): a null payload counts as empty; a null url is written empty; of
equal payloads, rows with the smallest id are responses (all of them, if rows repeat), others
revisits; a null id loses to every id, and where all are null the rows are responses; an empty
table writes no archive and gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, rows_in, same, saved
from tidemark.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D          # of the dictionary's skippable frame
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
ROLL = 64 << 20
SAMPLE_ROWS, SAMPLE_BYTES = 400, 4096  # what the dictionary is trained on: a bounded sample
DICTIONARY_BYTES = 32 << 10
DATE = "2024-01-01T00:00:00Z"
END = b"\r\n\r\n"


class Malformed(ValueError):
    """A record or an archive that does not hold what its headers say."""


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --------------------------------------------------------------------------------------- files

def open_fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path of a URI or a plain local path."""
    if re.match(r"^\w+:", path):
        return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pyarrow.fs.LocalFileSystem(), re.sub(r"^/+", "/", path)


def train_dictionary(samples: list[bytes]) -> bytes:
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too little to train on: plain content serves as a dictionary
        return (b"".join(samples)[-DICTIONARY_BYTES:] + b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: ")


class Writer:
    def __init__(self, out, dictionary: bytes):
        self.out = out
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=True)
        out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
        self.size = 8 + len(dictionary)

    def record(self, headers: list[tuple[str, str]], block: bytes) -> None:
        head = "".join(f"{k}: {clean(v)}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
        frame = self.compressor.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + END)
        self.out.write(frame)
        self.size += len(frame)


def clean(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if re.search("[\r\n]", value) else value


def frames(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Decoded frames of an archive, one at a time."""
    buffer = stream.read(8)
    if len(buffer) < 8:
        raise Malformed("no leading frame")
    magic, size = struct.unpack("<II", buffer)
    if magic != DICTIONARY_MAGIC:
        raise Malformed("the first frame holds no dictionary")
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise Malformed("the dictionary is cut short")
    if dictionary[:4] == ZSTD_MAGIC:
        dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
    context = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    data = b""
    while True:
        if len(data) < 8:
            data += stream.read(chunk)
        if not data:
            return
        if len(data) >= 8 and (head := struct.unpack("<II", data[:8]))[0] in SKIPPABLE:
            while len(data) < 8 + head[1]:
                more = stream.read(chunk)
                if not more:
                    raise Malformed("a skippable frame is cut short")
                data += more
            data = data[8 + head[1]:]
            continue
        if data[:4] != ZSTD_MAGIC:
            raise Malformed("no frame where one should start")
        decoder, out = context.decompressobj(), []
        while True:
            try:
                out.append(decoder.decompress(data))
            except zstandard.ZstdError as e:
                raise Malformed(f"a frame does not decode: {e}") from None
            if decoder.eof:
                data = decoder.unused_data
                break
            data = stream.read(chunk)
            if not data:
                raise Malformed("a frame is cut short")
        yield b"".join(out)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers by lower-case name, block) of one record; raises ``Malformed``."""
    head, gap, rest = record.partition(END)
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise Malformed("no WARC header")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#-'*+\-.0-9A-Z^-z|~]+", name):
            raise Malformed(f"a header line without a name: {line[:60]!r}")
        headers[name.decode().lower()] = value.strip().decode("utf-8", "replace")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise Malformed(f"no {name}")
    if not headers["content-length"].isdigit() or int(headers["content-length"]) != len(rest) - len(END) or rest[-len(END):] != END:
        raise Malformed("the block's length is not Content-Length")
    return headers, rest[:-len(END)]


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    head, gap, payload = block.partition(END)
    if not gap or not head.startswith(b"HTTP/1."):
        raise Malformed("no HTTP header")
    pairs = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.decode("latin-1").lower(): v.strip().decode("latin-1") for k, _, v in pairs}, payload


def checked(headers: dict[str, str], block: bytes) -> tuple[int, bytes]:
    """(length of the full payload, payload here) of a response or revisit whose digest and
    lengths agree."""
    http, payload = http_parts(block)
    size = http.get("content-length", "")
    if not size.isdigit():
        raise Malformed("no payload length")
    if headers["warc-type"] == "response":
        if int(size) != len(payload):
            raise Malformed("the payload's length is not that of its HTTP header")
        if headers.get("warc-payload-digest") != "sha1:" + base32_sha1(payload):
            raise Malformed("the payload's digest differs")
    elif payload:
        raise Malformed("a revisit holds a payload")
    elif "warc-refers-to" not in headers:
        raise Malformed("a revisit refers to nothing")
    return int(size), payload


# ------------------------------------------------------------------------------------ operators

def record_types(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """(id, url, payload, digest, first): ``first`` is the id that a revisit refers to, null for
    a response.  Payloads are equal when their length, SHA-1 and SHA-256 are; groups are combined
    before their shuffle."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("id", "url", "payload", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha2"))
    first = (rows.filter(F.octet_length("payload") >= least_bytes).groupBy("sha2", "sha1")
             .agg(F.min("id").alias("least")).withColumnsRenamed({"sha2": "_2", "sha1": "_1"}))
    joined = rows.join(first, (rows["sha2"] == first["_2"]) & (rows["sha1"] == first["_1"]), "left")
    revisit = F.col("least").isNotNull() & ~same(F.col("id"), F.col("least"))
    return joined.select("id", "url", "payload", F.when(revisit, F.col("least")).alias("first"))


def write_warc(rows: DataFrame, folder: str, dictionary: bytes, roll: int = ROLL) -> DataFrame:
    """Archives of ``rows(id, url, payload, first)`` under ``folder``: (path, records, bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = writer = None
        path, n, done = "", 0, []
        for ids, urls, payloads, firsts in rows_in(batches, "id", "url", "payload", "first"):
            for i, url, payload, first in zip(ids, urls, payloads, firsts):
                if writer is None:
                    path, n = f"{folder}/{uuid.uuid4().hex}.warc.zst", 0
                    fs, at = open_fs(path)
                    fs.create_dir(at.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(at)
                    writer = Writer(out, dictionary)
                headers = [("WARC-Type", "response" if first is None else "revisit"),
                           ("WARC-Record-ID", f"<urn:page:{'' if i is None else i}>"), ("WARC-Date", DATE),
                           ("WARC-Target-URI", url or ""), ("Content-Type", "application/http;msgtype=response"),
                           ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload))]
                if first is not None:
                    headers += [("WARC-Refers-To", f"<urn:page:{first}>"),
                                ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
                writer.record(headers, http + (payload if first is None else b""))
                n += 1
                if writer.size >= roll:
                    out.close()
                    done.append((path, n, writer.size))
                    writer = None
        if writer is not None:
            out.close()
            done.append((path, n, writer.size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["path", "records", "bytes"])

    prepare(rows.sparkSession)
    return saved(rows.mapInArrow(run, "path string, records long, bytes long"), "archives")


RECORD = ("path string, record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary")


def read_warc(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives named in ``archives(path, records)``.  A malformed
    record, or a count other than ``records``, stops the job."""
    kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for paths, counts in rows_in(batches, "path", "records"):
            for path, count in zip(paths, counts):
                fs, at = open_fs(path)
                out, size, n = [], 0, 0
                with fs.open_input_stream(at) as stream:
                    for record in frames(stream):
                        headers, block = parse(record)
                        length, payload = checked(headers, block)
                        out.append((path, headers["warc-record-id"], headers["warc-type"], headers.get("warc-target-uri"),
                                    headers.get("warc-refers-to"), headers.get("warc-payload-digest"), length,
                                    payload if with_payload else None))
                        n, size = n + 1, size + len(block)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                            out, size = [], 0
                if n != count:
                    raise Malformed(f"{path}: {n} records of {count}")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    spark = archives.sparkSession
    prepare(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # stated, or the few bytes of the names would end in one task
    return archives.select("path", "records").repartition(n, "path").mapInArrow(run, RECORD)


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as archives in the shared folder; (path, records, bytes)."""
    spark = pages.sparkSession
    ids = pages.select(F.col(id_col).alias("_i")).distinct().orderBy(F.xxhash64("_i"), "_i").limit(SAMPLE_ROWS)
    sample = (pages.join(F.broadcast(ids), pages[id_col] == ids["_i"])  # at most SAMPLE_ROWS ids
              .select(F.substring(F.col(payload_col).cast("string"), 1, SAMPLE_BYTES).alias("s"))
              .filter("s is not null").limit(SAMPLE_ROWS).collect())
    dictionary = train_dictionary([r["s"].encode() for r in sample])
    return write_warc(record_types(pages, id_col, url_col, payload_col), scratch_path(spark, "warc"), dictionary)


def page_id(column):
    return F.regexp_extract(column, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
