"""WARC archives of pages, compressed with Zstandard and a shared dictionary.

An archive starts with a skippable frame that holds the dictionary; after it every
record is a frame of its own, so records can be decoded one by one. Of records with
equal payloads of at least 100 bytes one is a response, the others revisit it.

Writing: digests are counted first, and a small sieve of the repeated ones lets pages
without a copy pass straight on; only the others meet the id that their copies refer to.
Each task writes one archive with Spark's own text sink, whose line separator is an
empty skippable frame; so archives go to any file system, and only whole ones stay
when a task is repeated. A task's archive is about as large as its share of the pages
table, so it is bounded by the size of input splits.

Reading: archives come as binary files; frames are cut by their block headers, decoded
with the archive's dictionary, and each record's headers, lengths and digest are checked.

Defined cases: null html is an empty payload; empty and short payloads are responses
even if repeated; repeated rows with the smallest id are each a response; copies without
any id are responses, and a row without id among copies with one revisits it; a null url
is left out of the record; line breaks in a url are percent-encoded; an empty table
writes no archive and reads no row; only id, url and html are read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, shared_folder, sieve, through

#: Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
EMPTY_FRAME = "P*M\x18\x00\x00\x00\x00"  # skippable, no content
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

LEAST_REVISITED = 100
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
DICTIONARY_BYTES = 32 * 1024
#: The dictionary is made from the starts of about so many pages.
SAMPLE_PAGES, SAMPLE_BYTES = 200, 8 * 1024

RECORD = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC record; a revisit leaves the payload out."""
    http = HTTP % len(payload)
    block = http + payload if refers_to is None else http
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")))
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    lines = b"".join(f"{name}: {value}\r\n".encode() for name, value in headers)
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _number(urn: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise ValueError(f"not a page record: {urn}")
    return int(urn[10:-1]) if urn[10:-1] else None


def parsed(data: bytes) -> tuple:
    """A record's values in the order of RECORD; ValueError if it is not what it says."""
    head, found, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not found or version != VERSION:
        raise ValueError("no WARC header")
    headers = {}
    for line in lines:
        name, colon, value = line.decode("utf-8").partition(": ")
        if not colon or name.lower() in headers:
            raise ValueError(f"bad header {name!r}")
        headers[name.lower()] = value
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - headers.keys()
    if missing:
        raise ValueError(f"headers are missing: {sorted(missing)}")
    n = int(headers["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content is {len(rest) - 4} bytes long, not {n}")
    http, found, payload = rest[:n].partition(b"\r\n\r\n")
    if not found or not http.startswith(b"HTTP/1.1 200 "):
        raise ValueError("no HTTP header")
    length = next((int(x[16:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length: ")), -1)
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    refers_to = None
    if kind == "response":
        if length != len(payload) or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("the payload is not the one described")
    elif kind == "revisit":
        if payload or headers.get("warc-profile") != REVISIT_PROFILE:
            raise ValueError("not a revisit of an identical payload")
        refers_to, payload = _number(headers["warc-refers-to"]), None
    else:
        raise ValueError(f"unknown record type {kind!r}")
    url = headers.get("warc-target-uri")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    return _number(headers["warc-record-id"]), url, kind, refers_to, payload, length, digest


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at a position ends, by its block headers."""
    start = bytes(data[at : at + 18])
    at += zstandard.frame_header_size(start)
    last = False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + (4 if zstandard.get_frame_parameters(start).has_checksum else 0)


def records(archive: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    data, at = memoryview(archive), 0
    decoder = None
    while at < len(data):
        magic, size = struct.unpack("<II", data[at : at + 8])
        if magic in SKIPPABLE_FRAMES:
            if magic == DICTIONARY_FRAME:
                if at:
                    raise ValueError("the dictionary is not in front")
                dictionary = zstandard.ZstdCompressionDict(bytes(data[8 : 8 + size]))
                decoder = zstandard.ZstdDecompressor(dict_data=dictionary)
            at += 8 + size
            continue
        if decoder is None:
            raise ValueError("the archive has no dictionary in front")
        end = frame_end(data, at)
        if end > len(data):
            raise ValueError("the last frame is cut off")
        yield decoder.decompress(data[at:end])
        at = end


def dictionary_of(samples: list[bytes]) -> bytes:
    """A trained dictionary; with too little to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        plain = b"".join(samples) + record(0, "http://", b"", "0" * 64, None)
        return plain[-DICTIONARY_BYTES:]


def _archived(dictionary: bytes):
    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            frames = []
            if encoder is None and batch.num_rows:
                encoder = zstandard.ZstdCompressor(
                    level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True
                )
                frames.append(struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary)
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for values in zip(*columns, strict=True):
                frames.append(encoder.compress(record(*(v.as_py() for v in values))))
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], names=["frame"])

    return archive


def write(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> None:
    """Archives of all pages, one record each, in `folder`."""
    payload = F.coalesce(F.col(f"`{html_column}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= LEAST_REVISITED
    repeated = settled(
        rows.where(long_enough)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    # About SAMPLE_PAGES rows, whatever the number of pages and of copies.
    sample = (
        rows.sample(min(1.0, SAMPLE_PAGES / max(1, pages.count())), seed=7)
        .select("page_id", "url", "digest", F.substring("payload", 1, SAMPLE_BYTES).alias("payload"))
        .collect()
    )
    sample.sort(key=lambda r: (r.digest, r.page_id is None, r.page_id))
    dictionary = dictionary_of([record(r.page_id, r.url, bytes(r.payload), r.digest, None) for r in sample])
    marked = through(rows, sieve(repeated, "digest"), "digest")
    maybe = F.col("_sieve_hit") & long_enough
    alone = marked.where(~maybe).drop("_sieve_hit").withColumn("refers_to", F.lit(None).cast("long"))
    revisits = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    copies = (
        marked.where(maybe)
        .drop("_sieve_hit")
        .join(repeated, "digest", "left")
        .withColumn("refers_to", F.when(revisits, F.col("first")))
        .drop("first")
    )
    frames = alone.unionByName(copies).mapInArrow(_archived(dictionary), "frame binary")
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(folder)


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The checked records of all archives in a folder; revisits have a null payload."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string())
            names = [c.split()[0] for c in RECORD.split(", ")]
            arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for archive in batch.column("content"):
                rows, size = [], 0
                for data in records(archive.as_py()):
                    values = parsed(data)
                    rows.append(values if payloads else (*values[:4], None, *values[5:]))
                    size += len(data) if payloads else 1
                    if size > 1 << 22 or len(rows) >= 4096:
                        yield out(rows)
                        rows, size = [], 0
                yield out(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(checked, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives in a shared folder and read again, without payloads."""
    folder = shared_folder(pages.sparkSession)
    write(pages, folder)
    return read(pages.sparkSession, folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
