"""WARC archives whose records are compressed one by one with a shared Zstandard dictionary.

An archive (``.warc.zst``) begins with a skippable frame (magic 0x184D2A5D) that
holds the dictionary, trained on records of that archive. Each record is a
frame of its own that needs the dictionary, so any record can be read alone, given
its offset. Of records with equal payloads one is a response and the others are
revisits that name it and carry no payload.

Tasks write archives under names of their own attempt and return one row a file;
these rows are stored by Spark's committed write and are the list of the collection. Files of lost
or repeated attempts are not in the list, so no reader sees them.
"""
from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.llm.common import join_groups, stored
from jobsift.session import scratch_path

# FIXED VALUES: the formats' marks.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE_TYPE = "application/http; msgtype=response"

#: Compressed bytes at which an archive is closed; dictionary size; bytes of records it is trained on, and of one record.
ARCHIVE_BYTES, DICTIONARY_BYTES, SAMPLE_BYTES, SAMPLE_RECORD_BYTES = 256 << 20, 64 << 10, 4 << 20, 32 << 10
#: Fewer records than this give no dictionary; such an archive has no skippable frame.
LEAST_SAMPLE = 8
LEVEL = 6
#: Bytes read from a file at a time.
READ_BYTES = 4 << 20
#: Records' date where the table has none: archives do not read the clock, so reruns agree.
DATE = "2020-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["WARC-Type"]


# ---- one record -----------------------------------------------------------------------------------------------

def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def one_line(value: str) -> str:
    """A header's value: no line ends or other controls, which would end the header early."""
    return "".join(c if c >= " " and c != "\x7f" else " " for c in value).strip()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {one_line(v)}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> Record:
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != VERSION:
        raise ValueError(f"not a record: {first[:40]!r}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    length = int(headers["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("record of a wrong length")
    return Record(headers, rest[:length])


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, ':'.join(map(str, parts)))}>"


def http_head(length: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()


def page_record(no: int, page_id, uri, payload: bytes, digest: str, refers_no, refers_id, date: str) -> bytes:
    """The record of a page: a response, or (with ``refers_no``, the number of its response) a revisit."""
    digest = f"sha1:{digest}"
    head = http_head(len(payload))
    block = head if refers_no is not None else head + payload
    headers = [("WARC-Type", "response" if refers_no is None else "revisit"), ("WARC-Record-ID", record_id("page", no)), ("WARC-Date", date)]
    if uri is not None and one_line(uri):
        headers.append(("WARC-Target-URI", uri))
    headers += [("Content-Type", RESPONSE_TYPE), ("WARC-Payload-Digest", digest), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}")]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_no is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id("page", refers_no))]
        if refers_id is not None:
            headers.append(("X-Refers-To-Page-ID", str(refers_id)))
    return record_bytes(headers, block)


def http_parts(block: bytes) -> tuple[int, bytes]:
    """(Content-Length that the block's HTTP head states, its body)."""
    head, _, body = block.partition(b"\r\n\r\n")
    for line in head.split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.lower() == b"content-length":
            return int(value), body
    raise ValueError("no Content-Length")


# ---- one archive ----------------------------------------------------------------------------------------------

def train(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of at most ``size`` bytes from the beginnings of ``records``; None if they are too few or too alike."""
    samples = [r[:SAMPLE_RECORD_BYTES] for r in records]
    if len(samples) < LEAST_SAMPLE:
        return None
    try:
        return zstandard.train_dictionary(max(1024, min(size, sum(map(len, samples)) // 8)), samples)
    except zstandard.ZstdError:
        return None


class ArchiveWriter:
    """Writes records to a binary stream: the dictionary's frame, then a frame a record.

    The first records, up to ``sample_bytes``, are held until the dictionary is trained on them.
    """

    def __init__(self, out, sample_bytes: int = SAMPLE_BYTES, dictionary_bytes: int = DICTIONARY_BYTES):
        self.out, self.sample_bytes, self.dictionary_bytes = out, sample_bytes, dictionary_bytes
        self.held: list[bytes] = []
        self.held_bytes = self.bytes = self.records = self.dictionary = 0
        self.compressor = None

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self._write(self.compressor.compress(record))
            return
        self.held.append(record)
        self.held_bytes += len(record)
        if self.held_bytes >= self.sample_bytes:
            self._start()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _start(self) -> None:
        shared = train(self.held, self.dictionary_bytes)
        if shared is not None:
            raw = shared.as_bytes()
            self.dictionary = len(raw)
            self._write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_checksum=True, write_content_size=True)
        for record in self.held:
            self._write(self.compressor.compress(record))
        self.held = []

    def close(self) -> None:
        if self.compressor is None:
            self._start()


def read_frames(source, read_bytes: int = READ_BYTES) -> Iterator[bytes]:
    """The decompressed frames of an archive, read forward through ``source.read(n)``; one record is held at a time."""
    data, shared = b"", None
    while len(data) < 8 and (more := source.read(read_bytes)):
        data += more
    if len(data) >= 8:
        magic, size = struct.unpack_from("<II", data)
        if magic == DICTIONARY_MAGIC:
            while len(data) < 8 + size:
                more = source.read(read_bytes)
                if not more:
                    raise ValueError("archive ends inside its dictionary")
                data += more
            shared, data = zstandard.ZstdCompressionDict(data[8:8 + size], dict_type=zstandard.DICT_TYPE_FULLDICT), data[8 + size:]
    decompressor = zstandard.ZstdDecompressor(dict_data=shared)
    frame, parts = decompressor.decompressobj(), []
    while True:
        if not data:
            data = source.read(read_bytes)
            if not data:
                break
        parts.append(frame.decompress(data))
        data = b""
        if frame.eof:
            yield b"".join(parts)
            data, frame, parts = frame.unused_data, decompressor.decompressobj(), []
    if any(parts):
        raise ValueError("archive ends inside a record")


# ---- collections ----------------------------------------------------------------------------------------------

def _warcinfo(name: str, date: str) -> bytes:
    fields = b"software: jobsift\r\nformat: WARC File Format 1.1\r\n"
    return record_bytes([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id("info", name)), ("WARC-Date", date), ("WARC-Filename", name),
                         ("Content-Type", "application/warc-fields")], fields)


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder named by path or URI (file, hdfs, s3, gs), and the path there."""
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if not uri.startswith("file:") else "file://" + uri[len("file:"):])


def marked_pages(pages: DataFrame, id_col: str, uri_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """(no, page_id, uri, payload, digest, refers_no, refers_id): every page with the page that it revisits, if any.

    Of pages with equal payloads of at least ``least_bytes`` the smallest id is the
    response (nulls last; of equal ids, the first stored row). Null payloads are empty.
    """
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    rows = stored(pages.select(F.col(id_col).alias("page_id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
                  .withColumn("digest", F.sha1("payload")).withColumn("no", F.monotonically_increasing_id()), "warc-pages", "zstd")
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "no")).alias("first")
    groups = stored(rows.groupBy("digest").agg(first, F.count("*").alias("copies")), "warc-groups")
    joined = join_groups(rows, groups, "digest", "copies")
    again = (F.col("no") != F.col("first.no")) & (F.octet_length("payload") >= least_bytes)
    return joined.select("no", "page_id", "uri", "payload", "digest", F.when(again, F.col("first.no")).alias("refers_no"),
                         F.when(again, F.col("first.page_id")).alias("refers_id"))


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
                   least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, sample_bytes: int = SAMPLE_BYTES, date: str = DATE) -> DataFrame:
    """Write every page as a record of archives under ``folder`` (default: a scratch folder of the session).

    Returns the stored list of archives: (path, records, bytes, dictionary_bytes). A
    folder must be one that driver and executors share. Null, empty and repeated
    rows have records like any other; a null uri leaves the header out; an empty table gives no
    archive. See ``marked_pages`` for which records are revisits.
    """
    spark = pages.sparkSession
    folder = (folder or scratch_path(spark, "llm-warc")).rstrip("/")
    marked = marked_pages(pages, id_col, uri_col, payload_col, least_bytes)

    def write(batches):
        task = TaskContext.get()
        where, base = open_fs(folder)
        where.create_dir(base, recursive=True)
        archive, done, name = None, [], ""

        def close():
            archive.close()
            archive.out.close()
            done.append((f"{folder}/{name}", archive.records - 1, archive.bytes, archive.dictionary))

        for b in batches:
            for no, page_id, uri, payload, digest, refers_no, refers_id in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))):
                if archive is None:
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{len(done):05d}.warc.zst"
                    archive = ArchiveWriter(where.open_output_stream(f"{base}/{name}", compression=None), sample_bytes)
                    archive.add(_warcinfo(name, date))
                payload = bytes(payload)
                archive.add(page_record(no, page_id, uri, payload, base64.b32encode(bytes.fromhex(digest)).decode(), refers_no, refers_id, date))
                if archive.bytes >= archive_bytes:
                    close()
                    archive = None
        if archive is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=["path", "records", "bytes", "dictionary_bytes"])

    return stored(marked.mapInArrow(write, "path string, records long, bytes long, dictionary_bytes long"), "warc-list")


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """The page records of listed archives (``path``), one task a file at most.

    (page_id string, uri, record_id, record_type, payload_bytes, payload_digest,
    refers_to_record, refers_to string[, payload]). Frames' checksums, block digests and, of responses,
    lengths and payload digests are verified; a damaged archive raises an error.
    """
    names = ["page_id", "uri", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to_record", "refers_to"]
    types = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 3
    if with_payload:
        names, types = [*names, "payload"], [*types, pa.binary()]

    def rows(path):
        where, at = open_fs(path)
        with where.open_input_stream(at, compression=None) as source:
            for frame in read_frames(source):
                record = parse_record(frame)
                if record.kind not in ("response", "revisit"):
                    continue
                h = record.headers
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                length, body = http_parts(record.block)
                if f"sha1:{base32_sha1(record.block)}" != h["WARC-Block-Digest"]:
                    raise ValueError(f"{path}: block digest differs in {h['WARC-Record-ID']}")
                if record.kind == "response" and (length != len(body) or base32_sha1(body) != digest):
                    raise ValueError(f"{path}: payload differs in {h['WARC-Record-ID']}")
                out = (h.get("X-Page-ID"), h.get("WARC-Target-URI"), h["WARC-Record-ID"], record.kind, length, digest,
                       h.get("WARC-Refers-To"), h.get("X-Refers-To-Page-ID"))
                yield (*out, body if record.kind == "response" else None) if with_payload else out

    def batch(held):
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held), types)], names=names)

    def read(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                held, size = [], 0
                for row in rows(path):
                    held.append(row)
                    size += row[4] if with_payload else 256
                    if size >= READ_BYTES:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    ddl = ", ".join(f"{n} {'long' if t == pa.int64() else 'binary' if t == pa.binary() else 'string'}" for n, t in zip(names, types))
    # The list is one row a file: a number of partitions by the files keeps each file's reading apart.
    files = max(1, archives.count())
    return archives.select("path").repartition(min(files, 20_000), "path").mapInArrow(read, ddl)


def dangling_revisits(records: DataFrame) -> DataFrame:
    """Revisits (of ``read_archives``) whose response is in none of the archives, or has another digest."""
    responses = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.lit(True).alias("_there"))
    targets = records.where("record_type = 'revisit'").select("refers_to_record").distinct().join(responses, "refers_to_record", "left_anti")
    return records.join(targets, "refers_to_record", "left_semi")


def archived_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives and report each page from what is read back.

    (page_id, payload_bytes, payload_digest, record_type, refers_to): page_id and refers_to in the type of page_id.
    """
    kind = pages.schema["page_id"].dataType
    back = read_archives(write_archives(pages, folder))
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))
