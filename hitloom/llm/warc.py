"""WARC archives, each record a Zstandard frame, with the archive's own dictionary in front.

Each task writes its rows to archives in a shared folder. An archive starts
with a skippable frame that holds a dictionary trained on the first records of
this archive (bounded by `SAMPLE_BYTES`), then comes one frame per record, so a
record can be read from its offset alone. A payload that occurs again is not
stored again: the row with the smallest id is the response, the others are
revisits that name it. Only digests are grouped; payloads are never shuffled
unless repeated digests are too many to broadcast.

A task's archives have names of this attempt and are listed in a manifest that
Spark commits, so a lost or repeated attempt leaves files that no manifest
names. Readers take the manifest's list, stream one record at a time, and raise
on a payload that does not have its digest.

Every record has an id of its own; the page's id is a header beside it, and a
revisit names the page that holds its payload.

Defined cases: a null payload is empty; empty payloads are equal to each other;
rows that share the smallest id of a payload are all responses, so a payload may
be stored as often as that id is repeated; a row without an id is a revisit of
the smallest id with its payload, and a response where no such row has an id; a
null address leaves the header out; an empty table makes no archive; other columns are not looked at;
an archive of too few records to train on has no dictionary.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitloom.llm.common import saved, scratch_dir, small_side

# Fixed values of the two file formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Headers of our own.
PAGE_ID = "Page-ID"
REFERS_TO = "Refers-To-Page-ID"

DICTIONARY_BYTES = 64 << 10
SAMPLE_SHARE = 50  # a dictionary is no more than this part of what it was trained on
SAMPLE_BYTES = 4 << 20
ARCHIVE_BYTES = 64 << 20
LEVEL = 6

MANIFEST = "path string, records long, payload_bytes long, file_bytes long"


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, sha1: str, refers_to, date: str) -> bytes:
    """One response record, or a revisit record if it refers to another page."""
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if page_id is not None:
        headers.append((PAGE_ID, quote(str(page_id), safe="")))
    if url is not None:
        plain = "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url)
        headers.insert(2, ("WARC-Target-URI", plain))
    if refers_to is None:
        return _record(headers, http.encode() + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), (REFERS_TO, quote(str(refers_to), safe=""))]
    return _record(headers, http.encode())


class ArchiveWriter:
    """One archive file; records are held back until there are enough to train a dictionary on."""

    def __init__(self, folder: str, date: str):
        self.files, root = fs.FileSystem.from_uri(folder)
        self.files.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.path, self._at = f"{folder}/{name}", f"{root}/{name}"
        self._date, self._first, self._held, self._out = date, [], 0, None
        self.records = self.payload_bytes = self.written = 0

    def add(self, record: bytes, payload_bytes: int) -> None:
        self.records += 1
        self.payload_bytes += payload_bytes
        if self._out is None:
            self._first.append(record)
            self._held += len(record)
            if self._held >= SAMPLE_BYTES:
                self._start()
        else:
            self._write(self._compressor.compress(record))

    def _write(self, data: bytes) -> None:
        self._out.write(data)
        self.written += len(data)

    def _start(self) -> None:
        self._out = self.files.open_output_stream(self._at, compression=None)
        try:
            size = max(256, min(DICTIONARY_BYTES, self._held // SAMPLE_SHARE))
            trained = zstandard.train_dictionary(size, self._first, level=LEVEL)
        except zstandard.ZstdError:  # too few or too short records
            trained = None
        if trained:
            data = trained.as_bytes()
            self._write(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
        self._compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
        info = [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
            ("WARC-Date", self._date),
            ("Content-Type", "application/warc-fields"),
        ]
        self._write(self._compressor.compress(_record(info, b"format: WARC File Format 1.1\r\n")))
        for record in self._first:
            self._write(self._compressor.compress(record))
        self._first = []

    def close(self) -> tuple:
        if self._out is None:
            self._start()
        self._out.close()
        return self.path, self.records, self.payload_bytes, self.written


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write all rows to archives under ``folder`` and return the manifest, one row per archive."""
    rows = pages.select(
        F.col(key).alias("id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    may_repeat = F.length("payload") >= min_revisit_bytes
    repeated = saved(
        rows.filter(may_repeat)
        .groupBy("sha1")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("sha1", "first"),
        "repeated",
    )
    is_other = F.col("id").isNull() | (F.col("first") < F.col("id"))
    refers = F.when(may_repeat & is_other, F.col("first"))
    planned = rows.join(small_side(repeated), "sha1", "left").select("id", "url", "payload", "sha1", refers.alias("first"))

    def run(batches):
        writer, done = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                page, address, data, sha1, first = (batch.column(i)[k].as_py() for i in range(5))
                writer = writer or ArchiveWriter(folder, date)
                writer.add(page_record(page, address, data, sha1, first, date), len(data))
                if writer.payload_bytes >= ARCHIVE_BYTES:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)], names=["path", "records", "payload_bytes", "file_bytes"]
            )

    return saved(planned.mapInArrow(run, MANIFEST), "manifest")


def archive_records(path: str):
    """(offset, record bytes) of each record of an archive, one at a time."""
    files, at = fs.FileSystem.from_uri(path)
    with files.open_input_stream(at, compression=None) as stream:
        head = stream.read(8)
        trained, offset = None, 0
        if len(head) == 8 and struct.unpack("<II", head)[0] == DICTIONARY_MAGIC:
            size = struct.unpack("<II", head)[1]
            trained, offset, head = zstandard.ZstdCompressionDict(stream.read(size)), 8 + size, b""
        decompressor = zstandard.ZstdDecompressor(dict_data=trained)
        rest = head
        while True:
            frame, parts, used = decompressor.decompressobj(), [], 0
            while not frame.eof:
                rest = rest or stream.read(1 << 16)
                if not rest:
                    if used:
                        raise ValueError(f"{path} ends within a record")
                    return
                parts.append(frame.decompress(rest))
                used += len(rest) - len(frame.unused_data)
                rest = frame.unused_data
            yield offset, b"".join(parts)
            offset += used


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers with names in lower case, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def _page(name: str | None) -> str | None:
    return None if name is None else unquote(name)


RECORDS = (
    "path string, offset long, page_id string, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to string"
)


def read_archives(spark: SparkSession, manifest: DataFrame, payloads: bool = False, id_type: str = "long") -> DataFrame:
    """One row per response or revisit record of the archives that the manifest names; page ids are of ``id_type``."""

    def rows(path: str):
        for offset, data in archive_records(path):
            headers, block = parse_record(data)
            kind = headers["warc-type"]
            if kind == "warcinfo":
                continue
            http, _, body = block.partition(b"\r\n\r\n")
            digest = headers["warc-payload-digest"].removeprefix("sha1:")
            fields = {k.lower(): v for k, _, v in (x.partition(": ") for x in http.decode().split("\r\n")[1:])}
            size = int(fields["content-length"])
            if kind == "response":
                if base64.b32encode(hashlib.sha1(body).digest()).decode() != digest or len(body) != size:
                    raise ValueError(f"{path}, {offset}: the payload does not have its digest")
            row = (
                path,
                offset,
                _page(headers.get(PAGE_ID.lower())),
                headers.get("warc-target-uri"),
                kind,
                size,
                digest,
                _page(headers.get(REFERS_TO.lower())),
            )
            yield (*row, body if kind == "response" else None) if payloads else row

    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"]

    def run(batches):
        def pack(part: list) -> pa.RecordBatch:
            columns = [pa.array(c, type=k) for c, k in zip(zip(*part), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=names[: len(columns)])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                part, held = [], 0
                for row in rows(path):
                    part.append(row)
                    held += 200 + (len(row[8] or b"") if payloads else 0)
                    if held >= 4 << 20:
                        yield pack(part)
                        part, held = [], 0
                if part:
                    yield pack(part)

    archives = manifest.select("path").repartition(spark.sparkContext.defaultParallelism * 4)
    found = archives.mapInArrow(run, RECORDS + (", payload binary" if payloads else ""))
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive_pages(pages: DataFrame, folder: str | None = None, payloads: bool = False, **columns) -> DataFrame:
    """Write pages to archives and read them back; without a folder, a new one in the shared folder."""
    spark = pages.sparkSession
    folder = folder or f"{scratch_dir(spark)}/warc"
    id_type = dict(pages.dtypes)[columns.get("key", "page_id")]
    return read_archives(spark, write_archives(pages, folder, **columns), payloads, id_type)
