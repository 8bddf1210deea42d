"""WARC archives in Zstandard with a dictionary: writer, deduplication and reader (operator 9).

An archive (``.warc.zst``) starts with a skippable frame that holds the dictionary trained on the
archive's first records (none where they are too few to train one), then one frame a record.
The reader streams an archive: it loads the dictionary from the leading skippable frame, decodes
one frame at a time, and checks the version line, the header fields, Content-Length, the record's
end, and both digests; anything wrong raises ``ValueError`` with the archive's name.

``write_archives`` decides revisits first: of records with equal payloads of at least
``REVISIT_BYTES`` bytes the one with the largest page_id is the response, the others are revisit
records (identical-payload-digest profile) that hold the HTTP header only. Its Content-Length is
that of the full payload. Smaller payloads are always responses.

Defined results: null html is the empty payload; rows that repeat page_id and html share one
decision (all responses or all revisits); a null page_id is written without a record id and never
is the one referred to unless all of its group are null; null urls leave the target out; line
breaks in urls are percent-encoded; an empty table writes no record and reads back as no row.

Archives are written and read by tasks, straight to and from a folder that all executors share,
under names of their own, so a repeated task leaves an unlisted file at worst: only archives in the
manifest, a Parquet table committed by Spark, are read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexicarium.llm.store import new_path, written

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 256 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 256, 4 << 20
#: Revisit decisions (under 100 bytes each) are broadcast to the pages up to this many, else both sides are shuffled.
BROADCAST_ROWS = 500_000
MOST_READERS = 50_000

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

MANIFEST = "archive string, records long, bytes long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_RECORD_TYPES = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record: a revisit of page refers_to where that is given, else a response."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        fields.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        fields.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        fields += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    fields += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The record's row; raises ValueError on any malformed header, length or digest."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC version line")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"malformed header line {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind!r}")
    if not fields.get("content-length", "").isdigit():
        raise ValueError("no Content-Length")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {length}, {len(rest) - 4} bytes found")
    block = rest[:length]
    if fields.get("warc-block-digest") != "sha1:" + hashlib.sha1(block).hexdigest():
        raise ValueError("block digest differs")
    http, gap, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":", 1)[1].strip() for x in http.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
    if not gap or len(sizes) != 1 or not sizes[0].isdigit():
        raise ValueError("no HTTP Content-Length")
    digest, size = fields.get("warc-payload-digest", "").removeprefix("sha1:"), int(sizes[0])
    page = lambda x: int(x.removeprefix("<urn:page:").removesuffix(">")) if x else None
    refers = page(fields.get("warc-refers-to"))
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload length or digest differs")
    if kind == "revisit" and (payload or refers is None or fields.get("warc-profile") != PROFILE):
        raise ValueError("revisit with a payload, or without profile or reference")
    return {"page_id": page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": refers, "payload": payload if kind == "response" else None}


class ArchiveWriter:
    """Appends records to one archive of a shared folder."""

    def __init__(self, root: str, dictionary: zstandard.ZstdCompressionDict | None):
        fs, path = pafs.FileSystem.from_uri(root)
        fs.create_dir(path, recursive=True)
        name = f"{uuid.uuid4().hex}.warc.zst"
        self.uri, self.records, self.bytes = f"{root}/{name}", 0, 0
        self.out = fs.open_output_stream(f"{path}/{name}", compression=None)  # the archive is compressed frame by frame already
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        if dictionary is not None:
            data = dictionary.as_bytes()
            self._put(struct.pack("<II", SKIPPABLE, len(data)) + data)

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.compressor.compress(record))
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.uri, self.records, self.bytes


def train_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the samples; None where they are too few or too alike to train one."""
    if len(samples) < 8:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples)
    except zstandard.ZstdError:
        return None


def _write(batches: Iterable[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    done, waiting, size, archive, dictionary = [], [], 0, None, None

    def start() -> None:
        nonlocal archive, dictionary
        if dictionary is None:
            dictionary = train_dictionary(waiting)
        archive = ArchiveWriter(root, dictionary)
        for r in waiting:
            archive.add(r)
        waiting.clear()

    for batch in batches:
        for page_id, url, payload, refers_to in zip(*[batch.column(c) for c in ("page_id", "url", "payload", "refers_to")], strict=True):
            record = record_bytes(page_id.as_py(), url.as_py(), payload.as_py() or b"", refers_to.as_py())
            if archive is None:
                waiting.append(record)
                size += len(record)
                if len(waiting) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
                    start()
                continue
            archive.add(record)
            if archive.bytes >= ARCHIVE_BYTES:
                done.append(archive.close())
                start()
    if waiting:
        start()
    if archive is not None:
        done.append(archive.close())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True) if done else ([], [], []), (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["archive", "records", "bytes"])


def _frames(stream, name: str) -> Iterator[bytes]:
    """The decoded frames of an archive, one at a time; the leading skippable frame gives the dictionary."""
    head = stream.read(8)
    dictionary, left = None, head
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        data = stream.read(struct.unpack("<I", head[4:])[0])
        if data[:4] == FRAME:
            data = zstandard.ZstdDecompressor().decompress(data)
        dictionary, left = zstandard.ZstdCompressionDict(data), b""
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while True:
        left = left or stream.read(1 << 20)
        if not left:
            return
        frame, parts = decompressor.decompressobj(), []
        while not frame.eof:
            if not left:
                left = stream.read(1 << 20)
                if not left:
                    raise ValueError(f"{name}: the last frame is cut off")
            try:
                parts.append(frame.decompress(left))
            except zstandard.ZstdError as e:
                raise ValueError(f"{name}: {e}") from e
            left = frame.unused_data
        yield b"".join(parts)


def read_archive(uri: str) -> Iterator[dict]:
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        for i, data in enumerate(_frames(stream, uri)):
            try:
                yield parse_record(data)
            except ValueError as e:
                raise ValueError(f"{uri}, record {i}: {e}") from e


def _read(batches: Iterable[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    def packed(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in _RECORD_TYPES], names=[n for n, _ in _RECORD_TYPES])

    for batch in batches:
        for archive, expected in zip(batch.column("archive"), batch.column("records"), strict=True):
            rows, n, size = [], 0, 0
            for row in read_archive(archive.as_py()):
                if not payloads:
                    row["payload"] = None
                rows.append(row)
                n, size = n + 1, size + len(row["payload"] or b"")
                if len(rows) == 4096 or size > 8 << 20:
                    yield packed(rows)
                    rows, size = [], 0
            if n != expected.as_py():
                raise ValueError(f"{archive}: {n} records, the manifest has {expected}")
            yield packed(rows)


def revisits(keyed: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that revisit another, from (page_id, digest, size); no payload is shuffled."""
    large = keyed.where(F.col("size") >= REVISIT_BYTES)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1 and refers_to is not null").select("digest", "refers_to")
    return large.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record a row of pages into archives under root; returns the manifest (archive, records, bytes)."""
    payload = F.coalesce(F.col(f"`{html_col}`"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    again = written(revisits(rows.select("page_id", "digest", F.octet_length("payload").alias("size"))), "revisits")
    decided = again.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "refers_to")
    side = F.broadcast(decided) if decided.count() <= BROADCAST_ROWS else decided
    joined = rows.join(side, rows["page_id"].eqNullSafe(side["p"]) & (rows["digest"] == side["d"]), "left").select("page_id", "url", "payload", "refers_to")
    return written(joined.mapInArrow(lambda it: _write(it, root), MANIFEST), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of the manifest's archives, an archive a task up to MOST_READERS tasks; the count is given as the manifest's few bytes would all be put into one task otherwise."""
    return manifest.repartition(max(1, min(MOST_READERS, manifest.count()))).mapInArrow(lambda it: _read(it, payloads), RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages into a fresh folder of archives and read them back, without payloads."""
    root = new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, root)).drop("payload")
