"""WARC archives as chunked record tables.

Payloads travel as rows of record and chunk number, so neither writer nor reader holds a whole record outside its row
in the JVM. Writing tasks stream chunks into archive files in the shared folder and return a manifest of segments, each
beginning at a record; reading tasks take a segment each and return chunk rows that carry the digest of the payload up
to and including the chunk. Files of failed attempts are in no manifest and therefore never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import map_batches, record, work_folder, written

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = b"\r\n"


@dataclass(frozen=True)
class Settings:
    """Bytes per chunk, per segment and per file, and the smallest payload that is stored once only."""

    chunk: int = 1 << 18
    segment: int = 8 << 20
    file: int = 1 << 30
    least: int = 0



def plan_records(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(page_id, url, body, digest, refers_to) per row of `pages`: the payload, its SHA-1, and the page it repeats.

    Of equal payloads of at least `least` bytes the one with the largest page_id is stored, the others refer to it;
    rows that repeat that id are stored too, and a NULL id is smaller than any. Equal means equal SHA-1 and length.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("body"),
    )
    keyed = rows.withColumn("digest", F.unhex(F.sha1("body"))).withColumn("bytes", F.octet_length("body"))
    # Only payloads that occur again are joined back; they are counted without their bodies.
    again = keyed.groupBy("digest", "bytes").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    # Written first, so that its size is known and the bodies are shuffled only if it is large.
    again = written(again.where((F.col("n") > 1) & (F.col("bytes") >= settings.least)).select("digest", "bytes", "kept"), "payloads")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept"))
    return keyed.join(again, ["digest", "bytes"], "left").select("page_id", "url", "body", "digest", refers.alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, settings: Settings = Settings()) -> DataFrame:
    """Write one record per row of `pages` (page_id, url, html) and return the manifest (path, begin, end, records).

    NULL html is an empty payload, a NULL url is left out. The first job writes the files; the manifest is a table in
    the shared folder, so a lost executor repeats its own files only. The folder must be one that pyarrow can write.
    """
    spark = pages.sparkSession
    folder = folder or f"{work_folder(spark)}/merchlens-warc-{uuid.uuid4().hex}"
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    planned = plan_records(pages, settings)
    numbers = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.octet_length("body") / settings.chunk).cast("int") - 1))
    # Exploding keeps the chunks of a record next to each other and in order.
    chunks = planned.select("*", F.explode(numbers).alias("chunk")).select(
        "page_id", "url", "digest", "refers_to", F.octet_length("body").cast("long").alias("bytes"), "chunk",
        F.substring("body", F.col("chunk") * settings.chunk + 1, F.lit(settings.chunk)).alias("data"),
    )
    schema = pa.schema([("path", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("records", pa.int64())])

    def work(batches):
        writer = _Writer(folder, date, settings)
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] == 0:
                    yield from _manifest(schema, writer.begin_record(row))
                writer.add(row)
        yield from _manifest(schema, writer.close())

    return written(map_batches(chunks, work, "path string, begin long, end long, records long"), "warc-manifest")


def _manifest(schema: pa.Schema, segments: list[tuple]) -> Iterator[pa.RecordBatch]:
    if segments:
        path, begin, end, records = zip(*segments)
        yield record(schema, path=path, begin=begin, end=end, records=records)


class _Writer:
    """Streams records into files; gives back the segments of a file when it is complete."""

    def __init__(self, folder: str, date: str, settings: Settings):
        self.folder, self.date, self.settings = folder, date, settings
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.out, self.segments, self.waiting = None, [], None

    def begin_record(self, row: dict) -> list[tuple]:
        """Write the headers of a record; returns the segments of a file that has become full."""
        self._end_record()
        done = self.close() if self.out is not None and self.at >= self.settings.file else []
        if self.out is None:
            self.system.create_dir(self.root, recursive=True)
            self.path, self.at = f"{self.root}/{uuid.uuid4().hex}.warc", 0
            self.out = self.system.open_output_stream(self.path)
        if not self.segments or self.at - self.segments[-1][0] >= self.settings.segment:
            self.segments.append([self.at, 0])
        self.segments[-1][1] += 1
        self._write(_headers(row, self.date))
        self.waiting = row
        return done

    def add(self, row: dict) -> None:
        if row["refers_to"] is None:
            self._write(row["data"])

    def _end_record(self) -> None:
        if self.waiting is not None:
            self._write(BREAK + BREAK)
            self.waiting = None

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def close(self) -> list[tuple]:
        if self.out is None:
            return []
        self._end_record()
        self.out.close()
        ends = [s[0] for s in self.segments[1:]] + [self.at]
        done = [(self.path, begin, end, records) for (begin, records), end in zip(self.segments, ends)]
        self.out, self.segments = None, []
        return done


def _headers(row: dict, date: str) -> bytes:
    http = BREAK.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % row["bytes"], b"", b""])
    revisit = row["refers_to"] is not None
    page = "" if row["page_id"] is None else row["page_id"]
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{page}>"), ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(http) + (0 if revisit else row["bytes"])),
        ("WARC-Payload-Digest", f"sha1:{base64.b32encode(row['digest']).decode()}"),
    ]
    if revisit:
        fields += [("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"), ("WARC-Profile", PROFILE)]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", row["url"].replace("\r", "%0D").replace("\n", "%0A")))
    lines = ["WARC/1.1", *(f"{name}: {value}" for name, value in fields), "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + http


class _Stream:
    """A file from a position on, read in pieces."""

    def __init__(self, source, begin: int, piece: int):
        self.source, self.held, self.piece, self.at = source, b"", piece, begin
        source.seek(begin)

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and including a mark."""
        looked = 0
        while (found := self.held.find(mark, looked)) < 0:
            looked = max(0, len(self.held) - len(mark) + 1)
            more = self.source.read(self.piece)
            if not more:
                raise ValueError("archive ends within a header")
            self.held += more
        return self._give(found + len(mark))

    def take(self, size: int) -> bytes:
        if not self.held:
            self.held = self.source.read(self.piece)
            if not self.held and size:
                raise ValueError("archive ends within a record")
        return self._give(min(size, len(self.held)))

    def exactly(self, size: int) -> bytes:
        parts = []
        while size:
            parts.append(self.take(size))
            size -= len(parts[-1])
        return b"".join(parts)

    def _give(self, size: int) -> bytes:
        given, self.held = self.held[:size], self.held[size:]
        self.at += size
        return given


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines if line)}


def _page(identifier_text: str | None) -> int | None:
    digits = (identifier_text or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


CHUNKS = pa.schema([
    ("record_id", pa.string()), ("chunk", pa.int64()), ("last", pa.bool_()), ("data", pa.binary()), ("bytes", pa.int64()),
    ("digest", pa.string()), ("type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("url", pa.string()),
])


def read_chunks(manifest: DataFrame, data: bool = True, settings: Settings = Settings()) -> DataFrame:
    """The chunk rows of all archived records: record_id, chunk, last, data, bytes, digest, type, page_id, refers_to, url.

    bytes and digest (bare base32 SHA-1) cover the payload up to and including the chunk, so the last row of a record
    has those of the whole payload. A revisit has one row without data; its length and digest are those of its headers.
    A stored payload that differs from the digest in its headers is an error. Without `data` the column is NULL. Records
    of repeated rows each have their chunks, an empty payload has one of no bytes, and an empty manifest gives no rows.
    """
    count = manifest.count()
    # A task per segment, or per 16 of them where there are very many.
    tasks = max(1, min(count, max(10_000, -(-count // 16))))
    spread = manifest.select("path", "begin", "end").repartition(tasks, "path", "begin")

    def work(batches):
        for batch in batches:
            for path, begin, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
                system, local = fs.FileSystem.from_uri(path)
                with system.open_input_file(local) as source:
                    yield from _batched(_records(_Stream(source, begin, settings.chunk), end, data, settings))

    return map_batches(
        spread, work,
        "record_id string, chunk long, last boolean, data binary, bytes long, digest string, type string, page_id long, refers_to long, url string",
    )


def _records(stream: _Stream, end: int, data: bool, settings: Settings) -> Iterator[dict]:
    while stream.at < end:
        fields = _fields(stream.until(BREAK + BREAK))
        head = stream.until(BREAK + BREAK)
        left = int(fields["content-length"]) - len(head)
        row = {
            "record_id": fields["warc-record-id"].strip("<>"), "type": fields["warc-type"], "url": fields.get("warc-target-uri"),
            "page_id": _page(fields["warc-record-id"]), "refers_to": _page(fields.get("warc-refers-to")),
        }
        stated = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-type"] == "revisit":
            yield row | {"chunk": 0, "last": True, "data": None, "bytes": int(_fields(head)["content-length"]), "digest": stated}
        else:
            sha, seen, number = hashlib.sha1(), 0, 0
            while number == 0 or left:
                part = stream.exactly(min(left, settings.chunk))
                left -= len(part)
                seen += len(part)
                sha.update(part)
                digest = base64.b32encode(sha.digest()).decode()
                if not left and digest != stated:
                    raise ValueError(f"payload of {row['record_id']} differs from its digest")
                yield row | {"chunk": number, "last": not left, "data": part if data else None, "bytes": seen, "digest": digest}
                number += 1
        stream.exactly(4)


def _batched(rows: Iterator[dict], size: int = 64) -> Iterator[pa.RecordBatch]:
    waiting = []
    for row in rows:
        waiting.append(row)
        if len(waiting) == size:
            yield pa.RecordBatch.from_pylist(waiting, schema=CHUNKS)
            waiting = []
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema=CHUNKS)


def round_trip(pages: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Write `pages` and read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to per row."""
    rows = read_chunks(write_archives(pages, settings=settings), data=False, settings=settings).where("last")
    return rows.select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to",
    )
