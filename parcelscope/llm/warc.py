"""WARC archives as a chunked record table.

Writing.  Every page is a record.  Payloads are dealt to rows of at most ``CHUNK`` bytes (record, chunk number) inside
Spark; a task streams them into archives, a gzip member for each record, and begins a new archive beyond ``ARCHIVE``
bytes.  Of records with equal payloads of at least ``LEAST`` bytes, that with the smallest id is a ``response``
and the others are ``revisit`` records, which hold HTTP headers and refer to it.  The tasks' result is the manifest:
segments of archives of about ``SEGMENT`` bytes that begin and end between records.  Archives of
task attempts that failed are not in it.

Reading.  A task streams a segment (or a whole archive, compressed by record, as a whole, or not at all) and gives
rows (record, chunk number) with the data, and the byte count and SHA-256 of the payload up to and with the chunk;
the last chunk's are those of the payload.  Neither side holds a record: memory is a few chunks, whatever its length.

Nulls: a null payload is empty; a null url gives no WARC-Target-URI; null ids come after all others
and are written as such.  Rows that repeat the smallest id of their payload are responses, too.  Control characters and
spaces in a url are percent-encoded.  An empty table gives no archive and no rows.  A record that is cut off, or a
header that cannot be read, ends the job with the archive and place.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir, tidy, written
from .hot import join_groups

CHUNK = 64 << 10
ARCHIVE, SEGMENT = 1 << 30, 64 << 20
LEAST = 100  # payload bytes from which a copy becomes a revisit
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
HEADER_BYTES = 1 << 20  # longest header that is read
BLOCK = 256 << 10  # archive bytes read at once
HELD_BYTES, HELD_ROWS = 4 << 20, 4096  # of a batch that a task gives back
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = ("record_id string, chunk int, data binary, bytes_so_far long, digest_so_far string, last boolean, record_type string, "
          "target_uri string, refers_to string, declared_digest string")


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a uri or an absolute path."""
    if "://" not in uri:
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


# --- writing -----------------------------------------------------------------------------------

def records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """Per row of pages (page_id, url, html): page_id, url, payload, size, digest, revisit, refers_to (of revisits)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))
    first = (rows.filter(F.col("size") >= least).groupBy("digest")
             .agg(F.count("*").alias("copies"), F.min("page_id").alias("first")).filter("copies > 1 and first is not null"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return join_groups(rows, first, ["digest"], "copies").select(
        "page_id", "url", "payload", "size", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to"))


def chunk_rows(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The rows of ``records``, each dealt to rows of at most ``chunk`` payload bytes (one without any for revisits)."""
    pieces = F.when(F.col("revisit") | (F.col("size") <= chunk), F.lit(1)).otherwise(F.ceil(F.col("size") / chunk)).cast("int")
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), pieces - 1)))
    data = F.when(~F.col("revisit"), F.substring("payload", F.col("chunk") * chunk + 1, F.lit(chunk)))
    return rows.select("page_id", "url", "size", "digest", "refers_to", "revisit", (F.col("chunk") == pieces - 1).alias("last"),
                       "chunk", data.alias("data"))


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def _head(page_id, url, size: int, digest: str, refers_to, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_name(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response",
             f"Content-Length: {len(http) + (0 if revisit else size)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if revisit:
        lines += [f"WARC-Refers-To: {record_name(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode(errors="replace") + b"\r\n\r\n" + http


class _Archive:
    """An archive being written: bytes so far, and where its last segment began."""

    def __init__(self, folder: str, name: str, level: int):
        self.path, self.level, self.at, self.begun = f"{folder}/{name}", level, 0, 0
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        self.file = system.open_output_stream(f"{path}/{name}", compression=None, buffer_size=1 << 20)
        self.member = None

    def write(self, data) -> None:
        if self.member is None:
            self.member = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        self._put(self.member.compress(data))

    def end_record(self) -> None:
        self.write(b"\r\n\r\n")
        self._put(self.member.flush())
        self.member = None

    def _put(self, packed: bytes) -> None:
        self.file.write(packed)
        self.at += len(packed)


def _archived(folder: str, level: int, archive: int, segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, number, attempt = None, 0, f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"

        def segment_row() -> pa.RecordBatch:
            row = pa.RecordBatch.from_arrays([pa.array([out.path]), pa.array([out.begun], pa.int64()), pa.array([out.at], pa.int64())],
                                             ["path", "start", "stop"])
            out.begun = out.at
            return row

        for b in batches:
            page, url, size, digest, refers, revisit, last, chunk = (b.column(i).to_pylist() for i in range(8))
            data = b.column(8)
            for i in range(b.num_rows):
                if out is None:
                    out, number = _Archive(folder, f"{attempt}-{number:05d}.warc.gz", level), number + 1
                if chunk[i] == 0:
                    out.write(_head(page[i], url[i], size[i], digest[i], refers[i], revisit[i]))
                if not revisit[i]:
                    out.write(data[i].as_buffer())
                if last[i]:
                    out.end_record()
                    if out.at >= archive or out.at - out.begun >= segment:
                        yield segment_row()
                        if out.at >= archive:
                            out.file.close()
                            out = None
        if out is not None:
            out.file.close()
            if out.at > out.begun:
                yield segment_row()
    return run


def write_archives(rows: DataFrame, folder: str, chunk: int = CHUNK, level: int = LEVEL, archive: int = ARCHIVE,
                   segment: int = SEGMENT) -> DataFrame:
    """Writes the rows of ``records`` as archives below ``folder``; the manifest: path, start, stop of segments."""
    return written(chunk_rows(rows, chunk).mapInArrow(tidy(_archived(folder, level, archive, segment)),
                                                      "path string, start long, stop long"), "warc-manifest")


# --- reading -----------------------------------------------------------------------------------

class Stream:
    """The bytes of an archive from ``start``, inflated where they are gzip; never more than a few blocks held."""

    def __init__(self, path: str, start: int):
        self.path = path
        system, plain = opened(path)
        self.file = system.open_input_file(plain)
        self.file.seek(start)
        self.raw, self.read_to, self.held = self.file.read(BLOCK), start, bytearray()
        self.gz = self.raw[:2] == b"\x1f\x8b"
        self.inflate = None

    def place(self) -> int:
        """Archive offset of the first byte not given yet (with gzip: that lies between members)."""
        return self.read_to - (0 if self.gz else len(self.held))

    def _fill(self) -> bool:
        """Reads on, to the end of a member at most; False at the end of the archive."""
        if not self.raw:
            self.raw = self.file.read(BLOCK)
            if not self.raw:
                if self.inflate is not None:
                    raise ValueError(f"{self.path}: a gzip member is cut off")
                return False
        if not self.gz:
            self.held += self.raw
            self.read_to += len(self.raw)
            self.raw = b""
            return True
        if self.inflate is None:
            self.inflate = zlib.decompressobj(31)
        before = len(self.raw)
        self.held += self.inflate.decompress(self.raw, BLOCK)
        ended = self.inflate.eof
        self.raw = self.inflate.unused_data if ended else self.inflate.unconsumed_tail
        self.read_to += before - len(self.raw)
        if ended:
            self.inflate = None
        return True

    def end_record(self) -> None:
        """Skips the line ends that close a record, and with gzip goes to the end of its member if that ends here."""
        while True:
            del self.held[:len(self.held) - len(self.held.lstrip(b"\r\n"))]
            if self.held or (self.gz and self.inflate is None) or not self._fill():
                return

    def ended(self, stop: int | None) -> bool:
        """Whether the segment that ends at ``stop`` ends here."""
        return stop is not None and not (self.gz and (self.held or self.inflate is not None)) and self.place() >= stop

    def head(self) -> list[bytes] | None:
        """The lines of a record's header; None at the end of the archive."""
        while not self.held:
            if not self._fill():
                return None
        return self.block(HEADER_BYTES)[1]

    def block(self, most: int) -> tuple[bytes, list[bytes]]:
        at = 0
        while True:
            end = self.held.find(b"\r\n\r\n", at)
            if end >= 0:
                whole = bytes(self.held[:end + 4])
                del self.held[:end + 4]
                return whole, whole.split(b"\r\n")[:-2]
            at = max(0, len(self.held) - 3)
            if len(self.held) > most or not self._fill():
                raise ValueError(f"{self.path} at {self.place()}: no header ends here")

    def take(self, n: int) -> bytes:
        """Exactly n bytes (a chunk or less)."""
        while len(self.held) < n:
            if not self._fill():
                raise ValueError(f"{self.path}: a record is cut off")
        got = bytes(self.held[:n])
        del self.held[:n]
        return got


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode(errors="replace").partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def record_chunks(path: str, start: int, stop: int | None, chunk: int) -> Iterator[tuple]:
    """Rows of ``CHUNKS`` of the records that begin from ``start`` on and before ``stop``."""
    s = Stream(path, start)
    while not s.ended(stop):
        lines = s.head()
        if lines is None:
            return
        fields = _fields(lines[1:])
        if not lines[0].startswith(b"WARC/") or not fields.get("content-length", "").isdigit():
            raise ValueError(f"{path} at {s.place()}: not a WARC record")
        left = int(fields["content-length"])
        if fields.get("content-type", "").lower().startswith("application/http") and left:
            left -= len(s.block(min(left, HEADER_BYTES))[0])
        digest = fields.get("warc-payload-digest")
        told = (fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
                digest.removeprefix("sha256:") if digest else None)
        number, done, sha = 0, 0, hashlib.sha256()
        while True:
            data = s.take(min(chunk, left))
            left -= len(data)
            done += len(data)
            sha.update(data)
            yield (fields.get("warc-record-id"), number, data, done, sha.hexdigest(), left == 0, *told)
            number += 1
            if not left:
                break
        s.end_record()


_TYPES = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string()]
_NAMES = [c.split()[0] for c in CHUNKS.split(", ")]


def _read(chunk: int):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for path, start, stop in zip(*(c.to_pylist() for c in b.columns)):
                for row in record_chunks(path, start or 0, stop, chunk):
                    rows.append(row)
                    size += len(row[2])
                    if size >= HELD_BYTES or len(rows) >= HELD_ROWS:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)
    return run


def archives(spark: SparkSession, paths: list[str]) -> DataFrame:
    """A manifest of whole archives, for those that another program wrote."""
    return spark.createDataFrame([(p, 0, None) for p in paths], "path string, start long, stop long")


def read_chunks(manifest: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The chunked record table of the segments in ``manifest`` (path, start, stop), dealt evenly to tasks."""
    spread = manifest.select("path", "start", "stop").repartition(
        int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "start")
    return spread.mapInArrow(tidy(_read(chunk)), CHUNKS)


def payloads(chunks: DataFrame) -> DataFrame:
    """Per record: record_id, record_type, refers_to, payload_bytes, payload_digest, intact (as declared in the archive).

    A revisit has the payload of the response that it refers to, found by its record identifier; without one both are null.
    """
    rows = written(chunks.filter("last").drop("data", "chunk", "last", "target_uri"), "warc-records")
    whole = rows.filter("record_type <> 'revisit'").select(
        "record_id", "record_type", "refers_to", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest"),
        "declared_digest")
    again = rows.filter("record_type = 'revisit'").select("record_id", "record_type", "refers_to", "declared_digest")
    named = again.groupBy("refers_to").agg(F.count("*").alias("revisits"))
    target = whole.groupBy("record_id").agg(F.min(F.struct("payload_bytes", "payload_digest")).alias("p"))
    found = named.join(target, F.col("refers_to") == F.col("record_id")).select("refers_to", "revisits", "p.payload_bytes", "p.payload_digest")
    again = join_groups(again, found, ["refers_to"], "revisits")
    return whole.unionByName(again).withColumn(
        "intact", F.coalesce(F.col("payload_digest") == F.col("declared_digest"), F.col("declared_digest").isNull()))


def digest(records: DataFrame) -> DataFrame:
    """Per record of ``payloads``: page_id, payload_bytes, payload_digest, record_type, refers_to as ids, intact."""
    def number(c: str):
        return F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number("refers_to").alias("refers_to"), "intact")


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm/warc-{uuid.uuid4().hex}"
