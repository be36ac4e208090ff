"""WARC archives compressed by Zstandard with a dictionary per file.

A file begins with a skippable frame that holds the dictionary; then comes one
frame per record, each with the dictionary's help decodable by itself.  Records
follow WARC 1.1: a response holds an HTTP head and the payload; a revisit holds
the head only and names the response with the equal payload.
"""

from __future__ import annotations

import hashlib
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import common
from quarry.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
LEAST_SHARED = 100
FILE_BYTES = 64 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 200, 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_BYTES = 64 << 10
MANIFEST = "path string, records long, size long"


class WarcError(ValueError):
    """An archive breaks the format."""


# Records ---------------------------------------------------------------------

def record_id(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str):
    found = re.fullmatch(r"<urn:page:(-?\d*)>", record)
    if not found:
        raise WarcError(f"record id {record!r}")
    return int(found[1]) if found[1] else None


def _field(value: str) -> str:
    """A header value: characters that would break the line are percent-coded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_field(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(raw: bytes, first: str) -> dict[str, str]:
    lines = raw.decode("utf-8", "strict").split("\r\n")
    if not lines[0].startswith(first):
        raise WarcError(f"a record begins with {lines[0][:40]!r}")
    found: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise WarcError(f"header line {line[:80]!r}")
        if name.lower() in found:
            raise WarcError(f"header {name} comes twice")
        found[name.lower()] = value.strip()
    return found


def _length(headers: dict[str, str]) -> int:
    value = headers.get("content-length", "")
    if not value.isascii() or not value.isdigit():
        raise WarcError(f"content length {value!r}")
    return int(value)


def parse_record(raw: bytes) -> dict:
    """One decoded record, after its headers, lengths and digest are tested."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("a record has no end of headers")
    headers = _headers(head, "WARC/1.")
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise WarcError(f"header {name} is missing")
    n = _length(headers)
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise WarcError(f"a block has {len(rest) - 4} bytes, not {n}")
    out = {"record_type": headers["warc-type"], "record_id": headers["warc-record-id"], "url": headers.get("warc-target-uri"),
           "refers_to": None, "payload": None, "payload_bytes": None, "payload_digest": None}
    if out["record_type"] not in ("response", "revisit"):
        return out
    inner, gap, payload = rest[:n].partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("a block has no HTTP head")
    out["payload_bytes"] = _length(_headers(inner, "HTTP/1."))
    kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
    if kind != "sha256" or not re.fullmatch("[0-9a-f]{64}", digest):
        raise WarcError("payload digest is missing")
    out["payload_digest"] = digest
    if out["record_type"] == "revisit":
        if "warc-refers-to" not in headers or payload:
            raise WarcError("a revisit has a payload or names no record")
        out["refers_to"] = headers["warc-refers-to"]
    else:
        if len(payload) != out["payload_bytes"]:
            raise WarcError(f"a payload has {len(payload)} bytes, not {out['payload_bytes']}")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise WarcError("a payload has another digest")
        out["payload"] = payload
    return out


# Files -----------------------------------------------------------------------

def dictionary_for(samples: list[bytes]):
    """A trained dictionary, or the samples' first bytes where too few are there
    to train one."""
    import zstandard as zstd

    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8)
    except zstd.ZstdError:
        raw = b"".join(s[:512] for s in samples)[:DICTIONARY_BYTES]
        return zstd.ZstdCompressionDict(raw, dict_type=zstd.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records into one file; the first ones also train its dictionary."""

    def __init__(self, folder: str, stem: str):
        self.file = common.NewFile(folder, stem, ".warc.zst")
        self.records, self._held, self._held_bytes, self._compressor = 0, [], 0, None

    def add(self, raw: bytes) -> None:
        self.records += 1
        if self._compressor is not None:
            self.file.write(self._compressor.compress(raw))
            return
        self._held.append(raw)
        self._held_bytes += len(raw)
        if len(self._held) >= SAMPLE_RECORDS or self._held_bytes >= SAMPLE_BYTES:
            self._begin()

    def _begin(self) -> None:
        import zstandard as zstd

        dictionary = dictionary_for(self._held)
        raw = dictionary.as_bytes()
        self.file.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self._compressor = zstd.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True)
        for record in self._held:
            self.file.write(self._compressor.compress(record))
        self._held = []

    def close(self) -> None:
        if self._compressor is None:
            self._begin()
        self.file.close()


def read_frames(source):
    """Decoded frames of a file, one after another, in bounded reads."""
    import zstandard as zstd

    def exactly(n):
        got = source.read(n)
        if len(got) != n:
            raise WarcError("an archive is cut short")
        return got

    magic, size = struct.unpack("<II", exactly(8))
    if magic != DICTIONARY_MAGIC:
        raise WarcError("an archive has no dictionary frame")
    raw = exactly(size)
    if raw[:4] == FRAME_MAGIC:
        raw = zstd.ZstdDecompressor().decompress(raw, max_output_size=16 << 20)
    decompressor = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(raw))
    rest = b""
    while True:
        rest = rest or source.read(READ_BYTES)
        if not rest:
            return
        frame, parts = decompressor.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(rest))
            except zstd.ZstdError as error:
                raise WarcError(f"a frame does not decode: {error}") from None
            if frame.eof:
                rest = frame.unused_data
                break
            rest = source.read(READ_BYTES)
            if not rest:
                raise WarcError("the last frame is cut short")
        yield b"".join(parts)


# Operators -------------------------------------------------------------------

def with_references(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """``pages`` (page_id, url, html) with the payload digest and ``refers_to``.

    Rows with equal payloads of ``least`` bytes or more refer to the smallest
    page_id among them; that row itself, and rows that repeat its id, do not.
    Only payloads that come more than once are joined, as digests; a null
    page_id is never the smallest.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    many = rows.where(F.octet_length("html") >= least).groupBy("digest").agg(
        F.count("*").alias("_n"), F.min("page_id").alias("_first"))
    many = common.written(many.where("_n > 1").select(F.col("digest").alias("_d"), "_first"), "warc_shared")
    joined = rows.join(many, rows["digest"] == many["_d"], "left")
    other = ~F.coalesce(F.col("page_id").eqNullSafe(F.col("_first")), F.lit(True))
    return joined.select("page_id", "url", "html", "digest",
                         F.when(F.col("_first").isNotNull() & other, F.col("_first")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes one record per row; returns the manifest (path, records, size).

    A task streams its rows into files of about ``file_bytes``.  A null html is
    an empty payload, a null url is left out, other columns are not read.
    """
    spark = pages.sparkSession
    common.ship(spark)
    folder = folder or scratch_path(spark, "llm/warc")

    def files(batches):
        from pyspark import TaskContext

        stem, writer = f"part-{TaskContext.get().partitionId():06d}", None
        done = []

        def close():
            writer.close()
            done.append((writer.file.path, writer.records, writer.file.size))

        for part in common.slices(batches, "html"):
            for page, url, html, digest, refers in zip(*(part.column(i).to_pylist() for i in range(5))):
                writer = writer or ArchiveWriter(folder, stem)
                writer.add(record_bytes(page, url, html.encode("utf-8"), digest, refers))
                if writer.file.size >= file_bytes:
                    close()
                    writer = None
        if writer is not None:
            close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.int64())], names=["path", "records", "size"])

    return common.written(with_references(pages).mapInArrow(files, MANIFEST), "warc_manifest")


RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string"


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of a manifest's files; a file that breaks the format, or has
    another number of records than the manifest says, fails the job."""
    spark = manifest.sparkSession
    common.ship(spark)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), *[pa.binary()] * with_payload]
    names = [c.split()[0] for c in RECORDS.split(", ")] + ["payload"] * with_payload

    def rows_of(path):
        with common.open_file(path) as source:
            for raw in read_frames(source):
                r = parse_record(raw)
                yield (page_of(r["record_id"]), r["url"], r["record_type"],
                       page_of(r["refers_to"]) if r["refers_to"] else None, r["payload_bytes"], r["payload_digest"],
                       *[r["payload"]] * with_payload)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def records(batches):
        for paths in batches:
            for path, wanted in zip(paths.column(0).to_pylist(), paths.column(1).to_pylist()):
                rows, size, n = [], 0, 0
                for row in rows_of(path):
                    rows.append(row)
                    n += 1
                    size += len(row[-1] or b"") if with_payload else 0
                    if len(rows) >= 2000 or size > 4 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)
                if n != wanted:
                    raise WarcError(f"{path} has {n} records, not {wanted}")

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "records").repartition(n).mapInArrow(
        records, RECORDS + (", payload binary" if with_payload else ""))
