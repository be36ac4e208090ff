import hashlib
import struct

import pytest
import zstandard
from quarry.llm import common, queries, warc

from conftest import SF

PAGES = "page_id long, url string, html string, digest string, refers_to long"


def expected(rows):
    first = {}
    for page, html in rows:
        if page is not None:
            raw = (html or "").encode()
            first[raw] = min(page, first.get(raw, page))
    for page, html in rows:
        raw = (html or "").encode()
        shared = len(raw) >= 100 and first.get(raw) is not None and page != first[raw]
        yield (page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if shared else "response", first[raw] if shared else None)


def digest_rows(df):
    key = lambda r: repr(r)
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=key)


def test_query_against_plain_version(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    assert digest_rows(queries.op5_warc(spark, SF)) == sorted(expected(pages), key=repr)


def test_odd_pages_round_trip(spark):
    same, other = "é" * 60, "x" * 99
    rows = [(5, "http://a/b c\r\nX: y", same), (3, None, same), (9, "u", same), (9, "u", same), (None, "u", same), (1, "u", other),
            (2, "u", other), (4, "u", None), (6, "u", ""), (None, "u", "n" * 200), (7, "u", "\r\n\r\nWARC/1.1\r\n" * 50)]
    df = spark.createDataFrame([(*r, "own", 1) for r in rows], PAGES).repartition(3)
    records = warc.read_archives(warc.write_archives(df, file_bytes=1500))
    assert digest_rows(records) == sorted(expected([(r[0], r[2]) for r in rows]), key=repr)
    for r in records.where("record_type = 'response'").collect():
        assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest
    assert warc.read_archives(warc.write_archives(df.where("false"))).collect() == []


def archive(tmp_path, n=260):
    writer = warc.ArchiveWriter(str(tmp_path), "a")
    for i in range(n):
        raw = f"<p>{i} page</p>".encode() * (1 + i % 7)
        writer.add(warc.record_bytes(i, f"http://h/{i}", raw, hashlib.sha256(raw).hexdigest(), None))
    writer.close()
    return writer.file.path


def frames(path):
    with common.open_file(path) as source:
        return list(warc.read_frames(source))


def test_each_frame_decodes_by_itself_with_the_dictionary(tmp_path):
    raw = open(archive(tmp_path), "rb").read()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8:8 + size]))
    one = decoder.decompressobj()
    assert warc.parse_record(one.decompress(raw[8 + size:]))["record_id"] == "<urn:page:0>" and one.eof


def test_broken_archives_are_found(tmp_path):
    path = archive(tmp_path)
    raw = open(path, "rb").read()
    assert len(frames(path)) == 260
    for name, bad in (("cut", raw[:-3]), ("magic", b"\x00" + raw[1:]), ("byte", raw[:-40] + bytes([raw[-40] ^ 255]) + raw[-39:])):
        (tmp_path / name).write_bytes(bad)
        with pytest.raises(warc.WarcError):
            for frame in frames(str(tmp_path / name)):
                warc.parse_record(frame)


def test_compressed_dictionary(tmp_path):
    path = archive(tmp_path, 3)
    raw = open(path, "rb").read()
    size = struct.unpack("<I", raw[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(raw[8:8 + size])
    (tmp_path / "packed").write_bytes(struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + raw[8 + size:])
    assert frames(str(tmp_path / "packed")) == frames(path)


@pytest.mark.parametrize("change", [
    (b"WARC/1.1", b"WARK/1.1"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date: ", b"WARC-Type: "), (b"sha256:", b"sha1:"),
    (b"hello", b"hallo"), (b"HTTP/1.1", b"HTTX/1.1"), (b"WARC-Date", b" WARC-Date")])
def test_broken_records_are_found(change):
    raw = warc.record_bytes(1, "u", b"hello", hashlib.sha256(b"hello").hexdigest(), None)
    assert warc.parse_record(raw)["payload"] == b"hello"
    with pytest.raises(warc.WarcError):
        warc.parse_record(raw.replace(*change, 1))
