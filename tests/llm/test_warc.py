import io
import struct

import pytest
import zstandard

from tickloom.llm.warc import Page, digest, frames, parse, read_archives, read_records, record, round_trip, write_archive, write_archives

SCHEMA = "page_id bigint, url string, html string, record_type string"


def archive(pages):
    out = io.BytesIO()
    write_archive(out, iter(pages))
    return out.getvalue()


def test_an_archive_reads_back():
    pages = [Page(i, 0, f"http://x/{i}", f"<html>{i}</html>".encode() * (i + 1), True, None) for i in range(30)]
    raw = archive(pages)
    assert struct.unpack("<I", raw[:4])[0] == 0x184D2A5D
    back = [parse(content) for content in frames(io.BytesIO(raw))]
    assert [(r["page_id"], r["payload"], r["target_uri"]) for r in back] == [(p.page_id, p.payload, p.url) for p in pages]
    # Each record is a frame of its own, and other skippable frames are passed over.
    size = struct.unpack("<I", raw[4:8])[0] + 8
    more = raw[:size] + struct.pack("<II", 0x184D2A50, 3) + b"abc" + raw[size:]
    assert len(list(frames(io.BytesIO(more)))) == 30


def test_a_compressed_dictionary_is_read():
    raw = archive([Page(1, 0, None, b"payload", True, None)])
    size = struct.unpack("<I", raw[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(raw[8 : 8 + size])
    again = struct.pack("<II", 0x184D2A5D, len(packed)) + packed + raw[8 + size :]
    assert [parse(c)["payload"] for c in frames(io.BytesIO(again))] == [b"payload"]


def test_damage_is_found():
    raw = archive([Page(1, 0, "u", b"payload", True, None)])
    for bad in (b"", raw[:5], raw[:20], raw[:-3], raw[4:], raw + b"xx"):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(frames(io.BytesIO(bad)))
    good = record(Page(1, 0, "u", b"payload", True, None))
    parse(good)
    for old, new in ((b"WARC/1.1", b"WARK/1.1"), (b"payload", b"pailoat"), (b"WARC-Date", b"WARC-Data"), (b"\r\n\r\n", b"\r\n"),
                     (b"Content-Length: ", b"Content-Length: 1"), (b"Type: response", b"Type: other"), (b"<urn:page:1>", b"<urn:x:1>")):
        with pytest.raises(ValueError):
            parse(good.replace(old, new))
    with pytest.raises(ValueError):
        parse(good + b"more")


def test_rows(spark):
    rows = [(1, "http://a", "same", "x"), (2, None, "same", "x"), (3, "a b\r\né", "other", "x"), (4, "u", None, "x"), (5, "u", "", "x"),
            (None, "u", "same", "x"), (3, "a", "other", "x"), (6, "u", "long" * 50_000, "x")]
    got = sorted(map(tuple, round_trip(spark, spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    expected = [(1, "same", "revisit", 2), (2, "same", "response", None), (3, "other", "response", None), (3, "other", "revisit", 3),
                (4, "", "revisit", 5), (5, "", "response", None), (None, "same", "revisit", 2), (6, "long" * 50_000, "response", None)]
    assert got == sorted(((i, len(t), digest(t.encode()), kind, to) for i, t, kind, to in expected), key=str)
    assert round_trip(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_come_back(spark, small, tmp_path):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    stored = read_archives(write_archives(pages, str(tmp_path / "warc")), payloads=True)
    joined = stored.where("record_type = 'response'").join(pages, "page_id")
    assert joined.where("decode(payload, 'utf-8') <> html").count() == 0 and joined.count() > 0


def test_a_task_goes_on_after_a_full_archive(spark, tmp_path):
    rows = [(i, "u", f"{digest(str(i).encode())} page {i}", "x") for i in range(4000)]  # a thousand a task, 400 of them train a dictionary
    archives = write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), str(tmp_path / "warc"), most=4000)
    back = read_archives(archives, payloads=True)
    assert sorted((r.page_id, r.payload.decode()) for r in back.collect()) == [(i, html) for i, _, html, _ in rows]
    # Four tasks, and more archives than that; their list tells all records.
    assert archives.count() > 4 and archives.agg({"records": "sum"}).first()[0] == len(rows)


def foreign(kind, name, block, **more):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 2024-01-01T00:00:00Z", f"Content-Length: {len(block)}"]
    lines += [f"{field}: {value}" for field, value in more.items()]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_records_of_other_archives(spark, tmp_path):
    """All types, foreign ids, damaged records and frames; what can be read is read."""
    trained = zstandard.ZstdCompressionDict(b"WARC/1.1 WARC-Type WARC-Record-ID" * 30, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    pack = zstandard.ZstdCompressor(dict_data=trained).compress
    head = struct.pack("<II", 0x184D2A5D, len(trained.as_bytes())) + trained.as_bytes()
    good = [
        foreign("warcinfo", "0", b"software: x", **{"Content-Type": "application/warc-fields"}),
        foreign("request", "1", b"GET / HTTP/1.1\r\n\r\n"),
        foreign("response", "2", b"not http", **{"WARC-Target-URI": "http://a/"}),
        foreign("revisit", "3", b"", **{"WARC-Refers-To": "<urn:uuid:2>"}),
    ]
    damaged = [b"no header", foreign("conversion", "4", b"abc").replace(b"Content-Length: 3", b"Content-Length: 9"), foreign("metadata", "5", b"", **{"WARC-Block-Digest": "sha1:X"})]
    whole, cut, other = tmp_path / "whole.warc.zst", tmp_path / "cut.warc.zst", tmp_path / "other.warc.zst"
    whole.write_bytes(head + b"".join(map(pack, [*good[:2], *damaged, *good[2:]])))
    cut.write_bytes(head + pack(good[0]) + pack(good[2])[:-5])
    other.write_bytes(b"\x1f\x8b gzip of another kind")
    paths = spark.createDataFrame([(str(p),) for p in (whole, cut, other)], "path string")
    rows = sorted(read_records(paths).collect(), key=lambda r: (r.path, r.number))
    found = {p.name: [(r.number, r.record_type, r.record_id, bool(r.reason)) for r in rows if r.path == str(p)] for p in (whole, cut, other)}
    assert found["whole.warc.zst"] == [
        (0, "warcinfo", "<urn:uuid:0>", False), (1, "request", "<urn:uuid:1>", False), (2, None, None, True), (3, None, None, True),
        (4, None, None, True), (5, "response", "<urn:uuid:2>", False), (6, "revisit", "<urn:uuid:3>", False),
    ]
    assert [(n, bool(why)) for n, _, _, why in found["cut.warc.zst"]] == [(0, False), (1, True)]
    assert found["other.warc.zst"] == [(0, None, None, True)]
    last = rows[-1]
    assert (last.refers_to, last.block_bytes, bytes(last.block)) == ("<urn:uuid:2>", 0, b"")
    assert [r.target_uri for r in rows if r.record_type == "response"][-1] == "http://a/"


def test_archives_lie_in_their_format(spark, tmp_path):
    """The file itself starts with the dictionary's frame, and plain tools read it."""
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>" * 50, "") for i in range(20)], SCHEMA)
    listed = write_archives(pages, str(tmp_path)).collect()
    assert listed and sum(r.records for r in listed) == 20
    for r in listed:
        raw = (tmp_path / r.path.rsplit("/", 1)[1]).read_bytes()
        assert struct.unpack("<I", raw[:4])[0] == 0x184D2A5D and len(raw) == r.bytes
        assert len(list(frames(io.BytesIO(raw)))) == r.records
    assert {r.record_type for r in read_records(spark.createDataFrame([(r.path,) for r in listed], "path string")).collect()} == {"response"}
