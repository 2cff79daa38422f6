"""WARC archives compressed with Zstandard and a dictionary, written and read.

An archive starts with a skippable frame that holds the dictionary; then comes
one frame for each record. Reading loads the dictionary, decodes frame by frame
with bounded memory, and checks every record: the version line, the fields a
record must have, the block's length, the closing blank lines and the digests.

Of pages with equal payloads one is stored as ``response``; the others are
``revisit`` records that refer to it and carry the HTTP header only.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.arrow import column
from tickloom.llm.tables import partitions, written
from tickloom.session import scratch_dir

# Fixed values of the format: magic numbers of Zstandard frames, and WARC's own words.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_MAGIC = range(0x184D2A50, 0x184D2A60)
ZSTD_MAGIC = 0xFD2FB528
VERSIONS = ("WARC/1.0", "WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

# The dictionary is trained on the first payloads of an archive, this many bytes and payloads at most.
SAMPLE_BYTES = 4 << 20
SAMPLE_PAYLOADS = 400
DICTIONARY_BYTES = 64 << 10
# An archive is closed when it has this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
LEVEL = 3


class Page(NamedTuple):
    page_id: int | None
    copy: int  # 0 but for repeated rows of one page_id and payload
    url: str | None
    payload: bytes
    response: bool
    refers_to: int | None


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(page_id: int | None, copy: int = 0) -> str:
    name = "" if page_id is None else str(page_id)
    return f"<urn:page:{name}.{copy}>" if copy else f"<urn:page:{name}>"


def _page_id(uri: str) -> int | None:
    if not (uri.startswith("<urn:page:") and uri.endswith(">")):
        raise ValueError(f"not a record of a page: {uri}")
    name = uri[10:-1].split(".")[0]
    return int(name) if name else None


def _target(url: str | None) -> str:
    """The URL without what would end or break a header line."""
    return "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "about:blank")


def record(page: Page) -> bytes:
    """The record of a page, header and block."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page.payload)}\r\n\r\n".encode()
    block = http + page.payload if page.response else http
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if page.response else 'revisit'}",
        f"WARC-Record-ID: {_uri(page.page_id, page.copy)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_target(page.url)}",
        f"WARC-Payload-Digest: sha1:{digest(page.payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if not page.response:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_uri(page.refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(sample: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the sample; raw content if the sample is too small or too uniform to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except zstandard.ZstdError:
        content = b"".join(sample)[:DICTIONARY_BYTES] or b"HTTP/1.1 200 OK\r\nContent-Type: text/html"
        return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(out: BinaryIO, pages: Iterator[Page], most: int = ARCHIVE_BYTES) -> tuple[int, int]:
    """One archive from the next pages; returns its records and bytes. Ends with the pages or at ``most`` bytes."""
    held, size = [], 0
    for page in pages:
        held.append(page)
        size += len(page.payload)
        if size >= SAMPLE_BYTES or len(held) >= SAMPLE_PAYLOADS:
            break
    trained = _dictionary([record(page)[:65_536] for page in held])
    content = trained.as_bytes()
    out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    records, written_bytes = 0, len(content) + 8

    def put(page: Page) -> None:
        nonlocal records, written_bytes
        frame = compressor.compress(record(page))
        out.write(frame)
        records += 1
        written_bytes += len(frame)

    for page in held:
        put(page)
    while written_bytes < most and (page := next(pages, None)) is not None:
        put(page)
    return records, written_bytes


def _load_dictionary(source: BinaryIO) -> zstandard.ZstdCompressionDict:
    head = source.read(8)
    if len(head) < 8:
        raise ValueError("the archive ends before its dictionary")
    magic, size = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise ValueError(f"the archive does not start with a dictionary frame but with {magic:#x}")
    content = source.read(size)
    if len(content) != size:
        raise ValueError("the dictionary is cut off")
    if size >= 4 and struct.unpack("<I", content[:4])[0] == ZSTD_MAGIC:
        content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
    return zstandard.ZstdCompressionDict(content)


def frames(source: BinaryIO) -> Iterator[bytes]:
    """The content of each data frame after the dictionary; other skippable frames are passed over."""
    decompressor = zstandard.ZstdDecompressor(dict_data=_load_dictionary(source))
    rest = source.read(CHUNK)
    while rest:
        while len(rest) < 8 and (more := source.read(CHUNK)):
            rest += more
        if len(rest) < 8:
            raise ValueError("bytes after the last frame")
        magic, size = struct.unpack("<II", rest[:8])
        if magic in SKIPPABLE_MAGIC:
            while len(rest) < 8 + size:
                if not (more := source.read(CHUNK)):
                    raise ValueError("a skippable frame is cut off")
                rest += more
            rest = rest[8 + size :] or source.read(CHUNK)
            continue
        frame = decompressor.decompressobj()
        parts = [frame.decompress(rest)]
        while not frame.eof:
            if not (more := source.read(CHUNK)):
                raise ValueError("a frame is cut off")
            parts.append(frame.decompress(more))
        rest = frame.unused_data or source.read(CHUNK)
        yield b"".join(parts)


def header_and_block(content: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields and the block of the one record in a frame, of any type; ``ValueError`` says what is wrong with it."""
    head, gap, body = content.partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("a record has no end of header")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version not in VERSIONS:
        raise ValueError(f"a record starts with {version[:40]!r}")
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"no header line: {line[:80]!r}")
        fields[name.strip().lower()] = value.strip()
    for name in REQUIRED:
        if name not in fields:
            raise ValueError(f"a record has no {name}")
    if not fields["content-length"].isdecimal():
        raise ValueError(f"Content-Length is {fields['content-length']!r}")
    length = int(fields["content-length"])
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError(f"a block has {len(body) - 4} bytes, its header says {length}")
    block = body[:length]
    if fields.get("warc-block-digest", "") not in ("", f"sha1:{digest(block)}"):
        raise ValueError(f"block digest of {fields['warc-record-id']} differs")
    return fields, block


def parse(content: bytes) -> dict:
    """The fields of a page's record; ``ValueError`` says what is wrong with it."""
    fields, block = header_and_block(content)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        raise ValueError(f"unexpected record type {kind!r}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    if not gap or not http.startswith(b"HTTP/"):
        raise ValueError(f"{fields['warc-record-id']} holds no HTTP message")
    said = [line.split(b":", 1)[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    size = int(said[0]) if said else len(payload)
    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and (size != len(payload) or declared != digest(payload)):
        raise ValueError(f"payload of {fields['warc-record-id']} differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError(f"{fields['warc-record-id']} is no valid revisit")
    return {
        "page_id": _page_id(fields["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": declared,
        "record_type": kind,
        "refers_to": _page_id(fields["warc-refers-to"]) if kind == "revisit" else None,
        "target_uri": fields.get("warc-target-uri"),
        "payload": payload if kind == "response" else None,
    }


def _plan(pages: DataFrame) -> DataFrame:
    """``page_id, payload, keeper, shared``: for payloads that several rows have, the page that keeps it.

    Only ids and digests are grouped and joined; a payload that a third of all
    pages share is combined before the shuffle.
    """
    ids = pages.select("page_id", F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("payload"))
    keepers = ids.groupBy("payload").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1").drop("n")
    return ids.join(keepers, "payload").select("page_id", "keeper", "payload").distinct()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages as they travel to the task that writes them: the payload compressed, and its digest."""
    compressor = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        payloads = column(batch, "html").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                column(batch, "page_id"),
                column(batch, "url"),
                pa.array([compressor.compress(payload) for payload in payloads], pa.binary()),
                pa.array([hashlib.sha256(payload).hexdigest() for payload in payloads], pa.string()),
            ],
            ["page_id", "url", "html", "payload"],
        )


def write_archives(pages: DataFrame, folder: str, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all pages under ``folder``; returns the list of archives, ``path, records, bytes``.

    A task closes an archive at ``most`` compressed bytes and goes on with the next one.

    A task gives each archive a name of its own, so a task that is run again leaves
    a file that no list names. The list is written as a table in the same folder.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html")
    ).mapInArrow(_packed, "page_id bigint, url string, html binary, payload string")
    plan = _plan(pages.select(F.col("page_id").cast("bigint").alias("page_id"), "html")).withColumnRenamed("page_id", "_page").withColumnRenamed("payload", "_payload")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("payload") == F.col("_payload"))
    planned = rows.join(plan, same, "left")
    key = F.coalesce("page_id", F.lit(-(2**63)))
    sorted_rows = planned.withColumn("_shared", F.col("_payload").isNotNull()).select("page_id", "url", "html", "payload", "keeper", "_shared")
    placed = sorted_rows.repartition(partitions(pages.sparkSession), key).sortWithinPartitions("page_id", "payload", "url")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[Page]:
        last, copy = None, 0
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in ("page_id", "payload", "url", "html", "keeper", "_shared")), strict=True):
                page_id, payload, url, html, keeper, shared = row
                copy = copy + 1 if last == (page_id, payload) else 0
                last = (page_id, payload)
                response = not shared or (keeper == page_id and copy == 0)
                yield Page(page_id, copy, url, unpack(html), response, None if response else keeper)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = each(batches)
        while (page := next(left, None)) is not None:
            store, root = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
            store.create_dir(root, recursive=True)
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            # No generator may stand between: when an archive is full it would be closed, and close ``left`` with it.
            following = itertools.chain([page], left)
            # The name's ending must not make the store compress the archive once more.
            with store.open_output_stream(path, compression=None) as out:
                records, size = write_archive(out, following, most)
            name = f"{folder.rstrip('/')}/{path.rsplit('/', 1)[1]}"
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return written(placed.mapInArrow(run, "path string, records bigint, bytes bigint"), "warc-list")


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """The records of archives named in the column ``path``; a malformed record ends the job with what is wrong.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to``,
    with ``payloads`` also ``target_uri`` and the ``payload`` of responses.
    """
    numbers = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}
    if payloads:
        numbers |= {"target_uri": pa.string(), "payload": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in column(batch, "path").to_pylist():
                store, name = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
                held, size = [], 0
                with store.open_input_stream(name, compression=None) as source:
                    for content in frames(source):
                        held.append(parse(content))
                        size += len(content) if payloads else 256
                        if size >= CHUNK:
                            yield pa.RecordBatch.from_pylist(held, pa.schema(numbers.items()))
                            held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, pa.schema(numbers.items()))

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    schema += ", target_uri string, payload binary" if payloads else ""
    return archives.select("path").repartition(partitions(archives.sparkSession)).mapInArrow(run, schema)


RECORD_SCHEMA = (
    "path string, number bigint, record_type string, record_id string, refers_to string, target_uri string, record_date string, "
    "content_type string, payload_digest string, block_bytes bigint, block binary, reason string"
)


def _any_record(path: str, number: int, content: bytes) -> dict:
    try:
        fields, block = header_and_block(content)
    except (ValueError, UnicodeDecodeError) as error:
        return {"path": path, "number": number, "reason": str(error)}
    named = {
        "record_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to", "target_uri": "warc-target-uri",
        "record_date": "warc-date", "content_type": "content-type", "payload_digest": "warc-payload-digest",
    }
    return {"path": path, "number": number, "block_bytes": len(block), "block": block} | {ours: fields.get(theirs) for ours, theirs in named.items()}


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of archives that anyone wrote, named in the column ``path``: all types, ids as text.

    A damaged record is a row with ``reason`` and ``number``, its place in the archive.
    Behind a damaged frame the rest of the archive cannot be found; that is one row with a reason too.
    """
    schema = {"path": pa.string(), "number": pa.int64()} | {
        name: pa.string() for name in ("record_type", "record_id", "refers_to", "target_uri", "record_date", "content_type", "payload_digest")
    }
    schema = pa.schema([*schema.items(), ("block_bytes", pa.int64()), ("block", pa.binary()), ("reason", pa.string())])

    def records(path: str) -> Iterator[dict]:
        store, name = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        number = 0
        with store.open_input_stream(name, compression=None) as source:
            try:
                for content in frames(source):
                    yield _any_record(path, number, content)
                    number += 1
            except (ValueError, zstandard.ZstdError) as error:
                yield {"path": path, "number": number, "reason": str(error)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in column(batch, "path").to_pylist():
                held, size = [], 0
                for row in records(path):
                    held.append(row)
                    size += 256 + row.get("block_bytes", 0)
                    if size >= CHUNK:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    return archives.select("path").repartition(partitions(archives.sparkSession)).mapInArrow(run, RECORD_SCHEMA)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """All pages written as archives into the shared folder and read back.

    Defined cases: a null ``html`` is an empty payload; equal payloads, the empty
    one too, are stored once, by the largest ``page_id``; rows equal in ``page_id``
    and payload are a record and its revisits; a null ``page_id`` counts as
    smallest and stays null; a null ``url`` becomes ``about:blank``; other
    characters than printable ASCII in it are percent-encoded; further columns
    are ignored; an empty table writes no archive.
    """
    return read_archives(write_archives(pages, scratch_dir(spark, "warc")))
