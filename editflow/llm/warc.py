"""Web archives compressed with Zstandard: writer and reader.

An archive begins with a skippable frame that holds the dictionary, followed by one
frame per record. A record has a header (version line, named fields, an empty line), a
block of Content-Length bytes, and two line ends. Archives are binary values of bounded
size, so Spark's own writers and readers move them; `open_archives` reads files.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editflow.llm.tables import sampled, stored

VERSION = b"WARC/1.1"
# A skippable frame with this number holds the dictionary, itself compressed or not.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
DICTIONARY_BYTES = 32 << 10
# The dictionary is trained on at most this many pages, chosen by a hash.
SAMPLE_PAGES = 400
SAMPLE_BYTES = 8 << 10
# An archive is closed beyond this many bytes; a larger record makes a larger archive.
ARCHIVE_BYTES = 8 << 20
# Equal payloads of at least this many bytes are stored once.
LEAST_REVISIT = 100
DATE = "2000-01-01T00:00:00Z"

_END = b"\r\n"
_ARCHIVE = "archive string, data binary"
_RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string, payload binary"
)
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


class BadRecord(ValueError):
    """A frame, header or length that doesn't hold."""


def planned(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """pages (page_id, url, html) as page_id, url, payload, digest, record_type, refers_to.

    Of equal payloads of at least `least` bytes, the one with the smallest page_id is the
    response; a repeated row of that id is a response, too. Null html is an empty payload.
    Pages without an id come last; if a payload has no other page, all are responses.
    Other columns are ignored.
    """
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    long_enough = F.octet_length("payload") >= least
    # The digests alone, without the payloads, find the first page of each payload.
    first = rows.where(long_enough).groupBy("digest").agg(
        F.min("page_id").alias("_first"), F.count("*").alias("_pages")
    )
    first = first.where("_pages > 1 and _first is not null").drop("_pages")
    later = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return rows.join(first, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(later, "revisit").otherwise("response").alias("record_type"),
        F.when(later, F.col("_first")).alias("refers_to"),
    )


def dictionary(pages: DataFrame, size: int = DICTIONARY_BYTES) -> bytes:
    """Trained on the beginnings of a bounded sample of pages; empty if there is too little text."""
    chosen = pages.where("html is not null").select(
        "page_id", "url", F.substring("html", 1, SAMPLE_BYTES).alias("html")
    )
    found = sampled(chosen, ["page_id", "url"], SAMPLE_PAGES, "sample")
    samples = [r["html"].encode() for r in found]
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _fields(pairs: list[tuple[str, str]]) -> bytes:
    lines = [VERSION, *(f"{name}: {value}".encode() for name, value in pairs)]
    return _END.join(lines) + _END + _END


def _identity(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page} {digest}')}>"


def _target(url: str | None, page: int | None) -> str:
    """One line without blanks at the ends; a page without an address is named by its id."""
    return re.sub(r"[\x00-\x20\x7f]+", "%20", url.strip()) if url and url.strip() else f"urn:page:{page}"


def record(
    page: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None
) -> bytes:
    """A response with its payload, or a revisit that refers to the response of the same payload."""
    head = b"HTTP/1.1 200 OK" + _END + b"Content-Type: text/html; charset=utf-8" + _END + _END
    block = head + payload if kind == "response" else head
    pairs = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _identity(page, digest)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _target(url, page)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page is not None:
        pairs.append(("X-Page-ID", str(page)))
    if kind == "revisit":
        pairs.append(("WARC-Refers-To", _identity(refers_to, digest)))
        pairs.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        pairs.append(("X-Refers-To-Page-ID", str(refers_to)))
    pairs.append(("Content-Length", str(len(block))))
    return _fields(pairs) + block + _END + _END


def write_archives(plan: DataFrame, words: bytes, most: int = ARCHIVE_BYTES) -> DataFrame:
    """archive, data: the records of each task in archives of bounded size."""
    return plan.mapInArrow(partial(_write, words=words, most=most), _ARCHIVE)


def archive_start(words: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(words)) + words


def _write(batches: Iterable[pa.RecordBatch], words: bytes, most: int) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(
        level=6, dict_data=zstandard.ZstdCompressionDict(words) if words else None, write_checksum=True
    )
    frames: list[bytes] = [archive_start(words)]
    size, name = 0, ""

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([f"{name}.warc.zst"]), pa.array([b"".join(frames)], pa.binary())], ["archive", "data"]
        )

    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(c)) for c in
                   ("page_id", "url", "payload", "digest", "record_type", "refers_to")]
        for row in range(batch.num_rows):
            values = [c[row].as_py() for c in columns]
            name = name or hashlib.sha256(f"{values[0]} {values[3]}".encode()).hexdigest()[:16]
            frames.append(press.compress(record(*values)))
            size += len(frames[-1])
            if size >= most:
                yield out()
                frames, size, name = [archive_start(words)], 0, ""
    if size:
        yield out()


def frames_of(data: bytes) -> tuple[bytes, Iterator[tuple[int, int]]]:
    """The dictionary of an archive, and begin and end of each frame after it."""
    if len(data) < 8:
        raise BadRecord("no leading skippable frame")
    number, size = struct.unpack_from("<II", data)
    if number != DICTIONARY_FRAME or 8 + size > len(data):
        raise BadRecord("no leading skippable frame with a dictionary")
    words = data[8 : 8 + size]
    if len(words) >= 4 and struct.unpack_from("<I", words)[0] == FRAME:
        words = zstandard.ZstdDecompressor().decompress(words, max_output_size=1 << 27)
    return words, _frames(data, 8 + size)


def _frames(data: bytes, at: int) -> Iterator[tuple[int, int]]:
    """Frame ends from the sizes of their blocks, without decoding them."""
    view = memoryview(data)
    while at < len(data):
        begin = at
        try:
            (number,) = struct.unpack_from("<I", view, at)
            if 0x184D2A50 <= number <= 0x184D2A5F:
                at += 8 + struct.unpack_from("<I", view, at + 4)[0]
                continue
            if number != FRAME:
                raise BadRecord(f"no frame at byte {at}")
            described = zstandard.get_frame_parameters(bytes(view[at : at + 18]))
            at += zstandard.frame_header_size(bytes(view[at : at + 18]))
            last = 0
            while not last:
                block = int.from_bytes(view[at : at + 3], "little")
                last, kind, size = block & 1, (block >> 1) & 3, block >> 3
                at += 3 + (1 if kind == 1 else size)
                if kind == 3 or at > len(data):
                    raise BadRecord(f"cut or bad block in the frame at byte {begin}")
            at += 4 * described.has_checksum
        except (struct.error, zstandard.ZstdError) as error:
            raise BadRecord(f"bad frame at byte {begin}: {error}") from error
        if at > len(data):
            raise BadRecord(f"cut frame at byte {begin}")
        yield begin, at


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of one record, whose lengths are checked."""
    head, gap, rest = raw.partition(_END + _END)
    lines = head.split(_END)
    if not gap or lines[0] != VERSION:
        raise BadRecord("no version line or no end of the header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name or name != name.strip():
            raise BadRecord(f"bad field {line[:40]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise BadRecord(f"no field {name}")
    length = fields["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != _END + _END:
        raise BadRecord("Content-Length doesn't hold")
    block = rest[:-4]
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise BadRecord("the block has another digest")
    return fields, block


def read_record(raw: bytes) -> tuple:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to, record_id, payload."""
    fields, block = parse(raw)
    _, gap, payload = block.partition(_END + _END)
    kind = fields["warc-type"]
    if kind not in ("response", "revisit") or not gap:
        raise BadRecord(f"no {kind} of a page")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    size = int(fields.get("x-payload-length", len(payload)))
    if kind == "response" and (size != len(payload) or digest != hashlib.sha256(payload).hexdigest()):
        raise BadRecord("the payload has another length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise BadRecord("a revisit with a payload, or that refers to nothing")
    number = [int(x) if (x := fields.get(f)) is not None else None for f in ("x-page-id", "x-refers-to-page-id")]
    url = fields.get("warc-target-uri")
    return number[0], url, size, digest, kind, number[1], fields["warc-record-id"], payload if kind == "response" else None


def open_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive files below a path as archive, data."""
    return spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("archive"), F.col("content").alias("data")
    )


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to,
    record_id, payload (null for revisits, or if not wanted).

    Frames are decoded one by one with the archive's own dictionary. A bad frame, header,
    length or digest fails the job with the archive's name: nothing is skipped.
    """
    return archives.mapInArrow(partial(_read, payloads=payloads), _RECORD)


def _read(batches: Iterable[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _RECORD.split(", ")]
    for batch in batches:
        for row in range(batch.num_rows):
            name, data = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
            rows: list[tuple] = []
            held = 0
            try:
                words, frames = frames_of(data)
                press = zstandard.ZstdDecompressor(zstandard.ZstdCompressionDict(words) if words else None)
                for begin, end in frames:
                    found = read_record(press.decompress(data[begin:end]))
                    rows.append(found if payloads else (*found[:-1], None))
                    held += found[2] if payloads else 64
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            except (BadRecord, zstandard.ZstdError) as error:
                raise BadRecord(f"{name}: {error}") from error
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def archived(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back."""
    archives = stored(write_archives(planned(pages), dictionary(pages)), "archives")
    return read_archives(archives, payloads)
