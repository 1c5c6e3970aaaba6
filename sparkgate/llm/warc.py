"""WARC archives compressed with Zstandard: written and read back by Spark.

An archive is a skippable frame with a dictionary, then one frame per record. Spark's text sink
writes the frames as they are; its line separator is an empty skippable frame, which readers pass
over. So files are committed like any others Spark writes, on any file system, and are valid
archives as well.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import from_arrow_schema

from sparkgate.llm.tables import narrow_enough, repeated_groups, salt, stage

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
EMPTY_FRAME = struct.pack("<II", SKIPPABLE_FIRST, 0).decode("ascii")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
LEVEL = 3
# An archive's dictionary comes from its first payloads, up to so many bytes of them.
SAMPLE_BYTES = 400_000
DICTIONARY_BYTES = 16_384
# Fewer payloads than this make no dictionary; the archive then begins with an empty one.
LEAST_SAMPLES = 16

_FRAMES = pa.schema([("frame", pa.binary())])
_RECORDS = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("problem", pa.string()),
    ]
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def page_urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{page_urn(page_id)}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", "".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{page_urn(refers_to)}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


def trained(samples: list[bytes]) -> bytes:
    """A dictionary for payloads like these; empty if they are too few or too plain."""
    if len(samples) < LEAST_SAMPLES:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _archive(rows: Iterator[tuple]) -> Iterator[bytes]:
    """Frames of one archive; the first rows wait until the dictionary is made."""
    held, size, compressor = [], 0, None

    def start() -> Iterator[bytes]:
        nonlocal compressor
        content = trained([row[2] for row in held])
        # The whole record goes through one compressor per archive, a frame each.
        options = {"dict_data": zstandard.ZstdCompressionDict(content)} if content else {}
        compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **options)
        yield skippable(DICTIONARY_MAGIC, content)
        for row in held:
            yield compressor.compress(record(*row))

    for row in rows:
        if compressor is not None:
            yield compressor.compress(record(*row))
            continue
        held.append(row)
        size += len(row[2])
        if size >= SAMPLE_BYTES:
            yield from start()
            held = []
    if held:
        yield from start()


def write_archives(pages: DataFrame, location: str) -> None:
    """Archive pages (page_id, url, payload as binary, refers_to), a file per task.

    Null payloads are empty; a row with refers_to becomes a revisit. Urls lose their white space,
    which a header line cannot hold. Partition pages so that a file fits a task's memory.
    """

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (page_id, url, payload or b"", refers_to)
            for batch in batches
            for page_id, url, payload, refers_to in zip(*(batch[n].to_pylist() for n in ("page_id", "url", "payload", "refers_to")))
        )
        out, size = [], 0
        for frame in _archive(rows):
            out.append(frame)
            size += len(frame)
            if size >= 4 << 20:
                yield pa.record_batch([pa.array(out, pa.binary())], schema=_FRAMES)
                out, size = [], 0
        if out:
            yield pa.record_batch([pa.array(out, pa.binary())], schema=_FRAMES)

    (
        pages.select("page_id", "url", "payload", "refers_to")
        .mapInArrow(frames, from_arrow_schema(_FRAMES))
        .select(F.col("frame").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_FRAME)
        .text(location)
    )


def frame_end(data: memoryview, at: int) -> int:
    """Where the compressed frame that starts at that place ends."""
    parameters = zstandard.get_frame_parameters(data[at : at + 18])
    end = at + zstandard.frame_header_size(data[at : at + 18])
    last = False
    while not last:
        if end + 3 > len(data):
            raise ValueError("a frame is cut short")
        head = int.from_bytes(data[end : end + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        end += 3 + (1 if kind == 1 else size)
    end += 4 * parameters.has_checksum
    if end > len(data):
        raise ValueError("a frame is cut short")
    return end


def records_of(archive: bytes) -> Iterator[bytes]:
    """Decoded records of an archive. Raises ValueError or ZstdError where it is damaged."""
    data, at, first, decoder = memoryview(archive), 0, True, None
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError("a frame is cut short")
        magic, size = struct.unpack_from("<II", data, at)
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            if at + 8 + size > len(data):
                raise ValueError("a frame is cut short")
            if first and magic == DICTIONARY_MAGIC and size:
                content = bytes(data[at + 8 : at + 8 + size])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    content = zstandard.ZstdDecompressor().decompress(content)
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
            at += 8 + size
        elif magic == FRAME_MAGIC:
            end = frame_end(data, at)
            decoder = decoder or zstandard.ZstdDecompressor()
            # Frames without a stated content size need a streaming decoder.
            yield decoder.decompressobj().decompress(data[at:end])
            at = end
        else:
            raise ValueError("neither a frame nor a skippable frame")
        first = False


def parsed(raw: bytes) -> tuple:
    """A row of _RECORDS from a record's bytes. What is wrong with it is told under problem."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:])}

    def number(name: str) -> int | None:
        found = fields.get(name, "").strip("<>").removeprefix("urn:page:")
        return int(found) if found.lstrip("-").isdigit() else None

    kind, length = fields.get("warc-type"), number("content-length")
    block = rest[:length] if length is not None else b""
    http, _, body = block.partition(b"\r\n\r\n")
    stated = [line.partition(b":")[2] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
    n_bytes = int(stated[0]) if stated and stated[0].strip().isdigit() else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    checks = [
        (lines[0] in ("WARC/1.0", "WARC/1.1") and bool(gap), "no WARC version line"),
        (all(fields.get(n) for n in ("warc-record-id", "warc-date")), "a mandatory field is missing"),
        (kind in ("response", "revisit"), "unknown record type"),
        (length is not None and rest[length:] == b"\r\n\r\n", "its length is wrong"),
        (fields.get("warc-block-digest") in (None, f"sha1:{base32_sha1(block)}"), "its block digest is wrong"),
        (n_bytes is not None, "no payload length"),
        (kind != "response" or n_bytes == len(body), "its payload length is wrong"),
        (kind != "response" or digest == base32_sha1(body), "its payload digest is wrong"),
        (kind != "revisit" or number("warc-refers-to") is not None, "a revisit refers to nothing"),
    ]
    problem = next((text for good, text in checks if not good), None)
    return (
        number("warc-record-id"), fields.get("warc-target-uri"), kind, number("warc-refers-to"),
        body if kind == "response" else None, n_bytes, digest, problem,
    )


def read_archives(spark: SparkSession, location: str, *, payloads: bool = True) -> DataFrame:
    """Records of all archives under a folder, one row each, see _RECORDS.

    A damaged record or archive gives a row whose problem is not null; records before the damage
    are whole. Without payloads, these are checked but not returned.
    """

    def rows(archive: bytes) -> Iterator[tuple]:
        try:
            for raw in records_of(archive):
                yield parsed(raw)
        except (ValueError, zstandard.ZstdError) as error:
            yield (None,) * 7 + (str(error),)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                out, size = [], 0
                for row in rows(content.as_py()):
                    out.append(row if payloads else (*row[:4], None, *row[5:]))
                    size += len(row[4] or b"") if payloads else 0
                    if size >= 4 << 20 or len(out) >= 10_000:
                        yield _batch(out)
                        out, size = [], 0
                if out:
                    yield _batch(out)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(location)
    return files.select("content").mapInArrow(decode, from_arrow_schema(_RECORDS))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)


def with_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to of pages, ready for write_archives.

    Of pages with equal payloads of least_bytes or more, that with the largest id is kept whole and
    the others refer to it. Payloads are compared by SHA-256 and length; only these and ids are
    grouped, map-side first. Null html is an empty payload. A null id can't be referred to, and a
    page with one is always whole. Rows that repeat an id and its payload have the same part.
    """
    source = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("h", F.unhex(F.sha2("payload", 256)))
    rows = stage(
        source.filter(F.col("page_id").isNotNull() & (F.octet_length("payload") >= least_bytes))
        .select("page_id", "h", salt("page_id").alias("salt")),
        "payload_digests",
    )
    groups = repeated_groups(rows, ["h"], "page_id", largest=True)
    revisits = stage(
        rows.join(groups, ["h", "salt"])
        .filter(F.col("page_id") != F.col("keep_id"))
        .select("page_id", "h", F.col("keep_id").alias("refers_to"))
        .distinct(),
        "revisits",
    )
    return source.join(narrow_enough(revisits, 64), ["page_id", "h"], "left").drop("h")


def archived_pages(pages: DataFrame, location: str, **options) -> DataFrame:
    """Write every page to archives at location and return what reading them back gives.

    Per page: page_id, payload_bytes, payload_digest, record_type, refers_to, problem (null for
    whole records). No pages, no records.
    """
    write_archives(with_revisits(pages, **options), location)
    return read_archives(pages.sparkSession, location, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "problem"
    )


# Base32 of 40 hex digits: 8 groups of 20 bits, 4 letters each.
ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), g AS (
  SELECT html, max(page_id) AS keep_id FROM p GROUP BY html
)
SELECT page_id, octet_length(encode(p.html))::BIGINT AS payload_bytes,
  list_aggregate(list_transform(range(8), lambda i: list_aggregate(list_transform([15, 10, 5, 0], lambda s:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h, 1 + 5 * i, 5))::BIGINT >> s) & 31)::INT, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = keep_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keep_id THEN NULL ELSE keep_id END AS refers_to,
  NULL::VARCHAR AS problem
FROM p JOIN g ON p.html = g.html
"""
