"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding a group of whole WARC records, and a last skippable frame with
the seek table of the public seekable format: compressed and decompressed size of every frame, their number, and a magic number.
A reader takes the table from the end of the file and opens any frame alone. The manifest maps each record id to its
bundle, frame and offset inside the frame.

Payloads that are equal (by SHA-1) are written once: the record with the smallest page id is a response, the others are
revisits that refer to it. Payloads below ``revisit_from`` bytes are always written. The digests travel without the pages:
only ids that repeat a digest are brought together with the pages again, by id, so a page copied very often is no hot key of
the wide table.

Tasks write bundles under fresh names and report what they wrote, so a task that is lost and run again leaves at most a
file nobody names. Bundles are closed at ``BUNDLE_BYTES``, frames at ``FRAME_BYTES``; a longer record has a frame of its own.

Null payloads are empty. A row with a null id is written under a fresh record id that stands for no page: a revisit if a row with
an id has its payload, else a response. Ids are meant to be unique: of rows that share id and payload all are written, and only
the first page id counts as the one referred to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.session import Workspace

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
# Skippable frame and seek table of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"
# rows without an id are spread over so many parts where they meet their digests
SALTS = 64

MANIFEST = "page_id long, bundle string, frame int, offset long, bytes long"


def location(uri: str):
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4() if page_id is None else uuid.UUID(int=page_id % (1 << 64))}>"


def page_of(name: str) -> int | None:
    value = uuid.UUID(name.strip("<>").removeprefix("urn:uuid:")).int
    if value >> 64:  # made for a row without an id
        return None
    return value - (1 << 64) if value >> 63 else value


def record(page_id: int | None, url: str, payload: bytes, digest: str, first: int | None) -> bytes:
    """A response, or a revisit of the page ``first``. A revisit has no body but says how long its payload was."""
    body = b"" if first is not None else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if first is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(body)}",
    ]
    if first is not None:
        head[5:5] = ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(first)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record that starts at ``at``, and where the next one starts."""
    stop = data.index(b"\r\n\r\n", at)
    lines = data[at:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    end = stop + 4 + int(headers["Content-Length"])
    if data[end : end + 4] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return headers, data[stop + 4 : end], end + 4


class Bundle:
    """A bundle being written."""

    def __init__(self, uri: str, frame_bytes: int):
        self.uri, self.limit = uri, frame_bytes
        fs, path = location(uri)
        self.out = fs.open_output_stream(path, compression=None)
        self.press = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.frame: list[bytes] = []
        self.size = self.written = 0
        self.table: list[tuple[int, int]] = []

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and offset in the frame."""
        if self.frame and self.size + len(data) > self.limit:
            self.flush()
        at = len(self.table), self.size
        self.frame.append(data)
        self.size += len(data)
        return at

    def flush(self) -> None:
        if self.frame:
            packed = self.press.compress(b"".join(self.frame))
            self.out.write(packed)
            self.table.append((len(packed), self.size))
            self.written += len(packed)
            self.frame, self.size = [], 0

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *x) for x in self.table)
        footer = struct.pack("<IBI", len(self.table), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int]]:
    """(position, compressed size, size) of each frame of an open bundle."""
    end = source.size()
    source.seek(end - 9)
    count, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end")
    source.seek(end - 9 - 8 * count)
    held, out, at = source.read(8 * count), [], 0
    for packed, size in struct.iter_unpack("<II", held):
        out.append((at, packed, size))
        at += packed
    return out


def read_frame(source, entry: tuple[int, int, int]) -> bytes:
    at, packed, size = entry
    source.seek(at)
    return zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=size)


def read_record(uri: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its place, reading no other frame."""
    fs, path = location(uri)
    with fs.open_input_file(path) as source:
        return parse(read_frame(source, seek_table(source)[frame]), offset)[:2]


def _write(folder: str, frame_bytes: int, bundle_bytes: int):
    def run(batches):
        bundle, rows = None, []

        def done():
            bundle.close()
            columns = list(zip(*rows))
            return pa.RecordBatch.from_pydict(
                {
                    "page_id": pa.array(columns[0], pa.int64()),
                    "bundle": [bundle.uri] * len(rows),
                    "frame": pa.array(columns[1], pa.int32()),
                    "offset": pa.array(columns[2], pa.int64()),
                    "bytes": pa.array(columns[3], pa.int64()),
                }
            )

        for batch in batches:
            for page, url, payload, first in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "first"))):
                page, payload = page.as_py(), payload.as_py() or b""
                if bundle is None:
                    fs, path = location(folder)
                    fs.create_dir(path, recursive=True)
                    bundle, rows = Bundle(f"{folder}/{uuid.uuid4().hex}.warc.zst", frame_bytes), []
                data = record(page, url.as_py() or "", payload, digest_of(payload), first.as_py())
                rows.append((page, *bundle.add(data), len(data)))
                if bundle.written >= bundle_bytes:
                    yield done()
                    bundle = None
        if bundle is not None:
            yield done()

    return run


def write_archives(
    ws: Workspace,
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    revisit_from: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write every page; returns the manifest (page_id, bundle, frame, offset, bytes)."""
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    held = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    digests = ws.save(
        held.where(F.length("payload") >= revisit_from).select("page_id", F.unhex(F.sha1("payload")).alias("digest")), "digests"
    )
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    copies = digests.join(firsts, "digest").where("page_id is null or page_id <> first").select("page_id", "digest", "first").distinct()
    # rows without an id have only the digest to be found by, so they are spread, and what they look for is there in each part
    copies = copies.withColumn("salt", F.explode(F.when(F.col("page_id").isNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    salt = F.when(F.col("page_id").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(0)
    key = lambda df: df.withColumn("known", F.col("page_id").isNotNull()).withColumn("key", F.coalesce("page_id", F.lit(0).cast("long")))
    # payloads are compared again, so that an id that stands for several payloads refers each to its own
    joined = (
        key(held.withColumn("salt", salt)).withColumn("digest", F.unhex(F.sha1("payload")))
        .join(key(copies).drop("page_id"), ["key", "known", "salt", "digest"], "left")
        .select("page_id", "url", "payload", "first")
    )
    folder = ws.path("bundles")
    return ws.save(joined.mapInArrow(_write(folder, frame_bytes, bundle_bytes), MANIFEST), "manifest")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, bundle string, frame int, offset long"


def _read(batches):
    for batch in batches:
        for uri in batch.column("bundle").to_pylist():
            fs, path = location(uri)
            with fs.open_input_file(path) as source:
                for frame, entry in enumerate(seek_table(source)):
                    data, at, rows = read_frame(source, entry), 0, []
                    while at < len(data):
                        headers, block, after = parse(data, at)
                        kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        size = int(headers["X-Payload-Length"])
                        if kind == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if len(payload) != size or digest_of(payload) != digest:
                                raise ValueError(f"payload of {headers['WARC-Record-ID']} is damaged")
                        refers = headers.get("WARC-Refers-To")
                        rows.append(
                            (page_of(headers["WARC-Record-ID"]), size, digest, kind, page_of(refers) if refers else None, headers["WARC-Target-URI"], uri, frame, at)
                        )
                        at = after
                    names = [c.split()[0] for c in RECORD.split(", ")]
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def read_archives(manifest: DataFrame) -> DataFrame:
    """Every record of the bundles the manifest names, with its place; payloads are checked against their digests."""
    bundles = manifest.select("bundle").distinct()
    # a number of partitions that stays: the names are few bytes, what they name is not
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInArrow(_read, RECORD)


def archive_sql() -> str:
    """What reading back returns, in DuckDB's SQL; base 32 takes five bits at a time from two neighbouring hexadecimal digits."""
    digit = lambda at: f"(strpos('0123456789abcdef', h[{at}]) - 1)"
    bits = f"(((16 * {digit('(5 * i // 4) + 1')} + CASE WHEN (5 * i // 4) + 2 <= 40 THEN {digit('(5 * i // 4) + 2')} ELSE 0 END) >> (3 - (5 * i) % 4)) & 31)"
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
      d AS (SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha1(payload) AS h, min(page_id) OVER (PARTITION BY payload) AS first FROM p)
      SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
        list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', {bits}::INT + 1, 1) for i in range(0, 32)], 'string_agg', '') AS payload_digest,
        CASE WHEN page_id IS NOT DISTINCT FROM first OR first IS NULL THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM d"""
