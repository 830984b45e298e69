"""WARC records in ZIP-packaged archives, read by range without extraction.

An archive is a ZIP file with stored members: ``archive/data.warc.gz`` (one
gzip member for each record) and ``indexes/index.cdxj`` (a line for each
record with its offset and length). The reader parses the end of the file,
the ZIP64 records if there are any, and the central directory, locates the
members' bytes, and reads single records by their range.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.tables import open_store, store_uri
from rillmark.session import scratch_dir

LEAST_BYTES = 1000
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: The tables hold no fetch time.
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
OUT_BYTES = 8 << 20
# Fixed values of the ZIP format: signatures and the marks that send to the ZIP64 fields.
END, END64, LOCATOR64, ENTRY, LOCAL = 0x06054B50, 0x06064B50, 0x07064B50, 0x02014B50, 0x04034B50
FULL16, FULL32, EXTRA64 = 0xFFFF, 0xFFFFFFFF, 0x0001


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    packed: int
    size: int
    header: int


def directory(source) -> list[Member]:
    """The members that a ZIP file's central directory lists."""
    total = source.size()
    tail_at = max(0, total - (22 + FULL16))
    tail = source.read_at(total - tail_at, tail_at)
    at = tail.rfind(struct.pack("<I", END))
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(struct.pack("<I", END), 0, at)
    if at < 0:
        raise ValueError("not a ZIP file")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if FULL16 == count or FULL32 in (length, begin):
        place = tail_at + at - 20
        mark, _, end64, _ = struct.unpack("<IIQI", source.read_at(20, place)) if place >= 0 else (0, 0, 0, 0)
        if mark == LOCATOR64:
            record = source.read_at(56, end64)
            if struct.unpack_from("<I", record)[0] != END64:
                raise ValueError("the ZIP64 end record is missing")
            count, length, begin = struct.unpack_from("<QQQ", record, 32)
    raw, members, at = source.read_at(length, begin), [], 0
    while at < len(raw):
        if struct.unpack_from("<I", raw, at)[0] != ENTRY:
            raise ValueError("damaged central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        packed, size, name_len, extra_len, note_len = struct.unpack_from("<IIHHH", raw, at + 20)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + name_len].decode("utf-8" if flags & 0x800 else "cp437")
        size, packed, header = _wide(raw[at + 46 + name_len : at + 46 + name_len + extra_len], size, packed, header)
        members.append(Member(name, method, packed, size, header))
        at += 46 + name_len + extra_len + note_len
    if len(members) != count:
        raise ValueError("the central directory lacks entries")
    return members


def _wide(extra: bytes, *values: int) -> list[int]:
    """Values that are full take the next number of the ZIP64 field."""
    at, wide = 0, []
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA64:
            wide = list(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
        at += 4 + length
    return [wide.pop(0) if v == FULL32 and wide else v for v in values]


def stored_at(source, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method != 0 or member.packed != member.size:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    mark, name_len, extra_len = struct.unpack("<I22xHH", source.read_at(30, member.header))
    if mark != LOCAL:
        raise ValueError(f"{member.name} has no local header")
    return member.header + 30 + name_len + extra_len


class ArchiveReader:
    """Reads single records of one packaged archive."""

    def __init__(self, source):
        self.source = source
        members = {m.name: m for m in directory(source)}
        index = members[INDEX]
        lines = source.read_at(index.size, stored_at(source, index)).decode("utf-8").splitlines()
        self.entries = [json.loads(line.split(" ", 2)[2]) for line in lines]
        self.begin, self.size = stored_at(source, members[DATA]), members[DATA].size

    def record(self, entry: dict) -> tuple[dict[str, str], bytes]:
        """Headers and block of the record at an index entry."""
        if entry["offset"] + entry["length"] > self.size:
            raise ValueError("the index points outside the archive member")
        raw = zlib.decompress(self.source.read_at(entry["length"], self.begin + entry["offset"]), wbits=31)
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8").split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        if not version.startswith("WARC/") or len(rest) != int(headers["Content-Length"]) + 4:
            raise ValueError("damaged record")
        return headers, rest[:-4]


def _id_text(page_id: int | None, part: int, row: int) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:page:none:{part}:{row}>"


def _id_value(text: str) -> int | None:
    last = text.removeprefix("<urn:page:").removesuffix(">")
    return None if last.startswith("none:") else int(last)


def _record(record_id: str, url: str | None, payload: bytes, sha1: bytes, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", "WARC-Payload-Digest: sha1:" + base64.b32encode(sha1).decode(), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _pack(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archive(sink, rows: Iterator[tuple], part: int = 0) -> int:
    """Write ``(page_id, url, payload, sha1, refers_to)`` rows into one archive; returns their number."""
    index, offset = [], 0
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as package:
        with package.open(DATA, "w", force_zip64=True) as member:
            for row, (page_id, url, payload, sha1, refers_to) in enumerate(rows):
                record_id = _id_text(page_id, part, row)
                packed = _pack(_record(record_id, url, payload, sha1, refers_to))
                member.write(packed)
                entry = {"url": url, "offset": offset, "length": len(packed), "filename": "data.warc.gz", "record": record_id}
                index.append(f"{json.dumps(url or '-').replace(' ', '%20')} {DATE[:4]} {json.dumps(entry)}")
                offset += len(packed)
        with package.open(INDEX, "w", force_zip64=True) as member:
            for line in index:
                member.write(line.encode("utf-8") + b"\n")
    return len(index)


def write_pages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_BYTES) -> DataFrame:
    """Write a record for each page into archives below ``folder``; returns their paths.

    Of records with equal payloads of at least ``least`` bytes, those of the
    largest id are responses and the others revisit them; a null id is smaller
    than any, and where all ids are null all are responses. Payloads count as
    equal by length, SHA-1 and SHA-256. A null html is an empty payload, a
    null url is left out. Every row gets a record, also where ids repeat. The
    table of repeated payloads has a row for each; a payload that a third of
    all pages share is met map-side and its join is split. No rows: no file.
    """
    folder = store_uri(pages.sparkSession, folder)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.unhex(F.sha1("payload")), "sha2": F.sha2("payload", 256), "size": F.octet_length("payload")})
    shared = rows.filter(F.col("size") >= least).groupBy("sha2", "sha1", "size").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = shared.select(F.col("sha2").alias("s2"), F.col("sha1").alias("s1"), F.col("size").alias("sz"), "top")
    met = rows.join(shared, (F.col("sha2") == F.col("s2")) & (F.col("sha1") == F.col("s1")) & (F.col("size") == F.col("sz")), "left")
    refers = F.when(F.col("id").isNull() | (F.col("id") < F.col("top")), F.col("top"))
    ready = met.select("id", "url", "payload", "sha1", refers.alias("refers"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        name = f"part-{context.partitionId():06d}"
        store, root = open_store(folder)
        store.create_dir(root, recursive=True)
        draft = f"{root}/.{name}-{context.taskAttemptId()}"
        with store.open_output_stream(draft) as sink:
            count = write_archive(sink, _rows(first, batches), context.partitionId())
        store.move(draft, f"{root}/{name}.wacz")
        yield pa.record_batch([pa.array([f"{folder}/{name}.wacz"]), pa.array([count], pa.int64())], names=["path", "records"])

    # One small row for each file written, as a commit protocol sends.
    files = ready.mapInArrow(write, "path string, records long").collect()
    return pages.sparkSession.createDataFrame([(f.path,) for f in files], "path string")


def _rows(first: pa.RecordBatch, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in (b for group in ([first], batches) for b in group):
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def read_pages(files: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of all archives: id, url, length and SHA-1 of the full payload, type, and what a revisit refers to.

    A response's payload is hashed again and compared with its header; a
    revisit has no payload of its own (null). Damaged records fail.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name = open_store(path)
                with store.open_input_file(name) as source:
                    reader, rows, size = ArchiveReader(source), [], 0
                    for entry in reader.entries:
                        rows.append(_read_record(reader, entry, with_payload))
                        size += len(rows[-1][6] or b"") + 200
                        if size > OUT_BYTES:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    return files.repartition(max(1, files.count()), "path").mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = [part.split()[0] for part in RECORDS.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _read_record(reader: ArchiveReader, entry: dict, with_payload: bool) -> tuple:
    headers, block = reader.record(entry)
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).split(b":")[1])
    sha1 = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != sha1):
        raise ValueError(f"record {headers['WARC-Record-ID']} has another payload than its header says")
    refers = _id_value(headers["WARC-Refers-To"]) if kind == "revisit" else None
    return _id_value(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), size, sha1, kind, refers, payload if with_payload and kind == "response" else None


def round_trip(pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Write all pages to a new folder below the shared one and read the records back."""
    return read_pages(write_pages(pages, scratch_dir(pages.sparkSession, "warc")), with_payload)


def oracle() -> str:
    """What reading the archives back must give, in DuckDB's SQL."""
    return f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY digest, n) AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= {LEAST_BYTES} AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {LEAST_BYTES} AND page_id < top THEN top END AS refers_to
FROM t
"""
