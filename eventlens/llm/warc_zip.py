"""WARC records in ZIP-packaged archives, written once and read by range.

Each writer task packs its records into one ZIP file with two members, both
stored without ZIP compression: ``archive/data.warc.gz``, one gzip member per
record, and ``indexes/index.cdxj``, one line per record with its offset and
length.  The reader never extracts: it finds the end-of-central-directory
record (and the ZIP64 one where sizes, offsets or counts are at their limit),
walks the central directory, resolves the members' data offsets through their
local headers, and range-reads single records by the index.

Of records with equal payloads of ``min_bytes`` or more, the one with the
largest page id is a ``response``; the others are ``revisit`` records that
hold the HTTP head only and name it.  The payload is the page's html in UTF-8.

A task writes under a name of its own, and only the manifest table, committed
by Spark, names the files that count; a task that is run again after a lost
executor leaves an unnamed file behind and nothing else.

Defined cases: a null html is an empty payload; a null url is written as
``about:blank`` and read back as null; a null page id cannot be referred to, so
rows without id are responses where no row of their group has one; rows that
share the largest page id of a group are all responses; empty tables give an
empty archive.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import child, open_fs, written

MIN_BYTES = 1000
#: A hot payload's rows are dealt over this many join keys.
SALTS = 64
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
_ID = "urn:page:"
_DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time


# -- ZIP directories ----------------------------------------------------------

# fixed values: record signatures and sizes of the ZIP format
EOCD, EOCD_SIZE = b"PK\x05\x06", 22
EOCD64_LOCATOR, EOCD64_LOCATOR_SIZE = b"PK\x06\x07", 20
EOCD64, EOCD64_SIZE = b"PK\x06\x06", 56
CENTRAL, CENTRAL_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
MAX_COMMENT, ZIP64_EXTRA = 0xFFFF, 0x0001


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    stored_size: int
    header_offset: int


class ZipReader:
    """Members of a ZIP file by its directory; reads byte ranges only.
    ``source`` is a seekable binary file."""

    def __init__(self, source):
        self.source = source
        source.seek(0, io.SEEK_END)
        self.length = source.tell()
        self.members = {m.name: m for m in self._directory()}

    def _at(self, offset: int, n: int) -> bytes:
        if offset < 0 or offset + n > self.length:
            raise ValueError("range outside the archive")
        self.source.seek(offset)
        return self.source.read(n)

    def _end(self) -> tuple[int, int, int]:
        """Number of entries, size and offset of the central directory."""
        n = min(self.length, EOCD_SIZE + MAX_COMMENT)
        tail, start = self._at(self.length - n, n), self.length - n
        at = tail.rfind(EOCD)
        while at >= 0:  # a comment may hold the signature: its length must reach the end
            if at + EOCD_SIZE <= len(tail) and at + EOCD_SIZE + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
            at = tail.rfind(EOCD, 0, at)
        if at < 0:
            raise ValueError("not a ZIP archive")
        count, size, offset = struct.unpack_from("<HII", tail, at + 10)
        if count == 0xFFFF or size == 0xFFFFFFFF or offset == 0xFFFFFFFF:
            where = start + at - EOCD64_LOCATOR_SIZE
            locator = self._at(where, EOCD64_LOCATOR_SIZE) if where >= 0 else b""
            if locator[:4] == EOCD64_LOCATOR:
                record = self._at(struct.unpack_from("<Q", locator, 8)[0], EOCD64_SIZE)
                if record[:4] != EOCD64:
                    raise ValueError("ZIP64 end record missing")
                count, size, offset = struct.unpack_from("<QQQ", record, 32)
        return count, size, offset

    def _directory(self) -> Iterator[Member]:
        count, size, offset = self._end()
        raw, at = self._at(offset, size), 0
        for _ in range(count):
            if raw[at : at + 4] != CENTRAL:
                raise ValueError("broken central directory")
            flags, method = struct.unpack_from("<HH", raw, at + 8)
            stored, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
            (header,) = struct.unpack_from("<I", raw, at + 42)
            name = raw[at + CENTRAL_SIZE : at + CENTRAL_SIZE + n_name]
            extra = raw[at + CENTRAL_SIZE + n_name : at + CENTRAL_SIZE + n_name + n_extra]
            plain, stored, header = self._zip64(extra, plain, stored, header)
            yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, plain, stored, header)
            at += CENTRAL_SIZE + n_name + n_extra + n_comment

    @staticmethod
    def _zip64(extra: bytes, *values: int) -> list[int]:
        """Fields at their 32-bit limit are taken, in order, from the ZIP64 extra field."""
        at, out = 0, list(values)
        while at + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, at)
            if kind == ZIP64_EXTRA:
                big = at + 4
                for i, v in enumerate(values):
                    if v == 0xFFFFFFFF:
                        (out[i],) = struct.unpack_from("<Q", extra, big)
                        big += 8
            at += 4 + n
        return out

    def data_offset(self, name: str) -> int:
        """Where a stored member's bytes begin."""
        m = self.members[name]
        if m.method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} is compressed; only stored members can be read by range")
        head = self._at(m.header_offset, LOCAL_SIZE)
        if head[:4] != LOCAL:
            raise ValueError("broken local header")
        n_name, n_extra = struct.unpack_from("<HH", head, 26)
        return m.header_offset + LOCAL_SIZE + n_name + n_extra

    def read_range(self, name: str, offset: int, n: int) -> bytes:
        """``n`` bytes at ``offset`` of a stored member."""
        if offset < 0 or offset + n > self.members[name].size:
            raise ValueError("range outside the member")
        return self._at(self.data_offset(name) + offset, n)

    def lines(self, name: str, piece: int = 1 << 20) -> Iterator[bytes]:
        """A stored member's lines, read in bounded pieces."""
        start, left, rest = self.data_offset(name), self.members[name].size, b""
        while left:
            n = min(piece, left)
            got = rest + self._at(start, n)
            start, left = start + n, left - n
            *full, rest = got.split(b"\n")
            yield from full
        if rest:
            yield rest


# -- records ------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """A WARC 1.1 record; ``refers_to`` makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = "about:blank" if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~^`{|}\\\"<>")
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha1:{sha1}",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one WARC record; payload is None for a revisit."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]):
        raise ValueError("cut WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    page = lambda x: int(x[len(_ID) + 1 : -1]) if x and x != f"<{_ID}>" else None
    kind = fields["WARC-Type"]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload and digest differ")
    return {
        "page_id": page(fields["WARC-Record-ID"]), "url": None if fields["WARC-Target-URI"] == "about:blank" else fields["WARC-Target-URI"],
        "record_type": kind, "payload_bytes": size, "payload_digest": digest, "refers_to": page(fields.get("WARC-Refers-To")),
        "payload": payload if kind == "response" else None,
    }


# -- Spark --------------------------------------------------------------------

def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, payload, size, digest, refers_to of every page."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    p = p.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload").cast("long"))
    owners = (
        p.where(F.col("size") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1 and owner is not null").select("digest", "owner")
    )
    # repeated payloads only, one row for each salt
    dealt = written(owners, "warc-owners").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    joined = p.withColumn("salt", salt).join(dealt, ["digest", "salt"], "left")
    refers = F.when((F.col("size") >= min_bytes) & ~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner"))
    return joined.select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "size", "digest", refers.alias("refers_to"))


def write_archives(rows: DataFrame, path: str) -> DataFrame:
    """Writes the rows of ``records`` as ZIP archives below ``path`` and
    returns the manifest (file, records, bytes), itself a written table."""

    def run(batches):
        fs = out = archive = data = index = None
        name = f"warc-{uuid.uuid4().hex}.zip"
        n = at = 0
        for b in batches:
            for page_id, url, payload, size, digest, refers_to in zip(*[b.column(i).to_pylist() for i in range(6)]):
                if archive is None:
                    fs, base = open_fs(path)
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(child(base, name))
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
                    data = archive.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
                    index = []
                raw = gzip.compress(record(page_id, url, payload or b"", size, digest, refers_to), 5, mtime=0)
                data.write(raw)
                index.append((page_id, at, len(raw)))
                at, n = at + len(raw), n + 1
        if archive is not None:
            data.close()
            with archive.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
                for page_id, offset, length in index:
                    f.write(json.dumps({"page_id": page_id, "offset": offset, "length": length, "filename": DATA}).encode() + b"\n")
            archive.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "records": [n], "bytes": [at]}, schema=pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    order = rows.select("page_id", "url", "payload", "size", "digest", "refers_to")
    return written(order.mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read_archives(manifest: DataFrame, path: str, payloads: bool = False) -> DataFrame:
    """One row per record of the manifest's archives, each read by range."""
    names = [x.split()[0] for x in READ.split(", ")] + ["payload"] * payloads
    schema = READ + ", payload binary" * payloads
    types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")])

    def run(batches):
        fs, base = open_fs(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                with fs.open_input_file(child(base, name)) as f:
                    z = ZipReader(f)
                    start = z.data_offset(DATA)
                    rows, held = [], 0
                    for line in z.lines(INDEX):
                        entry = json.loads(line)
                        raw = z._at(start + entry["offset"], entry["length"])
                        r = parse_record(gzip.decompress(raw))
                        rows.append({k: r[k] for k in names})
                        held += len(raw)
                        if len(rows) >= 5000 or held >= 1 << 24:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = manifest.select("file")
    return files.repartition(max(1, _count(manifest))).mapInArrow(run, schema)


def _count(manifest: DataFrame) -> int:
    """Archives, at most as many as writer tasks."""
    return manifest.count()
