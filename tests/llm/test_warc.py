import hashlib
import io
import struct
import zipfile

import pytest

from eventlens.llm import warc_zip as w
from eventlens.llm.common import folder


def test_stored_members_by_range():
    f = io.BytesIO()
    with zipfile.ZipFile(f, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment with PK\x05\x06 inside, and more bytes behind it"
        z.writestr("archive/ä.bin", b"0123456789" * 50)
        z.writestr("deflated", b"x" * 999, zipfile.ZIP_DEFLATED)
        z.writestr("lines", b"a\nbb\n\nccc")
    r = w.ZipReader(f)
    assert list(r.members) == ["archive/ä.bin", "deflated", "lines"]
    assert r.read_range("archive/ä.bin", 7, 5) == b"78901"
    assert list(r.lines("lines", 3)) == [b"a", b"bb", b"", b"ccc"]
    with pytest.raises(ValueError):
        r.read_range("deflated", 0, 1)
    with pytest.raises(ValueError):
        r.read_range("archive/ä.bin", 499, 2)
    with pytest.raises(ValueError):
        w.ZipReader(io.BytesIO(b"not an archive"))


def zip64(name: bytes, data: bytes) -> bytes:
    """A one-member archive whose sizes, offset and counts stand in ZIP64 fields only."""
    lead = b"bytes before the archive's first header"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HH4s", 0x7777, 4, b"junk") + struct.pack("<HHQQQ", 1, 24, len(data), len(data), len(lead))
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    at = len(lead) + len(local)
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, 1, 1, len(central), at)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    return lead + local + central + end64 + locator + end


def test_zip64_directory():
    r = w.ZipReader(io.BytesIO(zip64(b"big", b"abcdefghij")))
    assert r.members["big"].size == 10 and r.read_range("big", 2, 3) == b"cde"


def test_records():
    body = "é".encode() * 700
    digest = hashlib.sha1(body).hexdigest()
    raw = w.record(7, "http://a/ü b\r\nX: y", body, len(body), digest, None)
    got = w.parse_record(raw)
    assert (got["page_id"], got["payload"], got["payload_digest"], got["refers_to"]) == (7, body, digest, None)
    assert b"\r\nX: y" not in raw.split(b"\r\n\r\n")[0]
    got = w.parse_record(w.record(8, None, b"", len(body), digest, 9))
    assert (got["record_type"], got["refers_to"], got["payload_bytes"], got["payload"], got["url"]) == ("revisit", 9, 1400, None, None)
    with pytest.raises(ValueError):
        w.parse_record(raw[:-200])


def brute(rows):
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        group = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        owner = max(group, default=None) if len(body) >= 1000 and sum((h or "") == (html or "") for _, _, h in rows) > 1 else None
        revisit = owner is not None and owner != page_id
        out.append((page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", owner if revisit else None))
    return out


def test_archives_read_back(llm):
    from tests.llm.conftest import same_rows

    big, other = "<p>é</p>" * 150, "y" * 1000
    rows = [(i, f"http://h/{i}", big) for i in range(40)] + [(50, None, "short"), (51, "u", "short"), (52, "", None), (53, "u", "y" * 999), (54, "u", "y" * 999)]
    rows += [(60, "u", other), (60, "u", other), (61, "u", other), (61, "v", other), (None, "u", other), (None, "u", "q" * 2000), (None, "u", "q" * 2000), (70, "u", "w" * 300000)]
    df = llm.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for c in ("digest", "size", "salt", "owner", "payload"):
        df = df.selectExpr("*", f"'clash' AS {c}")
    path = folder(llm, "t-warc")
    manifest = w.write_archives(w.records(df), path)
    got = w.read_archives(manifest, path, payloads=True).collect()
    same_rows([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], brute(rows))
    assert all(len(r.payload) == r.payload_bytes for r in got if r.record_type == "response")


def test_nothing(llm):
    path = folder(llm, "t-warc0")
    empty = llm.createDataFrame([], "page_id long, url string, html string")
    assert w.read_archives(w.write_archives(w.records(empty), path), path).collect() == []
