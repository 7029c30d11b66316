import hashlib
import io
import zipfile

import pytest
from fixtures import empty

from lodestone.llm import warc
from lodestone.llm import zip_archive as Z


def reader(data):
    return lambda at, length: data[at : at + length]


def test_packages_open_in_other_readers():
    data = Z.package([("archive/a.warc", [b"ab", b"cd"]), ("indexes/é.cdx", [])])
    with zipfile.ZipFile(io.BytesIO(data)) as other:
        assert other.testzip() is None
        assert other.read("archive/a.warc") == b"abcd" and other.read("indexes/é.cdx") == b""


@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 looks like an end" * 3])
def test_plain_directories_of_other_writers(comment):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("one.txt", b"first")
        z.writestr("two.txt", b"second" * 50, compress_type=zipfile.ZIP_DEFLATED)
        z.comment = comment
    data = buffer.getvalue()
    members = Z.directory(reader(data), len(data))
    assert list(members) == ["one.txt", "two.txt"]
    at = Z.data_start(reader(data), members["one.txt"])
    assert data[at : at + members["one.txt"].size] == b"first"
    with pytest.raises(Z.NotAnArchive):
        Z.data_start(reader(data), members["two.txt"])


def test_zip64_directory_is_followed():
    data = Z.package([(f"m{k}", [bytes([k % 256]) * k]) for k in range(300)])
    members = Z.directory(reader(data), len(data))
    assert len(members) == 300
    at = Z.data_start(reader(data), members["m77"])
    assert data[at : at + 77] == bytes([77]) * 77


@pytest.mark.parametrize("broken", [b"", b"no archive", Z.package([("a", [b"x"])])[:-30], Z.package([("a", [b"x"])])[40:]])
def test_broken_archives_are_told(broken):
    with pytest.raises(Z.NotAnArchive):
        Z.directory(reader(broken), len(broken))


def test_only_ranges_are_read():
    piece = warc.record(1, "http://a/", b"x" * 5_000, hashlib.sha256(b"x" * 5_000).hexdigest(), "response", None)
    data = Z.package([(warc.DATA, [piece] * 200), (warc.INDEX, [b"".join(f"{k * len(piece)} {len(piece)}\n".encode() for k in range(200))])])
    asked = []

    def read_at(at, length):
        asked.append(length)
        return data[at : at + length]

    records = warc.read_records(read_at, len(data))
    next(records)
    next(records)
    assert sum(asked) < len(data) / 4


PAGES = [
    (5, "http://a/\r\nX: y", "<p>é" + "z" * 200),
    (3, "http://b/ c", "<p>é" + "z" * 200),
    (9, None, "<p>é" + "z" * 200),
    (9, None, "<p>é" + "z" * 200),
    (3, "http://b/ c", "<p>é" + "z" * 200),
    (1, "u", None),
    (2, "u", ""),
    (4, "u", "short"),
    (6, "u", "short"),
    (None, "u", "q" * 150),
    (8, "u", "q" * 150),
    (None, "u", "alone" * 30),
    (10, "u", "a\r\n\r\nb" * 40),
    (11, "u", "big" * 2_000_000),
]


def test_round_trip_of_awkward_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 700)
    pages = spark.createDataFrame([(*p, 1, "x") for p in PAGES], "page_id long, url string, html string, digest int, first string")
    result = warc.round_trip(pages, 100, payloads=True).collect()
    want = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = min(same, default=None) if len(data) >= 100 else None
        again = first is not None and page != first
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None, None if again else data))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for r in result]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty(spark):
    pages = empty(spark).selectExpr("doc_id page_id", "text url", "text html")
    assert warc.round_trip(pages).count() == 0
