import gzip
import hashlib
import io

import pytest

from marquee.llm.common import importable, scratch
from marquee.llm.warc import parse, read_archives, resolved, write_archives

LONG = "<p>" + "é" * 600 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n</p>"


def pages(spark, rows):
    importable(spark)
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, size int")


ROWS = [
    (1, "http://a", LONG),
    (2, "http://b\r\nX: y", LONG),
    (3, None, LONG),
    (4, "http://c", "short"),
    (5, "http://c", "short"),
    (6, "u", None),
    (7, "u", ""),
    (8, "u", "z" * 1000),
    (9, "u", "z" * 1000),
    (10, "u", "y" * 999),
    (11, "u", "y" * 999),
    (12, "u", "only " * 300),
    (None, "u", LONG),
    (12, "u", "only " * 300),
]


def expected(rows):
    out = []
    for ident, _, html in rows:
        data = (html or "").encode()
        same = [i for i, _, h in rows if (h or "").encode() == data and i is not None]
        original = max(same) if len(data) >= 1000 and same and ident != max(same) else None
        out.append((ident, len(data), hashlib.sha1(data).hexdigest(), "revisit" if original is not None else "response", original))
    return out


def test_round_trip(spark):
    path = scratch(spark, "warc-test")
    write_archives(pages(spark, ROWS), path)
    back = read_archives(spark, path)
    found = [tuple(r) for r in back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(found, key=repr) == sorted(expected(ROWS), key=repr)
    full = resolved(back).collect()
    assert sorted(((r["page_id"], bytes(r["content"]).decode()) for r in full), key=repr) == sorted(((i, h or "") for i, _, h in ROWS), key=repr)


def test_files_are_warc(spark, tmp_path):
    write_archives(pages(spark, ROWS).repartition(1), f"file://{tmp_path}/w")
    (file,) = (tmp_path / "w").glob("*.gz")
    found = list(parse(io.BytesIO(gzip.decompress(file.read_bytes()))))
    assert len(found) == len(ROWS)
    assert file.stat().st_size < sum(len((r[2] or "").encode()) for r in ROWS)
    revisit = next(h for h, _ in found if h["WARC-Type"] == "revisit")
    assert revisit["WARC-Refers-To"] == "<urn:page:3>" and revisit["Content-Length"] == "0" and "identical-payload-digest" in revisit["WARC-Profile"]


def test_many_files(spark, monkeypatch):
    monkeypatch.setattr("marquee.llm.warc.FILE_BYTES", 3000)
    path = scratch(spark, "warc-test")
    write_archives(pages(spark, ROWS).repartition(1), path)
    assert spark.read.format("binaryFile").load(path).count() > 2
    assert read_archives(spark, path).count() == len(ROWS)


def test_empty_table(spark):
    path = scratch(spark, "warc-test")
    write_archives(pages(spark, []), path)
    assert read_archives(spark, path).count() == 0


def test_damaged_archive():
    with pytest.raises(ValueError, match="does not end"):
        list(parse(io.BytesIO(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabcd\r\n\r\n")))
    with pytest.raises(ValueError, match="breaks off"):
        list(parse(io.BytesIO(b"WARC/1.1\r\nContent-Length: 2\r\n")))
