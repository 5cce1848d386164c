import base64
import hashlib
import io
import zipfile

import pytest

from tests.llm.data import written
from tidings.llm import warc
from tidings.session import cut_lineage

SCHEMA = "page_id long, url string, html string, payload string, revisit int, path string"


def expected(rows, least=0):
    out, biggest = [], {}
    for page_id, _, html in rows:
        if page_id is not None:
            biggest[html or ""] = max(page_id, biggest.get(html or "", page_id))
    for page_id, _, html in rows:
        data = (html or "").encode()
        top = biggest.get(html or "")
        again = top is not None and page_id != top and len(data) >= least
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", top if again else None))
    return sorted(out, key=str)


ROWS = [(1, "http://a.test/ä?x=1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", ""), (4, "u\r\nX: y", None), (5, "u", "long " * 50_000),
        (None, "u", "<p>é</p>"), (None, "u", "alone"), (6, "u", "twice"), (6, "u", "twice"), (7, "u", "\r\n\r\nHTTP/1.1")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("least", [0, 8])
def test_round_trip(spark, least):
    found = warc.archive_pages(frame(spark, ROWS), least).collect()
    assert sorted(map(tuple, found), key=str) == expected(ROWS, least)


def test_empty_table(spark):
    assert warc.archive_pages(frame(spark, ROWS).limit(0)).collect() == []


def test_query_reads_its_table(spark, tmp_path):
    found = warc.op1_warc(spark, written(frame(spark, ROWS), tmp_path, "pages"))
    assert sorted(map(tuple, found.collect()), key=str) == expected(ROWS)


def test_packages_roll_over(spark, tmp_path):
    rows = frame(spark, ROWS).selectExpr("page_id", "url", "cast(coalesce(html, '') as binary) payload")
    manifest = cut_lineage(warc.write_packages(warc.with_revisits(rows), str(tmp_path / "w"), package_bytes=200))
    assert manifest.count() > 3 and manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    found = warc.read_records(warc.locate_ranges(manifest, chunk_bytes=1)).collect()
    assert sorted(map(tuple, found), key=str) == expected(ROWS)


def package(**settings):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        with z.open("big", "w", force_zip64=True) as member:
            member.write(b"0123456789")
        z.writestr("näme", b"abc")
        z.writestr("packed", b"z" * 1000, zipfile.ZIP_DEFLATED)
        z.comment = settings.get("comment", b"")
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"a comment"])
@pytest.mark.parametrize("limits", [None, 1])
def test_directory_with_and_without_zip64(monkeypatch, limits, comment):
    if limits:  # every size, offset and count then goes to the ZIP64 fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limits)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 0)
    data = package(comment=comment)
    assert (warc.END64 in data) == bool(limits)
    file = io.BytesIO(data)
    members = {m[0]: m for m in warc.zip_directory(file, len(data))}
    assert {n: m[3] for n, m in members.items()} == {"big": 10, "näme": 3, "packed": 1000}
    start = warc.stored_start(file, members["big"])
    assert warc.read_range(file, start + 2, 5) == b"23456"
    assert warc.read_range(file, warc.stored_start(file, members["näme"]), 3) == b"abc"
    with pytest.raises(ValueError, match="compressed"):
        warc.stored_start(file, members["packed"])


def test_damage_is_an_error():
    with pytest.raises(ValueError, match="no end"):
        warc.zip_directory(io.BytesIO(b"nothing here"), 12)
    data = package()
    with pytest.raises(ValueError):
        warc.read_range(io.BytesIO(data), len(data) - 2, 10)
