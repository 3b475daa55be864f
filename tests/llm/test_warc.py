from __future__ import annotations

import gzip
import hashlib

import pytest
from helpers import sentences

from celluloid.llm import warc

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def rows():
    shared, small = "<p>é" + sentences(1, 60) + "\r\n\r\n\0</p>", "<p>small</p>"
    made = [(k, f"https://www.h{k % 7}.example.org/p/{k}?q=1#f", f"<p>{sentences(k, 50)}</p>") for k in range(300)]
    made += [(900, "http://x.org/a\nb", shared), (850, "http://x.org/", shared), (860, "http://x.org/", shared), (850, "http://x.org/2", shared), (None, None, shared)]
    made += [(910, "http://y.org/", small), (911, "http://y.org/", small), (920, "", None), (921, "http://z.org", ""), (None, "http://n.org", sentences(2, 70)), (None, "http://n.org", sentences(2, 70))]
    return made


def expected(rows):
    first: dict[str, int] = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 100:
            digest = hashlib.sha256(data).hexdigest()
            first[digest] = min(first.get(digest, page_id), page_id)
    made = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        refers = first.get(digest) if len(data) >= 100 else None
        refers = None if refers == page_id else refers
        made.append((page_id, len(data), digest, "response" if refers is None else "revisit", refers))
    return sorted(made, key=str)


@pytest.mark.parametrize(("archive", "block"), [(1 << 28, 1_000), (2_000, 7)])
def test_round_trip_and_lookups(spark, rows, monkeypatch, archive, block):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive)
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", block)
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    index = warc.CaptureIndex.build(pages)
    records = index.records().collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records), key=str) == expected(rows)
    by_id = {r[0]: r[2] for r in rows if r[0] is not None}
    for r in records:
        if r["page_id"] is not None and r["record_type"] == "response":
            assert bytes(r["payload"]) == (by_id[r["page_id"]] or "").encode()
    for url in ("https://www.h3.example.org/p/3?q=1#f", "http://x.org/", "http://none.org/"):
        wanted = sorted(r[0] for r in rows if r[1] == url)
        assert sorted(r["page_id"] for r in index.find([url])) == wanted
        assert sorted(r["page_id"] for r in index.find_all(spark.createDataFrame([(url,), (url,)], "url string")).collect()) == wanted
    directory = index.directory.orderBy("first_key", "last_key").collect()
    assert sum(r["entries"] for r in directory) == len(rows)
    assert all(a["last_key"] <= b["first_key"] for a, b in zip(directory, directory[1:]))


def test_archives_are_warc_records(spark, rows, tmp_path):
    entries = warc.write_archives(spark.createDataFrame(rows[:40], PAGES).coalesce(1), str(tmp_path))
    name = entries.first()["file"]
    data = gzip.decompress((tmp_path / name).read_bytes())
    assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC/1.1\r\n") == 40 and data.endswith(b"\r\n\r\n")
    for e in entries.collect():
        with open(tmp_path / name, "rb") as file:
            file.seek(e["offset"])
            headers, payload = warc.parse(gzip.decompress(file.read(e["length"])))
        assert headers["WARC-Target-URI"] == e["url"] and hashlib.sha256(payload).hexdigest() == e["payload_digest"]


def test_keys_and_damage():
    assert warc.url_key("https://www.B.example.org:80/x/y?z#f") == "org,example,b:80)/x/y?z"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert warc.url_key("nonsense") == "nonsense)/"
    good = warc.record(1, "u", b"abc", "d", None, None)
    for bad in (good[:-1], b"WARC/1.0" + good[8:], good + b"x"):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_empty_table_and_clashing_columns(spark, rows):
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows[:3]], PAGES + ", payload int, digest string")
    assert warc.CaptureIndex.build(pages).records().count() == 3
    empty = warc.CaptureIndex.build(pages.limit(0))
    assert empty.records().count() == 0 and empty.find(["http://x.org/"]) == []
