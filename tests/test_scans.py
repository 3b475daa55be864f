from __future__ import annotations

import gzip
import hashlib
import json
from datetime import date

import pytest

from celluloid.operators.claims import entity_rows, explode_claims, external_ids, prepare_items
from celluloid.sources import documents, manifest, tsv
from conftest import rows_of

TITLE_HEAD = "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres"


def land(tmp_path, name, lines):
    path = tmp_path / name
    data = ("\n".join(lines) + "\n").encode()
    path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    return str(path)


def test_titles_keep_quotes_blanks_and_backslashes(spark, tmp_path):
    path = land(
        tmp_path,
        "t.tsv.gz",
        [
            TITLE_HEAD,
            'tt1\ttvEpisode\t"Lantern (half open\t"x" y\t0\t2019\t\\N\t\\N\tReality-TV',
            "tt2\tshort\t  lead\\\t\\N\t\\N\t 42 \tbad\t1\t\\N",
            "tt3\tshort\t\\N\t\t1\t1968\t\\N\t1\tA,B",
        ],
    )
    got = rows_of(tsv.scan_titles(spark, path).drop(*tsv.ORDER).orderBy("imdb_id"))
    assert got == [
        ("tt1", "tvEpisode", '"Lantern (half open', '"x" y', 0, 2019, None, None, "Reality-TV"),
        ("tt2", "short", "  lead\\", None, 0, None, None, 1, None),
        # the mark is a null only where nulls are allowed; an empty field stays empty
        ("tt3", "short", "\\N", "", 1, 1968, None, 1, "A,B"),
    ]


def test_columns_are_bound_by_header_name(spark, tmp_path):
    path = land(tmp_path, "r.tsv", ["numVotes\textra\ttconst\taverageRating", "10\tzzz\ttt1\t8.6"])
    assert rows_of(tsv.scan_ratings(spark, path).drop(*tsv.ORDER)) == [("tt1", 8.6, 10)]


def test_ragged_row_fails_even_when_columns_are_pruned(spark, tmp_path):
    path = land(tmp_path, "r.tsv", ["tconst\taverageRating\tnumVotes", "tt1\t8.6"])
    with pytest.raises(Exception, match="(?i)malformed"):
        tsv.scan_ratings(spark, path).select("imdb_id").collect()


def test_order_columns_follow_the_file(spark, tmp_path):
    path = land(tmp_path, "r.tsv.gz", ["tconst\taverageRating\tnumVotes", *[f"tt{i}\t1\t{i}" for i in range(50)]])
    rows = tsv.scan_ratings(spark, path).orderBy(*tsv.ORDER)
    assert [r["num_votes"] for r in rows.collect()] == list(range(50))


def test_export_scan(spark, tmp_path):
    line = '{"id":31,"adult":false,"original_title":"Quiet Harbour","popularity":17.25,"video":false}'
    path = land(tmp_path, "e.json.gz", [line, "", "   ", '{"id":12,"adult":true,"video":true,"extra":1}'])
    got = rows_of(documents.scan_movie_export(spark, path, 7).drop(*tsv.ORDER).orderBy("tmdb_movie_id"))
    assert got == [(7, 12, 1, None, None, 1), (7, 31, 0, "Quiet Harbour", 17.25, 0)]


@pytest.mark.parametrize("line", ['{"id":1,"adult":false}', "{nope", '{"id":"x","adult":false,"video":false}'])
def test_bad_export_line_fails(spark, tmp_path, line):
    path = land(tmp_path, "e.json.gz", [line])
    with pytest.raises(Exception, match="(?i)malformed|lacks"):
        documents.scan_movie_export(spark, path, 1).collect()


def test_detail_without_credit_name_fails(spark, tmp_path):
    good = {"id": 1, "title": "A", "credits": {"cast": [], "crew": [{"id": 2, "name": "B"}]}}
    path = land(tmp_path, "d.json", [json.dumps(good)])
    assert documents.scan_movie_details(spark, path).count() == 1
    good["credits"]["crew"][0].pop("name")
    path = land(tmp_path, "d2.json", [json.dumps(good)])
    with pytest.raises(Exception, match="lacks"):
        documents.scan_movie_details(spark, path).collect()


def statement(value, rank="normal"):
    return {"rank": rank, "mainsnak": {"datatype": "d", "datavalue": {"value": value}}}


DUMP = [
    {
        "id": "Q1",
        "type": "item",
        "labels": {"de": {"value": "Eins"}, "en": {"value": "One"}},
        "descriptions": {"en": {"value": "first"}},
        "claims": {
            "P345": [statement("tt1"), statement(5), statement("nm1")],
            "P31": [
                statement("text"),
                statement({"id": "Q9", "time": "+1"}),
                {"rank": "normal"},
                statement({"time": "+2003"}),
                statement({"text": "mono", "language": "en"}),
                statement({"amount": "+3"}),
                statement(5),
                statement(2.5),
                statement([1]),
                statement({"other": 1}),
            ],
            "P999": [statement("ignored")],
            "P57": "not a list",
        },
    },
    {"id": "Q2", "type": "item", "claims": []},
    {"id": "Q3", "type": "property"},
    {"id": 4, "type": "item"},
    {"id": "Q5", "type": "item", "labels": [], "descriptions": {"en": {"value": 3}}},
]


@pytest.fixture
def items(spark, tmp_path):
    lines = ["[", *[json.dumps(d) + ("," if i % 2 else ",,  ") for i, d in enumerate(DUMP)], "", "]"]
    path = land(tmp_path, "dump.json.gz", lines)
    return prepare_items(documents.scan_entity_dump(spark, path), "de")


def test_dump_items_and_texts(items):
    got = rows_of(entity_rows(items).drop(*tsv.ORDER).orderBy("wikidata_id"))
    assert got == [("Q1", "Eins", "first", "item"), ("Q2", None, None, "item"), ("Q5", None, None, "item")]


def test_external_ids_are_texts_only(items):
    assert rows_of(external_ids(items), "wikidata_id", "external_id", "_pos") == [("Q1", "tt1", 0), ("Q1", "nm1", 2)]


def test_claim_values_and_ordinals(items):
    got = rows_of(
        explode_claims(items).orderBy("ordinal"), "property_id", "ordinal", "value_type", "value_text", "value_wikidata_id"
    )
    assert got == [
        ("P31", 0, "string", "text", None),
        ("P31", 1, "wikidata_item", None, "Q9"),
        ("P31", 3, "time", "+2003", None),
        ("P31", 4, "monolingual_text", "mono", None),
        ("P31", 5, "quantity", "+3", None),
        ("P31", 6, "number", "5", None),
        ("P31", 7, "number", "2.5", None),
    ]


def test_malformed_dump_line_fails(spark, tmp_path):
    path = land(tmp_path, "bad.json", ["[", "{broken,", "]"])
    with pytest.raises(Exception, match="(?i)malformed"):
        documents.scan_entity_dump(spark, path).collect()


def test_manifest_hashes_content(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"hello")
    got = rows_of(manifest.artifact_manifest(spark, str(tmp_path / "*.bin")), "name", "sha256", "byte_len")
    assert got == [("a.bin", hashlib.sha256(b"hello").hexdigest(), 5)]


def test_manifest_reads_files_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "CHUNK", 7)
    contents = {"a b.bin": bytes(range(256)) * 5, "z.bin": b"x" * 7, "c.gz": b"not gzip"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    got = rows_of(manifest.artifact_manifest(spark, str(tmp_path / "*")), "name", "sha256", "byte_len")
    assert {n.replace("%20", " "): (h, k) for n, h, k in got} == {n: (hashlib.sha256(c).hexdigest(), len(c)) for n, c in contents.items()}


def test_snapshot_names_newest_first(spark):
    names = [r["name"] for r in manifest.snapshot_candidates(spark, date(2026, 5, 30), 2).collect()]
    assert names == [f"movie_ids_05_{d}_2026.json.gz" for d in (30, 29, 28)]
    landed = spark.createDataFrame([("movie_ids_05_28_2026.json.gz",), ("movie_ids_05_29_2026.json.gz",)], "name string")
    assert manifest.latest_snapshot(landed, date(2026, 5, 30), 2).first()["name"] == "movie_ids_05_29_2026.json.gz"
