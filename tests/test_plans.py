from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from celluloid import Warehouse
from celluloid.operators import lookup
from celluloid.plans import bulk, entities, ledger, movies
from celluloid.sources import documents
from celluloid.sources.warehouse import warehouse_stats
from conftest import rows_of

HEADS = {
    "name.basics": "nconst primaryName birthYear deathYear primaryProfession knownForTitles",
    "title.basics": "tconst titleType primaryTitle originalTitle isAdult startYear endYear runtimeMinutes genres",
    "title.ratings": "tconst averageRating numVotes",
    "title.akas": "titleId ordering title region language types attributes isOriginalTitle",
    "title.crew": "tconst directors writers",
    "title.principals": "tconst ordering nconst category job characters",
    "title.episode": "tconst parentTconst seasonNumber episodeNumber",
}

LANDED = {
    "name.basics": ["nm1\tOtto Lindqvist\t1931\t2001\tactor,soundtrack\ttt1", "nm2\tOther\t\\N\t\\N\t\\N\t\\N"],
    "title.basics": [
        "tt1\tshort\tWindmill\tWindmill\t0\t1968\t\\N\t1\tDocumentary,Short",
        "tt2\tmovie\tOld name\t\\N\t\\N\t\\N\t\\N\t\\N\t\\N",
        "tt2\tmovie\tNew name\t\\N\t\\N\t\\N\t\\N\t\\N\t\\N",
    ],
    "title.ratings": ["tt1\t6.4\t310", "tt404\t9.9\t1"],
    "title.akas": ["tt1\t1\tA\t\\N\t\\N\t\\N\t\\N\t1", "tt1\t\\N\tB\tDE\t\\N\t\\N\t\\N\t0", "tt1\t\\N\tB\tDE\t\\N\t\\N\t\\N\t0"],
    "title.crew": ["tt1\tnm1,nm404,nm2\t\\N"],
    "title.principals": [
        'tt1\t1\tnm1\tactor\t\\N\t["Windmill"]',
        'tt1\t1\tnm1\tactor\tlater\t["Again"]',
        "tt1\t2\tnm404\tactor\t\\N\t\\N",
        "tt1\t1\tnm1\tdirector\tjob\t\\N",
    ],
    "title.episode": ["tt2\ttt1\t1\t3", "tt2\ttt404\t1\t3"],
}


def write_landing(folder, landed=LANDED):
    folder.mkdir(exist_ok=True)
    for name, rows in landed.items():
        head = HEADS[name].replace(" ", "\t")
        (folder / f"{name}.tsv.gz").write_bytes(gzip.compress("\n".join([head, *rows, ""]).encode()))
    return str(folder)


def test_bulk_import(spark, tmp_path):
    landing = write_landing(tmp_path / "landing")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    done = bulk.import_bulk(spark, landing, wh)
    # imported in dependency order, whatever the order of landing
    assert list(done) == [d for d, _ in bulk.IMPORT_ORDER]
    assert done["title.basics"] == {"rows_seen": 3, "rows_inserted": 2, "rows_updated": 1, "rows_skipped": 0}
    assert done["title.ratings"] == {"rows_seen": 2, "rows_inserted": 1, "rows_updated": 0, "rows_skipped": 1}
    assert done["title.episode"]["rows_skipped"] == 1
    assert done["title.principals"] == {"rows_seen": 4, "rows_inserted": 1, "rows_updated": 2, "rows_skipped": 1}
    assert rows_of(lookup.lookup_title(wh.table("titles"), "windm"), "imdb_id") == [("tt1",)]
    assert rows_of(lookup.lookup_title(wh.table("titles"), "name"), "primary_title") == [("New name",)]
    assert rows_of(lookup.lookup_person(wh.table("people"), "OTTO"), "imdb_name_id") == [("nm1",)]
    # rows with a null in the key never conflict
    assert wh.table("title_akas").count() == 3
    credits = wh.table("credits").orderBy("imdb_name_id", "ordering", "category")
    # the director credit comes from the crew list first; the principal row then sets its job
    assert rows_of(credits, "imdb_name_id", "ordering", "category", "job", "characters", "source") == [
        ("nm1", 1, "actor", "later", '["Again"]', "imdb"),
        ("nm1", 1, "director", "job", None, "imdb"),
        ("nm2", 3, "director", None, None, "imdb"),
    ]
    again = bulk.import_bulk(spark, landing, wh)
    assert all(c == {"rows_seen": 0, "rows_inserted": 0, "rows_updated": 0, "rows_skipped": 1} for c in again.values())
    stats = {r["table_name"]: r["row_count"] for r in warehouse_stats(wh).collect()}
    assert (stats["datasets"], stats["artifacts"], stats["import_runs"]) == (7, 7, 7)
    assert stats["title_ratings"] == 1
    assert set(rows_of(wh.table("import_runs"), "status")) == {("completed",)}


def test_failed_import_changes_no_table_and_may_run_again(spark, tmp_path):
    bad = {"name.basics": ["nm1\tonly two"]}
    landing = write_landing(tmp_path / "landing", bad)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    for _ in range(2):
        with pytest.raises(Exception, match="(?i)malformed"):
            bulk.import_bulk(spark, landing, wh)
        assert wh.version("people") == 0
        [run] = wh.table("import_runs").collect()
        assert run["status"] == "failed"
        assert run["error_message"]


def test_warehouse_versions(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.table("titles").count() == 0
    wh.save("titles", frame("titles", {"imdb_id": "a"}))
    # a table may be overwritten from a plan that reads it
    wh.save("titles", wh.table("titles").unionByName(frame("titles", {"imdb_id": "b"})))
    assert wh.version("titles") == 2
    assert sorted(rows_of(wh.table("titles"), "imdb_id")) == [("a",), ("b",)]

    broken = wh.table("titles").withColumn("genres", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        wh.save("titles", broken)
    assert wh.version("titles") == 2


DETAILS = {
    "id": 31,
    "title": "Quiet Harbour",
    "original_language": "nb",
    "release_date": "2003-09-32",
    "runtime": 96,
    "imdb_id": "tt-top-level",
    "external_ids": {"imdb_id": "tt0900031"},
    "credits": {
        "cast": [{"id": 77, "name": "Ilse Brandt", "character": "Keeper", "order": 0}],
        "crew": [{"id": 88, "name": "Mira Oslund", "department": "Directing", "job": "Director"}],
    },
}


def test_movie_import_and_hydration(spark, tmp_path, frame):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.save("titles", frame("titles", {"imdb_id": "tt0900031", "title_type": "movie", "primary_title": "Quiet Harbour"}))
    export = tmp_path / "movie_ids_05_30_2026.json.gz"
    lines = [
        {"id": 31, "adult": False, "original_title": "Quiet Harbour", "popularity": 17.25, "video": False},
        {"id": 32, "adult": True, "popularity": 99.0, "video": False},
        {"id": 13, "adult": False, "popularity": 1.0, "video": False},
    ]
    export.write_bytes(gzip.compress("\n".join(map(json.dumps, lines)).encode()))
    assert movies.import_export(spark, str(export), wh)["export_rows_seen"] == 3
    assert movies.import_export(spark, str(export), wh)["export_rows_skipped"] == 1
    artifact = wh.table("download_artifacts").first()["id"]
    pending = movies.pending_hydrations(wh.table("tmdb_movie_exports"), wh.table("tmdb_movies"), artifact)
    assert rows_of(pending, "tmdb_movie_id") == [(31,), (13,)]
    with_adult = movies.pending_hydrations(wh.table("tmdb_movie_exports"), wh.table("tmdb_movies"), artifact, True, 1)
    assert rows_of(with_adult, "tmdb_movie_id") == [(32,)]

    (tmp_path / "details.json").write_text(json.dumps(DETAILS) + "\n")
    details = documents.scan_movie_details(spark, str(tmp_path / "details.json"))
    failures = spark.createDataFrame([(artifact, 13, "HTTP 404")], "export_artifact_id bigint, tmdb_movie_id bigint, error string")
    got = movies.hydrate(spark, details, wh, artifact, failures=failures)
    assert got == {"movies_hydrated": 1, "credits_imported": 2, "title_links_created": 1, "hydration_failures": 1}
    assert rows_of(wh.table("tmdb_movies"), "imdb_id", "runtime_minutes") == [("tt0900031", 96)]
    assert sorted(rows_of(wh.table("tmdb_movie_credits"), "credit_key")) == [
        ("cast:77:0:Keeper",),
        ("crew:88:Directing:Director",),
    ]
    assert rows_of(wh.table("title_tmdb_links"), "imdb_id", "tmdb_movie_id", "linked_via") == [
        ("tt0900031", 31, "tmdb_external_id")
    ]
    queue = wh.table("tmdb_movie_exports").orderBy("tmdb_movie_id")
    assert rows_of(queue, "hydrate_status", "hydrate_attempts", "last_error") == [
        ("failed", 1, "HTTP 404"),
        ("completed", 1, None),
        (None, 0, None),
    ]
    # a movie with a record is not pending any more, one that failed before it had one is
    assert movies.hydrate(spark, details, wh, artifact)["movies_hydrated"] == 0
    assert json.loads(wh.table("tmdb_movies").first()["raw_json"])["original_title"] is None


def test_entity_import(spark, tmp_path, frame):
    def said(value):
        return {"rank": "normal", "mainsnak": {"datatype": "d", "datavalue": {"type": "t", "value": value}}}

    def item(i, label=None, **claims):
        labels = {"en": {"language": "en", "value": label}} if label else {}
        return {"id": i, "type": "item", "labels": labels, "descriptions": {}, "claims": claims}

    dump = [
        item("Q900", "Quiet Harbour", P345=[said("tt0900031"), said("tt0000002")], P136=[said({"id": "Q901"})], P577=[said({"time": "+2003"})]),
        item("Q901", "sea drama"),
        item("Q902", "Mira Oslund", P345=[said("nm0900041")], P569=[said({"time": "+1971"})]),
        item("Q903", "Northland", P31=[said({"id": "Q904"})]),
    ]
    path = tmp_path / "dump.json"
    path.write_text("[\n" + ",\n".join(map(json.dumps, [*dump, dump[2]])) + "\n]\n")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.save("titles", frame("titles", {"imdb_id": "tt0900031"}, {"imdb_id": "tt0000002"}))
    wh.save("people", frame("people", {"imdb_name_id": "nm0900041"}))
    wh.save("wikidata_entities", frame("wikidata_entities", {"wikidata_id": "Qold"}))
    stats = entities.import_entities(spark, str(path), wh)
    assert stats == {
        "entities_seen": 5,
        "entities_imported": 5,
        "title_links_created": 1,
        "person_links_created": 1,
        # a repeated entity repeats its claims
        "claims_imported": 4,
        "imports_skipped": 0,
        "links_rejected": 1,
    }
    assert rows_of(wh.table("title_wikidata_links"), "imdb_id", "wikidata_id") == [("tt0900031", "Q900")]
    labels = dict(rows_of(wh.table("wikidata_entities"), "wikidata_id", "label"))
    assert labels == {"Q900": "Quiet Harbour", "Q901": "sea drama", "Q902": "Mira Oslund", "Q903": "Northland"}
    assert entities.import_entities(spark, str(path), wh) == {"imports_skipped": 1}
    entities.import_entities(spark, str(path), wh, dedup=True, force=True)
    assert wh.table("wikidata_claims").count() == 3


def test_ledger_steps(spark, frame):
    artifacts = frame(
        "download_artifacts",
        {"id": 1, "dataset_id": 1, "sha256": "a"},
        {"id": 2, "dataset_id": 1, "sha256": "b"},
        {"id": 3, "dataset_id": 2, "sha256": "a"},
        {"id": 4, "dataset_id": 1, "sha256": "a"},
    )
    assert sorted(rows_of(ledger.dedup_artifacts(artifacts), "id")) == [(1,), (2,), (3,)]
    datasets = frame(
        "datasets", {"id": 1, "source": "s", "dataset_name": "x"}, {"id": 2, "source": "s", "dataset_name": "w"}
    )
    assert rows_of(ledger.latest_artifacts(datasets, artifacts, "s"), "dataset_name", "id") == [("w", 3), ("x", 4)]
    assert rows_of(ledger.latest_artifact(datasets, artifacts, "s"), "id") == [(4,)]
    assert rows_of(ledger.last_artifact_for_dataset(artifacts, 2), "id") == [(3,)]

    def run(artifact, status, importer="i"):
        return {"id": artifact, "artifact_id": artifact, "importer_name": importer, "importer_version": "1", "status": status}

    runs = frame("import_runs", run(1, "completed"), run(2, "failed"), run(3, "running"), run(4, "completed", "other"))
    free = ledger.importable(artifacts, runs, "i", "1")
    assert sorted(rows_of(free, "id")) == [(2,), (4,)]
    assert ledger.importable(artifacts, runs, "i", "1", force=True).count() == 4
    begun = rows_of(ledger.begin_runs(runs, free, "i", "1").orderBy("id"), "id", "artifact_id", "importer_name", "status")
    assert begun[:4] == [
        (1, 1, "i", "completed"),
        (2, 2, "i", "running"),
        (3, 3, "i", "running"),
        (4, 4, "other", "completed"),
    ]
    [(new_id, *fresh)] = begun[4:]
    assert new_id > 4
    assert fresh == [4, "i", "running"]
