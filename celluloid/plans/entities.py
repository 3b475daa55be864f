"""Import of a knowledge-base dump: entities, links to titles and people, claims of linked entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.operators.claims import entity_rows, explode_claims, external_ids, prepare_items
from celluloid.operators.mutations import merge_non_null, upsert_links
from celluloid.plans.ledger import RunLog
from celluloid.schema import TABLES
from celluloid.session import scratch_path
from celluloid.sources.documents import scan_entity_dump
from celluloid.sources.manifest import artifact_manifest
from celluloid.sources.tsv import ORDER
from celluloid.sources.warehouse import Tables, Warehouse

IMPORTER = "entity-dump"
VERSION = "0.1.0"


def resolve_links(ids: DataFrame, known: DataFrame, key: str, prefix: str) -> DataFrame:
    """External ids of one kind that exist locally: (key, wikidata_id, order columns, _pos).

    Ids are made of, or stored in, few bytes of a file each: by the size of its files Spark would send a table of
    millions of them through the driver, so they are merged.
    """
    mine = ids.where(F.col("external_id").startswith(prefix)).withColumnRenamed("external_id", key)
    return mine.join(known.select(key).hint("merge"), key, "left_semi").select(key, "wikidata_id", *ORDER, "_pos")


def entity_tables(items: DataFrame, warehouse: Tables, dedup: bool = False) -> dict[str, DataFrame]:
    """The four knowledge-base tables from prepared items, plus resolved links and rejected ones.

    The import starts from empty tables. Claims are taken from the dump lines that name a known
    title or person; each entity that is the value of a claim gets a row, labelled if the dump has
    its label anywhere. ``dedup`` keeps one of equal claims of a repeated entity.
    """
    ids = external_ids(items)
    titles = resolve_links(ids, warehouse.table("titles"), "imdb_id", "tt")
    people = resolve_links(ids, warehouse.table("people"), "imdb_name_id", "nm")

    lines = titles.select("wikidata_id", *ORDER).unionByName(people.select("wikidata_id", *ORDER)).distinct()
    linked = items.join(lines.hint("merge"), ["wikidata_id", *ORDER], "left_semi")
    claims = explode_claims(linked)
    stubs = claims.where(F.col("value_wikidata_id").isNotNull()).select(
        F.col("value_wikidata_id").alias("wikidata_id"),
        F.lit(None).cast("string").alias("label"),
        F.lit(None).cast("string").alias("description"),
        F.lit("item").alias("entity_type"),
        *ORDER,
    )
    entities = merge_non_null(None, entity_rows(items).unionByName(stubs), ["wikidata_id"], ORDER)

    at = [*ORDER, "_pos"]
    stamp = {"linked_via": F.lit("wikidata_imdb_id"), "linked_at": F.current_timestamp()}
    title_links, title_rejects = upsert_links(None, titles.withColumns(stamp), "imdb_id", "wikidata_id", at)
    person_links, person_rejects = upsert_links(None, people.withColumns(stamp), "imdb_name_id", "wikidata_id", at)
    claim_table = claims.select(*TABLES["wikidata_claims"].names)
    if dedup:
        # nulls count as equal here: one of the two value columns is always null
        claim_table = claim_table.dropDuplicates(list(TABLES["wikidata_claims"].key))
    return {
        "wikidata_entities": entities,
        "title_wikidata_links": title_links,
        "person_wikidata_links": person_links,
        "wikidata_claims": claim_table,
        "title_rejects": title_rejects,
        "person_rejects": person_rejects,
    }


def stage_items(spark: SparkSession, path: str, language: str) -> DataFrame:
    """Parse a dump once; later steps read the cut-down items from Parquet."""
    staged_at = scratch_path(spark, "stage-entities")
    prepare_items(scan_entity_dump(spark, path), language).write.parquet(staged_at)
    return spark.read.parquet(staged_at)


def import_entities(
    spark: SparkSession, path: str, warehouse: Warehouse, language: str = "en", dedup: bool = False, force: bool = False
) -> dict[str, int]:
    """Import a dump; all tables are ready before the first one is replaced."""
    log = RunLog(warehouse, IMPORTER, VERSION)
    manifest = artifact_manifest(spark, path).withColumn("name", F.lit("wikidata-dump"))
    [artifact_id] = log.register("wikidata", manifest).values()
    if not log.begin(artifact_id, force):
        return {"imports_skipped": 1}
    stats: dict[str, int] = {}

    def work() -> dict[str, int]:
        items = stage_items(spark, path, language)
        tables = entity_tables(items, warehouse, dedup)
        ready = {}
        for name, df in tables.items():
            at = scratch_path(spark, f"ready-{name}")
            df.write.parquet(at)
            ready[name] = spark.read.parquet(at)
        rejects = {n: ready.pop(n).count() for n in ("title_rejects", "person_rejects")}
        saved = {name: warehouse.save(name, df) for name, df in ready.items()}
        seen = items.count()
        stats.update(
            entities_seen=seen,
            entities_imported=seen,
            title_links_created=saved["title_wikidata_links"].count(),
            person_links_created=saved["person_wikidata_links"].count(),
            claims_imported=saved["wikidata_claims"].count(),
            imports_skipped=0,
            links_rejected=sum(rejects.values()),
        )
        inserted = seen + stats["title_links_created"] + stats["person_links_created"]
        return {"rows_seen": seen, "rows_inserted": inserted, "rows_updated": 0, "rows_skipped": 0}

    log.guarded(artifact_id, work)
    return stats
