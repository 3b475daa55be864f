"""Movie queue and hydration from landed detail documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.functions.parse import stamped
from celluloid.operators.claims import explode_credits, external_id, movie_rows
from celluloid.operators.mutations import apply_outcome, replace_children, upsert, upsert_columns, upsert_links
from celluloid.operators.relational import top_pending, when_flag
from celluloid.plans.ledger import RunLog
from celluloid.schema import TABLES
from celluloid.session import scratch_path
from celluloid.sources.documents import scan_movie_export
from celluloid.sources.manifest import artifact_manifest
from celluloid.sources.tsv import ORDER
from celluloid.sources.warehouse import Tables, Warehouse

IMPORTER = "movie-export"
VERSION = "0.1.0"
# Fixed value: movies hydrated per run unless told otherwise.
HYDRATE_LIMIT = 25

FROM_EXPORT = ("adult", "original_title", "popularity", "video")


def enqueue(queue: DataFrame, exported: DataFrame) -> DataFrame:
    """Fold export rows into the queue; the hydration state of known movies is kept."""
    fresh = exported.withColumns(
        {
            "hydrate_status": F.lit(None).cast("string"),
            "hydrate_attempts": F.lit(0).cast("bigint"),
            "last_error": F.lit(None).cast("string"),
            "hydrated_at": F.lit(None).cast("timestamp"),
        }
    )
    return upsert_columns(queue, fresh, TABLES["tmdb_movie_exports"].key, ORDER, FROM_EXPORT)


def import_export(
    spark: SparkSession, path: str, warehouse: Warehouse, dataset: str | None = None, force: bool = False
) -> dict[str, int]:
    """Import a landed movie-id export into the queue."""
    log = RunLog(warehouse, IMPORTER, VERSION)
    manifest = artifact_manifest(spark, path)
    name = dataset or manifest.first()["name"]
    [artifact_id] = log.register("tmdb", manifest.withColumn("name", F.lit(name))).values()
    if not log.begin(artifact_id, force):
        return {"export_rows_seen": 0, "export_rows_imported": 0, "export_rows_skipped": 1}

    def work() -> dict[str, int]:
        staged_at = scratch_path(spark, "stage-export")
        scan_movie_export(spark, path, artifact_id).write.parquet(staged_at)
        staged = spark.read.parquet(staged_at)
        warehouse.save("tmdb_movie_exports", enqueue(warehouse.table("tmdb_movie_exports"), staged))
        seen = staged.count()
        return {"rows_seen": seen, "rows_inserted": seen, "rows_updated": 0, "rows_skipped": 0}

    done = log.guarded(artifact_id, work)
    return {"export_rows_seen": done["rows_seen"], "export_rows_imported": done["rows_inserted"], "export_rows_skipped": 0}


def pending_hydrations(
    exports: DataFrame, movies: DataFrame, artifact_id: int, include_adult: bool = False, limit: int = HYDRATE_LIMIT
) -> DataFrame:
    """Most popular movies of an export that have no record yet."""
    mine = exports.where(F.col("export_artifact_id") == artifact_id)
    mine = when_flag(mine, include_adult, F.col("adult") == 0)
    fresh = mine.join(movies.select("tmdb_movie_id"), "tmdb_movie_id", "left_anti")
    return top_pending(fresh.select("export_artifact_id", "tmdb_movie_id", "original_title", "popularity"), limit)


def hydrate_tables(
    details: DataFrame, warehouse: Tables, tried: DataFrame | None = None, failures: DataFrame | None = None
) -> dict[str, DataFrame]:
    """New versions of the movie tables from detail documents.

    ``tried`` names the queue rows (export_artifact_id, tmdb_movie_id) this batch belongs to;
    ``failures`` (export_artifact_id, tmdb_movie_id, error) those that could not be had.
    Also returns ``link_rejects``: links that would give a movie a second title.
    """
    movies = stamped(movie_rows(details), "hydrated_at")
    credits = explode_credits(details)
    at = [*ORDER, "_pos"]
    credit_columns = TABLES["tmdb_movie_credits"].names
    people = credits.select("tmdb_person_id", "name", *at)

    doc = F.col("doc")
    wanted = details.select(external_id(doc).alias("imdb_id"), "tmdb_movie_id", *ORDER)
    linked = wanted.join(warehouse.table("titles").select("imdb_id"), "imdb_id", "left_semi").withColumns(
        {"linked_via": F.lit("tmdb_external_id"), "linked_at": F.current_timestamp()}
    )
    links, rejects = upsert_links(
        warehouse.table("title_tmdb_links"),
        linked.select("imdb_id", "tmdb_movie_id", "linked_via", "linked_at", *ORDER),
        "imdb_id",
        "tmdb_movie_id",
        ORDER,
    )
    out = {
        "tmdb_movies": upsert(warehouse.table("tmdb_movies"), movies, ["tmdb_movie_id"], ORDER),
        "tmdb_people": upsert(warehouse.table("tmdb_people"), people, ["tmdb_person_id"], at),
        "tmdb_movie_credits": replace_children(
            warehouse.table("tmdb_movie_credits"),
            credits.select(*credit_columns, *at),
            details,
            "tmdb_movie_id",
            TABLES["tmdb_movie_credits"].key,
            at,
        ),
        "title_tmdb_links": links,
        "link_rejects": rejects,
    }
    if tried is not None:
        keys = ["export_artifact_id", "tmdb_movie_id"]
        done = tried.select(*keys).join(details.select("tmdb_movie_id").distinct(), "tmdb_movie_id", "left_semi")
        outcome = done.select(*keys, F.lit(None).cast("string").alias("error"))
        if failures is not None:
            lost = failures.select(*keys, "error").join(done, keys, "left_anti")
            outcome = outcome.unionByName(lost)
        out["tmdb_movie_exports"] = apply_outcome(warehouse.table("tmdb_movie_exports"), outcome)
    return out


def hydrate(
    spark: SparkSession,
    details: DataFrame,
    warehouse: Warehouse,
    artifact_id: int,
    include_adult: bool = False,
    limit: int = HYDRATE_LIMIT,
    failures: DataFrame | None = None,
) -> dict[str, int]:
    """Hydrate the pending movies of an export from landed detail documents and save the tables."""
    # the choice is written first: it must not change while the tables it is made from are replaced
    chosen_at = scratch_path(spark, "pending")
    queue, movies = warehouse.table("tmdb_movie_exports"), warehouse.table("tmdb_movies")
    pending_hydrations(queue, movies, artifact_id, include_adult, limit).write.parquet(chosen_at)
    pending = spark.read.parquet(chosen_at)
    staged_at = scratch_path(spark, "details")
    details.join(pending.select("tmdb_movie_id"), "tmdb_movie_id", "left_semi").write.parquet(staged_at)
    batch = spark.read.parquet(staged_at)
    if failures is not None:
        failures = failures.join(pending.select("tmdb_movie_id"), "tmdb_movie_id", "left_semi")
    tables = hydrate_tables(batch, warehouse, pending, failures)
    rejects = tables.pop("link_rejects").count()
    # the movies of the batch are a few of all: only the folders that hold their credits are written again
    key, at = TABLES["tmdb_movie_credits"].key, [*ORDER, "_pos"]
    credits = upsert(None, explode_credits(batch).select(*TABLES["tmdb_movie_credits"].names, *at), key, at)
    del tables["tmdb_movie_credits"]
    warehouse.replace("tmdb_movie_credits", batch, credits)
    for name, df in tables.items():
        warehouse.save(name, df)
    linked = batch.select(external_id(F.col("doc")).alias("imdb_id")).join(
        warehouse.table("titles").select("imdb_id"), "imdb_id", "left_semi"
    )
    return {
        "movies_hydrated": batch.count(),
        "credits_imported": explode_credits(batch).count(),
        "title_links_created": linked.count() - rejects,
        "hydration_failures": 0 if failures is None else failures.count(),
    }
