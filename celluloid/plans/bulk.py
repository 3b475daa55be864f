"""Bulk import of the seven tab-separated datasets.

Per dataset: scan, stage as Parquet, drop rows whose references are unknown, fold into the table,
write a new table version. The order of datasets matters, as later ones refer to earlier ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.operators.mutations import ARRIVAL, insert_ignore, upsert, upsert_columns
from celluloid.operators.relational import explode_ids, gate
from celluloid.plans.ledger import RunLog
from celluloid.schema import TABLES
from celluloid.session import scratch_path
from celluloid.sources.manifest import artifact_manifest
from celluloid.sources.tsv import arrived, scan_dataset
from celluloid.sources.warehouse import Warehouse

IMPORTER = "bulk-tsv"
VERSION = "0.1.0"

# Dependency order of the datasets and the table each one feeds.
IMPORT_ORDER = (
    ("name.basics", "people"),
    ("title.basics", "titles"),
    ("title.ratings", "title_ratings"),
    ("title.akas", "title_akas"),
    ("title.crew", "title_crew"),
    ("title.principals", "credits"),
    ("title.episode", "episode_edges"),
)

# Fixed values: (referring column, table it must be found in) per fed table.
REFERENCES = {
    "title_ratings": (("imdb_id", "titles"),),
    "title_akas": (("imdb_id", "titles"),),
    "title_crew": (("imdb_id", "titles"),),
    "credits": (("imdb_id", "titles"), ("imdb_name_id", "people")),
    "episode_edges": (("imdb_id", "titles"), ("parent_imdb_id", "titles")),
}


def written(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written once under the shared folder."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def missing_ids(ids: DataFrame) -> DataFrame:
    return written(ids, "missing")


def gate_table(rows: DataFrame, table: str, warehouse, stored: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows whose references all exist in the warehouse."""
    parents = [
        (warehouse.keys(parent), TABLES[parent].key[0], column) for column, parent in REFERENCES.get(table, ())
    ]
    return gate(rows, parents, stored)


def import_counters(seen: int, kept: int, before: int, after: int) -> dict[str, int]:
    """A kept row either adds a row to the table or overwrites one, of the table or of its own batch."""
    return {"rows_seen": seen, "rows_inserted": after - before, "rows_updated": kept - (after - before), "rows_skipped": seen - kept}


def fold_counted(table: str, staged: DataFrame, warehouse: Warehouse) -> tuple[DataFrame, dict[str, int]]:
    """Gate and fold staged rows into a stored table: (kept rows, counters).

    The gated rows are written once; the fold, the crew list and the counters all read them, and the fold moves them
    once, to where the table has them. All four counts come from footers. (Metrics that are observed on a plan count a stage again when a lost executor makes Spark run it again.)
    """
    kept = written(gate_table(staged, table, warehouse, missing_ids), f"kept-{table}")
    before = warehouse.counted(table).count()
    warehouse.save(table, fold_table(table, warehouse.table(table), kept, cut=True), cut=True)
    return kept, import_counters(staged.count(), kept.count(), before, warehouse.counted(table).count())


def expand_crew(
    crew: DataFrame, titles: DataFrame, people: DataFrame, stored: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Crew lists as credits: directors, then writers, numbered by list position, known people only."""
    parts = [
        explode_ids(crew.select("imdb_id", column, *[c for c in (ARRIVAL,) if c in crew.columns]), column, "imdb_name_id")
        .withColumn("category", F.lit(category))
        for column, category in (("directors", "director"), ("writers", "writer"))
    ]
    both = parts[0].unionByName(parts[1])
    known = gate(both, [(titles, "imdb_id", "imdb_id"), (people, "imdb_name_id", "imdb_name_id")], stored)
    return known.withColumns(
        {"job": F.lit(None).cast("string"), "characters": F.lit(None).cast("string"), "source": F.lit("imdb")}
    )


def fold_table(table: str, existing: DataFrame, incoming: DataFrame, cut: bool = False) -> DataFrame:
    """Fold gated rows into a table by the table's conflict rule; with ``cut``, where the table has them."""
    spec = TABLES[table]
    if table == "credits":
        return upsert_columns(existing, incoming, spec.key, [ARRIVAL], ["job", "characters"], spec.nullable_key, cut)
    return upsert(existing, incoming, spec.key, [ARRIVAL], spec.nullable_key, cut)


def import_dataset(spark: SparkSession, path: str, dataset: str, table: str, warehouse: Warehouse) -> dict[str, int]:
    """Import one landed file; returns its counters."""
    staged_at = scratch_path(spark, f"stage-{table}")
    rows = scan_dataset(spark, path, dataset)
    if table == "credits":
        rows = rows.withColumn("source", F.lit("imdb"))
    # one task reads a gzip file, whatever its size; what it parsed is then split for all later steps
    rows.write.parquet(staged_at)
    kept, counters = fold_counted(table, arrived(spark.read.parquet(staged_at)), warehouse)
    if table == "title_crew":
        # the same rows also become credits; a line gives several, so they have its number in common
        spec, credits = TABLES["credits"], warehouse.table("credits")
        crew = written(expand_crew(kept, warehouse.keys("titles"), warehouse.keys("people"), missing_ids), "crew")
        warehouse.save("credits", insert_ignore(credits, crew, spec.key, [ARRIVAL], spec.nullable_key, cut=True), cut=True)
    return counters


def landed_datasets(spark: SparkSession, landing_dir: str, suffix: str = ".tsv.gz") -> DataFrame:
    """(path, name, sha256, byte_len) of the datasets in a landing folder; a folder of parts is known by
    the hashes of its parts in their order."""
    names = [f"{dataset}{suffix}" for dataset, _ in IMPORT_ORDER]
    known = "|".join(n.replace(".", "[.]") for n in names)
    files = artifact_manifest(spark, f"{landing_dir.rstrip('/')}/*{suffix}")
    within = F.regexp_extract("path", rf"^(.*/({known}))(?:/[^/]+)?$", 0)
    files = files.where(within != "").select(
        F.regexp_extract("path", rf"^(.*/(?:{known}))(?:/[^/]+)?$", 1).alias("of"), "path", "sha256", "byte_len"
    )
    parts = files.groupBy("of").agg(
        F.array_sort(F.collect_list(F.struct("path", "sha256"))).alias("parts"), F.sum("byte_len").alias("byte_len")
    )
    joined = F.sha2(F.concat_ws(" ", F.col("parts.sha256")), 256)
    one = (F.size("parts") == 1) & (F.col("parts")[0]["path"] == F.col("of"))
    return parts.select(
        F.col("of").alias("path"),
        F.substring_index("of", "/", -1).alias("name"),
        F.when(one, F.col("parts")[0]["sha256"]).otherwise(joined).alias("sha256"),
        "byte_len",
    )


def import_bulk(
    spark: SparkSession, landing_dir: str, warehouse: Warehouse, suffix: str = ".tsv.gz", force: bool = False
) -> dict[str, dict[str, int]]:
    """Import all landed datasets in dependency order; an artifact already imported is skipped.

    A dataset is a file ``<name><suffix>`` or a folder of that name with parts, each with its header.
    """
    log = RunLog(warehouse, IMPORTER, VERSION)
    landed = landed_datasets(spark, landing_dir, suffix)
    by_name = {r["name"]: r["path"] for r in landed.select("name", "path").collect()}  # seven at most
    artifact_ids = log.register("imdb", landed)
    results: dict[str, dict[str, int]] = {}
    for dataset, table in IMPORT_ORDER:
        name = f"{dataset}{suffix}"
        if name not in by_name:
            continue
        artifact_id = artifact_ids[name]
        if not log.begin(artifact_id, force):
            results[dataset] = {"rows_seen": 0, "rows_inserted": 0, "rows_updated": 0, "rows_skipped": 1}
            continue
        results[dataset] = log.guarded(
            artifact_id, lambda: import_dataset(spark, by_name[name], dataset, table, warehouse)
        )
    return results
