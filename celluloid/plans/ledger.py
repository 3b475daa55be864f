"""Datasets, artifacts and import runs.

The ledger has one row per landed file and run; its frames are small next to the data they
describe, but all steps stay DataFrame transforms.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celluloid.operators.mutations import insert_ignore, upsert, upsert_columns
from celluloid.operators.relational import latest_by
from celluloid.schema import TABLES
from celluloid.session import scratch_path
from celluloid.sources.warehouse import Tables

RUN_KEY = TABLES["import_runs"].key


def dedup_artifacts(artifacts: DataFrame) -> DataFrame:
    """First artifact (lowest id) per dataset and content hash."""
    rest = [c for c in artifacts.columns if c not in ("dataset_id", "sha256")]
    first = artifacts.groupBy("dataset_id", "sha256").agg(F.min_by(F.struct(*rest), F.col("id")).alias("_row"))
    return first.select("dataset_id", "sha256", "_row.*").select(*artifacts.columns)


def latest_artifacts(datasets: DataFrame, artifacts: DataFrame, source: str) -> DataFrame:
    """Newest artifact (greatest id) of each dataset of a source, by dataset name."""
    mine = datasets.where(F.col("source") == source).select(F.col("id").alias("dataset_id"), "dataset_name")
    newest = latest_by(artifacts, ["dataset_id"], "id")
    return mine.join(newest, "dataset_id").select("dataset_name", *artifacts.columns).orderBy("dataset_name")


def latest_artifact(datasets: DataFrame, artifacts: DataFrame, source: str) -> DataFrame:
    """Newest artifact of a source over all of its datasets: at most one row."""
    mine = datasets.where(F.col("source") == source).select(F.col("id").alias("dataset_id"), "dataset_name")
    joined = artifacts.join(mine, "dataset_id").select("dataset_name", *artifacts.columns)
    return joined.orderBy(F.desc("id")).limit(1)


def last_artifact_for_dataset(artifacts: DataFrame, dataset_id: int) -> DataFrame:
    return artifacts.where(F.col("dataset_id") == dataset_id).orderBy(F.desc("id")).limit(1)


def importable(
    artifacts: DataFrame, runs: DataFrame, importer: str, version: str, force: bool = False
) -> DataFrame:
    """Artifacts an importer may run on: never run, or failed last time. ``force`` lifts the gate."""
    if force:
        return artifacts
    mine = (F.col("importer_name") == importer) & (F.col("importer_version") == version)
    blocked = runs.where(mine & (F.col("status") != "failed")).select(F.col("artifact_id").alias("id"))
    return artifacts.join(blocked, "id", "left_anti").select(*artifacts.columns)


def begin_runs(runs: DataFrame, artifacts: DataFrame, importer: str, version: str) -> DataFrame:
    """Runs with a fresh ``running`` row for each artifact; a failed run starts over."""
    zero = F.lit(0).cast("bigint")
    fresh = artifacts.select(
        F.col("id").alias("artifact_id"),
        F.lit(importer).alias("importer_name"),
        F.lit(version).alias("importer_version"),
        F.current_timestamp().alias("started_at"),
        F.lit(None).cast("timestamp").alias("finished_at"),
        F.lit("running").alias("status"),
        *[zero.alias(c) for c in ("rows_seen", "rows_inserted", "rows_updated", "rows_skipped")],
        F.lit(None).cast("string").alias("error_message"),
        F.lit(0).alias("_at"),
    )
    return _keep_ids(runs, upsert(runs.drop("id"), fresh, RUN_KEY, ["_at"]), RUN_KEY)


def finish_runs(runs: DataFrame, outcome: DataFrame) -> DataFrame:
    """Write status and counters of finished runs.

    ``outcome``: run key, status, four counters, error_message; runs it does not name stay as they are.
    """
    changed = ("status", "rows_seen", "rows_inserted", "rows_updated", "rows_skipped", "error_message")
    done = outcome.select(*RUN_KEY, F.struct(*changed).alias("_new"))
    hit = F.col("_new").isNotNull()
    updates = {c: F.when(hit, F.col("_new")[c]).otherwise(F.col(c)) for c in changed}
    updates["finished_at"] = F.when(hit, F.current_timestamp()).otherwise(F.col("finished_at"))
    return runs.join(done, list(RUN_KEY), "left").withColumns(updates).select(*runs.columns)


def _keep_ids(old: DataFrame, rows: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Old rows keep their id; new ones get unused numbers above the greatest one.

    Numbers are unique and rise with every save, but have gaps: they are given per partition.
    """
    known = rows.join(old.select("id", *key), list(key), "left")
    top = old.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    new_id = F.coalesce(F.col("id"), top + 1 + F.monotonically_increasing_id())
    return known.withColumn("id", new_id).select(*old.columns)


def register_datasets(datasets: DataFrame, named: DataFrame) -> DataFrame:
    """Add datasets (source, dataset_name, canonical_url), or update their URL."""
    rows = named.select(
        "source",
        "dataset_name",
        "canonical_url",
        F.lit(None).cast("string").alias("license_note"),
        F.current_timestamp().alias("created_at"),
        F.col("canonical_url").alias("_at"),
    )
    key = TABLES["datasets"].key
    merged = upsert_columns(datasets.drop("id"), rows, key, ["_at"], ["canonical_url"])
    return _keep_ids(datasets, merged, key)


def register_artifacts(artifacts: DataFrame, landed: DataFrame) -> DataFrame:
    """Add landed files (dataset_id, url, local_path, sha256, byte_len); known content is kept as it is."""
    none = F.lit(None).cast("string")
    rows = landed.select(
        "dataset_id",
        "url",
        "local_path",
        "sha256",
        "byte_len",
        none.alias("etag"),
        none.alias("last_modified"),
        F.current_timestamp().alias("fetched_at"),
        F.col("url").alias("_at"),
    )
    key = TABLES["download_artifacts"].key
    return _keep_ids(artifacts, insert_ignore(artifacts.drop("id"), rows, key, ["_at"]), key)


class RunLog:
    """Ledger steps of one importer, saved to the warehouse around an import."""

    def __init__(self, warehouse: Tables, importer: str, version: str):
        self.warehouse = warehouse
        self.importer = importer
        self.version = version

    def register(self, source: str, landed: DataFrame) -> dict[str, int]:
        """Record landed files (manifest rows, ``name`` being the dataset) and return their artifact ids.

        The driver gets one number per landed dataset.
        """
        wh = self.warehouse
        # files are hashed once, however often the manifest is read below
        at = scratch_path(wh.spark, "manifest")
        landed.write.parquet(at)
        landed = wh.spark.read.parquet(at)
        named = landed.select(
            F.lit(source).alias("source"), F.col("name").alias("dataset_name"), F.col("path").alias("canonical_url")
        )
        datasets = wh.save("datasets", register_datasets(wh.table("datasets"), named))
        mine = datasets.where(F.col("source") == source).select(F.col("id").alias("dataset_id"), "dataset_name")
        files = landed.withColumnRenamed("name", "dataset_name").join(mine, "dataset_name")
        rows = files.select("dataset_id", F.col("path").alias("url"), F.col("path").alias("local_path"), "sha256", "byte_len")
        artifacts = wh.save("download_artifacts", register_artifacts(wh.table("download_artifacts"), rows))
        same = files.select("dataset_name", "dataset_id", "sha256").join(
            artifacts.select("id", "dataset_id", "sha256"), ["dataset_id", "sha256"]
        )
        return {r["dataset_name"]: r["id"] for r in same.select("dataset_name", "id").collect()}

    def begin(self, artifact_id: int, force: bool = False) -> bool:
        wh = self.warehouse
        artifact = wh.table("download_artifacts").where(F.col("id") == artifact_id)
        chosen = importable(artifact, wh.table("import_runs"), self.importer, self.version, force)
        if chosen.isEmpty():
            return False
        wh.save("import_runs", begin_runs(wh.table("import_runs"), chosen, self.importer, self.version))
        return True

    def finish(self, artifact_id: int, status: str, counters: dict[str, int], error: str | None = None) -> None:
        wh = self.warehouse
        row = {
            "artifact_id": artifact_id,
            "importer_name": self.importer,
            "importer_version": self.version,
            "status": status,
            **{c: counters.get(c, 0) for c in ("rows_seen", "rows_inserted", "rows_updated", "rows_skipped")},
            "error_message": error,
        }
        runs = wh.table("import_runs")
        schema = [f for f in runs.schema.fields if f.name in row]
        outcome = wh.spark.createDataFrame(
            [tuple(row[f.name] for f in schema)], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        )
        wh.save("import_runs", finish_runs(runs, outcome))

    def guarded(self, artifact_id: int, work) -> dict[str, int]:
        """Run ``work``; its counters, or its error, go to the ledger."""
        try:
            counters = work()
        except Exception as error:
            self.finish(artifact_id, "failed", {}, str(error))
            raise
        self.finish(artifact_id, "completed", counters)
        return counters
