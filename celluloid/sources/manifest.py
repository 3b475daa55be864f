"""Identity of landed files and choice of the dated snapshot."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from datetime import date
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.functions.parse import snapshot_name

CHUNK = 8 << 20  # bytes of a file that are held at a time


def artifact_manifest(spark: SparkSession, glob: str, names: str | None = None) -> DataFrame:
    """(path, name, sha256, byte_len) of landed files, whatever their size. With ``names``, of all files of such
    names in the folder and below it, whose folders are listed by tasks and not one by one by the driver.

    The file source lists the paths without reading any content; each file is then read as a stream by
    one task, which keeps a running hash. The source leaves out empty files.
    """
    reader = spark.read.format("binaryFile")
    if names:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", names)
    files = reader.load(glob).select("path", F.col("length").alias("byte_len"))
    size, tasks = CHUNK, 4 * spark.sparkContext.defaultParallelism  # the rows are few bytes, their files may be many or large

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column("path").to_pylist():
                system, plain = opened(path)
                running = hashlib.sha256()
                with system.open_input_stream(plain, compression=None) as file:
                    while chunk := file.read(size):
                        running.update(chunk)
                made.append(running.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["path", "byte_len", "sha256"])

    hashed = files.repartition(tasks, "path").mapInArrow(hashes, "path string, byte_len long, sha256 string")
    return hashed.select("path", F.substring_index("path", "/", -1).alias("name"), "sha256", "byte_len")


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and plain path of a listed file; the source lists paths percent-encoded."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote("/" + uri.removeprefix("file:").lstrip("/"))
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1)) if "://" in uri else (fs.LocalFileSystem(), uri)


def snapshot_candidates(spark: SparkSession, day: date, days_back: int) -> DataFrame:
    """(day, name) of the dated exports to try, newest first."""
    until = F.lit(day).cast("date")
    days = spark.range(1).select(F.explode(F.sequence(F.date_sub(until, days_back), until)).alias("day"))
    return days.select("day", snapshot_name(F.col("day")).alias("name")).orderBy(F.desc("day"))


def latest_snapshot(manifest: DataFrame, day: date, days_back: int) -> DataFrame:
    """The newest dated export of the window that is in the manifest (column ``name``)."""
    wanted = snapshot_candidates(manifest.sparkSession, day, days_back)
    # the candidate list has days_back + 1 rows
    return manifest.join(F.broadcast(wanted), "name", "inner").orderBy(F.desc("day")).limit(1)
