"""The Parquet warehouse: one folder per table, one numbered sub-folder per version.

The current version is the highest one whose write was committed (Spark leaves ``_SUCCESS`` last),
so readers see the old or the new table, a failed save changes nothing, and a table may be
overwritten from a plan that reads it.

Files are cut by range of the table's id columns, so their footers prune. Tables that are also asked from
another id have a copy in that order under the same version number; other id columns have Parquet Bloom
filters. Row counts are taken from the footers. The ids that imports are checked against are also kept in
buckets, so that a check does not shuffle them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.schema import STATS_NAMES, TABLES, table_schema


# Tables that are also kept in the order of another id column.
COPIES = {
    "credits": ("imdb_name_id",),
    "episode_edges": ("parent_imdb_id",),
    "title_wikidata_links": ("wikidata_id",),
    "person_wikidata_links": ("wikidata_id",),
}
# Id columns by which a table is asked, but not cut.
BLOOM_FILTERS = {
    "credits": ("imdb_name_id",),
    "title_tmdb_links": ("tmdb_movie_id",),
    "tmdb_movies": ("imdb_id",),
    "tmdb_movie_credits": ("tmdb_person_id",),
    "tmdb_movie_exports": ("tmdb_movie_id",),
    "wikidata_claims": ("value_wikidata_id",),
    "download_artifacts": ("sha256",),
}
# Tables whose rows are replaced parent by parent: they lie in folders by a hash of the parent, and a batch
# rewrites the folders of its parents only.
PARTED = {"tmdb_movie_credits": "tmdb_movie_id"}
PARTS = 64
# Tables that others refer to.
REFERRED = ("titles", "people")
BUCKET_ROWS = 500_000
V1_SOURCES, PUSH_DOWN = "spark.sql.sources.useV1SourceList", "spark.sql.parquet.aggregatePushdown"


class Tables:
    """Warehouse view over DataFrames held by name; a missing table is empty."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]):
        self.spark = spark
        self._frames = dict(frames)

    def table(self, name: str) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        return self.spark.createDataFrame([], table_schema(name))

    def counted(self, name: str) -> DataFrame:
        return self.table(name)

    def keys(self, name: str) -> DataFrame:
        """The ids of a table with one id column."""
        return self.table(name).select(*TABLES[name].key)

    def ordered(self, name: str, column: str) -> DataFrame:
        """The table laid out by one of its other id columns, where there is such a copy."""
        copy = f"{name}-by-{column}"
        return self._frames[copy] if copy in self._frames else self.table(name)

    def with_tables(self, **frames: DataFrame) -> Tables:
        return Tables(self.spark, {**self._frames, **frames})


class Warehouse(Tables):
    """Tables stored under ``root``, a path of any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, {})
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path

    def version(self, name: str) -> int:
        """Number of the current version, 0 for a table never saved."""
        fs, pattern = self._fs(f"{self.root}/{name}/v*/_SUCCESS")
        return max((int(f.getPath().getParent().getName()[1:]) for f in fs.globStatus(pattern) or []), default=0)

    def _folder(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version:08d}"

    def table(self, name: str) -> DataFrame:
        version = self.version(name)
        if not version:
            return super().table(name)
        return self._in_parts(name, version).drop("part") if name in PARTED else self.spark.read.schema(table_schema(name)).parquet(self._folder(name, version))

    def _in_parts(self, name: str, version: int) -> DataFrame:
        return self.spark.read.schema(table_schema(name).add("part", "integer")).parquet(self._folder(name, version))

    def replace(self, name: str, parents: DataFrame, children: DataFrame) -> DataFrame:
        """Drop the rows of the parents and add the children, which are theirs. Only folders that hold one of the parents
        are read and written, each is exchanged whole, and all others keep their files."""
        version, key = self.version(name), PARTED[name]
        rows = children.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name].schema])
        if not version:
            return self.save(name, rows)
        owners = parents.select(key).distinct()
        touched = [r["part"] for r in owners.select(_part(key).alias("part")).distinct().collect()]  # PARTS at most
        kept = self._in_parts(name, version).where(F.col("part").isin(touched)).join(owners, key, "left_anti")
        made = kept.select(*rows.columns, "part").unionByName(rows.withColumn("part", _part(key)))
        folder = self._folder(name, version)
        with self._staged(made) as fresh:
            sorted_rows = fresh.repartition("part").sortWithinPartitions("part", *TABLES[name].sort)
            sorted_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(folder)
            left = {r["part"] for r in fresh.select("part").distinct().collect()}
        fs, _ = self._fs(folder)
        for part in sorted(set(touched) - left):  # nothing is left of these
            fs.delete(self._fs(f"{folder}/part={part}")[1], True)
        return self.table(name)

    @contextmanager
    def _staged(self, rows: DataFrame):
        """Rows written once: cutting by range looks at its input twice, and rows that take a join or a fold to
        make would be made twice."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        yield self.spark.read.schema(rows.schema).parquet(path)
        fs, folder = self._fs(path)
        fs.delete(folder, True)

    def save(self, name: str, df: DataFrame, cut: bool = False) -> DataFrame:
        """Write a new version, clustered by the table's id columns, and with that make it current. Rows that are
        ``cut`` by range of these columns already are written as they lie."""
        spec = TABLES[name]
        made = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])
        sort = list(spec.sort)
        filters = {f"parquet.bloom.filter.enabled#{c}": "true" for c in BLOOM_FILTERS.get(name, ())}
        with nullcontext(made) if cut else self._staged(made) as rows:
            # by range, so that a file's footer tells which ids it can hold; rows of a hot id are cut by the other keys
            even = rows if cut else rows.repartitionByRange(*sort)
            folder = self._folder(name, self.version(name) + 1)
            if name in PARTED:
                even = rows.withColumn("part", _part(PARTED[name])).repartitionByRange("part", *sort)
                even.sortWithinPartitions("part", *sort).write.mode("overwrite").options(**filters).partitionBy("part").parquet(folder)
            else:
                even.sortWithinPartitions(*sort).write.mode("overwrite").options(**filters).parquet(folder)
            saved = self.table(name)
            for column in COPIES.get(name, ()):
                # made from the same rows, under the same number; until it is there, readers take the table
                order = (column, *(c for c in sort if c != column))
                copy = (saved if cut else rows).repartitionByRange(*order).sortWithinPartitions(*order)
                copy.write.mode("overwrite").parquet(self._folder(f"{name}-by-{column}", self.version(name)))
        if name in REFERRED:
            self._save_keys(name)
        return saved

    def _save_keys(self, name: str) -> None:
        """The ids in as many buckets as a shuffle has partitions, or more: then it is the other side that moves."""
        [key], version = TABLES[name].key, self.version(name)
        rows = self.counted(name).count()
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
        folder = f"{self.root}/{name}-keys/v{version:08d}-{buckets}"
        ids = self.table(name).select(key).repartition(buckets, key)
        writer = ids.write.mode("overwrite").option("path", folder).bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(self._catalogued(folder))

    @staticmethod
    def _catalogued(folder: str) -> str:
        """Spark knows buckets of tables in its catalog only; the name there follows from the folder."""
        return f"celluloid_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"

    def keys(self, name: str) -> DataFrame:
        version = self.version(name)
        fs, pattern = self._fs(f"{self.root}/{name}-keys/v{version:08d}-*/_SUCCESS")
        found = list(fs.globStatus(pattern) or []) if version else []
        if not found:
            return super().keys(name)
        [key], path = TABLES[name].key, found[0].getPath().getParent()
        buckets = path.getName().rpartition("-")[2]
        folder = f"{self.root}/{name}-keys/{path.getName()}"
        table = self._catalogued(folder)
        if not self.spark.catalog.tableExists(table):  # written by another session
            self.spark.sql(f"CREATE TABLE {table} ({key} STRING) USING parquet OPTIONS (path '{folder}') CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")
        return self.spark.table(table)

    def counted(self, name: str) -> DataFrame:
        """The table as the aggregating reader sees it: ``count(*)`` of it is taken from the footers, and no column is read."""
        version = self.version(name)
        if not version or name in PARTED:
            return self.table(name)
        conf = self.spark.conf
        conf.set(PUSH_DOWN, "true")  # for this reader only; the other one does not know it
        before = conf.get(V1_SOURCES)
        conf.set(V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet"))
        try:
            return self.spark.read.schema(table_schema(name)).parquet(self._folder(name, version))
        finally:
            conf.set(V1_SOURCES, before)

    def ordered(self, name: str, column: str) -> DataFrame:
        version = self.version(name)
        if not version or self.version(f"{name}-by-{column}") != version:
            return self.table(name)
        return self.spark.read.schema(table_schema(name)).parquet(self._folder(f"{name}-by-{column}", version))


def _part(key: str):
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def warehouse_stats(warehouse: Tables, names: list[str] | None = None) -> DataFrame:
    """Row count per table: one row (table_name, row_count) each."""
    parts = [
        warehouse.counted(name).agg(
            F.lit(STATS_NAMES.get(name, name)).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        for name in names or list(TABLES)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("table_name", "row_count")
