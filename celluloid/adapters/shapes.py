"""How the given tables are read as film tables.

Each shape is a projection that Spark and DuckDB spell the same way; it only renames and formats
input. What is under test is built on top: by operators in ``queries``, by plain SQL in ``oracle``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _id(prefix: str, column: str) -> str:
    return f"'{prefix}' || lpad(cast({column} as string), 10, '0')"


def tt(column: str) -> str:
    return _id("tt", column)


def nm(column: str) -> str:
    return _id("nm", column)


def title_entity(column: str) -> str:
    return _id("Q1", column)


def person_entity(column: str) -> str:
    return _id("Q2", column)


def place_entity(column: str) -> str:
    return _id("Q3", column)


@dataclass(frozen=True)
class Shape:
    """``SELECT columns FROM source WHERE filter [GROUP BY group]``."""

    source: str
    columns: dict[str, str]
    filter: str = "true"
    group: str = ""

    def sql(self) -> str:
        select = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        group = f" GROUP BY {self.group}" if self.group else ""
        return f"SELECT {select} FROM {self.source} WHERE {self.filter}{group}"

    def frame(self, spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
        rows = read(spark, sf_dir, self.source, spread).where(self.filter)
        if not self.group:
            return rows.selectExpr(*[f"{expr} AS {name}" for name, expr in self.columns.items()])
        return spark.sql(self.sql().replace(f"FROM {self.source}", "FROM {rows}"), rows=rows)


SPREAD_BY = {"lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id"}

_frames: dict[tuple[str, str], DataFrame] = {}


def read(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; its file footer is read once per session.

    The large ones come as one file with one row group, which is one task however many cores there
    are. With ``spread``, for costly work ahead, such a file is dealt out by a key of its own first;
    a table of many files is read as it is.
    """
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _frames:
        _frames[key] = spark.read.parquet(key[1])
    table = _frames[key]
    if spread:
        return table.repartition(spark.sparkContext.defaultParallelism, SPREAD_BY[name])
    return table


def dealt(rows: DataFrame) -> DataFrame:
    """The rows in the order they are read in, dealt out to all cores: what one task reads would be one landing
    file, which is one task again. Files written from them arrive in the same order."""
    numbered = rows.withColumn("_read", F.monotonically_increasing_id())
    ranges = numbered.repartitionByRange(rows.sparkSession.sparkContext.defaultParallelism, "_read")
    return ranges.sortWithinPartitions("_read").drop("_read")


CATEGORY = (
    "case l_orderkey % 6 when 0 then 'director' when 1 then 'actor' when 2 then 'actress' "
    "when 3 then 'writer' when 4 then 'producer' else 'composer' end"
)

# order of arrival of lines: a total order of the rows of lineitem
ARRIVAL = {
    "a1": "l_orderkey",
    "a2": "l_linenumber",
    "a3": "l_extendedprice",
    "a4": "l_shipdate",
    "a5": "l_quantity",
    "a6": "l_discount",
    "a7": "l_tax",
    "a8": "l_returnflag",
    "a9": "l_linestatus",
}

TITLE_ENTITY = "p_partkey % 3 <> 1"
PERSON_ENTITY = "s_suppkey % 20 <> 7"
NO_TEXT = "cast(null as string)"

SHAPES: dict[str, Shape] = {
    "titles": Shape(
        "part",
        {
            "imdb_id": tt("p_partkey"),
            "title_type": "lower(p_type)",
            "primary_title": "p_name",
            "original_title": "case when p_partkey % 7 = 0 then null else p_name || ' ' || p_brand end",
            "is_adult": "cast(case when p_partkey % 50 = 0 then 1 else 0 end as bigint)",
            "start_year": "cast(case when p_size % 10 = 0 then null else 1950 + p_size end as bigint)",
            "end_year": "cast(null as bigint)",
            "runtime_minutes": "cast(p_size as bigint)",
            "genres": "p_brand || ',' || p_type",
        },
    ),
    "people": Shape(
        "supplier",
        {
            "imdb_name_id": nm("s_suppkey"),
            "primary_name": "s_name",
            "birth_year": "cast(1900 + s_nationkey as bigint)",
            "death_year": "cast(case when s_nationkey % 2 = 0 then null else 1980 + s_nationkey end as bigint)",
            "primary_professions": "case s_suppkey % 3 when 0 then 'director,writer' when 1 then 'actor,producer' end",
            "known_for_titles": NO_TEXT,
        },
    ),
    # a missing ordering never conflicts with anything
    "credits_raw": Shape(
        "lineitem",
        {
            "imdb_id": tt("l_partkey"),
            "imdb_name_id": nm("l_suppkey"),
            "ordering": "cast(case when l_orderkey % 97 = 0 then null else l_linenumber end as bigint)",
            "category": CATEGORY,
            "job": "case when l_returnflag = 'N' then null else l_returnflag end",
            "characters": "case when l_orderkey % 6 in (1, 2) then '[\"role ' || cast(l_orderkey as string) || '\"]' end",
            "source": "'imdb'",
            **ARRIVAL,
        },
    ),
    "akas_raw": Shape(
        "lineitem",
        {
            "imdb_id": tt("l_partkey"),
            "ordering": "cast(case when l_linenumber = 7 then null else l_linenumber end as bigint)",
            "title": "'aka ' || l_returnflag",
            "region": "l_linestatus",
            "language": NO_TEXT,
            "types": "case when l_linestatus = 'F' then 'alternative' end",
            "attributes": NO_TEXT,
            "is_original_title": "cast(case when l_linenumber = 1 then 1 else 0 end as bigint)",
            **ARRIVAL,
        },
    ),
    "title_ratings": Shape(
        "lineitem",
        {
            "imdb_id": tt("l_partkey"),
            # avg(l_quantity) / 5 to one decimal, half up, in whole numbers
            "average_rating": "cast(floor((4 * sum(l_quantity) + count(*)) / (2 * count(*))) as double) / 10",
            "num_votes": "count(*)",
        },
        group="l_partkey",
    ),
    # lists with one, two or three members; an empty and a repeated member among them
    "title_crew": Shape(
        "part",
        {
            "imdb_id": tt("p_partkey"),
            "directors": f"case p_size % 4 when 1 then {nm('p_partkey % 100')} when 2 then {nm('p_size')} || ',' || "
            f"{nm('p_partkey % 100')} when 3 then {nm('p_size')} || ',,' || {nm('p_size')} end",
            "writers": f"case when p_partkey % 3 = 0 then {nm('p_size')} || ',' || {nm('p_size + 1')} end",
        },
    ),
    "episode_edges": Shape(
        "part",
        {
            "imdb_id": tt("p_partkey"),
            "parent_imdb_id": tt("p_partkey - p_partkey % 5"),
            "season_number": "cast(p_size as bigint)",
            "episode_number": "cast(p_partkey % 5 as bigint)",
        },
        "p_partkey % 5 <> 0",
    ),
    # titles and people that count as known where references are checked
    "known_titles": Shape("part", {"imdb_id": tt("p_partkey")}, "p_partkey % 10 <> 0"),
    "known_people": Shape("supplier", {"imdb_name_id": nm("s_suppkey")}, "s_suppkey % 10 <> 0"),
    "movie_export": Shape(
        "orders",
        {
            "tmdb_movie_id": "o_orderkey",
            "adult": "cast(case when o_orderstatus = 'P' then 1 else 0 end as bigint)",
            "original_title": "case when o_orderkey % 11 = 0 then null else 'Movie ' || cast(o_orderkey as string) end",
            "popularity": "o_totalprice",
            "video": "cast(case when o_orderkey % 4 = 0 then 1 else 0 end as bigint)",
        },
    ),
    "hydrated": Shape("orders", {"tmdb_movie_id": "o_orderkey"}, "o_orderkey % 3 = 0"),
    "title_entities": Shape(
        "part",
        {
            "wikidata_id": title_entity("p_partkey"),
            "label": "case when p_partkey % 4 = 0 then null else p_name end",
            "description": "p_brand",
        },
        TITLE_ENTITY,
    ),
    "person_entities": Shape(
        "supplier",
        {"wikidata_id": person_entity("s_suppkey"), "label": "s_name", "description": NO_TEXT},
        PERSON_ENTITY,
    ),
    "place_entities": Shape(
        "nation",
        {
            "wikidata_id": place_entity("n_nationkey"),
            "label": "case when n_nationkey % 5 = 0 then null else n_name end",
            "description": NO_TEXT,
        },
    ),
    "title_wikidata_links": Shape(
        "part", {"imdb_id": tt("p_partkey"), "wikidata_id": title_entity("p_partkey")}, TITLE_ENTITY
    ),
    "person_wikidata_links": Shape(
        "supplier", {"imdb_name_id": nm("s_suppkey"), "wikidata_id": person_entity("s_suppkey")}, PERSON_ENTITY
    ),
    "artifacts": Shape(
        "documents",
        {
            "id": "doc_id + 1",
            "dataset_id": "cast(substr(source, 4) as bigint) + 1",
            "url": "'file:///landing/' || cast(doc_id as string)",
            "byte_len": "n_chars",
        },
    ),
    "datasets": Shape(
        "documents",
        {
            "id": "cast(substr(source, 4) as bigint) + 1",
            "source": "case when cast(substr(source, 4) as bigint) % 2 = 0 then 'imdb' else 'tmdb' end",
            "dataset_name": "source",
        },
        group="source",
    ),
    "runs": Shape(
        "labels",
        {
            "artifact_id": "doc_id + 1",
            "importer_name": "case when toxic = 1 then 'other' else 'loader' end",
            "importer_version": "'1'",
            "status": "case when quality = 1 then 'completed' else 'failed' end",
        },
    ),
}


# Claims per kind of entity: (property, value type, value text, value entity, filter).
CLAIMS: tuple[tuple[str, str, str, str, str, str, str], ...] = (
    ("part", title_entity("p_partkey"), "P136", "wikidata_item", NO_TEXT, place_entity("p_size % 25"), TITLE_ENTITY),
    (
        "part",
        title_entity("p_partkey"),
        "P577",
        "time",
        "'+' || cast(1950 + p_size as string) || '-01-01T00:00:00Z'",
        NO_TEXT,
        TITLE_ENTITY,
    ),
    ("part", title_entity("p_partkey"), "P364", "string", "p_type", NO_TEXT, TITLE_ENTITY + " and p_partkey % 2 = 0"),
    (
        "supplier",
        person_entity("s_suppkey"),
        "P569",
        "time",
        "'+' || cast(1900 + s_nationkey as string) || '-01-01T00:00:00Z'",
        NO_TEXT,
        PERSON_ENTITY,
    ),
    ("supplier", person_entity("s_suppkey"), "P495", "wikidata_item", NO_TEXT, place_entity("s_nationkey"), PERSON_ENTITY),
)


def claim_shapes() -> list[Shape]:
    return [
        Shape(
            source,
            {
                "subject_wikidata_id": subject,
                "property_id": f"'{prop}'",
                "ordinal": "cast(0 as bigint)",
                "value_type": f"'{kind}'",
                "value_text": text,
                "value_wikidata_id": entity,
            },
            filter_,
        )
        for source, subject, prop, kind, text, entity, filter_ in CLAIMS
    ]
