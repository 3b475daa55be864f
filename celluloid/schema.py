"""Fixed table shapes, upsert keys and vocabulary.

Warehouse tables keep comma lists, dates and JSON as text, as they arrive in the landing files;
operators split them only where they need the parts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType(), "double": T.DoubleType(), "timestamp": T.TimestampType()}


@dataclass(frozen=True)
class Table:
    """One warehouse table: columns as ``name type``, upsert key, and key columns that may be null."""

    columns: str
    key: tuple[str, ...]
    nullable_key: tuple[str, ...] = ()
    layout: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        fields = (c.split() for c in self.columns.split(","))
        return T.StructType([T.StructField(n, _TYPES[t]) for n, t in fields])

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def sort(self) -> tuple[str, ...]:
        """Columns the table is clustered by on disk, so that id filters skip row groups."""
        return self.layout or self.key


# The 19 warehouse tables.
TABLES: dict[str, Table] = {
    "datasets": Table(
        "id long, source string, dataset_name string, canonical_url string, license_note string, created_at timestamp",
        ("source", "dataset_name"),
    ),
    "download_artifacts": Table(
        "id long, dataset_id long, url string, local_path string, sha256 string, byte_len long, etag string, last_modified string, fetched_at timestamp",
        ("dataset_id", "sha256"),
    ),
    "import_runs": Table(
        "id long, artifact_id long, importer_name string, importer_version string, started_at timestamp, finished_at timestamp, status string, "
        "rows_seen long, rows_inserted long, rows_updated long, rows_skipped long, error_message string",
        ("artifact_id", "importer_name", "importer_version"),
    ),
    "titles": Table(
        "imdb_id string, title_type string, primary_title string, original_title string, is_adult long, start_year long, end_year long, "
        "runtime_minutes long, genres string",
        ("imdb_id",),
    ),
    "people": Table(
        "imdb_name_id string, primary_name string, birth_year long, death_year long, primary_professions string, known_for_titles string",
        ("imdb_name_id",),
    ),
    "title_ratings": Table("imdb_id string, average_rating double, num_votes long", ("imdb_id",)),
    "title_akas": Table(
        "imdb_id string, ordering long, title string, region string, language string, types string, attributes string, is_original_title long",
        ("imdb_id", "ordering", "title"),
        nullable_key=("ordering",),
    ),
    "title_crew": Table("imdb_id string, directors string, writers string", ("imdb_id",)),
    "credits": Table(
        "imdb_id string, imdb_name_id string, ordering long, category string, job string, characters string, source string",
        ("imdb_id", "imdb_name_id", "ordering", "category", "source"),
        nullable_key=("ordering", "category"),
    ),
    "episode_edges": Table(
        "imdb_id string, parent_imdb_id string, season_number long, episode_number long", ("imdb_id",)
    ),
    "tmdb_movie_exports": Table(
        "export_artifact_id long, tmdb_movie_id long, adult long, original_title string, popularity double, video long, "
        "hydrate_status string, hydrate_attempts long, last_error string, hydrated_at timestamp",
        ("export_artifact_id", "tmdb_movie_id"),
    ),
    "tmdb_movies": Table(
        "tmdb_movie_id long, imdb_id string, title string, original_title string, original_language string, overview string, "
        "release_date string, runtime_minutes long, status string, popularity double, vote_average double, vote_count long, "
        "raw_json string, hydrated_at timestamp",
        ("tmdb_movie_id",),
    ),
    "tmdb_people": Table("tmdb_person_id long, name string", ("tmdb_person_id",)),
    "tmdb_movie_credits": Table(
        "tmdb_movie_id long, tmdb_person_id long, credit_key string, cast_order long, credit_kind string, department string, job string, "
        "character_name string, raw_json string",
        ("tmdb_movie_id", "credit_key"),
    ),
    "title_tmdb_links": Table("imdb_id string, tmdb_movie_id long, linked_via string, linked_at timestamp", ("imdb_id",)),
    "wikidata_entities": Table(
        "wikidata_id string, label string, description string, entity_type string", ("wikidata_id",)
    ),
    "title_wikidata_links": Table("imdb_id string, wikidata_id string, linked_via string, linked_at timestamp", ("imdb_id",)),
    "person_wikidata_links": Table(
        "imdb_name_id string, wikidata_id string, linked_via string, linked_at timestamp", ("imdb_name_id",)
    ),
    "wikidata_claims": Table(
        "subject_wikidata_id string, property_id string, value_type string, value_text string, value_wikidata_id string, datatype string, "
        "rank_name string, ordinal long, raw_json string",
        (
            "subject_wikidata_id",
            "property_id",
            "ordinal",
            "value_type",
            "value_text",
            "value_wikidata_id",
        ),
        nullable_key=("value_text", "value_wikidata_id"),
    ),
}

# Names the row-count profile reports some tables under.
STATS_NAMES = {"download_artifacts": "artifacts"}

# Claim properties that are imported, and the one holding film-database ids.
CLAIM_PROPERTIES = ("P31", "P57", "P161", "P136", "P364", "P495", "P577", "P569", "P570")
EXTERNAL_ID_PROPERTY = "P345"

# Credit category -> graph role. Other categories have no role.
ROLES = {
    "director": "director",
    "actor": "actor",
    "actress": "actor",
    "writer": "writer",
    "producer": "producer",
}

# Public RDF vocabulary.
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
SCHEMA_ORG = "https://schema.org/"
ENTITY_BASE = "https://www.wikidata.org/entity/"
PROPERTY_BASE = "https://www.wikidata.org/prop/direct/"
XSD = "http://www.w3.org/2001/XMLSchema#"

# Predicates that live under schema.org; all others live under the local base IRI.
SCHEMA_ORG_PREDICATES = ("name", "director", "actor", "datePublished", "sameAs")

DEFAULT_BASE_IRI = "https://films.example/"

TRIPLE_SCHEMA = T.StructType(
    [
        T.StructField("s", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("o", T.StringType()),
        T.StructField("o_kind", T.StringType()),
        T.StructField("o_type", T.StringType()),
        T.StructField("o_num", T.DoubleType()),
    ]
)


def table_schema(name: str) -> T.StructType:
    return TABLES[name].schema
