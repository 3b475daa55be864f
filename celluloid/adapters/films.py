"""Film tables as Spark frames, and landing files written from them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.adapters.shapes import ARRIVAL, PERSON_ENTITY, SHAPES, TITLE_ENTITY, claim_shapes, dealt, read
from celluloid.operators.mutations import upsert
from celluloid.schema import TABLES
from celluloid.session import scratch_path
from celluloid.sources.manifest import opened
from celluloid.sources.tsv import LAYOUTS
from celluloid.sources.warehouse import Tables

ARRIVAL_ORDER = tuple(ARRIVAL)
LANDED = ("a1", "a9")  # columns of the order of arrival that are asked for besides the number made of it


def shape(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    return SHAPES[name].frame(spark, sf_dir, spread)


# Tables that are made from the given ones and stored besides the credits.
STORED = (
    "titles",
    "people",
    "title_ratings",
    "episode_edges",
    "title_wikidata_links",
    "person_wikidata_links",
    "wikidata_entities",
    "wikidata_claims",
)

_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw rows as they are when they have been staged: in order of arrival, and numbered by it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _landed:
        path = scratch_path(spark, f"landed-{name}")
        made, order = SHAPES[name], list(ARRIVAL.values())
        # numbers and dates are sorted; the texts made of them are several times their size
        given = read(spark, sf_dir, made.source).where(made.filter).select("l_partkey", "l_suppkey", *order)
        rows = given.repartitionByRange(*order).sortWithinPartitions(*order)
        wanted = {c: e for c, e in made.columns.items() if c not in ARRIVAL or c in LANDED}
        rows.selectExpr(*[f"{e} AS {c}" for c, e in wanted.items()], "monotonically_increasing_id() AS _arrival").write.parquet(path)
        _landed[key] = path
    return spark.read.parquet(_landed[key])


def landed_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "credits_raw").select(*TABLES["credits"].names, "a1", "_arrival")


def credits(spark: SparkSession, sf_dir: str, cut: bool = False) -> DataFrame:
    """The lines folded by the table's key in their order of arrival: as they have landed, or with ``cut`` as they are
    given, in the one exchange that brings them to where the stored table wants them."""
    spec = TABLES["credits"]
    if cut:
        # all lines are of one source; a constant in the key would be dropped from the fold, but not from the cut
        rows, key = shape(spark, sf_dir, "credits_raw").drop("source"), [c for c in spec.key if c != "source"]
        made = upsert(None, rows, key, ARRIVAL_ORDER, spec.nullable_key, cut=True)
        return made.withColumn("source", F.expr(SHAPES["credits_raw"].columns["source"])).select(*spec.names)
    return upsert(None, landed_credits(spark, sf_dir).drop("a1"), spec.key, ["_arrival"], spec.nullable_key)


def whole_table(df: DataFrame, table: str) -> DataFrame:
    """With the table's other columns, as nulls."""
    fields = TABLES[table].schema
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in fields])


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [shape(spark, sf_dir, n) for n in ("title_entities", "person_entities", "place_entities")]
    return reduce(DataFrame.unionByName, parts).withColumn("entity_type", F.lit("item"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [s.frame(spark, sf_dir) for s in claim_shapes()])


def film_tables(spark: SparkSession, sf_dir: str) -> Tables:
    made = ("wikidata_entities", "wikidata_claims")
    frames = {n: whole_table(shape(spark, sf_dir, n), n) for n in STORED if n not in made}
    frames["wikidata_entities"] = whole_table(entities(spark, sf_dir), "wikidata_entities")
    frames["wikidata_claims"] = whole_table(claims(spark, sf_dir), "wikidata_claims")
    return Tables(spark, frames)


def land_tsv(df: DataFrame, dataset: str, path: str | None = None) -> str:
    """Write a frame as a gzip TSV landing dataset with ``\\N`` for nulls; returns its path."""
    columns = [(header, name) for header, name, _ in LAYOUTS[dataset]]
    path = path or scratch_path(df.sparkSession, f"landing-{dataset}")
    rows = df.select(*[F.coalesce(F.col(name).cast("string"), F.lit("\\N")).alias(header) for header, name in columns])
    writer = rows.write.option("sep", "\t").option("header", True).option("quote", "").option("compression", "gzip")
    writer.option("escape", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    return path


def land_lines(lines: DataFrame, name: str) -> str:
    path = scratch_path(lines.sparkSession, f"landing-{name}")
    lines.select("value").write.option("compression", "gzip").text(path)
    return path


def land_files(lines: DataFrame, key: str, path: str) -> None:
    """A text file for each key, with its lines in the order they are read in. There are as many files as keys, so
    tasks write them as streams: Spark's writer takes milliseconds of set-up for each."""
    tasks = 4 * lines.sparkSession.sparkContext.defaultParallelism

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder, system, last, file, files = f"{path}/{TaskContext.get().partitionId():05d}", None, None, None, 0
        for batch in batches:
            for name, line in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist()):
                if name != last:
                    if file:
                        file.close()
                    if not system:
                        system, plain = opened(folder)
                        system.create_dir(plain)
                    file, last, files = system.open_output_stream(f"{plain}/{name}.txt"), name, files + 1
                file.write(f"{line}\n".encode())
        if file:
            file.close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    name = F.concat(F.lit(f"{key}="), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    numbered = lines.select(name.alias("name"), "value", F.monotonically_increasing_id().alias("_read"))
    even = numbered.repartition(tasks, "name").sortWithinPartitions("name", "_read").select("name", "value")
    even.mapInArrow(write, "files long").agg(F.sum("files")).collect()  # one number


def export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "movie_export").select(
        F.col("tmdb_movie_id").alias("id"),
        (F.col("adult") == 1).alias("adult"),
        "original_title",
        "popularity",
        (F.col("video") == 1).alias("video"),
    )
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def detail_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A detail document per order, with up to four cast and two crew members, or no credits at all.

    Some members have no character, order, department or job.
    """
    orders = read(spark, sf_dir, "orders", spread=True)
    key, customer = F.col("o_orderkey"), F.col("o_custkey")

    def numbered(prefix: str, n: Column) -> Column:
        return F.concat(F.lit(prefix), n.cast("string"))

    def members(count: Column, make) -> Column:
        return F.transform(F.slice(F.array(*[F.lit(i).cast("bigint") for i in (1, 2, 3, 4)]), 1, count.cast("int")), make)

    def cast(i: Column) -> Column:
        person = customer * 7 + i
        return F.struct(
            person.alias("id"),
            numbered("Person ", person).alias("name"),
            F.when(i != 3, numbered("Role ", i)).alias("character"),
            F.when(i != 2, i - 1).alias("order"),
            F.when(i != 1, "Acting").alias("known_for_department"),
        )

    def crew(i: Column) -> Column:
        person = customer + i
        return F.struct(
            person.alias("id"),
            numbered("Person ", person).alias("name"),
            F.when(i != 2, "Directing").alias("department"),
            numbered("Job ", i).alias("job"),
        )

    tt = F.concat(F.lit("tt"), F.lpad(key.cast("string"), 10, "0"))
    credits = F.struct(members(1 + key % 4, cast).alias("cast"), members(key % 3, crew).alias("crew"))
    # the id is under external_ids in one half of the documents, on top level in the other
    doc = F.struct(
        key.alias("id"),
        numbered("Movie ", key).alias("title"),
        F.when(key % 5 != 0, numbered("Original ", key)).alias("original_title"),
        F.lit("en").alias("original_language"),
        F.to_date("o_orderdate").cast("string").alias("release_date"),
        (key % 200).alias("runtime"),
        F.col("o_totalprice").alias("popularity"),
        F.when(key % 2 == 1, tt).alias("imdb_id"),
        F.struct(F.when(key % 2 == 0, tt).alias("imdb_id")).alias("external_ids"),
        F.when(key % 8 != 0, credits).alias("credits"),
    )
    return orders.select(F.to_json(doc).alias("value"))


def _statement(value: Column) -> Column:
    return F.struct(
        F.lit("normal").alias("rank"),
        F.struct(F.lit("sample").alias("datatype"), F.struct(value.alias("value")).alias("datavalue")).alias("mainsnak"),
    )


def _entity_line(df: DataFrame, kind, wid, label, description, claims: dict) -> DataFrame:
    """One dump line per row; absent members are left out of the JSON."""
    texts = {
        member: F.when(col.isNotNull(), F.struct(F.struct(F.lit("en").alias("language"), col.alias("value")).alias("en")))
        for member, col in (("labels", label), ("descriptions", description))
    }
    doc = F.struct(
        wid.alias("id"),
        kind.alias("type"),
        *[col.alias(member) for member, col in texts.items()],
        F.struct(*[col.alias(prop) for prop, col in claims.items()]).alias("claims"),
    )
    return df.select(F.concat(F.to_json(doc), F.lit(",")).alias("value"))


def dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entities as a knowledge-base dump: brackets, trailing commas and foreign entity kinds included."""
    part, supplier, nation = (read(spark, sf_dir, n) for n in ("part", "supplier", "nation"))
    part, supplier = dealt(part), dealt(supplier)
    text = F.expr
    item = F.lit("item")
    shaped = {n: SHAPES[n].columns for n in ("title_entities", "person_entities", "place_entities")}

    own = text(SHAPES["title_wikidata_links"].columns["imdb_id"])
    second = text("'tt' || lpad(cast(p_partkey + 1 as string), 10, '0')")
    ids = F.when(F.col("p_partkey") % 9 == 0, F.array(_statement(own), _statement(second))).otherwise(
        F.array(_statement(own))
    )
    genre = F.struct(text("'Q3' || lpad(cast(p_size % 25 as string), 10, '0')").alias("id"))
    year = F.struct(text("'+' || cast(1950 + p_size as string) || '-01-01T00:00:00Z'").alias("time"))
    titles = _entity_line(
        part,
        F.when(text(TITLE_ENTITY), item).otherwise("property"),
        text(shaped["title_entities"]["wikidata_id"]),
        text(shaped["title_entities"]["label"]),
        text(shaped["title_entities"]["description"]),
        {
            "P345": ids,
            "P136": F.array(_statement(genre)),
            "P577": F.array(_statement(year)),
            "P364": F.when(F.expr("p_partkey % 2 = 0"), F.array(_statement(F.col("p_type")))),
            "P9999": F.array(_statement(F.col("p_brand"))),
        },
    )
    born = F.struct(text("'+' || cast(1900 + s_nationkey as string) || '-01-01T00:00:00Z'").alias("time"))
    place = F.struct(text("'Q3' || lpad(cast(s_nationkey as string), 10, '0')").alias("id"))
    people = _entity_line(
        supplier,
        F.when(text(PERSON_ENTITY), item).otherwise("property"),
        text(shaped["person_entities"]["wikidata_id"]),
        text(shaped["person_entities"]["label"]),
        text(shaped["person_entities"]["description"]),
        {
            "P345": F.array(_statement(text(SHAPES["person_wikidata_links"].columns["imdb_name_id"]))),
            "P569": F.array(_statement(born)),
            "P495": F.array(_statement(place)),
        },
    )
    places = _entity_line(
        nation,
        item,
        text(shaped["place_entities"]["wikidata_id"]),
        text(shaped["place_entities"]["label"]),
        text(shaped["place_entities"]["description"]),
        {"P31": F.array(_statement(F.col("n_regionkey")))},
    )
    frame = spark.range(1).select(F.explode(F.array(F.lit("["), F.lit("]"), F.lit(""))).alias("value"))
    return reduce(DataFrame.unionByName, [titles, people, places, frame])


def odd_dump_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dump lines with the value kinds, languages and wrong types that ``dump_lines`` has none of, one case per
    remainder of the part's number by six."""
    item = "'Q4' || lpad(cast(p_partkey as string), 10, '0')"

    def statement(value: str, datatype: str) -> str:
        return f'{{"rank":"preferred","mainsnak":{{"datatype":"{datatype}","datavalue":{{"value":{value}}}}}}}'

    def texts(**by_language: str) -> str:
        return "{" + ",".join(f'"{k}":{{"language":"{k}","value":{v}}}' for k, v in by_language.items()) + "}"

    many = statement('{"text":"Titel @@","language":"de"}', "monolingualtext")
    amount, number, truth = statement('{"amount":"+@@","unit":"1"}', "quantity"), statement("@@", "number"), statement("true", "bool")
    linked = statement('{"id":"Q30000000001","time":"+1"}', "item")
    rest = {
        0: f'"labels":{texts(en='"name @@"', de='"Name @@"')},"descriptions":{texts(fr='"nom"')},"claims":{{"P364":[{many}],"P9":[{many}]}}',
        1: f'"labels":{texts(en='"name @@"')},"claims":{{"P577":[{amount},{many}]}}',
        2: f'"labels":[],"descriptions":"none","claims":{{"P136":{{"a":1}},"P57":[{linked}]}}',
        3: f'"labels":{texts(de='"Name @@"', en='7')},"claims":{{"P495":[{{"mainsnak":null}},{number},7,{truth}]}}',
        4: f'"labels":{texts(de='5', en='"name @@"')},"claims":{{"P31":[{truth}]}}',
        5: '"descriptions":{"de":null},"claims":[]',
    }
    made = "case p_partkey % 6 " + " ".join(f"when {k} then '{v}'" for k, v in rest.items()) + " end"
    line = F.expr(f"'{{\"id\":\"' || {item} || '\",\"type\":\"item\",' || replace({made}, '@@', cast(p_partkey as string)) || '}},'")
    return dealt(read(spark, sf_dir, "part")).select(line.alias("value"))
