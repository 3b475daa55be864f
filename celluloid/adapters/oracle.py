"""Plain SQL for the registered queries, over the given tables, for DuckDB."""

from __future__ import annotations

from celluloid.adapters.queries import (
    ENTITY,
    EPISODE,
    LINKED_PERSON,
    PERSON,
    SERIES,
    SNAPSHOT_BACK,
    SNAPSHOT_DAY,
    VOCAB,
)
from celluloid.adapters.shapes import ARRIVAL, SHAPES, claim_shapes
from celluloid.operators.search import K1, B
from celluloid.schema import ENTITY_BASE, PROPERTY_BASE, STATS_NAMES, TABLES

NAME = VOCAB.predicate("name")
LATEST = ", ".join(f"{c} DESC" for c in ARRIVAL)
EARLIEST = ", ".join(ARRIVAL)
CREDIT_KEY = "imdb_id, imdb_name_id, ordering, category, source"
CREDIT_COLUMNS = "imdb_id, imdb_name_id, ordering, category, job, characters, source"


def _ranked(source: str, columns: str, key: str, order: str, nullable: str) -> str:
    """First row per key in an order; rows with a null in the key all stay."""
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) "
        f"WHERE rn = 1 OR {nullable} IS NULL"
    )


# Common table expressions; each may use those above it.
CTES: dict[str, str] = {name: shape.sql() for name, shape in SHAPES.items()}
CTES["credits"] = _ranked("credits_raw", CREDIT_COLUMNS, CREDIT_KEY, LATEST, "ordering")
CTES["entities"] = (
    "SELECT * FROM title_entities UNION ALL SELECT * FROM person_entities UNION ALL SELECT * FROM place_entities"
)
CTES["claims"] = " UNION ALL ".join(s.sql() for s in claim_shapes())
CTES["crew"] = CTES["title_crew"]
CTES["roles"] = (
    "SELECT imdb_id, imdb_name_id, 'participant' AS role FROM credits UNION ALL "
    "SELECT imdb_id, imdb_name_id, CASE category WHEN 'actress' THEN 'actor' ELSE category END FROM credits "
    "WHERE category <> 'composer'"
)


def _iri(name: str) -> str:
    return f"'{VOCAB.predicate(name)}'"


def _triples_sql() -> str:
    """Every triple as written, with its family."""
    title = f"'{VOCAB.title_base}' || imdb_id"
    person = f"'{VOCAB.person_base}' || imdb_name_id"
    rows: list[str] = []

    def add(family, source, s, p, o, kind="literal", type_name="string", num="NULL"):
        rows.append(
            f"SELECT '{family}' AS family, {s} AS s, {p} AS p, CAST({o} AS VARCHAR) AS o, '{kind}' AS o_kind, "
            f"'{type_name}' AS o_type, CAST({num} AS DOUBLE) AS o_num FROM {source} WHERE {o} IS NOT NULL"
        )

    def iri(family, source, s, p, o):
        add(family, source, s, p, o, "iri", "")

    def whole(family, source, s, p, o):
        add(family, source, s, p, o, "literal", "integer", o)

    iri("title", "titles", title, _iri("type"), f"'{VOCAB.movie}'")
    add("title", "titles", title, _iri("name"), "primary_title")
    add("title", "titles", title, _iri("titleType"), "title_type")
    whole("title", "titles", title, _iri("datePublished"), "start_year")
    add("title", "titles", title, _iri("originalTitle"), "original_title")
    iri("person", "people", person, _iri("type"), f"'{VOCAB.person}'")
    add("person", "people", person, _iri("name"), "primary_name")
    whole("person", "people", person, _iri("birthYear"), "birth_year")
    whole("person", "people", person, _iri("deathYear"), "death_year")
    role = " ".join(f"WHEN '{r}' THEN {_iri(r)}" for r in ("participant", "director", "actor", "writer", "producer"))
    iri("credit", "roles", title, f"CASE role {role} END", person)
    iri("episode", "episode_edges", title, _iri("partOfSeries"), f"'{VOCAB.title_base}' || parent_imdb_id")
    whole("episode", "episode_edges", title, _iri("seasonNumber"), "season_number")
    whole("episode", "episode_edges", title, _iri("episodeNumber"), "episode_number")
    lexical = "CASE WHEN average_rating = floor(average_rating) THEN CAST(CAST(average_rating AS BIGINT) AS VARCHAR) ELSE CAST(average_rating AS VARCHAR) END"
    add("rating", "title_ratings", title, _iri("averageRating"), lexical, "literal", "double", "average_rating")
    whole("rating", "title_ratings", title, _iri("voteCount"), "num_votes")
    entity = f"'{ENTITY_BASE}' || wikidata_id"
    iri("link", "linked", "local_iri", _iri("sameAs"), entity)
    add("link", "linked", entity, _iri("name"), "label")
    add("link", "linked", entity, _iri("description"), "description")
    value = f"'{ENTITY_BASE}' || value_wikidata_id"
    prop = f"'{PROPERTY_BASE}' || property_id"
    add("claim", "linked_claims", value, _iri("name"), "value_label")
    iri("claim", "linked_claims", "local_iri", prop, value)
    add("claim", "linked_claims WHERE value_wikidata_id IS NULL AND true", "local_iri", prop, "value_text")
    rows[-1] = rows[-1].replace("AND true WHERE", "AND")
    return " UNION ALL ".join(rows)


CTES["linked"] = (
    f"SELECT l.*, e.label, e.description FROM (SELECT '{VOCAB.title_base}' || imdb_id AS local_iri, wikidata_id "
    f"FROM title_wikidata_links UNION ALL SELECT '{VOCAB.person_base}' || imdb_name_id, wikidata_id FROM person_wikidata_links) l "
    "JOIN entities e USING (wikidata_id)"
)
CTES["linked_claims"] = (
    "SELECT l.local_iri, c.*, v.label AS value_label FROM claims c JOIN linked l ON l.wikidata_id = c.subject_wikidata_id "
    "LEFT JOIN entities v ON v.wikidata_id = c.value_wikidata_id"
)
CTES["written"] = _triples_sql()
CTES["triples"] = "SELECT DISTINCT s, p, o, o_kind, o_type, o_num FROM written"
CTES["names"] = f"SELECT s AS node, o AS name FROM triples WHERE p = '{NAME}'"
CTES["cast_pairs"] = (
    f"SELECT s AS title, o AS person FROM triples WHERE p = '{VOCAB.predicate('participant')}'"
)

TRIPLE_NAMES = (
    "titles",
    "people",
    "credits_raw",
    "credits",
    "roles",
    "episode_edges",
    "title_ratings",
    "title_wikidata_links",
    "person_wikidata_links",
    "title_entities",
    "person_entities",
    "place_entities",
    "entities",
    "claims",
    "linked",
    "linked_claims",
    "written",
    "triples",
    "names",
    "cast_pairs",
)


def sql(names: str, body: str, **extra: str) -> str:
    """A statement with the named common table expressions in front."""
    ctes = [f"{n} AS ({CTES[n]})" for n in names.split()] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def on_triples(body: str, **extra: str) -> str:
    return sql(" ".join(TRIPLE_NAMES), body, **extra)


def _last(column: str) -> str:
    return f"regexp_extract({column}, '[^/]*$')"


# --- search


def _tokens(parts: str) -> dict[str, str]:
    """Token occurrences and field lengths of parts (id, field, part, text)."""
    return {
        "parts": parts,
        "split": "SELECT id, field, part, list_filter(regexp_split_to_array(text, '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS ws "
        "FROM parts WHERE text IS NOT NULL",
        "placed": "SELECT id, field, part, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM split",
        "occ": "SELECT id, field, part, lower(word) AS term, pos FROM placed WHERE strlen(word) < 40",
        "lens": "SELECT id, field, count(*) AS len FROM occ GROUP BY ALL",
    }


TITLE_PARTS = (
    "SELECT imdb_id AS id, 'name' AS field, '' AS part, primary_title AS text FROM titles UNION ALL "
    "SELECT imdb_id, 'alt_name', '', original_title FROM titles UNION ALL "
    "SELECT imdb_id, 'context', '', concat_ws(' ', title_type, genres) FROM titles UNION ALL "
    "SELECT DISTINCT c.imdb_id, 'context', p.primary_name, p.primary_name FROM credits c JOIN titles USING (imdb_id) "
    "JOIN people p USING (imdb_name_id)"
)
PEOPLE_PARTS = (
    "SELECT imdb_name_id AS id, 'name' AS field, '' AS part, primary_name AS text FROM people UNION ALL "
    "SELECT imdb_name_id, 'alt_name', '', primary_professions FROM people UNION ALL "
    "SELECT imdb_name_id, 'context', '', primary_professions FROM people UNION ALL "
    "SELECT DISTINCT c.imdb_name_id, 'context', t.primary_title, t.primary_title FROM credits c "
    "JOIN people USING (imdb_name_id) JOIN titles t USING (imdb_id)"
)
DOCUMENT_PARTS = "SELECT CAST(doc_id AS VARCHAR) AS id, 'name' AS field, '' AS part, text FROM documents"
FILM_NAMES = "titles people credits_raw credits"


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _search(names, parts, docs, terms=(), operator="any", fields=None, must_not=(), phrase=(), boosts=None, k=None):
    """BM25 written out: score per (document, field, term), summed per document."""
    extra = _tokens(parts)
    field = f"field IN ({_list(fields)})" if fields else "true"
    extra["docs"] = f"SELECT count(*) AS n FROM {docs}"
    extra["avgs"] = "SELECT field, sum(len) / (SELECT n FROM docs) AS avg_len FROM lens GROUP BY field"
    extra["hits"] = f"SELECT * FROM occ WHERE {field}"
    words = phrase or terms
    extra["tf"] = (
        f"SELECT id, field, term, count(*) AS tf FROM hits WHERE term IN ({_list(set(words))}) GROUP BY ALL"
    )
    extra["idf"] = (
        "SELECT field, term, ln(1 + ((SELECT n FROM docs) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf GROUP BY field, term"
    )
    boost = "1.0"
    if boosts:
        boost = "CASE field " + " ".join(f"WHEN '{f}' THEN {w}" for f, w in boosts.items()) + " ELSE 1.0 END"
    weight = f"{boost} * idf * {K1 + 1} * tf / (tf + {K1} * ({1 - B} + {B} * len / avg_len))"
    if phrase:
        steps = " ".join(
            f"JOIN hits h{i} ON h{i}.id = h0.id AND h{i}.field = h0.field AND h{i}.part = h0.part "
            f"AND h{i}.pos = h0.pos + {i} AND h{i}.term = '{w}'"
            for i, w in enumerate(phrase)
            if i
        )
        extra["runs"] = f"SELECT h0.id, h0.field, count(*) AS tf FROM hits h0 {steps} WHERE h0.term = '{phrase[0]}' GROUP BY ALL"
        times = " ".join(f"WHEN '{w}' THEN {list(phrase).count(w)}" for w in set(phrase))
        extra["weights"] = f"SELECT field, sum(idf * CASE term {times} END) AS idf FROM idf GROUP BY field"
        extra["scored"] = f"SELECT id, '' AS term, {weight} AS s FROM runs JOIN weights USING (field) JOIN lens USING (id, field) JOIN avgs USING (field)"
    else:
        extra["scored"] = f"SELECT id, term, {weight} AS s FROM tf JOIN idf USING (field, term) JOIN lens USING (id, field) JOIN avgs USING (field)"
    having = f" HAVING count(DISTINCT term) = {len(set(terms))}" if operator == "all" else ""
    banned = f" WHERE id NOT IN (SELECT id FROM hits WHERE term IN ({_list(must_not)}))" if must_not else ""
    extra["ranked"] = f"SELECT id, round(sum(s), 6) AS score FROM scored{banned} GROUP BY id{having}"
    if k:
        extra["top"] = f"SELECT * FROM ranked ORDER BY score DESC, id LIMIT {k}"
    return names, extra


def _search_sql(body: str, *args, **kwargs) -> str:
    names, extra = _search(*args, **kwargs)
    return sql(names, body, **extra)


TITLE_RECORD = "primary_title, original_title, title_type, start_year, runtime_minutes, genres"
PERSON_RECORD = "primary_name, birth_year, death_year, primary_professions"
TITLE_HITS = f"SELECT score, imdb_id, {TITLE_RECORD} FROM top JOIN titles ON imdb_id = id"
PERSON_HITS = f"SELECT score, imdb_name_id, {PERSON_RECORD} FROM top JOIN people ON imdb_name_id = id"


# --- statements


def _neighbors(entity_iri: str) -> str:
    bases = " OR ".join(f"starts_with(node, '{b}')" for b in (VOCAB.title_base, VOCAB.person_base, ENTITY_BASE))
    edges = (
        f"SELECT 'out' AS direction, p, o AS node FROM triples WHERE s = '{entity_iri}' AND o_kind = 'iri' UNION ALL "
        f"SELECT 'in', p, s FROM triples WHERE o = '{entity_iri}' AND o_kind = 'iri'"
    )
    body = (
        f"SELECT direction, {_last('p')} AS predicate, {_last('node')} AS entity_id, name AS entity_name "
        f"FROM edges JOIN names USING (node) WHERE {bases}"
    )
    return on_triples(body, edges=edges)


def _title_neighbors(title: str) -> str:
    edges = (
        f"SELECT 'out' AS direction, role AS predicate, imdb_name_id AS entity_id, primary_name AS entity_name "
        f"FROM roles JOIN people USING (imdb_name_id) WHERE imdb_id = '{title}' UNION "
        f"SELECT 'out', 'partOfSeries', t.imdb_id, primary_title FROM episode_edges e JOIN titles t ON t.imdb_id = parent_imdb_id "
        f"WHERE e.imdb_id = '{title}' UNION "
        f"SELECT 'in', 'partOfSeries', t.imdb_id, primary_title FROM titles t SEMI JOIN "
        f"(SELECT imdb_id FROM episode_edges WHERE parent_imdb_id = '{title}') USING (imdb_id) UNION "
        f"SELECT 'out', 'sameAs', wikidata_id, coalesce(label, wikidata_id) FROM title_wikidata_links "
        f"LEFT JOIN entities USING (wikidata_id) WHERE imdb_id = '{title}' UNION "
        f"SELECT 'out', 'averageRating', CAST(average_rating AS VARCHAR), CAST(average_rating AS VARCHAR) FROM title_ratings "
        f"WHERE imdb_id = '{title}' UNION "
        f"SELECT 'out', 'voteCount', CAST(num_votes AS VARCHAR), CAST(num_votes AS VARCHAR) FROM title_ratings WHERE imdb_id = '{title}'"
    )
    return on_triples("SELECT * FROM edges", edges=edges)


def _upsert_akas() -> str:
    columns = ", ".join(TABLES["title_akas"].names)
    columns = columns.removeprefix("id, ")
    return sql("akas_raw", _ranked("akas_raw", columns, "imdb_id, ordering, title", LATEST, "ordering"))


def _split_credits(pick_late: bool) -> str:
    """Table of early orders and batch of late ones: the batch comes after the table."""
    side = "CASE WHEN a1 % 3 = 0 THEN 1 ELSE 0 END AS batch"
    table = _ranked("(SELECT * FROM credits_raw WHERE a1 % 3 <> 0)", f"{CREDIT_COLUMNS}, {EARLIEST}", CREDIT_KEY, LATEST, "ordering")
    both = f"SELECT *, {side} FROM (({table}) UNION ALL (SELECT {CREDIT_COLUMNS}, {EARLIEST} FROM credits_raw WHERE a1 % 3 = 0))"
    order = f"batch DESC, {LATEST}" if pick_late else f"batch, {EARLIEST}"
    return sql("credits_raw", _ranked("both_", CREDIT_COLUMNS, CREDIT_KEY, order, "ordering"), both_=both)


def _merge_entities() -> str:
    order = "(" + ", ".join(ARRIVAL) + ")"
    picks = ", ".join(
        f"arg_max({c}, {order}) FILTER (WHERE {c} IS NOT NULL) AS {name}"
        for c, name in (("characters", "characters"), ("job", "label"), ("a9", "description"))
    )
    return sql("credits_raw", f"SELECT imdb_id AS wikidata_id, {picks} FROM credits_raw GROUP BY imdb_id")


def _replace_credits() -> str:
    lines = (
        "SELECT l_orderkey AS tmdb_movie_id, 'crew:' || CAST(l_suppkey AS VARCHAR) || ':' || l_returnflag AS credit_key, "
        "l_linestatus AS department, l_partkey AS part, l_linenumber AS n, l_extendedprice AS price, l_partkey % 4 = 0 AS late FROM lineitem"
    )
    body = (
        "SELECT tmdb_movie_id, credit_key, department FROM (SELECT *, row_number() OVER (PARTITION BY tmdb_movie_id, credit_key "
        "ORDER BY part DESC, n DESC, price DESC) AS rn FROM lines l WHERE late OR tmdb_movie_id NOT IN (SELECT tmdb_movie_id FROM lines WHERE late)) WHERE rn = 1"
    )
    return sql("", body, lines=lines)


def _links(rejects: bool) -> str:
    columns = ", ".join(f"{e} AS {n}" for n, e in ARRIVAL.items())
    said = f"SELECT l_partkey AS local_id, l_suppkey * 7 + l_linenumber AS remote_id, {columns} FROM lineitem"
    # a local id's last statement counts; of the local ids that then claim a remote id, the first has it
    last = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY local_id ORDER BY {LATEST}) AS at_local FROM said) WHERE at_local = 1"
    judged = f"SELECT *, row_number() OVER (PARTITION BY remote_id ORDER BY {EARLIEST}) AS at_remote FROM last"
    if rejects:
        body = "SELECT remote_id, count(*) AS rejected FROM judged WHERE at_remote > 1 GROUP BY remote_id"
    else:
        body = "SELECT local_id, remote_id FROM judged WHERE at_remote = 1"
    return sql("", body, said=said, last=last, judged=judged)


def _counters() -> str:
    raw = "SELECT * FROM credits_raw"
    kept = "SELECT * FROM raw WHERE imdb_id IN (SELECT imdb_id FROM known_titles) AND imdb_name_id IN (SELECT imdb_name_id FROM known_people)"

    def size(source: str) -> str:
        return f"(SELECT count(*) FILTER (WHERE ordering IS NULL) + count(DISTINCT ({CREDIT_KEY})) FILTER (WHERE ordering IS NOT NULL) FROM {source})"

    # a second import keeps the table's own rows with a null in the key and adds the batch's
    body = (
        f"SELECT (SELECT count(*) FROM raw) AS rows_seen, ins AS rows_inserted, kept_n - ins AS rows_updated, "
        f"(SELECT count(*) FROM raw) - kept_n AS rows_skipped FROM (SELECT (SELECT count(*) FROM kept) AS kept_n, "
        f"{size('kept')} + (SELECT count(*) FROM kept WHERE ordering IS NULL AND a1 % 2 = 0) "
        f"- {size('(SELECT * FROM kept WHERE a1 % 2 = 0)')} AS ins)"
    )
    return sql("credits_raw known_titles known_people", body, raw=raw, kept=kept)


def _pending(adult: bool) -> str:
    keep = "true" if adult else "adult = 0"
    body = (
        f"SELECT CAST(1 AS BIGINT) AS export_artifact_id, tmdb_movie_id, original_title, popularity FROM movie_export "
        f"ANTI JOIN hydrated USING (tmdb_movie_id) WHERE {keep} ORDER BY popularity DESC NULLS LAST, tmdb_movie_id LIMIT 25"
    )
    return sql("movie_export hydrated", body)


# members of the documents that could be had
CAST = (
    "SELECT o_orderkey AS movie, i, o_custkey * 7 + i AS person FROM orders, unnest(range(1, 2 + o_orderkey % 4)) AS r(i) "
    "WHERE o_orderkey % 8 <> 0"
)
CREW = (
    "SELECT o_orderkey AS movie, i, o_custkey + i AS person FROM orders, unnest(range(1, 1 + o_orderkey % 3)) AS r(i) "
    "WHERE o_orderkey % 8 <> 0"
)


def _movie_credits() -> str:
    body = (
        "SELECT movie AS tmdb_movie_id, person AS tmdb_person_id, 'cast:' || person || ':' || CASE WHEN i = 2 THEN 0 ELSE i - 1 END "
        "|| ':' || CASE WHEN i = 3 THEN '' ELSE 'Role ' || i END AS credit_key, CAST(CASE WHEN i <> 2 THEN i - 1 END AS BIGINT) AS cast_order, "
        "'cast' AS credit_kind, CASE WHEN i <> 1 THEN 'Acting' END AS department, CAST(NULL AS VARCHAR) AS job, "
        "CASE WHEN i <> 3 THEN 'Role ' || i END AS character_name, "
        "'{\"id\":' || person || ',\"name\":\"Person ' || person || '\",\"character\":' || CASE WHEN i = 3 THEN 'null' ELSE '\"Role ' || i || '\"' END || "
        "',\"order\":' || CASE WHEN i = 2 THEN 'null' ELSE CAST(i - 1 AS VARCHAR) END || ',\"known_for_department\":' || "
        "CASE WHEN i = 1 THEN 'null' ELSE '\"Acting\"' END || '}' AS raw_json FROM cast_ UNION ALL "
        "SELECT movie, person, 'crew:' || person || ':' || CASE WHEN i = 2 THEN '' ELSE 'Directing' END || ':Job ' || i, NULL, 'crew', "
        "CASE WHEN i <> 2 THEN 'Directing' END, 'Job ' || i, NULL, "
        "'{\"id\":' || person || ',\"name\":\"Person ' || person || '\",\"department\":' || CASE WHEN i = 2 THEN 'null' ELSE '\"Directing\"' END || "
        "',\"job\":\"Job ' || i || '\"}' FROM crew_"
    )
    return sql("", body, cast_=CAST, crew_=CREW)


def _hydrate_pending() -> str:
    return sql(
        "movie_export",
        "SELECT e.tmdb_movie_id, CASE WHEN p.tmdb_movie_id IS NULL THEN NULL WHEN e.tmdb_movie_id % 7 = 0 THEN 'failed' ELSE 'completed' END AS hydrate_status, "
        "CAST(CASE WHEN p.tmdb_movie_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS hydrate_attempts, "
        "CASE WHEN p.tmdb_movie_id % 7 = 0 THEN 'not found' END AS last_error, "
        "CASE WHEN p.tmdb_movie_id % 7 <> 0 THEN 'Movie ' || p.tmdb_movie_id END AS title FROM movie_export e LEFT JOIN picked p USING (tmdb_movie_id)",
        picked="SELECT tmdb_movie_id FROM movie_export WHERE adult = 0 ORDER BY popularity DESC NULLS LAST, tmdb_movie_id LIMIT 25",
    )


def _import_entities() -> str:
    links = "(SELECT count(*) FROM title_wikidata_links SEMI JOIN titles USING (imdb_id))"
    people = "(SELECT count(*) FROM person_wikidata_links)"
    claims, items = "(SELECT count(*) FROM claims)", "(SELECT count(*) FROM entities)"
    rejects = f"(SELECT count(*) FROM ({_rejected_links()}))"
    values = {
        "entities_seen": items, "entities_imported": items, "title_links_created": links, "person_links_created": people, "claims_imported": claims,
        "imports_skipped": "1", "links_rejected": rejects, "wikidata_entities": items, "title_wikidata_links": links,
        "person_wikidata_links": people, "wikidata_claims": claims, "stale": "0",
    }
    body = " UNION ALL ".join(f"SELECT '{n}' AS name, CAST({v} AS BIGINT) AS value" for n, v in values.items())
    return sql("titles title_wikidata_links person_wikidata_links title_entities person_entities place_entities entities claims", body)


ODD_ITEM = "'Q4' || lpad(CAST(p_partkey AS VARCHAR), 10, '0')"


def _claim_kinds() -> str:
    """(remainder, property, ordinal, kind, text, entity, datatype) of the readable statements."""
    rows = (
        (0, "P364", 0, "monolingual_text", "'Titel ' || p_partkey", "NULL", "monolingualtext"),
        (1, "P577", 0, "quantity", "'+' || p_partkey", "NULL", "quantity"),
        (1, "P577", 1, "monolingual_text", "'Titel ' || p_partkey", "NULL", "monolingualtext"),
        (2, "P57", 0, "wikidata_item", "NULL", "'Q30000000001'", "item"),
        (3, "P495", 1, "number", "CAST(p_partkey AS VARCHAR)", "NULL", "number"),
    )
    return " UNION ALL ".join(
        f"SELECT {ODD_ITEM} AS subject_wikidata_id, '{prop}' AS property_id, '{kind}' AS value_type, {text} AS value_text, {entity} AS value_wikidata_id, "
        f"'{datatype}' AS datatype, 'preferred' AS rank_name, CAST({ordinal} AS BIGINT) AS ordinal FROM part WHERE p_partkey % 6 = {k}"
        for k, prop, ordinal, kind, text, entity, datatype in rows
    )


def _rejected_links() -> str:
    return (
        "SELECT t2.imdb_id, l.wikidata_id FROM part p JOIN title_wikidata_links l ON l.imdb_id = 'tt' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') "
        "JOIN titles t2 ON t2.imdb_id = 'tt' || lpad(CAST(p_partkey + 1 AS VARCHAR), 10, '0') WHERE p_partkey % 9 = 0"
    )


def _entity_ids() -> str:
    return (
        "SELECT wikidata_id, imdb_id AS external_id, CAST(0 AS BIGINT) AS pos FROM title_wikidata_links UNION ALL "
        "SELECT wikidata_id, imdb_name_id, 0 FROM person_wikidata_links UNION ALL "
        "SELECT 'Q1' || lpad(CAST(p_partkey AS VARCHAR), 10, '0'), 'tt' || lpad(CAST(p_partkey + 1 AS VARCHAR), 10, '0'), 1 FROM part WHERE p_partkey % 9 = 0"
    )


ARTIFACTS = "SELECT a.*, sha256(d.text) AS sha256 FROM artifacts a JOIN documents d ON d.doc_id + 1 = a.id"


def _artifacts(body: str) -> str:
    return sql("artifacts datasets runs", body, files=ARTIFACTS)


def _run_ledger() -> str:
    free = "SELECT id FROM artifacts WHERE id NOT IN (SELECT artifact_id FROM runs WHERE importer_name = 'loader' AND status <> 'failed')"
    body = (
        "SELECT id AS artifact_id, 'loader' AS importer_name, CASE WHEN id % 2 = 0 THEN 'completed' ELSE 'running' END AS status, "
        "CASE WHEN id % 2 = 0 THEN id ELSE 0 END AS rows_seen FROM free UNION ALL "
        "SELECT artifact_id, importer_name, status, CAST(NULL AS BIGINT) FROM runs "
        "WHERE importer_name <> 'loader' OR artifact_id NOT IN (SELECT id FROM free)"
    )
    return sql("artifacts runs", body, free=free)


def _counters_graph(profile: bool) -> str:
    """Build counters, or the profile made from them."""
    entities = (
        "SELECT count(DISTINCT w) AS n FROM (SELECT wikidata_id AS w FROM linked UNION ALL SELECT value_wikidata_id FROM linked_claims)"
    )
    by_predicate = f"SELECT 'predicate' AS metric, {_last('p')} AS name, count(*) AS value FROM written GROUP BY ALL"
    total = "SELECT '{}' AS metric, '' AS name, count(*) AS value FROM written"
    if profile:
        body = (
            f"{by_predicate} UNION ALL {total.format('total_triples')} UNION ALL SELECT 'title_nodes', '', count(*) FROM titles UNION ALL "
            "SELECT 'person_nodes', '', count(*) FROM people UNION ALL SELECT 'wikidata_entities', '', n FROM ents"
        )
        return on_triples(body, ents=entities)
    tables = {
        "title": "titles",
        "person": "people",
        "credit": "credits",
        "episode": "episode_edges",
        "rating": "title_ratings",
        "link": "linked",
        "claim": "linked_claims",
    }
    rows = " UNION ALL ".join(f"SELECT 'rows_projected' AS metric, '{n}' AS name, count(*) AS value FROM {t}" for n, t in tables.items())
    body = (
        f"{rows} UNION ALL SELECT 'triples_written', family, count(*) FROM written GROUP BY family UNION ALL {by_predicate} "
        f"UNION ALL {total.format('total_triples_written')} UNION ALL SELECT 'wikidata_entities', '', n FROM ents"
    )
    return on_triples(body, ents=entities)


def _live_profile() -> str:
    def nodes(metric: str, where: str) -> str:
        return f"SELECT '{metric}', '', count(DISTINCT s) FROM triples WHERE {where}"

    body = (
        f"SELECT 'predicate' AS metric, {_last('p')} AS name, count(*) AS value FROM triples GROUP BY ALL UNION ALL "
        "SELECT 'total_triples', '', count(*) FROM triples UNION ALL "
        + nodes("title_nodes", f"p = {_iri('type')} AND o = '{VOCAB.movie}'")
        + " UNION ALL "
        + nodes("person_nodes", f"p = {_iri('type')} AND o = '{VOCAB.person}'")
        + " UNION ALL "
        + nodes("wikidata_entities", f"p = {_iri('name')} AND starts_with(s, '{ENTITY_BASE}')")
    )
    return on_triples(body)


def _shared(person_iri: str, columns: str) -> str:
    shared = (
        f"SELECT o.person AS other, count(DISTINCT o.title) AS shared FROM cast_pairs o JOIN cast_pairs b USING (title) "
        f"WHERE b.person = '{person_iri}' AND o.person <> b.person GROUP BY o.person"
    )
    return on_triples(f"SELECT {columns} FROM shared JOIN names ON node = other", shared=shared)


def _directed(person: str, columns: str, joins: str = "") -> str:
    films = f"SELECT s AS node FROM triples WHERE p = {_iri('director')} AND o = '{VOCAB.node(person)}'"
    return on_triples(f"SELECT {columns} FROM films JOIN names USING (node) {joins}", films=films)


def _optional(predicate: str, name: str) -> str:
    return f"LEFT JOIN (SELECT s AS node, o AS {name} FROM triples WHERE p = {_iri(predicate)}) USING (node)"


def _nquads() -> str:
    quoted = "replace(replace(o, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
    term = (
        f"CASE WHEN o_kind = 'iri' THEN '<' || o || '>' WHEN o_type = 'string' THEN '\"' || {quoted} || '\"' "
        f"ELSE '\"' || o || '\"^^<http://www.w3.org/2001/XMLSchema#' || o_type || '>' END"
    )
    return on_triples(f"SELECT '<' || s || '> <' || p || '> ' || {term} || ' .' AS value FROM triples")


def _edge_kinds() -> str:
    def kind(column: str) -> str:
        return f"CASE WHEN {_last(column)} LIKE 'Q%' THEN 'entity' WHEN {_last(column)} LIKE 'tt%' THEN 'title' ELSE 'person' END"

    return on_triples(
        f"SELECT {kind('s')} AS from_kind, {kind('o')} AS to_kind, count(*) AS edges FROM triples "
        f"WHERE o_kind = 'iri' AND p <> {_iri('type')} GROUP BY ALL"
    )


def _row_counts() -> str:
    filled = {
        "titles": "titles",
        "people": "people",
        "title_ratings": "title_ratings",
        "credits": "credits",
        "episode_edges": "episode_edges",
        "wikidata_entities": "entities",
        "title_wikidata_links": "title_wikidata_links",
        "person_wikidata_links": "person_wikidata_links",
        "wikidata_claims": "claims",
    }
    rows = [
        f"SELECT '{STATS_NAMES.get(n, n)}' AS table_name, " + (f"count(*) AS row_count FROM {filled[n]}" if n in filled else "0 AS row_count")
        for n in TABLES
    ]
    return on_triples(" UNION ALL ".join(rows))


def _import_bulk() -> str:
    known = "imdb_id IN (SELECT imdb_id FROM known_titles)"
    person = "imdb_name_id IN (SELECT imdb_name_id FROM known_people)"
    expanded = " UNION ALL ".join(
        f"SELECT imdb_id, unnest(string_split({c}, ',')) AS imdb_name_id, unnest(range(1, len(string_split({c}, ',')) + 1)) AS ordering, "
        f"'{k}' AS category FROM crew WHERE {c} IS NOT NULL"
        for c, k in (("directors", "director"), ("writers", "writer"))
    )
    keys = (
        f"SELECT imdb_id, imdb_name_id, ordering, category FROM expanded WHERE {known} AND {person} UNION "
        f"SELECT imdb_id, imdb_name_id, ordering, category FROM credits_raw WHERE {known} AND {person} AND ordering IS NOT NULL"
    )
    counts = {
        "people": f"SELECT count(*) FROM people WHERE {person}",
        "titles": f"SELECT count(*) FROM titles WHERE {known}",
        "title_ratings": f"SELECT count(*) FROM title_ratings WHERE {known}",
        "title_akas": f"SELECT count(*) FILTER (WHERE ordering IS NULL) + count(DISTINCT (imdb_id, ordering, title)) "
        f"FILTER (WHERE ordering IS NOT NULL) FROM akas_raw WHERE {known}",
        "title_crew": f"SELECT count(*) FROM crew WHERE {known}",
        "credits": f"SELECT (SELECT count(*) FROM keys) + count(*) FROM credits_raw WHERE {known} AND {person} AND ordering IS NULL",
        "episode_edges": f"SELECT count(*) FROM episode_edges WHERE {known} AND parent_imdb_id IN (SELECT imdb_id FROM known_titles)",
    }
    # every dataset is an artifact with one run; the second import skips all of them
    counts |= {"datasets": "SELECT 7", "artifacts": "SELECT 7", "import_runs": "SELECT 7", "skipped on repeat": "SELECT 7"}
    body = " UNION ALL ".join(f"SELECT '{t}' AS table_name, CAST(({q}) AS BIGINT) AS row_count" for t, q in counts.items())
    names = "known_titles known_people people titles title_ratings akas_raw credits_raw title_crew crew episode_edges"
    return sql(names, body, expanded=expanded, keys=keys)


def _expand_crew() -> str:
    parts = " UNION ALL ".join(
        f"SELECT imdb_id, unnest(string_split({c}, ',')) AS imdb_name_id, unnest(range(1, len(string_split({c}, ',')) + 1)) AS ordering, "
        f"'{k}' AS category FROM crew WHERE {c} IS NOT NULL"
        for c, k in (("directors", "director"), ("writers", "writer"))
    )
    body = (
        "SELECT imdb_id, imdb_name_id, CAST(ordering AS BIGINT) AS ordering, category, CAST(NULL AS VARCHAR) AS job, "
        "CAST(NULL AS VARCHAR) AS characters, 'imdb' AS source FROM expanded SEMI JOIN known_titles USING (imdb_id) "
        "SEMI JOIN known_people USING (imdb_name_id)"
    )
    return sql("title_crew crew known_titles known_people", body, expanded=parts)


def _like(column: str, pattern: str) -> str:
    # all names are ASCII, so folding case by lower() is the same as folding ASCII letters only
    return f"lower({column}) LIKE '%{pattern}%'"


def _documents(doc: str, other: str, doc_table: str, other_table: str, name: str, out: str) -> str:
    return (
        f"SELECT {doc}, string_agg(DISTINCT {name}, ',' ORDER BY {name}) AS {out} FROM credits JOIN {other_table} USING ({other}) GROUP BY {doc}"
    )


def oracle_sql() -> dict[str, str]:
    titles_all = ", ".join(f"{c}" for c in SHAPES["titles"].columns)
    day = SNAPSHOT_DAY.isoformat()
    title_names = _documents("imdb_id", "imdb_name_id", "titles", "people", "primary_name", "people_text")
    person_names = _documents("imdb_name_id", "imdb_id", "people", "titles", "primary_title", "title_text")
    role_iri = on_triples(
        "SELECT role, film, name AS title FROM w JOIN names ON node = film",
        w=" UNION ALL ".join(
            f"SELECT '{r}' AS role, s AS film FROM triples WHERE p = {_iri(r)} AND o = '{VOCAB.node(PERSON)}'" for r in ("director", "writer")
        ),
    )
    crew_text = ", ".join(("imdb_id", "directors", "writers"))
    return {
        "collaborations": sql(
            FILM_NAMES,
            "SELECT imdb_name_id AS person_id, primary_name AS person_name, n AS shared_titles FROM shared JOIN people USING (imdb_name_id)",
            mine=f"SELECT DISTINCT imdb_id FROM credits WHERE imdb_name_id = '{PERSON}'",
            shared=f"SELECT imdb_name_id, count(DISTINCT imdb_id) AS n FROM credits SEMI JOIN mine USING (imdb_id) "
            f"WHERE imdb_name_id <> '{PERSON}' GROUP BY imdb_name_id",
        ),
        "title_neighbors": _title_neighbors(SERIES),
        "episode_neighbors": _title_neighbors(EPISODE),
        "person_neighbors": on_triples(
            f"SELECT DISTINCT 'in' AS direction, role AS predicate, imdb_id AS entity_id, primary_title AS entity_name FROM roles "
            f"JOIN titles USING (imdb_id) WHERE imdb_name_id = '{LINKED_PERSON}' UNION ALL "
            f"SELECT 'out', 'sameAs', wikidata_id, coalesce(label, wikidata_id) FROM person_wikidata_links "
            f"LEFT JOIN entities USING (wikidata_id) WHERE imdb_name_id = '{LINKED_PERSON}'"
        ),
        "lookup_title": sql(
            "titles",
            f"SELECT imdb_id, {TITLE_RECORD} FROM titles WHERE {_like('primary_title', 'red _i')} OR {_like('original_title', 'red _i')} "
            "ORDER BY start_year NULLS FIRST, primary_title, imdb_id LIMIT 20",
        ),
        "lookup_title_short": sql(
            "titles",
            f"SELECT imdb_id, {TITLE_RECORD} FROM titles WHERE {_like('primary_title', 'd _i%9')} OR {_like('original_title', 'd _i%9')} "
            "ORDER BY start_year NULLS FIRST, primary_title, imdb_id LIMIT 20",
        ),
        "lookup_title_id": sql("titles", f"SELECT imdb_id, {TITLE_RECORD} FROM titles WHERE imdb_id = '{SERIES}'"),
        "lookup_person": sql(
            "people",
            f"SELECT imdb_name_id, {PERSON_RECORD} FROM people WHERE {_like('primary_name', 'supplier#0000000_1')} "
            "ORDER BY primary_name, imdb_name_id LIMIT 20",
        ),
        "warehouse_row_counts": _row_counts(),
        "scan_people_tsv": sql("people", "SELECT * FROM people"),
        "scan_basics_tsv": sql("titles", f"SELECT {titles_all} FROM titles"),
        "scan_ratings_tsv": sql("title_ratings", "SELECT * FROM title_ratings"),
        "scan_akas_tsv": sql("akas_raw", f"SELECT {', '.join(list(SHAPES['akas_raw'].columns)[:8])} FROM akas_raw"),
        "scan_crew_tsv": sql("title_crew crew", f"SELECT {crew_text} FROM crew"),
        "scan_principals_tsv": sql("credits_raw credits", "SELECT * FROM credits"),
        "scan_episode_tsv": sql("episode_edges", "SELECT * FROM episode_edges"),
        "scan_movie_export_jsonl": sql("movie_export", "SELECT CAST(1 AS BIGINT) AS export_artifact_id, * FROM movie_export"),
        "latest_snapshot": sql(
            "",
            "SELECT 'movie_ids_' || strftime(max(o_orderdate), '%m_%d_%Y') || '.json.gz' AS name FROM orders "
            f"WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{day}' - {SNAPSHOT_BACK} AND DATE '{day}'",
        ),
        "gate_ratings": sql("title_ratings known_titles", "SELECT * FROM title_ratings SEMI JOIN known_titles USING (imdb_id)"),
        "gate_principals": sql(
            "credits_raw known_titles known_people",
            "SELECT imdb_id, imdb_name_id, ordering, category, job, characters, a1 AS line FROM credits_raw "
            "SEMI JOIN known_titles USING (imdb_id) SEMI JOIN known_people USING (imdb_name_id)",
        ),
        "gate_episodes": sql(
            "episode_edges known_titles",
            "SELECT * FROM episode_edges WHERE imdb_id IN (SELECT imdb_id FROM known_titles) "
            "AND parent_imdb_id IN (SELECT imdb_id FROM known_titles)",
        ),
        "import_counters": _counters(),
        "upsert_credits": sql("credits_raw credits", "SELECT * FROM credits"),
        "upsert_akas": _upsert_akas(),
        "upsert_principals_columns": _split_credits(True),
        "insert_ignore_credits": _split_credits(False),
        "expand_crew": _expand_crew(),
        "merge_entities": _merge_entities(),
        "replace_movie_credits": _replace_credits(),
        "replace_stored_credits": _replace_credits(),
        "link_upsert": _links(False),
        "link_rejects": _links(True),
        "latest_per_title": sql("credits_raw credits", "SELECT imdb_id, max(imdb_name_id) AS imdb_name_id FROM credits GROUP BY imdb_id"),
        "pending_hydrations": _pending(False),
        "pending_hydrations_adult": _pending(True),
        "hydrate_movies": sql(
            "",
            "SELECT o_orderkey AS tmdb_movie_id, 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS imdb_id, "
            "'Movie ' || CAST(o_orderkey AS VARCHAR) AS title, "
            "CASE WHEN o_orderkey % 5 <> 0 THEN 'Original ' || CAST(o_orderkey AS VARCHAR) END AS original_title, 'en' AS original_language, "
            "strftime(o_orderdate, '%Y-%m-%d') AS release_date, o_orderkey % 200 AS runtime_minutes, o_totalprice AS popularity "
            "FROM orders",
        ),
        "hydrate_people": sql(
            "",
            "SELECT person AS tmdb_person_id, 'Person ' || person AS name FROM cast_ UNION SELECT person, 'Person ' || person FROM crew_",
            cast_=CAST,
            crew_=CREW,
        ),
        "hydrate_movie_credits": _movie_credits(),
        "hydrate_links": sql(
            "titles",
            "SELECT imdb_id, o_orderkey AS tmdb_movie_id, 'tmdb_external_id' AS linked_via FROM orders "
            "JOIN titles ON imdb_id = 'tt' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0')",
        ),
        "hydrate_queue": sql(
            "movie_export",
            "SELECT tmdb_movie_id, CASE WHEN tmdb_movie_id % 7 <> 0 THEN 'completed' ELSE 'failed' END AS hydrate_status, "
            "CAST(1 AS BIGINT) AS hydrate_attempts, CASE WHEN tmdb_movie_id % 7 = 0 THEN 'not found' END AS last_error FROM movie_export",
        ),
        "entity_table": on_triples("SELECT wikidata_id, label, description, 'item' AS entity_type FROM entities"),
        "entity_title_links": sql(
            "title_wikidata_links titles",
            "SELECT imdb_id, wikidata_id, 'wikidata_imdb_id' AS linked_via FROM title_wikidata_links SEMI JOIN titles USING (imdb_id)",
        ),
        "entity_person_links": sql(
            "person_wikidata_links", "SELECT imdb_name_id, wikidata_id, 'wikidata_imdb_id' AS linked_via FROM person_wikidata_links"
        ),
        "entity_link_rejects": sql("titles title_wikidata_links", _rejected_links()),
        "entity_claims": sql(
            "claims",
            "SELECT subject_wikidata_id, property_id, value_type, value_text, value_wikidata_id, 'sample' AS datatype, 'normal' AS rank_name, ordinal FROM claims",
        ),
        "entity_claims_dedup": sql(
            "claims",
            "SELECT subject_wikidata_id, property_id, value_type, value_text, value_wikidata_id, 'sample' AS datatype, 'normal' AS rank_name, ordinal FROM claims",
        ),
        "claims_cleared": sql(
            "claims person_wikidata_links",
            "SELECT * FROM claims WHERE subject_wikidata_id NOT IN (SELECT wikidata_id FROM person_wikidata_links)",
        ),
        "export_row": sql("movie_export", "SELECT tmdb_movie_id, adult, original_title, popularity FROM movie_export WHERE tmdb_movie_id = 15"),
        "titles_by_ids": sql(
            FILM_NAMES,
            f"SELECT imdb_id, {TITLE_RECORD} FROM titles WHERE imdb_id IN (SELECT imdb_id FROM credits WHERE imdb_name_id = '{PERSON}')",
        ),
        "parsed_numbers": (
            "SELECT p_partkey, CAST(CASE WHEN p_partkey % 6 IN (2, 5) THEN p_size ELSE -1 END AS BIGINT) AS whole, "
            "CASE p_partkey % 5 WHEN 1 THEN -p_retailprice WHEN 3 THEN 0.5 WHEN 4 THEN p_retailprice END AS fraction, "
            "CASE p_partkey % 5 WHEN 0 THEN replace(CAST(p_retailprice AS VARCHAR), '.', '_') || 'f' "
            "WHEN 1 THEN '-' || replace(CAST(p_retailprice AS VARCHAR), '.', '_') WHEN 2 THEN replace(p_brand, '#', '_') WHEN 3 THEN '_5' "
            "ELSE replace(CAST(p_retailprice AS VARCHAR), '.', '_') END AS safe FROM part"
        ),
        "entity_external_ids": sql("title_wikidata_links person_wikidata_links", _entity_ids()),
        "claim_value_types": sql(
            "claims",
            "SELECT property_id, value_type, count(*) AS statements FROM claims GROUP BY ALL UNION ALL "
            "SELECT 'P31', 'number', count(*) FROM nation",
        ),
        "artifact_dedup": _artifacts(
            "SELECT id, dataset_id, url, byte_len, sha256 FROM (SELECT *, row_number() OVER (PARTITION BY dataset_id, sha256 ORDER BY id) AS rn FROM files) WHERE rn = 1"
        ),
        "latest_artifacts": _artifacts(
            "SELECT d.dataset_name, f.* FROM files f JOIN datasets d ON d.id = f.dataset_id WHERE d.source = 'imdb' "
            "AND f.id = (SELECT max(g.id) FROM artifacts g WHERE g.dataset_id = f.dataset_id)"
        ),
        "latest_artifact": _artifacts(
            "SELECT d.dataset_name, f.* FROM files f JOIN datasets d ON d.id = f.dataset_id WHERE d.source = 'tmdb' ORDER BY f.id DESC LIMIT 1"
        ),
        "import_gate": _artifacts(
            "SELECT * FROM files WHERE id NOT IN (SELECT artifact_id FROM runs WHERE importer_name = 'loader' AND status <> 'failed')"
        ),
        "run_ledger": _run_ledger(),
        "import_bulk": _import_bulk(),
        "artifact_manifest": "SELECT s_suppkey, sha256(content) AS sha256, CAST(octet_length(encode(content)) AS BIGINT) AS byte_len "
        "FROM (SELECT s_suppkey, concat_ws('|', s_suppkey, s_name, s_nationkey) || chr(10) AS content FROM supplier)",
        "title_documents": sql(
            FILM_NAMES,
            "SELECT imdb_id AS id, primary_title AS name, original_title AS alt_name, concat_ws(' ', title_type, genres, people_text) AS context, "
            "start_year, people_text FROM titles LEFT JOIN listed USING (imdb_id)",
            listed=title_names,
        ),
        "person_documents": sql(
            FILM_NAMES,
            "SELECT imdb_name_id AS id, primary_name AS name, primary_professions AS alt_name, concat_ws(' ', primary_professions, title_text) AS context, "
            "birth_year, death_year, title_text FROM people LEFT JOIN listed USING (imdb_name_id)",
            listed=person_names,
        ),
        "title_parts": sql(FILM_NAMES, TITLE_PARTS),
        "person_parts": sql(FILM_NAMES, PEOPLE_PARTS),
        "title_term_stats": sql(FILM_NAMES, "SELECT field, term, count(DISTINCT id) AS doc_freq FROM occ GROUP BY ALL", **_tokens(TITLE_PARTS)),
        "title_field_stats": sql(
            FILM_NAMES,
            "SELECT field, (SELECT count(*) FROM titles) AS n_docs, round(sum(len) / (SELECT count(*) FROM titles), 6) AS avg_len FROM lens GROUP BY field",
            **_tokens(TITLE_PARTS),
        ),
        "document_postings": sql(
            "", "SELECT id, term, count(*) AS tf, any_value(len) AS len FROM occ JOIN lens USING (id, field) GROUP BY id, term", **_tokens(DOCUMENT_PARTS)
        ),
        "index_counts": "SELECT 'titles' AS name, count(*) AS indexed FROM part UNION ALL SELECT 'people', count(*) FROM supplier",
        "search_titles_any": _search_sql(TITLE_HITS, FILM_NAMES, TITLE_PARTS, "titles", ("red", "gear", "economy"), k=10),
        "search_titles_all": _search_sql(TITLE_HITS, FILM_NAMES, TITLE_PARTS, "titles", ("blue", "widget", "000000003"), "all", k=10),
        "search_people": _search_sql(PERSON_HITS, FILM_NAMES, PEOPLE_PARTS, "people", ("supplier", "anvil"), "all", k=10),
        "search_fields_boosts": _search_sql(
            "SELECT * FROM ranked", FILM_NAMES, TITLE_PARTS, "titles", ("small", "ring", "promo"), fields=("name", "context"), must_not=("economy",), boosts={"name": 2.5}
        ),
        "search_titles_excluding": _search_sql("SELECT * FROM ranked", FILM_NAMES, TITLE_PARTS, "titles", ("red", "bolt"), must_not=("large", "old")),
        "search_documents_any": _search_sql("SELECT * FROM ranked", "", DOCUMENT_PARTS, "documents", ("the", "and", "over", "time")),
        "search_documents_phrase": _search_sql("SELECT * FROM ranked", "", DOCUMENT_PARTS, "documents", phrase=("of", "the")),
        "project_graph": on_triples("SELECT * FROM triples"),
        "triple_counters": _counters_graph(False),
        "graph_profile": _counters_graph(True),
        "graph_profile_live": _live_profile(),
        "predicate_counts": on_triples("SELECT p AS predicate, count(*) AS triples FROM triples GROUP BY p"),
        "entity_counts": on_triples(
            "SELECT count(DISTINCT w) AS entities FROM (SELECT wikidata_id AS w FROM linked UNION ALL SELECT value_wikidata_id FROM linked_claims)"
        ),
        "neighbors_of_title": _neighbors(VOCAB.node(SERIES)),
        "neighbors_of_person": _neighbors(VOCAB.node(LINKED_PERSON)),
        "neighbors_of_entity": _neighbors(VOCAB.node(ENTITY)),
        "collaborations_from_triples": _shared(VOCAB.node(PERSON), f"{_last('other')} AS person_id, name AS person_name, shared AS shared_titles"),
        "recurring_collaborators": _shared(VOCAB.node(PERSON), "other, name, shared AS shared_titles"),
        "director_filmography": _directed(PERSON, "node AS film, name AS title"),
        "directed_films": _directed(
            PERSON, f"{_last('node')} AS \"titleId\", name AS \"titleName\", year, rating", _optional("datePublished", "year") + " " + _optional("averageRating", "rating")
        ),
        "construct_director_edges": on_triples(
            f"SELECT DISTINCT o AS subject, '{VOCAB.base}directed' AS predicate, s AS object FROM triples JOIN names ON node = o WHERE p = {_iri('director')}"
        ),
        "ask_has_director": on_triples(f"SELECT count(*) > 0 AS value FROM triples WHERE p = {_iri('director')} AND o = '{VOCAB.node(PERSON)}'"),
        "describe_title": on_triples(f"SELECT s AS subject, p AS predicate, o AS object FROM triples WHERE s = '{VOCAB.node(SERIES)}'"),
        "crew_union": role_iri,
        "nquads_lines": _nquads(),
        "nquads_written": _nquads(),
        "stored_bytes": "SELECT true AS same",
        "search_by_id": sql("titles", f"SELECT imdb_id AS id FROM titles WHERE imdb_id = '{SERIES}'"),
        "import_export": sql(
            "movie_export",
            "SELECT tmdb_movie_id, adult, original_title, popularity, video, CAST(NULL AS VARCHAR) AS hydrate_status, CAST(0 AS BIGINT) AS hydrate_attempts, "
            "CAST(NULL AS VARCHAR) AS last_error, CAST(1 AS BIGINT) AS skipped_again FROM movie_export",
        ),
        "hydrate_pending": _hydrate_pending(),
        "import_entities": _import_entities(),
        "entity_texts_german": (
            f"SELECT {ODD_ITEM} AS wikidata_id, CASE p_partkey % 6 WHEN 0 THEN 'Name ' || p_partkey WHEN 1 THEN 'name ' || p_partkey WHEN 3 THEN 'Name ' || p_partkey "
            "WHEN 4 THEN 'name ' || p_partkey END AS label, CAST(NULL AS VARCHAR) AS description FROM part"
        ),
        "claim_kinds": _claim_kinds(),
        "edge_kinds": _edge_kinds(),
        "json_rows": sql(
            "titles",
            "SELECT '{\"imdb_id\":\"' || imdb_id || '\",\"primary_title\":\"' || primary_title || '\"' || "
            "coalesce(',\"original_title\":\"' || original_title || '\"', '') || coalesce(',\"start_year\":' || start_year, '') || '}' AS value FROM titles",
        ),
    }
