"""Full-text search: documents, postings and BM25-ranked top-k.

The index holds term frequencies (term, field, id, tf, len), token positions for phrases, and document
frequencies, each cut by range of the term on disk: a query reads the files and row groups of its
terms and counts nothing again. A document's context is indexed part by part (one part per credited
name), so that a title with a very long cast is never one row or one task while the index is built.
Stored postings are lists: a term's occurrences in a batch of documents are one row, which is what is shuffled and sorted.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celluloid.functions.text import join_present, query_terms, tokens
from celluloid.operators.lookup import PERSON_RECORD, TITLE_RECORD
from celluloid.operators.relational import concat_distinct, hydrate

# BM25 constants and the searched fields.
K1 = 1.2
B = 0.75
FIELDS = ("name", "alt_name", "context")


def _credited(credits: DataFrame, others: DataFrame, doc: str, other: str, name: str, out: str) -> DataFrame:
    """Distinct (document id, credited name) pairs; equal names of a document collapse with its repeated credits,
    so that pairs of ids need no shuffle of their own."""
    named = credits.select(doc, other).join(others.select(other, F.col(name).alias(out)), other)
    return named.select(doc, out).distinct()


def credited_people(credits: DataFrame, people: DataFrame) -> DataFrame:
    return _credited(credits, people, "imdb_id", "imdb_name_id", "primary_name", "credited")


def credited_titles(credits: DataFrame, titles: DataFrame) -> DataFrame:
    return _credited(credits, titles, "imdb_name_id", "imdb_id", "primary_title", "credited")


def title_documents(titles: DataFrame, credits: DataFrame, people: DataFrame) -> DataFrame:
    """Title documents with the distinct credited names as one text."""
    names = credited_people(credits, people).groupBy("imdb_id").agg(concat_distinct("credited").alias("people_text"))
    return titles.join(names, "imdb_id", "left").select(
        F.col("imdb_id").alias("id"),
        F.col("primary_title").alias("name"),
        F.col("original_title").alias("alt_name"),
        join_present(F.col("title_type"), F.col("genres"), F.col("people_text")).alias("context"),
        "start_year",
        "people_text",
    )


def person_documents(people: DataFrame, credits: DataFrame, titles: DataFrame) -> DataFrame:
    """Person documents with the distinct title names as one text."""
    names = credited_titles(credits, titles).groupBy("imdb_name_id").agg(concat_distinct("credited").alias("title_text"))
    return people.join(names, "imdb_name_id", "left").select(
        F.col("imdb_name_id").alias("id"),
        F.col("primary_name").alias("name"),
        F.col("primary_professions").alias("alt_name"),
        join_present(F.col("primary_professions"), F.col("title_text")).alias("context"),
        "birth_year",
        "death_year",
        "title_text",
    )


def _part(df: DataFrame, doc_id: str, field: str, text: Column, part: Column | None = None) -> DataFrame:
    return df.select(
        F.col(doc_id).alias("id"),
        F.lit(field).alias("field"),
        (F.lit("") if part is None else part).alias("part"),
        text.alias("text"),
    )


def title_parts(titles: DataFrame, credits: DataFrame, people: DataFrame) -> DataFrame:
    """The title documents as rows (id, field, part, text)."""
    # only credits of stored titles make it into a document; told first, their shuffle serves the pairs as well
    cast = credited_people(credits.join(titles.select("imdb_id"), "imdb_id", "left_semi"), people)
    parts = [
        _part(titles, "imdb_id", "name", F.col("primary_title")),
        _part(titles, "imdb_id", "alt_name", F.col("original_title")),
        _part(titles, "imdb_id", "context", join_present(F.col("title_type"), F.col("genres"))),
        _part(cast, "imdb_id", "context", F.col("credited"), F.col("credited")),
    ]
    return reduce(DataFrame.unionByName, parts)


def person_parts(people: DataFrame, credits: DataFrame, titles: DataFrame) -> DataFrame:
    """The person documents as rows (id, field, part, text)."""
    works = credited_titles(credits.join(people.select("imdb_name_id"), "imdb_name_id", "left_semi"), titles)
    parts = [
        _part(people, "imdb_name_id", "name", F.col("primary_name")),
        _part(people, "imdb_name_id", "alt_name", F.col("primary_professions")),
        _part(people, "imdb_name_id", "context", F.col("primary_professions")),
        _part(works, "imdb_name_id", "context", F.col("credited"), F.col("credited")),
    ]
    return reduce(DataFrame.unionByName, parts)


def text_parts(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Single-field documents: the whole text is the name field."""
    return _part(df, doc_id, "name", F.col(text)).withColumn("id", F.col("id").cast("string"))


def token_rows(parts: DataFrame) -> DataFrame:
    """The parts with their tokens (id, field, part, words): the only step that reads text."""
    return parts.where(F.col("text").isNotNull()).select("id", "field", "part", tokens(F.col("text")).alias("words"))


def build_positions(words: DataFrame) -> DataFrame:
    """Token occurrences (term, id, field, part, pos)."""
    return words.select("id", "field", "part", F.explode("words").alias("w")).select(
        F.col("w.term").alias("term"), "id", "field", "part", F.col("w.pos").cast("bigint").alias("pos")
    )


def build_postings(words: DataFrame) -> DataFrame:
    """(term, field, id, tf, len): occurrences of a term in a field of a document, and the field's tokens.

    A field's length is joined to its parts, before these become many rows; what is counted then is fixed in
    width and combines in the map tasks.
    """
    lengths = words.groupBy("id", "field").agg(F.sum(F.size("words")).cast("bigint").alias("len"))
    known = words.join(lengths, ["id", "field"]).select("id", "field", "len", F.explode("words.term").alias("term"))
    return known.groupBy("term", "field", "id").agg(F.count(F.lit(1)).alias("tf"), F.max("len").alias("len"))


LISTS = (
    "term string, field string, first string, counts boolean, placed boolean, n bigint, "
    "docs array<struct<id string, tf bigint, len bigint, part string, at array<int>>>"
)
LIST_ROWS = 8_192  # lists that are sent back at a time
LIST_TOKENS = 4_000_000  # tokens of a batch's documents, beyond which it is cut
COUNTED_ROWS = 65_536  # counted frequencies of a task that are made lists at a time


def build_lists(words: DataFrame, lengths: DataFrame) -> DataFrame:
    """``LISTS`` rows: the occurrences of a term in a batch of parts, each with its positions.

    An entry tells the term's frequency in the part and the length of the field. Where a part is all of its field, that
    is the frequency in the field; of the other fields, which ``lengths`` holds, it is counted over the parts (``counted_lists``).
    """
    known = words.join(lengths, ["id", "field"], "left")
    whole, length = F.col("len").isNull().alias("whole"), F.coalesce("len", "n").alias("len")
    return known.select("id", "field", "part", whole, "n", length, "words").mapInArrow(_lists, LISTS)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        block = (np.cumsum(batch.column("n").to_numpy()) - 1) // LIST_TOKENS
        cuts = [*np.flatnonzero(np.diff(block, prepend=-1)), len(block)]
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _bounded(batches):
        lists = batch.column("words")
        tokens_in = lists.flatten()
        if not len(tokens_in):
            continue
        codes, fields = tokens_in.field("term").dictionary_encode(), batch.column("field").dictionary_encode()
        n_terms = len(codes.dictionary)
        kind = fields.indices.to_numpy().astype(np.int64) * 2 + batch.column("whole").to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        key = kind[row] * n_terms + codes.indices.to_numpy()
        order = np.argsort(key.astype(np.min_scalar_type(key.max())), kind="stable")  # parts and positions stay ascending
        key, row_of = key[order], row[order]
        new = np.diff(key, prepend=-1) != 0
        entry = np.flatnonzero(new | (np.diff(row_of, prepend=-1) != 0))  # a term in a part
        begin = np.flatnonzero(new[entry])  # a term in a field of the batch
        row_of, head = row_of[entry], order[entry[begin]]
        owner, ends = pa.array(row_of), np.append(entry, len(order)).astype(np.int32)
        tf, whole = np.diff(ends).astype(np.int64), kind[row_of] % 2 == 1
        doc = batch.column("id").take(owner)
        docs = pa.StructArray.from_arrays(
            [
                doc,
                pa.array(tf),
                batch.column("len").take(owner),
                batch.column("part").take(owner),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens_in.field("pos").to_numpy()[order])),
            ],
            names=["id", "tf", "len", "part", "at"],
        )
        counts = pa.array(whole[begin])
        made = pa.RecordBatch.from_arrays(
            [
                codes.dictionary.take(codes.indices.take(pa.array(head))),
                batch.column("field").take(pa.array(row[head])),
                doc.take(pa.array(begin)),
                counts,
                pa.array(np.ones(len(begin), dtype=bool)),
                pa.array(np.add.reduceat(tf, begin)),
                pa.ListArray.from_arrays(pa.array(np.append(begin, len(entry)).astype(np.int32)), docs),
            ],
            names=["term", "field", "first", "counts", "placed", "n", "docs"],
        )
        for at in range(0, len(made), LIST_ROWS):
            yield made.slice(at, LIST_ROWS)


def counted_lists(lists: DataFrame) -> DataFrame:
    """``LISTS`` rows for fields in several parts, from the lists of these: frequencies and length of the field, no
    positions. Of the frequencies that a task has counted, those of one term are a row."""
    parts = lists.where(~F.col("counts")).select("term", "field", F.inline(F.transform("docs", lambda d: F.struct(d["id"], d["tf"], d["len"]))))
    counted = parts.groupBy("term", "field", "id").agg(F.sum("tf").alias("tf"), F.max("len").alias("len"))
    return counted.mapInArrow(_counted, LISTS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= COUNTED_ROWS:
            yield from _by_term(held)
            held = []
    if any(map(len, held)):
        yield from _by_term(held)


def _by_term(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(held).combine_chunks()
    term, field = (rows.column(c).combine_chunks() for c in ("term", "field"))
    codes, fields = (c.dictionary_encode().indices.to_numpy().astype(np.int64) for c in (term, field))
    key = fields * (codes.max(initial=0) + 1) + codes
    order = np.argsort(key, kind="stable")
    begin = np.flatnonzero(np.diff(key[order], prepend=-1))
    head, order = pa.array(order[begin]), pa.array(order)
    doc, tf, length = (rows.column(c).combine_chunks().take(order) for c in ("id", "tf", "len"))
    none = pa.nulls(len(order), pa.string()), pa.nulls(len(order), pa.list_(pa.int32()))
    docs = pa.StructArray.from_arrays([doc, tf, length, *none], names=["id", "tf", "len", "part", "at"])
    made = pa.RecordBatch.from_arrays(
        [
            term.take(head),
            field.take(head),
            doc.take(pa.array(begin)),
            pa.array(np.ones(len(begin), dtype=bool)),
            pa.array(np.zeros(len(begin), dtype=bool)),
            pa.array(np.add.reduceat(tf.to_numpy(), begin)),
            pa.ListArray.from_arrays(pa.array(np.append(begin, len(order)).astype(np.int32)), docs),
        ],
        names=["term", "field", "first", "counts", "placed", "n", "docs"],
    )
    for at in range(0, len(made), LIST_ROWS):
        yield made.slice(at, LIST_ROWS)


class SearchIndex:
    """Postings with term frequencies, positions for phrases, document frequencies, totals per field."""

    def __init__(
        self,
        postings: DataFrame,
        positions: DataFrame,
        documents: DataFrame,
        frequencies: DataFrame | None = None,
        totals: DataFrame | None = None,
        words: DataFrame | None = None,
    ):
        self.postings = postings
        self.positions = positions
        self.documents = documents
        self._frequencies = frequencies
        self._totals = totals
        self._words = words

    @classmethod
    def build(cls, parts: DataFrame, documents: DataFrame) -> SearchIndex:
        """``documents`` has one row per document and a column ``id``."""
        ids = documents.select(F.col("id").cast("string").alias("id"))
        words = token_rows(parts)
        return cls(build_postings(words), build_positions(words), ids, words=words)

    def field_totals(self) -> DataFrame:
        """(field, n_docs, avg_len), at most one row per field; avg_len is over all documents."""
        if self._totals is not None:
            return self._totals
        n_docs = self.documents.agg(F.count(F.lit(1)).alias("n_docs")).scalar()
        totals = self.postings.groupBy("field").agg(F.sum("tf").alias("n_tokens"))
        return totals.select(
            "field", n_docs.alias("n_docs"), (F.col("n_tokens") / n_docs).alias("avg_len")
        )

    def term_stats(self) -> DataFrame:
        """(field, term, doc_freq) of the whole index."""
        if self._frequencies is not None:
            return self._frequencies
        return self.postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("doc_freq"))

    def stats(self) -> DataFrame:
        """Number of indexed documents."""
        return self.documents.agg(F.count(F.lit(1)).alias("indexed"))

    def save(self, path: str) -> SearchIndex:
        """Drop and rebuild on disk. Tables are cut by range of the term, so that a file's footer tells which
        terms it can hold; frequent terms are cut by field and the first id of a list."""
        spark = self.documents.sparkSession

        def staged(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")
            return spark.read.schema(df.schema).parquet(f"{path}/{name}")

        # texts are tokenised once, and lists made once: cutting by range looks at its input twice
        known = self._words
        if known is None:  # the tokens of an index that was not built from texts
            token = F.struct(F.col("pos").cast("int").alias("pos"), "term")
            known = self.positions.groupBy("id", "field", "part").agg(F.array_sort(F.collect_list(token)).alias("words"))
        known = known.where(F.col("id").isNotNull())  # as a join by id leaves them
        words = staged(known.withColumn("n", F.size("words").cast("bigint")), "words")
        lengths = words.groupBy("id", "field").agg(F.sum("n").alias("len"), F.count(F.lit(1)).alias("parts"))
        # few or none where fields are whole texts, which then need no shuffle to learn so
        split = staged(lengths.where("parts > 1").drop("parts"), "lengths")
        placed = staged(build_lists(words, split), "lists")
        lists = placed.unionByName(staged(counted_lists(placed), "counted"))
        order = ("term", "field", "first")
        stored = staged(lists.repartitionByRange(*order).sortWithinPartitions(*order), "postings")
        self.documents.write.mode("overwrite").parquet(f"{path}/documents")
        counts = stored.where("counts").select("field", "term", F.size("docs").alias("docs"), "n")
        terms = staged(
            counts.groupBy("field", "term").agg(F.sum("docs").alias("doc_freq"), F.sum("n").alias("n")), "terms"
        )
        frequencies = terms.drop("n").repartitionByRange("term", "field").sortWithinPartitions("term", "field")
        frequencies.write.mode("overwrite").parquet(f"{path}/frequencies")
        tokens_of = terms.select("field", F.col("n").alias("tf"))
        SearchIndex(tokens_of, tokens_of, spark.read.parquet(f"{path}/documents")).field_totals().write.mode("overwrite").parquet(f"{path}/totals")
        return SearchIndex.load(spark, path)

    @classmethod
    def load(cls, spark, path: str) -> SearchIndex:
        def read(flag: str, entry: str) -> DataFrame:
            # only the members that are asked for are read
            schema = f"term string, field string, {flag} boolean, docs array<struct<{entry}>>"
            return spark.read.schema(schema).parquet(f"{path}/postings").where(flag).select("term", "field", F.inline("docs"))

        postings = read("counts", "id string, tf bigint, len bigint").select("term", "field", "id", "tf", "len")
        placed = read("placed", "id string, part string, at array<int>")
        positions = placed.select("term", "id", "field", "part", F.explode("at").alias("pos")).withColumn("pos", F.col("pos").cast("bigint"))
        return cls(postings, positions, *(spark.read.parquet(f"{path}/{name}") for name in ("documents", "frequencies", "totals")))

    def search(
        self,
        terms: str | Sequence[str] = "",
        operator: str = "any",
        fields: Sequence[str] = FIELDS,
        must_not: Sequence[str] = (),
        phrase: str | Sequence[str] = (),
        boosts: Mapping[str, float] | None = None,
        k: int | None = 10,
    ) -> DataFrame:
        """Top ``k`` (id, score), best first; ``k=None`` gives all hits.

        ``operator`` is ``any`` or ``all`` (over the terms, each in any field). ``phrase`` must occur
        as consecutive tokens of one part. ``boosts`` multiplies a field's score.
        """
        words = query_terms(terms) if isinstance(terms, str) else [t.lower() for t in terms]
        run = query_terms(phrase) if isinstance(phrase, str) else [t.lower() for t in phrase]
        words = list(dict.fromkeys(words))
        hits = self.postings.where(F.col("field").isin(list(fields)))
        scored = []
        if words:
            scored.append(self._term_scores(hits, words, boosts))
        if run:
            scored.append(self._phrase_scores(hits, list(fields), run, boosts))
        if not scored:
            raise ValueError("a search needs terms or a phrase")
        columns = ("id", "clause", "score")
        rows = reduce(DataFrame.unionByName, [s.select(*columns) for s in scored])
        docs = rows.groupBy("id").agg(
            # sums of doubles depend on their order in the last bits; rounded, equal scores tie by id
            F.round(F.sum("score"), 6).alias("score"),
            F.array_sort(F.collect_set("clause")).alias("clauses"),
        )
        needed = (words if operator == "all" else []) + ([" ".join(run)] if run else [])
        if needed:
            # a clause per query term, so the set is bounded by the length of the query
            docs = docs.where(F.size(F.array_intersect("clauses", F.array(*map(F.lit, needed)))) == len(set(needed)))
        if must_not:
            banned = query_terms(" ".join(must_not))
            docs = docs.join(hits.where(F.col("term").isin(banned)).select("id"), "id", "left_anti")
        ranked = docs.select("id", "score")
        return ranked.orderBy(F.desc("score"), "id").limit(k) if k is not None else ranked

    def _weights(self, words: list[str]) -> DataFrame:
        """One row per (query term, field), bounded by the query: safe to broadcast."""
        freq = self.term_stats().where(F.col("term").isin(words))
        return freq.join(F.broadcast(self.field_totals()), "field").withColumn("idf", _idf())

    def _term_scores(self, hits: DataFrame, words: list[str], boosts) -> DataFrame:
        scored = hits.where(F.col("term").isin(words)).join(F.broadcast(self._weights(words)), ["field", "term"])
        return scored.select("id", F.col("term").alias("clause"), _bm25(boosts).alias("score"))

    def _phrase_scores(self, hits: DataFrame, fields: list[str], run: list[str], boosts) -> DataFrame:
        offsets = F.create_map(
            *[x for t in dict.fromkeys(run) for x in (F.lit(t), F.array(*[F.lit(i) for i, w in enumerate(run) if w == t]))]
        )
        matched = self.positions.where(F.col("field").isin(fields) & F.col("term").isin(run))
        starts = matched.select(
            "id", "field", "part", "pos", F.explode(F.try_element_at(offsets, F.col("term"))).alias("offset")
        )
        # occurrences that belong to the same start of the phrase; all of its offsets must be there
        runs = (
            starts.groupBy("id", "field", "part", (F.col("pos") - F.col("offset")).alias("start"))
            .agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") == len(run))
        )
        counted = runs.groupBy("id", "field").agg(F.count(F.lit(1)).alias("tf"))
        counted = counted.join(hits.where(F.col("term") == run[0]).select("id", "field", "len"), ["id", "field"])
        times = F.create_map(*[x for t in dict.fromkeys(run) for x in (F.lit(t), F.lit(run.count(t)))])
        weights = (
            self._weights(run)
            .withColumn("idf", F.col("idf") * F.try_element_at(times, F.col("term")))
            .groupBy("field")
            .agg(F.sum("idf").alias("idf"), F.first("avg_len").alias("avg_len"))
        )
        scored = counted.join(F.broadcast(weights), "field")
        return scored.select("id", F.lit(" ".join(run)).alias("clause"), _bm25(boosts).alias("score"))

    def by_id(self, doc_id: str) -> DataFrame:
        """Exact, untokenised id."""
        return self.documents.where(F.col("id") == doc_id)


def _idf() -> Column:
    return F.log(1 + (F.col("n_docs") - F.col("doc_freq") + 0.5) / (F.col("doc_freq") + 0.5))


def _bm25(boosts: Mapping[str, float] | None) -> Column:
    norm = K1 * (1 - B + B * F.col("len") / F.col("avg_len"))
    score = F.col("idf") * (K1 + 1) * F.col("tf") / (F.col("tf") + norm)
    if boosts:
        table = F.create_map(*[x for f, w in boosts.items() for x in (F.lit(f), F.lit(float(w)))])
        score = score * F.coalesce(F.try_element_at(table, F.col("field")), F.lit(1.0))
    return score


def search_titles(index: SearchIndex, titles: DataFrame, query: str, limit: int = 10, operator: str = "all") -> DataFrame:
    """Ranked titles with their records."""
    hits = index.search(query, operator, k=limit).withColumnRenamed("id", "imdb_id")
    return hydrate(hits, titles.select(*TITLE_RECORD), "imdb_id", limit)


def search_people(index: SearchIndex, people: DataFrame, query: str, limit: int = 10, operator: str = "all") -> DataFrame:
    """Ranked people with their records."""
    hits = index.search(query, operator, k=limit).withColumnRenamed("id", "imdb_name_id")
    return hydrate(hits, people.select(*PERSON_RECORD), "imdb_name_id", limit)
