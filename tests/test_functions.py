from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from celluloid.functions import iri, parse, text
from celluloid.functions.iri import Vocabulary
from conftest import rows_of


def evaluate(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_null_sentinel_only_maps_the_mark(spark):
    assert evaluate(spark, ["\\N", "value", "", None], parse.null_sentinel) == [None, "value", "", None]


def test_parse_long(spark):
    values = ["42", "bad", None, " 42 ", "+7", "-3", "1.5", "", "9223372036854775807", "9223372036854775808"]
    expected = [42, None, None, None, 7, -3, None, None, 9223372036854775807, None]
    assert evaluate(spark, values, parse.parse_long) == expected


def test_parse_double(spark):
    values = ["8.6", "8.6f", "1e3", ".5", "5.", " 1", "x", "-2"]
    assert evaluate(spark, values, parse.parse_double) == [8.6, None, 1000.0, 0.5, 5.0, None, None, -2.0]


def test_like_folds_ascii_case_only_and_has_wildcards(spark):
    values = ["Été rouge", "été ROUGE", "a.b", "axb", "back\\slash", "two\nlines"]
    assert evaluate(spark, values, lambda c: text.like_ascii(c, "%rouge%")) == [True, True, False, False, False, False]
    assert evaluate(spark, values, lambda c: text.like_ascii(c, "é%")) == [False, True, False, False, False, False]
    assert evaluate(spark, values, lambda c: text.like_ascii(c, "a.b")) == [False, False, True, False, False, False]
    assert evaluate(spark, values, lambda c: text.like_ascii(c, "a_b")) == [False, False, True, True, False, False]
    assert evaluate(spark, values, lambda c: text.like_ascii(c, "%\\s%")) == [False, False, False, False, True, False]
    assert evaluate(spark, values, lambda c: text.like_ascii(c, "two%lines")) == [False] * 5 + [True]


def test_tokens_keep_positions_of_dropped_long_words(spark):
    long_word = "x" * 40
    [got] = evaluate(spark, [f"--Hello, {long_word} Été_42!"], text.tokens)
    assert [(t["pos"], t["term"]) for t in got] == [(0, "hello"), (2, "été"), (3, "42")]
    assert text.query_terms(f"Hello {long_word} Été_42") == ["hello", "été", "42"]


def test_roles(spark):
    values = ["director", "actress", "actor", "writer", "producer", "composer", None]
    assert evaluate(spark, values, text.role_predicate) == ["director", "actor", "actor", "writer", "producer", None, None]


def test_credit_key_fills_missing_parts(spark):
    df = spark.range(1).select(text.credit_key("cast", F.lit(101), F.lit(0), F.lit(None).cast("string")))
    assert rows_of(df) == [("cast:101:0:",)]


def test_split_ids_keeps_empty_parts(spark):
    assert evaluate(spark, ["a,,b", "", None], text.split_ids) == [["a", "", "b"], [""], None]


def test_clean_dump_line(spark):
    assert evaluate(spark, ['  {"a":1},, ', "[", "x,y,"], parse.clean_dump_line) == ['{"a":1}', "[", "x,y"]


@pytest.mark.parametrize(
    ("entity", "expected"),
    [
        ("tt1", "https://films.example/title/tt1"),
        ("nm1", "https://films.example/person/nm1"),
        ("x", "https://films.example/person/x"),
        ("Q5", "https://www.wikidata.org/entity/Q5"),
        ("https://a.b/c", "https://a.b/c"),
    ],
)
def test_node_by_prefix(entity, expected):
    assert Vocabulary().node(entity) == expected


def test_predicates_and_sanitising(spark):
    vocab = Vocabulary("http://x.y/")
    assert vocab.predicate("name") == "https://schema.org/name"
    assert vocab.predicate("part of") == "http://x.y/part_of"
    assert evaluate(spark, ["a b:c-d_e"], iri.sanitize) == ["a_b_c-d_e"]


def test_last_segment(spark):
    values = ["http://www.w3.org/1999/02/22-rdf-syntax-ns#type", "<https://a/b>", "plain"]
    assert evaluate(spark, values, iri.last_segment) == ["22-rdf-syntax-ns#type", "b", "plain"]


def test_entity_kind_column(spark):
    assert evaluate(spark, ["tt1", "nm1", "Q1", "http://x", "other"], iri.entity_kind) == [
        "title",
        "person",
        "entity",
        "iri",
        "person",
    ]
