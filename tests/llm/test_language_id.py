from __future__ import annotations

from helpers import documents, sentences
from pyspark.sql import functions as F

from celluloid.llm import language_id

POOLS = {
    "de": "der die und nicht mit straße haus garten über wieder schön freund zeit".split(),
    "en": "the and not with street house garden over again nice friend time which".split(),
    "es": "el los pero con calle casa jardín sobre otra vez bonito amigo tiempo".split(),
}


def corpus(spark, count=300):
    languages = sorted(POOLS)
    return documents(spark, [(k, sentences(k, 5 + k % 200, POOLS[languages[k % 3]]).capitalize() + ".", languages[k % 3]) for k in range(count)])


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    contents = language_id.learn_dictionaries(language_id.sample_texts(docs, F.col("doc_id") % 4 != 2))
    assert sorted(contents) == sorted(POOLS)
    rows = language_id.identify(docs, contents).where("doc_id % 4 = 2").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 and not r["rejected"] for r in rows if r["n_chars"] > 500)


def test_undetermined_short_mixed_and_repeated_rows(spark):
    docs = documents(spark, [(1, None), (2, ""), (3, " 123 !?\n"), (4, "x"), (4, "x"), (None, "the house and the garden")])
    contents = language_id.learn_dictionaries(language_id.sample_texts(corpus(spark), F.lit(True)))
    rows = language_id.identify(docs, contents).collect()
    assert [(r["lang_pred"], r["score"]) for r in rows[:3]] == [("und", 0.0)] * 3 and all(r["rejected"] for r in rows[:3])
    assert rows[3]["lang_pred"] == rows[4]["lang_pred"] in POOLS and rows[5]["lang_pred"] == "en"
    classifier = language_id.Classifier({"a": contents["de"], "b": contents["de"]})
    assert classifier.decide(sentences(1, 400, POOLS["de"])) == ("a", 0.5, True)  # a tie is a narrow margin


def test_long_texts_are_read_to_the_end(spark):
    contents = language_id.learn_dictionaries(language_id.sample_texts(corpus(spark), F.lit(True)))
    text = "".join(["xq " * 100, sentences(3, 60_000, POOLS["es"])])
    assert language_id.Classifier(contents).decide(text)[0] == "es"


def test_nothing_to_learn_from(spark):
    docs = documents(spark, [(1, "some text", None)])
    assert language_id.learn_dictionaries(language_id.sample_texts(docs, F.lit(True))) == {}
    assert language_id.identify(docs, {}).first()["lang_pred"] == "und"


def test_sample_is_bounded_for_each_language(spark):
    sample = language_id.sample_texts(corpus(spark), F.lit(True), rows=10).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in sample} == dict.fromkeys(POOLS, 10)
