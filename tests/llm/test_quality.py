from __future__ import annotations

import numpy as np
import pytest
from helpers import documents, sentences
from pyspark.sql import functions as F

from celluloid.llm import quality_classifier, quality_rules
from celluloid.llm.common import bounded_sample, fold
from celluloid.llm.text_stats import FIELDS, text_stats


def brute(text):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    repeated = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            repeated |= {i, i + 1, i + 2}
    seen, duplicates = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), duplicates, len(repeated)


TEXTS = [None, "", " \n\t ", "a b c a b c", "x\x1cy z w", "l\nl\n \n \nl ", "a a a a a", "#a $b <c> é ü", "one two three four\r\none two three", "a b c d e f g"]


def test_statistics_equal_a_plain_count():
    for text in TEXTS:
        assert text_stats(text)[:5] == brute(text), text


def corpus(spark, count=240):
    rows, labels = [], []
    for k in range(count):
        clean = k % 3 > 0
        text = sentences(k, 80 + k % 40)
        rows.append((k, text if clean else " ".join(w + "###" for w in text.split())))
        labels.append((k, int(clean), 0))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_rules_reject_what_labels_reject_and_keep_the_rest(spark):
    docs, labels = corpus(spark)
    rules = quality_rules.learn(quality_rules.labelled(docs, labels))
    assert rules and all(len(r) <= quality_rules.MAX_CONDITIONS for r in rules)
    judged = quality_rules.judge(docs, labels).select("doc_id", "kept", "rule", "base_failed").collect()
    assert all(r["kept"] == (r["doc_id"] % 3 > 0) for r in judged)
    assert all((r["rule"] is None) == r["kept"] for r in judged)


def test_conditional_expression_equals_the_masks(spark):
    docs, _ = corpus(spark, 60)
    rules = [(quality_rules.Condition("symbols_per_word", True, 1.0), quality_rules.Condition("words_per_line", True, 100.0)), (quality_rules.Condition("symbols_per_word", True, 0.5),)]
    rows = quality_rules.statistics(docs).withColumn("rule", quality_rules.verdict(rules)).select("stats.*", "rule").collect()
    for r in rows:
        symbols, per_line = r["n_symbols"] / r["n_words"], r["n_words"] / r["n_lines"]
        assert r["rule"] == (0 if symbols > 1 and per_line > 100 else 1 if symbols > 0.5 else None)


def test_edge_rows_and_missing_labels(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(1, "again"), (None, "no id")]
    docs = documents(spark, rows).withColumnRenamed("source", "quality")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    judged = quality_rules.judge(docs, none)
    assert judged.count() == len(rows) and judged.where("kept").count() == 0
    assert [c for c in docs.columns if c in judged.columns] == docs.columns
    nulls = spark.createDataFrame([(None, 1, 0), (1, None, None), (1, 7, 7)], "doc_id long, quality int, toxic int")
    assert quality_rules.judge(docs, nulls).count() == len(rows)
    assert quality_rules.judge(docs.limit(0), none).count() == 0


def test_bounded_sample_is_bounded_and_the_same(spark):
    frame = spark.range(5000).withColumnRenamed("id", "doc_id")
    first = {r[0] for r in bounded_sample(frame, 100, "doc_id").collect()}
    assert len(first) == 100
    assert first == {r[0] for r in bounded_sample(frame.repartition(7), 100, "doc_id").collect()}
    assert bounded_sample(frame, 9000, "doc_id").count() == 5000


def test_positive_unlabelled_risk_parts_two_classes():
    rng = np.random.default_rng(2)
    good = np.column_stack([rng.normal(2, 1, 4000), rng.normal(0, 1, 4000)])
    bad = np.column_stack([rng.normal(-2, 1, 1000), rng.normal(0, 1, 1000)])
    model = quality_classifier.fit(good[:2000], np.concatenate([good[2000:], bad[:500]]), 0.8)
    right = np.concatenate([model.margin(good) > 0, model.margin(bad) <= 0])
    assert right.mean() > 0.9


def test_classifier_on_held_out_rows(spark):
    docs, labels = corpus(spark, 400)
    stats = quality_rules.statistics(docs).select("doc_id", "stats").cache()
    model = quality_classifier.learn(stats, labels, fold("doc_id", 5) != 0)
    scored = quality_classifier.score(stats, model).where(fold("doc_id", 5) == 0).select("doc_id", "score").collect()
    assert len(scored) > 40
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 3 > 0) for r in scored]
    assert np.mean(right) > 0.95


@pytest.mark.parametrize(("labels", "expected"), [([], 0.5), ([(0, 0), (1, 0)], 0.0)])
def test_without_positives_the_score_is_constant(spark, labels, expected):
    docs = documents(spark, [(k, t) for k, t in enumerate(TEXTS)])
    stats = quality_rules.statistics(docs).select("doc_id", "stats")
    model = quality_classifier.learn(stats, spark.createDataFrame(labels, "doc_id long, quality int"), F.lit(True))
    assert {r["score"] for r in quality_classifier.score(stats, model).collect()} == {expected}


def test_only_positive_labels_use_the_estimated_prior(spark):
    docs, labels = corpus(spark, 200)
    stats = quality_rules.statistics(docs).select("doc_id", "stats").cache()
    model = quality_classifier.learn(stats, labels.where("quality = 1"), F.lit(True))
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(stats, model).collect()}
    good, bad = ([s for i, s in scores.items() if (i % 3 > 0) == kind] for kind in (True, False))
    assert np.median(good) > np.median(bad)
    assert len(FIELDS) == len(stats.schema["stats"].dataType.fields)
