from __future__ import annotations

import numpy as np
from helpers import documents, sentences
from pyspark.sql import functions as F

from celluloid.llm import toxicity
from celluloid.llm.common import fold

RUDE = ["blockhead", "numbskull", "dimwit"]


def corpus(spark, count=500):
    rows, labels = [], []
    for k in range(count):
        words = sentences(k, 30 + k % 50, [f"v{n}" for n in range(300)] + ["the", "of", "and"]).split()
        if k % 4 == 0:
            for n in range(3):
                words.insert((k * 7 + n * 11) % len(words), RUDE[(k + n) % 3] + ("!" if k % 8 else ""))
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(k % 4 == 0)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_whole_texts(spark):
    docs, labels = corpus(spark)
    net = toxicity.learn(docs, labels, fold("doc_id", 5) != 0, fold("doc_id", 5) == 1)
    held = toxicity.score(docs, net).where(fold("doc_id", 5) == 0).select("doc_id", "score").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held]) > 0.95
    scorer = toxicity.Scorer(net)
    late = sentences(1, 40_000, [f"v{n}" for n in range(300)])
    assert scorer.score(late + " blockhead numbskull dimwit") > scorer.score(late)


def test_scorer_equals_the_plain_network(spark):
    net = toxicity.Network.new()
    scorer, lexicon = toxicity.Scorer(net), toxicity.Lexicon()
    for text in [None, "", "one", "one two", sentences(5, 20_000), "The cat and the dog."]:
        numbers = lexicon.of(text)
        rows = np.array([lexicon.rows[i] for i in numbers], dtype=np.int64).reshape(-1, 3)
        pooled, _ = net.pooled(net.embedding[rows[:, 0]] + net.embedding[rows[:, 1]])
        assert abs(scorer.logit(text)[0] - net.logit(pooled)) < 1e-4
    assert scorer.logit("the cat and the dog")[1] == "en" and scorer.logit("der Hund und die Katze")[1] == "de"
    assert scorer.logit("xyzzy")[1] == "other"


def test_gradient_is_the_slope_of_the_loss():
    net = toxicity.Network.new(3)
    rng = np.random.default_rng(1)
    texts = [np.stack([rng.integers(0, 50, 30), 40_000 + rng.integers(0, 20, 30)], axis=1) for _ in range(40)]
    labels = np.arange(40) % 2.0
    for k in range(0, 40, 2):
        texts[k + 1][4] = [77, 41_000]
    trained = toxicity.train(texts, labels)
    logits = np.array([trained.logit(trained.pooled(trained.embedding[t[:, 0]] + trained.embedding[t[:, 1]])[0]) for t in texts])
    assert ((logits > 0) == (labels == 1)).mean() > 0.95
    assert net.bias == 0


def test_threshold_lies_in_the_best_gap():
    cut = toxicity.threshold(np.array([3.0, 2.0, 1.0, -1.0]), np.array([1.0, 1.0, 0.0, 0.0]))
    assert cut == 1.5
    assert toxicity.threshold(np.array([1.0, 1.0]), np.array([1.0, 0.0])) == 0.0


def test_edge_rows_and_missing_labels(spark):
    docs = documents(spark, [(1, None), (1, None), (2, ""), (None, "x"), (3, "y z")])
    for labels, expected in (([], 0.0), ([(3, 1)], 1.0), ([(3, 0), (None, 1), (1, None)], 0.0)):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        net = toxicity.learn(docs, frame, F.col("doc_id").isNotNull(), F.lit(False))
        assert [r["score"] for r in toxicity.score(docs, net).collect()] == [expected] * 5
    two = toxicity.learn(docs, spark.createDataFrame([(3, 1), (2, 0)], "doc_id long, toxic int"), F.lit(True), F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, two).collect())


def test_every_labelled_row_teaches(spark):
    """Each text is a word of its own, whose embedding moves when the text is learned."""
    count = 9_000
    docs = documents(spark, [(k, f"u{k}") for k in range(count)]).repartition(4)
    labels = spark.range(count).selectExpr("id as doc_id", "cast(id % 3 = 0 as int) as toxic")
    net = toxicity.learn(docs, labels, F.col("doc_id") >= 0, F.lit(False))
    own = [toxicity.numbers(f"u{k}".encode())[0] for k in range(count)]
    assert (net.embedding[own] != toxicity.Network.new().embedding[own]).any(axis=1).all()


def test_networks_of_shards_are_averaged(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 100)
    docs, labels = corpus(spark)
    first, second = (toxicity.learn(d, labels, fold("doc_id", 5) != 0, fold("doc_id", 5) == 1) for d in (docs, docs.repartition(7)))
    held = toxicity.score(docs, first).where(fold("doc_id", 5) == 0).select("doc_id", "score").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held]) > 0.9
    assert np.isfinite(second.embedding).all() and second.embedding.shape == first.embedding.shape


def test_cut_from_counts_equals_the_cut_from_rows():
    logits, labels = np.random.default_rng(2).normal(size=400), np.arange(400) % 2.0
    order = np.argsort(-logits)
    ones = np.ones(400)
    assert toxicity.best_cut(ones, labels[order], logits[order], logits[order]) == toxicity.threshold(logits, labels)
