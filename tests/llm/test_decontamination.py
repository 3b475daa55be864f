from __future__ import annotations

from helpers import documents, sentences
from pyspark.sql import functions as F

from celluloid.llm import decontamination

ITEMS = "item_id long, question string, answer string"


def items(spark, rows):
    return spark.createDataFrame(rows, ITEMS)


def benchmark(count=60):
    return [(k, sentences(5000 + k, 20 + k % 70), sentences(6000 + k, 3 + k % 9) if k % 3 else None) for k in range(count)]


def corpus():
    bench = benchmark()
    rows = []
    for k in range(80):
        text = sentences(k, 150 + k)
        if k % 4 == 0:
            item = bench[k % len(bench)]
            passage = item[1] + ". " + (item[2] or "")
            text = text[:300] + "\n" + (passage.upper() if k % 8 else passage.replace(" ", ", ")) + " " + text[300:]
        if k % 4 == 1:
            text += " " + " ".join(bench[k % len(bench)][1].split()[:8])  # a short quotation is not a leak
        rows.append((k, text))
    return rows + [(900, None), (901, ""), (902, " . ,")]


def brute(rows, bench):
    found = set()
    for doc_id, text in rows:
        words = decontamination.plain_words(text)
        for item_id, question, answer in bench:
            item = decontamination.Item(item_id, decontamination.plain_words(question), decontamination.plain_words(answer))
            if (item.question or item.answer) and decontamination.verify(item, words, {}, 5, decontamination.OVERLAP)[0]:
                found.add((doc_id, item_id))
    return found


def test_matches_equal_brute_force(spark, monkeypatch):
    rows, bench = corpus(), benchmark()
    expected = brute(rows, bench)
    assert {d for d, _ in expected} == {k for k in range(80) if k % 4 == 0}
    for shard, span in ((decontamination.SHARD_WORDS, decontamination.SPAN_CELLS), (300, 8)):
        monkeypatch.setattr(decontamination, "SPAN_CELLS", span)
        monkeypatch.setattr(decontamination.shards, "__defaults__", (shard,))
        got = decontamination.matches(documents(spark, rows), items(spark, bench)).collect()
        assert {(r["doc_id"], r["item_id"]) for r in got} == expected and len(got) == len(expected)


def test_retrieval_equals_unpruned_scores():
    bench = [decontamination.Item(k, q.split(), (a or "").split()) for k, q, a in benchmark()]
    index = decontamination.Index(bench)
    for _, text in corpus():
        found = (text or "").encode().split()
        expected = set()
        cells = [found[k : k + decontamination.CHUNK_WORDS] for k in range(0, len(found), decontamination.CHUNK_WORDS)]
        for passage in [a + b for a, b in zip(cells, cells[1:])] or cells:
            own = {index.known[w] for w in passage}
            for place, terms in enumerate(index.chunk_terms):
                if sum(i for t, i in terms.items() if t in own) >= index.chunk_threshold[place] - 1e-9:
                    expected.add(index.chunk_item[place])
        assert index.retrieve(found) == expected


def test_common_terms_in_many_blocks(monkeypatch):
    monkeypatch.setattr(decontamination, "COMMON_BLOCKS", 1)
    test_retrieval_equals_unpruned_scores()


def test_clean_keeps_rows_and_columns(spark):
    rows = corpus()
    docs = documents(spark, [*rows, (3, rows[3][1])]).withColumnRenamed("source", "item_id")
    kept = decontamination.clean(docs, items(spark, benchmark()))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted([k for k in range(80) if k % 4] + [3, 900, 901, 902])
    assert decontamination.clean(docs.limit(0), items(spark, benchmark())).count() == 0


def test_edge_items(spark):
    docs = documents(spark, [(1, "alpha beta gamma delta epsilon zeta"), (2, None)])
    bench = [(1, None, None), (None, "alpha beta gamma delta epsilon", None), (2, "", " "), (3, "beta gamma", "zeta"), (3, "beta gamma", "zeta"), (4, "gamma beta", None), (5, None, "epsilon zeta")]
    got = decontamination.matches(docs, items(spark, bench)).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in got) == [(1, 3), (1, 3), (1, 5)]
    assert decontamination.matches(docs, items(spark, [])).count() == 0


def test_question_and_answer(spark):
    rows = spark.createDataFrame([("One. Two three. Four?",), ("Only one.",), ("No end",), ("A.\nB.",), (None,), ("",)], "text string")
    question, answer = decontamination.question_and_answer("text")
    got = [tuple(r) for r in rows.select(question, F.coalesce(answer, F.lit(""))).collect()]
    assert got == [("One. Two three.", "Four?"), ("Only one.", ""), ("No end", ""), ("A.", "B."), (None, ""), ("", "")]


def test_cut_and_edited_last_sentences(spark):
    rare = [f"rare{k}" for k in range(400)]
    bench, rows = [], []
    for k, (n, m) in enumerate([(40, 3), (40, 9), (30, 15), (14, 9), (11, 9), (60, 7), (90, 30), (10, 1), (12, 18)]):
        question, answer = sentences(7000 + k, n), sentences(8000 + k, m, rare)
        bench.append((k, question, answer))
        last = answer.split()
        last[m // 2] = "changed"
        passages = [question, question + " " + " ".join(last)]
        if n < 0.6 * (n + m) and m >= 2 * decontamination.WIDTH:
            passages = [sentences(1, 5) + " " + answer]  # the answer is most of the item
        around = sentences(9000 + k, 200)
        rows += [(10 * k + i, around[:400] + " " + p + " . " + around[400:]) for i, p in enumerate(passages)]
        rows.append((10 * k + 5, around + " " + answer + " " + " ".join(question.split()[: n // 3])) if m < 5 else (10 * k + 5, around))
    got = decontamination.matches(documents(spark, rows), items(spark, bench)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, d // 10) for d, _ in rows if d % 10 < 5}
    kept = decontamination.clean(documents(spark, rows), items(spark, bench)).collect()
    assert {r["doc_id"] for r in kept} == {d for d, _ in rows if d % 10 == 5}


def test_short_questions_need_their_answers(spark):
    docs = documents(spark, [(1, "so what is this and that is all"), (2, "what is this it is a river in the north")])
    bench = [(1, "what is this", "a river in"), (2, "what is", "lakes")]
    assert [tuple(r)[:2] for r in decontamination.matches(docs, items(spark, bench)).collect()] == [(2, 1)]
