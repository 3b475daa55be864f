from __future__ import annotations

import importlib.util
from pathlib import Path

import pytest
from helpers import pool, sentences
from test_decontamination import benchmark
from test_decontamination import brute as leaks
from test_mixture import expected_targets
from test_ngram_join import brute as groups

from celluloid.llm import queries
from celluloid.llm.text_stats import text_stats

ROOT = Path(__file__).resolve().parents[2]
spec = importlib.util.spec_from_file_location("corpus_pipeline", ROOT / "corpus_pipeline.py")
pipeline = importlib.util.module_from_spec(spec)
spec.loader.exec_module(pipeline)

GERMAN = pool("sch", "über", "ung", "zei", "fen", "haus", "bär", "licht")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")
    bench = [(i, q + ". " + (a or "Yes.")) for i, q, a in benchmark(30)]
    rows, labels = [], []
    for k in range(400):
        text = sentences(k, 60 + k % 80, None if k % 4 else GERMAN)
        if k % 10 == 3:
            text = " ".join(w + "%%%" for w in text.split())
        if k % 10 == 5:
            text = sentences(5, 90) + f" copy{k}"
        if k % 10 == 7:
            text += "\n" + bench[k % 30][1]
        if k % 50 == 11:
            text = [None, "", "too short", " 1 2 3 " * 30, "the " * 90][k // 50 % 5]
        rows.append((k, text, "en" if k % 4 else "de", f"s{k % 3}" if k % 7 else None, 0))
        labels.append((k, int(k % 10 != 3), 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(root / "labels.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    bench = [tuple(r) for r in queries.benchmark_items(spark, folder).collect()]
    columns = docs.columns
    for number, (name, stage) in enumerate(pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        sources = {r["doc_id"]: r["source"] for r in docs.collect()}
        docs = pipeline.staged(stage(spark, docs, folder), "test-stage")
        after = {r["doc_id"] for r in docs.collect()}
        if number == 0:
            good = {i for i, t in before.items() if i % 10 != 3 and text_stats(t)[0] >= 50 and 2 * text_stats(t)[4] <= text_stats(t)[0]}
            assert after == good
        elif number == 1:
            assert after == {i for i, t in before.items() if any(c.isalpha() for c in t)}
        elif number == 2:
            assert after == {i for i, (_, low) in groups(before.items(), 5, 80).items() if i == low} and len(after) < len(before)
        elif number == 3:
            hit = {d for d, _ in leaks(before.items(), bench)}
            assert hit and after == set(before) - hit
        else:
            sizes: dict = {}
            for i, t in before.items():
                sizes[sources[i]] = sizes.get(sources[i], 0) + len(t.split())
            for source, goal in expected_targets(sizes).items():
                own = [r for r in docs.collect() if r["source"] == source]
                assert all(abs(r["target"] - goal) < 1e-6 for r in own) and abs(sum(r["taken"] for r in own) - goal) <= 0.02 * goal
            assert after == set(before)
        assert number == 4 or docs.columns == columns, name


def test_run_equals_its_stages_and_takes_empty_tables(spark, folder, tmp_path):
    assert pipeline.run(spark, folder).count() > 100
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered_queries_return_their_columns(spark):
    wanted = {
        "op1_mixture": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
        "op2_token_counts": {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"},
        "op3_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
        "op4_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op5_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
        "op6_warc": {"page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string", "record_type": "string", "refers_to": "bigint"},
        "op7_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op8_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op9_ngram_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
        "op10_decontamination": {"doc_id": "bigint", "item_id": "bigint"},
        "op11_merkle_manifest": {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"},
        "op12_disclosure": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
        "op13_hard_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
    }
    made = queries.queries()
    assert set(made) == set(wanted)
    for name, columns in wanted.items():
        frame = made[name](spark, "/root/testdata/sf0.001")
        assert columns.items() <= dict(frame.dtypes).items(), name
        assert frame.count() > 0, name
