"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import string
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celluloid.llm import decontamination, disclosure, hard_negatives, html_text, language_id, merkle, mixture, ngram_join, quality_classifier, quality_rules, token_counts, toxicity, warc
from celluloid.llm.common import fold, staged, table

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixture.mix(table(spark, sf_dir, "documents"), (1.0, 2.0, 3.0), 3.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.judge(docs, table(spark, sf_dir, "labels"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *(F.col(f"stats.{c}").alias(c) for c in counts), "base_failed", "rule", "kept")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = staged(quality_rules.statistics(docs).select("doc_id", "stats"), "quality-features")
    model = quality_classifier.learn(stats, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    scored = quality_classifier.score(stats, model)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.CaptureIndex.build(table(spark, sf_dir, "pages")).records()
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0, fold("doc_id", 5) == 1)
    scored = toxicity.score(docs, net)
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = language_id.sample_texts(docs, fold("doc_id", 4) != 2)
    decided = language_id.identify(docs.select("doc_id", "text"), language_id.learn_dictionaries(samples))
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    return decided.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), width=3, percent=90)


def benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    question, answer = decontamination.question_and_answer("text")
    return table(spark, sf_dir, "benchmark").select("item_id", question.alias("question"), answer.alias("answer"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), benchmark_items(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    chosen = fold("doc_id", 3) == 0
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    altered = merkle.digest(*(lowered if c == "text" else F.col(c) for c in merkle.FIELDS))
    leaves = docs.withColumn("altered", F.when(chosen, altered))
    made = merkle.manifest(merkle.leaf_rows(leaves, carried=("altered",)))
    tested = merkle.folded(F.coalesce("altered", "leaf"), F.col("proof"))
    made = made.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.siblings_digest(F.col("proof")).alias("proof_sha256"), tested.alias("folded_root"))
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find(table(spark, sf_dir, "documents"))
    counts = (f"n_{kind}" for kind in disclosure.KINDS)
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), disclosure.all_spans(found).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)
    return mined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: made for name, made in globals().items() if name.startswith("op")}


OP6_SQL = """
WITH known AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha256(payload) AS payload_digest FROM known
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM digests WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT d.page_id, d.payload_bytes, d.payload_digest,
       CASE WHEN f.first_id <> d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> d.page_id THEN f.first_id END AS refers_to
FROM digests d LEFT JOIN firsts f ON d.payload_bytes >= 100 AND f.payload_digest = d.payload_digest
"""

OP9_SQL = r"""
WITH RECURSIVE parted AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
           ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS shingles
    FROM parted
), entries AS (
    SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS m, b.n AS n, count(*) AS common
    FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n
    GROUP BY ALL
), links AS (
    SELECT a, b FROM shared WHERE 100 * common >= 90 * (m + n - common)
), reached AS (
    SELECT doc_id AS node, doc_id AS other FROM sets
    UNION
    SELECT r.node, l.b FROM reached r JOIN links l ON r.other = l.a
), smallest AS (
    SELECT node, min(other) AS component_id FROM reached GROUP BY node
)
SELECT s.doc_id, len(s.shingles) AS n_shingles, c.component_id FROM sets s JOIN smallest c ON s.doc_id = c.node
"""


# crc32 bit by bit: each byte is followed by eight steps, marked -1
OP11_SQL = r"""
WITH RECURSIVE given AS (
    SELECT *, row_number() OVER () AS line, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
           coalesce(xor(4294967295, list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
               lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END, 4294967295::BIGINT)) % 3 = 0, false) AS chosen
    FROM documents
), fields AS (
    SELECT doc_id, lang, line, chosen,
           coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
           coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail, coalesce(octet_length(encode(lowered)) || ':' || lowered, '-') AS low_tail
    FROM given
), leaves AS (
    SELECT doc_id, lang, line, sha256(head || tail) AS leaf, sha256(head || CASE WHEN chosen THEN low_tail ELSE tail END) AS altered
    FROM fields
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves
), nodes AS (
    SELECT 0 AS level, lang, place, leaf AS digest, count(*) OVER (PARTITION BY lang) AS size FROM placed
    UNION ALL
    SELECT level + 1, lang, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(size) + 7) // 8
    FROM nodes WHERE size > 1 GROUP BY level, lang, place // 8
), subroots AS (
    SELECT lang, digest, row_number() OVER (ORDER BY lang COLLATE "POSIX" NULLS FIRST) - 1 AS place FROM nodes WHERE size = 1
), upper AS (
    SELECT 0 AS level, place, digest, count(*) OVER () AS size FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(size) + 7) // 8
    FROM upper WHERE size > 1 GROUP BY level, place // 8
), runs AS (
    SELECT 0 AS part, level, lang, place // 8 AS run, list(digest ORDER BY place) AS members FROM nodes WHERE size > 1 GROUP BY ALL
    UNION ALL
    SELECT 1, level, NULL, place // 8, list(digest ORDER BY place) FROM upper WHERE size > 1 GROUP BY ALL
), walk AS (
    SELECT line, lang, 0 AS part, 0 AS level, place, altered AS low, '' AS proof FROM placed
    UNION ALL
    SELECT w.line, w.lang, CASE WHEN r.members IS NULL THEN 1 ELSE w.part END, CASE WHEN r.members IS NULL THEN 0 ELSE w.level + 1 END,
           CASE WHEN r.members IS NULL THEN s.place ELSE w.place // 8 END,
           CASE WHEN r.members IS NULL THEN w.low ELSE sha256(concat(array_to_string(r.members[: (w.place % 8)], ''), w.low, array_to_string(r.members[(w.place % 8) + 2 :], ''))) END,
           CASE WHEN r.members IS NULL THEN w.proof ELSE concat(w.proof, array_to_string(r.members[: (w.place % 8)], ''), array_to_string(r.members[(w.place % 8) + 2 :], '')) END
    FROM walk w
    LEFT JOIN runs r ON r.part = w.part AND r.level = w.level AND r.run = w.place // 8 AND (w.part = 1 OR r.lang IS NOT DISTINCT FROM w.lang)
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang
    WHERE r.members IS NOT NULL OR w.part = 0
), ended AS (
    SELECT line, arg_max(low, part * 1000 + level) AS folded_root, arg_max(proof, part * 1000 + level) AS proof FROM walk GROUP BY line
)
SELECT p.doc_id, p.leaf, s.digest AS subroot, t.digest AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = t.digest AS verified
FROM placed p JOIN ended e ON e.line = p.line JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN upper t ON t.size = 1
"""

OP13_SQL = """
WITH vectors AS (
    SELECT row_number() OVER () AS line, vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.line, a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.line <> b.line WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT line, anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY line ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.line, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.line = p.line AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_warc": OP6_SQL, "op9_ngram_join": OP9_SQL, "op11_merkle_manifest": OP11_SQL, "op13_hard_negatives": OP13_SQL}
