"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontam, hard_negatives, html, importance, jaccard, maxent, packing, passages, quality, secret_scan, toxicity
from .common import table

WORD = r"[^\x20\x09-\x0D]+"


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.extract(pages, html.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = maxent.held_out("doc_id")
    model = maxent.train(docs.where(~out))
    scored = maxent.score(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"),
                         "base_score", "score")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.train(docs))
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *(of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
                        F.sha2(joined(F.filter("spans", lambda x: x["kind"] != "markov")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")), quality.POLICIES[quality.DEFAULT])
    base = F.col("fail_mask").bitwiseAND(F.lit(quality.BASE_MASK)) != 0
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), "kept", "fail_mask")


QUALITY_CTES = rf"""
quality_text AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM {{docs}}),
quality_words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM quality_text),
quality_tri AS (SELECT doc_id, i, x, lead(x, 1) OVER p AS y, lead(x, 2) OVER p AS z FROM quality_words WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
quality_again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM quality_tri WHERE z IS NOT NULL) WHERE n > 1),
quality_cover AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, i FROM quality_again UNION ALL SELECT doc_id, i + 1 FROM quality_again UNION ALL SELECT doc_id, i + 2 FROM quality_again) GROUP BY doc_id),
quality_lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM quality_text) WHERE regexp_matches(l, '{WORD}') GROUP BY doc_id),
quality_m AS (SELECT q.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words,
  coalesce(l.n, 0) AS n_lines, length(t) - length(regexp_replace(t, '[A-Za-z]|[^\x00-\x7F]', '', 'g')) AS n_letters
  FROM quality_text q LEFT JOIN quality_cover c ON c.doc_id = q.doc_id LEFT JOIN quality_lines l ON l.doc_id = q.doc_id),
quality_ledger AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 5 * n_dup_lines > 2 * n_lines THEN 8 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 12 * n_words THEN 32 ELSE 0 END)
  + (CASE WHEN 2 * n_letters < word_chars THEN 64 ELSE 0 END) AS fail_mask FROM quality_m)"""

OP8_SQL = "WITH " + QUALITY_CTES.format(docs="documents").strip() + """
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, fail_mask & 3 <> 0 AS base_failed, fail_mask = 0 AS kept, fail_mask::BIGINT AS fail_mask
FROM quality_ledger"""

ESCAPED_TURN = "\\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", ESCAPED_TURN), (-7, 1, "assistant", ESCAPED_TURN)], turns.schema)
    return chat.digests(chat.format_turns(chat.turn_records(turns.unionByName(extra)))).drop("n_mappings")


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH usable AS (
  SELECT vec_id, row_number() OVER () AS r, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same, b.r, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT ar, vec_id AS positive_id, r AS pr, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5)
SELECT s.anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.ar = p.ar AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
WINDOW w AS (PARTITION BY s.ar, pr ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 5"""


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir).drop("ids")


QUERIES = {"pipeline": pipeline, "op1_html": op1_html, "op2_toxicity": op2_toxicity, "op3_ngram_jaccard": op3_ngram_jaccard, "op4_decontamination": op4_decontamination,
           "op5_lm_scoring": op5_lm_scoring, "op6_packing": op6_packing, "op7_secrets": op7_secrets, "op8_quality": op8_quality, "op9_chat": op9_chat,
           "op10_passages": op10_passages, "op11_importance": op11_importance, "op12_hard_negatives": op12_hard_negatives, "op13_bpe": op13_bpe}
ORACLES = {"op8_quality": OP8_SQL, "op12_hard_negatives": OP12_SQL}
