"""The ``opN_<name>`` queries: each applies its operator to the whole of its table and derives the columns
that its contract names. ``ORACLES`` has DuckDB SQL where SQL can express a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import (bpe, decontaminate, html_extract, line_rules, lsh_forest, merkle, spelling, sql, substring, token_counts,
                           toxicity, url_rules, warc, weak_quality)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_weak_quality(spark: SparkSession, sf: str) -> DataFrame:
    scored = weak_quality.weak_quality(_table(spark, sf, "documents"))
    return scored.withColumn("kept", F.col("score") >= weak_quality.KEEP)


def op2_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return lsh_forest.near_duplicates(_table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op3_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(_table(spark, sf, "documents"), with_ids=False)


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf, "documents"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    hit = decontaminate.n_hit()
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))


def op6_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring.substring_dedup(_table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    scored = toxicity.toxicity(_table(spark, sf, "documents"), _table(spark, sf, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rules = line_rules.line_rules(_table(spark, sf, "documents"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        "base_failed", "n_removed_words", "kept")


def op9_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract_main_text(_table(spark, sf, "pages"))


#: The host rules of the URL filter (verdict, host, path).
HOST_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op11_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    hosts = [f"{'@@' if v == 'allow' else ''}||{h}{p}" for v, h, p in HOST_RULES]
    rules = url_rules.rule_table(spark, [*hosts, *url_rules.PATTERNS])
    return url_rules.url_verdicts(_table(spark, sf, "pages"), rules)


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    manifest = merkle.build(merkle.leaf_table(_table(spark, sf, "documents")))
    proved = merkle.with_proof_hash(merkle.proofs(manifest))
    digests = [F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root", "folded_root")]
    return proved.select("doc_id", *digests[:3], "proof_sha256", digests[3], "verified")


QUERIES = {f.__name__: f for f in (
    op1_weak_quality, op2_near_duplicates, op3_byte_bpe, op4_token_counts, op5_decontamination, op6_substring_dedup, op7_toxicity, op8_quality_rules,
    op9_warc, op10_html_text, op11_url_filter, op12_spelling_variants, op13_merkle_manifest)}
#: The others cannot be said in SQL (tokenizers, learned models, tree scoring); the tests hold them against brute force,
#: the libraries, known parameters and held-out labels.
ORACLES = {"op2_near_duplicates": sql.near_duplicates(), "op5_decontamination": sql.decontamination(),
           "op6_substring_dedup": sql.substring_dedup(), "op8_quality_rules": sql.quality_rules(), "op9_warc": sql.warc(),
           "op11_url_filter": sql.url_filter(HOST_RULES), "op12_spelling_variants": sql.spelling_variants(),
           "op13_merkle_manifest": sql.merkle_manifest()}
