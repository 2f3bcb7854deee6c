"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from assay.llm import bitpack, langid, media, minhash, mixing, neighbours, packing, phrases, quality, runs, secrets, urlrules, vectors
from assay.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """The default vocabulary file; every operator takes another path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).withColumnRenamed("id", "doc_id")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urlrules.RULES, "host string, path string, verdict string")
    out = urlrules.judge_urls(_table(spark, sf_dir, "pages"), rules)
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))
    return out.withColumnRenamed("id", "vec_id")


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = media.encode_media(_table(spark, sf_dir, "documents"), bytes_col="text")
    stored = Scratch(spark, "media").save(coded, "media", compression="zstd")
    return media.describe_media(stored).withColumnRenamed("id", "doc_id")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "tokens").path("blocks")
    blocks = bitpack.write_tokens(_table(spark, sf_dir, "documents"), vocabulary(), path)
    return bitpack.read_tokens(blocks, keep_ids=False).drop("ids")


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs)).withColumnRenamed("id", "doc_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return out.withColumnRenamed("id", "doc_id")


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=2)
    return out.withColumnRenamed("id", "doc_id")


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.fair_queue(_table(spark, sf_dir, "documents"))
    ordered = plan.orderBy("virtual_time", "hash")
    return ordered.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op11_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.periodic_runs(runs.plant_repeats(_table(spark, sf_dir, "documents"))))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_best_fit_packing, op3_url_filters, op4_embedding_near_dedup, op5_media_columns, op6_token_output, op7_secret_scans, op8_quality_classifier, op9_minhash_near_dedup, op10_source_mixing, op11_approximate_neighbours, op12_periodic_runs, op13_phrase_collocations)}

ORACLE_SQL: dict[str, str] = {"op3_url_filters": urlrules.RULES_SQL, "op10_source_mixing": mixing.MIX_SQL, "op12_periodic_runs": runs.RUNS_SQL, "op13_phrase_collocations": phrases.PHRASES_SQL}
