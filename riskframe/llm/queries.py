"""opN_ queries: each applies its operator to the whole of its table and derives the digest columns from the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (decontam, divergence, html_extract, langid, line_rules, negatives, packing, pattern_packing, pii,
                           quality, secret_scan, sharding, simhash)
from riskframe.llm.catalog import register
from riskframe.llm.spans import count_column, joined_column


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id, of: int):
    """crc32(doc_id as text) mod `of`: the fold of a document."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % of


@register("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, with the item and the alignment score."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_simhash_dedup")
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_print("fp").alias("fingerprint"), "component_id")


@register("op5_secret_scan")
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials in every document: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.learn(docs))
    return found.select("doc_id", *(count_column("spans", k).alias(f"n_{k}") for k in secret_scan.KINDS),
                        F.sha2(joined_column("spans", only_base=True).cast("binary"), 256).alias("base_sha256"),
                        joined_column("spans").alias("spans"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@register("op6_packing")
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token of every document in one piece of one sequence of at most 1024 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    return quality.fit(docs, labels, remainder("doc_id", 5) != 0)


@register("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels are learned from four of five folds."""
    docs = table(spark, sf_dir, "documents")
    scores = quality.scored(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return scores.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


TREE = sharding.HashTree.regular(regions=3, racks=2, shards=4)


@register("op3_sharding", sharding.oracle(TREE))
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 23 by document id, and where each row would be with one shard more."""
    rows = sharding.assign(table(spark, sf_dir, "documents"), TREE)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@register("op8_line_rules")
def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and verdict of the line labelling for every document."""
    docs = table(spark, sf_dir, "documents")
    return line_rules.ruled(docs, line_rules.fit(docs, table(spark, sf_dir, "labels")))


@register("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identified(docs, langid.fit(docs, remainder("doc_id", 4) != 2))
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@register("op10_html_extraction")
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extracted(table(spark, sf_dir, "pages"))


@register("op4_personal_data")
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.learn(docs))
    return found.select("doc_id", *(count_column("spans", k).alias(f"n_{k}") for k in pii.KINDS),
                        F.sha2(joined_column("spans", only_base=True).cast("binary"), 256).alias("base_sha256"),
                        joined_column("spans").alias("spans"))


@register("op11_hard_negatives", negatives.ORACLE)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives of every anchor and positive; every seventh label is moved on by one first."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)


@register("op12_source_divergence", divergence.ORACLE)
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that set each source off."""
    return divergence.audit(table(spark, sf_dir, "documents"))


@register("op13_pattern_packing")
def op13_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, whole if it fits, in sequences of at most 4096 tokens."""
    pieces = pattern_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
