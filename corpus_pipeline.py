"""Training corpus from `documents`: five stages, each over all that the stage before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last
return the columns of documents.

In every stage a null text counts as empty, repeated rows and rows without an
id are rows like any other (near_dedup keeps one of those with equal or close
texts), columns besides doc_id and text are handed on unread, and an empty
table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import decontam, packing, quality, secret_scan, simhash
from riskframe.llm.common import stored
from riskframe.llm.queries import quality_model, table, tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; empty and null texts are scored like a text without words.
    With too few labels to learn from, all score 0.5 and stay."""
    return quality.accepted(docs, quality_model(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the one of least doc_id, ids before none. Empty and null texts are
    one group."""
    return simhash.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a copy of a benchmark item; empty and null texts hold none."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every credential in the texts by a mark; no document goes, empty and null texts stay as they are."""
    return secret_scan.redacted(docs, secret_scan.learn(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the token ids of what is left into sequences of at most 1024 tokens; an empty or null text is its end id alone."""
    pieces = packing.pack(docs, tokenizer_path())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality_classifier", quality_filter), ("simhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontaminate), ("secret_scan", redact_secrets), ("packing", pack_sequences)]

#: a trained classifier, XXH64 fingerprints, alignments and token ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
