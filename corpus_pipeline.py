"""The corpus pipeline: documents through the training-data operators, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, fertility, line_dedup, pieces, simhash
from basketry.llm.common import fresh_name, stored, table
from basketry.llm.queries import quality_vocabularies, tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    stats, failed, kept = (fresh_name(docs.columns, c) for c in ("_stats", "_failed", "_kept"))
    measured = stored(fertility.add_statistics(docs, quality_vocabularies(), out=stats), "stage-quality")
    judged = fertility.judge(measured, stats=stats, out=(failed, kept))
    return judged.where(F.col(kept)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without copies of earlier lines; ``n_chars`` follows the text."""
    cleaned = line_dedup.dedup_lines(docs, out=fresh_name(docs.columns, "_lines"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    matches = fresh_name(docs.columns, "_matches")
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), out=matches)
    return found.where(~decontaminate.contaminated(matches)).select(*docs.columns)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text that they decode to."""
    return pieces.encode(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: Tokenisation and bit-parallel matching are not SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
