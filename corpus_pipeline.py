"""The corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; run() writes each stage's rows as Parquet and rereads them as the next one's
documents.  All stages but the last return the columns of docs, whatever they are called;
an empty table passes through; texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrelscope.llm import common, lines, packing, quality, simhash, tiling


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects; a null or empty text has no words and goes.  Repeated rows go or stay alike."""
    return quality.kept(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines that repeat in one document or, as lines.py tells, in several are cut from later ones.

    Lines are cut between groups of near-duplicates, not inside them: a copy of a whole
    document reaches the next stage as like its first document as it is here.  Null texts
    stay null; rows are told apart by id and text.
    """
    return lines.cleaned(docs, groups=simhash.wide_grouped(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of smallest id, as simhash.kept tells: five-word shingles, 0.8 of the fingerprint bits alike.

    Null and empty texts are one group; repeated rows become one; rows that share an id only are kept apart.
    """
    return simhash.kept(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks; null texts stay, rows that share an id are judged by their own texts."""
    return tiling.kept(docs, common.read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences; a null text is an empty document, repeated rows are packed one by one."""
    return packing.packed(docs).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Packing and the passes over words can't be told in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
