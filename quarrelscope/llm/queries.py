"""The queries of the ten corpus operators over the synthetic tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, common, html, licenses, lines, packing, pii, quality, repeats, simhash, tiling


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and benchmark item that leaked into it."""
    return tiling.leaks(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark")).drop("tiles")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(licenses.document_files(common.read(spark, sf_dir, "documents")))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations hold no tool calls: every row gets some, with results and dependencies, by the rules of chat.with_calls."""
    return chat.report(chat.with_calls(common.read(spark, sf_dir, "conversations")), chat.TOOLS)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(common.read(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(common.read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(common.read(spark, sf_dir, "documents")).drop("ids")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(common.read(spark, sf_dir, "documents"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(common.read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measured(common.read(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(common.read(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_licenses": op2_licenses,
    "op3_chat": op3_chat,
    "op4_line_dedup": op4_line_dedup,
    "op5_repeats": op5_repeats,
    "op6_packing": op6_packing,
    "op7_pii": op7_pii,
    "op8_simhash": op8_simhash,
    "op9_quality": op9_quality,
    "op10_html": op10_html,
}
ORACLE_SQL: dict[str, str] = {"op2_licenses": licenses.oracle_sql(), "op9_quality": quality.oracle_sql()}
