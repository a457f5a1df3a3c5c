"""The zero-filled cube of indices by page and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tree import with_years


def conflict_index(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("conflict") > 0).select(F.lit("conflict").alias("type"), "page_id", "year", F.col("conflict").cast("double").alias("weight"))


def polemic_index(articles: DataFrame, above: DataFrame) -> DataFrame:
    return articles.unionByName(above).select(F.lit("polemic").alias("type"), "page_id", "year", "weight")


def present_types(indices: DataFrame, pages: DataFrame) -> DataFrame:
    """(type, page_type) that occur: at most two by three rows."""
    return indices.join(pages.select("page_id", "page_type").hint("merge"), "page_id").select("type", "page_type").distinct()


def zero_filled(indices: DataFrame, pages: DataFrame, bounds: DataFrame) -> DataFrame:
    """(type, page_id, topic_id, page_type, year, weight) of every page in every year of its life."""
    types = present_types(indices, pages)
    axis = with_years(pages.select("page_id", F.col("parent_id").alias("topic_id"), "page_type", "page_creationyear"), bounds).drop("page_creationyear")
    grid = axis.join(F.broadcast(types), "page_type")
    return grid.join(indices.hint("merge"), ["type", "page_id", "year"], "left").select("type", "page_id", "topic_id", "page_type", "year", F.coalesce("weight", F.lit(0.0)).alias("weight"))
