"""Top tens of articles: by topic, over all topics, and with empty lists for what is absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schema import ARTICLE

LENGTH = 10


def by_topic(cube: DataFrame, n: int = LENGTH) -> DataFrame:
    """(year, type, topic_id, position, page_id, weight); ties fall to the smaller page."""
    best = Window.partitionBy("year", "type", "topic_id").orderBy(F.desc("weight"), "page_id")
    ranked = cube.where(F.col("page_type") == ARTICLE).withColumn("position", F.row_number().over(best))
    return ranked.where(F.col("position") <= n).select("year", "type", "topic_id", "position", "page_id", "weight")


def overall(topics: DataFrame, n: int = LENGTH) -> DataFrame:
    """The first n of all topics' lists, as topic 0."""
    best = Window.partitionBy("year", "type").orderBy(F.desc("weight"), "page_id")
    ranked = topics.withColumn("position", F.row_number().over(best)).where(F.col("position") <= n)
    return ranked.select("year", "type", F.lit(0).cast("bigint").alias("topic_id"), "position", "page_id", "weight")


def lists(topics: DataFrame) -> DataFrame:
    """(year, type, topic_id, pages): an ordered list for each topic and type of a year, empty ones included."""
    every = topics.unionByName(overall(topics))
    full = every.groupBy("year", "type", "topic_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "page_id"))), lambda x: x["page_id"]).alias("pages"))
    axis = lambda c: full.select("year", c).distinct()
    dense = axis("type").join(axis("topic_id"), "year")
    return dense.join(full, ["year", "type", "topic_id"], "left").withColumn("pages", F.coalesce("pages", F.array().cast("array<bigint>")))


def ordered(rows: DataFrame) -> DataFrame:
    """By year with all time last, then index and topic."""
    return rows.orderBy(F.when(F.col("year") == 0, F.lit(2**31 - 1)).otherwise(F.col("year")), "type", "topic_id")
