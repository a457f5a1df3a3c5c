"""The topic tree, time bounds and creation years."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.schema import ALL_TIME, ARTICLE, GLOBAL, GLOBAL_ID, TOPIC


def page_type() -> Column:
    """global for page 0, topic for other pages below it, article for the rest."""
    return F.when(F.col("page_id") == GLOBAL_ID, GLOBAL).when(F.col("parent_id") == GLOBAL_ID, TOPIC).otherwise(ARTICLE)


def timebounds(revisions: DataFrame) -> DataFrame:
    """One row: minyear, maxyear, mintimestamp, maxtimestamp."""
    return revisions.agg(F.min("rev_year").alias("minyear"), F.max("rev_year").alias("maxyear"), F.min("rev_timestamp").alias("mintimestamp"), F.max("rev_timestamp").alias("maxtimestamp"))


def page_spans(revisions: DataFrame) -> DataFrame:
    """First and last year and timestamp of each page."""
    return revisions.groupBy("page_id").agg(F.min("rev_year").alias("minyear"), F.max("rev_year").alias("maxyear"), F.min("rev_timestamp").alias("mintimestamp"), F.max("rev_timestamp").alias("maxtimestamp"))


def with_creation_year(pages: DataFrame, spans: DataFrame, bounds: DataFrame) -> DataFrame:
    """page_creationyear: an article's first revision's year, the first year of all for other pages."""
    own = spans.select("page_id", F.col("minyear").alias("_own"))
    first = bounds.select(F.col("minyear").alias("_first"))
    year = F.when(F.col("page_type") == ARTICLE, F.col("_own")).otherwise(F.col("_first"))
    return pages.join(own.hint("merge"), "page_id", "left").crossJoin(F.broadcast(first)).withColumn("page_creationyear", year).drop("_own", "_first")  # bounds has one row


def pagetree(pages: DataFrame) -> DataFrame:
    """(page_id, parent_id): each page's parent and grandparent, without repeats."""
    own = pages.select("page_id", "parent_id")
    parents = own.select("parent_id").distinct()  # the topic catalogue and the root
    above = own.select(F.col("page_id").alias("parent_id"), F.col("parent_id").alias("grandparent_id")).where(F.col("grandparent_id").isNotNull()).join(F.broadcast(parents), "parent_id", "left_semi")
    higher = own.join(F.broadcast(above), "parent_id").select("page_id", F.col("grandparent_id").alias("parent_id"))
    return own.unionByName(higher).distinct()


def years(first: Column, last: Column) -> Column:
    """The years from first to last as an array; empty where first is later (sequence would count down)."""
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def year_axis(bounds: DataFrame) -> DataFrame:
    """Every year of the bounds, and the one that stands for all time."""
    every = F.array_append(years(F.col("minyear"), F.col("maxyear")), F.lit(ALL_TIME))
    return bounds.select(F.explode(every).alias("year"))


def with_years(pages: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each page in each year from its creation to the last, and in all time."""
    last = bounds.select(F.col("maxyear").alias("_last"))
    axis = F.array_append(years(F.col("page_creationyear"), F.col("_last")), F.lit(ALL_TIME))
    return pages.crossJoin(F.broadcast(last)).withColumn("year", F.explode(axis)).drop("_last")  # bounds has one row
