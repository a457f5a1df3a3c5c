"""Distinct editors by page and year from a stream of revisions.

An optional extra: state holds one row for each (page, year, user), kept for as long
as the watermark allows late edits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_edits(revisions: DataFrame, lateness: str = "30 days") -> DataFrame:
    """Each user's first edit of a page in a year, once.  rev_timestamp must be a timestamp with time zone."""
    stream = revisions.where(F.col("user_id").isNotNull()).withWatermark("rev_timestamp", lateness)
    return stream.select("page_id", "user_id", F.year("rev_timestamp").alias("year"), "rev_timestamp").dropDuplicatesWithinWatermark(["page_id", "user_id", "year"])
