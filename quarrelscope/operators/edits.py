"""Per-revision columns and filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _in_page(*order: str):
    return Window.partitionBy("page_id").orderBy(*order)


def serial_id(*order: str) -> Column:
    """1..n within the page in stream order."""
    return F.row_number().over(_in_page(*order))


def char_diff(*order: str) -> Column:
    """Text length minus that of the revision before; the first one counts from 0."""
    return F.col("rev_charweight") - F.lag("rev_charweight", 1, 0.0).over(_in_page(*order))


def registered(revisions: DataFrame) -> DataFrame:
    return revisions.where(F.col("user_id").isNotNull())


def reverts(revisions: DataFrame) -> DataFrame:
    return revisions.where(F.col("rev_isrevert") > 0)


def graph_edits(revisions: DataFrame) -> DataFrame:
    """Edits that count for the similarity graph: by registered users that are no bots."""
    return registered(revisions).where(~F.col("user_isbot"))


def known_user(user: Column, anonymous: Column) -> Column:
    """The anonymous sentinel as null."""
    return F.nullif(user, anonymous)
