"""The polemic index: conflict relative to popularity, weighed by how rare it is and how long the page was active."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schema import ALL_TIME, ARTICLE
from .tree import years


def paired(counts: DataFrame, pages: DataFrame) -> DataFrame:
    """Popularity beside conflict of the articles that have any conflict."""
    articles = pages.where(F.col("page_type") == ARTICLE).select("page_id")
    return counts.where(F.col("conflict") > 0).join(articles.hint("merge"), "page_id", "left_semi")


def histogram(pairs: DataFrame) -> DataFrame:
    """(year, popularity, conflict, count): articles by their pair."""
    return pairs.groupBy("year", "popularity", "conflict").agg(F.count("*").alias("count"))


def grid(cells: DataFrame) -> DataFrame:
    """The histogram over every popularity and every conflict of a year, zero where no article is."""
    p, c = cells.select("year", "popularity").distinct(), cells.select("year", "conflict").distinct()
    return p.join(c, "year").join(cells, ["year", "popularity", "conflict"], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


def dominance(cells: DataFrame) -> DataFrame:
    """(year, popularity, conflict, count): articles of at most this popularity and at least this conflict."""
    down = Window.partitionBy("year", "popularity").orderBy(F.desc("conflict"))
    up = Window.partitionBy("year", "conflict").orderBy("popularity")
    by_conflict = grid(cells).withColumn("count", F.sum("count").over(down))
    return by_conflict.withColumn("count", F.sum("count").over(up))


def dominating(cells: DataFrame) -> DataFrame:
    """(year, popularity, conflict, count) as :func:`dominance`, of the cells that exist only.

    The popularities up to p are a union of blocks [k * 2**l, (k + 1) * 2**l), one for each bit
    of p + 1.  Each cell is added to its blocks, a logarithmic number, and summed there by
    falling conflict; so nothing is as large as all popularities by all conflicts of a year.
    """
    one = F.lit(1).cast("bigint")
    highest = cells.agg(F.ceil(F.log2(F.max("popularity") + 2)).cast("int").alias("_top"))  # one row
    levelled = cells.crossJoin(F.broadcast(highest)).withColumn("_level", F.explode(F.sequence(F.lit(0), F.col("_top"))))
    block = lambda c: F.call_function("shiftright", c, F.col("_level"))
    own, upto = block(F.col("popularity")), block(F.col("popularity") + one)
    keys = ["year", "_level", "_block", "conflict"]
    sources = levelled.where(own % 2 == 0).groupBy("year", "_level", own.alias("_block"), "conflict").agg(F.sum("count").alias("_n"))
    asked = levelled.where(upto % 2 == 1).select("year", "_level", (upto - one).alias("_block"), "conflict", "popularity")
    both = sources.select(*keys, "_n", F.lit(None).cast("bigint").alias("popularity")).unionByName(asked.select(*keys, F.lit(0).cast("bigint").alias("_n"), "popularity"))
    sums = both.withColumn("_n", F.sum("_n").over(Window.partitionBy("year", "_level", "_block").orderBy(F.desc("conflict"))))
    return sums.where(F.col("popularity").isNotNull()).groupBy("year", "popularity", "conflict").agg(F.sum("_n").alias("count"))


def untimed(pairs: DataFrame, dominated: DataFrame, live: DataFrame) -> DataFrame:
    """(page_id, year, weight): (conflict / popularity) * log10(articles / dominating articles).

    Pairs are as many as pages and compress so well that their file looks small enough to be broadcast; they aren't.
    """
    weight = F.col("conflict") / F.col("popularity") * F.log10(F.col("totalpagecount").cast("double") / F.col("count"))
    return pairs.join(dominated.hint("merge"), ["year", "popularity", "conflict"]).join(F.broadcast(live), "year").select("page_id", "year", weight.alias("weight"))  # live has one row a year


def _days(later, earlier):
    return F.timestamp_diff("MICROSECOND", earlier, later) / F.lit(86400e6)


def time_weights(spans: DataFrame) -> DataFrame:
    """(page_id, year, weight): days between a page's first and last revision, by year and in all time."""
    first, last = F.col("mintimestamp"), F.col("maxtimestamp")
    start = F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz")
    end = F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")
    axis = F.array_append(years(F.col("minyear"), F.col("maxyear")), F.lit(ALL_TIME))
    days = F.when(F.col("year") == ALL_TIME, _days(last, first)).otherwise(_days(F.least(last, end), F.greatest(first, start)))
    return spans.withColumn("year", F.explode(axis)).select("page_id", "year", days.alias("weight"))


def articles_polemic(untimed_weights: DataFrame, weights: DataFrame) -> DataFrame:
    return untimed_weights.join(weights.withColumnRenamed("weight", "_days").hint("merge"), ["page_id", "year"]).select("page_id", "year", (F.col("weight") * F.col("_days")).alias("weight"))


def rolled_up(articles: DataFrame, tree: DataFrame) -> DataFrame:
    """Topics and the whole: the sum over the articles below."""
    return articles.join(tree.hint("merge"), "page_id").groupBy(F.col("parent_id").alias("page_id"), "year").agg(F.sum("weight").alias("weight"))
