"""Ranks and percentiles of the cube, among all pages of a type and among those of a topic.

Windows run over the distinct weights of a partition with their counts, not over its
pages: a weight that many pages share (zero, above all) is one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GLOBAL_KEYS = ("type", "year", "page_type")
TOPIC_KEYS = (*GLOBAL_KEYS, "topic_id")
MEASURES = ("weight", "percentile", "dense_percentile", "rank", "topic_percentile", "topic_dense_percentile", "topic_rank", "year")


#: Slices of weights by doubling.
SLICES = 64


def _slice(weight: str):
    """A whole number that rises with the weight; it depends on nothing else, so slices need no sample."""
    w = F.col(weight)
    return (F.signum(w) * F.floor(F.log2(1 + F.abs(w)) * SLICES)).cast("int")


def standings(cube: DataFrame, keys: tuple[str, ...] = GLOBAL_KEYS, prefix: str = "") -> DataFrame:
    """(keys, weight, percentile, dense_percentile, rank) of each distinct weight.

    Sums over smaller weights are those inside the weight's slice plus those of smaller
    slices, so the largest sort is a slice's, not a partition's.
    """
    values = cube.groupBy(*keys, "weight").agg(F.count("*").alias("_n")).withColumn("_slice", _slice("weight"))
    slices = values.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_slice_n"), F.count("*").alias("_slice_distinct"))
    smaller = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    slices = slices.select(
        *keys, "_slice",
        F.coalesce(F.sum("_slice_n").over(smaller), F.lit(0)).alias("_before"),
        F.coalesce(F.sum("_slice_distinct").over(smaller), F.lit(0)).alias("_dense_before"),
        F.sum("_slice_n").over(whole).alias("_all"),
        F.sum("_slice_distinct").over(whole).alias("_distinct"),
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy("weight")
    below = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    placed = values.select(*keys, "_slice", "weight", "_n", F.coalesce(below, F.lit(0)).alias("_inside"), F.row_number().over(inside).alias("_dense"))
    placed = placed.join(slices.hint("merge"), [*keys, "_slice"])  # dealt and sorted by these already
    lower = F.col("_before") + F.col("_inside")
    percentile = lower / F.greatest(F.col("_all") - 1, F.lit(1)).cast("double")
    dense = (F.col("_dense_before") + F.col("_dense") - F.lit(1.0)) / F.greatest(F.col("_distinct") - 1, F.lit(1)).cast("double")
    rank = F.col("_all") - lower - F.col("_n") + 1
    return placed.select(*keys, "weight", percentile.alias(f"{prefix}percentile"), dense.alias(f"{prefix}dense_percentile"), rank.alias(f"{prefix}rank"))


def ranked(cube: DataFrame, overall: DataFrame | None = None, in_topic: DataFrame | None = None) -> DataFrame:
    """The cube with both standings; overall and in_topic: those of the cube, where they are at hand.

    Most of the cube has weight zero.  Its standings are a row for each type, year, page
    type and topic, a catalogue's size, and are broadcast; the other weights, none of which
    stands out, meet theirs by a shuffle.
    """
    zero = F.col("weight") == 0
    overall = standings(cube) if overall is None else overall
    in_topic = standings(cube, TOPIC_KEYS, "topic_") if in_topic is None else in_topic
    at_zero = lambda s: F.broadcast(s.where(zero).drop("weight"))
    some = cube.where(~zero).join(overall.where(~zero).hint("merge"), [*GLOBAL_KEYS, "weight"]).join(in_topic.where(~zero).hint("merge"), [*TOPIC_KEYS, "weight"])
    return some.unionByName(cube.where(zero).join(at_zero(overall), [*GLOBAL_KEYS]).join(at_zero(in_topic), [*TOPIC_KEYS]))


def nested(ranked_cube: DataFrame) -> DataFrame:
    """(page_id, stats): by type and then by year; all time comes first."""
    by_year = F.sort_array(F.collect_list(F.struct("year", *MEASURES[:-1])))
    per_type = ranked_cube.groupBy("page_id", "type").agg(by_year.alias("measurements"))
    return per_type.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("type", "measurements"))).alias("stats"))


def rankings(ranked_cube: DataFrame, topic_names: DataFrame) -> DataFrame:
    """(page_id, index, among, span, rank, percentile, dense_percentile, value): among all, and for articles in the topic.

    Percentiles are whole percents.  topic_names: (topic_id, topic).
    """
    from ..functions.text import percentage

    span = F.when(F.col("year") == 0, F.lit("all")).otherwise(F.col("year").cast("string")).alias("span")
    named = ranked_cube.join(F.broadcast(topic_names), "topic_id", "left")  # the topic catalogue
    one = lambda p, among: F.struct(among.alias("among"), F.col(f"{p}rank").alias("rank"), percentage(F.col(f"{p}percentile")).alias("percentile"), percentage(F.col(f"{p}dense_percentile")).alias("dense_percentile"))
    both = F.when(F.col("page_type") == "article", F.array(one("", F.lit("all")), one("topic_", F.col("topic")))).otherwise(F.array(one("", F.lit("all"))))
    return named.select("page_id", F.col("type").alias("index"), span, F.col("weight").alias("value"), F.explode(both).alias("r")).select("page_id", "index", "r.among", "span", "r.rank", "r.percentile", "r.dense_percentile", "value")
