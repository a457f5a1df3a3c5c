"""Pages and revisions derived from the star-schema tables.

Parts are articles (id p_partkey + 1000), brands are topics (the number in Brand#N),
lineitems are revisions in (ship date, order, line) order, customers are users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tree import page_type
from ..operators.edits import char_diff, serial_id

ARTICLE_OFFSET = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, page_title) of the topic catalogue."""
    number = F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint")
    return table(spark, sf_dir, "part").select(number.alias("page_id")).distinct().withColumn("page_title", F.concat(F.lit("Topic"), F.col("page_id").cast("string"), F.lit(" things")))


def pages(spark: SparkSession, sf_dir: str, abstracts: bool = True) -> DataFrame:
    """(page_id, page_title, page_abstract, parent_id, page_type); without abstracts the column is null."""
    part = table(spark, sf_dir, "part")
    title = F.concat_ws(" ", F.col("p_name"), F.col("p_partkey").cast("string"))
    articles = part.select((F.col("p_partkey") + ARTICLE_OFFSET).alias("page_id"), title.alias("page_title"), F.regexp_extract("p_brand", r"(\d+)$", 1).cast("bigint").alias("parent_id"))
    if abstracts:
        texts = table(spark, sf_dir, "documents").select((F.col("doc_id") + ARTICLE_OFFSET).alias("page_id"), F.col("text").alias("page_abstract"))
        articles = articles.join(texts, "page_id", "left")
    else:
        articles = articles.withColumn("page_abstract", F.lit(None).cast("string"))
    none = F.lit(None).cast("string")
    top = topics(spark, sf_dir).select("page_id", "page_title", none.alias("page_abstract"), F.lit(0).cast("bigint").alias("parent_id"))
    root = spark.range(1).select(F.lit(0).cast("bigint").alias("page_id"), none.alias("page_title"), none.alias("page_abstract"), F.lit(0).cast("bigint").alias("parent_id"))
    return articles.unionByName(top).unionByName(root).withColumn("page_type", page_type())


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisions before serials and differences: what only counting needs, without a sort."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem").join(orders.hint("merge"), "l_orderkey")
    return lines.select(
        (F.col("l_partkey") + ARTICLE_OFFSET).alias("page_id"),
        F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("user_id"),
        (F.col("o_custkey") % 17 == 0).alias("user_isbot"),
        F.floor("l_extendedprice").cast("double").alias("rev_charweight"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1).otherwise(0).alias("rev_isrevert"),
        F.lit(False).alias("rev_isreverted"),
        F.col("l_shipdate").alias("rev_timestamp"),
        F.year("l_shipdate").alias("rev_year"),
        F.col("l_orderkey").alias("_order"),
        F.col("l_linenumber").alias("_line"),
    )


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All revision columns, with serial numbers and differences within each page.

    Dealt by page in as many parts as shuffles have: a given number is never coalesced, so tasks stay small.
    """
    order = ("rev_timestamp", "_order", "_line")
    dealt = edits(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "page_id")
    return dealt.withColumns({"rev_serialid": serial_id(*order), "rev_chardiff": char_diff(*order)}).drop("_order", "_line")
