"""Explicit schemas of the interchange tables, and the integrity rules that are part of their meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE, TOPIC, GLOBAL = "article", "topic", "global"
PAGE_TYPES = (ARTICLE, TOPIC, GLOBAL)
INDEX_TYPES = ("conflict", "polemic")
GLOBAL_ID = 0
#: The year that stands for all time.
ALL_TIME = 0
MAX_TITLE = 512

PAGES_CSV = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("topicid", T.LongType()),
])
REVISIONS_CSV = T.StructType([
    T.StructField("pageid", T.LongType()),
    T.StructField("ID", T.IntegerType()),
    T.StructField("userid", T.LongType()),
    T.StructField("isbot", T.BooleanType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("diff", T.DoubleType()),
    T.StructField("isrevert", T.IntegerType()),
    T.StructField("isreverted", T.BooleanType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])
JUMPS_CSV = T.StructType([T.StructField("id", T.LongType()), T.StructField("socialjumps", T.StringType())])

PAGE_FIELDS = ("page_id", "page_title", "page_abstract", "parent_id", "page_type", "page_creationyear")


def violations(pages: DataFrame, revisions: DataFrame) -> DataFrame:
    """(rule, n): how many keys or rows break each rule.

    k1 page ids are unique; k2 parents exist; k3 (page, serial) is unique; k4 revisions
    have a page; k5 revisions have a year; k6 articles have a revision (hence a creation
    year); k7 the topics are the pages but the global one whose parent is 0; title_length
    titles fit; page_type types are known.

    Page ids are as many as pages: they are merged, never broadcast.  A repeated (page, serial) is
    told by its second row, in a sort that can spill; revisions dealt by page stay where they are.
    """
    ids = pages.select("page_id")
    years = F.year("rev_timestamp")
    articles = pages.where(F.col("page_type") == ARTICLE).select("page_id")
    again = F.row_number().over(Window.partitionBy("page_id", "rev_serialid").orderBy("rev_serialid"))
    is_topic = (F.col("parent_id") == GLOBAL_ID) & (F.col("page_id") != GLOBAL_ID)
    checks = {
        "k1": pages.groupBy("page_id").count().where("count > 1"),
        "k2": pages.join(ids.select(F.col("page_id").alias("parent_id")).distinct().hint("merge"), "parent_id", "left_anti"),
        "k3": revisions.select("page_id", "rev_serialid").withColumn("_again", again).where("_again = 2"),
        "k4": revisions.join(ids.hint("merge"), "page_id", "left_anti"),
        "k5": revisions.where(years.isNull()),
        "k6": articles.join(revisions.select("page_id").hint("merge"), "page_id", "left_anti"),
        "k7": pages.where((F.col("page_type") == TOPIC) != is_topic),
        "title_length": pages.where(F.length("page_title") > MAX_TITLE),
        "page_type": pages.where(~F.col("page_type").isin(*PAGE_TYPES)),
    }
    out = None
    for rule, bad in checks.items():
        one = bad.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n")
        out = one if out is None else out.unionByName(one)
    return out
