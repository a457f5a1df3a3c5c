"""CSV and Parquet interchange, document sinks, and configuration."""

from __future__ import annotations

import gzip
import io
import tarfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema

_TIMES = ("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")


def read_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """CSV with a header, standard quoting and line feeds inside quotes.

    An unquoted empty field reads as null and a quoted one as an empty string: null is a text
    drawn anew for each reading, which no field is.
    """
    return spark.read.schema(columns).option(*_TIMES).csv(path, header=True, multiLine=True, quote='"', escape='"', nullValue=uuid.uuid4().hex)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option(*_TIMES).csv(path, header=True, mode="overwrite", quote='"', escape='"', emptyValue='""', nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def pages_out(pages: DataFrame) -> DataFrame:
    """The interchange form of pages: topics and articles, without the global row."""
    return pages.where(F.col("page_id") != schema.GLOBAL_ID).select(F.col("page_id").alias("id"), F.col("page_title").alias("title"), F.col("page_abstract").alias("abstract"), F.col("parent_id").alias("topicid"))


def revisions_out(revisions: DataFrame) -> DataFrame:
    return revisions.select(F.col("page_id").alias("pageid"), F.col("rev_serialid").alias("ID"), F.col("user_id").alias("userid"), F.col("user_isbot").alias("isbot"), F.col("rev_charweight").alias("weight"), F.col("rev_chardiff").alias("diff"), F.col("rev_isrevert").alias("isrevert"), F.lit(False).alias("isreverted"), F.col("rev_timestamp").alias("timestamp"))


def jumps_out(jumps: DataFrame) -> DataFrame:
    """(id, socialjumps) with the array as {a, b}."""
    from ..functions.text import array_text

    return jumps.select(F.col("page_id").alias("id"), array_text("page_socialjumps").alias("socialjumps"))


def pages_in(df: DataFrame) -> DataFrame:
    """Interchange pages plus the global row, with types derived from parents."""
    from ..operators.tree import page_type

    named = df.select(F.col("id").alias("page_id"), F.col("title").alias("page_title"), F.col("abstract").alias("page_abstract"), F.col("topicid").alias("parent_id"))
    root = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("page_id"), F.lit(None).cast("string").alias("page_title"), F.lit(None).cast("string").alias("page_abstract"), F.lit(0).cast("bigint").alias("parent_id"))
    return named.unionByName(root).withColumn("page_type", page_type())


def revisions_in(df: DataFrame) -> DataFrame:
    return df.select(F.col("pageid").alias("page_id"), F.col("ID").alias("rev_serialid"), F.col("userid").alias("user_id"), F.col("isbot").alias("user_isbot"), F.col("weight").alias("rev_charweight"), F.col("diff").alias("rev_chardiff"), F.col("isrevert").alias("rev_isrevert"), F.col("isreverted").alias("rev_isreverted"), F.col("timestamp").alias("rev_timestamp")).withColumn("rev_year", F.year("rev_timestamp"))


def jumps_in(df: DataFrame) -> DataFrame:
    inside = F.concat(F.lit("["), F.translate("socialjumps", "{}", ""), F.lit("]"))
    return df.select(F.col("id").alias("page_id"), F.from_json(inside, "array<bigint>").alias("page_socialjumps"))


def sampled(df: DataFrame, key: str, percent: int) -> DataFrame:
    """Test mode: the same share of keys each time, by hash."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(100)) < percent)


#: Looks at pages and revisions while they are read, and may put others in their place.
Process = Callable[[DataFrame, DataFrame], "tuple[DataFrame, DataFrame] | None"]


def taken_in(pages: DataFrame, revisions: DataFrame, processes: Iterable[Process] = (), test_percent: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages and revisions after the test mode (a share of the articles, with their revisions) and each process, in turn."""
    if test_percent is not None:
        article = F.col("page_type") == schema.ARTICLE
        pages = sampled(pages.where(article), "page_id", test_percent).unionByName(pages.where(~article))
        revisions = revisions.join(pages.select("page_id"), "page_id", "left_semi")
    for process in processes:
        pages, revisions = process(pages, revisions) or (pages, revisions)
    return pages, revisions


def write_documents(documents: DataFrame, path: str) -> None:
    """(path, data) rows as gzipped JSON lines, one file a task: a sink for any store."""
    documents.write.mode("overwrite").option("compression", "gzip").json(path)


def write_tree(documents: DataFrame, folder: str) -> None:
    """A gzip file <folder>/<path>.gz for each (path, data); the folder must be one that all executors mount.

    Each file is written beside its place and then moved there, so a task that is run again
    leaves no half of one.
    """

    def write(rows: Iterator) -> None:
        import os

        for row in rows:
            target = os.path.join(folder, f"{row.path}.gz")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            aside = f"{target}.{uuid.uuid4().hex}"
            with open(aside, "wb") as f:
                f.write(gzip.compress(row.data.encode(), compresslevel=9, mtime=0))
            os.replace(aside, target)

    documents.select("path", "data").foreachPartition(write)


def write_tar(documents: Iterable, target: str, prefix: str = "html") -> int:
    """A tar.gz of gzip members from rows (path, data), taken one at a time (use toLocalIterator()); returns how many."""
    n = 0
    with tarfile.open(target, "w:gz", compresslevel=9) as tar:
        for row in documents:
            body = gzip.compress(row.data.encode(), compresslevel=9, mtime=0)
            info = tarfile.TarInfo(f"{prefix}/{row.path}.gz")
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))
            n += 1
    return n


@dataclass(frozen=True)
class Options:
    """What a run is told: edition, source, address, whether to keep tables, enrichment, test mode.

    source: net reads and preprocesses, savepoint goes on from the CSV files of an earlier run.
    """

    lang: str = "en"
    source: str = "net"
    base_url: str = "http://%s.example.org"
    keep: bool = False
    enrichment: bool = False
    test: bool = False

    def __post_init__(self):
        if self.source not in ("net", "savepoint"):
            raise ValueError(f"unknown source {self.source!r}")
        if self.base_url.count("%s") > 1:
            raise ValueError("at most one %s in the base address")

    def url(self) -> str:
        return self.base_url.replace("%s", self.lang)
