"""The whole run: from pages and revisions to an archive of documents.

1. Pages and revisions are read (star-schema tables or Parquet), thinned out in test mode,
   shown to the processes, and written as interchange CSV together with the social jumps.
2. The CSV files are read again and analysed.
3. Documents are rendered, with the word statistics that were computed or saved before,
   and put into a tar of gzip files, in order.
4. Unless they are to be kept, the CSV files and all derived tables are deleted.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import graph
from .plans.warehouse import Warehouse
from .sources import files, schema, tables
from .sources.store import STORE, _fs

#: The share of articles that a test run takes, in percent.
TEST_PERCENT = 10


def _deleted(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def preprocessed(pages: DataFrame, revisions: DataFrame, folder: str, options: files.Options, processes: Iterable[files.Process] = ()) -> None:
    """Write the savepoint: pages, revisions and social jumps as CSV."""
    pages, revisions = files.taken_in(pages, revisions, processes, TEST_PERCENT if options.test else None)
    files.write_csv(files.pages_out(pages), f"{folder}/pages")
    files.write_csv(files.revisions_out(revisions), f"{folder}/revisions")
    jumps = graph.jumps(graph.similarities(graph.contributions(revisions), best=graph.NEIGHBOURS))
    files.write_csv(files.jumps_out(graph.social_jumps(pages.where(F.col("page_id") != schema.GLOBAL_ID), jumps)), f"{folder}/socialjumps")


def savepoint(spark: SparkSession, folder: str) -> Warehouse:
    """The analysis over a savepoint."""
    pages = files.pages_in(files.read_csv(spark, f"{folder}/pages", schema.PAGES_CSV))
    revisions = files.revisions_in(files.read_csv(spark, f"{folder}/revisions", schema.REVISIONS_CSV))
    out = Warehouse(pages, revisions, source=folder)
    listed = files.jumps_in(files.read_csv(spark, f"{folder}/socialjumps", schema.JUMPS_CSV))
    out.social_jumps = pages.select("page_id").join(listed, "page_id", "left").withColumn("page_socialjumps", F.coalesce("page_socialjumps", F.array().cast("array<bigint>")))
    return out


def run(spark: SparkSession, source: DataFrame | None, revisions: DataFrame | None, folder: str, target: str, options: files.Options, processes: Iterable[files.Process] = ()) -> int:
    """Everything; source and revisions may be None where the savepoint in the folder is used.  Returns how many documents the tar holds."""
    if options.source == "net":
        preprocessed(source, revisions, folder, options, processes)
    warehouse = savepoint(spark, folder)
    words = f"{folder}/words"
    if options.enrichment:
        computed = warehouse.enrichment()
        computed.select(F.col("page_id").alias("id"), "fields").write.mode("overwrite").parquet(words)
    none = warehouse.raw_pages.select("page_id", F.create_map().cast("map<string,string>").alias("fields"))
    fields = warehouse.enrichment(saved=words) if _exists(spark, words) else none  # statistics are optional
    documents = warehouse.documents(options.lang, options.url(), fields, ordered=True)
    n = files.write_tar(documents.toLocalIterator(), target)
    if not options.keep:
        STORE.forget(spark, folder)
        _deleted(spark, folder)
    return n


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    default = files.Options()
    parser = argparse.ArgumentParser(prog="quarrelscope", description="From an edit history to an archive of documents.")
    parser.add_argument("--lang", default=default.lang, help="language edition")
    parser.add_argument("--source", default=default.source, choices=("net", "savepoint"), help="read and preprocess, or go on from a savepoint")
    parser.add_argument("--url", default=default.base_url, help="base address; %%s stands for the edition")
    parser.add_argument("--keep", action="store_true", help="keep the savepoint and derived tables")
    parser.add_argument("--words", action="store_true", help="compute word statistics; else those of the savepoint are used, if any")
    parser.add_argument("--test", action="store_true", help=f"take {TEST_PERCENT} percent of the articles")
    parser.add_argument("--tables", help="folder of star-schema tables to read")
    parser.add_argument("--warehouse", help="folder that Warehouse.save() wrote, to read instead")
    parser.add_argument("--folder", default="savepoint", help="where the savepoint is")
    parser.add_argument("--out", default="documents.tar.gz", help="the archive")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    told = arguments(argv)
    options = files.Options(told.lang, told.source, told.url, told.keep, told.words, told.test)
    spark = spark or SparkSession.builder.appName("quarrelscope").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    pages = revisions = None
    if options.source == "net":
        if told.warehouse:
            opened = Warehouse.opened(spark, told.warehouse)
            pages, revisions = opened.raw_pages, opened.revisions
        elif told.tables:
            pages, revisions = tables.pages(spark, told.tables), tables.revisions(spark, told.tables)
        else:
            raise SystemExit("name the tables or the warehouse to read")
    n = run(spark, pages, revisions, told.folder, told.out, options)
    print(f"{n} documents in {told.out}")
    return n
