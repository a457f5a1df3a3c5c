"""The whole analysis as lazily linked frames over pages and revisions.

Aggregates that several results share (far smaller than the revisions) are written
once and reused, like the tables of a warehouse; see :mod:`quarrelscope.sources.store`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import documents, graph, indices, polemic, ranks, social, topten, tree
from ..sources import tables
from ..sources.store import STORE


class Warehouse:
    def __init__(self, pages: DataFrame, revisions: DataFrame, edits: DataFrame | None = None, source: str | None = None):
        """pages: without creation years; revisions: with serials and differences; edits: revisions where counting needs neither.

        source: what the frames are derived from; named, shared tables are written and reused under it.
        """
        self.raw_pages, self.revisions = pages, revisions
        self.edits = edits if edits is not None else revisions
        self.source = source
        self.abstracts = True

    @classmethod
    def of_tables(cls, spark: SparkSession, sf_dir: str, abstracts: bool = False, materialise: bool = True) -> Warehouse:
        """Of the star-schema tables of a folder; without abstracts, pages have null ones."""
        out = cls(tables.pages(spark, sf_dir, abstracts), tables.revisions(spark, sf_dir), tables.edits(spark, sf_dir), sf_dir if materialise else None)
        out.abstracts = abstracts
        return out

    def save(self, path: str) -> None:
        """Pages and revisions as Parquet, revisions by year."""
        self.raw_pages.write.mode("overwrite").parquet(f"{path}/pages")
        self.revisions.write.mode("overwrite").partitionBy("rev_year").parquet(f"{path}/revisions")

    def save_tables(self, database: str, location: str, buckets: int = 16) -> None:
        """Pages and revisions as tables of a database at the location, bucketed and sorted by page, with statistics.

        Joins and aggregates by page then need no shuffle of the revisions.
        """
        spark = self.raw_pages.sparkSession
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
        self.raw_pages.write.mode("overwrite").bucketBy(buckets, "page_id").sortBy("page_id").saveAsTable(f"{database}.pages")
        self.revisions.write.mode("overwrite").bucketBy(buckets, "page_id").sortBy("page_id", "rev_serialid").saveAsTable(f"{database}.revisions")
        for table in ("pages", "revisions"):
            spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS FOR COLUMNS page_id")

    @classmethod
    def of_database(cls, spark: SparkSession, database: str) -> Warehouse:
        """What save_tables() wrote."""
        return cls(spark.table(f"{database}.pages"), spark.table(f"{database}.revisions"))

    @staticmethod
    def drop_tables(spark: SparkSession, database: str) -> None:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    @classmethod
    def opened(cls, spark: SparkSession, path: str) -> Warehouse:
        """What save() wrote; its shared tables are kept under the path."""
        return cls(spark.read.parquet(f"{path}/pages"), spark.read.parquet(f"{path}/revisions"), source=path)

    def shared(self, name: str, make) -> DataFrame:
        """An aggregate that several results need: written once for a named source, else just made."""
        if self.source is None:
            return make()
        return STORE.table(self.raw_pages.sparkSession, self.source, name, make)

    @cached_property
    def timebounds(self) -> DataFrame:
        return self.shared("timebounds", lambda: tree.timebounds(self.edits))

    @cached_property
    def spans(self) -> DataFrame:
        return self.shared("spans", lambda: tree.page_spans(self.edits))

    @cached_property
    def pages(self) -> DataFrame:
        return tree.with_creation_year(self.raw_pages, self.spans, self.timebounds)

    @cached_property
    def lives(self) -> DataFrame:
        """(page_id, parent_id, page_type, page_creationyear): what counting needs of the pages, without their texts."""
        return self.shared("lives", lambda: self.pages.select("page_id", "parent_id", "page_type", "page_creationyear"))

    @cached_property
    def pagetree(self) -> DataFrame:
        return self.shared("pagetree", lambda: tree.pagetree(self.raw_pages))

    @cached_property
    def article_editors(self) -> DataFrame:
        return social.editors(self.edits)

    @cached_property
    def counts(self) -> DataFrame:
        return self.shared("counts", lambda: social.counts(social.rolled_up(self.article_editors, self.pagetree)))

    @cached_property
    def live_articles(self) -> DataFrame:
        return social.live_articles(self.lives, self.timebounds)

    @cached_property
    def paired(self) -> DataFrame:
        return polemic.paired(self.counts, self.lives)

    @cached_property
    def histogram(self) -> DataFrame:
        return self.shared("histogram", lambda: polemic.histogram(self.paired))

    @cached_property
    def dominance(self) -> DataFrame:
        return polemic.dominance(self.histogram)

    @cached_property
    def untimed(self) -> DataFrame:
        return polemic.untimed(self.paired, polemic.dominating(self.histogram), self.live_articles)

    @cached_property
    def time_weights(self) -> DataFrame:
        return polemic.time_weights(self.spans)

    @cached_property
    def articles_polemic(self) -> DataFrame:
        return self.shared("articles_polemic", lambda: polemic.articles_polemic(self.untimed, self.time_weights))

    @cached_property
    def above_polemic(self) -> DataFrame:
        return polemic.rolled_up(self.articles_polemic, self.pagetree)

    @cached_property
    def indices(self) -> DataFrame:
        """Both indices where they aren't zero; written, as the cube reads them twice and the driver holds each copy of a plan."""
        return self.shared("indices", lambda: indices.conflict_index(self.counts).unionByName(indices.polemic_index(self.articles_polemic, self.above_polemic)))

    @cached_property
    def cube(self) -> DataFrame:
        """The cube with weights of nine digits, so that no sum's order can part equal weights."""
        return self.shared("cube", lambda: indices.zero_filled(self.indices, self.lives, self.timebounds).withColumn("weight", F.round("weight", 9)))

    @cached_property
    def conflict_cube(self) -> DataFrame:
        return indices.zero_filled(indices.conflict_index(self.counts), self.lives, self.timebounds)

    @cached_property
    def standings(self) -> DataFrame:
        return self.shared("standings", lambda: ranks.standings(self.cube))

    @cached_property
    def topic_standings(self) -> DataFrame:
        return self.shared("topic_standings", lambda: ranks.standings(self.cube, ranks.TOPIC_KEYS, "topic_"))

    @cached_property
    def ranked(self) -> DataFrame:
        """Standings are written first: the cube meets each of them twice, and the driver holds each copy of a plan."""
        return self.shared("ranked", lambda: ranks.ranked(self.cube, self.standings, self.topic_standings))

    @cached_property
    def topic_names(self) -> DataFrame:
        topics = self.raw_pages.where(F.col("page_type") == "topic")
        return topics.select(F.col("page_id").alias("topic_id"), X.topic_short_name("page_title").alias("topic"))

    @cached_property
    def rankings(self) -> DataFrame:
        return ranks.rankings(self.ranked, self.topic_names)

    @cached_property
    def topic_toptens(self) -> DataFrame:
        return self.shared("topic_toptens", lambda: topten.by_topic(self.cube))

    @cached_property
    def topten_lists(self) -> DataFrame:
        return self.shared("topten_lists", lambda: topten.lists(self.topic_toptens))

    @cached_property
    def contributions(self) -> DataFrame:
        return graph.contributions(self.revisions)

    @cached_property
    def jumps(self) -> DataFrame:
        return self.shared("jumps", lambda: graph.jumps(graph.similarities(self.contributions, best=graph.NEIGHBOURS)))

    @cached_property
    def social_jumps(self) -> DataFrame:
        return graph.social_jumps(self.raw_pages, self.jumps)

    @cached_property
    def page_infos(self) -> DataFrame:
        return documents.page_infos(self.pages, ranks.nested(self.ranked), documents.neighbours(self.pages, self.social_jumps))

    def enrichment(self, saved: str | None = None, bad_words: tuple[str, ...] = documents.BAD_WORDS, external: tuple[DataFrame, ...] = ()) -> DataFrame:
        """Word statistics by page, of the whole, topics and articles, with those of external sources, which win.

        saved: a table (id, fields) of statistics that were computed before, instead of the abstracts.
        """
        if saved:
            sources = [self.raw_pages.sparkSession.read.parquet(saved)]
        else:
            texts = self.raw_pages.where(F.col("page_abstract").isNotNull()).select(F.col("page_id").alias("id"), F.col("page_abstract").alias("text"))
            counts = self.shared("word_counts", lambda: documents.word_counts(texts)) if self.abstracts else documents.word_counts(texts)
            sources = documents.word_sources(counts, self.raw_pages, bad_words)
        return documents.enriched(self.raw_pages, [*sources, *external])

    def page_documents(self, lang: str = "en", home: str = "", fields: DataFrame | None = None, ordered: bool = False) -> DataFrame:
        """(path, data) of every page.  fields: (page_id, fields), instead of the word statistics."""
        return documents.page_documents(self.page_infos, self.rankings, self.enrichment() if fields is None else fields, self.topic_names, self.timebounds, lang, home, ordered)

    def topten_documents(self, lang: str = "en", ordered: bool = False) -> DataFrame:
        """(path, data) of every top-ten list."""
        return documents.topten_documents(self.topten_lists, self.pages, self.topic_names, lang, ordered)

    def documents(self, lang: str = "en", home: str = "", fields: DataFrame | None = None, ordered: bool = False) -> DataFrame:
        """(path, data) of every page and every top-ten list; pages by id and then lists by year, if ordered."""
        return self.page_documents(lang, home, fields, ordered).unionByName(self.topten_documents(lang, ordered))
