"""All queries of the conflict analytics by name, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import documents, edits, graph, indices, ranks, social, topten, tree
from ..sources import files, schema, tables
from ..sources.store import shared_folder
from . import oracle
from .warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *, abstracts: bool = False, name: str | None = None):
    """Register fn(warehouse) under its name; sql: what selects the same rows from the CTEs of oracle."""

    def register(fn):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: fn(Warehouse.of_tables(spark, sf_dir, abstracts))
        if sql:
            ORACLE_SQL[key] = oracle.select(sql)
        return fn

    return register


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten most conflicted articles by topic and year."""
    return topten.by_topic(Warehouse.of_tables(spark, sf_dir).conflict_cube)


# sources, projections and filters


@query("SELECT page_id, rev_serialid, rev_year FROM revisions")
def f1_rev_year(w):
    return w.revisions.select("page_id", "rev_serialid", "rev_year")


@query("SELECT page_id, parent_id, page_type FROM pages")
def f2_page_types(w):
    return w.raw_pages.select("page_id", "parent_id", "page_type")


@query("SELECT page_id, rev_serialid, user_id FROM revisions WHERE user_id IS NOT NULL")
def f3_registered(w):
    return edits.registered(w.revisions).select("page_id", "rev_serialid", "user_id")


@query("SELECT page_id, rev_serialid FROM revisions WHERE rev_isrevert > 0")
def f4_reverts(w):
    return edits.reverts(w.revisions).select("page_id", "rev_serialid")


@query("SELECT page_id, page_title FROM pages WHERE page_type = 'article'")
def f5_articles(w):
    return w.raw_pages.where("page_type = 'article'").select("page_id", "page_title")


@query("SELECT page_id, rev_serialid, user_id FROM revisions WHERE user_id IS NOT NULL AND NOT user_isbot")
def f8_graph_edits(w):
    return edits.graph_edits(w.revisions).select("page_id", "rev_serialid", "user_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN o_custkey % 10 != 0 THEN o_custkey END AS user_id, FALSE AS rev_isreverted FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def f9_anonymous(w):
    sentinel = F.lit(-1).cast("bigint")
    user = edits.known_user(F.coalesce("user_id", sentinel), sentinel)
    return w.edits.select(F.col("_order").alias("l_orderkey"), F.col("_line").alias("l_linenumber"), (F.col("page_id") - tables.ARTICLE_OFFSET).alias("l_partkey"), user.alias("user_id"), "rev_isreverted")


@query("SELECT topic_id, page_title FROM topics")
def s2_topics(w):
    return w.raw_pages.where("page_type = 'topic'").select(F.col("page_id").alias("topic_id"), "page_title")


@query("SELECT minyear, maxyear FROM timebounds")
def s12_time_lookup(w):
    return w.timebounds.select("minyear", "maxyear")


@query("SELECT page_id, rev_serialid, rev_charweight, rev_chardiff FROM revisions")
def w8_char_diff(w):
    return w.revisions.select("page_id", "rev_serialid", "rev_charweight", "rev_chardiff")


@query("SELECT page_id, rev_serialid, rev_timestamp FROM revisions")
def w9_serial(w):
    return w.revisions.select("page_id", F.col("rev_serialid").cast("bigint").alias("rev_serialid"), "rev_timestamp")


# tree and time


@query("SELECT minyear, maxyear, mintimestamp, maxtimestamp FROM timebounds")
def a1_timebounds(w):
    return w.timebounds


@query("SELECT page_id, page_creationyear FROM created")
def a2_creation_year(w):
    return w.pages.select("page_id", "page_creationyear")


@query("SELECT page_id, parent_id FROM pagetree")
def j1_pagetree(w):
    return w.pagetree


@query("SELECT parent_id, count(*) AS n_pages FROM pagetree GROUP BY parent_id")
def u1_tree_union(w):
    return w.pagetree.groupBy("parent_id").agg(F.count("*").alias("n_pages"))


@query("SELECT year FROM years")
def u3_year_series(w):
    return tree.year_axis(w.timebounds)


@query("SELECT page_id, minyear, maxyear, mintimestamp, maxtimestamp FROM spans")
def a9_page_spans(w):
    return w.spans


@query("SELECT page_id, epoch(maxtimestamp)::BIGINT AS last_second FROM spans")
def x21_unix_seconds(w):
    return w.spans.select("page_id", X.unix_seconds("maxtimestamp").alias("last_second"))


@query("SELECT page_id, round(epoch_us(maxtimestamp - mintimestamp) / 86400e6, 6) AS days FROM (SELECT page_id, maxtimestamp, mintimestamp FROM spans)".replace("epoch_us(maxtimestamp - mintimestamp)", "(epoch_us(maxtimestamp) - epoch_us(mintimestamp))"))
def x3_active_days(w):
    return _rounded(w.time_weights.where("year = 0").select("page_id", F.col("weight").alias("days")), "days")


# editors


@query("SELECT page_id, year, popularity FROM counts WHERE page_type = 'article' AND year != 0")
def a3_popularity(w):
    return social.counts(w.article_editors).select("page_id", "year", "popularity")


@query("SELECT page_id, year, conflict FROM counts WHERE page_type = 'article' AND year != 0 AND conflict > 0")
def a3_conflict(w):
    return social.counts(w.article_editors).where("conflict > 0").select("page_id", "year", "conflict")


@query("SELECT page_id, year, popularity, conflict FROM counts WHERE page_type != 'article'")
def c3_ancestor_users(w):
    return w.counts.join(w.raw_pages.where("page_type != 'article'").select("page_id"), "page_id", "left_semi")


@query("SELECT page_id, popularity, conflict FROM counts WHERE year = 0")
def a5_all_time(w):
    return w.counts.where("year = 0").drop("year")


@query("SELECT page_id, year, popularity, conflict FROM counts")
def a6_counts(w):
    return w.counts


@query("SELECT year, totalpagecount FROM live")
def a7_live_articles(w):
    return w.live_articles


@query("SELECT page_id, year, popularity, conflict FROM paired")
def j4_paired(w):
    return w.paired


@query("SELECT year, popularity, conflict, count FROM cells")
def a8_histogram(w):
    return w.histogram


@query("SELECT year, popularity, conflict, coalesce(count, 0)::BIGINT AS count FROM (SELECT DISTINCT year, popularity FROM cells) JOIN (SELECT DISTINCT year, conflict FROM cells) USING (year) LEFT JOIN cells USING (year, popularity, conflict)")
def j6_dense_grid(w):
    from ..operators import polemic

    return polemic.grid(w.histogram)


@query("SELECT year, popularity, conflict, count FROM dominance")
def c4_dominance(w):
    return w.dominance


# polemic and cube


@query("SELECT page_id, year, round(weight, 6) AS weight FROM untimed")
def c5_untimed_polemic(w):
    return _rounded(w.untimed, "weight")


@query("SELECT page_id, year, round(weight, 6) AS weight FROM timeweights")
def c6_time_weight(w):
    return _rounded(w.time_weights, "weight")


@query("SELECT page_id, year, round(weight, 6) AS weight FROM polemic")
def c7_polemic(w):
    return _rounded(w.articles_polemic, "weight")


@query("SELECT page_id, year, round(weight, 6) AS weight FROM polemic_above")
def a10_polemic_rollup(w):
    return _rounded(w.above_polemic, "weight")


@query("SELECT DISTINCT type, page_type FROM indices JOIN pages USING (page_id)")
def a11_types(w):
    return indices.present_types(w.indices, w.raw_pages)


@query("SELECT DISTINCT type FROM cube WHERE page_type = 'article'")
def a18_article_types(w):
    return w.cube.where("page_type = 'article'").select("type").distinct()


@query("SELECT type, page_id, topic_id, page_type, year, round(weight, 6) AS weight FROM cube")
def c8_indices_by_year(w):
    return _rounded(w.cube, "weight")


@query("SELECT type, page_type, year, count(*) AS n_pages, count(*) FILTER (weight = 0) AS n_zero FROM cube GROUP BY ALL")
def j14_zero_fill(w):
    return w.cube.groupBy("type", "page_type", "year").agg(F.count("*").alias("n_pages"), F.count_if(F.col("weight") == 0).alias("n_zero"))


# ranks


@query("SELECT type, page_id, year, round(percentile, 9) AS percentile FROM ranked")
def w3_percent_rank(w):
    return _rounded(w.ranked, "percentile", digits=9).select("type", "page_id", "year", "percentile")


@query("SELECT type, page_id, year, round(dense_percentile, 9) AS dense_percentile FROM ranked")
def w4_dense_percentile(w):
    return _rounded(w.ranked, "dense_percentile", digits=9).select("type", "page_id", "year", "dense_percentile")


@query("SELECT type, page_id, year, rank FROM ranked")
def w5_rank(w):
    return w.ranked.select("type", "page_id", "year", "rank")


@query("SELECT type, page_id, year, round(topic_percentile, 9) AS topic_percentile, round(topic_dense_percentile, 9) AS topic_dense_percentile, topic_rank FROM ranked")
def w6_topic_ranks(w):
    return _rounded(w.ranked, "topic_percentile", "topic_dense_percentile", digits=9).select("type", "page_id", "year", "topic_percentile", "topic_dense_percentile", "topic_rank")


@query("SELECT page_id, type, year, round(weight, 6) AS weight, rank, topic_rank FROM ranked")
def a13_nested_measurements(w):
    flat = ranks.nested(w.ranked).select("page_id", F.explode("stats").alias("s")).select("page_id", "s.type", F.explode("s.measurements").alias("m"))
    return _rounded(flat.select("page_id", "type", "m.year", "m.weight", "m.rank", "m.topic_rank"), "weight")


@query(
    """SELECT page_id, type AS index, among, CASE WHEN year = 0 THEN 'all' ELSE year::VARCHAR END AS span, r AS rank, floor(p * 100 + 0.5)::INTEGER AS percentile, floor(d * 100 + 0.5)::INTEGER AS dense_percentile, round(weight, 6) AS value
    FROM (SELECT page_id, type, year, weight, 'all' AS among, rank AS r, percentile AS p, dense_percentile AS d FROM ranked
    UNION ALL SELECT page_id, type, year, weight, topic, topic_rank, topic_percentile, topic_dense_percentile FROM ranked JOIN topics USING (topic_id) WHERE page_type = 'article')"""
)
def c12_rankings(w):
    return _rounded(w.rankings, "value")


@query("SELECT type, page_id, year, floor(percentile * 100 + 0.5)::INTEGER AS percent FROM ranked")
def x13_percentage(w):
    return w.ranked.select("type", "page_id", "year", X.percentage("percentile").alias("percent"))


# top tens


@query("SELECT year, type, topic_id, position, page_id, round(weight, 6) AS weight FROM toptens")
def t3_topten_topic(w):
    return _rounded(w.topic_toptens, "weight")


@query("SELECT year, type, topic_id, position, page_id, weight FROM toptens WHERE type = 'conflict'")
def w10_topten_conflict(w):
    return topten.by_topic(w.conflict_cube)


@query("SELECT year, type, topic_id, position, page_id, round(weight, 6) AS weight FROM toptens_all")
def t6_topten_all(w):
    return _rounded(topten.overall(w.topic_toptens), "weight")


@query("SELECT year, type, topic_id, len(pages)::INTEGER AS n_pages, array_to_string(pages, ' ') AS pages FROM topten_lists")
def u5_topten_dense(w):
    return w.topten_lists.select("year", "type", "topic_id", F.size("pages").alias("n_pages"), F.array_join(F.transform("pages", lambda x: x.cast("string")), " ").alias("pages"))


@query("SELECT year, type, topic_id, row_number() OVER (ORDER BY CASE WHEN year = 0 THEN 999999 ELSE year END, type, topic_id) AS place FROM topten_lists")
def t5_topten_order(w):
    from pyspark.sql import Window

    keys = w.topten_lists.select("year", "type", "topic_id")  # a row for each document, not for each page
    return keys.withColumn("place", F.row_number().over(Window.orderBy(F.when(F.col("year") == 0, 999999).otherwise(F.col("year")), "type", "topic_id")).cast("bigint"))


@query("SELECT year, type, count(DISTINCT topic_id) AS n_topics, count(*) AS n_places, round(sum(weight), 6) AS total FROM toptens GROUP BY year, type")
def a17_annual_indexes(w):
    return w.topic_toptens.groupBy("year", "type").agg(F.count_distinct("topic_id").alias("n_topics"), F.count("*").alias("n_places"), F.round(F.sum("weight"), 6).alias("total"))


# graph


@query("SELECT page_id, user_id, weight FROM contributions")
def c13_contribution(w):
    return w.contributions


@query("SELECT page_id, count(*) AS n_users FROM contributions GROUP BY page_id")
def a20_degrees(w):
    return graph.degrees(w.contributions)


@query("SELECT a, b, round(similarity, 6) AS similarity FROM similarities")
def j23_similarities(w):
    return _rounded(graph.similarities(w.contributions), "similarity")


@query("SELECT page_id, position, neighbour, round(similarity, 6) AS similarity FROM jumps")
def c14_social_jumps(w):
    return _rounded(w.jumps, "similarity").select("page_id", "position", "neighbour", "similarity")


@query("SELECT page_id, '{' || array_to_string(list(neighbour ORDER BY position), ', ') || '}' AS socialjumps FROM jumps GROUP BY page_id UNION ALL SELECT page_id, '{}' FROM pages WHERE page_id NOT IN (SELECT page_id FROM jumps)")
def s6_jump_text(w):
    return w.social_jumps.select("page_id", X.array_text("page_socialjumps").alias("socialjumps"))


@query("SELECT page_id, position - 1 AS position, neighbour FROM jumps")
def u4_posexplode(w):
    return w.social_jumps.select("page_id", F.posexplode("page_socialjumps").alias("position", "neighbour"))


@query("SELECT j.page_id, position - 1 AS position, p.page_id AS neighbour, p.page_title AS title FROM jumps j JOIN pages p ON p.page_id = neighbour")
def j17_neighbours(w):
    near = documents.neighbours(w.pages, w.social_jumps)
    return near.select("page_id", F.posexplode("socialjumps").alias("position", "p")).select("page_id", "position", F.col("p.page_id").alias("neighbour"), F.col("p.page_title").alias("title"))


# documents


@query(
    """SELECT page_id, page_title, n_types, n_measurements, total, coalesce(links, '') AS links FROM (SELECT page_id, count(DISTINCT type) AS n_types, count(*) AS n_measurements, round(sum(weight * rank), 4) AS total FROM ranked GROUP BY page_id)
    JOIN pages USING (page_id) LEFT JOIN (SELECT page_id, string_agg(neighbour::VARCHAR, ' ' ORDER BY position) AS links FROM jumps GROUP BY page_id) USING (page_id)"""
)
def c10_page_doc(w):
    n = F.aggregate("stats", F.lit(0).cast("bigint"), lambda a, s: a + F.size(s["measurements"]))
    one = lambda s: F.aggregate(s["measurements"], F.lit(0.0), lambda a, m: a + m["weight"] * m["rank"])
    total = F.aggregate("stats", F.lit(0.0), lambda a, s: a + one(s))
    links = F.array_join(F.transform("socialjumps", lambda p: p["page_id"].cast("string")), " ")
    return w.page_infos.select("page_id", "page.page_title", F.size("stats").cast("bigint").alias("n_types"), n.alias("n_measurements"), F.round(total, 4).alias("total"), links.alias("links"))


@query(
    """SELECT p.page_id, p.page_title AS title, p.parent_id, p.page_type AS type, p.page_creationyear AS created, text AS abstract, n_types, first_type, n_links, link_title, link_abstract
    FROM (SELECT c.*, page_title FROM created c JOIN pages USING (page_id)) p LEFT JOIN abstracts a ON a.page_id = p.page_id
    JOIN (SELECT page_id, count(DISTINCT type) AS n_types, min(type) AS first_type FROM ranked GROUP BY page_id) r ON r.page_id = p.page_id
    JOIN (SELECT pages.page_id, count(neighbour) AS n_links FROM pages LEFT JOIN jumps USING (page_id) GROUP BY pages.page_id) l ON l.page_id = p.page_id
    LEFT JOIN (SELECT j.page_id, n.page_title AS link_title, cut AS link_abstract FROM jumps j JOIN pages n ON n.page_id = neighbour LEFT JOIN (SELECT * FROM cuts WHERE nbytes = 256) ON cuts.page_id = neighbour WHERE position = 1) f ON f.page_id = p.page_id""".replace("cuts.page_id", "k.page_id").replace("(SELECT * FROM cuts WHERE nbytes = 256) ON", "(SELECT * FROM cuts WHERE nbytes = 256) k ON"),
    abstracts=True,
)
def x8_page_json(w):
    """Pages as JSON, read again at the boundary."""
    page = "page_id: bigint, page_title: string, page_abstract: string, parent_id: bigint, page_type: string, page_creationyear: int"
    shape = f"page struct<{page}>, stats array<struct<type:string,measurements:array<struct<year:int,weight:double>>>>, socialjumps array<struct<{page}>>"
    j = documents.page_json(w.page_infos).select(F.from_json("json", shape).alias("j")).select("j.*")
    link = F.try_element_at("socialjumps", F.lit(1))
    return j.select(
        "page.page_id", F.col("page.page_title").alias("title"), "page.parent_id", F.col("page.page_type").alias("type"), F.col("page.page_creationyear").alias("created"), F.col("page.page_abstract").alias("abstract"),
        F.size("stats").cast("bigint").alias("n_types"), F.col("stats")[0]["type"].alias("first_type"), F.size("socialjumps").cast("bigint").alias("n_links"), link["page_title"].alias("link_title"), link["page_abstract"].alias("link_abstract"),
    )


@query("SELECT page_id, type, year, year = 0 AS is_all_time, round(weight, 6) AS weight, rank, topic_rank FROM ranked")
def x9_split_stats(w):
    s = documents.split_stats(w.page_infos)
    every = s.select("page_id", "type", F.lit(True).alias("is_all_time"), F.col("all_time").alias("m")).unionByName(s.select("page_id", "type", F.lit(False).alias("is_all_time"), F.explode("by_year").alias("m")))
    return _rounded(every.select("page_id", "type", "m.year", "is_all_time", "m.weight", "m.rank", "m.topic_rank"), "weight")


@query("SELECT page_id, word, n FROM page_words", abstracts=True)
def c15_word_counts(w):
    texts = w.raw_pages.where("page_abstract IS NOT NULL").select(F.col("page_id").alias("id"), F.col("page_abstract").alias("text"))
    return documents.word_counts(texts).withColumnRenamed("id", "page_id")


_LISTED_WORDS = ("of", "und", "les", "con")


def _flat_words(enriched):
    pairs = enriched.select("page_id", F.explode("fields").alias("key", "json"))
    return _rounded(pairs.select("page_id", "key", F.explode(F.from_json("json", "map<string,double>")).alias("word", "value")), "value")


@query("SELECT page_id, key, word, round(value, 6) AS value FROM word_fields", abstracts=True)
def j22_enrich(w):
    return _flat_words(w.enrichment(bad_words=_LISTED_WORDS))


@query("SELECT page_id, key, word, round(value, 6) AS value FROM word_fields", abstracts=True)
def s18_saved_words(w):
    path = f"{shared_folder(w.raw_pages.sparkSession)}/words-{uuid.uuid4().hex}"
    w.enrichment(bad_words=_LISTED_WORDS).select(F.col("page_id").alias("id"), "fields").write.parquet(path)
    return _flat_words(w.enrichment(saved=path))


@query("SELECT id, key, value FROM (SELECT page_id AS id, 'a' AS key, 'second' AS value FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id, 'a', 'first' FROM pages WHERE page_id % 2 = 1 UNION ALL SELECT page_id, 'b', page_id::VARCHAR FROM pages WHERE page_id % 2 = 0)")
def j21_merge(w):
    ids = w.raw_pages.select(F.col("page_id").alias("id"))
    one = ids.select("id", F.create_map(F.lit("a"), F.lit("first")).alias("fields"))
    two = ids.where("id % 2 = 0").select("id", F.create_map(F.lit("a"), F.lit("second"), F.lit("b"), F.col("id").cast("string")).alias("fields"))
    out = documents.enriched(w.raw_pages, [one, two])
    return out.select(F.col("page_id").alias("id"), F.explode("fields").alias("key", "value"))


@query("SELECT page_id, cut AS abstract FROM cuts WHERE nbytes = 256", abstracts=True)
def x11_smart_truncate(w):
    return w.raw_pages.where("page_abstract IS NOT NULL").select("page_id", X.smart_truncate("page_abstract").alias("abstract"))


@query("SELECT page_id, max(cut) FILTER (nbytes = 256) AS in_link, max(cut) FILTER (nbytes = 512) AS in_list, max(text) AS own FROM cuts GROUP BY page_id", abstracts=True)
def x12_limits(w):
    own = F.col("page_abstract")
    return w.raw_pages.where("page_abstract IS NOT NULL").select("page_id", X.smart_truncate(own, X.LINK_LIMIT).alias("in_link"), X.smart_truncate(own, X.TOPTEN_LIMIT).alias("in_list"), own.alias("own"))


@query("SELECT doc_id + 1000 AS page_id, octet_length(encode(text)) AS n_bytes FROM documents JOIN part ON p_partkey = doc_id", abstracts=True)
def x10_byte_length(w):
    return w.raw_pages.where("page_abstract IS NOT NULL").select("page_id", X.byte_length("page_abstract").cast("bigint").alias("n_bytes"))


@query("SELECT page_id, CASE page_type WHEN 'global' THEN 'index.html' WHEN 'topic' THEN 'categories/' || translate(page_title, ' /?#', '_∕？＃') || '.html' ELSE 'articles/' || translate(page_title, ' /?#', '_∕？＃') || '.html' END AS path FROM pages")
def x14_paths(w):
    return w.raw_pages.select("page_id", X.page_path("page_type", "page_title").alias("path"))


@query("SELECT page_id, translate(page_url, ' /?#', '_∕？＃') AS url FROM (SELECT page_id, url AS page_url FROM source_pages)")
def x15_translate(w):
    spark, sf_dir = w.raw_pages.sparkSession, w.source
    return tables.table(spark, sf_dir, "pages").select("page_id", X.url_text("url").alias("url"))


@query("SELECT topic_id, topic FROM topics")
def x16_topic_names(w):
    return w.topic_names


@query("SELECT pages.page_id, coalesce(topic, '') AS topic FROM pages LEFT JOIN topics ON topic_id = CASE page_type WHEN 'article' THEN parent_id ELSE page_id END")
def x17_page_topic(w):
    own = F.when(F.col("page_type") == "article", F.col("parent_id")).otherwise(F.col("page_id"))
    return w.raw_pages.select("page_id", own.alias("topic_id")).join(w.topic_names, "topic_id", "left").select("page_id", F.coalesce("topic", F.lit("")).alias("topic"))


@query("SELECT page_id, replace(page_title, ' ', '_') AS name FROM pages WHERE page_title IS NOT NULL")
def x18_underscored(w):
    return w.raw_pages.where("page_title IS NOT NULL").select("page_id", X.underscored("page_title").alias("name"))


def _named_lists(w):
    topic = F.when(F.col("topic_id") == 0, F.lit("all")).otherwise(F.col("topic"))
    return w.topten_lists.join(w.topic_names, "topic_id", "left").withColumn("topic", topic)


@query("SELECT year, type, topic_id, 'toptens/' || CASE WHEN year = 0 THEN 'all' ELSE year::VARCHAR END || '/' || type || '/' || CASE WHEN topic_id = 0 THEN 'all' ELSE topic END || '.html' AS path FROM topten_lists LEFT JOIN topics USING (topic_id)")
def x19_topten_paths(w):
    return _named_lists(w).select("year", "type", "topic_id", X.topten_path("year", "type", "topic").alias("path"))


@query("SELECT year, type, topic_id, CASE WHEN year = 0 THEN 'All Time' ELSE year::VARCHAR END || ' Top Ten of ' || upper(type[1]) || type[2:] || CASE WHEN topic_id = 0 THEN '' ELSE ' for ' || upper(topic[1]) || topic[2:] END AS title FROM topten_lists LEFT JOIN topics USING (topic_id)")
def x20_topten_titles(w):
    return _named_lists(w).select("year", "type", "topic_id", X.topten_title("year", "type", "topic").alias("title"))


@query("SELECT page_id, rev_serialid, strftime(rev_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS written FROM revisions")
def x22_rfc3339(w):
    return w.revisions.select("page_id", "rev_serialid", X.rfc3339("rev_timestamp").alias("written"))


@query("SELECT page_id, page_title, page_type, rev_serialid, user_id, rev_isrevert, rev_charweight FROM pages JOIN revisions USING (page_id)")
def s7_csv_roundtrip(w):
    """Pages and revisions written as interchange CSV and read again."""
    spark = w.raw_pages.sparkSession
    folder = f"{shared_folder(spark)}/interchange-{uuid.uuid4().hex}"
    files.write_csv(files.pages_out(w.raw_pages), f"{folder}/pages")
    files.write_csv(files.revisions_out(w.revisions), f"{folder}/revisions")
    pages = files.pages_in(files.read_csv(spark, f"{folder}/pages", schema.PAGES_CSV))
    revisions = files.revisions_in(files.read_csv(spark, f"{folder}/revisions", schema.REVISIONS_CSV))
    return pages.join(revisions, "page_id").select("page_id", "page_title", "page_type", "rev_serialid", "user_id", "rev_isrevert", "rev_charweight")


def _seen_in(documents_, kind: str):
    """What a rendered document shows: its title, how many rankings and list entries, and the time span it names."""
    inside = F.regexp_extract("data", r"const rankings = (\[.*\]);", 1)
    n_rankings = F.when(inside == "", 0).otherwise(F.size(F.from_json(inside, "array<array<string>>")))
    return documents_.select(
        "path",
        F.lit(kind).alias("kind"),
        F.regexp_extract("data", r"<h1>(.*?)</h1>", 1).alias("title"),
        F.regexp_extract("data", r'data-topic="([^"]*)"', 1).alias("topic"),
        n_rankings.cast("bigint").alias("n_rankings"),
        F.regexp_count("data", F.lit("<li ")).cast("bigint").alias("n_entries"),
        F.regexp_extract("data", r'"maxyear": (\d+)', 1).alias("last_year"),
    )


_PAGE_DOCUMENTS = """SELECT CASE page_type WHEN 'global' THEN 'index.html' WHEN 'topic' THEN 'categories/' || translate(page_title, ' /?#', '_∕？＃') || '.html' ELSE 'articles/' || translate(page_title, ' /?#', '_∕？＃') || '.html' END AS path,
    'page' AS kind, coalesce(page_title, '') AS title, coalesce(topic, '') AS topic, n_rankings, coalesce(n_entries, 0) AS n_entries, (SELECT maxyear FROM timebounds)::VARCHAR AS last_year
    FROM pages JOIN (SELECT page_id, sum(CASE WHEN page_type = 'article' THEN 2 ELSE 1 END)::BIGINT AS n_rankings FROM ranked GROUP BY page_id) USING (page_id)
    LEFT JOIN (SELECT page_id, count(*) AS n_entries FROM jumps GROUP BY page_id) USING (page_id) LEFT JOIN topics t ON t.topic_id = CASE page_type WHEN 'article' THEN parent_id ELSE page_id END"""
_PAGE_DOCUMENTS = _PAGE_DOCUMENTS.replace("coalesce(page_title, '')", "coalesce(pages.page_title, '')").replace("translate(page_title", "translate(pages.page_title")
_TOPTEN_DOCUMENTS = """SELECT 'toptens/' || CASE WHEN year = 0 THEN 'all' ELSE year::VARCHAR END || '/' || type || '/' || CASE WHEN topic_id = 0 THEN 'all' ELSE topic END || '.html' AS path, 'list' AS kind,
    CASE WHEN year = 0 THEN 'All Time' ELSE year::VARCHAR END || ' Top Ten of ' || upper(type[1]) || type[2:] || CASE WHEN topic_id = 0 THEN '' ELSE ' for ' || upper(topic[1]) || topic[2:] END AS title,
    CASE WHEN topic_id = 0 THEN 'all' ELSE topic END AS topic, 0::BIGINT AS n_rankings, len(pages)::BIGINT AS n_entries, '' AS last_year FROM topten_lists LEFT JOIN topics USING (topic_id)"""


@query(_PAGE_DOCUMENTS, abstracts=True)
def s14_page_documents(w):
    return _seen_in(w.page_documents(), "page")


@query(_TOPTEN_DOCUMENTS, abstracts=True)
def s15_topten_documents(w):
    return _seen_in(w.topten_documents(), "list")


@query(f"SELECT path, count(*) AS n FROM (({_PAGE_DOCUMENTS}) UNION ALL ({_TOPTEN_DOCUMENTS})) GROUP BY path", abstracts=True)
def s16_documents(w):
    """Every document's path; no two share one."""
    return w.documents().groupBy("path").agg(F.count("*").alias("n"))


@query("SELECT l.year, l.type AS index, l.topic_id, t.position, t.page_id, p.page_title AS title, cut AS abstract FROM topten_lists l LEFT JOIN (SELECT * FROM toptens UNION ALL SELECT * FROM toptens_all) t USING (year, type, topic_id) LEFT JOIN pages p ON p.page_id = t.page_id LEFT JOIN (SELECT * FROM cuts WHERE nbytes = 512) c ON c.page_id = t.page_id", abstracts=True)
def a17_annual_json(w):
    """The rankings of each year as one JSON array, read again."""
    j = documents.annual_rankings(w.topten_lists, w.pages).select("year", F.explode(F.from_json("json", documents.ANNUAL)).alias("r"))
    return j.select("year", "r.index", "r.topic_id", F.explode_outer("r.items").alias("e")).select("year", "index", "topic_id", "e.position", "e.page_id", "e.title", "e.abstract")


@query("SELECT page_id, page_title, page_type, parent_id, text AS page_abstract FROM pages LEFT JOIN (SELECT page_id, text FROM abstracts) USING (page_id)", abstracts=True)
def s5_pages_csv(w):
    """Pages with their abstracts, line feeds and quotes in them, written as CSV and read again."""
    path = f"{shared_folder(w.raw_pages.sparkSession)}/pages-csv-{uuid.uuid4().hex}"
    files.write_csv(files.pages_out(w.raw_pages), path)
    return files.pages_in(files.read_csv(w.raw_pages.sparkSession, path, schema.PAGES_CSV)).select("page_id", "page_title", "page_type", "parent_id", "page_abstract")


@query("SELECT page_id, user_id, row_number() OVER (PARTITION BY page_id ORDER BY user_id) AS place FROM contributions")
def t7_adjacency_order(w):
    """The graph's edges in order; a place is told by where the sorted rows stand."""
    from pyspark.sql import Window

    edges = w.contributions.select(F.col("page_id").alias("a"), F.col("user_id").alias("b"))
    stood = graph.adjacency_order(edges).withColumn("at", F.monotonically_increasing_id())
    return stood.select(F.col("a").alias("page_id"), F.col("b").alias("user_id"), (F.col("at") - F.min("at").over(Window.partitionBy("a")) + 1).alias("place"))


@query("SELECT page_id, page_type, count(*) AS n_revisions, max(rev_serialid)::BIGINT AS last FROM pages JOIN revisions USING (page_id) GROUP BY ALL")
def s19_bucketed_tables(w):
    """Pages and revisions as bucketed tables; their join and count by page need no shuffle."""
    spark = w.raw_pages.sparkSession
    name = f"run_{uuid.uuid4().hex}"
    w.save_tables(name, f"{shared_folder(spark)}/{name}")
    opened = Warehouse.of_database(spark, name)
    return opened.raw_pages.join(opened.revisions.select("page_id", "rev_serialid"), "page_id").groupBy("page_id", "page_type").agg(F.count("*").alias("n_revisions"), F.max("rev_serialid").cast("bigint").alias("last"))


@query(
    """SELECT rule, CASE rule WHEN 'k1' THEN (SELECT count(*) FROM articles WHERE page_id % 50 = 0) WHEN 'k2' THEN (SELECT count(*) FROM articles WHERE page_id % 50 = 0) WHEN 'k3' THEN (SELECT count(*) FROM revisions WHERE page_id % 70 = 0)
    WHEN 'k4' THEN (SELECT count(*) FROM revisions WHERE page_id % 30 = 0) WHEN 'k5' THEN (SELECT count(*) FROM revisions WHERE page_id % 30 = 0) WHEN 'k6' THEN (SELECT count(*) FROM articles WHERE page_id % 40 = 0)
    WHEN 'k7' THEN (SELECT count(*) FROM articles WHERE page_id % 60 = 0) WHEN 'title_length' THEN (SELECT count(*) FROM articles WHERE page_id % 50 = 0) ELSE (SELECT count(*) FROM articles WHERE page_id % 60 = 0) END AS n
    FROM (SELECT unnest(['k1', 'k2', 'k3', 'k4', 'k5', 'k6', 'k7', 'title_length', 'page_type']) AS rule)"""
)
def k_planted(w):
    """The integrity rules over data with planted faults of each kind."""
    pages, revisions = w.raw_pages, w.revisions
    articles = pages.where("page_type = 'article'")
    twice = articles.where("page_id % 50 = 0").withColumns({"page_title": F.repeat(F.lit("x"), 600), "parent_id": F.lit(-5).cast("bigint")})
    without = articles.where("page_id % 40 = 0").withColumn("page_id", -F.col("page_id") - 1_000_000_000)
    drafts = articles.where("page_id % 60 = 0").withColumns({"page_id": -F.col("page_id"), "parent_id": F.lit(0).cast("bigint"), "page_type": F.lit("draft")})
    nowhere = revisions.where("page_id % 30 = 0").withColumns({"page_id": -F.col("page_id") - 2_000_000_000, "rev_timestamp": F.lit(None).cast(revisions.schema["rev_timestamp"].dataType)})
    dirty = pages.unionByName(twice).unionByName(without).unionByName(drafts)
    return schema.violations(dirty, revisions.unionByName(revisions.where("page_id % 70 = 0")).unionByName(nowhere))


@query(
    "SELECT rule, 0::BIGINT AS n FROM (SELECT unnest(['k1', 'k2', 'k3', 'k4', 'k5', 'k6', 'k7', 'title_length', 'page_type']) AS rule)"
)
def k_constraints(w):
    return schema.violations(w.raw_pages, w.revisions)
