"""Page documents, top-ten documents and outside enrichment."""

from __future__ import annotations

import html
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.schema import PAGE_FIELDS
from .topten import ordered as in_order

#: A document names so many words of its page.
TOP_WORDS = 100
#: A word of at least one document in so many is common.
COMMON = 500
#: What counts as a bad word unless the caller has a list.
BAD_WORDS = ("damn", "crap", "idiot", "stupid", "hell")


def _page():
    return F.struct(*(F.col(c) for c in PAGE_FIELDS))


def neighbours(pages: DataFrame, jumps: DataFrame) -> DataFrame:
    """(page_id, socialjumps): the neighbours' pages in order; ids without a page are left out."""
    places = jumps.select("page_id", F.posexplode("page_socialjumps").alias("position", "neighbour"))
    named = pages.select(F.col("page_id").alias("neighbour"), _page().alias("page"))
    listed = places.join(named.hint("merge"), "neighbour").groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "page"))), lambda x: x["page"]).alias("socialjumps"))
    return pages.select("page_id").join(listed.hint("merge"), "page_id", "left")


def page_infos(pages: DataFrame, stats: DataFrame, near: DataFrame) -> DataFrame:
    """(page_id, page, stats, socialjumps) of every page that has statistics."""
    out = pages.select("page_id", _page().alias("page")).join(stats.hint("merge"), "page_id").join(near.hint("merge"), "page_id", "left")
    return out.select("page_id", "page", "stats", F.coalesce("socialjumps", F.array().cast(out.schema["socialjumps"].dataType)).alias("socialjumps"))


def page_json(infos: DataFrame) -> DataFrame:
    """(page_id, json), nulls kept; links' abstracts are cut."""
    cut = F.transform("socialjumps", lambda p: p.withField("page_abstract", X.smart_truncate(p["page_abstract"], X.LINK_LIMIT)))
    return infos.select("page_id", F.to_json(F.struct("page", "stats", cut.alias("socialjumps")), {"ignoreNullFields": "false"}).alias("json"))


def enriched(pages: DataFrame, external: list[DataFrame]) -> DataFrame:
    """(page_id, fields): each page with the fields of all sources, a later source's winning.

    external: frames (id, fields map<string,string>), in order; ids without a page are skipped.
    """
    one = None
    for n, source in enumerate(external):
        rows = source.select("id", F.lit(n).alias("_source"), F.explode("fields").alias("key", "value"))
        one = rows if one is None else one.unionByName(rows)
    last = one.groupBy("id", "key").agg(F.max_by("value", "_source").alias("value"))
    fields = last.groupBy(F.col("id").alias("page_id")).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("fields"))
    return pages.select("page_id").join(fields.hint("merge"), "page_id", "left").withColumn("fields", F.coalesce("fields", F.create_map().cast("map<string,string>")))


def word_counts(texts: DataFrame) -> DataFrame:
    """(id, word, n) from (id, text): words of letters and marks, in lower case.

    Texts are dealt by id, in as many parts as shuffles have; their words, far more bytes, are then counted where they stand.
    """
    texts = texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id")
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{M}]+)"), 1))
    return texts.select("id", words.alias("word")).groupBy("id", "word").agg(F.count("*").alias("n"))


def counts_above(counts: DataFrame, pages: DataFrame) -> DataFrame:
    """(id, word, n) of topics and of the whole (id 0): sums over the articles below."""
    below = counts.join(pages.select(F.col("page_id").alias("id"), "parent_id").hint("merge"), "id")
    topics = below.groupBy("parent_id", "word").agg(F.sum("n").alias("n")).select(F.col("parent_id").alias("id"), "word", "n")
    whole = topics.groupBy("word").agg(F.sum("n").alias("n")).select(F.lit(0).cast("bigint").alias("id"), "word", "n")
    return topics.unionByName(whole)


def tf_idf(counts: DataFrame) -> DataFrame:
    """(id, word, tfidf): count times ln(documents / documents with the word), to nine digits.

    Words of at least one document in COMMON are at most COMMON times as many as a document's
    distinct words; they are broadcast, and most counts stay where they are.  The others, none of
    which stands out, are shuffled by word.
    """
    every = counts.select("id").distinct().agg(F.count("*").alias("_all"))
    df = counts.groupBy("word").agg(F.count("*").alias("_df")).crossJoin(F.broadcast(every))  # one row of totals
    common = df.where(F.col("_df") * COMMON >= F.col("_all"))
    rare = df.where(F.col("_df") * COMMON < F.col("_all"))
    both = counts.join(F.broadcast(common), "word").unionByName(counts.join(F.broadcast(common.select("word")), "word", "left_anti").join(rare.hint("merge"), "word"))
    return both.select("id", "word", F.round(F.col("n") * F.log(F.col("_all") / F.col("_df")), 9).alias("tfidf"))


def word_maps(rows: DataFrame, value: str, field: str, top: int = TOP_WORDS) -> DataFrame:
    """(id, fields): the values of the id's top words as one JSON map under the field's name; ties fall to the lesser word."""
    best = Window.partitionBy("id").orderBy(F.desc(value), "word")
    ranked = rows.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= top)
    pairs = F.sort_array(F.collect_list(F.struct("word", F.col(value).alias("value"))))
    return ranked.groupBy("id").agg(F.create_map(F.lit(field), F.to_json(F.map_from_entries(pairs))).alias("fields"))


def word_sources(counts: DataFrame, pages: DataFrame, bad_words: tuple[str, ...] = BAD_WORDS, top: int = TOP_WORDS) -> list[DataFrame]:
    """Sources for :func:`enriched` from the :func:`word_counts` of articles.

    The whole and the topics get Word2Occur, articles Word2TFIDF and, of the bad words,
    BWord2Occur.  A map holds the top words only, so that no cell grows with the corpus.
    """
    bad = counts.where(F.col("word").isin(*bad_words))
    return [word_maps(counts_above(counts, pages), "n", "Word2Occur", top), word_maps(tf_idf(counts), "tfidf", "Word2TFIDF", top), word_maps(bad, "n", "BWord2Occur", top)]


def split_stats(infos: DataFrame) -> DataFrame:
    """(page_id, type, all_time, by_year): the first measurement of each type, which is that of all time, and the others."""
    s = infos.select("page_id", F.explode("stats").alias("s"))
    m = F.col("s.measurements")
    return s.select("page_id", "s.type", F.element_at(m, 1).alias("all_time"), F.slice(m, F.lit(2), F.size(m)).alias("by_year"))


def _script(value) -> str:
    """JSON that is safe inside a script element."""
    return json.dumps(value, ensure_ascii=False, default=str).replace("<", "\\u003c").replace(">", "\\u003e").replace("&", "\\u0026").replace("\u2028", "\\u2028").replace("\u2029", "\\u2029")


def _entries(items) -> str:
    """An ordered list of pages with their topic and abstract."""
    rows = "".join(f'<li data-topic="{html.escape(str(p["topic"] or ""))}"><cite>{html.escape(p["title"] or "")}</cite> {html.escape(p["abstract"] or "")}</li>' for p in items)
    return f"<ol>{rows}</ol>"


def _document(lang: str, kind: str, marks: dict, title: str, script: str, body: str) -> str:
    data = "".join(f' data-{k}="{html.escape(str(v))}"' for k, v in marks.items())
    script = f"<script>\n{script}</script>" if script else ""
    return f'<!DOCTYPE html>\n<html lang="{html.escape(lang)}" data-kind="{html.escape(kind)}"{data}><head><meta charset="UTF-8"/><title>{html.escape(title)}</title>{script}</head><body><h1>{html.escape(title)}</h1>{body}</body></html>'


#: What the numbers of a ranking mean, in order.
RANKING_FIELDS = ("rank", "percentile", "dense_percentile", "index", "among", "span", "value")


def page_documents(infos: DataFrame, rankings: DataFrame, fields: DataFrame, topic_names: DataFrame, bounds: DataFrame, lang: str = "en", home: str = "", ordered: bool = False) -> DataFrame:
    """(path, data): one HTML document for each page; in order of page ids, if ordered.

    topic_names: (topic_id, topic); bounds: the one row of first and last times; home: the
    address of the whole.  The global page is the home page, whose script also names the fields.
    """
    rows = F.struct(*RANKING_FIELDS)
    ranks = rankings.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("index", "among", "span", rows.alias("row")))).alias("ranks"))
    own = F.when(F.col("page.page_type") == "article", F.col("page.parent_id")).otherwise(F.col("page.page_id"))
    times = bounds.select(F.struct("minyear", "maxyear", X.rfc3339("mintimestamp").alias("first"), X.rfc3339("maxtimestamp").alias("last")).alias("times"))
    named = infos.withColumn("topic_id", own).join(topic_names, "topic_id", "left").join(ranks.hint("merge"), "page_id", "left").join(fields.hint("merge"), "page_id", "left").crossJoin(F.broadcast(times))  # times is one row
    links = F.transform("socialjumps", lambda p: F.struct(p["page_title"].alias("title"), X.smart_truncate(p["page_abstract"], X.LINK_LIMIT).alias("abstract"), p["parent_id"].cast("string").alias("topic")))
    flat = named.select(
        "page_id",
        X.page_path("page.page_type", "page.page_title").alias("path"),
        F.to_json(F.struct(F.col("page.page_title").alias("title"), F.col("page.page_abstract").alias("abstract"), F.col("page.page_type").alias("type"), F.coalesce("topic", F.lit("")).alias("topic"), F.transform("ranks", lambda r: r["row"]).alias("ranks"), links.alias("links"), "fields", "times"), {"ignoreNullFields": "false"}).alias("info"),
    )
    flat = (flat.orderBy("page_id") if ordered else flat).drop("page_id")

    def render(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for raw in part["info"]:
                p = json.loads(raw)
                kind = {"article": "article", "topic": "topic"}.get(p["type"], "home")
                title = p["title"] or ""
                body = f"<p>{html.escape(p['abstract'] or '')}</p>{_entries(p['links']) if p['links'] else ''}" if kind == "article" else ""
                told = {"rankings": [list(r.values()) for r in p["ranks"] or []], "times": p["times"], **{k: json.loads(v) for k, v in (p["fields"] or {}).items()}}
                if kind == "home":
                    told |= {"ranking_fields": RANKING_FIELDS, "address": home}
                script = "".join(f"const {k} = {_script(v)};\n" for k, v in sorted(told.items()))
                out.append(_document(lang, kind, {"topic": p["topic"]}, title, script, body))
            yield pd.DataFrame({"path": part["path"], "data": out})

    return flat.mapInPandas(render, "path string, data string")


def _list_items(lists: DataFrame, pages: DataFrame) -> DataFrame:
    """(year, type, topic_id, items): each list's pages in order, abstracts cut."""
    places = lists.select("year", "type", "topic_id", F.posexplode_outer("pages").alias("position", "page_id"))
    entry = F.struct((F.col("position") + 1).alias("position"), "page_id", F.col("page_title").alias("title"), X.smart_truncate("page_abstract", X.TOPTEN_LIMIT).alias("abstract"), F.col("parent_id").cast("string").alias("topic"))
    full = places.join(pages.select("page_id", "page_title", "page_abstract", "parent_id").hint("merge"), "page_id", "left")
    return full.groupBy("year", "type", "topic_id").agg(F.sort_array(F.collect_list(F.when(F.col("page_id").isNotNull(), entry))).alias("items"))


ANNUAL = "array<struct<index:string,topic_id:bigint,items:array<struct<position:int,page_id:bigint,title:string,abstract:string,topic:string>>>>"


def annual_rankings(lists: DataFrame, pages: DataFrame) -> DataFrame:
    """(year, json): all top-ten lists of a year as one JSON array (schema ANNUAL), by index and topic."""
    one = F.struct(F.col("type").alias("index"), "topic_id", "items")
    return _list_items(lists, pages).groupBy("year").agg(F.to_json(F.sort_array(F.collect_list(one)), {"ignoreNullFields": "false"}).alias("json"))


def topten_documents(lists: DataFrame, pages: DataFrame, topic_names: DataFrame, lang: str = "en", ordered: bool = False) -> DataFrame:
    """(path, data): one HTML document for each top-ten list; by year, index and topic, if ordered."""
    topic = F.when(F.col("topic_id") == 0, F.lit("all")).otherwise(F.coalesce("topic", F.lit("")))
    named = _list_items(lists, pages).join(topic_names, "topic_id", "left").withColumn("topic", topic)
    named = in_order(named) if ordered else named
    flat = named.select(X.topten_path("year", "type", "topic").alias("path"), X.topten_title("year", "type", "topic").alias("title"), F.to_json("items", {"ignoreNullFields": "false"}).alias("items"), F.col("type").alias("index"), X.span("year").alias("span"), "topic")

    def render(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = [
                _document(lang, "topten", {"index": index, "span": span, "topic": topic}, title, "", _entries(json.loads(items)))
                for index, span, topic, title, items in zip(part["index"], part["span"], part["topic"], part["title"], part["items"])
            ]
            yield pd.DataFrame({"path": part["path"], "data": out})

    return flat.mapInPandas(render, "path string, data string")
