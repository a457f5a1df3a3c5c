"""The same analysis in plain SQL, as common table expressions that each query's SQL selects from.

Written for clarity, not speed: it counts dominating articles by a direct comparison
of all pairs of cells and ranks pages by window functions over all of them.
"""

from __future__ import annotations

_CTES: dict[str, str] = {
    "articles": "SELECT p_partkey + 1000 AS page_id, p_name || ' ' || p_partkey AS page_title, regexp_extract(p_brand, '([0-9]+)$', 1)::BIGINT AS parent_id FROM part",
    "topics": "SELECT DISTINCT parent_id AS topic_id, 'Topic' || parent_id || ' things' AS page_title, 'topic' || parent_id AS topic FROM articles",
    "pages": "SELECT page_id, page_title, parent_id, 'article' AS page_type FROM articles UNION ALL SELECT topic_id, page_title, 0, 'topic' FROM topics UNION ALL SELECT 0, NULL, 0, 'global'",
    "abstracts": "SELECT page_id, parent_id, text FROM (SELECT doc_id + 1000 AS page_id, text FROM documents) JOIN articles USING (page_id) WHERE text IS NOT NULL",
    "cuts": """SELECT page_id, text, nbytes, regexp_extract(left(text, n::INTEGER), '(?s)^(.*[\\p{L}\\p{M}\\p{N}])[^\\p{L}\\p{M}\\p{N}]', 1) AS cut
        FROM (SELECT page_id, text, nbytes, max(n) AS n FROM abstracts, (SELECT unnest([256, 512]) AS nbytes), (SELECT unnest(range(0, 513)) AS n) WHERE n <= nbytes AND strlen(left(text, n::INTEGER)) <= nbytes GROUP BY ALL)""",
    "page_words": "SELECT page_id, parent_id, word, count(*) AS n FROM (SELECT page_id, parent_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{M}]+')) AS word FROM abstracts) GROUP BY ALL",
    "word_fields": """SELECT page_id, key, word, value FROM (SELECT *, row_number() OVER (PARTITION BY page_id, key ORDER BY value DESC, word) AS place FROM (
        SELECT 0 AS page_id, 'Word2Occur' AS key, word, sum(n)::DOUBLE AS value FROM page_words GROUP BY word
        UNION ALL SELECT parent_id, 'Word2Occur', word, sum(n)::DOUBLE FROM page_words GROUP BY parent_id, word
        UNION ALL SELECT page_id, 'Word2TFIDF', word, round(n * ln((SELECT count(DISTINCT page_id) FROM page_words) / df), 9) FROM page_words JOIN (SELECT word, count(*) AS df FROM page_words GROUP BY word) USING (word)
        UNION ALL SELECT page_id, 'BWord2Occur', word, n::DOUBLE FROM page_words WHERE word IN ('of', 'und', 'les', 'con'))) WHERE place <= 100""",
    "revisions": """SELECT *, (row_number() OVER w)::INTEGER AS rev_serialid, rev_charweight - lag(rev_charweight, 1, 0.0::DOUBLE) OVER w AS rev_chardiff
        FROM (SELECT l_partkey + 1000 AS page_id, CASE WHEN o_custkey % 10 != 0 THEN o_custkey END AS user_id, o_custkey % 17 = 0 AS user_isbot, floor(l_extendedprice)::DOUBLE AS rev_charweight,
          CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS rev_isrevert, l_shipdate AS rev_timestamp, year(l_shipdate)::INTEGER AS rev_year, l_orderkey, l_linenumber
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        WINDOW w AS (PARTITION BY page_id ORDER BY rev_timestamp, l_orderkey, l_linenumber)""",
    "timebounds": "SELECT min(rev_year) AS minyear, max(rev_year) AS maxyear, min(rev_timestamp) AS mintimestamp, max(rev_timestamp) AS maxtimestamp FROM revisions",
    "years": "SELECT unnest(range(minyear, maxyear + 1))::INTEGER AS year FROM timebounds UNION ALL SELECT 0",
    "spans": "SELECT page_id, min(rev_year) AS minyear, max(rev_year) AS maxyear, min(rev_timestamp) AS mintimestamp, max(rev_timestamp) AS maxtimestamp FROM revisions GROUP BY page_id",
    "created": "SELECT page_id, page_type, parent_id, CASE WHEN page_type = 'article' THEN minyear ELSE (SELECT minyear FROM timebounds) END AS page_creationyear FROM pages LEFT JOIN spans USING (page_id)",
    "pagetree": "SELECT page_id, parent_id FROM pages UNION SELECT c.page_id, p.parent_id FROM pages c JOIN pages p ON c.parent_id = p.page_id",
    "edits": "SELECT page_id, rev_year AS year, user_id, rev_isrevert > 0 AS reverted FROM revisions WHERE user_id IS NOT NULL",
    "all_edits": "SELECT * FROM edits UNION ALL SELECT t.parent_id, year, user_id, reverted FROM edits e JOIN pagetree t ON e.page_id = t.page_id",
    "counts": """SELECT page_id, year, popularity, conflict, page_type FROM (
        SELECT page_id, year, count(DISTINCT user_id) AS popularity, count(DISTINCT user_id) FILTER (reverted) AS conflict FROM all_edits GROUP BY page_id, year
        UNION ALL SELECT page_id, 0, count(DISTINCT user_id), count(DISTINCT user_id) FILTER (reverted) FROM all_edits GROUP BY page_id) JOIN pages USING (page_id)""",
    "live": "SELECT year, count(*) AS totalpagecount FROM created, years, timebounds WHERE page_type = 'article' AND (year = 0 OR year BETWEEN page_creationyear AND maxyear) GROUP BY year",
    "paired": "SELECT page_id, year, popularity, conflict FROM counts WHERE page_type = 'article' AND conflict > 0",
    "cells": "SELECT year, popularity, conflict, count(*) AS count FROM paired GROUP BY ALL",
    "dominance": """SELECT year, p.popularity, c.conflict, coalesce(sum(o.count), 0)::BIGINT AS count
        FROM (SELECT DISTINCT year, popularity FROM cells) p JOIN (SELECT DISTINCT year, conflict FROM cells) c USING (year)
        LEFT JOIN cells o USING (year) WHERE o.popularity <= p.popularity AND o.conflict >= c.conflict GROUP BY ALL
        UNION ALL SELECT year, p.popularity, c.conflict, 0 FROM (SELECT DISTINCT year, popularity FROM cells) p JOIN (SELECT DISTINCT year, conflict FROM cells) c USING (year)
        WHERE NOT EXISTS (SELECT 1 FROM cells o WHERE o.year = p.year AND o.popularity <= p.popularity AND o.conflict >= c.conflict)""",
    "untimed": "SELECT page_id, year, conflict / popularity * log10(totalpagecount / count) AS weight FROM paired JOIN dominance USING (year, popularity, conflict) JOIN live USING (year)",
    "timeweights": """SELECT page_id, year, (epoch_us(least(maxtimestamp, make_timestamp(year + 1, 1, 1, 0, 0, 0))) - epoch_us(greatest(mintimestamp, make_timestamp(year, 1, 1, 0, 0, 0)))) / 86400e6 AS weight
        FROM spans JOIN years ON year BETWEEN minyear AND maxyear UNION ALL SELECT page_id, 0, (epoch_us(maxtimestamp) - epoch_us(mintimestamp)) / 86400e6 FROM spans""",
    "polemic": "SELECT page_id, year, u.weight * t.weight AS weight FROM untimed u JOIN timeweights t USING (page_id, year)",
    "polemic_above": "SELECT t.parent_id AS page_id, year, sum(weight) AS weight FROM polemic p JOIN pagetree t ON p.page_id = t.page_id GROUP BY ALL",
    "indices": "SELECT 'conflict' AS type, page_id, year, conflict::DOUBLE AS weight FROM counts WHERE conflict > 0 UNION ALL SELECT 'polemic', * FROM polemic UNION ALL SELECT 'polemic', * FROM polemic_above",
    "types": "SELECT DISTINCT type, page_type FROM indices JOIN pages USING (page_id)",
    "cube": """SELECT type, page_id, parent_id AS topic_id, page_type, year, round(coalesce(weight, 0), 9) AS weight
        FROM (SELECT * FROM created JOIN types USING (page_type) JOIN (SELECT year, maxyear FROM years, timebounds) ON year = 0 OR year BETWEEN page_creationyear AND maxyear) LEFT JOIN indices USING (type, page_id, year)""",
    "ranked": """SELECT *, percent_rank() OVER up AS percentile, (dense_rank() OVER up - 1) / greatest(dense_rank() OVER up + dense_rank() OVER down - 2, 1) AS dense_percentile, rank() OVER down AS rank,
        percent_rank() OVER topic_up AS topic_percentile, (dense_rank() OVER topic_up - 1) / greatest(dense_rank() OVER topic_up + dense_rank() OVER topic_down - 2, 1) AS topic_dense_percentile, rank() OVER topic_down AS topic_rank
        FROM cube WINDOW up AS (PARTITION BY type, year, page_type ORDER BY weight), down AS (PARTITION BY type, year, page_type ORDER BY weight DESC),
        topic_up AS (PARTITION BY type, year, page_type, topic_id ORDER BY weight), topic_down AS (PARTITION BY type, year, page_type, topic_id ORDER BY weight DESC)""",
    "toptens": "SELECT * FROM (SELECT year, type, topic_id, (row_number() OVER (PARTITION BY year, type, topic_id ORDER BY weight DESC, page_id))::INTEGER AS position, page_id, weight FROM cube WHERE page_type = 'article') WHERE position <= 10",
    "toptens_all": "SELECT * FROM (SELECT year, type, 0::BIGINT AS topic_id, (row_number() OVER (PARTITION BY year, type ORDER BY weight DESC, page_id))::INTEGER AS position, page_id, weight FROM toptens) WHERE position <= 10",
    "topten_full": "SELECT year, type, topic_id, list(page_id ORDER BY position) AS pages FROM (SELECT * FROM toptens UNION ALL SELECT * FROM toptens_all) GROUP BY ALL",
    "topten_lists": "SELECT year, type, topic_id, coalesce(pages, []) AS pages FROM (SELECT DISTINCT year, type FROM topten_full) JOIN (SELECT DISTINCT year, topic_id FROM topten_full) USING (year) LEFT JOIN topten_full USING (year, type, topic_id)",
    "contributions": """SELECT page_id, user_id, CASE WHEN big IS NOT NULL THEN least(big, 100.0) WHEN changed THEN 10.0 ELSE 1.0 END::DOUBLE AS weight FROM (
        SELECT page_id, user_id, sum(rev_chardiff / 10.0::DOUBLE) FILTER (rev_isrevert = 0 AND rev_chardiff > 100) AS big, bool_or(rev_isrevert = 0) AS changed
        FROM revisions WHERE user_id IS NOT NULL AND NOT user_isbot GROUP BY page_id, user_id)""",
    "norms": "SELECT page_id, sqrt(sum(weight * weight)) AS norm FROM contributions GROUP BY page_id",
    "similarities": "SELECT a, b, dot / x.norm / y.norm AS similarity FROM (SELECT e.page_id AS a, f.page_id AS b, sum(e.weight * f.weight) AS dot FROM contributions e JOIN contributions f ON e.user_id = f.user_id AND e.page_id < f.page_id GROUP BY ALL) JOIN norms x ON x.page_id = a JOIN norms y ON y.page_id = b",
    "jumps": """SELECT * FROM (SELECT page_id, (row_number() OVER (PARTITION BY page_id ORDER BY similarity DESC, neighbour))::INTEGER AS position, neighbour, similarity
        FROM (SELECT a AS page_id, b AS neighbour, round(similarity, 9) AS similarity FROM similarities UNION ALL SELECT b, a, round(similarity, 9) FROM similarities)) WHERE position <= 10""",
}


def select(sql: str) -> str:
    """sql, with the expressions that it needs before it; source_pages stands for the table pages of the same name."""
    import re

    if "source_pages" in sql:
        return sql.replace("source_pages", "pages")
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in _CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(_CTES[name])
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in needed) + "\n" + sql
