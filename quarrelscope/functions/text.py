"""Strings and numbers of documents: truncation, paths, titles, percentages.  Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LINK_LIMIT, TOPTEN_LIMIT, TITLE_BYTES = 256, 512, 245
#: Characters that paths can't hold, and what stands for them.
URL_FROM, URL_TO = " /?#", "_∕？＃"
_WORD_END = r"(?s)^(.*[\p{L}\p{M}\p{N}])[^\p{L}\p{M}\p{N}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_bytes(text, limit: int) -> Column:
    """The longest beginning of at most limit UTF-8 bytes; a character that doesn't fit is dropped."""
    cut = F.make_valid_utf8(F.substring(_col(text).cast("binary"), 1, limit).cast("string"))
    return F.when(F.octet_length(_col(text)) <= limit, _col(text)).otherwise(F.rtrim(cut, F.lit("\ufffd")))


def smart_truncate(text, limit: int = LINK_LIMIT) -> Column:
    """The longest beginning within limit bytes that ends a word and has a non-word character after it within the limit; else ''."""
    return F.regexp_extract(first_bytes(text, limit), _WORD_END, 1)


def url_text(text) -> Column:
    return F.translate(_col(text), URL_FROM, URL_TO)


def underscored(text) -> Column:
    return F.translate(_col(text), " ", "_")


def percentage(share) -> Column:
    """Whole percents, halves up."""
    return (_col(share) * 100 + 0.5).cast("int")


def byte_length(text) -> Column:
    return F.octet_length(_col(text))


def array_text(numbers) -> Column:
    """{1, 2}"""
    return F.concat(F.lit("{"), F.array_join(F.transform(_col(numbers), lambda x: x.cast("string")), ", "), F.lit("}"))


def rfc3339(timestamp) -> Column:
    return F.date_format(_col(timestamp).cast("timestamp_ntz").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def unix_seconds(timestamp) -> Column:
    """Seconds since 1970 of a timestamp without zone, read as UTC."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), _col(timestamp))


def topic_short_name(title) -> Column:
    """The first word of a topic's title, in lower case."""
    return F.lower(F.split(_col(title), " ")[0])


def page_path(page_type, title) -> Column:
    article = F.concat(F.lit("articles/"), url_text(first_bytes(title, TITLE_BYTES)), F.lit(".html"))
    topic = F.concat(F.lit("categories/"), url_text(title), F.lit(".html"))
    return F.when(_col(page_type) == "global", "index.html").when(_col(page_type) == "topic", topic).otherwise(article)


def span(year) -> Column:
    return F.when(_col(year) == 0, F.lit("all")).otherwise(_col(year).cast("string"))


def topten_path(year, index, topic) -> Column:
    return F.concat(F.concat_ws("/", F.lit("toptens"), span(year), _col(index), _col(topic)), F.lit(".html"))


def topten_title(year, index, topic) -> Column:
    when = F.when(_col(year) == 0, F.lit("All Time")).otherwise(_col(year).cast("string"))
    where = F.when(_col(topic) == "all", F.lit("")).otherwise(F.concat(F.lit(" for "), F.initcap(_col(topic))))
    return F.concat(when, F.lit(" Top Ten of "), F.initcap(_col(index)), where)
