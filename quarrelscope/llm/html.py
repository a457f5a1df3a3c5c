"""Main text of web pages by two-pass block rules (operator 10).

A linear scanner cuts a page into blocks at block-level tags and line separators of
lists and tables.  Pass one decides blocks on their own: a block inside a container that
is boilerplate by nature (navigation, header, footer, aside, form, or one whose class,
id or role names an advert, notice, menu, sidebar, comments ...) is out; so is one of
high link density, but for headings and running text inside the article.  A long block
is in if it stands in the article (article or main) or has many stop words; a middling
one if it has enough of them.  What is left -- short blocks -- is ambiguous.  Pass two
gives each ambiguous block the label of its nearest decided neighbours: in if the decided
blocks on both sides are in; if they differ, a heading follows the block after it and any
other block the side that shares its container.  Where a page has an article, an
ambiguous block inside it is in, and one outside only if it is a heading and leads on to
a block that is in.  Where nothing is decided, all that isn't out counts as in.

A mark names boilerplate by its last part: reader-comments and comments-section do,
social-history doesn't.  Inside an article headings are never judged by their marks, and
ids only where they can mean nothing else.  Pages that are one form as a whole are read
as if it weren't there.

White space inside a block becomes one space; the kept blocks are joined by one line
feed in page order.  Null or empty html gives empty text; unclosed tags, stray closing
tags and cut-off pages are read as far as they go; pages of any length are read whole, in
linear time; repeated rows give repeated results, null ids and addresses stay null; no
other column is looked at; there are no ties; an empty table gives none.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Fixed lists: elements of the HTML standard.
BLOCK_TAGS = frozenset("address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text: inside an article they may be a link as a whole.
RUNNING = frozenset("p blockquote pre figcaption caption dd td".split())
#: Their content is no text of the page.
SILENT_TAGS = ("script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "textarea", "select", "title", "head", "button", "audio", "video")
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog".split())
#: What ids name that can mean nothing else, also inside an article.
PLAIN_MARKS = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner menu menubar navbar navigation breadcrumb breadcrumbs sidebar footer masthead topbar cookie cookies consent gdpr popup modal newsletter signup login comments disqus pagination pager paywall".split())
#: What classes, roles and ids name.
MARKS = PLAIN_MARKS | frozenset("nav side aside foot header notice notices notification alert overlay subscribe subscription search share sharing social related recommended recommendations comment reply replies respond discussion copyright legal disclaimer toc tags widget skip hidden complementary contentinfo form".split())
#: Parts of a mark that may follow the word that names it.
TAILS = frozenset("area bar block body bottom box button buttons center col column container content group holder inner item items label left link links list main outer panel placeholder right row section slot text title top unit wrap wrapper zone".split())
#: Frequent function words of the four languages; they must hold for any text, so the list is short.
STOP_WORDS = frozenset(
    "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so what up said its about than into them can only other time new some could these two may first then do any my now such like our over me even most made after also did many off before must well back through years where much your way down should because"
    " der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein wurde"
    " de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son lui nous comme mais elle leur même si tout aux cette ces ses été être fait sans"
    " el los y las del se por con su para al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante".split()
)
MIN_LONG, MIN_MIDDLE, STOP_LOW, STOP_HIGH, MAX_LINKS = 200, 70, 0.05, 0.15, 0.5

#: A tag's quoted values may hold >; their number and length are bounded, so that stray quotes can't make the scan quadratic.
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']++|\"[^\"]{0,5000}\"|'[^']{0,5000}'){0,100}+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>", re.S)
#: A class like has-sidebar tells what stands beside.
_BESIDE = re.compile(r"(?:has|with|no|without|is|show|js|wp)[_-]|.*[_-](?:with|has|no)[_-]", re.I)
_MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_GONE = re.compile(r"\bhidden(?=[\s=/>]|$)|aria-hidden\s*=\s*[\"']?true|style\s*=\s*[\"'][^\"']*display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    __slots__ = ("tag", "raw", "linked", "out", "article", "text", "label")

    def __init__(self, tag: str, out: bool, article: int):
        self.tag, self.out, self.article = tag, out, article
        self.raw: list[str] = []
        self.linked = 0
        self.text, self.label = "", ""


def _names(mark: str) -> str:
    """The part of a mark that says what the element is: the last but for numbers and tails."""
    parts = [p.lower() for p in re.split(r"[-_]+", _CAMEL.sub("-", mark)) if p and not p.isdigit()]
    while len(parts) > 1 and parts[-1] in TAILS:
        parts.pop()
    return parts[-1] if parts else ""


def _boilerplate(tag: str, attributes: str, inside_article: bool, forms_out: bool) -> bool:
    if tag in BOILERPLATE_TAGS:
        return forms_out or tag != "form"
    if tag == "header" and not inside_article:
        return True
    if not attributes:
        return False
    if _GONE.search(attributes):
        return True
    if tag in ("body", "html", "article", "main") or inside_article and tag in HEADINGS:
        return False
    for m in _MARKED.finditer(attributes):
        listed = PLAIN_MARKS if inside_article and m.group(1).lower() == "id" else MARKS
        for mark in (m.group(2) or m.group(3) or m.group(4) or "").split():
            name = _names(mark)
            if name in listed and not _BESIDE.match(mark) and not (inside_article and name == "header"):  # an article's own head
                return True
    return False


#: Elements whose end tags may be left out, and what their start ends.
_ENDS = {"p": ("p",), "li": ("li", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option",)}


def blocks(page: str, forms_out: bool = True) -> list[Block]:
    """Blocks of the page in order, with where they stand."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int]] = []  # open elements: name, boilerplate, number of the article
    open_: Counter = Counter()  # how many of each name are open
    unended: set[str] = set()  # silent elements that no end tag follows any more
    link, articles, at, n = -1, 0, 0, len(page)  # link: how deep the open link stands, or -1
    last = page.rfind(">")
    now = Block("", False, 0)

    def cut(tag: str) -> None:
        nonlocal now
        if now.raw:
            out.append(now)
        _, bad, article = stack[-1] if stack else ("", False, 0)
        now = Block(tag, bad, article)

    def shrink(k: int) -> None:
        """Close the elements from the kth on, and a link that was opened inside them."""
        nonlocal link
        open_.subtract(x[0] for x in stack[k:])
        del stack[k:]
        if link > k:
            link = -1

    def push(name: str, bad: bool, article: int) -> None:
        stack.append((name, bad, article))
        open_[name] += 1

    def say(s: str) -> None:
        if s:
            now.raw.append(s)
            if link >= 0:
                now.linked += len(s.strip())

    while at < n:
        m = _TAG.search(page, at) if at <= last or page.find("<!--", at) >= 0 else None
        if not m:
            rest = page[at:]
            k = rest.rfind("<")
            say(rest[:k] if k >= 0 and re.match(r"</?[A-Za-z!]", rest[k:]) and ">" not in rest[k:] else rest)
            break
        say(page[at : m.start()])
        at = m.end()
        name = m.group(2) or m.group(5)
        if not name:
            continue
        name, closing, attributes = name.lower(), bool(m.group(1) or m.group(4)), m.group(3) or m.group(6) or ""
        if closing:
            if name == "a":
                link = -1
            elif name in BLOCK_TAGS or any(x[0] == name for x in stack[-3:]):
                if open_[name]:
                    shrink(next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name))
                if name in BLOCK_TAGS:
                    cut(stack[-1][0] if stack else "")
            continue
        if name in SILENT_TAGS:
            if not attributes.endswith("/") and name not in unended:
                end = re.compile(rf"</{name}\s*>" if name != "head" else r"</head\s*>|(?=<body[\s>])", re.I).search(page, at)
                if not end:
                    unended.add(name)
                at = end.end() if end else (n if name in ("script", "style") else at)
            continue
        if name == "a":
            link = len(stack)
        elif name == "br" or name in VOID_TAGS and name != "hr":
            say(" ")
        elif name == "hr":
            cut(stack[-1][0] if stack else "")
        elif name in BLOCK_TAGS:
            if name in _ENDS:
                k = len(stack)
                while k and stack[k - 1][0] in _ENDS[name]:
                    k -= 1
                shrink(k)
            elif stack and stack[-1][0] == "p":
                shrink(len(stack) - 1)
            _, bad, article = stack[-1] if stack else ("", False, 0)
            if name in ("article", "main") and not article:
                articles += 1
                article = articles
            push(name, bad or _boilerplate(name, attributes, bool(article), forms_out), article)
            cut(name)
        elif attributes.strip() and not attributes.endswith("/") and _boilerplate(name, attributes, True, forms_out):  # an inline element that is an advert, a notice ...
            _, bad, article = stack[-1] if stack else ("", False, 0)
            push(name, True, article)
            cut(name)
    cut("")
    for b in out:
        b.text = _SPACE.sub(" ", html.unescape("".join(b.raw))).strip()
    return [b for b in out if b.text]


def _stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def _first_pass(b: Block) -> str:
    if b.out:
        return "out"
    running = b.article and (b.tag in HEADINGS or b.tag in RUNNING)
    if not running and b.linked > MAX_LINKS * sum(map(len, b.raw)):
        return "out"
    size = len(b.text)
    if size >= MIN_LONG and (b.article or _stop_share(b.text) >= STOP_HIGH):
        return "in"
    if size >= MIN_MIDDLE and _stop_share(b.text) >= (STOP_LOW if b.article else STOP_HIGH):
        return "in"
    return ""


def _nearest(found: list[Block]) -> tuple[list[int], list[int]]:
    """For each block the place of the decided one before and after it; -1 or their number where there is none."""
    n = len(found)
    before, after, seen = [0] * n, [0] * n, -1
    for k in range(n):
        before[k] = seen
        seen = k if found[k].label else seen
    seen = n
    for k in range(n - 1, -1, -1):
        after[k] = seen
        seen = k if found[k].label else seen
    return before, after


def labelled(page: str, forms_out: bool = True) -> list[Block]:
    """The page's blocks with their labels, in or out, after both passes."""
    found = blocks(page, forms_out)
    has_article = any(b.article and not b.out for b in found)
    for b in found:
        b.label = _first_pass(b)
    n, given = len(found), []
    before, after = _nearest(found)
    for k, b in enumerate(found):
        if b.label:
            continue
        following = found[after[k]] if after[k] < n else None
        if has_article and not b.article:
            given.append((b, "in" if b.tag in HEADINGS and (following is None or following.label == "in") else "out"))
            continue
        sides = [found[j] for j in (after[k], before[k]) if 0 <= j < n]
        own = [s for s in sides if s.article == b.article and not s.out]  # neighbours by nature out say nothing about a block outside them
        labels = {s.label for s in (own or sides)}
        if b.article and (not own or len(labels) > 1) or not labels:
            given.append((b, "in"))
        elif len(labels) == 1:
            given.append((b, labels.pop()))
        else:
            near = following if b.tag in HEADINGS or before[k] < 0 or following and after[k] - k <= k - before[k] else found[before[k]]
            given.append((b, near.label))
    for b, label in given:
        b.label = label
    return found


def main_text(page: str) -> str:
    found = labelled(page)
    if not any(b.label == "in" for b in found) and any(b.out for b in found):
        found = labelled(page, forms_out=False)
    return "\n".join(b.text for b in found if b.label == "in")


def extracted(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
        for b in common.small(batches, 1024):
            texts = [main_text(t) for t in b.column(2).to_pylist()]
            yield common.batch(schema, b.column(0), b.column(1), texts, list(map(len, texts)))

    return df.select(F.col(id_col).cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html")).mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
