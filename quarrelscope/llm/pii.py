"""Personal data (operator 7): expressions propose spans, checksums confirm them, context words move the score.

Base kinds (email, ip, card, phone) follow fixed definitions and always count.  The
method adds further kinds whose patterns alone are weak evidence: IBANs have their
country's length and must pass mod 97, national numbers and local phone numbers need a
context word near by, secrets (passwords, tokens, keys) the look of one or a name that
says so.  Each added span starts from its kind's score, gains CONTEXT_GAIN when one of the
kind's words stands within CONTEXT_CHARS characters before it (CONTEXT_AFTER after it), and
is reported at THRESHOLD or more.  An added span never overlaps a base span or an added one
of a kind listed before; of two that begin at one place the kind listed first stays.

Spans are (kind, start, end, score): code points, end exclusive.  Null text is
empty text and has no spans; rows are judged one by one, so repeated rows give
repeated results, a null id stays null; whole texts are scanned, whatever their length, in
linear time but for the sorting of spans; other columns are not looked at; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "national_id", "local_phone", "secret")
CONTEXT_CHARS, CONTEXT_AFTER, CONTEXT_GAIN, THRESHOLD = 48, 16, 0.4, 0.6


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"\b(?=([A-Z]{2})[0-9]{2}(?: ?[A-Z0-9]){11,30})")
#: Lengths of IBANs by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28, EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23,
    IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27, TL=23,
    TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
#: A value that a name gives away, and values that have a known look.
_NAMED_SECRET = re.compile(r"(?i)(?<![a-z])(?:pass(?:word|wd|phrase)|pwd|secret|token|credentials?|(?:api|access|auth|private|secret)[_-]?key)(?:[_-](?:id|key|token))?[\"']?[ \t]{0,3}[:=][ \t]{0,3}([\"']?)([^\s\"',;<>]{8,200})")
_KNOWN_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,100}|sk-[A-Za-z0-9_-]{20,100}|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10,2000}\.eyJ[A-Za-z0-9_-]{10,2000}\.[A-Za-z0-9_-]{10,2000})(?![A-Za-z0-9])")
_KEY_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]{0,20000}-----END [A-Z ]{0,30}PRIVATE KEY-----")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = str.maketrans("", "", " -().+")
#: Start score and context words of the added kinds.
_CONTEXT = {
    "iban": (0.9, re.compile(r"iban|account|konto|compte|cuenta", re.I)),
    "national_id": (0.3, re.compile(r"ssn|social security|national id|passport|ausweis|identidad", re.I)),
    "secret": (0.4, re.compile(r"pass|pwd|secret|token|credential|key|auth|bearer", re.I)),
    "local_phone": (0.3, re.compile(r"phone|call|tel\b|tel[.:]|mobile|fax|telefon|téléphone|teléfono", re.I)),
}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses; walks from one @ to the next, so long runs cost no more than their length."""
    done, at = 0, text.find("@")
    while at >= 0:
        s = at
        while s > done and text[s - 1] in _LOCAL:
            s -= 1
        m = _DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end()
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def _small_part(p: str) -> bool:
    p = p.lstrip("0")
    return len(p) < 3 or len(p) == 3 and p <= "255"


def base_spans(text: str) -> list[Span]:
    out = [Span("email", s, e, 1.0) for s, e in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    out += [Span("ip", *m.span(), 1.0) for m in _IP.finditer(text) if all(map(_small_part, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().translate(_NOT_DIGIT)
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(Span("card", *m.span(), 1.0))
    if "+" in text:
        out += [Span("phone", *m.span(), 1.0) for m in _PHONE.finditer(text) if 8 <= len(m.group().translate(_NOT_DIGIT)) <= 15]
    return out


def _scored(kind: str, text: str, start: int, end: int, bonus: float = 0.0) -> Span:
    least, words = _CONTEXT[kind]
    near = text[max(0, start - CONTEXT_CHARS) : start] + "\n" + text[end : end + CONTEXT_AFTER]
    return Span(kind, start, end, min(1.0, least + bonus + (CONTEXT_GAIN if words.search(near) else 0.0)))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """IBANs of their country's length, single spaces between the characters or not, that pass mod 97."""
    for m in _IBAN.finditer(text):
        left, at = IBAN_LENGTHS.get(m.group(1), 0), m.start()
        while left and at < len(text) and (text[at] in _IBAN_CHARS or text[at] == " " and text[at - 1] != " "):
            left -= text[at] != " "
            at += 1
        if not left and at > m.start() and not (at < len(text) and text[at] in _IBAN_CHARS) and mod97(text[m.start() : at]):
            yield m.start(), at


_IBAN_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def secrets(text: str) -> Iterator[tuple[int, int, float]]:
    """(start, end, bonus): values of a known look, and named values that mix digits and letters."""
    if "-----BEGIN" in text:
        yield from ((*m.span(), 0.6) for m in _KEY_BLOCK.finditer(text))
    yield from ((*m.span(), 0.6) for m in _KNOWN_SECRET.finditer(text))
    for m in _NAMED_SECRET.finditer(text):
        value = m.group(2)
        if any(map(str.isdigit, value)) and any(map(str.isalpha, value)):
            yield *m.span(2), 0.0  # the name before it is its context


class _Taken:
    """Spans by place: whether a new one overlaps any, in logarithmic time."""

    def __init__(self, spans_: list[Span]):
        ordered = sorted((s.start, s.end) for s in spans_)
        self.starts, self.ends = [s for s, _ in ordered], list(accumulate((e for _, e in ordered), max))

    def overlaps(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """The spans of the added kinds that reach THRESHOLD, by kind as listed and then start."""
    if not _DIGIT.search(text):
        return []
    found_: dict[str, list[Span]] = {"iban": [_scored("iban", text, *at) for at in ibans(text)]}
    if "-" in text:
        found_["national_id"] = [_scored("national_id", text, *m.span()) for m in _NATIONAL.finditer(text) if m.group()[:3] not in ("000", "666") and m.group()[0] != "9" and m.group()[4:6] != "00" and m.group()[7:] != "0000"]
    found_["local_phone"] = [_scored("local_phone", text, *m.span()) for m in _LOCAL_PHONE.finditer(text)]
    found_["secret"] = sorted(_scored("secret", text, *at) for at in secrets(text))
    kept: list[Span] = []
    for kind in ADDED_KINDS:
        taken, done = _Taken([*base, *kept]), -1
        for s in found_.get(kind, ()):
            if s.score >= THRESHOLD and s.start >= done and not taken.overlaps(s.start, s.end):
                kept.append(s)
                done = s.end
    return kept


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans, each by kind as listed and then start."""
    base = base_spans(text)
    return base, added_spans(text, base)


SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double,text:string>>"


def found(df: DataFrame) -> DataFrame:
    """(doc_id, base, added) of every document: lists of spans with their text and score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("text", pa.string())]))
        schema = pa.schema([("doc_id", pa.int64()), ("base", one), ("added", one)])
        for b in common.small(batches, 2048):
            both: tuple[list, list] = ([], [])
            for t in b.column(1).to_pylist():
                for to, got in zip(both, spans(t)):
                    to.append([{**s._asdict(), "text": t[s.start : s.end]} for s in got])
            yield common.batch(schema, b.column(0), *both)

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, f"doc_id bigint, base {SPAN_TYPE}, added {SPAN_TYPE}")


def digest(spans_: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans_)


def report(df: DataFrame) -> DataFrame:
    """One row a document: counts of the base kinds, the digest of the base spans, all spans as text, and the added kinds' count."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found(df).select("doc_id", *map(n, BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("bigint").alias("n_added"))


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets."""
    out, at = [], 0
    for s in sorted((x for part in spans(text) for x in part), key=lambda x: (x.start, -x.end)):
        if s.start >= at:
            out += [text[at : s.start], f"<{s.kind}>"]
            at = s.end
    return "".join([*out, text[at:]])
