"""Quality rules as a short-circuit cascade (operator 9).

A rule is a cheap test over a document's measurements, which are taken when a rule first
asks for them.  The cascade first measures every rule on a sample: what it costs beyond
the words that all rules share, and which share it rejects.  It then runs the rules by
falling rejection per cost, and a document leaves at the first rule that rejects it.
The order changes the time only: the verdict is the same under every order;
:meth:`Cascade.verdict` names the rule that ended the cascade.

Edge cases: null text counts as empty and has no words; an empty document fails the
base rule; repeated rows are judged one by one and equally; very long texts are
measured whole; equal rates of two rules (ties) fall to the cheaper one, then to the order
given; other columns are kept as they are by :func:`kept` and not looked at by
:func:`measured`; an empty table gives an empty result.
"""

from __future__ import annotations

import operator
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
#: The order is estimated on at most so many documents, one in SAMPLE_EVERY by the hash of the text; results don't depend on it.
SAMPLE_ROWS, SAMPLE_EVERY = 400, 16
#: Longer documents don't serve as samples, so that the driver holds a bounded amount.
SAMPLE_CHARS = 100_000
_SYMBOLS, _CAPITALS, _SMALL = b"#*$%&|<>", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_rng = np.random.default_rng(9)
_WORD_VALUES = _rng.integers(1, 2**63, 1 << 16, dtype=np.uint64)
_MULTIPLIERS = _rng.integers(1, 2**63, WINDOW, dtype=np.uint64) | np.uint64(1)


class Measured:
    """A document whose measurements are taken when a rule first asks for them."""

    def __init__(self, text: str):
        self.text = text
        self.utf8 = text.encode("utf-8", "surrogatepass")
        self.size = len(self.utf8)
        self.words: list[bytes] = self.utf8.split()

    def __getattr__(self, name: str):
        if name.startswith("_"):
            raise AttributeError(name)
        value = self.__dict__[name] = _MEASURES[name](self)
        return value


def _word_chars(d: Measured) -> int:
    text = d.text
    return len(text) - sum(text.count(c) for c in " \t\n\x0b\x0c\r")


def _n_symbols(d: Measured) -> int:
    return d.size - len(d.utf8.translate(None, _SYMBOLS))


def _n_dup_lines(d: Measured) -> int:
    lines = [x for x in d.text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def _n_repeat_words(d: Measured) -> int:
    words = d.words
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    with np.errstate(over="ignore"):
        value = common.splitmix(code.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
        h = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            h += value[k : k + n] * _MULTIPLIERS[k]
    ranked = np.sort(h)
    if not (ranked[1:] == ranked[:-1]).any():
        return 0
    order = np.argsort(h, kind="stable")
    one, two = order[:-1], order[1:]
    same = h[one] == h[two]
    one, two = one[same], two[same]
    alike = np.ones(len(one), bool)  # windows of one hash are compared word by word
    for k in range(WINDOW):
        alike &= code[one + k] == code[two + k]
    at = np.unique(np.concatenate([one[alike], two[alike]]))
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def _n_stutters(d: Measured) -> int:
    return sum(map(operator.eq, d.words, d.words[1:]))


_MEASURES: dict[str, Callable[[Measured], float]] = {
    "n_words": lambda d: len(d.words),
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_dup_lines": _n_dup_lines,
    "n_lines": lambda d: sum(1 for x in d.text.split("\n") if x.strip(" \t\n\x0b\x0c\r")),
    "n_repeat_words": _n_repeat_words,
    "n_stutters": _n_stutters,
    "n_bangs": lambda d: d.text.count("!"),
    "n_capitals": lambda d: d.size - len(d.utf8.translate(None, _CAPITALS)),
    "n_small": lambda d: d.size - len(d.utf8.translate(None, _SMALL)),
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measured], bool]
    base: bool = False


#: The production rules.  Base rules come from the contract; the others reject only what is plainly not prose.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda d: d.n_words < MIN_WORDS, True),
    Rule("repeated_windows", lambda d: 100 * d.n_repeat_words > MAX_REPEAT_PERCENT * d.n_words, True),
    Rule("symbols", lambda d: 10 * d.n_symbols > 3 * d.n_words),
    Rule("word_length", lambda d: not 2 * d.n_words <= d.word_chars <= 20 * d.n_words),
    Rule("repeated_lines", lambda d: d.n_lines >= 4 and 10 * d.n_dup_lines > 6 * d.n_lines),
    Rule("stutter", lambda d: 10 * d.n_stutters > 3 * d.n_words),
    Rule("shouting", lambda d: 2 * d.n_capitals > d.n_small + d.n_capitals and 3 * d.n_bangs > d.n_words),
)


@dataclass
class Cascade:
    """Rules in the order of rejection per cost that a sample shows."""

    rules: tuple[Rule, ...] = RULES
    cost: dict[str, float] = field(default_factory=dict)
    share: dict[str, float] = field(default_factory=dict)

    def fit(self, texts: list[str]) -> Cascade:
        """Cost (seconds a call, with the measurements that the rule alone needs) and selectivity of each rule on the sample."""
        for r in self.rules:
            documents = [Measured(t) for t in texts]  # encoding and words are shared, so they are no rule's cost
            began, out = time.perf_counter(), 0
            for d in documents:
                out += bool(r.rejects(d))
            self.cost[r.name] = (time.perf_counter() - began) / max(1, len(texts)) + 1e-9
            self.share[r.name] = out / max(1, len(texts))
        self.rules = tuple(sorted(self.rules, key=lambda r: (-self.share[r.name] / self.cost[r.name], self.cost[r.name])))
        return self

    def verdict(self, d: Measured) -> str | None:
        """The rule that ends the cascade, or None if the document stays."""
        for r in self.rules:
            if r.rejects(d):
                return r.name
        return None


def fitted(df: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, text_col: str = "text", every: int = SAMPLE_EVERY) -> Cascade:
    """A cascade ordered on at most sample_rows documents, whole."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(text.alias("t")).where((F.pmod(F.xxhash64("t"), F.lit(every)) == 0) & (F.length("t") <= SAMPLE_CHARS)).limit(sample_rows).collect()
    return Cascade(rules).fit([r.t for r in rows])


OUT = "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"
_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(df: DataFrame, cascade: Cascade | None = None) -> DataFrame:
    """Base measurements and verdict of every document; columns of OUT."""
    cascade = cascade or fitted(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = [r for r in cascade.rules if r.base]
        schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in _COLUMNS), ("base_failed", pa.bool_()), ("kept", pa.bool_())])
        for b in common.small(batches):
            rows = []
            for t in b.column(1).to_pylist():
                d = Measured(t)
                stays = cascade.verdict(d) is None  # stops at the first rule that rejects; the columns below ask for the rest
                rows.append((*(getattr(d, c) for c in _COLUMNS), not stays and any(r.rejects(d) for r in base), stays))
            yield common.batch(schema, b.column(0), *zip(*rows))

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, OUT)


def kept(df: DataFrame, cascade: Cascade | None = None) -> DataFrame:
    """The rows of df, all columns as they are, that no rule rejects.  Short-circuits: measurements are taken as rules ask."""
    cascade = cascade or fitted(df)
    at = df.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.small(batches):
            stays = [cascade.verdict(Measured(t or "")) is None for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(stays, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def oracle_sql() -> str:
    """SQL for :func:`measured` with the production rules, over documents of distinct ids."""
    blank = r"[^\x20\x09-\x0D]"
    count = lambda what: f"length(regexp_replace(text, '[^{what}]', '', 'g'))"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, text, regexp_extract_all(text, '{blank}+') AS w FROM docs),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + {WINDOW - 1}], ' ')) AS n FROM places WHERE i + {WINDOW - 1} <= len(w)),
again AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM windows, (SELECT unnest(range({WINDOW})) AS k) WHERE n > 1 GROUP BY doc_id),
per_word AS (SELECT doc_id, sum(length(w[i])) AS word_chars, count(*) FILTER (w[i] = w[i + 1]) AS n_stutters FROM places GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{blank}') GROUP BY doc_id),
m AS (SELECT doc_id, len(w) AS n_words, coalesce(word_chars, 0) AS word_chars, {count('#*$%&|<>')} AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_stutters, 0) AS n_stutters, {count('!')} AS n_bangs, {count('A-Z')} AS n_capitals, {count('a-z')} AS n_small
  FROM words LEFT JOIN again USING (doc_id) LEFT JOIN per_word USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words OR 10 * n_symbols > 3 * n_words OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words
    OR n_lines >= 4 AND 10 * n_dup_lines > 6 * n_lines OR 10 * n_stutters > 3 * n_words OR 2 * n_capitals > n_small + n_capitals AND 3 * n_bangs > n_words) AS kept
FROM m"""


def rule_report(df: DataFrame, cascade: Cascade | None = None) -> list[tuple[str, float, float]]:
    """(rule, cost in seconds, share rejected) in the order of the cascade."""
    c = cascade or fitted(df)
    return [(r.name, c.cost.get(r.name, 0.0), c.share.get(r.name, 0.0)) for r in c.rules]
