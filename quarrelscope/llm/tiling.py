"""Benchmark decontamination by greedy string tiling (operator 1).

Texts are word tokens (letters, digits, underscore; lower case).  Every MIN_MATCH
consecutive tokens of a benchmark item are a seed.  A document's rolling token hashes
are joined with the seeds; shared seeds on one diagonal merge to maximal matches
(Karp-Rabin hashes propose, tokens confirm).  Tiling then repeatedly takes the longest
match whose tokens are unmarked in item and document, marks both sides, and goes on
with what is left of the matches it cut, until none of MIN_MATCH tokens remains.  An
item leaks into a document when its marked share reaches THRESHOLD, in whatever order
the passages stand.

The benchmark is the query set: it is read in blocks of at most BLOCK_CHARS
characters, each broadcast within that bound and run against all documents, so
neither side has to fit anywhere as a whole.

Edge cases: null texts are empty and never leak; items without tokens match nothing;
items shorter than MIN_MATCH tokens have to stand as a whole; repeated items and
repeated documents are reported row by row, null ids as null; ties of equally long
matches fall to the earlier place in the item, then in the document; texts of any length
are read whole, in blocks of SEED_PAIRS meetings; an empty table on either side gives no
leak; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MIN_MATCH, THRESHOLD = 5, 0.5
BLOCK_CHARS = 16_000_000
_TOKENS = re.compile(r"\w+").findall
#: So many pairs of a document's place and an item's are looked at together.
SEED_PAIRS = 1 << 20


def tokens(text: str) -> list[str]:
    return _TOKENS(text.lower())


class Tile(NamedTuple):
    item: int
    document: int
    length: int


def window_hashes(code: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of length tokens; code: token numbers."""
    n = len(code) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        value = common.splitmix(np.arange(int(code.max()) + 1, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15))[code]
        odd = common.splitmix(np.arange(1, length + 1, dtype=np.uint64)) | np.uint64(1)
        h = np.zeros(n, np.uint64)
        for k in range(length):
            h += value[k : k + n] * odd[k]
    return h


def tile(matches: list[tuple[int, int, int]], n_item: int, min_match: int) -> list[Tile]:
    """Greedy tiling over maximal matches (item start, document start, length)."""
    heap = [(-n, i, d) for i, d, n in matches]
    heapq.heapify(heap)
    in_item: set[int] = set()
    in_doc: set[int] = set()
    out: list[Tile] = []
    while heap and len(in_item) < n_item:
        n, i, d = heapq.heappop(heap)
        n = -n
        run = 0
        parts = []
        for k in range(n + 1):
            if k < n and i + k not in in_item and d + k not in in_doc:
                run += 1
            else:
                if run >= min_match:
                    parts.append((k - run, run))
                run = 0
        if parts == [(0, n)]:
            out.append(Tile(i, d, n))
            in_item.update(range(i, i + n))
            in_doc.update(range(d, d + n))
        else:
            for s, m in parts:
                heapq.heappush(heap, (-m, i + s, d + s))
    return out


def _runs(item: np.ndarray, diagonal: np.ndarray, place: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of an item's places on one diagonal; each run that ends where another begins is joined with it."""
    order = np.lexsort((place, diagonal, item))
    item, diagonal, place, size = item[order], diagonal[order], place[order], size[order]
    new = np.ones(len(item), bool)
    new[1:] = (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + size[:-1])
    first = np.flatnonzero(new)
    return item[first], diagonal[first], place[first], np.add.reduceat(size, first) if len(first) else size


class Benchmark:
    """Seeds of a block of items, ready to meet documents."""

    def __init__(self, items: list[tuple[int, str]], min_match: int = MIN_MATCH):
        self.vocabulary: dict[str, int] = {}
        self.ids, self.codes = [], []
        for item_id, text in items:
            words = tokens(text or "")
            if words:
                self.ids.append(item_id)
                self.codes.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64))
        self.least = [min(min_match, len(c)) for c in self.codes]
        self.seeds = {}  # by seed length: sorted hashes, items, places, and a bit map that rejects most others at once
        for length in sorted(set(self.least)):
            own = [k for k, n in enumerate(self.least) if n == length]
            h = [window_hashes(self.codes[k], length) for k in own]
            item = np.repeat(own, [len(x) for x in h])
            place = np.concatenate([np.arange(len(x)) for x in h])
            h = np.concatenate(h)
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << 20, bool)
            bits[h >> np.uint64(44)] = True
            self.seeds[length] = (h[order], item[order], place[order], bits)

    def touched(self, texts: list[str]) -> list[int]:
        """Places of the texts that share a seed with an item: one pass of rolling hashes over all their tokens."""
        words = [tokens(t) for t in texts]
        ends = np.cumsum([len(w) + 1 for w in words])
        code = np.fromiter(map(self.vocabulary.get, chain.from_iterable((*w, "") for w in words), repeat(0)), np.int64, int(ends[-1]) if len(ends) else 0)
        out: set[int] = set()
        for length, (seeds, _, _, bits) in self.seeds.items():
            h = window_hashes(code, length)
            at = np.flatnonzero(bits[h >> np.uint64(44)]) if len(h) else h
            if len(at):
                near = np.searchsorted(seeds, h[at])
                at = at[seeds[np.minimum(near, len(seeds) - 1)] == h[at]]
                out.update(np.searchsorted(ends, at, "right").tolist())
        return sorted(out)

    def matches(self, text: str) -> dict[int, list[tuple[int, int, int]]]:
        """Maximal matches of each item that shares a seed with the text."""
        get = self.vocabulary.get
        words = tokens(text)
        code = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        found: dict[int, list[tuple[int, int, int]]] = {}
        for length, (seeds, items, places, bits) in self.seeds.items():
            h = window_hashes(code, length)
            at = np.flatnonzero(bits[h >> np.uint64(44)]) if len(h) else h
            if not len(at):
                continue
            lo, hi = np.searchsorted(seeds, h[at], "left"), np.searchsorted(seeds, h[at], "right")
            until = np.cumsum(hi - lo)
            if not until[-1]:
                continue
            runs, s = [], 0
            while s < len(at):  # a block of places, so that memory is bounded where a text and an item repeat one seed
                e = max(s + 1, int(np.searchsorted(until, (until[s - 1] if s else 0) + SEED_PAIRS, "right")))
                n = (hi - lo)[s:e]
                seed = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[s:e], n)
                runs.append(_runs(items[seed], np.repeat(at[s:e], n) - places[seed], places[seed], np.ones(len(seed), np.int64)))
                s = e
            for k, diagonal, i, size in np.stack(_runs(*map(np.concatenate, zip(*runs))), axis=1).tolist():
                d, size = i + diagonal, size + length - 1
                if np.array_equal(self.codes[k][i : i + size], code[d : d + size]):
                    found.setdefault(k, []).append((i, d, size))
        return found

    def leaks(self, text: str, threshold: float = THRESHOLD) -> Iterator[tuple[int, int, list[Tile]]]:
        """(item id, item tokens, tiles) of each item that the text covers up to the threshold."""
        for k, found in sorted(self.matches(text).items()):
            n = len(self.codes[k])
            touched = np.zeros(n, bool)
            for i, _, size in found:
                touched[i : i + size] = True
            if touched.sum() < threshold * n:  # no tiling can cover more
                continue
            tiles = tile(found, n, self.least[k])
            if sum(t.length for t in tiles) >= threshold * n:
                yield self.ids[k], n, tiles


OUT = "doc_id bigint, _h bigint, item_id bigint, item_tokens bigint, matched_tokens bigint, n_tiles bigint, coverage double, tiles array<struct<item:bigint,document:bigint,length:bigint>>"


def leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each document and item of which it holds at least the threshold."""
    found = _leaks(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.lit(0).cast("bigint").alias("_h")), benchmark, min_match, threshold, block_chars)
    return found.drop("_h")


def _leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, threshold: float = THRESHOLD, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The leaks of docs (doc_id, text, _h), with _h."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-int(chars) * 2 // block_chars))
    out = None
    for k in range(n_blocks):
        block = items if n_blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k)
        shared = spark.sparkContext.broadcast([(r.item_id, r.text) for r in block.collect()])

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items, long = Benchmark(shared.value, min_match), pa.int64()
            tile_ = pa.struct([("item", long), ("document", long), ("length", long)])
            schema = pa.schema([("doc_id", long), ("_h", long), ("item_id", long), ("item_tokens", long), ("matched_tokens", long), ("n_tiles", long), ("coverage", pa.float64()), ("tiles", pa.list_(tile_))])
            for b in common.small(batches, 2048):
                rows = []
                ids, texts, hashes = b.column(0), b.column(1).to_pylist(), b.column(2)
                for k in items.touched(texts):
                    for item_id, n, tiles in items.leaks(texts[k], threshold):
                        matched = sum(t.length for t in tiles)
                        rows.append((ids[k].as_py(), hashes[k].as_py(), item_id, n, matched, len(tiles), matched / n, [t._asdict() for t in tiles]))
                if rows:
                    yield common.batch(schema, *zip(*rows))

        part = docs.mapInArrow(run, OUT)
        out = part if out is None else out.unionByName(part)
    return out


def kept(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs into which no benchmark item leaks, with all columns as they are.

    Rows that share an id are judged by their own texts; repeated rows all stay or all go.
    """
    bad = _leaks(common.documents(docs), benchmark, **options).select("doc_id", "_h").distinct()
    return common.identified(docs).join(bad, ["doc_id", "_h"], "left_anti").select("row.*")
