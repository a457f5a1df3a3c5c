"""SimHash near-duplicates with pivot distance tables (operator 8).

A document's fingerprint has a bit set where over half of its word shingles' XXH64
values have it set.  Equal fingerprints collapse first, so groups of copies count
once.  Two fingerprints link at MAX_BITS or fewer differing bits.

Pivot tables alone can't be an index of bounded cost: Hamming distances to any
reference crowd around 32, so one coordinate keeps about half of all pairs.  Pairs are
therefore met in buckets first -- MAX_BITS differing bits leave at least one of
MAX_BITS + 1 blocks equal, so no link is lost -- and where there are many
fingerprints each bucket is cut by a second level of the same rule over its other
bits.  Inside a bucket the precomputed distances to PIVOTS reference fingerprints do
the pruning: the bucket is sorted by the first coordinate, each fingerprint meets
the window within MAX_BITS of it, pairs with a larger difference in any coordinate
are discarded (triangle inequality), and the survivors are verified bit by bit.
A bucket's links go out as a forest, never as all pairs of a group; a bucket of more than
BUCKET fingerprints is cut into blocks, of which every two are one task's work.

Edge cases: null or empty texts have fingerprint zero, which links like any other;
texts of fewer words than a shingle are one shingle; texts of any length are taken whole;
a bit set in just half the hashes (a tie) is 0; repeated rows share their fingerprint; an
empty table gives an empty result; a null id stays null and counts as the smallest; other
columns are not looked at, or kept as they are by :func:`kept`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

SHINGLE, SEED, MAX_BITS, BITS = 3, 42, 3, 64
PIVOTS = 24
#: From this many distinct fingerprints, buckets have two levels (28 bits instead of 16).
TWO_LEVELS_FROM = 2_000_000
_PIVOTS = np.random.default_rng(8).integers(0, 2**63, PIVOTS, dtype=np.uint64) * np.uint64(2) + np.random.default_rng(80).integers(0, 2, PIVOTS, dtype=np.uint64)
WINDOW_PAIRS = 1 << 20
#: A bucket of more fingerprints is cut into blocks, of which every two meet in a task of their own.
BUCKET = 4096


def shingle_hashes(text: str, shingle: int) -> np.ndarray:
    """XXH64 of each shingle; fewer words are one shingle."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes.lower changes A-Z only; bytes.split cuts at the six ASCII spaces
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(n + 1) - 1
    starts = (ends - n)[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, len(starts))


def majority(h: np.ndarray) -> int:
    """Bits that are set in over half the hashes."""
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 255):  # sums of so many bits fit a byte, which is many times as fast
        bits = np.unpackbits(h[at : at + 255].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(2 * count > len(h)).tobytes(), "big")


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    h = shingle_hashes(text, shingle)
    return majority(h) if len(h) else 0


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(df: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row of :func:`common.documents`; fp as a signed bigint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])
        for b in common.small(batches, 4096):
            yield common.batch(schema, b.column(0), [signed(fingerprint(t, shingle)) for t in b.column(1).to_pylist()])

    return df.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


def _blocks(width: int, n: int) -> list[tuple[int, int]]:
    cuts = [width * k // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def bucket_keys(fp: np.ndarray, levels: int, max_bits: int = MAX_BITS) -> list[np.ndarray]:
    """Bucket keys of each fingerprint, an array for each way to choose blocks."""
    out = []
    full = (1 << BITS) - 1
    for i, (s, e) in enumerate(_blocks(BITS, max_bits + 1)):
        mask = ((1 << (e - s)) - 1) << s
        if levels == 1:
            out.append(common.splitmix((fp & np.uint64(mask)) ^ np.uint64((i + 1) << s if s else 0)) ^ np.uint64(i))
            continue
        other = [b for b in range(BITS) if not s <= b < e]
        for j, (s2, e2) in enumerate(_blocks(len(other), max_bits + 1)):
            m = mask | sum(1 << b for b in other[s2:e2])
            assert m & full == m
            out.append(common.splitmix(fp & np.uint64(m)) ^ np.uint64(i * (max_bits + 1) + j))
    return out


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """Hamming distances of each fingerprint (row) to each pivot."""
    return np.stack([np.bitwise_count(fp ^ p) for p in _PIVOTS], axis=1)


class Forest:
    """Union-find over a bucket's places, with the smaller place as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _pairs_near(table: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows (x < y) of a pivot table, sorted by its first column, that no column tells more than max_bits apart."""
    n, at = len(table), 0
    width = np.searchsorted(table[:, 0], table[:, 0] + max_bits, "right") - np.arange(n) - 1
    until = np.cumsum(width)
    while at < n:
        upto = min(n, max(at + 1, int(np.searchsorted(until, (until[at - 1] if at else 0) + WINDOW_PAIRS, "right"))))
        w = width[at:upto]
        x = np.repeat(np.arange(at, upto), w)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(w) - w, w)
        for k in range(1, table.shape[1]):
            if not len(x):
                break
            near = np.abs(table[x, k] - table[y, k]) <= max_bits
            x, y = x[near], y[near]
        yield x, y
        at = upto


def bucket_links(fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links among a bucket's distinct fingerprints: (fingerprint, root)."""
    n = len(fp)
    table = pivot_table(fp)
    order = np.argsort(table[:, 0], kind="stable")
    fp, table = fp[order], table[order].astype(np.int16)
    trees = Forest(n)
    for x, y in _pairs_near(table, max_bits):
        close = np.bitwise_count(fp[x] ^ fp[y]) <= max_bits
        for p, q in zip(x[close].tolist(), y[close].tolist()):
            trees.join(p, q)
    root = np.array([trees.root(k) for k in range(n)])
    moved = np.flatnonzero(root != np.arange(n))
    return fp[moved], fp[root[moved]]


def _met(batches: Iterator[pa.RecordBatch], solve, empty) -> Iterator:
    """solve(items) for each task's group of two distinct items or more, from batches (task, item) sorted by task."""
    for _, parts in common.row_groups(batches, "task"):
        if sum(b.num_rows for b in parts) > 1:
            items = empty(parts)
            if len(items) > 1:
                yield solve(items)


def links(distinct: DataFrame, levels: int = 1, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) among distinct fingerprints (column fp) whose components are those of all links."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("bucket", pa.int64()), ("fp", pa.int64())])
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for keys in bucket_keys(fp, levels, max_bits):
                yield common.batch(schema, keys.view(np.int64), fp.view(np.int64))

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        prints = lambda parts: np.unique(np.concatenate([b.column(1).to_numpy() for b in parts])).view(np.uint64)
        for a, b in _met(batches, lambda fp: bucket_links(fp, max_bits), prints):
            if len(a):
                yield common.batch(schema, a.view(np.int64), b.view(np.int64))

    keys = distinct.select("fp").mapInArrow(keyed, "bucket bigint, fp bigint")
    return _by_task(keys, "fp").mapInArrow(met, "a bigint, b bigint").distinct()


def _by_task(keys: DataFrame, item: str) -> DataFrame:
    """(task, item) of (bucket, item), dealt and sorted by task; a large bucket is many tasks' work."""
    keys = common.written(keys, "buckets")
    tasks = common.bounded_groups(keys, "bucket", item, BUCKET).select("task", item)
    return tasks.repartition(common.n_shards(keys), "task").sortWithinPartitions("task")


def grouped(df: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of df (doc_id, text)."""
    prints = common.written(fingerprints(common.documents(df), shingle), "fingerprints")
    distinct = common.written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct-fingerprints")
    levels = 2 if distinct.count() >= TWO_LEVELS_FROM else 1
    roots = components(links(distinct, levels, max_bits)).withColumnsRenamed({"node": "fp"})
    # the smallest document of each component of fingerprints
    moved = distinct.join(roots, "fp")
    least = moved.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.written(moved.join(least, "root").select("fp", "component_id"), "groups")
    label = distinct.join(named, "fp", "left").select("fp", "n", F.coalesce("component_id", "least").alias("component_id"))
    return common.joined(prints, label, "fp", "n", prints.count()).select("doc_id", "fp", "component_id")


def report(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id."""
    return grouped(df).select(common.public_id(), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), common.public_id("component_id"))


# A wide form for similarities that 64 bits and a few differing ones can't tell.

#: Texts are near-duplicates when at least 0.8 of their fingerprint bits agree.
WIDE_SHINGLE, WIDE_WORDS, WIDE_SIMILARITY = 5, 4, 0.8
WIDE_BITS = int(64 * WIDE_WORDS * (1 - WIDE_SIMILARITY))
#: Of WIDE_BANDS buckets, texts of Jaccard similarity 0.8 share none with probability 0.00005, (1 - 0.8 ** 3) ** 14.
WIDE_BANDS, WIDE_ROWS = 14, 3
_ODD = np.random.default_rng(14).integers(1, 2**63, WIDE_BANDS * WIDE_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = common.splitmix(np.arange(1, WIDE_WORDS + 1, dtype=np.uint64))


def wide_fingerprint(text: str, shingle: int = WIDE_SHINGLE) -> tuple[list[int], list[int]]:
    """(fingerprint words, bucket keys), signed; of the set of shingles."""
    h = np.unique(shingle_hashes(text, shingle))
    if not len(h):
        return [0] * WIDE_WORDS, [0] * WIDE_BANDS
    count, least = np.zeros(64 * WIDE_WORDS, np.int64), np.full(len(_ODD), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(h), 255):  # sums of so many bits fit a byte, which is many times as fast
            some = h[at : at + 255]
            bits = np.unpackbits(common.splitmix(some[:, None] ^ _SALTS).astype(">u8").view(np.uint8), axis=1)
            count += bits.sum(axis=0, dtype=np.uint8)
            least = np.minimum(least, (some * _ODD[:, None]).min(axis=1))
        words = np.packbits(2 * count > len(h)).view(">u8").astype(np.int64)
        key = np.arange(WIDE_BANDS, dtype=np.uint64)
        for k in range(WIDE_ROWS):
            key = common.splitmix(key ^ least[k::WIDE_ROWS]) + np.uint64(k)
    return words.tolist(), key.view(np.int64).tolist()


def _distances(fp: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp ^ other).sum(axis=-1, dtype=np.int16)


def wide_bucket_links(fp: np.ndarray, max_bits: int = WIDE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(place, root): a forest of all links among a bucket's distinct wide fingerprints.

    Random references tell nothing at this distance (every coordinate is near 128, give or
    take 8), so the references are fingerprints of the bucket, each farther than max_bits
    from those before it.  What lies within max_bits of one is linked to it at once; of the
    pairs in different trees those that a coordinate tells apart are discarded, and the
    others verified.
    """
    n = len(fp)
    trees, free, table = Forest(n), np.ones(n, bool), []
    while free.any() and len(table) < PIVOTS:
        p = int(np.argmax(free))
        table.append(_distances(fp, fp[p]))
        near = table[-1] <= max_bits
        for x in np.flatnonzero(near).tolist():
            trees.join(p, x)
        free &= ~near
    root = np.array([trees.root(k) for k in range(n)])
    order = np.argsort(table[0], kind="stable")
    for x, y in _pairs_near(np.stack(table, axis=1)[order], max_bits):
        x, y = order[x], order[y]
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        for at in range(0, len(x), WINDOW_PAIRS // 4):
            some, other = x[at : at + WINDOW_PAIRS // 4], y[at : at + WINDOW_PAIRS // 4]
            close = _distances(fp[some], fp[other]) <= max_bits
            for p, q in zip(some[close].tolist(), other[close].tolist()):
                trees.join(p, q)
    root = np.array([trees.root(k) for k in range(n)])
    moved = np.flatnonzero(root != np.arange(n))
    return moved, root[moved]


def wide_links(distinct: DataFrame, max_bits: int = WIDE_BITS) -> DataFrame:
    """Links (a, b) among distinct wide fingerprints, from (fp, keys)."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])
        prints = lambda parts: sorted({x for b in parts for x in b.column(1).to_pylist()})

        def solve(fp: list[bytes]) -> tuple[list, list]:
            x, y = wide_bucket_links(np.frombuffer(b"".join(fp), np.uint64).reshape(-1, WIDE_WORDS), max_bits)
            return [fp[k] for k in x.tolist()], [fp[k] for k in y.tolist()]

        for a, b in _met(batches, solve, prints):
            if a:
                yield common.batch(schema, a, b)

    rows = distinct.select(F.explode("keys").alias("bucket"), "fp")
    return _by_task(rows, "fp").mapInArrow(met, "a binary, b binary").distinct()


def wide_grouped(df: DataFrame, shingle: int = WIDE_SHINGLE, max_bits: int = WIDE_BITS) -> DataFrame:
    """(doc_id, _h, lead): every row's group, named by its first document, the struct (doc_id, _h) of smallest id.

    Rows are told apart as :func:`common.documents` does, by id and text.  Texts whose
    wide fingerprints agree in WIDE_SIMILARITY of the bits link, and linked ones form a
    group.  For sets of shingles of Jaccard similarity s, a bit differs with probability
    acos(2s / (1 + s)) / pi: on average 39 of 256 bits at 0.8, 51 at 0.71, 81 at 0.3, 128
    for unrelated texts.  Texts meet in WIDE_BANDS buckets of WIDE_ROWS least hashes each,
    which blocks of bits can't replace at this distance; inside a bucket see
    :func:`wide_bucket_links`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.list_(pa.int64())
        schema = pa.schema([("doc_id", pa.int64()), ("_h", pa.int64()), ("fp", pa.binary()), ("keys", words)])
        for b in common.small(batches, 2048):
            fp, keys = zip(*(wide_fingerprint(t, shingle) for t in b.column(1).to_pylist()))
            yield common.batch(schema, b.column(0), b.column(2), [np.array(x, np.int64).tobytes() for x in fp], keys)

    prints = common.documents(df).mapInArrow(run, "doc_id bigint, _h bigint, fp binary, keys array<bigint>")
    prints = common.written(prints, "fingerprints")
    one = F.min(F.struct("doc_id", "_h"))
    distinct = common.written(prints.groupBy("fp").agg(one.alias("least"), F.min("keys").alias("keys"), F.count("*").alias("n")), "distinct-fingerprints")
    roots = common.written(components(wide_links(distinct, max_bits)).withColumnRenamed("node", "fp"), "fingerprint-roots")
    moved = roots.join(distinct.select("fp", "least"), "fp")
    lead = common.written(moved.groupBy("root").agg(F.min("least").alias("lead"), F.count("*").alias("n")), "leads")
    named = common.joined(roots, lead, "root", "n", roots.count()).select("fp", "lead")
    label = distinct.join(named, "fp", "left").select("fp", "n", F.coalesce("lead", "least").alias("lead"))
    return common.joined(prints.select("doc_id", "_h", "fp"), label, "fp", "n", prints.count()).select("doc_id", "_h", "lead")


def kept(df: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """The rows of df of which one document of each group stays, with all columns as they are.

    groups: (doc_id, _h, lead) as :func:`wide_grouped` (the default) gives them.  The first
    document stays: smallest id (a null id before all others), then smallest hash of the
    text.  Rows that share an id but no group all stay; of rows that repeat an id and a
    text, one stays.  Texts without words are one group.
    """
    groups = wide_grouped(df) if groups is None else groups
    lead = groups.select("lead.doc_id", "lead._h").distinct()
    return common.identified(df).join(lead, ["doc_id", "_h"], "left_semi").dropDuplicates(["doc_id", "_h"]).select("row.*")
