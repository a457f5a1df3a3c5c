"""Near-duplicate lines by a segment-partition edit join (operator 4).

Lines (split at line feeds) of at least MIN_CHARS code points link when their edit
distance is at most MAX_EDITS.  Such a line is cut into MAX_EDITS + 1 segments; two
linked lines share one of them at nearly the same place.  Every distinct line posts
its own segments, and for each length that a partner may have it probes the
substrings that the multi-match-aware windows allow.  Postings and probes travel as
arrays, dealt by key; where they meet, a character-count signature discards most
false pairs, and the rest are verified by banded bit-parallel edit distance on the
lines themselves.  Linked lines form classes (connected components); shorter lines
and lines without a link are classes of their own, by equality.

Removed are, of each class, the later lines of one document, and, when the class
stands in several documents, all lines in documents but the first: in two or more for
lines of MIN_CHARS or more, in at least MIN_DOCS for shorter ones.  Blank lines always
stay.

Nothing is capped: a frequent segment's lines are sorted by signature and compared in
blocks.  Copies of a line count once before the shuffle.  A task may get several shards
of keys and holds one at a time.

Edge cases: null text is one empty line and stays null where lines are cut; an empty table
gives an empty result; rows that repeat a document in full count as that document; rows
that share an id only are kept apart, the one of lesser text hash being the earlier; a
null id sorts first and comes back as null; texts and lines of any length are taken whole;
a class is named by its least line hash, and of several lines of one document the first
stays (there are no other ties); other columns stay as they are, whatever they are called.
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

MAX_EDITS, MIN_CHARS, MIN_DOCS = 2, 24, 5
#: Up to so many candidate lines (8 bytes each) are broadcast to fetch their texts; more are joined.
BROADCAST_LINES = 500_000
FLUSH_ROWS, PAIRS, SEEN = 800_000, 1 << 19, 500_000
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n + 1:
        size = max(1 << 21, n + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def within(a: str, b: str, k: int = MAX_EDITS) -> int | None:
    """The edit distance of a and b if it is at most k, else None.

    After equal ends are cut off, one bit vector of 2k + 1 bits holds the band of
    vertical differences and slides down the diagonal, a row for each character of b.
    """
    if abs(len(a) - len(b)) > k:
        return None
    if a == b:
        return 0
    s, n = 0, min(len(a), len(b))
    step = 1 << max(0, n.bit_length() - 1)
    while step:  # the longest common beginning, by halving
        if s + step <= n and a[s : s + step] == b[s : s + step]:
            s += step
        step >>= 1
    a, b = a[s:], b[s:]
    e, n = 0, min(len(a), len(b))
    step = 1 << max(0, n.bit_length() - 1) if n else 0
    while step:
        if e + step <= n and a[len(a) - e - step : len(a) - e] == b[len(b) - e - step : len(b) - e]:
            e += step
        step >>= 1
    a, b = a[: len(a) - e], b[: len(b) - e]
    m, n = len(a), len(b)
    if not m or not n:
        return max(m, n) if max(m, n) <= k else None
    width = 2 * k + 1
    full = (1 << width) - 1
    # bit t of a vector in column j stands for row j - k + t (rows from 1); rows outside 1..m match nothing
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + k)
    # vertical differences of column 0: +1 for rows from 1 on
    plus, minus = full >> k << k, 0
    score = min(k, m)  # of the band's lowest row, j + k, or of row m
    bottom = 1 << (width - 1)
    for j in range(n):
        # band of column j + 1, whose bit t is row j + 1 - k + t
        match = where.get(b[j], 0) >> j & full
        diagonal = ((((match & plus) + plus) ^ plus) | match | minus) & full
        h_plus = minus | ~(diagonal | plus) & full
        h_minus = diagonal & plus
        if j + k < m:  # the lowest row steps down the diagonal
            score += not diagonal & bottom
        else:  # it has reached row m, which stands t bits lower in each column
            t = m - 1 - j + k
            score += (h_plus >> t & 1) - (h_minus >> t & 1)
        if score > 2 * k + n - m:
            return None
        plus = (h_minus | ~((diagonal >> 1) | h_plus)) & full
        minus = (diagonal >> 1) & h_plus
    return score if score <= k else None


def signature(classes: np.ndarray, line: np.ndarray, n: int) -> np.ndarray:
    """Counts of 8 classes of characters by line, 255 at most, as one row of 8 bytes."""
    return np.minimum(np.bincount(line * 8 + classes, minlength=8 * n), 255).astype(np.uint8).reshape(n, 8)


def segments(length: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(start, size) of each of the k + 1 segments of lines so long."""
    parts = k + 1
    small, extra = length // parts, length % parts
    out, start = [], np.zeros_like(length)
    for i in range(parts):
        size = small + (i >= parts - extra)
        out.append((start, size))
        start = start + size
    return out


def postings(lines: list[str], k: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, role, signature by line): role 1 is a posted segment, 2 a probe, 3 both."""
    code = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, lines), np.int64, len(lines))
    start = np.cumsum(length) - length
    up, down = _power_table(len(code))
    with np.errstate(over="ignore"):
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) * up[: len(code)], out=total[1:])
        keys, who, roles = [], [], []
        every = np.arange(len(lines))
        for shorter in range(k + 1):  # partners are so many characters shorter
            fit = every[length - shorter >= min_chars]
            partner = length[fit] - shorter
            for i, (p, size) in enumerate(segments(partner, k)):
                lo, hi = max(-i, shorter - (k - i)), min(i, shorter + (k - i))
                for shift in range(lo, hi + 1):
                    at = p + shift
                    ok = (at >= 0) & (at + size <= length[fit])
                    a = start[fit[ok]] + at[ok]
                    h = (total[a + size[ok]] - total[a]) * down[a]
                    keys.append(common.splitmix(h ^ common.splitmix(partner[ok].astype(np.uint64) * np.uint64(16) + np.uint64(i))))
                    who.append(fit[ok])
                    roles.append(np.full(len(a), 3 if not shorter and not shift else 2, np.uint8))
    sig = signature((code & 7).astype(np.int64), np.repeat(every, length), len(lines))
    return np.concatenate(keys), np.concatenate(who), np.concatenate(roles), sig


def meetings(key: np.ndarray, line: np.ndarray, role: np.ndarray, sig: np.ndarray, k: int = MAX_EDITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of different lines that share a key in fitting roles and whose signatures allow k edits."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    many = np.zeros(len(key), bool)
    many[1:] |= same
    many[:-1] |= same
    order = order[many]
    if not len(order):
        return
    group = np.cumsum(np.concatenate([[0], key[many][1:] != key[many][:-1]]))
    line, role, sig = line[order], role[order], sig[order]
    rank = group * 1024 + sig[:, 0]
    order = np.argsort(rank, kind="stable")
    line, role, sig, rank = line[order], role[order], sig[order].astype(np.int16), rank[order]
    width = np.searchsorted(rank, rank + k, "right") - np.arange(len(rank)) - 1
    until, at = np.cumsum(width), 0
    while at < len(rank):
        before = int(until[at - 1]) if at else 0
        upto = min(len(rank), max(at + 1, int(np.searchsorted(until, before + PAIRS, "right"))))
        w = width[at:upto]
        x = np.repeat(np.arange(at, upto), w)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(w) - w, w)
        fits = (((role[x] & 1) & (role[y] >> 1)) | ((role[y] & 1) & (role[x] >> 1))).astype(bool) & (line[x] != line[y])
        x, y = x[fits], y[fits]
        if len(x):
            off = np.abs(sig[x] - sig[y])
            near = (off.max(axis=1) <= k) & (off.sum(axis=1) <= 2 * k)
            if near.any():
                yield line[x[near]], line[y[near]]
        at = upto


def _line_id(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def candidates(docs: DataFrame, k: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b): short line ids (the first 8 bytes of a line's id) of pairs to verify."""
    shards = common.n_shards(docs)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("n", pa.int32()), ("rows", pa.binary())])
        seen: set[bytes] = set()  # by the whole id; lines that share its beginning both post
        held, rows = [], 0

        def flushed() -> Iterator[pa.RecordBatch]:
            key, line, role, sig = (np.concatenate(x) for x in zip(*held))
            shard = (key % np.uint64(shards)).astype(np.int32)
            order = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[order], np.arange(shards + 1))
            each = ((s, order[cuts[s] : cuts[s + 1]]) for s in range(shards) if cuts[s] < cuts[s + 1])
            yield from common.blobs(schema, ((s, len(at), key[at].tobytes() + line[at].tobytes() + sig[at].tobytes() + role[at].tobytes()) for s, at in each))

        for b in common.small(batches, 4096, 2 << 20):
            new: list[str] = []
            ids: list[bytes] = []
            for text in b.column(0).to_pylist():
                for line in text.split("\n"):
                    if len(line) >= min_chars:
                        x = _line_id(line)
                        if x not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(x)
                            new.append(line)
                            ids.append(x[:8])
            if new:
                key, who, role, sig = postings(new, k, min_chars)
                held.append((key, np.frombuffer(b"".join(ids), "<i8")[who], role, sig[who]))
                rows += len(key)
                if rows >= FLUSH_ROWS:
                    yield from flushed()
                    held, rows = [], 0
        if held:
            yield from flushed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for _, blobs in common.row_groups(batches, "shard"):
            own = []
            for b in blobs:
                for n, raw in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    raw = np.frombuffer(raw, np.uint8)
                    own.append((raw[: 8 * n].view(np.uint64), raw[8 * n : 16 * n].view(np.int64), raw[24 * n :], raw[16 * n : 24 * n].reshape(n, 8)))
            key, line, role, sig = (np.concatenate(x) for x in zip(*own))
            del own, blobs
            for a, c in meetings(key, line, role, sig, k):
                both = np.unique(np.stack([np.minimum(a, c), np.maximum(a, c)], axis=1), axis=0)
                yield common.batch(schema, np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1]))

    posted = docs.select("text").mapInArrow(post, "shard int, n int, rows binary")
    return common.dealt(posted).mapInArrow(meet, "a bigint, b bigint").distinct()


def verified(docs: DataFrame, pairs: DataFrame, k: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, edits): full line ids of linked lines."""
    ids = common.written(pairs.select(F.col("a").alias("short")).unionByName(pairs.select(F.col("b").alias("short"))).distinct(), "line-ids")
    wanted = None
    if ids.count() <= BROADCAST_LINES:
        wanted = docs.sparkSession.sparkContext.broadcast({r.short for r in ids.collect()})

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("short", pa.int64()), ("full", pa.binary()), ("line", pa.string())])
        some, seen = wanted.value if wanted is not None else None, set()
        for b in common.small(batches, 4096):
            rows = []
            for text in b.column(0).to_pylist():
                for line in text.split("\n"):
                    if len(line) >= min_chars:
                        full = _line_id(line)
                        short = int.from_bytes(full[:8], "little", signed=True)
                        if (some is None or short in some) and full not in seen:
                            if len(seen) >= SEEN:
                                seen.clear()
                            seen.add(full)
                            rows.append((short, full, line))
            if rows:
                yield common.batch(schema, *zip(*rows))

    found = docs.select("text").mapInArrow(fetch, "short bigint, full binary, line string")
    if wanted is None:
        found = found.join(ids, "short", "left_semi")
    found = common.written(found.groupBy("short", "full").agg(F.min("line").alias("line")), "line-texts")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("edits", pa.int32())])
        for b in batches:
            rows = []
            for a, x, c, y in zip(*(b.column(n).to_pylist() for n in ("full_a", "line_a", "full_b", "line_b"))):
                d = within(x, y, k)
                if d is not None and a != c:
                    rows.append((max(a, c), min(a, c), d))
            if rows:
                yield common.batch(schema, *zip(*rows))

    side = lambda s: found.select(F.col("short").alias(s), F.col("full").alias(f"full_{s}"), F.col("line").alias(f"line_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("full_a", "line_a", "full_b", "line_b").mapInArrow(verify, "a binary, b binary, edits int").distinct()


def occurrences(docs: DataFrame) -> DataFrame:
    """(full, doc_id, _h, line_no, size) of every line that isn't blank; line numbers from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("full", pa.binary()), ("doc_id", pa.int64()), ("_h", pa.int64()), ("line_no", pa.int32()), ("size", pa.int32())])
        for b in common.small(batches, 2048):
            rows = []
            for doc_id, text, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                for n, line in enumerate(text.split("\n")):
                    if line.strip():
                        rows.append((_line_id(line), doc_id, h, n, len(line)))
            if rows:
                yield common.batch(schema, *zip(*rows))

    return docs.select("doc_id", "text", "_h").mapInArrow(run, "full binary, doc_id bigint, _h bigint, line_no int, size int")


def classes(df: DataFrame, k: int = MAX_EDITS, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """Linked lines (full, root, n_links), and the links themselves (a, b, edits)."""
    docs = common.documents(df)
    pairs = common.written(candidates(docs, k, min_chars), "line-pairs")
    linked = common.written(verified(docs, pairs, k, min_chars), "line-links")
    roots = components(linked.select("a", "b")).withColumnsRenamed({"node": "full"})
    n = linked.select(F.col("a").alias("full")).unionByName(linked.select(F.col("b").alias("full"))).groupBy("full").agg(F.count("*").alias("n_links"))
    return common.written(roots.join(n, "full"), "line-classes"), linked


def _members():
    """All (line_no, class, n_links) of a document, from its rows (class, marks)."""
    own = F.collect_list(F.struct("class", "marks"))
    return F.sort_array(F.flatten(F.transform(own, lambda c: F.transform(c["marks"], lambda m: F.struct(m["line_no"].alias("line_no"), c["class"].alias("class"), m["n_links"].alias("n_links"))))))


def removals(df: DataFrame, k: int = MAX_EDITS, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, members: bool = False, groups: DataFrame | None = None) -> DataFrame:
    """(doc_id, _h, n_classes, n_linked, n_links, removed): for each document with lines; removed lists line numbers, rising.

    members: adds classes, the (line_no, class, n_links) of every line that isn't blank, by line number.
    groups: (doc_id, _h, lead) of near-duplicate documents; a line stays where the first
    document of its class is of the same group, so that the copies of a document all lose
    the same lines and stay copies of each other.
    """
    docs = common.documents(df)
    linked, _ = classes(df, k, min_chars)
    occ = occurrences(docs).join(linked, "full", "left").select(F.coalesce("root", "full").alias("class"), "doc_id", "_h", "line_no", "size", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    # by class and document first, so that a line that stands everywhere is dealt over all tasks
    own = occ.groupBy("class", "doc_id", "_h").agg(F.sort_array(F.collect_set("line_no")).alias("lines"), F.sum("n_links").alias("n_links"), F.count_if(F.col("n_links") > 0).alias("n_linked"), F.max("size").alias("size"), *([F.collect_set(F.struct("line_no", "n_links")).alias("marks")] if members else []))
    if groups is None:
        own = own.withColumn("lead", F.struct("doc_id", "_h"))
    else:
        own = own.join(groups.select("doc_id", "_h", "lead").distinct(), ["doc_id", "_h"])
    own = common.written(own, "line-owners")
    whole = own.groupBy("class").agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "_h", "lead")).alias("first"), F.max("size").alias("size"))
    whole = common.written(whole.where(F.col("n_docs") >= F.when(F.col("size") >= min_chars, 2).otherwise(min_docs)).drop("size"), "line-wholes")
    first = (F.col("first.lead") == F.col("lead"))
    gone = F.when(F.col("first").isNull() | first, F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0)))).otherwise(F.col("lines"))
    return common.joined(own, whole, "class", "n_docs", own.count(), "left").withColumn("gone", gone).groupBy("doc_id", "_h").agg(F.count("*").alias("n_classes"), F.sum("n_linked").alias("n_linked"), F.sum("n_links").alias("n_links"), F.sort_array(F.flatten(F.collect_list("gone"))).alias("removed"), *([_members().alias("classes")] if members else []))


def report(df: DataFrame) -> DataFrame:
    """One row a document: its lines, classes of lines, linked lines and their links, the removed line numbers, and each line's class.

    classes: for every line that isn't blank its number, the id of its class (32 hex digits: the
    line hash of the class's representative) and the number of distinct lines it links to.
    """
    n_lines = F.size(F.split("text", "\n", -1)).cast("bigint").alias("n_lines")
    every = common.documents(df).select("doc_id", "_h", n_lines)
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    removed = F.coalesce("removed", F.array().cast("array<int>"))
    classes_ = F.transform(F.coalesce("classes", F.array().cast("array<struct<line_no:int,class:binary,n_links:bigint>>")), lambda m: F.struct(m["line_no"].alias("line_no"), F.lower(F.hex(m["class"])).alias("class"), m["n_links"].alias("n_links")))
    return every.join(removals(df, members=True), ["doc_id", "_h"], "left").select(common.public_id(), "n_lines", zero("n_classes"), zero("n_linked"), zero("n_links"), F.size(removed).cast("bigint").alias("n_removed"), removed.alias("removed"), classes_.alias("classes"))


def cleaned(df: DataFrame, **options) -> DataFrame:
    """df with the removed lines cut out of text; other columns stay, n_chars follows the text where there is such a column."""
    gone = removals(df, **options).where(F.size("removed") > 0).select("doc_id", "_h", "removed")
    split = common.identified(df).join(gone, ["doc_id", "_h"], "left").withColumn("lines", F.when(F.col("removed").isNotNull(), F.split(F.col("row.text"), "\n", -1)))
    # the runs of lines between the removed ones
    begins = F.concat(F.array(F.lit(0)), F.transform("removed", lambda n: n + 1))
    ends = F.concat("removed", F.array(F.size("lines")))
    left = F.array_join(F.flatten(F.zip_with(begins, ends, lambda s, e: F.slice("lines", s + 1, e - s))), "\n")
    cut = F.col("row").withField("text", left)
    if "n_chars" in df.columns:
        cut = cut.withField("n_chars", F.length(left).cast(df.schema["n_chars"].dataType))
    return split.select(F.when(F.col("removed").isNull(), F.col("row")).otherwise(cut).alias("row")).select("row.*")
