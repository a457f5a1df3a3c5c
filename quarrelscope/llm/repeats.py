"""Exact substring dedup over suffix structures (operator 5).

Texts are UTF-8 bytes.  A byte goes when a LENGTH-byte string that covers it also
starts earlier -- in a document of smaller id, or earlier in the same one.  All
strings are judged on the input; matches never cross documents.

A suffix array of the whole corpus has no place on one machine, so suffixes are dealt
by content.  Every LENGTH-byte string has an anchor, the leftmost minimal hash among
its GRAM-byte grams; equal strings have equal anchors at equal places.  Consecutive
strings with one anchor form a context (LENGTH to 2 * LENGTH - GRAM bytes).

1. Anchors are dealt by hash.  Those that occur once can't repeat and are done.
2. The contexts of repeated anchors are cut from their texts and dealt by anchor.
   Contexts that are equal as a whole need no more than their earliest place.
3. Where an anchor has different contexts, breadth-first backward extension on their
   Burrows-Wheeler transform (every interval of l-byte strings, by one byte to the
   left) derives the common prefixes of neighbours by increasing value.  It stops at
   LENGTH: intervals that still have several rows are the repeated strings, and each
   keeps its earliest place.
4. The spans of all other places go back to their documents and are merged.

Rows travel as compressed arrays, dealt by hash; a batch sends an anchor that it
holds many times, or a context, once.  A task that gets several shards of anchors or
contexts holds one at a time.  The contexts of an anchor that occurs HOT times or more
are cut again, by a second anchor of another hash, and dealt by both, so that they are
many tasks' work; equal strings still meet.  What is large even so is split by string
inside its task.

Edge cases: null text is empty; texts shorter than LENGTH stay; texts of any length are
read whole, in parts; rows that repeat a document in full are that document and give equal
results; rows that share an id only are kept apart, the one of lesser text hash coming
first (ties of equal strings fall to the earlier place in it); a null id sorts first and
comes back as null; other columns are not looked at; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH, GRAM = 100, 28
#: Texts are read in parts of at most this many bytes, which overlap by LENGTH - 1.
PART_BYTES, FLUSH_ANCHORS, CHUNK_BYTES, SEEN = 1 << 20, 1_000_000, 1 << 20, 1_000_000
#: An anchor that occurs so often is cut again; its key has the top bit set.
HOT, _HOT_BIT = 20_000, np.uint64(1 << 63)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}
_ROW = np.dtype([("doc", "<u4"), ("start", "<i8"), ("shift", "u1"), ("windows", "u1")])
_DOC = np.dtype([("doc_id", "<i8"), ("h", "<i4")])
_SPAN = np.dtype([("doc_id", "<i8"), ("h", "<i4"), ("start", "<i8"), ("end", "<i8")])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of fields as one compressed blob, field by field; see :func:`_unpacked`."""
    out = []
    for a in arrays:
        fields = [a] if a.dtype.names is None else [np.ascontiguousarray(a[n]) for n in a.dtype.names]
        out += [np.int64(len(a)).tobytes(), *(f.tobytes() for f in fields)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpacked(blob: bytes, *dtypes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    for t in map(np.dtype, dtypes):
        n = int(np.frombuffer(raw, np.int64, 1, at)[0])
        at += 8
        a = np.empty(n, t)
        for name in t.names or [None]:
            kind = t[name] if name else t
            a[name if name else slice(None)] = np.frombuffer(raw, kind, n, at)
            at += n * kind.itemsize
        out.append(a)
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n + 1:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            x = np.full(max(PART_BYTES + LENGTH, n + 1), base, np.uint64)
            x[0] = 1
            _tables[name] = np.multiply.accumulate(x)
    return _tables["up"], _tables["down"]


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM, salt: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, shift, windows) of each run of strings with one anchor.

    start: the run's first string; shift: from there to the anchor; windows: strings in the run.
    salt: another one chooses other anchors.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    code = np.frombuffer(data, np.uint8)
    up, down = _powers(len(code))
    with np.errstate(over="ignore"):
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) * up[: len(code)], out=total[1:])
        h = (total[gram:] - total[:-gram]) * down[: len(code) - gram + 1]
        h = common.splitmix(h ^ np.uint64(salt) if salt else h)
    # the leftmost minimum: the hash's upper bits, then the place
    least = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
    wide, size = least, 1
    span = length - gram + 1
    while 2 * size <= span:
        wide = np.minimum(wide[:-size], wide[size:])
        size *= 2
    least = np.minimum(wide[:n], wide[span - size : span - size + n])
    place = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    windows = np.diff(np.concatenate([first, [n]]))
    return h[place[first]] >> np.uint64(16), first, place[first] - first, windows


def parts(data: bytes, length: int = LENGTH) -> Iterator[tuple[int, bytes]]:
    """The text in parts that overlap by length - 1 bytes, with where each begins."""
    if len(data) <= PART_BYTES:
        yield 0, data
        return
    step = PART_BYTES - length + 1
    for at in range(0, len(data) - length + 1, step):
        yield at, data[at : at + PART_BYTES]


def repeated_windows(contexts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, context, offset) of every string of so many bytes that occurs twice or more among the contexts.

    Level l holds the strings' last l bytes in sorted order, cut to intervals of equal
    ones.  The bytes before them, in that order, are the Burrows-Wheeler transform of
    the level; one stable sort by that byte maps every row to its place on the next
    level (the last-to-first mapping) and extends all intervals to the left at once.
    Neighbours that part on level l + 1 have l bytes in common; intervals of one row
    can't become a repeat and leave.
    """
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    windows = np.maximum(sizes - length + 1, 0)
    text = np.frombuffer(b"".join(contexts), np.uint8)
    of = np.repeat(np.arange(len(contexts), dtype=np.int32), windows)
    offset = (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)).astype(np.int32)
    place = (np.cumsum(sizes) - sizes)[of].astype(np.int32) + offset
    rows = np.arange(len(of), dtype=np.int32)
    interval = np.zeros(len(of), np.int32)
    for back in range(length - 1, -1, -1):
        if not len(rows):
            break
        byte = text[place[rows] + back]
        to = np.argsort(byte, kind="stable")
        byte, rows, interval = byte[to], rows[to], interval[to]
        parts = np.ones(len(rows) + 1, bool)
        parts[1:-1] = (interval[1:] != interval[:-1]) | (byte[1:] != byte[:-1])
        interval = np.cumsum(parts[:-1], dtype=np.int32)
        alone = parts[:-1] & parts[1:]
        if alone.any():
            rows, interval = rows[~alone], interval[~alone]
    return interval.astype(np.int64), of[rows].astype(np.int64), offset[rows].astype(np.int64)


def _h32(h: np.ndarray) -> np.ndarray:
    return h.astype(np.int64).astype(np.int32)


def _doc_shard(doc_id: np.ndarray, shards: int) -> np.ndarray:
    return (common.splitmix(doc_id.astype(np.int64).view(np.uint64)) % np.uint64(shards)).astype(np.int64)


TAGGED = "shard int, kind int, doc_id bigint, h int, body binary"
_SCHEMA = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("h", pa.int32()), ("body", pa.binary())])
ARRAYS, TEXT = 0, 1


def _rows(shard, kind, doc_id, h, body) -> pa.RecordBatch:
    return common.batch(_SCHEMA, shard, kind, doc_id, h, body)


def _by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        if cuts[s] < cuts[s + 1]:
            yield s, order[cuts[s] : cuts[s + 1]]


def _anchor_rows(key: np.ndarray, rows: np.ndarray, who: np.ndarray, shard: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    """Anchors with their rows and documents, packed by shard."""

    def packed() -> Iterator[tuple]:
        for s, at in _by_shard(shard, shards):
            used, doc = np.unique(rows["doc"][at], return_inverse=True)
            some = rows[at]
            some["doc"] = doc
            yield s, ARRAYS, 0, 0, _packed(key[at], some, who[used])

    yield from common.blobs(_SCHEMA, packed())


def _documents_dealt(docs: DataFrame, shards: int) -> DataFrame:
    """Compressed texts by the shard of their id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in common.small(batches, 1024):
            ids = b.column(0).to_numpy()
            texts = [squeeze(t.encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
            yield _rows(_doc_shard(ids, shards), [TEXT] * len(ids), ids, _h32(b.column(2).to_numpy()), texts)

    return docs.select("doc_id", "text", "_h").mapInArrow(run, TAGGED)


def _repeated_anchors(docs: DataFrame, shards: int, length: int) -> DataFrame:
    """Arrays of the anchors that occur twice or more, by the shard of their document."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        owners: list[tuple[int, int]] = []
        n = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            key, rows = (np.concatenate(x) for x in zip(*held))
            who = np.array(owners, _DOC)
            yield from _anchor_rows(key, rows, who, (key % np.uint64(shards)).astype(np.int64), shards)

        for b in common.small(batches, 1024):
            for doc_id, text, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _h32(b.column(2).to_numpy()).tolist()):
                data = text.encode("utf-8", "surrogatepass")
                if len(data) < length:
                    continue
                for begin, part in parts(data, length):
                    key, start, shift, windows = anchors(part, length)
                    rows = np.empty(len(key), _ROW)
                    rows["doc"], rows["start"], rows["shift"], rows["windows"] = len(owners), start + begin, shift, windows
                    held.append((key, rows))
                    n += len(key)
                owners.append((doc_id, h))
                if n >= FLUSH_ANCHORS:
                    yield from flushed()
                    held, owners, n = [], [], 0
        if held:
            yield from flushed()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, blobs in common.row_groups(batches, "shard"):
            own = [body for b in blobs for body in b.column(4).to_pylist()]
            del blobs
            keys = np.sort(np.concatenate([_unpacked(x, "<u8", _ROW, _DOC)[0] for x in own]))
            again = np.unique(keys[1:][keys[1:] == keys[:-1]])
            hot = np.searchsorted(keys, again, "right") - np.searchsorted(keys, again, "left") >= HOT
            del keys
            held, n, docs_before = [], 0, 0

            def flushed() -> Iterator[pa.RecordBatch]:
                key, rows, who = (np.concatenate(x) for x in zip(*held))
                yield from _anchor_rows(key, rows, who, _doc_shard(who["doc_id"][rows["doc"]], shards), shards)

            for x in own:  # blob by blob: a blob is bounded, whatever one anchor's share is
                key, rows, who = _unpacked(x, "<u8", _ROW, _DOC)
                at = np.searchsorted(again, key)
                hit = np.flatnonzero(again[np.minimum(at, len(again) - 1)] == key) if len(again) else np.zeros(0, np.int64)
                if not len(hit):
                    continue
                key, rows = np.where(hot[at[hit]], key[hit] | _HOT_BIT, key[hit]), rows[hit]
                rows["doc"] += docs_before
                held.append((key, rows, who))
                n, docs_before = n + len(key), docs_before + len(who)
                if n >= FLUSH_ANCHORS:
                    yield from flushed()
                    held, n, docs_before = [], 0, 0
            if held:
                yield from flushed()

    posted = docs.select("doc_id", "text", "_h").mapInArrow(post, TAGGED)
    return common.dealt(posted).mapInArrow(meet, TAGGED)


def _with_arrays(batches: Iterator[pa.RecordBatch], take) -> Iterator[tuple[int, int, bytes]]:
    """Texts of a task's documents, after take() got each array blob that came before them."""
    for b in batches:
        kinds = b.column(1).to_pylist()
        for k, kind in enumerate(kinds):
            if kind == ARRAYS:
                take(b.column(4)[k].as_py())
            else:
                yield b.column(2)[k].as_py(), b.column(3)[k].as_py(), zstandard.ZstdDecompressor().decompress(b.column(4)[k].as_py())


def _spans_out(spans: list[tuple[int, int, int, int]], shards: int, kind: int) -> Iterator[pa.RecordBatch]:
    a = np.array(spans, _SPAN)
    yield from common.blobs(_SCHEMA, ((s, kind, 0, 0, _packed(a[at])) for s, at in _by_shard(_doc_shard(a["doc_id"], shards), shards)))


_SECOND = 0x2545F4914F6CDD1D


def _both(one: int, other: int) -> int:
    """The key of what has both anchors."""
    return int.from_bytes(xxhash.xxh3_64_digest(one.to_bytes(8, "big") + other.to_bytes(8, "big")), "big")


def _contexts(tagged: DataFrame, shards: int, length: int) -> DataFrame:
    """Contexts of repeated anchors by the shard of the anchor (kind ARRAYS), and spans that are settled (kind TEXT)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}

        def take(blob: bytes) -> None:
            key, rows, who = _unpacked(blob, "<u8", _ROW, _DOC)
            order = np.argsort(rows["doc"], kind="stable")
            cuts = np.searchsorted(rows["doc"][order], np.arange(len(who) + 1))
            for k, owner in enumerate(who.tolist()):
                at = order[cuts[k] : cuts[k + 1]]
                wanted.setdefault(owner, []).append((key[at], rows[at]))

        seen: set[bytes] = set()
        held: list[tuple] = []
        spans: list[tuple[int, int, int, int]] = []
        size, last = 0, None

        def flushed() -> Iterator[pa.RecordBatch]:
            keys = np.array([x[0] for x in held], np.uint64)

            def packed() -> Iterator[tuple]:
                for s, at in _by_shard((keys % np.uint64(shards)).astype(np.int64), shards):
                    some = [held[k] for k in at.tolist()]
                    place = np.array([(x[1], x[2], x[3], x[3]) for x in some], _SPAN)
                    shift = np.array([x[4] for x in some], np.uint8)
                    long = np.array([len(x[5]) for x in some], np.int64)
                    yield s, ARRAYS, 0, 0, _packed(keys[at], place, shift, long, np.frombuffer(b"".join(x[5] for x in some), np.uint8))

            yield from common.blobs(_SCHEMA, packed())

        for doc_id, h, data in _with_arrays(batches, take):
            if (doc_id, h) == last:  # a repeated row
                continue
            last = (doc_id, h)
            own = wanted.pop((doc_id, h), None)
            if own is None:
                continue
            key, rows = (np.concatenate(x) for x in zip(*own))
            order = np.argsort(rows["start"], kind="stable")
            rows = rows[order]
            for k, start, shift, windows in zip(key[order].tolist(), rows["start"].tolist(), rows["shift"].tolist(), rows["windows"].tolist()):
                context = data[start : start + windows - 1 + length]
                mark = xxhash.xxh3_128_digest(context) + bytes([shift])
                if mark in seen:  # an equal context stands earlier: documents come by rising id
                    spans.append((doc_id, h, start, start + len(context)))
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(mark)
                if k >> 63:
                    for k2, s2, shift2, n2 in zip(*(x.tolist() for x in anchors(context, length, salt=_SECOND))):
                        held.append((_both(k, k2), doc_id, h, start + s2, shift2, context[s2 : s2 + n2 - 1 + length]))
                        size += n2 - 1 + length
                else:
                    held.append((k, doc_id, h, start, shift, context))
                    size += len(context)
            if size >= 16 * CHUNK_BYTES:
                yield from flushed()
                held, size = [], 0
            if len(spans) >= 200_000:
                yield from _spans_out(spans, shards, TEXT)
                spans = []
        if held:
            yield from flushed()
        if spans:
            yield from _spans_out(spans, shards, TEXT)

    return tagged.mapInArrow(run, TAGGED)


def _settled(contexts: list[bytes], places: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Spans of the strings that stand earlier in another of the contexts; places: theirs, as _SPAN."""
    group, of, offset = repeated_windows(contexts, length)
    if not len(group):
        return
    start = places["start"][of] + offset
    order = np.lexsort((start, places["h"][of], places["doc_id"][of], group))
    g = group[order]
    later = order[np.concatenate([[False], g[1:] == g[:-1]])]
    later = later[np.lexsort((offset[later], of[later]))]
    o, w = of[later], offset[later]
    cut = np.flatnonzero((o[1:] != o[:-1]) | (w[1:] != w[:-1] + 1)) + 1
    for s, e in zip(np.concatenate([[0], cut]).tolist(), np.concatenate([cut, [len(o)]]).tolist()):
        if s < e:
            p = places[o[s]]
            yield int(p["doc_id"]), int(p["h"]), int(p["start"] + w[s]), int(p["start"] + w[e - 1] + length)


def _split(contexts: list[bytes], places: np.ndarray, length: int, limit: int) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Parts of at most about limit bytes in which all equal strings still meet: strings go by their hash."""
    n_parts = -(-sum(map(len, contexts)) * 4 // limit)
    at = [(k, w) for k, c in enumerate(contexts) for w in range(len(c) - length + 1)]
    part = np.fromiter((xxhash.xxh3_64_intdigest(contexts[k][w : w + length]) % n_parts for k, w in at), np.int64, len(at))
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(n_parts + 1))
    for p in range(n_parts):
        own = [at[k] for k in order[cuts[p] : cuts[p + 1]].tolist()]
        if own:
            yield [contexts[k][w : w + length] for k, w in own], np.array([(places[k]["doc_id"], places[k]["h"], places[k]["start"] + w, 0) for k, w in own], _SPAN)


def _spans(dealt: DataFrame, shards: int, length: int) -> DataFrame:
    """Spans to remove, as arrays by the shard of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []

        for shard, blobs in common.row_groups(batches, "shard"):
            own = []
            for b in blobs:
                for kind, body in zip(b.column(1).to_pylist(), b.column(4).to_pylist()):
                    if kind == TEXT:
                        yield _rows([shard], [ARRAYS], [0], [0], [body])
                    else:
                        own.append(body)
            del blobs
            if not own:
                continue
            keys, places, text = [], [], []
            for x in own:
                key, place, shift, long, raw = _unpacked(x, "<u8", _SPAN, "u1", "<i8", "u1")
                at = np.cumsum(long)
                raw = raw.tobytes()
                text += [raw[e - n : e] for e, n in zip(at.tolist(), long.tolist())]
                keys.append(key)
                places.append(place)
            del own
            key, place = np.concatenate(keys), np.concatenate(places)
            order = np.lexsort((place["start"], place["h"], place["doc_id"], key))
            group: list[int] = []
            chunk: list[int] = []
            size = 0

            def distinct(group: list[int]) -> list[int]:
                """Of each equal context the first; the others are settled."""
                first: set[bytes] = set()
                lead = []
                for k in group:
                    if text[k] in first:
                        p = place[k]
                        out.append((int(p["doc_id"]), int(p["h"]), int(p["start"]), int(p["start"]) + len(text[k])))
                    else:
                        first.add(text[k])
                        lead.append(k)
                return lead if len(lead) > 1 else []

            def solved(chunk: list[int]) -> None:
                some = [text[k] for k in chunk]
                if sum(map(len, some)) > 8 * CHUNK_BYTES:
                    for part, where in _split(some, place[chunk], length, 8 * CHUNK_BYTES):
                        out.extend(_settled(part, where, length))
                else:
                    out.extend(_settled(some, place[chunk], length))

            ranked = key[order]
            cuts = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranked)]):
                if e - s < 2:
                    continue
                group = distinct(order[s:e].tolist())
                if not group:
                    continue
                grown = sum(len(text[k]) for k in group)
                if chunk and size + grown > CHUNK_BYTES:
                    solved(chunk)
                    chunk, size = [], 0
                chunk += group
                size += grown
                if len(out) >= 200_000:
                    yield from _spans_out(out, shards, ARRAYS)
                    out.clear()
            if chunk:
                solved(chunk)
        if out:
            yield from _spans_out(out, shards, ARRAYS)

    return dealt.mapInArrow(run, TAGGED)


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the spans' union."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(s[1:] > e[:-1]) + 1
    return list(zip(s[np.concatenate([[0], new])].tolist(), e[np.concatenate([new - 1, [len(s) - 1]])].tolist()))


OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>, kept binary"


def deduplicated(df: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row's removed spans and remaining bytes; columns of OUT."""
    docs, shards = common.documents(df), common.n_shards(df)
    texts = _documents_dealt(docs, shards)
    sides = lambda arrays: texts.unionByName(arrays).repartition(shards, "shard").sortWithinPartitions("kind", "doc_id", "h")
    contexts = _contexts(sides(_repeated_anchors(docs, shards, length)), shards, length)
    spans = _spans(common.dealt(contexts), shards, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[np.ndarray] = []
        at: dict[tuple[int, int], np.ndarray] = {}
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
        rows, size = [], 0
        for doc_id, h, data in _with_arrays(batches, lambda blob: got.append(_unpacked(blob, _SPAN)[0])):
            if got:
                every = np.concatenate(got)
                every = every[np.lexsort((every["h"], every["doc_id"]))]
                got = []
                cut = np.flatnonzero((every["doc_id"][1:] != every["doc_id"][:-1]) | (every["h"][1:] != every["h"][:-1])) + 1
                for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(every)]):
                    at[int(every["doc_id"][s]), int(every["h"][s])] = every[s:e]
            own = at.get((doc_id, h))
            gone = merged(own["start"], own["end"]) if own is not None else []
            left, done = [], 0
            for s, e in gone:
                left.append(data[done:s])
                done = e
            left = b"".join([*left, data[done:]])
            rows.append((doc_id, len(data), len(data) - len(left), len(gone), hashlib.sha256(left).hexdigest(), [{"start": s, "end": e} for s, e in gone], left))
            size += len(left)
            if size > 4 << 20 or len(rows) >= 2048:
                yield common.batch(schema, *zip(*rows))
                rows, size = [], 0
        if rows:
            yield common.batch(schema, *zip(*rows))

    return sides(spans).mapInArrow(run, OUT)


def report(df: DataFrame) -> DataFrame:
    return deduplicated(df).select(common.public_id(), "n_bytes", "n_removed", "n_spans", "kept_sha256")
