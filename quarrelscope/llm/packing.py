"""Cost-balanced packing of documents into token sequences (operator 6).

Training cost of a sequence is estimated as LINEAR * tokens + QUADRATIC * sum of the
squares of its pieces' lengths (attention stays inside a document).  Documents are
packed in groups that one task meets one after another: a group closes at
GROUP_TOKENS tokens, so memory is bounded and no shuffle is needed.  Inside a group
of T tokens there are ceil(T / capacity) sequences.  Documents of more than one
sequence give whole sequences first; the rest are taken by falling length, and each
goes to the sequence of lowest cost among those with room for it.  One that fits
nowhere is cut to fill the roomiest sequences.  A group has no sequence more than its
tokens need, so its padding is less than one sequence in GROUP_TOKENS tokens.

Each document ends with END_ID; an empty or null text is that id alone.  Repeated
rows are packed one by one, null ids stay null, texts of any length are taken whole; of
equally long documents the earlier row comes first, of equally cheap sequences the one of
lesser number; other columns are not looked at; an empty table gives no piece.  Sequence
ids are unique over tasks (task number in the high bits) and independent of data.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY, END_ID = 1024, 0
LINEAR, QUADRATIC = 1.0, 1.0 / 512
GROUP_TOKENS = 6_000_000
OUT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_cost double"


def cost(length: float) -> float:
    return LINEAR * length + QUADRATIC * length * length


def plan(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], list[float]]:
    """Pieces (document, start, length, sequence, offset) and each sequence's cost."""
    total = sum(lengths)
    n_full = sum(n // capacity for n in lengths)
    n_open = -(-(total - n_full * capacity) // capacity)
    costs = [0.0] * (n_full + n_open)
    used = [0] * (n_full + n_open)
    pieces: list[tuple[int, int, int, int, int]] = []
    rest: list[tuple[int, int, int]] = []
    at = 0
    for k, n in enumerate(lengths):
        whole = n // capacity
        for j in range(whole):
            pieces.append((k, j * capacity, capacity, at, 0))
            used[at], costs[at] = capacity, cost(capacity)
            at += 1
        if n % capacity:
            rest.append((n % capacity, k, whole * capacity))
    rest.sort(key=lambda x: (-x[0], x[1]))
    by_room: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]  # heaps of (cost, sequence) by remaining room
    by_room[capacity] = [(0.0, s) for s in range(at, at + n_open)]
    best = np.full(capacity + 1, np.inf)  # the lowest cost of each heap
    if n_open:
        best[capacity] = 0.0

    def put(room: int, k: int, start: int, length: int) -> None:
        _, s = heapq.heappop(by_room[room])
        best[room] = by_room[room][0][0] if by_room[room] else np.inf
        pieces.append((k, start, length, s, used[s]))
        used[s] += length
        costs[s] += cost(length)
        left = room - length
        if left:
            heapq.heappush(by_room[left], (costs[s], s))
            best[left] = by_room[left][0][0]

    for length, k, start in rest:
        room = length + int(np.argmin(best[length:]))
        if best[room] < np.inf:
            put(room, k, start, length)
            continue
        while length:  # it fits nowhere: fill up what is roomiest
            room = int(np.flatnonzero(best < np.inf)[-1])
            put(room, k, start, step := min(room, length))
            start, length = start + step, length - step
    return pieces, costs


def packed(df: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, json_path: str | None = None) -> DataFrame:
    """Pieces of every document of df, columns of OUT, plus the ids themselves as ``ids`` (binary, little-endian 32-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = tokens.encoder(json_path)
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("sequence_cost", pa.float64()), ("ids", pa.binary())])
        first = TaskContext.get().partitionId() << 36
        group: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal first
            pieces, costs = plan([len(x) for _, x in group], capacity)
            for at in range(0, len(pieces), 4096):
                rows = []
                for k, start, length, s, offset in pieces[at : at + 4096]:
                    doc_id, ids = group[k]
                    raw = ids[start : start + length].astype("<u4").tobytes()
                    rows.append((doc_id, start, length, zlib.crc32(raw), len(ids), first + s, offset, costs[s], raw))
                yield common.batch(schema, *zip(*rows))
            first += len(costs)

        for b in common.small(batches):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = encode.ids(text, END_ID)
                group.append((doc_id, ids))
                held += len(ids)
                if held >= group_tokens:
                    yield from closed()
                    group, held = [], 0
        if group:
            yield from closed()

    return df.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, OUT + ", ids binary")
