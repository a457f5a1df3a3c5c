"""The page-user graph and its projection to similar pages."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .edits import graph_edits

NEIGHBOURS, MAX_WEIGHT, BIG_EDIT = 10, 100.0, 100
#: Ids of pages that are one block, pages of a block that are summed up at once, and products that are made at once.
PAGE_BLOCK, STEP, MEET = 8192, 128, 1_000_000
#: Digits of the similarities that neighbours are chosen by.
DIGITS = 9


def contributions(revisions: DataFrame) -> DataFrame:
    """(page_id, user_id, weight) of each page's registered users that are no bots.

    A revert alone weighs 1, a small edit 10; edits of more than 100 added bytes add a
    tenth of them, up to 100.  The rule is a fold over edits, but its order doesn't
    matter: one such edit outweighs the floor, so a hash aggregate computes it.
    """
    change = F.col("rev_isrevert") == 0
    big = F.sum(F.when(change & (F.col("rev_chardiff") > BIG_EDIT), F.col("rev_chardiff") / 10.0))
    out = graph_edits(revisions).groupBy("page_id", "user_id").agg(big.alias("_big"), F.max(change).alias("_change"))
    weight = F.when(F.col("_big").isNotNull(), F.least(F.col("_big"), F.lit(MAX_WEIGHT))).when(F.col("_change"), F.lit(10.0)).otherwise(F.lit(1.0))
    return out.select("page_id", "user_id", weight.alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """(page_id, n_users) of the graph's pages."""
    return edges.groupBy("page_id").agg(F.count("*").alias("n_users"))


def similarities(edges: DataFrame, block: int = PAGE_BLOCK, best: int | None = None) -> DataFrame:
    """(a, b, similarity) of pages a < b with a user in common: the cosine of their weights.

    Pages are cut into blocks of so many ids.  A user's edges in a block, in one row, travel
    to every two blocks that hold pages of the user; there all that two pages share is
    together, so their similarity is summed up inside a task and pairs are never shuffled.
    Rows that travel: an edge times the blocks of its user, which pages of near ids keep small.

    best: only pairs that are among the best so many of either page inside two blocks; with
    ties as in :func:`jumps`, which needs no others.
    """
    n_tasks = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    norm = edges.groupBy("page_id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("_norm"))
    own = F.floor(F.col("page_id") / block).cast("bigint")
    unit = edges.join(norm.hint("merge"), "page_id").select("user_id", own.alias("_own"), F.struct((F.col("page_id") - own * block).cast("int").alias("at"), (F.col("weight") / F.col("_norm")).alias("w")).alias("_edge"))
    lists = unit.repartition("user_id").groupBy("user_id", "_own").agg(F.collect_list("_edge").alias("_edges"))
    others = F.collect_list("_own").over(Window.partitionBy("user_id"))
    sent = lists.withColumn("_others", others).withColumn("_other", F.explode("_others")).select(F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "user_id", "_own", F.col("_edges.at").alias("at"), F.col("_edges.w").alias("w"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            i, j = (batch.column(c).to_numpy() for c in ("_i", "_j"))
            ends = [*(np.flatnonzero((i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1), len(i)] if len(i) else []
            start = 0
            for end in ends:
                now = (int(i[start]), int(j[start]))
                if key is not None and now != key:
                    yield from _pairs(key, rows, block, best)
                    rows = []
                key = now
                rows.append(batch.slice(start, end - start))
                start = end
        if rows:
            yield from _pairs(key, rows, block, best)

    return sent.repartition(n_tasks, "_i", "_j").sortWithinPartitions("_i", "_j").mapInArrow(meet, "a bigint, b bigint, similarity double")


def _rounded(x: np.ndarray, digits: int = DIGITS) -> np.ndarray:
    """As Spark rounds: of the shortest decimal, halves up."""
    scaled = x * 10.0**digits
    out = np.floor(scaled + 0.5) / 10.0**digits
    near = np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-4)
    if len(near):
        value, which = np.unique(x[near], return_inverse=True)
        out[near] = np.array([float(Decimal(repr(float(v))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)) for v in value])[which]
    return out


def _first(rows: np.ndarray, value: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
    """Where the n largest values of each row stand; ties fall to the smaller other."""
    order = np.lexsort((other, -value, rows))
    r = rows[order]
    began = np.maximum.accumulate(np.where(np.r_[True, r[1:] != r[:-1]], np.arange(len(r)), 0))
    return order[np.arange(len(r)) - began < n]


def _pairs(key: tuple[int, int], rows: list[pa.RecordBatch], block: int, best: int | None) -> Iterator[pa.RecordBatch]:
    """The pairs of two blocks of pages (or of one), a few pages of the first at a time."""
    table = pa.Table.from_batches(rows)
    lists = table.column("at").combine_chunks()
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    at, w = lists.flatten().to_numpy().astype(np.int64), table.column("w").combine_chunks().flatten().to_numpy()
    user, own = (np.repeat(table.column(c).to_numpy(), n) for c in ("user_id", "_own"))
    i, j = key
    right = np.flatnonzero(own == j)
    right = right[np.argsort(user[right], kind="stable")]
    left = np.flatnonzero(own == i)
    left = left[np.argsort(at[left], kind="stable")]
    begin, end = (np.searchsorted(user[right], user[left], side) for side in ("left", "right"))
    upto = np.searchsorted(at[left], np.arange(0, block + STEP, STEP))  # edges of the pages before each step
    kept = []
    for step, (lo, hi) in enumerate(zip(upto[:-1], upto[1:])):
        sums, met = np.zeros(STEP * block), np.zeros(STEP * block, dtype=bool)
        lo = int(lo)
        while lo < hi:
            size = end[lo:hi] - begin[lo:hi]
            stop = lo + max(1, int(np.searchsorted(np.cumsum(size), MEET, "right")))
            size = size[: stop - lo]
            a = np.repeat(np.arange(lo, lo + len(size)), size)
            b = right[np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin[lo : lo + len(size)], size)]
            a = left[a]
            cell = (at[a] - step * STEP) * block + at[b]
            if len(cell):
                sums += np.bincount(cell, weights=w[a] * w[b], minlength=len(sums))
                met[cell] = True
            lo = stop
        cell = np.flatnonzero(met)
        a, b = i * block + step * STEP + cell // block, j * block + cell % block
        some = a < b
        a, b, s = a[some], b[some], sums[cell[some]]
        if best is None:
            for k in range(0, len(a), MEET):
                yield pa.RecordBatch.from_arrays([pa.array(x[k : k + MEET]) for x in (a, b, s)], ["a", "b", "similarity"])
        elif len(a):
            s = _rounded(s)
            for_a = _first(a, s, b, best)
            for_b = _first(b, s, a, best)
            kept.append((np.r_[a[for_a], a[for_b]], np.r_[b[for_a], b[for_b]], np.r_[s[for_a], s[for_b]]))
    if kept:
        a, b, s = (np.concatenate(x) for x in zip(*kept))
        _, once = np.unique((a - i * block) * block + (b - j * block), return_index=True)
        a, b, s = a[once], b[once], s[once]
        some = np.unique(np.r_[_first(a, s, b, best), _first(b, s, a, best)])
        for k in range(0, len(some), MEET):
            x = some[k : k + MEET]
            yield pa.RecordBatch.from_arrays([pa.array(a[x]), pa.array(b[x]), pa.array(s[x])], ["a", "b", "similarity"])


def jumps(similar: DataFrame, n: int = NEIGHBOURS, digits: int = DIGITS) -> DataFrame:
    """(page_id, position, neighbour, similarity): the n most similar pages, ties to the smaller id.

    Similarities are rounded first, so that the order of a sum can't break a tie.
    """
    s = F.round("similarity", digits).alias("similarity")
    both = similar.select(F.explode(F.array(F.struct(F.col("a").alias("page_id"), F.col("b").alias("neighbour")), F.struct(F.col("b").alias("page_id"), F.col("a").alias("neighbour")))).alias("e"), s).select("e.*", "similarity")
    best = Window.partitionBy("page_id").orderBy(F.desc("similarity"), "neighbour")
    return both.withColumn("position", F.row_number().over(best)).where(F.col("position") <= n)


def social_jumps(pages: DataFrame, jump_rows: DataFrame) -> DataFrame:
    """(page_id, page_socialjumps) of every page; an empty list where it has no neighbour."""
    listed = jump_rows.groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("position", "neighbour"))), lambda x: x["neighbour"]).alias("page_socialjumps"))
    return pages.select("page_id").join(listed.hint("merge"), "page_id", "left").withColumn("page_socialjumps", F.coalesce("page_socialjumps", F.array().cast("array<bigint>")))


def adjacency_order(edges: DataFrame) -> DataFrame:
    """Edges (a, b, ...) dealt by a and sorted by (a, b) within each task."""
    return edges.repartition("a").sortWithinPartitions("a", "b")
