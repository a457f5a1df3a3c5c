"""Shared plumbing of the corpus operators: inputs, written tables, columnar shuffles.

Inputs are normalised once by :func:`documents`: ``doc_id`` as bigint (a null id
is kept as :data:`NULL_ID`), ``text`` with null read as empty, plus ``_h``, a hash
of the text, so that rows which share an id but not a text stay apart and repeated
rows count as one document.  Other columns are dropped by name, so a clashing extra
column can't interfere.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null id inside the operators; sorts before every other id.
NULL_ID = -(2**63)
_WRITTEN: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, _h): null id -> NULL_ID, null text -> empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_h"))


def public_id(name: str = "doc_id"):
    """NULL_ID back to null."""
    return F.when(F.col(name) != F.lit(NULL_ID), F.col(name)).alias(name)


def identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, _h): each row of df as one struct, beside its identity as in :func:`documents`.

    Nothing of df stands at the top level, so no column of it can clash; select("row.*") gives it back.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("doc_id"), F.xxhash64(text).alias("_h"))


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset (tests), a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = getattr(spark, "_own_shared_folder", None)
        if not folder:
            folder = spark._own_shared_folder = tempfile.mkdtemp(prefix="shared-")
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a table in the shared folder: lineage ends here and any executor can reread it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def drop_written() -> None:
    """Delete the tables made by :func:`written`; results that still read them must be consumed before."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may have ended
            pass


atexit.register(drop_written)


#: A key counts as hot with more than 1 / HOT_SHARE of the rows.
HOT_SHARE = 1000


def joined(rows: DataFrame, values: DataFrame, key: str, weight: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with values (one for a key) on a key that may hold any share of the rows.

    weight: the column of values with the key's rows; total: rows in all.  At most
    HOT_SHARE keys have more than total / HOT_SHARE rows: their values are broadcast,
    within that bound, and their rows stay where they are.  The others, none of which can
    fill a task, meet by a shuffle.  The weight isn't returned.
    """
    hot = F.broadcast(values.where(F.col(weight) * HOT_SHARE > total).drop(weight))
    rest = values.where(F.col(weight) * HOT_SHARE <= total).drop(weight)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(rest, key, how))


def bounded_groups(rows: DataFrame, key: str, item: str, size: int) -> DataFrame:
    """rows with ``task``: a group of at most size rows is one task's; of a larger one every two blocks meet in a task of their own.

    key: a bigint column; item: what a row's block is chosen by.  All pairs of a group meet, and no
    task's group has more than about twice size rows.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > size)
    counts = written(counts.withColumn("blocks", F.ceil(F.col("n") / size).cast("int")), "large-groups")
    if counts.isEmpty():
        return rows.withColumn("task", F.col(key))
    dealt_ = joined(rows, counts, key, "n", rows.count(), "left").withColumn("block", F.pmod(F.xxhash64(item), F.coalesce("blocks", F.lit(1)).cast("bigint")))
    others = F.sequence(F.lit(0).cast("bigint"), (F.coalesce("blocks", F.lit(1)) - 1).cast("bigint"))
    meets = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(F.filter(others, lambda x: x != F.col("block")))
    out = dealt_.withColumn("other", F.explode(meets))
    task = F.when(F.col("blocks").isNull(), F.col(key)).otherwise(F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other")))
    return out.withColumn("task", task).drop("blocks", "block", "other")


def n_shards(df: DataFrame) -> int:
    """Tasks of a shuffle that a columnar exchange deals its shards over."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def dealt(df: DataFrame, key: str = "shard") -> DataFrame:
    """Shuffle blobs to the task of their shard number, sorted by it: a task may get several shards, and holds one at a time.  Each blob is bounded by one input batch."""
    return df.repartition(n_shards(df), key).sortWithinPartitions(key)


def row_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[pa.RecordBatch]]]:
    """Consecutive runs of equal key, over batches sorted by it."""
    held, at = [], None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        bounds = [0, *cuts.tolist(), len(keys)]
        for s, e in zip(bounds, bounds[1:]):
            k = keys[s]
            if held and k != at:
                yield at, held
                held = []
            at = k
            held.append(b.slice(s, e - s))
    if held:
        yield at, held


def small(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of at most so many rows and, but for one long text, about so many bytes."""
    for b in batches:
        per = max(1, b.nbytes // max(1, b.num_rows))
        step = max(1, min(rows, size // per))
        for s in range(0, b.num_rows, step):
            yield b.slice(s, step)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def blobs(schema: pa.Schema, rows: Iterable[tuple], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows whose last field is bytes, in batches of about so many bytes: a batch for each blob would cost more than the blob."""
    held, n = [], 0
    for row in rows:
        held.append(row)
        n += len(row[-1])
        if n >= size:
            yield batch(schema, *zip(*held))
            held, n = [], 0
    if held:
        yield batch(schema, *zip(*held))


def splitmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix, vectorised."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x
