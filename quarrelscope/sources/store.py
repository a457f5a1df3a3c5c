"""Derived tables that are written once and read by every later query.

They stand in the folder named by spark.checkpoint.dir, which all executors share (a
temporary one where that is unset, as in tests).  Writing cuts the lineage: plans over
them stay small, and a lost executor costs a reread, not a rebuild.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="shared-")
        atexit.register(shutil.rmtree, _OWN[app], True)
    return _OWN[app]


def _fs(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files of a folder and of those right below it, whatever store it is in."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return ""
    told = []
    for f in fs.listStatus(p):
        told.append((f.getPath().getName(), f.getLen(), f.getModificationTime()))
        if f.isDirectory():
            told += [(g.getPath().getName(), g.getLen(), g.getModificationTime()) for g in fs.listStatus(f.getPath())]
    return str(sorted(told))


class Store:
    """Written tables of one session, by source and name, for as long as the source's files stay as they are."""

    def __init__(self):
        self._known: dict[tuple[str, str, str], tuple[str, str]] = {}
        self._lock = threading.RLock()

    def table(self, spark: SparkSession, source: str, name: str, make) -> DataFrame:
        """The table of that name: read if it was written from these files, else made by make() and written."""
        key = (spark.sparkContext.applicationId, source, name)
        with self._lock:  # tables may need each other while they are made
            now = state(spark, source)
            path, then = self._known.get(key, ("", ""))
            if not path or then != now:
                path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
                make().write.parquet(path)
                self._known[key] = (path, now)
        return spark.read.parquet(path)

    def forget(self, spark: SparkSession, source: str | None = None) -> int:
        """Delete what was written of the source, or of every source; returns how many tables."""
        with self._lock:
            gone = [k for k in self._known if k[0] == spark.sparkContext.applicationId and source in (None, k[1])]
            for k in gone:
                fs, p = _fs(spark, self._known.pop(k)[0])
                fs.delete(p, True)
        return len(gone)


STORE = Store()
