"""The files below a folder, listed and read by tasks (O-02, O-03).

Spark's own readers hold the name, size and split of every file of a folder on the driver, so
its memory grows with the number of files. Here tasks list the folders, a level at a time; what
they find is a table under the checkpoint location, and the driver holds two counts of it. The
files are those that Spark's readers find, under the same paths.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .files import kind_of, list_folder, read_bytes

#: Most folders, files listed and files read that one task takes where that makes more than 4 tasks a core.
FOLDERS, LISTED, READ = 1_000, 100_000, 4_000

#: Rows and bytes that a task gives away at once.
ROWS, BYTES = 10_000, 8_000_000

#: Stores whose folders the tasks can list; others, and path patterns, are left to Spark's readers.
STORES = ("file", "hdfs", "s3", "s3a", "s3n")

_FOUND = "folder boolean, path string, length long, modified long"
_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):/")
_NOT_IN_A_URI = re.compile(r"[\x00-\x20\"#%<>?\[\]\\^`{|}\x7f-\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def qualified(spark: SparkSession, directory: str) -> str | None:
    """The folder's path as Spark writes it, or None if tasks cannot list it."""
    if any(c in directory for c in "*?[]{}\\"):
        return None
    scheme = _SCHEME.match(directory)
    if scheme is None:
        store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
        if not store.startswith("file:"):
            return qualified(spark, store.rstrip("/") + directory) if directory.startswith("/") else None
        return "file:" + os.path.abspath(directory)
    if scheme[1].lower() not in STORES:
        return None
    if scheme[1].lower() == "file":
        return "file:" + os.path.abspath("/" + directory.partition(":")[2].lstrip("/"))
    return directory.rstrip("/")


def _hidden(name: str, folder: bool) -> bool:
    """What Spark's readers pass over."""
    if name.startswith(("_metadata", "_common_metadata")) and folder:
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _list(suffixes: Sequence[str], lower: bool, recursive: bool):
    def fold(name: str) -> str:
        return "".join(c.lower() if c.isascii() else c for c in name) if lower else name

    ends = tuple(fold(s) for s in suffixes)

    def wanted(name: str) -> bool:
        return fold(name).endswith(ends) and not _hidden(name, False)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for parent in batch.column(0).to_pylist():
                for name, folder, length, modified in list_folder(parent, wanted):
                    # folders of a partition column are entered by a plain read too
                    if not _hidden(name, folder) and (length > 0 or folder and (recursive or "=" in name)):
                        yield folder, f"{parent.rstrip('/')}/{name}", length, modified

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for row in rows(batches):
            held.append(row)
            if len(held) == ROWS:
                yield _found(held)
                held = []
        if held:
            yield _found(held)

    return run


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.bool_(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["folder", "path", "length", "modified"])


def _tasks(spark: SparkSession, n: int, most: int) -> int:
    """Tasks for ``n`` things: 4 a core, more beyond ``most`` for a task, none without work."""
    return max(1, min(n, max(4 * spark.sparkContext.defaultParallelism, -(-n // most))))


def files_below(spark: SparkSession, base: str, suffixes: Sequence[str], lower: bool = False, recursive: bool = False) -> tuple[DataFrame, int]:
    """(path, length, modificationTime) of the files with bytes below the :func:`qualified` folder
    ``base`` whose names end in one of ``suffixes``, and their number, as they are now."""
    kind = kind_of(base)
    if kind is None:
        raise AnalysisException(f"[PATH_NOT_FOUND] Path does not exist: {base}.")
    parent, name = base.rsplit("/", 1)
    start, list_now = (base, recursive) if kind == "folder" else (parent, False)
    kept, levels, files = scratch_dir(spark, "listing"), [], 0
    folders = spark.range(0, 1, 1, 1).select(F.lit(start).alias("path"))
    while True:
        at = f"{kept}/{len(levels)}"
        folders.mapInArrow(_list(suffixes, lower, list_now), _FOUND).write.parquet(at)
        levels.append(at)
        found = spark.read.schema(_FOUND).parquet(at)
        counted = dict(found.groupBy("folder").count().collect())
        files += counted.get(False, 0)
        n = counted.get(True, 0)
        if not n or kind != "folder":
            break
        list_now = True
        folders = found.where("folder").select("path").repartition(_tasks(spark, n, FOLDERS))
    listed = spark.read.schema(_FOUND).parquet(*levels).where("NOT folder")
    if kind != "folder":
        listed = listed.where(F.col("path") == base)
    out = listed.select("path", "length", F.timestamp_millis("modified").alias("modificationTime"))
    return out.coalesce(_tasks(spark, max(1, files), LISTED)), files


def _uri(path: str) -> str:
    """The path as Spark's file metadata column has it."""
    return _NOT_IN_A_URI.sub(lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), path)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def texts(held: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], ["name", "path", "content"])

    held, size = [], 0
    for batch in batches:
        for path in batch.column(0).to_pylist():
            data, uri = read_bytes(path), _uri(path)
            held.append((uri.rsplit("/", 1)[1], uri, data))
            size += len(data)
            if len(held) == ROWS or size >= BYTES:
                yield texts(held)
                held, size = [], 0
    if held:
        yield texts(held)


def texts_below(spark: SparkSession, base: str, suffix: str, recursive: bool = False) -> DataFrame:
    """(name, path, content) of the files found by :func:`files_below`, each read whole by the
    task that gives it out. Bytes that are no UTF-8 stay as they are."""
    files, n = files_below(spark, base, [suffix], recursive=recursive)
    dealt = files.select("path").repartition(_tasks(spark, n, READ))
    return dealt.mapInArrow(_read, "name string, path string, content binary").withColumn("content", F.col("content").cast("string"))
