"""Readers (O-01..O-07, O-09). Every reader takes an explicit schema; nothing is
inferred. Listings read file metadata only; tasks list the folders (``folders.py``)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import responses as R
from ..functions.nulls import normalise_null_tokens
from .folders import files_below, qualified, texts_below
from .lines import numbered_lines

CONVERSATION_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("image", T.StringType()),
    T.StructField("conversations", T.ArrayType(T.StructType([
        T.StructField("from", T.StringType()), T.StructField("value", T.StringType())]))),
])

TRAINING_LOG_SCHEMA = T.StructType([
    T.StructField("step", T.LongType()), T.StructField("loss", T.DoubleType()),
    T.StructField("eval_loss", T.DoubleType()), T.StructField("eval_accuracy", T.DoubleType()),
])


#: What the parser gives for a cell without anything; it differs from a quoted empty text.
NO_CELL = "\x00"


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str, null_tokens: Iterable[str] | None = None,
             sep: str = ",") -> DataFrame:
    """O-01 (+ O-05): header CSV with quoted multi-line cells and doubled quotes.

    Only a cell without anything is null, a quoted empty one is an empty text; ``null_tokens`` (e.g. the pandas list in
    ``constants.PANDAS_NULL_TOKENS``) makes the reference reader's null inference explicit.
    """
    df = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
          .option("sep", sep).option("nullValue", NO_CELL).schema(schema).csv(path))
    if null_tokens is not None:
        strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = normalise_null_tokens(df, strings, null_tokens)
    return df


#: Characters with a meaning in path patterns.
GLOB = "\\*?[]{},^"

#: Spark's splits of many small files that one task takes: of names and sizes only, of whole texts.
SPLITS_LISTED, SPLITS_READ = 250, 16


def _fewer_tasks(files: DataFrame, splits: int) -> DataFrame:
    """``files`` by a task for ``splits`` of its splits, but all cores. Spark counts every file as
    some megabytes more than it has, so that a folder of small files is a task for every few files."""
    n = files.rdd.getNumPartitions()
    return files.coalesce(max(-(-n // splits), 4 * files.sparkSession.sparkContext.defaultParallelism))


def scan_text_sidecars(spark: SparkSession, directory: str, suffix: str = ".txt", recursive: bool = False) -> DataFrame:
    """O-02: one row per file ending in ``suffix``: ``(name, path, content)``.

    Whole files, listed now and read by the tasks that give them out; name and path are those of
    the file metadata column. Keys are derived by the caller with ``text.doc_key``.
    """
    base = None if any(c in suffix for c in GLOB) else qualified(spark, directory)
    if base is not None:
        return texts_below(spark, base, suffix, recursive)
    df = (spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", recursive)
          .text(directory, wholetext=True))
    out = df.select(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_path").alias("path"),
                    F.col("value").alias("content"))
    return _fewer_tasks(out, SPLITS_READ)


def _suffix_glob(suffixes: Sequence[str], lower: bool) -> str:
    """Path pattern of names that end in one of ``suffixes``, in any case if ``lower``."""
    def one(c: str) -> str:
        if lower and c.isascii() and c.isalpha():
            return f"[{c.lower()}{c.upper()}]"
        return "\\" + c if c in GLOB else c

    return "*{" + ",".join("".join(one(c) for c in s) for s in suffixes) + "}"


def scan_listing(spark: SparkSession, directory: str, suffixes: Sequence[str] = K.VALID_IMAGE_SUFFIXES,
                 lower: bool = False, recursive: bool = False) -> DataFrame:
    """O-03: file names filtered by suffix (case-sensitive unless ``lower``).

    The folder is listed now, by tasks; no bytes are read, and other files are left out where they
    are found. No suffixes: no rows. A path pattern, or a store that tasks cannot list, goes
    to ``binaryFile`` with ``content`` pruned; the driver then holds all files of the folder.
    """
    base = qualified(spark, directory) if suffixes else None
    if base is not None:
        files, _ = files_below(spark, base, suffixes, lower, recursive)
        return files.select("path", F.substring_index("path", "/", -1).alias("name"), "length", "modificationTime")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
          .option("pathGlobFilter", _suffix_glob(suffixes, lower)).load(directory))
    name = F.substring_index(F.col("path"), "/", -1)
    out = df.select(F.col("path"), name.alias("name"), F.col("length"), F.col("modificationTime"))
    return _fewer_tasks(out, SPLITS_LISTED) if suffixes else out.filter(F.lit(False))


def scan_images(spark: SparkSession, directory: str, suffixes: Sequence[str] = K.VALID_IMAGE_SUFFIXES) -> DataFrame:
    """Image bytes ``(path, name, length, content)`` for the transcription / request jobs."""
    df = spark.read.format("binaryFile").load(directory)
    name = F.substring_index(F.col("path"), "/", -1)
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | name.endswith(s)
    return df.select("path", name.alias("name"), "length", "content").filter(cond)


def scan_result_jsonl(spark: SparkSession, path: str, batch_id: str | None = None, suffix: str = ".jsonl") -> DataFrame:
    """O-04: result lines ``(file, line_no, line)``; files chosen by ``.jsonl`` suffix and,
    if given, ``batch_<id>`` in the name. A large file is read by many tasks. Parse with
    ``operators.results``; the last line per key in ``(file, line_no)`` order wins (O-46)."""
    return numbered_lines(spark, path, suffix, None if batch_id is None else f"batch_{batch_id}")


def scan_conversation_json(spark: SparkSession, path: str) -> DataFrame:
    """O-06: JSON array of conversation documents (multi-line JSON)."""
    return spark.read.option("multiLine", True).schema(CONVERSATION_SCHEMA).json(path)


def scan_conversation_lines(spark: SparkSession, path: str, arm: str | None = None) -> DataFrame:
    """Conversation documents written one per line (the sink's format); ``arm`` names the column
    of the folders, which is there also if no arm was written."""
    schema = CONVERSATION_SCHEMA if arm is None else T.StructType([*CONVERSATION_SCHEMA.fields, T.StructField(arm, T.StringType())])
    return spark.read.schema(schema).json(path)


def scan_splits(spark: SparkSession, base: str, split: str | None = None, arm: str | None = None) -> DataFrame:
    """O-07: tokenised splits written partitioned by ``arm`` / ``split``; filters on the
    partition columns prune folders."""
    df = spark.read.parquet(base)
    if arm is not None:
        df = df.filter(F.col("arm") == arm)
    if split is not None:
        df = df.filter(F.col("split") == split)
    return df


def scan_training_log(spark: SparkSession, path: str) -> DataFrame:
    """O-09: tab-separated ``step, loss, eval_loss[, eval_accuracy]``."""
    return spark.read.option("header", True).option("sep", "\t").schema(TRAINING_LOG_SCHEMA).csv(path)


def parse_batch_files(spark: SparkSession, directory: str) -> DataFrame:
    """Batch state files (``<batch id>.txt`` holding the JSON record), flattened (O-66)."""
    side = scan_text_sidecars(spark, directory, ".txt")
    return side.select(F.replace(F.col("name"), F.lit(".txt"), F.lit("")).alias("batch_file_id"),
                       *R.batch_record_fields(F.col("content")))
