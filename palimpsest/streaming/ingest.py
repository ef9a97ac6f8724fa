"""Incremental ingestion of batch results (O-78) and the streaming batch ledger (O-79).

Result files land in a folder; a Structured Streaming query picks up new ``.jsonl``
files (``availableNow`` or a processing-time trigger), parses their lines with the same column
expressions as the batch path and merges each micro-batch into a table cut by key: only the
parts it touches are written anew, and an epoch that runs again changes nothing. The last
line of a key (O-46) wins over all epochs, so stream and batch give the same answers.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import constants as K
from ..operators import results as RS
from ..sources.lines import numbered_lines

#: Files of a micro-batch at most, and parts of the table of results.
FILES_AT_ONCE, BUCKETS = 1_000, 64


def _parsed_stream(spark: SparkSession, directory: str, max_files: int | None, suffix: str = ".jsonl") -> DataFrame:
    """The parsed lines of new files, in no order."""
    r = spark.readStream.option("pathGlobFilter", f"*{suffix}").option("lineSep", "\n")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    lines = r.text(directory).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    return RS.parse_result_lines(lines.where(F.btrim("line") != ""))


_VERSION = ["epoch", "file", "line_no"]
_KEPT = ["custom_id", *_VERSION, "content", "has_choices"]


def ingest_results_stream(spark: SparkSession, directory: str, table_path: str, checkpoint: str,
                          available_now: bool = True, max_files: int = FILES_AT_ONCE, suffix: str = ".jsonl", buckets: int = BUCKETS):
    """O-78: start the ingestion query; returns the ``StreamingQuery``.

    The stream itself carries new files' names only (at most ``max_files`` a micro-batch); the
    micro-batch reads them as the batch path does, in blocks and with exact line numbers,
    and merges their last lines into the table. Malformed lines go to
    ``<table_path>_quarantine/epoch=<n>``.
    """
    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("pathGlobFilter", f"*{suffix}").option("maxFilesPerTrigger", max_files).load(directory).select("path"))

    def write(batch: DataFrame, epoch: int) -> None:
        names = [r["path"] for r in batch.distinct().collect()]
        if names:
            merge_results(batch.sparkSession, numbered_lines(batch.sparkSession, names), table_path, epoch, buckets)

    w = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def merge_results(spark: SparkSession, lines: DataFrame, table_path: str, epoch: int, buckets: int = BUCKETS) -> None:
    """Merge result lines into the table as ``epoch``: the last line of a key wins, by epoch, file
    and line number.

    The table is cut by key into ``buckets``. Only buckets with a key of these lines are written
    anew, to a folder of the epoch; a small table says which epoch's folder holds each bucket
    now, and is written last. So readers see an epoch as a whole or not at all, and an epoch
    that runs again replaces what it had written, whatever came of it. Lines are parsed once."""
    parsed = f"{table_path}/parsed/epoch={epoch}"
    RS.parse_result_lines(lines).write.mode("overwrite").parquet(parsed)
    parts = spark.read.parquet(parsed)
    parts.where("malformed").select("file", "line").write.mode("overwrite").parquet(f"{table_path}_quarantine/epoch={epoch}")
    bucket = F.expr(f"cast(pmod(xxhash64(custom_id), {buckets}) as int)")
    new = parts.where("not malformed").withColumn("epoch", F.lit(epoch)).select(*_KEPT).withColumn("bucket", bucket)
    held = _places(spark, table_path, epoch - 1)
    touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
    old = [f"{table_path}/data/epoch={held[b]}/bucket={b}" for b in sorted(touched & held.keys())]
    if old:
        new = new.unionByName(spark.read.parquet(*old).select(*_KEPT).withColumn("bucket", bucket))
    last = RS.last_per_key(new, "custom_id", _VERSION)
    (last.repartition("bucket").write.mode("overwrite").option("maxRecordsPerFile", 1_000_000)
     .partitionBy("bucket").parquet(f"{table_path}/data/epoch={epoch}"))
    rows = sorted({**held, **{b: epoch for b in touched}}.items())
    spark.createDataFrame(rows, "bucket int, at int").coalesce(1).write.mode("overwrite").parquet(f"{table_path}/places/epoch={epoch}")


def _places(spark: SparkSession, table_path: str, upto: int | None = None) -> dict[int, int]:
    """Bucket -> epoch of the folder that holds it, as of the last epoch (up to ``upto``)."""
    try:
        found = spark.read.parquet(f"{table_path}/places")
    except AnalysisException:  # nothing merged yet
        return {}
    if upto is not None:
        found = found.where(F.col("epoch") <= upto)
    newest = found.agg(F.max("epoch")).first()[0]
    return {r["bucket"]: r["at"] for r in found.where(F.col("epoch") == newest).collect()} if newest is not None else {}


def current_rows(spark: SparkSession, table_path: str) -> DataFrame:
    """(custom_id, epoch, file, line_no, content, has_choices): each key once. One scan."""
    paths = [f"{table_path}/data/epoch={e}/bucket={b}" for b, e in _places(spark, table_path).items()]
    if not paths:
        return spark.createDataFrame([], "custom_id string, epoch int, file string, line_no long, content string, has_choices boolean")
    return spark.read.parquet(*paths).select(*_KEPT)


def current_results(spark: SparkSession, table_path: str, mode: str = "regex") -> DataFrame:
    """The ingested answers: last per key across epochs, with fields and sidecar."""
    return RS.answer_sidecars(current_rows(spark, table_path), mode)


def dedupe_first_arrival(parsed: DataFrame, event_time: str, delay: str = "1 hour") -> DataFrame:
    """First arrival per key with bounded state (watermark); the batch path keeps the last."""
    return parsed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["custom_id"])


# ------------------------------------------------------------------ O-79 (stream)

LEDGER_OUT = "batch_id string, outcome string, attempts long, polls long"
LEDGER_STATE = "attempts long, polls long, ended boolean"


def _ledger_fn(retry_limit: int, terminal: tuple[str, ...], forget_after_ms: int | None):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        attempts, polls, ended = state.get if state.exists else (0, 0, False)
        if not ended:
            # a batch ends at its first terminal poll or one after the limit: no later one can matter
            arriving = ((ts, event, status) for pdf in pdfs for ts, event, status in zip(pdf["ts"], pdf["event_id"], pdf["status"]))
            for _, _, status in heapq.nsmallest(retry_limit - attempts + 1, arriving):
                polls += 1
                outcome = status if status in terminal else "given_up" if attempts >= retry_limit else None
                if outcome:
                    ended = True
                    yield pd.DataFrame({"batch_id": [key[0]], "outcome": [outcome], "attempts": [attempts], "polls": [polls]})
                    break
                attempts += 1
        state.update((attempts, polls, ended))
        if ended and forget_after_ms is not None:
            state.setTimeoutTimestamp(state.getCurrentWatermarkMs() + forget_after_ms)

    return fn


def batch_ledger_stream(polls: DataFrame, retry_limit: int = K.BATCH_RETRY_LIMIT,
                        terminal: tuple[str, ...] = K.BATCH_TERMINAL, forget_after_ms: int | None = None) -> DataFrame:
    """O-79 over a stream of polls ``(batch_id, ts, event_id, status)``: per batch,
    state ``(attempts, polls, ended)``; emits the outcome once when the batch ends (append
    mode), however its polls are spread over micro-batches.

    The mark of an ended batch (three numbers) stays, so polls that come after the end are
    ignored; with ``forget_after_ms`` it goes once the watermark of ``ts`` (to be set on
    ``polls``) has moved on so far. Polls of a batch are applied in ``(ts, event_id)`` order
    within a micro-batch and in arrival order across them.
    """
    timeout = GroupStateTimeout.NoTimeout if forget_after_ms is None else GroupStateTimeout.EventTimeTimeout
    return polls.groupBy("batch_id").applyInPandasWithState(
        _ledger_fn(retry_limit, tuple(terminal), forget_after_ms), LEDGER_OUT, LEDGER_STATE, "append", timeout)
