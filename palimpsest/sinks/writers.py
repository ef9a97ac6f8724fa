"""Writers (O-10..O-15; O-16 is in ``progress.py``). Parquet is the working format; CSV / JSON / text are written
for the tools that need them. Every writer is a DataFrame write (one file per task),
partitioned by the columns that the readers prune on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Most rows of one written file.
FILE_ROWS = 1_000_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O-10: header CSV, quotes doubled, multi-line cells quoted, white space kept; an empty
    text is a quoted empty cell, a null an empty one."""
    (df.write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("emptyValue", '""').option("nullValue", None).csv(path))


def write_request_jsonl(requests: DataFrame, path: str, line: str = "request", batch: str = "batch",
                        mode: str = "overwrite") -> None:
    """O-11: compact JSON request lines, one folder per batch (unassigned items left out)."""
    (requests.filter(F.col(batch).isNotNull()).select(batch, F.col(line).alias("value"))
     .repartition(batch).write.mode(mode).partitionBy(batch).text(path))


def write_conversations(docs: DataFrame, path: str, arm: str = "arm", mode: str = "overwrite") -> None:
    """O-12: conversation documents, one JSON document per line, one folder per arm; the tasks
    keep the rows they have, so a large arm is many files."""
    docs.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).partitionBy(arm).json(path)


def write_splits(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O-13: tokenised rows partitioned by ``arm`` and ``split``, written by the tasks that
    hold them."""
    df.write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).partitionBy("arm", "split").parquet(path)


def sidecar_table(answers: DataFrame, key: str = "custom_id", content: str = "sidecar") -> DataFrame:
    """O-14: ``(key, path, content)`` of the tagged sidecar for each key (path from the key)."""
    return answers.filter(F.col(content).isNotNull()).select(
        F.col(key).alias("key"), T.key_to_sidecar(F.col(key))["sidecar_path"].alias("path"),
        F.col(content).alias("content"))


def write_sidecars(answers: DataFrame, path: str, mode: str = "overwrite") -> None:
    """O-14 as a table: sidecar contents keyed by their path (parquet)."""
    sidecar_table(answers).write.mode(mode).parquet(path)


def write_files(df: DataFrame, base: str, path: str = "path", content: str = "content") -> DataFrame:
    """O-14 as real files: every row's ``content`` (text or bytes) written to
    ``base/<path>`` by the task holding the row (``pyarrow.fs``: local, HDFS, S3).

    Returns ``(path, bytes)`` of what was written; the write happens when that frame is
    evaluated. Last write wins for a repeated path, as with the original's sidecars
    (deduplicate first with ``operators.results.last_per_key`` to make it explicit).
    """
    import pandas as pd

    from ..sources.files import write_bytes

    root = base.rstrip("/")

    def run(batches):
        for pdf in batches:
            sizes = []
            for p, c in zip(pdf["path"], pdf["content"]):
                data = c.encode("utf-8") if isinstance(c, str) else bytes(c)
                write_bytes(f"{root}/{p}", data)
                sizes.append(len(data))
            yield pd.DataFrame({"path": pdf["path"], "bytes": sizes})

    return df.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInPandas(
        run, "path string, bytes long")


def write_quarantine(bad: DataFrame, path: str, mode: str = "append") -> None:
    """O-15: rows that failed parsing, kept with their reason."""
    bad.write.mode(mode).parquet(path)
