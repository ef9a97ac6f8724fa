"""Request lines, batch records, fetching and transcription (O-08, O-57..O-59, O-66, O-81).

External calls (HTTP fetch, transcription engine) are injected callables run inside
``mapInPandas``; rows reach them already partitioned by Spark, and only rows that still
need work (anti-join on what exists) are sent.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import responses as R
from ..functions import text as T


def request_lines(items: DataFrame, prompt: str, path: str = "path", content: str = "content",
                  length: str = "length", model: str = K.REQUEST_MODEL) -> DataFrame:
    """O-56..O-59: ``custom_id``, mime type, base64 size and the request JSON line."""
    mime = T.mime_type(path)
    return items.select(
        F.col(path), T.path_to_key(path).alias("custom_id"), mime.alias("mime"),
        T.b64_size(length).alias("b64_size"),
        R.build_request(T.path_to_key(path), F.lit(prompt), T.data_url(content, mime), model=model).alias("request"),
    )


def batch_records(records: DataFrame, col: str = "record") -> DataFrame:
    """O-66: flatten batch metadata JSON records."""
    return records.select(*R.batch_record_fields(col))


# ------------------------------------------------------------------ O-08

Fetcher = Callable[[str], bytes | None]


def _fetch_rows(fetcher_factory: Callable[[], Fetcher], max_attempts: int, sleep: Callable[[float], None],
                threads: int, folder: str | None = None, suffix: str = ""):
    def one(fetch: Fetcher, key: str, url: str) -> tuple[str, int, int | None]:
        backoff, n, got = K.FETCH_FIRST_BACKOFF_S, 0, None
        while n < max_attempts:
            try:
                got = fetch(url)
            except Exception:  # a failed attempt, like a non-200 answer
                got = None
            n += 1
            if got is not None:
                break
            sleep(backoff)
            backoff *= 2
        if got is not None and folder is not None:
            from ..sources.files import write_bytes

            write_bytes(f"{folder.rstrip('/')}/{key}{suffix}", got)
        return (K.FETCH_DOWNLOADED if got is not None else K.FETCH_FAILED), n, (len(got) if got is not None else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        fetch = fetcher_factory()
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            for pdf in batches:
                res = list(pool.map(lambda k, u: one(fetch, k, u), pdf["key"], pdf["url"]))
                yield pd.DataFrame({"key": pdf["key"], "status": [r[0] for r in res],
                                    "attempts": [r[1] for r in res], "bytes": [r[2] for r in res]})

    return run


def fetch_manifest(manifest: DataFrame, present: DataFrame, fetcher_factory: Callable[[], Fetcher],
                   key: str = "key", url: str = "url", max_attempts: int = K.FETCH_MAX_ATTEMPTS,
                   sleep: Callable[[float], None] = time.sleep, partitions: int | None = None,
                   threads: int = 5, folder: str | None = None, suffix: str = ".jpg") -> DataFrame:
    """O-08: ``Exists`` for keys already present (no request); the rest fetched with up
    to ``max_attempts`` tries and doubling back-off -> ``Downloaded`` or
    ``Failed after max retries``. Output ``(key, status, attempts, bytes)``. Each task
    fetches with ``threads`` concurrent requests (I/O bound). With ``folder`` each body is
    written to ``folder/<key><suffix>`` by the task that fetched it, so that a listing of
    the folder is the next run's ``present``."""
    m = manifest.select(F.col(key).alias("key"), F.col(url).alias("url"))
    done = m.join(present.select(F.col(key).alias("key")), "key", "left_semi")
    todo = m.join(present.select(F.col(key).alias("key")), "key", "left_anti")
    if partitions:
        todo = todo.repartition(partitions)
    fetched = todo.mapInPandas(_fetch_rows(fetcher_factory, max_attempts, sleep, threads, folder, suffix),
                               "key string, status string, attempts int, bytes long")
    exists = done.select("key", F.lit(K.FETCH_EXISTS).alias("status"), F.lit(0).alias("attempts"),
                         F.lit(None).cast("long").alias("bytes"))
    return exists.unionByName(fetched)


# ------------------------------------------------------------------ O-81

Engine = Callable[[bytes], str]


def _transcribe_paths(engine_factory: Callable[[], Engine], reader: Callable[[str], bytes]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = engine_factory()
        for pdf in batches:
            texts, errors = [], []
            for p in pdf["path"]:
                try:
                    texts.append(engine(reader(p)))
                    errors.append(None)
                except Exception as e:  # unreadable file or engine failure: a message, not a crash
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"id": pdf["id"], "text": texts, "error": errors})

    return run


def transcribe_paths(listing: DataFrame, done: DataFrame, engine_factory: Callable[[], Engine],
                     key: str = "id", path: str = "path", reader: Callable[[str], bytes] | None = None) -> DataFrame:
    """O-81 over a file listing: only ``(id, path)`` go through the anti-join; each task
    reads the bytes of its pending images and runs the engine. Output ``(id, text, error)``.
    Pending paths are dealt out by number: by their own size they would be few tasks. The ids that
    are done are met in a merge; a broadcast would take them all through the driver."""
    from ..sources.files import read_bytes
    from .ordered import default_blocks

    todo = listing.select(F.col(key).alias("id"), F.col(path).alias("path")).join(
        done.select(F.col(key).alias("id")).hint("merge"), "id", "left_anti")
    todo = todo.repartition(max(default_blocks(listing.sparkSession), listing.sparkSession.sparkContext.defaultParallelism))
    return todo.mapInPandas(_transcribe_paths(engine_factory, reader or read_bytes),
                            "id string, text string, error string")


def _read_rows(reader: Callable[[str], bytes]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(content=[reader(p) for p in pdf["path"]])

    return run


def request_lines_from_paths(packed: DataFrame, prompt: str, key: str = "name", path: str = "path",
                             batch: str = "batch", model: str = K.REQUEST_MODEL,
                             reader: Callable[[str], bytes] | None = None) -> DataFrame:
    """O-59 for files on storage: ``(batch, name, request)`` lines built in the task that
    reads each image, after packing (O-40) saw only sizes; the line is that of
    :func:`request_lines`. ``key`` is the custom id source (slashes become ``|``)."""
    from ..sources.files import read_bytes

    todo = packed.filter(F.col(batch).isNotNull()).select(F.col(batch).cast("string").alias("batch"),
                                                          F.col(key).alias("name"), F.col(path).alias("path"))
    read = todo.mapInPandas(_read_rows(reader or read_bytes), "batch string, name string, path string, content binary")
    mime = T.mime_type("name")
    line = R.build_request(T.path_to_key("name"), F.trim(F.lit(prompt)), T.data_url("content", mime), model=model)
    return read.select("batch", "name", line.alias("request"))
