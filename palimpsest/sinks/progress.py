"""Resumable generation (O-16, O-22, O-27): every output is kept once, whatever was run before.

What is finished is known by the rows themselves, not by their place in the input. A row's
identity is a 128-bit hash of all its values (nulls told apart) and, for equal rows, a number
from 1 on; its outputs carry it. A run reads the identities and arms that are there, generates
the rest in one job, and each task writes what it has as a file of its own after every
``every`` outputs. A file is written under another name and then moved, so it is there whole
or not at all; its name is a hash of the outputs' identities and arms, and a task's rows are
sorted by identity, so a task that runs twice writes the same files. A run that was stopped
keeps its files.

So rows may be added, removed or changed between runs, keys may be null or repeated. Outputs
of rows that are no longer there stay in the folder; :func:`read_progress` with the present
rows leaves them out.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.generate import PENDING, ROW
from ..operators.ordered import row_number
from ..sources.files import write_once

#: Outputs of one file, and the bytes (in memory) after which a file has fewer.
EVERY, FILE_BYTES = 10_000, 32_000_000


def identified(rows: DataFrame) -> DataFrame:
    """``rows`` with their identity in the column ``ROW``: equal rows are numbered, and which of
    them has which number is of no importance."""
    missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in rows.columns])
    values = [F.to_json(c) if t.startswith(("map", "variant")) else F.col(c) for c, t in rows.dtypes]
    keyed = rows.select("*", F.xxhash64(missing, *values).alias("_h1"), F.xxhash64(F.lit(1), missing, *values).alias("_h2"),
                        F.monotonically_increasing_id().alias("_at"))
    numbered = row_number(keyed, ["_at"], keys=["_h1", "_h2"], name="_n")
    identity = F.concat_ws("-", F.lpad(F.hex("_h1"), 16, "0"), F.lpad(F.hex("_h2"), 16, "0"), F.col("_n").cast("string"))
    return numbered.select(*rows.columns, identity.alias(ROW))


def read_progress(spark, path: str, rows: DataFrame | None = None) -> DataFrame | None:
    """The outputs in ``path`` (None if there are none), with ``rows`` only theirs."""
    try:
        found = spark.read.parquet(path)
    except AnalysisException:  # nothing written yet
        return None
    return found if rows is None else found.join(identified(rows).select(ROW), ROW, "left_semi")


def _bytes(batch: pa.RecordBatch) -> list[int]:
    """Bytes of each row's texts."""
    texts = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    return np.sum([pc.fill_null(pc.binary_length(c), 0).to_numpy() for c in texts], axis=0, dtype=np.int64).tolist()


def _save(path: str, every: int):
    """Outputs -> the files written from them (file, outputs)."""

    def save(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held)
        name = hashlib.sha256("\n".join(f"{r} {a}" for r, a in zip(table[ROW].to_pylist(), table["arm"].to_pylist())).encode()).hexdigest()[:40]
        data = io.BytesIO()
        pq.write_table(table, data)
        write_once(f"{path}/part-{name}.parquet", data.getvalue())
        return pa.RecordBatch.from_pydict({"file": [name], "outputs": [table.num_rows]})

    def run(batches):
        held, rows, size = [], 0, 0
        for batch in batches:
            # cuts depend on the rows alone, so a task that runs twice makes the same ones
            start = 0
            for i, n in enumerate(_bytes(batch), 1):
                rows, size = rows + 1, size + n
                if rows == every or size >= FILE_BYTES:
                    yield save([*held, batch.slice(start, i - start)])
                    held, rows, size, start = [], 0, 0, i
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield save(held)

    return run


def append_progress(rows: DataFrame, path: str, generate: Callable[[DataFrame], DataFrame], arms: Sequence[str], every: int = EVERY) -> int:
    """O-16: run ``generate`` over what is not yet in ``path`` and save its outputs as it goes; the
    number of outputs that were added.

    ``generate`` gets the rows with their identity (``ROW``) and the arms still to run
    (``PENDING``), and returns outputs with the columns ``ROW`` and ``arm``; it should keep the
    rows in their tasks (as :func:`operators.generate.apply_arms` does), or nothing is saved
    before its last shuffle."""
    spark, path = rows.sparkSession, path.rstrip("/")
    every_arm = F.array(*[F.lit(a) for a in arms])
    todo = identified(rows)
    done = read_progress(spark, path)
    if done is None:
        todo = todo.withColumn(PENDING, every_arm)
    else:
        finished = done.groupBy(ROW).agg(F.collect_set("arm").alias("_done"))
        left = F.when(F.col("_done").isNull(), every_arm).otherwise(F.array_except(every_arm, F.col("_done")))
        todo = todo.join(finished, ROW, "left").withColumn(PENDING, left).drop("_done").where(F.size(PENDING) > 0)
    outputs = generate(todo.repartition(ROW).sortWithinPartitions(ROW))
    if not {ROW, "arm"} <= set(outputs.columns):
        raise ValueError(f"the outputs lack the column {ROW} or arm")
    saved = outputs.mapInArrow(_save(path, every), "file string, outputs long")
    return saved.agg(F.sum("outputs")).first()[0] or 0
