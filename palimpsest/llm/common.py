"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Characters that one step of a task holds as Python objects; longer single texts are a step of their own.
STEP_CHARS = 8_000_000


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new shared folder and read back: cuts the lineage and
    is computed once however often it is read."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def steps(batches, sizes: str = "text", limit: int = STEP_CHARS):
    """Slices of Arrow record batches whose column ``sizes`` holds about ``limit`` bytes, so
    that a batch of very long texts does not become Python objects all at once."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(batch.schema.get_field_index(sizes))
        lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i in range(n):
            held += int(lengths[i])
            if held >= limit:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
        if start < n:
            yield batch.slice(start)


def held_out(column, folds: int, fold: int):
    """True where crc32 of the id as text leaves ``fold`` modulo ``folds`` (null ids: false)."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1, ..: no name can clash with another or with a helper's."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def place_of(df: DataFrame, name: str) -> str:
    """The numbered name of a column; the first one counts if the name is given twice."""
    if name not in df.columns:
        raise ValueError(f"missing column {name}")
    return f"c{df.columns.index(name)}"


def plain_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, also where other columns differ from them but by case."""
    return numbered(df).select(*[F.col(place_of(df, n)).alias(n) for n in names])
