"""Token ids in ORC files: integers run-length encoded, row indexes and a Bloom filter on
the document ids, so that a reader skips stripes and row groups by their metadata and reads
the stripes of a file in parallel.

Documents are range-partitioned by id and sorted inside each part, so a file is one range
of ids. Defined results: null text counts as empty (the end id alone); a null id sorts
first; repeated rows are written each; an empty table gives files without rows; other
columns are ignored."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import plain_columns, steps, stored
from .tokens import STEP_CHARS, document_encoder

SCHEMA = "block int, pos long, doc_id long, ids array<int>"


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, blanks_kept: bool) -> DataFrame:
    """``docs`` -> (block, pos, doc_id, ids): ids with the end id, in ascending doc_id order
    over ``block`` and ``pos``."""

    def run(batches):
        encode = document_encoder(tokenizer, blanks_kept).encode
        end = end_id.to_bytes(4, "little")
        pos = 0
        for part in steps(batches, limit=STEP_CHARS):
            ids = encode(part.column(1).to_pylist())
            lengths = np.array([len(x) // 4 + 1 for x in ids])
            flat = np.frombuffer(b"".join([x + end for x in ids]), "<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [part.column(2), pa.array(np.arange(pos, pos + len(ids))), part.column(0), lists],
                names=["block", "pos", "doc_id", "ids"])
            pos += len(ids)

    ordered = plain_columns(docs, "doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return ordered.withColumn("block", F.spark_partition_id()).mapInArrow(run, SCHEMA)


def write_tokens(ids: DataFrame, path: str, stripe_bytes: int = 64 << 20, index_rows: int = 10_000) -> None:
    """``encode_documents`` -> ORC files at ``path``."""
    (ids.write.format("orc")
     .option("compression", "zstd")
     .option("orc.stripe.size", str(stripe_bytes))
     .option("orc.create.index", "true")
     .option("orc.row.index.stride", str(index_rows))
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", "0.01")
     .save(path))


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files' rows; with ``doc_ids`` only theirs, found through indexes and Bloom filters."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin([int(x) for x in doc_ids]))


def digests(rows: DataFrame) -> DataFrame:
    """``read_tokens`` -> (doc_id, start, n_tokens, ids_crc32); ``start`` counts the ids of all
    documents before it."""

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            crc = [zlib.crc32(flat[b - n:b]) for b, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(lengths), pa.array(crc, pa.int64())],
                names=["block", "pos", "doc_id", "n_tokens", "ids_crc32"])

    each = stored(rows.mapInArrow(run, "block int, pos long, doc_id long, n_tokens long, ids_crc32 long"), "digests")
    # one row for each block: its ids, and the ids of the blocks before it
    blocks = each.groupBy("block").agg(F.sum("n_tokens").alias("n"))
    before = blocks.select("block", (F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    return (each.withColumn("upto", inside).join(F.broadcast(before), "block")
            .select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"))
