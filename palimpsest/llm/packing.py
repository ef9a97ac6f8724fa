"""Best-fit packing of token pieces into sequences, in bulk-synchronous rounds.

A round sorts pieces and open gaps together by size, largest first, over range partitions
(blocks). Inside a block one sweep places each piece into the smallest gap that holds it.
Pieces that found none there succeed to the gaps left over by the blocks of larger sizes:
the blocks' counts (one row for each block) decide by rank which piece takes which gap, the
last gaps of the nearest block first. Then gaps are updated and the round repeats. Where
few pieces find a gap, the largest of the rest open as many sequences as the volume of the
rest needs. A gap of another block takes as many pieces in a round as its size surely holds.

Defined results: null text counts as empty (the end id alone); repeated rows and ids are
packed each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import heapq
import math
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import plain_columns, steps, stored
from .tokens import STEP_CHARS, document_encoder

#: Pieces and gaps of a block.
BLOCK_ROWS = 100_000
PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
#: A round opens sequences if fewer than one piece in this many found a gap.
OPEN_BELOW = 20


def pieces(docs: DataFrame, tokenizer: str, end_id: int, blanks_kept: bool, capacity: int) -> DataFrame:
    """``docs`` -> their pieces of at most ``capacity`` ids; of a longer document all but the
    first piece are full."""

    def run(batches):
        encode = document_encoder(tokenizer, blanks_kept).encode
        end = end_id.to_bytes(4, "little")
        uid = TaskContext.get().partitionId() << 40
        for part in steps(batches, limit=STEP_CHARS):
            rows = []
            for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                cuts = [0, *range(first, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((uid, doc_id, piece, a, b - a, zlib.crc32(ids[4 * a:4 * b])))
                    uid += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["uid", "doc_id", "piece", "start", "length", "ids_crc32"])

    return plain_columns(docs, "doc_id", "text").mapInArrow(run, PIECES)


GAP, ITEM, PLACED, ASIDE = 0, 1, 2, 3
_SWEPT = "block int, kind int, id long, size long, mate long, place long, rank long"


def _sweep(capacity: int):
    """Rows sorted by size, largest first, gaps before pieces. Out: pieces placed (mate: the
    sequence, place: the offset), pieces and gaps left over (rank: their order), and gaps
    that became smaller than the block's pieces (aside)."""

    def run(batches):
        stack: list[tuple[int, int]] = []
        waiting: list[tuple[int, int]] = []
        out: list[tuple] = []
        block = left = least = 0
        for batch in batches:
            block = batch.column(3)[0].as_py() if batch.num_rows else block
            for kind, name, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                least = size
                while waiting and -waiting[0][0] >= size:
                    gap, seq = heapq.heappop(waiting)
                    stack.append((-gap, seq))
                if kind == GAP:
                    stack.append((size, name))
                elif stack:
                    gap, seq = stack.pop()
                    out.append((block, PLACED, name, size, seq, capacity - gap, None))
                    gap -= size
                    if gap >= size:
                        stack.append((gap, seq))
                    elif gap:
                        heapq.heappush(waiting, (-gap, seq))
                else:
                    out.append((block, ITEM, name, size, None, None, left))
                    left += 1
        out += [(block, GAP, seq, gap, None, None, i) for i, (gap, seq) in enumerate(stack)]
        out += [(block, ASIDE, seq, -gap, None, None, None) for gap, seq in waiting]
        types = (pa.int32(), pa.int32(), *[pa.int64()] * 5)
        for i in range(0, len(out), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out[i:i + 100_000]), types)],
                                             names=["block", "kind", "id", "size", "mate", "place", "rank"])

    return run


def _carry(blocks: list[dict]) -> tuple[list[tuple], dict[int, int], dict[int, int]]:
    """Blocks in order with their left-over pieces and gaps -> which ranks of a block's pieces
    take which gaps of an earlier one (block, from, to, gap block, top rank, pieces a gap);
    pieces taken of each block; gaps left of each block."""
    stack: list[list[int]] = []
    runs, taken, left = [], {}, {}
    for b in blocks:
        rank = 0
        while rank < b["items"] and stack:
            a, gaps, least = stack[-1]
            each = max(1, least // b["largest"])
            use = min(gaps, -(-(b["items"] - rank) // each))
            upto = min(b["items"], rank + use * each)
            runs.append((b["block"], rank, upto, a, gaps - 1, each))
            rank, stack[-1][1] = upto, gaps - use
            if not stack[-1][1]:
                stack.pop()
        taken[b["block"]] = rank
        if b["gaps"]:
            stack.append([b["block"], b["gaps"], b["smallest"]])
    left.update({a: gaps for a, gaps, _ in stack})
    return runs, taken, left


def _in_blocks(state: DataFrame) -> DataFrame:
    """``state`` (kind, id, size) dealt to ranges of descending size of about ``BLOCK_ROWS``
    rows and sorted there. The ranges come from the counts of each size (at most two rows
    for each size up to the capacity); a size with more rows is split by id."""
    spark = state.sparkSession
    counts = state.groupBy("size", "kind").agg(F.count("*").alias("n")).orderBy(F.desc("size"), "kind").collect()
    ranges, block, held = [], 0, 0
    for r in counts:
        if held and held + r["n"] > BLOCK_ROWS:
            block, held = block + 1, 0
        parts = max(1, -(-r["n"] // BLOCK_ROWS))
        ranges.append((r["size"], r["kind"], block, parts))
        block, held = block + parts - 1, held + r["n"] if parts == 1 else BLOCK_ROWS
    ranges = F.broadcast(spark.createDataFrame(ranges, "size long, kind int, first int, parts int"))
    placed = state.join(ranges, ["size", "kind"]).select(
        "kind", "id", "size", F.expr("cast(first + pmod(xxhash64(id), parts) as int)").alias("block"))
    return placed.repartitionById(block + 1, F.col("block")).sortWithinPartitions(F.desc("size"), "kind", "id")


def best_fit(items: DataFrame, capacity: int) -> DataFrame:
    """``items`` (uid, length; shorter than ``capacity``) -> (uid, sequence_id, offset)."""
    spark = items.sparkSession
    first = items.agg(F.count("*").alias("n"), F.sum("length").alias("v"), F.min("length").alias("m"),
                      F.count_if(F.col("length") * 2 > capacity).alias("big")).first()
    done = items.select("uid", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).where("false")
    if not first["n"]:
        return done
    state = items.select(F.lit(ITEM).alias("kind"), F.col("uid").alias("id"), F.col("length").cast("long").alias("size"))
    opened = max(first["big"], math.ceil(first["v"] / capacity))
    while True:
        swept = stored(_in_blocks(state).mapInArrow(_sweep(capacity), _SWEPT), "swept")
        counts = swept.groupBy("block").agg(
            F.count_if(F.col("kind") == ITEM).alias("items"), F.count_if(F.col("kind") == GAP).alias("gaps"),
            F.count_if(F.col("kind") == PLACED).alias("placed"),
            F.max(F.when(F.col("kind") == ITEM, F.col("size"))).alias("largest"),
            F.min(F.when(F.col("kind") == GAP, F.col("size"))).alias("smallest"),
            F.sum(F.when(F.col("kind") == ITEM, F.col("size"))).alias("volume"))
        blocks = [r.asDict() for r in counts.orderBy("block").collect()]  # one row for each range partition
        runs, taken, left = _carry(blocks)
        matched = sum(b["placed"] for b in blocks) + sum(taken.values())
        rest = sum(b["items"] for b in blocks) - sum(taken.values())
        volume = sum(b["volume"] * (1 - taken[b["block"]] / b["items"]) for b in blocks if b["items"])
        if opened is None:
            opened = max(1, math.ceil(volume / capacity)) if matched * OPEN_BELOW < rest or not matched else 0
        opened = min(opened, rest)
        info, before = [], 0
        for b in blocks:
            info.append((b["block"], taken[b["block"]], left.get(b["block"], 0), before))
            before += b["items"] - taken[b["block"]]
        info = F.broadcast(spark.createDataFrame(info, "block int, taken long, left long, before long"))
        told = swept.join(info, "block")
        items_left = told.where(F.col("kind") == ITEM).where("rank >= taken").withColumn("place", F.expr("before + rank - taken"))
        gaps_left = told.where(F.col("kind") == GAP).where("rank < left").select("id", "size")
        placed = swept.where(F.col("kind") == PLACED).select("id", "mate", "place")
        new = [items_left.where(F.col("place") < opened).select("id", F.col("id").alias("mate"), F.lit(0).cast("long").alias("place"))]
        gaps = [gaps_left, swept.where(F.col("kind") == ASIDE).select("id", "size"),
                items_left.where(F.col("place") < opened).select("id", (F.lit(capacity) - F.col("size")).alias("size"))]
        if runs:
            plan = F.broadcast(spark.createDataFrame(runs, "block int, lo long, hi long, of int, top long, each long"))
            takers = (swept.where(F.col("kind") == ITEM).join(plan, "block").where("rank >= lo and rank < hi")
                      .select("id", "size", "rank", F.col("of").alias("block"), F.expr("top - (rank - lo) div each").alias("gap_rank")))
            offers = swept.where(F.col("kind") == GAP).select("block", F.col("rank").alias("gap_rank"), F.col("id").alias("mate"), F.col("size").alias("gap"))
            crossed = takers.join(offers, ["block", "gap_rank"])
            so_far = F.sum("size").over(Window.partitionBy("mate").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
            new.append(crossed.select("id", "mate", (F.lit(capacity) - F.col("gap") + so_far - F.col("size")).alias("place")))
            gaps.append(crossed.groupBy("mate").agg((F.max("gap") - F.sum("size")).alias("size")).select(F.col("mate").alias("id"), "size"))
        for part in [placed, *new]:
            done = done.union(part.select("id", "mate", "place"))
        if rest <= opened:
            return done
        still = items_left.where(F.col("place") >= opened).select(F.lit(ITEM).alias("kind"), "id", "size")
        room = gaps[0]
        for g in gaps[1:]:
            room = room.union(g)
        state = stored(still.union(room.where(F.col("size") >= first["m"]).select(F.lit(GAP).alias("kind"), "id", "size")), "state")
        opened = None


def pack(docs: DataFrame, tokenizer: str, end_id: int, blanks_kept: bool = True, capacity: int = 1024) -> DataFrame:
    """``docs`` -> one row for each piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    cut = stored(pieces(docs, tokenizer, end_id, blanks_kept, capacity), "pieces")
    full = cut.where(F.col("length") == capacity).withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    part = cut.where(F.col("length") < capacity)
    where = best_fit(part.select("uid", "length"), capacity)
    return full.unionByName(part.join(where, "uid")).drop("uid")
