"""Next-fit request batching under a byte budget (O-40), without a sequential pass.

Reference rule, per shard, items in order: a batch takes items while the running byte
total stays within ``budget``; the first item that does not fit closes it and opens the
next batch. An item that alone exceeds the budget stops the packing of its shard (all
later items stay unassigned). At most ``max_batches`` batches, if given.

The walk looks sequential, but what a stretch of items does depends on one number only: the
bytes in the open batch where the stretch begins. Items are range-partitioned by (shard,
order) into blocks. A block's task turns the stretch of a shard at its edge into a map from
entry bytes to exit bytes and opened batches: the entry decides which item is the first that
does not fit, and from there on all is fixed, so the map has one piece for each item of a
first batch at most, and fewer once walks have met. The maps of a shard, one a block, are
then read in order, one lookup each, which gives every block's entry; with it each block
numbers its own items. A shard inside one block needs no map.

Only ``(shard, order, size)`` enter the exchange; payload bytes never do. The blocks are written
once (reliable checkpoint), a shard may be spread over any number of them, and the driver
sees one entry for each block edge.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .ordered import default_blocks, materialize

#: Entry or exit of a shard that an oversized item has stopped.
STOPPED = -1


class StretchMap(NamedTuple):
    """Entry bytes up to ``upto[i]`` (and above those before) leave with ``exit[i]`` bytes after
    ``opened[i]`` new batches; a piece without new batches adds its ``exit`` to the entry."""

    upto: list[int]
    exit: list[int]
    opened: list[int]

    def follow(self, fill: int) -> tuple[int, int]:
        if fill == STOPPED:
            return STOPPED, 0
        i = bisect_left(self.upto, fill)
        return (self.exit[i] if self.opened[i] or self.exit[i] == STOPPED else fill + self.exit[i]), self.opened[i]


def stretch_map(sizes: np.ndarray, budget: int) -> StretchMap:
    """What items of ``sizes`` in a row do to the open batch."""
    if (sizes > budget).any():
        return StretchMap([budget], [STOPPED], [0])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    n = len(sizes)
    after = (np.searchsorted(ends, ends[:-1] + budget, "right") - 1).tolist()  # a batch from item i ends before it
    total = ends.tolist()
    left, opened = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        j = after[i]
        left[i], opened[i] = (total[n] - total[i], 1) if j == n else (left[j], opened[j] + 1)
    first = int(np.searchsorted(ends, budget, "right")) - 1  # items that fit an empty batch
    pieces = [(budget - total[n], total[n], 0)] if first == n else []
    # the more bytes there are already, the earlier the first item that does not fit
    pieces += [(budget - total[i], left[i], opened[i]) for i in range(min(first, n - 1), -1, -1)]
    kept = [p for p, q in zip(pieces, [*pieces[1:], None]) if q is None or p[1:] != q[1:] or not p[2]]
    return StretchMap(*map(list, zip(*kept)))


def _edges(budget: int):
    """A block's rows in order -> the maps of its first and its last shard's stretch."""

    def run(batches):
        now, held, first = None, [], True

        def told():
            m = stretch_map(np.concatenate(held), budget)
            return pd.DataFrame({"_key": [now[1]], "_blk": [now[0]], "upto": [m.upto], "exit": [m.exit], "opened": [m.opened]})

        for pdf in batches:
            for key, part in _runs(pdf):
                if key != now:
                    if now is not None and first:
                        yield told()
                    first, now, held = now is None, key, []
                held.append(part["_size"].to_numpy())
        if now is not None:
            yield told()

    return run


def _runs(pdf: pd.DataFrame):
    """Stretches of one block and shard: ((block, shard), rows)."""
    if not len(pdf):
        return
    new = (pdf["_blk"] != pdf["_blk"].shift()) | (pdf["_key"] != pdf["_key"].shift())
    starts = np.flatnonzero(new.to_numpy())
    for a, b in zip(starts, [*starts[1:], len(pdf)]):
        yield (int(pdf["_blk"].iloc[a]), pdf["_key"].iloc[a]), pdf.iloc[a:b]


def _entries(batches):
    """Maps of a shard in block order -> the entry of each of its blocks but the first."""
    now, fill, batch = None, 0, 0
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            if row.key != now:
                now, fill, batch = row.key, 0, 0
            else:
                out.append((row.key, row.block, fill, batch))
            m = StretchMap(list(row.upto), list(row.exit), list(row.opened))
            fill, more = m.follow(fill)
            batch += more
        yield pd.DataFrame(out, columns=["key", "block", "fill", "batch"])


def _number(budget: int, entries: dict, max_batches: int | None):
    """Rows of blocks in order -> their batch and, for those without one, why."""

    def run(batches):
        now, fill, batch = None, 0, 0
        for pdf in batches:
            numbers, reasons = np.full(len(pdf), -1, np.int64), np.full(len(pdf), None, object)
            at = 0
            for key, part in _runs(pdf):
                if key != now:
                    fill, batch = entries.get(key, (0, 0))
                    now = key
                sizes = part["_size"].to_numpy()
                large = np.flatnonzero(sizes > budget)
                end = 0 if fill == STOPPED else int(large[0]) if len(large) else len(sizes)
                ends = np.cumsum(sizes[:end])
                i, before = 0, 0
                while i < end:
                    j = int(np.searchsorted(ends, before + budget - fill, "right"))
                    numbers[at + i:at + j] = batch
                    if j < end:
                        batch, fill = batch + 1, 0
                    else:
                        fill += int(ends[-1]) - before
                    i, before = j, int(ends[j - 1]) if j else 0
                if end < len(sizes):
                    fill = STOPPED
                    reasons[at + end:at + len(sizes)] = "after_oversize"
                    reasons[at + large] = "oversize"
                at += len(part)
            if max_batches is not None:
                reasons[numbers >= max_batches] = "batch_limit"
                numbers[numbers >= max_batches] = -1
            given = pd.Series(numbers, index=pdf.index, dtype="Int64").mask(numbers < 0)
            yield pdf.drop(columns=["_blk", "_key"]).assign(batch=given, reason=reasons)

    return run


def pack_batches(items: DataFrame, order: Sequence[str], size: str, budget: int = K.BATCH_BUDGET_BYTES,
                 max_batches: int | None = None, shard: str | None = None,
                 oversize: str = "stop", blocks: int | None = None) -> DataFrame:
    """Assign ``batch`` (0-based, null = not sent) to every item.

    ``oversize='stop'`` is the original rule; ``'skip'`` packs the rest and returns items
    larger than the budget with a null batch. ``max_batches`` (the original's is
    ``constants.MAX_BATCHES``) is off unless given; items beyond it have a null batch.
    Output: ``shard`` (if given), ``order`` columns, ``size``, ``batch``, ``reason`` (null if
    sent, else ``oversize``, ``after_oversize`` or ``batch_limit``).
    """
    if oversize not in ("stop", "skip"):
        raise ValueError(f"unknown oversize policy {oversize!r}")
    order, keys = list(order), [shard] if shard else []
    # nulls are a shard of their own: as text, a null and any value differ
    key = F.when(F.col(shard).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(shard).cast("string"))) if shard else F.lit("v")
    base = items.select(*keys, *order, F.col(size).cast("long").alias("_size"), key.alias("_key"))
    too_large = base.filter(F.col("_size") > budget)
    if oversize == "skip":
        base = base.filter(F.col("_size") <= budget)
    n = blocks or default_blocks(items.sparkSession)
    ranged = base.repartitionByRange(n, "_key", *order).withColumn("_blk", F.spark_partition_id()).sortWithinPartitions("_key", *order)
    placed = materialize(ranged)  # blocks stay what they are for both passes
    maps = placed.select("_key", "_blk", "_size").mapInPandas(_edges(budget), "_key string, _blk int, upto array<long>, exit array<long>, opened array<long>")
    chains = maps.select(F.col("_key").alias("key"), F.col("_blk").alias("block"), "upto", "exit", "opened").repartition("key").sortWithinPartitions("key", "block")
    # one entry for each block edge at most
    known = {(r["block"], r["key"]): (r["fill"], r["batch"]) for r in chains.mapInPandas(_entries, "key string, block int, fill long, batch long").collect()}
    schema = ", ".join(f"`{c}` {t}" for c, t in base.dtypes if c != "_key") + ", batch long, reason string"
    out = placed.mapInPandas(_number(budget, known, max_batches), schema)
    kept = [*keys, *order, F.col("_size").alias(size)]
    out = out.select(*kept, "batch", "reason")
    if oversize == "skip":
        out = out.unionByName(too_large.select(*kept, F.lit(None).cast("long").alias("batch"), F.lit("oversize").alias("reason")))
    return out
