"""Distributed ordered scans: running sums / maxima and row numbers.

A window ``PARTITION BY key ORDER BY o`` puts all rows of a key into one task, and a
window without ``PARTITION BY`` puts the whole table into one task. Both break when
one key holds a large share of the data. :func:`prefix_scan` computes the same
inclusive running aggregates in three distributed steps:

1. range-partition on ``(keys, order)`` into blocks, so a hot key is spread over many
   blocks (and a global order over all of them);
2. a local running aggregate and a total per ``(block, key)`` (each window group is at
   most one block);
3. exclusive prefix of the block totals for the keys that cross a block boundary (at
   most ``2 * (blocks - 1)`` rows in all), broadcast and joined back on
   ``(block, key)``, then combined with the local value; the rows are not shuffled again.

The block id comes from ``spark_partition_id()`` right after the range exchange. The
blocked frame is checkpointed (reliable checkpoint in ``spark.checkpoint.dir``) before
the summary is taken: two independently planned range exchanges may sample different
bounds for skewed input, and a checkpoint also survives lost executors. Pass narrow
frames (keys, order, values, an id) when rows are wide.

A global row number (:func:`row_number` without keys) needs no window: the rows are range
partitioned and sorted once, a row's place in its partition is counted as the sorted rows
pass, and a table of one row per partition holds the offsets.

``order`` must be a total order within each key (add a unique tie-breaker), as for any
ROWS-framed window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def materialize(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint into the session's checkpoint folder (cuts lineage)."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def default_blocks(spark) -> int:
    """Blocks for a scan: the session's shuffle partition count, else the default parallelism."""
    v = spark.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return max(1, int(v))
    except (TypeError, ValueError):
        return max(1, spark.sparkContext.defaultParallelism)


def _sort_col(o) -> Column:
    return F.col(o) if isinstance(o, str) else o


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    values: Mapping[str, tuple[str, Column]],
    *,
    blocks: int | None = None,
    totals: bool = False,
) -> DataFrame:
    """Add inclusive running aggregates ``values`` (name -> (op, expr)) per ``keys``.

    ``op`` is ``sum``, ``max`` or ``min``. With ``totals=True`` also adds
    ``<name>_total``, the aggregate over the whole key.
    """
    keys = list(keys)
    order = [_sort_col(o) for o in order]
    spark = df.sparkSession
    n = blocks or default_blocks(spark)

    src = df.withColumns({f"_v_{k}": e for k, (_, e) in values.items()})
    ranged = src.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn("_blk", F.spark_partition_id())

    w_run = Window.partitionBy("_blk", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy("_blk", *keys)
    local_cols = {}
    for name, (op, _) in values.items():
        fn = _AGG[op]
        local_cols[f"_loc_{name}"] = fn(f"_v_{name}").over(w_run)
        local_cols[f"_tot_{name}"] = fn(f"_v_{name}").over(w_all)
    local = materialize(ranged.withColumns(local_cols))

    summary = local.groupBy("_blk", *keys).agg(*[F.max(f"_tot_{n_}").alias(f"_tot_{n_}") for n_ in values])
    w_prev = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_blk").rowsBetween(
        Window.unboundedPreceding, -1)
    w_key = Window.partitionBy(*keys) if keys else Window.partitionBy()
    # Only keys that span a block boundary need an offset or a cross-block total. The
    # order is range-partitioned, so each key occupies a contiguous run of blocks and
    # each of the ``blocks - 1`` boundaries is crossed by at most one key: the table below
    # has at most 2 * (blocks - 1) rows, a proven bound, so it is broadcast and the rows
    # themselves are never shuffled for the join.
    spans = summary.withColumn("_nb", F.count(F.lit(1)).over(w_key)).filter(F.col("_nb") > 1)
    off_cols = {}
    for name, (op, _) in values.items():
        fn = _AGG[op]
        off_cols[f"_off_{name}"] = fn(f"_tot_{name}").over(w_prev)
        if totals:
            off_cols[f"_all_{name}"] = fn(f"_tot_{name}").over(w_key)
    offsets = spans.withColumns(off_cols).drop("_nb", *[f"_tot_{n_}" for n_ in values])
    offsets = offsets.select(*[F.col(c).alias(f"_o{c}") if c in keys else F.col(c) for c in offsets.columns])
    offsets = F.broadcast(offsets.withColumnRenamed("_blk", "_o_blk"))
    cond = [local["_blk"] == offsets["_o_blk"]] + [local[k].eqNullSafe(offsets[f"_o{k}"]) for k in keys]
    joined = local.join(offsets, on=cond, how="left")

    out = {}
    for name, (op, _) in values.items():
        loc, off = F.col(f"_loc_{name}"), F.col(f"_off_{name}")
        if op == "sum":
            out[name] = F.coalesce(off, F.lit(0)) + loc
        elif op == "max":
            out[name] = F.greatest(off, loc)
        else:
            out[name] = F.least(off, loc)
        if totals:
            # keys inside one block: their block total is the key total
            out[f"{name}_total"] = F.coalesce(F.col(f"_all_{name}"), F.col(f"_tot_{name}"))
    result = joined.withColumns(out)
    drop = ["_blk", "_o_blk"] + [f"_o{k}" for k in keys]
    for name in values:
        drop += [f"_v_{name}", f"_loc_{name}", f"_tot_{name}", f"_off_{name}", f"_all_{name}"]
    return result.drop(*[c for c in drop if c in result.columns])


#: Bits of ``monotonically_increasing_id`` that hold the row's place in its partition.
_PLACE_BITS = 33


def sorted_blocks(df: DataFrame, order: Sequence, blocks: int | None = None) -> DataFrame:
    """``df`` in contiguous sorted partitions, with ``_m``: partition and place of the row in it."""
    order = [_sort_col(o) for o in order]
    n = blocks or default_blocks(df.sparkSession)
    return df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())


def _global_row_number(df: DataFrame, order: Sequence, name: str, totals: bool, blocks: int | None) -> DataFrame:
    rows = materialize(sorted_blocks(df, order, blocks)).withColumn("_blk", F.shiftright("_m", _PLACE_BITS))
    counts = rows.groupBy("_blk").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each partition, in both windows and in the broadcast
    before = Window.partitionBy().orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_blk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            F.sum("_n").over(Window.partitionBy()).alias("_all"))
    place = F.col("_m").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    out = rows.join(F.broadcast(offsets), "_blk").withColumn(name, F.col("_off") + place + 1)
    if totals:
        out = out.withColumn(f"{name}_total", F.col("_all"))
    return out.drop("_m", "_blk", "_off", "_all")


def row_number(df: DataFrame, order: Sequence, keys: Sequence[str] = (), name: str = "rn",
               totals: bool = False, blocks: int | None = None) -> DataFrame:
    """1-based row number in ``order`` (per ``keys``), distributed; see :func:`prefix_scan`.

    With ``totals=True`` adds ``<name>_total``, the row count of the key.
    """
    if not keys:
        return _global_row_number(df, order, name, totals, blocks)
    return prefix_scan(df, keys, order, {name: ("sum", F.lit(1).cast("long"))}, totals=totals, blocks=blocks)
