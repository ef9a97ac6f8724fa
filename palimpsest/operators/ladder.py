"""Arms, size ladders, splits, shards and chunks (O-28, O-42, O-44, O-45, O-47..O-50).

Global ranks use :func:`ordered.row_number` (range-partitioned blocks plus offsets),
never a window without ``PARTITION BY`` over a whole table. The first-N ladder finds the
order key of its last row on narrow keys, filters by it and ranks only those rows; repeated
and null keys (nulls first) are rows like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from .ordered import row_number

def arm_grid(spark: SparkSession, labels: Sequence[str] = K.ARM_LABELS, sizes: Sequence[int] = K.ARM_SIZES,
             base_dir: str = "work") -> DataFrame:
    """O-28: label x size arms with the arm name, folders and short job name.

    Built by exploding two parameter arrays (one row per arm), not by a join.
    """
    short = F.create_map(*[F.lit(x) for kv in K.ARM_SIZE_SHORT.items() for x in kv])
    g = (spark.range(1)
         .select(F.explode(F.array(*[F.lit(x) for x in labels])).alias("label"))
         .select("label", F.explode(F.array(*[F.lit(int(s)) for s in sizes])).alias("size")))
    arm = F.concat_ws("_", "label", F.col("size").cast("string"))
    size_short = F.coalesce(F.element_at(short, F.col("size")), F.col("size").cast("string"))
    return g.select(
        "label", "size", arm.alias("arm"),
        F.concat(F.substring("label", 1, 1), F.lit("_"), size_short, F.lit("_l")).alias("short_name"),
        F.concat(F.lit(base_dir + "/"), arm).alias("folder"),
        F.concat(F.lit(base_dir + "/tuning_results_"), arm).alias("output_dir"),
    )


def size_ladder(df: DataFrame, order: Sequence[str], sizes: Sequence[int] = K.ARM_SIZES,
                labels: Sequence[str] = K.ARM_LABELS, complete_only: bool = False) -> DataFrame:
    """O-44: nested first-``size`` prefixes of ``df`` in ``order``, one copy per arm.

    Adds ``label, size, arm, rn, n_rows, complete`` and ``target`` (the label column).
    ``complete`` is ``n_rows >= size``; the exporter skips incomplete arms
    (``complete_only``), the tokeniser takes what there is.
    """
    top_n = max(sizes)
    # the order key of row top_n, from the narrow keys; rows beyond it are never ranked
    keys = row_number(df.select(*order), order, name="_r", totals=True)
    last = keys.filter(F.col("_r") == F.least(F.col("_r_total"), F.lit(top_n))).first()
    bound = F.struct(*[F.lit(last[c] if last else None).cast(df.schema[c].dataType).alias(c) for c in order])
    near = df.filter((F.struct(*order) <= bound) if last else F.lit(False))
    ranked = row_number(near, order, name="rn").filter(F.col("rn") <= top_n).withColumn(
        "n_rows", F.lit(min(last["_r_total"], top_n) if last else 0))
    arms = F.array(*[F.struct(F.lit(lab).alias("label"), F.lit(int(s)).alias("size")) for lab in labels for s in sizes])
    out = ranked.withColumn("_arm", F.explode(F.filter(arms, lambda a: a["size"] >= F.col("rn"))))
    out = out.select("*", F.col("_arm.label").alias("label"), F.col("_arm.size").alias("size")).drop("_arm")
    out = out.withColumn("arm", F.concat_ws("_", "label", F.col("size").cast("string")))
    out = out.withColumn("n_rows", F.least(F.col("n_rows"), F.col("size")).cast("long"))
    out = out.withColumn("complete", F.col("n_rows") >= F.col("size"))
    target = None
    for lab in labels:
        target = (F.when(F.col("label") == lab, F.col(lab)) if target is None
                  else target.when(F.col("label") == lab, F.col(lab)))
    out = out.withColumn("target", target)
    return out.filter("complete") if complete_only else out


def split_80_10_10(df: DataFrame, key: str = "id", by: Sequence[str] = ("arm",), seed: int = K.SPLIT_SEED,
                   test_frac: float = 0.2, mode: str = "exact") -> DataFrame:
    """O-45: seeded train / val / test split per ``by`` group.

    ``exact``: held = ceil(test_frac * n), test = ceil(held / 2), val = held - test. Rows
    are ranked by ``md5(seed || '|' || key)`` (ties by key) with a distributed row number;
    the first ``n - held`` are train, the next ``val`` are val, the rest test. With
    ``by=()`` the split is computed once on the whole set (the same key gets the same
    split in every arm). ``threshold``: the hash read as a uniform number in [0, 1) picks
    the split row by row - no shuffle, sizes only approximately 80/10/10.
    """
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    if mode == "threshold":
        u = F.conv(F.substring(h, 1, 13), 16, 10).cast("double") / float(16 ** 13)
        split = (F.when(u < 1 - test_frac, F.lit("train")).when(u < 1 - test_frac / 2, F.lit("val"))
                 .otherwise(F.lit("test")))
        return df.withColumn("split", split)
    if mode != "exact":
        raise ValueError(f"unknown split mode {mode!r}")
    ranked = row_number(df.withColumn("_h", h), ["_h", key], keys=list(by), name="_r", totals=True)
    n = F.col("_r_total")
    held = F.ceil(n * F.lit(test_frac)).cast("long")
    test_n = F.ceil(held / F.lit(2)).cast("long")
    val_n = held - test_n
    split = (F.when(F.col("_r") <= n - held, F.lit("train"))
             .when(F.col("_r") <= n - held + val_n, F.lit("val")).otherwise(F.lit("test")))
    return ranked.withColumn("split", split).drop("_h", "_r", "_r_total")


def assign_shards(df: DataFrame, order: Sequence, tasks: int, mode: str = "balanced") -> DataFrame:
    """O-42: contiguous shards over the ordered rows.

    ``drop`` (only to reproduce the original job array): ``max(1, N // tasks)`` rows per
    shard; rows of shards >= ``tasks`` get a null shard, so the remainder can be seen. ``last``: ``N // tasks`` per shard,
    the remainder to the last shard. ``balanced`` (default): ``rn * tasks // N``, nothing
    lost, sizes differ by at most one.
    """
    r = row_number(df, order, name="_rn", totals=True)
    rn0 = F.col("_rn") - 1
    n = F.col("_rn_total")
    if mode == "drop":
        per = F.greatest(F.lit(1), F.floor(n / tasks).cast("long"))
        shard = F.floor(rn0 / per).cast("long")
        out = r.withColumn("shard", F.when(shard < tasks, shard))
    elif mode == "last":
        per = F.floor(n / tasks).cast("long")
        shard = F.when(per == 0, F.lit(tasks - 1)).otherwise(F.least(F.floor(rn0 / per), F.lit(tasks - 1)))
        out = r.withColumn("shard", shard.cast("long"))
    elif mode == "balanced":
        out = r.withColumn("shard", F.floor(rn0 * F.lit(tasks) / n).cast("long"))
    else:
        raise ValueError(f"unknown shard mode {mode!r}")
    return out.withColumn("rn", F.col("_rn")).drop("_rn", "_rn_total")


def chunk_id(df: DataFrame, order: Sequence, every: int = 100, by: Sequence[str] = ()) -> DataFrame:
    """O-47: save points every ``every`` rows: ``chunk = (rn - 1) // every`` and
    ``save_point = rn % every == 0`` (per ``by`` group)."""
    r = row_number(df, order, keys=list(by), name="rn")
    return r.withColumn("chunk", F.floor((F.col("rn") - 1) / every).cast("long")).withColumn(
        "save_point", F.col("rn") % every == 0)


def sort_by(df: DataFrame, *cols) -> DataFrame:
    """O-48: global sort (range-partitioned; binary UTF-8 order = code-point order)."""
    return df.orderBy(*cols)


def first_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """O-49: first ``n`` rows in an explicit order (top-k, not an arbitrary limit)."""
    return df.orderBy(*order).limit(n)


def union_outputs(parts: Sequence[DataFrame], order: Sequence, name: str = "original_index") -> DataFrame:
    """O-50: concatenate per-worker outputs and renumber by a global order (0-based)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return row_number(out, order, name="_rn").withColumn(name, F.col("_rn") - 1).drop("_rn")

