"""Per-key sequential rules as distributed scans: the no-op guard (O-41) and the
batch-poll ledger (O-79, batch form).

Both are gaps-and-islands problems. They are evaluated with
:func:`ordered.prefix_scan`, so a key (arm, batch) holding a large share of all rows is
spread over many tasks, and the per-key "first event" is an aggregate (``min_by``)
that combines partially before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from .ordered import prefix_scan


def no_op_guard(df: DataFrame, keys: Sequence[str], order: Sequence[str], same: str | Column,
                k: int = 5, eligible: str | Column | None = None) -> DataFrame:
    """O-41: stop an arm after ``k`` consecutive outputs equal to the untuned output.

    Only ``eligible`` rows (image present and cell still empty) are compared: they add
    to the streak when ``same`` and reset it otherwise; other rows neither count nor
    reset. The row whose streak reaches ``k`` breaks the loop before it is written,
    so it and every later row of the arm get ``written = false``.
    Adds ``streak`` (consecutive equal outputs so far) and ``written``.
    """
    keys, order = list(keys), list(order)
    same_c = F.col(same) if isinstance(same, str) else same
    elig = F.lit(True) if eligible is None else (F.col(eligible) if isinstance(eligible, str) else eligible)
    base = df.withColumn("_same", elig & same_c).withColumn("_diff", elig & ~same_c)
    a = prefix_scan(base, keys, order, {"_cs": ("sum", F.col("_same").cast("long"))})
    b = prefix_scan(a, keys, order, {"_last": ("max", F.when(F.col("_diff"), F.col("_cs")))})
    b = b.withColumn("streak", F.when(F.col("_same"), F.col("_cs") - F.coalesce(F.col("_last"), F.lit(0)))
                     .otherwise(F.lit(0)).cast("long"))
    c = prefix_scan(b, keys, order, {"_broken": ("max", (F.col("_same") & (F.col("streak") >= k)).cast("int"))})
    return c.withColumn("written", F.col("_broken") == 0).drop("_same", "_diff", "_cs", "_last", "_broken")


def batch_ledger(polls: DataFrame, batch: str = "batch_id", order: Sequence[str] = ("ts", "event_id"),
                 status: str = "status", retry_limit: int = K.BATCH_RETRY_LIMIT,
                 terminal: Sequence[str] = K.BATCH_TERMINAL) -> DataFrame:
    """O-79 (batch form): outcome of polling each batch.

    A terminal status ends the batch with that status. A non-terminal poll when
    ``attempts`` already reached ``retry_limit`` gives up; otherwise attempts + 1. No end
    yet -> ``pending``. Output: ``batch, outcome, attempts, polls, download``.
    """
    order = list(order)
    term = F.col(status).isin(list(terminal))
    s = prefix_scan(polls.select(batch, *order, status), [batch], order,
                    {"_nt": ("sum", (~term).cast("long")), "_rn": ("sum", F.lit(1).cast("long"))})
    is_end = term | (F.col("_nt") > retry_limit)
    ends = (s.filter(is_end)
            .groupBy(batch)
            .agg(F.min_by(F.struct(F.col(status).alias("st"), F.col("_nt").alias("nt"), F.col("_rn").alias("rn"),
                                   (~F.col(status).isin(list(terminal))).alias("gave_up")),
                          F.struct(*[F.col(o) for o in order])).alias("_e")))
    totals = polls.groupBy(batch).agg(F.count(F.lit(1)).cast("long").alias("_n"),
                                      F.count_if(~term).cast("long").alias("_ntt"))
    j = totals.join(ends, batch, "left")
    outcome = (F.when(F.col("_e").isNull(), F.lit("pending"))
               .when(F.col("_e.gave_up"), F.lit("given_up")).otherwise(F.col("_e.st")))
    attempts = F.when(F.col("_e").isNull(), F.col("_ntt")).when(F.col("_e.gave_up"), F.lit(retry_limit).cast("long")
                                                                ).otherwise(F.col("_e.nt"))
    polls_used = F.coalesce(F.col("_e.rn"), F.col("_n"))
    return j.select(batch, outcome.alias("outcome"), attempts.cast("long").alias("attempts"),
                    polls_used.cast("long").alias("polls"), (outcome == "completed").alias("download"))
