"""Lines of text files with their exact numbers, read by many tasks (O-04).

Spark's text reader cuts a large file at block borders, so a task knows a line's place in its
block but not in the file. :func:`numbered_lines` reads the files twice: the first pass counts
the lines of each block (no text leaves the scan), a running sum over a file's blocks gives
each block's first number, and the second pass adds it to a line's place in its block. The
table of blocks is broadcast up to ``BLOCKS_SENT`` rows; beyond that the lines meet it in a join.

Both passes must see the same blocks in the same tasks. A line that does not lie where the
first pass has counted (a file was changed, or splits were set differently in between) stops
the read: numbers are right or there are none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordered import materialize

#: Most blocks whose first numbers are sent to every executor (about 100 bytes each).
BLOCKS_SENT = 200_000


def _scan(spark: SparkSession, path: str | list[str], suffix: str) -> DataFrame:
    files = spark.read.option("pathGlobFilter", f"*{suffix}").option("lineSep", "\n").text(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def numbered_lines(spark: SparkSession, path: str | list[str], suffix: str = "", contains: str | None = None) -> DataFrame:
    """(file, line_no, line): the lines of the files in ``path`` with ``suffix``, numbered from 0 in
    each file; blank ones count but are not returned. ``contains``: only files with this in
    their name."""
    lines = _scan(spark, path, suffix)
    if contains is not None:
        lines = lines.where(F.col("file").contains(contains))
    counts = lines.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("at").alias("start"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = materialize(counts.select("path", "block", "start", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    small = blocks.count() <= BLOCKS_SENT
    met = lines.join(F.broadcast(blocks) if small else blocks, ["path", "block"], "left")
    place = F.col("at") - F.col("start")
    lost = F.raise_error(F.concat(F.lit("the blocks changed while reading "), "path")).cast("long")
    number = F.when((place >= 0) & (place < F.col("n")), F.col("first") + place).otherwise(lost)
    return met.where(F.btrim("line") != "").select("file", number.alias("line_no"), "line")
