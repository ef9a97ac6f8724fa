"""Batch results: keyed lines, last write per key, answer fields, sidecars
(O-14, O-46, O-53, O-56, O-60..O-63)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import responses as R
from ..functions import text as T


def last_per_key(df: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """O-46: keep the last row per ``key`` in ``order`` (a later line overwrites).

    ``max_by`` under ``groupBy`` aggregates partially on the map side, so a key
    repeated in a third of all rows is pre-reduced before the shuffle.
    """
    order_cols = [order] if isinstance(order, str) else list(order)
    ord_expr = F.struct(*[F.col(c) for c in order_cols]) if len(order_cols) > 1 else F.col(order_cols[0])
    others = [c for c in df.columns if c != key]
    agg = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in others]), ord_expr).alias("_last"))
    return agg.select(key, *[F.col("_last")[c].alias(c) for c in others])


def parse_result_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """O-04 / O-60: parse result lines; adds ``custom_id`` (``unknown_id`` if absent),
    ``content``, ``has_choices`` and ``malformed`` (text that is not JSON)."""
    rec = R.parse_response(F.col(line))
    malformed = F.try_parse_json(F.col(line)).isNull()
    return lines.select(
        "*",
        F.coalesce(rec["custom_id"], F.lit(K.UNKNOWN_ID)).alias("custom_id"),
        R.response_content(rec).alias("content"),
        (~malformed & R.has_choices(rec)).alias("has_choices"),
        malformed.alias("malformed"),
    )


def answer_sidecars(parsed: DataFrame, mode: str = "regex") -> DataFrame:
    """O-61 / O-62 / O-53 / O-56 / O-14: fields of each answer and the tagged sidecar
    (path from the key, five labelled lines). Rows without choices keep null fields."""
    f = R.extract_answer_fields(F.col("content"), mode)
    out = parsed.withColumn("_f", F.when(F.col("has_choices"), f))
    side = T.key_to_sidecar(F.col("custom_id"))
    content = T.format_tagged(F.col("_f.ocr_text"), F.col("_f.summary"), F.col("_f.date"),
                              F.col("_f.is_printed"), F.col("_f.is_legible"))
    return out.select("*", F.col("_f.*"), side["sidecar_path"].alias("sidecar_path"),
                      F.when(F.col("has_choices"), content).alias("sidecar")).drop("_f")


def collect_results(lines: DataFrame, order: str = "line_no", mode: str = "regex") -> DataFrame:
    """Result lines -> one answer row per key (last line wins) with fields and sidecar.

    Malformed lines are left out here; take them with :func:`malformed_lines`.
    """
    p = parse_result_lines(lines).filter(~F.col("malformed"))
    last = last_per_key(p.select("custom_id", order, "content", "has_choices"), "custom_id", order)
    return answer_sidecars(last, mode)


def malformed_lines(lines: DataFrame) -> DataFrame:
    """O-15 for result files: lines that are not JSON (quarantine)."""
    return parse_result_lines(lines).filter(F.col("malformed"))


def failed_keys(collected: DataFrame) -> DataFrame:
    """Keys whose (last) answer has no choices, listed once."""
    return collected.filter(~F.col("has_choices")).select("custom_id")
