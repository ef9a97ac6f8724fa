"""Assembling the parallel-text tables (O-17..O-27, O-31..O-34, O-38).

Joins are equi-joins left to Catalyst/AQE: a null-label filter after a left join lets
``EliminateOuterJoin`` turn it into an inner join, and AQE picks broadcast only when the
runtime size is under the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..functions.nulls import coerce_text
from .ordered import materialize

# ----------------------------------------------------------------- O-52 / O-21 / O-34


def parse_sidecars(sidecars: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """Add the five parsed fields and an ``outcome`` (written / skipped / error)."""
    p = sidecars.withColumns(T.parse_tagged_fields(content))
    keep = F.col("printed") & F.col("legible") & (F.col("ocr_text") != "")
    outcome = (F.when(F.col(content).isNull(), F.lit("error"))
               .when(keep, F.lit("written")).otherwise(F.lit("skipped")))
    return p.withColumn("outcome", outcome)


def clean_silver(sidecars: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """Silver table ``(ID, ocr)``: printed and legible, non-empty, newlines escaped.

    ``ID`` is the file name with every ``.txt`` removed (so it still ends in ``.jpg``).
    """
    p = parse_sidecars(sidecars, name, content)
    return p.filter(F.col("outcome") == "written").select(
        T.doc_key(name, "drop_txt").alias("ID"), T.escape_newlines("ocr_text").alias("ocr"))


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """O-15: good rows and error rows of one parsed frame."""
    return parsed.filter(F.col("outcome") != "error"), parsed.filter(F.col("outcome") == "error")


def parse_report(sidecars: DataFrame, name: str = "name", content: str = "content") -> DataFrame:
    """O-34: number of sidecars written, skipped and in error."""
    return (parse_sidecars(sidecars, name, content).groupBy("outcome")
            .agg(F.count(F.lit(1)).cast("long").alias("n")))


# ----------------------------------------------------------------- O-17 / O-19 / O-20


def project_rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """O-17: keep and rename the mapped columns only."""
    return df.select(*[F.col(a).alias(b) for a, b in mapping.items()])


def filter_complete(df: DataFrame, cols: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """O-20: drop rows with a null in ``required`` and rows where any of ``cols`` is ``''``."""
    out = df.dropna(subset=list(required)) if required else df
    cond = F.lit(True)
    for c in cols:
        cond = cond & (F.col(c) != "")
    return out.filter(cond)


# ----------------------------------------------------------------- O-23 / O-24


def join_gold_silver(gold: DataFrame, silver: DataFrame, legacy_null_keys: bool = False) -> DataFrame:
    """O-23: gold ``(id, gold)`` left join silver ``(ID, ocr)`` on id = ID without ``.jpg``.

    Result ``(id, gold, silver)``; unmatched rows have a null ``silver`` (they are
    counted by :func:`attrition_report` and dropped by :func:`filter_complete`).
    Repeated ids fan out as in any equi-join. ``legacy_null_keys`` lets null keys match.
    """
    s = silver.select(F.replace(F.col("ID"), F.lit(".jpg"), F.lit("")).alias("_sid"), F.col("ocr").alias("silver"),
                      F.lit(True).alias("_matched"))
    g = gold.select("id", coerce_text("gold").alias("gold"))
    cond = g["id"].eqNullSafe(s["_sid"]) if legacy_null_keys else g["id"] == s["_sid"]
    return g.join(s, cond, "left").drop("_sid")


def drop_failed_merges(merged: DataFrame, silver_checked: bool = False) -> DataFrame:
    """Drop rows whose silver text is missing (no match, or a null text).

    Tested through the match flag. A predicate on the silver text itself would be pushed
    by Catalyst below the projection that computes it, copying the whole text parse into
    the join condition; ``silver_checked`` (silver from :func:`clean_silver`, non-null and
    non-empty by construction) skips that test."""
    cond = F.col("_matched").isNotNull()
    if not silver_checked:
        cond = cond & F.col("silver").isNotNull()
    return merged.filter(cond).drop("_matched")


def sidecar_texts(sidecars: DataFrame, mode: str = "drop_pyte", out: str = "pyte") -> DataFrame:
    """O-02 result as ``(id, <out>)`` with the key derived from the file name."""
    return sidecars.select(T.doc_key("name", mode).alias("id"), F.col("content").cast("string").alias(out))


def join_sidecar_text(df: DataFrame, texts: DataFrame, on: str = "id") -> DataFrame:
    """O-24: left join on ``id`` with the engine text."""
    return df.join(texts, on, "left")


def training_table(gold_manifest: DataFrame, silver: DataFrame, engine_sidecars: DataFrame,
                   legacy_nan: bool = False, silver_checked: bool = False) -> DataFrame:
    """Training table ``(id, gold, silver, pyte)`` (entry 1 of the workflow).

    gold manifest ``(Asset, Transcription)`` -> O-17 -> O-19; O-23 with silver; drop
    failed merges; O-24 with the engine text; O-19 (``legacy_nan`` keeps a missing engine
    text as ``'nan'`` as the original did); O-20. ``silver_checked``: silver comes from
    :func:`clean_silver`, whose texts are non-empty, so O-20 need not test it again.
    """
    g = project_rename(gold_manifest, {"Asset": "id", "Transcription": "gold"})
    merged = drop_failed_merges(join_gold_silver(g, silver), silver_checked)
    final = join_sidecar_text(merged, sidecar_texts(engine_sidecars))
    final = final.withColumn("pyte", coerce_text("pyte", legacy_nan=True)) if legacy_nan else final.withColumn(
        "pyte", coerce_text("pyte"))
    return filter_complete(final, ["gold", "pyte"] if silver_checked else ["gold", "silver", "pyte"])


def attrition_report(gold_manifest: DataFrame, silver: DataFrame, engine_sidecars: DataFrame,
                     silver_checked: bool = False) -> DataFrame:
    """O-31: rows in gold, silver, merged, final, rows lost in the gold-silver merge, and
    gold keys that occur more than once (they fan out in the merge).

    Each input is read once, as keys and flags: counts per key are summed in one exchange
    and multiplied as the joins would fan out. Null keys match nothing.
    """
    def rows(df: DataFrame, key: Column, **flags: Column) -> DataFrame:
        return df.select(key.alias("id"), *[c.cast("long").alias(n) for n, c in flags.items()])

    yes, ocr = F.lit(True), F.col("ocr")
    sid = F.replace(F.col("ID"), F.lit(".jpg"), F.lit(""))
    parts = [
        rows(gold_manifest, F.col("Asset"), g=yes, g_full=coerce_text("Transcription") != ""),
        rows(silver, sid, s=yes, s_text=yes if silver_checked else ocr.isNotNull(),
             s_full=yes if silver_checked else F.coalesce(ocr != "", F.lit(False))),
        rows(sidecar_texts(engine_sidecars), F.col("id"), e_full=coerce_text("pyte") != ""),
    ]
    tagged = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    names = ("g", "g_full", "s", "s_text", "s_full", "e_full")
    keyed = tagged.groupBy("id").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    g, g_full, s, s_text, s_full, e_full = (F.col(n) for n in names)
    known = F.col("id").isNotNull()

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    def matched(c: Column) -> Column:
        return F.when(known, c).otherwise(F.lit(0))

    return keyed.agg(
        total(g).alias("gold_rows"),
        total(s).alias("silver_rows"),
        total(matched(g * s_text)).alias("merged_rows"),
        total(matched(g_full * s_full * e_full)).alias("final_rows"),
        total(g * F.greatest(F.lit(1), matched(s)) - matched(g * s_text)).alias("dropped_failed_merge"),
        F.count_if(g > 1).cast("long").alias("duplicate_gold_keys"),
    )


# ----------------------------------------------------------------- O-18 / O-25


def conform_to_template(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """O-18: add missing columns as ``''``, fix the order, blanks for nulls."""
    present = set(df.columns)
    cols = [coerce_text(c).alias(c) if c in present else F.lit("").alias(c) for c in columns]
    return df.select(*cols)


def enrich_from_sidecars(base: DataFrame, engine_sidecars: DataFrame, tagged_sidecars: DataFrame) -> DataFrame:
    """O-25: fill ``pyte_ocr`` from ``<id>.txt.pyte`` and ``chatgpt_ocr``, ``is_printed``,
    ``is_legible`` from ``<id>.jpg.txt`` (parsed, unfiltered, newlines kept).

    Two left equi-joins on derived keys; a missing sidecar leaves the template blanks.
    """
    pyte = engine_sidecars.select(T.doc_key("name", "drop_pyte").alias("_pid"), F.col("content").alias("_pyte"))
    tg = tagged_sidecars.select(F.replace(F.col("name"), F.lit(".jpg.txt"), F.lit("")).alias("_tid"),
                                T.parse_tagged("content").alias("_t"))
    j = base.join(pyte, base["id"] == pyte["_pid"], "left").join(tg, base["id"] == tg["_tid"], "left")
    return j.select(
        *[c for c in base.columns if c not in ("pyte_ocr", "chatgpt_ocr", "is_printed", "is_legible")],
        F.coalesce(F.col("_pyte"), F.col("pyte_ocr")).alias("pyte_ocr"),
        F.coalesce(F.col("_t.ocr_text"), F.col("chatgpt_ocr")).alias("chatgpt_ocr"),
        F.coalesce(F.when(F.col("_t").isNotNull(), T.bool_word(F.col("_t.printed"))), F.col("is_printed")).alias(
            "is_printed"),
        F.coalesce(F.when(F.col("_t").isNotNull(), T.bool_word(F.col("_t.legible"))), F.col("is_legible")).alias(
            "is_legible"),
        F.col("_pid").isNull().alias("_miss_pyte"),
        F.col("_tid").isNull().alias("_miss_chatgpt"),
    )


def testing_table(gold_manifest: DataFrame, engine_sidecars: DataFrame, tagged_sidecars: DataFrame,
                  template: Sequence[str] = K.TESTING_TEMPLATE) -> DataFrame:
    """Testing table on the 20-column template, with the two missing-sidecar flags."""
    base = conform_to_template(project_rename(gold_manifest, {"Asset": "id", "Transcription": "transcription"}),
                               template)
    e = enrich_from_sidecars(base, engine_sidecars, tagged_sidecars)
    return e.select(*[F.col(c) for c in template], "_miss_pyte", "_miss_chatgpt")


def missing_report(testing: DataFrame, k: int = 5, key: str = "id") -> DataFrame:
    """O-32: missing sidecars over both kinds, with the first ``k`` ids in key order.

    An id missing both kinds counts (and may be listed) twice. The examples come from
    a top-k (TakeOrderedAndProject), never from collecting every missing id; the count
    row and the ``k`` example rows are combined by one aggregation (no join). ``testing`` is
    read once: its missing ids are checkpointed, and both are taken from those.
    """
    kinds = F.array(F.when(F.col("_miss_pyte"), F.lit(0)), F.when(F.col("_miss_chatgpt"), F.lit(1)))
    long = materialize(testing.select(F.col(key).alias("id"), F.explode(F.array_compact(kinds)).alias("kind")))
    counts = long.agg(F.count(F.lit(1)).cast("long").alias("missing_total"),
                      F.count_if(F.col("kind") == 0).cast("long").alias("missing_pyte"),
                      F.count_if(F.col("kind") == 1).cast("long").alias("missing_chatgpt"))
    top = long.orderBy("id", "kind").limit(k).select(F.struct("id", "kind").alias("_ex"))
    both = counts.withColumn("_ex", F.lit(None).cast("struct<id:string,kind:int>")).unionByName(
        top, allowMissingColumns=True)
    return both.agg(
        F.max("missing_total").alias("missing_total"), F.max("missing_pyte").alias("missing_pyte"),
        F.max("missing_chatgpt").alias("missing_chatgpt"),
        F.array_join(F.transform(F.array_sort(F.collect_list("_ex")), lambda x: x["id"]), ",").alias("examples"))


def blank_report(testing: DataFrame, cols: Sequence[str] = ("pyte_ocr", "chatgpt_ocr"), k: int = 5,
                 key: str = "id") -> DataFrame:
    """O-33: per column, rows that are null or ``''`` and the first ``k`` such ids
    (one aggregation over the count rows and the top-k rows of each column). ``testing`` is read
    once: its blank cells are checkpointed as (column, id), all else is taken from those."""
    blanks = F.array(*[F.when(F.col(c).isNull() | (F.col(c) == ""), F.lit(c)) for c in cols])
    blank = materialize(testing.select(F.col(key).alias("_ex"), F.explode(F.array_compact(blanks)).alias("column")))
    asked = testing.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("column"))
    none = asked.select("column", F.lit(0).cast("long").alias("n_blank"), F.lit(None).cast("string").alias("_ex"))
    parts = none.unionByName(blank.groupBy("column").agg(F.count(F.lit(1)).cast("long").alias("n_blank")), allowMissingColumns=True)
    for c in cols:
        top = blank.filter(F.col("column") == c).orderBy("_ex").limit(k)
        parts = parts.unionByName(top.select("column", F.lit(None).cast("long").alias("n_blank"), F.col("_ex").cast("string").alias("_ex")))
    return parts.groupBy("column").agg(F.max("n_blank").alias("n_blank"),
                                       F.array_join(F.array_sort(F.collect_list("_ex")), ",").alias("examples"))


# ----------------------------------------------------------------- O-26 / O-27 / O-38


def keep_existing(df: DataFrame, listing: DataFrame, key: Column, file_col: str = "name") -> DataFrame:
    """O-26: rows whose file (``key`` expression, e.g. ``id || '.jpg'``) is listed."""
    return df.withColumn("_file", key).join(listing.select(F.col(file_col).alias("_file")), "_file",
                                            "left_semi").drop("_file")


def pending(df: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """O-27: rows without output yet (anti-join on the key)."""
    d = done.select(F.col(done_key or key).alias(key))
    return df.join(d, key, "left_anti")


def distinct_basenames(listing: DataFrame, name: str = "name") -> DataFrame:
    """O-38: set of file names cut at the first period."""
    return listing.select(T.doc_key(name, "basename").alias("basename")).distinct()
