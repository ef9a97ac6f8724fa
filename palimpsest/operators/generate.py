"""Pluggable text generators applied as distributed jobs (O-22, O-30, O-35..O-37,
O-43, O-64, O-65, O-80..O-82).

A generator factory maps an arm name to a function ``pd.Series[str] -> pd.Series[str]``.
It runs inside ``mapInPandas`` (Arrow batches); the model behind an arm is loaded once
per Python worker (``functools.lru_cache``), not per row. Rows are exploded per arm in
long form, so arms and rows are spread over all tasks together.
"""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T

Generator = Callable[[pd.Series], pd.Series]
GeneratorFactory = Callable[[str], Generator]


# ---------------------------------------------------------------- O-80


@functools.lru_cache(maxsize=32)
def _loaded(factory: GeneratorFactory, arm: str) -> Generator | Exception:
    """The arm's generator, loaded once per worker, or the error that loading it gave."""
    try:
        return factory(arm)
    except Exception as e:  # a checkpoint that cannot be loaded skips its arm, not the job
        return e


def _run_parts(factory: GeneratorFactory, arm: str):
    """Each row brings a document's parts; one call for all parts of an Arrow batch, as one flat
    series, and its outputs back in the same rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(1)
            sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(sizes)
            flat = parts.flatten().to_pandas()
            number = pd.Series(np.arange(len(flat)) - np.repeat(ends - sizes, sizes))
            model = _loaded(factory, arm)
            if isinstance(model, Exception):
                raise model
            given = model(flat, number) if "part" in inspect.signature(model).parameters else model(flat)
            texts = pa.array(given.tolist(), pa.string())
            outputs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), outputs], names=[batch.schema.names[0], "_outputs"])

    return run


#: Column with a row's identity; ``apply_arms`` carries it to the outputs of the row if it is given.
ROW = "input_row"
#: Column with the arms that a row still needs; ``apply_arms`` runs no others if it is given.
PENDING = "pending_arms"


#: Characters of inputs, each counted for all its arms, after which a task generates and gives its outputs away.
CHARS_AT_ONCE = 8_000_000


def _stretches(inputs: pd.Series, arms: pd.Series) -> Iterator[slice]:
    """Consecutive rows of ``CHARS_AT_ONCE``, or one row more."""
    start, held = 0, 0
    for i, (x, some) in enumerate(zip(inputs, arms), 1):
        held += len(x) * len(some) if isinstance(x, str) and some is not None else 0
        if held >= CHARS_AT_ONCE or i == len(inputs):
            yield slice(start, i)
            start, held = i, 0


def _run_arm_lists(factory: GeneratorFactory, key: str, arms_col: str, input_col: str, carried: Sequence[str] = ()):
    """Each row arrives once with its list of arms; one output row per (row, arm)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole, part in ((x, s) for x in batches for s in _stretches(x[input_col], x[arms_col])):
            long = whole.iloc[part][[key, *carried, input_col, arms_col]].explode(arms_col, ignore_index=True)
            long = long[long[arms_col].notna()]
            out = pd.Series([None] * len(long), index=long.index, dtype=object)
            error = pd.Series([None] * len(long), index=long.index, dtype=object)
            for arm, idx in long.groupby(arms_col, sort=False).groups.items():
                model = _loaded(factory, arm)
                if isinstance(model, Exception):
                    error.loc[idx] = f"{type(model).__name__}: {model}"
                    continue
                inputs = long.loc[idx, input_col]
                present = inputs.notna()
                if present.any():
                    res = model(inputs[present].astype(str))
                    out.loc[res.index] = res.values
            yield pd.DataFrame({key: long[key], **{c: long[c] for c in carried}, "arm": long[arms_col], "has_input": long[input_col].notna(),
                                "raw_output": out, "load_error": error})

    return run


def apply_arms(df: DataFrame, arms: Sequence[str], factory: GeneratorFactory, key: str, input_col: str,
               done: DataFrame | None = None, prompt_template: str | None = K.CORRECTION_PROMPT,
               load_errors: bool = False) -> DataFrame:
    """O-80: run every arm over every row; long output ``(key, arm, output, status)``.

    Each row crosses into Python once, with the list of arms still to run for it, and
    the generator of an arm sees many of that arm's rows at once (``CHARS_AT_ONCE``). ``done``
    (``key, arm``) holds outputs already written: those arms are removed per key
    (null-only fill, O-22 / resume, O-27). Arms left out of ``arms`` (no checkpoint or a
    load error upstream, see :func:`latest_checkpoint`) are not run. Null input -> null
    output, status ``no_input``; blank output -> error text, status ``blank`` (O-65). An arm
    whose loader raises is skipped: its rows are not in the output; ``load_errors=True``
    returns them too, with null output and status ``load_error: <error>``. If ``df`` has the
    column ``ROW``, the outputs have it too, and ``done`` is matched by it in place of the key;
    if it has the column ``PENDING``, a row's arms are those of ``arms`` in it.
    """
    carried = [ROW] if ROW in df.columns else []
    prompt = T.correction_prompt(input_col, prompt_template) if prompt_template else F.col(input_col)
    todo = F.array(*[F.lit(a) for a in arms])
    rows = df.select(F.col(key), *carried, prompt.alias("_prompt"), *([PENDING] if PENDING in df.columns else []))
    if PENDING in df.columns:
        todo = F.array_intersect(todo, PENDING)
    if done is not None:
        by = ROW if carried else key
        finished = done.groupBy(by).agg(F.collect_set("arm").alias("_done"))
        rows = rows.join(finished, by, "left")
        pending = F.when(F.col("_done").isNull(), todo).otherwise(F.array_except(todo, F.col("_done")))
        rows = rows.select(key, *carried, "_prompt", pending.alias("_arms")).filter(F.size("_arms") > 0)
    else:
        rows = rows.withColumn("_arms", todo)
    schema = f"{key} {dict(df.dtypes)[key]}, {''.join(f'{c} {dict(df.dtypes)[c]}, ' for c in carried)}arm string, has_input boolean, raw_output string, load_error string"
    gen = rows.mapInPandas(_run_arm_lists(factory, key, "_arms", "_prompt", carried), schema)
    g = T.blank_guard("raw_output", has_input=F.col("has_input"))
    if not load_errors:
        gen = gen.filter(F.col("load_error").isNull())
    failed = F.col("load_error").isNotNull()
    return gen.select(key, *carried, "arm", F.when(~failed, g["output"]).alias("output"),
                      F.when(failed, F.concat(F.lit("load_error: "), "load_error")).otherwise(g["status"]).alias("status"))


# ---------------------------------------------------------------- O-30 / O-35 / O-36


def arms_wide(base: DataFrame, long: DataFrame, key: str, arms: Sequence[str], prefix: str = "") -> DataFrame:
    """O-30: one output column per arm beside the base columns (explicit pivot values)."""
    wide = long.groupBy(key).pivot("arm", list(arms)).agg(F.first("output"))
    wide = wide.select(key, *[F.col(a).alias(prefix + a) for a in arms])
    return base.join(wide, key, "left")


def blank_outputs_by_arm(long: DataFrame) -> DataFrame:
    """O-35: blank generations per arm and in total (the rollup row has ``arm`` null)."""
    return long.rollup("arm").agg(F.count_if(F.col("status") == "blank").cast("long").alias("n_blank"),
                                  F.count(F.lit(1)).cast("long").alias("n_rows"))


def latest_checkpoint(dirs: DataFrame, arm: str = "arm", name: str = "dir", mtime: str = "mtime",
                      arms: Sequence[str] | None = None) -> DataFrame:
    """O-36: per arm, the newest ``checkpoint-N`` by N, by modification time, and (for
    contrast) by text order. With ``arms``, every listed arm gets a row, null when it has
    no checkpoint (the caller skips that arm)."""
    n = F.regexp_extract(F.col(name), r"([0-9]+)$", 1)
    ok = F.col(name).startswith("checkpoint-") & (n != "")
    d = dirs.filter(ok).withColumn("_n", n.cast("long"))
    latest = d.groupBy(arm).agg(F.max_by(name, "_n").alias("latest_by_number"),
                                F.max_by(name, mtime).alias("latest_by_mtime"),
                                F.max(name).alias("latest_by_text"))
    if arms is None:
        return latest
    listed = dirs.sparkSession.range(1).select(F.explode(F.array(*[F.lit(a) for a in arms])).alias(arm))
    return listed.join(latest, arm, "left")


# ---------------------------------------------------------------- O-43 / O-37 / O-82


def split_parts(df: DataFrame, text_col: str, max_tokens: int, tokens: Column | None = None) -> DataFrame:
    """O-43: texts longer than ``max_tokens`` tokens cut into consecutive parts; shorter
    texts kept whole and verbatim. Adds ``part`` (from 0), ``part_text``, ``n_parts``.

    Tokens are whitespace words by default (pluggable ``tokens`` array column); parts
    are re-joined with a single space. Every text is processed whole.
    """
    # the token array is projected once per row; the per-part lambda only slices it
    df = df.withColumn("_toks", tokens if tokens is not None else T.words(text_col))
    toks = F.col("_toks")
    n = F.size(toks)
    n_parts = F.when(n <= max_tokens, F.lit(1)).otherwise(F.ceil(n / F.lit(max_tokens)).cast("int"))
    parts = F.when(n <= max_tokens, F.array(F.col(text_col))).otherwise(
        F.transform(F.sequence(F.lit(0), n_parts - 1),
                    lambda i: F.array_join(F.slice(toks, i * max_tokens + 1, max_tokens), " ")))
    out = df.select("*", n_parts.alias("n_parts"), F.posexplode(parts).alias("part", "part_text"))
    return out.drop("_toks")


def reassemble_parts(parts: DataFrame, key: str, text: str = "part_output", note: str = "note",
                     part: str = "part") -> DataFrame:
    """O-37: per document, outputs joined by ``' '`` and notes by ``' | '`` in part order.

    Parts of one document are gathered into that document's row (bounded by the size of
    the document it came from). Empty outputs stay as empty strings in the join.
    """
    agg = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(part).alias("p"),
                                                                      F.coalesce(F.col(text), F.lit("")).alias("t"),
                                                                      F.col(note).alias("n")))).alias("_ps"))
    return agg.select(key, F.size("_ps").cast("long").alias("n_parts"),
                      F.array_join(F.transform("_ps", lambda x: x["t"]), " ").alias("model_corrected"),
                      F.array_join(F.transform("_ps", lambda x: x["n"]), " | ").alias("notes"))


def _spread(source: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` over all cores where their source (a small file, say) is read by fewer tasks."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if source.rdd.getNumPartitions() < cores else rows


def correct_long_text(df: DataFrame, key: str, text_col: str, factory: GeneratorFactory, arm: str = "long",
                      max_tokens: int = 1024) -> DataFrame:
    """O-82: split (O-43) -> generate per part -> notes (O-65) -> reassemble (O-37).

    A document's parts stay in its row: they are cut, generated (all parts of an Arrow batch
    in one call) and joined again in one task, without a shuffle; only rows read by fewer
    tasks than there are cores are dealt out first. A generator with a parameter ``part``
    also gets the part numbers.
    """
    # null texts go here: a filter on the parts would be pushed down and cut every text again
    toks = df.filter(F.col(text_col).isNotNull()).select(key, text_col, T.words(text_col).alias("_toks"))
    n = F.size("_toks")
    cut = F.transform(F.sequence(F.lit(0), F.ceil(n / F.lit(max_tokens)).cast("int") - 1),
                      lambda i: F.array_join(F.slice("_toks", i * max_tokens + 1, max_tokens), " "))
    rows = toks.select(key, F.when(n <= max_tokens, F.array(F.col(text_col))).otherwise(cut).alias("_parts"))
    schema = f"{key} {dict(df.dtypes)[key]}, _outputs array<string>"
    gen = _spread(df, rows).mapInArrow(_run_parts(factory, arm), schema)
    notes = F.transform("_outputs", lambda x: F.when(T.pystrip(x) == "", F.lit(K.NOTE_EMPTY)).otherwise(F.lit(K.NOTE_VALID)))
    return gen.select(key, F.size("_outputs").cast("long").alias("n_parts"),
                      F.array_join(F.transform("_outputs", lambda x: F.coalesce(x, F.lit(""))), " ").alias("model_corrected"),
                      F.array_join(notes, " | ").alias("notes"))
