"""Arms over text and image, run in rounds with the no-op guard inside (O-41, O-64, O-65, O-80).

A generator of an image arm takes two inputs: ``model(prompts, images)``, both pandas series.
Rows carry paths; the task that generates reads the bytes, some megabytes at a time, once for all
arms of the row. An image that is not there has a status of its own (``no_image``).

:func:`run_guarded` numbers the rows in order and cuts them into rounds of growing size. The
baseline (untuned) arm runs over all rows first. Then, round by round, the living arms run over
the round's rows, the equal outputs in a row are counted, and the count is carried into the
next round. An arm whose count reaches ``k`` is stopped: that output and all later ones are
not in the result, and no later round runs it. The count is a fold of summaries of
contiguous stretches of rows: one narrow exchange a round, whatever the arm's share of rows.

Everything is kept in a folder: rows with their baseline output, each round's outputs, and
each round's state, written last. A run that was stopped goes on after the last round with a
state and generates no finished round again; the folder belongs to one set of rows.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import constants as K
from ..functions import text as T
from .generate import GeneratorFactory, _loaded
from .ordered import row_number

#: Rows that a task holds at once, bytes of images and prompts after which it takes no more, and rows of the first round.
ROWS_AT_ONCE, BYTES_AT_ONCE, FIRST_ROUND = 1024, 16_000_000, 1024
LOAD_ERROR = "load_error: "


def _read(reader: Callable[[str], bytes], path) -> bytes | None:
    if path is None or pd.isna(path):
        return None
    try:
        return reader(path)
    except OSError:
        return None


def _stretches(whole: pd.DataFrame, reader, rows_at_once: int) -> Iterator[tuple[pd.DataFrame, pd.Series | None]]:
    """Rows in turn, with their images, until they are ``rows_at_once`` or hold ``BYTES_AT_ONCE``."""
    start, images, held = 0, [], 0
    for i, (prompt, path, arms) in enumerate(zip(whole["_prompt"], whole["_path"], whole["_arms"]), 1):
        image = _read(reader, path) if reader is not None and len(arms) else None
        images.append(image)
        held += (len(image) if image is not None else 0) + (len(prompt) if isinstance(prompt, str) else 0)
        if i == len(whole) or i - start >= rows_at_once or held >= BYTES_AT_ONCE:
            yield whole.iloc[start:i].reset_index(drop=True), pd.Series(images, dtype=object) if reader is not None else None
            start, images, held = i, [], 0


def _run(factory: GeneratorFactory, carried: Sequence[str], reader, rows_at_once: int):
    """Rows (carried.., _prompt, _path, _arms) -> one row for each (row, arm)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for pdf, images in _stretches(whole, reader, rows_at_once):
                arms = pdf["_arms"].map(list)
                for arm in dict.fromkeys(a for row in arms for a in row):
                    rows = pdf[arms.map(lambda x: arm in x)]  # noqa: B023
                    has_input = rows["_prompt"].notna()
                    has_image = images[rows.index].notna() if images is not None else pd.Series(True, index=rows.index)
                    out = pd.Series([None] * len(rows), index=rows.index, dtype=object)
                    error = None
                    model = _loaded(factory, arm)
                    if isinstance(model, Exception):
                        error = f"{type(model).__name__}: {model}"
                    else:
                        ready = rows.index[has_input & has_image]
                        if len(ready):
                            prompts = rows.loc[ready, "_prompt"].astype(str)
                            given = model(prompts, images[ready]) if images is not None and len(inspect.signature(model).parameters) > 1 else model(prompts)
                            out.loc[ready] = given.values
                    yield pd.DataFrame({**{c: rows[c] for c in carried}, "arm": arm, "has_input": has_input, "has_image": has_image,
                                        "raw_output": out, "load_error": error})

    return run


def generate(rows: DataFrame, factory: GeneratorFactory, prompt: str | Column, arms: Column, carry: Sequence[str], image: str | None = None,
             reader: Callable[[str], bytes] | None = None, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """One row for each row and arm of its array ``arms``: the columns ``carry``, arm, output, status.

    ``image`` names the column of paths (arms without images if not given). Status: ``ok``,
    ``blank``, ``no_image`` (its own error text, whatever the prompt), ``no_input`` (null) or
    ``load_error: ..`` (null; the arm's loader raised)."""
    from ..sources.files import read_bytes

    path = F.col(image) if image else F.lit(None).cast("string")
    todo = rows.select(*carry, (F.col(prompt) if isinstance(prompt, str) else prompt).alias("_prompt"), path.alias("_path"), arms.alias("_arms"))
    kinds = dict(todo.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in carry] + ["arm string, has_input boolean, has_image boolean, raw_output string, load_error string"])
    made = todo.where(F.size("_arms") > 0).mapInPandas(_run(factory, list(carry), (reader or read_bytes) if image else None, rows_at_once), schema)
    found = T.blank_guard("raw_output", has_input=F.col("has_input"))
    status = (F.when(F.col("load_error").isNotNull(), F.concat(F.lit(LOAD_ERROR), "load_error"))
              .when(~F.col("has_image"), F.lit("no_image")).otherwise(found["status"]))
    output = F.when(F.col("load_error").isNotNull(), F.lit(None)).when(~F.col("has_image"), F.lit(K.NO_IMAGE_ERROR)).otherwise(found["output"])
    return made.select(*carry, "arm", output.alias("output"), status.alias("status"))


def apply_image_arms(df: DataFrame, arms: Sequence[str], factory: GeneratorFactory, key: str, text: str, image: str,
                     template: str = K.IMAGE_PROMPT, reader: Callable[[str], bytes] | None = None, load_errors: bool = False) -> DataFrame:
    """O-80 over text and image: (key, arm, output, status). An arm whose loader raises is
    skipped; ``load_errors=True`` returns its rows too."""
    out = generate(df, factory, T.correction_prompt(text, template), F.array(*[F.lit(a) for a in arms]), [key], image, reader)
    return out if load_errors else out.where(~F.col("status").startswith(LOAD_ERROR))


# ---------------------------------------------------------------- streaks


class Stretch(NamedTuple):
    """What a stretch of one arm's compared outputs, in order, says to those before and after it."""

    n: int
    lead: list[int]  # places of its first equal outputs, ``k`` at most
    whole: bool  # all outputs are equal ones
    tail: int  # equal outputs at its end
    stop: int | None  # place where ``k`` in a row are reached inside it


def stretch(places: np.ndarray, same: np.ndarray, k: int) -> Stretch:
    n, differ = len(same), np.flatnonzero(~same)
    if not len(differ):
        return Stretch(n, places[:k].tolist(), True, n, int(places[k - 1]) if n >= k else None)
    edges = np.concatenate([[-1], differ, [n]])
    long = np.flatnonzero(np.diff(edges) > k)  # more than k apart: k equal ones between
    stop = int(places[edges[long[0]] + k]) if len(long) else None
    return Stretch(n, places[:min(differ[0], k)].tolist(), False, int(n - 1 - differ[-1]), stop)


def follow(a: Stretch, b: Stretch, k: int) -> Stretch:
    """The stretch of ``a`` and then ``b``."""
    stop = a.stop
    if stop is None:
        missing = max(1, k - a.tail)
        stop = b.lead[missing - 1] if len(b.lead) >= missing else b.stop
    return Stretch(a.n + b.n, (a.lead + b.lead)[:k] if a.whole else a.lead, a.whole and b.whole, b.tail + a.tail if b.whole else b.tail, stop)


NOTHING = Stretch(0, [], True, 0, None)


def streaks(rows: DataFrame, before: Mapping[str, int], k: int) -> dict[str, Stretch]:
    """``rows`` (arm, place, same) -> each arm's stretch, after ``before`` equal outputs in a row."""

    def summed(batches):
        now, held = None, NOTHING
        for pdf in batches:
            for arm, part in pdf.groupby("arm", sort=False):
                if arm != now:
                    if held.n:
                        yield pd.DataFrame([(now, first, *held)], columns=names)
                    now, held, first = arm, NOTHING, int(part["place"].iloc[0])
                held = follow(held, stretch(part["place"].to_numpy(), part["same"].to_numpy(), k), k)
        if held.n:
            yield pd.DataFrame([(now, first, *held)], columns=names)

    def folded(pdf):
        held = NOTHING
        for row in pdf.sort_values("first").itertuples():
            held = follow(held, Stretch(row.n, list(row.lead), row.whole, row.tail, None if pd.isna(row.stop) else int(row.stop)), k)
        return pd.DataFrame([(pdf["arm"].iloc[0], 0, *held)], columns=names)

    names = ["arm", "first", *Stretch._fields]
    schema = "arm string, first long, n long, lead array<long>, whole boolean, tail long, stop long"
    parts = rows.select("arm", "place", "same").repartitionByRange("arm", "place").sortWithinPartitions("arm", "place").mapInPandas(summed, schema)
    # at most one summary for each arm and partition
    found = {r["arm"]: Stretch(r["n"], r["lead"], r["whole"], r["tail"], r["stop"]) for r in parts.groupBy("arm").applyInPandas(folded, schema).collect()}
    return {a: follow(Stretch(0, [], True, before.get(a, 0), None), found.get(a, NOTHING), k) for a in {*before, *found}}


# ---------------------------------------------------------------- rounds


def round_of(place: Column, first: int) -> Column:
    """Rounds of ``first``, 2 x ``first``, 4 x ``first`` .. places (from 1)."""
    return (F.length(F.bin(F.floor((place - 1) / F.lit(first)).cast("long") + 1)) - 1).cast("int")


class Guarded(NamedTuple):
    outputs: DataFrame  # key, arm, place, output, status
    report: DataFrame  # arm, generated, stopped_at, load_error


def _written(spark, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing written yet
        return None


def run_guarded(df: DataFrame, arms: Sequence[str], factory: GeneratorFactory, key: str, order: Sequence[str], text: str, folder: str, *,
                image: str | None = None, baseline: str = "untuned", cells: Mapping[str, str] | None = None, k: int = 5,
                first: int = FIRST_ROUND, template: str = K.IMAGE_PROMPT, reader: Callable[[str], bytes] | None = None) -> Guarded:
    """O-41 joined to O-80: ``arms`` over the rows of ``df`` in ``order``, stopped at the ``k``-th
    output in a row that equals the baseline's.

    ``cells`` maps arms to columns that may already hold their output: such a cell is kept (status
    ``kept``), not generated and not compared, as are rows without image or text. ``report``:
    how often the arm's generator ran, the place where it was stopped, its loader's error."""
    spark, folder, cells = df.sparkSession, folder.rstrip("/"), dict(cells or {})
    base = _base(df, factory, key, order, text, folder, image, baseline, cells, first, template, reader)
    state = {r["round"]: json.loads(r["state"]) for r in done.collect()} if (done := _written(spark, f"{folder}/state")) is not None else {}
    now = {a: {"streak": 0, "stopped_at": None, "generated": 0, "load_error": None} for a in arms}
    for r in sorted(x["round"] for x in base.select("round").distinct().collect()):
        if r in state:
            now = state[r]
            continue
        living = [a for a in arms if now[a]["stopped_at"] is None and now[a]["load_error"] is None]
        if living:
            now = _round(base.where(F.col("round") == r), r, living, now, factory, folder, image, k, reader)
        spark.createDataFrame([(json.dumps(now),)], "state string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/state/round={r}")
    kept = base.select("key", F.explode(F.map_filter("filled", lambda a, x: a.isin(list(arms)))).alias("arm", "output"), "place").select(
        "key", "arm", "place", "output", F.lit("kept").alias("status"))
    first_arm = base.select("key", F.lit(baseline).alias("arm"), "place", F.col("base_output").alias("output"), F.col("base_status").alias("status"))
    made = _written(spark, f"{folder}/outputs")
    outputs = first_arm.union(kept)
    if made is not None:
        made = made.where(~F.col("status").startswith(LOAD_ERROR))
        outputs = outputs.union(made.select("key", "arm", "place", "output", "status"))
    stops = {a: s["stopped_at"] for a, s in now.items() if s["stopped_at"] is not None}
    if stops:
        # all cells after the stop are absent, but those that were there before
        stop = F.create_map(*[F.lit(x) for pair in stops.items() for x in pair])[F.col("arm")]
        outputs = outputs.where(stop.isNull() | (F.col("place") < stop) | (F.col("status") == "kept"))
    report = spark.createDataFrame([(a, s["generated"], s["stopped_at"], s["load_error"]) for a, s in now.items()],
                                   "arm string, generated long, stopped_at long, load_error string")
    return Guarded(outputs.withColumnRenamed("key", key) if key != "key" else outputs, report)


def _base(df, factory, key, order, text, folder, image, baseline, cells, first, template, reader) -> DataFrame:
    """The numbered rows with the baseline's outputs, by round; written once."""
    spark = df.sparkSession
    done = _written(spark, f"{folder}/base_schema")  # written last
    if done is not None:
        return spark.read.schema(StructType.fromJson(json.loads(done.first()[0]))).parquet(f"{folder}/base")
    given = [F.col(c) for c in cells.values()]
    filled = F.map_from_arrays(F.array(*[F.lit(a) for a in cells]), F.array(*given)) if cells else F.create_map().cast("map<string,string>")
    path = F.col(image) if image else F.lit(None).cast("string")
    rows = row_number(df, list(order), name="place")
    rows = rows.select("place", F.col(key).alias("key"), F.col(text).alias("text"), path.alias("path"),
                       F.map_filter(filled, lambda a, x: x.isNotNull()).alias("filled"))
    rows = rows.select("*", T.correction_prompt("text", template).alias("prompt"))
    carry = ["place", "key", "prompt", "path", "filled"]
    free = ~F.array_contains(F.map_keys("filled"), baseline)
    # rows whose baseline cell is filled go through without a call
    made = generate(rows.where(free), factory, "prompt", F.array(F.lit(baseline)), carry, "path" if image else None, reader)
    made = made.select(*carry, F.col("output").alias("base_output"), F.col("status").alias("base_status"))
    there = rows.where(~free).select(*carry, F.col("filled")[baseline].alias("base_output"), F.lit("kept").alias("base_status"))
    whole = made.union(there).withColumn("round", round_of(F.col("place"), first))
    whole.write.mode("overwrite").partitionBy("round").parquet(f"{folder}/base")
    spark.createDataFrame([(whole.schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/base_schema")
    return spark.read.schema(whole.schema).parquet(f"{folder}/base")


def _round(rows, r, living, now, factory, folder, image, k, reader):
    arms = F.array_except(F.array(*[F.lit(a) for a in living]), F.map_keys("filled"))
    made = generate(rows, factory, "prompt", arms, ["place", "key", "base_output"], "path" if image else None, reader)
    made = made.withColumn("same", F.coalesce(F.col("output") == F.col("base_output"), F.lit(False))).drop("base_output")
    path = f"{folder}/outputs/round={r}"
    made.write.mode("overwrite").parquet(path)
    written = rows.sparkSession.read.parquet(path)
    found = streaks(written.where(F.col("status").isin("ok", "blank")), {a: now[a]["streak"] for a in living}, k)
    errors = written.where(F.col("status").startswith(LOAD_ERROR)).groupBy("arm").agg(F.min("status").alias("status")).collect()
    broken = {e["arm"]: e["status"].removeprefix(LOAD_ERROR) for e in errors}
    after = dict(now)
    for a in living:
        s = found[a]
        after[a] = {"streak": s.tail, "stopped_at": s.stop, "generated": now[a]["generated"] + s.n, "load_error": broken.get(a)}
    return after
