"""Query registry: each query reads the driver tables (or data Spark derives from
them) and returns a DataFrame; each has an oracle SQL text for DuckDB where the
operation is SQL-expressible.

``QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, sql | None)``
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import assemble as A
from . import fixtures as FX
from . import sql as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = (fn, sql)
        return fn

    return deco


# ====================================================================== assemble


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return A.clean_silver(FX.tagged(spark, sf))


@query("silver_table", S.with_ctes(["silver"], "SELECT ID, ocr FROM silver"))
def q_silver_table(spark, sf):
    """O-02 -> O-52 -> O-21 -> O-54 -> O-55: silver table from tagged sidecars."""
    return silver(spark, sf)


@query("training_table", S.with_ctes(["training"], "SELECT id, gold, silver, pyte FROM training"))
def q_training_table(spark, sf):
    """Flagship: O-17, O-19, O-23, O-24, O-20 -> (id, gold, silver, pyte)."""
    return A.training_table(FX.gold(spark, sf), silver(spark, sf), FX.engine(spark, sf), silver_checked=True)


@query("attrition_report", S.with_ctes(["training"], """
SELECT (SELECT count(*) FROM gold)::BIGINT AS gold_rows,
       (SELECT count(*) FROM silver)::BIGINT AS silver_rows,
       (SELECT count(*) FROM gold g JOIN silver s ON g.id = replace(s.ID, '.jpg', ''))::BIGINT AS merged_rows,
       (SELECT count(*) FROM training)::BIGINT AS final_rows,
       (SELECT count(*) FROM gold g WHERE NOT EXISTS
           (SELECT 1 FROM silver s WHERE g.id = replace(s.ID, '.jpg', '')))::BIGINT AS dropped_failed_merge,
       (SELECT count(*) FROM (SELECT id FROM gold GROUP BY id HAVING count(*) > 1))::BIGINT AS duplicate_gold_keys
"""))
def q_attrition_report(spark, sf):
    """O-31."""
    return A.attrition_report(FX.gold(spark, sf), silver(spark, sf), FX.engine(spark, sf), silver_checked=True)


@query("parse_report", S.with_ctes(["tagged_parsed"], """
SELECT CASE WHEN content IS NULL THEN 'error'
            WHEN printed AND legible AND ocr_text <> '' THEN 'written' ELSE 'skipped' END AS outcome,
       count(*)::BIGINT AS n
FROM tagged_parsed GROUP BY 1
"""))
def q_parse_report(spark, sf):
    """O-34 (with O-15 outcome tagging)."""
    return A.parse_report(FX.tagged(spark, sf))


def _testing_sql_body() -> str:
    p = S.parsed("t.content")
    model_cols = ",\n  ".join(f"'' AS {c}" for c in A.K.TESTING_TEMPLATE[6:])
    return f"""
testing AS (
SELECT g.id, g.gold AS transcription,
  coalesce(e.content, '') AS pyte_ocr,
  CASE WHEN t.name IS NULL THEN '' ELSE {p['ocr_text']} END AS chatgpt_ocr,
  CASE WHEN t.name IS NULL THEN '' ELSE {S.bool_word(p['printed'])} END AS is_printed,
  CASE WHEN t.name IS NULL THEN '' ELSE {S.bool_word(p['legible'])} END AS is_legible,
  {model_cols},
  e.name IS NULL AS miss_pyte, t.name IS NULL AS miss_chatgpt
FROM gold g
LEFT JOIN engine e ON g.id = replace(e.name, '.txt.pyte', '')
LEFT JOIN tagged t ON g.id = replace(t.name, '.jpg.txt', ''))"""


def _testing_sql(select: str) -> str:
    ctes = S.with_ctes(["gold", "engine", "tagged"], "")
    return ctes.rstrip("\n") + "," + _testing_sql_body() + "\n" + select


def testing(spark: SparkSession, sf: str) -> DataFrame:
    return A.testing_table(FX.gold(spark, sf), FX.engine(spark, sf), FX.tagged(spark, sf))


@query("testing_table", _testing_sql("SELECT " + ", ".join(A.K.TESTING_TEMPLATE) + " FROM testing"))
def q_testing_table(spark, sf):
    """O-18 + O-25 (+ O-51/O-52 unfiltered): 20-column testing template."""
    return testing(spark, sf).drop("_miss_pyte", "_miss_chatgpt")


@query("missing_report", _testing_sql("""
, missing AS (SELECT id, 0 AS kind FROM testing WHERE miss_pyte
              UNION ALL SELECT id, 1 AS kind FROM testing WHERE miss_chatgpt)
SELECT count(*)::BIGINT AS missing_total,
       count(*) FILTER (WHERE kind = 0)::BIGINT AS missing_pyte,
       count(*) FILTER (WHERE kind = 1)::BIGINT AS missing_chatgpt,
       (SELECT string_agg(id, ',' ORDER BY id, kind) FROM (SELECT id, kind FROM missing ORDER BY id, kind LIMIT 5))
         AS examples
FROM missing
"""))
def q_missing_report(spark, sf):
    """O-32: missing sidecars of both kinds and the first five ids."""
    return A.missing_report(testing(spark, sf))


@query("blank_report", _testing_sql("""
SELECT 'pyte_ocr' AS "column", count(*)::BIGINT AS n_blank,
       (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM testing WHERE pyte_ocr IS NULL OR pyte_ocr = ''
        ORDER BY id LIMIT 5)) AS examples
FROM testing WHERE pyte_ocr IS NULL OR pyte_ocr = ''
UNION ALL
SELECT 'chatgpt_ocr', count(*)::BIGINT,
       (SELECT string_agg(id, ',' ORDER BY id) FROM (SELECT id FROM testing WHERE chatgpt_ocr IS NULL OR chatgpt_ocr = ''
        ORDER BY id LIMIT 5))
FROM testing WHERE chatgpt_ocr IS NULL OR chatgpt_ocr = ''
"""))
def q_blank_report(spark, sf):
    """O-33: blank cells per column and the first five ids."""
    return A.blank_report(testing(spark, sf))


@query("keep_existing", S.with_ctes(["gold", "listing"], """
SELECT id, gold FROM gold WHERE id || '.jpg' IN (SELECT name FROM listing)
"""))
def q_keep_existing(spark, sf):
    """O-26: manifest rows whose image file is present."""
    g = A.project_rename(FX.gold(spark, sf), {"Asset": "id", "Transcription": "gold"})
    return A.keep_existing(g, FX.listing(spark, sf), F.concat(F.col("id"), F.lit(".jpg")))


@query("pending_transcription", S.with_ctes(["listing", "engine"], """
SELECT name FROM listing l
WHERE NOT EXISTS (SELECT 1 FROM engine e WHERE e.name = replace(l.name, '.jpg', '.txt.pyte'))
"""))
def q_pending_transcription(spark, sf):
    """O-27: present images that have no engine sidecar yet."""
    from ..functions import text as T

    todo = FX.listing(spark, sf).withColumn("side", T.doc_key("name", "pyte_name"))
    return A.pending(todo, FX.engine(spark, sf), "side", "name").select("name")


@query("distinct_basenames", S.with_ctes(["listing", "tagged", "engine"], """
SELECT DISTINCT split_part(name, '.', 1) AS basename FROM
  (SELECT name FROM listing UNION ALL SELECT name FROM tagged UNION ALL SELECT name FROM engine)
"""))
def q_distinct_basenames(spark, sf):
    """O-38 over every file in the folder (images and both sidecar kinds)."""
    files = (FX.listing(spark, sf).unionByName(FX.tagged(spark, sf).select("name"))
             .unionByName(FX.engine(spark, sf).select("name")))
    return A.distinct_basenames(files)


# ====================================================================== ladder

from ..operators import ladder as L  # noqa: E402

_ARMS_SQL = "(VALUES " + ", ".join(f"('{lab}', {s})" for lab in L.K.ARM_LABELS for s in L.K.ARM_SIZES) + ") AS a(label, size)"
_LADDER_SQL = f"""
, ranked AS (SELECT *, row_number() OVER (ORDER BY id) AS rn, count(*) OVER () AS n_all FROM training)
, ladder AS (
  SELECT a.label, a.size, a.label || '_' || a.size AS arm, r.rn, least(r.n_all, a.size)::BIGINT AS n_rows,
         least(r.n_all, a.size) >= a.size AS complete, r.id,
         CASE a.label WHEN 'gold' THEN r.gold ELSE r.silver END AS target
  FROM ranked r JOIN {_ARMS_SQL} ON r.rn <= a.size)
"""


def _training_with(select: str) -> str:
    return S.with_ctes(["training"], "").rstrip("\n") + "\n" + _LADDER_SQL + select


def training(spark: SparkSession, sf: str) -> DataFrame:
    return A.training_table(FX.gold(spark, sf), silver(spark, sf), FX.engine(spark, sf), silver_checked=True)


def ladder(spark: SparkSession, sf: str) -> DataFrame:
    return L.size_ladder(training(spark, sf), ["id"])


@query("size_ladder", _training_with("SELECT arm, label, size, rn, n_rows, complete, id, target FROM ladder"))
def q_size_ladder(spark, sf):
    """O-44: nested first-N prefixes per arm (label x size) of the training table."""
    return ladder(spark, sf).select("arm", "label", "size", "rn", "n_rows", "complete", "id", "target")


@query("arm_grid", _training_with("""
SELECT a.label || '_' || a.size AS arm, a.label, a.size,
       substr(a.label, 1, 1) || '_' || CASE a.size WHEN 100 THEN '100' WHEN 1000 THEN '1k' WHEN 10000 THEN '10k'
         ELSE a.size::VARCHAR END || '_l' AS short_name,
       'work/' || a.label || '_' || a.size AS folder,
       'work/tuning_results_' || a.label || '_' || a.size AS output_dir,
       coalesce(l.n_rows, 0)::BIGINT AS n_rows, coalesce(l.n_rows, 0) >= a.size AS complete
FROM """ + _ARMS_SQL + """
LEFT JOIN (SELECT arm, count(*) AS n_rows FROM ladder GROUP BY arm) l ON l.arm = a.label || '_' || a.size
"""))
def q_arm_grid(spark, sf):
    """O-28: arm grid with folder / job names and the rows each arm receives."""
    counts = ladder(spark, sf).groupBy("arm").agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
    g = L.arm_grid(spark).join(counts, "arm", "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0)).cast("long")
    return g.select("arm", "label", "size", "short_name", "folder", "output_dir", n.alias("n_rows"),
                    (n >= F.col("size")).alias("complete"))


@query("arm_splits", _training_with("""
, r AS (SELECT arm, id, row_number() OVER (PARTITION BY arm ORDER BY md5('42|' || id), id) AS r,
               count(*) OVER (PARTITION BY arm) AS n FROM ladder)
, h AS (SELECT *, ceil(0.2::DOUBLE * n)::BIGINT AS held FROM r)
SELECT arm, id, CASE WHEN r <= n - held THEN 'train'
                     WHEN r <= n - held + (held - ceil(held / 2)::BIGINT) THEN 'val' ELSE 'test' END AS split
FROM h
"""))
def q_arm_splits(spark, sf):
    """O-45: seeded exact 80/10/10 split per arm."""
    return L.split_80_10_10(ladder(spark, sf).select("arm", "id"), key="id", by=["arm"])


_ITEMS_CTE = ("SELECT lang || '/' || source || '/d' || doc_id || '.jpg' AS path, lang AS shard, "
              "strlen(text)::BIGINT AS length FROM documents")


def _shard_sql(mode: str, tasks: int) -> str:
    if mode == "drop":
        expr = f"(rn - 1) // greatest(1, n // {tasks})"
        where = f"WHERE (rn - 1) // greatest(1, n // {tasks}) < {tasks}"
    elif mode == "last":
        expr = f"CASE WHEN n // {tasks} = 0 THEN {tasks - 1} ELSE least((rn - 1) // (n // {tasks}), {tasks - 1}) END"
        where = ""
    else:
        expr = f"((rn - 1) * {tasks}) // n"
        where = ""
    return f"""WITH items AS ({_ITEMS_CTE}),
r AS (SELECT path, row_number() OVER (ORDER BY path) AS rn, count(*) OVER () AS n FROM items)
SELECT path, rn, ({expr})::BIGINT AS shard FROM r {where}"""


SHARD_TASKS = 64


def _shard_query(mode: str):
    def fn(spark, sf):
        out = L.assign_shards(FX.items(spark, sf).select("path"), ["path"], SHARD_TASKS, mode).select("path", "rn", "shard")
        return out.filter("shard is not null")  # mode drop: the rows that the original's job array runs

    fn.__doc__ = f"O-42: contiguous shards over the sorted listing, mode {mode}."
    return fn


for _mode in ("drop", "last", "balanced"):
    query(f"shards_{_mode}", _shard_sql(_mode, SHARD_TASKS))(_shard_query(_mode))


CHUNK_EVERY = 10


@query("chunk_ids", f"""
SELECT user_id AS arm, event_id AS ord, rn, ((rn - 1) // {CHUNK_EVERY})::BIGINT AS chunk,
       rn % {CHUNK_EVERY} = 0 AS save_point
FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events)
""")
def q_chunk_ids(spark, sf):
    """O-47: save points per arm in output order."""
    return L.chunk_id(FX.arm_rows(spark, sf).select("arm", "ord"), ["ord"], CHUNK_EVERY, by=["arm"]).select(
        "arm", "ord", "rn", "chunk", "save_point")


@query("first_n", S.with_ctes(["training"], "SELECT id, gold FROM training ORDER BY id LIMIT 100"))
def q_first_n(spark, sf):
    """O-49 (with O-48 order): the first 100 rows of the training table by id."""
    return L.first_n(training(spark, sf).select("id", "gold"), ["id"], 100)


@query("union_outputs", S.with_ctes(["training"], """
SELECT (row_number() OVER (ORDER BY id) - 1)::BIGINT AS original_index, id FROM training
"""))
def q_union_outputs(spark, sf):
    """O-50: per-worker outputs (4 contiguous shards) concatenated and renumbered."""
    t = L.assign_shards(training(spark, sf).select("id"), ["id"], 4, "last")
    parts = [t.filter(F.col("shard") == k).select("id") for k in range(4)]
    return L.union_outputs(parts, ["id"]).select("original_index", "id")


# ====================================================================== results

from ..functions import text as TX  # noqa: E402
from ..operators import results as RS  # noqa: E402


@query("result_fields", S.with_ctes(["answer_fields"], """
SELECT custom_id, line_no, has_choices, ocr_text, summary, date, is_printed, is_legible, method, sidecar_path,
       CASE WHEN has_choices THEN """ + S.tagged_content("ocr_text", "summary", "date", "is_printed", "is_legible")
       + """ END AS sidecar
FROM answer_fields
"""))
def q_result_fields(spark, sf):
    """O-04, O-46, O-60..O-62, O-53, O-56, O-14: last answer per key, its five fields
    and the tagged sidecar written next to the image."""
    c = RS.collect_results(FX.responses(spark, sf))
    return c.select("custom_id", "line_no", "has_choices", "ocr_text", "summary", "date", "is_printed",
                    "is_legible", "method", "sidecar_path", "sidecar")


@query("failed_results", S.with_ctes(["last_answers"], "SELECT custom_id FROM last_answers WHERE NOT has_choices"))
def q_failed_results(spark, sf):
    """O-60: keys whose answer has no choices (listed once)."""
    return RS.failed_keys(RS.collect_results(FX.responses(spark, sf)))


@query("clean_fenced", S.with_ctes(["responses"], "SELECT line_no, " + S.clean_fenced("content")
                                   + " AS cleaned FROM responses WHERE has_choices"))
def q_clean_fenced(spark, sf):
    """O-63: fence / preamble removal and backslash escaping of raw answers."""
    p = RS.parse_result_lines(FX.responses(spark, sf)).filter("has_choices").select("line_no", "content")
    return TX.clean_fenced(p, "content", "cleaned").select("line_no", "cleaned")


# ====================================================================== packing

from ..operators import packing as PK  # noqa: E402


def _pack_sql(budget: int, max_batches: int | None = None, skip: bool = False, one: bool = False) -> str:
    shard = "0" if one else "lang"
    return f"""WITH RECURSIVE items AS (
  SELECT lang || '/' || source || '/d' || doc_id || '.jpg' AS path, {shard} AS shard,
         (4 * ((strlen(text) + 2) // 3))::BIGINT AS size FROM documents),
pos AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY path) - 1 AS p FROM items {f'WHERE size <= {budget}' if skip else ''}),
walk AS (
  SELECT path, shard, p, 0::BIGINT AS batch, size AS fill, size <= {budget} AS alive FROM pos WHERE p = 0
  UNION ALL
  SELECT n.path, w.shard, n.p,
         CASE WHEN w.fill + n.size <= {budget} THEN w.batch ELSE w.batch + 1 END,
         CASE WHEN w.fill + n.size <= {budget} THEN w.fill + n.size ELSE n.size END,
         (w.fill + n.size <= {budget}) OR (n.size <= {budget} AND {'true' if max_batches is None else f'w.batch + 1 < {max_batches}'})
  FROM walk w JOIN pos n ON n.shard = w.shard AND n.p = w.p + 1
  WHERE w.alive),
stops AS (SELECT shard, min(path) AS stop FROM items WHERE size > {budget} GROUP BY shard),
packed AS (SELECT i.path, i.shard, i.size, CASE WHEN w.alive THEN w.batch END AS batch,
  CASE WHEN w.alive THEN NULL WHEN i.size > {budget} THEN 'oversize' WHEN i.path > s.stop THEN 'after_oversize' ELSE 'batch_limit' END AS reason
  FROM items i LEFT JOIN walk w ON w.path = i.path LEFT JOIN stops s ON s.shard = i.shard)
"""


def _request_items(spark, sf):
    from ..functions import text as T

    return FX.items(spark, sf).select("path", "shard", T.b64_size("length").alias("size"))


def _pack_query(budget: int, oversize: str):
    def fn(spark, sf):
        return PK.pack_batches(_request_items(spark, sf), ["path"], "size", budget=budget, shard="shard", oversize=oversize)

    fn.__doc__ = f"O-40 (+ O-58 size): next-fit batches of base64 size per language, budget {budget}, every row with its batch or the reason why not."
    return fn


_PACKED = "SELECT path, shard, size, batch, reason FROM packed"
query("request_batches", _pack_sql(60000, skip=True) + _PACKED)(_pack_query(60000, "skip"))
query("request_batches_tight", _pack_sql(20000) + _PACKED)(_pack_query(20000, "stop"))
query("request_batches_original", _pack_sql(PK.K.BATCH_BUDGET_BYTES, skip=True) + _PACKED)(_pack_query(PK.K.BATCH_BUDGET_BYTES, "skip"))


# ====================================================================== streaks / ledger

from ..operators import streaks as SK  # noqa: E402

NOOP_K = 5


@query("no_op_guard", f"""
WITH a AS (SELECT user_id AS arm, event_id AS ord, event_type IN ('view', 'click', 'error') AS same FROM events),
b AS (SELECT *, sum(same::INT) OVER w AS cs FROM a
      WINDOW w AS (PARTITION BY arm ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
c AS (SELECT *, CASE WHEN same THEN cs - coalesce(max(CASE WHEN NOT same THEN cs END) OVER w, 0) ELSE 0 END AS streak
      FROM b WINDOW w AS (PARTITION BY arm ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT *, max((same AND streak >= {NOOP_K})::INT) OVER w AS broken FROM c
      WINDOW w AS (PARTITION BY arm ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT arm, ord, same, streak::BIGINT AS streak, broken = 0 AS written FROM d
""")
def q_no_op_guard(spark, sf):
    """O-41: per arm, stop after five consecutive outputs equal to the untuned one."""
    return SK.no_op_guard(FX.arm_rows(spark, sf), ["arm"], ["ord"], "same", k=NOOP_K).select(
        "arm", "ord", "same", "streak", "written")


LEDGER_RETRY = 1


@query("batch_ledger", f"""
WITH p AS (SELECT 'batch_' || user_id AS batch_id, ts, event_id,
                  CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
                                  WHEN 'signup' THEN 'expired' ELSE 'in_progress' END AS status FROM events),
s AS (SELECT *, status IN ('completed', 'failed', 'expired') AS term,
             sum((status NOT IN ('completed', 'failed', 'expired'))::INT) OVER w AS nt,
             row_number() OVER w AS rn
      FROM p WINDOW w AS (PARTITION BY batch_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e AS (SELECT batch_id, arg_min(status, (ts, event_id)) AS st, arg_min(nt, (ts, event_id)) AS nt,
             arg_min(rn, (ts, event_id)) AS rn, arg_min(NOT term, (ts, event_id)) AS gave_up
      FROM s WHERE term OR nt > {LEDGER_RETRY} GROUP BY batch_id),
t AS (SELECT batch_id, count(*) AS n, count(*) FILTER (WHERE NOT term) AS ntt FROM s GROUP BY batch_id)
SELECT t.batch_id,
       CASE WHEN e.batch_id IS NULL THEN 'pending' WHEN e.gave_up THEN 'given_up' ELSE e.st END AS outcome,
       (CASE WHEN e.batch_id IS NULL THEN t.ntt WHEN e.gave_up THEN {LEDGER_RETRY} ELSE e.nt END)::BIGINT AS attempts,
       coalesce(e.rn, t.n)::BIGINT AS polls,
       coalesce(NOT e.gave_up AND e.st = 'completed', false) AS download
FROM t LEFT JOIN e USING (batch_id)
""")
def q_batch_ledger(spark, sf):
    """O-79 (batch form) with a retry limit of one, so give-ups occur."""
    return SK.batch_ledger(FX.status_events(spark, sf), retry_limit=LEDGER_RETRY)


# ====================================================================== generation

from ..operators import generate as GN  # noqa: E402
from . import stubs as ST  # noqa: E402

ARMS = ["untuned"] + [f"{lab}_{s}" for lab in GN.K.ARM_LABELS for s in GN.K.ARM_SIZES]
_ARMS_VALUES = "(VALUES " + ", ".join(f"('{a}')" for a in ARMS) + ") AS arms(arm)"
_ARM_OUT_SQL = S.with_ctes(["training"], "").rstrip("\n") + f"""
, o AS (SELECT t.id, arms.arm, 'Correct this OCR:: ' || t.pyte AS prompt FROM training t, {_ARMS_VALUES})
, r AS (SELECT id, arm, {S.stub_output('prompt', 'arm')} AS raw FROM o)
, arm_out AS (SELECT id, arm, CASE WHEN {S.strip('raw')} = '' THEN 'ERROR: Blank response generated' ELSE raw END AS output,
                CASE WHEN {S.strip('raw')} = '' THEN 'blank' ELSE 'ok' END AS status FROM r)
"""


def arm_outputs(spark, sf):
    return GN.apply_arms(training(spark, sf), ARMS, ST.stub_factory, "id", "pyte")


@query("arm_outputs", _ARM_OUT_SQL + "SELECT id, arm, output, status FROM arm_out")
def q_arm_outputs(spark, sf):
    """O-80 + O-64 + O-65: every arm over every row of the training table (stub model)."""
    return arm_outputs(spark, sf)


@query("arms_wide", _ARM_OUT_SQL + "SELECT t.id, t.gold AS transcription, t.pyte AS pyte_ocr, "
       + ", ".join(f"w.\"BART_{a}\"" for a in ARMS) + " FROM training t LEFT JOIN (SELECT id, "
       + ", ".join(f"max(CASE WHEN arm = '{a}' THEN output END) AS \"BART_{a}\"" for a in ARMS)
       + " FROM arm_out GROUP BY id) w USING (id)")
def q_arms_wide(spark, sf):
    """O-30: comparison table, one column per arm beside truth and input."""
    base = training(spark, sf).select("id", F.col("gold").alias("transcription"), F.col("pyte").alias("pyte_ocr"))
    return GN.arms_wide(base, arm_outputs(spark, sf), "id", ARMS, prefix="BART_")


@query("blank_by_arm", _ARM_OUT_SQL + """SELECT arm, count(*) FILTER (WHERE status = 'blank')::BIGINT AS n_blank,
       count(*)::BIGINT AS n_rows FROM arm_out GROUP BY ROLLUP (arm)""")
def q_blank_by_arm(spark, sf):
    """O-35: blank generations per arm and in total."""
    return GN.blank_outputs_by_arm(arm_outputs(spark, sf))


@query("latest_checkpoint", """
SELECT event_type AS arm, arg_max('checkpoint-' || event_id, event_id) AS latest_by_number,
       arg_max('checkpoint-' || event_id, ts) AS latest_by_mtime, max('checkpoint-' || event_id) AS latest_by_text
FROM events GROUP BY event_type
""")
def q_latest_checkpoint(spark, sf):
    """O-36: newest checkpoint per arm by number and by time (text order for contrast)."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    dirs = e.select(F.col("event_type").alias("arm"), F.concat(F.lit("checkpoint-"), F.col("event_id")).alias("dir"),
                    F.col("ts").alias("mtime"))
    return GN.latest_checkpoint(dirs)


PART_TOKENS = 64
BLANK_PART = 3


@query("split_parts", f"WITH {S.parts_cte(PART_TOKENS)}\nSELECT doc_id, part, part_text, n_parts FROM parts")
def q_split_parts(spark, sf):
    """O-43: whole documents cut into 64-word parts (short ones kept verbatim)."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return GN.split_parts(d, "text", PART_TOKENS).select("doc_id", "part", "part_text", "n_parts")


@query("long_text_corrected", f"""WITH {S.parts_cte(PART_TOKENS)},
g AS (SELECT doc_id, part, CASE WHEN part = {BLANK_PART} THEN '' ELSE translate(part_text, 'aeiou', 'AEIOU') END AS out
      FROM parts)
SELECT doc_id, count(*)::BIGINT AS n_parts, string_agg(out, ' ' ORDER BY part) AS model_corrected,
       string_agg(CASE WHEN {S.strip('out')} = '' THEN 'Model produced empty output'
                       ELSE 'Model produced valid output' END, ' | ' ORDER BY part) AS notes
FROM g GROUP BY doc_id""")
def q_long_text_corrected(spark, sf):
    """O-82 (O-43 -> generator per part -> O-65 notes -> O-37 reassembly)."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return GN.correct_long_text(d, "doc_id", "text", ST.part_stub_factory(BLANK_PART), max_tokens=PART_TOKENS)


# ====================================================================== conversations / SFT

from ..operators import sft as SF  # noqa: E402


def prepared_convs(spark, sf):
    return SF.prepare_turns(SF.gather_turns(FX.turns(spark, sf)))


@query("sft_roles", S.with_ctes(["checked"], """
SELECT conv_id, len(turns)::BIGINT AS n_turns, leading_dropped, system, status,
       array_to_string(list_transform(dialog, lambda x: """ + S.signal_role("x['from']") + """), ',') AS roles
FROM checked"""))
def q_sft_roles(spark, sf):
    """O-68 / O-69 / O-70: role mapping, leading non-human turn dropped, alternation check."""
    p = prepared_convs(spark, sf)
    roles = F.array_join(F.transform("dialog", lambda x: SF.map_role(x["from"], "signal", SF.SIGNAL_ROLES)), ",")
    return p.select("conv_id", F.size("turns").cast("long").alias("n_turns"), "leading_dropped", "system", "status",
                    roles.alias("roles"))


@query("render_signal", S.with_ctes(["checked"], "SELECT conv_id, " + S.render_signal("dialog", "system")
                                    + " AS prompt FROM checked WHERE status <> 'empty'"))
def q_render_signal(spark, sf):
    """O-71: header (system turn or default) and ``### Role: text`` lines."""
    p = prepared_convs(spark, sf).filter(F.col("status") != "empty")
    return p.select("conv_id", SF.render_signal(F.col("dialog"), SF.signal_header(F.col("system"))).alias("prompt"))


@query("render_template", S.with_ctes(["checked"], """
SELECT conv_id, coalesce(system, """ + S.q(S.SFT_DEFAULT_SYSTEM) + """) || ' ' || array_to_string(list_transform(dialog,
  lambda x, i: CASE WHEN x['value'] IS NULL OR x['value'] = ''
    THEN (CASE x['from'] WHEN 'human' THEN 'USER' ELSE 'ASSISTANT' END) || ':'
    ELSE (CASE x['from'] WHEN 'human' THEN 'USER' ELSE 'ASSISTANT' END) || ': ' || x['value'] ||
         CASE WHEN (i - 1) % 2 = 0 THEN ' ' ELSE '</s>' END END), '') AS prompt
FROM checked WHERE status = 'ok'"""))
def q_render_template(spark, sf):
    """O-72: two-separator template prompt for valid conversations."""
    p = prepared_convs(spark, sf).filter(F.col("status") == "ok")
    return p.select("conv_id", SF.render_template(F.col("dialog"), F.col("system")).alias("prompt"))


SFT_MAX = 1024
_LM_IDS, _LM_LABELS = S.label_mask_ids("dialog", "system", SFT_MAX)


@query("label_mask", S.with_ctes(["checked"], f"""
, lm AS (SELECT conv_id, {_LM_IDS} AS ids, {_LM_LABELS} AS labels FROM checked WHERE status = 'ok')
SELECT conv_id, len(ids)::BIGINT AS n_tokens, len(list_filter(labels, lambda v: v <> -100))::BIGINT AS n_trained,
       array_to_string(ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels FROM lm"""))
def q_label_mask(spark, sf):
    """O-75: signal-format token ids and labels with human text masked."""
    p = prepared_convs(spark, sf).filter(F.col("status") == "ok")
    m = p.select("conv_id", SF.label_mask(F.col("dialog"), SF.signal_header(F.col("system")), SFT_MAX).alias("m"))
    return m.select("conv_id", F.size("m.input_ids").cast("long").alias("n_tokens"),
                    F.size(F.filter("m.labels", lambda v: v != K_IGNORE)).cast("long").alias("n_trained"),
                    F.array_join("m.input_ids", " ").alias("input_ids"), F.array_join("m.labels", " ").alias("labels"))


K_IGNORE = SF.K.IGNORE_INDEX


@query("collated", S.with_ctes(["checked"], f"""
, lm AS (SELECT conv_id, {_LM_IDS} AS ids, {_LM_LABELS} AS labels FROM checked WHERE status = 'ok')
, b AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // 16 AS batch FROM lm)
, w AS (SELECT *, least(max(len(ids)) OVER (PARTITION BY batch), {SFT_MAX}) AS width FROM b)
SELECT conv_id, batch::BIGINT AS batch, width AS padded_len,
       array_to_string(list_concat(ids[1:width], {S.repeat_list('1', 'width - len(ids)')}), ' ') AS input_ids,
       array_to_string(list_concat(labels[1:width], {S.repeat_list('-100', 'width - len(labels)')}), ' ') AS labels,
       len(list_filter(list_concat(ids[1:width], {S.repeat_list('1', 'width - len(ids)')}), lambda v: v <> 1))::BIGINT
         AS n_attended
FROM w"""))
def q_collated(spark, sf):
    """O-77: batches of 16 padded to the batch maximum (cut at 1024), mask = id != pad."""
    p = prepared_convs(spark, sf).filter(F.col("status") == "ok")
    m = p.select("conv_id", SF.label_mask(F.col("dialog"), SF.signal_header(F.col("system")), SFT_MAX).alias("m"))
    m = m.select("conv_id", F.col("m.input_ids").alias("input_ids"), F.col("m.labels").alias("labels"))
    c = SF.collate(m, ["conv_id"], 16, SFT_MAX)
    return c.select("conv_id", "batch", "padded_len", F.array_join("input_ids", " ").alias("input_ids"),
                    F.array_join("labels", " ").alias("labels"),
                    F.size(F.filter("attention_mask", lambda b: b)).cast("long").alias("n_attended"))


@query("tokenised_ladder", _training_with(f"""
, tk AS (SELECT arm, id, {S.token_ids(S.words("(SELECT pyte FROM training t WHERE t.id = ladder.id)"))} AS ii,
                {S.token_ids(S.words('target'))} AS tt FROM ladder)
SELECT arm, id, least(len(ii), {SFT_MAX})::INT AS n_input, least(len(tt), {SFT_MAX})::INT AS n_target,
       array_to_string(list_concat(ii[1:{SFT_MAX}], {S.repeat_list('1', f'{SFT_MAX} - len(ii)')}), ' ') AS input_ids,
       array_to_string(list_concat(tt[1:{SFT_MAX}], {S.repeat_list('1', f'{SFT_MAX} - len(tt)')}), ' ') AS labels
FROM tk"""))
def q_tokenised_ladder(spark, sf):
    """O-76 (+ O-13 layout): every ladder arm tokenised and padded to 1024.

    Each document is tokenised once (input, gold and silver ids), then the ladder fans
    the id arrays out to the arms."""
    tok = training(spark, sf).select("id", SF.token_ids_cut(F.col("pyte"), SFT_MAX).alias("pyte"),
                                     SF.token_ids_cut(F.col("gold"), SFT_MAX).alias("gold"),
                                     SF.token_ids_cut(F.col("silver"), SFT_MAX).alias("silver"))
    lad = L.size_ladder(tok, ["id"])
    t = lad.select("arm", "id", SF.pad_ids(F.col("pyte"), F.col("target"), SFT_MAX).alias("t"))
    return t.select("arm", "id", F.col("t.n_input").alias("n_input"), F.col("t.n_target").alias("n_target"),
                    F.array_join("t.input_ids", " ").alias("input_ids"), F.array_join("t.labels", " ").alias("labels"))


@query("conversation_lengths", S.with_ctes(["convs"], f"""
SELECT conv_id, sum(len({S.words('value')}))::BIGINT AS n_words, sum(len({S.words('value')}))::BIGINT AS length,
       (-sum(len({S.words('value')})))::BIGINT AS modality_length FROM turns GROUP BY conv_id"""))
def q_conversation_lengths(spark, sf):
    """O-39: length keys of text-only conversations (negative modality length)."""
    c = SF.gather_turns(FX.turns(spark, sf))
    return SF.conversation_lengths(c).select("conv_id", "n_words", "length", "modality_length")


_DOCS_SQL = S.with_ctes(["training", "listing"], """
, docs AS (SELECT id, 'images/' || id || '.jpg' AS image, 'What is the OCR of this image?' AS question,
                  gold AS answer FROM training WHERE id || '.jpg' IN (SELECT name FROM listing))
""")


@query("conversation_docs", _DOCS_SQL + f"""
SELECT id, image, 2::INT AS n_turns, question, answer,
       (len({S.words('question')}) + len({S.words('answer')}) + 128)::BIGINT AS length,
       (len({S.words('question')}) + len({S.words('answer')}))::BIGINT AS modality_length FROM docs""")
def q_conversation_docs(spark, sf):
    """O-67 (+ O-26, O-39): two-turn image conversations for present images."""
    t = training(spark, sf)
    present = A.keep_existing(t, FX.listing(spark, sf), F.concat(F.col("id"), F.lit(".jpg")))
    d = SF.to_conversations(present, "id", F.concat(F.lit("images/"), F.col("id"), F.lit(".jpg")), "gold")
    lens = SF.conversation_lengths(d, "conversations", has_image=F.col("image").isNotNull())
    return lens.select("id", "image", F.size("conversations").alias("n_turns"),
                       F.get("conversations", 0)["value"].alias("question"),
                       F.get("conversations", 1)["value"].alias("answer"), "length", "modality_length")


@query("hoist_image", S.with_ctes(["turns"], f"""
, mm AS (SELECT conv_id, turn, CASE WHEN "from" = 'human' AND turn <= 1 THEN value || ' <image>' ELSE value END AS v
         FROM turns)
SELECT conv_id, turn, CASE WHEN contains(v, '<image>')
  THEN {S.strip("'<image>' || " + S.NL + " || " + S.strip("replace(v, '<image>', '')"))} ELSE v END AS value FROM mm"""))
def q_hoist_image(spark, sf):
    """O-73: image token moved to the front of the first human turn."""
    t = FX.turns(spark, sf)
    mm = F.when((F.col("from") == "human") & (F.col("turn") <= 1), F.concat(F.col("value"), F.lit(" <image>"))).otherwise(
        F.col("value"))
    return t.select("conv_id", "turn", SF.hoist_image_token(mm).alias("value"))


@query("plain_pairs", _DOCS_SQL + """
SELECT id, true AS ok, '<image>' || answer || chr(10) AS text, 1::INT AS masked_tokens FROM docs""")
def q_plain_pairs(spark, sf):
    """O-74: plain image-caption pairs (token + answer + separator), token masked."""
    t = training(spark, sf)
    present = A.keep_existing(t, FX.listing(spark, sf), F.concat(F.col("id"), F.lit(".jpg")))
    d = SF.to_conversations(present, "id", F.lit(None).cast("string"), "gold",
                            question=SF.K.OCR_QUESTION + " " + SF.K.IMAGE_TOKEN)
    dialog = F.transform("conversations", lambda x: x.withField("value", SF.hoist_image_token(x["value"])))
    p = d.select("id", SF.plain_pair(dialog).alias("p"))
    return p.select("id", F.col("p.ok").alias("ok"), F.col("p.text").alias("text"),
                    F.col("p.masked_tokens").alias("masked_tokens"))


# ====================================================================== drift / requests / fetch

from ..operators import drift as DR  # noqa: E402
from ..operators import requests as RQ  # noqa: E402

_SUFFIX = "CASE WHEN label % 2 = 0 THEN '.lora_A' ELSE '.weight' END"


@query("vector_drift", f"""
WITH base AS (SELECT 'layer' || vec_id || {_SUFFIX} AS name, embedding AS vec FROM embeddings),
tuned AS (SELECT 'layer' || (vec_id + 1) || {_SUFFIX} AS name, embedding AS vec FROM embeddings)
SELECT t.name, CASE WHEN b.name IS NULL THEN 'new' ELSE 'diff' END AS kind,
  round(CASE WHEN b.name IS NULL THEN sqrt(list_sum(list_transform(t.vec, lambda x: x::DOUBLE * x::DOUBLE)))
        ELSE sqrt(list_sum(list_transform(range(1, len(t.vec) + 1),
             lambda i: (t.vec[i]::DOUBLE - b.vec[i]::DOUBLE) * (t.vec[i]::DOUBLE - b.vec[i]::DOUBLE)))) END, 6) AS l2
FROM tuned t LEFT JOIN base b USING (name) WHERE contains(lower(t.name), 'lora')""")
def q_vector_drift(spark, sf):
    """O-29: L2 drift of adapter vectors between two snapshots."""
    base, tuned = FX.vectors(spark, sf)
    return DR.vector_drift(base, tuned, "lora")


REQUEST_PROMPT = "Transcribe this letter and answer as JSON with ocr_text, summary, date, is_printed, is_legible.\n"


@query("request_lines", f"""
SELECT replace(lang || '/' || source || '/d' || doc_id || '.jpg', '/', '|') AS custom_id, 'image/jpeg' AS mime,
       (4 * ((strlen(text) + 2) // 3))::BIGINT AS b64_size, 'gpt-4o' AS model, 4000 AS max_tokens,
       {S.q(REQUEST_PROMPT.strip())} AS prompt,
       md5('data:image/jpeg;base64,' || to_base64(encode(text))) AS url_md5, 'POST' AS method
FROM documents""")
def q_request_lines(spark, sf):
    """O-56..O-59: request JSON per image (key, mime, data URL, size), read back."""
    r = RQ.request_lines(FX.items(spark, sf), REQUEST_PROMPT)
    p = F.from_json("request", RQ.R.REQUEST_SCHEMA)
    content = p["body"]["messages"][0]["content"]
    return r.select("custom_id", "mime", "b64_size", p["body"]["model"].alias("model"),
                    p["body"]["max_tokens"].alias("max_tokens"), content[0]["text"].alias("prompt"),
                    F.md5(content[1]["image_url"]["url"]).alias("url_md5"), p["method"].alias("method"))


@query("batch_records", """
SELECT 'batch_' || user_id AS id, 'batch' AS object,
       CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
                       WHEN 'signup' THEN 'expired' ELSE 'in_progress' END AS status,
       floor(epoch(ts))::BIGINT AS created_at, floor(value)::INT AS total_requests,
       floor(floor(value) / 2)::INT AS completed_requests, (floor(value) - floor(floor(value) / 2))::INT AS failed_requests,
       event_type AS description
FROM events""")
def q_batch_records(spark, sf):
    """O-66: batch metadata records (JSON with nested counts and a map) flattened."""
    ev = FX.status_events(spark, sf)
    total = F.floor("value").cast("int")
    done = F.floor(total / 2).cast("int")
    rec = F.to_json(F.struct(
        F.col("batch_id").alias("id"), F.lit("batch").alias("object"), F.lit("/v1/chat/completions").alias("endpoint"),
        F.col("status"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_at"),
        F.struct(total.alias("total"), done.alias("completed"), (total - done).alias("failed")).alias("request_counts"),
        F.create_map(F.lit("description"), F.col("event_type")).alias("metadata")))
    flat = RQ.batch_records(ev.select(rec.alias("record")))
    return flat.select("id", "object", "status", "created_at", "total_requests", "completed_requests",
                       "failed_requests", "description")


@query("fetch_manifest", """
WITH m AS (SELECT 'd' || p.page_id AS key, p.url, d.lang <> 'de' AS present
           FROM pages p JOIN documents d ON d.doc_id = p.page_id)
SELECT key, CASE WHEN present THEN 'Exists' WHEN length(url) % 7 >= 5 THEN 'Failed after max retries'
                 ELSE 'Downloaded' END AS status,
       (CASE WHEN present THEN 0 ELSE least(length(url) % 7 + 1, 5) END)::INT AS attempts,
       CASE WHEN NOT present AND length(url) % 7 < 5 THEN strlen(url) END::BIGINT AS bytes
FROM m""")
def q_fetch_manifest(spark, sf):
    """O-08: skip present images, fetch the rest with retries (stub fetcher, no sleeping)."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    manifest = pages.select(F.concat(F.lit("d"), F.col("page_id").cast("string")).alias("key"), "url")
    present = A.sidecar_texts(FX.engine(spark, sf)).select(F.col("id").alias("key"))
    return RQ.fetch_manifest(manifest, present, ST.stub_fetcher_factory, sleep=ST.no_sleep)


@query("fetch_again", """
WITH m AS (SELECT 'd' || p.page_id AS key, p.url, d.lang <> 'de' AS present
           FROM pages p JOIN documents d ON d.doc_id = p.page_id)
SELECT key, CASE WHEN present OR length(url) % 7 < 5 THEN 'Exists' ELSE 'Failed after max retries' END AS status,
       CASE WHEN NOT present AND length(url) % 7 < 5 THEN strlen(url) END::BIGINT AS kept_bytes
FROM m""")
def q_fetch_again(spark, sf):
    """O-08 twice: bodies are written by the tasks that fetch them; the second run finds them."""
    folder = scratch_dir(spark, "fetched")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    manifest = pages.select(F.concat(F.lit("d"), F.col("page_id").cast("string")).alias("key"), "url")
    present = A.sidecar_texts(FX.engine(spark, sf)).select(F.col("id").alias("key"))
    first = RQ.fetch_manifest(manifest, present, ST.stub_fetcher_factory, sleep=ST.no_sleep, folder=folder)
    first.write.format("noop").mode("overwrite").save()
    kept = RD.scan_listing(spark, folder).select(F.regexp_extract("name", r"^(.*)\.jpg$", 1).alias("key"), "length")
    again = RQ.fetch_manifest(manifest, present.union(kept.select("key")), ST.stub_fetcher_factory, sleep=ST.no_sleep)
    return again.select("key", "status").join(kept, "key", "left").select("key", "status", F.col("length").alias("kept_bytes"))


@query("transcribe", f"""
WITH todo AS (SELECT 'd' || doc_id AS id, text FROM documents WHERE lang = 'de')
SELECT id, CASE WHEN len({S.words('text')}) >= 3 THEN translate(text, 'ilo', '110') END AS text,
       CASE WHEN len({S.words('text')}) < 3 THEN 'ValueError: unreadable image' END AS error
FROM todo""")
def q_transcribe(spark, sf):
    """O-81: engine over images without an engine sidecar yet (errors captured)."""
    listing = RD.scan_listing(spark, _image_folder(spark, sf), recursive=True).select(
        F.regexp_extract("name", r"^(d[0-9]+)\.jpg$", 1).alias("id"), "path")
    done = A.sidecar_texts(FX.engine(spark, sf))
    return RQ.transcribe_paths(listing, done, ST.stub_engine_factory)


# ====================================================================== sources / sinks round trips

from ..session import scratch_dir  # noqa: E402
from ..sinks import progress as PG  # noqa: E402
from ..sinks import writers as WR  # noqa: E402
from ..sources import readers as RD  # noqa: E402


@query("csv_roundtrip", S.with_ctes(["training"], "SELECT id, gold, silver, pyte FROM training"))
def q_csv_roundtrip(spark, sf):
    """O-10 then O-01: the training table written as CSV (multi-line cells, quotes) and
    read back with an explicit schema, in a folder under the checkpoint location."""
    out = scratch_dir(spark, "training_csv")
    WR.write_csv(training(spark, sf), out)
    return RD.scan_csv(spark, out, "id string, gold string, silver string, pyte string")


_REPEATED = """
WITH k AS (SELECT CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 3 = 0 THEN 'hot' ELSE 'd' || doc_id END AS id, text
           FROM (SELECT doc_id, text FROM documents UNION ALL SELECT doc_id, text FROM documents)),
r AS (SELECT id, row_number() OVER (ORDER BY id NULLS FIRST, text) AS rn FROM k),
arms AS (SELECT l.label, s.size FROM (VALUES ('gold'), ('silver')) l(label), (VALUES (150), (100000)) s(size))
SELECT a.label || '_' || a.size AS arm, r.id, count(*)::BIGINT AS n, min(r.rn)::BIGINT AS first_rn, max(r.rn)::BIGINT AS last_rn
FROM r JOIN arms a ON r.rn <= a.size GROUP BY ALL"""


_SPACED = """CASE doc_id % 7 WHEN 0 THEN '  ' || text WHEN 1 THEN text || '  ' WHEN 2 THEN chr(9) || text || chr(9)
  WHEN 3 THEN ' ' WHEN 4 THEN '' WHEN 5 THEN NULL ELSE text END"""


@query("fill_if_null", """
SELECT doc_id, coalesce(CASE WHEN doc_id % 3 = 0 THEN NULL ELSE lang END, upper(source)) AS label FROM documents""")
def q_fill_if_null(spark, sf):
    """O-22: only missing cells are computed, filled ones are kept."""
    from ..functions import nulls as NU

    d = spark.read.parquet(f"{sf}/documents.parquet")
    held = d.select("doc_id", "source", F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("label"))
    return NU.fill_if_null(held, "label", F.upper("source")).select("doc_id", "label")


@query("csv_white_space", f"SELECT doc_id, {_SPACED} AS text FROM documents")
def q_csv_white_space(spark, sf):
    """O-10 then O-01: leading, trailing and only white space, empty and null cells survive."""
    out = scratch_dir(spark, "csv_white_space")
    d = spark.read.parquet(f"{sf}/documents.parquet")
    k = F.col("doc_id") % 7
    text = (F.when(k == 0, F.concat(F.lit("  "), "text")).when(k == 1, F.concat("text", F.lit("  ")))
            .when(k == 2, F.concat(F.lit("\t"), "text", F.lit("\t"))).when(k == 3, F.lit(" ")).when(k == 4, F.lit(""))
            .when(k == 5, F.lit(None)).otherwise(F.col("text")))
    WR.write_csv(d.select("doc_id", text.alias("text")), out)
    return RD.scan_csv(spark, out, "doc_id long, text string")


@query("size_ladder_repeated_keys", _REPEATED)
def q_size_ladder_repeated_keys(spark, sf):
    """O-44 over keys of which many are null and a third is one and the same."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    key = F.when(F.col("doc_id") % 10 == 0, None).when(F.col("doc_id") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    rows = d.union(d).select(key.alias("id"), "text", F.col("text").alias("gold"), F.col("text").alias("silver"))
    lad = L.size_ladder(rows, ["id", "text"], sizes=[150, 100_000], labels=["gold", "silver"])
    return lad.groupBy("arm", "id").agg(F.count("*").alias("n"), F.min("rn").alias("first_rn"), F.max("rn").alias("last_rn"))


@query("splits_roundtrip", _training_with("""
, r AS (SELECT arm, id, row_number() OVER (PARTITION BY arm ORDER BY md5('42|' || id), id) AS r,
               count(*) OVER (PARTITION BY arm) AS n FROM ladder)
, h AS (SELECT *, ceil(0.2::DOUBLE * n)::BIGINT AS held FROM r)
SELECT arm, id, CASE WHEN r <= n - held THEN 'train' WHEN r <= n - held + (held - ceil(held / 2)::BIGINT) THEN 'val' ELSE 'test' END AS split
FROM h
"""))
def q_splits_roundtrip(spark, sf):
    """O-13 then O-07: splits written partitioned by arm / split, each read back through
    partition pruning."""
    out = scratch_dir(spark, "splits")
    WR.write_splits(L.split_80_10_10(ladder(spark, sf).select("arm", "id"), "id", ["arm"]), out)
    parts = [RD.scan_splits(spark, out, split=x).select("arm", "id", F.lit(x).alias("split")) for x in ("train", "val", "test")]
    return parts[0].union(parts[1]).union(parts[2])


_SIDE_CONTENT = S.tagged_content("ocr_text", "summary", "date", "is_printed", "is_legible")


@query("sidecar_table", S.with_ctes(["answer_fields"], f"""
SELECT custom_id AS key, sidecar_path AS path, {_SIDE_CONTENT} AS content FROM answer_fields WHERE has_choices"""))
def q_sidecar_table(spark, sf):
    """O-14: tagged sidecars written as a (key, path, content) table and read back."""
    out = scratch_dir(spark, "sidecars")
    WR.write_sidecars(RS.collect_results(FX.responses(spark, sf)), out)
    return spark.read.parquet(out).select("key", "path", "content")


@query("result_lines_roundtrip", S.with_ctes(["responses"], f"""
SELECT custom_id, has_choices,
  CASE WHEN has_choices THEN {S.answer_field(S.strip_fence('content'), 'ocr_text')} END AS ocr_text,
  CASE WHEN has_choices THEN {S.answer_field(S.strip_fence('content'), 'summary')} END AS summary,
  CASE WHEN has_choices THEN coalesce(nullif({S.answer_field(S.strip_fence('content'), 'date')}, ''),
                                      {S.q(A.K.DEFAULT_DATE)}) END AS date,
  CASE WHEN has_choices THEN {S.answer_field(S.strip_fence('content'), 'is_printed')} = 'true' END AS is_printed,
  CASE WHEN has_choices THEN {S.answer_field(S.strip_fence('content'), 'is_legible')} = 'true' END AS is_legible
FROM responses"""))
def q_result_lines_roundtrip(spark, sf):
    """O-04 reader: result lines written as text files, read back whole with exact line
    numbers, parsed line by line (O-60..O-62)."""
    out = scratch_dir(spark, "result_lines")
    FX.responses(spark, sf).select(F.col("line").alias("value")).write.mode("overwrite").text(out)
    lines = RD.scan_result_jsonl(spark, out, suffix=".txt")
    a = RS.answer_sidecars(RS.parse_result_lines(lines).filter(~F.col("malformed")))
    return a.select("custom_id", "has_choices", "ocr_text", "summary", "date", "is_printed", "is_legible")


@query("request_files", _pack_sql(60000, skip=True) + "SELECT shard, batch, replace(path, '/', '|') AS custom_id, reason FROM packed")
def q_request_files(spark, sf):
    """O-11: request JSONL written one folder per batch (O-40 assignment, budget 60000) and read
    back, and the requests that no batch could take, with the reason."""
    packed = PK.pack_batches(_request_items(spark, sf), ["path"], "size", budget=60000, shard="shard", oversize="skip")
    req = RQ.request_lines(FX.items(spark, sf), REQUEST_PROMPT).join(packed, "path")
    name = F.when(F.col("batch").isNotNull(), F.concat_ws("-", "shard", F.col("batch").cast("string")))
    out = scratch_dir(spark, "requests")
    WR.write_request_jsonl(req.select("request", name.alias("batch")), out)
    back = spark.read.text(out)
    sent = back.select(F.substring_index("batch", "-", 1).alias("shard"), F.substring_index(F.col("batch"), "-", -1).cast("long").alias("batch"),
                       F.from_json("value", RQ.R.REQUEST_SCHEMA)["custom_id"].alias("custom_id"), F.lit(None).cast("string").alias("reason"))
    left = packed.filter(F.col("batch").isNull()).select("shard", "batch", TX.path_to_key("path").alias("custom_id"), "reason")
    return sent.unionByName(left)


@query("conversation_files", _training_with("""
SELECT arm, id, 'What is the OCR of this image?' AS question, target AS answer FROM ladder WHERE complete"""))
def q_conversation_files(spark, sf):
    """O-12 then O-06: conversation documents of every complete arm written one folder per
    arm (JSON lines) and read back."""
    lad = L.size_ladder(training(spark, sf), ["id"], complete_only=True)
    docs = SF.to_conversations(lad, "id", F.concat(F.lit("images/"), F.col("id"), F.lit(".jpg")), "target",
                               keep=["arm"])
    out = scratch_dir(spark, "conversations")
    WR.write_conversations(docs, out)
    back = RD.scan_conversation_lines(spark, out, arm="arm")
    return back.select("arm", "id", F.get("conversations", 0)["value"].alias("question"),
                       F.get("conversations", 1)["value"].alias("answer"))


def _arms_of(arms):
    return lambda rows: GN.apply_arms(rows, arms, ST.stub_factory, "id", "pyte")


@query("progress_resume", _ARM_OUT_SQL + "SELECT id, arm, output, status FROM arm_out")
def q_progress_resume(spark, sf):
    """O-16 + O-22 / O-27: a first run over two thirds of the rows and the untuned arm only, then the
    run over all rows and arms adds the rest; the table holds every output once."""
    out = scratch_dir(spark, "progress")
    t = training(spark, sf)
    PG.append_progress(t.where(F.crc32("id") % 3 != 0), out, _arms_of(ARMS[:1]), ARMS[:1])
    PG.append_progress(t, out, _arms_of(ARMS), ARMS)
    return PG.read_progress(spark, out).select("id", "arm", "output", "status")


_AGAIN_SQL = _ARM_OUT_SQL + """, twice AS (SELECT CASE WHEN id LIKE '%7' THEN NULL WHEN id LIKE '%3' THEN 'hot' ELSE id END AS id, arm, output, status
  FROM arm_out, (VALUES (1), (2)) AS n(copy) WHERE arm IN ('untuned', 'gold_100'))
"""


@query("progress_changed_rows", _AGAIN_SQL + "SELECT id, arm, output, status FROM twice")
def q_progress_changed_rows(spark, sf):
    """O-16 over rows with null and repeated keys, each twice: a run over some rows that are later
    changed or removed, one over more rows, then all; outputs of the rows that are there, each once."""
    out, arms = scratch_dir(spark, "progress"), ["untuned", "gold_100"]
    t = training(spark, sf)
    key = F.when(F.col("id").endswith("7"), None).when(F.col("id").endswith("3"), "hot").otherwise(F.col("id"))
    rows = t.union(t).withColumn("id", key)
    old = rows.where(F.crc32("pyte") % 4 == 0).withColumn("gold", F.concat("gold", F.lit("?")))
    PG.append_progress(rows.where(F.crc32("pyte") % 4 == 1).union(old), out, _arms_of(arms), arms, every=100)
    PG.append_progress(rows.where(F.crc32("pyte") % 4 < 2), out, _arms_of(arms[:1]), arms[:1], every=100)
    PG.append_progress(rows, out, _arms_of(arms), arms, every=100)
    return PG.read_progress(spark, out, rows).select("id", "arm", "output", "status")


@query("csv_null_tokens", _testing_sql("""
SELECT c AS "column", n_null::BIGINT AS n_null FROM (
  SELECT 'pyte_ocr' AS c, count(*) FILTER (WHERE pyte_ocr = '') AS n_null FROM testing
  UNION ALL SELECT 'chatgpt_ocr', count(*) FILTER (WHERE chatgpt_ocr = '') FROM testing
  UNION ALL SELECT 'is_printed', count(*) FILTER (WHERE is_printed = '') FROM testing
  UNION ALL SELECT 'BART_untuned', count(*) FROM testing)"""))
def q_csv_null_tokens(spark, sf):
    """O-10 / O-01 / O-05: the testing table written as CSV and read back with the
    pandas null tokens made explicit; blank cells come back as nulls."""
    out = scratch_dir(spark, "testing_csv")
    WR.write_csv(testing(spark, sf).drop("_miss_pyte", "_miss_chatgpt"), out)
    schema = ", ".join(f"{c} string" for c in A.K.TESTING_TEMPLATE)
    back = RD.scan_csv(spark, out, schema, null_tokens=A.K.PANDAS_NULL_TOKENS)
    cols = ["pyte_ocr", "chatgpt_ocr", "is_printed", "BART_untuned"]
    counts = back.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_null"))
                                             for c in cols])).alias("r")).select("r.*")


@query("training_log", """
SELECT event_id AS step, value AS loss, value / 2 AS eval_loss,
       CASE WHEN event_type = 'purchase' THEN value / 100 END AS eval_accuracy FROM events""")
def q_training_log(spark, sf):
    """O-09: a tab-separated training log (derived from events) written and read back."""
    out = scratch_dir(spark, "training_log")
    e = spark.read.parquet(f"{sf}/events.parquet")
    log = e.select(F.col("event_id").alias("step"), F.col("value").alias("loss"),
                   (F.col("value") / 2).alias("eval_loss"),
                   F.when(F.col("event_type") == "purchase", F.col("value") / 100).alias("eval_accuracy"))
    log.write.mode("overwrite").option("header", True).option("sep", "\t").csv(out)
    return RD.scan_training_log(spark, out)


@query("label_mask_template", S.with_ctes(["checked"], f"""
, t AS (SELECT conv_id, {S.template_prompt('dialog', 'system')} AS prompt FROM checked WHERE status = 'ok')
, r AS (SELECT conv_id, prompt, {S.template_tokens('prompt')} AS toks, string_split(prompt, '</s>') AS rounds FROM t)
, f AS (SELECT *, {S.token_ids('toks')} AS ids,
          list_transform(rounds, lambda x: x <> '' AND len(string_split(x, ' ASSISTANT: ')) = 2) AS valid,
          list_transform(rounds, lambda x: len({S.template_tokens('x')}) + 1) AS rlen,
          list_transform(rounds, lambda x: len({S.template_tokens("string_split(x, ' ASSISTANT: ')[1] || ' ASSISTANT: '")}))
            AS ilen FROM r)
, g AS (SELECT *, CASE WHEN list_position(valid, false) IS NULL THEN len(rounds)
                       ELSE list_position(valid, false) - 1 END AS k FROM f)
, h AS (SELECT *, coalesce(list_sum(rlen[1:k]), 0) AS cur, least(len(toks), {SFT_MAX}) AS total FROM g)
, m AS (SELECT conv_id, ids[1:{SFT_MAX}] AS ids, list_transform(ids, lambda tk, p:
          CASE WHEN (cur < {SFT_MAX} AND cur <> total) OR (p - 1) >= cur
                 OR len(list_filter(range(1, k + 1), lambda i: (p - 1) >= coalesce(list_sum(rlen[1:i - 1]), 0)
                        AND (p - 1) < coalesce(list_sum(rlen[1:i - 1]), 0) + ilen[i])) > 0
               THEN -100 ELSE tk END)[1:{SFT_MAX}] AS labels FROM h)
SELECT conv_id, len(ids)::BIGINT AS n_tokens, len(list_filter(labels, lambda v: v <> -100))::BIGINT AS n_trained,
       array_to_string(ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels FROM m"""))
def q_label_mask_template(spark, sf):
    """O-75 for the two-separator template: instruction parts masked per round; rows whose
    walk does not end at the token count (e.g. a last user turn without answer) fully masked."""
    p = prepared_convs(spark, sf).filter(F.col("status") == "ok")
    m = p.select("conv_id", SF.label_mask_template(F.col("dialog"), F.col("system"), max_length=SFT_MAX).alias("m"))
    return m.select("conv_id", F.size("m.input_ids").cast("long").alias("n_tokens"),
                    F.size(F.filter("m.labels", lambda v: v != K_IGNORE)).cast("long").alias("n_trained"),
                    F.array_join("m.input_ids", " ").alias("input_ids"), F.array_join("m.labels", " ").alias("labels"))


_ANSWER = f"'<|im_end|><|im_start|>assistant' || {S.NL}"


@query("label_mask_rounds", S.with_ctes(["checked"], f"""
, t AS (SELECT conv_id, {S.rounds_prompt('dialog', 'system')} AS prompt FROM checked WHERE status = 'ok')
, c AS (SELECT conv_id, {S.rounds_tokens('prompt')} AS toks, string_split(prompt, '<|im_end|>') AS pieces FROM t)
, r AS (SELECT conv_id, toks, list_concat([array_to_string(pieces[1:3], '<|im_end|>')],
          list_transform(range(4, len(pieces) + 1, 2), lambda i: array_to_string(pieces[i:i + 1], '<|im_end|>'))) AS rounds FROM c)
, f AS (SELECT *, {S.token_ids('toks')} AS ids,
          list_transform(rounds, lambda x: x <> '' AND len(string_split(x, {_ANSWER})) = 2) AS valid,
          list_transform(rounds, lambda x: len({S.rounds_tokens('x')}) + 1) AS rlen,
          list_transform(rounds, lambda x: len({S.rounds_tokens(f"string_split(x, {_ANSWER})[1] || {_ANSWER}")})) AS ilen FROM r)
, g AS (SELECT *, CASE WHEN list_position(valid, false) IS NULL THEN len(rounds) ELSE list_position(valid, false) - 1 END AS k FROM f)
, h AS (SELECT *, coalesce(list_sum(rlen[1:k]), 0) AS cur, least(len(toks), {SFT_MAX}) AS total FROM g)
, m AS (SELECT conv_id, ids[1:{SFT_MAX}] AS ids, list_transform(ids, lambda tk, p:
          CASE WHEN (cur < {SFT_MAX} AND cur <> total) OR (p - 1) >= cur
                 OR len(list_filter(range(1, k + 1), lambda i: (p - 1) >= coalesce(list_sum(rlen[1:i - 1]), 0)
                        AND (p - 1) < coalesce(list_sum(rlen[1:i - 1]), 0) + ilen[i])) > 0
               THEN -100 ELSE tk END)[1:{SFT_MAX}] AS labels FROM h)
SELECT conv_id, len(ids)::BIGINT AS n_tokens, len(list_filter(labels, lambda v: v <> -100))::BIGINT AS n_trained,
       array_to_string(ids, ' ') AS input_ids, array_to_string(labels, ' ') AS labels FROM m"""))
def q_label_mask_rounds(spark, sf):
    """O-75 for the one-separator prompt: rounds of system + question + answer, then pairs."""
    p = prepared_convs(spark, sf).filter(F.col("status") == "ok")
    m = p.select("conv_id", SF.label_mask_rounds(F.col("dialog"), F.col("system"), max_length=SFT_MAX).alias("m"))
    return m.select("conv_id", F.size("m.input_ids").cast("long").alias("n_tokens"),
                    F.size(F.filter("m.labels", lambda v: v != K_IGNORE)).cast("long").alias("n_trained"),
                    F.array_join("m.input_ids", " ").alias("input_ids"), F.array_join("m.labels", " ").alias("labels"))


@query("plain_pair_ids", _DOCS_SQL + f"""
, p AS (SELECT id, {S.token_ids(S.words('answer'))} AS ids FROM docs)
SELECT id, (len(ids) + 1)::BIGINT AS n_tokens, array_to_string(list_concat([-200], ids), ' ') AS input_ids,
       array_to_string(list_concat([-100], ids), ' ') AS labels FROM p""")
def q_plain_pair_ids(spark, sf):
    """O-74: token ids and labels of plain pairs; the image mark touches the answer's first word and
    is a token of its own."""
    t = training(spark, sf)
    present = A.keep_existing(t, FX.listing(spark, sf), F.concat(F.col("id"), F.lit(".jpg")))
    d = SF.to_conversations(present, "id", F.lit(None).cast("string"), "gold", question=SF.K.OCR_QUESTION + " " + SF.K.IMAGE_TOKEN)
    p = d.select("id", SF.plain_pair_ids(F.col("conversations")).alias("p"))
    return p.select("id", F.size("p.input_ids").cast("long").alias("n_tokens"), F.array_join("p.input_ids", " ").alias("input_ids"),
                    F.array_join("p.labels", " ").alias("labels"))


_BROKEN_TURNS = """turns AS (SELECT conv_id, turn, CASE WHEN conv_id % 11 = 2 AND turn = 2 THEN 'tool' ELSE "from" END AS "from", value FROM all_turns
  WHERE NOT (conv_id % 7 = 3 AND turn = 1))"""


@query("rejected_conversations", f"""WITH all_turns AS ({S.CTE['turns']}), {_BROKEN_TURNS}, convs AS ({S.CTE['convs']}), prepared AS ({S.CTE['prepared']}), checked AS ({S.CTE['checked']})
SELECT conv_id, status, len(dialog)::BIGINT AS n_turns, array_to_string(list_transform(dialog, lambda x: x['from'] || ': ' || x['value']), chr(10)) AS dialog
FROM checked WHERE status <> 'ok'""")
def q_rejected_conversations(spark, sf):
    """O-15 + O-70: conversations that no walk takes (a turn lost, a role unknown), written to
    quarantine with their turns and the reason, and read back."""
    out = scratch_dir(spark, "rejected")
    lost = (F.col("conv_id") % 7 == 3) & (F.col("turn") == 1)
    role = F.when((F.col("conv_id") % 11 == 2) & (F.col("turn") == 2), "tool").otherwise(F.col("from"))
    turns = FX.turns(spark, sf).where(~lost).withColumn("from", role)
    bad = SF.prepare_turns(SF.gather_turns(turns)).filter(F.col("status") != "ok")
    WR.write_quarantine(bad.select("conv_id", "status", "dialog"), out)
    text = F.array_join(F.transform("dialog", lambda x: F.concat(x["from"], F.lit(": "), x["value"])), "\n")
    return spark.read.parquet(out).select("conv_id", "status", F.size("dialog").cast("long").alias("n_turns"), text.alias("dialog"))


@query("quarantined_sidecars", """
SELECT 'd' || doc_id || '.jpg.txt' AS name, 'error' AS outcome FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_quarantined_sidecars(spark, sf):
    """O-15: sidecars that could not be read (here of documents without labels) go to quarantine with
    their outcome, the others on."""
    out = scratch_dir(spark, "quarantine")
    names = FX.gold(spark, sf).select(F.concat("Asset", F.lit(".jpg.txt")).alias("name"))
    side = names.join(FX.tagged(spark, sf), "name", "left")
    _, bad = A.quarantine(A.parse_sidecars(side))
    WR.write_quarantine(bad.select("name", "outcome"), out)
    return spark.read.schema("name string, outcome string").parquet(out)


GLOBAL_BUDGET = 100000


@query("request_batches_single", _pack_sql(GLOBAL_BUDGET, PK.K.MAX_BATCHES, one=True) + "SELECT path, size, batch, reason FROM packed")
def q_request_batches_single(spark, sf):
    """O-40 for parity with the original's form: one listing, no shards, its limit of 200 batches."""
    items = _request_items(spark, sf).drop("shard")
    return PK.pack_batches(items, ["path"], "size", budget=GLOBAL_BUDGET, max_batches=PK.K.MAX_BATCHES)


# ====================================================================== streams

from ..streaming import ingest as STR
from ..streaming import ledger as LG  # noqa: E402


@query("result_stream", S.with_ctes(["answer_fields"], """
SELECT custom_id, has_choices, ocr_text, summary, date, is_printed, is_legible, sidecar_path FROM answer_fields"""))
def q_result_stream(spark, sf):
    """O-78: result files ingested by a Structured Streaming query (availableNow, checkpointed,
    idempotent per-epoch writes) and read back as the current answers (last line per key)."""
    base = scratch_dir(spark, "result_stream")
    src = f"{base}/incoming"
    # result files in line order (range-partitioned by line number, one file per partition)
    FX.responses(spark, sf).orderBy("line_no").select(F.col("line").alias("value")).write.mode(
        "overwrite").text(src)
    q = STR.ingest_results_stream(spark, src, f"{base}/table", f"{base}/checkpoint", suffix=".txt")
    q.awaitTermination()
    cur = STR.current_results(spark, f"{base}/table")
    return cur.select("custom_id", "has_choices", "ocr_text", "summary", "date", "is_printed", "is_legible",
                      "sidecar_path")


LEDGER_SLICES, LEDGER_FILES = 5, 4


_LEDGER_SQL = f"""
WITH p AS (SELECT 'batch_' || user_id AS batch_id, ts, event_id,
                  CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
                                  WHEN 'signup' THEN 'expired' ELSE 'in_progress' END AS status FROM events),
s AS (SELECT *, status IN ('completed', 'failed', 'expired') AS term,
             sum((status NOT IN ('completed', 'failed', 'expired'))::INT) OVER w AS nt,
             row_number() OVER w AS rn
      FROM p WINDOW w AS (PARTITION BY batch_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
e AS (SELECT batch_id, arg_min(status, (ts, event_id)) AS st, arg_min(nt, (ts, event_id)) AS nt,
             arg_min(rn, (ts, event_id)) AS rn, arg_min(NOT term, (ts, event_id)) AS gave_up
      FROM s WHERE term OR nt > {LEDGER_RETRY} GROUP BY batch_id)
SELECT batch_id, CASE WHEN gave_up THEN 'given_up' ELSE st END AS outcome,
       (CASE WHEN gave_up THEN {LEDGER_RETRY} ELSE nt END)::BIGINT AS attempts, rn::BIGINT AS polls FROM e
"""


@query("ledger_stream", _LEDGER_SQL)
def q_ledger_stream(spark, sf):
    """O-79 (stream): polls read as a stream, per-batch state with applyInPandasWithState;
    each batch's outcome is emitted once when it ends (pending batches stay in state)."""
    base = scratch_dir(spark, "ledger_stream")
    polls = FX.status_events(spark, sf).select("batch_id", "ts", "event_id", "status")
    # polls in order of time, a slice of several files a trigger: a batch's polls are spread over
    # micro-batches, and some come after its end
    days = polls.select(F.to_date("ts").alias("day")).distinct().count()
    step = max(1, -(-days // LEDGER_SLICES))
    first = polls.agg(F.min(F.to_date("ts"))).first()[0]
    part = F.floor(F.datediff(F.to_date("ts"), F.lit(first)) / step)
    for k in range(LEDGER_SLICES):
        (polls.filter(part == k if k < LEDGER_SLICES - 1 else part >= k).repartition(LEDGER_FILES).write.mode("append").parquet(f"{base}/polls"))
    stream = spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", LEDGER_FILES).parquet(f"{base}/polls")
    out = STR.batch_ledger_stream(stream, retry_limit=LEDGER_RETRY)
    q = (out.writeStream.format("parquet").option("path", f"{base}/out")
         .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").select("batch_id", "outcome", "attempts", "polls")


@query("ledger_stream_late", _LEDGER_SQL)
def q_ledger_stream_late(spark, sf):
    """O-79 (stream): polls that arrive up to two days late and out of order, applied in the order of
    their time behind the watermark; a closing poll moves the watermark past the last one."""
    base = scratch_dir(spark, "ledger_stream_late")
    polls = FX.status_events(spark, sf).select("batch_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "status")
    arrival = F.date_add(F.to_date("ts"), F.expr("cast(pmod(xxhash64(event_id), 3) as int)"))
    first, last, end = polls.agg(F.min(F.to_date("ts")), F.max(arrival), F.max("ts")).first()
    step = max(1, -(-((last - first).days + 1) // LEDGER_SLICES)) if first else 1
    part = F.floor(F.datediff(arrival, F.lit(first)) / step)
    closing = spark.range(1).select(F.lit("closing").alias("batch_id"), (F.lit(end) + F.expr("interval 10 days")).cast("timestamp").alias("ts"),
                                    F.lit(-1).cast("long").alias("event_id"), F.lit("in_progress").alias("status"))
    for k in range(LEDGER_SLICES):
        polls.filter(part == k).repartition(LEDGER_FILES).write.mode("append").parquet(f"{base}/polls")
    closing.write.mode("append").parquet(f"{base}/polls")
    stream = spark.readStream.schema(polls.schema).option("maxFilesPerTrigger", LEDGER_FILES).parquet(f"{base}/polls")
    out = LG.batch_ledger_in_time(stream, "4 days", retry_limit=LEDGER_RETRY)
    with LG.timers_store(spark):
        q = (out.writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out").select("batch_id", "outcome", "attempts", "polls")


# ====================================================================== sidecar folders and listings


#: Folders that files are dealt over: tasks that make files in one folder wait for each other.
FOLDERS = 256


def _folder_of(key):
    return F.format_string("%03d", F.pmod(F.crc32(key), F.lit(FOLDERS)))


def _image_folder(spark, sf) -> str:
    """A folder of image files (the document bytes), tagged sidecars and engine sidecars, all
    files of a document side by side in one of its folders."""
    base = scratch_dir(spark, "images")
    d = spark.read.parquet(f"{sf}/documents.parquet")
    images = d.select(F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("path"),
                      F.encode("text", "UTF-8").alias("content"))
    files = images.unionByName(FX.tagged(spark, sf).select(F.col("name").alias("path"),
                                                           F.encode("content", "UTF-8").alias("content")))
    files = files.unionByName(FX.engine(spark, sf).select(F.col("name").alias("path"),
                                                          F.encode("content", "UTF-8").alias("content")))
    dealt = files.withColumn("path", F.concat(_folder_of(F.substring_index("path", ".", 1)), F.lit("/"), "path"))
    WR.write_files(dealt, base).write.format("noop").mode("overwrite").save()
    return base


@query("sidecar_files", S.with_ctes(["silver"], "SELECT ID, ocr FROM silver"))
def q_sidecar_files(spark, sf):
    """O-14 files, then O-02: tagged sidecars written one file per key next to the images,
    read back whole from the folder (``*.txt``), once, and cleaned into the silver table."""
    folder, texts = _image_folder(spark, sf), scratch_dir(spark, "sidecar_texts")
    RD.scan_text_sidecars(spark, folder, ".txt", recursive=True).write.mode("overwrite").option("compression", "zstd").parquet(texts)
    return A.clean_silver(spark.read.parquet(texts))


@query("image_listing", """
SELECT 'd' || doc_id || '.jpg' AS name, strlen(text)::BIGINT AS length FROM documents""")
def q_image_listing(spark, sf):
    """O-03: image files of a mixed folder (images and both sidecar kinds) by suffix, metadata only."""
    folder = _image_folder(spark, sf)
    return RD.scan_listing(spark, folder, recursive=True).select("name", "length")


# ====================================================================== image arms and the guard inside generation

from ..operators import guarded as GD  # noqa: E402

_BEFORE, _AFTER = GN.K.IMAGE_PROMPT.split("{text}")
_IMAGE_SQL = f"""
WITH items AS (SELECT 'd' || doc_id AS id, text AS gold, CASE WHEN lang <> 'de' THEN translate(text, 'ilo', '110') END AS pyte FROM documents),
n AS (SELECT id, gold, pyte, row_number() OVER (ORDER BY id) AS place, {S.q(_BEFORE)} || pyte || {S.q(_AFTER)} AS prompt, strlen(html) AS bytes
      FROM items LEFT JOIN (SELECT 'd' || page_id AS id, html FROM pages) USING (id)),
arms(arm, step) AS (VALUES ('untuned', 0), {", ".join(f"('{a}', {m})" for a, m in ST.IMAGE_ARM_STEP.items())}),
r AS (SELECT id, gold, pyte, place, arm, bytes, prompt, CASE WHEN length(prompt) % 11 = 0 THEN ''
        ELSE translate(prompt, 'aeiou', 'AEIOU') || ' #' || bytes || CASE WHEN step > 0 AND length(prompt) % step = 0 THEN ' [' || arm || ']' ELSE '' END END AS raw
      FROM n, arms),
out AS (SELECT id, gold, pyte, place, arm, CASE WHEN bytes IS NULL THEN {S.q(GN.K.NO_IMAGE_ERROR)} WHEN raw IS NOT NULL AND {S.strip('raw')} = '' THEN {S.q(GN.K.BLANK_ERROR)} ELSE raw END AS output,
               CASE WHEN bytes IS NULL THEN 'no_image' WHEN prompt IS NULL THEN 'no_input' WHEN {S.strip('raw')} = '' THEN 'blank' ELSE 'ok' END AS status FROM r),
cmp AS (SELECT o.arm, o.place, o.output = b.output AS same FROM out o JOIN (SELECT place, output FROM out WHERE arm = 'untuned') b USING (place)
        WHERE o.arm <> 'untuned' AND o.status IN ('ok', 'blank')),
cs AS (SELECT *, sum(same::INT) OVER w AS cs FROM cmp WINDOW w AS (PARTITION BY arm ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
st AS (SELECT *, CASE WHEN same THEN cs - coalesce(max(CASE WHEN NOT same THEN cs END) OVER w, 0) ELSE 0 END AS streak
       FROM cs WINDOW w AS (PARTITION BY arm ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
stops AS (SELECT arm, min(place) FILTER (WHERE streak >= {NOOP_K}) AS stop FROM st GROUP BY arm)
"""
FIRST_ROUND = 32


def _image_items(spark, sf) -> tuple[DataFrame, str]:
    """(id, transcription, pyte_ocr, image) for every document, and the folder of the images that are there (one for each page)."""
    folder = scratch_dir(spark, "page_images")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    key = F.concat(F.lit("d"), F.col("page_id").cast("string"))
    files = pages.select(F.concat(_folder_of(key), F.lit("/"), key, F.lit(".jpg")).alias("path"), F.encode("html", "UTF-8").alias("content"))
    WR.write_files(files, folder).write.format("noop").mode("overwrite").save()
    gold = FX.gold(spark, sf).select(F.col("Asset").alias("id"), F.col("Transcription").alias("transcription"))
    items = A.join_sidecar_text(gold, A.sidecar_texts(FX.engine(spark, sf), out="pyte_ocr"))
    return items.withColumn("image", F.concat(F.lit(folder + "/"), _folder_of(F.col("id")), F.lit("/"), "id", F.lit(".jpg"))), folder


def _guarded(spark, sf) -> GD.Guarded:
    items, _ = _image_items(spark, sf)
    return GD.run_guarded(items, list(ST.IMAGE_ARM_STEP), ST.image_stub_factory, "id", ["id"], "pyte_ocr", scratch_dir(spark, "guarded"),
                          image="image", k=NOOP_K, first=FIRST_ROUND)


@query("image_arms", _IMAGE_SQL + "SELECT id, arm, output, status FROM out")
def q_image_arms(spark, sf):
    """O-80 + O-64 + O-65 over text and image: every arm over every document, the bytes read by the
    task that needs them; most documents have no image."""
    items, _ = _image_items(spark, sf)
    return GD.apply_image_arms(items, ["untuned", *ST.IMAGE_ARM_STEP], ST.image_stub_factory, "id", "pyte_ocr", "image")


@query("image_arms_wide", _IMAGE_SQL + "SELECT id, any_value(gold) AS transcription, any_value(pyte) AS pyte_ocr, "
       + ", ".join(f"max(output) FILTER (WHERE arm = '{a}') AS \"LLAVA_{a}\"" for a in ["untuned", *ST.IMAGE_ARM_STEP]) + " FROM out GROUP BY id")
def q_image_arms_wide(spark, sf):
    """O-30 for the seven image columns of the testing template."""
    items, _ = _image_items(spark, sf)
    arms = ["untuned", *ST.IMAGE_ARM_STEP]
    long = GD.apply_image_arms(items, arms, ST.image_stub_factory, "id", "pyte_ocr", "image")
    return GN.arms_wide(items.drop("image"), long, "id", arms, prefix="LLAVA_")


@query("guarded_arms", _IMAGE_SQL + """SELECT id, arm, output, status FROM out LEFT JOIN stops USING (arm)
WHERE stop IS NULL OR place < stop""")
def q_guarded_arms(spark, sf):
    """O-41 + O-80: arms in rounds, stopped at the fifth output in a row that equals the untuned one;
    that output and all later ones of the arm are absent."""
    return _guarded(spark, sf).outputs.select("id", "arm", "output", "status")


@query("guarded_calls", _IMAGE_SQL + f"""SELECT arm, count(*) FILTER (WHERE s.stop IS NULL OR rnd <= (length(bin((s.stop - 1) // {FIRST_ROUND} + 1)) - 1))::BIGINT AS generated,
       any_value(s.stop)::BIGINT AS stopped_at
FROM (SELECT *, length(bin((place - 1) // {FIRST_ROUND} + 1)) - 1 AS rnd FROM cmp) JOIN stops s USING (arm) GROUP BY arm""")
def q_guarded_calls(spark, sf):
    """O-41 + O-80: how often each arm's generator ran (no round after its stop) and where it stopped."""
    return _guarded(spark, sf).report.select("arm", "generated", "stopped_at")
