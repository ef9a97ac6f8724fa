"""Inputs derived from the driver tables (nothing is generated from scratch).

Each derivation is plain Spark over ``documents``, ``labels``, ``pages``, ``events``,
``conversations`` and ``embeddings``; the oracle SQL repeats the same definitions as
CTEs (``plans/oracle.py``), so both engines read identical inputs.

- ``gold``: one manifest row per document, ``id = 'd' || doc_id``.
- ``tagged``: tagged answer sidecar ``d<id>.jpg.txt`` for every labelled document;
  Printed = ``quality = 1``, Legible = ``toxic = 0``, summary = ``source``.
- ``engine``: engine sidecar ``d<id>.txt.pyte`` with character noise; the engine has
  no German model, so German documents have no engine text.
- ``listing``: image files present on disk, one per page.
- ``items``: request items ``lang/source/d<id>.jpg`` whose bytes are the text.
- ``responses``: one result line per document, keyed by the image path of its text
  (copies share a key); the answer format varies by language.
- ``status_events``, ``arm_rows``, ``turns``, ``vectors``: see functions below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as T
from ..session import table

ENGINE_NOISE_FROM = "ilo"
ENGINE_NOISE_TO = "110"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def doc_id_key(c="doc_id"):
    return F.concat(F.lit("d"), F.col(c).cast("string"))


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest with the reference column names ``Asset``, ``Transcription``."""
    d = _docs(spark, sf)
    return d.select(doc_id_key().alias("Asset"), F.col("text").alias("Transcription"),
                    F.col("lang").alias("Language"))


def tagged(spark: SparkSession, sf: str) -> DataFrame:
    """(name, content) tagged sidecars for labelled documents."""
    d = _docs(spark, sf)
    lab = table(spark, sf, "labels")
    j = d.join(lab, "doc_id")
    content = T.format_tagged(F.col("text"), F.col("source"), F.lit(K.DEFAULT_DATE),
                              F.col("quality") == 1, F.col("toxic") == 0)
    return j.select(F.concat(doc_id_key(), F.lit(".jpg.txt")).alias("name"), content.alias("content"))


def engine(spark: SparkSession, sf: str) -> DataFrame:
    """(name, content) engine sidecars; none for German documents."""
    d = _docs(spark, sf).filter(F.col("lang") != "de")
    return d.select(F.concat(doc_id_key(), F.lit(".txt.pyte")).alias("name"),
                    F.translate("text", ENGINE_NOISE_FROM, ENGINE_NOISE_TO).alias("content"))


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """(name) image files present."""
    p = table(spark, sf, "pages")
    return p.select(F.concat(F.lit("d"), F.col("page_id").cast("string"), F.lit(".jpg")).alias("name"))


def items(spark: SparkSession, sf: str) -> DataFrame:
    """(path, shard, length, content) request items; bytes are the UTF-8 text."""
    d = _docs(spark, sf)
    return d.select(
        F.concat_ws("/", "lang", "source", F.concat(doc_id_key(), F.lit(".jpg"))).alias("path"),
        F.col("lang").alias("shard"),
        F.octet_length("text").cast("long").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
    )


def answer_text(text, source, lang, quality=None, toxic=None):
    """Model answer for a document; format by language.

    en: clean JSON; fr: fenced JSON; es: no space after the colons (regexes miss);
    de: not used (the response has no choices).
    """
    esc = F.replace(F.replace(F.col(text), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    printed = F.lit("true") if quality is None else F.when(F.col(quality) == 1, "true").otherwise("false")
    legible = F.lit("true") if toxic is None else F.when(F.col(toxic) == 0, "true").otherwise("false")
    sep = F.when(F.col(lang) == "es", F.lit(":")).otherwise(F.lit(": "))
    body = F.concat(
        F.lit('{\n  "ocr_text"'), sep, F.lit('"'), esc, F.lit('",\n  "summary"'), sep, F.lit('"'), F.col(source),
        F.lit('",\n  "date"'), sep, F.lit('"1919-05-01",\n  "is_printed"'), sep, printed,
        F.lit(',\n  "is_legible"'), sep, legible, F.lit("\n}"),
    )
    return F.when(F.col(lang) == "fr", F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """(line_no, line) result JSONL lines built with ``to_json``."""
    d = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id", "left")
    key = T.path_to_key(F.concat_ws("/", "lang", "source", F.concat(F.substring(F.md5("text"), 1, 12), F.lit(".jpg"))))
    content = answer_text("text", "source", "lang", "quality", "toxic")
    choices = F.when(F.col("lang") == "de", F.array().cast("array<struct<message:struct<content:string>>>")).otherwise(
        F.array(F.struct(F.struct(content.alias("content")).alias("message"))))
    rec = F.struct(key.alias("custom_id"), F.struct(F.struct(choices.alias("choices")).alias("body")).alias("response"))
    return d.select(F.col("doc_id").alias("line_no"), F.to_json(rec).alias("line"))


STATUS_OF_EVENT = {"purchase": "completed", "error": "failed", "signup": "expired"}


def status_events(spark: SparkSession, sf: str) -> DataFrame:
    """(batch_id, ts, event_id, status): each event is one poll of batch ``user_id``."""
    e = table(spark, sf, "events")
    status = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in STATUS_OF_EVENT.items() for x in kv]),
                                     F.col("event_type")), F.lit("in_progress"))
    return e.select(F.concat(F.lit("batch_"), F.col("user_id").cast("string")).alias("batch_id"),
                    "ts", "event_id", status.alias("status"), "value", "event_type")


def arm_rows(spark: SparkSession, sf: str) -> DataFrame:
    """(arm, ord, same): outputs of arm ``user_id`` in ``event_id`` order; ``same``
    marks an output equal to the untuned one (view, click, error)."""
    e = table(spark, sf, "events")
    return e.select(F.col("user_id").alias("arm"), F.col("event_id").alias("ord"),
                    F.col("event_type").isin("view", "click", "error").alias("same"))


ROLE_OF = {"user": "human", "assistant": "gpt"}


def turns(spark: SparkSession, sf: str) -> DataFrame:
    """(conv_id, turn, from, value): user -> human, assistant -> gpt, others kept."""
    c = table(spark, sf, "conversations")
    role = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ROLE_OF.items() for x in kv]), F.col("role")),
                      F.col("role"))
    return c.select("conv_id", "turn", role.alias("from"), F.col("text").alias("value"))


def vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(base, tuned) named vector snapshots; tuned names are shifted by one id.

    Names end in ``.lora_A`` for even labels and ``.weight`` otherwise.
    """
    e = table(spark, sf, "embeddings")
    suffix = F.when(F.col("label") % 2 == 0, F.lit(".lora_A")).otherwise(F.lit(".weight"))
    base = e.select(F.concat(F.lit("layer"), F.col("vec_id").cast("string"), suffix).alias("name"),
                    F.col("embedding").alias("vec"))
    tuned = e.select(F.concat(F.lit("layer"), (F.col("vec_id") + 1).cast("string"), suffix).alias("name"),
                     F.col("embedding").alias("vec"))
    return base, tuned
