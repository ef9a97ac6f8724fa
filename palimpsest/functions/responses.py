"""Request / response record expressions (O-59, O-60, O-62, O-66).

Schemas are explicit; JSON is parsed with ``from_json`` and built with ``to_json``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import constants as K
from .text import _col, pystrip, strip_fence

# ------------------------------------------------------------------ schemas

CONTENT_PART = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("image_url", T.StructType([T.StructField("url", T.StringType())])),
])

REQUEST_SCHEMA = T.StructType([
    T.StructField("custom_id", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("body", T.StructType([
        T.StructField("model", T.StringType()),
        T.StructField("messages", T.ArrayType(T.StructType([
            T.StructField("role", T.StringType()),
            T.StructField("content", T.ArrayType(CONTENT_PART)),
        ]))),
        T.StructField("max_tokens", T.IntegerType()),
    ])),
])

RESPONSE_SCHEMA = T.StructType([
    T.StructField("custom_id", T.StringType()),
    T.StructField("response", T.StructType([
        T.StructField("body", T.StructType([
            T.StructField("choices", T.ArrayType(T.StructType([
                T.StructField("message", T.StructType([T.StructField("content", T.StringType())])),
            ]))),
        ])),
    ])),
])

ANSWER_SCHEMA = T.StructType([
    T.StructField("ocr_text", T.StringType()),
    T.StructField("summary", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("is_printed", T.BooleanType()),
    T.StructField("is_legible", T.BooleanType()),
])

BATCH_RECORD_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("object", T.StringType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("errors", T.StringType()),
    T.StructField("input_file_id", T.StringType()),
    T.StructField("completion_window", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("output_file_id", T.StringType()),
    T.StructField("error_file_id", T.StringType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("in_progress_at", T.LongType()),
    T.StructField("expires_at", T.LongType()),
    T.StructField("completed_at", T.LongType()),
    T.StructField("failed_at", T.LongType()),
    T.StructField("expired_at", T.LongType()),
    T.StructField("request_counts", T.StructType([
        T.StructField("total", T.IntegerType()),
        T.StructField("completed", T.IntegerType()),
        T.StructField("failed", T.IntegerType()),
    ])),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])


# ------------------------------------------------------------------ O-59

def build_request(custom_id, prompt, image_url, model: str = K.REQUEST_MODEL,
                  max_tokens: int = K.REQUEST_MAX_TOKENS) -> Column:
    """One batch request line as compact JSON.

    The two content parts have different shapes (text vs image_url); both are one
    struct type whose unused field is null, and ``to_json`` drops null fields.
    """
    text_part = F.struct(F.lit("text").alias("type"), pystrip(_col(prompt)).alias("text"),
                         F.lit(None).cast(CONTENT_PART["image_url"].dataType).alias("image_url"))
    image_part = F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"),
                          F.struct(_col(image_url).alias("url")).alias("image_url"))
    body = F.struct(
        F.lit(model).alias("model"),
        F.array(F.struct(F.lit("user").alias("role"), F.array(text_part, image_part).alias("content"))).alias("messages"),
        F.lit(max_tokens).alias("max_tokens"),
    )
    record = F.struct(_col(custom_id).alias("custom_id"), F.lit(K.REQUEST_METHOD).alias("method"),
                      F.lit(K.REQUEST_URL).alias("url"), body.alias("body"))
    return F.to_json(record, {"ignoreNullFields": "true"})


# ------------------------------------------------------------------ O-60

def parse_response(line) -> Column:
    """Parse a result JSONL line; malformed text gives a struct of nulls."""
    return F.from_json(_col(line), RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})


def response_content(record) -> Column:
    """``response.body.choices[0].message.content``; null when there are no choices."""
    r = _col(record)
    return F.get(r["response"]["body"]["choices"], 0)["message"]["content"]


def has_choices(record) -> Column:
    return F.coalesce(F.size(_col(record)["response"]["body"]["choices"]) > 0, F.lit(False))


# ------------------------------------------------------------------ O-62

def _regex_field(content: Column, name: str) -> Column:
    return F.regexp_extract(content, K.ANSWER_PATTERNS[name], 1)


def extract_answer_fields(content, mode: str = "regex") -> Column:
    """Five answer fields from a model answer (after :func:`strip_fence`).

    ``regex`` (parity): the five patterns on the raw text, defaults ``''``, ``''``,
    ``No Date Provided``, false, false. ``json``: parsed fields first, regex as
    fallback. ``method`` records whether the answer parsed as JSON.
    """
    c = strip_fence(_col(content))
    ocr = _regex_field(c, "ocr_text")
    summary = _regex_field(c, "summary")
    date = F.coalesce(F.nullif(_regex_field(c, "date"), F.lit("")), F.lit(K.DEFAULT_DATE))
    printed = _regex_field(c, "is_printed") == "true"
    legible = _regex_field(c, "is_legible") == "true"
    parsed = F.from_json(c, ANSWER_SCHEMA)
    ok = F.coalesce(F.try_parse_json(c).isNotNull(), F.lit(False))
    if mode == "json":
        ocr = F.coalesce(parsed["ocr_text"], ocr)
        summary = F.coalesce(parsed["summary"], summary)
        date = F.coalesce(parsed["date"], date)
        printed = F.coalesce(parsed["is_printed"], printed)
        legible = F.coalesce(parsed["is_legible"], legible)
    elif mode != "regex":
        raise ValueError(f"unknown mode {mode!r}")
    method = F.when(ok, F.lit(K.METHOD_JSON)).otherwise(F.lit(K.METHOD_REGEX))
    return F.struct(ocr.alias("ocr_text"), summary.alias("summary"), date.alias("date"),
                    printed.alias("is_printed"), legible.alias("is_legible"), method.alias("method"))


# ------------------------------------------------------------------ O-66

def batch_record_fields(record_json) -> list[Column]:
    """Flattened columns of a batch metadata record."""
    r = F.from_json(_col(record_json), BATCH_RECORD_SCHEMA)
    cols = [r[f.name].alias(f.name) for f in BATCH_RECORD_SCHEMA.fields if f.name not in ("request_counts", "metadata")]
    cols += [
        r["request_counts"]["total"].alias("total_requests"),
        r["request_counts"]["completed"].alias("completed_requests"),
        r["request_counts"]["failed"].alias("failed_requests"),
        r["metadata"]["description"].alias("description"),
        F.timestamp_seconds(r["created_at"]).alias("created_ts"),
    ]
    return cols
