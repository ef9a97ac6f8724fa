"""A training corpus from ``documents``: language, repeated lines, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read back as the next stage's documents. The stages work on all rows they are given.

1. ``language_id`` learns from the labelled rows and removes documents without a language
   (no letter, null text) and those whose best language gets less than ``LEAST_SHARE``.
2. ``line_dedup`` removes repeated lines from the texts; documents stay, also empty ones.
3. ``simhash_near_dedup`` keeps one document of each near-duplicate group.
4. ``best_fit_packing`` packs the rest into sequences: the result's rows are its pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm import langid, line_dedup, near_dedup, packing
from palimpsest.llm.common import numbered, place_of, stored
from palimpsest.llm.queries import TOKENIZERS
from palimpsest.session import table

#: A document goes if its likeliest language has a smaller share than this.
LEAST_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs)
    rows = numbered(docs).withColumn("text", F.col(place_of(docs, "text")))
    found = langid.predict(rows, model, *rows.columns[:-1])
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).drop("lang_pred", "score").toDF(*docs.columns)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs, width=3, max_bits=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, f"{TOKENIZERS}/byte_bpe_50k.json", end_id=2, blanks_kept=True, capacity=1024)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", remove_repeated_lines),
    ("simhash_near_dedup", remove_near_duplicates),
    ("best_fit_packing", pack_sequences),
]

#: Models, hashes and tokenizers have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
